import os

import pytest

import corpus_pipeline as P
from rewardflow.llm.simhash_trie import one_per_component

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, position double"


def test_one_document_of_each_component_stays(spark):
    rows = [(4, "a b c d e", "x"), (2, "A b c d e", "y"), (2, "a B c d e", "y"), (2, "a B c d e", "y"), (None, None, None), (None, "", "z"),
            (9, "wholly other words stand here today", "q"), (None, "unrelated text of its own kind here", "n"),
            (None, "unrelated text of its own kind here", "n")]
    df = spark.createDataFrame([(i, t, s, s, 1, "r", 0.5) for i, t, s in rows], DOCS)
    out = one_per_component(df)
    assert out.columns == df.columns
    got = sorted((str(r.doc_id), (r.text or "").lower()) for r in out.collect())
    assert got == [("2", "a b c d e"), ("9", rows[6][1]), ("None", ""), ("None", rows[7][1])]


def test_stages_take_odd_rows_and_empty_tables(spark):
    rows = [(1, None, None), (None, "text without an id", "s"), (2, "", "s"), (2, "", "s"), (3, "é " * 50000, None),
            (3, "é " * 50000, None), (5, "some plain words that go on for a while and end", "s")]
    full = spark.createDataFrame([(i, t, "en", s, 1, "r", 0.5) for i, t, s in rows], DOCS)
    for df in (full, full.limit(0)):
        for k, (name, stage) in enumerate(P.STAGES):
            out = stage(spark, df, SF)
            n = out.count()
            assert n <= 2 * len(rows)
            if k < len(P.STAGES) - 1:
                assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()


def test_mixture_keeps_columns_with_names_of_the_plan(spark):
    df = spark.createDataFrame([(1, "some words here", "s", 1.5, "a", "b", "c")],
                               "doc_id long, text string, source string, position double, Size string, "
                               "document_position string, positions string")
    out = P.mixture(spark, df, SF)
    assert out.columns == ["doc_id", "text", "source", "document_document_position", "document_Size", "document_position",
                           "document_positions", "size", "source_size", "target", "taken", "position"]
    first = out.first()
    assert (first.document_document_position, first.document_Size, first.document_position, first.document_positions,
            first["size"]) == (1.5, "a", "b", "c", 3)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    frame = docs
    for _, stage in P.STAGES:
        frame = stage(spark, frame, SF)
        sizes.append(frame.select("doc_id").distinct().count())
    out = P.run(spark, SF)
    rows = out.select("doc_id", "text", "position", "taken", "size").collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert sorted(sizes, reverse=True) == sizes and sizes[-1] > 0.4 * sizes[0]
    assert sorted((r.doc_id, r.position) for r in rows) == sorted(
        (r.doc_id, r.position) for r in frame.select("doc_id", "position").collect())
