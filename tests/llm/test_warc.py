import hashlib

from rewardflow.llm.warc import (
    archive_pages, decode_records, encode_record, read_bundles, read_by_index, read_frame, read_record, seek_table)

PAGES = "page_id long, url string, html string, payload string, record_type long, first string"


def make(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "f") for r in rows], PAGES)


def test_record_round_trip():
    raw = encode_record(5, "http://a/\r\nX: y", b"a\r\n\r\nWARC/1.1", 13, "d", "response", None)
    raw += encode_record(None, None, None, 7, "e", "revisit", 5)
    (a, h1, b1), (b, h2, b2) = decode_records(raw)
    assert (a, b1, h1["WARC-Record-ID"]) == (0, b"a\r\n\r\nWARC/1.1", "<urn:page:5>")
    assert "X" not in h1 and h2["WARC-Refers-To"] == "<urn:page:5>" and b2 == b""


def test_archive_reads_back(spark):
    same, tiny = "é" * 50, "x" * 99
    rows = [(3, "u3", same), (1, None, same), (2, "u2", same), (4, "u", tiny), (5, "u", tiny), (6, "u", None),
            (7, "u", ""), (None, "u", same), (8, "u", "z" * 3_000_000), (1, None, same), (9, "u", "WARC/1.1\r\n\r\n" * 30)]
    index, back = archive_pages(spark, make(spark, rows), frame_bytes=500)
    got = sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                 for r in back.collect())
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        again = html == same and i != 1
        want.append((i is None, i or 0, len(raw), hashlib.sha256(raw).hexdigest(),
                     "revisit" if again else "response", 1 if again else None))
    assert got == sorted(want)
    entries = index.collect()
    assert len(entries) == len(rows)
    by_id = {i: html for i, _, html in rows}
    for e in entries:  # a single record by its index row
        head, block = read_record(e.asDict())
        assert head["WARC-Record-ID"] == e.record_id
        if head["WARC-Type"] == "response":
            assert block == (by_id[int(e.record_id[10:-1])] or "").encode()
    for uri in {e.bundle for e in entries}:  # frames stand alone and the footer lists them
        frames = seek_table(uri)
        assert sorted({(e.frame_offset, e.frame_bytes) for e in entries if e.bundle == uri}) == [f[:2] for f in frames]
        assert all(len(read_frame(uri, *f)) == f[2] for f in frames)


def test_read_back_follows_the_bytes(spark):
    rows = [(i, "u", f"{i} " + "".join(chr(97 + (i * k) % 26) for k in range(400))) for i in range(60)]
    index, back = archive_pages(spark, make(spark, rows), frame_bytes=1000)
    assert index.select("bundle").distinct().count() < 5
    packed = index.select("bundle", "frame", "frame_bytes").distinct().agg({"frame_bytes": "sum"}).first()[0]
    few = read_by_index(index, task_bytes=packed // 6)
    assert few.rdd.getNumPartitions() in (6, 7) and back.rdd.getNumPartitions() == 1
    want = sorted(map(str, back.collect()))
    assert sorted(map(str, few.collect())) == want
    # without the index, by the footers
    whole = read_bundles(index.select("bundle").distinct(), tasks=5)
    assert whole.rdd.getNumPartitions() == 5 and sorted(map(str, whole.collect())) == want


def test_a_wrong_index_is_an_error(spark):
    import pytest
    from pyspark.sql import functions as F
    index, _ = archive_pages(spark, make(spark, [(1, "u", "a"), (2, "u", "b")]))
    with pytest.raises(Exception, match="should"):
        read_by_index(index.withColumn("record_id", F.lit("<urn:page:9>"))).collect()


def test_empty_table(spark):
    index, back = archive_pages(spark, make(spark, []))
    assert index.count() == 0 and back.count() == 0
