"""Duplicates past the broadcast bounds, counted where the rows lie after their joins."""

import pytest
from conftest import CARD_TYPES, dims, spend_rows
from pyspark.sql import functions as F

from rewardflow.operators import validate as V
from rewardflow.sources import testviews as tv

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _validated(spark, tx, **kw):
    d = dims(spark)
    return V.validate_spend(tx, d["card_types"], d["exclusions"], CARD_TYPES[0][2], **kw)


def _reasons(df):
    return sorted((r.id, r.reject_reason or "") for r in df.collect())


@pytest.mark.parametrize("duplicates", ["keys", "slots"])
@pytest.mark.parametrize("together", [1_000_000, 1])
def test_counted_duplicates_agree_with_joined_ones(spark, monkeypatch, duplicates, together):
    monkeypatch.setattr(V, "MAX_TOGETHER", together)
    ids = ["1-1", "1-1", None, None, "1-2", "2-1", "2-1", "2-1", "3-1", "1-1", "2-2", "2-2"]
    files = ["f", "f", "f", "f", "f", "f", "g", "f", None, "g", None, None]
    rows = [dict(transaction_id=t, mcc=None if i in (1, 7) else "5000") for i, t in enumerate(ids)]
    tx = spend_rows(spark, rows)
    place = F.substring("id", 2, 9).cast("int") + 1
    tx = tx.withColumn("source_file", F.element_at(F.array(*map(F.lit, files)), place))
    keyed = tx.withColumn("_order", F.substring_index("transaction_id", "-", 1).cast("long"))
    for scope in ((), ("source_file",)):
        want = _reasons(_validated(spark, tx, scope=scope, duplicates=duplicates))
        held = []
        got = _validated(spark, keyed, scope=scope, duplicates=duplicates, max_broadcast_rows=-1, cache=held,
                         within=["_order"])
        assert "_order" not in got.columns and _reasons(got) == want and len(want) == len(rows)
        got = _validated(spark, keyed, scope=scope, duplicates=duplicates, within=["_order"])
        assert "_order" not in got.columns and _reasons(got) == want
    # the keys' table is let go when it is not joined
    assert bool(held) == (together == 1)


def test_rows_that_lie_by_order_are_not_shuffled_again(spark, monkeypatch):
    monkeypatch.setattr(tv, "DEFAULT_MAX_BROADCAST_ROWS", 0)
    d = tv.dims(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def run(duplicates, **kw):
            return V.validate_spend(tv.spend(spark, SF, "_order"), d["card_types"], d["exclusions"], tv.TENANT,
                                    max_broadcast_rows=0, duplicates=duplicates, **kw)
        for duplicates in ("keys", "slots"):
            counted = run(duplicates, within=["_order"])
            p = _plan(counted)
            assert "hashpartitioning(transaction_id#" not in p and "hashpartitioning(_order#" not in p, p
            assert p.count("Exchange hashpartitioning(l_orderkey#") == 1 and "Window" in p
            assert _reasons(counted) == _reasons(run(duplicates))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_equal_transactions_have_one_order(spark):
    rows = tv.spend(spark, SF, "_order").where("transaction_id is not null")
    most = rows.groupBy("transaction_id").agg(F.count_distinct("_order").alias("n")).agg(F.max("n")).first()[0]
    assert most == 1


def test_stream_reads_its_outputs_from_the_scored_rows_it_wrote(spark, tmp_path, monkeypatch):
    from rewardflow.streaming import files
    seen, report = [], files.run_report
    monkeypatch.setattr(files, "run_report", lambda res, **kw: seen.extend(res.inputFiles()) or report(res, **kw))
    rows = spend_rows(spark, [dict(transaction_id=t) for t in ("1-1", "1-1", "2-1", None)])
    rows = rows.withColumn("source_file", F.lit("file:/in/202101/a.csv"))
    write = files.spend_batch_writer(
        dims(spark), CARD_TYPES[0][2], str(tmp_path), fmt="parquet", within=["_order"],
        to_spend=lambda x: x.withColumn("_order", F.substring_index("transaction_id", "-", 1)))
    for _ in range(2):  # a replayed batch replaces its folders
        write(rows, 0)
    assert seen and all("/result/batch=0/" in f for f in seen)
    got = spark.read.parquet(f"{tmp_path}/report/batch=0").first()
    assert (got.numberOfRows, got.numberOfProcessed, got.numberOfRejected) == (4, 1, 3)
    assert "_order" not in spark.read.parquet(f"{tmp_path}/result/batch=0").columns


@pytest.mark.parametrize("duplicates", ["keys", "slots"])
def test_rows_that_lie_by_order_are_read_once(spark, monkeypatch, duplicates):
    monkeypatch.setattr(tv, "DEFAULT_MAX_BROADCAST_ROWS", 0)
    assert tv.lie_by_order(spark, SF)
    d, looked = tv.dims(spark), []
    for name in ("_repeated", "_repeated_by_slot"):
        real = getattr(V, name)
        monkeypatch.setattr(V, name, lambda *a, _real=real, **kw: looked.append(1) or _real(*a, **kw))

    def run(**kw):
        return V.validate_spend(tv.spend(spark, SF, "_order"), d["card_types"], d["exclusions"], tv.TENANT,
                                duplicates=duplicates, **kw)
    got = run(within=["_order"], counted=tv.lie_by_order(spark, SF))
    assert not looked and "_order" not in got.columns
    assert _reasons(got) == _reasons(run()) and looked


def test_crowded_orders_are_looked_for_first(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 5, i) for i in range(50)], "a long, b long")
    assert V.may_crowd(rows, ["a"], 9) and not V.may_crowd(rows, ["a"], 50)
    monkeypatch.setattr(tv, "DEFAULT_MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(V, "MAX_TOGETHER", 1)
    assert not tv.lie_by_order(spark, SF)


def test_few_orders_leave_the_rows_where_they_were(spark):
    assert not tv.lie_by_order(spark, SF)


@pytest.mark.parametrize("slots", [False, True])
def test_counted_duplicates_need_an_id_and_an_mcc(spark, slots):
    rows = [("a", "1", 1), ("a", "1", 1), ("a", None, 1), ("b", "1", 1), ("b", None, 1), (None, "1", None), (None, "1", None)]
    tx = spark.createDataFrame(rows, "transaction_id string, mcc string, _order long")
    got = V.with_counted_duplicates(tx, ["transaction_id"], ["_order"], slots)
    assert got.columns == [*tx.columns, "_dup"]
    assert [r.transaction_id for r in got.where("_dup").collect()] == ["a", "a"]


def test_currency_and_date_come_from_the_supplier(spark, tmp_path):
    key, line = [-27, -10, 0, 5, 6, 7, 8, 9, 17, None], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    spark.createDataFrame([(1, "x", 3)], "p_partkey long, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, 1)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "BUILDING")], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    rows = spark.createDataFrame([(1, 1, k, i, 1.5, "2020-03-04") for i, k in enumerate(key)],
                                 line + "l_extendedprice double, day string")
    rows.withColumn("l_shipdate", F.col("day").cast("timestamp")).drop("day").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {int(r.id.split("-")[1]): (r.currency, "/" in r.transaction_date) for r in tv.spend(spark, str(tmp_path)).collect()}
    want = ["SGD", "SGD", "SGD", "SGD", "USD", "USD", "sgd", "EUR", "USD", "EUR"]
    assert [got[i] for i in range(len(key))] == [(w, k is not None and k % 17 == 0) for w, k in zip(want, key)]
