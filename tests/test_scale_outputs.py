"""What the streams hold on disk and how often they score."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from conftest import dims, rule, spend_rows
from rewardflow.plans import registry
from rewardflow.plans.spend import process_spend
from rewardflow.session import LET_GO, settings
from rewardflow.streaming.files import spend_file_stream
from rewardflow.streaming.messages import distinct_dealt_messages, distinct_messages_stream


def files(path, ending):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(ending)]


def test_a_batch_packs_its_text_outputs(spark):
    tmp = tempfile.mkdtemp(prefix="rf-packed-", dir="/tmp")
    rows = spend_rows(spark, [{"mcc": None} if i % 2 else {} for i in range(4000)])
    rows.coalesce(1).write.option("header", True).csv(f"{tmp}/in")
    q = spend_file_stream(spark, f"{tmp}/in", dims(spark, rules=[rule("base", 1, 0.1)]), "t1", f"{tmp}/out", f"{tmp}/ck")
    q.awaitTermination()
    assert q.exception() is None
    assert spark.read.json(f"{tmp}/out/messages").count() == 2000
    rejects = spark.read.option("header", True).option("recursiveFileLookup", True).csv(f"{tmp}/out/error")
    assert rejects.count() == 2000 and "reject_reason" in rejects.columns
    # 290 bytes a message and 70 a reject as plain text
    assert sum(map(os.path.getsize, files(f"{tmp}/out/messages", ".gz"))) < 2000 * 120
    assert 0 < sum(map(os.path.getsize, files(f"{tmp}/out/error", ".csv.gz"))) < 2000 * 40
    assert not files(f"{tmp}/out/error", ".csv") and not files(f"{tmp}/out/messages", ".json")


def test_shuffle_files_go_with_their_query_and_settings_come_back(spark):
    def held():
        return spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().size()
    key, tmp = next(iter(LET_GO)), tempfile.mkdtemp(prefix="rf-go-", dir="/tmp")
    was, before = spark.conf.get(key, None), held()
    kept = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    with settings(spark, LET_GO):
        kept.write.parquet(f"{tmp}/x")
    time.sleep(1)
    assert held() <= before and spark.conf.get(key, None) == was
    assert spark.read.parquet(f"{tmp}/x").count() == 10 and kept.count() == 10


def test_the_message_stream_scores_every_row_once(spark, monkeypatch):
    d, passed = dims(spark, rules=[rule("base", 1, 0.1)]), spark.sparkContext.accumulator(0)
    scored = process_spend(spend_rows(spark, [{} for _ in range(300)]), d["card_types"], d["exclusions"], d["rules"],
                           d["categories"], "t1")

    def count(frames):
        for f in frames:
            passed.add(len(f))
            yield f
    monkeypatch.setattr(registry, "_result", lambda spark, sf: scored.mapInPandas(count, scored.schema))
    got = [r.transactionId for r in registry.message_stream(spark, "").collect()]
    assert sorted(got) == sorted(f"t{i}" for i in range(300))
    assert passed.value == 300


def test_dealt_messages_pass_once_and_none_is_lost(spark):
    k = F.col("id")
    rows = spark.range(0, 90, 1, 3).select(
        F.when(k % 10 > 0, (k % 30).cast("string")).alias("messageKey"), k.cast("string").alias("body"))
    batches = F.when(k < 30, F.array(F.lit(0))).when(k < 60, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(1)))
    dealt = rows.withColumn("id", F.col("body").cast("long"))
    got = [r.messageKey for r in distinct_dealt_messages(spark, dealt, batches, 4).collect()]
    assert sorted(x or "" for x in got) == sorted({str(i) for i in range(30) if i % 10} | {""})


def test_keys_seen_are_kept_on_disk(spark):
    tmp = tempfile.mkdtemp(prefix="rf-store-", dir="/tmp")
    rows = spark.createDataFrame([("a",), ("b",)], "messageKey string")
    provider = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(provider)
    for kept in (2, 2):
        rows.write.mode("append").parquet(f"{tmp}/in")
        q = distinct_messages_stream(spark, f"{tmp}/in", rows.schema, f"{tmp}/out", f"{tmp}/ck")
        q.awaitTermination()
        assert q.exception() is None and spark.read.parquet(f"{tmp}/out").count() == kept
    assert files(f"{tmp}/ck/state", ".zip") and spark.conf.get(provider) == was


def test_merchant_patterns_make_the_spend_rows_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    rows = [(f"1-{i}-{i % 40}", f"t{i}", "blue ring" if i % 2 else "red bolt", i % 5) for i in range(400)]
    scored = spark.createDataFrame(rows, "id string, transaction_id string, merchant string, mcc_int int").repartition(3)

    def count(frames):
        for f in frames:
            made.add(len(f))
            yield f
    patterns = spark.createDataFrame([("ring store 1", 1, "a"), ("RED", 2, "b"), ("e", 3, "c"), (None, 1, "d"),
                                      ("none", 4, "e")], "name string, mcc int, merchant string")
    monkeypatch.setattr(registry, "_result", lambda spark, sf: scored.mapInPandas(count, scored.schema))
    monkeypatch.setattr(registry.tv, "part_patterns", lambda spark, sf: patterns)
    got = sorted((r.id, r.pattern) for r in registry.merchant_patterns(spark, "").collect())
    want = []
    for id_, _, merchant, mcc in rows:
        text = f"{merchant} store {id_.rsplit('-', 1)[1]}"
        want += [(id_, n) for n, m, _ in (("ring store 1", 1, 0), ("RED", 2, 0), ("e", 3, 0), ("none", 4, 0))
                 if m == mcc and n.upper() in text.upper()]
    assert got == sorted(want) and got
    assert made.value == len(rows)
    registry._hold()
