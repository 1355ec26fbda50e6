"""CSV batch job, users write job, file stream and path/date helpers."""

import csv
import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import dims, rule
from rewardflow import schemas as S
from rewardflow.functions.text import base_name, normalise_date, reject_folder
from rewardflow.plans.spend import run_spend_file
from rewardflow.plans.users import write_users_run
from rewardflow.streaming.files import spend_file_stream


def write_csv(path, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(S.SPEND_COLUMNS)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def row(i, txid, mcc="5000", currency="SGD", amount="100.00", card_type="shop"):
    return (f"id{i}", txid, "GRAB FOOD", mcc, currency, amount, "2021-09-03", "c1",
            "4111111111111234", card_type)


def test_run_spend_file_writes_rejects_messages_report(spark):
    d = dims(spark, rules=[rule("base", 1, 0.1)])
    tmp = tempfile.mkdtemp(prefix="rf-job-", dir="/tmp")
    src = os.path.join(tmp, "spend.csv")
    write_csv(src, [row(0, "a"), row(1, "b", mcc=""), row(2, "c"), row(3, "c"), row(4, "d", currency="EUR")])
    rep = run_spend_file(spark, src, d, "t1", os.path.join(tmp, "out"), "run1").collect()[0]
    assert (rep["filename"], rep["numberOfRows"], rep["numberOfProcessed"], rep["numberOfRejected"]) == (
        "spend.csv", 5, 1, 4)
    rej = spark.read.option("header", True).csv(rep["errorFileURL"]).collect()
    assert sorted(r["reject_reason"] for r in rej) == [
        "Duplicate rows", "Duplicate rows", "EUR is not in currency mapping!", "MCC is empty!"]
    assert {r["card_pan"] for r in rej} == {"****1234"}
    msgs = [json.loads(r["body"]) for r in spark.read.json(os.path.join(tmp, "out/messages/run1"))
            .select(F.to_json(F.struct("*")).alias("j")).select(
                F.get_json_object("j", "$.body").alias("body")).collect()]
    assert len(msgs) == 1
    m = msgs[0]
    assert (m["tenant"], m["transactionId"], m["mcc"], m["amount"], m["rewardAmount"]) == (
        "T1", "a", 5000, 100.0, 10.0)
    assert m["remarks"] == "Base reward giving 10.0 cashback/SGD"


def test_spend_stream_two_triggers_nothing_reread(spark):
    d = dims(spark, rules=[rule("base", 1, 0.1)])
    tmp = tempfile.mkdtemp(prefix="rf-stream-", dir="/tmp")
    inp, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    os.makedirs(inp)
    # the same transaction id in two files is not a duplicate: each file is its own run
    write_csv(os.path.join(inp, "f1.csv"), [row(0, "a"), row(1, "x"), row(2, "x")])
    write_csv(os.path.join(inp, "f2.csv"), [row(3, "a"), row(4, "b", mcc="")])
    q = spend_file_stream(spark, inp, d, "t1", out, ck, max_files_per_trigger=1)
    q.awaitTermination()
    res = spark.read.parquet(os.path.join(out, "result"))
    got = {(r["source_file"].split("/")[-1], r["id"]): r["reject_reason"] for r in res.collect()}
    assert got == {("f1.csv", "id0"): None, ("f1.csv", "id1"): "Duplicate rows",
                   ("f1.csv", "id2"): "Duplicate rows", ("f2.csv", "id3"): None,
                   ("f2.csv", "id4"): "MCC is empty!"}
    report = spark.read.parquet(os.path.join(out, "report")).collect()
    rep = {r["filename"]: (r["numberOfProcessed"], r["numberOfRejected"]) for r in report}
    assert rep == {"f1.csv": (1, 2), "f2.csv": (1, 1)}
    for r in report:  # as the batch job: headered CSV rejects and JSON bodies
        assert "/error/in/batch=" in r["errorFileURL"]
        rej = spark.read.option("header", True).csv(r["errorFileURL"]).collect()
        assert len(rej) == r["numberOfRejected"] and {x["card_pan"] for x in rej} == {"****1234"}
    bodies = [json.loads(r["body"]) for r in spark.read.json(os.path.join(out, "messages")).collect()]
    assert sorted((b["transactionId"], b["rewardAmount"]) for b in bodies) == [("a", 10.0), ("a", 10.0)]
    batches_before = set(os.listdir(os.path.join(out, "result")))

    write_csv(os.path.join(inp, "f3.csv"), [row(5, "z")])
    q = spend_file_stream(spark, inp, d, "t1", out, ck)
    q.awaitTermination()
    new = set(os.listdir(os.path.join(out, "result"))) - batches_before
    assert len(new) == 1
    fresh = spark.read.parquet(os.path.join(out, "result", new.pop())).collect()
    assert [(r["source_file"].split("/")[-1], r["id"]) for r in fresh] == [("f3.csv", "id5")]


def test_spend_stream_reads_each_file_by_its_own_header(spark):
    d = dims(spark, rules=[rule("base", 1, 0.1)])
    tmp = tempfile.mkdtemp(prefix="rf-stream-", dir="/tmp")
    inp, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    os.makedirs(inp)
    write_csv(os.path.join(inp, "f1.csv"), [row(0, "a")])
    with open(os.path.join(inp, "f2.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["extra", *reversed(S.SPEND_COLUMNS)])
        w.writerow(["e", *reversed(row(1, "b"))])
    spend_file_stream(spark, inp, d, "t1", out, ck).awaitTermination()
    res = spark.read.parquet(os.path.join(out, "result")).collect()
    assert sorted((r["id"], r["merchant"], r["mcc"], r["reject_reason"]) for r in res) == [
        ("id0", "GRAB FOOD", "5000", None), ("id1", "GRAB FOOD", "5000", None)]


def test_write_users_run_refuses_its_own_targets(spark):
    import pytest
    tmp = tempfile.mkdtemp(prefix="rf-users-", dir="/tmp")
    spark.createDataFrame([("1", "a@x", "acme")], S.CARD_CUSTOMER_SCHEMA).write.parquet(f"{tmp}/card_customer")
    targets = {"card_customers": spark.read.parquet(f"{tmp}/card_customer")}
    with pytest.raises(ValueError, match="being read"):
        write_users_run(spark, spark.createDataFrame([], S.USER_SCHEMA), "acme", targets, tmp)


def test_write_users_run(spark):
    from rewardflow.sources.testviews import local_table
    tmp = tempfile.mkdtemp(prefix="rf-users-", dir="/tmp")
    users = spark.createDataFrame(
        [("1", "Ann", "Lee", "a@x", "9", "c1", "5111", "scis_gold", "2021-01-01")], S.USER_SCHEMA)
    targets = {
        "card_customers": spark.createDataFrame([], S.CARD_CUSTOMER_SCHEMA),
        "cards": spark.createDataFrame([], S.CARD_SCHEMA),
        "card_types": local_table(spark, [(3, "scis_shopping", "acme")], S.CARD_TYPE_SCHEMA),
        "campaign_customers": spark.createDataFrame([], S.CAMPAIGN_CUSTOMER_SCHEMA),
    }
    paths = write_users_run(spark, users, "acme", targets, tmp)
    ct = sorted((r["id"], r["name"]) for r in spark.read.parquet(paths["card_type"]).collect())
    assert ct == [(3, "scis_shopping"), (4, "scis_gold")]
    cc = [(r["name"], r["card_type_id"]) for r in spark.read.parquet(paths["campaign_customer"]).collect()]
    assert cc == [("Ann Lee", 4)]


def test_path_and_date_helpers(spark):
    df = spark.createDataFrame([("bucket/in/2021/users.csv", "3/9/2021"), ("users.csv", "2021-09-03"),
                                ("a/b", "12/11/2021")], "k string, d string")
    got = df.select(base_name("k").alias("b"), reject_folder("k").alias("f"),
                    normalise_date("d").alias("n")).collect()
    assert [tuple(r) for r in got] == [("users.csv", "error/2021/", "3-09-2021"),
                                       ("users.csv", None, "2021-09-03"),
                                       ("b", "error/a/", "12-11-2021")]


def test_users_stream_second_file_sees_first(spark):
    import time
    from rewardflow.sources.testviews import local_table
    from rewardflow.streaming.files import latest_users_snapshot, users_file_stream
    tmp = tempfile.mkdtemp(prefix="rf-ustream-", dir="/tmp")
    inp, out, ck = (os.path.join(tmp, x) for x in ("in/2021-10", "out", "ck"))
    os.makedirs(inp)

    def put(name, rows):
        with open(os.path.join(inp, name), "w", newline="") as f:
            w = csv.writer(f)
            w.writerow(S.USER_COLUMNS)
            for r in rows:
                w.writerow(r)

    put("u1.csv", [("1", "Ann", "Lee", "a@x", "9", "c1", "5111", "scis_gold", "2021-01-01")])
    time.sleep(1.1)  # the file source orders by modification time
    put("u2.csv", [("1", "Ann", "Lee", "a2@x", "9", "c1", "5111", "scis_gold", "2021-02-01"),
                   ("2", "Bo", None, "b@x", "8", "c2", "5222", None, "2021-02-01")])
    targets = {
        "card_customers": spark.createDataFrame([], S.CARD_CUSTOMER_SCHEMA),
        "cards": spark.createDataFrame([], S.CARD_SCHEMA),
        "card_types": local_table(spark, [(3, "scis_shopping", "acme")], S.CARD_TYPE_SCHEMA),
        "campaign_customers": spark.createDataFrame([], S.CAMPAIGN_CUSTOMER_SCHEMA),
    }
    users_file_stream(spark, inp, "acme", targets, out, ck).awaitTermination()
    snap = latest_users_snapshot(spark, out, targets)
    assert sorted((r["id"], r["name"]) for r in snap["card_type"].collect()) == [
        (3, "scis_shopping"), (4, "scis_gold")]
    assert {r["customer_id"]: r["email"] for r in snap["card_customer"].collect()} == {
        "1": "a2@x", "2": "b@x"}
    assert [(r["name"], r["card_type_id"], r["email"]) for r in snap["campaign_customer"].collect()] == [
        ("Ann Lee", 4, "a2@x")]
    seq = {name.split("-")[0]: name for name in os.listdir(out) if name.startswith("seq=")}
    rej = spark.read.parquet(os.path.join(out, seq["seq=1"], "rejects_by_folder")).collect()
    assert {r["reject_folder"] for r in rej} == {"error/2021-10/"}
    # a batch writes what its file changes, not the tables
    assert spark.read.parquet(os.path.join(out, seq["seq=1"], "card_type")).count() == 0
    assert [r["customer_id"] for r in spark.read.parquet(os.path.join(out, seq["seq=0"], "card_customer")).collect()] == ["1"]

    # a new checkpoint goes on from the last commit, compacting on the way
    time.sleep(1.1)
    os.makedirs(os.path.join(tmp, "more/2021-11"))
    inp = os.path.join(tmp, "more/2021-11")
    put("u3.csv", [("3", "Cy", "Dee", "c@x", "7", "c3", "5333", "scis_gold", "2021-03-01")])
    users_file_stream(spark, inp, "acme", targets, out, ck + "2", compact_every=3).awaitTermination()
    want = {"1": "a2@x", "2": "b@x", "3": "c@x"}
    for first in (targets, None):  # the compacted tables stand on their own
        snap = latest_users_snapshot(spark, out, first)
        assert {r["customer_id"]: r["email"] for r in snap["card_customer"].collect()} == want

    # a record of commits that cannot be read fails the batch instead of starting over
    for name in os.listdir(os.path.join(out, "_log")):
        if name.endswith(".json"):
            with open(os.path.join(out, "_log", name), "wb") as f:
                f.write(b"broken")
    put("u4.csv", [("4", "Di", "Ess", "d@x", "6", "c4", "5444", "scis_gold", "2021-04-01")])
    import pytest
    with pytest.raises(Exception):
        users_file_stream(spark, inp, "acme", targets, out, ck + "2").awaitTermination()


def test_csv_header_is_checked_by_name(spark):
    import pytest
    from rewardflow.sources.files import read_csv
    tmp = tempfile.mkdtemp(prefix="rf-hdr-", dir="/tmp")
    good, bad = os.path.join(tmp, "good.csv"), os.path.join(tmp, "bad.csv")
    write_csv(good, [row(0, "a")])
    cols = list(S.SPEND_COLUMNS)
    cols[0], cols[1] = cols[1], cols[0]
    with open(bad, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(cols)
        w.writerow(["a", "id0", "M", "1", "SGD", "1.00", "2021-01-01", "c", "4111", "shop"])
    assert read_csv(spark, good, S.SPEND_SCHEMA).first()["transaction_id"] == "a"
    # columns are found by name, in any order, file by file; a missing one is an error
    assert read_csv(spark, bad, S.SPEND_SCHEMA).first()["transaction_id"] == "a"
    both = read_csv(spark, [good, bad], S.SPEND_SCHEMA, with_source=True).collect()
    assert sorted((r["id"], r["transaction_id"], os.path.basename(r["source_file"])) for r in both) == [
        ("id0", "a", "bad.csv"), ("id0", "a", "good.csv")]
    short = os.path.join(tmp, "short.csv")
    with open(short, "w") as f:
        f.write("id,mcc\n1,2\n")
    with pytest.raises(ValueError, match="transaction_id"):
        read_csv(spark, [good, short], S.SPEND_SCHEMA)
    wide = os.path.join(tmp, "wide.csv")
    with open(wide, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["more", *S.USER_COLUMNS])
        w.writerow(["m", "1", "Ann", "Lee", "a@x", "9", "c1", "5111", "scis_gold", "2021-01-01"])
    users = read_csv(spark, wide, S.USER_SCHEMA)
    assert users.columns == list(S.USER_COLUMNS) and users.first()["email"] == "a@x"


def test_cli_spend_and_users(spark):
    from rewardflow import cli
    from rewardflow.sources import testviews as tv
    tmp = tempfile.mkdtemp(prefix="rf-cli-", dir="/tmp")
    dims_dir, tgt_dir = os.path.join(tmp, "dims"), os.path.join(tmp, "targets")
    d = dims(spark, rules=[rule("base", 1, 0.1)])
    for k, v in cli.DIM_TABLES.items():
        d[k].write.parquet(os.path.join(dims_dir, v))
    src = os.path.join(tmp, "spend.csv")
    write_csv(src, [row(0, "a"), row(1, "b", mcc="")])
    rep = cli.main(["spend", "--input", src, "--tenant", "t1", "--dims", dims_dir,
                    "--out", os.path.join(tmp, "out"), "--run-id", "r1"])
    assert (rep["numberOfProcessed"], rep["numberOfRejected"]) == (1, 1)
    targets = {
        "card_customers": spark.createDataFrame([], S.CARD_CUSTOMER_SCHEMA),
        "cards": spark.createDataFrame([], S.CARD_SCHEMA),
        "card_types": tv.local_table(spark, [(3, "scis_shopping", "acme")], S.CARD_TYPE_SCHEMA),
        "campaign_customers": spark.createDataFrame([], S.CAMPAIGN_CUSTOMER_SCHEMA),
    }
    for k, v in cli.TARGET_TABLES.items():
        targets[k].write.parquet(os.path.join(tgt_dir, v))
    users_csv = os.path.join(tmp, "users.csv")
    with open(users_csv, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(S.USER_COLUMNS)
        w.writerow(["1", "Ann", "Lee", "a@x", "9", "c1", "5111", "scis_gold", "2021-01-01"])
    paths = cli.main(["users", "--input", users_csv, "--tenant", "acme", "--targets", tgt_dir,
                      "--out", os.path.join(tmp, "uout")])
    ct = sorted((r["id"], r["name"]) for r in spark.read.parquet(paths["card_type"]).collect())
    assert ct == [(3, "scis_shopping"), (4, "scis_gold")]
