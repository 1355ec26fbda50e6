"""Plan shape: what must hold at scale, checked on the physical plan."""

from rewardflow.plans.registry import QUERIES
from rewardflow.sources import testviews as tv

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spend_plan_broadcasts_dimensions_and_never_shuffles_the_fact(spark):
    p = plan(QUERIES["tiered_rewards"](spark, SF))
    assert "SortMergeJoin" not in p
    # hash exchanges: the map-side-combined duplicate-key count on transaction_id,
    # and the small dimensions grouped before their broadcast (card type name,
    # exclusion keys, rules per card type, patterns per mcc); no fact column else
    allowed = ("transaction_id#", "name#", "_ex_ct#", "_r_ct#", "mcc#")
    exchanges = [ln.split("hashpartitioning(")[1] for ln in p.splitlines()
                 if "Exchange hashpartitioning" in ln]
    assert exchanges and all(x.startswith(allowed) for x in exchanges), exchanges
    assert "BroadcastHashJoin" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(QUERIES["reject_folder"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_filters_reach_the_scan(spark):
    p = plan(tv.spend(spark, SF))
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in p


def test_dedupe_is_partially_aggregated_before_the_shuffle(spark):
    p = plan(QUERIES["users_dedupe_campaign"](spark, SF))
    # map-side partial min(struct) before the exchange: a hot key cannot pile up in one task
    assert p.count("SortAggregate") + p.count("HashAggregate") + p.count("ObjectHashAggregate") >= 2
    assert "Window" not in p


def test_invariants_on_whole_table(spark):
    from pyspark.sql import functions as F
    from rewardflow.plans.spend import spend_run
    run = spend_run(tv.spend(spark, SF), tv.dims(spark), tv.TENANT, filename="f", error_path="e/")
    try:
        rep = run.report.collect()[0]
        total = tv.spend(spark, SF).count()
        assert rep["numberOfRows"] == total == rep["numberOfProcessed"] + rep["numberOfRejected"]
        assert run.rejects.count() == rep["numberOfRejected"]
        per_tx = run.messages.groupBy("transactionId").count().agg(F.max("count")).first()[0]
        assert per_tx <= 3
        keys = run.messages.select("messageKey")
        assert keys.distinct().count() == keys.count()
    finally:
        run.release()


def test_no_python_udfs_or_pair_joins_in_any_query(spark):
    from rewardflow.plans.registry import QUERIES as Q
    banned = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
              "FlatMapGroupsInPandas", "MapInPandas", "Window [row_number")
    for name, fn in Q.items():
        if name.startswith("file_stream_"):
            continue  # their result is read back from the stream's output files
        p = plan(fn(spark, SF))
        found = [b for b in banned if b in p]
        assert not found, (name, found)


def _filters(df):
    return [ln for ln in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in ln]


def test_no_filter_evaluates_the_tiers(spark):
    for name in ("tiered_rewards", "reward_messages", "rewards_by_card_type"):
        assert not [ln for ln in _filters(QUERIES[name](spark, SF)) if "aggregate(" in ln], name


def test_join_form_moves_accepted_rows_once(spark):
    from rewardflow.operators.rules import apply_rules
    from rewardflow.operators.validate import validate_spend
    d = tv.dims(spark)
    v = validate_spend(tv.spend(spark, SF), d["card_types"], d["exclusions"], tv.TENANT)
    p = plan(apply_rules(v, d["rules"], d["categories"], form="join"))
    # the accepted rows are gathered once, by key, after a partial aggregation
    assert p.count("partial_first(_row") == 1 and "SortMergeJoin" not in p


def test_size_check_moves_no_rows(spark):
    from rewardflow.operators.joins import is_bounded
    df = tv.rules(spark)
    assert is_bounded(df, 100) and not is_bounded(df, 5) and not is_bounded(df, 100, 50)
