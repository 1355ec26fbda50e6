"""C1: the spend job - validate, compute rewards, split, report."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import DEFAULT_MAX_BROADCAST_ROWS
from ..operators.messages import message_json, to_messages
from ..operators.report import observed, observed_report, reject_rows, run_report, write_rejects
from ..operators.rules import apply_rules
from ..operators.validate import validate_spend
from ..schemas import SPEND_SCHEMA
from ..session import scratch_path
from ..sources.files import read_csv, read_csv_checked


def process_spend(tx: DataFrame, card_types: DataFrame, exclusions: DataFrame, rules: DataFrame,
                  categories: DataFrame, tenant: str, rates: dict | DataFrame | None = None,
                  scope: Sequence[str] = (), form: str = "auto",
                  cache: list | None = None,
                  max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                  within: Sequence[str] = (), counted: bool = False) -> DataFrame:
    """Every spend row with its reject_reason (NULL = accepted), the converted
    amount, per-tier rates, rewards and remarks. One plan, no row dropped.
    Frames persisted on the way are appended to ``cache``. Tables above
    ``max_broadcast_rows`` rows are joined by shuffle instead of broadcast.
    ``within``, ``counted``: as in ``validate_spend``."""
    v = validate_spend(tx, card_types, exclusions, tenant, rates=rates, scope=scope, cache=cache,
                       max_broadcast_rows=max_broadcast_rows, within=within, counted=counted)
    return apply_rules(v, rules, categories, form=form, key=[*scope, "transaction_id"],
                       cache=cache, max_broadcast_rows=max_broadcast_rows)


@dataclass
class SpendRun:
    result: DataFrame
    rejects: DataFrame
    messages: DataFrame
    report: DataFrame
    cached: list

    def release(self) -> None:
        """Unpersist the result and the helper frames."""
        for df in [self.result, *self.cached]:
            df.unpersist()


def spend_run(tx: DataFrame, dims: dict[str, DataFrame], tenant: str, filename: str | None = None,
              error_path: str = "", rates: dict | DataFrame | None = None,
              scope: Sequence[str] = (),
              form: str = "auto") -> SpendRun:
    """The whole job as lazy DataFrames over one persisted result, so the
    input is read and the rules evaluated once for all outputs."""
    cached: list = []
    res = process_spend(tx, dims["card_types"], dims["exclusions"], dims["rules"],
                        dims["categories"], tenant, rates=rates, scope=scope, form=form,
                        cache=cached)
    res = res.persist(StorageLevel.MEMORY_AND_DISK)
    extra = tuple(scope)
    return SpendRun(
        result=res,
        rejects=reject_rows(res, extra),
        messages=to_messages(res, tenant),
        report=run_report(res, filename, error_path, by_file="source_file" in scope),
        cached=cached,
    )


def run_spend_file(spark: SparkSession, path: str, dims: dict[str, DataFrame], tenant: str,
                   out_dir: str, run_id: str, rates: dict | DataFrame | None = None,
                   check_lines: bool = False) -> DataFrame:
    """Batch job for one spend CSV: rejects to ``out_dir/error/<run_id>``,
    messages (JSON lines) to ``out_dir/messages/<run_id>``; returns the
    one-row report. ``check_lines``: malformed lines are no spend rows but go, as JSON
    lines with their text, to ``out_dir/bad_lines/<run_id>``."""
    if check_lines:
        tx, bad = read_csv_checked(spark, path, SPEND_SCHEMA, spread_input=True)
        bad.write.mode("overwrite").json(f"{out_dir.rstrip('/')}/bad_lines/{run_id}")
    else:
        tx = read_csv(spark, path, SPEND_SCHEMA, spread_input=True)
    out = out_dir.rstrip("/")
    err, cached = f"{out}/error/{run_id}", []
    scored = process_spend(tx, dims["card_types"], dims["exclusions"], dims["rules"], dims["categories"], tenant,
                           rates=rates, cache=cached)
    counted, counts = observed(scored)
    place = scratch_path(spark, f"spend-{uuid.uuid4().hex}")
    try:
        # one pass scores and counts; the outputs are read from what it wrote
        counted.write.parquet(place)
        result = spark.read.schema(scored.schema).parquet(place)
        report = observed_report(spark, counts, path.rstrip("/").split("/")[-1], err)
        if counts.get["numberOfRejected"]:
            write_rejects(reject_rows(result), err)
        message_json(to_messages(result, tenant)).write.mode("overwrite").json(f"{out}/messages/{run_id}")
        return report
    finally:
        for df in cached:
            df.unpersist()
        p = spark._jvm.org.apache.hadoop.fs.Path(place)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
