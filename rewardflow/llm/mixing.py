"""Mixing sources to target weights along a time-varying curriculum.

Training runs over time 0 to 1. Every source has a target in words and a weight
schedule, a piecewise-linear function of time. The schedule's integral, scaled
to the target, is the source's cumulative token demand; a document copy that
fills the words [c, c + size) of its source's stream gets the training position
at which the demand reaches the middle of them, found by inverting the
integral. Documents range-sorted by position are the training order.

A stream visits its source's documents in the order of a digest of id and text
and starts over when it ends. The running word count per source is taken over
4096 digest buckets per source, so a source that holds most of the rows is
still spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rewardflow.llm.common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: (time, weight) knots, dealt to the sources like the weights: early, even, late
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 0.5), (1.0, 2.0)))
SHARE, CAP = 1.5, 2.0
BUCKET_DIGITS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """``(_null, _source, source_size)`` -> adds ``target`` and ``_rank``.

    Sources by code point, NULL last, get the weights in turn and share
    ``share`` of all words by weight; a target stops at ``cap`` times its source
    and the rest is shared again by weight, until none is above. In order of the
    weight level at which they stop, that is one level for all others. One row
    per source: the windows here have no more rows than there are sources.
    """
    every = Window.orderBy("_null", "_source")
    rank = F.row_number().over(every)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.col("_rank") % len(weights) + 1)
    ranked = (sizes.withColumn("_rank", rank - 1).withColumn("_w", weight)
              .withColumn("_cap", F.col("source_size") * F.lit(cap)))
    stop = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before = stop.rowsBetween(Window.unboundedPreceding, -1)
    after = stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) * F.lit(share)
              - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after))
    leveled = ranked.withColumn("_level", level)
    fits = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))
    found = F.max(fits).over(whole)
    return leveled.withColumn("_found", found).select(
        "_null", "_source", "source_size", "_rank",
        F.least(F.col("_cap"), F.coalesce(F.col("_found") * F.col("_w"), F.col("_cap")))
        .alias("target"))


def _segments(knots) -> Column:
    """Array of (done, area, start, w0, slope) per piece, areas scaled to sum to 1."""
    pieces = [((t1 - t0) * (w0 + w1) / 2, t0, w0, (w1 - w0) / (t1 - t0))
              for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total, done, out = sum(p[0] for p in pieces), 0.0, []
    for area, t0, w0, slope in pieces:
        out.append(F.struct(F.lit(done / total).alias("done"), F.lit(area / total).alias("area"),
                            F.lit(t0).alias("start"), F.lit(w0 / total).alias("w0"),
                            F.lit(slope / total).alias("slope")))
        done += area
    return F.array(*out)


def _position(share: Column, schedules) -> Column:
    """Time at which a source's demand has reached ``share`` of its target."""
    pieces = F.element_at(F.array(*[_segments(s) for s in schedules]),
                          (F.col("_rank") % len(schedules) + 1).cast("int"))
    piece = F.element_at(F.filter(pieces, lambda p: (p["done"] <= share) | (p["done"] == 0.0)), -1)
    left = F.least(F.greatest(share - piece["done"], F.lit(0.0)), piece["area"])
    root = F.sqrt(F.greatest(piece["w0"] * piece["w0"] + piece["slope"] * left * 2.0, F.lit(0.0)))
    return F.when(left <= 0.0, piece["start"]).otherwise(
        piece["start"] + left * 2.0 / (piece["w0"] + root))


def plan_mix(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), weights=WEIGHTS,
             schedules=SCHEDULES, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``keep`` columns plus size, source_size, target, taken and ``positions``
    (one training position per copy that the mix takes), one row per row.

    A copy is taken when the middle of its words lies within the target, so a
    source's taken words miss its target by at most half a document, and no
    document is taken more often than ``cap`` rounded up. NULL sources are one
    source; NULL and empty texts have size 0 and are never taken. Repeated rows
    follow each other in the stream. An empty table gives an empty result; other
    columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"),
                         F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
        F.col("source").isNull().alias("_null"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
        word_count().alias("size"), key.alias("_key"),
    ).withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    group = ["_null", "_source"]
    buckets = scratch.write(rows.groupBy(*group, "_bucket").agg(F.sum("size").alias("_words")),
                            "buckets")
    targets = scratch.write(source_targets(
        buckets.groupBy(*group).agg(F.sum("_words").alias("source_size")), weights, share, cap),
        "targets")
    starts = scratch.write(buckets.select(*group, "_bucket", F.coalesce(F.sum("_words").over(
        Window.partitionBy(*group).orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start")), "starts")
    scratch.drop("buckets")
    within = (Window.partitionBy(*group, "_bucket").orderBy("_key")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(starts, [*group, "_bucket"]).join(targets, group)
              .withColumn("_at", F.col("_start") + F.col("_within")))
    middles = F.transform(F.sequence(F.lit(0), F.lit(math.ceil(cap) - 1)),
                          lambda e: e * F.col("source_size") + F.col("_at") + F.col("size") / 2.0)
    taken = F.when(F.col("size") > 0, F.filter(middles, lambda m: m <= F.col("target")))
    placed = placed.withColumn("_middles", F.coalesce(taken, F.array().cast("array<double>")))
    return placed.select(
        *[F.col("_row").getField(c).alias(c) for c in keep], "size", "source_size", "target",
        (F.size("_middles") * F.col("size")).alias("taken"),
        F.transform("_middles", lambda m: _position(m / F.col("target"), schedules))
        .alias("positions"))


def training_order(plan: DataFrame) -> DataFrame:
    """One row per copy that the mix takes, with its ``position``, range-sorted by it."""
    rest = [c for c in plan.columns if c != "positions"]
    return plan.select(*rest, F.explode("positions").alias("position")).orderBy("position", "doc_id")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][rk % 3 + 1] AS w, source_size * 2.0::DOUBLE AS cap FROM r),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                 - coalesce(sum(cap) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM w),
f AS (SELECT *, max(CASE WHEN lv * w <= cap THEN lv END) OVER () AS found FROM l),
t AS (SELECT source, source_size, least(cap, coalesce(found * w, cap)) AS target FROM f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target,
       (CASE WHEN size > 0 AND a + size / 2.0 <= target THEN size ELSE 0 END
        + CASE WHEN size > 0 AND source_size + a + size / 2.0 <= target THEN size ELSE 0 END)::BIGINT AS taken
FROM p
"""
