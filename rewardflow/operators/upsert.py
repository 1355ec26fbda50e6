"""Set-based merges into existing tables (K2-K6, J3, J8).

A source row whose key has a NULL can never match and is rejected before
the merge with a reason, instead of failing row by row. Running a merge a
second time with the same source changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed as X
from .ids import assign_ids
from .joins import DEFAULT_MAX_BROADCAST_ROWS, is_bounded, small_side


def _any(cs: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cs)


def _all(cs: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cs)


def split_null_keys(src: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key set, rows with a NULL key + ``reject_reason``)."""
    keys = list(keys)
    bad = _any([F.col(k).isNull() for k in keys])
    reason = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(f"{k} is empty!")) for k in keys])
    return src.where(~bad), src.where(bad).withColumn("reject_reason", reason)


def _held(source: DataFrame, cache: list | None) -> DataFrame:
    """Persist a (small) source used several times; the caller unpersists
    what is appended to ``cache``."""
    if cache is None:
        return source
    source = source.persist(StorageLevel.MEMORY_AND_DISK)
    cache.append(source)
    return source


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update: Sequence[str], max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 cache: list | None = None, changed_only: bool = False) -> DataFrame:
    """INSERT ... ON DUPLICATE KEY UPDATE, set-based.

    Matched rows take ``update`` columns from the source (a NULL there is
    written too) and keep the rest; unmatched target rows stay; unmatched
    source rows are inserted (columns the source lacks are NULL). Both sides
    must be unique on ``keys`` and the source free of NULL keys.

    A source within the broadcast bound (a user file against a large table)
    is broadcast: one pass over the target updates the matched rows and a
    semi-join pass finds which source keys exist, so the target is never
    shuffled. A larger source is merged with one full outer join. With a
    ``cache`` list the source is persisted once for its several uses.
    ``changed_only`` returns the matched and inserted rows alone, as merged.
    """
    keys, update = list(keys), list(update)
    source = _held(source, cache)
    have = set(source.columns)
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in target.columns if c in have],
                      F.lit(True).alias("_s_hit"))
    on = _all([F.col(k) == F.col(f"_s_{k}") for k in keys])

    def pick(c: str, in_t: Column, in_s: Column) -> Column:
        sc = F.col(f"_s_{c}") if c in have else F.lit(None).cast(target.schema[c].dataType)
        if c in update:
            return F.when(in_s, sc).otherwise(F.col(c)).alias(c)
        return F.when(in_t, F.col(c)).otherwise(sc).alias(c)

    if is_bounded(source, max_broadcast_rows):
        hit = F.col("_s_hit").isNotNull()
        updated = (target.join(F.broadcast(s), on, "inner" if changed_only else "left")
                   .select(*[pick(c, F.lit(True), hit) for c in target.columns]))
        return updated.unionByName(_absent(target, source, keys, bounded=True)
                                   .select(*[F.col(c) if c in have else
                                             F.lit(None).cast(target.schema[c].dataType).alias(c)
                                             for c in target.columns]))
    t = target.withColumn("_t_hit", F.lit(True))
    j = t.join(s, on, "right" if changed_only else "full_outer")
    in_t, in_s = F.col("_t_hit").isNotNull(), F.col("_s_hit").isNotNull()
    return j.select(*[pick(c, in_t, in_s) for c in target.columns])


def _absent(target: DataFrame, source: DataFrame, keys: list[str], bounded: bool) -> DataFrame:
    """Source rows whose key is not in the target. A bounded source is
    checked with a semi-join of the target against the broadcast source
    keys (the target is scanned, not shuffled)."""
    if not bounded:
        return source.join(target.select(*keys).distinct(), keys, "left_anti")
    src_keys = source.select(*keys).distinct()
    present = target.select(*keys).join(F.broadcast(src_keys), keys, "left_semi").distinct()
    return source.join(F.broadcast(present), keys, "left_anti")


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str],
             max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
             cache: list | None = None) -> DataFrame:
    """Source rows whose key is not in the target."""
    source = _held(source, cache)
    return _absent(target, source, list(keys), is_bounded(source, max_broadcast_rows))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str],
                     id_col: str | None = None, cache: list | None = None,
                     changed_only: bool = False) -> DataFrame:
    """Target plus the source rows with unseen keys (``changed_only``: these alone).
    With ``id_col`` the new rows get ids after the target's largest, in key order."""
    new = new_rows(target, source, keys, cache=cache)
    if id_col is not None:
        top = target.agg(F.max(id_col)).first()[0] or 0
        new = assign_ids(new, id_col, keys, start=int(top))
    base = target.limit(0) if changed_only else target
    return base.unionByName(new.select(*[c for c in target.columns if c in new.columns]),
                            allowMissingColumns=True)


def resolve_card_type_id(src: DataFrame, card_types: DataFrame, name_col: str = "card_type",
                         tenant_col: str = "TENANT") -> tuple[DataFrame, DataFrame]:
    """Look up ``card_type_id`` by (name, tenant) in the card-type table
    (after new types were inserted). Returns (resolved, rejects)."""
    ct = (card_types.select(F.col("id").alias("card_type_id"), F.col("name").alias("_ct_name"),
                            F.col("tenant").alias("_ct_tenant"))
          .groupBy("_ct_name", "_ct_tenant").agg(F.min("card_type_id").alias("card_type_id")))
    j = src.join(small_side(ct, source=card_types), (F.col(name_col) == F.col("_ct_name"))
                 & (F.col(tenant_col) == F.col("_ct_tenant")), "left").drop("_ct_name", "_ct_tenant")
    return (j.where(F.col("card_type_id").isNotNull()),
            j.where(F.col("card_type_id").isNull()).withColumn("reject_reason", F.lit(X.R_NO_CARD_TYPE_ID)))
