"""Spend validation in one pass: a single ``reject_reason`` column whose value
is the first failing check (NULL = passes).

Order of checks: mcc NULL -> transaction id NULL -> duplicate -> card type
not registered -> mcc not an integer -> currency NULL -> (excluded mcc:
accepted) -> currency not in rates or rate 0 -> date NULL -> date shape -> amount not
numeric. The rule engine adds merchant and reward-unit checks after these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed as X
from ..functions.parse import parse_amount, parse_int
from ..functions.text import map_literal
from ..schemas import CURRENCY_RATE, MONEY
from .joins import is_bounded, largest_group, small_side

#: rows of one duplicate key that are counted together in one task
MAX_TOGETHER = 1_000_000
#: hash slots that bound the rows of a key
SLOTS = 1 << 16


def card_type_lookup(card_types: DataFrame, tenant: str) -> DataFrame:
    """Tenant's card types, one id per name, so a duplicated name cannot multiply
    spend rows: the lowest id. ``duplicate_card_types`` lists such names."""
    return (card_types.where(F.col("tenant") == tenant)
            .groupBy("name").agg(F.min("id").alias("cardTypeId")))


def duplicate_card_types(card_types: DataFrame) -> DataFrame:
    """(tenant, name, ids) of names that a tenant has more than once; a caller that
    must not guess refuses the run when there are any."""
    return (card_types.groupBy("tenant", "name").agg(F.sort_array(F.collect_set("id")).alias("ids"))
            .where(F.size("ids") > 1))


def exclusion_keys(exclusions: DataFrame, tenant: str) -> DataFrame:
    return (exclusions.where(F.col("tenant") == tenant)
            .select(F.col("card_type_id").alias("_ex_ct"), F.col("mcc_mcc").alias("_ex_mcc"))
            .where(F.col("_ex_ct").isNotNull() & F.col("_ex_mcc").isNotNull())
            .distinct())


def _repeated(tx: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Keys seen more than once, with their ``count``."""
    return (tx.where(F.col("mcc").isNotNull() & F.col("transaction_id").isNotNull())
            .groupBy(*keys, *within).count()
            .where(F.col("count") > 1))


def duplicate_keys(tx: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once among rows with an mcc and a transaction id.

    Only the key columns are shuffled, after a map-side partial count, so a
    key holding a large share of the rows costs one row per map task."""
    return _repeated(tx, keys).select(*keys, F.lit(True).alias("_dup"))


def _repeated_by_slot(tx: DataFrame, keys: Sequence[str], max_broadcast_rows: int | None = None,
                      cache: list | None = None, within: Sequence[str] = ()) -> DataFrame:
    """``_repeated``, but hash slots are counted first."""
    kw = {} if max_broadcast_rows is None else {"max_rows": max_broadcast_rows}
    able = tx.where(F.col("mcc").isNotNull() & F.col("transaction_id").isNotNull())
    slot = F.xxhash64(*keys)
    hit = able.groupBy(slot.alias("_slot"), *within).count().where(F.col("count") > 1).select("_slot")
    if cache is not None:
        hit = hit.persist(StorageLevel.MEMORY_AND_DISK)
        cache.append(hit)
    if not is_bounded(hit, **kw):
        return _repeated(tx, keys, within)
    named = able.select(*dict.fromkeys([*keys, *within, "mcc", "transaction_id"]))
    return _repeated(named.join(F.broadcast(hit), slot == F.col("_slot"), "left_semi"), keys, within)


def duplicate_keys_by_slot(tx: DataFrame, keys: Sequence[str], max_broadcast_rows: int | None = None,
                           cache: list | None = None) -> DataFrame:
    """``duplicate_keys`` without shuffling every key: a first pass shuffles one 64-bit
    hash slot per key (partially counted), and only the keys of slots hit twice or
    more are shuffled and counted in full. Equal keys share a slot, so none is lost,
    and the full count tells them from keys that only share a slot.

    For keys wider than a number (long ids, a file path beside the id) that are mostly
    unique. When too many slots are hit twice to broadcast, the keys are counted at
    once as ``duplicate_keys`` does. ``cache``: as in ``validate_spend``.
    """
    return _repeated_by_slot(tx, keys, max_broadcast_rows, cache).select(*keys, F.lit(True).alias("_dup"))


def with_duplicates(tx: DataFrame, dups: DataFrame, keys: Sequence[str], bounded: bool) -> DataFrame:
    """Add ``_dup`` from the duplicate keys, which are broadcast when ``bounded``.

    Past the bounds the rows are shuffled by key, once and in one read of ``tx``. Rows
    without an id or an mcc can match no key; so that they do not all meet in one
    partition they go by other columns."""
    if bounded:
        return tx.join(small_side(dups, bounded=True), keys, "left")
    open_ = F.col("mcc").isNotNull() & F.col("transaction_id").isNotNull()
    other = F.pmod(F.xxhash64("transaction_date", "amount", "currency"), F.lit(1 << 16)).cast("int") + 1
    place = F.when(open_, F.lit(0)).otherwise(other)
    # always 0, but no literal, which would drop out of the join's keys
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    return tx.withColumn("_place", place).join(dups.withColumn("_place", zero), [*keys, "_place"], "left").drop("_place")


def with_counted_duplicates(tx: DataFrame, keys: Sequence[str], within: Sequence[str],
                            slots: bool = False) -> DataFrame:
    """Add ``_dup`` by counting each key among the rows, without a table of keys: where the
    rows lie by ``within`` already (the join that made them was by it) nothing is
    shuffled. The rows of one key meet in one task, which spills when they are many.
    ``slots``: rows are sorted and counted by the hash slot of their key, and by the key
    within a slot."""
    open_ = F.col("mcc").isNotNull()
    for key in keys:
        open_ = open_ & F.col(key).isNotNull()
    n = F.count(F.lit(1))
    if not slots:
        return tx.withColumn("_dup", open_ & (n.over(Window.partitionBy(*within, *keys, open_)) > 1))
    # the counts share one sort, by slot before key
    x = tx.withColumns({"_slot": F.xxhash64(*keys), "_open": open_})
    x = x.withColumn("_met", n.over(Window.partitionBy(*within, "_slot", "_open", *keys)))
    x = x.withColumn("_hits", n.over(Window.partitionBy(*within, "_slot", "_open")))
    return x.withColumn("_dup", F.col("_open") & (F.col("_hits") > 1) & (F.col("_met") > 1)).drop(
        "_slot", "_open", "_met", "_hits")


def may_crowd(rows: DataFrame, keys: Sequence[str], most: int | None = None) -> bool:
    """False when no key has more than ``most`` rows (``MAX_TOGETHER``), by the rows of its
    hash slot, which are at least its own. Each task hands on one count a slot, so what is
    shuffled does not grow with the keys."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS))
    return largest_group(rows, slot) > (MAX_TOGETHER if most is None else most)


def rate_lookup(currency: Column, rates: dict | None) -> Column:
    """Conversion rate for ``upper(currency)`` from a small literal map."""
    rates = X.CURRENCY_RATES if rates is None else rates
    lit_map = map_literal({k.upper(): str(v) for k, v in rates.items()})
    return F.try_element_at(lit_map, F.upper(currency)).try_cast(CURRENCY_RATE)


def with_rate_table(x: DataFrame, rates: DataFrame, **kw) -> DataFrame:
    """Add ``_rate`` from a (currency, rate) table, matched on the upper-cased
    currency (one rate per currency: the first by value if repeated)."""
    r = (rates.select(F.upper(F.col("currency")).alias("_rcur"), F.col("rate").try_cast(CURRENCY_RATE).alias("_r"))
         .where(F.col("_rcur").isNotNull()).groupBy("_rcur").agg(F.min("_r").alias("_rate")))
    return (x.join(small_side(r, source=rates, **kw), F.upper(F.col("currency")) == F.col("_rcur"),
                   "left").drop("_rcur"))


def validate_spend(tx: DataFrame, card_types: DataFrame, exclusions: DataFrame, tenant: str,
                   rates: dict | DataFrame | None = None, scope: Sequence[str] = (),
                   max_broadcast_rows: int | None = None,
                   cache: list | None = None, duplicates: str = "keys",
                   within: Sequence[str] = (), counted: bool = False) -> DataFrame:
    """Add cardTypeId, mcc_int, amount_num, rate, is_foreign, excluded and
    reject_reason to the spend rows. No row is dropped.

    ``rates`` is a dict (a map literal) or a (currency, rate) table (a
    size-checked broadcast join). ``scope`` adds columns to the duplicate
    key (e.g. ``source_file`` when each file is its own run). With a ``cache`` list the duplicate keys are
    persisted (and appended to it for the caller to unpersist), so their size
    check and the join share one aggregation. ``duplicates``: 'keys' counts every key,
    'slots' counts hash slots first (``duplicate_keys_by_slot``).

    ``within`` names columns that rows with equal duplicate keys have in common, and by which
    the rows were joined last, such as the order of a line; they are not in the result.
    Duplicate keys past the broadcast bounds are then counted where the rows lie
    (``with_counted_duplicates``) instead of joined to them, unless a key has more than
    ``MAX_TOGETHER`` rows. ``counted``: they are counted there at once, without looking for
    the keys first; for rows that a shuffle join has laid by ``within``, and of which the
    caller knows that no key is crowded (``may_crowd``)."""
    if duplicates not in ("keys", "slots"):
        raise ValueError(f"unknown duplicates {duplicates!r}")
    kw = {} if max_broadcast_rows is None else {"max_rows": max_broadcast_rows}
    keys, held = [*scope, "transaction_id"], len(cache or ())
    slots = duplicates == "slots"
    if counted and within:
        x = with_counted_duplicates(tx, keys, within, slots)
    else:
        found = _repeated_by_slot(tx, keys, max_broadcast_rows, cache, within) if slots else _repeated(tx, keys, within)
        if cache is not None:
            found = found.persist(StorageLevel.MEMORY_AND_DISK)
            cache.append(found)
        dups = found.select(*keys, F.lit(True).alias("_dup"))
        bounded = is_bounded(dups, **kw)
        if bounded or not within or (found.agg(F.max("count")).first()[0] or 0) > MAX_TOGETHER:
            x = with_duplicates(tx, dups, keys, bounded)
        else:
            x = with_counted_duplicates(tx, keys, within)
            while len(cache or ()) > held:
                cache.pop().unpersist()  # the keys are not read again

    ct = card_type_lookup(card_types, tenant)
    x = (x.join(small_side(ct, source=card_types, **kw), x.card_type == ct.name, "left")
          .drop("name").withColumn("mcc_int", parse_int("mcc")))
    ex = exclusion_keys(exclusions, tenant)
    x = x.join(small_side(ex, source=exclusions, **kw),
               (F.col("cardTypeId") == F.col("_ex_ct")) & (F.col("mcc_int") == F.col("_ex_mcc")),
               "left")

    cur, date = F.col("currency"), F.col("transaction_date")
    if isinstance(rates, DataFrame):
        x = with_rate_table(x, rates, **kw)
        rate = F.col("_rate")
    else:
        rate = rate_lookup(cur, rates)
    x = x.select(
        *[F.col(c) for c in tx.columns if c not in within],
        F.col("cardTypeId"), F.col("mcc_int"),
        parse_amount("amount").alias("amount_num"),
        rate.alias("rate"),
        (cur != X.HOME_CURRENCY).alias("is_foreign"),
        F.col("_ex_ct").isNotNull().alias("excluded"),
        F.coalesce(F.col("_dup"), F.lit(False)).alias("_dup"),
    )
    before = F.coalesce(
        F.when(F.col("mcc").isNull(), X.R_MCC_EMPTY),
        F.when(F.col("transaction_id").isNull(), X.R_TXID_EMPTY),
        F.when(F.col("_dup"), X.R_DUPLICATE),
        F.when(F.col("cardTypeId").isNull(), X.R_CARD_TYPE),
        F.when(F.col("mcc_int").isNull(), X.R_ERROR + "mcc"),
        F.when(cur.isNull(), X.R_ERROR + "currency"),
    )
    after = F.coalesce(
        F.when(F.coalesce(F.col("rate"), F.lit(0)) == 0, F.concat(cur, F.lit(X.R_NOT_IN_RATES))),
        F.when(date.isNull(), X.R_ERROR + "transaction_date"),
        F.when(~date.contains("-"), F.concat(F.lit(X.R_DATE_SHAPE), date)),
        F.when(F.col("amount_num").isNull(), X.R_ERROR + "amount"),
    )
    reason = F.coalesce(before, F.when(~F.col("excluded"), after))
    return (x.withColumn("reject_reason", reason)
             .withColumn("excluded", F.col("excluded") & before.isNull())
             .drop("_dup"))


def converted_amount(amount_num: Column, rate: Column, is_foreign: Column) -> Column:
    """amount x rate, NULL when it does not fit; foreign amounts rounded to whole
    units, half to even, from the unrounded product."""
    conv = F.try_multiply(amount_num, rate)
    return F.when(is_foreign, F.bround(conv, 0)).otherwise(conv).try_cast(MONEY)
