"""The reward rule engine as native expressions.

Three tiers run in order - base (title 'base'), category (title
'category') and campaign (any rule with an end date) - each taking the best
positive rate among the card type's active rules whose conditions hold:

* foreign-only rules need a foreign row (NULL/false: no constraint);
* the minimum spend is compared with the *running* amount;
* the rule merchant is a case-insensitive substring of the row merchant
  (NULL or '' matches any);
* a custom category label must be among the labels of the patterns that
  match the row merchant under the row's mcc (label match is exact).

A matched tier multiplies the running amount by its rate and the product is
that tier's reward, so the amount compounds: base = A*r1, category =
A*r1*r2, campaign = A*r1*r2*r3. Unmatched tiers give 0 and keep the amount.

Two physical forms. ``array`` (default): the rules of each card type are
grouped into one array per tier and broadcast after a size check, and every tier
is an ``aggregate`` over its array - no shuffle of the spend rows. ``join``: for
rule sets too large for that, the accepted rows are joined once to the rules
whose conditions other than the minimum spend hold, the distinct (minimum, rate)
pairs of each tier are gathered per row by one grouping on the row's key, and the
tiers are evaluated on those. Rejected rows take no part in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed as X
from ..functions.text import tier_remark, unit_for
from ..schemas import MONEY, MONEY_OUT, RATE
from .joins import DEFAULT_MAX_BROADCAST_ROWS, is_bounded, largest_group, small_side
from .substring import substring_matches
from .validate import converted_amount

TIER_FLAGS = ("tb", "tc", "tp")
_TIER_COLUMNS = ("r1", "a1", "r2", "a2", "r3", "a3")
#: rules of a card type, or patterns of an mcc, that are walked as an array
MAX_ARRAY = 1_000
SALTS = 32


def tier_rules(rules: DataFrame) -> DataFrame:
    """Active rules of the three tiers, normalised; zero/negative/NULL rates
    can never win and are left out."""
    title = F.col("title")
    return (rules.where(F.col("is_active") == F.lit(True))
            .select(
                F.col("card_type_id").alias("_r_ct"),
                F.coalesce(title == "base", F.lit(False)).alias("tb"),
                F.coalesce(title == "category", F.lit(False)).alias("tc"),
                F.col("end_date").isNotNull().alias("tp"),
                F.coalesce(F.col("is_foreign"), F.lit(False)).alias("fo"),
                F.coalesce(F.col("min_dollar_spent").cast(MONEY), F.lit(0).cast(MONEY)).alias("mn"),
                F.upper(F.col("merchant")).alias("mu"),
                F.col("custom_category_name").alias("cat"),
                F.col("reward_rate").cast(RATE).alias("rate"))
            .where((F.col("tb") | F.col("tc") | F.col("tp")) & F.col("_r_ct").isNotNull()))


def rules_by_card_type(rules: DataFrame) -> DataFrame:
    """One row per card type: ``_tb``, ``_tc``, ``_tp`` arrays of its base,
    category and campaign rules, and ``_needs_merchant`` (a rule tests the
    merchant text)."""
    rule = F.struct("fo", "mn", "mu", "cat", "rate")
    # collect_list skips the NULLs of other tiers' rules and of rates that cannot win
    return tier_rules(rules).groupBy("_r_ct").agg(
        *[F.collect_list(F.when(F.col(f) & (F.col("rate") > 0), rule)).alias(f"_{f}")
          for f in TIER_FLAGS],
        F.max(F.col("mu").isNotNull() | F.col("cat").isNotNull()).alias("_needs_merchant"))


def frontier_rules(rules: DataFrame) -> DataFrame:
    """The rules that can still win: a rule goes when another of its card type and tier has a
    rate at least as high, a minimum at least as low and no stricter condition (the same
    one, or none where it has one), as then that one holds whenever it does. One row per
    rule and tier, in the columns of ``tier_rules``.

    Equal conditions and rates are grouped first (partially aggregated), so a window sorts
    one row per different rate of a condition, not the rules.
    """
    of = ["_r_ct", "tier", "fo", "mu", "cat"]
    tier = F.array_compact(F.array(*[F.when(F.col(f), F.lit(i)) for i, f in enumerate(TIER_FLAGS)]))
    best = (tier_rules(rules).where(F.col("rate") > 0).withColumn("tier", F.explode(tier))
            .groupBy(*of, "rate").agg(F.min("mn").alias("mn")))
    lower = Window.partitionBy(*of).orderBy("mn", F.col("rate").desc())
    ahead = F.max("rate").over(lower.rowsBetween(Window.unboundedPreceding, -1))
    own = best.withColumn("_ahead", ahead).where("_ahead is null or rate > _ahead").drop("_ahead")
    me = F.struct(*of, "mn", "rate")
    # every rule asks the conditions looser than its own for a rate as high at its minimum
    looser = F.explode(F.array_distinct(F.array(*[
        F.struct((F.lit(False) if a else F.col("fo")).alias("fo"), (F.lit(None).cast("string") if b else F.col("mu")).alias("mu"),
                 (F.lit(None).cast("string") if c else F.col("cat")).alias("cat"))
        for a in (0, 1) for b in (0, 1) for c in (0, 1)])))
    asks = (own.select("_r_ct", "tier", "mn", "rate", me.alias("me"), F.struct("fo", "mu", "cat").alias("mine"),
                       looser.alias("at")).where("at <> mine")
            .select("_r_ct", "tier", "at.fo", "at.mu", "at.cat", "mn", "rate", "me"))
    offers = own.select(*of, "mn", "rate", F.lit(None).cast(asks.schema["me"].dataType).alias("me"))
    upto = Window.partitionBy(*of).orderBy("mn", F.col("me").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    beaten = (offers.unionByName(asks)
              .withColumn("_best", F.max(F.when(F.col("me").isNull(), F.col("rate"))).over(upto))
              .where("me is not null and _best >= rate").select("me").distinct())
    left = own.withColumn("me", me).join(beaten, "me", "left_anti")
    return left.select("_r_ct", *[(F.col("tier") == i).alias(f) for i, f in enumerate(TIER_FLAGS)],
                       "fo", "mn", "mu", "cat", "rate")


def frontier_by_card_type(frontier: DataFrame, rules: DataFrame) -> DataFrame:
    """``rules_by_card_type`` with the frontier's rules in the arrays."""
    rule = F.struct("fo", "mn", "mu", "cat", "rate")
    arrays = frontier.groupBy("_r_ct").agg(*[F.collect_list(F.when(F.col(f), rule)).alias(f"_{f}") for f in TIER_FLAGS])
    needs = tier_rules(rules).groupBy("_r_ct").agg(
        F.max(F.col("mu").isNotNull() | F.col("cat").isNotNull()).alias("_needs_merchant"))
    return needs.join(arrays, "_r_ct", "left")


def patterns_by_mcc(categories: DataFrame) -> DataFrame:
    """One row per mcc: the (upper-cased pattern, label) pairs of that mcc."""
    return (categories.where(F.col("name").isNotNull() & F.col("mcc").isNotNull())
            .groupBy(F.col("mcc").alias("_p_mcc"))
            .agg(F.collect_list(F.struct(F.upper(F.col("name")).alias("pu"),
                                         F.col("merchant").alias("label"))).alias("_pats")))


def _holds(fo: Column, mu: Column, cat: Column, is_foreign: Column, merchant_u: Column,
           cats: Column) -> Column:
    """The conditions that do not depend on the running amount."""
    return ((~fo | is_foreign) & (mu.isNull() | merchant_u.contains(mu))
            & (cat.isNull() | F.array_contains(cats, cat)))


def _compound(a: Column, rate: Column) -> Column:
    return F.try_multiply(a, F.coalesce(rate, F.lit(1).cast(RATE))).try_cast(MONEY)


def _tiers(x: DataFrame, ok: Column, holds) -> DataFrame:
    """r1..r3 (best rate that holds) and a1..a3 (running amount after it) from the
    arrays ``_tb``, ``_tc``, ``_tp``. They leave through a generator, so a filter on
    what is derived from them cannot be pushed below and evaluate the tiers again."""
    columns, prev = x.columns, "a0"
    for i, flag in enumerate(TIER_FLAGS, start=1):
        a = F.col(prev)
        best = F.aggregate(
            F.coalesce(F.col(f"_{flag}"), F.array()), F.lit(None).cast(RATE),
            lambda acc, r: F.when(holds(r) & (r["mn"] <= a) & (acc.isNull() | (r["rate"] > acc)),
                                  r["rate"]).otherwise(acc))
        x = x.withColumn(f"r{i}", F.when(ok, best))
        x = x.withColumn(f"a{i}", _compound(a, F.col(f"r{i}")))
        prev = f"a{i}"
    keep = [c for c in columns if c not in ("_tb", "_tc", "_tp", "_pats", "_cats")]
    return x.select(*keep, F.inline(F.array(F.struct("r1", "a1", "r2", "a2", "r3", "a3"))))


def apply_rules(validated: DataFrame, rules: DataFrame, categories: DataFrame,
                form: str = "auto", key: Sequence[str] = ("transaction_id",),
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                max_array: int = MAX_ARRAY, cache: list | None = None) -> DataFrame:
    """Rewards, remarks and the final ``reject_reason`` for validated rows.

    ``form`` is 'join', or 'array' or 'auto', which take the array form when rules
    and category patterns are within the broadcast bounds and no card type has more
    than ``max_array`` rules (no mcc more patterns). Larger rule sets are cut to the
    rules that can win (``frontier_rules``) and take the array form if those are few
    enough, and the join form otherwise.
    ``key`` must identify accepted rows (transaction id, plus the file for per-file
    runs). With a ``cache`` list the rules and categories, and the join form's input,
    are persisted once (appended to the list for the caller to unpersist).
    """
    if form not in ("auto", "array", "join"):
        raise ValueError(f"unknown form {form!r}")
    if cache is not None:
        rules, categories = (d.persist(StorageLevel.MEMORY_AND_DISK) for d in (rules, categories))
        cache += [rules, categories]
    rules_small = is_bounded(rules, max_broadcast_rows)
    cats_small = (is_bounded(categories, max_broadcast_rows)
                  and largest_group(categories, "mcc") <= max_array)
    arrays = (form != "join" and rules_small and cats_small
              and largest_group(rules, "card_type_id") <= max_array)
    frontier = None
    if form != "join" and cats_small and not arrays:
        # too many rules for arrays as they are: try those that can win
        frontier = frontier_rules(rules)
        if cache is not None:
            frontier = frontier.persist(StorageLevel.MEMORY_AND_DISK)
            cache.append(frontier)
        arrays = is_bounded(frontier, max_broadcast_rows) and largest_group(frontier, "_r_ct") <= max_array
    x = validated
    mu = F.upper(F.col("merchant"))
    ok = F.col("reject_reason").isNull() & ~F.col("excluded")
    if cats_small:
        # per-mcc pattern arrays only for a bounded category table
        pats = patterns_by_mcc(categories)
        x = x.join(small_side(pats, bounded=True), F.col("mcc_int") == F.col("_p_mcc"), "left").drop("_p_mcc")
        cats = F.transform(F.filter(F.coalesce(F.col("_pats"), F.array()),
                                    lambda p: mu.contains(p["pu"])), lambda p: p["label"])
    else:
        cats = F.lit(None).cast("array<string>")
    x = x.select("*", F.when(ok, converted_amount(F.col("amount_num"), F.col("rate"),
                                                   F.col("is_foreign"))).alias("a0"),
                 F.when(ok, cats).alias("_cats"))
    if arrays:
        # grouping per card type adds no rows: the rule count bounds it
        by_type = rules_by_card_type(rules) if frontier is None else frontier_by_card_type(frontier, rules)
        x = x.join(small_side(by_type, bounded=True),
                   F.col("cardTypeId") == F.col("_r_ct"), "left").drop("_r_ct")
        x = _tiers(x, ok, lambda r: _holds(r["fo"], r["mu"], r["cat"], F.col("is_foreign"), mu,
                                           F.col("_cats")))
    else:
        if cache is not None:
            x = x.persist(StorageLevel.MEMORY_AND_DISK)
            cache.append(x)
        x = _tiers_by_join(x, rules, list(key), mu, ok, rules_small, None if cats_small else categories)
    return _finish(x, validated.columns)


def _tiers_by_join(x: DataFrame, rules: DataFrame, key: list[str], mu: Column, ok: Column,
                   rules_small: bool, categories: DataFrame | None = None) -> DataFrame:
    """Join form: one join of the accepted rows to the rules, one grouping by key.

    Rules too many to broadcast are joined by (card type, salt): every card type's
    rows are dealt over ``SALTS`` tasks and its rules repeated for each, as there are
    few card types. With ``categories`` (a table too big to broadcast) the labels of
    each different (mcc, merchant) are found by an inverted join on q-grams and a
    rule's category is a semi-join on (mcc, merchant, label), instead of a per-row
    label array."""
    t = tier_rules(rules)
    live = x.where(ok)
    salts = 1 if rules_small else SALTS
    probe = live.select(*key, F.col("cardTypeId").alias("_pct"), F.col("is_foreign").alias("_pfo"),
                        F.col("mcc_int").alias("_pmcc"), mu.alias("_mu"), F.col("_cats").alias("_pcats"),
                        F.pmod(F.xxhash64(*key), F.lit(salts)).alias("_ps"))
    rt = t.where(F.col("rate") > 0).withColumnRenamed("mu", "_rmu").withColumn(
        "_rs", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cat = F.col("cat") if categories is None else F.lit(None).cast("string")
    on = (F.col("_pct") == F.col("_r_ct")) & (F.col("_ps") == F.col("_rs"))
    cand = probe.join(small_side(rt, bounded=rules_small), on & _holds(
        F.col("fo"), F.col("_rmu"), cat, F.col("_pfo"), F.col("_mu"), F.col("_pcats")), "inner")
    if categories is not None:
        cat_tab = categories.select(F.col("mcc").alias("_cm"), F.upper(F.col("name")).alias("pattern"),
                                    F.col("merchant").alias("_cl"))
        met = substring_matches(live.select(F.col("mcc_int").alias("_cm"), mu.alias("text")), cat_tab, ["_cm"])
        labels = met.join(cat_tab, ["_cm", "pattern"]).select("_cm", F.col("text").alias("_ct"), "_cl").distinct()
        cand = cand.where("cat is null").unionByName(cand.where("cat is not null").join(
            labels, (F.col("_cm") == F.col("_pmcc")) & (F.col("_ct") == F.col("_mu"))
            & (F.col("_cl") == F.col("cat")), "left_semi"))
    pair = F.struct("mn", "rate")
    none = F.lit(None).cast("struct<mn:decimal(24,6),rate:decimal(10,4)>")
    row = F.struct(*[F.col(c) for c in x.columns if c not in ("_pats", "_cats")])
    both = live.select(*key, row.alias("_row"), *[none.alias(f"_{f}") for f in TIER_FLAGS])
    empty = F.lit(None).cast(both.schema["_row"].dataType)
    both = both.unionByName(cand.select(*key, empty.alias("_row"),
                                        *[F.when(F.col(f), pair).alias(f"_{f}") for f in TIER_FLAGS]))
    met = both.groupBy(*key).agg(F.first("_row", ignorenulls=True).alias("_row"),
                                 *[F.collect_set(f"_{f}").alias(f"_{f}") for f in TIER_FLAGS])
    met = _tiers(met.select("_row.*", *[f"_{f}" for f in TIER_FLAGS]), F.lit(True), lambda r: F.lit(True))
    rest = x.where(~ok).select(*[c for c in met.columns if c not in _TIER_COLUMNS],
                               *[F.lit(None).cast(met.schema[c].dataType).alias(c) for c in _TIER_COLUMNS])
    needs = (t.where(F.col("mu").isNotNull() | F.col("cat").isNotNull())
             .select(F.col("_r_ct").alias("_nm_ct")).distinct()
             .withColumn("_nm", F.lit(True)))
    return (met.unionByName(rest).join(small_side(needs, bounded=rules_small),
                                       F.col("cardTypeId") == F.col("_nm_ct"), "left").drop("_nm_ct")
             .withColumn("_needs_merchant", F.coalesce(F.col("_nm"), F.lit(False))))


def _finish(x: DataFrame, base_cols: list[str]) -> DataFrame:
    ct = F.col("cardTypeId")
    unit = unit_for(ct)
    r1, r2, r3 = F.col("r1"), F.col("r2"), F.col("r3")
    matched = r1.isNotNull() | r2.isNotNull() | r3.isNotNull()
    ok = F.col("reject_reason").isNull() & ~F.col("excluded")
    # a product past the type's digits is NULL and rejects its row
    over = (F.col("a0").isNull() | (r1.isNotNull() & F.col("a1").isNull())
            | (r2.isNotNull() & F.col("a2").isNull()) | (r3.isNotNull() & F.col("a3").isNull()))
    reason = F.coalesce(
        F.col("reject_reason"),
        F.when(ok & F.col("merchant").isNull() & F.coalesce(F.col("_needs_merchant"), F.lit(False)),
               F.lit(X.R_ERROR + "merchant")),
        F.when(ok & over, F.lit(X.R_ERROR + "amount")),
        F.when(ok & unit.isNull() & matched, F.lit(X.R_ERROR + "reward unit")),
    )
    accepted = reason.isNull()
    zero = F.lit(0).cast(MONEY)
    excl = F.col("excluded")

    def reward(r: Column, a: str) -> Column:
        return (F.when(~accepted, F.lit(None).cast(MONEY)).when(excl, zero)
                 .when(r.isNotNull(), F.col(a)).otherwise(zero))

    remarks = [tier_remark(lbl, r, ct, unit) for lbl, r in zip(X.TIER_LABELS, (r1, r2, r3))]
    remark = (F.when(~accepted, F.lit(None).cast("string"))
               .when(excl, F.concat(F.lit(X.EXCLUSION_REMARK), F.col("mcc_int").cast("string")))
               .otherwise(F.concat(remarks[0], F.lit(","), remarks[1], F.lit(","),
                                   remarks[2], F.lit(","))))
    keep = [c for c in base_cols if c != "reject_reason"]
    return x.select(
        *keep,
        reason.alias("reject_reason"),
        F.col("a0").alias("amount_sgd"),
        F.when(accepted & ~excl, r1).alias("rate_base"),
        F.when(accepted & ~excl, r2).alias("rate_cat"),
        F.when(accepted & ~excl, r3).alias("rate_camp"),
        reward(r1, "a1").alias("rewardAmountBase"),
        reward(r2, "a2").alias("rewardAmountCat"),
        reward(r3, "a3").alias("rewardAmountCampaign"),
        F.when(accepted & ~excl, remarks[0]).alias("remark_base"),
        F.when(accepted & ~excl, remarks[1]).alias("remark_cat"),
        F.when(accepted & ~excl, remarks[2]).alias("remark_camp"),
        remark.alias("remark"),
    )


def round_money(c: Column) -> Column:
    return F.round(c, 2).try_cast(MONEY_OUT)
