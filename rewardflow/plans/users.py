"""C2: the users job - split a user file into four tables and merge them.

The card-type insert (K4) feeds the foreign-key lookup (J3) as a DataFrame
dependency, not through a side effect, so the lookup always sees the new
types. ``write_users_run`` writes the card-type table first and reads it
back, which also cuts the lineage before the last merge.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.onboard import UserTables, split_users  # noqa: F401
from ..operators.upsert import (insert_if_absent, merge_upsert, resolve_card_type_id,
                                split_null_keys)


def customer_source(parts: UserTables) -> DataFrame:
    return parts.customers.select(F.col("id").alias("customer_id"), "email",
                                  F.col("TENANT").alias("tenant"))


def card_source(parts: UserTables) -> DataFrame:
    return parts.cards.select("card_id", "card_type", F.col("REWARD_TYPE").alias("reward_type"),
                              F.col("TENANT").alias("tenant"), F.col("id").alias("customer_id"))


def card_type_source(parts: UserTables) -> DataFrame:
    return parts.card_types.select(F.col("card_type").alias("name"), F.col("TENANT").alias("tenant"))


def campaign_customer_source(parts: UserTables, card_types: DataFrame) -> tuple[DataFrame, DataFrame]:
    resolved, no_type = resolve_card_type_id(parts.campaign_customers, card_types)
    src = resolved.select("email", "name", F.col("phone").alias("phone_number"), "card_type_id",
                          "card_type", F.col("TENANT").alias("tenant"))
    return src, no_type


#: every source column of the four tables, so a dead letter can be replayed
REJECT_COLUMNS = ("customer_id", "email", "name", "phone_number", "card_id", "card_type",
                  "card_type_id", "reward_type", "tenant")


def _rejects(table: str, df: DataFrame, **named: str) -> DataFrame:
    """Rejected rows in full; ``named``: columns that the source calls otherwise."""
    of = {c: named.get(c, c) for c in REJECT_COLUMNS}
    return df.select(F.lit(table).alias("table_name"), F.col("reject_reason"), *[
        (F.col(s) if s in df.columns else F.lit(None)).cast("string").alias(c) for c, s in of.items()])


class UsersRun:
    """The merged tables of one user file, each built on first use, so a
    caller that needs one table pays only for the checks and joins of that
    table (and of what it depends on)."""

    def __init__(self, users: DataFrame, tenant: str, targets: dict[str, DataFrame],
                 reward_types: dict | None = None, card_types: DataFrame | None = None,
                 cache: list | None = None, order: Sequence[str] = (), keep: str = "first",
                 parts: UserTables | None = None, changed_only: bool = False):
        self.changed_only = changed_only
        self.parts = parts or split_users(users, tenant, reward_types, order, cache, keep)
        self.targets = targets
        self.cache = cache
        self._card_types = card_types

    @cached_property
    def _customer_src(self):
        return split_null_keys(customer_source(self.parts), ["customer_id", "tenant"])

    @cached_property
    def _card_src(self):
        return split_null_keys(card_source(self.parts), ["card_id", "tenant"])

    @cached_property
    def _card_type_src(self):
        return split_null_keys(card_type_source(self.parts), ["name", "tenant"])

    @cached_property
    def _campaign_src(self):
        src, no_type = campaign_customer_source(self.parts, self.card_types)
        ok, null_key = split_null_keys(src, ["card_type_id", "name"])
        return ok, no_type, null_key

    @cached_property
    def customers(self) -> DataFrame:
        return merge_upsert(self.targets["card_customers"], self._customer_src[0],
                            ["customer_id", "tenant"], ["email"], cache=self.cache,
                            changed_only=self.changed_only)

    @cached_property
    def cards(self) -> DataFrame:
        return merge_upsert(self.targets["cards"], self._card_src[0], ["card_id", "tenant"],
                            ["card_type", "reward_type", "customer_id"], cache=self.cache,
                            changed_only=self.changed_only)

    @cached_property
    def card_types(self) -> DataFrame:
        if self._card_types is not None:
            return self._card_types
        return insert_if_absent(self.targets["card_types"], self._card_type_src[0],
                                ["name", "tenant"], id_col="id", cache=self.cache)

    @cached_property
    def campaign_customers(self) -> DataFrame:
        return merge_upsert(self.targets["campaign_customers"], self._campaign_src[0],
                            ["card_type_id", "name"], ["email", "phone_number"], cache=self.cache,
                            changed_only=self.changed_only)

    @cached_property
    def rejects(self) -> DataFrame:
        _, no_type, null_key = self._campaign_src
        return (_rejects("card_customer", self._customer_src[1])
                .unionByName(_rejects("card", self._card_src[1]))
                .unionByName(_rejects("card_type", self._card_type_src[1], card_type="name", name="card_type"))
                .unionByName(_rejects("campaign_customer", no_type, phone_number="phone", tenant="TENANT"))
                .unionByName(_rejects("campaign_customer", null_key)))


def users_run(users: DataFrame, tenant: str, targets: dict[str, DataFrame],
              reward_types: dict | None = None, card_types: DataFrame | None = None,
              cache: list | None = None, order: Sequence[str] = (),
              keep: str = "first") -> UsersRun:
    """Merged tables. ``targets`` holds the current ``card_customers``,
    ``cards``, ``card_types`` and ``campaign_customers`` tables.
    ``card_types`` may pass an already-written K4 result. Sources persisted
    on the way are appended to ``cache`` for the caller to unpersist."""
    return UsersRun(users, tenant, targets, reward_types, card_types, cache, order, keep)


def _same_place(file: str, folder: str) -> bool:
    """``file`` lies below ``folder``; both may or may not carry a scheme."""
    bare = [re.sub(r"^file:/+", "/", p) for p in (file, folder)]
    return bare[0].startswith(bare[1].rstrip("/") + "/")


def write_users_run(spark: SparkSession, users: DataFrame, tenant: str,
                    targets: dict[str, DataFrame], out_dir: str,
                    reward_types: dict | None = None, order: Sequence[str] = (),
                    keep: str = "first", changed_only: bool = False) -> dict[str, str]:
    """Write the four new tables (``changed_only``: their changed and inserted rows)
    and the rejects as parquet under ``out_dir``. The
    user rows are persisted once for all of them. The card-type table is written
    first and read back before the campaign-customer merge uses it. ``out_dir`` must
    not hold a table that ``targets`` reads."""
    out = out_dir.rstrip("/")
    for df in targets.values():
        if any(_same_place(f, out) for f in df.inputFiles()):
            raise ValueError(f"{out} holds target tables that are being read")
    held: list = []
    try:
        parts = split_users(users, tenant, reward_types, order, held, keep)
        ok3, _ = split_null_keys(card_type_source(parts), ["name", "tenant"])
        (insert_if_absent(targets["card_types"], ok3, ["name", "tenant"], id_col="id", cache=held,
                          changed_only=changed_only)
         .write.mode("overwrite").parquet(f"{out}/card_type"))
        ct = spark.read.parquet(f"{out}/card_type")
        if changed_only:
            ct = targets["card_types"].unionByName(ct)
        run = UsersRun(users, tenant, targets, reward_types, ct, held, parts=parts,
                       changed_only=changed_only)
        paths = {"card_type": f"{out}/card_type"}
        for name, df in (("card_customer", run.customers), ("card", run.cards),
                         ("campaign_customer", run.campaign_customers), ("rejects", run.rejects)):
            df.write.mode("overwrite").parquet(f"{out}/{name}")
            paths[name] = f"{out}/{name}"
        return paths
    finally:
        for df in held:
            df.unpersist()
