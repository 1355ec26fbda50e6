"""User file -> normalised customer, card, card-type and campaign-customer
tables (P1-P4, A4)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed as X
from ..functions.text import map_literal


def prepare_users(users: DataFrame, tenant: str, reward_types: dict | None = None) -> DataFrame:
    """The columns that the tables need: ``name`` (NULL when either part is NULL),
    ``TENANT``, ``REWARD_TYPE`` by card type (case-sensitive; unknown -> NULL) and
    ``created_at`` to order by. The card number is left out."""
    m = map_literal(X.REWARD_TYPE_MAP if reward_types is None else reward_types)
    return users.select(
        "id", "email", "phone", "card_id", "card_type",
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("name"),
        F.lit(tenant).alias("TENANT"), F.try_element_at(m, F.col("card_type")).alias("REWARD_TYPE"),
        "created_at")


def dedupe(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
           order: Sequence[str] = (), keep: str = "first") -> DataFrame:
    """One row per key (NULL keys form one group), projected to ``cols``.

    The kept row is the smallest ('first') or largest ('last') by ``order``
    then by the other columns, so the winner is stable; a NULL loses against any
    value either way. It is a min/max of a struct per key: partial aggregation
    runs map-side, so a key holding a large share of the rows never collects its
    rows in one task.
    """
    keys, cols = list(keys), list(cols)
    rest = [c for c in cols if c not in keys]
    if not rest:
        return df.select(*cols).distinct()
    tie = list(order) + [c for c in rest if c not in order]
    pick = F.min if keep == "first" else F.max
    ranked = []
    for i, c in enumerate(tie):
        there = F.col(c).isNull() if keep == "first" else F.col(c).isNotNull()
        ranked += [there.alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
    w = df.groupBy(*keys).agg(pick(F.struct(*ranked)).alias("_w"))
    return w.select(*[F.col(k) for k in keys],
                    *[F.col(f"_w._o{tie.index(c)}").alias(c) for c in rest]).select(*cols)


@dataclass
class UserTables:
    customers: DataFrame           # card DB customer source (id, email, TENANT)
    cards: DataFrame               # card DB card source
    card_types: DataFrame          # campaign DB card type source (card_type, TENANT)
    campaign_customers: DataFrame  # campaign DB customer source


def split_users(users: DataFrame, tenant: str, reward_types: dict | None = None,
                order: Sequence[str] = (), cache: list | None = None,
                keep: str = "first") -> UserTables:
    """The four de-duplicated sources; ``order`` and ``keep`` as in ``dedupe``
    (``["created_at"]`` and ``"last"``: the latest row wins). With a ``cache`` list the prepared
    user rows are persisted once (appended for the caller to unpersist), so
    the file is read once for all four."""
    u = prepare_users(users, tenant, reward_types)
    if cache is not None:
        u = u.persist(StorageLevel.MEMORY_AND_DISK)
        cache.append(u)
    return UserTables(
        customers=dedupe(u, ["id", "TENANT"], ["id", "email", "TENANT"], order, keep),
        cards=dedupe(u, ["card_id", "TENANT"], ["card_id", "card_type", "REWARD_TYPE", "TENANT", "id"],
                     order, keep),
        card_types=dedupe(u, ["card_type", "TENANT"], ["card_type", "TENANT"], order, keep),
        campaign_customers=dedupe(u, ["name", "card_type"],
                                  ["email", "name", "phone", "card_type", "TENANT"], order, keep),
    )
