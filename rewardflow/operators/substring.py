"""J6/F12 for large pattern tables: an inverted join on q-grams.

Every pattern is filed under one q-gram of its own, the one that fewest of the texts
hold; the texts hand out their q-grams; equal grams meet in an equi-join and the
substring test settles them. A text and a pattern meet at most once, because a pattern
has one gram and a text's grams are distinct. Patterns with a gram that no text holds
match nothing and drop out early. Each different text is treated once, however many
rows carry it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_MAX_BROADCAST_ROWS, is_bounded, small_side

Q = 3


def grams(text: Column, q: int) -> Column:
    """The different runs of ``q`` characters of a text (none when it is shorter)."""
    last = F.length(text) - q + 1
    return F.when(last >= 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(q))))).otherwise(F.array())


def _probes(text: Column, q: int, short: Sequence[int]) -> Column:
    """The q-grams of a text, and its runs of the lengths of the shorter patterns
    (the empty pattern's is the empty run, which every text has)."""
    parts = [grams(text, q), *[grams(text, n) if n else F.array(F.lit("")) for n in short]]
    return F.concat(*parts)


def substring_matches(texts: DataFrame, patterns: DataFrame, keys: Sequence[str] = (), q: int = Q,
                      max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """All different (keys, text, pattern) of ``texts`` (keys, ``text``) and ``patterns`` (keys,
    ``pattern``) with equal keys whose text contains the pattern, case as it is.

    NULL texts, patterns and keys match nothing; the empty pattern matches every text.
    Nothing is collected but the lengths of patterns shorter than ``q``.
    """
    keys = list(keys)
    t = texts.select(*keys, "text").where(" and ".join(f"`{c}` is not null" for c in [*keys, "text"])).distinct()
    p = patterns.select(*keys, "pattern").where(
        " and ".join(f"`{c}` is not null" for c in [*keys, "pattern"])).distinct()
    size = F.length("pattern")
    short = sorted(r[0] for r in p.where(size < q).select(size).distinct().collect())
    probes = t.select(*keys, "text", F.explode(_probes(F.col("text"), q, short)).alias("_gram"))
    own = p.select(*keys, "pattern", F.explode(F.when(size < q, F.array("pattern")).otherwise(
        grams(F.col("pattern"), q))).alias("_gram"))
    asked = own.select(*keys, "_gram").distinct()
    small = is_bounded(asked, max_broadcast_rows)
    held = (probes.select(*keys, "_gram").join(F.broadcast(asked) if small else asked, [*keys, "_gram"], "left_semi")
            .groupBy(*keys, "_gram").count())
    # a gram that no text holds has no count, and its pattern cannot match
    filed = (own.join(held, [*keys, "_gram"], "left").groupBy(*keys, "pattern").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "_gram")).alias("_rare"))
        .where("_rare.n > 0").select(*keys, "pattern", F.col("_rare._gram").alias("_gram")))
    return (probes.join(F.broadcast(filed) if small else filed, [*keys, "_gram"])
            .where(F.col("text").contains(F.col("pattern"))).select(*keys, "text", "pattern"))


def substring_join(rows: DataFrame, patterns: DataFrame, text: str, pattern: str,
                   on: Sequence[tuple[str, str]] = (), q: int = Q,
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per (row, pattern row) with equal ``on`` columns (row's, pattern's) whose
    upper-cased text contains the upper-cased pattern; the columns of both.

    The matching texts go back to the rows by an equi-join on the text, which is a
    broadcast join when the matches are within the bounds, else a shuffle join (AQE
    splits a hot text). Column names of the two sides must differ.
    """
    names = [f"_k{i}" for i in range(len(on))]
    t = rows.select(*[F.col(a).alias(n) for (a, _), n in zip(on, names)], F.upper(F.col(text)).alias("text"))
    p = patterns.select(*[F.col(b).alias(n) for (_, b), n in zip(on, names)], F.upper(F.col(pattern)).alias("pattern"))
    met = substring_matches(t, p, names, q, max_broadcast_rows).select(
        *names, F.col("text").alias("_text"), F.col("pattern").alias("_pattern"))
    full = met.join(patterns, [F.col(n) == F.col(b) for (_, b), n in zip(on, names)]
                    + [F.col("_pattern") == F.upper(F.col(pattern))]).drop("_pattern")
    # counting needs no text form of what may be a row for every text and pattern
    small = full.count() <= max_broadcast_rows and is_bounded(full, max_broadcast_rows)
    return rows.join(small_side(full, bounded=small), [F.col(n) == F.col(a) for (a, _), n in zip(on, names)]
                     + [F.col("_text") == F.upper(F.col(text))]).drop(*names, "_text")
