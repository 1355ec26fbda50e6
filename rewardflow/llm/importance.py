"""Importance resampling towards a target text distribution.

Documents are weighed by hashed runs of words: a feature's bucket has a gain, the
log ratio of its share in the target texts to its share in all documents, and the
gains of all buckets are one small array. A document's weight is the mean of its
features' gains, read from the array by bucket number; a Gumbel term drawn from a
digest of its id makes the highest scores a sample without replacement.

The k-th highest score is found by a distributed quickselect on the composite key
(score, id, number of features): random rows of the live range are the pivots, one
aggregate counts exactly how many keys lie below and on each pivot, and the range
between two pivots that must hold the k-th key is the next live range. No row is
sorted for this; only the winners are range-sorted and numbered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import Scratch, Shared, text_bytes
from rewardflow.operators.ids import assign_ids

BUCKETS, RUN, PIVOTS = 10_000, 2, 15
#: bytes of a text that are split into words at a time (a word is never cut)
PIECE = 1 << 20
_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def pieces_of(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text (runs of letters, digits and non-ASCII bytes, A-Z in lower
    case), piece by piece: a long text never stands as one list of words."""
    text = text.lower().translate(_SPACED)
    start = 0
    while len(text) - start > size:
        end = text.find(b" ", start + size)
        if end < 0:
            break
        yield text[start:end].split()
        start = end
    yield text[start:].split()


def feature_hashes(text: bytes, run: int = RUN, size: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """(words, crc32 of every run of 1 to ``run`` words that ends in them), by piece."""
    held: list[bytes] = []
    for words in pieces_of(text, size):
        n, joined = len(words), held + words
        found, ends = [], list(map(crc32, joined))
        found.append(ends[len(held):])
        for k in range(2, run + 1):  # ends[i]: crc32 of the k - 1 words from joined[i]
            ends = list(map(crc32, joined[k - 1:], map(crc32, repeat(b" "), ends)))
            found.append(ends[max(0, len(held) - k + 1):])
        held = joined[max(0, len(joined) - run + 1):] if run > 1 else []
        yield n, np.concatenate([np.array(x, dtype=np.int64) for x in found])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """Features of every text by bucket. A task hands on one row a bucket; what the
    driver gets is one row a bucket."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for f in frames:
            for text in f["_text"]:
                for _, hashes in feature_hashes(text, run):
                    total += np.bincount(hashes % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held.astype(np.int32), "n": total[held]})

    rows = (texts.select(text_bytes().alias("_text")).mapInPandas(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    more_s, more_t = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1) * more_s / ((s + 1) * more_t)))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, run: int = RUN) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    shared = Shared(docs.sparkSession, gains)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gain = shared.value
        for f in frames:
            made = []
            for text in f.pop("_text"):
                words = features = total = 0
                for n, hashes in feature_hashes(text, run):
                    words, features = words + n, features + len(hashes)
                    total += int(gain[hashes % len(gain)].sum())
                made.append((words, features, total // features if features else 0))
            yield f.assign(**dict(zip(("n_words", "n_features", "weight"),
                                      np.array(made, dtype=np.int64).reshape(-1, 3).T)))

    src = docs.select("doc_id", text_bytes().alias("_text"))
    return src.mapInPandas(score, f"doc_id {dict(src.dtypes)['doc_id']}, n_words long, n_features long, "
                                  "weight long")


def luck(doc_id: str, seed: int) -> Column:
    """floor(1000 x) of a Gumbel value x from the id's digest. A NULL id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def kth_key(rows: DataFrame, key: Column, k: int, pivots: int = PIVOTS) -> tuple | None:
    """The k-th smallest (from 1) ``key`` (a struct) of the rows, repeats counted;
    None when there are fewer rows.

    ``rows`` are read twice a round (pivots, counts) and a round keeps about one in
    ``pivots`` of them, so they should be a written or held table. Pivots are the
    live rows with the smallest hash of key and round: a rerun takes the same ones.
    """
    rows = rows.select(key.alias("key"))
    kind = rows.schema["key"].dataType
    live, below, turn = rows, 0, 0

    def literal(value) -> Column:
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(value, kind.fields)])

    while True:
        turn += 1
        found = live.orderBy(F.xxhash64("key", F.lit(turn)), "key").limit(pivots)
        ordered = [tuple(r.key) for r in found.distinct().orderBy("key").collect()]
        if not ordered:
            return None
        pivot = F.array(*[literal(p) for p in ordered])
        # how many pivots lie below a key, and whether the next one is equal to it
        place = F.size(F.filter(pivot, lambda p: p < F.col("key")))
        rows_at = {(r.place, r.same): r["count"] for r in live.groupBy(
            place.alias("place"), F.array_contains(pivot, F.col("key")).alias("same")).count().collect()}
        low = high = None
        passed = below
        for i, p in enumerate(ordered):
            less = passed + rows_at.get((i, False), 0)
            if k <= less:
                high = p
                break
            low, passed = p, less + rows_at.get((i, True), 0)
            if k <= passed:
                return p
        if low is not None:
            live, below = live.where(F.col("key") > literal(low)), passed
        if high is not None:
            live = live.where(F.col("key") < literal(high))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7,
             buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """doc_id, n_features, weight, score, rank and n_words, one row per row of ``docs``.

    Of the N rows with at least ``min_words`` words the floor(percent N / 100) with the
    highest scores are drawn; ``rank`` numbers them, ties to the smaller doc_id (NULL
    last), then to fewer features. Rows equal in all of these are alike, so which of
    them is drawn does not show. Others have rank NULL.

    NULL and empty texts have no features and weight 0. Long texts are taken a piece at
    a time. Repeated rows count and are drawn each for itself. Without rows the result
    is empty; without target texts all gains follow the documents alone. Only doc_id and
    text are read, so other columns, whatever their names, do not matter. Broadcast: one
    number per bucket.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    gains = bucket_gains(bucket_counts(docs, buckets, run), bucket_counts(target, buckets, run))
    scored = scratch.write(weigh(docs, gains, run).withColumn("score", F.col("weight") + luck("doc_id", seed)),
                           "scored")
    able = F.col("n_words") >= min_words
    k = percent * scored.where(able).count() // 100
    order = {"_down": -F.col("score"), "_missing": F.col("doc_id").isNull(), "_id": F.col("doc_id"),
             "_features": F.col("n_features")}
    key = F.struct(*[c.alias(n) for n, c in order.items()])
    last = kth_key(scored.where(able), key, k) if k else None
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(*columns)
    kinds = scored.select(key.alias("key")).schema["key"].dataType.fields
    cut = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(last, kinds)])
    drawn = able & (key <= cut)
    winners = assign_ids(scored.where(drawn).withColumns(order), "rank", list(order))
    # rows equal to the last one beyond the k-th are not drawn
    winners = winners.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return winners.select(*columns).unionByName(
        scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")).select(*columns))


ORACLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
                          lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
words AS (
  SELECT side, r, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM words),
known AS (SELECT side, r, f, count(*) AS n FROM features GROUP BY ALL),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i:
           ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM known), crc_table),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s,
         coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
  FROM known JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (ts + 10000) / ((s + 1) * (tt + 10000)))) AS gain
  FROM sums, (SELECT sum(s) AS ts, sum(t) AS tt FROM sums)),
weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
  FROM known JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE side = 'd'),
ranked AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20
                  ORDER BY score DESC, doc_id, n_features) END AS place,
         count(*) FILTER (n_words >= 20) OVER () AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * able // 100 THEN place END AS rank,
       n_words FROM ranked
"""
