"""SimHash near-duplicates by a self-join of a binary trie.

Every document gets a 64-bit fingerprint of its word shingles. Equal
fingerprints collapse into classes first (partial aggregation), so copies cost
one row however many there are. Two classes at ``budget`` or fewer differing
bits agree on at least one of ``budget + 1`` blocks of bits; classes that share
a block value meet in one group, and each group is joined with itself by
walking its binary trie: node pairs are traversed together, differing bits
accumulate, and a pair is dropped once they exceed the budget. A group with too
many classes is dealt out again by blocks of its remaining bits, as often as it
takes, which loses no link for the same reason. Each group hands on a spanning forest of its links
(not all pairs), and the forests are contracted to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import Scratch, text_bytes, whole_groups
from rewardflow.llm.components import connected_components

SEED = 42
BITS = 64
GROUP_CLASSES = 20_000


def simhash(text: bytes, shingle: int = 3) -> int:
    """Bit i is set when it is set in over half of the shingles' XXH64 values.
    Fewer words than ``shingle``: the whole sequence is one shingle; none: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))]
    h64 = xxhash.xxh64_intdigest
    hashes = np.array([h64(g, SEED) for g in grams], dtype=">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3) -> DataFrame:
    """``keep`` columns plus ``fp``, the fingerprint as a signed long."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = np.array([simhash(t, shingle) for t in f.pop("_text")], dtype=np.uint64)
            yield f.assign(fp=fp.view(np.int64))

    src = docs.select(*keep, text_bytes().alias("_text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in src.dtypes if c != "_text") + ", fp long"
    return src.mapInPandas(run, schema)


def roots(n: int, u: np.ndarray, v: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Smallest index of each index's component under the links (u, v)."""
    root = np.arange(n) if root is None else root
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root[root] != root).any():
            root = root[root]


def trie_join(group: np.ndarray, fp: np.ndarray, budget: int = 2,
              most: int = 1 << 20) -> np.ndarray:
    """Self-join of one binary trie per group, over rows sorted by (group, fp).

    A trie node is a run of sorted fingerprints with a common prefix, so a node
    pair is two runs. All pairs of a level advance together; a pair of single
    fingerprints is finished by one popcount. More than ``most`` open pairs are
    worked off in parts. Returns each row's root row (its component's first).
    """
    n = len(fp)
    root = np.arange(n)
    if n < 2:
        return root
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], n]
    many = ends - starts > 1
    lo, hi = starts[many], ends[many]
    open_ = [(BITS - 1, np.stack([lo, hi, lo, hi, np.zeros_like(lo)]))]
    zeros: dict[int, np.ndarray] = {}
    while open_:
        bit, pairs = open_.pop()
        if not pairs.shape[1]:
            continue
        if pairs.shape[1] > most:
            half = pairs.shape[1] // 2
            open_ += [(bit, pairs[:, :half]), (bit, pairs[:, half:])]
            continue
        if bit not in zeros:
            if len(zeros) > 8:
                zeros.clear()
            zeros[bit] = np.r_[0, np.cumsum((fp >> np.uint64(bit)) & np.uint64(1) == 0)]
        z = zeros[bit]
        alo, ahi, blo, bhi, d = pairs
        am, bm = alo + z[ahi] - z[alo], blo + z[bhi] - z[blo]
        same = alo == blo
        other = ~same
        nxt = np.concatenate([
            np.stack([alo, am, blo, bm, d]), np.stack([am, ahi, bm, bhi, d]),
            np.stack([alo, am, bm, bhi, d + 1]),
            np.stack([am, ahi, blo, bm, d + 1])[:, other]], axis=1)
        alo, ahi, blo, bhi, d = nxt
        alone = (alo == blo) & (ahi - alo < 2)
        nxt = nxt[:, (ahi > alo) & (bhi > blo) & (d <= budget) & ~alone]
        alo, ahi, blo, bhi, d = nxt
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            a, b = alo[single], blo[single]
            near = np.bitwise_count(fp[a] ^ fp[b]) <= budget
            root = roots(n, a[near], b[near], root)
        if bit:
            open_.append((bit - 1, nxt[:, ~single]))
    return root


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _deals(mask: int, budget: int) -> list[int]:
    """``mask`` (bits that a group's members share) widened by each of ``budget`` + 1
    parts of the other bits: members within the budget agree on one part at least.
    So few other bits that all members are within the budget are left as they are."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    if len(free) <= budget:
        return [mask]
    n = budget + 1
    return [mask | sum(1 << b for b in free[len(free) * i // n:len(free) * (i + 1) // n]) for i in range(n)]


def links(classes: DataFrame, scratch: Scratch, budget: int = 2,
          group_classes: int = GROUP_CLASSES) -> DataFrame:
    """Distinct fingerprints ``(fp)`` -> a spanning forest ``(a, b)`` of each group's links.

    A group is the fingerprints that agree on the bits of a mask. Groups of over
    ``group_classes`` are dealt out again by parts of their other bits, until none is
    above that or its members are all within the budget; every deal keeps all links.
    """
    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for mask, g in f.groupby("mask"):
                for wider in map(_signed, _deals(mask % (1 << BITS), budget)):
                    yield pd.DataFrame({"fp": g["fp"], "mask": wider, "value": g["fp"] & wider})

    schema = "fp long, mask long, value long"
    blocks, done = classes.select("fp", F.lit(0).cast("long").alias("mask")).mapInPandas(deal, schema), []
    for level in range(BITS):
        hot = scratch.write(blocks.groupBy("mask", "value").count().where(
            (F.col("count") > group_classes) & (F.bit_count("mask") < BITS - budget)).select("mask", "value"), f"hot{level}")
        if hot.isEmpty():
            break
        done.append(blocks.join(hot, ["mask", "value"], "left_anti").select("fp", "mask", "value"))
        crowded = blocks.join(hot, ["mask", "value"], "left_semi").select("fp", "mask")
        blocks = scratch.write(crowded.mapInPandas(deal, schema), f"dealt{level}")
    for other in done:
        blocks = blocks.unionByName(other)
    keys = ["mask", "value"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in whole_groups(frames, keys):
            f = f.drop_duplicates()  # deals in another order can end in the same mask
            f = f.assign(u=f["fp"].to_numpy().view(np.uint64)).sort_values([*keys, "u"])
            group = f.groupby(keys, sort=False).ngroup().to_numpy()
            root = trie_join(group, f["u"].to_numpy(), budget)
            moved = root != np.arange(len(root))
            signed = f["fp"].to_numpy()
            yield pd.DataFrame({"a": signed[moved], "b": signed[root[moved]]})

    return (blocks.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
            .mapInPandas(run, "a long, b long"))


def _members(docs: DataFrame, shingle: int, budget: int, keep: tuple[str, ...]) -> DataFrame:
    """``doc_id``, ``keep`` columns, ``fp``, ``component_id`` and ``root``, a
    fingerprint that names the component."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.write(fingerprints(docs, ["doc_id", *keep], shingle), "prints")
    classes = scratch.write(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "classes")
    forest = connected_components(links(classes.select("fp"), scratch, budget), scratch)
    forest = scratch.write(forest.withColumnRenamed("node", "fp"), "forest")
    named = scratch.write(
        classes.join(forest, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    final = scratch.write(named.select("fp", "root").join(least, "root"), "final")
    scratch.drop("classes", "forest", "named")
    return prints.join(final, "fp")


def simhash_components(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, one row per
    row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``budget`` differing bits. NULL and empty texts have fingerprint zero and
    link like any other. Repeated rows share their class, one result row each.
    NULL ids are never a component's smallest unless it has no other. An empty
    table gives an empty result. Other columns of ``docs`` are ignored.
    """
    return _members(docs, shingle, budget, ()).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id
    (NULL last), of equal ids the one with the smallest text digest, and one row of
    rows that repeat it. Columns stay as they are."""
    columns = docs.columns
    spark = docs.sparkSession
    scratch = Scratch(spark, "kept")
    digest = F.xxhash64(text_bytes())
    keyed = docs.select("doc_id", "text", digest.alias("_digest"))
    members = scratch.write(_members(keyed, shingle, budget, ("_digest",)), "members")
    by = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_digest")
    kept = scratch.write(
        members.groupBy("root").agg(F.min(by).alias("_first"))
        .select(F.col("_first.doc_id").alias("_id"), F.col("_first._digest").alias("_digest")), "kept")
    scratch.drop("members")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"),
                         F.col("doc_id").alias("_doc"), digest.alias("_text"))
    found = packed.join(kept, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_digest")))
    return (found.groupBy("_doc", "_text").agg(F.first("_row").alias("_row"))
            .select(*[F.col("_row").getField(c).alias(c) for c in columns]))
