"""Removal of byte strings that also occur earlier in the corpus.

A window is a string of ``length`` bytes; it goes when an equal window starts
earlier. Every window is filed under its anchor, the leftmost of its k-byte
strings with the smallest hash, which depends on the window's bytes alone, so
equal windows meet under equal anchors. A row per anchor occurrence carries the
span of windows it anchors and a hash of that span (its context).

A text that repeats itself under a short period would anchor a row per period
(per byte for a run of one character). Windows whose bytes equal those one period
earlier in their text go at once, as one span a block of windows, and only the
first period is filed.

1. Anchors that occur once are dropped (partially aggregated count).
2. Occurrences with equal anchor and context collapse to their first; all
   others start later, window by window.
3. Anchors left with several different contexts are resolved by the suffix
   array: the contexts are dealt to tasks by anchor, and each task builds the
   Burrows-Wheeler transform of a bounded batch and runs a breadth-first
   backward extension over it. Intervals of strings of 0, 1, 2, ... bytes fix
   the common prefixes of neighbouring suffixes by increasing value; it stops at
   ``length``, and what is still open then is exactly the suffixes that share
   ``length`` bytes or more.
4. An anchor with very many contexts is salted over several tasks. Those hand
   on the first occurrence of each of their windows, and equal windows of
   different tasks meet by a 128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rewardflow.llm.common import Scratch, text_bytes

LENGTH = 100
KMER_DOUBLINGS = 5
KMER = 1 << KMER_DOUBLINGS
#: windows handled together; equal windows pick equal anchors in any block
BLOCK = 1 << 16
#: contexts of one anchor beyond which it is salted, and bytes of text per transform
CROWD, BATCH_BYTES = 500, 1 << 17
#: bits of a packed span for its last window, counted from its first; a block's windows fit
SPAN_BITS = 17
LAST_ID = 2 ** 63 - 1

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _kmer_hashes(data: np.ndarray) -> np.ndarray:
    h = (data.astype(np.uint64) + np.uint64(1)) * _ODD[4]
    h ^= h >> np.uint64(29)
    for i in range(KMER_DOUBLINGS):
        h = h[:-(1 << i)] * _ODD[i] + h[1 << i:]
    h ^= h >> np.uint64(32)
    h *= _ODD[1]
    h ^= h >> np.uint64(29)
    return h


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def window_anchors(data: np.ndarray, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of window starts with the same anchor, block by block: (hash, anchor, first, last)."""
    low = np.uint64((1 << 20) - 1)
    for at in range(0, max(0, len(data) - length + 1), BLOCK):
        part = data[at:at + BLOCK + length - 1]
        h = _kmer_hashes(part)
        best = _slide_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - KMER + 1)
        anchor = (best & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:], len(anchor)] - 1
        p = anchor[first]
        yield h[p].view(np.int64), p + at, first + at, last + at


def periodic_rows(data: np.ndarray, h: np.ndarray, p: np.ndarray, first: np.ndarray,
                  last: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """Which rows hold only windows that equal, byte for byte, those one step earlier
    in their text; the step is the distance to the equal anchor of the row before."""
    step = np.r_[0, p[1:] - p[:-1]]
    ask = np.r_[False, h[1:] == h[:-1]] & (step > 0) & (first - step >= begin)
    late = np.zeros(len(h), bool)
    asked = np.flatnonzero(ask)
    if not len(asked):
        return late
    cut = np.flatnonzero(np.r_[True, (np.diff(asked) > 1) | (np.diff(step[asked]) != 0), True])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        rows = asked[a:b]
        lo, hi, d = first[rows[0]], last[rows[-1]] + length, step[rows[0]]
        differ = np.r_[0, np.cumsum(data[lo:hi] != data[lo - d:hi - d])]
        late[rows] = differ[last[rows] + length - lo] == differ[first[rows] - lo]
    return late


def _joined(texts: list[bytes], enough: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``enough`` bytes."""
    start, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= enough:
            yield start, i + 1
            start, n = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def anchor_rows(texts: list[bytes], length: int, context: bool,
                enough: int = 1 << 14) -> Iterator[tuple[np.ndarray, ...]]:
    """(text index, anchor hash, context hash, packed span) per anchor occurrence, in
    pieces of about ``enough`` rows. The last piece has no contexts (None): it holds the
    windows that repeat their own text one period earlier, a row per run and block."""
    runs = []
    for a, b in _joined(texts):
        part = texts[a:b]
        whole = b"".join(part)
        view, h64 = memoryview(whole), xxhash.xxh3_64_intdigest
        data = np.frombuffer(whole, dtype=np.uint8)
        sizes = np.array([len(t) for t in part])
        ends = np.cumsum(sizes)
        held, rows = [], 0
        for h, p, first, last in window_anchors(data, length):
            # a run of window starts may span texts: keep the part in each text it starts in
            doc = np.searchsorted(ends, first, side="right")
            until = np.searchsorted(ends, last, side="right")
            more = until - doc
            row = np.repeat(np.arange(len(first)), more + 1)
            doc = doc[row] + np.arange(len(row)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
            begin = ends[doc] - sizes[doc]
            first = np.maximum(first[row], begin)
            last = np.minimum(last[row], ends[doc] - length)
            ok = first <= last
            row, doc, first, last, begin = row[ok], doc[ok], first[ok], last[ok], begin[ok]
            h, p = h[row], p[row]
            late = periodic_rows(data, h, p, first, last, begin, length)
            if late.any():
                at = np.flatnonzero(late)
                fresh = np.r_[True, (doc[at][1:] != doc[at][:-1]) | (first[at][1:] != last[at][:-1] + 1)]
                head, tail = at[fresh], at[np.r_[fresh[1:], True]]
                runs.append((doc[head] + a, h[head],
                             ((first[head] - begin[head]) << SPAN_BITS) | (last[tail] - first[head])))
                doc, h, p, first, last, begin = (x[~late] for x in (doc, h, p, first, last, begin))
            ctx = np.zeros(len(h), dtype=np.uint64)
            if context:
                ctx[:] = [h64(view[s:e], o) for s, e, o in zip(
                    first.tolist(), (last + length).tolist(), (p - first).tolist())]
            held.append((doc + a, h, ctx.view(np.int64),
                         ((first - begin) << SPAN_BITS) | (last - first)))
            rows += len(h)
            if rows >= enough:
                yield tuple(np.concatenate(c) for c in zip(*held))
                held, rows = [], 0
        if rows:
            yield tuple(np.concatenate(c) for c in zip(*held))
    if runs:
        doc, h, span = (np.concatenate(c) for c in zip(*runs))
        yield doc, h, None, span


def common_prefix_groups(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, group of each of its entries): entries are in one group when
    their suffixes share ``length`` symbols or more.

    The suffix array is built by prefix doubling, for the transform only; the
    groups come from the transform by breadth-first backward extension. An
    interval of the array holds the suffixes that start with some string; the
    symbols before them, taken through the last-to-first mapping, are the
    intervals of the strings one symbol longer, and the right end of one that is
    still open has a common prefix of exactly the current value. ``symbols`` must
    end in a 0 that occurs nowhere else.
    """
    n = len(symbols)
    padded = np.r_[symbols.astype(np.int64), np.zeros(6, np.int64)]
    key = np.zeros(n, np.int64)
    for i in range(7):  # seven symbols of nine bits fill a first key
        key = (key << 9) | padded[i:i + n]
    sa = np.argsort(key)
    rank = np.empty(n, np.int64)
    slot, group, k = np.arange(n), key[sa], 7
    while True:  # only suffixes that are still tied are sorted again, by the next k symbols
        fresh = np.r_[True, group[1:] != group[:-1]]
        rank[sa[slot]] = np.maximum.accumulate(np.where(fresh, slot, 0))
        tied = ~(fresh & np.r_[fresh[1:], True])
        slot = slot[tied]
        if not len(slot):
            break
        at = sa[slot]
        after = np.where(at + k < n, rank[np.minimum(at + k, n - 1)] + 1, 0)
        group = rank[at] * (n + 1) + after
        by = np.argsort(group)
        sa[slot], group = at[by], group[by]
        k *= 2
    bwt = symbols[sa - 1]
    order = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[order] = np.arange(n)
    settled = np.zeros(n + 1, bool)
    settled[[0, n]] = True
    lb, rb = np.array([0]), np.array([n])
    for _ in range(length):
        size = rb - lb
        if not len(size):
            break
        which = np.repeat(np.arange(len(size)), size)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + lb[which]
        to = lf[rows]
        by = np.argsort(to)
        to, which, char = to[by], which[by], bwt[rows[by]]
        cut = np.r_[True, (which[1:] != which[:-1]) | (char[1:] != char[:-1])]
        start = np.flatnonzero(cut)
        lb2 = to[start]
        rb2 = to[np.r_[start[1:], len(to)] - 1] + 1
        new = ~settled[rb2]
        settled[rb2[new]] = True
        lb, rb = lb2[new], rb2[new]
    return sa, np.cumsum(settled[:n]) - 1


def judge_contexts(f: pd.DataFrame, length: int) -> pd.DataFrame:
    """One batch of contexts: ``kind`` 0 rows are spans of windows that start later
    than an equal one of the batch, ``kind`` 1 rows the first of each window of a
    salted anchor, with its digest."""
    f = f.sort_values(["_id", "_tx", "at"], kind="stable").reset_index(drop=True)
    parts = list(f["bytes"])
    sizes = np.array([len(b) + 1 for b in parts])
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"\x00".join(parts) + b"\x00\x00", dtype=np.uint8).astype(np.int64) + 2
    data[begin + sizes - 1] = 1
    data[-1] = 0
    sa, group = common_prefix_groups(data, length)
    window = np.zeros(len(data), bool)
    seg = np.repeat(np.arange(len(parts)), sizes)
    inside = np.arange(len(seg)) - begin[seg]
    window[:len(seg)] = inside <= sizes[seg] - 1 - length
    pick = window[sa]
    pos, group = sa[pick], group[pick]
    seg, start = seg[pos], f["at"].to_numpy()[seg[pos]] + inside[pos]
    ids, tx = f["_id"].to_numpy()[seg], f["_tx"].to_numpy()[seg]
    by = np.lexsort((start, tx, ids, group))
    pos, group, seg, start, ids, tx = (x[by] for x in (pos, group, seg, start, ids, tx))
    head = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
    rep = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    late = (ids != ids[rep]) | (tx != tx[rep]) | (start != start[rep])
    spans = pd.DataFrame({"_id": ids[late], "_tx": tx[late], "start": start[late]})
    spans = spans.sort_values(["_id", "_tx", "start"])
    same = ((spans["_id"] == spans["_id"].shift()) & (spans["_tx"] == spans["_tx"].shift())
            & (spans["start"] <= spans["start"].shift() + 1))
    runs = spans.groupby((~same).cumsum(), sort=False).agg(
        _id=("_id", "first"), _tx=("_tx", "first"), start=("start", "min"), last=("start", "max"))
    out = [runs.assign(kind=0, window=b"", end=runs["last"] + length)]
    shared = head & f["salted"].to_numpy()[seg]
    if shared.any():
        blob = b"\x00".join(parts)
        out.append(pd.DataFrame({
            "_id": ids[shared], "_tx": tx[shared], "start": start[shared],
            "end": start[shared] + length, "kind": 1,
            "window": [xxhash.xxh3_128_digest(blob[p:p + length]) for p in pos[shared].tolist()]}))
    names = ["kind", "window", "_id", "_tx", "start", "end"]
    return pd.concat([x[names] for x in out if len(x)] or [runs.assign(kind=0, window=b"", end=0)[names]])


def context_batches(frames: Iterator[pd.DataFrame], enough: int = BATCH_BYTES) -> Iterator[pd.DataFrame]:
    """Contexts sorted by anchor and salt, regrouped into batches of about ``enough`` bytes
    that never cut a group. Frames are taken apart first: Arrow hands on ten thousand rows
    at a time, and the transform needs memory for a hundred times its bytes."""
    held, size = [], 0
    for f in frames:
        ends = np.cumsum([len(b) for b in f["bytes"]])
        for part in np.split(np.arange(len(f)), np.flatnonzero(np.diff(ends // enough)) + 1):
            if not len(part):
                continue
            held.append(f.iloc[part[0]:part[-1] + 1])
            size += sum(map(len, held[-1]["bytes"]))
            if size < enough:
                continue
            whole = pd.concat(held, ignore_index=True)
            h, salt = whole["h"].to_numpy(), whole["salt"].to_numpy()
            cut = int(((h == h[-1]) & (salt == salt[-1])).argmax())
            if cut:
                yield whole.iloc[:cut]
            held = [whole.iloc[cut:]]
            size = sum(map(len, held[0]["bytes"]))
    if held:
        yield pd.concat(held, ignore_index=True)


def _keyed(docs: DataFrame, *keep: str) -> DataFrame:
    text = text_bytes()
    return docs.select(*keep, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"),
                       F.xxhash64(text).alias("_tx"), text.alias("_text"))


def merged_spans(cuts: DataFrame) -> DataFrame:
    """Maximal ``[start, end)`` runs per ``(_id, _tx)``. Rows of one id and text repeat
    their spans, so these are first made distinct, added up map-side."""
    distinct = cuts.groupBy("_id", "_tx", "start").agg(F.max("end").alias("end"))
    by = Window.partitionBy("_id", "_tx").orderBy("start")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = distinct.withColumn("_new", F.when(F.col("start") <= reach, 0).otherwise(1))
    runs = fresh.withColumn("_run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("_id", "_tx", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH,
                   crowd: int = CROWD, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``(_id, _tx, cuts)`` for documents with repeated windows; ``cuts`` is an array
    of the maximal [start, end) byte spans to remove.

    A text is one row beside its contexts, so a task needs memory for a few times the
    longest text. Spans are merged before they meet in one row: their number follows
    the gaps between them, not the windows removed."""
    source = _keyed(docs)

    def anchors(context: bool) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                ids, tx = f["_id"].to_numpy(), f["_tx"].to_numpy()
                for doc, h, ctx, span in anchor_rows(list(f["_text"]), length, context):
                    ctx = pd.array([pd.NA] * len(h), dtype="Int64") if ctx is None else ctx
                    out = {"h": h} | ({"ctx": ctx, "_id": ids[doc], "_tx": tx[doc], "span": span}
                                      if context else {})
                    yield pd.DataFrame(out)
        return source.mapInPandas(run, "h long, ctx long, _id long, _tx long, span long"
                                  if context else "h long")

    again = scratch.write(anchors(False).groupBy("h").count().where("count > 1").select("h"), "again")
    scratch.settle()
    seen = scratch.write(anchors(True).join(again, "h", "left_semi"), "seen")
    scratch.drop("again")
    scratch.settle()
    place = F.struct("_id", "_tx", "span")
    contexts = scratch.write(seen.where("ctx IS NOT NULL").groupBy("h", "ctx").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "contexts")
    copied = contexts.where("n > 1").select("h", "ctx", "first")
    start = F.shiftright("span", SPAN_BITS)
    cut = ["_id", "_tx", start.alias("start"),
           (start + F.col("span").bitwiseAND(F.lit((1 << SPAN_BITS) - 1)) + length).alias("end")]
    equal = seen.join(copied, ["h", "ctx"]).where(place != F.col("first")).select(*cut)
    # windows of a period go whether or not their anchor is found elsewhere
    equal = scratch.write(equal.unionByName(seen.where("ctx IS NULL").select(*cut)), "equal")
    scratch.drop("seen")
    scratch.settle()

    crowds = scratch.write(contexts.groupBy("h").count().where("count > 1"), "crowds")
    salts = F.ceil(F.col("count") / crowd)
    open_ = (contexts.join(crowds, "h").select(
        "h", F.col("first._id").alias("_id"), F.col("first._tx").alias("_tx"),
        F.struct("h", F.when(F.col("count") > crowd, F.pmod(F.col("ctx"), salts) + 1)
                 .otherwise(F.lit(0)).cast("int").alias("salt"),
                 F.col("first.span").alias("span")).alias("c"))
        .groupBy("_id", "_tx").agg(F.collect_list("c").alias("cs"))
        .select("_id", "_tx", "cs.h", "cs.salt", "cs.span"))
    wanted = source.join(open_, ["_id", "_tx"])

    def texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["h", "salt", "_id", "_tx", "at"]

        def frame(held: list, parts: list[bytes]) -> pd.DataFrame:
            columns = (np.concatenate(c) for c in zip(*held))
            return pd.DataFrame(dict(zip(names, columns))).assign(bytes=parts)
        for f in frames:
            held, parts = [], []
            for i, x, text, h, salt, span in zip(*(f[c] for c in ("_id", "_tx", "_text", "h", "salt", "span"))):
                at = span >> SPAN_BITS
                end = at + (span & ((1 << SPAN_BITS) - 1)) + length
                held.append((h, salt, np.full(len(h), i), np.full(len(h), x), at))
                parts += [text[s:e] for s, e in zip(at.tolist(), end.tolist())]
                if len(parts) >= 5000:
                    yield frame(held, parts)
                    held, parts = [], []
            if parts:
                yield frame(held, parts)

    cut_out = scratch.write(wanted.mapInPandas(
        texts, "h long, salt int, _id long, _tx long, at long, bytes binary"), "cut_out")
    scratch.settle()

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in context_batches(frames, batch_bytes):
            yield judge_contexts(f.assign(salted=f["salt"] > 0), length)

    judged = scratch.write(
        cut_out.repartition("h", "salt").sortWithinPartitions("h", "salt").mapInPandas(
            judge, "kind int, window binary, _id long, _tx long, start long, end long"), "judged")
    scratch.drop("cut_out", "contexts", "crowds")
    firsts = judged.where("kind = 1")
    spot = F.struct("_id", "_tx", "start")
    least = scratch.write(firsts.groupBy("window").agg(F.min(spot).alias("first"),
                                                       F.count(F.lit(1)).alias("n"))
                          .where("n > 1").select("window", "first"), "least")
    across = firsts.join(least, "window").where(spot != F.col("first"))
    cuts = (equal.unionByName(judged.where("kind = 0").select("_id", "_tx", "start", "end"))
            .unionByName(across.select("_id", "_tx", "start", "end")))
    cuts = scratch.write(merged_spans(cuts).groupBy("_id", "_tx").agg(
        F.collect_list(F.struct("start", "end")).alias("cuts")), "cuts")
    scratch.drop("equal", "judged", "least")
    scratch.settle()
    return cuts


def removed_runs(cuts) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((c["start"], c["end"]) for c in cuts):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in runs:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def _cut(docs: DataFrame, scratch: Scratch, keep: list[str], length: int, **sizes) -> DataFrame:
    cuts = repeated_spans(docs, scratch, length, **sizes)
    return _keyed(docs, *keep).join(cuts, ["_id", "_tx"], "left")


def dedup_digest(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD,
                 batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Documents are ordered by doc_id, NULL last, equal ids by a hash of the text;
    rows with equal id and text are one document and get the same result each.
    NULL and empty texts, and texts below ``length`` bytes, lose nothing. Texts of any
    length are read whole; one that repeats a short period keeps its first period. An
    empty table gives an empty result; other columns are ignored.
    """
    joined = _cut(docs, Scratch(docs.sparkSession, "suffix"), ["doc_id"], length,
                  crowd=crowd, batch_bytes=batch_bytes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            n, gone, spans, sha = [], [], [], []
            for text, cuts in zip(f["_text"], f["cuts"]):
                runs = [] if cuts is None else removed_runs(cuts)
                n.append(len(text))
                gone.append(sum(b - a for a, b in runs))
                spans.append(len(runs))
                sha.append(hashlib.sha256(kept_bytes(text, runs)).hexdigest())
            yield f[["doc_id"]].assign(n_bytes=n, n_removed=gone, n_spans=spans, kept_sha256=sha)

    return joined.mapInPandas(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, "
                                   "n_removed long, n_spans long, kept_sha256 string")


def dedup_texts(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD,
                batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``docs`` with repeated bytes cut from the texts (a character that loses some
    of its bytes goes whole); all rows stay, with their columns. ``n_chars``, where
    there is one, counts the new text of rows that lost bytes. Untouched texts stay
    as they are, NULL included. See ``dedup_digest`` for the order of documents."""
    columns = docs.columns
    rest = F.struct(*[F.col(f"`{c}`") for c in columns if c != "text"])
    packed = docs.select(rest.alias("_row"), F.col("text").isNull().alias("_null"), "doc_id", "text")
    joined = _cut(packed, Scratch(docs.sparkSession, "suffix"), ["_row", "_null"], length,
                  crowd=crowd, batch_bytes=batch_bytes)

    @F.pandas_udf("string")
    def cut(text: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([t.decode() if c is None else
                          kept_bytes(t, removed_runs(c)).decode("utf-8", "ignore")
                          for t, c in zip(text, cuts)])

    lost = F.col("cuts").isNotNull()
    new = joined.select("_row", "_null", lost.alias("_lost"),
                        cut.asNondeterministic()("_text", "cuts").alias("_new"))
    out = []
    for c in columns:
        old = F.when(~F.col("_null"), F.col("_new")) if c == "text" else F.col("_row").getField(c)
        if c == "n_chars":
            old = F.when(F.col("_lost"), F.char_length("_new").cast(docs.schema[c].dataType)).otherwise(old)
        out.append(old.alias(c))
    return new.select(*out)
