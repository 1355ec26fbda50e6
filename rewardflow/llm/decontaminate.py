"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items (word sequences) form one suffix automaton over word
tokens. Training words are streamed through it: after each word the automaton
holds the longest suffix of the words read so far that occurs in some item. A
match of ``window`` words or more ends an occurrence of a window; an item of
fewer words is a window as a whole and is recognised among the suffixes of the
match. Long items are cut into overlapping pieces and the pieces dealt into shards
of about ``shard_states`` states; tasks build the automata, and the documents are
streamed through one broadcast automaton a pass. With more than one shard the hits
of each pass are written and united at the end, so what the driver and a task hold
is bounded however large the benchmark is.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import Scratch, Shared, text_bytes

WINDOW = 10
SHARD_STATES = 1 << 19  # an automaton has at most two states a word
# a word: every byte that is no ASCII character, or an ASCII digit or letter
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def normalised_words(text: bytes) -> list[bytes]:
    return text.lower().translate(_SPACED).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences.

    ``hits(words)`` marks the words inside any occurrence of a window and
    returns the items whose windows occur.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            state = 0
            for word in words:
                state = self._extend(state, word)
        # items by state: of a window as its state, of a short item as the state of the whole
        holds: list[set[str]] = [set() for _ in self.length]
        whole = [False] * len(holds)
        for name, words in items:
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= window:
                    while self.length[self.link[state]] >= window:
                        state = self.link[state]
                    holds[state].add(name)
            if 0 < len(words) < window:
                holds[state].add(name)
                whole[state] = True
        self.names = [tuple(x) for x in holds]
        # nearest suffix state that is a whole short item, itself included; -1: none
        self.shorter = [-1] * len(holds)
        # state of the last `window` words, for states at least that long
        self.top = [-1] * len(holds)
        for s in sorted(range(1, len(holds)), key=self.length.__getitem__):
            up = self.link[s]
            self.shorter[s] = s if whole[s] else self.shorter[up]
            if self.length[s] >= window:
                self.top[s] = self.top[up] if self.length[up] >= window else s

    def packed(self) -> bytes:
        import zstandard

        return zstandard.ZstdCompressor().compress(pickle.dumps(vars(self)))

    @classmethod
    def of(cls, packed: bytes) -> SuffixAutomaton:
        import zstandard

        out = cls.__new__(cls)
        vars(out).update(pickle.loads(zstandard.ZstdDecompressor().decompress(packed)))
        return out

    def _clone(self, p: int, word: bytes, q: int) -> int:
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        new = len(self.length) - 1
        self.link[q] = new
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, word: bytes) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, word, q)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        new, p = len(self.length) - 1, last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q)
        return new

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged hit runs [start, end) in words, and the items that occur."""
        window, nxt, link, size = self.window, self.next, self.link, self.length
        start, runs, found = nxt[0], [], set()
        state, length = 0, 0
        for i, word in enumerate(words):
            if not state:
                state = start.get(word, 0)
                length = 1 if state else 0
                if not state:
                    continue
            else:
                to = nxt[state].get(word)
                while to is None and state:
                    state = link[state]
                    length = size[state]
                    to = nxt[state].get(word)
                if to is None:
                    length = 0
                    continue
                state, length = to, length + 1
            covered = 0
            if length >= window:
                found.update(self.names[self.top[state]])
                covered = window
            at = self.shorter[state]
            while at > 0:
                if size[at] <= length:
                    found.update(self.names[at])
                    covered = max(covered, size[at])
                at = self.shorter[link[at]]
            if covered:
                first = i + 1 - covered
                while runs and runs[-1][1] >= first:
                    first = min(first, runs.pop()[0])
                runs.append((first, i + 1))
        return runs, found


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def pieces(items: DataFrame, window: int, most: int) -> DataFrame:
    """Items (item_id, text) -> their words (item_id, words, n) in pieces of which each
    begins ``most`` windows, so that every window is in one piece."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for name, text in zip(f["item_id"], f["text"]):
                words = normalised_words(text)
                for i in range(0, len(words), most):
                    if i == 0 or len(words) - i >= window:
                        part = words[i:i + most + window - 1]
                        rows.append((name, b" ".join(part), len(part)))
            yield pd.DataFrame(rows, columns=["item_id", "words", "n"])

    return items.distinct().mapInPandas(run, "item_id string, words binary, n long").distinct()


def automata(found: DataFrame, shards: int, window: int) -> DataFrame:
    """The packed automaton of every shard of the pieces: (shard, automaton)."""
    def build(f: pd.DataFrame) -> pd.DataFrame:
        items = sorted((name, bytes(words)) for name, words in zip(f["item_id"], f["words"]))
        made = SuffixAutomaton([(name, words.split()) for name, words in items], window)
        return pd.DataFrame({"shard": f["shard"].iloc[:1], "automaton": [made.packed()]})

    shard = F.pmod(F.xxhash64("item_id", "words"), F.lit(shards)).alias("shard")
    return (found.select("item_id", "words", shard).groupBy("shard")
            .applyInPandas(build, "shard long, automaton binary"))


def _find(held: Shared):
    """UDF of text -> hits. Only texts go to Python, and a filter on the hits does not
    evaluate it again."""
    @F.pandas_udf("n_words long, runs array<array<long>>, items array<string>")
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = SuffixAutomaton.of(held.value)
        for texts in parts:
            n, runs, names = [], [], []
            for text in texts:
                words = normalised_words(text)
                r, found = automaton.hits(words)
                n.append(len(words))
                runs.append([list(x) for x in r])
                names.append(sorted(found))
            yield pd.DataFrame({"n_words": np.array(n, dtype=np.int64), "runs": runs, "items": names})

    return find.asNondeterministic()


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str],
                   window: int = WINDOW, shard_states: int = SHARD_STATES) -> DataFrame:
    """``keep`` columns plus ``n_words``, ``runs`` (merged hit runs, in words) and
    ``items`` (sorted ids of the items whose windows occur), one row per row.

    NULL and empty texts have no words. Items without id or words are ignored;
    rows that repeat an item id count as that one item. An empty benchmark hits
    nothing; an empty table gives an empty result. Other columns of both tables are
    ignored. A text is held whole by one task, with its words; an item's text is held
    whole only while it is cut into pieces.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "hits")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                             text_bytes().alias("text")).where("item_id is not null")
    found = scratch.write(pieces(items, window, max(window, shard_states // 8)), "pieces")
    words = found.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-2 * words // shard_states))
    built = scratch.write(automata(found, shards, window), "automata")

    def shard(k: int) -> Shared:
        row = built.where(F.col("shard") == k).first()
        return Shared(spark, bytes(row.automaton) if row else SuffixAutomaton([], window).packed())

    if shards == 1:
        return docs.select(*keep, _find(shard(0))(text_bytes()).alias("_hits")).select(*keep, "_hits.*")
    rows = scratch.write(docs.select(F.struct(*keep).alias("_keep"), "text",
                                     F.monotonically_increasing_id().alias("_at")), "texts")
    passes = None
    for k in range(shards):
        held = shard(k)
        hits = rows.select("_at", _find(held)(text_bytes()).alias("_hits")).select("_at", "_hits.*")
        hits = scratch.write(hits.where(F.lit(k == 0) | (F.size("runs") > 0)), f"hits{k}")
        held.release()
        passes = hits if passes is None else passes.unionByName(hits)

    @F.pandas_udf("array<array<long>>")
    def merged(runs: pd.Series) -> pd.Series:
        return pd.Series([[list(x) for x in merge_runs([tuple(x) for x in r])] for r in runs], dtype=object)

    of_row = passes.groupBy("_at").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return (rows.select("_keep", "_at").join(of_row, "_at")
            .select("_keep.*", "n_words", merged.asNondeterministic()("runs").alias("runs"), "items"))


def cut_runs(text: bytes, runs: list) -> bytes:
    """The text without its hit words and what stands between the words of a run."""
    spans = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in runs:
        out.append(text[at:spans[a][0]])
        at = spans[b - 1][1]
    return b"".join([*out, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_coverage: float = 0.5, shard_states: int = SHARD_STATES) -> DataFrame:
    """``docs`` without benchmark passages: a document of whose words more than
    ``max_coverage`` are hit is removed; from others each run of hit words is cut
    out. Columns stay; ``n_chars``, where there is one, counts the new text. A
    document without hits stays as it is, NULL text included.
    """
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), "text")
    hits = benchmark_hits(packed, benchmark, ["_row", "text"], window, shard_states)

    @F.pandas_udf("string")
    def cut(text: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not len(r) else
                          cut_runs(t.encode(), r).decode() for t, r in zip(text, runs)])

    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    clean = (hits.where(n_hit <= F.col("n_words") * F.lit(float(max_coverage)))
             .select("_row", cut.asNondeterministic()("text", "runs").alias("_new"), F.size("runs").alias("_cut")))
    out = []
    for c in columns:
        old = F.col("_row").getField(c)
        if c == "text":
            out.append(F.col("_new").alias(c))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            out.append(F.when(F.col("_cut") > 0, F.char_length("_new").cast(kind))
                       .otherwise(old).alias(c))
        else:
            out.append(old.alias(c))
    return clean.select(*out)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  shard_states: int = SHARD_STATES) -> DataFrame:
    """Digest per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = benchmark_hits(docs, benchmark, ["doc_id"], window, shard_states)
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"))
