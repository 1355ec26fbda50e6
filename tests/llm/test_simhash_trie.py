import numpy as np
import xxhash

from rewardflow.llm.simhash_trie import links, simhash, simhash_components, trie_join
from rewardflow.llm.common import Scratch

SCHEMA = "doc_id long, text string, fp string, component_id string"


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = ([b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2
             else [b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, prints, budget=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                root[find(i)] = find(j)
    out = {}
    for i in range(len(ids)):
        out.setdefault(find(i), []).append(i)
    least = {}
    for members in out.values():
        known = [ids[m] for m in members if ids[m] is not None]
        for m in members:
            least[m] = min(known) if known else None
    return [least[i] for i in range(len(ids))]


def test_fingerprint_equals_brute_force():
    for text in ["", "one", "One TWO", "a b c", "a b c d e f a b c", "x\x1cy z w é q r", "a " * 5000]:
        assert simhash(text.encode()) == brute_print(text)


def test_trie_join_finds_every_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
    fps = [int(b) for b in base]
    for b in base:
        for _ in range(12):
            x = int(b)
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(bit)
            fps.append(x)
    fp = np.unique(np.array(fps, dtype=np.uint64))
    for most in (1 << 20, 16):
        root = trie_join(np.zeros(len(fp)), fp, 2, most)
        want = brute_components(list(range(len(fp))), [int(x) for x in fp])
        assert root.tolist() == want


def test_crowded_groups_are_dealt_again(spark):
    rng = np.random.default_rng(5)
    center = int(rng.integers(0, 2 ** 62))
    fps = {center}
    while len(fps) < 300:
        x = center
        for bit in rng.choice(64, rng.integers(1, 6), replace=False):
            x ^= 1 << int(bit)
        fps.add(x)
    fps = sorted(fps)
    signed = [x - 2 ** 64 if x >= 2 ** 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = brute_components(list(range(len(fps))), fps)
    for size in (10_000, 5):
        forest = links(df, Scratch(spark, "t"), 2, size).collect()
        at = {x: i for i, x in enumerate(signed)}
        root = list(range(len(fps)))
        changed = True
        while changed:
            changed = False
            for r in forest:
                a, b = at[r.a], at[r.b]
                m = min(root[a], root[b])
                if root[a] != m or root[b] != m:
                    root[a] = root[b] = m
                    changed = True
        assert root == want


def test_rows_nulls_ties_and_clashing_columns(spark):
    rows = [(1, "a b c d e f g h", "x", "y"), (2, "A b c d e f g h", None, None), (2, "A b c d e f g h", None, None),
            (3, None, None, None), (None, "", None, None), (7, "other words entirely here now", None, None),
            (None, "lonely text with nobody near it at all", None, None), (9, "a b " * 20000, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash_components(df).collect())
    prints = [brute_print(r[1]) for r in rows]
    comps = brute_components([r[0] for r in rows], prints)
    want = sorted((r[0] is None, r[0] or 0, f"{p:016x}", c) for r, p, c in zip(rows, prints, comps))
    assert got == want


def test_empty_table(spark):
    out = simhash_components(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_generated_documents_equal_brute_force(spark):
    import os
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        return
    docs = spark.read.parquet(path)
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    comps = brute_components([r.doc_id for r in rows], prints)
    want = {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(rows, prints, comps)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_components(docs).collect()}
    assert got == want


def test_components_of_chains_stars_and_loops(spark):
    import random
    from rewardflow.llm.components import connected_components
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(i, 500) for i in range(300, 330)] + [(7, 7), (None, 3), (9, 8), (8, 9)]
    edges += [(rng.randint(1000, 1080), rng.randint(1000, 1080)) for _ in range(50)]
    rng.shuffle(edges)
    root = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if None not in (a, b) and a != b:
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(df, Scratch(spark, "t")).collect()}
    assert got == root
    assert connected_components(df.limit(0), Scratch(spark, "t")).count() == 0
