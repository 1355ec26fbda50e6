import hashlib
import random
import re

from rewardflow.llm.decontaminate import (
    SuffixAutomaton, automata, contamination, cut_runs, decontaminate, normalised_words, pieces)

DOCS = "doc_id long, text string, n_words string, runs string, items string, n_chars long"


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, items, window):
    words, hit, found = words_of(text), set(), set()
    for name, item in items:
        iw = words_of(item)
        if not iw or name is None:
            continue
        wins = [iw[i:i + window] for i in range(len(iw) - window + 1)] or [iw]
        for w in wins:
            for i in range(len(words) - len(w) + 1):
                if words[i:i + len(w)] == w:
                    found.add(name)
                    hit.update(range(i, i + len(w)))
    return len(words), hit, found


def test_words():
    for text in ["", "A-b c3É_ü\x1cß\x7fz", "日本 x", "`{|~}"]:
        assert [w.decode() for w in normalised_words(text.encode())] == words_of(text)


def test_automaton_equals_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        items = [(str(i), " ".join(rng.choices("abc", k=rng.randint(0, 9)))) for i in range(4)]
        text = " ".join(rng.choices("abcd", k=60))
        window = rng.randint(1, 5)
        auto = SuffixAutomaton([(n, normalised_words(t.encode())) for n, t in items], window)
        runs, found = auto.hits(normalised_words(text.encode()))
        _, hit, want = brute(text, items, window)
        assert found == want
        assert {i for a, b in runs for i in range(a, b)} == hit
        assert all(runs[i][1] < runs[i + 1][0] or runs[i][1] <= runs[i + 1][0] for i in range(len(runs) - 1))


def digest(names):
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def test_contract_rows_in_one_or_many_shards(spark):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choices(["x", "y", "z", "É"], k=rng.choice([0, 3, 12, 30])))) for i in range(9)]
    items += [(9, None), (None, "x y z"), (4, items[4][1]), (10, "Q-q")]
    docs = [(1, None), (2, ""), (3, "q Q."), (3, "q Q."), (None, "a b c"), (5, (items[4][1] + " pad, ") * 3),
            (6, " ".join(rng.choices(["x", "y", "z", "é", "É"], k=3000)))]
    df = spark.createDataFrame([(i, t, "n", "r", "s", 1) for i, t in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [(None if i is None else str(i), t) for i, t in items]
    want = []
    for i, t in docs:
        n, hit, found = brute(t, named, 10)
        want.append((str(i), n, len(hit), len(found), digest(found), bool(hit)))
    for size in (1 << 20, 150, 24):
        got = [(str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
               for r in contamination(df, bench, shard_states=size).collect()]
        assert sorted(got) == sorted(want)


def test_spans_are_cut_and_covered_documents_go(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    clean = "Nothing here, is of the test. " * 3
    docs = [(1, clean + passage.upper() + "! End", "", "", "", 0), (2, passage, "", "", "", 0), (3, clean, "", "", "", 7),
            (4, None, "", "", "", None)]
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    out = {r.doc_id: r for r in decontaminate(spark.createDataFrame(docs, DOCS), bench).collect()}
    assert sorted(out) == [1, 3, 4]
    assert out[1].text == clean + "! End" and out[1].n_chars == len(clean + "! End")
    assert out[3].text == clean and out[3].n_chars == 7 and out[4].text is None
    assert cut_runs(b"a b c", [(0, 1), (2, 3)]) == b" b "


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, bench).count() == 0
    one = spark.createDataFrame([(1, "a b", "", "", "", 1)], DOCS)
    assert contamination(one, bench).first().contaminated is False


def test_pieces_hold_every_window_and_shards_their_bound(spark):
    words = [f"w{i % 37}" for i in range(500)]
    items = spark.createDataFrame([("long", " ".join(words).encode()), ("short", b"a b c"), ("none", b" ! ")],
                                  "item_id string, text binary")
    found = pieces(items, 10, 16)
    rows = found.collect()
    windows = {tuple(words[i:i + 10]) for i in range(491)}
    held = [bytes(r.words).split() for r in rows if r.item_id == "long"]
    assert {tuple(x.decode() for x in p[i:i + 10]) for p in held for i in range(len(p) - 9)} == windows
    assert all(r.n <= 25 for r in rows) and {r.item_id for r in rows} == {"long", "short"}
    shards = -(-2 * sum(r.n for r in rows) // 200)
    built = [SuffixAutomaton.of(bytes(r.automaton)) for r in automata(found, shards, 10).collect()]
    assert shards > 3 and len(built) > 3
    names = set().union(*[b.hits([w.encode() for w in words] + b"a b c".split())[1] for b in built])
    assert names == {"long", "short"}


def test_long_items_are_cut_from_documents_over_many_shards(spark):
    passage = " ".join(f"p{i}" for i in range(120))
    docs = [(1, f"before {passage} " + "after words " * 200, "", "", "", 0), (2, passage, "", "", "", 0),
            (3, "clean text", "", "", "", 7)]
    bench = spark.createDataFrame([(1, passage), (2, "x y z " * 30)], "item_id long, text string")
    out = {r.doc_id: r for r in decontaminate(spark.createDataFrame(docs, DOCS), bench, shard_states=100).collect()}
    assert sorted(out) == [1, 3]
    assert out[1].text == "before  " + "after words " * 200 and out[3].text == "clean text"
