"""Personal data by patterns and a semi-Markov conditional random field.

Base spans are the plain patterns of four kinds: e-mail addresses, IPv4 addresses,
payment card numbers and phone numbers. They miss what is written otherwise (a phone
number without +, an address with "(at)", a card number with dots) and what stands too
close (two card numbers with a space between are one run of 32 digits). The field adds
such spans: the text around digits and at-signs is cut into tokens, every run of up
to ``SPAN`` tokens that could be an entity is a candidate, whole-span features (shape,
digit groups, check digit, neighbours) score it for each kind, and a dynamic program over
segmentations, in which a segment is one plain token or one bounded entity, chooses
boundaries and kinds together.

The field is trained here, by its exact likelihood (forward-backward over
segmentations), on base spans in a bounded sample of documents, on the same spans
rewritten by rule (other separators, two in a row), and on made-up ones of each kind with
close misses (wrong check digit, dates, versions, hexadecimal digests), so that it also
works where the documents hold few.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import Shared, text_bytes
from rewardflow.llm.training import Adam, TEXT_BYTES, scatter

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: tokens and characters of a candidate at most; tokens decoded at a time, and looked ahead
SPAN, CHARS, BLOCK, AHEAD = 21, 80, 4096, 64
CACHE = 100_000
#: documents the field is trained on at most, zones of theirs, and made-up spans of each kind
ROWS, ZONES, MADE = 1000, 400, 40
EPOCHS, RATE, RIDGE = 60, 0.25, 2e-3

SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"

# ---------------------------------------------------------------- base spans
# Each pattern is anchored so that a long run is scanned once.
_TRIGGER = re.compile("[0-9@]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def digits_of(text: str) -> str:
    return re.sub("[^0-9]+", "", text)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part is the run of its characters before an @, back to
    the end of the match before."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(last, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order, code points, end exclusive."""
    if not _TRIGGER.search(text):
        return []
    found = [(s, EMAIL, e) for s, e in emails(text)]
    found += [(m.start(), IP, m.end()) for m in _IP.finditer(text) if octets(m.group().split("."))]
    for kind, pattern, low, high in ((CARD, _CARD, 12, 19), (PHONE, _PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = digits_of(m.group())
            if low <= len(digits) <= high and (kind == PHONE or luhn(digits)):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


# ---------------------------------------------------------------- zones, tokens, candidates
#: words with a digit or an at-sign, or "at" or "dot" in brackets: where entities can be
_HOT = re.compile(r"(?<!\S)(?:[^\s0-9@(\[{]++|[(\[{](?!(?:at|dot)[)\]}]))*+(?:[0-9@]|[(\[{](?:at|dot)[)\]}])\S*", re.I)
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
_AT, _DOT = re.compile(r"[(\[{]at[)\]}]", re.I), re.compile(r"[(\[{](?:dot|\.)[)\]}]", re.I)


def zones(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around hot words, with a word (of 64 characters at most) on each side;
    stretches that meet are one."""
    begin = end = None
    for m in _HOT.finditer(text):
        s = m.start()
        left = text[max(0, s - 66):s]
        word = left.rstrip(" \t")
        s = s - len(left) + len(word) - len(re.search(r"\S*$", word).group()) if len(left) - len(word) <= 2 else s
        e = m.end() + len(re.match(r"[ \t]{0,2}\S{0,64}", text[m.end():m.end() + 66]).group())
        if end is not None and s <= end:
            end = max(end, e)
            continue
        if end is not None:
            yield begin, end
        begin, end = s, e
    if end is not None:
        yield begin, end


def tokens_from(text: str, at: int, end: int, most: int = BLOCK + AHEAD) -> list[tuple[int, int]]:
    """At most ``most`` tokens (start, end) of the stretch."""
    return [m.span() for m in islice(_TOKEN.finditer(text, at, end), most)]


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(first token, token after the last) of the runs that could be an entity: they cut no
    word, begin with a letter, a digit, + or (, end with a letter or a digit, have single
    blanks only, and hold a digit or an at-sign."""
    out = []
    size = len(tokens)
    for i in range(size):
        s = tokens[i][0]
        c = text[s]
        if not (c.isalnum() or c in "+(") or (c.isalnum() and s and text[s - 1].isalnum()):
            continue
        hot = blank = False
        for j in range(i, min(size, i + SPAN)):
            a, e = tokens[j]
            d = text[a]
            if e - s > CHARS or d in "\r\n" or (d.isspace() and (blank or d != " ")):
                break
            blank = d == " "
            hot = hot or d in "0123456789@" or (d in "aA" and _AT.match(text, a - 1, e + 1) is not None)
            if hot and d.isalnum() and not (e < len(text) and text[e].isalnum()):
                out.append((i, j + 1))
    return out


def side(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "none"
    c = text[at]
    return "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


def features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole candidate span and its neighbours."""
    s = text[start:end]
    plain = _DOT.sub("{.}", _AT.sub("{@}", s)) if "{" in s or "[" in s or "(" in s else s
    groups = re.findall("[0-9]+", s)
    digits = "".join(groups)
    letters = any(c.isalpha() for c in plain)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]+", "9", plain))
    marks = "".join(sorted(set(re.sub(r"[a9]", "", shape))))
    ends = f"{side(text, start - 1)}{side(text, end)}"
    # whether the span could go on with a digit beyond one separator
    more = ("l" if re.search(r"[0-9][ .-]$", text[max(0, start - 2):start]) else "") + (
        "r" if re.match("[ .-][0-9]", text[end:end + 2]) else "")
    n = len(digits)
    out = ["all", f"n-groups:{min(9, len(groups))}:{letters}", f"marks:{marks}", f"shape:{shape[:40]}", f"ends:{ends}", f"more:{more}", f"letters:{letters}",
           f"digits:{min(n, 20)}:{letters}", f"first:{s[0] if s[0] in '+(' else side(s, 0)}"]
    if not letters:
        out.append("groups:" + "-".join(str(len(g)) for g in groups[:8]))
        if 12 <= n <= 19:
            ok = luhn(digits)
            out += [f"luhn:{ok}", f"luhn:{ok}:{len(groups)}", f"luhn:{ok}:{more}"]
        if len(groups) == 4:
            out.append(f"octets:{octets(groups)}:{marks}")
        if 9 <= n <= 15:
            out.append(f"plus:{s[0]}:{marks}")
    else:
        ats = plain.count("@")
        last = re.search(r"[^\W\d_]*$", s).group()
        out += [f"ats:{min(ats, 2)}:{2 <= len(last) <= 6}", f"at-dot:{ats == 1 and '.' in plain[plain.find('@'):]}",
                f"blanks:{ats}:{min(3, s.count(' '))}", f"plain-blank:{bool(re.search('[a9] [a9]', shape))}"]
    return out


def token_class(text: str, start: int) -> int:
    c = text[start]
    return 0 if c.isdigit() else 1 if c.isalpha() else 2


# ---------------------------------------------------------------- the field
@dataclass
class Field:
    """``index``: rows of ``weights`` (features x kinds); ``plain``: scores of a token outside."""

    index: dict[str, int]
    weights: np.ndarray
    plain: tuple[float, float, float]
    #: best kind and score of candidates seen, with the two characters on each side
    known: dict = field(default_factory=dict, repr=False, compare=False)

    def best_kind(self, text: str, start: int, end: int) -> tuple[int, float]:
        key = (text[max(0, start - 2):start], text[start:end], text[end:end + 2])
        got = self.known.get(key)
        if got is None:
            rows = [self.index[f] for f in features(text, start, end) if f in self.index]
            scores = self.weights[rows].sum(axis=0)
            k = int(scores.argmax())
            if len(self.known) >= CACHE:
                self.known.clear()
            got = self.known[key] = (k, float(scores[k]))
        return got

    def segment(self, text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """The best segmentation's entities as (first token, kind, token after the last)."""
        ending: list[list] = [[] for _ in range(len(tokens) + 1)]
        for i, j in candidates(text, tokens):
            ending[j].append((i, *self.best_kind(text, tokens[i][0], tokens[j - 1][1])))
        best, back = [0.0], [None]
        for j in range(1, len(tokens) + 1):
            score, move = best[j - 1] + self.plain[token_class(text, tokens[j - 1][0])], None
            for i, k, gain in ending[j]:
                if best[i] + gain > score:
                    score, move = best[i] + gain, (i, k, j)
            best.append(score)
            back.append(move)
        out, j = [], len(tokens)
        while j:
            if back[j] is None:
                j -= 1
            else:
                out.append(back[j])
                j = back[j][0]
        return out[::-1]

    def spans(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, kind, end) of all entities. A zone of more than ``BLOCK`` tokens is decoded
        block by block, each seeing ``AHEAD`` tokens of the next."""
        for at, end in zones(text):
            while at < end:
                tokens = tokens_from(text, at, end)
                whole = tokens[-1][1] == end
                found = [x for x in self.segment(text, tokens) if whole or x[0] < BLOCK]
                for i, k, j in found:
                    yield tokens[i][0], k, tokens[j - 1][1]
                at = end if whole else tokens[max(BLOCK, found[-1][2] if found else 0) - 1][1]


class Lattices:
    """Training zones as arrays: candidates, their features and the true segmentation."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.rows, self.sizes, self.zones = [], [], []
        self.n = 0

    def add(self, text: str, gold: list[tuple[int, int, int]]) -> bool:
        """A whole text with its true (start, kind, end); False if the truth is no segmentation
        of candidates."""
        tokens = [m.span() for m in _TOKEN.finditer(text)]
        if len(tokens) > 200:
            return False
        starts, ends = {s: i for i, (s, _) in enumerate(tokens)}, {e: i + 1 for i, (_, e) in enumerate(tokens)}
        runs = candidates(text, tokens)
        at = {r: c for c, r in enumerate(runs)}
        true, last = [], 0
        for s, k, e in sorted(gold):
            c = at.get((starts.get(s), ends.get(e)))
            if c is None or s < last:
                return False
            true.append((c, k))
            last = e
        for i, j in runs:
            rows = [self.index.setdefault(f, len(self.index)) for f in features(text, tokens[i][0], tokens[j - 1][1])]
            self.rows.append(np.array(rows))
            self.sizes.append(len(rows))
        covered = {t for c, _ in true for t in range(*runs[c])}
        classes = [token_class(text, s) for s, _ in tokens]
        ending: list[list] = [[] for _ in range(len(tokens) + 1)]
        for c, (i, j) in enumerate(runs):
            ending[j].append((i, c))
        outside = np.bincount([k for t, k in enumerate(classes) if t not in covered], minlength=3)
        self.zones.append((self.n, len(runs), classes, ending, true, outside))
        self.n += len(runs)
        return True

    def fit(self, epochs: int = EPOCHS, rate: float = RATE, ridge: float = RIDGE) -> Field:
        """Maximum likelihood with a ridge penalty, by full-batch Adam steps."""
        if not self.n:
            return Field({}, np.zeros((0, len(KINDS))), (0.0, 0.0, 0.0))
        flat, of = np.concatenate(self.rows), np.repeat(np.arange(self.n), self.sizes)
        model = {"weights": np.zeros((len(self.index), len(KINDS))), "plain": np.zeros(3)}
        model["weights"][self.index["all"]] = -2.0
        truth, outside = np.zeros((self.n, len(KINDS))), np.zeros(3)
        for first, _, _, _, true, plain in self.zones:
            outside += plain
            for c, k in true:
                truth[first + c, k] = 1
        adam = Adam(model, rate)
        for _ in range(epochs):
            scores = scatter(of, model["weights"][flat], self.n)
            top = scores.max(axis=1)
            total = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
            chance, seen = np.zeros(self.n), np.zeros(3)
            plain = model["plain"].tolist()
            for first, n, classes, ending, _, _ in self.zones:
                marginals(total[first:first + n].tolist(), plain, classes, ending, chance[first:first + n], seen)
            expected = np.exp(scores - total[:, None]) * chance[:, None]
            adam.step({"weights": scatter(flat, (expected - truth)[of], len(self.index)) / len(self.zones)
                       + ridge * model["weights"], "plain": (seen - outside) / len(self.zones)})
        return Field(self.index, model["weights"], tuple(model["plain"].tolist()))


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def marginals(total: list[float], plain: list[float], classes: list[int], ending: list[list],
              chance: np.ndarray, seen: np.ndarray) -> float:
    """Forward-backward over segmentations: fills each candidate's probability, adds up the
    expected plain tokens by class, and returns the log of the normaliser."""
    n = len(classes)
    ahead = [0.0]
    for j in range(1, n + 1):
        ahead.append(_log_sum([ahead[j - 1] + plain[classes[j - 1]], *[ahead[i] + total[c] for i, c in ending[j]]]))
    after: list[list[float]] = [[] for _ in range(n)] + [[0.0]]
    norm = ahead[n]
    for j in range(n, 0, -1):
        behind = _log_sum(after[j])
        step = plain[classes[j - 1]] + behind
        after[j - 1].append(step)
        seen[classes[j - 1]] += math.exp(ahead[j - 1] + step - norm)
        for i, c in ending[j]:
            step = total[c] + behind
            after[i].append(step)
            chance[c] = math.exp(ahead[i] + step - norm)
    return norm


# ---------------------------------------------------------------- training texts
def with_check_digit(digits: str) -> str:
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def made_up(rng: random.Random, kind: int) -> str:
    """A made-up entity of a kind, in its plain form."""
    word = lambda a, b: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(a, b)))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == EMAIL:
        local = rng.choice([word(2, 9), f"{word(3, 8)}.{word(3, 8)}", f"{word(3, 7)}.{number(2)}", word(3, 6) + number(3)])
        host = rng.choice([word(3, 9), f"{word(3, 6)}{number(1)}.{word(3, 8)}", f"{word(3, 6)}-{word(3, 6)}"])
        return f"{local}@{host}.{rng.choice(['com', 'org', 'net', 'de', 'io', 'fr', 'info'])}"
    if kind == IP:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == CARD:
        digits = with_check_digit(rng.choice("3456") + number(rng.choice([13, 14, 14, 14, 14, 14, 17])))
        return rng.choice([digits, digits] + [sep.join(re.findall("[0-9]{1,4}", digits)) for sep in " -"])
    area, three, four = number(3), number(3), number(4)
    return rng.choice([f"+1 ({area}) {three}-{four}", f"+{rng.randint(2, 99)} {area} {three} {four}",
                       f"+1-{area}-{three}-{four}", f"+{rng.randint(20, 99)}{number(9)}"])


def rewritten(rng: random.Random, kind: int, span: str) -> str:
    """The same entity as people write it to be read, or to hide it from plain patterns."""
    groups = re.findall("[0-9]+", span)
    if kind == EMAIL:
        at = rng.choice([" (at) ", "(at)", " [at] ", "[at]", "{at}"])
        dot = rng.choice([".", " (dot) ", "[dot]", "[.]", " [dot] "])
        local, host = span.split("@")
        return local + at + host.replace(".", dot)
    if kind == IP:
        return rng.choice(["[.]", "(.)", "[dot]", " . "]).join(groups)
    if kind == CARD:
        return rng.choice("./_").join(re.findall("[0-9]{1,4}", "".join(groups)))
    if len(groups) < 3:
        return "00" + "".join(groups) if groups else span
    head, rest = groups[0], groups[1:]
    return rng.choice([f"({rest[0]}) " + "-".join(rest[1:]), "-".join(rest), ".".join(rest),
                       f"{head} ({rest[0]}) " + "-".join(rest[1:]), f"{head}-" + "-".join(rest), "00" + " ".join(groups)])


def near_miss(rng: random.Random) -> str:
    """Something with digits or an at-sign that is no personal data."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    hexes = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([8, 18, 32, 40])))
    card = made_up(rng, CARD)
    wrong = card[:-1] + str((int(card[-1]) + rng.randint(1, 9)) % 10)
    return rng.choice([
        number(rng.randint(1, 8)), f"{rng.randint(1, 99)}.", f"{number(1)}.{number(1)}.", f"v{number(1)}.{number(1)}.{number(2)}",
        f"{number(1)}.{number(2)}.{number(1)}", f"20{number(2)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
        f"{number(2)}:{number(2)}", f"{number(2)}/{number(2)}/20{number(2)}", f"{number(3)},{number(3)}", f"{number(2)}.{number(2)}",
        hexes, f"id={hexes}", f'"{hexes}"', "KEY" + hexes.upper()[:16], wrong, wrong, number(rng.choice([13, 16, 22, 25])),
        ".".join(str(rng.randint(256, 999)) for _ in range(4)), f"+{number(3)}", f"+{number(2)} {number(3)}", f"@{number(3)}",
        "@someone", "a @ b", f"{number(3)}-{number(4)}", f"{number(1)}-{number(2)}", f"{number(4)}-{number(4)}",
        f"{number(3)}.{number(3)}", " ".join(number(rng.randint(1, 3)) for _ in range(rng.randint(2, 4))),
        " ".join(f"{k}." for k in range(1, rng.randint(3, 8))), f"{number(1)}. {number(1)}. {number(1)}.{number(1)}",
        f"({number(2)}) {number(1)}", f"1 (at) {number(1)}", f"{number(2)}%", f"{number(2)} + {number(2)}"])


_WORDS = "the of on is a by at les des la and der die el que in call mail from to card number ip".split()


def training_lattices(texts: list[str], seed: int = 11) -> Lattices:
    """Zones of the sample with their base spans, then written variants and near misses."""
    rng, out = random.Random(seed), Lattices()
    known: list[list[str]] = [[made_up(rng, k) for _ in range(MADE)] for k in range(len(KINDS))]
    picked = [(text, z) for text in texts for z in zones(text)]
    for text, (begin, end) in rng.sample(picked, min(ZONES, len(picked))):
        part = text[begin:end]
        gold = base_spans(part)
        # a run of digits that fails its check may be several entities: not a sure truth
        if any(len(digits_of(m.group())) > 19 for m in _CARD.finditer(part)):
            continue
        if out.add(part, gold):
            for s, k, e in gold:
                if len(known[k]) < 3 * MADE:
                    known[k].append(part[s:e])
    around = lambda parts: rng.choice(_WORDS) + " " + " ".join(parts) + rng.choice(["", ".", ","]) + " " + rng.choice(_WORDS)
    for kind, spans in enumerate(known):
        for span in spans:
            for written in (span, rewritten(rng, kind, span)):
                text = around([written])
                s = text.index(written)
                out.add(text, [(s, kind, s + len(written))])
            other = rng.randrange(len(KINDS))
            two = [span, rng.choice(known[other])]
            text = around(two)
            s = text.index(two[0])
            t = s + len(span) + 1
            out.add(text, [(s, kind, s + len(span)), (t, other, t + len(two[1]))])
    for _ in range(10 * MADE):
        out.add(around([near_miss(rng) for _ in range(rng.choice([1, 1, 2]))]), [])
    return out


def train_field(docs: DataFrame, rows: int = ROWS, text_limit: int = TEXT_BYTES) -> Field:
    """The field, from at most ``rows`` texts of at most ``text_limit`` bytes with a digit or
    an at-sign: those with the smallest hash of their id, of an id's texts the smallest."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    able = docs.select(F.xxhash64("doc_id").alias("h"), text.alias("t")).where(
        F.col("t").rlike("[0-9@]") & (F.octet_length("t") <= text_limit))
    # hashes first, so that a task hands on numbers and not texts
    last = able.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if last is None:
        return training_lattices([]).fit()
    got = able.where(F.col("h") <= last).groupBy("h").agg(F.min("t").alias("t")).collect()
    return training_lattices(sorted({r.t for r in got})).fit()


# ---------------------------------------------------------------- operator
def all_spans(text: str, model: Field) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, base) in order: the base spans, and the field's that touch none."""
    base = base_spans(text)
    if not _TRIGGER.search(text) and not _AT.search(text):
        return []
    out, taken = [(*b, True) for b in base], sorted((s, e) for s, _, e in base)
    at = 0
    for s, k, e in model.spans(text):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        near = at
        while near < len(taken) and taken[near][0] < e and taken[near][1] <= s:
            near += 1
        if near == len(taken) or taken[near][0] >= e:
            out.append((s, k, e, False))
    return sorted(out)


def find_personal_data(docs: DataFrame, rows: int = ROWS, text_limit: int = TEXT_BYTES) -> DataFrame:
    """doc_id, text and ``spans`` (kind, start, end in code points with the end exclusive, base:
    found by the patterns), one row per row.

    NULL and empty texts have no spans; ill-formed UTF-8 counts as replacement characters.
    Repeated rows and NULL ids are rows like others. Texts of any length are searched whole;
    a stretch of over 4,096 tokens full of digits is decoded in blocks that look 64 tokens
    ahead. The field is fitted on a bounded sample (see ``train_field``) and broadcast. Columns other
    than doc_id and text are not read.
    """
    shared = Shared(docs.sparkSession, train_field(docs, rows, text_limit))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for f in frames:
            found = [all_spans(bytes(t).decode("utf-8", "replace"), model) for t in f["_text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "text": f["text"], "spans": [
                [{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in x] for x in found]})

    src = docs.select("doc_id", F.col("text").cast("string").alias("text"), text_bytes().alias("_text"))
    return src.mapInPandas(run, f"doc_id {dict(src.dtypes)['doc_id']}, text string, spans {SPANS}")


def redact(found: DataFrame) -> DataFrame:
    """doc_id and text of ``find_personal_data``'s rows with every span replaced by its kind in
    brackets; of spans that overlap, the first. A NULL text stays NULL."""
    start = {"text": F.lit(""), "at": F.lit(0).cast("long")}
    zero = F.struct(*[c.alias(n) for n, c in start.items()])

    def step(done: Column, span: Column) -> Column:
        gap = F.substr(F.col("text"), (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        more = F.struct(F.concat(done["text"], gap, F.lit("["), span["kind"], F.lit("]")).alias("text"),
                        span["end"].alias("at"))
        return F.when(span["start"] < done["at"], done).otherwise(more)

    cut = F.aggregate("spans", zero, step, lambda done: F.concat(
        done["text"], F.substr(F.col("text"), (done["at"] + 1).cast("int"), F.length("text"))))
    return found.select("doc_id", cut.alias("text"))


def spans_digest(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, the digest of the base spans, all spans
    as text, and how many the field added."""
    base = F.filter("spans", lambda s: s["base"])
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))
