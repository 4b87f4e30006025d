"""Problem 2: noise in text from scanned pages.

Method: words that the collection hardly knows retrieve correction candidates through an inverted join on positional
character q-grams; gradient-boosted trees rank the candidates and decide on a replacement. Classifiers on pairs of
lines handle the rest: a line and the next one (is the word between them cut?), a line and the recurring lines
of its file (is it a running header?), a line's number and the numbering of its file (is it the page number?).

The models are fitted on bounded samples: words of the collection that are corrupted or cut by rule (``SAMPLE_WORDS``), and
made-up books (``SAMPLE_BOOKS``). Counts, candidates and recurring lines cover all pages, and no list of a file is cut short.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.boosting import Boosted
from folioscope.runtime import materialize, slices

#: Known words sampled to fit the word and join models, and books made up for the line models.
SAMPLE_WORDS, SAMPLE_BOOKS = 2_500, 120
#: Words sent to executors so that they need no look-up: the most frequent ones.
KNOWN_WORDS = 5_000
#: A word is known from this share of all words on, and from ``KNOWN_FROM`` occurrences; it is beyond doubt from ``SURE_SHARE`` on.
KNOWN_SHARE, KNOWN_FROM, SURE_SHARE, SURE_FROM = 2.5e-6, 4, 2.5e-5, 40
#: A candidate is known at least so many times better than the word.
BETTER = 3
Q = 3
#: Known words that must share each trigram of a word that is put right without a candidate.
LEAST_USUAL = 8
#: A line and a recurring line are a pair from this likeness on; without one, a line is not judged as a header.
PAIR_FROM = 0.6
#: Non-blank lines at either edge of a page that may be header or page number; where they are short, so are all short lines that follow.
EDGE, SHORT = 2, 0.75
#: Buckets of the counts by which grams are rare or usual: what the driver holds of them.
GRAM_BUCKETS = 1 << 16
#: A key of this share of all rows is hot; there are at most 1 / HOT_SHARE of them, whatever the collection's size.
HOT_SHARE = 0.001

# What recognition takes for what. (read, true)
CONFUSIONS = [
    ("c", "e"), ("e", "c"), ("b", "h"), ("h", "b"), ("f", "t"), ("t", "f"), ("1", "l"), ("I", "l"), ("l", "i"), ("i", "l"), ("!", "i"), ("|", "l"), ("0", "o"), ("5", "s"), ("6", "b"), ("8", "B"), ("9", "g"), ("@", "a"), ("(", "c"),
    ("1", "i"), ("I", "i"), ("j", "i"), ("3", "e"), ("2", "z"), ("4", "a"), ("7", "t"), ("$", "s"), ("rn", "m"), ("m", "rn"), ("ii", "u"), ("h", "li"), ("li", "h"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("w", "vv"), ("n", "u"), ("u", "n"), ("in", "m"), ("ni", "m"), ("q", "g"), ("é", "e"), ("e", "é"),
]
MARKS = "-‐‑­¬=~–"
LOOKS = str.maketrans({"0": "o", "1": "i", "l": "i", "|": "i", "!": "i", "5": "s", "6": "b", "8": "b", "9": "g", "@": "a", "(": "c", "h": "b", "e": "c", "t": "f", "3": "e"})

_OUTER = "“”\"'‘’«»()[]{}.,;:?!…—–*_#>`"
_SPLIT = re.compile(r"[-‐‑’']")
_ROMAN = re.compile(r"^(?=[mdclxvi])m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$")
_NUMBER = re.compile(r"^(?:[-–—\[(|.*~ ]*)(?:(?:page|p|pg|seite|página|pag|s|folio)\.?\s*)?([0-9lIO|!]{1,5}|[ivxlcdmIVXLCDM]{1,9})(?:\s*(?:of|/|von|de|sur)\s*[0-9lIO|!]{1,5})?(?:[-–—\])|.*~ ]*)$", re.I)
_GAP = re.compile(r"\s{2,}|\s*\|\s*|\t")

TOKENS = "kind string, page_id long, line_no int, word string, other string, mark string"


# --- words ---------------------------------------------------------------------------------------


def word_units(token: str, line: str) -> list[str]:
    """The words of a token, in lower case, without outer punctuation. Signs that stand for a letter stay inside."""
    lead = token[:1]
    core = token.strip(_OUTER)
    if len(core) < 2:
        return []
    # an opening sign without its partner may be a letter
    if lead in "!(" and (lead == "!" or ")" not in line) and token[1:2].isalpha():
        core = lead + core.lstrip(lead)
    return [p for p in _SPLIT.split(core) if sum(c.isalpha() for c in p) >= 2 and len(p) >= 3]


def folded(word: str) -> str:
    """Lower case, but for a capital inside a word, which lower-case words do not have."""
    inner = word[1:]
    return word if not word.isupper() and any(c.isupper() for c in inner) else word.lower()


def page_lines(text: str | None) -> list[str]:
    return text.split("\n") if text else []


def _cut(line: str) -> tuple[str, str] | None:
    """(last word before the mark, mark) where a line ends in a mark of a cut word."""
    stripped = line.rstrip()
    if len(stripped) < 2 or stripped[-1] not in MARKS or not stripped[-2].isalnum():
        return None
    token = stripped[:-1].split()[-1] if stripped[:-1].split() else ""
    word = _SPLIT.split(token.strip(_OUTER))[-1]
    return (word, stripped[-1]) if sum(c.isalpha() for c in word) >= 1 else None


def _next_body(lines: list[str], i: int) -> int | None:
    """The next line with running text."""
    for j in range(i + 1, len(lines)):
        if sum(c.isalpha() for c in lines[j]) >= 3 and not _NUMBER.match(lines[j].strip()):
            return j
    return None


def _units_of(token: str, line: str) -> tuple[tuple[tuple[str, bool], ...], str]:
    """((word, whether it begins in lower case), ...) of a token, and the token as a whole if it is a compound."""
    core = token.strip(_OUTER)
    compound = core.lower() if "-" in core and all(p.isalpha() for p in core.split("-")) else ""
    return tuple((folded(u), u[:1].islower() or not u[:1].isalpha()) for u in word_units(token, line)), compound


@lru_cache(maxsize=1 << 16)
def _units(token: str) -> tuple[tuple[tuple[str, bool], ...], str]:
    """Tokens repeat; those that do not begin with a sign for a letter mean the same in every line."""
    return _units_of(token, "")


def page_words(lines: list[str]) -> Iterator[tuple[int, str, bool, str]]:
    """(line number, word, whether it begins in lower case, whole compound or '') without the halves of cut words."""
    skip = -1
    for i, line in enumerate(lines):
        tokens = line.split()
        if not tokens:
            continue
        cut = _cut(line)
        for k, token in enumerate(tokens):
            if k == 0 and skip == i or k == len(tokens) - 1 and cut:
                continue
            units, compound = _units(token) if token[0] not in "!(" else _units_of(token, line)
            for word, lower in units:
                yield i, word, lower, compound
        if cut:
            follow = _next_body(lines, i)
            skip = follow if follow is not None else -1


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, low = Counter(), Counter()

    def add(units: tuple[tuple[tuple[str, bool], ...], str], times: int) -> None:
        for word, lower in units[0]:
            n[word] += times
            low[word] += lower * times
        if units[1]:
            n[units[1]] += times * len(units[0])

    for batch in batches:
        # tokens are counted as they stand and split into words once each; those that depend on their line are looked at alone
        tokens: Counter = Counter()
        for text in batch.column("text").to_pylist():
            lines = page_lines(text)
            tokens.update((text or "").split())
            skip = -1
            for i, line in enumerate(lines):
                cut, dropped = _cut(line), {0} if skip == i else set()
                own = line.split() if cut or dropped or "!" in line or "(" in line else ()
                if cut:
                    dropped.add(len(own) - 1)
                    skip = _next_body(lines, i) or -1
                for k in dropped:
                    tokens[own[k]] -= 1
                for k, token in enumerate(own):
                    if token[0] in "!(" and k not in dropped:
                        add(_units_of(token, line), 1)
        for token, times in tokens.items():
            if times > 0 and token[0] not in "!(":
                add(_units(token), times)
    words = list(n)
    yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([n[w] for w in words], pa.int64()), pa.array([low[w] for w in words], pa.int64())], names=["word", "n", "low"])


def vocabulary(pages: DataFrame) -> DataFrame:
    """(word, n, low): every word of all pages, its count, and how often it began in lower case. Compounds count as well."""
    return pages.select("text").mapInArrow(_count_words, "word string, n long, low long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("low").alias("low"))


def _costs() -> dict[tuple[str, str], float]:
    return {pair: 0.25 for pair in CONFUSIONS}


_COST = _costs()


def distance(read: str, true: str) -> tuple[float, int]:
    """(weighted edit distance, edits) where confusions of recognition are cheap. Stops counting at 3."""
    # what both begin and end with alike costs nothing
    lead = next((i for i, (x, y) in enumerate(zip(read, true)) if x != y), min(len(read), len(true)))
    read, true = read[lead:], true[lead:]
    tail = next((i for i, (x, y) in enumerate(zip(read[::-1], true[::-1])) if x != y), min(len(read), len(true)))
    read, true = read[: len(read) - tail], true[: len(true) - tail]
    n, m = len(read), len(true)
    best = [[(9.0, 9)] * (m + 1) for _ in range(n + 1)]
    best[0][0] = (0.0, 0)
    for i in range(n + 1):
        for j in range(max(0, i - 3), min(m, i + 3) + 1):
            cost, edits = best[i][j]
            if cost > 3:
                continue
            for a, b in ((1, 1), (1, 0), (0, 1), (2, 1), (1, 2)):
                if i + a > n or j + b > m:
                    continue
                x, y = read[i : i + a], true[j : j + b]
                if a == b and x == y:
                    step, more = 0.0, 0
                elif (x, y) in _COST:
                    step, more = _COST[x, y], 1
                elif a + b <= 2:
                    step, more = 1.0, 1
                else:
                    continue
                if (cost + step, edits + more) < best[i + a][j + b]:
                    best[i + a][j + b] = (cost + step, edits + more)
    return best[n][m]


def grams(word: str) -> list[str]:
    """Positional q-grams of a word as it looks: each with its place from the nearer end, in steps of two."""
    text = f"^{word.lower().translate(LOOKS)}$"
    return [f"{text[i : i + Q]}{min(i, len(text) - Q - i) // 2}{'<' if i <= len(text) - Q - i else '>'}" for i in range(len(text) - Q + 1)]


class Likely:
    """Trigrams of known words: how usual a word's rarest one is."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.counts = counts

    @staticmethod
    def parts(word: str) -> list[str]:
        text = f"^{word.lower()}$"
        return [text[i : i + 3] for i in range(len(text) - 2)]

    def rarest(self, word: str) -> int:
        return min((self.counts.get(p, 0) for p in self.parts(word)), default=0)


def features(read: str, n: int, low: int, true: str, true_n: int, likely: Likely) -> list[float]:
    cost, edits = distance(read, true)
    odd = sum(not c.isalpha() for c in read)
    inner = any(c.isupper() for c in read[1:]) and not read.isupper()
    return [cost, float(edits), cost / max(1, edits), math.log(true_n) - math.log(n), float(odd), float(inner), low / max(1, n), float(len(read)), float(len(true) - len(read)), math.log1p(likely.rarest(read)), math.log1p(likely.rarest(true)), float(read[:1].lower() == true[:1])]


def corrupted(word: str, r: random.Random) -> str | None:
    places = [(i, read, true) for read, true in CONFUSIONS for i in range(len(word) - len(true) + 1) if word[i : i + len(true)] == true]
    if not places:
        return None
    i, read, true = r.choice(places)
    made = word[:i] + read + word[i + len(true) :]
    return made if made != word else None


def fit_words(sample: list[tuple[str, int, int]], likely: Likely) -> Boosted:
    """Ranks pairs (word as read, candidate). Corrupted known words are cases; other pairs of similar words are none."""
    r = random.Random(11)
    sample = sorted(s for s in sample if len(s[0]) >= 3)
    known = [s for s in sample if s[0].isalpha() and not any(c.isupper() for c in s[0][1:])]
    rows, classes = [], []
    near: dict[str, list[tuple[str, int, int]]] = {}
    for s in known:
        for g in set(grams(s[0])):
            near.setdefault(g, []).append(s)
    for word, n, low in known:
        made = corrupted(word, r)
        if made is None:
            continue
        seen = r.randint(1, max(1, r.choice([n // 50, n // 10, n // 4])))
        rows.append(features(made, seen, seen if low else 0, word, n, likely))
        classes.append(1.0)
        pool = [s for g in r.sample(grams(word), min(3, len(word))) for s in r.sample(near.get(g, []), min(2, len(near.get(g, []))))]
        for other, on, _ in pool:
            # a pair that looks like a misread word and its original, though well known, teaches nothing
            if other != word and not (on >= 20 * n and distance(word, other)[0] <= 0.5):
                rows += [features(made, seen, seen if low else 0, other, max(on, BETTER * seen), likely), features(word, n, low, other, max(on, BETTER * n), likely)]
                classes += [0.0, 0.0]
    if not rows or len(set(classes)) < 2:
        rows += [features("sentencc", 1, 1, "sentence", 50, likely), features("senate", 9, 9, "sentence", 50, likely)] * 8
        classes += [1.0, 0.0] * 8
    return Boosted(trees=80).fit(np.array(rows), np.array(classes))


def undone(word: str) -> list[str]:
    """The word with one confusion undone, at every place where it may be."""
    return sorted({word[:i] + true + word[i + len(read) :] for read, true in CONFUSIONS for i in range(len(word) - len(read) + 1) if word[i : i + len(read)] == read})


def suspicious(word: str, n: int, low: int, likely: Likely, sure: float) -> bool:
    """Whether a word is looked up at all: seldom and, if it may be a name, with an unusual sequence of characters."""
    if not word.isalpha() or any(c.isupper() for c in word[1:]):
        return len(word) >= 3 and sum(c.isalpha() for c in word) >= 2
    if n >= sure or len(word) < 3:
        return False
    return low * 2 >= n or likely.rarest(word) <= 3


def reread(word: str, likely: Likely) -> str | None:
    """The word with one confusion undone, where that turns an impossible sequence of characters into usual ones.

    Names that stand nowhere else have no candidate to retrieve; the trigrams of known words judge them.
    """
    odd = [i for i, c in enumerate(word) if not c.isalpha() or i and c.isupper()]
    if not odd and likely.rarest(word) > 0 or len(odd) > 2 or len(word) < 5:
        return None
    best: tuple[int, str] = (LEAST_USUAL - 1, "")
    for read, true in CONFUSIONS:
        for i in range(len(word) - len(read) + 1):
            if word[i : i + len(read)] == read and (not odd or i in odd):
                made = word[:i] + true + word[i + len(read) :]
                best = max(best, (likely.rarest(made), made)) if made.isalpha() else best
    return best[1] or None


def _reread(likely: Likely):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, t, 0.0) for w in batch.column("word").to_pylist() if (t := reread(w, likely))]
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.float64()))], names=["word", "true", "chance"])

    return run


def _suspects(likely: Likely, sure: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, n, low, sorted(set(grams(w))), undone(w)) for w, n, low in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "low"))) if "-" not in w and suspicious(w, n, low, likely, sure)]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())))], names=["word", "n", "low", "grams", "undone"])

    return run


def _known_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(w, n, sorted(set(grams(w)))) for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()) if w.isalpha() and len(w) >= 3]
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.list_(pa.string())))], names=["true", "true_n", "grams"])


def _rank(model: Boosted, likely: Likely):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kept = [], []
            for word, n, low, true, true_n in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "low", "true", "true_n"))):
                f = features(word, n, low, true, true_n, likely)
                if f[0] <= 1.0:
                    rows.append(f)
                    kept.append((word, true))
            chance = model.predict(np.array(rows)) if rows else np.zeros(0)
            good = [(w, t, float(c)) for (w, t), c in zip(kept, chance) if c >= model.threshold]
            columns = list(zip(*good)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.float64()))], names=["word", "true", "chance"])

    return run


def salted(asked: DataFrame, held: DataFrame, key: str, salts: int = 8) -> DataFrame:
    """asked joined with held by a key that either side may hold often: each row of held meets asked in ``salts`` parts."""
    left = asked.withColumn("_salt", F.pmod(F.xxhash64(*asked.columns), F.lit(salts)).cast("int"))
    right = held.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return left.join(right, [key, "_salt"]).drop("_salt")


def thresholds(words: DataFrame) -> tuple[float, float]:
    """Occurrences from which a word is known, and beyond doubt; both grow with the collection."""
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return max(KNOWN_FROM, KNOWN_SHARE * total), max(SURE_FROM, SURE_SHARE * total)


def corrections(words: DataFrame) -> DataFrame:
    """(word, true): the misread words of a vocabulary, each with its best replacement."""
    spark = words.sparkSession
    known_from, sure = thresholds(words)
    known = words.filter((F.col("n") >= known_from) & ~F.col("word").contains("-"))
    parts = known.filter(F.col("word").rlike(r"^\p{L}+$")).select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.substring(F.concat(F.lit("^"), F.lower("word"), F.lit("$")), i, F.lit(3)))).alias("p"))
    likely = Likely({r["p"]: r["count"] for r in parts.groupBy("p").count().collect()})  # trigrams of an alphabet
    # by hash: the same words on every run and at every size
    sample = [tuple(r) for r in known.select("word", "n", "low").orderBy(F.xxhash64("word")).limit(SAMPLE_WORDS).collect()]
    model = fit_words(sample, likely)
    suspects = materialize(words.mapInArrow(_suspects(likely, sure), "word string, n long, low long, grams array<string>, undone array<string>"), "suspects")
    targets = known.select("word", "n").mapInArrow(_known_grams, "true string, true_n long, grams array<string>")
    inverted = targets.select("true", "true_n", F.length("true").alias("true_size"), F.size("grams").alias("true_of"), F.explode("grams").alias("gram"))
    asked = suspects.select("word", "n", "low", F.length("word").alias("size"), F.size("grams").alias("of"), F.explode("grams").alias("gram"))
    met = salted(asked, inverted, "gram").filter((F.abs(F.col("size") - F.col("true_size")) <= 1) & (F.col("word") != F.col("true")) & (F.col("true_n") >= BETTER * F.col("n")))
    shared = met.groupBy("word", "n", "low", "of", "true", "true_n").agg(F.count("*").alias("shared")).filter(F.col("shared") * 10 >= F.col("of") * 4).select("word", "n", "low", "true", "true_n")
    # what differs by one confusion is met whatever grams that leaves
    near = suspects.select("word", "n", "low", F.explode("undone").alias("true")).join(targets.select("true", "true_n"), "true").filter((F.col("word") != F.col("true")) & (F.col("true_n") >= BETTER * F.col("n")))
    shared = shared.unionByName(near).distinct()
    ranked = shared.repartition(slices(spark)).mapInArrow(_rank(model, likely), "word string, true string, chance double")
    ranked = ranked.unionByName(suspects.select("word").mapInArrow(_reread(likely), "word string, true string, chance double"))
    return ranked.groupBy("word").agg(F.max(F.struct("chance", "true")).alias("b")).select("word", F.col("b.true").alias("true"))


# --- joins ---------------------------------------------------------------------------------------


def join_features(mark: str, a: str, b: str, whole: int, left: int, right: int, compound: int) -> list[float]:
    return [float(mark in "-–"), float(mark in "­¬‐"), math.log1p(whole), math.log1p(left), math.log1p(right), math.log1p(compound), math.log1p(whole) - math.log1p(compound), float(len(a)), float(len(b)), float(b[:1].isupper()), float(bool(b))]


def fit_joins(words: list[tuple[str, int, int]]) -> Boosted:
    """Known words cut by rule are cases; compounds broken at their own hyphen are none."""
    r = random.Random(5)
    counts = {w: n for w, n, _ in words}
    compounds = [w for w in counts if w.count("-") == 1]
    plain = sorted(w for w in counts if w.isalpha() and len(w) >= 5)
    rows, classes = [], []
    for w in plain:
        k = r.randrange(2, len(w) - 1)
        mark = r.choice("---‐­¬")
        seen = r.random() > 0.25  # words, names above all, may stand nowhere else
        rows.append(join_features(mark, w[:k], w[k:], counts[w] if seen else 0, counts.get(w[:k], 0), counts.get(w[k:], 0), counts.get(f"{w[:k]}-{w[k:]}", 0)))
        classes.append(1.0)
    for _ in range(max(1, len(plain) // max(1, len(compounds)))):
        for w in sorted(compounds):
            a, b = w.split("-")
            seen = r.random() > 0.15
            rows.append(join_features(r.choice("----‐"), a, b, counts.get(a + b, 0), max(1, counts.get(a, 0)), max(1, counts.get(b, 0)), counts[w] if seen else 0))
            classes.append(0.0)
    for a, b in (("read", "only"), ("half", "elf")) * 4:
        rows += [join_features("-", a, b, 0, 20, 20, 9), join_features("-", a + b, "tion", 30, 0, 0, 0)]
        classes += [0.0, 1.0]
    return Boosted().fit(np.array(rows), np.array(classes))


def _page_tokens(known: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strange: dict[str, tuple[str, ...]] = {}  # the unknown words of a token, mostly none

        def unknown(token: str, line: str) -> tuple[str, ...]:
            if token[0] in "!(":
                return tuple(w for w, _ in _units_of(token, line)[0] if w not in known)
            if token not in strange:
                if len(strange) > 1 << 18:
                    strange.clear()
                strange[token] = tuple(w for w, _ in _units(token)[0] if w not in known)
            return strange[token]

        for batch in batches:
            out: list[tuple] = []
            for page_id, text in zip(batch.column("page_id").to_pylist(), batch.column("text").to_pylist()):
                lines = page_lines(text)
                skip = -1
                for i, line in enumerate(lines):
                    tokens, cut = line.split(), _cut(line)
                    own = tokens[skip == i : len(tokens) - (cut is not None)]
                    found = {w for token in own for w in unknown(token, line)}
                    out += [("word", page_id, i + 1, w, None, None) for w in found]
                    if cut:
                        skip = _next_body(lines, i) or -1
                for i, line in enumerate(lines):
                    if cut := _cut(line):
                        follow = _next_body(lines, i)
                        rest = lines[follow].split()[0].strip(_OUTER) if follow is not None else ""
                        rest = _SPLIT.split(rest)[0] if rest else ""
                        out.append(("cut", page_id, i + 1, cut[0], rest, cut[1]))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()))], names=["kind", "page_id", "line_no", "word", "other", "mark"])

    return run


def _judge_joins(model: Boosted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("mark", "a", "b", "whole", "left", "right", "compound")]
            rows = [join_features(*x) for x in zip(*cols)]
            hit = model.holds(np.array(rows)) if rows else np.zeros(0, bool)
            yield batch.select(["page_id", "line_no"]).take(pa.array(np.flatnonzero(hit)))

    return run


def cut_lines(cuts: DataFrame, words: DataFrame, model: Boosted) -> DataFrame:
    """(page_id, line_no) of the lines whose last word goes on in the next line."""
    keyed = cuts.select("page_id", "line_no", "mark", F.lower("word").alias("a"), F.col("other").alias("b"))
    low = F.lower("b")
    asked = keyed.select("page_id", "line_no", F.explode(F.array(
        F.struct(F.lit("whole").alias("role"), F.concat("a", low).alias("word")), F.struct(F.lit("left").alias("role"), F.col("a").alias("word")),
        F.struct(F.lit("right").alias("role"), low.alias("word")), F.struct(F.lit("compound").alias("role"), F.concat("a", F.lit("-"), low).alias("word")),
    )).alias("k")).select("page_id", "line_no", "k.role", "k.word")
    counted = asked.join(words.select("word", "n"), "word").groupBy("page_id", "line_no").agg(*[F.max(F.when(F.col("role") == r, F.col("n"))).alias(r) for r in ("whole", "left", "right", "compound")])
    full = keyed.join(counted, ["page_id", "line_no"], "left").na.fill(0, ["whole", "left", "right", "compound"])
    return full.mapInArrow(_judge_joins(model), "page_id long, line_no int")


# --- furniture -----------------------------------------------------------------------------------


def as_number(text: str) -> tuple[int, float] | None:
    """(value, how plainly it is a page number) of a text that is one in some notation."""
    text = text.strip()
    m = _NUMBER.match(text)
    if not m:
        return None
    core = m.group(1)
    dressed = float(len(text) > len(core))
    if core.isdigit():
        return int(core), 1.0 + dressed
    if _ROMAN.match(core.lower()):
        value, last = 0, 0
        for c in reversed(core.lower()):
            v = dict(i=1, v=5, x=10, l=50, c=100, d=500, m=1000)[c]
            value, last = (value - v, last) if v < last else (value + v, v)
        # a lone stroke may be a misread one
        return value if core.lower() != "l" else 1, 0.5 + dressed
    digits = core.translate(str.maketrans("lIO|!", "11011"))
    return (int(digits), 0.5 + dressed) if digits.isdigit() else None


def parts_of(line: str) -> tuple[str, tuple[int, float] | None]:
    """(the line without the page number in it, that number)."""
    whole = as_number(line)
    if whole:
        return "", whole
    pieces = [p for p in _GAP.split(line.strip()) if p]
    if len(pieces) > 1:
        for k in (0, len(pieces) - 1):
            number = as_number(pieces[k])
            if number:
                return " ".join(p for i, p in enumerate(pieces) if i != k), number
    return line.strip(), None


def canonical(head: str) -> str:
    """A heading as it looks, so that most misread copies agree."""
    return re.sub(r"[^\w]|\d|_", "", re.sub(r"rn|ii", "m", head.lower()).translate(LOOKS))


def edges(lines: list[str]) -> list[tuple[int, int, bool]]:
    """(index, place: 0, 1 .. from the top, -1, -2 .. from the bottom, whether a blank line or the edge separates it).

    The first ``EDGE`` non-blank lines of either edge, and those that follow on them while all are short.
    """
    full = [i for i, line in enumerate(lines) if line.strip()]
    sizes = [len(lines[i].rstrip()) for i in full]
    width = sorted(sizes)[len(sizes) * 3 // 4] if sizes else 0
    n = len(full)

    def block(own: list[int]) -> int:
        short = 0
        while short < n and own[short] < SHORT * width:
            short += 1
        return max(min(EDGE, n), short)

    top, bottom = block(sizes), block(sizes[::-1])
    out = []
    for k, i in enumerate(full):
        if k < top or k >= n - bottom:
            place = k if k < top and (k < n - bottom or k <= n - 1 - k) else k - n
            gap = (i + 1 >= len(lines) or not lines[i + 1].strip()) if place >= 0 else (i == 0 or not lines[i - 1].strip())
            out.append((i, place, gap))
    return out


EDGES = "pdf_id long, page_id long, page_no int, line_no int, place int, apart boolean, line string, head string, shape string, number long, plain double, listed boolean, width int"


def _edge_rows(pdf_id: int | None, page_id: int, page_no: int | None, text: str | None) -> list[tuple]:
    lines = page_lines(text)
    out = []
    widths = sorted(len(x.rstrip()) for x in lines if x.strip())
    width = widths[len(widths) * 3 // 4] if widths else 0
    for i, place, apart in edges(lines):
        head, number = parts_of(lines[i])
        before = lines[i - 1].strip() if i else ""
        earlier = lines[i - 2].strip() if i > 1 else ""
        # a number below a short line that itself stands below a number is in a list
        listed = 0 < len(before.split()) <= 2 and as_number(earlier) is not None
        out.append((pdf_id, page_id, page_no, i + 1, place, apart, lines[i], head, canonical(head), number[0] if number else None, number[1] if number else None, listed, width))
    return out


def _edge_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.bool_(), pa.int32())
    names = [c.split()[0] for c in EDGES.split(", ")]
    for batch in batches:
        rows = [r for x in zip(*(batch.column(c).to_pylist() for c in ("pdf_id", "page_id", "page_no", "text"))) for r in _edge_rows(*x)]
        columns = list(zip(*rows)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def likeness(a: str, b: str) -> float:
    """Characters two shapes have in common order, as a share of both."""
    if a == b:
        return 1.0
    total = len(a) + len(b)
    if 2 * min(len(a), len(b)) < PAIR_FROM * total:
        return 0.0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        if c in places:
            hit = state & places[c]
            state = ((state + hit) | (state - hit)) & full
    return 2 * (len(a) - state.bit_count()) / total


def shape_grams(shape: str) -> list[str]:
    text = f"^{shape}$"
    return sorted({text[i : i + Q] for i in range(len(text) - Q + 1)})


def rarest_grams(shape: str, usual: np.ndarray) -> list[int]:
    """The rarest grams of a shape, so many that two shapes a few edits apart share one: an edit changes ``Q`` of them at most."""
    found = sorted({crc32(g.encode()) for g in shape_grams(shape)}, key=lambda g: (usual[g % GRAM_BUCKETS], g))
    return found[: (len(shape) // 5 + 1) * Q + 1]


def header_features(head: str, place: int, apart: bool, width: int, best: float, support: int, pages: int) -> list[float]:
    """Of the pair (line, the recurring line of its file most like it); support counts the pages of all recurring lines like it."""
    words = head.split()
    return [best, float(support), support / max(1, pages), float(place == 0), float(place == -1), float(min(place if place >= 0 else -1 - place, 4)), float(apart), float(len(words)), len(head) / max(1, width), float(head[-1:] in ".,;:?!"), sum(w[:1].isupper() for w in words) / max(1, len(words)), float(head.isupper())]


def number_features(number: int, plain: float, place: int, apart: bool, listed: bool, alone: bool, same: int, near: int, total: int, pages: int) -> list[float]:
    """Of the pair (number of a line, numbering of its file): pages of the same numbering, of those at most 2 off, of all."""
    return [float(same), float(near), near / max(1, total), near / max(1, pages), plain, float(place in (0, -1)), float(place < 0), float(min(place if place >= 0 else -1 - place, 4)), float(apart), float(listed), float(alone), float(number)]


def _made_book(r: random.Random) -> tuple[list[tuple[int, str]], dict[tuple[int, int], set[str]]]:
    """Pages of a made-up book, and the kinds of its lines of furniture by (page, line)."""
    word = lambda: "".join(r.choice("mor vel tar an ish dun gal ric os fen kar lin bar tho we qui".split()) for _ in range(r.randrange(1, 4)))
    title = lambda: r.choice([f"The {word()} {word()} of {word().capitalize()}", f"{word().capitalize()} {word().capitalize()}", f"Chapter {r.randrange(1, 20)}: {word()} {word()}"])
    upper = r.random() < 0.3
    chapters = [[title(), title()] if r.random() < 0.5 else [title()] * 2 for _ in range(r.choice([1, 1, 1, 2, 3, 5]))]
    above = title() if r.random() < 0.15 else ""  # a line that stands over the header on every page
    has_head, has_number = r.random() < 0.7, r.random() < 0.75
    style = r.choice(["{}", "[{}]", "- {} -", "— {} —", "Page {}", "p. {} of 99", "{} |", "roman"])
    together, bottom = r.random() < 0.3, r.random() < 0.6
    first, pages, kinds, last = r.choice([0, 0, 1, 2, 10, 100, 120]), [], {}, r.randrange(4, 34)
    shift, closing = 0, word() if r.random() < 0.6 else ""
    for page_no in range(1, last):
        heads = chapters[page_no * len(chapters) // last]
        shift += r.random() < 0.05
        width = r.randrange(50, 75)
        body = []
        for _ in range(r.randrange(5, 40)):
            if r.random() < 0.15:
                body.append("")
            line = " ".join(word() for _ in range(width // 7))
            body.append(line.capitalize() if r.random() < 0.2 else line + r.choice(["", "", ".", ","]))
        if r.random() < 0.2:
            rows = [x for _ in range(r.randrange(2, 5)) for x in (word(), str(r.randrange(2, 300)))]
            body += ["", *rows] if r.random() < 0.5 else [""]
            body = body if r.random() < 0.5 else [*rows, "", *body]
        if closing and r.random() < 0.3:
            body.append(r.choice([f"{closing} {word()[:1].upper()}{r.randrange(1, 30)}.", f"{closing} {word()}.", f"{closing} {r.randrange(1, 30)}."]))
        if r.random() < 0.2:
            body = [title(), "", *body]
        n = first + page_no + shift
        roman = "".join(s * (n // v % k) for v, s, k in ()) or _roman(n)
        number = (roman if style == "roman" else style.format(n)) if has_number and r.random() < 0.92 else ""
        head = heads[page_no % 2] if has_head and r.random() < 0.92 else ""
        head = head.upper() if upper else head
        if r.random() < 0.25:
            for _ in range(r.randrange(1, 3)):
                head = corrupted(head, r) or head
        if r.random() < 0.05 and number:
            number = number.replace("1", "l", 1)
        top, foot = [], []
        if together and head and number:
            top = [(f"{head}    {number}" if page_no % 2 else f"{number}    {head}", {"header", "page_number"})]
        else:
            top = [(head, {"header"})] if head else []
            if number:
                (foot if bottom else top).append((number, {"page_number"}))
        if above and top:
            top.insert(0, (above, {"header"}))
        gap = [""] * r.randrange(0, 2)
        lines = [t for t, _ in top] + gap + body + gap + [t for t, _ in foot]
        for k, (_, kind) in enumerate(top):
            kinds[page_no, k] = kind
        for k, (_, kind) in enumerate(foot):
            kinds[page_no, len(lines) - len(foot) + k] = kind
        pages.append((page_no, "\n".join(lines)))
    return pages, kinds


def _roman(n: int) -> str:
    out = ""
    for v, s in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out, n = out + s * (n // v), n % v
    return out


@lru_cache(maxsize=1)
def line_models() -> tuple[Boosted, Boosted]:
    """(header, page number), fitted on made-up books."""
    r = random.Random(3)
    rows: tuple[list, list] = ([], [])
    classes: tuple[list, list] = ([], [])
    for _ in range(SAMPLE_BOOKS):
        pages, kinds = _made_book(r)
        found = [row for page_no, text in pages for row in _edge_rows(0, page_no, page_no, text)]
        shapes = Counter(shape for _, shape in {(row[2], row[8]) for row in found if len(row[8]) >= 4})
        offs = Counter(off for _, off in {(row[2], row[9] - row[2]) for row in found if row[9] is not None})
        recurring, numberings = [(s, n) for s, n in shapes.items() if n > 1], {o: n for o, n in offs.items() if n > 1}
        for _, page_no, _, line_no, place, apart, _, head, shape, number, plain, listed, width in found:
            kind = kinds.get((page_no, line_no - 1), set())
            alike = [(x, n) for s, n in recurring if (x := likeness(shape, s)) >= PAIR_FROM] if head and len(shape) >= 4 else []
            if alike:
                rows[0].append(header_features(head, place, apart, width, max(x for x, _ in alike), sum(n for _, n in alike), len(pages)))
                classes[0].append(float("header" in kind))
            if number is not None:
                off = number - page_no
                near = sum(numberings.get(off + k, 0) for k in range(-2, 3))
                rows[1].append(number_features(number, plain, place, apart, listed, not head, numberings.get(off, 0), near, sum(numberings.values()), len(pages)))
                classes[1].append(float("page_number" in kind))
    return Boosted().fit(np.array(rows[0]), np.array(classes[0])), Boosted().fit(np.array(rows[1]), np.array(classes[1]))


def _judge(model: Boosted, kind: str, names: list[str], features):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(*x) for x in zip(*(batch.column(c).to_pylist() for c in names))]
            hit = pa.array(np.flatnonzero(model.holds(np.array(rows))) if rows else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id").take(hit), batch.column("line_no").take(hit), pa.array([kind] * len(hit), pa.string())], names=["page_id", "line_no", "noise_kind"])

    return run


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(GRAM_BUCKETS, np.int64)
    for batch in batches:
        for shape in batch.column("shape").to_pylist():
            for g in shape_grams(shape):
                counts[crc32(g.encode()) % GRAM_BUCKETS] += 1
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["bucket", "n"])


def _key_grams(usual: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([rarest_grams(s, usual) for s in batch.column("shape").to_pylist()], pa.list_(pa.int64()))], names=["pdf_id", "shape", "n", "grams"])

    return run


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [likeness(a, b) for a, b in zip(batch.column("shape").to_pylist(), batch.column("other").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=["pdf_id", "shape", "other", "m", "alike"])


def recurring_lines(shapes: DataFrame) -> DataFrame:
    """(pdf_id, shape, best, support) of the shapes that are like a recurring one of their file. shapes: (pdf_id, shape, n).

    Every distinct shape meets the recurring ones of its file that share one of its rarest grams; likeness decides. A shape that
    itself recurs is like itself.
    """
    spark = shapes.sparkSession
    # a line longer than all recurring ones of its file is like none of them
    longest = shapes.filter("n > 1").groupBy("pdf_id").agg(F.max(F.length("shape")).alias("longest"))
    shapes = shapes.join(longest, "pdf_id").filter(F.length("shape") * 4 <= F.col("longest") * 5 + 5).select("pdf_id", "shape", "n")
    counted = shapes.select("shape").mapInArrow(_count_grams, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # GRAM_BUCKETS rows at most
    usual = np.zeros(GRAM_BUCKETS, np.int64)
    usual[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    keyed = materialize(shapes.repartition(slices(spark)).mapInArrow(_key_grams(usual), "pdf_id long, shape string, n long, grams array<long>"), "shapes")
    asked = keyed.select("pdf_id", "shape", F.explode("grams").alias("gram"))
    held = keyed.filter("n > 1").select("pdf_id", F.col("shape").alias("other"), F.col("n").alias("m"), F.explode("grams").alias("gram"))
    size = F.abs(F.length("shape") - F.length("other")) <= F.greatest(F.length("shape"), F.length("other")) / 5 + 1
    met = asked.join(held, ["pdf_id", "gram"]).filter((F.col("shape") != F.col("other")) & size).select("pdf_id", "shape", "other", "m").distinct()
    alike = met.mapInArrow(_alike, "pdf_id long, shape string, other string, m long, alike double").filter(F.col("alike") >= PAIR_FROM).select("pdf_id", "shape", "alike", "m")
    own = keyed.filter("n > 1").select("pdf_id", "shape", F.lit(1.0).alias("alike"), F.col("n").alias("m"))
    return alike.unionByName(own).groupBy("pdf_id", "shape").agg(F.max("alike").alias("best"), F.sum("m").alias("support"))


def with_lookup(rows: DataFrame, lookup: DataFrame, keys: list[str], total: int) -> DataFrame:
    """rows joined with lookup, which has each key once and tells by ``rows`` how many rows have it.

    Keys of at least ``HOT_SHARE`` of all rows, of which there is a bounded number, are sent to their rows; the others meet by shuffle.
    """
    least = max(2, int(total * HOT_SHARE))
    hot, cold = lookup.filter(F.col("rows") >= least).drop("rows"), lookup.filter(F.col("rows") < least).drop("rows")
    return rows.join(F.broadcast(hot), keys).unionByName(rows.join(cold, keys))


def furniture(pages: DataFrame) -> DataFrame:
    """(page_id, line_no, noise_kind): running headers and page numbers.

    Recurring lines and numberings are counted by file and joined to the lines they belong to, all of them; a file of any length
    and any number of headers gives rows of fixed size.
    """
    # rows without a file belong to a file of their own
    found = materialize(pages.select("pdf_id", "page_id", "page_no", "text").mapInArrow(_edge_pass, EDGES).withColumn("pdf_id", F.coalesce("pdf_id", F.lit(-1))).withColumn("off", F.col("number") - F.col("page_no")), "edges")
    total = found.count()
    sizes = found.groupBy("pdf_id").agg(F.countDistinct("page_no").alias("pages"), F.count("*").alias("rows"))
    shapes = materialize(found.filter(F.length("shape") >= 4).groupBy("pdf_id", "shape").agg(F.countDistinct("page_no").alias("n"), F.count("*").alias("rows")), "line-shapes")
    offs = materialize(found.filter("off is not null").groupBy("pdf_id", "off").agg(F.countDistinct("page_no").alias("n"), F.count("*").alias("rows")), "numberings")
    kept = offs.filter("n > 1")
    files = materialize(sizes.join(kept.groupBy("pdf_id").agg(F.sum("n").alias("total")), "pdf_id", "left").na.fill(0, ["total"]), "files")
    alike = materialize(recurring_lines(shapes.select("pdf_id", "shape", "n")), "recurring")
    headed = materialize(with_lookup(alike.join(shapes.select("pdf_id", "shape", F.col("rows").alias("held")), ["pdf_id", "shape"]), files, ["pdf_id"], total).withColumnRenamed("held", "rows"), "headed")
    around = kept.select("pdf_id", F.explode(F.array(*[F.col("off") + k for k in range(-2, 3)])).alias("off"), "n").groupBy("pdf_id", "off").agg(F.sum("n").alias("near"))
    numbered = offs.select("pdf_id", "off", F.when(F.col("n") > 1, F.col("n")).otherwise(0).alias("same"), F.col("rows").alias("held")).join(around, ["pdf_id", "off"], "left").na.fill(0, ["near"])
    numbered = materialize(with_lookup(numbered, files, ["pdf_id"], total).withColumnRenamed("held", "rows"), "numbered")
    models, schema = line_models(), "page_id long, line_no int, noise_kind string"
    heads = with_lookup(found.filter("head <> ''").select("pdf_id", "shape", "page_id", "line_no", "head", "place", "apart", "width"), headed, ["pdf_id", "shape"], total)
    numbers = with_lookup(found.filter("off is not null").select("pdf_id", "off", "page_id", "line_no", "number", "plain", "place", "apart", "listed", (F.col("head") == "").alias("alone")), numbered, ["pdf_id", "off"], total)
    return heads.mapInArrow(_judge(models[0], "header", ["head", "place", "apart", "width", "best", "support", "pages"], header_features), schema).unionByName(
        numbers.mapInArrow(_judge(models[1], "page_number", ["number", "plain", "place", "apart", "listed", "alone", "same", "near", "total", "pages"], number_features), schema)
    )


# --- the operator --------------------------------------------------------------------------------


def _clean(pages: DataFrame) -> DataFrame:
    kinds = {"page_id": "long", "pdf_id": "long", "page_no": "int", "text": "string"}
    have = set(pages.columns)
    full = pages.select(*[(F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in kinds.items()])
    return full.filter(F.col("page_id").isNotNull() & F.col("text").isNotNull()).dropDuplicates(["page_id"])


def analysis(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(noise: page_id, line_no, noise_kind; fixes: page_id, line_no, word, true)."""
    texts = _clean(pages)
    words = materialize(vocabulary(texts), "vocabulary")
    fixes = materialize(corrections(words), "corrections")
    known_from, _ = thresholds(words)
    sure = words.filter(F.col("n") >= known_from).join(fixes, "word", "left_anti")
    known = [r["word"] for r in sure.orderBy(F.desc("n"), "word").limit(KNOWN_WORDS).select("word").collect()]
    sample = [tuple(r) for r in words.filter((F.col("n") >= known_from) | F.col("word").contains("-")).orderBy(F.xxhash64("word")).limit(SAMPLE_WORDS).collect()]
    tokens = materialize(texts.select("page_id", "text").mapInArrow(_page_tokens(frozenset(known)), TOKENS), "tokens")
    lines = furniture(texts)
    lines = materialize(lines.distinct(), "furniture")
    wrong = materialize(tokens.filter("kind = 'word'").join(fixes, "word").select("page_id", "line_no", "word", "true"), "wrong")
    cuts = cut_lines(tokens.filter("kind = 'cut'"), words, fit_joins(sample))
    body = wrong.select("page_id", "line_no").distinct().join(lines, ["page_id", "line_no"], "left_anti").withColumn("noise_kind", F.lit("misread"))
    noise = lines.unionByName(body).unionByName(cuts.distinct().withColumn("noise_kind", F.lit("hyphen")))
    return noise, wrong


def found(pages: DataFrame) -> DataFrame:
    """(page_id, line_no, noise_kind). Pages without text have no lines; a page in two equal rows counts once."""
    return analysis(pages)[0]


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page_id, text, noise, fixes in zip(*(batch.column(c).to_pylist() for c in ("page_id", "text", "noise", "fixes"))):
            kinds: dict[int, set[str]] = {}
            for n in noise or ():
                kinds.setdefault(n["line_no"], set()).add(n["noise_kind"])
            swaps: dict[int, dict[str, str]] = {}
            for f in fixes or ():
                swaps.setdefault(f["line_no"], {})[f["word"]] = f["true"]
            out.append((page_id, repaired(page_lines(text), kinds, swaps)))
        columns = list(zip(*out)) or [()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], names=["page_id", "repaired"])


def repaired(lines: list[str], kinds: dict[int, set[str]], swaps: dict[int, dict[str, str]]) -> str:
    """Continuous paragraphs: furniture left out, cut words joined, misread words replaced, lines of a paragraph in one."""
    paragraphs: list[str] = [""]
    joined = False
    for i, line in enumerate(lines, 1):
        noise = kinds.get(i, set())
        if noise & {"header", "page_number"}:
            continue
        for word, true in swaps.get(i, {}).items():
            line = re.sub(rf"(?<!\w){re.escape(word)}(?!\w)", lambda m, t=true: t.upper() if m.group().isupper() and len(t) > 1 else t.capitalize() if m.group()[:1].isupper() else t, line, flags=re.I)
        text = line.strip()
        if not text:
            if paragraphs[-1] and not joined:
                paragraphs.append("")
            continue
        paragraphs[-1] += text if joined or not paragraphs[-1] else " " + text
        joined = "hyphen" in noise
        if joined:
            paragraphs[-1] = paragraphs[-1].rstrip()[:-1]
    return "\n\n".join(p for p in paragraphs if p)


def repaired_pages(pages: DataFrame) -> DataFrame:
    """(page_id, repaired) of every page with text."""
    noise, wrong = analysis(pages)
    texts = _clean(pages).select("page_id", "text")
    by_page = noise.groupBy("page_id").agg(F.collect_list(F.struct("line_no", "noise_kind")).alias("noise"))
    swaps = wrong.groupBy("page_id").agg(F.collect_list(F.struct("line_no", "word", "true")).alias("fixes"))
    return texts.join(by_page, "page_id", "left").join(swaps, "page_id", "left").mapInArrow(_repair, "page_id long, repaired string")
