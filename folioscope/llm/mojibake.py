"""Problem 10: text that was decoded with the wrong encoding.

Method: units of text (lines and words) are joined on what is left of them without non-ASCII characters.
Units that agree there but differ in the characters taken out are twins. Aligning their characters gives pairs of a garbled
form and a clean character; the wrong decodings that explain enough of these pairs, of all that Python's codecs can make, carry
what was learned over to the other characters of the collection. Pairs that no decoding explains are kept as they are, if they
are frequent. The mappings are applied to all records, with or without a twin.

Clean characters are learned as well: a mapping is only applied if its result is a character that the
collection's own clean text uses. A form of a single character, which may stand rightly elsewhere, is put right only between
neighbours where the collection has the clean character far more often, or within a word of another script.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from encodings.aliases import aliases
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.runtime import materialize

#: Charsets that text is commonly in or taken for; of decodings that explain alike the first counts.
COMMON = ["cp1252", "latin_1", "mac_roman", "cp850", "cp437", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "iso8859_2", "iso8859_15", "koi8_r", "cp866", "gbk", "big5", "shift_jis", "euc_kr"]
LOST = "�"
#: Typographic characters that count as clean even where the collection has no clean example.
TYPOGRAPHIC = "–—‘’‚“”„…•€™«»"
#: Distinct twin units that must speak for a decoding, and words that must show a clean character.
LEAST_SUPPORT = 3
LEAST_WORDS = 2
#: Units on which a pair must stand to be collected, and to be kept without a decoding that explains it.
LEAST_PAIR, LEAST_UNEXPLAINED = 1, 20
#: How many times more often a clean character stands between two neighbours than the form that is put right there.
CLEARER = 3
OTHERS = "[^\\x00-\\x7F]+"

_RUN = re.compile(OTHERS)
_QUOTED = re.compile(r"(?<!`)`[^`\n]+`(?!`)")
_WORD = re.compile(r"\S*[^\x00-\x7f\s]\S*")


#: Steps of (charset the text was in, charset it was taken for).
Chain = tuple[tuple[str, str], ...]


@lru_cache(maxsize=None)
def _byte_table(charset: str) -> tuple[str, ...] | None:
    """What each byte becomes, undefined bytes the control of the same number; None for charsets of several bytes."""
    table = []
    for b in range(256):
        try:
            table.append(bytes([b]).decode(charset))
        except UnicodeDecodeError:
            table.append(chr(b))
    try:
        # in a charset of several bytes, some byte alone is no character though a pair is
        several = any(len(bytes([b, 0xB0]).decode(charset, "ignore")) == 1 and b >= 0x80 for b in range(0x80, 0xFF)) and len(bytes([0xC3, 0xA9]).decode(charset, "replace")) == 1
    except UnicodeError:
        several = True
    return None if several else tuple(table)


def misread(text: str, chain: Chain | tuple[str, ...]) -> str:
    """Text as it looks after it went through each step of the chain. A step that is a name alone took UTF-8 for that charset."""
    for step in chain:
        true, wrong = ("utf-8", step) if isinstance(step, str) else step
        try:
            data = text.encode(true, "surrogatepass" if true == "utf-8" else "strict")
        except UnicodeEncodeError:
            return LOST
        table = _byte_table(wrong)
        text = data.decode(wrong, "replace") if table is None else "".join(table[b] for b in data)
    return text


@lru_cache(maxsize=1)
def charsets() -> tuple[str, ...]:
    """All charsets of Python that keep ASCII, common ones first."""
    plain = "".join(map(chr, range(0x20, 0x7F)))
    found = []
    for name in [*COMMON, *sorted(set(aliases.values()))]:
        try:
            info = codecs.lookup(name)
            if info.name not in found and info._is_text_encoding and "utf" not in info.name and plain.encode(name).decode(name) == plain and plain.encode(name) == plain.encode("ascii") and "é".encode("ascii", "ignore") == b"":
                found.append(info.name)
        except (LookupError, UnicodeError, AttributeError):
            continue
    return tuple(found)


def chains() -> Iterator[Chain]:
    """UTF-8 taken for a charset, once or twice, and a charset taken for another."""
    for wrong in charsets():
        yield (("utf-8", wrong),)
    for wrong in charsets():
        yield (("utf-8", wrong), ("utf-8", wrong))
    for true in charsets():
        if _byte_table(true) is not None:
            for wrong in charsets():
                if wrong != true:
                    yield ((true, wrong),)


def explaining(pairs: dict[tuple[str, str], int]) -> tuple[list[Chain], set[tuple[str, str]]]:
    """(decodings, the pairs they explain) of aligned pairs (garbled form, clean character) and their support.

    The decoding that explains most is taken, then the one that explains most of the rest, as long as what it adds has
    ``LEAST_SUPPORT``; one that swaps single characters must explain two of them at least.
    """
    by_letter: dict[str, list[str]] = {}
    for form, letter in pairs:
        by_letter.setdefault(letter, []).append(form)
    explained: list[tuple[Chain, frozenset[tuple[str, str]]]] = []
    for chain in chains():
        made = {letter: misread(letter, chain) for letter in by_letter}
        own = frozenset((form, letter) for letter, form in made.items() if (form, letter) in pairs and form != letter)
        if own:
            explained.append((chain, own))
    taken: list[Chain] = []
    done: set[tuple[str, str]] = set()
    while explained:
        gains = [(sum(pairs[p] for p in own - done), -i) for i, (_, own) in enumerate(explained)]
        gain, at = max(gains)
        chain, own = explained[-at]
        new = own - done
        if gain < LEAST_SUPPORT:
            break
        explained.pop(-at)
        if any(len(form) > 1 for form, _ in new) or len(own) >= 2 and len(new) >= 1 and sum(len(form) == 1 for form, _ in own) >= 2:
            taken.append(chain)
            done |= own
    return taken, done


def _units(docs: DataFrame) -> DataFrame:
    """(kind, skeleton, runs, n): distinct lines and words with other than ASCII characters, counted."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("unit")).filter(F.col("unit").rlike(OTHERS))
    words = lines.select(F.lit("word").alias("kind"), F.explode(F.regexp_extract_all("unit", F.lit(r"\S*[^\x00-\x7F\s]\S*"), F.lit(0))).alias("unit"))
    both = words.unionByName(lines.select(F.lit("line").alias("kind"), "unit"))
    runs = F.regexp_extract_all("unit", F.lit(OTHERS), F.lit(0))
    # the places of the runs belong to the skeleton: a line break, which no unit holds, marks each
    skeleton = F.regexp_replace("unit", OTHERS, "\n")
    # what stands before and after each run
    before = F.regexp_extract_all("unit", F.lit("(^|[\\x00-\\x7F])[^\\x00-\\x7F]+"), F.lit(1))
    after = F.regexp_extract_all("unit", F.lit("[^\\x00-\\x7F]+($|[\\x00-\\x7F])"), F.lit(1))
    ends = lambda cs: F.transform(cs, lambda c: F.when(c == "", "|").otherwise(c))
    word = F.col("kind") == "word"
    cut = both.select("kind", F.xxhash64("kind", skeleton).alias("skeleton"), F.length(F.regexp_replace("unit", OTHERS, "")).alias("kept"), runs.alias("runs"), F.when(word, ends(before)).alias("before"), F.when(word, ends(after)).alias("after"))
    return cut.groupBy("kind", "skeleton", "kept", "runs").agg(F.first("before").alias("before"), F.first("after").alias("after"), F.count("*").alias("n"))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (neighbour, character, neighbour) around runs of one character; the sign | stands for the end of a unit."""
    counts: Counter = Counter()
    for batch in batches:
        for runs, before, after, n in zip(*(batch.column(c).to_pylist() for c in ("runs", "before", "after", "n"))):
            for run, b, a in zip(runs, before, after):
                if len(run) == 1:
                    counts[b + run + a] += n
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["context", "n"])


class Learned:
    """What the collection taught: forms of several characters, forms of one, and counts of contexts of the latter."""

    def __init__(self, table: dict[str, str], single: dict[str, str], contexts: dict[str, int]) -> None:
        self.table, self.single, self.contexts = table, single, contexts


def learn(docs: DataFrame) -> Learned:
    """Garbled form -> clean character, from all records.

    Of the twins on one skeleton the variant with the fewest characters, of equals the most frequent, is the clean one, so
    that a skeleton with many variants gives as many pairs, not their square. What the driver holds is bounded by characters of
    the alphabet and charsets, not by the records.
    """
    units = materialize(_units(docs.select("text").filter(F.col("text").isNotNull())), "units")
    size = F.length(F.array_join("runs", ""))
    lost = F.array_join("runs", "").contains(LOST).cast("int")
    best = units.filter(F.col("kept") >= 3).groupBy("skeleton").agg(F.min(F.struct(lost.alias("lost"), size.alias("size"), (-F.col("n")).alias("n"), F.col("runs"))).alias("b"), F.count("*").alias("variants"))
    best = best.filter((F.col("variants") > 1) & (F.col("b.lost") == 0)).select("skeleton", F.col("b.runs").alias("clean"), (-F.col("b.n")).alias("clean_n"))
    twins = units.join(best, "skeleton").filter((F.col("runs") != F.col("clean")) & (F.size("runs") == F.size("clean")) & ((size > F.length(F.array_join("clean", ""))) | (F.col("n") < F.col("clean_n"))))
    aligned = twins.select("skeleton", F.explode(F.arrays_zip("runs", "clean")).alias("p")).select("skeleton", F.col("p.runs").alias("form"), F.col("p.clean").alias("letter"))
    aligned = aligned.filter((F.col("form") != F.col("letter")) & (F.length("letter") == 1) & ~F.col("form").contains(LOST) & (F.length("form") <= 12)).distinct()
    pairs = {(r["form"], r["letter"]): r["count"] for r in aligned.groupBy("form", "letter").count().filter(F.col("count") >= LEAST_PAIR).collect()}
    if not pairs:
        return Learned({}, {}, {})
    found, done = explaining(pairs)
    leads = sorted({form[0] for chain in found for c in (0xC0, 0xE9, 0xFF, 0x153, 0x2019, 0x20AC) if len(form := misread(chr(c), chain)) > 1})
    mixed = "[" + "".join(re.escape(x) for x in leads) + "][^\\x00-\\x7F]" if leads else "(?!)"
    words = units.filter((F.col("kind") == "word") & ~F.array_join("runs", " ").rlike(mixed))
    letters = words.select(F.explode(F.split(F.array_join("runs", ""), "")).alias("letter"), "n").groupBy("letter").agg(F.sum("n").alias("n"))
    alphabet = {r["letter"]: r["n"] for r in letters.filter(F.col("n") >= LEAST_WORDS).collect() if r["letter"] and r["letter"] != LOST}  # at most the characters of Unicode
    table: dict[str, str] = {}
    single: dict[str, str] = {}
    for chain in sorted(found, key=len):
        for letter in dict.fromkeys([*sorted(alphabet), *TYPOGRAPHIC]):
            form = misread(letter, chain)
            if form == letter or LOST in form or ord(letter) < 0xA0:
                continue
            if len(form) > 1:
                table.setdefault(form, letter)
            elif chain[0][0] == "utf-8" or any(p[1] == letter for p in done) or unicodedata.category(letter)[0] == "L":
                single.setdefault(form, letter)
    for (form, letter), n in sorted(pairs.items()):
        if n >= LEAST_UNEXPLAINED and len(form) > 1 and (form, letter) not in done:
            table.setdefault(form, letter)
    # a form of one character that is put right into one which is itself put right would go round
    single = {form: letter for form, letter in single.items() if ord(form) >= 0x80 and letter not in single}
    if not single:
        return Learned(table, {}, {})
    wanted = F.array(*[F.lit(c) for c in sorted({*single, *single.values()})])
    around = units.filter("kind = 'word'").filter(F.exists("runs", lambda r: F.array_contains(wanted, r)))
    counted = around.mapInArrow(_contexts, "context string, n long").groupBy("context").agg(F.sum("n").alias("n"))
    contexts = {r["context"]: r["n"] for r in counted.filter(F.col("n") >= LEAST_WORDS).collect()}  # at most the alphabet times its neighbours
    return Learned(table, single, contexts)


def _script(c: str) -> str:
    return unicodedata.name(c, "").split(" ")[0]


class Mapper:
    """The learned mappings as one pattern, longest forms first."""

    def __init__(self, learned: Learned) -> None:
        table = learned.table
        self.table, self.single, self.contexts = table, learned.single, learned.contexts
        self.pattern = re.compile("|".join(map(re.escape, sorted(table, key=lambda x: (-len(x), x)))) or r"(?!)")
        self.any = re.compile(f"{LOST}|{self.pattern.pattern}" if table else LOST)
        self.lone = re.compile("[" + "".join(map(re.escape, sorted(self.single))) + "]") if self.single else re.compile(r"(?!)")

    def _wrong(self, text: str, at: int) -> bool:
        """Whether the form of one character at a place stands where the clean one belongs."""
        form = text[at]
        before, after = text[at - 1] if at and not text[at - 1].isspace() else "|", text[at + 1] if at + 1 < len(text) and not text[at + 1].isspace() else "|"
        right, here = self.contexts.get(before + self.single[form] + after, 0), self.contexts.get(before + form + after, 0)
        if right >= LEAST_WORDS and right >= CLEARER * here:
            return True
        latin = sum(c.isascii() and c.isalpha() for c in (before, after))
        return form.isalpha() and latin > 0 and all(c == "|" or c.isascii() for c in (before, after)) and _script(form) not in ("LATIN", "MICRO", "FEMININE", "MASCULINE", "GREEK") and (latin == 2 or "|" in (before, after))

    def garbled(self, text: str) -> bool:
        """Whether the text holds a garbled form outside of inline code, which quotes it as an example."""
        if text.isascii():
            return False
        if self.any.search(text) is not None and self.any.search(_QUOTED.sub("` `", text)) is not None:
            return True
        if self.lone.search(text) is None:
            return False
        bare = _QUOTED.sub("` `", text)
        return any(self._wrong(bare, m.start()) for m in self.lone.finditer(bare))

    def restore(self, text: str) -> str:
        """The text with garbled forms put right, quoted ones left alone."""
        parts, last = [], 0
        for quoted in _QUOTED.finditer(text):
            parts += [self._fixed(text[last : quoted.start()]), quoted.group()]
            last = quoted.end()
        return "".join([*parts, self._fixed(text[last:])])

    def _fixed(self, text: str) -> str:
        while True:  # text may have been misread more than once; each round makes it shorter
            after = self.pattern.sub(lambda m: self.table[m.group()], text)
            if len(after) >= len(text):
                break
            text = after
        return self.lone.sub(lambda m: self.single[m.group()] if self._wrong(m.string, m.start()) else m.group(), text)


def _flag(table: Learned):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapper = Mapper(table)
        for batch in batches:
            hits = [i for i, text in enumerate(batch.column("text").to_pylist()) if text and mapper.garbled(text)]
            yield batch.select(["doc_id"]).take(pa.array(hits, pa.int64()))

    return run


def found(docs: DataFrame) -> DataFrame:
    """(doc_id): the garbled records. Null and empty texts are none; repeated rows come out once."""
    table = learn(docs)
    return docs.filter(F.col("text").rlike(OTHERS)).select("doc_id", "text").mapInArrow(_flag(table), "doc_id long").distinct()


def _restore(table: Learned):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapper = Mapper(table)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if text and mapper.garbled(text):
                    rows.append((doc_id, mapper.restore(text)))
            columns = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())], names=["doc_id", "restored"])

    return run


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, words in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "restored", "words"))):
            known = {w["word"]: w["clean"] for w in words or ()}
            text = _WORD.sub(lambda m: known.get(m.group(), m.group()) if LOST in m.group() else m.group(), text)
            rows.append((doc_id, text, "partly" if LOST in text else "restored"))
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()))], names=["doc_id", "restored", "outcome"])


def restored(docs: DataFrame) -> DataFrame:
    """(doc_id, restored, outcome) of the garbled records.

    Replacement characters carry nothing to map back; a word that holds them takes the characters of its clean
    twin, if all clean words on its skeleton agree. ``outcome`` is ``partly`` where some are left.
    """
    table = learn(docs)
    texts = docs.select("doc_id", "text").filter(F.col("text").rlike(OTHERS))
    mapped = materialize(texts.mapInArrow(_restore(table), "doc_id long, restored string").dropDuplicates(["doc_id"]), "mapped")
    pattern = F.lit(r"\S*[^\x00-\x7F\s]\S*")
    damaged = mapped.filter(F.col("restored").contains(LOST)).select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("restored", pattern, F.lit(0)))).alias("word")).filter(F.col("word").contains(LOST))
    damaged = damaged.withColumn("skeleton", F.regexp_replace("word", OTHERS, "\n"))
    whole = texts.join(mapped.select("doc_id"), "doc_id", "left_anti").select(F.explode(F.regexp_extract_all("text", pattern, F.lit(0))).alias("clean")).filter(~F.col("clean").contains(LOST))
    whole = whole.withColumn("skeleton", F.regexp_replace("clean", OTHERS, "\n")).groupBy("skeleton").agg(F.min("clean").alias("clean"), F.max("clean").alias("other")).filter(F.col("clean") == F.col("other"))
    known = damaged.join(whole.select("skeleton", "clean"), "skeleton").groupBy("doc_id").agg(F.collect_list(F.struct("word", "clean")).alias("words"))
    return mapped.join(known, "doc_id", "left").mapInArrow(_fill, "doc_id long, restored string, outcome string")
