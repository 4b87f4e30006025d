"""Scalar text functions as native Column expressions.

Patterns keep to what Java, Python and RE2 read alike, unless a docstring says otherwise. Null in, null out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and markers of the digested format.
FENCE = r"(?s)```.*?```"
INLINE_CODE = r"`[^`]+`"
STUBS = [r"\[[a-z_]*asset_pointer content omitted\]", r"\[audio_transcription content omitted\]", r"\*\[\d+ reasoning steps?\]\*"]
WORD = r"[A-Za-z][A-Za-z'-]{2,}"
FRONTMATTER = r"(?s)\A---\n(.*?)\n---\n?"
HEADING = r"(?m)^#{1,6}[ \t]+[^\n]+$"
INDEX_BEGIN, INDEX_END = "<!-- BEGIN AUTO INDEX -->", "<!-- END AUTO INDEX -->"
INDEX_BLOCK = r"(?s)<!-- BEGIN AUTO INDEX -->.*?<!-- END AUTO INDEX -->\n*"

# Default stop words of the digested format, those that stand alone and those that a rule forms. Pass a list of your own to
# tokenise by another.
_ALONE = (
    "the and for that with this from have has had you your are was were but not they them their there which when where will would could should its into than then about just like over also some more most such other any all two because been being does did out off yes get got make made say said very much many "
    "each every only even still while upon onto able after again against along among around back both down else ever here hers him his himself however may might must neither never nor once ours ourselves perhaps quite rather same seem since themselves therefore these those though through thus under until versus "
    "via well whether whose within without yet wont cant dont ive weve theyre lets now new going want need think know see seen give given right good best better first last next user assistant tool system content omitted pointer asset real audio video image transcription container reasoning context particular "
    "specific interesting important notable worth noting regarding concerning sense side okay sure yeah indeed moreover furthermore although regardless anyway anyhow meanwhile hence noted stated states explanation description suggestion another different similar various several certain actual true false correct "
    "wrong left high low big small large great little main key major minor simple complex easy hard difficult common rare unique general broad narrow reply replies probably possibly likely simply consider discuss mention discussion"
).split()
_WITH_S = (
    "answer area case chat conversation describe discussion example explain framework here indicate instance issue kind level look message moment one other part period perspective piece place point problem question response section sort stage step suggest task term that their thing thread time type use way what work"
).split()
_WITH_ING, _WITH_ED = ["consider", "discuss", "look", "mention", "work"], ["describ", "discuss", "explain", "indicat", "mention", "suggest", "us"]
_WITH_LY = "absolute according actual additional basical certain clear consequent definite especial essential exact fundamental general mere obvious particular precise pure real specifical total ultimate".split()


def _stopwords() -> list[str]:
    formed = [*_WITH_S, *(w + "s" for w in _WITH_S), "approach", "approaches", "using", *(w + "ing" for w in _WITH_ING), *(w + "ed" for w in _WITH_ED), *(w + "ly" for w in _WITH_LY)]
    persons = [who + what for who in ("any", "every", "no", "some") for what in ("thing", "one", "body") if (who, what) != ("no", "one")]
    return sorted({*_ALONE, *formed, *persons})


STOPWORDS = _stopwords()


def strip_code(text: Column) -> Column:
    """Fenced code, inline code and stubs each become a space."""
    return reduce(lambda t, p: F.regexp_replace(t, p, " "), [FENCE, INLINE_CODE, *STUBS], text)


def classifiable_text(body: Column) -> Column:
    """Without the generated index block and fences; inline code stays."""
    return F.regexp_replace(F.regexp_replace(body, INDEX_BLOCK, " "), FENCE, " ")


def words(text: Column) -> Column:
    """All words, as they stand."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(body: Column) -> Column:
    return F.size(words(strip_code(body)))


def tokens(text: Column, stopwords: list[str] | None = None) -> Column:
    """Lower-case words of four characters and more that are no stop words."""
    return kept_words(words(text), stopwords)


def kept_words(found: Column, stopwords: list[str] | None = None) -> Column:
    """Of words as they stand, in lower case, those of four characters and more that are no stop words."""
    stop = STOPWORDS if stopwords is None else stopwords
    return F.filter(F.transform(found, F.lower), lambda w: (F.length(w) >= 4) & ~w.isin(stop))


def keyword_count(n: Column, base: int = 10, ceiling: int = 40) -> Column:
    """How many keywords a document of n words gets."""
    steps = F.when(n < 500, 8).when(n < 2000, 12).when(n < 5000, 18).when(n < 15000, 25)
    return steps.otherwise(F.least(F.lit(ceiling), F.lit(base) + F.floor(n / 500))).cast("int")


def frontmatter(text: Column) -> Column:
    """The block between the leading dashes, or an empty string."""
    return F.regexp_extract(text, FRONTMATTER, 1)


def body(text: Column) -> Column:
    return F.regexp_replace(text, FRONTMATTER, "")


def field(block: Column, name: str) -> Column:
    """A field of a frontmatter block without outer quotes; null where absent or empty. The last of equal names counts."""
    found = F.element_at(F.regexp_extract_all(F.concat(F.lit("\n"), block), F.lit(rf"\n{name}:[ \t]*([^\n]*)"), F.lit(1)), -1)
    found = F.when(F.size(F.regexp_extract_all(F.concat(F.lit("\n"), block), F.lit(rf"\n{name}:[ \t]*([^\n]*)"), F.lit(1))) > 0, found)
    bare = F.trim(found)
    return F.nullif(F.regexp_replace(bare, r'^"(.*)"$', "$1"), F.lit(""))


def fields(block: Column) -> Column:
    """Every field of a block as a map of strings; needs spark.sql.mapKeyDedupPolicy=LAST_WIN for repeated names."""
    pairs = F.filter(F.split(block, "\n"), lambda x: F.instr(x, ":") > 1)
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)), F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))))))


def list_items(value: Column) -> Column:
    """Items of a bracketed list, split at commas; the notation knows no escapes."""
    inner = F.regexp_replace(F.trim(value), r"^\[\s*|\s*\]$", "")
    items = F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), r'^"|"$', ""))
    return F.when(F.trim(value).startswith("["), F.filter(items, lambda x: x != ""))


def yaml_quote(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def emit_frontmatter(values: list[tuple[str, Column]], empty: bool = False) -> Column:
    """A block of the fields that are not null, or with ``empty`` of all, null ones as ``""``; strings are quoted, arrays bracketed, the rest bare."""
    lines = F.array(*[F.concat(F.lit(f"{name}: "), F.coalesce(shown, F.lit('""')) if empty else shown) for name, shown in values])
    return F.concat(F.lit("---\n"), F.array_join(F.filter(lines, lambda x: x.isNotNull()), "\n"), F.lit("\n---\n"))


def bracketed(items: Column) -> Column:
    """A list as a field shows it."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, yaml_quote), ", "), F.lit("]"))


def headings(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(HEADING), F.lit(0))


def outline(text: Column, most: int = 25) -> Column:
    """The first headings as bullets, indented by depth."""
    marks = lambda h: F.length(F.regexp_extract(h, r"^(#+)", 1))
    title = lambda h: F.trim(F.regexp_replace(h, r"^#+[ \t]+", ""))
    return F.transform(F.slice(headings(text), 1, most), lambda h: F.concat(F.repeat(F.lit("  "), marks(h) - 1), F.lit("- "), title(h)))


def index_block(keywords: Column, bullets: Column) -> Column:
    """The generated block; a part without entries is left out."""
    words = F.when(F.size(keywords) > 0, F.concat(F.lit("**Keywords:** "), F.array_join(keywords, ", "), F.lit("\n\n"))).otherwise("")
    heads = F.when(F.size(bullets) > 0, F.concat(F.lit("**Outline:**\n\n"), F.array_join(bullets, "\n"), F.lit("\n\n"))).otherwise("")
    return F.concat(F.lit(f"{INDEX_BEGIN}\n## Document index\n\n"), words, heads, F.lit(INDEX_END))


def with_index(text: Column, block: Column) -> Column:
    """The block in place of an old one, else after the first top heading, else in front; again gives the same."""
    spaced = F.concat(block, F.lit("\n\n"))
    old = F.regexp_extract(text, f"({INDEX_BLOCK})", 1)
    first = F.regexp_extract(text, r"(?m)^(#[ \t]+[^\n]+\n)", 1)

    def beside(found: Column, before: Column) -> Column:
        """Text up to a passage, what comes before the rest, and the rest."""
        at = F.instr(text, found)
        rest = F.substring(text, at + F.length(found), F.length(text))
        return F.concat(F.substring(text, F.lit(1), at - 1), before, F.regexp_replace(rest, r"^\n+", ""))

    return F.when(old != "", beside(old, spaced)).when(first != "", beside(first, F.concat(first, F.lit("\n"), spaced))).otherwise(F.concat(spaced, text))


def slug(text: Column, most: int = 60) -> Column:
    """Lower case, words joined by hyphens, cut; ``untitled`` where nothing is left. Java's (?U) makes \\w know all alphabets."""
    kept = F.regexp_replace(F.lower(F.trim(text)), r"(?U)[^\w\s-]", "")
    joined = F.regexp_replace(F.regexp_replace(kept, r"[\s_-]+", "-"), r"^-+|-+$", "")
    return F.coalesce(F.nullif(F.substring(joined, 1, most), F.lit("")), F.lit("untitled"))


def slug_clean_end(text: Column, most: int = 60) -> Column:
    """As ``slug``, but a cut never ends in a hyphen."""
    return F.coalesce(F.nullif(F.regexp_replace(slug(text, most), r"-+$", ""), F.lit("")), F.lit("untitled"))


def short_uuid(uuid: Column) -> Column:
    return F.coalesce(F.nullif(F.substring(F.replace(uuid, F.lit("-"), F.lit("")), 1, 8), F.lit("")), F.lit("noid"))


def safe_name(name: Column, fallback: Column, most: int = 120) -> Column:
    """A file name: forbidden characters become underscores, runs of white space one space."""
    kept = F.regexp_replace(F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]', "_"), r"\s+", " ")
    return F.coalesce(F.nullif(F.trim(F.substring(F.trim(kept), 1, most)), F.lit("")), fallback)


def path_keywords(name: Column, path: Column, most: int = 10, stopwords: list[str] | None = None) -> Column:
    """Words of a file's name and path of three characters and more, first seen first."""
    stop = STOPWORDS if stopwords is None else stopwords
    parts = F.split(F.lower(F.concat_ws(" ", name, path)), r"[\\/._\-\s]+")
    return F.slice(F.array_distinct(F.filter(parts, lambda w: (F.length(w) >= 3) & ~w.isin(stop))), 1, most)


def capitalised_terms(text: Column) -> Column:
    """Lower-case forms of words capitalised within a sentence. Java only: it looks behind."""
    pattern = r"""(?<![A-Za-z][A-Za-z'-]{0,64})(?<=[^ \t.!?:;\n\r#\-*>|"“‘(\[][ \t]{0,64})[A-Z][A-Za-z'-]{2,}"""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lower))


def fenced(text: Column, lang: str = "") -> Column:
    """The text within a fence longer than any run of backticks in it."""
    longest = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(text, F.lit("`+"), F.lit(0)), F.length)), F.lit(0))
    fence = F.repeat(F.lit("`"), F.greatest(F.lit(3), longest + 1))
    return F.concat(fence, F.lit(lang + "\n"), text, F.lit("\n"), fence)


def clean_page(text: Column) -> Column:
    """Line ends made alike, blanks at line ends gone, at most one blank line in a row, no outer white space."""
    lines = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"[ \t]+(\n|$)", "$1")
    return F.regexp_replace(F.regexp_replace(lines, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def escape_cell(text: Column) -> Column:
    return F.regexp_replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")), r"\r?\n", "<br>")


def truncated(text: Column, most: int = 120) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def parent(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit(""))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(.)\.[^.]*$", "$1")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r".(\.[^.]+)$", 1))


def title(text: Column, name: Column) -> Column:
    """The first top heading, else the file's stem in words."""
    first = F.trim(F.regexp_extract(text, r"(?m)^#[ \t]+([^\n]+)$", 1))
    return F.coalesce(F.nullif(first, F.lit("")), F.regexp_replace(stem(name), "[_-]", " "))
