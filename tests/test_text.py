"""Scalar functions against literal cases and plain Python models."""

import random
import re

from pyspark.sql import functions as F

from folioscope.functions import artifacts, text, values


def _one(spark, column, **data):
    return spark.createDataFrame([tuple(data.values())], list(data)).select(column.alias("x")).first()["x"] if data else spark.range(1).select(column.alias("x")).first()["x"]


def test_artifact_cases(spark):
    cases = {
        "clock": ("", ""), "clocks": ("", ""), "handling": ("", ""), "strengths": ("", ""), "twelfths": ("", ""), "sphinx": ("", ""), "crwth": ("", ""),
        "erlyjewxq": ("q without u", None), "jauuimuv-wmcjrfg": ("consonant run", None), "kxwoj": ("", "pair kx"), "lz-pirirgptx": ("", "pair lz"), "aaargh": ("letter three times", None), "bcdf": ("no vowel", None),
    }
    rows = spark.createDataFrame([(k,) for k in cases], "term string").select("term", artifacts.hard_reason(F.col("term")).alias("hard"), artifacts.soft_reason(F.col("term")).alias("soft")).collect()
    for r in rows:
        hard, soft = cases[r["term"]]
        assert (r["hard"] or "") == hard, r
        if soft is not None:
            assert (r["soft"] or "") == soft, r


def test_verdict(spark):
    rows = [("kxwoj", 1, False, False, "soft"), ("kxwoj", 3, False, False, "kept"), ("kxwoj", 1, True, False, "kept"), ("kxwoj", 1, False, True, "kept"), ("erlyjewxq", 99, True, True, "hard"), ("market", None, None, None, "kept")]
    df = spark.createDataFrame(rows, "term string, df int, lex boolean, named boolean, want string")
    for r in df.select("want", artifacts.verdict(F.col("term"), F.col("df"), F.col("lex"), F.col("named")).alias("got")).collect():
        assert r["got"] == r["want"]


def test_keyword_count(spark):
    want = {0: 8, 499: 8, 500: 12, 1999: 12, 2000: 18, 4999: 18, 5000: 25, 14999: 25, 15000: 40, 99999: 40}
    df = spark.createDataFrame([(k,) for k in want], "n int").select("n", text.keyword_count(F.col("n")).alias("k"))
    assert {r["n"]: r["k"] for r in df.collect()} == want


def test_tokens_agree_with_python(spark):
    r = random.Random(1)
    texts = ["".join(r.choice("aAbé'- \n.`x9Z") for _ in range(r.randrange(60))) for _ in range(300)]
    want = [[w.lower() for w in re.findall(r"[A-Za-z][A-Za-z'-]{2,}", t) if len(w) >= 4 and w.lower() not in text.STOPWORDS] for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.tokens(F.col("t")).alias("x"))
    assert [r["x"] for r in df.orderBy("i").collect()] == want


def test_capitalised_terms_agree_with_a_model(spark):
    before = set(".!?:;\n\r#-*>|\"“‘([")

    def model(t):
        out = []
        for m in re.finditer(r"[A-Za-z][A-Za-z'-]{2,}", t):
            i = m.start() - 1
            while i >= 0 and t[i] in " \t":
                i -= 1
            if m.group()[0].isupper() and i >= 0 and t[i] not in before:
                out.append(m.group().lower())
        return sorted(set(out))

    r = random.Random(2)
    texts = [" ".join(r.choice(["Loom", "the", "a.", "Brigit", "- x", "(Sun", "moon,", "\nStar", "It's"]) for _ in range(12)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", F.array_sort(text.capitalised_terms(F.col("t"))).alias("x"))
    assert [row["x"] for row in df.orderBy("i").collect()] == [model(t) for t in texts]


def test_names_and_blocks(spark):
    assert _one(spark, text.slug(F.lit("  Héllo, Wörld & more_things! "))) == "héllo-wörld-more-things"
    assert _one(spark, text.slug(F.lit("!!"))) == "untitled"
    assert _one(spark, text.short_uuid(F.lit("0123-4567-89ab"))) == "01234567"
    assert _one(spark, text.short_uuid(F.lit(""))) == "noid"
    assert _one(spark, text.fenced(F.lit("a ```` b"))) == "`````\na ```` b\n`````"
    assert _one(spark, text.clean_page(F.lit("a  \r\n\n\n\nb \n"))) == "a\n\nb"
    block = text.index_block(F.array(F.lit("k$1")), F.array(F.lit("- h")))
    once = text.with_index(F.lit("# T\n\nbody $1 \\ text"), block)
    assert _one(spark, once) == _one(spark, text.with_index(once, block))
    assert "body $1 \\ text" in _one(spark, once)


def test_frontmatter_fields(spark):
    doc = '---\ntitle: "A: b"\nn: 3\nkeywords: [ "x", "y z" ]\ntitle: "last"\n---\nBody'
    block = text.frontmatter(F.lit(doc))
    assert _one(spark, text.field(block, "title")) == "last"
    assert _one(spark, text.field(block, "absent")) is None
    assert _one(spark, text.list_items(text.field(block, "keywords"))) == ["x", "y z"]
    assert _one(spark, text.body(F.lit(doc))) == "Body"


def test_dates_numbers_bytes(spark):
    for given, want in {"D:20260917095500-07'00'": "2026-09-17 16:55:00", "2026-09-15T17:47-07:00": "2026-09-16 00:47:00", "2026-09-15": "2026-09-15 00:00:00", "2026/09/15": "2026-09-15 00:00:00", "unknown": None, "2026-13-45": None, "": None}.items():
        got = _one(spark, values.any_date(F.lit(given)).cast("string"))
        assert got == want, given
    for given, want in {1.0: "1899-12-31", 45292.0: "2024-01-01", 0.5: "", 45292.5: "2024-01-01 12:00:00"}.items():
        assert _one(spark, values.sheet_serial(F.lit(given))) == want
    assert [_one(spark, values.column_letters(F.lit(n))) for n in (1, 26, 27, 703)] == ["A", "Z", "AA", "AAA"]
    assert _one(spark, values.column_number(F.lit("AAA"))) == 703
    for head, ext in {b"\x89PNG\r\n\x1a\nxxxx": ".png", b"\xff\xd8\xff\xe0": ".jpg", b"GIF87axx": ".gif", b"GIF89axx": ".gif", b"ID3\x03": ".mp3", b"OggSxx": ".ogg", b"RIFF1234WEBPxx": ".webp", b"RIFF1234WAVExx": ".wav", b"RIFF1234AVI xx": ".avi", b"xxxxftypisom": ".mp4", b"RIFF1234NONE": None, b"plain": None}.items():
        assert _one(spark, values.sniffed_extension(F.lit(head))) == ext, head
    assert _one(spark, values.asset_extension(F.lit("a.JPG"), F.lit(None).cast("string"), F.lit(b"x"))) == ".jpg"
    assert _one(spark, values.asset_extension(F.lit("a"), F.lit("image/png; q=1"), F.lit(b"x"))) == ".png"
    assert _one(spark, values.asset_extension(F.lit("a"), F.lit("x/y"), F.lit(b"x"))) == ".bin"
    assert _one(spark, values.iso_minutes(F.lit("2026-07-01T12:00:00Z").cast("timestamp"), "America/New_York")) == "2026-07-01T08:00-04:00"
    assert _one(spark, values.iso_minutes(F.lit("2026-01-01T12:00:00Z").cast("timestamp"), "Asia/Kolkata")) == "2026-01-01T17:30+05:30"
    assert _one(spark, values.sniffed_extension(F.lit(b"%PDF-1.7 xxxx"))) == ".pdf"
    assert bytes(_one(spark, values.data_url_bytes(F.lit("data:text/plain;base64,aGk=")))) == b"hi"
    assert _one(spark, values.data_url_bytes(F.lit("http://x"))) is None
    assert _one(spark, values.pointers(F.lit('{"a":"file-service://file-AbC123","b":["sediment://file_00ff","file-service://file-AbC123"]}'))) == ["file-AbC123", "file_00ff"]
    assert str(_one(spark, values.name_date(F.lit("2026-02-30__x")))) == "None"


def test_null_in_null_out(spark):
    for f in (text.strip_code, text.slug_clean_end, text.clean_page, text.escape_cell, text.truncated, values.any_date):
        _one(spark, f(F.lit(None).cast("string")))
    assert _one(spark, text.strip_code(F.lit(None).cast("string"))) is None
