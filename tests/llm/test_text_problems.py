import random
import re
from datetime import datetime

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from folioscope.llm import history_dedup, leakage, mojibake, packing, pii, scan_noise
from folioscope.llm.boosting import Boosted
from pii_sentences import SENTENCES

WORDS = "amber bright candle distant editor folder gentle harbour island journal kitchen lantern market narrow orchard parcel quiet river silver tavern upper village window yellow zealous".split()


def _prose(r, n):
    return " ".join(r.choice(WORDS) + r.choice(["", "", r.choice("aeiou")]) for _ in range(n))


# --- boosted trees -------------------------------------------------------------------------------


def test_boosted_trees_learn_a_rule():
    r = np.random.default_rng(0)
    x = r.normal(size=(1500, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.5) | (x[:, 3] > 1.5)).astype(float)
    model = Boosted().fit(x[:1000], y[:1000])
    assert (model.holds(x[1000:]) == (y[1000:] > 0)).mean() > 0.95
    assert (Boosted().fit(x[:1000], y[:1000]).predict(x) == model.predict(x)).all()


# --- scanned pages -------------------------------------------------------------------------------


def _book(spark):
    r = random.Random(7)
    pages, want = [], set()
    for n in range(1, 25):
        lines = ["The Quiet Harbour" if n % 5 else "The Quict Harbour", ""]
        want.add((n, 1, "header"))
        for _ in range(12):
            lines.append(" ".join(r.choice(WORDS) for _ in range(9)) + ".")
        lines[4] = lines[4][:-1] + " lan-"
        lines[5] = "tern " + lines[5]
        want.add((n, 5, "hyphen"))
        lines[7] = lines[7][:-1] + " read-"
        lines[8] = "only " + lines[8]
        lines[9] += " a read-only market"
        if n % 6 == 0:
            lines[10] = "the 0rchard and " + lines[10]
            want.add((n, 11, "misread"))
        lines += ["", f"- {n + 4} -"]
        want.add((n, len(lines), "page_number"))
        pages.append((n, 1, n, "\n".join(lines)))
    return pages, want


def test_noise_of_a_book(spark):
    pages, want = _book(spark)
    df = spark.createDataFrame(pages + [(99, 1, 99, None), (100, 1, None, ""), (None, 1, 3, "x")], "page_id long, pdf_id long, page_no int, text string").withColumn("line_no", F.lit("clash"))
    got = {tuple(r) for r in scan_noise.found(df).collect()}
    assert len(got & want) / len(got | want) > 0.9, (sorted(got - want)[:5], sorted(want - got)[:5])
    fixed = {r["page_id"]: r["repaired"] for r in scan_noise.repaired_pages(df).collect()}
    assert "lantern" in fixed[1] and "read-only" in fixed[1] and "Quiet Harbour" not in fixed[1] and "- 5 -" not in fixed[1]
    assert "orchard" in fixed[6] and "0rchard" not in fixed[6] and fixed[100] == ""


def test_a_header_for_each_chapter(spark):
    """No number of headers is too many for a file, and a header may stand under other lines."""
    r = random.Random(4)
    names = ["Distant Candle", "Narrow Orchard", "Silver Parcel", "Gentle Kitchen", "Upper Tavern", "Bright Island", "Yellow Folder", "Quiet Window", "Amber Journal", "Village Editor", "Market River", "Lantern Harbour"]
    pages, want = [], set()
    for c, name in enumerate(names):
        for k in range(6):
            n = c * 6 + k + 1
            top = ["Collected Letters", "of the county", name] if c % 2 else [name]
            top = [x for x in top if k or x != name]  # a chapter's first page has none
            want |= {(n, top.index(name) + 1)} if k else set()
            body = [" ".join(r.choice(WORDS) for _ in range(9)) + r.choice(["", ".", ","]) for _ in range(14)]
            pages.append((n, 1, n, "\n".join([*top, "", *body, "", str(n + 2)])))
    got = {(r["page_id"], r["line_no"]) for r in scan_noise.found(spark.createDataFrame(pages, "page_id long, pdf_id long, page_no int, text string")).filter("noise_kind = 'header'").collect()}
    assert len(want) == 60 and want <= got, sorted(want - got)


def test_words_that_grams_alone_do_not_meet():
    for read, true in {"tvvice": "twice", "clraft": "draft", "inclex": "index", "giiarded": "guarded", "spht": "split", "thc": "the", "srnith": "smith"}.items():
        assert true in scan_noise.undone(read), read


def test_no_pages(spark):
    assert scan_noise.found(spark.createDataFrame([], "page_id long, pdf_id long, page_no int, text string")).count() == 0


def test_numbers_in_every_notation():
    want = {"12": 12, "[3]": 3, "- 10 -": 10, "— 10 —": 10, "Page 41": 41, "p. 7 of 15": 7, "130": 130, "11 |": 11, "xliii": 43, "l6": 16, "lO |": 10, "p. cxxi of 144": 121}
    for text, value in want.items():
        assert scan_noise.as_number(text)[0] == value, text
    for text in ("market", "B6.", "3d8", "", "12 torches"):
        assert scan_noise.as_number(text) is None, text
    assert scan_noise.parts_of("28    The public melody")[0] == "The public melody" and scan_noise.parts_of("Frugal Header    - 15 -")[1][0] == 15


# --- personal information ------------------------------------------------------------------------


@pytest.mark.parametrize("kind", pii.KINDS)
def test_kinds_on_wording_of_its_own(kind):
    finder = pii.Finder(pii.models(), pii.spellings())
    right = missed = wrong = 0
    for line in SENTENCES[kind].strip().split("\n"):
        case = re.search(r"\[\[(.+?)\]\](?!\])", line)
        text = line.replace(case.group(), case.group(1)) if case else line
        hits = [h for h in finder.spans([text])[0] if h[2] == kind]
        good = case is not None and any(h[0] < case.start() + len(case.group(1)) and h[1] > case.start() for h in hits)
        right, missed, wrong = right + good, missed + (case is not None and not good), wrong + (bool(hits) and not good)
    assert right / (right + missed) >= 0.9 and right / (right + wrong) >= 0.9, (right, missed, wrong)


def test_no_made_up_wording_stands_in_the_tables(sf):
    """What is fitted on is not what is searched."""
    held = []
    for name, columns in (("chat_messages", ["text"]), ("file_ops", ["text"]), ("documents", ["text"])):
        for column in columns:
            held += [x for x in pq.read_table(f"{sf}/{name}.parquet", columns=[column])[column].to_pylist() if x]
    blocks = pq.read_table(f"{sf}/chat_messages.parquet", columns=["content"])["content"].to_pylist()
    held += [t for row in blocks for b in row or () for t in (b["text"], b["thinking"]) if t]
    seen = {tuple(w[i : i + 3]) for t in held for w in [re.findall(r"\w+", t.lower())] for i in range(len(w) - 2)}
    made = 0
    for i, kind in enumerate(pii.KINDS):
        maker = pii._Maker(7 + i, pii.LEXICON)
        for k in range(400):
            text, span = maker.sample(kind, k % 2 == 0)
            text = text[: span[0]] + " | " + text[span[1] :] if span else text
            words = re.findall(r"[^\W\d_]+|\|", text.lower())
            made += sum(tuple(words[j : j + 3]) in seen for j in range(len(words) - 2))
    assert made <= 2, made  # three function words in a row may meet by chance
    lines = [x for block in SENTENCES.values() for x in block.strip().split("\n")]
    assert len(lines) >= 200 and not any(line.replace("[[", "").replace("]]", "") in t for line in lines for t in held)


def test_redaction_keeps_the_rest(spark):
    messages = spark.createDataFrame(
        [
            (1, "Contact: ana.moor+x@post.example or call me on +44 20 7946 0512 please.", None), (2, "The build is 2026.08.7656, see ISBN 978-0-000-30466-7 for the printed rules.", None),
            (3, None, [("text", "My neighbour Celeste Pellifeld read the draft first.", None, None), ("thinking", None, "ID: 666-80-3233", None)]), (4, "", []), (5, None, None), (1, "Contact: ana.moor+x@post.example", None),
        ],
        "row_id long, text string, content array<struct<block_type:string,text:string,thinking:string,tool_name:string>>",
    )
    files = spark.createDataFrame([(7, "Home: 45 Heron Street, Oberfeld"), (8, None), (9, "x" * 200_000)], "op_id long, text string")
    got = sorted(tuple(r) for r in pii.found(messages, files).collect())
    assert got == [("chat_messages", 1, "email"), ("chat_messages", 1, "phone"), ("chat_messages", 3, "id_number"), ("chat_messages", 3, "name"), ("file_ops", 7, "address")]
    text = {r["ref_id"]: r["redacted"] for r in pii.redacted(messages.filter("row_id = 3"), files.limit(0)).collect()}
    assert text[3] == ["My neighbour [NAME] read the draft first.", "ID: [ID_NUMBER]"]
    assert pii.found(messages.limit(0), files.limit(0)).count() == 0


# --- history -------------------------------------------------------------------------------------

CONV = "conv_row_id long, batch_no int, transcript string"


def _brute(rows):
    accepted, out = [], set()
    for row_id, _, text in sorted((r for r in rows if r[2] and history_dedup.words(r[2])), key=lambda r: (r[1], r[0])):
        found = history_dedup.words(text)
        hits = [(-history_dedup.share_of(found, words), i) for i, (_, words) in enumerate(accepted)]
        best = min(hits, default=(0, 0))
        if -best[0] >= history_dedup.SHARE:
            out.add((accepted[best[1]][0], row_id))
        else:
            accepted.append((row_id, found))
    return out


def _edited(r, text, share):
    words = text.split()
    for _ in range(int(len(words) * share)):
        i = r.randrange(len(words))
        words[i : i + 1] = r.choice([[], [r.choice(WORDS)], [words[i], r.choice(WORDS)]])
    return " ".join(words)


def test_history_against_brute_force(spark):
    r = random.Random(3)
    opening = _prose(r, 50)
    base = [(opening + " " if i % 3 == 0 else "") + _prose(r, r.choice([45, 90, 160, 400])) for i in range(30)]
    rows = [(i, i % 3 + 1, t) for i, t in enumerate(base)]
    for k in range(45):
        source = r.choice(base)
        rows.append((1000 + k, r.randrange(1, 9), r.choice([source, source.upper().replace(" ", "  "), _edited(r, source, 0.05), _edited(r, source, 0.12), source + " " + _prose(r, len(source.split()) // 2)])))
    rows += [(2000, 1, None), (2001, 1, "  "), (2002, 2, "?!"), (None, 2, base[0]), (2003, None, base[0])]
    got = {tuple(x) for x in history_dedup.found(spark.createDataFrame(rows + rows[:3], CONV).withColumn("share", F.lit("clash"))).collect()}
    assert got == _brute([x for x in rows if x[0] is not None and x[1] is not None])


def test_edited_copies_of_one_long_text(spark, monkeypatch):
    monkeypatch.setattr(history_dedup, "LEAST_HOT", 20)
    r = random.Random(8)
    source = " ".join(f"w{r.randrange(5000)}" for _ in range(300))
    rows = [(i, 1 + i // 50, _edited(r, source, 0.01)) for i in range(150)]
    assert {tuple(x) for x in history_dedup.found(spark.createDataFrame(rows, CONV)).collect()} == _brute(rows)


def test_every_fifth_word_replaced(spark):
    r = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(9))
    source = [f"w{i}" for i in range(45)]
    rows = [(i, 1, " ".join(f"v{r.randrange(300)}" for _ in range(45))) for i in range(20)] + [(100, 1, " ".join(source))]
    rows += [(101 + k, 2, " ".join(f"x{k}-{i}".replace("-", "y") if i % 5 == k else w for i, w in enumerate(source))) for k in range(5)]
    # many accepted rows begin with the same passage, the right one in the middle of them
    rows += [(200 + i, 3, f"{passage} " + " ".join(f"u{i}a{k}" for k in range(36))) for i in range(12)]
    rows += [(300 + i, 4, f"{passage} " + " ".join(f"z{k}" if k % 4 == 3 else f"u{i}a{k}" for k in range(36))) for i in range(12)]
    got = {tuple(x) for x in history_dedup.found(spark.createDataFrame(rows, CONV)).collect()}
    assert {(100, 101 + k) for k in range(5)} <= got
    assert got == _brute(rows)


def test_exact_search_alone(spark, monkeypatch):
    monkeypatch.setattr(history_dedup, "COVERAGE", 1e9)
    r = random.Random(12)
    base = [_prose(r, n) for n in (5, 8, 45, 90, 330, 500, 1100) for _ in range(3)]
    rows = [(i, 1, t) for i, t in enumerate(base)] + [(100 + i, 2 + i % 3, _edited(r, t, share)) for i, t in enumerate(base * 3) for share in (0.05 * (1 + i % 4),)]
    expected = _brute(rows)
    assert len(expected) > 40
    assert {tuple(x) for x in history_dedup.found(spark.createDataFrame(rows, CONV)).collect()} == expected


def test_history_taken_in_by_parts(spark, tmp_path):
    r = random.Random(21)
    base = [_prose(r, r.choice([20, 45, 90, 350])) for _ in range(20)]
    rows = [(i, 1 + i % 3, t) for i, t in enumerate(base)]
    for k in range(60):
        source = r.choice(base)
        rows.append((1000 + k, r.randrange(1, 9), r.choice([source, _edited(r, source, 0.08), _edited(r, source, 0.16), source + " " + _prose(r, len(source.split()) // 2)])))
    want = _brute(rows)
    df = spark.createDataFrame(rows, CONV)
    history = history_dedup.History(spark, f"file://{tmp_path}/history")
    got = set()
    for low, high in ((1, 3), (4, 4), (5, 6), (7, 9)):
        found = {(x["accepted_id"], x["duplicate_id"]) for x in history.take_in(df.filter(F.col("batch_no").between(low, high))).collect()}
        assert found == {w for w in want if any(x[0] == w[1] and low <= x[1] <= high for x in rows)}, (low, high)
        got |= found
    assert got == want
    sizes = [s["rows"] for s in history.manifest()["segments"]]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == history.accepted().count() == len(rows) - len(want)
    assert history.take_in(df.limit(0)).count() == 0


def test_history_of_nothing(spark):
    assert history_dedup.found(spark.createDataFrame([], CONV)).count() == 0


def test_common_words_by_a_plain_table():
    r = random.Random(5)
    for _ in range(60):
        a, b = ([r.choice("abcde") for _ in range(r.randrange(0, 30))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert history_dedup.common_words(a, b) == best[-1][-1]


# --- packing -------------------------------------------------------------------------------------


def test_packing_holds_every_piece_once(spark):
    r = random.Random(2)
    texts = [(i, _prose(r, r.choice([5, 50, 300, 900, 3000]))) for i in range(150)] + [(900, ""), (901, None), (None, "x")]
    df = spark.createDataFrame(texts + texts[:4], "doc_id long, text string")
    placed = packing.containers(df).collect()
    encode = packing.tokenizer(packing.TOKENIZERS, packing.VOCABULARY).encode_ordinary
    sizes = {i: len(encode(t)) for i, t in texts if t is not None and i is not None}
    total = {}
    for row in placed:
        total[row["doc_id"]] = total.get(row["doc_id"], 0) + row["tokens"]
    assert total == sizes
    pieces = [(x["doc_id"], x["piece_no"]) for x in placed]
    assert len(pieces) == len(set(pieces))
    assert all(sizes[d] > packing.CAPACITY for d, p in pieces if p > 0)
    fill = packing.fill(spark.createDataFrame(placed)).first()
    assert fill["containers"] <= fill["least_containers"] + 2
    assert max(r["t"] for r in spark.createDataFrame(placed).groupBy("container_id").agg(F.sum("tokens").alias("t")).collect()) <= packing.CAPACITY
    assert packing.containers(df.limit(0)).count() == 0


def test_neighbours_share_terms():
    terms = [np.array(x, np.uint32) for x in ([1, 2, 3], [1, 2, 9], [7, 8], [3, 7])]
    index = packing.Index(terms, [np.ones(len(t), np.uint8) for t in terms], np.array([3, 3, 2, 2]))
    assert index.neighbours(0, np.array([False, True, True, True])).tolist() == [1, 3]


# --- leakage -------------------------------------------------------------------------------------


def test_leaks_against_brute_force(spark):
    r = random.Random(8)
    items = [(i, _prose(r, r.choice([9, 13, 40, 70])), "Is the candle amber?", r.choice(["amber", None])) for i in range(40)]
    items += [(100, items[1][1].upper().replace(" ", " — "), None, None), (101, None, None, None), (None, _prose(r, 20), None, None)]
    docs = []
    for d in range(80):
        text = _prose(r, r.randrange(0, 120))
        if d % 3 == 0:
            found = r.choice(items[:40])[1].split()
            k = r.randrange(max(1, len(found) - 12))
            text += "\n" + "-".join(found[k : k + r.choice([12, 13, 30])]) + "! " + _prose(r, 20)
        docs.append((d, text))
    grams = {}
    for i, p, *_ in items:
        w = leakage.words(p)
        for k in range(len(w) - 12):
            if i is not None:
                grams.setdefault(tuple(w[k : k + 13]), set()).add(i)
    want = {(d, i) for d, t in docs for w in [leakage.words(t)] for k in range(len(w) - 12) for i in grams.get(tuple(w[k : k + 13]), ())}
    df = spark.createDataFrame([*docs, *docs[:5], (200, None), (201, "")], "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    table = spark.createDataFrame(items, "item_id long, passage string, question string, answer string")
    assert {tuple(x) for x in leakage.found(df, table).collect()} == want and want
    assert leakage.found(df.limit(0), table).count() == 0 and leakage.found(df, table.limit(0)).count() == 0


def test_leaks_by_several_indexes(spark, monkeypatch):
    monkeypatch.setattr(leakage, "INDEX_WORDS", 60)
    passages = [" ".join(f"w{i}x{k}" for k in range(15)) for i in range(5)]
    table = spark.createDataFrame([(i, p, "what was w0x1", "w0x2") for i, p in enumerate(passages)], "item_id long, passage string, question string, answer string")
    docs = spark.createDataFrame([(1, passages[4] + " and " + passages[0])], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["extent"] for r in leakage.leaks(docs, table).collect()}
    assert found == {(1, 0): "passage and answer", (1, 4): "passage and answer"}


def test_blocks_are_left_early():
    """Of many items only those are scored that a run can be from."""
    r = random.Random(6)
    index = leakage.Index([(i, " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(60)), None, None) for i in range(3000)])
    run = index.passages[1234][20:33]
    assert {c[1] for c in index.candidates(np.concatenate((run, [len(index.ids)], run[::-1].copy())).astype(np.int32)) if index.holds(c[1], run)} == {1234}
    assert len(list(index.candidates(run))) == 1


# --- wrong encodings -----------------------------------------------------------------------------

CLEAN = ["Der Bäcker trug die Müller über die Straße", "La niña numeró las páginas del león", "Le théâtre a brûlé près du café d’argent", "It’s the “so-called” naïve façade — again", "The fee was 12 €", "plain text only"]


@pytest.mark.parametrize("charset", ["cp1252", "latin-1", "mac_roman", "cp850", "cp1251"])
def test_garbled_texts_are_found_and_restored(spark, charset):
    docs = [(i, CLEAN[i % 6] + f" {i}") for i in range(60)]
    bad = [(100 + i, mojibake.misread(CLEAN[i % 5], (charset,)) + f" {i}") for i in range(10)]
    twice = [(200, mojibake.misread(CLEAN[2], (charset, charset)))] if charset == "cp1252" else []
    good = [(300, "Quoted `cafÃ©` only"), (301, "São João: IRMÃ, Âncora, L’ÂGE, 21 °C ± 2"), (302, None), (303, ""), (304, "Θάλασσα и море")]
    lost = [(400, "The caf� of 5"), (401, "quoted `�` only")]
    df = spark.createDataFrame([*docs, *bad, *twice, *good, *lost, *bad[:2]], "doc_id long, text string").withColumn("outcome", F.lit("clash"))
    if charset == "cp1252":
        df = df.unionByName(spark.createDataFrame([(500 + i, mojibake.misread(CLEAN[2], (charset, charset)), "x") for i in range(4)], df.schema))
    want = {i for i, _ in [*bad, *twice]} | {400} | ({500, 501, 502, 503} if charset == "cp1252" else set())
    assert {r["doc_id"] for r in mojibake.found(df).collect()} == want
    fixed = {r["doc_id"]: (r["restored"], r["outcome"]) for r in mojibake.restored(df).collect()}
    assert all(fixed[100 + i] == (CLEAN[i % 5] + f" {i}", "restored") for i in range(10))
    assert fixed[400] == ("The café of 5", "restored")


@pytest.mark.parametrize("chain", [(("cp1252", "cp1251"),), (("mac_roman", "cp1252"),), ("gbk",)])
def test_characters_swapped_one_for_one(spark, chain):
    docs = [(i, CLEAN[i % 6] + f" {i}") for i in range(90)]
    bad = [(100 + i, mojibake.misread(CLEAN[i % 3], chain) + f" {i}") for i in range(9)]
    good = [(300, "Θάλασσα и море"), (301, "Он ждёт: café, naïve, Straße"), (302, "quoted `" + mojibake.misread("é", chain) + "` only"), (303, "中文 and 茅台")]
    df = spark.createDataFrame([*docs, *bad, *good], "doc_id long, text string")
    got = {r["doc_id"] for r in mojibake.found(df).collect()}
    assert {i for i, _ in bad} <= got and not got & {i for i, _ in docs} and not got & {300, 301, 302}, sorted(got ^ {i for i, _ in bad})
    fixed = {r["doc_id"]: r["restored"] for r in mojibake.restored(df).collect()}
    assert sum(fixed[100 + i] == CLEAN[i % 3] + f" {i}" for i in range(9)) >= 6


def test_decodings_are_learned_from_aligned_pairs():
    pairs = {(mojibake.misread(c, (("cp1252", "cp1251"),)), c): 3 for c in "éèàü"} | {(mojibake.misread(c, ("koi8_r",)), c): 4 for c in "éñ"} | {("é", "è"): 9}
    found, done = mojibake.explaining(pairs)
    assert set(found) == {(("cp1252", "cp1251"),), (("utf-8", "koi8-r"),)} and ("é", "è") not in done


def test_no_documents(spark):
    assert mojibake.found(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert mojibake.restored(spark.createDataFrame([(1, "plain")], "doc_id long, text string")).count() == 0
