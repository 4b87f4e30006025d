import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioscope.llm import conversations, term_counts, term_residuals
from folioscope.llm.terms import normal_term

DOCS = "digest_id long, keywords array<string>, word_count long"


def _docs(spark):
    r = random.Random(1)
    pool = ["Alpha", " alpha", "beta\t", "café", "café", "CAFÉ ", "rare%d", "x", "", "  ", None]
    rows = []
    for i in range(120):
        words = None if i % 17 == 0 else [w and w.replace("%d", str(i)) for w in r.choices(pool, k=r.randrange(0, 7))]
        rows.append((i, words, None if i % 9 == 0 else i % 4))
    return rows, spark.createDataFrame(rows + rows[:40], DOCS)


def test_counts_against_brute_force(spark):
    rows, df = _docs(spark)
    occ, rec = Counter(), defaultdict(set)
    for i, words, n in rows:
        for w in words or ():
            if w and normal_term(w):
                occ["keywords", normal_term(w)] += 1
                rec["keywords", normal_term(w)].add(i)
        if n is not None:
            occ["word_count", str(n)] += 1
            rec["word_count", str(n)].add(i)
    got = {(r["field_name"], r["term"]): (r["occurrences"], r["records"], r["mark"]) for r in term_counts.term_counts(df.withColumn("term", F.lit("clash"))).collect()}
    want = {k: (n, len(rec[k]), "rare" if len(rec[k]) <= 2 else "common" if len(rec[k]) * 100 > 5 * 120 else None) for k, n in occ.items()}
    assert got == want


def test_counts_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert term_counts.term_counts(empty).count() == 0
    assert term_residuals.found(empty).count() == 0
    only_null = spark.createDataFrame([(None, ["a"], 1), (1, None, None)], DOCS)
    assert term_counts.term_counts(only_null).count() == 0


def test_identifiers_are_dense(spark):
    _, df = _docs(spark)
    from folioscope.llm.terms import entries

    ids = sorted(r["term_id"] for r in term_counts.dense_dictionary(entries(df)).collect())
    assert ids == list(range(len(ids))) and ids


def test_residuals(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"], 1), (2, ["b"], 1), (3, ["b", "c"], 1)], DOCS)
    got = {(r["digest_id"], r["term"]): r for r in term_residuals.term_residuals(df).collect()}
    # a: expected 3 * 2 / 6 = 1, residual 1, adjusted 1 / sqrt(0.5 * 2 / 3)
    assert got[1, "a"]["expected"] == 1 and abs(got[1, "a"]["adjusted"] - 1 / (0.5 * 2 / 3) ** 0.5) < 1e-9
    assert {(r["digest_id"], r["term"]) for r in term_residuals.found(df).collect()} == {(1, "a"), (2, "b"), (3, "c")}


def test_equal_terms_by_code_point(spark):
    df = spark.createDataFrame([(1, ["z", "É", "a"], 1), (2, ["q"], 1)], DOCS)
    assert {(r["digest_id"], r["term"]) for r in term_residuals.found(df).collect()} == {(1, "a"), (2, "q")}


T0 = datetime(2025, 1, 1)
MSG = "row_id long, project_uuid string, conv_uuid string, msg_uuid string, parent_uuid string, sender string, created_at timestamp, text string, content array<struct<block_type:string,text:string,thinking:string,tool_name:string>>"


def _msg(conv, key, parent, sender, minute, text="x", row=0):
    return (row, "p", conv, key, parent, sender, None if minute is None else T0 + timedelta(minutes=minute), text, None)


CASES = [
    _msg("ok", "a", None, "human", 1), _msg("ok", "b", "a", "ai", 2), _msg("ok", "b", "a", "ai", 2),
    _msg("fork", "a", conversations.START, " User", 1), _msg("fork", "b", "a", "assistant", 2), _msg("fork", "c", "a", "assistant", 3), _msg("fork", "d", "b", "human", 4), _msg("fork", "e", "d", "Assistant ", 5),
    _msg("flat", "z", None, "human", 1), _msg("flat", "a", None, "assistant", 2), _msg("blank", "a", None, "human", 1, " "), _msg("blank", "b", "a", "ai", 2, None),
    _msg("nosender", "a", None, "human", 1), _msg("nosender", "b", "a", " ", 2), _msg("lost", "a", None, "human", 1), _msg("lost", "b", "gone", "ai", 2),
    _msg("circle", "r", None, "human", 0), _msg("circle", "a", "b", "human", 1), _msg("circle", "b", "a", "ai", 2), _msg("unanswered", "a", None, "human", 1), _msg("unanswered", "b", "a", "ai", 2), _msg("unanswered", "c", "b", "human", 3),
    _msg("blankanswer", "a", None, "human", 1), _msg("blankanswer", "b", "a", "ai", 2, " "), _msg(None, "a", None, "human", 1), _msg("late", "a", None, "human", 9), _msg("late", "b", "a", "ai", None),
]
WANT = [
    ("flat", 1, "z", "user"), ("flat", 2, "a", "assistant"), ("fork", 1, "a", "user"), ("fork", 2, "b", "assistant"), ("fork", 3, "d", "user"), ("fork", 4, "e", "assistant"),
    ("late", 1, "a", "user"), ("late", 2, "b", "assistant"), ("ok", 1, "a", "user"), ("ok", 2, "b", "assistant"),
]


@pytest.mark.parametrize("in_one_task", [conversations.IN_ONE_TASK, 0])
def test_conversations(spark, in_one_task):
    df = spark.createDataFrame(CASES, MSG).withColumn("turn_no", F.lit("clash"))
    assert sorted(tuple(r) for r in conversations.conversations(df, in_one_task).collect()) == WANT


def test_long_chain_by_tables(spark):
    rows = [_msg("c", f"m{i:03}", f"m{i - 1:03}" if i else None, "human" if i % 2 == 0 else "ai", i) for i in range(70)]
    got = sorted((r["turn_no"], r["msg_uuid"]) for r in conversations.conversations(spark.createDataFrame(rows, MSG), 5).collect())
    assert got == [(i + 1, f"m{i:03}") for i in range(70)]


def test_no_messages(spark):
    assert conversations.conversations(spark.createDataFrame([], MSG)).count() == 0
    assert conversations.threads(spark.createDataFrame([], MSG)).count() == 0


def test_interleaved_channel(spark):
    talk = [("a", "human", 1, "Where does the Karimoor lantern hang?"), ("b", "human", 2, "Please translate the invoice heading"), ("c", "ai", 3, "The Karimoor lantern hangs above the stairway"), ("d", "ai", 4, "The invoice heading reads Rechnung"), ("e", "human", 9000, "something else entirely")]
    df = spark.createDataFrame([_msg(None, k, None, s, m, t) for k, s, m, t in talk], MSG)
    links = {r["msg_uuid"]: r["parent_uuid"] for r in conversations.reply_links(df).collect()}
    assert links["c"] == "a" and links["d"] == "b" and links["a"] is None and links["e"] is None
    assert {r["thread_uuid"] for r in conversations.threads(df).collect()} >= {"a", "e"}


def test_parent_far_back_in_a_busy_channel(spark):
    start = datetime(2024, 1, 1, 10)
    rows = [(0, "p", None, "asked", None, "human", start, "Which kettle did Marigold recommend yesterday?")]
    rows += [(i, "p", None, f"noise{i:02}", None, "human", start + timedelta(seconds=i), f"filler{chr(96 + i)} chatter{chr(96 + i)}") for i in range(1, 20)]
    rows.append((30, "p", None, "reply", None, "assistant", start + timedelta(seconds=40), "The kettle Marigold did recommend yesterday"))
    table = spark.createDataFrame(rows, "row_id long, project_uuid string, conv_uuid string, msg_uuid string, parent_uuid string, sender string, created_at timestamp, text string")
    links = {r["msg_uuid"]: r["parent_uuid"] for r in conversations.reply_links(table).collect()}
    assert links["reply"] == "asked"


def test_planted_threads_of_interleaved_channels(spark):
    """Talks of two to five turns, a dozen at a time in each channel; nine in ten replies go to the message they answer."""
    import random

    r = random.Random(31)
    syllables = "bar ven tol mir ka rus quin lo fen dor wex el thi mo gard hal ost pel".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(3))
    rows, want = [], {}
    for channel in ("p1", "p2", None):
        for talk in range(60):
            topic, second, parent = [word() for _ in range(5)], r.randrange(0, 7200), None
            for turn in range(r.randrange(2, 6)):
                key = f"{channel}-{talk}-{turn}"
                # each turn takes up some words of the one before and brings new ones
                said, topic = r.sample(topic, 3), [*r.sample(topic, 3), word(), word()]
                rows.append((len(rows), channel, None, key, None, "human" if turn % 2 == 0 else "assistant", T0 + timedelta(seconds=second), " ".join([*said, *topic[3:], *(word() for _ in range(3))]), None))
                want[key] = parent
                parent, second = key, second + r.randrange(20, 400)
    links = {x["msg_uuid"]: x["parent_uuid"] for x in conversations.reply_links(spark.createDataFrame(rows, MSG)).collect()}
    replies = [k for k, p in want.items() if p is not None]
    assert sum(links[k] == want[k] for k in replies) / len(replies) >= 0.9


def test_a_named_parent_outweighs_all_else(spark):
    talk = [("a", None, 1, "the amber lantern of Karimoor"), ("b", None, 2, "another matter"), ("c", "b", 3, "the amber lantern of Karimoor")]
    df = spark.createDataFrame([_msg(None, k, p, "human", m, t) for k, p, m, t in talk], MSG)
    assert {x["msg_uuid"]: x["parent_uuid"] for x in conversations.reply_links(df).collect()}["c"] == "b"


def test_repeated_rows_without_id_count_alike(spark):
    rows = [(None, "p", "c", "a", None, "human", T0, "x", None), (4, "p", "c", "a", "gone", "human", T0, "x", None), (5, "p", "c", "b", "a", "ai", T0 + timedelta(minutes=1), "y", None)]
    df = spark.createDataFrame(rows, MSG)
    both = [sorted(tuple(x) for x in conversations.conversations(df, n).collect()) for n in (conversations.IN_ONE_TASK, 0)]
    assert both[0] == both[1]


def test_conversations_are_linked_without_scores(spark, monkeypatch):
    for name in ("link_score", "likeliest"):
        monkeypatch.setattr(conversations, name, lambda *a, **k: pytest.fail("a link of a conversation was scored"))
    rows = conversations.messages(spark.createDataFrame(CASES, MSG)).filter("conv_uuid is not null").orderBy("conv_uuid")
    got = [tuple(x.values()) for out in conversations._ordered(iter(rows.toArrow().to_batches())) for x in out.to_pylist()]
    assert sorted(got) == WANT


@pytest.mark.parametrize(("weight", "parent"), [(conversations.WEIGHTS["overlap"], "a"), (0.0, "b")])
def test_scores_decide_links_of_loose_rows(monkeypatch, weight, parent):
    monkeypatch.setitem(conversations.WEIGHTS, "overlap", weight)
    said = [("a", 0, "amber lantern"), ("b", 0, "another matter"), ("c", 1, "amber lantern")]
    rows = [{"channel": "p", "bucket": 0, "context": False, "at": i * 60_000_000, "msg_uuid": k, "role": role, "words": words, "parent_uuid": None} for i, (k, role, words) in enumerate(said)]
    (out,) = conversations._linked(iter([pa.RecordBatch.from_pylist(rows)]))
    assert {x["msg_uuid"]: x["parent_uuid"] for x in out.to_pylist()}["c"] == parent
