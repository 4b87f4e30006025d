"""Keywords: term counts, weights against the collection, the first n of each document, and what is rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import artifacts, text
from folioscope.runtime import materialize

#: Decimals that ranks go by, so that engines agree on ties.
DIGITS = 6
#: Terms ranked beyond a document's count, so that rejected ones can be made up for.
HEADROOM = 10
#: Times that a term of the subject's own turns counts.
SUBJECT_WEIGHT = 128
#: A term of this share of all documents is hot; documents of k terms have k / HOT_SHARE such terms at most, on average.
HOT_SHARE = 0.001


def term_frequency(docs: DataFrame, column: str = "text", stopwords: list[str] | None = None) -> DataFrame:
    """(doc_id, term, tf). A document without tokens has no row."""
    found = docs.select("doc_id", F.explode(text.tokens(text.strip_code(F.col(column)), stopwords)).alias("term"))
    return found.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def document_frequency(tf: DataFrame) -> DataFrame:
    """(term, df) over a term table that has each term of a document once."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def with_document_frequency(tf: DataFrame, df: DataFrame, n: int) -> DataFrame:
    """tf with df. Hot terms, of which there is a bounded number, meet their rows by broadcast, the rest by shuffle."""
    least = max(2, int(n * HOT_SHARE))
    hot, cold = df.filter(F.col("df") >= least), df.filter(F.col("df") < least)
    first = tf.join(F.broadcast(hot), "term", "left")
    rest = first.filter(F.col("df").isNull()).drop("df").join(cold, "term")
    return first.filter(F.col("df").isNotNull()).unionByName(rest)


def weight(tf: Column, df: Column, n: int) -> Column:
    return F.round((1 + F.log(tf.cast("double"))) * (F.log((F.lit(n) + 1.0) / (df + 1.0)) + 1), DIGITS)


def ranked(scored: DataFrame, wanted: Column | int, by: str = "score", keys: list[str] | None = None) -> DataFrame:
    """The first ``wanted`` terms of each document, best first, equals by term."""
    w = Window.partitionBy(*(keys or ["doc_id"])).orderBy(F.desc(by), "term")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= wanted)


def tfidf(docs: DataFrame, column: str = "text") -> DataFrame:
    """(doc_id, term, tf, df, score)."""
    tf = materialize(term_frequency(docs, column), "tf")
    df = materialize(document_frequency(tf), "df")
    n = tf.select("doc_id").distinct().count()
    return with_document_frequency(tf, df, n).withColumn("score", weight(F.col("tf"), F.col("df"), n))


def keywords_tfidf(docs: DataFrame, n: int = 8) -> DataFrame:
    """(doc_id, term, score, rank)."""
    return ranked(tfidf(docs), n).select("doc_id", "term", "score", "rank")


def keywords_raw(docs: DataFrame, n: int = 8) -> DataFrame:
    """By plain count, for collections too small to weigh."""
    return ranked(term_frequency(docs).withColumn("score", F.col("tf").cast("double")), n).select("doc_id", "term", "score", "rank")


def keywords_by_group(docs: DataFrame, group: str, n: int = 10) -> DataFrame:
    """(group, term, df, rank): terms of the most documents in each group; pre-aggregated, so a group may be of any size."""
    tf = term_frequency(docs).join(docs.select("doc_id", group).dropDuplicates(["doc_id"]), "doc_id")
    counted = tf.groupBy(group, "term").agg(F.count("*").alias("df"))
    return ranked(counted, n, "df", [group]).select(group, "term", "df", "rank")


def judged(docs: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """(doc_id, term, score, rank, wanted, verdict): the ranked terms with headroom, judged as words or debris.

    lexicon: (term), lower case; a term counts as known with or without its hyphens.
    """
    # one pass over the texts: terms, the number of words, and which terms stand with a capital within a sentence
    split = docs.select("doc_id", text.words(text.strip_code(F.col("text"))).alias("words"))
    counted = split.select("doc_id", F.size("words").alias("n"), F.explode(text.kept_words(F.col("words"))).alias("term"))
    found = counted.select("doc_id", text.keyword_count(F.col("n")).alias("wanted"), "term")
    tf = materialize(found.groupBy("doc_id", "wanted", "term").agg(F.count("*").alias("tf")), "tf")
    df = materialize(document_frequency(tf), "df")
    n = tf.select("doc_id").distinct().count()
    scored = with_document_frequency(tf, df, n).withColumn("score", weight(F.col("tf"), F.col("df"), n))
    first = ranked(scored, F.col("wanted") + HEADROOM)
    known = F.lit(False)
    if lexicon is not None:
        # a lexicon is as large as its files: the planner decides how to join it
        listed = lexicon.select(F.col("term").alias("listed")).distinct()
        plain = listed.withColumnRenamed("listed", "listed_plain")
        first = first.join(listed, F.col("term") == F.col("listed"), "left").join(plain, F.replace(F.col("term"), F.lit("-"), F.lit("")) == F.col("listed_plain"), "left")
        known = F.col("listed").isNotNull() | F.col("listed_plain").isNotNull()
    first = materialize(first.withColumn("known", known), "ranked")
    # capitals are looked for only where they could save a term
    asked = first.filter(artifacts.verdict(F.col("term"), F.col("df"), F.col("known"), F.lit(False)) == "soft").select("doc_id").distinct()
    names = docs.select("doc_id", "text").join(asked, "doc_id", "left_semi").select("doc_id", text.capitalised_terms(F.col("text")).alias("names"))
    named = first.join(names, "doc_id", "left")
    said = artifacts.verdict(F.col("term"), F.col("df"), F.col("known"), F.array_contains("names", F.col("term")))
    return named.withColumn("verdict", said).select("doc_id", "term", "score", "rank", "wanted", "verdict")


def keywords_filtered(docs: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """(doc_id, keywords): what documents keep, as many as their length asks for, in alphabetical order."""
    kept = judged(docs, lexicon).filter(F.col("verdict") == "kept").drop("rank")
    best = ranked(kept, F.col("wanted"))
    return best.groupBy("doc_id").agg(F.array_sort(F.collect_list("term")).alias("keywords"))


def rejected_report(docs: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """(term, tier, reason, documents, first_doc) of rejected terms."""
    bad = judged(docs, lexicon).filter(F.col("verdict") != "kept")
    reason = F.when(F.col("verdict") == "hard", artifacts.hard_reason(F.col("term"))).otherwise(artifacts.soft_reason(F.col("term")))
    return bad.groupBy("term", F.col("verdict").alias("tier"), reason.alias("reason")).agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_doc"))
