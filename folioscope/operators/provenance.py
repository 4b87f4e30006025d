"""Who speaks in a document: turns by role heading or by label, its class, and terms weighted by speaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text
from folioscope.operators.keywords import SUBJECT_WEIGHT, document_frequency, ranked, weight, with_document_frequency
from folioscope.runtime import materialize

# Role headings and labels of converted conversations.
ROLE = r"(?m)^##[ \t]+(Human|User|Assistant|System|Tool)\b[^\n]*$"
LABEL = r"(?m)^[ \t]{0,3}\*\*([A-Z][A-Za-z0-9 .'’-]{0,39}):\*\*"
SUBJECTS, OTHERS = ["Human", "User"], ["Assistant", "System", "Tool"]
MACHINES = "claude chatgpt gpt ai assistant bot copilot gemini bard llama model system tool".split()
AI_SOURCE = r"(?i)chatgpt|claude|gpt|openai|anthropic"


def roles(body: Column) -> Column:
    return F.regexp_extract_all(text.classifiable_text(body), F.lit(ROLE), F.lit(1))


def labels(body: Column) -> Column:
    return F.transform(F.regexp_extract_all(text.classifiable_text(body), F.lit(LABEL), F.lit(1)), F.trim)


def recurring(names: Column) -> Column:
    """Names that stand at least twice, sorted."""
    return F.array_sort(F.filter(F.array_distinct(names), lambda n: F.size(F.filter(names, lambda m: m == n)) >= 2))


def structure(body: Column, source: Column) -> Column:
    """turn-structured, speaker-labelled, single-voice or unknown; by what is found only, never by what is missing."""
    seen = roles(body)
    both = F.arrays_overlap(seen, F.array(*map(F.lit, SUBJECTS))) & F.arrays_overlap(seen, F.array(*map(F.lit, OTHERS)))
    named = F.trim(F.coalesce(source, F.lit("")))
    return F.when(both, "turn-structured").when(F.size(recurring(labels(body))) >= 2, "speaker-labelled").when((named != "") & ~named.rlike(AI_SOURCE), "single-voice").otherwise("unknown")


def subjects(body: Column, named: list[str] | None = None) -> Column:
    """The speakers whose words count as the subject's: those named, else the only one that is no machine, else none."""
    names = F.array_distinct(labels(body))
    if named:
        return F.filter(names, lambda n: F.lower(n).isin([x.lower() for x in named]))
    people = F.filter(names, lambda n: ~F.lower(n).isin(MACHINES))
    return F.when(F.size(people) == 1, people).otherwise(F.array().cast("array<string>"))


def turns(docs: DataFrame, named: list[str] | None = None) -> DataFrame:
    """(doc_id, turn_no, role, kind, segment) of turn-structured documents, and of labelled ones whose subject is known.

    Turn 0 is what stands before the first heading or label. Unlabelled prose goes on with the speaker before it. named: labels
    that are the subject's.
    """
    body = text.classifiable_text(F.col("text"))
    heads = r"^##[ \t]+(Human|User|Assistant|System|Tool)\b[^\n]*"
    shaped = docs.select("doc_id", body.alias("body"), structure(F.col("text"), F.col("source")).alias("shape"), subjects(F.col("text"), named).alias("own"))
    shaped = shaped.filter((F.col("shape") == "turn-structured") | ((F.col("shape") == "speaker-labelled") & (F.size("own") > 0)))
    cut = F.when(F.col("shape") == "turn-structured", F.split("body", r"(?m)(?=^##[ \t]+(?:Human|User|Assistant|System|Tool)\b)")).otherwise(F.split("body", "(?m)(?=" + LABEL.removeprefix("(?m)").replace("(", "(?:") + ")"))
    parts = shaped.select("doc_id", "shape", "own", F.posexplode(cut).alias("place", "part"))
    pattern = F.when(F.col("shape") == "turn-structured", F.regexp_extract("part", heads, 1)).otherwise(F.trim(F.regexp_extract("part", LABEL.removeprefix("(?m)"), 1)))
    found = parts.withColumn("role", F.nullif(pattern, F.lit(""))).filter(F.col("role").isNotNull() | (F.col("part") != ""))
    mine = F.when(F.col("shape") == "turn-structured", F.col("role").isin(SUBJECTS)).otherwise(F.array_contains("own", F.col("role")))
    kind = F.when(F.col("role").isNull(), "neutral").when(mine, "subject").otherwise("assistant")
    # a document that begins with a heading has no part before it
    order = Window.partitionBy("doc_id").orderBy("place")
    number = F.coalesce(F.when(F.col("role").isNull(), 0), F.sum(F.col("role").isNotNull().cast("int")).over(order)).cast("int")
    rest = F.when(F.col("shape") == "turn-structured", F.regexp_replace("part", heads, "")).otherwise(F.regexp_replace("part", LABEL.removeprefix("(?m)"), ""))
    return found.select("doc_id", number.alias("turn_no"), "role", kind.alias("kind"), F.when(F.col("role").isNull(), F.col("part")).otherwise(rest).alias("segment"))


def weighting(docs: DataFrame, named: list[str] | None = None) -> DataFrame:
    """(doc_id, structure, weighted, skipped): whether a document's terms are weighed by speaker, and if not, why."""
    shape = structure(F.col("text"), F.col("source"))
    spoken = docs.select("doc_id", shape.alias("structure"), F.size(subjects(F.col("text"), named)).alias("own"))
    counted = weighted_terms(docs, named).groupBy("doc_id").agg(F.count("*").alias("terms"))
    why = F.when(~F.col("structure").isin("turn-structured", "speaker-labelled"), F.concat(F.lit("structure is "), "structure")).when((F.col("structure") == "speaker-labelled") & (F.col("own") == 0), "subject could not be identified from the speaker labels").when(F.col("terms").isNull(), "no tokens survived filtering")
    return spoken.join(counted, "doc_id", "left").select("doc_id", "structure", why.isNull().alias("weighted"), why.alias("skipped"))


def weighted_terms(docs: DataFrame, named: list[str] | None = None) -> DataFrame:
    """(doc_id, term, tf, in_subject, weighted): a term of the subject's turns counts ``SUBJECT_WEIGHT`` times."""
    found = turns(docs, named).select("doc_id", (F.col("kind") == "subject").alias("own"), F.explode(text.tokens(text.strip_code(F.col("segment")))).alias("term"))
    counted = found.groupBy("doc_id", "term").agg(F.count("*").alias("tf"), F.bool_or("own").alias("in_subject"))
    return counted.withColumn("weighted", F.col("tf") * F.when(F.col("in_subject"), SUBJECT_WEIGHT).otherwise(1))


def keywords_weighted(docs: DataFrame, n: int = 8, named: list[str] | None = None) -> DataFrame:
    """(doc_id, term, score, rank) of documents whose speakers are known, weighed by speaker and against their collection."""
    tf = materialize(weighted_terms(docs, named), "weighted")
    df = materialize(document_frequency(tf), "df")
    total = tf.select("doc_id").distinct().count()
    scored = with_document_frequency(tf, df, total).withColumn("score", weight(F.col("weighted"), F.col("df"), total))
    return ranked(scored, n).select("doc_id", "term", "score", "rank")


def structure_tally(docs: DataFrame, named: list[str] | None = None) -> DataFrame:
    """(structure, documents, ai_source, weighted, blocked), with a total in the row whose structure is null.

    Blocked are labelled documents whose subject is not known; naming the subject would weigh them.
    """
    ai = docs.select("doc_id", F.coalesce(F.col("source").rlike(AI_SOURCE), F.lit(False)).alias("ai"))
    found = weighting(docs, named).join(ai, "doc_id")
    blocked = (F.col("structure") == "speaker-labelled") & ~F.col("weighted")
    return found.rollup("structure").agg(F.count("*").alias("documents"), F.count_if("ai").alias("ai_source"), F.count_if("weighted").alias("weighted"), F.count_if(blocked).alias("blocked"))
