"""Queries of the corpus problems, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import conversations, history_dedup, leakage, mojibake, packing, pii, scan_noise, term_counts, term_residuals
from folioscope.runtime import materialize, scratch_dir, spread
from folioscope.runtime import table as stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(stored(spark, sf_dir, name))


Query = Callable[[SparkSession, str], DataFrame]


def _faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.faults(docs, materialize(packing.containers(docs), "containers"))


def queries() -> dict[str, Query]:
    return {
        "p1_found": lambda s, d: term_counts.found(table(s, d, "digested_docs")),
        "p1_term_counts": lambda s, d: term_counts.term_counts(table(s, d, "digested_docs")),
        "p2_found": lambda s, d: scan_noise.found(table(s, d, "pdf_pages")),
        "p2_repaired": lambda s, d: scan_noise.repaired_pages(table(s, d, "pdf_pages")),
        "p3_found": lambda s, d: conversations.conversations(table(s, d, "chat_messages")),
        "p3_threads": lambda s, d: conversations.threads(table(s, d, "chat_messages")),
        "p4_found": lambda s, d: pii.found(table(s, d, "chat_messages"), table(s, d, "file_ops")),
        "p4_redacted": lambda s, d: pii.redacted(table(s, d, "chat_messages"), table(s, d, "file_ops")),
        "p6_found": lambda s, d: term_residuals.found(table(s, d, "digested_docs")),
        "p6_residuals": lambda s, d: term_residuals.most_characteristic(table(s, d, "digested_docs")),
        "p7_found": lambda s, d: history_dedup.found(table(s, d, "export_conversations")),
        "p7_duplicates": lambda s, d: history_dedup.duplicates(table(s, d, "export_conversations")),
        "p7_incremental": lambda s, d: history_dedup.incremental(table(s, d, "export_conversations"), f"{scratch_dir(s)}/history-{uuid.uuid4().hex}"),
        "p8_containers": lambda s, d: packing.containers(table(s, d, "documents")),
        "p8_faults": _faults,
        "p8_fill": lambda s, d: packing.fill(packing.containers(table(s, d, "documents"))),
        "p9_found": lambda s, d: leakage.found(table(s, d, "documents"), table(s, d, "eval_items")),
        "p9_extent": lambda s, d: leakage.leaks(table(s, d, "documents"), table(s, d, "eval_items")).select("doc_id", "item_id", "runs", F.round("question_share", 6).alias("question_share"), "answer_seen", "extent"),
        "p9_leaks": lambda s, d: leakage.leaks(table(s, d, "documents"), table(s, d, "eval_items")),
        "p10_found": lambda s, d: mojibake.found(table(s, d, "documents")),
        "p10_restored": lambda s, d: mojibake.restored(table(s, d, "documents")),
    }


#: Outer white space as the operators strip it.
_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_TERMS = f"""
WITH docs AS (SELECT digest_id, any_value(keywords) AS keywords, any_value(word_count) AS word_count
              FROM digested_docs WHERE digest_id IS NOT NULL GROUP BY digest_id),
raw AS (SELECT digest_id, lower(regexp_replace(nfc_normalize(k), '^{_SPACE}|{_SPACE}$', '', 'g')) AS term
        FROM (SELECT digest_id, unnest(keywords) AS k FROM docs)),
cells AS (SELECT digest_id, nfc_normalize(term) AS term, count(*) AS tf FROM raw WHERE term IS NOT NULL AND term <> '' GROUP BY 1, 2)
"""
_COUNTS = (
    _TERMS
    + """, counted AS (
  SELECT 'keywords' AS field_name, term, sum(tf)::BIGINT AS occurrences, count(*) AS records FROM cells GROUP BY term
  UNION ALL
  SELECT 'word_count', word_count::VARCHAR, count(*), count(*) FROM docs WHERE word_count IS NOT NULL GROUP BY word_count),
marked AS (SELECT *, CASE WHEN records <= 2 THEN 'rare' WHEN records * 100 > 5 * (SELECT count(*) FROM docs) THEN 'common' END AS mark FROM counted)
"""
)
_WEIGHED = (
    _TERMS
    + """, cols AS (SELECT term, count(*) AS df, sum(tf) AS ct FROM cells GROUP BY term),
rws AS (SELECT digest_id, sum(tf) AS rt FROM cells GROUP BY digest_id),
tot AS (SELECT count(*) AS n, sum(rt) AS t FROM rws),
scored AS (SELECT digest_id, term,
   round((1 + ln(tf)) * (ln((n + 1) / (df + 1)) + 1), 9) AS weight,
   round(CASE WHEN (1 - rt / t) * (1 - ct / t) > 0 THEN (tf - rt * ct / t) / sqrt(rt * ct / t) / sqrt((1 - rt / t) * (1 - ct / t)) ELSE 0 END, 9) AS adjusted
 FROM cells JOIN cols USING (term) JOIN rws USING (digest_id), tot)
"""
)
_BLANK = r"^[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]*$"
_CONVERSATIONS = rf"""
WITH RECURSIVE m AS (
  SELECT conv_uuid AS c, msg_uuid AS id, any_value(nullif(parent_uuid, '00000000-0000-4000-8000-000000000000')) AS up,
    any_value(parent_uuid) AS parent, any_value(created_at) AS made,
    CASE WHEN regexp_matches(coalesce(any_value(sender), ''), '{_BLANK}') THEN NULL
         WHEN lower(trim(any_value(sender))) IN ('assistant', 'ai', 'claude', 'bot', 'model', 'chatgpt', 'gpt') THEN 'assistant' ELSE 'user' END AS role,
    regexp_matches(coalesce(any_value(text), ''), '{_BLANK}')
      AND len(list_filter(coalesce(any_value(content), []), lambda b: NOT (regexp_matches(coalesce(b.text, ''), '{_BLANK}') AND regexp_matches(coalesce(b.thinking, ''), '{_BLANK}')))) = 0 AS blank
  FROM chat_messages WHERE conv_uuid IS NOT NULL AND msg_uuid IS NOT NULL GROUP BY 1, 2),
state AS (SELECT c, count(parent) = 0 AS flat FROM m GROUP BY c HAVING count(role) = count(*) AND NOT bool_and(blank)),
walk AS (
  SELECT m.c, id, id AS below, up FROM m JOIN state USING (c) WHERE NOT flat
  UNION
  SELECT w.c, m.id, w.below, m.up FROM walk w JOIN m ON m.c = w.c AND m.id = w.up),
whole AS (SELECT c FROM m JOIN state USING (c) WHERE NOT flat GROUP BY c
  HAVING count(*) = (SELECT count(DISTINCT w.below) FROM walk w WHERE w.c = m.c AND w.up IS NULL)),
best AS (SELECT c, w.id, any_value(w.up) AS up, max({{'at': coalesce(b.made, TIMESTAMPTZ '1900-01-01'), 'id': w.below}}) AS best
  FROM walk w JOIN whole USING (c) JOIN (SELECT c, id AS other, made FROM m) b USING (c) WHERE b.other = w.below GROUP BY 1, 2),
chosen AS (SELECT c, id FROM best QUALIFY row_number() OVER (PARTITION BY c, up ORDER BY best DESC) = 1),
path AS (SELECT w.c, w.below AS id, count(*)::INT AS turn_no FROM walk w JOIN whole USING (c) LEFT JOIN chosen k ON k.c = w.c AND k.id = w.id
  GROUP BY 1, 2 HAVING count(k.id) = count(*)),
turns AS (SELECT c, id, turn_no FROM path UNION ALL
  SELECT c, id, row_number() OVER (PARTITION BY c ORDER BY coalesce(made, TIMESTAMPTZ '1900-01-01'), id)::INT FROM m JOIN state USING (c) WHERE flat),
follow AS (SELECT c, id, turn_no, role, lead(role) OVER w AS next_role, lead(blank) OVER w AS next_blank FROM turns JOIN m USING (c, id)
  WINDOW w AS (PARTITION BY c ORDER BY turn_no))
SELECT c AS conv_uuid, turn_no, id AS msg_uuid, role AS speaker_role FROM follow
WHERE c NOT IN (SELECT c FROM follow WHERE role = 'user' AND NOT coalesce(next_role = 'assistant' AND NOT next_blank, false))
"""
_RUNS = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(passage), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
dr AS (SELECT DISTINCT doc_id, hash(array_to_string(w[k : k + 12], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d)),
ir AS (SELECT DISTINCT item_id, hash(array_to_string(w[k : k + 12], ' ')) AS h FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i))
SELECT DISTINCT doc_id, item_id FROM dr JOIN ir USING (h)
"""


_EXTENT = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(passage), '[\\p{L}\\p{N}]+') AS w, list_distinct(regexp_extract_all(lower(coalesce(question, '')), '[\\p{L}\\p{N}]+')) AS q, regexp_extract_all(lower(coalesce(answer, '')), '[\\p{L}\\p{N}]+') AS a FROM eval_items),
dr AS (SELECT doc_id, hash(array_to_string(w[k : k + 12], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d)),
ir AS (SELECT DISTINCT item_id, hash(array_to_string(w[k : k + 12], ' ')) AS h FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i)),
m AS (SELECT doc_id, item_id, count(*)::INT AS runs FROM dr JOIN ir USING (h) GROUP BY ALL),
x AS (SELECT doc_id, item_id, runs, CASE WHEN len(q) > 0 THEN round(len(list_intersect(q, list_distinct(d.w))) / len(q), 6) ELSE 0 END AS question_share, len(a) > 0 AND list_has_all(d.w, a) AS answer_seen, len(q) > 0 AS posed FROM m JOIN d USING (doc_id) JOIN i USING (item_id))
SELECT doc_id, item_id, runs, question_share, answer_seen, CASE WHEN answer_seen AND posed AND question_share >= 0.8 THEN 'whole item' WHEN answer_seen THEN 'passage and answer' WHEN posed AND question_share >= 0.8 THEN 'passage and question' ELSE 'passage' END AS extent FROM x
"""
_NO_FAULTS = "SELECT unnest(['document that is nowhere', 'document that is not in the table', 'piece placed twice', 'container above its capacity', 'document split though it fits', 'piece cut short']) AS fault, 0::BIGINT AS n"


def oracle_sql() -> dict[str, str]:
    return {
        "p8_faults": _NO_FAULTS,
        "p9_extent": _EXTENT,
        "p1_found": _COUNTS + "SELECT field_name, term, mark FROM marked WHERE mark IS NOT NULL",
        "p1_term_counts": _COUNTS + "SELECT field_name, term, occurrences, records, mark FROM marked",
        "p3_found": _CONVERSATIONS,
        "p6_found": _WEIGHED + "SELECT digest_id, term FROM scored QUALIFY row_number() OVER (PARTITION BY digest_id ORDER BY weight DESC, term) = 1",
        "p6_residuals": _WEIGHED + "SELECT digest_id, term FROM scored QUALIFY row_number() OVER (PARTITION BY digest_id ORDER BY adjusted DESC, term) = 1",
        "p9_found": _RUNS,
    }
