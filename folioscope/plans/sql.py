"""The core's queries as SQL for DuckDB. Patterns keep to RE2, which knows no look-around and no back-references."""

from __future__ import annotations

from folioscope.functions.artifacts import PAIRS, TRIPLE
from folioscope.functions.text import STOPWORDS
from folioscope.operators.audit import TOOL_FILES
from folioscope.operators.inventory import ACCOUNT_FILES, MEDIA
from folioscope.operators.provenance import MACHINES
from folioscope.plans.catalog import HEADS, PLACES


def _list(items: list[str]) -> str:
    return ", ".join(f"'{i}'" for i in items)


def _code(t: str) -> str:
    out = t
    for p in (r"(?s)```.*?```", "`[^`]+`", r"\[[a-z_]*asset_pointer content omitted\]", r"\[audio_transcription content omitted\]", r"\*\[\d+ reasoning steps?\]\*"):
        out = f"regexp_replace({out}, '{p}', ' ', 'g')"
    return out


_INDEX = r"(?s)<!-- BEGIN AUTO INDEX -->.*?<!-- END AUTO INDEX -->\n*"
_WORDS = "regexp_extract_all({}, '[A-Za-z][A-Za-z''-]{{2,}}')"
_CLASSIFIABLE = rf"regexp_replace(regexp_replace(text, '{_INDEX}', ' ', 'g'), '(?s)```.*?```', ' ', 'g')"
_N = f"len({_WORDS.format(_code('text'))})"
_SCALE = f"CASE WHEN {_N} < 500 THEN 8 WHEN {_N} < 2000 THEN 12 WHEN {_N} < 5000 THEN 18 WHEN {_N} < 15000 THEN 25 ELSE least(40, 10 + {_N} // 500) END"
_FRONT = r"regexp_extract(text, '(?s)\A---\n(.*?)\n---\n?', 1)"
_BODY = r"regexp_replace(text, '(?s)\A---\n(.*?)\n---\n?', '')"
_STOP = _list(STOPWORDS)
_DIGESTS = "dd AS (SELECT DISTINCT ON (digest_id) * FROM digested_docs)"
_FILES = "ff AS (SELECT concat(source_path, '-', digest_id, '.', CASE WHEN regexp_matches(source, '^[a-z]+$') THEN source ELSE 'md' END) AS path, source_bytes AS size, source_sha256 AS sha256, digest_id FROM dd)"
_TF = f"""
toks AS (SELECT doc_id, lower(unnest({_WORDS.format(_code('text'))})) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE len(term) >= 4 AND term NOT IN ({_STOP}) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
nn AS (SELECT count(DISTINCT doc_id) AS n FROM tf)
"""
_TFIDF = _TF + ", scored AS (SELECT doc_id, term, tf, df, round((1 + ln(tf)) * (ln((n + 1.0) / (df + 1.0)) + 1), 6) AS score FROM tf JOIN df USING (term), nn)"
_RANKED = _TFIDF + ", rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term)::INT AS rank FROM scored)"
_LETTERS = "regexp_replace(term, '[^a-z]', '', 'g')"
_HARD = f"""CASE WHEN {_LETTERS} = '' THEN 'no letters' WHEN regexp_matches(term, '[0-9]') THEN 'letters mixed with digits'
 WHEN len({_LETTERS}) >= 4 AND NOT regexp_matches({_LETTERS}, '[aeiouyw]') THEN 'no vowel' WHEN regexp_matches(term, 'q([^u]|$)') THEN 'q without u'
 WHEN regexp_matches(term, '{TRIPLE}') THEN 'letter three times' WHEN regexp_matches(term, '[b-df-hj-np-tv-xz]{{7}}') THEN 'consonant run' END"""
_PAIR = f"regexp_extract({_LETTERS}, '({'|'.join(PAIRS)})', 1)"
_SOFT = f"CASE WHEN len({_LETTERS}) >= 4 AND {_PAIR} <> '' THEN 'pair ' || {_PAIR} WHEN len({_LETTERS}) >= 4 AND regexp_matches(term, '[b-df-hj-np-tv-xz]{{6}}') THEN 'consonant run' END"
_LEXICON = "lex AS (SELECT DISTINCT lower(trim(k)) AS term FROM (SELECT unnest(keywords) AS k FROM dd) WHERE lower(trim(k)) <> '')"
_ROLES = rf"regexp_extract_all({_CLASSIFIABLE}, '(?m)^##[ \t]+(Human|User|Assistant|System|Tool)\b[^\n]*$', 1)"
_LABELS = rf"list_transform(regexp_extract_all({_CLASSIFIABLE}, '(?m)^[ \t]{{0,3}}\*\*([A-Z][A-Za-z0-9 .''’-]{{0,39}}):\*\*', 1), lambda x: trim(x))"
_STRUCTURE = f"""CASE WHEN list_has_any({_ROLES}, ['Human', 'User']) AND list_has_any({_ROLES}, ['Assistant', 'System', 'Tool']) THEN 'turn-structured'
 WHEN len(list_filter(list_distinct({_LABELS}), lambda n: len(list_filter({_LABELS}, lambda m: m = n)) >= 2)) >= 2 THEN 'speaker-labelled'
 WHEN trim(coalesce(source, '')) <> '' AND NOT regexp_matches(source, '(?i)chatgpt|claude|gpt|openai|anthropic') THEN 'single-voice' ELSE 'unknown' END"""
_NAMES = f"list_distinct({_LABELS})"
_PEOPLE = f"list_filter({_NAMES}, lambda n: lower(n) NOT IN ({_list(MACHINES)}))"
_TURNS = rf"""
src AS (SELECT doc_id, {_CLASSIFIABLE} AS body, {_STRUCTURE} AS shape, CASE WHEN len({_PEOPLE}) = 1 THEN {_PEOPLE} ELSE [] END AS own FROM documents),
marked AS (SELECT doc_id, shape, own, CASE WHEN shape = 'turn-structured' THEN regexp_replace(body, '(?m)^(##[ \t]+(?:Human|User|Assistant|System|Tool)\b)', chr(1) || '\1', 'g')
  ELSE regexp_replace(body, '(?m)^([ \t]{{0,3}}\*\*(?:[A-Z][A-Za-z0-9 .''’-]{{0,39}}):\*\*)', chr(1) || '\1', 'g') END AS body FROM src WHERE shape = 'turn-structured' OR shape = 'speaker-labelled' AND len(own) > 0),
parts AS (SELECT doc_id, shape, own, generate_subscripts(p, 1) AS place, unnest(p) AS part FROM (SELECT doc_id, shape, own, string_split(body, chr(1)) AS p FROM marked)),
roled AS (SELECT *, nullif(CASE WHEN shape = 'turn-structured' THEN regexp_extract(part, '^##[ \t]+(Human|User|Assistant|System|Tool)\b', 1) ELSE trim(regexp_extract(part, '^[ \t]{{0,3}}\*\*([A-Z][A-Za-z0-9 .''’-]{{0,39}}):\*\*', 1)) END, '') AS role FROM parts),
turns AS (SELECT doc_id, CASE WHEN role IS NULL THEN 0 ELSE sum((role IS NOT NULL)::INT) OVER (PARTITION BY doc_id ORDER BY place) END::INT AS turn_no, role,
  CASE WHEN role IS NULL THEN 'neutral' WHEN CASE WHEN shape = 'turn-structured' THEN role IN ('Human', 'User') ELSE list_contains(own, role) END THEN 'subject' ELSE 'assistant' END AS kind,
  CASE WHEN role IS NULL THEN part WHEN shape = 'turn-structured' THEN regexp_replace(part, '^##[ \t]+(?:Human|User|Assistant|System|Tool)\b[^\n]*', '') ELSE regexp_replace(part, '^[ \t]{{0,3}}\*\*[A-Z][A-Za-z0-9 .''’-]{{0,39}}:\*\*', '') END AS segment FROM roled WHERE role IS NOT NULL OR part <> ''),
wt AS (SELECT doc_id, term, count(*) AS tf, bool_or(own) AS in_subject, count(*) * CASE WHEN bool_or(own) THEN 128 ELSE 1 END AS weighted
  FROM (SELECT doc_id, kind = 'subject' AS own, lower(unnest({_WORDS.format(_code('segment'))})) AS term FROM turns) WHERE len(term) >= 4 AND term NOT IN ({_STOP}) GROUP BY doc_id, term)
"""
_NORMAL = f"list_transform({_WORDS.format(_code(f'regexp_replace({_BODY}, {chr(39)}{_INDEX}{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})'))}, lambda w: lower(w))"


def _windows(name: str, source: str) -> str:
    return f"""{name}_t AS (SELECT doc_id, {_NORMAL} AS t FROM {source}),
{name}_s AS (SELECT doc_id, t, len(t) - 40 AS span, greatest(1, (len(t) - 40) // 7) AS step FROM {name}_t WHERE len(t) >= 40),
{name}_h AS (SELECT doc_id, k, md5(array_to_string(t[k + 1 : k + 40], ' ')) AS h FROM (SELECT doc_id, t, unnest(range(0, span + 1, step)) AS k FROM {name}_s)),
{name}_f AS (SELECT doc_id, h, min(k) AS k FROM {name}_h GROUP BY ALL),
{name} AS (SELECT doc_id, h AS window_hash FROM {name}_f QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY k) <= 8)"""


_UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


def _get(*names: str) -> str:
    return "coalesce(" + ", ".join(f"json_extract_string(j, '$.{n}')" for n in names) + ")"


_MANIFESTS = rf"""
js AS (SELECT file_id, file_name, written_at, CASE WHEN json_valid(raw_json) THEN raw_json::JSON END AS j FROM manifest_files),
mf AS (SELECT file_id, lower(regexp_extract(file_name, '(?i)({_UUID})', 1)) AS file_project, written_at, j IS NOT NULL AS valid,
 lower(regexp_replace(regexp_replace({_get('project_uuid', 'project_id', 'projectUuid')}, '^urn:uuid:|[{{}}]', '', 'g'), '-', '', 'g')) AS project,
 try_cast(regexp_extract({_get('revision', 'revision_no', 'rev')}, '(\d+)', 1) AS INT) AS revision,
 try_cast({_get('conversation_count', 'n_conversations', 'conversationCount')} AS INT) AS declared,
 CASE WHEN json_type(j, '$.conversations') = 'ARRAY' THEN list_transform(json_extract(j, '$.conversations[*]'), lambda e: coalesce(json_extract_string(e, '$.uuid'), json_extract_string(e, '$.conversation_uuid'), json_extract_string(e, '$.id'))) END AS entries
 FROM js),
newest_mf AS (SELECT * FROM mf WHERE valid QUALIFY row_number() OVER (PARTITION BY file_project ORDER BY written_at DESC NULLS LAST, file_id DESC) = 1),
claims AS (SELECT file_project, written_at, unnest(entries) AS conv_uuid FROM newest_mf),
placed AS (SELECT conv_uuid, arg_min(file_project, {{'w': written_at, 'p': file_project}}) AS project, count(DISTINCT file_project) AS projects FROM claims WHERE conv_uuid IS NOT NULL GROUP BY conv_uuid)
"""
_VERSIONS = "vs AS (SELECT conv_uuid, export_key, max(exported_at) AS exported_at, count(DISTINCT msg_uuid) AS messages, max(created_at) AS last_activity FROM chat_messages WHERE conv_uuid IS NOT NULL GROUP BY ALL), nv AS (SELECT * FROM vs QUALIFY row_number() OVER (PARTITION BY conv_uuid ORDER BY exported_at DESC, export_key DESC) = 1)"
_SLUG = r"trim(regexp_replace(regexp_replace(lower(trim({})), '[^\p{{L}}\p{{N}}\p{{M}}\p{{Pc}}\s-]', '', 'g'), '[\s_-]+', '-', 'g'), '-')"
_DATE = r"""CASE WHEN regexp_matches(trim(doc_date), '^D:\d{8}') THEN try_cast(regexp_replace(trim(doc_date), '^D:(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})([+-]\d{2})''(\d{2})''?$', '\1-\2-\3 \4:\5:\6\7:\8') AS TIMESTAMPTZ)
 WHEN regexp_matches(trim(doc_date), '^\d{4}/\d{2}/\d{2}$') THEN try_cast(replace(trim(doc_date), '/', '-') AS TIMESTAMPTZ)
 WHEN regexp_matches(trim(doc_date), '^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$') THEN try_cast(regexp_replace(trim(doc_date), '^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})([+-Z].*)?$', '\1 \2:00\3') AS TIMESTAMPTZ) END"""
_TOTALS = "count(*) AS files"

_NODES = r"""
nd AS (SELECT conv_uuid AS conv_id, msg_uuid AS node_id, any_value(nullif(parent_uuid, '00000000-0000-4000-8000-000000000000')) AS parent, any_value(created_at) AS made, any_value(text) AS text,
 any_value(CASE WHEN lower(trim(coalesce(sender, ''))) IN ('human', 'user') THEN 'user' WHEN lower(trim(coalesce(sender, ''))) IN ('system', 'tool') THEN lower(trim(sender)) ELSE 'assistant' END) AS role,
 any_value(list_filter(list_transform(coalesce(content, []), lambda b: b.text), lambda x: x IS NOT NULL)) AS said FROM chat_messages WHERE conv_uuid IS NOT NULL AND msg_uuid IS NOT NULL GROUP BY 1, 2),
sh AS (SELECT *, regexp_replace(CASE WHEN len(said) > 0 THEN array_to_string(said, chr(10)) ELSE coalesce(text, '') END, '^\s+|\s+$', '', 'g') AS shown FROM nd),
blocks AS (SELECT *, CASE WHEN shown = '' AND role = 'system' THEN NULL WHEN shown = '' AND role = 'assistant' THEN chr(1)
 ELSE '## ' || upper(role[1]) || role[2:] || coalesce(chr(10) || '*' || strftime(made, '%Y-%m-%d %H:%M:%S') || '*', '') || CASE WHEN shown <> '' THEN chr(10) || chr(10) || shown ELSE '' END END AS block FROM sh)
"""
_ASSETS = """
aa AS (SELECT project_uuid AS root, 'assets/' || lower(trim(coalesce(sender, 'none'))) || '/file-' || substr(replace(msg_uuid, '-', ''), 1, 12) || '-' || row_id || CASE WHEN text IS NULL THEN '.json' ELSE '.dat' END AS path, 'file-' || substr(replace(msg_uuid, '-', ''), 1, 12) AS asset_id FROM chat_messages WHERE project_uuid IS NOT NULL),
af AS (SELECT * FROM aa WHERE path NOT LIKE '%.json')
"""
_REFERENCES = "refs AS (SELECT DISTINCT conv_uuid AS conv_id, 'file-' || substr(replace(parent_uuid, '-', ''), 1, 12) AS asset_id FROM chat_messages WHERE parent_uuid IS NOT NULL AND conv_uuid IS NOT NULL)"
_DOCFILES = rf"""
dn AS (SELECT DISTINCT ON (doc_id) * FROM documents),
df1 AS (SELECT source || '/' || doc_id || CASE WHEN source LIKE 'pdf%' THEN '.pdf' ELSE '.md' END AS path, CASE WHEN source NOT LIKE 'pdf%' THEN text END AS content, chr(10) || {_FRONT} AS b FROM dn),
df2 AS (SELECT path, content, list_filter(['title', 'keywords', 'date', 'source'], lambda f: coalesce(trim(regexp_replace(trim(coalesce(regexp_extract_all(b, chr(10) || f || ':[ \t]*([^\n]*)', 1)[-1], '')), '^"(.*)"$', '\1')), '') = '') AS missing, len(missing) = 0 AS complete FROM df1)
"""

SQL: dict[str, str] = {
    "word_count_documents": f"SELECT doc_id, {_N}::INT AS words FROM documents",
    "keyword_count_scale": f"SELECT doc_id, ({_SCALE})::INT AS n FROM documents",
    "token_stats": f"WITH t AS (SELECT lang, lower(unnest({_WORDS.format(_code('text'))})) AS t FROM documents) SELECT lang, count(*) AS tokens, count(DISTINCT t) AS terms FROM t WHERE len(t) >= 4 AND t NOT IN ({_STOP}) GROUP BY lang",
    "strip_code_documents": f"SELECT doc_id, md5({_code('text')}) AS digest FROM documents",
    "classifiable_text_documents": f"SELECT doc_id, md5({_CLASSIFIABLE}) AS digest FROM documents",
    "slug_documents": f"SELECT doc_id, coalesce(nullif(substr({_SLUG.format('title')}, 1, 60), ''), 'untitled') AS slug, coalesce(nullif(rtrim(substr({_SLUG.format('title')}, 1, 60), '-'), ''), 'untitled') AS slug_clean FROM documents",
    "heading_outline": r"SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '(?m)^#{1,6}[ \t]+[^\n]+$')[1:25], lambda h: repeat('  ', len(regexp_extract(h, '^(#+)', 1)) - 1) || '- ' || trim(regexp_replace(h, '^#+[ \t]+', ''))), chr(10)) AS outline FROM documents",
    "title_documents": rf"SELECT doc_id, coalesce(nullif(trim(regexp_extract({_BODY}, '(?m)^#[ \t]+([^\n]+)$', 1)), ''), regexp_replace(regexp_replace(split_part(source, '/', -1), '(.)\.[^.]*$', '\1'), '[_-]', ' ', 'g')) AS title FROM documents",
    "frontmatter_fields": rf"""WITH b AS (SELECT doc_id, chr(10) || {_FRONT} AS b, {_BODY} AS body FROM documents),
 f AS (SELECT doc_id, body, trim(regexp_extract_all(b, '\ntitle:[ \t]*([^\n]*)', 1)[-1]) AS t, trim(regexp_extract_all(b, '\nsource:[ \t]*([^\n]*)', 1)[-1]) AS s, trim(regexp_extract_all(b, '\nkeywords:[ \t]*([^\n]*)', 1)[-1]) AS k FROM b)
 SELECT doc_id, nullif(regexp_replace(t, '^"(.*)"$', '\1'), '') AS title, nullif(regexp_replace(s, '^"(.*)"$', '\1'), '') AS source,
 CASE WHEN k LIKE '[%' THEN array_to_string(list_filter(list_transform(string_split(regexp_replace(k, '^\[\s*|\s*\]$', '', 'g'), ','), lambda x: regexp_replace(trim(x), '^"|"$', '', 'g')), lambda x: x <> ''), chr(10)) END AS keywords, md5(body) AS body FROM f""",
    "frontmatter_emit": f"""WITH {_DIGESTS} SELECT digest_id, '---' || chr(10) || array_to_string(list_filter(['title: "' || replace(replace(title, '\\', '\\\\'), '"', '\\"') || '"', 'source: "' || source || '"', 'word_count: ' || word_count, 'keywords_weighted: ' || keywords_weighted], lambda x: x IS NOT NULL), chr(10)) || chr(10) || '---' || chr(10) AS block FROM dd""",
    "frontmatter_roundtrip": f"WITH {_DIGESTS} SELECT digest_id, nullif(trim(title), '') AS title, nullif(trim(source), '') AS source, word_count FROM dd",
    "fenced_documents": "SELECT doc_id, md5(f || chr(10) || text || chr(10) || f) AS digest FROM (SELECT doc_id, text, repeat('`', greatest(3, coalesce(list_max(list_transform(regexp_extract_all(text, '`+'), lambda x: len(x))), 0) + 1)::INT) AS f FROM documents)",
    "clean_pages": r"SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[ \t]+(\n|$)', '\1', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS digest FROM pdf_pages",
    "escaped_cells": r"SELECT doc_id, md5(regexp_replace(replace(replace(text, '\', '\\'), '|', '\|'), '\r?\n', '<br>', 'g')) AS digest FROM documents",
    "truncated_documents": "SELECT doc_id, CASE WHEN len(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END AS head FROM documents",
    "safe_names": r"""WITH p AS (SELECT project_uuid, coalesce(nullif(substr(replace(project_uuid, '-', ''), 1, 8), ''), 'noid') AS short, trim(substr(trim(regexp_replace(regexp_replace(project_name, '[<>:"/\\|?*\x00-\x1f]', '_', 'g'), '\s+', ' ', 'g')), 1, 120)) AS n FROM projects) SELECT project_uuid, coalesce(nullif(n, ''), short) AS folder, short FROM p""",
    "path_keywords": rf"""WITH {_DIGESTS}, w AS (SELECT digest_id, string_split_regex(lower(concat_ws(' ', title, source_path)), '[\\/._\-\s]+') AS w FROM dd),
 u AS (SELECT digest_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM w), f AS (SELECT digest_id, t, min(i) AS i FROM u WHERE len(t) >= 3 AND t NOT IN ({_STOP}) GROUP BY ALL),
 k AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY digest_id ORDER BY i) <= 10), s AS (SELECT digest_id, string_agg(t, ',' ORDER BY i) AS keywords FROM k GROUP BY digest_id) SELECT digest_id, coalesce(s.keywords, '') AS keywords FROM dd LEFT JOIN s USING (digest_id)""",
    "term_frequency": f"WITH {_TF} SELECT doc_id, term, tf FROM tf",
    "doc_frequency": f"WITH {_TF} SELECT term, df FROM df",
    "keywords_tfidf_documents": f"WITH {_RANKED} SELECT doc_id, term, score, rank FROM rk WHERE rank <= 8",
    "keywords_raw_documents": f"WITH {_TF}, rk AS (SELECT doc_id, term, tf::DOUBLE AS score, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term)::INT AS rank FROM tf) SELECT * FROM rk WHERE rank <= 8",
    "keywords_by_lang": f"WITH {_TF}, c AS (SELECT lang, term, count(*) AS df FROM tf JOIN documents USING (doc_id) GROUP BY ALL), rk AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY df DESC, term)::INT AS rank FROM c) SELECT lang, term, df, rank FROM rk WHERE rank <= 10",
    "lexicon_veto": f"WITH {_DIGESTS}, {_TF}, {_LEXICON}, s AS (SELECT term, df FROM df WHERE ({_SOFT}) IS NOT NULL) SELECT s.term, df, lex.term IS NOT NULL AS listed, df >= 3 OR lex.term IS NOT NULL AS saved FROM s LEFT JOIN lex USING (term)",
    "artifact_hard": f"WITH {_TF}, r AS (SELECT term, {_HARD} AS reason FROM df) SELECT * FROM r WHERE reason IS NOT NULL",
    "artifact_soft": f"WITH {_TF}, r AS (SELECT term, {_SOFT} AS reason FROM df) SELECT * FROM r WHERE reason IS NOT NULL",
    "provenance_structure": f"SELECT doc_id, {_STRUCTURE} AS structure, array_to_string(list_sort(list_distinct({_ROLES})), chr(10)) AS roles FROM documents",
    "structure_tally": f"""WITH {_TURNS}, s AS (SELECT {_STRUCTURE} AS structure, coalesce(regexp_matches(source, '(?i)chatgpt|claude|gpt|openai|anthropic'), false) AS ai, doc_id IN (SELECT doc_id FROM wt) AS w FROM documents)
 SELECT structure, count(*) AS documents, count(*) FILTER (ai) AS ai_source, count(*) FILTER (w) AS weighted, count(*) FILTER (structure = 'speaker-labelled' AND NOT w) AS blocked FROM s GROUP BY ROLLUP (structure)""",
    "weighting": f"""WITH {_TURNS}, s AS (SELECT doc_id, {_STRUCTURE} AS structure, len({_PEOPLE}) = 1 AS known, doc_id IN (SELECT doc_id FROM wt) AS weighted FROM documents)
 SELECT doc_id, structure, weighted, CASE WHEN weighted THEN NULL WHEN structure NOT IN ('turn-structured', 'speaker-labelled') THEN 'structure is ' || structure WHEN structure = 'speaker-labelled' AND NOT known THEN 'subject could not be identified from the speaker labels' ELSE 'no tokens survived filtering' END AS skipped FROM s""",
    "turn_spans": f"WITH {_TURNS} SELECT doc_id, turn_no, role, kind, md5(segment) AS digest FROM turns",
    "weighted_terms": f"WITH {_TURNS} SELECT doc_id, term, tf, in_subject, weighted FROM wt",
    "keywords_weighted": f"WITH {_TURNS}, wdf AS (SELECT term, count(*) AS df FROM wt GROUP BY term), sc AS (SELECT doc_id, term, round((1 + ln(weighted)) * (ln(((SELECT count(DISTINCT doc_id) FROM wt) + 1.0) / (df + 1.0)) + 1), 6) AS score FROM wt JOIN wdf USING (term)), rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term)::INT AS rank FROM sc) SELECT * FROM rk WHERE rank <= 8",
    "fingerprint_windows": f"WITH {_windows('w', 'documents')} SELECT doc_id, window_hash FROM w",
    "duplicate_classes": f"""WITH RECURSIVE {_windows('w', 'documents')}, l AS (SELECT min(doc_id) AS a, window_hash FROM w GROUP BY window_hash HAVING count(*) > 1), e AS (SELECT DISTINCT a, doc_id AS b FROM w JOIN l USING (window_hash) WHERE doc_id <> a),
 b AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS id, a AS other FROM b UNION SELECT r.id, b.b FROM r JOIN b ON b.a = r.other), c AS (SELECT id, min(other) AS class_id FROM r GROUP BY id)
 SELECT id AS doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM c""",
    "shared_windows": f"""WITH items AS (SELECT item_id AS doc_id, passage AS text FROM eval_items), {_windows('w', 'documents')}, {_windows('x', 'items')},
 wc AS (SELECT min(doc_id) AS doc_id FROM (SELECT doc_id, list(window_hash ORDER BY window_hash) AS ws FROM w GROUP BY doc_id) GROUP BY ws), xc AS (SELECT min(doc_id) AS doc_id FROM (SELECT doc_id, list(window_hash ORDER BY window_hash) AS ws FROM x GROUP BY doc_id) GROUP BY ws)
 SELECT w.doc_id, x.doc_id AS other_id, count(*) AS windows FROM w JOIN x USING (window_hash) WHERE w.doc_id IN (SELECT doc_id FROM wc) AND x.doc_id IN (SELECT doc_id FROM xc) GROUP BY ALL""",
    "completeness_antijoin": rf"""WITH {_DIGESTS}, {_FILES}, raw AS (SELECT file_path AS path, max(octet_length(encode(text))) AS size, max(sha256(text)) AS sha FROM file_ops WHERE file_path IS NOT NULL GROUP BY 1 UNION ALL SELECT path, size, sha256 FROM ff),
 r AS (SELECT *, split_part(path, '/', -1) AS name FROM raw) SELECT path FROM r WHERE NOT EXISTS (SELECT 1 FROM dd WHERE source_path || '.md' IN (r.path, regexp_replace(r.path, '\.[^./]*$', '') || '.md', r.path || '.md'))
 AND name NOT IN (SELECT split_part(source_path, '/', -1) FROM dd WHERE source_path IS NOT NULL) AND path NOT IN (SELECT source_path FROM dd WHERE source_path IS NOT NULL) AND name NOT IN (SELECT split_part(source_path, '/', -1) || '.md' FROM dd WHERE source_path IS NOT NULL)
 AND NOT EXISTS (SELECT 1 FROM dd WHERE source <> 'pdf' AND source_bytes = r.size AND source_sha256 = r.sha)""",
    "index_differences": f"WITH {_DIGESTS} SELECT digest_id AS id, 'dangling' AS side FROM dd WHERE digest_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT doc_id, 'unindexed' FROM documents WHERE doc_id NOT IN (SELECT digest_id FROM dd)",
    "frontmatter_missing": f"WITH {_DIGESTS}, m AS (SELECT provenance_structure, unnest(list_filter([CASE WHEN trim(coalesce(title, '')) = '' THEN 'title' END, CASE WHEN trim(coalesce(array_to_string(keywords, ','), '')) = '' THEN 'keywords' END, CASE WHEN trim(coalesce(doc_date, '')) = '' THEN 'date' END, CASE WHEN trim(coalesce(source, '')) = '' THEN 'source' END], lambda x: x IS NOT NULL)) AS field FROM dd) SELECT provenance_structure, field, count(*) AS records FROM m GROUP BY ALL",
    "filename_conformance": r"SELECT file_id, regexp_matches(file_name, '(?i)^.+-(?:v\d+(?:\.\d+)*|draft\d*)\.[A-Za-z0-9]+$') OR regexp_matches(file_name, '^\d{4}-\d{2}-\d{2}-\d{4}__[a-z0-9]+(?:-[a-z0-9]+)*\.[A-Za-z0-9]+$') AS conforms FROM manifest_files",
    "utility_paths": rf"""WITH {_DIGESTS}, {_FILES}, p AS (SELECT digest_id, replace(([{_list(PLACES)}])[digest_id % {len(PLACES)} + 1], '*', path) AS path FROM ff)
 SELECT digest_id, regexp_matches(path, '(^|/)(_audit|_Tools|_ocr-cache|__pycache__|node_modules|\.[^/]*)/') OR regexp_matches(path, '(^|/)(~\$|\.)[^/]*$') OR regexp_matches(lower(path), '\.(pyc|pyo)$') OR split_part(path, '/', -1) IN ({_list(TOOL_FILES)}) AS utility FROM p""",
    "stale_classification": f"""WITH {_DIGESTS}, k AS (SELECT DISTINCT conv_uuid FROM chat_messages WHERE conv_uuid IS NOT NULL AND project_uuid IS NOT NULL), f AS (SELECT DISTINCT split_part(source, '/', -1) AS n FROM documents),
 r AS (SELECT CASE WHEN title IS NULL THEN 'no-frontmatter' WHEN NOT coalesce(keywords_weighted, false) THEN 'retired' WHEN source LIKE '%export%' THEN 'skipped' WHEN source_path IS NULL OR source IS NULL THEN 'orphan' WHEN regexp_replace(split_part(source_path, '/', -1), '-\\d+$', '') IN (SELECT n FROM f) THEN 'ok' ELSE 'absent-file' END AS state FROM dd
 UNION ALL SELECT CASE WHEN coalesce(failed, false) THEN 'retired' WHEN conv_uuid IS NULL THEN 'orphan' WHEN conv_uuid IN (SELECT conv_uuid FROM k) THEN 'ok' ELSE 'absent-conversation' END FROM file_ops) SELECT state, count(*) AS records FROM r GROUP BY state""",
    "rename_detection": f"WITH {_DIGESTS}, {_FILES}, w AS (SELECT size, sha256, min(path) AS new_path FROM ff GROUP BY ALL) SELECT 'moved/' || path AS path, new_path FROM ff  JOIN w USING (size, sha256)",
    "export_times": "SELECT export_key, coalesce(max(created_at), max(exported_at)) AS export_time, count(DISTINCT conv_uuid) AS conversations, count(DISTINCT msg_uuid) AS messages FROM chat_messages GROUP BY export_key",
    "newest_versions": f"WITH {_VERSIONS} SELECT * FROM nv",
    "earlier_versions_kept": f"WITH {_VERSIONS}, h AS (SELECT DISTINCT conv_uuid, export_key, msg_uuid FROM chat_messages WHERE conv_uuid IS NOT NULL), t AS (SELECT h.*, nv.export_key AS nk FROM h JOIN nv USING (conv_uuid)) SELECT conv_uuid, export_key, count(*) AS lost_messages FROM t o WHERE export_key <> nk AND NOT EXISTS (SELECT 1 FROM t n WHERE n.conv_uuid = o.conv_uuid AND n.msg_uuid = o.msg_uuid AND n.export_key = n.nk) GROUP BY ALL",
    "merge_report": f"WITH {_VERSIONS}, p AS (SELECT conv_uuid, count(*) AS n FROM vs GROUP BY conv_uuid), h AS (SELECT DISTINCT conv_uuid, export_key, msg_uuid FROM chat_messages WHERE conv_uuid IS NOT NULL), t AS (SELECT h.*, nv.export_key AS nk FROM h JOIN nv USING (conv_uuid)), e AS (SELECT DISTINCT conv_uuid, export_key FROM t o WHERE export_key <> nk AND NOT EXISTS (SELECT 1 FROM t n WHERE n.conv_uuid = o.conv_uuid AND n.msg_uuid = o.msg_uuid AND n.export_key = n.nk)) SELECT (SELECT count(DISTINCT export_key) FROM chat_messages) AS exports, (SELECT count(DISTINCT msg_uuid) FROM chat_messages) AS messages, count(*) AS conversations, count(*) FILTER (n > 1) AS in_several_exports, (SELECT count(*) FROM e) AS earlier_versions_kept FROM p",
    "as_of_labels": "WITH t AS (SELECT export_key, coalesce(max(created_at), max(exported_at)) AS made FROM chat_messages GROUP BY export_key) SELECT export_key, CASE WHEN row_number() OVER (PARTITION BY made::DATE ORDER BY made, export_key) = 1 THEN strftime(made, '%Y-%m-%d') ELSE strftime(made, '%Y-%m-%d-%H%M') END AS label FROM t",
    "manifest_problems": f"WITH {_MANIFESTS} SELECT file_id, unnest(list_filter([CASE WHEN NOT valid THEN 'unreadable' END, CASE WHEN declared <> len(entries) THEN 'count differs' END, CASE WHEN len(entries) <> len(list_distinct(entries)) THEN 'entry listed twice' END, CASE WHEN project <> replace(file_project, '-', '') THEN 'named for another project' END, CASE WHEN valid AND project IS NULL THEN 'no project' END], lambda x: x IS NOT NULL)) AS problem FROM mf",
    "manifest_revisions": f"WITH {_MANIFESTS}, b AS (SELECT file_id, file_project, revision, last_value(revision IGNORE NULLS) OVER (PARTITION BY file_project ORDER BY written_at NULLS FIRST, file_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM mf WHERE valid) SELECT *, coalesce(revision > before, true) AS rises FROM b",
    "manifest_placement": f"WITH {_MANIFESTS} SELECT * FROM placed",
    "manifest_gate": f"""WITH {_MANIFESTS}, held AS (SELECT conv_uuid, max(created_at) AS last_activity FROM chat_messages WHERE conv_uuid IS NOT NULL GROUP BY conv_uuid), listed AS (SELECT DISTINCT file_project FROM mf WHERE valid)
 SELECT 'project without manifest' AS problem, count(*) AS subjects FROM (SELECT DISTINCT lower(project_uuid) AS p FROM projects) WHERE p NOT IN (SELECT file_project FROM listed) UNION ALL
 SELECT 'conversation in no project', count(*) FROM held WHERE conv_uuid NOT IN (SELECT conv_uuid FROM placed) UNION ALL SELECT 'listed conversation is absent', count(*) FROM placed WHERE conv_uuid NOT IN (SELECT conv_uuid FROM held) UNION ALL
 SELECT 'manifest of unknown project', count(*) FROM listed WHERE file_project NOT IN (SELECT lower(project_uuid) FROM projects) UNION ALL SELECT 'claimed by two projects', count(*) FROM placed WHERE projects > 1 UNION ALL
 SELECT 'manifest older than its conversations', count(DISTINCT file_project) FROM claims JOIN held USING (conv_uuid) WHERE last_activity > written_at""",
    "split_buckets": "SELECT coalesce(project_uuid, '_ungrouped') AS bucket, count(DISTINCT conv_uuid) AS conversations, count(DISTINCT msg_uuid) AS messages FROM chat_messages WHERE conv_uuid IS NOT NULL GROUP BY bucket",
    "collapse_reasoning": "WITH b AS (SELECT row_id, generate_subscripts(content, 1) AS place, unnest(content).block_type = 'thinking' AS step FROM chat_messages WHERE content IS NOT NULL), c AS (SELECT *, coalesce((step <> lag(step) OVER w)::INT, 1) AS ch FROM b WINDOW w AS (PARTITION BY row_id ORDER BY place)), r AS (SELECT *, sum(ch) OVER (PARTITION BY row_id ORDER BY place)::BIGINT AS run_no FROM c) SELECT row_id, run_no, any_value(step) AS flagged, count(*) AS n FROM r GROUP BY row_id, run_no",
    "conversation_counters": "WITH m AS (SELECT conv_uuid, msg_uuid, any_value(content) AS content, any_value(created_at) AS created_at FROM chat_messages WHERE conv_uuid IS NOT NULL GROUP BY ALL) SELECT conv_uuid, count(*) AS messages, sum(len(list_filter(coalesce(content, []), lambda b: b.block_type = 'thinking')))::BIGINT AS thinking_blocks, sum(len(list_filter(coalesce(content, []), lambda b: b.block_type = 'tool_use')))::BIGINT AS tool_uses, max(created_at) AS last_message FROM m GROUP BY conv_uuid",
    "file_kinds": f"""WITH {_DIGESTS}, {_FILES}, k AS (SELECT size, lower(split_part(path, '/', -1)) AS name, lower(regexp_extract(split_part(path, '/', -1), '.(\\.[^.]+)$', 1)) AS ext FROM ff),
 t AS (SELECT size, CASE WHEN name LIKE '~$%' OR name LIKE '.%' THEN 'skipped' WHEN ext = '.docx' THEN 'docx' WHEN ext IN ('.xlsx', '.xlsm') THEN 'xlsx' WHEN ext = '.pdf' THEN 'pdf' WHEN name IN ({_list(ACCOUNT_FILES)}) THEN 'account' WHEN ext IN ('.html', '.htm') THEN 'html' WHEN ext = '.rtf' THEN 'rtf' WHEN regexp_matches(name, '^conversations(-\\d+)?\\.json$') THEN 'conversations' WHEN ext = '.md' THEN 'md' WHEN ext = '.txt' THEN 'txt' WHEN ext IN ({_list(['.' + m for m in MEDIA])}) THEN 'media' ELSE 'sidecar' END AS kind FROM k)
 SELECT kind, count(*) AS files, sum(size)::BIGINT AS bytes FROM t GROUP BY kind""",
    "folder_summary": f"""WITH {_DIGESTS}, s AS (SELECT regexp_replace(source_path, '/[^/]*$', '') AS folder, count(*) AS files, count(*) FILTER (source = 'md') AS md_files, coalesce(sum(source_bytes), 0)::BIGINT AS bytes, min(indexed_at::DATE) AS first_day, max(indexed_at::DATE) AS last_day FROM dd GROUP BY 1)
 SELECT *, CASE WHEN bytes < 1024 THEN printf('%d B', bytes) WHEN bytes < 1048576 THEN printf('%.1f KB', round(bytes / 1024.0, 1)) WHEN bytes < 1073741824 THEN printf('%.1f MB', round(bytes / 1048576.0, 1)) ELSE printf('%.1f GB', round(bytes / 1073741824.0, 1)) END AS size FROM s""",
    "selection_coverage": "WITH l AS (SELECT 'chats' AS n, project_uuid AS folder FROM chat_messages UNION SELECT 'exports', project_uuid FROM export_conversations), s AS (SELECT folder, string_agg(n, ',' ORDER BY n) AS selected_by FROM l WHERE folder IS NOT NULL GROUP BY folder), p AS (SELECT DISTINCT project_uuid AS folder FROM projects) SELECT coalesce(p.folder, s.folder) AS folder, selected_by, CASE WHEN p.folder IS NULL THEN 'unmatched' WHEN selected_by IS NULL THEN 'unselected' ELSE 'selected' END AS state FROM p FULL JOIN s ON p.folder = s.folder",
    "mirror_actions": """WITH n AS (SELECT conv_uuid AS path, batch_no > 12 AS late, len(transcript) AS size, md5(transcript) AS digest FROM export_conversations WHERE conv_uuid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conv_uuid, batch_no > 12 ORDER BY batch_no DESC, conv_row_id DESC) = 1),
 a AS (SELECT * FROM n WHERE late), b AS (SELECT * FROM n WHERE NOT late) SELECT CASE WHEN b.path IS NULL THEN '+' WHEN a.path IS NULL THEN '-' WHEN a.size IS NOT DISTINCT FROM b.size AND a.digest IS NOT DISTINCT FROM b.digest THEN '=' ELSE '~' END AS action, count(*) AS files FROM a FULL JOIN b ON a.path = b.path GROUP BY action""",
    "collision_verdicts": f"""WITH {_DIGESTS}, n AS (SELECT source, regexp_replace(source_path, '/[^/]*$', '') AS folder, split_part(title, ' ', 1) AS stem, max(indexed_at) AS at, count(title) AS c FROM dd WHERE title IS NOT NULL GROUP BY ALL),
 f AS (SELECT * FROM n WHERE source = 'xlsx'), s AS (SELECT * FROM n WHERE source = 'docx') SELECT f.folder || '/' || f.stem || '.xlsx' AS path, s.folder || '/' || s.stem AS sheet_path, CASE WHEN f.at IS NULL OR s.at IS NULL THEN 'unknown' WHEN f.at >= s.at THEN 'SAFE' ELSE 'KEEP' END AS verdict FROM f JOIN s USING (folder, stem)""",
    "first_claims": "SELECT conv_uuid, conv_row_id, batch_no, project_uuid FROM export_conversations QUALIFY row_number() OVER (PARTITION BY conv_uuid ORDER BY batch_no, conv_row_id) = 1",
    "date_resolution": f"WITH {_DIGESTS}, p AS (SELECT digest_id, {_DATE} AS made, indexed_at FROM dd) SELECT digest_id, strftime(coalesce(made, indexed_at), '%Y-%m-%dT%H:%M') || '+00:00' AS date, CASE WHEN made IS NOT NULL THEN 'document (date)' WHEN indexed_at IS NOT NULL THEN 'file mtime' ELSE 'unavailable' END AS date_source FROM p",
    "sheet_values": """SELECT doc_id, CASE WHEN n < 1 THEN '' WHEN n = floor(n) THEN strftime(DATE '1899-12-30' + floor(n)::INT, '%Y-%m-%d') ELSE strftime(DATE '1899-12-30' + to_days(floor(n)::INT) + to_seconds(round((n - floor(n)) * 86400)::BIGINT), '%Y-%m-%d %H:%M:%S') END AS serial_date,
 (CASE WHEN c > 18278 THEN chr((65 + ((c - 18279) // 17576) % 26)::INT) ELSE '' END) || (CASE WHEN c > 702 THEN chr((65 + ((c - 703) // 676) % 26)::INT) ELSE '' END) || (CASE WHEN c > 26 THEN chr((65 + ((c - 27) // 26) % 26)::INT) ELSE '' END) || chr((65 + (c - 1) % 26)::INT) AS letters, c AS number,
 CASE WHEN h >= 48 THEN 1 WHEN h >= 36 THEN 2 WHEN h >= 28 THEN 3 END AS level FROM (SELECT doc_id, n_chars + (doc_id % 2) / 2.0 AS n, (n_chars + 1)::BIGINT AS c, n_chars % 60 AS h FROM documents)""",
    "byte_functions": f"""WITH b AS (SELECT doc_id, coalesce(text, '') AS t, ([{_list(HEADS)}])[n_chars % {len(HEADS)} + 1] || lower(hex(encode(coalesce(text, '')))) AS h FROM documents)
 SELECT doc_id, CASE WHEN h LIKE '52494646________57454250%' THEN '.webp' WHEN h LIKE '52494646________57415645%' THEN '.wav' WHEN h LIKE '52494646________41564920%' THEN '.avi' WHEN h LIKE '89504e470d0a1a0a%' THEN '.png' WHEN h LIKE 'ffd8ff%' THEN '.jpg'
 WHEN h LIKE '474946383_61%' AND substr(h, 10, 1) IN ('7', '9') THEN '.gif' WHEN h LIKE '255044462d%' THEN '.pdf' WHEN h LIKE '494433%' THEN '.mp3' WHEN h LIKE '4f676753%' THEN '.ogg' WHEN h LIKE '________66747970%' THEN '.mp4' END AS extension, sha256(t) AS sha256, octet_length(encode(t)) AS payload FROM b""",
    "pointer_ids": "SELECT row_id, 'file_' || row_id || ',file-' || substr(msg_uuid, 1, 8) AS ids FROM chat_messages",
    "common_extensions": "SELECT lower(regexp_extract(split_part(file_path, '/', -1), '.(\\.[^.]+)$', 1)) AS extension, count(*) AS n FROM file_ops WHERE file_path IS NOT NULL GROUP BY 1 ORDER BY n DESC, extension LIMIT 15",
    "index_entries": f"""WITH {_DIGESTS} SELECT digest_id, '{{"digest_id":' || digest_id || coalesce(',"title":"' || title || '"', '') || coalesce(',"source_bytes":' || source_bytes, '') || '}}' AS entry FROM dd""",
    "event_windows": "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS events, count(DISTINCT user_id) AS users, round(sum(value), 2) AS value FROM events GROUP BY ALL",
    "rendered_messages": """WITH m AS (SELECT row_id, sender, created_at, text, list_filter(list_transform(coalesce(content, []), lambda b: CASE WHEN b.block_type = 'text' THEN b.text WHEN b.block_type = 'thinking' THEN '<details><summary>Thinking</summary>' || chr(10) || chr(10) || coalesce(b.thinking, '') || chr(10) || chr(10) || '</details>' WHEN b.block_type = 'tool_use' THEN '**Tool:** `' || coalesce(b.tool_name, 'unknown') || '`' ELSE '**' || coalesce(b.block_type, 'block') || '**' END), lambda x: x IS NOT NULL AND trim(x) <> '') AS s FROM chat_messages)
 SELECT row_id, md5('## ' || CASE WHEN lower(trim(sender)) IN ('human', 'user') THEN 'Human' WHEN sender IS NULL OR trim(sender) = '' THEN 'Unknown' ELSE 'Assistant' END || chr(10) || chr(10) || coalesce('*' || strftime(created_at, '%Y-%m-%d %H:%M') || ' UTC*' || chr(10) || chr(10), '') || CASE WHEN len(s) > 0 THEN array_to_string(s, chr(10) || chr(10)) ELSE coalesce(text, '') END) AS digest FROM m""",
    "scanned_files": "SELECT pdf_id, coalesce(sum(len(trim(text))), 0)::BIGINT AS chars, count(DISTINCT page_no) AS pages, coalesce(sum(len(trim(text))), 0) < 20 * count(DISTINCT page_no) AS scanned FROM pdf_pages WHERE page_no <= 10 GROUP BY pdf_id",
    "plain_documents": rf"SELECT doc_id, md5(regexp_replace(regexp_replace({_BODY}, '{_INDEX}', '', 'g'), '^\s+', '')) AS digest FROM documents",
    "unrecoverable_outputs": """WITH o AS (SELECT * FROM file_ops WHERE conv_uuid IS NOT NULL AND file_path IS NOT NULL AND coalesce(failed, false) = false)
 SELECT DISTINCT conv_uuid, file_path, CASE WHEN lower(file_path) LIKE '%.zip' OR EXISTS (SELECT 1 FROM o z WHERE z.op = 'zip' AND z.conv_uuid = p.conv_uuid AND z.file_path = p.file_path) THEN 'a zip archive' ELSE 'no text in the export; likely binary' END AS reason
 FROM o p WHERE op = 'present' AND coalesce(branch = 'active', true) AND NOT EXISTS (SELECT 1 FROM o c WHERE c.op = 'create' AND c.conv_uuid = p.conv_uuid AND c.file_path = p.file_path)""",
    "manifest_resolution": f"""WITH {_MANIFESTS}, bad AS (SELECT file_id FROM mf WHERE NOT valid OR declared <> len(entries) OR len(entries) <> len(list_distinct(entries)) OR project <> replace(file_project, '-', '') OR project IS NULL),
 o AS (SELECT *, file_id IN (SELECT file_id FROM bad) AS bad, row_number() OVER (PARTITION BY file_project ORDER BY written_at DESC NULLS LAST, file_id DESC) AS k FROM mf WHERE valid), l AS (SELECT * FROM o WHERE k = 1),
 p AS (SELECT file_project, arg_min(revision, k) AS prior FROM o WHERE k > 1 AND NOT bad AND revision IS NOT NULL GROUP BY file_project)
 SELECT file_project, file_id, CASE WHEN bad THEN 'rejected' ELSE 'chosen' END AS state, prior, coalesce(revision > prior, true) AS climbs FROM l LEFT JOIN p USING (file_project)""",
    "duplicate_conversations": f"""WITH RECURSIVE src AS (SELECT conv_row_id AS doc_id, transcript AS text FROM export_conversations WHERE NOT coalesce(earlier_version, false)), {_windows('w', 'src')}, l AS (SELECT min(doc_id) AS a, window_hash FROM w GROUP BY window_hash HAVING count(*) > 1), e AS (SELECT DISTINCT a, doc_id AS b FROM w JOIN l USING (window_hash) WHERE doc_id <> a),
 b AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS id, a AS other FROM b UNION SELECT r.id, b.b FROM r JOIN b ON b.a = r.other), c AS (SELECT id, min(other) AS class_id FROM r GROUP BY id)
 SELECT id AS doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM c""",
    "frontmatter_emit_all": rf"""WITH {_DIGESTS}, q AS (SELECT digest_id, '"' || replace(replace(title, '\', '\\'), '"', '\"') || '"' AS t, '[' || array_to_string(list_transform(list_filter(keywords, lambda k: k IS NOT NULL), lambda k: '"' || replace(replace(k, '\', '\\'), '"', '\"') || '"'), ', ') || ']' AS k, word_count FROM dd)
 SELECT digest_id, '---' || chr(10) || 'title: ' || coalesce(t, '""') || chr(10) || 'keywords: ' || coalesce(k, '""') || chr(10) || 'word_count: ' || coalesce(word_count::VARCHAR, '""') || chr(10) || '---' || chr(10) AS block FROM q""",
    "record_dates": r"""SELECT doc_id, coalesce(CASE WHEN len(title) > 12 THEN indexed_at::DATE END, try_cast(nullif(regexp_extract(substr(text, 1, 2048), '(?m)^date:[ \t]*"?(\d{4}-\d{2}-\d{2})', 1), '') AS DATE)) AS day FROM documents""",
    "p5_retyped": rf"""WITH f AS (SELECT DISTINCT ON (file_id, file_name, written_at) file_id, lower(regexp_extract(file_name, '(?i)({_UUID})', 1)) AS grp, written_at, raw_json::JSON AS j FROM manifest_files WHERE json_valid(raw_json) AND json_type(raw_json) = 'OBJECT' AND regexp_matches(file_name, '(?i){_UUID}')),
 e AS (SELECT file_id, unnest(json_extract(j, '$.conversations[*]')) AS j FROM f WHERE json_type(j, '$.conversations') = 'ARRAY'),
 k AS (SELECT file_id, '' AS level, j, unnest(json_keys(j)) AS key FROM f UNION ALL SELECT file_id, 'conversations.', j, unnest(json_keys(j)) FROM e WHERE json_type(j) = 'OBJECT'),
 t AS (SELECT file_id, level || key AS field_name, json_type(j, '$."' || key || '"') AS t FROM k),
 n AS (SELECT file_id, field_name, list_sort(list(DISTINCT CASE WHEN t IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT') THEN 'NUMBER' ELSE t END)) AS ts FROM t WHERE t <> 'NULL' GROUP BY ALL),
 p AS (SELECT file_id, lag(file_id) OVER (PARTITION BY grp ORDER BY written_at NULLS FIRST, file_id) AS before FROM f)
 SELECT p.file_id, a.field_name FROM p JOIN n a ON a.file_id = p.file_id JOIN n b ON b.file_id = p.before AND b.field_name = a.field_name WHERE a.ts <> b.ts""",
    "ledger_new": "SELECT export_key FROM chat_messages GROUP BY export_key HAVING export_key IS NULL OR count(*) <> count(*) FILTER (exported_at < (SELECT max(exported_at) - INTERVAL 60 DAY FROM chat_messages))",
    "sidecars": rf"""WITH {_DIGESTS}, {_FILES}, n AS (SELECT *, split_part(path, '/', -1) AS name FROM ff) SELECT digest_id, md5('---' || chr(10) || array_to_string(list_filter(['title: "' || name || '"', 'source: "unconvertible"', 'file_type: "' || lower(regexp_extract(name, '.(\.[^.]+)$', 1)) || '"', 'source_path: "' || path || '"', 'size_bytes: ' || size, 'source_sha256: "' || sha256 || '"'], lambda x: x IS NOT NULL), chr(10)) || chr(10) || '---' || chr(10) || chr(10) || '# ' || name || chr(10)) AS digest FROM n""",
    "allocated_names": rf"""WITH {_DIGESTS}, w AS (SELECT digest_id, regexp_replace(source_path, '/[^/]*$', '') || '/' || coalesce(nullif(substr({_SLUG.format("CASE WHEN contains(title, ' ') THEN split_part(title, ' ', 1) || ' ' || split_part(title, ' ', 2) ELSE title END")}, 1, 60), ''), 'untitled') || '.md' AS wanted FROM dd),
 t AS (SELECT regexp_extract(left(wanted, -3), '^(.*)-\d{{1,9}}$', 1) AS base, max(regexp_extract(left(wanted, -3), '-(\d{{1,9}})$', 1)::INT) AS most FROM w WHERE regexp_matches(wanted, '-\d{{1,9}}\.md$') GROUP BY 1),
 n AS (SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY digest_id) AS k FROM w)
 SELECT digest_id, CASE WHEN k = 1 THEN wanted ELSE left(wanted, -3) || '-' || (greatest(coalesce(most, 1), 1) + k - 1) || '.md' END AS allocated FROM n LEFT JOIN t ON t.base = left(wanted, -3)""",
    "node_blocks": f"WITH {_NODES} SELECT conv_id, node_id, md5(block) AS digest FROM blocks WHERE block IS NOT NULL",
    "node_conversations": f"""WITH RECURSIVE {_NODES}, last AS (SELECT conv_id, arg_max(node_id, {{'a': coalesce(made, TIMESTAMPTZ '1900-01-01'), 'i': node_id}}) AS now FROM nd GROUP BY conv_id),
 up AS (SELECT conv_id, now AS node_id FROM last UNION SELECT u.conv_id, n.parent FROM up u JOIN nd n ON n.conv_id = u.conv_id AND n.node_id = u.node_id JOIN nd p ON p.conv_id = n.conv_id AND p.node_id = n.parent),
 act AS (SELECT conv_id, count(*) AS c FROM up GROUP BY conv_id), st AS (SELECT conv_id, count(*) FILTER (block = chr(1)) AS s, coalesce(bool_or(contains(shown, '[real_time_user_audio_video_asset_pointer content omitted]') OR contains(shown, '[audio_asset_pointer content omitted]') OR contains(shown, '[audio_transcription content omitted]')), false) AS v FROM blocks WHERE block IS NOT NULL GROUP BY conv_id)
 SELECT conv_id, any_value(act.c) AS active_message_count, count(*) AS total_node_count, coalesce(any_value(st.s), 0) AS reasoning_step_count, coalesce(any_value(st.v), false) AS is_voice, coalesce(strftime(max(made), '%Y-%m-%d %H:%M:%S'), '') AS last_message_time FROM nd JOIN act USING (conv_id) LEFT JOIN st USING (conv_id) GROUP BY conv_id""",
    "asset_index": f"WITH {_ASSETS} SELECT root, asset_id, min(path) AS path FROM af GROUP BY ALL",
    "asset_counts": f"WITH {_ASSETS} SELECT root, count(*) AS files_scanned, 0::BIGINT AS files_without_id FROM aa WHERE path NOT LIKE '%.json' GROUP BY root",
    "asset_resolution": f"WITH {_ASSETS}, {_REFERENCES} SELECT conv_id, asset_id, path FROM refs LEFT JOIN (SELECT asset_id, min(path) AS path FROM af GROUP BY asset_id) USING (asset_id)",
    "split_assets": f"WITH {_ASSETS}, {_REFERENCES}, b AS (SELECT conv_uuid AS conv_id, coalesce(min(project_uuid), '_ungrouped') AS bucket FROM chat_messages WHERE conv_uuid IS NOT NULL GROUP BY 1), r AS (SELECT DISTINCT bucket, asset_id, asset_id IN (SELECT asset_id FROM af) AS there FROM refs JOIN b USING (conv_id)) SELECT bucket, count(*) FILTER (there) AS assets, count(*) FILTER (NOT there) AS missing FROM r GROUP BY bucket",
    "asset_profile": "WITH b AS (SELECT coalesce(u.block_type, '(none)') AS kind, u FROM (SELECT unnest(content) AS u FROM chat_messages)), k AS (SELECT kind, unnest(list_filter([CASE WHEN u.block_type IS NOT NULL THEN 'content_type' END, CASE WHEN u.text IS NOT NULL THEN 'text' END, CASE WHEN u.tool_name IS NOT NULL THEN 'tool_name' END], lambda x: x IS NOT NULL)) AS key FROM b) SELECT kind, NULL AS key, count(*) AS n FROM b GROUP BY kind UNION ALL SELECT kind, key, count(*) FROM k GROUP BY ALL",
    "catalogue_states": f"WITH {_DOCFILES} SELECT path, path || '.md' AS record_path, CASE WHEN content IS NOT NULL AND complete THEN 'self_describing' ELSE 'written' END AS status FROM df2",
    "stamped_documents": f"WITH {_DOCFILES} SELECT path, array_to_string(missing, ',') AS missing, len(missing) > 0 AS changed, true AS complete FROM df2 WHERE content IS NOT NULL",
    "manifest_shapes": "WITH j AS (SELECT file_id, CASE WHEN json_valid(raw_json) THEN raw_json::JSON END AS j FROM manifest_files) SELECT file_id, coalesce(json_type(j, '$.project_uuid') = 'VARCHAR' AND json_type(j, '$.conversations') = 'ARRAY' AND (json_array_length(j, '$.conversations') = 0 OR json_extract(j, '$.conversations[0].uuid') IS NOT NULL), false) AS manifest, coalesce(json_type(j, '$.uuid') = 'VARCHAR' AND json_extract(j, '$.name') IS NOT NULL, false) AS project FROM j",
    "filed_manifests": f"""WITH {_MANIFESTS}, bad AS (SELECT file_id FROM mf WHERE NOT valid OR declared <> len(entries) OR len(entries) <> len(list_distinct(entries)) OR project <> replace(file_project, '-', '') OR project IS NULL)
 SELECT DISTINCT 'projects/' || substr(replace(project_uuid, '-', ''), 1, 8) || '_manifests/' || file_name AS path, md5(raw_json) AS digest FROM mf JOIN manifest_files f USING (file_id) JOIN projects p ON lower(p.project_uuid) = file_project WHERE valid AND file_id NOT IN (SELECT file_id FROM bad)""",
    "kept_documents": "SELECT conv_uuid AS project, file_path AS name, md5(text) AS digest FROM file_ops WHERE op = 'create' AND conv_uuid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conv_uuid, coalesce(file_path, 'untitled') ORDER BY seq DESC, op_id DESC) = 1",
}
