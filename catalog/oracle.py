"""SQL for an independent engine: the same questions over the same tables.

Each query is put together from named views, which become ``WITH`` clauses.
"""

from __future__ import annotations

import re

from corpusmix.functions import fixed_values as fixed
from corpusmix.functions.tokens import SPACE, SPECIAL, TOKEN
from corpusmix.operators.prompts import TRANSLATION_TEMPLATE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _fill(template: str, **slots: str) -> str:
    names = "|".join(slots)
    parts = re.split("{(" + names + ")}", template)
    shown = [slots[part] if at % 2 else _text(part) for at, part in enumerate(parts)]
    return "(" + " || ".join(shown) + ")"


def _strip(sql: str) -> str:
    return f"trim({sql}, {_text(fixed.WHITESPACE)})"


def _tokens(sql: str) -> str:
    return f"regexp_extract_all({sql}, {_text(TOKEN)})"


def _count(sql: str) -> str:
    return f"len({_tokens(sql)})"


def _key(seed: object, sql: str) -> str:
    return f"md5({_text(str(seed))} || chr(0) || cast({sql} as varchar))"


def _missing(sql: str) -> str:
    return f"lower({sql}) in ('none', 'null', '')"


FLAT = "task, source_text, target_text, source_lang_code, target_lang_code"

VIEWS: dict[str, str] = {}

# --- the sources ---------------------------------------------------------------

VIEWS["bitext"] = f"""
SELECT doc_id // 2 AS pair_id, {_key(42, "doc_id // 2")} AS order_key,
       {_strip("max(text) FILTER (doc_id % 2 = 0)")} AS en_text,
       {_strip("max(text) FILTER (doc_id % 2 = 1)")} AS cy_text
FROM documents GROUP BY doc_id // 2
"""

VIEWS["both_directions"] = """
SELECT order_key, 'translation' AS task, en_text AS source_text, cy_text AS target_text,
       'en' AS source_lang_code, 'cy' AS target_lang_code, 0 AS emit_ord
FROM bitext WHERE en_text <> '' AND cy_text <> ''
UNION ALL
SELECT order_key, 'translation', cy_text, en_text, 'cy', 'en', 1
FROM bitext WHERE en_text <> '' AND cy_text <> ''
"""

VIEWS["bitext_again"] = """
SELECT order_key, 'translation' AS task, cy_text AS source_text, en_text AS target_text,
       'cy' AS source_lang_code, 'en' AS target_lang_code, 0 AS emit_ord
FROM (
  SELECT *, row_number() OVER (ORDER BY order_key) AS rn, count(*) OVER () AS n FROM bitext
)
WHERE rn <= floor(n * 0.35::double) AND en_text <> '' AND cy_text <> ''
"""

VIEWS["terms_raw"] = f"""
SELECT {_key(42, "p_partkey")} AS order_key, {_strip("p_name")} AS en,
       CASE WHEN p_size = 7 THEN 'None' ELSE {_strip("p_brand")} END AS cy,
       CASE WHEN p_size > 40 THEN 'null' ELSE {_strip("p_type")} END AS en_def,
       CASE WHEN p_size < 10 THEN 'None' WHEN p_size < 20 THEN ''
            ELSE 'maint ' || p_size END AS cy_def,
       CASE WHEN p_size > 25 THEN 'size ' || p_size ELSE '' END AS en_ctx,
       CASE WHEN p_type <> 'SMALL' THEN {_strip("lower(p_type)")} ELSE '' END AS cy_ctx
FROM part
"""

VIEWS["terms"] = f"""
SELECT order_key, en, cy, en_def, cy_def,
       CASE WHEN {_missing("en_ctx")} THEN en_def
            ELSE en_def || {_text(fixed.CONTEXT_LABEL_EN)} || en_ctx END AS en_full,
       CASE WHEN {_missing("cy_ctx")} THEN cy_def
            ELSE cy_def || {_text(fixed.CONTEXT_LABEL_CY)} || cy_ctx END AS cy_full,
       ('0x' || substr({_key("42/en", "order_key")}, 1, 4))::int % 3 AS pick_en,
       ('0x' || substr({_key("42/cy", "order_key")}, 1, 4))::int % 2 AS pick_cy
FROM terms_raw WHERE NOT {_missing("en")} AND NOT {_missing("cy")}
"""


def _templates(templates, pick: str, side: int, full: str) -> str:
    cases = " ".join(
        f"WHEN {at} THEN {_fill(template[side], en='en', cy='cy', definition=full)}"
        for at, template in enumerate(templates)
    )
    return f"CASE {pick} {cases} END"


VIEWS["dictionary"] = f"""
SELECT order_key, 'translation' AS task, en AS source_text, cy AS target_text,
       'en' AS source_lang_code, 'cy' AS target_lang_code, 0 AS emit_ord FROM terms
UNION ALL
SELECT order_key, 'translation', cy, en, 'cy', 'en', 1 FROM terms
UNION ALL
SELECT order_key, 'instruction',
       {_templates(fixed.EN_TO_CY_TEMPLATES, "pick_en", 0, "cy_full")},
       {_templates(fixed.EN_TO_CY_TEMPLATES, "pick_en", 1, "cy_full")}, 'en', 'cy', 2
FROM terms WHERE NOT {_missing("cy_def")}
UNION ALL
SELECT order_key, 'instruction',
       {_templates(fixed.CY_TO_EN_TEMPLATES, "pick_cy", 0, "en_full")},
       {_templates(fixed.CY_TO_EN_TEMPLATES, "pick_cy", 1, "en_full")}, 'cy', 'en', 3
FROM terms WHERE NOT {_missing("en_def")}
"""

VIEWS["turns"] = f"""
SELECT conv_id,
       coalesce(min_by({_strip("text")}, turn)
         FILTER (lower(role) IN ('user', 'human') AND {_strip("text")} <> ''), '') AS source_text,
       coalesce(min_by({_strip("text")}, turn)
         FILTER (lower(role) = 'assistant' AND {_strip("text")} <> ''), '') AS target_text
FROM conversations GROUP BY conv_id
"""

VIEWS["pages_keyed"] = f"""
SELECT {_key(42, "page_id")} AS order_key, 'instruction' AS task, {_strip("url")} AS source_text,
       {_strip("html")} AS target_text, 'cy' AS source_lang_code, 'cy' AS target_lang_code,
       0 AS emit_ord
FROM pages
"""

VIEWS["instructions"] = f"""
SELECT 'chats' AS dataset_source, 4 AS source_ord, {_key(42, "conv_id")} AS order_key,
       'instruction' AS task, source_text, target_text, 'en' AS source_lang_code,
       'en' AS target_lang_code, 0 AS emit_ord
FROM turns
UNION ALL
SELECT 'web_pages', 5, * EXCLUDE (rn, n) FROM (
  SELECT *, row_number() OVER (ORDER BY order_key) AS rn, count(*) OVER () AS n FROM pages_keyed
) WHERE rn <= floor(n * 1.0::double)
UNION ALL
SELECT 'texts_' || named, 5 + list_position(['en', 'fr', 'de', 'es', 'other'], named), {_key(42, "doc_id")},
       'instruction', {_strip("split_part(text, chr(10), 1)")}, {_strip("text")},
       CASE named WHEN 'other' THEN 'und' ELSE named END, CASE named WHEN 'other' THEN 'und' ELSE named END, 0
FROM (SELECT *, CASE WHEN lang IN ('en', 'fr', 'de', 'es') THEN lang ELSE 'other' END AS named FROM documents)
"""

VIEWS["sliced"] = f"""
SELECT 'translation' AS section, 'document_pairs' AS dataset_source, 0 AS source_ord, *
FROM both_directions
UNION ALL SELECT 'translation', 'document_pairs_again', 1, * FROM bitext_again
UNION ALL SELECT 'dictionary', 'part_terms', 3, * FROM dictionary
UNION ALL
SELECT 'instruction', dataset_source, source_ord, order_key, {FLAT}, emit_ord
FROM instructions WHERE source_text <> '' AND target_text <> ''
"""

VIEWS["usage_lines"] = """
  SELECT 0 AS source_ord, 'translation' AS section, 'document_pairs' AS dataset_source, 1.0 AS usage,
         (SELECT count(DISTINCT doc_id // 2) FROM documents) AS n
  UNION ALL SELECT 1, 'translation', 'document_pairs_again', 0.35,
         (SELECT count(DISTINCT doc_id // 2) FROM documents)
  UNION ALL SELECT 3, 'dictionary', 'part_terms', 1.0, (SELECT count(*) FROM part)
  UNION ALL SELECT 4, 'instruction', 'chats', 1.0,
         (SELECT count(DISTINCT conv_id) FROM conversations)
  UNION ALL SELECT 5, 'instruction', 'web_pages', 1.0, (SELECT count(*) FROM pages)
  UNION ALL SELECT 6, 'instruction', 'texts_en', 1.0, (SELECT count(*) FROM documents WHERE lang = 'en')
  UNION ALL SELECT 7, 'instruction', 'texts_fr', 1.0, (SELECT count(*) FROM documents WHERE lang = 'fr')
  UNION ALL SELECT 8, 'instruction', 'texts_de', 1.0, (SELECT count(*) FROM documents WHERE lang = 'de')
  UNION ALL SELECT 9, 'instruction', 'texts_es', 1.0, (SELECT count(*) FROM documents WHERE lang = 'es')
  UNION ALL SELECT 10, 'instruction', 'texts_other', 1.0,
         (SELECT count(*) FROM documents WHERE lang IS NULL OR lang NOT IN ('en', 'fr', 'de', 'es'))
"""

# --- budget, duplicates, mix, split ----------------------------------------------

PROMPT = f"""CASE task WHEN 'translation' THEN {
    _fill(TRANSLATION_TEMPLATE, source_lang_code="source_lang_code",
          target_lang_code="target_lang_code", text="source_text")
} ELSE {_text(fixed.BOS + fixed.USER_TURN)} || {_strip("source_text")} || {
    _text(fixed.END_OF_TURN + fixed.MODEL_TURN)} END"""

COMPLETION = f"{_strip('target_text')} || {_text(fixed.END_OF_TURN)}"


def _budget(view: str, limit: int = 2048, total: bool = False) -> str:
    special = _text("^" + SPACE + "*" + SPECIAL + "$")
    kept = f"[t FOR t IN ({_tokens('target_text')})[1:allowed] IF NOT regexp_matches(t, {special})]"
    return f"""
SELECT * EXCLUDE (src_len, tgt_len, allowed, target_text),
       CASE WHEN over_limit AND tgt_len > allowed THEN {_strip(f"array_to_string({kept}, '')")}
            ELSE target_text END AS target_text
FROM (
  SELECT *, greatest(0, {limit - 1} - {_count(PROMPT)} - {_count(_text(fixed.END_OF_TURN))}) AS allowed,
         {"tgt_len > allowed" if total else f"src_len > {limit} OR tgt_len > {limit}"} AS over_limit
  FROM (
    SELECT *, {_count("source_text")} AS src_len, {_count("target_text")} AS tgt_len FROM {view}
  ) WHERE src_len <= 1266
)
"""


VIEWS["budgeted"] = _budget("sliced")
VIEWS["budgeted_whole"] = _budget("sliced", 600, total=True)
VIEWS["pool"] = f"""
SELECT *, sha1(source_text || chr(0) || target_text) AS pair_hash FROM budgeted
WHERE NOT over_limit OR target_text <> ''
"""
VIEWS["ranked"] = """
SELECT *, row_number() OVER place AS rn, count(*) OVER (PARTITION BY pair_hash) AS copies,
       first_value(dataset_source) OVER place AS winner
FROM pool
WINDOW place AS (PARTITION BY pair_hash
                 ORDER BY source_ord, over_limit, order_key, emit_ord, dataset_source)
"""
VIEWS["deduped"] = "SELECT * FROM ranked WHERE rn = 1"
VIEWS["task_sizes"] = """
SELECT count(*) FILTER (task = 'translation') AS t, count(*) FILTER (task = 'instruction') AS i
FROM deduped
"""
VIEWS["quotas"] = """
SELECT task, available::bigint AS available, k::bigint AS k FROM (
  SELECT 'translation' AS task, t AS available,
         CASE WHEN t / 0.7::double <= i / 0.3::double THEN t
              ELSE least(t, round_even(i * 0.7::double / 0.3::double, 0)) END AS k
  FROM task_sizes
  UNION ALL
  SELECT 'instruction', i,
         CASE WHEN t / 0.7::double <= i / 0.3::double
              THEN least(i, round_even(t * 0.3::double / 0.7::double, 0)) ELSE i END
  FROM task_sizes
)
"""
VIEWS["mixed"] = f"""
SELECT d.*, d.task || ':' || d.source_lang_code || '->' || d.target_lang_code AS stratify_key
FROM (
  SELECT *, row_number() OVER (PARTITION BY task ORDER BY {_key("42/mix", "pair_hash")}) AS drawn
  FROM deduped
) d JOIN quotas q ON q.task = d.task WHERE drawn <= q.k
"""
VIEWS["strata"] = """
SELECT stratify_key, count(*) AS n, (SELECT count(*) FROM mixed) AS total,
       round_even((SELECT count(*) FROM mixed) * 0.05::double, 0)::bigint AS test_rows
FROM mixed GROUP BY stratify_key
"""
VIEWS["allocation"] = """
SELECT stratify_key,
       whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, stratify_key)
                         <= test_rows - sum(whole) OVER () THEN 1 ELSE 0 END AS k
FROM (
  SELECT stratify_key, test_rows, n * test_rows // total AS whole, n * test_rows % total AS rest
  FROM strata
)
"""
VIEWS["split_rows"] = f"""
SELECT m.*, CASE WHEN row_number() OVER (PARTITION BY m.stratify_key
                                        ORDER BY {_key("42/split", "m.pair_hash")}) <= a.k
                 THEN 'test' ELSE 'train' END AS split,
       {_key("42/rows", "m.pair_hash")} AS row_order
FROM mixed m JOIN allocation a ON a.stratify_key = m.stratify_key
"""

# --- evaluation --------------------------------------------------------------------

VIEWS["pairs_budgeted"] = _budget("both_directions")
VIEWS["predictions"] = f"""
SELECT row_id, {FLAT}, reverse(target_text) AS hypothesis FROM (
  SELECT *, sha1(source_text || chr(0) || target_text) AS row_id,
         row_number() OVER (PARTITION BY sha1(source_text || chr(0) || target_text)
                            ORDER BY over_limit, order_key, emit_ord) AS rn
  FROM pairs_budgeted WHERE NOT over_limit OR target_text <> ''
) WHERE rn = 1
"""
VIEWS["scores"] = """
SELECT sha1(source_text || chr(0) || target_text) AS row_id,
       round(max(abs(length(source_text) - length(target_text)) * 25.0::double
                 / greatest(length(source_text), length(target_text))), 6) AS prediction
FROM both_directions GROUP BY 1
"""
VIEWS["scored"] = """
SELECT p.row_id, p.source_lang_code, p.target_lang_code, s.prediction
FROM predictions p JOIN scores s ON s.row_id = p.row_id
"""
VIEWS["packed"] = f"""
SELECT pair_hash, total_tokens,
       coalesce(sum(total_tokens) OVER (ORDER BY {_key("42/rows", "pair_hash")}
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS start_token
FROM (
  SELECT pair_hash, {_count(_fill(fixed.MEASURED_TEXT, source="source_text", target="target_text"))}
         AS total_tokens
  FROM deduped
)
"""
VIEWS["gaps"] = """
SELECT source_lang_code || '->' || target_lang_code AS direction,
       abs(length(source_text) - length(target_text))::double AS prediction
FROM split_rows WHERE split = 'test' AND task = 'translation'
"""
VIEWS["some_codes_missing"] = """
SELECT pair_hash, target_lang_code, CASE WHEN dataset_source <> 'document_pairs_again' THEN source_lang_code END
         AS source_lang_code, CASE WHEN dataset_source <> 'chats' THEN task END AS task
FROM deduped
"""
VIEWS["rendered_lengths"] = f"""
SELECT split, task, {_count(f"({PROMPT} || {COMPLETION})")} AS total_tokens FROM split_rows
"""
VIEWS["lengths"] = f"""
SELECT split, task,
       {_count(_fill(fixed.MEASURED_TEXT, source="source_text", target="target_text"))} AS total_tokens
FROM split_rows
"""


def _used_views(sql: str, found: dict[str, None]) -> dict[str, None]:
    for name in VIEWS:
        if name not in found and re.search(rf"(?:FROM|JOIN)\s+{name}\b", sql):
            _used_views(VIEWS[name], found)
            found[name] = None
    return found


def _query(sql: str) -> str:
    views = _used_views(sql, {})
    if not views:
        return sql
    clauses = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name]})" for name in views)
    return f"WITH {clauses}\n{sql}"


# --- one statement per query --------------------------------------------------------


def _bucketed() -> str:
    return f"""
SELECT order_key, source_lang_code, src_len, tgt_len,
       CASE WHEN src_len > 1266 THEN 'source too long'
            WHEN src_len > 2048 OR tgt_len > 2048 THEN 'over' ELSE 'under' END AS bucket
FROM (SELECT *, {_count("source_text")} AS src_len, {_count("target_text")} AS tgt_len
      FROM both_directions)
"""


def _length_statistics(condition: str, view: str = "lengths") -> str:
    points = [
        ("median_tokens", 0.5),
        ("p95_tokens", 0.95),
        ("p99_tokens", 0.99),
        ("p99_9_tokens", 0.999),
    ]
    columns = ", ".join(
        f"round(quantile_cont(total_tokens, {point}::double), 6) AS {name}"
        for name, point in points
    )
    return f"""
SELECT coalesce(task, 'all') AS segment, count(*) AS samples,
       round(avg(total_tokens), 6) AS mean_tokens, max(total_tokens) AS max_tokens, {columns}
FROM {view} WHERE {condition} GROUP BY GROUPING SETS ((), (task))
"""


def _line_turns(content: str) -> str:
    """Documents as chats, one row per document and turn, and the first ones of each role."""
    return f"""
WITH turns_of AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS turn
  FROM documents WHERE lang <> 'fr'
), said AS (
  SELECT doc_id, turn, length(line) % 4 AS kind, {_strip(content)} AS said FROM turns_of
), firsts AS (
  SELECT doc_id, min_by(said, turn) FILTER (kind IN (1, 2) AND said <> '') AS user_text,
         min_by(said, turn) FILTER (kind = 0 AND said <> '') AS answer_text
  FROM said GROUP BY doc_id
)
SELECT cast(d.doc_id AS varchar) AS order_key, 'instruction' AS task,
       CASE WHEN lang = 'fr' THEN {_strip("source")} ELSE coalesce(user_text, '') END AS source_text,
       CASE WHEN lang = 'fr' THEN {_strip("text")} ELSE coalesce(answer_text, '') END AS target_text,
       'cy' AS source_lang_code, 'cy' AS target_lang_code
FROM documents d LEFT JOIN firsts f ON f.doc_id = d.doc_id
"""


def _score_document(split: str, view: str, direction: str) -> str:
    """The overall scores beside those of each direction."""
    figures = "count(*) AS samples, round(avg(prediction), 6) AS average_score, round(median(prediction), 6) AS median_score"
    return f"""
SELECT '{split}' AS split, 'validation' AS requested_split, 'translation' AS evaluated_task, 'reference' AS mode, o.*,
       d.direction, d.samples AS direction_samples, d.average_score AS direction_average_score,
       d.median_score AS direction_median_score
FROM (SELECT {figures} FROM {view}) o, (SELECT {direction} AS direction, {figures} FROM {view} GROUP BY 1) d
"""


_SPLIT_LINES = "SELECT pair_hash, stratify_key, split FROM split_rows"

STATEMENTS: dict[str, str] = {
    "q01_recipe_active_sources": """
SELECT source_ord::bigint AS source_ord, section, dataset_source, usage::double AS usage,
       n::bigint AS rows_available, floor(n * usage::double)::bigint AS source_rows_used
FROM usage_lines
""",
    "q01b_sources_of_each_format": """
SELECT format, doc_id, text, lang, source FROM documents, (VALUES ('csv'), ('json'), ('parquet')) AS f(format)
""",
    "q02_strip_and_blank_filter": f"""
SELECT * FROM (
  SELECT doc_id, {_strip("text")} AS source_text,
         {_strip("source")} AS target_text
  FROM documents
) WHERE source_text <> '' AND target_text <> ''
""",
    "q03_bitext_column_mapping": f"""
SELECT doc_id, {_strip("text")} AS en_text, {_strip("source")} AS cy_text
FROM documents WHERE {_strip("text")} <> '' AND {_strip("source")} <> ''
UNION ALL
SELECT doc_id, 'kept', {_strip("source")} FROM documents WHERE lang = 'en' AND {_strip("source")} <> ''
""",
    "q04_bitext_json_extract": f"""
SELECT doc_id, {_strip("json_extract_string(translation, '$.en')")} AS en_text,
       {_strip("json_extract_string(translation, '$.cy')")} AS cy_text
FROM (SELECT doc_id, json_object('en', text, 'cy', source) AS translation FROM documents)
""",
    "q04b_bitext_struct_extract": f"""
SELECT doc_id, {_strip("text")} AS en_text, {_strip("source")} AS cy_text
FROM documents WHERE {_strip("text")} <> '' AND {_strip("source")} <> ''
""",
    "q05_direction_expansion": f"SELECT order_key, {FLAT} FROM both_directions",
    "q06_usage_slice_union": f"SELECT section, dataset_source, order_key, {FLAT} FROM sliced",
    "q07_dictionary_translations": f"SELECT order_key, {FLAT} FROM dictionary WHERE task = 'translation'",
    "q08_dictionary_instructions": f"SELECT order_key, {FLAT} FROM dictionary WHERE task = 'instruction'",
    "q09_dictionary_breakdown": """
SELECT task, source_lang_code, target_lang_code, count(*) AS rows FROM dictionary GROUP BY ALL
""",
    "q10_token_lengths_and_buckets": _bucketed(),
    "q10b_batch_tokenizer_lengths": _bucketed(),
    "q11_budget_truncation": f"SELECT dataset_source, over_limit, order_key, {FLAT} FROM pool",
    "q11b_budget_of_whole_rows": f"""
SELECT dataset_source, over_limit, order_key, {FLAT} FROM budgeted_whole WHERE NOT over_limit OR target_text <> ''
""",
    "q12_dedup_keep_first": """
SELECT pair_hash, dataset_source, task, source_lang_code, over_limit, order_key, copies FROM deduped
""",
    "q12b_dedup_losers": """
SELECT dataset_source AS source, winner, pair_hash AS hash FROM ranked WHERE rn > 1
""",
    "q12c_duplicates_by_source": """
SELECT dataset_source AS source, winner, count(*) AS dropped FROM ranked WHERE rn > 1 GROUP BY ALL
""",
    "q12d_dedup_pair_and_languages": """
SELECT sha1(text_and_languages) AS pair_hash, dataset_source, source_lang_code, target_lang_code, order_key,
       copies
FROM (SELECT *, row_number() OVER (PARTITION BY text_and_languages
                                   ORDER BY source_ord, over_limit, order_key, emit_ord) AS place,
             count(*) OVER (PARTITION BY text_and_languages) AS copies
      FROM (SELECT * EXCLUDE copies,
                   concat_ws(chr(0), source_text, target_text, source_lang_code, target_lang_code)
                       AS text_and_languages
            FROM ranked))
WHERE place = 1
""",
    "q13_instruction_from_turns": "SELECT * FROM turns",
    "q13b_instruction_from_messages": _line_turns("line"),
    "q13c_instruction_from_message_parts": _line_turns("substr(line, 1, 10) || ' ' || substr(line, 11)"),
    "q13d_instruction_from_conversations": _line_turns("line"),
    "q14_instruction_from_flat": f"""
SELECT order_key, {FLAT} FROM pages_keyed WHERE source_text <> '' AND target_text <> ''
""",
    "q15_rebalance_quotas": "SELECT task, available, k FROM quotas",
    "q16_rebalance_sample": "SELECT pair_hash, task, dataset_source FROM mixed",
    "q16b_balance_directions": f"""
SELECT pair_hash, task, source_lang_code, target_lang_code FROM (
  SELECT *, row_number() OVER (PARTITION BY task, source_lang_code, target_lang_code
                               ORDER BY {_key("42/direction", "pair_hash")}) AS drawn
  FROM deduped
) WHERE task <> 'translation' OR drawn <= (
  SELECT min(n) FROM (SELECT count(*) AS n FROM deduped WHERE task = 'translation'
                      GROUP BY source_lang_code, target_lang_code))
""",
    "q16c_balance_directions_missing_codes": f"""
SELECT pair_hash, task, source_lang_code, target_lang_code FROM (
  SELECT *, row_number() OVER (PARTITION BY task, source_lang_code, target_lang_code
                               ORDER BY {_key("42/direction", "pair_hash")}) AS drawn
  FROM some_codes_missing
) WHERE task IS DISTINCT FROM 'translation' OR drawn <= (
  SELECT min(n) FROM (SELECT count(*) AS n FROM some_codes_missing WHERE task = 'translation'
                      GROUP BY source_lang_code, target_lang_code))
""",
    "q17_stratified_split_counts": """
SELECT stratify_key, split, count(*) AS rows FROM split_rows GROUP BY ALL
""",
    "q17b_stratified_split_rows": _SPLIT_LINES,
    "q17c_stratum_codes": """
SELECT pair_hash, task || ':' || source_lang_code || '->' || target_lang_code AS stratify_key,
       dense_rank() OVER (ORDER BY task || ':' || source_lang_code || '->' || target_lang_code) - 1
         AS stratum_code
FROM deduped
""",
    "q18_source_report": """
SELECT coalesce(section, 'TOTAL') AS section, coalesce(dataset_source, 'TOTAL') AS dataset_source,
       count(*) AS rows, count(*) FILTER (task = 'translation') AS translation_rows,
       count(*) FILTER (task = 'instruction') AS instruction_rows
FROM pool GROUP BY ROLLUP (section, dataset_source)
""",
    "q18b_recipe_report": """
SELECT u.section, u.dataset_source, coalesce(p.n, 0)::bigint AS rows_used,
       u.n::bigint AS rows_available, floor(u.n * u.usage::double)::bigint AS source_rows_used
FROM usage_lines u LEFT JOIN (
  SELECT dataset_source, count(*) AS n FROM pool GROUP BY dataset_source
) p ON p.dataset_source = u.dataset_source
""",
    "q19_task_totals_and_percentages": """
SELECT t AS translation_rows, i AS instruction_rows, n AS total_rows,
       round(100.0::double * t / n, 1) AS translation_percent,
       round(100.0::double * i / n, 1) AS instruction_percent
FROM (SELECT count(*) FILTER (task = 'translation') AS t,
             count(*) FILTER (task = 'instruction') AS i, count(*) AS n FROM pool)
""",
    "q20_direction_counts": """
SELECT source_lang_code || '->' || target_lang_code AS direction, count(*) AS rows
FROM mixed WHERE task = 'translation' GROUP BY ALL
""",
    "q20b_removed_counts": """
SELECT p AS pool_rows, u AS unique_rows, m AS total_rows, p - u AS duplicates_removed,
       u - m AS removed_by_rebalancing, m - e AS training_split_rows, e AS eval_split_rows
FROM (SELECT (SELECT count(*) FROM pool) AS p, (SELECT count(*) FROM deduped) AS u,
             (SELECT count(*) FROM mixed) AS m,
             (SELECT count(*) FROM split_rows WHERE split = 'test') AS e)
""",
    "q21_length_statistics": _length_statistics("true"),
    "q21b_length_statistics_train": _length_statistics("split = 'train'"),
    "q21c_length_statistics_rendered": _length_statistics("true", "rendered_lengths"),
    "q21d_length_sketches": """
SELECT coalesce(task, 'all') AS segment, count(*) AS samples, round(avg(total_tokens), 6) AS mean_tokens,
       max(total_tokens) AS max_tokens, true AS within
FROM lengths GROUP BY GROUPING SETS ((), (task))
""",
    "q22_fraction_prefix": """
SELECT pair_hash, row_order AS order_key FROM (
  SELECT *, row_number() OVER (ORDER BY row_order) AS rn2, count(*) OVER () AS n
  FROM split_rows WHERE split = 'train'
) WHERE rn2 <= floor(n * 0.25::double)
""",
    "q23_prompt_completion": f"""
SELECT {PROMPT} AS prompt, {COMPLETION} AS completion FROM split_rows WHERE split = 'train'
""",
    "q23b_prompt_boundary_check": f"""
SELECT count(*) FILTER (NOT ends_with({PROMPT}, {_text(fixed.MODEL_TURN)})) AS violations,
       count(*) AS rows
FROM pool
""",
    "q23c_prompt_row_cap": f"""
SELECT {PROMPT} AS prompt, {COMPLETION} AS completion FROM split_rows
WHERE split = 'train' ORDER BY row_order LIMIT 1200
""",
    "q24_eval_rows": f"""
SELECT pair_hash AS row_id, {FLAT} FROM split_rows
WHERE split = 'test' AND task = 'translation' ORDER BY row_order LIMIT 20
""",
    "q25_metric_input": """
SELECT source_text AS source, hypothesis, target_text AS reference FROM predictions
""",
    "q25b_metric_input_reference_free": """
SELECT source_text AS source, hypothesis, '' AS reference FROM predictions
""",
    "q26_score_join": "SELECT row_id, source_lang_code, target_lang_code, prediction FROM scored",
    "q26b_score_join_unmatched": """
SELECT count(*) FILTER (p.row_id IS NOT NULL AND s.row_id IS NOT NULL) AS matched,
       count(*) FILTER (s.row_id IS NULL) AS without_score,
       count(*) FILTER (p.row_id IS NULL) AS without_prediction
FROM predictions p FULL JOIN scores s ON s.row_id = p.row_id
""",
    "q27_direction_scores": """
SELECT source_lang_code || '->' || target_lang_code AS direction, count(*) AS samples,
       round(avg(prediction), 6) AS average_score, round(median(prediction), 6) AS median_score,
       true AS lower_is_better
FROM scored GROUP BY 1 ORDER BY 1
""",
    "q28_overall_scores": """
SELECT 'test' AS split, 'validation' AS requested_split, 'translation' AS evaluated_task,
       count(*) AS samples, 'reference' AS mode, round(avg(prediction), 6) AS average_score,
       round(median(prediction), 6) AS median_score, true AS lower_is_better
FROM scored
""",
    "q28b_score_summary": _score_document("test", "scored", "source_lang_code || '->' || target_lang_code"),
    "q28c_whole_evaluation": _score_document("test", "gaps", "direction"),
    "q29_packing_plan": """
SELECT pair_hash, total_tokens, start_token, start_token // 2048 AS first_block,
       (start_token + total_tokens - 1) // 2048 AS last_block
FROM packed
""",
    "q29b_packing_fill": """
SELECT block, count(*) AS rows, sum(tokens)::bigint AS tokens,
       round(sum(tokens)::bigint / 2048.0::double, 4) AS fill
FROM (
  SELECT block, least(start_token + total_tokens, (block + 1) * 2048)
                - greatest(start_token, block * 2048) AS tokens
  FROM (SELECT *, unnest(range(start_token // 2048,
                               (start_token + total_tokens - 1) // 2048 + 1)) AS block FROM packed)
) GROUP BY block
""",
    "q30_json_lines_round_trip": f"SELECT {FLAT} FROM both_directions",
    "q31_prepared_round_trip": """
SELECT pair_hash, dataset_source, stratify_key, split FROM split_rows
""",
    "q31b_shuffled_write": f"""
SELECT split, row_number() OVER (PARTITION BY split ORDER BY {_key("42/shuffle", "pair_hash")}) - 1 AS row_at, pair_hash
FROM split_rows
""",
    "q32_batch_scorer": """
SELECT row_id, abs(length(source_text) - length(hypothesis)) AS prediction FROM predictions
""",
    "q33_checked_tasks": "SELECT task, count(*) AS rows FROM pool GROUP BY task",
}

ORACLE: dict[str, str] = {name: _query(sql) for name, sql in STATEMENTS.items()}
