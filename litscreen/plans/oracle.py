"""The contract queries in SQL, for a comparison on the same tables."""

from __future__ import annotations

from litscreen.plans.queries import STANDING_QUERIES

_NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"
_BLANK = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
_TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\s\x0B\x1C-\x1F\x{85}\p{Z}\p{L}\p{M}\p{N}]"


def _words(text: str) -> str:
    return f"(' ' || trim(regexp_replace(lower({text}), '{_NOT_WORD}', ' ', 'g')) || ' ')"


def _one_line(text: str) -> str:
    lines = f"list_transform(regexp_split_to_array({text}, '\\r\\n|\\r|\\n'), lambda x: {_strip('x')})"
    return f"array_to_string(list_filter({lines}, lambda x: x <> ''), ' ')"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"


def _uniform(row_key: str, salt: str) -> str:
    return f"(('0x' || substr(md5({row_key} || ':{salt}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _clip(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, 0.0), 1.0) END"


# ---------------------------------------------------------------- scoring and evaluation

_DOTS = """
x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
dots AS (
  SELECT vec_id, any_value(label) AS label, m, h,
         0.6 + sum(v * ((i * (2 * m + 3) + 5 * h + m) % 17 - 8) / 32.0) AS y
  FROM x, range(4) a(m), range(2) b(h) GROUP BY vec_id, m, h)
"""

_SCORES = f"""
WITH {_DOTS},
means AS (
  SELECT vec_id AS "ID", avg(y) FILTER (h = 0) AS a, avg(y) FILTER (h = 1) AS s FROM dots GROUP BY vec_id)
SELECT "ID", round({_clip('a')}, 6) AS "Predicted_AwT_score", round({_clip('s')}, 6) AS "Predicted_SoE_score" FROM means
"""

_EVALUATED = f"""
WITH {_DOTS},
evaluated AS (
  SELECT vec_id AS "ID", avg(1 / (1 + exp(-y))) FILTER (h = 0) AS a, avg(1 / (1 + exp(-y))) FILTER (h = 1) AS s,
         any_value(label) / 9.0::DOUBLE AS truth
  FROM dots GROUP BY vec_id)
"""

# ---------------------------------------------------------------- elements of pages


def _element(page: str, name: str) -> str:
    return f"regexp_extract({page}, '(?is)<{name}(?:\\s[^>]*)?>.*?(?:</{name}\\s*>|\\z)')"


def _paragraphs(element: str) -> str:
    cut = f"list_transform(string_split_regex({element}, '(?i)<p(?:\\s[^>]*)?>')[2:], lambda x: regexp_replace(string_split_regex(x, '(?i)</p\\s*>')[1], '<[a-zA-Z/!?][^>]*>', '', 'g'))"
    text = f"array_to_string({cut}, ' ')"
    for name, character in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{character}')"
    return f"replace({text}, '\"', '')"


_PAGE_ID = r"regexp_extract(url, '//[^/]+/([a-z]+)/([0-9]+)', 2)"
_FOLDER = r"regexp_extract(url, '//[^/]+/([a-z]+)/([0-9]+)', 1)"

# ---------------------------------------------------------------- search


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_STANDING = ", ".join(
    f"({_quoted(name)}, {clause}, {_quoted(term)})"
    for name, clauses in STANDING_QUERIES.items()
    for clause, terms in enumerate(clauses)
    for term in terms
)


def _found(terms: str) -> str:
    return f"""
folded AS (SELECT doc_id, {_words('text')} AS w FROM documents),
given AS ({terms}),
terms AS (SELECT DISTINCT query_id, clause, {_words('term')} AS phrase FROM given WHERE trim({_words('term')}) <> ''),
sizes AS (SELECT query_id, count(DISTINCT clause) AS clauses FROM terms GROUP BY query_id),
held AS (
  SELECT doc_id, query_id, count(DISTINCT clause) AS clauses
  FROM folded JOIN terms ON contains(w, phrase) GROUP BY doc_id, query_id),
found AS (SELECT doc_id, query_id FROM held JOIN sizes USING (query_id, clauses))
"""


_STANDING_FOUND = _found(f"SELECT * FROM (VALUES {_STANDING}) v(query_id, clause, term)")
_SENTENCE_FOUND = _found(f"""
  SELECT query_id, clause, term FROM (
    SELECT query_id, clause, unnest(string_split(trim({_words('sentence')}), ' ')) AS term FROM (
      SELECT item_id::VARCHAR AS query_id, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS clause
      FROM (SELECT item_id, string_split(text, '.') AS parts FROM benchmark)))
  WHERE term <> ''""")
_PHRASE_FOUND = _found("SELECT item_id::VARCHAR AS query_id, 0 AS clause, text AS term FROM benchmark")
_TOP_50 = """
top AS (
  SELECT query_id, doc_id, ts::DATE AS pub_date FROM found JOIN events ON event_id = doc_id
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY ts::DATE DESC, {order}) <= 50)
"""

# ---------------------------------------------------------------- run planning

_STATE = """
state AS (
  SELECT user_id, max(ts)::DATE AS last_fetch FROM events
  WHERE ts < DATE '2024-01-20' AND user_id % 7 <> 3 GROUP BY user_id)
"""
_PLAN = f"""
WITH {_STATE},
plan AS (
  SELECT item_id AS query_id, text, last_fetch,
         CASE WHEN last_fetch IS NULL THEN 'FULL' WHEN last_fetch = DATE '2024-01-30' THEN 'SKIP' ELSE 'INCREMENTAL' END AS mode
  FROM benchmark LEFT JOIN state ON item_id = user_id)
"""

# ---------------------------------------------------------------- training data


def _noised(column: str, source: str) -> str:
    draw = _uniform("doc_id", f"{column}:42")
    noised = f"({source} * (1 + (2 * {draw} - 1) * 0.05::DOUBLE))"
    return _clip(noised)


_NOISED = f"""
noised AS (
  SELECT doc_id, quality::DOUBLE AS "AwT_score", toxic::DOUBLE AS "SoE_score",
         {_noised('AwT_score', 'quality::DOUBLE')} AS "randomized_AwT_score",
         {_noised('SoE_score', 'toxic::DOUBLE')} AS "randomized_SoE_score"
  FROM labels)
"""
_SHUFFLED = """
shuffled AS (SELECT *, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) - 1 AS row FROM labels),
size AS (SELECT ceil(0.2::DOUBLE * count(*)) AS n FROM labels)
"""
_COMPARED = f"""
WITH {_NOISED},
compared AS (
  SELECT doc_id, "randomized_AwT_score", "randomized_SoE_score",
         round((n_chars % 101) / 100.0::DOUBLE, 4) AS "predicted_AwT_score",
         round((n_chars % 37) / 36.0::DOUBLE, 4) AS "predicted_SoE_score"
  FROM documents JOIN noised USING (doc_id))
"""
_DIFF_A = '("predicted_AwT_score" - "randomized_AwT_score")'
_DIFF_S = '("predicted_SoE_score" - "randomized_SoE_score")'


def _weight(member: int) -> str:
    draw, below, probability, cases = _uniform("doc_id", f"member{member}:42"), 0.0, 0.36787944117144233, []
    while below < 1 - 2.0**-32:
        below += probability
        cases.append(f"WHEN {draw} < {below!r}::DOUBLE THEN {len(cases)}")
        probability /= len(cases)
    return f"(CASE {' '.join(cases)} ELSE {len(cases)} END)::DOUBLE AS weight_{member}"


# ---------------------------------------------------------------- tokens

_VOCAB = f"""
spoken AS (SELECT doc_id, regexp_extract_all(lower(text), '{_TOKEN}') AS tokens FROM documents),
counts AS (SELECT term, count(*) AS n FROM (SELECT unnest(tokens) AS term FROM spoken) GROUP BY term),
vocab AS (
  SELECT term, n, row_number() OVER (ORDER BY n DESC, term) + 3 AS token_id FROM counts
  QUALIFY row_number() OVER (ORDER BY n DESC, term) <= 500)
"""
_IDS = f"""
WITH {_VOCAB},
cut AS (SELECT doc_id, tokens[1:510] AS tokens FROM spoken),
placed AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS i FROM cut),
body AS (SELECT doc_id, list(coalesce(token_id, 1) ORDER BY i) AS ids FROM placed LEFT JOIN vocab USING (term) GROUP BY doc_id),
encoded AS (
  SELECT doc_id, list_concat(list_concat([2], coalesce(ids, [])), [3]) AS ids FROM documents LEFT JOIN body USING (doc_id))
"""

_OLD_AND_NEW = """
old AS (
  SELECT doc_id, source, md5(text) AS text_md5 FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
  QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1),
new AS (SELECT doc_id, source, md5(text) AS text_md5 FROM documents)
"""

SQL = {
    "score_filter": f"""SELECT * FROM ({_SCORES}) WHERE "Predicted_AwT_score" >= 0.7 AND "Predicted_SoE_score" >= 0.4""",
    "score_all": _SCORES,
    "batch_predict": _SCORES,
    "ensemble_eval": f"""{_EVALUATED}
        SELECT "ID", round(a, 6) AS "predicted_AwT_score", round(s, 6) AS "predicted_SoE_score", round(truth, 6) AS truth FROM evaluated""",
    "ensemble_mse": f"""{_EVALUATED}
        SELECT round(avg((a - truth) ** 2), 9) AS "mse_AwT", round(avg((s - truth) ** 2), 9) AS "mse_SoE" FROM evaluated""",
    "ensemble_long": f"""WITH {_DOTS}
        SELECT vec_id AS "ID", round(avg(y) FILTER (h = 0), 6) AS "AwT_score", round(avg(y) FILTER (h = 1), 6) AS "SoE_score"
        FROM dots GROUP BY vec_id""",
    "query_key": r"""
        SELECT item_id, name AS folder_name, hash AS short_hash, name || '_' || hash AS query_key FROM (
          SELECT item_id, substr(md5(text), 1, 8) AS hash,
                 substr(regexp_replace(replace(text, ' ', '_'), '[<>:"/\\|?*]', '', 'g'), 1, 50) AS name
          FROM benchmark)""",
    "query_long_name": r"""
        SELECT item_id, trim(regexp_replace(regexp_replace(replace(
                 regexp_replace(text, '\[.*?\]|\(.*?\)', '', 'g'), ' ', '_'), '[<>:"/\\|?*]', '', 'g'), '_+', '_', 'g'), '_') AS long_name
        FROM benchmark""",
    "date_reformat": "SELECT event_id, strftime(ts, '%Y/%m/%d') AS day FROM events",
    "normalise_lines": f"""
        SELECT * FROM (SELECT doc_id, {_one_line('text')} AS "Abstract" FROM documents WHERE doc_id % 9 <> 0) WHERE "Abstract" <> ''""",
    "extract_body": f"""
        SELECT * FROM (SELECT page_id, {_element('html', 'body')} AS body_html FROM pages) WHERE body_html <> ''""",
    "extract_paragraphs": f"""
        SELECT page_id, {_paragraphs('element')} AS abstract_text
        FROM (SELECT page_id, {_element('html', 'article')} AS element FROM pages WHERE page_id % 3 <> 0) WHERE element <> ''""",
    "missing_element": "SELECT page_id FROM pages WHERE page_id % 3 = 0 OR NOT regexp_matches(html, '(?i)<article[\\s/>]')",
    "landing_upsert": f"""
        SELECT {_FOLDER} AS query_folder, {_PAGE_ID} AS id, page_id + 1800 AS fetched_at, md5(html) AS content_md5 FROM pages
        QUALIFY row_number() OVER (PARTITION BY {_FOLDER}, {_PAGE_ID} ORDER BY page_id DESC) = 1""",
    "abstract_dataset": f"""
        SELECT "ID", "Abstract" FROM (
          SELECT {_PAGE_ID} AS "ID", {_FOLDER} AS folder, page_id,
                 {_one_line(_paragraphs(_element('html', 'article')))} AS "Abstract"
          FROM pages WHERE {_element('html', 'article')} <> '')
        WHERE "Abstract" <> ''
        QUALIFY row_number() OVER (PARTITION BY "ID" ORDER BY folder, page_id) = 1""",
    "body_table": f"""
        SELECT query_folder, id, body_html FROM (
          SELECT {_FOLDER} AS query_folder, {_PAGE_ID} AS id, {_element('html', 'body')} AS body_html FROM pages
          QUALIFY row_number() OVER (PARTITION BY {_FOLDER}, {_PAGE_ID} ORDER BY page_id DESC) = 1)
        WHERE body_html <> ''""",
    "abstract_table": f"""
        SELECT query_folder, id, {_paragraphs('abstract_html')} AS abstract_text, abstract_html FROM (
          SELECT {_FOLDER} AS query_folder, {_PAGE_ID} AS id, {_element('html', 'article')} AS abstract_html FROM pages
          QUALIFY row_number() OVER (PARTITION BY {_FOLDER}, {_PAGE_ID} ORDER BY page_id DESC) = 1)
        WHERE abstract_html <> ''""",
    "decode_rejects": r"SELECT doc_id FROM documents WHERE regexp_matches(text, '[\x{80}-\x{FF}]')",
    "query_list": r"""
        SELECT DISTINCT key AS query_id, query_text, key AS folder FROM (
          SELECT query_text, substr(regexp_replace(replace(query_text, ' ', '_'), '[<>:"/\\|?*]', '', 'g'), 1, 50)
                 || '_' || substr(md5(query_text), 1, 8) AS key
          FROM (SELECT trim(unnest(string_split(text, chr(10)))) AS query_text FROM benchmark) WHERE query_text <> '')""",
    "union_batches": """
        SELECT text AS "Abstract", doc_id::VARCHAR AS "ID" FROM documents
        UNION ALL SELECT text, conv_id || '-' || turn FROM conversations""",
    "csv_round_trip": """SELECT text AS "Abstract", doc_id::VARCHAR AS "ID" FROM documents""",
    "dedup_first": f"""WITH {_OLD_AND_NEW},
        both_tables AS (SELECT *, 0 AS batch FROM old UNION ALL SELECT *, 1 FROM new)
        SELECT doc_id, source, text_md5 FROM both_tables
        QUALIFY row_number() OVER (PARTITION BY text_md5 ORDER BY batch, doc_id) = 1""",
    "append_new": f"""WITH {_OLD_AND_NEW}
        SELECT * FROM new WHERE text_md5 NOT IN (SELECT text_md5 FROM old)
        QUALIFY row_number() OVER (PARTITION BY text_md5 ORDER BY doc_id) = 1""",
    "upsert_latest": """
        SELECT user_id, event_type, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "boolean_search_top50": f"""WITH {_STANDING_FOUND}, {_TOP_50.format(order='doc_id')}
        SELECT query_id, doc_id, strftime(pub_date, '%Y-%m-%d') AS pub_date FROM top""",
    "search_many": f"WITH {_SENTENCE_FOUND} SELECT doc_id, query_id FROM found",
    "phrase_search": f"WITH {_PHRASE_FOUND} SELECT doc_id, query_id FROM found",
    "newest_articles": """
        SELECT doc_id, source, strftime(ts, '%Y-%m-%d') AS pub_date FROM documents JOIN events ON event_id = doc_id
        ORDER BY ts::DATE DESC, doc_id LIMIT 50""",
    "date_range": "SELECT event_id, user_id FROM events WHERE ts::DATE BETWEEN DATE '2024-01-20' AND DATE '2024-01-30'",
    "run_gate": """
        SELECT DISTINCT user_id, CASE WHEN user_id % 11 = 0 THEN 'FULL' WHEN user_id % 5 = 0 THEN 'ERROR_NO_STATE'
          WHEN user_id % 12 = 0 THEN 'SKIP_SAME_DAY' WHEN user_id % 12 >= 7 THEN 'RUN' ELSE 'SKIP_TOO_SOON' END AS gate
        FROM events""",
    "query_plan": f"""{_PLAN}
        SELECT query_id, mode, CASE mode WHEN 'FULL' THEN text WHEN 'INCREMENTAL'
          THEN text || ' AND (' || strftime(last_fetch, '%Y/%m/%d') || '[PubDate] : 2024/01/30[PubDate])' END AS search_text
        FROM plan""",
    "incremental_select": f"""WITH {_STATE}
        SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day,
               CASE WHEN last_fetch IS NULL THEN 'FULL' ELSE 'INCREMENTAL' END AS mode
        FROM events LEFT JOIN state USING (user_id)
        WHERE last_fetch IS NULL OR (last_fetch <> DATE '2024-01-30' AND ts::DATE BETWEEN last_fetch AND DATE '2024-01-30')""",
    "run_state_advance": f"""{_PLAN}
        SELECT coalesce(query_id, user_id) AS query_id,
               strftime(CASE WHEN mode <> 'SKIP' THEN DATE '2024-01-30' ELSE state.last_fetch END, '%Y-%m-%d') AS last_fetch
        FROM plan FULL JOIN state ON query_id = user_id""",
    "select_articles": f"""WITH {_STANDING_FOUND}, {_TOP_50.format(order='doc_id::VARCHAR')}
        SELECT query_id AS query_folder, doc_id::VARCHAR AS id, md5(text) AS content_md5 FROM top JOIN documents USING (doc_id)""",
    "select_incremental": f"""WITH {_STANDING_FOUND},
        state(query_id, last_fetch) AS (VALUES ('q1', DATE '2024-01-20'), ('q2', DATE '2024-01-10'), ('q4', DATE '2024-01-30'), ('q5', DATE '2024-02-10')),
        top AS (
          SELECT query_id, doc_id FROM found JOIN events ON event_id = doc_id LEFT JOIN state USING (query_id)
          WHERE last_fetch IS NULL OR last_fetch <> DATE '2024-01-30' AND ts::DATE BETWEEN last_fetch AND DATE '2024-01-30'
          QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY ts::DATE DESC, doc_id::VARCHAR) <= 50)
        SELECT 'landed' AS kind, query_id AS query_folder, doc_id::VARCHAR AS id, md5(text) AS value FROM top JOIN documents USING (doc_id)
        UNION ALL SELECT 'state', 'q' || i, '', '2024-01-30' FROM range(1, 6) r(i)""",
    "noise_scores": f"""WITH {_NOISED}
        SELECT doc_id, "AwT_score", "SoE_score", round("randomized_AwT_score", 9) AS "randomized_AwT_score",
               round("randomized_SoE_score", 9) AS "randomized_SoE_score" FROM noised""",
    "split_test": f"WITH {_SHUFFLED} SELECT doc_id FROM shuffled, size WHERE row < n",
    "split_train": f"WITH {_SHUFFLED} SELECT doc_id FROM shuffled, size WHERE row >= n",
    "rest_after_split": f"WITH {_SHUFFLED} SELECT doc_id, quality FROM shuffled, size WHERE row >= n",
    "training_order": f"WITH {_SHUFFLED} SELECT doc_id, row FROM shuffled",
    "bootstrap_weights": f"SELECT doc_id, {', '.join(_weight(m) for m in range(4))} FROM labels",
    "compare_table": f"""{_COMPARED}
        SELECT doc_id, round("randomized_AwT_score", 6) AS "randomized_AwT_score", round("randomized_SoE_score", 6) AS "randomized_SoE_score",
               "predicted_AwT_score", "predicted_SoE_score" FROM compared""",
    "mse_by_target": f"""{_COMPARED}
        SELECT round(avg({_DIFF_A} ** 2), 9) AS "mse_AwT", round(avg({_DIFF_S} ** 2), 9) AS "mse_SoE" FROM compared""",
    "batch_loss": f"""{_COMPARED},
        dealt AS (SELECT *, (row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) - 1) // 6 AS batch FROM compared),
        losses AS (SELECT batch, avg(({_DIFF_A} ** 2 + {_DIFF_S} ** 2) / 2) AS loss FROM dealt GROUP BY batch)
        SELECT round(avg(loss), 9) AS loss, count(*) AS batches FROM losses""",
    "missing_counts": """
        SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(text) AS text, count(*) - count(lang) AS lang,
               count(*) - count(source) AS source, count(*) - count(n_chars) AS n_chars,
               count(*) - count(quality) AS quality, count(*) - count(toxic) AS toxic
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "train_join": """
        SELECT doc_id, text, quality::DOUBLE AS "AwT_score", toxic::DOUBLE AS "SoE_score"
        FROM documents JOIN labels USING (doc_id)""",
    "articles_per_query": "SELECT source, count(*) AS n FROM documents GROUP BY source",
    "vocab_topk": f"WITH {_VOCAB} SELECT term, n, token_id FROM vocab",
    "encode_tokens": f"{_IDS} SELECT doc_id, array_to_string(ids, ' ') AS input_ids FROM encoded",
    "encode_padded": f"""{_IDS}, longest AS (SELECT max(len(ids)) AS n FROM encoded)
        SELECT doc_id, array_to_string(ids, ' ') || repeat(' 0', n - len(ids)) AS input_ids,
               repeat('1', len(ids)) || repeat('0', n - len(ids)) AS attention_mask
        FROM encoded, longest""",
    "landed_files": f"""
        SELECT query_folder, id, md5(content) AS content_md5, md5(content) AS text_md5 FROM (
          SELECT {_FOLDER} AS query_folder, {_PAGE_ID} AS id, replace(html, chr(10), ' ') || chr(10) AS content FROM pages
          QUALIFY row_number() OVER (PARTITION BY {_FOLDER}, {_PAGE_ID} ORDER BY page_id DESC) = 1)""",
    "stream_ingest": f"""
        SELECT "ID", "Abstract" FROM (
          SELECT {_PAGE_ID} AS "ID", {_FOLDER} AS folder, {_one_line(_paragraphs(_element("replace(html, chr(10), ' ')", 'article')))} AS "Abstract" FROM (
            SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY {_FOLDER}, {_PAGE_ID} ORDER BY page_id DESC) = 1))
        WHERE "Abstract" <> ''
        QUALIFY row_number() OVER (PARTITION BY "ID" ORDER BY folder) = 1""",
    "text_embedding": f"""WITH {_VOCAB},
        found AS (SELECT doc_id, term, count(*) AS times FROM (SELECT doc_id, unnest(tokens) AS term FROM spoken) GROUP BY ALL),
        held AS (SELECT term, count(*) AS df FROM found GROUP BY term)
        SELECT doc_id, (token_id - 4)::INT AS place,
               round(times * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)::DOUBLE), 6) AS weight
        FROM found JOIN vocab USING (term) JOIN held USING (term)
        WHERE ln(((SELECT count(*) FROM documents) + 1) / (df + 1)::DOUBLE) > 0""",
    "linear_fit": """
        SELECT round(1e6 * regr_slope(quality, n_chars), 6) AS slope_per_million, round(regr_intercept(quality, n_chars), 6) AS intercept
        FROM documents JOIN labels USING (doc_id)""",
    "training_epochs": f"""WITH RECURSIVE {_SHUFFLED},
        given AS (SELECT row % 8 AS k, n_chars / 10000.0::DOUBLE AS x, quality::DOUBLE AS y
                  FROM shuffled JOIN documents USING (doc_id)),
        batch AS (SELECT k, count(*) AS n, sum(x) AS x, sum(y) AS y, sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy
                  FROM given GROUP BY k),
        steps AS (
          SELECT 0 AS step, 0.0::DOUBLE AS w, 0.0::DOUBLE AS b, NULL::DOUBLE AS loss
          UNION ALL
          SELECT step + 1, w - 0.05 * 2 * (w * xx + b * x - xy) / n, b - 0.05 * 2 * (w * x + b * n - y) / n,
                 (w * w * xx + 2 * w * b * x + b * b * n - 2 * w * xy - 2 * b * y + yy) / n
          FROM steps JOIN batch ON k = step % 8 WHERE step < 128)
        SELECT epoch, round(loss, 9) AS loss, round(b, 9) AS bias, round(w, 9) AS weight FROM (
          SELECT ceil(step / 8.0)::INT AS epoch, avg(loss) AS loss, arg_max(b, step) AS b, arg_max(w, step) AS w
          FROM steps WHERE step > 0 GROUP BY 1)""",
    "ml_ensemble": f"""WITH {_NOISED}, {_SHUFFLED}
        SELECT doc_id AS "ID", round("randomized_AwT_score", 9) AS "randomized_AwT_score",
               round("randomized_SoE_score", 9) AS "randomized_SoE_score", true AS in_range, true AS averaged
        FROM shuffled JOIN noised USING (doc_id), size WHERE row < n""",
    "ml_score": """
        SELECT doc_id::VARCHAR AS "ID", md5(text) AS abstract_md5, true AS in_range, true AS filtered FROM documents""",
    "stream_dedup": """SELECT DISTINCT user_id || ':' || event_type AS "ID" FROM events""",
}
