"""The results of registered queries as SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from tidemark.llm import licenses, middle, quality, secrets

_WORD = r"[^\x20\x09-\x0D]+"
_DOCS = "SELECT doc_id, coalesce(text, '') AS text FROM documents"


def _regex(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _quality() -> str:
    notices = " OR ".join(
        f"(contains(lower(l), {_regex(n)}) AND length(l) * {quality.NOTICE_PERCENT} <= {100 * len(n)})" for n in quality.NOTICES
    )
    unparted = quality.UNPARTED.replace(r"\p{Is", r"\p{")
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text, regexp_extract_all(text, '{_WORD}') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM ({_DOCS})
), runs AS (
  SELECT r, i, array_to_string(w[i : i + {quality.WINDOW - 1}], ' ') AS run
  FROM (SELECT r, w, unnest(range(1, len(w) - {quality.WINDOW - 2})) AS i FROM d)
), again AS (
  SELECT r, i FROM runs QUALIFY count(*) OVER (PARTITION BY r, run) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, range({quality.WINDOW}) AS t(k) GROUP BY r
), line AS (
  SELECT r, l, len(string_split(l, ' ')) AS words, regexp_extract_all(l, '{_WORD}') AS ws,
    len(regexp_extract_all(l, '[#*$%&<>{{}}~^\\=_]')) AS symbols,
    len(regexp_extract_all(l, '[!?]{{2,}}|…{{2,}}')) AS shouts,
    -- A blank may part two signs, so it is doubled before signs are counted.
    len(regexp_extract_all(regexp_replace(l, '(\s)', '\1\1', 'g'), '\s(\||»|›|·|•|→|/|>)\s')) AS signs
  FROM (SELECT r, unnest(lines) AS l FROM d)
), good AS (
  SELECT r, sum(len(regexp_extract_all(l, '{_WORD}'))) AS n FROM line
  WHERE NOT (signs >= {quality.MENU_SIGNS} AND signs * {quality.MENU_WORDS} >= words - signs)
    AND symbols * 100 <= words * {quality.MARKS_PERCENT} AND shouts * 100 <= words * {quality.MARKS_PERCENT}
    AND (regexp_matches(l, '[.!?]$') OR regexp_matches(l, {_regex(quality.SENTENCE)}) OR regexp_matches(l, '{quality.OTHER_SENTENCE}')
      -- Without a sentence end: more than a few words, no half of them repeated, not mostly capitals.
      OR NOT ((len(ws) <= {quality.FEW_WORDS} AND NOT regexp_matches(l, '{unparted}')) OR len(list_distinct(ws)) * 2 <= len(ws)
        OR len(list_filter(ws, lambda w: regexp_matches(w, '^\p{{Lu}}'))) * 3 > len(ws) * 2))
    AND NOT ({notices})
  GROUP BY r
), f AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(good.n, 0) AS BIGINT) AS n_kept_words
  FROM d LEFT JOIN covered USING (r) LEFT JOIN good USING (r)
), b AS (
  SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.REPEATED_PERCENT} * n_words AS base_failed FROM f
)
SELECT *, NOT base_failed AND 100 * n_kept_words >= {quality.KEPT_PERCENT} * n_words AS kept FROM b
"""


_NEAR = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM ({_DOCS})
), s AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM shared s JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * s.n >= 75 * (a.n + b.n - s.n)
), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, edge.y FROM reach JOIN edge ON edge.x = reach.other
), comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def _secrets() -> str:
    """Matches and what stands between them alternate; their lengths give the places."""
    key = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
    rules = []
    for k, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", key)
        value = f"regexp_replace(m, {_regex('^' + key)}, '')" if rule.value else "m"
        rules.append(f"""
  SELECT r, {k} AS kind, '{rule.kind}' AS name, b AS s, b + length(m) AS e FROM (
    SELECT r, ms[i] AS m, coalesce(list_sum(list_transform(parts[1 : i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(ms[1 : i - 1], lambda x: length(x))), 0) AS b
    FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT r, regexp_extract_all(text, {_regex(pattern)}) AS ms, string_split_regex(text, {_regex(pattern)}) AS parts FROM d)))
  WHERE length({value}) >= {rule.least}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM ({_DOCS})),
span AS ({" UNION ALL ".join(rules)}),
listed AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(name || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
    string_agg(name || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, kind) AS spans
  FROM span GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)
"""


_CHAT_MARK = r"""'([\[<])(\\*)(/?(?:INST|TEXT|ROLE)\]|/?s>)', '\1\\\2\3', 'g'"""
_CHAT = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), e AS (
  SELECT *, length(regexp_replace(text, {_CHAT_MARK})) AS n,
    length(regexp_replace(role, {_CHAT_MARK})) AS role_n, chr(10) AS br FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || br || text || br, '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE role WHEN 'user' THEN 13 + n WHEN 'assistant' THEN 7 + n ELSE 19 + role_n + n END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def _licenses() -> str:
    rows = ", ".join(
        f"({n}, {_regex(name)}, {_regex(t)}, {c})" for n, name, _, terms in licenses.templates() for t, c in terms.items()
    )
    common = ", ".join(f"({_regex(t)})" for t in sorted(licenses.COMMON))
    window, step = licenses.WINDOW, licenses.STEP
    return f"""
WITH f AS (
  SELECT DISTINCT concat_ws('/', source, lang, doc_id || '.txt') AS path, doc_id, coalesce(text, '') AS text FROM documents
), t AS (SELECT path, text, regexp_extract_all(lower(text), '{licenses.TERM}') AS terms FROM f),
model AS (SELECT * FROM (VALUES {rows}) AS t(template, licence, term, n)),
common AS (SELECT * FROM (VALUES {common}) AS t(term)),
known AS (SELECT DISTINCT term FROM model ANTI JOIN common USING (term)),
held AS (SELECT term, count(DISTINCT path) AS df FROM (SELECT path, unnest(terms) AS term FROM t) SEMI JOIN known USING (term) GROUP BY term),
idf AS (SELECT term, ln(((SELECT count(*) FROM f) + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM known LEFT JOIN held USING (term)),
weight AS (SELECT term, idf FROM idf UNION ALL SELECT term, 1 FROM common),
unit AS (
  SELECT template, licence, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY template)) AS unit FROM model JOIN weight USING (term)
), line AS (SELECT path, unnest(string_split(text, chr(10))) AS l FROM f),
short AS (
  SELECT path, regexp_extract_all(lower(l), '{licenses.TERM}') AS terms FROM line
  UNION ALL
  SELECT path, regexp_extract_all(lower(unnest(regexp_split_to_array(l, '{licenses.SENTENCE}'))), '{licenses.TERM}') FROM line
), units AS (
  SELECT *, row_number() OVER () AS uid FROM (
    SELECT path, terms FROM short WHERE len(terms) BETWEEN 1 AND {window}
    UNION
    SELECT path, terms[k : k + {window} - 1] FROM (SELECT path, terms, unnest(range(1, greatest(len(terms) - {step}, 1) + 1, {step})) AS k FROM t)
    WHERE len(terms) > 0)
), tf AS (SELECT uid, term, count(*) AS tf FROM (SELECT uid, unnest(terms) AS term FROM units) GROUP BY ALL),
weighed AS (SELECT uid, term, tf * coalesce(idf, (SELECT avg(idf) FROM idf)) AS weight FROM tf LEFT JOIN weight USING (term)),
norm AS (SELECT uid, sqrt(sum(weight * weight)) AS norm FROM weighed GROUP BY uid),
score AS (
  SELECT uid, template, licence, round(sum(weight * unit) / any_value(norm), 6) AS score
  FROM weighed JOIN unit USING (term) JOIN norm USING (uid) GROUP BY ALL
), best AS (
  SELECT uid, score, licence FROM score WHERE score >= {licenses.LEAST}
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, template) = 1
), header AS (
  SELECT path, max(struct_pack(granted := licence <> {_regex(licenses.RESERVED)}, score := score, licence := licence)) AS h,
    max(len(terms)) AS noticed
  FROM best JOIN units USING (uid) GROUP BY path
), stated AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, max(h) AS h FROM header JOIN t USING (path)
  WHERE regexp_matches(path, {_regex(licenses.FILE_NAME)}) OR noticed * 100 >= len(terms) * {licenses.FILE_PERCENT}
  GROUP BY dir
), near AS (
  SELECT path, arg_max(dir, length(dir)) AS dir, arg_max(h.licence, length(dir)) AS licence
  FROM f JOIN stated ON dir = '' OR starts_with(path, dir || '/') GROUP BY path
)
SELECT doc_id, path, h.licence AS header_licence, h.score AS header_score,
  CASE WHEN h IS NULL THEN near.licence END AS inherited_licence,
  CASE WHEN h IS NULL THEN near.dir END AS inherited_from, coalesce(h.licence, near.licence) AS licence
FROM f LEFT JOIN header USING (path) LEFT JOIN near USING (path)
"""


def _middle() -> str:
    p, m, s = middle.PREFIX, middle.MIDDLE, middle.SUFFIX
    return f"""
WITH d AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM ({_DOCS})
), k AS (
  SELECT doc_id, text, t, len(t) AS n,
    [CAST('0x' || substr(h, 1 + 8 * i, 8) AS BIGINT) for i in range(4)] AS h
  FROM d
), c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= {middle.RATE} THEN 'plain'
      WHEN h[4] % 100 < {middle.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM k
), o AS (
  SELECT *, array_to_string(t[1 : a], '') AS p, array_to_string(t[a + 1 : b], '') AS m, array_to_string(t[b + 1 : n], '') AS s
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{p}' || p || '{s}' || s || '{m}' || m
    ELSE '{s}' || s || '{p}' || p || '{m}' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM o
"""


ORACLES: dict[str, str] = {
    "op2_quality": _quality(),
    "op3_near_duplicates": _NEAR,
    "op7_chat": _CHAT,
    "op8_licenses": _licenses(),
    "op10_secrets": _secrets(),
    "op11_middle": _middle(),
}
