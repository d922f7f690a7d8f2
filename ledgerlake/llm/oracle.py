"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP3 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM d),
runs AS (
  SELECT doc_id, i, 3 AS width, md5(array_to_string(words[i:i+2], ' ')) AS k FROM places WHERE i + 2 <= len(words)
  UNION ALL
  SELECT doc_id, i, 10, md5(array_to_string(words[i:i+9], ' ')) FROM places WHERE i + 9 <= len(words)
  UNION ALL
  SELECT doc_id, i, 101, md5(array_to_string(words[i:i+100], ' ')) FROM places WHERE i + 100 <= len(words)
),
again AS (SELECT * FROM runs QUALIFY count(*) OVER (PARTITION BY doc_id, width, k) > 1),
spans AS (
  SELECT doc_id, width, i,
         coalesce(lead(i) OVER (PARTITION BY doc_id, width ORDER BY i), i + width) AS next_i
  FROM again
),
covered AS (
  SELECT doc_id,
         sum(least(width, next_i - i)) FILTER (width = 3) AS n3,
         sum(least(width, next_i - i)) FILTER (width = 10) AS n10,
         count(*) FILTER (width = 101) AS n101
  FROM spans GROUP BY doc_id
),
base AS (
  SELECT d.doc_id,
         CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(length(array_to_string(words, '')), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         CAST(coalesce(n3, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(n10, 0) AS BIGINT) AS covered_words,
         coalesce(n101, 0) AS n101
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols,
       CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
       n_repeat_words, covered_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND 100 * covered_words <= 40 * n_words AND n101 = 0 AS kept
FROM base
"""

TRIM = r"regexp_replace(regexp_replace({}, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')"

OP8 = rf"""
WITH lined AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
each AS (SELECT DISTINCT source, text, unnest(range(1, len(lines) + 1)) AS i, lines FROM lined),
line AS (SELECT source, text, i, {TRIM.format('lines[i]')} AS l FROM each),
spread AS (SELECT l FROM line WHERE l <> '' GROUP BY l HAVING count(DISTINCT source) >= 8),
held AS (SELECT DISTINCT text, i, l FROM line JOIN spread USING (l)),
share AS (SELECT text, 2 * sum(length(l)) > length(text) AS mostly FROM held GROUP BY text),
copied AS (
  SELECT l FROM (SELECT DISTINCT text, l FROM held) JOIN share USING (text)
  GROUP BY l HAVING 2 * count_if(mostly) > count(*)
),
gone AS (SELECT text, list(i) AS gone FROM held WHERE l NOT IN (SELECT l FROM copied) GROUP BY text),
cut AS (SELECT d.doc_id, d.text, lines, g.gone FROM lined d LEFT JOIN gone g ON d.text = g.text)
SELECT doc_id,
       CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NOT NULL
                   THEN coalesce(array_to_string(list_filter(lines, lambda x, i: NOT list_contains(gone, i)), chr(10)), '')
                   ELSE coalesce(text, '') END) AS text_sha256
FROM cut
"""

TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"

# The rule itself, without masks: all diagonals on which enough tokens agree.
OP9 = f"""
WITH d AS (SELECT doc_id, {TOKENS} AS t FROM documents),
b AS (SELECT item_id, {TOKENS} AS t FROM benchmark),
d_at AS (SELECT doc_id, unnest(t) AS w, unnest(range(1, len(t) + 1)) AS i FROM d),
b_at AS (SELECT item_id, len(t) AS n, unnest(t) AS w, unnest(range(1, len(t) + 1)) AS i FROM b),
hits AS (
  SELECT doc_id, item_id, d_at.i - b_at.i AS diagonal FROM d_at JOIN b_at USING (w)
  GROUP BY ALL HAVING 13 * count(*) >= 10 * least(13, any_value(n))
),
compared AS (
  SELECT h.doc_id, h.item_id, diagonal, len(b.t) AS n, least(13, len(b.t)) AS w,
         list_transform(range(1, len(b.t) + 1), lambda j:
           CASE WHEN diagonal + j >= 1 AND diagonal + j <= len(d.t) AND d.t[diagonal + j] = b.t[j] THEN 1 ELSE 0 END) AS same
  FROM hits h JOIN d ON d.doc_id = h.doc_id JOIN b ON b.item_id = h.item_id
),
judged AS (
  SELECT doc_id, item_id, diagonal, w, list_sum(same) AS matched,
         list_max(list_transform(range(1, n - w + 2), lambda i: list_sum(same[i:i + w - 1]))) AS best
  FROM compared
)
SELECT doc_id, item_id, CAST(best AS BIGINT) AS best_overlap, CAST(matched AS BIGINT) AS matched,
       CAST(diagonal AS BIGINT) AS start
FROM judged WHERE 13 * best >= 10 * w
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY best DESC, matched DESC, diagonal) = 1
"""

def _op4_level(d: int) -> str:
    return rf"""
kids{d} AS (
  SELECT host, template, seg[{d + 1}] AS s, sum(n) AS n, sum(l) AS l, sum(b) AS b
  FROM tree{d} WHERE len(seg) > {d} AND template NOT LIKE '%**' GROUP BY ALL
),
up{d} AS (
  SELECT host, template, count(*) AS k, sum(n) AS n, sum(l) AS l, sum(b) AS b FROM kids{d} GROUP BY ALL
),
to{d} AS (
  SELECT c.host, c.template, c.s,
         CASE WHEN u.l < 10 THEN '**'
              WHEN c.l < 10 THEN '*'
              WHEN abs(c.b::DOUBLE / c.l::DOUBLE - u.b::DOUBLE / u.l::DOUBLE)
                   <= CASE WHEN u.k > 50 AND c.n * 50 < u.n THEN 3.29 ELSE 1.96 END * sqrt(u.b::DOUBLE / u.l::DOUBLE * (1 - u.b::DOUBLE / u.l::DOUBLE) / c.l::DOUBLE) THEN '*'
              ELSE c.s END AS x
  FROM kids{d} c JOIN up{d} u ON c.host = u.host AND c.template = u.template
),
tree{d + 1} AS (
  SELECT t.host, t.shape, t.seg, t.n, t.l, t.b, t.template || coalesce('/' || x, '') AS template
  FROM tree{d} t LEFT JOIN to{d} o ON t.host = o.host AND t.template = o.template AND t.template NOT LIKE '%**' AND t.seg[{d + 1}] = o.s
)"""


_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
_FITS = " UNION ALL ".join(
    f"SELECT '{h}' AS h, '{p}' AS p, '{h}{p}' AS rule, '{v}' AS verdict" for h, p, v in _RULES
)

OP4 = rf"""
WITH split AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
),
segs AS (
  SELECT *, list_transform(list_filter(string_split(replace(path, '*', '%star'), '/'), lambda s: s <> ''),
                           lambda s: regexp_replace(s, '[0-9]+', '*', 'g')) AS every
  FROM split
),
parts AS (
  SELECT page_id, host, path, array_to_string(every, '/') AS shape
  FROM segs
),
marks AS (
  SELECT p.page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM parts p JOIN labels ON labels.doc_id = TRY_CAST(regexp_extract(path, '/(\d{{1,18}})(?:[/.]|$)', 1) AS BIGINT)
  GROUP BY p.page_id
),
shapes AS (
  SELECT host, shape, count(*) AS n, count(bad) AS l, coalesce(sum(bad), 0) AS b
  FROM parts LEFT JOIN marks USING (page_id) GROUP BY ALL
),
tree0 AS (SELECT *, list_filter(string_split(shape, '/'), lambda s: s <> '') AS seg, '' AS template FROM shapes),
{",".join(_op4_level(d) for d in range(6))},
tree AS (SELECT host, shape, l, b, template FROM tree6),
prior AS (SELECT coalesce((sum(l) - sum(b))::DOUBLE / nullif(sum(l), 0)::DOUBLE, 1.0) AS g FROM shapes),
hosts AS (
  SELECT host, ((sum(l) - sum(b))::DOUBLE + 10.0::DOUBLE * any_value(g)) / (sum(l)::DOUBLE + 10.0::DOUBLE) AS g
  FROM shapes, prior GROUP BY host
),
judged AS (
  SELECT t.host, template,
         CASE WHEN ((sum(l) - sum(b))::DOUBLE + 10.0::DOUBLE * any_value(g)) / (sum(l)::DOUBLE + 10.0::DOUBLE) < 0.5::DOUBLE
              THEN 'block' ELSE 'allow' END AS verdict
  FROM tree t JOIN hosts h ON t.host = h.host GROUP BY ALL
),
fit AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(r.verdict, length(rule)) AS verdict
  FROM parts JOIN ({_FITS}) r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, j.verdict) AS verdict, t.template
FROM parts p JOIN tree t ON p.host = t.host AND p.shape = t.shape
JOIN judged j ON j.host = t.host AND j.template = t.template
LEFT JOIN fit f ON f.page_id = p.page_id
"""

OP12 = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
hashed AS (
  SELECT doc_id, text, t, CAST(len(t) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(t) + 1) AS c1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(t) + 1) AS c2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4
  FROM cut
),
parts AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR regexp_matches(text, '<P>|<S>|<M>') OR h3 >= 50 THEN 'plain' WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form,
         coalesce(array_to_string(t[1:least(c1, c2)], ''), '') AS prefix,
         coalesce(array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS middle,
         coalesce(array_to_string(t[greatest(c1, c2) + 1:], ''), '') AS suffix
  FROM hashed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

# What an escape adds: one character before a backslash, a # after a #, a / after a < (in roles also a colon).
ESCAPES = (
    r"length({0}) - length(replace({0}, '\', '')) + length({0}) - length(regexp_replace({0}, '#+', '#', 'g'))"
    r" + (length({0}) - length(replace({0}, '</', ''))) // 2"
)
TURN_ORDER = "ORDER BY turn NULLS FIRST, role, text"

OP1 = rf"""
WITH said AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
),
sized AS (
  SELECT *, length('### : </turn>') + 1 + length(role) + length(text) + {ESCAPES.format("text")}
            + {ESCAPES.format("role")} + length(role) - length(replace(role, ':', '')) AS chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {TURN_ORDER})) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' {TURN_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, false AS rewrites_history
FROM sized GROUP BY conv_id
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i+12], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)
),
repeats AS (SELECT doc_id, i FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY k)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM repeats),
placed AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

LLM_ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": OP1,
    "op3_quality_rules": OP3,
    "op4_url_filters": OP4,
    "op8_line_dedup": OP8,
    "op9_decontamination": OP9,
    "op10_substring_dedup": OP10,
    "op12_fill_middle": OP12,
}
