"""DuckDB SQL of the results that SQL can express; written from the result
contracts, not from the operators' method."""

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Shingle sets as lists of strings; a shorter text is one shingle.
SHINGLES = f"""
word_list AS (SELECT doc_id, {WORDS.format(ASCII_LOWER)} AS ws FROM {{table}}),
shingle_set AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')))) END AS sh
  FROM word_list)"""

NEAR_DUP = f"""
WITH RECURSIVE {SHINGLES.format(table='documents')},
class AS (SELECT sh, min(doc_id) AS rep, len(sh) AS n FROM shingle_set WHERE len(sh) > 0 GROUP BY sh),
item AS (SELECT rep, n, unnest(sh) AS g FROM class),
meet AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i
         FROM item a JOIN item b ON a.g = b.g AND a.rep < b.rep GROUP BY 1, 2),
link AS (SELECT a, b FROM meet WHERE 100 * i >= 85 * (na + nb - i)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT rep AS a, rep AS b FROM class UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
label AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(l.component, s.doc_id) AS component_id,
  coalesce(l.component, s.doc_id) = s.doc_id AS kept
FROM shingle_set s LEFT JOIN class c ON c.sh = s.sh LEFT JOIN label l ON l.rep = c.rep
"""

DECONTAMINATION = f"""
WITH {SHINGLES.format(table='documents')},
item_words AS (SELECT item_id, {WORDS.format(ASCII_LOWER)} AS ws FROM benchmark),
item AS (SELECT item_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END) AS g FROM item_words),
size AS (SELECT item_id, count(*) AS n FROM item GROUP BY 1),
doc AS (SELECT doc_id, unnest(sh) AS g FROM shingle_set),
shared AS (SELECT d.doc_id, i.item_id, count(*) AS s FROM doc d JOIN item i USING (g) GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_item_shingles, s AS n_shared, s / n AS containment
FROM shared JOIN size USING (item_id) WHERE 100 * s >= 80 * n
"""

# (rule, statistic, least cutoff, greatest cutoff): the operator's parameters.
QUALITY_RULES = [
    ("symbols", "n_symbols / greatest(word_chars, 1)", 0.01, 0.5),
    ("dup_lines", "n_dup_lines / greatest(n_lines, 1)", 0.02, 1.0),
    ("repeats", "n_repeat_words / greatest(n_words, 1)", 0.02, 0.3),
    ("long_words", "word_chars / greatest(n_words, 1)", 6.0, 20.0),
    ("short_words", "-word_chars / greatest(n_words, 1)", -5.0, -1.0),
]
_STATISTICS = " UNION ALL ".join(
    f"SELECT doc_id, lang, {at} AS place, '{rule}' AS rule, CASE WHEN x < {low} THEN 0 WHEN x >= {high} THEN 32 "
    f"ELSE CAST(floor((x - {low}) * 31 / ({high} - ({low}))) AS INT) + 1 END AS level "
    f"FROM (SELECT *, CAST({stat} AS DOUBLE) AS x FROM counts WHERE NOT base_failed)"
    for at, (rule, stat, low, high) in enumerate(QUALITY_RULES))

QUALITY = rf"""
WITH parts AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
place AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM parts WHERE len(ws) >= 8),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS w FROM place),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM win),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twice WHERE c > 1) GROUP BY 1),
counts AS (
  SELECT p.doc_id, p.lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(list_sum(list_transform(ws, lambda w: length(w))) AS BIGINT) AS wc,
    CAST(coalesce(wc, 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words,
    len(ws) < 20 OR 100 * coalesce(c.n, 0) > 30 * len(ws) AS base_failed
  FROM parts p LEFT JOIN covered c USING (doc_id)),
marks AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY 1),
stat AS ({_STATISTICS}),
judged AS (SELECT * FROM stat JOIN marks USING (doc_id)),
total AS (SELECT lang, rule, sum(quality) AS n FROM judged GROUP BY ALL),
cut AS (SELECT a.lang, a.rule, a.level, t.n, sum(b.quality) AS k, sum(1 - b.quality) AS caught
        FROM (SELECT DISTINCT lang, rule, level FROM judged) a JOIN judged b ON a.lang = b.lang AND a.rule = b.rule AND b.level >= a.level
        JOIN total t ON t.lang = a.lang AND t.rule = a.rule GROUP BY ALL),
term AS (SELECT *, unnest(range(CAST(k AS BIGINT) + 1)) AS j FROM cut WHERE level > 0 AND caught > 0 AND caught >= 9 * k AND k < 0.005 * n),
tail AS (SELECT lang, rule, level, k, caught,
           sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.005) + (n - j) * ln(0.995))) AS p
         FROM term GROUP BY ALL),
chosen AS (SELECT lang, rule, level FROM tail WHERE p * (SELECT count(DISTINCT lang) FROM judged) * 160 <= 0.05
           QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY caught DESC, k, level DESC) = 1),
fired AS (SELECT s.doc_id, arg_min(s.rule, s.place) AS rejected_by FROM stat s JOIN chosen c ON s.lang = c.lang AND s.rule = c.rule
          AND s.level >= c.level GROUP BY 1)
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rejected_by IS NULL AS kept, rejected_by
FROM counts c LEFT JOIN fired f USING (doc_id)
"""

CHAT = r"""
WITH turn AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(20 + 2 * (length(role) + length(text)) - length(translate(role || text, '\<>', ''))) AS BIGINT) AS formatted_chars
FROM turn GROUP BY conv_id
"""

WARC = """
WITH page AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
last AS (SELECT payload_digest, max(page_id) AS last FROM page WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM page LEFT JOIN last USING (payload_digest)
"""

LINES = """
WITH split AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT r, doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS l FROM split),
keyed AS (SELECT *, translate(trim(l, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line),
common AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
marked AS (SELECT *, k IN (SELECT k FROM common) AS gone FROM keyed)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

TERMS = rf"regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SEARCH = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS ts FROM documents),
corpus AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS big_l FROM doc),
size AS (SELECT r, doc_id, 10 + (90 * len(ts) * big_n) // big_l AS m FROM doc, corpus WHERE len(ts) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM doc) GROUP BY ALL),
item AS (SELECT DISTINCT item_id, unnest({TERMS}) AS t FROM benchmark),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM tf, corpus WHERE t IN (SELECT t FROM item) GROUP BY t),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM item JOIN tf USING (t) JOIN weight USING (t) JOIN size USING (r) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat_format": CHAT,
        "op6_near_dup": NEAR_DUP,
        "op7_warc": WARC,
        "op8_decontamination": DECONTAMINATION,
        "op9_quality_rules": QUALITY,
        "op11_line_dedup": LINES,
        "op12_term_search": SEARCH,
    }
