"""DuckDB SQL of the numbered queries that SQL can express; written from the contracts, not from the operators."""

from __future__ import annotations

from .quality_rules import STOP_WORDS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

#: The thresholds of the production rules, by hand.
OP2 = rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), spots AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win FROM d, unnest(range(1, len(w) - 1)) u(i)
), twice AS (SELECT doc_id, win FROM spots GROUP BY ALL HAVING count(*) > 1
), rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM spots JOIN twice USING (doc_id, win), unnest([0, 1, 2]) u(k) GROUP BY doc_id
), m AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words, len(regexp_extract_all(t, '!')) AS exclaims, len(lines) AS n_lines,
           len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS stops,
           len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS dots,
           len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•][\x20\x09-\x0D]'))) AS bullets
    FROM d LEFT JOIN rep USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_symbols <= 0.25 * n_words AND exclaims <= 0.5 * n_words AND word_chars BETWEEN 1.5 * n_words AND 25 * n_words
       AND stops >= 0.02 * n_words AND n_dup_lines <= 0.5 * n_lines AND dots <= 0.5 * n_lines AND bullets <= 0.95 * n_lines AS kept
FROM b
"""

OP4 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), spots AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM d, unnest(range(1, len(w) - 11)) u(i)
), first AS (SELECT win, min(doc_id) AS lead FROM spots GROUP BY win
), gone AS (SELECT DISTINCT doc_id, i + k AS p FROM spots JOIN first USING (win), unnest(range(13)) u(k) WHERE doc_id > lead
), words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) u(p)
), kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Base 32 takes 20 bits, five hexadecimal digits, at a time.
OP6 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages
), k AS (SELECT *, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS lead FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda j: '{_DIGITS}'[1 + (CAST('0x' || x[1 + 5 * (j // 4):5 + 5 * (j // 4)] AS BIGINT) >> (15 - 5 * (j % 4))) % 32]), '') AS payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM k
"""

OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 3, 2))) u(i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""

_RUNS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP9 = f"""
WITH d AS (SELECT doc_id, {_RUNS} AS w FROM documents
), b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_RUNS} AS w FROM benchmark
), wins AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
    FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) u(i) WHERE len(w) > 0
), spots AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM d, (SELECT DISTINCT n FROM wins), unnest(range(1, len(w) - n + 2)) u(i)
), hits AS (SELECT doc_id, n, i, item_id FROM spots JOIN wins USING (n, win)
), items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
), cover AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(n)) u(k) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: The crc32 of a text's bytes, by its table of 256 numbers made from the polynomial.
_CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen({0})), lambda j: CAST('0x' || substr(hex(encode({0})), 2 * j + 1, 2) AS BIGINT))),"
    " lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)"
)

#: Near words by their deletions: equal at the same place, or one word equal to another's.
OP11 = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}
), r AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents
), g AS (SELECT id, w, count(*) AS n FROM r GROUP BY ALL
), h AS (SELECT w, n, {_CRC.format("(id || w)")} AS h FROM g, crc
), v AS (
    SELECT CASE WHEN h % 97 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, CAST(sum(n) AS BIGINT) AS n FROM h
    GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), cut AS (SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest FROM v, unnest(range(1, length(word) + 1)) u(i)
), near AS (
    SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT c.word, v.word FROM cut c JOIN v ON v.word = c.rest UNION SELECT v.word, c.word FROM cut c JOIN v ON v.word = c.rest
), best AS (SELECT a, count(*) AS n_near, min((-v.n, b)) AS best FROM near JOIN v ON v.word = b GROUP BY a
), f AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * n THEN -best[1] END AS form_n
    FROM v LEFT JOIN best ON a = word
), walk AS (SELECT word, word AS here FROM f UNION ALL SELECT w.word, f.form FROM walk w JOIN f ON f.word = w.here WHERE f.form IS NOT NULL)
SELECT f.word, f.form, here AS root, f.n, f.n_near, f.form_n FROM f JOIN walk w USING (word) JOIN f l ON l.word = w.here AND l.form IS NULL
"""

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {0})"


def _climb(rows: str, nodes: str, match: str) -> str:
    """A step of folding: the rows' digests and siblings, taken with the other nodes of their runs."""
    return f"""SELECT f.g, f.k, f.i // 3, (f.n + 2) // 3, f.lv + 1, sha256(string_agg(CASE WHEN u.i = f.i THEN f.h ELSE u.h END, '' ORDER BY u.i)),
           f.p || coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i <> f.i), '')
    FROM {rows} f JOIN {nodes} u ON {match} u.lv = f.lv AND u.i // 3 = f.i // 3 WHERE f.n > 1 GROUP BY f.g, f.k, f.i, f.n, f.lv, f.p"""


OP13 = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}
), a AS (
    SELECT doc_id, source, {_LEAF.format(_FIELD.format("text"))} AS leaf,
           CASE WHEN {_CRC.format("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_LEAF.format(_FIELD.format("replace(text, chr(10), '')"))} ELSE {_LEAF.format(_FIELD.format("text"))} END AS changed
    FROM documents, crc
), d AS (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY source) AS n,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM a
), up AS (
    SELECT g, k AS i, n, 0 AS lv, leaf AS h FROM d
    UNION ALL SELECT g, i // 3, (n + 2) // 3, lv + 1, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY g, i // 3, n, lv
), crown AS (
    SELECT g AS i, count(*) OVER () AS n, 0 AS lv, h FROM up WHERE n = 1
    UNION ALL SELECT i // 3, (n + 2) // 3, lv + 1, sha256(string_agg(h, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY i // 3, n, lv
), low AS (
    SELECT g, k, k AS i, n, 0 AS lv, changed AS h, '' AS p FROM d UNION ALL {_climb("low", "up", "u.g = f.g AND")}
), high AS (
    SELECT g, k, g AS i, (SELECT max(n) FROM crown) AS n, 0 AS lv, h, p FROM low WHERE n = 1 UNION ALL {_climb("high", "crown", "")}
)
SELECT doc_id, leaf, s.h AS subroot, c.h AS root, sha256(p) AS proof_sha256, e.h AS folded_root, e.h = c.h AS verified
FROM d JOIN up s ON s.g = d.g AND s.n = 1 JOIN crown c ON c.n = 1 JOIN high e ON e.g = d.g AND e.k = d.k AND e.n = 1
"""
