"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_VISIBLE = r"[^\x20\x09-\x0D]+"

OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS h,
             max(page_id) OVER (PARTITION BY body) AS top FROM p),
v AS (SELECT *, list_transform(range(4), lambda i: CAST('0x' || substr(h, 1 + 10 * i, 10) AS BIGINT)) AS q FROM d)
SELECT page_id, payload_bytes,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((q[1 + k // 8] >> (35 - 5 * (k % 8))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM v
"""

_TOKENS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP2 = f"""
WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWERED}, '{_TOKENS}') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[s + 1:s + 10], ' ') AS win
        FROM iw, unnest(range(0, greatest(1, len(w) - 9))) t(s) WHERE len(w) > 0),
dw AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_TOKENS}') AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
pos AS (SELECT doc_id, size, s, array_to_string(w[s + 1:s + size], ' ') AS win
       FROM dw, sizes, unnest(range(0, len(w) - size + 1)) t(s)),
hit AS MATERIALIZED (SELECT pos.doc_id, pos.s, pos.size, win.item FROM pos JOIN win USING (size, win)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + size)) t(p) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
         FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""

OP7 = f"""
WITH t AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_VISIBLE}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_VISIBLE}')) AS lines FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s + 1:s + 5], ' ') AS win FROM t, unnest(range(0, len(w) - 4)) u(s)),
again AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, win) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM again, unnest(range(s, s + 5)) u(p) GROUP BY doc_id),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_chars,
             length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_chars,
             length(regexp_replace(t, '[^0-9]', '', 'g')) AS digits
      FROM t LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols * 4 > n_words
            OR n_dup_lines * 10 > n_lines * 3 OR word_chars * 2 < n_words * 3
            OR (upper_chars > lower_chars AND upper_chars >= 40) OR digits * 2 > word_chars) AS kept
FROM c
"""

OP10 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_VISIBLE}') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 4], ' ') AS s
                   FROM w, unnest(range(0, greatest(1, len(w) - 3))) t(i) WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
                      WHERE 100 * k >= 85 * (na.n + nb.n - k)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""

OP11 = f"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t),
run AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
own AS MATERIALIZED (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key, count(*) AS n FROM run GROUP BY doc_id, run),
bytes AS (SELECT run, n, hex(encode(key)) AS x FROM own),
hashed AS (SELECT run, n, xor(list_reduce(list_transform(range(len(x) // 2), lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM bytes, crc),
word AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gone AS MATERIALIZED (SELECT word, i, word[1:i - 1] || word[i + 1:] AS v FROM word, unnest(range(1, length(word) + 1)) t(i)),
near AS (SELECT a.word, b.word AS other FROM gone a JOIN gone b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
         UNION SELECT a.word, w.word FROM gone a JOIN word w ON a.v = w.word
         UNION SELECT w.word, a.word FROM gone a JOIN word w ON a.v = w.word),
best AS (SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, other, o.n AS other_n
         FROM near JOIN word o ON o.word = other
         QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) = 1),
form AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
         CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n FROM word w LEFT JOIN best b ON b.word = w.word),
up AS (SELECT word, word AS root FROM form WHERE form IS NULL
       UNION ALL SELECT f.word, u.root FROM form f JOIN up u ON f.form = u.word)
SELECT f.word, form, root, n, n_near, form_n FROM form f JOIN up ON up.word = f.word
"""

OP13 = f"""
WITH w AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
           FROM documents, unnest(string_split_regex({_LOWERED}, '[.,;:!?\\x0A-\\x0D]')) t(piece)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[s + 1:s + m], ' ') AS phrase, count(*) AS f
  FROM w, unnest([1, 2, 3, 4]) a(m), unnest(range(0, greatest(0, len(w) - m + 1))) b(s) GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first,
               array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
        FROM f, unnest(range(1, m)) t(k) WHERE m > 1),
scored AS (SELECT c.*, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score
           FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM f g WHERE g.lang = b.lang AND len(string_split(g.phrase, ' ')) > len(string_split(b.phrase, ' '))
                      AND 100 * g.f >= 80 * b.a AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""

ORACLE = {"op1_warc": OP1, "op2_decontaminate": OP2, "op7_rules": OP7, "op10_jaccard": OP10, "op11_spelling": OP11,
          "op13_collocations": OP13}
