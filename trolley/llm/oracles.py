"""DuckDB SQL for the contracts that SQL can express, written from the contracts
alone: no hashing of windows into units, no anchors, no archives."""

from __future__ import annotations

from trolley.llm.rules import CHAR_GUARD, CHAR_LIMIT, WORD_GUARD, WORD_LIMIT

SPACE = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{SPACE}') AS ws FROM documents),
win AS (SELECT r, s, md5(array_to_string(ws[s:s + 34], ' ')) AS h FROM w, range(1, len(ws) - 33) t(s) WHERE len(ws) >= 35),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, s + k AS p FROM win JOIN rep USING (h), range(0, 35) t(k)),
word AS (SELECT r, p, ws[p] AS x FROM w, range(1, len(ws) + 1) t(p)),
cut AS (SELECT word.r, count(gone.p) AS n_removed, string_agg(CASE WHEN gone.p IS NULL THEN x END, ' ' ORDER BY word.p) AS kept
        FROM word LEFT JOIN gone ON gone.r = word.r AND gone.p = word.p GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN cut USING (r)"""

OP5 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY 1)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN n >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)"""

# bytes as two hex digits each: byte i is characters 2 i + 1 and 2 i + 2
OP6 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT r, doc_id, x, len(x) // 2 AS n FROM d),
win AS (SELECT r, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM s, range(0, n - 199) t(i) WHERE n >= 200),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
st AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM win JOIN rep USING (h)),
runs AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM st),
span AS (SELECT r, run, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY 1, 2),
part AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS from_ FROM span),
cut AS (SELECT s.r, count(*) AS n_spans, sum(b - a) AS n_removed,
               string_agg(substr(x, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept
        FROM part JOIN s USING (r) GROUP BY 1)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM s LEFT JOIN cut USING (r)"""


OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang,
                  regexp_extract_all(coalesce(text, ''), '{SPACE}') AS ws FROM documents),
known AS (SELECT lang FROM d WHERE lang <> '*' GROUP BY 1 HAVING count(*) >= 0.001 * (SELECT count(*) FROM d)),
k AS (SELECT d.*, len(ws) AS n, CASE WHEN known.lang IS NULL THEN '*' ELSE d.lang END AS ref FROM d LEFT JOIN known USING (lang)),
ch AS (SELECT r, lang, ref, length(t) AS size, [
    length(regexp_replace(t, '[^a-z]', '', 'g')), length(regexp_replace(t, '[^A-Z]', '', 'g')), length(regexp_replace(t, '[^0-9]', '', 'g')),
    length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')), length(regexp_replace(t, '[^.,;:!?''"()-]', '', 'g')),
    length(regexp_replace(t, '[^\x00-\x08\x0E-\x1F#$%&*+/<=>@\[\\\]^_`{{|}}~\x7F]', '', 'g')), length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))] AS c FROM k),
cl AS (SELECT r, ref, size, i, c[i] AS x FROM ch, range(1, 8) t(i)),
once AS (SELECT min(r) AS r FROM k GROUP BY lang, t),
cl1 AS (SELECT * FROM cl SEMI JOIN once USING (r)),
cref0 AS (SELECT ref, i, sum(x) AS x FROM cl1 GROUP BY 1, 2 HAVING ref <> '*' UNION ALL SELECT '*', i, sum(x) FROM cl1 GROUP BY 2),
cref AS (SELECT ref, i, x / greatest(sum(x) OVER (PARTITION BY ref), 1) AS q FROM cref0),
cjs AS (SELECT r, any_value(size) AS size, sqrt(greatest(sum(
          (CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 0)) AS js
        FROM (SELECT cl.r, cl.size, cl.x / greatest(cl.size, 1) AS p, q FROM cl JOIN cref ON cref.ref = cl.ref AND cref.i = cl.i) GROUP BY 1),
word AS (SELECT r, ref, n, p, ws[p] AS w FROM k, range(1, len(ws) + 1) t(p)),
cnt AS (SELECT r, ref, w, count(*) AS x FROM word GROUP BY 1, 2, 3),
cnt1 AS (SELECT * FROM cnt SEMI JOIN once USING (r)),
tot AS (SELECT ref, w, sum(x) AS x FROM cnt1 GROUP BY 1, 2 HAVING ref <> '*' UNION ALL SELECT '*', w, sum(x) FROM cnt1 GROUP BY 2),
sz AS (SELECT ref, sum(x) AS size FROM tot GROUP BY 1),
common AS (SELECT tot.ref, w, x, size FROM tot JOIN sz USING (ref) WHERE x >= 0.002 * size),
wref AS (SELECT ref, w, x / size AS q FROM common UNION ALL SELECT ref, NULL, (any_value(size) - sum(x)) / any_value(size) FROM common GROUP BY 1),
hit AS (SELECT cnt.r, cnt.w, cnt.x FROM cnt JOIN common ON common.ref = cnt.ref AND common.w = cnt.w),
wh AS (SELECT r, w, x FROM hit UNION ALL
       SELECT k.r, NULL, n - coalesce(s, 0) FROM k LEFT JOIN (SELECT r, sum(x) AS s FROM hit GROUP BY 1) USING (r)),
wjs AS (SELECT r, sqrt(greatest(sum(
          (CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 0)) AS js
        FROM (SELECT k.r, coalesce(wh.x, 0) / k.n AS p, q FROM k JOIN wref USING (ref)
              LEFT JOIN wh ON wh.r = k.r AND wh.w IS NOT DISTINCT FROM wref.w WHERE k.n > 0) GROUP BY 1),
win AS (SELECT r, p, count(*) OVER (PARTITION BY r, h) AS m FROM (
          SELECT r, p, array_to_string(ws[p:p + 4], ' ') AS h FROM k, range(1, len(ws) - 3) t(p) WHERE len(ws) >= 5)),
rep AS (SELECT r, count(DISTINCT p + j) AS m FROM win, range(0, 5) t(j) WHERE win.m > 1 GROUP BY 1),
ln AS (SELECT r, count(*) - count(DISTINCT l) AS m FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM k)
       WHERE regexp_matches(l, '{SPACE}') GROUP BY 1),
base AS (SELECT k.r, doc_id, CAST(n AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(ln.m, 0) AS n_dup_lines,
                coalesce(rep.m, 0) AS n_repeat_words FROM k LEFT JOIN ln USING (r) LEFT JOIN rep USING (r)),
v AS (SELECT base.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, coalesce(cjs.js, 0) AS c, cjs.size, coalesce(wjs.js, 0) AS w
      FROM base LEFT JOIN cjs USING (r) LEFT JOIN wjs USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (size >= {CHAR_GUARD} AND c > {CHAR_LIMIT[0]} + {CHAR_LIMIT[1]} / sqrt(size))
       AND NOT (n_words >= {WORD_GUARD} AND w > {WORD_LIMIT[0]} + {WORD_LIMIT[1]} / sqrt(n_words)) AS kept,
       round(c, 6) AS char_js, round(w, 6) AS word_js FROM v"""

OP13 = r"""
WITH t AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM t),
n AS (SELECT lang, sum(len(ws)) AS n FROM p GROUP BY 1),
g AS (SELECT lang, m, array_to_string(ws[s:s + m - 1], ' ') AS phrase
      FROM p, range(1, 5) a(m), range(1, len(ws) + 1) b(s) WHERE s + m - 1 <= len(ws)),
f AS (SELECT lang, m, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 30),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
part AS (SELECT lang, m, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
         FROM c, range(1, 4) t(k) WHERE k < m),
cut AS (SELECT part.lang, part.m, part.phrase, a, k, l.f AS l, r.f AS r, (2000000 * a) // (l.f + r.f) AS score
        FROM part JOIN f l ON l.lang = part.lang AND l.phrase = head JOIN f r ON r.lang = part.lang AND r.phrase = tail),
low AS (SELECT lang, m, phrase, a, l, r, score FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sub AS (SELECT lang, array_to_string(ws[s:s + m2 - 1], ' ') AS phrase, max(a) AS most
        FROM c, range(2, 4) t(m2), range(1, 4) u(s) WHERE m2 < m AND s + m2 - 1 <= m GROUP BY 1, 2),
kept AS (SELECT low.* FROM low LEFT JOIN sub USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score FROM top JOIN n USING (lang) WHERE rank <= 2000"""

ORACLES = {"op2_substring_dedup": OP2, "op5_warc_index": OP5, "op6_suffix_dedup": OP6, "op8_quality_rules": OP8, "op13_collocations": OP13}
