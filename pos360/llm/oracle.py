"""DuckDB SQL of the queries that SQL can express over whole tables.

Not here: operator 2 (no fixed answer), 3 (boosted trees), 4 (DuckDB has no
XXH64), 5 (Viterbi paths), 7 (binomial tests), 9 (random draws) and 10
(recursive links); tests hold these against brute force, the law of the draw,
exact round trips or held-out accuracy."""

from __future__ import annotations

from pos360.llm.license_rules import MAX_WORDS, rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

def _rules() -> str:
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    return ", ".join(f"({r.order}, {text(r.label)}, {r.priority}, {r.weight}, {text(r.keyword)}, {r.lead}, {text(r.pattern)}, {r.base})" for r in rules())


ORACLE: dict[str, str] = {
    "op1_suffix_array_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT doc_id, 512 * c AS base, substr(h, 1024 * c + 1, 1122) AS h FROM (SELECT *, unnest(range(0, length(h) // 1024 + 1)) AS c FROM d)),
piece AS (SELECT doc_id, base + i AS i, substr(h, 2 * i + 1, 100) AS s
          FROM (SELECT *, unnest(range(0, least(512, length(h) // 2 - 49))) AS i FROM part)),
earliest AS (SELECT s, min(doc_id) AS first_id FROM piece GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT p.doc_id, p.i, lag(p.i) OVER o AS before, lead(p.i) OVER o AS after
        FROM piece p JOIN earliest e ON p.s = e.s AND e.first_id < p.doc_id WINDOW o AS (PARTITION BY p.doc_id ORDER BY p.i)),
run AS (SELECT doc_id, i, coalesce(i - before > 50, true) AS opens, least(50, coalesce(after - i, 50)) AS n FROM hit),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b
         FROM (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM run) GROUP BY doc_id, r),
gap AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM span
        UNION ALL SELECT doc_id, max(b), NULL FROM span GROUP BY doc_id),
kept AS (SELECT g.doc_id, string_agg(substr(h, 2 * g.a + 1, coalesce(2 * (g.b - g.a), length(h))), '' ORDER BY g.a) AS k
         FROM gap g JOIN d USING (doc_id) GROUP BY g.doc_id),
sums AS (SELECT doc_id, sum(n) AS removed, count(*) FILTER (WHERE opens) AS spans FROM run GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(CASE WHEN removed IS NULL THEN h ELSE k END)) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op6_suffix_automata_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d)),
again AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM again),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS k FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op8_suffix_array_decontamination": f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_ALNUM} AS w FROM benchmark),
sized AS (SELECT *, least(13, len(w)) AS n FROM item WHERE len(w) > 0),
test AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
size AS (SELECT DISTINCT n FROM test),
win AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN size ON len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM win JOIN test USING (n, s)),
word AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS list FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_license_signatures": f"""
WITH rule(ord, label, priority, weight, keyword, lead, pattern, base) AS (VALUES {_rules()}),
d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i FROM d),
near AS (SELECT doc_id, i - lead AS a, r.*, array_to_string(w[i - lead + 1:i - lead + {MAX_WORDS}], ' ') AS s
         FROM word JOIN rule r ON x = keyword AND lead <= i JOIN d USING (doc_id)),
match AS (SELECT *, regexp_extract(s, '^(?:' || pattern || ')(?: |$)') AS m FROM near),
det AS (SELECT *, a + length(rtrim(m)) - length(replace(rtrim(m), ' ', '')) + 1 AS z FROM match WHERE m <> ''),
longest AS (SELECT * FROM det QUALIFY row_number() OVER (PARTITION BY doc_id, a ORDER BY z DESC, priority, ord) = 1),
outside AS (SELECT * FROM longest
            QUALIFY coalesce(max(z) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) < z),
left_over AS (SELECT * FROM outside o WHERE NOT EXISTS (SELECT 1 FROM outside e WHERE e.doc_id = o.doc_id AND e.a < o.z AND o.a < e.z
              AND (e.priority, e.a - e.z, e.ord) < (o.priority, o.a - o.z, o.ord))),
found AS (SELECT doc_id, label, weight FROM left_over UNION ALL SELECT doc_id, label, weight FROM det WHERE base),
base AS (SELECT doc_id, count(*) AS n, min(a) AS first, max(a) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM det WHERE base GROUP BY doc_id),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS l, max(weight) AS score FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(first AS BIGINT) AS first_word, CAST(last AS BIGINT) AS last_word,
  coalesce(base.l, '') AS base_labels, coalesce(every.l, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)""",
    "op12_bitsliced_search": f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
stat AS (SELECT count(*) FILTER (len(w) > 0) AS dn, CAST(sum(len(w)) AS BIGINT) AS total FROM d),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_ALNUM}) AS t FROM benchmark) GROUP BY item_id, t),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d) SEMI JOIN q USING (t) GROUP BY doc_id, n, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * dn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, stat GROUP BY t, dn),
part AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * dn) // total))) AS p FROM tf JOIN weight USING (t), stat),
score AS (SELECT item_id, doc_id, CAST(sum(times * p) AS BIGINT) AS score FROM q JOIN part USING (t) GROUP BY item_id, doc_id HAVING sum(times * p) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, CAST(doc_id AS BIGINT) AS doc_id, score
FROM score QUALIFY rank <= 20""",
    "op13_debruijn_collocations": rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all({_LOWER}, '[^.,;:!?\x0A-\x0D]+')) AS s FROM documents),
word AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM piece),
gram AS (SELECT lang, k, w[i:i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM word, (VALUES (1), (2), (3), (4)) t(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, count(*) AS f FROM gram GROUP BY lang, k, g),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k > 1 AND f >= 30),
inner_ AS (SELECT lang, g[i:i + m - 1] AS g, max(f) AS f
           FROM (SELECT lang, g, f, k, m, unnest(range(1, k - m + 2)) AS i FROM cand, (VALUES (2), (3)) t(m) WHERE m < k) GROUP BY ALL),
best AS (SELECT lang, g, max(f) AS covers FROM inner_ GROUP BY lang, g),
left_over AS (SELECT c.* FROM cand c LEFT JOIN best b ON c.lang = b.lang AND c.g = b.g WHERE covers IS NULL OR 100 * covers < 80 * c.f),
cut AS (SELECT c.lang, c.g, c.f AS a, j, x.f AS l, y.f AS r, CAST((2000000 * CAST(c.f AS HUGEINT)) // (x.f + y.f) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, k)) AS j FROM left_over) c
        JOIN f x ON x.lang = c.lang AND x.g = c.g[1:j] JOIN f y ON y.lang = c.lang AND y.g = c.g[j + 1:c.k]),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
named AS (SELECT *, array_to_string(g, ' ') AS phrase FROM low)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM named JOIN total USING (lang) QUALIFY rank <= 2000""",
}
