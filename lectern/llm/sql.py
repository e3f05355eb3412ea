"""DuckDB SQL for those of the operators' queries that SQL can express on the whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from lectern.llm import decontaminate, quality_rules, sharding, substring_dedup, suffix_dedup, url_filter

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_dup() -> str:
    """Shingles as strings, all pairs that share one, and the closure of the links."""
    return rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
s AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS d, doc_id AS o FROM documents UNION SELECT r.d, s.b FROM r JOIN s ON r.o = s.a),
c AS (SELECT d, min(o) AS component_id FROM r GROUP BY d)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN c ON c.d = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id"""


def substring() -> str:
    k = substring_dedup.WINDOW
    return rf"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
g AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {k - 1}], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM w WHERE len(w) >= {k})
),
f AS (SELECT g, min(doc_id) AS f FROM g GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {k})) AS i FROM g JOIN f USING (g) WHERE f < doc_id),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def quality() -> str:
    q = quality_rules
    return rf"""WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id),
m AS (
  SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM l LEFT JOIN covered USING (doc_id)
),
b AS (SELECT *, n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.REPEAT_PERCENT} * n_words AS base_failed FROM m),
r AS (SELECT *, base_failed OR 100 * n_symbols > {q.SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {q.DUP_LINE_PERCENT} * n_lines AS failed FROM b),
h AS (SELECT host, count(*) AS n, sum(CAST(failed AS INTEGER)) AS f FROM r WHERE host IS NOT NULL GROUP BY host),
o AS (SELECT sum(f) / sum(n) AS mean, greatest(0, sum(n * (f / n) * (f / n)) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n))) AS v FROM h),
k AS (SELECT mean, CASE WHEN v > 1e-12 THEN greatest(0, mean * (1 - mean) / v - 1) END AS k FROM o),
s AS (SELECT host, CASE WHEN k IS NULL THEN mean ELSE (f + mean * k) / (n + k) END AS shrunk FROM h CROSS JOIN k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(shrunk, 0) <= {q.HOST_RATE} AS kept, failed, host
FROM r LEFT JOIN s USING (host)"""


def shards(count: int, seed: int) -> str:
    """Row numbers, the Feistel network unrolled, the walk and CRC-32 (reflected polynomial EDB88320) by recursion."""
    s = sharding

    def salt(i: int, k: int) -> int:
        return (seed * 7919 + i * 104729 + k * 15485863 + 12345) % s.PRIME

    def hashed(x: str, salt: int) -> str:
        one = f"(({x}) % {s.PRIME} * {s.FACTOR} + {salt}) % {s.PRIME}"
        two = f"(({one}) * ({one}) + {salt}) % {s.PRIME} * {s.FACTOR} % {s.PRIME}"
        return f"((({two}) * ({two}) + ({two})) % {s.PRIME})"

    turns = []
    for i in range(s.ROUNDS // 2):
        turns.append(f"SELECT * REPLACE ((x + {hashed('y', salt(i, 0))}) % a AS x) FROM")
        turns.append(f"SELECT * REPLACE ((y + {hashed('x', salt(i, 1))}) % b AS y) FROM")
    network = "(SELECT *, p % a AS x, p // a AS y FROM walk WHERE steps = 0 OR p >= n)"
    for t in turns:
        network = f"({t} {network})"
    bucket = f"CAST('0x' || substr(md5(concat_ws('/', coalesce(CAST(doc_id AS VARCHAR), ''), size, crc)), 1, 8) AS BIGINT) % {s.BUCKETS}"
    return f"""WITH RECURSIVE bits AS (SELECT range AS i, range AS c, 0 AS k FROM range(256) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
t AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
bytes AS (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS v FROM documents),
crc AS (SELECT doc_id, len(v) + 1 AS size, xor(list_reduce(list_prepend(4294967295, v), lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295) AS crc FROM bytes CROSS JOIN t),
base AS (SELECT doc_id, size, crc, row_number() OVER (ORDER BY {bucket}, doc_id) - 1 AS row_number, count(*) OVER () AS n FROM crc),
grid AS (SELECT doc_id, row_number, n, CAST(ceil(sqrt(n)) AS BIGINT) AS a, CAST(ceil(n / ceil(sqrt(n))) AS BIGINT) AS b FROM base),
walk AS (
  SELECT doc_id, n, a, b, row_number AS p, 0 AS steps FROM grid
  UNION ALL SELECT doc_id, n, a, b, y * a + x AS p, steps + 1 FROM {network}
),
placed AS (SELECT doc_id, p FROM walk WHERE steps > 0 AND p < n)
SELECT base.doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(p % {count} AS INTEGER) AS shard,
  p // {count} AS slot, CAST(NULL AS INTEGER) AS grown_shard, row_number
FROM base JOIN placed USING (doc_id)"""


def urls(rules: Sequence[tuple[str, str, str]]) -> str:
    u = url_filter
    variable = u.VARIABLE.replace("++", "+").replace("}+", "}").replace("*+", "*")  # there are no possessive groups in this dialect
    fits = [(h + p, v, f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}')") for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, _, c in fits) + " END"
    fixed = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for _, v, c in fits) + " END"
    constant = "list_transform(string_split(branch, '/'), lambda y, j: CASE WHEN y NOT IN ('*', '') THEN j ELSE 0 END)"
    up = f"array_to_string(list_transform(string_split(branch, '/'), lambda y, j: CASE WHEN j = list_max({constant}) THEN '*' ELSE y END), '/')"
    levels = "\n".join(f"""s{c} AS (SELECT host, branch, {up} AS parent, sum(n) AS n, sum(b) AS b FROM cur{c}
  WHERE len(list_filter({constant}, lambda j: j > 0)) = {c} GROUP BY host, branch),
p{c} AS (SELECT host, parent, CASE WHEN sum(n) > 0 THEN sum(b) / sum(n) ELSE 0 END AS q FROM s{c} GROUP BY host, parent),
f{c} AS (SELECT host, branch, parent FROM s{c} JOIN p{c} USING (host, parent) WHERE abs(b - n * q) <= {u.SIGMAS} * sqrt(n * q * (1 - q)) + 0.5),
cur{c - 1} AS (SELECT host, template, n, b, coalesce(parent, branch) AS branch FROM cur{c} LEFT JOIN f{c} USING (host, branch)),""" for c in range(u.DEEPEST, 0, -1))
    return rf"""WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
),
lab AS (
  SELECT page_id, bool_or(quality = 0) AS bad FROM (
    SELECT page_id, CAST(nullif(regexp_extract(path, '/([0-9]{{1,18}})([^0-9]|$)', 1), '') AS BIGINT) AS doc_id FROM p
  ) JOIN labels USING (doc_id) GROUP BY page_id
),
s AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS s FROM p),
seen AS (SELECT host, unnest(range(1, len(s) + 1)) AS depth, unnest(s) AS v FROM s),
vary AS (
  SELECT host, depth FROM seen WHERE NOT regexp_matches(v, '{variable}') GROUP BY host, depth
  HAVING count(DISTINCT v) > {u.MANY} AND 2 * count(DISTINCT v) > count(*)
),
hv AS (SELECT host, list(depth) AS dv FROM vary GROUP BY host),
w AS (
  SELECT s.page_id, s.host, s.path, list_transform(s.s, lambda x, i: CASE WHEN regexp_matches(x, '{variable}') OR coalesce(list_contains(dv, i), false) THEN '*' ELSE x END) AS w
  FROM s LEFT JOIN hv USING (host)
),
x AS (SELECT *, coalesce(list_filter(list_transform(w, lambda y, j: CASE WHEN y <> '*' THEN j END), lambda j: j IS NOT NULL)[{u.DEEPEST + 1}], len(w) + 1) AS cut FROM w),
t AS (SELECT page_id, host, path, '/' || array_to_string(list_transform(w, lambda y, j: CASE WHEN j >= cut THEN '*' ELSE y END), '/') AS template FROM x),
leaf AS (
  SELECT host, template, count(bad) AS n, coalesce(sum(CAST(bad AS INTEGER)), 0) AS b FROM t LEFT JOIN lab USING (page_id) GROUP BY host, template
),
good AS (SELECT 1 - sum(b) / sum(n) AS g FROM leaf),
cur{u.DEEPEST} AS (SELECT *, template AS branch FROM leaf),
{levels}
v AS (
  SELECT host, template, branch, (sum(n) OVER w - sum(b) OVER w + {u.PRIOR} * g) / (sum(n) OVER w + {u.PRIOR}) AS purity
  FROM cur0 CROSS JOIN good WINDOW w AS (PARTITION BY host, branch)
)
SELECT page_id, host, path, {rule} AS rule, coalesce({fixed}, CASE WHEN purity < {u.PURITY} THEN 'block' ELSE 'allow' END) AS verdict,
  template, branch, round(purity, 9) AS purity
FROM t JOIN v USING (host, template)"""


def repeated_bytes() -> str:
    w = suffix_dedup.WINDOW
    return f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, {2 * w})) AS m FROM (SELECT doc_id, x, unnest(range(0, greatest(n - {w - 1}, 0))) AS i FROM d)),
hit AS (SELECT doc_id, i FROM w JOIN (SELECT m FROM w GROUP BY m HAVING count(*) > 1) USING (m)),
island AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {w} THEN 0 ELSE 1 END AS new FROM hit)),
span AS (SELECT doc_id, min(i) AS s, max(i) + {w} AS e FROM island GROUP BY doc_id, k),
stop AS (SELECT doc_id, s, e FROM span UNION ALL SELECT doc_id, n, n FROM d),
piece AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s, e), 0) AS f FROM stop)
SELECT doc_id, n AS n_bytes, CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) - 1 AS n_spans,
  sha256(unhex(string_agg(substr(x, 2 * f + 1, 2 * (s - f)), '' ORDER BY s, e))) AS kept_sha256
FROM piece JOIN d USING (doc_id) GROUP BY doc_id, n"""


def leaks() -> str:
    """Shingles as strings; a pair is a document and an item that it holds three quarters of."""
    return rf"""WITH w AS (
  SELECT 0 AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
  UNION ALL SELECT 1, item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') FROM benchmark
),
g AS (SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
n AS (SELECT id AS item_id, count(*) AS n_item FROM g WHERE kind = 1 GROUP BY id),
p AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM g d JOIN g i ON d.kind = 0 AND i.kind = 1 AND d.g = i.g GROUP BY d.id, i.id)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM p JOIN n USING (item_id) WHERE n_shared >= {decontaminate.CONTAINMENT} * n_item"""
