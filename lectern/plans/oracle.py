"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently from the Spark code: plain SQL over the same tables,
with the same output column names and types.
"""

from __future__ import annotations

from lectern.functions.core import SENTINEL
from lectern.operators.report import MERGE_PROMPT, NARRATIVE_PROMPT, REPORT_TITLE
from lectern.plans.extract import BASIC_PROMPT, DETAIL_PROMPT, SUMMARY_PROMPT

S = "'" + SENTINEL + "'"
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_CHUNKS = """
c AS (
  SELECT doc_id, lang, text, unnest(range(0, CAST(ceil(length(text) / 15000.0) AS BIGINT))) AS i
  FROM documents WHERE text IS NOT NULL AND text <> ''
),
cc AS (SELECT doc_id, lang, i, substring(text, CAST(i * 15000 + 1 AS BIGINT), 15000) AS chunk FROM c)
"""

_ASSEMBLE = f"""
SELECT conv_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5
FROM (SELECT conv_id, trim(string_agg(coalesce(text, ''), '' ORDER BY turn), {WS}) AS t
      FROM conversations GROUP BY conv_id)
"""

_RESPONSES = """
r AS (
  SELECT event_id,
    CASE event_type
      WHEN 'click' THEN 'Sure! Here is the JSON:' || chr(10) || props || chr(10) || 'Hope this helps.'
      WHEN 'view' THEN '```json' || chr(10) || props || chr(10) || '```'
      WHEN 'signup' THEN props || ' trailing }'
      WHEN 'purchase' THEN replace(props, '"', '''')
      ELSE 'no structured answer' END AS response
  FROM events
),
env AS (
  SELECT event_id, regexp_replace(regexp_replace(response, '^[^{]*', ''), '[^}]*$', '') AS env FROM r
),
ok AS (
  SELECT event_id, env,
    CASE WHEN coalesce(json_valid(env), false) THEN json_type(env) = 'OBJECT' ELSE false END AS valid
  FROM env
)
"""

_EMB = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"

_CENTROIDS = """
dd AS (SELECT label, unnest(range(0, len(v))) AS dim, unnest(v) AS x FROM {src}),
cm AS (SELECT label, dim, avg(x) AS m FROM dd GROUP BY label, dim),
c AS (SELECT label, list(m ORDER BY dim) AS cv FROM cm GROUP BY label)
"""

_COS = "list_dot_product({a}, {b}) / (greatest(sqrt(list_dot_product({a}, {a})), 1e-8) * greatest(sqrt(list_dot_product({b}, {b})), 1e-8))"

_PAPERS = f"""
{_EMB},
p AS (
  SELECT d.doc_id, e.label, e.v, d.source, d.lang, split_part(d.text, chr(10), 1) AS title,
    CAST(CAST(1990 + least(floor(d.n_chars / 1000.0), 35) AS BIGINT) AS VARCHAR) AS year
  FROM documents d JOIN e ON e.vec_id = d.doc_id % (SELECT count(*) FROM embeddings)
),
{_CENTROIDS.format(src='p')},
s AS (SELECT p.doc_id, p.label, p.title, {_COS.format(a='p.v', b='c.cv')} AS sim FROM p JOIN c USING (label)),
rr AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, doc_id) AS rk FROM s),
t AS (SELECT label, string_agg(coalesce(title, {S}), ', ' ORDER BY rk) AS titles FROM rr WHERE rk <= 3 GROUP BY label),
m AS (
  SELECT label, string_agg(source, ', ' ORDER BY source) AS methods
  FROM (SELECT DISTINCT label, source FROM p WHERE source IS NOT NULL AND source <> '' AND source <> {S})
  GROUP BY label
),
z AS (SELECT label, count(*) AS size FROM p GROUP BY label),
descr AS (
  SELECT z.label, z.size,
    'Cluster with ' || CAST(z.size AS VARCHAR) || ' papers focusing on ' || coalesce(m.methods, '')
      || '. Key papers: ' || coalesce(t.titles, '') AS description
  FROM z LEFT JOIN m USING (label) LEFT JOIN t USING (label)
)
"""

_PROMPT_PREFIX = _lit(BASIC_PROMPT.split("{}")[0])
_DETAIL_PREFIX = _lit(DETAIL_PROMPT.split("{}")[0])


SQL: dict[str, str] = {
    "chunk_stats": f"""WITH {_CHUNKS}
SELECT lang, count(*) AS n_chunks, count(DISTINCT doc_id) AS n_docs,
       CAST(sum(length(chunk)) AS BIGINT) AS n_chars, CAST(max(i) AS INTEGER) AS max_chunk_idx
FROM cc GROUP BY lang""",
    "drop_empty": "SELECT doc_id, lang, n_chars FROM documents WHERE text IS NOT NULL AND text <> ''",
    "chunk_text": f"""WITH {_CHUNKS}
SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx, CAST(length(chunk) AS INTEGER) AS chunk_len, md5(chunk) AS chunk_md5
FROM cc""",
    "assemble_pages": _ASSEMBLE,
    "incremental_ingest": _ASSEMBLE,
    "head_slice": """SELECT doc_id, CAST(length(substring(text, 1, 5000)) AS INTEGER) AS head_len,
       md5(substring(text, 1, 5000)) AS head_md5 FROM documents""",
    "build_prompt": f"""SELECT doc_id, CAST(length(pr) AS INTEGER) AS prompt_len, md5(pr) AS prompt_md5
FROM (SELECT doc_id, {_PROMPT_PREFIX} || coalesce(substring(text, 1, 5000), '') AS pr FROM documents)""",
    "fill_sentinel": f"""SELECT d.doc_id,
  CASE WHEN l.quality IS NULL THEN {S} ELSE CAST(l.quality AS VARCHAR) END AS quality,
  CASE WHEN l.toxic IS NULL THEN {S} ELSE CAST(l.toxic AS VARCHAR) END AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "cluster_slice": "SELECT vec_id, label FROM embeddings WHERE label = 3",
    "csv_roundtrip": "SELECT * FROM part",
    "json_envelope": """SELECT page_id, CAST(length(e) AS INTEGER) AS env_len, md5(e) AS env_md5
FROM (SELECT page_id, regexp_replace(regexp_replace(html, '^[^{]*', ''), '[^}]*$', '') AS e FROM pages)""",
    "json_parse": f"""WITH {_RESPONSES}
SELECT event_id, valid, CASE WHEN valid THEN json_extract_string(env, '$.k') END AS k FROM ok""",
    "extraction_status": f"""WITH {_RESPONSES}
SELECT event_id, CASE WHEN valid THEN 'success' ELSE 'error' END AS extraction_status,
       CASE WHEN valid THEN NULL ELSE 'malformed response' END AS error_message FROM ok""",
    "merge_fields": f"""WITH pc AS (
  SELECT conv_id, turn, role, rtrim(text, '; ') AS piece FROM conversations
  WHERE text IS NOT NULL AND text <> '' AND text <> {S}
),
q AS (
  SELECT conv_id, role, ltrim(string_agg(piece, '; ' ORDER BY turn), '; ') AS merged
  FROM pc WHERE piece <> '' GROUP BY conv_id, role
),
w AS (
  SELECT conv_id,
    max(CASE WHEN role = 'user' THEN merged END) AS u,
    max(CASE WHEN role = 'assistant' THEN merged END) AS a,
    max(CASE WHEN role = 'system' THEN merged END) AS s
  FROM q GROUP BY conv_id
)
SELECT conv_id, md5(u) AS user_md5, md5(a) AS assistant_md5, md5(s) AS system_md5,
  CAST(length(u) AS INTEGER) AS user_len, CAST(length(a) AS INTEGER) AS assistant_len,
  CAST(length(s) AS INTEGER) AS system_len
FROM w""",
    "feature_text": f"""SELECT p_partkey,
  array_to_string(list_filter([p_name, p_brand, p_type, CAST(p_size AS VARCHAR)],
    lambda x: x IS NOT NULL AND x <> '' AND x <> {S}), ' ') AS feature_text
FROM part""",
    "format_citation": f"""WITH cu AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 2000) AS INTEGER) AS bucket FROM customer
),
g AS (
  SELECT c_nationkey, c_mktsegment, bucket, string_agg(c_name, ', ' ORDER BY c_custkey) AS authors
  FROM cu GROUP BY c_nationkey, c_mktsegment, bucket
),
a AS (
  SELECT g.*, n.n_name, string_split(g.authors, ',') AS parts
  FROM g JOIN nation n ON n.n_nationkey = g.c_nationkey
)
SELECT c_nationkey AS nationkey, c_mktsegment AS segment, bucket,
  array_to_string(list_transform(parts[1:3], lambda x: trim(x, {WS})), ', ')
  || CASE WHEN len(parts) > 3 THEN ' et al.' ELSE '' END
  || ', "' || trim(n_name || ' ' || c_mktsegment, {WS}) || '", in Proc. Meta-Learning Conf., '
  || CAST(bucket + 2000 AS VARCHAR) || '.' AS citation
FROM a""",
    "lead_summary": """SELECT doc_id, CAST(length(s) AS INTEGER) AS summary_len, md5(s) AS summary_md5
FROM (SELECT doc_id,
  array_to_string(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))[1:3], ' ') AS s
  FROM documents)""",
    "infer_stub": f"""WITH {_CHUNKS},
p AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx, {_DETAIL_PREFIX} || chunk AS prompt FROM cc)
SELECT doc_id, chunk_idx,
  CASE WHEN length(prompt) % 11 = 0 THEN NULL
       ELSE 'Answer: {{"n": ' || CAST(length(prompt) AS VARCHAR) || ', "w": "'
            || replace(replace(split_part(prompt, ' ', 1), '\\', ''), '"', '') || '"}} Thanks.' END AS response,
  CASE WHEN length(prompt) % 11 = 0 THEN 'RuntimeError: model unavailable' END AS error
FROM p""",
    "masked_mean_pool": """WITH e AS (
  SELECT label, CASE WHEN embedding[1] > 0 THEN 1.0 ELSE 0.0 END AS mk, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
x AS (SELECT label, mk, unnest(v) AS val, unnest(range(0, len(v))) AS dim FROM e)
SELECT label, CAST(dim AS INTEGER) AS dim, round(sum(val * mk) / greatest(sum(mk), 1e-9), 6) AS value
FROM x GROUP BY label, dim""",
    "centroids": f"""WITH {_EMB},
x AS (SELECT label, unnest(v) AS val, unnest(range(0, len(v))) AS dim FROM e)
SELECT label, CAST(dim AS INTEGER) AS dim, round(avg(val), 6) AS value FROM x GROUP BY label, dim""",
    "l2_normalize": """WITH e AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * (vec_id + 1)) AS v FROM embeddings
),
n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS nv FROM e)
SELECT vec_id, round(nv, 6) AS norm_in, round(list_sum(v) / greatest(nv, 1e-12), 6) AS comp_sum,
  round(nv / greatest(nv, 1e-12), 6) AS norm_out
FROM n""",
    "cluster_size": "SELECT label, count(*) AS size FROM embeddings GROUP BY label",
    "representatives": f"""WITH {_EMB},
{_CENTROIDS.format(src='e')},
s AS (SELECT e.vec_id, e.label, {_COS.format(a='e.v', b='c.cv')} AS sim FROM e JOIN c USING (label)),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id) AS rk FROM s)
SELECT label, vec_id, CAST(rk AS INTEGER) AS rank, round(sim, 6) AS sim FROM r WHERE rk <= 3""",
    "assign_nearest": f"""WITH {_EMB},
{_CENTROIDS.format(src='e')}
SELECT e.vec_id, arg_min(c.label, list_distance(e.v, c.cv)) AS cluster FROM e, c GROUP BY e.vec_id""",
    "cosine_pairs": f"""WITH {_EMB},
s AS (SELECT a.vec_id AS i, b.vec_id AS j, {_COS.format(a='a.v', b='b.v')} AS sim FROM e a JOIN e b ON a.vec_id < b.vec_id)
SELECT i, j, round(sim, 6) AS sim FROM s WHERE sim >= 0.35""",
    "top_neighbors": f"""WITH {_EMB},
s AS (SELECT a.vec_id, b.vec_id AS neighbor, {_COS.format(a='a.v', b='b.v')} AS sim FROM e a JOIN e b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, neighbor) AS rk FROM s)
SELECT vec_id, neighbor, CAST(rk AS INTEGER) AS rank, round(sim, 6) AS sim FROM r WHERE rk <= 3""",
    "top_values": """WITH v AS (
  SELECT o_orderstatus, o_orderpriority AS value, count(*) AS cnt FROM orders
  WHERE o_orderpriority IS NOT NULL GROUP BY o_orderstatus, o_orderpriority
),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY cnt DESC, value) AS rk FROM v)
SELECT o_orderstatus, CAST(rk AS INTEGER) AS rank, value, cnt FROM r WHERE rk <= 3""",
    "year_histogram": """SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS cnt
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY o_orderstatus, year(o_orderdate)""",
    "cluster_description": f"WITH {_PAPERS} SELECT label, size, description FROM descr",
    "attach_description": f"""WITH {_PAPERS}
SELECT p.doc_id, p.label, md5(descr.description) AS description_md5 FROM p LEFT JOIN descr USING (label)""",
    "group_records": f"""WITH {_PAPERS},
q AS (SELECT label, doc_id, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS k FROM p),
g AS (
  SELECT label, CAST((k - 1) // 20 AS INTEGER) AS batch, count(*) AS n_records,
    string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS record_ids
  FROM q GROUP BY label, (k - 1) // 20
)
SELECT g.label, g.batch, z.size, g.n_records, g.record_ids FROM g JOIN z USING (label)""",
    "number_references": f"""WITH c AS (
  SELECT doc_id, CASE WHEN lang <> 'en' THEN 'Document ' || CAST(doc_id AS VARCHAR) || ' (' || source || ')' END AS citation
  FROM documents
),
v AS (SELECT doc_id, citation FROM c WHERE citation IS NOT NULL AND citation <> '' AND citation <> {S})
SELECT CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS ref_no, doc_id,
  '[' || CAST(row_number() OVER (ORDER BY doc_id) AS VARCHAR) || '] ' || citation AS reference
FROM v""",
    "report_sections": f"""WITH {_PAPERS},
f AS (SELECT label, min(doc_id) AS first FROM p GROUP BY label),
sec AS (
  SELECT 0 AS g, CAST(0 AS BIGINT) AS o, 'introduction' AS section_id, 'Introduction' AS title
  UNION ALL SELECT 2, CAST(0 AS BIGINT), 'conclusion', 'Conclusion'
  UNION ALL SELECT 1, first, 'cluster_' || CAST(label AS VARCHAR), 'Cluster ' || CAST(label AS VARCHAR) FROM f
)
SELECT CAST(row_number() OVER (ORDER BY g, o) - 1 AS INTEGER) AS section_order, section_id, title FROM sec""",
    "cluster_profile": f"""WITH {_PAPERS},
reps AS (SELECT label, string_agg(title, ' | ' ORDER BY rk) AS representative_papers FROM rr WHERE rk <= 3 GROUP BY label),
vm AS (
  SELECT label, source AS value, count(*) AS cnt,
    row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, source) AS k
  FROM p WHERE source IS NOT NULL GROUP BY label, source
),
vd AS (
  SELECT label, lang AS value, count(*) AS cnt,
    row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, lang) AS k
  FROM p WHERE lang IS NOT NULL GROUP BY label, lang
),
vy AS (SELECT label, year AS value, count(*) AS cnt FROM p WHERE year IS NOT NULL GROUP BY label, year),
fm AS (SELECT label, string_agg(value || '=' || CAST(cnt AS VARCHAR), ', ' ORDER BY k) AS common_methods FROM vm WHERE k <= 3 GROUP BY label),
fd AS (SELECT label, string_agg(value || '=' || CAST(cnt AS VARCHAR), ', ' ORDER BY k) AS common_datasets FROM vd WHERE k <= 3 GROUP BY label),
fy AS (SELECT label, string_agg(value || '=' || CAST(cnt AS VARCHAR), ', ' ORDER BY value) AS publication_years FROM vy GROUP BY label)
SELECT descr.label, descr.description, descr.size, reps.representative_papers, fm.common_methods,
  fd.common_datasets, fy.publication_years
FROM descr LEFT JOIN reps USING (label) LEFT JOIN fm USING (label) LEFT JOIN fd USING (label) LEFT JOIN fy USING (label)""",
    "cluster_profile_json": f"""WITH {_PAPERS},
rp AS (SELECT label, list(title ORDER BY rk) AS lst FROM rr WHERE rk <= 3 GROUP BY label),
vm AS (
  SELECT label, source AS value, count(*) AS cnt,
    row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, source) AS k
  FROM p WHERE source IS NOT NULL GROUP BY label, source
),
vd AS (
  SELECT label, lang AS value, count(*) AS cnt,
    row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, lang) AS k
  FROM p WHERE lang IS NOT NULL GROUP BY label, lang
),
vy AS (SELECT label, year AS value, count(*) AS cnt FROM p WHERE year IS NOT NULL GROUP BY label, year),
fm AS (SELECT label, map(list(value ORDER BY k), list(cnt ORDER BY k)) AS m FROM vm WHERE k <= 3 GROUP BY label),
fd AS (SELECT label, map(list(value ORDER BY k), list(cnt ORDER BY k)) AS m FROM vd WHERE k <= 3 GROUP BY label),
fy AS (SELECT label, map(list(value ORDER BY value), list(cnt ORDER BY value)) AS m FROM vy GROUP BY label)
SELECT descr.label, CAST(to_json(struct_pack(
  description := descr.description, size := descr.size, representative_papers := rp.lst,
  common_methods := fm.m, common_datasets := fd.m, publication_years := fy.m)) AS VARCHAR) AS analysis
FROM descr LEFT JOIN rp USING (label) LEFT JOIN fm USING (label) LEFT JOIN fd USING (label) LEFT JOIN fy USING (label)""",
    "embed_tfidf": """WITH t AS (
  SELECT doc_id, len(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{M}\\p{N}\\p{Pc}]+'), lambda x: length(x) >= 1)) AS n
  FROM documents
)
SELECT doc_id, CAST(n AS BIGINT) AS n_terms, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END AS norm FROM t""",
}


def _echo(prompt: str, label: str) -> str:
    """SQL for the offline echo model's text (or the section's error text)."""
    return f"""CASE WHEN length({prompt}) % 11 = 0
    THEN 'Error analyzing cluster Cluster ' || CAST({label} AS VARCHAR) || ': API error - RuntimeError: model unavailable'
    ELSE 'Answer: {{"n": ' || CAST(length({prompt}) AS VARCHAR) || ', "w": "'
      || replace(replace(split_part({prompt}, ' ', 1), '\\', ''), '"', '') || '"}} Thanks.' END"""


def _batch_ctes(src: str, rows: int, max_bytes: int) -> list[str]:
    """Batches of ``src`` (label, ord, js) bounded in rows and bytes, by window sums: bb (label, b, ord, js)."""
    half = (max_bytes - 1) // 2
    return [f"b1 AS (SELECT label, ord, js, octet_length(encode(js)) + 1 AS bytes FROM {src})", f"""b2 AS (
  SELECT *, bytes > {half} AS alone, coalesce(sum(CASE WHEN bytes > {half} THEN 0 ELSE bytes END) OVER w, 0) AS before,
    coalesce(sum(CASE WHEN bytes > {half} THEN 1 ELSE 0 END) OVER w, 0) AS longs, count(*) OVER w AS n_before
  FROM b1 WINDOW w AS (PARTITION BY label ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)""", f"""b3 AS (
  SELECT *, CASE WHEN alone THEN 0 ELSE CAST(before AS BIGINT) // {half} END AS cell, CASE WHEN alone THEN 0 ELSE n_before // {rows} END AS run FROM b2
)""", """b4 AS (
  SELECT label, longs, alone, cell, run, row_number() OVER (PARTITION BY label ORDER BY min(n_before)) - 1 AS b
  FROM b3 GROUP BY label, longs, alone, cell, run
)""", "bb AS (SELECT b3.label, b4.b, b3.ord, b3.js FROM b3 JOIN b4 USING (label, longs, alone, cell, run))"]


def _narrative_sql(batch: int, fan_in: int) -> str:
    ctes = [_PAPERS, """q AS (SELECT label, doc_id, title, source,
  row_number() OVER (PARTITION BY label ORDER BY doc_id) AS k FROM p)""", f"""batched AS (
  SELECT label, CAST((k - 1) // {batch} AS BIGINT) AS b,
    CAST(to_json(list(struct_pack(doc_id := doc_id, title := title, source := source) ORDER BY doc_id)) AS VARCHAR) AS js
  FROM q GROUP BY label, (k - 1) // {batch}
)"""]
    tree, out = _tree_ctes("batched", fan_in)
    return "WITH " + ",\n".join(ctes + tree) + "\n" + out


def _tree_ctes(batches: str, fan_in: int, levels: int = 8) -> tuple[list[str], str]:
    """The narrative tree over ``batches`` (label, b, js: a list of records), unrolled to ``levels`` combining levels
    (enough for fan_in ** levels batches per cluster); levels past the deepest cluster are empty.  Level 0: one answer per
    batch; level i + 1: one answer per ``fan_in`` consecutive answers, a lone answer passed on."""
    head, tail = NARRATIVE_PROMPT.split("{}")[0], NARRATIVE_PROMPT.split("{}")[1]
    m_head, m_tail = MERGE_PROMPT.split("{}")[0], MERGE_PROMPT.split("{}")[1]
    ctes = [f"g0 AS (SELECT label, b, {_lit(head)} || 'Cluster ' || CAST(label AS VARCHAR) || {_lit(tail)} || js AS prompt FROM {batches})",
            f"l0 AS (SELECT label, b, {_echo('prompt', 'label')} AS body FROM g0)"]
    finals = []
    for i in range(levels):
        ctes.append(f"m{i} AS (SELECT label, max(b) AS mb FROM l{i} GROUP BY label)")
        ctes.append(f"f{i} AS (SELECT l.label, l.body FROM l{i} l JOIN m{i} USING (label) WHERE m{i}.mb = 0)")
        ctes.append(f"""g{i + 1} AS (
  SELECT l.label, l.b // {fan_in} AS b, list(l.body ORDER BY l.b) AS parts
  FROM l{i} l JOIN m{i} USING (label) WHERE m{i}.mb > 0 GROUP BY l.label, l.b // {fan_in}
)""")
        mp = (f"({_lit(m_head)} || 'Cluster ' || CAST(label AS VARCHAR) || {_lit(m_tail)}"
              f" || CAST(to_json(parts) AS VARCHAR))")
        ctes.append(f"""l{i + 1} AS (
  SELECT label, b, CASE WHEN len(parts) = 1 THEN parts[1] ELSE {_echo(mp, 'label')} END AS body FROM g{i + 1}
)""")
        finals.append(f"SELECT label, body FROM f{i}")
    return ctes, "\nUNION ALL ".join(finals)


SQL["cluster_narrative"] = _narrative_sql(20, 4)


# Python's str.split() separators (ASCII and Unicode white space), as an RE2 class.
_PY_WS = r"'[ \t\n\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'"
_DETAIL = ["method", "features_chosen", "selection_method", "algorithms", "metrics", "datasets", "performance",
           "contributions", "feature_generation", "limitations"]


def _extract_sql() -> str:
    """Records extracted by the offline record model, from the documents.

    Head request: title = first five words, authors = the next (words % 6)
    words, year = 1990 + words % 35.  Chunk request: method = first word,
    datasets = words 2-3, limitations = last word; merged over chunks in
    order.  Summary: the length of the summary request.  A request whose
    length is divisible by 13 fails (chunk: skipped; summary: an error and no
  citation; head: an error and no further request).
    """
    json_parts = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || CAST(to_json({c}) AS VARCHAR) END"
        for c in ["title", "authors", "year", *_DETAIL]
    )
    merged = ",\n    ".join(
        f"max(CASE WHEN field = '{c}' THEN merged END) AS {c}" for c in _DETAIL
    )
    return f"""WITH d AS (
  SELECT CAST(doc_id AS VARCHAR) AS filename, text FROM documents WHERE text IS NOT NULL AND text <> ''
),
hp AS (SELECT filename, {_PROMPT_PREFIX} || substring(text, 1, 5000) AS prompt FROM d),
hw AS (
  SELECT filename, length(prompt) % 13 = 0 AS failed,
    list_filter(regexp_split_to_array(substring(prompt, {len(BASIC_PROMPT.split("{}")[0]) + 1}), {_PY_WS}), lambda w: w <> '') AS words
  FROM hp
),
basic AS (
  SELECT filename,
    CASE WHEN NOT failed THEN nullif(array_to_string(words[1:5], ' '), '') END AS title,
    CASE WHEN NOT failed THEN nullif(array_to_string(words[6:5 + len(words) % 6], ', '), '') END AS authors,
    CASE WHEN NOT failed THEN CAST(1990 + len(words) % 35 AS VARCHAR) END AS year,
    CASE WHEN failed THEN 'RuntimeError: model unavailable' END AS basic_error
  FROM hw
),
c AS (SELECT filename, text, unnest(range(0, CAST(ceil(length(text) / 15000.0) AS BIGINT))) AS i
  FROM d JOIN hw USING (filename) WHERE NOT failed),
cp AS (SELECT filename, i, {_DETAIL_PREFIX} || substring(text, CAST(i * 15000 + 1 AS BIGINT), 15000) AS prompt FROM c),
cw AS (
  SELECT filename, i,
    list_filter(regexp_split_to_array(substring(prompt, {len(DETAIL_PROMPT.split("{}")[0]) + 1}), {_PY_WS}), lambda w: w <> '') AS words
  FROM cp WHERE length(prompt) % 13 <> 0
),
fv AS (
  SELECT filename, i, 'method' AS field, words[1] AS v FROM cw WHERE len(words) > 0
  UNION ALL SELECT filename, i, 'datasets', array_to_string(words[2:3], ', ') FROM cw
  UNION ALL SELECT filename, i, 'limitations', words[-1] FROM cw WHERE len(words) > 0
),
pc AS (
  SELECT filename, i, field, rtrim(v, '; ') AS piece FROM fv
  WHERE v IS NOT NULL AND v <> '' AND v <> {S}
),
mf AS (
  SELECT filename, field, ltrim(string_agg(piece, '; ' ORDER BY i), '; ') AS merged
  FROM pc WHERE piece <> '' GROUP BY filename, field
),
mw AS (SELECT filename,
    {merged}
  FROM mf GROUP BY filename),
rec AS (SELECT * FROM basic LEFT JOIN mw USING (filename)),
sp AS (
  SELECT *, {_lit(SUMMARY_PROMPT.split("{}")[0])} || '{{' || array_to_string(list_filter([{json_parts}], lambda x: x IS NOT NULL), ',') || '}}' AS sprompt
  FROM rec
),
sm AS (
  SELECT *,
    CASE WHEN basic_error IS NULL AND length(sprompt) % 13 <> 0 THEN 'Summary of a record with ' || CAST(length(sprompt) AS VARCHAR) || ' characters.' END AS summary,
    CASE WHEN basic_error IS NULL AND length(sprompt) % 13 = 0 THEN 'RuntimeError: model unavailable' END AS summary_error,
    string_split(authors, ',') AS parts
  FROM sp
),
out AS (
  SELECT filename, title, authors, year, {", ".join(_DETAIL)}, summary,
    CASE WHEN basic_error IS NULL AND summary_error IS NULL AND title IS NOT NULL AND title <> '' AND title <> {S} AND authors IS NOT NULL AND authors <> ''
           AND authors <> {S} AND year IS NOT NULL AND year <> '' AND year <> {S}
      THEN array_to_string(list_transform(parts[1:3], lambda x: trim(x, {WS})), ', ')
        || CASE WHEN len(parts) > 3 THEN ' et al.' ELSE '' END
        || ', "' || trim(title, {WS}) || '", in Proc. Meta-Learning Conf., ' || year || '.' END AS citation,
    coalesce(basic_error, summary_error) AS error_message
  FROM sm
)
SELECT *, CASE WHEN error_message IS NULL THEN 'success' ELSE 'error' END AS extraction_status FROM out"""


SQL["extract_records"] = _extract_sql()



SQL["tfidf_weights"] = """WITH t AS (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{M}\\p{N}\\p{Pc}]+'), lambda x: x <> '')) AS term
  FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
w AS (
  SELECT doc_id, tf, tf * ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) OVER (PARTITION BY term) + 1.0)) AS w FROM tf
),
n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm, count(*) AS n_terms, sum(tf) AS n_tokens, sum(w) AS s, max(w) AS m FROM w GROUP BY doc_id)
SELECT doc_id, n_terms, CAST(n_tokens AS BIGINT) AS n_tokens, round(CASE WHEN norm > 0 THEN s / norm ELSE 0.0 END, 6) AS sum_weight,
  round(CASE WHEN norm > 0 THEN m / norm ELSE 0.0 END, 6) AS max_weight FROM n"""


def _kmeans_sql(k: int, rounds: int) -> str:
    """k-means from the vectors of the k smallest ids, unrolled; ties go to the smaller centre, empty centres stay."""
    ctes = [_EMB, f"c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cid, v AS cv FROM e ORDER BY vec_id LIMIT {k})"]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS (
  SELECT vec_id, arg_min(cid, (d, cid)) AS cid FROM (
    SELECT e.vec_id, c.cid, list_sum(list_transform(list_zip(e.v, c.cv), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM e CROSS JOIN c{i} c
  ) GROUP BY vec_id
)""")
        if i < rounds:
            ctes.append(f"x{i} AS (SELECT a.cid, unnest(range(0, len(e.v))) AS dim, unnest(e.v) AS x FROM a{i} a JOIN e USING (vec_id))")
            ctes.append(f"m{i} AS (SELECT cid, dim, avg(x) AS m FROM x{i} GROUP BY cid, dim)")
            ctes.append(f"n{i} AS (SELECT cid, list(m ORDER BY dim) AS nv FROM m{i} GROUP BY cid)")
            ctes.append(f"c{i + 1} AS (SELECT c.cid, coalesce(n.nv, c.cv) AS cv FROM c{i} c LEFT JOIN n{i} n USING (cid))")
    ctes.append(f"lab AS (SELECT cid, CAST(row_number() OVER (ORDER BY min(vec_id)) - 1 AS INTEGER) AS cluster FROM a{rounds} GROUP BY cid)")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT vec_id, cluster FROM a{rounds} JOIN lab USING (cid)"


SQL["kmeans_fixed_start"] = _kmeans_sql(5, 3)

SQL["stream_profile"] = f"""WITH top AS ({SQL['top_values']}), years AS ({SQL['year_histogram']})
SELECT o_orderstatus AS cluster, 'o_orderpriority' AS field, value, cnt FROM top
UNION ALL SELECT o_orderstatus, 'year', CAST(year AS VARCHAR), cnt FROM years
UNION ALL SELECT o_orderstatus, 'size', '', count(*) FROM orders GROUP BY o_orderstatus"""

SQL["decode_pages"] = """SELECT count(*) AS n_pages, CAST(sum(length(coalesce(html, ''))) AS BIGINT) AS n_chars, count(DISTINCT coalesce(html, '')) AS n_distinct,
  CAST(max(length(coalesce(html, ''))) AS INTEGER) AS longest FROM pages"""

SQL["durable_answers"] = SQL["infer_stub"]

SQL["csv_multiline"] = """SELECT doc_id, lang, n_chars, CAST(length(text) AS INTEGER) AS n, md5(text) AS text_md5 FROM documents"""

_PAPER_JSON = "CAST(to_json(struct_pack(doc_id := doc_id, title := title, source := source)) AS VARCHAR)"

SQL["byte_batches"] = "WITH " + ",\n".join([
    _PAPERS, f"src AS (SELECT label, doc_id AS ord, {_PAPER_JSON} AS js FROM p)", *_batch_ctes("src", 20, 3000)]) + """
SELECT bb.label, CAST(bb.b AS INTEGER) AS batch, z.size, count(*) AS n_records, CAST(sum(octet_length(encode(js)) + 1) + 1 AS BIGINT) AS n_bytes,
  string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) AS record_ids
FROM bb JOIN z USING (label) GROUP BY bb.label, bb.b, z.size"""


def _tfidf_ctes(docs: str, key: str) -> list[str]:
    """Exact TF-IDF rows w (key, term, x) of ``docs`` (key, t)."""
    return [f"""t AS (
  SELECT {key}, unnest(list_filter(regexp_split_to_array(lower(coalesce(t, '')), '[^\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Pc}}]+'), lambda x: x <> '')) AS term FROM {docs}
)""", f"tf AS (SELECT {key}, term, count(*) AS tf FROM t GROUP BY {key}, term)", f"""raw AS (
  SELECT {key}, term, tf * ln(((SELECT count(*) FROM {docs}) + 1.0) / (count(*) OVER (PARTITION BY term) + 1.0)) AS x FROM tf
)""", f"nrm AS (SELECT {key}, sqrt(sum(x * x)) AS nrm FROM raw GROUP BY {key})",
            f"w AS (SELECT {key}, term, CASE WHEN nrm > 0 THEN x / nrm ELSE 0.0 END AS x FROM raw JOIN nrm USING ({key}))"]


def _centroid_ctes(i: int, labels: str, key: str) -> list[str]:
    return [f"s{i} AS (SELECT cid, count(*) AS n FROM {labels} GROUP BY cid)",
            f"c{i} AS (SELECT cid, term, sum(x) / any_value(n) AS c FROM w JOIN {labels} USING ({key}) JOIN s{i} USING (cid) GROUP BY cid, term)"]


def _nearest_cte(i: int, docs: str, key: str) -> str:
    """a_i (key, cid): the nearest of the centres c_i, ties to the smaller."""
    return f"""a{i} AS (
  SELECT {key}, arg_min(cid, (norm - 2 * dot, cid)) AS cid FROM (
    SELECT d.{key}, k.cid, k.norm, coalesce(p.dot, 0) AS dot FROM {docs} d CROSS JOIN (SELECT cid, sum(c * c) AS norm FROM c{i} GROUP BY cid) k
    LEFT JOIN (SELECT w.{key}, c.cid, sum(w.x * c.c) AS dot FROM w JOIN c{i} c USING (term) GROUP BY w.{key}, c.cid) p ON p.{key} = d.{key} AND p.cid = k.cid
  ) GROUP BY {key}
)"""


def _sparse_kmeans_ctes(docs: str, key: str, first: str, rounds: int) -> list[str]:
    """k-means on ``docs`` from the clusters ``first`` (key, cid), unrolled; lab (key, cluster)."""
    ctes = [*_tfidf_ctes(docs, key), *_centroid_ctes(0, first, key), _nearest_cte(0, docs, key)]
    for i in range(1, rounds + 1):
        ctes += [*_centroid_ctes(i, f"a{i - 1}", key), _nearest_cte(i, docs, key)]
    return [*ctes, f"ord AS (SELECT cid, CAST(row_number() OVER (ORDER BY min({key})) - 1 AS INTEGER) AS cluster FROM a{rounds} GROUP BY cid)",
            f"lab AS (SELECT {key}, cluster FROM a{rounds} JOIN ord USING (cid))"]


SQL["indexed_neighbors"] = SQL["top_neighbors"]

SQL["neighbor_layout"] = f"""WITH near AS ({SQL['top_neighbors'].replace('rk <= 3', 'rk <= 10')}),
edges AS (SELECT vec_id AS i, neighbor AS j FROM near UNION SELECT neighbor, vec_id FROM near)
SELECT i AS vec_id, count(*) AS degree, true AS settled FROM edges GROUP BY i"""

SQL["sparse_pairs"] = "WITH " + ",\n".join(["docs AS (SELECT doc_id, text AS t FROM documents)", *_tfidf_ctes("docs", "doc_id")]) + """
SELECT a.doc_id AS i, b.doc_id AS j, round(sum(a.x * b.x), 6) AS sim FROM w a JOIN w b ON a.term = b.term AND a.doc_id < b.doc_id
GROUP BY a.doc_id, b.doc_id HAVING sum(a.x * b.x) >= 0.9"""

_LANGUAGE = "(SELECT doc_id, dense_rank() OVER (ORDER BY lang) - 1 AS cid FROM documents)"

SQL["sparse_kmeans"] = "WITH " + ",\n".join(_sparse_kmeans_ctes("docs", "doc_id", "lang", 3)).join(
    [f"docs AS (SELECT doc_id, text AS t FROM documents), lang AS {_LANGUAGE},\n", "\nSELECT doc_id, cluster FROM lab"])

_RECORDS = f"records AS ({SQL['extract_records']})"
_FEATURES = ["title", "method", "features_chosen", "selection_method", "algorithms", "datasets", "contributions", "summary"]
_FEATURE_TEXT = "array_to_string(list_filter([" + ", ".join(_FEATURES) + f"], lambda x: x IS NOT NULL AND x <> '' AND x <> {S}), ' ')"

SQL["build_table"] = f"""WITH {_RECORDS}
SELECT extraction_status, count(*) AS n, count(nullif(title, {S})) AS n_title, count(nullif(summary, {S})) AS n_summary, count(citation) AS n_citation,
  count(*) AS n_cluster, count(*) AS n_described, CAST(0 AS BIGINT) AS n_misplaced FROM records GROUP BY extraction_status"""

SQL["cluster_analysis"] = "WITH " + ",\n".join([
    _RECORDS, f"docs AS (SELECT CAST(filename AS BIGINT) AS doc_id, year, {_FEATURE_TEXT} AS t FROM records)", f"lang AS {_LANGUAGE}",
    *_sparse_kmeans_ctes("docs", "doc_id", "lang", 3)]) + """
SELECT 'Cluster ' || CAST(cluster AS VARCHAR) AS cluster, count(*) AS size, count(*) AS n_described, count(DISTINCT year) AS n_years, count(year) AS n_dated
FROM lab JOIN docs USING (doc_id) GROUP BY cluster"""

SQL["stream_labels"] = "WITH " + ",\n".join([
    _RECORDS, f"docs AS (SELECT CAST(filename AS BIGINT) AS doc_id, filename, title, extraction_status, {_FEATURE_TEXT} AS t FROM records)", f"lang AS {_LANGUAGE}",
    *_tfidf_ctes("docs", "doc_id"), *_centroid_ctes(0, "lang", "doc_id"), _nearest_cte(0, "docs", "doc_id")]) + """
SELECT filename, title, extraction_status, CAST(cid AS INTEGER) AS cluster, 1 AS model_version FROM docs JOIN a0 USING (doc_id)"""

_REVIEW_COLS = ["title", "authors", "year", "method", "datasets", "contributions", "summary"]
_REVIEW_JSON = "'{' || array_to_string(list_filter(['\"row_id\":' || CAST(doc_id AS VARCHAR), " + ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || CAST(to_json({c}) AS VARCHAR) END" for c in _REVIEW_COLS) + "], lambda x: x IS NOT NULL), ',') || '}'"
_review_tree, _review_bodies = _tree_ctes("joined", 4)

SQL["review_report"] = "WITH " + ",\n".join([
    _RECORDS, "r AS (SELECT d.doc_id, d.lang AS label, records.* FROM records JOIN documents d ON CAST(d.doc_id AS VARCHAR) = records.filename)",
    f"src AS (SELECT label, doc_id AS ord, {_REVIEW_JSON} AS js FROM r)", *_batch_ctes("src", 20, 3000),
    "joined AS (SELECT label, CAST(b AS BIGINT) AS b, '[' || string_agg(js, ',' ORDER BY ord) || ']' AS js FROM bb GROUP BY label, b)", *_review_tree,
    f"bodies AS ({_review_bodies})",
    "refs AS (SELECT '[' || CAST(row_number() OVER (ORDER BY doc_id) AS VARCHAR) || '] ' || citation AS line FROM r WHERE citation IS NOT NULL)",
    f"""lines AS (
  SELECT '# {REPORT_TITLE}' AS line UNION ALL SELECT '## Introduction' UNION ALL SELECT 'intro' UNION ALL SELECT '## Conclusion' UNION ALL SELECT 'end'
  UNION ALL SELECT '## References' UNION ALL SELECT '## Cluster ' || label FROM bodies UNION ALL SELECT trim(body) FROM bodies UNION ALL SELECT line FROM refs
)"""]) + """
SELECT md5(line) AS line_md5, CAST(length(line) AS INTEGER) AS n FROM lines"""
