"""Registered queries over the driver's tables, one per operator.

Each query reads whole tables from ``sf_dir`` and returns a DataFrame whose
column names and types match the DuckDB SQL in :mod:`lectern.plans.oracle`.
Long texts are reported as length + md5 so results stay small while every
character is still processed.  Doubles are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.core import SENTINEL, sentinel_or, strip_ws
from lectern.functions.text import (
    clean_json_envelope, feature_text, fill_template, format_citation, head_slice, lead_sentences,
)
from lectern.functions.vectors import as_double_array, l2_normalize, norm, vec_sum
from lectern.operators import parsing, profile, references, similarity, text, vectors
from lectern.operators.clustering import kmeans
from lectern.operators.inference import EchoModel, RecordModel, infer
from lectern.operators.joins import join_small
from lectern.operators.report import narrate_clusters, review_sections
from lectern.session import cut_lineage, read_table, scratch_path, spread

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
CHUNK = 15000
SIM_THRESHOLD = 0.35
PAIR_THRESHOLD = 0.9
TOP_K = 3
LAYOUT_K = 10
REP_N = 3
KMEANS_K = 5
KMEANS_RESTARTS = 10
REVIEW_BATCH = 20
REVIEW_FAN_IN = 4
REVIEW_BYTES = 3000
FIXED_ROUNDS = 3
# Model calls of the offline models need no pause.
FREE_CALLS = {"multiplier": 0.0, "cap": 0.0, "pause": 0.0}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


# Key of each table with long text or JSON per row.
_KEYS = {"documents": "doc_id", "events": "event_id", "pages": "page_id"}


def _spread_t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table for CPU-heavy per-row work (regex, JSON, tokenising, model calls):
    spread over the task slots when the scan has fewer splits than slots
    (see ``lectern.session.spread``; a no-op on a large, well-split input)."""
    return spread(read_table(spark, sf, name), _KEYS[name])


def _len(c) -> F.Column:
    return F.length(c).cast("int")


# ------------------------------------------------------------ text / scan

def q_chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship slice: documents -> drop empty -> 15,000-char chunks -> per language."""
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "text")
    ch = text.chunk_text(docs, size=CHUNK, keep=["doc_id", "lang"])
    return ch.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.countDistinct("doc_id").alias("n_docs"),
        F.sum(F.length("chunk")).cast("long").alias("n_chars"),
        F.max("chunk_idx").cast("int").alias("max_chunk_idx"),
    )


def q_drop_empty(spark, sf):
    return text.drop_empty(_t(spark, sf, "documents")).select("doc_id", "lang", "n_chars")


def q_chunk_text(spark, sf):
    ch = text.chunk_text(_t(spark, sf, "documents"), size=CHUNK, keep=["doc_id"])
    return ch.select("doc_id", F.col("chunk_idx").cast("int").alias("chunk_idx"),
                     _len("chunk").alias("chunk_len"), F.md5("chunk").alias("chunk_md5"))


def q_assemble_pages(spark, sf):
    conv = _t(spark, sf, "conversations")
    doc = text.assemble_pages(conv, "conv_id", "turn", "text")
    return doc.select("conv_id", _len("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def q_head_slice(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", head_slice("text").alias("h"))
    return d.select("doc_id", _len("h").alias("head_len"), F.md5("h").alias("head_md5"))


def q_build_prompt(spark, sf):
    from lectern.plans.extract import BASIC_PROMPT

    d = text.build_prompt(_t(spark, sf, "documents"), BASIC_PROMPT, [head_slice("text")])
    return d.select("doc_id", _len("prompt").alias("prompt_len"), F.md5("prompt").alias("prompt_md5"))


def q_fill_sentinel(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id")
    lab = _t(spark, sf, "labels").select("doc_id", "quality", "toxic")
    j = docs.join(lab, "doc_id", "left")
    return j.select("doc_id", sentinel_or("quality").alias("quality"), sentinel_or("toxic").alias("toxic"))


def q_cluster_slice(spark, sf):
    return profile.cluster_slice(_t(spark, sf, "embeddings"), "label", 3).select("vec_id", "label")


def q_scan_documents(spark, sf):
    """The table files of ``sf`` read as document files (binary file source, not recursive)."""
    from lectern.sources.records import scan_documents

    files = scan_documents(spark, sf, "*.parquet")
    return files.select("filename", F.col("length").cast("long").alias("n_bytes"))


def q_decode_pages(spark, sf):
    """The ``pages`` table's files scanned as documents and decoded, a page per row, by an injected decoder."""
    from lectern.sources.records import decode_pages, scan_documents

    def rows_as_pages(content: bytes) -> Iterator[str]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        file = pq.ParquetFile(pa.BufferReader(content), pre_buffer=False)
        for batch in file.iter_batches(batch_size=256, columns=["html"], use_threads=False):
            for t in batch.column(0):
                yield t.as_py() or ""

    files = scan_documents(spark, f"{sf}/pages.parquet", "*.parquet")
    pages = decode_pages(files, rows_as_pages)
    return pages.agg(F.count(F.lit(1)).alias("n_pages"), F.sum(F.length("text")).cast("long").alias("n_chars"),
                     F.countDistinct("text").alias("n_distinct"), F.max(F.length("text")).cast("int").alias("longest"))


def q_csv_roundtrip(spark, sf):
    """Written with its columns in reverse order, read back by name."""
    from lectern.sources.records import read_records, write_records

    part = _t(spark, sf, "part")
    path = scratch_path(spark, "csv_roundtrip")
    write_records(part.select(*reversed(part.columns)), path)
    return read_records(spark, path, part.schema)


def q_csv_multiline(spark, sf):
    """All documents as CSV, line breaks and quotes inside the cells, read back by byte ranges."""
    from lectern.sources.records import read_records, write_records

    d = _t(spark, sf, "documents").select("doc_id", "lang", "text", "n_chars")
    path = scratch_path(spark, "csv_multiline")
    write_records(d, path)
    back = read_records(spark, path, d.schema, split=True)
    return back.select("doc_id", "lang", "n_chars", _len("text").alias("n"), F.md5("text").alias("text_md5"))


# ------------------------------------------------------------ parsing

def _responses(spark, sf) -> DataFrame:
    """Model-like answers built from events.props: prose, fences, and three malformed shapes."""
    ev = _spread_t(spark, sf, "events").select("event_id", "event_type", "props")
    resp = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("Sure! Here is the JSON:\n"), "props", F.lit("\nHope this helps.")))
        .when(F.col("event_type") == "view", F.concat(F.lit("```json\n"), "props", F.lit("\n```")))
        .when(F.col("event_type") == "signup", F.concat("props", F.lit(" trailing }")))
        .when(F.col("event_type") == "purchase", F.regexp_replace("props", '"', "'"))
        .otherwise(F.lit("no structured answer"))
    )
    return ev.select("event_id", resp.alias("response"))


def q_json_envelope(spark, sf):
    p = _spread_t(spark, sf, "pages").select("page_id", clean_json_envelope("html").alias("env"))
    return p.select("page_id", _len("env").alias("env_len"), F.md5("env").alias("env_md5"))


def q_json_parse(spark, sf):
    parsed = parsing.parse_response(_responses(spark, sf))
    return parsed.select("event_id", F.col("obj").isNotNull().alias("valid"),
                         *parsing.project_fields("obj", {"k": "k"}))


def q_extraction_status(spark, sf):
    parsed = parsing.parse_response(_responses(spark, sf))
    errs = parsed.withColumn("_err", F.when(F.col("obj").isNull(), F.lit("malformed response")))
    return parsing.capture_status(errs, ["_err"]).select("event_id", "extraction_status", "error_message")


def q_merge_fields(spark, sf):
    conv = _t(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("role").alias("field"), F.col("text").alias("value"))
    m = parsing.merge_fields(conv, "conv_id", "turn", ["user", "assistant", "system"])
    return m.select("conv_id", *[F.md5(c).alias(f"{c}_md5") for c in ["user", "assistant", "system"]],
                    *[_len(c).alias(f"{c}_len") for c in ["user", "assistant", "system"]])


def q_feature_text(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", feature_text(["p_name", "p_brand", "p_type", F.col("p_size").cast("string")]).alias("feature_text"))


def q_format_citation(spark, sf):
    cust = _t(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
        F.floor(F.col("c_acctbal") / 2000).cast("int").alias("bucket"))
    keys = ["c_nationkey", "c_mktsegment", "bucket"]
    # joined in two levels, by runs of consecutive keys, so that no group holds all names of a hot key
    runs = cust.groupBy(*keys, text.position_run("c_custkey").alias("run")).agg(text.ordered_join("c_custkey", "c_name", ", ").alias("part"))
    authors = runs.groupBy(*keys).agg(text.ordered_join("run", "part", ", ").alias("authors"))
    nation = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    g = join_small(authors, nation, "c_nationkey", "inner")
    return g.select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"), "bucket",
        format_citation(F.concat_ws(" ", "n_name", "c_mktsegment"), "authors",
                        (F.col("bucket") + 2000).cast("string")).alias("citation"),
    )


def q_lead_summary(spark, sf):
    d = _spread_t(spark, sf, "documents").select("doc_id", lead_sentences("text", 3).alias("s"))
    return d.select("doc_id", _len("s").alias("summary_len"), F.md5("s").alias("summary_md5"))


# ------------------------------------------------------------ inference

def q_infer_stub(spark, sf):
    """One model call per 15,000-character chunk of every document (the whole text)."""
    from lectern.plans.extract import DETAIL_PROMPT

    ch = text.chunk_text(_spread_t(spark, sf, "documents"), size=CHUNK, keep=["doc_id"])
    d = ch.select("doc_id", F.col("chunk_idx").cast("int").alias("chunk_idx"),
                  fill_template(DETAIL_PROMPT, "chunk").alias("prompt"))
    out = infer(d, "prompt", EchoModel(), ["doc_id", "chunk_idx"], retries=3, multiplier=0.0, cap=0.0, pause=0.0)
    return out.select("doc_id", "chunk_idx", "response", "error")


def q_durable_answers(spark, sf):
    """The chunk requests of ``infer_stub`` by way of an answer store, asked twice: the second time of a model that is
    down, so every answer comes from the store and only what failed before fails again."""
    from lectern.operators.answers import AnswerStore, infer_stored
    from lectern.plans.extract import DETAIL_PROMPT

    ch = text.chunk_text(_spread_t(spark, sf, "documents"), size=CHUNK, keep=["doc_id"])
    d = ch.select("doc_id", F.col("chunk_idx").cast("int").alias("chunk_idx"), fill_template(DETAIL_PROMPT, "chunk").alias("prompt"))
    store = AnswerStore(spark, scratch_path(spark, "answers"), "offline echo")
    calls = max(1, -(-d.count() // 3))  # three waves at any size
    infer_stored(d, "prompt", EchoModel(), ["doc_id", "chunk_idx"], store, retries=3, wave_calls=calls, **FREE_CALLS)
    down = EchoModel(fail_every=1)
    out = infer_stored(d, "prompt", down, ["doc_id", "chunk_idx"], store, retries=1, **FREE_CALLS)
    return out.select("doc_id", "chunk_idx", "response", "error")


def _papers_in(spark, sf) -> DataFrame:
    return _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("filename"), "text")


def q_extract_records(spark, sf):
    from lectern.plans.extract import extract_records

    return extract_records(_papers_in(spark, sf), RecordModel(), "filename", **FREE_CALLS)


# ------------------------------------------------------------ vectors

def _emb(spark, sf) -> DataFrame:
    return _t(spark, sf, "embeddings")


def _explode_vec(df: DataFrame, key: str, vec: str) -> DataFrame:
    return df.select(key, F.posexplode(vec).alias("dim", "value")).select(
        key, F.col("dim").cast("int").alias("dim"), F.round("value", 6).alias("value"))


def q_masked_mean_pool(spark, sf):
    e = _emb(spark, sf).withColumn("mask", F.when(F.col("embedding")[0] > 0, 1).otherwise(0))
    return _explode_vec(vectors.masked_mean_pool(e, "label", "embedding", "mask"), "label", "pooled")


def q_centroids(spark, sf):
    return _explode_vec(vectors.centroids(_emb(spark, sf), "label", "embedding"), "label", "centroid")


def q_l2_normalize(spark, sf):
    e = _emb(spark, sf).select("vec_id", F.transform(as_double_array("embedding"), lambda x: x * (F.col("vec_id") + 1)).alias("v"))
    n = e.withColumn("u", l2_normalize("v"))
    return n.select("vec_id", F.round(norm("v"), 6).alias("norm_in"), F.round(vec_sum("u"), 6).alias("comp_sum"),
                    F.round(norm("u"), 6).alias("norm_out"))


def q_cluster_size(spark, sf):
    return profile.cluster_size(_emb(spark, sf), "label")


def q_representatives(spark, sf):
    r = vectors.representatives(_emb(spark, sf), "label", "embedding", "vec_id", REP_N)
    return r.select("label", "vec_id", F.col("rank").cast("int").alias("rank"), F.round("sim", 6).alias("sim"))


def q_assign_nearest(spark, sf):
    e = _emb(spark, sf)
    ids, centers = vectors.collect_centers(vectors.centroids(e, "label", "embedding"), "label")
    return vectors.assign_nearest(e, "embedding", centers, ids).select("vec_id", "cluster")


def q_cosine_pairs(spark, sf):
    p = similarity.cosine_pairs(_emb(spark, sf), "vec_id", "embedding", SIM_THRESHOLD)
    return p.select("i", "j", F.round("sim", 6).alias("sim"))


def q_top_neighbors(spark, sf):
    t = similarity.top_neighbors(_emb(spark, sf), "vec_id", "embedding", TOP_K)
    return t.select(F.col("id").alias("vec_id"), "neighbor", F.col("rank").cast("int").alias("rank"),
                    F.round("sim", 6).alias("sim"))


def q_indexed_neighbors(spark, sf):
    """The neighbours of ``top_neighbors`` by way of an index of cells: a few cells first, then all that could hold a nearer one."""
    from lectern.operators.neighbors import build_index, search

    e = _emb(spark, sf)
    t = search(e, "vec_id", "embedding", build_index(e, "vec_id", "embedding"), TOP_K, exact=True)
    return t.select(F.col("id").alias("vec_id"), "neighbor", F.col("rank").cast("int").alias("rank"), F.round("sim", 6).alias("sim"))


def q_sparse_pairs(spark, sf):
    """All pairs of documents whose exact TF-IDF rows have a cosine of at least ``PAIR_THRESHOLD``."""
    from lectern.operators.neighbors import sparse_pairs

    w = vectors.tfidf_weights(_spread_t(spark, sf, "documents"), "text", "doc_id")
    return sparse_pairs(w, "doc_id", PAIR_THRESHOLD).select("i", "j", F.round("sim", 6).alias("sim"))


def q_kmeans_clusters(spark, sf):
    res = kmeans(_emb(spark, sf), "embedding", "vec_id", k=KMEANS_K, restarts=KMEANS_RESTARTS)
    return res.labels


def q_project_2d(spark, sf):
    e = _emb(spark, sf)
    return vectors.project_2d(e, "embedding", ["vec_id", "label"])


def q_neighbor_layout(spark, sf):
    """The layout of the graph of nearest neighbours: each vector's degree, and whether its coordinates are, within the layout's
    bound, the mean of its neighbours' ones times the eigenvalue's inverse."""
    from lectern.operators.layout import TOLERANCE, neighbor_graph, spectral_layout

    edges = neighbor_graph(similarity.top_neighbors(_emb(spark, sf), "vec_id", "embedding", LAYOUT_K))
    edges = cut_lineage(edges, "edges")
    out = spectral_layout(edges)
    p = out.points
    total = p.agg(F.sum("degree")).first()[0] or 0
    means = edges.join(p.select(F.col("id").alias("j"), "x", "y"), "j").groupBy(F.col("i").alias("id")).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    off = lambda c, v: F.abs(F.col("m" + c) - F.lit(v) * F.col(c)) * F.sqrt(F.col("degree").cast("double"))
    bound = F.lit(TOLERANCE * total**0.5 + 1e-9)
    settled = (off("x", out.values[0]) <= bound) & (off("y", out.values[1]) <= bound)
    return p.join(means, "id").select(F.col("id").alias("vec_id"), "degree", settled.alias("settled"))


def q_embed_tfidf(spark, sf):
    d = _spread_t(spark, sf, "documents")
    v = vectors.embed_tfidf(d, "text", ["doc_id"], terms_out="n_terms")
    return v.select("doc_id", "n_terms", F.round(norm("embedding"), 6).alias("norm"))


def q_tfidf_weights(spark, sf):
    """Exact TF-IDF weights of every document, each as its number of terms, sum and largest weight."""
    w = vectors.tfidf_weights(_spread_t(spark, sf, "documents"), "text", "doc_id")
    return w.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("n_tokens"), F.round(F.sum("weight"), 6).alias("sum_weight"),
        F.round(F.max("weight"), 6).alias("max_weight"))


def q_kmeans_fixed(spark, sf):
    """Three rounds of k-means from fixed first centres (the vectors of the smallest ids): labels by smallest member."""
    e = _emb(spark, sf)
    start = e.orderBy("vec_id").limit(KMEANS_K).select(as_double_array("embedding").alias("v")).collect()
    return kmeans(e, "embedding", "vec_id", max_iter=FIXED_ROUNDS, tolerance=0.0, start=[list(r["v"]) for r in start]).labels


def _language(spark, sf) -> DataFrame:
    """doc_id, lang, cluster: the languages numbered from 0 in their order (one row per language to the driver)."""
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    names = sorted(r["lang"] for r in docs.select("lang").distinct().collect())
    return docs.withColumn("cluster", F.array_position(F.array(*[F.lit(n) for n in names]), F.col("lang")).cast("int") - 1)


def q_sparse_kmeans(spark, sf):
    """Three rounds of k-means on the exact TF-IDF rows of all documents, from the mean vector of each language."""
    from lectern.operators.sparse import sparse_centroids, sparse_kmeans

    d = _spread_t(spark, sf, "documents").select("doc_id", "text")
    weights = vectors.tfidf_table(d, "text", "doc_id")
    start = sparse_centroids(weights, _language(spark, sf), "doc_id")
    return sparse_kmeans(weights, d, "doc_id", max_iter=FIXED_ROUNDS, tolerance=0.0, start=start, together=True).labels


# ------------------------------------------------------------ end to end

def _records(spark, sf) -> DataFrame:
    """Every document's record, extracted offline."""
    return cut_lineage(q_extract_records(spark, sf), "records")


def _misplaced(records: DataFrame, centers: DataFrame) -> DataFrame:
    """(filename, misplaced): whether some other centre is nearer to a record than its own cluster's."""
    from lectern.operators.sparse import sparse_assign
    from lectern.sources.records import FEATURE_FIELDS

    texts = records.select("filename", F.col("cluster").alias("own"), feature_text(FEATURE_FIELDS).alias("t"))
    near = sparse_assign(vectors.tfidf_weights(texts, "t", "filename"), texts.select("filename", "own"), centers, "filename")
    return near.select("filename", (F.col("own") != F.col("cluster")).cast("long").alias("misplaced"))


def q_build_table(spark, sf):
    """Documents -> records -> clusters -> CSV, read back by name: rows and present fields by status, and how many records
    are not in the cluster of the nearest centre."""
    from lectern.plans.corpus import build_table
    from lectern.sources.records import from_display, read_clustered, validate_columns, write_clustered

    out = build_table(_papers_in(spark, sf), RecordModel(), calls=FREE_CALLS, clustering={"k": KMEANS_K, "restarts": KMEANS_RESTARTS})
    path = scratch_path(spark, "table")
    descriptions = out.profile.select("cluster", F.col("description").alias("cluster_description"))
    write_clustered(out.records.drop("row_id"), descriptions, path, sentinel_cols=["title", "summary"])
    back = from_display(read_clustered(spark, path))
    validate_columns(back, ["title", "cluster", "cluster_description"])
    # looked at before the join by file name, which would send every record's description through a shuffle
    described = F.col("cluster_description").startswith("Cluster with ").alias("described")
    back = back.select("filename", "extraction_status", "title", "summary", "citation", "cluster", described)
    back = back.join(_misplaced(out.records, out.centers), "filename")
    has = lambda c: F.count(F.when(F.col(c) != SENTINEL, 1))
    return back.groupBy("extraction_status").agg(
        F.count(F.lit(1)).alias("n"), has("title").alias("n_title"), has("summary").alias("n_summary"), F.count("citation").alias("n_citation"),
        F.count("cluster").alias("n_cluster"), F.count_if("described").alias("n_described"), F.sum("misplaced").alias("n_misplaced"))


def q_cluster_analysis(spark, sf):
    """Records clustered from the languages' mean vectors, their profile written as JSON and read back: one row per cluster."""
    from lectern.operators.sparse import sparse_centroids
    from lectern.plans.corpus import cluster_table
    from lectern.sources.records import FEATURE_FIELDS, write_analysis

    recs = _records(spark, sf).withColumn("row_id", F.col("filename").cast("long"))
    texts = recs.select("row_id", feature_text(FEATURE_FIELDS).alias("t"))
    language = _language(spark, sf).select(F.col("doc_id").alias("row_id"), "cluster")
    start = sparse_centroids(vectors.tfidf_weights(texts, "t", "row_id"), language, "row_id")
    path = scratch_path(spark, "analysis")
    write_analysis(cluster_table(recs, max_iter=FIXED_ROUNDS, tolerance=0.0, start=start).profile, path)
    said = F.regexp_extract("description", r"^Cluster with ([0-9]+) papers", 1).cast("long")
    years = "publication_years"
    back = spark.read.schema(f"cluster string, description string, size long, {years} map<string,bigint>").json(path)
    return back.select("cluster", "size", said.alias("n_described"), F.size(years).cast("long").alias("n_years"),
                       F.aggregate(F.map_values(years), F.lit(0).cast("long"), lambda a, b: a + b).alias("n_dated"))


def q_review_report(spark, sf):
    """The review of all records (language as cluster), written as Markdown and read back: all its lines that are not blank."""
    from lectern.plans.corpus import review
    from lectern.sources.records import write_report

    lang = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("filename"), F.col("doc_id").alias("row_id"), "lang")
    recs = _records(spark, sf).join(lang, "filename").withColumn("cluster", F.col("lang")).withColumn("cluster_description", F.lit("by language"))
    path = scratch_path(spark, "review")
    lines = review(recs, EchoModel(), "intro", "end", batch_rows=REVIEW_BATCH, fan_in=REVIEW_FAN_IN, batch_bytes=REVIEW_BYTES, retries=2, **FREE_CALLS)
    write_report(lines, path)
    return spark.read.text(path).where("value <> ''").select(F.md5("value").alias("line_md5"), F.length("value").alias("n"))


def q_stream_labels(spark, sf):
    """Documents arriving in four files, each a micro-batch: extracted, and labelled by a stored model whose frequencies
    are those of all records and whose centres are the languages' mean vectors."""
    from lectern.sources.records import FEATURE_FIELDS
    from lectern.streaming.labels import fit_model, incremental_labels, labelled_records, store_model

    recs = _records(spark, sf)
    texts = recs.select("filename", feature_text(FEATURE_FIELDS).alias("t"))
    language = _language(spark, sf).select(F.col("doc_id").cast("string").alias("filename"), "cluster")
    models, source, sink = (scratch_path(spark, x) for x in ("models", "arriving", "labelled"))
    store_model(fit_model(texts, language, "filename", "t", version=1), models)
    arriving = _papers_in(spark, sf)
    arriving.repartition(4, "filename").write.parquet(source)
    incremental_labels(spark, source, arriving.schema, sink, scratch_path(spark, "label-log"), models, RecordModel(), calls=FREE_CALLS, max_files_per_trigger=1)
    return labelled_records(spark, sink).select("filename", "title", "extraction_status", "cluster", "model_version")


# ------------------------------------------------------------ profile

def _papers(spark, sf) -> DataFrame:
    """Every document with a vector (number doc_id modulo their count): label as
    cluster, source as method, the first line of the text as title.

    The joined table feeds many aggregates of one query, so it is written
    once (``cut_lineage``) rather than recomputed in every branch of the plan.
    """
    e = _emb(spark, sf).select("vec_id", "label", "embedding")
    n = e.count()
    d = _t(spark, sf, "documents").select(
        "doc_id", "source", "lang", F.substring_index("text", "\n", 1).alias("title"),
        (F.lit(1990) + F.least(F.floor(F.col("n_chars") / 1000), F.lit(35))).cast("string").alias("year"))
    return cut_lineage(d.join(e, F.pmod("doc_id", F.lit(n)) == F.col("vec_id")).drop("vec_id"), "papers")


def q_top_values(spark, sf):
    o = _t(spark, sf, "orders")
    t = profile.top_values(o, "o_orderstatus", "o_orderpriority", 3)
    return t.select("o_orderstatus", F.col("rank").cast("int").alias("rank"), "value", "cnt")


def q_year_histogram(spark, sf):
    o = _t(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("int"))
    h = profile.value_histogram(o, "o_orderstatus", "year")
    return h.select("o_orderstatus", F.col("value").alias("year"), "cnt")


def _descriptions(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Papers, their representatives (n per cluster, stored once) and cluster descriptions."""
    p = _papers(spark, sf)
    reps = cut_lineage(vectors.representatives(p, "label", "embedding", "doc_id", REP_N).drop("embedding"), "reps")
    return p, reps, profile.describe_clusters(p, "label", "source", reps)


def q_cluster_description(spark, sf):
    _, _, desc = _descriptions(spark, sf)
    return desc.select("label", "size", "description")


def q_attach_description(spark, sf):
    p, _, desc = _descriptions(spark, sf)
    a = profile.attach_description(p.select("doc_id", "label"), desc, "label")
    return a.select("doc_id", "label", F.md5("cluster_description").alias("description_md5"))


def q_group_records(spark, sf):
    p = _papers(spark, sf)
    g = profile.group_records(p, "label", "doc_id", ["title", "source"], batch_rows=REVIEW_BATCH)
    return g.select(
        "label", "batch", "size", F.size("records").cast("long").alias("n_records"),
        F.array_join(F.transform("records", lambda r: r["doc_id"].cast("string")), ",").alias("record_ids"))


def q_byte_batches(spark, sf):
    """Records of every label in batches bounded in rows and in bytes of JSON."""
    p = _papers(spark, sf)
    g = profile.group_records(p, "label", "doc_id", ["title", "source"], batch_rows=REVIEW_BATCH, batch_bytes=REVIEW_BYTES)
    return g.select(
        "label", "batch", "size", F.size("records").cast("long").alias("n_records"),
        F.octet_length(F.to_json("records")).cast("long").alias("n_bytes"),
        F.array_join(F.transform("records", lambda r: r["doc_id"].cast("string")), ",").alias("record_ids"))


def q_number_references(spark, sf):
    d = _t(spark, sf, "documents").withColumn(
        "citation", F.when(F.col("lang") != "en", F.concat(F.lit("Document "), F.col("doc_id").cast("string"), F.lit(" ("), F.col("source"), F.lit(")"))))
    n = references.number_references(d, "doc_id", "citation")
    return n.select("ref_no", "doc_id", "reference")


def q_report_sections(spark, sf):
    p = _papers(spark, sf)
    bodies = p.groupBy("label").agg(F.lit("").alias("body"))
    s = review_sections(p, "label", "doc_id", bodies, "intro", "end")
    return s.select(F.col("section_order").cast("int").alias("section_order"), "section_id", "title")


def q_cluster_narrative(spark, sf):
    p = _papers(spark, sf)
    g = profile.group_records(p, "label", "doc_id", ["title", "source"], batch_rows=REVIEW_BATCH)
    return narrate_clusters(g, "label", EchoModel(), fan_in=REVIEW_FAN_IN, retries=2, multiplier=0.0, pause=0.0)


def q_cluster_profile_json(spark, sf):
    p, reps, desc = _descriptions(spark, sf)
    prof = profile.cluster_profile(p, "label", desc, reps, "source", "lang", "year")
    return prof.select("label", F.to_json(F.struct(*[c for c in prof.columns if c != "label"])).alias("analysis"))


def _flat_map(col: str) -> F.Column:
    return F.array_join(F.transform(F.map_entries(col), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", ")


def q_cluster_profile(spark, sf):
    """The per-cluster profile with its maps flattened to ordered ``key=count`` text."""
    p, reps, desc = _descriptions(spark, sf)
    prof = profile.cluster_profile(p, "label", desc, reps, "source", "lang", "year")
    return prof.select(
        "label", "description", "size",
        F.array_join("representative_papers", " | ").alias("representative_papers"),
        _flat_map("common_methods").alias("common_methods"),
        _flat_map("common_datasets").alias("common_datasets"),
        _flat_map("publication_years").alias("publication_years"),
    )


def q_incremental_ingest(spark, sf):
    from lectern.streaming.ingest import incremental_assemble

    return incremental_assemble(spark, sf).select("conv_id", _len("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def q_stream_profile(spark, sf):
    """Orders arriving in five files, each a micro-batch, counted into a stored profile: the values that ``top_values`` and
    ``year_histogram`` find in the whole table."""
    from lectern.streaming.profiles import ProfileStore, incremental_profile

    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").cast("int").alias("year"))
    source = scratch_path(spark, "orders")
    o.repartition(5, "o_orderkey").write.parquet(source)
    store = ProfileStore(spark, scratch_path(spark, "profile"), ["o_orderpriority", "year"], merge_after=2)
    incremental_profile(spark, source, o.schema, store, scratch_path(spark, "profile-log"), "o_orderstatus", max_files_per_trigger=1)
    top = store.top_values(3).where("field = 'o_orderpriority'").select("cluster", "field", "value", "cnt")
    years = store.histogram("year").select("cluster", F.lit("year").alias("field"), "value", "cnt")
    sizes = store.sizes().select("cluster", F.lit("size").alias("field"), F.lit("").alias("value"), F.col("size").alias("cnt"))
    return top.unionByName(years).unionByName(sizes)


QUERIES: dict[str, Query] = {
    "chunk_stats": q_chunk_stats,
    "drop_empty": q_drop_empty,
    "chunk_text": q_chunk_text,
    "assemble_pages": q_assemble_pages,
    "head_slice": q_head_slice,
    "build_prompt": q_build_prompt,
    "fill_sentinel": q_fill_sentinel,
    "cluster_slice": q_cluster_slice,
    "scan_documents": q_scan_documents,
    "decode_pages": q_decode_pages,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_multiline": q_csv_multiline,
    "json_envelope": q_json_envelope,
    "json_parse": q_json_parse,
    "extraction_status": q_extraction_status,
    "merge_fields": q_merge_fields,
    "feature_text": q_feature_text,
    "format_citation": q_format_citation,
    "lead_summary": q_lead_summary,
    "infer_stub": q_infer_stub,
    "durable_answers": q_durable_answers,
    "extract_records": q_extract_records,
    "masked_mean_pool": q_masked_mean_pool,
    "centroids": q_centroids,
    "l2_normalize": q_l2_normalize,
    "cluster_size": q_cluster_size,
    "representatives": q_representatives,
    "assign_nearest": q_assign_nearest,
    "cosine_pairs": q_cosine_pairs,
    "top_neighbors": q_top_neighbors,
    "indexed_neighbors": q_indexed_neighbors,
    "sparse_pairs": q_sparse_pairs,
    "kmeans_clusters": q_kmeans_clusters,
    "project_2d": q_project_2d,
    "neighbor_layout": q_neighbor_layout,
    "embed_tfidf": q_embed_tfidf,
    "tfidf_weights": q_tfidf_weights,
    "kmeans_fixed_start": q_kmeans_fixed,
    "sparse_kmeans": q_sparse_kmeans,
    "build_table": q_build_table,
    "cluster_analysis": q_cluster_analysis,
    "review_report": q_review_report,
    "top_values": q_top_values,
    "year_histogram": q_year_histogram,
    "cluster_description": q_cluster_description,
    "attach_description": q_attach_description,
    "group_records": q_group_records,
    "byte_batches": q_byte_batches,
    "number_references": q_number_references,
    "report_sections": q_report_sections,
    "cluster_narrative": q_cluster_narrative,
    "cluster_profile_json": q_cluster_profile_json,
    "cluster_profile": q_cluster_profile,
    "incremental_ingest": q_incremental_ingest,
    "stream_labels": q_stream_labels,
    "stream_profile": q_stream_profile,
}

__all__ = ["QUERIES", "SENTINEL", "strip_ws"]
