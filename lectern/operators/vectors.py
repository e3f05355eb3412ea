"""Vector operators: pooling, normalisation, centroids, representatives,
nearest-centre assignment, embeddings and 2-D projection.

Vectors are ``ARRAY<DOUBLE>`` (or FLOAT) columns.  Per-cluster sums use
Spark ML's ``Summarizer`` (a JVM aggregate over ML vectors), so vectors are
never exploded into one row per component before a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.vectors import as_double_array, cosine, dot, l2_normalize, norm, sq_dist, vectors_literal
from lectern.operators.joins import join_small
from lectern.session import cut_lineage, discard


def masked_mean_pool(
    df: DataFrame, key: str, vec: str, mask: str, out: str = "pooled", eps: float = 1e-9
) -> DataFrame:
    """Per key: sum(vec * mask) / max(sum(mask), eps), component-wise."""
    masked = F.transform(as_double_array(vec), lambda x: x * F.col(mask).cast("double"))
    agg = df.groupBy(key).agg(
        Summarizer.sum(array_to_vector(masked)).alias("_s"),
        F.sum(F.col(mask).cast("double")).alias("_m"),
    )
    denom = F.greatest(F.col("_m"), F.lit(eps))
    return agg.select(key, F.transform(vector_to_array("_s"), lambda x: x / denom).alias(out))


def normalize_rows(df: DataFrame, vec: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or vec, l2_normalize(vec))


def centroids(df: DataFrame, cluster: str, vec: str, out: str = "centroid") -> DataFrame:
    """Mean vector and size per cluster (partial aggregation map-side)."""
    return df.groupBy(cluster).agg(
        vector_to_array(Summarizer.mean(array_to_vector(as_double_array(vec)))).alias(out),
        F.count(F.lit(1)).alias("size"),
    )


def centroid_similarity(
    df: DataFrame, cluster: str, vec: str, cents: DataFrame | None = None,
    out: str = "sim",
) -> DataFrame:
    """Cosine of every member to its own cluster's centroid."""
    cents = cents if cents is not None else centroids(df, cluster, vec)
    cents = cents.select(cluster, "centroid")
    joined = join_small(df, cents, cluster, "inner")
    return joined.withColumn(out, cosine(vec, "centroid")).drop("centroid")


def representatives(
    df: DataFrame, cluster: str, vec: str, id_col: str, n: int = 3
) -> DataFrame:
    """The ``n`` members closest to their centroid, by similarity desc then id.

    ``row_number <= n`` lets Catalyst put a per-partition group limit before
    the shuffle, so a huge cluster sends at most ``n`` rows per map task.
    """
    sims = centroid_similarity(df, cluster, vec)
    w = Window.partitionBy(cluster).orderBy(F.col("sim").desc(), F.col(id_col).asc())
    return sims.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def nearest_center(vec: Column | str, centers: Sequence[Sequence[float]], ids: Sequence[int] | None = None) -> Column:
    """Id of the nearest centre (squared Euclidean; ties -> smaller id).

    The centres (k small, collected once) are a literal in the expression, so
    assignment is a narrow map over the vectors: no join, no shuffle.
    """
    lits = vectors_literal(centers, ids)
    v = as_double_array(vec)
    scored = F.transform(lits, lambda s: F.struct(sq_dist(v, s["c"]).alias("d"), s["id"].alias("id")))
    return F.array_min(scored)["id"]


def assign_nearest(
    df: DataFrame, vec: str, centers: Sequence[Sequence[float]], ids: Sequence[int] | None = None,
    out: str = "cluster",
) -> DataFrame:
    return df.withColumn(out, nearest_center(vec, centers, ids))


def collect_centers(cents: DataFrame, cluster: str, centroid: str = "centroid") -> tuple[list[int], list[list[float]]]:
    """Bring the k centres to the driver (O(k * dim) values)."""
    rows = cents.select(cluster, centroid).orderBy(cluster).collect()
    return [int(r[0]) for r in rows], [list(r[1]) for r in rows]


def embed(
    df: DataFrame,
    text_col: str,
    model_factory: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]],
    id_cols: Sequence[str],
    batch: int = 32,
    out: str = "embedding",
) -> DataFrame:
    """Injected text -> vector model, loaded once per task, fed ``batch`` texts at a time."""
    ids = list(id_cols)
    src = df.select(*ids, text_col)
    schema = T.StructType([src.schema[c] for c in ids] + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_factory()
        for pdf in batches:
            texts = pdf[text_col].fillna("").tolist()
            vecs: list[list[float]] = []
            for i in range(0, len(texts), batch):
                vecs.extend([list(map(float, v)) for v in model(texts[i:i + batch])])
            res = pdf[ids].copy()
            res[out] = vecs
            yield res

    return src.mapInPandas(run, schema)


def embed_tfidf(
    df: DataFrame, text_col: str, id_cols: Sequence[str], num_features: int = 1 << 10, min_doc_freq: int = 1,
    out: str = "embedding", terms_out: str | None = None,
) -> DataFrame:
    """Offline embedding: tokens -> hashed term counts -> IDF -> unit L2 rows.

    All stages are Spark ML (JVM).  Term counts are computed once and written
    (sparse vectors) for the IDF pass and the weighting pass, so the text is
    tokenised only once.  ``terms_out`` optionally adds each
    row's number of tokens (the sum of its term counts).
    """
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer

    src = df.select(*id_cols, F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"(?U)\W+", toLowercase=True)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)
    counts = cut_lineage(tf.transform(tok.transform(src)).select(*id_cols, "_tf"), "counts")
    idf = IDF(inputCol="_tf", outputCol="_idf", minDocFreq=min_doc_freq).fit(counts)
    unit = Normalizer(inputCol="_idf", outputCol="_vec", p=2.0).transform(idf.transform(counts))
    extra = []
    if terms_out:
        total = F.aggregate(vector_to_array("_tf"), F.lit(0.0).cast("double"), lambda acc, x: acc + x)
        extra = [total.cast("long").alias(terms_out)]
    return unit.select(*id_cols, vector_to_array("_vec").alias(out), *extra)


def term_counts(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(id, term, tf): lower-cased runs of Unicode word characters, counted; documents without terms have no rows."""
    terms = F.explode(F.split(F.lower(F.col(text_col)), r"(?U)\W+")).alias("term")
    return df.select(id_col, terms).where("term <> ''").groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(tf: DataFrame) -> DataFrame:
    """(term, df): in how many documents of ``tf`` (:func:`term_counts`) a term is."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def weigh_terms(tf: DataFrame, frequencies: DataFrame, n: int, id_col: str) -> DataFrame:
    """(id, term, tf, weight) by the frequencies (term, df) of ``n`` documents, which need not be those of ``tf``.

    The weight is tf * ln((n + 1) / (df + 1)), divided by the document's norm; a term that is not in ``frequencies`` has df 0.
    A document whose weights are all zero keeps zeros.
    """
    idf = frequencies.select("term", F.log(F.lit(n + 1.0) / (F.col("df") + 1.0)).alias("_idf"))
    weight = F.col("tf") * F.coalesce("_idf", F.log(F.lit(n + 1.0)))
    # one pass by the id: a document's rows are at most as many as there are terms
    raw = tf.where(F.col(id_col).isNotNull()).join(idf, "term", "left").withColumn("_w", weight)
    raw = raw.withColumn("_n", F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col))))
    unit = F.when(F.col("_n") > 0, F.col("_w") / F.col("_n")).otherwise(F.lit(0.0))
    return raw.select(id_col, "term", "tf", unit.alias("weight"))


def tfidf_weights(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Exact TF-IDF: (id, term, tf, weight), one row per document and distinct term, each document of length 1.

    Terms and weights are those of :func:`term_counts` and :func:`weigh_terms`, by the documents' own frequencies.  The
    vocabulary is as large as the corpus makes it: nothing is hashed or capped.  Term counts are aggregated before they
    are shuffled; documents without terms have no rows.
    """
    tf = cut_lineage(term_counts(df, text_col, id_col), "tf")
    return weigh_terms(tf, document_frequencies(tf), df.count(), id_col)


def tfidf_table(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(id, term, weight) of :func:`tfidf_weights` as a written table, a document's rows together; the term counts are discarded."""
    tf = cut_lineage(term_counts(df, text_col, id_col), "tf")
    weights = weigh_terms(tf, document_frequencies(tf), df.count(), id_col).select(id_col, "term", "weight")
    weights = cut_lineage(weights, "weights")
    discard(tf)
    return weights


def project_2d(df: DataFrame, vec: str, keep: Sequence[str]) -> DataFrame:
    """2-D coordinates via Spark ML PCA (distributed), signs fixed.

    Each component is flipped so that its largest-magnitude loading is positive,
    which makes the output independent of the solver's sign choice.
    """
    from pyspark.ml.feature import PCA

    src = df.select(*keep, array_to_vector(as_double_array(vec)).alias("_v"))
    model = PCA(k=2, inputCol="_v", outputCol="_p").fit(src)
    pc = model.pc.toArray()  # dim x 2, small
    signs = []
    for j in range(pc.shape[1]):
        col = pc[:, j]
        i = int(abs(col).argmax())
        signs.append(1.0 if col[i] >= 0 else -1.0)
    arr = vector_to_array(F.col("_p"))
    return model.transform(src).select(
        *keep, (arr[0] * F.lit(signs[0])).alias("x"), (arr[1] * F.lit(signs[1])).alias("y")
    )


__all__ = [
    "assign_nearest", "centroid_similarity", "centroids", "collect_centers", "cosine", "dot", "embed",
    "embed_tfidf", "masked_mean_pool", "nearest_center", "norm", "normalize_rows", "project_2d", "representatives",
]
