"""Review report: one generated section per cluster, framed by an
introduction and a conclusion, followed by the numbered references.

Sections are a small table ``(section_order, section_id, title, body)``:
introduction first, clusters in order of first appearance, conclusion, then
references.  The writer turns sections and references into ordered line rows
and writes them with Spark; the report is never gathered into one string.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import cluster_key, cluster_title
from lectern.operators.inference import REVIEW_RETRIES, TABLE_BACKOFF, infer
from lectern.operators.profile import first_appearance

# Report title and the section headings.
REPORT_TITLE = "Meta-Learning Literature Review"
INTRODUCTION = "Introduction"
CONCLUSION = "Conclusion"
REFERENCES = "References"

# Our own wording of the per-cluster request.
NARRATIVE_PROMPT = (
    "Write one cohesive, formal paragraph that synthesises the research papers of {}: "
    "shared themes, methods, main findings and open problems, citing papers as [n]. "
    "Papers (JSON): {}"
)


MERGE_PROMPT = (
    "Combine these partial syntheses of the papers of {} into one cohesive, formal paragraph, "
    "keeping their themes, findings and citations. Partial syntheses (JSON list, in paper order): {}"
)

# Default number of partial texts combined by one call at the upper levels.
DEFAULT_FAN_IN = 8


def narrate_clusters(
    grouped: DataFrame,
    cluster: str,
    fn: Callable[[str], str],
    records: str = "records",
    batch: str = "batch",
    fan_in: int = DEFAULT_FAN_IN,
    retries: int = REVIEW_RETRIES,
    multiplier: float = TABLE_BACKOFF,
    pause: float = 1.0,
    partitions: int | None = None,
    cap: float | None = None,
) -> DataFrame:
    """(cluster, batch, records) -> (cluster, body): one generated text per cluster.

    A cluster whose records fit in one batch gets one call over all of them.
    A larger cluster is narrated as a tree: one call per batch of records,
    then one call per ``fan_in`` consecutive partial texts, level by level,
    until one text is left.  Every call sees a bounded input and every level
    is a distributed stage, so a hot cluster never reaches one task whole.
    A failed call becomes its text (the error message) instead of aborting.
    Each level's answers are checkpointed: model calls are expensive and not
    deterministic, so they must not be recomputed by a later action.
    ``partitions`` (default: the cluster's task slots) is the number of
    concurrent calls per level.
    """
    from lectern.functions.text import fill_template
    from lectern.operators.joins import join_small
    from lectern.session import cut_lineage

    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    n = partitions or grouped.sparkSession.sparkContext.defaultParallelism
    kw = dict(retries=retries, multiplier=multiplier, cap=cap, pause=pause, partitions=n)
    # fixed text
    err_text = F.concat(F.lit("Error analyzing cluster "), cluster_title(cluster), F.lit(": API error - "), F.col("error"))

    def call(prompts: DataFrame) -> DataFrame:
        out = infer(prompts, "prompt", fn, [cluster, "_b"], **kw)
        return out.select(cluster, "_b", F.coalesce(F.btrim(F.col("response")), err_text).alias("body"))

    prompts = grouped.select(
        cluster, F.col(batch).cast("long").alias("_b"),
        fill_template(NARRATIVE_PROMPT, cluster_title(cluster), F.to_json(F.col(records))).alias("prompt"),
    )
    level = cut_lineage(call(prompts))
    widest = level.agg(F.max("_b")).first()[0]  # one number: the most batches of any cluster, minus 1
    finals = []
    while widest is not None and widest > 0:
        last = level.groupBy(cluster).agg(F.max("_b").alias("_m"))  # one row per cluster
        level = join_small(level, last, cluster, "inner")
        finals.append(level.where(F.col("_m") == 0).select(cluster, "body"))
        groups = level.where(F.col("_m") > 0).groupBy(cluster, F.floor(F.col("_b") / F.lit(fan_in)).alias("_b")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col("_b").alias("o"), F.col("body").alias("t")))),
                        lambda s: s["t"]).alias("_parts"))
        single = groups.where(F.size("_parts") == 1).select(cluster, "_b", F.col("_parts")[0].alias("body"))
        merged = call(groups.where(F.size("_parts") > 1).select(
            cluster, "_b", fill_template(MERGE_PROMPT, cluster_title(cluster), F.to_json(F.col("_parts"))).alias("prompt")))
        level = cut_lineage(single.unionByName(merged))
        widest = (widest // fan_in)
    finals.append(level.select(cluster, "body"))
    out = finals[0]
    for f in finals[1:]:
        out = out.unionByName(f)
    return out


def review_sections(
    df: DataFrame,
    cluster: str,
    order: str,
    bodies: DataFrame,
    introduction: str,
    conclusion: str,
) -> DataFrame:
    """(section_order, section_id, title, body): introduction 0, clusters 1..k in
    order of first appearance, conclusion k + 1.  The ordering window runs over
    k + 2 rows only (one per section)."""
    from pyspark.sql import Window

    spark = df.sparkSession
    firsts = first_appearance(df, cluster, order)
    clusters = firsts.join(bodies, cluster, "left").select(
        F.lit(1).alias("_g"), F.col("first").cast("long").alias("_o"),
        cluster_key(cluster).alias("section_id"), cluster_title(cluster).alias("title"),
        F.coalesce(F.col("body"), F.lit("")).alias("body"),
    )
    frame = spark.createDataFrame(
        [(0, 0, "introduction", INTRODUCTION, introduction), (2, 0, "conclusion", CONCLUSION, conclusion)],
        "_g int, _o long, section_id string, title string, body string",
    )
    ordered = frame.unionByName(clusters).withColumn(
        "section_order", (F.row_number().over(Window.orderBy("_g", "_o")) - 1).cast("int"))
    return ordered.select("section_order", "section_id", "title", "body")


def report_lines(sections: DataFrame, references: DataFrame) -> DataFrame:
    """Ordered Markdown lines: (k1, k2, line) with sections then references."""
    spark = sections.sparkSession
    head = spark.createDataFrame([(-1, 0, f"# {REPORT_TITLE}\n")], "k1 long, k2 long, line string")
    sec = sections.select(
        F.col("section_order").cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"),
        F.concat(F.lit("## "), F.col("title"), F.lit("\n\n"), F.col("body"), F.lit("\n")).alias("line"),
    )
    ref_head = spark.createDataFrame([(2_000_000_000, 0, f"## {REFERENCES}\n")], "k1 long, k2 long, line string")
    refs = references.select(
        F.lit(2_000_000_000).cast("long").alias("k1"), F.col("ref_no").cast("long").alias("k2"),
        F.concat(F.col("reference"), F.lit("\n")).alias("line"),
    )
    return head.unionByName(sec).unionByName(ref_head).unionByName(refs)
