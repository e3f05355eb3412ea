"""URL filters by a path-template tree.

A url's path becomes a template: segments that look like numbers, hashes or dates, and segments at a depth where the
host has nearly as many values as urls, are wildcards, and so are all behind the first ``DEEPEST`` constant ones.  Templates
are the leaves of a tree; a node's parent has its last constant segment generalised too.  Level by level, from the most
constant segments to none, sibling branches whose labelled shares of bad pages do not differ from their common share by more
than chance are merged into their parent, which is then compared with its own siblings; a branch that differs stays
where it is.  A branch's share of good labels is smoothed towards the share of all labels, and branches below a
threshold are rejected.  Fixed rules come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.joins import join_small
from lectern.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Numbers (with an ending such as .html), dates, long hashes and ids.
# The repeated group is possessive, so that a segment of any length is matched without recursion.
VARIABLE = r"^[0-9]++(?:[._-][A-Za-z0-9]{1,8}+)*+$|^[0-9a-fA-F]{8,}$|^[0-9a-fA-F]{8}-[0-9a-fA-F-]{27}$|[0-9]{4,}"
# A depth varies if its values number over MANY and over half of the host's urls that reach it.
MANY = 20
# Constant segments of a template: the levels of the tree.
DEEPEST = 8
PRIOR = 5.0  # labels that the smoothing counts for
PURITY = 0.6
SIGMAS = 2.0


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a url without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits; nulls where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _constant(s: Column) -> Column:
    return (s != "*") & (s != "")


def level(node: Column) -> Column:
    """Constant segments of a node."""
    return F.size(F.filter(F.split(node, "/"), _constant))


def parent(node: Column) -> Column:
    """The node with its last constant segment generalised."""
    last = F.array_max(F.transform(F.split(node, "/"), lambda s, i: F.when(_constant(s), i).otherwise(-1)))
    found = F.transform(F.array(F.struct(F.split(node, "/").alias("s"), last.alias("last"))), lambda x: F.array_join(
        F.transform(x["s"], lambda s, i: F.when(i == x["last"], "*").otherwise(s)), "/"))
    return F.element_at(found, 1)


def templates(pages: DataFrame) -> DataFrame:
    """``pages`` (with host and path) with ``template``."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    pages = pages.withColumn("_s", segments)
    seen = pages.select("host", F.posexplode("_s").alias("depth", "segment")).where(~F.col("segment").rlike(VARIABLE))
    values = seen.groupBy("host", "depth", "segment").agg(F.count(F.lit(1)).alias("c"))
    depths = values.groupBy("host", "depth").agg(F.count(F.lit(1)).alias("values"), F.sum("c").alias("urls"))
    varies = depths.where(f"values > {MANY} and 2 * values > urls").groupBy("host").agg(F.collect_set("depth").alias("_v"))
    pages = join_small(pages, varies, "host", "left")
    wild = F.transform("_s", lambda s, i: F.when(
        s.rlike(VARIABLE) | F.coalesce(F.array_contains("_v", i), F.lit(False)), "*").otherwise(s))
    pages = pages.withColumn("_w", wild)
    constants = F.filter(F.transform("_w", lambda s, i: F.when(s != "*", i)), lambda i: i.isNotNull())
    pages = pages.withColumn("_cut", F.coalesce(F.get(constants, F.lit(DEEPEST)), F.size("_w")))
    few = F.transform("_w", lambda s, i: F.when(i >= F.col("_cut"), "*").otherwise(s))
    return pages.withColumn("template", F.concat(F.lit("/"), F.array_join(few, "/"))).drop("_s", "_v", "_w", "_cut")


def branch_verdicts(labelled: DataFrame, prior: float = PRIOR, purity: float = PURITY, sigmas: float = SIGMAS) -> DataFrame:
    """(host, template, branch, purity, rejected) of the templates among rows (host, template, bad: boolean or null)."""
    leaf = labelled.groupBy("host", "template").agg(F.count("bad").alias("n"), F.sum(F.col("bad").cast("long")).alias("b")).fillna(0, ["b"])
    placed = cut_lineage(leaf.withColumn("branch", F.col("template")), "branches")
    one = placed.agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.max(level(F.col("branch"))).alias("deepest")).first()
    good = 1 - one["b"] / one["n"] if one["n"] else 1.0
    for depth in range(one["deepest"] or 0, 0, -1):
        nodes = placed.where(level(F.col("branch")) == depth).groupBy("host", "branch").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
        nodes = cut_lineage(nodes.withColumn("parent", parent(F.col("branch"))), "nodes")
        parents = nodes.groupBy("host", "parent").agg(F.sum("n").alias("pn"), F.sum("b").alias("pb"))
        p = F.when(F.col("pn") > 0, F.col("pb") / F.col("pn")).otherwise(F.lit(0.0))
        spread = F.lit(sigmas) * F.sqrt(F.col("n") * p * (1 - p)) + 0.5
        alike = join_small(nodes, parents, ["host", "parent"]).where(F.abs(F.col("b") - F.col("n") * p) <= spread).select("host", "branch", "parent")
        up = join_small(placed, alike, ["host", "branch"], "left")
        placed = cut_lineage(up.select("host", "template", "n", "b", F.coalesce("parent", "branch").alias("branch")), "branches")
    sums = placed.groupBy("host", "branch").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    share = (F.col("n") - F.col("b") + F.lit(prior * good)) / (F.col("n") + F.lit(prior))
    judged = sums.select("host", "branch", share.alias("purity"), (share < purity).alias("rejected"))
    return join_small(placed.select("host", "template", "branch"), judged, ["host", "branch"])


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, template, branch, purity.

    ``labels`` has the key (``page_id``) and ``bad`` (boolean) of some pages; a page labelled more than once is bad if any label
    is.  ``rules`` are (verdict, host, path): a rule fits its host and all subdomains, if the path starts with the
    rule's; the longest decides.  Elsewhere pages of rejected templates are blocked.  A null url or one without
    ``://`` has an empty host and path, one template of its own, and is allowed unless its labels reject it.
    Repeated and null keys are rows like others; other columns are ignored; an empty table gives none.
    """
    host, path = host_path(F.col(url))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    known = labels.select(F.col("page_id").cast("long").alias("page_id"), F.col("bad").cast("boolean").alias("bad")).groupBy("page_id").agg(F.bool_or("bad").alias("bad"))
    rows = cut_lineage(templates(rows).join(known, "page_id", "left"), "templates")
    verdicts = branch_verdicts(rows)
    rule, fixed = rule_of(F.col("host"), F.col("path"), rules)
    out = join_small(rows, verdicts, ["host", "template"], "left")
    return out.select("page_id", "host", "path", rule.alias("rule"),
                      F.coalesce(fixed, F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"), "template", "branch", F.round("purity", 9).alias("purity"))
