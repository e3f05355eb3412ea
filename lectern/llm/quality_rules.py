"""Host-level quality rules.

Every document is measured and tested by rules; failures are counted by host; a host's failure rate is shrunk towards
all hosts' by a beta prior whose two parameters are fitted to the hosts' rates by their moments (an empirical Bayes
estimate, so a host of few documents is not judged by them alone); and the verdict on a host comes back to its
documents.  Only Spark expressions, joins and aggregates are used; repeated word triples of a text are found
inside its row, by sorting their hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.native import text_key, words
from lectern.session import cut_lineage

LEAST_WORDS = 50
REPEAT_PERCENT = 50
# Further rules, counted against the host only: symbols and repeated lines in percent of words and lines.
SYMBOL_PERCENT, DUP_LINE_PERCENT = 30, 60
# A host whose shrunk failure rate is above this loses all its documents.
HOST_RATE = 0.6


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words instead of its text."""
    rest = [c for c in docs.columns if c != text]
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    a = docs.select(*rest, words(text).alias("_w"), F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), lines.alias("_l"))
    # a hash of every word triple; the last two positions start none
    triple = F.slice(
        F.transform("_w", lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2))), F.lit(1), F.greatest(F.size("_w") - 2, F.lit(0)))
    b = a.select(
        *rest, "n_symbols", F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        triple.alias("_t"))
    # position in the low bits, hash in all others: equal triples are neighbours after a sort of whole numbers
    mask = F.expr("shiftleft(1L, length(bin(size(_t)))) - 1L").alias("_m")
    c = b.select(*rest, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines", "_t", mask)
    repeats = F.size(F.array_distinct("_t")) < F.size("_t")
    packed = F.when(repeats, F.sort_array(F.transform(
        "_t", lambda h, i: h.bitwiseAND(F.bitwise_not("_m")).bitwiseOR(i.cast("long")))))
    d = c.select(*rest, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines", "_m", "_t", packed.alias("_s"))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce(x.bitwiseXOR(y).bitwiseAND(F.bitwise_not("_m")) == 0, F.lit(False))

    found = F.filter("_s", lambda x, i: same(x, F.get("_s", i + 1)) | ((i > 0) & same(x, F.get("_s", i - 1))))
    # these few are compared by their whole hashes: a triple that repeats is among them, but so are strangers
    at = F.transform(found, lambda x: x.bitwiseAND(F.col("_m")))
    whole = F.sort_array(F.transform(at, lambda p: F.struct(F.get("_t", p.cast("int")).alias("h"), p.alias("p"))))
    d = d.select(*rest, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines", whole.alias("_q"))

    def equal(x: Column, y: Column) -> Column:
        return F.coalesce(x["h"] == y["h"], F.lit(False))

    pairs = F.filter("_q", lambda x, i: equal(x, F.get("_q", i + 1)) | ((i > 0) & equal(x, F.get("_q", i - 1))))
    e = d.select(*rest, "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines", F.transform(pairs, lambda x: x["p"]).alias("_p"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_p", lambda p: F.array(p, p + 1, p + 2)))))
    return e.select(*rest, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                    F.when(F.col("_p").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"))


def host_rates(rows: DataFrame, host: str, failed: str) -> DataFrame:
    """(host, n, failures, rate, shrunk): per host its failure rate, raw and shrunk by the empirical beta prior.

    With mean m and variance v of the hosts' rates, weighted by documents, the prior is beta(m k, (1 - m) k) with
    k = m (1 - m) / v - 1; where v is too small for a k, every host gets m.  Where all hosts fail wholly or not at
    all, v is as large as can be, k is 0 and every host keeps its own rate.  A null host is no host.
    """
    hosts = rows.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(failed).cast("long")).alias("failures"))
    hosts = cut_lineage(hosts.withColumn("rate", F.col("failures") / F.col("n")), "hosts")
    one = hosts.agg(F.sum("n").alias("n"), F.sum("failures").alias("f"), F.sum(F.col("n") * F.col("rate") * F.col("rate")).alias("q")).first()
    mean = one["f"] / one["n"] if one["n"] else 0.0
    variance = max(0.0, one["q"] / one["n"] - mean * mean) if one["n"] else 0.0
    if variance > 1e-12:
        k = max(0.0, mean * (1 - mean) / variance - 1)  # below 0 by rounding only
        shrunk = (F.col("failures") + F.lit(mean * k)) / (F.col("n") + F.lit(k))
    else:
        shrunk = F.lit(mean)
    return hosts.withColumn("shrunk", shrunk)


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", host_rate: float = HOST_RATE) -> DataFrame:
    """One row per input row: doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    failed, host_rate, kept and text_key.

    ``base_failed``: fewer than 50 words, or over half of the words inside repeated word triples.  ``failed`` adds the
    rules counted against hosts.  ``kept`` is false if ``base_failed`` or if the host's shrunk failure rate is above
    the limit.  A null or empty text has no words and fails; a null host has no rate and rejects nothing; a null key
    and repeated rows are rows like others.  Other columns are ignored; an empty table gives none.
    """
    rows = measures(docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), text_key(text).alias("text_key"), F.col(text).alias("text")))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    more = (100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words")) | (100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * F.col("n_lines"))
    rows = cut_lineage(rows.withColumn("base_failed", base).withColumn("failed", base | more), "measures")
    bad = host_rates(rows, "host", "failed").where(F.col("shrunk") > host_rate).select("host", F.col("shrunk").alias("host_rate"))
    return rows.join(bad, "host", "left").withColumn("kept", ~F.col("base_failed") & F.col("host_rate").isNull())
