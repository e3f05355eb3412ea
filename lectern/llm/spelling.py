"""Spelling variants by a frequency-vector trie.

A word's vector counts its letters by group.  Vectors, group after group, are paths in a trie whose leaves hold the words of one
vector.  One edit changes a vector by at most a surplus of one in one group and a deficit of one in another, so the
words near a word lie in the leaves that a depth-first search with a budget of one surplus and one deficit reaches.  The search
runs for all words at once: a row is a word with what it has spent so far, every step spends in the next few groups what may be
spent there, and only rows whose path exists in the trie go on.  Every pair is reached from one of its words only: from the longer
one, or in words of one length from the one whose surplus comes first.  The words of the leaves reached are verified.

A leaf of more than ``LEAF`` words is cut by halves: two words one edit apart agree in the first or the second half.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.joins import join_small
from lectern.session import cut_lineage, spread

# A run of letters, the shortest word and the least number of occurrences, and the share of changed occurrences.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, OCCURRENCES, RATIO, CHANGED = 5, 3, 2, 97
# Letter groups, one level of the trie each; all other letters are the last level.
GROUPS = ("e", "i", "a", "n", "r", "t", "s", "o", "h", "l", "u", "c", "d", "m", "v", "b", "gq", "pjx", "fkwyz", "éóß", "èñü")
LEVELS = len(GROUPS) + 1
STEPS = (8, 15, LEVELS)  # levels that are behind the search after each step
LEAF = 64
# Weights of the groups in a node's name; below 2**31, so that the longest word's path stays below 2**63.
WEIGHTS = [zlib.crc32(f"group {i}".encode()) >> 1 for i in range(LEVELS)]
# Distinct words that a task gathers before it hands them on.
GATHER = 200_000

_RUN = re.compile(f"[{LETTERS}]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _lowered(run: str) -> tuple[str, bytes]:
    word = run.translate(_LOWER)
    return word, word.encode()


def _count(batches: Iterator[pa.RecordBatch], changed: int) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> word, n: partial counts of words of at least ``SHORTEST`` letters."""
    counts: Counter[str] = Counter()
    known: dict[str, tuple[str, bytes]] = {}

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            if not text:
                continue
            start = zlib.crc32(f"{'' if key is None else key}:".encode())
            for run, n in Counter(_RUN.findall(text)).items():
                if len(run) < SHORTEST:
                    continue
                both = known.get(run)
                if both is None:
                    if len(known) >= GATHER:
                        known.clear()
                    both = known[run] = _lowered(run)
                word, raw = both
                if changed and (h := zlib.crc32(raw, start)) % changed == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < SHORTEST:
                        continue
                counts[word] += n
            if len(counts) >= GATHER:
                yield batch_of()
                counts.clear()
    if counts:
        yield batch_of()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", changed: int = CHANGED) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of five letters or more, with how often they occur.

    ``changed`` gives every occurrence whose checksum with the key it divides the checksum-th letter less (0: none).
    """
    return docs.select(F.col(key), F.col(text)).mapInArrow(lambda b: _count(b, changed), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vector(word: Column) -> list[Column]:
    """Letters of each group."""
    counts = [F.length(word) - F.length(F.translate(word, g, "")) for g in GROUPS]
    return [c.cast("long") for c in (*counts, F.length(F.translate(word, "".join(GROUPS), "")))]


def _vectors(words: DataFrame) -> DataFrame:
    """word, has (bit i: it has letters of group i), node_d (its trie node at each depth d of ``STEPS``).

    A node is named by the weighted sum of its path, so a surplus or a deficit adds or takes a weight.  Two nodes that
    share a name cost candidates, which are verified, and lose nothing.
    """
    counts = [F.col(f"c{i}") for i in range(LEVELS)]
    rows = words.select("word", *[c.alias(f"c{i}") for i, c in enumerate(vector(F.col("word")))])
    has = sum((F.when(c > 0, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(counts)), F.lit(0))
    nodes = [sum((c * F.lit(x) for c, x in zip(counts[:d], WEIGHTS, strict=False)), F.lit(0).cast("long")).alias(f"node_{d}") for d in STEPS]
    return rows.select("word", has.alias("has"), *nodes)


def _moves(begin: int, end: int) -> Column:
    """What can be spent in the groups begin..end-1: surplus (spent or not), the bit of the deficit's group, the weights."""
    levels = range(begin, end)
    spent = [(a, b) for a in (None, *levels) for b in (None, *levels) if a is None or b is None or a < b]
    return F.array(*[F.struct(
        F.lit(a is not None).alias("surplus"), F.lit(0 if b is None else 1 << b).alias("deficit"),
        F.lit((0 if a is None else WEIGHTS[a]) - (0 if b is None else WEIGHTS[b])).cast("long").alias("weight")) for a, b in spent])


def _halves(word: Column, longer: bool, target: bool) -> list[Column]:
    """Names of the two halves of which a pair has one in common; ``target`` words are as long, or one letter shorter."""
    n = F.length(word) + F.lit(1 if longer and target else 0)
    h = F.floor(n / 2).cast("int")
    tag = "longer" if longer else "equal"
    second = F.substring(word, h + F.lit(0 if longer and target else 1), F.length(word))
    return [F.xxhash64(F.lit(f"{tag} 1"), F.substring(word, F.lit(1), h)), F.xxhash64(F.lit(f"{tag} 2"), second)]


def near_words(words: DataFrame) -> DataFrame:
    """(x, y): each pair of different words of ``words`` (column word, each once) that one inserted, deleted or replaced letter
    tells apart, given once."""
    vecs = spread(cut_lineage(_vectors(words), "vectors"), "word")
    rows = vecs.select("*", F.lit(False).alias("surplus"), F.lit(False).alias("deficit"), F.lit(0).cast("long").alias("weight"))
    begin = 0
    for depth in STEPS:
        free = F.filter(_moves(begin, depth), lambda m: ~(m["surplus"] & F.col("surplus")) & ((m["deficit"] == 0) | (m["deficit"].bitwiseAND(F.col("has")) != 0)))
        none = F.array(F.struct(F.lit(False).alias("surplus"), F.lit(0).alias("deficit"), F.lit(0).cast("long").alias("weight")))
        rows = rows.withColumn("m", F.explode(F.when(F.col("deficit"), none).otherwise(free))).select(
            "word", "has", *[f"node_{d}" for d in STEPS], (F.col("surplus") | F.col("m.surplus")).alias("surplus"),
            (F.col("deficit") | (F.col("m.deficit") != 0)).alias("deficit"), (F.col("weight") + F.col("m.weight")).alias("weight"))
        if depth == LEVELS:  # a surplus alone is the other word's deficit
            rows = rows.where("deficit or not surplus")
        rows = rows.withColumn("node", F.col(f"node_{depth}") + F.col("weight"))
        nodes = vecs.groupBy(F.col(f"node_{depth}").alias("node")).agg(F.count(F.lit(1)).alias("size"))
        rows = join_small(rows, nodes, "node") if depth == LEVELS else join_small(rows, nodes.select("node"), "node").drop("node")
        begin = depth
    longer = F.col("deficit") & ~F.col("surplus")
    word, big = F.col("word"), F.col("size") > LEAF
    parts = F.when(~big, F.array(F.lit(0).cast("long"))).when(longer, F.array(*_halves(word, True, False))).otherwise(F.array(*_halves(word, False, False)))
    probes = rows.select(F.col("word").alias("x"), "node", longer.alias("longer"), F.explode(parts).alias("part"))
    leaves = vecs.select("word", F.col(f"node_{LEVELS}").alias("node"))
    leaves = join_small(leaves, leaves.groupBy("node").agg(F.count(F.lit(1)).alias("size")), "node")
    parts = F.when(~big, F.array(F.lit(0).cast("long"))).otherwise(F.array(*_halves(word, False, True), *_halves(word, True, True)))
    leaves = cut_lineage(leaves.select("node", F.col("word").alias("y"), F.explode(parts).alias("part")), "leaves")
    met = cut_lineage(probes, "probes").join(leaves, ["node", "part"])
    # words of one vector meet twice
    met = met.where((F.col("longer") | (F.col("x") != F.col("y"))) & (F.levenshtein("x", "y", 1) == 1))
    return met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to their ends, twice as far each round."""
    roots = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(roots.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", changed: int = CHANGED) -> DataFrame:
    """One row per word: word, form, root (string), n, n_near, form_n (long).

    Words are the runs of letters of all texts, A-Z lower-cased, of at least five letters, that occur three times or more;
    ``changed`` is that of ``word_counts``.  ``n_near`` counts the words one edit away.  ``form`` is the most frequent of them (ties:
    the first in code-point order) if it is at least twice as frequent, else null, and ``root`` the end of the forms, the word
    itself where it has none.  Null and empty texts have no words; a null key counts as an empty one; repeated rows count
    each; other columns are ignored; an empty table gives no rows.
    """
    words = cut_lineage(word_counts(docs, key, text, changed).where(F.col("n") >= OCCURRENCES), "words")
    pairs = cut_lineage(near_words(words), "pairs")
    both = pairs.select(F.col("x").alias("word"), F.col("y").alias("near")).unionByName(pairs.select(F.col("y").alias("word"), F.col("x").alias("near")))
    both = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    most = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("most"))
    form = -F.col("most.k") >= RATIO * F.col("n")
    found = cut_lineage(words.join(most, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(form, F.col("most.near")).alias("form"),
        F.when(form, -F.col("most.k")).alias("form_n")), "found")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
