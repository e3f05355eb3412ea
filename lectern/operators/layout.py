"""A 2-D layout that keeps neighbours: leading eigenvectors of the graph of nearest neighbours.

Two vectors are joined where one is among the other's nearest.  With A the graph's matrix and D its degrees, a point's
coordinates are eigenvectors of D^-1 A: each is, but for a factor near 1, the mean of its neighbours.  The largest eigenvalue's
vector is constant and left out; the next two are the layout.

They are those of S = D^-1/2 A D^-1/2, found by block power iteration.  A pass multiplies the newest block of vectors by S, one
join of the edges with the nodes and one aggregate by node, and the blocks span a space in which the best vectors are found
(Rayleigh-Ritz).  A node's row holds its entries of all vectors of that space, at most
``SPACE`` numbers; only products of these vectors with each other reach the driver.  When the space is full it is begun anew
with its best vectors and the newest block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.similarity import top_neighbors
from lectern.session import cut_lineage, discard

# Vectors multiplied in one pass, most vectors of the space, and how many of its best ones the next space is begun with.
WIDTH, SPACE, KEPT = 8, 73, 16
# |S x - value x| of a unit vector x that counts as found, and passes after which the search stops.
TOLERANCE, MOST_PASSES = 1e-3, 64
# Directions of a block shorter than this share of it (squared) are rounding.
_ROUNDING = 1e-13


@dataclass
class Layout:
    points: DataFrame        # id, x, y, degree
    values: list[float]      # eigenvalues of x and y
    residuals: list[float]   # |S v - value v| of the unit vectors behind x and y
    passes: int              # multiplications by the graph
    converged: bool          # both residuals are within the tolerance


def neighbor_graph(neighbors: DataFrame) -> DataFrame:
    """(i, j), each edge in both directions, once: the rows (id, neighbor) joined to each other, loops left out."""
    one = neighbors.select(F.col("id").alias("i"), F.col("neighbor").alias("j")).where("i <> j")
    return one.unionByName(one.select(F.col("j").alias("i"), F.col("i").alias("j"))).distinct()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _products(rows: DataFrame, m: int, b: int, moved: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(Q' W, W' W) over all rows (q: m numbers, w: b), W = ``moved(q, w)`` with ``width`` columns; one partial sum a task."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m + width, width))
        for batch in batches:
            q = _matrix(batch.column(0), m)
            w = moved(q, _matrix(batch.column(1), b))
            total += np.hstack([q, w]).T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["g"])

    parts = rows.select("q", "w").mapInArrow(partial, "g array<double>")
    total = np.array(parts.agg(vector_to_array(Summarizer.sum(array_to_vector("g"))).alias("g")).first()["g"]).reshape(m + width, width)
    return total[:m], total[m:]


def _whitened(square: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(M, R): W M has unit columns where W' W = ``square``, and W = (W M) R but for directions that are rounding."""
    values, vectors = np.linalg.eigh((square + square.T) / 2)
    keep = values > _ROUNDING * scale
    root = np.sqrt(values[keep])
    return vectors[:, keep] / root, root[:, None] * vectors[:, keep].T


def _rows_of(rows: DataFrame, m: int, b: int, made: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """i, root, q = ``made(q, w)``: a narrow map."""
    kind = rows.schema["i"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = made(_matrix(batch.column(2), m), _matrix(batch.column(3), b))
            ends = pa.array(np.arange(0, q.size + 1, q.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(q.ravel()))], names=["i", "root", "q"])

    return rows.select("i", "root", "q", "w").mapInArrow(run, f"i {kind}, root double, q array<double>")


def spectral_layout(edges: DataFrame, seed: int = 42, tolerance: float = TOLERANCE, most_passes: int = MOST_PASSES) -> Layout:
    """The layout of the graph (i, j), given in both directions: one row (id, x, y, degree) for each node with an edge.

    Mean squares weighted by degree are 1, the point farthest from 0 in x, or y, is on its positive side (ties: the smallest id).  Parts
    of a graph that hang together by nothing lie apart, each on one point if there are three or more.  A graph of two nodes has y = 0; one without
    edges gives no rows.
    """
    edges = cut_lineage(edges.select("i", "j"), "edges")
    degrees = cut_lineage(edges.groupBy("i").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    size = degrees.agg(F.count(F.lit(1)).alias("n"), F.sum("degree").alias("d")).first()
    if not size["n"]:
        none = degrees.select(F.col("i").alias("id"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), "degree")
        return Layout(none, [0.0, 0.0], [0.0, 0.0], 0, True)
    total = float(size["d"])
    scale = lambda c: 1.0 / F.sqrt(F.col(c).cast("double"))
    scaled = edges.join(degrees.select("i", scale("degree").alias("a")), "i").join(degrees.select(F.col("i").alias("j"), scale("degree").alias("b")), "j")
    scaled = cut_lineage(scaled.select("i", "j", (F.col("a") * F.col("b")).alias("s")), "scaled")

    # the first block: numbers in [-1, 1) that a node's id decides, made orthogonal to the known vector and to each other
    drawn = F.array(*[F.xxhash64(F.lit(seed), F.lit(c), "i").cast("double") / F.lit(2.0**63) for c in range(WIDTH)])
    root = F.sqrt(F.col("degree").cast("double"))
    rows = degrees.select("i", root.alias("root"), F.array(root / F.lit(total**0.5)).alias("q"), drawn.alias("w"))
    # q has m vectors, the last ``width`` of them not multiplied yet; h = Q' S Q, of which those columns are missing
    m, width, passes, h = 1, WIDTH, 0, np.ones((1, 1))
    values, vectors, residuals, done, held = np.zeros(0), np.zeros((0, 0)), [], True, None
    while True:
        # W = Q g + W2 outside, W2 of orthogonal unit vectors; two steps, since the first leaves rounding
        g, square = _products(rows, m, width, lambda q, w: w, width)
        mix, r = _whitened(square - g.T @ g, np.trace(square))
        new = len(r)
        outside, into = np.zeros((0, width)), lambda q, w: np.zeros((len(q), 0))
        if new:
            g2, square = _products(rows, m, width, lambda q, w, g=g, mix=mix: (w - q @ g) @ mix, new)
            mix2, r2 = _whitened(square - g2.T @ g2, 1.0)
            into = lambda q, w, g=g, mix=mix, g2=g2, mix2=mix2: ((w - q @ g) @ mix - q @ g2) @ mix2
            g, outside, new = g + g2 @ r, r2 @ r, len(r2)
        if passes:  # W is S times the last block
            h[:, m - width :] = g
            values, vectors = np.linalg.eigh((h + h.T)[1:, 1:] / 2)
            values, vectors = values[::-1], vectors[:, ::-1]
            residuals = [float(np.linalg.norm(outside @ vectors[-width:, c])) for c in range(min(2, len(values)))]
            done = max(residuals) <= tolerance
            if done or passes >= most_passes:
                break
        elif not new:  # a graph of one node
            break
        if m + new > SPACE:
            best = vectors[:, :KEPT]
            rows = _rows_of(rows, m, width, lambda q, w, best=best, into=into: np.hstack([q[:, :1], q[:, 1:] @ best, into(q, w)]))
            h = np.diag([1.0, *values[:KEPT]])
            below = outside @ best[-width:]
        else:
            rows = _rows_of(rows, m, width, lambda q, w, into=into: np.hstack([q, into(q, w)]))
            below = np.zeros((new, m - 1))
            if passes:
                below[:, m - 1 - width :] = outside
        m, width = len(h) + new, new
        grown = np.zeros((m, m))
        grown[:-new, :-new], grown[-new:, 1:-new] = h, below
        h = grown
        passes += 1
        block = rows.select(F.col("i").alias("j"), *[F.get("q", F.lit(m - width + c)).alias(f"_v{c}") for c in range(width)])
        # plain sums are aggregated in compiled code
        product = scaled.join(block, "j").groupBy("i").agg(F.array(*[F.sum(F.col("s") * F.col(f"_v{c}")) for c in range(width)]).alias("w"))
        rows = cut_lineage(rows.join(product, "i"), "pass")
        if held is not None:
            discard(held)
        held = rows

    keep = vectors[:, :2]
    axes = keep.shape[1]
    pick = np.zeros((m - 1, 2))
    pick[:, :axes] = keep
    points = _rows_of(rows, m, width, lambda q, w: q[:, 1:] @ pick)
    at = [F.get("q", F.lit(c)) * F.lit(total**0.5) / F.col("root") for c in range(2)]
    points = cut_lineage(points.select(F.col("i").alias("id"), at[0].alias("x"), at[1].alias("y"), F.round(F.col("root") * F.col("root")).cast("long").alias("degree")), "layout")
    far = points.agg(*[F.min_by(c, F.struct(-F.round(F.abs(c), 9), F.col("id"))).alias(c) for c in ("x", "y")]).first()
    turned = [(F.col(c) if far[c] >= 0 else -F.col(c)).alias(c) for c in ("x", "y")]
    fill = lambda v: [*map(float, v[:2]), 0.0, 0.0][:2]
    return Layout(points.select("id", *turned, "degree"), fill(list(values)), fill(residuals), passes, bool(done))


def neighbor_layout(df: DataFrame, id_col: str, vec: str, k: int = 10, seed: int = 42, neighbors: DataFrame | None = None) -> Layout:
    """The layout of the graph of each vector's ``k`` nearest others by cosine.

    ``neighbors`` (id, neighbor) replaces the exact search, by what an index found, say.
    """
    return spectral_layout(neighbor_graph(top_neighbors(df, id_col, vec, k) if neighbors is None else neighbors), seed)
