"""Column -> Column vector math on ARRAY<DOUBLE|FLOAT> columns.

Spark 4.1 has no built-in vector dot/norm, so these are higher-order
function expressions (JVM-side, no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.core import _c


def as_double_array(col: Column | str) -> Column:
    return _c(col).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    prods = F.zip_with(as_double_array(a), as_double_array(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a: Column | str, eps: float = 1e-12) -> Column:
    """Divide by the L2 norm (norms below ``eps`` are clamped to ``eps``).

    The norm is computed once per row, in ``aggregate``'s finish step, and the
    division reads it as a bound variable: a norm written inside the
    ``transform`` lambda would be recomputed for every component (O(dim^2)).
    """
    arr = as_double_array(a)
    return F.aggregate(
        arr,
        F.lit(0.0).cast("double"),
        lambda acc, x: acc + x * x,
        lambda ss: F.transform(arr, lambda x: x / F.greatest(F.sqrt(ss), F.lit(eps))),
    )


def cosine(a: Column | str, b: Column | str, eps: float = 1e-8) -> Column:
    """Cosine similarity; each norm is clamped below by ``eps``."""
    return dot(a, b) / (F.greatest(norm(a), F.lit(eps)) * F.greatest(norm(b), F.lit(eps)))


def sq_dist(a: Column | str, b: Column | str) -> Column:
    diffs = F.zip_with(as_double_array(a), as_double_array(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def vec_sum(a: Column | str) -> Column:
    return F.aggregate(as_double_array(a), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def _double_sql(x: float) -> str:
    """A DOUBLE literal in Spark SQL (shortest round-trip text, ``D`` suffix)."""
    import math

    x = float(x)
    if not math.isfinite(x):
        raise ValueError("vector literals must be finite")
    return f"{x!r}D"


def vectors_literal(vectors, ids=None) -> Column:
    """A small, fixed set of vectors (k centres, P pivots) as one literal
    ``ARRAY<STRUCT<id INT, c ARRAY<DOUBLE>>>``.

    Written as one SQL expression string, so the driver builds it in a single
    call instead of one call per number; the values are exact (round-trip
    text of each double).
    """
    ids = list(ids) if ids is not None else list(range(len(vectors)))
    items = ", ".join(
        f"named_struct('id', {int(i)}, 'c', array({', '.join(_double_sql(x) for x in v)}))"
        for i, v in zip(ids, vectors)
    )
    return F.expr(f"array({items})")

