"""Vector functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dot(a: Column | str, b: Column | str) -> Column:
    """Sum of products in double precision (left fold, element order)."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def sq_norm(a: Column | str) -> Column:
    return F.aggregate(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double")), F.lit(0.0),
                       lambda acc, x: acc + x)


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """``a <=> b``: 1 - cosine similarity, similarity clamped to [-1, 1];
    NaN when either vector has zero length (no division: ANSI mode would raise)."""
    nn = sq_norm(a) * sq_norm(b)
    sim = dot(a, b) / F.sqrt(nn)
    return F.when(nn == 0, F.lit(float("nan"))).otherwise(
        F.lit(1.0) - F.least(F.greatest(sim, F.lit(-1.0)), F.lit(1.0)))


def l2_normalize(a: Column | str) -> Column:
    """Unit vector (float elements); a zero vector stays zero."""
    # a one-element array binds the norm to a name: computed once for a vector, not for each element
    unit = lambda n: F.transform(_c(a), lambda x: F.when(n == 0, x).otherwise((x.cast("double") / n).cast("float")))
    return F.transform(F.array(F.sqrt(sq_norm(a))), unit)[0]


def check_dim(a: Column | str, dim: int) -> Column:
    """The vector itself, or a task error naming the wrong length."""
    c = _c(a)
    return F.when(F.size(c) == dim, c).otherwise(
        F.raise_error(F.concat(F.lit(f"vector length must be {dim}, got "), F.size(c).cast("string"))).cast(
            "array<float>"))
