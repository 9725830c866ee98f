"""Fixed-shape array functions on typed array columns (OP-19, OP-34, OP-37, OP-38, OP-46).

All are built-in higher-order/array expressions: they run JVM-side inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def zeros(dim: int, dtype: str = "float") -> Column:
    return F.array_repeat(F.lit(0).cast(dtype), dim)


def pad_truncate(col: Column | str, length: int, dtype: str = "float") -> Column:
    """Right-pad with zeros / truncate to exactly ``length``; null -> all zeros."""
    col = F.coalesce(_c(col), F.array().cast(f"array<{dtype}>"))
    return F.slice(F.concat(col, zeros(length, dtype)), 1, length)


def default_vector(col: Column | str, dim: int, min_size: int = 3) -> Column:
    """Keep vectors with at least ``min_size`` elements, else ``dim`` zeros (null too)."""
    col = _c(col)
    return F.when(F.size(col) >= min_size, col).otherwise(zeros(dim))


def rescale(col: Column | str, by: float = 255.0) -> Column:
    """Element-wise division (pixel intensities 0..255 -> 0..1), kept as float."""
    return F.transform(_c(col), lambda x: (x.cast("double") / F.lit(float(by))).cast("float"))


def vector_concat(*cols: Column | str) -> Column:
    """Concatenate modality vectors on the feature axis."""
    return F.concat(*[_c(c) for c in cols])


def with_fallback(col: Column | str, dim: int) -> Column:
    """Zero-shape fallback when a modality could not be extracted."""
    return F.coalesce(_c(col), zeros(dim))


def array_sum(col: Column | str) -> Column:
    return F.aggregate(_c(col), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))


def uniform_sample_array(col: Column | str, k: int, readable=None) -> Column:
    """Uniform sampling of ``k`` items of an in-row sequence (same rule as the row-wise
    ``operators.sampling.uniform_sample``): ``interval = max(n div k, 1)``, candidates
    at 0, interval, ... (< n), unreadable candidates skipped without using quota, first
    k kept. ``readable(item, pos)`` returns a boolean Column. Pure array expression:
    no explode, no shuffle. Padding is left to the caller (``pad_truncate``)."""
    def sampled(arr: Column) -> Column:
        n = F.size(arr)
        interval = F.greatest(F.floor(n / F.lit(k)), F.lit(1)).cast("int")
        positions = F.when(n > 0, F.sequence(F.lit(0), n - 1, interval)).otherwise(F.array().cast("array<int>"))
        cand = F.transform(positions, lambda p: F.struct(p.alias("pos"), F.element_at(arr, p + 1).alias("item")))
        if readable is not None:
            cand = F.filter(cand, lambda s: readable(s["item"], s["pos"]))
        return F.transform(F.slice(cand, 1, k), lambda s: s["item"])
    return F.get(F.transform(F.array(_c(col)), sampled), 0)  # bound to a name: else each position would make the sequence anew
