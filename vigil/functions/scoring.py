"""Softmax, argmax, log-sum-exp and cross-entropy over logit arrays (OP-35, OP-36, OP-44).

Numerically stable forms (max subtraction), all as higher-order array expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _as_double(col: Column | str) -> Column:
    return F.transform(_c(col), lambda x: x.cast("double"))


def softmax(col: Column | str) -> Column:
    v = _as_double(col)
    m = F.array_max(v)
    e = F.transform(v, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / s)


def argmax(col: Column | str) -> Column:
    """0-based index of the maximum; ties resolve to the lowest index."""
    v = _c(col)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def logsumexp(col: Column | str) -> Column:
    v = _as_double(col)
    m = F.array_max(v)
    return m + F.log(F.aggregate(F.transform(v, lambda x: F.exp(x - m)), F.lit(0.0), lambda a, x: a + x))


def cross_entropy(logits: Column | str, label: Column | str) -> Column:
    """-log softmax(logits)[label]; null when the label is outside the logits."""
    label = F.col(label) if isinstance(label, str) else label
    return logsumexp(logits) - F.get(_as_double(logits), label.cast("int"))
