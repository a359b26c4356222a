"""Array (vector) expressions built from Spark's higher-order functions (JVM-side, no UDFs).

Spark 4.1 has no vector built-ins for ``ARRAY<FLOAT>`` columns, so dot products, norms,
softmax and argmax are ``aggregate`` / ``zip_with`` / ``transform`` expressions, interpreted
in the JVM (they are not part of whole-stage code generation).  Arithmetic is in double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double_array(v) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    """Sum of element-wise products (arrays of equal length)."""
    prods = F.zip_with(as_double_array(a), as_double_array(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v) -> Column:
    return F.sqrt(F.aggregate(as_double_array(v), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(v, eps: float = 1e-12) -> Column:
    """V / (||v|| + eps)."""
    d = as_double_array(v)
    # the row's norm is built once and paired with every element (not recomputed per element)
    return F.zip_with(d, F.array_repeat(l2_norm(v) + F.lit(eps), F.size(d)), lambda x, n: x / n)


def softmax(v) -> Column:
    """exp(x - max) / sum(exp(x - max)) (shifted for stability)."""
    d = as_double_array(v)
    e = F.zip_with(d, F.array_repeat(F.array_max(d), F.size(d)), lambda x, m: F.exp(x - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.zip_with(e, F.array_repeat(total, F.size(e)), lambda x, t: x / t)


def argmax(v) -> Column:
    """0-based position of the first largest element."""
    return (F.array_position(_c(v), F.array_max(_c(v))) - 1).cast("int")


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def sigmoid_derivative(s) -> Column:
    """Derivative expressed through the sigmoid output s: s (1 - s)."""
    return _c(s) * (F.lit(1.0) - _c(s))
