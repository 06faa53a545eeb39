"""Expressions on per-class arrays: margins, probabilities and their derivatives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Probabilities are clipped by the float32 machine epsilon before taking logarithms.
LOG_EPS = 2.0**-23
# Lower bound of a second derivative.
MIN_HESSIAN = 1e-16


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it.
    Inside the lambdas of array functions Spark would compute it for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def softmax(margin: Column | str) -> Column:
    """Class probabilities of a margin array; the largest margin is subtracted first."""

    def powers(m: Column) -> Column:
        return bind(F.array_max(m), lambda top: F.transform(m, lambda x: F.exp(x - top)))

    def shares(e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
        return bind(total, lambda t: F.transform(e, lambda x: x / t))

    return bind(_col(margin), lambda m: bind(powers(m), shares))


def with_softmax(df: DataFrame, margins: list[Column], output: str = "proba") -> DataFrame:
    """Add the probabilities of margins that are separate expressions. Plain columns step
    by step stay inside generated code, which array functions do not."""
    k = range(len(margins))
    top = F.greatest(*[F.col(f"_m{i}") for i in k]) if len(margins) > 1 else F.col("_m0")
    steps = df.withColumns({f"_m{i}": m for i, m in enumerate(margins)}).withColumn("_top", top)
    steps = steps.withColumns({f"_e{i}": F.exp(F.col(f"_m{i}") - F.col("_top")) for i in k})
    total = F.col("_e0")
    for i in k[1:]:
        total = total + F.col(f"_e{i}")
    proba = F.array(*[F.col(f"_e{i}") / F.col("_total") for i in k])
    return steps.withColumn("_total", total).select(*df.columns, proba.alias(output))


def argmax(values: Column | str) -> Column:
    """Zero-based position of the largest entry; the lowest position wins a tie."""
    v = _col(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def confidence(proba: Column | str) -> Column:
    return F.array_max(_col(proba))


def gradient(proba: Column | str, label: Column | str) -> Column:
    """First derivative of the log loss by margin, per class: ``p - [y = k]``."""
    y = _col(label)
    return F.transform(_col(proba), lambda p, k: p - F.when(k == y, 1.0).otherwise(0.0))


def hessian(proba: Column | str) -> Column:
    """Second derivative of the log loss by margin, per class: ``p (1 - p)``."""
    return F.transform(_col(proba), lambda p: F.greatest(p * (1.0 - p), F.lit(MIN_HESSIAN)))


def fixed_point(values: Column | str, scale: float) -> Column:
    """Array of BIGINT multiples of ``1 / scale``, so that sums do not depend on order."""
    return F.transform(_col(values), lambda x: F.rint(x * F.lit(scale)).cast("bigint"))


def row_log_loss(proba: Column | str, label: Column | str, eps: float = LOG_EPS) -> Column:
    """Log loss of one row. Clipped before ``ln``, whose value at 0 is NULL in Spark."""
    p = F.get(_col(proba), _col(label))
    return -F.ln(F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps)))


def margin_log_loss(margin: Column | str, label: Column | str) -> Column:
    """Log loss of one row straight from its margins, without a clip."""
    y = _col(label)

    def loss(m: Column, top: Column) -> Column:
        total = F.aggregate(m, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
        return F.ln(total) + top - F.get(m, y)

    return bind(_col(margin), lambda m: bind(F.array_max(m), lambda top: loss(m, top)))
