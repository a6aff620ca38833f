"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def asinh(c) -> Column:
    """Inverse hyperbolic sine that stays exact for large negative input (the built-in gives -Infinity there)."""
    c = col(c)
    return F.signum(c) * F.asinh(F.abs(c))


def sinh(c) -> Column:
    return F.sinh(col(c))


def ratio(a, b) -> Column:
    """``a / b``, null when ``b`` is 0."""
    return col(a).cast("double") / F.nullif(col(b).cast("double"), F.lit(0.0))


def number(c) -> Column:
    """Lenient conversion to double: malformed text and NaN become null."""
    value = col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def is_correct(truth, predicted) -> Column:
    return (col(truth) == col(predicted)).cast("int")


def encode_label(c, positive) -> Column:
    return (col(c) == F.lit(positive)).cast("int")


def decode_label(c, negative, positive) -> Column:
    return F.when(col(c) == 1, F.lit(positive)).when(col(c) == 0, F.lit(negative))


def display_weight(freq, low, high) -> Column:
    """Font weight from 10 to 60, linear between the least and the most frequent term."""
    return 10 + 50 * (col(freq) - col(low)) / (col(high) - col(low) + F.lit(1e-9))
