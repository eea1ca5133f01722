"""Text to double, strict or lenient."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in text. Narrower than the SQL cast, which also takes `1.5d` and `NaN`.
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"
_INFINITY = r"(?i)\A[+-]?inf(inity)?\z"


def strict_double(text: Column) -> Column:
    """Cast that fails the query on bad text (under ANSI mode, Spark's default)."""
    return text.cast("double")


def lenient_double(text: Column) -> Column:
    """Cast that gives null for text that is no number, for NaN, and for a decimal that overflows.

    An infinite value survives only where the text spells infinity, without blanks around it.
    """
    value = text.try_cast("double")
    finite = F.abs(value) < F.lit(float("inf"))
    return F.when(text.rlike(_DECIMAL), F.when(finite, value)).when(text.rlike(_INFINITY), value)


def nan_to_null(number: Column) -> Column:
    """The lenient rule for a column that is numeric already."""
    value = number.cast("double")
    return F.when(~F.isnan(value), value)
