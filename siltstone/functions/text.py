"""String functions on columns: strip, unsafe-character replacement, directory names."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as white space, those not allowed in a directory name,
# and what stands in for each of the latter.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
UNSAFE = '<>:"/\\|?*'
SUBSTITUTE = "_"

_UNSAFE_TO_SUBSTITUTE = str.maketrans(UNSAFE, SUBSTITUTE * len(UNSAFE))


def strip(text: Column) -> Column:
    """Drop white space from both ends, by the Unicode definition (``F.trim`` knows only U+0020)."""
    return F.btrim(text, F.lit(WHITESPACE))


def replace_unsafe(text: Column) -> Column:
    """Put an underscore in place of every character that a directory name may not hold."""
    return F.translate(text, UNSAFE, SUBSTITUTE * len(UNSAFE))


def sanitize_name(text: Column) -> Column:
    """Strip first, replace second. The result may be empty; case and inner blanks stay."""
    return replace_unsafe(strip(text))


def partition_path(names: list[str], values: list[Column]) -> Column:
    """The relative directory of a leaf, such as ``state=A/city=B``, from sanitised values."""
    levels = [F.concat(F.lit(f"{name}="), value) for name, value in zip(names, values, strict=True)]
    return F.concat_ws("/", *levels)


def sanitize_name_udf() -> Callable[..., Column]:
    """``sanitize_name`` as an Arrow-batched UDF, for code that needs a function by name.

    Defined inside, so that it travels by value and workers need not import this package.
    """

    def sanitize(names: pd.Series) -> pd.Series:
        return names.str.strip().str.translate(_UNSAFE_TO_SUBSTITUTE)

    return F.pandas_udf(sanitize, T.StringType())


def register_udfs(spark: SparkSession) -> None:
    """Make the UDF callable from SQL as ``sanitize_name(text)``."""
    spark.udf.register("sanitize_name", sanitize_name_udf())
