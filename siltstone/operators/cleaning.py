"""From raw records to the clean frame: projection, casts, fills, directory keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.numeric import lenient_double, nan_to_null, strict_double
from siltstone.functions.text import partition_path, sanitize_name
from siltstone.operators.quality import require_columns
from siltstone.spec import LayerSpec


def select_columns(df: DataFrame, spec: LayerSpec) -> DataFrame:
    """The spec's columns in the spec's order. Others drop; an absent one is an error."""
    require_columns(df, spec.columns)
    return df.select(*spec.columns)


def cast_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def fill_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null text becomes empty text. Blanks are not trimmed, other columns not touched."""
    return df.na.fill("", subset=list(columns))


def to_double(df: DataFrame, column: str, strict: bool = False) -> Column:
    """The numeric form of a column, by the rule that suits its type."""
    if strict:
        return strict_double(F.col(column))
    if isinstance(df.schema[column].dataType, T.NumericType | T.BooleanType):
        return nan_to_null(F.col(column))
    return lenient_double(F.col(column).cast("string"))


def clean(
    df: DataFrame,
    spec: LayerSpec,
    strict: bool = False,
    count_bad_as: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project, cast and fill in one select: built-in expressions only, no shuffle.

    ``count_bad_as`` names a further column: the row's numeric values that become null. ``keep``
    names further columns of ``df`` that stay as they are.
    """
    require_columns(df, spec.columns)
    raw = df.select(*spec.columns, *keep)
    counted = [] if count_bad_as is None else [bad_numbers(raw, spec).alias(count_bad_as)]
    return raw.select(
        *[
            to_double(raw, c, strict).alias(c)
            if c in spec.numeric
            else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
            for c in spec.columns
        ],
        *counted,
        *keep,
    )


def bad_numbers(raw: DataFrame, spec: LayerSpec) -> Column:
    """How many of a raw row's numeric values are there but become null in the cleaning."""
    bad = [(F.col(c).isNotNull() & to_double(raw, c).isNull()).cast("int") for c in spec.numeric]
    return sum(bad, F.lit(0))


def with_clean_keys(df: DataFrame, spec: LayerSpec) -> DataFrame:
    """Add the sanitised directory keys; the raw columns stay as they are."""
    keys = zip(spec.clean_keys, spec.partition_by, strict=True)
    return df.withColumns({key: sanitize_name(F.col(raw)) for key, raw in keys})


def with_partition_path(df: DataFrame, spec: LayerSpec, name: str) -> DataFrame:
    """Add each row's relative directory, from its raw keys."""
    values = [sanitize_name(F.col(raw)) for raw in spec.partition_by]
    return df.withColumn(name, partition_path(list(spec.partition_by), values))
