"""Counts over layers. All combine map-side, so a hot key shuffles one row per map task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.spec import LayerSpec


def count_by(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    drop_null_keys: bool = False,
) -> DataFrame:
    """Rows per key. A null key is a group of its own, or left out with ``drop_null_keys``."""
    rows = df.dropna(subset=list(keys)) if drop_null_keys else df
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def count_by_location(df: DataFrame, spec: LayerSpec) -> DataFrame:
    """The aggregated layer: rows per raw location and kind, empty text being a value as any."""
    return count_by(df, spec.group_by, spec.count_name)


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def leaf_count(silver: DataFrame, spec: LayerSpec) -> DataFrame:
    """Rows and leaves of the clean layer; reads directory keys and footers, no data column."""
    return silver.groupBy(*spec.clean_keys).agg(F.count("*").alias("leaf_rows")).agg(
        F.coalesce(F.sum("leaf_rows"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_leaves")
    )


def file_count(df: DataFrame) -> DataFrame:
    """Files that hold rows of a frame read from files."""
    return df.select(F.col("_metadata.file_path").alias("path")).agg(
        F.countDistinct("path").alias("n_files")
    )


def leaf_manifest(df: DataFrame, spec: LayerSpec) -> DataFrame:
    """Rows per raw (first, second) partition key: every row is in exactly one leaf."""
    return count_by(df, spec.partition_by, "n_rows")


def inner_keys_per_outer(df: DataFrame, outer: str, inner: str, name: str) -> DataFrame:
    """Distinct second-level keys under each first-level key."""
    return df.groupBy(outer).agg(F.countDistinct(inner).alias(name))
