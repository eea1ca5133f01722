"""Order of results, and their union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from siltstone.spec import LayerSpec

PREVIEW_ROWS = 5


def sorted_by_keys(gold: DataFrame, spec: LayerSpec) -> DataFrame:
    """Code-point order of the keys, empty text first."""
    return gold.orderBy(*spec.group_by)


def preview(gold: DataFrame, spec: LayerSpec, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows in key order; each task keeps only that many."""
    return sorted_by_keys(gold, spec).limit(rows)


def in_ingest_order(records: DataFrame) -> DataFrame:
    """Page order, then order within the page."""
    return records.orderBy("page", "pos")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
