"""Raw layer to clean layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.aggregates import leaf_count
from siltstone.operators.cleaning import bad_numbers, clean, with_clean_keys
from siltstone.operators.collisions import keep_last_pair
from siltstone.operators.quality import MissingColumnsError
from siltstone.plans.status import WRITTEN, LayerStatus
from siltstone.sinks.layers import write_silver
from siltstone.sources.layers import read_silver
from siltstone.sources.records import (
    missing_keys,
    read_json_arrays,
    read_json_lines,
    read_union_of_keys,
    record_lines,
)
from siltstone.spec import LayerSpec
from siltstone.versions import newest

_BAD = "bad_numbers"


def read_bronze(
    spark: SparkSession,
    path: str,
    spec: LayerSpec,
    arrays: bool = False,
) -> DataFrame:
    """Raw records as text columns. A column that no record has is an error; no record is none."""
    if arrays:
        records = read_json_arrays(spark, path, spec.bronze_schema)
        found = read_union_of_keys(spark, path, arrays=True).columns
        missing = [c for c in spec.columns if found and c not in found]
    else:
        records = read_json_lines(spark, path, spec.bronze_schema)
        missing = missing_keys(record_lines(spark, path), spec.columns)
    if missing:
        raise MissingColumnsError(f"no record has: {', '.join(missing)}")
    return records


def bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    spec: LayerSpec,
    arrays: bool = False,
    strict: bool = False,
    keep_other_leaves: bool = False,
    last_pair_wins: bool = False,
    piece_rows: int | None = None,
) -> LayerStatus:
    """Clean every record and write the layer, split by its sanitised keys.

    No row is lost, unless ``last_pair_wins`` asks for the rows of colliding keys to replace each
    other. ``arrays``: the raw layer holds array documents. ``strict``: bad numbers fail the job,
    else they become null and the outcome says how many did.
    ``keep_other_leaves``, ``piece_rows``: see ``write_silver``.
    """
    cleaned = clean(read_bronze(spark, bronze_path, spec, arrays), spec, strict, _BAD)
    if last_pair_wins:
        cleaned = keep_last_pair(cleaned, spec)
    keyed = with_clean_keys(cleaned, spec)
    counts = write_silver(
        keyed,
        silver_path,
        spec,
        keep_other_leaves,
        piece_rows,
        [_BAD],
        source=newest(spark, bronze_path),
        all_rows=not (last_pair_wins or keep_other_leaves),
    )
    leaves = leaf_count(read_silver(spark, silver_path, spec), spec).first()["n_leaves"]
    return LayerStatus("silver", WRITTEN, counts["n_rows"], leaves, counts[_BAD])


def count_bad_numbers(
    spark: SparkSession, bronze_path: str, spec: LayerSpec, arrays: bool = False
) -> int:
    """Values of the raw layer that are no number where one belongs, by a pass over it."""
    raw = read_bronze(spark, bronze_path, spec, arrays)
    return raw.agg(F.coalesce(F.sum(bad_numbers(raw, spec)), F.lit(0))).first()[0]
