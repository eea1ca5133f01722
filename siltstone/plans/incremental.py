"""Counts kept per leaf, so that a load of some leaves recounts only those.

Beside the aggregated layer stands a layer of parts: a row per leaf and group with its count, and the
state of the leaf's files that it was counted from. Leaves whose files are the same keep their
parts, others are read again, and leaves that are gone drop out. The aggregate is the sum of the parts.

The states come from the listing of files, so it does not matter who replaced a leaf. They are taken
before the leaves are read: one that changes in between is counted again by the next run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.aggregates import count_by
from siltstone.runtime import checkpointed
from siltstone.sources.layers import leaf_states, read_silver
from siltstone.spec import LayerSpec
from siltstone.versions import current, replace

# More changed leaves than so many are not named in a filter: then all are read.
MAX_CHANGED = 1000

_STATE = "leaf_state"


def _parts_schema(spec: LayerSpec) -> T.StructType:
    keys = T.StructType([T.StructField(k, T.StringType()) for k in spec.clean_keys])
    return T.StructType([*keys.fields, *spec.gold_schema.fields, T.StructField(_STATE, T.StringType())])


def changed_leaves(silver: DataFrame, states: DataFrame, known: DataFrame, spec: LayerSpec) -> DataFrame | None:
    """The rows of leaves whose state is not among the known ones, or None if these are too many to name.

    The filter is on directory keys alone, so the other leaves' files are not opened.
    """
    keys = list(spec.clean_keys)
    # No two leaves give the same text.
    leaf = F.concat(*[part for k in keys for part in (F.length(k).cast("string"), F.lit(":"), F.col(k))])
    found = states.join(known, [*keys, _STATE], "left_anti").select(leaf).limit(MAX_CHANGED + 1).collect()
    if len(found) > MAX_CHANGED:
        return None
    return silver.filter(leaf.isin([r[0] for r in found]) if found else F.lit(False))


def leaf_parts(spark: SparkSession, silver_path: str, parts_path: str, spec: LayerSpec) -> DataFrame:
    """Counts per leaf and group of the clean layer as it is now, set down on shared storage."""
    keys = list(spec.clean_keys)
    silver = read_silver(spark, silver_path, spec)
    states = checkpointed(leaf_states(spark, silver_path, spec, _STATE))
    schema, folder = _parts_schema(spec), current(spark, parts_path)
    changed, kept = None, None
    if folder is not None:
        stored = spark.read.schema(schema).parquet(folder)
        changed = changed_leaves(silver, states, stored.select(*keys, _STATE).distinct(), spec)
        kept = stored.join(states, [*keys, _STATE], "left_semi")
    counted = count_by(silver if changed is None else changed, [*keys, *spec.group_by], spec.count_name)
    fresh = counted.join(states, keys).select(*schema.names)
    return checkpointed(fresh if changed is None else fresh.unionByName(kept.select(*schema.names)))


def sum_of_parts(parts: DataFrame, spec: LayerSpec) -> DataFrame:
    """The aggregate; equal to counting the whole clean layer."""
    return parts.groupBy(*spec.group_by).agg(F.sum(spec.count_name).alias(spec.count_name))


def write_parts(parts: DataFrame, parts_path: str) -> None:
    replace(parts.sparkSession, parts_path, parts.write.parquet)
