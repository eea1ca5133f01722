"""Raw keys that fall on one directory once sanitised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.aggregates import leaf_manifest
from siltstone.operators.cleaning import with_clean_keys
from siltstone.runtime import checkpointed, fits_broadcast, has_rows
from siltstone.spec import LayerSpec


def _keyed_pairs(df: DataFrame, spec: LayerSpec) -> DataFrame:
    """Distinct raw pairs with their row counts; keys are sanitised per pair, not per row."""
    return with_clean_keys(leaf_manifest(df, spec), spec)


def key_collisions(df: DataFrame, spec: LayerSpec) -> DataFrame:
    """Directory keys fed by more than one raw pair, with the pairs and rows on each."""
    return (
        _keyed_pairs(df, spec)
        .groupBy(*spec.clean_keys)
        .agg(F.count("*").alias("raw_pairs"), F.sum("n_rows").alias("n_rows"))
        .filter("raw_pairs > 1")
    )


def keep_last_pair(df: DataFrame, spec: LayerSpec) -> DataFrame:
    """Of the raw pairs that share a directory, keep the rows of the last one in sorted order.

    Loses rows on purpose: it gives the result of writing pair after pair, each replacing the
    directory. The losing pairs are found on the distinct pairs, set down once, so no leaf passes
    through one task, and a frame without collisions is not joined at all.
    """
    pair = F.struct(*spec.partition_by)
    pairs = checkpointed(_keyed_pairs(df, spec))
    last = (
        pairs.groupBy(*spec.clean_keys)
        .agg(F.max(pair).alias("last_pair"), F.count("*").alias("raw_pairs"))
        .filter("raw_pairs > 1")
    )
    lost_names = [f"lost_{c}" for c in spec.partition_by]
    lost = checkpointed(
        pairs.join(last, list(spec.clean_keys))
        .filter(~pair.eqNullSafe(F.col("last_pair")))
        .select(*[F.col(c).alias(n) for c, n in zip(spec.partition_by, lost_names, strict=True)])
    )
    if not has_rows(lost):
        return df
    same = [
        F.col(c).eqNullSafe(F.col(n)) for c, n in zip(spec.partition_by, lost_names, strict=True)
    ]
    return df.join(F.broadcast(lost) if fits_broadcast(lost) else lost, same, "left_anti")
