"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import fits_broadcast

# A key is heavy with more rows than this, and with more than one in so many of all rows; so there
# are never more heavy keys than HEAVY_KEYS.
HEAVY_ROWS = 1000
HEAVY_KEYS = 100_000


def attach(left: DataFrame, right: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``left`` with the columns of ``right``, null where there is no match.

    ``right`` is materialised, has each key once, and in ``weight`` the number of rows of ``left``
    with that key. Measured small it is broadcast. Otherwise its heavy keys alone are, as their
    number is bounded, and the rest joins by shuffle; ``left`` is then read twice.
    """
    columns = right.drop(weight)
    if fits_broadcast(columns):
        return left.join(F.broadcast(columns), keys, "left")
    total = right.agg(F.sum(weight).alias("n")).first()["n"]
    heavy = F.col(weight) > max(HEAVY_ROWS, total // HEAVY_KEYS)
    few = F.broadcast(right.filter(heavy).drop(weight))
    light = left.join(F.broadcast(right.filter(heavy).select(*keys)), keys, "left_anti")
    return left.join(few, keys).unionByName(light.join(right.filter(~heavy).drop(weight), keys, "left"))
