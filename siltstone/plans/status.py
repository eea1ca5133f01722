"""What a job did to a layer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

WRITTEN = "written"
SKIPPED = "skipped"


@dataclass(frozen=True)
class LayerStatus:
    """Outcome of one job; None stands for what was not counted.

    ``n_rows`` is what the layer accounts for, ``n_leaves`` the leaves of the clean layer written or
    read, ``bad_numbers`` the values there that were no number and became null.
    """

    layer: str
    status: str
    n_rows: int | None
    n_leaves: int | None = None
    bad_numbers: int | None = None


def status_frame(spark: SparkSession, outcomes: Sequence[LayerStatus]) -> DataFrame:
    return spark.createDataFrame(
        [astuple(o) for o in outcomes],
        "layer string, status string, n_rows bigint, n_leaves bigint, bad_numbers bigint",
    )
