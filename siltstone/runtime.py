"""Shared storage for cut lineage, and the size check that stands before every broadcast."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its measured size is below this; above it the join shuffles.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
_ROW_OVERHEAD_BYTES = 64


_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def byte_size(size: str) -> int:
    """Bytes in a setting such as ``64MB``, ``512k`` or ``1048576b``."""
    number, unit = re.fullmatch(r"(\d+)([bkmgt]?)b?", size.strip().lower()).groups()
    return int(number) * _UNITS[unit or "b"]


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing else ever writes to it."""
    return f"{shared_dir(spark)}/siltstone-{uuid.uuid4().hex}/{name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage, so that a lost executor cannot undo it."""
    context = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, asked of its file system; reading an absent one would
    log a stack trace.
    """
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()).exists(found)


def has_rows(df: DataFrame) -> bool:
    """Whether there is any row. Goes on to further partitions only while it finds none;
    ``DataFrame.isEmpty`` starts a task for every one.
    """
    return bool(df.select(F.lit(1)).take(1))


def fits_broadcast(materialised: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether the measured size of a materialised frame is within the bound for a broadcast."""
    widths = [F.octet_length(F.col(c).cast("string")) for c in materialised.columns]
    width = sum((F.coalesce(w, F.lit(0)) for w in widths), F.lit(_ROW_OVERHEAD_BYTES))
    size = materialised.agg(F.sum(width).alias("size")).first()["size"]
    return (size or 0) <= limit
