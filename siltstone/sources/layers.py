"""Reading the clean and aggregated layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.spec import LayerSpec
from siltstone.versions import current, readable


# Fixed value: the directory Spark gives to empty keys.
_EMPTY_KEY = "__HIVE_DEFAULT_PARTITION__"


def read_silver(spark: SparkSession, path: str, spec: LayerSpec) -> DataFrame:
    """All leaves as one table, raw values from the files, directory keys from the paths.

    The schema is given, so no footer is read to find it and a key such as ``01`` stays text.
    An empty key has the null directory; it reads back as empty text.
    """
    silver = spark.read.schema(spec.silver_schema).parquet(readable(spark, path))
    keys = {k: F.coalesce(F.col(k), F.lit("")) for k in spec.clean_keys}
    return silver.withColumns(keys)


def read_leaf_files(spark: SparkSession, path: str, spec: LayerSpec) -> DataFrame:
    """Leaves whose directories carry the same names as columns in the files.

    Directories are walked, not parsed: the files' values count, as ``x/y`` under ``x_y``.
    """
    reader = spark.read.schema(spec.silver_schema).option("recursiveFileLookup", True)
    files = reader.option("pathGlobFilter", "*.parquet").parquet(readable(spark, path))
    return files.select(*spec.columns)


def _listed(spark: SparkSession, path: str, spec: LayerSpec) -> DataFrame:
    """Every data file with the directory keys of its leaf, from the listing of files alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = files.option("pathGlobFilter", "*.parquet").load(readable(spark, path))
    keys = []
    for key in spec.clean_keys:
        written = F.regexp_extract("path", f"/{key}=([^/]*)/", 1)
        # Characters that a directory cannot hold are written as % and two digits; + is itself.
        plain = F.url_decode(F.replace(written, F.lit("+"), F.lit("%2B")))
        keys.append(F.when(written == _EMPTY_KEY, "").otherwise(plain).alias(key))
    return listed.select("path", "length", "modificationTime", *keys)


def list_leaves(spark: SparkSession, path: str, spec: LayerSpec) -> DataFrame:
    """The directory keys of every leaf that has a data file, from the listing of files alone."""
    return _listed(spark, path, spec).select(*spec.clean_keys).distinct()


def leaf_states(spark: SparkSession, path: str, spec: LayerSpec, name: str) -> DataFrame:
    """Per leaf a text that differs once any of its files is another: their number and a hash of all."""
    files = _listed(spark, path, spec)
    one = F.xxhash64("path", "length", "modificationTime")
    state = F.concat_ws(":", F.count("*").cast("string"), F.hex(F.bit_xor(one)))
    return files.groupBy(*spec.clean_keys).agg(state.alias(name))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Files that differ in columns, as one table with all of them."""
    return spark.read.option("mergeSchema", True).parquet(readable(spark, path))


def read_gold(spark: SparkSession, path: str, spec: LayerSpec) -> DataFrame:
    return spark.read.schema(spec.gold_schema).parquet(readable(spark, path))


def read_silver_or_none(
    spark: SparkSession,
    path: str,
    spec: LayerSpec,
    leaf_files: bool = False,
) -> DataFrame | None:
    """The silver layer in either layout, or None if there is no such path, or no finished version."""
    if current(spark, path) is None:
        return None
    return (read_leaf_files if leaf_files else read_silver)(spark, path, spec)
