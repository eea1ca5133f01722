"""Parquet files whose schemas drifted apart: other columns, and other types under one name.

Footers are read in tasks, a few files each. Each column gets the narrowest type that holds the values of
all files, files of one schema are read together by their own types, then cast and joined by name.

The rule for two types: the wider of two whole numbers or two decimals; a decimal for a whole number beside a
decimal, where 38 digits hold both; double for any other two numbers, as in Spark's own coercion; a
timestamp for a date beside one; else text, nested values as JSON.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from siltstone.runtime import checkpointed
from siltstone.versions import readable

FILES_PER_TASK = 64

# Fixed value: where Spark keeps its own schema in a footer.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def _schema_of(path: str) -> str:
    """A file's schema as JSON, from its footer alone."""
    # The scheme of one connector is another's in Arrow; blanks and the like are escaped in a listing.
    plain = re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "/", path))
    files, inside = pafs.FileSystem.from_uri(plain) if "://" in plain else (pafs.LocalFileSystem(), plain)
    with files.open_input_file(inside) as source:
        arrow = pq.read_schema(source)
    written = (arrow.metadata or {}).get(_SPARK_SCHEMA)
    return written.decode() if written else from_arrow_schema(arrow).json()


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """``(path, schema)`` of every data file; hidden files and folders are none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    paths = files.option("pathGlobFilter", "*.parquet").load(readable(spark, path)).select("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_schema_of(p) for p in batch["path"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"path": batch["path"], "schema": pa.array(found, pa.string())})

    tasks = max(1, -(-paths.count() // FILES_PER_TASK))
    return paths.repartition(tasks).mapInArrow(read, "path string, schema string")


def wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type that holds values of both."""
    if left == right:
        return left
    if isinstance(left, T.NullType) or isinstance(right, T.NullType):
        return right if isinstance(left, T.NullType) else left
    if left in _WHOLE and right in _WHOLE:
        return max(left, right, key=_WHOLE.__getitem__)
    exact = [T.DecimalType(_WHOLE[t], 0) if t in _WHOLE else t for t in (left, right)]
    if all(isinstance(t, T.DecimalType) for t in exact):
        scale = max(t.scale for t in exact)
        digits = max(t.precision - t.scale for t in exact) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        return T.DoubleType()
    if {left, right} <= {T.DateType(), T.TimestampType()}:
        return T.TimestampType()
    if {left, right} <= {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    return T.StringType()


def merged_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns of the schemas, in order of first sight."""
    types: dict[str, T.DataType] = {}
    for field in (f for schema in schemas for f in schema.fields):
        types[field.name] = wider(types[field.name], field.dataType) if field.name in types else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def _as(field: T.StructField, present: T.StructType) -> Column:
    if field.name not in present.names:
        return F.lit(None).cast(field.dataType).alias(field.name)
    value, own = F.col(f"`{field.name}`"), present[field.name].dataType
    nested = isinstance(own, T.StructType | T.ArrayType | T.MapType) and own != field.dataType
    return (F.to_json(value) if nested else value.cast(field.dataType)).alias(field.name)


def read_drifted(spark: SparkSession, path: str) -> DataFrame:
    """All files as one table, whatever their schemas; a column a file lacks is null there.

    Directory keys come as Spark finds them. Costs a read of the footers. To the driver come the schemas and
    the paths of the files, which the file index of any read holds there as well.
    """
    listed = checkpointed(file_schemas(spark, path).withColumn("kind", F.xxhash64("schema")))
    texts = {r["kind"]: r["schema"] for r in listed.select("kind", "schema").distinct().collect()}
    files: dict[int, list[str]] = {}
    # By path, so that the order of the columns does not depend on the run.
    for row in sorted(listed.select("path", "kind").collect()):
        files.setdefault(row["kind"], []).append(row["path"])
    if not files:
        raise ValueError(f"no data file under {path}")
    schemas = {kind: T.StructType.fromJson(json.loads(texts[kind])) for kind in files}
    merged = merged_schema(list(schemas.values()))
    parts = []
    for kind, own in schemas.items():
        rows = spark.read.schema(own).option("basePath", readable(spark, path)).parquet(*files[kind])
        keys = [F.col(f"`{c}`") for c in rows.columns if c not in own.names]
        parts.append(rows.select(*[_as(f, own) for f in merged.fields], *keys))
    return reduce(DataFrame.unionByName, parts)
