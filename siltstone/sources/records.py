"""Reading raw JSON records: lines, array documents, union of keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.runtime import byte_size
from siltstone.sources.documents import record_texts
from siltstone.versions import readable

_PROBE_ROWS = 1000

# Text that does not parse fails; a text value may be as long as a string can be.
STRICT_JSON = {"mode": "FAILFAST", "maxStringLen": str(2**31 - 1)}


def _only(parsed: Column, what: str) -> Column:
    """The single value of a parsed text; a text with none, a null one or several fails the query."""
    one = F.coalesce((F.size(parsed) == 1) & parsed[0].isNotNull(), F.lit(False))
    return F.when(one, parsed).otherwise(F.raise_error(F.lit(f"a {what} does not hold one value")))


def _wrapped(text: str) -> Column:
    """The text in brackets: as one array it may have nothing behind its value."""
    return F.concat(F.lit("["), F.col(text), F.lit("]"))


def record_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw layer's lines of text, as ``value``."""
    return spark.read.text(readable(spark, path))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One record per line, splittable. Blank lines are none.

    As in all readers here, text that does not parse to its last character fails the query; no
    record turns to nulls or is dropped. A line ``null`` is no record and fails too.
    """
    lines = record_lines(spark, path).filter(F.length(F.trim("value")) > 0)
    return _parsed(lines, "value", schema)


def _parsed(texts: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """The records in a column of texts, one each."""
    parsed = texts.select(F.from_json(_wrapped(column), T.ArrayType(schema), STRICT_JSON).alias("r"))
    return parsed.select(F.inline(_only(F.col("r"), "line")))


def _is_long(spark: SparkSession, path: str) -> bool:
    """Whether any file is longer than what a task reads; from the listing of files alone."""
    files = spark.read.format("binaryFile").load(readable(spark, path))
    longest = files.agg(F.max("length").alias("n")).first()["n"] or 0
    return longest > byte_size(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Documents that hold an array of records over many lines. Null elements fail the query.

    Where a file is longer than what Spark gives a task, all are cut into records over many tasks first
    (see ``documents``). Otherwise a document is one task's work, parsed from the document's text: the multi-line JSON reader goes back to the file for every
    value that is not a string but read as one.
    """
    if _is_long(spark, path):
        return _parsed(record_texts(spark, readable(spark, path)), "record", schema)
    documents = spark.read.text(readable(spark, path), wholetext=True).filter(F.length(F.trim("value")) > 0)
    shape = T.ArrayType(T.ArrayType(schema))
    parsed = documents.select(F.from_json(_wrapped("value"), shape, STRICT_JSON).alias("d"))
    records = parsed.select(_only(F.col("d"), "document")[0].alias("r"))
    whole = F.forall("r", lambda item: item.isNotNull())
    broken = F.raise_error(F.lit("a document holds a null record"))
    return records.select(F.inline(F.when(whole, F.col("r")).otherwise(broken)))


def read_union_of_keys(spark: SparkSession, path: str, arrays: bool = False) -> DataFrame:
    """All keys that any record has, as string columns; a key a record lacks is null there.

    Costs a pass over the whole input to find the keys; pass a schema to the other readers
    where the keys are known.
    """
    if arrays and _is_long(spark, path):
        keys = record_texts(spark, readable(spark, path)).select(F.explode(F.json_object_keys("record")).alias("k"))
        found = sorted(r["k"] for r in keys.distinct().collect())
        schema = T.StructType([T.StructField(k, T.StringType()) for k in found])
        return read_json_arrays(spark, path, schema)
    reader = spark.read.options(**STRICT_JSON).option("primitivesAsString", True)
    schema = reader.option("multiLine", arrays).json(readable(spark, path)).schema
    return (read_json_arrays if arrays else read_json_lines)(spark, path, schema)


def key_presence(lines: DataFrame, expected: Sequence[str]) -> DataFrame:
    """For each expected key, how many records (JSON text in ``value``) carry it: one pass."""
    keys = lines.select(F.json_object_keys("value").alias("keys"))
    counts = keys.agg(*[F.count_if(F.array_contains("keys", k)).alias(k) for k in expected])
    rows = [
        F.struct(F.lit(k).alias("column_name"), F.col(f"`{k}`").alias("records")) for k in expected
    ]
    return counts.select(F.inline(F.array(*rows))).withColumn("missing", F.col("records") == 0)


def missing_keys(lines: DataFrame, expected: Sequence[str]) -> list[str]:
    """Expected keys that no record carries; none for an input without records.

    A key seen once is present, so a few rows settle the usual case. Only keys not among them
    cost a pass over everything.
    """
    keys = lines.select(F.json_object_keys("value").alias("keys"))
    probe = keys.take(_PROBE_ROWS)
    seen = {k for row in probe for k in row["keys"] or ()}
    missing = [k for k in expected if k not in seen]
    if not missing or len(probe) < _PROBE_ROWS:
        return missing if probe else []
    found = keys.agg(
        *[F.bool_or(F.array_contains("keys", k)).alias(k) for k in missing]
    ).first()
    return [k for k in missing if not found[k]]
