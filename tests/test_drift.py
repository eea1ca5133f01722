"""Files whose columns and types drifted apart, read as one table."""

from __future__ import annotations

import datetime
import decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from siltstone.sources.drift import merged_schema, read_drifted, wider
from siltstone.sources.layers import read_merged

TYPES = [
    T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.DecimalType(38, 30),
    T.DateType(), T.TimestampType(), T.BooleanType(), T.StringType(), T.ArrayType(T.LongType()), T.NullType(),
]


def test_wider_is_a_lattice():
    for a in TYPES:
        assert wider(a, a) == a
        for b in TYPES:
            assert wider(a, b) == wider(b, a) and wider(wider(a, b), b) == wider(a, b)
    assert wider(T.IntegerType(), T.LongType()) == T.LongType()
    assert wider(T.LongType(), T.DecimalType(10, 2)) == T.DecimalType(22, 2)
    assert wider(T.LongType(), T.DecimalType(38, 30)) == T.StringType()
    assert wider(T.LongType(), T.FloatType()) == T.DoubleType()
    assert wider(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert wider(T.BooleanType(), T.LongType()) == T.StringType()


def test_columns_come_in_order_of_first_sight():
    whole, big, text = T.IntegerType(), T.LongType(), T.StringType()
    one = T.StructType().add("a", whole).add("b", text)
    two = T.StructType().add("c", whole).add("a", big)
    assert merged_schema([one, two]) == T.StructType().add("a", big).add("b", text).add("c", whole)


def test_a_changed_type_no_longer_fails_the_read(spark, fresh):
    path = f"{fresh}/t"
    spark.createDataFrame([(1, "x", 1.5, [1, 2])], "id int, `a.b` string, v double, n array<int>").write.parquet(path)
    rows = [("k", 7, datetime.date(2020, 1, 2), "text")]
    spark.createDataFrame(rows, "id string, v bigint, day date, n string").write.mode("append").parquet(path)
    rows = [(None, decimal.Decimal("2.50"), datetime.datetime(2020, 1, 2, 3), None)]
    spark.createDataFrame(rows, "id string, v decimal(5,2), day timestamp, n string").write.mode("append").parquet(path)
    with pytest.raises(Exception, match="CANNOT_MERGE|merge"):
        read_merged(spark, path).collect()
    found = read_drifted(spark, path)
    types = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    assert types == {"id": "string", "a.b": "string", "v": "double", "n": "string", "day": "timestamp"}
    rows = {(r["id"], r["a.b"], r["v"], r["n"], str(r["day"])) for r in found.collect()}
    assert rows == {
        ("1", "x", 1.5, "[1,2]", "None"), ("k", None, 7.0, "text", "2020-01-02 00:00:00"), (None, None, 2.5, None, "2020-01-02 03:00:00"),
    }


def test_files_of_other_writers_and_directory_keys(spark, fresh):
    path = f"{fresh}/t"
    spark.createDataFrame([(1, "a b"), (2, "c")], "id int, k string").write.partitionBy("k").parquet(path)
    pq.write_table(pa.table({"id": pa.array([3], pa.int64()), "more": ["m"]}), f"{path}/k=c/other.parquet")
    found = {(r["id"], r["more"], r["k"]) for r in read_drifted(spark, path).collect()}
    assert found == {(1, None, "a b"), (2, None, "c"), (3, "m", "c")}


def test_no_file(spark, fresh):
    with pytest.raises(ValueError, match="no data file"):
        read_drifted(spark, fresh)
