"""Reads that skip most of a leaf, by the order of its rows and by Bloom filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.cleaning import with_clean_keys
from siltstone.sinks.layers import write_silver
from siltstone.sources.layers import read_silver
from siltstone.spec import LOCATIONS

ROWS = 200_000


def _hot(spark):
    """Most rows in one leaf, some in the leaf of an empty key; ids in no order."""
    columns = {c: F.lit("") for c in LOCATIONS.strings} | {c: F.lit(1.0) for c in LOCATIONS.numeric}
    columns |= {"id": F.sha2(F.col("n").cast("string"), 256), "postal_code": F.format_string("%06d", (F.col("n") * 7919) % ROWS)}
    columns |= {"state": F.when(F.col("n") % 50 == 0, "").otherwise("H"), "city": F.lit("h")}
    rows = spark.range(0, ROWS, 1, 8).withColumnRenamed("id", "n")
    return with_clean_keys(rows.select(*[columns[c].alias(c) for c in LOCATIONS.columns]), LOCATIONS)


def _rows_scanned(df):
    """The rows that the scan of a plan gave to the filter, and the result."""
    found = df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numOutputRows").value(), found


def test_a_point_read_in_a_hot_leaf_reads_little(spark, fresh):
    path = f"{fresh}/s"
    counts = write_silver(_hot(spark), path, LOCATIONS, piece_rows=10_000, order_by=["postal_code"], bloom=["id"])
    assert counts["n_rows"] == ROWS
    silver = read_silver(spark, path, LOCATIONS)
    assert silver.count() == ROWS and silver.filter("state_clean = ''").count() == ROWS // 50
    some = silver.filter("state = 'H'").select("id").first()["id"]
    scanned, found = _rows_scanned(silver.filter(F.col("id") == some).select("id", "state_clean"))
    assert len(found) == 1 and 0 < scanned < ROWS // 8
    # In each of the pieces a range of the ordered column is a few pages.
    plain = f"{fresh}/plain"
    write_silver(_hot(spark), plain, LOCATIONS, order_by=["postal_code"])
    ranged = read_silver(spark, plain, LOCATIONS).filter("postal_code BETWEEN '000100' AND '000119'")
    scanned, found = _rows_scanned(ranged.select("postal_code"))
    assert len(found) == 20 and scanned <= ROWS // 4


def test_rows_are_in_order_within_each_file(spark, fresh):
    path = f"{fresh}/s"
    write_silver(_hot(spark), path, LOCATIONS, order_by=["postal_code"])
    rows = read_silver(spark, path, LOCATIONS).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("nth"), "postal_code"
    )
    found = {}
    for row in sorted(rows.collect(), key=lambda r: (r["file"], r["nth"])):
        found.setdefault(row["file"], []).append(row["postal_code"])
    assert all(codes == sorted(codes) for codes in found.values())
