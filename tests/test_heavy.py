"""Leaves found while landing, write tasks dealt by them, and fingerprints that see swapped rows."""

from __future__ import annotations

import glob
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators.fingerprint import fingerprint_of, same_rows
from siltstone.operators.heavy import suffices, write_tasks
from siltstone.operators.quality import QualityGateError
from siltstone.plans import refine
from siltstone.plans.refine import bronze_to_silver
from siltstone.plans.summarise import silver_to_gold
from siltstone.sinks import layers
from siltstone.sinks.bronze import land_array_documents, land_record_text
from siltstone.sources.layers import read_gold, read_silver
from siltstone.spec import LOCATIONS
from siltstone.versions import newest

ROWS = 60_000


def _records(spark, rows=ROWS):
    """A third of the rows in one leaf, the rest over 200; odd keys among them."""
    hot = F.col("id") % 3 == 0
    city = F.when(F.col("id") % 7 == 0, F.lit(" a/b ")).otherwise(F.concat(F.lit("c"), F.col("id") % 200))
    columns = {c: F.concat(F.lit(f"{c} "), F.col("id").cast("string")) for c in LOCATIONS.columns}
    columns |= {"state": F.when(hot, "H").otherwise("S"), "city": F.when(hot, "h").otherwise(city)}
    columns |= {"brewery_type": F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise((F.col("id") % 4).cast("string"))}
    columns |= {"longitude": (F.col("id") / 7).cast("string"), "latitude": F.lit("n/a")}
    frame = spark.range(0, rows, 1, 6).select(*[columns[c].alias(c) for c in LOCATIONS.columns])
    return frame.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


@pytest.mark.parametrize("arrays", [False, True])
def test_landing_names_the_heavy_leaves(spark, fresh, arrays):
    (land_array_documents if arrays else land_record_text)(_records(spark), f"{fresh}/b", LOCATIONS)
    version = newest(spark, f"{fresh}/b")
    assert version.rows == ROWS and version.notes["leaf_keys"] == list(LOCATIONS.clean_keys)
    counts = {tuple(key): n for n, *key in version.notes["leaves"]}
    bronze_to_silver(spark, f"{fresh}/b", f"{fresh}/s", LOCATIONS, arrays=arrays)
    silver = read_silver(spark, f"{fresh}/s", LOCATIONS)
    exact = {tuple(r)[:2]: r["count"] for r in silver.groupBy(*LOCATIONS.clean_keys).count().collect()}
    assert counts == exact
    assert counts["H", "h"] == ROWS // 3
    silver_notes = newest(spark, f"{fresh}/s").notes
    assert silver_notes["source_print"] == silver_notes["rows_print"] == version.notes["rows_print"]


def test_cold_leaves_are_one_file_beside_a_hot_one_in_one_pass(spark, fresh, monkeypatch):
    land_record_text(_records(spark), f"{fresh}/b", LOCATIONS)
    monkeypatch.setattr(layers, "_leaf_rows", lambda *a: pytest.fail("counted by a second pass"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        outcome = bronze_to_silver(spark, f"{fresh}/b", f"{fresh}/s", LOCATIONS, piece_rows=6000)
    finally:
        spark.conf.set(name, before)
    assert outcome.n_rows == ROWS
    files = Counter(p.rsplit("/", 1)[0] for p in glob.glob(f"{fresh}/s/v*/*/*/*.parquet"))
    hot = [n for leaf, n in files.items() if leaf.endswith("state_clean=H/city_clean=h")]
    assert hot == [4] and sum(files.values()) - 4 == len(files) - 1
    silver = read_silver(spark, f"{fresh}/s", LOCATIONS)
    assert silver.agg(F.countDistinct("id")).first()[0] == ROWS
    path = F.col("_metadata.file_path")
    sizes = [r["count"] for r in silver.filter("state = 'H'").groupBy(path).count().collect()]
    assert max(sizes) < 5600


def test_the_plan_shuffles_once_and_reads_once(spark, fresh):
    land_record_text(_records(spark), f"{fresh}/b", LOCATIONS)
    cleaned = refine.with_clean_keys(
        refine.clean(refine.read_bronze(spark, f"{fresh}/b", LOCATIONS), LOCATIONS), LOCATIONS
    )
    source = newest(spark, f"{fresh}/b")
    plan = layers._balanced(cleaned, LOCATIONS, 5000, source)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange shufflepartitionid") == 1 and plan.count("Exchange hashpartitioning") == 0


def test_without_a_sketch_fine_enough_leaves_are_counted(spark, fresh, monkeypatch):
    land_record_text(_records(spark, 6000), f"{fresh}/b", LOCATIONS)
    asked = []
    counting = layers._leaf_rows
    monkeypatch.setattr(layers, "_leaf_rows", lambda *a: asked.append(1) or counting(*a))
    assert not suffices(6000, 11) and suffices(6000, 12) and not suffices(None, 12)
    assert bronze_to_silver(spark, f"{fresh}/b", f"{fresh}/s", LOCATIONS, piece_rows=11).n_rows == 6000
    land_record_text(_records(spark, 6000), f"{fresh}/plain")
    assert bronze_to_silver(spark, f"{fresh}/plain", f"{fresh}/s", LOCATIONS, piece_rows=500).n_rows == 6000
    assert len(asked) == 2


def test_wrong_counts_lose_no_row(spark, fresh):
    land_record_text(_records(spark, 6000), f"{fresh}/b", LOCATIONS)
    stale = newest(spark, f"{fresh}/b")
    stale.notes["leaves"] = [[5999, "gone", "leaf"], [1, "H", "h"]]
    frame = refine.read_bronze(spark, f"{fresh}/b", LOCATIONS)
    keyed = refine.with_clean_keys(refine.clean(frame, LOCATIONS), LOCATIONS)
    counts = layers.write_silver(keyed, f"{fresh}/s", LOCATIONS, piece_rows=100, source=stale)
    assert counts == {"n_rows": 6000}


def test_tasks_are_even():
    leaves = [[1000, "hot"], *[[n, f"k{n}"] for n in range(1, 100)]]
    placed, shared, tasks = write_tasks(leaves, 1000 + 4950, 100)
    assert shared == 50 and tasks == 60
    load = Counter()
    for key, first, pieces in placed:
        if pieces == 1:
            load[first] += int(key[1:])
    assert max(load.values()) <= 100 and len(load) == 50
    assert write_tasks([], 0, 10) == ([], 1, 1)


def test_fingerprints_see_swaps_but_not_order(spark):
    rows = [("a", None, 1.5), (None, "a", 1.5), ("ab", "c", 0.0), ("a", "bc", None), ("a", "bc", None), ("", None, -0.5)]
    schema = "x string, y string, z double"
    frame = spark.createDataFrame(rows, schema)
    shuffled = spark.createDataFrame(rows[::-1], schema).repartition(3)
    assert same_rows(frame, shuffled) and same_rows(frame.limit(0), frame.limit(0))
    for k in range(len(rows)):
        # One row lost, its neighbour doubled.
        other = [*rows[:k], rows[(k + 2) % len(rows)], *rows[k + 1 :]]
        assert not same_rows(frame, spark.createDataFrame(other, schema))
    weighed = frame.groupBy("x", "y", "z").count()
    assert fingerprint_of(weighed, ["x", "y", "z"], F.col("count")) == fingerprint_of(frame, ["x", "y", "z"])


def _swap(spark, path, change):
    """Write a layer's version anew with a change, as a faulty writer would, under its own manifest."""
    folder = f"{path}/{newest(spark, path).folder}"
    rows = spark.read.schema(LOCATIONS.silver_schema).parquet(folder).toPandas()
    frame = spark.createDataFrame(change(rows), LOCATIONS.silver_schema)
    frame.write.mode("overwrite").partitionBy(*LOCATIONS.clean_keys).parquet(folder)


def test_a_lost_and_a_doubled_row_stop_gold(spark, fresh):
    land_record_text(_records(spark, 500), f"{fresh}/b", LOCATIONS)
    bronze_to_silver(spark, f"{fresh}/b", f"{fresh}/s", LOCATIONS)
    silver_to_gold(spark, f"{fresh}/s", f"{fresh}/g", LOCATIONS)
    before = sorted(map(tuple, read_gold(spark, f"{fresh}/g", LOCATIONS).collect()))

    def lose_one_double_one(rows):
        hot, cold = rows.index[rows["state"] == "H"], rows.index[rows["state"] == "S"]
        rows.loc[hot[0]] = rows.loc[cold[0]]
        return rows

    _swap(spark, f"{fresh}/s", lose_one_double_one)
    with pytest.raises(QualityGateError, match="fingerprint on silver=gold"):
        silver_to_gold(spark, f"{fresh}/s", f"{fresh}/g", LOCATIONS, {"bronze": 500})
    assert sorted(map(tuple, read_gold(spark, f"{fresh}/g", LOCATIONS).collect())) == before


def test_a_cleaning_that_swaps_rows_stops_gold(spark, fresh, monkeypatch):
    land_record_text(_records(spark, 500), f"{fresh}/b", LOCATIONS)
    whole = refine.read_bronze

    def swapped(*given):
        rows = whole(*given)
        return rows.filter("id != 'id 7'").unionAll(rows.filter("id = 'id 8'"))

    monkeypatch.setattr(refine, "read_bronze", swapped)
    assert bronze_to_silver(spark, f"{fresh}/b", f"{fresh}/s", LOCATIONS).n_rows == 500
    with pytest.raises(QualityGateError, match="fingerprint on bronze=silver"):
        silver_to_gold(spark, f"{fresh}/s", f"{fresh}/g", LOCATIONS, {"bronze": 500})
    # Where rows are meant to go, the landed fingerprint is not asked for.
    bronze_to_silver(spark, f"{fresh}/b", f"{fresh}/s", LOCATIONS, last_pair_wins=True)
    silver_to_gold(spark, f"{fresh}/s", f"{fresh}/g", LOCATIONS)
    assert json.loads(json.dumps(newest(spark, f"{fresh}/s").notes)).keys() == {"rows_print", "keys_print"}


def test_many_hot_leaves_are_hashed(spark, fresh, monkeypatch):
    monkeypatch.setattr(layers, "NAMED", 3)
    land_record_text(_records(spark, 6000), f"{fresh}/b")
    assert bronze_to_silver(spark, f"{fresh}/b", f"{fresh}/s", LOCATIONS, piece_rows=15).n_rows == 6000
    assert read_silver(spark, f"{fresh}/s", LOCATIONS).agg(F.countDistinct("id")).first()[0] == 6000
