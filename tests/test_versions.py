import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siltstone.operators.cleaning import with_clean_keys
from siltstone.plans.ingest import ingest_bronze
from siltstone.plans.medallion import build_layers, layer_paths
from siltstone.sinks.bronze import land_array_documents, land_frame, land_record_text
from siltstone.sinks.layers import is_complete, write_gold, write_silver
from siltstone.sources.layers import read_gold, read_silver, read_silver_or_none
from siltstone.sources.records import record_lines
from siltstone.spec import LOCATIONS
from siltstone.versions import ConcurrentWriteError, current, replace, versions


def _records(spark, ids):
    return spark.createDataFrame([(json.dumps({"id": i}),) for i in ids], "record string")


def _failing_late(df, column):
    """``df``, whose last row raises; the rows before it are written by then."""
    rows = df.coalesce(1).withColumn("nth", F.monotonically_increasing_id())
    last = df.count() - 1
    broken = F.when(F.col("nth") == last, F.raise_error(F.lit("late"))).otherwise(F.col(column))
    return rows.withColumn(column, broken.cast("string")).drop("nth")


def _keyed(spark, rows):
    others = [c for c in LOCATIONS.columns if c not in ("id", "state", "city")]
    frame = spark.createDataFrame(rows, "id string, state string, city string")
    return with_clean_keys(frame.withColumns({c: F.lit("") for c in others}), LOCATIONS)


@pytest.mark.parametrize("land", [land_record_text, land_array_documents, lambda df, p: land_frame(df, p)])
def test_a_raw_layer_outlives_a_write_that_fails_late(spark, fresh, land):
    path = f"{fresh}/bronze"
    land(_records(spark, "abc"), path)
    before = sorted(r["value"] for r in record_lines(spark, path).collect())
    with pytest.raises(Exception, match="late"):
        land(_failing_late(_records(spark, range(3000)), "record"), path)
    assert sorted(r["value"] for r in record_lines(spark, path).collect()) == before
    assert is_complete(spark, path) and len(versions(spark, path)) == 1
    land(_records(spark, "d"), path)
    lines = " ".join(r["value"] for r in record_lines(spark, path).collect())
    assert "d" in lines and "a" not in lines.replace("record", "")
    # What the failed write left is gone with the next one.
    assert len([n for n in os.listdir(path) if n.startswith("v")]) == 2


@pytest.mark.parametrize("keep", [False, True])
def test_a_clean_layer_outlives_a_write_that_fails_late(spark, fresh, keep):
    path = f"{fresh}/silver"
    write_silver(_keyed(spark, [("1", "A", "a"), ("2", "B", "b")]), path, LOCATIONS)
    more = _keyed(spark, [(str(i), "B", "b") for i in range(500)])
    with pytest.raises(Exception, match="late"):
        write_silver(_failing_late(more, "name"), path, LOCATIONS, keep)
    assert sorted(r["id"] for r in read_silver(spark, path, LOCATIONS).select("id").collect()) == ["1", "2"]
    assert is_complete(spark, path)


def test_gold_outlives_a_write_that_fails_late(spark, fresh):
    path = f"{fresh}/gold"
    gold = spark.createDataFrame([("s", "c", "t", 3)], LOCATIONS.gold_schema)
    write_gold(gold, path)
    with pytest.raises(Exception, match="late"):
        write_gold(_failing_late(gold.union(gold), "state"), path)
    assert [tuple(r) for r in read_gold(spark, path, LOCATIONS).collect()] == [("s", "c", "t", 3)]


def test_a_first_write_that_fails_leaves_no_layer(spark, fresh):
    path = f"{fresh}/silver"
    with pytest.raises(Exception, match="late"):
        write_silver(_failing_late(_keyed(spark, [("1", "A", "a")] * 9), "name"), path, LOCATIONS)
    assert not is_complete(spark, path) and read_silver_or_none(spark, path, LOCATIONS) is None


def test_a_run_after_a_failed_write_goes_on(spark, fresh, monkeypatch):
    body = json.dumps([dict.fromkeys(LOCATIONS.columns) | {"id": "1", "state": "A", "city": "a"}])
    responses = spark.createDataFrame([(1, 200, body), (2, 200, "[]")], "page bigint, status int, body string")
    ingest_bronze(responses, layer_paths(fresh)["bronze"])
    with monkeypatch.context() as patched:
        patched.setattr("siltstone.plans.refine.write_silver", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            build_layers(spark, responses, fresh, LOCATIONS)
    assert [o.status for o in build_layers(spark, responses, fresh, LOCATIONS)] == ["skipped", "written", "written"]


def test_manifests_say_what_was_written(spark, fresh):
    path = f"{fresh}/s"
    for n in (1, 2, 3):
        write_silver(_keyed(spark, [(str(i), f"S{i}", "c") for i in range(n)]), path, LOCATIONS)
    write_silver(_keyed(spark, [("9", "S1", "c")]), path, LOCATIONS, keep_other_leaves=True)
    found = versions(spark, path)
    assert [(v.number, v.rows) for v in found] == [(3, 3), (4, None)] and found[0].folder == found[1].folder
    assert all(v.files >= 3 and v.bytes > 0 for v in found)
    assert current(spark, path) == f"{path}/{found[1].folder}"


def test_a_reader_goes_on_while_a_new_version_is_written(spark, fresh):
    path = f"{fresh}/g"
    write_gold(spark.range(5), path)
    reading = spark.read.parquet(current(spark, path))
    write_gold(spark.range(7), path)
    assert reading.count() == 5
    assert spark.read.parquet(current(spark, path)).count() == 7


def test_of_two_writes_at_once_one_fails(spark, fresh):
    path = f"{fresh}/g"

    def slow(folder):
        write_gold(spark.range(2), path)
        spark.range(9).write.parquet(folder)

    with pytest.raises(ConcurrentWriteError):
        replace(spark, path, slow)
    assert spark.read.parquet(current(spark, path)).count() == 2


def test_a_layer_without_versions_is_read_and_replaced(spark, fresh):
    path = f"{fresh}/g"
    spark.range(4).write.parquet(path)
    assert current(spark, path) == path and is_complete(spark, path)
    write_gold(spark.range(1), path)
    assert spark.read.parquet(current(spark, path)).count() == 1
    assert sorted(n[0] for n in os.listdir(path) if not n.startswith(".")) == ["_", "v"]


def test_a_manifest_cut_short_does_not_count(spark, fresh):
    path = f"{fresh}/g"
    write_gold(spark.range(3), path)
    for text in ("", '{"folder": "v0000', "[]"):
        Path(f"{path}/_versions/00000002.json").write_text(text, encoding="utf-8")
        assert spark.read.parquet(current(spark, path)).count() == 3
    write_gold(spark.range(4), path)
    assert [v.number for v in versions(spark, path)] == [1, 3]
