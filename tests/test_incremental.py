"""Counts kept per leaf: what is read again, and that the result is that of a whole count."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltstone.operators.aggregates import count_by_location
from siltstone.operators.cleaning import with_clean_keys
from siltstone.plans import incremental
from siltstone.plans.summarise import silver_to_gold
from siltstone.sinks.layers import write_silver
from siltstone.sources.layers import leaf_states, read_gold, read_silver
from siltstone.spec import LOCATIONS

STATES = ["A", "", "a/b", "50%", "ü +", "B"]


def _rows(spark, kind, states=STATES, n=6):
    rows = [(f"{s}{c}{i}", s, f"c{c}", kind(i)) for s in states for c in range(3) for i in range(n)]
    frame = spark.createDataFrame(rows, "id string, state string, city string, brewery_type string")
    others = [c for c in LOCATIONS.strings if c not in frame.columns]
    frame = frame.withColumns({c: F.lit("") for c in others} | {c: F.lit(0.5) for c in LOCATIONS.numeric})
    return with_clean_keys(frame, LOCATIONS)


def _count(spark, fresh):
    silver_to_gold(spark, f"{fresh}/s", f"{fresh}/g", LOCATIONS, parts_path=f"{fresh}/parts")
    found = sorted(map(tuple, read_gold(spark, f"{fresh}/g", LOCATIONS).collect()))
    whole = count_by_location(read_silver(spark, f"{fresh}/s", LOCATIONS), LOCATIONS)
    assert found == sorted(map(tuple, whole.collect()))
    return found


def test_a_load_of_some_leaves_counts_as_a_whole_run(spark, fresh):
    write_silver(_rows(spark, lambda i: str(i % 2)), f"{fresh}/s", LOCATIONS)
    first = _count(spark, fresh)
    assert _count(spark, fresh) == first
    write_silver(_rows(spark, lambda i: "new", ["", "50%", "later"]), f"{fresh}/s", LOCATIONS, True)
    assert _count(spark, fresh) != first
    # A whole replacement drops the leaves that are gone.
    write_silver(_rows(spark, lambda i: "x", ["B"]), f"{fresh}/s", LOCATIONS)
    assert _count(spark, fresh) == [("B", f"c{c}", "x", 6) for c in range(3)]


def test_only_replaced_leaves_are_read(spark, fresh):
    path, parts = f"{fresh}/s", f"{fresh}/parts"
    write_silver(_rows(spark, lambda i: "k"), path, LOCATIONS)
    silver_to_gold(spark, path, f"{fresh}/g", LOCATIONS, parts_path=parts)
    write_silver(_rows(spark, lambda i: "new", ["", "a/b"]), path, LOCATIONS, keep_other_leaves=True)
    states = leaf_states(spark, path, LOCATIONS, "leaf_state")
    known = spark.read.parquet(incremental.current(spark, parts)).select(*LOCATIONS.clean_keys, "leaf_state").distinct()
    changed = incremental.changed_leaves(read_silver(spark, path, LOCATIONS), states, known, LOCATIONS)
    assert {r["state"] for r in changed.select("state").collect()} == {"", "a/b"}
    # The filter is one on partitions: the other leaves' files are not opened.
    plan = changed._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan") :]
    assert "PartitionFilters: [concat(" in scan and "DataFilters: []" in scan
    read = {r[0] for r in changed.select("_metadata.file_path").distinct().collect()}
    assert len(read) == 6


def test_many_changed_leaves_are_counted_whole(spark, fresh, monkeypatch):
    monkeypatch.setattr(incremental, "MAX_CHANGED", 2)
    write_silver(_rows(spark, lambda i: "k"), f"{fresh}/s", LOCATIONS)
    _count(spark, fresh)
    write_silver(_rows(spark, lambda i: "new", ["A"]), f"{fresh}/s", LOCATIONS, True)
    _count(spark, fresh)


def test_a_failed_check_keeps_both_layers(spark, fresh):
    write_silver(_rows(spark, lambda i: "k"), f"{fresh}/s", LOCATIONS)
    _count(spark, fresh)
    write_silver(_rows(spark, lambda i: "new", ["A"]), f"{fresh}/s", LOCATIONS, True)
    before = sorted(map(tuple, read_gold(spark, f"{fresh}/g", LOCATIONS).collect()))
    with pytest.raises(Exception, match="totals"):
        silver_to_gold(spark, f"{fresh}/s", f"{fresh}/g", LOCATIONS, {"bronze": 1}, parts_path=f"{fresh}/parts")
    assert sorted(map(tuple, read_gold(spark, f"{fresh}/g", LOCATIONS).collect())) == before
    _count(spark, fresh)


def test_leaf_files_have_no_parts(spark, fresh):
    with pytest.raises(ValueError, match="directory keys"):
        silver_to_gold(spark, f"{fresh}/s", f"{fresh}/g", LOCATIONS, leaf_files=True, parts_path=f"{fresh}/p")
