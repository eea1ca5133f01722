"""Cleaning, aggregates, order, collisions on literal frames."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltstone import runtime
from siltstone.functions.text import UNSAFE
from siltstone.operators import aggregates, cleaning, collisions, ordering
from siltstone.operators.quality import MissingColumnsError
from siltstone.sinks.layers import write_silver
from siltstone.sources.layers import read_silver
from siltstone.spec import LOCATIONS

PLACES = "state string, city string, brewery_type string"


def _raw(spark, **values):
    row = {c: None for c in LOCATIONS.columns} | values
    schema = ", ".join(f"{c} string" for c in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_clean_projects_casts_and_fills(spark):
    raw = _raw(spark, name=" é ", state="", longitude="x", latitude=" 2.5", extra="gone")
    cleaned = cleaning.clean(raw, LOCATIONS)
    assert cleaned.columns == list(LOCATIONS.columns)
    assert dict(cleaned.dtypes)["longitude"] == "double"
    row = cleaned.first()
    assert (row["name"], row["state"], row["city"]) == (" é ", "", "")
    assert (row["longitude"], row["latitude"]) == (None, 2.5)


def test_clean_takes_typed_columns(spark):
    raw = _raw(spark, id="1").withColumns(
        {
            "id": F.lit(7),
            "longitude": F.lit(float("nan")),
            "latitude": F.lit(True),
        }
    )
    row = cleaning.clean(raw, LOCATIONS).first()
    assert (row["id"], row["longitude"], row["latitude"]) == ("7", None, 1.0)


def test_an_absent_column_is_an_error(spark):
    with pytest.raises(MissingColumnsError, match="phone, website_url"):
        cleaning.clean(_raw(spark).drop("phone", "website_url"), LOCATIONS)


def test_cleaning_stays_in_the_jvm(spark, capsys):
    cleaning.with_clean_keys(cleaning.clean(_raw(spark), LOCATIONS), LOCATIONS).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Exchange" not in plan


def test_counts_treat_blank_as_a_value(spark):
    rows = [("A", "", "x"), ("A", "", "x"), ("", "b", ""), ("A/B", "c", "x")]
    gold = aggregates.count_by_location(spark.createDataFrame(rows, PLACES), LOCATIONS)
    assert sorted(tuple(r) for r in gold.collect()) == [("", "b", "", 1), ("A", "", "x", 2), ("A/B", "c", "x", 1)]
    assert gold.schema[LOCATIONS.count_name].dataType.simpleString() == "bigint"


def test_counts_read_only_what_they_need(spark, fresh, capsys):
    rows = cleaning.with_clean_keys(cleaning.clean(_raw(spark, state="A"), LOCATIONS), LOCATIONS)
    write_silver(rows, f"{fresh}/s", LOCATIONS)
    silver = read_silver(spark, f"{fresh}/s", LOCATIONS)
    aggregates.leaf_count(silver, LOCATIONS).explain()
    assert "ReadSchema: struct<>" in capsys.readouterr().out
    aggregates.count_by_location(silver, LOCATIONS).explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<brewery_type:string,city:string,state:string>" in plan
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_null_key_rules_equal_pandas(spark):
    rows = [("a", 1), (None, 2), ("a", None)]
    frame = spark.createDataFrame(rows, "k string, v int")
    kept = aggregates.count_by(frame, ["k"], "n").collect()
    assert sorted(((r["k"], r["n"]) for r in kept), key=str) == [("a", 2), (None, 1)]
    dropped = aggregates.count_by(frame, ["k"], "n", drop_null_keys=True).collect()
    expected = pd.DataFrame(rows, columns=["k", "v"]).groupby("k").size().to_dict()
    assert {r["k"]: r["n"] for r in dropped} == expected


def test_order_is_by_code_point_with_blank_first(spark):
    states = ["é", "b", "B", "", "a", "10", "9", "漢", "\U0001f600"]
    gold = spark.createDataFrame([(s, "c", "t", 1) for s in states], PLACES + ", n bigint")
    found = [r["state"] for r in ordering.sorted_by_keys(gold, LOCATIONS).collect()]
    assert found == sorted(states)
    assert [r["state"] for r in ordering.preview(gold, LOCATIONS).collect()] == sorted(states)[:5]


def test_preview_keeps_only_the_top_in_each_task(spark, capsys):
    ordering.preview(spark.createDataFrame([("a", "b", "c")], PLACES), LOCATIONS).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_union_by_name(spark):
    one = spark.createDataFrame([(1, "a")], "k int, x string")
    two = spark.createDataFrame([("b", 1)], "y string, k int")
    rows = ordering.union_by_name([one, two, one]).collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "a", None), (1, "a", None), (1, None, "b")]


def _replayed(rows):
    """Write pair after pair in sorted order, each replacing its directory."""
    def folder(text):
        return "".join("_" if c in UNSAFE else c for c in text.strip())

    leaves = {}
    for pair in sorted({r[:2] for r in rows}):
        leaves[folder(pair[0]), folder(pair[1])] = [r for r in rows if r[:2] == pair]
    return sorted(r for leaf in leaves.values() for r in leaf)


@pytest.mark.parametrize("limit", [runtime.BROADCAST_LIMIT_BYTES, 0])
def test_last_pair_wins(spark, monkeypatch, limit):
    monkeypatch.setattr(collisions, "fits_broadcast", lambda df: runtime.fits_broadcast(df, limit))
    rng = random.Random(3)
    names = ["A/B", "A_B", "A:B", "X ", "X", " X", "", "  ", "Z"]
    rows = [(rng.choice(names), rng.choice(names), str(i)) for i in range(400)]
    frame = spark.createDataFrame(rows, PLACES).repartition(5)
    kept = collisions.keep_last_pair(frame, LOCATIONS)
    assert sorted(tuple(r) for r in kept.collect()) == _replayed(rows)


def test_without_collisions_nothing_is_joined(spark):
    frame = spark.createDataFrame([("A", "B", "t"), ("C", "D", "t")], PLACES)
    assert collisions.keep_last_pair(frame, LOCATIONS) is frame


def test_collision_audit(spark):
    rows = [("A/B", "c", "1"), ("A_B", "c", "2"), ("A_B", "c", "3"), ("A_B", "d", "4")]
    found = collisions.key_collisions(spark.createDataFrame(rows, PLACES), LOCATIONS).collect()
    assert [tuple(r) for r in found] == [("A_B", "c", 2, 3)]


def test_size_is_measured(spark):
    frame = runtime.checkpointed(spark.createDataFrame([("x" * 100, 7)] * 10, "v string, i bigint"))
    assert runtime.fits_broadcast(frame, 10 * (64 + 101))
    assert not runtime.fits_broadcast(frame, 10 * (64 + 101) - 1)
    assert runtime.fits_broadcast(frame.limit(0), 0)
