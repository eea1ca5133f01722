"""Checks find injected dirt; the gate raises with what failed."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import quality
from siltstone.spec import LOCATIONS


@pytest.fixture
def dirty(spark):
    rows = [
        ("1", "A", "1.5", "2024-01-01"),
        ("1", "A", "1.5", "2024-01-01"),
        ("2", "", "abc", "2024-02-30"),
        (None, None, None, "2030-01-01"),
    ]
    return spark.createDataFrame(rows, "id string, state string, number string, day string")


def test_nulls_and_blanks(dirty):
    found = quality.null_and_blank_counts(dirty, ["id", "state"]).collect()
    assert [tuple(r) for r in found] == [("id", 1, 0), ("state", 1, 1)]


def test_duplicates(dirty):
    assert [tuple(r) for r in quality.duplicate_rows(dirty).collect()] == [("1", "A", "1.5", "2024-01-01", 2)]
    assert [tuple(r) for r in quality.duplicates(dirty, ["id"]).collect()] == [("1", 2)]


@pytest.mark.parametrize("bits", [(64, 64), (64, 1 << 10), quality._FILTER_BITS])
def test_duplicate_rows_with_nulls_and_special_numbers(spark, monkeypatch, bits):
    monkeypatch.setattr(quality, "_FILTER_BITS", bits)
    rng = random.Random(5)
    texts, numbers = ["a", "", None, "b"], [0.0, -0.0, math.nan, None, 1.5, math.inf]
    rows = [(rng.choice(texts), rng.choice(numbers), rng.randrange(4)) for _ in range(300)]

    def plain(row):
        return (row[0], "nan" if row[1] is not None and math.isnan(row[1]) else row[1], row[2])

    counted = Counter(plain(r) for r in rows)
    expected = {k: n for k, n in counted.items() if n > 1}
    frame = spark.createDataFrame(rows, "t string, v double, i int").repartition(4)
    assert {plain(r[:3]): r["n"] for r in quality.duplicate_rows(frame).collect()} == expected


def test_rows_are_compared_whole_only_on_suspicion(spark, capsys):
    frame = spark.range(1000).withColumn("v", F.col("id") % 7)
    found = quality.duplicate_rows(frame)
    assert found.count() == 0
    found.explain()
    plan = capsys.readouterr().out
    # Rows meet the suspects' filter before any exchange, and the suspects themselves behind it.
    assert plan.count("LeftSemi") == 2
    assert "BroadcastHashJoin [row_hash_slot" in plan


def test_types(dirty):
    found = quality.type_violations(dirty, {"number": ["double", "string"], "day": ["date"]}).collect()
    assert [tuple(r) for r in found] == [("number", "double", 1), ("number", "string", 0), ("day", "date", 1)]


def test_date_range(dirty):
    days = dirty.select(F.col("day").try_cast("date").alias("day"))
    bounds = [F.lit(d).cast("date") for d in ("2024-01-01", "2024-12-31")]
    row = quality.date_range(days, "day", *bounds).first()
    assert (str(row["first_value"]), str(row["last_value"]), row["out_of_range"]) == ("2024-01-01", "2030-01-01", 1)


def test_missing_columns(spark):
    frame = spark.createDataFrame(
        [("k-9", "Kiln", "Opava", "MSK", "t1")],
        "id string, name string, city string, state string, brewery_type string",
    )
    assert quality.missing_columns(frame, LOCATIONS.columns) == [
        "street", "postal_code", "country", "longitude", "latitude", "phone", "website_url",
    ]
    assert quality.missing_columns(frame, LOCATIONS.group_by) == []


def test_a_leaf_without_rows_shows(spark, fresh):
    row = dict.fromkeys(LOCATIONS.columns, "x") | {"longitude": 1.0, "latitude": 2.0}
    schema = T.StructType([f for f in LOCATIONS.silver_schema if f.name in LOCATIONS.columns])
    frame = spark.createDataFrame([tuple(row[f.name] for f in schema)] * 2, schema).coalesce(1)
    for leaf, part in (("A/city_clean=a", frame), ("A/city_clean=b %2F+", frame.limit(0)), ("__HIVE_DEFAULT_PARTITION__/city_clean=c", frame)):
        part.write.parquet(f"{fresh}/s/state_clean={leaf}")
    found = quality.layout(spark, f"{fresh}/s", LOCATIONS).collect()
    assert sorted(tuple(r) for r in found) == [("", 1, 2, 2, True), ("A", 2, 2, 0, False)]


def test_a_report_with_many_rows_is_summed(spark):
    many = spark.range(1000).selectExpr("'own' as check_name", "'s' as subject", "1L as bad_rows", "id <> 7 as passed")
    with pytest.raises(quality.QualityGateError, match="own on s: 1000"):
        quality.gate(many)


def test_a_report_with_a_subject_per_row_is_bounded(spark):
    columns = ("'own' as check_name", "concat('s', id) as subject", "id as bad_rows", "id < 199990 as passed")
    many = spark.range(0, 200_000, 1, 16).selectExpr(*columns)
    with pytest.raises(quality.QualityGateError) as raised:
        quality.gate(many, many.withColumn("check_name", F.lit("again")), worst=4)
    found = [tuple(r)[1:3] for r in raised.value.report if r["check_name"] == "own"]
    assert found == [("s199999", 199999), ("s199998", 199998), ("s199997", 199997), ("s199996", 199996), ("199996 more", sum(range(199_996)))]
    assert len(raised.value.report) == 10 and len(str(raised.value)) < 400
    passing = quality.gate(many.filter("passed"), worst=2).collect()
    assert [tuple(r)[1:] for r in passing] == [("s199989", 199989, True), ("s199988", 199988, True), ("199988 more", sum(range(199_988)), True)]


def test_subjects_may_be_null_or_few(spark):
    rows = [("a", None, 3, True), ("a", None, 2, True), ("a", "x", 1, True), ("b", "y", 0, True)]
    report = spark.createDataFrame(rows, quality.REPORT_SCHEMA)
    assert [tuple(r) for r in quality.gate(report).collect()] == [("a", None, 5, True), ("a", "x", 1, True), ("b", "y", 0, True)]
    assert quality.gate(report.limit(0)).count() == 0


def _rows_into_shuffles(found):
    """Rows that the filter over suspects reads, and those that it lets into the shuffle."""
    plan = found._jdf.queryExecution().optimizedPlan()
    joins = [n for n in _nodes(plan) if n.nodeName() == "Join" and "row_hash_word" in n.condition().toString()]
    session = found.sparkSession
    rows = session._jvm.org.apache.spark.sql.classic.Dataset.ofRows
    count = lambda nodes: sum(rows(session._jsparkSession, n).count() for n in nodes)
    return count([j.left() for j in joins]), count(joins)


def _nodes(plan):
    yield plan
    children = plan.children()
    for k in range(children.size()):
        yield from _nodes(children.apply(k))


def test_rows_drop_before_the_shuffle_among_many_suspects(spark):
    """Three million suspects; of two million other rows few come behind the filter."""
    twice = spark.range(0, 6_000_000, 1, 8).selectExpr("id % 3000000 as id")
    frame = twice.union(spark.range(3_000_000, 5_000_000, 1, 4))
    found = quality.duplicate_rows(frame)
    assert found.agg(F.count("*"), F.min("n"), F.max("n")).first()[:3] == (3_000_000, 2, 2)
    scanned, kept = _rows_into_shuffles(found)
    assert kept < 6_000_000 + 2_000_000 * 0.07 < scanned


def test_non_empty(dirty):
    assert quality.non_empty(dirty, "x").first()["non_empty"] is True
    assert quality.non_empty(dirty.filter("id = '9'"), "x").first()["non_empty"] is False


def test_totals(spark):
    gold = spark.createDataFrame([("A", "a", "t", 2), ("B", "b", "t", 1)], LOCATIONS.gold_schema)
    row = quality.totals(spark.range(3), spark.range(3), gold, LOCATIONS).first()
    assert tuple(row) == (3, 3, 3, True)
    row = quality.totals(spark.range(4), spark.range(3), gold.limit(0), LOCATIONS).first()
    assert tuple(row) == (4, 3, 0, False)


def test_gate(dirty):
    passing = quality.gate(quality.report_missing(dirty, ["id"], allowed_nulls=1, allowed_blanks=0))
    assert sorted(tuple(r) for r in passing.collect()) == [
        ("blank_keys", "id", 0, True), ("null_keys", "id", 1, True),
    ]
    with pytest.raises(quality.QualityGateError, match="duplicates on id: 1") as raised:
        quality.gate(
            quality.report_missing(dirty, ["id"], allowed_nulls=1),
            quality.report_duplicates(dirty, ["id"]),
            quality.report_types(dirty, {"number": ["double"]}),
        )
    assert [r["check_name"] for r in raised.value.report] == ["duplicates", "types"]
