"""Writers: files per leaf, overwrite rules, lossless landing, markers."""

from __future__ import annotations

import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siltstone import runtime
from siltstone.operators.aggregates import file_count
from siltstone.operators.cleaning import clean, with_clean_keys
from siltstone.sinks import bronze, layers
from siltstone.sinks.bronze import land_array_documents, land_frame, land_record_text
from siltstone.sinks.layers import is_complete, write_gold, write_silver
from siltstone.sinks.responses import write_responses
from siltstone.sources.layers import read_silver
from siltstone.sources.records import record_lines
from siltstone.spec import LOCATIONS
from siltstone.versions import current, newest


def _keyed(spark, rows):
    """Rows of (id, state, city)."""
    raw = spark.createDataFrame(rows, "id string, state string, city string")
    others = [c for c in LOCATIONS.columns if c not in raw.columns]
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in others})
    return with_clean_keys(clean(raw, LOCATIONS), LOCATIONS)


def _leaf_files(path):
    return glob.glob(f"{path}/v*/state_clean=*/city_clean=*/*.parquet")


def test_one_file_per_leaf(spark, fresh):
    rows = [(str(i), f"S{i % 5}", f"C{i % 7}") for i in range(1000)]
    path = f"{fresh}/s"
    assert write_silver(_keyed(spark, rows).repartition(16), path, LOCATIONS)["n_rows"] == 1000
    assert len(_leaf_files(path)) == 35
    silver = read_silver(spark, path, LOCATIONS)
    assert silver.count() == 1000
    assert file_count(silver).first()["n_files"] == 35


def _hot(spark, text):
    """A third of 200,000 rows in one leaf, the rest over 50."""
    small = F.concat(F.lit("S"), F.col("id") % 50)
    rows = spark.range(0, 200_000, 1, 16).select(
        text.alias("id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(small).alias("state"),
        F.lit("C").alias("city"),
    )
    others = [c for c in LOCATIONS.columns if c not in rows.columns]
    return with_clean_keys(rows.withColumns({c: F.lit("") for c in others}), LOCATIONS)


@pytest.mark.parametrize("piece_rows", [None, 10_000])
def test_a_hot_leaf_is_split(spark, fresh, piece_rows):
    keyed = _hot(spark, F.sha2(F.col("id").cast("string"), 256))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        assert write_silver(keyed, f"{fresh}/s", LOCATIONS, piece_rows=piece_rows)["n_rows"] == 200_000
    finally:
        spark.conf.set(name, before)
    assert len(glob.glob(f"{fresh}/s/v*/state_clean=HOT/*/*.parquet")) > 1
    silver = read_silver(spark, f"{fresh}/s", LOCATIONS)
    assert silver.columns == [f.name for f in LOCATIONS.silver_schema]
    assert silver.agg(F.countDistinct("id")).first()[0] == 200_000


@pytest.mark.parametrize(("copies", "largest"), [(False, 11_000), (True, 20_000)])
def test_hot_leaves_have_pieces_even_of_copies(spark, copies, largest):
    text = F.lit("same") if copies else F.col("id").cast("string")
    pieces = layers._with_pieces(_hot(spark, text), LOCATIONS, 10_000)
    found = pieces.groupBy("state", layers._PIECE).count().collect()
    hot = [r["count"] for r in found if r["state"] == "HOT"]
    assert len(hot) == 7 and sum(hot) == 66_667 and max(hot) <= largest
    assert {r[layers._PIECE] for r in found if r["state"] != "HOT"} == {0}


@pytest.mark.parametrize("limit", [runtime.BROADCAST_LIMIT_BYTES, 0])
def test_every_leaf_above_the_bound_is_cut(spark, monkeypatch, limit):
    monkeypatch.setattr(layers, "fits_broadcast", lambda df: runtime.fits_broadcast(df, limit))
    rows = [(str(i), f"S{i % 500}", "C") for i in range(15_000)] + [(f"x{i}", "SMALL", "C") for i in range(9)]
    found = layers._with_pieces(_keyed(spark, rows), LOCATIONS, 10).groupBy("state").agg(
        F.countDistinct(layers._PIECE).alias("pieces"), F.count("*").alias("n")
    )
    by_state = {r["state"]: (r["pieces"], r["n"]) for r in found.collect()}
    assert by_state.pop("SMALL") == (1, 9)
    assert len(by_state) == 500 and all(n == 30 and pieces > 1 for pieces, n in by_state.values())


@pytest.mark.parametrize(("keep", "ids"), [(True, ["1", "3"]), (False, ["3"])])
def test_second_load(spark, fresh, keep, ids):
    path = f"{fresh}/s"
    write_silver(_keyed(spark, [("1", "A", "a"), ("2", "B", "b")]), path, LOCATIONS)
    assert write_silver(_keyed(spark, [("3", "B", "b")]), path, LOCATIONS, keep)["n_rows"] == 1
    found = read_silver(spark, path, LOCATIONS).select("id").collect()
    assert sorted(r["id"] for r in found) == ids


def test_a_load_of_single_leaves_marks_the_layer(spark, fresh):
    write_silver(_keyed(spark, [("1", "A", "a")]), f"{fresh}/s", LOCATIONS, keep_other_leaves=True)
    assert is_complete(spark, f"{fresh}/s")
    assert [r["id"] for r in read_silver(spark, f"{fresh}/s", LOCATIONS).collect()] == ["1"]


def test_nothing_to_write(spark, fresh):
    assert write_silver(_keyed(spark, [("1", "A", "a")]).limit(0), f"{fresh}/s", LOCATIONS)["n_rows"] == 0
    assert is_complete(spark, f"{fresh}/s")


def test_landing_keeps_nulls_and_microseconds(spark, fresh):
    frame = spark.sql(
        "SELECT 1 AS id, CAST(NULL AS STRING) AS never, "
        "TIMESTAMP_NTZ '2024-01-02 03:04:05.678901' AS seen, "
        "TIMESTAMP '2024-01-02 03:04:05.678901' AS at, named_struct('x', CAST(NULL AS INT)) AS deep"
    )
    land_frame(frame, f"{fresh}/b")
    lines = [line for f in glob.glob(f"{fresh}/b/v*/*.json") for line in open(f, encoding="utf-8")]
    record = json.loads(lines[0])
    assert record["never"] is None and record["deep"] == {"x": None}
    assert record["seen"] == "2024-01-02T03:04:05.678901"
    assert record["at"].startswith("2024-01-02T03:04:05.678901")
    back = spark.read.schema(frame.schema).json(current(spark, f"{fresh}/b"))
    assert back.collect() == frame.collect()


def test_array_documents_hold_every_record(spark, fresh):
    texts = [json.dumps({"i": i, "t": 'a\n"é'}) for i in range(25)]
    records = spark.createDataFrame([(t,) for t in texts], "record string").repartition(3)
    land_array_documents(records, f"{fresh}/a")
    found = []
    for name in glob.glob(f"{fresh}/a/v*/*.txt"):
        found += json.load(open(name, encoding="utf-8"))
    assert sorted(found, key=lambda r: r["i"]) == [json.loads(t) for t in texts]


def test_array_documents_are_bounded(spark, fresh):
    """One partition of many advisory sizes gives many documents, each readable."""
    records = spark.range(40_000).coalesce(1).select(
        F.to_json(F.struct(F.col("id").alias("i"), F.sha2(F.col("id").cast("string"), 512).alias("t"))).alias("record")
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256k")
    try:
        land_array_documents(records, f"{fresh}/a")
    finally:
        spark.conf.set(name, before)
    documents = [json.load(open(f, encoding="utf-8")) for f in glob.glob(f"{fresh}/a/v*/*.txt")]
    assert len(documents) >= 20 and max(map(len, documents)) < 3_000
    assert sorted(r["i"] for d in documents for r in d) == list(range(40_000))


def test_array_documents_without_records(spark, fresh):
    land_array_documents(spark.createDataFrame([], "record string").coalesce(1), f"{fresh}/a")
    for name in glob.glob(f"{fresh}/a/v*/*.txt"):
        if os.path.getsize(name):
            assert json.load(open(name, encoding="utf-8")) == []


def test_text_landing_replaces(spark, fresh):
    for text in ('{"a":1}', '{"b":null}'):
        land_record_text(spark.createDataFrame([(text,)], "record string"), f"{fresh}/b")
    assert [r["value"] for r in record_lines(spark, f"{fresh}/b").collect()] == ['{"b":null}']


def test_landed_lines_are_packed_into_bounded_files(spark, fresh, monkeypatch):
    monkeypatch.setitem(bronze._PACKED, "maxRecordsPerFile", "1000")
    texts = [json.dumps({"id": f"n{i}", "name": f'é "{i}', "state": None, "phone": ""}) for i in range(4500)]
    records = spark.createDataFrame([(t,) for t in texts], "record string").coalesce(1)
    land_record_text(records, f"{fresh}/b")
    assert len(glob.glob(f"{fresh}/b/v*/part-*")) == 5
    version = newest(spark, f"{fresh}/b")
    assert version.rows == 4500 and version.bytes * 3 < sum(map(len, texts))
    assert sorted(r["value"] for r in record_lines(spark, f"{fresh}/b").collect()) == sorted(texts)


def test_gold_is_replaced_and_marked(spark, fresh):
    assert not is_complete(spark, f"{fresh}/g")
    for n in (3, 2):
        write_gold(spark.range(n), f"{fresh}/g")
    assert spark.read.parquet(current(spark, f"{fresh}/g")).count() == 2
    assert is_complete(spark, f"{fresh}/g")


def test_a_folder_without_marker_is_not_complete(spark, fresh):
    os.makedirs(f"{fresh}/g/_temporary")
    assert not is_complete(spark, f"{fresh}/g")


def test_responses_are_kept_in_short_groups(spark, fresh):
    body = F.repeat(F.sha2(F.col("id").cast("string"), 512), 100)
    pages = spark.range(1, 2001, 1, 1).select(
        F.col("id").cast("int").alias("page"), F.lit(200).alias("status"), body.alias("body")
    )
    write_responses(pages, f"{fresh}/r")
    (name,) = glob.glob(f"{fresh}/r/*.parquet")
    groups = pq.ParquetFile(name).metadata
    assert {groups.row_group(i).num_rows for i in range(groups.num_row_groups)} <= {256, 2000 % 256}
    assert spark.read.parquet(f"{fresh}/r").count() == 2000
