import base64
import glob
import hashlib
import io

import pytest
import zstandard

from siltstone.llm import joins, warc

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (1, "http://a/1", "one"),
    (2, "http://a/2", "two"),
    (3, "http://a/3", "one"),
    (7, "http://a/7", "one"),
    (7, "http://b/7", "one"),
    (None, "http://a/0", "one"),
    (4, None, None),
    (5, "http://a/5", ""),
    (None, None, None),
    (6, "http://a/\r\nX: 1%0D", "Überlänge 𝒳\r\n\r\nWARC/1.1\r\n" * 50_000),
    (8, "http://a/8", "two"),
    (8, "http://a/8", "two"),
]


def plain(rows):
    out = []
    for page_id, _, html in rows:
        ids = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        kept = max(ids, default=None)
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        revisit = page_id != kept
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", kept if revisit else None))
    return sorted(out, key=str)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' as payload", "1 as rows", "'y' as record_id")


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_round_trip_of_odd_rows(pages):
    assert result(warc.round_trip(pages)) == plain(ROWS)


def test_round_trip_without_a_broadcast(pages, monkeypatch):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(joins, "HEAVY_ROWS", 3)
    assert result(warc.round_trip(pages)) == plain(ROWS)


def test_no_pages(spark):
    found = warc.round_trip(spark.createDataFrame([], SCHEMA))
    assert found.collect() == []
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_bundles_are_plain_zstandard_with_frames_of_their_own(spark, fresh, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 5000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 40_000)
    pages = spark.range(200).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(cast(id as string), 300) as html")
    path = f"{fresh}/bundles"
    warc.write_bundles(warc.plan_records(pages).repartition(2), path)
    files = sorted(glob.glob(f"{path}/part-*"))
    assert len(files) > 2
    records = 0
    for name in files:
        data = open(name, "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        opened = warc.Opened(data)
        frames = [opened.frame(k) for k in range(len(opened.sizes) - 1)]
        assert b"".join(frames) == whole and len(frames) > 1
        assert all(len(f) <= 5000 for f in frames)
        records += whole.count(b"WARC/1.1\r\n")
    assert records == 200
    read = warc.read_records(spark, path).collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in read} == {i: str(i) * 300 for i in range(200)}
    assert {r["url"] for r in read} == {f"http://h/{i}" for i in range(200)}
    index = warc.read_index(spark, path).collect()
    assert {tuple(r) for r in index} == {(r["bundle"], r["record_id"], r["frame"], r["offset"], r["length"]) for r in read}


def test_fetch_reads_records_and_what_they_revisit(spark, pages, fresh, monkeypatch):
    path = f"{fresh}/bundles"
    warc.write_bundles(warc.plan_records(pages), path)
    records = warc.read_records(spark, path)
    wanted = records.filter("page_id in (1, 2, 6)").select("record_id")
    for limit in (1000, 0):
        monkeypatch.setattr(warc, "NAMED_BUNDLES", limit)
        found = {r["page_id"]: r for r in warc.fetch(spark, path, wanted.union(wanted)).collect()}
        assert {k: bytes(r["payload"]).decode() for k, r in found.items()} == {1: "one", 2: "two", 6: ROWS[9][2]}
        assert found[1]["record_type"] == "revisit" and found[6]["url"] == ROWS[9][1]
    assert warc.fetch(spark, path, wanted.filter("false")).count() == 0
    assert warc.fetch(spark, path, spark.sql("select 'nothing' as record_id")).count() == 0


def test_a_revisit_names_a_response_that_is_there(spark, pages, fresh):
    path = f"{fresh}/bundles"
    warc.write_bundles(warc.plan_records(pages), path)
    records = warc.read_records(spark, path)
    responses = {r["record_id"] for r in records.filter("record_type = 'response'").collect()}
    revisits = records.filter("record_type = 'revisit'").collect()
    assert revisits and all(r["refers_to_id"] in responses for r in revisits)


def test_damage_is_an_error(spark, fresh):
    path = f"{fresh}/bundles"
    warc.write_bundles(warc.plan_records(spark.createDataFrame(ROWS[:3], SCHEMA)).coalesce(1), path)
    data = open(glob.glob(f"{path}/part-*")[0], "rb").read()
    with pytest.raises(ValueError, match="seek table"):
        warc.Opened(data[:-1])
    with pytest.raises(ValueError, match="add up"):
        warc.Opened(data[5:])
    opened = warc.Opened(data)
    record = opened.frame(0)
    with pytest.raises(ValueError, match="cut short"):
        warc.parse_record(record[: next(opened.directory())[3] - 6])
    opened.sizes[0] = (*opened.sizes[0][:2], 0)
    with pytest.raises(ValueError, match="checksum"):
        opened.frame(0)


def test_no_payload_is_shuffled_when_repeats_are_few(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = warc.plan_records(pages)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
