"""Paged responses: whole sets, broken sets, order, progress."""

from __future__ import annotations

import glob
import io
import json
import os
import subprocess
import sys
from pathlib import Path
from urllib.error import HTTPError

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from siltstone.operators.ordering import in_ingest_order
from siltstone.sources import pages
from siltstone.sources.fetch import http_get, land_responses
from siltstone.sources.pages import IncompleteIngestError, ingest, page_progress, pages_before_end

FIRST = (1, 200, json.dumps([{"id": "a", "n": None, "deep": {"x": [1, 1.5]}}, {"id": "b"}], indent=2))
SECOND = (2, 200, '[{"id": "c", "big": 123456789012345678901234567890}]')
END = (3, 200, "[ ]")


def _responses(spark, *rows):
    return spark.createDataFrame(list(rows), "page bigint, status int, body string")


def test_records_in_order_up_to_the_first_empty_page(spark):
    late = [(4, 200, '[{"id": "z"}]'), (5, 500, "boom"), (5, 200, "not json")]
    found = in_ingest_order(ingest(_responses(spark, *late, END, SECOND, FIRST))).collect()
    assert [(r["page"], r["pos"]) for r in found] == [(1, 0), (1, 1), (2, 0)]
    bodies = json.loads(FIRST[2]) + json.loads(SECOND[2])
    assert [json.loads(r["record"]) for r in found] == bodies


@pytest.mark.parametrize("body", ["[]", " [\n] ", "{}", "null"])
def test_what_ends_the_set(spark, body):
    assert ingest(_responses(spark, FIRST, (2, 200, body))).count() == 2


def test_a_set_may_be_empty(spark):
    assert ingest(_responses(spark, (1, 200, "[]"))).count() == 0


BROKEN = {
    "page 2 came back with 500": [FIRST, (2, 500, "[]"), END],
    "page 2 came back with None": [FIRST, (2, None, "[]"), END],
    "page 1 came back with 404": [(1, 404, ""), (2, 200, "[]")],
    "page 2 does not hold": [FIRST, (2, 200, '[{"id": "c"}, {"id":'), END],
    "page 1 does not hold": [(1, 200, '{"message": "slow down"}'), (2, 200, "[]")],
    "page 2 does not": [FIRST, (2, 200, None), END],
    "page 2 does": [FIRST, (2, 200, '[{"id":1},{"id":"a\tb"},{"id":3}]'), END],
    "page 2 doe": [FIRST, (2, 200, '[{"id":1}][{"id":2}]'), END],
    "page 2 do": [FIRST, (2, 200, '[{"id":1}],[{"id":2}]'), END],
    "page 2 d": [FIRST, (2, 200, '[{"id":1}] rest'), END],
    "page 2 ": [FIRST, (2, 200, '[{"id":1}, null]'), END],
    "page 2": [FIRST, (2, 200, '[{"id":1}, 7]'), END],
    "2 pages expected": [FIRST, END],
    "found 3 rows for 2 pages": [FIRST, SECOND, SECOND, END],
    "found 2 rows for 1 pages": [FIRST, FIRST, END],
    "no empty page": [FIRST, SECOND],
    "1 responses without": [FIRST, SECOND, END, (None, 200, "[]")],
    "numbering starts at 0": [(0, 200, FIRST[2]), FIRST, END],
}


@pytest.mark.parametrize("message", list(BROKEN))
def test_broken_sets(spark, message):
    with pytest.raises(IncompleteIngestError, match=message):
        ingest(_responses(spark, *BROKEN[message]))


def test_long_texts_are_kept_whole(spark):
    text = "x" * 21_000_000
    responses = _responses(spark, (1, 200, json.dumps([{"id": text}, {"id": "b"}])), (2, 200, "[]"))
    lengths = [len(json.loads(r["record"])["id"]) for r in in_ingest_order(ingest(responses)).collect()]
    assert lengths == [21_000_000, 1]
    assert page_progress(pages_before_end(responses)).first()["n"] == 2


def test_numbers_are_written_anew(spark):
    body = '[{"a": 1.10, "b": 0.1234567890123456789012, "c": 1e400, "d": 12345678901234567890}]'
    found = ingest(_responses(spark, (1, 200, body), (2, 200, "[]"))).first()["record"]
    assert found == '{"a":1.1,"b":0.12345678901234568,"c":"Infinity","d":12345678901234567890}'


def test_progress_rejects_what_the_ingest_rejects(spark):
    for message in ("page 2 does", "page 2 doe", "page 2 ", "page 2"):
        with pytest.raises((PySparkException, Py4JJavaError)):
            page_progress(pages_before_end(_responses(spark, *BROKEN[message]))).collect()


@pytest.mark.parametrize("block", [1, 3, 65536])
def test_progress(spark, monkeypatch, block):
    monkeypatch.setattr(pages, "_BLOCK", block)
    rows = [(p, 200, json.dumps([{"id": i} for i in range(p % 4 + 1)])) for p in range(1, 12)]
    found = page_progress(pages_before_end(_responses(spark, *rows, (12, 200, "[]"))))
    so_far, expected = 0, []
    for page in range(1, 12):
        so_far += page % 4 + 1
        expected.append((page, page % 4 + 1, so_far))
    assert sorted(tuple(r) for r in found.collect()) == expected


def _served(pages_with_records, failing=None):
    """A stand-in for the network: answers by page number."""

    def fetch(page):
        if page == failing:
            return 500, "timed out"
        records = [{"id": f"{page}-{i}"} for i in range(2)] if page <= pages_with_records else []
        return 200, json.dumps(records)

    return fetch


@pytest.mark.parametrize("pages_with_records", [0, 3, 4, 9])
def test_fetched_in_waves(spark, fresh, pages_with_records):
    landed = land_responses(spark, _served(pages_with_records), f"{fresh}/r", pages_per_wave=4, tasks=2)
    ids = sorted(json.loads(r["record"])["id"] for r in ingest(landed).collect())
    assert ids == sorted(f"{p}-{i}" for p in range(1, pages_with_records + 1) for i in range(2))


def test_a_failed_page_stops_the_fetch_and_the_ingest(spark, fresh):
    landed = land_responses(spark, _served(100, failing=6), f"{fresh}/r", pages_per_wave=4, tasks=2)
    assert landed.count() == 8
    with pytest.raises(IncompleteIngestError, match="page 6 came back with 500"):
        ingest(landed)


class _Answer(io.BytesIO):
    status = 200


def test_http_get(monkeypatch):
    asked = []

    def urlopen(url, timeout):
        asked.append((url, timeout))
        if "page=2" in url:
            raise HTTPError(url, 503, "busy", {}, None)
        return _Answer("[é]".encode())

    monkeypatch.setattr("urllib.request.urlopen", urlopen)
    fetch = http_get("http://host/items?per_page=50&page={page}", timeout=5)
    assert [fetch(1), fetch(2)] == [(200, "[é]"), (503, "")]
    assert asked[0] == ("http://host/items?per_page=50&page=1", 5)


_ONE_SCAN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from siltstone.sources.pages import ingest
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", {folder!r} + "/set-down").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.compress", "false").config("spark.eventLog.dir", {folder!r}).getOrCreate())
rows = [(n, 200, '[{{"id": "%d"}}, {{"id": "x"}}]' % n) for n in range(1, 40)]
rows += [(40, 200, "[]"), (41, 200, '[{{"id": "late"}}]'), (42, 200, "broken"), (43, 500, "late")]
spark.createDataFrame(rows, "page bigint, status int, body string").write.parquet({folder!r} + "/responses")
records = ingest(spark.read.parquet({folder!r} + "/responses"))
assert records.count() == 78 and records.filter("record like '%late%'").count() == 0
spark.stop()
"""


def test_bodies_are_read_once(fresh):
    root = str(Path(__file__).resolve().parent.parent)
    subprocess.run([sys.executable, "-c", _ONE_SCAN.format(root=root, folder=fresh)], check=True, timeout=300)
    plans = []
    for log in glob.glob(f"{fresh}/**/*local-*", recursive=True):
        if os.path.isfile(log):
            events = [json.loads(line) for line in Path(log).read_text(encoding="utf-8").splitlines()]
            plans += [e["physicalPlanDescription"] for e in events if e["Event"].endswith("SQLExecutionStart")]
    scans = [line for plan in plans for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert [s for s in scans if "page" in s] and sum("body" in s for s in scans) == 1
