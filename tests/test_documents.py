import json
import random
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from siltstone.plans.refine import bronze_to_silver
from siltstone.sources import documents
from siltstone.sources.records import read_json_arrays, read_union_of_keys
from siltstone.spec import LOCATIONS

TEXT = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "t", "n")])
HARD = ['}', '{', '"', "\\", '\\"', '"}', "]}", "[{", "\\\\}", "é}𝒳", ", {", "}, {", "\n}", " ", "", "}\\", '{"id": "no"}']


def _some_records(seed, n):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice([*HARD, "plain ", "x"]) for _ in range(rng.randrange(9)))
    return [
        {"id": str(i), "t": text(), **({"n": {text(): [text(), {"deep": [1, {}]}]}} if i % 3 == 0 else {})}
        for i in range(n)
    ]


@pytest.fixture
def tiny(spark):
    """Ranges of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def ranges(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield ranges
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def _write(fresh, name, text):
    Path(fresh, "docs").mkdir(exist_ok=True)
    Path(fresh, "docs", name).write_text(text, encoding="utf-8")
    return f"{fresh}/docs"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("size", [40, 333, 4000])
def test_records_are_those_of_the_whole_text(spark, fresh, tiny, monkeypatch, size, broadcast):
    if not broadcast:
        monkeypatch.setattr(documents, "fits_broadcast", lambda df: False)
    # Laid out over lines, on one line, in a file of few bytes, and with long records.
    path = _write(fresh, "a.json", json.dumps(_some_records(1, 60), indent=4))
    _write(fresh, "b.json", json.dumps(_some_records(2, 40), ensure_ascii=False, separators=(",", ":")))
    _write(fresh, "c.json", "  [ ]\n")
    _write(fresh, "d.json", json.dumps([{"id": "long", "t": "}{" * 3000}, {"id": "", "t": None}]))
    _write(fresh, "e.json", "   ")
    want = _rows(read_json_arrays(spark, path, TEXT))
    assert len(want) == 102
    keys = read_union_of_keys(spark, path, arrays=True).columns
    tiny(size)
    assert _rows(read_json_arrays(spark, path, TEXT)) == want
    assert read_union_of_keys(spark, path, arrays=True).columns == keys


BAD = [
    '[{"id":"1"}][{"id":"2"}]', '[{"id":"1"}],[{"id":"2"}]', '[{"id":"1"}] rest', '[{"id":"1"}, null]', "null",
    '[{"id":"a\tb"}]', '[{"id":"1"}', '[{"id":"1"', '{"id":"1"}', '[{"id":"1"},]', '[{"id":"1"} {"id":"2"}]',
    '[null, {"id":"1"}]', '[[{"id":"1"}]]', '[{"id":"1"}, 7, {"id":"2"}]', 'x[{"id":"1"}]', '[{"id":"1"}]]', "[",
    '[{"id":"1}]', ',{"id":"1"}]', '[{"id":"1"}]}', " \n ",
]


@pytest.mark.parametrize("text", BAD)
def test_what_is_not_one_array_of_records_fails(spark, fresh, tiny, text):
    path = _write(fresh, "a.json", text)
    tiny(5 if len(text) > 5 else 1)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_json_arrays(spark, path, TEXT).collect()


def test_a_long_document_becomes_a_clean_layer(spark, fresh, tiny):
    records = [dict.fromkeys(LOCATIONS.columns) | {"id": str(i), "state": "S{", "city": "}"} for i in range(300)]
    path = _write(fresh, "a.json", json.dumps(records, indent=1))
    tiny(10_000)
    assert documents.record_texts(spark, path).rdd.getNumPartitions() > 4
    assert bronze_to_silver(spark, path, f"{fresh}/silver", LOCATIONS, arrays=True).n_rows == 300
