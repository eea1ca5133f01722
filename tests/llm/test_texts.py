import random
import re

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm import texts

TEXTS = ["", None, "one", " two  Three\t\n", "é ü Ä\x0b\x0cx\r", "\x1c a b  ", "w" * 900, "a " * 400, "  "]


def plain(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


@pytest.mark.parametrize("block", [7, 64, 1 << 19])
def test_words_by_blocks(monkeypatch, block):
    monkeypatch.setattr(texts, "BLOCK_BYTES", block)
    rng = random.Random(block)
    many = TEXTS + ["".join(rng.choice("aB é\n") for _ in range(rng.randint(0, 200))) for _ in range(60)]
    array = pa.array(many, pa.string())
    rows, hashes = texts.word_hashes(array)
    want = [(k, w) for k, t in enumerate(many) for w in plain(t)]
    assert rows.tolist() == [k for k, _ in want]
    by_word = {}
    for (_, word), h in zip(want, hashes.tolist(), strict=True):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)
    data, offsets = texts.flat(array)
    cuts = list(texts.blocks(data, offsets))
    assert [s for s, _ in cuts] == [0, *[e for _, e in cuts[:-1]]] and cuts[-1][1] == len(data)


def test_flat_of_a_slice_and_of_chunks():
    array = pa.array(TEXTS, pa.string())
    data, offsets = texts.flat(array[2:5])
    assert data.tobytes() == "".join(t for t in TEXTS[2:5]).encode() and len(offsets) == 4
    data, offsets = texts.flat(pa.chunked_array([array[:3], array[3:]]))
    assert data.tobytes() == "".join(t or "" for t in TEXTS).encode() and len(offsets) == len(TEXTS) + 1
    assert texts.flat(pa.array([], pa.string()))[1].tolist() == [0]


def test_range_hash_depends_on_bytes_alone():
    data = np.frombuffer(b"abcabcab" * 4, np.uint8)
    sums = texts.prefix_sums(data)
    h = texts.range_hash(sums, np.array([0, 8, 16, 3, 0]), np.array([5, 13, 21, 8, 4]))
    assert h[0] == h[1] == h[2] == h[3] != h[4]


def test_slices_hold_every_text_once(monkeypatch):
    monkeypatch.setattr(texts, "BLOCK_BYTES", 50)
    array = pa.array(TEXTS, pa.string())
    assert [t for part in texts.slices(array) for t in part.to_pylist()] == TEXTS
    assert list(texts.slices(pa.array([], pa.string()))) == []


def test_batches_are_bounded_but_never_widened(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, bound in (("10000", "1000"), ("70", "70"), ("0", "1000")):
            spark.conf.set(name, given)
            texts.bound_batches(spark.range(1))
            assert spark.conf.get(name) == bound
    finally:
        spark.conf.set(name, before)
