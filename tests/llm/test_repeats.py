import hashlib
import bisect
import random

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm import repeats, texts


def brute(rows):
    """Marks bytes by looking every 100-byte string up among all earlier ones."""
    seen, out = {}, []
    for doc_id, raw in sorted(set(rows)):
        for s in range(len(raw) - 99):
            seen.setdefault(raw[s : s + 100], (doc_id, s))
    for doc_id, raw in rows:
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for s in range(len(raw) - 99):
            if seen[raw[s : s + 100]] < (doc_id, s):
                gone[s : s + 100] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        n_spans = int(((~gone[:-1]) & gone[1:]).sum()) + int(gone[0])
        out.append((doc_id, len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in repeats.report(frame).collect())


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(params=["one range", "many ranges"])
def ranges(request, monkeypatch):
    if request.param == "many ranges":
        monkeypatch.setattr(repeats, "PART_BYTES", 4000)


def planted(seed, n_docs):
    rng = random.Random(seed)
    common = [words(rng, k) for k in (12, 25, 40, 90, 200)]
    rows = []
    for k in range(n_docs):
        parts = [words(rng, rng.randint(0, 60)) for _ in range(3)]
        if rng.random() < 0.7:
            piece = rng.choice(common)
            cut = rng.randint(0, len(piece) // 2)
            parts.insert(rng.randint(0, 3), piece[cut:] if rng.random() < 0.5 else piece)
        if rng.random() < 0.2:
            parts.append(common[2])
        if rng.random() < 0.1 and rows:
            parts = [rng.choice(rows)[1]]
        rows.append((k * 3, "|".join(parts)))
    rows += [(5, "x" * 700), (8, "xy" * 300), (11, words(rng, 20) * 9), (14, ""), (17, "short"), (20, "x" * 99), (23, "x" * 100)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_planted_passages(spark, ranges, seed):
    rows = planted(seed, 120)
    assert found(spark, rows) == brute([(d, t.encode()) for d, t in rows])


def brute_by_window_hash(rows):
    """The same for whole tables: a 64-bit hash of every window, sorted, instead of its bytes."""
    rows = sorted(rows)
    data = np.frombuffer(b"".join(raw for _, raw in rows), np.uint8)
    ends = np.cumsum([len(raw) for _, raw in rows])
    table = np.random.default_rng(77).integers(0, 1 << 63, 256, dtype=np.uint64)
    n = len(data) - 99
    h = np.zeros(n, np.uint64)
    for k in range(100):
        h = ((h << np.uint64(1)) | (h >> np.uint64(63))) ^ table[data[k : k + n]]
        h *= np.uint64(0xFF51AFD7ED558CCD)
    inside = np.flatnonzero(np.arange(n) + 100 <= ends[np.searchsorted(ends, np.arange(n), side="right")])
    order = np.argsort(h[inside], kind="stable")
    again = inside[order][1:][h[inside][order][1:] == h[inside][order][:-1]]
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + 100, -1)
    gone, out, start = np.cumsum(change[:-1]) > 0, [], 0
    for (doc_id, raw), end in zip(rows, ends, strict=True):
        g = gone[start:end]
        kept = data[start:end][~g].tobytes()
        n_spans = int((np.diff(np.concatenate([[0], g.astype(np.int8)])) > 0).sum())
        out.append((doc_id, len(raw), int(g.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
        start = end
    return out


def test_whole_table(spark, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    raws = [(d, t.encode()) for d, t in rows]
    small = [(d, raw) for d, raw in raws if len(raw) < 900]
    assert brute_by_window_hash(small) == brute(small)
    assert found(spark, rows) == brute_by_window_hash(raws)


def test_frequent_passage_in_many_surroundings(spark, ranges):
    rng = random.Random(4)
    passage = words(rng, 45)
    rows = [(k, words(rng, rng.randint(1, 12)) + passage + words(rng, rng.randint(1, 12))) for k in range(300)]
    assert found(spark, rows) == brute([(d, t.encode()) for d, t in rows])


def test_texts_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1500)
    rows = planted(7, 30) + [(900, words(random.Random(8), 2000))]
    rows.append((901, rows[-1][1][777:9000]))
    data, offsets = texts.flat(pa.array([t for _, t in rows]))
    stretches = list(repeats._starts(offsets))
    assert stretches[0][0] == 0 and all(a[1] == b[0] for a, b in zip(stretches, stretches[1:], strict=False))
    assert max(e - s for s, e, _ in stretches) <= 1500
    ends = [(int(r), int(lo), int(hi)) for row, _, _, low, high in repeats.units(data, offsets) for r, lo, hi in zip(row, low, high, strict=True)]
    starts = sorted(s for r, lo, hi in ends for s in range(lo, hi + 1))
    assert starts == [s for k in range(len(rows)) for s in range(offsets[k], max(offsets[k], offsets[k + 1] - 99))]


def test_merge_gives_order_and_common_prefixes():
    rng = random.Random(6)
    runs = []
    for k in range(37):
        strings = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 30)))
        run = [(s, b"", k, j) for j, s in enumerate(strings)]
        runs.append(repeats._unpack_run(repeats._pack_run(run)) if run else ([], []))
    before, repeats.FAN_IN = repeats.FAN_IN, 8
    try:
        merged, common = repeats.merge(runs)
    finally:
        repeats.FAN_IN = before
    strings = [e[0] for e in merged]
    assert strings == sorted(e[0] for run, _ in runs for e in run)
    assert common[1:] == repeats.front_code(strings).tolist()[1:]
    assert sorted(e[2:] for e in merged) == sorted(e[2:] for run, _ in runs for e in run)


def test_known_prefixes_are_not_compared_again(monkeypatch):
    calls = []
    plain = repeats._common_from
    monkeypatch.setattr(repeats, "_common_from", lambda a, b, known: calls.append((plain(a, b, known) - known)) or plain(a, b, known))
    deep = b"z" * 80
    runs = [([(deep + bytes([c]), b"", 0, 0) for c in range(k, 250, 5)], [0] + [80] * len(range(k + 5, 250, 5))) for k in range(5)]
    merged, _ = repeats.merge(runs)
    assert [e[0][-1] for e in merged] == list(range(250))
    assert sum(calls) <= 80 * 8


def test_same_ids_null_ids_and_odd_rows(spark, odd, empty):
    rng = random.Random(5)
    text, other = words(rng, 60), words(rng, 60)
    rows = [(1, text), (1, text), (2, text), (None, other), (3, other + "!"), (4, other)]
    got = found_ids(spark, rows)
    assert got[1] == [0, 0] and got[2] == [len(text.encode())]
    assert got[None] == [0] and got[4] == [len(other.encode())] and got[3] == [len(other.encode())]
    assert got.keys() == {1, 2, 3, 4, None}
    assert repeats.report(odd).count() == odd.count()
    assert repeats.report(empty).count() == 0


def found_ids(spark, rows):
    out = {}
    for r in repeats.report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        out.setdefault(r["doc_id"], []).append(r["n_removed"])
    return out


def test_bounds_follow_the_suffixes_of_texts_of_any_length(spark):
    rng = random.Random(13)
    long = "".join(chr(rng.randrange(97, 123)) for _ in range(200_000))
    copies = [(k + 1, long[:300]) for k in range(500)]
    for rows in ([(0, long)], [(0, long), *copies]):
        docs = spark.createDataFrame([(k, t) for k, t in rows], "rid long, text string")
        bounds = repeats._splitters(docs, 20, sum(len(t) for _, t in rows))
        assert len(bounds) == 19
        # Random letters: each range of the order holds about a twentieth of the suffixes.
        suffixes = sorted(long[k : k + 30].encode() for k in range(len(long) - 100))
        places = [0, *[bisect.bisect_left(suffixes, b[:30]) for b in bounds], len(suffixes)]
        assert max(b - a for a, b in zip(places, places[1:])) < len(suffixes) / 5
