import numpy as np
import pytest

from siltstone.llm import hard_negatives as hard
from siltstone.llm import joins

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=10, positives=5, negatives=10):
    whole = [(i, label, [int(np.floor(256 * float(c))) for c in v]) for i, label, v in rows]
    out = []
    for a, label, v in whole:
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), i, other) for i, other, w in whole if i != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:positives]:
            near = [s for s in scored if s[2] != label and -30 * minus <= -100 * s[0] <= -90 * minus]
            out += [(a, p, r, i, -minus, -m) for r, (m, i, _) in enumerate(near[:negatives], 1)]
    return sorted(out)


def mined(frame, every=10):
    found = hard.mine(frame, lambda vec_id: vec_id % every == 0)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


def random_rows(n, d=6, labels=4, seed=3):
    rng = np.random.default_rng(seed)
    near = rng.standard_normal((labels, d))
    label = rng.integers(0, labels, n)
    return [(i, int(label[i]), (near[label[i]] + rng.standard_normal(d)).round(3).tolist()) for i in range(n)]


def frame(spark, rows, kind="float"):
    schema = f"vec_id long, label int, embedding array<{kind}>"
    return spark.createDataFrame(rows, schema).selectExpr("*", "1 as near", "2 as vector", "3 as rank", "4 as bucket")


@pytest.mark.parametrize("small", [False, True])
def test_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(hard, "BLOCK_ROWS", 50)
        monkeypatch.setattr(hard, "CHUNK_ROWS", 7)
        monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(joins, "HEAVY_ROWS", 100)
    rows = random_rows(500)
    assert mined(frame(spark, rows, "double")) == brute(rows) != []


def test_copies_ties_and_a_label_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(hard, "BLOCK_ROWS", 64)
    rows = random_rows(120, d=3)
    rows += [(i, 0, [1.0, 2.0, 0.5]) for i in range(120, 320)]
    rows += [(i, 1, [1.0, 1.0, 0.5]) for i in range(320, 400)]
    assert mined(frame(spark, rows, "double")) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (10, 1, [0.5, 0.5]), (20, 2, [0.0, 0.0]), (1, 2, [0.75, 0.1]), (2, 2, [0.75, 0.1]), (3, 1, [-1.0, 0.0]), (4, 3, [0.3, 0.3])]
    odd = [(30, None, [1.0, 0.0]), (None, 1, [1.0, 0.0]), (40, 1, None), (50, 1, [nan, 0.0]), (60, 2, [inf, 0.0]), (70, 1, [None, 1.0]), (80, 1, [1.0]), (90, 1, []), (4, 3, [0.3, 0.3]), (4, 5, [9.0, 9.0])]
    assert mined(frame(spark, rows + odd)) == brute(rows) != []
    assert mined(frame(spark, rows[:1])) == mined(frame(spark, rows[:2])) == mined(frame(spark, rows[:0])) == []


def test_scores_are_whole_beyond_double_precision(spark):
    rows = [(0, 1, [3e5, 7e5]), (1, 1, [123457.004, 654321.7]), (2, 2, [234567.001, 254321.3]), (3, 2, [34567.891, 454321.9])]
    found = mined(frame(spark, [(i, label, [c * 2 for c in v]) for i, label, v in rows], "double"))
    want = brute([(i, label, [c * 2 for c in v]) for i, label, v in rows])
    assert found == want != [] and want[0][4] > 1 << 53
    with pytest.raises(Exception, match="62 bits"):
        mined(frame(spark, [(i, label, [c * 1e6 for c in v]) for i, label, v in rows], "double"))


def clustered(n, clusters, rng):
    centres = rng.standard_normal((clusters, 16)) * 300
    return (centres[rng.integers(0, clusters, n)] + rng.standard_normal((n, 16)) * 8).astype(np.int64)


def test_every_point_is_within_its_nodes_bounds():
    rng = np.random.default_rng(5)
    x = clustered(2000, 20, rng)
    tree = hard.CoverTree(np.arange(2000), np.zeros(2000, np.int64), x, 11).exact(x)
    below = {}

    def points(node):
        if tree.child_end[node]:
            return [p for c in range(tree.child_start[node], tree.child_end[node]) for p in points(c)]
        return list(range(tree.leaf_start[node], tree.leaf_end[node]))

    for node in range(len(tree.radius)):
        below[node] = points(node)
    assert sorted(below[0]) == list(range(len(tree.points)))
    for q in tree.points[:20]:
        least, most = tree.bounds(q, np.arange(len(tree.radius)))
        scores = tree.points @ q
        assert all(least[n] <= scores[p].min() and scores[p].max() <= most[n] for n, p in below.items())


def test_nodes_outside_the_windows_are_skipped():
    rng = np.random.default_rng(6)
    x = clustered(4000, 40, rng)
    tree = hard.CoverTree(np.arange(4000), np.zeros(4000, np.int64), x, 11).exact(x)
    for q in tree.points[:50].copy():
        tree.scored = 0
        scores = sorted((tree.points @ q).astype(int), reverse=True)
        top = int(scores[0])
        for low, high in ((-np.inf, np.inf), (30 * top // 100, 90 * top // 100)):
            found = tree.search(q, [(low, high)], 10, lambda labels: labels == 0)[0]
            assert [-s for s, _ in found] == [s for s in scores if low <= s <= high][:10]
        assert tree.scored < len(x) / 2
