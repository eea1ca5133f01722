import math

import numpy as np
from pyspark.sql import functions as F

from siltstone.llm import neighbours

TWENTIETH = lambda c: c % 20 == 0


def brute(rows, k=20):
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], dtype=float)
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            scores = neighbours._exact(np.repeat([v], len(m), axis=0).astype(float), m)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want = brute(rows)
    neighbours.PART_ROWS, before = 256, neighbours.PART_ROWS
    try:
        got = found(neighbours.search(table, TWENTIETH))
    finally:
        neighbours.PART_ROWS = before
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.95
    by_id = dict(rows)
    for q, near in got.items():
        for i, score in near:
            assert math.isclose(score, math.fsum(a * b for a, b in zip(by_id[q], by_id[i], strict=True)), abs_tol=1e-9)


def test_few_rows_ties_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (40, [1.0, 1.0]), (3, [1.0, 1.0]), (2, [1.0, 1.0]), (5, [-1.0, 2.0])]
    odd = [(60, None), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [None, 1.0]), (140, [inf, 1.0]), (160, []), (180, [1.0]), (None, [1.0, 1.0]), (20, [0.0, 1.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").selectExpr("*", "1 as part", "2 as query", "3 as score")
    assert found(neighbours.search(frame, TWENTIETH)) == brute(rows)
    assert neighbours.search(frame.limit(0), TWENTIETH).count() == 0
    one = neighbours.search(frame.filter("vec_id = 0"), TWENTIETH)
    assert one.count() == 0 and one.columns == ["query_id", "rank", "vec_id", "score"]


def test_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else rng.standard_normal(3).tolist()) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(neighbours.search(frame, TWENTIETH)) == brute(rows)


def test_parts_are_balanced_and_cut_few_links():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal((100, 8)) * 0.1 + c for c in rng.standard_normal((4, 8)) * 5])
    links = neighbours.nearest_links(x, x, 6, True)
    part = neighbours.balanced_parts(x, links, 4)
    assert np.bincount(part).tolist() == [100] * 4


def test_clustered_vectors_need_few_parts():
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((64, 16)) * 3
    sample = centres[rng.integers(0, 64, 6000)] + rng.standard_normal((6000, 16)) * 0.1
    router, parts, probed = neighbours.learn(sample, 10**6, 20)
    assert parts >= 16 and probed <= parts // 4
    sizes = np.bincount(router.chances(sample).argmax(axis=1), minlength=parts)
    assert sizes.max() < 4 * len(sample) / parts
