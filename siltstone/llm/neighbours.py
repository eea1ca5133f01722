"""Approximate nearest neighbours by inner product, over learned partitions.

On a bounded sample, each vector is linked with its nearest ones; the graph is cut into parts of
equal size by bisection along the widest direction, refined by swaps that reduce the links cut. A
small neural classifier learns in which parts a vector's neighbours lie. It gives every row of the
table its part, and routes each query to its most probable parts, as many as reach ``RECALL`` against
brute force among vectors of the sample that it was not fitted on. Vectors without any structure need
most parts for that, clustered ones a few. There are 2 to ``MAX_PARTS`` parts, one per ``PART_ROWS`` rows
(below some 290 rows a single one, searched whole); more rows make larger parts. Candidates are scored exactly, in double precision.

Rows of a part are dealt over blocks of bounded size, queries of a part over chunks, and a task gets
one block and one chunk, so a part with a third of all rows is many tasks. Equal vectors of a block
are scored once; of these only the ids that can be among the nearest are kept.

Null, zero and non-finite vectors, null ids, and vectors whose length is not the table's most common
one (of equally common ones the longest) take no part. Of rows with the same id the one with the
smallest vector counts; equal scores go to the smaller id. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.runtime import checkpointed

SAMPLE_ROWS = 12288
SAMPLE_FLOATS = 4 << 20
LINKS = 12
PART_ROWS = 2048
MAX_PARTS = 64
LEAST_SAMPLE_PER_PART = 96
RECALL = 0.95
HELD_BACK = 3
PROBE_QUERIES = 512
BLOCK_FLOATS = 1 << 20
QUERY_ROWS = 2048
HIDDEN = 64

SCHEMA = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding")
    ).filter(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    once = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    sizes = once.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return once.filter(F.size("embedding") == (common["d"] if common else 0))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest_links(x: np.ndarray, y: np.ndarray, k: int, skip_own: bool) -> np.ndarray:
    """For each row of x the k rows of y with the largest inner product."""
    out = np.empty((len(x), k), dtype=np.int64)
    for start in range(0, len(x), 512):
        scores = x[start : start + 512] @ y.T
        if skip_own:
            scores[np.arange(len(scores)), np.arange(start, start + len(scores))] = -np.inf
        out[start : start + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, links: np.ndarray, parts: int) -> np.ndarray:
    """A part per vector, sizes equal up to one, few links cut. ``parts`` is a power of two."""
    out = np.zeros(len(x), dtype=np.int64)
    source = np.repeat(np.arange(len(x)), links.shape[1])
    target = links.ravel()

    def cut(members: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            out[members] = first
            return
        centred = x[members] - x[members].mean(axis=0)
        _, axes = np.linalg.eigh(centred.T @ centred)
        side = np.zeros(len(members), dtype=bool)
        side[np.argsort(centred @ axes[:, -1], kind="stable")[len(members) // 2 :]] = True
        local = np.full(len(x), -1)
        local[members] = np.arange(len(members))
        inside = (local[source] >= 0) & (local[target] >= 0)
        a, b = local[source[inside]], local[target[inside]]
        for _ in range(8):
            # How many more links a vector has to the other side than to its own.
            unlike = np.where(side[a] != side[b], 1.0, -1.0)
            gain = np.bincount(a, unlike, len(members)) + np.bincount(b, unlike, len(members))
            left, right = np.flatnonzero(~side), np.flatnonzero(side)
            left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
            swaps = min(len(left), len(right))
            better = int((gain[left[:swaps]] + gain[right[:swaps]] > 2).sum()) // 2
            if not better:
                break
            side[left[:better]], side[right[:better]] = True, False
        cut(members[~side], first, count // 2)
        cut(members[side], first + count // 2, count // 2)

    cut(np.arange(len(x)), 0, parts)
    return out


class Router:
    """One hidden layer, softmax over parts, on unit vectors."""

    def __init__(self, x: np.ndarray, target: np.ndarray, epochs: int = 60):
        rng = np.random.default_rng(11)
        sizes = (x.shape[1], HIDDEN, target.shape[1])
        self.w = [rng.standard_normal((a, b)) * np.sqrt(2 / a) for a, b in zip(sizes, sizes[1:], strict=False)]
        self.b = [np.zeros(b) for b in sizes[1:]]
        x = _unit(x)
        state = [np.zeros_like(p) for p in (*self.w, *self.b)]
        speed = [np.zeros_like(p) for p in (*self.w, *self.b)]
        step = 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
                hidden = np.maximum(x[rows] @ self.w[0] + self.b[0], 0)
                out = self._softmax(hidden @ self.w[1] + self.b[1])
                error = (out - target[rows]) / len(rows)
                back = (error @ self.w[1].T) * (hidden > 0)
                gradients = (x[rows].T @ back, hidden.T @ error, back.sum(axis=0), error.sum(axis=0))
                step += 1
                for p, g, m, v in zip((*self.w, *self.b), gradients, state, speed, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def chances(self, x: np.ndarray) -> np.ndarray:
        return self._softmax(np.maximum(_unit(x) @ self.w[0] + self.b[0], 0) @ self.w[1] + self.b[1])


def learn(sample: np.ndarray, rows: int, k: int) -> tuple[Router | None, int, int]:
    """The router, the number of parts, and how many parts a query is routed to."""
    fresh = np.arange(len(sample)) % HELD_BACK == 0
    held, sample = sample[fresh], sample[~fresh]
    # Two parts at least, wherever the sample can teach them: small tables go the way of large ones.
    room = min(MAX_PARTS, max(2, rows // PART_ROWS), len(sample) // LEAST_SAMPLE_PER_PART)
    parts = 1 << max(0, room.bit_length() - 1) if room else 1
    if parts < 2:
        return None, 1, 1
    unit = _unit(sample)
    links = nearest_links(unit, unit, min(LINKS, len(sample) - 1), True)
    part = balanced_parts(unit, links, parts)
    target = np.zeros((len(sample), parts))
    near = nearest_links(sample, sample, min(k, len(sample) - 1), True)
    np.add.at(target, (np.arange(len(sample))[:, None], part[near]), 0.5 / near.shape[1])
    target[np.arange(len(sample)), part] += 0.5
    router = Router(sample, target)
    chances = router.chances(held)
    near = nearest_links(held, held, min(k, len(held) - 1), True)[:PROBE_QUERIES]
    order = np.argsort(-chances[:PROBE_QUERIES], axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    found = np.take_along_axis(place, chances.argmax(axis=1)[near], axis=1)
    for probed in range(1, parts + 1):
        if (found < probed).mean() >= RECALL:
            return router, parts, probed
    return router, parts, parts


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _exact(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed left to right, so that equal vectors get equal scores."""
    total = np.zeros(len(queries))
    for j in range(queries.shape[1]):
        total += queries[:, j] * vectors[:, j]
    return total


def best_in_block(query_ids, queries, ids, vectors, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of each query's k nearest in a block, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order]) + 0.0
    rows = vectors.view([("", vectors.dtype)] * vectors.shape[1]).ravel()
    _, first, which = np.unique(rows, return_index=True, return_inverse=True)
    by_vector = np.argsort(which, kind="stable")
    starts = np.searchsorted(which[by_vector], np.arange(len(first)))
    counts = np.minimum(np.bincount(which, minlength=len(first)), k + 1)
    distinct = vectors[first]
    out = []
    for at in range(0, len(queries), 256):
        q, q_ids = queries[at : at + 256], query_ids[at : at + 256]
        rough = q @ distinct.T
        wanted = min(k + 1, len(distinct))
        least = -np.partition(-rough, wanted - 1, axis=1)[:, wanted - 1]
        slack = 1e-9 * (np.abs(q) @ np.abs(distinct).max(axis=0) + 1e-300)
        row, col = np.nonzero(rough >= (least - slack)[:, None])
        score = _exact(q[row], distinct[col])
        n = counts[col]
        row, score, col = np.repeat(row, n), np.repeat(score, n), np.repeat(col, n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        found = ids[by_vector[starts[col] + nth]]
        other = found != q_ids[row]
        row, score, found = row[other], score[other], found[other]
        order = np.lexsort((found, -score, row))
        row, score, found = row[order], score[order], found[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        keep = rank < k
        out.append((q_ids[row[keep]], found[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest of each row for which ``is_query`` holds."""
    rows = checkpointed(usable(vectors))
    spark = rows.sparkSession
    n = rows.count()
    if not n:
        return spark.createDataFrame([], SCHEMA)
    d = rows.select(F.size("embedding")).first()[0]
    bound = max(1, min(SAMPLE_ROWS, SAMPLE_FLOATS // d))
    chance = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(chance < bound / n).orderBy(F.xxhash64("vec_id"), "vec_id").limit(bound).select("embedding")
    router, parts, probed = learn(_matrix(sample.toArrow()["embedding"]), n, k) if n > 1 else (None, 1, 1)

    def routed(count: int):
        def run(column: pa.Array) -> pa.Array:
            if router is None or not len(column):
                return pa.array([[0]] * len(column), pa.list_(pa.int32()))
            order = np.argsort(-router.chances(_matrix(column)), axis=1, kind="stable")[:, :count]
            return pa.array(list(order.astype(np.int32)), pa.list_(pa.int32()))

        return F.arrow_udf(run, "array<int>")

    placed = checkpointed(
        rows.withColumn("part", routed(1)("embedding")[0]).withColumn(
            "query", F.coalesce(is_query(F.col("vec_id")), F.lit(False))
        )
    )
    asked = placed.filter("query").select(
        F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("vector"),
        F.explode(routed(probed)("embedding")).alias("part"),
    )
    block_rows = max(64, BLOCK_FLOATS // d)

    def pieces(df: DataFrame, size: int) -> dict[int, int]:
        # At most one row per part: two numbers each.
        counts = df.groupBy("part").agg(F.count("*").alias("n")).collect()
        return {r["part"]: -(-r["n"] // size) for r in counts}

    blocks, chunks = pieces(placed, block_rows), pieces(asked, QUERY_ROWS)

    def of(counts: dict[int, int]):
        return F.element_at(F.array(*[F.lit(counts.get(p, 0)) for p in range(parts)]), F.col("part") + 1)

    def dealt(ids, count):
        return F.pmod(F.xxhash64(ids), F.greatest(count, F.lit(1))).cast("int")

    def each(count):
        return F.explode(F.filter(F.sequence(F.lit(0), count), lambda i: i < count))

    keys = ["part", "block", "chunk"]
    left = placed.withColumn("block", dealt("vec_id", of(blocks))).withColumn("chunk", each(of(chunks)))
    right = asked.withColumn("chunk", dealt("query_id", of(chunks))).withColumn("block", each(of(blocks)))

    def scored(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        names = ("query_id", "vec_id", "score")
        if not candidates.num_rows or not queries.num_rows:
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            found = best_in_block(
                queries["query_id"].to_numpy(),
                _matrix(queries["vector"]),
                candidates["vec_id"].to_numpy(),
                _matrix(candidates["embedding"]),
                k,
            )
        return pa.table(dict(zip(names, map(pa.array, found), strict=True)))

    near = (
        left.select(*keys, "vec_id", "embedding")
        .groupBy(*keys)
        .cogroup(right.select(*keys, "query_id", "vector").groupBy(*keys))
        .applyInArrow(scored, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
