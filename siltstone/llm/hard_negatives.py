"""Hard negatives for contrastive training: rows of another label that are near, but not too near.

Vectors are scaled and floored to integers; scores are inner products, exact. An anchor's positives are
its best rows of its own label. For each positive, the negatives are the best rows of other labels whose
scores are between ``low`` and ``high`` hundredths of the positive's.

Rows are dealt into blocks of bounded size, and each block gets a cover tree. Its points carry one more
coordinate, which brings all to the same norm, so that the distance of two points falls as their inner
product grows. A node covers its points within a radius; a level down, centres are chosen farthest
first until all is covered within that radius divided by ``BASE``. From an anchor's distance to a centre
and the radius follow the least and the largest inner product below the node. The search goes best bound
first, skips nodes outside all of the anchor's windows or below what each window has found, and scores
the rows of leaves exactly.

A task holds one block and one chunk of anchors, so neither a label with a third of all rows nor a large
number of anchors comes to one place. Equal vectors of one label in a block are one point, of which only
the ids that can be among the first are kept.

Rows with a null id, label or vector, or with null or non-finite components take no part, nor do vectors
whose length is not the table's most common one (of equally common ones the longest). Of rows with the
same id the one with the smallest label, then vector counts. Equal scores go by smaller id. An anchor
without positives, or without rows in a window, has no rows. Extra columns are not read; an empty table
gives no rows. Products beyond 62 bits raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.joins import attach
from siltstone.runtime import checkpointed, has_rows

SCALE = 256
BLOCK_ROWS = 4096
CHUNK_ROWS = 2048
LEAF_POINTS = 32
BASE = 1.3
VERIFIED_AT_ONCE = 256
EXACT_FLOAT = 1 << 53
EXACT_LONG = 1 << 62


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, components scaled and floored."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        v.cast("array<double>").alias("embedding"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & ~bad)
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    rows = rows.filter(F.size("embedding") == (common["d"] if common else 0))
    rows = rows.select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * scale)).alias("vector"))
    if has_rows(rows.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1")):
        first = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
        rows = first.select("vec_id", "row.label", "row.vector")
    return checkpointed(rows)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges [start, end), one after the other."""
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class CoverTree:
    """A cover tree over the rows of one block; nodes and points are arrays in order of levels."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, keep: int):
        order = np.argsort(ids, kind="stable")
        ids, labels, x = ids[order], labels[order], x[order]
        rows = np.ascontiguousarray(np.column_stack([x, labels]))
        rows = rows.view([("", rows.dtype)] * rows.shape[1]).ravel()
        _, first, which = np.unique(rows, return_index=True, return_inverse=True)
        by_point = np.argsort(which, kind="stable")
        counts = np.bincount(which)
        starts = np.cumsum(counts) - counts
        x, labels = x[first], labels[first]

        self.largest = float((x.astype(np.float64) ** 2).sum(axis=1).max())
        norms = (x.astype(np.float64) ** 2).sum(axis=1)
        lifted = np.column_stack([x.astype(np.float64), np.sqrt(np.maximum(self.largest - norms, 0))])
        self.centre, self.radius = [0], []
        child, leaf = [], []
        members, placed, n_placed = [np.arange(len(x))], [], 0
        k = 0
        while k < len(members):
            own = members[k]
            away = self._distances(lifted, own, self.centre[k])
            radius = float(away.max())
            self.radius.append(radius)
            if len(own) <= LEAF_POINTS or radius == 0:
                child.append((0, 0))
                leaf.append((n_placed, n_placed + len(own)))
                placed.append(own)
                n_placed += len(own)
            else:
                nearest, chosen = np.zeros(len(own), dtype=np.int64), [self.centre[k]]
                while True:
                    far = int(away.argmax())
                    if away[far] <= radius / BASE:
                        break
                    to_new = self._distances(lifted, own, own[far])
                    closer = to_new < away
                    away[closer], nearest[closer] = to_new[closer], len(chosen)
                    chosen.append(own[far])
                    away[far], nearest[far] = 0.0, len(chosen) - 1
                groups = np.argsort(nearest, kind="stable")
                bounds = np.searchsorted(nearest[groups], np.arange(len(chosen) + 1))
                child.append((len(members), len(members) + len(chosen)))
                leaf.append((0, 0))
                for c, (start, end) in zip(chosen, zip(bounds, bounds[1:], strict=False), strict=True):
                    members.append(own[groups[start:end]])
                    self.centre.append(c)
            members[k] = None
            k += 1
        self.child_start, self.child_end = np.array(child).T
        self.leaf_start, self.leaf_end = np.array(leaf).T
        self.scored = 0
        place = np.concatenate(placed)
        self.points, self.labels = x[place], labels[place]
        self.centres = x[np.array(self.centre)]
        self.radius = np.array(self.radius)
        kept = np.minimum(counts, keep)
        self.ids = [ids[by_point[starts[p] : starts[p] + kept[p]]] for p in place]

    @staticmethod
    def _distances(lifted: np.ndarray, rows: np.ndarray, to: int) -> np.ndarray:
        return np.sqrt(((lifted[rows] - lifted[to]) ** 2).sum(axis=1))

    def exact(self, q: np.ndarray) -> CoverTree:
        """The tree with points as numbers in which products with ``q`` are exact."""
        bound = float(np.sqrt(self.largest)) * float(np.sqrt((q.astype(np.float64) ** 2).sum(axis=1).max()))
        if bound >= EXACT_LONG:
            raise ArithmeticError("inner products pass 62 bits")
        kind = np.float64 if bound < EXACT_FLOAT else np.int64
        self.points, self.centres = self.points.astype(kind), self.centres.astype(kind)
        return self

    def bounds(self, q: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest inner product of ``q`` with any point below each node."""
        norm = float((q.astype(np.float64) ** 2).sum()) + self.largest
        away = np.sqrt(np.maximum(norm - 2 * (self.centres[nodes] @ q).astype(np.float64), 0))
        slack = 1e-9 * norm + 1e-3
        least = (norm - (away + self.radius[nodes]) ** 2) / 2 - slack
        most = (norm - np.maximum(away - self.radius[nodes], 0) ** 2) / 2 + slack
        return least, most

    def search(self, q: np.ndarray, windows: list[tuple[float, float]], k: int, allowed) -> list[list[tuple[int, int]]]:
        """Per window the k best (score, id) among points that ``allowed(labels)`` lets in."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        needed = np.array([low for low, _ in windows], dtype=np.float64)
        high = np.array([high for _, high in windows], dtype=np.float64)
        nodes = np.zeros(1, dtype=np.int64)
        waiting, at = self.bounds(q, nodes)[1], 0
        while at < len(nodes) and waiting[at] >= needed.min():
            run = nodes[at : at + VERIFIED_AT_ONCE]
            inner = self.child_end[run] > 0
            alike = int((inner != inner[0]).argmax()) or len(run)
            run = run[:alike]
            if inner[0]:
                # The best nodes in a row that have children are opened together.
                at += alike
                below = _ranges(self.child_start[run], self.child_end[run])
                least, most = self.bounds(q, below)
                inside = ((most[:, None] >= needed) & (least[:, None] <= high)).any(axis=1)
                waiting = np.concatenate([waiting[at:], most[inside]])
                nodes = np.concatenate([nodes[at:], below[inside]])
                order = np.argsort(-waiting, kind="stable")
                waiting, nodes, at = waiting[order], nodes[order], 0
                continue
            sizes = np.cumsum(self.leaf_end[run] - self.leaf_start[run])
            run = run[: int(np.searchsorted(sizes, VERIFIED_AT_ONCE)) + 1]
            at += len(run)
            points = _ranges(self.leaf_start[run], self.leaf_end[run])
            self.scored += len(points)
            scores = self.points[points] @ q
            usable = allowed(self.labels[points]) & (scores >= needed.min()) & (scores <= high.max())
            points, scores = points[usable], scores[usable]
            for w, (low, _) in enumerate(windows):
                mine = (scores >= needed[w]) & (scores <= high[w])
                if not mine.any():
                    continue
                pairs = found[w]
                for p, score in zip(points[mine], scores[mine], strict=True):
                    value = int(score)
                    pairs.extend((-value, int(i)) for i in self.ids[p])
                pairs.sort()
                del pairs[k:]
                needed[w] = max(low, -pairs[-1][0]) if len(pairs) == k else low
        return found


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


FOUND = "query_id long, near long, vec_id long, score long"


def _search(candidates: DataFrame, queries: DataFrame, k: int, same_label: bool, low: int, high: int) -> DataFrame:
    """(query_id, near, vec_id, score): the best of each block for each anchor and window.

    A query has ``own_label``, ``query`` and ``near``; its windows are ``low`` to ``high`` hundredths of
    the scores in ``near``; null stands for one window without bounds. With ``same_label`` it meets the
    rows of its label, otherwise all rows, of which those of other labels count.
    """
    blocks = F.ceil(F.col("rows") / BLOCK_ROWS).cast("long").alias("blocks")
    chunks = F.ceil(F.col("asking") / CHUNK_ROWS).cast("long").alias("chunks")
    if same_label:
        per = candidates.groupBy(F.col("label").alias("bucket")).agg(F.count("*").alias("rows"))
        asking = queries.groupBy(F.col("own_label").alias("bucket")).agg(F.count("*").alias("asking"))
        sizes = checkpointed(per.join(asking, "bucket").select("bucket", "rows", "asking", blocks, chunks))
        left = candidates.withColumn("bucket", F.col("label"))
        left = attach(left, sizes.drop("asking"), ["bucket"], "rows").filter("chunks IS NOT NULL")
        right = queries.withColumn("bucket", F.col("own_label"))
        right = attach(right, sizes.drop("rows"), ["bucket"], "asking").filter("blocks IS NOT NULL")
    else:
        counted = {"bucket": F.lit(0), "rows": F.lit(candidates.count()), "asking": F.lit(queries.count())}
        left, right = (
            df.withColumns(counted).select(*df.columns, "bucket", blocks, chunks) for df in (candidates, queries)
        )

    def dealt(ids: str, n: str) -> Column:
        return F.pmod(F.xxhash64(ids), F.greatest(F.col(n), F.lit(1)))

    def each(n: str) -> Column:
        return F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col(n)), lambda i: i < F.col(n)))

    keys = ["bucket", "block", "chunk"]
    left = left.withColumn("block", dealt("vec_id", "blocks")).withColumn("chunk", each("chunks"))
    right = right.withColumn("chunk", dealt("query_id", "chunks")).withColumn("block", each("blocks"))

    def searched(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int | None, int, int]] = []
        if rows.num_rows and asked.num_rows:
            vectors = _matrix(asked["query"])
            tree = CoverTree(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["vector"]), k + 1)
            tree.exact(vectors)
            vectors = vectors.astype(tree.points.dtype)
            for q, query_id, label, near in zip(
                vectors, asked["query_id"].to_pylist(), asked["own_label"].to_pylist(), asked["near"].to_pylist(), strict=True
            ):
                near = near or [None]
                # Whole numbers, so the bounds are rounded inwards.
                windows = [
                    (-np.inf, np.inf) if s is None else (-(-low * s // 100), high * s // 100) for s in near
                ]
                pick = (lambda x, own=label: x == own) if same_label else (lambda x, own=label: x != own)
                # The anchor itself may be among the best of its own label.
                for s, pairs in zip(near, tree.search(q, windows, k + same_label, pick), strict=True):
                    out.extend((query_id, s, i, -minus) for minus, i in pairs if i != query_id)
        columns = zip(*out, strict=True) if out else ([], [], [], [])
        names = [f.split()[0] for f in FOUND.split(", ")]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return (
        left.select(*keys, "vec_id", "label", "vector")
        .groupBy(*keys)
        .cogroup(right.select(*keys, "query_id", "own_label", "query", "near").groupBy(*keys))
        .applyInArrow(searched, FOUND)
    )


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = whole_vectors(vectors, scale)
    anchors = rows.filter(is_anchor(F.col("vec_id"))).select(
        F.col("vec_id").alias("query_id"), F.col("label").alias("own_label"), F.col("vector").alias("query")
    )
    no_window = F.lit(None).cast("array<long>")
    own = _search(rows, anchors.withColumn("near", no_window), positives, True, low, high)
    best = _first(own, ["query_id"], positives)
    near = checkpointed(best.select("query_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("near")))
    # At most ``positives`` numbers an anchor.
    windows = near.groupBy("query_id").agg(F.sort_array(F.collect_set("near")).alias("near"))
    others = _search(rows, checkpointed(anchors.join(windows, "query_id")), negatives, False, low, high)
    ranked = _first(others, ["query_id", "near"], negatives)
    return near.join(ranked, ["query_id", "near"]).select(
        F.col("query_id").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("near").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
