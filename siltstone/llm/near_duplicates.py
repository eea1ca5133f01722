"""Near-duplicate documents by a MinHash LSH forest, links confirmed on whole shingle sets.

Documents with equal shingle sets form one class. A class gets ``TREES * DEPTH`` minimum hashes; each
tree orders the classes by its own run of ``DEPTH`` of them. Classes that share the first
``LEAST_DEPTH`` form a region of the order. In a small region all pairs are looked at; a larger one is
deepened, value by value, until its parts are small, and neighbours in the order are looked at
besides. A pair is a candidate if a 128-bit sketch (one bit of every minimum) agrees as it does, but
for a chance below one in a million, at the threshold.

Candidates are confirmed on full sets, the likeliest few of each class first, then all from small
regions whose two sides these have not connected. Regions that were deepened (and those at the edge
of a task) and hold several components are then compared whole, block by block, on full sets, so
deepening loses nothing that the first ``LEAST_DEPTH`` values found; a block returns no more links than
connect its components. What remains is the forest's own chance: a pair at the threshold is missed
by all trees once in 6,000 times (``(1 - 0.75 ** 3) ** 16``).

Null text counts as empty; a text without words has no shingles and is linked with nothing. Rows with
the same id and text are one document; a component's id is its smallest non-null id. Extra columns
pass through ``keep_one``, an empty table gives no rows, very long texts are hashed block by block.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.components import compact, components
from siltstone.llm.texts import bound_batches, mixed, word_hashes
from siltstone.runtime import checkpointed, fits_broadcast, has_rows

# Words to a shingle, and the least similarity as a percentage.
SHINGLE = 5
PERCENT = 75

TREES, DEPTH, LEAST_DEPTH = 16, 8, 3
AGREEMENT = 92
REGION = 16
NEIGHBOURS = 2
FIRST = 4
BLOCK = 512
_COLUMNS = 4096
_STREAM = 1 << 16
_ROOT = 9

_RNG = np.random.default_rng(20240607)
_FACTORS = _RNG.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
_PLACES = mixed(np.arange(1, SHINGLE + 2, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Per text, the sorted hashes of its distinct shingles."""
    rows, hashes = word_hashes(texts)
    ends = np.searchsorted(rows, np.arange(len(texts) + 1))
    out = []
    for start, end in zip(ends[:-1], ends[1:], strict=True):
        h = hashes[start:end]
        if len(h) >= SHINGLE:
            n = len(h) - SHINGLE + 1
            s = mixed(sum(h[k : k + n] * _PLACES[k] for k in range(SHINGLE)))
        elif len(h):
            s = mixed(np.sum(h * _PLACES[: len(h)], keepdims=True) + _PLACES[SHINGLE:] * np.uint64(len(h)))
        else:
            s = h
        s = np.sort(s)
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum hashes of sets that are not empty, a row each."""
    out = np.zeros((len(sets), TREES * DEPTH), dtype=np.uint32)
    sizes = np.array([len(s) for s in sets])
    full = np.flatnonzero(sizes)
    groups = np.split(full, np.flatnonzero(np.diff(np.cumsum(sizes[full]) // (1 << 17))) + 1)
    for group in groups:
        if not len(group):
            continue
        joined = np.concatenate([sets[k] for k in group])
        starts = np.cumsum(sizes[group]) - sizes[group]
        for j in range(TREES * DEPTH):
            values = (joined * _FACTORS[j] + _SHIFTS[j]) >> np.uint64(32)
            out[group, j] = np.minimum.reduceat(values, starts).astype(np.uint32)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            sets = shingle_sets(part["text"])
            minima = signatures(sets)
            spread = [mixed(s * _PLACES[0]) for s in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part["doc_id"],
                    "text_hash": part["text_hash"],
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "k1": pa.array(np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)),
                    "k2": pa.array(np.array([s.sum(dtype=np.uint64) for s in spread], dtype=np.uint64).view(np.int64)),
                    "minima": pa.array([m.tobytes() for m in minima], pa.binary()),
                }
            )


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and tree: its place in the tree's order, and the sketch."""
    for batch in batches:
        n = batch.num_rows
        minima = np.frombuffer(b"".join(batch["minima"].to_pylist()), dtype=np.uint32).reshape(n, TREES, DEPTH)
        sketch = np.packbits((minima.reshape(n, -1) & 1).astype(np.uint8), axis=1)
        root = np.zeros((n, TREES), dtype=np.uint64)
        for d in range(LEAST_DEPTH):
            root = mixed(root * np.uint64(31) + minima[:, :, d] + np.uint64(1))
        place = np.empty((n, TREES, _ROOT + 2 * (DEPTH - LEAST_DEPTH)), dtype=np.uint8)
        place[:, :, 0] = np.arange(TREES)
        place[:, :, 1:_ROOT] = root.astype(">u8").view(np.uint8).reshape(n, TREES, 8)
        deeper = np.ascontiguousarray(minima[:, :, LEAST_DEPTH:] & 0xFFFF).astype(">u2")
        place[:, :, _ROOT:] = deeper.view(np.uint8).reshape(n, TREES, -1)
        cid = batch["cid"].to_numpy()
        yield pa.RecordBatch.from_pydict(
            {
                "place": pa.array([p.tobytes() for p in place.reshape(n * TREES, -1)], pa.binary()),
                "cid": pa.array(np.repeat(cid, TREES)),
                "sketch": pa.array([s.tobytes() for s in np.repeat(sketch, TREES, axis=0)], pa.binary()),
            }
        )


def _all_pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def region_pairs(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows to look at in one region; ``place`` holds its sorted deeper values."""
    n = len(place)
    if n <= REGION:
        return _all_pairs(n)
    left = [np.arange(n - k) for k in range(1, NEIGHBOURS + 1)]
    right = [x + k for k, x in enumerate(left, 1)]
    bounds = [(0, n, 0)]
    while bounds:
        start, end, depth = bounds.pop()
        if end - start <= REGION:
            i, j = _all_pairs(end - start)
            left.append(i + start)
            right.append(j + start)
        elif depth < place.shape[1]:
            cuts = np.flatnonzero(place[start + 1 : end, depth] != place[start : end - 1, depth]) + start + 1
            bounds += zip([start, *cuts], [*cuts, end], [depth + 1] * (len(cuts) + 1), strict=True)
    both = np.unique(np.concatenate(left) * np.int64(n) + np.concatenate(right))
    return both // n, both % n


_PAIRS = "a long, b long, agree int, small boolean, region binary, sketch binary"


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of one stretch of the order; and, with their region, the rows of regions
    that were deepened or may go on in another task.
    """

    def rows(a, b, agree, small, region, sketch):
        return pa.RecordBatch.from_pydict(
            {
                "a": pa.array(a, pa.int64()),
                "b": pa.array(b, pa.int64()),
                "agree": pa.array(agree, pa.int32()),
                "small": pa.array(small, pa.bool_()),
                "region": pa.array(region, pa.binary()),
                "sketch": pa.array(sketch, pa.binary()),
            }
        )

    def settle(place: np.ndarray, cid: np.ndarray, bits: np.ndarray, first: bool, last: bool):
        starts = np.flatnonzero(np.concatenate([[True], (place[1:, :_ROOT] != place[:-1, :_ROOT]).any(axis=1)]))
        ends = np.append(starts[1:], len(place))
        deeper = place[:, _ROOT:].copy().view(">u2")
        edge = np.zeros(len(starts), dtype=bool)
        edge[0] |= first
        edge[-1] |= last
        a, b, small = [], [], []
        for k in np.flatnonzero(ends - starts > 1):
            i, j = region_pairs(deeper[starts[k] : ends[k]])
            a.append(i + starts[k])
            b.append(j + starts[k])
            small.append(np.full(len(i), ends[k] - starts[k] <= REGION))
        if a:
            a, b, small = np.concatenate(a), np.concatenate(b), np.concatenate(small)
            agree = 128 - np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            fit = (agree >= AGREEMENT) & (cid[a] != cid[b])
            a, b, agree, small = cid[a[fit]], cid[b[fit]], agree[fit], small[fit]
            none = pa.nulls(len(a), pa.binary())
            yield rows(np.minimum(a, b), np.maximum(a, b), agree, small, none, none)
        again = np.flatnonzero(np.repeat((ends - starts > REGION) | edge, ends - starts))
        if len(again):
            n = len(again)
            region = [place[k, :_ROOT].tobytes() for k in again]
            sketch = [bits[k].tobytes() for k in again]
            b, agree, small = (pa.nulls(n, kind) for kind in (pa.int64(), pa.int32(), pa.bool_()))
            yield rows(cid[again], b, agree, small, region, sketch)

    held, first = None, True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        now = (
            np.frombuffer(b"".join(batch["place"].to_pylist()), dtype=np.uint8).reshape(n, -1),
            batch["cid"].to_numpy(),
            np.frombuffer(b"".join(batch["sketch"].to_pylist()), dtype=np.uint64).reshape(n, 2),
        )
        held = now if held is None else tuple(np.concatenate(x) for x in zip(held, now, strict=True))
        place = held[0]
        whole = np.flatnonzero((place[1:, :_ROOT] != place[:-1, :_ROOT]).any(axis=1)) + 1
        cut = int(whole[-1]) if len(whole) else 0
        long = len(place) - cut > _STREAM
        if long:
            cut = len(place)
        if cut:
            yield from settle(*(x[:cut] for x in held), first, long)
            held, first = tuple(x[cut:] for x in held), long
            if not len(held[0]):
                held = None
    if held is not None:
        yield from settle(*held, first, True)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    sets: OrderedDict[int, np.ndarray] = OrderedDict()

    def set_of(key: int, body: bytes) -> np.ndarray:
        if key not in sets:
            sets[key] = shingle_sets(pa.array([unpack(body).decode()], pa.large_string()))[0]
            if len(sets) > 64:
                sets.popitem(last=False)
        return sets[key]

    for batch in batches:
        linked = []
        columns = [batch[c].to_pylist() for c in ("a", "b", "body_a", "body_b")]
        for a, b, body_a, body_b in zip(*columns, strict=True):
            x, y = set_of(a, body_a), set_of(b, body_b)
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_pydict({"a": batch["a"], "b": batch["b"], "linked": pa.array(linked, pa.bool_())})


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        bodies = [pack((t.as_py() or "").encode()) for t in batch["text"]]
        yield pa.RecordBatch.from_pydict({"cid": batch["cid"], "body": pa.array(bodies, pa.binary())})


def _set_down(df: DataFrame) -> DataFrame:
    """A small table on shared storage, in as few partitions as its rows fill."""
    kept = checkpointed(df)
    return compact(kept, kept.count())


class _Links:
    """Confirmed components of the classes, grown round by round."""

    def __init__(self, bodies: DataFrame):
        self.bodies = bodies
        self.links: DataFrame | None = None
        self.refuted: DataFrame | None = None
        self.of: DataFrame | None = None

    def open(self, pairs: DataFrame) -> DataFrame:
        """Pairs between different components that have not been refuted."""
        if self.of is not None:
            for side in ("a", "b"):
                part = self.of.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
                pairs = pairs.join(part, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
            pairs = pairs.filter("ca != cb").drop("ca", "cb")
        if self.refuted is not None:
            pairs = pairs.join(self.refuted, ["a", "b"], "left_anti")
        return pairs

    def confirm(self, pairs: DataFrame) -> None:
        pairs = _set_down(pairs)
        sides = {s: self.bodies.select(F.col("cid").alias(s), F.col("body").alias(f"body_{s}")) for s in ("a", "b")}
        joined = pairs.select("a", "b").join(sides["a"], "a").join(sides["b"], "b").select("a", "b", "body_a", "body_b")
        judged = checkpointed(joined.mapInArrow(_confirm, "a long, b long, linked boolean"))
        refuted, found = judged.filter("not linked").select("a", "b"), judged.filter("linked").select("a", "b")
        self.refuted = refuted if self.refuted is None else self.refuted.union(refuted)
        self.join(found)

    def join(self, found: DataFrame) -> None:
        """Merges the components of confirmed links (a, b)."""
        if has_rows(found):
            if self.of is not None:
                # Components so far stand as links from each node to its root.
                found = found.union(self.of.select("node", "component"))
            self.of = _set_down(components(found))


def _settle_pairs(links: _Links, pairs: DataFrame) -> None:
    """Confirms candidates: first the likeliest few of each class, then all that small regions
    leave open; larger ones are compared whole later.
    """
    ends = pairs.select("a", "b", "agree", F.explode(F.array("a", "b")).alias("end"))
    best = Window.partitionBy("end").orderBy(F.desc("agree"), "a", "b")
    chosen = ends.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= FIRST)
    links.confirm(chosen.select("a", "b").distinct())
    links.confirm(links.open(pairs.filter("small")))


def across(sets: list[np.ndarray], component: np.ndarray, own: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the components of these sets, each from an own row to any other."""
    sizes = np.array([len(s) for s in sets], dtype=np.float32)
    rows = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    _, words, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[words] > 1
    place = np.cumsum(counts > 1) - 1
    rows, words = rows[shared], place[words[shared]]
    mine = np.flatnonzero(own)
    both = np.zeros((len(mine), len(sets)), dtype=np.float32)
    order = np.argsort(words, kind="stable")
    rows, words = rows[order], words[order]
    for start in range(0, int(words[-1]) + 1 if len(words) else 0, _COLUMNS):
        low, high = np.searchsorted(words, [start, start + _COLUMNS])
        grid = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        grid[rows[low:high], words[low:high] - start] = 1
        both += grid[mine] @ grid.T
    linked = 100 * both >= PERCENT * (sizes[mine][:, None] + sizes[None, :] - both)
    linked &= component[mine][:, None] != component[None, :]
    root = {c: c for c in component.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        x, y = find(int(component[mine[i]])), find(int(component[j]))
        if x != y:
            root[x] = y
            out.append((int(mine[i]), int(j)))
    return out


def _compare_blocks(table: pa.Table) -> pa.Table:
    """Links between different components of one block and another, on full sets."""
    cid, component = table["cid"].to_numpy(), table["component"].to_numpy()
    own = table["own"].to_numpy(zero_copy_only=False).astype(bool)
    bits = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype=np.uint64).reshape(-1, 2)
    promising = np.zeros(len(cid), dtype=bool)
    for k in np.flatnonzero(own):
        agree = 128 - np.bitwise_count(bits ^ bits[k]).sum(axis=1, dtype=np.int64)
        fit = (agree >= AGREEMENT) & (component != component[k])
        if fit.any():
            promising |= fit
            promising[k] = True
    found = []
    keep = np.flatnonzero(promising)
    if len(keep):
        unpack = zstandard.ZstdDecompressor().decompress
        bodies = table["body"].take(pa.array(keep)).to_pylist()
        sets = shingle_sets(pa.array([unpack(b).decode() for b in bodies], pa.large_string()))
        found = [(int(cid[keep[i]]), int(cid[keep[j]])) for i, j in across(sets, component[keep], own[keep])]
    return pa.table(
        {
            "a": pa.array([min(x) for x in found], pa.int64()),
            "b": pa.array([max(x) for x in found], pa.int64()),
        }
    )


def _settle_regions(links: _Links, rows: DataFrame) -> None:
    """Compares regions that hold several components, all pairs of their blocks."""
    placed = rows.withColumn("component", F.col("cid"))
    if links.of is not None:
        placed = rows.join(links.of.withColumnRenamed("node", "cid"), "cid", "left")
        placed = placed.withColumn("component", F.coalesce("component", "cid"))
    several = placed.groupBy("region").agg(
        F.count("*").alias("n"), (F.min("component") != F.max("component")).alias("several")
    ).filter("several").select("region", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = placed.join(several, "region").withColumn("block", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    # Blocks meet in both orders of their numbers once: the lower one is the own one.
    met = dealt.join(links.bodies, "cid").withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "region",
        F.least("block", "mate").alias("low"),
        F.greatest("block", "mate").alias("high"),
        (F.col("block") <= F.col("mate")).alias("own"),
        "cid",
        "component",
        "sketch",
        "body",
    )
    links.join(checkpointed(met.groupBy("region", "low", "high").applyInArrow(_compare_blocks, "a long, b long")))


def _classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, text_hash, n_shingles, k1, k2), and classes with a component each."""
    keyed = bound_batches(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    signed = checkpointed(
        keyed.mapInArrow(
            _sign, "doc_id long, text_hash long, n_shingles long, k1 long, k2 long, minima binary"
        )
    )
    full = signed.filter("n_shingles > 0")
    sets = full.groupBy("k1", "k2", "n_shingles").agg(
        F.min("doc_id").alias("least_id"),
        F.min_by(F.struct("doc_id", "text_hash"), F.struct("doc_id", "text_hash")).alias("one"),
        F.first("minima").alias("minima"),
    )
    classes = checkpointed(sets.withColumn("cid", F.monotonically_increasing_id()))
    order = (
        classes.select("cid", "minima")
        .mapInArrow(_forest, "place binary, cid long, sketch binary")
        .repartitionByRange("place", "cid")
        .sortWithinPartitions("place", "cid")
    )
    looked = checkpointed(order.mapInArrow(_look, _PAIRS))
    found = looked.filter("region is null")
    pairs = _set_down(found.groupBy("a", "b").agg(F.max("agree").alias("agree"), F.max("small").alias("small")))
    regions = looked.filter("region is not null").select("region", F.col("a").alias("cid"), "sketch").distinct()
    seen = looked.select(F.explode(F.array("a", F.coalesce("b", "a"))).alias("cid")).distinct()
    texts_of = classes.select("cid", F.col("one.doc_id").alias("one_id"), F.col("one.text_hash").alias("one_hash"))
    wanted = checkpointed(seen.join(texts_of, "cid"))
    same = F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_hash") == F.col("one_hash"))
    texts = keyed.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, same).select("cid", "text")
    bodies = checkpointed(texts.mapInArrow(_packed, "cid long, body binary").dropDuplicates(["cid"]))
    links = _Links(bodies)
    _settle_pairs(links, pairs)
    _settle_regions(links, regions)
    ids = classes.select("cid", "k1", "k2", "n_shingles", "least_id")
    if links.of is not None:
        ids = ids.join(links.of.withColumnRenamed("node", "cid"), "cid", "left")
        ids = ids.withColumn("component", F.coalesce("component", "cid"))
    else:
        ids = ids.withColumn("component", F.col("cid"))
    least = ids.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return signed.drop("minima"), ids.join(least, "component")


def group(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, component) per row of ``docs``."""
    signed, classes = _classed(docs)
    members = signed.join(
        classes.select("k1", "k2", "n_shingles", "component", "component_id"), ["k1", "k2", "n_shingles"], "left"
    )
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return members.select("doc_id", "text_hash", "n_shingles", own.alias("component_id"), "component")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document."""
    return group(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each component the one with the smallest id."""
    grouped = group(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).filter("n_shingles > 0")
    keys = checkpointed(grouped.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("copies")))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = keys.groupBy("component").agg(F.min_by(F.struct("doc_id", "text_hash"), order).alias("one"))
    chosen = keys.join(first, "component").withColumn(
        "chosen", F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("text_hash") == F.col("one.text_hash"))
    )
    listed = chosen.filter("not chosen or copies > 1").withColumnsRenamed({"doc_id": "l_id", "text_hash": "l_hash"})
    listed = checkpointed(listed.select("l_id", "l_hash", "chosen"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").cast("long").alias("key_id"),
        F.xxhash64("text").alias("key_hash"),
    )
    same = F.col("key_id").eqNullSafe(F.col("l_id")) & (F.col("key_hash") == F.col("l_hash"))

    def held(keys: DataFrame, how: str) -> DataFrame:
        return rows.join(F.broadcast(keys) if fits_broadcast(keys) else keys, same, how)

    # Only documents that go, or stand there several times, are listed; all others just pass.
    kept = held(listed.drop("chosen"), "left_anti").select("doc.*")
    several = listed.filter("chosen").drop("chosen")
    if has_rows(several):
        once = held(several, "left_semi").dropDuplicates(["key_id", "key_hash"])
        kept = kept.union(once.select("doc.*"))
    return kept
