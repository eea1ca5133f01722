"""Array documents over many tasks: one JSON array of records, however long its file is.

A file is read in pieces that end at ``}``, so Spark cuts it into byte ranges like any text. Where a piece
stands, inside a text or how deep, depends on everything before it. So each range is scanned twice:

1. For both states that a range may start in, inside a text or not, what it does to the state and to the
   depth: three numbers a range. A running sum over the ranges of a file gives each one its start.
2. With that known, records are cut out where a ``}`` closes one of the array's own elements. What a
   range has before its first such place and behind its last one is joined with its neighbours'.

Nothing holds a document or a range whole; a record must fit a string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.runtime import checkpointed, fits_broadcast

# The bytes that matter in JSON.
_QUOTE, _BACKSLASH = 0x22, 0x5C
_OPEN, _CLOSE = b"{[", b"}]"
_SPACE = "[ \\t\\r\\n]*"

_STEP = np.zeros(256, dtype=np.int64)
_STEP[list(_OPEN)] = 1
_STEP[list(_CLOSE)] = -1

_RECORD, _HEAD, _TAIL, _THROUGH = range(4)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, start, nth, piece): the file's text up to and with each ``}``; the last piece gets one too."""
    read = spark.read.option("lineSep", "}").text(path)
    return read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nth"),
        F.concat("value", F.lit("}")).alias("piece"),
    )


def _scan(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte, whether it is on the other side of a text's quotes than the first byte's start, and
    what it would do to the depth outside of texts. A piece never ends in a backslash.
    """
    place = np.arange(len(data))
    plain = np.maximum.accumulate(np.where(data != _BACKSLASH, place, -1))
    run = place - 1 - np.append(-1, plain[:-1])
    quotes = (data == _QUOTE) & (run % 2 == 0)
    return np.cumsum(quotes) % 2 == 1, _STEP[data]


def _flat(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces, and where each ends."""
    pieces = pieces.cast(pa.large_string())
    _, offsets, data = pieces.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds[1:] - bounds[0]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batch cut where the range changes."""
    start, file = batch["start"].to_numpy(), batch["file"].dictionary_encode().indices.to_numpy()
    new = np.flatnonzero((start[1:] != start[:-1]) | (file[1:] != file[:-1])) + 1
    for a, b in zip(np.append(0, new), np.append(new, len(start)), strict=True):
        if b > a:
            yield (batch["file"][int(a)].as_py(), int(start[a])), batch.slice(a, b - a)


_EFFECTS = "file string, size long, start long, nth long, flips long, outside long, inside long, bytes long"


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, size, start, nth, flips, outside, inside, bytes) per batch and range: whether the state
    flips, and the change of depth if the range's part starts outside of a text, or inside one.
    """
    for batch in batches:
        rows = []
        for (file, start), run in _runs(batch):
            data = _flat(run["piece"])[0]
            flipped, step = _scan(data)
            outside, inside = int(step[~flipped].sum()), int(step[flipped].sum())
            size, nth = run["size"][0].as_py(), run["nth"][0].as_py()
            rows.append((file, size, start, nth, int(flipped[-1]), outside, inside, len(data)))
        if rows:
            names = [f.split()[0] for f in _EFFECTS.split(", ")]
            yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names=names)


def _starts(pieces: DataFrame) -> DataFrame:
    """(file, start, in_text, depth, last) per range: the state that it starts in."""
    parts = checkpointed(pieces.mapInArrow(_effects, _EFFECTS))
    # A range has a row per batch. All ranges of a file are few numbers each.
    before = Window.partitionBy("file").orderBy("start", "nth").rowsBetween(Window.unboundedPreceding, -1)
    states = parts.withColumn("in_text", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    change = F.when(F.col("in_text") == 1, F.col("inside")).otherwise(F.col("outside"))
    states = states.withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0)))
    first = states.groupBy("file", "size", "start").agg(
        F.min(F.struct("nth", "in_text", "depth")).alias("s"), F.sum("bytes").alias("bytes")
    )
    whole = Window.partitionBy("file")
    # Of a file that ends in ``}``, which no array does, that one is its own.
    own = F.sum("bytes").over(whole) == F.col("size")
    last = (F.col("start") == F.max("start").over(whole)) & ~own
    return first.select("file", "start", "s.in_text", "s.depth", last.alias("last"))


class _Range:
    """Cuts one range's pieces into records."""

    def __init__(self, file: str, start: int, in_text: int, depth: int, last: bool):
        self.file, self.start, self.last = file, start, last
        self.in_text, self.depth = bool(in_text), depth
        self.open: list[bytes] = []
        self.held: pa.Array | None = None
        self.cut = False

    def feed(self, pieces: pa.Array) -> list[tuple]:
        if self.last:
            # The file's last piece has no ``}`` of its own; it is known as such when none follows.
            whole = pieces if self.held is None else pa.concat_arrays([self.held, pieces])
            pieces, self.held = whole[:-1], whole[-1:]
        if not len(pieces):
            return []
        data, ends = _flat(pieces)
        flipped, step = _scan(data)
        inside = flipped ^ self.in_text
        depth = self.depth + np.cumsum(np.where(inside, 0, step))
        close = ends[(depth[ends - 1] == 1) & ~inside[ends - 1]]
        self.in_text, self.depth = bool(inside[-1]), int(depth[-1])
        rows, at = [], 0
        for end in close.tolist():
            kind = _RECORD if self.cut or self.start == 0 else _HEAD
            first = not self.cut and self.start == 0
            rows.append((kind, first, b"".join((*self.open, data[at:end].tobytes()))))
            self.open, self.cut, at = [], True, end
        self.open.append(data[at:].tobytes())
        return rows

    def close(self) -> list[tuple]:
        if self.held is not None:
            self.open.append(self.held[0].as_py().encode()[:-1])
        first = not self.cut and self.start == 0
        return [(_TAIL if self.cut else _THROUGH, first, b"".join(self.open))]


_CUT = "file string, start long, kind int, first boolean, text string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Range | None = None

    def rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        if found:
            kind, first, text = zip(*found, strict=True)
            n = len(found)
            columns = ([now.file] * n, [now.start] * n, pa.array(kind, pa.int32()), first, [t.decode() for t in text])
            yield pa.record_batch([pa.array(c) for c in columns], names=[f.split()[0] for f in _CUT.split(", ")])

    for batch in batches:
        for (file, start), run in _runs(batch):
            if now is None or (now.file, now.start) != (file, start):
                if now is not None:
                    yield from rows(now.close())
                given = [run[c][0].as_py() for c in ("in_text", "depth", "last")]
                now = _Range(file, start, *given)
            pieces = run["piece"]
            for at in range(0, len(pieces), 1000):
                yield from rows(now.feed(pieces[at : at + 1000]))
    if now is not None:
        yield from rows(now.close())


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of every element of the array documents under ``path``.

    Elements must be objects, separated by commas, in one array, with nothing before or behind it;
    anything else fails the query. A document of blanks has no records.
    """
    pieces = _pieces(spark, path)
    starts = checkpointed(_starts(pieces))
    keys = ["file", "start"]
    if fits_broadcast(starts):
        placed = pieces.join(F.broadcast(starts), keys)
    else:
        # A join by shuffle loses the order of the pieces.
        placed = pieces.join(starts.hint("shuffle_hash"), keys).sortWithinPartitions(*keys, "nth")
    found = placed.select(*keys, "nth", "piece", "in_text", "depth", "last").mapInArrow(_cut, _CUT)
    # Fragments are read again for the joined ones; records within a range are not set down.
    whole = found.filter(F.col("kind") == _RECORD).select("text", "first", F.lit(True).alias("closed"))
    parts = found.filter(F.col("kind") != _RECORD)
    before = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    closed = (F.col("kind") == _HEAD).cast("int")
    numbered = parts.withColumn("record", F.coalesce(F.sum(closed).over(before), F.lit(0)))
    joined = numbered.groupBy("file", "record").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))), lambda p: p["text"]), ""
        ).alias("text"),
        F.bool_or("first").alias("first"),
        F.bool_or(F.col("kind") == _HEAD).alias("closed"),
    )
    texts = whole.unionByName(joined.select("text", "first", "closed"))
    opening = F.when(F.col("first"), F.lit(f"^{_SPACE}\\[{_SPACE}\\{{")).otherwise(F.lit(f"^{_SPACE},{_SPACE}\\{{"))
    ending = F.when(F.col("first"), F.lit(f"^( *|{_SPACE}\\[{_SPACE}\\]{_SPACE})$")).otherwise(F.lit(f"^{_SPACE}\\]{_SPACE}$"))
    proper = F.regexp_like("text", F.when(F.col("closed"), opening).otherwise(ending))
    checked = F.when(proper, F.col("text")).otherwise(
        F.raise_error(F.lit("a document is not one array of records"))
    )
    # A document's end must be looked at too, so the check comes before what is left out.
    records = texts.select(F.regexp_replace(checked, f"^{_SPACE}[\\[,]{_SPACE}(?=\\{{)", "").alias("record"), "closed")
    return records.filter(F.when(F.col("closed"), F.col("record").isNotNull()).otherwise(F.length("record") < 0)).select("record")
