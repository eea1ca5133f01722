"""Phrases that stand together more often than their parts would, by Toivonen's method.

A sample of the documents proposes the phrases that may be frequent, with a lowered threshold. One pass
over all documents counts them, together with their negative border: the phrases that were not proposed
though both of their parts, without the last and without the first word, were. If a phrase of the border
turns out to be frequent, those that it makes possible have not been counted yet, and a further pass
counts them, until none is left. The result is exact whatever the sample was.

These passes know phrases by 64-bit hashes: a task adds its own up and sends hash and number, packed by
part of the hash space, not the text. Chance matches only let more phrases in. A last pass counts what was
frequent by the words themselves. In all of them a task looks phrases up in a Bloom filter of bounded size;
what that lets in needlessly is counted too, and changes nothing.

A phrase's words stand in one piece of a text, between ``.,;:!?`` and line ends. A null lang counts as
``und``, a null text as empty. Texts of any length are worked on in blocks, across which phrases go on.
Rows repeated whole count as often as they stand. Equal scores go by count, then by the phrase's bytes.
Extra columns are not read; no rows, or no frequent phrases, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm import texts
from siltstone.llm.joins import attach
from siltstone.runtime import checkpointed, has_rows, scratch_path

LEAST = 30
LONGEST = 4
TOP = 2000
# One document in so many is in the sample; there a phrase is proposed from so many occurrences on.
SAMPLE_ONE_IN = 8
SAMPLE_LEAST = 2
FILTER_BITS = (1 << 16, 1 << 27)
BITS_PER_PHRASE = 16
# Text whose phrases a part of the hash space has on average, all in one task.
PART_BYTES = 1 << 25
# A task sends what it holds when, added up, it is over three quarters of this; with texts, of half of it.
HELD_ROWS = 1 << 21
EMITTED_ROWS = 1 << 16
SALTS = 64

# The bytes that end a piece, and those that part words within one.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
GAPS = b"\x20\x09"

_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[list(BREAKS)] = True
_IS_GAP = _IS_BREAK.copy()
_IS_GAP[list(GAPS)] = True
_LANES = np.random.default_rng(23).integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_STEP = np.uint64(0x9FB21C651E98DF25)

PACKED = "level int, part int, h binary, n binary"
SENT = "part int, rows binary"


class Filter:
    """A Bloom filter over hashes, as 64-bit words."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @staticmethod
    def of(phrases: DataFrame) -> Filter:
        """The filter of the column ``h``. Its size is bounded, so it may be collected."""
        bits, rows = FILTER_BITS[0], phrases.count()
        while bits < min(rows * BITS_PER_PHRASE, FILTER_BITS[1]):
            bits *= 2

        def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = np.ascontiguousarray(batch["h"].to_numpy()).view(np.uint64)
                bit = np.unique(np.concatenate(list(Filter._bits(h, bits))))
                slot, start = np.unique(bit >> np.uint64(6), return_index=True)
                ones = np.uint64(1) << (bit & np.uint64(63))
                word = np.bitwise_or.reduceat(ones, start) if len(bit) else ones
                yield pa.record_batch({"slot": pa.array(slot.view(np.int64)), "word": pa.array(word.view(np.int64))})

        slots = phrases.select("h").mapInArrow(set_bits, "slot long, word long")
        found = slots.groupBy("slot").agg(F.bit_or("word").alias("word")).toArrow()
        words = np.zeros(bits // 64, dtype=np.int64)
        words[found["slot"].to_numpy()] = found["word"].to_numpy()
        return Filter(words.view(np.uint64))

    @staticmethod
    def _bits(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
        mask = np.uint64(size - 1)
        for _ in range(2):
            yield h & mask
            yield (h >> np.uint64(32)) & mask
            h = texts.mixed(h ^ _STEP)

    def has(self, h: np.ndarray) -> np.ndarray:
        inside = np.ones(len(h), dtype=bool)
        for bit in self._bits(h, len(self.slots) * 64):
            inside &= (self.slots[bit >> np.uint64(6)] >> (bit & np.uint64(63))).astype(np.uint8) & 1 == 1
        return inside


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _reach(data: np.ndarray, end: int, bound: int, words: int) -> int:
    """A place behind the next ``words`` words after ``end``, or the text's end."""
    size = 4096
    while True:
        stop = min(end + size, bound)
        gap = _IS_GAP[data[end:stop]]
        ends = np.flatnonzero(~gap[:-1] & gap[1:]) if len(gap) else gap
        if len(ends) >= words or stop == bound:
            return end + int(ends[words - 1]) + 1 if len(ends) >= words else bound
        size *= 4


class Block:
    """The words of a block of texts, and hashes of the phrases that start at them.

    The block goes on for as many words as a phrase needs that starts in it; ``n`` words are its own.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, start: int, end: int, seed: np.ndarray):
        text = int(np.searchsorted(offsets, end, side="left"))
        stop = end if offsets[text] == end else _reach(data, end, int(offsets[text]), LONGEST - 1)
        self.data = data = texts.lowered(data[start:stop])
        gap = _IS_GAP[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        lo, hi = np.searchsorted(offsets, [start, stop + 1])
        edge[offsets[lo:hi] - start] = True
        edge[0] = edge[-1] = True
        before, after = edge[:-1].copy(), edge[1:].copy()
        before[1:] |= gap[:-1]
        after[:-1] |= gap[1:]
        self.first, self.last = np.flatnonzero(before & ~gap), np.flatnonzero(after & ~gap) + 1
        self.n = int(np.searchsorted(self.first, end - start))
        self.row = np.searchsorted(offsets, self.first + start, side="right") - 1
        self.seed = seed[self.row]
        # A word and the next one are joined if no break stands between them.
        breaks = np.flatnonzero(_IS_BREAK[data])
        seen = np.searchsorted(breaks, self.first)
        self.joined = np.zeros(len(self.first), dtype=bool)
        self.joined[:-1] = (seen[1:] == seen[:-1]) & (self.row[1:] == self.row[:-1])

    def words(self, lane: int) -> np.ndarray:
        """A hash per word, of its bytes and its language."""
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_LANES[lane][self.data] * texts.powers(len(self.data))[0][:-1], out=sums[1:])
        return texts.mixed(texts.range_hash(sums, self.first, self.last) ^ self.seed)

    @staticmethod
    def longer(at: np.ndarray, shorter: np.ndarray, words: np.ndarray, level: int) -> np.ndarray:
        """Hashes of the phrases of so many words at ``at``, from those of one word less."""
        return texts.mixed((shorter[at] ^ _STEP) + words[at + level - 1])

    def phrases(self, at: np.ndarray, level: int) -> pa.Array:
        """The words with one blank between any two."""
        word = (at[:, None] + np.arange(level)).ravel()
        size = (self.last - self.first)[word] + 1
        ends = np.cumsum(size) - 1
        chosen = np.append(self.data, np.uint8(32))[_ranges(self.first[word], self.last[word] + 1)]
        chosen[ends] = 32
        # The last word's blank goes.
        keep = np.ones(len(chosen), dtype=bool)
        keep[ends[level - 1 :: level]] = False
        offsets = np.zeros(len(at) + 1, dtype=np.int64)
        np.cumsum(size.reshape(-1, level).sum(axis=1) - 1, out=offsets[1:])
        kept = np.ascontiguousarray(chosen[keep])
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])


def _language_seeds(languages: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x.encode()) for x in languages], dtype=np.uint64)


def _blocks(batches: Iterator[pa.RecordBatch], languages: dict[str, int]) -> Iterator[tuple[Block, np.ndarray]]:
    """The blocks of all batches, each with the number of the language of every text; ``languages``
    gets the numbers.
    """
    for batch in batches:
        encoded = batch["lang"].cast(pa.string()).dictionary_encode()
        local = np.array([languages.setdefault(x.as_py(), len(languages)) for x in encoded.dictionary], dtype=np.int64)
        row_lang = local[encoded.indices.to_numpy(zero_copy_only=False)] if len(local) else local
        seed = _language_seeds(list(languages))[row_lang]
        data, offsets = texts.flat(batch["text"])
        for start, end in texts.blocks(data, offsets):
            yield Block(data, offsets, start, end, seed), row_lang


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h = h[order]
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else order
    return h[starts], np.add.reduceat(n[order], starts) if len(h) else n


def tally(
    docs: DataFrame, levels: list[int], known: Filter | None, fresh: Filter | None, least: int, parts: int
) -> DataFrame:
    """(level, h) of the phrases with a number of words among ``levels`` whose two parts are ``known``,
    one of them ``fresh`` if that is given, and that stand at least so often.
    """
    context = docs.sparkSession.sparkContext
    held_known = context.broadcast(known and known.slots)
    held_fresh = context.broadcast(fresh and fresh.slots)
    deepest = max(levels)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = held_known.value is not None and Filter(held_known.value)
        new = held_fresh.value is not None and Filter(held_fresh.value)
        held: dict[int, list] = {level: [] for level in levels}
        rows = 0

        def combine() -> int:
            for level, found in held.items():
                if found:
                    held[level] = [_summed(*(np.concatenate(c) for c in zip(*found, strict=True)))]
            return sum(len(f[0][0]) for f in held.values() if f)

        def emitted() -> Iterator[pa.RecordBatch]:
            combine()
            for level, found in held.items():
                if not found:
                    continue
                h, n = found[0]
                bounds = np.searchsorted(_part(h, parts), np.arange(parts + 1))
                filled = np.flatnonzero(bounds[1:] > bounds[:-1])
                spans = [(int(bounds[k]), int(bounds[k + 1])) for k in filled]
                yield pa.record_batch(
                    [
                        pa.array([level] * len(filled), pa.int32()),
                        pa.array(filled, pa.int32()),
                        pa.array([h[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([n[a:b].tobytes() for a, b in spans], pa.binary()),
                    ],
                    names=[f.split()[0] for f in PACKED.split(", ")],
                )
                held[level] = []

        for block, _ in _blocks(batches, {}):
            words = h = block.words(0)
            at = np.arange(len(words))
            # Whether the phrase that starts at a word is known, and whether it is fresh.
            ok = is_new = np.zeros(0, dtype=bool)
            for level in range(1, deepest + 1):
                if level > 1:
                    at = at[at + level <= len(words)]
                    at = at[block.joined[at + level - 2] & ok[at] & ok[at + 1]]
                    longer = np.zeros(len(words), dtype=np.uint64)
                    longer[at] = block.longer(at, h, words, level)
                    h = longer
                if level in levels:
                    chosen = at[at < block.n]
                    if new and level > 1:
                        chosen = chosen[is_new[chosen] | is_new[chosen + 1]]
                    if len(chosen):
                        found = np.sort(h[chosen])
                        starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
                        held[level].append((found[starts], np.diff(np.append(starts, len(found)))))
                        rows += len(starts)
                if level < deepest and inside:
                    ok, is_new = (np.zeros(len(words) + 1, dtype=bool) for _ in range(2))
                    ok[at] = inside.has(h[at])
                    if new:
                        is_new[at] = ok[at] & new.has(h[at])
            if rows > HELD_ROWS:
                rows = combine()
                if rows > HELD_ROWS * 3 // 4:
                    yield from emitted()
                    rows = 0
        yield from emitted()

    def merged(table: pa.Table) -> pa.Table:
        h, n = (np.frombuffer(b"".join(table[c].to_pylist()), dtype=t) for c, t in (("h", np.uint64), ("n", np.int64)))
        h, n = _summed(h, n)
        h = h[n >= least].view(np.int64)
        level = table["level"][0].as_py() if table.num_rows else 0
        return pa.table({"level": pa.array([level] * len(h), pa.int32()), "h": pa.array(h)})

    rows = docs.select("lang", "text").mapInArrow(packed, PACKED)
    return rows.groupBy("level", "part").applyInArrow(merged, "level int, h long")


def propose(docs: DataFrame, parts: int) -> DataFrame:
    """(level, h) of the phrases that are frequent in a sample of the documents, level by level."""
    spark = docs.sparkSession
    path = scratch_path(spark, "sample")
    docs.filter(F.pmod(F.col("place"), F.lit(SAMPLE_ONE_IN)) == 0).write.parquet(path)
    sample = spark.read.parquet(path)
    proposed = checkpointed(tally(sample, [1], None, None, SAMPLE_LEAST, parts))
    for level in range(2, LONGEST):
        found = checkpointed(tally(sample, [level], Filter.of(proposed), None, SAMPLE_LEAST, parts))
        if not has_rows(found):
            break
        proposed = proposed.unionByName(found)
    return proposed


def candidates(docs: DataFrame, least: int, parts: int) -> DataFrame:
    """(level, h) of all phrases that stand at least so often, and perhaps of a few more."""
    proposed = propose(docs, parts)
    found = checkpointed(tally(docs, list(range(1, LONGEST + 1)), Filter.of(proposed), None, least, parts))
    # Those found later stay fresh to the end: what a false entry of a filter hid becomes reachable.
    fresh = last = checkpointed(found.filter(F.col("level") < LONGEST).join(proposed.select("h"), "h", "left_anti"))
    while has_rows(last):
        shortest = fresh.agg(F.min("level")).first()[0] + 1
        levels = list(range(shortest, LONGEST + 1))
        counted = tally(docs, levels, Filter.of(found), Filter.of(fresh), least, parts)
        added = checkpointed(counted.join(found.select("h"), "h", "left_anti"))
        found, last = found.unionByName(added), added.filter(F.col("level") < LONGEST)
        fresh = fresh.unionByName(last)
    return found


def count_exactly(docs: DataFrame, wanted: Filter, least: int, parts: int) -> DataFrame:
    """(lang, phrase, level, f) of all phrases that are wanted and stand at least so often; level 0 is
    the number of words.
    """
    held = docs.sparkSession.sparkContext.broadcast(wanted.slots)
    columns = [("lang", pa.string()), ("phrase", pa.large_string()), ("level", pa.int32()), ("n", pa.int64())]
    sent = pa.schema(columns)
    result = pa.schema([columns[0], ("phrase", pa.string()), columns[2], ("f", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = Filter(held.value)
        languages: dict[str, int] = {}
        words: dict[int, int] = {}
        found: list[tuple] = []
        rows = 0

        def combine() -> int:
            # Equal phrases have equal pairs of hashes; a pair's rows may end up as several, which add up later.
            h1, h2, n, level, lang = (np.concatenate(c) for c in list(zip(*found, strict=True))[:5])
            phrases = pa.concat_arrays([p[5] for p in found])
            order, starts = _pairs(h1, h2)
            first = order[starts]
            sums = np.add.reduceat(n[order], starts)
            found[:] = [(h1[first], h2[first], sums, level[first], lang[first], phrases.take(pa.array(first)))]
            return len(first)

        def emitted() -> Iterator[pa.RecordBatch]:
            if found:
                combine()
                h1, _, n, level, lang, phrases = found[0]
                named = pa.array(list(languages), pa.string()).take(pa.array(lang))
                whole = pa.table([named, phrases, pa.array(level), pa.array(n)], schema=sent)
                yield from _packed(whole, np.searchsorted(_part(h1, parts), np.arange(parts + 1)))
                found.clear()

        for block, row_lang in _blocks(batches, languages):
            lang = row_lang[block.row]
            for k, n in enumerate(np.bincount(lang[: block.n])):
                words[k] = words.get(k, 0) + int(n)
            single = one, two = block.words(0), block.words(1)
            at, ok = np.arange(len(one)), np.zeros(0, dtype=bool)
            for level in range(1, LONGEST + 1):
                if level > 1:
                    at = at[at + level <= len(one)]
                    at = at[block.joined[at + level - 2] & ok[at] & ok[at + 1]]
                    longer = np.zeros((2, len(one)), dtype=np.uint64)
                    for k, h in enumerate((one, two)):
                        longer[k, at] = block.longer(at, h, single[k], level)
                    one, two = longer
                at = at[inside.has(one[at])]
                ok = np.zeros(len(one) + 1, dtype=bool)
                ok[at] = True
                own = at[at < block.n]
                if len(own):
                    order, starts = _pairs(one[own], two[own])
                    n, own = np.diff(np.append(starts, len(order))), own[order[starts]]
                    levels = np.full(len(own), level, dtype=np.int32)
                    found.append((one[own], two[own], n, levels, lang[own], block.phrases(own, level)))
                    rows += len(own)
            if rows > HELD_ROWS // 2:
                rows = combine()
                if rows > HELD_ROWS * 3 // 8:
                    yield from emitted()
                    rows = 0
        yield from emitted()
        if words:
            names = list(languages)
            totals = [[names[k] for k in words], [""] * len(words), [0] * len(words), list(words.values())]
            whole = pa.table([pa.array(c, kind) for c, (_, kind) in zip(totals, columns, strict=True)], schema=sent)
            yield from _packed(whole, np.append(0, np.full(parts, len(words))))

    def merged(table: pa.Table) -> pa.Table:
        whole = pa.concat_tables([pa.ipc.open_stream(rows).read_all() for rows in table["rows"].to_pylist()])
        sums = whole.group_by(["lang", "phrase", "level"]).aggregate([("n", "sum")])
        sums = sums.filter((pc.field("level") == 0) | (pc.field("n_sum") >= least))
        return sums.select(["lang", "phrase", "level", "n_sum"]).rename_columns(result.names).cast(result)

    rows = docs.select("lang", "text").mapInArrow(counted, SENT)
    return rows.groupBy("part").applyInArrow(merged, "lang string, phrase string, level int, f long")


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    """The part of the hash space, by the upper bits, so that parts are ranges of sorted hashes."""
    return (h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def _packed(whole: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(part, rows): per part a compressed stream of its rows of ``whole``."""
    filled = np.flatnonzero(bounds[1:] > bounds[:-1])
    rows = []
    for k in filled:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(whole.slice(bounds[k], bounds[k + 1] - bounds[k]))
        rows.append(sink.getvalue().to_pybytes())
    yield pa.record_batch([pa.array(filled, pa.int32()), pa.array(rows, pa.binary())], names=["part", "rows"])


def _pairs(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal pairs stand together, and where each run of them starts.

    Pairs that share the first hash alone may be split into several runs.
    """
    order = np.argsort(h1)
    a, b = h1[order], h2[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


def frequent(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, level, f) of all phrases that stand at least so often, and (lang, n)."""
    docs = texts.bound_batches(docs).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.xxhash64(*[F.col(c) for c in docs.columns if c in ("doc_id", "text")]).alias("place"),
    )
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = 1 + size // PART_BYTES
    counted = checkpointed(count_exactly(docs, Filter.of(candidates(docs, least, parts)), least, parts))
    words = counted.filter("level = 0").select("lang", F.col("f").alias("n"))
    return counted.filter("level > 0"), words


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of each language."""
    found, words = frequent(docs, least)
    longer_than_one = found.filter("level > 1").withColumn("words", F.split("phrase", " ", -1))

    def part(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    k = F.col("k")
    cuts = longer_than_one.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("level") - 1)))
    cuts = cuts.select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        part(F.lit(1), k).alias("first"), part(k + 1, F.col("level") - k).alias("rest"),
    )
    used = cuts.select("lang", F.explode(F.array("first", "rest")).alias("phrase"))
    used = used.groupBy("lang", "phrase").agg(F.count("*").alias("rows"))
    parts = checkpointed(used.join(found, ["lang", "phrase"]).select("lang", "phrase", "f", "rows"))
    cuts = attach(cuts, parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"), "rows"), ["lang", "first"], "rows")
    cuts = attach(cuts, parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"), "rows"), ["lang", "rest"], "rows")
    wide = "decimal(38,0)"
    score = F.expr(f"(cast(2000000 as decimal(8,0)) * cast(a as decimal(20,0))) div (cast(l as {wide}) + r)")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )

    lengths = F.sequence(F.lit(2), F.col("level") - 1)
    inner = longer_than_one.filter("level > 2").select(
        "lang",
        "f",
        F.explode(
            F.flatten(
                F.transform(
                    lengths,
                    lambda m: F.transform(
                        F.sequence(F.lit(1), F.col("level") - m + 1),
                        lambda s: F.array_join(F.slice("words", s, m), " "),
                    ),
                )
            )
        ).alias("phrase"),
    )
    longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = worst.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("a").cast(wide) * 80)
    )
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        best = Window.partitionBy(*keys).orderBy(*order)
        salted = salted.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    return salted.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
