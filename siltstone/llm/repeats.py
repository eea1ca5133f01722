"""Repeated passages: every byte covered by a ``SPAN``-byte string that also starts earlier.

Suffixes are sorted by a distributed merge sort that knows common prefixes. Not all suffixes are:

1. Anchors. The smallest hash of the ``GRAM``-byte strings inside a ``SPAN``-byte window is its anchor;
   equal windows have equal anchors, and about one byte in forty is one. An anchor stands for all
   windows that have it, its unit. Only suffixes that start at anchors are sorted.
2. Distinguishing prefixes. Anchors' gram hashes are exchanged first; a suffix whose first ``GRAM``
   bytes occur nowhere else can repeat nothing and stays home.
3. Runs. Each part of the documents sorts its remaining suffixes, equal units once, and sends them
   front-coded (common prefix length and the rest) to ranges of the order.
4. Merge. A range merges its runs with a loser tree whose nodes keep the common prefix with the last
   winner, so that no character known to be common is compared again. Its output carries common
   prefix lengths, and with the bytes before the anchor these say which windows of which units are
   equal; of equal windows all but the first are repeats.
5. Where a range's bound falls into suffixes with one common gram (as it does where a passage is very
   frequent), the windows of these go by their digest to buckets that know the first of each.

A passage repeated inside a part is settled there; one entry per part goes on, whatever its
frequency. Nothing is capped.

Order is (document, start). A document is an id with its text; rows equal in both are one document.
Where ids are null or stand for several texts, documents are numbered by (id, text hash), null first.
Null text counts as empty. Texts shorter than ``SPAN`` bytes keep all. Extra columns are not read, an
empty table gives no rows, long texts are worked on block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.texts import BLOCK_BYTES, bound_batches, flat, mixed, powers, prefix_sums
from siltstone.runtime import checkpointed

# Fixed value: length of a repeated string.
SPAN = 100

GRAM = 24
WINDOW = SPAN - GRAM + 1
PART_BYTES = 6 << 20
PACK_BYTES = 16 << 20
SAMPLE_GRAMS = 1 << 15
_SAMPLED = np.uint64(0x5851F42D4C957F2D)
FAN_IN = 256
FEW = 12
_PLACE_BITS = 23
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)

_ROWS = "key long, payload binary"


# Anchors


def _starts(offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Stretches [start, end) of window starts, and where the bytes they need end."""
    start, n = 0, int(offsets[-1])
    while start < n:
        after = int(np.searchsorted(offsets, start, side="right"))
        last = int(np.searchsorted(offsets, start + BLOCK_BYTES, side="right")) - 1
        if last >= after:
            end = bytes_end = int(offsets[last])
        else:
            bound = int(offsets[after])
            end = min(start + BLOCK_BYTES, bound)
            bytes_end = min(end + SPAN - 1, bound)
        yield start, end, bytes_end
        start = end


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        v = np.minimum(v[:-reach], v[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def units(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Per stretch: row, hash of the anchor's gram, anchor, first and last window start, as
    positions in ``data``.
    """
    for start, end, bytes_end in _starts(offsets):
        if bytes_end - start < SPAN:
            continue
        sums = prefix_sums(data[start:bytes_end])
        inverse = powers(bytes_end - start)[1]
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(sums) - GRAM])
        places = np.arange(len(grams), dtype=np.uint64)
        anchor = (_sliding_least((grams & ~_PLACE) | places, WINDOW) & _PLACE).astype(np.int64)
        anchor = anchor[: end - start]
        row = np.searchsorted(offsets, np.arange(start, start + len(anchor)), side="right") - 1
        valid = np.arange(start, start + len(anchor)) + SPAN <= offsets[row + 1]
        fresh = valid.copy()
        fresh[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        final = valid.copy()
        final[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
        first, last = np.flatnonzero(fresh), np.flatnonzero(final)
        at = anchor[first]
        yield row[first], grams[at], at + start, first + start, last + start


# Payloads


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, compressed; ids sorted beforehand shrink to their steps."""
    head = np.array([len(columns[0])], dtype=np.int64).tobytes()
    body = b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def _unpack(payload: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _pack_places(rid: np.ndarray, at: np.ndarray) -> bytes:
    return _pack(_steps(rid), at.astype(np.uint32))


def _unpack_places(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    rid, at = _unpack(payload, "i8", "u4")
    return np.cumsum(rid), at.astype(np.int64)


def _rows(keys: list[int], payloads: list[bytes]) -> dict:
    return {"key": pa.array(keys, pa.int64()), "payload": pa.array(payloads, pa.binary())}


def _by_part(rid: np.ndarray, parts: int, columns: tuple[np.ndarray, ...], pack) -> tuple[list[int], list[bytes]]:
    """Rows for the documents' parts, under keys below zero."""
    keys, payloads = [], []
    part = rid % parts
    order = np.lexsort((*columns[::-1], rid, part))
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for group in np.split(order, cuts) if len(order) else []:
        keys.append(-1 - int(part[group[0]]))
        payloads.append(pack(rid[group], *(c[group] for c in columns)))
    return keys, payloads


def _pack_spans(rid: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    return _pack(_steps(rid), start.astype(np.uint32), (end - start).astype(np.uint32))


def _unpack_spans(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rid, start, length = _unpack(payload, "i8", "u4", "u4")
    start = start.astype(np.int64)
    return np.cumsum(rid), start, start + length


# 1 and 2: grams that occur twice


def _exchange_grams(parts: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def send() -> pa.RecordBatch:
            gram, rid, at = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((at, rid, gram))
            gram, rid, at = gram[order], rid[order], at[order]
            same = gram[1:] == gram[:-1]
            elsewhere = same & ((rid[1:] != rid[:-1]) | (at[1:] != at[:-1]))
            # Grams twice in this task are settled here; one of each is sent all the same.
            first = np.concatenate([[True], ~same])
            group = np.cumsum(first) - 1
            twice = np.zeros(group[-1] + 1, dtype=bool)
            twice[group[1:][elsewhere]] = True
            settled = twice[group]
            keys, payloads = _by_part(rid[settled], parts, (at[settled],), _pack_places)
            gram, rid, at = gram[first], rid[first], at[first]
            bucket = (gram % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((at, rid, bucket))
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            for some in np.split(order, cuts):
                keys.append(int(bucket[some[0]]))
                # 40 bits of the gram's hash beside its bucket: an equal pair by chance costs a
                # comparison later, no more.
                rest = gram[some] // np.uint64(buckets)
                low, high = rest.astype(np.uint32), (rest >> np.uint64(32)).astype(np.uint8)
                payloads.append(_pack(_steps(rid[some]), at[some].astype(np.uint32), low, high))
            return pa.RecordBatch.from_pydict(_rows(keys, payloads))

        size = 0
        for batch in batches:
            data, offsets = flat(batch["text"])
            rid = batch["rid"].to_numpy()
            for row, gram, at, _, _ in units(data, offsets):
                if len(row):
                    held.append((gram, rid[row], at - offsets[row]))
                    size += len(row)
            if size > 2_000_000:
                yield send()
                size = 0
        if held:
            yield send()

    return run


def _resolve_grams(parts: int):
    def run(table: pa.Table) -> pa.Table:
        key = table["key"][0].as_py()
        payloads = table["payload"].to_pylist()
        if key < 0:
            return pa.table(_rows([key] * len(payloads), payloads))
        found = [_unpack(p, "i8", "u4", "u4", "u1") for p in payloads]
        rid = np.concatenate([np.cumsum(f[0]) for f in found])
        at = np.concatenate([f[1] for f in found])
        gram = np.concatenate([f[2].astype(np.int64) + (f[3].astype(np.int64) << 32) for f in found])
        order = np.argsort(gram, kind="stable")
        gram, rid, at = gram[order], rid[order], at[order]
        same = gram[1:] == gram[:-1]
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        return pa.table(_rows(*_by_part(rid[twice], parts, (at[twice],), _pack_places)))

    return run


# 3: sorted runs, front-coded


def front_code(strings: list[bytes]) -> np.ndarray:
    """Common prefix length of each sorted string with the one before."""
    if not strings:
        return np.zeros(0, dtype=np.int64)
    width = max(map(len, strings))
    grid = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    unlike = grid[1:] != grid[:-1]
    common = np.where(unlike.any(axis=1), unlike.argmax(axis=1), width)
    lengths = np.array([len(s) for s in strings])
    return np.concatenate([[0], np.minimum(common, np.minimum(lengths[1:], lengths[:-1]))])


Entry = tuple[bytes, bytes, int, int]


def _pack_run(run: list[Entry]) -> bytes:
    """Entries (suffix, bytes before, rid, anchor), sorted."""
    common = front_code([e[0] for e in run])
    rest = b"".join(e[0][c:] for e, c in zip(run, common.tolist(), strict=True))
    left = b"".join(e[1] for e in run)
    columns = (
        common.astype(np.uint8),
        np.array([len(e[0]) for e in run], np.uint8),
        np.array([len(e[1]) for e in run], np.uint8),
        np.array([e[2] for e in run], np.int64),
        np.array([e[3] for e in run], np.uint32),
    )
    head = np.array([len(run), len(rest)], dtype=np.int64).tobytes()
    raw = head + b"".join(c.tobytes() for c in columns) + rest + left
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack_run(payload: bytes) -> tuple[list[Entry], list[int]]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, size = np.frombuffer(raw, np.int64, 2).tolist()
    at, columns = 16, []
    for kind in ("u1", "u1", "u1", "i8", "u4"):
        columns.append(np.frombuffer(raw, kind, n, at).tolist())
        at += n * np.dtype(kind).itemsize
    left_at, run, before = at + size, [], b""
    for common, length, left, rid, place in zip(*columns, strict=True):
        before = before[:common] + raw[at : at + length - common]
        at += length - common
        run.append((before, raw[left_at : left_at + left], rid, place))
        left_at += left
    return run, columns[0]


def _covers(entry: Entry) -> tuple[int, int]:
    """Bytes of its document that an entry's windows cover."""
    suffix, left, _, at = entry
    return at - len(left), at + len(suffix)


def _sort_runs(parts: int, splitters: list[bytes]):
    bounds = np.array(splitters, dtype=object)

    def run(table: pa.Table) -> pa.Table:
        docs, replies = _sides(table)
        if not docs.num_rows or not replies:
            return pa.table(_rows([], []))
        places = [_unpack_places(p) for p in replies]
        wanted_rid = np.concatenate([p[0] for p in places])
        wanted_at = np.concatenate([p[1] for p in places])
        order = np.lexsort((wanted_at, wanted_rid))
        wanted_rid, wanted_at = wanted_rid[order], wanted_at[order]
        docs = docs.filter(pa.array(np.isin(docs["rid"].to_numpy(), wanted_rid)))
        first: dict[tuple[bytes, bytes], tuple[int, int]] = {}
        settled: list[tuple[int, int, int]] = []
        ids = docs["rid"].to_numpy()
        data, offsets = flat(docs["text"])
        for row, _, at, low, high in units(data, offsets):
            rid, base = ids[row], offsets[row]
            keep = np.zeros(len(row), dtype=bool)
            # Where each unit's document begins and ends among the places asked for.
            lo = np.searchsorted(wanted_rid, rid, side="left")
            hi = np.searchsorted(wanted_rid, rid, side="right")
            for r in np.unique(row):
                mine = np.flatnonzero(row == r) if len(row) < 64 else np.arange(*np.searchsorted(row, [r, r + 1]))
                k = mine[0]
                keep[mine] = np.isin(at[mine] - base[k], wanted_at[lo[k] : hi[k]])
            raw = data[int(low[0]) if len(low) else 0 : (int(high[-1]) + SPAN) if len(high) else 0].tobytes()
            shift = int(low[0]) if len(low) else 0
            kept = np.flatnonzero(keep)
            for r, b, p, s, e in zip(*[c[kept].tolist() for c in (rid, base, at, low, high)], strict=True):
                unit = (raw[p - shift : e + SPAN - shift], raw[s - shift : p - shift])
                place = (r, p - b)
                known = first.get(unit)
                if known is None:
                    first[unit] = place
                elif known < place:
                    settled.append((r, s - b, e + SPAN - b))
                elif place < known:
                    first[unit] = place
                    settled.append((known[0], known[1] - (p - s), known[1] + len(unit[0])))
        keys, payloads = _span_rows(settled, parts)
        entries = sorted((suffix, left, *place) for (suffix, left), place in first.items())
        if entries:
            target = np.searchsorted(bounds, np.array([e[0] for e in entries], dtype=object), side="right")
            cuts = np.flatnonzero(np.diff(target)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(entries)], strict=True):
                keys.append(int(target[start]))
                payloads.append(_pack_run(entries[start:end]))
        return pa.table(_rows(keys, payloads))

    return run


def _span_rows(spans: list[tuple[int, int, int]], parts: int) -> tuple[list[int], list[bytes]]:
    if not spans:
        return [], []
    rid, start, end = np.array(spans, dtype=np.int64).T
    return _by_part(rid, parts, (start, end), _pack_spans)


# 4: merge


def _common_from(a: bytes, b: bytes, known: int) -> int:
    """Common prefix length of two strings that agree in their first ``known`` bytes."""
    n = min(len(a), len(b))
    while known < n:
        step = min(16, n - known)
        x = int.from_bytes(a[known : known + step], "big") ^ int.from_bytes(b[known : known + step], "big")
        if x:
            return known + step - (x.bit_length() + 7) // 8
        known += step
    return known


def merge(runs: list[tuple[list[Entry], list[int]]]) -> tuple[list[Entry], list[int]]:
    """One sorted run out of many, with common prefix lengths, by a loser tree.

    ``common[s]`` is what the head of run s has in common with the last winner. Of two heads the
    one with more in common is smaller; only if both have the same are bytes compared, from there.
    """
    while len(runs) > FAN_IN:
        runs = [merge(runs[k : k + FAN_IN]) for k in range(0, len(runs), FAN_IN)]
    if len(runs) == 1:
        return runs[0]
    size = 1 << max(1, (len(runs) - 1).bit_length())
    feeds = [iter(zip(*run, strict=True)) for run in runs]
    heads: list[Entry | None] = [None] * size
    common = [-1] * size
    for s, feed in enumerate(feeds):
        entry, _ = next(feed, (None, -1))
        heads[s] = entry
        common[s] = 0 if entry else -1

    def smaller(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs' heads."""
        ca, cb = common[a], common[b]
        if ca != cb:
            return (a, b) if ca > cb else (b, a)
        if ca < 0:
            return a, b
        x, y = heads[a][0], heads[b][0]
        shared = _common_from(x, y, ca)
        if shared == len(x) or (shared < len(y) and x[shared] < y[shared]):
            common[b] = shared
            return a, b
        common[a] = shared
        return b, a

    losers = [0] * size
    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = smaller(winners[2 * node], winners[2 * node + 1])
    best = winners[1]
    out: list[Entry] = []
    shared_with_last: list[int] = []
    while heads[best] is not None:
        out.append(heads[best])
        shared_with_last.append(common[best])
        heads[best], common[best] = next(feeds[best], (None, -1))
        node = (size + best) >> 1
        while node:
            other = losers[node]
            ca, cb = common[best], common[other]
            if cb > ca:
                losers[node], best = best, other
            elif ca == cb and ca >= 0:
                best, losers[node] = smaller(best, other)
            node >>= 1
    return out, shared_with_last


def _common_end(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    return _common_from(a[::-1][:n], b[::-1][:n], 0)


def _later_windows(group: list[Entry], common: list[int]) -> list[tuple[int, int, int]]:
    """Spans of windows that equal a window of an earlier entry; ``common`` from the merge."""
    spans = []
    if len(group) <= FEW:
        for i in range(len(group)):
            right = SPAN
            for j in range(i + 1, len(group)):
                right = min(right, common[j])
                if group[i][2:] == group[j][2:]:
                    continue
                (a, la, *pa_), (b, lb, *pb_) = group[i], group[j]
                # A window that reaches o bytes before the anchor needs SPAN - o from it on.
                low = max(SPAN - right, SPAN - min(len(a), len(b)))
                high = min(len(la), len(lb))
                if low > high:
                    continue
                high = min(high, _common_end(la, lb))
                if low <= high:
                    rid, at = max(pa_, pb_)
                    spans.append((rid, at - high, at - low + SPAN))
        return spans
    return _windows_by_content(group)[1]


def _windows_by_content(
    group: list[Entry],
) -> tuple[list[tuple[bytes, int, int]], list[tuple[int, int, int]]]:
    """The first (content, rid, start) of each window content, and the spans of all others."""
    firsts, later = [], []
    widest = max(len(e[1]) for e in group)
    for o in range(widest + 1):
        seen: dict[bytes, tuple[int, int]] = {}
        need = SPAN - o
        for suffix, left, rid, at in group:
            if len(left) < o or len(suffix) < need:
                continue
            content = left[len(left) - o :] + suffix[:need]
            place = (rid, at - o)
            known = seen.get(content)
            if known is None:
                seen[content] = place
            elif known < place:
                later.append((rid, at - o, at - o + SPAN))
            elif place < known:
                seen[content] = place
                later.append((known[0], known[1], known[1] + SPAN))
        firsts += [(content, *place) for content, place in seen.items()]
    return firsts, later


def _merge_range(parts: int, buckets: int, splitters: list[bytes]):
    cut_grams = {s[:GRAM] for s in splitters}

    def run(table: pa.Table) -> pa.Table:
        key = table["key"][0].as_py()
        payloads = table["payload"].to_pylist()
        if key < 0:
            return pa.table(_rows([key] * len(payloads), payloads))
        entries, common = merge([_unpack_run(p) for p in payloads])
        spans: list[tuple[int, int, int]] = []
        crossing: list[tuple[bytes, int, int]] = []
        start = 0
        for end in range(1, len(entries) + 1):
            if end < len(entries) and common[end] >= GRAM:
                continue
            cut = entries[start][0][:GRAM] in cut_grams
            if end - start > 1 or cut:
                group, shared = entries[start:end], common[start:end]
                # Equal units from several runs: the first stays, the others are repeats.
                once: list[Entry] = []
                kept: list[int] = []
                known: dict[tuple[bytes, bytes], int] = {}
                least = SPAN
                for entry, c in zip(group, shared, strict=True):
                    least = min(least, c)
                    k = known.get(entry[:2])
                    if k is None:
                        known[entry[:2]] = len(once)
                        once.append(entry)
                        kept.append(least)
                        least = SPAN
                    elif once[k][2:] < entry[2:]:
                        spans.append((entry[2], *_covers(entry)))
                    elif entry[2:] < once[k][2:]:
                        spans.append((once[k][2], *_covers(once[k])))
                        once[k] = entry
                if cut:
                    firsts, later = _windows_by_content(once)
                    crossing += firsts
                    spans += later
                elif len(once) > 1:
                    spans += _later_windows(once, kept)
            start = end
        keys, packed = _span_rows(spans, parts)
        if crossing:
            digest = b"".join(hashlib.blake2b(c, digest_size=16).digest() for c, _, _ in crossing)
            digests = np.frombuffer(digest, np.uint64).reshape(-1, 2)
            rid = np.array([r for _, r, _ in crossing], np.int64)
            at = np.array([s for _, _, s in crossing], np.uint32)
            bucket = (digests[:, 0] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                keys.append(int(bucket[some[0]]))
                packed.append(_pack(digests[some, 0], digests[some, 1], rid[some], at[some]))
        return pa.table(_rows(keys, packed))

    return run


# 5: windows of groups that lie in several ranges


def _first_windows(parts: int):
    def run(table: pa.Table) -> pa.Table:
        key = table["key"][0].as_py()
        payloads = table["payload"].to_pylist()
        if key < 0:
            return pa.table(_rows([key] * len(payloads), payloads))
        found = [_unpack(p, "u8", "u8", "i8", "u4") for p in payloads]
        h, g, rid, at = (np.concatenate(x) for x in zip(*found, strict=True))
        at = at.astype(np.int64)
        order = np.lexsort((at, rid, g, h))
        h, g, rid, at = h[order], g[order], rid[order], at[order]
        fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
        lead = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        later = (rid != rid[lead]) | (at != at[lead])
        return pa.table(_rows(*_by_part(rid[later], parts, (at[later], at[later] + SPAN), _pack_spans)))

    return run


# Documents


def _pack_docs(parts: int):
    """Documents by part, compressed together: both exchanges of texts carry these."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=3).compress
        table = pa.Table.from_batches(held)
        rid = table["rid"].to_numpy()
        part = rid % parts
        order = np.argsort(part, kind="stable")
        known = table["doc_id"].is_valid().to_numpy().astype(np.uint8)
        doc_id = table["doc_id"].fill_null(0).to_numpy()
        data, offsets = flat(table["text"])
        keys, payloads = [], []
        for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            head = np.array([len(some)], np.int64).tobytes()
            columns = (rid[some], doc_id[some], known[some], offsets[some + 1] - offsets[some])
            texts = b"".join(data[offsets[k] : offsets[k + 1]].tobytes() for k in some)
            keys.append(int(part[some[0]]))
            payloads.append(pack(head + b"".join(c.tobytes() for c in columns) + texts))
        return pa.RecordBatch.from_pydict(_rows(keys, payloads))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > PACK_BYTES:
                yield packed(held)
                held, size = [], 0
        if sum(b.num_rows for b in held):
            yield packed(held)

    return run


def _unpack_docs(payload: bytes) -> pa.Table:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, at, columns = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in ("i8", "i8", "u1", "i8"):
        columns.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    rid, doc_id, known, lengths = columns
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    text = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[at:]))
    return pa.table({"rid": rid, "doc_id": pa.array(doc_id, mask=known == 0), "text": text})


def _sides(table: pa.Table) -> tuple[pa.Table, list[bytes]]:
    """The documents of a part, and what else was sent there."""
    payloads = table["payload"].to_pylist()
    is_docs = table["docs"].to_pylist()
    docs = [_unpack_docs(p) for p, d in zip(payloads, is_docs, strict=True) if d]
    empty = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("text", pa.large_string())])
    others = [p for p, d in zip(payloads, is_docs, strict=True) if not d]
    return (pa.concat_tables(docs) if docs else empty.empty_table()), others


def _cut(table: pa.Table) -> pa.Table:
    docs, replies = _sides(table)
    found = [_unpack_spans(p) for p in replies]
    rid, start, end = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
    order = np.argsort(rid, kind="stable")
    rid, start, end = rid[order], start[order], end[order]
    data, offsets = flat(docs["text"])
    n_bytes, n_removed, spans, kept = [], [], [], []
    for k, r in enumerate(docs["rid"].to_pylist()):
        raw = data[offsets[k] : offsets[k + 1]]
        low, high = np.searchsorted(rid, [r, r + 1])
        change = np.zeros(len(raw) + 1, dtype=np.int64)
        np.add.at(change, start[low:high], 1)
        np.add.at(change, end[low:high], -1)
        gone = np.cumsum(change[:-1]) > 0 if high > low else np.zeros(len(raw), dtype=bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        n_bytes.append(len(raw))
        n_removed.append(int(gone.sum()))
        spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
        kept.append(raw[~gone].tobytes())
    return pa.table(
        {
            "doc_id": docs["doc_id"],
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def _numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, rid, text), rid in document order, and the bytes of all texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = F.xxhash64("text")
    ids = rows.groupBy("doc_id").agg(
        (F.min(hashed) != F.max(hashed)).alias("several"),
        F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("bytes"),
    )
    unfit = F.col("several") | F.col("doc_id").isNull() | (F.col("doc_id") < 0)
    row = ids.agg(
        F.coalesce(F.max(unfit), F.lit(False)).alias("mixed"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    ).first()
    if not row["mixed"]:
        return rows.select("doc_id", F.col("doc_id").alias("rid"), "text"), row["bytes"]
    order = [F.col("id").asc_nulls_first(), F.col("hash")]
    known = rows.select(F.col("doc_id").alias("id"), hashed.alias("hash")).distinct()
    placed = checkpointed(
        known.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("rid", F.monotonically_increasing_id())
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash"))
    return rows.join(placed, same).select("doc_id", "rid", "text"), row["bytes"]


def _prime_above(n: int) -> int:
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _sample_suffixes(bound: int):
    """Suffixes at anchors whose gram's hash, mixed anew, is at most ``bound``; one per gram and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch["text"])
            found: dict[int, bytes] = {}
            for _, gram, at, _, high in units(data, offsets):
                some = np.flatnonzero(mixed(gram ^ _SAMPLED) <= np.uint64(bound))
                for k in some[np.unique(gram[some], return_index=True)[1]]:
                    found.setdefault(int(gram[k].view(np.int64)), data[at[k] : high[k] + SPAN].tobytes())
            yield pa.RecordBatch.from_pydict(_rows(list(found), list(found.values())))

    return run


def _splitters(docs: DataFrame, ranges: int, total: int) -> list[bytes]:
    """Bounds of the ranges of the order, from about ``SAMPLE_GRAMS`` suffixes: those of all texts,
    whatever their length, chosen by hash among the distinct anchor grams.
    """
    if ranges < 2:
        return []
    # About one byte in forty is an anchor.
    share = min(1.0, SAMPLE_GRAMS / max(total / 40, 1.0))
    bound = min(int(share * 2.0**64), (1 << 64) - 1)
    sample = docs.select("text").mapInArrow(_sample_suffixes(bound), _ROWS)
    rows = sample.groupBy("key").agg(F.min("payload").alias("payload")).select("payload").toArrow()
    suffixes = sorted(set(rows["payload"].to_pylist()))
    if not suffixes:
        return []
    picks = np.linspace(0, len(suffixes), ranges + 1)[1:-1].astype(int)
    return sorted({suffixes[k] for k in picks})


def find_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) per document: the byte ranges removed, what is left."""
    rows, total = _numbered(bound_batches(docs))
    parts = _prime_above(-(-total // PART_BYTES))
    splitters = _splitters(rows, parts, total)
    grams = rows.select("rid", "text").mapInArrow(_exchange_grams(parts, parts), _ROWS)
    replies = grams.groupBy("key").applyInArrow(_resolve_grams(parts), _ROWS)
    packed = rows.select("rid", "doc_id", "text").mapInArrow(_pack_docs(parts), _ROWS)

    def by_part(payloads: DataFrame):
        """Documents and payloads of each part together."""
        sent = payloads.select((-1 - F.col("key")).alias("key"), "payload", F.lit(False).alias("docs"))
        return packed.withColumn("docs", F.lit(True)).union(sent).groupBy("key")

    runs = by_part(replies).applyInArrow(_sort_runs(parts, splitters), _ROWS)
    merged = runs.groupBy("key").applyInArrow(_merge_range(parts, parts, splitters), _ROWS)
    spans = checkpointed(merged.groupBy("key").applyInArrow(_first_windows(parts), _ROWS))
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    return by_part(spans).applyInArrow(_cut, schema)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""
    return find_repeats(docs).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
