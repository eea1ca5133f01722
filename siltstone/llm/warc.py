"""Web archives in seekable Zstandard bundles.

A WARC record is written per page. Records are gathered into frames of about ``FRAME_BYTES``, each a
Zstandard frame of its own, and frames into bundles of about ``BUNDLE_BYTES``, a file each:

    frame, frame, ..., directory, seek table

The directory is a skippable frame that maps each record's identifier to its frame and to its offset
and length within that frame, uncompressed. The seek table is the public seekable format: a skippable
frame with compressed size, size and checksum of every frame before it, read from the file's end. To
any other reader the file is plain Zstandard.

Spark writes the bundles itself, through its commit protocol and to any store that it reaches: each
bundle is one value and one file of the text writer, whose line separator is the seek table's closing
magic number.

Of records with equal payloads (by SHA-256 and length) the one with the largest page_id is the response
and the others revisit it. Rows that share that page_id are all responses; a null page_id is the
smallest. A revisit names the response with the largest url. Null html counts as empty, null url and
null page_id are left out of the record and come back as null. A page longer than a frame makes a
frame, or a bundle, of its own. Rows repeated whole are records with the same identifier. Extra columns
are not read; no rows give no records. Characters of a url that would end its line are escaped.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.joins import attach
from siltstone.runtime import checkpointed, has_rows, scratch_path

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
LEVEL = 3
NAMED_BUNDLES = 1000
# Pages carry no time of their own.
CAPTURED = "1970-01-01T00:00:00Z"

# Fixed values of the public formats.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_DIRECTORY = 0x184D2A5D
SEEKABLE_MAGIC = b"\xb1\xea\x92\x8f"
HAS_CHECKSUMS = 0x80
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_HEAD = "<II"
_FOOT = "<IB"
_ENTRY = "<III"
_PLACE = "<16sIII"

RECORD_SCHEMA = (
    "bundle string, record_id string, frame int, offset int, length int, page_id long, url string, "
    "record_type string, payload_bytes long, payload_digest string, refers_to long, refers_to_id string, "
    "payload binary"
)
INDEX_SCHEMA = "bundle string, record_id string, frame int, offset int, length int"


def base32_digest(text: Column) -> Column:
    """Upper-case base32 SHA-1 of the UTF-8 bytes, four characters per five hexadecimal digits."""
    hexadecimal = F.sha1(text)
    groups = [
        F.lpad(F.conv(F.substring(hexadecimal, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _record_id(page_id: Column, url: Column, payload_key: Column) -> Column:
    none = F.lit("")
    name = F.concat_ws("\n", F.coalesce(page_id.cast("string"), none), payload_key, F.coalesce(url, none))
    h = F.sha2(name, 256)
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 14, 3))]
    parts += [F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat_ws("-", *parts)


def plan_records(pages: DataFrame) -> DataFrame:
    """A row per page: its payload, digests, identifier, and which record it revisits."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    )
    rows = rows.select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.concat(F.sha2("payload", 256), F.lit(":"), F.octet_length("payload")).alias("payload_key"),
    )
    groups = rows.groupBy("payload_key").agg(
        F.max(F.struct("page_id", "url")).alias("kept"), F.count("*").alias("rows")
    )
    repeated = checkpointed(groups.filter("rows > 1"))
    placed = attach(rows, repeated, ["payload_key"], "rows")
    revisit = F.col("kept").isNotNull() & ~F.col("kept.page_id").eqNullSafe(F.col("page_id"))
    kept_id = _record_id(F.col("kept.page_id"), F.col("kept.url"), F.col("payload_key"))
    return placed.select(
        _record_id(F.col("page_id"), F.col("url"), F.col("payload_key")).alias("record_id"),
        "page_id",
        "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "payload_bytes",
        base32_digest(F.col("payload")).alias("payload_digest"),
        F.when(revisit, F.col("kept.page_id")).alias("refers_to"),
        F.when(revisit, F.col("kept.url")).alias("refers_to_url"),
        F.when(revisit, kept_id).alias("refers_to_id"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _escaped(url: str) -> str:
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if url else url


def _unescaped(url: str | None) -> str | None:
    return url and url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")


def record_bytes(row: dict, captured: str = CAPTURED) -> bytes:
    """One WARC record, with its closing blank lines."""
    payload = (row["payload"] or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    block = http.encode() + payload
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<urn:uuid:{row['record_id']}>"),
        ("WARC-Date", captured),
        ("WARC-Target-URI", None if row["url"] is None else _escaped(row["url"])),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("Page-ID", row["page_id"]),
    ]
    if row["record_type"] == "revisit":
        target = row["refers_to_url"]
        fields += [
            ("WARC-Profile", IDENTICAL_PAYLOAD),
            ("WARC-Refers-To", f"<urn:uuid:{row['refers_to_id']}>"),
            ("WARC-Refers-To-Target-URI", None if target is None else _escaped(target)),
            ("Refers-To-Page-ID", row["refers_to"]),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"".join((b"WARC/1.1\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n"))


def parse_record(data: bytes) -> dict:
    """The fields and the payload of one record."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    block = data[end + 4 : end + 4 + length]
    if len(block) != length or data[end + 4 + length :] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} is cut short")
    head_end = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:head_end].decode().split("\r\n")[1:])
    payload, digest = block[head_end + 4 :], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of record {fields['WARC-Record-ID']} does not match its digest")
    number = {k: int(fields[k]) if k in fields else None for k in ("Page-ID", "Refers-To-Page-ID")}
    refers = fields.get("WARC-Refers-To")
    return {
        "record_id": fields["WARC-Record-ID"][10:-1],
        "page_id": number["Page-ID"],
        "url": _unescaped(fields.get("WARC-Target-URI")),
        "record_type": fields["WARC-Type"],
        "payload_bytes": int(http["Content-Length"]),
        "payload_digest": digest,
        "refers_to": number["Refers-To-Page-ID"],
        "refers_to_id": refers and refers[10:-1],
        "payload": None if revisit else payload,
    }


class Bundle:
    """Collects records; ``close`` gives the file without its last four bytes, the magic number."""

    def __init__(self) -> None:
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[bytes] = []
        self.table: list[bytes] = []
        self.directory: list[bytes] = []
        self.open: list[bytes] = []
        self.open_bytes = self.total = 0

    def add(self, record_id: str, record: bytes) -> None:
        if self.open and self.open_bytes + len(record) > FRAME_BYTES:
            self._end_frame()
        place = (len(self.frames), self.open_bytes, len(record))
        self.directory.append(struct.pack(_PLACE, uuid.UUID(record_id).bytes, *place))
        self.open.append(record)
        self.open_bytes += len(record)
        self.total += len(record)

    def _end_frame(self) -> None:
        data = b"".join(self.open)
        self._append(self.compressor.compress(data), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF)
        self.open, self.open_bytes = [], 0

    def _append(self, frame: bytes, size: int, checksum: int) -> None:
        self.frames.append(frame)
        self.table.append(struct.pack(_ENTRY, len(frame), size, checksum))

    def close(self) -> bytes:
        if self.open:
            self._end_frame()
        directory = b"".join(self.directory)
        self._append(struct.pack(_HEAD, SKIPPABLE_DIRECTORY, len(directory)) + directory, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        table = b"".join(self.table) + struct.pack(_FOOT, len(self.table), HAS_CHECKSUMS)
        head = struct.pack(_HEAD, SKIPPABLE_SEEK_TABLE, len(table) + len(SEEKABLE_MAGIC))
        return b"".join((*self.frames, head, table))


class Opened:
    """A bundle's bytes, its frames found through the seek table."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        if content[-4:] != SEEKABLE_MAGIC:
            raise ValueError("not a seekable bundle: the seek table is missing")
        n, flags = struct.unpack(_FOOT, self.content[-9:-4])
        if flags != HAS_CHECKSUMS:
            raise ValueError("not a seekable bundle with checksums")
        table = self.content[len(content) - 9 - n * struct.calcsize(_ENTRY) : len(content) - 9]
        self.sizes = list(struct.iter_unpack(_ENTRY, table))
        self.starts = [0]
        for packed, _, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        if self.starts[-1] + struct.calcsize(_HEAD) + len(table) + 9 != len(content):
            raise ValueError("the seek table does not add up to the bundle's length")
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        _, size, checksum = self.sizes[k]
        data = self.decompressor.decompress(self.content[self.starts[k] : self.starts[k + 1]], max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} does not match its checksum")
        return data

    def directory(self) -> Iterator[tuple[str, int, int, int]]:
        """(record_id, frame, offset, length) of every record, in order; no frame is decompressed."""
        place = self.content[self.starts[-2] : self.starts[-1]]
        if struct.unpack(_HEAD, place[: struct.calcsize(_HEAD)]) != (SKIPPABLE_DIRECTORY, len(place) - struct.calcsize(_HEAD)):
            raise ValueError("the bundle has no directory")
        for name, frame, offset, length in struct.iter_unpack(_PLACE, place[struct.calcsize(_HEAD) :]):
            yield str(uuid.UUID(bytes=name)), frame, offset, length


def write_bundles(records: DataFrame, path: str) -> None:
    """Write the records of ``plan_records`` as bundles under ``path``, replacing what is there."""

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    bundle.add(row["record_id"], record_bytes(row))
                    if bundle.total >= BUNDLE_BYTES:
                        yield pa.record_batch({"bundle": pa.array([bundle.close()], pa.binary())})
                        bundle = Bundle()
        if bundle.total:
            yield pa.record_batch({"bundle": pa.array([bundle.close()], pa.binary())})

    files = records.mapInArrow(bundled, "bundle binary").select(F.col("bundle").cast("string").alias("value"))
    options = {"maxRecordsPerFile": 1, "encoding": "ISO-8859-1", "lineSep": SEEKABLE_MAGIC.decode("latin-1")}
    files.write.mode("overwrite").options(**options).text(path)


def _bundles(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").load(paths)
    # A write without rows leaves one empty file.
    return files.filter("length > 0").select(F.col("path").alias("bundle"), "content")


def _table(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(bundle, record_id, frame, offset, length) from the directories; no frame is decompressed."""
    schema = _arrow(INDEX_SCHEMA)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, content in zip(batch["bundle"], batch["content"], strict=True):
                places = [(bundle.as_py(), *place) for place in Opened(content.as_py()).directory()]
                columns = zip(*places, strict=True) if places else ([] for _ in schema)
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return _bundles(spark, path).mapInArrow(listed, INDEX_SCHEMA)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of all bundles, with their places. Frames are checked and payloads held against
    their digests; a frame is decompressed at a time.
    """
    schema = _arrow(RECORD_SCHEMA)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, content in zip(batch["bundle"], batch["content"], strict=True):
                opened, name = Opened(content.as_py()), bundle.as_py()
                at, data, rows = -1, b"", []
                for record_id, frame, offset, length in opened.directory():
                    if frame != at:
                        if rows:
                            yield _table(rows, schema)
                        at, data, rows = frame, opened.frame(frame), []
                    record = parse_record(data[offset : offset + length])
                    if record["record_id"] != record_id:
                        raise ValueError(f"the directory names {record_id} where {record['record_id']} stands")
                    if not with_payload:
                        record["payload"] = None
                    rows.append({**record, "bundle": name, "frame": frame, "offset": offset, "length": length})
                if rows:
                    yield _table(rows, schema)

    return _bundles(spark, path).mapInArrow(parsed, RECORD_SCHEMA)


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records whose ``record_id`` is in ``wanted``; only frames that hold one are decompressed.

    A revisit comes with the payload of the response that it names.
    """
    columns = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    index = read_index(spark, path)
    ids = wanted.select(F.col("record_id").cast("string").alias("record_id")).filter("record_id IS NOT NULL")
    found = checkpointed(_at_places(spark, path, index.join(ids.distinct(), "record_id")))
    revisits = found.filter("record_type = 'revisit'").groupBy("refers_to_id").agg(F.count("*").alias("rows"))
    if not has_rows(revisits):
        return found
    named = index.join(revisits.select(F.col("refers_to_id").alias("record_id")), "record_id")
    # Rows repeated whole are records with one identifier and one payload.
    kept = _at_places(spark, path, named).groupBy(F.col("record_id").alias("refers_to_id"))
    payloads = checkpointed(kept.agg(F.max("payload").alias("kept")).join(revisits, "refers_to_id"))
    joined = attach(found, payloads, ["refers_to_id"], "rows")
    return joined.withColumn("payload", F.coalesce("payload", "kept")).select(*columns)


def _at_places(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """The records at the places. Few bundles are opened by name; of many, all under ``path`` are read."""
    schema = _arrow(RECORD_SCHEMA)
    places = checkpointed(places.select("bundle", "record_id", "frame", "offset", "length"))
    touched = [r["bundle"] for r in places.select("bundle").distinct().limit(NAMED_BUNDLES + 1).collect()]
    if not touched:
        return spark.createDataFrame([], RECORD_SCHEMA)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            opened, at, data = Opened(right["content"][0].as_py()), -1, b""
            for place in left.sort_by([("frame", "ascending"), ("offset", "ascending")]).to_pylist():
                if place["frame"] != at:
                    at, data = place["frame"], opened.frame(place["frame"])
                record = parse_record(data[place["offset"] : place["offset"] + place["length"]])
                rows.append({**record, **place})
        return pa.Table.from_pylist(rows, schema)

    # Places of one bundle are at most its records, so a group is bounded by a bundle.
    bundles = _bundles(spark, touched if len(touched) <= NAMED_BUNDLES else path)
    return places.groupBy("bundle").cogroup(bundles.groupBy("bundle")).applyInArrow(cut, RECORD_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as bundles under the shared folder, read them back, and say what each record is."""
    spark = pages.sparkSession
    path = scratch_path(spark, "bundles")
    write_bundles(plan_records(pages), path)
    return read_records(spark, path, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
