"""Layers in versions: a write makes a new folder, and a small manifest says which one counts.

    layer/_versions/00000002.json     {"folder": "v00000002-5c1f…", "rows": …, "files": …, "bytes": …, "notes": {…}}
    layer/v00000002-5c1f…/            the data, as Spark writes it

A write that fails, late or early, leaves the manifest and so the layer as it was. The switch is the
creation of one small file that must not be there yet: of two writes at once the second fails and
changes nothing. No data is renamed or copied, so it holds on object stores too. The version before
the newest stays for readers that still use it; older ones, what failed writes left, and files of a
layer that had no versions go with the next successful write.

A folder without ``_versions`` is a layer that other tools wrote, and is read as it is.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

KEPT = 2
_LOG = "_versions"
_MANIFEST = re.compile(r"(\d{8})\.json")
_FOLDER = re.compile(r"v(\d{8})-[0-9a-f]+")


class ConcurrentWriteError(RuntimeError):
    """Another write of the same layer was published first."""


@dataclass(frozen=True)
class Version:
    """What a manifest says; ``rows`` is None where they were not counted.

    ``notes`` is what the writer measured on the way, of bounded size: the leaves with most rows,
    fingerprints.
    """

    number: int
    folder: str
    rows: int | None
    files: int
    bytes: int
    notes: dict = field(default_factory=dict)


class _Store:
    """The file system of a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self.jvm = context._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.root.getFileSystem(context._jsc.hadoopConfiguration())

    def at(self, *names: str):
        path = self.root
        for name in names:
            path = self.jvm.org.apache.hadoop.fs.Path(path, name)
        return path

    def is_folder(self) -> bool:
        return self.files.exists(self.root) and self.files.getFileStatus(self.root).isDirectory()

    def names(self, *under: str) -> list[str]:
        path = self.at(*under)
        return [s.getPath().getName() for s in self.files.listStatus(path)] if self.files.exists(path) else []

    def text(self, *names: str) -> str:
        stream = self.files.open(self.at(*names))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, text: str, *names: str) -> None:
        """A new file; raises if there is one."""
        stream = self.files.create(self.at(*names), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def remove(self, *names: str) -> None:
        self.files.delete(self.at(*names), True)


def _published(store: _Store) -> list[Version]:
    """Versions by number. A manifest that is not whole was never published."""
    found = []
    for name in sorted(store.names(_LOG)):
        match = _MANIFEST.fullmatch(name)
        if match:
            try:
                found.append(Version(int(match[1]), **json.loads(store.text(_LOG, name))))
            except (ValueError, TypeError):
                continue
    return found


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The versions of the layer that are still there, oldest first."""
    store = _Store(spark, path)
    return _published(store) if store.is_folder() else []


def current(spark: SparkSession, path: str) -> str | None:
    """The folder (or file) to read the layer from, or None if there is no finished one."""
    store = _Store(spark, path)
    if not store.is_folder():
        return path if store.files.exists(store.root) else None
    if _LOG not in store.names():
        return path
    published = _published(store)
    return f"{path.rstrip('/')}/{published[-1].folder}" if published else None


def readable(spark: SparkSession, path: str) -> str:
    """Like ``current``; where nothing is, the path itself, so that reading it says so."""
    return current(spark, path) or path


def newest(spark: SparkSession, path: str) -> Version | None:
    """The version that readers go by, or None for a layer without versions."""
    found = versions(spark, path)
    return found[-1] if found else None


def replace(
    spark: SparkSession,
    path: str,
    write: Callable[[str], int | None],
    notes: Callable[[], dict] | None = None,
) -> None:
    """Let ``write`` fill a new folder and return its rows, if it knows; then make it the layer.

    ``notes`` is asked after the write for what the manifest shall hold besides.
    """
    store = _Store(spark, path)
    store.files.mkdirs(store.at(_LOG))
    number = _next(store)
    folder = f"v{number:08d}-{uuid.uuid4().hex[:12]}"
    rows = write(f"{path.rstrip('/')}/{folder}")
    _publish(store, number, folder, rows, notes() if notes else {})


def amend(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` change the newest version in place, and note that as a version of its own."""
    store = _Store(spark, path)
    folder, number = _published(store)[-1].folder, _next(store)
    write(f"{path.rstrip('/')}/{folder}")
    _publish(store, number, folder, None, {})


def _next(store: _Store) -> int:
    taken = [int(m[1]) for m in map(_MANIFEST.fullmatch, store.names(_LOG)) if m]
    return max(taken, default=0) + 1


def _publish(store: _Store, number: int, folder: str, rows: int | None, notes: dict) -> None:
    size = store.files.getContentSummary(store.at(folder))
    counts = {"folder": folder, "rows": rows, "files": size.getFileCount(), "bytes": size.getLength()}
    manifest = counts | {"notes": notes}
    name = f"{number:08d}.json"
    if name in store.names(_LOG):
        raise ConcurrentWriteError(f"version {number} of {store.root.toString()} was written meanwhile")
    store.create(json.dumps(manifest), _LOG, name)
    published = _published(store)
    kept = published[-KEPT:]
    for version in published[:-KEPT]:
        store.remove(_LOG, f"{version.number:08d}.json")
    folders = {v.folder for v in kept}
    for name in store.names():
        match = _FOLDER.fullmatch(name)
        # A folder with a higher number is another write that still goes on.
        if name != _LOG and name not in folders and not (match and int(match[1]) > number):
            store.remove(name)
