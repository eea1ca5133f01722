"""Landing raw records. All writers replace what was there, once all of it is written."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltstone.operators.cleaning import clean, with_clean_keys
from siltstone.operators.fingerprint import fingerprint, row_hashes
from siltstone.operators.heavy import leaf_sketch, named_leaves
from siltstone.runtime import byte_size
from siltstone.spec import LayerSpec
from siltstone.versions import replace

# Without these, null keys vanish and times lose their microseconds.
_LOSSLESS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

# Record lines repeat their keys, so even the fastest level takes most of them. A compressed file is read by
# one task; it is cut after so many records, and holds no more than the task that wrote it had.
_RECORDS_PER_FILE = 1 << 17
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(_RECORDS_PER_FILE)}


def _cleaned(records: DataFrame, spec: LayerSpec) -> DataFrame:
    """Records beside hashes of their clean form and their leaf; text that does not parse is blank here."""
    options = {"maxStringLen": str(2**31 - 1)}
    read = records.select("record", F.from_json("record", spec.bronze_schema, options).alias("r"))
    flat = read.select("record", *[F.col("r")[c].alias(c) for c in spec.columns])
    cleaned = with_clean_keys(clean(flat, spec, keep=("record",)), spec)
    return cleaned.withColumns(row_hashes(spec.columns, "row"))


def _measures(spec: LayerSpec | None) -> list[Column]:
    if spec is None:
        return []
    sketch = leaf_sketch([F.col(k) for k in spec.clean_keys])
    return [sketch.alias("leaves"), fingerprint("row").alias("rows_print")]


def _notes(measured: dict, spec: LayerSpec | None) -> dict:
    if spec is None:
        return {}
    leaves = {"leaf_keys": list(spec.clean_keys), "leaves": named_leaves(measured["leaves"])}
    return leaves | {"rows_print": list(measured["rows_print"])}


def land_record_text(records: DataFrame, path: str, spec: LayerSpec | None = None) -> None:
    """Write JSON text (column ``record``) as it is, one record per line, in compressed files of bounded length.

    With a ``spec`` the manifest gets the leaves that will hold most rows and a fingerprint of the
    rows as they will be cleaned, both taken in the same pass.
    """
    rows = Observation()
    wide = records.select("record") if spec is None else _cleaned(records, spec)
    counted = wide.observe(rows, F.count(F.lit(1)).alias("n"), *_measures(spec)).select("record")

    def whole(folder: str) -> int:
        counted.write.options(**_PACKED).text(folder)
        return rows.get["n"]

    replace(records.sparkSession, path, whole, lambda: _notes(rows.get, spec))


def land_frame(df: DataFrame, path: str) -> None:
    """Write a frame as one JSON record per line, nulls included."""
    replace(df.sparkSession, path, df.write.options(**_LOSSLESS).json)


def land_array_documents(records: DataFrame, path: str, spec: LayerSpec | None = None) -> None:
    """Write JSON text (column ``record``) as array documents over many lines.

    For readers that need an array. Records are measured and dealt out first, so that a document is
    about the advisory partition size, whatever the partitions were; a reader holds one whole.
    Lines (``land_record_text``) are the better layout: many files, read line by line. ``spec``: as there,
    taken where the records are measured.
    """
    spark = records.sparkSession
    wide = records if spec is None else _cleaned(records, spec)
    total = F.sum(F.octet_length("record") + 6).alias("n")
    measured = wide.agg(total, F.count("*").alias("n_rows"), *_measures(spec)).first().asDict()
    size = measured["n"] or 0
    documents = max(1, -(-size // byte_size(spark.conf.get(_ADVISORY))))

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines(prefix: str, texts: pa.Array) -> pa.RecordBatch:
            joined = pc.binary_join_element_wise(prefix, texts.cast(pa.string()), "")
            return pa.RecordBatch.from_arrays([joined], ["value"])

        yield lines("", pa.array(["["]))
        prefix = "    "
        for batch in batches:
            texts = batch.column(0)
            if len(texts):
                yield lines(prefix, texts[:1])
                prefix = "    ,"
                yield lines(prefix, texts[1:])
        yield lines("", pa.array(["]"]))

    dealt = records.select("record").repartition(documents)
    lines_of = dealt.mapInArrow(bracketed, "value string")

    def whole(folder: str) -> int:
        lines_of.write.text(folder)
        return measured["n_rows"]

    replace(spark, path, whole, lambda: _notes(measured, spec))
