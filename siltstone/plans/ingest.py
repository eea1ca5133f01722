"""Landed responses to the raw layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltstone.plans.status import WRITTEN, LayerStatus
from siltstone.sinks.bronze import land_array_documents, land_record_text
from siltstone.sources.pages import ingest, running_totals
from siltstone.spec import LayerSpec


def ingest_bronze(
    responses: DataFrame,
    bronze_path: str,
    arrays: bool = False,
    progress_path: str | None = None,
    spec: LayerSpec | None = None,
) -> LayerStatus:
    """Check and parse the responses, then replace the raw layer. A failure at any point leaves it untouched.

    The raw layer holds a record per line, or with ``arrays`` array documents. Under
    ``progress_path`` goes a table of the records per page and the records so far. With a ``spec`` the
    manifest gets what the later jobs balance and check their writes by (see ``land_record_text``).
    """
    records = ingest(responses)
    if progress_path is not None:
        running_totals(records).write.mode("overwrite").parquet(progress_path)
    (land_array_documents if arrays else land_record_text)(records, bronze_path, spec)
    return LayerStatus("bronze", WRITTEN, records.count())
