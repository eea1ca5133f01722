"""Landing responses ``(page, status, body)`` as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

# A reader holds a batch of rows at once, at most a row group. A body is a whole page of records,
# so groups are short; by default a batch would hold thousands of bodies.
_ROWS_PER_GROUP = 256


def write_responses(responses: DataFrame, path: str, append: bool = False) -> None:
    """Write responses so that a task reading them holds few bodies at a time."""
    (
        responses.write.mode("append" if append else "overwrite")
        .option("parquet.block.row.count.limit", _ROWS_PER_GROUP)
        .parquet(path)
    )
