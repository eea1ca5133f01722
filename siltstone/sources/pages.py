"""Paged responses, landed as rows ``(page, status, body)``, turned into records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F

from siltstone.runtime import checkpointed
from siltstone.sources.records import STRICT_JSON

# Numbering starts at 1, and this status means success.
FIRST_PAGE = 1
STATUS_OK = 200

# A body without records ends the set: an empty array, an empty object or null.
_NO_RECORDS = r"^\s*(\[\s*\]|\{\s*\}|null)\s*\z"

# Here a text that does not parse is null, and judged with the set it belongs to.
_LENIENT_JSON = STRICT_JSON | {"mode": "PERMISSIVE"}

_NOT_RECORDS = " does not hold an array of records"

# Pages per block of the running total. One block is one window group.
_BLOCK = 65536


class IncompleteIngestError(RuntimeError):
    """The landed responses do not form a whole set of pages."""


def has_no_records(body: Column) -> Column:
    """Whether a response body ends the set of pages."""
    return F.coalesce(body.rlike(_NO_RECORDS), F.lit(False))


def _marks() -> list[Column]:
    """Aggregates that say where a set of pages ends and whether it may."""
    ok = F.coalesce(F.col("status") == STATUS_OK, F.lit(False))
    return [
        F.min(F.when(ok & has_no_records(F.col("body")), F.col("page"))).alias("end"),
        F.min(F.when(~ok, F.struct("page", "status"))).alias("failed"),
        F.count_if(F.col("page").isNull()).alias("unnumbered"),
    ]


def _pages_to(end: int | None, failed: Row | None, unnumbered: int, responses: DataFrame) -> DataFrame:
    """The pages before the end; raises if they are no whole set. Reads the page column only."""
    if unnumbered:
        raise IncompleteIngestError(f"{unnumbered} responses without a page number")
    if failed is not None and (end is None or failed["page"] < end):
        raise IncompleteIngestError(f"page {failed['page']} came back with {failed['status']}")
    if end is None:
        raise IncompleteIngestError("no empty page ends the set")

    pages = responses.filter(F.col("page") < end)
    seen = pages.agg(
        F.count("*").alias("rows"),
        F.countDistinct("page").alias("distinct_pages"),
        F.min("page").alias("first"),
    ).first()
    expected = end - FIRST_PAGE
    if seen["rows"] != expected or seen["distinct_pages"] != expected:
        raise IncompleteIngestError(
            f"{expected} pages expected before page {end}, "
            f"found {seen['rows']} rows for {seen['distinct_pages']} pages"
        )
    if expected and seen["first"] != FIRST_PAGE:
        raise IncompleteIngestError(f"numbering starts at {seen['first']}")
    return pages


def pages_before_end(responses: DataFrame) -> DataFrame:
    """The pages that carry records: all before the first empty one, there once and fetched whole.

    Raises ``IncompleteIngestError`` if a page up to the end failed, is missing or is there twice,
    or if no page ends the set. Later pages are ignored, whatever they hold. Bodies are only
    matched against the pattern of an empty one here; what reads the records parses them.
    """
    marks = responses.agg(*_marks()).first()
    return _pages_to(marks["end"], marks["failed"], marks["unnumbered"], responses)


def _parsed(body: Column, options: dict[str, str]) -> Column:
    """The records of a body as JSON texts. The brackets make the whole text one value, so that
    nothing may stand behind the array.
    """
    return F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<array<string>>", options)


def _is_whole(parsed: Column) -> Column:
    """Whether a body was one array, and each of its elements an object."""
    objects = F.forall(parsed[0], lambda item: F.coalesce(item.startswith("{"), F.lit(False)))
    return F.coalesce((F.size(parsed) == 1) & objects, F.lit(False))


def explode_records(pages: DataFrame) -> DataFrame:
    """One row per record, ``(page, pos, record)``, the record as its own JSON text.

    The text keeps every key, null and nested value. A body that is not one array of objects, to
    its last character, fails the query. Ingest order is ``(page, pos)``; nothing is sorted until
    someone asks.
    """
    parsed = pages.select("page", _parsed(F.col("body"), STRICT_JSON).alias("parsed"))
    broken = F.raise_error(
        F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(_NOT_RECORDS))
    ).cast("array<string>")
    records = F.when(_is_whole(F.col("parsed")), F.col("parsed")[0]).otherwise(broken)
    return parsed.select("page", F.posexplode(records).alias("pos", "record"))


def ingest(responses: DataFrame) -> DataFrame:
    """Checked responses to records, set down on shared storage.

    Bodies are read and parsed once: the records of all pages are set down, and what the checks need
    to know is measured on the way. Only then the set is judged; one that is not whole, or a page
    in it that does not hold records, raises ``IncompleteIngestError`` before anything is written
    elsewhere. Records behind the end, whose pages may hold anything, are set down but not returned.
    """
    marks = Observation()
    parsed = responses.select("page", "status", "body", _parsed(F.col("body"), _LENIENT_JSON).alias("parsed"))
    judged = parsed.withColumn("whole", _is_whole(F.col("parsed")))
    # A page before the end that is not whole is a fault; at and behind the end it does not matter.
    bad = F.min(F.when(~F.col("whole"), F.col("page"))).alias("bad")
    counted = judged.observe(marks, *_marks(), bad).filter("whole")
    records = checkpointed(counted.select("page", F.posexplode(F.col("parsed")[0]).alias("pos", "record")))
    found = marks.get
    _pages_to(found["end"], found["failed"], found["unnumbered"], responses)
    if found["bad"] is not None and found["bad"] < found["end"]:
        raise IncompleteIngestError(f"page {found['bad']}{_NOT_RECORDS}")
    return records.filter(F.col("page") < found["end"])


def page_progress(pages: DataFrame) -> DataFrame:
    """Records per page and records so far, ``(page, n, running_total)``.

    A page counts the records that the ingest takes from it; one that it would reject fails the
    query.
    """
    return running_totals(explode_records(pages))


def running_totals(records: DataFrame) -> DataFrame:
    """``page_progress`` from records that have their ``page``.

    A single ordered window would send every page to one task. Pages are summed in blocks first:
    only the block totals (one row per 65,536 pages) pass through an unpartitioned window. The
    counts, two numbers per page, are set down first, so that records are read once.
    """
    counts = checkpointed(records.groupBy("page").agg(F.count("*").alias("n")))
    counted = counts.withColumn("block", F.floor(F.col("page") / _BLOCK))
    so_far = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.groupBy("block")
        .agg(F.sum("n").alias("block_total"))
        .select("block", F.coalesce(F.sum("block_total").over(so_far), F.lit(0)).alias("before"))
    )
    in_block = (
        Window.partitionBy("block")
        .orderBy("page")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return counted.join(offsets, "block").select(
        "page", "n", (F.col("before") + F.sum("n").over(in_block)).alias("running_total")
    )
