"""Checks on layers, and the gate that stops a write when a check fails."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.functions.numeric import lenient_double
from siltstone.runtime import checkpointed, has_rows
from siltstone.sources.layers import list_leaves, read_silver
from siltstone.spec import LayerSpec

_HASH, _SLOT, _FILTER_SLOT, _WORD = "row_hash", "row_hash_slot", "row_hash_filter", "row_hash_word"
# Bits of the filter over suspect hashes: so many a suspect, between these bounds; the upper one is two
# million words of 64, and holds the broadcast to some tens of MB.
_BITS_PER_SUSPECT = 16
_FILTER_BITS = (1 << 20, 1 << 27)

# Subjects that a gate names per check; the others are counted and summed.
WORST = 100
_SALTS = 64

REPORT_SCHEMA = "check_name string, subject string, bad_rows bigint, passed boolean"


class MissingColumnsError(ValueError):
    """Columns that a layer must have are absent."""


class QualityGateError(RuntimeError):
    """At least one check failed; ``report`` holds the failing rows of the report."""

    def __init__(self, report: Sequence[Row]) -> None:
        self.report = list(report)
        lines = [f"{r['check_name']} on {r['subject']}: {r['bad_rows']}" for r in self.report]
        super().__init__("quality gate failed: " + "; ".join(lines))


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in expected if c not in df.columns]


def require_columns(df: DataFrame, expected: Sequence[str]) -> None:
    missing = missing_columns(df, expected)
    if missing:
        raise MissingColumnsError(f"columns not found: {', '.join(missing)}")


def _rows_of(single: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn a one-row frame of measures into one row per subject."""
    return single.select(F.inline(F.array(*rows)))


def null_and_blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and empty texts per column, in one pass."""
    measures = []
    rows = []
    for i, c in enumerate(columns):
        measures.append(F.count_if(F.col(c).isNull()).alias(f"null_{i}"))
        measures.append(F.count_if(F.col(c).cast("string") == "").alias(f"blank_{i}"))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"null_{i}").alias("null_count"),
                F.col(f"blank_{i}").alias("blank_count"),
            )
        )
    return _rows_of(df.agg(*measures), rows)


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole rows that occur more than once, with how often. One plan for every size.

    Row hashes are counted first, so that the shuffle carries a number per row instead of the row.
    Rows whose hash is not in a bit filter of those seen twice then drop before any shuffle. The filter
    is sized by the number of suspects and bounded, so it may be broadcast; of a hundred other rows it
    lets about six pass, more only above eight million suspects. Of the rest, those whose hash was seen
    twice are compared whole.
    """
    hashed = df.withColumn(_HASH, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    suspects = checkpointed(duplicates(hashed, [_HASH]).select(_HASH))
    bits, wanted = _FILTER_BITS[0], suspects.count() * _BITS_PER_SUSPECT
    while bits < min(wanted, _FILTER_BITS[1]):
        bits *= 2
    bit = F.col(_HASH).bitwiseAND(bits - 1)
    slot, own = F.shiftright(bit, 6).alias(_SLOT), F.expr(f"shiftleft(1L, cast({_HASH} & 63 as int))")
    words = suspects.groupBy(slot).agg(F.bit_or(own).alias(_WORD)).withColumnRenamed(_SLOT, _FILTER_SLOT)
    # Both joins only let rows through, or the optimiser would put the one that shuffles first.
    passes = (F.col(_SLOT) == F.col(_FILTER_SLOT)) & (F.col(_WORD).bitwiseAND(own) != 0)
    likely = hashed.select("*", slot).join(F.broadcast(words), passes, "left_semi")
    whole = likely.join(suspects, _HASH, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    return duplicates(whole, whole.columns)


def _converts(column: str, kind: str) -> Column:
    """Doubles by the rule of the cleaning, other types by Spark's cast."""
    value = F.col(column)
    return lenient_double(value.cast("string")) if kind == "double" else value.try_cast(kind)


def type_violations(df: DataFrame, types: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per column and type, the values that are there but do not convert, in one pass.

    For ``double`` that is what the lenient cleaning makes null.
    """
    checks = [(c, t) for c, candidates in types.items() for t in candidates]
    measures = [
        F.count_if(F.col(c).isNotNull() & _converts(c, t).isNull()).alias(f"bad_{i}")
        for i, (c, t) in enumerate(checks)
    ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(t).alias("type_name"),
            F.col(f"bad_{i}").alias("bad_rows"),
        )
        for i, (c, t) in enumerate(checks)
    ]
    return _rows_of(df.agg(*measures), rows)


def totals(bronze: DataFrame, silver: DataFrame, gold: DataFrame, spec: LayerSpec) -> DataFrame:
    """Rows that each layer accounts for, and whether all agree: one row."""
    layers = {
        "bronze": bronze.agg(F.count("*").alias("n")),
        "silver": silver.agg(F.count("*").alias("n")),
        "gold": gold.agg(F.coalesce(F.sum(spec.count_name), F.lit(0)).alias("n")),
    }
    counted = [one.select(F.lit(name).alias("layer"), "n") for name, one in layers.items()]
    tall = counted[0].unionAll(counted[1]).unionAll(counted[2])
    per_layer = [
        F.max(F.when(F.col("layer") == name, F.col("n"))).alias(f"{name}_rows") for name in layers
    ]
    return tall.agg(*per_layer, (F.min("n") == F.max("n")).alias("consistent"))


def date_range(df: DataFrame, column: str, earliest: Column, latest: Column) -> DataFrame:
    """First and last value of a date or time column, and the rows outside the bounds."""
    value = F.col(column)
    return df.agg(
        F.min(value).alias("first_value"),
        F.max(value).alias("last_value"),
        F.count_if(~value.between(earliest, latest)).alias("out_of_range"),
    )


def non_empty(df: DataFrame, subject: str) -> DataFrame:
    """Whether there is any row; stops at the first."""
    row = (subject, has_rows(df))
    return df.sparkSession.createDataFrame([row], "subject string, non_empty boolean")


def layout(spark: SparkSession, path: str, spec: LayerSpec) -> DataFrame:
    """Per first-level key: its leaves, their rows, the smallest, and whether all hold rows.

    Leaves come from the listing of files, so one whose files hold no row shows.
    """
    outer, inner = spec.clean_keys
    counted = read_silver(spark, path, spec).groupBy(outer, inner).agg(F.count("*").alias("n"))
    leaves = list_leaves(spark, path, spec).join(counted, [outer, inner], "left")
    leaves = leaves.withColumn("leaf_rows", F.coalesce("n", F.lit(0)))
    return leaves.groupBy(outer).agg(
        F.count("*").alias("leaves"),
        F.sum("leaf_rows").alias("n_rows"),
        F.min("leaf_rows").alias("smallest_leaf"),
        (F.min("leaf_rows") > 0).alias("ok"),
    )


def _report(df: DataFrame, check: str, subject: Column, bad: Column, allowed: int) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"),
        subject.alias("subject"),
        bad.cast("bigint").alias("bad_rows"),
        (bad <= allowed).alias("passed"),
    )


def report_missing(
    df: DataFrame,
    columns: Sequence[str],
    allowed_nulls: int = 0,
    allowed_blanks: int | None = None,
) -> DataFrame:
    """Nulls per column; blanks too, if a bound for them is given. One pass for both."""
    counts = null_and_blank_counts(df, columns)
    checks = [("null_keys", "null_count", allowed_nulls)]
    if allowed_blanks is not None:
        checks.append(("blank_keys", "blank_count", allowed_blanks))
    rows = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.col("column_name").alias("subject"),
            F.col(measure).alias("bad_rows"),
            (F.col(measure) <= allowed).alias("passed"),
        )
        for check, measure, allowed in checks
    ]
    return counts.select(F.inline(F.array(*rows)))


def report_duplicates(df: DataFrame, columns: Sequence[str], allowed: int = 0) -> DataFrame:
    """Rows beyond the first of each key."""
    extra = duplicates(df, columns).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"))
    return _report(extra, "duplicates", F.lit(",".join(columns)), F.col("extra"), allowed)


def report_types(
    df: DataFrame,
    types: Mapping[str, Sequence[str]],
    allowed: int = 0,
) -> DataFrame:
    counts = type_violations(df, types)
    subject = F.concat_ws(":", "column_name", "type_name")
    return _report(counts, "types", subject, F.col("bad_rows"), allowed)


def report_date_range(
    df: DataFrame,
    column: str,
    earliest: Column,
    latest: Column,
    allowed: int = 0,
) -> DataFrame:
    measured = date_range(df, column, earliest, latest)
    return _report(measured, "date_range", F.lit(column), F.col("out_of_range"), allowed)


def _worst(report: DataFrame, k: int) -> DataFrame:
    """At most k + 1 rows per check: its worst subjects, and the sum of all others.

    Worked out per salt first, so that no task gets all subjects of a check.
    """
    rows = report.groupBy("check_name", "subject").agg(
        F.sum("bad_rows").alias("bad_rows"), F.bool_and("passed").alias("passed")
    )
    rows = rows.withColumns({"others": F.lit(0).cast("bigint"), "salt": F.pmod(F.xxhash64("subject"), F.lit(_SALTS))})
    for keys in (["check_name", "salt"], ["check_name"]):
        order = Window.partitionBy(*keys).orderBy(F.col("others") > 0, "passed", F.desc("bad_rows"), "subject")
        named = (F.row_number().over(order) <= k) & (F.col("others") == 0)
        rows = rows.withColumn("named", named).groupBy(
            *keys, "named", F.when(F.col("named"), F.col("subject")).alias("subject")
        ).agg(
            F.sum("bad_rows").alias("bad_rows"),
            F.bool_and("passed").alias("passed"),
            F.sum(F.when(F.col("named"), F.lit(0)).otherwise(F.greatest("others", F.lit(1)))).alias("others"),
        )
    subject = F.when(F.col("others") > 0, F.concat("others", F.lit(" more"))).otherwise(F.col("subject"))
    rows = rows.orderBy("check_name", F.col("others") > 0, "passed", F.desc("bad_rows"), "subject")
    return rows.select("check_name", subject.alias("subject"), "bad_rows", "passed")


def gate(*reports: DataFrame, worst: int = WORST) -> DataFrame:
    """Run the reports and return them as one frame, or raise with those that failed.

    A report should have one row per check and subject; it is summed to that. Of each check the
    ``worst`` subjects come to the driver, failed ones first, by bad rows; the others as one row
    with their number and their sum. So a report with a subject per data row does no harm.
    """
    rows = [row for report in reports for row in _worst(report, worst).collect()]
    failed = [row for row in rows if not row["passed"]]
    if failed:
        raise QualityGateError(failed)
    return reports[0].sparkSession.createDataFrame(rows, REPORT_SCHEMA)
