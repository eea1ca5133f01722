"""Clean layer to aggregated layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.aggregates import count_by_location
from siltstone.operators.fingerprint import fingerprint_of
from siltstone.operators.ordering import sorted_by_keys
from siltstone.operators.quality import REPORT_SCHEMA, gate, report_missing
from siltstone.plans.incremental import leaf_parts, sum_of_parts, write_parts
from siltstone.plans.status import SKIPPED, WRITTEN, LayerStatus
from siltstone.runtime import checkpointed
from siltstone.sinks.layers import write_gold
from siltstone.sources.layers import read_silver_or_none
from siltstone.spec import LayerSpec
from siltstone.versions import newest

Check = Callable[[DataFrame], DataFrame]


def _totals_report(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    spread = max(counts.values()) - min(counts.values())
    row = ("totals", "=".join(counts), spread, spread == 0)
    return spark.createDataFrame([row], REPORT_SCHEMA)


def _print_reports(spark: SparkSession, silver_path: str, gold: DataFrame, spec: LayerSpec) -> list[DataFrame]:
    """Whether the clean layer holds the rows that landed and the aggregate those of the clean layer.

    Equal totals do not see one row lost and another doubled; the manifests' fingerprints do. What a
    manifest does not hold is not checked.
    """
    version = newest(spark, silver_path)
    notes = version.notes if version else {}
    rows = []
    if "source_print" in notes:
        same = notes["source_print"] == notes["rows_print"]
        rows.append(("fingerprint", "bronze=silver", int(not same), same))
    if "keys_print" in notes:
        same = notes["keys_print"] == fingerprint_of(gold, spec.group_by, F.col(spec.count_name))
        rows.append(("fingerprint", "silver=gold", int(not same), same))
    return [spark.createDataFrame(rows, REPORT_SCHEMA)] if rows else []


def _number_reports(spark: SparkSession, found: int | None, allowed: int | None) -> list[DataFrame]:
    if allowed is None:
        return []
    if found is None:
        raise ValueError("a bound on bad numbers needs their count")
    row = ("bad_numbers", "silver", found, found <= allowed)
    return [spark.createDataFrame([row], REPORT_SCHEMA)]


def silver_to_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    spec: LayerSpec,
    known_rows: Mapping[str, int] | None = None,
    checks: Sequence[Check] = (),
    leaf_files: bool = False,
    bad_numbers: int | None = None,
    allowed_bad_numbers: int | None = None,
    parts_path: str | None = None,
) -> LayerStatus:
    """Count rows per location and kind; write only if every check passes.

    Always checked: no key is null, the layers' totals agree, and so do the fingerprints of their rows,
    where the manifests hold them. ``known_rows`` holds the rows
    that earlier layers were written with; where it lacks the silver layer, that is counted from
    its footers. ``checks`` adds reports on the clean frame. A failed check raises and leaves the
    previous result. Without clean rows the job is skipped. ``leaf_files``: the directories of the
    clean layer are named like columns in its files (see ``read_leaf_files``). With
    ``allowed_bad_numbers``, more ``bad_numbers`` of the cleaning than that stop the job.

    ``parts_path`` names a layer of counts per leaf, kept by this job: only leaves whose files
    changed since are read (see ``incremental``). Rows of the others are those that it holds.
    """
    if parts_path is not None and leaf_files:
        raise ValueError("counts per leaf need leaves named by their directory keys")
    silver = read_silver_or_none(spark, silver_path, spec, leaf_files)
    if silver is None:
        return LayerStatus("gold", SKIPPED, 0)
    parts = None if parts_path is None else leaf_parts(spark, silver_path, parts_path, spec)
    gold = checkpointed(count_by_location(silver, spec) if parts is None else sum_of_parts(parts, spec))
    total = gold.agg(F.sum(spec.count_name).alias("n")).first()["n"]
    if total is None:
        return LayerStatus("gold", SKIPPED, 0)
    counts = {**(known_rows or {}), "gold": total}
    # Footers and directory names; with leaf files, whose keys are columns, those columns.
    keys = spec.partition_by if leaf_files else spec.clean_keys
    if parts is None:
        leaves = silver.groupBy(*keys).agg(F.count("*").alias("n"))
    else:
        leaves = parts.groupBy(*keys).agg(F.sum(spec.count_name).alias("n"))
    measured = leaves.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_leaves")).first()
    counts.setdefault("silver", measured["n_rows"])
    # Nulls among the grouping keys show in the aggregate, where they count as groups: the clean
    # layer is not read again for them.
    gate(
        report_missing(gold, spec.group_by),
        _totals_report(spark, counts),
        *_print_reports(spark, silver_path, gold, spec),
        *_number_reports(spark, bad_numbers, allowed_bad_numbers),
        *[check(silver) for check in checks],
    )
    if parts is not None:
        write_parts(parts, parts_path)
    write_gold(sorted_by_keys(gold, spec), gold_path)
    return LayerStatus("gold", WRITTEN, total, measured["n_leaves"])
