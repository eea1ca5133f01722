"""Run one layer or all of them: ``python -m siltstone all --responses PATH --root PATH``.

fetch    pages of a URL with ``{page}`` in it, to a table of responses
bronze   responses to raw records
silver   raw records to the clean layer
gold     clean layer to the counts per location and kind
all      bronze, silver and gold, each only if it is not there yet
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from siltstone.operators.ordering import preview
from siltstone.plans.ingest import ingest_bronze
from siltstone.plans.medallion import build_layers, layer_paths
from siltstone.plans.refine import bronze_to_silver, count_bad_numbers, read_bronze
from siltstone.plans.status import WRITTEN, LayerStatus
from siltstone.plans.summarise import silver_to_gold
from siltstone.sinks.layers import is_complete
from siltstone.sources.fetch import http_get, land_responses
from siltstone.sources.layers import read_gold
from siltstone.spec import LOCATIONS


_CLEANING = {"arrays", "strict", "keep_other_leaves", "piece_rows", "last_pair_wins"}
# Options of each step; any other is refused.
TAKES = {
    "fetch": {"url", "responses"},
    "bronze": {"responses", "root", "arrays", "progress"},
    "silver": {"root"} | _CLEANING,
    "gold": {"root", "leaf_files", "arrays", "last_pair_wins", "keep_other_leaves", "allowed_bad_numbers", "parts"},
    "all": {"responses", "root", "allowed_bad_numbers", "progress", "parts"} | _CLEANING,
}


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        prog="siltstone", description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    parser.add_argument("step", choices=("fetch", "bronze", "silver", "gold", "all"))
    parser.add_argument("--root", help="folder that holds bronze/, silver/ and gold/")
    parser.add_argument("--responses", help="path of the landed responses")
    parser.add_argument("--url", help="URL of a page, with {page} in place of its number")
    parser.add_argument("--arrays", action="store_true", help="bronze holds array documents")
    parser.add_argument("--strict", action="store_true", help="bad numbers fail the job")
    parser.add_argument("--keep-other-leaves", action="store_true", help="replace single leaves")
    parser.add_argument("--piece-rows", type=int, help="rows per file of a large leaf")
    parser.add_argument("--last-pair-wins", action="store_true", help="colliding keys replace")
    parser.add_argument(
        "--leaf-files", action="store_true", help="silver's directories are named like its columns"
    )
    parser.add_argument(
        "--allowed-bad-numbers", type=int, help="values that may become null before gold is refused"
    )
    parser.add_argument("--progress", help="where to write the records per page and so far")
    parser.add_argument("--parts", help="layer of counts per leaf: only replaced leaves are counted again")
    given = parser.parse_args(argv)
    needs = {"fetch": ("url", "responses"), "bronze": ("responses", "root"), "all": ("responses", "root")}
    for name in needs.get(given.step, ("root",)):
        if getattr(given, name) is None:
            parser.error(f"{given.step} needs --{name}")
    for name, value in vars(given).items():
        if name != "step" and value != parser.get_default(name) and name not in TAKES[given.step]:
            parser.error(f"{given.step} does not take --{name.replace('_', '-')}")
    return given


def _run(spark: SparkSession, given: argparse.Namespace) -> list[LayerStatus]:
    if given.step == "fetch":
        landed = land_responses(spark, http_get(given.url), given.responses)
        return [LayerStatus("responses", WRITTEN, landed.count())]
    paths = layer_paths(given.root)
    cleaning = {name: getattr(given, name) for name in _CLEANING}
    if given.step == "silver":
        return [bronze_to_silver(spark, paths["bronze"], paths["silver"], LOCATIONS, **cleaning)]
    if given.step == "gold":
        return [_gold(spark, given, paths)]
    responses = spark.read.parquet(given.responses)
    if given.step == "bronze":
        return [ingest_bronze(responses, paths["bronze"], given.arrays, given.progress, LOCATIONS)]
    allowed = given.allowed_bad_numbers
    return build_layers(
        spark,
        responses,
        given.root,
        LOCATIONS,
        allowed_bad_numbers=allowed,
        progress_path=given.progress,
        parts_path=given.parts,
        **cleaning,
    )


def _gold(spark: SparkSession, given: argparse.Namespace, paths: dict[str, str]) -> LayerStatus:
    """The last step alone: what it must know of the raw layer is counted, if there is one."""
    known, bad = {}, None
    if is_complete(spark, paths["bronze"]):
        if not (given.last_pair_wins or given.keep_other_leaves):
            known["bronze"] = read_bronze(spark, paths["bronze"], LOCATIONS, given.arrays).count()
        if given.allowed_bad_numbers is not None:
            bad = count_bad_numbers(spark, paths["bronze"], LOCATIONS, given.arrays)
    return silver_to_gold(
        spark,
        paths["silver"],
        paths["gold"],
        LOCATIONS,
        known,
        leaf_files=given.leaf_files,
        bad_numbers=bad,
        allowed_bad_numbers=given.allowed_bad_numbers,
        parts_path=given.parts,
    )


def main(argv: Sequence[str] | None = None) -> list[LayerStatus]:
    given = _arguments(argv)
    running = SparkSession.getActiveSession()
    spark = running or SparkSession.builder.appName(f"siltstone {given.step}").getOrCreate()
    outcomes = _run(spark, given)
    for outcome in outcomes:
        counts = {"rows": outcome.n_rows, "leaves": outcome.n_leaves, "bad numbers": outcome.bad_numbers}
        told = "".join(f", {n} {what}" for what, n in counts.items() if n is not None)
        print(f"{outcome.layer}: {outcome.status}{told}")
    if outcomes[-1].layer == "gold" and outcomes[-1].status == WRITTEN:
        gold = read_gold(spark, layer_paths(given.root)["gold"], LOCATIONS)
        preview(gold, LOCATIONS).show(truncate=False)
    if running is None:
        spark.stop()
    return outcomes


if __name__ == "__main__":
    main()
