"""All three layers in a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from siltstone.plans.ingest import ingest_bronze
from siltstone.plans.refine import bronze_to_silver, count_bad_numbers, read_bronze
from siltstone.plans.status import SKIPPED, LayerStatus
from siltstone.plans.summarise import Check, silver_to_gold
from siltstone.sinks.layers import is_complete
from siltstone.spec import LayerSpec


def layer_paths(root: str) -> dict[str, str]:
    return {layer: f"{root}/{layer}" for layer in ("bronze", "silver", "gold")}


def build_layers(
    spark: SparkSession,
    responses: DataFrame,
    root: str,
    spec: LayerSpec,
    checks: Sequence[Check] = (),
    piece_rows: int | None = None,
    arrays: bool = False,
    strict: bool = False,
    keep_other_leaves: bool = False,
    last_pair_wins: bool = False,
    allowed_bad_numbers: int | None = None,
    progress_path: str | None = None,
    parts_path: str | None = None,
) -> list[LayerStatus]:
    """Bring the three layers under ``root`` up to date and say what was done.

    A layer whose write finished is not made again, nor is anything before it: a run after a
    failure goes on behind the last whole layer, a run after success does nothing. What such a run
    needs to know of a layer that it skips it counts, so the checks are those of a whole run.
    Raw and clean layer account for the same rows, unless ``last_pair_wins`` drops some or
    ``keep_other_leaves`` keeps others. The options are those of the single steps.
    """
    paths = layer_paths(root)
    layers = list(paths)
    whole = [i for i, layer in enumerate(layers) if is_complete(spark, paths[layer])]
    done = max(whole, default=-1)
    outcomes = [LayerStatus(layer, SKIPPED, None) for layer in layers[: done + 1]]
    if done < 0:
        outcomes.append(ingest_bronze(responses, paths["bronze"], arrays, progress_path, spec))
    if done < 1:
        outcomes.append(
            bronze_to_silver(
                spark,
                paths["bronze"],
                paths["silver"],
                spec,
                arrays=arrays,
                strict=strict,
                keep_other_leaves=keep_other_leaves,
                last_pair_wins=last_pair_wins,
                piece_rows=piece_rows,
            )
        )
    if done < 2:
        known = {o.layer: o.n_rows for o in outcomes if o.n_rows is not None}
        bad = {o.layer: o.bad_numbers for o in outcomes}.get("silver")
        if allowed_bad_numbers is not None and bad is None:
            bad = count_bad_numbers(spark, paths["bronze"], spec, arrays)
        if last_pair_wins or keep_other_leaves:
            known.pop("bronze", None)
            known.pop("silver", None)
        elif "bronze" not in known and is_complete(spark, paths["bronze"]):
            known["bronze"] = read_bronze(spark, paths["bronze"], spec, arrays).count()
        outcomes.append(
            silver_to_gold(
                spark,
                paths["silver"],
                paths["gold"],
                spec,
                known,
                checks,
                bad_numbers=bad,
                allowed_bad_numbers=allowed_bad_numbers,
                parts_path=parts_path,
            )
        )
    return outcomes
