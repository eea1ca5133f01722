"""Leaves that hold much: a mergeable sketch of the leaf keys, and the write tasks dealt out by it."""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Leaves that a sketch names, and those that it tracks to do so. A count is off by at most
# 3.5 / 16,384 of all rows, so any leaf with a share above 1 / SURE is among those named.
NAMED = 1000
TRACKED = 10_000
SURE = 500


def leaf_sketch(keys: Sequence[Column]) -> Column:
    """Aggregate: the leaves with most rows, for any row order and any way of merging."""
    leaf = F.to_json(F.array(*[F.coalesce(k, F.lit("")) for k in keys]))
    return F.call_function("approx_top_k", leaf, F.lit(NAMED), F.lit(TRACKED))


def named_leaves(sketch: Sequence) -> list[list]:
    """A sketch's result as ``[[rows, key, …], …]``, which a manifest can hold."""
    return [[row["count"], *json.loads(row["item"])] for row in sketch or ()]


def suffices(rows: int | None, piece_rows: int) -> bool:
    """Whether a sketch of so many rows names every leaf above ``piece_rows``."""
    return rows is not None and piece_rows * SURE >= rows


def write_tasks(leaves: Sequence[Sequence], rows: int, piece_rows: int) -> tuple[list[tuple], int, int]:
    """(key…, first task, tasks) of each named leaf; the tasks for whole leaves; all tasks.

    A leaf above ``piece_rows`` gets tasks of its own. The other named ones go, largest first, to the
    task with fewest rows among those for whole leaves, over which leaves without a name are hashed.
    """
    hot = [leaf for leaf in leaves if leaf[0] > piece_rows]
    shared = max(1, -(-(rows - sum(leaf[0] for leaf in hot)) // piece_rows))
    load = [(0, task) for task in range(shared)]
    placed, task = [], shared
    for n, *keys in sorted(leaves, reverse=True):
        if n > piece_rows:
            pieces = -(-n // piece_rows)
            placed.append((*keys, task, pieces))
            task += pieces
        else:
            have, least = heapq.heappop(load)
            placed.append((*keys, least, 1))
            heapq.heappush(load, (have + n, least))
    return placed, shared, task


def dealt(df: DataFrame, keys: Sequence[str], leaves: Sequence[Sequence], rows: int, piece_rows: int) -> DataFrame:
    """``df`` shuffled once to the tasks of ``write_tasks``; a leaf up to ``piece_rows`` meets in one.

    The piece depends on a row's content and its task, not on the order of rows: a task that runs again
    gives the same, and copies of one row spread as far as they come from many tasks. The sketch
    decides on balance alone: with wrong counts every row is still written.
    """
    placed, shared, tasks = write_tasks(leaves, rows, piece_rows)
    columns = [*[f"hot_{k} string" for k in keys], "first_task int", "tasks int"]
    # At most NAMED rows.
    hot = F.broadcast(df.sparkSession.createDataFrame(placed, ", ".join(columns)))
    same = [F.col(k) == F.col(f"hot_{k}") for k in keys]
    spread = F.shiftright(F.xxhash64(*df.columns), 1) + F.spark_partition_id()
    named = F.col("first_task") + F.pmod(spread, F.col("tasks"))
    task = F.coalesce(named, F.pmod(F.xxhash64(*keys), F.lit(shared))).cast("int")
    numbered = df.join(hot, same, "left").select(*df.columns, task.alias("write_task"))
    return numbered.repartitionById(tasks, F.col("write_task")).drop("write_task")
