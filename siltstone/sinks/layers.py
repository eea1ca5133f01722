"""Writing the clean and aggregated layers, and the marker that says a layer is whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.fingerprint import fingerprint, row_hashes
from siltstone.operators.heavy import NAMED, dealt, suffices
from siltstone.runtime import checkpointed, fits_broadcast, path_exists
from siltstone.spec import LayerSpec
from siltstone.versions import Version, amend, current, replace, versions

# Fixed value: the directory Spark gives to empty keys. A key that is spelled so goes there too.
_EMPTY_KEY = "__HIVE_DEFAULT_PARTITION__"

_PIECE = "leaf_piece"


def _leaf_rows(df: DataFrame, spec: LayerSpec) -> DataFrame:
    return checkpointed(df.groupBy(*spec.clean_keys).agg(F.count("*").alias("leaf_rows")))


def _with_pieces(
    df: DataFrame, spec: LayerSpec, piece_rows: int, counted: DataFrame | None = None
) -> DataFrame:
    """Number the pieces of leaves above ``piece_rows``; any other leaf is one piece.

    The number depends on a row's content and its task, not on the order of rows: a task that runs
    again gives the same numbers, and copies of one row spread as far as they come from many tasks.
    """
    keys = list(spec.clean_keys)
    leaves = _leaf_rows(df, spec) if counted is None else counted
    hot = leaves.filter(F.col("leaf_rows") > piece_rows).select(
        *[F.col(k).alias(f"hot_{k}") for k in keys],
        F.ceil(F.col("leaf_rows") / piece_rows).alias("pieces"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"hot_{k}")) for k in keys]
    # Leaves above the bound may be many: beyond the broadcast limit the join shuffles, and
    # adaptive execution splits its skewed partitions.
    joined = df.join(F.broadcast(hot) if fits_broadcast(hot) else hot, same, "left")
    spread = F.shiftright(F.xxhash64(*df.columns), 1) + F.spark_partition_id()
    piece = F.pmod(spread, F.coalesce("pieces", F.lit(1)))
    return joined.select(*df.columns, piece.alias(_PIECE))


def _counted_pieces(df: DataFrame, spec: LayerSpec, piece_rows: int) -> DataFrame:
    """The pieces by a pass over the keys: dealt to tasks one by one, as with a sketch.

    Where more leaves than a sketch names are above ``piece_rows``, there are many times more pieces than
    these, and they are hashed over a fixed number of tasks. In neither way a task is split again.
    """
    leaves, keys = _leaf_rows(df, spec), list(spec.clean_keys)
    total = leaves.agg(F.coalesce(F.sum("leaf_rows"), F.lit(0))).first()[0]
    hot = leaves.filter(F.col("leaf_rows") > piece_rows).select("leaf_rows", *keys).limit(NAMED + 1).collect()
    if len(hot) <= NAMED and all(key is not None for leaf in hot for key in leaf):
        return dealt(df, keys, [list(leaf) for leaf in hot], total, piece_rows)
    numbered = _with_pieces(df, spec, piece_rows, leaves)
    return numbered.repartition(max(1, -(-total // piece_rows)), *keys, _PIECE).drop(_PIECE)


def _balanced(df: DataFrame, spec: LayerSpec, piece_rows: int | None, source: Version | None) -> DataFrame:
    keys = list(spec.clean_keys)
    if piece_rows is None:
        return df.hint("rebalance", *keys)
    notes = source.notes if source else {}
    if notes.get("leaf_keys") == keys and suffices(source.rows, piece_rows):
        # An empty key's directory may be spelled out in the data; see ``_EMPTY_KEY``.
        leaves = [[n, *("" if k == _EMPTY_KEY else k for k in key)] for n, *key in notes["leaves"]]
        if len({tuple(key) for _, *key in leaves}) == len(leaves):
            return dealt(df, keys, leaves, source.rows, piece_rows)
    return _counted_pieces(df, spec, piece_rows)


def write_silver(
    df: DataFrame,
    path: str,
    spec: LayerSpec,
    keep_other_leaves: bool = False,
    piece_rows: int | None = None,
    helpers: Sequence[str] = (),
    source: Version | None = None,
    all_rows: bool = False,
    order_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
) -> dict[str, int]:
    """Write a frame that has the directory keys, split by them.

    Returns the rows written under ``n_rows``, and the sums of the ``helpers``, number columns that
    are counted on the way and not written.

    Rows of a leaf meet in one task, so a leaf is one file, until it outgrows the advisory
    partition size: then adaptive execution splits it over tasks and files, and a leaf that holds
    a third of all rows does not wait on a single writer. Such a split also spreads the small
    leaves that share the hot one's shuffle partition. ``piece_rows`` prevents that: leaves above so
    many rows are written in pieces of so many, every other leaf is one file. Which leaves those are
    says the manifest of the layer that the rows come from (``source``), if it was landed with a
    spec; then rows are cleaned and shuffled once. A sketch is too coarse for pieces below a 500th
    of all rows: for these, and without one, a pass over the keys counts the leaves first.

    Within a file rows are ordered by ``order_by``, so that a filter on these columns reads only the pages
    that may hold its values, and the ``bloom`` columns get Bloom filters, by which a filter for single
    values skips whole row groups: both prune inside a leaf that directory keys do not split.

    The manifest gets a fingerprint of the rows written and of their grouping keys, and with
    ``all_rows`` the one that ``source`` was landed with, which must be the same.

    The whole dataset is replaced by a new version, or, with ``keep_other_leaves``, only the leaves in
    ``df`` within the present one. A write that fails before it commits changes neither.
    """
    rows = Observation()
    keyed = df.replace(_EMPTY_KEY, "", subset=list(spec.clean_keys))
    balanced = _balanced(keyed, spec, piece_rows, source)
    # Counted behind the shuffle: there, a task that runs again does not count twice.
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in helpers]
    prints = {}
    if set(spec.columns) <= set(df.columns):
        prints = {"rows_print": spec.columns, "keys_print": spec.group_by}
    hashes = {n: c for name, columns in prints.items() for n, c in row_hashes(columns, name).items()}
    sums += [fingerprint(name).alias(name) for name in prints]
    counted = balanced.withColumns(hashes) if hashes else balanced
    counted = counted.observe(rows, F.count(F.lit(1)).alias("n_rows"), *sums).drop(*helpers, *hashes)
    spark = df.sparkSession
    if order_by:
        # Keys that cannot be null let the writer take this order; else it would sort anew by them alone.
        whole_keys = counted.withColumns({k: F.coalesce(k, F.lit("")) for k in spec.clean_keys})
        counted = whole_keys.sortWithinPartitions(*spec.clean_keys, *order_by)
    writer = counted.write.partitionBy(*spec.clean_keys)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")

    def notes() -> dict:
        told = {name: list(rows.get[name]) for name in prints}
        expected = source.notes.get("rows_print") if source and all_rows else None
        return told | ({"source_print": expected} if expected else {})

    def whole(folder: str) -> int:
        writer.parquet(folder)
        return rows.get["n_rows"]

    def leaves(folder: str) -> None:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)

    if keep_other_leaves and versions(spark, path):
        amend(spark, path, leaves)
    elif keep_other_leaves and current(spark, path):
        # A layer without versions stays one.
        leaves(path)
        # A write of single leaves sets no marker on the whole; adding no rows does.
        nothing = spark.createDataFrame([], df.drop(*helpers).schema)
        nothing.write.mode("append").partitionBy(*spec.clean_keys).parquet(path)
    else:
        replace(spark, path, whole, notes)
    return {name: n for name, n in rows.get.items() if name not in prints}


def write_gold(df: DataFrame, path: str) -> None:
    """Replace the aggregated table by a new version; a write that fails leaves the last one."""
    rows = Observation()

    def whole(folder: str) -> int:
        df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(folder)
        return rows.get["n"]

    replace(df.sparkSession, path, whole)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left its manifest under ``path``, or its marker in a layer without versions."""
    folder = current(spark, path)
    return folder is not None and (folder != path or path_exists(spark, f"{path}/_SUCCESS"))
