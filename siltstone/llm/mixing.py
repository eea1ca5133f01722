"""Mixing sources to target weights, with documents repeated whole.

Sizes are summed per source. Sources, by code point with null last, weigh 1, 2, 3, 1, 2, 3, ...;
they share all sizes by weight, none above ``cap`` times its own size, the excess reshared. A source
is repeated ``target / size`` times: each of its documents floor(rate) times, and once more if a
hash of its id, source and text, read as a number in [0, 1), is below the fraction. Rows that are equal
in all three would be drawn alike: they are numbered, per partition of the input, and the extra copies
spread evenly over the numbers, from a start that the hash gives.

Null text has size 0, texts may be of any length. Null ids and sources, repeated rows and empty sources
are kept. An empty table gives no rows. Extra columns pass through
``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.joins import attach
from siltstone.runtime import checkpointed, fits_broadcast, has_rows

# The weights in turn, and the bound on a target in sizes of its source.
WEIGHTS = (1, 2, 3)
CAP = 3
_WORD = r"[^\x20\x09-\x0D]+"
_SALTS = 64


def size_of(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def drawn(*parts: Column) -> Column:
    """A number in [0, 1): the first 32 bits of the parts' MD5."""
    texts = [F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    digest = F.md5(F.concat_ws(":", F.lit("mix"), *texts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def _with_extra(rated: DataFrame) -> DataFrame:
    """``extra``: whether a row gets the one copy that the fraction of its rate is about."""
    fraction = F.col("rate") - F.floor("rate")
    counts = rated.groupBy("digest").agg(F.count("*").alias("rows"))
    repeated = checkpointed(counts.filter("rows > 1"))
    single = (F.col("draw") < fraction).cast("long")
    if not has_rows(repeated):
        return rated.withColumn("extra", single)
    # Equal rows of one partition are numbered; those of several have starts of their own.
    marked = attach(rated, repeated.withColumn("again", F.lit(True)), ["digest"], "rows")
    parted = marked.withColumn("part", F.spark_partition_id())
    alone = parted.filter("again IS NULL").withColumn("extra", single)
    among = parted.filter("again IS NOT NULL")
    nth = F.row_number().over(Window.partitionBy("digest", "part").orderBy("draw"))
    start = drawn(F.col("digest"), F.col("part"))
    steps = F.floor(nth * fraction + start) - F.floor((nth - 1) * fraction + start)
    return alone.unionByName(among.withColumn("extra", steps.cast("long"))).drop("again", "part")


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, their 0-based position by code point, null last.

    Ordered by ranges: each task numbers its own range, after the counts of the ranges before.
    """
    order = [F.col("source").asc_nulls_last()]
    ranged = checkpointed(
        sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranged.withColumn("rank", rank).join(starts, F.col("part") == F.col("p")).select(
        "source", "source_size", (F.col("start") + F.col("rank") - 1).alias("place")
    )


def _is_full(share: int, weights: int) -> Column:
    """Whether a source's share is at or above its cap, in whole numbers of up to 38 digits."""
    whole = "decimal(19,0)"
    cap = (F.col("source_size") * CAP).cast(whole) * F.lit(weights).cast(whole)
    return cap <= F.col("weight").cast(whole) * F.lit(share).cast(whole)


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Rounds settle the sources that reach the cap; each is one sum over the sources, and the level
    only rises, so rounds end when none is above.
    """
    salted = sized.groupBy("source", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS))).agg(F.sum("size").alias("s"))
    sums = salted.groupBy("source").agg(F.sum("s").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod("place", F.lit(len(WEIGHTS))) + 1).cast("int"))
    weighed = checkpointed(_numbered(sums).withColumn("weight", weight.cast("long")))
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    share, weights, capped = total, None, -1
    while True:
        full = _is_full(share, weights) if weights is not None else F.lit(False)
        row = weighed.agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, F.col("source_size") * CAP)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        if row["n"] == capped:
            break
        capped, share, weights = row["n"], total - row["taken"], row["weights"]
    full = _is_full(share, weights) if weights else F.lit(True)
    level = F.col("weight") * F.lit(share) / F.lit(weights or 1)
    target = F.when(full, (F.col("source_size") * CAP).cast("double")).otherwise(level.cast("double"))
    return weighed.select("source", "source_size", target.alias("target"))


def _rated(docs: DataFrame) -> DataFrame:
    """Documents with size, source_size, target and copies, beside their own columns in ``doc``."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id"),
        F.col("source"),
        size_of(F.col("text")).alias("size"),
        drawn(F.col("doc_id"), F.col("source"), F.md5(F.coalesce("text", F.lit("")))).alias("draw"),
        F.xxhash64("doc_id", "source", "text").alias("digest"),
    )
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("key")
    plan = checkpointed(targets(sized.select("doc_id", "source", "size")).select(key, "source_size", "target"))
    if fits_broadcast(plan):
        joined = sized.select("*", key).join(F.broadcast(plan), "key")
    else:
        # A source with a third of all rows is dealt over the salts, so no task gets all of it.
        dealt = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id", "size"), F.lit(_SALTS)).cast("int").alias("salt")
        joined = sized.select("*", key, salt).join(dealt, ["key", "salt"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = joined.withColumn("rate", rate)
    return _with_extra(joined).withColumn("copies", F.floor("rate") + F.col("extra"))


def plan_mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) per document."""
    return _rated(docs.select("doc_id", "source", "text")).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


def mix(docs: DataFrame) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    repeated = _rated(docs).filter(F.col("copies") > 0).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    return repeated.select("doc.*")
