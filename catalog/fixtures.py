"""Inputs for the registered queries, derived by Spark from the given tables.

The tables hold no nulls, no bad numbers and no unsafe names, so the select lists below put them
in, for whole tables. Both engines read the same lists: they define input, not an operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.cleaning import clean, with_clean_keys
from siltstone.runtime import scratch_path
from siltstone.sinks.bronze import land_record_text
from siltstone.sinks.layers import write_silver
from siltstone.sinks.responses import write_responses
from siltstone.spec import LOCATIONS

# Fixed value: records per page.
PAGE_SIZE = 50

# Raw records in the 12-column model, all text.
RAW_SELECTS = {
    "lineitem": """
        CONCAT(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
        CONCAT('item ', CAST(l_partkey AS STRING)) AS name,
        NULLIF(CAST(l_linenumber AS STRING), '7') AS brewery_type,
        CONCAT('Dock ', CAST(l_suppkey AS STRING)) AS street,
        CONCAT(l_linestatus, '/', CAST(l_linenumber AS STRING), ' ') AS city,
        NULLIF(l_returnflag, 'R') AS state,
        CAST(CAST(l_quantity AS INT) AS STRING) AS postal_code,
        CAST(NULL AS STRING) AS country,
        CASE WHEN l_linenumber = 6 THEN 'n/a'
             ELSE CAST(l_extendedprice AS STRING) END AS longitude,
        CASE WHEN l_linenumber = 5 THEN CONCAT(CAST(l_discount AS STRING), 'd')
             ELSE CAST(l_discount AS STRING) END AS latitude,
        '' AS phone,
        CONCAT('http://parts/', CAST(l_partkey AS STRING)) AS website_url
    """,
    "part": """
        CAST(p_partkey AS STRING) AS id,
        p_name AS name,
        NULLIF(CAST(p_size AS STRING), '7') AS brewery_type,
        CONCAT('Bin ', CAST(p_size AS STRING)) AS street,
        p_brand AS city,
        p_type AS state,
        '' AS postal_code,
        CAST(NULL AS STRING) AS country,
        CASE WHEN p_size = 13 THEN 'n/a' ELSE CAST(p_retailprice AS STRING) END AS longitude,
        CAST(p_size AS STRING) AS latitude,
        CAST(NULL AS STRING) AS phone,
        CONCAT('http://parts/', CAST(p_partkey AS STRING)) AS website_url
    """,
    "orders": """
        CAST(o_orderkey AS STRING) AS id,
        CONCAT('order ', CAST(o_orderkey AS STRING)) AS name,
        CAST(YEAR(o_orderdate) AS STRING) AS brewery_type,
        CAST(NULL AS STRING) AS street,
        NULLIF(o_orderstatus, 'P') AS city,
        o_orderpriority AS state,
        CAST(o_custkey AS STRING) AS postal_code,
        'US' AS country,
        CAST(o_totalprice AS STRING) AS longitude,
        CASE WHEN o_orderstatus = 'F' THEN 'unknown' ELSE '-1.5e1' END AS latitude,
        CAST(NULL AS STRING) AS phone,
        '' AS website_url
    """,
}

# Two raw spellings of the first key that fall on one directory.
COLLIDING_SELECT = """
    p_partkey AS id,
    CASE WHEN p_size > 25 THEN CONCAT(p_type, '/x') ELSE CONCAT(p_type, '_x ') END AS state,
    p_brand AS city,
    CAST(p_size AS STRING) AS brewery_type
"""

# Numbers as text, in the spellings that parsers disagree on.
NUMBER_TEXT_SELECT = """
    event_id,
    CASE event_type WHEN 'error' THEN 'n/a'
                    WHEN 'view' THEN CONCAT(CAST(value AS STRING), 'd')
                    WHEN 'signup' THEN CONCAT(' ', CAST(value AS STRING), ' ')
                    WHEN 'click' THEN CONCAT('+', CAST(value AS STRING), 'e1')
                    ELSE '1e999' END AS number_text
"""


def split_select(text: str) -> list[str]:
    """A select list to its items, cut at the commas that end a line."""
    return [item.strip() for item in text.strip().split(",\n")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_locations(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*split_select(RAW_SELECTS[name]))


def clean_locations(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_clean_keys(clean(raw_locations(spark, sf_dir, name), LOCATIONS), LOCATIONS)


# Paths of inputs already made, by what they are; None while every query makes its own.
_made: dict[tuple[str, ...], str] | None = None


def keep_inputs(keep: bool) -> None:
    """Whether inputs are made once per session instead of once per query (for the bench)."""
    global _made
    _made = {} if keep else None


def _once(make: Callable[[], str], *what: str) -> str:
    if _made is None:
        return make()
    if what not in _made:
        _made[what] = make()
    return _made[what]


def silver_of(spark: SparkSession, sf_dir: str, name: str, fresh: bool = False) -> str:
    """Path of a clean layer written from a table; ``fresh`` for a query that changes it."""

    def make() -> str:
        path = scratch_path(spark, "silver")
        write_silver(clean_locations(spark, sf_dir, name), path, LOCATIONS)
        return path

    return make() if fresh else _once(make, "silver", sf_dir, name)


def as_records(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("record"))


def bronze_of(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Path of a raw layer written from a table."""

    def make() -> str:
        path = scratch_path(spark, "bronze")
        land_record_text(as_records(raw_locations(spark, sf_dir, name)), path)
        return path

    return _once(make, "bronze", sf_dir, name)


def _response(page: Column, status: int, body: str) -> Column:
    return F.struct(
        page.alias("page"), F.lit(status).alias("status"), F.lit(body).alias("body")
    )


def landed_responses(
    spark: SparkSession, sf_dir: str, name: str, key: str, df: DataFrame
) -> DataFrame:
    """A table of responses that delivers ``df`` page by page, ordered by ``key``.

    ``key`` is the table's primary key, counted from 0, so a page never holds more than
    ``PAGE_SIZE`` records. An empty page ends the set; behind it comes a failed one, which must
    not matter.
    """
    return spark.read.parquet(_once(lambda: _land_responses(spark, name, key, df), "responses", sf_dir, name))


def _land_responses(spark: SparkSession, name: str, key: str, df: DataFrame) -> str:
    path = scratch_path(spark, f"responses_{name}")
    number = F.floor(F.col(key) / PAGE_SIZE).cast("bigint") + 1
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record")
    packed = (
        df.select(number.alias("page"), F.struct(F.col(key), record).alias("item"))
        .groupBy("page")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .select(
            "page",
            F.lit(200).alias("status"),
            F.concat(F.lit("["), F.array_join("items.record", ",\n "), F.lit("]")).alias("body"),
        )
    )
    write_responses(packed, path)
    last = spark.read.parquet(path).agg(F.max("page").alias("last"))
    end, late = F.col("last") + 1, F.col("last") + 2
    tail = last.select(F.inline(F.array(_response(end, 200, "[]"), _response(late, 500, "late"))))
    write_responses(tail, path, append=True)
    return path


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "NULLIF(event_type, 'error') AS event_type", "value"
    )
    return landed_responses(spark, sf_dir, "events", "event_id", events)


def order_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderkey", *split_select(RAW_SELECTS["orders"])]
    orders = table(spark, sf_dir, "orders").selectExpr(*columns)
    return landed_responses(spark, sf_dir, "orders", "o_orderkey", orders)
