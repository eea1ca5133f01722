"""One query per operator and job, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.fixtures import (
    COLLIDING_SELECT,
    NUMBER_TEXT_SELECT,
    as_records,
    bronze_of,
    clean_locations,
    event_responses,
    order_responses,
    raw_locations,
    silver_of,
    split_select,
    table,
)
from siltstone.functions.numeric import lenient_double, strict_double
from siltstone.functions.text import replace_unsafe, sanitize_name, sanitize_name_udf, strip
from siltstone.operators import aggregates, cleaning, collisions, fingerprint, ordering, quality
from siltstone.plans.ingest import ingest_bronze
from siltstone.plans.medallion import build_layers, layer_paths
from siltstone.plans.refine import bronze_to_silver
from siltstone.plans.status import status_frame
from siltstone.plans.summarise import silver_to_gold
from siltstone.runtime import scratch_path
from siltstone.sinks.bronze import land_array_documents, land_frame, land_record_text
from siltstone.sinks.layers import write_gold, write_silver
from siltstone.sources import drift, layers, pages, records
from siltstone.spec import LOCATIONS
from siltstone.versions import current

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


EVENT_RECORD = "event_id bigint, user_id bigint, event_type string, value double"


def _parsed_events(found: DataFrame) -> DataFrame:
    parsed = found.withColumn("r", F.from_json("record", EVENT_RECORD))
    return parsed.select("page", "pos", "r.event_id", "r.user_id", "r.event_type", "r.value")


# Sources


@query
def src_json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        "value",
        F.from_json("props", "k int").alias("nested"),
    )
    path = scratch_path(spark, "arrays")
    land_array_documents(as_records(events), path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in events.columns])
    found = records.read_json_arrays(spark, path, text)
    return found.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_type",
        F.col("value").cast("double").alias("value"),
        "nested",
    )


@query
def src_record_key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "NULLIF(event_type, 'error') AS event_type",
        "CASE WHEN value > 100 THEN value END AS high",
        "CASE WHEN value <= 100 THEN value END AS low",
    )
    path = scratch_path(spark, "bronze")
    land_record_text(as_records(events, keep_nulls=False), path)
    found = records.read_union_of_keys(spark, path)
    return found.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_type",
        F.col("high").cast("double").alias("high"),
        F.col("low").cast("double").alias("low"),
    )


@query
def src_partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = layers.read_silver(spark, silver_of(spark, sf_dir, "part"), LOCATIONS)
    return silver.select(*LOCATIONS.columns)


@query
def src_merge_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "drift")
    orders.select("o_orderkey", "o_orderpriority").write.parquet(path)
    orders.select("o_orderkey", "o_orderstatus").write.mode("append").parquet(path)
    return layers.read_merged(spark, path).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query
def src_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of one layer: a column turned from number to text, one got wider, one came, one went."""
    path, items = scratch_path(spark, "drift"), table(spark, sf_dir, "lineitem")
    first = items.filter("l_linenumber < 4").selectExpr(
        "l_orderkey", "l_linenumber", "CAST(l_quantity AS INT) AS l_quantity", "l_suppkey AS part", "l_returnflag"
    )
    second = items.filter("l_linenumber >= 4").selectExpr(
        "l_orderkey", "CAST(l_linenumber AS BIGINT) AS l_linenumber", "l_extendedprice AS l_quantity",
        "CONCAT('P', CAST(l_suppkey AS STRING)) AS part", "l_linestatus"
    )
    first.write.parquet(path)
    second.write.mode("append").parquet(path)
    return drift.read_drifted(spark, path)


@query
def src_empty_input_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = silver_of(spark, sf_dir, "lineitem")
    absent = scratch_path(spark, "silver")
    gold = scratch_path(spark, "gold")
    outcomes = [silver_to_gold(spark, path, gold, LOCATIONS) for path in (present, absent)]
    return status_frame(spark, outcomes)


@query
def src_page_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed_events(pages.ingest(event_responses(spark, sf_dir)))


@query
def src_page_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_progress(pages.pages_before_end(event_responses(spark, sf_dir)))


# Sinks


@query
def snk_json_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumns(
        {
            "event_type": F.nullif("event_type", F.lit("error")),
            "note": F.lit(None).cast("string"),
        }
    )
    path = scratch_path(spark, "bronze")
    land_frame(events, path)
    found = records.read_union_of_keys(spark, path)
    return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in events.schema])


@query
def snk_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.read_silver(spark, silver_of(spark, sf_dir, "lineitem", fresh=True), LOCATIONS)


def _second_load(spark: SparkSession, sf_dir: str, keep_other_leaves: bool) -> DataFrame:
    """A first load of all leaves, then one that brings new rows for some of them."""
    path = silver_of(spark, sf_dir, "part", fresh=True)
    update = (
        clean_locations(spark, sf_dir, "part")
        .filter(F.col("state").isin("SMALL", "LARGE"))
        .withColumn("name", F.upper("name"))
    )
    write_silver(update, path, LOCATIONS, keep_other_leaves)
    return layers.read_silver(spark, path, LOCATIONS)


@query
def snk_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_load(spark, sf_dir, keep_other_leaves=True)


@query
def snk_static_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_load(spark, sf_dir, keep_other_leaves=False)


@query
def snk_gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold")
    for name in ("part", "lineitem"):
        cleaned = clean_locations(spark, sf_dir, name)
        write_gold(aggregates.count_by_location(cleaned, LOCATIONS), path)
    return layers.read_gold(spark, path, LOCATIONS)


@query
def snk_skip_if_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "layers")
    responses = order_responses(spark, sf_dir)
    first = build_layers(spark, responses, root, LOCATIONS)
    second = build_layers(spark, responses, root, LOCATIONS)
    runs = [
        status_frame(spark, outcomes).withColumn("run", F.lit(i))
        for i, outcomes in enumerate((first, second), start=1)
    ]
    return runs[0].unionAll(runs[1])


# Projection, filter, cleaning


@query
def prj_select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_locations(spark, sf_dir, "lineitem").withColumn("extra", F.lit("dropped"))
    return cleaning.select_columns(raw, LOCATIONS)


@query
def prj_derived_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_locations(spark, sf_dir, "lineitem")
    return cleaned.select("id", "state", "city", "state_clean", "city_clean")


@query
def flt_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = layers.read_silver(spark, silver_of(spark, sf_dir, "lineitem"), LOCATIONS)
    leaf = silver.filter((F.col("state_clean") == "A") & (F.col("city_clean") == "O_3"))
    return leaf.select("id", "state", "city", "longitude")


@query
def flt_point_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single rows out of large leaves whose files are ordered and carry Bloom filters."""
    path = scratch_path(spark, "silver")
    cleaned = clean_locations(spark, sf_dir, "lineitem")
    write_silver(cleaned, path, LOCATIONS, order_by=["postal_code", "id"], bloom=["id"])
    found = layers.read_silver(spark, path, LOCATIONS)
    wanted = ["1-1", "7-2", "32-5", "no such"]
    return found.filter(F.col("id").isin(wanted) | (F.col("postal_code") == "17")).select("id", "state", "postal_code")


@query
def cln_cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_returnflag"]
    items = table(spark, sf_dir, "lineitem").select(*columns)
    return cleaning.cast_strings(items, columns)


@query
def cln_cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("string").alias("price_text")
    )
    return text.select(
        "l_orderkey", "l_linenumber", strict_double(F.col("price_text")).alias("price")
    )


@query
def cln_lenient_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "events").selectExpr(*split_select(NUMBER_TEXT_SELECT))
    return text.select("event_id", lenient_double(F.col("number_text")).alias("number"))


@query
def cln_fill_blank_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_locations(spark, sf_dir, "lineitem").select(*LOCATIONS.strings)
    return cleaning.fill_blank(raw, LOCATIONS.strings)


# Scalar functions


@query
def str_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t 　"), F.col("text"), F.lit("\xa0\n"))
    return table(spark, sf_dir, "documents").select("doc_id", strip(padded).alias("stripped"))


@query
def str_replace_unsafe_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages")
    return found.select("page_id", replace_unsafe(F.col("html")).alias("replaced"))


@query
def str_sanitize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.col("url"), F.lit("\x85"))
    found = table(spark, sf_dir, "pages")
    return found.select("page_id", sanitize_name(padded).alias("name_clean"))


@query
def str_partition_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = cleaning.clean(raw_locations(spark, sf_dir, "lineitem"), LOCATIONS)
    return cleaning.with_partition_path(raw, LOCATIONS, "leaf").select("id", "leaf")


@query
def udf_sanitize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.col("url"), F.lit("\x85"))
    sanitize = sanitize_name_udf()
    return table(spark, sf_dir, "pages").select("page_id", sanitize(padded).alias("name_clean"))


# Aggregates, order, union


@query
def agg_count_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_locations(spark, sf_dir, "lineitem")
    return aggregates.count_by_location(cleaned, LOCATIONS)


@query
def agg_layer_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.row_count(
        layers.read_silver(spark, silver_of(spark, sf_dir, "lineitem"), LOCATIONS)
    )


@query
def agg_leaf_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = layers.read_silver(spark, silver_of(spark, sf_dir, "part"), LOCATIONS)
    return aggregates.leaf_count(silver, LOCATIONS)


@query
def agg_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that hold rows, of a layer in which every leaf is one piece."""
    path = scratch_path(spark, "silver")
    write_silver(clean_locations(spark, sf_dir, "part"), path, LOCATIONS, piece_rows=2**31 - 1)
    return aggregates.file_count(layers.read_silver(spark, path, LOCATIONS))


@query
def dq_row_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer beside itself in another order, and beside one that lost a row and has another twice."""
    rows = clean_locations(spark, sf_dir, "lineitem")
    first, last = rows.agg(F.min("id"), F.max("id")).first()
    swapped = rows.filter(F.col("id") != first).unionAll(rows.filter(F.col("id") == last))
    found = [
        (name, other.count(), fingerprint.same_rows(rows, other))
        for name, other in (("shuffled", rows.repartition("name")), ("swapped", swapped))
    ]
    return spark.createDataFrame(found, "compared string, n_rows bigint, same_rows boolean")


@query
def agg_leaf_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.leaf_manifest(clean_locations(spark, sf_dir, "lineitem"), LOCATIONS)


@query
def agg_null_key_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("error")).alias("kind")
    )
    keep = aggregates.count_by(events, ["kind"], "n").withColumn("rule", F.lit("keep"))
    drop = aggregates.count_by(events, ["kind"], "n", drop_null_keys=True)
    return keep.unionAll(drop.withColumn("rule", F.lit("drop")))


@query
def agg_cities_per_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_locations(spark, sf_dir, "lineitem")
    return aggregates.inner_keys_per_outer(cleaned, "state", "city", "cities")


@query
def ord_sorted_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = aggregates.count_by_location(clean_locations(spark, sf_dir, "part"), LOCATIONS)
    return ordering.sorted_by_keys(gold, LOCATIONS)


@query
def ord_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = aggregates.count_by_location(clean_locations(spark, sf_dir, "part"), LOCATIONS)
    return ordering.preview(gold, LOCATIONS)


@query
def ord_page_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.ingest(event_responses(spark, sf_dir))
    ordered = ordering.in_ingest_order(found)
    return _parsed_events(ordered).select("page", "pos", "event_id")


@query
def set_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return ordering.union_by_name(
        [
            items.select(F.col("l_orderkey").alias("orderkey"), "l_quantity"),
            orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus"),
            items.select("l_returnflag", F.col("l_orderkey").alias("orderkey")),
        ]
    )


@query
def win_collision_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr(*split_select(COLLIDING_SELECT))
    return collisions.keep_last_pair(parts, LOCATIONS)


# Data quality


@query
def dq_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_locations(spark, sf_dir, "lineitem")
    return quality.null_and_blank_counts(raw, [*LOCATIONS.group_by, "country", "phone"])


@query
def dq_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    again = items.filter("l_quantity > 40").unionAll(items.filter("l_quantity > 48"))
    return quality.duplicate_rows(items.unionAll(again))


@query
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_type_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = table(spark, sf_dir, "events").selectExpr(*split_select(NUMBER_TEXT_SELECT))
    text = table(spark, sf_dir, "events").join(spelled, "event_id").select(
        F.col("value").cast("string").alias("value_text"),
        "number_text",
        F.nullif("event_type", F.lit("error")).alias("kind"),
        F.when(F.col("event_type") == "click", F.lit("someday"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("day_text"),
    )
    types = {
        "value_text": ["double", "string"],
        "number_text": ["double"],
        "kind": ["double", "date"],
        "day_text": ["date", "double"],
    }
    return quality.type_violations(text, types)


@query
def dq_totals_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_of(spark, sf_dir, "lineitem")
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    bronze_to_silver(spark, bronze, silver, LOCATIONS)
    silver_to_gold(spark, silver, gold, LOCATIONS)
    return quality.totals(
        records.record_lines(spark, bronze),
        layers.read_silver(spark, silver, LOCATIONS),
        layers.read_gold(spark, gold, LOCATIONS),
        LOCATIONS,
    )


@query
def dq_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = [F.lit(day).cast("timestamp_ntz") for day in ("1996-01-01", "2000-12-31")]
    return quality.date_range(table(spark, sf_dir, "orders"), "o_orderdate", *bounds)


@query
def dq_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn(
        "event_type", F.nullif("event_type", F.lit("error"))
    )
    path = scratch_path(spark, "bronze")
    land_record_text(as_records(events, keep_nulls=False), path)
    expected = ["event_id", "event_type", "value", "country"]
    return records.key_presence(records.record_lines(spark, path), expected)


@query
def dq_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = aggregates.count_by_location(clean_locations(spark, sf_dir, "lineitem"), LOCATIONS)
    none = gold.filter(F.col(LOCATIONS.count_name) < 1)
    return quality.non_empty(gold, "gold").unionAll(quality.non_empty(none, "empty groups"))


@query
def dq_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = silver_of(spark, sf_dir, "lineitem", fresh=True)
    # A leaf whose file holds no row.
    rows = layers.read_silver(spark, path, LOCATIONS).drop(*LOCATIONS.clean_keys)
    empty = rows.filter("id is null").coalesce(1)
    empty.write.parquet(f"{current(spark, path)}/state_clean=A/city_clean=no rows + 100%25")
    return quality.layout(spark, path, LOCATIONS)


@query
def dq_key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr(*split_select(COLLIDING_SELECT))
    return collisions.key_collisions(parts, LOCATIONS)


@query
def dq_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_locations(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    bounds = [F.lit(day).cast("timestamp_ntz") for day in ("1995-01-01", "1997-01-01")]
    reports = [
        quality.report_missing(raw, ["id", "phone", "state"], 0, 0),
        quality.report_duplicates(raw, ["id"]),
        quality.report_types(raw, {"postal_code": ["double"], "longitude": ["double"]}, allowed=5),
        quality.report_date_range(orders, "o_orderdate", *bounds),
    ]
    try:
        return quality.gate(*reports)
    except quality.QualityGateError as error:
        return spark.createDataFrame(error.report, quality.REPORT_SCHEMA)


# Jobs


@query
def job_ingest_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    ingest_bronze(order_responses(spark, sf_dir), path)
    found = records.read_json_lines(spark, path, LOCATIONS.bronze_schema)
    return found.withColumn("longitude", F.col("longitude").cast("double"))


@query
def job_bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = scratch_path(spark, "silver")
    bronze_to_silver(spark, bronze_of(spark, sf_dir, "lineitem"), silver, LOCATIONS)
    return layers.read_silver(spark, silver, LOCATIONS)


@query
def job_silver_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = scratch_path(spark, "gold")
    silver_to_gold(spark, silver_of(spark, sf_dir, "part"), gold, LOCATIONS)
    return layers.read_gold(spark, gold, LOCATIONS)


@query
def job_incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A count of all leaves, a load that replaces some, and a count of only those."""
    path, gold, parts = (scratch_path(spark, name) for name in ("silver", "gold", "gold_parts"))
    cleaned = clean_locations(spark, sf_dir, "lineitem")
    write_silver(cleaned, path, LOCATIONS)
    silver_to_gold(spark, path, gold, LOCATIONS, parts_path=parts)
    load = cleaned.filter("state = 'A' AND city LIKE 'F/%'").withColumn("brewery_type", F.lit("new"))
    write_silver(load, path, LOCATIONS, keep_other_leaves=True)
    silver_to_gold(spark, path, gold, LOCATIONS, parts_path=parts)
    return layers.read_gold(spark, gold, LOCATIONS)


@query
def job_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "layers")
    build_layers(spark, order_responses(spark, sf_dir), root, LOCATIONS)
    return layers.read_gold(spark, layer_paths(root)["gold"], LOCATIONS)
