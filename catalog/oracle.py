"""The same results in plain SQL over the same tables, written apart from the Spark code."""

from __future__ import annotations

from catalog.fixtures import COLLIDING_SELECT, NUMBER_TEXT_SELECT, RAW_SELECTS
from siltstone.spec import LOCATIONS

_EDGE = r"[\t\n\x0b\f\r\x1c-\x1f\x{85}\p{Z}]+"


def _stripped(text: str) -> str:
    return f"regexp_replace({text}, '^{_EDGE}|{_EDGE}$', '', 'g')"


def _replaced(text: str) -> str:
    return rf"regexp_replace({text}, '[<>:\"/\\|?*]', '_', 'g')".replace('\\"', '"')


def _sanitized(text: str) -> str:
    return _replaced(_stripped(text))


def _number(text: str) -> str:
    decimal = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
    return (
        f"CASE WHEN regexp_matches({text}, '{decimal}') AND NOT isinf(TRY_CAST({text} AS DOUBLE)) "
        f"THEN TRY_CAST({text} AS DOUBLE) END"
    )


def _raw(name: str) -> str:
    return f"SELECT {RAW_SELECTS[name]} FROM {name}"


def _clean(name: str) -> str:
    strings = ", ".join(f"coalesce({c}, '') AS {c}" for c in LOCATIONS.strings)
    numbers = ", ".join(f"{_number(c)} AS {c}" for c in LOCATIONS.numeric)
    return f"SELECT {strings}, {numbers} FROM ({_raw(name)})"


def _silver(name: str) -> str:
    keys = ", ".join(f"{_sanitized(c)} AS {c}_clean" for c in LOCATIONS.partition_by)
    return f"SELECT *, {keys} FROM ({_clean(name)})"


def _gold(name: str) -> str:
    return (
        f"SELECT state, city, brewery_type, count(*) AS brewery_count "
        f"FROM ({_clean(name)}) GROUP BY ALL"
    )


_COLLIDING = f"SELECT {COLLIDING_SELECT} FROM part"
_COLLIDING_KEYED = (
    f"SELECT *, {_sanitized('state')} AS state_clean, {_sanitized('city')} AS city_clean "
    f"FROM ({_COLLIDING})"
)
_PADDED_URL = "concat(' ', chr(9), url, chr(133))"
_ALL = ", ".join(LOCATIONS.columns)

ORACLE: dict[str, str] = {
    "src_json_array_scan": """
        SELECT event_id, nullif(event_type, 'error') AS event_type, value,
               replace(props, ' ', '') AS nested
        FROM events""",
    "src_record_key_union": """
        SELECT event_id, nullif(event_type, 'error') AS event_type,
               CASE WHEN value > 100 THEN value END AS high,
               CASE WHEN value <= 100 THEN value END AS low
        FROM events""",
    "src_partitioned_scan": f"SELECT {_ALL} FROM ({_clean('part')})",
    "src_merge_schema_scan": """
        SELECT o_orderkey, o_orderpriority, CAST(NULL AS VARCHAR) AS o_orderstatus FROM orders
        UNION ALL
        SELECT o_orderkey, NULL, o_orderstatus FROM orders""",
    "src_empty_input_guard": f"""
        WITH silver AS ({_silver('lineitem')})
        SELECT 'gold' AS layer, 'written' AS status, count(*) AS n_rows,
               (SELECT count(*) FROM (SELECT DISTINCT state_clean, city_clean FROM silver)) AS n_leaves,
               CAST(NULL AS BIGINT) AS bad_numbers
        FROM silver
        UNION ALL
        SELECT 'gold', 'skipped', 0, NULL, NULL""",
    "src_page_ingest": """
        SELECT CAST(event_id // 50 + 1 AS BIGINT) AS page, CAST(event_id % 50 AS INTEGER) AS pos,
               event_id, user_id, nullif(event_type, 'error') AS event_type, value
        FROM events""",
    "src_page_running_total": """
        WITH counted AS (
            SELECT CAST(event_id // 50 + 1 AS BIGINT) AS page, count(*) AS n
            FROM events GROUP BY 1)
        SELECT page, n, CAST(sum(n) OVER (ORDER BY page) AS BIGINT) AS running_total
        FROM counted""",
    "snk_json_landing_roundtrip": """
        SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value, props,
               CAST(NULL AS VARCHAR) AS note
        FROM events""",
    "snk_partitioned_roundtrip": _silver("lineitem"),
    "snk_dynamic_overwrite": f"""
        SELECT * REPLACE (CASE WHEN state IN ('SMALL', 'LARGE') THEN upper(name) ELSE name END
                          AS name)
        FROM ({_silver('part')})""",
    "snk_static_overwrite": f"""
        SELECT * REPLACE (upper(name) AS name)
        FROM ({_silver('part')}) WHERE state IN ('SMALL', 'LARGE')""",
    "snk_gold_roundtrip": _gold("lineitem"),
    "snk_skip_if_complete": f"""
        WITH leaves AS (SELECT DISTINCT state_clean, city_clean FROM ({_silver('orders')}))
        SELECT layer, 'written' AS status, (SELECT count(*) FROM orders) AS n_rows,
               CASE WHEN layer <> 'bronze' THEN (SELECT count(*) FROM leaves) END AS n_leaves,
               CASE WHEN layer = 'silver'
                    THEN (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') END AS bad_numbers,
               1 AS run
        FROM (VALUES ('bronze'), ('silver'), ('gold')) AS layers(layer)
        UNION ALL
        SELECT layer, 'skipped', NULL, NULL, NULL, 2
        FROM (VALUES ('bronze'), ('silver'), ('gold')) AS layers(layer)""",
    "prj_select_columns": f"SELECT {_ALL} FROM ({_raw('lineitem')})",
    "prj_derived_keys": f"""
        SELECT id, state, city, state_clean, city_clean FROM ({_silver('lineitem')})""",
    "flt_partition_pruned": f"""
        SELECT id, state, city, longitude FROM ({_clean('lineitem')})
        WHERE state = 'A' AND city = 'O/3 '""",
    "flt_point_read": f"""
        SELECT id, state, postal_code FROM ({_clean('lineitem')})
        WHERE id IN ('1-1', '7-2', '32-5', 'no such') OR postal_code = '17'""",
    "src_type_drift": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               CASE WHEN l_linenumber < 4 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE)
                    ELSE l_extendedprice END AS l_quantity,
               CASE WHEN l_linenumber < 4 THEN CAST(l_suppkey AS VARCHAR)
                    ELSE concat('P', CAST(l_suppkey AS VARCHAR)) END AS part,
               CASE WHEN l_linenumber < 4 THEN l_returnflag END AS l_returnflag,
               CASE WHEN l_linenumber >= 4 THEN l_linestatus END AS l_linestatus
        FROM lineitem""",
    "cln_cast_string": """
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
               CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag
        FROM lineitem""",
    "cln_cast_double": """
        SELECT l_orderkey, l_linenumber, l_extendedprice AS price FROM lineitem""",
    "cln_lenient_numeric": f"""
        SELECT event_id, {_number('number_text')} AS number
        FROM (SELECT {NUMBER_TEXT_SELECT} FROM events)""",
    "cln_fill_blank_strings": f"""
        SELECT {', '.join(LOCATIONS.strings)} FROM ({_clean('lineitem')})""",
    "str_strip": f"""
        SELECT doc_id, {_stripped('text')} AS stripped FROM documents""",
    "str_replace_unsafe_chars": f"""
        SELECT page_id, {_replaced('html')} AS replaced FROM pages""",
    "str_sanitize_name": f"""
        SELECT page_id, {_sanitized(_PADDED_URL)} AS name_clean FROM pages""",
    "str_partition_path": f"""
        SELECT id, concat('state=', state_clean, '/city=', city_clean) AS leaf
        FROM ({_silver('lineitem')})""",
    "udf_sanitize_name": f"""
        SELECT page_id, {_sanitized(_PADDED_URL)} AS name_clean FROM pages""",
    "agg_count_by_location": _gold("lineitem"),
    "agg_layer_row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "agg_leaf_count": """
        SELECT count(*) AS n_rows, count(DISTINCT (p_type, p_brand)) AS n_leaves FROM part""",
    "agg_file_count": "SELECT count(DISTINCT (p_type, p_brand)) AS n_files FROM part",
    "dq_row_fingerprint": f"""
        WITH cleaned AS ({_clean('lineitem')}),
        swapped AS (SELECT * FROM cleaned WHERE id <> (SELECT min(id) FROM cleaned)
                    UNION ALL SELECT * FROM cleaned WHERE id = (SELECT max(id) FROM cleaned))
        SELECT 'shuffled' AS compared, count(*) AS n_rows, true AS same_rows FROM cleaned
        UNION ALL
        SELECT 'swapped', (SELECT count(*) FROM swapped),
               NOT EXISTS (FROM cleaned EXCEPT ALL FROM swapped)""",
    "agg_leaf_manifest": f"""
        SELECT state, city, count(*) AS n_rows FROM ({_clean('lineitem')}) GROUP BY ALL""",
    "agg_null_key_rule": """
        WITH kinds AS (SELECT nullif(event_type, 'error') AS kind FROM events)
        SELECT kind, count(*) AS n, 'keep' AS rule FROM kinds GROUP BY kind
        UNION ALL
        SELECT kind, count(*), 'drop' FROM kinds WHERE kind IS NOT NULL GROUP BY kind""",
    "agg_cities_per_state": f"""
        SELECT state, count(DISTINCT city) AS cities FROM ({_clean('lineitem')}) GROUP BY ALL""",
    "ord_sorted_gold": f"{_gold('part')} ORDER BY state, city, brewery_type",
    "ord_preview": f"{_gold('part')} ORDER BY state, city, brewery_type LIMIT 5",
    "ord_page_position": """
        SELECT CAST(event_id // 50 + 1 AS BIGINT) AS page, CAST(event_id % 50 AS INTEGER) AS pos,
               event_id
        FROM events ORDER BY page, pos""",
    "set_union_by_name": """
        SELECT l_orderkey AS orderkey, l_quantity FROM lineitem
        UNION ALL BY NAME SELECT o_orderkey AS orderkey, o_orderstatus FROM orders
        UNION ALL BY NAME SELECT l_returnflag, l_orderkey AS orderkey FROM lineitem""",
    "win_collision_last_wins": f"""
        SELECT id, state, city, brewery_type FROM ({_COLLIDING_KEYED})
        QUALIFY dense_rank() OVER (PARTITION BY state_clean, city_clean
                                   ORDER BY state DESC, city DESC) = 1""",
    "dq_null_keys": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"count(*) FILTER (WHERE {c} = '') AS blank_count FROM ({_raw('lineitem')})"
        for c in (*LOCATIONS.group_by, "country", "phone")
    ),
    "dq_duplicate_rows": """
        SELECT *, count(*) AS n FROM (
            FROM lineitem UNION ALL FROM lineitem WHERE l_quantity > 40
            UNION ALL FROM lineitem WHERE l_quantity > 48)
        GROUP BY ALL HAVING count(*) > 1""",
    "dq_duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "dq_type_validation": f"""
        SELECT 'value_text' AS column_name, 'double' AS type_name, CAST(0 AS BIGINT) AS bad_rows
        UNION ALL SELECT 'value_text', 'string', 0
        UNION ALL SELECT 'number_text', 'double', count(*)
            FROM (SELECT {NUMBER_TEXT_SELECT} FROM events) WHERE {_number('number_text')} IS NULL
        UNION ALL SELECT 'kind', 'double', count(*) FROM events WHERE event_type <> 'error'
        UNION ALL SELECT 'kind', 'date', count(*) FROM events WHERE event_type <> 'error'
        UNION ALL SELECT 'day_text', 'date', count(*) FROM events WHERE event_type = 'click'
        UNION ALL SELECT 'day_text', 'double', count(*) FROM events""",
    "dq_totals_consistent": """
        SELECT count(*) AS bronze_rows, count(*) AS silver_rows, count(*) AS gold_rows,
               true AS consistent
        FROM lineitem""",
    "dq_date_range": """
        SELECT min(o_orderdate) AS first_value, max(o_orderdate) AS last_value,
               count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1996-01-01'
                                OR o_orderdate > TIMESTAMP '2000-12-31') AS out_of_range
        FROM orders""",
    "dq_required_columns": """
        SELECT 'event_id' AS column_name, count(*) AS records, false AS missing FROM events
        UNION ALL SELECT 'event_type', count(*), false FROM events WHERE event_type <> 'error'
        UNION ALL SELECT 'value', count(*), false FROM events
        UNION ALL SELECT 'country', 0, true""",
    "dq_non_empty": """
        SELECT 'gold' AS subject, count(*) > 0 AS non_empty FROM lineitem
        UNION ALL SELECT 'empty groups', false""",
    "dq_layout": f"""
        SELECT state_clean, count(*) AS leaves, CAST(sum(leaf_rows) AS BIGINT) AS n_rows,
               min(leaf_rows) AS smallest_leaf, min(leaf_rows) > 0 AS ok
        FROM (SELECT state_clean, city_clean, count(*) AS leaf_rows
              FROM ({_silver('lineitem')}) GROUP BY ALL
              UNION ALL SELECT 'A', 'no rows + 100%', 0)
        GROUP BY ALL""",
    "dq_key_collisions": f"""
        SELECT state_clean, city_clean, count(DISTINCT (state, city)) AS raw_pairs,
               count(*) AS n_rows
        FROM ({_COLLIDING_KEYED}) GROUP BY ALL HAVING count(DISTINCT (state, city)) > 1""",
    "dq_gate_report": f"""
        WITH raw AS ({_raw('lineitem')}), found AS (
        SELECT 'null_keys' AS check_name, 'id' AS subject,
               count(*) FILTER (WHERE id IS NULL) AS bad_rows, 0 AS allowed FROM raw
        UNION ALL SELECT 'null_keys', 'phone', count(*) FILTER (WHERE phone IS NULL), 0 FROM raw
        UNION ALL SELECT 'null_keys', 'state', count(*) FILTER (WHERE state IS NULL), 0 FROM raw
        UNION ALL SELECT 'blank_keys', 'id', count(*) FILTER (WHERE id = ''), 0 FROM raw
        UNION ALL SELECT 'blank_keys', 'phone', count(*) FILTER (WHERE phone = ''), 0 FROM raw
        UNION ALL SELECT 'blank_keys', 'state', count(*) FILTER (WHERE state = ''), 0 FROM raw
        UNION ALL SELECT 'duplicates', 'id', count(*) - count(DISTINCT id), 0 FROM raw
        UNION ALL SELECT 'types', c || ':double', count(*) FILTER (WHERE t IS NOT NULL AND {_number('t')} IS NULL), 5
            FROM (SELECT 'postal_code' AS c, postal_code AS t FROM raw
                  UNION ALL SELECT 'longitude', longitude FROM raw) GROUP BY c
        UNION ALL SELECT 'date_range', 'o_orderdate',
            count(*) FILTER (WHERE o_orderdate NOT BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1997-01-01'), 0
            FROM orders)
        SELECT check_name, subject, bad_rows, false AS passed FROM found WHERE bad_rows > allowed""",
    "job_ingest_bronze": f"""
        SELECT * REPLACE (CAST(longitude AS DOUBLE) AS longitude) FROM ({_raw('orders')})""",
    "job_bronze_to_silver": _silver("lineitem"),
    "job_silver_to_gold": _gold("part"),
    "job_incremental_gold": f"""
        SELECT state, city,
               CASE WHEN state = 'A' AND city LIKE 'F/%' THEN 'new' ELSE brewery_type END
                   AS brewery_type,
               count(*) AS brewery_count
        FROM ({_clean('lineitem')}) GROUP BY ALL""",
    "job_medallion": _gold("orders"),
}
