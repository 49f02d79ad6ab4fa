"""The same results in ANSI SQL, for DuckDB over the same Parquet tables."""

from __future__ import annotations

# Rules of the validation queries; a NULL outcome is a failure.
_QUANTITY = "COALESCE(l_quantity >= 5, FALSE)"
_DISCOUNT = "COALESCE(l_discount > 0, FALSE)"
_TAX = "COALESCE(l_tax <= CAST(0.06 AS DOUBLE), FALSE)"
_VALID = f"({_QUANTITY} AND {_DISCOUNT} AND {_TAX})"
_REASONS = (
    f"concat_ws(',', CASE WHEN NOT {_QUANTITY} THEN 'l_quantity' END, "
    f"CASE WHEN NOT {_DISCOUNT} THEN 'l_discount' END, "
    f"CASE WHEN NOT {_TAX} THEN 'l_tax' END)"
)
_REASON_COUNT = (
    f"(CASE WHEN {_QUANTITY} THEN 0 ELSE 1 END + CASE WHEN {_DISCOUNT} THEN 0 ELSE 1 END"
    f" + CASE WHEN {_TAX} THEN 0 ELSE 1 END)"
)

_UTC = "timezone('UTC', timezone('America/New_York', ts))"

_UPSERT = """
WITH target AS (
    SELECT *, TIMESTAMP '2020-01-01 00:00:00' AS created_at, TRUE AS hit
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
), source AS (
    SELECT o_orderkey, o_custkey, o_totalprice + 1000 AS o_totalprice, o_orderdate, o_orderpriority,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS o_orderstatus,
           TIMESTAMP '2024-01-01 00:00:00' AS created_at, TRUE AS hit
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
)
SELECT CASE WHEN s.hit THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN s.hit THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.hit THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.hit THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.hit THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN s.hit THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
       CASE WHEN t.hit THEN t.created_at ELSE s.created_at END AS created_at
FROM target t FULL JOIN source s ON t.o_orderkey = s.o_orderkey
"""

_STAGED_FILES = """
    SELECT 'customer.parquet' AS source_file_name, COUNT(*) AS row_count FROM customer
    UNION ALL SELECT 'supplier.parquet', COUNT(*) FROM supplier
    UNION ALL SELECT 'orders.parquet', COUNT(*) FROM orders
"""

_LOADED = """
    SELECT 'stg_orders' AS table_name, 'orders.parquet' AS file_name, COUNT(*) AS n
    FROM orders WHERE o_totalprice > 1000 AND o_orderstatus <> 'P'
    UNION ALL SELECT 'stg_customer', 'customer.parquet', COUNT(*) FROM customer
    UNION ALL SELECT 'stg_lineitem', 'lineitem.parquet', COUNT(*) FROM lineitem WHERE l_quantity > 10
"""

_LOG_OF_ONE_RUN = """
    SELECT table_name, 'success' AS status, n AS records_processed,
           CAST(0 AS BIGINT) AS records_failed, 'File ' || file_name AS message FROM loaded
    UNION ALL
    SELECT table_name, 'success', n, 0, '1 new files, ' || n || ' rows.' FROM loaded
"""

ORACLES = {
    "scan_formats": """
        SELECT f.file_format, c.* FROM customer c
        CROSS JOIN (VALUES ('parquet'), ('orc'), ('json'), ('csv'), ('xml'), ('text')) f(file_format)
    """,
    "scan_csv_options": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer
    """,
    "scan_parquet_select": """
        SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_quantity * 2 AS DOUBLE) AS twice
        FROM lineitem WHERE l_quantity > 10 AND l_returnflag = 'R'
    """,
    "filter_clauses": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag
        FROM lineitem WHERE l_quantity > 10 AND l_returnflag = 'R'
    """,
    "scan_table": "SELECT * FROM orders",
    "registry_active_sources": """
        SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'view')
    """,
    "load_new_files": "SELECT * FROM orders",
    "load_by_manifest": """
        WITH counts AS (
            SELECT count(*) FILTER (o_orderkey % 3 <> 2) AS first,
                   count(*) FILTER (o_orderkey % 3 = 2 OR (o_orderkey % 3 = 1 AND o_orderkey % 2 = 0)) AS second
            FROM orders
        )
        SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
               (o_orderkey % 3) || '.parquet' AS source_file_name
        FROM orders WHERE o_orderkey % 3 <> 1 OR o_orderkey % 2 = 0
        UNION ALL SELECT 0, NULL, '2 new, 0 changed, ' || first || ' rows' FROM counts
        UNION ALL SELECT -1, NULL, '1 new, 1 changed, ' || second || ' rows' FROM counts
        UNION ALL SELECT -2, NULL, '0 new, 0 changed, 0 rows'
    """,
    "load_rescued": """
        WITH loaded AS (SELECT *, o_orderkey % 7 = 0 AS bad FROM orders WHERE o_orderkey % 3 <> 2)
        SELECT 'o_totalprice' AS what, count(*) AS n FROM loaded WHERE bad
        UNION ALL SELECT 'o_custkey', count(*) FROM loaded WHERE o_orderkey % 5 = 0
        UNION ALL SELECT 'o_orderpriority', count(*) FROM loaded WHERE o_orderkey % 2 = 0
        UNION ALL SELECT 'rows', count(*) FROM loaded
        UNION ALL SELECT 'prices', count(*) FROM loaded WHERE NOT bad
        UNION ALL SELECT 'comments', 0
        UNION ALL SELECT 'refused files', 1
    """,
    "month_slice": """
        SELECT * FROM orders WHERE date_trunc('month', o_orderdate) = TIMESTAMP '1998-03-01 00:00:00'
    """,
    "stage_with_lineage": """
        SELECT o_orderkey, o_orderdate, o_totalprice, TRUE AS has_loaded_at, TRUE AS from_orders,
               TRUE AS has_file_name, TRUE AS has_modified_at
        FROM orders
    """,
    "strip_suffix": f"SELECT event_id, {_UTC} AS ts, user_id, event_type, value FROM events",
    "conform_columns": "SELECT event_type, event_id, value FROM events",
    "audit_fill": """
        SELECT c_custkey, TRUE AS is_active, TIMESTAMP '2020-01-02 03:04:05' AS created_at,
               TRUE AS has_updated_at
        FROM customer
    """,
    "join_lookup": """
        SELECT c_custkey, c_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
    "file_load_stats": f"""
        SELECT source_file_name, row_count, TRUE AS has_modified_at FROM ({_STAGED_FILES}) f
    """,
    "load_counts": """
        SELECT 'customer' AS table_name, COUNT(*) AS rows_observed, COUNT(*) AS rows_written FROM customer
        UNION ALL SELECT 'orders', COUNT(*), COUNT(*) FROM orders
        UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*) FROM lineitem
    """,
    "grouped_sum": """
        SELECT event_type, ROUND(SUM(value), 2) AS total_value FROM events GROUP BY event_type
    """,
    "dedup_keys": """
        SELECT l_orderkey, l_linenumber, TRUE AS is_a_source_row
        FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) keys
    """,
    "dedup_latest": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC NULLS LAST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                         l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
                         l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST
            ) AS rn FROM lineitem
        ) ranked WHERE rn = 1
    """,
    "append_evolve": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal,
               CASE WHEN NOT COALESCE(c_acctbal < 0, FALSE) THEN c_mktsegment END AS c_mktsegment,
               CASE WHEN c_acctbal < 0 THEN 'owing' END AS c_risk
        FROM customer
    """,
    "evolve_order": """
        SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_acctbal END AS c_acctbal,
               'c_custkey,c_name,c_mktsegment,c_acctbal,is_active,created_at' AS column_order
        FROM customer
    """,
    "upsert_merge": _UPSERT,
    "upsert_table": _UPSERT,
    "upsert_partitioned": _UPSERT,
    "upsert_by_day": _UPSERT,
    "upsert_csv_table": _UPSERT,
    "upsert_bucketed": _UPSERT,
    "append_once": "SELECT * FROM customer",
    "upsert_history": """
        WITH said AS (
            SELECT o_custkey, o_orderstatus, o_orderdate + to_seconds(o_orderkey) AS valid_from FROM orders
        ), changes AS (
            SELECT * FROM said
            QUALIFY o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY valid_from)
                 OR row_number() OVER (PARTITION BY o_custkey ORDER BY valid_from) = 1
        )
        SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to,
               lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) IS NULL AS is_active
        FROM changes
    """,
    "migrate_table": """
        SELECT CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey ELSE l_orderkey + 10000000000 END AS l_orderkey,
               l_linenumber, l_suppkey, CASE WHEN l_orderkey % 2 <> 0 THEN l_returnflag END AS l_returnflag,
               '1.1.0 l_returnflag,l_orderkey,l_suppkey' AS changes
        FROM lineitem
    """,
    "stream_upsert": """
        WITH versions AS (
            SELECT o_orderkey, o_orderstatus, o_totalprice, 10 * n AS version
            FROM orders, (SELECT unnest([0, 1, 2]) AS n) WHERE o_orderkey % 3 <> n
        ), arrived AS (
            SELECT * FROM versions
            UNION ALL SELECT * REPLACE (version + 5 AS version) FROM versions WHERE o_orderkey % 2 = 0
            UNION ALL SELECT * REPLACE (version - 8 AS version) FROM versions WHERE o_orderkey % 5 = 0
        )
        SELECT o_orderkey, o_orderstatus, o_totalprice + version AS o_totalprice, version FROM arrived
        QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1
    """,
    "upsert_audit": """
        SELECT c_custkey, c_name, TRUE AS is_active, TRUE AS created_before_updated FROM customer
    """,
    "load_log": f"""
        WITH files AS ({_STAGED_FILES})
        SELECT 'run-1' AS execution_id, 'shop' AS source_system, 'stg_keys' AS table_name,
               'success' AS status, row_count AS records_processed,
               CAST(0 AS BIGINT) AS records_failed, 'File ' || source_file_name AS message
        FROM files
        UNION ALL
        SELECT 'run-1', 'shop', 'stg_keys', 'success', CAST(SUM(row_count) AS BIGINT), 0,
               COUNT(*) || ' new files, ' || SUM(row_count) || ' rows.'
        FROM files
    """,
    "dataset_chain": """
        SELECT o_orderpriority, ROUND(SUM(o_totalprice), 2) AS total_price
        FROM orders GROUP BY o_orderpriority
    """,
    "metadata_load": f"""
        WITH loaded AS ({_LOADED}) {_LOG_OF_ONE_RUN}
        UNION ALL
        SELECT table_name, 'success', 0, 0, 'No new rows.' FROM loaded
    """,
    "metadata_load_rows": f"""
        SELECT o_orderkey, {_UTC.replace("ts))", "o_orderdate))")} AS o_orderdate_utc
        FROM orders WHERE o_totalprice > 1000 AND o_orderstatus <> 'P'
    """,
    "metadata_load_types": """
        SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem
    """,
    "gated_write": f"""
        SELECT 'accepted' AS outcome, COUNT(*) FILTER (WHERE {_VALID} AND l_quantity IS NOT NULL
               AND l_discount IS NOT NULL AND l_tax IS NOT NULL) AS row_count FROM lineitem
        UNION ALL SELECT 'l_quantity_min_check', COUNT(*) FILTER (WHERE NOT (l_quantity >= 5)) FROM lineitem
        UNION ALL SELECT 'l_discount_custom_check', COUNT(*) FILTER (WHERE NOT (l_discount > 0)) FROM lineitem
        UNION ALL SELECT 'l_tax_max_check', COUNT(*) FILTER (WHERE NOT (l_tax <= CAST(0.06 AS DOUBLE))) FROM lineitem
    """,
    "zone_load": """
        SELECT o_orderkey, c_name, c_mktsegment, ROUND(o_custkey + (1 + SQRT(o_totalprice) / 1000) / 3, 4) AS longitude,
               ROUND(o_orderkey + (1 + SQRT(o_totalprice) / 1000) / 3, 4) AS latitude
        FROM orders JOIN customer ON o_custkey = c_custkey
        UNION ALL SELECT COUNT(*), 'log', 'success', NULL, NULL FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "metadata_load_sql": f"WITH loaded AS ({_LOADED}) {_LOG_OF_ONE_RUN}",
    "refine_table": f"""
        WITH judged AS (
            SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
                   concat_ws(',', CASE WHEN l_orderkey IS NULL THEN 'l_orderkey' END,
                             CASE WHEN NOT COALESCE(l_linenumber >= 1, FALSE) THEN 'l_linenumber' END,
                             CASE WHEN NOT {_VALID} THEN {_REASONS} END) AS reasons
            FROM lineitem
        ), ranked AS (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_quantity DESC, l_discount DESC, l_tax DESC) AS place
            FROM judged WHERE reasons = ''
        ), outcome AS (
            SELECT * EXCLUDE (place, reasons), CASE WHEN place > 1 THEN 'duplicate key' ELSE '' END AS reasons
            FROM ranked
            UNION ALL SELECT * FROM judged WHERE reasons <> ''
        )
        SELECT CASE WHEN reasons = '' THEN 'clean' ELSE 'quarantined' END AS outcome,
               l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, reasons
        FROM outcome
        UNION ALL
        SELECT 'log', COUNT(*), CAST(COUNT(*) FILTER (WHERE reasons <> '') AS INTEGER), NULL, NULL, NULL, 'success'
        FROM outcome
    """,
    "validate_flag": f"SELECT *, {_VALID} AS is_row_valid FROM lineitem",
    "validate_reasons": f"""
        SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, {_VALID} AS is_row_valid,
               {_REASONS} AS reasons, {_REASON_COUNT} AS reason_count
        FROM lineitem
    """,
    "clean_rows": f"SELECT * FROM lineitem WHERE {_VALID}",
    "quarantine_rows": f"""
        SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, {_VALID} AS is_row_valid,
               {_REASONS} AS reasons
        FROM lineitem WHERE NOT {_VALID}
    """,
    "validation_summary": f"""
        SELECT 'l_quantity' AS column_name, COUNT(*) FILTER (WHERE NOT {_QUANTITY}) AS failed_rows FROM lineitem
        UNION ALL SELECT 'l_discount', COUNT(*) FILTER (WHERE NOT {_DISCOUNT}) FROM lineitem
        UNION ALL SELECT 'l_tax', COUNT(*) FILTER (WHERE NOT {_TAX}) FROM lineitem
        UNION ALL SELECT '*', COUNT(*) FILTER (WHERE NOT {_VALID}) FROM lineitem
    """,
    "constraint_violations": """
        SELECT 'l_quantity_not_null' AS constraint_name,
               COUNT(*) FILTER (WHERE l_quantity IS NULL) AS violations FROM lineitem
        UNION ALL SELECT 'l_discount_not_null', COUNT(*) FILTER (WHERE l_discount IS NULL) FROM lineitem
        UNION ALL SELECT 'l_tax_not_null', COUNT(*) FILTER (WHERE l_tax IS NULL) FROM lineitem
        UNION ALL SELECT 'l_quantity_min_check' AS constraint_name,
               COUNT(*) FILTER (WHERE NOT (l_quantity >= 5)) AS violations FROM lineitem
        UNION ALL SELECT 'l_discount_custom_check', COUNT(*) FILTER (WHERE NOT (l_discount > 0)) FROM lineitem
        UNION ALL SELECT 'l_tax_max_check',
               COUNT(*) FILTER (WHERE NOT (l_tax <= CAST(0.06 AS DOUBLE))) FROM lineitem
    """,
    "schema_drift": """
        SELECT 'type_mismatch' AS kind, 'o_custkey' AS column_name, 'int' AS expected_type,
               'bigint' AS actual_type,
               COUNT(*) FILTER (WHERE o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS INTEGER) IS NULL) AS bad_rows
        FROM orders
        UNION ALL
        SELECT 'type_mismatch', 'o_orderpriority', 'int', 'string',
               COUNT(*) FILTER (WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL)
        FROM orders
        UNION ALL SELECT 'missing_in_source', 'o_clerk', 'string', NULL, NULL
        UNION ALL SELECT 'unexpected_in_source', 'o_orderstatus', NULL, 'string', NULL
    """,
    "tz_to_utc": f"SELECT event_id, {_UTC} AS ts_utc, user_id FROM events",
    "tz_keep_name": f"SELECT event_id, {_UTC} AS ts FROM events",
    "tz_cast": """
        SELECT event_id, 'timestamp' AS ts_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events
    """,
    "zone_centroid": """
        WITH zones AS (
            SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS x, CAST(o_orderkey AS DOUBLE) AS y,
                   o_orderstatus, 1 + sqrt(o_totalprice) / 1000 AS size
            FROM orders
        ), placed AS (
            SELECT o_orderkey, x, y, CASE o_orderstatus
                WHEN 'F' THEN size * 30.5 / 15
                WHEN 'P' THEN 8 + 0.9 * size
                ELSE size / 3 END AS shift
            FROM zones
        )
        SELECT o_orderkey, round(x + shift, 4) AS longitude, round(y + shift, 4) AS latitude FROM placed
    """,
}
