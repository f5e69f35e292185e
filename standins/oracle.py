"""The same results in plain SQL over the given tables."""

_MANIFEST = """inv AS (
  SELECT 'SALES_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS file_nm, 11 AS exp_cols, count(*) AS exp_rows
  FROM orders GROUP BY o_orderdate HAVING count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) > 0)"""

_LANDED = """landed AS (
  SELECT 'sales_' || strftime(o_orderdate, '%Y%m%d') || '.CSV' AS file_nm,
         CASE WHEN min(l_quantity) > 3 THEN 10 ELSE 11 END AS act_cols,
         count(DISTINCT l_orderkey) AS act_rows
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_orderdate HAVING max(l_quantity) > 45)"""

_VERDICT = f"""{_MANIFEST},
{_LANDED},
v AS (
  SELECT l.file_nm, i.file_nm IS NOT NULL AS listed, i.exp_cols, i.exp_rows, l.act_cols, l.act_rows
  FROM landed l LEFT JOIN inv i ON upper(l.file_nm) = upper(i.file_nm)),
f AS (
  SELECT *, CASE WHEN NOT listed THEN 1
            ELSE (CASE WHEN exp_cols IS DISTINCT FROM act_cols THEN 1 ELSE 0 END)
               + (CASE WHEN exp_rows IS DISTINCT FROM act_rows THEN 1 ELSE 0 END) END AS n_failed
  FROM v)"""

_COUNT_CHECKS = """
SELECT file_nm, 'COLUMN_COUNT' AS check_nm, CAST(exp_cols AS VARCHAR) AS expected_val,
       CAST(act_cols AS VARCHAR) AS actual_val,
       CASE WHEN exp_cols IS NOT DISTINCT FROM act_cols THEN 'PASS' ELSE 'FAIL' END AS check_status,
       'Header columns vs inventory COL_CNT' AS check_msg
FROM v WHERE listed
UNION ALL
SELECT file_nm, 'ROW_COUNT', CAST(exp_rows AS VARCHAR), CAST(act_rows AS VARCHAR),
       CASE WHEN exp_rows IS NOT DISTINCT FROM act_rows THEN 'PASS' ELSE 'FAIL' END,
       'Data rows in file vs inventory ROW_CNT'
FROM v WHERE listed"""

_STEPS = """jl AS (
  SELECT event_id AS seq, user_id AS job_run_id, 'FILE_' || strftime(ts, '%Y%m%d') AS file_nm,
         CASE event_type WHEN 'signup' THEN 'VALIDATION' WHEN 'purchase' THEN 'TABLE_LOAD'
              WHEN 'view' THEN 'VIEW_REFRESH' WHEN 'click' THEN 'ARCHIVE'
              WHEN 'error' THEN 'FILE_MISSING' END AS step_nm,
         CASE WHEN value < 10 THEN 'RUNNING' WHEN value < 30 THEN 'SUCCESS'
              WHEN value < 60 THEN 'FAILED' ELSE 'SKIPPED' END AS status,
         event_id AS row_cnt, event_type AS target_object, props AS error_msg, ts AS start_ts,
         CASE WHEN value < 10 THEN NULL ELSE ts END AS end_ts
  FROM events)"""

_ORDER_TABLES = """t AS (
  SELECT *, 'ORD_' || o_orderstatus || '_' || strftime(o_orderdate, '%Y%m%d') AS table_nm FROM orders),
latest AS (
  SELECT regexp_replace(table_nm, '_[0-9]{8}$', '') AS base_nm, max(table_nm) AS latest_table
  FROM t WHERE regexp_full_match(table_nm, '.*_[0-9]{8}') GROUP BY 1)"""

_PART_VALUES = """u AS (
  SELECT 0 AS pos, 'p_partkey' AS col, CAST(p_partkey AS VARCHAR) AS val FROM part
  UNION ALL SELECT 1, 'p_name', p_name FROM part
  UNION ALL SELECT 2, 'p_brand', p_brand FROM part
  UNION ALL SELECT 3, 'p_type', p_type FROM part
  UNION ALL SELECT 4, 'p_size', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT 5, 'p_retailprice', CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) FROM part),
k AS (
  SELECT *, CASE WHEN regexp_full_match(val, '[+-]?[0-9]+') THEN 1
                 WHEN regexp_full_match(val, '[+-]?[0-9]+[.][0-9]+') THEN 2 ELSE 32 END AS kind
  FROM u WHERE val IS NOT NULL),
p AS (
  SELECT pos, col, bit_or(kind) AS kinds,
         coalesce(max(CASE WHEN kind < 32 THEN length(split_part(ltrim(val, '+-'), '.', 1)) END), 0) AS whole_digits,
         coalesce(max(CASE WHEN kind = 2 THEN length(split_part(val, '.', 2)) END), 0) AS scale
  FROM k GROUP BY pos, col)"""

_YEARS = """y AS (
  SELECT 'ORDERS_' || CAST(year(o_orderdate) AS VARCHAR) || '0101.csv' AS file_nm, count(*) AS n
  FROM orders GROUP BY 1)"""

_LATE = """s AS (
  SELECT 'ORDERS_' || CAST(year(o_orderdate) + 1 AS VARCHAR) || '0101.csv' AS file_nm, count(*) AS n
  FROM orders GROUP BY 1)"""

ORACLE = {
    "manifest_parse": """
SELECT p_partkey, trim(p_name) AS file_nm, CAST(NULL AS DECIMAL(38,0)) AS col_cnt,
       TRY_CAST(trim(CASE WHEN p_brand = 'Brand#1' THEN 'N/A' WHEN p_type = 'ECONOMY' THEN p_size || '.5'
            WHEN p_type = 'PROMO' THEN '' ELSE '  ' || p_size || ' ' END) AS DECIMAL(38,0)) AS row_cnt
FROM part WHERE p_type <> 'SMALL' AND nullif(trim(p_name), '') IS NOT NULL""",
    "folder_listing": """
SELECT page_id, split_part(url, '/', -1) AS file_nm, url AS relative_path FROM pages
WHERE url LIKE 'http%' AND url NOT LIKE 'http://%'
  AND split_part(url, '/', -1) NOT ILIKE 'rds_inventory%' AND split_part(url, '/', -1) <> ''""",
    "inventory_lookup": """
WITH m AS (
  SELECT CASE WHEN o_orderstatus = 'F' THEN 'sales_' ELSE 'SALES_' END || strftime(o_orderdate, '%Y%m%d') || '.csv' AS file_nm,
         count(*) AS row_cnt, count(CASE WHEN o_totalprice > 100000 THEN 1 END) AS col_cnt
  FROM orders GROUP BY o_orderdate, o_orderstatus)
SELECT upper(file_nm) AS file_key, count(*) AS n_listed, max(col_cnt) AS exp_cols, max(row_cnt) AS exp_rows
FROM m GROUP BY 1""",
    "check_file_in_inventory": f"""
WITH {_VERDICT}
SELECT file_nm, 'FILE_IN_INVENTORY' AS check_nm, 'Y' AS expected_val,
       CASE WHEN listed THEN 'Y' ELSE 'N' END AS actual_val,
       CASE WHEN listed THEN 'PASS' ELSE 'FAIL' END AS check_status,
       CASE WHEN listed THEN 'Found in RDS_Inventory_SALES.csv'
            ELSE 'File is in S3 but NOT listed in RDS_Inventory_SALES.csv - not loaded' END AS check_msg
FROM v""",
    "check_column_count": """
SELECT doc_id, CAST(len(string_split(split_part(text, chr(10), 1), ',')) AS INTEGER) AS act_cols FROM documents""",
    "check_row_count": r"""
SELECT doc_id, CAST(greatest(len(list_filter(string_split(text, chr(10)),
       lambda x: regexp_matches(x, '[^\x00-\x20]'))) - 1, 0) AS BIGINT) AS act_rows FROM documents""",
    "audit_count_checks": f"WITH {_VERDICT} {_COUNT_CHECKS}",
    "audit_skipped_checks": f"""
WITH {_VERDICT}
SELECT file_nm, c.check_nm, 'SKIPPED' AS check_status, 'File not in inventory' AS check_msg
FROM v CROSS JOIN (VALUES ('COLUMN_COUNT'), ('ROW_COUNT')) AS c(check_nm) WHERE NOT listed""",
    "validation_step": f"""
WITH {_VERDICT}
SELECT file_nm, CASE WHEN n_failed = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       CASE WHEN n_failed = 0 THEN NULL ELSE n_failed || ' check(s) failed - see OPS.AUDIT_LOG' END AS error_msg
FROM f""",
    "load_gate": f"""
WITH {_VERDICT}
SELECT file_nm, CASE WHEN n_failed = 0 THEN 'LOAD' ELSE 'SKIPPED' END AS decision FROM f""",
    "check_rows_loaded": f"""
WITH {_VERDICT}
SELECT file_nm, CAST(exp_rows AS VARCHAR) AS expected_val, CAST(act_rows AS VARCHAR) AS actual_val,
       CASE WHEN act_rows = exp_rows THEN 'PASS' ELSE 'FAIL' END AS check_status,
       'Rows loaded into ' || split_part(file_nm, '.', 1) AS check_msg
FROM v""",
    "run_summary": f"""
WITH {_VERDICT}
SELECT count(*) AS files_found, count(CASE WHEN n_failed = 0 THEN 1 END) AS files_loaded,
       count(CASE WHEN listed AND n_failed > 0 THEN 1 END) AS files_failed,
       count(CASE WHEN NOT listed THEN 1 END) AS files_not_in_inventory,
       (SELECT count(*) FROM inv i WHERE NOT EXISTS
          (SELECT 1 FROM landed l WHERE upper(l.file_nm) = upper(i.file_nm))) AS files_missing
FROM f""",
    "file_missing": f"""
WITH {_MANIFEST},
{_LANDED},
j AS (
  SELECT 'sales_' || strftime(l_shipdate, '%Y%m%d') || '.csv' AS file_nm, 'TABLE_LOAD' AS step_nm,
         CASE WHEN l_returnflag = 'R' AND l_quantity >= 50 THEN 'SUCCESS' ELSE 'FAILED' END AS status
  FROM lineitem)
SELECT i.file_nm FROM inv i
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE upper(l.file_nm) = upper(i.file_nm))
  AND NOT EXISTS (SELECT 1 FROM j WHERE upper(j.file_nm) = upper(i.file_nm)
                  AND j.step_nm = 'TABLE_LOAD' AND j.status = 'SUCCESS')""",
    "inventory_driven_exists": f"""
WITH {_MANIFEST},
{_LANDED}
SELECT i.file_nm, CASE WHEN count(l.file_nm) > 0 THEN 'PASS' ELSE 'FAIL' END AS check_status
FROM inv i LEFT JOIN landed l ON upper(l.file_nm) = upper(i.file_nm) GROUP BY i.file_nm""",
    "table_and_base_name": f"""
WITH {_LANDED}
SELECT file_nm, upper(split_part(file_nm, '.', 1)) AS table_nm,
       regexp_replace(upper(split_part(file_nm, '.', 1)), '_[0-9]{{8}}$', '') AS base_nm FROM landed""",
    "latest_table": f"WITH {_ORDER_TABLES} SELECT base_nm, latest_table FROM latest",
    "view_over_latest": f"""
WITH {_ORDER_TABLES}
SELECT t.* EXCLUDE (table_nm) FROM t JOIN latest ON t.table_nm = latest.latest_table""",
    "lineage_columns": """
SELECT c.*, 'CRM/CUSTOMER_20240101.csv' AS src_file_nm, TIMESTAMP '2024-01-01 00:00:00' AS load_ts FROM customer c""",
    "load_summary": f"""
WITH {_STEPS}
SELECT job_run_id, file_nm,
       max(CASE WHEN step_nm = 'VALIDATION' THEN status END) AS validation_status,
       max(CASE WHEN step_nm = 'TABLE_LOAD' THEN status END) AS load_status,
       max(CASE WHEN step_nm = 'TABLE_LOAD' THEN row_cnt END) AS rows_loaded,
       max(CASE WHEN step_nm = 'TABLE_LOAD' THEN target_object END) AS target_table,
       max(CASE WHEN step_nm = 'VIEW_REFRESH' THEN status END) AS view_status,
       max(CASE WHEN step_nm = 'VIEW_REFRESH' THEN target_object END) AS target_view,
       max(CASE WHEN step_nm = 'ARCHIVE' THEN status END) AS archive_status,
       max(CASE WHEN step_nm = 'FILE_MISSING' THEN status END) AS missing_status,
       max(error_msg) AS error_msg, min(start_ts) AS start_ts, max(end_ts) AS end_ts,
       date_diff('second', min(start_ts), max(end_ts)) AS duration_sec
FROM jl GROUP BY job_run_id, file_nm""",
    "step_current_state": f"""
WITH {_STEPS},
r AS (SELECT *, row_number() OVER (PARTITION BY job_run_id, file_nm, step_nm ORDER BY seq DESC) AS rn,
             min(seq) OVER (PARTITION BY job_run_id, file_nm, step_nm) AS first_seq,
             min(start_ts) OVER (PARTITION BY job_run_id, file_nm, step_nm) AS first_start FROM jl)
SELECT first_seq, job_run_id, file_nm, step_nm, first_start AS start_ts, status, row_cnt, error_msg, end_ts
FROM r WHERE rn = 1""",
    "error_finalize": f"""
WITH {_STEPS}
SELECT seq, CASE WHEN status = 'RUNNING' THEN 'ERROR' ELSE status END AS status,
       CASE WHEN status = 'RUNNING' THEN left(repeat(error_msg, 200), 1000) ELSE repeat(error_msg, 200) END AS error_msg
FROM jl""",
    "failed_checks": f"""
WITH {_VERDICT}, a AS ({_COUNT_CHECKS})
SELECT 'r' AS job_run_id, 'SALES' AS category, file_nm, check_nm, expected_val, actual_val, check_msg,
       TIMESTAMP '2024-01-01 00:00:00' AS checked_at
FROM a WHERE check_status = 'FAIL'""",
    "per_file_profile": """
SELECT source || '/' || lang AS file_path, count(*) AS actual_row_cnt FROM documents
WHERE regexp_full_match(source || '/' || lang, 'src[0-9]{1,2}/[a-z]+') GROUP BY 1""",
    "schema_template": f"""
WITH {_PART_VALUES}
SELECT string_agg(col || ' ' || CASE WHEN kinds = 1 AND whole_digits <= 9 THEN 'int'
         WHEN kinds = 1 AND whole_digits <= 18 THEN 'bigint' WHEN kinds = 1 THEN 'decimal(38,0)'
         WHEN kinds <= 3 THEN 'decimal(' || (whole_digits + scale) || ',' || scale || ')'
         ELSE 'string' END, ', ' ORDER BY pos) AS ddl FROM p""",
    "column_profile": f"""
WITH {_PART_VALUES}
SELECT pos, kinds, CAST(whole_digits AS INTEGER) AS whole_digits, CAST(scale AS INTEGER) AS scale FROM p""",
    "current_view_source": """
WITH r AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'hds_vw' WHEN 'O' THEN 'ihp_vw' ELSE 'ops' END AS view_schema,
         'ORD_' || left(o_orderpriority, 1) AS view_name,
         'ORD_' || left(o_orderpriority, 1) || '_' || strftime(o_orderdate, '%Y%m%d') AS points_to,
         o_orderdate AS refreshed_at FROM orders)
SELECT view_schema, view_name, arg_max(points_to, refreshed_at) AS points_to, max(refreshed_at) AS last_refreshed
FROM r WHERE view_schema IN ('hds_vw', 'ihp_vw') GROUP BY view_schema, view_name""",
    "load_latest_view": "SELECT * FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
    "load_audit_log": f"""
WITH {_YEARS}
SELECT file_nm, 'FILE_IN_INVENTORY' AS check_nm, 'Y' AS expected_val, 'Y' AS actual_val, 'PASS' AS check_status FROM y
UNION ALL SELECT file_nm, 'COLUMN_COUNT', '6', '6', 'PASS' FROM y
UNION ALL SELECT file_nm, 'ROW_COUNT', CAST(n AS VARCHAR), CAST(n AS VARCHAR), 'PASS' FROM y
UNION ALL SELECT file_nm, 'ROWS_LOADED', CAST(n AS VARCHAR), CAST(n AS VARCHAR), 'PASS' FROM y""",
    "load_summary_view": f"""
WITH {_YEARS}
SELECT file_nm, 'SUCCESS' AS validation_status, 'SUCCESS' AS load_status, n AS rows_loaded,
       'SUCCESS' AS view_status, 'SUCCESS' AS archive_status, CAST(NULL AS VARCHAR) AS missing_status,
       'Points to ' || split_part(file_nm, '.', 1) AS error_msg FROM y""",
    "load_rejected_result": f"""
WITH {_YEARS}, {_LATE},
j AS (SELECT y.file_nm, s.n AS promised, y.n AS delivered FROM y LEFT JOIN s ON s.file_nm = y.file_nm)
SELECT count(*) AS files_found, count(CASE WHEN promised = delivered THEN 1 END) AS files_loaded,
       count(CASE WHEN promised <> delivered THEN 1 END) AS files_failed,
       count(CASE WHEN promised IS NULL THEN 1 END) AS files_not_in_inventory,
       (SELECT count(*) FROM s WHERE file_nm NOT IN (SELECT file_nm FROM y)) AS files_missing FROM j""",
    "load_rejected_checks": f"""
WITH {_YEARS}, {_LATE}
SELECT y.file_nm, 'ROW_COUNT' AS check_nm, CAST(s.n AS VARCHAR) AS expected_val, CAST(y.n AS VARCHAR) AS actual_val
FROM y JOIN s ON s.file_nm = y.file_nm WHERE s.n <> y.n
UNION ALL SELECT y.file_nm, 'FILE_IN_INVENTORY', 'Y', 'N' FROM y WHERE file_nm NOT IN (SELECT file_nm FROM s)
UNION ALL SELECT s.file_nm, 'FILE_NAME_EXISTS', 'Y', 'N' FROM s WHERE file_nm NOT IN (SELECT file_nm FROM y)""",
    "load_with_errors": f"""
WITH {_YEARS}
SELECT file_nm, step_nm, 'SUCCESS' AS status, CASE WHEN step_nm = 'TABLE_LOAD' THEN n END AS row_cnt
FROM y CROSS JOIN (VALUES ('VALIDATION'), ('TABLE_LOAD'), ('VIEW_REFRESH'), ('ARCHIVE')) t(step_nm)
UNION ALL VALUES ('NATION_20000101.csv', 'VALIDATION', 'SUCCESS', NULL), ('NATION_20000101.csv', 'TABLE_LOAD', 'ERROR', NULL),
                 ('REGION_ALL.csv', 'VALIDATION', 'SUCCESS', NULL),
                 ('REGION_ALL.csv', 'TABLE_LOAD', 'SUCCESS', (SELECT count(*) FROM region)),
                 ('REGION_ALL.csv', 'VIEW_REFRESH', 'ERROR', NULL),
                 ('CANCELLED_20000101.csv', 'VALIDATION', 'SUCCESS', NULL), ('CANCELLED_20000101.csv', 'TABLE_LOAD', 'ERROR', NULL)
UNION ALL
SELECT file_nm, step_nm, 'SUCCESS', CASE WHEN step_nm = 'TABLE_LOAD' THEN n END
FROM (SELECT '_SUPPLIER_20000101.csv' AS file_nm, count(*) AS n FROM supplier UNION ALL SELECT '.PART_20000101.csv', count(*) FROM part)
CROSS JOIN (VALUES ('VALIDATION'), ('TABLE_LOAD'), ('VIEW_REFRESH'), ('ARCHIVE')) t(step_nm)""",
    "load_rerun": """
SELECT 0::BIGINT AS files_found, 0::BIGINT AS files_loaded, 0::BIGINT AS files_failed,
       0::BIGINT AS files_not_in_inventory, 0::BIGINT AS files_missing""",
    "earlier_summary": f"""
WITH {_YEARS}
SELECT file_nm, 'SUCCESS' AS validation_status, 'SUCCESS' AS load_status, n AS rows_loaded, 'SUCCESS' AS view_status FROM y""",
    "history_listing": f"""
WITH {_YEARS}
SELECT 'CATEGORY/History/' || file_nm AS relative_path, true AS has_content FROM y
UNION ALL SELECT 'CATEGORY/RDS_Inventory_CATEGORY.csv', true""",
    "newest_loads": f"""
WITH {_YEARS}
SELECT file_nm, 'SUCCESS' AS load_status, n AS rows_loaded FROM y ORDER BY file_nm DESC LIMIT 3""",
    "log_stamps": f"""
WITH {_YEARS}
SELECT file_nm, step_nm, true AS is_uuid, true AS is_user, true AS is_now
FROM y CROSS JOIN (VALUES ('VALIDATION'), ('TABLE_LOAD'), ('VIEW_REFRESH'), ('ARCHIVE')) t(step_nm)""",
    "current_views": """
SELECT upper(t) AS view_name, 'RDS_DB.CATEGORY.' || upper(t) || '_20240101' AS points_to, count(*) > 0 AS has_time
FROM (SELECT 'region' AS t FROM region UNION ALL SELECT 'supplier' FROM supplier) GROUP BY t""",
    "probe_orders": f"""
WITH {_YEARS}
SELECT file_nm, 6 AS actual_col_cnt, n AS actual_row_cnt FROM y""",
    "all_manifests": f"""
WITH {_YEARS}, {_LATE}
SELECT file_nm, 6::BIGINT AS col_cnt, n AS row_cnt FROM s""",
    "load_by_manifest": f"""
WITH {_YEARS}, {_LATE},
m AS (SELECT file_nm FROM s WHERE file_nm NOT IN (SELECT file_nm FROM y))
SELECT file_nm, 'FILE_NAME_EXISTS' AS check_nm, 'Y' AS expected_val, 'Y' AS actual_val, 'PASS' AS check_status
FROM y CROSS JOIN range(3)
UNION ALL SELECT file_nm, 'COLUMN_COUNT', '6', '6', 'PASS' FROM y CROSS JOIN range(3)
UNION ALL SELECT file_nm, 'ROW_COUNT', CAST(n AS VARCHAR), CAST(n AS VARCHAR), 'PASS' FROM y CROSS JOIN range(2)
UNION ALL SELECT file_nm, 'ROW_COUNT', CAST(n + 1 AS VARCHAR), CAST(n AS VARCHAR), 'FAIL' FROM y
UNION ALL SELECT file_nm, 'ROWS_LOADED', CAST(n AS VARCHAR), CAST(n AS VARCHAR), 'PASS' FROM y CROSS JOIN range(2)
UNION ALL SELECT file_nm, 'FILE_NAME_EXISTS', 'Y', 'N', 'FAIL' FROM m
UNION ALL SELECT file_nm, 'COLUMN_COUNT', NULL, NULL, 'SKIPPED' FROM m
UNION ALL SELECT file_nm, 'ROW_COUNT', NULL, NULL, 'SKIPPED' FROM m""",
    **{
        f"load_{name}": f"SELECT * FROM {name}"
        for name in (
            "region",
            "nation",
            "supplier",
            "customer",
            "part",
            "orders",
            "lineitem",
            "events",
            "documents",
            "pages",
            "conversations",
        )
    },
}
