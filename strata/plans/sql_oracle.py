"""Independent ANSI-SQL statements of each registered query (DuckDB dialect).

These are the correctness oracle: the same question written as plain SQL over
the fixture tables, run by DuckDB next to the Spark plan.  Shared fixture
views are CTE snippets so each statement stays self-contained.
"""

from __future__ import annotations

# --- finance star (mirrors strata.plans.fixtures.finance_model) ------------
FINANCE_CTES = """
service_fare AS (
  SELECT l_orderkey AS fare_id, l_partkey AS service_type_id, l_orderkey AS ta_supp_doc_no_id,
         CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS record_type,
         l_linenumber AS last_action,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS customer_price,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS deal_discount,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS customer_tax,
         CAST(l_quantity AS DECIMAL(6,2)) * CAST(0.01 AS DECIMAL(3,2)) AS rounding_amount,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS supplier_amount,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
             * CAST(l_tax AS DECIMAL(4,2)) AS supplier_tax
  FROM lineitem),
supp_doc AS (
  SELECT o_orderkey AS supp_doc_no_id, o_custkey AS service_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS last_action,
         CASE WHEN o_orderstatus IN ('F','O') THEN 2 ELSE 1 END AS sys_sale_side_status,
         CASE WHEN o_orderstatus = 'F' THEN 4 ELSE 3 END AS sys_refund_side_status,
         o_orderdate AS sale_date, o_orderdate + INTERVAL 45 DAY AS refund_date
  FROM orders),
sales_purchase AS (
  SELECT
    SUM(CASE WHEN sf.record_type = 1 THEN sf.customer_price + sf.deal_discount - sf.customer_tax - sf.rounding_amount ELSE 0 END) AS gmv_sale,
    SUM(CASE WHEN sf.record_type = 2 THEN sf.customer_price + sf.deal_discount - sf.customer_tax - sf.rounding_amount ELSE 0 END) AS gmv_refund,
    SUM(CASE WHEN sf.record_type = 1 THEN sf.supplier_amount - sf.supplier_tax ELSE 0 END) AS purchase_sale,
    SUM(CASE WHEN sf.record_type = 2 THEN sf.supplier_amount - sf.supplier_tax ELSE 0 END) AS purchase_refund
  FROM service_fare sf
  JOIN supp_doc sd ON sd.supp_doc_no_id = sf.ta_supp_doc_no_id
  JOIN customer c ON sd.service_id = c.c_custkey
  JOIN part p ON p.p_partkey = sf.service_type_id
  WHERE sd.last_action <> 0 AND sf.last_action <> 0
    AND ((sf.record_type = 1 AND sd.sys_sale_side_status = 2
          AND sd.sale_date BETWEEN TIMESTAMP '1997-07-01' AND TIMESTAMP '1997-07-31')
      OR (sf.record_type = 2 AND sd.sys_refund_side_status = 4
          AND sd.refund_date BETWEEN TIMESTAMP '1997-07-01' AND TIMESTAMP '1997-07-31'))),
ledger AS (
  SELECT -CAST(o.o_totalprice AS DECIMAL(12,2)) * CASE WHEN o.o_orderstatus = 'O' THEN -1 ELSE 1 END AS amt,
         c.c_mktsegment AS code, d.o_orderpriority AS doc_no_code_part, n.n_nationkey AS category
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN orders d ON d.o_orderkey = o.o_orderkey
  JOIN customer c2 ON c2.c_custkey = c.c_custkey
  JOIN nation n ON c2.c_nationkey = n.n_nationkey
  WHERE o.o_orderdate BETWEEN TIMESTAMP '1997-07-01' AND TIMESTAMP '1997-07-31'),
ledger_summary AS (
  SELECT
    SUM(CASE WHEN category = 9 AND (code = 'BUILDING' OR doc_no_code_part NOT IN ('1-URGENT','2-HIGH')) THEN amt END) AS incentive_amount,
    SUM(CASE WHEN category <> 9 AND (code = 'AUTOMOBILE' OR doc_no_code_part NOT IN ('1-URGENT','2-HIGH')) THEN amt END) AS total_expense,
    SUM(CASE WHEN category NOT IN (9,10,11,12) AND (code = 'AUTOMOBILE' OR doc_no_code_part NOT IN ('1-URGENT','2-HIGH')) THEN amt END) AS ebitda_expense
  FROM ledger),
pnl AS (
  SELECT (gmv_sale - gmv_refund) AS gmv, (purchase_sale - purchase_refund) AS purchase,
         (gmv_sale - gmv_refund) - (purchase_sale - purchase_refund) AS operational_revenue,
         incentive_amount,
         (gmv_sale - gmv_refund) - (purchase_sale - purchase_refund) + incentive_amount AS total_revenue,
         total_expense, ebitda_expense
  FROM sales_purchase CROSS JOIN ledger_summary)
"""


def _with(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["pnl_gmv"] = _with(FINANCE_CTES, """
SELECT CAST(gmv AS DOUBLE) AS gmv, CAST(purchase AS DOUBLE) AS purchase,
       CAST(operational_revenue AS DOUBLE) AS operational_revenue FROM pnl""")

ORACLE["pnl_incentive_by_code"] = _with(FINANCE_CTES, """
SELECT code, CAST(SUM(amt) AS DOUBLE) AS incentive_amount FROM ledger
WHERE category = 9 AND (code = 'BUILDING' OR doc_no_code_part NOT IN ('1-URGENT','2-HIGH'))
GROUP BY code""")

ORACLE["pnl_total_revenue"] = _with(FINANCE_CTES, """
SELECT CAST(gmv AS DOUBLE) AS total_gmv, CAST(purchase AS DOUBLE) AS total_purchase,
       CAST(operational_revenue AS DOUBLE) AS operational_revenue,
       CAST(incentive_amount AS DOUBLE) AS incentive_amount,
       CAST(total_revenue AS DOUBLE) AS total_revenue FROM pnl""")

ORACLE["pnl_total_expense"] = _with(FINANCE_CTES, """
SELECT CAST(total_expense AS DOUBLE) AS expense FROM pnl""")

ORACLE["pnl_net_profit"] = _with(FINANCE_CTES, """
SELECT CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_expense AS DOUBLE) AS total_expense,
       CAST(total_revenue + total_expense AS DOUBLE) AS net_profit FROM pnl""")

ORACLE["pnl_ebitda"] = _with(FINANCE_CTES, """
SELECT CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(ebitda_expense AS DOUBLE) AS total_expense,
       CAST(total_revenue + ebitda_expense AS DOUBLE) AS ebitda FROM pnl""")

# --- windows and loads -----------------------------------------------------
EVENTS_KEYS = """ev AS (SELECT event_id, ts, user_id, event_type, value, props,
                       ts + INTERVAL 3 DAY AS updated_at FROM events)"""

ORACLE["window_delta"] = _with(EVENTS_KEYS, """
SELECT * FROM ev
WHERE (ts > TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00')
   OR (updated_at > TIMESTAMP '2024-01-10 00:00:00' AND updated_at < TIMESTAMP '2024-01-20 12:00:00')""")

ORACLE["window_full"] = _with(EVENTS_KEYS, """
SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-12 00:00:00' OR updated_at < TIMESTAMP '2024-01-12 00:00:00'""")

ORACLE["cutoff_any_date"] = """
WITH d AS (
  SELECT o_orderkey, o_orderdate,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'not a date'
              ELSE strftime(o_orderdate + INTERVAL 400 DAY, '%Y-%m-%d') END AS ship_text
  FROM orders)
SELECT o_orderkey, o_orderdate, ship_text FROM d
WHERE COALESCE(o_orderdate >= TIMESTAMP '1999-06-01', FALSE)
   OR COALESCE(TRY_CAST(ship_text AS TIMESTAMP) >= TIMESTAMP '1999-06-01', FALSE)"""

FIRST_LOAD = """first_load AS (
  SELECT event_id, ts, user_id, event_type, value, props, TIMESTAMP '2024-01-20 00:00:00' AS insertion_date
  FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00')"""

ORACLE["load_full"] = _with(FIRST_LOAD, "SELECT * FROM first_load")

ORACLE["load_window_append"] = _with(FIRST_LOAD, """
SELECT * FROM first_load
WHERE NOT COALESCE(ts > TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-25 06:00:00', FALSE)
UNION ALL
SELECT event_id, ts, user_id, event_type, value + 1 AS value, props, TIMESTAMP '2024-01-25 06:00:00' AS insertion_date
FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-25 06:00:00'""")

ORACLE["load_upsert"] = """
WITH d1 AS (SELECT event_id, ts, user_id, event_type, value, props FROM events
            WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
d2 AS (SELECT event_id, ts, user_id, event_type, value, props FROM events
       WHERE ts > TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-25 06:00:00'
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT * FROM d1 WHERE user_id NOT IN (SELECT user_id FROM d2)
UNION ALL SELECT * FROM d2"""

ORACLE["load_multi_db"] = """
SELECT *, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS source_db_id,
       CASE o_orderstatus WHEN 'O' THEN 2 ELSE 1 END AS market_profile_id
FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_orderstatus IN ('F','O','P')"""

ORACLE["sentinel_clamp"] = """
SELECT *, strftime(CASE WHEN o_orderpriority = '1-URGENT' THEN TIMESTAMP '9999-12-31 22:59:59'
                        ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS "EndDate"
FROM orders"""

# --- control ---------------------------------------------------------------
CONTROL_CTES = """
batches AS (
  SELECT user_id AS batch_run_id, MIN(ts) AS run_start_datetime, MAX(ts) AS run_end_datetime,
         CASE WHEN MIN(value) < 1 THEN 'FULL' ELSE 'DELTA' END AS load_type,
         CASE WHEN MAX(ts) >= TIMESTAMP '2024-01-30 12:00:00' THEN 'RUNNING' ELSE 'COMPLETED' END AS run_status
  FROM events GROUP BY user_id),
audit0 AS (
  SELECT event_id AS process_id, user_id AS batch_run_id, event_type AS source_table_name,
         'clean_' || event_type AS destination_table_name, ts AS etl_start_time, ts AS time_to,
         CASE WHEN value > 90 THEN 'Post-Clean_Update' ELSE 'append' END AS operation,
         ts + to_seconds(CAST(floor(value) AS BIGINT)) AS etl_end_time,
         CAST(floor(value * 10) AS BIGINT) AS input_row,
         CAST(CASE WHEN value < 2 THEN 0 WHEN value < 4 THEN CAST(floor(value * 10) AS BIGINT) - 1
                   ELSE CAST(floor(value * 10) AS BIGINT) END AS BIGINT) AS output_row
  FROM events),
audit AS (
  SELECT *, CASE WHEN input_row = output_row AND input_row > 0 THEN 'Success'
                 WHEN output_row > 0 THEN 'Partial Success'
                 WHEN input_row = 0 AND output_row = 0 THEN 'Success'
                 ELSE 'Failed' END AS operation_result
  FROM audit0)
"""

ORACLE["watermark"] = _with(CONTROL_CTES, """
SELECT a.source_table_name, MAX(a.time_to) - INTERVAL 5 MINUTE AS last_processed_date
FROM audit a JOIN batches b ON a.batch_run_id = b.batch_run_id
WHERE b.load_type = 'DELTA' AND a.etl_start_time IS NOT NULL AND a.operation <> 'Post-Clean_Update'
  AND a.operation_result IN ('Success', 'SUCCESS', 'success')
GROUP BY a.source_table_name""")

ORACLE["latest_batch"] = _with(CONTROL_CTES, """
SELECT batch_run_id, run_start_datetime, load_type FROM batches WHERE run_status = 'RUNNING'
ORDER BY batch_run_id DESC, run_start_datetime DESC LIMIT 1""")

ORACLE["audit_state"] = """
SELECT user_id AS process_id, CAST(dayofmonth(ts) AS INTEGER) AS batch_run_id, event_type AS source_table_name,
       ts AS event_time, value AS output_row
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, dayofmonth(ts), event_type
                           ORDER BY ts DESC, value DESC) = 1"""

ORACLE["run_summary"] = _with(CONTROL_CTES, """
SELECT batch_run_id, COUNT(*) AS tables_total,
       CAST(SUM(CASE WHEN operation_result IN ('Success','SUCCESS','success') THEN 1 ELSE 0 END) AS BIGINT) AS tables_successful,
       CAST(SUM(CASE WHEN operation_result = 'Failed' THEN 1 ELSE 0 END) AS BIGINT) AS tables_failed,
       ROUND(SUM(CASE WHEN operation_result IN ('Success','SUCCESS','success') THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) AS success_rate,
       CAST(SUM(input_row) AS BIGINT) AS rows_fetched, CAST(SUM(output_row) AS BIGINT) AS rows_processed,
       MIN(etl_start_time) AS run_start, MAX(etl_end_time) AS run_end,
       date_sub('second', MIN(etl_start_time), MAX(etl_end_time)) AS duration_seconds,
       COALESCE(array_to_string(list_sort(list_distinct(list(destination_table_name) FILTER (WHERE operation_result = 'Failed'))), ', '), '') AS failed_tables
FROM audit GROUP BY batch_run_id""")

ORACLE["config_plan"] = """
WITH systems AS (
  SELECT r_regionkey AS source_system_id, r_name AS source_system_name,
         CASE WHEN r_regionkey IN (1,2) THEN 1 ELSE 0 END AS is_multi_db,
         CASE WHEN r_regionkey = 4 THEN 0 ELSE 1 END AS system_is_active FROM region),
dbs AS (SELECT n_nationkey AS source_db_id, n_name AS source_db_code, n_regionkey AS source_system_id FROM nation),
tbls AS (
  SELECT n.n_regionkey AS source_system_id, s.s_name AS source_table_name,
         CAST(floor(s.s_acctbal / 1000) AS BIGINT) AS load_sequence, s.s_suppkey AS hierarchy_number,
         CASE WHEN s.s_acctbal < 0 THEN 'master' ELSE 'transaction' END AS table_type,
         CASE WHEN s.s_nationkey < 12 THEN 'DAILY' ELSE 'HOURLY' END AS run_frequency,
         CASE WHEN s.s_acctbal > -500 THEN 1 ELSE 0 END AS is_active
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)
SELECT s.source_system_name, s.is_multi_db, d.source_db_code, t.source_table_name, t.load_sequence, t.hierarchy_number
FROM tbls t JOIN systems s ON t.source_system_id = s.source_system_id
JOIN dbs d ON d.source_system_id = t.source_system_id
WHERE t.is_active = 1 AND t.table_type = 'transaction' AND t.run_frequency = 'DAILY'
  AND s.system_is_active = 1
  AND d.source_db_code IN ('NATION_0','NATION_2','NATION_4','NATION_6','NATION_8','NATION_10','NATION_12',
                           'NATION_14','NATION_16','NATION_18','NATION_20','NATION_22','NATION_24')
ORDER BY t.load_sequence, t.hierarchy_number"""

# --- silver steps ----------------------------------------------------------
DIRTY = r"""
dirty AS (
  SELECT c.c_custkey,
    CASE c.c_mktsegment WHEN 'BUILDING' THEN '  ' || upper(c.c_name) || '   o''neil 3rd  '
                        WHEN 'MACHINERY' THEN lower(c.c_name)
                        WHEN 'AUTOMOBILE' THEN '' WHEN 'FURNITURE' THEN '   '
                        ELSE c.c_name END AS raw_name,
    c.c_mktsegment AS segment,
    CASE WHEN c.c_nationkey = 0 THEN 'US' WHEN c.c_nationkey = 1 THEN 'GB' WHEN c.c_nationkey = 2 THEN 'IN'
         WHEN c.c_nationkey = 3 THEN NULL ELSE 'N' || CAST(c.c_nationkey AS VARCHAR) END AS country,
    c.c_acctbal AS balance,
    CASE n.n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'INR' WHEN 2 THEN 'EUR' WHEN 3 THEN 'GBP' END AS balance_currency,
    CASE WHEN n.n_nationkey = 5 THEN NULL ELSE CAST(n.n_nationkey AS DOUBLE) * 3.5::DOUBLE - 40 END AS latitude,
    CASE WHEN n.n_nationkey = 7 THEN NULL ELSE CAST(n.n_nationkey AS DOUBLE) * 7.0::DOUBLE - 80 END AS longitude,
    '  ' || substr(md5(c.c_name), 1, 8) || '-' || substr(md5(c.c_name), 9, 4) || '-'
      || CASE WHEN c.c_mktsegment = 'BUILDING' THEN '7' ELSE '4' END || substr(md5(c.c_name), 14, 3)
      || '-a' || substr(md5(c.c_name), 18, 3) || '-' || substr(md5(c.c_name), 21, 12) || ' ' AS uuid_text
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""

PY_TITLE = (r"array_to_string(list_transform(regexp_extract_all({x}, '(\p{{L}}+|[^\p{{L}}]+)'), "
            r"lambda w: upper(w[1]) || lower(w[2:])), '')")


def _title(x: str) -> str:
    return PY_TITLE.format(x=x)


def _cap(x: str) -> str:
    return f"(upper(left({x}, 1)) || lower(substr({x}, 2)))"


ORACLE["case_unify"] = _with(DIRTY, f"""
SELECT c_custkey, upper(raw_name) AS name_upper, lower(raw_name) AS name_lower,
       {_title('raw_name')} AS name_title, {_cap('raw_name')} AS name_cap,
       trim(raw_name) AS name_strip, {_cap('raw_name')} AS name_sentence, raw_name AS name_keep
FROM dirty""")

_TT = "trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
ORACLE["title_trim"] = _with(DIRTY, f"""
SELECT c_custkey, {_title(_TT.format(x='raw_name'))} AS raw_name, {_title(_TT.format(x='segment'))} AS segment,
       {_title(_TT.format(x='country'))} AS country
FROM dirty""")

ORACLE["null_blank"] = _with(DIRTY, """
SELECT c_custkey, CASE WHEN trim(raw_name) = '' THEN NULL ELSE trim(raw_name) END AS raw_name,
       segment, balance, NULLIF(raw_name, '') AS raw_name_silver
FROM dirty""")

ORACLE["uuid_upper"] = _with(DIRTY, """
SELECT c_custkey, CASE WHEN segment = 'BUILDING' THEN trim(uuid_text) ELSE upper(trim(uuid_text)) END AS uuid_text
FROM dirty""")

ORACLE["datetime_format"] = """
WITH d AS (
  SELECT o_orderkey, strftime(o_orderdate, '%-m/%-d/%Y') AS d_us,
         CASE WHEN o_orderpriority = '5-LOW' THEN '31-02-1997' ELSE strftime(o_orderdate, '%d-%m-%Y') END AS d_eu,
         o_orderdate AS d_ts, strftime(o_orderdate, '%Y-%m-%d') AS d_other
  FROM orders)
SELECT o_orderkey, strftime(try_strptime(d_us, '%m/%d/%Y'), '%m/%d/%Y') AS d_us,
       strftime(try_strptime(d_eu, '%d-%m-%Y'), '%d-%m-%Y') AS d_eu,
       strftime(d_ts, '%Y-%m-%d %H:%M:%S') AS d_ts,
       strftime(try_strptime(d_other, '%Y-%m-%d'), '%Y-%m-%d') AS d_other
FROM d"""

ORACLE["country_unify"] = _with(DIRTY, """
SELECT c_custkey, CASE country WHEN 'US' THEN 'USA' WHEN 'IN' THEN 'IND' WHEN 'GB' THEN 'UK' ELSE country END AS country
FROM dirty""")

ORACLE["value_map"] = _with(DIRTY, """
SELECT c_custkey, CASE WHEN segment IN ('HOUSEHOLD','AUTOMOBILE') THEN 'CONSUMER'
                       WHEN segment IN ('MACHINERY','BUILDING') THEN 'INDUSTRIAL' ELSE segment END AS segment
FROM dirty""")

ORACLE["currency_std"] = _with(DIRTY, """
SELECT c_custkey,
       balance * COALESCE(CASE balance_currency WHEN 'USD' THEN 1.0::DOUBLE WHEN 'INR' THEN 0.012::DOUBLE
                                                WHEN 'EUR' THEN 1.1::DOUBLE END, 1.0::DOUBLE) * 1.2::DOUBLE AS balance,
       COALESCE(latitude, 40.7128::DOUBLE) AS latitude, COALESCE(longitude, -74.0060::DOUBLE) AS longitude
FROM dirty""")

JSON_PARTS = """
jp AS (
  SELECT p_partkey, CASE WHEN p_size < 3 THEN '{bad'
         ELSE '{"brand": "' || p_brand || '", "dims": {"size": ' || CAST(p_size AS VARCHAR)
              || '}, "name": "' || p_name || '"}' END AS j
  FROM part)
"""

ORACLE["json_flatten"] = _with(JSON_PARTS, """
SELECT p_partkey,
       CASE WHEN json_valid(j) THEN json_extract_string(j, '$.brand') END AS j_brand,
       CASE WHEN json_valid(j) THEN json_extract_string(j, '$.dims.size') END AS j_dims_size,
       CASE WHEN json_valid(j) THEN json_extract_string(j, '$.dims.size') END AS size2,
       CAST(NULL AS VARCHAR) AS j_missing
FROM jp""")

ORACLE["json_extract_all"] = _with(JSON_PARTS, """
SELECT p_partkey,
       CASE WHEN json_valid(j) THEN json_extract_string(j, '$.brand') END AS brand,
       CASE WHEN json_valid(j) THEN json_extract_string(j, '$.dims') END AS dims,
       CASE WHEN json_valid(j) THEN json_extract_string(j, '$.name') END AS name
FROM jp""")

ORACLE["xml_flatten"] = """
SELECT p_partkey, p_name || ' (' || p_brand || ')' AS x_SN,
       'City (' || upper(substr(p_name, 1, 3)) || ')' AS x_IL_attr_LOC,
       CASE WHEN p_size > 40 THEN NULL ELSE lpad(CAST(p_size AS VARCHAR), 2, '0') || '/01/24' END AS x_IL_attr_ED,
       p_type AS sc
FROM part"""

ORACLE["xml_repair"] = """
SELECT p_partkey,
       CASE WHEN p_size < 10 THEN '<a><b>' || p_name || ' &amp; co</b></a>'
            WHEN p_size < 20 THEN '<a><b>' || p_name || ' &lt;1&gt;</b></a>'
            WHEN p_size < 25 THEN NULL
            ELSE '<a><b>' || p_name || '</b></a>' END AS x2
FROM part"""

ORACLE["json_array_serialise"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_returnflag = 'A' THEN NULL
            WHEN l_returnflag = 'R' THEN '{' || CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR) || ',None}'
            ELSE '{' || CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR) || ','
                 || CAST(l_linenumber AS VARCHAR) || '}' END AS arr,
       CAST(to_json({'k': l_partkey, 'f': l_returnflag}) AS VARCHAR) AS js
FROM lineitem"""

ORACLE["dedup_rows"] = "SELECT DISTINCT * FROM lineitem"

ORACLE["row_index"] = """
SELECT *, row_number() OVER (ORDER BY o_orderkey) AS partition_index FROM orders"""

ORACLE["schema_align"] = """
SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS missing_col,
       TIMESTAMP '2024-01-20 00:00:00' AS insertion_date,
       CAST(NULL AS VARCHAR) AS is_vip, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS n_name
FROM orders"""

# --- emission mart -----------------------------------------------------------
BOOKING_CTES = r"""
booking AS (
  SELECT o_orderkey AS ID, o_custkey AS BookingFileID, CAST(left(o_orderpriority, 1) AS INT) - 1 AS AirTripTypeID,
         CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 1 END AS TravelSectorID, o_totalprice - 20000 AS Amount,
         o_orderpriority IN ('1-URGENT', '3-MEDIUM') AS IsDomestic, o_orderdate < TIMESTAMP '2001-01-01' AS IsActive,
         CASE WHEN o_orderstatus = 'F' THEN 16 ELSE 17 END AS BookingStatusID, o_orderdate AS RemitDate,
         o_totalprice AS AmountNetRemit,
         CAST(floor((o_totalprice - 20000) / 5000) AS INT) AS ValidatingAirlineID,
         CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS HotelPropertyItemID,
         o_orderdate AS CheckIn, o_orderdate + INTERVAL 3 DAY AS CheckOut,
         CASE WHEN o_orderstatus = 'P' THEN 'HC' || CAST(o_orderkey AS VARCHAR) END AS ProviderConfirmationReference
  FROM orders),
booking_file AS (
  SELECT c_custkey AS ID, c_name AS SystemReference,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS BookedForOrganizationID,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 15 ELSE 16 END AS BookingFileStatusID,
         c_name AS CustomerFullName
  FROM customer),
organization AS (SELECT n_nationkey AS ID, n_regionkey <> 4 AS IsActive, n_name AS Name FROM nation),
trip_type AS (SELECT * FROM (VALUES (0, 'One Way'), (1, 'Round Trip'), (2, 'Multi City'), (3, 'Open Jaw'),
                                    (4, 'Open Return')) AS v(ID, NameEN)),
cabin_class AS (SELECT * FROM (VALUES (1, 'Economy'), (2, 'Business'), (3, 'First')) AS v(ID, NameEN)),
air_traveler AS (SELECT o_custkey + 500000 AS ID, o_orderkey AS BookingID, 'ET' || CAST(o_orderkey AS VARCHAR) AS ETicketNumber FROM orders),
origin_destination AS (SELECT o_orderkey AS ID, o_orderkey AS BookingID FROM orders),
segment AS (
  SELECT l_orderkey AS AirOriginDestinationID, l_shipdate AS Departure,
         l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS Arrival,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS BookedAirCabinClassID,
         l_suppkey AS MarketingAirlineID,
         l_linenumber - 1 + CASE WHEN l_linestatus = 'O' THEN 7 ELSE 0 END AS DepartureAirportID,
         CAST(floor(l_quantity / 2) AS INT) AS ArrivalAirportID
  FROM lineitem),
airline AS (SELECT s_suppkey AS ID, s_name AS NameEN FROM supplier),
airport AS (
  SELECT n_nationkey AS ID, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS IATACode,
         CASE WHEN n_nationkey = 5 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) * 3.5::DOUBLE - 40 END AS Latitude,
         CASE WHEN n_nationkey = 7 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) * 14.0::DOUBLE - 170 END AS Longitude
  FROM nation),
service AS (
  SELECT p_partkey AS ID, p_partkey AS BookingFileID,
         CASE WHEN p_type = 'ECONOMY' THEN 13 WHEN p_type IN ('STANDARD', 'SMALL') THEN 15 WHEN p_type = 'LARGE' THEN 14
              WHEN p_type = 'MEDIUM' THEN 20 WHEN p_retailprice < 995 THEN 27 ELSE 31 END AS ServiceTypeID,
         CASE WHEN p_size > 45 THEN 20 ELSE 16 END AS BookingStatusID,
         p_retailprice < 995 AS IsActive,
         CAST(DATE '1997-01-01' + CAST(p_size AS INT) AS TIMESTAMP) AS RemitDate,
         CASE WHEN p_size > 25 THEN p_brand || ' (' || upper(substr(p_name, 1, 2)) || ')' ELSE p_brand END AS NameEN,
         p_name AS Service,
         CASE WHEN p_size < 10 THEN 'eco plus' WHEN p_size < 20 THEN 'Business' WHEN p_size < 30 THEN 'first row'
              WHEN p_size < 40 THEN 'PREMIUM economy' ELSE 'std' END AS Service_Class,
         CASE WHEN p_size = 50 THEN NULL ELSE
           'N' || lpad(CAST(CAST(floor(p_size / 2) AS INT) AS VARCHAR), 2, '0') || '-'
           || 'N' || lpad(CAST(length(p_name) + 10 AS VARCHAR), 2, '0')
           || CASE WHEN p_retailprice >= 950
                   THEN '-N' || lpad(CAST(CAST(floor((p_retailprice - 900) / 4) AS INT) AS VARCHAR), 2, '0')
                   ELSE '' END END AS Service_Location,
         '1997-' || lpad(CAST(CAST(floor(p_size / 5) + 1 AS BIGINT) AS VARCHAR), 2, '0') || '-15' AS Service_Start_Date,
         '1997-12-31' AS Service_End_Date,
         CASE WHEN p_size < 5 THEN NULL ELSE 'PNR' || CAST(p_partkey AS VARCHAR) END AS ProviderConfirmationReference,
         p_retailprice AS AmountNetRemit,
         CASE WHEN p_size < 8 THEN 'STANDARD' WHEN p_size < 16 THEN 'premium suite' WHEN p_size < 24 THEN 'Executive'
              WHEN p_size < 32 THEN 'deluxe' WHEN p_size < 40 THEN 'eco' ELSE 'Business' END AS x_sc,
         CASE WHEN p_size > 45 THEN NULL
              ELSE p_brand || CASE WHEN p_size > 20 THEN ' (' || p_type || ')' ELSE '' END END AS x_sn,
         CASE WHEN p_size > 42 THEN NULL
              ELSE 'Town (' || lower('N' || lpad(CAST(CAST(floor(p_size / 2) AS INT) AS VARCHAR), 2, '0')) || ')' END AS x_loc,
         CASE WHEN p_size < 15 THEN '1997-' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-20'
              WHEN p_size < 35 THEN '20/' || lpad(CAST(CAST(floor(p_size / 3) AS BIGINT) AS VARCHAR), 2, '0') || '/24'
         END AS x_sd,
         CASE WHEN p_size > 30 THEN '2024-12-31' END AS x_ed
  FROM part),
service_traveler AS (SELECT p_partkey + 100000 AS ID, p_partkey AS ServiceID FROM part)
"""

# The emission and listing statements follow the meaning of each output column: distances come from a
# table of all airport pairs, factors and labels from rule tables, and flights, hotels and services are
# separate parts of a union.
EMISSION_CTES = BOOKING_CTES + """,
hop AS (
  SELECT p.ID AS from_id, q.ID AS to_id, p.IATACode AS from_code, q.IATACode AS to_code,
         6371 * acos(greatest(-1.0, least(1.0,
           sin(radians(p.Latitude)) * sin(radians(q.Latitude))
           + cos(radians(p.Latitude)) * cos(radians(q.Latitude)) * cos(radians(q.Longitude - p.Longitude))))) AS km
  FROM airport p CROSS JOIN airport q),
client_file AS (
  SELECT f.*, o.ID AS client, o.IsActive AS client_active
  FROM booking_file f LEFT JOIN organization o ON o.ID = f.BookedForOrganizationID
  WHERE f.BookedForOrganizationID IS NOT NULL),
flight_booking AS (
  SELECT x.ID, x.AirTripTypeID, x.RemitDate, x.Amount, x.IsDomestic, x.BookingStatusID,
         c.ID AS file_id, c.client, c.SystemReference
  FROM booking x JOIN client_file c ON c.ID = x.BookingFileID
  WHERE x.IsActive AND x.TravelSectorID = 1 AND c.BookingFileStatusID = 16),
flown AS (
  SELECT d.BookingID, g.Departure, g.Arrival, g.MarketingAirlineID, g.BookedAirCabinClassID,
         h.from_code || '-' || h.to_code AS pair, coalesce(h.km, 0) AS km
  FROM origin_destination d
  JOIN segment g ON g.AirOriginDestinationID = d.ID
  JOIN hop h ON h.from_id = g.DepartureAirportID AND h.to_id = g.ArrivalAirportID),
booking_leg AS (
  SELECT t.file_id, t.client AS OrganizationId, t.SystemReference AS Trip, t.ID AS BookingID,
         w.Departure AS Start_Date, w.Arrival AS End_Date, p.ID AS TravelerId, carrier.NameEN AS Airline,
         kind.NameEN AS TripType, cabin.NameEN AS Cabin_Class, p.ETicketNumber AS E_Ticket, t.RemitDate,
         w.pair || CASE t.AirTripTypeID WHEN 0 THEN '' WHEN 1 THEN '' WHEN 4 THEN '-*' END AS Route,
         w.km * (CASE t.AirTripTypeID WHEN 1 THEN 2 ELSE 1 END) AS KM,
         CASE WHEN t.Amount < 0 THEN 'Cancelled'
              WHEN t.Amount < (CASE t.IsDomestic WHEN TRUE THEN 100 WHEN FALSE THEN 250 END) THEN 'Changed'
              ELSE CAST(t.BookingStatusID AS VARCHAR) END AS Ticket_status
  FROM flight_booking t
  JOIN air_traveler p ON p.BookingID = t.ID
  JOIN flown w ON w.BookingID = t.ID
  JOIN trip_type kind ON kind.ID = t.AirTripTypeID
  JOIN cabin_class cabin ON cabin.ID = w.BookedAirCabinClassID
  JOIN airline carrier ON carrier.ID = w.MarketingAirlineID),
stop AS (
  SELECT ID, i, string_split(Service_Location, '-')[i] AS here, string_split(Service_Location, '-')[i + 1] AS next
  FROM service, (SELECT unnest(range(1, 5)) AS i)),
service_distance AS (
  SELECT stop.ID, sum(coalesce(hop.km, 0)) AS km
  FROM stop LEFT JOIN hop ON hop.from_code = stop.here AND hop.to_code = stop.next GROUP BY stop.ID),
class_word AS (
  SELECT * FROM (VALUES (1, 'eco', 'Economy class'), (2, 'busi', 'Business class'), (3, 'first', 'First class'),
                        (4, 'premium', 'Premium economy class')) v(turn, word, label)),
service_class AS (
  SELECT s.ID, min_by(c.label, c.turn) AS label
  FROM service s JOIN class_word c ON contains(lower(s.Service_Class), c.word) GROUP BY s.ID),
service_leg AS (
  SELECT c.ID AS file_id, c.client AS OrganizationId, c.SystemReference AS Trip, s.ID AS BookingID,
         CAST(s.Service_Start_Date AS DATE) AS Start_Date, CAST(s.Service_End_Date AS DATE) AS End_Date,
         who.ID AS TravelerId, split_part(s.NameEN, ' (', 1) AS Airline, s.Service AS TripType,
         coalesce(k.label, 'Other') AS Cabin_Class, coalesce(s.ProviderConfirmationReference, '-') AS E_Ticket,
         s.RemitDate, coalesce(s.Service_Location, '-') AS Route, far.km AS KM
  FROM service s
  JOIN client_file c ON c.ID = s.BookingFileID AND c.client_active
  JOIN service_traveler who ON who.ServiceID = s.ID
  JOIN service_distance far ON far.ID = s.ID
  LEFT JOIN service_class k ON k.ID = s.ID
  WHERE s.ServiceTypeID IN (13, 15) AND s.BookingStatusID = 16 AND s.IsActive),
every_leg AS (
  SELECT 'Booking' AS source, * EXCLUDE (Ticket_status) FROM booking_leg
  UNION ALL BY NAME SELECT 'Service' AS source, * FROM service_leg),
factor AS (
  SELECT * FROM (VALUES
    (-1, 785, 'economy', 0.16685), (-1, 785, 'first', 0.16685), (-1, 785, 'other', 0.16685),
    (785, 3700, 'economy', 0.09074), (785, 3700, 'first', 0.13612), (785, 3700, 'other', 0.13612),
    (3700, 1e9, 'economy', 0.07954), (3700, 1e9, 'first', 0.31816), (3700, 1e9, 'other', 0.23066))
    v(above, up_to, cabin, kg)),
emitted AS (
  SELECT l.*, l.KM * 1.09 * CAST(f.kg AS DOUBLE) AS kg
  FROM every_leg l LEFT JOIN factor f ON l.KM > f.above AND l.KM <= f.up_to AND f.cabin =
    CASE WHEN contains(lower(l.Cabin_Class), 'economy') THEN 'economy'
         WHEN contains(lower(l.Cabin_Class), 'first') THEN 'first' ELSE 'other' END)
"""

ORACLE["emission_booking"] = _with(EMISSION_CTES, """
SELECT BookingID, OrganizationId, Trip, Start_Date, Airline, TripType, Cabin_Class, E_Ticket, Route,
       round(KM, 6) AS KM, Ticket_status FROM booking_leg""")

ORACLE["emission_multileg"] = _with(EMISSION_CTES, """
SELECT BookingID, OrganizationId, Trip, Start_Date, End_Date, TravelerId, Airline, TripType, Cabin_Class,
       E_Ticket, Route, round(KM, 6) AS KM FROM service_leg""")

ORACLE["emission_mart"] = _with(EMISSION_CTES, """
SELECT Trip AS trip_id, BookingID AS booking_service_id, source AS booking_service_type,
       OrganizationId AS organization_id, TravelerId AS traveler_id, TripType AS trip_type,
       Airline AS airline_name, Route AS flight_route, Cabin_Class AS booking_class,
       round(KM, 6) AS distance, round(kg, 6) AS emission, Start_Date AS start_date, End_Date AS end_date
FROM emitted""")

# --- listing -------------------------------------------------------------------
LISTING_CTES = BOOKING_CTES + """,
bfile AS (
  SELECT c_custkey AS ID, c_name AS SystemReference,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS BookedForOrganizationID,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 15 ELSE 16 END AS BookingFileStatusID,
         c_name AS CustomerFullName,
         CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 1 WHEN c_mktsegment = 'MACHINERY' THEN 2
              WHEN c_mktsegment = 'AUTOMOBILE' THEN 3 ELSE 4 END AS MarketProfileID
  FROM customer),
org AS (SELECT n_nationkey AS ID, n_regionkey <> 4 AS IsActive, n_name AS Name,
               CASE WHEN n_nationkey < 10 THEN 'Group ' || CAST(n_regionkey AS VARCHAR) END AS OrganizationGroup,
               n_regionkey AS RelationshipManagerUserID FROM nation),
usr AS (SELECT r_regionkey AS ID, r_name AS FirstName, CASE WHEN r_regionkey = 0 THEN NULL ELSE 'Manager' END AS LastName
        FROM region),
atrav AS (SELECT o_orderkey AS BookingID, o_custkey AS TravelerID, 'ET' || CAST(o_orderkey AS VARCHAR) AS ETicketNumber,
                 o_totalprice / 2 AS AmountNetRemit FROM orders WHERE o_orderstatus <> 'P'),
htrav AS (SELECT o_orderkey AS BookingID, o_custkey + 7 AS TravelerID FROM orders
          WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'),
traveler AS (SELECT c_custkey AS ID, c_name AS FullName, c_custkey AS TravelerProfileID FROM customer),
tprofile AS (SELECT c_custkey AS ID, c_nationkey AS OrganizationID FROM customer),
bstatus AS (SELECT * FROM (VALUES (16, 'Confirmed'), (17, 'On Hold'), (20, 'Cancelled'), (23, 'Refunded')) AS v(ID, NameEN)),
stype AS (SELECT * FROM (VALUES (13, 'Flight DOM'), (14, 'Hotel INT'), (15, 'Flight INT'), (20, 'Hotel DOM'),
                                (27, 'Visa'), (31, 'Transfer')) AS v(ID, NameEN)),
airport2 AS (SELECT *, ID AS CityID FROM airport),
city AS (SELECT n_nationkey AS ID, 'City_' || CAST(n_nationkey AS VARCHAR) AS NameEN,
                'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS IATACode, n_regionkey AS CountryID,
                CAST(n_regionkey AS DOUBLE) + CASE WHEN n_nationkey > 20 THEN 0.5 ELSE 0.0 END AS UTCDifference
         FROM nation),
country AS (SELECT r_regionkey AS ID, r_name AS NameEN FROM region),
hpitem AS (SELECT c_custkey AS ID, 'Room ' || c_mktsegment AS NameEN, c_nationkey AS HotelPropertyID FROM customer),
hprop AS (SELECT n_nationkey AS ID, 'Hotel ' || n_name AS NameEN, n_regionkey AS DestinationID FROM nation),
dest AS (SELECT r_regionkey AS ID, r_regionkey AS CountryID FROM region),
citydest AS (SELECT r_regionkey AS DestinationID, r_regionkey * 5 AS CityID FROM region),
strav AS (SELECT p_partkey AS ServiceID, p_partkey + 3 AS TravelerID FROM part),
leg_clock AS (
  SELECT d.BookingID, g.Departure, g.Arrival, cabin.NameEN AS cabin, p.IATACode || '-' || q.IATACode AS pair,
         p.IATACode AS p_code, q.IATACode AS q_code,
         date_diff('minute', g.Departure - to_hours(CAST(trunc(near.UTCDifference) AS BIGINT)),
                   g.Arrival - to_hours(CAST(trunc(far.UTCDifference) AS BIGINT))) AS minutes
  FROM origin_destination d
  JOIN segment g ON g.AirOriginDestinationID = d.ID
  JOIN cabin_class cabin ON cabin.ID = g.BookedAirCabinClassID
  JOIN airport2 p ON p.ID = g.DepartureAirportID JOIN city near ON near.ID = p.CityID
  JOIN airport2 q ON q.ID = g.ArrivalAirportID JOIN city far ON far.ID = q.CityID),
itinerary AS (
  SELECT x.ID, CAST(trunc(sum(k.minutes) / CASE x.AirTripTypeID WHEN 1 THEN 2.0 ELSE 1.0 END) AS BIGINT) AS Flight_Time,
         strftime(min(k.Departure), '%d/%m/%Y') AS "From", strftime(max(k.Arrival), '%d/%m/%Y') AS "To",
         min(k.cabin) AS "In",
         string_agg(k.pair, ', ' ORDER BY k.Departure, k.p_code, k.q_code, k.pair) AS Route
  FROM booking x JOIN leg_clock k ON k.BookingID = x.ID GROUP BY x.ID, x.AirTripTypeID),
code_country AS (
  SELECT s.ID AS CI_ID, nation_name.NameEN AS Country
  FROM service s
  JOIN city ON city.IATACode = upper(CASE WHEN contains(s.x_loc, '(')
                                          THEN substring(split_part(s.x_loc, '(', 2), 1, 3)
                                          ELSE substring(s.x_loc, 1, 3) END)
  JOIN country nation_name ON nation_name.ID = city.CountryID
  WHERE s.ServiceTypeID IN (14, 20, 27, 31)),
held AS (
  SELECT x.ID AS b_id, air.TravelerID AS at_traveler, hotel.TravelerID AS ht_traveler,
         air.ETicketNumber AS ticket, air.AmountNetRemit AS air_amount
  FROM booking x LEFT JOIN atrav air ON air.BookingID = x.ID LEFT JOIN htrav hotel ON hotel.BookingID = x.ID),
either AS (
  SELECT held.*, person.ID AS traveler_id, person.FullName AS traveler_name
  FROM held LEFT JOIN traveler person ON person.ID IN (held.at_traveler, held.ht_traveler)),
report_file AS (
  SELECT f.ID AS file_id, f.SystemReference AS trip_reference, f.CustomerFullName,
         (['UAE', 'India', 'Qatar', 'Saudi Arabia'])[f.MarketProfileID] AS market,
         CAST(o.ID AS BIGINT) AS organization_id, o.Name AS organization,
         concat_ws(' ', m.FirstName, m.LastName) AS rm, coalesce(o.OrganizationGroup, '-') AS org_group
  FROM bfile f JOIN org o ON o.ID = f.BookedForOrganizationID
  LEFT JOIN usr m ON m.ID = o.RelationshipManagerUserID
  WHERE f.MarketProfileID = 1),
due AS (SELECT TIMESTAMP '1995-01-01 00:00:00' AS since, TIMESTAMP '2001-12-31 23:59:59' AS until),
due_booking AS (
  SELECT x.*, r.*, status.NameEN AS ticket_status, e.ticket, e.air_amount, upper(e.traveler_name) AS estimated_traveler,
         CASE WHEN x.IsDomestic THEN 'Domestic' ELSE 'International' END AS dom_int,
         strftime(x.RemitDate, '%d/%m/%Y') AS approved, 'B-' || CAST(x.ID AS VARCHAR) AS row_id,
         upper(r.CustomerFullName) AS for_name
  FROM booking x JOIN report_file r ON r.file_id = x.BookingFileID JOIN bstatus status ON status.ID = x.BookingStatusID
  JOIN either e ON e.b_id = x.ID JOIN due ON x.RemitDate BETWEEN due.since AND due.until
  WHERE x.IsActive AND x.BookingStatusID > 0),
flight_row AS (
  SELECT d.*, 'Flight' AS category, coalesce(d.ticket, '-') AS e_ticket_number, i."In" AS in_label,
         coalesce(carrier.NameEN, '-') AS on_at, i.Route AS route_city, '-' AS hotel_country,
         i."From" AS from_date, i."To" AS to_date, i.Flight_Time AS flight_time,
         coalesce(CASE WHEN d.BookingStatusID IN (16, 20, 23) THEN d.air_amount ELSE d.AmountNetRemit END, 0) AS payable
  FROM due_booking d LEFT JOIN airline carrier ON carrier.ID = d.ValidatingAirlineID
  LEFT JOIN itinerary i ON i.ID = d.ID WHERE d.TravelSectorID = 1),
hotel_row AS (
  SELECT d.*, 'Hotel' AS category, coalesce(d.ProviderConfirmationReference, '-') AS e_ticket_number,
         room.NameEN AS in_label, coalesce(house.NameEN, '-') AS on_at, town.NameEN AS route_city,
         land.NameEN AS hotel_country, strftime(d.CheckIn, '%d/%m/%Y') AS from_date,
         strftime(d.CheckOut, '%d/%m/%Y') AS to_date, CAST(0 AS BIGINT) AS flight_time,
         coalesce(d.AmountNetRemit, 0) AS payable
  FROM due_booking d LEFT JOIN hpitem room ON room.ID = d.HotelPropertyItemID
  LEFT JOIN hprop house ON house.ID = room.HotelPropertyID LEFT JOIN dest spot ON spot.ID = house.DestinationID
  LEFT JOIN citydest near ON near.DestinationID = spot.ID LEFT JOIN city town ON town.ID = near.CityID
  LEFT JOIN country land ON land.ID = spot.CountryID WHERE d.TravelSectorID = 3),
class_label AS (
  SELECT * FROM (VALUES
    ('Hotel', 1, 'stand', 'Standard room'), ('Hotel', 2, 'premi', 'Deluxe room'), ('Hotel', 3, 'exec', 'Executive room'),
    ('Hotel', 4, 'lux', 'Deluxe room'), ('Hotel', 5, 'eco', 'Standard room'),
    ('Flight', 1, 'stand', 'Economy class'), ('Flight', 2, 'eco', 'Economy class'), ('Flight', 3, 'busi', 'Business class'),
    ('Flight', 4, 'first', 'First class'), ('Flight', 5, 'premium', 'Premium economy class')) v(kind, turn, word, label)),
kind_of AS (
  SELECT s.ID, CASE WHEN s.ServiceTypeID IN (13, 15) THEN 'Flight'
                    WHEN s.ServiceTypeID IN (14, 20, 27, 31) THEN 'Hotel' END AS kind
  FROM service s),
label_of AS (
  SELECT s.ID, min_by(c.label, c.turn) AS label
  FROM service s JOIN kind_of k ON k.ID = s.ID
  JOIN class_label c ON c.kind = k.kind AND contains(lower(s.x_sc), c.word) GROUP BY s.ID),
printed AS (
  SELECT ID, side, max(shown) AS shown
  FROM (SELECT ID, side,
               CASE WHEN regexp_matches(d, '^....-') THEN concat_ws('/', right(d, 2), split_part(d, '-', 2)[1:2], left(d, 4))
                    ELSE replace(d, right(d, 3), replace(right(d, 3), '/', '/20')) END AS shown
        FROM (SELECT ID, 'from' AS side, x_sd AS d FROM service UNION ALL SELECT ID, 'to', x_ed FROM service)
        WHERE d IS NOT NULL) GROUP BY ID, side),
service_row AS (
  SELECT r.*, 'S-' || CAST(s.ID AS VARCHAR) AS row_id, status.NameEN AS ticket_status,
         upper(person.FullName) AS traveler_name, strftime(s.RemitDate, '%d/%m/%Y') AS approved,
         CASE WHEN contains(lower(t.NameEN), 'dom') THEN 'Domastic'
              WHEN contains(lower(t.NameEN), 'int') THEN 'International' ELSE '-' END AS dom_int,
         coalesce(k.kind, t.NameEN) AS category, coalesce(s.ProviderConfirmationReference, '-') AS e_ticket_number,
         coalesce(l.label, 'Other') AS in_label,
         CASE k.kind WHEN 'Hotel' THEN trim(s.x_sn)
                     WHEN 'Flight' THEN CASE WHEN s.x_sn IS NULL THEN '-' WHEN contains(s.x_sn, ' (')
                                             THEN trim(split_part(s.x_sn, ' (', 1)) ELSE '' END
                     ELSE '-' END AS on_at,
         coalesce(s.x_loc, '-') AS route_city, coalesce(land.Country, '-') AS hotel_country,
         coalesce(f.shown, strftime(s.RemitDate, '%d/%m/%Y')) AS from_date,
         coalesce(u.shown, strftime(s.RemitDate, '%d/%m/%Y')) AS to_date, coalesce(s.AmountNetRemit, 0) AS payable
  FROM service s JOIN report_file r ON r.file_id = s.BookingFileID JOIN bstatus status ON status.ID = s.BookingStatusID
  JOIN kind_of k ON k.ID = s.ID JOIN due ON s.RemitDate BETWEEN due.since AND due.until
  LEFT JOIN stype t ON t.ID = s.ServiceTypeID LEFT JOIN label_of l ON l.ID = s.ID
  LEFT JOIN strav named ON named.ServiceID = s.ID LEFT JOIN traveler person ON person.ID = named.TravelerID
  LEFT JOIN code_country land ON land.CI_ID = s.ID
  LEFT JOIN printed f ON f.ID = s.ID AND f.side = 'from' LEFT JOIN printed u ON u.ID = s.ID AND u.side = 'to'
  WHERE s.IsActive AND s.BookingStatusID > 0)
"""

_LISTED = ("dom_int, trip_reference, row_id AS id, market, organization_id, organization, rm, approved, category, "
           "e_ticket_number, ticket_status, {name} AS for_name, in_label, on_at, route_city, hotel_country, from_date, "
           "to_date, {minutes} AS flight_time, payable AS amount, {traveler} AS estimated_traveler, org_group")
_BOOKED = _LISTED.format(name="for_name", minutes="flight_time", traveler="estimated_traveler")
_SERVED = _LISTED.format(name="CustomerFullName", minutes="CAST(0 AS BIGINT)", traveler="coalesce(traveler_name, '-')")

ORACLE["or_join_traveler"] = _with(LISTING_CTES, """
SELECT b_id AS B_ID, at_traveler, ht_traveler, traveler_id, traveler_name FROM either""")
ORACLE["itinerary_rollup"] = _with(LISTING_CTES, """
SELECT ID, Flight_Time, "From", "To", "In", Route FROM itinerary""")
ORACLE["city_code_country"] = _with(LISTING_CTES, "SELECT CI_ID, Country FROM code_country")
ORACLE["listing_union"] = _with(LISTING_CTES, f"""
SELECT {_BOOKED} FROM flight_row UNION SELECT {_BOOKED} FROM hotel_row UNION SELECT {_SERVED} FROM service_row""")

ORACLE["gold_template"] = """
SELECT event_type, user_id, COUNT(*) AS n_events, ROUND(SUM(value), 2) AS total_value
FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
GROUP BY event_type, user_id"""

ORACLE["xml_extract_all"] = """
SELECT p_partkey, p_name || ' (' || p_brand || ')' AS SN,
       p_type AS ServiceDetailsInfo_attr_SC,
       'City (' || upper(substr(p_name, 1, 3)) || ')' AS IL_attr_LOC,
       '2024-01-' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS IL_attr_SD,
       CASE WHEN p_size > 40 THEN NULL ELSE lpad(CAST(p_size AS VARCHAR), 2, '0') || '/01/24' END AS IL_attr_ED
FROM part"""

ORACLE["latest_success"] = _with(CONTROL_CTES, """
SELECT process_id, destination_table_name, time_to, input_row FROM audit
WHERE destination_table_name = 'clean_purchase' AND operation_result IN ('Success', 'SUCCESS', 'success')
  AND batch_run_id IN (SELECT batch_run_id FROM batches WHERE load_type = 'DELTA')
ORDER BY time_to DESC NULLS LAST, process_id DESC LIMIT 1""")

ORACLE["source_systems"] = """
SELECT DISTINCT r.r_name AS source_system_name, CASE WHEN r.r_regionkey IN (1, 2) THEN 1 ELSE 0 END AS is_multi_db
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
JOIN nation d ON d.n_regionkey = n.n_regionkey
WHERE r.r_regionkey <> 4 AND CASE WHEN s.s_acctbal > -500 THEN 1 ELSE 0 END = 1"""

ORACLE["sink_window_by_day"] = """
SELECT * EXCLUDE (value), value + CASE WHEN again THEN 1 ELSE 0 END AS value FROM (
  SELECT *, CASE WHEN event_id % 50 <> 0 THEN CAST(ts AS DATE) END AS day,
         ts > TIMESTAMP '2024-01-15 12:00:00' AND ts < TIMESTAMP '2024-01-25 00:00:00' AS again FROM events)
WHERE CASE WHEN again THEN dayofmonth(ts) <> 18 ELSE ts < TIMESTAMP '2024-01-20 00:00:00' END"""
ORACLE["sink_window_by_day"] = f"SELECT * EXCLUDE (again) FROM ({ORACLE['sink_window_by_day']})"

ORACLE["sink_upsert_by_bucket"] = """
WITH one AS (
  SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-12'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
two AS (
  SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-14'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT * FROM two UNION ALL SELECT one.* FROM one ANTI JOIN two USING (user_id)"""

ORACLE["first_silver_delta"] = """
SELECT * FROM orders WHERE o_orderdate + INTERVAL 18 YEARS > TIMESTAMP '2015-01-01'
  AND o_orderdate + INTERVAL 18 YEARS < TIMESTAMP '2018-01-01'"""

ORACLE["ordered_plan"] = """
SELECT s_name AS source_table_name, CAST(floor(s_acctbal / 1000) AS BIGINT) AS load_sequence,
       s_suppkey AS hierarchy_number,
       row_number() OVER (ORDER BY CAST(floor(s_acctbal / 1000) AS BIGINT), s_suppkey) AS place
FROM supplier"""

ORACLE["silver_full_scan"] = "SELECT * FROM events"

ORACLE["load_append"] = """
SELECT * FROM orders UNION ALL BY NAME
SELECT * EXCLUDE (o_orderpriority) FROM orders WHERE o_orderstatus = 'F'"""

ORACLE["gold_unbounded_delete"] = """
SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' UNION ALL
SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'"""

ORACLE["nan_clean"] = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 5 THEN CAST(l_extendedprice AS DOUBLE) END AS price
FROM lineitem"""

ORACLE["layers_end_to_end"] = """
SELECT upper(event_type) AS event_type, count(*) AS n, max(ts) AS last_ts
FROM events WHERE ts < TIMESTAMP '2024-01-25 06:00:00' GROUP BY event_type"""

# the same statement: splitting the fact in two and joining it again changes nothing
ORACLE["pnl_gmv_from_two_facts"] = ORACLE["pnl_gmv"]

ORACLE["processing_orders"] = """
SELECT layer, s_name AS source_table_name, CASE layer
  WHEN 'bronze' THEN row_number() OVER (PARTITION BY layer ORDER BY CAST(floor(s_acctbal / 1000) AS BIGINT), s_suppkey)
  WHEN 'silver' THEN row_number() OVER (PARTITION BY layer ORDER BY s_suppkey)
  ELSE row_number() OVER (PARTITION BY layer ORDER BY s_suppkey DESC) END AS place
FROM supplier, (VALUES ('bronze'), ('silver'), ('gold')) v(layer)"""

ORACLE["emission_order"] = _with(EMISSION_CTES, """
SELECT strftime(CAST(RemitDate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS RemitDate, OrganizationId,
       min(place) AS first_place, max(place) AS last_place, count(*) AS n_rows
FROM (SELECT RemitDate, OrganizationId,
             row_number() OVER (ORDER BY RemitDate DESC NULLS FIRST, OrganizationId ASC NULLS LAST) AS place FROM emitted)
GROUP BY ALL""")


def _stamped_events(stamps: str, upper: str) -> str:
    """Events before an upper bound with the stamp of the load that delivered them last."""
    return f"SELECT *, CASE {stamps} END AS insertion_date FROM events WHERE ts < TIMESTAMP '{upper}'"


ORACLE["layout_whole_to_days"] = _stamped_events(
    """WHEN ts > TIMESTAMP '2024-01-19' THEN TIMESTAMP '2024-01-25 06:00:00'
       WHEN ts > TIMESTAMP '2024-01-14' THEN TIMESTAMP '2024-01-20' ELSE TIMESTAMP '2024-01-15'""", "2024-01-25 06:00:00")
ORACLE["layout_whole_to_buckets"] = _stamped_events(
    """WHEN ts > TIMESTAMP '2024-01-18' THEN TIMESTAMP '2024-01-25 06:00:00'
       WHEN ts > TIMESTAMP '2024-01-14' THEN TIMESTAMP '2024-01-20' ELSE TIMESTAMP '2024-01-15'""", "2024-01-25 06:00:00")
ORACLE["first_delta_append"] = _stamped_events("WHEN TRUE THEN TIMESTAMP '2024-01-20'", "2024-01-20 00:00:00")

ORACLE["load_databases_one_write"] = """
SELECT *, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS source_db_id,
       CASE o_orderstatus WHEN 'O' THEN 2 ELSE 1 END AS market_profile_id, 2 AS versions
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')"""

ORACLE["config_audit"] = """
WITH batch AS (SELECT * FROM (VALUES (0, TIMESTAMP '1996-01-01'), (1, TIMESTAMP '2024-01-20')) v(batch_run_id, upper)),
db AS (SELECT * FROM (VALUES ('F', 'DB1'), ('O', 'DB2'), ('P', 'DB3')) v(status, db_code)),
loaded AS (
  SELECT batch_run_id, 'raw_orders' AS destination_table_name, db_code, 'incremental' AS operation,
         (SELECT count(*) FROM orders WHERE o_orderstatus = status AND o_orderdate < upper) AS n
  FROM batch, db
  UNION ALL
  SELECT batch_run_id, 'raw_events', NULL, 'append', (SELECT count(*) FROM events WHERE ts < upper) FROM batch)
SELECT CAST(batch_run_id AS BIGINT) AS batch_run_id, destination_table_name, db_code, operation,
       n AS input_row, n AS output_row, 'Success' AS operation_result
FROM loaded"""

ORACLE["silver_target_sync"] = """
SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, props, '2024-01-25 06:00:00' AS insertion_date,
       'event_id:bigint,event_type:string,user_id:string,props:string,insertion_date:timestamp_ntz' AS kinds
FROM events"""

ORACLE["join_enrichment"] = """
SELECT c.*, n_name AS nation_name, n_regionkey, r_name AS region_name, CAST(NULL AS VARCHAR) AS unknown
FROM customer c LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey <> 7
LEFT JOIN region ON r_regionkey = n_regionkey"""

ORACLE["window_bounds"] = """
SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-03' THEN '2024-01-03 00:00:00' ELSE '2024-01-10 00:00:00' END AS upper_bound
FROM events WHERE ts < TIMESTAMP '2024-01-03' OR (ts > TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-10')"""
