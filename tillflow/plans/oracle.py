"""DuckDB SQL for each registered query (the correctness oracle).

The SQL is written independently of the DataFrame code, in the plain form of
the retail job (window sum + DISTINCT, rank() = 1), over the driver's tables.
Money is DECIMAL(18,2) on both sides; names match the DataFrame results.
"""

from __future__ import annotations

# Retail model over the driver tables (same mapping as tillflow.sources.tables).
RETAIL = """
sales AS (
  SELECT o.o_custkey AS customer_id, s.s_nationkey AS store_id, p.p_name AS product_name,
         CAST(l.l_shipdate AS DATE) AS sales_date, l.l_suppkey AS sales_person_id,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS price, CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_cost,
         o.o_orderpriority, o.o_orderstatus, l.l_returnflag, l.l_linestatus, l.l_discount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey),
dim_customer AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name, c_mktsegment AS address,
         CAST(c_nationkey AS VARCHAR) AS pincode, CAST(c_custkey AS VARCHAR) AS phone_number
  FROM customer),
dim_store AS (
  SELECT n_nationkey AS id, n_name AS address, 'Manager ' || n_name AS store_manager_name
  FROM nation),
dim_sales_team AS (
  SELECT s_suppkey AS id, split_part(s_name, '#', 1) AS first_name,
         split_part(s_name, '#', 2) AS last_name,
         min(s_suppkey) OVER (PARTITION BY s_nationkey) AS manager_id,
         CASE WHEN s_suppkey = min(s_suppkey) OVER (PARTITION BY s_nationkey)
              THEN 'Y' ELSE 'N' END AS is_manager,
         'Desk ' || CAST(s_suppkey AS VARCHAR) AS address,
         CAST(s_nationkey AS VARCHAR) AS pincode
  FROM supplier)"""

ENRICHED = RETAIL + """,
enriched_customer AS (
  SELECT s.customer_id, s.store_id, s.sales_date, s.sales_person_id, s.total_cost,
         c.first_name, c.last_name, c.address, c.pincode, c.phone_number
  FROM sales s JOIN dim_customer c ON s.customer_id = c.customer_id),
enriched_store AS (
  SELECT e.*, st.address AS store_address, st.store_manager_name
  FROM enriched_customer e JOIN dim_store st ON st.id = e.store_id),
enriched AS (
  SELECT e.*, t.first_name AS sales_person_first_name, t.last_name AS sales_person_last_name,
         t.manager_id, t.is_manager, t.address AS sales_person_address,
         t.pincode AS sales_person_pincode
  FROM enriched_store e JOIN dim_sales_team t ON t.id = e.sales_person_id),
customer_extract AS (
  SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost
  FROM enriched),
sales_team_extract AS (
  SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name,
         store_manager_name, manager_id, is_manager, sales_person_address, sales_person_pincode,
         sales_date, total_cost, strftime(sales_date, '%Y-%m') AS sales_month
  FROM enriched)"""

# The retail job's own form: window total, then DISTINCT.
SALESPERSON_MONTHLY = """
salesperson_monthly AS (
  SELECT DISTINCT store_id, sales_person_id,
         sales_person_first_name || ' ' || sales_person_last_name AS full_name, sales_month,
         CAST(sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month)
              AS DECIMAL(18,2)) AS total_sales
  FROM sales_team_extract)"""


def customer_monthly_sql(extract: str) -> str:
    return f"""
SELECT DISTINCT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
       strftime(sales_date, '%Y-%m') AS sales_date_month,
       CAST(sum(total_cost) OVER (PARTITION BY customer_id, strftime(sales_date, '%Y-%m'))
            AS DECIMAL(18,2)) AS total_sales
FROM {extract}"""


TOP_SELLER_INCENTIVE = f"""WITH {ENRICHED},{SALESPERSON_MONTHLY}
SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
       CAST(CASE WHEN rank() OVER (PARTITION BY store_id, sales_month
                                   ORDER BY total_sales DESC NULLS LAST) = 1
                 THEN round(total_sales * 0.01, 2) ELSE 0 END AS DECIMAL(18,2)) AS incentive
FROM salesperson_monthly"""

ORACLES: dict[str, str] = {
    "top_seller_incentive": TOP_SELLER_INCENTIVE,
    "salesperson_monthly_sales": f"""WITH {ENRICHED},{SALESPERSON_MONTHLY}
SELECT * FROM salesperson_monthly""",
    "sales_rank_in_store_month": f"""WITH {ENRICHED},{SALESPERSON_MONTHLY}
SELECT *, CAST(rank() OVER (PARTITION BY store_id, sales_month
                            ORDER BY total_sales DESC NULLS LAST) AS INTEGER) AS sales_rank
FROM salesperson_monthly""",
    "customer_monthly_spend": f"WITH {ENRICHED}" + customer_monthly_sql("customer_extract"),
    "enrich_customer": f"WITH {ENRICHED} SELECT * FROM enriched_customer",
    "enrich_store": f"WITH {ENRICHED} SELECT * FROM enriched_store",
    "enrich_full": f"WITH {ENRICHED} SELECT * FROM enriched",
    "customer_mart_extract": f"WITH {ENRICHED} SELECT * FROM customer_extract",
    "sales_team_mart_extract": f"WITH {ENRICHED} SELECT * FROM sales_team_extract",
}

# The sales facts with the two extra columns of the drop files.
WITH_EXTRAS = """,
sales_x AS (
  SELECT *, CASE o_orderstatus WHEN 'F' THEN 'card' WHEN 'O' THEN 'cash' END AS payment_mode,
         CASE WHEN l_returnflag = 'R' THEN 'RET-' || l_linestatus END AS coupon_code
  FROM sales)"""

SALES_COLS = ("customer_id, store_id, product_name, sales_date, sales_person_id, price, "
              "quantity, total_cost")

# Rows that reach the sales union: accepted layouts, well-formed rows.
ACCEPTED_WHERE = ("o_orderpriority <> '4-NOT SPECIFIED' "
                  "AND NOT (o_orderpriority = '2-HIGH' AND l_discount > 0.095)")

INGESTED = RETAIL + WITH_EXTRAS + f""",
ingested AS (
  SELECT {SALES_COLS},
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN concat_ws(', ', payment_mode, coupon_code)
         END AS additional_column
  FROM sales_x WHERE {ACCEPTED_WHERE})"""

INGESTED_EXTRACT = """
extract_i AS (
  SELECT c.customer_id, c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
         i.sales_date, i.total_cost
  FROM ingested i JOIN dim_customer c ON i.customer_id = c.customer_id
  JOIN dim_store st ON st.id = i.store_id
  JOIN dim_sales_team t ON t.id = i.sales_person_id)"""

# The drop layouts; a layout exists when its priority has sales.
LAYOUTS = """
layouts(priority, source_folder, header, accepted, missing_columns, extra_columns) AS (VALUES
  ('1-URGENT', 'plain_urgent',
   'customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost',
   true, '', ''),
  ('2-HIGH', 'plain_high',
   'customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost',
   true, '', ''),
  ('3-MEDIUM', 'extra',
   'customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode,coupon_code',
   true, '', 'payment_mode,coupon_code'),
  ('4-NOT SPECIFIED', 'missing',
   'customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode',
   false, 'store_id', 'payment_mode'),
  ('5-LOW', 'reordered',
   'total_cost,quantity,price,sales_person_id,sales_date,product_name,store_id,customer_id',
   true, '', ''))"""

LEDGER = """
days AS (
  SELECT CAST(o_orderdate AS DATE) AS day,
         max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS has_partial,
         max(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS has_open
  FROM orders GROUP BY 1),
files AS (
  SELECT 'sales_' || strftime(day, '%Y%m%d') || '.csv' AS file_name,
         'landing/' || strftime(day, '%Y-%m') AS file_location, day, has_partial, has_open
  FROM days),
events AS (
  SELECT file_name, file_location, 'A' AS status, CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS event_ts, 1 AS seq FROM files
  UNION ALL
  SELECT file_name, file_location, 'A', CAST(day + INTERVAL 2 DAY AS TIMESTAMP), 2 FROM files WHERE has_partial = 1
  UNION ALL
  SELECT file_name, file_location, 'I', CAST(day + INTERVAL 3 DAY AS TIMESTAMP), 3 FROM files WHERE has_open = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY event_ts DESC, seq DESC) AS rn,
         max(event_ts) OVER (PARTITION BY file_name) AS updated_at,
         count(*) OVER (PARTITION BY file_name) AS event_count
  FROM events),
current_status AS (
  SELECT file_name, file_location, status, updated_at, event_count FROM ranked WHERE rn = 1)"""

CUSTOMER_RENAMES = """,
dim_customer_2 AS (
  SELECT * FROM dim_customer
  UNION ALL
  SELECT customer_id, first_name, upper('x' || last_name), address, pincode, phone_number
  FROM dim_customer WHERE address = 'BUILDING'),
extract_2 AS (
  SELECT c.customer_id, c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
         s.sales_date, s.total_cost
  FROM sales s JOIN dim_customer_2 c ON s.customer_id = c.customer_id
  JOIN dim_store st ON st.id = s.store_id
  JOIN dim_sales_team t ON t.id = s.sales_person_id)"""

ORACLES.update({
    "customer_spend_shared_key": f"WITH {RETAIL}{CUSTOMER_RENAMES}" + customer_monthly_sql("extract_2"),
    "daily_store_sales": f"""WITH {ENRICHED}
SELECT store_id, sales_date, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales,
       count(*) AS sales_count
FROM enriched GROUP BY store_id, sales_date""",
    "product_sales": f"""WITH {RETAIL},
by_name AS (SELECT p_name AS product_name,
                   max(CAST(p_retailprice AS DECIMAL(18,2))) AS list_price
            FROM part GROUP BY p_name)
SELECT s.product_name, strftime(s.sales_date, '%Y-%m') AS sales_month,
       CAST(sum(s.quantity) AS BIGINT) AS units,
       CAST(sum(s.total_cost) AS DECIMAL(18,2)) AS revenue, b.list_price
FROM sales s JOIN by_name b ON s.product_name = b.product_name
GROUP BY s.product_name, strftime(s.sales_date, '%Y-%m'), b.list_price""",
    "orphan_sales": f"""WITH {RETAIL},
flagged AS (
  SELECT {SALES_COLS},
         NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = s.customer_id) AS missing_customer,
         NOT EXISTS (SELECT 1 FROM dim_store r WHERE r.id = s.store_id) AS missing_store,
         NOT EXISTS (SELECT 1 FROM dim_sales_team t WHERE t.id = s.sales_person_id) AS missing_sales_person
  FROM sales s)
SELECT * FROM flagged WHERE missing_customer OR missing_store OR missing_sales_person""",
    "orphan_sales_of_region": f"""WITH {RETAIL},
region_stores AS (SELECT n_nationkey AS id FROM nation JOIN region ON n_regionkey = r_regionkey
                  WHERE r_name = 'AMERICA'),
flagged AS (
  SELECT {SALES_COLS},
         NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = s.customer_id) AS missing_customer,
         NOT EXISTS (SELECT 1 FROM region_stores r WHERE r.id = s.store_id) AS missing_store,
         NOT EXISTS (SELECT 1 FROM dim_sales_team t WHERE t.id = s.sales_person_id) AS missing_sales_person
  FROM sales s)
SELECT * FROM flagged WHERE missing_customer OR missing_store OR missing_sales_person""",
    "scalar_semantics": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS order_month,
       o_orderpriority || ' ' || NULLIF(o_orderstatus, 'P') AS label,
       concat_ws(', ', NULLIF(o_orderstatus, 'P'),
                 CASE WHEN o_orderpriority = '1-URGENT' THEN 'rush' END) AS folded,
       CASE WHEN NULLIF(o_orderstatus, 'P') = 'F' THEN 'closed' ELSE 'open' END AS state,
       CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.01, 2) AS DECIMAL(18,2)) AS cents
FROM orders""",
    "csv_header_gate": f"""WITH {LAYOUTS}
SELECT source_folder, header, accepted, missing_columns, extra_columns FROM layouts
WHERE priority IN (SELECT o.o_orderpriority FROM orders o
                   JOIN lineitem l ON l.l_orderkey = o.o_orderkey)""",
    "csv_ingest_union": f"WITH {INGESTED} SELECT * FROM ingested",
    "fold_extra_columns": f"""WITH {RETAIL}{WITH_EXTRAS}
SELECT {SALES_COLS}, concat_ws(', ', payment_mode, coupon_code) AS additional_column
FROM sales_x""",
    "quarantine_report": f"""WITH {RETAIL}
SELECT 'MISSING_COLUMNS' AS reason, 'missing' AS source_folder, 'store_id' AS missing_columns,
       count(*) AS record_count
FROM sales WHERE o_orderpriority = '4-NOT SPECIFIED' HAVING count(*) > 0
UNION ALL
SELECT 'CORRUPT_ROW', 'plain_high', NULL, count(*)
FROM sales WHERE o_orderpriority = '2-HIGH' AND l_discount > 0.095 HAVING count(*) > 0
UNION ALL
SELECT 'NOT_CSV', 'misc', NULL, count(*) FROM region HAVING count(*) > 0""",
    "ledger_current_status": f"WITH {LEDGER} SELECT * FROM current_status",
    "ledger_open_files": f"""WITH {LEDGER}
SELECT DISTINCT f.file_name FROM files f
WHERE f.has_partial = 1
  AND EXISTS (SELECT 1 FROM current_status c WHERE c.file_name = f.file_name AND c.status = 'A')""",
    "parquet_mart_roundtrip": f"WITH {ENRICHED} SELECT * FROM customer_extract",
    "partitioned_mart_month": f"WITH {ENRICHED} SELECT * FROM sales_team_extract",
    "latest_snapshot": f"WITH {ENRICHED}" + customer_monthly_sql("customer_extract"),
    "mart_month_refresh": TOP_SELLER_INCENTIVE,
    "partitioned_mart_one_store_month": f"""WITH {ENRICHED}
SELECT * FROM sales_team_extract WHERE sales_month = '1998-05' AND store_id = 7""",
    "file_manifest": f"""WITH {LAYOUTS}
SELECT source_folder, 'CSV' AS kind, '.csv' AS extension FROM layouts
WHERE priority IN (SELECT o.o_orderpriority FROM orders o
                   JOIN lineitem l ON l.l_orderkey = o.o_orderkey)
UNION ALL
SELECT 'misc', 'NOT_CSV', '.json' FROM region HAVING count(*) > 0""",
    "stream_archive": f"""WITH {LAYOUTS}
SELECT source_folder, 'CSV' AS kind FROM layouts
WHERE priority IN (SELECT o.o_orderpriority FROM orders o
                   JOIN lineitem l ON l.l_orderkey = o.o_orderkey)
UNION ALL
SELECT 'misc', 'NOT_CSV' FROM region HAVING count(*) > 0""",
    "files_ledger_status": f"""WITH {LAYOUTS}
SELECT source_folder, 'I' AS status, true AS opened_and_closed, true AS stamped FROM layouts
WHERE accepted AND priority IN (SELECT o.o_orderpriority FROM orders o
                                JOIN lineitem l ON l.l_orderkey = o.o_orderkey)""",
    "files_to_customer_mart": f"WITH {INGESTED},{INGESTED_EXTRACT}" + customer_monthly_sql("extract_i"),
    "files_to_sales_team_mart": f"""WITH {INGESTED},
sums AS (
  SELECT CAST(i.store_id AS BIGINT) AS store_id, i.sales_person_id,
         t.first_name || ' ' || t.last_name AS full_name,
         strftime(i.sales_date, '%Y-%m') AS sales_month,
         CAST(sum(i.total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM ingested i JOIN dim_customer c ON i.customer_id = c.customer_id
  JOIN dim_store st ON st.id = i.store_id
  JOIN dim_sales_team t ON t.id = i.sales_person_id
  GROUP BY 1, 2, 3, 4)
SELECT *, CAST(CASE WHEN total_sales = max(total_sales) OVER (PARTITION BY store_id, sales_month)
               THEN round(total_sales * 0.01, 2) ELSE 0 END AS DECIMAL(18,2)) AS incentive
FROM sums""",
    "stream_ingest_available_now": f"WITH {INGESTED},{INGESTED_EXTRACT}" + customer_monthly_sql("extract_i"),
})


# Folders by run: the first run's priorities, then the others and the file that is not CSV.
RUNS = f"""{LAYOUTS},
landed AS (
  SELECT *, CASE WHEN priority IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED') THEN 'run-1' ELSE 'run-2' END AS run_id
  FROM layouts
  WHERE priority IN (SELECT o.o_orderpriority FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey))"""

ORACLES.update({
    "two_runs_customer_mart": ORACLES["files_to_customer_mart"],
    "two_runs_sales_team_mart": ORACLES["files_to_sales_team_mart"],
    "two_runs_files": f"""WITH {RUNS}
SELECT source_folder, run_id, unnest(['A', 'I']) AS status FROM landed WHERE accepted
UNION ALL
SELECT source_folder, run_id, 'MISSING_COLUMNS' FROM landed WHERE NOT accepted
UNION ALL
SELECT 'plain_high', 'run-2', 'CORRUPT_ROW' FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderpriority = '2-HIGH' AND l.l_discount > 0.095 HAVING count(*) > 0
UNION ALL
SELECT 'misc', 'run-2', 'NOT_CSV' FROM region HAVING count(*) > 0""",
    "two_runs_archive": f"""WITH {RUNS}
SELECT CASE WHEN accepted THEN 'processed' ELSE 'rejected' END AS place, run_id, source_folder, 'CSV' AS kind FROM landed
UNION ALL
SELECT 'rejected', 'run-2', 'misc', 'NOT_CSV' FROM region HAVING count(*) > 0""",
    "two_runs_extract": f"""WITH {INGESTED}
SELECT i.store_id, i.sales_person_id, t.first_name AS sales_person_first_name, t.last_name AS sales_person_last_name,
       st.store_manager_name, t.manager_id, t.is_manager, t.address AS sales_person_address,
       t.pincode AS sales_person_pincode, i.sales_date, i.total_cost, strftime(i.sales_date, '%Y-%m') AS sales_month
FROM ingested i JOIN dim_customer c ON i.customer_id = c.customer_id
JOIN dim_store st ON st.id = i.store_id JOIN dim_sales_team t ON t.id = i.sales_person_id""",
    "published_snapshots": f"""WITH {ENRICHED},{SALESPERSON_MONTHLY}
SELECT 2 AS run_id, count(*) AS n_rows, CAST(NULL AS BIGINT) AS rows_read FROM salesperson_monthly
UNION ALL SELECT 3, 0, 0""",
    "catalog_customers_data_mart": ORACLES["customer_monthly_spend"],
    "catalog_sales_team_data_mart": TOP_SELLER_INCENTIVE,
    "catalog_open_files": f"WITH {LEDGER} SELECT file_name FROM current_status WHERE status = 'A'",
    "mart_of_some_stores": f"""WITH {ENRICHED}
SELECT store_id, store_address AS address, strftime(sales_date, '%Y-%m') AS sales_month,
       CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales, count(*) AS sales_count
FROM enriched WHERE starts_with(store_address, 'NATION_2') GROUP BY ALL""",
})
