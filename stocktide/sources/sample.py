"""The given tables (orders, lineitem, customer, part, events, ...) shaped into feeds.

Each feed is one SQL text that Spark runs here and that the check queries run in their own engine, so both start
from the same rows. All rules are arithmetic on keys. ``SQL`` may name earlier entries.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations")

SQL: dict[str, str] = {}

# Point-of-sale lines. The +05:30 shift crosses midnight for a quarter of the parts; the unit is unknown before
# 1998 and the quantity changes its name then; line 7 arrives three days late; (order, line) repeats.
SQL["feed_pos"] = """
SELECT CAST(l.l_orderkey AS STRING) AS txn_id,
       CAST(l.l_linenumber AS SMALLINT) AS txn_line_no,
       CAST(l.l_orderkey AS STRING) AS basket_id,
       CAST(o.o_custkey AS STRING) AS outlet_code,
       c.c_mktsegment AS channel,
       CAST(l.l_partkey AS STRING) AS sku_code,
       replace(CAST(CASE WHEN l.l_partkey % 4 = 0 THEN o.o_orderdate + INTERVAL '20' HOUR
                         ELSE o.o_orderdate + INTERVAL '10' HOUR END AS STRING), ' ', 'T') || 'Z' AS event_ts,
       CASE WHEN o.o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN CAST(l.l_quantity AS INT) END AS qty,
       CASE WHEN o.o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' THEN CAST(l.l_quantity AS INT) END AS quantity_units,
       CASE WHEN o.o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN NULL
            WHEN l.l_suppkey % 5 = 0 THEN 'CS' ELSE 'EA' END AS uom,
       p.p_retailprice AS unit_price,
       CAST(CAST(CAST(l.l_quantity AS DECIMAL(6,0)) * CAST(p.p_retailprice AS DECIMAL(12,2))
                 * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DOUBLE) AS discount_amount,
       CAST(CAST(CAST(l.l_quantity AS DECIMAL(6,0)) * CAST(p.p_retailprice AS DECIMAL(12,2))
                 * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DOUBLE) AS tax_amount,
       CASE WHEN l.l_suppkey % 3 = 0 THEN 'CASH' WHEN l.l_suppkey % 3 = 1 THEN 'CARD' ELSE 'CREDIT' END AS payment_mode,
       CAST(l.l_suppkey % 4 AS SMALLINT) AS till_id,
       'C' || CAST(l.l_suppkey % 50 AS STRING) AS cashier_id,
       CASE WHEN l.l_returnflag = 'R' THEN 'PROMO' END AS promo_code,
       CASE WHEN o.o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND l.l_suppkey % 2 = 0
            THEN 'L' || CAST(o.o_custkey AS STRING) END AS loyalty_id,
       'pos_' || l.l_linestatus AS source_file,
       CASE WHEN l.l_linenumber = 7 THEN CAST(o.o_orderdate AS DATE) + 3
            WHEN l.l_partkey % 4 = 0 THEN CAST(o.o_orderdate AS DATE) + 1
            ELSE CAST(o.o_orderdate AS DATE) END AS ingest_date
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
"""

# Refrigerated transport readings: one vendor sends Fahrenheit, one firmware runs seven hours ahead, every 31st
# event is delivered twice. Every 29th device moves between two vehicles.
SQL["feed_telemetry"] = """
SELECT CAST(e.user_id AS STRING) AS device_id,
       CASE WHEN e.user_id % 3 = 0 THEN 'COLDEYE' ELSE 'THERMLOG' END AS telemetry_vendor,
       CASE WHEN e.user_id % 11 = 0 THEN '2.1.4' ELSE '2.0.9' END AS firmware_version,
       'V' || CAST(CASE WHEN e.user_id % 29 = 0 THEN e.user_id + e.event_id % 2 * 1000000 ELSE e.user_id END AS STRING) AS vehicle_registration,
       'R' || CAST(e.event_id % 260 AS STRING) AS route_code,
       CAST(e.event_id % 8 AS STRING) AS warehouse_code,
       'G' || CAST(e.user_id % 10 AS STRING) AS gateway_id,
       CAST(CASE WHEN e.user_id % 11 = 0 THEN e.ts + INTERVAL '7' HOUR ELSE e.ts END AS STRING) AS reading_ts,
       CASE WHEN e.event_id % 170 = 0 THEN NULL
            WHEN e.user_id % 3 = 0 THEN e.value / CAST(10 AS DOUBLE) * CAST(9 AS DOUBLE) / CAST(5 AS DOUBLE) + CAST(32 AS DOUBLE)
            ELSE e.value / CAST(10 AS DOUBLE) END AS temp_value,
       CASE WHEN e.event_id % 12 = 0 THEN NULL WHEN e.user_id % 3 = 0 THEN 'F' ELSE 'C' END AS temp_unit,
       CAST(e.event_id % 101 AS DOUBLE) AS humidity_pct,
       CAST(e.event_id % 2 AS TINYINT) AS door_open_flag,
       CAST(e.event_id % 90 AS DOUBLE) AS gps_lat,
       CAST(e.event_id % 180 AS DOUBLE) AS gps_lon,
       CAST(e.event_id % 100 AS DOUBLE) AS battery_pct,
       CAST(e.ts AS DATE) AS dt
FROM events e
JOIN (SELECT 1 AS copy UNION ALL SELECT 2) d ON d.copy = 1 OR e.event_id % 31 = 0
"""

# The readings as completeness finds them: gateway 7 is silent for two days.
SQL["feed_telemetry_gapped"] = """
SELECT * FROM feed_telemetry WHERE NOT (gateway_id = 'G7' AND dt IN (DATE '2024-01-11', DATE '2024-01-12'))
"""

# Warehouse scans.
SQL["feed_wms"] = """
SELECT CAST(e.event_id AS STRING) AS scan_id,
       CAST(e.event_id % 8 AS STRING) AS warehouse_code,
       CASE e.event_type WHEN 'view' THEN 'RECEIVE' WHEN 'click' THEN 'PUTAWAY' WHEN 'signup' THEN 'PICK'
            WHEN 'error' THEN 'PACK' ELSE CASE WHEN e.event_id % 2 = 0 THEN 'STAGE' ELSE 'DISPATCH' END END AS event_type,
       CAST(e.user_id AS STRING) AS order_number,
       CAST(e.event_id % 97 AS STRING) AS sku_code,
       CAST(e.event_id % 501 AS STRING) AS batch_id,
       CAST(e.event_id % 40 AS SMALLINT) AS qty_cases,
       CAST(e.event_id % 307 AS STRING) AS pallet_id,
       CAST(e.event_id % 12 AS TINYINT) AS dock_door,
       'OP' || CAST(e.event_id % 60 AS STRING) AS operator_id,
       'HH' || CAST(e.event_id % 25 AS STRING) AS handheld_device,
       CAST(e.ts AS STRING) AS event_ts,
       CAST(e.ts AS DATE) AS dt
FROM events e
"""

# The scans as completeness finds them: the 17th is absent, the 20th keeps a third and the 24th 60% of its scans.
SQL["feed_wms_gapped"] = """
SELECT * FROM feed_wms
WHERE dt <> DATE '2024-01-17' AND NOT (dt = DATE '2024-01-20' AND CAST(scan_id AS BIGINT) % 3 > 0)
  AND NOT (dt = DATE '2024-01-24' AND CAST(scan_id AS BIGINT) % 5 > 2)
"""

# Outlet changes: the customer as first version, then one change per order; most attributes are noise.
SQL["feed_outlet"] = """
SELECT CAST(c.c_custkey AS STRING) AS outlet_code, 'I' AS __op, '1994-12-31 00:00:00' AS __op_ts,
       c.c_custkey - 100000000 AS __seq, c.c_name AS outlet_name, c.c_mktsegment AS channel,
       'F' || CAST(c.c_custkey % 4 AS STRING) AS outlet_format, 'CITY' || CAST(c.c_custkey % 13 AS STRING) AS city,
       'R' || CAST(c.c_custkey % 260 AS STRING) AS route_code, CAST(c.c_nationkey AS STRING) AS warehouse_code,
       CAST(c.c_custkey % 9 * 1000 AS DOUBLE) AS credit_limit, c.c_custkey % 60 AS credit_terms_days,
       'GST' || CAST(c.c_custkey AS STRING) AS gst_number, 'ACTIVE' AS status, DATE '1994-12-31' AS extract_date
FROM customer c
UNION ALL
SELECT CAST(c.c_custkey AS STRING), CASE WHEN o.o_orderkey % 97 = 0 THEN 'D' ELSE 'U' END, CAST(o.o_orderdate AS STRING),
       o.o_orderkey, c.c_name, o.o_orderpriority,
       'F' || CAST(o.o_orderkey % 4 AS STRING), 'CITY' || CAST(o.o_orderkey % 13 AS STRING),
       'R' || CAST(o.o_orderkey % 260 AS STRING), CAST(c.c_nationkey AS STRING),
       CAST(o.o_orderkey % 9 * 1000 AS DOUBLE), o.o_orderkey % 60,
       'GST' || CAST(c.c_custkey AS STRING), 'ACTIVE', CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 5 AS INT)
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

# Product changes from all lines; a sixtieth of the orders' lines is extracted a second time two days later.
SQL["feed_product"] = """
SELECT CAST(p.p_partkey AS STRING) AS sku_code, 'I' AS __op, '1994-12-31 00:00:00' AS __op_ts,
       p.p_partkey - 100000000 AS __seq, p.p_name AS product_name, p.p_type AS category, p.p_brand AS brand,
       CAST(p.p_size AS BIGINT) AS case_pack, p.p_retailprice AS mrp, p.p_retailprice AS list_price,
       CAST(p.p_partkey % 4 * 6 AS DOUBLE) AS gst_rate_pct, p.p_partkey % 365 AS shelf_life_days,
       p.p_partkey % 2 AS is_chilled, 'ACTIVE' AS status, DATE '1994-12-31' AS extract_date
FROM part p
UNION ALL
SELECT CAST(p.p_partkey AS STRING), CASE WHEN l.l_orderkey % 860 = 0 THEN 'D' ELSE 'U' END, CAST(l.l_shipdate AS STRING),
       l.l_orderkey * 10 + l.l_linenumber, p.p_name, p.p_type, 'Brand#' || CAST(l.l_orderkey % 25 AS STRING),
       CAST(p.p_size AS BIGINT), p.p_retailprice + CAST(l.l_orderkey % 100 AS DOUBLE), p.p_retailprice,
       CAST(l.l_orderkey % 4 * 6 AS DOUBLE), l.l_orderkey % 365,
       p.p_partkey % 2, 'ACTIVE', CAST(l.l_shipdate AS DATE) + 2 * d.copy
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN (SELECT 0 AS copy UNION ALL SELECT 1) d ON d.copy = 0 OR l.l_orderkey % 60 = 0
"""

# Order changes: insert, one or two updates, and a deletion that copies the insert with its time.
SQL["feed_order"] = """
SELECT CAST(o.o_orderkey AS STRING) AS order_number, s.op AS __op,
       CAST(CASE s.step WHEN 1 THEN o.o_orderdate + INTERVAL '6' HOUR
                        WHEN 2 THEN o.o_orderdate + INTERVAL '12' HOUR ELSE o.o_orderdate END AS STRING) AS __op_ts,
       o.o_orderkey * 10 + CASE s.step WHEN 3 THEN 1000000000 ELSE s.step END AS __seq,
       CAST(o.o_custkey AS STRING) AS outlet_code, CAST(o.o_custkey % 25 AS STRING) AS warehouse_code,
       'R' || CAST(o.o_orderkey % 260 AS STRING) AS route_code,
       CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS order_date,
       CAST(CAST(o.o_orderdate AS DATE) + 1 + CAST((o.o_orderkey + s.step) % 3 AS INT) AS STRING) AS requested_delivery_date,
       CASE s.step WHEN 1 THEN 'CONFIRMED' WHEN 2 THEN 'DISPATCHED' ELSE 'CREATED' END AS order_status,
       CAST((o.o_orderkey + s.step) % 20 + 1 AS SMALLINT) AS line_count,
       CAST(CAST((CAST(o.o_totalprice AS DECIMAL(12,2)) + CASE s.step WHEN 3 THEN 0 ELSE s.step END)
            * CASE WHEN o.o_orderpriority = '5-LOW' THEN 1.085 ELSE 1.000 END AS DECIMAL(18,2)) AS DOUBLE) AS order_value_gross,
       CAST((o.o_orderkey * 7919 + s.step * 31) % 900000 AS DOUBLE) / CAST(100 AS DOUBLE) AS discount_amount,
       CAST(20000 + (o.o_orderkey * 104729 + s.step * 17) % 5180000 AS DOUBLE) / CAST(100 AS DOUBLE) AS tax_amount,
       CASE o.o_orderpriority WHEN '5-LOW' THEN 'PARTNER_API' WHEN '4-NOT SPECIFIED' THEN 'ERP_WEB' ELSE 'SFA_MOBILE' END AS source_system,
       CASE s.step WHEN 3 THEN CAST(o.o_orderdate AS DATE) + 2 + CAST(o.o_orderkey % 29 AS INT)
                   ELSE CAST(o.o_orderdate AS DATE) END AS extract_date
FROM orders o
JOIN (SELECT 0 AS step, 'I' AS op UNION ALL SELECT 1, 'U' UNION ALL SELECT 2, 'U' UNION ALL SELECT 3, 'D') s
  ON s.step < 2 OR (s.step = 2 AND o.o_orderkey % 3 = 0) OR (s.step = 3 AND o.o_orderkey % 111 = 0)
"""

SQL["ref_uom"] = """
SELECT CAST(p_partkey AS STRING) AS sku_code, p_size AS eaches_per_case, 'EA' AS base_uom, 'CS' AS case_uom
FROM part WHERE p_partkey % 24 <> 0
"""

SQL["ref_warehouse"] = """
SELECT CAST(n.n_nationkey AS STRING) AS warehouse_code, n.n_name AS warehouse_name,
       'CITY' || CAST(n.n_nationkey AS STRING) AS city, r.r_name AS region_name, 'Asia/Kolkata' AS timezone,
       100 + 10 * n.n_nationkey AS chilled_capacity_pallets
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""

SQL["ref_carrier"] = """
SELECT 'CR-' || CAST(s_suppkey AS STRING) AS carrier_id, s_name AS carrier_name,
       CASE WHEN s_suppkey % 3 = 0 THEN 'SURFACE' WHEN s_suppkey % 3 = 1 THEN 'REEFER' ELSE 'LCV' END AS mode,
       CAST(12 + s_suppkey % 37 AS INT) AS sla_hours,
       CAST(20 + s_suppkey % 35 AS DOUBLE) AS rate_per_km
FROM supplier
"""

# Published weekly report: every seventh day from 1995 on, for each channel; unrelated to the sales.
SQL["ref_legacy"] = """
SELECT DATE '1995-01-01' + 7 * w.week_no AS week_ending, w.channel,
       CAST(200000 + (w.week_no * 7919 + w.len * 104729) % 1400000 AS DOUBLE) AS gross_sales_inr,
       CAST(4000 + (w.week_no * 31 + w.len * 7) % 9000 AS BIGINT) AS units_sold,
       CAST(10 + (w.week_no * 3 + w.len) % 90 AS BIGINT) AS basket_count,
       'Finance' AS prepared_by, 'As published' AS note
FROM (SELECT DISTINCT CAST(floor(datediff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) / CAST(7 AS DOUBLE)) AS INT) AS week_no,
             c.c_mktsegment AS channel, CAST(length(c.c_mktsegment) AS INT) AS len
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) w
"""

# Manifest of what was written, with planted deviations: short and surplus partitions, an unlisted one, and one
# that was never written.
SQL["ref_manifest"] = """
SELECT 'pos_transactions' AS feed, 'ingest_date=' || CAST(ingest_date AS STRING) AS partition,
       CAST(4 AS BIGINT) AS file_count, count(*) AS row_count, count(*) * 40 AS bytes
FROM feed_pos GROUP BY ingest_date
UNION ALL
SELECT 'reefer_telemetry', 'dt=' || CAST(dt AS STRING), CAST(8 AS BIGINT),
       count(*) + CASE WHEN extract(DAY FROM dt) % 7 = 0 THEN 5 WHEN extract(DAY FROM dt) % 11 = 0 THEN -3 ELSE 0 END,
       count(*) * 50
FROM feed_telemetry_gapped WHERE dt <> DATE '2024-01-09' GROUP BY dt
UNION ALL
SELECT 'reefer_telemetry', 'dt=2024-02-15', CAST(8 AS BIGINT), count(*) % 1000 + 1, CAST(900 AS BIGINT) FROM feed_telemetry_gapped
UNION ALL
SELECT 'wms_scan_events', 'dt=' || CAST(dt AS STRING), CAST(2 AS BIGINT), count(*), count(*) * 30
FROM feed_wms_gapped GROUP BY dt
"""

# The first and last day on which each feed is expected, from the tables it is derived from.
SQL["ref_feed_spans"] = """
SELECT 'pos_transactions' AS feed, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) + 3 AS last_day FROM orders
UNION ALL SELECT 'erp_cdc/sales_order_header', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) + 30 FROM orders
UNION ALL SELECT 'erp_cdc/outlet_master', DATE '1994-12-31', max(CAST(o_orderdate AS DATE)) + 4 FROM orders
UNION ALL SELECT 'erp_cdc/product_master', DATE '1994-12-31', max(CAST(l_shipdate AS DATE)) + 2 FROM lineitem
UNION ALL SELECT 'reefer_telemetry', min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) FROM events
UNION ALL SELECT 'wms_scan_events', min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) FROM events
"""

# Questions: the user turns of the conversations, and one composed question per order with a period phrase.
SQL["questions"] = """
SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user'
UNION ALL
SELECT -1 - o.o_orderkey, CAST(0 AS BIGINT),
       CASE o.o_orderkey % 19
         WHEN 0 THEN 'Gross sales by channel'
         WHEN 1 THEN 'What were net sales & baskets by month?'
         WHEN 2 THEN 'Revenue for category ' || o.o_orderpriority
         WHEN 3 THEN 'Units sold'
         WHEN 4 THEN 'How many units in eaches'
         WHEN 5 THEN 'Top 10 SKUs and outlets'
         WHEN 6 THEN 'How does that reconcile with the FINANCE report'
         WHEN 7 THEN 'Order value by source system'
         WHEN 8 THEN 'Excursion rate'
         WHEN 9 THEN 'Gateway outage and missing readings'
         WHEN 10 THEN 'Which days have missing data in any feed?'
         WHEN 11 THEN 'Dock-to-dispatch cycle time by warehouse'
         WHEN 12 THEN 'Excursion rate by carrier'
         WHEN 13 THEN 'Which outlets changed channel'
         WHEN 14 THEN 'Order tax and net value'
         WHEN 15 THEN 'What share of chilled trips breached temperature'
         WHEN 16 THEN 'Turnover by regional zone'
         WHEN 17 THEN 'Tell me a story about ' || c.c_name
         ELSE 'Sales: quarterly, by channel (' || c.c_mktsegment || ')' END
       || ' ' ||
       CASE o.o_orderkey % 13
         WHEN 0 THEN 'last quarter'
         WHEN 1 THEN 'last complete quarter'
         WHEN 2 THEN 'previous quarter'
         WHEN 3 THEN 'last 7 days'
         WHEN 4 THEN 'in the last 30 days'
         WHEN 5 THEN 'last 90 days!'
         WHEN 6 THEN 'last month'
         WHEN 7 THEN 'this month'
         WHEN 8 THEN 'last year'
         WHEN 9 THEN 'over all time'
         WHEN 10 THEN 'FY' || substr(CAST(o.o_orderdate AS STRING), 3, 2) || ' Q' || CAST(1 + o.o_custkey % 4 AS STRING)
         WHEN 11 THEN CASE o.o_custkey % 4 WHEN 0 THEN 'in June ' WHEN 1 THEN 'sept ' WHEN 2 THEN 'February ' ELSE 'Dec ' END
                      || substr(CAST(o.o_orderdate AS STRING), 1, 4)
         ELSE '' END
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""


# The same joins in another order, where Spark would take them as they are written: customers meet their orders before the
# many lines do, which travel once less, and copies are made before parts are met, so that a condition on a line and its
# copy is applied before lines travel. Rows and columns are those of the text above.
ORDER = (
    (
        "JOIN orders o ON l.l_orderkey = o.o_orderkey\nJOIN customer c ON o.o_custkey = c.c_custkey\n",
        "JOIN (orders o JOIN customer c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey\n",
    ),
    (
        "FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey\nJOIN (SELECT 0 AS copy UNION ALL SELECT 1) d ON d.copy = 0 OR l.l_orderkey % 60 = 0\n",
        "FROM lineitem l JOIN (SELECT 0 AS copy UNION ALL SELECT 1) d ON d.copy = 0 OR l.l_orderkey % 60 = 0\nJOIN part p ON l.l_partkey = p.p_partkey\n",
    ),
)


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Run one adapter over the tables of ``sf_dir``; names in the text resolve to tables or earlier adapters."""
    text = SQL[name].replace("datediff('day', ", "datediff(DAY, ")
    for written, ordered in ORDER:
        text = text.replace(written, ordered)
    names = {w for w in re.findall(r"\b(?:FROM|JOIN)\s+\(?(\w+)", text)}
    inputs = {}
    for ref in names & {*TABLES, *SQL}:
        source = feed(spark, sf_dir, ref) if ref in SQL else spark.read.parquet(f"{sf_dir}/{ref}.parquet")
        inputs[ref] = source
        text = re.sub(rf"\b(FROM|JOIN)\s+(\(?){ref}\b", rf"\1 \2{{{ref}}}", text)
    return spark.sql(text, **inputs)
