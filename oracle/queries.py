"""SQL for each registered query. Where none stands, the reason is in ``WITHOUT_SQL``."""

from __future__ import annotations

from oracle.relations import REL, with_relations
from stocktide.plans.intents import INTENTS

Q: dict[str, str] = {}
WITHOUT_SQL: dict[str, str] = {}
MODELS = (
    "stg_pos_transactions", "stg_reefer_telemetry", "stg_wms_scan_events", "stg_outlet_history", "stg_product_history",
    "stg_sales_order_header", "dim_outlet", "dim_product", "dim_calendar", "dim_warehouse", "dim_carrier", "fct_orders",
    "fct_cold_chain_readings", "fct_warehouse_cycle_time", "fct_sales", "dq_partition_reconciliation",
    "dq_feed_completeness", "dq_gateway_health", "rpt_finance_reconciliation",
)
TOP_N, FISCAL_YEAR, FISCAL_QUARTER = 25, "FY00", "Q3"

# --- sources and sinks
Q["scan_partitioned"] = "SELECT dt, event_type, count(*) AS scans, sum(qty_cases)::BIGINT AS cases, max(event_ts) AS latest FROM feed_wms GROUP BY ALL"
Q["scan_schema_drift"] = """
SELECT if(qty IS NULL, 'after', 'before') AS period, uom, count(*) AS lines, sum(qty)::BIGINT AS qty,
       sum(quantity_units)::BIGINT AS quantity_units, sum(ifnull(qty, quantity_units))::BIGINT AS qty_original,
       count(loyalty_id) AS loyal_lines
FROM feed_pos GROUP BY ALL
"""
Q["scan_skip_corrupt"] = "SELECT dt, count(*) AS readings, 0::BIGINT AS without_file, count(*) - count(temp_value) AS null_values FROM feed_telemetry GROUP BY dt"
Q["scan_found_corrupt"] = "SELECT dt, count(*) AS readings, count(*) - count(temp_value) AS null_values, 2::BIGINT AS cut_files FROM feed_telemetry GROUP BY dt"
Q["scan_csv_reference"] = "SELECT * FROM ref_uom"
Q["model_row_counts"] = " UNION ALL ".join(f"SELECT '{n}' AS model, count(*) AS row_count FROM {n}" for n in MODELS)
Q["build_tables"] = Q["model_row_counts"] + " UNION ALL SELECT 'rpt_sales_flat', count(*) FROM rpt_sales_flat"

# --- row-level rules
Q["utc_to_business_day"] = """
SELECT txn_id, txn_line_no, event_ts::TIMESTAMP AS event_ts_utc, event_ts::TIMESTAMP + INTERVAL 330 MINUTE AS event_ts_ist,
       (event_ts::TIMESTAMP + INTERVAL 330 MINUTE)::DATE AS event_date_ist FROM feed_pos
"""
Q["drift_coalesce"] = "SELECT txn_id, txn_line_no, ifnull(qty, quantity_units) AS qty_original, uom IS NULL AS uom_unknown_flag FROM feed_pos"
Q["late_arrival_flag"] = """
SELECT txn_id, txn_line_no, ingest_date, (event_ts::TIMESTAMP + INTERVAL 330 MINUTE)::DATE <> ingest_date AS is_late_arrival FROM feed_pos
"""
Q["clock_skew_fix"] = """
SELECT device_id, firmware_version, reading_ts::TIMESTAMP AS reading_ts,
       reading_ts::TIMESTAMP - INTERVAL 1 HOUR * if(firmware_version = '2.1.4', 7, 0) AS reading_ts_corrected FROM feed_telemetry
"""
_UNIT = "ifnull(temp_unit, if(telemetry_vendor = 'COLDEYE', 'F', 'C'))"
Q["unit_inference"] = f"SELECT telemetry_vendor, temp_unit, {_UNIT} AS temp_unit_resolved, count(*) AS readings FROM feed_telemetry GROUP BY ALL"
Q["unit_normalise"] = f"""
SELECT device_id, gps_lat, gps_lon, dt, temp_value, if({_UNIT} = 'C', temp_value, (temp_value - 32) * 5 / 9) AS temp_value_celsius,
       temp_value IS NULL AS temp_reading_missing FROM feed_telemetry
"""
Q["band_flags"] = """
SELECT temp_reading_missing, temp_value_celsius > 8 AS is_excursion, temp_value_celsius < 2 AS is_below_band,
       count(*) AS readings, min(temp_value_celsius) AS lowest, max(temp_value_celsius) AS highest
FROM stg_reefer_telemetry GROUP BY ALL
"""
Q["freight_correction"] = """
SELECT order_number, __seq AS seq, source_system, order_value_gross,
       if(source_system = 'PARTNER_API', round(order_value_gross / 1.085, 2), order_value_gross)::DECIMAL(18,2) AS order_value_gross_corrected
FROM feed_order
"""
Q["sales_measures"] = """
SELECT txn_id, txn_line_no, qty_original, unit_price, discount_amount, tax_amount, gross_sales_amount, net_sales_amount,
       sales_amount_incl_tax FROM fct_sales
"""
Q["units_eaches_line"] = "SELECT txn_id, txn_line_no, qty_original, uom_original, eaches_per_case, uom_conversion_missing, qty_eaches FROM fct_sales"

# --- windows
Q["dedup_keep_first"] = "SELECT * FROM pos_once"
Q["dedup_composite"] = "SELECT device_id, reading_ts::TIMESTAMP AS reading_ts, gps_lat, gps_lon, dt, temp_value, temp_unit FROM telemetry_once"
Q["dedup_cdc_guard"] = "SELECT sku_code, seq, op_type, op_ts, extract_date, brand, mrp::DOUBLE AS mrp FROM stg_product_history"
Q["cdc_version_no"] = "SELECT sku_code, seq, op_ts, version_no FROM stg_product_history"
Q["cdc_upsert"] = Q["cdc_version_no"]
Q["late_delivery"] = Q["dedup_keep_first"]
Q["stream_dedup"] = Q["dedup_composite"]
Q["scd2_windows"] = """
SELECT outlet_code, version_no, seq, valid_from, valid_to::VARCHAR AS valid_to, is_last_version, is_deleted, is_current FROM outlet_windows
"""
Q["ever_deleted"] = "SELECT outlet_code, bool_or(op_type = 'D') AS is_deleted, count(*) AS versions FROM stg_outlet_history GROUP BY outlet_code"
Q["canonical_snapshot"] = "SELECT order_number, op_type, op_ts, seq, version_no, order_value_gross, is_ever_deleted FROM order_best"
Q["dominant_value"] = "SELECT * FROM owners"
Q["median_baseline"] = "SELECT *, median(readings) OVER (PARTITION BY gateway_id) AS gateway_median FROM gateway_filled"
Q["trailing_mean"] = """
SELECT channel, calendar_date, n, day_absent,
       round(avg(n) OVER (PARTITION BY channel ORDER BY calendar_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 6) AS trailing_28d_mean
FROM (SELECT s.channel, s.calendar_date, count(p.txn_id) AS n, count(p.txn_id) = 0 AS day_absent
      FROM (SELECT channel, calendar_date FROM (SELECT DISTINCT channel FROM stg_pos_transactions) x, dim_calendar) s
      LEFT JOIN stg_pos_transactions p ON p.channel = s.channel AND p.event_date_ist = s.calendar_date GROUP BY ALL)
"""
Q["share_of_total"] = """
SELECT payment_mode, channel_at_sale, sum(gross_sales_amount)::DOUBLE AS gross_sales,
       round(100.0 * sum(gross_sales_amount)::DOUBLE / (SELECT sum(gross_sales_amount)::DOUBLE FROM fct_sales), 2) AS pct_of_total
FROM fct_sales GROUP BY ALL
"""

# --- joins
Q["lookup_left"] = "SELECT txn_id, txn_line_no, p.sku_code, eaches_per_case FROM stg_pos_transactions p LEFT JOIN ref_uom u USING (sku_code)"
Q["asof_scd2_join"] = """
SELECT p.txn_id, p.txn_line_no, p.outlet_code, p.at AS event_ts_ist, o.version_no, o.channel AS outlet_channel, o.warehouse_code
FROM (SELECT *, event_ts::TIMESTAMP + INTERVAL 330 MINUTE AS at FROM feed_pos) p
LEFT JOIN dim_outlet o ON o.outlet_code = p.outlet_code AND p.at >= o.valid_from AND p.at < o.valid_to
"""
Q["asof_hot_day"] = """
SELECT l.txn_id, l.txn_line_no, l.key, l.at, v.version, v.warehouse_code
FROM (SELECT txn_id, txn_line_no, if(txn_line_no < 4, 'HOT', outlet_code) AS key,
             if(txn_line_no < 4, TIMESTAMP '1996-06-15' + to_seconds((sku_code::BIGINT * 7919 + txn_id::BIGINT * 31) % 86400), event_ts_ist) AS at
      FROM stg_pos_transactions) l
ASOF LEFT JOIN (SELECT k, f, max(v) AS version, arg_max(w, v) AS warehouse_code
    FROM (SELECT if(version_no % 3 = 0, 'HOT', outlet_code) AS k,
                 if(version_no % 3 = 0, TIMESTAMP '1996-06-15' + to_seconds((outlet_code::BIGINT * 101 + version_no * 13) % 86400), valid_from) AS f,
                 outlet_code::BIGINT * 100000 + version_no AS v, warehouse_code AS w FROM dim_outlet) GROUP BY k, f) v
  ON l.key = v.k AND l.at >= v.f
"""
Q["week_bucket_join"] = """
SELECT week_start, count(*) AS lines, count(DISTINCT basket_id) AS baskets, sum(gross_sales_amount)::DOUBLE AS gross_sales
FROM fct_sales JOIN weeks ON event_date_ist BETWEEN week_start AND week_start + 6 GROUP BY week_start
"""
Q["full_outer_reconcile"] = """
SELECT feed, partition, row_count AS expected_rows, actual_rows FROM ref_manifest FULL JOIN part_counts USING (feed, partition)
"""
Q["calendar_spine"] = "SELECT device_id, calendar_date FROM (SELECT DISTINCT device_id FROM fct_cold_chain_readings) x, feed_calendar"
REL["dock_filled"] = """
SELECT s.warehouse_code, s.dock_door, s.calendar_date, ifnull(n, 0) AS readings,
       median(ifnull(n, 0)) OVER (PARTITION BY s.warehouse_code, s.dock_door) AS mid
FROM (SELECT warehouse_code, dock_door, calendar_date FROM (SELECT DISTINCT warehouse_code, dock_door FROM feed_wms_gapped) x, feed_calendar) s
LEFT JOIN (SELECT warehouse_code, dock_door, dt, count(*) AS n FROM feed_wms_gapped GROUP BY ALL) d
  ON d.warehouse_code = s.warehouse_code AND d.dock_door = s.dock_door AND d.dt = s.calendar_date
"""
Q["sparse_dock_health"] = """
SELECT warehouse_code, dock_door, min(calendar_date) AS first_day, max(calendar_date) AS last_day, count(*)::INT AS days,
       0::BIGINT AS readings, any_value(mid) AS median, 'OUTAGE' AS status
FROM (SELECT *, calendar_date - row_number() OVER (PARTITION BY warehouse_code, dock_door ORDER BY calendar_date)::INT AS island
      FROM dock_filled WHERE readings = 0) GROUP BY warehouse_code, dock_door, island
UNION ALL
SELECT warehouse_code, dock_door, calendar_date, calendar_date, 1, readings, mid, 'DEGRADED' FROM dock_filled WHERE readings > 0 AND readings < mid / 2
"""
Q["silent_tills"] = """
SELECT outlet_code, min(calendar_date) AS absent_from, max(calendar_date) AS absent_to, count(*)::INT AS days
FROM (SELECT outlet_code, calendar_date, calendar_date - row_number() OVER (PARTITION BY outlet_code ORDER BY calendar_date)::INT AS island
      FROM (SELECT outlet_code, calendar_date FROM (SELECT DISTINCT outlet_code FROM stg_pos_transactions) x, dim_calendar) s
      ANTI JOIN (SELECT DISTINCT outlet_code, event_date_ist FROM stg_pos_transactions) p
        ON p.outlet_code = s.outlet_code AND p.event_date_ist = s.calendar_date) GROUP BY outlet_code, island
"""
Q["series_outliers"] = """
SELECT gateway_id, calendar_date, readings, med AS median, mad, round(0.6745::DOUBLE * (readings - med) / nullif(mad, 0), 4) AS z_score
FROM (SELECT *, median(abs(readings - med)) OVER (PARTITION BY gateway_id) AS mad
      FROM (SELECT *, median(readings) OVER (PARTITION BY gateway_id) AS med FROM gateway_filled))
WHERE abs(round(0.6745::DOUBLE * (readings - med) / nullif(mad, 0), 4)) > 3.5 OR (mad = 0 AND readings <> med)
"""
Q["spine_zero_fill"] = """
SELECT s.device_id, s.calendar_date, count(r.dt) AS readings, count(r.dt) = 0 AS day_absent
FROM (SELECT device_id, calendar_date FROM (SELECT DISTINCT device_id FROM readings_watched) x, feed_calendar) s
LEFT JOIN readings_watched r ON r.device_id = s.device_id AND r.dt = s.calendar_date GROUP BY ALL
"""

# --- aggregations, sorts, set operations
Q["multi_distinct"] = """
SELECT channel_at_sale, count(DISTINCT basket_id) AS n_basket_id, count(DISTINCT outlet_code) AS n_outlet_code,
       count(DISTINCT sku_code) AS n_sku_code, count(DISTINCT event_date_ist) AS n_event_date_ist FROM fct_sales GROUP BY ALL
"""
Q["filtered_agg"] = """
SELECT telemetry_vendor, count(*) AS readings, count(*) FILTER (is_excursion) AS above, count(*) FILTER (is_below_band) AS below,
       count(*) FILTER (temp_reading_missing) AS missing FROM fct_cold_chain_readings GROUP BY ALL
"""
Q["median_agg"] = "SELECT channel_at_sale, median((gross_sales_amount * 100)::BIGINT) / 100 AS median_line_value FROM fct_sales GROUP BY ALL"
Q["percentiles_of_doubles"] = " UNION ALL ".join(
    f"""SELECT telemetry_vendor, '{c}' AS measure, round(quantile_cont({c}, 0.01), 6) AS p01, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.99), 6) AS p99 FROM fct_cold_chain_readings WHERE {c} IS NOT NULL GROUP BY ALL"""
    for c in ("temp_value_celsius", "gps_lat", "humidity_pct")
)
Q["percentiles_of_moments"] = """
SELECT channel_at_sale, min(epoch_us(event_ts_ist))::DOUBLE AS first_at, quantile_cont(epoch_us(event_ts_ist)::DOUBLE, 0.5) AS middle_at,
       max(epoch_us(event_ts_ist))::DOUBLE AS last_at FROM fct_sales WHERE event_ts_ist IS NOT NULL GROUP BY ALL
"""
Q["corr_agg"] = """
SELECT source_system, round(corr(order_value_gross::DOUBLE, order_value_gross_corrected::DOUBLE), 6) AS corr_raw_corrected,
       round(corr(order_value_gross_corrected::DOUBLE, discount_amount::DOUBLE), 6) AS corr_gross_discount FROM fct_orders GROUP BY ALL
"""
Q["stage_pivot"] = "SELECT * FROM stages"
Q["agg_of_agg"] = """
SELECT count(*) AS outlets, round(avg(b), 4) AS avg_baskets, max(s) AS max_skus
FROM (SELECT count(DISTINCT basket_id) AS b, count(DISTINCT sku_code) AS s FROM fct_sales GROUP BY outlet_code)
"""
Q["having_distinct"] = "SELECT outlet_code, count(DISTINCT channel) AS n_channels FROM dim_outlet GROUP BY ALL HAVING n_channels > 3"
_SUMMARY = """
       count(*) AS transaction_lines, count(DISTINCT basket_id) AS baskets, sum(gross_sales_amount)::DOUBLE AS gross_sales,
       sum(discount_amount)::DOUBLE AS discount, sum(net_sales_amount)::DOUBLE AS net_sales, sum(tax_amount)::DOUBLE AS tax,
       sum(sales_amount_incl_tax)::DOUBLE AS sales_incl_tax,
       round(sum(gross_sales_amount)::DOUBLE / count(DISTINCT basket_id), 2) AS avg_basket_value,
       round(100.0 * count(*) FILTER (is_late_arrival) / count(*), 2) AS pct_late_arriving
FROM rpt_sales_flat WHERE "grouping" IS NOT NULL GROUP BY "grouping"
"""
_KEYS = {
    "month": "strftime(event_date_ist, '%Y-%m')", "fiscal_quarter": "fiscal_year || '-' || fiscal_quarter",
    "channel": "channel_at_sale", "category": "product_category", "region": "warehouse_region",
}


def _summary(name: str) -> str:
    body = _SUMMARY.replace('WHERE "grouping" IS NOT NULL GROUP BY "grouping"', f"WHERE {_KEYS[name]} IS NOT NULL GROUP BY {_KEYS[name]}")
    return f'{_KEYS[name]} AS "grouping", {body}'


Q["sales_summary_by"] = " UNION ALL ".join(f"SELECT '{n}' AS group_by, {_summary(n)}" for n in _KEYS)
Q["top_n"] = f"""
SELECT outlet_code, count(*) AS orders, sum(order_value_gross_corrected)::DOUBLE AS order_value FROM fct_orders
GROUP BY outlet_code ORDER BY sum(order_value_gross_corrected) DESC, outlet_code LIMIT {TOP_N}
"""
Q["union_all_feeds"] = "SELECT feed, d, n FROM all_feed_days"

# --- models
for _name in (*MODELS, "rpt_sales_flat"):
    Q[_name] = f"SELECT * FROM {_name}"
for _name in ("dim_outlet", "dim_product"):
    Q[_name] = f"SELECT * REPLACE (valid_to::VARCHAR AS valid_to) FROM {_name}"
Q["dq_partition_reconciliation"] = "SELECT * EXCLUDE (unlisted) FROM dq_partition_reconciliation"
Q["dim_static"] = """
SELECT 'warehouse' AS dimension, warehouse_code AS code, warehouse_name AS name FROM dim_warehouse
UNION ALL SELECT 'carrier', carrier_id, carrier_name FROM dim_carrier
"""

# --- KPI library
_BY_CHANNEL = """
SELECT channel_at_sale AS channel, count(*) AS transaction_lines, count(DISTINCT basket_id) AS baskets,
       sum(gross_sales_amount)::DOUBLE AS gross_sales_inr, round(sum(gross_sales_amount)::DOUBLE / 1e7, 2) AS gross_sales_cr,
       sum(net_sales_amount)::DOUBLE AS net_sales_inr, sum(sales_amount_incl_tax)::DOUBLE AS sales_incl_tax_inr,
       round(100.0 * sum(gross_sales_amount)::DOUBLE / sum(sum(gross_sales_amount)) OVER ()::DOUBLE, 2) AS pct_of_total
"""
_BY_CHANNEL = _BY_CHANNEL.replace("sum(sum(gross_sales_amount)) OVER ()::DOUBLE", "(sum(sum(gross_sales_amount)) OVER ())::DOUBLE")
Q["kpi_gross_by_channel"] = _BY_CHANNEL + f"""
FROM rpt_sales_flat WHERE fiscal_year = '{FISCAL_YEAR}' AND fiscal_quarter = '{FISCAL_QUARTER}' GROUP BY channel_at_sale
"""
Q["kpi_gross_by_channel_1990s"] = _BY_CHANNEL + """
FROM rpt_sales_flat WHERE fiscal_year = 'FY97' AND fiscal_quarter = 'Q1' GROUP BY channel_at_sale
"""
Q["kpi_gross_by_fiscal_quarter"] = _BY_CHANNEL.replace("SELECT ", "SELECT fiscal_year, fiscal_quarter, ", 1).replace("OVER ()", "OVER (PARTITION BY fiscal_year, fiscal_quarter)") + """
FROM rpt_sales_flat WHERE fiscal_year IS NOT NULL GROUP BY fiscal_year, fiscal_quarter, channel_at_sale
"""
Q["kpi_gross_by_channel_latest"] = _BY_CHANNEL + """
FROM fct_sales, (SELECT date_trunc('quarter', max(event_date_ist) + 1) AS following FROM fct_sales)
WHERE event_date_ist < following AND event_date_ist >= following - INTERVAL 3 MONTH GROUP BY channel_at_sale
"""
Q["kpi_sales_summary"] = f"SELECT {_summary('month')}"
Q["kpi_units_sold"] = """
SELECT channel_at_sale AS channel, sum(qty_original)::BIGINT AS units_as_transacted,
       (sum(qty_original) FILTER (uom_original = 'EA'))::BIGINT AS units_known_eaches,
       (sum(qty_original) FILTER (uom_original = 'CS'))::BIGINT AS units_known_cases,
       (sum(qty_original) FILTER (uom_unknown_flag))::BIGINT AS units_unknown_uom,
       round(100.0 * sum(qty_original) FILTER (uom_unknown_flag) / sum(qty_original), 2) AS pct_unknown_uom
FROM fct_sales GROUP BY channel_at_sale
"""
Q["kpi_units_eaches"] = """
SELECT channel_at_sale AS channel, sum(qty_eaches)::BIGINT AS units_eaches, count(*) AS lines_total, count(qty_eaches) AS lines_converted,
       round(100.0 * count(qty_eaches) / count(*), 2) AS pct_coverage, count(*) FILTER (uom_unknown_flag) AS excluded_no_uom_in_feed,
       count(*) FILTER (uom_conversion_missing) AS excluded_sku_not_in_ref
FROM fct_sales GROUP BY channel_at_sale
"""
Q["kpi_top_products"] = f"""
SELECT sku_code, min(product_name) AS product_name, min(product_category) AS category, min(product_is_chilled) AS is_chilled,
       count(*) AS lines, sum(gross_sales_amount)::DOUBLE AS gross_sales, sum(qty_eaches)::BIGINT AS units_eaches,
       round(100.0 * sum(gross_sales_amount)::DOUBLE / (SELECT sum(gross_sales_amount)::DOUBLE FROM fct_sales), 2) AS pct_of_window
FROM rpt_sales_flat GROUP BY sku_code ORDER BY sum(gross_sales_amount) DESC, sku_code LIMIT {TOP_N}
"""
Q["kpi_top_outlets"] = f"""
SELECT outlet_code, min(outlet_name) AS outlet_name, min(channel_at_sale) AS channel, min(warehouse_region) AS region,
       count(DISTINCT basket_id) AS baskets, sum(gross_sales_amount)::DOUBLE AS gross_sales,
       round(sum(gross_sales_amount)::DOUBLE / count(DISTINCT basket_id), 2) AS avg_basket_value
FROM rpt_sales_flat GROUP BY outlet_code ORDER BY sum(gross_sales_amount) DESC, outlet_code LIMIT {TOP_N}
"""
Q["kpi_top_categories"] = """
SELECT product_category AS category, count(DISTINCT sku_code) AS skus_sold, sum(gross_sales_amount)::DOUBLE AS gross_sales,
       round(100.0 * sum(gross_sales_amount)::DOUBLE / (SELECT sum(gross_sales_amount)::DOUBLE FROM fct_sales), 2) AS pct_of_window
FROM rpt_sales_flat GROUP BY product_category
"""
Q["kpi_recon_bases"] = """
SELECT 'A. our correct basis (event date, deduped)' AS basis, round(sum(our_gross_correct::DECIMAL(18,2))::DOUBLE / 1e7, 2) AS gross_cr FROM rpt_finance_reconciliation
UNION ALL SELECT 'B. legacy method reproduced (ingest date, no dedup)', round(sum(legacy_emulated_gross::DECIMAL(18,2))::DOUBLE / 1e7, 2) FROM rpt_finance_reconciliation
UNION ALL SELECT 'C. as published to the board', round(sum(legacy_published_gross::DECIMAL(18,2))::DOUBLE / 1e7, 2) FROM rpt_finance_reconciliation
"""
Q["kpi_recon_bug_impact"] = """
SELECT round(i::DOUBLE / 1e7, 2) AS bug_impact_cr, round(100.0 * b::DOUBLE / a::DOUBLE - 100.0, 2) AS bug_inflation_pct,
       d AS duplicate_lines, (c - b)::DOUBLE AS residual_unexplained_inr
FROM (SELECT sum(bug_impact_gross::DECIMAL(18,2)) AS i, sum(legacy_emulated_gross::DECIMAL(18,2)) AS b,
             sum(our_gross_correct::DECIMAL(18,2)) AS a, sum(duplicate_lines_counted)::BIGINT AS d,
             sum(legacy_published_gross::DECIMAL(18,2)) AS c FROM rpt_finance_reconciliation)
"""
Q["kpi_recon_corr"] = """
SELECT count(*) AS cells, round(corr(legacy_published_gross, our_gross_correct), 4) AS corr_published_vs_actual,
       round(corr(legacy_published_gross, legacy_emulated_gross), 4) AS corr_published_vs_emulated,
       count(*) FILTER (reconciliation_status = 'RECONCILED_WITHIN_5PCT') AS cells_within_5pct,
       round(min(variance_pct), 1) AS worst_understatement_pct, round(max(variance_pct), 1) AS worst_overstatement_pct
FROM rpt_finance_reconciliation
"""
Q["kpi_order_value"] = """
SELECT source_system, count(*) AS orders, round(sum(order_value_gross)::DOUBLE / 1e7, 2) AS gross_raw_cr,
       round(sum(order_value_gross_corrected)::DOUBLE / 1e7, 2) AS gross_corrected_cr,
       round(100.0 * sum(order_value_gross)::DOUBLE / sum(order_value_gross_corrected)::DOUBLE - 100.0, 2) AS inflation_removed_pct,
       round(sum(order_value_gross_corrected)::DOUBLE / count(*), 0) AS avg_order_value,
       round(median((order_value_gross_corrected * 100)::BIGINT) / 100, 0) AS median_order_value,
       round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct_of_orders
FROM fct_orders WHERE NOT is_deleted GROUP BY source_system
"""
_VALID = "count(*) FILTER (NOT temp_reading_missing)"
Q["kpi_excursion_month"] = f"""
SELECT date_trunc('month', reading_ts)::TIMESTAMP AS month, count(*) AS readings_total, {_VALID} AS readings_valid,
       round(100.0 * count(*) FILTER (is_excursion) / nullif({_VALID}, 0), 2) AS excursion_pct_above_band,
       round(100.0 * count(*) FILTER (is_below_band) / nullif({_VALID}, 0), 2) AS below_band_pct,
       round(100.0 * count(*) FILTER (temp_value_celsius NOT BETWEEN 2 AND 8) / nullif({_VALID}, 0), 2) AS outside_band_pct,
       round(100.0 * count(*) FILTER (temp_reading_missing) / count(*), 2) AS missing_reading_pct
FROM fct_cold_chain_readings GROUP BY 1
"""
Q["kpi_null_rate"] = """
SELECT telemetry_vendor, firmware_version, count(*) AS readings, count(*) FILTER (temp_reading_missing) AS null_readings,
       round(100.0 * count(*) FILTER (temp_reading_missing) / count(*), 3) AS null_pct FROM fct_cold_chain_readings GROUP BY ALL
"""
Q["kpi_gateway_holes"] = """
SELECT f.gateway_id, calendar_date AS dt, readings, round(mid, 0) AS median_daily,
       round(100.0 * readings / nullif(mid, 0), 1) AS pct_of_median, if(day_absent, 'DAY_ABSENT', 'VOLUME_COLLAPSE') AS finding
FROM gateway_filled f JOIN (SELECT gateway_id, median(readings) AS mid FROM gateway_days GROUP BY gateway_id) b ON b.gateway_id = f.gateway_id
WHERE readings < 0.4 * mid
"""
Q["dq_short_partitions"] = """
SELECT feed, partition, expected_rows, actual_rows, row_delta, pct_of_expected, status FROM dq_partition_reconciliation
WHERE status <> 'MATCH' AND status <> 'NO_MANIFEST_BASELINE'
"""
Q["dq_no_baseline"] = "SELECT feed, sum(n)::BIGINT AS rows_loaded, 'NO_MANIFEST_BASELINE' AS status FROM feed_days WHERE feed LIKE 'erp%' GROUP BY feed"
Q["dq_alert_days"] = """
SELECT feed, calendar_date, rows_present, feed_median, pct_of_feed_median, status, severity FROM dq_feed_completeness
WHERE severity <> 'OK' AND severity <> 'INFO'
"""
Q["dq_inner_holes"] = """
SELECT gateway_id, calendar_date, readings, gateway_median, pct_of_gateway_median, status FROM dq_gateway_health WHERE status <> 'OK'
"""
Q["dq_verdict"] = """
SELECT *, if(short_partitions + feed_day_alerts + gateway_outage_days = 0, 'CLEAN', 'DEFECTS PRESENT - read sections 1-4 before publishing') AS verdict
FROM (SELECT count(*) FILTER (status NOT IN ('MATCH', 'NO_MANIFEST_BASELINE')) AS short_partitions,
             (sum(row_delta) FILTER (status = 'SHORTFALL'))::BIGINT AS rows_missing,
             count(*) FILTER (status = 'NO_MANIFEST_BASELINE') AS unreconcilable_feeds FROM dq_partition_reconciliation),
     (SELECT count(*) AS feed_day_alerts FROM dq_feed_completeness WHERE severity = 'ALERT'),
     (SELECT count(*) AS gateway_outage_days FROM dq_gateway_health WHERE status = 'OUTAGE')
"""
Q["scalar_verdict"] = Q["dq_verdict"]
Q["x01_carriers"] = "SELECT * FROM dim_carrier"
Q["x01_spread"] = """
SELECT count(*) AS vehicles, round(avg(r), 1) AS avg_routes_per_vehicle, round(avg(w), 1) AS avg_warehouses_per_vehicle,
       max(r) AS max_routes_per_vehicle, (SELECT count(DISTINCT route_code) FROM fct_cold_chain_readings) AS routes_in_existence
FROM (SELECT count(DISTINCT route_code) AS r, count(DISTINCT warehouse_code) AS w FROM fct_cold_chain_readings GROUP BY vehicle_registration)
"""
Q["x01_one_to_one"] = """
SELECT device_id, count(DISTINCT vehicle_registration) AS n_vehicles FROM fct_cold_chain_readings GROUP BY ALL HAVING n_vehicles > 1
"""
Q["x02_negative"] = """
SELECT count(cycle_time_seconds) AS orders_with_both_scans, count(*) FILTER (cycle_time_seconds < 0) AS negative_duration,
       round(100.0 * count(*) FILTER (cycle_time_seconds < 0) / count(cycle_time_seconds), 2) AS pct_negative FROM fct_warehouse_cycle_time
"""
Q["x02_plausible"] = """
SELECT count(*) AS plausible_orders, round(median(cycle_time_seconds) / 86400, 1) AS median_days,
       round(min(cycle_time_seconds) / 86400, 1) AS min_days, round(max(cycle_time_seconds) / 86400, 1) AS max_days
FROM fct_warehouse_cycle_time WHERE is_cycle_time_plausible
"""
Q["x02_items"] = """
SELECT round(avg(k), 2) AS avg_distinct_skus, round(avg(b), 2) AS avg_distinct_batches, count(*) AS orders_with_all_6_stages
FROM (SELECT count(DISTINCT sku_code) AS k, count(DISTINCT batch_id) AS b FROM stg_wms_scan_events GROUP BY order_number
      HAVING count(DISTINCT event_type) = 6)
"""
Q["x03_changes"] = """
SELECT count(*) FILTER (n > 1) AS outlets_appearing_to_change_channel, count(*) AS outlets_total
FROM (SELECT count(DISTINCT channel) AS n FROM dim_outlet GROUP BY outlet_code)
"""
_NOISE = ("channel", "outlet_format", "city", "route_code", "credit_limit", "warehouse_code", "outlet_name")
Q["x03_noise_profile"] = (
    "SELECT " + ", ".join(f"round(avg({c}), 2) AS avg_distinct_{c}" for c in _NOISE)
    + " FROM (SELECT " + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in _NOISE)
    + " FROM dim_outlet GROUP BY outlet_code HAVING count(*) > 2)"
)
Q["x03_one_key"] = """
SELECT outlet_code, version_no, channel, outlet_format, city, route_code, warehouse_code, valid_from FROM dim_outlet
WHERE outlet_code = (SELECT outlet_code FROM dim_outlet GROUP BY outlet_code ORDER BY count(*) DESC, outlet_code LIMIT 1)
"""
Q["x03_version1"] = "SELECT channel AS reliable_channel, count(*) AS outlets FROM dim_outlet WHERE version_no = 1 GROUP BY channel"

# --- checks
_PAIRS = {
    "pos_transactions": ("feed_pos", "stg_pos_transactions"), "reefer_telemetry": ("feed_telemetry", "stg_reefer_telemetry"),
    "wms_scan_events": ("feed_wms", "stg_wms_scan_events"), "erp_cdc/outlet_master": ("feed_outlet", "stg_outlet_history"),
    "erp_cdc/product_master": ("feed_product", "stg_product_history"),
    "erp_cdc/sales_order_header": ("feed_order", "stg_sales_order_header"),
}
Q["check_dedup_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS feed, r AS raw_rows, s AS staged_rows, r - s AS removed_rows "
    f"FROM (SELECT count(*) AS r FROM {a}) ra CROSS JOIN (SELECT count(*) AS s FROM {b}) sb"
    for n, (a, b) in _PAIRS.items()
)
Q["check_late_rate"] = """
SELECT count(*) AS lines, count(*) FILTER (is_late_arrival) AS late_lines,
       round(100.0 * count(*) FILTER (is_late_arrival) / count(*), 2) AS pct_late, count(*) - count(uom_original) AS unit_unknown,
       round(100.0 * count(*) FILTER (uom_original = 'EA') / count(uom_original), 2) AS pct_eaches_of_known,
       round(100.0 * count(*) FILTER (uom_original = 'CS') / count(uom_original), 2) AS pct_cases_of_known FROM stg_pos_transactions
"""
Q["check_telemetry_rates"] = """
SELECT count(*) AS readings, round(100.0 * count(*) FILTER (firmware_version = '2.1.4') / count(*), 2) AS pct_skewed_clock,
       round(100.0 * count(*) FILTER (temp_reading_missing) / count(*), 2) AS pct_missing,
       round(100.0 * count(*) FILTER (temp_unit_resolved = 'F') / count(*), 2) AS pct_fahrenheit,
       count(*) - count(temp_unit_resolved) AS unit_unresolved FROM stg_reefer_telemetry
"""
Q["check_not_null"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM stg_wms_scan_events" for c in ("order_number", "sku_code", "warehouse_code")
)
Q["check_version_ties"] = "SELECT outlet_code, op_ts, count(*) AS versions FROM stg_outlet_history GROUP BY ALL HAVING versions > 1"
Q["check_extract_lag"] = """
SELECT op_type, count(*) AS changes, count(*) FILTER (lag <> 0) AS lagging, round(100.0 * count(*) FILTER (lag <> 0) / count(*), 2) AS pct_lagging,
       max(lag)::INT AS max_lag_days
FROM (SELECT op_type, extract_date - op_ts::DATE AS lag FROM stg_sales_order_header) GROUP BY op_type
"""


def _resurrected(label: str, history: str, dim: str, key: str) -> str:
    return f"""
SELECT '{label}' AS dimension, count(*) AS deleted_keys, count(*) FILTER (later) AS with_later_change,
       (SELECT count(*) FROM {dim} WHERE is_deleted AND is_current) AS current_versions_of_deleted
FROM (SELECT d.{key}, bool_or(h.op_type <> 'D' AND (h.op_ts > d.op_ts OR (h.op_ts = d.op_ts AND h.seq > d.seq))) AS later
      FROM (SELECT * FROM {history} WHERE op_type = 'D'
            QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY op_ts, seq) = 1) d
      JOIN {history} h ON h.{key} = d.{key} GROUP BY d.{key})
"""


Q["check_delete_resurrection"] = (
    _resurrected("outlet", "stg_outlet_history", "dim_outlet", "outlet_code")
    + " UNION ALL " + _resurrected("product", "stg_product_history", "dim_product", "sku_code")
)
Q["check_scd2_integrity"] = """
SELECT count(*) AS fact_rows, count(*) - count(v) AS facts_without_version,
       (SELECT count(*) FROM dim_product a JOIN dim_product b ON a.sku_code = b.sku_code AND a.version_no < b.version_no
          AND a.valid_to > b.valid_from) AS overlapping_windows,
       (SELECT count(*) FROM (SELECT count(*) FILTER (is_current) <> if(bool_or(is_deleted), 0, 1) AS wrong
                              FROM dim_product GROUP BY sku_code) k WHERE wrong) AS keys_with_wrong_current
FROM (SELECT p.version_no AS v FROM fct_sales f LEFT JOIN dim_product p
      ON p.sku_code = f.sku_code AND f.event_ts_ist >= p.valid_from AND f.event_ts_ist < p.valid_to)
"""
REL["faulty_products"] = """
SELECT sku_code, version_no, valid_from, till AS valid_to FROM (
  SELECT *, CASE WHEN valid_to >= TIMESTAMP '9999-01-01' THEN valid_to WHEN version_no % 7 = 0 THEN valid_to + INTERVAL 10 DAY
                 WHEN version_no % 11 = 0 THEN valid_to - INTERVAL 10 DAY ELSE valid_to END AS till FROM dim_product) WHERE valid_from < till
"""
Q["check_stored_windows"] = """
SELECT count(*) AS fact_rows, sum(greatest(n, 1))::BIGINT AS rows_of_left_range_join, count(*) FILTER (n = 0) AS facts_without_version,
       count(*) FILTER (n > 1) AS facts_with_several,
       (SELECT count(*) FROM (SELECT valid_from < max(valid_to) OVER w AS o FROM faulty_products WINDOW w AS (
          PARTITION BY sku_code ORDER BY valid_from, valid_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE o) AS overlapping_windows,
       (SELECT count(*) FROM (SELECT valid_from > max(valid_to) OVER w AS g FROM faulty_products WINDOW w AS (
          PARTITION BY sku_code ORDER BY valid_from, valid_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE g) AS windows_after_gap
FROM (SELECT f.txn_id, f.txn_line_no, count(p.version_no) AS n FROM fct_sales f LEFT JOIN faulty_products p
      ON p.sku_code = f.sku_code AND f.event_ts_ist >= p.valid_from AND f.event_ts_ist < p.valid_to GROUP BY ALL)
"""
Q["check_channel_match"] = """
SELECT count(*) AS lines, count(*) FILTER (channel_at_sale = channel) AS matching,
       round(100.0 * count(*) FILTER (channel_at_sale = channel) / count(*), 2) AS pct_matching
FROM fct_sales f JOIN dim_outlet o ON o.outlet_code = f.outlet_code AND o.version_no = 1
"""
Q["vehicle_day_breach"] = """
SELECT count(*) AS vehicle_days, count(*) FILTER (bad > 0) AS breached_days, round(100.0 * count(*) FILTER (bad > 0) / count(*), 2) AS pct_vehicle_days,
       round(100.0 * sum(bad) / sum(valid), 2) AS pct_readings
FROM (SELECT count(*) FILTER (is_excursion) AS bad, count(is_excursion) AS valid FROM fct_cold_chain_readings
      GROUP BY vehicle_registration, dt HAVING valid > 0)
"""


def _stitched(key: str) -> str:
    return f"""
SELECT '{key}' AS stitch_key, count(*) AS keys_with_both, count(*) FILTER (date_diff('second', a, b) < 0) AS reversed,
       round(100.0 * count(*) FILTER (date_diff('second', a, b) < 0) / count(*), 2) AS pct_reversed
FROM (SELECT min(event_ts) FILTER (event_type = 'RECEIVE') AS a, min(event_ts) FILTER (event_type = 'DISPATCH') AS b
      FROM stg_wms_scan_events GROUP BY {key}) WHERE a IS NOT NULL AND b IS NOT NULL
"""


Q["stitch_by_key"] = " UNION ALL ".join(_stitched(k) for k in ("order_number", "batch_id", "pallet_id", "warehouse_code"))
Q["order_noise_profile"] = """
SELECT count(*) AS orders, round(corr(g, discount_amount::DOUBLE), 4) AS corr_gross_discount, round(corr(g, tax_amount::DOUBLE), 4) AS corr_gross_tax,
       count(*) FILTER (order_value_net < 0) AS negative_net_orders, min(order_value_net)::DOUBLE AS lowest_net,
       min(rate) / 10000.0 AS min_tax_rate_pct, median(rate) / 10000.0 AS median_tax_rate_pct, max(rate) / 10000.0 AS max_tax_rate_pct
FROM (SELECT *, order_value_gross_corrected::DOUBLE AS g,
             round(round(100.0 * (tax_amount::DOUBLE / order_value_gross_corrected::DOUBLE), 4) * 10000.0, 0)::BIGINT AS rate FROM fct_orders)
"""
Q["negative_net_by_source"] = """
SELECT source_system, count(*) AS orders, count(*) FILTER (order_value_net < 0) AS negative_net,
       round(100.0 * count(*) FILTER (order_value_net < 0) / count(*), 3) AS pct_negative_net FROM fct_orders GROUP BY ALL
"""
Q["canonical_agreement"] = """
SELECT count(*) AS orders, count(*) FILTER (ever) AS ever_deleted, count(*) FILTER (last_op = 'D') AS latest_is_delete,
       count(*) FILTER (last_seq = best_seq) AS canonical_is_latest
FROM (SELECT order_number, bool_or(op_type = 'D') AS ever, arg_max(op_type, (op_ts, seq)) AS last_op, arg_max(seq, (op_ts, seq)) AS last_seq
      FROM stg_sales_order_header GROUP BY order_number)
JOIN (SELECT order_number, seq AS best_seq FROM order_best) USING (order_number)
"""
Q["check_net_nonneg"] = "SELECT count(*) AS lines, count(*) FILTER (net_sales_amount < 0) AS negative_net_lines FROM fct_sales"
Q["series_day_percentiles"] = """
SELECT count(*) AS series_days, round(quantile_cont(p, 0) / 10, 3) AS min_pct, round(quantile_cont(p, 0.001) / 10, 3) AS p0_1_pct,
       round(quantile_cont(p, 0.01) / 10, 3) AS p1_pct
FROM (SELECT round(pct_of_gateway_median * 10, 0)::BIGINT AS p FROM dq_gateway_health WHERE gateway_median > 0 AND readings > 0)
"""
Q["diff_builds"] = """
SELECT count(*) AS differing_rows FROM (
  (SELECT * FROM stg_pos_transactions EXCEPT ALL SELECT * FROM stg_pos_transactions)
  UNION ALL (SELECT * FROM stg_pos_transactions EXCEPT ALL SELECT * FROM stg_pos_transactions))
"""
Q["diff_stored_builds"] = """
SELECT month, txn_id, txn_line_no, discount::DOUBLE AS discount_amount, sum(side)::BIGINT AS surplus
FROM (WITH a AS (SELECT *, strftime(event_date_ist, '%Y-%m') AS month FROM stg_pos_transactions)
      SELECT month, txn_id, txn_line_no, discount_amount AS discount, 1 AS side FROM a
      UNION ALL SELECT month, txn_id, txn_line_no, discount_amount + if(month = '1997-07' AND txn_line_no = 2, 1, 0), -1 FROM a
      WHERE NOT (month = '1996-03' AND txn_line_no = 1)
      UNION ALL SELECT month, txn_id, txn_line_no, discount_amount, -1 FROM a WHERE month = '1995-02' AND txn_line_no = 3)
GROUP BY ALL HAVING sum(side) <> 0
"""
Q["channel_ratio"] = """
SELECT channel, sum(legacy_published_gross::DECIMAL(18,2))::DOUBLE AS published_gross, sum(our_gross_correct::DECIMAL(18,2))::DOUBLE AS actual_gross,
       round(sum(legacy_published_gross::DECIMAL(18,2))::DOUBLE / sum(our_gross_correct::DECIMAL(18,2))::DOUBLE, 4) AS published_to_actual
FROM rpt_finance_reconciliation GROUP BY channel
"""
Q["period_coverage"] = """
SELECT fiscal_year, fiscal_quarter, count(*) AS days_expected, count(*) FILTER (n > 0) AS days_present,
       round(sum(n)::DOUBLE / count(*), 2) AS mean_lines, round(sum(n) FILTER (tail)::DOUBLE / count(*) FILTER (tail), 2) AS tail_mean_lines,
       round(100.0 * (sum(n) FILTER (tail)::DOUBLE / count(*) FILTER (tail)) / (sum(n)::DOUBLE / count(*)), 1) AS tail_pct_of_mean
FROM (SELECT *, calendar_date > max(calendar_date) OVER (PARTITION BY fiscal_year, fiscal_quarter) - 7 AS tail
      FROM (SELECT fiscal_year, fiscal_quarter, calendar_date, count(txn_id) AS n
            FROM dim_calendar LEFT JOIN fct_sales ON event_date_ist = calendar_date GROUP BY ALL))
GROUP BY ALL
"""
Q["period_coverage"] = Q["period_coverage"].replace("sum(n) FILTER (tail)::DOUBLE", "(sum(n) FILTER (tail))::DOUBLE")

# --- parameters and routing
Q["as_of_date"] = "SELECT max(event_date_ist) AS as_of_date FROM fct_sales"
REL["asked"] = "SELECT conv_id, turn, regexp_replace(lower(question), '[^a-z0-9 ]+', ' ', 'g') AS normalised FROM questions"
Q["route_normalise"] = "SELECT conv_id, turn, normalised FROM asked"


def _values(rows) -> str:
    def text(v):
        return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return "(VALUES " + ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows) + ")"


# Optional terms stand in group -1.
_TERMS = [
    (pos, intent.name, number, term)
    for pos, intent in enumerate(INTENTS)
    for number, group in [*enumerate(intent.all_of), (-1, intent.any_of)]
    for term in group
]
REL["intent_terms"] = f"SELECT * FROM {_values(_TERMS)} t(pos, intent, grp, term)"
REL["intent_facts"] = "SELECT * FROM " + _values(
    (pos, i.name, len(i.all_of), len(i.any_of), i.refused is not None, i.refused, ", ".join(i.kpi) or None, i.reason)
    for pos, i in enumerate(INTENTS)
) + " t(pos, intent, groups, optional, refused, catalogue, kpi, reason)"
REL["matches"] = """
SELECT conv_id, turn, f.intent, f.pos, f.refused, h.groups_hit + h.terms_hit AS score
FROM (SELECT conv_id, turn, pos, count(DISTINCT grp) FILTER (grp >= 0) AS groups_hit, count(*) FILTER (grp < 0) AS terms_hit
      FROM asked JOIN intent_terms ON contains(normalised, term) GROUP BY ALL) h
JOIN intent_facts f ON f.pos = h.pos
WHERE groups_hit = groups AND (optional = 0 OR terms_hit > 0)
"""
Q["route_score"] = "SELECT conv_id, turn, intent, score::INT AS score, refused FROM matches"
_GROUP_TERMS = [
    (order, name, term)
    for order, (name, terms) in enumerate(next(i for i in INTENTS if i.group_by).group_by.items())
    for term in terms
]
REL["group_terms"] = f"SELECT * FROM {_values(_GROUP_TERMS)} t(place, name, term)"
Q["route_pick"] = """
SELECT a.conv_id, a.turn, ifnull(m.intent, 'unknown') AS intent, ifnull(m.score, 0)::INT AS score, ifnull(m.refused, false) AS refused,
       f.catalogue, f.kpi, f.reason,
       if(m.intent = 'sales_summary', g.name, NULL) AS group_by
FROM asked a
LEFT JOIN (SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY refused DESC, score DESC, pos) = 1) m
  ON m.conv_id = a.conv_id AND m.turn = a.turn
LEFT JOIN intent_facts f ON f.pos = m.pos
LEFT JOIN (SELECT conv_id, turn, arg_min(name, place) AS name FROM asked JOIN group_terms ON contains(normalised, term) GROUP BY ALL) g
  ON g.conv_id = a.conv_id AND g.turn = a.turn
"""
_MONTH = r"\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\w*\s+(\d{4})\b"
_FY = r"\bfy\s*(\d{2})\D{0,3}q([1-4])\b"
REL["latest"] = "SELECT max(event_date_ist) AS day FROM stg_pos_transactions"
# Quarters start on the first of April, July, October and January: those of the calendar, renumbered.
REL["periods"] = f"""
SELECT conv_id, turn, normalised AS q, day, date_trunc('quarter', day)::DATE AS own_start,
       nullif(regexp_extract(normalised, '{_FY}', 1), '')::INT AS fy, nullif(regexp_extract(normalised, '{_FY}', 2), '')::INT AS fq,
       nullif(regexp_extract(normalised, '{_MONTH}', 1), '') AS mon, nullif(regexp_extract(normalised, '{_MONTH}', 2), '')::INT AS yr
FROM asked CROSS JOIN latest
"""
REL["quarters"] = """
SELECT *, CASE WHEN fy IS NOT NULL THEN (make_date(1999 + fy, 4, 1) + INTERVAL 3 MONTH * (fq - 1))::DATE
               WHEN (contains(q, 'previous quarter') OR (contains(q, 'last quarter') AND NOT contains(q, 'complete')))
                    AND day < own_start + INTERVAL 3 MONTH - INTERVAL 1 DAY THEN (own_start - INTERVAL 3 MONTH)::DATE
               ELSE own_start END AS qf
FROM periods
"""
REL["ranges"] = """
SELECT *, (qf + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS qt,
       'FY' || strftime(qf + INTERVAL 9 MONTH, '%y') AS fyl, 'Q' || (quarter(qf - INTERVAL 3 MONTH))::VARCHAR AS fql,
       CASE WHEN mon IS NOT NULL THEN make_date(yr, list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], mon)::INT, 1)
            WHEN contains(q, 'last month') OR contains(q, 'previous month')
              THEN if(day = last_day(day), date_trunc('month', day), date_trunc('month', day) - INTERVAL 1 MONTH)::DATE END AS mf,
       contains(q, 'last 7 days') OR contains(q, 'last week') AS w7, contains(q, 'last 30 days') AS w30, contains(q, 'last 90 days') AS w90,
       contains(q, 'this month') AS tm, contains(q, 'last year') AS ly,
       contains(q, 'all time') OR contains(q, 'whole period') OR contains(q, 'everything') AS aw
FROM quarters
"""
Q["route_period"] = """
SELECT conv_id, turn, fyl AS fiscal_year, fql AS fiscal_quarter, qf AS quarter_from, qt AS quarter_to,
       CASE WHEN mon IS NOT NULL THEN mf WHEN w7 THEN day - 6 WHEN w30 THEN day - 29 WHEN w90 THEN day - 89 WHEN mf IS NOT NULL THEN mf
            WHEN tm THEN date_trunc('month', day)::DATE WHEN ly THEN make_date(year(day) - 1, 1, 1) WHEN aw THEN DATE '2000-01-01' ELSE qf END AS date_from,
       CASE WHEN mon IS NOT NULL THEN last_day(mf) WHEN w7 OR w30 OR w90 THEN day WHEN mf IS NOT NULL THEN last_day(mf)
            WHEN tm THEN day WHEN ly THEN make_date(year(day) - 1, 12, 31) WHEN aw THEN day ELSE qt END AS date_to,
       CASE WHEN mon IS NOT NULL THEN monthname(mf) || ' ' || year(mf)::VARCHAR WHEN w7 THEN 'last 7 days' WHEN w30 THEN 'last 30 days'
            WHEN w90 THEN 'last 90 days' WHEN mf IS NOT NULL THEN monthname(mf) || ' ' || year(mf)::VARCHAR
            WHEN tm THEN monthname(day) || ' ' || year(day)::VARCHAR WHEN ly THEN 'calendar ' || (year(day) - 1)::VARCHAR
            WHEN aw THEN 'the whole period' ELSE fyl || '-' || fql END AS label
FROM ranges
"""
Q["fiscal_quarter_bounds"] = """
SELECT 'FY' || strftime(s + INTERVAL 9 MONTH, '%y') AS fiscal_year, 'Q' || quarter(s - INTERVAL 3 MONTH)::VARCHAR AS fiscal_quarter,
       s::DATE AS quarter_from, (s + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS quarter_to, count(*) AS days_counted
FROM (SELECT date_trunc('quarter', o_orderdate) AS s FROM orders) GROUP BY s
"""


def all_sql() -> dict[str, str]:
    return {name: with_relations(sql) for name, sql in Q.items()}
