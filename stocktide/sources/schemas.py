"""Declared schemas of the feeds and reference files (fixed values: names and types as delivered)."""

FEEDS = {
    "pos_transactions": (
        "txn_id string, txn_line_no smallint, basket_id string, outlet_code string, channel string, "
        "sku_code string, event_ts string, qty int, quantity_units int, uom string, unit_price double, "
        "discount_amount double, tax_amount double, payment_mode string, till_id smallint, cashier_id string, "
        "promo_code string, loyalty_id string, source_file string, ingest_date date"
    ),
    "reefer_telemetry": (
        "device_id string, telemetry_vendor string, firmware_version string, vehicle_registration string, "
        "route_code string, warehouse_code string, gateway_id string, reading_ts string, temp_value double, "
        "temp_unit string, humidity_pct double, door_open_flag tinyint, gps_lat double, gps_lon double, "
        "battery_pct double, dt date"
    ),
    "wms_scan_events": (
        "scan_id string, warehouse_code string, event_type string, order_number string, sku_code string, "
        "batch_id string, qty_cases smallint, pallet_id string, dock_door tinyint, operator_id string, "
        "handheld_device string, event_ts string, dt date"
    ),
    "erp_cdc/outlet_master": (
        "outlet_code string, __op string, __op_ts string, __seq bigint, outlet_name string, channel string, "
        "outlet_format string, city string, route_code string, warehouse_code string, credit_limit double, "
        "credit_terms_days bigint, gst_number string, status string, extract_date date"
    ),
    "erp_cdc/product_master": (
        "sku_code string, __op string, __op_ts string, __seq bigint, product_name string, category string, "
        "brand string, case_pack bigint, mrp double, list_price double, gst_rate_pct double, "
        "shelf_life_days bigint, is_chilled bigint, status string, extract_date date"
    ),
    "erp_cdc/sales_order_header": (
        "order_number string, __op string, __op_ts string, __seq bigint, outlet_code string, "
        "warehouse_code string, route_code string, order_date string, requested_delivery_date string, "
        "order_status string, line_count smallint, order_value_gross double, discount_amount double, "
        "tax_amount double, source_system string, extract_date date"
    ),
}

PARTITION_COLUMN = {
    "pos_transactions": "ingest_date",
    "reefer_telemetry": "dt",
    "wms_scan_events": "dt",
    "erp_cdc/outlet_master": "extract_date",
    "erp_cdc/product_master": "extract_date",
    "erp_cdc/sales_order_header": "extract_date",
}

MANIFEST_FEEDS = ("pos_transactions", "reefer_telemetry", "wms_scan_events")
UNLISTED_FEEDS = ("erp_cdc/outlet_master", "erp_cdc/product_master", "erp_cdc/sales_order_header")

REFERENCE_FILES = {
    "uom_conversion": "sku_code string, eaches_per_case int, base_uom string, case_uom string",
    "warehouse_master": (
        "warehouse_code string, warehouse_name string, city string, region_name string, timezone string, "
        "chilled_capacity_pallets int"
    ),
    "carrier_master": "carrier_id string, carrier_name string, mode string, sla_hours int, rate_per_km double",
    "fiscal_calendar": (
        "calendar_date date, fiscal_year string, fiscal_quarter string, fiscal_month_no int, iso_week int, "
        "day_of_week string, is_weekend int"
    ),
    "legacy_finance_weekly_report": (
        "week_ending date, channel string, gross_sales_inr double, units_sold bigint, basket_count bigint, "
        "prepared_by string, note string"
    ),
}

MANIFEST_SCHEMA = "feed string, partition string, file_count bigint, row_count bigint, bytes bigint"
