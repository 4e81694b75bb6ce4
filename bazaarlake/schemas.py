"""Stream schemas and table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

KINDS = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(),
}


def _fields(text: str) -> T.StructType:
    """A nullable schema from 'name type, ...'; unlike a DDL string it needs no running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind], True) for name, kind in pairs])


# Field names and types of the three streams and the customer file.
CLICKSTREAM = _fields(
    "event_id string, event_type string, page string, page_path string, user_id string, session_id string, "
    "timestamp string, device_type string, user_agent string, device_fingerprint string, ip_address string, "
    "referrer string, product_id string, category_id string, scroll_depth_pct int, duration_seconds int, "
    "viewport_width int, is_bot_suspected boolean, utm_source string, utm_medium string, product_name string, "
    "product_price double, quantity int, is_adult_product boolean, document_type string, upload_method string, "
    "kyc_current_status string, failure_reason string, user_age int, document_path string, blocked_category string, "
    "kyc_status string, block_reason string, attempted_category string"
)
PAYMENTS = _fields(
    "transaction_id string, user_id string, amount double, currency string, payment_method string, "
    "product_id string, product_category_id string, is_adult_product boolean, card_issuer string, "
    "billing_country string, shipping_country string, ip_address string, ip_country_inferred string, "
    "device_type string, user_agent string, device_fingerprint string, is_new_device boolean, "
    "is_new_merchant boolean, user_kyc_status string, user_age int, timestamp string, merchant_id string, "
    "fraud_label_ground_truth boolean, fraud_scenario_label string, velocity_attack_group string, "
    "geo_mismatch_detail string, card_testing_batch_id string, account_takeover_indicator string"
)
LOGISTICS = _fields(
    "event_id string, order_id string, user_id string, product_id string, product_category_id string, "
    "is_adult_product boolean, status string, previous_status string, carrier string, tracking_number string, "
    "warehouse_id string, warehouse_city string, delivery_city string, delivery_postal_code string, "
    "delivery_country string, order_date string, estimated_delivery string, actual_delivery string, "
    "timestamp string, weight_kg double, nb_items int, is_delayed boolean, delay_reason string, "
    "shipping_cost_eur double, billing_shipping_country_match boolean, warehouse_stock_level string, "
    "customer_rating int"
)
CRM = _fields(
    "user_id string, registration_date date, city string, postal_code string, country string, birth_date date, "
    "age int, is_minor boolean, id_verification_status string, id_document_image_path string, "
    "customer_segment string, total_orders int, total_spent_eur double, last_order_date date, "
    "newsletter_optin boolean, gdpr_consent_date date, crm_extract_date date"
)
KAFKA = _fields(
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
STREAMS = {"clickstream-raw": CLICKSTREAM, "payments-raw": PAYMENTS, "logistics-raw": LOGISTICS}

# Column order of the payments table.
SILVER_PAYMENTS_COLUMNS = [
    "transaction_id", "user_id", "merchant_id", "order_id", "amount_eur", "currency_code", "event_timestamp",
    "event_date", "event_hour", "event_day_of_week", "time_of_day", "billing_country_iso", "shipping_country_iso",
    "ip_country_code", "is_cross_border", "ip_geo_mismatch", "geo_distance_km", "payment_method", "is_new_card",
    "is_new_merchant", "user_kyc_status", "user_is_minor", "user_age", "user_txn_count_30d", "user_avg_amount_30d",
    "user_amount_stddev_30d", "amount_vs_avg_ratio", "is_first_transaction", "user_distinct_countries_30d",
    "user_distinct_merchants_30d", "velocity_count_5min", "fraud_type", "fraud_score_label", "blocked",
    "reject_reason", "ingested_at", "pii_anonymized_at", "silver_loaded_at",
]
# Columns the fact table needs beyond that contract.
SILVER_PAYMENTS_EXTRA = ["product_id", "quantity", "status", "fraud_label"]

# Column order of the sessions table.
SILVER_SESSIONS_COLUMNS = [
    "session_id", "user_id", "device_category", "browser", "traffic_source", "session_start", "session_end",
    "session_date", "session_duration_seconds", "total_events", "page_views", "product_views", "add_to_cart_count",
    "remove_from_cart_count", "checkout_starts", "wishlist_adds", "unique_products_viewed",
    "unique_categories_viewed", "max_scroll_depth", "avg_scroll_depth", "avg_page_duration_seconds",
    "max_cart_value_eur", "has_conversion", "entry_page", "exit_page", "contains_adult_products",
    "engagement_score", "ingested_at", "silver_loaded_at",
]
