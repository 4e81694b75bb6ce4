"""The bound marketplace tables as SQL common table expressions, for checking results in a second engine."""

from __future__ import annotations

from bazaarlake.plans import bindings as B
from bazaarlake import constants as C


def sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


COUNTRIES = sql_list(B.COUNTRIES)
KYC = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in B.KYC_BY_SEGMENT.items()) + " END"
TIER = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in B.TIER_BY_SEGMENT.items()) + " END"
USER = "'USR-' || lpad(CAST({} AS VARCHAR), 6, '0')"
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"
PLACED = (
    "TIMESTAMP '2024-01-01' + to_seconds(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60 "
    "* 86400 + o_orderkey % 24 * 3600 + o_orderkey * 7 % 240 + l_linenumber * 11 AS BIGINT))"
)

LINES = f"""lines AS (
  SELECT *, {PLACED} AS at_ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""

PAYMENTS = LINES + f""", payments_raw AS (
  SELECT 'TXN-' || l_orderkey || '-' || l_linenumber AS transaction_id,
    {USER.format('o_custkey')} AS user_id,
    CASE WHEN l_partkey % 97 = 0 THEN -l_extendedprice WHEN l_partkey % 101 = 0 THEN NULL
         WHEN l_suppkey % 20 = 1 THEN CAST(l_linenumber AS DOUBLE) * CAST(0.25 AS DOUBLE) + CAST(0.5 AS DOUBLE)
         WHEN l_returnflag = 'R' THEN l_extendedprice ELSE l_quantity - CAST(0.01 AS DOUBLE) END AS amount,
    CASE WHEN l_suppkey % 10 = 0 THEN ' usd ' WHEN l_suppkey % 10 = 1 THEN 'GBP' WHEN l_suppkey % 10 = 2 THEN NULL
         WHEN l_suppkey % 10 = 3 AND l_linenumber = 1 THEN 'RUB' ELSE 'EUR' END AS currency,
    ({sql_list(B.METHODS)})[l_linenumber] AS payment_method,
    'PROD-' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS product_id, 'CAT-' || p_type AS product_category_id,
    p_type = 'PROMO' AS is_adult_product,
    ({COUNTRIES})[c_nationkey + 1] AS billing_country,
    CASE WHEN l_linestatus = 'O' THEN lower(({COUNTRIES})[s_nationkey + 1]) ELSE ({COUNTRIES})[c_nationkey + 1] END
      AS shipping_country,
    CASE WHEN l_suppkey % 20 = 0 THEN '185.220.101.' || (l_partkey % 250)
         WHEN l_suppkey % 20 = 1 THEN '45.33.32.' || (l_suppkey % 250)
         ELSE '78.' || (o_custkey % 250) || '.' || (o_orderkey % 250) || '.1' END AS ip_address,
    CASE WHEN l_suppkey % 20 = 0 THEN 'TOR' WHEN l_returnflag = 'A' THEN ({COUNTRIES})[s_nationkey + 1]
         ELSE ({COUNTRIES})[c_nationkey + 1] END AS ip_country_inferred,
    'dev-' || (o_custkey % 1000) || '-' || (o_orderkey % 3) AS device_fingerprint,
    l_tax >= CAST(0.06 AS DOUBLE) AS is_new_device, l_discount >= CAST(0.05 AS DOUBLE) AS is_new_merchant,
    {KYC} AS user_kyc_status, CAST(c_custkey % 70 + 10 AS INTEGER) AS user_age,
    CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE at_ts END AS event_timestamp,
    'MERCH-' || lpad(CAST(l_suppkey AS VARCHAR), 4, '0') AS merchant_id,
    l_discount >= CAST(0.09 AS DOUBLE) AND l_returnflag = 'R' AS fraud_label,
    'ORD-' || l_orderkey AS order_id, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_suppkey % 16 AS INTEGER) AS kafka_partition,
    l_partkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS kafka_offset,
    at_ts + to_seconds(l_partkey % 7200) AS ingested_at
  FROM lines)"""

# One row per transaction, cleaned, with the reason a row is refused.
CLEAN = PAYMENTS + f""", payments_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC) AS rn FROM payments_raw),
payments_clean AS (
  SELECT * EXCLUDE (rn, currency, billing_country, shipping_country, ip_country_inferred),
    CAST(abs(amount) AS DECIMAL(12,2)) AS amount_eur,
    coalesce(upper(trim(currency)), 'EUR') AS currency_code,
    CAST(event_timestamp AS DATE) AS event_date,
    upper(trim(billing_country)) AS billing_country_iso, upper(trim(shipping_country)) AS shipping_country_iso,
    upper(trim(ip_country_inferred)) AS ip_country_code
  FROM payments_ranked WHERE rn = 1),
payments_judged AS (
  SELECT *, CASE WHEN user_id IS NULL THEN 'missing_user' WHEN amount IS NULL THEN 'missing_amount'
    WHEN amount <= 0 OR amount_eur <= 0 THEN 'amount_not_positive'
    WHEN currency_code NOT IN ({', '.join(repr(c) for c in C.CURRENCIES)}) THEN 'currency_not_supported'
    WHEN event_timestamp IS NULL THEN 'bad_timestamp' END AS reject_reason
  FROM payments_clean),
valid AS (
  SELECT *, CAST(amount_eur * 100 AS BIGINT) AS cents, CAST(epoch(event_timestamp) AS BIGINT) AS sec,
    billing_country_iso <> shipping_country_iso AS is_cross_border,
    ip_country_code <> billing_country_iso AS ip_geo_mismatch,
    user_age < 18 AS user_is_minor,
    CASE WHEN fraud_label THEN 'blocked' ELSE 'success' END AS status
  FROM payments_judged WHERE reject_reason IS NULL)"""

FEATURES = CLEAN + """, featured AS (
  SELECT *, count(*) OVER w AS n30, sum(cents) OVER w AS s30, sum(CAST(cents AS HUGEINT) * cents) OVER w AS q30,
    count(*) OVER (PARTITION BY user_id ORDER BY event_timestamp
      RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) AS n5,
    count(*) OVER (PARTITION BY user_id ORDER BY event_timestamp
      RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n60,
    row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, transaction_id) = 1 AS is_first_transaction
  FROM valid
  WINDOW w AS (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW))"""

CLICKSTREAM = f"""clicks_raw AS (
  SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events),
clicks AS (
  SELECT 'EVT-' || event_id AS event_id,
    CASE WHEN event_type = 'click' THEN 'cart_add' WHEN event_type = 'error' THEN ({sql_list(C.KYC_EVENTS)})[k % 5 + 1]
         WHEN event_type = 'signup' AND k % 4 >= 2 THEN 'wishlist_add' ELSE 'page_view' END AS event_type,
    CASE event_type WHEN 'view' THEN ({sql_list(B.VIEW_PAGES)})[k % 3 + 1] WHEN 'click' THEN 'cart_add'
      WHEN 'purchase' THEN (['checkout_start', 'checkout_payment', 'order_confirmation'])[k % 3 + 1]
      WHEN 'error' THEN 'user_kyc' ELSE CASE WHEN k % 4 >= 2 THEN 'product_detail' ELSE 'cart_view' END END AS page,
    {USER.format('user_id')} AS user_id, user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
    ts AS event_timestamp,
    ({sql_list(B.DEVICES)})[(CASE WHEN k % 7 = 0 THEN 5 ELSE user_id % 5 END) + 1] AS device_type,
    ({sql_list(B.AGENTS)})[(CASE WHEN k % 7 = 0 THEN 5 ELSE user_id % 5 END) + 1] AS user_agent,
    ({sql_list(B.REFERRERS)})[k % 10 + 1] AS referrer,
    'PROD-' || k AS product_id, 'CAT-' || (k % 7) AS category_id, k AS scroll_depth_pct,
    CASE WHEN event_type <> 'error' THEN CAST(floor(value / 10) AS INTEGER) END AS duration_seconds,
    k % 7 = 0 AS is_bot_suspected, value AS product_price, k % 4 + 1 AS quantity, k % 7 = 6 AS is_adult_product,
    event_id AS kafka_offset, CAST(events_user % 8 AS INTEGER) AS kafka_partition, ts + to_seconds(k) AS ingested_at
  FROM (SELECT *, user_id AS events_user FROM clicks_raw)),
clicks_typed AS (
  SELECT *, CAST(event_timestamp AS DATE) AS event_date,
    CASE WHEN event_type = 'page_view' AND page = 'product_detail' THEN 'product_view'
         WHEN event_type = 'page_view' AND page = 'checkout_start' THEN 'checkout_start'
         WHEN event_type = 'cart_add' THEN 'add_to_cart' ELSE event_type END AS canonical_type,
    CASE WHEN lower(device_type) LIKE 'mobile%' THEN 'mobile' WHEN lower(device_type) LIKE 'tablet%' THEN 'tablet'
         ELSE 'desktop' END AS device_category,
    CASE WHEN lower(user_agent) LIKE '%chrome%' THEN 'chrome' WHEN lower(user_agent) LIKE '%firefox%' THEN 'firefox'
         WHEN lower(user_agent) LIKE '%safari%' THEN 'safari' WHEN lower(user_agent) LIKE '%edge%' THEN 'edge'
         ELSE 'other' END AS browser,
    CASE WHEN referrer LIKE '%google%' OR referrer LIKE '%bing%' THEN 'organic_search'
         WHEN referrer LIKE '%facebook%' OR referrer LIKE '%instagram%' OR referrer LIKE '%tiktok%' THEN 'social'
         WHEN referrer = 'email_campaign' THEN 'email' WHEN referrer = 'direct' OR referrer IS NULL THEN 'direct'
         ELSE 'referral' END AS traffic_source,
    CASE WHEN event_type = 'cart_add' THEN product_price * quantity END AS cart_value_eur
  FROM clicks),
clicks_kept AS (
  SELECT * FROM clicks_typed WHERE duration_seconds >= 2 OR (duration_seconds IS NULL AND event_type <> 'page_view'))"""

SESSIONS = CLICKSTREAM + """, session_agg AS (
  SELECT session_id, arg_min(user_id, {'a': event_timestamp, 'b': event_id}) AS user_id,
    count(DISTINCT user_id) > 1 AS is_multi_user,
    max(device_category) AS device_category, max(browser) AS browser, max(traffic_source) AS traffic_source,
    min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
    CAST(floor(epoch(max(event_timestamp))) AS BIGINT) - CAST(floor(epoch(min(event_timestamp))) AS BIGINT)
      AS session_duration_seconds,
    CAST(min(event_timestamp) AS DATE) AS session_date, count(*) AS total_events,
    count(*) FILTER (canonical_type = 'page_view') AS page_views,
    count(*) FILTER (canonical_type = 'product_view') AS product_views,
    count(*) FILTER (canonical_type = 'add_to_cart') AS add_to_cart_count,
    count(*) FILTER (canonical_type = 'remove_from_cart') AS remove_from_cart_count,
    count(*) FILTER (canonical_type = 'checkout_start') AS checkout_starts,
    count(*) FILTER (canonical_type = 'wishlist_add') AS wishlist_adds,
    count(DISTINCT product_id) AS unique_products_viewed, count(DISTINCT category_id) AS unique_categories_viewed,
    max(scroll_depth_pct) AS max_scroll_depth,
    CAST(sum(scroll_depth_pct) AS DOUBLE) / count(scroll_depth_pct) AS avg_scroll_depth,
    CAST(sum(duration_seconds) AS DOUBLE) / count(duration_seconds) AS avg_page_duration_seconds,
    max(cart_value_eur) AS max_cart_value_eur,
    bool_or(canonical_type = 'checkout_start') AS has_conversion,
    bool_or(is_adult_product) AS contains_adult_products,
    arg_min(page, {'a': event_timestamp, 'b': event_id}) AS entry_page,
    arg_max(page, {'a': event_timestamp, 'b': event_id}) AS exit_page,
    max(ingested_at) AS ingested_at
  FROM clicks_kept WHERE session_id IS NOT NULL AND event_id IS NOT NULL GROUP BY session_id),
sessions AS (
  SELECT *, CAST(CASE WHEN has_conversion THEN 1.0 WHEN add_to_cart_count > 0 THEN 0.7 WHEN product_views > 2 THEN 0.4
    WHEN page_views > 1 THEN 0.2 ELSE 0.0 END AS DOUBLE) AS engagement_score
  FROM session_agg WHERE total_events >= 2 AND session_duration_seconds >= 2)"""

CRM = f"""crm AS (
  SELECT {USER.format('c_custkey')} AS user_id, c_custkey,
    CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS registration_date,
    'City-' || c_nationkey AS city, lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS postal_code,
    ({COUNTRIES})[c_nationkey + 1] AS country, CAST(c_custkey % 70 + 10 AS INTEGER) AS age,
    c_custkey % 70 + 10 < 18 AS is_minor, {KYC} AS id_verification_status, {TIER} AS customer_segment,
    CASE WHEN c_custkey % 20 <> 0 THEN '/ids/' || c_custkey || '.jpg' END AS id_document_image_path,
    c_acctbal AS total_spent_eur, c_acctbal > 0 AS newsletter_optin,
    CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 + c_custkey % 11 - 1 AS INTEGER) AS DATE) AS gdpr_consent_date,
    ' Client.' || c_custkey || '@Example.COM ' AS email,
    '+336' || lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0') AS phone,
    TIMESTAMP '2024-02-29 02:00:00' + to_seconds(c_custkey % 3600) AS ingested_at
  FROM customer)"""

PARCELS = f"""parcels AS (
  SELECT 'LOG-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS event_id,
    'ORD-' || l_orderkey AS order_id, {USER.format('o_custkey')} AS user_id, 'CAT-' || p_type AS product_category_id,
    CAST((l_linenumber + l_partkey) % 12 AS INTEGER) AS step,
    ({sql_list(C.STATUS_FLOW + C.STATUS_EXCEPTIONS)})[(l_linenumber + l_partkey) % 12 + 1] AS status,
    CASE WHEN (l_linenumber + l_partkey) % 12 BETWEEN 1 AND 7
      THEN ({sql_list(C.STATUS_FLOW)})[(l_linenumber + l_partkey) % 12] END AS previous_status,
    ({sql_list(B.CARRIERS)})[l_suppkey % 7 + 1] AS carrier, 'WH-' || s_nationkey AS warehouse_id,
    ({COUNTRIES})[c_nationkey + 1] AS delivery_country, at_ts AS order_ts,
    CASE WHEN (l_linenumber + l_partkey) % 12 = 7 THEN at_ts + to_days(CAST(l_partkey % 12 AS INTEGER)) END
      AS delivered_ts,
    at_ts + to_seconds(l_linenumber * 3600 + l_partkey % 60) AS event_ts,
    l_quantity / 10 AS weight_kg, l_discount >= CAST(0.08 AS DOUBLE) AS is_delayed,
    CASE WHEN l_discount >= CAST(0.08 AS DOUBLE) THEN ({sql_list(B.REASONS)})[l_partkey % 7 + 1] END AS delay_reason,
    l_extendedprice / 100 AS shipping_cost_eur, ({sql_list(B.STOCK_LEVELS)})[l_partkey % 4 + 1] AS stock_level
  FROM lines)"""

LOGISTICS = LINES + ", " + PARCELS

PRODUCTS = """products AS (
  SELECT 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS product_id, p_name AS name,
    'CAT-' || p_type AS category_id, p_type = 'PROMO' AS adult_only, p_retailprice * 2 AS price_max FROM part)"""
