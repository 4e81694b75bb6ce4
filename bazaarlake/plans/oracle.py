"""The SQL counterpart of each query, for a second engine on the same tables."""

from __future__ import annotations

from bazaarlake import constants as C
from bazaarlake.operators import fraud, privacy
from bazaarlake.plans import bindings as B
from bazaarlake.plans import oracle_base as O

ORACLES: dict[str, str] = {}


def rounded(x: str, digits: int = 4) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return rounded(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0.0)")


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def key(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(CAST({p} AS VARCHAR), '_null_')" for p in parts) + ")"


MEAN = "CAST(s30 AS DOUBLE) / 100 / n30"
STD = ("CASE WHEN n30 > 1 THEN " + rounded(
    "sqrt(CAST(n30 * q30 - s30 * s30 AS DOUBLE) / (CAST(n30 AS DOUBLE) * (CAST(n30 AS DOUBLE) - 1))) / 100") + " END")
RATIO = rounded(f"CAST(amount_eur AS DOUBLE) / nullif({MEAN}, 0.0)")
MONTH = f"""transaction_id, user_id, n30 AS user_txn_count_30d, {MEAN} AS user_avg_amount_30d,
  {STD} AS user_amount_stddev_30d, {RATIO} AS amount_vs_avg_ratio"""
TIME_OF_DAY = """CASE WHEN hour(event_timestamp) BETWEEN 0 AND 6 THEN 'night' WHEN hour(event_timestamp) BETWEEN 7 AND 12
  THEN 'morning' WHEN hour(event_timestamp) BETWEEN 13 AND 18 THEN 'afternoon'
  WHEN event_timestamp IS NOT NULL THEN 'evening' END"""


def lat(c: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN radians({v[0]})" for k, v in C.CENTROIDS.items()) + " END"


def lon(c: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN radians({v[1]})" for k, v in C.CENTROIDS.items()) + " END"


A, Z = "ip_country_code", "shipping_country_iso"
INNER = f"""(pow(sin((({lat(Z)}) - ({lat(A)})) / 2), 2)
  + cos({lat(A)}) * cos({lat(Z)}) * pow(sin((({lon(Z)}) - ({lon(A)})) / 2), 2))"""
KM = rounded(f"2 * 6371.0 * asin(sqrt(CASE WHEN {INNER} > 1 THEN 1 ELSE {INNER} END))", 1)

DISTINCT = """count(DISTINCT shipping_country_iso) OVER w AS user_distinct_countries_30d,
  count(DISTINCT merchant_id) OVER w AS user_distinct_merchants_30d"""
W30 = "WINDOW w AS (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW)"

# Sources.

ORACLES["bronze_parse_events"] = f"""WITH {O.CLICKSTREAM}, flagged AS (
  SELECT *, kafka_offset % 11 = 0 OR kafka_offset % 10 = 0 AS _parse_error FROM clicks)
SELECT kafka_offset, kafka_partition, user_id AS kafka_key, _parse_error,
  CASE WHEN NOT _parse_error THEN event_id END AS event_id, 2024 AS year, 3 AS month, 1 AS day,
  'clickstream-raw' AS _source_topic, CASE WHEN NOT _parse_error THEN event_type END AS event_type,
  CASE WHEN NOT _parse_error THEN page END AS page,
  CASE WHEN NOT _parse_error THEN scroll_depth_pct END AS scroll_depth_pct,
  CASE WHEN NOT _parse_error THEN duration_seconds END AS duration_seconds,
  CASE WHEN NOT _parse_error THEN is_adult_product END AS is_adult_product FROM flagged"""
ORACLES["bronze_parse_payments"] = f"""WITH {O.PAYMENTS}, flagged AS (
  SELECT *, kafka_offset % 11 = 0 AS is_empty, kafka_offset % 11 = 0 OR kafka_offset % 10 = 0 AS _parse_error
  FROM payments_raw)
SELECT _parse_error, count(*) AS messages, count(*) FILTER (is_empty) AS empty_messages,
  count(*) FILTER (NOT _parse_error AND amount IS NULL) AS missing_amounts FROM flagged GROUP BY ALL"""
ORACLES["incremental_slice"] = """SELECT event_id, ts, user_id, value FROM events
WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1970-01-01') FROM events WHERE ts < TIMESTAMP '2024-01-20')"""
ORACLES["incremental_lookback"] = """SELECT event_id, ts, user_id, value FROM events
WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 3 DAYS"""
ORACLES["source_readiness"] = f"""WITH {O.PAYMENTS}
SELECT CAST(ingested_at AS DATE) AS ingestion_day, count(*) AS rows FROM payments_raw GROUP BY ALL"""

# Payments.

ORACLES["payments_clean"] = f"""WITH {O.CLEAN}
SELECT transaction_id, user_id, CAST(amount_eur AS DOUBLE) AS amount_eur, currency_code, event_timestamp, event_date,
  CAST(hour(event_timestamp) AS INTEGER) AS event_hour, CAST(dayofweek(event_timestamp) + 1 AS INTEGER)
  AS event_day_of_week, {TIME_OF_DAY} AS time_of_day, billing_country_iso, shipping_country_iso, ip_country_code,
  billing_country_iso <> shipping_country_iso AS is_cross_border,
  ip_country_code <> billing_country_iso AS ip_geo_mismatch, user_age < 18 AS user_is_minor, reject_reason
FROM payments_judged"""
ORACLES["payments_dedup_latest"] = """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
  l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1"""
ORACLES["payments_validity_split"] = f"""WITH {O.CLEAN}
SELECT count(*) FILTER (reject_reason IS NULL) AS valid_rows,
  count(*) FILTER (reject_reason IS NOT NULL) AS rejected_rows FROM payments_judged"""
ORACLES["payments_quarantine"] = f"""WITH {O.CLEAN}
SELECT transaction_id, user_id, amount, currency_code, reject_reason FROM payments_judged
WHERE reject_reason IS NOT NULL"""
ORACLES["currency_conversion"] = f"""WITH {O.CLEAN}, rates AS (
  SELECT DISTINCT CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60
    AS INTEGER) AS DATE) AS rate_date FROM orders)
SELECT transaction_id, currency_code, CAST(CASE WHEN currency_code = 'EUR' THEN amount_eur
  WHEN rate_date IS NULL OR currency_code NOT IN ('USD', 'GBP') THEN NULL
  ELSE CAST(amount_eur * CASE currency_code WHEN 'USD' THEN 0.9 ELSE 1.2 END AS DECIMAL(12,2)) END AS DOUBLE)
  AS amount_eur FROM valid LEFT JOIN rates ON event_date = rate_date"""
ORACLES["user_rolling_30d"] = ORACLES["user_rolling_30d_swept"] = f"WITH {O.FEATURES} SELECT {MONTH} FROM featured"
ORACLES["user_distinct_30d"] = ORACLES["user_distinct_30d_swept"] = (
    f"WITH {O.CLEAN} SELECT transaction_id, {DISTINCT} FROM valid {W30}")
ORACLES["velocity_5min_1h"] = """SELECT event_id, user_id,
  count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW)
    AS events_5min,
  count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
    AS events_1h FROM events"""
ORACLES["first_transaction"] = f"""WITH {O.FEATURES}
SELECT transaction_id, user_id, is_first_transaction FROM featured"""
ORACLES["cross_border"] = f"""WITH {O.CLEAN}
SELECT billing_country_iso, shipping_country_iso, is_cross_border, count(*) AS payments,
  count(*) FILTER (ip_geo_mismatch) AS ip_mismatches FROM valid GROUP BY ALL"""
ORACLES["silver_payments"] = f"""WITH {O.FEATURES}
SELECT {MONTH}, merchant_id, order_id, CAST(amount_eur AS DOUBLE) AS amount_eur, currency_code, event_timestamp,
  event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
  CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS event_day_of_week, {TIME_OF_DAY} AS time_of_day,
  billing_country_iso, shipping_country_iso, ip_country_code, is_cross_border, ip_geo_mismatch,
  {KM} AS geo_distance_km, payment_method, is_new_merchant, user_kyc_status, user_is_minor, user_age,
  is_first_transaction, count(DISTINCT billing_country_iso) OVER w AS user_distinct_countries_30d,
  count(DISTINCT merchant_id) OVER w AS user_distinct_merchants_30d, n5 AS velocity_count_5min,
  CASE WHEN fraud_label THEN 'account_takeover' END AS fraud_type, fraud_label AS blocked,
  CASE WHEN fraud_label THEN 'fraud_detected' END AS reject_reason, ingested_at, product_id, quantity, status,
  fraud_label FROM featured {W30}"""
ORACLES["incremental_refresh"] = f"""WITH {O.FEATURES}, starts AS (
  SELECT user_id AS new_user, min(event_timestamp) AS first_new FROM valid WHERE payment_method = 'paypal' GROUP BY 1),
full_table AS (SELECT *, count(DISTINCT merchant_id) OVER w AS user_distinct_merchants_30d FROM featured {W30})
SELECT {MONTH}, n5 AS velocity_count_5min, is_first_transaction, user_distinct_merchants_30d
FROM full_table JOIN starts ON user_id = new_user AND event_timestamp >= first_new"""
ORACLES["silver_payments_swept"] = f"""WITH {O.FEATURES}
SELECT {MONTH}, n5 AS velocity_count_5min, is_first_transaction,
  count(DISTINCT billing_country_iso) OVER w AS user_distinct_countries_30d,
  count(DISTINCT merchant_id) OVER w AS user_distinct_merchants_30d FROM featured {W30}"""
ORACLES["upsert_latest"] = """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice FROM orders"""

# Sessions.

ORACLES["session_gap_30m"] = ORACLES["session_gap_30m_chunked"] = """WITH gaps AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER u <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS opens FROM events
  WINDOW u AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM gaps)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS total_events
FROM numbered GROUP BY user_id, session_no"""
ORACLES["event_gaps"] = ORACLES["event_gaps_chunked"] = """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT)
  - CAST(floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS gap_seconds FROM events"""
ORACLES["clickstream_clean"] = f"""WITH {O.CLICKSTREAM}
SELECT event_id, event_timestamp, event_date, duration_seconds, scroll_depth_pct,
  CASE WHEN device_type LIKE 'mobile%' THEN 'mobile' WHEN device_type LIKE 'tablet%' THEN 'tablet' ELSE 'desktop' END
    AS device_category,
  CASE WHEN device_type LIKE '%chrome%' THEN 'chrome' WHEN device_type LIKE '%firefox%' THEN 'firefox'
    WHEN device_type LIKE '%safari%' THEN 'safari' ELSE 'other' END AS browser,
  CASE referrer WHEN 'google.com' THEN 'organic_search' WHEN 'facebook.com' THEN 'social'
    WHEN 'email_campaign' THEN 'email' WHEN 'direct' THEN 'direct' ELSE 'other' END AS traffic_source
FROM clicks_kept"""
ORACLES["device_class"] = f"""WITH {O.CLICKSTREAM}
SELECT device_category, browser, traffic_source, canonical_type, count(*) AS events FROM clicks_kept GROUP BY ALL"""
ORACLES["session_metrics"] = f"WITH {O.SESSIONS} SELECT * EXCLUDE (entry_page, exit_page) FROM session_agg"
ORACLES["session_entry_exit"] = f"WITH {O.SESSIONS} SELECT session_id, entry_page, exit_page FROM session_agg"
ORACLES["silver_sessions"] = f"WITH {O.SESSIONS} SELECT * FROM sessions"
ORACLES["touched_sessions"] = f"""WITH {O.CLICKSTREAM}
SELECT session_id, count(*) AS events FROM clicks WHERE session_id IN (
  SELECT session_id FROM clicks WHERE event_timestamp >= TIMESTAMP '2024-01-30' - INTERVAL 3 DAYS) GROUP BY ALL"""

# Privacy and customers.


def masked(column: str) -> str:
    for pattern, replacement in privacy.MASKS:
        column = f"regexp_replace({column}, '{pattern}', '{replacement.replace('$1', chr(92) + '1')}', 'g')"
    return column


def token(label: str, text: str, length: int) -> str:
    return f"'{label}' || substr(sha256({text}), 1, {length})"


NOTES = "'appeler ' || phone || ' ou' || email || 'IBAN FR7630006000011234567890189'"
PEOPLE = O.CRM + f""", silver_crm AS (
  SELECT *, {token(C.EMAIL_TOKEN, f"lower(trim(email)) || '{B.SALT}'", 16)} AS email_hashed,
    {token(C.PHONE_TOKEN, f"phone || '{B.SALT}'", 8)} AS phone_token, substr(postal_code, 1, 4) || '0' AS postal_zone,
    CASE WHEN age < 18 THEN 'minor' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 50 THEN '35-49'
      ELSE '50+' END AS age_group, {key('user_id')} AS customer_key FROM crm)"""
ORACLES["pseudonymise_crm"] = f"""WITH {PEOPLE}
SELECT user_id, email_hashed, phone_token, postal_zone, {masked(NOTES)} AS notes, customer_segment,
  TIMESTAMP '{B.AS_OF}' AS pii_anonymized_at, 'native-1' AS pii_anonymization_version FROM silver_crm"""
ORACLES["crm_profile"] = f"""WITH {O.CRM}
SELECT customer_segment, id_verification_status, count(*) AS customers,
  {rounded('CAST(count(*) FILTER (is_minor) AS DOUBLE) * 100 / count(*)', 2)} AS minor_pct,
  count(id_document_image_path) AS with_image FROM crm GROUP BY ALL"""
ORACLES["mask_free_text"] = f"SELECT doc_id, {masked('text')} AS masked FROM documents"
ORACLES["pii_leak_check"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (regexp_matches({c}, '{privacy.EMAIL}')) AS leaking_rows,
  min(doc_id) FILTER (regexp_matches({c}, '{privacy.EMAIL}')) AS first_key FROM documents"""
    for c in ("text", "lang", "source"))
ERASED = token(C.ERASED_TOKEN, f"{O.USER.format('c_custkey')} || '{B.SALT}'", 16)
ORACLES["gdpr_erase"] = f"""SELECT CASE WHEN c_acctbal < 0 THEN {ERASED} ELSE {O.USER.format('o_custkey')} END AS user_id,
  md5(CASE WHEN c_acctbal < 0 THEN {ERASED} ELSE {O.USER.format('o_custkey')} END) AS customer_key, o_orderkey,
  o_totalprice FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
ORACLES["gdpr_receipts"] = f"""SELECT {ERASED} AS pseudonym, CAST(1 AS BIGINT) AS dim_customers_rows,
  (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS fact_orders_rows, true AS found,
  TIMESTAMP '{B.AS_OF}' AS erased_at FROM customer WHERE c_acctbal < 0"""
ORACLES["privacy_violations"] = f"""WITH {O.CRM}
SELECT user_id, 'minor_with_image' AS violation FROM crm WHERE is_minor AND id_document_image_path IS NOT NULL
UNION ALL SELECT user_id, 'consent_too_early' FROM crm WHERE gdpr_consent_date < registration_date"""

# Gold.

ORACLES["dim_date"] = """WITH days AS (SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP),
    INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders))
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_actual, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
  strftime(d, '%A') AS day_name, CAST(dayofmonth(d) AS INTEGER) AS day_of_month, dayofweek(d) IN (0, 6) AS is_weekend,
  month(d) = 1 AND dayofmonth(d) = 1 AS is_new_year, month(d) = 7 AND dayofmonth(d) = 14 AS is_bastille_day,
  month(d) = 12 AND dayofmonth(d) = 25 AS is_christmas,
  month(d) = 11 AND dayofweek(d) = 5 AND dayofmonth(d) BETWEEN 23 AND 29 AS is_black_friday,
  month(d) IN (11, 12) AS is_holiday_season, strftime(d, '%Y-%m') AS year_month,
  'Q' || quarter(d) || ' ' || year(d) AS year_quarter FROM days"""
RISK = "CASE WHEN adult_only THEN 'high' WHEN price_max >= CAST(199.99 AS DOUBLE) THEN 'medium' ELSE 'low' END"
ORACLES["dim_customers_rfm"] = f"""WITH {O.SESSIONS}, {PEOPLE}, {O.CLEAN}, totals AS (
  SELECT user_id, count(*) FILTER (status = 'success') AS lifetime_orders,
    sum(amount_eur) FILTER (status = 'success') AS lifetime_value,
    max(event_date) FILTER (status = 'success') AS last_purchase_date,
    min(event_date) FILTER (status = 'success') AS first_purchase_date, count(*) FILTER (fraud_label) AS fraud_attempts
  FROM valid GROUP BY user_id),
visits AS (SELECT user_id, count(*) AS total_sessions,
  CAST(count(*) FILTER (has_conversion) AS DOUBLE) / count(*) AS conversion_rate FROM sessions GROUP BY user_id),
joined AS (
  SELECT c.*, t.* EXCLUDE (user_id), v.* EXCLUDE (user_id),
    CAST(date_diff('day', last_purchase_date, DATE '2024-03-01') AS INTEGER) AS recency_days,
    coalesce(lifetime_orders, 0) AS frequency, coalesce(lifetime_value, 0) AS monetary
  FROM silver_crm c LEFT JOIN totals t ON c.user_id = t.user_id LEFT JOIN visits v ON c.user_id = v.user_id)
SELECT customer_key, user_id, age, age_group, city, postal_zone, country, id_verification_status AS kyc_status,
  is_minor, is_minor AND id_verification_status = 'verified' AS kyc_minor_anomaly, customer_segment, recency_days,
  frequency, CAST(monetary AS DOUBLE) AS monetary_eur,
  CASE WHEN frequency > 0 THEN CAST(monetary AS DOUBLE) / frequency ELSE 0.0 END AS avg_order_value_eur,
  coalesce(total_sessions, 0) AS total_sessions, coalesce(conversion_rate, 0.0) AS session_conversion_rate,
  coalesce(fraud_attempts, 0) AS fraud_attempts_count, coalesce(fraud_attempts, 0) > 0 AS has_fraud_history,
  registration_date, first_purchase_date, last_purchase_date, gdpr_consent_date, newsletter_optin,
  CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS FIRST, user_id) AS INTEGER) AS rfm_recency_score,
  CAST(ntile(5) OVER (ORDER BY frequency, user_id) AS INTEGER) AS rfm_frequency_score,
  CAST(ntile(5) OVER (ORDER BY monetary, user_id) AS INTEGER) AS rfm_monetary_score FROM joined"""
ORACLES["rfm_tiles_sorted"] = """SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER)
  AS price_tile FROM orders"""
ORACLES["dim_products"] = f"""WITH {O.PRODUCTS}
SELECT {key('product_id')} AS product_key, product_id, name, category_id, adult_only, {RISK} AS risk_category
FROM products"""
ORACLES["dim_merchants"] = f"""SELECT {key("'MERCH-' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0')")} AS merchant_key,
  'MERCH-' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS merchant_id, s_name AS merchant_name, r_name AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
FACTS = f"""{PEOPLE}, {O.PRODUCTS}, {O.FEATURES}, facts_all AS (
  SELECT f.*, {RATIO} AS amount_vs_avg_ratio, c.customer_key, c.customer_segment, c.id_verification_status AS kyc_status,
    c.age_group, {key('p.product_id')} AS product_key, p.category_id, {RISK} AS risk_category,
    CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS order_date_key
  FROM featured f LEFT JOIN silver_crm c ON f.user_id = c.user_id LEFT JOIN products p ON f.product_id = p.product_id),
facts AS (SELECT * FROM facts_all WHERE status = 'success')"""
ORACLES["fact_orders"] = f"""WITH {FACTS}
SELECT {key('transaction_id')} AS fact_key, transaction_id, order_id, user_id, merchant_id, customer_key, product_key,
  order_date_key, CAST(amount_eur AS DOUBLE) AS amount_eur, currency_code, payment_method, quantity,
  billing_country_iso, shipping_country_iso, is_cross_border, ip_geo_mismatch, user_is_minor, is_first_transaction,
  is_new_merchant, n30 AS user_txn_count_30d, amount_vs_avg_ratio, fraud_label,
  CAST(NULL AS VARCHAR) AS fraud_type, customer_segment, kyc_status, age_group, category_id, risk_category,
  event_date, event_timestamp FROM facts"""
ORACLES["kpi_daily"] = f"""WITH {FACTS}
SELECT event_date, count(*) AS orders, CAST(sum(amount_eur) AS DOUBLE) AS revenue_eur,
  count(DISTINCT user_id) AS active_customers, CAST(sum(amount_eur) AS DOUBLE) / count(*) AS avg_basket_eur,
  count(*) FILTER (is_cross_border) AS cross_border_orders, count(*) FILTER (is_first_transaction) AS first_orders
FROM facts GROUP BY event_date"""
LABELLED = f"""{FACTS}, dayed AS (
  SELECT * EXCLUDE (n30, s30, q30, amount_vs_avg_ratio), count(*) OVER d AS n30, sum(cents) OVER d AS s30,
    sum(CAST(cents AS HUGEINT) * cents) OVER d AS q30
  FROM facts_all WINDOW d AS (PARTITION BY user_id ORDER BY CAST(event_date AS TIMESTAMP)
    RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)),
labelled AS (SELECT *, event_date AS feature_date, fraud_label AS is_fraud FROM dayed WHERE fraud_label IS NOT NULL)"""
ORACLES["feature_store"] = f"""WITH {LABELLED}
SELECT transaction_id, user_id, feature_date, n5 AS txn_count_5min, n60 AS txn_count_1h, n30 AS txn_count_30d,
  {MEAN} AS avg_amount_30d, {RATIO} AS amount_vs_avg_ratio, {STD} AS amount_stddev_30d, kyc_status, age_group,
  risk_category, category_id, payment_method, billing_country_iso, shipping_country_iso, is_cross_border,
  user_is_minor, is_first_transaction, is_new_merchant, ip_geo_mismatch, is_fraud,
  CASE WHEN fraud_label THEN 'account_takeover' END AS fraud_type, CAST(amount_eur AS DOUBLE) AS amount_eur
FROM labelled"""
ORACLES["referential_integrity"] = f"""WITH {O.CLEAN}
SELECT transaction_id, 'missing_customer' AS integrity_error FROM valid
  JOIN customer ON user_id = {O.USER.format('c_custkey')} WHERE status = 'success' AND c_acctbal < 0
UNION ALL SELECT transaction_id, 'missing_product' FROM valid
  JOIN part ON product_id = 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 6, '0')
  WHERE status = 'success' AND NOT p_size > 1"""

# Quality.


def suite(source: str, rules: list[tuple[str, str, str]], tables: str) -> str:
    """One SELECT per rule; a rule is (name, severity, count of failures)."""
    rows = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule, '{severity}' AS severity, CAST({failed} AS BIGINT) AS failed, count(*) AS total "
        f"FROM {source}" for name, severity, failed in rules)
    return f"""WITH {tables}, results AS ({rows})
SELECT *, CASE WHEN failed = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM results"""


def bad(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def repeated(column: str, source: str) -> str:
    return (f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {source} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1))")


def absent(*columns: str) -> list[tuple[str, str, str]]:
    return [(f"not_null_{c}", "error", bad(f"{c} IS NULL")) for c in columns]


ORACLES["dq_suite"] = suite("crm", [
    *absent("user_id"), ("unique_user_id", "error", repeated("user_id", "crm")),
    ("matches_user_id", "error", bad("NOT regexp_matches(user_id, '^USR-[0-9]{6}$')")),
    ("accepted_range_age", "error", bad("age < 0 OR age > 120")),
    ("accepted_values_customer_segment", "error", bad(f"customer_segment NOT IN ({quoted(C.SEGMENTS)})")),
    ("accepted_values_id_verification_status", "warn",
     bad(f"id_verification_status NOT IN ({quoted(C.KYC_STATUSES)})")),
    ("accepted_range_total_spent_eur", "warn", bad("total_spent_eur < 0")),
    ("consent_after_registration", "warn", bad("gdpr_consent_date < registration_date")),
    ("minor_without_image", "warn", bad("is_minor AND id_document_image_path IS NOT NULL")),
], O.CRM)
ORACLES["dq_payments_suite"] = suite("checked", [
    *absent("transaction_id"), ("unique_transaction_id", "error", repeated("transaction_id", "checked")),
    *absent("user_id", "amount_eur"),
    ("accepted_range_amount_eur", "error", bad("CAST(amount_eur AS DOUBLE) < 0.01 OR amount_eur > 99999")),
    *absent("currency_code"),
    ("accepted_values_currency_code", "error", bad(f"currency_code NOT IN ({quoted(C.CURRENCIES)})")),
    *absent("event_timestamp", "event_date"),
    ("accepted_range_event_hour", "error", bad("hour(event_timestamp) NOT BETWEEN 0 AND 23")),
    ("accepted_values_time_of_day", "error", bad(f"{TIME_OF_DAY} NOT IN ({quoted(C.TIMES_OF_DAY)})")),
    *absent("billing_country_iso"),
    ("length_billing_country_iso", "error", bad("length(billing_country_iso) <> 2")),
    ("length_shipping_country_iso", "error", bad("length(shipping_country_iso) <> 2")),
    ("accepted_values_user_kyc_status", "error", bad(f"user_kyc_status NOT IN ({quoted(C.KYC_STATUSES)})")),
    ("accepted_range_user_age", "error", bad("user_age NOT BETWEEN 0 AND 120")),
    ("not_null_user_txn_count_30d", "error", bad("n30 IS NULL")),
    ("accepted_range_user_txn_count_30d", "error", bad("n30 < 1")),
    ("accepted_range_user_avg_amount_30d", "error", bad(f"{MEAN} < CAST(0.01 AS DOUBLE)")),
    ("accepted_range_user_distinct_countries_30d", "error", bad("countries < 1")),
    ("accepted_range_fraud_score_label", "error", "0"), *absent("ingested_at"),
    ("event_timestamp_between", "error",
     bad(f"event_timestamp < TIMESTAMP '2020-01-01' OR event_timestamp > TIMESTAMP '{B.AS_OF}'")),
    ("not_null_pii_anonymized_at", "warn", "0"), ("not_null_silver_loaded_at", "error", "0"),
    ("column_absent_email", "error", "0"), ("column_absent_first_name", "error", "0"),
    ("column_exists_pii_anonymized_at", "error", "0"),
    ("row_count_between", "error", "CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END"),
    ("max_between_event_timestamp", "error", "CASE WHEN max(event_timestamp) BETWEEN TIMESTAMP '2020-01-01' "
     f"AND TIMESTAMP '{B.AS_OF}' THEN 0 ELSE 1 END"),
], O.FEATURES + f", checked AS (SELECT *, count(DISTINCT billing_country_iso) OVER w AS countries FROM featured {W30})")
ORACLES["dq_sessions_suite"] = suite("sessions", [
    *absent("session_id"), ("unique_session_id", "error", repeated("session_id", "sessions")), *absent("user_id"),
    ("accepted_values_device_category", "error", bad(f"device_category NOT IN ({quoted(C.DEVICE_CATEGORIES)})")),
    ("accepted_values_traffic_source", "error", bad(f"traffic_source NOT IN ({quoted(C.TRAFFIC_SOURCES)})")),
    *absent("session_start", "session_end", "session_date", "session_duration_seconds"),
    ("accepted_range_session_duration_seconds", "error", bad("session_duration_seconds < 2")),
    *absent("total_events"), ("accepted_range_total_events", "error", bad("total_events < 2")),
    ("accepted_range_max_scroll_depth", "error", bad("max_scroll_depth NOT BETWEEN 0 AND 100")),
    *absent("engagement_score"),
    ("accepted_range_engagement_score", "error", bad("engagement_score NOT BETWEEN 0 AND 1")),
    *absent("ingested_at"), ("not_null_silver_loaded_at", "error", "0"),
], O.SESSIONS)
ORACLES["dq_failing_rows"] = f"""WITH {O.CRM}, listed AS (SELECT user_id, concat_ws(',',
  CASE WHEN total_spent_eur < 0 THEN 'accepted_range_total_spent_eur' END,
  CASE WHEN gdpr_consent_date < registration_date THEN 'consent_after_registration' END,
  CASE WHEN is_minor AND id_document_image_path IS NOT NULL THEN 'minor_without_image' END) AS broken_rules FROM crm)
SELECT * FROM listed WHERE broken_rules <> ''"""
ORACLES["dq_duplicates"] = f"""WITH {O.PAYMENTS}
SELECT transaction_id, count(*) AS rows FROM payments_raw GROUP BY ALL HAVING count(*) > 1"""


def fresh(table: str, name: str, warn: int, error: int) -> str:
    return f"""SELECT '{name}' AS source, newest, age_hours, CASE WHEN age_hours > {error} THEN 'error'
  WHEN age_hours > {warn} THEN 'warn' ELSE 'pass' END AS status FROM (
  SELECT max(ingested_at) AS newest, CAST(CAST(epoch(TIMESTAMP '2024-02-29 12:00:00') AS BIGINT)
    - CAST(floor(epoch(max(ingested_at))) AS BIGINT) AS DOUBLE) / 3600.0 AS age_hours FROM {table})"""


ORACLES["dq_freshness"] = f"""WITH {O.PAYMENTS}, {O.CLICKSTREAM}, {O.CRM}
{fresh('payments_raw', 'bronze.payments', 2, 6)} UNION ALL {fresh('clicks', 'bronze.clickstream', 1, 4)}
UNION ALL {fresh('crm', 'bronze.crm', 25, 48)}"""

# Fraud.

AWAY = "shipping_country_iso <> billing_country_iso"
W = fraud.RULE_WEIGHTS
HITS = f"""{O.FEATURES}, wide AS (
  SELECT *, {RATIO} AS amount_vs_avg_ratio, count(DISTINCT billing_country_iso) OVER w AS countries,
    count(*) OVER b AS burst_count, count(DISTINCT merchant_id) OVER b AS burst_merchants
  FROM featured WINDOW w AS (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW),
    b AS (PARTITION BY user_id, ip_address, device_fingerprint ORDER BY sec RANGE BETWEEN 60 PRECEDING AND CURRENT ROW)),
micro AS (
  SELECT transaction_id, ip_address, merchant_id, sec, count(DISTINCT user_id) OVER (
    PARTITION BY ip_address, merchant_id ORDER BY sec RANGE BETWEEN 300 PRECEDING AND CURRENT ROW) AS users
  FROM wide WHERE amount_eur <= 2.99 AND ip_address IS NOT NULL AND merchant_id IS NOT NULL),
hits AS (
  SELECT transaction_id, 'adult_product_minor' AS rule FROM wide WHERE is_adult_product AND user_age < 18
  UNION ALL SELECT transaction_id, 'adult_product_kyc_bypass' FROM wide
    WHERE is_adult_product AND user_age >= 18 AND coalesce(user_kyc_status, 'none') <> 'verified'
  UNION ALL SELECT transaction_id, 'velocity_attack' FROM wide WHERE burst_count >= 4 AND burst_merchants >= 2
  UNION ALL SELECT transaction_id, 'geo_mismatch' FROM wide WHERE ip_geo_mismatch AND {AWAY} AND amount_eur >= 199.99
    AND shipping_country_iso IN ('NG', 'CN', 'RU')
  UNION ALL SELECT transaction_id, 'account_takeover' FROM wide
    WHERE is_new_device AND (ip_geo_mismatch OR {AWAY}) AND amount_vs_avg_ratio > 3
  UNION ALL SELECT transaction_id, 'high_count_30d' FROM wide WHERE n30 > 10
  UNION ALL SELECT transaction_id, 'many_countries_30d' FROM wide WHERE countries > 3
  UNION ALL SELECT transaction_id, 'new_account_high_amount' FROM wide WHERE is_first_transaction AND amount_eur >= 199.99
  UNION ALL SELECT DISTINCT a.transaction_id, 'card_testing' FROM micro a JOIN micro b
    ON a.ip_address = b.ip_address AND a.merchant_id = b.merchant_id AND a.sec BETWEEN b.sec - 300 AND b.sec
    WHERE b.users >= 3)"""
WEIGHT = "CAST(CASE rule " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in W.items()) + " END AS DOUBLE)"
SCORES = f"""{HITS}, rule_scores AS (
  SELECT transaction_id, count(*) AS rules_hit, least(1.0, {rounded(f'max({WEIGHT}) + 0.05 * (count(*) - 1)')})
    AS fraud_probability FROM hits GROUP BY transaction_id),
scores AS (
  SELECT f.transaction_id, user_id, merchant_id, CAST(amount_eur AS DOUBLE) AS amount_eur, billing_country_iso,
    shipping_country_iso, ip_country_code, event_date, event_timestamp,
    coalesce(fraud_probability, 0.0) AS fraud_probability, coalesce(rules_hit, 0) AS rules_hit,
    CASE WHEN coalesce(fraud_probability, 0.0) >= CAST(0.8 AS DOUBLE) THEN 'BLOCK'
      WHEN coalesce(fraud_probability, 0.0) >= 0.5 THEN '3DS_REQUIRED' ELSE 'APPROVED' END AS fraud_decision,
    fraud_label AS confirmed_fraud, amount_eur AS amount_exact
  FROM featured f LEFT JOIN rule_scores r ON f.transaction_id = r.transaction_id)"""
ORACLES["fraud_rules"] = f"WITH {HITS} SELECT transaction_id, rule, {WEIGHT} AS score FROM hits"
ORACLES["rule_score"] = f"WITH {SCORES} SELECT transaction_id, rules_hit, fraud_probability FROM rule_scores"
ORACLES["fact_fraud_scores"] = f"WITH {SCORES} SELECT * EXCLUDE (ip_country_code, amount_exact) FROM scores"
IP_TYPE = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"starts_with(ip_address, '{p}')" for p in ps) + f" THEN '{n}'"
    for n, ps in C.IP_PREFIXES.items()) + " ELSE 'CLEAN' END"
ORACLES["ip_reputation"] = f"""WITH {O.CLEAN}, typed AS (SELECT {IP_TYPE} AS ip_type FROM valid)
SELECT ip_type, ip_type = 'TOR_EXIT' AS is_tor, ip_type = 'VPN_KNOWN' AS is_vpn, ip_type <> 'CLEAN' AS is_suspicious,
  count(*) AS payments FROM typed GROUP BY ALL"""
ORACLES["geo_distance"] = f"WITH {O.CLEAN} SELECT transaction_id, {KM} AS geo_distance_km FROM valid"
ORACLES["country_mismatch"] = f"""WITH {O.CLEAN}, {O.PARCELS},
paid AS (SELECT order_id, min(billing_country_iso) AS billing_country FROM valid GROUP BY order_id),
sent AS (SELECT order_id, arg_max(CASE WHEN is_delayed THEN 'NG' ELSE delivery_country END,
  {{'a': event_ts, 'b': event_id}}) AS delivery_country FROM parcels GROUP BY order_id)
SELECT order_id, billing_country, delivery_country FROM paid JOIN sent USING (order_id)
WHERE billing_country <> delivery_country"""
ORACLES["payment_without_session"] = f"""WITH {O.CLEAN}, {O.SESSIONS}
SELECT transaction_id, user_id FROM valid p WHERE NOT EXISTS (SELECT 1 FROM sessions s WHERE s.user_id = p.user_id
  AND s.session_start <= p.event_timestamp AND s.session_start >= p.event_timestamp - INTERVAL 6 HOURS)"""
ORACLES["decision_mix"] = f"WITH {SCORES} SELECT fraud_decision, count(*) AS payments FROM scores GROUP BY ALL"
ORACLES["score_histogram"] = f"""WITH {SCORES}
SELECT CAST(least(floor(round(CAST(fraud_probability * 10 AS DECIMAL(38,12)), 6)), 9) AS DOUBLE) / 10.0 AS bin,
  count(*) AS payments FROM scores GROUP BY ALL"""
ORACLES["review_queue"] = f"""WITH {SCORES} SELECT transaction_id, user_id, amount_eur, billing_country_iso,
  fraud_probability FROM scores WHERE fraud_decision = 'BLOCK'"""
ORACLES["fraud_monitor"] = f"""WITH {SCORES}, counted AS (SELECT count(*) AS payments,
  count(*) FILTER (fraud_decision = 'BLOCK') AS blocked,
  sum(CAST(round(fraud_probability * 10000) AS BIGINT)) AS points,
  count(*) FILTER (fraud_decision = 'BLOCK' AND NOT confirmed_fraud) AS false_positives,
  CAST(coalesce(sum(amount_exact) FILTER (fraud_decision = 'BLOCK'), 0) AS DOUBLE) AS saved_eur FROM scores)
SELECT payments, blocked, CAST(points AS DOUBLE) / 10000 / payments AS avg_score, {ratio('blocked * 100', 'payments')}
  AS blocked_pct, false_positives, saved_eur FROM counted"""
ORACLES["blocked_trend"] = f"""WITH {SCORES} SELECT event_date, count(*) AS blocked FROM scores
WHERE fraud_decision = 'BLOCK' GROUP BY ALL"""
ORACLES["fraud_alerts"] = f"""WITH {SCORES} SELECT transaction_id, fraud_probability, fraud_decision FROM scores
WHERE fraud_probability >= CAST(0.8 AS DOUBLE)"""
ORACLES["blocked_per_hour"] = f"""WITH {SCORES} SELECT date_trunc('hour', event_timestamp) AS hour, count(*) AS blocked
FROM scores WHERE fraud_decision = 'BLOCK' GROUP BY ALL HAVING count(*) > 50"""
ORACLES["distance_vs_score"] = f"""WITH {SCORES}, placed AS (SELECT transaction_id, {KM} AS geo_distance_km,
  fraud_probability FROM scores) SELECT * FROM placed WHERE geo_distance_km IS NOT NULL"""

# Clickstream reports.

STEPS = C.FUNNEL_STEPS
ORACLES["funnel_steps"] = f"""WITH {O.CLICKSTREAM}, """ + ", ".join(
    f"s{i} AS (SELECT c.session_id, min(c.event_timestamp) AS since FROM clicks c "
    + (f"JOIN s{i - 1} p ON c.session_id = p.session_id AND c.event_timestamp >= p.since " if i else "")
    + f"WHERE c.page = '{s}' AND c.event_timestamp IS NOT NULL AND c.session_id IS NOT NULL GROUP BY c.session_id)" for i, s in enumerate(STEPS)
) + ", totals AS (SELECT " + ", ".join(f"(SELECT count(*) FROM s{i}) AS n{i}" for i in range(len(STEPS))) + """)
""" + " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INTEGER) AS step_no, '{s}' AS step, n{i} AS sessions, "
    f"{ratio(f'n{i}', f'n{i - 1}') if i else 'CAST(1.0 AS DOUBLE)'} AS step_conversion FROM totals"
    for i, s in enumerate(STEPS))
ORACLES["abandonment"] = f"""WITH {O.CLICKSTREAM}, flags AS (SELECT session_id, bool_or(event_type = 'cart_add') AS cart,
  bool_or(page = 'order_confirmation') AS ordered FROM clicks GROUP BY session_id)
SELECT count(*) FILTER (cart) AS cart_sessions, count(*) FILTER (cart AND NOT ordered) AS abandoned_sessions,
  {ratio('count(*) FILTER (cart AND NOT ordered)', 'count(*) FILTER (cart)')} AS abandonment_rate FROM flags"""
ORACLES["attribution"] = f"""WITH {O.CLICKSTREAM}, firsts AS (SELECT session_id,
  arg_min(coalesce(referrer, 'direct'), {{'a': event_timestamp, 'b': event_id}}) AS source,
  bool_or(page = 'checkout_start') AS converted FROM clicks GROUP BY session_id)
SELECT source, count(*) AS sessions, count(*) FILTER (converted) AS conversions,
  {ratio('count(*) FILTER (converted)', 'count(*)')} AS conversion_rate FROM firsts GROUP BY source"""
ORACLES["cart_without_view"] = f"""WITH {O.CLICKSTREAM}
SELECT session_id, count(*) FILTER (event_type = 'cart_add') AS cart_adds,
  count(*) FILTER (page = 'product_detail') AS product_views FROM clicks GROUP BY session_id
HAVING cart_adds > 0 AND product_views = 0"""
ORACLES["multi_device_users"] = f"""WITH {O.CLICKSTREAM}
SELECT user_id, count(DISTINCT device_type) AS devices FROM clicks GROUP BY user_id HAVING devices > 1"""
ORACLES["bot_rate"] = f"""WITH {O.CLICKSTREAM}
SELECT event_date, count(*) AS events, count(*) FILTER (is_bot_suspected) AS bot_events,
  {ratio('count(*) FILTER (is_bot_suspected)', 'count(*)')} AS bot_rate FROM clicks_typed GROUP BY event_date"""
ORACLES["kyc_events"] = f"""WITH {O.CLICKSTREAM}
SELECT user_id, {', '.join(f"count(*) FILTER (event_type = '{e}') AS {e}" for e in C.KYC_EVENTS)},
  {ratio("count(*) FILTER (event_type = 'id_verification_success')",
         "count(*) FILTER (event_type = 'id_verification_started')")} AS success_rate
FROM clicks WHERE event_type IN ({quoted(C.KYC_EVENTS)}) GROUP BY user_id"""

# Logistics.

PARCELS = O.LOGISTICS + """, timed AS (
  SELECT *, CAST(date_diff('day', order_ts, delivered_ts) AS INTEGER) AS delivery_days FROM parcels)"""
DAYS = "CAST(sum(delivery_days) AS DOUBLE) / nullif(count(delivery_days), 0)"
ORACLES["carrier_kpis"] = f"""WITH {PARCELS}
SELECT carrier, count(*) AS parcels, count(*) FILTER (is_delayed) AS delayed, {DAYS} AS avg_delivery_days,
  {ratio('sum(CAST(round(shipping_cost_eur * 100) AS BIGINT)) * 10', 'sum(CAST(round(weight_kg * 1000) AS BIGINT))')}
  AS cost_per_kg, {ratio('count(*) FILTER (is_delayed)', 'count(*)')} AS delay_rate FROM timed GROUP BY carrier"""
ORACLES["zone_delays"] = f"""WITH {PARCELS}
SELECT delivery_country, product_category_id, count(*) AS parcels, count(*) FILTER (is_delayed) AS delayed,
  {ratio('count(*) FILTER (is_delayed)', 'count(*)')} AS delay_rate FROM timed GROUP BY 1, 2"""
ORACLES["delay_reasons"] = f"""WITH {PARCELS} SELECT delay_reason, count(*) AS parcels FROM timed WHERE is_delayed
GROUP BY ALL"""
ORDER = "{'a': event_ts, 'b': event_id}"
ORACLES["critical_stock"] = f"""WITH {PARCELS}
SELECT warehouse_id, arg_max(stock_level, {ORDER}) AS stock_level, max(event_ts) AS seen_at FROM timed
GROUP BY warehouse_id HAVING arg_max(stock_level, {ORDER}) = 'critical'"""
ORACLES["status_latest"] = f"""WITH {PARCELS}
SELECT order_id, arg_max(status, {ORDER}) AS status, max(event_ts) AS status_at, count(*) AS events
FROM timed GROUP BY order_id"""
ORACLES["status_transitions"] = f"""WITH {PARCELS}, stepped AS (
  SELECT event_id, order_id, event_ts AS event_timestamp, status, lag(status) OVER w AS came_from,
    CASE WHEN step < 8 THEN step END AS now_step, lag(CASE WHEN step < 8 THEN step END) OVER w AS was_step FROM timed
  WINDOW w AS (PARTITION BY order_id ORDER BY event_ts, event_id))
SELECT event_id, order_id, event_timestamp, status, came_from, coalesce(now_step >= was_step, true) AS is_legal
FROM stepped"""
ORACLES["delivery_sla"] = f"""WITH {PARCELS}
SELECT count(*) AS parcels, count(delivery_days) AS delivered, {DAYS} AS avg_delivery_days,
  count(*) FILTER (delivery_days > 5) AS late,
  {ratio('count(*) FILTER (delivery_days <= 3) * 100', 'count(delivery_days)')} AS within_3_days_pct,
  {ratio("count(*) FILTER (status = 'returned') * 100", 'count(*)')} AS return_pct FROM timed"""
ORACLES["status_funnel"] = f"""WITH {PARCELS} SELECT status, count(DISTINCT order_id) AS orders FROM timed
WHERE status IN ('order_placed', 'shipped', 'delivered', 'returned') GROUP BY status"""
MONTHS = ", ".join(
    f"CAST(sum(delivery_days) FILTER (month(order_ts) = {m}) AS DOUBLE) / nullif(count(*) "
    f"FILTER (month(order_ts) = {m}), 0) AS m{m:02d}" for m in range(1, 13))
ORACLES["delivery_matrix"] = f"""WITH {PARCELS} SELECT delivery_country, {MONTHS} FROM timed
WHERE delivery_days IS NOT NULL GROUP BY delivery_country"""
ORACLES["returns_trend"] = f"""WITH {PARCELS} SELECT CAST(event_ts AS DATE) AS day, count(*) AS returns FROM timed
WHERE status = 'returned' GROUP BY ALL"""

# Commercial reports.

ORACLES["bi_revenue"] = f"""WITH {FACTS}
SELECT CAST(sum(amount_eur) AS DOUBLE) AS revenue_eur, count(DISTINCT user_id) AS active_customers, count(*) AS orders,
  CAST(sum(amount_eur) AS DOUBLE) / count(*) AS avg_basket_eur FROM facts"""
ORACLES["bi_mom"] = f"""WITH monthly AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue_eur FROM orders GROUP BY 1),
paired AS (SELECT m.*, p.revenue_eur AS previous_eur FROM monthly m
  LEFT JOIN monthly p ON m.month = p.month + INTERVAL 1 MONTH)
SELECT *, {ratio('revenue_eur - previous_eur', 'previous_eur')} AS growth FROM paired"""
ORACLES["bi_retention"] = f"""WITH {FACTS}, most AS (SELECT user_id, max(n30) AS most FROM facts GROUP BY user_id)
SELECT count(*) FILTER (most > 1) AS retained, count(*) AS active,
  {ratio('count(*) FILTER (most > 1)', 'count(*)')} AS retention_rate FROM most"""
ORACLES["bi_top10"] = f"""WITH {FACTS}, best AS (SELECT merchant_id, sum(amount_eur) AS revenue, count(*) AS orders
  FROM facts GROUP BY merchant_id ORDER BY revenue DESC, merchant_id LIMIT 10)
SELECT merchant_id, s_name AS merchant_name, r_name AS region, orders, CAST(revenue AS DOUBLE) AS revenue_eur FROM best
JOIN supplier ON merchant_id = 'MERCH-' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0')
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
ORACLES["bi_category"] = f"""WITH {FACTS} SELECT category_id, risk_category, count(*) AS orders,
  CAST(sum(amount_eur) AS DOUBLE) AS revenue_eur FROM facts GROUP BY 1, 2"""
ORACLES["bi_country"] = f"""WITH {FACTS} SELECT billing_country_iso, count(*) AS orders,
  count(DISTINCT user_id) AS customers FROM facts GROUP BY 1"""
ORACLES["bi_vip"] = f"""WITH {FACTS} SELECT user_id, count(*) AS orders, CAST(sum(amount_eur) AS DOUBLE) AS revenue_eur,
  CAST(sum(amount_eur) AS DOUBLE) / count(*) AS avg_basket_eur FROM facts WHERE customer_segment = 'vip' GROUP BY 1"""

# Identity documents.

DOCS = f"""texts AS (SELECT c_custkey AS doc_id, {O.USER.format('c_custkey')} AS user_id,
  unnest(string_split('NOM : DUPONT 1 PRENOM : Jean ' || CASE WHEN c_custkey % 13 = 0 THEN 'illisible'
    WHEN c_custkey % 17 = 0 THEN '32/13/2000'
    ELSE strftime(DATE '2024-03-01' - CAST((c_custkey % 60 + 5) * 365 + 40 AS INTEGER), '%d/%m/%Y') END
    || ' N° ' || lpad(CAST(c_custkey * 104729 AS VARCHAR), 12, '1'), ' ')) AS word,
  generate_subscripts(string_split('NOM : DUPONT 1 PRENOM : Jean x N° y', ' '), 1) - 1 AS seq FROM customer),
words AS (SELECT *, CAST(CASE WHEN (doc_id + seq) % 9 = 0 THEN -1 ELSE (doc_id * 13 + seq * 5) % 71 + 30 END AS INTEGER)
  AS conf FROM texts),
docs AS (SELECT doc_id, user_id, coalesce(string_agg(word, ' ' ORDER BY seq) FILTER (conf > 40), '') AS text,
  coalesce(CAST(sum(conf) FILTER (conf <> -1) AS DOUBLE) / nullif(count(*) FILTER (conf <> -1), 0), 0.0) AS confidence
  FROM words GROUP BY 1, 2),
found AS (SELECT *, nullif(regexp_extract(text, '{C.NAME_PATTERN}', 1), '') AS raw_name,
  nullif(trim(regexp_extract(text, '{C.GIVEN_NAME_PATTERN}', 1)), '') AS given,
  translate(nullif(regexp_extract(text, '{C.BIRTH_DATE_PATTERN}', 1), ''), ' /', '..') AS birth_date_text,
  nullif(regexp_extract(text, '{C.CARD_NUMBER_PATTERN}', 1), '') AS number FROM docs),
dated AS (SELECT *, CAST(try_strptime(birth_date_text, '%d.%m.%Y') AS DATE) AS birth_date FROM found),
aged AS (SELECT *, CAST(date_diff('day', birth_date, DATE '2024-03-01') // 365 AS INTEGER) AS age FROM dated),
judged AS (SELECT *, coalesce(age < 18, false) AS is_minor, birth_date IS NOT NULL AS success,
  CASE WHEN age < 18 THEN 'restrict_account' WHEN confidence < 60 OR birth_date IS NULL THEN 'manual_review'
    ELSE 'none' END AS action_required FROM aged),
checked_docs AS (SELECT *, CASE WHEN NOT success THEN 'failed' WHEN action_required = 'none' THEN 'verified'
  WHEN action_required = 'restrict_account' THEN 'restricted' ELSE 'manual_review' END AS kyc_decision FROM judged)"""
ORACLES["kyc_extract"] = f"""WITH {DOCS}
SELECT doc_id, user_id, text, confidence, upper(trim(raw_name)) AS last_name, birth_date_text,
  upper(substr(given, 1, 1)) || lower(substr(given, 2)) AS first_name, birth_date,
  {token(C.CARD_TOKEN, 'number', 16)} AS card_number_hash, age, is_minor, success,
  CASE WHEN birth_date_text IS NOT NULL AND birth_date IS NULL THEN 'invalid date: ' || birth_date_text END
    AS error_message, action_required, kyc_decision FROM checked_docs"""
ORACLES["kyc_counters"] = f"""WITH {DOCS}
SELECT count(*) AS processed, count(*) FILTER (success) AS success,
  count(*) FILTER (action_required = 'restrict_account') AS restricted,
  count(*) FILTER (action_required = 'manual_review') AS manual_review FROM checked_docs"""
ORACLES["kyc_updates"] = f"""WITH {O.CRM}, {DOCS}
SELECT crm.user_id, kyc_decision AS id_verification_status FROM crm JOIN checked_docs ON crm.user_id = checked_docs.user_id
WHERE kyc_decision <> id_verification_status"""
ORACLES["kyc_status_lookup"] = f"""WITH {O.CRM}, asked AS (SELECT DISTINCT CASE WHEN o_totalprice < 5000 THEN 'USR-UNKNOWN'
  ELSE {O.USER.format('o_custkey')} END AS asked_id FROM orders)
SELECT asked_id AS user_id, coalesce(id_verification_status, 'pending') AS kyc_status,
  CASE WHEN age IS NULL THEN NULL WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35' WHEN age <= 50 THEN '36-50'
    WHEN age <= 65 THEN '51-65' ELSE '65+' END AS age_group,
  coalesce(id_verification_status, '') = 'restricted' AS is_minor,
  coalesce(id_verification_status, '') IN ('restricted', 'rejected') AS account_restricted
FROM asked LEFT JOIN crm ON asked_id = user_id"""

# Model.

ORACLES["class_balance"] = f"""WITH {LABELLED}
SELECT count(*) FILTER (NOT is_fraud) AS negatives, count(*) FILTER (is_fraud) AS positives,
  {ratio('count(*) FILTER (NOT is_fraud)', 'count(*) FILTER (is_fraud)')} AS positive_weight FROM labelled"""
ORACLES["ml_split"] = f"""WITH {LABELLED}, coded AS (
  SELECT CAST(is_fraud AS DOUBLE) AS label, md5('42|' || CAST(is_fraud AS INTEGER) || '|' || transaction_id) AS digest
  FROM labelled)
SELECT label, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % 100 < 20 AS is_test, count(*) AS payments
FROM coded GROUP BY ALL"""
ORACLES["ml_time_split"] = f"""WITH {LABELLED}, parts AS (
  SELECT date_diff('day', feature_date, DATE '2024-03-01') AS age FROM labelled)
SELECT CASE WHEN age < 0 THEN NULL WHEN age < 7 THEN 'validation' WHEN age < 37 THEN 'train' END AS part,
  count(*) AS payments FROM parts GROUP BY 1"""
ORACLES["ml_gate"] = f"""WITH {SCORES}, counted AS (SELECT
  count(*) FILTER (fraud_probability >= 0.5 AND confirmed_fraud) AS tp,
  count(*) FILTER (fraud_probability >= 0.5 AND NOT confirmed_fraud) AS fp,
  count(*) FILTER (fraud_probability < 0.5 AND confirmed_fraud) AS fn,
  count(*) FILTER (fraud_probability < 0.5 AND NOT confirmed_fraud) AS tn FROM scores)
SELECT *, {ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'tp + fn')} AS recall,
  {ratio('tp * 2', 'tp * 2 + fp + fn')} AS f1_score, {ratio('tp + fn', 'tp + fp + fn + tn')} AS fraud_rate_test,
  coalesce({ratio('tp * 2', 'tp * 2 + fp + fn')} >= CAST(0.9 AS DOUBLE), false) AS promoted FROM counted"""

# Streams: what the closed windows and the whole input give.

ORACLES["stream_bronze"] = f"""WITH {O.CLICKSTREAM}, flagged AS (
  SELECT *, kafka_offset % 11 = 0 OR kafka_offset % 10 = 0 AS _parse_error FROM clicks)
SELECT kafka_offset, user_id AS kafka_key, _parse_error, CASE WHEN NOT _parse_error THEN event_id END AS event_id
FROM flagged"""
ORACLES["stream_dedup"] = "SELECT event_id, ts, user_id FROM events"
ORACLES["stream_velocity"] = """WITH spread AS (
  SELECT user_id, date_trunc('minute', ts) - to_minutes(i) AS window_start
  FROM events, (SELECT unnest(range(0, 5)) AS i))
SELECT window_start, window_start + INTERVAL 5 MINUTES AS window_end, user_id, count(*) AS events FROM spread
GROUP BY ALL"""
ORACLES["stream_velocity_exact"] = """SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) AS velocity FROM events"""
ORACLES["stream_sessions"] = ORACLES["session_gap_30m"]
PURCHASES = """purchases AS (SELECT *, least(value / 100, 1.0) AS fraud_probability FROM events
  WHERE event_type = 'purchase'),
decided AS (SELECT *, CASE WHEN fraud_probability >= CAST(0.8 AS DOUBLE) THEN 'BLOCK' WHEN fraud_probability >= 0.5
  THEN '3DS_REQUIRED' ELSE 'APPROVED' END AS fraud_decision FROM purchases)"""
ORACLES["stream_alerts"] = f"""WITH {PURCHASES} SELECT event_id, user_id, fraud_probability, fraud_decision FROM decided
WHERE fraud_probability >= CAST(0.8 AS DOUBLE)"""
ORACLES["stream_blocked_hourly"] = f"""WITH {PURCHASES} SELECT date_trunc('hour', ts) AS hour, count(*) AS blocked
FROM decided WHERE fraud_decision = 'BLOCK' GROUP BY 1 HAVING count(*) > 1"""

# Scoring from messages: every micro-batch holds a third of the time of delivery, and each its newest versions.

RULE_SCORES = f"""{HITS}, row_scores AS (
  SELECT transaction_id, count(*) AS rules_hit, least(1.0, {rounded(f'max({WEIGHT}) + 0.05 * (count(*) - 1)')})
    AS fraud_probability FROM hits WHERE rule <> 'card_testing' GROUP BY transaction_id)"""
ORACLES["stream_score"] = f"""WITH {RULE_SCORES}
SELECT {MONTH.replace('transaction_id', 'f.transaction_id', 1)}, n5 AS velocity_count_5min, is_first_transaction,
  count(DISTINCT billing_country_iso) OVER w AS user_distinct_countries_30d,
  count(DISTINCT merchant_id) OVER w AS user_distinct_merchants_30d,
  coalesce(rules_hit, 0) AS rules_hit, coalesce(fraud_probability, 0.0) AS fraud_probability,
  CASE WHEN coalesce(fraud_probability, 0.0) >= CAST(0.8 AS DOUBLE) THEN 'BLOCK'
    WHEN coalesce(fraud_probability, 0.0) >= 0.5 THEN '3DS_REQUIRED' ELSE 'APPROVED' END AS fraud_decision
FROM featured f LEFT JOIN row_scores r ON f.transaction_id = r.transaction_id {W30}"""
BATCHED = """, payments_batched AS (
  SELECT r.*, least(2, (CAST(floor(epoch(ingested_at)) AS BIGINT) - lo) * 3 // (hi - lo + 1)
    + CASE WHEN CAST(substr(order_id, 5) AS BIGINT) % 11 = 0 THEN 1 ELSE 0 END) AS batch_id FROM payments_raw r,
    (SELECT CAST(floor(epoch(min(ingested_at))) AS BIGINT) AS lo, CAST(floor(epoch(max(ingested_at))) AS BIGINT) AS hi
     FROM payments_raw)), payments_ranked AS ("""
TAKEN = O.CLEAN.replace(", payments_ranked AS (", BATCHED, 1).replace("FROM payments_raw),\npayments_clean", "FROM payments_batched),\npayments_clean", 1).replace(
    "OVER (PARTITION BY transaction_id\n", "OVER (PARTITION BY transaction_id, batch_id\n", 1) + """, ends AS (
  SELECT batch_id, max(event_timestamp) FILTER (reject_reason IS NULL) AS newest FROM payments_judged GROUP BY 1),
marked AS (SELECT p.*, coalesce(event_timestamp < (SELECT max(newest) FROM ends e WHERE e.batch_id < p.batch_id)
  - INTERVAL 10 MINUTES, false) AS is_late FROM payments_judged p)"""
ORACLES["stream_late_rows"] = f"WITH {TAKEN} SELECT transaction_id, event_timestamp, batch_id FROM marked WHERE is_late"
ORACLES["stream_progress"] = f"""WITH {TAKEN}, came AS (SELECT batch_id, count(*) AS rows_in FROM payments_batched GROUP BY 1)
SELECT batch_id, any_value(rows_in) AS rows_in, CAST(0 AS BIGINT) AS unreadable,
  count(*) FILTER (reject_reason IS NULL) AS valid, count(*) FILTER (reject_reason IS NOT NULL) AS rejected,
  count(*) FILTER (is_late) AS late FROM marked JOIN came USING (batch_id) GROUP BY batch_id"""

# Stored tables.

ORACLES["upsert_on_disk"] = """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus = 'P' THEN '1999-01' ELSE strftime(o_orderdate, '%Y-%m') END AS month
FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 10 = 0)"""
ORACLES["upsert_changed_partitions"] = f"""WITH after AS ({ORACLES["upsert_on_disk"]}),
touched AS (SELECT strftime(o_orderdate, '%Y-%m') AS month FROM orders
    WHERE o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderkey % 10 = 0)
  UNION SELECT '1999-01' WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P'))
SELECT month, month NOT IN (SELECT month FROM after) AS gone FROM touched"""
ORACLES["fact_orders_incremental"] = ORACLES["fact_orders"]

# Claims of documents and the training job.

ORACLES["document_claims"] = f"""WITH files AS (
  SELECT {O.USER.format('c_custkey')} || '/id.jpg' AS path, c_custkey * 7919 % 997 AS at_s FROM customer),
ranked AS (SELECT path, row_number() OVER (ORDER BY at_s, path) AS place FROM files),
taken AS (SELECT path, CASE WHEN place <= 50 THEN 'run-1' WHEN place <= 100 THEN 'run-4' WHEN place <= 150 THEN 'run-3'
  WHEN place <= 170 THEN 'run-4' END AS run FROM ranked)
SELECT path, run, CASE run WHEN 'run-1' THEN 'done' ELSE 'claimed' END AS state,
  CASE run WHEN 'run-1' THEN TIMESTAMP '2024-03-01 01:00:00' WHEN 'run-3' THEN TIMESTAMP '2024-03-01 06:00:00'
    ELSE TIMESTAMP '2024-03-01 09:00:00' END AS claimed_at,
  CASE run WHEN 'run-1' THEN TIMESTAMP '2024-03-01 01:30:00' END AS finished_at, DATE '2024-03-01' AS claimed_on
FROM taken WHERE run IS NOT NULL"""
NUMBERS = {"txn_count_5min": "n5", "txn_count_1h": "n60", "txn_count_30d": "n30", "avg_amount_30d": MEAN,
           "amount_vs_avg_ratio": RATIO, "amount_stddev_30d": STD}
ORACLES["ml_medians"] = f"WITH {LABELLED} " + " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(v) AS rows, median(v) AS median FROM (SELECT CAST({sql} AS DOUBLE) AS v FROM labelled)"
    for name, sql in NUMBERS.items())
ORACLES["ml_codes"] = f"WITH {LABELLED}, seen AS (" + " UNION ".join(
    f"SELECT '{c}' AS name, coalesce({c}, 'unknown') AS value FROM labelled" for c in C.CATEGORICAL_FEATURES) + """)
SELECT name, value, CAST(row_number() OVER (PARTITION BY name ORDER BY value) AS INTEGER) AS code FROM seen"""
ORACLES["ml_parts"] = f"""WITH {LABELLED}, coded AS (
  SELECT CAST(is_fraud AS DOUBLE) AS label, CAST('0x' || substr(md5('42|' || CAST(is_fraud AS INTEGER) || '|' || transaction_id),
    1, 8) AS BIGINT) % 100 AS bucket FROM labelled)
SELECT label, CASE WHEN bucket < 15 THEN 'test' WHEN bucket < 30 THEN 'validation' ELSE 'train' END AS part,
  count(*) AS payments FROM coded GROUP BY ALL"""
CURVE = f"""{SCORES}, counted AS (
  SELECT fraud_probability AS threshold, count(*) FILTER (confirmed_fraud) AS new_hits, count(*) AS new_rows FROM scores
  WHERE confirmed_fraud IS NOT NULL GROUP BY 1),
curve AS (SELECT *, sum(new_hits) OVER w AS hits, sum(new_rows) OVER w AS flagged, sum(new_hits) OVER () AS positives,
  sum(new_rows) OVER () AS total FROM counted WINDOW w AS (ORDER BY threshold DESC))"""
ORACLES["ml_precision_recall"] = f"""WITH {CURVE}
SELECT threshold, CAST(flagged AS BIGINT) AS flagged, CAST(hits AS BIGINT) AS hits,
  round(hits::DOUBLE / flagged, 6) AS precision, round(hits::DOUBLE / nullif(positives, 0), 6) AS recall FROM curve"""
ORACLES["ml_ranking_metrics"] = f"""WITH {CURVE},
pairs AS (SELECT sum(CASE WHEN a.fraud_probability > b.fraud_probability THEN 1.0::DOUBLE
    WHEN a.fraud_probability = b.fraud_probability THEN 0.5::DOUBLE ELSE 0 END * a.n * b.n) AS won
  FROM (SELECT fraud_probability, count(*) AS n FROM scores WHERE confirmed_fraud GROUP BY 1) a,
    (SELECT fraud_probability, count(*) AS n FROM scores WHERE NOT confirmed_fraud GROUP BY 1) b)
SELECT round(sum(new_hits::DOUBLE / positives * hits / flagged), 6) AS average_precision,
  round(any_value(won) / any_value(positives * (total - positives))::DOUBLE, 6) AS roc_auc FROM curve, pairs"""
ORACLES["dq_stored_failures"] = f"""SELECT rule, failed AS rows FROM ({ORACLES["dq_payments_suite"]})
WHERE failed > 0 AND NOT regexp_matches(rule, '^(column_|row_count|max_between|unique_)')"""
ORACLES["dq_stored_results"] = ORACLES["dq_payments_suite"]
