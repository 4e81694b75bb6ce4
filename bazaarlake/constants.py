"""Fixed values that results depend on: word lists, thresholds, patterns and formats."""

# Enumerations.
CURRENCIES = ["EUR", "USD", "GBP", "CHF", "JPY", "CAD", "AUD"]
KYC_STATUSES = ["verified", "pending", "none", "rejected", "expired"]
SEGMENTS = ["vip", "gold", "silver", "bronze", "new"]
TIMES_OF_DAY = ["night", "morning", "afternoon", "evening"]
DEVICE_CATEGORIES = ["mobile", "tablet", "desktop"]
TRAFFIC_SOURCES = ["organic_search", "social", "email", "direct", "referral"]

# Order status flow, then exceptions.
STATUS_FLOW = [
    "order_placed", "payment_confirmed", "warehouse_processing", "ready_for_pickup",
    "shipped", "in_transit", "out_for_delivery", "delivered",
]
STATUS_EXCEPTIONS = ["delayed", "delivery_failed", "return_requested", "returned"]

# Shopping funnel, in order.
FUNNEL_STEPS = [
    "homepage", "category_listing", "product_detail", "cart_add", "checkout_start",
    "checkout_payment", "order_confirmation",
]

# Identity events.
KYC_EVENTS = [
    "age_gate_shown", "adult_content_blocked", "id_verification_started",
    "id_verification_failed", "id_verification_success",
]

# Thresholds.
BLOCK_AT = 0.80
CHALLENGE_AT = 0.50
ALERT_AT = 0.80
PROMOTE_F1 = 0.90
MIN_EVENT_SECONDS = 2
MIN_SESSION_EVENTS = 2
MIN_SESSION_SECONDS = 2
LATE_DAYS = 5
FAST_DAYS = 3
BLOCKED_PER_HOUR = 50
CARD_TEST_MAX = 2.99
GEO_MISMATCH_MIN = 199.99
TAKEOVER_RATIO = 3.0
VELOCITY_MIN_COUNT = 4
VELOCITY_SECONDS = 60
CARD_TEST_USERS = 3
CARD_TEST_SECONDS = 300
COUNT_30D_LIMIT = 10
COUNTRIES_30D_LIMIT = 3
RISKY_DESTINATIONS = ["NG", "CN", "RU"]
RETENTION_HOURS = 72
UPLOAD_MAX_BYTES = 10 * 1024 * 1024

# Privacy formats.
EMAIL_TOKEN = "HASHED_"
PHONE_TOKEN = "TOK_PHONE_"
ERASED_TOKEN = "ERASED_"
CARD_TOKEN = "SHA256_"
MASK_EMAIL = "<EMAIL>"
MASK_PHONE = "<TEL>"
MASK_CARD = "<CARD>"
MASK_IP = "<IP>"

# Patterns of recognised identity documents.
NAME_PATTERN = r"(?:NOM|Nom)\s*[:;]?\s*([A-ZÉÈÊËÀÂÙÛÎ][A-ZÉÈÊËÀÂÙÛÎ\s-]+)"
GIVEN_NAME_PATTERN = r"(?:PRENOM|Prénom|PRÉNOM)\s*[:;]?\s*([A-ZÉÈÊËÀÂÙÛÎ][a-zA-Zéèê\s-]+)"
BIRTH_DATE_PATTERN = r"(\d{2}[./\s]\d{2}[./\s]\d{4})"
CARD_NUMBER_PATTERN = r"(?:N°|No|Numéro)?\s*([0-9A-Z]{12,15})"
WORD_MIN_CONFIDENCE = 40
DOCUMENT_MIN_CONFIDENCE = 60

# Reputation of address prefixes.
IP_PREFIXES = {
    "TOR_EXIT": ["185.220.101.", "185.220.100.", "185.107.57.", "193.32.161."],
    "RUSSIA": ["91.108.", "185.234.218.", "194.87.216.", "185.185.68."],
    "NIGERIA": ["197.210.", "41.203.", "196.216.", "154.118."],
    "CHINA": ["218.2.", "222.85.", "61.177.", "116.31."],
    "DATACENTER": ["45.152.66.", "194.165.16.", "23.95.97.", "162.33.177."],
    "VPN_KNOWN": ["104.234.220.", "192.241.154.", "45.33.32.", "139.59.1."],
}

# Country centroids (latitude, longitude), rounded to whole degrees.
CENTROIDS = {
    "FR": (46.0, 2.0), "BE": (51.0, 4.0), "CH": (47.0, 8.0), "DE": (51.0, 9.0), "IT": (43.0, 13.0),
    "ES": (40.0, -4.0), "NL": (52.0, 6.0), "LU": (50.0, 6.0), "PT": (39.0, -8.0), "GB": (54.0, -2.0),
    "US": (38.0, -97.0), "CA": (60.0, -95.0), "RU": (60.0, 100.0), "CN": (35.0, 105.0), "NG": (10.0, 8.0),
    "BR": (-10.0, -55.0), "VN": (16.0, 106.0), "JP": (36.0, 138.0), "AU": (-27.0, 133.0), "SE": (62.0, 15.0),
    "NO": (62.0, 10.0), "DK": (56.0, 10.0), "FI": (64.0, 26.0), "AT": (47.0, 13.0), "IE": (53.0, -8.0),
}

# Model features.
NUMERIC_FEATURES = [
    "txn_count_5min", "txn_count_1h", "txn_count_30d", "avg_amount_30d",
    "amount_vs_avg_ratio", "amount_stddev_30d", "geo_distance_km",
]
CATEGORICAL_FEATURES = [
    "kyc_status", "age_group", "risk_category", "category_id",
    "payment_method", "billing_country_iso", "shipping_country_iso",
]
BINARY_FEATURES = [
    "is_cross_border", "user_is_minor", "is_first_transaction",
    "is_new_card", "is_new_merchant", "ip_geo_mismatch",
]
