"""Clickstream typing and the sessions table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake import schemas
from bazaarlake.functions import scalars as S
from bazaarlake.functions.ranking import dedup_latest
from bazaarlake.functions.timeline import gap_sessions, previous


def exact_device(device: Column) -> Column:
    return F.when(device.startswith("mobile"), "mobile").when(device.startswith("tablet"), "tablet").otherwise("desktop")


def exact_browser(device: Column) -> Column:
    return (
        F.when(device.contains("chrome"), "chrome").when(device.contains("firefox"), "firefox")
        .when(device.contains("safari"), "safari").otherwise("other")
    )


def exact_source(referrer: Column) -> Column:
    return (
        F.when(referrer == "google.com", "organic_search").when(referrer == "facebook.com", "social")
        .when(referrer == "email_campaign", "email").when(referrer == "direct", "direct").otherwise("other")
    )


def loose_device(device: Column) -> Column:
    return exact_device(F.lower(device))


def loose_browser(agent: Column, strict: bool = False) -> Column:
    """Browser from the user agent. `strict` looks for Edge first, because its agent text also names Chrome."""
    agent = F.lower(agent)
    plain = (
        F.when(agent.contains("chrome"), "chrome").when(agent.contains("firefox"), "firefox")
        .when(agent.contains("safari"), "safari").when(agent.contains("edge"), "edge").otherwise("other")
    )
    return F.when(agent.contains("edg/") | agent.contains("edge"), "edge").otherwise(plain) if strict else plain


def loose_source(referrer: Column) -> Column:
    return (
        F.when(referrer.contains("google") | referrer.contains("bing"), "organic_search")
        .when(referrer.contains("facebook") | referrer.contains("instagram") | referrer.contains("tiktok"), "social")
        .when(referrer == "email_campaign", "email")
        .when((referrer == "direct") | referrer.isNull(), "direct")
        .otherwise("referral")
    )


def canonical_type(event_type: Column, page: Column) -> Column:
    """One event vocabulary: page views of a product or of the checkout get their own type."""
    return (
        F.when((event_type == "page_view") & (page == "product_detail"), "product_view")
        .when((event_type == "page_view") & (page == "checkout_start"), "checkout_start")
        .when(event_type == "cart_add", "add_to_cart")
        .otherwise(event_type)
    )


def measured_or_special() -> Column:
    """Drop events shorter than two seconds and page views without a duration; special events carry none."""
    return (F.col("duration_seconds") >= C.MIN_EVENT_SECONDS) | (
        F.col("duration_seconds").isNull() & (F.col("event_type") != "page_view"))


def latest_events(df: DataFrame) -> DataFrame:
    order = [F.col(c).desc() for c in ("ingested_at", "kafka_partition", "kafka_offset") if c in df.columns]
    return dedup_latest(df.filter(F.col("event_id").isNotNull()), ["event_id"], order)


def clean_events(df: DataFrame) -> DataFrame:
    """The event-level table: typed, classified by exact values, last version of each event, no bots."""
    at = S.parse_timestamp(F.col("timestamp"))
    typed = df.withColumns({
        "event_timestamp": at, "event_date": F.to_date(at),
        "duration_seconds": F.col("duration_seconds").try_cast("int"),
        "scroll_depth_pct": F.col("scroll_depth_pct").try_cast("int"),
        "device_category": exact_device(F.col("device_type")),
        "browser": exact_browser(F.col("device_type")),
        "traffic_source": exact_source(F.col("referrer")),
    })
    return latest_events(typed).filter(measured_or_special()).drop(
        "kafka_offset", "kafka_partition", "kafka_topic", "year", "month", "day", "timestamp")


def normalise(df: DataFrame, strict_browser: bool = False) -> DataFrame:
    """Events as the session table reads them: canonical type, loose classification, cart value."""
    return df.withColumns({
        "event_timestamp": S.parse_timestamp(F.col("timestamp")),
        "canonical_type": canonical_type(F.col("event_type"), F.col("page")),
        "device_category": loose_device(F.col("device_type")),
        "browser": loose_browser(F.col("user_agent"), strict_browser),
        "traffic_source": loose_source(F.col("referrer")),
        "cart_value_eur": F.when(F.col("event_type") == "cart_add", F.col("product_price") * F.col("quantity")),
    }).filter(measured_or_special() & F.col("session_id").isNotNull() & F.col("event_id").isNotNull())


def engagement(conversion: Column, carts: Column, product_views: Column, page_views: Column) -> Column:
    return (
        F.when(conversion, 1.0).when(carts > 0, 0.7).when(product_views > 2, 0.4).when(page_views > 1, 0.2)
        .otherwise(0.0)
    )


def aggregate(events: DataFrame) -> DataFrame:
    """One row per session in one pass, with map-side combine.

    Entry and exit pages come from min_by/max_by instead of a second window over the events. A session id used by
    several users keeps the first one and is flagged.
    """
    order = F.struct("event_timestamp", "event_id")
    kind = F.col("canonical_type")

    def count(name: str) -> Column:
        return F.count_if(kind == name)

    def mean(name: str) -> Column:
        return F.sum(name).cast("double") / F.nullif(F.count(name), F.lit(0)).cast("double")

    return events.groupBy("session_id").agg(
        F.min_by("user_id", order).alias("user_id"),
        (F.min("user_id") != F.max("user_id")).alias("is_multi_user"),
        F.max("device_category").alias("device_category"),
        F.max("browser").alias("browser"),
        F.max("traffic_source").alias("traffic_source"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        (F.unix_timestamp(F.max("event_timestamp")) - F.unix_timestamp(F.min("event_timestamp")))
        .alias("session_duration_seconds"),
        F.to_date(F.min("event_timestamp")).alias("session_date"),
        F.count(F.lit(1)).alias("total_events"),
        count("page_view").alias("page_views"),
        count("product_view").alias("product_views"),
        count("add_to_cart").alias("add_to_cart_count"),
        count("remove_from_cart").alias("remove_from_cart_count"),
        count("checkout_start").alias("checkout_starts"),
        count("wishlist_add").alias("wishlist_adds"),
        F.count_distinct("product_id").alias("unique_products_viewed"),
        F.count_distinct("category_id").alias("unique_categories_viewed"),
        F.max("scroll_depth_pct").alias("max_scroll_depth"),
        mean("scroll_depth_pct").alias("avg_scroll_depth"),
        mean("duration_seconds").alias("avg_page_duration_seconds"),
        F.max("cart_value_eur").alias("max_cart_value_eur"),
        F.coalesce(F.bool_or(kind == "checkout_start"), F.lit(False)).alias("has_conversion"),
        F.coalesce(F.bool_or("is_adult_product"), F.lit(False)).alias("contains_adult_products"),
        F.min_by("page", order).alias("entry_page"),
        F.max_by("page", order).alias("exit_page"),
        F.max("ingested_at").alias("ingested_at"),
    )


def build(bronze: DataFrame, loaded_at, min_events: int = C.MIN_SESSION_EVENTS,
          min_seconds: int = C.MIN_SESSION_SECONDS, strict_browser: bool = False) -> DataFrame:
    """The sessions table: kept sessions, engagement score, contract columns plus the multi-user flag."""
    sessions = aggregate(normalise(latest_events(bronze), strict_browser))
    kept = sessions.filter(
        (F.col("total_events") >= min_events) & (F.col("session_duration_seconds") >= min_seconds))
    scored = kept.withColumns({
        "engagement_score": engagement(F.col("has_conversion"), F.col("add_to_cart_count"), F.col("product_views"),
                                       F.col("page_views")),
        "silver_loaded_at": S.as_timestamp(loaded_at),
    })
    return scored.select(*schemas.SILVER_SESSIONS_COLUMNS, "is_multi_user")


def touched_sessions(bronze: DataFrame, as_of, lookback_days: int = 3) -> DataFrame:
    """All events of every session that has an event in the lookback, so no session is rebuilt from a part."""
    recent = S.parse_timestamp(F.col("timestamp")) >= F.date_sub(S.as_day(as_of), lookback_days).cast("timestamp")
    ids = bronze.filter(recent).select("session_id").distinct()
    return bronze.join(ids, "session_id", "left_semi")


def entry_exit(events: DataFrame) -> DataFrame:
    order = F.struct("event_timestamp", "event_id")
    return events.groupBy("session_id").agg(
        F.min_by("page", order).alias("entry_page"), F.max_by("page", order).alias("exit_page"))


def sessionise(events: DataFrame, key: str, at: str, gap_seconds: int, **routing) -> DataFrame:
    """Sessions by inactivity gap for events without a session id: one row per key and session."""
    timed = events.withColumn("_micros", F.unix_micros(at))
    opened = gap_sessions(timed, key, "_micros", gap_seconds * 1_000_000, **routing)
    return opened.groupBy(key, "session_open").agg(
        F.min(at).alias("session_start"), F.max(at).alias("session_end"), F.count(F.lit(1)).alias("total_events"),
    ).drop("session_open")


def previous_event_gap(events: DataFrame, key: str, at: str, tie: str, **options) -> DataFrame:
    """Seconds since the key's previous event."""
    timed = events.withColumn("_micros", F.unix_micros(at))
    out = previous(timed, key, "_micros", tie, at, "_before", 86_400_000_000, **options)
    return out.withColumn("gap_seconds", F.unix_timestamp(at) - F.unix_timestamp("_before")).drop("_micros", "_before")
