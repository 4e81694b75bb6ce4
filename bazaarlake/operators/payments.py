"""Payments: typing, latest version, validity split, behavioural features, the curated table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake import schemas
from bazaarlake.functions import scalars as S
from bazaarlake.functions.ranking import dedup_latest
from bazaarlake.functions.skew import ALL, HOT_ROWS, cut, hot_keys, none_hot, routed
from bazaarlake.functions.timeline import trailing

DAY = 86_400
MONTH = 30 * DAY
INGEST_COLUMNS = ["kafka_topic", "kafka_key", "kafka_partition", "kafka_offset", "year", "month", "day", "timestamp"]


def derive(df: DataFrame) -> DataFrame:
    """What follows from the typed columns of the same row."""
    hour = F.col("event_hour")
    return df.withColumn("event_hour", F.hour("event_timestamp")).withColumns({
        "event_date": F.to_date("event_timestamp"),
        "event_day_of_week": F.dayofweek("event_timestamp"),
        "time_of_day": F.when(hour.isNotNull(), S.time_of_day(hour)),
        "is_cross_border": F.col("billing_country_iso") != F.col("shipping_country_iso"),
        "ip_geo_mismatch": F.col("ip_country_code") != F.col("billing_country_iso"),
        "user_is_minor": F.col("user_age") < 18,
    })


def clean(df: DataFrame) -> DataFrame:
    """Typed and normalised columns; nothing is filtered and no value can fail the job."""
    at = S.parse_timestamp(F.col("timestamp"))
    typed = df.withColumns({
        "event_timestamp": at,
        "amount": F.col("amount").try_cast("double"),
        "amount_eur": F.abs(F.col("amount").try_cast("double")).try_cast("decimal(12,2)"),
        "currency_code": F.coalesce(F.upper(F.trim("currency")), F.lit("EUR")),
        "billing_country_iso": F.upper(F.trim("billing_country")),
        "shipping_country_iso": F.upper(F.trim("shipping_country")),
        "ip_country_code": F.upper(F.trim("ip_country_inferred")),
    })
    return derive(typed).withColumns({
        "fraud_label": S.optional(df, "fraud_label_ground_truth", "boolean"),
        "fraud_type": F.nullif(S.optional(df, "fraud_scenario_label", "string"), F.lit("none")),
    }).drop(*INGEST_COLUMNS)


def latest(df: DataFrame, whole: bool = False) -> DataFrame:
    """The last delivered version of each transaction. Rows without an id cannot be versions of anything.

    Run it on the raw rows, before `clean`: old versions are then never parsed. `whole` says that all columns will be
    read: those that do not choose the version then travel as one, copied at once.
    """
    chooses = [c for c in ("ingested_at", "kafka_partition", "kafka_offset") if c in df.columns]
    rest = [c for c in df.columns if c not in ("transaction_id", *chooses)] if whole else []
    rows = df.filter(F.col("transaction_id").isNotNull())
    if rest:
        rows = rows.select("transaction_id", *chooses, F.struct(*rest).alias("_rest"))
    kept = dedup_latest(rows, ["transaction_id"], [F.col(c).desc() for c in chooses])
    return kept.select(*[F.col(f"_rest.{c}") if c in rest else c for c in df.columns]) if rest else kept


def reject_reason() -> Column:
    """First rule that the row breaks, NULL for a valid row. Every NULL input breaks a rule, so no row is lost."""
    return (
        F.when(F.col("transaction_id").isNull(), "missing_transaction")
        .when(F.col("user_id").isNull(), "missing_user")
        .when(F.col("amount").isNull() | F.col("amount_eur").isNull(), "missing_amount")
        .when((F.col("amount") <= 0) | (F.col("amount_eur") <= 0), "amount_not_positive")
        .when(~F.coalesce(F.col("currency_code").isin(C.CURRENCIES), F.lit(False)), "currency_not_supported")
        .when(F.col("event_timestamp").isNull(), "bad_timestamp")
    )


def is_valid() -> Column:
    """True where `reject_reason` is NULL, and never true elsewhere; each input is looked at once."""
    return (
        F.col("transaction_id").isNotNull() & F.col("user_id").isNotNull() & (F.col("amount") > 0) & (F.col("amount_eur") > 0)
        & F.col("currency_code").isin(C.CURRENCIES) & F.col("event_timestamp").isNotNull()
    )


def judge(df: DataFrame) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason())


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with `reject_reason`): two narrow filters on one parent, no shuffle."""
    judged = judge(df)
    return judged.filter(is_valid()), judged.filter(F.col("reject_reason").isNotNull())


def validity_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("reject_reason").isNull()).alias("valid_rows"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected_rows"),
    )


def convert(df: DataFrame, rates: DataFrame) -> DataFrame:
    """`amount_eur` through a daily rate table (currency_code, rate_date, rate); unknown rates leave NULL."""
    return (
        df.join(rates.select("currency_code", F.col("rate_date").alias("event_date"), "rate"),
                ["currency_code", "event_date"], "left")
        .withColumn("amount_eur", F.when(F.col("currency_code") == "EUR", F.col("amount_eur"))
                    .otherwise((F.col("amount_eur") * F.col("rate")).cast("decimal(12,2)")))
        .drop("rate")
    )


def trailing_month(df: DataFrame, distinct: dict[str, str] | None = None, **routing) -> DataFrame:
    """Count, mean, sample deviation and current-to-mean ratio of `amount_eur` over the last 30 days per user.

    Sums run over whole cents, so the result does not depend on the order of additions.
    """
    cents = F.col("_cents")
    prepared = df.withColumns({
        "_cents": (F.col("amount_eur") * 100).cast("bigint"), "_second": F.unix_timestamp("event_timestamp"),
    })
    summed = trailing(
        prepared, "user_id", "_second", MONTH,
        {"_n": F.lit(1), "_sum": cents, "_squares": cents.cast("decimal(19,0)") * cents.cast("decimal(19,0)")},
        distinct, **routing,
    )
    n, total = F.col("_n").cast("double"), F.col("_sum").cast("double")
    spread = (F.col("_n") * F.col("_squares") - F.col("_sum") * F.col("_sum")).cast("double")
    mean = total / 100 / n
    return summed.withColumns({
        "user_txn_count_30d": F.col("_n").cast("bigint"),
        "user_avg_amount_30d": mean,
        "user_amount_stddev_30d": F.when(F.col("_n") > 1, S.round_to(F.sqrt(spread / (n * (n - 1))) / 100)),
        "amount_vs_avg_ratio": S.safe_divide(F.col("amount_eur"), mean),
    }).drop("_n", "_sum", "_squares", "_cents", "_second")


def velocity(df: DataFrame, seconds: int, name: str, **routing) -> DataFrame:
    """Payments of the same user in the last `seconds`, the current one included, to the microsecond.

    The microseconds stay if they are there already as `_micros`.
    """
    prepared = df if "_micros" in df.columns else df.withColumn("_micros", F.unix_micros("event_timestamp"))
    counted = trailing(prepared, "user_id", "_micros", seconds * 1_000_000, {name: F.lit(1)},
                       chunk=DAY * 1_000_000, **routing)
    return counted.withColumn(name, F.col(name).cast("bigint")).drop(*[c for c in ["_micros"] if c not in df.columns])


def first_transaction(df: DataFrame, **routing) -> DataFrame:
    """Flag each user's earliest payment of all time; the id breaks ties.

    A heavy user is not gathered: the minimum is found by partial aggregation and compared back on the id.
    """
    key = F.struct("event_timestamp", "transaction_id")

    def plain(frame: DataFrame) -> DataFrame:
        # Without order the window runs on the rows as the earlier windows left them; with `_micros` it is the window of
        # `velocity`, and the earliest payment is the smallest up to any row.
        whole = Window.partitionBy("user_id")
        first = F.min(key).over(whole.orderBy("_micros").rangeBetween(Window.unboundedPreceding, 0)
                                if "_micros" in frame.columns else whole)
        return frame.withColumn("is_first_transaction", first["transaction_id"] == F.col("transaction_id"))

    def heavy(frame: DataFrame) -> DataFrame:
        firsts = frame.groupBy("user_id").agg(F.min(key).alias("_first")).select(
            F.col("_first.transaction_id").alias("transaction_id"), F.lit(True).alias("is_first_transaction"))
        return frame.join(firsts, "transaction_id", "left").withColumn(
            "is_first_transaction", F.coalesce("is_first_transaction", F.lit(False)))

    return routed(df, "user_id", plain, heavy, **routing)


WINDOWED = ["transaction_id", "user_id", "event_timestamp", "amount_eur", "billing_country_iso", "merchant_id"]


def features(df: DataFrame, hot: list | str, whole: bool = False) -> DataFrame:
    """The features with a given route: `[]` for ordinary users, `ALL` for heavy ones.

    Ordinary users' rows are moved once and before anything is derived from them, so that only what is derived from is moved.
    `whole` says that all columns will be read: those that no window reads then travel as one, copied at once.
    """
    routing = {"hot": hot}
    ordinary, columns = hot == [], df.columns
    rest = [c for c in columns if c not in WINDOWED] if whole and ordinary else []
    if rest:
        df = df.select(*WINDOWED, F.struct(*rest).alias("_rest"))
    if ordinary:
        df, routing["lies"] = df.repartition("user_id"), "user_id"
    out = trailing_month(df, {"user_distinct_countries_30d": "billing_country_iso",
                              "user_distinct_merchants_30d": "merchant_id"}, **routing)
    if ordinary:
        out = out.withColumn("_micros", F.unix_micros("event_timestamp"))
    out = first_transaction(velocity(out, 300, "velocity_count_5min", hot=hot), hot=hot).drop("_micros")
    if rest:
        made = [c for c in out.columns if c not in df.columns]
        out = out.select(*[F.col(f"_rest.{c}") if c in rest else c for c in columns], *made)
    return out


def enrich(df: DataFrame, hot: DataFrame | list | None = None, min_rows: int = HOT_ROWS, whole: bool = False) -> DataFrame:
    """All behavioural features of valid payments. Heavy users are searched once and split off once."""
    keys = hot_keys(df.select("user_id"), "user_id", min_rows) if hot is None else hot
    if none_hot(keys):
        return features(df, [], whole)
    light, heavy = cut(df, "user_id", keys)
    return features(light, [], whole).unionByName(features(heavy, ALL))


def beside(df: DataFrame, read: list[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`step` over `df`, of whose columns it reads `read` only: the others travel as one struct, copied at once."""
    rest = [c for c in df.columns if c not in read]
    if not rest:
        return step(df)
    out = step(df.select(*[c for c in df.columns if c in read], F.struct(*rest).alias("_beside")))
    made = [c for c in out.columns if c not in df.columns and c != "_beside"]
    return out.select(*[F.col(f"_beside.{c}") if c in rest else c for c in df.columns], *made)


DERIVED = ["event_hour", "event_date", "event_day_of_week", "time_of_day", "is_cross_border", "ip_geo_mismatch", "user_is_minor"]


def carried(df: DataFrame) -> list[str]:
    """The columns of valid payments that `curated` reads, without those that it derives."""
    wanted = {*schemas.SILVER_PAYMENTS_COLUMNS, *schemas.SILVER_PAYMENTS_EXTRA, *WINDOWED, "ip_country_code", "user_age",
              "fraud_label", "quantity"} - {*DERIVED, "reject_reason"}
    return [c for c in df.columns if c in wanted]


def curated(df: DataFrame, loaded_at) -> DataFrame:
    """The public columns of the payments table, in contract order; addresses and devices stay out.

    What follows from other columns of a row is derived here again, so that the windows before need not carry it.
    """
    df = derive(df)
    kinds = {
        "order_id": "string", "is_new_card": "boolean", "fraud_score_label": "double", "geo_distance_km": "double",
        "pii_anonymized_at": "timestamp", "quantity": "int", "product_id": "string",
    }
    km = S.country_distance_km(F.col("ip_country_code"), F.col("shipping_country_iso"))
    derived = {
        "geo_distance_km": S.round_to(km, 1), "blocked": F.coalesce("fraud_label", F.lit(False)),
        "status": F.when(F.coalesce("fraud_label", F.lit(False)), "blocked").otherwise("success"),
        "silver_loaded_at": S.as_timestamp(loaded_at),
        "quantity": F.coalesce(S.optional(df, "quantity", "int"), F.lit(1)),
    }
    if "reject_reason" in df.columns:
        derived["reject_reason"] = F.when(derived["blocked"], "fraud_detected")
    columns = schemas.SILVER_PAYMENTS_COLUMNS + schemas.SILVER_PAYMENTS_EXTRA
    return df.select(*[
        (derived[c] if c in derived else S.optional(df, c, kinds[c]) if c in kinds else F.col(c)).alias(c)
        for c in columns
    ])


# The columns of a raw message that the curated table is made of.
_RAW = ["transaction_id", "user_id", "amount", "currency", "payment_method", "product_id", "billing_country",
        "shipping_country", "ip_country_inferred", "is_new_merchant", "user_kyc_status", "user_age", "timestamp", "merchant_id",
        "fraud_label_ground_truth", "fraud_scenario_label", "order_id", "quantity", "ingested_at", "kafka_partition",
        "kafka_offset"]


def build(bronze: DataFrame, loaded_at, hot: DataFrame | list | None = None, min_rows: int = HOT_ROWS) -> DataFrame:
    """The curated table. Heavy users are searched in one column of the raw rows, which hold all valid ones.

    All that the table is made of is read, and nothing else is moved.
    """
    wanted = {*_RAW, *schemas.SILVER_PAYMENTS_COLUMNS, *schemas.SILVER_PAYMENTS_EXTRA}
    keys = hot_keys(bronze.select("user_id"), "user_id", min_rows) if hot is None else hot
    valid, _ = split(clean(latest(bronze.select(*[c for c in bronze.columns if c in wanted]), whole=True)))
    rows = enrich(valid.select(*carried(valid)), hot=keys, whole=True)
    return curated(rows.withColumn("reject_reason", F.lit(None).cast("string")), loaded_at)


def refresh(history: DataFrame, new: DataFrame, withdrawn: DataFrame | None = None, older: DataFrame | None = None,
            then: Callable[[DataFrame], DataFrame] | None = None, **options) -> DataFrame:
    """Features of the new payments and of the older ones that they change: equal to a full rebuild on those rows.

    A payment at t changes the features of the same user's payments in [t, t + 30 days], which in turn read the 30
    days before them. A replaced version changes those of its own user and time as well, and so does a payment in
    `withdrawn` (transaction_id), which is valid no more. So only the users of new and of replaced rows are read, from
    30 days before the first of these; of what is older only its existence matters, for the first-payment flag. Both
    inputs are valid, deduplicated payments without features; the result is an upsert set by transaction_id.

    `history` may leave out what is older than 30 days before all of these rows if `older` names the users (user_id)
    that have payments there. `then` adds columns that also need the earlier payments beside a row.
    """
    ids = new.select("transaction_id")
    if withdrawn is not None:
        ids = ids.union(withdrawn.select("transaction_id")).distinct()
    place = ["user_id", "event_timestamp"]
    replaced = history.join(ids, "transaction_id", "left_semi").select(*place)
    starts = new.select(*place).union(replaced).groupBy("user_id").agg(F.min("event_timestamp").alias("_from"))
    touched = history.join(starts, "user_id").join(ids, "transaction_id", "left_anti")
    reach = F.col("event_timestamp") >= F.col("_from") - F.expr("INTERVAL 30 DAYS")
    featured = enrich(touched.filter(reach).drop("_from").unionByName(new, allowMissingColumns=True), **options)
    featured = then(featured) if then else featured
    before = touched.filter(~reach).select("user_id")
    seen = (before if older is None else before.union(older.select("user_id"))).distinct().withColumn(
        "_seen_before", F.lit(True))
    marks = starts.join(seen, "user_id", "left")
    return (
        featured.join(marks, "user_id").filter(F.col("event_timestamp") >= F.col("_from"))
        .withColumn("is_first_transaction", F.col("is_first_transaction") & F.col("_seen_before").isNull())
        .drop("_from", "_seen_before")
    )
