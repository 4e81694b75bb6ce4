"""Column expressions. Everything here stays inside whole-stage code generation."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import constants as C


def as_timestamp(value: datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def as_day(value: date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def optional(df: DataFrame, name: str, kind: str) -> Column:
    """The column `name` if the frame has it, else a typed NULL."""
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def round_to(value: Column, digits: int = 4) -> Column:
    """Decimal half-up rounding of a double, independent of binary noise beyond 12 digits."""
    return F.round(value.cast("decimal(38,12)"), digits).cast("double")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is 0 or NULL, else the ratio rounded to 4 digits."""
    return round_to(numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0)))


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 text with or without fraction and zone; NULL instead of an error for anything else."""
    return F.try_to_timestamp(text)


def ticks(df: DataFrame, column: str) -> Column:
    """A whole number that orders like the column: microseconds of a timestamp, else the number itself."""
    kind = dict(df.dtypes)[column]
    return F.unix_micros(column) if kind == "timestamp" else F.col(column).cast("bigint")


def surrogate_key(*columns: Column | str, missing: str = "_null_") -> Column:
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(missing)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def sha_prefix(label: str, text: Column, length: int) -> Column:
    return F.concat(F.lit(label), F.substring(F.sha2(text, 256), 1, length))


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour.between(0, 6), "night")
        .when(hour.between(7, 12), "morning")
        .when(hour.between(13, 18), "afternoon")
        .otherwise("evening")
    )


def age_group(age: Column) -> Column:
    """Bands of the customer dimension; an unknown age falls into the last band."""
    return (
        F.when(age < 18, "minor")
        .when(age < 25, "18-24")
        .when(age < 35, "25-34")
        .when(age < 50, "35-49")
        .otherwise("50+")
    )


def model_age_group(age: Column) -> Column:
    """Bands of the model; they differ from the dimension's."""
    return (
        F.when(age.isNull(), None)
        .when(age <= 25, "18-25")
        .when(age <= 35, "26-35")
        .when(age <= 50, "36-50")
        .when(age <= 65, "51-65")
        .otherwise("65+")
    )


def decide(probability: Column) -> Column:
    return (
        F.when(probability >= C.BLOCK_AT, "BLOCK")
        .when(probability >= C.CHALLENGE_AT, "3DS_REQUIRED")
        .otherwise("APPROVED")
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    inner = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Rounding may push the value just above 1; `least` would also turn an unknown place into a distance.
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(F.when(inner > 1.0, 1.0).otherwise(inner)))


def lookup(mapping: dict[str, float], key: Column) -> Column:
    """Number for a word from a small fixed table, as a literal map without a join. NULL for an unknown word."""
    entries = ", ".join(f"'{word}', {float(number)}D" for word, number in mapping.items())
    return F.try_element_at(F.expr(f"map({entries})"), F.coalesce(key, F.lit("")))


def country_distance_km(country_a: Column, country_b: Column) -> Column:
    lat = {k: v[0] for k, v in C.CENTROIDS.items()}
    lon = {k: v[1] for k, v in C.CENTROIDS.items()}
    return haversine_km(
        lookup(lat, country_a), lookup(lon, country_a), lookup(lat, country_b), lookup(lon, country_b),
    )
