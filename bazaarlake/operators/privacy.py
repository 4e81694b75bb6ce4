"""Pseudonymisation, masking, leak checks and erasure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import constants as C
from bazaarlake.functions import scalars as S

# Patterns of personal data in free text.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IBAN = r"\b([A-Z]{2}[0-9]{2}[A-Z0-9]{1,20})[A-Z0-9]{10}\b"
CARD = r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b"
IPV4 = r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"
PHONE = r"(\+|\b0)[0-9]{1,3}[ .-]?[0-9]{1,4}([ .-]?[0-9]{2,4}){2,4}\b"
# What a text must hold before a number pattern can match: a cheap scan that spares most texts the full patterns.
NUMBER_HINT = r"[0-9]{2}|[0-9]\.[0-9]"
MASKS = [(EMAIL, C.MASK_EMAIL), (IBAN, "$1**********"), (CARD, C.MASK_CARD), (IPV4, C.MASK_IP), (PHONE, C.MASK_PHONE)]


def mask_text(text: Column) -> Column:
    """Mask e-mail, IBAN (last ten characters), card, IPv4 and phone over the whole text, in this order."""
    (mail, mail_mask), *numbers = MASKS
    text = F.when(text.contains("@"), F.regexp_replace(text, mail, mail_mask)).otherwise(text)
    masked = text
    for pattern, replacement in numbers:
        masked = F.regexp_replace(masked, pattern, replacement)
    return F.when(text.rlike(NUMBER_HINT), masked).otherwise(text)


def pseudonymise(df: DataFrame, salt: str, as_of, version: str = "native-1") -> DataFrame:
    """Apply each privacy rule whose column is present; direct names are dropped."""
    out = df
    if "email" in df.columns:
        token = S.sha_prefix(C.EMAIL_TOKEN, F.concat(F.lower(F.trim("email")), F.lit(salt)), 16)
        out = out.withColumn("email_hashed", token)
    if "phone" in df.columns:
        out = out.withColumn("phone_token", S.sha_prefix(C.PHONE_TOKEN, F.concat("phone", F.lit(salt)), 8))
    if "postal_code" in df.columns:
        out = out.withColumn("postal_zone", F.concat(F.substring("postal_code", 1, 4), F.lit("0")))
    if "notes" in df.columns:
        out = out.withColumn("notes", mask_text(F.col("notes")))
    return out.drop("email", "phone", "postal_code", "first_name", "last_name").withColumns({
        "pii_anonymized_at": S.as_timestamp(as_of), "pii_anonymization_version": F.lit(version),
    })


def leak_check(df: DataFrame, key: str) -> DataFrame:
    """(column, leaking_rows, first_key) for every text column that still shows an e-mail: one pass."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != key]
    counts = [F.count_if(F.col(c).rlike(EMAIL)).alias(f"n{i}") for i, c in enumerate(texts)]
    firsts = [F.min(F.when(F.col(c).rlike(EMAIL), F.col(key))).alias(f"k{i}") for i, c in enumerate(texts)]
    one_row = df.agg(*counts, *firsts)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("leaking_rows"), F.col(f"k{i}").alias("first_key"))
            for i, c in enumerate(texts)]
    return one_row.select(F.inline(F.array(*rows)))


def pseudonym(user: Column, salt: str) -> Column:
    return S.sha_prefix(C.ERASED_TOKEN, F.concat(user, F.lit(salt)), 16)


def erase(tables: dict[str, DataFrame], requests: DataFrame, salt: str, as_of) -> tuple[dict[str, DataFrame], DataFrame]:
    """Replace the users of `requests` in every table that has `user_id`; return the tables and a receipt per user.

    Direct tokens become the pseudonym and `customer_key` is derived anew, so the old key no longer links.
    """
    wanted = requests.select("user_id").filter(F.col("user_id").isNotNull()).distinct().withColumn(
        "_pseudonym", pseudonym(F.col("user_id"), salt))
    erased, counts = {}, wanted
    for name, df in tables.items():
        hit = F.col("_pseudonym").isNotNull()
        changed = df.join(wanted, "user_id", "left")
        fresh = {c: F.when(hit, F.col("_pseudonym")).otherwise(F.col(c))
                 for c in ("email_hashed", "phone_token") if c in df.columns}
        if "customer_key" in df.columns:
            fresh["customer_key"] = F.when(hit, S.surrogate_key("_pseudonym")).otherwise(F.col("customer_key"))
        fresh["user_id"] = F.coalesce("_pseudonym", "user_id")
        erased[name] = changed.withColumns(fresh).select(*df.columns)
        per_user = df.join(wanted, "user_id", "left_semi").groupBy("user_id").agg(
            F.count(F.lit(1)).alias(f"{name}_rows"))
        counts = counts.join(per_user, "user_id", "left").withColumn(
            f"{name}_rows", F.coalesce(f"{name}_rows", F.lit(0)).cast("bigint"))
    total = sum((F.col(f"{n}_rows") for n in tables), F.lit(0))
    receipts = counts.select(
        F.col("_pseudonym").alias("pseudonym"), *[f"{n}_rows" for n in tables],
        (total > 0).alias("found"), S.as_timestamp(as_of).alias("erased_at"),
    )
    return erased, receipts


def minors_with_image(crm: DataFrame) -> DataFrame:
    """Minors must not have a stored document image."""
    return crm.filter(F.col("is_minor") & F.col("id_document_image_path").isNotNull())


def consent_before_registration(crm: DataFrame) -> DataFrame:
    return crm.filter(F.col("gdpr_consent_date") < F.col("registration_date"))
