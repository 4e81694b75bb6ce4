"""Identity checks from recognised document text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import constants as C
from bazaarlake.functions import scalars as S


def assemble(words: DataFrame) -> DataFrame:
    """(doc_id, user_id, text, confidence): words above the confidence limit in reading order, mean over all words.

    Layout rows (confidence -1) count for neither. A document holds a page of words, so the list stays small.
    """
    real = F.col("conf") != -1
    kept = F.sort_array(F.collect_list(
        F.when(real & (F.col("conf") > C.WORD_MIN_CONFIDENCE), F.struct("seq", "word"))))
    return words.groupBy("doc_id", "user_id").agg(
        F.array_join(F.transform(kept, lambda w: w["word"]), " ").alias("text"),
        F.coalesce(F.sum(F.when(real, F.col("conf"))).cast("double") / F.nullif(F.count_if(real), F.lit(0)),
                   F.lit(0.0)).alias("confidence"),
    )


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def capitalise(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.expr("substring(_given, 2)")))


def extract(documents: DataFrame, as_of, strict: bool = False) -> DataFrame:
    """Fields, age, decision and outcome per document text.

    `strict` anchors the surname to a word start, so it is not found inside the label of the given name.
    """
    name = (r"\b" if strict else "") + C.NAME_PATTERN
    text = F.col("text")
    found = documents.withColumns({
        "last_name": F.upper(F.trim(_found(text, name))),
        "_given": F.trim(_found(text, C.GIVEN_NAME_PATTERN)),
        "birth_date_text": F.translate(_found(text, C.BIRTH_DATE_PATTERN), " /", ".."),
        "_number": _found(text, C.CARD_NUMBER_PATTERN),
    }).withColumns({
        "first_name": capitalise(F.col("_given")),
        "birth_date": F.to_date(F.try_to_timestamp(F.col("birth_date_text"), F.lit("dd.MM.yyyy"))),
        "card_number_hash": F.when(F.col("_number").isNotNull(), S.sha_prefix(C.CARD_TOKEN, F.col("_number"), 16)),
    }).withColumn("age", F.floor(F.datediff(S.as_day(as_of), "birth_date") / 365).cast("int"))
    minor = F.coalesce(F.col("age") < 18, F.lit(False))
    return found.withColumns({
        "is_minor": minor,
        "success": F.col("birth_date").isNotNull(),
        "error_message": F.when(F.col("birth_date_text").isNotNull() & F.col("birth_date").isNull(),
                                F.concat(F.lit("invalid date: "), "birth_date_text")),
        "action_required": F.when(minor, "restrict_account")
        .when((F.col("confidence") < C.DOCUMENT_MIN_CONFIDENCE) | F.col("birth_date").isNull(), "manual_review")
        .otherwise("none"),
    }).withColumn("kyc_decision", outcome(F.col("success"), F.col("action_required"))).drop("_given", "_number")


def outcome(success: Column, action: Column) -> Column:
    return (
        F.when(~success, "failed").when(action == "none", "verified")
        .when(action == "restrict_account", "restricted").when(action == "manual_review", "manual_review")
        .otherwise("failed")
    )


def counters(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("processed"), F.count_if("success").alias("success"),
        F.count_if(F.col("action_required") == "restrict_account").alias("restricted"),
        F.count_if(F.col("action_required") == "manual_review").alias("manual_review"),
    )


def updates(crm: DataFrame, results: DataFrame, decided_at: str | None = None) -> DataFrame:
    """Customers whose status changes with their latest result: the incoming side of an upsert by user."""
    last = results.groupBy("user_id").agg(F.max_by("kyc_decision", F.struct("doc_id")).alias("_decision"))
    return crm.join(last, "user_id").filter(
        F.col("_decision") != F.coalesce("id_verification_status", F.lit(""))
    ).withColumn("id_verification_status", F.col("_decision")).drop("_decision")


def status_lookup(requests: DataFrame, crm: DataFrame) -> DataFrame:
    """Identity status per requested user; an unknown user is pending."""
    known = crm.select("user_id", F.col("id_verification_status").alias("_status"), F.col("age").alias("_age"))
    return requests.select("user_id").distinct().join(known, "user_id", "left").select(
        "user_id", F.coalesce("_status", F.lit("pending")).alias("kyc_status"),
        S.model_age_group(F.col("_age")).alias("age_group"),
        (F.coalesce("_status", F.lit("")) == "restricted").alias("is_minor"),
        F.coalesce("_status", F.lit("")).isin("restricted", "rejected").alias("account_restricted"),
    )
