"""Names, descriptions, actions and analyst rows for predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventward import catalog
from eventward.functions import messages
from eventward.functions.values import (
    clean_columns,
    directory_path,
    display_fields,
    fallback_description,
)
from eventward.schema import EVENT_COLUMNS


def enrich_predictions(df: DataFrame) -> DataFrame:
    """Add technique, tactic name and description. The lookups are fixed tables of under 40 rows."""
    spark = df.sparkSession
    return (
        df.drop("predicted_technique")
        .join(F.broadcast(catalog.technique_table(spark)), "predicted_label", "left")
        .join(F.broadcast(catalog.tactic_name_table(spark)), "predicted_tactic", "left")
        .join(F.broadcast(catalog.description_table(spark)), "predicted_label", "left")
        .withColumn(
            "description", F.coalesce("known_description", fallback_description(F.col("predicted_label")))
        )
        .drop("known_description")
    )


def recommended_actions(df: DataFrame) -> DataFrame:
    """Add `actions`: first steps by label, none for benign rows or unknown labels."""
    none = F.array().cast("array<string>")
    actions = F.when(F.col("is_attack"), F.coalesce("known_actions", none)).otherwise(none)
    return (
        df.join(F.broadcast(catalog.action_table(df.sparkSession)), "predicted_label", "left")
        .withColumn("actions", actions)
        .drop("known_actions")
    )


def severity() -> Column:
    return F.when(F.col("is_attack"), F.lit("critical")).otherwise(F.lit("info"))


def clean_rows(df: DataFrame) -> DataFrame:
    return df.select(*clean_columns(df))


def analyst_rows(df: DataFrame) -> DataFrame:
    """One row per scored event in the form an analyst view shows."""
    raw_columns = clean_columns(df.select(*[c for c in EVENT_COLUMNS if c in df.columns]))

    def percent(column: str) -> Column:
        return F.round(F.col(column) * 100, 1)

    def shown(column: str, default: str) -> Column:
        return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))

    return df.select(
        F.col("ord").cast("string").alias("id"),
        F.coalesce(F.date_format("timestamp", "HH:mm:ss"), F.lit("")).alias("time"),
        directory_path("computer").alias("dn"),
        shown("computer", catalog.UNKNOWN_HOST).alias("host"),
        shown("subject_user_name", "SYSTEM").alias("user"),
        F.col("event_id").alias("eventId"),
        F.col("predicted_label").alias("technique"),
        shown("predicted_tactic", catalog.BENIGN_TACTIC).alias("tacticKey"),
        F.col("predicted_technique").alias("mitre"),
        percent("stage1_confidence").alias("stage1"),
        percent("stage2_confidence").alias("stage2"),
        severity().alias("severity"),
        display_fields(df).alias("fields"),
        F.to_json(F.struct(*raw_columns), {"ignoreNullFields": "false"}).alias("raw"),
    )


def with_analysis(df: DataFrame) -> DataFrame:
    """Prompt for attacks, fixed explanation for benign rows, and the recommended actions."""
    attack = F.col("is_attack")
    return recommended_actions(df).withColumns(
        {
            "prompt": F.when(attack, messages.analyze_prompt()),
            "explanation": F.when(~attack, F.lit(catalog.BENIGN_EXPLANATION)),
        }
    )


def with_question(df: DataFrame, question: str | Column) -> DataFrame:
    return df.withColumn("prompt", messages.ask_prompt(question))


def with_report_prompt(df: DataFrame) -> DataFrame:
    attack = F.col("is_attack")
    return df.withColumns(
        {
            "prompt": F.when(attack, messages.report_prompt()),
            "explanation": F.when(~attack, F.lit(catalog.BENIGN_REPORT_EXPLANATION)),
        }
    )


def with_report(df: DataFrame) -> DataFrame:
    return df.withColumn("report", messages.report_text("explanation"))

