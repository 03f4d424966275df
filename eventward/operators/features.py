"""Encoders fitted on the training split and the feature matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward.catalog import (
    LEAKAGE_COLUMNS,
    SPARSE_COLUMNS,
    TARGET_COLUMNS,
    TOP_EVENT_IDS,
    manual_mitre_table,
)
from eventward.functions.times import (
    business_hours_flag,
    hour_of,
    weekday_of,
    weekend_flag,
)
from eventward.functions.values import presence_flag
from eventward.operators.ordered import MAX_GROUP_ROWS
from eventward.operators.rolling import ROLLING_COLUMNS, USER, add_rolling_features
from eventward.session import stored


# -- expressions ----------------------------------------------------------------------------

def add_time_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "hour": hour_of(),
            "day_of_week": weekday_of(),
            "is_business_hours": business_hours_flag(),
            "is_weekend": weekend_flag(),
        }
    )


def add_presence_flags(df: DataFrame, empty_is_present: bool = True) -> DataFrame:
    """`has_<field>` for the sparse fields the table has.

    In training an empty text is a value; the scoring of a lone event counts it as missing
    (`empty_is_present=False`). Pass the same choice to both to avoid the difference.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {f"has_{c}": presence_flag(c, types[c], empty_is_present) for c in SPARSE_COLUMNS if c in types}
    )


def event_id_flag(event_id: int) -> Column:
    return F.coalesce((F.col("event_id") == event_id).cast("int"), F.lit(0))


def add_event_id_onehot(df: DataFrame, top_event_ids: list[int]) -> DataFrame:
    flags = {f"eid_{i}": event_id_flag(i) for i in top_event_ids}
    known = F.coalesce(F.col("event_id").isin(top_event_ids), F.lit(False)) if top_event_ids else F.lit(False)
    flags["eid_other"] = (~known).cast("int")
    return df.withColumns(flags)


# -- fitted encoders --------------------------------------------------------------------------

def event_id_counts(train: DataFrame) -> DataFrame:
    return train.where("event_id IS NOT NULL").groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


def event_id_frequency(counts: DataFrame) -> DataFrame:
    """Share of the training rows per event id, from the counts."""
    total = counts.agg(F.sum("n")).first()[0]
    return counts.select("event_id", (F.col("n") / F.lit(total)).alias("event_id_freq"))


def top_event_ids(counts: DataFrame, n: int = TOP_EVENT_IDS) -> DataFrame:
    return counts.orderBy(F.desc("n"), "event_id").limit(n)


def apply_event_id_frequency(df: DataFrame, frequency: DataFrame) -> DataFrame:
    return df.join(frequency, "event_id", "left").withColumn(
        "event_id_freq", F.coalesce("event_id_freq", F.lit(0.0))
    )


def label_to_tactic(train: DataFrame) -> DataFrame:
    """Most frequent known tactic per label; of equally frequent ones the smallest."""
    known = train.where("mitre_tactic IS NOT NULL AND label IS NOT NULL")
    return known.groupBy("label").agg(F.mode("mitre_tactic", True).alias("learned_tactic"))


def labels_without_tactic(train: DataFrame, tactics: DataFrame) -> DataFrame:
    return train.select("label").distinct().join(tactics, "label", "left_anti")


def backfill_mitre(df: DataFrame, tactics: DataFrame) -> DataFrame:
    """Fill missing tactics from the learned map, then from the fixed one; techniques from the fixed one."""
    manual = F.broadcast(manual_mitre_table(df.sparkSession))  # seven fixed rows
    return (
        df.join(tactics, "label", "left")
        .join(manual, "label", "left")
        .withColumns(
            {
                "mitre_tactic": F.coalesce("mitre_tactic", "learned_tactic", "manual_tactic"),
                "mitre_technique": F.coalesce("mitre_technique", "manual_technique"),
            }
        )
        .drop("learned_tactic", "manual_tactic", "manual_technique")
    )


@dataclass
class FeatureEncoders:
    """State fitted on train and frozen: it names the `eid_` columns and feeds every later split."""

    frequency: DataFrame
    top_event_ids: list[int]
    tactics: DataFrame

    def save(self, path: str) -> None:
        spark = self.frequency.sparkSession
        self.frequency.write.mode("overwrite").json(f"{path}/event_id_frequency")
        self.tactics.write.mode("overwrite").json(f"{path}/label_to_tactic")
        ranks = list(enumerate(self.top_event_ids))
        top = spark.createDataFrame(ranks, "rank int, event_id int")
        top.coalesce(1).write.mode("overwrite").json(f"{path}/top_event_ids")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureEncoders":
        top = spark.read.schema("rank int, event_id int").json(f"{path}/top_event_ids")
        return FeatureEncoders(
            spark.read.schema("event_id int, event_id_freq double").json(f"{path}/event_id_frequency"),
            [r.event_id for r in top.orderBy("rank").collect()],
            spark.read.schema("label string, learned_tactic string").json(f"{path}/label_to_tactic"),
        )


def fit_encoders(train: DataFrame, n_top: int = TOP_EVENT_IDS) -> FeatureEncoders:
    """One pass over three columns of train; the encoders derive from its small result."""
    cells = train.groupBy("event_id", "label", "mitre_tactic").agg(F.count(F.lit(1)).alias("n"))
    cells = stored(cells, "training-counts")
    known = cells.where("event_id IS NOT NULL").groupBy("event_id").agg(F.sum("n").alias("n"))
    tactics = cells.where("mitre_tactic IS NOT NULL AND label IS NOT NULL").groupBy("label", "mitre_tactic")
    learned = tactics.agg(F.sum("n").alias("n")).groupBy("label").agg(
        F.min_by("mitre_tactic", F.struct(-F.col("n"), "mitre_tactic")).alias("learned_tactic")
    )
    return FeatureEncoders(
        frequency=stored(event_id_frequency(known), "event-id-frequency"),
        top_event_ids=[r.event_id for r in top_event_ids(known, n_top).collect()],
        tactics=stored(learned, "label-tactics"),
    )


# -- feature matrix ----------------------------------------------------------------------------

def _encode(df: DataFrame, encoders: FeatureEncoders, empty_is_present: bool) -> DataFrame:
    df = add_presence_flags(add_time_features(df), empty_is_present)
    df = apply_event_id_frequency(df, encoders.frequency)
    return add_event_id_onehot(df, encoders.top_event_ids)


def build_features(
    df: DataFrame,
    encoders: FeatureEncoders,
    group: tuple[str, ...] = ("split",),
    empty_is_present: bool = True,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Events with all feature columns. Rolling context never crosses `group`.

    The rolling part comes first, so that its shuffle carries the event columns only.
    """
    rolled = add_rolling_features(df, group, max_group_rows=max_group_rows)
    rolled = rolled.fillna({"seconds_since_prev_event_user": -1.0, "distinct_computers_last_5min_user": 0})
    return _encode(rolled, encoders, empty_is_present)


def isolated_features(
    df: DataFrame, encoders: FeatureEncoders, empty_is_present: bool = False
) -> DataFrame:
    """Features of events seen alone: rolling columns as given, else their defaults; a missing time is now."""
    defaults = dict(zip(ROLLING_COLUMNS, (F.lit(1), F.lit(1), F.lit(0), F.lit(-1.0))))
    kinds = dict(zip(ROLLING_COLUMNS, ("long", "long", "long", "double")))
    rolling = {
        c: (F.coalesce(c, v) if c in df.columns else v).cast(kinds[c]) for c, v in defaults.items()
    }
    now = F.coalesce("timestamp", F.current_timestamp().cast("timestamp_ntz"))
    return _encode(df.withColumns({"timestamp": now, **rolling}), encoders, empty_is_present)


def feature_columns(columns: list[str], extra_excluded: tuple[str, ...] = ("ord", "us", "split", "stage1_target")) -> list[str]:
    """Columns usable as model input, sorted by name."""
    excluded = {*LEAKAGE_COLUMNS, *TARGET_COLUMNS, *SPARSE_COLUMNS, USER, "timestamp", "event_id", *extra_excluded}
    return sorted(c for c in columns if c not in excluded)


def kept_columns(df: DataFrame) -> list[str]:
    """Columns of the stored feature table: features, targets, then what traces a row back."""
    wanted = [*feature_columns(df.columns), *TARGET_COLUMNS, USER, "timestamp", "computer"]
    return [c for c in dict.fromkeys(wanted) if c in df.columns]
