"""Registered queries: every operator over the whole given tables.

`events` is read through the canonical view; texts, predictions and splits used below are
derived from it by Spark, row by row, so each query grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward import catalog
from eventward.functions import messages
from eventward.functions.times import event_micros, iso_text, validated_time
from eventward.functions.values import directory_path, display_fields
from eventward.operators import cleaning, correlation, enrichment, evaluation, features, profiles, splitting
from eventward.operators import detection as forests
from eventward.operators import node_tables
from eventward.operators.rolling import ROLLING_COLUMNS, add_rolling_features
from eventward.plans import detection as plans
from eventward.plans.dataset import build_dataset, read_sources
from eventward.plans.registry import VERSION, ModelRegistry, score_with_latest
from eventward.schema import EVENT_COLUMNS
from eventward.session import scratch_path, stored
from eventward.sources import audit
from eventward.sources.adapter import read_security_events, read_table, security_view
from eventward.sources.json_events import normalize_canonical_texts, normalize_emulation_texts
from eventward.sources.normalize import REASON, accepted, quarantined
from eventward.sources.tables import preview, write_events, write_features, write_label_list, write_layout, write_split
from eventward.sources.xml_events import (
    missing_manifest_files,
    normalize_manifest_batch,
    normalize_xml_texts,
    read_manifest_events,
    stream_event_xml,
)
from eventward.streaming import feeds, keyed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BROKEN = "ord % 50 = 0"  # rows whose text is cut short, to be found in quarantine


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(*columns: str, digits: int = 9) -> list[Column]:
    return [F.round(c, digits).alias(c) for c in columns]


# -- inputs derived from the tables -------------------------------------------------------------

def split_events(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_train_test(read_security_events(spark, folder))


def xml_texts(events: DataFrame) -> DataFrame:
    text = F.concat(
        F.lit(f'<Event xmlns="{catalog.EVENT_LOG_NAMESPACE}"><System><EventID Qualifiers="16384">'),
        F.col("event_id").cast("string"),
        F.lit('</EventID><TimeCreated SystemTime="'),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.lit('+02:00"/><EventRecordID>'), F.coalesce("record_id", F.lit("")),
        F.lit("</EventRecordID><Computer>"), F.col("computer"),
        F.lit('</Computer></System><EventData><Data Name="SubjectUserName">'),
        F.coalesce("subject_user_name", F.lit("-")),
        F.lit('</Data><Data Name="SubjectUserName">second</Data><Data Name="LogonType">'),
        F.coalesce(F.col("logon_type").cast("string"), F.lit("%%1793")),
        F.lit("</Data></EventData></Event>"),
    )
    return events.select(
        "ord", "source_dataset", "source_file", "label", F.col("mitre_tactic").alias("tactic"),
        F.col("mitre_technique").alias("technique"), text.alias("xml"),
    )


def json_texts(events: DataFrame) -> DataFrame:
    text = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("EventID"),
            F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("EventTime"),
            F.col("computer").alias("Hostname"),
            F.col("subject_user_name").alias("SubjectUserName"),
            F.col("subject_domain_name").alias("SubjectDomainName"),
            F.col("record_id").cast("long").alias("RecordNumber"),
            F.col("logon_type").alias("LogonType"),
        )
    )
    return events.select("ord", "source_dataset", "source_file", "label", text.alias("value"))


def canonical_texts(events: DataFrame) -> DataFrame:
    fields = [
        iso_text("timestamp").alias("timestamp") if c == "timestamp" else F.col(c) for c in EVENT_COLUMNS
    ]
    return events.select("ord", "source_file", F.to_json(F.struct(*fields)).alias("value"))


def cut_short(df: DataFrame, text: str) -> DataFrame:
    half = F.expr(f"substring({text}, 1, length({text}) div 2)")
    return df.withColumn(text, F.when(F.expr(BROKEN), half).otherwise(F.col(text)))


def stage1_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows with their tactic and one that is wrong for every seventh row."""
    events = forests.with_stage1_target(split_events(spark, folder)).where("split = 'test'")
    wrong = F.when(F.col("stage1_target") == forests.BENIGN_TACTIC, F.lit("TA0006")).otherwise(F.lit(forests.BENIGN_TACTIC))
    guess = F.when(F.col("ord") % 7 == 0, wrong).otherwise(F.col("stage1_target"))
    return events.withColumn("predicted_tactic", guess).select("ord", "stage1_target", "predicted_tactic")


def evaluable_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = stored(split_events(spark, folder), "split-events")
    labels = evaluation.evaluable_labels(events.where("split = 'train'"), events.where("split = 'test'"))
    return evaluation.restrict_to(with_majority_label(events), labels)


def predictions(events: DataFrame) -> DataFrame:
    """Fixed stand-in for model output: the true label, sometimes an unknown one, with confidences."""
    attack = F.col("label") != catalog.BENIGN_LABEL
    label = F.when(attack & F.expr("ord % 97 = 0"), F.lit("New_technique_X")).otherwise(F.col("label"))
    tactic = F.expr(
        "CASE label WHEN 'benign' THEN NULL WHEN 'pass_the_hash' THEN 'TA0008' "
        "WHEN 'zerologon' THEN 'TA0004' WHEN 'privexchange' THEN 'TA0099' ELSE 'TA0006' END"
    )
    return events.withColumns(
        {
            "predicted_label": label,
            "predicted_tactic": tactic,
            "stage1_confidence": (F.lit(50) + F.col("ord") % 50) / 100.0,
            "stage2_confidence": F.when(attack & F.expr("ord % 97 <> 0"), ((F.col("ord") * 7) % 101) / 100.0),
            "is_attack": attack,
        }
    )


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return predictions(read_security_events(spark, folder)).transform(enrichment.enrich_predictions)


def with_majority_label(events: DataFrame) -> DataFrame:
    """Test rows with the most frequent train label of their event id as prediction."""
    counts = events.where("split = 'train'").groupBy("event_id", "label").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("event_id").agg(
        F.min_by("label", F.struct(-F.col("n"), "label")).alias("guess")
    )
    best = stored(best, "majority-labels")
    return events.where("split = 'test'").join(best, "event_id", "left").withColumn(
        "guess", F.coalesce("guess", F.lit(catalog.BENIGN_LABEL))
    )


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    schema = read_table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return security_view(stream)


# -- ingestion -----------------------------------------------------------------------------------

_INGESTED = ["ord", "event_id", "us", "computer", "subject_user_name", "record_id", "logon_type",
             "source_file", "source_format", "label"]


def _ingested(normalized: DataFrame, *more: str) -> DataFrame:
    return accepted(normalized).withColumn("us", event_micros()).select(*_INGESTED, *more)


@query
def ingest_xml(spark, folder):
    texts = cut_short(xml_texts(read_security_events(spark, folder)), "xml")
    return _ingested(normalize_xml_texts(texts), "mitre_tactic", "mitre_technique", "hostname_raw")


@query
def quarantine_xml(spark, folder):
    texts = cut_short(xml_texts(read_security_events(spark, folder)), "xml")
    return quarantined(normalize_xml_texts(texts)).select("ord", "source_file", REASON)


@query
def ingest_json(spark, folder):
    texts = cut_short(json_texts(read_security_events(spark, folder)), "value")
    return _ingested(normalize_emulation_texts(texts), "subject_domain_name", "hostname_raw")


@query
def quarantine_json(spark, folder):
    texts = cut_short(json_texts(read_security_events(spark, folder)), "value")
    return quarantined(normalize_emulation_texts(texts)).select(
        "ord", "source_file", REASON, F.length("raw").alias("raw_length")
    )


@query
def ingest_canonical(spark, folder):
    texts = canonical_texts(read_security_events(spark, folder))
    return _ingested(normalize_canonical_texts(texts), "mitre_tactic", "ticket_encryption_type", "access_mask")


@query
def validate_timestamps(spark, folder):
    """The accepted time patterns and two others, one per row in turn."""
    events = read_table(spark, folder, "events")
    text = F.expr(
        """CASE event_id % 7
             WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
             WHEN 1 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
             WHEN 2 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
             WHEN 3 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")
             WHEN 4 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
             WHEN 5 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
             ELSE date_format(ts, 'yyyy/MM/dd HH:mm:ss') END"""
    )
    return events.select("event_id", event_micros(validated_time(text)).alias("us"))


@query
def build_event_table(spark, folder):
    """Three sources, XML for the privilege labels, JSON for the other attacks, canonical for benign."""
    events = read_security_events(spark, folder)
    by_xml = F.col("label").isin("zerologon", "privexchange")
    benign = F.col("label") == catalog.BENIGN_LABEL
    rows = (
        normalize_xml_texts(xml_texts(events.where(by_xml)))
        .unionByName(normalize_emulation_texts(json_texts(events.where(~by_xml & ~benign))))
        .unionByName(normalize_canonical_texts(canonical_texts(events.where(benign))))
    )
    return build_dataset(rows).withColumn("us", event_micros()).select(
        *_INGESTED, "mitre_tactic", "mitre_technique"
    )


@query
def scan_event_table(spark, folder):
    return read_security_events(spark, folder).select("ord", "event_id", "us", "computer", "label")


@query
def preview_events(spark, folder):
    return preview(read_security_events(spark, folder), 3).select("ord", "event_id", "us", "computer", "label")


# -- filters and projections ----------------------------------------------------------------------

@query
def filter_label(spark, folder):
    events = read_security_events(spark, folder)
    return events.where(F.col("label") == "pass_the_hash").select("ord", "us", "source_file", "computer")


@query
def filter_members(spark, folder):
    events = read_security_events(spark, folder)
    labels = stored(splitting.single_host_labels(events), "single-host-labels")
    return events.join(labels, "label", "left_semi").select("ord", "label")


@query
def filter_non_members(spark, folder):
    events = read_security_events(spark, folder)
    labels = stored(splitting.single_host_labels(events), "single-host-labels")
    return events.join(labels, "label", "left_anti").select("ord", "label")


@query
def filter_nulls(spark, folder):
    events = read_security_events(spark, folder)
    rows = events.dropna(subset=["subject_user_name", "record_id"]).where("mitre_tactic IS NULL")
    return rows.select("ord", "subject_user_name", "record_id")


@query
def filter_time_range(spark, folder):
    day = "timestamp BETWEEN TIMESTAMP_NTZ'2024-01-02 00:00:00' AND TIMESTAMP_NTZ'2024-01-03 00:00:00'"
    return read_security_events(spark, folder).where(day).select("ord", "us", "computer")


@query
def fill_nulls(spark, folder):
    events = read_security_events(spark, folder)
    return events.select(
        "ord", forests.stage1_target().alias("tactic"), splitting.group_key().alias("group_key"),
        F.coalesce("logon_type", F.lit(-1)).alias("logon_type"),
    )


@query
def clean_rows(spark, folder):
    events = read_security_events(spark, folder).select(
        "ord", *EVENT_COLUMNS).withColumn("raw", F.lit("x"))
    return enrichment.clean_rows(events).select(
        "ord", "event_id", "timestamp", "computer", "subject_user_name", "logon_type", "record_id", "label"
    )


# -- cleaning and profile ---------------------------------------------------------------------------

@query
def deduplicate(spark, folder):
    events = cleaning.deduplicate(read_security_events(spark, folder))
    return events.select("ord", "event_id", "us", "source_file", "record_id", "computer", "label")


@query
def deduplication_report(spark, folder):
    return cleaning.deduplication_report(read_security_events(spark, folder))


@query
def row_count(spark, folder):
    return cleaning.row_count(read_security_events(spark, folder).select(*EVENT_COLUMNS))


@query
def leakage_audit(spark, folder):
    return cleaning.leakage_audit(read_security_events(spark, folder))


@query
def label_distribution(spark, folder):
    return cleaning.label_distribution(read_security_events(spark, folder))


@query
def label_top_counts(spark, folder):
    return cleaning.label_distribution(read_security_events(spark, folder), limit=3)


@query
def label_count(spark, folder):
    return cleaning.label_count(read_security_events(spark, folder))


@query
def null_rates(spark, folder):
    return cleaning.null_rates(read_security_events(spark, folder).select(*EVENT_COLUMNS))


@query
def top_event_ids_per_label(spark, folder):
    return cleaning.top_event_ids_per_label(read_security_events(spark, folder))


@query
def time_span_per_label(spark, folder):
    return cleaning.time_span_per_label(read_security_events(spark, folder))


@query
def rare_labels(spark, folder):
    """The threshold fits the data: at five rows the small tables have no rare label."""
    return cleaning.rare_labels(read_security_events(spark, folder), threshold=100)


@query
def rare_label_totals(spark, folder):
    return cleaning.rare_label_totals(read_security_events(spark, folder))


@query
def merge_rare_labels(spark, folder):
    events = cleaning.merge_rare_labels(read_security_events(spark, folder), threshold=100)
    return events.select("ord", "label", "merged_label")


@query
def tactic_distribution(spark, folder):
    return cleaning.tactic_distribution(read_security_events(spark, folder))


@query
def source_files_per_label(spark, folder):
    return cleaning.source_files_per_label(read_security_events(spark, folder))


@query
def days_per_label(spark, folder):
    return cleaning.days_per_label(read_security_events(spark, folder))


@query
def first_and_last_events(spark, folder):
    return cleaning.first_and_last_events(read_security_events(spark, folder))


@query
def largest_gaps(spark, folder):
    return cleaning.largest_gaps(read_security_events(spark, folder))


@query
def mitre_coverage(spark, folder):
    events = split_events(spark, folder)
    tactics = stored(features.label_to_tactic(events.where("split = 'train'")), "label-tactics")
    return cleaning.mitre_coverage(features.backfill_mitre(events, tactics))


@query
def tactics_per_label(spark, folder):
    return cleaning.tactics_per_label(read_security_events(spark, folder))


@query
def describe_event_frequency(spark, folder):
    events = split_events(spark, folder)
    counts = stored(features.event_id_counts(events.where("split = 'train'")), "event-id-counts")
    encoded = features.apply_event_id_frequency(
        events.where("split = 'train'"), features.event_id_frequency(counts)
    )
    table = cleaning.describe_per_label(encoded, "event_id_freq", catalog.DESCRIBED_LABELS)
    return table.select("label", "n", *rounded("mean", "std", "min", "q25", "q50", "q75", "max"))


@query
def mean_flag_per_label(spark, folder):
    events = features.add_presence_flags(read_security_events(spark, folder))
    return cleaning.top_mean_per_label(events, "has_access_mask").select("label", *rounded("mean"))


@query
def remaining_nulls(spark, folder):
    return cleaning.null_counts(read_security_events(spark, folder).select(*EVENT_COLUMNS))


# -- split ----------------------------------------------------------------------------------------

@query
def group_keys(spark, folder):
    events = read_security_events(spark, folder)
    return events.groupBy(splitting.group_key().alias("group_key")).agg(F.count(F.lit(1)).alias("n"))


@query
def single_host_labels(spark, folder):
    return splitting.single_host_labels(read_security_events(spark, folder))


@query
def fixed_train_hosts(spark, folder):
    return splitting.fixed_train_hosts(read_security_events(spark, folder))


@query
def host_assignment(spark, folder):
    return splitting.host_assignment(read_security_events(spark, folder))


@query
def split_train_test(spark, folder):
    return split_events(spark, folder).select("ord", "label", "computer", "split")


@query
def split_overlap(spark, folder):
    return splitting.split_overlap(split_events(spark, folder))


@query
def split_counts(spark, folder):
    return splitting.split_counts(split_events(spark, folder))


@query
def split_summary(spark, folder):
    return splitting.split_summary(split_events(spark, folder))


# -- features ---------------------------------------------------------------------------------------

@query
def time_features(spark, folder):
    events = features.add_time_features(read_security_events(spark, folder))
    return events.select("ord", "hour", "day_of_week", "is_business_hours", "is_weekend")


@query
def presence_flags(spark, folder):
    events = features.add_presence_flags(read_security_events(spark, folder))
    return events.select("ord", *[f"has_{c}" for c in catalog.SPARSE_COLUMNS])


@query
def event_id_frequency(spark, folder):
    counts = stored(features.event_id_counts(split_events(spark, folder).where("split = 'train'")), "event-id-counts")
    return features.event_id_frequency(counts).select("event_id", *rounded("event_id_freq"))


@query
def apply_event_id_frequency(spark, folder):
    """Encoder fitted on train, applied to all events."""
    events = stored(split_events(spark, folder), "split-events")
    fitted = events.where("split = 'train'")
    counts = stored(features.event_id_counts(fitted), "event-id-counts")
    encoded = features.apply_event_id_frequency(events, features.event_id_frequency(counts))
    return encoded.select("ord", "event_id", *rounded("event_id_freq"))


@query
def top_event_ids(spark, folder):
    counts = features.event_id_counts(split_events(spark, folder).where("split = 'train'"))
    return features.top_event_ids(counts)


@query
def event_id_onehot(spark, folder):
    events = features.add_event_id_onehot(read_security_events(spark, folder), [4624, 4634])
    return events.select("ord", "eid_4624", "eid_4634", "eid_other")


def _rolled(spark, folder) -> DataFrame:
    return add_rolling_features(split_events(spark, folder))


@query
def rolling_event_count(spark, folder):
    return _rolled(spark, folder).select("ord", "split", ROLLING_COLUMNS[0])


@query
def rolling_distinct_event_ids(spark, folder):
    return _rolled(spark, folder).select("ord", "split", ROLLING_COLUMNS[1])


@query
def rolling_distinct_computers(spark, folder):
    return _rolled(spark, folder).select("ord", "split", ROLLING_COLUMNS[2])


@query
def seconds_since_previous(spark, folder):
    return _rolled(spark, folder).select("ord", "split", *rounded(ROLLING_COLUMNS[3]))


@query
def rows_without_user(spark, folder):
    return _rolled(spark, folder).where("subject_user_name IS NULL").select("ord", *ROLLING_COLUMNS)


@query
def label_to_tactic(spark, folder):
    return features.label_to_tactic(split_events(spark, folder).where("split = 'train'"))


@query
def backfill_mitre(spark, folder):
    events = split_events(spark, folder)
    tactics = stored(features.label_to_tactic(events.where("split = 'train'")), "label-tactics")
    return features.backfill_mitre(events, tactics).select("ord", "label", "mitre_tactic", "mitre_technique")


@query
def labels_without_tactic(spark, folder):
    train = split_events(spark, folder).where("split = 'train'")
    return features.labels_without_tactic(train, features.label_to_tactic(train))


@query
def feature_columns(spark, folder):
    table, _ = plans.features_of_split(split_events(spark, folder))
    names = features.feature_columns(table.columns)
    # One row per column and split, counted over all rows.
    counts = table.groupBy("split").agg(*[F.count(c).alias(c) for c in names])
    return counts.unpivot(["split"], names, "feature", "n")


@query
def feature_matrix(spark, folder):
    table, _ = plans.features_of_split(stored(split_events(spark, folder), "split-events"))
    numbers = [c for c in features.feature_columns(table.columns)]
    doubles = {"event_id_freq", ROLLING_COLUMNS[3]}
    return table.select(
        "ord", "split", "label", "mitre_tactic", "mitre_technique",
        *[F.round(c, 9).alias(c) if c in doubles else F.col(c).cast("long").alias(c) for c in numbers],
    )


@query
def isolated_features(spark, folder):
    events = split_events(spark, folder)
    encoders = features.fit_encoders(events.where("split = 'train'"))
    table = features.isolated_features(events, encoders)
    return table.select(
        "ord", "hour", "day_of_week", "is_business_hours", "is_weekend", *rounded("event_id_freq"),
        "has_subject_domain_name", "has_subject_user_name", "has_logon_type", "eid_4624", "eid_other",
        *ROLLING_COLUMNS,
    )


@query
def rolling_profile(spark, folder):
    """Flagship: duplicates out, host-disjoint split, all features, means per split and label."""
    # Each step is read more than once below; written, it is computed once.
    unique = stored(cleaning.deduplicate(read_security_events(spark, folder)), "unique-events")
    events = stored(splitting.split_train_test(unique), "split-events")
    table, _ = plans.features_of_split(events)
    means = [F.round(F.avg(c), 9).alias(c) for c in (*ROLLING_COLUMNS, "event_id_freq", "is_business_hours")]
    return table.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"), *means)


# -- training figures, scoring, evaluation -------------------------------------------------------------

@query
def stage1_targets(spark, folder):
    events = forests.with_stage1_target(split_events(spark, folder))
    return events.groupBy("split", "stage1_target").agg(F.count(F.lit(1)).alias("n"))


@query
def class_weights(spark, folder):
    train = split_events(spark, folder).where("split = 'train'")
    return forests.class_weights(train, "label").select("label", "n", *rounded("weight"))


@query
def tactic_training_summary(spark, folder):
    events = split_events(spark, folder)
    train = events.where("split = 'train'")
    tactics = stored(features.label_to_tactic(train), "label-tactics")
    return forests.tactic_training_summary(features.backfill_mitre(train, tactics))


@query
def route_predictions(spark, folder):
    """Tactic to label: benign, constant, model output and unknown, from a fixed score table."""
    scored = predictions(read_security_events(spark, folder))
    tactic = F.coalesce("predicted_tactic", F.lit(catalog.BENIGN_TACTIC))
    label = forests.route_labels(tactic, {"TA0008": "pass_the_hash"}, {"TA0006": F.col("predicted_label")})
    return scored.select("ord", tactic.alias("tactic"), label.alias("final_label"))


@query
def highest_class(spark, folder):
    """Class and value of the highest score, over the vectors of `embeddings` as score rows."""
    vectors = read_table(spark, folder, "embeddings")
    names = F.transform(F.sequence(F.lit(1), F.size("embedding")), lambda i: F.concat(F.lit("class_"), i.cast("string")))
    best, value = forests.highest_class(F.col("embedding"), names)
    return vectors.select("vec_id", best.alias("best_class"), F.round(value.cast("double"), 6).alias("best_score"))


@query
def accuracy_all(spark, folder):
    scored = with_majority_label(split_events(spark, folder))
    return evaluation.accuracy(scored, "label", "guess").select("n", *rounded("accuracy"))


@query
def accuracy_evaluable(spark, folder):
    events = split_events(spark, folder)
    labels = evaluation.evaluable_labels(events.where("split = 'train'"), events.where("split = 'test'"))
    scored = evaluation.restrict_to(with_majority_label(events), labels)
    return evaluation.accuracy(scored, "label", "guess").select("n", *rounded("accuracy"))


@query
def classification_report(spark, folder):
    return evaluation.classification_report(with_majority_label(split_events(spark, folder)), "label", "guess")


@query
def classification_report_labels(spark, folder):
    return evaluation.classification_report(read_table(spark, folder, "labels"), "quality", "toxic")


@query
def confusion_matrix(spark, folder):
    scored = with_majority_label(split_events(spark, folder))
    classes = evaluation.class_names(scored, "label", "guess")
    return evaluation.confusion_matrix(scored, "label", "guess", classes)


@query
def confusion_matrix_labels(spark, folder):
    table = read_table(spark, folder, "labels")
    names = evaluation.class_names(table, "quality", "toxic")
    wide = evaluation.confusion_matrix(table, "quality", "toxic", names)
    return wide.select("y", *[F.col(c).alias(f"p_{c}") for c in names])


@query
def evaluable_labels(spark, folder):
    events = split_events(spark, folder)
    return evaluation.evaluable_labels(events.where("split = 'train'"), events.where("split = 'test'"))


@query
def error_destinations(spark, folder):
    return evaluation.error_destinations(with_majority_label(split_events(spark, folder)), "label", "guess")


# -- enrichment, correlation, reports ---------------------------------------------------------------------

@query
def enrich_predictions(spark, folder):
    return enriched(spark, folder).select(
        "ord", "predicted_label", "predicted_tactic", "predicted_technique", "tactic_name", "description"
    )


@query
def recommended_actions(spark, folder):
    rows = predictions(read_security_events(spark, folder)).transform(enrichment.recommended_actions)
    return rows.select("ord", "predicted_label", F.array_join("actions", " | ").alias("actions"))


@query
def severities(spark, folder):
    rows = predictions(read_security_events(spark, folder))
    return rows.select("ord", enrichment.severity().alias("severity"))


@query
def related_events(spark, folder):
    """Every attack event as a detection, against all events."""
    events = read_security_events(spark, folder)
    detections = events.where(F.col("label") != catalog.BENIGN_LABEL)
    return correlation.related_events(events, detections)


@query
def priority_sample(spark, folder):
    sample = correlation.priority_sample(read_security_events(spark, folder))
    return sample.select("ord", "us", "label", "event_id")


@query
def analyst_rows(spark, folder):
    rows = enrichment.analyst_rows(enriched(spark, folder))
    return rows.withColumn("dn", F.array_join("dn", ";")).select(
        "id", "time", "dn", "host", "user", "eventId", "technique", "tacticKey", "mitre",
        "stage1", "stage2", "severity", "fields", F.get_json_object("raw", "$.timestamp").alias("raw_time"),
    )


@query
def display_field_objects(spark, folder):
    events = read_security_events(spark, folder)
    return events.select("ord", display_fields(events).alias("fields"))


@query
def directory_paths(spark, folder):
    """Host names, short names, empty and missing ones."""
    events = read_security_events(spark, folder)
    name = F.expr(
        "CASE event_id WHEN 4624 THEN computer WHEN 4634 THEN split(computer, '[.]')[0] "
        "WHEN 4769 THEN '' WHEN 4662 THEN concat('a.', computer) END"
    )
    return events.select("ord", F.array_join(directory_path(name), ";").alias("dn"))


@query
def scorable_rows(spark, folder):
    """Rows that fail are left out of scoring; the rest goes on."""
    texts = cut_short(json_texts(read_security_events(spark, folder)), "value")
    rows = normalize_emulation_texts(texts)
    return rows.groupBy(F.coalesce(REASON, F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query
def json_odd_lines(spark, folder):
    """Lines with something behind the object, white space around it, or an id that is no number."""
    texts = json_texts(read_security_events(spark, folder)).withColumn("kind", F.col("ord") % 8)
    odd = texts.withColumn(
        "value",
        F.when(F.col("kind") == 1, F.concat_ws(" ", "value", "value"))
        .when(F.col("kind") == 2, F.concat("value", F.lit("}")))
        .when(F.col("kind") == 3, F.concat(F.lit("\u00a0\t"), "value", F.lit("\t\u000b")))
        .when(F.col("kind") == 4, F.regexp_replace("value", '"EventID":"[0-9]+"', '"EventID":NaN'))
        .when(F.col("kind") == 5, F.concat("value", F.lit("] xyz")))
        .when(F.col("kind") == 6, F.concat("value", F.lit("][1]")))
        .when(F.col("kind") == 7, F.concat("value", F.lit(',{"~":1}]')))
        .otherwise(F.col("value")),
    )
    rows = normalize_emulation_texts(odd)
    return rows.groupBy(
        (F.col("ord") % 8).alias("kind"), F.coalesce(REASON, F.lit("accepted")).alias("outcome")
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def file_sources(spark, folder):
    """Events written as captures and as several canonical files, read through all sources.

    Returns the survivors of duplicate removal by the number they had before, which the lines
    carry in a text field, and how many numbers the read table has for its rows.
    """
    path = scratch_path(spark, "file-sources")
    events = read_security_events(spark, folder).withColumn("subject_logon_id", F.col("ord").cast("string"))
    lines = canonical_texts(events).repartitionByRange(6, "ord").sortWithinPartitions("ord")
    lines.select("value").write.text(f"{path}/canonical")
    rows = accepted(read_sources(spark, canonical_path=f"{path}/canonical"))
    rows = stored(rows, "read-events")
    numbers = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ord").alias("n_numbers")).first()
    kept = cleaning.deduplicate(rows).select(F.col("subject_logon_id").cast("long").alias("ord"), "source_file", "record_id")
    return kept.withColumns({name: F.lit(numbers[name]) for name in ("n_rows", "n_numbers")})


def _one_file(lines: DataFrame, path: str) -> None:
    """A column of lines, in order of `ord`, as one text file of a given name, as exports come."""
    spark = lines.sparkSession
    folder = scratch_path(spark, "export")
    lines.repartitionByRange(1, "ord").sortWithinPartitions("ord").select("value").write.text(folder)
    paths = spark._jvm.org.apache.hadoop.fs
    files = paths.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(paths.Path(path).getParent())
    parts = [s.getPath() for s in files.listStatus(paths.Path(folder)) if s.getPath().getName().startswith("part-")]
    files.rename(parts[0], paths.Path(path))


#: Category, file, label, tactic and technique of the logs that the queries export.
EXPORTED = (
    ("privilege", "zerologon_log", "zerologon", "TA0004", "CVE-2020-1472"),
    ("privilege", "privexchange_log", "privexchange", "TA0004", "T1187"),
    ("privilege", "never_exported", "nothing", "TA0004", "T1"),
)
XML_LABELS = [entry[2] for entry in EXPORTED]


def _export_logs(events: DataFrame, root: str, entries=EXPORTED) -> None:
    """XML logs, whose events span lines, and one that no manifest names."""
    for category, name, label, _, _ in entries:
        if label != "nothing":
            texts = xml_texts(events.where(F.col("label") == label))
            _one_file(texts.select("ord", F.regexp_replace("xml", "><(?!/)", ">\n<").alias("value")), f"{root}/{category}/{name}.xml")
    texts = xml_texts(events.where(F.col("label") == "mimikatz"))
    _one_file(texts.select("ord", F.col("xml").alias("value")), f"{root}/privilege/unlisted.xml")


_FROM_FILES = ["event_id", "us", "computer", "subject_user_name", "record_id", "logon_type", "source_file",
               "source_format", "label", "mitre_tactic", "mitre_technique"]


@query
def manifest_sources(spark, folder):
    """XML logs on disk, read by their manifest; its entry without a file is counted apart."""
    root = scratch_path(spark, "xml-logs")
    _export_logs(read_security_events(spark, folder), root)
    manifest = catalog.manifest_table(spark, EXPORTED)
    rows = accepted(read_manifest_events(spark, root, manifest)).withColumn("us", event_micros()).select(*_FROM_FILES)
    missing = ",".join(row.file for row in missing_manifest_files(spark, root, manifest).orderBy("file").collect())
    return rows.withColumn("missing", F.lit(missing))


@query
def stream_manifest_sources(spark, folder):
    """The same logs as a feed: one is there at first, the other comes while the feed is down."""
    root, out, state = (scratch_path(spark, f"xml-feed-{part}") for part in ("logs", "table", "state"))
    events = read_security_events(spark, folder)
    manifest = catalog.manifest_table(spark, EXPORTED)
    for entry in EXPORTED[:2]:
        _export_logs(events, root, [entry])
        feeds.ingest_stream(stream_event_xml(spark, root), normalize_manifest_batch(manifest), out, state).awaitTermination()
    table = spark.read.parquet(out).where("accepted = 'true'")
    return table.withColumn("us", event_micros()).select(*_FROM_FILES)


@query
def all_sources(spark, folder):
    """The data set of XML logs, captures and canonical files on disk, without duplicates."""
    root = scratch_path(spark, "sources")
    events = read_security_events(spark, folder)
    _export_logs(events, f"{root}/xml")
    captured = [label for label in catalog.EMULATION_LABELS if label in ("mimikatz", "pass_the_hash", "dcsync_empire")]
    for label in captured:
        _one_file(json_texts(events.where(F.col("label") == label)), f"{root}/captures/{label}.json")
    rest = ~F.col("label").isin([*XML_LABELS, *captured])
    canonical_texts(events.where(rest)).select("value").write.text(f"{root}/canonical")
    rows = read_sources(spark, f"{root}/xml", catalog.manifest_table(spark, EXPORTED), f"{root}/captures", f"{root}/canonical")
    return build_dataset(rows).groupBy("label", "source_format").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("ord").alias("n_numbers"), F.sum(event_micros() - 1_704_067_200_000_000).alias("us"),
        F.countDistinct("source_file").alias("n_files"), F.count("mitre_tactic").alias("n_tactics"),
    )


@query
def audit_fields(spark, folder):
    """Fields of raw records, accepted and rejected ones, from the audit table."""
    texts = json_texts(read_security_events(spark, folder))
    no_number = F.regexp_replace("value", '"EventID":"[0-9]+"', '"EventID":"none"')
    texts = cut_short(texts.withColumn("value", F.when(F.expr("ord % 50 = 1"), no_number).otherwise(F.col("value"))), "value")
    path = scratch_path(spark, "audit")
    audit.write_audit(normalize_emulation_texts(texts), path)
    return audit.read_audit(spark, path).select(
        "ord", "accepted", F.coalesce(REASON, F.lit("")).alias(REASON), audit.raw_field("EventID").alias("event_text"),
        audit.raw_field("EventID", "int").alias("event_number"), audit.raw_field("Hostname").alias("host"),
        audit.raw_field("RecordNumber", "bigint").alias("record"), audit.raw_field("no such").alias("nothing"),
        F.length(audit.raw_text()).alias("text_length"),
    )


@query
def daily_profile_union(spark, folder):
    """Profiles of days, written day by day and united per label, against one pass over all events."""
    events = read_security_events(spark, folder)
    path = scratch_path(spark, "daily-profiles")
    half = F.to_date("timestamp") < F.lit("2024-01-04").cast("date")
    for days in (half, ~half):
        profiles.write_days(events.where(days), path)
    united = profiles.figures(profiles.unite(profiles.read_days(spark, path), "label"), (0.5,))
    second = profiles.second_of_day()
    exact = events.groupBy("label").agg(
        *[F.countDistinct(c).alias(f"{name}_exact") for name, c in profiles.DISTINCT.items()]
    )
    ranks = events.withColumn("second", second).join(united.select("label", "second_50"), "label").groupBy("label").agg(
        F.avg((F.col("second") < F.col("second_50")).cast("double")).alias("below"),
        F.avg((F.col("second") <= F.col("second_50")).cast("double")).alias("upto"),
    )
    close = [
        (F.abs(F.col(name) - F.col(f"{name}_exact")) <= profiles.DISTINCT_ERROR * F.col(f"{name}_exact")).alias(f"{name}_close")
        for name in profiles.DISTINCT
    ]
    middle = (F.col("below") <= 0.5 + profiles.RANK_ERROR) & (F.col("upto") >= 0.5 - profiles.RANK_ERROR)
    return united.join(exact, "label").join(ranks, "label").select("label", "n_events", *close, middle.alias("median_close"))


@query
def split_sink_round_trip(spark, folder):
    """Split and feature tables and the list of evaluable labels through their sinks and back."""
    path = scratch_path(spark, "split-sinks")
    write_split(split_events(spark, folder), f"{path}/split")
    split = spark.read.parquet(f"{path}/split")
    train, test = (split.where(F.col("split") == s) for s in ("train", "test"))
    write_label_list(evaluation.evaluable_labels(train, test), f"{path}/labels")
    table, encoders = plans.features_of_split(split)
    write_features(table, f"{path}/features")
    encoders.save(f"{path}/encoders")
    loaded = features.FeatureEncoders.load(spark, f"{path}/encoders")
    labels = spark.read.text(f"{path}/labels").select(F.col("value").alias("label"), F.lit(True).alias("evaluable"))
    features_back = spark.read.parquet(f"{path}/features").groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n_features"), F.sum("hour").cast("bigint").alias("hours")
    )
    counts = split.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.join(features_back, ["split", "label"]).join(labels, "label", "left")
        .withColumn("evaluable", F.coalesce("evaluable", F.lit(False)))
        .withColumn("top_ids", F.lit(",".join(map(str, sorted(loaded.top_event_ids)))))
    )


@query
def event_table_round_trip(spark, folder):
    """The event table through its Parquet and CSV sinks and back."""
    path = scratch_path(spark, "event-sinks")
    write_events(read_security_events(spark, folder), f"{path}/parquet", f"{path}/csv")
    table = spark.read.parquet(f"{path}/parquet").select("ord", "event_id", "computer", "label", "record_id")
    texts = spark.read.csv(f"{path}/csv", header=True).select(F.col("ord").cast("long").alias("ord"), F.col("label").alias("csv_label"))
    # Both sides have a row per event, and their files are far smaller than the rows in memory, so
    # their size would pass as that of a lookup table, which the driver collects.
    return table.join(texts.hint("merge"), "ord")


@query
def stage1_report(spark, folder):
    """Tactic report of stand-in predictions on test, over all true and predicted tactics."""
    scored = stage1_pairs(spark, folder)
    return evaluation.classification_report(scored, "stage1_target", "predicted_tactic")


@query
def stage1_confusion(spark, folder):
    scored = stage1_pairs(spark, folder)
    pairs = evaluation.pair_counts(scored, "stage1_target", "predicted_tactic")
    return pairs.select("y", "p", "n")


@query
def evaluable_report(spark, folder):
    """Report of stand-in labels on test, over labels that train and test share."""
    return evaluation.classification_report(evaluable_rows(spark, folder), "label", "guess")


@query
def evaluable_error_destinations(spark, folder):
    return evaluation.error_destinations(evaluable_rows(spark, folder), "label", "guess")


@query
def representative_events(spark, folder):
    rows = correlation.representative_events(read_security_events(spark, folder))
    return rows.select("label", "ord", "event_id", "subject_user_name", "us")


@query
def confidence_texts(spark, folder):
    rows = predictions(read_security_events(spark, folder))
    return rows.select(
        "ord", messages.format_confidence("stage1_confidence").alias("stage1"),
        messages.format_confidence("stage2_confidence").alias("stage2"),
    )


@query
def analysis_prompts(spark, folder):
    return enriched(spark, folder).transform(enrichment.with_analysis).select(
        "ord", "prompt", "explanation", F.size("actions").alias("n_actions")
    )


@query
def question_prompts(spark, folder):
    rows = enriched(spark, folder)
    question = F.concat(F.lit("Is "), F.col("computer"), F.lit(" affected?"))
    return enrichment.with_question(rows, question).select("ord", "prompt")


@query
def report_prompts(spark, folder):
    return enriched(spark, folder).transform(enrichment.with_report_prompt).select("ord", "prompt", "explanation")


@query
def reports(spark, folder):
    rows = enriched(spark, folder).transform(enrichment.with_report_prompt)
    return rows.transform(enrichment.with_report).select("ord", "report")


# -- models -------------------------------------------------------------------------------------------

_SAVED: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def _trained(spark, folder) -> tuple[plans.Detector, DataFrame]:
    """The detector of a folder, trained and saved once per session and loaded from then on, and its feature table."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _SAVED:
        detector, table = plans.train_detector(split_events(spark, folder))
        path = scratch_path(spark, "detector")
        detector.save(spark, path)
        _SAVED[key] = path, table
    path, table = _SAVED[key]
    return plans.Detector.load(spark, path), table


def _detector(spark, folder) -> plans.Detector:
    return _trained(spark, folder)[0]


@query
def train_and_score(spark, folder):
    """Both stages fitted on train, test rows scored with their rolling features, and the accuracy."""
    detector, table = _trained(spark, folder)
    scored = forests.predict_hierarchical(detector.model, table.where("split = 'test'"))
    return evaluation.classification_report(scored, "label", "predicted_label")


@query
def node_table_scores(spark, folder):
    """Test rows scored by the model and by its node tables; both must agree in every row, to the last bit."""
    detector, table = _trained(spark, folder)
    path = scratch_path(spark, "node-tables")
    detector.model.save(spark, path)
    test = table.where("split = 'test'")
    columns = ["predicted_label", "stage1_confidence", "stage2_confidence"]
    first, second = (
        forests.predict_hierarchical(model, test).select("ord", "label", F.struct(*columns).alias("answer"))
        for model in (detector.model, node_tables.load_as_nodes(spark, path))
    )
    both = first.join(second.select("ord", F.col("answer").alias("again")).hint("merge"), "ord", "left")
    return both.select("ord", "label", F.col("answer").eqNullSafe(F.col("again")).alias("same"))


@query
def important_features(spark, folder):
    model = _detector(spark, folder).model
    return forests.feature_importances(model.stage1, model.features, spark)


@query
def reports_of_scored_events(spark, folder):
    """The whole chain for every event: isolated features, both stages, names, prompt, report."""
    detector = _detector(spark, folder)
    return plans.report(read_security_events(spark, folder), detector).select(
        "ord", "predicted_label", "predicted_tactic", "is_attack", "report"
    )


# -- streams --------------------------------------------------------------------------------------------

@query
def stream_ingest(spark, folder):
    texts = cut_short(json_texts(stream_events(spark, folder)), "value")
    rows = feeds.with_quarantine(normalize_emulation_texts(texts))
    table = feeds.run_to_table(rows, "stream-ingest", ("accepted",))
    return table.groupBy("accepted", F.coalesce(REASON, F.lit("")).alias(REASON), "source_file").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.length("raw"), F.lit(0))).alias("raw_length")
    )


@query
def stream_deduplicate(spark, folder):
    events = stream_events(spark, folder).select("ord", "timestamp", "source_file", "record_id")
    table = feeds.run_to_table(feeds.deduplicate_stream(events, "30 days"), "stream-deduplicate")
    return table.groupBy("source_file", "record_id").agg(F.count(F.lit(1)).alias("n"))


def _over_feed(table: DataFrame, along: str, operator, name: str, partition_by: tuple[str, ...] = (), parts: int = 3) -> DataFrame:
    """Run an operator over the table as a feed, its rows in order of a number: each part arrives,
    is taken up as a micro-batch from the checkpoint of the one before, and ends in one table."""
    spark = table.sparkSession
    table = stored(table, "feed-rows")
    first, last = table.agg(F.min(along), F.max(along)).first()
    path, out, state = (scratch_path(spark, f"{name}-{part}") for part in ("feed", "table", "state"))
    width = (last - first) // parts + 1 if last is not None else 1
    for k in range(parts):
        low = (first or 0) + k * width
        table.where(F.col(along).between(low, low + width - 1)).write.mode("append").parquet(path)
        result = operator(spark.readStream.schema(table.schema).parquet(path))
        feeds.write_stream(result, out, state, partition_by).awaitTermination()
    return spark.read.schema(result.schema).parquet(out)


@query
def stream_rolling_features(spark, folder):
    """On a feed in order of time, several micro-batches long."""
    events = read_security_events(spark, folder).select(
        "ord", "timestamp", event_micros().alias("us"), "subject_user_name", "event_id", "computer"
    )
    table = _over_feed(events, "us", keyed.rolling_features_stream, "stream-rolling")
    return table.select("ord", "late", *ROLLING_COLUMNS[:3], *rounded(ROLLING_COLUMNS[3]))


@query
def rolling_from_layout(spark, folder):
    """Rolling features over the event table bucketed by user, whose windows shuffle nothing."""
    events = read_security_events(spark, folder).select("ord", "timestamp", "subject_user_name", "event_id", "computer")
    name = write_layout(events, scratch_path(spark, "user-layout"), "subject_user_name")
    rolled = add_rolling_features(spark.table(name), group=(), dealt=True)
    return rolled.select("ord", F.lit(False).alias("late"), *ROLLING_COLUMNS[:3], *rounded(ROLLING_COLUMNS[3]))


@query
def stream_first_wins(spark, folder):
    """Survivors and duplicates of a feed in order of arrival, as one sink in two parts."""
    events = read_security_events(spark, folder).select("ord", "timestamp", "source_file", "record_id", "event_id", "logon_type")
    table = _over_feed(events, "ord", lambda feed: keyed.first_wins_stream(feed, "30 days"), "stream-first", (keyed.VERDICT,))
    return table.select("ord", "source_file", "record_id", "event_id", "logon_type", keyed.VERDICT)


@query
def stream_related_events(spark, folder):
    """Related events of all attack events of a feed in order of time, with a last sign of life that closes it."""
    events = read_security_events(spark, folder).select(
        "ord", "timestamp", event_micros().alias("us"), "computer", "event_id", "label"
    )
    last = events.agg(F.max("timestamp").alias("last")).select(
        F.lit(-1).cast("long").alias("ord"), (F.col("last") + F.expr("INTERVAL 1 DAY")).alias("timestamp"),
        F.expr("unix_micros(CAST(last AS TIMESTAMP)) + 86400000000").alias("us"), F.lit("").alias("computer"),
        F.lit(0).alias("event_id"), F.lit(catalog.BENIGN_LABEL).alias("label"),
    )

    def related(feed: DataFrame) -> DataFrame:
        return keyed.related_events_stream(feed, F.col("label") != catalog.BENIGN_LABEL)

    return _over_feed(events.unionByName(last), "us", related, "stream-related")


@query
def stream_score(spark, folder):
    """A feed scored with the newest version of the detector; each row names the version."""
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    registry.publish(_detector(spark, folder))
    path, state = scratch_path(spark, "stream-score"), scratch_path(spark, "stream-score-state")
    score_with_latest(stream_events(spark, folder), registry, path, state).awaitTermination()
    scored = spark.read.parquet(path).transform(enrichment.enrich_predictions)
    return scored.select(
        "ord", "predicted_label", "predicted_tactic", "tactic_name", "is_attack", enrichment.severity().alias("severity"), VERSION
    )
