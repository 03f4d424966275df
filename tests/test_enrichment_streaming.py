"""Names, messages, samples; streams against batch."""

import pytest
from pyspark.sql import functions as F

from eventward.functions import messages
from eventward.functions.values import clean_columns, directory_path, display_fields
from eventward.operators import correlation, enrichment
from eventward.plans.queries import json_texts
from eventward.sources.json_events import normalize_emulation_texts
from eventward.streaming import feeds
from tests.helpers import event_table, random_rows


def prediction(spark, label, tactic, one, two, attack):
    return spark.createDataFrame(
        [(label, tactic, one, two, attack)],
        "predicted_label string, predicted_tactic string, stage1_confidence double, stage2_confidence double, is_attack boolean",
    )


def test_enrich(spark):
    known = enrichment.enrich_predictions(prediction(spark, "mimikatz", "TA0006", 0.9, 1.0, True)).first()
    assert (known.predicted_technique, known.tactic_name) == ("T1003.001", "Credential Access")
    assert known.description.startswith("In-memory")
    other = enrichment.enrich_predictions(prediction(spark, "some_New_thing", "TA0099", 0.9, None, True)).first()
    assert (other.predicted_technique, other.tactic_name, other.description) == (None, None, "Some new thing")
    none = enrichment.enrich_predictions(prediction(spark, None, None, 0.9, None, True)).first()
    assert none.description == "Unknown technique"


def test_actions(spark):
    rows = [prediction(spark, x, None, 0.5, None, attack) for x, attack in (("dcsync", True), ("dcsync", False), ("rid_hijacking", True))]
    assert [len(enrichment.recommended_actions(r).first().actions) for r in rows] == [2, 0, 0]


def test_messages(spark):
    row = enrichment.enrich_predictions(prediction(spark, "UNKNOWN", "TA0006", 0.5, None, True))
    asked = enrichment.with_question(row, 'why "this"?').first().prompt
    assert "Stage 1 confidence: 50.00%" in asked and "Stage 2" not in asked and 'asks: "why "this"?"' in asked
    analysed = enrichment.with_analysis(row).first()
    assert "- MITRE technique: None\n" in analysed.prompt and "Stage 2 (technique) confidence: N/A" in analysed.prompt
    assert analysed.prompt.endswith("Write in plain conversational prose only.")
    text = enrichment.with_report(row.withColumn("explanation", F.lit("E"))).first().report
    assert text == (
        "=== RAPPORT SOC ===\nSeverite       : CRITIQUE\nTechnique      : UNKNOWN\n"
        "Tactique MITRE : TA0006 (Credential Access)\nTechnique MITRE: -\n"
        "Confiance      : stage1=50.00%, stage2=N/A\n\nExplication analyste :\nE\n"
    )
    benign = enrichment.enrich_predictions(prediction(spark, "benign", None, 0.1234, None, False))
    assert enrichment.with_analysis(benign).first().explanation.startswith("Event classified as normal")
    assert benign.select(messages.format_confidence("stage1_confidence")).first()[0] == "12.34%"


def test_directory_path(spark):
    names = [None, "", "host", "host.corp.local"]
    table = spark.createDataFrame([(n,) for n in names], "computer string")
    assert [r[0] for r in table.select(directory_path()).collect()] == [
        ["DC=unknown"], ["DC=unknown"], ["CN=host"], ["DC=corp,DC=local", "CN=host"],
    ]


def test_display_and_clean(spark):
    table = spark.createDataFrame([(None, None, float("nan"), "r"), (1, "", 1.5, "r")], "event_id int, computer string, x double, raw string")
    assert [r[0] for r in table.select(display_fields(table)).collect()] == [
        '{"event_id":null,"computer":null}', '{"event_id":1,"computer":""}',
    ]
    assert [tuple(r) for r in table.select(*clean_columns(table)).collect()] == [(None, None, None), (1, "", 1.5)]


def test_priority_sample(spark, events):
    sample = correlation.priority_sample(events).collect()
    labels = [r.label for r in sample]
    assert len(sample) == 8 and max(labels.count(x) for x in labels) == 2
    assert [r.us for r in sample] == sorted((r.us for r in sample), reverse=True)
    assert [r.ord for r in correlation.priority_sample(events).collect()] == [r.ord for r in sample]
    assert correlation.priority_sample(events, labels=["absent"], limit=5).count() == 5
    cut = correlation.priority_sample(events, limit=3).collect()
    assert sorted(r.label for r in cut) == ["mimikatz", "pass_the_hash", "pass_the_hash"]


def test_representative_prefers_rows_with_user(spark):
    rows = [(1, "a", 5, None), (2, "a", 5, "u"), (3, "a", 6, "u"), (4, "b", 7, None)]
    table = spark.createDataFrame(rows, "ord long, label string, event_id int, subject_user_name string")
    got = {r.label: r.ord for r in correlation.representative_events(table).collect()}
    assert got == {"a": 2, "b": 4}
    assert correlation.representative_events(table, ["b"]).count() == 1


@pytest.fixture
def batches(spark, tmp_path):
    """A feed in time order, cut into four files."""
    rows = sorted(random_rows(21, n=200, seconds=1500), key=lambda r: r[1])
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    table = event_table(spark, rows)
    folder = tmp_path / "feed"
    for k in range(4):
        table.where(f"ord >= {50 * k} AND ord < {50 * (k + 1)}").coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return table, stream


def test_stream_deduplicate(spark, tmp_path):
    from eventward.sources.adapter import read_security_events

    events = read_security_events(spark, "/root/testdata/sf0.001").select("ord", "timestamp", "source_file", "record_id")
    folder = str(tmp_path / "dup")
    events.repartition(5).write.parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    got = feeds.run_to_table(feeds.deduplicate_stream(stream, "30 days"), "t-dedup")
    assert got.where("record_id IS NULL").count() == 50
    keyed = got.where("record_id IS NOT NULL")
    assert keyed.count() == keyed.select("source_file", "record_id").distinct().count() == 842


def test_stream_ingest_of_text_files(spark, events, tmp_path):
    texts = json_texts(events)
    folder = str(tmp_path / "lines")
    texts.select(F.when(F.col("ord") % 100 == 0, "{broken").otherwise(F.col("value")).alias("value")).repartition(4).write.text(folder)
    lines = feeds.stream_lines(spark, folder, max_files=1).withColumns({"source_dataset": F.lit("d"), "label": F.lit("l")})
    path = str(tmp_path / "out")
    feeds.ingest_stream(lines, normalize_emulation_texts, path, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(path)
    good, bad = got.where("accepted = 'true'"), got.where("accepted = 'false'")
    assert (good.count(), bad.count(), got.select("batch").distinct().count()) == (990, 10, 4)
    assert {r.raw for r in bad.collect()} == {"{broken"} and good.where("raw IS NOT NULL").count() == 0
    assert got.select("source_file", "ord").distinct().count() == 1000


def test_stream_scoring_writes_each_batch(spark, batches, tmp_path):
    table, stream = batches
    path = str(tmp_path / "scores")
    feeds.score_stream(stream, lambda b: b.select("ord", F.lit("x").alias("s")), path, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(path)
    assert got.count() == 200 and got.select("batch").distinct().count() == 4
