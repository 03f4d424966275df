"""Features, both model stages, evaluation."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventward.catalog import SPARSE_COLUMNS
from eventward.operators import detection as D
from eventward.operators import evaluation, features
from eventward.operators.rolling import ROLLING_COLUMNS
from eventward.plans import detection as plans
from eventward.sources.tables import write_features

SMALL = D.ForestSettings(stage1_trees=10, stage1_depth=6, stage1_min_leaf=1, stage2_trees=10, stage2_depth=6, memory_mb=256)


@pytest.fixture(scope="module")
def matrix(split):
    table, encoders = plans.features_of_split(split)
    return table.cache(), encoders


def test_feature_rows_and_columns(split, matrix):
    table, encoders = matrix
    assert table.count() == split.count()
    names = features.feature_columns(table.columns)
    assert names == sorted(names) and len(names) == 24 + len(encoders.top_event_ids) + 1 + 4 + 4 + 1
    assert not {"event_id", "computer", "label", "timestamp", "split", "ord"} & set(names)
    assert table.select([F.count_if(F.col(c).isNull()).alias(c) for c in names]).first().asDict() == dict.fromkeys(names, 0)


def test_kept_columns(matrix, spark, tmp_path):
    table, _ = matrix
    kept = features.kept_columns(table)
    assert kept[-3:] == ["subject_user_name", "timestamp", "computer"] and len(kept) == len(set(kept))
    write_features(table, str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    assert sorted(stored.columns) == sorted([*kept, "split"])


def test_presence_of_empty_text(spark):
    table = spark.createDataFrame([("",), ("x",), (None,)], "subject_user_name string")
    flag = lambda **o: [r[0] for r in features.add_presence_flags(table, **o).select("has_subject_user_name").collect()]
    assert flag() == [1, 1, 0] and flag(empty_is_present=False) == [0, 1, 0]
    assert set(SPARSE_COLUMNS) - {"subject_user_name"} and features.add_presence_flags(table).columns == ["subject_user_name", "has_subject_user_name"]


def test_time_features(spark):
    times = [datetime(2024, 1, 1, 8), datetime(2024, 1, 6, 18, 59), datetime(2024, 1, 7, 19), None]
    table = spark.createDataFrame([(t,) for t in times], "timestamp timestamp_ntz")
    got = [tuple(r)[1:] for r in features.add_time_features(table).collect()]
    assert got == [(8, 0, 1, 0), (18, 5, 1, 1), (19, 6, 0, 1), (None, None, 0, 0)]


def test_onehot_of_missing_event_id(spark):
    table = spark.createDataFrame([(1,), (2,), (None,)], "event_id int")
    rows = features.add_event_id_onehot(table, [1]).select("eid_1", "eid_other").collect()
    assert [tuple(r) for r in rows] == [(1, 0), (0, 1), (0, 1)]


def test_label_to_tactic_tie_and_agreement(spark):
    rows = [("a", "T2", 1), ("a", "T1", 1), ("b", "T3", 2), ("b", None, 2), ("c", None, 2)]
    train = spark.createDataFrame(rows, "label string, mitre_tactic string, event_id int")
    direct = {tuple(r) for r in features.label_to_tactic(train).collect()}
    assert direct == {("a", "T1"), ("b", "T3")}
    encoders = features.fit_encoders(train)
    assert {tuple(r) for r in encoders.tactics.collect()} == direct
    assert encoders.top_event_ids == [2, 1]
    assert [r.label for r in features.labels_without_tactic(train, features.label_to_tactic(train)).collect()] == ["c"]


def test_backfill(spark):
    rows = [("mimikatz", None, None), ("a", None, None), ("a", "T9", "X"), ("benign", None, None)]
    table = spark.createDataFrame(rows, "label string, mitre_tactic string, mitre_technique string")
    learned = spark.createDataFrame([("a", "T1")], "label string, learned_tactic string")
    got = {tuple(r) for r in features.backfill_mitre(table, learned).collect()}
    assert got == {("mimikatz", "TA0006", "T1003.001"), ("a", "T1", None), ("a", "T9", "X"), ("benign", None, None)}


def test_isolated_features_use_given_rolling_values(split, matrix):
    _, encoders = matrix
    rows = split.limit(5).withColumn("events_last_5min_user", F.lit(7)).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    got = features.isolated_features(rows, encoders).select(*ROLLING_COLUMNS, "hour").collect()
    assert {tuple(r)[:4] for r in got} == {(7, 1, 0, -1.0)} and all(r.hour is not None for r in got)


def test_encoders_round_trip(spark, matrix, tmp_path):
    _, encoders = matrix
    encoders.save(str(tmp_path / "enc"))
    loaded = features.FeatureEncoders.load(spark, str(tmp_path / "enc"))
    assert loaded.top_event_ids == encoders.top_event_ids
    assert sorted(map(tuple, loaded.frequency.collect())) == sorted(map(tuple, encoders.frequency.select("event_id", "event_id_freq").collect()))


def toy(spark, with_unknown=False):
    rows = []
    for i in range(240):
        kind = i % 4
        label, tactic = [("benign", None), ("p", "TA0006"), ("q", "TA0006"), ("only", "TA0008")][kind]
        rows.append((i, float(kind == 0), float(kind in (1, 2)), float(kind == 2), float(kind == 3), label, tactic))
    return spark.createDataFrame(rows, "ord long, a double, b double, c double, d double, label string, mitre_tactic string")


def test_hierarchical_model(spark, tmp_path):
    table, names = toy(spark), ["a", "b", "c", "d"]
    model = D.train_hierarchical(table, names, SMALL)
    assert model.constants == {"TA0008": "only"} and set(model.forests) == {"TA0006"}
    assert model.tactics == ["BENIGN", "TA0006", "TA0008"]
    scored = D.predict_hierarchical(model, table).cache()
    assert evaluation.accuracy(scored, "label", "predicted_label").first().accuracy == 1.0
    assert scored.count() == 240
    benign = scored.where("label = 'benign'").first()
    assert (benign.predicted_tactic, benign.is_attack, benign.stage2_confidence) == (None, False, None)
    assert scored.where("label = 'only'").first().stage2_confidence == 1.0
    model.save(spark, str(tmp_path / "m"))
    loaded = D.HierarchicalModel.load(spark, str(tmp_path / "m"))
    again = D.predict_hierarchical(loaded, table)
    assert sorted(map(tuple, again.select("ord", "predicted_label", "stage1_confidence").collect())) == sorted(
        map(tuple, scored.select("ord", "predicted_label", "stage1_confidence").collect())
    )
    model.forests, model.constants = {}, {}
    assert {r[0] for r in D.predict_hierarchical(model, table).select("predicted_label").distinct().collect()} == {"benign", "UNKNOWN"}
    top = D.feature_importances(loaded.stage1, names, spark, 2).collect()
    assert len(top) == 2 and top[0].importance >= top[1].importance


def test_class_weights(spark):
    table = spark.createDataFrame([("a",)] * 3 + [("b",)], "label string")
    assert {r.label: round(r.weight, 6) for r in D.class_weights(table, "label").collect()} == {"a": 0.666667, "b": 2.0}


def test_highest_class_tie(spark):
    table = spark.createDataFrame([([0.4, 0.4, 0.2],)], "s array<double>")
    label, value = D.highest_class(F.col("s"), F.array(*[F.lit(c) for c in "xyz"]))
    assert tuple(table.select(label, value).first()) == ("x", 0.4)


def test_detector_chain(spark, split, tmp_path):
    detector, table = plans.train_detector(split, SMALL)
    assert detector.model.evaluable_labels == ["benign", "mimikatz", "pass_the_hash"]
    detector.save(spark, str(tmp_path / "d"))
    loaded = plans.Detector.load(spark, str(tmp_path / "d"))
    sample = split.limit(40).cache()
    texts = sample.select("ord", F.lit("because").alias("explanation"))
    rows = plans.report(sample, loaded, texts).collect()
    assert len(rows) == 40 and all(r.report.startswith("=== RAPPORT SOC ===") for r in rows)
    assert all(("because" in r.report) == r.is_attack for r in rows)
    analysed = plans.analyse(sample, loaded).collect()
    assert all((r.prompt is None) != r.is_attack for r in analysed)
    broken = sample.withColumn("event_id", F.when(F.col("ord") % 2 == 0, F.col("event_id")))
    scored = {r.ord: r for r in plans.score_isolated(broken, loaded).collect()}
    assert len(scored) == 40  # an event without id is scored as an unknown one
    assert all(r.event_id_freq == 0.0 and r.eid_other == 1 for r in scored.values() if r.event_id is None)
    assert plans.score_in_context(broken, loaded).count() == 40
    assert plans.score_in_context(sample, loaded).count() == 40


def test_report_without_hits(spark):
    table = spark.createDataFrame([("a", "b"), ("c", "c")], "y string, p string")
    rows = {r["class"]: r for r in evaluation.classification_report(table, "y", "p").collect()}
    assert (rows["a"].recall, rows["b"].precision, rows["c"].f1) == (0.0, 0.0, 1.0)
    assert rows["accuracy"].f1 == 0.5 and rows["macro avg"].precision == round(1 / 3, 9)
    assert evaluation.class_names(table, "y", "p") == ["a", "b", "c"]
    assert [tuple(r) for r in evaluation.error_destinations(table, "y", "p").collect()] == [("b", 1)]
