"""Versions of a model on a feed, bounded fits, forests on any number of cores, profiles of days."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from eventward.operators import detection as D
from eventward.operators import profiles
from eventward.plans import detection as plans
from eventward.plans.registry import VERSION, ModelRegistry, score_with_latest
from tests.test_features_detection import SMALL


def test_a_feed_takes_up_new_versions(spark, split, tmp_path):
    detector, _ = plans.train_detector(split, SMALL)
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    assert registry.versions() == []
    folder, out, state = (str(tmp_path / name) for name in ("feed", "out", "state"))
    events = split.drop("split").where("ord < 90").cache()
    for part in range(3):
        events.where(f"ord % 3 = {part}").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    with pytest.raises(Exception, match="no detector published"):
        score_with_latest(stream, registry, out, state).awaitTermination()
    assert registry.publish(detector) == 1
    load, loaded = registry.load, []

    def publish_between_batches(version):
        found = load(version)
        loaded.append(version)
        if len(loaded) == 1:  # while the first micro-batch is scored, a second version appears
            ModelRegistry(spark, registry.path).publish(detector)
        return found

    registry.load = publish_between_batches
    score_with_latest(stream, registry, out, state).awaitTermination()
    rows = spark.read.parquet(out)
    assert loaded == [1, 2, 2]
    assert {(r.batch, r[VERSION]) for r in rows.select("batch", VERSION).distinct().collect()} == {(0, 1), (1, 2), (2, 2)}
    assert sorted(r.ord for r in rows.collect()) == sorted(r.ord for r in events.collect())
    assert "computer" not in rows.columns


def test_a_fit_is_bounded_by_label(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("ord"), F.when(F.col("id") < 2900, "often").when(F.col("id") < 2990, "rare").alias("label")
    )
    counts = {r.label: r["count"] for r in D.bounded_rows(rows, 500, 42).groupBy("label").count().collect()}
    assert counts["rare"] == 90 and counts[None] == 10 and 430 < counts["often"] < 570
    again = D.bounded_rows(rows.repartition(7), 500, 42)
    assert again.exceptAll(D.bounded_rows(rows, 500, 42)).count() == 0


def test_a_fit_takes_every_row(spark, monkeypatch):
    """Training draws no rows: each fit sees all of its stage's rows, however many a label has."""
    label = F.when(F.col("id") % 10 < 8, "benign").when(F.col("id") % 10 == 8, "p").otherwise("q")
    rows = spark.range(2000).select(
        F.col("id").alias("ord"), (F.col("id") % 10).cast("double").alias("a"), label.alias("label"),
        F.when(label != "benign", "TA0006").alias("mitre_tactic"),
    )
    fit, seen = D._fit_forest, []

    def counted(df, *args, **settings):
        seen.append(df.count())
        return fit(df, *args, **settings)

    def drawn(*args, **settings):
        raise AssertionError("a fit draws its rows")

    monkeypatch.setattr(D, "_fit_forest", counted)
    monkeypatch.setattr(D, "bounded_rows", drawn)
    assert not [name for name in vars(D.ForestSettings()) if name.startswith("most_")]
    D.train_hierarchical(rows, ["a"], SMALL, balanced=())
    assert seen == [2000, 400]


def test_rows_of_a_fit_are_dealt_to_enough_tasks(spark, monkeypatch):
    """Without a bound on rows, tasks must not grow with them."""
    rows = spark.range(2000).selectExpr("id AS ord", "id % 10 + 0D AS a", "'benign' AS label", "CAST(NULL AS string) AS mitre_tactic")
    deal, parts = D.spread, []

    def dealt(df, partitions):
        parts.append(partitions)
        return deal(df, partitions)

    monkeypatch.setattr(D, "spread", dealt)
    rows = D.assemble(rows, ["a"])
    D.train_stage1(rows, ["a"], SMALL)
    monkeypatch.setattr(D, "PARTITION_ROWS", 50)
    D.train_stage1(rows, ["a"], SMALL)
    assert parts == [SMALL.partitions, 40]


TREES = """
import json, sys
from pyspark.sql import SparkSession, functions as F
from eventward.operators import detection as D
spark = SparkSession.builder.master(sys.argv[1]).config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
noise = lambda k: F.pmod(F.hash("id", F.lit(k)), F.lit(97)).cast("double")
label = F.when(F.col("id") % 4 == 0, "benign").when(noise(1) < 40, "p").otherwise("q")
rows = spark.range(600).select(F.col("id").alias("ord"), noise(1).alias("a"), noise(2).alias("b"), label.alias("label"),
    F.when(label != "benign", "TA0006").alias("mitre_tactic"))
model = D.train_hierarchical(rows, ["a", "b"], D.ForestSettings(stage1_trees=4, stage2_trees=3, stage1_depth=5, stage2_depth=5, partitions=8))
print(json.dumps([model.stage1.model.toDebugString.split(chr(10), 1)[1], model.forests["TA0006"].model.toDebugString.split(chr(10), 1)[1]]))
"""


def test_trees_do_not_depend_on_cores(tmp_path):
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = []
    clean = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK", "PYSPARK", "_PYSPARK"))}
    for master in ("local[1]", "local[4]"):
        run = subprocess.run(
            [sys.executable, "-c", TREES, master, str(tmp_path / f"cores{master[6]}")],
            capture_output=True, text=True, cwd=home, timeout=300, env=clean | {"PYTHONPATH": home},
        )
        assert run.returncode == 0, run.stderr[-3000:]
        found.append(json.loads(run.stdout.strip().splitlines()[-1]))
    assert found[0] == found[1] and "If (feature" in found[0][0]


def test_bootstraps_balance_rare_classes(spark, tmp_path):
    """Skewed and overlapping classes: weights per bootstrap find the rare one as often as weights for all, or more."""
    noise = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000
    rare = F.col("id") % 100 == 0
    rows = spark.range(6000).select(
        F.col("id").alias("ord"), (noise(1) + F.when(rare, 0.8).otherwise(0)).alias("a"), noise(2).alias("b"),
        F.when(rare, "rare").otherwise("often").alias("label"), F.lit("TA0006").alias("mitre_tactic"),
    )
    settings = D.ForestSettings(stage2_trees=12, stage2_depth=4, balanced_bootstraps=4, partitions=8)
    rows = D.assemble(rows, ["a", "b"]).cache()
    train, test = rows.where("ord % 200 < 100"), rows.where("ord % 200 >= 100")

    def recall(forest):
        scored = forest.score(test, "guess", "confidence")
        return scored.where("label = 'rare'").agg(F.avg((F.col("guess") == "rare").cast("double"))).first()[0]

    _, balanced = D.train_stage2(train, ["a", "b"], settings)
    weighted = train.join(D.class_weights(train, "label").select("label", "weight"), "label")
    once = D._fit_forest(weighted, "label", 12, 4, 1, settings, "weight")
    _, plain = D.train_stage2(train, ["a", "b"], settings, balanced=())
    assert balanced["TA0006"].model.getNumTrees == 12
    assert recall(balanced["TA0006"]) >= recall(once) - 0.02 and recall(balanced["TA0006"]) > recall(plain["TA0006"])
    drawn = rows.agg(*[F.avg(D._drawn(42, k)).alias(f"m{k}") for k in range(3)]).first()
    assert all(0.95 < m < 1.05 for m in drawn)
    balanced["TA0006"].model.write().overwrite().save(str(tmp_path / "forest"))
    loaded = D.Forest(type(balanced["TA0006"].model).load(str(tmp_path / "forest")), balanced["TA0006"].classes)
    assert recall(loaded) == recall(balanced["TA0006"])


def test_node_tables_score_like_the_model(spark, split, tmp_path):
    from eventward.operators.node_tables import NodeForest, load_as_nodes, read_nodes

    detector, table = plans.train_detector(split, SMALL)
    detector.model.save(spark, str(tmp_path / "model"))
    nodes = load_as_nodes(spark, str(tmp_path / "model"))
    assert isinstance(nodes.stage1, NodeForest) and set(nodes.forests) == set(detector.model.forests)
    assert nodes.stage1.n_trees == SMALL.stage1_trees and nodes.stage1.depth == SMALL.stage1_depth
    columns = ["ord", "predicted_label", "predicted_tactic", "stage1_confidence", "stage2_confidence", "is_attack"]
    found = [sorted(map(tuple, D.predict_hierarchical(m, table).select(*columns).collect())) for m in (detector.model, nodes)]
    assert found[0] == found[1] and len(found[0]) == table.count()
    shares = read_nodes(spark, str(tmp_path / "model" / "stage1")).select(F.expr("aggregate(shares, 0D, (a, x) -> a + x)")).collect()
    assert all(abs(r[0] - 1) < 1e-9 for r in shares)


def test_profiles_unite_like_one_pass(spark, tmp_path):
    events = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("label"),
        F.expr("cast(timestamp_seconds(1700000000 + id * 13) AS timestamp_ntz)").alias("timestamp"),
        F.concat(F.lit("h"), F.col("id") % 5000).alias("computer"), F.lit(None).cast("string").alias("subject_user_name"),
        (F.col("id") % 7).cast("int").alias("event_id"),
    )
    path = str(tmp_path / "days")
    days = [r[0] for r in events.select(F.to_date("timestamp")).distinct().collect()]
    for day in days:
        profiles.write_days(events.where(F.to_date("timestamp") == F.lit(day)), path)
    united = {r.label: r for r in profiles.figures(profiles.unite(profiles.read_days(spark, path), "label")).collect()}
    assert len(days) > 5 and {k: r.n_events for k, r in united.items()} == {"a": 13334, "b": 26666}
    for row in united.values():
        assert abs(row.hosts - 5000) < profiles.DISTINCT_ERROR * 5000 and row.event_ids == 7 and row.users == 0
    seconds = sorted(r[0] for r in events.where("label = 'b'").select(profiles.second_of_day()).collect())
    rank = sum(s <= united["b"].second_50 for s in seconds) / len(seconds)
    assert abs(rank - 0.5) < profiles.RANK_ERROR + 0.001
