"""Steps that must not depend on how many rows there are: no whole table in the driver or in one task."""

import pytest
from pyspark.sql import functions as F

from eventward.operators import detection as forests
from eventward.operators import node_tables, ordered
from eventward.plans import detection as plans
from eventward.plans.queries import QUERIES
from tests.conftest import SF


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_round_trip_joins_without_the_driver(spark):
    plan = plan_of(QUERIES["event_table_round_trip"](spark, SF))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("most", [50_000, 0])
def test_isolated_events_are_scored_once_a_vector(spark, split, monkeypatch, most):
    small = forests.ForestSettings(stage1_trees=5, stage1_depth=5, stage2_trees=5, stage2_depth=5, memory_mb=256)
    detector, _ = plans.train_detector(split, small)
    events = split.limit(30).unionByName(split.limit(30))
    scored_rows = []

    def counted(model, df):
        scored_rows.append(df.count())
        return forests.predict_hierarchical(model, df)

    monkeypatch.setattr(plans, "predict_hierarchical", counted)
    monkeypatch.setattr(plans, "MOST_SENT_VECTORS", most)
    got = plans.score_isolated(events, detector)
    plain = forests.predict_hierarchical(detector.model, plans.isolated_features(events, detector.encoders))
    names = ["ord", "predicted_label", "predicted_tactic", "stage1_confidence", "stage2_confidence", "is_attack"]
    assert got.columns == plain.columns and scored_rows[0] <= 30
    assert sorted(map(repr, got.select(*names).collect())) == sorted(map(repr, plain.select(*names).collect()))


def test_ordinary_groups_fit_a_task():
    """A window sorts and keeps the whole rows of a group, several times over: about 2 KB a row."""
    assert ordered.MAX_GROUP_ROWS * 2_000 <= 1_200_000_000


def test_node_tables_score_without_the_driver(spark, tmp_path, monkeypatch):
    """Neither trees nor rows are broadcast, and many small blocks and parts give what the model gives."""
    rows = spark.range(700).select(
        F.col("id").alias("ord"), *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(97)).cast("double").alias(n) for k, n in enumerate("abc")],
        F.when(F.col("id") % 4 == 0, "benign").when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, "p").otherwise("q").alias("label"),
        F.when(F.col("id") % 4 != 0, "TA0006").alias("mitre_tactic"),
    )
    small = forests.ForestSettings(stage1_trees=7, stage1_depth=6, stage2_trees=5, stage2_depth=6, memory_mb=256, balanced_bootstraps=2)
    model = forests.train_hierarchical(rows, list("abc"), small)
    model.save(spark, str(tmp_path / "model"))
    for name, value in (("BLOCK_ROWS", 16), ("PARTS", 3), ("PART_ROWS", 200), ("BLOCKS_A_TASK", 2), ("NODES_A_TASK", 50)):
        monkeypatch.setattr(node_tables, name, value)
    nodes = node_tables.load_as_nodes(spark, str(tmp_path / "model"))
    assert nodes.stage1.n_trees == 7 == nodes.stage1.trees.count()
    odd = F.when(F.col("ord") % 9 == 0, float("nan")).otherwise(F.col("a"))  # goes right
    rows = rows.withColumn("a", odd)
    assembled = forests.assemble(rows, list("abc"))
    scored = nodes.stage1.score(assembled, "guess", "confidence")
    plan = plan_of(scored)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "CartesianProduct" not in plan
    columns = ["ord", "predicted_label", "predicted_tactic", "stage1_confidence", "stage2_confidence", "is_attack"]
    found = [sorted(map(repr, forests.predict_hierarchical(m, rows).select(*columns).collect())) for m in (model, nodes)]
    assert found[0] == found[1] and len(found[0]) == 700
    none = nodes.stage1.score(assembled.where("ord < 0"), "guess", "confidence")
    assert none.columns == scored.columns and none.count() == 0
