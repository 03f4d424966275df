"""Windows over groups of any size: the chunked form gives what one sort per group gives."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventward.operators.cleaning import largest_gaps
from eventward.operators.correlation import related_events
from eventward.operators.ordered import ordered_scan, split_by_group_size
from eventward.operators.rolling import ROLLING_COLUMNS, add_rolling_features
from tests.helpers import brute_related, brute_rolling, event_table, random_rows


def rolled(table, **options):
    rows = add_rolling_features(table, **options).select("ord", *ROLLING_COLUMNS).collect()
    return {r[0]: tuple(r[1:]) for r in rows}


@pytest.mark.parametrize("hot_time", [False, True])
@pytest.mark.parametrize("max_group_rows", [4_000_000, 40])
def test_rolling_equals_brute_force(spark, hot_time, max_group_rows):
    rows = random_rows(7, hot_time=hot_time)
    assert rolled(event_table(spark, rows), max_group_rows=max_group_rows) == brute_rolling(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), seconds=st.sampled_from([5, 400, 20_000]))
def test_rolling_property(spark, seed, seconds):
    rows = random_rows(seed, n=120, seconds=seconds)
    assert rolled(event_table(spark, rows)) == brute_rolling(rows)


def test_rolling_is_causal(spark):
    rows = random_rows(3, n=200)
    cut = sorted(r[1] for r in rows)[100]
    early = [r for r in rows if r[1] < cut]
    whole = rolled(event_table(spark, rows))
    assert rolled(event_table(spark, early)) == {r[0]: whole[r[0]] for r in early}


def test_rolling_without_computer_column(spark):
    rows = random_rows(5, n=60)
    result = rolled(event_table(spark, rows).drop("computer"))
    assert {v[2] for v in result.values()} == {0}
    assert len(result) == 60


def test_scan_chunks_equal_scan_groups(spark):
    rows = [(f"k{i % 2}" if i % 10 else "big", (i * 7919) % 1000, i, i % 5 - 2) for i in range(1000)]
    table = spark.createDataFrame(rows, "k string, t long, ord long, x long")
    columns = dict(sums={"s": "x"}, prev={"p": "ord"}, following={"f": "ord"})
    small = ordered_scan(table, ["k"], ["t", "ord"], **columns)
    large = ordered_scan(table, ["k"], ["t", "ord"], **columns, max_group_rows=50)
    assert sorted(map(tuple, small.select(sorted(small.columns)).collect()), key=str) == sorted(
        map(tuple, large.select(sorted(small.columns)).collect()), key=str
    )


def test_group_sizes_split_rows_whole(spark):
    table = spark.createDataFrame([("a", i) for i in range(30)] + [("b", i) for i in range(3)], "k string, v int")
    sizes = split_by_group_size(table, ["k"], 10)
    assert (sizes.small.count(), sizes.large.count(), sizes.large_rows) == (3, 30, 30)
    assert split_by_group_size(table, ["k"], 100).large is None


def test_largest_gaps_in_chunks(spark, events):
    small = sorted(map(tuple, largest_gaps(events).collect()))
    assert small == sorted(map(tuple, largest_gaps(events, max_group_rows=100).collect()))


@pytest.mark.parametrize("max_group_rows", [4_000_000, 30])
@pytest.mark.parametrize("hot_time", [False, True])
def test_related_events_equal_brute_force(spark, hot_time, max_group_rows):
    rows = random_rows(11, n=300, hot_time=hot_time, seconds=2000)
    detections = [r for r in rows if r[5] != "benign"]
    found = related_events(
        event_table(spark, rows), event_table(spark, detections), max_group_rows=max_group_rows
    )
    got = {(r.ord, r["rank"], r.us, r.related_ord, r.event_id, r.label) for r in found.collect()}
    assert got == brute_related(rows, detections)


def test_related_events_of_foreign_detection(spark):
    """A detection need not be an event of the table; without host or time it has no neighbours."""
    rows = [(1, 1_000_000_000, "h", "u", 1, "a"), (2, 1_300_000_000, "h", "u", 1, "b"), (3, 5_000_000_000, "h", "u", 1, "c")]
    asked = [(9, 1_150_000_000, "h", None, 7, "x"), (10, 1_150_000_000, None, None, 7, "x")]
    found = related_events(event_table(spark, rows), event_table(spark, asked)).collect()
    assert [(r.ord, r["rank"], r.related_ord) for r in found] == [(9, 1, 1), (9, 2, 2)]


def test_related_events_are_symmetric(spark):
    """With room for all, a sees b if and only if b sees a."""
    rows = random_rows(2, n=60, seconds=2000)
    rows = [(o, u, h, w, o, l) for o, u, h, w, _, l in rows]  # event ids all different
    table = event_table(spark, rows)
    pairs = {(r.ord, r.related_ord) for r in related_events(table, table, limit=100).collect()}
    assert pairs == {(b, a) for a, b in pairs} and pairs


def test_related_plan_forms_no_pairs(spark, events):
    plan = related_events(events, events)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_layout_by_user_needs_no_shuffle(spark, tmp_path):
    from eventward.operators.rolling import ROLLING_COLUMNS, add_rolling_features
    from eventward.sources.tables import write_layout
    from tests.helpers import event_table, random_rows

    events = event_table(spark, random_rows(8, n=300, users=20)).drop("us", "split")
    name = write_layout(events, str(tmp_path / "layout"), "subject_user_name", buckets=4)
    rolled = add_rolling_features(spark.table(name), group=(), dealt=True)
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount" in plan
    both = [sorted(map(tuple, df.select("ord", *ROLLING_COLUMNS).collect())) for df in (rolled, add_rolling_features(events, group=()))]
    assert both[0] == both[1] and len(both[0]) == 300
    large = add_rolling_features(spark.table(name), group=(), dealt=True, max_group_rows=10)
    assert sorted(map(tuple, large.select("ord", *ROLLING_COLUMNS).collect())) == both[0]
