"""Feeds with state by key: equal to the batch operators, with every late row accounted for."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventward.operators.cleaning import deduplicate
from eventward.operators.correlation import related_events
from eventward.operators.rolling import ROLLING_COLUMNS, add_rolling_features
from eventward.session import scratch_path
from eventward.streaming import feeds, keyed
from tests.helpers import event_table, random_rows


def feed(spark, folder, parts):
    """A feed with one file for each of `parts`, in this order."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def rows_of(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture
def in_time_order(spark):
    rows = sorted(random_rows(21, n=200, seconds=1500), key=lambda r: r[1])
    return event_table(spark, [(i, *r[1:]) for i, r in enumerate(rows)])


def cut(table, n, width):
    return [table.where(f"ord >= {width * k} AND ord < {width * (k + 1)}") for k in range(n)]


@pytest.mark.parametrize("piece", [10_000, 7])
def test_rolling_equals_batch(spark, in_time_order, tmp_path, piece):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", piece)
    try:
        stream = feed(spark, tmp_path / "feed", cut(in_time_order, 4, 50))
        got = feeds.run_to_table(keyed.rolling_features_stream(stream), "t-rolling")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    assert got.where("late").count() == 0
    batch = add_rolling_features(in_time_order)
    assert rows_of(got, "ord", *ROLLING_COLUMNS) == rows_of(batch, "ord", *ROLLING_COLUMNS)


def test_rolling_marks_late_rows(spark, tmp_path):
    second = 1_000_000
    rows = [
        (1, 2000 * second, "h", "u", 1, "a"), (2, 1000 * second, "h", "u", 1, "a"), (3, 2100 * second, "h", "u", 2, "a"),
        (4, 9000 * second, "h", "v", 1, "a"), (5, 2200 * second, "h", "w", 1, "a"), (6, 9100 * second, "h", "u", 1, "a"),
    ]
    stream = feed(spark, tmp_path / "late", [event_table(spark, [row]) for row in rows])
    got = {r.ord: r for r in feeds.run_to_table(keyed.rolling_features_stream(stream), "t-late").collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    # 2 is older than its user's last event; 5 is the first of its user, but older than the watermark.
    assert [i for i in got if got[i].late] == [2, 5] and got[2].events_last_5min_user is None
    assert got[3].events_last_5min_user == 2 and got[3].seconds_since_prev_event_user == 100.0
    assert got[6].events_last_5min_user == 1 and got[6].seconds_since_prev_event_user == 7000.0


def test_rolling_state_of_silent_users_goes(spark, tmp_path):
    day = 86_400_000_000
    rows = [(1, 0, "h", "u", 1, "a"), (2, 3 * day, "h", "v", 1, "a"), (3, 3 * day + 1, "h", "v", 1, "a"), (4, 3 * day + 2, "h", "u", 1, "a")]
    parts = [event_table(spark, [row]) for row in rows]
    state = scratch_path(spark, "t-state")
    stream = feed(spark, tmp_path / "silent", parts[:3])
    rolled = keyed.rolling_features_stream(stream, forget_days=1)
    out = str(tmp_path / "out")
    feeds.write_stream(rolled, out, state).awaitTermination()
    for name in ("recent", "last"):
        kept = spark.read.format("statestore").option("stateVarName", name).load(state)
        assert {r.key[0] for r in kept.select("key").collect()} == {"v"}, name
    # The returning user counts as new.
    feed(spark, tmp_path / "silent", parts[3:])
    feeds.write_stream(keyed.rolling_features_stream(stream, forget_days=1), out, state).awaitTermination()
    back = spark.read.parquet(out).where("ord = 4").first()
    assert (back.late, back.events_last_5min_user, back.seconds_since_prev_event_user) == (False, 1, None)


def test_roll_takes_null_ids():
    rows = pd.DataFrame({"ord": [1, 2, 3], "us": [0, 1_000_000, 2_000_000], "event_id": [4624, None, 4624], "host": ["a", "a", "b"]})
    found, recent = keyed.roll(rows, None, [], 300_000_000)
    assert found[ROLLING_COLUMNS[0]].tolist() == [1, 2, 3] and found[ROLLING_COLUMNS[1]].tolist() == [1, 1, 1]
    assert [r[1] for r in recent] == [4624, None, 4624]
    later, _ = keyed.roll(rows.assign(us=rows["us"] + 5_000_000), 2_000_000, recent, 300_000_000)
    assert later[ROLLING_COLUMNS[0]].tolist() == [4, 5, 6]


KEYED = "ord bigint, timestamp timestamp_ntz, source_file string, record_id string, logon_type int, verdict string"


def keyed_events(spark, rows):
    time = F.expr("cast(timestamp_seconds(us) AS timestamp_ntz)")
    df = spark.createDataFrame(rows, "ord bigint, us bigint, source_file string, record_id string, logon_type int")
    return df.select("ord", time.alias("timestamp"), "source_file", "record_id", "logon_type", F.lit("mine").alias("verdict"))


@pytest.mark.parametrize("piece", [10_000, 2])
def test_first_wins_equals_batch(spark, tmp_path, piece):
    rows = [(i, 1000 + i, f"f{i % 2}", None if i % 9 == 0 else str(i % 40 // 2), None if i % 3 else i) for i in range(200)]
    table = keyed_events(spark, rows)
    shuffled = [p.orderBy(F.md5(F.col("ord").cast("string"))) for p in cut(table, 4, 50)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", piece)
    try:
        got = feeds.run_to_table(keyed.first_wins_stream(feed(spark, tmp_path / "dup", shuffled), "1 hour"), "t-first", ("verdict",))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    names = ["ord", "timestamp", "source_file", "record_id", "logon_type"]
    assert rows_of(got.where("verdict = 'kept'"), *names) == rows_of(deduplicate(table), *names)
    assert rows_of(got, *names) == rows_of(table, *names)
    assert got.where("verdict = 'late'").count() == 0


def test_first_wins_sets_late_rows_aside(spark, tmp_path):
    rows = [
        [(1, 10_000, "f", "a", 1), (2, 10_001, "f", "a", 2), (3, 10_000, None, "a", 3)],
        [(4, 20_000, "f", "b", 4)],
        [(5, 10_000, "f", "a", 5), (6, 9_000, "f", "c", 6), (7, 20_000, "f", "b", 7), (8, 1, "f", None, 8)],
        [(9, 10_000, "f", "a", 9)],
    ]
    stream = feed(spark, tmp_path / "late", [keyed_events(spark, part) for part in rows])
    got = feeds.run_to_table(keyed.first_wins_stream(stream, "1 hour"), "t-late", ("verdict",))
    assert {r.ord: r.verdict for r in got.collect()} == {
        1: "kept", 2: "duplicate", 3: "kept", 4: "kept", 5: "duplicate", 6: "late", 7: "duplicate", 8: "kept", 9: "late"
    }


def test_related_events_equal_batch(spark, in_time_order, tmp_path):
    closing = event_table(spark, [(1000, 2 * 10**15, "nowhere", "u", 1, "a")])
    stream = feed(spark, tmp_path / "feed", [*cut(in_time_order, 4, 50), closing])
    asked = "ord % 3 = 0 AND ord < 1000"
    got = feeds.run_to_table(keyed.related_events_stream(stream, F.expr(asked)), "t-related")
    batch = related_events(in_time_order, in_time_order.where(asked))
    names = ["ord", "rank", "us", "related_ord", "event_id", "label"]
    assert rows_of(got, *names) == rows_of(batch, *names) and got.count() > 100


class _Value:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class _List(_Value):
    def get(self):
        return iter(self.value or [])

    def put(self, value):
        self.value = value

    def appendValue(self, value):
        self.value = [*(self.value or []), value]


class _Handle:
    """State and timers of one group."""

    def __init__(self):
        self.timers = set()

    def getValueState(self, name, schema):
        return _Value()

    def getListState(self, name, schema):
        return _List()

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)


class _Times:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_first_wins_judges_many_keys_in_one_call():
    """A call, a state and a timer for each key cost more than the rows."""
    wins, handle = keyed.FirstWins(), _Handle()
    wins.init(handle)

    def judged(rows, watermark=0):
        frame = pd.DataFrame(rows, columns=["ord", "us", "judged_name"]).assign(judged_bucket=0)
        out = pd.concat(wins.handleInputRows((0,), iter([frame[:2], frame[2:]]), _Times(watermark)))
        return dict(zip(out["ord"], out["verdict"]))

    assert judged([(3, 5_000, "a"), (2, 9_000, "b"), (1, 5_000, "a"), (4, 9_000, "b")]) == {3: "duplicate", 2: "kept", 1: "kept", 4: "duplicate"}
    assert len(handle.timers) == 1
    assert judged([(5, 5_000, "a"), (6, 7_000, "c"), (7, 8_000, "d")], 8) == {5: "duplicate", 6: "late", 7: "kept"}
    assert list(wins.handleExpiredTimer((0,), _Times(7), _Times(7))) == []
    assert sorted(wins.known.read()[0]["key"]) == ["b", "d"]
    for n in range(20):
        judged([(100 + n, 10**6, f"k{n}"), (200 + n, 10**6, f"k{n}")])
    known, pieces = wins.known.read()
    assert len(known) == 22 and pieces <= keyed.MOST_PIECES


def test_first_related_without_pairs():
    """A hot moment is kept in as many rows as a detection can show; answers are those of brute force."""
    rng, span, limit = np.random.default_rng(3), 300, 6
    rows = pd.DataFrame({
        "us": rng.integers(0, 40, 4000) * 50, "related_ord": rng.permutation(4000), "event_id": rng.integers(0, 3, 4000), "label": "x",
    })
    kept = keyed.shown_rows(rows, limit)
    assert len(kept) <= 40 * 2 * limit
    asked = rows.sample(200, random_state=1).rename(columns={"related_ord": "ord"})
    got = keyed.first_related(asked, kept, span, limit)
    for one in asked.itertuples():
        near = rows[(rows["us"] >= one.us - span) & (rows["us"] <= one.us + span) & ~((rows["us"] == one.us) & (rows["event_id"] == one.event_id))]
        want = near.sort_values(["us", "related_ord"]).head(limit)
        mine = got[got["ord"] == one.ord]
        assert mine["related_ord"].tolist() == want["related_ord"].tolist() and mine["rank"].tolist() == list(range(1, len(want) + 1))
