"""Operators on feeds that keep state by key and let it expire: rolling features, first-wins, related events.

All use event time. A watermark moves on with the feed, and timers remove the state of keys that
have become silent. The processors get event times as plain numbers: a column that carries the
watermark would make Spark drop late rows unseen, while here each late row comes out, marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from eventward.catalog import RELATED_LIMIT, WINDOW_SECONDS
from eventward.functions.times import event_micros
from eventward.operators.cleaning import DEDUP_KEY
from eventward.operators.rolling import NO_HOST, ROLLING_COLUMNS, USER
from eventward.session import prepare, ship

#: Rows of an output piece.
PIECE = 10_000
EVENT_TIME = "_event_time"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state(spark: SparkSession) -> None:
    """State with timers needs the RocksDB store, which also keeps it out of the executors' heap."""
    ship(prepare(spark), "eventward")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)


def watermarked(events: DataFrame, delay: str) -> DataFrame:
    """Let the watermark follow `timestamp`; rows without a time do not move it."""
    return events.withColumn(EVENT_TIME, F.col("timestamp").cast("timestamp")).withWatermark(EVENT_TIME, delay)


def _where(rows: DataFrame, condition: Column) -> DataFrame:
    """Filter above the watermark. Spark moves a filter below it unless it reads the event time, and
    then rows that the filter drops, such as signs of life, would not move the watermark."""
    return rows.where(F.when(F.col(EVENT_TIME).isNotNull(), condition))


def _micros():
    """Microseconds of the event time, without the mark that makes Spark drop late rows."""
    return F.unix_micros(EVENT_TIME)


def _pieces(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for start in range(0, len(frame), PIECE):
        yield frame.iloc[start : start + PIECE]


def _present(us: np.ndarray, values: pd.Series, left: np.ndarray, span: int) -> np.ndarray:
    """Distinct values in the trailing window: openings so far less closings at or before its start."""
    times, known = pd.Series(us), values.notna().to_numpy()  # nulls are no values
    by_value = times.groupby(values.to_numpy())
    opens = ~(times - by_value.shift(1) < span).to_numpy() & known
    closes = ~(by_value.shift(-1) - times < span).to_numpy() & known
    closed = np.concatenate([[0], np.cumsum(closes)])
    return np.cumsum(opens) - closed[left]


def roll(rows: pd.DataFrame, last: int | None, recent: list[tuple], span: int) -> tuple[pd.DataFrame, list[tuple]]:
    """Rolling columns of rows in order of (us, ord), none before `last`, behind the `recent` events
    (us, event_id, host) of the window; and the recent events after them."""
    kept = len(recent)
    times = np.concatenate([np.array([r[0] for r in recent], np.int64), rows["us"].to_numpy(np.int64)])
    ids = pd.Series([r[1] for r in recent] + rows["event_id"].tolist(), dtype=object)
    hosts = pd.Series([r[2] for r in recent] + rows["host"].tolist(), dtype=object)
    left = np.searchsorted(times, times - span, side="right")
    before = np.concatenate([[np.nan if last is None else last], times[kept:-1].astype(float)])
    out = pd.DataFrame({"ord": rows["ord"].to_numpy(), "late": False})
    out[ROLLING_COLUMNS[0]] = (np.arange(1, len(times) + 1) - left)[kept:]
    out[ROLLING_COLUMNS[1]] = _present(times, ids, left, span)[kept:]
    out[ROLLING_COLUMNS[2]] = _present(times, hosts, left, span)[kept:]
    out[ROLLING_COLUMNS[3]] = (times[kept:] - before) / 1e6
    stay = np.flatnonzero(times > times[-1] - span)
    return out, [(int(times[i]), None if pd.isna(ids[i]) else int(ids[i]), hosts[i]) for i in stay]


class RollingFeatures(StatefulProcessor):
    """Per user the time of the last event, and the events of the last window.

    The events go when the watermark has passed their window, the time when it has passed
    `forget` behind it: only after that a returning user counts as new.
    """

    def __init__(self, span: int, forget: int):
        self.span, self.forget = span, forget

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us bigint")
        self.recent = handle.getListState("recent", "us bigint, event_id int, host string")

    def _ends(self, last: int) -> list[int]:
        return [(last + keep) // 1000 + 1 for keep in (self.span, self.forget)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.last.get()
        last = state[0] if state else None
        floor = max(timerValues.getCurrentWatermarkInMs() * 1000, -(2**63) if last is None else last)
        narrow, late = [], []
        # Pieces of bounded size, each at once made as narrow as the columns are; late rows go out directly.
        for piece in rows:
            on_time = piece["us"] >= floor
            narrow.append(piece.loc[on_time, ["ord", "us", "event_id", "host"]].astype({"host": "category"}))
            late = piece.loc[~on_time, ["ord"]]
            if len(late):
                yield self._late(late)
        mine = pd.concat([p.astype({"host": object}) for p in narrow], ignore_index=True)
        if not len(mine):
            return
        mine = mine.sort_values(["us", "ord"], ignore_index=True)
        out, recent = roll(mine, last, list(self.recent.get()), self.span)
        if last is not None:
            for end in self._ends(last):
                self.handle.deleteTimer(end)
        self.last.update((recent[-1][0],))
        self.recent.put(recent)
        for end in self._ends(recent[-1][0]):
            self.handle.registerTimer(end)
        yield from _pieces(out)

    @staticmethod
    def _late(rows: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"ord": rows["ord"].to_numpy(), "late": True})
        for c in ROLLING_COLUMNS[:3]:
            out[c] = pd.Series(pd.NA, index=out.index, dtype="Int64")
        out[ROLLING_COLUMNS[3]] = np.nan
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.last.get()
        if state:
            window_end, end = self._ends(state[0])
            if expiredTimerInfo.getExpiryTimeInMs() >= window_end:
                self.recent.clear()
            if expiredTimerInfo.getExpiryTimeInMs() >= end:
                self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def rolling_features_stream(
    events: DataFrame, seconds: int = WINDOW_SECONDS, delay: str = "10 minutes", forget_days: float = 30
) -> DataFrame:
    """The four rolling columns on a feed: (ord, late, ...) per event with a user and a time.

    A row is late, and gets no values, if it is older than its user's last event of an earlier
    micro-batch, or than the watermark, which is `delay` behind the newest event; rows of one
    micro-batch come in any order. State of a silent user shrinks to one number after the window
    and goes after `forget_days`. A user's rows of one micro-batch meet in one task, four narrow
    columns of them, read in pieces; the source's rate limit bounds them. Rows without a user or
    a time need no state and get the fixed values.
    """
    keep_state(events.sparkSession)
    known = F.col(USER).isNotNull() & F.col("timestamp").isNotNull()
    schema = T.StructType(
        [T.StructField("ord", T.LongType()), T.StructField("late", T.BooleanType())]
        + [T.StructField(c, T.LongType()) for c in ROLLING_COLUMNS[:3]]
        + [T.StructField(ROLLING_COLUMNS[3], T.DoubleType())]
    )
    rows = _where(watermarked(events, delay), known).select(
        "ord", USER, _micros().alias("us"), "event_id", F.coalesce("computer", F.lit(NO_HOST)).alias("host")
    )
    keyed = rows.groupBy(USER).transformWithStateInPandas(
        RollingFeatures(seconds * 1_000_000, int(forget_days * 86_400_000_000)), schema, "append", "EventTime"
    )
    alone = events.where(~known).select(
        "ord", F.lit(False).alias("late"), F.lit(1).cast("long").alias(ROLLING_COLUMNS[0]),
        F.lit(1).cast("long").alias(ROLLING_COLUMNS[1]), F.lit(0).cast("long").alias(ROLLING_COLUMNS[2]),
        F.lit(None).cast("double").alias(ROLLING_COLUMNS[3]),
    )
    return keyed.unionByName(alone)


VERDICT = "verdict"
KEPT, DUPLICATE, LATE = "kept", "duplicate", "late"


#: Keys are dealt by hash to so many buckets, which have their state and are judged together: a call, a
#: state and a timer for each key would cost far more than the rows. The number is part of the state.
KEY_BUCKETS = 1024
#: Pieces of a bucket's state that are made one when there are more.
MOST_PIECES = 8


def _to_bytes(frame: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


class _Pieces:
    """Rows in a list state, a piece for each micro-batch that added some."""

    def __init__(self, handle, name: str):
        self.state = handle.getListState(name, "piece binary")

    def read(self) -> tuple[pd.DataFrame | None, int]:
        """The rows, or None, and the number of pieces that they are in."""
        tables = [pa.ipc.open_stream(bytes(piece)).read_all() for (piece,) in self.state.get()]
        whole = pa.concat_tables(tables, promote_options="default").to_pandas() if tables else None
        return whole, len(tables)

    def add(self, rows: pd.DataFrame) -> None:
        self.state.appendValue((_to_bytes(rows),))

    def replace(self, rows: pd.DataFrame) -> None:
        if len(rows):
            self.state.put([(_to_bytes(rows),)])
        else:
            self.state.clear()


class _Alarm:
    """One timer of a group, for the first of the times that it waits for."""

    def __init__(self, handle):
        self.handle, self.due = handle, handle.getValueState("due", "ms bigint")

    def by(self, ms: int) -> None:
        state = self.due.get()
        if state is not None and state[0] <= ms:
            return
        if state is not None:
            self.handle.deleteTimer(state[0])
        self.due.update((ms,))
        self.handle.registerTimer(ms)

    def rang(self, timerValues, expiredTimerInfo) -> int:
        """Times up to this one are over."""
        self.due.clear()
        return max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)


class FirstWins(StatefulProcessor):
    """Of a bucket's keys the times of their first rows, until the watermark has passed them."""

    def init(self, handle) -> None:
        self.known, self.alarm = _Pieces(handle, "known"), _Alarm(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, pieces = self.known.read()
        names = pd.Index(known["key"]) if known is not None else pd.Index([], dtype=object)
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        # The first of a new key's rows on time wins; one row of each is held, losers go out as they come.
        best = None
        for piece in rows:
            old = piece["judged_name"].isin(names)
            late = ~old & (piece["us"] < watermark)
            for verdict, which in ((DUPLICATE, old), (LATE, late)):
                if which.any():
                    yield self._judged(piece[which], verdict)
            piece = piece[~old & ~late]
            if not len(piece):
                continue
            piece = pd.concat([best, piece], ignore_index=True) if best is not None else piece
            piece = piece.sort_values("ord", kind="stable", ignore_index=True)
            lost = piece["judged_name"].duplicated()
            if lost.any():
                yield self._judged(piece[lost], DUPLICATE)
            best = piece[~lost]
        if best is None:
            return
        new = pd.DataFrame({"key": best["judged_name"].to_numpy(), "ms": best["us"].to_numpy(np.int64) // 1000 + 1})
        if pieces < MOST_PIECES:
            self.known.add(new)
        else:
            self.known.replace(pd.concat([known, new], ignore_index=True))
        self.alarm.by(int(new["ms"].min()))
        for part in _pieces(best):
            yield self._judged(part, KEPT)

    @staticmethod
    def _judged(rows: pd.DataFrame, verdict: str) -> pd.DataFrame:
        return rows.drop(columns=["us", "judged_name", "judged_bucket"], errors="ignore").assign(**{VERDICT: verdict})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over, (known, _) = self.alarm.rang(timerValues, expiredTimerInfo), self.known.read()
        if known is not None:
            left = known[known["ms"] > over]
            self.known.replace(left)
            if len(left):
                self.alarm.by(int(left["ms"].min()))
        return iter(())

    def close(self) -> None:
        pass


def first_wins_stream(events: DataFrame, delay: str, key: tuple[str, ...] = DEDUP_KEY) -> DataFrame:
    """Every event with a `verdict`: kept, duplicate or late; no row is lost.

    Of rows with one key the smallest `ord` of the micro-batch that first has the key is kept, and
    rows of later micro-batches are duplicates. A key is remembered until the watermark, `delay` behind the newest event, has passed its first event;
    `delay` must cover the time over which copies arrive. A row older than the watermark whose key
    is not remembered is late: it cannot be told from a copy. Rows without record id or time are
    kept as they come. Writing with `partition_by=("verdict",)` gives the survivors and the
    quarantine as two tables of one sink.
    """
    spark = events.sparkSession
    keep_state(spark)
    names = [c for c in events.columns if c != VERDICT]
    types = {c: t for c, t in events.dtypes}
    known = F.col(key[-1]).isNotNull() & F.col("timestamp").isNotNull()
    # A key's parts with their lengths, so that no two keys have one name. Names that begin with _ do not reach Python.
    parts = [F.col(c).cast("string") for c in key]
    name = F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])
    # Values cross to Python as text and back, so that whole numbers and times with nulls stay what they are.
    rows = _where(watermarked(events, delay), known).select(
        *[F.col(c) if c == "ord" else F.col(c).cast("string").alias(c) for c in names], _micros().alias("us"), name.alias("judged_name"),
    ).withColumn("judged_bucket", F.pmod(F.xxhash64("judged_name"), F.lit(KEY_BUCKETS)))
    fields = [T.StructField(c, T.LongType() if c == "ord" else T.StringType()) for c in names]
    fields += [T.StructField(VERDICT, T.StringType())]
    judged = rows.groupBy("judged_bucket").transformWithStateInPandas(FirstWins(), T.StructType(fields), "append", "EventTime")
    judged = judged.select(*[F.col(c).cast(types[c]).alias(c) for c in names], VERDICT)
    alone = events.where(~known).select(*names, F.lit(KEPT).alias(VERDICT))
    return judged.unionByName(alone)


#: A stretch of a host's time is as long as so many windows.
STRETCH = 12
_NONE = -(2**63)  # stands for null where numbers cross to Python


def shown_rows(rows: pd.DataFrame, limit: int) -> pd.DataFrame:
    """The rows that a detection can show, in order of (us, related_ord).

    It skips the rows of its own time and event id and shows `limit` rows: of one event id at one time
    only the first `limit` can be among them, and of one time only the first 2 * limit of those.
    """
    rows = rows.sort_values(["us", "related_ord"], kind="stable")
    rows = rows[rows.groupby(["us", "event_id"]).cumcount() < limit]
    return rows[rows.groupby("us").cumcount() < 2 * limit].reset_index(drop=True)


def first_related(asked: pd.DataFrame, seen: pd.DataFrame, span: int, limit: int) -> pd.DataFrame:
    """The first `limit` rows of `shown_rows` for each detection, with their rank."""
    times, ids = seen["us"].to_numpy(np.int64), seen["event_id"].to_numpy(np.int64)
    at = asked["us"].to_numpy(np.int64)[:, None]
    # At most `limit` rows have the detection's time and event id, so the answer is in twice as many rows.
    slot = np.searchsorted(times, at - span, side="left") + np.arange(2 * limit)
    there = slot < len(times)
    slot = np.where(there, slot, 0)
    own = (times[slot] == at) & (ids[slot] == asked["event_id"].to_numpy(np.int64)[:, None])
    fits = there & (times[slot] <= at + span) & ~own
    fits &= np.cumsum(fits, axis=1) <= limit
    who, _ = np.nonzero(fits)
    out = seen.iloc[slot[fits]].reset_index(drop=True)
    out.insert(0, "ord", asked["ord"].to_numpy(np.int64)[who])
    out = out.sort_values(["ord", "us", "related_ord"], kind="stable", ignore_index=True)
    out.insert(1, "rank", out.groupby("ord").cumcount() + 1)
    return out[out["rank"] <= limit]


class FirstRelated(StatefulProcessor):
    """The detections of a host in one stretch of time and the events within their reach; answers come out
    when the watermark has passed their window."""

    def __init__(self, span: int, limit: int):
        self.span, self.limit = span, limit

    def init(self, handle) -> None:
        self.seen, self.asked, self.alarm = _Pieces(handle, "seen"), _Pieces(handle, "asked"), _Alarm(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new, asked = None, []
        for piece in rows:
            asks = piece.loc[piece["asks"], ["ord", "us", "event_id"]]
            if len(asks):
                asked.append(asks)
            piece = piece[["us", "ord", "event_id", "label"]].rename(columns={"ord": "related_ord"})
            new = shown_rows(piece if new is None else pd.concat([new, piece], ignore_index=True), self.limit)
        if len(self._stored(self.seen, new)) > 0:
            self.alarm.by(self._end(key))
        if asked:
            asked = pd.concat(asked, ignore_index=True)
            self.asked.add(asked)
            self.alarm.by((int(asked["us"].min()) + self.span) // 1000 + 1)
        return iter(())

    def _end(self, key) -> int:
        """When no window of this stretch is open any more."""
        return ((int(key[1]) + 1) * STRETCH * self.span + self.span) // 1000 + 1

    def _stored(self, pieces: _Pieces, new: pd.DataFrame) -> pd.DataFrame:
        """Rows are kept as pieces, of which many are made one."""
        before, number = pieces.read()
        if number < MOST_PIECES:
            pieces.add(new)
            return new
        whole = shown_rows(pd.concat([before, new], ignore_index=True), self.limit)
        pieces.replace(whole)
        return whole

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = self.alarm.rang(timerValues, expiredTimerInfo)
        (asked, _), (seen, _) = self.asked.read(), self.seen.read()
        waits = np.array([], np.int64)
        if asked is not None:
            ends = (asked["us"].to_numpy(np.int64) + self.span) // 1000 + 1
            due = ends <= over
            waits = ends[~due]
            if due.any():
                self.asked.replace(asked[~due])
                out = first_related(asked[due], shown_rows(seen, self.limit), self.span, self.limit)
                yield from _pieces(out[["ord", "rank", "us", "related_ord", "event_id", "label"]])
        if self._end(key) <= over:
            self.seen.state.clear()
            self.asked.state.clear()
        else:
            self.alarm.by(min([*waits.tolist(), self._end(key)]))

    def close(self) -> None:
        pass


def related_events_stream(
    events: DataFrame, is_detection: Column, delay: str = "10 minutes", seconds: int = WINDOW_SECONDS, limit: int = RELATED_LIMIT
) -> DataFrame:
    """For each detection of a feed the first `limit` other events of its host within +- `seconds`.

    `is_detection` tells which events ask; rare detections do not hold the watermark back. No pairs are
    formed: a host's time is cut into stretches, an event goes to each that has it within reach, and a
    stretch keeps what its detections can show (`shown_rows`) until their windows are over. A detection comes out when the watermark has passed its window, with the same rows as
    `related_events` in batch; rows older than the watermark find nothing. Detections without host or
    time have no related events.
    """
    keep_state(events.sparkSession)
    span = seconds * 1_000_000
    placed = F.col("computer").isNotNull() & (F.col("computer") != "")
    none = F.lit(_NONE).cast("long")
    # The watermark's column goes along, so that Spark drops the rows that come too late.
    rows = _where(watermarked(events, delay), placed).select(
        EVENT_TIME, F.col("computer").alias("_host"), F.coalesce("ord", none).alias("ord"), _micros().alias("us"),
        F.coalesce(F.col("event_id").cast("long"), none).alias("event_id"), "label",
        F.coalesce(is_detection, F.lit(False)).alias("_asks"),
    )
    length = STRETCH * span
    stretch = lambda us: F.expr(f"({us} - pmod({us}, {length}L)) div {length}L")
    reached = F.array_distinct(F.array(stretch(f"(us - {span}L)"), stretch("us"), stretch(f"(us + {span}L)")))
    rows = rows.withColumn("_stretch", F.explode(reached)).select(
        EVENT_TIME, "_host", "_stretch", "ord", "us", "event_id", "label", (F.col("_asks") & (F.col("_stretch") == stretch("us"))).alias("asks")
    )
    schema = "ord bigint, rank int, us bigint, related_ord bigint, event_id bigint, label string"
    found = rows.groupBy("_host", "_stretch").transformWithStateInPandas(FirstRelated(span, limit), schema, "append", "EventTime")
    number = lambda c: F.when(F.col(c) != none, F.col(c))
    return found.select(
        number("ord").alias("ord"), "rank", "us", number("related_ord").alias("related_ord"),
        number("event_id").cast("int").alias("event_id"), "label",
    )
