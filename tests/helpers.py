"""Small event tables and brute-force answers."""

import random

EVENT_FIELDS = "ord long, timestamp timestamp_ntz, computer string, subject_user_name string, event_id int, label string"
MINUTES_5 = 300_000_000


def random_rows(seed, n=400, users=3, hosts=3, seconds=3000, hot_time=False):
    """Rows as (ord, us, computer, user, event_id, label); a third share one user, host and time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = hot_time and i % 3 == 0
        us = 1_700_000_000_000_000 + (600 if hot else rng.randrange(seconds)) * 1_000_000
        user = "u0" if hot else rng.choice([f"u{k}" for k in range(users)] + [None])
        host = "h0" if hot else rng.choice([f"h{k}" for k in range(hosts)] + [None])
        rows.append((i, us, host, user, rng.choice([1, 2, 3, 4]), rng.choice(["a", "b", "benign"])))
    return rows


def event_table(spark, rows):
    from pyspark.sql import functions as F

    table = spark.createDataFrame(
        rows, "ord long, us long, computer string, subject_user_name string, event_id int, label string"
    )
    return table.withColumn("timestamp", F.timestamp_micros("us").cast("timestamp_ntz")).withColumn(
        "split", F.lit("all")
    )


def brute_rolling(rows, span=MINUTES_5):
    answer = {}
    for i, us, host, user, eid, _ in rows:
        if user is None:
            answer[i] = (1, 1, 0, None)
            continue
        mine = sorted((u, o, e, h) for o, u, h, w, e, _ in rows if w == user and (u, o) <= (us, i))
        inside = [r for r in mine if r[0] > us - span]
        before = mine[-2][0] if len(mine) > 1 else None
        answer[i] = (
            len(inside), len({r[2] for r in inside}), len({r[3] for r in inside}),
            None if before is None else (us - before) / 1e6,
        )
    return answer


def brute_related(rows, detections, span=MINUTES_5, limit=6):
    answer = set()
    for i, us, host, _, eid, _ in detections:
        if host is None:
            continue
        near = sorted(
            (u, o, e, l) for o, u, h, _, e, l in rows
            if h == host and us - span <= u <= us + span and not (u == us and e == eid)
        )
        answer |= {(i, k + 1, u, o, e, l) for k, (u, o, e, l) in enumerate(near[:limit])}
    return answer
