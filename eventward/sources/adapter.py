"""The generic `events` table seen as canonical security events.

The table holds clicks, purchases and the like; this view gives them event ids, hosts, users
and labels with the traits real logs have: equal times, missing users and record ids, repeated
records, labels bound to one host and labels that share hosts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventward.schema import EVENT_SCHEMA, ORDINAL
from eventward.session import prepare

_DERIVED = """
SELECT *,
  CASE event_type WHEN 'click' THEN 4624 WHEN 'view' THEN 4634 WHEN 'purchase' THEN 4769
                  WHEN 'signup' THEN 4672 ELSE 4662 END AS eid,
  1704067200000000
    + ((unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 50000000) * 10000000 AS us,
  CAST(get_json_object(props, '$.k') AS INT) AS k
FROM {source}
"""

_LABELLED = """
SELECT *, CASE
    WHEN k = 7 AND event_type = 'error' THEN 'zerologon'
    WHEN event_type = 'signup' AND h = 13 THEN 'privexchange'
    WHEN event_type = 'error' AND h BETWEEN 1 AND 5 THEN 'mimikatz'
    WHEN event_type = 'purchase' AND h BETWEEN 4 AND 10 THEN 'pass_the_hash'
    WHEN event_type = 'signup' AND h IN (11, 12) THEN 'dcsync_empire'
    ELSE 'benign' END AS lab
FROM (SELECT *, k % 15 + 1 AS h FROM {derived})
"""

_CANONICAL = {
    "event_id": "eid",
    "timestamp": "CAST(timestamp_micros(us) AS TIMESTAMP_NTZ)",
    "computer": "concat('WS', lpad(CAST(h AS STRING), 3, '0'), '.internal.local')",
    "subject_user_name": "CASE WHEN user_id % 10 <> 0 THEN concat('user', user_id % 4) END",
    "subject_domain_name": "CASE WHEN user_id % 7 = 0 THEN '' WHEN user_id % 10 <> 0 THEN 'INTERNAL' END",
    "record_id": "CASE WHEN event_id % 20 <> 0 THEN CAST(event_id div 2 AS STRING) END",
    "source_dataset": "lab",
    "source_file": "concat('src', user_id % 4, '.json')",
    "source_format": "'adapter'",
    "label": "lab",
    "mitre_tactic": """CASE WHEN lab IN ('zerologon', 'privexchange') THEN 'TA0004'
                            WHEN lab = 'pass_the_hash' AND user_id % 2 = 0 THEN 'TA0008' END""",
    "mitre_technique": """CASE WHEN lab = 'zerologon' THEN 'CVE-2020-1472'
                               WHEN lab = 'privexchange' THEN 'T1187'
                               WHEN lab = 'pass_the_hash' AND user_id % 2 = 0 THEN 'T1550.002' END""",
    "logon_type": "CASE WHEN eid = 4624 THEN CASE WHEN value < 10 THEN 2 ELSE 10 END END",
    "ticket_encryption_type": "CASE WHEN eid = 4769 THEN '0x12' END",
    "access_mask": "CASE WHEN eid = 4662 THEN '0x100' END",
}


def security_view(events: DataFrame) -> DataFrame:
    """Canonical event table plus `ord` and `us` (event time in microseconds)."""
    prepare(events.sparkSession)
    derived = events.sparkSession.sql(_DERIVED.format(source="{events}"), events=events)
    labelled = events.sparkSession.sql(_LABELLED.format(derived="{derived}"), derived=derived)
    columns = [
        F.expr(_CANONICAL.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields
    ]
    return labelled.select(F.col("event_id").alias(ORDINAL), *columns, "us")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_security_events(spark: SparkSession, folder: str) -> DataFrame:
    return security_view(read_table(spark, folder, "events"))
