"""The canonical event table."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the event table.
STRING_FIELDS = [
    "subject_user_name", "subject_user_sid", "subject_domain_name", "subject_logon_id",
    "target_user_name", "target_user_sid", "target_domain_name",
    "ticket_encryption_type", "ticket_options", "failure_reason", "status", "sub_status",
    "authentication_package", "ip_address", "ip_port", "workstation_name",
    "object_name", "object_type", "object_server", "operation_type",
    "access_mask", "properties", "privilege_list",
]

ORIGIN_FIELDS = ["source_dataset", "source_file", "source_format", "hostname_raw", "record_id"]
LABEL_FIELDS = ["label", "mitre_tactic", "mitre_technique"]

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.IntegerType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("computer", T.StringType()),
    ]
    + [T.StructField(c, T.StringType()) for c in STRING_FIELDS[:7]]
    + [T.StructField("logon_type", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in STRING_FIELDS[7:]]
    + [T.StructField(c, T.StringType()) for c in ORIGIN_FIELDS + LABEL_FIELDS]
)

EVENT_COLUMNS = EVENT_SCHEMA.names

# Arrival ordinal. It orders equal timestamps and decides which copy comes first,
# so every ranking in the library ends with it; it must be unique per table.
ORDINAL = "ord"
