"""The registered queries as DuckDB SQL over the same tables, written from their definitions."""

from __future__ import annotations

from eventward import catalog

_NULL_COLUMNS = [
    "subject_user_sid", "subject_logon_id", "target_user_name", "target_user_sid", "target_domain_name",
    "ticket_options", "failure_reason", "status", "sub_status", "authentication_package", "ip_address",
    "ip_port", "workstation_name", "object_name", "object_type", "object_server", "operation_type",
    "properties", "privilege_list", "hostname_raw",
]
_KNOWN_COLUMNS = [
    "event_id", "timestamp", "computer", "subject_user_name", "subject_domain_name", "record_id",
    "source_dataset", "source_file", "source_format", "label", "mitre_tactic", "mitre_technique",
    "logon_type", "ticket_encryption_type", "access_mask",
]

SEC = f"""
b AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    CASE event_type WHEN 'click' THEN 4624 WHEN 'view' THEN 4634 WHEN 'purchase' THEN 4769
                    WHEN 'signup' THEN 4672 ELSE 4662 END AS eid,
    1704067200000000 + ((epoch_us(ts) - 1704067200000000) // 50000000) * 10000000 AS us
  FROM events),
h AS (SELECT *, k % 15 + 1 AS h FROM b),
l AS (SELECT *, CASE
    WHEN k = 7 AND event_type = 'error' THEN 'zerologon'
    WHEN event_type = 'signup' AND h = 13 THEN 'privexchange'
    WHEN event_type = 'error' AND h BETWEEN 1 AND 5 THEN 'mimikatz'
    WHEN event_type = 'purchase' AND h BETWEEN 4 AND 10 THEN 'pass_the_hash'
    WHEN event_type = 'signup' AND h IN (11, 12) THEN 'dcsync_empire'
    ELSE 'benign' END AS label FROM h),
sec AS (SELECT event_id AS ord, eid AS event_id, us, make_timestamp(us) AS "timestamp",
  'WS' || lpad(h::VARCHAR, 3, '0') || '.internal.local' AS computer,
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'user' || (user_id % 4) END AS subject_user_name,
  CASE WHEN event_id % 20 = 0 THEN NULL ELSE (event_id // 2)::VARCHAR END AS record_id,
  'src' || (user_id % 4) || '.json' AS source_file, label,
  CASE WHEN label IN ('zerologon', 'privexchange') THEN 'TA0004'
       WHEN label = 'pass_the_hash' AND user_id % 2 = 0 THEN 'TA0008' END AS mitre_tactic,
  label AS source_dataset, 'adapter' AS source_format,
  CASE label WHEN 'zerologon' THEN 'CVE-2020-1472' WHEN 'privexchange' THEN 'T1187'
    WHEN 'pass_the_hash' THEN CASE WHEN user_id % 2 = 0 THEN 'T1550.002' END END AS mitre_technique,
  CASE WHEN eid = 4624 THEN CASE WHEN value < 10 THEN 2 ELSE 10 END END AS logon_type,
  CASE WHEN eid = 4769 THEN '0x12' END AS ticket_encryption_type,
  CASE WHEN eid = 4662 THEN '0x100' END AS access_mask,
  CASE WHEN user_id % 7 = 0 THEN '' WHEN user_id % 10 <> 0 THEN 'INTERNAL' END AS subject_domain_name,
  {', '.join(f'NULL::VARCHAR AS {c}' for c in _NULL_COLUMNS)}
  FROM l)"""

SPLIT = SEC + """,
single AS (SELECT label FROM sec GROUP BY label HAVING count(DISTINCT computer) <= 1),
fixed AS (SELECT DISTINCT coalesce(computer, source_dataset) AS host FROM sec
  WHERE label IN (SELECT label FROM single)),
free AS (SELECT DISTINCT label, computer AS host FROM sec
  WHERE computer IS NOT NULL AND label NOT IN (SELECT label FROM single)
    AND computer NOT IN (SELECT host FROM fixed)),
ranked AS (SELECT *, count(*) OVER (PARTITION BY label) AS n,
    row_number() OVER (PARTITION BY label ORDER BY md5('42|' || label || '|' || host), host) AS rk FROM free),
choice AS (SELECT *, CASE WHEN rk <= least(greatest(1, round_even(n * 0.25, 0)), n - 1)
    THEN 'test' ELSE 'train' END AS side FROM ranked),
assigned AS (SELECT host, min_by(side, label) AS split FROM choice GROUP BY host
  UNION ALL SELECT host, 'train' FROM fixed),
sp AS (SELECT sec.*, CASE WHEN assigned.split = 'test' THEN 'test' ELSE 'train' END AS split
  FROM sec LEFT JOIN assigned ON coalesce(sec.computer, sec.source_dataset) = assigned.host)"""

_MANUAL = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in catalog.MANUAL_MITRE)

TACTICS = SPLIT + f""",
learned AS (SELECT label, min_by(mitre_tactic, (-n, mitre_tactic)) AS learned_tactic FROM (
    SELECT label, mitre_tactic, count(*) AS n FROM sp
    WHERE split = 'train' AND mitre_tactic IS NOT NULL GROUP BY ALL) GROUP BY label),
manual(label, manual_tactic, manual_technique) AS (VALUES {_MANUAL}),
filled AS (SELECT sp.* REPLACE (
    coalesce(sp.mitre_tactic, learned.learned_tactic, manual.manual_tactic) AS mitre_tactic,
    coalesce(sp.mitre_technique, manual.manual_technique) AS mitre_technique)
  FROM sp LEFT JOIN learned USING (label) LEFT JOIN manual USING (label))"""

# Every pair of one user inside the window, counted directly.
ROLLING = TACTICS + """,
in_window AS (SELECT a.ord, count(*) AS n, count(DISTINCT b.event_id) AS e, count(DISTINCT b.computer) AS c
  FROM sp a JOIN sp b ON a.split = b.split AND a.subject_user_name = b.subject_user_name
    AND b.us > a.us - 300000000 AND (b.us < a.us OR (b.us = a.us AND b.ord <= a.ord))
  GROUP BY a.ord),
gaps AS (SELECT ord, (us - lag(us) OVER (PARTITION BY split, subject_user_name ORDER BY us, ord)) / 1e6 AS gap
  FROM sp WHERE subject_user_name IS NOT NULL),
rolled AS (SELECT filled.*, coalesce(w.n, 1) AS events_last_5min_user,
    coalesce(w.e, 1) AS distinct_eventid_last_5min_user,
    coalesce(w.c, 0) AS distinct_computers_last_5min_user, g.gap AS seconds_since_prev_event_user
  FROM filled LEFT JOIN in_window w USING (ord) LEFT JOIN gaps g USING (ord)),
counts AS (SELECT event_id, count(*) AS n FROM sp WHERE split = 'train' GROUP BY event_id),
freq AS (SELECT event_id, n / sum(n) OVER () AS event_id_freq, n FROM counts)"""

_HOUR = 'CAST(extract(hour FROM "timestamp") AS BIGINT)'
_DOW = '(CAST(extract(isodow FROM "timestamp") AS BIGINT) - 1)'
TIME_COLUMNS = f"""{_HOUR} AS hour, {_DOW} AS day_of_week,
  CASE WHEN {_HOUR} BETWEEN 8 AND 18 THEN 1 ELSE 0 END AS is_business_hours,
  CASE WHEN {_DOW} >= 5 THEN 1 ELSE 0 END AS is_weekend"""
FLAG_COLUMNS = ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END AS has_{c}" for c in catalog.SPARSE_COLUMNS
)
_TRAIN_IDS = [4624, 4634, 4662, 4672, 4769]
ONEHOT_COLUMNS = ", ".join(
    f"CASE WHEN r.event_id = {i} THEN 1 ELSE 0 END AS eid_{i}" for i in _TRAIN_IDS
) + f", CASE WHEN r.event_id IN ({', '.join(map(str, _TRAIN_IDS))}) THEN 0 ELSE 1 END AS eid_other"

MAJORITY = SPLIT + """,
best AS (SELECT event_id, min_by(label, (-n, label)) AS guess FROM (
    SELECT event_id, label, count(*) AS n FROM sp WHERE split = 'train' GROUP BY ALL) GROUP BY event_id),
scored AS (SELECT sp.*, coalesce(best.guess, 'benign') AS guess
  FROM sp LEFT JOIN best USING (event_id) WHERE split = 'test')"""

STAGE1 = SPLIT + """,
tactics AS (SELECT ord, coalesce(mitre_tactic, 'BENIGN') AS y, CASE WHEN ord % 7 <> 0 THEN coalesce(mitre_tactic, 'BENIGN')
    WHEN mitre_tactic IS NULL THEN 'TA0006' ELSE 'BENIGN' END AS p FROM sp WHERE split = 'test')"""

EVALUABLE = MAJORITY + """,
evaluable AS (SELECT * FROM scored WHERE label IN (SELECT label FROM sp WHERE split = 'train')
    AND label IN (SELECT label FROM sp WHERE split = 'test'))"""

_REPORT = """
pairs AS (SELECT CAST({y} AS VARCHAR) AS y, CAST({p} AS VARCHAR) AS p, count(*) AS n FROM {table} GROUP BY ALL),
classes AS (SELECT y AS class FROM pairs UNION SELECT p FROM pairs),
figures AS (SELECT class,
    (SELECT coalesce(sum(n), 0) FROM pairs WHERE y = class) AS support,
    (SELECT coalesce(sum(n), 0) FROM pairs WHERE p = class) AS predicted,
    (SELECT coalesce(sum(n), 0) FROM pairs WHERE y = class AND p = class) AS hits FROM classes),
measures AS (SELECT class, support, hits,
    CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall FROM figures),
complete AS (SELECT *, CASE WHEN precision + recall > 0
    THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM measures)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
    CAST(support AS BIGINT) AS support FROM complete
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 9), round(sum(hits) / sum(support), 9),
    round(sum(hits) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM complete
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
    CAST(sum(support) AS BIGINT) FROM complete
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
    round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
    CAST(sum(support) AS BIGINT) FROM complete"""


def _values(table: dict[str, str]) -> str:
    return ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in table.items())


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _actions() -> str:
    return ", ".join(f"({_quoted(k)}, {_quoted(' | '.join(v))}, {len(v)})" for k, v in catalog.LABEL_ACTIONS.items())


PREDICTED = SEC + """,
pred AS (SELECT *,
    CASE WHEN label <> 'benign' AND ord % 97 = 0 THEN 'New_technique_X' ELSE label END AS predicted_label,
    CASE label WHEN 'benign' THEN NULL WHEN 'pass_the_hash' THEN 'TA0008' WHEN 'zerologon' THEN 'TA0004'
               WHEN 'privexchange' THEN 'TA0099' ELSE 'TA0006' END AS predicted_tactic,
    (50 + ord % 50) / 100.0 AS stage1_confidence,
    CASE WHEN label <> 'benign' AND ord % 97 <> 0 THEN ((ord * 7) % 101) / 100.0 END AS stage2_confidence,
    label <> 'benign' AS is_attack FROM sec)"""

ENRICHED = PREDICTED + f""",
techniques(predicted_label, predicted_technique) AS (VALUES {_values(catalog.LABEL_TECHNIQUES)}),
tactic_names(predicted_tactic, tactic_name) AS (VALUES {_values(catalog.TACTIC_NAMES)}),
descriptions(predicted_label, known) AS (VALUES {_values(catalog.LABEL_DESCRIPTIONS)}),
actions(predicted_label, actions, n_actions) AS (VALUES {_actions()}),
enr AS (SELECT pred.*, predicted_technique, tactic_name,
    coalesce(known, upper(substr(replace(predicted_label, '_', ' '), 1, 1))
      || lower(substr(replace(predicted_label, '_', ' '), 2))) AS description,
    CASE WHEN is_attack THEN coalesce(actions.actions, '') ELSE '' END AS action_text,
    CASE WHEN is_attack THEN coalesce(actions.n_actions, 0) ELSE 0 END AS n_actions,
    format('{{:.2f}}%', stage1_confidence * 100) AS stage1,
    coalesce(format('{{:.2f}}%', stage2_confidence * 100), 'N/A') AS stage2
  FROM pred LEFT JOIN techniques USING (predicted_label) LEFT JOIN tactic_names USING (predicted_tactic)
    LEFT JOIN descriptions USING (predicted_label) LEFT JOIN actions USING (predicted_label))"""


def _filled(template: str, missing: str, **more: str) -> str:
    """A message format as an SQL text expression."""
    names = {
        c: f"coalesce({c}, '{missing}')"
        for c in ("predicted_label", "description", "predicted_tactic", "tactic_name", "predicted_technique")
    } | {"stage1": "stage1", "stage2": "stage2"} | more
    pieces, rest = [], template
    while rest:
        text, brace, rest = rest.partition("{")
        if text:
            pieces.append(_quoted(text))
        if brace:
            name, _, rest = rest.partition("}")
            pieces.append(names[name])
    return " || ".join(pieces)


_JSON_FIELDS = [f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || " + (
    f"{c}::VARCHAR" if c in ("event_id", "logon_type") else f"'\"' || {c} || '\"'") + " END"
    for c in catalog.DISPLAY_FIELDS]
DISPLAY = "'{' || concat_ws(',', " + ", ".join(_JSON_FIELDS) + ") || '}'"
# Host name computer -> domain parts and host, for names with a dot.
_DN = """'DC=' || replace(substr({c}, instr({c}, '.') + 1), '.', ',DC=') || ';CN=' || split_part({c}, '.', 1)"""

_BASE = "ord, event_id, {us} AS us, computer, {user} AS subject_user_name, record_id, logon_type, source_file, {format} AS source_format, label"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.lstrip()}\n{body}"


def _of_sec(body: str) -> str:
    return _with(SEC, body)


_FIRST_OF_RECORD = """SELECT *, CASE WHEN record_id IS NULL THEN 1 ELSE
    row_number() OVER (PARTITION BY source_file, record_id ORDER BY ord) END AS copy FROM sec"""

def _null_table(figure: str, name: str) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, {figure.format(c=chr(34) + c + chr(34))} AS {name} FROM sec"
        for c in _KNOWN_COLUMNS + _NULL_COLUMNS
    ]
    return _of_sec(f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE {name} > 0")


_JSON_TEXT_LENGTH = """length('{"EventID":"' || event_id || '","EventTime":"' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')
    || '","Hostname":"' || computer || '"' || coalesce(',"SubjectUserName":"' || subject_user_name || '"', '')
    || coalesce(',"SubjectDomainName":"' || subject_domain_name || '"', '')
    || coalesce(',"RecordNumber":' || record_id, '') || coalesce(',"LogonType":' || logon_type, '') || '}') // 2"""

RELATED = _of_sec("""SELECT * FROM (SELECT d.ord, row_number() OVER (PARTITION BY d.ord ORDER BY e.us, e.ord) AS rank,
          e.us, e.ord AS related_ord, e.event_id, e.label
        FROM sec d JOIN sec e ON d.computer = e.computer AND e.us BETWEEN d.us - 300000000 AND d.us + 300000000
          AND NOT (e.us = d.us AND e.event_id = d.event_id)
        WHERE d.label <> 'benign') WHERE rank <= 6""")

_MANIFEST = """SELECT event_id, us - 7200000000 AS us, computer, coalesce(subject_user_name, 'second') AS subject_user_name,
  record_id, logon_type, label || '_log' AS source_file, 'evtx_xml' AS source_format, label, 'TA0004' AS mitre_tactic,
  CASE label WHEN 'zerologon' THEN 'CVE-2020-1472' ELSE 'T1187' END AS mitre_technique{more}
FROM sec WHERE label IN ('zerologon', 'privexchange')"""

ROLLED_FEED = _with(
        ROLLING.replace("THEN 'test' ELSE 'train' END AS split", "THEN 'all' ELSE 'all' END AS split"),
        """SELECT ord, false AS late, events_last_5min_user, distinct_eventid_last_5min_user,
        distinct_computers_last_5min_user, round(seconds_since_prev_event_user, 9) AS seconds_since_prev_event_user
        FROM rolled""")

ORACLE: dict[str, str] = {
    "ingest_xml": _of_sec("SELECT " + _BASE.format(
        us="us - 7200000000", user="coalesce(subject_user_name, 'second')", format="'evtx_xml'")
        + ", mitre_tactic, mitre_technique, computer AS hostname_raw FROM sec WHERE ord % 50 <> 0"),
    "quarantine_xml": _of_sec("SELECT ord, source_file, 'malformed_xml' AS reject_reason FROM sec WHERE ord % 50 = 0"),
    "ingest_json": _of_sec("SELECT " + _BASE.format(us="us", user="subject_user_name", format="'mordor_jsonl'")
        + ", subject_domain_name, computer AS hostname_raw FROM sec WHERE ord % 50 <> 0"),
    "quarantine_json": _of_sec(f"""SELECT ord, source_file, 'malformed_json' AS reject_reason,
        {_JSON_TEXT_LENGTH} AS raw_length FROM sec WHERE ord % 50 = 0"""),
    "ingest_canonical": _of_sec("SELECT " + _BASE.format(us="us", user="subject_user_name", format="source_format")
        + ", mitre_tactic, ticket_encryption_type, access_mask FROM sec"),
    "validate_timestamps": """SELECT event_id, CASE event_id % 7
        WHEN 2 THEN epoch_us(ts) WHEN 3 THEN epoch_us(ts) // 1000 * 1000
        WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE epoch_us(ts) // 1000000 * 1000000 END AS us FROM events""",
    "build_event_table": _of_sec(f"""SELECT ord, event_id,
        CASE WHEN label IN ('zerologon', 'privexchange') THEN us - 7200000000 ELSE us END AS us, computer,
        CASE WHEN label IN ('zerologon', 'privexchange') THEN coalesce(subject_user_name, 'second')
             ELSE subject_user_name END AS subject_user_name,
        record_id, logon_type, source_file,
        CASE WHEN label IN ('zerologon', 'privexchange') THEN 'evtx_xml' WHEN label = 'benign' THEN 'adapter'
             ELSE 'mordor_jsonl' END AS source_format, label,
        CASE WHEN label IN ('zerologon', 'privexchange') THEN mitre_tactic END AS mitre_tactic,
        CASE WHEN label IN ('zerologon', 'privexchange') THEN mitre_technique END AS mitre_technique
        FROM ({_FIRST_OF_RECORD}) WHERE copy = 1"""),
    "scan_event_table": _of_sec("SELECT ord, event_id, us, computer, label FROM sec"),
    "preview_events": _of_sec("SELECT ord, event_id, us, computer, label FROM sec ORDER BY ord LIMIT 3"),
    "filter_label": _of_sec("SELECT ord, us, source_file, computer FROM sec WHERE label = 'pass_the_hash'"),
    "filter_members": _with(SPLIT, "SELECT ord, label FROM sec WHERE label IN (SELECT label FROM single)"),
    "filter_non_members": _with(SPLIT, "SELECT ord, label FROM sec WHERE label NOT IN (SELECT label FROM single)"),
    "filter_nulls": _of_sec("""SELECT ord, subject_user_name, record_id FROM sec WHERE subject_user_name IS NOT NULL
        AND record_id IS NOT NULL AND mitre_tactic IS NULL"""),
    "filter_time_range": _of_sec("""SELECT ord, us, computer FROM sec
        WHERE us >= 1704153600000000 AND us <= 1704240000000000"""),
    "fill_nulls": _of_sec("""SELECT ord, coalesce(mitre_tactic, 'BENIGN') AS tactic,
        coalesce(computer, source_dataset) AS group_key, coalesce(logon_type, -1) AS logon_type FROM sec"""),
    "clean_rows": _of_sec("""SELECT ord, event_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS "timestamp", computer,
        subject_user_name, logon_type, record_id, label FROM sec"""),
    "deduplicate": _of_sec(f"""SELECT ord, event_id, us, source_file, record_id, computer, label
        FROM ({_FIRST_OF_RECORD}) WHERE copy = 1"""),
    "deduplication_report": _of_sec(f"""SELECT count(*) AS rows_before, count(*) FILTER (copy = 1) AS rows_after,
        count(*) FILTER (copy > 1) AS removed, count(*) FILTER (record_id IS NULL) AS without_record_id
        FROM ({_FIRST_OF_RECORD})"""),
    "row_count": _of_sec("SELECT count(*) AS n_rows, 35 AS n_columns FROM sec"),
    "leakage_audit": _of_sec("""SELECT label, count(*) AS n_events, count(DISTINCT computer) AS n_hosts,
        count(DISTINCT computer) <= 1 AS single_host,
        CASE WHEN count(DISTINCT computer) <= 1 THEN min(computer) END AS host FROM sec GROUP BY label"""),
    "label_distribution": _of_sec("SELECT label, count(*) AS n FROM sec GROUP BY label"),
    "label_top_counts": _of_sec("SELECT label, count(*) AS n FROM sec GROUP BY label ORDER BY n DESC, label LIMIT 3"),
    "label_count": _of_sec("SELECT count(DISTINCT label) AS n_labels FROM sec"),
    "null_rates": _null_table("round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6)", "null_percent"),
    "remaining_nulls": _null_table("count(*) FILTER ({c} IS NULL)", "null_count"),
    "top_event_ids_per_label": _of_sec("""SELECT label, CAST(max(total) AS BIGINT) AS n_events,
        string_agg(event_id || '(' || n || ')', ', ' ORDER BY rk) AS event_ids FROM (
          SELECT *, sum(n) OVER (PARTITION BY label) AS total,
            row_number() OVER (PARTITION BY label ORDER BY n DESC, event_id) AS rk
          FROM (SELECT label, event_id, count(*) AS n FROM sec GROUP BY ALL)) WHERE rk <= 3 GROUP BY label"""),
    "time_span_per_label": _of_sec("""SELECT label, min(us) AS first_us, max(us) AS last_us,
        max(us) - min(us) AS span_us FROM sec GROUP BY label"""),
    "rare_labels": _of_sec("SELECT label, count(*) AS n FROM sec GROUP BY label HAVING count(*) < 100"),
    "rare_label_totals": _of_sec("""SELECT count(*) AS n_labels, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_events
        FROM (SELECT label, count(*) AS n FROM sec GROUP BY label HAVING count(*) < 5)"""),
    "merge_rare_labels": _of_sec("""SELECT ord, label, CASE WHEN mitre_tactic IS NOT NULL
        AND count(*) OVER (PARTITION BY label) < 100 THEN 'rare_technique_' || mitre_tactic ELSE label END
        AS merged_label FROM sec"""),
    "tactic_distribution": _of_sec("""SELECT mitre_tactic, count(*) AS n FROM sec
        WHERE mitre_tactic IS NOT NULL GROUP BY mitre_tactic"""),
    "source_files_per_label": _of_sec("""SELECT label, source_file, count(*) AS n FROM sec GROUP BY ALL"""),
    "days_per_label": _of_sec("""SELECT label, strftime("timestamp", '%Y-%m-%d') AS day, count(*) AS n FROM sec GROUP BY ALL"""),
    "first_and_last_events": _of_sec("""SELECT * FROM (
        SELECT label, 'first' AS which, row_number() OVER (PARTITION BY label ORDER BY us, ord) AS position,
          us, ord, source_file, computer FROM sec
        UNION ALL SELECT label, 'last', row_number() OVER (PARTITION BY label ORDER BY us DESC, ord DESC),
          us, ord, source_file, computer FROM sec) WHERE position <= 15"""),
    "largest_gaps": _of_sec("""SELECT * FROM (SELECT label, gap_us, pos - 1 AS from_position, pos AS to_position,
          row_number() OVER (PARTITION BY label ORDER BY gap_us DESC, pos) AS rank FROM (
            SELECT label, us - lag(us) OVER w AS gap_us, row_number() OVER w - 1 AS pos FROM sec
            WINDOW w AS (PARTITION BY label ORDER BY us, ord)) WHERE gap_us IS NOT NULL) WHERE rank <= 5"""),
    "mitre_coverage": _with(TACTICS, """SELECT split, count(*) FILTER (mitre_tactic IS NULL) AS without_tactic,
        count(*) AS n_events, coalesce(string_agg(DISTINCT label, ',' ORDER BY label)
        FILTER (mitre_tactic IS NULL), '') AS labels FROM filled GROUP BY split"""),
    "tactics_per_label": _of_sec("""SELECT label, coalesce(string_agg(DISTINCT mitre_tactic, ',' ORDER BY mitre_tactic), '')
        AS tactics FROM sec GROUP BY label"""),
    "describe_event_frequency": _with(ROLLING, """SELECT label, count(*) AS n, round(avg(event_id_freq), 9) AS mean,
        round(stddev_samp(event_id_freq), 9) AS std, round(min(event_id_freq), 9) AS min,
        round(quantile_cont(event_id_freq, 0.25), 9) AS q25, round(quantile_cont(event_id_freq, 0.5), 9) AS q50,
        round(quantile_cont(event_id_freq, 0.75), 9) AS q75, round(max(event_id_freq), 9) AS max
        FROM sp JOIN freq USING (event_id) WHERE split = 'train' AND label IN ('benign', 'dcsync_empire',
          'pass_the_hash', 'mimikatz', 'kerberos_createnetonly', 'dcsync_convenant') GROUP BY label"""),
    "mean_flag_per_label": _of_sec("""SELECT label, round(avg(CASE WHEN access_mask IS NOT NULL THEN 1.0 ELSE 0.0 END), 9)
        AS mean FROM sec GROUP BY label ORDER BY mean DESC, label LIMIT 10"""),
    "group_keys": _of_sec("""SELECT coalesce(computer, source_dataset) AS group_key, count(*) AS n FROM sec GROUP BY ALL"""),
    "single_host_labels": _with(SPLIT, "SELECT label FROM single"),
    "fixed_train_hosts": _with(SPLIT, "SELECT host FROM fixed"),
    "host_assignment": _with(SPLIT, "SELECT host, split FROM assigned"),
    "split_train_test": _with(SPLIT, "SELECT ord, label, computer, split FROM sp"),
    "split_overlap": _with(SPLIT, """SELECT coalesce(computer, source_dataset) AS group_key,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM sp GROUP BY 1 HAVING count(DISTINCT split) = 2"""),
    "split_counts": _with(SPLIT, """SELECT label, count(*) FILTER (split = 'train') AS train,
        count(*) FILTER (split = 'test') AS test,
        count(*) FILTER (split = 'train') > 0 AND count(*) FILTER (split = 'test') > 0 AS evaluable
        FROM sp GROUP BY label"""),
    "split_summary": _with(SPLIT, """SELECT count(*) FILTER (split = 'train') AS train,
        count(*) FILTER (split = 'test') AS test,
        (SELECT count(*) FROM (SELECT label FROM sp GROUP BY label HAVING count(DISTINCT split) = 2)) AS evaluable_labels,
        count(DISTINCT label) AS labels FROM sp"""),
    "time_features": _of_sec(f"SELECT ord, {TIME_COLUMNS} FROM sec"),
    "presence_flags": _of_sec(f"SELECT ord, {FLAG_COLUMNS} FROM sec"),
    "event_id_frequency": _with(ROLLING, "SELECT event_id, round(event_id_freq, 9) AS event_id_freq FROM freq"),
    "apply_event_id_frequency": _with(SPLIT, """SELECT ord, sp.event_id, round(coalesce(f.share, 0), 9) AS event_id_freq
        FROM sp LEFT JOIN (SELECT event_id, count(*) / sum(count(*)) OVER () AS share FROM sp
          WHERE split = 'train' GROUP BY event_id) f ON sp.event_id = f.event_id"""),
    "top_event_ids": _with(ROLLING, "SELECT event_id, n FROM counts ORDER BY n DESC, event_id LIMIT 20"),
    "event_id_onehot": _of_sec("""SELECT ord, CASE WHEN event_id = 4624 THEN 1 ELSE 0 END AS eid_4624,
        CASE WHEN event_id = 4634 THEN 1 ELSE 0 END AS eid_4634,
        CASE WHEN event_id IN (4624, 4634) THEN 0 ELSE 1 END AS eid_other FROM sec"""),
    "rolling_event_count": _with(ROLLING, "SELECT ord, split, events_last_5min_user FROM rolled"),
    "rolling_distinct_event_ids": _with(ROLLING, "SELECT ord, split, distinct_eventid_last_5min_user FROM rolled"),
    "rolling_distinct_computers": _with(ROLLING, "SELECT ord, split, distinct_computers_last_5min_user FROM rolled"),
    "seconds_since_previous": _with(ROLLING, """SELECT ord, split, round(seconds_since_prev_event_user, 9)
        AS seconds_since_prev_event_user FROM rolled"""),
    "rows_without_user": _of_sec("""SELECT ord, 1 AS events_last_5min_user, 1 AS distinct_eventid_last_5min_user,
        0 AS distinct_computers_last_5min_user, NULL::DOUBLE AS seconds_since_prev_event_user
        FROM sec WHERE subject_user_name IS NULL"""),
    "label_to_tactic": _with(TACTICS, "SELECT label, learned_tactic FROM learned"),
    "backfill_mitre": _with(TACTICS, "SELECT ord, label, mitre_tactic, mitre_technique FROM filled"),
    "labels_without_tactic": _with(TACTICS, """SELECT DISTINCT label FROM sp WHERE split = 'train'
        AND label NOT IN (SELECT label FROM learned)"""),
    "feature_columns": _with(SPLIT, "SELECT split, feature, count(*) AS n FROM sp, (SELECT unnest(["
        + ", ".join(f"'{c}'" for c in [
            "day_of_week", "hour", "is_business_hours", "is_weekend", "event_id_freq", "eid_other",
            "distinct_computers_last_5min_user", "distinct_eventid_last_5min_user", "events_last_5min_user",
            "seconds_since_prev_event_user", *[f"eid_{i}" for i in _TRAIN_IDS],
            *[f"has_{c}" for c in catalog.SPARSE_COLUMNS]])
        + "]) AS feature) GROUP BY ALL"),
    "feature_matrix": _with(ROLLING, f"""SELECT r.ord, r.split, r.label, r.mitre_tactic, r.mitre_technique, {TIME_COLUMNS},
        {FLAG_COLUMNS}, {ONEHOT_COLUMNS}, round(coalesce(f.event_id_freq, 0), 9) AS event_id_freq,
        events_last_5min_user, distinct_eventid_last_5min_user, distinct_computers_last_5min_user,
        round(coalesce(seconds_since_prev_event_user, -1), 9) AS seconds_since_prev_event_user
        FROM rolled r LEFT JOIN freq f ON r.event_id = f.event_id"""),
    "isolated_features": _with(ROLLING, f"""SELECT ord, {TIME_COLUMNS}, round(coalesce(f.event_id_freq, 0), 9) AS event_id_freq,
        CASE WHEN subject_domain_name <> '' THEN 1 ELSE 0 END AS has_subject_domain_name,
        CASE WHEN subject_user_name <> '' THEN 1 ELSE 0 END AS has_subject_user_name,
        CASE WHEN logon_type IS NOT NULL THEN 1 ELSE 0 END AS has_logon_type,
        CASE WHEN r.event_id = 4624 THEN 1 ELSE 0 END AS eid_4624, 0 AS eid_other,
        1 AS events_last_5min_user, 1 AS distinct_eventid_last_5min_user, 0 AS distinct_computers_last_5min_user,
        -1.0::DOUBLE AS seconds_since_prev_event_user FROM sp r LEFT JOIN freq f ON r.event_id = f.event_id"""),
    "rolling_profile": _with(
        ROLLING.replace("sec AS (SELECT event_id AS ord", "every AS (SELECT event_id AS ord").replace(
            "single AS (", f"sec AS (SELECT * EXCLUDE (copy) FROM ({_FIRST_OF_RECORD.replace('FROM sec', 'FROM every')}) "
            "WHERE copy = 1),\nsingle AS (", 1),
        """SELECT split, label, count(*) AS n, round(avg(events_last_5min_user), 9) AS events_last_5min_user,
        round(avg(distinct_eventid_last_5min_user), 9) AS distinct_eventid_last_5min_user,
        round(avg(distinct_computers_last_5min_user), 9) AS distinct_computers_last_5min_user,
        round(avg(coalesce(seconds_since_prev_event_user, -1)), 9) AS seconds_since_prev_event_user,
        round(avg(coalesce(f.event_id_freq, 0)), 9) AS event_id_freq,
        round(avg(CASE WHEN extract(hour FROM "timestamp") BETWEEN 8 AND 18 THEN 1.0 ELSE 0.0 END), 9) AS is_business_hours
        FROM rolled r LEFT JOIN freq f ON r.event_id = f.event_id GROUP BY split, label"""),
    "stage1_targets": _with(SPLIT, """SELECT split, coalesce(mitre_tactic, 'BENIGN') AS stage1_target, count(*) AS n
        FROM sp GROUP BY ALL"""),
    "class_weights": _with(SPLIT, """SELECT label, n, round(total / (classes * n), 9) AS weight FROM (
        SELECT label, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS classes
        FROM sp WHERE split = 'train' GROUP BY label)"""),
    "tactic_training_summary": _with(TACTICS, """SELECT mitre_tactic AS stage1_target, count(*) AS n_events,
        count(DISTINCT label) AS n_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
        FROM filled WHERE split = 'train' AND mitre_tactic IS NOT NULL GROUP BY mitre_tactic"""),
    "route_predictions": _with(PREDICTED, """SELECT ord, coalesce(predicted_tactic, 'BENIGN') AS tactic,
        CASE coalesce(predicted_tactic, 'BENIGN') WHEN 'BENIGN' THEN 'benign' WHEN 'TA0008' THEN 'pass_the_hash'
          WHEN 'TA0006' THEN predicted_label ELSE 'UNKNOWN' END AS final_label FROM pred"""),
    "highest_class": """SELECT vec_id, 'class_' || list_position(embedding, list_max(embedding)) AS best_class,
        round(CAST(list_max(embedding) AS DOUBLE), 6) AS best_score FROM embeddings""",
    "accuracy_all": _with(MAJORITY, """SELECT count(*) AS n,
        round(avg(CASE WHEN label = guess THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM scored"""),
    "accuracy_evaluable": _with(MAJORITY, """SELECT count(*) AS n,
        round(avg(CASE WHEN label = guess THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM scored
        WHERE label IN (SELECT label FROM sp WHERE split = 'train')"""),
    "classification_report": _with(MAJORITY, "").rstrip() + "," + _REPORT.format(y="label", p="guess", table="scored"),
    "classification_report_labels": "WITH " + _REPORT.format(y="quality", p="toxic", table="labels"),
    "confusion_matrix": _with(MAJORITY, """SELECT y, count(*) FILTER (guess = 'benign') AS benign,
        count(*) FILTER (guess = 'mimikatz') AS mimikatz, count(*) FILTER (guess = 'pass_the_hash') AS pass_the_hash
        FROM (SELECT unnest(['benign', 'mimikatz', 'pass_the_hash']) AS y) axis LEFT JOIN scored ON label = y GROUP BY y"""),
    "confusion_matrix_labels": """SELECT CAST(y AS VARCHAR) AS y, count(*) FILTER (toxic = 0) AS p_0,
        count(*) FILTER (toxic = 1) AS p_1
        FROM (SELECT unnest([0, 1]) AS y) axis LEFT JOIN labels ON quality = y GROUP BY y""",
    "evaluable_labels": _with(SPLIT, """SELECT label FROM sp WHERE split = 'train'
        INTERSECT SELECT label FROM sp WHERE split = 'test'"""),
    "error_destinations": _with(MAJORITY, """SELECT guess AS predicted_label, count(*) AS n FROM scored
        WHERE label <> guess GROUP BY guess"""),
    "enrich_predictions": _with(ENRICHED, """SELECT ord, predicted_label, predicted_tactic, predicted_technique,
        tactic_name, description FROM enr"""),
    "recommended_actions": _with(ENRICHED, "SELECT ord, predicted_label, action_text AS actions FROM enr"),
    "severities": _with(PREDICTED, "SELECT ord, CASE WHEN is_attack THEN 'critical' ELSE 'info' END AS severity FROM pred"),
    "related_events": RELATED,
    "priority_sample": _of_sec("""SELECT ord, us, label, event_id FROM (SELECT *,
          list_position(['pass_the_hash', 'mimikatz', 'dcsync_empire', 'dcsync_convenant', 'kerberos_createnetonly',
            'ntds_dump_shadowcopy', 'benign'], label) AS place,
          row_number() OVER (PARTITION BY label ORDER BY md5('42|' || ord)) AS rk FROM sec)
        WHERE place IS NOT NULL AND rk <= 2 ORDER BY place, rk LIMIT 12"""),
    "analyst_rows": _with(ENRICHED, f"""SELECT ord::VARCHAR AS id, strftime("timestamp", '%H:%M:%S') AS time,
        {_DN.format(c='computer')} AS dn, computer AS host, coalesce(nullif(subject_user_name, ''), 'SYSTEM') AS user,
        event_id AS "eventId", predicted_label AS technique, coalesce(predicted_tactic, 'BENIGN') AS "tacticKey",
        predicted_technique AS mitre, round(stage1_confidence * 100, 1)::DOUBLE AS stage1,
        round(stage2_confidence * 100, 1)::DOUBLE AS stage2,
        CASE WHEN is_attack THEN 'critical' ELSE 'info' END AS severity, {DISPLAY} AS fields,
        strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS raw_time FROM enr"""),
    "display_field_objects": _of_sec(f"SELECT ord, {DISPLAY} AS fields FROM sec"),
    "directory_paths": _of_sec(f"""SELECT ord, CASE event_id WHEN 4624 THEN {_DN.format(c='computer')}
        WHEN 4634 THEN 'CN=' || split_part(computer, '.', 1) WHEN 4662 THEN {_DN.format(c="('a.' || computer)")}
        ELSE 'DC=unknown' END AS dn FROM sec"""),
    "scorable_rows": _of_sec("""SELECT CASE WHEN ord % 50 = 0 THEN 'malformed_json' ELSE 'accepted' END AS outcome,
        count(*) AS n FROM sec GROUP BY ALL"""),
    "json_odd_lines": _of_sec("""SELECT ord % 8 AS kind, CASE WHEN ord % 8 IN (1, 2, 5, 6, 7) THEN 'malformed_json'
        WHEN ord % 8 = 4 THEN 'bad_event_id' ELSE 'accepted' END AS outcome, count(*) AS n FROM sec GROUP BY ALL"""),
    "file_sources": _of_sec(f"""SELECT ord, source_file, record_id, (SELECT count(*) FROM sec) AS n_rows,
        (SELECT count(*) FROM sec) AS n_numbers FROM ({_FIRST_OF_RECORD}) WHERE copy = 1"""),
    "manifest_sources": _of_sec(_MANIFEST.format(more=", 'never_exported' AS missing")),
    "stream_manifest_sources": _of_sec(_MANIFEST.format(more="")),
    "all_sources": _of_sec("""SELECT label, source_format, count(*) AS n, count(*) AS n_numbers, sum(us - 1704067200000000)::BIGINT AS us,
          count(DISTINCT source_file) AS n_files, count(mitre_tactic) AS n_tactics
        FROM (SELECT *, row_number() OVER (PARTITION BY source_file, record_id ORDER BY ord) AS copy FROM (
          SELECT ord, label, record_id,
            CASE WHEN label IN ('zerologon', 'privexchange') THEN us - 7200000000 ELSE us END AS us,
            CASE WHEN label IN ('zerologon', 'privexchange') THEN label || '_log' WHEN label = 'benign' THEN source_file
              ELSE label || '.json' END AS source_file,
            CASE WHEN label IN ('zerologon', 'privexchange') THEN 'evtx_xml' WHEN label = 'benign' THEN source_format
              ELSE 'mordor_jsonl' END AS source_format,
            CASE WHEN label IN ('zerologon', 'privexchange') THEN 'TA0004' END AS mitre_tactic
          FROM sec))
        WHERE record_id IS NULL OR copy = 1 GROUP BY label, source_format"""),
    "audit_fields": _of_sec(f"""SELECT ord, ord % 50 NOT IN (0, 1) AS accepted,
        CASE ord % 50 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'bad_event_id' ELSE '' END AS reject_reason,
        CASE ord % 50 WHEN 0 THEN NULL WHEN 1 THEN 'none' ELSE event_id::VARCHAR END AS event_text,
        CASE WHEN ord % 50 > 1 THEN event_id END AS event_number, CASE WHEN ord % 50 > 0 THEN computer END AS host,
        CASE WHEN ord % 50 > 0 THEN record_id::BIGINT END AS record, NULL::VARCHAR AS nothing,
        CASE WHEN ord % 50 = 0 THEN {_JSON_TEXT_LENGTH} END AS text_length FROM sec"""),
    "daily_profile_union": _of_sec("""SELECT label, count(*) AS n_events, true AS hosts_close, true AS users_close,
        true AS event_ids_close, true AS median_close FROM sec GROUP BY label"""),
    "node_table_scores": _with(SPLIT, "SELECT ord, label, true AS same FROM sp WHERE split = 'test'"),
    "split_sink_round_trip": _with(SPLIT, """SELECT split, label, count(*) AS n, count(*) AS n_features,
          sum(hour("timestamp"))::BIGINT AS hours,
          label IN (SELECT label FROM sp GROUP BY label HAVING count(DISTINCT split) = 2) AS evaluable,
          (SELECT string_agg(DISTINCT event_id::VARCHAR, ',' ORDER BY event_id::VARCHAR) FROM sp WHERE split = 'train') AS top_ids
        FROM sp GROUP BY split, label"""),
    "event_table_round_trip": _of_sec("SELECT ord, event_id, computer, label, record_id, label AS csv_label FROM sec"),
    "stage1_report": _with(STAGE1, "").rstrip() + "," + _REPORT.format(y="y", p="p", table="tactics"),
    "stage1_confusion": _with(STAGE1, "SELECT y, p, count(*) AS n FROM tactics GROUP BY ALL"),
    "evaluable_report": _with(EVALUABLE, "").rstrip() + "," + _REPORT.format(y="label", p="guess", table="evaluable"),
    "evaluable_error_destinations": _with(EVALUABLE, """SELECT guess AS predicted_label, count(*) AS n
        FROM evaluable WHERE label <> guess GROUP BY guess"""),
    "representative_events": _of_sec("""SELECT label, ord, event_id, subject_user_name, us FROM (
        SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, event_id,
          CASE WHEN subject_user_name IS NULL THEN 1 ELSE 0 END, ord) AS rk
        FROM (SELECT *, count(*) OVER (PARTITION BY label, event_id) AS n FROM sec)) WHERE rk = 1"""),
    "confidence_texts": _with(ENRICHED, "SELECT ord, stage1, stage2 FROM enr"),
    "analysis_prompts": _with(ENRICHED, f"""SELECT ord, n_actions,
        CASE WHEN is_attack THEN {_filled(catalog.ANALYZE_PROMPT + catalog.PLAIN_PROSE_SUFFIX, 'None')} END AS prompt,
        CASE WHEN NOT is_attack THEN {_quoted(catalog.BENIGN_EXPLANATION)} END AS explanation FROM enr"""),
    "question_prompts": _with(ENRICHED, f"""SELECT ord, {_filled(catalog.ASK_PROMPT_HEAD, 'None')}
        || CASE WHEN stage1_confidence IS NULL THEN '' ELSE {_filled(catalog.ASK_PROMPT_STAGE1, 'None')} END
        || CASE WHEN stage2_confidence IS NULL THEN '' ELSE {_filled(catalog.ASK_PROMPT_STAGE2, 'None')} END
        || {_filled(catalog.ASK_PROMPT_TAIL + catalog.PLAIN_PROSE_SUFFIX, 'None',
                    question="'Is ' || computer || ' affected?'")} AS prompt FROM enr"""),
    "report_prompts": _with(ENRICHED, f"""SELECT ord,
        CASE WHEN is_attack THEN {_filled(catalog.REPORT_PROMPT + catalog.PLAIN_PROSE_SUFFIX, 'None')} END AS prompt,
        CASE WHEN NOT is_attack THEN {_quoted(catalog.BENIGN_REPORT_EXPLANATION)} END AS explanation FROM enr"""),
    "reports": _with(ENRICHED, f"""SELECT ord, {_filled(catalog.REPORT_FORMAT, '-',
        severity="CASE WHEN is_attack THEN 'CRITIQUE' ELSE 'INFO' END",
        explanation="CASE WHEN is_attack THEN 'None' ELSE " + _quoted(catalog.BENIGN_REPORT_EXPLANATION) + " END")}
        AS report FROM enr"""),
    "stream_ingest": _of_sec(f"""SELECT ord % 50 <> 0 AS accepted,
        CASE WHEN ord % 50 = 0 THEN 'malformed_json' ELSE '' END AS reject_reason, source_file, count(*) AS n,
        CAST(sum(CASE WHEN ord % 50 = 0 THEN {_JSON_TEXT_LENGTH} ELSE 0 END) AS BIGINT) AS raw_length
        FROM sec GROUP BY ALL"""),
    "stream_deduplicate": _of_sec("""SELECT source_file, record_id,
        CASE WHEN record_id IS NULL THEN count(*) ELSE 1 END AS n FROM sec GROUP BY source_file, record_id"""),
    "stream_first_wins": _of_sec("""SELECT ord, source_file, record_id, event_id, logon_type,
        CASE WHEN record_id IS NULL OR row_number() OVER (PARTITION BY source_file, record_id ORDER BY ord) = 1
          THEN 'kept' ELSE 'duplicate' END AS verdict FROM sec"""),
    "stream_related_events": RELATED,
    "stream_rolling_features": ROLLED_FEED,
    "rolling_from_layout": ROLLED_FEED,
}
