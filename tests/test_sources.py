"""Literal records of each source, files on disk, quarantine."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventward.catalog import EVENT_LOG_NAMESPACE, MANIFEST, manifest_table
from eventward.functions.times import validated_time, xml_time
from eventward.plans.dataset import build_dataset, quarantine, read_sources
from eventward.sources.json_events import normalize_canonical_texts, normalize_emulation_texts
from eventward.sources.normalize import accepted, read_with_quarantine, write_with_quarantine
from eventward.sources.tables import write_events, write_label_list, write_split
from eventward.sources.xml_events import (
    missing_manifest_files,
    normalize_xml_texts,
    read_event_xml,
    read_manifest_events,
    read_manifest_file,
)

SYSTEM = (
    '<System><EventID Qualifiers="">4624</EventID><TimeCreated SystemTime="2020-09-22 01:02:03.123456+00:00"/>'
    "<EventRecordID>7</EventRecordID><Computer>h1</Computer></System>"
)


def event(system=SYSTEM, data="<EventData></EventData>"):
    return f'<Event xmlns="{EVENT_LOG_NAMESPACE}">{system}{data}</Event>'


def data(*pairs):
    return "<EventData>" + "".join(f'<Data Name="{n}">{v}</Data>' for n, v in pairs) + "</EventData>"


def parse_xml(spark, *texts):
    rows = [(i, t, "set", "file.evtx", "lab", "TA0006", "T1003") for i, t in enumerate(texts)]
    table = spark.createDataFrame(
        rows, "ord long, xml string, source_dataset string, source_file string, label string, tactic string, technique string"
    )
    return normalize_xml_texts(table).orderBy("ord").collect()


def test_xml_complete(spark):
    pairs = data(("SubjectUserName", "bob"), ("LogonType", "3"), ("IpAddress", "-"), ("Status", "%%1793"))
    (row,) = parse_xml(spark, event(data=pairs))
    assert row.reject_reason is None
    assert (row.event_id, row.computer, row.hostname_raw, row.record_id) == (4624, "h1", "h1", "7")
    assert row.timestamp == datetime(2020, 9, 22, 1, 2, 3, 123456)
    assert (row.subject_user_name, row.logon_type, row.ip_address, row.status) == ("bob", 3, None, None)
    assert (row.source_format, row.label, row.mitre_tactic, row.mitre_technique) == ("evtx_xml", "lab", "TA0006", "T1003")


@pytest.mark.parametrize(
    "text, reason",
    [
        ("<Event><broken", "malformed_xml"),
        ("no markup", "malformed_xml"),
        (event(system=""), "no_system"),
        (event(SYSTEM.replace("4624", "")), "no_event_id"),
        (event("<System><Computer>h</Computer></System>"), "no_event_id"),
        (event(SYSTEM.replace("4624", "abc")), "bad_event_id"),
        (event("<System><EventID>1</EventID></System>"), "no_time"),
        (event(SYSTEM.replace("2020-09-22", "yesterday")), "bad_time"),
        (event(SYSTEM.replace("h1", "")), "no_computer"),
        (event(data=data(("LogonType", "abc"))), "bad_logon_type"),
    ],
)
def test_xml_rejects(spark, text, reason):
    (row,) = parse_xml(spark, text)
    assert row.reject_reason == reason and row.raw == text


def test_xml_first_accepted_value_wins(spark):
    first, second, third = parse_xml(
        spark,
        event(data=data(("SubjectUserName", "-"), ("SubjectUserName", "x"), ("SubjectUserName", "y"))),
        event(data=data(("TargetSid", "S-1"), ("TargetUserSid", "S-2"))),
        event(data=data(("Unknown", "z"))),
    )
    assert first.subject_user_name == "x" and second.target_user_sid == "S-1"
    assert third.reject_reason is None and third.target_user_sid is None


def test_xml_defaults(spark):
    (row,) = parse_xml(spark, event(SYSTEM.replace("<Computer>h1</Computer>", "").replace("<EventRecordID>7</EventRecordID>", "")))
    assert (row.computer, row.record_id, row.reject_reason) == ("UNKNOWN", None, None)


def test_xml_times(spark):
    cases = {
        "2020-09-22 01:02:03.123456+02:00": datetime(2020, 9, 21, 23, 2, 3, 123456),
        "2020-09-22T01:02:03Z": datetime(2020, 9, 22, 1, 2, 3),
        "2020-09-22T01:02:03.1234567Z": datetime(2020, 9, 22, 1, 2, 3, 123456),
        "2020-09-22 01:02:03.5 UTC": datetime(2020, 9, 22, 1, 2, 3),
        "2020-09-22": datetime(2020, 9, 22),
        "2020-02-30 01:02:03": None,
        "soon": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", xml_time(F.col("t")).alias("v"))
    assert {r.t: r.v for r in rows.collect()} == cases


def test_accepted_time_patterns(spark):
    good = ["2020-09-22 01:02:03", "2020-09-22T01:02:03Z", "2020-09-22T01:02:03.1Z", "2020-09-22T01:02:03.123456", "2020-09-22T01:02:03", "2020-9-2 1:2:3"]
    bad = ["2020-09-22 01:02:03.5", "2020-09-22T01:02:03.1234567Z", "2020-09-22T01:02:03+02:00", "2020-02-30 00:00:00", "2020-09-22", "", "2020-09-22 01:02:03Z"]
    rows = spark.createDataFrame([(t,) for t in good + bad], "t string").select("t", validated_time(F.col("t")).alias("v"))
    assert sorted(r.t for r in rows.collect() if r.v is not None) == sorted(good)


def parse_json(spark, *lines, strict=False):
    rows = [(i, t, "mimikatz", "mimikatz.json", "mimikatz") for i, t in enumerate(lines)]
    table = spark.createDataFrame(rows, "ord long, value string, source_dataset string, source_file string, label string")
    return {r.ord: r for r in normalize_emulation_texts(table, strict=strict).collect()}


TIME = '"EventTime":"2020-09-22 01:02:03"'


def test_json_lines(spark):
    rows = parse_json(
        spark,
        '{"EventID":4624,%s,"Hostname":"h","RecordNumber":5,"SubjectUserName":"-","Other":1}' % TIME,
        "   ",
        '{"EventID":"4625","EventTime":"","@timestamp":"2020-09-22T01:02:03.5Z","host":"x","IpPort":445,"LogonType":"3"}',
        '{"EventID":4624.9,%s}' % TIME,
    )
    assert 1 not in rows  # a blank line is no record
    first = rows[0]
    assert (first.event_id, first.computer, first.record_id, first.subject_user_name) == (4624, "h", "5", "-")
    assert (first.source_format, first.label, first.hostname_raw) == ("mordor_jsonl", "mimikatz", "h")
    second = rows[2]
    assert (second.event_id, second.computer, second.hostname_raw, second.ip_port, second.logon_type) == (4625, "x", None, "445", 3)
    assert second.timestamp == datetime(2020, 9, 22, 1, 2, 3, 500000)
    assert (rows[3].event_id, rows[3].computer) == (4624, "UNKNOWN")


@pytest.mark.parametrize(
    "line, reason",
    [
        ("{bad", "malformed_json"),
        ('[{"EventID":1}]', "malformed_json"),
        ("{'EventID':1}", "malformed_json"),
        ('{"EventID":1,%s} trailing' % TIME, "malformed_json"),
        ('{"EventID":1,%s}] xyz' % TIME, "malformed_json"),
        ('{"EventID":1,%s}][1]' % TIME, "malformed_json"),
        ('{"EventID":1,%s},{"~":1}]' % TIME, "malformed_json"),
        ('{"EventID":1,%s},{"EventID":2}' % TIME, "malformed_json"),
        ('[{"EventID":1,%s}]' % TIME, "malformed_json"),
        ("{%s}" % TIME, "no_event_id"),
        ('{"EventID":null,%s}' % TIME, "bad_event_id"),
        ('{"EventID":"4.5",%s}' % TIME, "bad_event_id"),
        ('{"EventID":1}', "bad_time"),
        ('{"EventID":1,"EventTime":"2020-09-22T01:02:03+02:00"}', "bad_time"),
        ('{"EventID":1,%s,"Hostname":null,"host":"x"}' % TIME, "no_computer"),
        ('{"EventID":1,%s,"LogonType":"-"}' % TIME, "bad_logon_type"),
    ],
)
def test_json_rejects(spark, line, reason):
    assert parse_json(spark, line)[0].reject_reason == reason


def test_json_strict_types(spark):
    line = '{"EventID":1,%s,"IpPort":445}' % TIME
    assert parse_json(spark, line)[0].reject_reason is None
    assert parse_json(spark, line, strict=True)[0].reject_reason == "not_text"


CANONICAL = (
    '{"event_id":4624,"timestamp":"2022-03-01T08:00:00","computer":"WS001","record_id":"1","source_dataset":"s",'
    '"source_file":"benign.json","source_format":"synthetic","label":"benign","mitre_tactic":null,"logon_type":2,"extra":1}'
)


def test_canonical_lines(spark):
    lines = [
        CANONICAL, CANONICAL.replace('"source_dataset":"s",', ""), CANONICAL.replace('"record_id":"1"', '"record_id":1'),
        CANONICAL.replace('"logon_type":2', '"logon_type":2.5'), CANONICAL.replace('"computer":"WS001",', ""),
    ]
    table = spark.createDataFrame([(i, t, "path.json") for i, t in enumerate(lines)], "ord long, value string, source_file string")
    rows = {r.ord: r for r in normalize_canonical_texts(table).collect()}
    assert [rows[i].reject_reason for i in range(5)] == [None, "no_source", "not_text", "bad_logon_type", None]
    assert (rows[0].source_file, rows[0].logon_type, rows[0].mitre_tactic) == ("benign.json", 2, None)
    assert rows[4].computer == "UNKNOWN"
    lenient = {r.ord: r.reject_reason for r in normalize_canonical_texts(table, strict=False).collect()}
    assert lenient[2] is None


@pytest.fixture(scope="module")
def raw_folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    xml = root / "xml"
    by_file = {(c, f): label for c, f, label, _, _ in MANIFEST}
    listed = [
        ("credential_access", "CA_DCSync_4662.evtx"),
        ("lateral_movement", "ImpersonateUser-via local Pass The Hash Sysmon and Security.evtx"),
    ]
    for category, name in listed:
        (xml / category).mkdir(parents=True, exist_ok=True)
        pretty = event(data="\n  " + data(("SubjectUserName", by_file[category, name])) + "\n")
        other = event(SYSTEM.replace(">7<", ">8<"))
        (xml / category / f"{name}.xml").write_text(f"<Events>\n{pretty}\n{pretty}\n{other}\n</Events>\n")
    (xml / "discovery").mkdir()
    (xml / "discovery" / "not_in_manifest.evtx.xml").write_text(f"<Events>{event()}</Events>")
    emulation = root / "emulation"
    emulation.mkdir()
    line = '{"EventID":10,%s,"Hostname":"h2","RecordNumber":%d}'
    (emulation / "mimikatz.json").write_text("\n".join(line % (TIME, n) for n in (1, 1, 2)) + "\n{broken\n\n")
    (emulation / "other.json").write_text(line % (TIME, 1))
    (root / "benign.json").write_text(CANONICAL + "\n" + CANONICAL.replace('"record_id":"1",', "") + "\n")
    return root


def test_manifest_scan(spark, raw_folder):
    rows = read_manifest_events(spark, str(raw_folder / "xml")).collect()
    assert len(rows) == 6  # the file outside the manifest is not read
    by_label = {r.label: r for r in rows}
    assert set(by_label) == {"dcsync", "pass_the_hash"}
    assert by_label["pass_the_hash"].source_file == "ImpersonateUser-via local Pass The Hash Sysmon and Security.evtx"
    assert by_label["dcsync"].mitre_technique == "T1003.006" and by_label["dcsync"].source_dataset == "dcsync"
    assert len({r.ord for r in rows}) == 6
    missing = missing_manifest_files(spark, str(raw_folder / "xml"))
    assert missing.count() == len(MANIFEST) - 2


def test_single_xml_file(spark, raw_folder):
    path = str(raw_folder / "xml" / "credential_access" / "CA_DCSync_4662.evtx.xml")
    rows = read_event_xml(spark, path, "dcsync", "dcsync").orderBy("ord").collect()
    assert [r.record_id for r in rows] == ["7", "7", "8"]
    assert [r.subject_user_name for r in rows] == ["dcsync", "dcsync", None]


def test_manifest_file(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "manifest.yaml"
    path.write_text("cat:\n  - file: \"a b.evtx\"\n    label: \"x\"\n    tactic: \"TA0001\"\n    technique: \"T1\"\n")
    (row,) = read_manifest_file(spark, str(path)).collect()
    assert tuple(row) == (0, "cat", "a b.evtx", "x", "TA0001", "T1")
    assert manifest_table(spark).count() == 33
    assert manifest_table(spark).select("label").distinct().count() == 30


def test_build_dataset(spark, raw_folder):
    rows = read_sources(
        spark, str(raw_folder / "xml"), None, str(raw_folder / "emulation"), str(raw_folder / "benign.json")
    )
    table = build_dataset(rows)
    counts = {r.label: r["count"] for r in table.groupBy("label").count().collect()}
    assert counts == {"dcsync": 2, "pass_the_hash": 2, "mimikatz": 2, "benign": 2}
    kept = table.where("label = 'dcsync' AND record_id = '7'").first()
    assert kept.subject_user_name == "dcsync"  # the first copy stays
    assert [r.reject_reason for r in quarantine(rows).collect()] == ["malformed_json"]
    ranks = {r.label: r.m for r in table.groupBy("label").agg(F.min("ord").alias("m")).collect()}
    assert ranks["dcsync"] < ranks["pass_the_hash"] < ranks["mimikatz"] < ranks["benign"]


def test_sources_are_optional(spark, raw_folder, tmp_path):
    rows = read_sources(spark, str(tmp_path / "none"), None, str(tmp_path / "none"), str(raw_folder / "benign.json"))
    assert accepted(rows).count() == 2
    with pytest.raises(ValueError):
        read_sources(spark, str(tmp_path / "none"))


def test_quarantine_in_one_pass(spark, raw_folder, tmp_path):
    rows = read_sources(spark, emulation_folder=str(raw_folder / "emulation"))
    write_with_quarantine(rows, str(tmp_path / "out"))
    good, bad = read_with_quarantine(spark, str(tmp_path / "out"))
    assert (good.count(), bad.count()) == (3, 1)
    assert bad.first().raw == "{broken"


def test_sinks(spark, split, tmp_path):
    write_events(split.select("ord", "label", "timestamp"), str(tmp_path / "e"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == split.count()
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["ord", "label", "timestamp"]
    write_split(split, str(tmp_path / "s"))
    test = spark.read.parquet(str(tmp_path / "s")).where("split = 'test'")
    assert test.count() == split.where("split = 'test'").count()
    write_label_list(split.select("label").distinct(), str(tmp_path / "l"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "l")).collect()]
    assert lines == sorted(lines) and len(lines) == 6


def test_any_columns_of_the_event_table(spark, events):
    """Pruning to any one column must not disturb the parsing."""
    from eventward.plans.queries import canonical_texts, json_texts, xml_texts
    from eventward.schema import EVENT_COLUMNS

    tables = [
        normalize_xml_texts(xml_texts(events)), normalize_emulation_texts(json_texts(events)),
        normalize_emulation_texts(json_texts(events), strict=True), normalize_canonical_texts(canonical_texts(events)),
    ]
    for table in tables:
        good = accepted(table)
        for columns in (["event_id"], ["timestamp", "logon_type"], ["record_id", "target_user_sid"], ["computer"]):
            assert len(good.select(*columns).collect()) == 1000
        assert good.select(F.count("event_id"), F.min("timestamp")).first()[0] == 1000
        assert good.columns == ["ord", *EVENT_COLUMNS]


def test_odd_json_lines(spark):
    good = '{"EventID":4624,%s,"Hostname":"h"}' % TIME
    lines = [
        good + " " + good, good + "}", good + " xyz}", good + "\t", "\t", "\u00a0", good + "," + good, "null", "[" + good + "]",
        good.replace("4624", "NaN"), "1",
    ]
    table = spark.createDataFrame(
        [(i, t, "mimikatz", "f", "mimikatz") for i, t in enumerate(lines)],
        "ord long, value string, source_dataset string, source_file string, label string",
    )
    reasons = {r.ord: r.reject_reason for r in normalize_emulation_texts(table).collect()}
    wrong = "malformed_json"
    assert reasons == {
        0: wrong, 1: wrong, 2: wrong, 3: None, 6: wrong, 7: wrong, 8: wrong, 9: "bad_event_id", 10: wrong,
    }


def test_numbers_are_unique_over_files(spark, tmp_path):
    lines = [CANONICAL.replace('"record_id":"1"', f'"record_id":"{i}"') for i in range(12)]
    spark.createDataFrame([(t,) for t in lines], "value string").repartition(4).write.text(str(tmp_path / "b"))
    rows = read_sources(spark, canonical_path=str(tmp_path / "b")).collect()
    assert len(rows) == len({r.ord for r in rows}) == 12
    again = read_sources(spark, canonical_path=str(tmp_path / "b")).collect()
    assert {r.record_id: r.ord for r in rows} == {r.record_id: r.ord for r in again}


def test_unlisted_xml_files_are_not_opened(spark, raw_folder):
    files = read_manifest_events(spark, str(raw_folder / "xml")).inputFiles()
    assert files and not [f for f in files if "not_in_manifest" in f]


def test_blanks_in_xml_values_stay(spark, tmp_path):
    (tmp_path / "e.xml").write_text(event(data=data(("SubjectUserName", "  bob "))))
    (row,) = read_event_xml(spark, str(tmp_path / "e.xml"), "d").collect()
    assert row.subject_user_name == "  bob "


def test_logs_need_no_element_around_their_events(spark, tmp_path):
    event = '<Event xmlns="http://x">\n<System><EventID>%d</EventID><TimeCreated SystemTime="2020-01-01 00:00:00"/></System>\n</Event>\n'
    for name, text in (
        ("bare", "".join(event % i for i in range(5))),
        ("wrapped", "<Events>\n" + "".join(event % i for i in range(5)) + "</Events>"),
        ("records", '<?xml version="1.0"?>\nRecord 1\n' + event % 0 + 'Record 2\n<?xml version="1.0"?>\n' + event % 1),
    ):
        (tmp_path / f"{name}.xml").write_text(text)
        got = read_event_xml(spark, str(tmp_path / f"{name}.xml"), "d", "l").collect()
        assert sorted(r.event_id for r in got) == list(range(2 if name == "records" else 5)), name
        assert all(r.reject_reason is None for r in got)
