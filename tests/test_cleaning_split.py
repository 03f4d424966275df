"""Duplicates, rare labels, host-disjoint split."""

from pyspark.sql import functions as F

from eventward.operators import cleaning, splitting


def test_deduplicate_keeps_first_and_unkeyed(spark):
    rows = [(3, "f", "1"), (1, "f", "1"), (2, "g", "1"), (4, "f", None), (5, "f", None)]
    table = spark.createDataFrame(rows, "ord long, source_file string, record_id string")
    once = cleaning.deduplicate(table)
    assert sorted(r.ord for r in once.collect()) == [1, 2, 4, 5]
    assert cleaning.deduplicate(once).count() == 4
    report = cleaning.deduplication_report(table).first()
    assert tuple(report) == (5, 4, 1, 2)


def test_deduplicate_limits_before_the_shuffle(spark, events):
    plan = cleaning.deduplicate(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_leakage_audit_counts_null_hosts_as_single(spark):
    rows = [("a", None), ("b", "h"), ("b", "h"), ("c", "h"), ("c", "i")]
    audit = {r.label: r for r in cleaning.leakage_audit(spark.createDataFrame(rows, "label string, computer string")).collect()}
    assert (audit["a"].n_hosts, audit["a"].single_host, audit["a"].host) == (0, True, None)
    assert (audit["b"].host, audit["c"].single_host) == ("h", False)


def test_rare_labels(spark):
    rows = [("x", "TA1")] * 4 + [("y", "TA2")] * 5 + [("z", None)]
    table = spark.createDataFrame(rows, "label string, mitre_tactic string")
    merged = cleaning.merge_rare_labels(table).select("label", "merged_label").distinct().collect()
    assert {tuple(r) for r in merged} == {("x", "rare_technique_TA1"), ("y", "y"), ("z", "z")}
    assert tuple(cleaning.rare_label_totals(table).first()) == (2, 5)


def test_null_figures(spark):
    table = spark.createDataFrame([(1, None, 1), (2, "x", 1)], "a int, b string, c int")
    assert [tuple(r) for r in cleaning.null_rates(table).collect()] == [("b", 50.0)]
    assert [tuple(r) for r in cleaning.null_counts(table).collect()] == [("b", 1)]


def test_describe_approximate(spark):
    table = spark.createDataFrame([("a", float(i)) for i in range(101)], "label string, v double")
    exact = cleaning.describe_per_label(table, "v").first()
    close = cleaning.describe_per_label(table, "v", accuracy=10_000).first()
    assert (exact.q25, exact.q50, exact.q75) == (close.q25, close.q50, close.q75) == (25.0, 50.0, 75.0)


def test_split_shares_no_host(spark, events, split):
    assert split.count() == events.count()
    assert splitting.split_overlap(split).count() == 0
    single = {r.label for r in splitting.single_host_labels(events).collect()}
    in_test = {r.label for r in split.where("split = 'test'").select("label").distinct().collect()}
    assert in_test and not in_test & single


def test_host_assignment_in_chunks(spark, events):
    small = sorted(map(tuple, splitting.host_assignment(events).collect()))
    assert small == sorted(map(tuple, splitting.host_assignment(events, max_group_rows=4).collect()))


def test_host_assignment_rules(spark):
    """One host: train. Fixed hosts stay in train. The first label decides a shared host."""
    rows = [("one", "solo", "d")] + [("many", f"h{i}", "d") for i in range(8)] + [("many", "solo", "d")]
    rows += [("nohost", None, "dataset")]
    table = spark.createDataFrame(rows, "label string, computer string, source_dataset string").withColumn(
        "ord", F.monotonically_increasing_id()
    )
    hosts = {r.host: r.split for r in splitting.host_assignment(table).collect()}
    assert hosts["solo"] == "train" and hosts["dataset"] == "train"
    assert sorted(hosts.values()).count("test") == 2  # a quarter of eight
    out = splitting.split_train_test(table)
    assert out.where("label = 'nohost' AND split = 'train'").count() == 1
    again = {r.host: r.split for r in splitting.host_assignment(table.repartition(5)).collect()}
    assert hosts == again


def test_split_size_rounds_half_to_even(spark):
    def tests(n):
        rows = [("l", f"h{i}", "d") for i in range(n)]
        table = spark.createDataFrame(rows, "label string, computer string, source_dataset string")
        return splitting.host_assignment(table).where("split = 'test'").count()

    assert [tests(n) for n in (2, 3, 6, 10)] == [1, 1, 2, 2]
