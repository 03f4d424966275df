"""Train and test sets that share no host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventward.operators.ordered import MAX_GROUP_ROWS, ordered_scan, scan_groups
from eventward.session import stored

TEST_SIZE = 0.25
SEED = 42


def group_key() -> Column:
    return F.coalesce("computer", "source_dataset")


def single_host_labels(df: DataFrame) -> DataFrame:
    """Labels with at most one distinct host; a label without any host counts too."""
    hosts = df.groupBy("label").agg(F.count_distinct("computer").alias("n_hosts"))
    return hosts.where("n_hosts <= 1").select("label")


def fixed_train_hosts(df: DataFrame) -> DataFrame:
    """Hosts touched by any single-host label: they stay in train altogether."""
    pairs = df.select("label", group_key().alias("host")).where("host IS NOT NULL").distinct()
    return pairs.join(single_host_labels(df), "label", "left_semi").select("host").distinct()


def host_assignment(
    df: DataFrame, test_size: float = TEST_SIZE, seed: int = SEED, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Host -> train or test.

    Each multi-host label draws a share of its free hosts for test in the order of a seeded
    hash. Hosts fixed in train never change, so labels draw independently; where they disagree
    about a host, the first label in alphabetical order wins.
    """
    # One pass over the events; all that follows reads the distinct pairs.
    pairs = stored(df.select("label", "computer", group_key().alias("host")).distinct(), "label-hosts")
    hosts_of = pairs.groupBy("label").agg(F.count("computer").alias("_hosts"))
    pairs = pairs.join(hosts_of.select("label", (F.col("_hosts") <= 1).alias("_single")), "label")
    fixed = pairs.where("_single AND host IS NOT NULL").select("host").distinct()
    free = (
        pairs.where("NOT _single AND computer IS NOT NULL")
        .select("label", F.col("computer").alias("host"))
        .join(fixed, "host", "left_anti")
    )
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), "label", "host"))
    free = free.withColumns({"_draw": drawn, "_one": F.lit(1).cast("long")})
    scan = (["label"], ["_draw", "host"], {"_rank": "_one"})
    if pairs.count() <= max_group_rows:  # a count from the file footers: no group can be larger
        ranked = scan_groups(free, *scan)
    else:
        ranked = ordered_scan(free, *scan, max_group_rows=max_group_rows)
    candidates = free.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    wanted = F.least(F.greatest(F.lit(1), F.bround(F.col("_n") * F.lit(test_size))), F.col("_n") - 1)
    choice = ranked.join(candidates, "label").select(
        "host", "label", F.when(F.col("_rank") <= wanted, "test").otherwise("train").alias("_choice")
    )
    decided = choice.groupBy("host").agg(F.min_by("_choice", "label").alias("split"))
    return decided.unionByName(fixed.select("host", F.lit("train").alias("split")))


def split_train_test(
    df: DataFrame, test_size: float = TEST_SIZE, seed: int = SEED, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Add `split`. Only hosts assigned to test leave train; all else stays there.

    A single-host label needs no test of its own: its hosts are fixed in train.
    """
    hosts = host_assignment(df, test_size, seed, max_group_rows).where("split = 'test'")
    test_hosts = stored(hosts.select(F.col("host").alias("_host"), "split"), "test-hosts")
    return (
        df.join(test_hosts, group_key() == F.col("_host"), "left")
        .withColumn("split", F.coalesce("split", F.lit("train")))
        .drop("_host")
    )


def split_overlap(df: DataFrame) -> DataFrame:
    """Group keys found in both splits, with their labels. Must be empty."""
    return (
        df.groupBy(group_key().alias("group_key"))
        .agg(
            F.count_distinct("split").alias("n_splits"),
            F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        )
        .where("n_splits = 2 AND group_key IS NOT NULL")
        .select("group_key", "labels")
    )


def split_counts(df: DataFrame) -> DataFrame:
    """Train and test rows per label, and whether the label can be evaluated."""
    counts = df.groupBy("label").agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "test").alias("test"),
    )
    return counts.withColumn("evaluable", (F.col("train") > 0) & (F.col("test") > 0))


def split_summary(df: DataFrame) -> DataFrame:
    return split_counts(df).agg(
        F.sum("train").alias("train"), F.sum("test").alias("test"),
        F.count_if("evaluable").alias("evaluable_labels"), F.count(F.lit(1)).alias("labels"),
    )
