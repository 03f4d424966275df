"""Accuracy, reports and confusion tables from (true, predicted) columns.

Everything starts from one count per (true, predicted) pair: the rows are aggregated once, with
partial sums, and what follows works on a table of classes by classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventward.session import stored


def pair_counts(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return df.groupBy(
        F.col(truth).cast("string").alias("y"), F.col(guess).cast("string").alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))


def evaluable_labels(train: DataFrame | None, test: DataFrame, label: str = "label") -> DataFrame:
    """Labels present in train and in test; all test labels if train is unknown."""
    if train is None:
        return test.select(label).distinct()
    return train.select(label).distinct().intersect(test.select(label).distinct())


def restrict_to(df: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    return df.join(stored(labels, "labels"), label, "left_semi")


def accuracy(df: DataFrame, truth: str, guess: str) -> DataFrame:
    hit = F.col(truth).eqNullSafe(F.col(guess))
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def per_class_report(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall, f1 and support for each class that is true or predicted somewhere."""
    pairs = pair_counts(df, truth, guess)
    # Each pair counts once for its true class and once for its predicted class.
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                         F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                         F.lit(0).cast("long").alias("hits")),
            )
        ).alias("s")
    ).select("s.*")
    totals = sides.where("class IS NOT NULL").groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    scored = totals.select(
        "class", "support",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        "hits",
    )
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), both))


def classification_report(df: DataFrame, truth: str, guess: str, digits: int = 9) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    # One row per class, written once: four parts of the report read it.
    classes = stored(per_class_report(df, truth, guess), "class-figures")
    measures = ["precision", "recall", "f1"]
    weight = F.col("support")
    macro = classes.agg(
        F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    weighted = classes.agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(m) * weight) / F.sum(weight)).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    overall = classes.agg(
        F.lit("accuracy").alias("class"),
        *[(F.sum("hits") / F.sum(weight)).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    report = classes.drop("hits").unionByName(overall).unionByName(macro).unionByName(weighted)
    return report.select("class", *[F.round(m, digits).alias(m) for m in measures], "support")


def confusion_matrix(df: DataFrame, truth: str, guess: str, classes: list[str]) -> DataFrame:
    """Wide matrix over the given classes on both axes, zeros filled in.

    Pairs with a side outside `classes` are left out.
    """
    pairs = pair_counts(df, truth, guess).where(F.col("y").isin(classes) & F.col("p").isin(classes))
    cells = [F.coalesce(F.sum(F.when(F.col("p") == c, F.col("n"))), F.lit(0)).alias(c) for c in classes]
    filled = pairs.groupBy("y").agg(*cells)
    axis = df.sparkSession.createDataFrame([(c,) for c in classes], "y string")
    return F.broadcast(axis).join(filled, "y", "left").fillna(0, classes)


def class_names(df: DataFrame, truth: str, guess: str) -> list[str]:
    """Sorted classes of both sides: as many as there are labels."""
    pairs = pair_counts(df, truth, guess)
    names = pairs.select(F.explode(F.array("y", "p")).alias("class")).where("class IS NOT NULL").distinct()
    return sorted(r["class"] for r in names.collect())


def error_destinations(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Where wrong rows went: counts per predicted label."""
    wrong = df.where(~F.col(truth).eqNullSafe(F.col(guess)))
    return wrong.groupBy(F.col(guess).alias("predicted_label")).agg(F.count(F.lit(1)).alias("n"))
