"""Mixing sources to target weights by Poisson replication, in built-in expressions.

A source's rate is how often its documents should appear on average, so that its share of the
mixture's characters is its target weight. A document's number of copies is the Poisson quantile
of a number in [0, 1) that a hash of seed and id gives: the same in every run and on every
machine, independent between documents, with the source's rate as its mean.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import drop_columns, shielded, stored

#: Weights of sources not named: a source's share to this power, so that small ones gain.
POWER = 0.7
SEED = "mixture-1"


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from a hash."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _cumulative(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ..., as far as doubles tell it from one; sums of logarithms, so
    that large rates do not underflow."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(
        (-rate).alias("log"),
        F.exp(-rate).alias("sum"),
        F.array(F.exp(-rate)).alias("all"),
    )

    def add(acc: Column, k: Column) -> Column:
        log = acc["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = acc["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(acc["all"], F.array(total)).alias("all"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, add, lambda acc: acc["all"]))


def source_rates(
    df: DataFrame, weights: Mapping[str, float] | None = None, size: float = 1.0,
    source: str = "source", text: str = "text", power: float = POWER,
) -> DataFrame:
    """(source, n_chars, weight, rate) of every source, the null source included.

    Weights need not sum to one. With `weights`, sources not named have weight zero; without,
    a source's weight is its number of characters to `power`. The mixture has `size` times as
    many characters as the input, on average. A source without characters has rate zero.
    """
    sums = df.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.char_length(text), F.lit(0)).cast("bigint")).alias("n_chars")
    )
    if weights is None:
        weight = F.pow(F.col("n_chars").cast("double"), F.lit(power))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
    sums = stored(sums.withColumn("weight", F.when(F.col("n_chars") > 0, weight).otherwise(0.0)), "source-sizes")
    whole = sums.agg(F.sum("n_chars").alias("chars"), F.sum("weight").alias("weights")).first()
    chars, total = float(whole["chars"] or 0), float(whole["weights"] or 0)
    share = F.col("weight") / F.lit(total or 1.0)
    rate = F.when(F.col("n_chars") > 0, share * F.lit(size * chars) / F.col("n_chars")).otherwise(0.0)
    return sums.select("source", "n_chars", share.alias("weight"), rate.alias("rate"))


@shielded
def mix_sources(
    df: DataFrame, weights: Mapping[str, float] | None = None, size: float = 1.0, seed: str = SEED,
    doc_id: str = "doc_id", source: str = "source", text: str = "text", power: float = POWER,
) -> DataFrame:
    """Each document as often as drawn, with `copy` (from 1) and `shuffle_key`, in global order of the key.

    Rows of a null source are a source of their own. Rows that share an id, or have none, are
    drawn alike. Null and empty texts count no characters but are drawn at their source's rate;
    a source of such texts alone is left out, as is one with weight zero. An empty table stays
    empty; columns of the two names are replaced. Sources are summed by partial sums, and joined
    by the size of the written table of rates, so a source with a third of all rows is no task
    of its own. The order is that of a hash of seed, id and copy, in parts of its range. Texts of any
    length are only carried along; columns with names like `__n` come back as they were.
    """
    df = drop_columns(df, "copy", "shuffle_key")
    rates = stored(source_rates(df, weights, size, source, text, power), "source-rates")
    rates = rates.filter("rate > 0").select(F.col("source").alias("__source"), _cumulative(F.col("rate")).alias("__chances"))
    drawn = df.join(rates, F.col(source).eqNullSafe(F.col("__source")))
    value = uniform(seed, F.col(doc_id))
    # Quantile: as many copies as there are k with P(X <= k) not above the number.
    drawn = drawn.withColumn("__u", value)
    count = F.size(F.filter("__chances", lambda c: c <= F.col("__u")))
    copies = drawn.withColumn("__n", count).filter("__n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col("copy"))
    keyed = copies.drop("__source", "__chances", "__u", "__n").withColumn("shuffle_key", F.md5(name))
    # The key is a hash, so its range is cut evenly; a range shuffle would draw everything twice to find the cuts.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return keyed.repartitionById(parts, F.floor(place * parts).cast("int")).sortWithinPartitions("shuffle_key")
