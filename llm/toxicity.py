"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value calibration.

Tokens score by how much likelier they make the label, with Dirichlet priors in two levels: a
word's counts are smoothed towards those of its first letters, these towards the rate of the
whole. A linear scan finds every maximal-scoring segment of a text. By chance a text of n tokens
reaches a segment score of x with the extreme-value probability 1 - exp(-K n exp(-l x)); l and K
are fitted on texts without the label. What segments score beyond chance adds up to a text's
evidence, which a logistic curve turns into a probability.

Extremes and curve are fitted on labelled texts whose tokens score by the counts of the other folds,
so that no text is judged by what it taught itself. Then all texts are scanned once, by all counts;
every segment beyond chance counts, however low its score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import ship, stored

#: Cells of the tables of counts, for words and for beginnings, by hash: words may share one. The
#: tables have this size for any corpus and are what is collected and broadcast, a pair for each of
#: the calibration's folds (about 36 MB, then 9 MB).
WORD_CELLS, START_CELLS = 1 << 20, 1 << 16
START_LETTERS = 5
#: Strength of the priors, in documents, and what every token costs a segment.
WORD_PRIOR, START_PRIOR, DRIFT = 12.0, 12.0, 0.35
#: Labelled rows to learn from, about: beyond this number a share of them is drawn by a hash of the
#: id. It bounds what is broadcast to find their texts (a few MB).
MOST_LABELS = 200_000
#: Folds of the labelled rows for the calibration.
FOLDS = 4
_EDGES = ".,;:!?\"'()[]{}<>|#*$%&-_+=/\\«»“”„‘’…"
_MEMORY = 300_000


def tokens_of(text: str | None) -> list[str]:
    """Lower-case words without signs at their edges; words of signs alone are ''."""
    return [w.strip(_EDGES) for w in text.lower().split()] if text else []


def cells(token: str) -> tuple[int, int]:
    """A word's cell and its beginning's."""
    word = xxhash.xxh64_intdigest(token.encode("utf-8", "replace"))
    start = xxhash.xxh64_intdigest(token[:START_LETTERS].encode("utf-8", "replace"), 1)
    return word % WORD_CELLS, WORD_CELLS + start % START_CELLS


class Odds(dict):
    """Token scores, remembered up to a number of tokens."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray, rate: float):
        super().__init__()
        self.toxic, self.clean, self.rate = toxic, clean, rate
        self.logit = math.log(rate / (1 - rate))

    def __missing__(self, token: str) -> float:
        if len(self) >= _MEMORY:
            self.clear()
        if not token:
            value = 0.0
        else:
            word, start = cells(token)
            known = self.toxic[start] + self.clean[start]
            prior = (self.toxic[start] + START_PRIOR * self.rate) / (known + START_PRIOR)
            known = self.toxic[word] + self.clean[word]
            share = (self.toxic[word] + WORD_PRIOR * prior) / (known + WORD_PRIOR)
            share = min(max(share, 1e-6), 1 - 1e-6)
            value = math.log(share / (1 - share)) - self.logit
        value = self[token] = float(value) - DRIFT
        return value


def maximal_segments(scores: np.ndarray, least: float = 0.0) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) with at least `least`, by one scan.

    A segment is kept as the sums before it and up to its end. A new positive score joins back
    over earlier segments as long as that makes a larger one; every segment is looked at a
    bounded number of times, since joined ones leave the list.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # start, end, sum before, sum at the end
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, low, high = i, i + 1, sums[i], sums[i + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
        # Where the search for a smaller sum before goes on, from this segment.
        k = len(found) - 1
        while k >= 0 and found[k][2] >= low:
            k = found[k][4]
        found.append([start, end, low, high, k])
    return [(a, b, float(y - x)) for a, b, x, y, _ in found if y - x >= least]


def count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, toxic, text) to sums per part and cell, each word once per document."""
    sums = np.zeros((FOLDS, 2, WORD_CELLS + START_CELLS), np.int32)
    memory: dict[str, tuple[int, int]] = {}
    for batch in batches:
        for part, label, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            mine = set()
            for token in set(tokens_of(text)):
                if token:
                    if (pair := memory.get(token)) is None:
                        if len(memory) >= _MEMORY:
                            memory.clear()
                        pair = memory[token] = cells(token)
                    mine.update(pair)
            sums[part, int(label), np.fromiter(mine, np.int64, len(mine))] += 1
    for part in range(FOLDS):
        some = np.flatnonzero(sums[part].any(axis=0))
        columns = [np.full(len(some), part, np.int32), some.astype(np.int32), *(sums[part, k, some].astype(np.int64) for k in (1, 0))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "cell", "toxic", "clean"])


def fit_extremes(counts: dict[tuple[int, int], int]) -> tuple[float, float]:
    """l and log K from how many clean texts have which length (power of two) and best score.

    Within a length class the best scores of texts without toxic passages vary by l alone, and
    their mean gives K: the variance of the law is pi^2 / 6 l^2, its mean (log Kn + 0.577) / l.
    The upper tail is cut at the 98th percentile against texts that are mislabelled.
    """
    by: dict[int, list[tuple[float, int]]] = {}
    for (length, score), n in counts.items():
        by.setdefault(length, []).append((score / 4, n))
    spread, means, total = 0.0, [], 0
    for length, rows in by.items():
        rows.sort()
        size, kept, left = sum(n for _, n in rows), [], 0.98 * sum(n for _, n in rows)
        for x, n in rows:
            if left > 0:
                kept.append((x, min(n, left)))
                left -= n
        mass = sum(n for _, n in kept)
        mean = sum(x * n for x, n in kept) / mass
        spread += sum(n * (x - mean) ** 2 for x, n in kept)
        total += mass
        means.append((length, mean, size))
    variance = spread / total if total else 0.0
    rate = math.pi / math.sqrt(6 * max(variance, 0.05))
    weight = sum(size for *_, size in means) or 1
    log_k = sum(size * (rate * mean - 0.5772 - length * math.log(2)) for length, mean, size in means) / weight
    return rate, log_k


def fit_curve(counts: dict[int, tuple[int, int]]) -> tuple[float, float]:
    """Bias and slope of the logistic curve over evidence in quarters, by Newton's method."""
    x = np.array(sorted(counts), float) / 4
    clean, toxic = np.array([counts[k] for k in sorted(counts)], float).reshape(-1, 2).T
    design, weights = np.stack([np.ones_like(x), x], axis=1), np.array([-2.0, 1.0])
    for _ in range(60 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (toxic - (toxic + clean) * p) - 1e-3 * weights
        bend = (design.T * ((toxic + clean) * p * (1 - p))) @ design + np.diag([1e-3, 1e-3])
        weights = weights + np.clip(np.linalg.solve(bend, slope), -1, 1)
    return float(weights[0]), float(max(weights[1], 1e-3))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", fold: int = 5,
    most_labels: int = MOST_LABELS,
) -> DataFrame:
    """(id, held_out, score, predicted, n_tokens, evidence, passages) of every row of `docs`.

    Learns from rows of `labels` whose crc32 of the id as text does not leave 0 modulo `fold`;
    null labels and ids teach nothing, a document labelled twice teaches twice. Of more than
    `most_labels` such rows a share drawn by hash is learnt from; all texts are scored. Passages are the
    segments beyond chance: first and last token (exclusive), score, and the number of such
    expected by chance in the text. Null, empty and wordless texts have none and get the score
    of no evidence. Without labels all get the smoothed rate. Repeated rows are scored alike; an
    empty table gives no rows. Very long texts are scanned whole, in time that grows with their
    length. Other columns are not read. Texts are never shuffled: cells of counts are, as many as
    the tables have, and their sums are collected.
    """
    spark = docs.sparkSession
    ship(spark)
    fold_of = lambda c: F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % fold
    narrow = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isNotNull() & F.col("id").isNotNull() & (fold_of(F.col("id")) != 0))

    total = known.count()
    if total > most_labels:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int(most_labels / total * (1 << 40)))
    # At most about `most_labels` narrow rows, so every task can have them all.
    known = F.broadcast(stored(known, "toxic-labels"))

    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)).cast("int")
    taught = narrow.join(known, "id").select(part.alias("part"), (F.col("toxic") > 0).alias("toxic"), "text")
    parts = taught.mapInArrow(count_cells, "part int, cell int, toxic bigint, clean bigint")
    sums = parts.groupBy("part", "cell").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    found = sums.toArrow()  # as many rows as there are cells in the folds
    counts = np.zeros((FOLDS, 2, WORD_CELLS + START_CELLS), np.float32)
    at = found.column("part").to_numpy(), found.column("cell").to_numpy()
    counts[at[0], 0, at[1]], counts[at[0], 1, at[1]] = found.column("toxic").to_numpy(), found.column("clean").to_numpy()
    del found
    classes = {row["toxic"]: row["n"] for row in known.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    rate = (classes.get(True, 0) + 0.5) / (sum(classes.values()) + 1)
    whole = counts.sum(axis=0)
    folds = spark.sparkContext.broadcast((whole[None] - counts, rate))
    table = spark.sparkContext.broadcast((whole, rate))
    del counts, whole

    def scan_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(toxic, n_tokens, scores of all segments) of labelled texts, by the counts of the other folds."""
        tables, mean = folds.value
        odds = [Odds(*tables[k], mean) for k in range(FOLDS)]
        for batch in batches:
            sizes, scores = [], []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tokens = tokens_of(text)
                found = maximal_segments(np.fromiter(map(odds[number].__getitem__, tokens), float, len(tokens)))
                sizes.append(len(tokens))
                scores.append([x for _, _, x in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(sizes, pa.int64()), pa.array(scores, pa.list_(pa.float64()))], ["toxic", "n_tokens", "scores"]
            )

    others = stored(taught.mapInArrow(scan_others, "toxic boolean, n_tokens bigint, scores array<double>"), "toxic-segments")
    length = F.greatest(F.col("n_tokens"), F.lit(1)).cast("double")
    best = F.coalesce(F.array_max("scores"), F.lit(0.0))
    cleans = others.filter("NOT toxic").groupBy(
        F.round(F.log2(length)).cast("int").alias("length"), F.round(best * 4).cast("int").alias("best")
    ).count()
    # Here and below no more rows come than there are labelled rows to learn from.
    decay, log_k = fit_extremes({(row["length"], row["best"]): row["count"] for row in cleans.collect()})
    excess = F.transform("scores", lambda x: F.greatest(x * decay - (F.log(length) + log_k), F.lit(0.0)))
    evidence = F.aggregate(excess, F.lit(0.0), lambda acc, x: acc + x)
    seen = others.groupBy(F.round(evidence * 4).cast("int").alias("bin")).agg(
        F.count_if(~F.col("toxic")).alias("clean"), F.count_if("toxic").alias("toxic")
    )
    bias, slope = fit_curve({row["bin"]: (row["clean"], row["toxic"]) for row in seen.collect()})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, mean = table.value
        odds = Odds(*counted, mean)
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("by_chance", pa.float64())])
        for batch in batches:
            sizes, sums, passages = [], [], []
            for value in batch.column(1).to_pylist():
                tokens = tokens_of(value)
                scores = np.fromiter(map(odds.__getitem__, tokens), float, len(tokens))
                chance = math.log(max(len(tokens), 1)) + log_k
                beyond = [(a, b, x, x * decay - chance) for a, b, x in maximal_segments(scores) if x * decay > chance]
                sizes.append(len(tokens))
                sums.append(math.fsum(x[3] for x in beyond))
                passages.append([{"start": a, "end": b, "score": x, "by_chance": math.exp(-y)} for a, b, x, y in beyond])
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64()), pa.array(passages, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "evidence", "passages"])

    bins = narrow.mapInArrow(
        scan,
        f"id {id_type}, n_tokens bigint, evidence double, "
        "passages array<struct<start:int,end:int,score:double,by_chance:double>>",
    )
    curve = 1 / (1 + F.exp(-(F.lit(bias) + F.lit(slope) * F.col("evidence"))))
    return bins.withColumn("score", curve if classes else F.lit(rate)).select(
        F.col("id").alias(doc_id),
        (fold_of(F.col("id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_tokens",
        "evidence",
        "passages",
    )
