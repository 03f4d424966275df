"""Benchmark decontamination: a prefix-filtered join of document words with item windows.

An item's shingles are its windows of ten words (an item of fewer words is one window). To find a
window whole, it is enough to look where the rarest of its words stands: words are ordered by how
often the documents hold them, and the rarest is the window's necessary prefix. Where a document
has that word, the word's place in the window says where the window would begin; a start before
the text or an end behind it is ruled out, and the words in between are compared.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import drop_columns, map_batches, shielded, ship, stored

WINDOW = 10
#: (window, item) pairs that one pass over the documents looks for. It bounds what is collected
#: and broadcast, about 100 MB; a larger benchmark takes several passes, each over all documents.
PAIRS_A_PASS = 400_000

#: A to Z become small letters; other ASCII characters that are no letter or digit part words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_HIT = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def windows_of(words: list[bytes], size: int) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def item_windows(items: DataFrame, item_id: str, text: str, size: int = WINDOW) -> DataFrame:
    """(item, window), each pair once. Items without words have none; a null id is the id ''."""

    def explode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, windows = [], []
        for item, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = list(dict.fromkeys(windows_of(words_of(value), size)))
            ids += [item] * len(found)
            windows += found
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(windows, pa.binary())], ["item", "window"])

    narrow = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(text).cast("binary")
    )
    return map_batches(narrow, explode, "item string, window binary").distinct()


def corpus_counts(docs: DataFrame, text: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often all documents together hold each word of a bounded vocabulary."""
    wanted = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = Counter(), wanted.value.__contains__
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts.update(filter(known, words_of(value)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    partial = docs.select(F.col(text).cast("binary")).mapInArrow(count, "word binary, n bigint")
    totals = partial.groupBy("word").agg(F.sum("n").alias("n"))  # no more rows than the vocabulary
    return {bytes(row.word): row.n for row in totals.collect()}


def plan_block(pairs: list[tuple[str, bytes]], counts: dict[bytes, int]) -> tuple[dict, dict]:
    """Items by window, and (place, length) of windows by the rarest word, the prefix."""
    items, prefixes = defaultdict(list), defaultdict(set)
    for item, window in pairs:
        items[window].append(item)
    for window in items:
        words = window.split()
        rarest = min(words, key=lambda w: (counts.get(w, 0), w))
        prefixes[rarest].add((words.index(rarest), len(words)))
    return dict(items), {word: tuple(places) for word, places in prefixes.items()}


def find_windows(words: list[bytes], items: dict, prefixes: dict) -> tuple[list[tuple[int, int]], list[str]]:
    """Merged stretches of words inside windows, and the items whose windows occur."""
    total, hits, found = len(words), set(), set()
    for i in [i for i, word in enumerate(words) if word in prefixes]:
        for place, size in prefixes[words[i]]:
            start = i - place
            if start < 0 or start + size > total or (start, size) in hits:
                continue
            if (owners := items.get(b" ".join(words[start : start + size]))) is not None:
                hits.add((start, size))
                found.update(owners)
    spans: list[tuple[int, int]] = []
    for start, size in sorted(hits):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], start + size))
        else:
            spans.append((start, start + size))
    return spans, sorted(found)


def _matcher(docs: DataFrame, pairs: list[tuple[str, bytes]], counts: dict[bytes, int]):
    block = docs.sparkSession.sparkContext.broadcast(plan_block(pairs, counts))

    @F.arrow_udf(_HIT)
    def match(texts: pa.Array) -> pa.Array:
        items, prefixes = block.value
        out = []
        for value in texts.to_pylist():
            words = words_of(value)
            spans, found = find_windows(words, items, prefixes)
            out.append({"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans], "items": found})
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])
        return pa.array(out, kind)

    return match


def _covered(spans: Column) -> Column:
    """Words in the union of stretches that are in order of their start."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["end"]), F.lit(0).cast("bigint"))).alias("n"),
            F.greatest(acc["end"], s["end"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )


@shielded
def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    pairs_a_pass: int = PAIRS_A_PASS,
) -> DataFrame:
    """Add `n_words`, `hit_spans` (stretches of word numbers), `n_hit` and `hit_items` to documents.

    Null, empty and wordless texts have no words and no hits, null and wordless items no windows;
    an empty benchmark or document table gives no hits or no rows. Repeated documents are judged
    alike; items with one id are one item. Columns of the four names are replaced, others come back as
    they were. Very long texts are matched whole, in time that grows with their length. Documents are
    never shuffled; their words are counted in one pass and matched in a second, once for every
    `pairs_a_pass` pairs of item and window.
    """
    ship(docs.sparkSession)
    docs = drop_columns(docs, "n_words", "hit_spans", "n_hit", "hit_items")
    pairs = stored(item_windows(items, item_id, item_text, size), "item-windows")
    blocks = max(1, -(-pairs.count() // pairs_a_pass))
    whole = F.col(text).cast("binary")
    for number in range(blocks):
        mine = F.pmod(F.xxhash64("item", "window"), F.lit(blocks)) == number
        block = [(row.item, bytes(row.window)) for row in pairs.filter(mine).collect()]
        vocabulary = {word for _, window in block for word in window.split()}
        counts = corpus_counts(docs, text, vocabulary) if vocabulary else {}
        docs = docs.withColumn(f"__hit{number}", _matcher(docs, block, counts)(whole))
        if number + 1 < blocks:
            docs = stored(docs, "block-hits")  # one block at a time in a worker's memory
    hits = [F.col(f"__hit{number}") for number in range(blocks)]
    spans = F.sort_array(F.flatten(F.array(*[h["spans"] for h in hits])))
    found = F.array_sort(F.array_distinct(F.flatten(F.array(*[h["items"] for h in hits]))))
    return docs.withColumns(
        {"n_words": hits[0]["n_words"], "hit_spans": spans, "n_hit": _covered(spans), "hit_items": found}
    ).drop(*[f"__hit{number}" for number in range(blocks)])
