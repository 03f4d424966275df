"""Hard negatives by bounds along spanning trees of the anchors.

Anchors are dealt into blocks, and each block gets a minimum spanning tree. A vector's scores at two
anchors differ by no more than the distance of the anchors times the vector's norm, so from a score
at the parent, or from the bounds there, follow bounds at the child. Only vectors whose bounds reach
into what the child looks for are scored there anew, exactly: for positives all above the fifth
best so far, for negatives the windows under the positives' scores, which become narrower as
better negatives are found.

A pass takes some blocks, broadcasts them and reads all vectors once for the positives and once for
the negatives. A task gives its best rows per anchor, and Spark ranks these over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import ship, stored

POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these hundredths of its positive's.
LEAST, MOST = 80, 100
SCALE = 256
#: Anchors of a tree, on average, and trees of a pass; they bound what is collected and broadcast:
#: for each anchor its components and some numbers, 9 MB a pass for 64 components.
BLOCK, BLOCKS_A_PASS = 1024, 16
#: Squared norms up to which every score is a whole number of 64 bits.
LONGEST = float(1 << 62)
_EXACT = float(1 << 53)
_NO_ID = np.iinfo(np.int64).max
_NONE = np.iinfo(np.int64).min


@dataclass
class Tree:
    """Anchors of a block with a spanning tree; `order` has parents first and the largest child last."""

    block: int
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parents: np.ndarray
    edges: np.ndarray
    order: np.ndarray

    def __post_init__(self):
        self.norms = np.sqrt((self.vectors.astype(float) ** 2).sum(axis=1))
        self.floats = self.vectors.astype(float)
        self.last = np.full(len(self.ids), -1)
        for node in self.order:
            if self.parents[node] >= 0:
                self.last[self.parents[node]] = node


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parents (-1 for the root), lengths of the edges to them, and an order for the visit."""
    points, n = vectors.astype(float), len(vectors)
    squares = (points**2).sum(axis=1)
    parents, nearest = np.full(n, -1), np.full(n, np.inf)
    open_nodes, added, node = np.ones(n, bool), [], 0
    for _ in range(n):
        added.append(node)
        open_nodes[node] = False
        distance = squares + squares[node] - 2 * (points @ points[node])
        closer = open_nodes & (distance < nearest)
        nearest[closer], parents[closer] = distance[closer], node
        node = int(np.argmin(np.where(open_nodes, nearest, np.inf)))
    edges = np.zeros(n)
    inner = parents >= 0
    edges[inner] = np.sqrt(((points[inner] - points[parents[inner]]) ** 2).sum(axis=1))
    size, children = np.ones(n, int), [[] for _ in range(n)]
    for child in reversed(added[1:]):
        size[parents[child]] += size[child]
        children[parents[child]].append(child)
    order, stack = [], [0] if n else []
    while stack:
        node = stack.pop()
        order.append(node)
        # The largest subtree is visited last, so few nodes wait for their bounds at any time.
        stack += sorted(children[node], key=lambda c: -size[c])
    return parents, edges, np.array(order, int)


def _matrix(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole components, short vectors filled with zeros, and whether all are finite and not too long."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), int)
    flat = column.flatten()
    values = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), float)  # nulls become NaN
    width = int(lengths.max(initial=0))
    place = np.arange(width) < lengths[:, None]
    out = np.zeros((len(lengths), width))
    out[place] = values
    good = np.isfinite(out).all(axis=1) & np.asarray(column.is_valid().to_numpy(zero_copy_only=False), bool)
    out[~good] = 0
    out = np.floor(scale * out)
    good &= (out**2).sum(axis=1) <= LONGEST
    out[~good] = 0
    return out.astype(np.int64), good


def _fitted(x: np.ndarray, width: int) -> np.ndarray:
    """Of `width` components; those beyond meet zeros only."""
    if x.shape[1] >= width:
        return np.ascontiguousarray(x[:, :width])
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


class Search:
    """Scores of the rows of a chunk at the anchors of a tree, as far as they are looked for."""

    def __init__(self, tree: Tree, x: np.ndarray, labels: np.ndarray, ids: np.ndarray):
        self.tree, self.labels, self.ids = tree, labels, ids
        x = _fitted(x, tree.vectors.shape[1])
        self.norms = np.sqrt((x.astype(float) ** 2).sum(axis=1))
        self.exact = self.norms.max(initial=0) * tree.norms.max(initial=0) >= _EXACT
        self.x = x if self.exact else x.astype(float)
        self.met = self.scored = 0

    def _score(self, node: int, rows: np.ndarray) -> np.ndarray:
        """Exact: below 2^53 every sum of whole numbers is whole in floats, beyond that they stay integers."""
        vector = (self.tree.vectors if self.exact else self.tree.floats)[node]
        if 2 * len(rows) > len(self.x):
            return (self.x @ vector)[rows].astype(np.int64)
        return (self.x[rows] @ vector).astype(np.int64)

    def walk(self, wanted, allowed) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, rows, scores); `wanted(anchor)` gives lists of inclusive bounds, asked for on arrival,
        `allowed(anchor)` the rows that may be found at all."""
        tree, bounds = self.tree, {}
        for node in tree.order:
            ranges, may = wanted(node), allowed(node)
            parent = tree.parents[node]
            if parent < 0:
                low = high = None
                rows = np.arange(len(self.x))
            else:
                low, high = bounds[parent]
                # A little more than the bound itself, for what floats round off.
                slack = self.norms * (tree.edges[node] * (1 + 1e-9) + 1e-12 * tree.norms.max()) + 1e-6
                low, high = low - slack, high + slack
                reach = np.zeros(len(low), bool)
                for least, most in ranges:
                    reach |= (high >= least) & (low <= most)
                rows = np.flatnonzero(reach & may)
            scores = self._score(node, rows)
            self.met += len(self.x)
            self.scored += len(rows)
            if tree.last[node] >= 0:
                if parent < 0:
                    low = high = scores.astype(float)
                else:
                    low[rows] = high[rows] = scores
                bounds[node] = low, high
            if parent >= 0 and tree.last[parent] == node:
                del bounds[parent]
            inside = np.zeros(len(rows), bool)
            for least, most in ranges:
                inside |= (scores >= least) & (scores <= most)
            inside &= may[rows]
            yield node, rows[inside], scores[inside]


class Best:
    """The best few (score, id) of a number of lists, by score, then by smaller id."""

    def __init__(self, lists: int, few: int):
        self.scores = np.full((lists, few), _NONE)
        self.ids = np.full((lists, few), _NO_ID)
        self.found = np.zeros(lists, int)
        self.few = few

    def least(self, at: int):
        """What a further row must reach to be among the best; an equal score may, by its id."""
        return self.scores[at, -1] if self.found[at] == self.few else -np.inf

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        if len(scores) > 4 * self.few:
            bound = np.partition(scores, len(scores) - self.few)[len(scores) - self.few]
            scores, ids = scores[scores >= bound], ids[scores >= bound]
        n = self.found[at]
        scores, ids = np.concatenate([self.scores[at, :n], scores]), np.concatenate([self.ids[at, :n], ids])
        first = np.lexsort((ids, -scores))[: self.few]
        self.found[at] = len(first)
        self.scores[at, : len(first)], self.ids[at, : len(first)] = scores[first], ids[first]


def _chunks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, components) of the rows that take part, in pieces of bounded size."""
    for batch in batches:
        step = 2048
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            x, good = _matrix(part.column(2), scale)
            ids = part.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            labels = part.column(1).to_numpy(zero_copy_only=False)
            if good.any():
                yield ids[good], labels[good], x[good]


def _ids(values: list[int]) -> pa.Array:
    return pa.array([None if v == _NO_ID else v for v in values], pa.int64())


def find_positives(batches, trees: list[Tree], few: int, scale: int) -> Iterator[pa.RecordBatch]:
    """(block, anchor, id, score) of a task's best rows of each anchor's label."""
    best = [Best(len(t.ids), few) for t in trees]
    for ids, labels, x in _chunks(batches, scale):
        for tree, top in zip(trees, best, strict=True):
            search = Search(tree, x, labels, ids)
            found = search.walk(
                lambda node, top=top: [(top.least(node), np.inf)],
                lambda node, tree=tree: (labels == tree.labels[node]) & (ids != tree.ids[node]),
            )
            for node, rows, scores in found:
                top.add(node, scores, ids[rows])
    for tree, top in zip(trees, best, strict=True):
        at, place = np.nonzero(np.arange(few) < top.found[:, None])
        columns = [pa.array(np.full(len(at), tree.block)), pa.array(tree.ids[at]), _ids(top.ids[at, place].tolist()), pa.array(top.scores[at, place])]
        yield pa.RecordBatch.from_arrays(columns, ["block", "anchor_id", "positive_id", "positive_score"])


def window_of(score: int, least: int, most: int) -> tuple[int, int]:
    """Whole scores s with least * score <= 100 * s <= most * score."""
    return -(-least * score // 100), most * score // 100


def find_negatives(batches, trees: list[Tree], tops: list[dict[int, list[int]]], few: int, scale: int, least: int, most: int) -> Iterator[pa.RecordBatch]:
    """(anchor, positive score, id, score) of a task's best rows under each positive's score."""
    lists, best = [], []
    for tree, top in zip(trees, tops, strict=True):
        flat = [(node, score, *window_of(score, least, most)) for node in range(len(tree.ids)) for score in top.get(int(tree.ids[node]), [])]
        flat = [x for x in flat if x[2] <= x[3]]
        mine: list[list[int]] = [[] for _ in tree.ids]
        for k, x in enumerate(flat):
            mine[x[0]].append(k)
        lists.append((flat, mine))
        best.append(Best(len(flat), few))
    for ids, labels, x in _chunks(batches, scale):
        for tree, (flat, mine), found in zip(trees, lists, best, strict=True):

            def wanted(node, flat=flat, mine=mine, found=found):
                """The windows, each as far as a row in it may still be among its best, joined where they overlap."""
                out: list[tuple] = []
                for low, high in sorted((max(flat[k][2], found.least(k)), flat[k][3]) for k in mine[node]):
                    if out and low <= out[-1][1]:
                        out[-1] = out[-1][0], max(out[-1][1], high)
                    else:
                        out.append((low, high))
                return out

            search = Search(tree, x, labels, ids)
            for node, rows, scores in search.walk(wanted, lambda node, tree=tree: labels != tree.labels[node]):
                for k in mine[node]:
                    inside = (scores >= flat[k][2]) & (scores <= flat[k][3])
                    found.add(k, scores[inside], ids[rows[inside]])
    for tree, (flat, _), found in zip(trees, lists, best, strict=True):
        at, place = np.nonzero(np.arange(few) < found.found[:, None])
        nodes, scores = np.array([x[0] for x in flat], int), np.array([x[1] for x in flat], np.int64)
        columns = [pa.array(tree.ids[nodes[at]]), pa.array(scores[at]), _ids(found.ids[at, place].tolist()), pa.array(found.scores[at, place])]
        yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "positive_score", "negative_id", "negative_score"])


_TREE = "block bigint, ids array<bigint>, labels array<bigint>, width int, vectors array<bigint>, parents array<int>, edges array<double>, places array<int>"


def _grow(scale: int):
    def grow(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        x, good = _matrix(rows.column("v"), scale)
        keep = np.flatnonzero(good)
        x = x[keep]
        parents, edges, order = spanning_tree(x)

        def one(values, kind):
            return pa.array([list(values)], pa.list_(kind))

        return pa.table(
            {
                "block": rows.column("block").slice(0, 1),
                "ids": one(rows.column("id").to_numpy()[keep], pa.int64()),
                "labels": one(rows.column("l").to_numpy()[keep], pa.int64()),
                "width": pa.array([x.shape[1]], pa.int32()),
                "vectors": one(x.ravel(), pa.int64()),
                "parents": one(parents, pa.int32()),
                "edges": one(edges, pa.float64()),
                "places": one(order, pa.int32()),
            }
        )

    return grow


def _tree(row) -> Tree:
    ids = np.array(row.ids, np.int64)
    return Tree(
        row.block, ids, np.array(row.labels, np.int64), np.array(row.vectors, np.int64).reshape(len(ids), row.width),
        np.array(row.parents, int), np.array(row.edges, float), np.array(row.places, int),
    )


def _ranked(df: DataFrame, keys: list[str], score: str, vec_id: str, few: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(vec_id))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= few)


def mine_hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    scale: int = SCALE,
    block: int = BLOCK,
    blocks_a_pass: int = BLOCKS_A_PASS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of `floor(scale * component)`. An anchor's positives are the first
    other rows of its label, by score and then by smaller id; each gets its first rows of other
    labels whose score lies between `least` and `most` hundredths of the positive's.

    Rows with a null label or vector, or a component that is null, not finite, or so large that
    scores may leave 64 bits, take no part. Short and empty vectors are filled with zeros. Rows
    without id are no anchors and rank behind others of their score; an anchor's id counts once,
    and rows that repeat it are not others; other rows that repeat count as often as they come. An
    empty table, or one without anchors, gives no rows. Only the named columns are read. Labels
    and ids are whole numbers.

    Vectors are never shuffled or grouped; a label that most rows have costs no more than others.
    What a pass broadcasts is bounded by `block` and `blocks_a_pass`; more anchors take more passes.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.filter(F.col(label).isNotNull() & F.col(vector).isNotNull())
    rows = rows.select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("l"),
        F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    anchors = rows.filter(F.col("anchor") & F.col("id").isNotNull())
    anchors = anchors.groupBy("id").agg(F.min(F.struct("l", "v")).alias("r")).select("id", "r.*")
    anchors = stored(anchors, "anchors")
    count = anchors.count()
    blocks = max(1, -(-count // block))
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    trees = stored(dealt.groupBy("block").applyInArrow(_grow(scale), _TREE), "anchor-trees")
    vectors = rows.select("id", "l", "v")
    results = []
    for first in range(0, blocks, blocks_a_pass):
        mine = F.col("block").between(first, first + blocks_a_pass - 1)
        forest = [t for t in map(_tree, trees.filter(mine).orderBy("block").collect()) if len(t.ids)]
        results.append(_pass(vectors, forest, positives, negatives, least, most, scale))
    return reduce(DataFrame.unionByName, results)


def _pass(vectors: DataFrame, forest: list[Tree], positives: int, negatives: int, least: int, most: int, scale: int) -> DataFrame:
    context = vectors.sparkSession.sparkContext
    shared = context.broadcast(forest)
    near = vectors.mapInArrow(
        lambda batches: find_positives(batches, shared.value, positives, scale),
        "block bigint, anchor_id bigint, positive_id bigint, positive_score bigint",
    )
    near = stored(_ranked(near, ["anchor_id"], "positive_score", "positive_id", positives, "place"), "positives")
    tops: dict[int, dict[int, list[int]]] = {tree.block: {} for tree in forest}
    for row in near.select("block", "anchor_id", "positive_score").distinct().collect():
        tops[row.block].setdefault(row.anchor_id, []).append(row.positive_score)
    windows = context.broadcast([tops[tree.block] for tree in forest])
    hard = vectors.mapInArrow(
        lambda batches: find_negatives(batches, shared.value, windows.value, negatives, scale, least, most),
        "anchor_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    hard = stored(_ranked(hard, ["anchor_id", "positive_score"], "negative_score", "negative_id", negatives, "rank"), "negatives")
    found = near.join(hard, ["anchor_id", "positive_score"])
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
