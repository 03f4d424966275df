"""Merkle manifest of a table: hash trees by group, one root, and proofs by pointer jumping.

A leaf is the digest of a row's fields. The leaves of a group stand in order of their key; every
eight nodes in a row, a run, become their digest, level by level, until one node is left, the
group's subroot. The subroots, in order of their group, become the root in the same way.

A run is one row of a table, with the digests of its nodes: it holds the siblings of each of
them, so all that stands above the leaves has an eighth of their rows or less. For the proofs each
run holds a segment, the runs from itself towards an ancestor, and points to that ancestor. A
self-join puts the ancestor's segment behind the own one and takes over its pointer, which doubles
the distance; after as many joins as the height has binary digits every segment ends at the root.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import lower_ascii, stored

FANOUT = 8
#: The one group of the tree over the subroots.
TOP = "top"
_STEP = "array<struct<digests:array<string>,alone:boolean,at:int>>"


def sha256(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """`-` for a null, else the length in bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """A row's digest from its values, in order."""
    return sha256(*[field(v) for v in values])


def lower_case_leaf(fields: Sequence[str], text: str) -> Column:
    """The digest of the row whose text has its A to Z in small letters."""
    return leaf(*[lower_ascii(F.col(c)) if c == text else F.col(c) for c in fields])


def numbered(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add `index`, the place from 0 in the group along a unique order, for groups of any size.

    Rows are dealt by ranges of (group, order), so a group is spread over as many tasks as it
    needs; sums over (task, group) carry the numbers over the cuts.
    """
    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(ranged.withColumn("__place", F.monotonically_increasing_id()), "placed-nodes")
    placed = placed.withColumns(
        {"__task": F.shiftright("__place", 33), "__place": F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    cells = placed.groupBy(group, "__task").agg(F.count("*").alias("n"), F.min("__place").alias("first"))
    before = Window.partitionBy(group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    shifts = stored(cells.select(group, "__task", shift.alias("__shift")), "node-offsets")
    return placed.join(shifts, [group, "__task"]).withColumn("index", F.col("__place") + F.col("__shift")).drop(
        "__place", "__task", "__shift"
    )


def _runs(nodes: DataFrame, fanout: int, *carried: str) -> DataFrame:
    """Runs of `nodes(grp, index, digest, carried...)`; the nodes of a run are in order.

    A run 0 of one node is the only run of its level: its node stays as it is and ends the tree.
    """
    member = F.struct("index", "digest", *carried)
    runs = nodes.groupBy("grp", F.floor(F.col("index") / fanout).alias("run")).agg(
        F.sort_array(F.collect_list(member)).alias("members")
    )
    alone = (F.col("run") == 0) & (F.size("members") == 1)
    return runs.withColumns({"digests": F.col("members.digest"), "alone": alone}).withColumn(
        "digest", F.when(F.col("alone"), F.get("digests", F.lit(0))).otherwise(F.sha2(F.array_join("digests", ""), 256))
    )


def _grown(nodes: DataFrame, tree: int, fanout: int, *carried: str) -> tuple[DataFrame, DataFrame]:
    """All runs of the trees over `nodes`, each level written once, and (grp, height, digest) of the tops.

    A lone leaf has a run of its own, so that it has a row; above the leaves lone runs are left out.
    """
    first = made = stored(_runs(nodes, fanout, *carried), "runs")
    level, levels, tops = 0, [], []
    while True:
        here = F.lit(level).alias("level")
        tops.append(made.filter("alone").select("grp", F.lit(level).alias("height"), "digest"))
        levels.append((made if level == 0 else made.filter("NOT alone")).select(F.lit(tree).alias("tree"), here, "grp", "run", "digests", "alone"))
        open_runs = made.filter("NOT alone")
        if open_runs.isEmpty():
            break
        made = stored(_runs(open_runs.select("grp", F.col("run").alias("index"), "digest"), fanout), "runs")
        level += 1
    runs = reduce(DataFrame.unionByName, levels)
    if carried:
        leaves = first.select("grp", "run", "members")
        return runs.join(leaves.withColumn("level", F.lit(0)), ["grp", "run", "level"], "left"), reduce(DataFrame.unionByName, tops)
    return runs, reduce(DataFrame.unionByName, tops)


def _name(tree: Column, level: Column, run: Column, group: Column) -> Column:
    return F.concat_ws(":", tree, level, run, group)


def jump(pointers: DataFrame) -> DataFrame:
    """Double the distance of `pointers(id, level, next, path)` until none is left to go.

    `level` counts from the leaves and only goes up along a pointer; after k rounds an ancestor
    stands 2^k levels up at least, so the joined side shrinks by the fanout's power, and is
    broadcast when it has become small.
    """
    distance = 1
    while not pointers.filter("next IS NOT NULL").isEmpty():
        ahead = pointers.filter(F.col("level") >= distance)
        ahead = stored(ahead.select(F.col("id").alias("next"), F.col("next").alias("beyond"), F.col("path").alias("rest")), "ancestors")
        joined = pointers.join(ahead, "next", "left")
        path = F.when(F.col("rest").isNull(), F.col("path")).otherwise(F.concat("path", "rest"))
        pointers = stored(joined.select("id", "level", F.col("beyond").alias("next"), path.alias("path")), "pointers")
        distance *= 2
    return pointers


def prove(
    df: DataFrame,
    fields: Sequence[str],
    key: str,
    group: str,
    carried: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """(key, leaf, carried..., at, path, subroot, root): a row per leaf, with its proof.

    `path` has the runs from the leaf's own up to the root: the run's digests, whether its one
    node stands for itself, and the place of the run's digest in the next run; `at` is the
    leaf's place in the first. `siblings` and `folded` read it.

    Nulls in any field count as `-`. Leaves of a group stand in order of `key`, nulls first, then
    of their digest, so rows that repeat are leaves of their own, side by side; which of them is
    first makes no difference. A null group comes before all others. Empty and very long texts
    are hashed whole; an empty table gives no rows. Only the named columns are read, so others
    may have any name. `carried` expressions are computed with the leaves, in the one pass over
    the texts; a group of any size is dealt by ranges, and no task sees more than a run of it.
    """
    carried = dict(carried or {})
    whole = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = df.select(
        F.col(key).alias("key"), whole.alias("grp"), leaf(*[F.col(c) for c in fields]).alias("digest"),
        *[value.alias(f"_{name}") for name, value in carried.items()],
    ).withColumn("row", F.monotonically_increasing_id())
    names = [f"_{name}" for name in carried]
    leaves = numbered(stored(leaves, "leaves"), "grp", ["key", "digest", "row"]).drop("row")
    runs, tops = _grown(leaves, 0, fanout, "key", *names)
    tops = numbered(stored(tops, "subroots").withColumn("top", F.lit(TOP)), "top", ["grp"])
    tops = stored(tops.select("grp", "height", F.col("digest").alias("subroot"), "index"), "numbered-subroots")
    top_runs, roots = _grown(tops.select(F.lit(TOP).alias("grp"), "index", F.col("subroot").alias("digest")), 1, fanout)
    top = roots.first()
    root, several = (top["digest"], top["height"] > 0) if top else (None, False)
    height = top["height"] if top else 0

    # A run's digest is node `run` of the next level, so the next run follows from its number; at
    # the subroot the way goes on in the upper tree.
    up, place = F.floor(F.col("run") / fanout), F.pmod("run", F.lit(fanout)).cast("int")
    below = runs.join(tops, "grp")
    ends = F.col("level") + F.when(F.col("alone"), 0).otherwise(1) == F.col("height")
    over = _name(F.lit(1), F.lit(0), F.floor(F.col("index") / fanout), F.lit(TOP)) if several else F.lit(None).cast("string")
    over_place = F.pmod("index", F.lit(fanout)).cast("int") if several else F.lit(None).cast("int")
    lower = below.select(
        _name(F.lit(0), F.col("level"), F.col("run"), F.col("grp")).alias("id"), "level", "digests", "alone",
        F.when(ends, over).otherwise(_name(F.lit(0), F.col("level") + 1, up, F.col("grp"))).alias("next"),
        F.when(ends, over_place).otherwise(place).alias("at"),
    )
    highest = tops.agg(F.max("height")).first()[0] or 0
    last = F.col("level") + 1 == height
    upper = top_runs.filter("NOT alone").select(
        _name(F.lit(1), F.col("level"), F.col("run"), F.col("grp")).alias("id"),
        (F.col("level") + highest + 1).alias("level"), "digests", "alone",
        F.when(~last, _name(F.lit(1), F.col("level") + 1, up, F.col("grp"))).alias("next"),
        F.when(~last, place).alias("at"),
    )
    pointers = lower.unionByName(upper)
    path = F.array(F.struct("digests", "alone", "at")).cast(_STEP)
    pointers = jump(stored(pointers.select("id", "level", "next", path.alias("path")), "pointers"))

    first = below.filter("level = 0").select(_name(F.lit(0), F.lit(0), F.col("run"), F.col("grp")).alias("id"), "members", "subroot")
    proven = first.join(pointers.select("id", "path"), "id").select("subroot", "path", F.inline("members"))
    return proven.select(
        F.col("key").alias(key),
        F.col("digest").alias("leaf"),
        *[F.col(f"_{name}").alias(name) for name in carried],
        F.pmod("index", F.lit(fanout)).cast("int").alias("at"),
        "path",
        "subroot",
        F.lit(root).cast("string").alias("root"),
    )


def _walked(start: Column, path: Column, at: Column, fanout: int) -> Column:
    """(siblings so far, digest so far) along the path."""

    def step(acc: Column, run: Column) -> Column:
        left = F.array_join(F.slice(run["digests"], F.lit(1), acc["at"]), "")
        right = F.array_join(F.slice(run["digests"], acc["at"] + 2, F.lit(fanout)), "")
        return F.struct(
            F.concat(acc["siblings"], left, right).alias("siblings"),
            F.when(run["alone"], acc["digest"]).otherwise(sha256(left, acc["digest"], right)).alias("digest"),
            run["at"].alias("at"),
        )

    begin = F.struct(F.lit("").alias("siblings"), start.alias("digest"), at.alias("at"))
    return F.aggregate(path, begin, step)


def verified(proofs: DataFrame, start: Column, fanout: int = FANOUT) -> DataFrame:
    """Add `siblings`, the proof's digests as one text from the leaf's level up, `folded_root`,
    what the digest `start` in the leaf's place leads to, and `verified`, whether that is the root."""
    walked = proofs.withColumn("__walked", _walked(start, F.col("path"), F.col("at"), fanout))
    return walked.withColumns(
        {"siblings": F.col("__walked.siblings"), "folded_root": F.col("__walked.digest")}
    ).withColumn("verified", F.col("folded_root") == F.col("root")).drop("__walked")
