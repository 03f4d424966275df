"""URL filters: prefix rules first, then a tree of path templates per host, in built-in expressions.

A path is cut into segments; numbers and long hexadecimal names in them become `#`. Level by level
the urls of a host are led down a tree of templates: of a node with very many different segments
only frequent ones keep a branch, the rest share the wildcard `*`, and branches beside each other
whose urls are statistically alike (shares of good, bad, ended and numbered urls pass two-sample
tests) become one branch. A template is rejected if few of its labelled urls are good; counts are
smoothed, so that templates with few labels or none stay.

The tree is grown over the distinct generalised paths with their counts, not over the urls; these
are only joined to their template at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import drop_columns, lower_ascii, stored

ALLOW, BLOCK = "allow", "block"
#: Segments that have a level of their own; what follows the last is one segment.
DEPTH = 4
#: Different segments up to which each keeps its branch, and the share of its node's urls that a
#: segment needs beyond that; so no node has more than this many branches and the wildcard.
MOST_BRANCHES, LEAST_SHARE = 50, 0.02
#: Urls that a branch needs to be compared with another, and the square of the tests' bound.
LEAST_URLS, Z_SQUARED = 5, 3.84
#: Labels that smoothing adds, half of them good; the purity under which a template is rejected.
SMOOTHING, LEAST_PURITY = 4.0, 0.4


@dataclass(frozen=True)
class UrlRule:
    """`verdict` for urls of a host and its subdomains whose path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit("." + self.host))) & F.startswith(path, F.lit(self.path))


# The contract's rules.
RULES = (
    UrlRule(ALLOW, "com", "/"),
    UrlRule(BLOCK, "example.com", "/en/"),
    UrlRule(ALLOW, "www.example.com", "/en/"),
    UrlRule(BLOCK, "net", "/es/"),
    UrlRule(BLOCK, "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _longest_fit(rules: Sequence[UrlRule], host: Column, path: Column, value) -> Column:
    """Of the longest rule that fits; of equal lengths the first."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(enumerate(rules), key=lambda r: (len(r[1].name), -r[0])):
        found = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(found)
    return found


def general_path(path: Column) -> Column:
    """The path with `#` for numbers and for names of eight hexadecimal digits or more, one a digit."""

    def general(segment: Column) -> Column:
        named = segment.rlike(r"^[0-9a-fA-F-]{8,}\z") & segment.rlike("[0-9]")
        return F.when(named, "#").otherwise(F.regexp_replace(segment, "[0-9]+", "#"))

    return F.array_join(F.transform(F.split(path, "/", -1), general), "/")


def _segments(path: Column) -> Column:
    """Up to `DEPTH` segments behind the first slash, and what follows as one more."""
    parts = F.split(path, "/", -1)
    rest = F.array_join(F.slice(parts, F.lit(DEPTH + 2), F.greatest(F.size(parts), F.lit(1))), "/")
    first = F.slice(parts, F.lit(2), F.lit(DEPTH))
    return F.when(F.size(parts) > DEPTH + 1, F.concat(first, F.array(rest))).otherwise(first)


def _alike(count: str) -> Column:
    """The share of `count` among `n` urls passes the two-sample test against the branch before."""
    a, n, b, m = (F.col(c).cast("double") for c in (count, "n", f"before.{count}", "before.n"))
    return F.pow(a * m - b * n, F.lit(2.0)) * (n + m) <= F.lit(Z_SQUARED) * (a + b) * (n + m - a - b) * n * m


_COUNTS = ("n", "good", "bad", "ended", "numbered")


def _branches(paths: DataFrame) -> DataFrame:
    """(host, template, segment, branch) of the segments of a level that have a branch of their own."""
    nodes = paths.groupBy("host", "template", "segment").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    nodes = stored(nodes, "url-nodes")
    wide = nodes.groupBy("host", "template").agg(F.count("*").alias("branches"), F.sum("n").alias("all"))
    wide = stored(wide.filter(F.col("branches") > MOST_BRANCHES), "wide-url-nodes")
    kept = nodes.join(wide, ["host", "template"], "left").filter(
        F.col("branches").isNull() | (F.col("n") >= F.lit(LEAST_SHARE) * F.col("all"))
    )
    # No more than `MOST_BRANCHES` rows stand beside each other.
    beside = Window.partitionBy("host", "template").orderBy(
        F.col("n") < LEAST_URLS, F.col("bad") / F.col("n"), F.col("good") / F.col("n"),
        F.col("ended") / F.col("n"), F.col("numbered") / F.col("n"), "segment",
    )
    before = kept.withColumn("before", F.lag(F.struct(*_COUNTS)).over(beside))
    like = (F.col("n") >= LEAST_URLS) & (F.col("before.n") >= LEAST_URLS)
    for count in _COUNTS[1:]:
        like = like & _alike(count)
    marked = before.withColumn("new", F.when(like, 0).otherwise(1)).withColumn("part", F.sum("new").over(beside))
    together = Window.partitionBy("host", "template", "part")
    names = F.sort_array(F.collect_list("segment").over(together))
    branch = F.when(F.size(names) > 1, F.concat(F.lit("("), F.array_join(names, "|"), F.lit(")"))).otherwise(F.col("segment"))
    return marked.select("host", "template", "segment", branch.alias("branch"))


def path_templates(paths: DataFrame) -> DataFrame:
    """(host, path, template, good, bad, purity) of `paths(host, path, n, good, bad)`.

    `path` is a generalised path, `n` counts urls, `good` and `bad` the labelled ones; `good` and
    `bad` of the result are those of the whole template.
    """
    rows = paths.select("*", _segments(F.col("path")).alias("segments"), F.lit("").alias("template"))
    done = None
    for level in range(DEPTH + 1):
        longer = F.size("segments") > level
        ended = rows.filter(~longer).drop("segments")
        done = ended if done is None else done.unionByName(ended)
        here, following = F.get("segments", F.lit(level)), F.get("segments", F.lit(level + 1))
        rows = rows.filter(longer).withColumn("segment", here)
        counted = rows.select(
            "host", "template", "segment", "n", "good", "bad",
            F.when(following.isNull(), F.col("n")).otherwise(0).alias("ended"),
            F.when(following.contains("#"), F.col("n")).otherwise(0).alias("numbered"),
        )
        branches = stored(_branches(counted), "url-branches")
        rows = rows.join(branches, ["host", "template", "segment"], "left")
        template = F.concat("template", F.lit("/"), F.coalesce("branch", F.lit("*")))
        rows = stored(rows.withColumn("template", template).drop("segment", "branch"), "url-templates")
        if rows.isEmpty():
            break
    done = done.unionByName(rows.drop("segments"))
    sums = done.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    purity = (F.col("good") + SMOOTHING / 2) / (F.col("good") + F.col("bad") + SMOOTHING)
    return done.select("host", "path", "template").join(sums.withColumn("purity", purity), ["host", "template"])


def judge_urls(
    df: DataFrame,
    url: str = "url",
    rules: Sequence[UrlRule] = RULES,
    good: str | None = None,
    least_purity: float = LEAST_PURITY,
) -> DataFrame:
    """Add `host`, `path`, `rule`, `verdict`, and `template` and `purity`, on which urls without a rule are judged.

    Labels are the verdicts of the rules, or else the boolean column `good`, null where there is
    none. A url without a rule is blocked if its template's purity is under `least_purity`.

    A null url, or one without `://`, has an empty host and path and no labels, so it is allowed.
    Urls that repeat count as often as they come and are judged alike; long ones are read whole.
    An empty table gives none; columns of the six names are replaced. Urls are shuffled once, to
    meet the table of paths, which is broadcast where it is small; a path that a third of all urls
    have is one row of partial sums, and its urls are dealt out by a skew join.
    """
    made = ("host", "path", "rule", "verdict", "template", "purity")
    kept = drop_columns(df, *made).columns
    source = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        *([F.col(good).cast("boolean").alias("good")] if good else [F.lit(None).cast("boolean").alias("good")]),
    )
    where = F.col("host"), F.col("path")
    judged = source.withColumns(
        {
            "rule": _longest_fit(rules, *where, lambda r: r.name),
            "ruled": _longest_fit(rules, *where, lambda r: r.verdict),
            "general": general_path(F.col("path")),
        }
    )
    label = F.coalesce(F.col("ruled") == ALLOW, F.col("good"))
    paths = judged.groupBy("host", F.col("general").alias("path")).agg(
        F.count("*").alias("n"),
        F.count_if(label).alias("good"),
        F.count_if(~label).alias("bad"),
    )
    found = path_templates(stored(paths, "url-paths")).select(
        "host", F.col("path").alias("general"), "template", "purity"
    )
    found = stored(found, "judged-paths")
    verdict = F.coalesce("ruled", F.when(F.col("purity") < least_purity, BLOCK).otherwise(ALLOW))
    return judged.join(found, ["host", "general"], "left").select(
        *[F.col("row").getField(c).alias(c) for c in kept], "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )
