"""Quality rules: a threshold table compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import SPACES, drop_columns, in_one_row, shielded

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by are this at from or an not "
    "der die und den von zu das sich mit auf für ist im nicht dem ein eine als "
    "de la le et les des du en un une que est pour par dans avec qui pas sur au "
    "el y los las se del con no una su para es al lo"
).split()

#: As they are, capitalised, and in capitals: looking a word up is cheaper than changing its case.
CASED_STOP_WORDS = sorted({f(w) for w in STOP_WORDS for f in (str.lower, str.capitalize, str.upper)})

#: Counts that a text has; every rule is a ratio of two of them, or one of them.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_stop_words", "n_ellipsis_lines",
)


@dataclass(frozen=True)
class Rule:
    """`least <= numerator / denominator <= most`; a missing denominator counts as 1.

    A rule with `from_words` holds of itself for texts with fewer words, whose ratios are chance.
    """

    name: str
    numerator: str
    denominator: str | None = None
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The contract's base: at least ten words, and at most a fifth of them in repeated windows.
BASE = (
    Rule("words", "n_words", least=10),
    Rule("repeated_words", "n_repeat_words", "n_words", most=0.2),
)

#: The method's own thresholds. Junk of the synthetic corpora has a symbol for every second word
#: or more, clean prose has none; the others are wide enough for clean prose in four languages.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", least=2.0, most=15.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02, from_words=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=0.3),
)


def _sorted_windows(windows: Column) -> Column:
    """(hash, position) in order of hash; empty if no hash occurs twice, as in nearly all texts."""
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    twice = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(twice, F.sort_array(pairs)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _repeat_words(at: Column) -> Column:
    """Words that lie in a window of five whose hash occurs twice or more in the text.

    Windows are compared by 64-bit hash. In order of hash equal windows stand side by side, so a
    window is repeated if a neighbour has its hash; the covered words are then a sum over the
    repeated windows in order of position.
    """
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    rest = F.greatest(F.size(at) - 1, F.lit(0))
    beside = F.arrays_zip(
        at.alias("here"),
        F.concat(none, F.slice(at, F.lit(1), rest)).alias("before"),
        F.concat(F.slice(at, F.lit(2), rest), none).alias("after"),
    )
    again = F.filter(
        beside,
        lambda x: x["here"]["h"].eqNullSafe(x["before"]["h"]) | x["here"]["h"].eqNullSafe(x["after"]["h"]),
    )
    covered = F.aggregate(
        F.sort_array(F.transform(again, lambda x: x["here"]["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct(
            (acc["n"] + i + 5 - F.greatest(i, acc["end"])).alias("n"), (i + 5).alias("end")
        ),
        lambda acc: acc["n"],
    )
    return F.when(F.size(at) > 0, covered).otherwise(0)


def _ratio(rule: Rule) -> Column:
    value = F.col(rule.numerator).cast("double")
    return value / F.greatest(F.col(rule.denominator), F.lit(1)) if rule.denominator else value


def holds(rule: Rule) -> Column:
    """The rule as an expression over the count columns."""
    value, checks = _ratio(rule), []
    if rule.least is not None:
        checks.append(value >= rule.least)
    if rule.most is not None:
        # Multiplied out, so that a ratio that equals the threshold is not lost by rounding.
        bound = F.greatest(F.col(rule.denominator), F.lit(1)) if rule.denominator else F.lit(1)
        checks.append(F.lit(100) * F.col(rule.numerator) <= F.lit(round(100 * rule.most)) * bound)
    passed = checks[0] if len(checks) == 1 else checks[0] & checks[1]
    return passed | (F.col("n_words") < rule.from_words) if rule.from_words else passed


def _all_hold(rules: tuple[Rule, ...]) -> Column:
    passed = F.lit(True)
    for rule in rules:
        passed = passed & holds(rule)
    return passed


@shielded
def quality_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns of `COUNTS` (long). A null text counts as an empty one.

    Words are runs of characters other than space and x09 to x0D; lines are split at \\n and
    count only with a word in them. Input columns named like a count are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))
    size = F.size("__words")
    kept = drop_columns(df, *COUNTS).columns
    rows = in_one_row(
        df,
        __words=F.array_remove(F.split(whole, f"[{SPACES}]+"), ""),
        n_symbols__=F.regexp_count(whole, F.lit(r"[#*$%&|<>]")),
        n_lines__=F.size(lines),
        n_dup_lines__=F.size(lines) - F.size(F.array_distinct(lines)),
        n_ellipsis_lines__=F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|\u2026)$"))),
    )
    # The words go no further than this step: copying them along costs more than the counts.
    rows = in_one_row(
        rows,
        n_words__=size,
        word_chars__=F.char_length(F.array_join("__words", "")),
        n_stop_words__=F.size(F.filter("__words", lambda w: w.isin(CASED_STOP_WORDS))),
        __windows=F.transform(
            F.slice("__words", F.lit(1), F.greatest(size - 4, F.lit(0))),
            lambda w, i: F.xxhash64(w, *[F.get("__words", i + k) for k in range(1, 5)]),
        ),
    ).drop("__words")
    rows = in_one_row(rows, __sorted=_sorted_windows(F.col("__windows"))).drop("__windows")
    rows = in_one_row(rows, n_repeat_words__=_repeat_words(F.col("__sorted"))).drop("__sorted")
    return rows.select(
        *[F.col(f"`{c}`") for c in kept], *[F.col(f"{c}__").cast("long").alias(c) for c in COUNTS]
    )


@shielded
def apply_rules(
    df: DataFrame, text: str = "text", base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Add the counts, `base_failed`, `kept`, and `failed_rules`, the names of the rules broken.

    Null, empty and blank texts have no words and fail the base. Rows that repeat are judged
    alike, each for itself; an empty table gives an empty table. Very long texts are counted whole, one
    at a time. Columns of the new names are replaced, others come back as they were. Nothing is shuffled.
    """
    counted = drop_columns(quality_counts(df, text), "base_failed", "kept", "failed_rules")
    broken = F.array_compact(
        F.array(*[F.when(~holds(rule), F.lit(rule.name)) for rule in (*base, *rules)])
    )
    return counted.withColumns(
        {
            "base_failed": ~_all_hold(base),
            "kept": _all_hold((*base, *rules)),
            "failed_rules": broken,
        }
    )
