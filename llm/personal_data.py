"""Personal data by weak supervision, in built-in expressions only.

Patterns give candidate spans: those of the four base kinds, which always count, and looser ones.
Six labelers (shape, validity, gazetteer, context, surroundings, length) vote for, against or not
at all. How often each pattern of votes occurs is counted over all documents; that table has no
more rows than there are patterns of votes. Expectation-maximisation on it estimates how reliable
each labeler is and how likely each pattern is right; a logistic span classifier is trained on
these likelihoods and compiled into an expression, which decides on the looser candidates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import drop_columns, in_one_row, shielded

# The base kinds in the order in which spans are listed, and their patterns. A run
# is entered only at its start, or where the match before ended, and quantifiers do not give back
# what the next part cannot use; so the matches are those of the plain patterns
#   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+      [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   [0-9]([\x20-]?[0-9])+                                  \+[0-9][\x20().0-9-]+[0-9]
# and a long run without a match takes linear time.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns: addresses spelled out, numbers without a country code.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}

# Gazetteers and context words.
DOMAINS = "com org net edu gov info biz io de fr es uk eu ch at it nl us ca co me dev app".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
CONTEXT = {
    "email": "mail contact write correo courriel kontakt adresse address".split(),
    "ip": "ip host server address adresse client login".split(),
    "card": "card visa mastercard amex credit karte carte tarjeta payment".split(),
    "phone": "phone tel call fax mobile telefon telefono movil cell".split(),
}
AGAINST = "version licen isbn order serial section chapter token hash build".split()

LABELERS = ("shape", "validity", "gazetteer", "context", "surroundings", "length")
#: How often a labeler is right, to begin with; expectation-maximisation goes on from there.
TRUST = {"shape": 0.8, "validity": 0.9, "gazetteer": 0.7, "context": 0.85, "surroundings": 0.65, "length": 0.65}
ROUNDS = 30
_SPAN = "array<struct<start:int,end:int,value:string>>"


def _found(text: Column, pattern: str, needs: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(needs, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)


def _located(text: Column, found: Column, pattern: str) -> Column:
    """Spans in code points. The text between matches says how far apart they stand."""
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.greatest(F.size(found), F.lit(1)))
    none = F.array().cast(_SPAN)

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["0"])
        end = start + F.char_length(x["1"])
        span = F.struct(start.alias("start"), end.alias("end"), x["1"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["all"], F.array(span)).alias("all"))

    pairs = F.arrays_zip(between.alias("0"), found.alias("1"))
    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("all")), add, lambda acc: acc["all"])
    return F.when(F.size(found) > 0, spans).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """The check sum of card numbers, from the last digit on."""
    digits = F.reverse(F.split(_digits(value), ""))
    weighed = F.transform(
        F.filter(digits, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5)),
    )
    return F.aggregate(weighed, F.lit(0).cast("bigint"), lambda acc, d: acc + d) % 10 == 0


def _octets(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def is_base(kind: str, value: Column) -> Column:
    """What a match of the kind's pattern must pass besides."""
    count = F.length(_digits(value))
    if kind == "ip":
        return _octets(value)
    if kind == "card":
        return count.between(16, 19) & _luhn(value)
    return count.between(8, 15) if kind == "phone" else F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    against = ~yes if no is None else no
    return F.when(yes, "+").when(against, "-").otherwise("0")


def _votes(kind: str, text: Column, span: Column, base: Column) -> Column:
    """One sign per labeler."""
    value, count = span["value"], F.length(_digits(span["value"]))
    before = F.lower(F.substring(text, F.greatest(span["start"] - 39, F.lit(1)), F.least(span["start"], F.lit(40))))
    beside = F.concat(
        F.when(span["start"] > 0, F.substring(text, span["start"], F.lit(1))).otherwise(" "),
        F.substring(text, span["end"] + 1, F.lit(1)),
    )
    validity = {
        "email": value.rlike(r"[.\])\x20][A-Za-z]{2,24}$"),
        "ip": _octets(value) & ~value.rlike(r"^0"),
        "card": _luhn(value),
        "phone": count.between(8, 15),
    }[kind]
    gazetteer = {
        "email": _vote(F.lower(F.regexp_extract(value, "[A-Za-z]+$", 0)).isin(DOMAINS)),
        "ip": _vote(value.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\."), F.lit(False)),
        "card": _vote(_digits(value).rlike(ISSUERS)),
        "phone": _vote(value.rlike(r"^\+|^\("), F.lit(False)),
    }[kind]
    length = {
        "email": F.length(value).between(6, 64),
        "ip": F.length(value).between(7, 15),
        "card": count.between(15, 16),
        "phone": count.between(10, 13),
    }[kind]
    wanted = before.rlike("|".join(CONTEXT[kind]))
    return F.concat(
        _vote(base),
        _vote(validity),
        gazetteer,
        _vote(wanted, before.rlike("|".join(AGAINST))),
        _vote(~beside.rlike(r"[A-Za-z0-9_=\"]")),
        _vote(length),
    )


def candidates(df: DataFrame, text: str) -> DataFrame:
    """Add `__spans`: kind, start, end, base, pattern (of votes) of every candidate, base ones first."""
    rows = in_one_row(df, __text=F.coalesce(F.col(text), F.lit("")))
    whole = F.col("__text")
    needs = {"email": whole.contains("@"), "ip": whole.contains("."), "phone": whole.contains("+")}
    digit = whole.rlike("[0-9]")
    loose_needs = {"email": whole.rlike(r"[\[(]at[\])]"), "phone": digit}
    found = {f"__{k}": _found(whole, p, needs.get(k, F.lit(True)) & (digit if k != "email" else F.lit(True))) for k, p in PATTERNS.items()}
    found |= {f"__{k}_loose": _found(whole, p, loose_needs[k]) for k, p in LOOSE.items()}
    rows = in_one_row(rows, **found)
    patterns = {f"__{k}": p for k, p in PATTERNS.items()} | {f"__{k}_loose": p for k, p in LOOSE.items()}
    located = {name: _located(whole, F.col(name), pattern) for name, pattern in patterns.items()}
    rows = in_one_row(rows, **{f"{name}_at": spans for name, spans in located.items()}).drop(*found)

    def judged(kind: str, name: str, loose: bool) -> Column:
        def one(span: Column) -> Column:
            base = F.lit(False) if loose else is_base(kind, span["value"])
            return F.struct(
                F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                base.alias("base"), _votes(kind, whole, span, base).alias("pattern"),
            )

        # Numbers that cannot be the kind at all are no candidates.
        spans = F.col(name)
        if not loose and kind in ("card", "phone", "ip"):
            least = {"card": 13, "phone": 8, "ip": 4}[kind]
            most = {"card": 19, "phone": 15, "ip": 12}[kind]
            spans = F.filter(spans, lambda s: F.length(_digits(s["value"])).between(least, most) | is_base(kind, s["value"]))
        return F.transform(spans, one)

    every = [judged(k, f"__{k}_at", False) for k in KINDS] + [judged(k, f"__{k}_loose_at", True) for k in LOOSE]
    rows = in_one_row(rows, __all=F.concat(*every)).drop(*[f"{n}_at" for n in found])
    base = F.filter("__all", lambda s: s["base"])
    clear = F.filter(
        "__all",
        lambda s: ~s["base"]
        & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return in_one_row(rows, __spans=F.concat(base, clear)).drop("__all")


def estimate(patterns: dict[tuple[str, str], int]) -> dict[tuple[str, str], float]:
    """How likely each (kind, pattern) is right, by expectation-maximisation over the labelers.

    A labeler has a rate of votes for, against and none in either class, smoothed; the work is
    that of the table of patterns, whatever the number of documents.
    """
    right: dict[tuple[str, str], float] = {}
    for kind in KINDS:
        mine = {p: n for (k, p), n in patterns.items() if k == kind}
        rates = [{c: {"+": t if c else 1 - t, "-": 1 - t if c else t, "0": 0.5} for c in (0, 1)} for t in TRUST.values()]
        prior, share = 0.5, {}
        for _ in range(ROUNDS if mine else 0):
            for pattern in mine:
                yes = math.log(prior) + sum(math.log(r[1][v]) for r, v in zip(rates, pattern, strict=True))
                no = math.log(1 - prior) + sum(math.log(r[0][v]) for r, v in zip(rates, pattern, strict=True))
                share[pattern] = 1 / (1 + math.exp(max(-60.0, min(60.0, no - yes))))
            mass = {c: sum(n * (share[p] if c else 1 - share[p]) for p, n in mine.items()) for c in (0, 1)}
            prior = (mass[1] + 5) / (mass[0] + mass[1] + 10)
            for at, trust in enumerate(TRUST.values()):
                for c in (0, 1):
                    begin = {"+": trust if c else 1 - trust, "-": 1 - trust if c else trust, "0": 0.5}
                    # The first guess counts as twenty votes, so that the classes keep their meaning.
                    for sign in "+-0":
                        n = sum(k * (share[p] if c else 1 - share[p]) for p, k in mine.items() if p[at] == sign)
                        rates[at][c][sign] = (n + 20 * begin[sign]) / (mass[c] + 30)
        right |= {(kind, p): s for p, s in share.items()}
    return right


def train_classifier(
    patterns: dict[tuple[str, str], int], right: dict[tuple[str, str], float], steps: int = 400
) -> dict[str, list[float]]:
    """Per kind a bias and two weights per labeler (for, against), by logistic regression on the
    likelihoods, each pattern weighted by its share of the kind's candidates."""
    models = {}
    for kind in KINDS:
        mine = [(p, n, right[kind, p]) for (k, p), n in patterns.items() if k == kind]
        total, weights = sum(n for _, n, _ in mine) or 1, [0.0] * (1 + 2 * len(LABELERS))
        rows = [([1.0] + [float(v == s) for v in p for s in "+-"], n / total, y) for p, n, y in mine]
        for _ in range(steps):
            slope = [-1e-3 * w for w in weights]
            for x, share, y in rows:
                miss = y - 1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, x, strict=True))))
                slope = [s + share * miss * v for s, v in zip(slope, x, strict=True)]
            weights = [w + 2.0 * s for w, s in zip(weights, slope, strict=True)]
        models[kind] = weights
    return models


def _chance(span: Column, models: dict[str, list[float]]) -> Column:
    chance = F.lit(0.0)
    for kind, weights in models.items():
        total = F.lit(weights[0])
        for at in range(len(LABELERS)):
            sign = F.substring(span["pattern"], at + 1, 1)
            total = total + F.when(sign == "+", weights[1 + 2 * at]).when(sign == "-", weights[2 + 2 * at]).otherwise(0.0)
        chance = F.when(span["kind"] == kind, 1 / (1 + F.exp(-total))).otherwise(chance)
    return chance


@shielded
def find_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """Add `spans`: kind, start, end (code points, end exclusive), base, by kind as listed, then start.

    Base spans are the matches of the four base patterns that pass their checks, leftmost and
    without overlap within a kind. Further spans are those candidates that overlap no base span
    and that the trained classifier takes for right. Null and empty texts have none; long texts
    are searched whole. Repeated rows have the same spans, an empty table stays empty, and a
    column named `spans` is replaced. Two passes over the texts, no shuffle of them.
    """
    df = drop_columns(df, "spans")
    votes = candidates(df.select(F.col(text).alias("__source")), "__source").select(F.explode("__spans").alias("s"))
    counted = votes.groupBy("s.kind", "s.pattern").count().collect()  # one row a pattern of votes
    patterns = {(row["kind"], row["pattern"]): row["count"] for row in counted}
    models = train_classifier(patterns, estimate(patterns))
    taken = lambda s: s["base"] | (_chance(s, models) >= 0.5)
    number = lambda s: sum((F.when(s["kind"] == k, i).otherwise(0) for i, k in enumerate(KINDS)), F.lit(0))
    chosen = F.transform(
        F.filter("__spans", taken),
        lambda s: F.struct(number(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base")),
    )
    result = F.transform(
        F.sort_array(chosen),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")),
    )
    return candidates(df, text).withColumn("spans", result).drop("__spans", "__text")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Put `<EMAIL>`, `<IP>`, `<CARD>` or `<PHONE>` where `spans` says; stretches that overlap become one."""
    whole = F.col(text)

    def cut(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        between = F.substring(whole, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        added = F.when(fresh, F.concat(between, mark)).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], added).alias("out"))

    places = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    clean = F.aggregate(
        places,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        cut,
        lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"] + 1, F.lit(2**31 - 1))),
    )
    return df.withColumn(text, F.when(F.size("spans") > 0, clean).otherwise(whole))
