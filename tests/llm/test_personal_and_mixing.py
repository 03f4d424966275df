import collections
import hashlib
import random
import re

from llm.mixing import mix_sources, source_rates
from llm.personal_data import estimate, find_personal_data, redact
from tests.llm.odd import empty, odd_documents

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def brute_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text or ""):
            digits = sum(c.isdigit() for c in m.group())
            passed = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 16 <= digits <= 19 and luhn(m.group()),
                "phone": lambda: 8 <= digits <= 15,
            }[kind]()
            if passed:
                found.append((kind, m.start(), m.end()))
    return found


def test_base_spans_of_random_and_long_texts(spark):
    rng = random.Random(3)
    parts = [*"abA1234567890..@@++-- ()_%é\U0001f600", "1.2.3.4", "a@b.co", "+1 ", "4111 1111 1111 1111", "\n"]
    parts += ["4111111111111111", "name [at] site [dot] com", "(415) 555-2671", "tel "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1200)]
    texts += ["a" * 60000, "1" * 60000, "a@b" + ".c" * 20000, "+1" + "(" * 30000, "1 " * 20000]
    rows = find_personal_data(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    for row in rows:
        assert [(s.kind, s.start, s.end) for s in row.spans if s.base] == brute_spans(row.text), row.text[:200]
        base = [(s.start, s.end) for s in row.spans if s.base]
        for s in row.spans:
            assert s.base or all(s.end <= a or b <= s.start for a, b in base)


def test_no_python_in_the_plan(spark):
    frame = find_personal_data(odd_documents(spark))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark):
    rows = find_personal_data(odd_documents(spark)).collect()
    assert len(rows) == 13
    for row in rows:
        assert [(s.kind, s.start, s.end) for s in row.spans if s.base] == brute_spans(row.text)
    assert find_personal_data(empty(spark)).count() == 0


def test_redaction(spark):
    texts = ["x a@b.co y +1 (415) 555-2671 z", "", "nothing", "a@b.co", "\U0001f600 1.2.3.4."]
    rows = redact(find_personal_data(spark.createDataFrame([(t,) for t in texts], "text string"))).collect()
    want = ["x <EMAIL> y <PHONE> z", "", "nothing", "<EMAIL>", "\U0001f600 <IP>."]
    assert sorted(r.text for r in rows) == sorted(want)


def test_estimation_trusts_labelers_that_agree():
    patterns = {("phone", "+++++0"): 900, ("phone", "------"): 900, ("phone", "++-+++"): 50, ("phone", "--+--0"): 50}
    right = estimate(patterns)
    assert right["phone", "++-+++"] > 0.9 and right["phone", "--+--0"] < 0.1


def drawn(rate, name):
    """Copies of a document by the definition of the Poisson quantile."""
    value = int(hashlib.md5(f"mixture-1:{name}".encode()).hexdigest()[:13], 16) / 2**52
    import math

    total, k, term = 0.0, 0, math.exp(-rate)
    while True:
        total += term
        if total > value:
            return k
        k += 1
        term *= rate / k


def test_mixture_is_the_drawn_one(spark):
    docs = odd_documents(spark)
    rates = {r.source: r.rate for r in source_rates(docs).collect()}
    rows = mix_sources(docs, size=30.0).collect()
    found = collections.Counter((r.doc_id, r.source) for r in rows)
    want = collections.Counter()
    for doc in docs.collect():
        name = "" if doc.doc_id is None else str(doc.doc_id)
        if rates[doc.source]:
            want[doc.doc_id, doc.source] += drawn(30 * rates[doc.source], name)
    assert found == collections.Counter({k: n for k, n in want.items() if n})
    keys = [r.shuffle_key for r in rows]
    assert keys == sorted(keys)


def test_weights_are_met(spark):
    rows = [(i, "x" * 10, "big" if i % 10 else "small") for i in range(6000)] + [(9999, None, "void")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = collections.Counter(r.source for r in mix_sources(docs, {"big": 1, "small": 1}).select("source").collect())
    assert abs(mixed["big"] - 3000) < 250 and abs(mixed["small"] - 3000) < 250 and "void" not in mixed
    assert mix_sources(docs.limit(0)).count() == 0
