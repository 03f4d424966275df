import collections
import random

import public_tokenizers
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from llm.quality import COUNTS, apply_rules
from llm.tokens import Counter, count_tokens, read_rules
from tests.llm.odd import empty, odd_documents, words

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_counts(text):
    found = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_verdicts_on_odd_rows(spark):
    rows = apply_rules(odd_documents(spark)).collect()
    assert len(rows) == 13
    for row in rows:
        want = brute_counts(row.text)
        assert tuple(row[c] for c in COUNTS[:5]) == want
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (row.base_failed and row.kept)
    by = {row.doc_id: row for row in rows}
    assert by[8].kept is True and by[8].failed_rules == []
    assert "symbols" in by[10].failed_rules and by[2].failed_rules[0] == "words"
    assert [c for c in rows[0].__fields__ if c.lower() == "kept"] == ["kept"]


def test_quality_of_nothing(spark):
    assert apply_rules(empty(spark)).count() == 0


def test_quality_repeats_in_random_texts(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    rows = apply_rules(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert all(row.n_repeat_words == brute_counts(row.text)[4] for row in rows)


def test_token_counts_are_the_librarys(spark):
    library = Tokenizer.from_file(PATH)
    rows = count_tokens(odd_documents(spark), PATH).collect()
    for row in rows:
        text = row.text or ""
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert row.n_bytes == len(text.encode()) and row.over_limit == (row.n_tokens > 2048)
    assert count_tokens(empty(spark), PATH).count() == 0


def test_token_counts_of_random_strings():
    library, counter, rng = Tokenizer.from_file(PATH), Counter(read_rules(PATH), memory=50), random.Random(5)
    parts = ["a", "B", "th", "Er", " ", "\n", "'s", "'LL", "1", "23", "é", "é", "Σ", "ß", "İ", "!"]
    parts += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "...", "\x1c", "\x85", "　", "日"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert counter.text(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    long = "ab" * 20000
    assert counter.text(long) == len(library.encode(long, add_special_tokens=False).ids)


def test_columns_with_internal_names_come_back(spark):
    """Every operator leaves input columns alone that are named like its own working columns."""
    from llm.mixing import mix_sources
    from llm.personal_data import find_personal_data, redact
    from llm.quality import apply_rules
    from llm.decontaminate import find_contamination
    from llm.simhash import keep_one_of_each_group
    from llm.substrings import remove_repeated

    rows = [(i, f"One text of its own, number {i}, for who{i}@where.com to read and keep.", "s", i) for i in range(4)]
    names = ["__words", "__text", "__email", "__id", "__n", "__u", "__hit0", "__row", "__key", "__source", "n_words__", "__spans"]
    df = spark.createDataFrame(rows, "doc_id bigint, __text string, source string, v bigint")
    df = df.withColumns({name: F.col("v") * 10 for name in names if name != "__text"}).drop("v")
    items = spark.createDataFrame([(1, "number")], "item_id bigint, text string")
    for found in (
        apply_rules(df, text="__text"), remove_repeated(df, text="__text"), find_contamination(df, items, text="__text"),
        find_personal_data(df, text="__text"), mix_sources(df, text="__text"), keep_one_of_each_group(df, text="__text"),
    ):
        assert {r.doc_id: r["__n"] for r in found.collect()} in ({i: 10 * i for i in range(4)}, {}) or "copy" in found.columns
        assert set(names) <= set(found.columns)
        assert all(r["__hit0"] == 10 * r.doc_id and r["n_words__"] == 10 * r.doc_id for r in found.collect())
