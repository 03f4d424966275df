import collections

import corpus_pipeline
from llm.decontaminate import find_windows, plan_block, windows_of, words_of
from tests.llm.odd import odd_documents
from tests.llm.test_duplicates import brute_components, brute_fingerprint
from tests.llm.test_personal_and_mixing import brute_spans, drawn
from tests.llm.test_rules_and_tokens import brute_counts

SF = "/root/testdata/sf0.001"


def brute_pipeline(spark):
    """The stages one after another in plain Python; the rules' verdict is taken from the operator."""
    from llm.quality import apply_rules

    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    verdict = {r.doc_id: r for r in apply_rules(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    for doc_id, row in docs.items():
        n, _, _, _, repeated = brute_counts(row.text)
        assert verdict[doc_id].base_failed == (n < 10 or 100 * repeated > 20 * n)
    left = sorted(i for i in docs if verdict[i].kept)
    groups = collections.defaultdict(list)
    for root, i in zip(brute_components([brute_fingerprint(docs[i].text) for i in left]), left, strict=True):
        groups[root].append(i)
    left = sorted(min(g) for g in groups.values())
    pairs = [(str(r.item_id), w) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for w in windows_of(words_of(r.text.encode()), 10)]
    items, prefixes = plan_block(pairs, {})
    left = [i for i in left if not find_windows(words_of(docs[i].text.encode()), items, prefixes)[0]]
    texts = {}
    for i in left:
        text, out, at = docs[i].text, "", 0
        for kind, start, end in sorted(brute_spans(text), key=lambda s: (s[1], s[2], s[0])):
            if start >= at:
                out += text[at:start] + f"<{kind.upper()}>"
            at = max(at, end)
        texts[i] = out + text[at:]
    size = collections.Counter()
    for i in left:
        size[docs[i].source] += len(texts[i])
    total, power = sum(size.values()), sum(n**0.7 for n in size.values())
    copies = {i: drawn(size[docs[i].source] ** 0.7 / power * total / size[docs[i].source], i) for i in left}
    return {(i, texts[i]): n for i, n in copies.items() if n}


def test_pipeline_equals_the_plain_version(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert collections.Counter((r.doc_id, r.text) for r in rows) == brute_pipeline(spark)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs.limit(0), SF)
        assert found.count() == 0, name
        assert found.columns[: len(docs.columns)] == docs.columns


def test_stages_take_odd_rows(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with clashing names."""
    docs = odd_documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        assert found.columns[:5] == list(corpus_pipeline.DOCUMENT), name
        kept[name] = sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)
    copies = [(1, texts[1])] * 2
    assert [x for x in kept["quality_rules"] if x[0] == 1] == copies and not any(i in (2, 3, 4, 6, 7) for i, _ in kept["quality_rules"])
    # Of the texts without words one stays, of the three that are alike the smallest id.
    ids = [i for i, _ in kept["near_duplicates"]]
    assert sum(i in (2, 3, 4) for i in ids) == 1 and 8 not in ids and ids.count(1) == 1
    assert len(kept["decontamination"]) == 13 and len(kept["personal_data"]) == 13
    assert any(t and "<EMAIL>" in t for i, t in kept["personal_data"] if i is None)
    assert set(kept["mixing"]) <= {(r.doc_id, r.text) for r in docs.collect()}
