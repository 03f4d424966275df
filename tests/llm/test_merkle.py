import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from llm.merkle import lower_case_leaf, numbered, prove, verified
from llm.queries import MANIFEST_FIELDS, op12_merkle_manifest
from tests.llm.odd import LOWER, empty, odd_documents


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(nodes, fanout=8):
    """The levels of a tree, each a list of digests; the last has one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def brute_walk(levels, i, start, fanout=8):
    siblings, cur = "", start
    for level in levels[:-1]:
        run = level[i // fanout * fanout : i // fanout * fanout + fanout]
        left, right = "".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])
        siblings, cur, i = siblings + left + right, sha(left + cur + right), i // fanout
    return siblings, cur


def brute_manifest(rows, fanout=8):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row.lang].append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, brute_leaf(r, r.text)))
        trees[lang] = brute_tree([brute_leaf(r, r.text) for r in groups[lang]], fanout)
    top = brute_tree([trees[lang][-1][0] for lang in langs], fanout)
    out = []
    for at, lang in enumerate(langs):
        for i, row in enumerate(groups[lang]):
            chosen = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0
            changed = row.text.translate(LOWER) if chosen and row.text is not None else row.text
            own, cur = brute_walk(trees[lang], i, brute_leaf(row, changed), fanout)
            above, cur = brute_walk(top, at, cur, fanout)
            root = top[-1][0]
            out.append((row.doc_id, trees[lang][0][i], trees[lang][-1][0], root, sha(own + above), cur, cur == root))
    return out


def query_rows(df, fanout=8):
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = F.when(chosen, lower_case_leaf(MANIFEST_FIELDS, "text"))
    checked = verified(prove(df, MANIFEST_FIELDS, "doc_id", "lang", {"tampered": tampered}, fanout), F.coalesce("tampered", "leaf"), fanout)
    found = checked.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256), "folded_root", "verified")
    return [tuple(r) for r in found.collect()]


def same(a, b):
    return collections.Counter(a) == collections.Counter(b)


def test_query_equals_the_plain_version(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    found = [tuple(r) for r in op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()]
    assert same(found, brute_manifest(rows))
    assert {r[-1] for r in found} == {True, False}


def test_odd_rows(spark):
    df = odd_documents(spark)
    assert same(query_rows(df), brute_manifest(df.collect()))
    assert query_rows(empty(spark)) == []


@pytest.mark.parametrize("n, langs, fanout", [(1, 1, 8), (17, 1, 2), (40, 20, 2), (30, 12, 3)])
def test_shapes(spark, n, langs, fanout):
    rows = [(i, f"Text {i}", "s", None if i % langs == 0 else f"l{i % langs}", i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    assert same(query_rows(df, fanout), brute_manifest(df.collect(), fanout))


def test_numbers_over_many_tasks(spark):
    df = spark.range(5000).select((F.col("id") % 3 * 0).alias("g"), F.md5(F.col("id").cast("string")).alias("k")).repartition(7)
    found = numbered(df, "g", ["k"]).orderBy("k").select("index").collect()
    assert [r[0] for r in found] == list(range(5000))
