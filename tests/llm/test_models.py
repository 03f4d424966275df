import collections
import itertools
import math
import pickle
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash

from llm.html_text import Labeller, Pages, blocks_of, extract_main_text, trained_labeller
from llm.language_model import Restaurants, Seats, Totals, _add_slice, _block, _merge, _pack, _release, _restaurants, _split, _squeeze, _unpack
from llm.language_model import score_texts, sizes
from llm.toxicity import maximal_segments, score_toxicity
from tests.llm.odd import empty, lower_words, odd_documents

SF = "/root/testdata/sf0.001"


def test_language_model_base_score_and_gain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in score_texts(docs).collect()}
    counts, tokens = collections.Counter(), {}
    for doc in docs.collect():
        tokens[doc.doc_id] = [*lower_words(doc.text), None]
        if zlib.crc32(str(doc.doc_id).encode()) % 10:
            counts.update(tokens[doc.doc_id])
    total, kinds = sum(counts.values()), len(counts)
    assert rows.keys() == tokens.keys()
    sums = collections.Counter()
    for doc_id, found in tokens.items():
        row, held = rows[doc_id], zlib.crc32(str(doc_id).encode()) % 10 == 0
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in found)
        assert abs(row.base_score - base) < 1e-6 * abs(base)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held, len(found), total)
        assert row.n_known == sum(counts[t] > 0 for t in found)
        if held:
            sums["base"] += row.base_score
            sums["score"] += row.score
    assert sums["score"] > sums["base"]


def test_language_model_on_odd_rows(spark):
    rows = score_texts(odd_documents(spark)).collect()
    assert len(rows) == 13 and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert next(r for r in rows if r.doc_id == 3).n_tokens == 1
    again = score_texts(odd_documents(spark)).collect()
    assert sorted((r.doc_id or -1, r.score) for r in rows) == sorted((r.doc_id or -1, r.score) for r in again)
    assert score_texts(empty(spark)).count() == 0


def test_probabilities_of_a_restaurant_sum_to_one():
    word = np.array([0, 0, 1, 2, 2, 3])
    place = np.array([0, 1, 0, 0, 1, 1])
    count = np.array([5, 1, 2, 40, 3, 1])
    here = Restaurants(word, place, count, 4, 0)
    first = Totals.first(here.sums(2))
    for _ in here.phase(first, 3):
        pass
    later = first.later(here.sums(2))
    # Every word in restaurant 0, seen there or not, and the unknown word.
    full = Restaurants(np.arange(4), np.zeros(4, int), np.array([5, 2, 40, 0]), 4, 0)
    root = here.root(later)
    strength = 1 + later.context_discount * later.tables[0]
    tables = np.array([here.tables[(word == w) & (place == 0)].sum() for w in range(4)])
    over = full.count - later.context_discount * tables + strength * root
    unknown = strength * (10 + later.root_discount * here.root_tables.sum()) / 5 / (10 + here.root_customers().sum())
    later_sum = (over.sum() + unknown) / (1 + later.customers[0])
    assert abs(later_sum - 1) < 0.15  # root totals lag one phase behind


def test_seats_stay_consistent():
    rng = np.random.default_rng(3)
    count, weight = rng.integers(1, 90, 200), rng.random(200) * 3
    seats = Seats(count, weight, 0.5)
    for turn in range(30):
        seats.sweep(weight, 0.5, rng)
        if turn % 3 == 2:
            count = np.maximum(1, count + rng.integers(-9, 10, 200))
            seats.resize(count, weight, 0.5, rng)
        assert (np.bincount(seats.owner, seats.size, 200) == count).all()
        assert (seats.size > 0).all() and (np.diff(seats.owner) >= 0).all()


def test_sweeps_sample_the_posterior_of_seatings():
    """Of three and four customers all seatings can be listed, with their weights."""
    rng, discount, weight = np.random.default_rng(4), 0.4, 0.7
    for count in (3, 4):
        chance = collections.Counter()
        for seating in itertools.product(range(count), repeat=count):
            if all(seating[i] <= max(seating[:i], default=-1) + 1 for i in range(count)):  # tables in order of their first customer
                sizes = collections.Counter(seating).values()
                chance[len(sizes)] += math.prod(weight * math.prod(k - discount for k in range(1, n)) for n in sizes)
        dishes = 4000
        seats = Seats(np.full(dishes, count), np.full(dishes, weight), discount)
        found = collections.Counter()
        for turn in range(30):
            seats.sweep(np.full(dishes, weight), discount, rng)
            if turn >= 10:
                found.update(seats.tables().tolist())
        for tables, value in chance.items():
            assert abs(found[tables] / found.total() - value / chance.total()) < 0.01


def test_large_dishes_move_in_parts():
    """A dish of any size has as many tables as customers seated one by one have, about."""
    rng, discount, weight = np.random.default_rng(5), 0.5, 2.0
    seats = Seats(np.full(60, 600), np.full(60, weight), discount)
    for _ in range(40):
        seats.sweep(np.full(60, weight), discount, rng)
    one = Seats(np.full(60, 600), np.full(60, weight), discount)
    for _ in range(4000):
        one._leave(np.ones(60, int), rng)
        one._join(np.full(60, weight), discount, rng)
    assert abs(seats.tables().mean() / one.tables().mean() - 1) < 0.2


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for number in ("4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", number)
            found.append({r.doc_id: r.score for r in score_texts(docs.repartition(int(number))).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0].keys() == found[1].keys()
    assert all(abs(v - found[1][k]) < 1e-6 * abs(v) for k, v in found[0].items())


def test_contexts_are_kept_apart(spark):
    """Each of 6,000 contexts has one follower, seen four times: the model must be nearly sure of it."""
    docs = spark.range(12_000).selectExpr("id AS doc_id", "concat('a', id % 3000, ' b', id % 3000) AS text")
    rows = [r for r in score_texts(docs).collect() if not r.held_out]
    first = math.log10(4 / 12_000)
    assert all(r.n_tokens == 3 for r in rows)
    assert sum(r.score > first - 0.6 for r in rows) > 0.9 * len(rows)


def _bigrams(texts):
    found = collections.Counter()
    for text in texts:
        words = [None, *lower_words(text), None]
        found.update(zip(words, words[1:]))
    return found


def test_a_bucket_holds_exact_counts_of_contexts_and_words():
    """Entries over all buckets and blocks are the pairs of words in a row, held-out rows with a count of none."""
    rng = random.Random(3)
    texts = [" ".join(f"W{rng.randrange(60)}" for _ in range(rng.randrange(40))) for _ in range(30)] + [None, ""]
    held = np.array([k % 5 == 0 for k in range(len(texts))])
    rows = collections.defaultdict(list)
    for block, half in enumerate((slice(0, 16), slice(16, 32))):
        data = [t.encode() if t is not None else None for t in texts[half]]
        for bucket, number, state, sent in _block(block, pa.array(range(len(data))), data, held[half], 3):
            if bucket >= 0:
                rows[bucket].append((number, state))
    name = {xxhash.xxh64_intdigest(w.encode()): w for w in (f"w{k}" for k in range(60))} | {xxhash.xxh64_intdigest(b""): None}
    above = {key >> 16: word for key, word in name.items()}
    counts = {}
    for bucket, blocks in rows.items():
        state, numbers = _merge(blocks)
        here, contexts = _restaurants(_squeeze(pickle.dumps(state)), bucket)
        names = np.unique(np.concatenate([_unpack(_release(s))[0] for _, s in blocks]))
        for word, place, count in zip(here.word, here.restaurant, here.count):
            counts[above[int(contexts[place])], name[int(names[word])]] = int(count)
        assert all((np.diff(n) >= 0).all() for n in numbers) and len(numbers) == len(blocks)
    trained = _bigrams(t for t, h in zip(texts, held) if not h)
    assert counts == {pair: trained[pair] for pair in _bigrams(texts)}


def test_a_slice_adds_up_the_contexts_of_all_buckets():
    mine = [([5, 9, 1 << 47], [2, 1, 7], [1, 1, 3]), ([5, 1 << 47], [4, 1], [2, 1]), ([6], [8], [5])]
    data = [_squeeze(_pack(*_split(np.array(c, np.uint64)), np.array(n), np.array(t))) for c, n, t in mine]
    table = pa.table({"bucket": [0, 1, 2], "slice": [0, 0, 0], "sums": data, "figures": [[1.0], [2.0], [3.0]]})
    found = _add_slice(table)
    assert found.column_names == table.column_names and found.column("figures").to_pylist() == [[1.0], [2.0], [3.0]]
    sums = [[a.tolist() for a in _unpack(_release(d))] for d in found.column("sums").to_pylist()]
    assert sums == [[[6, 1, 8], [3, 1, 4]], [[6, 8], [3, 4]], [[8], [5]]]


def test_sizes_follow_the_text():
    assert sizes(0) == (8, 1024) and sizes(10**9) == (239, 65536)
    assert sizes(10**12)[0] > 200_000


def brute_segments(scores):
    def best(a, b):
        found = None
        for i in range(a, b):
            for j in range(i + 1, b + 1):
                s = sum(scores[i:j])
                if s > 1e-12 and (found is None or s > found[2] + 1e-12):
                    found = (i, j, s)
        return found

    def all_of(a, b):
        found = best(a, b)
        return [*all_of(a, found[0]), found[:2], *all_of(found[1], b)] if found else []

    return all_of(0, len(scores))


def test_all_maximal_segments():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.uniform(-2, 1.5) for _ in range(rng.randint(0, 14))]
        assert [s[:2] for s in maximal_segments(np.array(scores), 0)] == brute_segments(scores)


def test_toxicity_separates_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = score_toxicity(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    toxic, clean = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([[(a > b) + (a == b) / 2 for b in clean] for a in toxic]) > 0.75


def test_toxicity_of_odd_rows_and_labels(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (8, None), (99, 1)], "doc_id bigint, toxic int")
    rows = score_toxicity(odd_documents(spark), labels).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert all(0 <= r.score <= 1 for r in score_toxicity(odd_documents(spark), none).collect())
    assert score_toxicity(empty(spark), none).count() == 0


def test_gradients_are_those_of_the_loss():
    make = Pages(5)
    pages = [make.page() for _ in range(3)]
    blocks, labels = [b for b, _ in pages], [y for _, y in pages]
    model = Labeller(3)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    _, grads = model.gradients(blocks, labels)
    for name, grad in grads.items():
        place = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        at, losses = model.w[name][place], []
        for shift in (1e-4, -1e-4):
            model.w[name][place] = at + shift
            losses.append(model.gradients(blocks, labels)[0])
        model.w[name][place] = at
        assert abs((losses[0] - losses[1]) / 2e-4 - grad[place]) < 2e-4 + 0.02 * abs(grad[place])


def test_labeller_on_pages_it_has_not_seen():
    make = Pages(77)
    pages = [page for page in (make.page() for _ in range(150)) if page[0]]
    found = trained_labeller().probabilities([b for b, _ in pages])
    right = np.concatenate([(p >= 0.5) == (np.array(y) == 1) for p, (_, y) in zip(found, pages, strict=True)])
    assert right.mean() > 0.99


def test_blocks():
    page = "<p>a <b>b</b>c &amp; d<p>e<br>f<script>x('</p>')</script><!-- g --><ul><li>h<li>i</ul>j"
    assert [b.text for b in blocks_of(page)] == ["a bc & d", "e f", "h", "i", "j"]
    assert blocks_of(None) == [] and blocks_of("<<<>>") != []


def test_blocks_of_pages_with_elements_left_open():
    texts = lambda page: [b.text for b in blocks_of(page)]
    assert texts("<html><head><title>x</title><p>Body.</p>") == ["Body."]
    assert texts("<head><meta charset=u><link href=x>Text at once<div>more") == ["Text at once", "more"]
    assert texts("<html><head><title>x</title></head><body><p>a") == ["a"]
    assert texts("<p>a</p><select><option>b<p>c</p>") == ["a", "b", "c"]
    assert texts("<p>a</p><select><option>b</select><p>c</p>") == ["a", "c"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p><object>Kept.</object>") == ["Let x=1 hold.", "Kept."]
    assert texts("<p>a</p><script>b<p>c</p>") == ["a"] and texts("<svg/><p>d") == ["d"]
    assert texts("<p>a" + "<iframe>" * 3 + "<p>b") == ["a", "b"]
    assert "head" not in blocks_of("<head><p>x")[0].path


def test_digits_are_counted_over_the_whole_block():
    from llm.html_text import Block, _figures

    block = Block(("p",), "a" * 400 + "1" * 400, 1, 0)
    assert _figures(block)[4] == 0.5


def test_main_text_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = extract_main_text(pages).collect()
    assert len(rows) == pages.count()
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", row.html, re.DOTALL).group(1)
        assert row.text == "\n".join(b.text for b in blocks_of(article)) and row.n_chars == len(row.text)


def test_main_text_of_odd_pages(spark):
    rows = [(1, None), (1, None), (2, ""), (3, "<html>"), (4, "<p>x</p>" * 20000), (5, "no tags"), (None, "<a href='")]
    frame = spark.createDataFrame(rows, "page_id bigint, html string").selectExpr("*", "1 AS Text")
    found = extract_main_text(frame).collect()
    assert len(found) == 7 and all(r.text == "" and r.n_chars == 0 for r in found if not r.html)
    assert extract_main_text(frame.limit(0)).count() == 0
