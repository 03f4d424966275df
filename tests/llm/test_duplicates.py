import collections
import random
import re

import xxhash

from llm.decontaminate import find_contamination, words_of
from llm.graph import components
from llm.simhash import _signed, fingerprint, keep_one_of_each_group, links, near_duplicate_groups
from llm.queries import op1_substring_dedup
from llm.substrings import remove_repeated
from tests.llm.odd import empty, lower_words, odd_documents


SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    found = lower_words(text)
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] if len(found) > 2 else [" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= 2:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_groups_of_odd_rows(spark):
    docs = odd_documents(spark)
    rows = near_duplicate_groups(docs).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rows) == len(texts)
    values = [brute_fingerprint(t) for _, t in texts]
    roots, ids = brute_components(values), collections.defaultdict(list)
    for root, (doc_id, _) in zip(roots, texts, strict=True):
        ids[root].append(doc_id)
    least = [min((i for i in ids[r] if i is not None), default=None) for r in roots]
    want = sorted(((i is None, i or 0, f"{v:016x}", c or -1) for (i, _), v, c in zip(texts, values, least, strict=True)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id or -1) for r in rows) == want
    kept = keep_one_of_each_group(docs)
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted(
        min((i for i in group if i is not None), default=-1) for group in ids.values()
    )
    assert kept.columns == docs.columns


def test_no_rows(spark):
    assert near_duplicate_groups(empty(spark)).count() == 0
    assert keep_one_of_each_group(empty(spark)).count() == 0
    assert remove_repeated(empty(spark)).count() == 0
    assert find_contamination(empty(spark), spark.createDataFrame([], "item_id bigint, text string")).count() == 0


def test_dense_balls_link_like_all_pairs(spark):
    rng, values = random.Random(1), set()
    for _ in range(2):
        centre = rng.getrandbits(64)
        for _ in range(250):
            value = centre
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(values | {rng.getrandbits(64) for _ in range(100)})
    frame = spark.createDataFrame([(_signed(v),) for v in values], "f bigint")
    found = {r.v: r.root for r in components(links(frame)).collect()}
    mine = [found.get(_signed(v), _signed(v)) for v in values]
    pairs = set(zip(mine, brute_components(values), strict=True))
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    roots = {r.v: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({roots[i] for i in range(61)}) == 1 and len({roots[i] for i in range(1000, 1100)}) == 1
    assert roots[0] != roots[1000]


def test_fingerprint_of_very_long_text():
    text = "a b c d e f g " * 20000
    assert fingerprint(text.encode()) == _signed(brute_fingerprint(text))


def brute_units(text):
    """Stretches between line ends and sentence ends, found character by character."""
    units, start, i = [], 0, 0
    while i <= len(text):
        blank = text[i : i + 1] in (" ", "\t")
        if i == len(text) or text[i] == "\n":
            units.append((start, i))
            start = i + 1
        elif i and text[i - 1] in ".!?\u2026\u061f\u06d4\u0964\u0965" and blank or i and text[i - 1] in "\u3002\uff01\uff1f\uff61":
            units.append((start, i))
            blanks = " \t" if blank and text[i - 1] in ".!?\u2026\u061f\u06d4\u0964\u0965" else " \t\u3000"
            while text[i : i + 1] and text[i] in blanks:
                i += 1
            start = i
            if text[i : i + 1] == "\n":
                continue
        i += 1
    return [(a, b) for a, b in units if a < b]


def brute_words(text):
    return tuple(re.findall(r"[^\W_]+(?:['\u2019-][^\W_]+)*", text.lower()))


def brute_removed(rows, least_words=20, least_text=5):
    """doc_id and text in rank order; repeated rows count once."""
    first, out = set(), {}
    for doc_id, text in rows:
        units = [(low, high, brute_words(text[low:high])) for low, high in brute_units(text or "")]
        units = [u for u in units if u[2]]
        marks = []
        for _, _, words in units:
            marks.append(words in first)
            first.add(words)
        spans, i = [], 0
        while i < len(units):
            j = i
            while j < len(units) and marks[j]:
                j += 1
            words = sum(len(u[2]) for u in units[i:j])
            if j > i and words >= (least_text if j - i == len(units) else least_words):
                spans.append((units[i][0], units[j - 1][1]))
            i = j + 1
        out[doc_id, text] = spans
    return out


def without(text, spans):
    out, at = "", 0
    for low, high in spans:
        out, at = out + text[at:low], high
    return out + text[at:]


def test_substring_query_equals_the_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    want = {i: spans for (i, _), spans in brute_removed(docs).items()}
    rows = op1_substring_dedup(spark, SF).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for row in rows:
        assert row.removed == ",".join(f"{a}:{b}" for a, b in want[row.doc_id])
        assert row.text == (without(texts[row.doc_id], want[row.doc_id]) if texts[row.doc_id] is not None else None)
        assert row.n_removed == len(want[row.doc_id])


def test_sentence_ends_of_other_scripts_and_short_repeats(spark):
    chinese = "\u8fd9\u662f \u4e00 \u4e2a \u5f88 \u957f \u7684 \u53e5 \u5b50\u3002"
    rows = [(1, f"{chinese}\u7532\u3002"), (2, f"\u4e59\u3002{chinese}{chinese}\u4e19\u3002 "), (3, chinese), (4, "Of the. New one here. "), (5, "Of the. Other one.")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in remove_repeated(df, least_words=10).collect()}
    assert found[2].text == "\u4e59\u3002\u4e19\u3002 " and [tuple(s) for s in found[2].removed] == [(2, 2 + 2 * len(chinese))]
    assert found[3].text == "" and found[4].text == rows[3][1] and found[5].text == rows[4][1]


def test_repeated_units_of_odd_rows(spark):
    docs = odd_documents(spark)
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").distinct().collect()]
    named = sorted((x for x in texts if x[0] is not None), key=lambda x: x[0])
    want = brute_removed(named + [x for x in texts if x[0] is None])
    before = collections.Counter((r.doc_id, r.source) for r in docs.collect())
    rows = remove_repeated(docs).collect()
    assert collections.Counter((r.doc_id, r.source) for r in rows) == before
    spans = {(i, t): [tuple(s) for s in want[i, t]] for i, t in want}
    for row in rows:
        assert [tuple(s) for s in row.removed] in [s for (i, _), s in spans.items() if i == row.doc_id]
    assert next(r.text for r in rows if r.doc_id == 8) == ""
    assert next(r for r in rows if r.doc_id == 2).text is None


def test_long_passage_is_removed_and_clean_text_stays(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passage = " ".join([*(sentence(9) for _ in range(4)), "Of it.", *(sentence(9) for _ in range(3))])
    clean = [" ".join(["Of it.", sentence(12), sentence(8)]) for _ in range(4)]
    rows = [(i, f"{clean[i]} {passage} {sentence(7)}" if i in (1, 3) else clean[i]) for i in range(4)]
    found = {r.doc_id: r for r in remove_repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [found[i].text for i in (0, 1, 2)] == [rows[i][1] for i in (0, 1, 2)]
    assert passage not in found[3].text and clean[3] in found[3].text
    (span,) = found[3].removed
    assert rows[3][1][span.start : span.end] == passage


def brute_hits(text, items):
    found, covered, names = [w.decode() for w in words_of((text or "").encode())], set(), set()
    for name, item in items:
        mine = [w.decode() for w in words_of((item or "").encode())]
        windows = [mine[i : i + 10] for i in range(len(mine) - 9)] if len(mine) >= 10 else [mine] * bool(mine)
        for window in windows:
            for i in range(len(found) - len(window) + 1):
                if found[i : i + len(window)] == window:
                    covered |= set(range(i, i + len(window)))
                    names.add("" if name is None else str(name))
    return len(found), len(covered), sorted(names)


def test_contamination_in_one_and_many_passes(spark):
    items = [
        (1, "The QUICK brown fox, jumps over the lazy dog and runs"), (2, "one"), (3, None), (None, "lazy dog and"),
        (4, ""), (4, "ipsum dolor sit amet consectetur adipiscing elit lorem ipsum dolor sit amet"), (2, "one"),
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = odd_documents(spark)
    for pairs in (400_000, 2):
        rows = find_contamination(docs, benchmark, pairs_a_pass=pairs).collect()
        assert len(rows) == 13
        for row in rows:
            if row.doc_id == 5:  # very long: the brute-force version is slow on it
                assert row.n_hit == row.n_words - 4 and row.hit_items == ["4"]
            else:
                assert (row.n_words, row.n_hit, row.hit_items) == brute_hits(row.text, items)
