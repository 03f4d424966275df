"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are emitted."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import drop_columns, ship

# Capital letters that are younger than Python's tables, with their small letters.
YOUNG_CAPITALS = {0xA7CB: 0x0264, 0xA7DC: 0x019B}
#: Words and pieces whose counts a Python worker remembers; a full memory is emptied.
MEMORY = 400_000


def read_rules(path: str) -> dict:
    """What counting needs of a tokenizer file: merges, splitting pattern, word end, added tokens.

    Files of the kind word-BPE with NFC, white-space and lower-case normalisers, one splitting
    pattern and byte-level symbols are understood; others raise an error.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    steps = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
    model = spec["model"]
    if kinds != ["NFC", "Replace", "Lowercase"] or steps != ["Split", "ByteLevel"] or model["type"] != "BPE":
        raise ValueError(f"{path}: not a tokenizer of the kind that can be counted")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {
        "merges": merges,
        "pattern": spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"],
        "word_end": model["end_of_word_suffix"] or "",
        "raw_tokens": [t["content"] for t in spec["added_tokens"] if not t["normalized"]],
        "normal_tokens": [t["content"].lower() for t in spec["added_tokens"] if t["normalized"]],
    }


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the others for the characters from U+0100.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class _Memory(dict):
    """Remembers a function's values, so many at most."""

    def __init__(self, function, most: int):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        value = self.function(key)
        if len(key) < 64:  # long runs hardly recur
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Counter:
    """Counts tokens of texts by the rules of one tokenizer."""

    def __init__(self, rules: dict, memory: int = MEMORY):
        self.merge = {pair: (rank, pair[0] + pair[1]) for rank, pair in enumerate(rules["merges"])}
        self.word_end = rules["word_end"]
        self.symbols = byte_symbols()
        self.find = regex.compile(rules["pattern"]).findall
        alternatives = "|".join(map(re.escape, rules["raw_tokens"]))
        self.raw = re.compile(alternatives) if alternatives else None
        alternatives = "|".join(map(re.escape, rules["normal_tokens"]))
        self.normal = re.compile(alternatives) if alternatives else None
        self.pieces = _Memory(self.piece, memory)
        self.words = _Memory(self.word, memory)

    def piece(self, piece: str) -> int:
        """Symbols of a piece minus the merges that apply, the lowest rank first, leftmost first.

        The pieces form a linked list of symbols; the heap holds candidate pairs by rank and
        place. An entry is stale if its left symbol has gone or changed, or its pair has.
        """
        symbols = self.symbols
        text = [symbols[b] for b in piece.encode("utf-8", "surrogatepass")]
        if not text:
            return 0
        text[-1] += self.word_end
        n = left = len(text)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merge, heap = self.merge.get, []
        for i in range(n - 1):
            if found := merge((text[i], text[i + 1])):
                heap.append((found[0], i))
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if text[i] is None or j < 0:
                continue
            found = merge((text[i], text[j]))
            if not found or found[0] != rank:
                continue
            text[i], text[j] = found[1], None
            left -= 1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := merge((text[i], text[k])):
                    heapq.heappush(heap, (found[0], i))
            h = before[i]
            if h >= 0 and (found := merge((text[h], text[i]))):
                heapq.heappush(heap, (found[0], h))
        return left

    def plain(self, text: str) -> int:
        return sum(map(self.pieces.__getitem__, self.find(text)))

    def word(self, word: str) -> int:
        """Tokens of a stretch without white space."""
        if "<" in word:
            return self.marked(word)
        part = self.normalised(word)
        # Latin letters, perhaps with one sign behind them, need no pattern.
        body, sign = (part[:-1], part[-1]) if part[-1:] in ".,;:!?" else (part, "")
        if body.isalpha() and max(body) < "\u0250":
            return self.pieces[body] + (self.pieces[sign] if sign else 0)
        return self.plain(part)

    @staticmethod
    def normalised(part: str) -> str:
        """Lower case letter by letter: a sigma at the end of a word is not special here."""
        if part.isascii():
            return part.lower()
        return unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").translate(YOUNG_CAPITALS).lower()

    def marked(self, word: str) -> int:
        """A stretch that may hold strings of added tokens."""
        total = 0
        for part in self.raw.split(word) if self.raw else [word]:
            part = self.normalised(part)
            total += sum(map(self.plain, self.normal.split(part) if self.normal else [part]))
            total += len(self.normal.findall(part)) if self.normal else 0
        return total + (len(self.raw.findall(word)) if self.raw else 0)

    #: What str.split() takes for white space and the tokenizers do not.
    separators = re.compile(r"[\x1c-\x1f]")
    spaces = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

    def text(self, text: str) -> int:
        """White space never joins what stands around it, so a text is the sum of its words."""
        if self.separators.search(text):
            return sum(map(self.words.__getitem__, filter(None, self.spaces.split(text))))
        return sum(map(self.words.__getitem__, text.split()))


#: One counter per worker process and tokenizer, so that its memory serves many tasks.
_counters: dict[str, Counter] = {}


def count_tokens(df: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """Add `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens).

    Null and empty texts have no bytes and no tokens. Special strings inside texts count as the
    one token they are to the tokenizer. Whole texts are counted, however long: the work of a
    piece of n bytes is n log n. Rows that repeat get the same counts, an empty table stays
    empty, and columns of the three names are replaced. Nothing is shuffled; the merge table is
    broadcast and its size is that of the tokenizer file.
    """
    ship(df.sparkSession)
    rules = df.sparkSession.sparkContext.broadcast(read_rules(tokenizer_path))

    @F.arrow_udf("bigint")
    def tokens(texts: pa.Array) -> pa.Array:
        counter = _counters.get(tokenizer_path)
        if counter is None:
            counter = _counters[tokenizer_path] = Counter(rules.value)
        return pa.array([counter.text(t) for t in texts.to_pylist()], pa.int64())

    whole = F.coalesce(F.col(text), F.lit(""))
    counted = drop_columns(df, "n_bytes", "n_tokens", "over_limit").withColumns(
        {"n_bytes": F.octet_length(whole).cast("bigint"), "n_tokens": tokens(whole)}
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
