"""Scores under a hierarchical Pitman-Yor language model, trained on the corpus itself.

Every context has a restaurant: the customers are the training tokens that follow the context, the
dishes their words. A table sends one customer to the parent restaurant, which all contexts share
and which has the words of the whole corpus; its own parent is the uniform distribution over the
vocabulary and one unknown word. Contexts are previous words, each with a restaurant of its own.

The corpus is cut into blocks of documents and the vocabulary into buckets of words, whose number
follows the size of the text. A block sends each bucket the counts of its words by restaurant, and
who uses them; a bucket holds all seats of its words, and knows the contexts they follow. Seats are sampled by Gibbs in numpy: in a
sweep every customer leaves its table and sits down again by the Chinese-restaurant rule, dishes of
more than eight customers an eighth at a time. Seats in the root are kept and follow the tables
below. Only the totals of restaurants are shared between buckets: between two phases of sampling each
bucket sends those of its contexts to the slices of the contexts' hashes, which add them up and send
each bucket the sums that it asked for. Samples are replayed from seeds where they are needed again, so no state is
written. Probabilities are averaged over samples, a bucket sums their logarithms by document, and a
block adds up what its buckets say.
"""

from __future__ import annotations

import ctypes
import pickle
import struct
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import scratch_path, ship, stored

#: What `sizes` reckons for contexts that share restaurants; scoring keeps contexts apart.
RESTAURANT_BYTES, LEAST_RESTAURANTS, MOST_RESTAURANTS = 16 << 10, 1 << 10, 1 << 16
#: Sweeps over all customers before the samples, and the samples that are averaged.
WARM_SWEEPS, SAMPLES = 2, 3
#: Parts of a sweep: so many customers of a dish move one by one, of larger dishes parts of this share.
ROUNDS = 8
CONTEXT_STRENGTH, ROOT_STRENGTH = 1.0, 10.0
_MEMORY = 60_000
#: A block has so many bytes of text, but at least one document; a task's batches are cut so.
BLOCK_BYTES = 2 << 20
#: A bucket of words for so many bytes of text.
BUCKET_BYTES, LEAST_BUCKETS = 4 << 20, 8
#: Documents whose sums a task holds at most; more are sent on in between.
FLUSH_DOCUMENTS = 2_000_000
#: A slice of the contexts for so many buckets, but so many at least; it adds up their totals.
SLICE_BUCKETS, LEAST_SLICES = 16, 8
#: Buckets that one task samples, about.
TASK_BUCKETS = 4
#: A context is known by so many leading bits of its word's hash.
CONTEXT_BITS = 48
_END = xxhash.xxh64_intdigest(b"")
_ROWS = "bucket int, block bigint, state binary, readers binary"
_TOTALS = "bucket int, slice int, sums binary, figures array<double>"
_CODEC = pa.Codec("zstd", compression_level=1)


def _trim() -> None:
    """Give freed memory back to the machine: workers live on between jobs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


class _Hashes(dict):
    """Word hashes that a worker remembers, up to a number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def _pack(*arrays: np.ndarray) -> bytes:
    """Numbers end to end behind their kinds and lengths, in as few bytes as the largest needs."""
    arrays = tuple(a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8) for a in arrays)
    head = b"".join(a.dtype.str.encode() + struct.pack("<I", len(a)) for a in arrays)
    return struct.pack("<B", len(arrays)) + head + b"".join(a.tobytes() for a in arrays)


def _unpack(data: bytes) -> list[np.ndarray]:
    heads = [(data[at : at + 3].decode(), *struct.unpack_from("<I", data, at + 3)) for at in range(1, 1 + 7 * data[0], 7)]
    at, found = 1 + 7 * data[0], []
    for kind, length in heads:
        found.append(np.frombuffer(data, kind, length, at))
        at += found[-1].nbytes
    return found


def _squeeze(data: bytes) -> bytes:
    return struct.pack("<Q", len(data)) + _CODEC.compress(data, asbytes=True)


def _release(data: bytes) -> bytes:
    return _CODEC.decompress(memoryview(data)[8:], struct.unpack_from("<Q", data)[0], asbytes=True)


def _split(contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts in six bytes each."""
    return (contexts >> np.uint64(16)).astype(np.uint32), (contexts & np.uint64(0xFFFF)).astype(np.uint16)


def _whole(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.uint64) << np.uint64(16) | low.astype(np.uint64)


@dataclass
class Totals:
    """Sums over all buckets. `customers` and `tables` have one number per restaurant."""

    customers: np.ndarray
    tables: np.ndarray
    root_customers: float
    root_tables: float
    tokens: float
    words: float
    context_discount: float = 0.75
    root_discount: float = 0.75

    @staticmethod
    def first(sums: np.ndarray) -> Totals:
        """Before any sampling: every dish has one table. Discounts are those that the numbers of
        dishes with one and with two customers suggest."""
        r = (len(sums) - 8) // 2
        ones, twos, root_ones, root_twos = sums[2 * r + 4 :]
        discount = lambda n1, n2: float(np.clip(n1 / max(n1 + 2 * n2, 1), 0.05, 0.95))
        return Totals(
            sums[:r], sums[r : 2 * r], *sums[2 * r : 2 * r + 4], discount(ones, twos), discount(root_ones, root_twos)
        )

    def later(self, sums: np.ndarray) -> Totals:
        r = len(self.customers)
        return Totals(
            self.customers, sums[r : 2 * r], *sums[2 * r : 2 * r + 2], self.tokens, self.words,
            self.context_discount, self.root_discount,
        )


class Seats:
    """Tables of dishes, in order of dish: `owner` is the dish's number, `size` the customers at the table."""

    def __init__(self, count: np.ndarray, weight: np.ndarray, discount: float):
        """Begin with the number of tables that the rule leads to on average.

        With weight a for a new table and discount d, c customers make about
        1 + a log((a + c - d) / (a + 1 - d)).
        """
        self.count = count
        tables = 1 + weight * np.log((weight + count - discount) / (weight + 1 - discount))
        tables = np.clip(np.rint(tables), 1, count).astype(np.int64)
        self.owner = np.repeat(np.arange(len(count)), tables)
        place = np.arange(len(self.owner)) - np.repeat(np.cumsum(tables) - tables, tables)
        share, rest = np.divmod(count, tables)
        self.size = share[self.owner] + (place < rest[self.owner])

    def _leave(self, gone: np.ndarray, rng: np.random.Generator) -> None:
        """So many customers of each dish leave: all of its customers in a row, every (count / gone)th from a random one on."""
        count = np.bincount(self.owner, self.size, len(gone))
        rate, shift = (gone / np.maximum(count, 1))[self.owner], rng.random(len(gone))[self.owner]
        ends = np.cumsum(self.size) - (np.cumsum(count) - count)[self.owner]
        picked = lambda upto: np.clip(np.ceil(upto * rate - shift), 0, gone[self.owner]).astype(np.int64)
        self.size = self.size - np.minimum(picked(ends) - picked(ends - self.size), self.size)
        stay = self.size > 0
        self.owner, self.size = self.owner[stay], self.size[stay]

    def _join(self, weight: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        """Customers that a dish lacks sit down, each at a table with a weight of its size less the discount, or at a new one."""
        lacks = self.count - np.bincount(self.owner, self.size, len(self.count)).astype(np.int64)
        who = np.repeat(np.arange(len(lacks)), np.maximum(lacks, 0))
        mass = self.size - discount
        held = np.bincount(self.owner, mass, len(lacks))
        draw = rng.random(len(who)) * (weight + held)[who]
        opens = (draw < weight[who]) | (held[who] <= 0)
        joins, over = who[~opens], (draw - weight[who])[~opens]
        found = np.searchsorted(np.cumsum(mass), (np.cumsum(held) - held)[joins] + over, side="right")
        tables = np.bincount(self.owner, minlength=len(lacks))
        last = np.cumsum(tables)
        found = np.clip(found, (last - tables)[joins], last[joins] - 1)
        self.size = self.size + np.bincount(found, minlength=len(self.size)).astype(np.int64)
        new = who[opens]
        at = last[new]
        self.owner, self.size = np.insert(self.owner, at, new), np.insert(self.size, at, 1)

    def sweep(self, weight: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        """Every customer leaves once and sits down again, or as many as there are."""
        for turn in range(ROUNDS):
            self._leave(np.where(turn < self.count, -(-self.count // ROUNDS), 0), rng)
            self._join(weight, discount, rng)

    def resize(self, count: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        """Dishes get or lose customers; those who stay keep their seats."""
        self._leave(np.maximum(self.count - count, 0), rng)
        self.count = count
        self._join(weight, discount, rng)

    def tables(self) -> np.ndarray:
        return np.bincount(self.owner, minlength=len(self.count))


class Restaurants:
    """The seats of one bucket's words. Entries are (word, restaurant) with a count, by word."""

    def __init__(self, word: np.ndarray, restaurant: np.ndarray, count: np.ndarray, words: int, seed: int):
        self.word, self.restaurant, self.count, self.words = word, restaurant, count, words
        self.rng = np.random.default_rng(seed)
        self.many = np.flatnonzero(count > 1)
        self.tables = (count > 0).astype(np.int64)
        self.root_tables = np.zeros(words)
        self.seats: Seats | None = None
        self.root_seats: Seats | None = None

    def root_customers(self) -> np.ndarray:
        return np.bincount(self.word, self.tables, self.words)

    def root(self, totals: Totals) -> np.ndarray:
        """Each word's probability in the root restaurant, after a sweep over its customers there."""
        customers = self.root_customers().astype(np.int64)
        known = np.flatnonzero(customers > 0)  # the same words at every call
        weight = (ROOT_STRENGTH + totals.root_discount * totals.root_tables) / (totals.words + 1)
        weights, discount = np.full(len(known), weight), totals.root_discount
        if self.root_seats is None:
            self.root_seats = Seats(customers[known], weights, discount)
        else:
            self.root_seats.resize(customers[known], weights, discount, self.rng)
        self.root_seats.sweep(weights, discount, self.rng)
        self.root_tables[known] = self.root_seats.tables()
        over = customers - discount * self.root_tables + weight
        return over / (ROOT_STRENGTH + totals.root_customers)

    def phase(self, totals: Totals, sweeps: int) -> Iterator[np.ndarray]:
        """Sample under fixed totals; gives each entry's probability after every sweep."""
        strength = CONTEXT_STRENGTH + totals.context_discount * totals.tables
        discount = totals.context_discount
        for _ in range(sweeps):
            root = self.root(totals)
            pull = strength[self.restaurant] * root[self.word]
            if self.seats is None:
                self.seats = Seats(self.count[self.many], pull[self.many], discount)
            self.seats.sweep(pull[self.many], discount, self.rng)
            self.tables[self.many] = self.seats.tables()
            over = self.count - discount * self.tables + pull
            yield over / (CONTEXT_STRENGTH + totals.customers[self.restaurant])

    def sums(self, restaurants: int) -> np.ndarray:
        """What this bucket adds to the totals."""
        customers, trained = self.root_customers(), self.count > 0
        per = lambda values: np.bincount(self.restaurant, values, restaurants)
        counts = [np.sum(self.count == 1), np.sum(self.count == 2), np.sum(customers == 1), np.sum(customers == 2)]
        rest = [customers.sum(), self.root_tables.sum() or (customers > 0).sum(), self.count.sum()]
        known = len(np.unique(self.word[trained]))
        return np.concatenate([per(self.count), per(self.tables), rest, [known], counts]).astype(float)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of the blocks that a batch is cut into."""
    start, total = 0, 0
    for at, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if at > start and total + size > BLOCK_BYTES:
            yield start, at - start
            start, total = at, 0
        total += size
    yield start, len(texts) - start


def _block(block: int, ids: pa.Array, texts: list, held: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows of one block: its documents, and per bucket the entries and who uses them."""
    lookup, hashes, document = _hashes.__getitem__, [], []
    for number, text in enumerate(texts):
        words = text.lower().split() if text else []
        hashes.append(np.fromiter(map(lookup, words), np.uint64, len(words)))
        hashes.append(np.array([_END], np.uint64))
        document.append(len(words) + 1)
    document = np.array(document, np.int64)
    token = np.concatenate(hashes)
    reader = np.repeat(np.arange(len(document)), document)
    del hashes
    word, code = np.unique(token, return_inverse=True)
    del token
    before = np.roll(code, 1)  # the end of one text stands before the next one's first word, and the last end before the first
    bucket = ((word >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(word), np.int64)
    rank[order] = np.arange(len(word))
    # Word, context and document in one number: sorting it groups all three.
    readers, words = len(document), len(word)
    packed = np.sort((rank[code] * words + before) * readers + reader)
    del code, before, reader
    first = np.flatnonzero(np.diff(packed, prepend=-1))
    uses = np.diff(first, append=len(packed))
    packed = packed[first]
    entry, reader = packed // readers, packed % readers
    train = np.where(held[reader], 0, uses)
    starts = np.flatnonzero(np.diff(entry, prepend=-1))
    owner, context = entry[starts] // words, word[entry[starts] % words] >> np.uint64(64 - CONTEXT_BITS)
    count = np.add.reduceat(train, starts)
    readers_of = np.diff(starts, append=len(entry))
    entry_edge = np.searchsorted(owner, np.searchsorted(bucket[order], np.arange(buckets + 1)))
    # A word that one block uses far more than a bucket's share keeps its uses in the block and
    # has the values sent back, so no bucket receives all uses of a word that is everywhere.
    heavy = np.bincount(owner, readers_of, len(word)) > max(1024, 4 * len(entry) // buckets)
    kept = []
    for b in range(buckets):
        low, high = entry_edge[b], entry_edge[b + 1]
        if low == high:
            continue
        use_low, use_high = starts[low], starts[high] if high < len(starts) else len(entry)
        light = ~heavy[owner[low:high]]
        light_uses = np.repeat(light, readers_of[low:high])
        names = word[order][owner[low] : owner[high - 1] + 1]
        runs = np.bincount(owner[low:high] - owner[low])
        state = (names, runs.astype(np.uint32), *_split(context[low:high]), count[low:high].astype(np.uint32))
        uses_here = slice(use_low, use_high)
        number = np.where(light, readers_of[low:high], 0).astype(np.uint32)
        sent = (number, reader[uses_here][light_uses].astype(np.uint32), uses[uses_here][light_uses].astype(np.uint32))
        if not light.all():
            kept.append((b, readers_of[low:high][~light], reader[uses_here][~light_uses], uses[uses_here][~light_uses]))
        yield b, block, _squeeze(_pack(*state)), _squeeze(_pack(*sent))
    batch = pa.RecordBatch.from_arrays([ids], ["id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    yield -1, block, pickle.dumps((sink.getvalue().to_pybytes(), held, document)), pickle.dumps(kept)


def _merge(blocks: list[tuple[int, bytes]]) -> tuple[tuple, list]:
    """One bucket's entries over all blocks, and each block's entries as numbers into them, which ascend."""
    parts = [_unpack(_release(state)) for _, state in blocks]
    names, word = np.unique(np.concatenate([p[0].astype(np.uint64) for p in parts]), return_inverse=True)
    word = np.repeat(word, np.concatenate([p[1] for p in parts]))
    contexts, context = np.unique(np.concatenate([_whole(p[2], p[3]) for p in parts]), return_inverse=True)
    entries, number = np.unique(word * len(contexts) + context, return_inverse=True)
    del word, context
    total = np.bincount(number, np.concatenate([p[4] for p in parts]), len(entries)).astype(np.int64)
    runs = np.bincount(entries // len(contexts), minlength=len(names))
    state = _small(runs), _small(entries % len(contexts)), _small(total), np.diff(contexts, prepend=np.uint64(0))
    return state, np.split(number, np.cumsum([len(p[4]) for p in parts])[:-1])


def _small(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


class Sums:
    """What a task adds up for documents, over all buckets it has, so that a document's block gets one row from it."""

    def __init__(self):
        self.blocks: dict[int, np.ndarray] = {}
        self.back: dict[int, dict[int, tuple]] = {}
        self.first: dict[int, int] = {}
        self.documents = 0

    def add(self, block: int, bucket: int, word: np.ndarray, values: np.ndarray, number, reader, uses) -> None:
        """Entries of a bucket with their words and (score, base, known), the readers of each, and their uses.

        Entries without readers belong to words whose uses stayed in the block; their values go back,
        base and known once a word.
        """
        number, reader = number.astype(np.int64), reader.astype(np.int64)
        size = int(reader.max(initial=-1)) + 1
        here = self.blocks.get(block)
        if here is None or here.shape[1] < size:
            grown = np.zeros((3, max(size, 1)))
            if here is not None:
                grown[:, : here.shape[1]] = here
                self.documents -= here.shape[1]
            self.documents += grown.shape[1]
            here = self.blocks[block] = grown
        light = np.repeat(values, number, axis=1) * uses
        for row in range(3):
            here[row, :size] += np.bincount(reader, light[row], size)
        self.first.setdefault(block, bucket)
        stayed = np.flatnonzero(number == 0)
        if len(stayed):
            words = word[stayed]
            starts = np.flatnonzero(np.diff(words, prepend=-1))
            runs = np.diff(starts, append=len(words))
            score = values[0, stayed].astype(np.float32).tobytes()
            self.back.setdefault(block, {})[bucket] = score, _small(runs), values[1, stayed[starts]], values[2, stayed[starts]]

    def flush(self) -> Iterator[pa.RecordBatch]:
        for block, (score, base, known) in self.blocks.items():
            documents = np.flatnonzero((score != 0) | (base != 0))
            counts = _small(documents), _small(np.rint(known[documents]).astype(np.int64))
            answer = counts, score[documents].astype(np.float32).tobytes(), base[documents].tobytes(), self.back.get(block, {})
            yield _answers([(block, self.first[block], pickle.dumps(answer))])
        self.__init__()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    names = ["bucket", "block", "state", "readers"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _restaurants(state: bytes, bucket: int) -> tuple[Restaurants, np.ndarray]:
    """A bucket's seats, and the contexts that its restaurants belong to, in ascending order."""
    runs, restaurant, count, steps = pickle.loads(_release(state))
    word = np.repeat(np.arange(len(runs)), runs)
    return Restaurants(word, restaurant.astype(np.int64), count.astype(np.int64), len(runs), bucket), np.cumsum(steps)


def _sums(slices: list[dict], figures: list[float]) -> np.ndarray:
    """The sums of all buckets, of restaurants those that one bucket has contexts for."""
    parts = [_unpack(_release(part["sums"])) for part in sorted(slices, key=lambda part: part["slice"])]
    return np.concatenate([*[np.concatenate([p[k] for p in parts]) for k in (0, 1)], figures]).astype(float)


def _add_slice(table: pa.Table) -> pa.Table:
    """The buckets' totals of one slice's contexts in, the sums for the same contexts out."""
    parts = [_unpack(_release(data)) for data in table.column("sums").to_pylist()]
    _, number = np.unique(np.concatenate([_whole(p[0], p[1]) for p in parts]), return_inverse=True)
    added = [np.bincount(number, np.concatenate([p[k] for p in parts])).astype(np.int64)[number] for k in (2, 3)]
    edges = np.cumsum([len(p[0]) for p in parts])[:-1]
    sums = [_squeeze(_pack(*both)) for both in zip(*[np.split(a, edges) for a in added], strict=True)]
    return table.set_column(table.column_names.index("sums"), "sums", pa.array(sums, pa.binary()))


def sizes(text_bytes: int) -> tuple[int, int]:
    """Buckets for so many bytes of text; the cluster's settings have no part in them.

    The second number is that of restaurants for contexts that share them by hash, which scoring does not do.
    """
    restaurants = 1 << max(0, (text_bytes // RESTAURANT_BYTES).bit_length())
    return max(LEAST_BUCKETS, -(-text_bytes // BUCKET_BYTES)), min(max(restaurants, LEAST_RESTAURANTS), MOST_RESTAURANTS)


@contextmanager
def _without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """A write's shuffle files go when it has ended, so that they do not lie beside the next one's."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _laid_out(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """`stored`, with the rows dealt by a key, so that joins by it need no shuffle of them."""
    spark, table = df.sparkSession, f"layout_{uuid.uuid4().hex}"
    df.write.bucketBy(parts, key).option("path", scratch_path(spark, name)).saveAsTable(table, format="parquet")
    return spark.table(table)


def score_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", fold: int = 10) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) per row.

    The model learns from rows whose crc32 of the id as text does not leave 0 modulo `fold`; the
    crc of a null id is that of an empty text. Null and empty texts are the end token alone.
    Repeated rows count as often as they come. Without training rows all probabilities are those
    of the unknown word. `base_score` is the additive unigram score, `score` the model's log10
    probability of the text, `perplexity` is per token. An empty table gives no rows. A very long text
    is a block of its own. Other columns are not read, so their names do not matter.
    """
    spark = df.sparkSession
    ship(spark)
    held = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % fold == 0
    narrow = df.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"), held.alias("held"))
    id_type = narrow.schema["id"].dataType.simpleString()
    size = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets, _ = sizes(size)
    slices = max(LEAST_SLICES, -(-buckets // SLICE_BUCKETS))
    tasks = -(-buckets // TASK_BUCKETS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for batch in batches:
            for at, rows in _pieces(batch.column(1)):
                part = batch.slice(at, rows)
                block += 1
                flags = np.array(part.column(2).to_pylist(), bool)
                for row in _block(block, part.column(0), part.column(1).to_pylist(), flags, buckets):
                    yield _rows([row])
            _trim()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        bucket, part = key
        rows = list(zip(*[table.column(c).to_pylist() for c in ("block", "state", "readers")], strict=True))
        if bucket.as_py() < 0:
            return pa.Table.from_batches([_rows([(-1, b, s, r) for b, s, r in rows])])
        state, numbers = _merge([(b, s) for b, s, _ in rows])
        readers = [(b, _small(np.diff(n, prepend=0)), _release(r)) for (b, _, r), n in zip(rows, numbers, strict=True)]
        found = pa.Table.from_batches(
            [_rows([(bucket.as_py(), None, _squeeze(pickle.dumps(state)), _squeeze(pickle.dumps(readers)))])]
        )
        del rows, state, numbers, readers
        _trim()
        return found

    # Documents' own rows only travel along; the block spreads them.
    spread = F.when(F.col("bucket") < 0, F.pmod("block", F.lit(buckets))).otherwise(0)
    blocks = narrow.mapInArrow(cut, _ROWS).withColumn("part", spread)
    merged = blocks.groupBy("bucket", "part").applyInArrow(merge, _ROWS)
    # Laid out by bucket, so that a join by bucket moves the totals and leaves the states where they are.
    place = F.when(F.col("bucket") < 0, F.pmod("block", F.lit(buckets)).cast("int")).otherwise(F.col("bucket"))
    with _without_old_shuffles(spark):
        merged = _laid_out(merged.withColumn("place", place), "language-model", "place", tasks)
    words = merged.filter("bucket >= 0")

    def joined(states: DataFrame, totals: DataFrame, name: str) -> DataFrame:
        """A column with the slices' sums for each bucket."""
        mine = totals.select(F.col("bucket").alias("place"), F.struct("slice", "sums").alias("part"))
        mine = mine.repartition(tasks, "place").groupBy("place").agg(F.collect_list("part").alias(name))
        return states.join(mine.hint("shuffle_hash"), "place")

    def totals_after(states: DataFrame, warm: bool) -> tuple[DataFrame, list[float]]:
        """The sums of all buckets before any sampling or after the first phase: of contexts, as each bucket needs
        them, and of the whole corpus."""

        def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    bucket, state, *before = (column[row].as_py() for column in batch.columns)
                    here, contexts = _restaurants(state, bucket)
                    if warm:
                        for _ in here.phase(Totals.first(_sums(before[0], first)), WARM_SWEEPS):
                            pass
                    n, sums = len(contexts), here.sums(len(contexts))
                    slice_of = ((contexts >> np.uint64(CONTEXT_BITS - 32)) * np.uint64(slices)) >> np.uint64(32)
                    edges = np.flatnonzero(np.diff(slice_of.astype(np.int64), prepend=-1))
                    figures = sums[2 * n :].tolist()  # once a bucket
                    for low, high in zip(edges, [*edges[1:], n], strict=True):
                        customers, tables = sums[low:high], sums[n + low : n + high]
                        data = _pack(*_split(contexts[low:high]), customers.astype(np.int64), tables.astype(np.int64))
                        yield pa.RecordBatch.from_pydict(
                            {"bucket": [bucket], "slice": [int(slice_of[low])], "sums": [_squeeze(data)], "figures": [figures]}, kinds
                        )
                        figures = None
            _trim()

        kinds = pa.schema({"bucket": pa.int32(), "slice": pa.int32(), "sums": pa.binary(), "figures": pa.list_(pa.float64())})
        parts = states.mapInArrow(within, _TOTALS)
        with _without_old_shuffles(spark):
            found = stored(parts.groupBy("slice").applyInArrow(_add_slice, _TOTALS), "language-model-totals")
        figures = found.agg(*[F.sum(F.get("figures", F.lit(k))).alias(f"f{k}") for k in range(8)]).first()
        return found, [value or 0.0 for value in figures]

    totals, first = totals_after(words.select("bucket", "state"), False)
    warmed = joined(words, totals, "first")
    totals, later = totals_after(warmed.select("bucket", "state", "first"), True)
    ready = joined(warmed, totals, "later").select("bucket", "state", "readers", "first", "later")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block what the task's buckets sum up for its documents."""
        sums = Sums()
        for batch in batches:
            for row in range(batch.num_rows):
                bucket, state, readers, before, after = (column[row].as_py() for column in batch.columns)
                here, _ = _restaurants(state, bucket)
                start = Totals.first(_sums(before, first))
                for _ in here.phase(start, WARM_SWEEPS):
                    pass
                chance = np.log10(sum(here.phase(start.later(_sums(after, later)), SAMPLES)) / SAMPLES)
                seen = np.bincount(here.word, here.count, here.words)[here.word]
                values = np.stack([chance, np.log10(seen + 0.1), (seen > 0).astype(float)])
                for owner, steps, sent in pickle.loads(_release(readers)):
                    entries = np.cumsum(steps, dtype=np.int64)
                    sums.add(owner, bucket, here.word[entries], values[:, entries], *_unpack(sent))
                del here, chance, seen, values, start, readers, state
                if sums.documents > FLUSH_DOCUMENTS:
                    yield from sums.flush()
                _trim()
        yield from sums.flush()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The documents' states as they are."""
        for batch in batches:
            for block, state, kept in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                yield _answers([(block, -1, pickle.dumps((state, kept)))])

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("bucket").to_pylist(), table.column("answer").to_pylist(), strict=True))
        state, kept = pickle.loads(rows[0][1])
        ids, flags, tokens = pickle.loads(state)
        sums, back = np.zeros((3, len(tokens))), {}
        for _, answer in rows[1:]:
            (documents, known), score, base, sent_back = pickle.loads(answer)
            sums[0, documents] += np.frombuffer(score, np.float32)
            sums[1, documents] += np.frombuffer(base)
            sums[2, documents] += known
            back |= sent_back
        for bucket, number, reader, uses in pickle.loads(kept):
            score, runs, base, known = back[bucket]
            values = np.stack([np.frombuffer(score, np.float32), np.repeat(base, runs), np.repeat(known, runs)])
            values = np.repeat(values, number, axis=1) * uses
            for row in range(3):
                sums[row] += np.bincount(reader, values[row], len(tokens))
        column = pa.ipc.open_stream(ids).read_all().column("id").combine_chunks()
        trained, known_words = first[2:4]
        base = sums[1] - tokens * np.log10(trained + 0.1 * (known_words + 1))
        return pa.table(
            {
                "id": column,
                "held_out": pa.array(flags),
                "n_tokens": pa.array(tokens, pa.int64()),
                "n_known": pa.array(np.rint(sums[2]).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(tokens), int(trained)), pa.int64()),
                "base_score": pa.array(base),
                "score": pa.array(sums[0]),
                "perplexity": pa.array(10.0 ** (-sums[0] / tokens)),
            }
        )

    answers = "block bigint, bucket int, answer binary"
    documents = merged.filter("bucket < 0").select("block", "state", "readers")
    scored = ready.mapInArrow(score, answers).union(documents.mapInArrow(own, answers))
    found = scored.groupBy("block").applyInArrow(
        finish,
        f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, perplexity double",
    )
    return found.withColumnRenamed("id", doc_id)


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["block", "bucket", "answer"]
    )
