"""Similarity join of documents on their word shingles, by parity sketches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import drop_stored, map_texts, python_batches, store
from tickloom.llm.components import components

# What binds op8: two sets are alike if 10 * |A and B| >= 9 * |A or B|.
SHINGLE_WORDS = 3
ALIKE = (9, 10)
# Ratio of the ends of a size band.
BAND = 1.5
# Distinct words whose hashes a worker remembers before it starts anew.
REMEMBERED = 300_000
# Bits of the map that keeps unneeded texts from being shuffled.
MAP_BITS = 1 << 23
# Block keys that a task deals out at a time, that a bucket holds on average, and that are met at once.
DEALT, PER_BUCKET, AT_ONCE = 1_000_000, 1_000_000, 4_000_000
# Bytes of a block key besides its bucket.
KEY_BYTES = 5
# Shingles of the sets that a task remembers while it verifies pairs.
SETS = 4_000_000
# Bits of a set's sketch: the least and the most, and at least so many for each shingle that may differ.
LEAST_BITS, MOST_BITS, BITS_EACH = 1024, 1 << 24, 8
# Bytes that Python tasks get at once, and rows that they give at once of what has met.
BATCH_BYTES, MET_ROWS = 4 << 20, 100_000

_U = np.uint64
_ONE = _U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scattered over all 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_set(text: bytes | None, hash_of, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; none without words."""
    words = text.lower().split() if text else []  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(hash_of, words), np.uint64, len(words))
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total = _mixed(total * _U(0x9E3779B97F4A7C15) + hashes[k : len(words) - width + 1 + k])
    return np.unique(total)


class Band(NamedTuple):
    """Set sizes from ``first`` up to the next band, and how sketches of such sets are cut."""

    first: int
    last: int
    different: int  # shingles in which an alike pair may differ if its larger set lies here
    spare: int  # blocks more than needed for one to be the same in both sets

    @property
    def blocks(self) -> int:
        return self.different + 1 + self.spare


class Likeness:
    """Shingles of so many words, and how much of two sets must be shared for them to be alike.

    With ``alike = (p, q)`` sets are alike if ``q * |A and B| >= p * |A or B|``. Then
    ``(q + p) * |A xor B| <= (q - p) * (|A| + |B|)``.
    """

    def __init__(self, words: int = SHINGLE_WORDS, alike: tuple[int, int] = ALIKE):
        if words < 1 or not 0 < alike[0] <= alike[1]:
            raise ValueError(f"no likeness: {words} words, {alike[0]} of {alike[1]}")
        self.words, self.alike = words, alike
        self.differ = (alike[1] - alike[0], alike[1] + alike[0])

    @cached_property
    def bands(self) -> list[Band]:
        first, out = 1, []
        while first < 1 << 40:
            following = max(first + 1, int(first * BAND))
            different = 2 * (following - 1) * self.differ[0] // self.differ[1]
            out.append(Band(first, following - 1, different, 2 + different // 50))
            first = following
        return out

    def differs(self, n: int, band: Band) -> int:
        """Shingles in which a set of ``n`` and an alike one may differ if the larger lies in ``band``."""
        largest = min(n * self.alike[1] // self.alike[0], band.last)
        return (n + max(n, largest)) * self.differ[0] // self.differ[1]

    @cached_property
    def firsts(self) -> np.ndarray:
        return np.array([b.first for b in self.bands])


OP8 = Likeness()


def _block_keys(shingles: np.ndarray, number: int, likeness: Likeness) -> np.ndarray:
    """A key per block of the parity sketch: equal keys mean equal band, block and parities.

    A shingle toggles one of 2**58 bits of its block, so the parities of a block are the few odd
    bits, written as the XOR of their hashes. A set whose shingles lie in more blocks than it may
    differ in from an alike one agrees with it in one of these; only other sets give the keys of
    their empty blocks, too, which many sets have in common.
    """
    band = likeness.bands[number]
    if not band.different:
        return np.empty(0, np.uint64)  # alike sets are equal there
    block = (shingles % _U(band.blocks)).astype(np.int64)
    by_block = np.argsort(block, kind="stable")
    block = block[by_block]
    starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    parity = np.zeros(band.blocks, np.uint64)
    parity[block[starts]] = np.bitwise_xor.reduceat(_mixed(shingles[by_block] + _ONE), starts)
    place = _mixed(np.arange(band.blocks, dtype=np.uint64) + _U(number << 40))
    keys = _mixed(place ^ _mixed(parity + _U(0x9E3779B97F4A7C15)))
    return keys[block[starts]] if len(starts) > likeness.differs(len(shingles), band) else keys


def block_keys(shingles: np.ndarray, likeness: Likeness = OP8) -> np.ndarray:
    """The keys of a set in its own band, and in each further one if an alike set may lie there."""
    n = len(shingles)
    if not n:
        return np.empty(0, np.uint64)
    least, whole = likeness.alike
    band = int(np.searchsorted(likeness.firsts, n, "right")) - 1
    keys = [_block_keys(shingles, band, likeness)]
    while band + 1 < len(likeness.bands) and whole * n >= least * likeness.bands[band + 1].first:
        band += 1
        keys.append(_block_keys(shingles, band, likeness))
    return np.concatenate(keys)


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit hash of the whole set."""
    both = _mixed(shingles.sum(dtype=np.uint64, keepdims=True)) ^ np.bitwise_xor.reduce(
        _mixed(shingles + _ONE), keepdims=True
    )
    return int(_mixed(both + _U(len(shingles))).view(np.int64)[0])


def parity_sketch(shingles: np.ndarray, likeness: Likeness = OP8) -> np.ndarray:
    """The parities of how many shingles hit each bit, in words of 64; the larger the set, the more.

    The number of bits is a power of two. The XOR of its halves is the sketch in half as many.
    """
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_EACH * (2 * len(shingles) * likeness.differ[0] // likeness.differ[1])):
        bits *= 2
    odd = np.bincount(((shingles >> _U(40)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _folded(sketch: np.ndarray) -> np.ndarray:
    """The same sketch in the least number of bits."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, LEAST_BITS // 64), axis=0)


def _sketcher(likeness: Likeness):
    def work(batches: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        hash_of = _WordHashes().__getitem__
        with np.errstate(over="ignore"):
            for texts in batches:
                columns: list[list] = [[], [], [], []]
                for text in texts:
                    s = shingle_set(text, hash_of, likeness.words)
                    sketch = parity_sketch(s, likeness)
                    row = (len(s), set_id(s), sketch, _folded(sketch))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                yield columns

    return work


def _own_text(likeness: Likeness):
    """Whether a text has the set whose hash stands beside it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = _WordHashes().__getitem__
        with np.errstate(over="ignore"):
            for batch in batches:
                texts, ids = batch.column("text").to_pylist(), batch.column("id").to_pylist()
                own = [set_id(shingle_set(t, hash_of, likeness.words)) == i for t, i in zip(texts, ids, strict=True)]
                yield batch.filter(pa.array(own, pa.bool_()))

    return work


# --- meeting at block keys ---------------------------------------------------------------


def _dealer(likeness: Likeness, buckets: int):
    """The block keys of texts, dealt out to buckets: per bucket one row with all that a task has gathered.

    A row is packed: the sets' hashes, how many keys of each follow, and the keys, by set. A
    task leaves out a set that it has dealt before.
    """
    names = ["bucket", "sets", "counts", "keys"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = _WordHashes().__getitem__
        seen: set[int] = set()
        ids: list[int] = []
        keys: list[np.ndarray] = []
        held = 0

        def deal() -> pa.RecordBatch:
            every = np.concatenate(keys)
            owner = np.repeat(np.array(ids, np.int64), [len(k) for k in keys])
            bucket = (every % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            every, owner, bucket = every[order], owner[order], bucket[order]
            packed = (every >> _U(64 - 8 * KEY_BYTES)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
            ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)) if len(bucket) else []
            rows: list[list] = [[], [], [], []]
            start = 0
            for end in ends:
                own = owner[start:end]
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                counts = np.diff(np.append(first, len(own))).astype("<u4")
                row = (int(bucket[start]), own[first].astype("<i8").tobytes(), counts.tobytes(), packed[start:end].tobytes())
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
                start = end
            ids.clear(), keys.clear()
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

        with np.errstate(over="ignore"):
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    s = shingle_set(text, hash_of, likeness.words)
                    own = set_id(s)
                    if own in seen:
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(own)
                    ids.append(own)
                    keys.append(block_keys(s, likeness))
                    held += len(keys[-1])
                    if held >= DEALT:
                        yield deal()
                        held = 0
            if held:
                yield deal()

    return work


class _Bucket:
    """The holders of the block keys of one bucket, as far as a key has several.

    A bucket that fits is met at once: each key has its smallest and its largest holder, and of
    keys with the same holders one is enough. If a hot key makes it outgrow ``AT_ONCE``, it is met
    in parts, and memory grows with its distinct keys only: a key's hub is its smallest holder
    of the first part that has the key, and of each part at least what differs from the hub is given.
    """

    def __init__(self, number: int):
        self.number, self.held = number, 0
        self.keys: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.hub_keys: np.ndarray | None = None
        self.hubs = np.empty(0, np.int64)

    def add(self, sets: bytes, counts: bytes, keys: bytes) -> None:
        packed = np.frombuffer(keys, np.uint8).reshape(-1, KEY_BYTES)
        wide = np.zeros((len(packed), 8), np.uint8)
        wide[:, :KEY_BYTES] = packed
        self.keys.append(wide.view("<u8").ravel())
        self.ids.append(np.repeat(np.frombuffer(sets, "<i8"), np.frombuffer(counts, "<u4")))
        self.held += len(packed)

    def met(self, last: bool) -> tuple[np.ndarray, ...] | None:
        """``(key, id, low, high)`` of what has been added since the last call."""
        if not self.held:
            return None
        keys, ids = np.concatenate(self.keys), np.concatenate(self.ids)
        self.keys, self.ids, self.held = [], [], 0
        whole = last and self.hub_keys is None
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        if whole:  # single holders have met nobody
            same = keys[1:] == keys[:-1]
            several = np.concatenate((same, [False])) | np.concatenate(([False], same))
            keys, ids = keys[several], ids[several]
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])))[: len(keys)]
        keys, ids = keys[new], ids[new]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
        sizes = np.diff(np.append(starts, len(keys)))
        if not len(starts):
            return None
        low, high = ids[starts], ids[starts + sizes - 1]
        if whole:
            holders = _mixed(ids.view(np.uint64) + _ONE)
            alike = np.add.reduceat(holders, starts) ^ _mixed(np.bitwise_xor.reduceat(holders, starts))
            given = np.zeros(len(starts), bool)
            given[np.unique(alike, return_index=True)[1]] = True
            given &= sizes > 1
        else:
            if self.hub_keys is None:
                self.hub_keys = np.empty(0, np.uint64)
            at = np.searchsorted(self.hub_keys, keys[starts])
            known = np.zeros(len(starts), bool)
            inside = at < len(self.hub_keys)
            known[inside] = self.hub_keys[at[inside]] == keys[starts][inside]
            low = low.copy()
            low[known] = self.hubs[at[known]]
            given = (sizes > 1) | (known & (low != ids[starts]))
            self.hubs = np.insert(self.hubs, at[~known], low[~known])
            self.hub_keys = np.insert(self.hub_keys, at[~known], keys[starts][~known])
            high = low
        every = np.repeat(given, sizes)
        spread = [np.repeat(v, sizes)[every] for v in (low, high)]
        name = (keys[every] | _U(self.number << (8 * KEY_BYTES))).view(np.int64)
        rows = [name, ids[every], *spread]
        if not whole:  # the hub itself may stand in another part
            hubs = [(keys[starts][given] | _U(self.number << (8 * KEY_BYTES))).view(np.int64), *[low[given]] * 3]
            rows = [np.concatenate(pair) for pair in zip(rows, hubs, strict=True)]
        return tuple(rows)


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, id, low, high)`` from the rows of ``_dealer``, bucket by bucket."""
    names = ["key", "id", "low", "high"]

    def given(bucket: _Bucket | None, last: bool) -> Iterator[pa.RecordBatch]:
        rows = bucket.met(last) if bucket else None
        for start in range(0, len(rows[0]) if rows else 0, MET_ROWS):
            part = [pa.array(r[start : start + MET_ROWS], pa.int64()) for r in rows]
            yield pa.RecordBatch.from_arrays(part, names)

    bucket = None
    with np.errstate(over="ignore"):
        for batch in batches:
            for number, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket is None or bucket.number != number:
                    yield from given(bucket, True)
                    bucket = _Bucket(number)
                bucket.add(*packed)
                if bucket.held >= AT_ONCE:
                    yield from given(bucket, False)
        yield from given(bucket, True)


def _met(docs: DataFrame, shingles: int, likeness: Likeness) -> DataFrame:
    """``(key, id, low, high)``: the holders of the block keys that several sets have.

    Keys are shuffled once, packed by bucket; a task sorts the keys of one bucket at a time.
    """
    expected = shingles * 2 * likeness.differ[0] / likeness.differ[1] * BAND * BAND
    buckets = max(int(expected / PER_BUCKET), 1) + 1
    rows = docs.where("text is not null").select(F.col("text").cast("binary").alias("text"))
    dealt = rows.mapInArrow(_dealer(likeness, buckets), "bucket long, sets binary, counts binary, keys binary")
    by_bucket = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return by_bucket.mapInArrow(_meeting, "key long, id long, low long, high long")


def _half(sketch: Column) -> Column:
    """The same sketch in half as many bits."""
    words = (F.size(sketch) / 2).cast("int")
    return F.zip_with(
        F.slice(sketch, F.lit(1), words), F.slice(sketch, words + 1, words), lambda x, y: x.bitwiseXOR(y)
    )


def _may_be_alike(a: str, b: str, likeness: Likeness) -> Column:
    """Sizes and sketches allow it: the sketches' Hamming distance is at most |A xor B|.

    The folded sketches are compared first, which is quick; of pairs that pass, sketches of as many
    bits are, or the half of one that has twice the other's.
    """
    def distance(x: Column, y: Column) -> Column:
        return F.aggregate(
            F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda d, n: d + n
        )

    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    x, y = F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
    folded = sum(
        (F.bit_count(F.col(f"{a}.fold")[i].bitwiseXOR(F.col(f"{b}.fold")[i])) for i in range(LEAST_BITS // 64)),
        F.lit(0),
    )
    apart = (
        F.when((F.size(x) == F.size(y)) & (F.size(x) == LEAST_BITS // 64), 0)  # nothing is folded
        .when(F.size(x) == F.size(y), distance(x, y))
        .when(F.size(x) == 2 * F.size(y), distance(F.col(f"{a}.half"), y))
        .when(F.size(y) == 2 * F.size(x), distance(x, F.col(f"{b}.half")))
        .otherwise(0)
    )
    sizes = F.greatest(n_a, n_b) * likeness.alike[0] <= F.least(n_a, n_b) * likeness.alike[1]
    allowed = (n_a + n_b) * likeness.differ[0]
    return sizes & (folded * likeness.differ[1] <= allowed) & (apart * likeness.differ[1] <= allowed)


def _verifier(likeness: Likeness):
    """The pairs whose shingle sets are alike, by counting what they share."""
    least, whole = likeness.alike

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = _WordHashes().__getitem__
        known: dict[int, np.ndarray] = {}
        held = 0

        def set_of(own: int, text: bytes) -> np.ndarray:
            nonlocal held
            if own not in known:
                if held >= SETS:
                    known.clear()
                    held = 0
                known[own] = shingle_set(text, hash_of, likeness.words)
                held += len(known[own])
            return known[own]

        with np.errstate(over="ignore"):
            for batch in batches:
                alike = []
                for a, b, left, right in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "left", "right")), strict=True):
                    x, y = set_of(a, left), set_of(b, right)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    alike.append(shared * whole >= (len(x) + len(y) - shared) * least)
                yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    return work


def _links(pairs: DataFrame, texts: DataFrame, likeness: Likeness) -> DataFrame:
    """The stored ``pairs`` ``(a, b)`` whose texts have alike sets. Texts are shuffled, as sets are larger."""
    def side(end: str, name: str) -> DataFrame:
        wanted = _may_hold(pairs.select(F.col(end).alias("id")), texts, "id")
        return wanted.select(F.col("id").alias(end), F.col("text").cast("binary").alias(name))

    both = pairs.join(side("a", "left"), "a").join(side("b", "right"), "b")
    return both.select("a", "b", "left", "right").mapInArrow(_verifier(likeness), "a long, b long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``store`` for tables that Python tasks make from texts or packed keys."""
    with python_batches(df.sparkSession, BATCH_BYTES):
        return store(df, name)


def _may_hold(ids: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``rows`` without most whose ``column`` is not among ``ids`` (column ``id``); all others stay.

    The ids set bits of a map of fixed size (``MAP_BITS``, 1 MB), which goes to all tasks, so
    that what an equi-join would drop is dropped before it is shuffled.
    """
    def place(of: str) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(MAP_BITS))

    bits = ids.select(place("id").alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    at = F.bitmap_bit_position(place(column)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    marked = rows.join(F.broadcast(bits), F.bitmap_bucket_number(place(column)) == F.col("part"))
    return marked.where(F.getbit(byte.cast("bigint"), at % 8) == 1).select(*rows.columns)


def similar_documents(
    docs: DataFrame, words: int = SHINGLE_WORDS, alike: tuple[int, int] = ALIKE
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs`` (``doc_id, text``).

    Texts are compared as sets of shingles of ``words`` words (A-Z lower-cased, words split at
    ASCII white space; fewer words are one shingle). With ``alike = (p, q)`` two documents link
    when q times the shared shingles reach p times the united ones. ``component_id`` is the smallest doc_id that links reach.
    Shingles and sets are told apart by 64-bit hashes.

    Null and empty texts have no shingles, link with nothing, and are their own component.
    Rows with a null doc_id link with nothing and have a null component. Repeated rows are
    given back each; rows with one doc_id and different texts each go with their own text.
    Other columns are left out. No document, no row.

    1. One pass over the texts: each document gives its size, a hash of its set and a parity
       sketch. Shingles toggle bits, so the Hamming distance of two sketches is at most the
       number of shingles that differ.
    2. Documents with equal sets are one class from here on.
    3. A second pass gives a key per block of a larger parity sketch, in which (per size band)
       alike sets agree in some block. Keys are packed into buckets, shuffled once, and met bucket
       by bucket (``_Bucket``). Each key's smallest and largest holders are compared with
       the others; what is linked by then needs no more comparing. Only holders of one key
       that are still in different components meet pairwise, and only pairs that size and
       sketch allow leave that join.
    4. Candidate pairs are verified on exact shingle sets, made anew from the texts; components
       come from distributed star contraction.

    Stored tables go when their last reader is done.
    """
    likeness = Likeness(words, alike)
    docs = docs.select("doc_id", "text")
    kind = "n long, id long, sketch array<long>, fold array<long>"
    sketched = _stored(
        map_texts(docs, kind, _sketcher(likeness), ["doc_id"]).select("doc.doc_id", "*").drop("doc"),
        "join-sketches",
    )
    held = sketched.where("n > 0 and doc_id is not null")
    shingles = held.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    met = _stored(_met(docs.where("doc_id is not null"), shingles, likeness), "join-keys")

    classes = held.groupBy("id").agg(F.min("doc_id").alias("first_doc"))
    ids = store(met.select("id").distinct(), "join-ids")
    facts = store(
        held.select("id", "n", "sketch", "fold").join(ids, "id", "left_semi").dropDuplicates(["id"])
        .withColumn("half", _half(F.col("sketch"))), "join-facts"
    )
    readers = store(classes.join(ids, "id", "left_semi"), "join-readers")
    first_texts = _may_hold(readers.select(F.col("first_doc").alias("id")), docs, "doc_id")
    with_text = first_texts.join(readers, F.col("doc_id") == F.col("first_doc")).dropDuplicates(["doc_id", "id", "text"])
    texts = _stored(
        with_text.select("id", F.col("text").cast("binary").alias("text"))
        .mapInArrow(_own_text(likeness), "id long, text binary").select("id", F.col("text").cast("string").alias("text")),
        "join-texts",
    )
    for table in (ids, readers):
        drop_stored(table)

    def verified(pairs: DataFrame, before: DataFrame | None = None) -> DataFrame:
        asked = store(pairs, "join-pairs")
        new = _links(asked, texts, likeness)
        links = _stored(before.union(new) if before else new, "join-links")
        for table in (asked, before):
            if table:
                drop_stored(table)
        return links

    def allowed(pairs: DataFrame) -> DataFrame:
        a, b = facts.alias("fa"), facts.alias("fb")
        return (
            pairs.distinct().join(a, F.col("a") == F.col("fa.id")).join(b, F.col("b") == F.col("fb.id"))
            .where(_may_be_alike("fa", "fb", likeness)).select("a", "b")
        )

    links = verified(allowed(met.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b"))))
    for last in (False, True):
        groups = store(components(links), "join-groups")
        placed = met.join(groups, F.col("id") == F.col("node"), "left").select(
            "key", "id", "low", "high", F.coalesce("component", "id").alias("group")
        )
        open_keys = (
            placed.groupBy("key").agg(F.min("group").alias("g0"), F.max("group").alias("g1"))
            .where("g0 < g1").select("key")
        )
        left = placed.join(open_keys, "key", "left_semi")
        if not last:
            rest = store(left.drop("group"), "join-keys")
            of_high = groups.select(F.col("node").alias("high_node"), F.col("component").alias("high_group"))
            pairs = left.join(of_high, F.col("high") == F.col("high_node"), "left").where(
                F.col("group") != F.coalesce("high_group", "high")
            ).where("id <> high")
            links = verified(allowed(pairs.select(F.col("id").alias("a"), F.col("high").alias("b"))), links)
            drop_stored(met)
            met = rest
        else:
            # Pairs have most of their keys in common, and most of these have one smallest holder.
            by_low = store(
                left.where("id <> low").groupBy("low", "id", "group").agg(F.collect_set("key").alias("keys")),
                "join-lows",
            )
            rows = by_low.join(facts, "id")
            x, y = rows.alias("x"), rows.alias("y")
            pairs = x.join(y, (
                (F.col("x.low") == F.col("y.low")) & (F.col("x.id") < F.col("y.id"))
                & (F.col("x.group") != F.col("y.group")) & _may_be_alike("x", "y", likeness)
                & F.arrays_overlap("x.keys", "y.keys")
            )).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
            links = verified(pairs.distinct(), links)
            drop_stored(by_low)
        drop_stored(groups)
    for table in (met, facts, texts):
        drop_stored(table)

    groups = classes.join(components(links), F.col("id") == F.col("node"), "left").select(
        F.col("id").alias("class"), "first_doc", F.coalesce("component", "id").alias("component")
    )
    groups = store(groups, "join-members")
    least = groups.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    member = groups.join(least, "component").select("class", "component_id")
    found = sketched.select("doc_id", "n", "id").join(
        member, (F.col("id") == F.col("class")) & (F.col("n") > 0) & F.col("doc_id").isNotNull(), "left"
    )
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
