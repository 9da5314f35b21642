"""Benchmark decontamination: short test items inside long documents by size-partitioned MinHash containment search.

Texts become sets of shingles of five words. Items are partitioned by size: a class takes the items with more than c / 2
and at most c shingle places, c a power of two. For a class every document is cut into windows of 2c places, each
starting c after the one before, so a passage of an item's length lies whole in one window, and an item that is
contained to `threshold` in it has a Jaccard similarity with the window of at least
threshold / 2 / (1/2 + 2 - threshold / 2), 0.19 for 0.8, however long the document is. The number of MinHash values follows
from this bound: single values are the bands, and the chance to miss such a pair in all of them is at most `miss`.
Minima of a large window are minima of the smallest class' blocks, so all classes share one pass over the hashes.

Candidates are verified by the exact share of the item's distinct shingles in the whole document.

Items are taken to the executors in blocks of at most `block_shingles` shingles; each block is one pass over the
documents, so nothing that grows with the benchmark is held at once. Documents are not shuffled.

Edge cases: null and empty texts match nothing; items with fewer words than a shingle are too short to tell a leak from
chance and match nothing. Repeated rows of one id give one row with the best share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.llm.licenses import license_words
from tallywire.llm.text import once_per_worker, ship_code, written

ship_code(__name__)

BATCH_SHINGLES = 1_000_000


def word_hashes(text: Column) -> Column:
    """XXH64 of the words (letters, digits and characters beyond ASCII, A to Z lower-cased)."""
    return F.transform(license_words(text), lambda w: F.xxhash64(w))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words; `words` are unsigned hashes of words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = _mixed(total + words[k : k + n])
    return total


def _odd(count: int) -> np.ndarray:
    """Odd multipliers: each permutes the 64-bit numbers."""
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def bands_for(threshold: float, miss: float) -> int:
    share = threshold / 2
    least = share / (0.5 + 2 - share)
    return math.ceil(math.log(miss) / math.log(1 - least))


class Items:
    """A block of items: shingle sets, and by class and MinHash value the sorted minima of its items."""

    def __init__(self, ids: list, words: list[np.ndarray], shingle: int, threshold: float, miss: float):
        self.shingle, self.threshold = shingle, threshold
        self.multipliers = _odd(bands_for(threshold, miss))
        self.ids, self.sets = [], []
        sizes = []
        for key, own in zip(ids, words):
            places = shingles_of(own, shingle)
            if len(places):
                self.ids.append(key)
                self.sets.append(np.unique(places))
                sizes.append(1 << (len(places) - 1).bit_length())
        self.classes = sorted(set(sizes))
        self.mask = np.uint64((1 << min(22, max(14, len(self.ids).bit_length() + 7))) - 1)
        self.tables = {}
        for c in self.classes:
            members = np.array([i for i, s in enumerate(sizes) if s == c])
            for k, a in enumerate(self.multipliers):
                low = np.array([(self.sets[i] * a).min() for i in members])
                order = np.argsort(low, kind="stable")
                hint = np.zeros(int(self.mask) + 1, bool)
                hint[(low & self.mask).astype(np.int64)] = True
                self.tables[c, k] = (low[order], members[order], hint)


def _lookup(table: tuple, low: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Places in `low` and items with the same minimum."""
    known, members, hint = table
    at = np.flatnonzero(hint[(low & mask).astype(np.int64)])
    first, last = np.searchsorted(known, low[at], "left"), np.searchsorted(known, low[at], "right")
    count = last - first
    at, first, count = at[count > 0], first[count > 0], count[count > 0]
    steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(at, count), members[np.repeat(first, count) + steps]


def search(items: Items, docs: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """(document, item, shared shingles) of all pairs at the threshold; `docs` are arrays of shingle hashes."""
    sizes = np.array([len(d) for d in docs])
    values = np.concatenate(docs) if len(docs) else np.empty(0, np.uint64)
    if not len(values) or not items.ids:
        return []
    unit = items.classes[0]
    starts = np.cumsum(sizes) - sizes
    levels = {}  # class -> (start of each block in the blocks below, document of each block)
    blocks = -(-sizes // unit)
    owner = np.repeat(np.arange(len(docs)), blocks)
    number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    base = starts[owner] + number * unit
    size = unit
    levels[size] = (None, owner)
    while size < items.classes[-1]:
        pair = np.flatnonzero(number % 2 == 0)
        owner, number, size = owner[pair], number[pair] // 2, size * 2
        levels[size] = (pair, owner)
    found = set()
    for k, a in enumerate(items.multipliers):
        low = np.minimum.reduceat(values * a, base)
        for size, (pair, owner) in levels.items():
            if pair is not None:
                low = np.minimum.reduceat(low, pair)
            if size not in items.classes:
                continue
            window = low.copy()
            joined = owner[1:] == owner[:-1]
            window[:-1][joined] = np.minimum(low[:-1], low[1:])[joined]
            at, item = _lookup(items.tables[size, k], window, items.mask)
            found.update(zip(owner[at].tolist(), item.tolist()))
    out = []
    held_by, held = -1, None
    for doc, item in sorted(found):
        if doc != held_by:
            held_by, held = doc, np.unique(docs[doc])
        own = items.sets[item]
        place = np.minimum(np.searchsorted(held, own), len(held) - 1)
        shared = int((held[place] == own).sum())
        if shared >= items.threshold * len(own) - 1e-9:
            out.append((doc, item, shared))
    return out


def _searching(shared, id_type: pa.DataType, item_type: pa.DataType):
    def rows(ids: list, docs: list[np.ndarray], items: Items) -> pa.RecordBatch:
        hits = search(items, docs)
        columns = [
            pa.array([ids[d] for d, _, _ in hits], id_type),
            pa.array([items.ids[i] for _, i, _ in hits], item_type),
            pa.array([len(items.sets[i]) for _, i, _ in hits], pa.int64()),
            pa.array([n for *_, n in hits], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["_id", "_item", "n_shingles", "n_shared"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = once_per_worker(shared, Items)
        for batch in batches:
            lists, ids = batch.column(1), batch.column(0).to_pylist()
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            words = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            names, docs, total = [], [], 0
            for i, key in enumerate(ids):
                places = shingles_of(words[ends[i] : ends[i + 1]], items.shingle)
                if len(places):
                    names.append(key)
                    docs.append(places)
                    total += len(places)
                if total >= BATCH_SHINGLES:
                    yield rows(names, docs, items)
                    names, docs, total = [], [], 0
            if docs:
                yield rows(names, docs, items)

    return work


def _blocks(items: DataFrame, item_col: str, text_col: str, block_shingles: int) -> Iterator[tuple[list, list]]:
    """Items in blocks; rows come to the driver one partition after the other."""
    ids, words, total = [], [], 0
    for row in items.select(F.col(item_col).alias("i"), word_hashes(F.col(text_col)).alias("w")).toLocalIterator():
        ids.append(row["i"])
        words.append(np.array(row["w"], np.int64).view(np.uint64))
        total += len(row["w"])
        if total >= block_shingles:
            yield ids, words
            ids, words, total = [], [], 0
    yield ids, words


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    miss: float = 1e-6,
    block_shingles: int = 2_000_000,
) -> DataFrame:
    """_id, _item, n_shingles (of the item), n_shared: all pairs whose containment reaches the threshold."""
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    rows = docs.select(F.col(id_col).alias("_id"), word_hashes(F.col(text_col)).alias("_words"))
    schema = f"_id {kinds[0].simpleString()}, _item {kinds[1].simpleString()}, n_shingles long, n_shared long"
    arrow = [pa.int64() if k.simpleString() == "bigint" else pa.int32() if k.simpleString() == "int" else pa.string() for k in kinds]
    found = spark.createDataFrame([], schema)
    for ids, words in _blocks(benchmark, item_col, item_text_col, block_shingles):
        if any(len(w) >= shingle for w in words):
            shared = spark.sparkContext.broadcast({"args": (ids, words, shingle, threshold, miss)})
            found = found.unionByName(rows.mapInArrow(_searching(shared, *arrow), schema))
    return found.groupBy("_id", "_item").agg(F.max("n_shingles").alias("n_shingles"), F.max("n_shared").alias("n_shared"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """`docs` without documents that hold a benchmark item. Rows without an id stay."""
    leaks = written(find_leaks(docs, benchmark, id_col, **how).select(F.col("_id").alias("_leak")).distinct(), "leaks")
    return docs.join(leaks, docs[id_col] == leaks["_leak"], "left_anti")
