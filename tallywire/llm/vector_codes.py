"""Vector codes: product codebooks over integer parts, with LAESA pivots.

Each component becomes floor(scale * x); a vector is cut into equal consecutive parts, and a part is coded by the nearest
of up to 256 entries of its position's codebook. Entries start as the parts of the vectors with the smallest ids; a round assigns
every part and replaces each used entry by the floored componentwise mean of its parts.

Assignment follows LAESA. A few entries of the first codebook, far from each other, are the pivots and stay the pivots. The distances
of all parts to them are computed once and written beside the parts. In a round only the distances of the entries to the pivots
are new: the largest difference between a part's and an entry's pivot distances bounds their distance from below. The entries
with the smallest bounds are evaluated first, in whole numbers; their best distance then prunes all entries whose bound is
above it, and the rest is evaluated exactly. Equal distances go to the lower index.

A pass over the table is one map; every task gives one sum per entry it used, so a round moves at most
(parts * entries) rows per task, and the driver holds the codebooks alone. Their size does not grow with the table.

Edge cases: rows whose vector is null, or holds null or non-finite components, are left out; so are vectors shorter than the
longest one. The longest must divide into the parts (else ValueError), and components must stay below 2^20 after scaling (so that sums
of squares are whole numbers; else ValueError). Fewer vectors than entries give a smaller codebook. Repeated rows are coded each;
equal ids are ordered by their vectors. Null ids come last. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.text import ship_code, written

ship_code(__name__)

BLOCK = 1024  # vectors coded at a time
MOST = 1 << 20


def whole_vectors(table: DataFrame, vector_col: str, scale: float, name: str = "_vector") -> DataFrame:
    """`table` with the vector as whole numbers, without rows whose vector is null or holds anything but finite numbers."""
    clean = F.forall(vector_col, lambda x: F.coalesce(x.cast("double") - x.cast("double") == 0, F.lit(False)))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return table.where(F.col(vector_col).isNotNull()).where(clean).withColumn(name, whole)


def far_apart(entries: np.ndarray, n: int) -> np.ndarray:
    """Up to n different entries, each as far as possible from those before."""
    chosen, near = [0], ((entries - entries[0]) ** 2).sum(1)
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((entries - entries[chosen[-1]]) ** 2).sum(1))
    return entries[chosen]


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distances of all points to a few others."""
    return np.sqrt(np.stack([((points - x) ** 2).sum(1) for x in to], axis=1).astype(np.float64))


def nearest(points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray, first: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each point's nearest entry."""
    bound = np.abs(to_pivots[:, :1] - entry_pivots[:, 0])
    for k in range(1, entry_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, k : k + 1] - entry_pivots[:, k]), out=bound)
    # differences of rounded roots may come out too large
    bound = np.floor(np.maximum(bound - 1e-6 * (1 + bound), 0) ** 2).astype(np.int64)
    first = min(first, len(entries))
    ahead = np.argpartition(bound, first - 1, axis=1)[:, :first]
    rank = len(entries)
    # distance and index in one number: the least is the nearest, ties by index
    found = ((((points[:, None, :] - entries[ahead]) ** 2).sum(2)) * rank + ahead).min(1)
    open_ = bound <= (found // rank)[:, None]
    np.put_along_axis(open_, ahead, False, axis=1)
    who, which = np.nonzero(open_)
    for start in range(0, len(who), 1 << 18):
        i, k = who[start : start + (1 << 18)], which[start : start + (1 << 18)]
        exact = ((points[i] - entries[k]) ** 2).sum(1) * rank + k
        np.minimum.at(found, i, exact)
    return found % rank, found // rank


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.int64).reshape(len(rows), -1) if rows else np.empty((0, 0), np.int64)


def _with_pivots(pivots: list[np.ndarray], size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, label, vector) -> (id, label, whole numbers as bytes, distances to the pivots of each part as bytes)"""
        for batch in batches:
            n = batch.num_rows
            points = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, size)
            points = points.astype(np.int64)
            parts = np.split(points, len(pivots), axis=1)
            far = np.concatenate([distances(x, p) for x, p in zip(parts, pivots)], axis=1)
            columns = [pa.array([r.tobytes() for r in points], pa.binary()), pa.array([r.tobytes() for r in far], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["_id", "_label", "_points", "_far"])

    return work


class _Coder:
    """Codes batches of (points, distances to the pivots) with one state of the codebooks."""

    def __init__(self, books: list[np.ndarray], pivots: list[np.ndarray]):
        self.books, self.ends = books, np.cumsum([len(p) for p in pivots])[:-1]
        self.entry_pivots = [distances(b, p) for b, p in zip(books, pivots)]

    def blocks(self, points: pa.Array, far: pa.Array) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        """Parts, indexes and squared distances (a column per part) of some vectors after the other."""
        for start in range(0, len(points), BLOCK):
            parts = np.split(_matrix(points.slice(start, BLOCK)), len(self.books), axis=1)
            to_pivots = np.split(_matrix(far.slice(start, BLOCK)).view(np.float64), self.ends, axis=1)
            got = [nearest(x, f, b, e) for x, f, b, e in zip(parts, to_pivots, self.books, self.entry_pivots)]
            yield parts, np.stack([g[0] for g in got], axis=1), np.stack([g[1] for g in got], axis=1)


def _summing(books: list[np.ndarray], pivots: list[np.ndarray]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(points, distances) -> (part, entry, number of its parts, their sum), once per task"""
        coder = _Coder(books, pivots)
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for parts, index, _ in coder.blocks(batch.column(0), batch.column(1)):
                for k, part in enumerate(parts):
                    counts[k] += np.bincount(index[:, k], minlength=len(books[k]))
                    np.add.at(sums[k], index[:, k], part)
        rows = [(k, e, int(counts[k][e]), sums[k][e].tolist()) for k in range(len(books)) for e in np.nonzero(counts[k])[0].tolist()]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))]
        yield pa.RecordBatch.from_arrays(columns, ["_part", "_entry", "_count", "_sum"])

    return work


def _coding(books: list[np.ndarray], pivots: list[np.ndarray]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, label, points, distances) -> (id, label, code, error)"""
        coder = _Coder(books, pivots)
        for batch in batches:
            codes, errors = [], []
            for _, index, squared in coder.blocks(batch.column(2), batch.column(3)):
                codes += [row.tobytes().hex() for row in index.astype(np.uint8)]
                errors.append(squared.sum(1))
            columns = [pa.array(codes, pa.string()), pa.array(np.concatenate(errors) if errors else [], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["_id", "_label", "_code", "_error"])

    return work


def improved(table: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks after one round. Tasks pre-aggregate; the driver gets a row per used entry."""
    sums = table.select("_points", "_far").mapInArrow(_summing(books, pivots), "_part int, _entry int, _count long, _sum array<long>")
    wide = F.posexplode("_sum").alias("_k", "_x")
    flat = sums.select("_part", "_entry", "_count", wide).groupBy("_part", "_entry", "_k").agg(F.sum("_x").alias("_x"), F.sum("_count").alias("_n"))
    # a row per used entry and component: bounded by the size of the codebooks
    books = [b.copy() for b in books]
    for r in flat.collect():
        books[r["_part"]][r["_entry"], r["_k"]] = r["_x"] // r["_n"]
    return books


def codebook_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: float = 1024.0,
    n_pivots: int = 6,
) -> tuple[DataFrame, list[np.ndarray]]:
    """_id, _label, code (two hex digits a part), error and label_error (error over rows of the label, nulls together); the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part")
    cols = table.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).alias("_raw"))
    clean = whole_vectors(cols, "_raw", scale).select("_id", "_label", "_vector")
    largest = F.max(F.array_max(F.transform("_vector", F.abs)))
    size, most = clean.agg(F.coalesce(F.max(F.size("_vector")), F.lit(0)), F.coalesce(largest, F.lit(0))).first()
    if most > MOST:
        raise ValueError(f"components beyond {MOST} after scaling")
    if size % parts:
        raise ValueError(f"vectors of {size} components do not divide into {parts} parts")
    clean = clean.where(F.size("_vector") == size) if size else clean.where(F.lit(False))
    start = clean.orderBy(F.col("_id").asc_nulls_last(), "_vector").limit(entries).collect()
    books = np.split(np.array([r["_vector"] for r in start], np.int64).reshape(len(start), size), parts, axis=1)
    pivots = [far_apart(b, n_pivots) if len(b) else b for b in books]
    kinds = {f.name: f.dataType.simpleString() for f in clean.schema.fields}
    keys = f"_id {kinds['_id']}, _label {kinds['_label']}"
    ready = written(clean.mapInArrow(_with_pivots(pivots, size), f"{keys}, _points binary, _far binary"), "pivot-distances")
    for _ in range(rounds if len(start) else 0):
        books = improved(ready, books, pivots)
    coded = written(ready.mapInArrow(_coding(books, pivots), f"{keys}, code string, error long"), "codes") if len(start) else ready.select(
        "_id", "_label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")
    )
    by_label = coded.groupBy(F.col("_label").alias("_l")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("_label").eqNullSafe(F.col("_l")), "left").drop("_l"), books
