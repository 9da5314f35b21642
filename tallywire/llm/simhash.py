"""SimHash near-dedup with Golay-code keys.

A fingerprint has 64 bits: the majority of the XXH64 values of a text's word shingles. Two fingerprints link if at most
two bits differ. Candidates come from the perfect binary Golay code of length 23: every 23-bit word lies within three
bits of exactly one of 4096 codewords. Decoding a word and its 23 one-bit neighbours gives the codewords within four
bits, one or six of them, and two words that differ in at most two bits share one: the word halfway between them
has a codeword within three bits, which is within four bits of both.

The fingerprint is cut into segments of 22, 21 and 21 bits. Two errors leave one of three segments free of errors, and
the next segment has at most two, so the pair meets under (free segment, Golay index of the next): up to 18 keys a
fingerprint, each telling 2^33 cases apart. Joined pairs are verified by counting the differing bits.

Only distinct fingerprints are joined, so copies cost nothing, and no group is expanded into pairs: a key that more
than `max_bucket` fingerprints share goes another exact way. Its fingerprints emit their 64 one-bit neighbours and
themselves; two of them within two bits share such a value, all fingerprints at one value are within two bits of each
other, and a value has at most 65 of them, each linked to the smallest. This loses no link that components need.

Edge cases: texts without words (also null ones) have fingerprint zero and link like others. A text with fewer words
than a shingle is one shingle. Rows of one id are separate members; null ids take part and never are the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.llm.components import components
from tallywire.llm.text import lower_ascii, ship_code, words_of, written

ship_code(__name__)

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and length
#: generator polynomial of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value)
GOLAY = 0b101011100011


def shingle_hashes(text: Column, shingle: int) -> Column:
    """XXH64 (seed 42) of every run of `shingle` words; the words are joined by one blank."""
    words = words_of(lower_ascii(F.coalesce(text, F.lit(""))))

    def at(i: Column, words: Column) -> Column:
        return F.xxhash64(F.concat_ws(" ", *[F.get(words, i + k) for k in range(shingle)]))

    # the struct keeps the words in one column: they are split once and read by position
    return F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
        .when(F.size(w) <= shingle, F.array(F.xxhash64(F.array_join(w, " "))))
        .otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - shingle), lambda i: at(i, w))),
    )[0]


_BIT = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the values, as a signed 64-bit number."""
    counts = np.zeros((8, 256), np.int64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start : start + 65536].view(np.uint8).reshape(-1, 8)
        place = part.astype(np.int32) + (np.arange(8, dtype=np.int32) << 8)
        counts += np.bincount(place.ravel(), minlength=2048).reshape(8, 256)
    bits = (counts @ _BIT).ravel() * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def _with_print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, list of hashes) -> (id, fingerprint)."""
    for batch in batches:
        lists = batch.column(1)
        values, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        ends = ends - ends[0]
        prints = [majority(values[i:j]) for i, j in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["_id", "_print"])


def _remainder(words: np.ndarray) -> np.ndarray:
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, GOLAY << (bit - 11), 0)
    return words


def _error_table() -> np.ndarray:
    """Error pattern (up to three bits) of each of the 2048 remainders; the code is perfect, so each has one."""
    single = 1 << np.arange(23)
    two = (single[:, None] | single).ravel()
    errors = np.unique(np.concatenate([[0], (two[:, None] | single).ravel()]))
    table = np.zeros(2048, np.int64)
    table[_remainder(errors)] = errors
    return table


ERRORS = _error_table()


def golay_indices(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords within four bits of each 23-bit word: 24 columns, repeats included."""
    near = words[:, None] ^ np.concatenate([[0], 1 << np.arange(23)])
    return (near ^ ERRORS[_remainder(near)]) >> 11


def golay_keys(prints: np.ndarray) -> np.ndarray:
    """72 keys of each fingerprint, repeats included: free segment, index of the next one, which segment is free."""
    bits = prints.view(np.uint64)
    part = [((bits >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    return np.concatenate(
        [(part[k][:, None] << 12 | golay_indices(part[(k + 1) % 3])) * 3 + k for k in range(3)], axis=1
    )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fingerprint) -> (fingerprint, key), each key of a fingerprint once."""
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        keys = np.sort(golay_keys(prints), axis=1)
        first = np.ones(keys.shape, bool)
        first[:, 1:] = keys[:, 1:] != keys[:, :-1]
        row, _ = np.nonzero(first)
        yield pa.RecordBatch.from_arrays([pa.array(prints[row]), pa.array(keys[first])], ["_print", "_key"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """_id, _print: one row per row of `docs`, written once."""
    hashes = shingle_hashes(F.col(text_col), shingle)
    kind = docs.schema[id_col].dataType.simpleString()
    hashed = docs.select(F.col(id_col).alias("_id"), hashes.alias("_hashes"))
    return written(hashed.mapInArrow(_with_print, f"_id {kind}, _print long"), "fingerprints")


def linked_prints(prints: DataFrame, max_bucket: int = 256, max_bits: int = 2) -> DataFrame:
    """Pairs a < b of distinct fingerprints within two bits: all of them, or enough to connect the same ones."""
    if max_bits > 2:
        raise ValueError("the keys are made for two differing bits")
    distinct = prints.select("_print").distinct()
    keyed = written(distinct.mapInArrow(_keyed, "_print long, _key long"), "golay-keys")
    counts = keyed.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1")
    small = counts.where(F.col("_n") <= max_bucket).select("_key")
    left = keyed.join(small, "_key").select("_key", F.col("_print").alias("a"))
    right = keyed.select("_key", F.col("_print").alias("b"))
    pairs = left.join(right, "_key").where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    pairs = pairs.select("a", "b").distinct()

    large = written(counts.where(F.col("_n") > max_bucket).select("_key"), "large-buckets")
    crowded = keyed.join(large, "_key", "left_semi").select("_print").distinct()
    masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    spread = crowded.withColumn("_value", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("_print")))))
    meets = spread.groupBy("_value").agg(F.min("_print").alias("a"), F.collect_set("_print").alias("_all")).where(F.size("_all") > 1)
    stars = meets.select("a", F.explode("_all").alias("b")).where("a < b").distinct()
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bucket: int = 256) -> DataFrame:
    """_id, _print (signed) and component: the smallest id among all rows reachable over links; null if all are null."""
    rows = fingerprints(docs, id_col, text_col, shingle)
    return with_component(rows, linked_prints(rows, max_bucket))


def with_component(rows: DataFrame, links: DataFrame) -> DataFrame:
    """_id, _print and component of `rows` (_id, _print) whose prints are linked by a, b."""
    group = components(links, "a", "b")
    # one row per distinct fingerprint: its smallest id and its component of fingerprints
    first = rows.groupBy("_print").agg(F.min("_id").alias("_first"))
    placed = first.join(group, F.col("_print") == F.col("node"), "left").select(
        F.col("_print").alias("_p"), "_first", F.coalesce("component", "_print").alias("_c")
    )
    placed = written(placed, "print-groups")
    lowest = placed.groupBy("_c").agg(F.min("_first").alias("component"))
    named = written(placed.join(lowest, "_c").select("_p", "component"), "print-components")
    return rows.join(named, F.col("_print") == F.col("_p")).select("_id", "_print", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """`docs` with one document, the smallest id, of every group. Rows without an id stay.

    Rows that repeat the kept id all stay: they cannot be told apart by it.
    """
    return drop_losers(docs, near_duplicates(docs, id_col, text_col, **how), id_col)


def drop_losers(docs: DataFrame, classes: DataFrame, id_col: str) -> DataFrame:
    """`docs` without the rows of `classes` whose id is not the smallest of their group."""
    losers = classes.where(F.col("_id") != F.col("component")).select(F.col("_id").alias("_lost")).distinct()
    losers = written(losers, "near-copies")
    return docs.join(losers, docs[id_col] == losers["_lost"], "left_anti")
