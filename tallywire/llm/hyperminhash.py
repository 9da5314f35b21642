"""MinHash near-dedup with HyperMinHash registers.

A text is the set of its distinct runs of `shingle` words (64-bit hashes). Its sketch has `bands` x `rows` buckets. A bucket
keeps the least hash that falls into it, compressed to 16 bits: how many leading zeros the hash has (5 bits), the 8 bits
behind them (mantissa) and 3 bits for the round. One round deals all hashes of the set to the buckets; while buckets are
empty, another round deals them anew with another hash, so that sets of any size fill all buckets and a bucket of two sets
agrees with the chance of their Jaccard similarity.

1. Each band of registers is a key. A pair at the threshold shares none of them with a chance below (1 - t^rows)^bands,
   1e-6 for 0.8; unlike texts rarely meet.
2. Every set is compared with one set of each of its keys, the one that meets most others, so that a group's middle links most of it. The similarity estimated from registers, corrected
   for registers that agree by chance, drops pairs that lie six standard deviations below the threshold. The rest is verified on the
   full sets. Linked sets form components.
3. Only keys whose sets are in several components go on. Keys with up to `max_bucket` sets give their pairs of
   different components. The sets of larger keys meet in an exact prefix join instead: sets at the threshold share one of their
   rarest hashes, the place of which bounds what they can share at all. At a hash only the sets outside its largest component
   are joined with the others, so a group of copies stays linear. These pairs are estimated and verified as before.

So no link is lost in a large key, no group is expanded into all its pairs, and the number of steps is fixed. Equal sets are one row in
all joins. A link is 100 * intersection >= percent * union, in whole numbers.

Edge cases: texts without words (also null ones) are empty sets and link with nothing. With fewer words than a shingle the
whole sequence is the one element. Rows of one id are separate members; null ids take part and never are the smallest; the
component is null if all its ids are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.llm.components import components
from tallywire.llm.simhash import shingle_hashes, with_component
from tallywire.llm.text import ship_code, written

ship_code(__name__)

MANTISSA, ZEROS, ROUNDS = 8, 5, 3  # bits of a register
FULL = np.uint64(2**64 - 1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Another 64-bit hash of 64-bit hashes."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def least_hashes(values: np.ndarray, buckets: int) -> np.ndarray:
    """Round and 32-bit hash of the first and least value in each bucket; `values` are distinct and not empty."""
    best = np.full(buckets, FULL)
    start, at_once = 0, max(1, 2048 // len(values))
    while True:
        turns = np.arange(start, start + at_once, dtype=np.uint64)
        dealt = mixed(values ^ mixed(turns + np.uint64(1))[:, None])
        bucket = (dealt >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        value = turns[:, None] << np.uint64(32) | dealt & np.uint64(0xFFFFFFFF)
        np.minimum.at(best, bucket.ravel().astype(np.int64), value.ravel())
        if best.max() < FULL:
            return best
        start += at_once


def compressed(best: np.ndarray) -> np.ndarray:
    """Registers: round, leading zeros and the bits behind them."""
    turn = np.minimum(best >> np.uint64(32), np.uint64(2**ROUNDS - 1))
    low = (best & np.uint64(0xFFFFFFFF)).astype(np.float64)
    part, power = np.frexp(low)  # low = part * 2^power with part from 0.5
    zeros = np.minimum(32 - power, 2**ZEROS - 1).astype(np.uint64)
    mantissa = ((part * 2 - 1).clip(0) * 2**MANTISSA).astype(np.uint64)
    return (turn << np.uint64(MANTISSA + ZEROS) | zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)


def chance(sizes_a: np.ndarray, sizes_b: np.ndarray, buckets: int) -> np.ndarray:
    """Share of buckets that agree though their hashes differ, for sets of these sizes."""
    a, b = np.asarray(sizes_a, float)[:, None] / buckets, np.asarray(sizes_b, float)[:, None] / buckets
    at = 0.75 * 0.5 ** np.arange(2**ZEROS)  # the middle of the hashes with so many leading zeros
    width = 0.5 ** (np.arange(2**ZEROS) + 1 + MANTISSA)
    filled_a, filled_b = -np.expm1(-a), -np.expm1(-b)
    dense_a, dense_b = a * np.exp(-a * at) / filled_a, b * np.exp(-b * at) / filled_b
    same_cell = (2**MANTISSA * dense_a * dense_b * width**2).sum(1)
    turns = np.arange(2**ROUNDS - 1)
    same_turn = (np.exp(-(a + b) * turns) * filled_a * filled_b).sum(1) + np.exp(-(a + b) * len(turns))[:, 0]
    return np.minimum(same_cell * same_turn, 0.5)


def estimate(registers_a: np.ndarray, registers_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers (a row per pair), corrected for those that agree by chance."""
    agree = (registers_a == registers_b).mean(axis=1)
    by_chance = chance(sizes_a, sizes_b, registers_a.shape[1])
    return (agree - by_chance) / (1 - by_chance)


def _sets(lists: pa.Array) -> Iterator[np.ndarray]:
    values, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    ends = ends - ends[0]
    for i, j in zip(ends[:-1], ends[1:]):
        yield np.unique(values[i:j].astype(np.int64).view(np.uint64))


def _digest(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _sketching(buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, row, hashes) -> (id, row, digest of the set, its size, registers)"""
        for batch in batches:
            sets = list(_sets(batch.column(2)))
            registers = [compressed(least_hashes(s, buckets)).tobytes() if len(s) else None for s in sets]
            columns = [
                batch.column(0), batch.column(1), pa.array(map(_digest, sets), pa.binary()),
                pa.array(map(len, sets), pa.int64()), pa.array(registers, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_row", "_digest", "_n", "_registers"])

    return work


def _banding(bands: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, registers) -> (node, key) for each band"""
        for batch in batches:
            registers = _matrix(batch.column(1)).reshape(-1, bands, rows).astype(np.uint64)
            keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), registers.shape[:2])
            for k in range(rows):
                keys = mixed(keys + registers[:, :, k])
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands)
            columns = [pa.array(nodes, pa.int64()), pa.array(keys.view(np.int64).ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["_node", "_key"])

    return work


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint16).reshape(len(rows), -1 if rows else 0)


def _estimating(least: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(a, b, registers and sizes of both) -> the pairs estimated at `least` or more"""
        for batch in batches:
            if batch.num_rows:
                sizes = [batch.column(k).to_numpy(zero_copy_only=False) for k in (4, 5)]
                found = estimate(_matrix(batch.column(2)), _matrix(batch.column(3)), *sizes) >= least
                yield batch.select(["a", "b"]).filter(pa.array(found))

    return work


def _with_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hashes) -> (digest, set)"""
    for batch in batches:
        sets = list(_sets(batch.column(0)))
        columns = [pa.array(map(_digest, sets), pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["_digest", "_set"])


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, buckets: int) -> DataFrame:
    """_id, _row, _digest, _n, _registers: one row per row of `docs`, written once. _row finds the text of a set again."""
    row = F.when(F.col(id_col).isNull(), F.xxhash64(text_col, F.lit(1))).otherwise(F.xxhash64(id_col))
    kind = docs.schema[id_col].dataType.simpleString()
    hashed = docs.select(F.col(id_col).alias("_id"), row.alias("_row"), shingle_hashes(F.col(text_col), shingle).alias("_hashes"))
    schema = f"_id {kind}, _row long, _digest binary, _n long, _registers binary"
    return written(hashed.mapInArrow(_sketching(buckets), schema), "sketches")


class _Linker:
    """Estimates and verifies pairs of nodes; a node is one distinct set."""

    def __init__(self, nodes: DataFrame, percent: int, buckets: int):
        self.nodes, self.percent = nodes, percent
        share = percent / 100
        self.least = share - 6 * (share * (1 - share) / buckets) ** 0.5

    def read_sets(self, docs: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle: int) -> None:
        """The full sets of all nodes that share a key; their texts are read again, no other ones."""
        wanted = self.nodes.join(members.select("_node").distinct(), "_node", "left_semi").select("_node", "_digest", "_row")
        wanted = written(wanted, "wanted-sets")
        row = F.when(F.col(id_col).isNull(), F.xxhash64(text_col, F.lit(1))).otherwise(F.xxhash64(id_col))
        texts = docs.select(row.alias("_row"), F.col(text_col).alias("_text")).join(wanted.select("_row").distinct(), "_row", "left_semi")
        found = texts.select(shingle_hashes(F.col("_text"), shingle).alias("_hashes")).mapInArrow(_with_set, "_digest binary, _set array<long>")
        found = found.join(wanted.select("_digest", "_node"), "_digest").dropDuplicates(["_node"])
        self.sets = written(found.select("_node", "_set"), "full-sets")

    def linked(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of the distinct pairs a, b that are at the threshold."""
        sketch = lambda x: self.nodes.select(F.col("_node").alias(x), F.col("_registers").alias(f"_r{x}"), F.col("_n").alias(f"_n{x}"))
        both = pairs.join(sketch("a"), "a").join(sketch("b"), "b").select("a", "b", "_ra", "_rb", "_na", "_nb")
        likely = written(both.mapInArrow(_estimating(self.least), "a long, b long"), f"{name}-likely")
        full = lambda x: self.sets.select(F.col("_node").alias(x), F.col("_set").alias(f"_s{x}"))
        checked = likely.join(full("a"), "a").join(full("b"), "b")
        shared = F.size(F.array_intersect("_sa", "_sb"))
        return written(checked.where(100 * shared >= self.percent * (F.size("_sa") + F.size("_sb") - shared)).select("a", "b"), f"{name}-links")

    def rare_pairs(self, crowd: DataFrame) -> DataFrame:
        """Pairs of `crowd` (_node, _c) of different components that may reach the threshold by their rarest hashes."""
        p = self.percent
        tokens = crowd.join(self.sets, "_node").select("_node", "_c", F.size("_set").alias("_n"), F.explode("_set").alias("_s"))
        often = tokens.groupBy("_s").agg(F.count("*").alias("_df")).where("_df > 1")
        # hashes that stand in one set only come first and find nothing, so their number suffices
        ranked = tokens.join(often, "_s").groupBy("_node", "_c", "_n").agg(F.array_sort(F.collect_list(F.struct("_df", "_s"))).alias("_list"))
        alone = F.col("_n") - F.size("_list")
        placed = ranked.select("_node", "_c", "_n", alone.alias("_alone"), F.posexplode("_list").alias("_k", "_x"))
        place = F.col("_alone") + F.col("_k")
        prefix = F.col("_n") - F.ceil(F.lit(p) * F.col("_n") / 100) + 1
        keyed = placed.where(place < prefix).select("_node", "_c", "_n", place.alias("_place"), F.col("_x._s").alias("_s"))
        keyed = written(keyed, "rare-hashes")
        sizes = keyed.groupBy("_s", "_c").agg(F.count("*").alias("_m"))
        main = sizes.groupBy("_s").agg(F.max(F.struct("_m", "_c"))["_c"].alias("_main"), F.count("*").alias("_parts")).where("_parts > 1")
        left = keyed.join(main, "_s").where(F.col("_c") != F.col("_main")).alias("l")
        left_n, right_n = F.col("l._n"), F.col("r._n")
        still = F.least(left_n - F.col("l._place"), right_n - F.col("r._place"))
        met = left.join(
            keyed.alias("r"),
            (F.col("l._s") == F.col("r._s"))
            & (F.col("l._c") != F.col("r._c"))
            & (100 * F.least(left_n, right_n) >= p * F.greatest(left_n, right_n))
            & (still * (100 + p) >= p * (left_n + right_n)),
        )
        return met.select(F.least("l._node", "r._node").alias("a"), F.greatest("l._node", "r._node").alias("b")).distinct()


def key_members(keyed: DataFrame) -> DataFrame:
    """_key, _node of the keys that several nodes share, with the _size of the key and how often the node meets others (_meets)."""
    shared = keyed.groupBy("_key").agg(F.count("*").alias("_size")).where("_size > 1")
    members = written(keyed.join(shared, "_key"), "shared-keys")
    meets = members.groupBy("_node").agg(F.sum("_size").alias("_meets"))
    return written(members.join(meets, "_node").select("_key", "_node", "_size", "_meets"), "key-members")


def _stars(members: DataFrame) -> DataFrame:
    """Pairs of every node with the node of its key that meets most others: the middle of a group is the same for many keys."""
    middle = members.groupBy("_key").agg(F.max(F.struct("_meets", "_node"))["_node"].alias("_middle"))
    met = members.join(middle, "_key").where(F.col("_node") != F.col("_middle"))
    return met.select(F.least("_node", "_middle").alias("a"), F.greatest("_node", "_middle").alias("b")).distinct()


def _apart(members: DataFrame, links: DataFrame) -> DataFrame:
    """`members` of the keys whose nodes are in several components, with the component _c."""
    group = components(links, "a", "b").select(F.col("node").alias("_node"), F.col("component").alias("_group"))
    placed = members.join(group, "_node", "left").select("_key", "_node", "_size", F.coalesce("_group", "_node").alias("_c"))
    placed = written(placed, "placed-members")
    several = placed.groupBy("_key").agg(F.min("_c").alias("_low"), F.max("_c").alias("_high")).where("_low < _high")
    return written(placed.join(several.select("_key"), "_key"), "open-members")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    percent: int = 80,
    bands: int = 35,
    rows: int = 5,
    max_bucket: int = 8,
) -> DataFrame:
    """_id, _n (elements of the set) and component: the smallest id among all rows reachable over links."""
    buckets = bands * rows
    drawn = sketches(docs, id_col, text_col, shingle, buckets)
    nodes = drawn.where("_n > 0").groupBy("_digest").agg(F.min("_row").alias("_row"), F.first("_n").alias("_n"), F.first("_registers").alias("_registers"))
    nodes = written(nodes.withColumn("_node", F.monotonically_increasing_id()), "distinct-sets")
    # smaller sets reach the threshold only with equal ones
    able = nodes.where(F.col("_n") * 100 >= percent * (F.col("_n") + 1)).select("_node", "_registers")
    keyed = written(able.mapInArrow(_banding(bands, rows), "_node long, _key long"), "band-keys")
    members = key_members(keyed)

    linker = _Linker(nodes, percent, buckets)
    linker.read_sets(docs, members, id_col, text_col, shingle)
    links = linker.linked(_stars(members), "star")
    rest = _apart(members, links)
    few = rest.where(F.col("_size") <= max_bucket).alias("l")
    cross = few.join(few.alias("r"), (F.col("l._key") == F.col("r._key")) & (F.col("l._node") < F.col("r._node")) & (F.col("l._c") != F.col("r._c")))
    cross = cross.select(F.col("l._node").alias("a"), F.col("r._node").alias("b"))
    crowd = rest.where(F.col("_size") > max_bucket).select("_node", "_c").distinct()
    links = links.unionByName(linker.linked(cross.unionByName(linker.rare_pairs(crowd)).distinct(), "rest"))

    named = drawn.where("_n > 0").join(nodes.select("_digest", "_node"), "_digest").select("_id", "_n", F.col("_node").alias("_print"))
    named = written(named, "named-sets")
    found = with_component(named.select("_id", "_print"), links)
    sizes = nodes.select(F.col("_node").alias("_print"), "_n")
    found = found.join(sizes, "_print").select("_id", "_n", "component")
    return found.unionByName(drawn.where("_n = 0").select("_id", "_n", F.col("_id").alias("component")))


def is_kept(id_col: Column, component: Column) -> Column:
    """One row, the smallest id, of each group stays; so do rows without an id."""
    return F.coalesce(id_col == component, F.lit(True))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """`docs` with the smallest id of every group. Rows that repeat the kept id all stay, they cannot be told apart by it."""
    groups = near_duplicates(docs, id_col, text_col, **how)
    lost = groups.where(~is_kept(F.col("_id"), F.col("component"))).select(F.col("_id").alias("_lost")).distinct()
    lost = written(lost, "near-copies")
    return docs.join(lost, docs[id_col] == lost["_lost"], "left_anti")
