"""Substring dedup by prefix-partitioned suffix trees over words.

A document's suffixes start at its words. What counts is whether two suffixes agree in their first `window` words:
whether they meet in a node of the suffix tree at that depth or deeper. The trees are built in groups of a
prefix, each small enough for a task:

1. Sparse suffixes. Of every window, one run of `seed` words is its seed, the one with the least hash; equal windows
   have equal seeds at equal places, so it is enough to compare suffixes around the same seed. Seeds are one in eight
   words. A seed found once in the corpus is a leaf of the tree and leaves with all its suffixes.
2. Prefix groups. The suffixes around one seed are a group. If it has more than `group_rows` seeds, its prefix is
   lengthened to the whole window: the suffixes of one window are then a node, and only its first leaf is kept,
   folded before the shuffle. So no group that a task holds grows with the corpus.
3. Subtrees. In a task, the suffixes of a block of groups are sorted by the hash of their path down to the depth, and
   within it by document and place. Paths with more than one leaf are the deep internal nodes, whose leaves are
   the maximal repeats; all leaves but the first start a repeat.

Whole copies are folded before: of documents with the same words only the first takes part, the others are repeats
from end to end. Between the steps only hashes, ids and places are shuffled.

Edge cases: null and empty texts have no words. Documents with fewer words than the window have no repeats. The id is a
whole number; null comes before all others. Rows of one id are told apart, and ordered, by their texts; repeated rows
get the same result. n_words and n_removed replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.llm.decontaminate import shingles_of
from tallywire.llm.text import kept_positions, packed, ship_code, text_key, unpacked, words_at, words_of, written

ship_code(__name__)

BLOCK_SUFFIXES = 2_000_000
LEAST = -(1 << 63)


def windows_of(words: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window: hash of its words, place of its seed, and the hashes of all runs of `seed` words."""
    runs = shingles_of(words, seed)
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), runs
    # runs that cover the window from the first word to the last
    places = [*range(0, window - seed, seed), window - seed]
    paths = np.zeros(n, np.uint64)
    for k in places:
        paths = shingles_of(paths ^ runs[k : k + n], 1)
    span = window - seed + 1
    seeds = np.empty(n, np.int64)
    for start in range(0, n, 65536):  # bounds the strided comparison
        stop = min(n, start + 65536)
        seeds[start:stop] = start + np.arange(stop - start) + np.lib.stride_tricks.sliding_window_view(runs[start : stop + span - 1], span).argmin(axis=1)
    return paths, seeds, runs


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    ends = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ends - ends[0]


def _seed_rows(window: int, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ends = _lists(batch.column(2))
            at, places, hashes = [], [], []
            for i in range(batch.num_rows):
                _, seeds, runs = windows_of(words[ends[i] : ends[i + 1]].view(np.uint64), window, seed)
                if len(seeds):
                    own = seeds[np.append(True, seeds[1:] != seeds[:-1])]  # never go back
                    at.append(np.full(len(own), i))
                    places.append(own)
                    hashes.append(runs[own])
            if at:
                row = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array(np.concatenate(places).astype(np.int32)),
                        pa.array(np.concatenate(hashes).view(np.int64)),
                    ],
                    ["_doc", "_row", "_at", "_seed"],
                )

    return work


def _suffix_rows(window: int, seed: int):
    """(doc, row, word hashes, places of repeated seeds) -> a row per seed: its suffixes are consecutive windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ends = _lists(batch.column(2))
            wanted, stops = _lists(batch.column(3))
            at, start, key, size, paths = [], [], [], [], []
            for i in range(batch.num_rows):
                own, seeds, runs = windows_of(words[ends[i] : ends[i + 1]].view(np.uint64), window, seed)
                first = np.flatnonzero(np.append(True, seeds[1:] != seeds[:-1]))
                count = np.diff(np.append(first, len(seeds)))
                hit = np.isin(seeds[first], wanted[stops[i] : stops[i + 1]])
                at.append(np.full(hit.sum(), i))
                start.append(first[hit])
                key.append(runs[seeds[first[hit]]])
                size.append(count[hit])
                paths.append(own[np.repeat(hit, count)])
            if not at:
                continue
            row = pa.array(np.concatenate(at))
            borders = np.concatenate([[0], np.cumsum(np.concatenate(size))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(np.concatenate(paths).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(key).view(np.int64)),
                    batch.column(0).take(row),
                    batch.column(1).take(row),
                    pa.array(np.concatenate(start).astype(np.int32)),
                    lists,
                ],
                ["_seed", "_doc", "_row", "_start", "_paths"],
            )

    return work


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by seed -> (doc, row, first, last): places of windows that start earlier too.

    Whole groups are gathered into blocks; a group at the end of a batch waits for the next one.
    """
    waiting: list[pa.Table] = []

    def solve(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        paths, ends = _lists(rows.column("_paths").chunk(0))
        size = np.diff(ends)
        owner = np.repeat(np.arange(len(size)), size)
        place = rows.column("_start").to_numpy()[owner] + np.arange(len(paths)) - ends[owner]
        doc, part = rows.column("_doc").to_numpy()[owner], rows.column("_row").to_numpy()[owner]
        leaves = np.lexsort((place, part, doc, paths))
        repeat = np.zeros(len(paths), bool)
        repeat[leaves[1:]] = paths[leaves[1:]] == paths[leaves[:-1]]
        # runs of repeats within a row of suffixes
        inner = np.append(False, owner[1:] == owner[:-1])
        first = np.flatnonzero(repeat & ~(np.append(False, repeat[:-1]) & inner))
        last = np.flatnonzero(repeat & ~(np.append(repeat[1:], False) & np.append(inner[1:], False)))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[first]), pa.array(part[first]), pa.array(place[first].astype(np.int32)), pa.array(place[last].astype(np.int32))],
            ["_doc", "_row", "_first", "_last"],
        )

    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        table, seeds = pa.Table.from_batches([batch]), batch.column(0)
        if held >= BLOCK_SUFFIXES:
            # up to the last change of seed, the groups are whole
            values = seeds.to_numpy()
            change = np.flatnonzero(values[1:] != values[:-1]) + 1
            before = waiting[-1].column("_seed")[-1].as_py()
            cut = int(change[-1]) if len(change) else 0 if values[0] != before else None
            if cut is not None:
                done = pa.concat_tables([*waiting, table.slice(0, cut)])
                waiting, held, table = [], 0, table.slice(cut)
                yield solve(done)
        waiting.append(table)
        held += len(batch.column(4).flatten())
    if waiting:
        yield solve(pa.concat_tables(waiting))


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST))


def repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
    seed: int = 6,
    group_rows: int = 100_000,
) -> tuple[DataFrame, DataFrame]:
    """Repeated windows (_doc, _row, _first, _last: runs of starts) and whole later copies (_doc, _row).

    Every window of `window` words that also starts earlier, in a smaller id or the same document, is in one of them.
    """
    words = words_of(F.col(text_col))
    rows = docs.select(_key(id_col).alias("_doc"), text_key(F.col(text_col)).alias("_row"), words.alias("_w"))
    content = F.array_join("_w", " ")
    addressed = rows.where(F.size("_w") >= window).select(
        "_doc", "_row", F.xxhash64(content).alias("_c1"), F.xxhash64(F.lit("copy"), content).alias("_c2")
    )
    addressed = written(addressed, "contents")
    firsts = addressed.groupBy("_c1", "_c2").agg(F.min(F.struct("_doc", "_row")).alias("_one"), F.count("*").alias("_n")).where("_n > 1")
    copies = addressed.join(firsts, ["_c1", "_c2"]).where(F.struct("_doc", "_row") != F.col("_one")).select("_doc", "_row").distinct()
    copies = written(copies, "whole-copies")

    hashed = rows.select("_doc", "_row", F.transform("_w", lambda w: F.xxhash64(w)).alias("_hashes"))
    seeds = hashed.mapInArrow(_seed_rows(window, seed), "_doc long, _row long, _at int, _seed long")
    seeds = written(seeds, "seeds")
    often = written(seeds.groupBy("_seed").agg(F.count("*").alias("_n")).where("_n > 1"), "repeated-seeds")

    def suffixes(limit: Column) -> DataFrame:
        wanted = seeds.join(often.where(limit).select("_seed"), "_seed").groupBy("_doc", "_row").agg(F.collect_set("_at").alias("_wanted"))
        wanted = wanted.join(copies, ["_doc", "_row"], "left_anti")
        joined = hashed.join(wanted, ["_doc", "_row"]).dropDuplicates(["_doc", "_row"])
        return joined.select("_doc", "_row", "_hashes", "_wanted").mapInArrow(
            _suffix_rows(window, seed), "_seed long, _doc long, _row long, _start int, _paths array<long>"
        )

    found = "_doc long, _row long, _first int, _last int"
    cold = suffixes(F.col("_n") <= group_rows)
    cold = cold.repartition("_seed").sortWithinPartitions("_seed").mapInArrow(_subtrees, found)
    result = written(cold, "repeats")
    hot = F.col("_n") > group_rows
    if not often.where(hot).isEmpty():
        leaves = suffixes(hot).select("_doc", "_row", "_start", F.posexplode("_paths").alias("_k", "_path"))
        leaves = written(leaves.select("_path", "_doc", "_row", (F.col("_start") + F.col("_k")).alias("_at")), "hot-suffixes")
        nodes = leaves.groupBy("_path").agg(F.min(F.struct("_doc", "_row", "_at")).alias("_leaf"), F.count("*").alias("_n"))
        nodes = written(nodes.where("_n > 1").select("_path", "_leaf"), "hot-nodes")
        more = leaves.join(nodes, "_path").where(F.struct("_doc", "_row", "_at") != F.col("_leaf"))
        result = result.unionByName(more.select("_doc", "_row", F.col("_at").alias("_first"), F.col("_at").alias("_last")))
    return result, copies


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, **how) -> DataFrame:
    """`docs` with the text of the kept words, joined by blanks, and n_words (before) and n_removed behind its columns."""
    found, copies = repeats(docs, id_col, text_col, window, **how)
    covered = F.sequence(F.col("_first"), F.col("_last") + window - 1)
    spans = found.groupBy("_doc", "_row").agg(F.flatten(F.collect_list(covered)).alias("_drop"))
    marks = spans.withColumn("_copy", F.lit(False)).unionByName(
        copies.select("_doc", "_row", F.lit(None).cast("array<int>").alias("_drop"), F.lit(True).alias("_copy"))
    )
    marks = written(marks, "removals").select(F.col("_doc").alias("_d"), F.col("_row").alias("_r"), "_drop", "_copy")
    tagged = docs.select(
        packed(docs, text_col), _key(id_col).alias("_key_doc"), text_key(F.col(text_col)).alias("_key_row"), F.col(text_col).alias("_text")
    )
    joined = tagged.join(marks, (F.col("_key_doc") == F.col("_d")) & (F.col("_key_row") == F.col("_r")), "left")
    parts = joined.withColumn("_words", words_of(F.col("_text")))
    none = F.array().cast("array<int>")
    parts = parts.withColumn(
        "_keep", F.when(F.coalesce("_copy", F.lit(False)), none).otherwise(kept_positions(F.size("_words"), F.col("_drop")))
    )
    text = F.when(F.size("_keep") == F.size("_words"), F.array_join("_words", " ")).otherwise(
        F.array_join(words_at(F.col("_words"), F.col("_keep")), " ")
    )
    return parts.select(
        *unpacked(
            docs,
            **{text_col: text},
            n_words=F.size("_words").cast("long"),
            n_removed=(F.size("_words") - F.size("_keep")).cast("long"),
        )
    )
