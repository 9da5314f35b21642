"""Hard-negative mining with a GNAT-style multiway hyperplane tree.

Scores are inner products of whole-number vectors; with the squared lengths of both ends, a score is a Euclidean distance, so a
window of scores is an annulus around the anchor. The tree is fitted on a bounded sample: a node has up to `fan` split points far
from each other, and every row below the node belongs to the nearest one. All rows are then routed to their leaves, and for every
child and every split point of its node the least and the largest distance of the child's rows are kept (over all rows,
not the sample), with the range of their lengths. For an anchor these ranges bound the distance, hence the score, of everything
below a child; a child whose bounds miss all windows of the anchor is eliminated with its leaves. What is left is scored exactly.

1. Positives: the anchor's own leaf gives a first five; the worst of them (or nothing, if there are fewer) is the window for the other leaves.
2. Negatives: each positive gives the window low * score … high * score.

A leaf is dealt to blocks of some thousand rows, and anchors to blocks of their own, so a task holds one block of each however many
rows share a leaf or a vector; blocks of rows and anchors meet by a shuffle, nothing that grows with the table is broadcast or collected. The
tree with its ranges is bounded by the sample (`sample` vectors).

Edge cases: rows with a null label, null vector or anything but finite components take no part, nor do vectors shorter than the longest
one. Rows with an anchor's own id are never its positives. Repeated rows count each, repeated anchors give their rows each.
A null id is no anchor and comes last among equal scores. An anchor without positives, and a positive without rows in its window,
gives nothing. Scores must stay below 2^46 (else ValueError), where doubles hold them and their hundredfold exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywire.llm.text import ship_code, written
from tallywire.llm.vector_codes import whole_vectors

ship_code(__name__)

ROWS, ANCHORS, TILE = 8192, 16384, 256  # of a block; anchors scored at a time
MOST = 2.0**46


@dataclass
class Node:
    points: np.ndarray
    #: per child: the number of its node, or of its leaf
    child: list[int] = field(default_factory=list)
    is_leaf: list[bool] = field(default_factory=list)
    #: per child and split point: least and largest squared distance of the child's rows; per child: rows, range of squared lengths
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    count: np.ndarray | None = None
    short: np.ndarray | None = None
    long: np.ndarray | None = None


def squared_distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact for whole numbers."""
    return (x * x).sum(1)[:, None] + (points * points).sum(1) - 2 * (x @ points.T)


def fit_tree(sample: np.ndarray, fan: int, leaf_size: int) -> list[Node]:
    """Nodes, the root first. Leaves are numbered in order."""
    nodes: list[Node] = []
    leaves = 0
    todo = [(sample, None, 0)]
    while todo:
        rows, parent, place = todo.pop(0)
        chosen = [0]
        near = squared_distances(rows, rows[:1])[:, 0]
        while len(chosen) < fan and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, squared_distances(rows, rows[chosen[-1:]])[:, 0])
        if parent is not None:
            parent.child[place] = len(nodes)
        node = Node(rows[chosen])
        nodes.append(node)
        own = squared_distances(rows, node.points).argmin(1)
        for k in range(len(chosen)):
            below = rows[own == k]
            is_leaf = len(below) <= leaf_size or len(chosen) == 1
            node.child.append(leaves if is_leaf else -1)
            node.is_leaf.append(is_leaf)
            if is_leaf:
                leaves += 1
            else:
                todo.append((below, node, k))
    return nodes


def route(nodes: list[Node], x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(node, rows that reach it, their child, squared distances to its split points) for every node that rows reach."""
    todo = [(0, np.arange(len(x)))] if len(x) else []
    while todo:
        at, rows = todo.pop()
        far = squared_distances(x[rows], nodes[at].points)
        own = far.argmin(1)
        yield at, rows, own, far
        for k in np.unique(own):
            if not nodes[at].is_leaf[k]:
                todo.append((nodes[at].child[k], rows[own == k]))


def score_bounds(node: Node, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of anything below each child, a row per anchor."""
    own = np.sqrt(squared_distances(anchors, node.points).clip(0))[:, None, :]
    low, high = np.sqrt(node.low), np.sqrt(node.high)
    least = np.maximum(own - high, low - own).max(2).clip(0)
    most = (own + high).min(2)
    length = (anchors * anchors).sum(1)[:, None]
    # roots are rounded
    slack = 1e-9 * (length + node.long + most**2) + 1e-6
    return (length + node.short - most**2) / 2 - slack, (length + node.long - least**2) / 2 + slack


def leaves_to_visit(nodes: list[Node], anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> list[list[int]]:
    """Leaves that may hold a score in one of the windows (a row of lows and highs per anchor; nan: no window)."""
    found: list[list[int]] = [[] for _ in anchors]
    todo = [(0, np.arange(len(anchors)))] if len(anchors) else []
    while todo:
        at, who = todo.pop()
        node = nodes[at]
        least, most = score_bounds(node, anchors[who])
        meets = ((lows[who][:, None, :] <= most[:, :, None]) & (highs[who][:, None, :] >= least[:, :, None])).any(2) & (node.count > 0)
        for k in range(len(node.child)):
            some = who[meets[:, k]]
            if not node.is_leaf[k]:
                if len(some):
                    todo.append((node.child[k], some))
            else:
                for i in some.tolist():
                    found[i].append(node.child[k])
    return found


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1) if rows else np.empty((0, 0))


def _routing(shared: Any):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, label, vector) -> (id, label, vector as bytes, leaf)"""
        nodes = shared.value
        size = nodes[0].points.shape[1]
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            if len(x) and (x * x).sum(1).max() >= MOST:
                raise ValueError("scores are too large")
            leaf = np.zeros(len(x), np.int64)
            for at, rows, own, _ in route(nodes, x):
                ends = np.array(nodes[at].is_leaf)[own]
                leaf[rows[ends]] = np.array(nodes[at].child)[own[ends]]
            columns = [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(leaf)]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_label", "_x", "_leaf"])

    return work


def _ranging(shared: Any):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(vector) -> (node, child, rows, range of squared lengths, least and largest squared distances), once per task"""
        nodes, seen = shared.value, {}
        for batch in batches:
            x = _matrix(batch.column(0))
            length = (x * x).sum(1)
            for at, rows, own, far in route(nodes, x):
                for k in np.unique(own).tolist():
                    part, its = far[own == k], length[rows[own == k]]
                    now = (len(part), its.min(), its.max(), part.min(0), part.max(0))
                    was = seen.get((at, k))
                    if was:
                        now = (was[0] + now[0], min(was[1], now[1]), max(was[2], now[2]), np.minimum(was[3], now[3]), np.maximum(was[4], now[4]))
                    seen[at, k] = now
        rows = [(*key, v[0], float(v[1]), float(v[2]), v[3].tolist(), v[4].tolist()) for key, v in seen.items()]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        names = ["_node", "_child", "_count", "_short", "_long", "_low", "_high"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return work


def with_ranges(nodes: list[Node], rows: DataFrame) -> list[Node]:
    """The tree with the ranges of all rows: a row per child and split point reaches the driver, bounded by the tree."""
    shared = rows.sparkSession.sparkContext.broadcast(nodes)
    schema = "_node int, _child int, _count long, _short double, _long double, _low array<double>, _high array<double>"
    ranges = rows.select("_x").mapInArrow(_ranging(shared), schema)
    flat = ranges.select("_node", "_child", "_count", "_short", "_long", "_high", F.posexplode("_low").alias("_k", "_l"))
    flat = flat.groupBy("_node", "_child", "_k").agg(
        F.sum("_count").alias("n"), F.min("_short").alias("short"), F.max("_long").alias("long"), F.min("_l").alias("low"), F.max(F.get("_high", F.col("_k"))).alias("high")
    )
    for node in nodes:
        m = len(node.child)
        node.low, node.high, node.count = np.zeros((m, m)), np.zeros((m, m)), np.zeros(m, np.int64)
        node.short, node.long = np.zeros(m), np.zeros(m)
    for r in flat.collect():
        node, k = nodes[r["_node"]], r["_child"]
        node.low[k, r["_k"]], node.high[k, r["_k"]], node.count[k] = r["low"], r["high"], r["n"]
        node.short[k], node.long[k] = r["short"], r["long"]
    return nodes


def _visiting(shared: Any):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(anchor, vector, lows, highs) -> (anchor, leaf)"""
        nodes = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, TILE):
                part = batch.slice(start, TILE)
                lows, highs = part.column(2).to_pylist(), part.column(3).to_pylist()
                width = max(map(len, lows))
                pad = lambda rows: np.array([r + [np.nan] * (width - len(r)) for r in rows], float).reshape(len(rows), width)  # noqa: E731, B023
                leaves = leaves_to_visit(nodes, _matrix(part.column(1)), pad(lows), pad(highs))
                who = np.repeat(part.column(0).to_numpy(), [len(x) for x in leaves])
                columns = [pa.array(who, pa.int64()), pa.array([leaf for x in leaves for leaf in x], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["_anchor", "_leaf"])

    return work


def _by_id(table: pa.Table) -> pa.Table:
    return table.sort_by([("_id", "ascending"), ("_key", "ascending")])


def _positives(n: int):
    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        """The best n rows of an anchor's label in a block of rows."""
        rows, out = _by_id(rows), []
        x, ids, keys, labels = _matrix(rows["_x"]), rows["_id"].to_pylist(), rows["_key"].to_numpy(), rows["_label"].to_numpy()
        names = np.array([-1 if i is None else i for i in ids])
        known = np.array([i is not None for i in ids], bool)
        for start in range(0, len(anchors) if len(x) else 0, TILE):
            part = anchors.slice(start, TILE)
            own, label = part["_anchor_id"].to_numpy(), part["_label"].to_numpy()
            score = _matrix(part["_x"]) @ x.T
            score[(label[:, None] != labels) | ((own[:, None] == names) & known)] = -np.inf
            # stable: equal scores keep the order of the ids
            best = np.argsort(-score, axis=1, kind="stable")[:, :n]
            for who, cols, values in zip(part["_anchor"].to_pylist(), best, np.take_along_axis(score, best, axis=1)):
                out += [(who, ids[c], int(keys[c]), int(v)) for c, v in zip(cols, values) if v > -np.inf]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["_anchor", "_id", "_key", "_score"])

    return work


def _negatives(n: int, low: int, high: int):
    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        """The best n rows of other labels in the window of each positive, in a block of rows."""
        rows, out = _by_id(rows), []
        x, ids, keys, labels = _matrix(rows["_x"]), rows["_id"].to_pylist(), rows["_key"].to_numpy(), rows["_label"].to_numpy()
        for start in range(0, len(anchors) if len(x) else 0, TILE):
            part = anchors.slice(start, TILE)
            label = part["_label"].to_numpy()
            score = _matrix(part["_x"]) @ x.T
            score[label[:, None] == labels] = -np.inf
            order = np.argsort(-score, axis=1, kind="stable")
            falling = -100 * np.take_along_axis(score, order, axis=1)
            for who, cols, values, windows in zip(part["_anchor"].to_pylist(), order, falling, part["_windows"].to_pylist()):
                for w in windows:
                    s = w["_score"]
                    i, j = np.searchsorted(values, -high * s, "left"), np.searchsorted(values, -low * s, "right")
                    out += [(who, w["_place"], ids[cols[k]], int(keys[cols[k]]), round(-values[k] / 100)) for k in range(i, min(j, i + n))]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["_anchor", "_place", "_id", "_key", "_score"])

    return work


class _Search:
    """All rows in leaves, and anchors that visit them."""

    def __init__(self, rows: DataFrame, nodes: list[Node], anchors: DataFrame):
        self.spark, self.rows, self.anchors = rows.sparkSession, rows, anchors
        self.tree = self.spark.sparkContext.broadcast(nodes)
        sizes = {n.child[k]: int(n.count[k]) for n in nodes for k in range(len(n.child)) if n.is_leaf[k]}
        # one number per leaf, bounded by the tree
        self.blocks = F.array(*[F.lit(-(-sizes[leaf] // ROWS)).cast("long") for leaf in range(len(sizes))])

    def n_blocks(self) -> Column:
        return F.greatest(F.get(self.blocks, F.col("_leaf").cast("int")), F.lit(1))

    def leaves(self, anchors: DataFrame) -> DataFrame:
        """_anchor, _leaf for anchors with windows _lows and _highs."""
        return anchors.select("_anchor", "_x", "_lows", "_highs").mapInArrow(_visiting(self.tree), "_anchor long, _leaf long")

    def scan(self, visits: DataFrame, anchors: DataFrame, work, schema: str) -> DataFrame:
        """work(anchors, rows) on every block of the leaves that its block of anchors visits."""
        met = visits.join(anchors, "_anchor").withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), self.n_blocks() - 1)))
        asked = visits.join(anchors.select("_anchor", "_group"), "_anchor").select("_leaf", "_group").distinct()
        dealt = self.rows.withColumn("_block", F.pmod(F.xxhash64("_key"), self.n_blocks())).join(asked, "_leaf")
        keys = ("_leaf", "_block", "_group")
        # toDF gives columns of their own: both sides come from the same tables
        met, dealt = met.toDF(*met.columns), dealt.toDF(*dealt.columns)
        return met.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(work, schema)


def _best(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first n per key, with their _place from 0."""
    order = Window.partitionBy(*keys).orderBy(F.col("_score").desc(), F.col("_id").asc_nulls_last(), "_key")
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)


def mine(
    table: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: float = 256.0,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    sample: int = 2048,
    fan: int = 8,
    leaf_size: int = 48,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative's score is between `low` and `high` hundredths of the positive's.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    cols = table.select(
        F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("_label"), F.col(vector_col).alias("_raw"), is_anchor.alias("_is_anchor")
    )
    clean = whole_vectors(cols.where(F.col("_label").isNotNull()), "_raw", scale)
    size = clean.agg(F.max(F.size("_vector"))).first()[0] or 0
    if not size:
        return table.sparkSession.createDataFrame([], schema)
    clean = clean.where(F.size("_vector") == size)
    # the sample is the rows with the least hashes of their vectors
    drawn = clean.select("_vector", F.xxhash64("_vector").alias("_h")).orderBy("_h").limit(sample).collect()
    nodes = fit_tree(np.array([r["_vector"] for r in drawn], float), fan, leaf_size)
    shared = table.sparkSession.sparkContext.broadcast(nodes)
    marked = clean.withColumn("_marked", F.struct("_id", F.coalesce("_is_anchor", F.lit(False)).alias("_is")))
    routed = marked.select("_marked", "_label", "_vector").mapInArrow(_routing(shared), "_id struct<_id: long, _is: boolean>, _label long, _x binary, _leaf long")
    routed = routed.select(F.col("_id._id").alias("_id"), F.col("_id._is").alias("_is"), "_label", "_x", "_leaf", F.monotonically_increasing_id().alias("_key"))
    rows = written(routed, "tree-rows")
    nodes = with_ranges(nodes, rows)

    anchors = rows.where(F.col("_is") & F.col("_id").isNotNull())
    groups = -(-anchors.count() // ANCHORS) or 1
    anchors = written(
        anchors.select(F.col("_key").alias("_anchor"), F.col("_id").alias("_anchor_id"), "_label", "_x", F.col("_leaf").alias("_own"), F.pmod(F.xxhash64("_key"), F.lit(groups)).alias("_group")),
        "anchors",
    )
    search = _Search(rows.drop("_is"), nodes, anchors)
    columns = "_anchor long, _id long, _key long, _score long"
    look = anchors.select("_anchor", "_anchor_id", "_label", "_x", "_group")

    first = search.scan(anchors.select("_anchor", F.col("_own").alias("_leaf")), look, _positives(n_positives), columns)
    first = written(_best(first, ["_anchor"], n_positives).drop("_rank"), "own-leaf")
    worst = first.groupBy("_anchor").agg(F.count("*").alias("_n"), F.min("_score").alias("_worst"))
    bound = F.when(F.col("_n") == n_positives, F.col("_worst").cast("double")).otherwise(F.lit(float("-inf")))
    asked = anchors.join(worst, "_anchor", "left").withColumn("_lows", F.array(bound)).withColumn("_highs", F.array(F.lit(float("inf"))))
    visits = search.leaves(asked).join(anchors.select("_anchor", "_own"), "_anchor").where(F.col("_leaf") != F.col("_own")).drop("_own")
    more = search.scan(written(visits, "positive-visits"), look, _positives(n_positives), columns)
    best = written(_best(first.unionByName(more), ["_anchor"], n_positives), "positives")

    windows = best.groupBy("_anchor").agg(F.collect_list(F.struct(F.col("_rank").alias("_place"), "_score")).alias("_windows"))
    asked = look.join(windows, "_anchor")
    edge = lambda part: F.transform("_windows", lambda w: w["_score"] * part / 100)
    # without rounding of the hundredths a window could lose its border
    reach = asked.withColumn("_lows", F.transform(edge(low), lambda x: x - 1e-3)).withColumn("_highs", F.transform(edge(high), lambda x: x + 1e-3))
    visits = written(search.leaves(reach), "negative-visits")
    found = search.scan(visits, asked, _negatives(n_negatives, low, high), "_anchor long, _place int, _id long, _key long, _score long")
    found = _best(found, ["_anchor", "_place"], n_negatives)
    named = best.select("_anchor", F.col("_rank").alias("_place"), F.col("_id").alias("positive_id"), F.col("_score").alias("positive_score"))
    named = named.join(anchors.select("_anchor", F.col("_anchor_id").alias("anchor_id")), "_anchor")
    return found.join(named, ["_anchor", "_place"]).select(
        "anchor_id", "positive_id", F.col("_rank").alias("rank"), F.col("_id").alias("negative_id"), "positive_score", F.col("_score").alias("negative_score")
    )
