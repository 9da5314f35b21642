"""Vector codes and hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywire.llm import hard_negatives, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(n, size, seed, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (centres, size))
    return (middle[rng.integers(0, centres, n)] + rng.normal(0, 0.05, (n, size))).astype(np.float32)


def odd_rows(size):
    nan, inf = float("nan"), float("inf")
    return [
        (9001, None, 1),
        (9002, [None, *[0.0] * (size - 1)], 1),
        (9003, [nan, *[0.0] * (size - 1)], 1),
        (9004, [*[0.0] * (size - 1), -inf], None),
        (9005, [0.5], 1),
        (9006, [], 2),
        (9100, None, None),
    ]


def usable(rows, size):
    return [r for r in rows if r[1] is not None and len(r[1]) == size and all(x is not None and math.isfinite(x) for x in r[1])]


def coded_by_hand(rows, parts=4, entries=256, rounds=4):
    rows = sorted((r[0], [math.floor(1024 * x) for x in r[1]], r[2]) for r in rows)
    points = np.array([r[1] for r in rows])
    cut = np.split(points, parts, axis=1)
    books = [x[:entries].copy() for x in cut]

    def assign(x, book):
        squared = ((x[:, None, :] - book) ** 2).sum(2)
        return squared.argmin(1), squared.min(1)

    for _ in range(rounds):
        for x, book in zip(cut, books):
            own = assign(x, book)[0]
            for e in set(own.tolist()):
                book[e] = x[own == e].sum(0) // (own == e).sum()
    last = [assign(x, book) for x, book in zip(cut, books)]
    errors = sum(x[1] for x in last)
    codes = ["".join(f"{x[0][i]:02x}" for x in last) for i in range(len(rows))]
    by_label = {}
    for r, e in zip(rows, errors.tolist()):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted((r[0], c, e, by_label[r[2]]) for r, c, e in zip(rows, codes, errors.tolist())), books


@pytest.mark.parametrize("entries,n_pivots", [(256, 6), (20, 1)])
def test_codes(spark, entries, n_pivots):
    """Clusters, equal vectors (ties between entries), a label of its own for nulls, and rows that take no part."""
    size = 8
    rows = [(i, [float(x) for x in v], i % 3 if i % 5 else None) for i, v in enumerate(clustered(900, size, 1))]
    rows += [(2000 + i, rows[7][1], 1) for i in range(40)] + [(1, rows[3][1], 2)]
    table = spark.createDataFrame(rows + odd_rows(size), SCHEMA)
    coded, books = vector_codes.encode(table, entries=entries, n_pivots=n_pivots)
    want, want_books = coded_by_hand(usable(rows, size), entries=entries)
    assert sorted((r["_id"], r["code"], r["error"], r["label_error"]) for r in coded.collect()) == want
    assert all((x == y).all() for x, y in zip(books, want_books))


def test_bounds_prune_and_ties_go_to_the_lower_index():
    rng = np.random.default_rng(2)
    points = rng.integers(-300, 300, (500, 4))
    entries = np.concatenate([points[:40], points[:40]])  # every entry twice
    pivots = vector_codes.far_apart(entries, 5)
    index, squared = vector_codes.nearest(points, vector_codes.distances(points, pivots), entries, vector_codes.distances(entries, pivots))
    full = ((points[:, None, :] - entries) ** 2).sum(2)
    assert (index == full.argmin(1)).all() and (squared == full.min(1)).all() and index.max() < 40
    assert len(vector_codes.far_apart(np.ones((9, 3), int), 4)) == 1


def test_few_empty_and_large_vectors(spark):
    few = spark.createDataFrame([(3, [1.0, 2.0, 3.0, 4.0], None), (None, [1.5, 2.0, 3.0, 4.0], None)], SCHEMA)
    coded, books = vector_codes.encode(few)
    assert sorted((r["code"], r["error"], r["label_error"]) for r in coded.collect()) == [("00000000", 0, 0), ("01000000", 0, 0)]
    assert [len(b) for b in books] == [2] * 4
    assert vector_codes.encode(few.where(F.lit(False)))[0].collect() == []
    with pytest.raises(ValueError):
        vector_codes.encode(spark.createDataFrame([(1, [1.0] * 6, 1)], SCHEMA))
    with pytest.raises(ValueError, match="components beyond"):
        vector_codes.encode(spark.createDataFrame([(1, [1e30] * 4, 1)], SCHEMA))


def mined_by_hand(rows):
    rows = [(r[0], r[2], np.array([math.floor(256 * x) for x in r[1]])) for r in rows if r[2] is not None]
    out = []
    for a in rows:
        if a[0] is None or a[0] % 100:
            continue
        scored = sorted(((-int(a[2] @ r[2]), math.inf if r[0] is None else r[0], r[1], r[0]) for r in rows), key=lambda x: x[:2])
        best = [x for x in scored if x[2] == a[1] and x[3] != a[0]][:5]
        for p in best:
            fits = [x for x in scored if x[2] != a[1] and 30 * -p[0] <= 100 * -x[0] <= 90 * -p[0]][:10]
            out += [(a[0], p[3], k + 1, x[3], -p[0], -x[0]) for k, x in enumerate(fits)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [8192, 40])
def test_mining(spark, monkeypatch, block):
    """Clusters, one vector many times, ties, few rows of a label, rows without label or vector; small blocks split a hot leaf."""
    monkeypatch.setattr(hard_negatives, "ROWS", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", block)
    rng, size = random.Random(3), 8
    rows = [(i, [float(x) for x in v], rng.randrange(4) if i % 9 else None) for i, v in enumerate(clustered(1500, size, 4))]
    rows += [(3000 + i, rows[5][1], i % 2) for i in range(200)] + [(20_000, rows[6][1], 77), (None, rows[8][1], 2)]
    table = spark.createDataFrame(rows + odd_rows(size), SCHEMA)
    got = hard_negatives.mine(table, F.col("vec_id") % 100 == 0, sample=400, fan=4, leaf_size=20).collect()
    assert sorted(map(tuple, got), key=repr) == mined_by_hand(usable(rows, size))


def test_ranges_eliminate_leaves_but_no_row():
    x = np.floor(256 * clustered(3000, 8, 5).astype(float))
    nodes = hard_negatives.fit_tree(x[:500], 4, 20)
    leaf = np.zeros(len(x), int)
    for at, rows, own, _ in hard_negatives.route(nodes, x):
        ends = np.array(nodes[at].is_leaf)[own]
        leaf[rows[ends]] = np.array(nodes[at].child)[own[ends]]
    for node in nodes:
        m = len(node.child)
        node.low, node.high, node.count, node.short, node.long = np.zeros((m, m)), np.zeros((m, m)), np.zeros(m, int), np.zeros(m), np.zeros(m)
    for at, rows, own, far in hard_negatives.route(nodes, x):
        for k in set(own.tolist()):
            length = (x[rows[own == k]] ** 2).sum(1)
            nodes[at].low[k], nodes[at].high[k], nodes[at].count[k] = far[own == k].min(0), far[own == k].max(0), (own == k).sum()
            nodes[at].short[k], nodes[at].long[k] = length.min(), length.max()
    anchors = x[::50]
    score = anchors @ x.T
    windows = np.sort(score, axis=1)[:, [-40, -20]]
    visits = hard_negatives.leaves_to_visit(nodes, anchors, windows[:, :1], windows[:, 1:])
    n_leaves = leaf.max() + 1
    for i, seen in enumerate(visits):
        inside = (score[i] >= windows[i, 0]) & (score[i] <= windows[i, 1])
        assert set(leaf[inside]) <= set(seen)
    assert np.mean([len(v) for v in visits]) < 0.6 * n_leaves


def test_mining_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(none, F.col("vec_id") % 100 == 0).collect() == []
    alone = spark.createDataFrame([(100, [1.0, 2.0], 1)], SCHEMA)
    assert hard_negatives.mine(alone, F.col("vec_id") % 100 == 0).collect() == []
