"""HyperMinHash near-dedup: registers, planted copies and large groups against all pairs."""

import random
import re

import numpy as np
import pytest

from tallywire.llm import hyperminhash


def elements(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def groups(texts):
    """Smallest id of each component over all pairs."""
    root, sets = {i: i for i in texts}, {i: elements(t) for i, t in texts.items()}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(texts):
        for j in sorted(texts):
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in texts}


def found(spark, texts, **how):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r["_id"]: (r["_n"], r["component"]) for r in hyperminhash.near_duplicates(docs, **how).collect()}


def edited(words, changes, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"new{rng.getrandbits(40)}"
    return words


def test_registers_estimate_the_similarity():
    """Also for sets far smaller and far larger than the buckets; unlike sets come out at zero after the correction."""
    rng = np.random.default_rng(3)
    for size in (5, 40, 400, 6000):
        for share in (0.0, 0.5, 0.8):
            errors, agree = [], []
            for _ in range(40):
                both = int(round(2 * share / (1 + share) * size))
                values = rng.integers(0, 2**63, 2 * size - both).astype(np.uint64)
                a, b = values[:size], values[size - both :]
                x, y = (hyperminhash.compressed(hyperminhash.least_hashes(v, 175))[None] for v in (a, b))
                truth = both / (2 * size - both)
                got = hyperminhash.estimate(x, y, np.array([size]), np.array([size]))[0]
                errors.append(got - truth)
                agree.append((x == y).mean())
            assert abs(np.mean(errors)) < 0.025, (size, share)
            if not share:
                assert abs(np.mean(agree) - hyperminhash.chance([size], [size], 175)[0]) < 0.002


def test_chance_is_that_of_unlike_sets():
    """With few bits the chance of equal registers is large enough to measure."""
    rng = np.random.default_rng(4)
    for size in (60, 500, 5000):
        equal = []
        for _ in range(150):
            x, y = (hyperminhash.compressed(hyperminhash.least_hashes(rng.integers(0, 2**63, size).astype(np.uint64), 175)) for _ in range(2))
            equal.append((x == y).mean())
        assert np.mean(equal) == pytest.approx(hyperminhash.chance([size], [size], 175)[0], abs=0.0006)


def test_planted_copies(spark):
    """Pairs on both sides of the threshold; short texts; one of the smallest pairs that can link."""
    rng, texts = random.Random(5), {}
    for k in range(80):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((8, 30, 200)))]
        copy = edited(words, min(len(words), 1 + k % 6), rng) if len(words) > 8 else [*words, "end"]
        texts[2 * k], texts[2 * k + 1] = " ".join(words), " ".join(copy).upper()
    base = "a b c d e f g".split()
    texts |= {900: " ".join(base), 901: " ".join([*base, "h"]), 902: "", 903: " \t", 904: "two words", 905: "Two  words", 906: "two"}
    assert found(spark, texts) == groups(texts)


@pytest.mark.parametrize("max_bucket", [8, 2])
def test_large_groups_against_all_pairs(spark, max_bucket):
    """Groups that crowd their keys, with chains and members on both sides of the threshold."""
    rng, texts = random.Random(6), {}
    for _ in range(2):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(60):
            texts[len(texts)] = " ".join(edited(base, rng.choice((0, 1, 1, 2, 3, 4, 5, 9)), rng))
        for _ in range(12):  # a chain away from the base
            base = edited(base, 2, rng)
            texts[len(texts)] = " ".join(base)
    assert found(spark, texts, max_bucket=max_bucket) == groups(texts)


def test_common_text_takes_a_fixed_number_of_steps(spark):
    """Texts that are two thirds alike share many keys but no link; rarest hashes tell them apart without pairs."""
    rng = random.Random(7)
    common = [f"c{i}" for i in range(400)]

    def of(n):
        return {i: " ".join([*common, *(f"u{rng.getrandbits(40)}" for _ in range(200))]) for i in range(n)}

    tracker = spark.sparkContext.statusTracker()
    used = []
    for n in (40, 300):
        spark.sparkContext.setJobGroup(f"common-{n}", "")
        assert all(c == i for i, (_, c) in found(spark, of(n)).items())
        used.append(len(tracker.getJobIdsForGroup(f"common-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert used[1] <= used[0] + 5
