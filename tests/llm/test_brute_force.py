"""Operators against plain Python on the small tables and on rows made to hit their rare paths."""

import hashlib
import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from conftest import SF
from pyspark.sql import functions as F

from tallywire.llm import decontaminate, html_text, licenses, mixing, quality, secrets_scan, simhash, substrings, tokens
from tallywire.llm.components import components
from tallywire.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# --- quality -----------------------------------------------------------------------------------


def test_quality_figures(spark, texts):
    for r in QUERIES["op1_quality"](spark, SF).collect():
        text = texts[r["doc_id"]]
        words = blank_words(text)
        lines = [x for x in text.split("\n") if blank_words(x)]
        count = Counter(zip(words, words[1:], words[2:]))
        covered = {j for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        )
        assert r["base_failed"] == (len(words) < 50 or 2 * len(covered) > len(words))
        assert not (r["kept"] and r["base_failed"])


def signals(spark, rows):
    fields = ", ".join(f"rule_{r} int" for r in quality.RULES)
    return spark.createDataFrame(rows, f"doc_id long, lang string, base_failed boolean, {fields}")


def test_cutoffs_are_certified_by_exact_bounds(spark):
    from math import comb

    rng = random.Random(5)
    rows, marks = [], []
    for i in range(6000):
        bad = i % 4 == 0
        symbols = rng.randint(300, 500) if bad else (350 if rng.random() < 0.002 else rng.randint(0, 60))
        rows.append((i, "en" if i % 3 else None, False, symbols, 0, 0, 0, 0))
        marks.append((i, 0 if bad else 1))
    found = quality.fit_cutoffs(signals(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int")).collect()
    assert {r["rule"] for r in found} == {0} and {r["stratum"] for r in found} == {"=en", "null"}
    for r in found:
        tail = sum(comb(r["n"], i) * 0.01**i * 0.99 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert tail <= 0.05 / (len(quality.RULES) * 2)
        # a good document with 350 costs more than the small stratum can certify
        assert 60 <= r["cutoff"] <= 350


def test_too_few_labels_reject_nothing(spark):
    rows = [(i, "en", False, 400 if i % 2 else 0, 0, 0, 0, 0) for i in range(200)]
    marks = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "doc_id long, quality int")
    assert quality.fit_cutoffs(signals(spark, rows), marks).collect() == []


def test_binomial_tail(spark):
    from math import comb, log

    cases = [(n, k) for n in (1, 7, 100, 900) for k in (0, 1, 5, 30) if k <= n]
    frame = spark.createDataFrame(cases, "n long, k long")
    for r in frame.select("n", "k", quality.log_binomial_cdf(F.col("n"), F.col("k"), 0.03).alias("x")).collect():
        want = sum(comb(r["n"], i) * 0.03**i * 0.97 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert r["x"] == pytest.approx(log(want), abs=1e-9)


# --- substrings --------------------------------------------------------------------------------


def removed_by_hand(docs, window):
    seen, out = set(), {}
    for key in sorted(docs):
        words, gone = blank_words(docs[key]), set()
        for i in range(len(words) - window + 1):
            path = tuple(words[i : i + window])
            if path in seen:
                gone.update(range(i, i + window))
            seen.add(path)
        out[key] = [w for i, w in enumerate(words) if i not in gone]
    return out


@pytest.mark.parametrize("group_rows", [100_000, 3])
def test_substrings(spark, group_rows):
    """Passages in many documents, copies, a passage repeated inside a document; a low bound sends groups the other way."""
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz")
    passage = [word() for _ in range(33)]
    docs = {}
    for i in range(60):
        words = [word() + str(rng.randint(0, 40)) for _ in range(rng.randint(0, 120))]
        if i % 3 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = passage[rng.randint(0, 9) :]
        docs[i] = " ".join(words)
    docs[60], docs[61], docs[62] = docs[7], docs[7] + " ", " ".join([*passage, *passage, *passage])
    docs[63] = "la " * 100
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.drop_repeats(frame, group_rows=group_rows).collect()}
    want = removed_by_hand(docs, 20)
    assert {i: r["text"].split() for i, r in got.items()} == want
    assert all(r["n_words"] - r["n_removed"] == len(want[i]) for i, r in got.items())


def test_blocks_of_subtrees_keep_groups_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(substrings, "BLOCK_SUFFIXES", 3)
    rng = np.random.default_rng(3)
    seeds = np.sort(rng.integers(0, 12, 200))
    rows = [(int(s), i, 0, 0, [int(s) * 100 + int(rng.integers(0, 3)) for _ in range(rng.integers(1, 4))]) for i, s in enumerate(seeds)]
    names = ["_seed", "_doc", "_row", "_start", "_paths"]
    table = pa.table([pa.array(c) for c in zip(*rows)], names)
    found = set()
    for batch in substrings._subtrees(iter(table.to_batches(max_chunksize=7))):
        for r in batch.to_pylist():
            found |= {(r["_doc"], p) for p in range(r["_first"], r["_last"] + 1)}
    seen, want = set(), set()
    for _, doc, _, start, paths in rows:
        for k, path in enumerate(paths):
            if path in seen:
                want.add((doc, start + k))
            seen.add(path)
    assert found == want


# --- licenses and secrets ----------------------------------------------------------------------


def test_licenses(spark, texts):
    known = [(label, licenses.template_words(t)) for label, t in licenses.TEMPLATES]
    for r in QUERIES["op3_licenses"](spark, SF).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r["doc_id"]].translate(LOWER))
        places, base, score = [], set(), 0.0
        for phrase, label in licenses.PHRASES:
            own = phrase.split()
            hits = [i for i in range(len(words)) if words[i : i + len(own)] == own]
            places += hits
            base |= {label} if hits else set()
        labels = set(base)
        for label, template in known:
            run = -(-len(template) * 10 // 9)
            for i in range(max(1, len(words) - run + 1)):
                share = len(set(words[i : i + run]) & set(template)) / len(set(template))
                if share >= 0.9:
                    labels.add(label)
                    score = max(score, share)
        want = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)))
        assert tuple(r)[1:-1] == want and r["score"] == pytest.approx(score)


def test_licenses_need_their_words_close_together(spark):
    rows = [
        (1, "MIT researchers released a paper. Later the license plate was found under the bridge", ""),
        (2, "licensed nurses under 40 saw by CC train nc line 0 stops 4 times", ""),
        (3, "x " * 300 + "it is released under the MIT license", "mit"),
        (4, "licensed (under) CC-BY-NC 4.0", "cc-by-nc"),
        (5, " ".join(w if i % 20 else f"{w} ACME" for i, w in enumerate(licenses.TEMPLATES[8][1].split())), "mit"),
        (6, "nine words before it and a license under which the MIT text was released", ""),
    ]
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["_id"]: ",".join(x for x in r["labels"] if x not in r["base_labels"]) for r in licenses.scan_licenses(frame).collect()}
    assert got == {i: want for i, _, want in rows}


def test_license_templates_of_any_length(spark):
    """A class per power of two: a template of 700 words, cut short by a few and with others put in, among one of two words."""
    rng = random.Random(2)
    body = [f"w{rng.randint(0, 400)}" for _ in range(700)]
    copy = [w for i, w in enumerate(body) if i % 50]
    frame = spark.createDataFrame([(1, " ".join(["a"] * 33 + copy + ["a"] * 900)), (2, " ".join(body[:350])), (3, "short one")], "doc_id long, text string")
    found = licenses.template_matches(frame, templates=[("long", " ".join(body)), ("two", "Short One")]).collect()
    assert {(r["_id"], r["label"]) for r in found} == {(1, "long"), (3, "two")}


def test_license_places_over_lines(spark):
    text = "x\nCC\nby y general public\nLicense all rights reserved cc bye. cc-by"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = licenses.scan_licenses(frame).first()
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (4, 1, 12, ["cc-by", "gpl", "reserved"])


KINDS = (
    ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    ("access", r"(AKIA[A-Z0-9]+)", 16),
    ("hex", r"([0-9a-f]+)", 32),
)


def base_spans(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, least) in enumerate(KINDS) for m in re.finditer(p, text) if len(m[1]) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def test_secrets(spark, texts):
    for r in QUERIES["op8_secrets"](spark, SF).collect():
        spans = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s.startswith(k) for s in spans) for k, *_ in KINDS)
        assert set(spans) <= set(r["spans"].split(",")) | {""}


def test_secret_spans_of_hard_texts(spark):
    hexa = "0123456789abcdef" * 2
    rows = [
        "token=api_key: longsecret123 Password : 'abcdefgh12' 😀secret=short token==12345678",
        f"😀{hexa} AKIA{'A' * 12} AKIAAKIA{'B' * 12} x{hexa}g{hexa} token = \"{hexa}\"",
        "passwd:abcdefg\npasswd:abcdefgh" * 50,
        "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36 + " https://me:pw@host/ eyJhbGciOi00.eyJzdWIiOi00.abcdefgh",
    ]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = secrets_scan.scan(frame).select("_id", secrets_scan.span_text(F.col("findings")).alias("s")).collect()
    got = {r["_id"]: r["s"].split(",") for r in found}
    for i, text in enumerate(rows):
        assert [s for s in got[i] if s.split(":")[0] in ("assign", "access", "hex")] == base_spans(text)
    assert {s.split(":")[0] for s in got[3]} >= {"private", "github", "login", "jwt"}


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    spark.createDataFrame([], secrets_scan.LEDGER).write.parquet(ledger)
    first = spark.createDataFrame([(1, "token=12345678"), (2, "clean"), (3, "token=12345678")], "doc_id long, text string")
    rules = secrets_scan.RULES
    assert {r["_id"] for r in secrets_scan.scan(first, ledger, rules=rules[:3]).collect() if r["findings"]} == {1, 3}
    rows = lambda: spark.read.parquet(ledger).collect()
    assert len(rows()) == 2
    secrets_scan.scan(first, ledger, rules=rules[:3]).collect()
    assert len(rows()) == 2  # nothing new to scan
    more = first.unionByName(spark.createDataFrame([(4, "AKIA" + "Z" * 12)], "doc_id long, text string"))
    newer = (*rules[:3], rules[4])
    got = {r["_id"]: [f["kind"] for f in r["findings"]] for r in secrets_scan.scan(more, ledger, rules=newer).collect()}
    assert got == {1: ["assign"], 2: [], 3: ["assign"], 4: ["access"]}
    added = [sorted(r["rules"]) for r in rows()]
    assert sorted(map(len, added)) == [1, 1, 3, 3, 4]


def test_ledger_forgets_outdated_rule_versions(spark, tmp_path):
    """A rule with another pattern and a higher version finds what a fresh ledger finds; the old version still finds its own."""
    ledger = str(tmp_path / "ledger")
    spark.createDataFrame([], secrets_scan.LEDGER).write.parquet(ledger)
    docs = spark.createDataFrame([(1, "AKIA" + "Z" * 12 + " token=12345678"), (2, "AKIB" + "Y" * 12)], "doc_id long, text string")
    old = secrets_scan.RULES[:2]
    new = (old[0], old[1]._replace(version=old[1].version + 1, pattern=old[1].pattern.replace("AKIA", "AKIB")))
    spans = lambda rules, where: {r["_id"]: sorted((f["kind"], f["start"], f["end"]) for f in r["findings"]) for r in secrets_scan.scan(docs, where, rules=rules).collect()}
    first = spans(old, ledger)
    assert first == {1: [("access", 0, 16), ("assign", 17, 31)], 2: []}
    assert spans(new, ledger) == spans(new, None) == {1: [("assign", 17, 31)], 2: [("access", 0, 16)]}
    assert spans(old, ledger) == first


# --- near duplicates ---------------------------------------------------------------------------


def print_of(text):
    words = blank_words(text.translate(LOWER))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2 and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_simhash(spark, texts):
    prints = {i: print_of(t) for i, t in texts.items()}
    want = {i: (f"{prints[i]:016x}", c) for i, c in classes(prints).items()}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op6_simhash"](spark, SF).collect()} == want


def test_golay_words_within_two_bits_share_a_codeword():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    assert set(map(len, map(set, simhash.golay_indices(words)))) == {1, 6}
    other = words ^ (1 << rng.integers(0, 23, 3000)) ^ (1 << rng.integers(0, 23, 3000))
    for a, b in zip(simhash.golay_indices(words), simhash.golay_indices(other)):
        assert set(a) & set(b)


@pytest.mark.parametrize("max_bucket", [256, 4])
def test_links_connect_what_is_close(spark, max_bucket):
    """Balls of close fingerprints, more than a bucket may hold in the second run."""
    rng = random.Random(2)
    prints = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        prints += [centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) for _ in range(15)]
    prints = [p & (1 << 64) - 1 for p in prints]
    want = classes(dict(enumerate(prints)))
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    frame = spark.createDataFrame(signed, "_id long, _print long")
    group = {r["node"]: r["component"] for r in components(simhash.linked_prints(frame, max_bucket), "a", "b").collect()}
    by_group = defaultdict(set)
    for i, p in signed:
        by_group[group.get(p, p)].add(i)
    expected = defaultdict(set)
    for i, c in want.items():
        expected[c].add(i)
    assert sorted(map(sorted, by_group.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1030)] + [(5000, 5000), (7, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1030)}}


# --- decontamination ---------------------------------------------------------------------------


def test_items_in_long_documents(spark):
    """Whole, edited and partial passages at any place; all pairs at the threshold, and no others."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = {i: [word() for _ in range(rng.choice([5, 6, 9, 14, 40, 70]))] for i in range(40)}
    docs = {}
    for i in range(120):
        words = [word() for _ in range(rng.choice([3, 50, 3000]))]
        own = list(items[rng.randrange(40)])
        if rng.random() < 0.5:
            own[rng.randrange(len(own))] = "changed"
        at = rng.randint(0, len(words))
        words[at:at] = own
        docs[i] = " ".join(words).upper() if i % 5 == 0 else ", ".join(words)

    def shingles(words):
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    held = {i: shingles(re.findall(r"[a-z]+", d.lower())) for i, d in docs.items()}
    want = {(d, i) for i, w in items.items() for d in docs if len(held[d] & shingles(w)) >= 0.8 * len(shingles(w))}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id int, text string")
    for size in (2_000_000, 100):  # one block of items, several
        assert {(r["_id"], r["_item"]) for r in decontaminate.find_leaks(frame, bench, block_shingles=size).collect()} == want
    assert len(want) > 50


# --- mixing ------------------------------------------------------------------------------------


def test_targets_are_filled_by_weight(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, "d": 5, "e": 3000, None: 20}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame, (5, 2, 1), 3).collect()}
    order = ["a", "b", "c", "d", "e", None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, open_, rest = {}, set(order), sum(sizes.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 3 * sizes[s]}
        if not full:
            break
        want |= {s: 3 * sizes[s] for s in full}
        rest -= sum(3 * sizes[s] for s in full)
        open_ -= full
    want |= share
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_demand_is_inverted(spark):
    rng = random.Random(1)
    for schedule in (*mixing.SCHEDULES, ((0.0, 0.0), (0.4, 2.0), (0.4001, 0.0), (1.0, 1.0))):
        shares = [rng.random() for _ in range(50)] + [0.0, 1.0]
        frame = spark.createDataFrame([(s,) for s in shares], "share double").withColumn("o", F.lit(0))
        rows = frame.select("share", mixing.invert_demand(mixing._at([schedule], F.col("o")), F.col("share")).alias("t")).collect()
        grid = np.linspace(0, 1, 400_001)
        rate = np.interp(grid, *zip(*schedule))
        done = np.append(0, np.cumsum((rate[1:] + rate[:-1]) / 2))
        for r in rows:
            assert np.interp(r["t"], grid, done / done[-1]) == pytest.approx(r["share"], abs=2e-5)


def test_mixture_follows_schedule_and_targets(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(1, 30), "abc"[min(i % 7, 2)]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, buckets=16).collect()
    place = [r["position"] for r in mixed]
    assert place == sorted(place)
    taken = mixing.take_documents(docs, buckets=16).withColumn("taken", F.col("size") * F.col("_times"))
    for r in taken.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect():
        assert abs(r["taken"] - r["target"]) <= 30
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    early = Counter(r["source"] for r in mixed if r["position"] < 0.5)
    late = Counter(r["source"] for r in mixed if r["position"] >= 0.5)
    assert early["a"] > 1.3 * late["a"] and late["c"] > 1.3 * early["c"]
    again = mixing.mix(docs.repartition(7), buckets=16).collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in mixed]


def test_op4_counts_places_in_the_training_order(spark, tmp_path, monkeypatch):
    """The words that the query reports are those of the range-sorted order: take a pass away there and they are gone."""
    rng = random.Random(3)
    rows = [(i % 400, "w " * rng.randint(0, 9) if i % 50 else None, rng.choice(["a", "b", None])) for i in range(420)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    want = Counter((r["_id"], r["size"], r["size"] * r["_times"]) for r in mixing.take_documents(docs).collect())
    got = QUERIES["op4_mixing"](spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == want
    order = mixing.training_positions
    monkeypatch.setattr(mixing, "training_positions", lambda *a: order(*a).where("pass_no = 0"))
    once = QUERIES["op4_mixing"](spark, str(tmp_path)).collect()
    assert all(r["taken"] in (0, r["size"]) for r in once) and any(r["taken"] > r["size"] for r in got)
    places = [r["position"] for r in mixing.training_order(mixing.take_documents(docs)).collect()]
    assert places == sorted(places) and len(places) > 100


# --- html and tokens ---------------------------------------------------------------------------


def test_pages(spark):
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op9_html"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", rows[r["page_id"]], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", article)).split())
        assert (r["text"], r["n_chars"]) == (want, len(want))


HARD = {
    "<div id=main><p>One, two, and three of them.</p><p>Four <i>fi</i>ve</p></div><div class='user-comments'><p>no, no, no</p></div>": "One, two, and three of them. Four five",
    "<body><div class=sideBar><p>menu, menu, menu</p></div><div>Plain text, no tags<br>next</div><footer><p>f, f</p></footer>": "Plain text, no tags next",
    "<main><section><p>First, part.</p></section><section><p>Second.</p></section><form>q</form><aside>a</aside></main>": "First, part. Second.",
    "<p>a &lt;b&gt; &amp; c&nbsp;d &#233;</p><script>var x = '</p>';</script><style>p{}</style>": "a <b> & c d é",
    "<ul><li><a href=x>link</a><li><a>link</a></ul><div><p>Text, enough of it here to win, surely.</p></div>": "Text, enough of it here to win, surely.",
    "<!-- c --><p title='>'>x<p hidden>y<p>z": "x z",
    "text < 5 and <b>more": "text < 5 and more",
    "": "",
    "<div><nav>n</nav></div>": "",
    "<body><form id=aspnetForm><nav>m</nav><div><p>One, two.</p><p>Three <input>four.</p></div><label>l</label></form>": "One, two. Three four.",
    "<main><article><p>First, long, of the two.</p></article><article><p>Second.</p></article><article class=teaser>t</article></main>": "First, long, of the two. Second.",
    "<body><article><p>Text, of it.</p></article><form><p>Name, mail</p><p>Send, now</p></form></body>": "Text, of it.",
    "<article><p>Some text, here.</p><div class='related-work'><p>Others did it.</p></div><p class='share-price'>It fell.</p><section id='discussion'><h2>Discussion</h2><p>We saw.</p></section></article>": "Some text, here. Others did it. It fell. Discussion We saw.",
    "<article><p>Some text, here.</p><div class='related-posts'><p>x</p></div><div id='discussion'>Talk<div class='comment'>c</div></div><div class='share-icons-row'>s</div><p class='related-gems'><a>l</a></p></article>": "Some text, here.",
    "<div class='sidebar left'><p>s, s, s</p></div><div class='page sidebar-open'><p>Text, text.</p></div>": "Text, text.",
    "<article><p>Outer, one.</p><article><p>Inner, with, many, commas.</p></article></article>": "Outer, one. Inner, with, many, commas.",
    "<main><h1>Head</h1><article><p>Body, text.</p></article><ul><li><a>more</a></ul></main>": "Head Body, text.",
}


@pytest.mark.parametrize("page", HARD)
def test_hard_pages(page):
    assert html_text.main_text(page) == HARD[page]


WORDS = "river stone paper light window garden letter market engine silver".split()
AROUND = (
    lambda r: f"<nav><ul>{''.join(f'<li><a href=x>{w}</a>' for w in r.sample(WORDS, 5))}</ul></nav>",
    lambda r: f"<div class='{r.choice(['ad', 'top-banner', 'cookie-notice', 'sidebar left', 'newsletterBox'])}'><p>zz, {r.choice(WORDS)}, zz</p></div>",
    lambda r: f"<footer><p>zz {r.choice(WORDS)}</p></footer>",
    lambda r: "<script>if (a < b) document.write('<p>zz</p>');</script><style>p > b {}</style><!-- <p>zz</p> -->",
    lambda r: "<form action=x><p>zz, your mail</p><input><select><option>zz</select></form>",
    lambda r: f"<section class='{r.choice(['comments', 'user-comments', 'commentList'])}'><div><p>zz, I say, {r.choice(WORDS)}.</p></div></section>",
    lambda r: "<p hidden>zz</p><div role=navigation>zz</div><aside>zz, zz</aside>",
)


def planted_page(rng):
    """A page and the text of its article, known because it was put there."""
    shown, said = [], []
    for _ in range(rng.randint(3, 12)):
        words = [rng.choice(WORDS) + rng.choice(["", "", ","]) for _ in range(rng.randint(8, 60))]
        text = " ".join(words) + " &amp; so."
        kind = rng.randint(0, 4)
        inline = text.replace(words[2] + " ", f"<{rng.choice(['b', 'em', 'span'])}>{words[2]}</b></em></span> ", 1) if kind == 0 else text
        shown.append({1: f"<blockquote><p>{text}</p></blockquote>", 2: f"<ul><li>{text}</ul>", 3: f"<p>{text}"}.get(kind, f"<p>{inline}</p>"))
        said.append(html.unescape(text))
    middle = rng.randint(1, len(shown) - 1)
    noise = lambda: "".join(f(rng) for f in rng.sample(AROUND, rng.randint(0, 3)))
    body = "\n ".join(shown[:middle]) + noise() + "\n".join(shown[middle:])
    around = rng.choice(["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<main><article>{}</article></main>"])
    page = f"<div class=wrap>{noise()}{around.format(body)}{noise()}</div>"
    if rng.random() < 0.2:
        page = f"<form id=all method=post>{page}<input type=hidden></form>"
    return f"<!DOCTYPE html><html><head><title>zz</title></head><body>{noise()}{page}{noise()}</body></html>", " ".join(" ".join(said).split())


def test_planted_pages():
    rng = random.Random(8)
    for _ in range(500):
        page, want = planted_page(rng)
        assert html_text.main_text(page) == want, page


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 20_000 + "deep, very deep") == "deep, very deep"
    body = "".join(f"<p>Sentence {i}, with a comma.</p>" for i in range(5000))
    assert len(html_text.main_text(f"<article>{body}</article>").split()) == 5 * 5000


def test_tokens(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in QUERIES["op10_tokens"](spark, SF).collect():
        text = texts[r["doc_id"]]
        n = len(model.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)


def test_transducer_equals_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    small = tokens.Transducer(tokens.load_pieces(MODEL), max_states=500, max_words=100)
    rng = random.Random(3)
    pieces = [model.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    signs = "abcdeghinorst ▁ééÉ\n\t日本語12300-_/=<>sŚ😀"
    for n in range(3000):
        pool, most = (pieces, 12) if n % 2 else (signs, 60)
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, most)))
        words = tokens.WORDS.findall(("▁" + text.replace(" ", "▁")) if text else "")
        assert small.count(words) == len(model.encode(text)), text


def test_chunks_join_at_any_border(spark, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_CHARS", 3)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = ["tokenization is   hard  ", "averyverylongwordwithoutanyblank", "日本語 テキスト", "a b c d", "   ", "x"]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["_id"]: r["n_tokens"] for r in tokens.count_tokens(frame, MODEL).collect()}
    assert got == {i: len(model.encode(t)) for i, t in enumerate(rows)}


def test_chunks_are_counted_once(spark):
    """One pass makes the chunk maps, one counts the seams."""
    frame = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    plan = tokens.count_tokens(frame, MODEL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2
