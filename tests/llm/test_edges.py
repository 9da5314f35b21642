"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
import public_tokenizers
from pyspark.sql import functions as F

from tallywire.llm import decontaminate, html_text, hyperminhash, licenses, line_dedup, mixing, quality, secrets_scan, simhash, substrings, tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"w{i}" for i in range(30_000))
CLASH = "n_lines n_dropped n_words n_removed kept size position pass_no component _all _key _drop _keep _text _w _id _row main_text".split()
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASH)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * len(CLASH)) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """A null id, null text, empty text, blanks only, repeated rows, one id with two texts, a very long text."""
    rows = [
        (None, "a text without id", None, None),
        (1, None, "en", "s"),
        (2, "", "en", None),
        (3, " \t\n \r\n", None, "s"),
        (4, "Same row. All rights reserved.", "en", "s"),
        (4, "Same row. All rights reserved.", "en", "s"),
        (4, "another text of the same id", "en", "t"),
        (5, LONG, "en", "s"),
        (6, "héé 日本 😀 ﬁ   x", "fr", "t"),
    ]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(None, 1, 0), (1, None, 0), (5, 1, 0), (5, 0, 0), (99, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(None, "w7 w8 w9 w10 w11 w12 w13"), (1, None), (2, ""), (3, "w1 w2"), (4, "W100, w101; w102 w103 w104 w105 w106")]
    return spark.createDataFrame(rows, "item_id long, text string")


def runs(spark, docs, labels, items):
    return {
        "quality": quality.judge(docs, labels),
        "keep_good": quality.keep_good(docs, labels),
        "substrings": substrings.drop_repeats(docs),
        "licenses": licenses.scan_licenses(docs),
        "mix": mixing.mix(docs),
        "take": mixing.take_documents(docs),
        "lines": line_dedup.dedup_lines(docs),
        "simhash": simhash.near_duplicates(docs),
        "keep_one": simhash.keep_one(docs),
        "hyperminhash": hyperminhash.near_duplicates(docs),
        "hyper_keep_one": hyperminhash.keep_one(docs),
        "leaks": decontaminate.find_leaks(docs, items),
        "drop_leaks": decontaminate.drop_leaks(docs, items),
        "secrets": secrets_scan.scan(docs),
        "html": html_text.extract_text(docs.withColumnRenamed("text", "html")),
        "tokens": tokens.count_tokens(docs, MODEL),
    }


def test_odd_rows(spark, odd, labels, items):
    got = {name: df.collect() for name, df in runs(spark, odd, labels, items).items()}
    n = odd.count()
    for name in ("quality", "substrings", "licenses", "take", "lines", "simhash", "hyperminhash", "secrets", "html", "tokens"):
        assert len(got[name]) == n, name
    # texts of fewer than 50 words fail the base rule; the long one has no repeats
    assert [r["doc_id"] for r in got["keep_good"]] == [5]
    assert all(r["n_removed"] == 0 for r in got["substrings"])
    assert sorted((r["_id"] or 0, r["n_base"], r["first_word"]) for r in got["licenses"] if r["n_base"]) == [(4, 1, 2), (4, 1, 2)]
    assert {r["text"] for r in got["lines"] if r["doc_id"] in (1, 2)} == {""}
    assert {r["n_lines"] for r in got["lines"] if r["doc_id"] == 3} == {3}
    zero = [r for r in got["simhash"] if r["_print"] == 0]
    assert {r["_id"] for r in zero} == {1, 2, 3} and {r["component"] for r in zero} == {1}
    assert sorted(r["doc_id"] or 0 for r in got["keep_one"]) == [0, 1, 4, 4, 4, 5, 6]
    # texts without words link with nothing, repeated rows with each other
    assert {(r["_id"], r["component"]) for r in got["hyperminhash"] if r["_n"] == 0} == {(1, 1), (2, 2), (3, 3)}
    assert sorted(r["doc_id"] or 0 for r in got["hyper_keep_one"]) == [0, 1, 2, 3, 4, 4, 4, 5, 6]
    assert sorted((r["_id"], r["_item"] or 0) for r in got["leaks"]) == [(5, 0), (5, 4)]
    assert 5 not in {r["doc_id"] for r in got["drop_leaks"]} and len(got["drop_leaks"]) == n - 1
    assert all(r["findings"] == [] for r in got["secrets"])
    assert {(r["_id"], r["n_bytes"], r["n_tokens"]) for r in got["tokens"] if r["_id"] in (1, 2)} == {(1, 0, 0), (2, 0, 0)}
    assert all(r["_times"] == 0 for r in got["take"] if r["size"] == 0)
    # clashing columns keep their values unless a result has the name
    assert {r["_drop"] for r in got["lines"]} == {"x"} and {r["_all"] for r in got["substrings"]} == {"x"}
    assert {r["_key"] for r in got["mix"]} == {"x"} and all(0 <= r["position"] <= 1 for r in got["mix"])


def test_empty_tables(spark, odd, labels, items):
    none = odd.where(F.lit(False))
    for name, df in runs(spark, none, labels.where(F.lit(False)), items.where(F.lit(False))).items():
        assert df.collect() == [], name


def test_no_benchmark_and_no_labels(spark, odd, labels, items):
    assert decontaminate.find_leaks(odd, items.where(F.lit(False))).collect() == []
    assert quality.keep_good(odd, labels.where(F.lit(False))).count() == 1
