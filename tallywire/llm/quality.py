"""Quality rules with risk-controlled cutoffs.

Each rule is a whole-number signal of a text (per mille of symbols, punctuation, capitals, repeated lines, repeated
words). Labelled documents are split in two by a hash of their id. On one half the cutoff of a rule is tuned per
stratum (language): the one that catches most bad documents, good ones counting `good_cost` times against it. On the
other half, the holdout, cutoffs are certified from the loosest to the tuned one: with k of n good documents rejected, a
cutoff passes if the exact binomial probability of k or fewer at a true rate `alpha` is at most
delta / (rules x strata), which is the statement that the Clopper-Pearson upper bound is at most alpha. Testing runs
along the cutoffs in a fixed order and stops at the first that fails, so one path costs one share of delta; the
Bonferroni shares cover all paths. With probability 1 - delta, no rule rejects more than `alpha` of the good
documents of any stratum. Strata with too few labels to certify anything reject nothing.

The counts are exact over all labelled rows. A path has at most 1001 cutoffs whatever the input.

Edge cases: null and empty texts have no words and fail the base rule. Labels without an id or quality are ignored; of
several labels of one id the lowest counts. Null strata form a stratum. No labels: only the base rule rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywire.llm.text import packed, text_key, unpacked, words_of, written

RULES = ("symbols", "punctuation", "capitals", "repeated_lines", "repeated_words")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: bits of a packed value that hold the position of a window: texts up to 268 million words
POSITION_BITS = 28


def _dropped(text: Column, chars: str) -> Column:
    """Code points of the class."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]+", ""))


def _repeated_at(hashes: Column, shift: int) -> Column:
    """Positions whose 36 hash bits from `shift` on occur more than once, found by sorting (bits, position)."""
    mask = (1 << POSITION_BITS) - 1
    packed = F.sort_array(
        F.transform(hashes, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, shift), POSITION_BITS).bitwiseOR(i.cast("long")))
    )

    def pick(p: Column) -> Column:
        def repeats(x: Column, i: Column) -> Column:
            own = F.shiftright(x, POSITION_BITS)
            return (F.shiftright(F.get(p, i - 1), POSITION_BITS) == own) | (F.shiftright(F.get(p, i + 1), POSITION_BITS) == own)

        return F.transform(F.filter(p, repeats), lambda x: x.bitwiseAND(F.lit(mask)))

    # the array of one element binds the sorted values to a name, so they are sorted once
    return F.transform(F.array(packed), pick)[0]


def covered_by_repeats(hashes: Column, window: int = 3) -> Column:
    """Words lying in windows that occur more than once; `hashes` are those of the windows, by position.

    Two sorts by different 36 bits of the 64 must both find a position repeated.
    """
    both = F.sort_array(F.array_intersect(_repeated_at(hashes, 0), _repeated_at(hashes, 64 - 36)))
    start = F.struct(F.lit(-window).cast("long").alias("last"), F.lit(0).cast("long").alias("sum"))
    total = F.aggregate(
        both,
        start,
        lambda s, x: F.struct(x.alias("last"), (s["sum"] + F.least(F.lit(window).cast("long"), x - s["last"])).alias("sum")),
        lambda s: s["sum"],
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(total)


def with_signals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` and its base figures (BASE), base_failed, and one column for each of RULES, prefixed by rule_."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    frame = docs.withColumns({"_words": words_of(text), "_lines": lines})
    w = F.col("_words")
    frame = frame.withColumn(
        "_hashes",
        F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.slice(w, F.lit(1), F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        ),
    )
    frame = frame.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": _dropped(text, r"#*$%&|<>").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered_by_repeats(F.col("_hashes")),
            "_n_lines": F.size("_lines"),
            "_marks": _dropped(text, r"!-/:-@\[-`{-~"),
            "_capitals": _dropped(text, "A-Z"),
        }
    )

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part) * 1000, F.col(whole)), F.lit(0)).cast("int")

    return frame.withColumns(
        {
            "base_failed": (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
            "rule_symbols": share("n_symbols", "word_chars"),
            "rule_punctuation": share("_marks", "word_chars"),
            "rule_capitals": share("_capitals", "word_chars"),
            "rule_repeated_lines": share("n_dup_lines", "_n_lines"),
            "rule_repeated_words": share("n_repeat_words", "n_words"),
        }
    ).drop("_words", "_lines", "_hashes", "_n_lines", "_marks", "_capitals")


def _stratum(name: str) -> Column:
    """A key for every value, null too."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def log_binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """ln P(X <= k) for X ~ Bin(n, p), summed exactly term by term in logarithms."""
    odds = F.log(F.lit(p / (1 - p)))

    def add(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(s["sum"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(-F.abs(s["sum"] - term)))).alias("sum"))

    start = F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("sum"))
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return n * F.log(F.lit(1 - p)) + F.aggregate(steps, start, add, lambda s: s["sum"])


def fit_cutoffs(
    signals: DataFrame,
    labels: DataFrame,
    stratum_col: str = "lang",
    id_col: str = "doc_id",
    alpha: float = 0.01,
    delta: float = 0.05,
    good_cost: int = 5,
) -> DataFrame:
    """stratum, rule, cutoff, n, k: rows for certified paths only. Values above the cutoff are rejected.

    `signals` is narrow (no texts); `labels` has the id and quality 0 or 1.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy(F.col(id_col).alias("_labelled")).agg(F.min("quality").alias("_quality"))
    rows = signals.where(~F.col("base_failed")).join(known, F.col(id_col) == F.col("_labelled"))
    tuning = F.md5(F.col(id_col).cast("string").cast("binary")) < "8"
    good, bad = F.col("_quality") > 0, F.col("_quality") <= 0
    counts = rows.select(
        _stratum(stratum_col).alias("stratum"),
        (tuning & good).cast("int").alias("tg"),
        (tuning & bad).cast("int").alias("tb"),
        (~tuning & good).cast("int").alias("hg"),
        F.posexplode(F.array(*[F.col(f"rule_{r}") for r in RULES])).alias("rule", "value"),
    )
    counts = counts.groupBy("stratum", "rule", "value").agg(*[F.sum(c).cast("long").alias(c) for c in ("tg", "tb", "hg")])
    path = Window.partitionBy("stratum", "rule")
    above = path.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    cuts = counts.withColumns(
        {
            "gain": F.coalesce(F.sum(F.col("tb") - good_cost * F.col("tg")).over(above), zero),
            "k": F.coalesce(F.sum("hg").over(above), zero),
            "n": F.sum("hg").over(path),
        }
    )
    cuts = cuts.withColumn("best", F.max(F.struct("gain", "value")).over(path))
    cuts = written(cuts.where((F.col("best.gain") > 0) & (F.col("value") >= F.col("best.value"))), "cutoff-paths")
    strata = rows.agg(F.greatest(F.count_distinct(_stratum(stratum_col)), F.lit(1)).alias("n")).scalar()
    # a rate of k / n at or above alpha cannot pass; only the others are summed
    bound = F.when(F.col("k") < alpha * F.col("n"), log_binomial_cdf(F.col("n"), F.col("k"), alpha))
    passing = cuts.withColumn("passes", bound <= F.log(F.lit(delta / len(RULES)) / strata))
    passing = passing.where("passes").groupBy("stratum", "rule").agg(F.min(F.struct("value", "n", "k")).alias("x"))
    return passing.select("stratum", "rule", F.col("x.value").alias("cutoff"), "x.n", "x.k")


def with_verdict(signals: DataFrame, cutoffs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """`signals` and kept: neither the base rule nor a certified cutoff rejects.

    The cutoffs come as one value, at most one row per rule and certified stratum: a stratum needs hundreds of labelled
    good documents to be there, so their number is bounded by the labels, not by the documents.
    """
    by_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cut"))
    every = by_stratum.agg(F.map_from_entries(F.collect_list(F.struct("stratum", "cut")))).scalar()
    frame = signals.withColumn("_cut", F.try_element_at(every, _stratum(stratum_col)))
    over = F.lit(False)
    for i, rule in enumerate(RULES):
        over = over | F.coalesce(F.col(f"rule_{rule}") > F.try_element_at("_cut", F.lit(i)), F.lit(False))
    return frame.withColumn("kept", ~F.col("base_failed") & ~over).drop("_cut")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", **how) -> DataFrame:
    """id, stratum, _row (tells the texts of one id apart), base figures, signals and kept of every row.

    The signals are written once and read twice: to fit the cutoffs and to apply them.
    """
    narrow = docs.select(F.col(id_col), F.col(stratum_col), F.col(text_col), text_key(F.col(text_col)).alias("_row"))
    signals = written(with_signals(narrow, text_col).drop(text_col), "signals")
    return with_verdict(signals, fit_cutoffs(signals, labels, stratum_col, id_col, **how), stratum_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", **how) -> DataFrame:
    """`docs` without the rejected rows."""
    judged = judge(docs, labels, id_col, text_col, stratum_col, **how)
    lost = judged.where(~F.col("kept")).select(F.col(id_col).alias("_id"), F.col(stratum_col).alias("_in"), F.col("_row").alias("_lost")).distinct()
    lost = written(lost, "rejected")
    tagged = docs.select(
        packed(docs), F.col(id_col).alias("_key"), F.col(stratum_col).alias("_key_in"), text_key(F.col(text_col)).alias("_key_row")
    )
    same = F.col("_key").eqNullSafe(F.col("_id")) & F.col("_key_in").eqNullSafe(F.col("_in")) & (F.col("_key_row") == F.col("_lost"))
    # the rejected rows grow with the documents: a shuffled join at every size
    return tagged.join(lost.hint("merge"), same, "left_anti").select(*unpacked(docs))
