"""Secret scans with an incremental blob ledger.

Every version of a path is addressed by the SHA-256 of its text. The ledger says which rules, by name and version,
have seen which blob and what they found. A scan looks only at pairs of blob and rule version that the ledger does not
hold, once per blob however many paths or versions share it, appends what it found (also nothing), and joins the
ledger's findings back to all paths. A new rule version, or a new blob, is all that a later run has to read.

The ledger is append-only: a run that dies before its append leaves nothing, a repeated append of the same pairs
changes no result, because findings are taken as a set.

Spans are code-point offsets. `split` gives the text between matches and `regexp_extract_all` the matches; running
sums of both lengths, over the matches of one blob and rule, are the offsets.

Edge cases: null text is the empty blob. Paths may be null or repeat; each row keeps its own findings.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywire.llm.text import written
from tallywire.session import scratch_path


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    min_chars: int = 0  # of the group; shorter matches are dropped after matching
    group: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: leftmost matches without overlap, per rule; the order of the list breaks ties of start
RULES = (
    Rule(
        "assign", 1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16),
    Rule("hex", 1, r"[0-9a-f]{32,}"),  # maximal runs, the short ones never matched
    Rule("private", 1, r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("login", 1, r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/@]{1,64}@"),
)

LEDGER = "blob string, rules array<string>, findings array<struct<rule:string,kind:string,start:long,end:long>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _matches(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, _text, _want) -> one row per match that counts: blob, kind, start, end."""
    found = []
    for rule in rules:
        # a rule that is not wanted for this blob is not evaluated
        hit = F.when(F.array_contains("_want", rule.key), F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(0)))
        found.append(hit.alias(f"_hit_{rule.kind}"))
    frame = texts.select("blob", "_text", *found)
    cells = []
    for rule in rules:
        hits = F.col(f"_hit_{rule.kind}")
        values = F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits
        zipped = F.arrays_zip(hits.alias("hit"), values.alias("value"), F.split("_text", rule.pattern).alias("before"))
        cell = F.struct(
            F.lit(rule.key).alias("rule"),
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.min_chars).alias("min"),
            F.slice(zipped, F.lit(1), F.size(hits)).alias("all"),
        )
        cells.append(F.when(F.size(hits) > 0, cell))
    kinds = frame.select("blob", F.explode(F.array_compact(F.array(*cells))).alias("x"))
    rows = kinds.select("blob", "x.rule", "x.kind", "x.min", F.posexplode("x.all").alias("i", "m")).select(
        "blob",
        "rule",
        "kind",
        "i",
        F.length("m.before").cast("long").alias("gap"),
        F.length("m.hit").cast("long").alias("len"),
        (F.length("m.value") >= F.col("min")).alias("counts"),
    )
    # repeated rows of one id would be scanned twice
    rows = rows.dropDuplicates(["blob", "kind", "i"])
    upto = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("len")).over(upto)
    spans = rows.withColumn("end", end).where("counts")
    return spans.select("blob", F.struct("rule", "kind", (F.col("end") - F.col("len")).alias("start"), "end").alias("finding"))


def scan(
    docs: DataFrame,
    ledger: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """_id, blob, findings (kind, start, end; by start, then in the order of the rules) of every row of `docs`.

    `ledger` is the folder of the ledger; without one, a new ledger is started below the shared folder.
    """
    spark = docs.sparkSession
    if ledger is None:
        ledger = scratch_path(spark, "blob-ledger")
        spark.createDataFrame([], LEDGER).write.parquet(ledger)
    paths = written(docs.select(F.col(id_col).alias("_id"), blob_of(F.col(text_col)).alias("blob")), "paths")
    seen = spark.read.schema(LEDGER).parquet(ledger).select("blob", F.explode("rules").alias("rule"))
    seen = seen.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    keys = F.array(*[F.lit(r.key) for r in rules])
    todo = paths.groupBy("blob").agg(F.min("_id").alias("_one")).join(seen, "blob", "left")
    todo = todo.withColumn("want", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
    todo = written(todo.where(F.size("want") > 0).select("blob", "_one", "want"), "unseen")

    # the id spreads the copies of a blob; only the row that stands for it is joined
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    texts = texts.withColumn("_blob", blob_of(F.col("_text")))
    texts = texts.join(todo, (F.col("_blob") == F.col("blob")) & F.col("_id").eqNullSafe(F.col("_one")))
    found = _matches(texts.select("blob", "_text", F.col("want").alias("_want")), rules)
    found = found.groupBy("blob").agg(F.collect_list("finding").alias("findings"))
    rows = todo.join(found, "blob", "left").select(
        "blob", F.col("want").alias("rules"), F.coalesce("findings", F.array().cast("array<struct<rule:string,kind:string,start:long,end:long>>")).alias("findings")
    )
    rows.write.mode("append").parquet(ledger)

    known = spark.read.schema(LEDGER).parquet(ledger)
    # findings of other versions of a rule stay in the ledger and are not read
    known = known.select("blob", F.explode("findings").alias("f")).where(F.col("f.rule").isin([r.key for r in rules]))
    place = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("f.kind"))
    by_blob = known.groupBy("blob").agg(
        F.array_sort(F.collect_set(F.struct("f.start", place.alias("place"), "f.end", "f.kind"))).alias("_all")
    )
    by_blob = by_blob.select(
        F.col("blob").alias("_b"),
        F.transform("_all", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("findings"),
    )
    joined = paths.join(by_blob, F.col("blob") == F.col("_b"), "left")
    return joined.select("_id", "blob", F.coalesce("findings", F.array().cast("array<struct<kind:string,start:long,end:long>>")).alias("findings"))


def span_text(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
