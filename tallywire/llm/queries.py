"""One query per operator over the given tables, with its SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.llm import (
    decontaminate,
    hard_negatives,
    html_text,
    hyperminhash,
    licenses,
    line_dedup,
    mixing,
    quality,
    secrets_scan,
    simhash,
    substrings,
    tokens,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; only the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)


SQL_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


@query(
    "op4_mixing",
    f"""
    WITH d AS (SELECT doc_id, source, {SQL_SIZE} AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    o AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s),
    w AS (SELECT *, [5, 2, 1][place % 3 + 1] AS weight, 3 * source_size AS bound FROM o),
    f AS (SELECT *, sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY bound / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (ORDER BY bound / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM w),
    l AS (SELECT *, rest * weight >= bound * weights AS filled FROM f),
    v AS (SELECT rest, weights FROM l WHERE NOT filled ORDER BY bound / weight, place LIMIT 1),
    t AS (SELECT l.source, l.source_size, CASE WHEN filled THEN bound::DOUBLE ELSE (v.rest * weight)::DOUBLE / v.weights::DOUBLE END AS target
        FROM l LEFT JOIN v ON true),
    a AS (SELECT d.*, source_size, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR), doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
        CASE WHEN size = 0 THEN 0 ELSE size * (least(floor(target / source_size), 3)
            + CASE WHEN ahead + size / 2 < target - least(floor(target / source_size), 3) * source_size THEN 1 ELSE 0 END) END::BIGINT AS taken
    FROM a""",
)
def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words taken are those of the document's places in the training order."""
    return mixing.trained(table(spark, sf, "documents")).select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("_passes")).alias("taken")
    )


@query(
    "op5_line_dedup",
    r"""
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    j AS (SELECT k.*, s.key IS NOT NULL AND doc_id <> s.last AS dropped FROM k LEFT JOIN s USING (key))
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM j GROUP BY doc_id""",
)
def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf, "documents"))
    return groups.select(
        F.col("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op1_quality")
def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept")


@query("op3_licenses")
def op3_licenses(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets_scan.scan(table(spark, sf, "documents"))
    base = ("assign", "access", "hex")
    kinds = F.transform("findings", lambda f: f["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in base]
    spans = secrets_scan.span_text(F.filter("findings", lambda f: f["kind"].isin(*base)))
    return found.select(
        F.col("_id").alias("doc_id"), *counts, F.sha2(spans, 256).alias("base_sha256"), secrets_scan.span_text(F.col("findings")).alias("spans")
    )


@query("op9_html")
def op9_html(spark: SparkSession, sf: str) -> DataFrame:
    found = html_text.extract_text(table(spark, sf, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


@query("op10_tokens")
def op10_tokens(spark: SparkSession, sf: str) -> DataFrame:
    counts = tokens.count_tokens(table(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return counts.select(F.col("_id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


#: words of letters, digits and characters beyond ASCII
SQL_WORDS = r"[w FOR w IN regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> '']"
SQL_SHINGLES = "SELECT DISTINCT {0}, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS s FROM {1}"


@query(
    "op7_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    b AS (SELECT item_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
    ds AS ({SQL_SHINGLES.format("doc_id", "d")}), bs AS ({SQL_SHINGLES.format("item_id", "b")}),
    n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
    m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_shingles, n_shared FROM m JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles""",
)
def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    leaks = decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return leaks.select(F.col("_id").alias("doc_id"), F.col("_item").alias("item_id"), "n_shingles", "n_shared")


SQL_BLANKS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op2_substring_dedup",
    f"""
    WITH d AS (SELECT doc_id, {SQL_BLANKS} AS w FROM documents),
    p AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, unnest([array_to_string(w[j:j + 19], ' ') FOR j IN range(1, len(w) - 18)]) AS s FROM d),
    f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS later FROM p),
    x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
    c AS (SELECT x.*, coalesce(sum(later::INT) OVER (PARTITION BY x.doc_id ORDER BY x.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
        FROM x LEFT JOIN f ON x.doc_id = f.doc_id AND x.i = f.i),
    k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
    SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)""",
)
def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = substrings.drop_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL_FINITE = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"


def _codebook_sql(rounds: int = 4, entries: int = 256) -> str:
    """Lloyd's rounds, one after the other, over the parts as lists of whole doubles."""
    nearest = """SELECT p.vec_id, p.part, p.x, min_by(e.entry, (list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, e.x) + list_dot_product(e.x, e.x)) * 256 + e.entry) AS entry,
        min(list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, e.x) + list_dot_product(e.x, e.x)) AS err
        FROM p JOIN b{0} e USING (part) GROUP BY p.vec_id, p.part, p.x"""
    update = """b{1} AS MATERIALIZED (SELECT part, entry, coalesce(n.x, o.x) AS x FROM b{0} o LEFT JOIN
        (SELECT part, entry, list(m ORDER BY i) AS x FROM (SELECT part, entry, i, floor(sum(v) / count(*)) AS m
            FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{0}) GROUP BY part, entry, i) GROUP BY part, entry) n USING (part, entry))"""
    steps = [f"a{k} AS MATERIALIZED ({nearest.format(k)}), {update.format(k, k + 1)}" for k in range(rounds)]
    return f"""
    WITH v AS (SELECT vec_id, label, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS x FROM embeddings WHERE {SQL_FINITE}),
    p AS MATERIALIZED (SELECT vec_id, part, x[part * len(x) // 4 + 1:(part + 1) * len(x) // 4] AS x FROM v, range(4) r(part)),
    f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {entries}),
    b0 AS MATERIALIZED (SELECT part, entry, x FROM p JOIN f USING (vec_id)),
    {", ".join(steps)},
    a{rounds} AS MATERIALIZED ({nearest.format(rounds)}),
    c AS (SELECT vec_id, string_agg(lower(lpad(hex(entry), 2, '0')), '' ORDER BY part) AS code, sum(err)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
    h AS (SELECT sha256(string_agg(array_to_string([y::BIGINT FOR y IN x], ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM c JOIN v USING (vec_id), h"""


@query("op11_vector_codes", _codebook_sql())
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded, books = vector_codes.encode(table(spark, sf, "embeddings"))
    return coded.select(
        F.col("_id").alias("vec_id"), "code", "error", "label_error", F.lit(vector_codes.codebook_digest(books)).alias("codebooks_sha256")
    )


@query(
    "op12_hard_negatives",
    f"""
    WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS x FROM embeddings WHERE label IS NOT NULL AND {SQL_FINITE}),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
        FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10""",
)
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query(
    "op13_hyperminhash",
    r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s FROM d),
    n AS MATERIALIZED (SELECT doc_id, count(s) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id),
    m AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM m JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(doc_id, reached) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reached = e.a)
    SELECT doc_id, n AS n_shingles, min(reached) AS component_id, doc_id = min(reached) AS kept FROM r JOIN n USING (doc_id) GROUP BY doc_id, n""",
)
def op13_hyperminhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = hyperminhash.near_duplicates(table(spark, sf, "documents"))
    return groups.select(
        F.col("_id").alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        hyperminhash.is_kept(F.col("_id"), F.col("component")).alias("kept"),
    )
