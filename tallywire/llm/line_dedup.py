"""Line dedup: lines that many documents share stay only in the last of these documents.

Lines are exploded and normalised, hashed, counted by distinct document, and the documents are put together
again by line position. Only hashes, ids and positions are shuffled before the last step; a line that a third of
the documents hold is folded by task before it is counted, and its join to the positions is split by adaptive execution.

Edge cases: null and empty texts are one empty line. Keys shorter than `min_chars` never count. Rows of one id are
one document, whatever their texts; a null id is a document of its own, before all others. Extra columns pass; n_lines and n_dropped
replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.llm.text import kept_positions, lower_ascii, packed, text_key, trim_spaces, unpacked, words_at, written


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """_doc, _row, _pos and a 128-bit hash of every line whose key is long enough."""
    text = F.col(text_col)
    return (
        docs.select(F.col(id_col).alias("_doc"), text_key(text).alias("_row"), F.posexplode(lines_of(text)).alias("_pos", "_line"))
        .where(F.length("_line") >= min_chars)
        .select("_doc", "_row", "_pos", lower_ascii(trim_spaces(F.col("_line"))).alias("_key"))
        .where(F.length("_key") >= min_chars)
        .select("_doc", "_row", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("line"), "_key").alias("_h2"))
    )


def shared_lines(keys: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least `min_docs` documents, with the largest id holding them."""
    return (
        keys.groupBy("_h1", "_h2", "_doc").agg(F.lit(1).alias("_one"))
        .groupBy("_h1", "_h2").agg(F.count("_one").alias("_docs"), F.max("_doc").alias("_last"))
        .where(F.col("_docs") >= min_docs)
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """`docs` with the text of the kept lines, and n_lines (before) and n_dropped behind its columns."""
    keys = written(line_keys(docs, id_col, text_col, min_chars), "line-keys")
    shared = written(shared_lines(keys, min_docs), "shared-lines")
    drops = (
        keys.join(shared, ["_h1", "_h2"])
        .where(~F.col("_doc").eqNullSafe(F.col("_last")))
        .groupBy("_doc", "_row")
        .agg(F.collect_set("_pos").alias("_drop"))
    )
    tagged = docs.select(
        packed(docs, text_col),
        F.col(id_col).alias("_key_doc"),
        text_key(F.col(text_col)).alias("_key_row"),
        F.coalesce(text_col, F.lit("")).alias("_text"),
    )
    joined = tagged.join(
        drops, F.col("_key_doc").eqNullSafe(F.col("_doc")) & (F.col("_key_row") == F.col("_row")), "left"
    )
    parts = joined.withColumn("_lines", lines_of(F.col("_text"))).withColumn(
        "_keep", kept_positions(F.size("_lines"), F.col("_drop"))
    )
    left = F.array_join(words_at(F.col("_lines"), F.col("_keep")), "\n")
    return parts.select(
        *unpacked(
            docs,
            **{text_col: F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(left)},
            n_lines=F.size("_lines").cast("long"),
            n_dropped=(F.size("_lines") - F.size("_keep")).cast("long"),
        )
    )
