"""Exact deduplication by sorting the content."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import WHITE, cut

#: Leading characters of the normalised text that the range splitters carry.
SPLITTER_CHARS = 64


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 32) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when nothing but white space differs. The rows are range-partitioned by sampled
    splitters and sorted by content, so that equal texts lie side by side; the window over the sorted
    rows compares each whole text with its neighbour. Of equal texts the longest original, then the
    smallest id, stays.

    A splitter is the first characters of the text, its hash and a slice number: the driver's sample never
    holds whole texts, and a text that fills a third of all rows is spread over ``parts`` slices. Slices of
    one text (at most ``parts``) are then joined by their SHA-256. Texts are shuffled once; later steps
    carry digests only.

    Null and empty texts are equal to each other and to white space. A null id sorts after all others. Of
    rows repeated with one id exactly one is kept. Other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("raw"))
    norm = rows.select("id", F.char_length("raw").alias("n"), F.translate("raw", WHITE, "").alias("norm"))
    keyed = norm.select("id", "n", "norm", F.substring("norm", 1, SPLITTER_CHARS).alias("head"),
                        F.xxhash64("norm").alias("h"), F.pmod(F.xxhash64("id", "n"), F.lit(parts)).cast("int").alias("part"))
    spread = keyed.repartitionByRange("head", "h", "part")
    alike = Window.partitionBy("head", "h", "norm", "part").orderBy(F.desc("n"), F.asc_nulls_last("id"))
    marked = cut(spread.withColumn("at", F.row_number().over(alike))
                 .select("id", "n", "part", "at", F.sha2("norm", 256).alias("sha")))
    best = F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("part").alias("part"))
    partial = marked.groupBy("sha", "part").agg(F.count("*").alias("rows"), F.min(best).alias("best"))
    whole = Window.partitionBy("sha")  # at most ``parts`` rows
    groups = partial.select("sha", "part", F.sum("rows").over(whole).alias("group_size"), F.min("best").over(whole).alias("best"))
    return marked.join(groups, ["sha", "part"]).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
        ((F.col("at") == 1) & (F.col("part") == F.col("best.part"))).alias("kept"), F.col("sha").alias("text_sha256"))


EXACT_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS raw,
                  sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
           FROM documents),
g AS (SELECT doc_id, text_sha256,
             first_value(doc_id) OVER w AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size,
             row_number() OVER w AS place
      FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(raw) DESC, doc_id ASC NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""
