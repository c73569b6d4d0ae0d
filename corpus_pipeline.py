"""From raw documents to a mixed, tokenised training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import jaccard, lines, mixing, pieces, quality
from tallyforge.llm.common import ship, table
from tallyforge.session import fresh_path

#: No SQL can express the learned classifier.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts, with all their columns; it learns from all labelled rows here.

    Null and empty texts are scored like any other, repeated rows stay or go together, columns of any name pass. Without a
    labelled document all stay; an empty table gives none.
    """
    ship(spark)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without line runs that stand in an earlier one; one that loses every word goes, others keep the rest.

    Null texts stay as they are. Rows that agree in id and text are one document, so neither is the later one. Columns of any
    name pass; ``n_chars`` follows a shortened text.
    """
    ship(spark)
    out = lines.drop_repeated_runs(docs)
    out = out.where((F.col("n_deleted") == 0) | F.coalesce(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False)))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_deleted") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("row.n_chars"))}
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by near-equal shingle sets the one with the smallest id.

    Rows that share an id are one document, of which one row stays. Rows without an id are told apart by their texts.
    """
    ship(spark)
    key = F.coalesce(F.col("doc_id"), -F.pmod(F.xxhash64("text"), F.lit(1 << 62)) - 1)
    keyed = docs.select(F.struct("*").alias("row"), key.alias("key"))
    groups = jaccard.jaccard_groups(docs.select(key.alias("doc_id"), "text"))
    first = groups.where("component_id = doc_id").select(F.col("doc_id").alias("key")).distinct()
    kept = keyed.join(first, "key", "left_semi").groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents repeated to the target weights of their sources, in a random order.

    A null source is one of the others, a null or empty text weighs nothing, rows repeated with one id get equal counts.
    Columns of any name pass, also those that the operator adds under the same names.
    """
    ship(spark)
    own = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in ("copy", "shuffle_key")}
    back = {v: k for k, v in own.items()}
    renamed = docs.withColumnsRenamed(own) if own else docs
    return mixing.poisson_mix(renamed).select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in renamed.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, score and alternatives of every document; null text gives nulls, repeated rows repeat, other columns go."""
    ship(spark)
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each but the last written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
