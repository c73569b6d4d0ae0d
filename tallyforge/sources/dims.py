"""Dimension tables: database, JSON descriptions, CSV."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# No-break space and curly quote, both repaired to a blank.
REPAIRED = "\u00a0\u2019"


def read_table(spark: SparkSession, database: str, table: str, connection: Mapping[str, str] | None = None) -> DataFrame:
    """A dimension from the catalogue, or over JDBC when a connection is given.

    ``connection`` holds Spark's JDBC options (url, user, driver, ...). For a table that is
    not small, give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``, so that it is read in parallel.
    """
    if connection is None:
        return spark.table(f"{database}.{table}")
    return spark.read.format("jdbc").options(**connection, dbtable=f"{database}.{table}").load()


def repair_text(df: DataFrame) -> DataFrame:
    """No-break spaces and curly quotes in top-level text columns become blanks."""
    blanks = " " * len(REPAIRED)
    return df.withColumns({f.name: F.translate(f.name, REPAIRED, blanks) for f in df.schema.fields
                           if isinstance(f.dataType, T.StringType)})


def read_descriptions(spark: SparkSession, path: str, field: str = "Descs", schema: T.StructType | None = None) -> DataFrame:
    """Description files: each a JSON document with a list of entries, one row per entry."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(field, T.ArrayType(schema))]))
    return repair_text(reader.json(path).select(F.inline(field)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV export with a header; types come from ``schema`` and never from a guess."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
