"""Result tables. Every write is one Spark job whose output appears when the job commits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.sources import folders


def _even(df: DataFrame, *keys: str) -> DataFrame:
    """Output files of even size: small partitions are merged, large ones split, whatever their key."""
    return df.hint("rebalance", *keys)


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str] = ("device", "date")) -> None:
    """Replaces exactly the partitions the frame has rows for; a second run leaves the same table."""
    (_even(df, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


def overwrite_slice(df: DataFrame, path: str, keys: Mapping[str, object]) -> None:
    """Replaces one partition, also with nothing: a day whose re-run is empty ends up empty.

    ``keys`` are the partition columns in the table's order, such as device and date, or
    device and end_date for a period table. Any text and null may be a key. The partition
    is replaced when the job commits; the job itself counts its rows, and an empty run clears the
    partition's folder after it has succeeded. Where readers must never see a step in between, see
    ``versioned.VersionedTable``.
    """
    text = {k: None if v is None else str(v) for k, v in keys.items()}
    counted = Observation("slice")
    rows = df.drop(*keys).withColumns({k: F.lit(v).cast("string") for k, v in text.items()}).observe(counted, F.count(F.lit(1)).alias("n"))
    overwrite_partitions(rows, path, list(keys))
    if not _observed_rows(counted):
        wanted = [v or None for v in text.values()]
        for folder, values in list(folders.partitions(df.sparkSession, path, list(keys))):
            if values == wanted:
                folders.delete(df.sparkSession, f"{path.rstrip('/')}/{folder}")


def _observed_rows(counted: Observation) -> int:
    try:
        return counted.get["n"]
    except Py4JJavaError:  # a plan that Spark knows to be empty beforehand runs without its metrics
        return 0


def append(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*keys).parquet(path)


def append_table(df: DataFrame, database: str, table: str, connection: Mapping[str, str] | None = None) -> None:
    """Appends to a catalogue table, or over JDBC when a connection is given."""
    if connection is None:
        df.write.mode("append").saveAsTable(f"{database}.{table}")
    else:
        df.write.format("jdbc").options(**connection, dbtable=f"{database}.{table}").mode("append").save()


def rebuild(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Drops and rebuilds the whole table."""
    _even(df, *keys).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(path)


def rebuild_table(df: DataFrame, name: str) -> None:
    _even(df).write.mode("overwrite").saveAsTable(name)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. A small result comes out as one file, a large one as several."""
    _even(df).write.mode("overwrite").option("header", True).csv(path)


def append_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str, path: str) -> None:
    """Adds literal rows to a calendar-like dimension."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A result without rows that still has its columns and types."""
    return spark.createDataFrame([], schema)


def stamp(df: DataFrame, **constants: object) -> DataFrame:
    """Constant columns and the time of the run."""
    return df.withColumns({**{k: F.lit(v) for k, v in constants.items()}, "reg_datetime": F.current_timestamp()})
