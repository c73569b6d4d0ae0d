"""Scans of the event lake.

Tables are partitioned by columns such as device, log name and date. A day range is a
filter on those columns, which Spark turns into partition pruning; no path is listed or
probed one day at a time.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.periods import as_date
from tallyforge.sources import folders


def lake_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, merge_schema: bool = False,
               skip_unreadable: bool = False, empty_if_missing: bool = False) -> DataFrame:
    """A partitioned parquet table.

    ``merge_schema`` joins the columns of all files, for facts that gained columns over
    time; a declared ``schema`` does the same without reading every footer. With
    ``skip_unreadable`` damaged or vanished files are left out; ``files_left_out`` names them. ``empty_if_missing`` gives
    an empty frame of ``schema`` where nothing has been written yet.
    """
    reader = (spark.read.option("mergeSchema", merge_schema).option("ignoreCorruptFiles", skip_unreadable)
              .option("ignoreMissingFiles", skip_unreadable))
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as problem:
        if empty_if_missing and schema is not None and problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


#: A parquet file without rows is no larger than its footer; only files up to this size are looked at whole.
EMPTY_FILE_BYTES = 16 << 20
#: Files without rows that are opened by name; more of them than this are found among all small files.
MOST_NAMED_FILES = 1000


def files_left_out(spark: SparkSession, path: str, schema: T.StructType | str, day: str = "date") -> DataFrame:
    """What ``skip_unreadable`` leaves out: partition day (as text) and file of every data file that cannot be read.

    The listed files are compared with the files that give rows, for which Spark reads no column and so nothing but footers. Of the few
    that give none, small ones are opened by the tasks to tell a valid file without rows from a damaged one.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("file"), "length")
              .where(~F.regexp_extract("file", "([^/]*)$", 1).rlike("^[_.]")))
    read = lake_table(spark, path, schema, skip_unreadable=True).select(F.col("_metadata.file_path").alias("file")).distinct()

    def same(c):
        return F.regexp_replace(F.url_decode(c), "^file:/+", "/")

    silent = listed.withColumn("__f", same("file")).join(read.select(same("file").alias("__f")), "__f", "left_anti").select("file", "__f", "length")
    small = silent.where(F.col("length") <= EMPTY_FILE_BYTES)
    names = [r.file for r in small.select("file").limit(MOST_NAMED_FILES + 1).collect()]
    if len(names) <= MOST_NAMED_FILES:  # only these files are opened
        contents = (spark.read.format("binaryFile").load([re.sub(r"([\[\]{}*?\\])", r"\\\1", n) for n in names]).select(same("path").alias("__f"), "content")
                    if names else spark.createDataFrame([], "__f string, content binary"))
    else:  # a lake with very many of them is read file by file, no larger than an empty one can be
        contents = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.col("length") <= EMPTY_FILE_BYTES)
                    .select(same("path").alias("__f"), "content").join(small.select("__f"), "__f", "left_semi"))
    out = silent.join(contents.mapInArrow(_valid_files, "__f string"), "__f", "left_anti")
    return out.select(F.regexp_extract("file", f"/{day}=([^/]*)/", 1).alias(day), "file")


def _valid_files(batches):
    """Names of the files whose footers can be read."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    for batch in batches:
        good = []
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            try:
                pq.read_metadata(pa.BufferReader(content.as_buffer()))
                good.append(name)
            except (pa.ArrowException, OSError):
                pass
        yield pa.RecordBatch.from_arrays([pa.array(good, pa.string())], names=["__f"])


def flatten(df: DataFrame, **columns: str) -> DataFrame:
    """Columns picked from nested structs by dotted name, e.g. ``map="common.mapname"``; only these are read."""
    return df.select(*[F.col(path).alias(name) for name, path in columns.items()])


def days(df: DataFrame, start: str | Column, end: str | Column, day: str = "date", devices: Sequence[str] | str = "*",
         device: str = "device") -> DataFrame:
    """Rows of a day range, both ends included, for all devices (``*``) or the listed ones."""
    out = df.where(F.col(day).between(as_date(start), as_date(end)))
    if devices == "*":
        return out
    return out.where(F.col(device).isin([devices] if isinstance(devices, str) else list(devices)))


def moments(df: DataFrame, start: str, end: str, time: str = "time") -> DataFrame:
    """Rows of a date-time range, both ends included; for intraday tables."""
    return df.where(F.col(time).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def log_scan(logs: DataFrame, start: str, end: str, **partition: str) -> DataFrame:
    """One log of an append-only log table, picked by partition values such as device, environment and log name."""
    for column, value in partition.items():
        logs = logs.where(F.col(column) == value)
    return days(logs, start, end)


def nested_scan(snapshot: DataFrame, keep: Sequence[str], explode: str | None = None) -> DataFrame:
    """A nested snapshot as it is, or with one array of structs flattened next to the columns to keep."""
    return snapshot if explode is None else snapshot.select(*keep, F.inline(explode))


def expected_days(spark: SparkSession, start: str, end: str, day: str = "date") -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(as_date(start), as_date(end))).alias(day))


def missing_days(df: DataFrame, start: str, end: str, day: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Days of the range without a row, optionally per device or log.

    Reads partition columns only when these are the partition columns.
    """
    found = days(df, start, end, day).select(*by, day).distinct()
    wanted = expected_days(df.sparkSession, start, end, day)
    if by:
        # every known group times a calendar of fixed length
        calendar = F.sequence(as_date(start), as_date(end))
        wanted = df.select(*by).distinct().withColumn(day, F.explode(calendar))
    return wanted.join(found, [*by, day], "left_anti")


def listed_partitions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The partitions of a table (columns ``keys`` as text) that hold a data file, from the folders' names; no data file is opened."""
    found = [tuple(values) for _, values in folders.partitions(spark, path, keys)]
    return spark.createDataFrame(found, T.StructType([T.StructField(k, T.StringType()) for k in keys]))


def missing_listed_days(spark: SparkSession, path: str, keys: Sequence[str], start: str, end: str, day: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """``missing_days`` of a table in a folder, from the listing of its partitions ``keys`` (which include the day) alone."""
    found = listed_partitions(spark, path, keys).withColumn(day, F.col(day).cast("date"))
    return missing_days(found, start, end, day, by)


def with_day_policy(df: DataFrame, start: str, end: str, policy: str = "warn", day: str = "date") -> DataFrame:
    """The day range under a missing-day policy.

    ``ignore`` reads what is there; ``warn`` names the missing days (a job over the day
    column only, its result no longer than the range); ``error`` makes the query itself
    fail when a day is missing.
    """
    scan = days(df, start, end, day)
    if policy == "ignore":
        return scan
    missing = missing_days(df, start, end, day)
    if policy == "warn":
        gaps = [str(r[0]) for r in missing.orderBy(day).toLocalIterator()]
        if gaps:
            warnings.warn(f"no data for {len(gaps)} days: {', '.join(gaps)}", stacklevel=2)
        return scan
    if policy == "error":
        gaps = missing.agg(F.count(F.lit(1))).scalar()
        text = F.concat(F.lit("days without data: "), gaps.cast("string"))
        return scan.where(F.when(gaps == 0, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
    raise ValueError(f"unknown policy {policy!r}")


def null_keys(df: DataFrame, key: str, since: str, day: str = "date") -> DataFrame:
    """Rows on or after a cut-off day that lack a key they should have."""
    return df.where((F.col(day) >= as_date(since)) & F.col(key).isNull())


def require_key(df: DataFrame, key: str, since: str, day: str = "date") -> DataFrame:
    """The same as a strict gate: the query fails at the first such row, with no extra pass over the data."""
    bad = (F.col(day) >= as_date(since)) & F.col(key).isNull()
    fail = F.raise_error(F.concat(F.lit(f"null {key} on "), F.col(day).cast("string")))
    return df.withColumn(key, F.when(bad, fail.cast(df.schema[key].dataType)).otherwise(F.col(key)))


def null_report(df: DataFrame, key: str, since: str, day: str = "date", most_days: int = 10_000) -> tuple[DataFrame, Observation]:
    """``df`` and the number of its rows and of null keys per day on or after a cut-off day, taken while ``df`` is used.

    The first action over the frame fills the observation; there is no pass of its own. ``days_with_nulls`` reads it. The
    counts per day come from a mergeable summary, which is exact up to ``most_days`` days with nulls.
    """
    bad = (F.col(day) >= as_date(since)) & F.col(key).isNull()
    observation = Observation(f"null {key}")
    tracked = 1 << (4 * most_days // 3).bit_length()
    days_seen = f"approx_top_k(CASE WHEN `{day}` >= DATE '{since}' AND `{key}` IS NULL THEN `{day}` END, {most_days}, {max(tracked, most_days)})"
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("nulls"), F.expr(days_seen).alias("days")), observation


def days_with_nulls(spark: SparkSession, observation: Observation, day: str = "date") -> DataFrame:
    """(day, rows): the rows without a key per day, as observed by a job that has run."""
    seen = [(r["item"], r["count"]) for r in observation.get["days"] if r["item"] is not None]
    if sum(n for _, n in seen) != observation.get["nulls"]:
        raise ValueError("more days with null keys than the summary can name")
    return spark.createDataFrame(seen, T.StructType([T.StructField(day, T.DateType()), T.StructField("rows", T.LongType())]))
