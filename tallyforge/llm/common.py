"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.session import shared_folder

#: Bytes of text that a Python worker handles at a time; one longer text is a slice of its own.
SLICE_BYTES = 512 << 10
#: Rows of an Arrow batch, unless the session says otherwise than Spark's default; texts make wide rows.
ARROW_ROWS = 2000
#: The white space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"


def cut(df: DataFrame) -> DataFrame:
    """The same rows from the shared checkpoint folder, with their lineage gone.

    Executors that are lost later take nothing with them, as the files lie in the folder that
    ``spark.checkpoint.dir`` names.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def keep(df: DataFrame) -> DataFrame:
    """The same rows, held on the executors' disks for the steps that read them again.

    The lineage stays: what a lost executor held is computed again from the input.
    """
    return df.persist(StorageLevel.DISK_ONLY)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands this package to the Python workers, once per application, so that they need no copy of their own, and
    lowers the session's rows per Arrow batch from Spark's default to ``ARROW_ROWS``."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, ARROW_ROWS)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        made = shutil.make_archive(f"{tempfile.mkdtemp()}/package", "zip", os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(made)
        _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col, n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def least_hashed(rows: DataFrame, group: str, hash_col: str, n: int, most_groups: int) -> DataFrame:
    """(group, hash): of each group the ``n`` distinct rows of least hash, at most; of more than ``most_groups`` groups the largest ones.

    A count per group gives a bound on the hash that about 2 ``n`` rows of it meet, so the rows that are ranked, and the task that ranks
    them, are bounded whatever the table's size and number of tasks.
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), group).limit(most_groups)
    share = F.least(F.lit(1.0), F.lit(2.0 * n + 200) / F.col("__n"))
    near = rows.select(group, hash_col).join(F.broadcast(counts), group).where(F.col(hash_col) <= (share - 0.5) * F.lit(2.0 ** 64))
    ranked = F.row_number().over(Window.partitionBy(group).orderBy(hash_col))
    return near.select(group, hash_col).distinct().withColumn("__place", ranked).where(F.col("__place") <= n).drop("__place")


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the texts of each piece hold about ``most`` bytes; keeps order and all rows."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def map_slices(df: DataFrame, text: str, run: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, most: int = SLICE_BYTES) -> DataFrame:
    """``run`` over text-bounded slices of ``df``'s partitions; memory does not depend on the partition's size."""

    def body(batches):
        for piece in slices(batches, text, most):
            out = run(piece)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(body, schema)
