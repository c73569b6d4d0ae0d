"""Folders as the session's file systems list them: names of partitions, without opening any data file."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession

#: How a partition whose key is null is named; fixed by the file layout.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list:
    where, system = _at(spark, path)
    return list(system.listStatus(where)) if system.exists(where) else []


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, nothing if there is none."""
    return [c.getPath().getName() for c in _children(spark, path)]


def partitions(spark: SparkSession, path: str, keys: Sequence[str]) -> Iterator[tuple[str, list[str | None]]]:
    """The partition folders below ``path`` (relative) that hold a data file, and their key values as text, null where null.

    One listing per folder, none of which holds more than its own level.
    """
    if not keys:
        if any(not n.startswith(("_", ".")) for n in names(spark, path)):
            yield "", []
        return
    for child in _children(spark, path):
        name = child.getPath().getName()
        key, _, value = name.partition("=")
        if child.isDirectory() and unquote(key) == keys[0]:
            for rest, values in partitions(spark, f"{path.rstrip('/')}/{name}", keys[1:]):
                yield (f"{name}/{rest}" if rest else name), [None if value == NULL_PARTITION else unquote(value), *values]


def read_text(spark: SparkSession, path: str) -> str:
    where, system = _at(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    where, system = _at(spark, path)
    stream = system.create(where, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def move_new(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file in one step; an error if the target is there already."""
    a, _ = _at(spark, source)
    b, _ = _at(spark, target)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    context.rename(context.makeQualified(a), context.makeQualified(b), options)


def delete(spark: SparkSession, path: str) -> None:
    where, system = _at(spark, path)
    system.delete(where, True)
