"""Common stages of a plan, computed once and read by all results that need them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tallyforge.session import fresh_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame's rows, written to the shared folder and read back: later reads cost a scan, whatever the rows cost to make.

    The write is one job at the time of the call and appears as a whole when it commits. An executor that is lost later takes
    nothing with it, and a retried task reads the same rows. The files stay until the folder that ``spark.checkpoint.dir``
    names is cleared.
    """
    path = fresh_path(df.sparkSession, f"stage-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Stages:
    """The stages of one plan by name; each is made by the first result that asks for it."""

    def __init__(self):
        self._made: dict[str, DataFrame] = {}

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = staged(build(), name)
        return self._made[name]
