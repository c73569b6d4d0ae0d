"""Tables whose slices are replaced by one atomic switch.

Every run writes a folder of its own, and a small manifest names the folder that each slice (partition)
is read from. A run is complete on disk before anything refers to it; then the next manifest appears by
one rename that fails if another run was first. So whatever breaks in between, readers see the old slices
whole or the new ones, and a slice can become empty like any other change. A manifest has an entry per
slice, not per file, and nothing else is listed or collected.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.sources import folders

_MANIFESTS = "_manifests"


class VersionedTable:
    """A table in a folder, partitioned by ``keys``; ``schema`` has the data columns and then the keys."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    # -- reading ----------------------------------------------------------------
    def version(self) -> int:
        """The number of the newest manifest, 0 before the first run."""
        names = folders.names(self.spark, f"{self.path}/{_MANIFESTS}")
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def slices(self, version: int | None = None) -> dict[str, str]:
        """The folder of each slice, by the slice's name."""
        version = self.version() if version is None else version
        return json.loads(folders.read_text(self.spark, f"{self.path}/{_MANIFESTS}/{version:012d}.json")) if version else {}

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of the newest manifest, or of an earlier one that is still there. Partition filters prune as usual."""
        current = sorted(self.slices(version).values())
        if not current:
            return self.spark.createDataFrame([], self.schema)
        full = T.StructType([*self.schema.fields, T.StructField("run", T.StringType())])
        return (self.spark.read.schema(full).option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in current])
                .select(*[F.col(f"`{c}`") for c in self.schema.names]))

    # -- writing ----------------------------------------------------------------
    def replace(self, df: DataFrame) -> None:
        """Replaces exactly the slices that ``df`` has rows for, all of them at once."""
        self._switch(self._write(df))

    def replace_slice(self, df: DataFrame, keys: Mapping[str, object]) -> None:
        """Replaces one slice by the rows of ``df``, also by none. Any text and null may be a key; an empty text counts as null."""
        text = {k: None if keys[k] is None else str(keys[k]) for k in self.keys}
        rows = df.drop(*self.keys).withColumns({k: F.lit(v).cast("string") for k, v in text.items()})
        written = self._write(rows)
        self._switch(written or {self._name([text[k] or None for k in self.keys]): None})

    def _write(self, df: DataFrame) -> dict[str, str]:
        """Writes a run and gives its folder by slice."""
        run = f"run={uuid.uuid4().hex}"
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name not in self.keys else F.col(f"`{f.name}`") for f in self.schema.fields]
        df.select(*columns).hint("rebalance", *self.keys).write.partitionBy(*self.keys).parquet(f"{self.path}/{run}")
        return {self._name(values): f"{run}/{folder}" for folder, values in folders.partitions(self.spark, f"{self.path}/{run}", self.keys)}

    @staticmethod
    def _name(values: Sequence[str | None]) -> str:
        return json.dumps(list(values), ensure_ascii=False)

    def _switch(self, changes: Mapping[str, str | None]) -> None:
        """The next manifest with the changes; begins again from a newer one if another run came first."""
        for _ in range(100):
            version = self.version()
            slices = {k: v for k, v in {**self.slices(version), **changes}.items() if v is not None}
            if self._publish(version + 1, json.dumps(slices, ensure_ascii=False, indent=0, sort_keys=True)):
                return
        raise RuntimeError(f"no turn to change {self.path} in 100 attempts")

    def _publish(self, version: int, text: str) -> bool:
        """Writes a manifest beside its place and moves it there; false if the place is taken."""
        made = f"{self.path}/{_MANIFESTS}/.{uuid.uuid4().hex}"
        folders.write_text(self.spark, made, text)
        try:
            folders.move_new(self.spark, made, f"{self.path}/{_MANIFESTS}/{version:012d}.json")
        except Py4JJavaError as problem:
            if "FileAlreadyExists" in problem.java_exception.getClass().getName():
                folders.delete(self.spark, made)
                return False
            raise
        return True

    def remove_old(self, keep: int = 1) -> int:
        """Deletes run folders that none of the last ``keep`` manifests names, and older manifests; gives the number of folders.

        Not to be called while a run is being written.
        """
        newest = self.version()
        kept = {f.split("/")[0] for v in range(max(1, newest - keep + 1), newest + 1) for f in self.slices(v).values()}
        for name in folders.names(self.spark, f"{self.path}/{_MANIFESTS}"):
            if not name.endswith(".json") or int(name.removesuffix(".json")) <= newest - keep:
                folders.delete(self.spark, f"{self.path}/{_MANIFESTS}/{name}")
        old = [n for n in folders.names(self.spark, self.path) if n.startswith("run=") and n not in kept]
        for name in old:
            folders.delete(self.spark, f"{self.path}/{name}")
        return len(old)
