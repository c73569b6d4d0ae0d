"""Session and shared-folder helpers.

Nothing here is needed on a cluster that already hands out a session; the
operators never build one themselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tallyforge") -> SparkSession:
    """A local session for tests and benchmarks: ANSI, UTC, AQE, no UI."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TALLYFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a session of one machine (tests, a laptop) that names none gets a
    temporary folder, which is then set as its checkpoint folder so that later
    calls agree on it. On a cluster executors would each see a folder of their
    own, so a missing name is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tallyforge-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir() or made


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet, inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
