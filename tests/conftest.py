import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows with a DDL schema; dates and times may be given as text."""

    def make(ddl: str, *rows):
        from pyspark.sql import functions as F
        from pyspark.sql import types as T

        schema = T.StructType.fromDDL(ddl)
        timed = (T.DateType, T.TimestampNTZType)
        loose = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, timed) else f.dataType) for f in schema])
        return spark.createDataFrame([tuple(r) for r in rows], loose).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    return make


def rows(df, *cols):
    """Sorted tuples with dates as text, for comparing by eye."""
    import datetime as dt
    import decimal

    def plain(v):
        if isinstance(v, (dt.date, dt.datetime)):
            return str(v)
        if isinstance(v, decimal.Decimal):
            return float(v)
        return v

    picked = df.select(*cols) if cols else df
    return sorted((tuple(plain(v) for v in r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
