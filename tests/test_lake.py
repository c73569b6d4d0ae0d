import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tallyforge.sinks import tables
from tallyforge.sources import dims, lake
from tests.conftest import rows

FACT = "device string, date date, n bigint"


@pytest.fixture
def table(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(frame(FACT, ("pc", "2020-01-01", 1), ("pc", "2020-01-02", 2), ("tv", "2020-01-02", 3), ("pc", "2020-01-04", 4)), path)
    return path


def test_scan_prunes_partitions(spark, table):
    out = lake.days(lake.lake_table(spark, table), "2020-01-02", "2020-01-03", devices="pc")
    assert rows(out, "n") == [(2,)]
    scan = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [" in scan and "date" in scan.split("PartitionFilters:")[1]
    assert rows(lake.days(lake.lake_table(spark, table), "2020-01-02", "2020-01-03"), "n") == [(2,), (3,)]


def test_rerun_is_idempotent_and_leaves_other_days(spark, frame, table):
    again = frame(FACT, ("pc", "2020-01-02", 20))
    for _ in range(2):
        tables.overwrite_partitions(again, table)
    assert rows(lake.lake_table(spark, table), "device", "date", "n") == [
        ("pc", "2020-01-01", 1), ("pc", "2020-01-02", 20), ("pc", "2020-01-04", 4), ("tv", "2020-01-02", 3)]


def test_empty_rerun_empties_its_day(spark, frame, table):
    tables.overwrite_slice(frame(FACT), table, {"device": "pc", "date": "2020-01-02"})
    assert rows(lake.lake_table(spark, table), "n") == [(1,), (3,), (4,)]
    tables.overwrite_slice(frame(FACT, ("pc", "2020-01-02", 7)), table, {"device": "pc", "date": "2020-01-02"})
    assert rows(lake.lake_table(spark, table), "n") == [(1,), (3,), (4,), (7,)]


@pytest.mark.parametrize("key", ["a,b", "x+y", "é", "a(b)", "a/b=c%", None])
def test_slice_rerun_of_any_key_leaves_one_row(spark, frame, tmp_path, key):
    path = str(tmp_path / "odd")
    tables.overwrite_partitions(frame(FACT, (key, "2020-01-01", 1), ("pc", "2020-01-01", 2)), path)
    for n in (3, 4):
        tables.overwrite_slice(frame(FACT, (key, "2020-01-01", n)), path, {"device": key, "date": "2020-01-01"})
    assert sorted(r.n for r in lake.lake_table(spark, path).collect()) == [2, 4]
    tables.overwrite_slice(frame(FACT), path, {"device": key, "date": "2020-01-01"})
    assert [r.n for r in lake.lake_table(spark, path).collect()] == [2]


def test_failed_slice_rerun_leaves_the_day(spark, frame, table):
    bad = frame(FACT, ("pc", "2020-01-02", 7)).selectExpr("device", "date", "n + CAST(raise_error('no') AS bigint) AS n")
    with pytest.raises(PySparkException):
        tables.overwrite_slice(bad, table, {"device": "pc", "date": "2020-01-02"})
    assert rows(lake.lake_table(spark, table), "n") == [(1,), (2,), (3,), (4,)]


def test_missing_days_and_policies(spark, table):
    df = lake.lake_table(spark, table)
    assert rows(lake.missing_days(df, "2020-01-01", "2020-01-04")) == [("2020-01-03",)]
    assert rows(lake.missing_days(df, "2020-01-01", "2020-01-02", by=["device"])) == [("tv", "2020-01-01")]
    with pytest.warns(UserWarning, match="2020-01-03"):
        assert lake.with_day_policy(df, "2020-01-01", "2020-01-04", "warn").count() == 4
    assert lake.with_day_policy(df, "2020-01-01", "2020-01-04", "ignore").count() == 4
    with pytest.raises(PySparkException, match="days without data"):
        lake.with_day_policy(df, "2020-01-01", "2020-01-04", "error").collect()
    assert lake.with_day_policy(df, "2020-01-01", "2020-01-02", "error").count() == 3


def test_key_gate(frame):
    df = frame("id string, date date", (None, "2020-01-01"), ("a", "2020-01-05"), (None, "2020-01-06"))
    assert rows(lake.null_keys(df, "id", "2020-01-05")) == [(None, "2020-01-06")]
    with pytest.raises(PySparkException, match="null id on 2020-01-06"):
        lake.require_key(df, "id", "2020-01-05").collect()
    assert lake.require_key(df, "id", "2020-01-07").count() == 3


def test_missing_table_is_empty_with_schema(spark, tmp_path):
    schema = T.StructType.fromDDL(FACT)
    out = lake.lake_table(spark, str(tmp_path / "none"), schema, empty_if_missing=True)
    assert out.schema == schema and out.count() == 0
    with pytest.raises(PySparkException):
        lake.lake_table(spark, str(tmp_path / "none"), schema)


def test_columns_added_later(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.append(frame("date date, n bigint", ("2020-01-01", 1)), path, ["date"])
    tables.append(frame("date date, n bigint, m string", ("2020-01-02", 2, "x")), path, ["date"])
    assert rows(lake.lake_table(spark, path, merge_schema=True), "n", "m") == [(1, None), (2, "x")]


def test_unreadable_day_is_skipped(spark, frame, table):
    (bad,) = [p for p in __import__("pathlib").Path(table, "device=tv", "date=2020-01-02").glob("*.parquet")]
    bad.write_bytes(b"not parquet")
    checksum = bad.with_name(f".{bad.name}.crc")
    if checksum.exists():
        checksum.write_bytes(b"")
    schema = T.StructType.fromDDL(FACT)
    assert rows(lake.lake_table(spark, table, schema, skip_unreadable=True), "n") == [(1,), (2,), (4,)]


def test_descriptions_are_repaired(spark, tmp_path):
    path = tmp_path / "desc.json"
    path.write_text(json.dumps({"Descs": [{"Id": "a b", "Name": "it’s", "n": 1}, {"Id": "c", "Name": None, "n": 2}]}, indent=1))
    assert rows(dims.read_descriptions(spark, str(path)), "Id", "Name", "n") == [("a b", "it s", 1), ("c", None, 2)]
    declared = T.StructType.fromDDL("Id string, n bigint")
    assert rows(dims.read_descriptions(spark, str(path), schema=declared)) == [("a b", 1), ("c", 2)]


def test_csv_round_trip(spark, frame, tmp_path):
    df = frame("name string, day date, n bigint", ("a,b", "2020-01-01", 1), ('q"', "2020-01-02", 2))
    tables.export_csv(df, str(tmp_path / "out"))
    assert rows(dims.read_csv(spark, str(tmp_path / "out"), df.schema)) == rows(df)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1


def test_calendar_rows_and_stamp(spark, tmp_path):
    path, ddl = str(tmp_path / "cal"), "name string, n int"
    tables.append_rows(spark, [("a", 1)], ddl, path)
    tables.append_rows(spark, [("b", 2), ("c", 3)], ddl, path)
    assert rows(lake.lake_table(spark, path)) == [("a", 1), ("b", 2), ("c", 3)]
    stamped = tables.stamp(tables.empty(spark, ddl), device="pc")
    assert stamped.columns == ["name", "n", "device", "reg_datetime"] and stamped.count() == 0


def test_catalogue_tables(spark, frame, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS scratch LOCATION '{tmp_path}/db'")
    try:
        df = frame("id int, s struct<x: int>", (1, (5,)))
        tables.rebuild_table(df, "scratch.t")
        tables.rebuild_table(df, "scratch.t")
        tables.append_table(df, "scratch", "t")
        assert rows(dims.read_table(spark, "scratch", "t").select("id", "s.x")) == [(1, 5), (1, 5)]
    finally:
        spark.sql("DROP DATABASE scratch CASCADE")


def test_files_left_out_are_named(spark, frame, table):
    schema = "device string, date date, n bigint"
    assert lake.files_left_out(spark, table, schema).collect() == []
    spark.range(1).selectExpr("'junk' AS value").write.mode("append").text(f"{table}/device=pc/date=2020-01-09")
    assert lake.lake_table(spark, table, schema, skip_unreadable=True).count() == 4
    assert [r.date for r in lake.files_left_out(spark, table, schema).collect()] == ["2020-01-09"]


def test_flatten_reads_only_the_named_fields(spark, tmp_path):
    path = str(tmp_path / "nested")
    spark.range(2).selectExpr("named_struct('a', id, 'b', named_struct('c', 'x', 'd', 1)) AS s").write.parquet(path)
    out = lake.flatten(lake.lake_table(spark, path), n="s.a", c="s.b.c")
    assert rows(out) == [(0, "x"), (1, "x")]
    scan = out._jdf.queryExecution().executedPlan().toString()
    assert "d:int" not in scan.split("ReadSchema")[1]
