"""Switched slices, listings and checks that open no data."""

import os

import pytest
from pyspark.errors import PySparkException

from tallyforge.sinks import tables
from tallyforge.sinks.versioned import VersionedTable
from tallyforge.sources import folders, lake
from tests.conftest import rows

FACT = "n bigint, device string, date date"


@pytest.fixture
def table(spark, frame, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "table"), FACT, ["device", "date"])
    made.replace(frame(FACT, (1, "pc", "2020-01-01"), (2, "pc", "2020-01-02"), (3, "tv", "2020-01-01"), (4, None, "2020-01-01")))
    return made


def test_slices_are_replaced_exactly(frame, table):
    table.replace(frame(FACT, (5, "pc", "2020-01-02"), (6, "pc", "2020-01-03"), (6, "pc", "2020-01-03")))
    assert rows(table.read(), "n") == [(1,), (3,), (4,), (5,), (6,), (6,)] and table.read().schema == table.schema
    table.replace_slice(frame(FACT, (7, "x", "2020-05-05")), {"device": None, "date": "2020-01-01"})
    table.replace_slice(frame(FACT), {"device": "pc", "date": "2020-01-03"})
    assert rows(table.read()) == [(1, "pc", "2020-01-01"), (3, "tv", "2020-01-01"), (5, "pc", "2020-01-02"), (7, None, "2020-01-01")]
    assert rows(table.read(1), "n") == [(1,), (2,), (3,), (4,)]  # as of the first run
    assert table.remove_old() == 1 and rows(table.read(), "n") == [(1,), (3,), (5,), (7,)] and table.remove_old() == 0


@pytest.mark.parametrize("key", ["a,b", "x+y", "é", "a(b)", "a/b=c%", "a b", None])
def test_any_key_names_its_slice(frame, table, key):
    for n in (8, 9):
        table.replace_slice(frame(FACT, (n, "y", "2021-01-01")), {"device": key, "date": "2021-01-01"})
    assert rows(table.read().where("n > 4"), "n", "device") == [(9, key)]
    table.replace_slice(frame(FACT), {"device": key, "date": "2021-01-01"})
    assert rows(table.read().where("n > 4")) == []


def test_a_failure_between_the_steps_leaves_the_old_day(frame, table, monkeypatch):
    before = rows(table.read())
    bad = frame(FACT, (9, "pc", "2020-01-02")).selectExpr("n + CAST(raise_error('no') AS bigint) AS n", "device", "date")
    with pytest.raises(PySparkException):
        table.replace_slice(bad, {"device": "pc", "date": "2020-01-02"})
    assert rows(table.read()) == before
    for step in ("_switch", "_publish"):  # the run is written, the switch does not happen
        with monkeypatch.context() as m:
            m.setattr(table, step, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            for df in (frame(FACT, (9, "pc", "2020-01-02")), frame(FACT)):
                with pytest.raises(OSError):
                    table.replace_slice(df, {"device": "pc", "date": "2020-01-02"})
        assert rows(table.read()) == before and table.version() == 1
    monkeypatch.setattr(folders, "move_new", lambda *a: (_ for _ in ()).throw(OSError("lost")))  # the manifest lies beside its place
    with pytest.raises(OSError):
        table.replace(frame(FACT, (9, "pc", "2020-01-02")))
    assert rows(table.read()) == before
    monkeypatch.undo()
    table.replace_slice(frame(FACT, (9, "pc", "2020-01-02")), {"device": "pc", "date": "2020-01-02"})
    assert rows(table.read(), "n") == [(1,), (3,), (4,), (9,)]
    assert table.remove_old() >= 4


def test_a_run_that_came_second_keeps_both_changes(spark, frame, table, monkeypatch):
    other, real, calls = VersionedTable(spark, table.path, FACT, ["device", "date"]), table._publish, []

    def late(version, text):
        if not calls:
            calls.append(version)
            other.replace(frame(FACT, (6, "tv", "2020-01-01")))
        return real(version, text)

    monkeypatch.setattr(table, "_publish", late)
    table.replace(frame(FACT, (5, "pc", "2020-01-01")))
    assert table.version() == 3 and rows(table.read(), "n") == [(2,), (4,), (5,), (6,)]


def test_partition_filters_prune_and_empty_tables_read(spark, frame, table, tmp_path):
    plan = table.read().where("device = 'pc' AND date = DATE '2020-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    empty = VersionedTable(spark, str(tmp_path / "none"), FACT, ["device", "date"])
    assert empty.read().collect() == [] and empty.version() == 0
    empty.replace_slice(frame(FACT), {"device": "pc", "date": "2020-01-02"})
    assert empty.read().collect() == [] and empty.version() == 1


def test_listed_days_open_no_data_file(spark, frame, tmp_path):
    path = str(tmp_path / "lake")
    tables.overwrite_partitions(frame(FACT, (1, "pc", "2020-01-01"), (2, "pc", "2020-01-02"), (3, "t v/=", "2020-01-02"), (4, None, "2020-01-02")), path)
    for folder, _, names in os.walk(path):  # files that nobody could read
        for name in names:
            with open(os.path.join(folder, name), "wb") as out:
                out.write(b"?")
    os.makedirs(f"{path}/device=pc/date=2020-01-03")  # a folder without a file is no data
    assert rows(lake.listed_partitions(spark, path, ["device", "date"])) == [("pc", "2020-01-01"), ("pc", "2020-01-02"), ("t v/=", "2020-01-02"), (None, "2020-01-02")]
    got = lake.missing_listed_days(spark, path, ["device", "date"], "2020-01-01", "2020-01-03", by=["device"])
    assert rows(got.where("device IS NOT NULL"), "device", "date") == [("pc", "2020-01-03"), ("t v/=", "2020-01-01"), ("t v/=", "2020-01-03")]
    assert rows(lake.missing_listed_days(spark, path, ["device", "date"], "2020-01-01", "2020-01-03"), "date") == [("2020-01-03",)]
    assert lake.listed_partitions(spark, str(tmp_path / "none"), ["device", "date"]).collect() == []


def test_null_report_comes_with_the_rows(spark, frame, tmp_path):
    df = frame("id string, date date", (None, "2020-01-01"), ("a", "2020-01-05"), (None, "2020-01-06"), (None, "2020-01-06"), (None, "2020-01-07"))
    out, seen = lake.null_report(df, "id", "2020-01-05")
    out.write.parquet(str(tmp_path / "rows"))
    assert rows(lake.days_with_nulls(spark, seen)) == [("2020-01-06", 2), ("2020-01-07", 1)]
    assert seen.get["rows"] == 5 and seen.get["nulls"] == 3
    out, seen = lake.null_report(df.limit(0), "id", "2020-01-05")
    assert out.collect() == [] and lake.days_with_nulls(spark, seen).collect() == []


def test_an_empty_valid_file_is_not_left_out(spark, frame, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "lake"), "device string, date date, n bigint"
    tables.append(frame(FACT, (1, "pc", "2020-01-01")), path, ["device", "date"])
    frame(FACT).select("n").coalesce(1).write.parquet(f"{path}/device=pc/date=2020-01-02")
    spark.range(1).selectExpr("'junk' AS value").write.text(f"{path}/device=pc/date=2020-01-03")
    tables.append(frame(FACT, (2, "p[c]", "2020-01-04")), path, ["device", "date"])
    frame(FACT).select("n").coalesce(1).write.parquet(f"{path}/device=p[c] x/date=2020-01-05")
    assert [r.date for r in lake.files_left_out(spark, path, schema).collect()] == ["2020-01-03"]
    monkeypatch.setattr(lake, "MOST_NAMED_FILES", 0)
    assert [r.date for r in lake.files_left_out(spark, path, schema).collect()] == ["2020-01-03"]
    plan = lake.lake_table(spark, path, schema, skip_unreadable=True).select("_metadata.file_path").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
