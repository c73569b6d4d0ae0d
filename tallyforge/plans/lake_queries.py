"""Registered scans and sinks: the model's own tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators.levels import people_and_sums
from tallyforge.plans.registry import query
from tallyforge.session import fresh_path
from tallyforge.sinks import tables
from tallyforge.sinks.versioned import VersionedTable
from tallyforge.sources import lake
from tallyforge.sources.dims import read_csv, read_descriptions

# Fixed values of the registered scans.
START, END = "2024-01-05", "2024-01-14"


def _lake(t, keys=("event_type", "date")):
    """The event log as a lake table partitioned by log name and day."""
    path = fresh_path(t.spark, "log")
    tables.overwrite_partitions(t.log, path, list(keys))
    return path


_BY_DAY = "date, event_type, count(*) AS rows, count(DISTINCT account_id) AS users, CAST(sum(cents) AS BIGINT) AS cents"


def _by_day(df):
    return people_and_sums(df, "account_id", ["date", "event_type"], {"users": True}, {"cents": "cents"}, rows="rows")


@query("scan_day_range", f"""
SELECT {_BY_DAY} FROM log WHERE date BETWEEN DATE '{START}' AND DATE '{END}' AND event_type IN ('click', 'view') GROUP BY 1, 2""")
def scan_day_range(t):
    table = lake.lake_table(t.spark, _lake(t))
    return _by_day(lake.days(table, START, END, devices=["click", "view"], device="event_type"))


@query("scan_one_log", f"SELECT {_BY_DAY} FROM log WHERE date BETWEEN DATE '{START}' AND DATE '{END}' AND event_type = 'error' GROUP BY 1, 2")
def scan_one_log(t):
    return _by_day(lake.log_scan(lake.lake_table(t.spark, _lake(t)), START, END, event_type="error"))


@query("scan_time_range", f"""
SELECT {_BY_DAY} FROM log WHERE time BETWEEN TIMESTAMP '{START} 06:00:00' AND TIMESTAMP '{END} 18:30:00' GROUP BY 1, 2""")
def scan_time_range(t):
    return _by_day(lake.moments(t.log, f"{START} 06:00:00", f"{END} 18:30:00"))


@query("missing_days", f"""
, g AS (SELECT DISTINCT event_type FROM log WHERE NOT (event_type = 'error' AND date = DATE '{START}')),
d AS (SELECT CAST(x AS DATE) AS date FROM unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) u(x)),
f AS (SELECT DISTINCT event_type, date FROM log WHERE NOT (event_type = 'error' AND date = DATE '{START}'))
SELECT event_type, date FROM g, d WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.event_type = g.event_type AND f.date = d.date)""")
def missing_days(t):
    gappy = t.log.where(f"NOT (event_type = 'error' AND date = DATE '{START}')")
    return lake.missing_days(gappy, START, "2024-02-03", by=["event_type"])


@query("missing_days_listed", f"""
, l AS (SELECT * FROM log WHERE NOT (event_type = 'error' AND date = DATE '{START}')),
d AS (SELECT CAST(x AS DATE) AS date FROM unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) u(x))
SELECT event_type, date FROM (SELECT DISTINCT event_type FROM l) g, d
WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.event_type = g.event_type AND l.date = d.date)""")
def missing_days_listed(t):
    """The same from a lake table's folders alone."""
    path = fresh_path(t.spark, "gappy")
    tables.overwrite_partitions(t.log.where(f"NOT (event_type = 'error' AND date = DATE '{START}')"), path, ["event_type", "date"])
    return lake.missing_listed_days(t.spark, path, ["event_type", "date"], START, "2024-02-03", by=["event_type"])


NULL_IDS_SQL = """
SELECT date, count(*) AS rows FROM purchases WHERE date >= DATE '1995-01-01' AND sales_id IS NULL GROUP BY 1"""


@query("null_report_in_pass", NULL_IDS_SQL)
def null_report_in_pass(t):
    """The null report of the rows that another job writes, taken in that job."""
    rows, seen = lake.null_report(t.purchases, "sales_id", "1995-01-01")
    tables.rebuild(rows, fresh_path(t.spark, "gated"))
    return lake.days_with_nulls(t.spark, seen)


@query("null_sales_ids", """
SELECT date, count(*) AS rows FROM purchases WHERE date >= DATE '2000-01-01' AND sales_id IS NULL GROUP BY 1""")
def null_sales_ids(t):
    return lake.null_keys(t.purchases, "sales_id", "2000-01-01").groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@query("required_key_gate", "SELECT date, count(*) AS rows, count(product_id) AS keyed FROM purchases GROUP BY 1")
def required_key_gate(t):
    return lake.require_key(t.purchases, "product_id", "1995-01-01").groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"), F.count("product_id").alias("keyed"))


@query("schema_evolution", """
SELECT date, count(*) AS rows, count(CASE WHEN date >= DATE '2024-01-15' THEN k END) AS with_k, CAST(sum(cents) AS BIGINT) AS cents FROM log GROUP BY 1""")
def schema_evolution(t):
    """Days before a change lack a column that later days have."""
    path = fresh_path(t.spark, "grown")
    new = F.col("date") >= F.lit("2024-01-15").cast("date")
    tables.append(t.log.where(~new).drop("k"), path, ["date"])
    tables.append(t.log.where(new), path, ["date"])
    return lake.lake_table(t.spark, path, merge_schema=True).groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"), F.count("k").alias("with_k"), F.sum("cents").alias("cents"))


@query("nested_snapshot_flattened", """
SELECT platform, expiry_date, count(*) AS entries, CAST(sum(free_balance) AS BIGINT) AS free_balance FROM ledger_entries GROUP BY 1, 2""")
def nested_snapshot_flattened(t):
    flat = lake.nested_scan(t.ledger, ["account_id", "date", "platform"], "by_expiry")
    return flat.groupBy("platform", "expiry_date").agg(F.count(F.lit(1)).alias("entries"), F.sum("free_balance").alias("free_balance"))


@query("rerun_replaces_day", f"SELECT {_BY_DAY} FROM log GROUP BY 1, 2")
def rerun_replaces_day(t):
    """A first run with wrong amounts for some days, then a correct re-run of just those days, twice."""
    path = fresh_path(t.spark, "rerun")
    redo = F.col("date").between(START, END)
    wrong = t.log.withColumn("cents", F.when(redo, F.col("cents") + 1).otherwise(F.col("cents")))
    tables.overwrite_partitions(wrong, path, ["event_type", "date"])
    for _ in range(2):
        tables.overwrite_partitions(t.log.where(redo), path, ["event_type", "date"])
    return _by_day(lake.lake_table(t.spark, path))


@query("rerun_with_empty_day", f"SELECT {_BY_DAY} FROM log WHERE NOT (event_type = 'error' AND date = DATE '{START}') GROUP BY 1, 2")
def rerun_with_empty_day(t):
    path = _lake(t)
    tables.overwrite_slice(t.log.where("false"), path, {"event_type": "error", "date": START})
    return _by_day(lake.lake_table(t.spark, path))


@query("rerun_by_switch", f"""
, l AS (SELECT * FROM log WHERE NOT (event_type = 'view' AND date = DATE '{START}'))
SELECT event_type AS kind, date, count(*) AS rows, CAST(sum(cents) AS BIGINT) AS cents FROM l WHERE event_type <> 'error' GROUP BY 1, 2
UNION ALL SELECT NULL, date, count(*), CAST(sum(cents) AS BIGINT) FROM l WHERE event_type = 'error' GROUP BY 2""")
def rerun_by_switch(t):
    """Wrong days replaced at once, then one slice again and one by nothing, each by a switch of manifests; old runs are removed."""
    log = t.log.withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type"))).select("event_id", "cents", "kind", "date")
    table = VersionedTable(t.spark, fresh_path(t.spark, "switched"), log.schema, ["kind", "date"])
    redo = F.col("date").between(START, END)
    table.replace(log.withColumn("cents", F.when(redo, F.col("cents") + 1).otherwise(F.col("cents"))))
    table.replace(log.where(redo))
    table.replace_slice(log.where(f"kind IS NULL AND date = DATE '{END}'"), {"kind": None, "date": END})
    table.replace_slice(log.where("false"), {"kind": "view", "date": START})
    table.remove_old()
    return table.read().groupBy("kind", "date").agg(F.count(F.lit(1)).alias("rows"), F.sum("cents").alias("cents"))


@query("append_then_rebuild", "SELECT date, 2 * count(*) AS rows FROM log GROUP BY 1")
def append_then_rebuild(t):
    """Appending twice doubles the rows; a rebuild starts over."""
    path = fresh_path(t.spark, "rebuilt")
    tables.rebuild(t.log.select("date", "event_id"), path)
    tables.rebuild(t.log.select("date", "event_id"), path)
    tables.append(t.log.select("date", "event_id"), path)
    return lake.lake_table(t.spark, path).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@query("csv_round_trip", "SELECT region, membership, count(*) AS users FROM users GROUP BY 1, 2")
def csv_round_trip(t):
    path = fresh_path(t.spark, "csv")
    tables.export_csv(people_and_sums(t.users, "account_id", ["region", "membership"], {"users": True}), path)
    return read_csv(t.spark, path, "region string, membership string, users bigint")


@query("rerun_of_odd_keys", """
SELECT event_type || ',+(é' AS kind, date, count(*) AS rows, CAST(sum(cents) AS BIGINT) AS cents FROM log
WHERE event_type IN ('click', 'view') AND NOT (event_type = 'view' AND date = DATE '""" + START + """') GROUP BY 1, 2
UNION ALL SELECT NULL, date, count(*), CAST(sum(cents) AS BIGINT) FROM log WHERE event_type = 'error' GROUP BY 2""")
def rerun_of_odd_keys(t):
    """Slices whose keys need escaping or are null: run again they replace themselves, run with nothing they end up empty."""
    path = fresh_path(t.spark, "odd")
    kind = F.when(F.col("event_type") != "error", F.concat("event_type", F.lit(",+(é")))
    log = t.log.where("event_type IN ('click', 'view', 'error')").withColumn("kind", kind).drop("event_type")
    tables.overwrite_partitions(log.withColumn("cents", F.col("cents") + 1).where(f"date = DATE '{START}'"), path, ["kind", "date"])
    tables.overwrite_partitions(log.where(f"date <> DATE '{START}'"), path, ["kind", "date"])
    for key in ("click,+(é", None):
        day = log.where(F.col("kind").eqNullSafe(F.lit(key)) & (F.col("date") == F.lit(START).cast("date")))
        for _ in range(2):
            tables.overwrite_slice(day, path, {"kind": key, "date": START})
    tables.overwrite_slice(log.where("false"), path, {"kind": "view,+(é", "date": START})
    return lake.lake_table(t.spark, path).groupBy("kind", "date").agg(F.count(F.lit(1)).alias("rows"), F.sum("cents").alias("cents"))


@query("missing_table_is_empty", "SELECT date, count(*) AS rows FROM log GROUP BY 1")
def missing_table_is_empty(t):
    """A table nobody has written yet adds no row to the one that is there."""
    here = t.log.select("event_id", "date")
    none = lake.lake_table(t.spark, fresh_path(t.spark, "unwritten"), here.schema, empty_if_missing=True)
    return here.unionByName(none).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@query("unreadable_files_reported", """
SELECT CAST(date AS VARCHAR) AS date, count(*) AS rows, CAST(0 AS BIGINT) AS files_left_out FROM log GROUP BY 1
UNION ALL SELECT '2030-01-01', 0, 1""")
def unreadable_files_reported(t):
    """A day whose file is damaged is skipped, and named."""
    path, schema = fresh_path(t.spark, "damaged"), "event_id bigint, cents bigint, date date"
    tables.append(t.log.select("event_id", "cents", "date"), path, ["date"])
    t.spark.range(1).selectExpr("'not a data file' AS value").write.text(f"{path}/date=2030-01-01")
    read = lake.lake_table(t.spark, path, schema, skip_unreadable=True).groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("rows"))
    left = lake.files_left_out(t.spark, path, schema).groupBy("date").agg(F.count(F.lit(1)).alias("files_left_out"))
    return read.join(left, "date", "full_outer").fillna(0, subset=["rows", "files_left_out"])


@query("nested_columns_by_name", """
SELECT event_type, k, count(*) AS rows, CAST(sum(cents) AS BIGINT) AS cents FROM log GROUP BY 1, 2""")
def nested_columns_by_name(t):
    path = fresh_path(t.spark, "nested")
    nested = F.struct(F.struct("event_type", "k").alias("what"), F.col("cents").alias("cents")).alias("common")
    tables.append(t.log.select("date", nested), path, ["date"])
    flat = lake.flatten(lake.lake_table(t.spark, path), event_type="common.what.event_type", k="common.what.k", cents="common.cents")
    return flat.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("rows"), F.sum("cents").alias("cents"))


@query("click_log_of_category", f"""
SELECT date, action, count(*) AS clicks, count(DISTINCT account_id) AS users FROM clicks
WHERE date BETWEEN DATE '{START}' AND DATE '{END}' AND label LIKE 'item.%' GROUP BY 1, 2""")
def click_log_of_category(t):
    """The click log as a lake table, one category of a day range."""
    path = fresh_path(t.spark, "clicks")
    tables.overwrite_partitions(t.clicks.withColumn("category", F.substring_index("label", ".", 1)), path, ["date"])
    of_items = lake.days(lake.lake_table(t.spark, path), START, END).where("category = 'item'")
    return people_and_sums(of_items, "account_id", ["date", "action"], {"users": True}, rows="clicks")


@query("descriptions_read_and_repaired", "SELECT country_code AS id, region AS name FROM regions")
def descriptions_read_and_repaired(t):
    """Description documents with no-break spaces in place of blanks."""
    path = fresh_path(t.spark, "descs")
    entry = F.struct(F.translate("country_code", " ", "\u00a0").alias("id"), F.translate("region", " ", "\u2019").alias("name"))
    docs = t.regions.groupBy(F.substring("country_code", 1, 1).alias("letter")).agg(F.collect_list(entry).alias("Descs"))
    docs.select("Descs").repartition("Descs").write.option("maxRecordsPerFile", 1).json(path)
    return read_descriptions(t.spark, path).select("id", "name")


@query("calendar_rows_appended", """
SELECT region AS name, count(*) AS n FROM regions GROUP BY 1 UNION ALL SELECT 'extra one', 1 UNION ALL SELECT 'extra two', 1""")
def calendar_rows_appended(t):
    path = fresh_path(t.spark, "calendar")
    tables.rebuild(t.regions.groupBy(F.col("region").alias("name")).agg(F.count(F.lit(1)).alias("n")), path)
    tables.append_rows(t.spark, [("extra one", 1), ("extra two", 1)], "name string, n bigint", path)
    return lake.lake_table(t.spark, path)


@query("stamped_result", "SELECT region, membership, count(*) AS users, 'daily' AS period, true AS stamped FROM users GROUP BY 1, 2")
def stamped_result(t):
    out = tables.stamp(people_and_sums(t.users, "account_id", ["region", "membership"], {"users": True}), period="daily")
    return out.withColumn("stamped", F.col("reg_datetime").isNotNull()).drop("reg_datetime")
