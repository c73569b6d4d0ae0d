"""Registered baskets, paths and orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.columns import label_in
from tallyforge.operators import segment, sequence
from tallyforge.operators.levels import people_and_sums
from tallyforge.plans.registry import query

# Fixed values of the registered reports.
CAMPAIGN = "Brand#1"
MODELS = [("black", ["Brand#11"]), ("white", ["Brand#12"]), ("yellow", ["Brand#13"])]
KINDS = [("paint", ["STANDARD", "PROMO"]), ("wheels", ["ECONOMY"]), ("calipers", ["MEDIUM", "LARGE"])]
MODEL_CASE = """CASE event_name WHEN 'Brand#11' THEN 'black' WHEN 'Brand#12' THEN 'white' WHEN 'Brand#13' THEN 'yellow' END"""
KIND_CASE = """CASE WHEN event_type IN ('STANDARD', 'PROMO') THEN 'paint' WHEN event_type = 'ECONOMY' THEN 'wheels'
  WHEN event_type IN ('MEDIUM', 'LARGE') THEN 'calipers' END"""
OWNED = f"""
, owned AS (SELECT account_id, model, min(date) AS own_date FROM (SELECT *, {MODEL_CASE} AS model FROM sales) WHERE model IS NOT NULL GROUP BY 1, 2)
"""


def owned(t):
    return segment.acquisitions(t.sales, label_in("event_name", MODELS))


def _basket_sql(item, where="", having=""):
    return f"""
, pairs AS (SELECT DISTINCT account_id, {item} FROM sales {where}),
sets AS (SELECT account_id, string_agg({item}, '|' ORDER BY {item}) AS basket, count(*) AS items FROM pairs GROUP BY 1 {having}),
g AS (SELECT min(account_id) AS account_id, count(*) AS users, items FROM sets GROUP BY basket, items)
SELECT account_id, users, items, {item} FROM g JOIN pairs USING (account_id)"""


def _path_sql(where=""):
    return f"""
, steps AS (SELECT account_id, product_name, row_number() OVER (PARTITION BY account_id ORDER BY time, transaction_id, product_id) AS position
  FROM sales {where}),
paths AS (SELECT account_id, string_agg(product_name, ' > ' ORDER BY position) AS path, count(*) AS steps FROM steps GROUP BY 1),
g AS (SELECT min(account_id) AS account_id, count(*) AS users, steps FROM paths GROUP BY path, steps)
SELECT account_id, users, g.steps, position, product_name FROM g JOIN steps USING (account_id)"""


@query("baskets", _basket_sql("event_type"))
def baskets(t):
    return sequence.baskets(t.sales, item="event_type")


@query("baskets_of_campaign", _basket_sql("product_name", f"WHERE event_name = '{CAMPAIGN}'", "HAVING count(*) IN (2, 3)"))
def baskets_of_campaign(t):
    return sequence.baskets(t.sales.where(F.col("event_name") == CAMPAIGN)).where("items IN (2, 3)")


@query("purchase_path", _path_sql())
def purchase_path(t):
    return sequence.purchase_path(t.sales)


@query("campaign_purchase_path", _path_sql(f"WHERE event_name = '{CAMPAIGN}'"))
def campaign_purchase_path(t):
    return sequence.purchase_path(t.sales.where(F.col("event_name") == CAMPAIGN))


@query("path_positions", """
SELECT position, event_type, count(*) AS users FROM (
  SELECT event_type, row_number() OVER (PARTITION BY account_id ORDER BY time, event_id) AS position FROM log) GROUP BY 1, 2""")
def path_positions(t):
    return sequence.path_items(t.log, "account_id", "time", ["event_id"], "event_type").groupBy("position", "event_type").agg(
        F.count("account_id").alias("users"))


_HIST = """
SELECT items, count(*) AS users, CAST(sum(total_use) AS BIGINT) AS total_use, CAST(sum(total_use) AS DOUBLE) / count(*) AS arppu
FROM (SELECT account_id, {} AS items, sum(paid_use + free_use) AS total_use FROM sales {} GROUP BY 1) GROUP BY 1"""


@query("count_histogram", _HIST.format("count(DISTINCT product_name)", ""))
def count_histogram(t):
    return sequence.count_histogram(t.sales)


@query("count_histogram_rows", _HIST.format("count(*)", f"WHERE event_name = '{CAMPAIGN}'"))
def count_histogram_rows(t):
    return sequence.count_histogram(t.sales.where(F.col("event_name") == CAMPAIGN), item=None)


@query("nth_active_day", OWNED + """
, d AS (SELECT account_id, min(own_date) AS date FROM owned GROUP BY 1),
n AS (SELECT account_id, date, CAST(row_number() OVER (PARTITION BY account_id ORDER BY date) AS INTEGER) AS active_day
  FROM (SELECT DISTINCT account_id, date FROM active_days))
SELECT d.account_id, d.date, active_day FROM d LEFT JOIN n USING (account_id, date)""")
def nth_active_day(t):
    dates = owned(t).groupBy("account_id").agg(F.min("own_date").alias("date"))
    return sequence.nth_active_day(t.active_days, dates)


@query("nth_active_day_since_first_spend", OWNED + """
, d AS (SELECT account_id, min(own_date) AS date FROM owned GROUP BY 1),
s AS (SELECT account_id, min(date) AS start_day FROM sales WHERE event_name = 'Brand#10' GROUP BY 1),
n AS (SELECT account_id, date, CAST(row_number() OVER (PARTITION BY account_id ORDER BY date) AS INTEGER) AS active_day
  FROM (SELECT DISTINCT account_id, date FROM active_days JOIN s USING (account_id) WHERE date >= start_day))
SELECT d.account_id, d.date, active_day FROM d LEFT JOIN n USING (account_id, date)""")
def nth_active_day_since_first_spend(t):
    dates = owned(t).groupBy("account_id").agg(F.min("own_date").alias("date"))
    starts = t.sales.where("event_name = 'Brand#10'").groupBy("account_id").agg(F.min("date").alias("start_day"))
    return sequence.nth_active_day(t.active_days, dates, starts)


@query("combo_strings", OWNED + f"""
, c AS (SELECT o.model, account_id, coalesce(string_agg(DISTINCT kind, ', ' ORDER BY kind), '') AS combo
  FROM (SELECT *, {KIND_CASE} AS kind FROM sales) JOIN owned o USING (account_id) GROUP BY 1, 2)
SELECT model, membership, combo, count(*) AS users FROM c JOIN users USING (account_id) GROUP BY 1, 2, 3""")
def combo_strings(t):
    kinds = t.sales.select("account_id", label_in("event_type", KINDS).alias("kind")).distinct()
    combos = sequence.combo(kinds.join(owned(t).select("account_id", "model"), "account_id"), ["model", "account_id"], "kind")
    segmented = combos.join(t.users.select("account_id", "membership"), "account_id")
    return people_and_sums(segmented, "account_id", ["model", "membership", "combo"], {"users": True})


@query("owned_combo", OWNED + """
SELECT models, count(*) AS users FROM (SELECT account_id, string_agg(model, ',' ORDER BY model) AS models FROM owned GROUP BY 1) GROUP BY 1""")
def owned_combo(t):
    return sequence.owned_combo(owned(t))


@query("timeline_of_busiest_user", """
SELECT time, event_id, event_type, cents FROM log WHERE account_id = (
  SELECT account_id FROM (SELECT account_id, count(*) AS n FROM log GROUP BY 1) ORDER BY n DESC, account_id LIMIT 1)""")
def timeline_of_busiest_user(t):
    busiest = (t.log.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), "account_id").limit(1).select("account_id").scalar())
    return sequence.timeline(t.log, busiest, "time").select("time", "event_id", "event_type", "cents")


