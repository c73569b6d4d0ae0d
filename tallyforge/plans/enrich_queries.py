"""Registered enrichment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.columns import name_or_id, payer_id, strip_prefix
from tallyforge.functions.periods import period_start
from tallyforge.operators import joins
from tallyforge.operators.levels import label_after, people_and_sums
from tallyforge.operators.quantile import exact_percentiles, percentile_tiers
from tallyforge.plans.registry import query

# Fixed values of the registered queries.
DAY = "1998-03-18"
FLOOR = "1998-03-15"
GIVEAWAYS = ["7", "11"]
TIERS = {"p20": 0.20, "p50": 0.50, "p80": 0.80, "p95": 0.95}


@query("country_resolution", """
SELECT account_id, CASE WHEN country_os = 'CN' THEN country_os ELSE country_ip END AS country FROM snapshot""")
def country_resolution(t):
    return joins.with_country(t.snapshot).select("account_id", "country")


GEO = """
, geo AS (SELECT s.*, CASE WHEN country_os = 'CN' THEN country_os ELSE country_ip END AS country FROM snapshot s),
reg AS (SELECT geo.*, regions.region FROM geo LEFT JOIN regions ON country = country_code)
"""


@query("region_lookup", GEO + "SELECT region, count(*) AS users FROM reg GROUP BY 1")
def region_lookup(t):
    users = joins.with_region(joins.with_country(t.snapshot), t.regions)
    return users.groupBy("region").agg(F.count(F.lit(1)).alias("users"))


@query("membership_default_before", """
SELECT coalesce(membership, 'undefined') AS membership, count(*) AS users FROM snapshot LEFT JOIN membership USING (account_id) GROUP BY 1""")
def membership_default_before(t):
    users = joins.with_membership(t.snapshot, t.membership)
    return users.groupBy("membership").agg(F.count(F.lit(1)).alias("users"))


@query("membership_default_after", """
, literal AS (SELECT account_id, CASE WHEN device = 'pc' THEN membership END AS m, device FROM snapshot LEFT JOIN membership USING (account_id)),
marked AS (SELECT account_id, CASE WHEN device = 'console' THEN 'undefined' ELSE m END AS membership FROM literal)
SELECT coalesce(membership, 'undefined') AS membership, users FROM (SELECT membership, count(*) AS users FROM marked GROUP BY 1)""")
def membership_default_after(t):
    users = joins.with_membership(t.snapshot, t.membership, default=None)
    users = users.withColumn("membership", F.when(F.col("device") == "console", "undefined").otherwise(F.col("membership")))
    return label_after(users.groupBy("membership").agg(F.count(F.lit(1)).alias("users")), "membership", "undefined")


@query("first_row_per_user", """
SELECT account_id, date, platform, play_mode FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY date, platform, play_mode) AS rn FROM active_days) WHERE rn = 1""")
def first_row_per_user(t):
    return joins.first_per_key(t.active_days, "account_id", ["date", "platform", "play_mode"])


RANGED = """
, ranged AS (SELECT *, count(*) OVER (PARTITION BY platform, product_id) AS versions,
  coalesce(lead(start_time) OVER (PARTITION BY platform, product_id ORDER BY start_time), TIMESTAMP '2038-01-19 00:00:00') AS next_start
  FROM offers)
"""
_OFFER_SUMMARY = """CAST(sum(qty) AS BIGINT) AS units, count(*) AS lines, CAST(sum(price) AS BIGINT) AS price,
  CAST(sum(qty * list_price) AS BIGINT) AS list_revenue"""


def _offer_summary(joined, *by):
    priced = joins.with_revenue(joined, "qty", "list_price", "list_revenue")
    return priced.groupBy(*by).agg(F.sum("qty").alias("units"), F.count(F.lit(1)).alias("lines"),
                                   F.sum("price").alias("price"), F.sum("list_revenue").alias("list_revenue"))


SCD2_SQL = RANGED + f"""
SELECT p.platform, p.product_id, offer_id, version, {_OFFER_SUMMARY}
FROM purchases p LEFT JOIN ranged r ON p.platform = r.platform AND p.product_id = r.product_id
  AND (versions = 1 OR (time >= start_time AND time < next_start)) GROUP BY 1, 2, 3, 4"""


@query("scd2_price_join", SCD2_SQL)
def scd2_price_join(t):
    joined = joins.scd2_join(t.purchases, t.offers, ["platform", "product_id"])
    return _offer_summary(joined, "platform", "product_id", "offer_id", "version")


@query("scd2_price_join_sliced", SCD2_SQL)
def scd2_price_join_sliced(t):
    """As with a price list too large to broadcast."""
    joined = joins.scd2_join(t.purchases, t.offers, ["platform", "product_id"], slice_it=True)
    return _offer_summary(joined, "platform", "product_id", "offer_id", "version")


EITHER_SQL = RANGED + f"""
, keyed AS (SELECT *, CASE WHEN sales_id LIKE 'offer%' THEN split_part(sales_id, '.', 2) ELSE sales_id END AS sid FROM purchases),
joined AS (
  SELECT k.*, offer_id, version, list_price, event_name FROM keyed k LEFT JOIN ranged r ON k.platform = r.platform AND k.sid = r.offer_id
  WHERE k.sid IS NOT NULL
  UNION ALL
  SELECT k.*, offer_id, version, list_price, event_name FROM keyed k LEFT JOIN ranged r ON k.platform = r.platform AND k.product_id = r.product_id
    AND (versions = 1 OR (time >= start_time AND time < next_start)) WHERE k.sid IS NULL)
SELECT platform, event_name, offer_id, version, sid IS NOT NULL AS has_id, {_OFFER_SUMMARY} FROM joined GROUP BY 1, 2, 3, 4, 5"""


@query("either_key_join", EITHER_SQL)
def either_key_join(t):
    return _by_either_key(t, None)


@query("either_key_join_sliced", EITHER_SQL)
def either_key_join_sliced(t):
    """As with a price list too large to broadcast."""
    return _by_either_key(t, True)


def _by_either_key(t, slice_it):
    joined = joins.either_key_join(t.purchases, t.offers, "sales_id", "offer_id", ["platform"], "product_id", slice_it=slice_it)
    joined = joined.withColumn("has_id", F.col("sales_id").isNotNull())
    return _offer_summary(joined, "platform", "event_name", "offer_id", "version", "has_id")


@query("lookup_join", """
, cash AS (SELECT account_id, platform, product_id, date, qty, price, CASE WHEN channel <> 'A' THEN time END AS time FROM purchases),
dim AS (SELECT platform, product_id, product_name, list_price FROM offers WHERE version = 1)
SELECT platform, product_name, status, CAST(hour(coalesce(time, CAST(date AS TIMESTAMP))) AS INTEGER) AS hour, count(*) AS lines,
  CAST(sum(qty * list_price) AS BIGINT) AS revenue
FROM (SELECT *, 'Succeeded' AS status FROM cash WHERE product_id NOT IN ('7', '11')) LEFT JOIN dim USING (platform, product_id)
GROUP BY 1, 2, 3, 4""")
def lookup_join(t):
    cash = t.purchases.select("account_id", "platform", "product_id", "date", "qty", "price",
                              F.when(F.col("channel") != "A", F.col("time")).alias("time"))
    dim = t.offers.where("version = 1").select("platform", "product_id", "product_name", "list_price")
    joined = joins.with_revenue(joins.lookup_join(cash, dim, ["platform", "product_id"], GIVEAWAYS), "qty", "list_price")
    return joined.groupBy("platform", "product_name", "status", F.hour("time").alias("hour")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue"))


@query("strip_id_prefix", """
SELECT CASE WHEN sales_id LIKE 'offer%' THEN split_part(sales_id, '.', 2) ELSE sales_id END AS plain_id, count(*) AS lines
FROM purchases GROUP BY 1""")
def strip_id_prefix(t):
    return t.purchases.groupBy(strip_prefix("sales_id", "offer").alias("plain_id")).agg(F.count(F.lit(1)).alias("lines"))


@query("name_fallback", """
SELECT DISTINCT product_id, coalesce(product_name, product_id) AS product_name FROM offers""")
def name_fallback(t):
    return t.offers.select("product_id", name_or_id("product_name", "product_id").alias("product_name")).distinct()


@query("active_user_modes", """
, ok AS (SELECT * FROM snapshot WHERE server_type = 'LIVE' AND platform NOT LIKE '%NULL%')
SELECT device, count(*) AS all_live, count(CASE WHEN last_login >= DATE '2001-06-01' THEN 1 END) AS since,
  count(CASE WHEN last_login = first_login THEN 1 END) AS same_day FROM ok GROUP BY 1""")
def active_user_modes(t):
    live = joins.active_users(t.snapshot, mode="any")
    return live.groupBy("device").agg(
        F.count(F.lit(1)).alias("all_live"), F.count_if(joins.is_active("2001-06-01")).alias("since"),
        F.count_if(joins.is_active(mode="same_day", day="first_login")).alias("same_day"))


@query("period_windows", "".join([
    "\nSELECT 'daily' AS period, min(date) AS first_day, count(*) AS lines, CAST(sum(price) AS BIGINT) AS revenue "
    f"FROM purchases WHERE date BETWEEN DATE '{DAY}' AND DATE '{DAY}'",
    "\nUNION ALL SELECT 'weekly', min(date), count(*), CAST(sum(price) AS BIGINT) "
    f"FROM purchases WHERE date BETWEEN DATE '{FLOOR}' AND DATE '{DAY}'",
    "\nUNION ALL SELECT 'monthly', min(date), count(*), CAST(sum(price) AS BIGINT) "
    f"FROM purchases WHERE date BETWEEN DATE '1998-03-01' AND DATE '{DAY}'"]))
def period_windows(t):
    """All windows from one scan; a window without rows is still reported."""
    periods = ("daily", "weekly", "monthly")
    day = F.lit(DAY).cast("date")
    facts = t.purchases.where(F.col("date").between(period_start(DAY, "monthly"), day))
    inside = {p: F.col("date") >= period_start(DAY, p, FLOOR) for p in periods}
    totals = facts.agg(*[m for p, c in inside.items() for m in (
        F.min(F.when(c, F.col("date"))).alias(f"{p}_first"), F.count_if(c).alias(f"{p}_lines"),
        F.sum(F.when(c, F.col("price"))).alias(f"{p}_revenue"))])
    return totals.select(F.inline(F.array(*[F.struct(
        F.lit(p).alias("period"), F.col(f"{p}_first").alias("first_day"), F.col(f"{p}_lines").alias("lines"),
        F.col(f"{p}_revenue").alias("revenue")) for p in periods])))


@query("semi_cohort", """
SELECT date, count(*) AS lines, CAST(sum(price) AS BIGINT) AS revenue FROM purchases
WHERE account_id IN (SELECT account_id FROM sales WHERE event_name = 'Brand#7') GROUP BY 1""")
def semi_cohort(t):
    cohort = t.sales.where("event_name = 'Brand#7'")
    return joins.in_cohort(t.purchases, cohort).groupBy("date").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("price").alias("revenue"))


@query("cohort_flag", """
SELECT account_id IN (SELECT account_id FROM sales WHERE event_name = 'Brand#7') AS in_brand, count(*) AS lines,
  count(DISTINCT account_id) AS users FROM purchases GROUP BY 1""")
def cohort_flag(t):
    members = t.sales.where("event_name = 'Brand#7'").select("account_id").distinct().withColumn("in_brand", F.lit(True))
    counted = people_and_sums(t.purchases, "account_id", ["in_brand"], {"users": True}, rows="lines", attrs=members)
    return counted.withColumn("in_brand", F.coalesce("in_brand", F.lit(False)))


CALENDAR = """
, calendar AS (SELECT p_brand AS name, DATE '1995-01-01' + CAST(substr(p_brand, 7) AS INTEGER) * 90 AS start_date,
  DATE '1995-01-01' + CAST(substr(p_brand, 7) AS INTEGER) * 90 + 99 AS end_date FROM part GROUP BY p_brand)
"""


def calendar(t):
    """One 100-day campaign per brand, starting every 90 days, so that neighbours overlap."""
    start = F.date_add(F.lit("1995-01-01").cast("date"), F.substring("p_brand", 7, 10).cast("int") * 90)
    brands = t.table("part").select("p_brand").distinct()
    return brands.select(F.col("p_brand").alias("name"), start.alias("start_date"), F.date_add(start, 99).alias("end_date"))


@query("live_campaign", CALENDAR + f"""
SELECT * FROM calendar WHERE start_date <= DATE '{DAY}' AND DATE '{DAY}' <= end_date ORDER BY start_date, name LIMIT 1""")
def live_campaign(t):
    return joins.live_campaign(calendar(t), DAY)


DEVICE_CALENDAR = CALENDAR + """
, device_calendar AS (SELECT 'Campaign ' || name AS name, CASE WHEN CAST(substr(name, 7) AS INTEGER) % 2 = 0 THEN 'pc' ELSE 'console' END AS device,
  start_date, start_date + 20 AS end_date, end_date - 30 AS tab_start, end_date AS tab_end, name AS event_name FROM calendar)
"""
TAB = [("tab_start", "tab_end")]


def device_calendar(t):
    """The same campaigns by device, with an event name of their own and two ranges: sales, then the tab's opening."""
    even = F.substring("event_name", 7, 10).cast("int") % 2 == 0
    named = calendar(t).withColumnRenamed("name", "event_name")
    return named.select(F.concat(F.lit("Campaign "), "event_name").alias("name"), F.when(even, "pc").otherwise("console").alias("device"), "start_date",
                        F.date_add("start_date", 20).alias("end_date"), F.date_sub("end_date", 30).alias("tab_start"),
                        F.col("end_date").alias("tab_end"), "event_name")


def live_by_device_sql(day, device):
    return f"""SELECT * FROM device_calendar WHERE device = '{device}' AND (DATE '{day}' BETWEEN start_date AND end_date
  OR DATE '{day}' BETWEEN tab_start AND tab_end) ORDER BY start_date, name LIMIT 1"""


@query("live_campaign_by_device", DEVICE_CALENDAR + f"SELECT 'pc' AS asked, * FROM ({live_by_device_sql(DAY, 'pc')}) "
       f"UNION ALL SELECT 'console', * FROM ({live_by_device_sql(DAY, 'console')})")
def live_campaign_by_device(t):
    pc, console = [joins.live_campaign(device_calendar(t), DAY, device=d, more=TAB).withColumn("asked", F.lit(d)) for d in ("pc", "console")]
    return pc.unionByName(console)


@query("new_buyers", """
SELECT date, count(DISTINCT account_id) AS pu, count(DISTINCT CASE WHEN date = first_use_date THEN account_id END) AS npu
FROM purchases LEFT JOIN first_use USING (account_id) GROUP BY 1""")
def new_buyers(t):
    flagged = joins.flag_new_buyer(t.purchases.select("account_id", "date").distinct(), t.first_use)
    return people_and_sums(flagged, "account_id", ["date"], {"pu": True, "npu": "is_new"})


@query("payer_flag", """
SELECT platform, count(DISTINCT account_id) AS pu, count(DISTINCT CASE WHEN paid_use > 0 THEN account_id END) AS paid_pu
FROM purchases GROUP BY 1""")
def payer_flag(t):
    return people_and_sums(t.purchases, "account_id", ["platform"], {"pu": True, "paid_pu": payer_id("paid_use", "account_id").isNotNull()})


SPEND = """
, spend AS (SELECT account_id, CAST(sum(price) AS BIGINT) AS spend FROM purchases GROUP BY 1),
cuts AS (SELECT quantile_cont(spend, 0.20) AS p20, quantile_cont(spend, 0.50) AS p50, quantile_cont(spend, 0.80) AS p80,
  quantile_cont(spend, 0.95) AS p95 FROM spend)
"""


@query("exact_percentiles", SPEND + "SELECT round(p20, 2) AS p20, round(p50, 2) AS p50, round(p80, 2) AS p80, round(p95, 2) AS p95 FROM cuts")
def percentiles(t):
    spend = t.purchases.groupBy("account_id").agg(F.sum("price").alias("spend"))
    return exact_percentiles(spend, "spend", TIERS).select(*[F.round(p, 2).alias(p) for p in TIERS])


@query("percentile_tiers", SPEND + """
SELECT CASE WHEN spend <= p20 THEN '<=20' WHEN spend <= p50 THEN '<=50' WHEN spend <= p80 THEN '<=80' WHEN spend <= p95 THEN '<=95'
  ELSE '>95' END AS tier, count(*) AS users, CAST(sum(spend) AS BIGINT) AS spend FROM spend, cuts GROUP BY 1""")
def tiers(t):
    spend = t.stage("spend", lambda: t.purchases.groupBy("account_id").agg(F.sum("price").alias("spend")))
    cuts = exact_percentiles(spend, "spend", TIERS, stage=False)
    return percentile_tiers(spend, "spend", TIERS, cuts).groupBy("tier").agg(
        F.count(F.lit(1)).alias("users"), F.sum("spend").alias("spend"))
