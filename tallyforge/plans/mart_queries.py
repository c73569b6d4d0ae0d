"""Registered data marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.plans import marts
from tallyforge.plans.enrich_queries import CALENDAR, DEVICE_CALENDAR, TAB, calendar, device_calendar, live_by_device_sql
from tallyforge.plans.registry import query

# Fixed values of the registered marts.
DAY = "1998-01-31"
SNAPSHOT_DAY = "2001-08-01"
CAMPAIGN_DAY = "1998-03-18"
CASH_START = "1997-12-31"
MEASURES = ["free_balance", "paid_balance"]
CLASSES = [("%imprint%", "imprint"), ("%voucher%", "voucher")]


def _coin(t):
    return t.sales.where("channel <> 'R'")


def _cash(t):
    return t.sales.where("channel = 'R'").select(
        "account_id", "date", "sales_id", "product_id", "product_name", F.col("qty").alias("unit_sold"),
        F.col("price").alias("revenue"))


def _snapshot(t):
    return t.snapshot.withColumn("days_since", F.datediff(F.lit(SNAPSHOT_DAY).cast("date"), F.col("last_login")))


def _users_sql(start: str | None, default: bool) -> str:
    login = f" AND last_login >= DATE '{start}'" if start else ""
    member = "coalesce(membership, 'undefined')" if default else "membership"
    return f"""
, mu AS (
  SELECT account_id, device, platform, region, {member} AS membership, DATE '{SNAPSHOT_DAY}' - last_login AS days_since
  FROM (SELECT s.*, CASE WHEN country_os = 'CN' THEN country_os ELSE country_ip END AS country FROM snapshot s)
  LEFT JOIN regions ON country = country_code LEFT JOIN membership USING (account_id)
  WHERE server_type = 'LIVE' AND platform NOT LIKE '%NULL%'{login}),
au AS (SELECT device, platform, region, coalesce(membership, 'undefined') AS membership, au FROM (
  SELECT device, platform, region, membership, count(*) AS au FROM mu GROUP BY 1, 2, 3, 4))
"""


_DIMS = "device, platform, region, membership"
_SUMS = """CAST(sum(unit_sold) AS BIGINT) AS unit_sold, CAST(sum(free_used) AS BIGINT) AS free_used,
  CAST(sum(paid_used) AS BIGINT) AS paid_used"""
_ON = "b.device = au.device AND b.platform = au.platform AND b.region = au.region AND b.membership = au.membership"
_MERGED = ", ".join(f"coalesce(b.{c}, au.{c}) AS {c}" for c in ("device", "platform", "region", "membership"))

def _sales_sql(start: str, day: str) -> str:
    return _users_sql(start, False) + f"""
, u AS (
  SELECT account_id, sales_id, product_id, product_name, 'coin' AS currency, sum(qty) AS unit_sold, sum(free_use) AS free_used,
    sum(paid_use) AS paid_used, NULL AS revenue FROM sales
  WHERE channel <> 'R' AND date BETWEEN DATE '{start}' AND DATE '{day}' GROUP BY 1, 2, 3, 4
  UNION ALL
  SELECT account_id, sales_id, product_id, product_name, 'cash', sum(qty), NULL, NULL, sum(price) FROM sales
  WHERE channel = 'R' AND date BETWEEN DATE '{start}' AND DATE '{day}' GROUP BY 1, 2, 3, 4),
j AS (SELECT u.*, {_DIMS} FROM u LEFT JOIN mu USING (account_id)),
b0 AS (
  SELECT {_DIMS}, currency, sales_id, product_id, product_name, count(DISTINCT account_id) AS pu, {_SUMS},
    CAST(sum(revenue) AS BIGINT) AS revenue FROM j GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
  UNION ALL
  SELECT {_DIMS}, currency, '0', 'total', '0', count(DISTINCT account_id), {_SUMS}, CAST(sum(revenue) AS BIGINT) FROM j GROUP BY 1, 2, 3, 4, 5
  UNION ALL
  SELECT {_DIMS}, 'coin+cash', '0', 'total', '0', count(DISTINCT account_id), {_SUMS}, CAST(sum(revenue) AS BIGINT) FROM j GROUP BY 1, 2, 3, 4),
b AS (SELECT * REPLACE (coalesce(membership, 'undefined') AS membership) FROM b0)
SELECT {_MERGED}, currency, sales_id, product_id, product_name, pu, unit_sold, free_used, paid_used, revenue, au,
  DATE '{day}' AS date FROM b FULL JOIN au ON {_ON}"""


@query("mart_sales_by_membership", _sales_sql("1998-01-01", DAY))
def mart_sales_by_membership(t):
    return marts.sales_by_membership(t.snapshot, t.regions, t.membership, _coin(t), _cash(t), DAY, "monthly")


@query("mart_sales_weekly_since_launch", _sales_sql("1998-01-28", DAY))
def mart_sales_weekly_since_launch(t):
    """A week that reaches back to the launch day only."""
    return marts.sales_by_membership(t.snapshot, t.regions, t.membership, _coin(t), _cash(t), DAY, "weekly", "1998-01-28")


def _paid_sql(start: str, day: str, stamp: str) -> str:
    return _users_sql(start, False) + f"""
, u AS (
  SELECT account_id, sales_id, product_id, product_name, sum(qty) AS unit_sold, sum(free_use) AS free_used, sum(paid_use) AS paid_used
  FROM sales WHERE channel <> 'R' AND paid_use > 0 AND date BETWEEN DATE '{start}' AND DATE '{day}' GROUP BY 1, 2, 3, 4),
j AS (SELECT u.*, {_DIMS} FROM u LEFT JOIN mu USING (account_id)),
b AS (
  SELECT {_DIMS}, sales_id, product_id, product_name, count(DISTINCT account_id) AS pu, {_SUMS} FROM j GROUP BY 1, 2, 3, 4, 5, 6, 7
  UNION ALL
  SELECT device, platform, region, coalesce(membership, 'undefined'), '0', 'total', '0', pu, unit_sold, free_used, paid_used FROM (
    SELECT {_DIMS}, count(DISTINCT account_id) AS pu, {_SUMS} FROM j GROUP BY 1, 2, 3, 4)),
f AS (SELECT {_MERGED}, coalesce(sales_id, '0') AS sales_id, coalesce(product_id, '0') AS product_id, product_name, pu, unit_sold,
  free_used, paid_used, au, {stamp} FROM b FULL JOIN au ON {_ON})
SELECT * FROM f WHERE device IS NOT NULL AND platform IS NOT NULL AND region IS NOT NULL AND membership IS NOT NULL"""


@query("mart_paid_by_product", _paid_sql("1998-01-01", DAY, f"DATE '1998-01-01' AS start_date, DATE '{DAY}' AS end_date"))
def mart_paid_by_product(t):
    return marts.paid_by_product(t.snapshot, t.regions, t.membership, _coin(t), DAY, "monthly")


@query("mart_paid_by_product_daily", _paid_sql(DAY, DAY, f"DATE '{DAY}' AS date"))
def mart_paid_by_product_daily(t):
    return marts.paid_by_product(t.snapshot, t.regions, t.membership, _coin(t), DAY, "daily")


@query("mart_event_sales", _users_sql(None, True) + f"""
SELECT {_DIMS}, sub_category, event_type, event_name, count(DISTINCT account_id) AS pu, CAST(sum(free_use) AS BIGINT) AS free_used,
  CAST(sum(paid_use) AS BIGINT) AS paid_used, DATE '{DAY}' AS date
FROM (SELECT * EXCLUDE (platform) FROM sales WHERE channel <> 'R' AND date = DATE '{DAY}') LEFT JOIN mu USING (account_id)
GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def mart_event_sales(t):
    return marts.event_sales(t.snapshot, t.regions, t.membership, _coin(t), DAY)


_BUCKET = """CASE WHEN d < 1 THEN '0' WHEN d < 7 THEN '[1-7)' WHEN d < 30 THEN '[7-30)' WHEN d < 90 THEN '[30-90)'
  WHEN d < 180 THEN '[90-180)' ELSE '[180-inf)' END"""


@query("balance_by_expiry", _users_sql(None, True) + f"""
, e AS (SELECT *, (expiry_date - date) - 1 AS d FROM ledger_entries WHERE (expiry_date - date) - 1 >= 0),
j AS (SELECT e.*, upper(device) AS device, region, membership, days_since FROM e
  LEFT JOIN (SELECT * EXCLUDE (platform) FROM mu) USING (account_id)),
w AS (SELECT *, 'all' AS active_window FROM j
  UNION ALL SELECT j.*, name FROM j, (VALUES ('w-01', 6), ('w-02', 13), ('w-04', 27), ('w-08', 55), ('w-12', 83)) v(name, days)
  WHERE days_since <= days AND region IS NOT NULL)
SELECT date, coalesce(device, 'ALL') AS device, platform, coalesce(region, 'Undefined') AS region, membership, active_window,
  {_BUCKET} AS days_to_expiry, count(DISTINCT account_id) AS users, CAST(sum(free_balance) AS BIGINT) AS free_balance,
  CAST(sum(paid_balance) AS BIGINT) AS paid_balance,
  count(DISTINCT CASE WHEN daily_free_topup <> 0 OR daily_paid_topup <> 0 THEN account_id END) AS topup_users,
  count(DISTINCT CASE WHEN daily_free_use <> 0 OR daily_paid_use <> 0 THEN account_id END) AS use_users
FROM w GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def balance_by_expiry(t):
    return marts.balance_by_expiry(_snapshot(t), t.regions, t.membership, t.ledger, MEASURES)


TEN = {"total_free_topup": "daily_free_topup + 1", "total_paid_topup": "daily_paid_topup + 2", "total_free_topup_refunds": "daily_free_use + 3",
       "total_paid_topup_refunds": "daily_paid_use + 4", "total_free_use": "daily_free_use + 5", "total_paid_use": "daily_paid_use + 6",
       "total_free_returns": "daily_free_topup + 7", "total_paid_returns": "daily_paid_topup + 8"}


@query("balance_of_ten_measures", _users_sql(None, True) + f"""
, e AS (SELECT *, (expiry_date - date) - 1 AS d, {", ".join(f"{v} AS {k}" for k, v in TEN.items())} FROM ledger_entries WHERE (expiry_date - date) - 1 >= 0),
j AS (SELECT e.*, upper(device) AS device, region, membership, days_since FROM e
  LEFT JOIN (SELECT * EXCLUDE (platform) FROM mu) USING (account_id)),
w AS (SELECT *, 'all' AS active_window FROM j
  UNION ALL SELECT j.*, name FROM j, (VALUES ('w-01', 6), ('w-02', 13), ('w-04', 27), ('w-08', 55), ('w-12', 83)) v(name, days)
  WHERE days_since <= days AND region IS NOT NULL)
SELECT date, coalesce(device, 'ALL') AS device, platform, coalesce(region, 'Undefined') AS region, membership, active_window,
  {_BUCKET} AS days_to_expiry, count(DISTINCT account_id) AS users,
  {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in [*TEN, *MEASURES])},
  count(DISTINCT CASE WHEN daily_free_topup <> 0 OR daily_paid_topup <> 0 THEN account_id END) AS topup_users,
  count(DISTINCT CASE WHEN daily_free_use <> 0 OR daily_paid_use <> 0 THEN account_id END) AS use_users
FROM w GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def balance_of_ten_measures(t):
    def entry(e):
        fields = {n: e[x] + int(k) for n, (x, k) in ((n, rule.split(" + ")) for n, rule in TEN.items())}
        return F.struct(*[e[f].alias(f) for f in ("expiry_date", "daily_free_topup", "daily_paid_topup", "daily_free_use", "daily_paid_use", *MEASURES)],
                        *[c.alias(n) for n, c in fields.items()])

    ledger = t.ledger.withColumn("by_expiry", F.transform("by_expiry", entry))
    return marts.balance_by_expiry(_snapshot(t), t.regions, t.membership, ledger, [*TEN, *MEASURES])


@query("mart_coupon_balance", _users_sql(None, True) + f"""
SELECT {_DIMS}, reason, reason_detail, CAST(sum(amount) AS BIGINT) AS balance
FROM currency_log LEFT JOIN mu USING (account_id) WHERE currency = 'coupon.free' GROUP BY 1, 2, 3, 4, 5, 6""")
def mart_coupon_balance(t):
    return marts.coupon_balance(t.snapshot, t.regions, t.membership, t.currency_log, "coupon.free")


LOG_DAY = "2024-01-10"


@query("mart_coupon_balance_daily", _users_sql(None, True) + f"""
SELECT {_DIMS}, reason, reason_detail, CAST(sum(amount) AS BIGINT) AS balance, DATE '{LOG_DAY}' AS date
FROM currency_log LEFT JOIN mu USING (account_id) WHERE currency = 'coupon.free' AND date = DATE '{LOG_DAY}' GROUP BY 1, 2, 3, 4, 5, 6""")
def mart_coupon_balance_daily(t):
    return marts.coupon_balance(t.snapshot, t.regions, t.membership, t.currency_log, "coupon.free", LOG_DAY)


@query("mart_campaign_kpi_by_device", DEVICE_CALENDAR + f"""
, live AS ({live_by_device_sql(CAMPAIGN_DAY, "pc")}),
c AS (SELECT sales.* FROM sales, live WHERE contains(sales.event_name, live.event_name) AND channel <> 'R'),
cum AS (SELECT c.* FROM c, live WHERE date BETWEEN start_date AND DATE '{CAMPAIGN_DAY}')
SELECT DATE '{CAMPAIGN_DAY}' AS date, name,
  (SELECT count(DISTINCT account_id) FROM snapshot WHERE server_type = 'LIVE' AND last_login >= start_date) AS cum_au,
  (SELECT count(DISTINCT account_id) FROM cum) AS cum_pu,
  (SELECT count(DISTINCT account_id) FROM cum WHERE paid_use > 0) AS cum_paid_pu,
  (SELECT CAST(sum(free_use) AS BIGINT) FROM cum) AS cum_free_use, (SELECT CAST(sum(paid_use) AS BIGINT) FROM cum) AS cum_paid_use,
  (SELECT count(DISTINCT account_id) FROM c JOIN first_use USING (account_id)
    WHERE date = DATE '{CAMPAIGN_DAY}' AND first_use_date = DATE '{CAMPAIGN_DAY}') AS daily_npu
FROM live""")
def mart_campaign_kpi_by_device(t):
    return marts.campaign_kpi(t.snapshot, _coin(t), t.first_use, device_calendar(t), CAMPAIGN_DAY, "event_name", "pc", TAB)


def _campaign_sql(day):
    return CALENDAR + f"""
, live AS (SELECT * FROM calendar WHERE start_date <= DATE '{day}' AND DATE '{day}' <= end_date ORDER BY start_date, name LIMIT 1),
c AS (SELECT sales.* FROM sales, live WHERE contains(event_name, live.name) AND channel <> 'R'),
cum AS (SELECT c.* FROM c, live WHERE date BETWEEN start_date AND DATE '{day}')
SELECT DATE '{day}' AS date, name,
  (SELECT count(DISTINCT account_id) FROM snapshot WHERE server_type = 'LIVE' AND last_login >= start_date) AS cum_au,
  (SELECT count(DISTINCT account_id) FROM cum) AS cum_pu,
  (SELECT count(DISTINCT account_id) FROM cum WHERE paid_use > 0) AS cum_paid_pu,
  (SELECT CAST(sum(free_use) AS BIGINT) FROM cum) AS cum_free_use, (SELECT CAST(sum(paid_use) AS BIGINT) FROM cum) AS cum_paid_use,
  (SELECT count(DISTINCT account_id) FROM c JOIN first_use USING (account_id)
    WHERE date = DATE '{day}' AND first_use_date = DATE '{day}') AS daily_npu
FROM live"""


@query("mart_campaign_kpi", _campaign_sql(CAMPAIGN_DAY))
def mart_campaign_kpi(t):
    return marts.campaign_kpi(t.snapshot, _coin(t), t.first_use, calendar(t), CAMPAIGN_DAY)


@query("mart_campaign_kpi_none", _campaign_sql("1980-01-01"))
def mart_campaign_kpi_none(t):
    return marts.campaign_kpi(t.snapshot, _coin(t), t.first_use, calendar(t), "1980-01-01")


@query("mart_point_sales", """
SELECT p.product_id, event_name, CAST(sum(amount) AS BIGINT) AS unit_sold, CAST(sum(local_price * amount) AS BIGINT) AS points_used, n.product_name
FROM purchase_log p LEFT JOIN (SELECT DISTINCT product_id, coalesce(product_name, product_id) AS product_name FROM offers) n
  ON p.product_id = n.product_id WHERE currency = 'point' GROUP BY 1, 2, 5""")
def mart_point_sales(t):
    return marts.point_sales(t.purchase_log, t.offers, calendar(t), CAMPAIGN_DAY, "point")


@query("mart_point_sales_daily", f"""
, o AS (SELECT DISTINCT product_id, coalesce(product_name, product_id) AS product_name FROM offers WHERE version = 2)
SELECT p.product_id, event_name, CAST(sum(amount) AS BIGINT) AS unit_sold, CAST(sum(local_price * amount) AS BIGINT) AS points_used, o.product_name,
  DATE '{LOG_DAY}' AS date
FROM purchase_log p LEFT JOIN o ON p.product_id = o.product_id WHERE currency = 'point' AND date = DATE '{LOG_DAY}' GROUP BY 1, 2, 5""")
def mart_point_sales_daily(t):
    """Of the day, in a campaign whose tab is open then, with names of items sold for points only."""
    items = t.offers.withColumn("currency", F.when(F.col("version") == 2, "point").otherwise("coin"))
    calendar = t.regions.limit(1).selectExpr("'season' AS name", "'pc' AS device", "DATE '2024-01-01' AS start_date", "DATE '2024-01-05' AS end_date",
                                             "DATE '2024-01-08' AS tab_start", "DATE '2024-01-12' AS tab_end")
    return marts.point_sales(t.purchase_log, items, calendar, LOG_DAY, "point", True, "pc", TAB)


@query("mart_currency_flow", """
SELECT date, currency, reason, coalesce(reason_detail, '') AS reason_detail, CAST(sum(amount) AS BIGINT) AS amount
FROM currency_log GROUP BY 1, 2, 3, 4""")
def mart_currency_flow(t):
    return marts.currency_flow(t.currency_log)


@query("mart_crafts", """
SELECT date, item_id, count(*) AS crafts, count(DISTINCT account_id) AS users FROM workshop_log WHERE action = 'craft' GROUP BY 1, 2""")
def mart_crafts(t):
    return marts.crafts(t.workshop_log)


_GAINED = """
SELECT date, item_id, reason, CAST(sum(amount) AS BIGINT) AS amount FROM workshop_log WHERE action = '{}' GROUP BY 1, 2, 3"""


@query("mart_crates_gained", _GAINED.format("open"))
def mart_crates_gained(t):
    return marts.items_gained(t.workshop_log, "open")


@query("mart_consumables_gained", _GAINED.format("repurpose"))
def mart_consumables_gained(t):
    return marts.items_gained(t.workshop_log, "repurpose")


@query("mart_token_purchases", """
SELECT date, currency, product_id, CAST(sum(amount) AS BIGINT) AS amount, count(DISTINCT account_id) AS users
FROM purchase_log WHERE currency LIKE '%token%' GROUP BY 1, 2, 3
UNION ALL
SELECT date, currency, 'total', CAST(sum(amount) AS BIGINT), count(DISTINCT account_id)
FROM purchase_log WHERE currency LIKE '%token%' GROUP BY 1, 2""")
def mart_token_purchases(t):
    return marts.token_purchases(t.purchase_log)


@query("mart_actions", """
, w AS (SELECT *, CASE WHEN action = 'open' THEN open_amount ELSE 1 END AS n FROM workshop_log)
SELECT date, 'open' AS action, item_id AS item, CAST(sum(n) AS BIGINT) AS count, count(DISTINCT account_id) AS users
FROM w WHERE action = 'open' GROUP BY 1, 3
UNION ALL
SELECT date, 'craft', CASE WHEN item_id LIKE '%imprint%' THEN 'imprint' WHEN item_id LIKE '%voucher%' THEN 'voucher' ELSE 'else' END,
  count(*), count(DISTINCT account_id) FROM w WHERE action = 'craft' GROUP BY 1, 3
UNION ALL
SELECT date, action, 'total', CAST(sum(n) AS BIGINT), count(DISTINCT account_id) FROM w GROUP BY 1, 2""")
def mart_actions(t):
    return marts.workshop_actions(t.workshop_log, CLASSES)


def _type_rule():
    name = F.lower("product_name")
    return (F.when(name.like("%red%"), "red").when(name.like("%blue%"), "blue").when(F.col("product_id") == "42", "key")
            .when(F.col("event_type") == "ECONOMY", "seasonal").otherwise("else"))


@query("mart_overview", _users_sql(None, False) + f"""
, f AS (SELECT s.*, CASE WHEN channel = 'A' THEN 'console' ELSE 'pc' END AS device, mu.region,
    CASE WHEN date = first_use_date THEN account_id END AS new_id,
    CASE WHEN lower(product_name) LIKE '%red%' THEN 'red' WHEN lower(product_name) LIKE '%blue%' THEN 'blue'
      WHEN product_id = '42' THEN 'key' WHEN event_type = 'ECONOMY' THEN 'seasonal' ELSE 'else' END AS product_type
  FROM sales s LEFT JOIN first_use USING (account_id) LEFT JOIN mu USING (account_id)
  WHERE channel <> 'R' AND event_type LIKE '%O%' AND date BETWEEN DATE '1998-01-01' AND DATE '{DAY}'),
l AS (SELECT device, platform, region, product_type, event_name, account_id, new_id, free_use, paid_use FROM f
  UNION ALL SELECT device, platform, region, 'total', 'total', account_id, new_id, free_use, paid_use FROM f
  UNION ALL SELECT device, platform, region, 'regular', 'regular', account_id, new_id, free_use, paid_use FROM f WHERE event_type = 'PROMO')
SELECT device, platform, region, product_type, event_name, count(DISTINCT CASE WHEN paid_use > 0 THEN account_id END) AS paid_pu,
  count(DISTINCT account_id) AS total_pu, count(DISTINCT new_id) AS npu, CAST(sum(free_use) AS BIGINT) AS free_used,
  CAST(sum(paid_use) AS BIGINT) AS paid_used, DATE '{DAY}' AS date FROM l GROUP BY 1, 2, 3, 4, 5""")
def mart_overview(t):
    coin = _coin(t).withColumn("device", F.when(F.col("channel") == "A", "console").otherwise("pc"))
    return marts.overview(t.snapshot, t.regions, coin, t.first_use, DAY, "monthly", "%O%", _type_rule(), "PROMO")


INVENTORY = f"""
, spend AS (SELECT account_id, CAST(sum(price) AS BIGINT) AS spend FROM sales
  WHERE channel = 'R' AND date BETWEEN DATE '{CASH_START}' AND DATE '{DAY}' GROUP BY 1),
cuts AS (SELECT quantile_cont(spend, 0.20) AS p20, quantile_cont(spend, 0.50) AS p50, quantile_cont(spend, 0.80) AS p80,
  quantile_cont(spend, 0.95) AS p95 FROM spend),
tiers AS (SELECT account_id, CASE WHEN spend <= p20 THEN '<=20' WHEN spend <= p50 THEN '<=50' WHEN spend <= p80 THEN '<=80'
  WHEN spend <= p95 THEN '<=95' ELSE '>95' END AS tier FROM spend, cuts),
us AS (SELECT account_id, region, coalesce(tier, 'non_pu') AS tier
  FROM (SELECT s.*, CASE WHEN country_os = 'CN' THEN country_os ELSE country_ip END AS country FROM snapshot s)
  LEFT JOIN regions ON country = country_code LEFT JOIN tiers USING (account_id)
  WHERE server_type = 'LIVE' AND last_login >= DATE '1998-01-25'),
eq AS (SELECT account_id, part, itemid, category, sub_category, name, tier, coalesce(region, 'Undefined') AS region
  FROM worn JOIN parts ON 'desc.' || part = parts.part_id LEFT JOIN part_names ON parts.part_id = part_names.part_id
  JOIN us USING (account_id) WHERE date_updated >= DATE '1998-01-25')
"""


def _inventory(t):
    cash = _cash(t).where(F.col("date").between(CASH_START, DAY))
    return marts.InventoryReports(t.snapshot, t.regions, cash, t.inventory, t.parts, t.part_names, "1998-01-25")


@query("mart_spender_tiers", INVENTORY + "SELECT region, tier, count(*) AS users FROM us GROUP BY 1, 2")
def mart_spender_tiers(t):
    return _inventory(t).users().groupBy("region", "tier").agg(F.count(F.lit(1)).alias("users"))


@query("mart_item_users", INVENTORY + """
, c AS (SELECT round(p20, 2) AS p20, round(p50, 2) AS p50, round(p80, 2) AS p80, round(p95, 2) AS p95 FROM cuts)
SELECT * FROM (
  SELECT region, tier, category, part, count(DISTINCT account_id) AS users FROM eq GROUP BY 1, 2, 3, 4
  UNION ALL SELECT region, tier, category, 'total', count(DISTINCT account_id) FROM eq GROUP BY 1, 2, 3
  UNION ALL SELECT region, tier, 'total', 'total', count(DISTINCT account_id) FROM eq GROUP BY 1, 2), c""")
def mart_item_users(t):
    return _inventory(t).item_users().withColumns({p: F.round(p, 2) for p in marts.SPEND_PERCENTILES})


@query("top50_by_group", INVENTORY + """
SELECT region, tier, category, sub_category, part, name, itemid, equip_count FROM (
  SELECT *, row_number() OVER (PARTITION BY region, tier, category ORDER BY equip_count DESC, part, itemid) AS rn
  FROM (SELECT region, tier, category, sub_category, part, name, itemid, count(*) AS equip_count FROM eq GROUP BY 1, 2, 3, 4, 5, 6, 7))
WHERE rn <= 50""")
def top50_by_group(t):
    return _inventory(t).top_items()


@query("top50_report", INVENTORY + f"""
SELECT region, tier, category, sub_category, part, name, itemid, equip_count, DATE '1998-01-25' AS start_date, DATE '{DAY}' AS end_date,
  'pc' AS device, 'itemdesc.' || itemid AS item_id FROM (
  SELECT *, row_number() OVER (PARTITION BY region, tier, category ORDER BY equip_count DESC, part, itemid) AS rn
  FROM (SELECT region, tier, category, sub_category, part, name, itemid, count(*) AS equip_count FROM eq GROUP BY 1, 2, 3, 4, 5, 6, 7))
WHERE rn <= 50""")
def top50_report(t):
    return _inventory(t).top_items_report(DAY, "pc")


@query("inventory_reports", INVENTORY + """
, us_n AS (SELECT 'users' AS report, region, tier, count(*) AS n FROM us GROUP BY 2, 3),
parts_n AS (SELECT 'equipped' AS report, region, tier, count(*) AS n FROM (SELECT DISTINCT region, tier, account_id, part, itemid FROM eq) GROUP BY 2, 3),
top_n AS (SELECT 'top' AS report, region, tier, count(*) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY region, tier, category ORDER BY equip_count DESC, part, itemid) AS rn
  FROM (SELECT region, tier, category, sub_category, part, name, itemid, count(*) AS equip_count FROM eq GROUP BY 1, 2, 3, 4, 5, 6, 7))
  WHERE rn <= 50 GROUP BY 2, 3)
SELECT * FROM us_n UNION ALL SELECT * FROM parts_n UNION ALL SELECT * FROM top_n""")
def inventory_reports(t):
    """Rows of all three results by region and tier, from one plan object whose stages are made once."""
    reports = _inventory(t)
    results = {"users": reports.users(), "equipped": reports.equipped.select("region", "tier", "account_id", "part", "itemid").distinct(), "top": reports.top_items()}
    counted = [df.groupBy("region", "tier").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("report"), "region", "tier", "n") for name, df in results.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("inventory_flattened", """
SELECT part, count(*) AS items, count(DISTINCT itemid) AS distinct_items FROM worn GROUP BY 1""")
def inventory_flattened(t):
    flat = t.inventory.selectExpr("inline(equips)")
    return flat.groupBy("part").agg(F.count(F.lit(1)).alias("items"), F.count_distinct("itemid").alias("distinct_items"))
