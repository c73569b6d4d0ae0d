"""Registered KPI reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import kpi
from tallyforge.plans.registry import query

# Fixed values of the registered reports (dates, groups and patterns they ask for).
LAUNCH = "1998-03-01"
ANCHOR = "1997-01-01"
GROUPS = [("bundle", ["Brand#1", "Brand#2"]), ("set", ["Brand#3", "Brand#4", "Brand#5"])]
VOTE_TYPES = [("%BONUS%", "bonus"), ("%SOLO%", "solo"), ("%TEAM%", "team"), ("%DUEL%", "duel")]
VOTE_REGIONS = [("%EAST%", "east"), ("%WEST%", "west")]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

RATIOS = """CAST(pu AS DOUBLE) / nullif(au, 0) AS pur, CAST(paid_pu AS DOUBLE) / nullif(au, 0) AS paid_pur, CAST(total_use AS DOUBLE) / nullif(au, 0) AS arpu,
  CAST(total_use AS DOUBLE) / nullif(pu, 0) AS arppu"""
SOLD = """count(DISTINCT account_id) AS pu, count(DISTINCT CASE WHEN paid_use > 0 THEN account_id END) AS paid_pu,
  CAST(sum(paid_use) AS BIGINT) AS paid_use, CAST(sum(paid_use + free_use) AS BIGINT) AS total_use"""


def _kpi_by_sql(dim: str) -> str:
    return f"""
, au AS (SELECT {dim}, count(DISTINCT account_id) AS au FROM users GROUP BY 1),
sold AS (SELECT {dim}, {SOLD} FROM purchases LEFT JOIN users USING (account_id) GROUP BY 1),
j AS (SELECT {dim}, au, coalesce(pu, 0) AS pu, coalesce(paid_pu, 0) AS paid_pu, coalesce(paid_use, 0) AS paid_use,
        coalesce(total_use, 0) AS total_use FROM au LEFT JOIN sold USING ({dim}))
SELECT *, {RATIOS} FROM j"""


@query("kpi_by_region", _kpi_by_sql("region"))
def kpi_by_region(t):
    return kpi.kpi_by(t.users, t.purchases, ["region"])


@query("kpi_by_membership", _kpi_by_sql("membership"))
def kpi_by_membership(t):
    return kpi.kpi_by(t.users, t.purchases, ["membership"])


@query("kpi_by_country", _kpi_by_sql("country"))
def kpi_by_country(t):
    return kpi.kpi_by(t.users, t.purchases, ["country"])


DAILY = f"""
, au AS (SELECT date, count(DISTINCT account_id) AS au FROM active_days GROUP BY 1),
sold AS (SELECT date, {SOLD} FROM purchases GROUP BY 1),
daily AS (SELECT date, au, pu, paid_pu, paid_use, total_use, {RATIOS} FROM au LEFT JOIN sold USING (date))
"""


@query("daily_kpi", DAILY + "SELECT * FROM daily")
def daily_kpi(t):
    return kpi.daily_kpi(t.active_days, t.purchases)


@query("pre_post_week", DAILY + f"""
SELECT *, CASE WHEN date < DATE '{LAUNCH}' THEN 'pre' ELSE 'post' END AS period FROM daily
WHERE date BETWEEN DATE '{LAUNCH}' - 7 AND DATE '{LAUNCH}' + 6""")
def pre_post_week(t):
    return kpi.pre_post(t.active_days, t.purchases, LAUNCH, 7)


@query("product_rank", """
SELECT product_name, count(DISTINCT account_id) AS pu, CAST(sum(qty) AS BIGINT) AS units, CAST(sum(price) AS BIGINT) AS revenue,
  CAST(sum(price) AS DOUBLE) / count(*) AS mean_price, CAST(sum(price) AS DOUBLE) / count(DISTINCT account_id) AS arppu
FROM sales GROUP BY 1""")
def product_rank(t):
    return kpi.product_rank(t.sales)


RANKED = """
, units AS (SELECT date, product_id, CAST(sum(qty) AS BIGINT) AS units FROM purchases GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY date ORDER BY units DESC, product_id) AS INTEGER) AS rank FROM units)
SELECT product_id, date, units, rank, product_name, event_name FROM ranked JOIN products USING (product_id)"""


@query("rank_in_day", RANKED)
def rank_in_day(t):
    return kpi.rank_in_day(t.purchases, t.products)


@query("top10_in_day", RANKED + " WHERE rank <= 10")
def top10_in_day(t):
    return kpi.rank_in_day(t.purchases, t.products, 10)


@query("product_kpi", """
SELECT product_name, count(DISTINCT transaction_id) AS transactions, CAST(sum(qty) AS BIGINT) AS units,
  CAST(sum(paid_use) AS BIGINT) AS paid_use, CAST(sum(paid_use + free_use) AS BIGINT) AS total_use FROM sales GROUP BY 1""")
def product_kpi(t):
    return kpi.product_kpi(t.sales, ["product_name"])


@query("product_kpi_by_platform", """
SELECT product_name, platform, count(DISTINCT transaction_id) AS transactions, CAST(sum(qty) AS BIGINT) AS units,
  CAST(sum(paid_use) AS BIGINT) AS paid_use, CAST(sum(paid_use + free_use) AS BIGINT) AS total_use FROM sales GROUP BY 1, 2""")
def product_kpi_by_platform(t):
    return kpi.product_kpi(t.sales, ["product_name", "platform"])


CTR = """
, item AS (SELECT *, nullif(split_part(label, '.', 2), '') AS item_id FROM clicks),
counted AS (SELECT date, item_id, count(CASE WHEN action = 'detail' THEN 1 END) AS detail_clicks,
  count(CASE WHEN action = 'buy' THEN 1 END) AS buy_clicks FROM item WHERE item_id IS NOT NULL GROUP BY 1, 2),
per_item AS (SELECT date, product_name, event_name, detail_clicks, buy_clicks,
  CAST(buy_clicks AS DOUBLE) / detail_clicks AS ctr
  FROM counted JOIN products ON item_id = product_id WHERE detail_clicks > 0 AND buy_clicks > 0)
"""


def _per_item(t):
    from tallyforge.functions.columns import part_after

    clicks = t.clicks.withColumn("item_id", part_after("label"))
    items = t.products.select(F.col("product_id").alias("item_id"), "product_name", "event_name")
    return kpi.ctr(clicks, items, ["product_name", "event_name"])


@query("ctr_by_day_and_item", CTR + "SELECT * FROM per_item")
def ctr_by_day_and_item(t):
    return _per_item(t)


@query("ctr_by_day", CTR + """
SELECT date, round(sum(ctr) / count(*), 6) AS ctr, CAST(sum(buy_clicks) AS DOUBLE) / count(*) AS buy_clicks,
  CAST(sum(detail_clicks) AS DOUBLE) / count(*) AS detail_clicks FROM per_item GROUP BY 1""")
def ctr_by_day(t):
    return kpi.mean_ctr(_per_item(t), ["date"]).withColumn("ctr", F.round("ctr", 6))


@query("ctr_bundle_vs_rest", CTR + """
SELECT date, event_name = 'Brand#1' AS is_bundle, round(sum(ctr) / count(*), 6) AS ctr,
  CAST(sum(buy_clicks) AS DOUBLE) / count(*) AS buy_clicks,
  CAST(sum(detail_clicks) AS DOUBLE) / count(*) AS detail_clicks FROM per_item GROUP BY 1, 2""")
def ctr_bundle_vs_rest(t):
    split = _per_item(t).withColumn("is_bundle", F.col("event_name") == "Brand#1")
    return kpi.mean_ctr(split, ["date", "is_bundle"]).withColumn("ctr", F.round("ctr", 6))


@query("group_kpi_by_day", f"""
SELECT date, CASE WHEN event_name IN ('Brand#1', 'Brand#2') THEN 'bundle'
  WHEN event_name IN ('Brand#3', 'Brand#4', 'Brand#5') THEN 'set' ELSE 'others' END AS product_group,
  {SOLD}, CAST(sum(qty) AS BIGINT) AS units FROM sales GROUP BY 1, 2""")
def group_kpi_by_day(t):
    return kpi.group_kpi(t.sales, GROUPS, ["date"], column="event_name")


FIRST = """
, first AS (SELECT account_id, min(date) AS first_date, min(time) AS first_time, count(DISTINCT product_id) AS products
  FROM purchases GROUP BY 1)
"""


@query("first_purchase", FIRST + "SELECT * FROM first")
def first_purchase(t):
    return kpi.first_purchase(t.purchases)


@query("first_purchase_by_day", FIRST + "SELECT first_date, count(*) AS users FROM first GROUP BY 1")
def first_purchase_by_day(t):
    return kpi.users_by(kpi.first_purchase(t.purchases), ["first_date"])


@query("product_breadth", FIRST + "SELECT products, count(*) AS users FROM first GROUP BY 1")
def product_breadth(t):
    return kpi.users_by(kpi.first_purchase(t.purchases), ["products"])


VOTES = """
, v AS (SELECT *, CASE WHEN game_id LIKE '%BONUS%' THEN 'bonus' WHEN game_id LIKE '%SOLO%' THEN 'solo'
    WHEN game_id LIKE '%TEAM%' THEN 'team' WHEN game_id LIKE '%DUEL%' THEN 'duel' END AS vote_type,
  CASE WHEN game_id LIKE '%EAST%' THEN 'east' WHEN game_id LIKE '%WEST%' THEN 'west' END AS vote_region FROM votes),
vu AS (SELECT v.*, region, membership FROM v JOIN users USING (account_id))
"""


def _votes(t):
    return kpi.labelled(t.votes, {"vote_type": VOTE_TYPES, "vote_region": VOTE_REGIONS}, "game_id")


def _segments(t, *dims):
    """The user attributes that a report groups by; joined after the rows of each user have been summed."""
    return t.users.select("account_id", *(dims or ("region", "membership")))


@query("label_votes", VOTES + "SELECT vote_type, count(DISTINCT account_id) AS voters, count(*) AS votes FROM v GROUP BY 1")
def label_votes(t):
    return kpi.vote_kpi(kpi.labelled(t.votes, {"vote_type": VOTE_TYPES}, "game_id"), ["vote_type"])


@query("votes_by_day", VOTES + """
SELECT date, membership, count(DISTINCT account_id) AS voters, count(*) AS votes FROM vu GROUP BY 1, 2""")
def votes_by_day(t):
    return kpi.vote_kpi(_votes(t), ["date", "membership"], attrs=_segments(t, "membership"))


@query("votes_by_type_and_region", VOTES + """
SELECT vote_type, vote_region, region, membership, count(DISTINCT account_id) AS voters, count(*) AS votes
FROM vu GROUP BY 1, 2, 3, 4""")
def votes_by_type_and_region(t):
    return kpi.vote_kpi(_votes(t), ["vote_type", "vote_region", "region", "membership"], attrs=_segments(t))


@query("crosstab_region_membership", """
SELECT region, """ + ", ".join(
    f"nullif(count(DISTINCT CASE WHEN membership = '{s}' THEN account_id END), 0) AS \"{s}\"" for s in SEGMENTS) + """
FROM purchases JOIN users USING (account_id) GROUP BY 1""")
def crosstab_region_membership(t):
    buyers = t.purchases.select("account_id").distinct().join(t.users, "account_id")
    counted = kpi.users_by(buyers, ["region", "membership"])
    return kpi.crosstab(counted, "region", "membership", SEGMENTS, F.first("users"))


@query("crosstab_votes", VOTES + """
SELECT date, """ + ", ".join(
    f"nullif(count(DISTINCT CASE WHEN membership = '{s}' THEN account_id END), 0) AS \"{s}\"" for s in SEGMENTS) + """
FROM vu GROUP BY 1""")
def crosstab_votes(t):
    return kpi.crosstab(kpi.vote_kpi(_votes(t), ["date", "membership"], attrs=_segments(t, "membership")), "date", "membership", SEGMENTS, F.first("voters"))


SIGN = """
, s AS (SELECT *, CASE WHEN amount > 0 THEN '+' ELSE '-' END AS side FROM currency_log)
"""


@query("sign_split_by_day", SIGN + """
SELECT date, reason, side, count(DISTINCT account_id) AS users, CAST(sum(amount) AS BIGINT) AS amount FROM s GROUP BY 1, 2, 3""")
def sign_split_by_day(t):
    return kpi.sign_split(t.currency_log, "amount", ["date", "reason"])


@query("sign_split_by_segment", SIGN + """
SELECT region, membership, side, count(DISTINCT account_id) AS users, CAST(sum(amount) AS BIGINT) AS amount
FROM s LEFT JOIN users USING (account_id) GROUP BY 1, 2, 3""")
def sign_split_by_segment(t):
    return kpi.sign_split(t.currency_log, "amount", ["region", "membership"], attrs=_segments(t))


@query("sign_mean_per_user", SIGN + """
SELECT side, CAST(sum(amount) AS DOUBLE) / count(*) AS mean_amount
FROM (SELECT side, account_id, sum(amount) AS amount FROM s GROUP BY 1, 2) GROUP BY 1""")
def sign_mean_per_user(t):
    return kpi.sign_mean(t.currency_log, "amount")


WEEK = f"DATE '{ANCHOR}' + CAST(floor(CAST(date - DATE '{ANCHOR}' AS DOUBLE) / 7) AS INTEGER) * 7"


@query("week_buckets", f"""
SELECT {WEEK} AS week_start, CAST(sum(paid_use) AS BIGINT) AS paid_use,
  CAST(sum(paid_use + free_use) AS BIGINT) AS total_use FROM purchases GROUP BY 1""")
def week_buckets(t):
    return kpi.weekly_sales(t.purchases, ANCHOR)


@query("weekly_actives", f"SELECT {WEEK} AS week_start, count(DISTINCT account_id) AS wau FROM active_days GROUP BY 1")
def weekly_actives(t):
    return kpi.weekly_actives(t.active_days, ANCHOR)


@query("max_level_hist", """
SELECT pass_name, max_level, count(*) AS users FROM (
  SELECT pass_name, account_id, max(level) AS max_level FROM pass_status WHERE status = 'pass' GROUP BY 1, 2) GROUP BY 1, 2""")
def max_level_hist(t):
    return kpi.max_level_hist(t.pass_status.where("status = 'pass'"), ["pass_name"])


@query("pass_rates_by_region", """
SELECT region, count(DISTINCT account_id) AS users, count(DISTINCT CASE WHEN status = 'pass' THEN account_id END) AS pass_users,
  CAST(count(DISTINCT CASE WHEN status = 'pass' THEN account_id END) AS DOUBLE) / count(DISTINCT account_id) AS pass_rate
FROM pass_status LEFT JOIN users USING (account_id) WHERE status IN ('active', 'pass') GROUP BY 1""")
def pass_rates_by_region(t):
    return kpi.pass_rates(t.pass_status, ["region"], attrs=_segments(t, "region"))


@query("pass_levels_by_region", """
, h AS (SELECT * FROM pass_status JOIN users USING (account_id) WHERE status = 'pass'),
tot AS (SELECT region, count(DISTINCT account_id) AS pass_users FROM h GROUP BY 1)
SELECT region, level, count(DISTINCT account_id) AS users, pass_users,
  CAST(count(DISTINCT account_id) AS DOUBLE) / pass_users AS level_rate
FROM h JOIN tot USING (region) GROUP BY region, level, pass_users""")
def pass_levels_by_region(t):
    return kpi.pass_levels(t.pass_status, ["region"], attrs=_segments(t, "region"))


@query("levelup_rate_by_day", """
SELECT date, count(DISTINCT account_id) AS users, CAST(sum(levelup_xp) AS BIGINT) AS levelup_xp,
  CAST(sum(CASE WHEN levelup_xp > 0 THEN 1 END) AS BIGINT) AS levelups,
  round(CAST(sum(CASE WHEN levelup_xp > 0 THEN 1 END) AS DOUBLE) / count(DISTINCT account_id), 3) AS levelup_rate
FROM pass_status WHERE status = 'pass' GROUP BY 1""")
def levelup_rate_by_day(t):
    return kpi.levelup_by_day(t.pass_status)


@query("pass_status_by_day", """
SELECT date, CAST(sum(CASE WHEN status = 'active' THEN 1 END) AS BIGINT) AS active_rows,
  CAST(sum(CASE WHEN status = 'pass' THEN 1 END) AS BIGINT) AS pass_rows
FROM pass_status WHERE status IN ('active', 'pass') GROUP BY 1""")
def pass_status_by_day(t):
    return kpi.status_by_day(t.pass_status)


TWO_STAGE = """
, fine AS (SELECT date, platform, region, count(DISTINCT account_id) AS au
  FROM active_days JOIN users USING (account_id) GROUP BY 1, 2, 3)
"""


@query("two_stage_kpi_by_day", TWO_STAGE + """
SELECT date, au, pu, CAST(pu AS DOUBLE) / nullif(au, 0) AS pur
FROM (SELECT date, CAST(sum(au) AS BIGINT) AS au FROM fine GROUP BY 1)
JOIN (SELECT date, count(DISTINCT account_id) AS pu FROM purchases GROUP BY 1) USING (date)""")
def two_stage_kpi_by_day(t):
    return kpi.two_stage_kpi(t.active_days, t.purchases, ["date", "platform", "region"], ["date"], attrs=_segments(t, "region"))


@query("two_stage_kpi_by_platform", TWO_STAGE + """
SELECT date, platform, au, pu, CAST(pu AS DOUBLE) / nullif(au, 0) AS pur
FROM (SELECT date, platform, CAST(sum(au) AS BIGINT) AS au FROM fine GROUP BY 1, 2)
JOIN (SELECT date, platform, count(DISTINCT account_id) AS pu FROM purchases GROUP BY 1, 2) USING (date, platform)""")
def two_stage_kpi_by_platform(t):
    return kpi.two_stage_kpi(t.active_days, t.purchases, ["date", "platform", "region"], ["date", "platform"], attrs=_segments(t, "region"))


@query("campaign_totals", f"SELECT event_name, {SOLD} FROM sales GROUP BY 1")
def campaign_totals(t):
    return kpi.campaign_totals(t.sales, ["event_name"])


@query("overall_totals", f"SELECT {SOLD} FROM purchases")
def overall_totals(t):
    return kpi.campaign_totals(t.purchases)


@query("arppu_by_membership", f"""
SELECT *, CAST(total_use AS DOUBLE) / nullif(pu, 0) AS arppu, CAST(paid_use AS DOUBLE) / nullif(paid_pu, 0) AS paid_arppu
FROM (SELECT membership, {SOLD} FROM purchases JOIN users USING (account_id) GROUP BY 1)""")
def arppu_by_membership(t):
    return kpi.arppu_by(t.purchases, "membership", attrs=_segments(t, "membership"))


@query("price_list", "SELECT DISTINCT product_name, list_price FROM products")
def price_list(t):
    return kpi.value_list(t.products, ["product_name", "list_price"], [F.desc("list_price"), F.asc("product_name")])


@query("coupon_flow", """
SELECT region, membership, count(DISTINCT CASE WHEN amount > 0 THEN account_id END) AS owners,
  count(DISTINCT CASE WHEN reason = 'purchase' THEN account_id END) AS spenders,
  CAST(sum(CASE WHEN amount > 0 THEN amount END) AS BIGINT) AS gained,
  CAST(sum(CASE WHEN reason = 'purchase' THEN amount END) AS BIGINT) AS used
FROM currency_log LEFT JOIN users USING (account_id) WHERE currency LIKE 'coupon%' GROUP BY 1, 2""")
def coupon_flow(t):
    return kpi.coupon_flow(t.currency_log, ["region", "membership"], "coupon", "purchase", attrs=_segments(t))


@query("coupon_totals", """
SELECT CASE WHEN currency LIKE '%coupon.free%' THEN 'free' WHEN currency LIKE '%coupon.paid%' THEN 'paid' END AS kind,
  CAST(sum(amount) AS BIGINT) AS amount FROM currency_log WHERE amount > 0 GROUP BY 1""")
def coupon_totals(t):
    return kpi.coupon_totals(t.currency_log, [("%coupon.free%", "free"), ("%coupon.paid%", "paid")])


@query("same_day_attributes", """
, snap AS (SELECT DISTINCT account_id, date, play_mode FROM active_days)
SELECT play_mode, count(*) AS lines, CAST(sum(price) AS BIGINT) AS revenue
FROM purchases LEFT JOIN snap USING (account_id, date) GROUP BY 1""")
def same_day_attributes(t):
    joined = kpi.same_day_join(t.purchases, t.active_days, ["play_mode"])
    return joined.groupBy("play_mode").agg(F.count(F.lit(1)).alias("lines"), F.sum("price").alias("revenue"))
