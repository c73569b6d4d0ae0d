"""Registered cohort reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import cohort, joins
from tallyforge.operators.levels import people_and_sums
from tallyforge.plans.registry import query

# Fixed values of the registered reports.
CUT = "1998-03-01"
MID = "2024-01-16 00:00:00"
BRANDS = {"one": "Brand#1", "two": "Brand#2", "three": "Brand#3"}


def _brand(t, name):
    return t.sales.where(F.col("event_name") == name)


@query("cohort_spend", f"""
, c AS (SELECT date, account_id, sum(paid_use + free_use) AS spend FROM purchases
  WHERE account_id IN (SELECT account_id FROM sales WHERE event_name = 'Brand#7') GROUP BY 1, 2),
k AS (SELECT account_id, min(date) < DATE '{CUT}' AS kept FROM c GROUP BY 1)
SELECT date, CASE WHEN date >= DATE '{CUT}' THEN 'after' ELSE 'before' END AS period, count(*) AS users,
  CAST(sum(spend) AS DOUBLE) / (count(*) * 100) AS mean_spend, count(CASE WHEN kept THEN 1 END) AS kept_users,
  CAST(sum(CASE WHEN kept THEN spend END) AS DOUBLE) / nullif(count(CASE WHEN kept THEN 1 END) * 100, 0) AS kept_mean_spend
FROM c JOIN k USING (account_id) GROUP BY 1, 2""")
def cohort_spend(t):
    return cohort.cohort_spend(t.purchases, _brand(t, "Brand#7"), CUT)


@query("buyer_overlap", """
, f AS (SELECT account_id, bool_or(event_name = 'Brand#1') AS one, bool_or(event_name = 'Brand#2') AS two,
  bool_or(event_name = 'Brand#3') AS three FROM sales GROUP BY 1),
m AS (SELECT account_id, 'one' AS g FROM f WHERE one UNION ALL SELECT account_id, 'two' FROM f WHERE two
  UNION ALL SELECT account_id, 'three' FROM f WHERE three),
n AS (SELECT g, count(*) AS users FROM m GROUP BY 1)
SELECT a.g AS first, b.g AS second, users, count(*) AS both, CAST(count(*) * 100 AS DOUBLE) / users AS share
FROM m a JOIN m b USING (account_id) JOIN n ON n.g = a.g WHERE a.g <> b.g GROUP BY 1, 2, 3""")
def buyer_overlap(t):
    return cohort.overlap(t.sales, {n: F.col("event_name") == b for n, b in BRANDS.items()})


@query("after_event", """
, a AS (SELECT account_id, min(time) AS first_a FROM sales WHERE event_name = 'Brand#1' GROUP BY 1)
SELECT event_name, count(*) AS lines, count(DISTINCT account_id) AS users FROM sales JOIN a USING (account_id) WHERE time > first_a GROUP BY 1""")
def after_event(t):
    later = cohort.b_after_a(_brand(t, "Brand#1"), t.sales.select("account_id", "time", "event_name"))  # rows are dealt by all their columns
    return people_and_sums(later, "account_id", ["event_name"], {"users": True}, rows="lines")


@query("first_purchase_after_event", """
, a AS (SELECT account_id, min(time) AS first_a FROM sales WHERE event_name = 'Brand#1' GROUP BY 1),
b AS (SELECT account_id, min(time) AS first_b FROM sales WHERE event_name = 'Brand#2' GROUP BY 1)
SELECT CAST(first_b AS DATE) AS first_day, count(*) AS users FROM a JOIN b USING (account_id) WHERE first_b > first_a GROUP BY 1""")
def first_purchase_after_event(t):
    first_b = _brand(t, "Brand#2").groupBy("account_id").agg(F.min("time").alias("time"))
    later = cohort.b_after_a(_brand(t, "Brand#1"), first_b)
    return later.groupBy(F.col("time").cast("date").alias("first_day")).agg(F.count("account_id").alias("users"))


@query("same_day_chain", """
, ab AS (SELECT c.* FROM clicks c JOIN (SELECT account_id, date, min(time) AS t FROM currency_log WHERE reason = 'signup' GROUP BY 1, 2) a
  USING (account_id, date) WHERE c.time > a.t),
aba AS (SELECT p.* FROM purchase_log p JOIN (SELECT account_id, date, min(time) AS t FROM ab GROUP BY 1, 2) a USING (account_id, date) WHERE p.time > a.t)
SELECT date, count(*) AS lines, count(DISTINCT account_id) AS users FROM aba GROUP BY 1""")
def same_day_chain(t):
    """Gain, then click, then purchase, all on one day."""
    keys = ["account_id", "date"]
    clicked = cohort.b_after_a(t.currency_log.where("reason = 'signup'"), t.clicks, keys)
    bought = cohort.b_after_a(clicked, t.purchase_log, keys)
    return people_and_sums(bought, "account_id", ["date"], {"users": True}, rows="lines")


SIDES = f"""
, s AS (SELECT *, time > TIMESTAMP '{CUT} 00:00:00' AS is_after FROM purchases),
u AS (SELECT account_id, count(DISTINCT is_after) AS sides FROM s GROUP BY 1)
"""


@query("both_sides_users", SIDES + "SELECT CAST(sides AS INTEGER) AS sides, count(*) AS users FROM u GROUP BY 1")
def both_sides_users(t):
    return cohort.both_sides(t.purchases, f"{CUT} 00:00:00").groupBy("sides").agg(F.count("account_id").alias("users"))


@query("both_sides_spend", SIDES + """
SELECT is_after, count(DISTINCT account_id) AS users, CAST(sum(paid_use) AS BIGINT) AS paid_use,
  CAST(sum(paid_use + free_use) AS BIGINT) AS total_use FROM s JOIN u USING (account_id) WHERE sides = 2 GROUP BY 1""")
def both_sides_spend(t):
    both = cohort.both_sides(t.purchases, f"{CUT} 00:00:00").where("sides = 2")
    return cohort.bought_by(cohort.with_side(t.purchases, f"{CUT} 00:00:00"), both, ["is_after"])


SPLIT = f"""
, g AS (SELECT * FROM currency_log WHERE amount > 0),
sp AS (SELECT account_id, CAST(sum(CASE WHEN time <= TIMESTAMP '{MID}' THEN amount END) AS BIGINT) AS before_amount,
  CAST(sum(CASE WHEN time > TIMESTAMP '{MID}' THEN amount END) AS BIGINT) AS after_amount FROM g GROUP BY 1)
"""


@query("cutoff_split", SPLIT + "SELECT * FROM sp")
def cutoff_split(t):
    return cohort.split_amount(t.currency_log.where("amount > 0"), MID, "amount")


@query("only_after_users", f"""
, sp AS (SELECT account_id, min(date) AS first_day, CAST(sum(price) AS BIGINT) AS after_amount FROM purchases GROUP BY 1)
SELECT account_id, after_amount FROM sp WHERE first_day >= DATE '1995-07-01'""")
def only_after_users(t):
    split = cohort.split_amount(t.purchases.withColumn("day", F.col("date").cast("timestamp_ntz")),
                                "1995-06-30 12:00:00", "price", time="day")
    return cohort.only_after(split).select("account_id", "after_amount")


@query("first_event_source", """
, f AS (SELECT account_id, min(time) AS first_time FROM currency_log WHERE amount <> 0 GROUP BY 1),
u AS (SELECT DISTINCT account_id FROM currency_log JOIN f USING (account_id) WHERE time = first_time AND reason = 'purchase')
SELECT product_name, CAST(sum(paid_use) AS BIGINT) AS paid_use, CAST(sum(paid_use + free_use) AS BIGINT) AS total_use,
  count(DISTINCT account_id) AS users FROM sales WHERE account_id IN (SELECT account_id FROM u) GROUP BY 1""")
def first_event_source(t):
    starters = cohort.first_event(t.currency_log.where("amount <> 0"), "purchase")
    return cohort.bought_by(t.sales, starters, ["product_name"])


@query("anti_cohort", """
SELECT region, count(*) AS users FROM users
WHERE account_id NOT IN (SELECT account_id FROM sales WHERE event_name = 'Brand#1')
  AND account_id NOT IN (SELECT account_id FROM sales WHERE event_name = 'Brand#2') GROUP BY 1""")
def anti_cohort(t):
    rest = joins.exclude(t.users, _brand(t, "Brand#1"), _brand(t, "Brand#2"))
    return rest.groupBy("region").agg(F.count("account_id").alias("users"))


@query("participation_codes", """
, c AS (SELECT DISTINCT account_id, 1 AS code FROM sales WHERE event_name = 'Brand#1'
  UNION ALL SELECT DISTINCT account_id, 3 FROM purchase_log WHERE local_price > 12000
  UNION ALL SELECT DISTINCT account_id, 5 FROM pass_status WHERE levelup_xp > 12000)
SELECT CAST(code AS BIGINT) AS code, count(*) AS users FROM (SELECT account_id, sum(code) AS code FROM c GROUP BY 1) GROUP BY 1""")
def participation_codes(t):
    return cohort.participation([(_brand(t, "Brand#1"), 1), (t.purchase_log.where("local_price > 12000"), 3), (t.pass_status.where("levelup_xp > 12000"), 5)])


FIRSTS = """
, f AS (SELECT account_id, min(CASE WHEN event_type = 'signup' THEN time END) AS signup,
  min(CASE WHEN event_type = 'click' THEN time END) AS click, min(CASE WHEN event_type = 'purchase' THEN time END) AS purchase
  FROM log GROUP BY 1)
"""
_STEPS = """
SELECT 1 AS step, 'signup' AS name, count(signup) AS reached, count(signup) AS in_order FROM g
UNION ALL SELECT 2, 'click', count(CASE WHEN signup IS NOT NULL AND click IS NOT NULL THEN 1 END), count(CASE WHEN signup < click THEN 1 END) FROM g
UNION ALL SELECT 3, 'purchase', count(CASE WHEN signup IS NOT NULL AND click IS NOT NULL AND purchase IS NOT NULL THEN 1 END),
  count(CASE WHEN signup < click AND click < purchase THEN 1 END) FROM g"""
STEPS = {s: f"event_type = '{s}'" for s in ("signup", "click", "purchase")}


def _firsts(t):
    return cohort.first_times(t.log, {s: F.expr(c) for s, c in STEPS.items()})


@query("funnel_3step", FIRSTS + ", g AS (SELECT * FROM f)" + _STEPS)
def funnel_3step(t):
    return cohort.funnel(_firsts(t), list(STEPS))


@query("funnel_excluding_cohort", FIRSTS + """
, g AS (SELECT * FROM f WHERE account_id NOT IN (SELECT account_id FROM log WHERE event_type = 'error' AND cents > 15000))""" + _STEPS)
def funnel_excluding_cohort(t):
    return cohort.funnel(joins.exclude(_firsts(t), t.log.where("event_type = 'error' AND cents > 15000")), list(STEPS))


@query("funnel_with_page_visit", FIRSTS + """
, page AS (SELECT DISTINCT account_id FROM clicks WHERE label = 'home')
SELECT count(*) AS visited, count(CASE WHEN signup < click THEN 1 END) AS in_order,
  count(CASE WHEN account_id NOT IN (SELECT account_id FROM votes WHERE game_id LIKE '%BONUS%') THEN 1 END) AS no_bonus_vote
FROM f JOIN page USING (account_id)""")
def funnel_with_page_visit(t):
    visited = joins.in_cohort(_firsts(t), t.clicks.where("label = 'home'"))
    marked = joins.in_cohort(visited, t.votes.where("game_id LIKE '%BONUS%'"), flag="bonus")
    return marked.agg(F.count(F.lit(1)).alias("visited"), F.count_if(F.expr("signup < click")).alias("in_order"),
                      F.count_if(~F.col("bonus")).alias("no_bonus_vote"))


@query("funnel_without_purchase", FIRSTS + """
, g AS (SELECT account_id, greatest(signup, click) AS done FROM f WHERE signup IS NOT NULL AND click IS NOT NULL AND purchase IS NULL),
m AS (SELECT account_id, account_id IN (SELECT account_id FROM votes WHERE game_id LIKE '%BONUS%') AS bonus,
  EXISTS (SELECT 1 FROM clicks c WHERE c.account_id = g.account_id AND label = 'home' AND c.time > done) AS visited FROM g)
SELECT count(*) AS users, count(CASE WHEN bonus THEN 1 END) AS bonus_voters, count(CASE WHEN visited THEN 1 END) AS visited_after,
  count(CASE WHEN visited AND bonus THEN 1 END) AS visited_with_bonus, count(CASE WHEN visited AND NOT bonus THEN 1 END) AS visited_without_bonus
FROM m""")
def funnel_without_purchase(t):
    """Signed up and clicked but did not buy: bonus voters among them, and visits of the page after both steps."""
    left = cohort.did_without(_firsts(t), ["signup", "click"], ["purchase"]).select("account_id", "done")
    pages = t.clicks.where("label = 'home'").groupBy("account_id").agg(F.max("time").alias("last_visit"))
    marked = joins.in_cohort(left.join(pages, "account_id", "left"), t.votes.where("game_id LIKE '%BONUS%'"), flag="bonus")
    visited = F.coalesce(F.col("last_visit") > F.col("done"), F.lit(False))
    return marked.agg(F.count(F.lit(1)).alias("users"), F.count_if("bonus").alias("bonus_voters"), F.count_if(visited).alias("visited_after"),
                      F.count_if(visited & F.col("bonus")).alias("visited_with_bonus"), F.count_if(visited & ~F.col("bonus")).alias("visited_without_bonus"))


@query("threshold_takeup", """
, rich AS (SELECT account_id FROM currency_log WHERE amount > 0 GROUP BY 1 HAVING sum(amount) >= 200000)
SELECT product_id, count(DISTINCT account_id) AS pu, (SELECT count(*) FROM rich) AS users,
  CAST(count(DISTINCT account_id) AS DOUBLE) / (SELECT count(*) FROM rich) AS takeup
FROM purchase_log WHERE account_id IN (SELECT account_id FROM rich) GROUP BY 1""")
def threshold_takeup(t):
    return cohort.threshold_takeup(t.currency_log.where("amount > 0"), 200000, t.purchase_log)


@query("retention", """
, a AS (SELECT DISTINCT account_id FROM sales WHERE event_name = 'Brand#1'), b AS (SELECT DISTINCT account_id FROM sales WHERE event_name = 'Brand#2')
SELECT (SELECT count(*) FROM a) AS earlier_users, (SELECT count(*) FROM b) AS later_users, count(*) AS retained,
  CAST(count(*) * 100 AS DOUBLE) / (SELECT count(*) FROM a) AS retention FROM a JOIN b USING (account_id)""")
def retention(t):
    return cohort.retention(_brand(t, "Brand#1"), _brand(t, "Brand#2"))


@query("retained_users_buy", """
SELECT trim(event_type) AS event_type, count(DISTINCT account_id) AS users, CAST(sum(paid_use) AS BIGINT) AS paid_use,
  CAST(sum(paid_use + free_use) AS BIGINT) AS total_use FROM sales
WHERE account_id IN (SELECT account_id FROM sales WHERE event_name = 'Brand#1') GROUP BY 1""")
def retained_users_buy(t):
    return cohort.bought_by(t.sales.withColumn("event_type", F.trim("event_type")), _brand(t, "Brand#1"), ["event_type"])


@query("new_buyer_kpi", """
, f AS (SELECT p.*, region, date = first_use_date AS is_new FROM purchases p JOIN users USING (account_id) LEFT JOIN first_use USING (account_id))
SELECT region, count(DISTINCT account_id) AS pu, count(DISTINCT CASE WHEN is_new THEN account_id END) AS npu,
  count(DISTINCT CASE WHEN is_new AND paid_use > 0 THEN account_id END) AS paid_npu, CAST(sum(paid_use + free_use) AS BIGINT) AS total_use,
  CAST(sum(CASE WHEN is_new THEN paid_use + free_use END) AS BIGINT) AS new_use,
  CAST(sum(CASE WHEN is_new THEN paid_use + free_use END) * 100 AS DOUBLE) / sum(paid_use + free_use) AS new_share FROM f GROUP BY 1""")
def new_buyer_kpi(t):
    return cohort.new_buyer_kpi(t.purchases, t.first_use, ["region"], attrs=t.users.select("account_id", "region"))


@query("first_buy_order", """
, a AS (SELECT account_id, min(date) AS a_day FROM sales WHERE event_name = 'Brand#1' GROUP BY 1),
b AS (SELECT account_id, min(date) AS b_day FROM sales WHERE event_name = 'Brand#2' GROUP BY 1)
SELECT CASE WHEN a_day < b_day THEN 'a' WHEN a_day = b_day THEN 'b' WHEN a_day > b_day THEN 'c' WHEN a_day IS NULL THEN 'd' ELSE 'e' END AS case,
  count(*) AS users FROM a FULL JOIN b USING (account_id) GROUP BY 1""")
def first_buy_order(t):
    return cohort.first_order(_brand(t, "Brand#1"), _brand(t, "Brand#2"))


@query("pass_uptake", """
SELECT pass_name, count(DISTINCT account_id) AS users FROM pass_status
WHERE status = 'pass' AND ((pass_name = 'season1' AND date <= DATE '2024-01-07') OR (pass_name = 'season2' AND date <= DATE '2024-01-03')) GROUP BY 1""")
def pass_uptake(t):
    return cohort.pass_uptake(t.pass_status.where("status = 'pass'"), {"season1": "2024-01-07", "season2": "2024-01-03"})


@query("pass_share_of_active", """
, ids AS (SELECT account_id FROM pass_status WHERE status = 'pass' AND level >= 80 UNION SELECT account_id FROM purchase_log WHERE product_id = '7')
SELECT count(DISTINCT account_id) AS au, (SELECT count(*) FROM ids) AS pass_users,
  CAST((SELECT count(*) FROM ids) AS DOUBLE) / count(DISTINCT account_id) AS share FROM active_days""")
def pass_share_of_active(t):
    return cohort.pass_share(t.active_days, t.pass_status.where("status = 'pass' AND level >= 80"),
                             t.purchase_log.where("product_id = '7'"))


@query("segment_cross_check", """
SELECT region, membership, count(*) AS users FROM users WHERE account_id IN (SELECT account_id FROM pass_status WHERE status = 'pass') GROUP BY 1, 2""")
def segment_cross_check(t):
    return cohort.cross_check(t.users, t.pass_status.where("status = 'pass'"), ["region", "membership"])
