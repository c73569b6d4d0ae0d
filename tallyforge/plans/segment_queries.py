"""Registered segments and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.columns import label_in, total_use
from tallyforge.operators import segment
from tallyforge.operators.quantile import exact_percentiles
from tallyforge.plans.registry import query
from tallyforge.plans.sequence_queries import OWNED, owned

# Fixed values of the registered reports.
EDGES = [(120_000_000, "A"), (180_000_000, "B"), (210_000_000, "C"), (240_000_000, "D")]
QUINTILES = {"q20": 0.2, "q40": 0.4, "q60": 0.6, "q80": 0.8}
PASS, PRODUCT, LEVEL = "Brand#1", "Brand#2", "Brand#3"
SHORT = {"black": "SB", "white": "SW", "yellow": "EY"}
CRATES = {"imprint.0": "loot", "voucher.4": "prime", "part.7": "event"}
VIEWS = [f"{v}_{s}" for v in ("tpp", "fpp") for s in ("solo", "duo", "squad")]

PER_USER = "SELECT account_id, CAST(sum(paid_use) AS BIGINT) AS paid_use, CAST(sum(paid_use + free_use) AS BIGINT) AS total_use FROM purchases GROUP BY 1"


@query("spend_tiers", f"""
, p AS ({PER_USER})
SELECT CASE WHEN total_use <= 120000000 THEN 'A' WHEN total_use <= 180000000 THEN 'B' WHEN total_use <= 210000000 THEN 'C'
  WHEN total_use <= 240000000 THEN 'D' ELSE 'E' END AS tier, count(*) AS users, CAST(sum(total_use) AS BIGINT) AS total_use FROM p GROUP BY 1""")
def spend_tiers(t):
    return segment.spend_tiers(t.purchases, EDGES).groupBy("tier").agg(
        F.count("account_id").alias("users"), F.sum("total_use").alias("total_use"))


@query("spend_quantile_preview", f"""
, p AS ({PER_USER})
SELECT round(quantile_cont(total_use, 0.2), 2) AS q20, round(quantile_cont(total_use, 0.4), 2) AS q40,
  round(quantile_cont(total_use, 0.6), 2) AS q60, round(quantile_cont(total_use, 0.8), 2) AS q80 FROM p""")
def spend_quantile_preview(t):
    spend = segment.spend_tiers(t.purchases, EDGES)
    return exact_percentiles(spend, "total_use", QUINTILES).select(*[F.round(q, 2).alias(q) for q in QUINTILES])


MAIN = """
, cat AS (SELECT account_id, event_type, CAST(sum(paid_use + free_use) AS BIGINT) AS amount FROM sales GROUP BY 1, 2),
main AS (SELECT account_id, event_type AS main_category, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY amount DESC, event_type) AS rn FROM cat) WHERE rn = 1)
"""


@query("main_category", MAIN + "SELECT * FROM main")
def main_category(t):
    return segment.main_category(t.sales, "event_type")


_ADD = " + ".join("{}".format(v + "_{0}") for v in VIEWS)
PLAY = f"""
, play AS (SELECT account_id, count(DISTINCT date) AS play_days, CAST(sum({_ADD.format('count')}) AS BIGINT) AS plays,
  CAST(sum({_ADD.format('minute')}) AS BIGINT) AS minutes FROM gameplay GROUP BY 1)
"""


def _play(t):
    return segment.play_profile(t.gameplay, [f"{v}_count" for v in VIEWS], [f"{v}_minute" for v in VIEWS])


@query("play_profile", PLAY + "SELECT * FROM play")
def play_profile(t):
    return _play(t)


@query("profile_merge", PLAY + MAIN + f"""
, p AS ({PER_USER})
SELECT * FROM p FULL JOIN main USING (account_id) FULL JOIN play USING (account_id)""")
def profile_merge(t):
    spend = t.purchases.groupBy("account_id").agg(F.sum("paid_use").alias("paid_use"), F.sum(total_use()).alias("total_use"))
    return segment.merge_profiles(spend, segment.main_category(t.sales, "event_type"), _play(t))


SEG = f"""
, camp AS (SELECT * FROM sales WHERE event_name IN ('{PASS}', '{PRODUCT}', '{LEVEL}')),
seg AS (SELECT account_id, count(*) AS purchases, bool_or(event_name = '{PASS}') AS has_pass, bool_or(event_name = '{PRODUCT}') AS has_product,
  CAST(sum(CASE WHEN event_name = '{LEVEL}' THEN qty WHEN event_name = '{PASS}' AND sub_category = 'big' THEN 30 END) AS BIGINT) AS level_ups,
  CAST(sum(CASE WHEN event_name = '{LEVEL}' THEN paid_use + free_use END) AS BIGINT) AS level_up_use,
  CAST(sum(CASE WHEN event_name = '{PRODUCT}' THEN paid_use + free_use END) AS BIGINT) AS product_use,
  CAST(sum(CASE WHEN event_name = '{PASS}' THEN paid_use + free_use END) AS BIGINT) AS pass_use,
  CAST(sum(paid_use) AS BIGINT) AS paid_use, CAST(sum(paid_use + free_use) AS BIGINT) AS total_use FROM camp GROUP BY 1),
segs AS (SELECT *, CASE WHEN NOT has_pass THEN 'M-2' WHEN purchases = 1 THEN 'P-1' WHEN has_product THEN 'P-3' ELSE 'P-2' END AS segment FROM seg)
"""


def _segments(t):
    brand = F.col("event_name")
    is_pass, is_product, is_level = brand == PASS, brand == PRODUCT, brand == LEVEL
    measures = segment.typed_measures(is_pass, is_product, is_level, is_pass & (F.col("sub_category") == "big"))
    campaign = t.sales.where(brand.isin(PASS, PRODUCT, LEVEL))
    return segment.exclusive_segments(campaign, is_pass, is_product, measures=measures), campaign


@query("exclusive_segments", SEG + "SELECT * FROM segs")
def exclusive_segments(t):
    return _segments(t)[0]


@query("exclusive_segment_totals", SEG + """
SELECT segment, count(*) AS users, CAST(sum(total_use) AS BIGINT) AS total_use, CAST(sum(level_ups) AS BIGINT) AS level_ups FROM segs GROUP BY 1""")
def exclusive_segment_totals(t):
    return _segments(t)[0].groupBy("segment").agg(F.count("account_id").alias("users"), F.sum("total_use").alias("total_use"),
                                                  F.sum("level_ups").alias("level_ups"))


@query("segment_partition_check", SEG + """
SELECT CAST(count(*) AS BIGINT) AS rows, count(DISTINCT account_id) AS users, (SELECT count(*) FROM (SELECT account_id FROM segs GROUP BY 1 HAVING count(DISTINCT segment) > 1)) AS in_two,
  (SELECT count(DISTINCT account_id) FROM camp WHERE account_id NOT IN (SELECT account_id FROM segs)) AS left_out FROM segs""")
def segment_partition_check(t):
    parts, campaign = _segments(t)
    return segment.partition_check(parts, campaign)


FREE = SEG + """
, free AS (SELECT account_id, 'free_pass' AS history FROM pass_status WHERE status = 'active' GROUP BY 1
  UNION ALL SELECT account_id, 'event_crate' FROM workshop_log WHERE action = 'open' AND item_id = 'part.7' GROUP BY 1),
m1 AS (SELECT *, 'M-1' AS segment FROM free WHERE account_id NOT IN (SELECT account_id FROM segs WHERE has_pass)
  AND account_id NOT IN (SELECT account_id FROM segs WHERE NOT has_pass))
"""


def _free(t, segs=None):
    segs = _segments(t)[0] if segs is None else segs
    return segment.free_segment(
        {"free_pass": t.pass_status.where("status = 'active'"),
         "event_crate": t.workshop_log.where("action = 'open' AND item_id = 'part.7'")},
        segs.where("has_pass"), segs.where("NOT has_pass"))


@query("free_segment", FREE + "SELECT * FROM m1")
def free_segment(t):
    return _free(t)


GROUPS = OWNED + """
, grp AS (SELECT account_id, CASE WHEN count(*) > 1 THEN 'TM' ELSE CASE min(model) WHEN 'black' THEN 'SB' WHEN 'white' THEN 'SW' ELSE 'EY' END END AS owner_group,
  min(own_date) AS first_own_date FROM owned GROUP BY 1)
"""


@query("owner_groups", GROUPS + "SELECT * FROM grp")
def owner_groups(t):
    return segment.owner_groups(owned(t), SHORT)


@query("owner_models", OWNED + "SELECT * FROM owned")
def owner_models(t):
    return owned(t)


@query("combined_profiles", FREE + GROUPS + MAIN + """
, stacked AS (SELECT account_id, segment, total_use, level_ups FROM segs
  UNION ALL SELECT DISTINCT account_id, segment, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM m1),
levels AS (SELECT account_id, max(level) AS max_level FROM pass_status GROUP BY 1)
SELECT account_id, segment, total_use, level_ups, coalesce(owner_group, 'N') AS owner_group, first_own_date, max_level,
  main_category AS pre_main_category, amount AS pre_amount
FROM stacked FULL JOIN grp USING (account_id) LEFT JOIN levels USING (account_id) LEFT JOIN main USING (account_id)""")
def combined_profiles(t):
    levels = t.pass_status.groupBy("account_id").agg(F.max("level").alias("max_level"))
    segs = t.stage("segments", lambda: _segments(t)[0].select("account_id", "segment", "total_use", "level_ups", "has_pass"))
    return segment.combine_profiles(
        [segs.drop("has_pass"), _free(t, segs).select("account_id", "segment").distinct()],
        segment.owner_groups(owned(t), SHORT), [levels], segment.main_category(t.sales, "event_type"))


@query("opens_by_type", """
SELECT account_id, CAST(sum(CASE WHEN item_id = 'imprint.0' THEN open_amount END) AS BIGINT) AS loot,
  CAST(sum(CASE WHEN item_id = 'voucher.4' THEN open_amount END) AS BIGINT) AS prime,
  CAST(sum(CASE WHEN item_id = 'part.7' THEN open_amount END) AS BIGINT) AS event
FROM workshop_log WHERE action = 'open' AND item_id IN ('imprint.0', 'voucher.4', 'part.7') GROUP BY 1""")
def opens_by_type(t):
    return segment.opens_by_type(t.workshop_log.where("action = 'open'"), CRATES)


@query("gains_without_tests", """
SELECT account_id, CAST(sum(amount) AS BIGINT) AS gained FROM currency_log
WHERE reason_detail NOT IN ('tier1', 'tier3') AND amount > 0 GROUP BY 1""")
def gains_without_tests(t):
    return segment.gains(t.currency_log, ["tier1", "tier3"])


@query("segment_takeup", SEG + """
, s AS (SELECT account_id, coalesce(segment, 'none') AS segment, membership FROM users LEFT JOIN segs USING (account_id)),
k AS (SELECT DISTINCT account_id FROM workshop_log WHERE action = 'craft')
SELECT segment, membership, count(*) AS users, count(k.account_id) AS takers, CAST(count(k.account_id) AS DOUBLE) / count(*) AS takeup
FROM s LEFT JOIN k USING (account_id) GROUP BY 1, 2""")
def segment_takeup(t):
    return segment.segment_takeup(_user_segments(t), t.workshop_log.where("action = 'craft'"), ["segment", "membership"])


def _user_segments(t):
    segs = t.users.select("account_id", "membership").join(_segments(t)[0].select("account_id", "segment"), "account_id", "left")
    return segs.withColumn("segment", F.coalesce("segment", F.lit("none")))


RANK = SEG + """
, s AS (SELECT account_id, coalesce(segment, 'none') AS segment, membership FROM users LEFT JOIN segs USING (account_id)),
c AS (SELECT {0}, item_id, count(*) AS takes, count(DISTINCT account_id) AS users FROM s JOIN workshop_log USING (account_id) WHERE action = 'craft' GROUP BY {0}, item_id)
SELECT *, CAST(row_number() OVER (PARTITION BY {0} ORDER BY takes DESC, item_id) AS INTEGER) AS rank FROM c"""


@query("craft_rank_in_segment", RANK.format("segment, membership"))
def craft_rank_in_segment(t):
    return segment.rank_in_segment(_user_segments(t), t.workshop_log.where("action = 'craft'"), ["segment", "membership"])


@query("craft_rank_in_segment_only", RANK.format("segment"))
def craft_rank_in_segment_only(t):
    return segment.rank_in_segment(_user_segments(t), t.workshop_log.where("action = 'craft'"), ["segment"])


@query("override_both_models", OWNED + """
, two AS (SELECT * FROM owned WHERE model IN ('white', 'yellow')), n AS (SELECT account_id, count(*) AS held FROM two GROUP BY 1)
SELECT account_id, own_date, CASE WHEN held = 2 THEN 'both' ELSE model END AS model FROM two JOIN n USING (account_id)""")
def override_both_models(t):
    return segment.override_both(owned(t), ["white", "yellow"])


ACTIVITY = """
, a AS (
  SELECT account_id, 'pass_purchase' AS action FROM purchase_log WHERE event_name = 'season1'
  UNION SELECT account_id, CASE WHEN item_id LIKE 'imprint%' THEN 'imprint_' ELSE 'normal_' END || action FROM workshop_log WHERE action IN ('open', 'craft')
  UNION SELECT account_id, action FROM workshop_log WHERE action IN ('disassemble', 'repurpose')
  UNION SELECT account_id, CASE WHEN currency = 'token.season' THEN 'season_craft' WHEN currency = 'token.artisan' THEN 'artisan_craft' END
    FROM purchase_log WHERE currency LIKE 'token%'
  UNION SELECT account_id, CASE event_name WHEN 'Brand#1' THEN 'campaign_coin' ELSE 'shop_coin' END FROM sales)
"""


def _activity(t):
    special = F.when(F.col("item_id").startswith("imprint"), "imprint_").otherwise("normal_")
    workshop = F.when(F.col("action").isin("open", "craft"), F.concat(special, F.col("action"))).otherwise(F.col("action"))
    tokens = label_in("currency", [("season_craft", ["token.season"]), ("artisan_craft", ["token.artisan"])])
    return segment.activity_long([
        (t.purchase_log.where("event_name = 'season1'"), "pass_purchase"), (t.workshop_log, workshop), (t.purchase_log, tokens),
        (t.sales, F.when(F.col("event_name") == "Brand#1", "campaign_coin").otherwise("shop_coin"))])


@query("activity_long", ACTIVITY + "SELECT * FROM a")
def activity_long(t):
    return _activity(t)


@query("activity_by_segment", SEG + ACTIVITY + """
SELECT coalesce(segment, 'none') AS segment, action, count(*) AS users FROM a JOIN users USING (account_id) LEFT JOIN segs USING (account_id) GROUP BY 1, 2""")
def activity_by_segment(t):
    return _activity(t).join(_user_segments(t), "account_id").groupBy("segment", "action").agg(F.count("account_id").alias("users"))
