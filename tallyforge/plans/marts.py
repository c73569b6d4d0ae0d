"""The scheduled data marts, one function each.

Every mart takes the frames of one device (or of all devices at once) already limited
to its scan window, and returns a lazy frame in the mart's grain. Facts shrink to one
row per user and group before they meet the user table, so no join carries raw facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import label_below, label_like, name_or_id
from tallyforge.functions.periods import as_date, period_start
from tallyforge.operators import joins
from tallyforge.operators.levels import label_after, people_and_sums, top_n
from tallyforge.operators.quantile import exact_percentiles, percentile_tiers
from tallyforge.stages import Stages

# Fixed values the marts are defined by.
USER_DIMS = ["device", "platform", "region", "membership"]
PRODUCT_DIMS = ["sales_id", "product_id", "product_name"]
TOTAL = "total"
ACTIVE_WINDOWS = {"w-01": 6, "w-02": 13, "w-04": 27, "w-08": 55, "w-12": 83}
EXPIRY_EDGES = [(1, "0"), (7, "[1-7)"), (30, "[7-30)"), (90, "[30-90)"), (180, "[90-180)")]
EXPIRY_ABOVE = "[180-inf)"
ITEM_PREFIX = "itemdesc."
SPEND_PERCENTILES = {"p20": 0.20, "p50": 0.50, "p80": 0.80, "p95": 0.95}


def mart_users(snapshot: DataFrame, regions: DataFrame, membership: DataFrame | None, start: Column | str | None = None,
               default: str | None = None) -> DataFrame:
    """One row per live account with region and membership; ``start`` keeps users seen since then."""
    users = joins.active_users(snapshot, start, "any" if start is None else "since")
    users = joins.with_region(joins.with_country(users), regions)
    order = ["first_login", "platform"]
    if membership is not None:
        users = joins.with_membership(users, membership, default)
        order.append("membership")
    return joins.first_per_key(users, "account_id", order)


def _active(users: DataFrame, dims: Sequence[str] = tuple(USER_DIMS)) -> DataFrame:
    """Users per segment; the label for a missing membership comes after the count."""
    return label_after(people_and_sums(users, "account_id", dims, {"au": True}), "membership", "undefined")


def sales_by_membership(snapshot: DataFrame, regions: DataFrame, membership: DataFrame, coin: DataFrame,
                        cash: DataFrame, day: str, period: str = "daily", floor: str | None = None) -> DataFrame:
    """Coin and cash sales by segment and product, with a total per currency and a grand total."""
    start = period_start(day, period, floor)
    window = F.col("date").between(start, as_date(day))
    users = mart_users(snapshot, regions, membership, start)
    none = F.lit(None).cast("bigint")
    coins = coin.where(window).groupBy("account_id", *PRODUCT_DIMS).agg(
        F.sum("qty").alias("unit_sold"), F.sum("free_use").alias("free_used"), F.sum("paid_use").alias("paid_used")
    ).withColumns({"revenue": none, "currency": F.lit("coin")})
    cashed = cash.where(window).groupBy("account_id", *PRODUCT_DIMS).agg(
        F.sum("unit_sold").alias("unit_sold"), F.sum("revenue").alias("revenue")
    ).withColumns({"free_used": none, "paid_used": none, "currency": F.lit("cash")})
    measures = ["unit_sold", "free_used", "paid_used", "revenue"]
    # active users and sales from one pass: users without a sale come along, and are counted on the total rows
    by_user = coins.unionByName(cashed).withColumn("sale", F.lit(1)).join(
        users.select("account_id", *USER_DIMS).withColumn("is_user", F.lit(True)), "account_id", "full_outer")
    sold = label_after(people_and_sums(
        by_user, "account_id", [*USER_DIMS, "currency", *PRODUCT_DIMS], {"pu": "sale = 1", "au": "is_user"}, {"sales": "sale", **{m: m for m in measures}},
        levels=[[*USER_DIMS, "currency", *PRODUCT_DIMS], [*USER_DIMS, "currency"], USER_DIMS],
        labels={"currency": "coin+cash", "sales_id": "0", "product_id": TOTAL, "product_name": "0"}), "membership", "undefined")
    known = F.lit(True)
    for dim in USER_DIMS:
        known = known & F.col(dim).isNotNull()
    is_total, has_sales = F.col("currency") == "coin+cash", F.coalesce(F.col("sales") > 0, F.lit(False))
    active = F.nullif(F.max(F.when(is_total, F.col("au"))).over(Window.partitionBy(*USER_DIMS)), F.lit(0))
    # a segment with an unknown dimension keeps sales and active users apart
    kinds = F.array_compact(F.array(F.when(has_sales, "sales"), F.when(is_total & (F.col("au") > 0) & ~(has_sales & known), "users")))
    rows = sold.withColumn("known", known).withColumn("active", active).withColumn("kind", F.explode(kinds))
    of_sales = F.col("kind") == "sales"
    return rows.select(
        *USER_DIMS, *[F.when(of_sales, F.col(c)).alias(c) for c in ("currency", *PRODUCT_DIMS, "pu", *measures)],
        F.when(~of_sales | F.col("known"), F.col("active")).alias("au"), as_date(day).alias("date"))


def paid_by_product(snapshot: DataFrame, regions: DataFrame, membership: DataFrame, coin: DataFrame,
                    day: str, period: str = "daily", floor: str | None = None) -> DataFrame:
    """Paid coins by segment and product, with a total per segment.

    The default membership reaches totals and active users only, so product rows of
    users without one are incomplete and dropped with all other incomplete keys.
    """
    start = period_start(day, period, floor)
    users = mart_users(snapshot, regions, membership, start)
    paid = coin.where(F.col("date").between(start, as_date(day)) & (F.col("paid_use") > 0))
    by_user = paid.groupBy("account_id", *PRODUCT_DIMS).agg(
        F.sum("qty").alias("unit_sold"), F.sum("free_use").alias("free_used"), F.sum("paid_use").alias("paid_used"))
    sold = people_and_sums(
        by_user.join(users.select("account_id", *USER_DIMS), "account_id", "left"), "account_id",
        [*USER_DIMS, *PRODUCT_DIMS], {"pu": True}, {m: m for m in ("unit_sold", "free_used", "paid_used")},
        levels=[[*USER_DIMS, *PRODUCT_DIMS], USER_DIMS],
        labels={"sales_id": "0", "product_id": TOTAL, "product_name": "0"})
    sold = sold.withColumn("membership", F.when(F.col("product_id") == TOTAL, F.coalesce("membership", F.lit("undefined")))
                           .otherwise(F.col("membership")))
    out = sold.join(_active(users), USER_DIMS, "full_outer").withColumns(
        {"sales_id": F.coalesce("sales_id", F.lit("0")), "product_id": F.coalesce("product_id", F.lit("0"))})
    stamp = {"date": as_date(day)} if period == "daily" else {"start_date": start, "end_date": as_date(day)}
    return out.withColumns(stamp).na.drop(subset=[*USER_DIMS, "sales_id", "product_id"])


def event_sales(snapshot: DataFrame, regions: DataFrame, membership: DataFrame, coin: DataFrame, day: str) -> DataFrame:
    """Coins by segment and event."""
    event = ["sub_category", "event_type", "event_name"]
    users = mart_users(snapshot, regions, membership, default="undefined")
    by_user = coin.where(F.col("date") == as_date(day)).groupBy("account_id", *event).agg(
        F.sum("free_use").alias("free_used"), F.sum("paid_use").alias("paid_used"))
    joined = by_user.join(users.select("account_id", *USER_DIMS), "account_id", "left")
    return people_and_sums(joined, "account_id", [*USER_DIMS, *event], {"pu": True},
                           {"free_used": "free_used", "paid_used": "paid_used"}).withColumn("date", as_date(day))


def balance_by_expiry(snapshot: DataFrame, regions: DataFrame, membership: DataFrame, ledger: DataFrame,
                      measures: Sequence[str], windows: Mapping[str, int] = ACTIVE_WINDOWS,
                      device: str = "all") -> DataFrame:
    """Balances by days to expiry and by how lately the user was seen, from one pass over the ledger.

    The nested ledger is flattened and shrunk to one row per user and expiry bucket; only
    then is that row repeated for each activity window that covers the user. Windows leave
    out users of unknown region, ``all`` keeps them as ``Undefined``.
    """
    users = mart_users(snapshot, regions, membership, default="undefined").select(
        "account_id", F.upper("device").alias("device"), "region", "membership", "days_since")
    entries = ledger.selectExpr("date", "account_id", "platform", "inline(by_expiry)")
    left = F.datediff("expiry_date", "date") - 1
    keys = ["date", "account_id", "platform", "days_to_expiry"]
    per_user = (entries.withColumn("left", left).where("left >= 0")
                .withColumn("days_to_expiry", label_below("left", EXPIRY_EDGES, EXPIRY_ABOVE))
                .groupBy(*keys).agg(
                    F.max((F.col("daily_free_topup") != 0) | (F.col("daily_paid_topup") != 0)).alias("topped_up"),
                    F.max((F.col("daily_free_use") != 0) | (F.col("daily_paid_use") != 0)).alias("used"),
                    *[F.sum(m).alias(m) for m in measures]))
    covering = F.array(F.lit("all"), *[
        F.when((F.col("days_since") <= days) & F.col("region").isNotNull(), F.lit(name)) for name, days in windows.items()])
    wide = (per_user.join(users, "account_id", "left")
            .withColumn("active_window", F.explode(F.array_compact(covering)))
            .withColumns({"device": F.coalesce("device", F.lit(device.upper())),
                          "region": F.coalesce("region", F.lit("Undefined"))}))
    group = ["date", "device", "platform", "region", "membership", "active_window", "days_to_expiry"]
    # one row per user in each group by now, so plain counts are user counts
    return wide.groupBy(*group).agg(
        F.count("account_id").alias("users"), *[F.sum(m).alias(m) for m in measures],
        F.count_if("topped_up").alias("topup_users"), F.count_if("used").alias("use_users"))


def coupon_balance(snapshot: DataFrame, regions: DataFrame, membership: DataFrame, log: DataFrame, currency: str,
                   day: str | None = None) -> DataFrame:
    """Amount of one currency by segment, reason and detail; with ``day`` of that day, which is a column then."""
    users = mart_users(snapshot, regions, membership, default="undefined")
    log = log if day is None else log.where(F.col("date") == as_date(day))
    per_user = log.where(F.col("currency") == currency).groupBy("account_id", "reason", "reason_detail").agg(
        F.sum("amount").alias("balance"))
    out = (per_user.join(users.select("account_id", *USER_DIMS), "account_id", "left")
           .groupBy(*USER_DIMS, "reason", "reason_detail").agg(F.sum("balance").alias("balance")))
    return out if day is None else out.withColumn("date", as_date(day))


def campaign_kpi(snapshot: DataFrame, coin: DataFrame, ledger: DataFrame, calendar: DataFrame, day: str,
                 event: str = "name", device: str | None = None, more: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """One row for the campaign live on ``day``: cumulative users, buyers, payers and coins, new buyers of the day.

    ``event`` is the calendar's column with the text that event names of the campaign contain; ``device`` and ``more``
    are those of ``joins.live_campaign``.

    The campaign's name and start reach the scans as scalar subqueries; no live campaign gives no row.
    """
    live = joins.live_campaign(calendar, day, device=device, more=more)
    name, start = live.select(event).scalar(), live.select("start_date").scalar()
    of_campaign = coin.where(F.col("event_name").contains(name))
    au = snapshot.where((F.col("server_type") == "LIVE") & (F.col("last_login") >= start)).select(
        F.count_distinct("account_id").alias("au"))
    sold = people_and_sums(
        of_campaign.where((F.col("date") >= start) & (F.col("date") <= as_date(day))), "account_id", [],
        {"pu": True, "paid_pu": "paid_use > 0"}, {"free_use": "free_use", "paid_use": "paid_use"}
    ).select(F.struct("pu", "paid_pu", "free_use", "paid_use").alias("s")).scalar()
    new = (ledger.where(F.col("first_use_date") == as_date(day))
           .join(of_campaign.where(F.col("date") == as_date(day)), "account_id", "left_semi")
           .select(F.count_distinct("account_id").alias("npu")))
    return live.select(
        as_date(day).alias("date"), "name", au.scalar().alias("cum_au"), sold.alias("s"), new.scalar().alias("daily_npu")
    ).select("date", "name", "cum_au", F.col("s.pu").alias("cum_pu"), F.col("s.paid_pu").alias("cum_paid_pu"),
             F.col("s.free_use").alias("cum_free_use"), F.col("s.paid_use").alias("cum_paid_use"), "daily_npu")


def point_sales(log: DataFrame, items: DataFrame, calendar: DataFrame, day: str, currency: str, of_day: bool = False,
                device: str | None = None, more: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Units and points by event and product while a campaign is live; empty, with its schema, otherwise.

    With ``of_day`` only the day's purchases count, the day is a column, and names come from the currency's items only.
    """
    live = joins.live_campaign(calendar, day, device=device, more=more)
    is_live = F.coalesce(live.select(F.lit(True).alias("live")).scalar(), F.lit(False))
    if of_day:
        log, items = log.where(F.col("date") == as_date(day)), items.where(F.col("currency") == currency)
    sold = log.where((F.col("currency") == currency) & is_live).groupBy("event_name", "product_id").agg(
        F.sum("amount").alias("unit_sold"), F.sum(F.col("local_price") * F.col("amount")).alias("points_used"))
    names = items.select("product_id", name_or_id("product_name", "product_id").alias("product_name")).distinct()
    out = sold.join(names, "product_id", "left")
    return out.withColumn("date", as_date(day)) if of_day else out


def currency_flow(log: DataFrame) -> DataFrame:
    return (log.fillna("", subset=["reason_detail"]).groupBy("date", "currency", "reason", "reason_detail")
            .agg(F.sum("amount").alias("amount")))


def crafts(log: DataFrame) -> DataFrame:
    return people_and_sums(log.where("action = 'craft'"), "account_id", ["date", "item_id"], {"users": True}, rows="crafts")


def items_gained(log: DataFrame, action: str) -> DataFrame:
    """Crates or consumables gained, by item and reason."""
    return log.where(F.col("action") == action).groupBy("date", "item_id", "reason").agg(F.sum("amount").alias("amount"))


def token_purchases(log: DataFrame, pattern: str = "%token%") -> DataFrame:
    """Amount and buyers per token and product, with a total per token."""
    return people_and_sums(
        log.where(F.col("currency").like(pattern)), "account_id", ["date", "currency", "product_id"],
        {"users": True}, {"amount": "amount"},
        levels=[["date", "currency", "product_id"], ["date", "currency"]], labels={"product_id": TOTAL})


def workshop_actions(log: DataFrame, classes: Sequence[tuple[str, str]]) -> DataFrame:
    """Counts and users per action: crates by item, crafts by item class, all with a total.

    One scan: every row counts under its own item (where its action has items, null being one) and under the total.
    """
    item = F.when(F.col("action") == "open", F.col("item_id")).when(
        F.col("action") == "craft", label_like("item_id", classes, "else"))
    amount = F.when(F.col("action") == "open", F.col("open_amount")).otherwise(F.lit(1).cast("bigint"))
    rows = log.select("date", "action", "account_id", amount.alias("amount"), item.alias("item"))
    out = people_and_sums(rows, "account_id", ["date", "action", "item"], {"users": True}, {"count": "amount"},
                          levels=[["date", "action", "item"], ["date", "action"]], labels={"item": TOTAL})
    return out.where((F.col("item") == TOTAL) | F.col("action").isin("open", "craft"))


def overview(snapshot: DataFrame, regions: DataFrame, coin: DataFrame, first_use: DataFrame, day: str, period: str,
             event_types: str, type_rule: Column, regular: str, floor: str | None = None) -> DataFrame:
    """Payers, buyers, new buyers and coins by product type and event, with ``total`` and ``regular`` rows.

    Device and platform are those of the purchase, the region is the user's.
    """
    users = mart_users(snapshot, regions, None)
    window = F.col("date").between(period_start(day, period, floor), as_date(day))
    facts = coin.where(window & F.col("event_type").like(event_types)).withColumn("product_type", type_rule)
    per_user = facts.groupBy("account_id", "date", "device", "platform", "product_type", "event_name", "event_type").agg(
        F.max(F.col("paid_use") > 0).alias("paid"), F.sum("free_use").alias("free_used"), F.sum("paid_use").alias("paid_used"))
    flagged = joins.flag_new_buyer(per_user, first_use)
    joined = flagged.join(users.select("account_id", "region"), "account_id", "left")
    kinds = F.array_compact(F.array(
        F.struct(F.col("product_type").alias("t"), F.col("event_name").alias("e")),
        F.struct(F.lit(TOTAL).alias("t"), F.lit(TOTAL).alias("e")),
        F.when(F.col("event_type") == regular, F.struct(F.lit("regular").alias("t"), F.lit("regular").alias("e")))))
    labelled = joined.withColumn("kind", F.explode(kinds)).withColumns(
        {"product_type": F.col("kind.t"), "event_name": F.col("kind.e")})
    return people_and_sums(
        labelled, "account_id", ["device", "platform", "region", "product_type", "event_name"],
        {"paid_pu": "paid", "total_pu": True, "npu": "is_new"}, {"free_used": "free_used", "paid_used": "paid_used"}
    ).withColumn("date", as_date(day))


def spend_per_user(cash: DataFrame) -> DataFrame:
    return cash.groupBy("account_id").agg(F.sum("revenue").alias("spend"))


def spender_users(snapshot: DataFrame, regions: DataFrame, spend: DataFrame, start: str, cuts: DataFrame | None = None) -> DataFrame:
    """Active users with region and spender tier; users without ``spend`` (account_id, spend) form a tier of their own."""
    tiers = percentile_tiers(spend, "spend", SPEND_PERCENTILES, cuts, "tier")
    users = joins.with_region(joins.with_country(
        snapshot.where((F.col("server_type") == "LIVE") & (F.col("last_login") >= as_date(start)))), regions)
    return (users.select("account_id", "region").join(tiers.select("account_id", "tier"), "account_id", "left")
            .withColumn("tier", F.coalesce("tier", F.lit("non_pu"))).distinct())


def equipped_items(inventory: DataFrame, parts: DataFrame, names: DataFrame, users: DataFrame, start: str) -> DataFrame:
    """Items worn by users whose inventory changed since ``start``: one row per user, part and item, with a count."""
    worn = (inventory.where(F.col("date_updated") >= as_date(start))
            .selectExpr("account_id", "inline(equips)")
            .groupBy("account_id", "part", "itemid").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("part_id", F.concat(F.lit("desc."), F.col("part"))))
    described = worn.join(parts, "part_id").join(names.select("part_id", "name"), "part_id", "left")
    return described.join(users, "account_id").withColumn("region", F.coalesce("region", F.lit("Undefined")))


def item_users(equipped: DataFrame, cuts: DataFrame) -> DataFrame:
    """Users by region, tier, category and part, with two total levels and the tier limits on each row."""
    levels = [["region", "tier", "category", "part"], ["region", "tier", "category"], ["region", "tier"]]
    out = people_and_sums(equipped, "account_id", levels[0], {"users": True}, levels=levels,
                          labels={"category": TOTAL, "part": TOTAL})
    limits = cuts.select(F.struct(*SPEND_PERCENTILES)).scalar()
    return out.withColumn("__limits", limits).select("*", "__limits.*").drop("__limits")


def top_items(equipped: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` most equipped items per region, tier and category (ties by part and item)."""
    counted = equipped.groupBy("region", "tier", "category", "sub_category", "part", "name", "itemid").agg(
        F.sum("rows").alias("equip_count"))
    return top_n(counted, ["region", "tier", "category"],
                 [F.desc("equip_count"), F.asc("part"), F.asc("itemid")], n, "row_number").drop("row_number")


def top_items_report(equipped: DataFrame, start: str, end: str, device: str, n: int = 50) -> DataFrame:
    """The same with the report's period and device, and the item's full id."""
    return top_items(equipped, n).withColumns({
        "start_date": as_date(start), "end_date": as_date(end), "device": F.lit(device),
        "item_id": F.concat(F.lit(ITEM_PREFIX), F.col("itemid"))})


class InventoryReports:
    """All results of the weekly inventory: users by tier, users by part, most equipped items.

    The spend per user and the equipped items are stages: each is computed once, by the first result that needs it, and
    read from the shared folder by all of them. The percentiles are found once on the stage.
    """

    def __init__(self, snapshot: DataFrame, regions: DataFrame, cash: DataFrame, inventory: DataFrame, parts: DataFrame, names: DataFrame, start: str):
        self.snapshot, self.regions, self.cash, self.start = snapshot, regions, cash, start
        self.inventory, self.parts, self.names = inventory, parts, names
        self.stages = Stages()

    @cached_property
    def spend(self) -> DataFrame:
        return self.stages.once("spend", lambda: spend_per_user(self.cash))

    @cached_property
    def cuts(self) -> DataFrame:
        return exact_percentiles(self.spend, "spend", SPEND_PERCENTILES, stage=False)

    def users(self) -> DataFrame:
        return spender_users(self.snapshot, self.regions, self.spend, self.start, self.cuts)

    @cached_property
    def equipped(self) -> DataFrame:
        return self.stages.once("equipped", lambda: equipped_items(self.inventory, self.parts, self.names, self.users(), self.start))

    def item_users(self) -> DataFrame:
        return item_users(self.equipped, self.cuts)

    def top_items(self, n: int = 50) -> DataFrame:
        return top_items(self.equipped, n)

    def top_items_report(self, end: str, device: str, n: int = 50) -> DataFrame:
        return top_items_report(self.equipped, self.start, end, device, n)
