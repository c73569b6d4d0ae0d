"""Key figures: active users, buyers, payers, revenue and their ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import label_in, label_like, ratio, sign, total_use
from tallyforge.functions.periods import as_date, week_bucket
from tallyforge.operators.levels import people_and_sums, rank_all, top_n
from tallyforge.operators.skew import split_join


def _people() -> dict[str, Column | bool | str]:
    return {"pu": True, "paid_pu": "paid_use > 0"}


def _coins() -> dict[str, Column | str]:
    return {"paid_use": "paid_use", "total_use": total_use()}


def with_ratios(df: DataFrame, revenue: str = "total_use") -> DataFrame:
    """Purchase rate, rate of payers, revenue per active user and per buyer; a zero base gives null."""
    return df.withColumns({"pur": ratio("pu", "au"), "paid_pur": ratio("paid_pu", "au"), "arpu": ratio(revenue, "au"), "arppu": ratio(revenue, "pu")})


def active_by(users: DataFrame, dims: Sequence[str], key: str = "account_id", attrs: DataFrame | None = None) -> DataFrame:
    return people_and_sums(users, key, dims, {"au": True}, attrs=attrs, how="inner")


def sales_by(purchases: DataFrame, dims: Sequence[str], key: str = "account_id") -> DataFrame:
    return people_and_sums(purchases, key, dims, _people(), _coins())


def daily_kpi(users: DataFrame, purchases: DataFrame, day: str = "date") -> DataFrame:
    """AU, buyers, payers, coins and ratios per day; days without a sale keep null sales."""
    return with_ratios(active_by(users, [day]).join(sales_by(purchases, [day]), day, "left"))


def kpi_by(users: DataFrame, purchases: DataFrame, dims: Sequence[str], key: str = "account_id") -> DataFrame:
    """The same per user segment. Purchases shrink to one row per user before they meet the users."""
    per_user = purchases.groupBy(key).agg(
        F.max(F.col("paid_use") > 0).alias("paid"), F.sum("paid_use").alias("paid_use"),
        F.sum(total_use()).alias("total_use"))
    attrs = users.select(key, *dims).distinct()
    sold = per_user.join(attrs, key, "left").groupBy(*dims).agg(
        F.count(key).alias("pu"), F.count(F.when(F.col("paid"), F.col(key))).alias("paid_pu"),
        F.sum("paid_use").alias("paid_use"), F.sum("total_use").alias("total_use"))
    joined = active_by(users, dims).join(sold, list(dims), "left")
    return with_ratios(joined.fillna(0, subset=["pu", "paid_pu", "paid_use", "total_use"]))


def product_rank(purchases: DataFrame, product: str = "product_name", key: str = "account_id") -> DataFrame:
    """Mean price, units, buyers, revenue and revenue per buyer, by product, best sellers first."""
    out = people_and_sums(purchases, key, [product], {"pu": True}, {"units": "qty", "revenue": "price"}, rows="lines")
    return (out.withColumns({"mean_price": ratio("revenue", "lines"), "arppu": ratio("revenue", "pu")})
            .drop("lines").orderBy(F.desc("revenue"), product))


def rank_in_day(purchases: DataFrame, products: DataFrame, n: int | None = None) -> DataFrame:
    """Products ranked by units within each day (ties by product id), with their names.

    With ``n`` each task sends a day's first ``n`` only. Without it a day's products are ranked over several tasks.
    """
    units = purchases.groupBy("date", "product_id").agg(F.sum("qty").alias("units"))
    order = [F.desc("units"), F.asc("product_id")]
    ranked = rank_all(units, ["date"], order) if n is None else top_n(units, ["date"], order, n)
    return ranked.join(products.select("product_id", "product_name", "event_name").distinct(), "product_id")


def product_kpi(purchases: DataFrame, dims: Sequence[str], txn: str = "transaction_id") -> DataFrame:
    """Distinct transactions, units and coins per product, optionally by more dimensions."""
    return people_and_sums(purchases, txn, dims, {"transactions": True},
                           {"units": "qty", "paid_use": "paid_use", "total_use": total_use()})


def pre_post(users: DataFrame, purchases: DataFrame, launch: str, days: int = 7) -> DataFrame:
    """Daily figures for ``days`` days before and from a launch, labelled ``pre`` and ``post``."""
    first, last = F.date_sub(as_date(launch), days), F.date_add(as_date(launch), days - 1)
    window = F.col("date").between(first, last)
    out = daily_kpi(users.where(window), purchases.where(window))
    return out.withColumn("period", F.when(F.col("date") < as_date(launch), "pre").otherwise("post"))


def ctr(clicks: DataFrame, items: DataFrame, by: Sequence[str], detail: str = "detail", buy: str = "buy") -> DataFrame:
    """Buy clicks over detail clicks per day and item, for items with both kinds of click."""
    counted = (clicks.groupBy("date", "item_id")
               .agg(F.count(F.when(F.col("action") == detail, 1)).alias("detail_clicks"),
                    F.count(F.when(F.col("action") == buy, 1)).alias("buy_clicks"))
               .where("detail_clicks > 0 AND buy_clicks > 0"))
    named = counted.join(items, "item_id")
    return named.select("date", *by, "detail_clicks", "buy_clicks", ratio("buy_clicks", "detail_clicks").alias("ctr"))


def mean_ctr(per_item: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean of the item figures."""
    return per_item.groupBy(*by).agg(
        F.avg("ctr").alias("ctr"), ratio(F.sum("buy_clicks"), F.count(F.lit(1))).alias("buy_clicks"),
        ratio(F.sum("detail_clicks"), F.count(F.lit(1))).alias("detail_clicks"))


def group_kpi(purchases: DataFrame, groups: Sequence[tuple[str, Sequence[str]]], by: Sequence[str],
              column: str = "product_id", default: str = "others") -> DataFrame:
    """Buyers, units and coins by product group."""
    labelled = purchases.withColumn("product_group", label_in(column, groups, default))
    return people_and_sums(labelled, "account_id", [*by, "product_group"], _people(), {"units": "qty", **_coins()})


def first_purchase(purchases: DataFrame, key: str = "account_id") -> DataFrame:
    """First day, first time and number of distinct products per user."""
    per_product = purchases.groupBy(key, "product_id").agg(F.min("date").alias("d"), F.min("time").alias("t"))
    return per_product.groupBy(key).agg(F.min("d").alias("first_date"), F.min("t").alias("first_time"),
                                        F.count("product_id").alias("products"))


def users_by(df: DataFrame, dims: Sequence[str], key: str = "account_id", name: str = "users") -> DataFrame:
    return people_and_sums(df, key, dims, {name: True})


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str], measure: Column) -> DataFrame:
    """One column per listed value; the list is given, so no extra job looks for values."""
    return df.groupBy(row).pivot(col, list(values)).agg(measure)


def sign_split(df: DataFrame, amount: str, by: Sequence[str], key: str = "account_id", attrs: DataFrame | None = None) -> DataFrame:
    """Amount and users on the gain and the spend side; a zero amount is on the spend side."""
    return people_and_sums(df.withColumn("side", sign(amount)), key, [*by, "side"], {"users": True}, {"amount": amount}, attrs=attrs)


def sign_mean(df: DataFrame, amount: str, key: str = "account_id") -> DataFrame:
    """Mean over users of each user's amount, per side."""
    per_user = df.groupBy(sign(amount).alias("side"), key).agg(F.sum(amount).alias("amount"))
    return per_user.groupBy("side").agg(ratio(F.sum("amount"), F.count("amount")).alias("mean_amount"))


def weekly_sales(purchases: DataFrame, anchor: str) -> DataFrame:
    """Coins per seven-day bucket counted from an anchor day; earlier days fall in earlier buckets."""
    return purchases.groupBy(week_bucket("date", anchor).alias("week_start")).agg(
        F.sum("paid_use").alias("paid_use"), F.sum(total_use()).alias("total_use"))


def weekly_actives(users: DataFrame, anchor: str, key: str = "account_id") -> DataFrame:
    return people_and_sums(users.withColumn("week_start", week_bucket("date", anchor)), key, ["week_start"], {"wau": True})


def max_level_hist(levels: DataFrame, by: Sequence[str], key: str = "account_id", level: str = "level") -> DataFrame:
    """Users per highest level reached."""
    top = levels.groupBy(*by, key).agg(F.max(level).alias("max_level"))
    return top.groupBy(*by, "max_level").agg(F.count(key).alias("users"))


def pass_rates(status: DataFrame, by: Sequence[str], key: str = "account_id", attrs: DataFrame | None = None) -> DataFrame:
    """Share of active users that hold the pass."""
    present = status.where(F.col("status").isin("active", "pass"))
    return (people_and_sums(present, key, by, {"users": True, "pass_users": "status = 'pass'"}, attrs=attrs)
            .withColumn("pass_rate", ratio("pass_users", "users")))


def pass_levels(status: DataFrame, by: Sequence[str], key: str = "account_id", attrs: DataFrame | None = None) -> DataFrame:
    """Pass users per level and their share of all pass users of the group."""
    holders = status.where("status = 'pass'")
    total = people_and_sums(holders, key, by, {"pass_users": True}, attrs=attrs, how="inner")
    per_level = people_and_sums(holders, key, [*by, "level"], {"users": True}, attrs=attrs, how="inner")
    return per_level.join(total, list(by)).withColumn("level_rate", ratio("users", "pass_users"))


def levelup_by_day(status: DataFrame, key: str = "account_id") -> DataFrame:
    """Experience, pass users and level-ups per day; a day without a level-up has a null count, not 0."""
    out = people_and_sums(status.where("status = 'pass'"), key, ["date"], {"users": True},
                          {"levelup_xp": "levelup_xp", "levelups": F.when(F.col("levelup_xp") > 0, 1).cast("bigint")})
    return out.withColumn("levelup_rate", F.round(ratio("levelups", "users"), 3))


def status_by_day(status: DataFrame) -> DataFrame:
    return status.where(F.col("status").isin("active", "pass")).groupBy("date").agg(
        F.sum(F.when(F.col("status") == "active", 1)).alias("active_rows"),
        F.sum(F.when(F.col("status") == "pass", 1)).alias("pass_rows"))


def two_stage_kpi(users: DataFrame, purchases: DataFrame, fine: Sequence[str], grain: Sequence[str], attrs: DataFrame | None = None) -> DataFrame:
    """AU counted at the fine grain and *summed* to ``grain``; buyers counted at ``grain`` itself.

    A user seen in two fine groups counts twice in AU. That is the definition, not an oversight.
    """
    au = active_by(users, fine, attrs=attrs).groupBy(*grain).agg(F.sum("au").alias("au"))
    pu = people_and_sums(purchases, "account_id", grain, {"pu": True})
    return au.join(pu, list(grain)).withColumn("pur", ratio("pu", "au"))


def campaign_totals(purchases: DataFrame, by: Sequence[str] = (), attrs: DataFrame | None = None) -> DataFrame:
    """Payers, buyers, paid and total coins of a campaign."""
    return people_and_sums(purchases, "account_id", by, _people(), _coins(), attrs=attrs, how="inner")


def arppu_by(purchases: DataFrame, dim: str, attrs: DataFrame | None = None) -> DataFrame:
    """Total coins per buyer and paid coins per payer."""
    return campaign_totals(purchases, [dim], attrs).withColumns(
        {"arppu": ratio("total_use", "pu"), "paid_arppu": ratio("paid_use", "paid_pu")})


def value_list(df: DataFrame, cols: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*order)


def coupon_flow(log: DataFrame, by: Sequence[str], prefix: str, used_reason: str, key: str = "account_id", attrs: DataFrame | None = None) -> DataFrame:
    """Coupons gained and used, with the users on each side."""
    coupons = log.where(F.col("currency").startswith(prefix))
    gained, used = F.col("amount") > 0, F.col("reason") == used_reason
    return people_and_sums(
        coupons, key, by, {"owners": gained, "spenders": used},
        {"gained": F.when(gained, F.col("amount")), "used": F.when(used, F.col("amount"))}, attrs=attrs)


def coupon_totals(log: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Amount gained by coupon kind; currencies no rule names come under a null kind."""
    kind = label_like("currency", rules)
    return log.where(F.col("amount") > 0).groupBy(kind.alias("kind")).agg(F.sum("amount").alias("amount"))


def vote_kpi(votes: DataFrame, by: Sequence[str], key: str = "account_id", attrs: DataFrame | None = None) -> DataFrame:
    return people_and_sums(votes, key, by, {"voters": True}, rows="votes", attrs=attrs, how="inner")


def same_day_join(facts: DataFrame, snapshots: DataFrame, attrs: Sequence[str], key: str = "account_id") -> DataFrame:
    """Facts with the user's attributes as of the fact's own day; days without a snapshot keep null."""
    return split_join(facts, snapshots.select(key, "date", *attrs).distinct(), [key, "date"], "left")


def labelled(df: DataFrame, rules: Mapping[str, Sequence[tuple[str, str]]], column: str) -> DataFrame:
    """Adds one label column per rule list, all read from the same text column."""
    return df.withColumns({name: label_like(column, r) for name, r in rules.items()})
