"""Cohorts: overlap, ordered events, funnels, retention and first-purchase order.

Wherever only the first or last time of something matters, it is aggregated per user
first; users, not raw rows, then meet in joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import ratio, total_use
from tallyforge.functions.periods import as_date
from tallyforge.operators.joins import flag_new_buyer, in_cohort
from tallyforge.operators.skew import split_join
from tallyforge.operators.levels import people_and_sums


def cohort_spend(purchases: DataFrame, cohort: DataFrame, cut: str, key: str = "account_id", unit: int = 100) -> DataFrame:
    """Mean spend per buying user and day of a cohort, before and from the cut-off day on.

    ``users`` and ``mean_spend`` cover the whole cohort, the ``kept_`` columns those of its
    users that had also bought before the cut-off.
    """
    daily = in_cohort(purchases.groupBy("date", key).agg(F.sum(total_use()).alias("spend")), cohort, key)
    is_after = F.col("date") >= as_date(cut)
    had_before = daily.groupBy(key).agg(F.max(~is_after).alias("kept"))
    per_day = daily.join(had_before, key).groupBy("date").agg(
        F.count(key).alias("users"), F.sum("spend").alias("s"),
        F.count(F.when(F.col("kept"), F.col(key))).alias("kept_users"), F.sum(F.when(F.col("kept"), F.col("spend"))).alias("ks"))
    return per_day.select(
        "date", F.when(is_after, "after").otherwise("before").alias("period"), "users",
        ratio("s", F.col("users") * unit).alias("mean_spend"), "kept_users",
        ratio("ks", F.col("kept_users") * unit).alias("kept_mean_spend"))


def overlap(purchases: DataFrame, groups: Mapping[str, Column], key: str = "account_id") -> DataFrame:
    """For each ordered pair of product groups: buyers of both and their share of the first group's buyers.

    One flag per group and user; the pairs are counted as conditions over the flags and
    never formed as rows.
    """
    flags = purchases.groupBy(key).agg(*[F.max(F.coalesce(c, F.lit(False))).alias(n) for n, c in groups.items()])
    names = list(groups)
    counts = flags.agg(*[F.count_if(F.col(a) & F.col(b)).alias(f"{a}~{b}") for a in names for b in names])
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"`{a}~{a}`").alias("users"),
                 F.col(f"`{a}~{b}`").alias("both")) for a in names for b in names if a != b]))
    return counts.select(rows.alias("r")).select("r.*").withColumn("share", ratio(F.col("both") * 100, "users"))


def b_after_a(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("account_id",), time: str = "time",
              a_time: str | None = None) -> DataFrame:
    """Rows of ``b`` later than the first ``a`` of the same key; later than *any* a means later than the first.

    Each row's own time counts, so rows of ``b`` meet that first time one by one; a busy key is spread over
    several tasks.
    """
    first = a.groupBy(*keys).agg(F.min(a_time or time).alias("__first_a"))
    return split_join(b, first, keys).where(F.col(time) > F.col("__first_a")).drop("__first_a")


def with_side(df: DataFrame, cut: str, time: str = "time", name: str = "is_after") -> DataFrame:
    return df.withColumn(name, F.col(time) > F.lit(cut).cast("timestamp_ntz"))


def both_sides(df: DataFrame, cut: str, key: str = "account_id", time: str = "time") -> DataFrame:
    """Per user: activity before, after, and on how many sides of the cut-off."""
    sided = with_side(df, cut, time)
    per_user = sided.groupBy(key).agg(F.max(~F.col("is_after")).alias("before"), F.max("is_after").alias("after"))
    return per_user.withColumn("sides", F.col("before").cast("int") + F.col("after").cast("int"))


def split_amount(df: DataFrame, cut: str, amount: str, key: str = "account_id", time: str = "time") -> DataFrame:
    """Per user: amount before and after the cut-off, null where there is none on that side."""
    after = F.col(time) > F.lit(cut).cast("timestamp_ntz")
    return df.groupBy(key).agg(F.sum(F.when(~after, F.col(amount))).alias("before_amount"),
                               F.sum(F.when(after, F.col(amount))).alias("after_amount"))


def only_after(split: DataFrame) -> DataFrame:
    return split.where(F.col("before_amount").isNull() & F.col("after_amount").isNotNull())


def first_event(df: DataFrame, reason: str, key: str = "account_id", time: str = "time", column: str = "reason") -> DataFrame:
    """Users whose very first event has the reason, also when it shares its instant with others."""
    firsts = df.groupBy(key).agg(F.min(time).alias("first_time"),
                                 F.min(F.when(F.col(column) == reason, F.col(time))).alias("__with_reason"))
    return firsts.where(F.col("__with_reason") == F.col("first_time")).drop("__with_reason")


def participation(cohorts: Sequence[tuple[DataFrame, int]], key: str = "account_id") -> DataFrame:
    """Sum of cohort codes per user and users per sum; codes must have distinct subset sums."""
    coded = None
    for cohort, code in cohorts:
        one = cohort.select(key).distinct().withColumn("code", F.lit(code))
        coded = one if coded is None else coded.unionByName(one)
    per_user = coded.groupBy(key).agg(F.sum("code").alias("code"))
    return per_user.groupBy("code").agg(F.count(key).alias("users"))


def first_times(events: DataFrame, steps: Mapping[str, Column], key: str = "account_id", time: str = "time") -> DataFrame:
    """First time of each step per user, from one pass over the events."""
    return events.groupBy(key).agg(*[F.min(F.when(c, F.col(time))).alias(n) for n, c in steps.items()])


def did_without(firsts: DataFrame, did: Sequence[str], without: Sequence[str]) -> DataFrame:
    """Users that took all steps of ``did`` and none of ``without``, with the time ``done`` of the last one taken."""
    hit = F.lit(True)
    for step in did:
        hit = hit & F.col(step).isNotNull()
    for step in without:
        hit = hit & F.col(step).isNull()
    return firsts.where(hit).withColumn("done", F.greatest(*did) if len(did) > 1 else F.col(did[0]))


def funnel(firsts: DataFrame, steps: Sequence[str]) -> DataFrame:
    """One row per step: users that reached it and all steps before, and those that did so in order.

    In order means each step's first time lies after the first time of the step before.
    """
    rows, reached, ordered = [], F.lit(True), F.lit(True)
    for i, step in enumerate(steps):
        reached = reached & F.col(step).isNotNull()
        if i:
            ordered = ordered & (F.col(steps[i - 1]) < F.col(step))
        rows.append((i + 1, step, reached, ordered))
    counted = firsts.agg(*[c for i, _, r, o in rows for c in (
        F.count_if(r).alias(f"r{i}"), F.count_if(r & F.coalesce(o, F.lit(False))).alias(f"o{i}"))])
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("name"), F.col(f"r{i}").alias("reached"),
                 F.col(f"o{i}").alias("in_order")) for i, name, _, _ in rows])).alias("r")).select("r.*")


def threshold_takeup(gains: DataFrame, minimum: int, purchases: DataFrame, amount: str = "amount",
                     item: str = "product_id", key: str = "account_id") -> DataFrame:
    """Buyers per item among users whose total gain reaches ``minimum``, beside the number of such users."""
    rich = gains.groupBy(key).agg(F.sum(amount).alias("total")).where(F.col("total") >= minimum)
    taken = people_and_sums(purchases, key, [item], {"pu": True}, attrs=rich.select(key), how="left_semi")
    return taken.withColumn("users", rich.agg(F.count(key)).scalar()).withColumn("takeup", ratio("pu", "users"))


def retention(earlier: DataFrame, later: DataFrame, key: str = "account_id") -> DataFrame:
    """Users of two campaigns: earlier, later, both, and the share of the earlier ones retained."""
    flags = (earlier.select(key).distinct().withColumn("a", F.lit(1))
             .join(later.select(key).distinct().withColumn("b", F.lit(1)), key, "full_outer"))
    return (flags.agg(F.count("a").alias("earlier_users"), F.count("b").alias("later_users"),
                      F.count(F.col("a") + F.col("b")).alias("retained"))
            .withColumn("retention", ratio(F.col("retained") * 100, "earlier_users")))


def bought_by(purchases: DataFrame, cohort: DataFrame, by: Sequence[str], key: str = "account_id") -> DataFrame:
    """What a cohort buys: users and coins per group."""
    return people_and_sums(purchases, key, by, {"users": True}, {"paid_use": "paid_use", "total_use": total_use()},
                           attrs=cohort.select(key), how="left_semi")


def new_buyer_kpi(purchases: DataFrame, ledger: DataFrame, by: Sequence[str], key: str = "account_id",
                  attrs: DataFrame | None = None) -> DataFrame:
    """New buyers per group, their coins on their first day, and the share of all coins.

    Purchases shrink to one row per user and day before they meet the ledger and the users' ``attrs``.
    """
    own = [d for d in by if attrs is None or d not in attrs.columns]
    daily = purchases.groupBy(key, "date", *own).agg(F.max(F.col("paid_use") > 0).alias("paid"), F.sum(total_use()).alias("coins"))
    flagged = flag_new_buyer(daily, ledger, key)
    out = people_and_sums(flagged, key, by, {"pu": True, "npu": "is_new", "paid_npu": "is_new AND paid"},
                          {"total_use": "coins", "new_use": F.when(F.col("is_new"), F.col("coins"))}, attrs=attrs, how="inner")
    return out.withColumn("new_share", ratio(F.col("new_use") * 100, "total_use"))


def first_order(a: DataFrame, b: DataFrame, key: str = "account_id", day: str = "date") -> DataFrame:
    """Users by the order of their first purchases in two product lines.

    a: first line first; b: both the same day; c: second line first; d: second only; e: first only.
    """
    fa, fb = a.groupBy(key).agg(F.min(day).alias("a_day")), b.groupBy(key).agg(F.min(day).alias("b_day"))
    case = (F.when(F.col("a_day") < F.col("b_day"), "a").when(F.col("a_day") == F.col("b_day"), "b")
            .when(F.col("a_day") > F.col("b_day"), "c").when(F.col("a_day").isNull(), "d").otherwise("e"))
    return fa.join(fb, key, "full_outer").groupBy(case.alias("case")).agg(F.count(key).alias("users"))


def pass_uptake(passes: DataFrame, limits: Mapping[str, str], key: str = "account_id") -> DataFrame:
    """Users per pass that held it up to that pass's own cut-off day."""
    hit = None
    for name, day in limits.items():
        one = (F.col("pass_name") == name) & (F.col("date") <= as_date(day))
        hit = one if hit is None else hit | one
    return people_and_sums(passes.where(hit), key, ["pass_name"], {"users": True})


def pass_share(users: DataFrame, *holders: DataFrame, key: str = "account_id") -> DataFrame:
    """Users found in any of the holder sets over all active users."""
    ids = None
    for h in holders:
        ids = h.select(key) if ids is None else ids.unionByName(h.select(key))
    return users.agg(F.count_distinct(key).alias("au")).withColumn(
        "pass_users", ids.agg(F.count_distinct(key)).scalar()).withColumn("share", ratio("pass_users", "au"))


def cross_check(segments: DataFrame, snapshot: DataFrame, by: Sequence[str], key: str = "account_id") -> DataFrame:
    """Users of a snapshot by the segments they were put in, to spot contradictions."""
    return people_and_sums(segments.join(snapshot.select(key).distinct(), key), key, by, {"users": True})


