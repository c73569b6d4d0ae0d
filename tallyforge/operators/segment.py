"""User segments and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import label_upto, ratio, total_use
from tallyforge.operators.joins import exclude
from tallyforge.operators.levels import people_and_sums, rank_all, top_n

# Spend tiers (upper edges included) and the label above the last edge.
SPEND_EDGES = [(2000, "A"), (10000, "B"), (20000, "C"), (40000, "D")]
SPEND_ABOVE = "E"


def spend_tiers(purchases: DataFrame, edges: Sequence[tuple[int, str]] = tuple(SPEND_EDGES), above: str = SPEND_ABOVE,
                key: str = "account_id") -> DataFrame:
    """Paid and total coins per user, with the fixed spend tier."""
    per_user = purchases.groupBy(key).agg(F.sum("paid_use").alias("paid_use"), F.sum(total_use()).alias("total_use"))
    return per_user.withColumn("tier", label_upto("total_use", edges, above))


def main_category(df: DataFrame, category: str, amount: Column | None = None, key: str = "account_id") -> DataFrame:
    """The category a user spends most on (ties by name), with the amount."""
    amount = total_use() if amount is None else amount
    per_cat = df.groupBy(key, category).agg(F.sum(amount).alias("amount"))
    best = F.min_by(F.struct(category, "amount"), F.struct(-F.col("amount"), F.col(category))).alias("b")
    return per_cat.groupBy(key).agg(best).select(key, F.col(f"b.{category}").alias("main_category"), "b.amount")


def play_profile(df: DataFrame, counts: Sequence[str], minutes: Sequence[str], key: str = "account_id") -> DataFrame:
    """Distinct days, plays and minutes per user; a row with a null in any column adds nothing to that sum."""
    add = lambda cols: reduce(lambda a, b: a + b, [F.col(c) for c in cols])
    per_day = df.groupBy(key, "date").agg(F.sum(add(counts)).alias("c"), F.sum(add(minutes)).alias("m"))
    return per_day.groupBy(key).agg(F.count("date").alias("play_days"), F.sum("c").alias("plays"), F.sum("m").alias("minutes"))


def merge_profiles(*profiles: DataFrame, how: str = "full_outer", key: str = "account_id") -> DataFrame:
    """Profiles of one row per user side by side."""
    return reduce(lambda a, b: a.join(b, key, how), profiles)


def exclusive_segments(purchases: DataFrame, is_pass: Column, is_product: Column, key: str = "account_id",
                       measures: Mapping[str, Column] | None = None) -> DataFrame:
    """One segment per buyer of a campaign, from one aggregate.

    P-1: exactly one purchase, a pass; P-3: a pass and a product; P-2: any other pass holder;
    M-2: buyers without a pass.
    """
    per_user = purchases.groupBy(key).agg(
        F.count(F.lit(1)).alias("purchases"), F.max(is_pass).alias("has_pass"), F.max(is_product).alias("has_product"),
        *[F.sum(c).alias(n) for n, c in (measures or {}).items()])
    segment = (F.when(~F.col("has_pass"), "M-2").when(F.col("purchases") == 1, "P-1")
               .when(F.col("has_product"), "P-3").otherwise("P-2"))
    return per_user.withColumn("segment", segment)


def typed_measures(is_pass: Column, is_product: Column, is_level: Column, level_pass: Column, levels: int = 30) -> dict[str, Column]:
    """Amounts that count only for one kind of product; a pass that carries levels counts as that many."""
    return {
        "level_ups": F.when(is_level, F.col("qty")).when(level_pass, F.lit(levels).cast("bigint")),
        "level_up_use": F.when(is_level, total_use()),
        "product_use": F.when(is_product, total_use()),
        "pass_use": F.when(is_pass, total_use()),
        "paid_use": F.col("paid_use"),
        "total_use": total_use(),
    }


def free_segment(sources: Mapping[str, DataFrame], *minus: DataFrame, key: str = "account_id") -> DataFrame:
    """Users of any source and of no other segment: one row per user and source that names them."""
    named = [df.select(key).distinct().withColumn("history", F.lit(n)) for n, df in sources.items()]
    return exclude(reduce(lambda a, b: a.unionByName(b), named), *minus, key=key).withColumn("segment", F.lit("M-1"))


def acquisitions(df: DataFrame, model: Column, key: str = "account_id") -> DataFrame:
    """First day each user got each model; rows of no model are left out."""
    return (df.withColumn("model", model).where(F.col("model").isNotNull())
            .groupBy(key, "model").agg(F.min("date").alias("own_date")))


def owner_groups(owned: DataFrame, short: Mapping[str, str], several: str = "TM", key: str = "account_id") -> DataFrame:
    """Owner group per user: ``several`` for more than one model, else the model's short name."""
    per_user = owned.groupBy(key).agg(F.count(F.lit(1)).alias("models"), F.min("model").alias("model"),
                                      F.min("own_date").alias("first_own_date"))
    group = reduce(lambda c, kv: c.when(F.col("model") == kv[0], kv[1]), short.items(), F.when(F.col("models") > 1, several))
    return per_user.select(key, group.alias("owner_group"), "first_own_date")


def combine_profiles(segments: Sequence[DataFrame], owners: DataFrame, extras: Sequence[DataFrame] = (),
                     earlier: DataFrame | None = None, missing: str = "N", key: str = "account_id") -> DataFrame:
    """Segments of differing columns stacked, owners joined (``missing`` where none), extras added by user.

    Columns of ``earlier`` come in under a ``pre_`` prefix.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), segments)
    out = stacked.join(owners, key, "full_outer").withColumn("owner_group", F.coalesce("owner_group", F.lit(missing)))
    for extra in extras:
        out = out.join(extra, key, "left")
    if earlier is not None:
        out = out.join(earlier.select(key, *[F.col(c).alias(f"pre_{c}") for c in earlier.columns if c != key]), key, "left")
    return out


def opens_by_type(opens: DataFrame, types: Mapping[str, str], item: str = "item_id", amount: str = "open_amount",
                  key: str = "account_id") -> DataFrame:
    """Amount opened per user and crate type, one column per type, null where none was opened."""
    listed = opens.where(F.col(item).isin(list(types)))
    return listed.groupBy(key).agg(*[F.sum(F.when(F.col(item) == i, F.col(amount))).alias(n) for i, n in types.items()])


def gains(log: DataFrame, excluded: Sequence[str], key: str = "account_id") -> DataFrame:
    """Positive amounts per user; excluded reasons are dropped, and rows without a reason with them."""
    kept = log.where(~F.col("reason_detail").isin(list(excluded)) & (F.col("amount") > 0))
    return kept.groupBy(key).agg(F.sum("amount").alias("gained"))


def segment_takeup(segments: DataFrame, taken: DataFrame, by: Sequence[str], item: str = "item_id",
                   key: str = "account_id") -> DataFrame:
    """Users of each segment and how many of them took anything."""
    takers = taken.where(F.col(item).isNotNull()).select(key).distinct().withColumn("took", F.lit(True))
    return people_and_sums(segments.join(takers, key, "left"), key, by, {"users": True, "takers": "took"}).withColumn(
        "takeup", ratio("takers", "users"))


def rank_in_segment(segments: DataFrame, taken: DataFrame, by: Sequence[str], item: str = "item_id",
                    n: int | None = None, key: str = "account_id") -> DataFrame:
    """Items by number of takes within each segment (ties by item), with their users."""
    per_user = taken.groupBy(key, item).agg(F.count(F.lit(1)).alias("takes"))
    counted = (per_user.join(segments.select(key, *by), key).groupBy(*by, item)
               .agg(F.sum("takes").alias("takes"), F.count(key).alias("users")))
    order = [F.desc("takes"), F.asc(item)]
    return rank_all(counted, by, order) if n is None else top_n(counted, by, order, n)


def override_both(owners: DataFrame, models: Sequence[str], label: str = "both", key: str = "account_id") -> DataFrame:
    """Owner rows of two models, relabelled for users that hold both: such a user keeps *two* rows."""
    listed = owners.where(F.col("model").isin(list(models)))
    held = listed.groupBy(key).agg(F.count(F.lit(1)).alias("held"))
    return (listed.join(held, key)
            .withColumn("model", F.when(F.col("held") == 2, F.lit(label)).otherwise(F.col("model"))).drop("held"))


def activity_long(sources: Sequence[tuple[DataFrame, Column | str]], key: str = "account_id") -> DataFrame:
    """Distinct (user, action) rows. Each log is read once: its label is a constant or a ``when`` over its rows."""
    parts = []
    for df, action in sources:
        label = F.lit(action) if isinstance(action, str) else action
        parts.append(df.select(key, label.alias("action")).where(F.col("action").isNotNull()))
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def partition_check(parts: DataFrame, whole: DataFrame, segment: str = "segment", key: str = "account_id") -> DataFrame:
    """Rows, distinct users, users in two segments and users of the whole left out: a sound split has rows = users and 0, 0."""
    per_user = parts.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(segment).alias("segs"))
    missing = whole.select(key).distinct().join(parts, key, "left_anti").agg(F.count(key))
    return per_user.agg(F.sum("n").alias("rows"), F.count(key).alias("users"), F.count_if(F.col("segs") > 1).alias("in_two")
                        ).withColumn("left_out", missing.scalar())
