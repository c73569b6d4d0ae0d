"""Baskets, purchase paths and per-user orderings.

No list or set is built per user. A user's basket or path is a 128-bit digest that is
aggregated like a sum; users with one digest form a group, named by its smallest user,
and the group's items come in long form, read off that user's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import ratio, total_use
from tallyforge.stages import staged


def _digest(*parts: Column) -> Column:
    """Order-free digest of a group's rows; every row's parts must be distinct within the group."""
    return F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*parts)).alias("a"),
                    F.bit_xor(F.xxhash64(F.lit("second"), *reversed(parts))).alias("b"))


def _groups(members: DataFrame, key: str, count: str, *parts: Column) -> DataFrame:
    """Users with equal rows as one group: the smallest user, the number of users and of rows each has."""
    per_user = members.groupBy(key).agg(_digest(*parts).alias("__digest"))
    return per_user.groupBy("__digest").agg(F.min(key).alias(key), F.count(key).alias("users")).select(
        key, "users", F.col("__digest.n").alias(count))


def positions(df: DataFrame, key: str, time: str, tie: Sequence[str] = (), name: str = "position") -> DataFrame:
    """1-based position of each row in its user's order by ``time``, then ``tie``.

    Rows are numbered within each minute of a user, and the rows before that minute are added from counts
    per minute. So a very active user is spread over as many tasks as they have active minutes, and only the
    counts of the minutes come together. The last row of a minute has its count, so both read one shuffle.
    """
    rows = df.withColumn("__minute", F.date_trunc("minute", F.col(time)))
    minute = Window.partitionBy(key, "__minute")
    inside = rows.withColumn(name, F.row_number().over(minute.orderBy(time, *tie)))
    counts = inside.groupBy(key, "__minute").agg(F.max(name).alias("__n"))
    before = Window.partitionBy(key).orderBy("__minute").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(key).alias("__key"), F.col("__minute").alias("__from"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    on = F.col(key).eqNullSafe(F.col("__key")) & F.col("__minute").eqNullSafe(F.col("__from"))
    return inside.join(offsets, on).select(key, (F.col(name) + F.col("__before")).alias(name), *[c for c in df.columns if c != key])


def baskets(df: DataFrame, key: str = "account_id", item: str = "product_name") -> DataFrame:
    """Sets of items that users hold, one row per set and item: smallest user, users, items (of the set), item.

    The users' items are written to the shared folder once, for the groups and for their items.
    """
    pairs = staged(df.where(F.col(item).isNotNull()).select(key, item).distinct(), "baskets")
    return _groups(pairs, key, "items", F.col(item)).join(pairs, key).select(key, "users", "items", item)


def path_items(df: DataFrame, key: str, time: str, tie: Sequence[str], item: str) -> DataFrame:
    """Every user's path in long form: user, position, item."""
    return positions(df, key, time, tie).select(key, "position", item)


def purchase_path(df: DataFrame, key: str = "account_id", time: str = "time", tie: Sequence[str] = ("transaction_id", "product_id"),
                  item: str = "product_name") -> DataFrame:
    """Orders in which users got their items, one row per path and position: smallest user, users, steps (of the path),
    position, item. Rows of one instant are ordered by ``tie``; rows without an item are no step. All users' steps are written to
    the shared folder once, for the groups and for their items."""
    rows = df.where(F.col(item).isNotNull()).select(*dict.fromkeys([key, time, *tie, item]))
    steps = staged(path_items(rows, key, time, tie, item), "paths")
    return _groups(steps, key, "steps", F.col("position"), F.col(item)).join(steps, key).select(key, "users", "steps", "position", item)


def count_histogram(df: DataFrame, key: str = "account_id", item: str | None = "product_name") -> DataFrame:
    """Users, coins and coins per user by number of distinct items (or of rows, without ``item``) per user."""
    if item is None:
        per_user = df.groupBy(key).agg(F.count(F.lit(1)).alias("items"), F.sum(total_use()).alias("total_use"))
    else:
        pairs = df.groupBy(key, item).agg(F.sum(total_use()).alias("t"))
        per_user = pairs.groupBy(key).agg(F.count(item).alias("items"), F.sum("t").alias("total_use"))
    return (per_user.groupBy("items").agg(F.count(key).alias("users"), F.sum("total_use").alias("total_use"))
            .withColumn("arppu", ratio("total_use", "users")))


def nth_active_day(logins: DataFrame, dates: DataFrame, starts: DataFrame | None = None, key: str = "account_id") -> DataFrame:
    """For each (user, date): which of the user's active days it was, null if the user was not seen then.

    ``starts`` (user, start_day) counts only days from each user's own start on. Days are made
    distinct first, so a user has at most one row per calendar day in the window.
    """
    days = logins.select(key, "date").distinct()
    if starts is not None:
        days = days.join(starts.select(key, "start_day"), key).where("date >= start_day").drop("start_day")
    numbered = days.withColumn("active_day", F.row_number().over(Window.partitionBy(key).orderBy("date")))
    return dates.join(numbered, [key, "date"], "left")


def combo(df: DataFrame, key: Sequence[str], kind: str, sep: str = ", ") -> DataFrame:
    """Sorted distinct kinds per key as text; nulls leave no trace and a key of only nulls gives ''."""
    kinds = df.select(*key, kind).distinct()
    return kinds.groupBy(*key).agg(F.concat_ws(sep, F.sort_array(F.collect_set(kind))).alias("combo"))


def owned_combo(owners: DataFrame, key: str = "account_id", model: str = "model") -> DataFrame:
    """Users per sorted list of models owned; ``owners`` holds one row per user and model, repeats are kept."""
    per_user = owners.groupBy(key).agg(F.concat_ws(",", F.sort_array(F.collect_list(model))).alias("models"))
    return per_user.groupBy("models").agg(F.count(key).alias("users"))


def timeline(df: DataFrame, user: Column | int | str, time: str, key: str = "account_id") -> DataFrame:
    return df.where(F.col(key) == user).orderBy(time)
