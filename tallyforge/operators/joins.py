"""Enrichment: user attributes, versioned price lists, cohorts and campaigns.

No join here carries a broadcast hint: the optimiser broadcasts a side whose size it
knows to be small, and falls back to a shuffled join with skew splitting otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.columns import resolve_country, strip_prefix
from tallyforge.functions.periods import as_date
from tallyforge.operators.skew import interval_join, split_join

OPEN_END = "2038-01-19 00:00:00"  # fixed value: end of a product's last price version


def with_country(users: DataFrame, os: str = "country_os", ip: str = "country_ip", home: str = "CN") -> DataFrame:
    return users.withColumn("country", resolve_country(os, ip, home))


def with_region(users: DataFrame, regions: DataFrame, code: str = "country") -> DataFrame:
    """Region by country code; an unknown code leaves a null region."""
    lookup = regions.select(F.col("country_code").alias("__code"), "region")
    return users.join(lookup, F.col(code) == F.col("__code"), "left").drop("__code")


def with_membership(users: DataFrame, membership: DataFrame, default: str | None = "undefined",
                    key: str = "account_id") -> DataFrame:
    """Membership level; ``default=None`` leaves the gap for a label after aggregation."""
    out = users.join(membership.select(key, "membership").distinct(), key, "left")
    return out if default is None else out.withColumn("membership", F.coalesce("membership", F.lit(default)))


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` columns per key, nulls first.

    An aggregate and not a window: one running row per key and task, combined before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return best.select(*keys, "__first.*")


def is_active(start: str | Column | None = None, mode: str = "since", day: str = "date", login: str = "last_login") -> Column:
    """Condition for a live account on a real platform, active in one of two senses.

    ``since``: last login on or after ``start`` (one closing snapshot);
    ``same_day``: last login on the snapshot's own day (a daily snapshot each);
    ``any``: no login condition.
    """
    live = (F.col("server_type") == "LIVE") & ~F.col("platform").like("%NULL%")
    if mode == "since":
        return live & (F.col(login) >= as_date(start))
    if mode == "same_day":
        return live & (F.col(login) == F.col(day))
    return live


def active_users(users: DataFrame, start: str | Column | None = None, mode: str = "since",
                 day: str = "date", login: str = "last_login") -> DataFrame:
    return users.where(is_active(start, mode, day, login))


def version_ranges(dim: DataFrame, keys: Sequence[str], start: str = "start_time") -> DataFrame:
    """Adds ``valid_from``/``valid_to``; a product with a single version is valid at any time (nulls)."""
    versions = Window.partitionBy(*keys)
    many = F.count(F.lit(1)).over(versions) > 1
    next_start = F.coalesce(F.lead(start).over(versions.orderBy(start)), F.lit(OPEN_END).cast("timestamp_ntz"))
    return dim.withColumns({"valid_from": F.when(many, F.col(start)), "valid_to": F.when(many, next_start)})


def scd2_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], time: str = "time",
              start: str = "start_time", slice_it: bool | None = None) -> DataFrame:
    """Facts with the price version valid at their time; unmatched facts stay.

    A price list too large to broadcast is joined by product and slice of time, see ``interval_join``.
    """
    ranged = version_ranges(dim, keys, start)
    names = [f"__{k}" for k in keys]
    ranged = ranged.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in ranged.columns if c not in keys])
    return interval_join(facts, ranged, list(keys), names, time, slice_it=slice_it).drop(*names, "valid_from", "valid_to")


def either_key_join(facts: DataFrame, dim: DataFrame, fact_id: str, dim_id: str, keys: Sequence[str], item: str, time: str = "time",
                    start: str = "start_time", prefix: str = "offer", slice_it: bool | None = None) -> DataFrame:
    """By sales id where the fact has one, else by product and time (``scd2_join`` rules).

    The two rules become one equi join: each dimension row appears once under its own id
    and once under its product, and a fact carries whichever key applies. Facts are read
    once, and every row of a platform hashes by that key and not by the platform alone; with a price list too
    large to broadcast a heavy product or id is spread by slices of time as well.
    """
    ranged = version_ranges(dim, [*keys, item], start)
    attrs = [c for c in dim.columns if c not in (*keys, item)]
    names = [f"__{k}" for k in keys]
    shared = [F.col(k).alias(n) for k, n in zip(keys, names)]
    any_time = F.lit(None).cast(dim.schema[start].dataType)
    by_id = ranged.select(*shared, F.lit(True).alias("__by_id"), F.col(dim_id).alias("__key_of"), any_time.alias("valid_from"), any_time.alias("valid_to"), *attrs)
    by_item = ranged.select(*shared, F.lit(False).alias("__by_id"), F.col(item).alias("__key_of"), "valid_from", "valid_to", *attrs)
    keyed = facts.withColumns({
        "__has_id": F.col(fact_id).isNotNull(),
        # an id without the expected form matches nothing, and not a product by chance
        "__fact_key": F.when(F.col(fact_id).isNotNull(), strip_prefix(fact_id, prefix)).otherwise(F.col(item))})
    joined = interval_join(keyed, by_id.unionByName(by_item), [*keys, "__has_id", "__fact_key"], [*names, "__by_id", "__key_of"], time, slice_it=slice_it)
    return joined.drop("__has_id", "__fact_key", "__by_id", "__key_of", "valid_from", "valid_to", *names)


def lookup_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], exclude: Sequence[str] = (),
                item: str = "product_id", status: str = "Succeeded") -> DataFrame:
    """Plain lookup for facts without transactions: filler id and status, midnight for a missing time.

    Products in ``exclude`` are dropped, and with them rows that name no product.
    """
    kept = facts.where(~F.col(item).isin(list(exclude))) if exclude else facts
    filled = kept.withColumns({
        "transaction_id": F.lit(None).cast("string"), "status": F.lit(status),
        "time": F.coalesce(F.col("time"), F.col("date").cast("timestamp_ntz"))})
    return filled.join(dim, list(keys), "left")


def with_revenue(df: DataFrame, units: str, price: str, name: str = "revenue") -> DataFrame:
    return df.withColumn(name, F.col(units) * F.col(price))


def in_cohort(df: DataFrame, cohort: DataFrame, key: str = "account_id", flag: str | None = None) -> DataFrame:
    """Rows of the cohort's users; with ``flag`` all rows, marked true or false. Busy users' rows are split, see ``split_join``."""
    members = cohort.select(key).distinct()
    if flag is None:
        return split_join(df, members, [key], "left_semi")
    return split_join(df, members.withColumn(flag, F.lit(True)), [key], "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def spread_join(facts: DataFrame, one: DataFrame, keys: Sequence[str], parts: int = 16, how: str = "inner") -> DataFrame:
    """Join (inner or left) of facts with a frame of one row per key, a busy key's facts dealt to ``parts`` tasks."""
    dealt = facts.withColumn("__part", F.pmod(F.xxhash64(*facts.columns), F.lit(parts)))
    copies = one.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    return dealt.join(copies, [*keys, "__part"], how).drop("__part")


def exclude(df: DataFrame, *others: DataFrame, key: str = "account_id") -> DataFrame:
    """Rows whose user is in none of the other cohorts."""
    for other in others:
        df = df.join(other.select(key), key, "left_anti")
    return df


def live_campaign(calendar: DataFrame, day: str | Column, first: str = "start_date", last: str = "end_date",
                  device: str | None = None, more: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """The first calendar row (by start, then name) that covers the day, or no row.

    ``device`` keeps that device's rows. ``more`` names further date ranges (such as sales or the opening of a tab); a
    campaign is live in any of its ranges.
    """
    day = as_date(day)
    live = (F.col(first) <= day) & (day <= F.col(last))
    for a, b in more:
        live = live | ((F.col(a) <= day) & (day <= F.col(b)))
    rows = calendar if device is None else calendar.where(F.col("device") == device)
    return rows.where(live).orderBy(first, "name").limit(1)


def flag_new_buyer(purchases: DataFrame, ledger: DataFrame, key: str = "account_id", name: str = "is_new") -> DataFrame:
    """True where the purchase day is the user's first purchase day in the ledger."""
    first = ledger.select(key, "first_use_date").distinct()
    flagged = purchases.join(first, key, "left")
    return flagged.withColumn(name, F.coalesce(F.col("date") == F.col("first_use_date"), F.lit(False)))
