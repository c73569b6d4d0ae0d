"""People counts and sums per group, at one or several grouping levels.

People counts are done in two steps instead of by ``count(distinct)``: first one
row per (group, person) with the person's flags and sums, then one row per group.
Both steps combine on the map side, so neither a busy person nor a busy group
piles its rows on one task, and several people counts need no row expansion.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.stages import staged

_PICK = "__level"


def _flag(condition: Column | bool | str, name: str) -> Column:
    """Whether a condition, given as SQL text, a column or a constant, held for any row; unknown is no."""
    if isinstance(condition, Column):
        return F.max(F.coalesce(condition, F.lit(False))).alias(name)
    text = str(condition).lower() if isinstance(condition, bool) else condition
    return F.expr(f"max(coalesce({text}, false)) AS {name}")


def people_and_sums(
    df: DataFrame,
    key: str,
    dims: Sequence[str],
    people: Mapping[str, Column | bool | str] | None = None,
    sums: Mapping[str, Column | str] | None = None,
    rows: str | None = None,
    levels: Sequence[Sequence[str]] | None = None,
    labels: Mapping[str, str] | None = None,
    attrs: DataFrame | None = None,
    how: str = "left",
) -> DataFrame:
    """Per group: people for whom a condition held at least once, sums, and a row count.

    ``levels`` lists the grouping sets (default: all ``dims``). A dimension rolled up
    at a level holds ``labels[dim]`` there, so a real null is never taken for a total.
    Rows with a null ``key`` count in sums and rows but not as people.

    ``attrs`` (the key and attributes, one row per combination) supplies the dimensions that ``df``
    lacks. It is joined (``how``) to the one-row-per-person stage, so raw rows are never shuffled by
    person for it and a person with very many rows costs no task more than others.
    """
    people, sums, labels = dict(people or {}), dict(sums or {}), dict(labels or {})
    keep = [_flag(c, f"__p_{n}") for n, c in people.items()]
    keep += [F.sum(c).alias(f"__s_{n}") for n, c in sums.items()]
    keep += [F.expr("count(1) AS __rows")]
    who = [*dims, key]
    if attrs is not None:
        if levels is not None:
            raise ValueError("levels and attrs do not go together")
        own = [d for d in dims if d not in attrs.columns]
        per_person, groups = df.groupBy(*own, key).agg(*keep).join(attrs, key, how), list(dims)
    elif levels is None:
        per_person, groups = df.groupBy(*who).agg(*keep), list(dims)
    else:
        sets = [[F.col(c) for c in [*level, key]] for level in levels]
        keep.append(F.grouping_id().alias(_PICK))
        per_person, groups = df.groupingSets(sets, *[F.col(c) for c in who]).agg(*keep), [*dims, _PICK]
    out = per_person.groupBy(*groups).agg(
        *[F.expr(f"count(CASE WHEN __p_{n} THEN `{key}` END) AS `{n}`") for n in people],
        *[F.expr(f"sum(__s_{n}) AS `{n}`") for n in sums],
        *([F.expr(f"sum(__rows) AS `{rows}`")] if rows else []),
    )
    if levels is None:
        return out
    width = len(who)
    for i, dim in enumerate(dims):
        if dim in labels:
            rolled_up = F.col(_PICK).bitwiseAND(F.lit(1 << (width - 1 - i)).cast("bigint")) != 0
            out = out.withColumn(dim, F.when(rolled_up, F.lit(labels[dim])).otherwise(F.col(dim)))
    return out.drop(_PICK)


def count_distinct_by(df: DataFrame, dims: Sequence[str], key: str, name: str) -> DataFrame:
    """Distinct keys per group."""
    return df.groupBy(*dims).agg(F.count_distinct(key).alias(name))


def label_after(df: DataFrame, column: str, default: str) -> DataFrame:
    """Default label put on *after* aggregation: a null group and a literal group stay two rows."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int | None, name: str = "rank") -> DataFrame:
    """Row number per group over already aggregated rows; with ``n`` only the first ``n`` are kept.

    The limit is applied before the shuffle as well (Spark's window group limit),
    so a large group sends ``n`` rows per task and not all of them.
    """
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked if n is None else ranked.where(F.col(name) <= n)


def rank_all(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank", parts: int | None = None) -> DataFrame:
    """``top_n`` without a limit for groups of any size: the same row numbers, and no window over a whole group.

    The rows are range-partitioned by group and order, so a group that holds a third of all rows lies sorted over many tasks, and written
    to the shared folder with their place, once. A row's number is its place in its part of the group plus the sizes of
    the parts before; only those sizes, one per group and part, come together. ``order`` should leave no ties; rows that tie
    wholly are numbered in any order. ``parts`` is the number of ranges, by default the session's number of shuffle partitions.
    """
    ranges = ([parts] if parts else []) + [F.col(c) for c in by] + list(order)
    placed = staged(df.repartitionByRange(*ranges).sortWithinPartitions(*ranges[1 if parts else 0:]).withColumn("__at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))  # the task's number stands in the upper bits
    sizes = placed.groupBy(*by, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__part").alias("__of"), (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by] + [F.col("__part") == F.col("__of")]
    return placed.join(offsets, on).select(*df.columns, (F.col("__at") + F.col("__shift")).cast("int").alias(name))
