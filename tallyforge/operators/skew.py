"""Joins that hold when one key has a third of all rows.

Which keys are heavy is read from a summary of fixed size, a mergeable sketch of frequent items that
every task fills and Spark folds like any aggregate. Only heavy keys are split; the other side is
repeated for them alone. Where the optimiser would broadcast the other side, no row is dealt by key
and nothing of this is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of all rows is heavy; its rows go to groups of about this share each.
SHARE = 1 / 128
#: Counters of the summary. Counts are too low by 3.5 / TRACKED of all rows at most, far below ``SHARE``.
TRACKED = 16_384
#: Slices of the time axis, each with an equal number of facts.
SLICES = 64


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimiser's own estimate of the frame lies below the session's broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def _key(columns: Sequence[str]) -> Column:
    """One number for the key columns; two keys that share it are only split together."""
    return F.xxhash64(*[F.col(c) for c in columns])


def heavy_keys(facts: DataFrame, keys: Sequence[str], share: float = SHARE, also: Sequence[Column] = ()) -> DataFrame:
    """(__key, __parts): the keys with more than ``share`` of all rows, and into how many parts to split each.

    At most 1 / ``share`` rows, whatever the facts; a null key can be one. Reads the key columns only. ``also`` names further
    aggregates of the facts, taken in the same pass and put on every row.
    """
    most = int(1 / share) + 1
    names = ", ".join(f"`{k}`" for k in keys)
    summary = facts.agg(F.expr(f"approx_top_k(xxhash64({names}), {most}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("rows"), *also)
    found = summary.select(F.inline("top").alias("__key", "__count"), *[c for c in summary.columns if c != "top"]).where(F.col("__count") > F.col("rows") * share)
    return found.withColumn("__parts", F.ceil(F.col("__count") / (F.col("rows") * share)).cast("int")).drop("__count", "rows")


def split_join(facts: DataFrame, one: DataFrame, keys: Sequence[str], how: str = "inner", share: float = SHARE) -> DataFrame:
    """Join (inner, left or left_semi) on ``keys`` with a frame of few rows per key, heavy keys split over several tasks.

    A heavy key's facts are dealt to its parts by a hash of the whole row, which a repeated task deals alike, and the other
    side's rows of that key are repeated for each part; all other rows are joined as they are. Facts with a null key
    match nothing and are kept by a left join. Identical facts stay together.
    """
    if fits_broadcast(one):
        return facts.join(one, list(keys), how)
    heavy = F.broadcast(heavy_keys(facts, keys, share))
    part = F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*facts.columns), F.col("__parts")).cast("int"))
    dealt = facts.withColumn("__key", _key(keys)).join(heavy, "__key", "left").withColumn("__part", part).drop("__key", "__parts")
    parts = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
    copies = one.withColumn("__key", _key(keys)).join(heavy, "__key", "left").withColumn("__part", F.explode(parts)).drop("__key", "__parts")
    return dealt.join(copies, [*keys, "__part"], how).drop("__part")


def _slice(time: Column, edges: Column) -> Column:
    """The number of edges not after ``time``."""
    return F.coalesce(F.size(F.filter(edges, lambda e: e <= time)), F.lit(0))


def sliced(facts: DataFrame, ranges: DataFrame, fact_keys: Sequence[str], range_keys: Sequence[str], time: str, start: str, end: str,
           slices: int = SLICES, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """Both sides of ``interval_join`` with the column ``__slice``, that together with the keys is the join's key.

    The edges of the slices are quantiles of the facts' times, so a slice holds an equal share of all facts and a group of one
    key and slice no more than that. Facts of a heavy key carry the slice of their time, and a range of such a key stands in every slice
    that it covers; what has no start or no end reaches to that side's last slice. All else carries -1.
    """
    quantiles = ", ".join(f"{i / slices!r}D" for i in range(1, slices))
    heavy = F.broadcast(heavy_keys(facts, fact_keys, share, [F.expr(f"percentile_approx(`{time}`, array({quantiles}), {20 * slices})").alias("__edges")]))
    edges = F.col("__edges")
    is_heavy = F.col("__parts").isNotNull()
    dealt = facts.withColumn("__key", _key(fact_keys)).join(heavy, "__key", "left").withColumn("__slice", F.when(is_heavy, _slice(F.col(time), edges)).otherwise(-1))
    first = F.when(F.col(start).isNull(), 0).otherwise(_slice(F.col(start), edges))
    last = F.when(F.col(end).isNull(), slices - 1).otherwise(_slice(F.col(end), edges))
    covered = F.when(is_heavy, F.sequence(first, F.greatest(first, last))).otherwise(F.array(F.lit(-1)))
    placed = ranges.withColumn("__key", _key(range_keys)).join(heavy, "__key", "left").withColumn("__slice", F.explode(covered))
    return dealt.drop("__key", "__parts", "__edges"), placed.drop("__key", "__parts", "__edges")


def interval_join(facts: DataFrame, ranges: DataFrame, fact_keys: Sequence[str], range_keys: Sequence[str], time: str, start: str = "valid_from",
                  end: str = "valid_to", slice_it: bool | None = None, **how_fine: object) -> DataFrame:
    """Left join of facts with the ranges of their key that hold at their time: ``start`` <= time < ``end``, or any time without a start.

    Ranges that the optimiser can broadcast are joined as they are, unless ``slice_it`` says otherwise. Larger ones are joined by
    key and slice of time (see ``sliced``): a key with a third of all facts is spread over as many groups as its times are, with
    nothing broadcast but the list of heavy keys, and each group meets only the ranges that reach into its slice. Only facts of
    one key and one very instant cannot be told apart that way. A fact without a time matches ranges without a start only. Key
    columns must differ in name between the two sides.
    """
    holds = F.col(start).isNull() | ((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end)))
    on = [F.col(a) == F.col(b) for a, b in zip(fact_keys, range_keys)]
    if slice_it is None:
        slice_it = not fits_broadcast(ranges)
    if not slice_it:
        return facts.join(ranges, [*on, holds], "left")
    dealt, placed = sliced(facts, ranges, fact_keys, range_keys, time, start, end, **how_fine)
    placed = placed.withColumnRenamed("__slice", "__in_slice")
    return dealt.join(placed, [*on, F.col("__slice") == F.col("__in_slice"), holds], "left").drop("__slice", "__in_slice")
