"""Exact percentiles without collecting or sorting the values.

Spark's ``percentile`` keeps every distinct value in one aggregation buffer. Here a mergeable quantile
sketch of fixed size gives a narrow bracket around each wanted value. One more pass counts the rows
between the brackets and keeps only the values inside them, which decides every rank exactly. Where a
rank lies outside its bracket after all, the bracket is widened to where it lies and the pass repeated.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.stages import staged

#: Size of the sketch, some 80 KB for any number of values.
SKETCH = 4096
#: Values inside the brackets of which the ranks are counted in one sorted run; brackets that hold more are narrowed first.
MOST_INSIDE = 4_000_000
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1

Bracket = tuple[int, int]


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint") if value != _LOWEST else F.expr("-9223372036854775808L")


def _inside(bracket: Bracket) -> Column:
    return F.col("value").between(_long(bracket[0]), _long(bracket[1]))


def _sketched(values: DataFrame, bracket: Bracket, shares: Sequence[tuple[float, float]], size: int) -> tuple[int, int, list[Bracket]]:
    """Rows below the bracket and inside it, and for each range of shares of the inside its bracket by the sketch; one pass, one row."""
    inside = F.when(_inside(bracket), F.col("value"))
    made = values.agg(F.count_if(F.col("value") < _long(bracket[0])).alias("below"), F.count(inside).alias("n"),
                      F.kll_sketch_agg_bigint(inside, size).alias("sketch"))
    at = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(min(max(s, 0.0), 1.0)))).alias(f"q{i}{j}")
          for i, pair in enumerate(shares) for j, s in enumerate(pair)]
    row = made.select("below", "n", *at).first()
    brackets = [(bracket[0] if a <= 0 else row[f"q{i}0"], bracket[1] if b >= 1 else row[f"q{i}1"]) for i, (a, b) in enumerate(shares)]
    return row["below"], row["n"], brackets


def _joined(brackets: Sequence[Bracket]) -> list[Bracket]:
    """The brackets in order, overlapping ones as one."""
    out: list[Bracket] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _ranked(values: DataFrame, brackets: Sequence[Bracket], ranks: Sequence[int]) -> dict[int, tuple[int, int | None]]:
    """For each rank its region (odd: inside a bracket) and, inside one, its value.

    Every row outside the brackets is only counted with its region, and regions follow each other in order of value, so a
    running count over regions and inside values is the rank.
    """
    region, value = F.lit(2 * len(brackets)), F.lit(None).cast("bigint")
    for i, (low, high) in reversed(list(enumerate(brackets))):
        region = F.when(F.col("value") < _long(low), 2 * i).when(F.col("value") <= _long(high), 2 * i + 1).otherwise(region)
        value = F.when(_inside((low, high)), F.col("value")).otherwise(value)
    counts = values.select(region.alias("region"), value.alias("value")).groupBy("region", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("region", "value").rowsBetween(Window.unboundedPreceding, 0))  # at most MOST_INSIDE rows and the regions
    placed = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    hit = F.lit(False)
    for k in ranks:
        hit = hit | ((F.col("before") <= k) & (F.col("upto") > k))
    rows = placed.where(hit).collect()  # no more rows than ranks
    return {k: next((r.region, r.value) for r in rows if r.before <= k < r.upto) for k in ranks}


def _ranks(p: float, n: int) -> tuple[int, int]:
    """The ranks (from 0) below and above a share of ``n`` rows."""
    return math.floor(p * (n - 1)), math.ceil(p * (n - 1))


def exact_values(values: DataFrame, probs: Sequence[float], sketch: int = SKETCH, margin: float | None = None, most: int = MOST_INSIDE) -> tuple[int, dict[int, int]]:
    """The number of rows of ``values`` (value, no nulls) and the values at the ranks below and above each share.

    ``margin`` is the half width of a first bracket as a share of all rows, by default several times the sketch's error.
    """
    margin = 10 / sketch ** 0.9 if margin is None else margin
    _, n, first = _sketched(values, (_LOWEST, _HIGHEST), [(p - margin, p + margin) for p in probs], sketch)
    if not n:
        return 0, {}
    brackets = {k: bracket for p, bracket in zip(probs, first) for k in _ranks(p, n)}
    ranks = sorted(brackets)
    expected = 2 * margin * n
    while expected > most and margin < 0.25:  # narrow each bracket by a sketch of its inside
        for k in ranks:
            below, inside, _ = _sketched(values, brackets[k], [], sketch)
            if below <= k < below + inside:
                share = (k - below) / inside
                brackets[k] = _sketched(values, brackets[k], [(share - margin, share + margin)], sketch)[2][0]
        expected *= 2 * margin
    found: dict[int, int] = {}
    width = dict.fromkeys(ranks, max(margin, 1e-6))
    while len(found) < len(ranks):
        joined = _joined(list(brackets.values()))
        for k, (region, value) in _ranked(values, joined, ranks).items():
            if region % 2:
                found[k] = value
            else:  # the rank lies between two brackets, so there is where to look, with a wider one
                gap = (joined[region // 2 - 1][1] + 1 if region else _LOWEST, joined[region // 2][0] - 1 if region < 2 * len(joined) else _HIGHEST)
                below, inside, _ = _sketched(values, gap, [], sketch)
                share, width[k] = (k - below) / inside, 8 * width[k]
                brackets[k] = _sketched(values, gap, [(share - width[k], share + width[k])], sketch)[2][0]
    return n, found


def exact_percentiles(df: DataFrame, column: str, probs: Mapping[str, float], sketch: int = SKETCH, margin: float | None = None, stage: bool = True) -> DataFrame:
    """One row with a double per entry of ``probs``, linearly interpolated between ranks.

    ``column`` may hold any integers of 64 bits; nulls are ignored, and without values every percentile is null. The values
    are written to the shared folder once (unless ``stage`` is false, for a frame that is a stage already) and read by two small
    jobs at the time of the call, for the sketch and for the ranks; the result holds the found numbers and reads no table.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("bigint").alias("value"))
    n, found = exact_values(staged(values, "values") if stage else values, list(probs.values()), sketch, margin)

    def at(p: float) -> float | None:
        if not n:
            return None
        low, high = (float(found[k]) for k in _ranks(p, n))
        return low + (high - low) * (p * (n - 1) - math.floor(p * (n - 1)))

    return df.sparkSession.range(1).select(*[F.lit(at(p)).cast("double").alias(name) for name, p in probs.items()])


def percentile_tiers(df: DataFrame, column: str, probs: Mapping[str, float], cuts: DataFrame | None = None,
                     name: str = "tier") -> DataFrame:
    """Tier per row, named after the first percentile the value does not exceed, else after the last one."""
    cuts = exact_percentiles(df, column, probs) if cuts is None else cuts
    tier = F.lit(f">{100 * list(probs.values())[-1]:g}")
    for p, share in reversed(probs.items()):
        tier = F.when(F.col(column) <= F.col(f"__cuts.{p}"), F.lit(f"<={100 * share:g}")).otherwise(tier)
    with_cuts = df.withColumn("__cuts", cuts.select(F.struct(*probs)).scalar())
    return with_cuts.withColumn(name, tier).drop("__cuts")
