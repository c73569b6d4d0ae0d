"""State reconstruction over a fixed grid of phases: what each player holds in each phase.

Events are first counted per player, item and phase. From there on a player has at most
one row per phase and item, so every window below is bounded by the phase grid and the
item catalogue, not by the number of events.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PHASE = "decimal(3,1)"


def phases(last: float = 8.5, first: str = "0.1", step: str = "0.5") -> list[Decimal]:
    """The phase grid: ``first``, then 1.0 to ``last`` by ``step``. Decimals, so that phases are exact join keys."""
    out, p = [Decimal(first)], Decimal("1.0")
    while p <= Decimal(str(last)):
        out.append(p)
        p += Decimal(step)
    return out


def tagged_events(log: DataFrame, items: DataFrame, kinds: Sequence[str] = ("equip", "unequip")) -> DataFrame:
    """Log rows of the given kinds whose item is in the item dimension."""
    return log.where(F.col("kind").isin(list(kinds))).join(items.select("item_id"), "item_id")


def counts_by_type(events: DataFrame, keys: Sequence[str], kinds: Mapping[str, str], time: str = "time") -> DataFrame:
    """Events per kind and key group; identical events logged twice count once."""
    once = events.select(*keys, time, "kind").distinct()
    return once.groupBy(*keys).agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(n) for n, k in kinds.items()])


def running_sum(df: DataFrame, part: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    upto = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.sum(c).over(upto) for c in cols})


def held_sets(df: DataFrame, keys: Sequence[str], item: str, diff: Column) -> DataFrame:
    """Items held (difference 1) and released (difference 0) per key; any other difference is neither."""
    return df.groupBy(*keys).agg(
        F.sort_array(F.collect_set(F.when(diff == 1, F.col(item)))).alias("held"),
        F.sort_array(F.collect_set(F.when(diff == 0, F.col(item)))).alias("released"))


def carry_over(df: DataFrame, part: Sequence[str], order: str, cap: int = 2) -> DataFrame:
    """Adds what the last logged phase held and this one did not release, unless ``cap`` items are held already.

    It looks one logged phase back and no further. Phases that end up empty are dropped.
    """
    before = F.lag("held").over(Window.partitionBy(*part).orderBy(order))
    kept = F.coalesce(F.array_except(before, F.col("released")), F.array().cast("array<string>"))
    full = F.size("held") == cap
    items = F.array_sort(F.when(full, F.col("held")).otherwise(F.array_distinct(F.concat("held", kept))))
    return df.withColumn("items", items).drop("held", "released").where(F.size("items") > 0)


def phase_grid(ends: DataFrame, grid: Sequence[Decimal], end: str = "end_phase") -> DataFrame:
    """One row per player and phase up to the player's end; a player without an end has no rows."""
    all_phases = F.array(*[F.lit(str(p)).cast(PHASE) for p in grid])
    return ends.withColumn("phase", F.explode(F.filter(all_phases, lambda p: p <= F.col(end))))


def from_first(grid: DataFrame, held: DataFrame, part: Sequence[str], phase: str = "phase") -> DataFrame:
    """The grid from the first phase in which the player held something."""
    firsts = held.groupBy(*part).agg(F.min(phase).alias("first_phase"))
    return grid.join(firsts, list(part)).where(F.col(phase) >= F.col("first_phase"))


def gap_fill(grid: DataFrame, held: DataFrame, part: Sequence[str], order: str, col: str) -> DataFrame:
    """The grid with ``col`` where known, and the last known value where not."""
    known = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (grid.join(held.select(*part, order, col), [*part, order], "left")
            .withColumn(col, F.last(col, ignorenulls=True).over(known)))


def player_phases(log: DataFrame, items: DataFrame, grid: Sequence[Decimal], player: Sequence[str], cap: int = 2, time: str = "time") -> DataFrame:
    """What each player holds in every phase from the first with an item to the player's end: player, end_phase, first_phase, phase, items.

    The same as the steps above one after the other, from one read of the log and one shuffle by player. Events (deaths among
    them) are counted per player, phase and item first; the counts, at most grid x catalogue per player, then lie with their player, where
    running sums, sets, the look back and the fill need no further shuffle and no join. The grid is a constant array.
    """
    known = items.select("item_id", F.lit(True).alias("__known"))
    death = F.col("kind") == "death"
    tagged = log.where(F.col("kind").isin("equip", "unequip", "death")).join(known, "item_id", "left").where(death | F.col("__known"))
    once = tagged.select(*player, "phase", F.when(~death, F.col("item_id")).alias("item_id"), F.when(~death, F.col(time)).alias(time), "kind").distinct()
    counted = once.groupBy(*player, "phase", "item_id").agg(
        (F.count_if(F.col("kind") == "equip") - F.count_if(F.col("kind") == "unequip")).alias("diff"), F.max(death).alias("died"))
    rows = running_sum(counted.repartition(*player), [*player, "item_id"], "phase", ["diff"])
    of_item = F.col("item_id").isNotNull()
    held = rows.groupBy(*player, "phase").agg(
        F.sort_array(F.collect_set(F.when(of_item & (F.col("diff") == 1), F.col("item_id")))).alias("held"),
        F.sort_array(F.collect_set(F.when(of_item & (F.col("diff") == 0), F.col("item_id")))).alias("released"),
        F.max(of_item).alias("logged"), F.max("died").alias("died"))
    before = F.lag("held").over(Window.partitionBy(*player, "logged").orderBy("phase"))  # the last logged phase, deaths aside
    kept = F.coalesce(F.array_except(before, F.col("released")), F.array().cast("array<string>"))
    carried = F.array_sort(F.when(F.size("held") == cap, F.col("held")).otherwise(F.array_distinct(F.concat("held", kept))))
    step = F.when(F.col("logged") & (F.size("items") > 0), F.struct("phase", "items"))
    folded = held.withColumn("items", carried).groupBy(*player).agg(
        F.sort_array(F.collect_list(step)).alias("steps"), F.max(F.when(F.col("died"), F.col("phase"))).alias("end_phase"))
    all_phases = F.array(*[F.lit(str(p)).cast(PHASE) for p in grid])
    first = F.col("steps")[0]["phase"]
    lasting = folded.where((F.size("steps") > 0) & F.col("end_phase").isNotNull()).withColumn("first_phase", first)
    spread = lasting.withColumn("phase", F.explode(F.filter(all_phases, lambda p: (p >= F.col("first_phase")) & (p <= F.col("end_phase")))))
    latest = F.element_at(F.filter("steps", lambda s: s["phase"] <= F.col("phase")), -1)["items"]
    return spread.select(*player, "end_phase", "phase", "first_phase", latest.alias("items"))


def explode_count(filled: DataFrame, per: Sequence[str], attrs: DataFrame, on: Sequence[str], by: Sequence[str],
                  col: str = "items") -> DataFrame:
    """Players per item within ``per``, then summed over the attributes joined by ``on``."""
    counted = filled.withColumn("item_id", F.explode(col)).groupBy(*per, "item_id").agg(F.count(F.lit(1)).alias("players"))
    return counted.join(attrs, list(on)).groupBy(*by, "item_id").agg(F.sum("players").alias("players"))
