"""Registered steps of the held-items-per-phase mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import state
from tallyforge.plans.registry import query

# The grid covers the 31 days of a month in the model, one phase each.
GRID = state.phases(15.5)
PLAYER = ["session_id", "account_id"]
GRID_SQL = ", ".join(str(p) for p in GRID)


def _items(t):
    """Item dimension: name, category, and one item kind that is left out."""
    ids = t.table("part").selectExpr("'w' || CAST(p_size % 5 AS STRING) AS item_id").distinct()
    return ids.where("item_id <> 'w4'").select(
        "item_id", F.upper("item_id").alias("item_name"),
        F.when(F.col("item_id") < "w2", "rifle").otherwise("sniper").alias("category"))


BASE = """
, items AS (SELECT item_id, upper(item_id) AS item_name, CASE WHEN item_id < 'w2' THEN 'rifle' ELSE 'sniper' END AS category
  FROM (SELECT DISTINCT 'w' || CAST(p_size % 5 AS VARCHAR) AS item_id FROM part) WHERE item_id <> 'w4'),
ev AS (SELECT p.* FROM phase_log p JOIN items USING (item_id) WHERE kind IN ('equip', 'unequip')),
cnt AS (SELECT session_id, account_id, phase, item_id, count(CASE WHEN kind = 'equip' THEN 1 END) AS equips,
  count(CASE WHEN kind = 'unequip' THEN 1 END) AS unequips FROM (SELECT DISTINCT session_id, account_id, phase, item_id, time, kind FROM ev) GROUP BY 1, 2, 3, 4),
run AS (SELECT session_id, account_id, phase, item_id,
  CAST(sum(equips) OVER w AS BIGINT) AS equips, CAST(sum(unequips) OVER w AS BIGINT) AS unequips FROM cnt
  WINDOW w AS (PARTITION BY session_id, account_id, item_id ORDER BY phase ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
held AS (SELECT session_id, account_id, phase,
  coalesce(list(item_id ORDER BY item_id) FILTER (WHERE equips - unequips = 1), []) AS held,
  coalesce(list(item_id ORDER BY item_id) FILTER (WHERE equips - unequips = 0), []) AS released FROM run GROUP BY 1, 2, 3),
lagged AS (SELECT *, lag(held) OVER (PARTITION BY session_id, account_id ORDER BY phase) AS before FROM held),
carried AS (SELECT session_id, account_id, phase, list_sort(CASE WHEN len(held) = 2 THEN held
    ELSE list_distinct(list_concat(held, coalesce(list_filter(before, lambda x: NOT list_contains(released, x)), []))) END) AS items FROM lagged),
kept AS (SELECT * FROM carried WHERE len(items) > 0),
ends AS (SELECT session_id, account_id, max(phase) AS end_phase FROM phase_log WHERE kind = 'death' GROUP BY 1, 2),
grid AS (SELECT session_id, account_id, end_phase, CAST(p AS DECIMAL(3,1)) AS phase FROM ends, unnest([""" + GRID_SQL + """]) g(p) WHERE p <= end_phase),
firsts AS (SELECT session_id, account_id, min(phase) AS first_phase FROM kept GROUP BY 1, 2),
started AS (SELECT grid.*, first_phase FROM grid JOIN firsts USING (session_id, account_id) WHERE phase >= first_phase),
filled AS (SELECT session_id, account_id, end_phase, phase, first_phase,
  last_value(items IGNORE NULLS) OVER (PARTITION BY session_id, account_id ORDER BY phase ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS items
  FROM started LEFT JOIN kept USING (session_id, account_id, phase))
"""


def _plain(df):
    """Phases as doubles in the result; they stay decimals while they are keys."""
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c.endswith("phase")})


def _sql(frame: str, *phases: str) -> str:
    cast = ", ".join(f"CAST({p} AS DOUBLE) AS {p}" for p in phases or ("phase",))
    return BASE + f"SELECT * REPLACE ({cast}) FROM {frame}"


def _events(t):
    return state.tagged_events(t.phase_log, _items(t))


def _counts(t):
    return state.counts_by_type(_events(t), [*PLAYER, "phase", "item_id"], {"equips": "equip", "unequips": "unequip"})


def _running(t):
    return state.running_sum(_counts(t), [*PLAYER, "item_id"], "phase", ["equips", "unequips"])


def _held(t):
    return state.held_sets(_running(t), [*PLAYER, "phase"], "item_id", F.col("equips") - F.col("unequips"))


def _kept(t):
    return state.carry_over(_held(t), PLAYER, "phase")


def _grid(t):
    ends = t.phase_log.where("kind = 'death'").groupBy(*PLAYER).agg(F.max("phase").alias("end_phase"))
    return state.phase_grid(ends, GRID)


def _started(t, kept):
    return state.from_first(_grid(t), kept, PLAYER)


def _filled(t):
    kept = _kept(t)
    return state.gap_fill(_started(t, kept), kept, PLAYER, "phase", "items")


@query("phase_events", BASE + "SELECT item_id, kind, CAST(phase AS DOUBLE) AS phase, count(*) AS events FROM ev GROUP BY 1, 2, 3")
def phase_events(t):
    return _plain(_events(t).groupBy("item_id", "kind", "phase").agg(F.count(F.lit(1)).alias("events")))


@query("phase_counts", _sql("cnt"))
def phase_counts(t):
    return _plain(_counts(t))


@query("running_state", _sql("run"))
def running_state(t):
    return _plain(_running(t))


@query("held_sets", _sql("held"))
def held_sets(t):
    return _plain(_held(t))


@query("carry_over", _sql("kept"))
def carry_over(t):
    return _plain(_kept(t))


@query("phase_grid", _sql("grid", "phase", "end_phase"))
def phase_grid(t):
    return _plain(_grid(t))


@query("phase_grid_from_first", _sql("started", "phase", "end_phase", "first_phase"))
def phase_grid_from_first(t):
    return _plain(_started(t, _kept(t)))


@query("gap_fill", _sql("filled", "phase", "end_phase", "first_phase"))
def gap_fill(t):
    return _plain(_filled(t))


@query("player_phases", _sql("filled", "phase", "end_phase", "first_phase"))
def player_phases(t):
    """The whole chain as one fold per player."""
    return _plain(state.player_phases(t.phase_log, _items(t), GRID, PLAYER))


@query("held_by_phase", BASE + """
, x AS (SELECT session_id, phase, unnest(items) AS item_id FROM filled),
c AS (SELECT session_id, phase, item_id, count(*) AS players FROM x GROUP BY 1, 2, 3)
SELECT region, membership, CAST(phase AS DOUBLE) AS phase, c.item_id, item_name, category, CAST(sum(players) AS BIGINT) AS players
FROM c JOIN users ON session_id = users.account_id JOIN items ON c.item_id = items.item_id GROUP BY 1, 2, 3, 4, 5, 6""")
def held_by_phase(t):
    attrs = t.users.select(F.col("account_id").alias("session_id"), "region", "membership")
    filled = state.player_phases(t.phase_log, _items(t), GRID, PLAYER)
    counted = state.explode_count(filled, ["session_id", "phase"], attrs, ["session_id"], ["region", "membership", "phase"])
    return _plain(counted.join(_items(t), "item_id"))
