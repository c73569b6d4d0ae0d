import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import cohort, kpi, segment, sequence, state
from tallyforge.operators.quantile import exact_percentiles, percentile_tiers
from tests.conftest import rows

BUYS = "account_id string, date date, time timestamp_ntz, product_id string, product_name string, qty bigint, free_use bigint, paid_use bigint, transaction_id bigint"


def buy(user, time, name, free=0, paid=10, txn=1, qty=1):
    return (user, time[:10], time, name, name, qty, free, paid, txn)


# -- quantiles ---------------------------------------------------------------
@pytest.mark.parametrize("seed", range(4))
def test_exact_percentiles_equal_the_builtin(spark, seed):
    rnd = random.Random(seed)
    scale = [3, 1000, 10**7, 10**13][seed]
    values = [rnd.randint(-scale, scale) for _ in range(rnd.choice([1, 2, 37, 500]))] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    probs = {"a": 0.0, "b": 0.2, "c": 0.5, "d": 0.95, "e": 1.0}
    got = exact_percentiles(df, "v", probs).first()
    want = df.select(*[F.expr(f"percentile(v, {p})").alias(n) for n, p in probs.items()]).first()
    assert list(got) == pytest.approx(list(want), rel=1e-12)


@pytest.mark.parametrize("values", [(-2**63, 2**63 - 1), (-2**47 - 5, 1, 2, 3), (2**47, 2**47 + 1, -2**48 - 2**47, 0), (2**50,), (-2**63, -2**63, 5)])
def test_percentiles_of_any_64_bits(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = exact_percentiles(df, "v", {"a": 0.0, "b": 0.5, "c": 1.0}).first()
    v = sorted(values)
    middle = (float(v[(len(v) - 1) // 2]) + float(v[len(v) // 2])) / 2
    assert list(got) == [float(v[0]), pytest.approx(middle), float(v[-1])]


@pytest.mark.parametrize("sketch, margin, most", [(8, 0.0, 4_000_000), (8, 0.001, 4_000_000), (16, 0.02, 5), (4096, None, 4_000_000)])
def test_percentiles_of_values_that_fool_the_sketch(spark, sketch, margin, most):
    """Too small a sketch or bracket, nearly all values alike, gaps, and brackets that hold too much at first."""
    from tallyforge.operators.quantile import exact_values

    shapes = {"powers": "shiftleft(1L, CAST(id % 62 AS INT))"} if margin == 0.001 else {"alike": "CASE WHEN id % 997 = 0 THEN id * id ELSE 5 END", "gap": "CASE WHEN id < 1499 THEN id - 4000000000000 ELSE id * 4000000000 END"}
    for shape in shapes.values():
        values = spark.range(3000, numPartitions=6).selectExpr(f"{shape} AS value")
        want = sorted(r.value for r in values.collect())
        ranks = [0, 1, 599, 600, 1498, 1499, 1500, 2849, 2999]
        n, found = exact_values(values, [k / 2999 for k in ranks], sketch, margin, most)
        assert n == 3000 and set(found) >= set(ranks) and found == {k: want[k] for k in found}, shape


def test_percentile_passes_are_small(spark):
    """The ranks' pass groups by region and inside value only, in one aggregate and one run over its result."""
    from tallyforge.operators import quantile

    df = spark.range(10_000).selectExpr("id * 7 AS v")
    plans = []
    real = quantile._ranked

    def watched(values, brackets, ranks):
        assert len(brackets) <= 2 and values.columns == ["value"] and values.where("value between -1 and 1").count() == 1
        plans.append(values._jdf.queryExecution().executedPlan().toString())
        return real(values, brackets, ranks)

    quantile._ranked = watched
    try:
        out = exact_percentiles(df, "v", {"a": 0.25, "b": 0.9})
    finally:
        quantile._ranked = real
    assert list(out.first()) == pytest.approx([17498.25, 62993.7]) and len(plans) == 1 and "Exchange" not in plans[0]
    assert "Scan parquet" not in out._jdf.queryExecution().executedPlan().toString()


def test_percentiles_of_nothing(spark):
    assert list(exact_percentiles(spark.createDataFrame([(None,)], "v bigint"), "v", {"a": 0.5}).first()) == [None]


def test_spend_at_a_percentile_is_in_the_lower_tier(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 12)], "v bigint")
    out = percentile_tiers(df, "v", {"p20": 0.2, "p50": 0.5})
    assert [r[1] for r in sorted(out.collect())] == ["<=20"] * 3 + ["<=50"] * 3 + [">50"] * 5


# -- key figures -------------------------------------------------------------
def test_no_active_users_gives_null_ratio(frame):
    out = kpi.with_ratios(frame("au bigint, pu bigint, paid_pu bigint, total_use bigint", (0, 0, 0, 0), (4, 2, 1, 10)))
    assert rows(out, "pur", "paid_pur", "arpu", "arppu") == [(0.5, 0.25, 2.5, 5.0), (None, None, None, None)]


def test_zero_amount_is_spend(frame):
    df = frame("account_id string, amount bigint", ("a", 0), ("a", 5), ("b", -2))
    assert rows(kpi.sign_split(df, "amount", []), "side", "users", "amount") == [("+", 1, 5), ("-", 2, -2)]


def test_day_without_levelup_is_null(frame):
    df = frame("account_id string, date date, status string, levelup_xp bigint", ("a", "2020-01-01", "pass", 0), ("a", "2020-01-02", "pass", 5))
    assert rows(kpi.levelup_by_day(df), "date", "levelups", "levelup_rate") == [("2020-01-01", None, None), ("2020-01-02", 1, 1.0)]


def test_click_label_without_item(frame):
    from tallyforge.functions.columns import part_after

    clicks = frame("date date, action string, label string", ("2020-01-01", "detail", "x.i"), ("2020-01-01", "buy", "x.i"), ("2020-01-01", "buy", "home"))
    clicks = clicks.withColumn("item_id", part_after("label"))
    items = frame("item_id string, product_name string", ("i", "I"))
    assert rows(kpi.ctr(clicks, items, ["product_name"])) == [("2020-01-01", "I", 1, 1, 1.0)]


def test_two_stage_users_are_summed(frame):
    users = frame("account_id string, date date, platform string", ("a", "2020-01-01", "x"), ("a", "2020-01-01", "y"))
    buys = frame("account_id string, date date", ("a", "2020-01-01"))
    assert rows(kpi.two_stage_kpi(users, buys, ["date", "platform"], ["date"])) == [("2020-01-01", 2, 1, 0.5)]


def test_kpi_keeps_segments_without_sales(frame):
    users = frame("account_id string, region string", ("a", "N"), ("b", "S"))
    buys = frame(BUYS, buy("a", "2020-01-01 01:00:00", "p"))
    assert rows(kpi.kpi_by(users, buys, ["region"]), "region", "au", "pu", "total_use", "pur") == [("N", 1, 1, 10, 1.0), ("S", 1, 0, 0, 0.0)]


def test_top_n_ties_by_id(frame):
    buys = frame(BUYS, buy("a", "2020-01-01 01:00:00", "q"), buy("a", "2020-01-01 02:00:00", "p"), buy("a", "2020-01-01 02:00:00", "r"))
    products = frame("product_id string, product_name string, event_name string", ("p", "P", "e"), ("q", "Q", "e"), ("r", "R", "e"))
    assert rows(kpi.rank_in_day(buys, products, 2), "product_id", "rank") == [("p", 1), ("q", 2)]


# -- cohorts -----------------------------------------------------------------
def test_first_order_classes(frame):
    a = frame("account_id string, date date", ("a", "2020-01-01"), ("b", "2020-01-01"), ("c", "2020-01-02"), ("e", "2020-01-01"))
    b = frame("account_id string, date date", ("a", "2020-01-02"), ("b", "2020-01-01"), ("c", "2020-01-01"), ("d", "2020-01-01"))
    assert rows(cohort.first_order(a, b)) == [(k, 1) for k in "abcde"]


def test_after_means_strictly_after_the_first(frame):
    a = frame("account_id string, time timestamp_ntz", ("u", "2020-01-01 05:00:00"), ("u", "2020-01-03"))
    b = frame("account_id string, time timestamp_ntz", ("u", "2020-01-01 05:00:00"), ("u", "2020-01-01 05:00:01"), ("v", "2020-01-09"))
    assert rows(cohort.b_after_a(a, b)) == [("u", "2020-01-01 05:00:01")]


def test_first_event_keeps_ties(frame):
    df = frame("account_id string, time timestamp_ntz, reason string", ("u", "2020-01-01", "x"), ("u", "2020-01-01", "buy"), ("v", "2020-01-01", "x"), ("v", "2020-01-02", "buy"))
    assert rows(cohort.first_event(df, "buy"), "account_id") == [("u",)]


def test_sides_and_split(frame):
    df = frame("account_id string, time timestamp_ntz, n bigint", ("u", "2020-01-01 09:00:00", 1), ("u", "2020-01-02", 2), ("v", "2020-01-02", 4), ("w", "2019-01-01", 8))
    assert rows(cohort.both_sides(df, "2020-01-01 09:00:00"), "account_id", "sides") == [("u", 2), ("v", 1), ("w", 1)]
    split = cohort.split_amount(df, "2020-01-01 09:00:00", "n")
    assert rows(split) == [("u", 1, 2), ("v", None, 4), ("w", 8, None)]
    assert rows(cohort.only_after(split), "account_id") == [("v",)]


def test_participation_codes(frame):
    ids = lambda *u: frame("account_id string", *[(x,) for x in u])
    out = cohort.participation([(ids("a", "a", "d", "e", "g"), 1), (ids("b", "d", "f", "g"), 3), (ids("c", "e", "f", "g"), 5)])
    assert rows(out) == [(c, 1) for c in (1, 3, 4, 5, 6, 8, 9)]


def test_funnel_counts_order(frame):
    ev = frame("account_id string, time timestamp_ntz, e string", ("u", "2020-01-01", "s"), ("u", "2020-01-02", "c"), ("v", "2020-01-02", "s"), ("v", "2020-01-01", "c"), ("w", "2020-01-01", "s"))
    firsts = cohort.first_times(ev, {"s": F.col("e") == "s", "c": F.col("e") == "c"})
    assert rows(cohort.funnel(firsts, ["s", "c"])) == [(1, "s", 3, 3), (2, "c", 2, 1)]


# -- sequences ---------------------------------------------------------------
def test_basket_ignores_order_and_path_does_not(frame):
    buys = frame(BUYS, buy("u", "2020-01-01 01:00:00", "a"), buy("u", "2020-01-01 02:00:00", "b"), buy("v", "2020-01-01 01:00:00", "b"), buy("v", "2020-01-01 02:00:00", "a"))
    assert rows(sequence.baskets(buys)) == [("u", 2, 2, "a"), ("u", 2, 2, "b")]
    assert rows(sequence.purchase_path(buys)) == [("u", 1, 2, 1, "a"), ("u", 1, 2, 2, "b"), ("v", 1, 2, 1, "b"), ("v", 1, 2, 2, "a")]


def test_one_instant_is_ordered_by_id(frame):
    buys = frame(BUYS, buy("u", "2020-01-01 01:00:00", "z", txn=1), buy("u", "2020-01-01 01:00:00", "a", txn=2))
    assert rows(sequence.purchase_path(buys), "position", "product_name") == [(1, "z"), (2, "a")]


def test_groups_of_paths_and_baskets_are_exact(frame):
    rnd = random.Random(5)
    data = [buy(f"u{u:02d}", f"2020-01-0{1 + i // 3} 0{i % 3}:00:00", "xyz"[(i * (u % 4)) % 3], txn=i) for u in range(12) for i in range(6)]
    paths, sets = {}, {}
    for u in {d[0] for d in data}:
        mine = [d for d in sorted(data, key=lambda d: d[2]) if d[0] == u]
        item = [x for x in mine[0] if x in ("x", "y", "z")] and mine[0].index([x for x in mine[0] if x in ("x", "y", "z")][0])
        paths.setdefault(tuple(d[item] for d in mine), []).append(u)
        sets.setdefault(frozenset(d[item] for d in mine), []).append(u)
    rnd.shuffle(data)
    buys = frame(BUYS, *data)
    assert rows(sequence.purchase_path(buys), "account_id", "users", "steps", "position", "product_name") == sorted(
        (min(us), len(us), len(p), i + 1, x) for p, us in paths.items() for i, x in enumerate(p))
    assert rows(sequence.baskets(buys), "account_id", "users", "items", "product_name") == sorted((min(us), len(us), len(b), x) for b, us in sets.items() for x in b)


def test_positions_number_every_row_once(frame):
    data = [buy("u", f"2020-01-0{1 + i % 3} {i % 5:02d}:{i:02d}:00", str(i), txn=i) for i in range(40)]
    got = sequence.positions(frame(BUYS, *data), "account_id", "time", ["transaction_id"])
    ordered = [r[0] for r in got.orderBy("position").select("transaction_id").collect()]
    assert ordered == [d[-1] for d in sorted(data, key=lambda d: (d[2], d[-1]))]
    assert sorted(r[0] for r in got.select("position").collect()) == list(range(1, 41))


def test_nth_active_day(frame):
    logins = frame("account_id string, date date", ("u", "2020-01-01"), ("u", "2020-01-01"), ("u", "2020-01-03"), ("u", "2020-01-05"))
    dates = frame("account_id string, date date", ("u", "2020-01-03"), ("u", "2020-01-04"), ("v", "2020-01-01"))
    assert rows(sequence.nth_active_day(logins, dates)) == [("u", "2020-01-03", 2), ("u", "2020-01-04", None), ("v", "2020-01-01", None)]
    starts = frame("account_id string, start_day date", ("u", "2020-01-02"))
    assert rows(sequence.nth_active_day(logins, dates.where("account_id = 'u'"), starts)) == [("u", "2020-01-03", 1), ("u", "2020-01-04", None)]


def test_owned_combo_keeps_repeats(frame):
    assert rows(sequence.owned_combo(frame("account_id string, model string", ("u", "b"), ("u", "a"), ("u", "a")))) == [("a,a,b", 1)]


# -- segments ----------------------------------------------------------------
def campaign(frame):
    return frame(BUYS, buy("p1", "2020-01-01 01:00:00", "pass"), buy("p3", "2020-01-01 01:00:00", "pass"), buy("p3", "2020-01-01 01:00:00", "car"),
                 buy("p2", "2020-01-01 01:00:00", "pass"), buy("p2", "2020-01-01 01:00:00", "level", qty=4), buy("m2", "2020-01-01 01:00:00", "car"))


def test_exclusive_segments(frame):
    is_pass, is_product, is_level = (F.col("product_id") == p for p in ("pass", "car", "level"))
    out = segment.exclusive_segments(campaign(frame), is_pass, is_product,
                                     measures=segment.typed_measures(is_pass, is_product, is_level, F.lit(False)))
    assert rows(out, "account_id", "segment", "level_ups", "pass_use") == [
        ("m2", "M-2", None, None), ("p1", "P-1", None, 10), ("p2", "P-2", 4, 10), ("p3", "P-3", None, 10)]
    assert rows(segment.partition_check(out, campaign(frame))) == [(4, 4, 0, 0)]


def test_free_segment_keeps_one_row_per_source(frame):
    ids = lambda *u: frame("account_id string", *[(x,) for x in u])
    out = segment.free_segment({"a": ids("x", "x", "y"), "b": ids("x", "z")}, ids("y"), ids("z"))
    assert rows(out) == [("x", "a", "M-1"), ("x", "b", "M-1")]


def test_owner_groups_and_override(frame):
    owned = segment.acquisitions(frame("account_id string, m string, date date", ("u", "white", "2020-01-02"), ("u", "white", "2020-01-01"), ("v", "white", "2020-01-01"),
                                       ("v", "yellow", "2020-01-03"), ("w", None, "2020-01-01")), F.col("m"))
    assert rows(owned) == [("u", "white", "2020-01-01"), ("v", "white", "2020-01-01"), ("v", "yellow", "2020-01-03")]
    assert rows(segment.owner_groups(owned, {"white": "SW", "yellow": "EY"}), "account_id", "owner_group") == [("u", "SW"), ("v", "TM")]
    assert rows(segment.override_both(owned, ["white", "yellow"]), "account_id", "model") == [("u", "white"), ("v", "both"), ("v", "both")]


def test_combined_profiles(frame):
    segs = [frame("account_id string, segment string, total_use bigint", ("a", "P-1", 5)), frame("account_id string, segment string", ("b", "M-1"))]
    owners = frame("account_id string, owner_group string", ("a", "SW"), ("c", "EY"))
    out = segment.combine_profiles(segs, owners, earlier=frame("account_id string, tier string", ("b", "A")))
    assert rows(out, "account_id", "segment", "owner_group", "total_use", "pre_tier") == [
        ("a", "P-1", "SW", 5, None), ("b", "M-1", "N", None, "A"), ("c", None, "EY", None, None)]


def test_null_reason_is_dropped_with_the_excluded(frame):
    log = frame("account_id string, reason_detail string, amount bigint", ("u", None, 5), ("u", "test", 7), ("u", "real", 1), ("u", "real", -9))
    assert rows(segment.gains(log, ["test"])) == [("u", 1)]


def test_one_null_count_nulls_the_row(frame):
    df = frame("account_id string, date date, a bigint, b bigint", ("u", "2020-01-01", 1, None), ("u", "2020-01-01", 2, 3))
    assert rows(segment.play_profile(df, ["a", "b"], ["a"])) == [("u", 1, 5, 3)]


def test_main_category_tie(frame):
    df = frame("account_id string, c string, free_use bigint, paid_use bigint", ("u", "b", 0, 5), ("u", "a", 5, 0), ("u", "z", 1, 1))
    assert rows(segment.main_category(df, "c")) == [("u", "a", 5)]


def test_spend_tier_edges(frame):
    df = frame("account_id string, free_use bigint, paid_use bigint", *[(str(v), 0, v) for v in (0, 2000, 2001, 10000, 20000, 40000, 40001)])
    assert rows(segment.spend_tiers(df), "total_use", "tier") == sorted(
        [(0, "A"), (2000, "A"), (2001, "B"), (10000, "B"), (20000, "C"), (40000, "D"), (40001, "E")], key=lambda r: str(r[0]))


# -- state -------------------------------------------------------------------
PLAYER = ["session_id", "account_id"]
LOG = "session_id string, account_id string, time timestamp_ntz, phase decimal(3,1), item_id string, kind string"


def held(frame, *rows_):
    from decimal import Decimal

    return frame("session_id string, account_id string, phase decimal(3,1), held array<string>, released array<string>",
                 *[("s", "u", Decimal(p), h, r) for p, h, r in rows_])


def test_carry_over_looks_one_phase_back(frame):
    df = held(frame, ("1.0", ["a", "b"], []), ("2.0", ["c"], ["a"]), ("3.0", [], []), ("4.0", ["x", "y"], []), ("5.0", [], ["x", "y"]))
    got = state.carry_over(df, PLAYER, "phase")
    assert rows(got, "phase", "items") == [(1.0, ["a", "b"]), (2.0, ["b", "c"]), (3.0, ["c"]), (4.0, ["x", "y"])]


def test_gap_is_filled_and_the_unrecorded_are_absent(frame):
    from decimal import Decimal as D

    log = frame(LOG, ("s", "u", "2020-01-01 00:00:01", D("1.0"), "a", "equip"), ("s", "u", "2020-01-01 00:00:01", D("1.0"), "a", "equip"),
                ("s", "u", "2020-01-01 00:00:09", D("2.5"), "a", "unequip"), ("s", "u", "2020-01-01 00:00:09", D("2.5"), "b", "equip"),
                ("s", "v", "2020-01-01 00:00:01", D("1.0"), "a", "equip"))
    counts = state.counts_by_type(log, [*PLAYER, "phase", "item_id"], {"e": "equip", "q": "unequip"})
    run = state.running_sum(counts, [*PLAYER, "item_id"], "phase", ["e", "q"])
    kept = state.carry_over(state.held_sets(run, [*PLAYER, "phase"], "item_id", F.col("e") - F.col("q")), PLAYER, "phase")
    ends = frame("session_id string, account_id string, end_phase decimal(3,1)", ("s", "u", D("3.0")))
    grid = state.from_first(state.phase_grid(ends, state.phases()), kept, PLAYER)
    filled = state.gap_fill(grid, kept, PLAYER, "phase", "items")
    assert rows(filled, "account_id", "phase", "items") == [
        ("u", 1.0, ["a"]), ("u", 1.5, ["a"]), ("u", 2.0, ["a"]), ("u", 2.5, ["b"]), ("u", 3.0, ["b"])]


def test_phase_grid_values():
    assert [float(p) for p in state.phases()][:3] == [0.1, 1.0, 1.5] and float(state.phases()[-1]) == 8.5 and len(state.phases()) == 17


# -- rows summed per person before they meet attributes ------------------------
def test_attributes_join_after_the_sum(spark, frame):
    from tallyforge.operators.levels import people_and_sums

    df = frame("account_id string, side string, amount bigint", *[("hot", "a", 1)] * 50, ("u", "a", 2), ("u", "b", 3), ("x", "a", 4), (None, "a", 5))
    attrs = frame("account_id string, region string", ("hot", "E"), ("u", "W"), ("u", "E"))
    got = people_and_sums(df, "account_id", ["side", "region"], {"users": True}, {"amount": "amount"}, rows="n", attrs=attrs)
    assert rows(got, "side", "region", "users", "amount", "n") == [
        ("a", "E", 2, 52, 51), ("a", "W", 1, 2, 1), ("a", None, 1, 9, 2), ("b", "E", 1, 3, 1), ("b", "W", 1, 3, 1)]
    inner = people_and_sums(df, "account_id", ["region"], {"users": True}, attrs=attrs, how="inner")
    assert rows(inner) == [("E", 2), ("W", 1)]
    semi = people_and_sums(df, "account_id", ["side"], {"users": True}, attrs=attrs.select("account_id").distinct(), how="left_semi")
    assert rows(semi) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize("name", ["sign_split_by_segment", "coupon_flow", "votes_by_day", "arppu_by_membership", "two_stage_kpi_by_day", "retained_users_buy"])
def test_no_raw_fact_reaches_a_join_with_users(spark, name):
    """Below each side of a join by account stands an aggregate or a table of one row per account."""
    from tallyforge.plans import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for i, line in enumerate(lines):
        if "Join" in line and "account_id" in line:
            first = next(x for x in lines[i + 1:] if not x.lstrip(" :+-").startswith(("Project", "Filter")))
            assert "Aggregate" in first, (name, first)
    assert depth


def test_spread_join_equals_a_plain_one(frame):
    from tallyforge.operators import joins

    facts = frame("k string, n bigint", *[("hot", i) for i in range(40)], ("u", 1), ("v", 2), (None, 3))
    one = frame("k string, x bigint", ("hot", 7), ("u", 8))
    for how in ("inner", "left"):
        assert rows(joins.spread_join(facts, one, ["k"], how=how), "k", "n", "x") == rows(facts.join(one, "k", how), "k", "n", "x")


def test_did_without(frame):
    firsts = frame("account_id string, a bigint, b bigint, c bigint", ("u", 1, 5, None), ("v", 1, 5, 9), ("w", 1, None, None))
    assert rows(cohort.did_without(firsts, ["a", "b"], ["c"]), "account_id", "done") == [("u", 5)]


def test_live_campaign_by_device_and_second_range(frame):
    from tallyforge.operators import joins

    calendar = frame("name string, device string, start_date date, end_date date, tab_start date, tab_end date",
                     ("x", "pc", "2020-01-01", "2020-01-05", "2019-12-01", "2019-12-31"), ("y", "tv", "2020-01-01", "2020-01-09", None, None))
    more = [("tab_start", "tab_end")]
    assert rows(joins.live_campaign(calendar, "2019-12-15", device="pc", more=more), "name") == [("x",)]
    assert rows(joins.live_campaign(calendar, "2019-12-15", device="pc")) == []
    assert rows(joins.live_campaign(calendar, "2020-01-08", device="pc", more=more)) == []
    assert rows(joins.live_campaign(calendar, "2020-01-08", device="tv", more=more), "name") == [("y",)]


def test_rank_all_equals_a_window(spark):
    from pyspark.sql import Window

    from tallyforge.operators.levels import rank_all

    rows_in = [("hot", i * 7919 % 1000, i) for i in range(900)] + [(None, 5, i) for i in range(40)] + [(f"g{i % 9}", i, i) for i in range(60)]
    df = spark.createDataFrame(rows_in, "g string, v bigint, id bigint").repartition(5)
    order = [F.desc("v"), F.asc("id")]
    got = rank_all(df, ["g"], order, parts=7)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") and all("__part" in line for line in plan.splitlines() if "Window [" in line or "Window(" in line)
    assert rank_all(df.limit(0), ["g"], order).collect() == []


def test_a_hot_group_is_ranked_by_several_tasks(spark):
    df = spark.range(20_000).selectExpr("'hot' AS g", "id * 7919 % 20011 AS v")
    dealt = df.repartitionByRange(8, F.col("g"), F.desc("v")).groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 20_000 / 3


def test_player_phases_reads_the_log_once(frame):
    from tallyforge.operators import state

    import re

    log = frame("s string, a string, time timestamp_ntz, phase string, item_id string, kind string",
                ("s", "a", "2020-01-01 00:00:01", "1.0", "x", "equip"), ("s", "a", "2020-01-01 00:00:01", "1.0", "x", "equip"),
                ("s", "a", "2020-01-01 00:00:02", "1.5", "y", "equip"), ("s", "a", "2020-01-01 00:00:03", "2.5", "x", "unequip"),
                ("s", "a", "2020-01-01 00:00:04", "3.0", None, "death"), ("s", "a", "2020-01-01 00:00:04", "0.1", "odd", "equip"),
                ("s", "none", "2020-01-01", "1.0", "x", "equip"), ("s", "late", "2020-01-01", "1.0", "q", "death"), ("s", "late", "2020-01-01", "2.0", "x", "equip")).withColumn("phase", F.col("phase").cast(state.PHASE))
    items = frame("item_id string", ("x",), ("y",))
    out = state.player_phases(log, items, state.phases(4.0), ["s", "a"])
    assert rows(out, "a", "phase", "items") == [("a", 1.0, ["x"]), ("a", 1.5, ["x", "y"]), ("a", 2.0, ["x", "y"]), ("a", 2.5, ["y"]), ("a", 3.0, ["y"])]
    assert rows(state.player_phases(log.limit(0), items, state.phases(4.0), ["s", "a"])) == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(s#\d+, a#\d+, \d+\)", plan)) == 1 and plan.count("kind#") and "SortMergeJoin [s#" not in plan
