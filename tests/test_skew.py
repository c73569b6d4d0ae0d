"""Joins with heavy keys: same rows as plain joins, and no group that holds a heavy key whole."""

import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import joins, skew
from tests.conftest import rows


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


FACTS = "id bigint, platform string, product_id string, sales_id string, time timestamp_ntz"
OFFERS = "platform string, product_id string, offer_id string, start_time timestamp_ntz, list_price bigint"


def sales(frame, n=3000):
    rng = random.Random(8)
    made = []
    for i in range(n):
        product = "hot" if i % 3 == 0 else None if i % 17 == 0 else f"p{rng.randrange(40)}"
        day = None if i % 29 == 0 else f"20{rng.randrange(18, 23)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d} {rng.randrange(24):02d}:30:00"
        made.append((i, "x" if i % 4 else "y", product, rng.choice([None, None, "offer.hot2", f"p{rng.randrange(40)}1", "odd"]), day))
    return frame(FACTS, *made)


def offers(frame):
    made = []
    for platform in "xy":
        made += [(platform, "hot", f"hot{v}", f"20{17 + v}-03-0{v}", 10 + v) for v in range(1, 6)]
        for p in range(0, 40, 2):
            made += [(platform, f"p{p}", f"p{p}{v}", f"2019-0{v}-01", p) for v in range(1, 1 + p % 3 + 1)]
    return frame(OFFERS, *made)


def test_heavy_keys_of_a_skewed_frame(frame):
    facts = frame("k string, n bigint", *[("hot", i) for i in range(400)], *[(None, i) for i in range(90)], *[(f"u{i}", i) for i in range(710)])
    got = {r["__key"]: r["__parts"] for r in skew.heavy_keys(facts, ["k"], 1 / 20).collect()}
    names = {r.k: r.h for r in facts.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert got == {names["hot"]: 7, names[None]: 2}
    assert skew.heavy_keys(facts.limit(0), ["k"]).collect() == [] and skew.heavy_keys(facts.where("k like 'u%'"), ["k"], 1 / 20).collect() == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_split_join_equals_a_plain_one(frame, no_broadcast, how):
    facts = frame("k string, d int, n bigint", *[("hot", i % 2, i) for i in range(400)], *[("hot", 1, 7)] * 3, ("u", 1, 1), ("v", 2, 2), (None, 1, 3))
    one = frame("k string, d int, x bigint", ("hot", 1, 7), ("u", 1, 8), (None, 1, 9), ("w", 3, 3))
    got = skew.split_join(facts, one, ["k", "d"], how)
    assert rows(got, *sorted(got.columns)) == rows(facts.join(one, ["k", "d"], how), *sorted(got.columns))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__part" in plan and "Cartesian" not in plan


def test_sliced_scd2_join_equals_a_plain_one(frame, no_broadcast):
    facts, dim = sales(frame), offers(frame)
    plain = joins.scd2_join(facts, dim, ["platform", "product_id"], slice_it=False)
    got = joins.scd2_join(facts, dim, ["platform", "product_id"])
    assert got.columns == plain.columns and rows(got, "id", "offer_id", "list_price") == rows(plain, "id", "offer_id", "list_price")
    assert len(rows(got)) == 3000


def test_sliced_either_key_join_equals_a_plain_one(frame, no_broadcast):
    facts, dim = sales(frame), offers(frame)
    args = (facts, dim, "sales_id", "offer_id", ["platform"], "product_id")
    plain, got = joins.either_key_join(*args, slice_it=False), joins.either_key_join(*args)
    assert got.columns == plain.columns and rows(got, "id", "offer_id", "list_price") == rows(plain, "id", "offer_id", "list_price")


def test_a_hot_product_is_spread_over_time(frame, no_broadcast):
    facts, dim = sales(frame), offers(frame)
    ranged = joins.version_ranges(dim, ["platform", "product_id"]).withColumnsRenamed({"platform": "__platform", "product_id": "__product_id"})
    dealt, placed = skew.sliced(facts, ranged, ["platform", "product_id"], ["__platform", "__product_id"], "time", "valid_from", "valid_to", share=1 / 20)
    groups = dealt.where("time IS NOT NULL").groupBy("platform", "product_id", "__slice").count().collect()
    hot = [g["count"] for g in groups if g.product_id == "hot"]
    assert sum(hot) > 900 and len(hot) > 60 and max(hot) <= 3000 / 32
    # a version stands in the slices that it covers only, and light keys once
    n = {r["__product_id"]: r["count"] for r in placed.where("__platform = 'x'").groupBy("__product_id").count().collect()}
    assert n["p2"] == 3 and 50 <= n["hot"] <= 64 + 4
    plan = joins.scd2_join(facts, dim, ["platform", "product_id"])._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Join" in line and "__slice" in line]
    assert wide and all("SortMergeJoin" in line or "ShuffledHashJoin" in line for line in wide)


def test_empty_sides(frame, no_broadcast):
    facts, dim = sales(frame, 30), offers(frame)
    assert joins.scd2_join(facts.limit(0), dim, ["platform", "product_id"]).collect() == []
    got = joins.scd2_join(facts, dim.limit(0), ["platform", "product_id"])
    assert got.count() == 30 and got.where("offer_id IS NOT NULL").count() == 0
