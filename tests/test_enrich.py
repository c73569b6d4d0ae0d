from pyspark.sql import functions as F

from tallyforge.functions import columns, periods
from tallyforge.operators import joins
from tallyforge.operators.levels import label_after, people_and_sums
from tests.conftest import rows

OFFERS = "platform string, product_id string, offer_id string, start_time timestamp_ntz, list_price bigint"
FACTS = "id int, platform string, product_id string, sales_id string, time timestamp_ntz"


def offers(frame):
    return frame(OFFERS, ("x", "one", "11", "2020-01-10", 5), ("x", "two", "21", "2020-01-10", 7), ("x", "two", "22", "2020-02-01", 8))


def test_versions_match_by_time(frame):
    facts = frame(FACTS, (1, "x", "one", None, "2019-01-01"), (2, "x", "two", None, "2020-02-01 00:00:00"),
                  (3, "x", "two", None, "2020-01-31 23:59:59"), (4, "x", "two", None, "2019-12-31"), (5, "y", "two", None, "2020-02-02"))
    got = joins.scd2_join(facts, offers(frame), ["platform", "product_id"])
    assert rows(got, "id", "offer_id") == [(1, "11"), (2, "22"), (3, "21"), (4, None), (5, None)]


def test_last_version_ends_in_2038(frame):
    facts = frame(FACTS, (1, "x", "two", None, "2038-01-18"), (2, "x", "two", None, "2038-01-19"), (3, "x", "one", None, "2050-01-01"))
    got = joins.scd2_join(facts, offers(frame), ["platform", "product_id"])
    assert rows(got, "id", "offer_id") == [(1, "22"), (2, None), (3, "11")]


def test_either_key_join_prefers_the_id(frame):
    facts = frame(FACTS, (1, "x", "two", None, "2020-01-15"), (2, "x", "two", "offer.22", "2020-01-15"), (3, "x", "one", "21", "2020-01-15"),
                  (4, "x", "one", "99", "2020-01-15"), (5, "y", "one", "11", "2020-01-15"), (6, "x", "none", None, "2020-01-15"),
                  (7, "x", "11", "offerX", "2020-01-15"))  # an id of no known form does not fall back to the product, whose name is an offer's id
    got = joins.either_key_join(facts, offers(frame), "sales_id", "offer_id", ["platform"], "product_id")
    assert rows(got, "id", "offer_id") == [(1, "21"), (2, "22"), (3, "21"), (4, None), (5, None), (6, None), (7, None)]


def test_either_key_join_equals_the_or_form(frame):
    facts = frame(FACTS, *[(i, "xy"[i % 2], ["one", "two", None][i % 3], [None, "11", "offer.22", "zz"][i % 4], f"2020-0{1 + i % 3}-15") for i in range(48)])
    dim = joins.version_ranges(offers(frame), ["platform", "product_id"])
    f, d = facts.alias("f"), dim.alias("d")
    sid = columns.strip_prefix("f.sales_id", "offer")
    in_range = F.col("d.valid_from").isNull() | ((F.col("f.time") >= F.col("d.valid_from")) & (F.col("f.time") < F.col("d.valid_to")))
    either = (F.col("f.sales_id").isNotNull() & (sid == F.col("d.offer_id"))) | (
        F.col("f.sales_id").isNull() & (F.col("f.product_id") == F.col("d.product_id")) & in_range)
    expected = f.join(d, (F.col("f.platform") == F.col("d.platform")) & either, "left").select("f.id", "d.offer_id")
    got = joins.either_key_join(facts, offers(frame), "sales_id", "offer_id", ["platform"], "product_id")
    assert rows(got, "id", "offer_id") == rows(expected)


def test_either_key_join_has_an_equi_key_per_row(frame, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = frame(FACTS, (1, "x", "two", None, "2020-01-15"))
        joined = joins.either_key_join(facts, offers(frame), "sales_id", "offer_id", ["platform"], "product_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert any("__fact_key" in line for line in plan.splitlines() if "hashpartitioning" in line)


def test_lookup_join_fills_and_drops(frame):
    facts = frame("product_id string, date date, time timestamp_ntz", ("a", "2020-01-01", None), ("gift", "2020-01-01", None),
                  (None, "2020-01-01", None), ("b", "2020-01-02", "2020-01-02 05:00:00"))
    dim = frame("product_id string, list_price bigint", ("a", 3))
    got = joins.lookup_join(facts, dim, ["product_id"], ["gift"])
    assert rows(got, "product_id", "time", "list_price", "status", "transaction_id") == [
        ("a", "2020-01-01 00:00:00", 3, "Succeeded", None), ("b", "2020-01-02 05:00:00", None, "Succeeded", None)]


def test_country_and_region(frame):
    users = frame("id int, country_os string, country_ip string", (1, None, "KR"), (2, "CN", "KR"), (3, "US", "KR"), (4, "US", "ZZ"))
    got = joins.with_region(joins.with_country(users), frame("country_code string, region string", ("KR", "EAST")))
    assert rows(got, "id", "country", "region") == [(1, "KR", "EAST"), (2, "CN", None), (3, "KR", "EAST"), (4, "ZZ", None)]


def test_membership_default_before_and_after(frame):
    users = frame("account_id string", ("a",), ("b",), ("c",))
    members = frame("account_id string, membership string", ("a", "gold"), ("a", "gold"), ("b", "undefined"))
    before = joins.with_membership(users, members).groupBy("membership").count()
    assert rows(before) == [("gold", 1), ("undefined", 2)]
    after = label_after(joins.with_membership(users, members, None).groupBy("membership").count(), "membership", "undefined")
    assert rows(after) == [("gold", 1), ("undefined", 1), ("undefined", 1)]


def test_first_per_key_breaks_ties_and_keeps_nulls_first(frame):
    df = frame("k string, first_login date, tie string, v int", ("a", "2020-01-01", "y", 1), ("a", "2020-01-01", "x", 2),
               ("b", None, "z", 3), ("b", "2019-01-01", "a", 4))
    assert rows(joins.first_per_key(df, "k", ["first_login", "tie"]), "k", "v") == [("a", 2), ("b", 3)]


def test_active_modes(frame):
    users = frame("id int, server_type string, platform string, date date, last_login date",
                  (1, "LIVE", "p", "2020-01-05", "2020-01-05"), (2, "LIVE", "p", "2020-01-05", "2020-01-03"),
                  (3, "TEST", "p", "2020-01-05", "2020-01-05"), (4, "LIVE", "NULL_p", "2020-01-05", "2020-01-05"), (5, "LIVE", "p", "2020-01-05", "2019-12-01"))
    ids = lambda df: [r[0] for r in rows(df, "id")]
    assert ids(joins.active_users(users, "2020-01-01")) == [1, 2]
    assert ids(joins.active_users(users, mode="same_day")) == [1]
    assert ids(joins.active_users(users, mode="any")) == [1, 2, 5]


def test_periods(frame, spark):
    one = spark.range(1)
    value = lambda c: str(one.select(c).first()[0])
    assert value(periods.period_start("2022-01-14", "weekly", "2022-01-12")) == "2022-01-12"
    assert value(periods.period_start("2022-03-14", "weekly", "2022-01-12")) == "2022-03-08"
    assert value(periods.period_start("2022-03-14", "monthly")) == "2022-03-01"
    assert value(periods.period_start("2022-03-14")) == "2022-03-14"
    days = frame("d date", ("2022-03-16",), ("2022-03-22",), ("2022-03-23",), ("2022-03-15",))
    assert rows(days.select("d", periods.week_bucket("d", "2022-03-16").alias("w"))) == [
        ("2022-03-15", "2022-03-09"), ("2022-03-16", "2022-03-16"), ("2022-03-22", "2022-03-16"), ("2022-03-23", "2022-03-23")]


def test_live_campaign_takes_the_first_that_covers_the_day(frame):
    cal = frame("name string, start_date date, end_date date", ("late", "2020-01-05", "2020-02-01"), ("early", "2020-01-01", "2020-01-10"), ("gone", "2019-01-01", "2019-02-01"))
    assert rows(joins.live_campaign(cal, "2020-01-06"), "name") == [("early",)]
    assert rows(joins.live_campaign(cal, "2020-01-20"), "name") == [("late",)]
    assert rows(joins.live_campaign(cal, "2021-01-01")) == []


def test_cohort_flag_and_exclude(frame):
    df, cohort = frame("account_id string", ("a",), ("b",), (None,)), frame("account_id string", ("a",), ("a",))
    assert rows(joins.in_cohort(df, cohort)) == [("a",)]
    assert rows(joins.in_cohort(df, cohort, flag="f")) == [("a", True), ("b", False), (None, False)]
    assert rows(joins.exclude(df, cohort)) == [("b",), (None,)]


def test_new_buyer_flag(frame):
    buys = frame("account_id string, date date", ("a", "2020-01-01"), ("a", "2020-01-02"), ("b", "2020-01-01"))
    ledger = frame("account_id string, first_use_date date", ("a", "2020-01-01"))
    assert rows(joins.flag_new_buyer(buys, ledger), "account_id", "date", "is_new") == [
        ("a", "2020-01-01", True), ("a", "2020-01-02", False), ("b", "2020-01-01", False)]


def test_text_helpers(frame):
    df = frame("c string", ("offer.12",), ("12",), ("offer",), (None,))
    assert rows(df.select("c", columns.strip_prefix("c", "offer").alias("s"))) == [("12", "12"), ("offer", None), ("offer.12", "12"), (None, None)]
    labelled = df.select("c", columns.label_like("c", [("%1%", "one"), ("offer%", "offer")]).alias("l"))
    assert rows(labelled) == [("12", "one"), ("offer", "offer"), ("offer.12", "one"), (None, None)]


def test_totals_do_not_swallow_real_nulls(frame):
    df = frame("u string, g string, paid bigint", ("a", "x", 1), ("a", None, 0), ("b", None, 5), (None, "x", 7))
    out = people_and_sums(df, "u", ["g"], {"users": True, "payers": "paid > 0"}, {"paid": "paid"}, rows="n", levels=[["g"], []], labels={"g": "total"})
    assert rows(out, "g", "users", "payers", "paid", "n") == [("total", 2, 2, 13, 4), ("x", 1, 1, 8, 2), (None, 2, 1, 5, 2)]
