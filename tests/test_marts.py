import datetime as dt

from pyspark.sql import functions as F

from tallyforge.plans import marts
from tests import schemas
from tests.conftest import rows

SNAP = "account_id string, device string, platform string, server_type string, country_os string, country_ip string, first_login date, last_login date, days_since int"
COIN = "account_id string, sales_id string, product_id string, product_name string, date date, qty bigint, free_use bigint, paid_use bigint"
CASH = "account_id string, sales_id string, product_id string, product_name string, date date, unit_sold bigint, revenue bigint"
DAY = "2020-01-10"


def people(frame):
    snapshot = frame(SNAP, ("a", "pc", "w", "LIVE", None, "KR", "2019-01-01", DAY, 0), ("b", "pc", "w", "LIVE", "US", "ZZ", "2019-01-01", DAY, 9),
                     ("c", "pc", "w", "LIVE", None, "KR", "2019-01-01", DAY, 40), ("d", "pc", "w", "TEST", None, "KR", "2019-01-01", DAY, 0))
    regions = frame("country_code string, region string", ("KR", "EAST"))
    members = frame("account_id string, membership string", ("a", "gold"), ("b", "gold"))
    return snapshot, regions, members


def test_sales_mart_keeps_unknown_regions_apart(frame):
    coin = frame(COIN, ("a", "1", "p", "P", DAY, 2, 3, 4), ("b", "1", "p", "P", DAY, 1, 0, 5), ("c", "1", "p", "P", DAY, 1, 1, 1), ("a", "1", "p", "P", "2020-01-09", 9, 9, 9))
    cash = frame(CASH, ("a", "9", "q", "Q", DAY, 1, 100))
    out = marts.sales_by_membership(*people(frame), coin, cash, DAY)
    got = rows(out, "region", "membership", "currency", "product_id", "pu", "unit_sold", "paid_used", "revenue", "au")
    assert got == [
        ("EAST", "gold", "cash", "q", 1, 1, None, 100, 1), ("EAST", "gold", "cash", "total", 1, 1, None, 100, 1),
        ("EAST", "gold", "coin", "p", 1, 2, 4, None, 1), ("EAST", "gold", "coin", "total", 1, 2, 4, None, 1),
        ("EAST", "gold", "coin+cash", "total", 1, 3, 4, 100, 1),
        ("EAST", "undefined", "coin", "p", 1, 1, 1, None, 1), ("EAST", "undefined", "coin", "total", 1, 1, 1, None, 1),
        ("EAST", "undefined", "coin+cash", "total", 1, 1, 1, None, 1),
        # the unknown region: sales rows and active users do not meet
        (None, "gold", "coin", "p", 1, 1, 5, None, None), (None, "gold", "coin", "total", 1, 1, 5, None, None),
        (None, "gold", "coin+cash", "total", 1, 1, 5, None, None), (None, "gold", None, None, None, None, None, None, 1)]


def test_paid_mart_drops_products_of_users_without_membership(frame):
    coin = frame(COIN, ("a", "1", "p", "P", DAY, 2, 3, 4), ("c", "1", "p", "P", DAY, 1, 1, 1), ("a", "1", "free", "F", DAY, 2, 3, 0))
    out = marts.paid_by_product(*people(frame), coin, DAY)
    assert rows(out, "membership", "product_id", "pu", "paid_used", "au") == [("gold", "p", 1, 4, 1), ("gold", "total", 1, 4, 1), ("undefined", "total", 1, 1, 1)]


def test_balance_buckets_and_windows(spark, frame):
    day = dt.date(2020, 1, 10)
    entry = lambda days, **kw: {"expiry_date": day + dt.timedelta(days), **{f: 0 for f in [
        "daily_free_topup", "daily_paid_topup", "daily_free_use", "daily_paid_use", *schemas.LEDGER_MEASURES]}, **kw}
    ledger = spark.createDataFrame(
        [("a", day, "pc", "w", day, [entry(n, free_balance=1, daily_free_topup=int(n == 1)) for n in (0, 1, 2, 8, 31, 91, 181)]),
         ("b", day, "pc", "w", day, [entry(1, free_balance=5, daily_paid_use=1)])], schemas.LEDGER)
    out = marts.balance_by_expiry(*people(frame), ledger, schemas.LEDGER_MEASURES)
    a_all = out.where("region = 'EAST' AND active_window = 'all'")
    assert rows(a_all, "days_to_expiry", "users", "free_balance", "topup_users", "use_users") == sorted(
        [("0", 1, 1, 1, 0)] + [(b, 1, 1, 0, 0) for b in ("[1-7)", "[7-30)", "[30-90)", "[90-180)", "[180-inf)")])
    assert {r[0] for r in rows(out.where("region = 'EAST'"), "active_window")} == {"all", "w-01", "w-02", "w-04", "w-08", "w-12"}
    # unknown region: only in 'all', under a literal label
    assert rows(out.where("region <> 'EAST'"), "region", "active_window", "free_balance", "use_users") == [("Undefined", "all", 5, 1)]


def test_campaign_mart_is_empty_with_schema_when_nothing_is_live(frame):
    calendar = frame("name string, start_date date, end_date date", ("x", "2020-01-01", "2020-01-20"))
    coin = frame("account_id string, event_name string, date date, free_use bigint, paid_use bigint", ("a", "the x cup", DAY, 1, 2), ("b", "the x cup", "2020-01-02", 4, 0), ("c", "other", DAY, 9, 9))
    ledger = frame("account_id string, first_use_date date", ("a", DAY), ("c", DAY))
    live = marts.campaign_kpi(people(frame)[0], coin, ledger, calendar, DAY)
    assert rows(live) == [(DAY, "x", 3, 2, 1, 5, 2, 1)]
    none = marts.campaign_kpi(people(frame)[0], coin, ledger, calendar, "2021-01-01")
    assert rows(none) == [] and none.columns == live.columns


def test_point_sales_only_while_live(frame):
    calendar = frame("name string, start_date date, end_date date", ("x", "2020-01-01", "2020-01-20"))
    log = frame("currency string, event_name string, product_id string, amount bigint, local_price bigint", ("pt", "e", "p", 2, 5), ("pt", "e", "q", 1, 1), ("other", "e", "p", 9, 9))
    items = frame("product_id string, product_name string", ("p", None), ("p", None), ("q", "Q"))
    assert rows(marts.point_sales(log, items, calendar, DAY, "pt"), "product_id", "product_name", "unit_sold", "points_used") == [("p", "p", 2, 10), ("q", "Q", 1, 1)]
    assert rows(marts.point_sales(log, items, calendar, "2021-01-01", "pt")) == []


def test_action_totals(frame):
    log = frame("date date, action string, account_id string, item_id string, open_amount bigint", (DAY, "open", "a", "c1", 5), (DAY, "open", "a", "c2", 1), (DAY, "open", "b", None, 2),
                (DAY, "craft", "a", "imprint.1", None), (DAY, "craft", "b", "x", None), (DAY, "disassemble", "a", "x", None))
    out = marts.workshop_actions(log, [("%imprint%", "imprint")])
    assert rows(out, "action", "item", "count", "users") == [
        ("craft", "else", 1, 1), ("craft", "imprint", 1, 1), ("craft", "total", 2, 2), ("disassemble", "total", 1, 1),
        ("open", "c1", 5, 1), ("open", "c2", 1, 1), ("open", "total", 8, 2), ("open", None, 2, 1)]


def test_overview_levels(frame):
    coin = frame("account_id string, device string, platform string, event_type string, event_name string, product_id string, date date, free_use bigint, paid_use bigint",
                 ("a", "tv", "x", "season_shop", "s1", "k", DAY, 1, 2), ("a", "tv", "x", "shop", "r", "z", DAY, 1, 0),
                 ("z", "pc", "w", "food", "f", "z", DAY, 9, 9), ("q", "tv", "x", "shop", "r", "z", DAY, 0, 3))
    first = frame("account_id string, first_use_date date", ("a", DAY))
    out = marts.overview(people(frame)[0], people(frame)[1], coin, first, DAY, "daily", "%shop%", F.when(F.col("product_id") == "k", "key").otherwise("else"), "shop")
    assert rows(out, "product_type", "event_name", "paid_pu", "total_pu", "npu", "free_used", "paid_used") == [
        ("else", "r", 0, 1, 1, 1, 0), ("else", "r", 1, 1, 0, 0, 3), ("key", "s1", 1, 1, 1, 1, 2), ("regular", "regular", 0, 1, 1, 1, 0),
        ("regular", "regular", 1, 1, 0, 0, 3), ("total", "total", 1, 1, 0, 0, 3), ("total", "total", 1, 1, 1, 2, 2)]
    # a buyer outside the snapshot lacks a region, not the purchase's device and platform
    assert set(rows(out, "device", "platform", "region")) == {("tv", "x", "EAST"), ("tv", "x", None)}
