"""The analytics model on top of the driver's star-schema tables.

Every frame is a lazy projection of whole parquet tables. ``MODEL_SQL`` states
the same derivations as common table expressions, so a query's SQL twin reads
exactly the same rows. Amounts are whole coins (1/100 of a price unit), so sums
are exact integers in any engine and any order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.stages import Stages

# Fixed values of the mapping, shared by the Spark frames and the SQL text.
TODAY = "1998-01-01"          # reporting day of the ledger and snapshots
FIRST_START = "1996-01-01"    # start of every product's first price version
SECOND_START = "1998-01-01"   # start of the second version, where there is one
PLATFORMS = ("F", "O")


class Model:
    """Model frames over one data folder; columns are pruned by whoever selects from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._stages = Stages()

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A common stage of this model's queries, computed once."""
        return self._stages.once(name, build)

    def _joined(self, left: str, right: str, left_key: str, right_key: str) -> DataFrame:
        return self.table(left).join(self.table(right), F.expr(f"{left_key} = {right_key}"))

    # -- people -----------------------------------------------------------
    @cached_property
    def regions(self) -> DataFrame:
        return self._joined("nation", "region", "n_regionkey", "r_regionkey").selectExpr(
            "n_name AS country_code", "r_name AS region")

    @cached_property
    def users(self) -> DataFrame:
        placed = self._joined("customer", "nation", "c_nationkey", "n_nationkey").join(
            self.table("region"), F.expr("n_regionkey = r_regionkey"))
        return placed.selectExpr("c_custkey AS account_id", "r_name AS region", "c_mktsegment AS membership", "n_name AS country")

    @cached_property
    def membership(self) -> DataFrame:
        """Accounts in debt hold no membership."""
        return self.table("customer").where("c_acctbal >= 0").selectExpr("c_custkey AS account_id", "c_mktsegment AS membership")

    @cached_property
    def snapshot(self) -> DataFrame:
        """One user row as of the end of the data: device, server, both countries, login days."""
        logins = self.table("orders").groupBy("o_custkey").agg(
            F.expr("CAST(min(o_orderdate) AS DATE) AS first_login"), F.expr("CAST(max(o_orderdate) AS DATE) AS last_login"))
        return self._joined("customer", "nation", "c_nationkey", "n_nationkey").join(
            logins, F.expr("c_custkey = o_custkey")).selectExpr(
            "c_custkey AS account_id",
            "CASE WHEN c_acctbal >= 5000 THEN 'console' ELSE 'pc' END AS device",
            "CASE WHEN c_acctbal > 9800 THEN 'NULL_X' WHEN n_nationkey < 13 THEN 'west' ELSE 'east' END AS platform",
            "CASE WHEN c_acctbal BETWEEN 4500 AND 5000 THEN 'TEST' ELSE 'LIVE' END AS server_type",
            "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'CN' WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'US' END AS country_os",
            "n_name AS country_ip", "first_login", "last_login")

    @cached_property
    def active_days(self) -> DataFrame:
        """Daily activity snapshot: one row per order, with the user's attributes of that day."""
        return self.table("orders").selectExpr(
            "o_custkey AS account_id", "CAST(o_orderdate AS DATE) AS date", "o_orderstatus AS platform", "o_orderpriority AS play_mode")

    # -- purchases --------------------------------------------------------
    def _ordered(self, lines: DataFrame, *more: str) -> DataFrame:
        """Purchases out of order lines, with ``more`` columns that the lines bring along."""
        return (
            lines.join(self.table("orders"), F.expr("l_orderkey = o_orderkey"))
            .selectExpr(
                "*", "CAST(round(l_extendedprice * 100) AS BIGINT) AS price",
                "CASE WHEN l_tax = 0 THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE "
                "CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) div 100 END AS free_use")
            .selectExpr(
                "o_custkey AS account_id", "o_orderkey AS transaction_id", "l_linestatus AS platform", "CAST(l_partkey AS STRING) AS product_id",
                "CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linestatus = 'O' THEN 'offer.' || CAST(l_partkey * 10 + l_linenumber AS STRING) "
                "ELSE CAST(l_partkey * 10 + l_linenumber AS STRING) END AS sales_id",
                "CAST(o_orderdate AS DATE) AS date", "o_orderdate + make_dt_interval(0, l_linenumber) AS time",
                "CAST(l_quantity AS BIGINT) AS qty", "price", "free_use", "price - free_use AS paid_use",
                "l_returnflag AS channel", "l_suppkey AS seller_id", *more)
        )

    @cached_property
    def purchases(self) -> DataFrame:
        return self._ordered(self.table("lineitem"))

    @cached_property
    def _parts(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS part_key", "p_name AS product_name", "p_brand AS event_name", "p_type AS event_type",
            "CASE WHEN p_size <= 25 THEN 'small' ELSE 'big' END AS sub_category",
            "CAST(round(p_retailprice * 100) AS BIGINT) AS list_price")

    @cached_property
    def products(self) -> DataFrame:
        return self._parts.selectExpr("CAST(part_key AS STRING) AS product_id", *self._parts.columns[1:])

    @cached_property
    def sales(self) -> DataFrame:
        """Purchases with their product's attributes.

        Lines meet their products first: a report on few products then sends only those lines to the orders.
        """
        lines = self.table("lineitem").join(self._parts, F.expr("l_partkey = part_key"))
        return self._ordered(lines, *self._parts.columns[1:])

    @cached_property
    def offers(self) -> DataFrame:
        """Versioned sales items: one row per platform, product and price version."""
        platforms = ", ".join(f"'{p}'" for p in PLATFORMS)
        return (
            self.table("part")
            .selectExpr("*", f"explode(array({platforms})) AS platform")
            .selectExpr("*", "explode(CASE WHEN p_size > 25 THEN array(1, 2) ELSE array(1) END) AS version")
            .selectExpr(
                "platform", "CAST(p_partkey AS STRING) AS product_id", "CAST(p_partkey * 10 + version AS STRING) AS offer_id", "version",
                f"CAST(CASE WHEN version = 1 THEN '{FIRST_START}' ELSE '{SECOND_START}' END AS TIMESTAMP_NTZ) AS start_time",
                "CAST(round(p_retailprice * 100) AS BIGINT) + (version - 1) * 500 AS list_price",
                "CASE WHEN p_type <> 'SMALL' THEN p_name END AS product_name", "p_brand AS event_name", "p_type AS event_type")
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """Coin ledger rows with a nested array of balances by expiry day."""
        up = "CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0L END"
        used = "CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0L END"
        coins = "CAST(round(l_extendedprice * 100) AS BIGINT)"
        entry = ("named_struct('expiry_date', {}, 'daily_free_topup', {}, 'daily_paid_topup', {}, 'daily_free_use', {}, "
                 f"'daily_paid_use', {{}}, 'free_balance', {coins}, 'paid_balance', 2 * {coins})")
        first = entry.format("CAST(l_shipdate AS DATE)", up, "0L", used, "0L")
        second = entry.format("date_add(CAST(l_shipdate AS DATE), 30)", "0L", up, "0L", used)
        return self._joined("lineitem", "orders", "l_orderkey", "o_orderkey").selectExpr(
            "o_custkey AS account_id", f"DATE '{TODAY}' AS date", "l_linestatus AS platform", f"array({first}, {second}) AS by_expiry")

    @cached_property
    def first_use(self) -> DataFrame:
        """First purchase day per account, as the ledger keeps it."""
        return self.table("orders").groupBy(F.expr("o_custkey AS account_id")).agg(
            F.expr("CAST(min(o_orderdate) AS DATE) AS first_use_date"))

    @cached_property
    def inventory(self) -> DataFrame:
        """Inventory rows with a nested array of equipped items."""
        return self._joined("lineitem", "orders", "l_orderkey", "o_orderkey").selectExpr(
            "o_custkey AS account_id", "CAST(l_shipdate AS DATE) AS date_updated",
            "array(named_struct('part', CAST(l_linenumber AS STRING), 'itemid', CAST(l_partkey AS STRING)), "
            "named_struct('part', CAST(8 - l_linenumber AS STRING), 'itemid', CAST(l_suppkey AS STRING))) AS equips")

    @cached_property
    def parts(self) -> DataFrame:
        """Body parts an item can sit on, with store categories; derived from the part sizes."""
        return self.table("part").selectExpr("(p_size - 1) div 8 + 1 AS n").distinct().selectExpr(
            "'desc.' || CAST(n AS STRING) AS part_id",
            "CASE WHEN n <= 3 THEN 'weapon' WHEN n <= 5 THEN 'outfit' ELSE 'vehicle' END AS category",
            "CASE WHEN n % 2 = 0 THEN 'even' ELSE 'odd' END AS sub_category")

    @cached_property
    def part_names(self) -> DataFrame:
        return self.parts.where("category = 'weapon'").selectExpr("part_id", "'blade ' || part_id AS name")

    # -- logs -------------------------------------------------------------
    @cached_property
    def log(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id", "user_id AS account_id", "ts AS time", "CAST(ts AS DATE) AS date", "event_type",
            "CAST(round(value * 100) AS BIGINT) AS cents", "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k")

    @cached_property
    def currency_log(self) -> DataFrame:
        return self.log.selectExpr(
            "event_id", "account_id", "time", "date",
            "CASE WHEN k < 40 THEN 'coupon.free' WHEN k < 60 THEN 'coupon.paid' WHEN k < 80 THEN 'token.season' ELSE 'point' END AS currency",
            "CASE event_type WHEN 'purchase' THEN -cents WHEN 'error' THEN 0L ELSE cents END AS amount",
            "event_type AS reason", "CASE WHEN k >= 20 THEN 'tier' || CAST(k div 20 AS STRING) END AS reason_detail")

    @cached_property
    def purchase_log(self) -> DataFrame:
        return self.log.where("event_type = 'purchase'").selectExpr(
            "event_id", "account_id", "time", "date",
            "CASE WHEN k < 40 THEN 'token.season' WHEN k < 60 THEN 'token.artisan' ELSE 'point' END AS currency",
            "CAST(k AS STRING) AS product_id", "k div 25 + 1 AS amount", "cents AS local_price",
            "'season' || CAST(k div 50 AS STRING) AS event_name")

    @cached_property
    def workshop_log(self) -> DataFrame:
        """Workshop actions: click = craft, view = crate opened, error = disassemble, signup = repurpose."""
        return self.log.where("event_type <> 'purchase'").selectExpr(
            "event_id", "account_id", "time", "date",
            "CASE event_type WHEN 'click' THEN 'craft' WHEN 'view' THEN 'open' WHEN 'error' THEN 'disassemble' ELSE 'repurpose' END AS action",
            "CASE WHEN k < 30 THEN 'imprint.' WHEN k < 60 THEN 'voucher.' ELSE 'part.' END || CAST(k div 10 AS STRING) AS item_id",
            "k + 1 AS open_amount", "cents AS amount", "'why' || CAST(k div 34 AS STRING) AS reason")

    @cached_property
    def clicks(self) -> DataFrame:
        return self.log.where("event_type IN ('view', 'click')").selectExpr(
            "event_id", "account_id", "time", "date", "CASE event_type WHEN 'view' THEN 'detail' ELSE 'buy' END AS action",
            "CASE WHEN k < 5 THEN 'home' ELSE 'item.' || CAST(k AS STRING) END AS label")

    @cached_property
    def votes(self) -> DataFrame:
        return self.log.where("event_type = 'signup'").selectExpr(
            "event_id", "account_id", "time", "date",
            "CASE WHEN k < 30 THEN 'TEAM_' WHEN k < 50 THEN 'SOLO_BONUS_' WHEN k < 80 THEN 'DUEL_' ELSE 'OTHER_' END || "
            "CASE k % 3 WHEN 0 THEN 'EAST' WHEN 1 THEN 'WEST' ELSE 'NORTH' END AS game_id")

    @cached_property
    def pass_status(self) -> DataFrame:
        return self.log.selectExpr(
            "event_id", "account_id", "date", "CASE WHEN k < 50 THEN 'season1' ELSE 'season2' END AS pass_name",
            "CASE WHEN event_type IN ('purchase', 'signup') THEN 'pass' WHEN event_type = 'error' THEN 'non_active' ELSE 'active' END AS status",
            "k AS level", "CASE WHEN event_type = 'signup' THEN cents ELSE 0L END AS levelup_xp")

    @cached_property
    def gameplay(self) -> DataFrame:
        first = "CASE WHEN event_type <> 'error' THEN k END"
        columns = [f"{first if (view, size) == ('tpp', 'solo') else f'k + {i}'} AS {view}_{size}_{kind}"
                   for kind in ("count", "minute")
                   for i, (view, size) in enumerate((v, z) for v in ("tpp", "fpp") for z in ("solo", "duo", "squad"))]
        return self.log.selectExpr("account_id", "date", *columns)

    @cached_property
    def phase_log(self) -> DataFrame:
        """In-game log: click = equip, view = unequip, error = death; the day of the month picks the phase."""
        return self.log.where("event_type IN ('click', 'view', 'error')").selectExpr(
            "account_id AS session_id", "account_id", "time",
            "CAST(CASE WHEN day(time) = 1 THEN 0.1 ELSE 1.0 + (day(time) - 2) * 0.5 END AS DECIMAL(3,1)) AS phase",
            "'w' || CAST(k % 5 AS STRING) AS item_id",
            "CASE event_type WHEN 'click' THEN 'equip' WHEN 'view' THEN 'unequip' ELSE 'death' END AS kind")


# Derivations above as SQL text (DuckDB dialect).
MODEL_SQL = f"""
WITH regions AS (
  SELECT n_name AS country_code, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey
), users AS (
  SELECT c_custkey AS account_id, r_name AS region, c_mktsegment AS membership, n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), membership AS (
  SELECT c_custkey AS account_id, c_mktsegment AS membership FROM customer WHERE c_acctbal >= 0
), snapshot AS (
  SELECT c_custkey AS account_id, CASE WHEN c_acctbal >= 5000 THEN 'console' ELSE 'pc' END AS device,
    CASE WHEN c_acctbal > 9800 THEN 'NULL_X' WHEN n_nationkey < 13 THEN 'west' ELSE 'east' END AS platform,
    CASE WHEN c_acctbal BETWEEN 4500 AND 5000 THEN 'TEST' ELSE 'LIVE' END AS server_type,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'CN' WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'US' END AS country_os,
    n_name AS country_ip, first_login, last_login
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_login, CAST(max(o_orderdate) AS DATE) AS last_login
        FROM orders GROUP BY 1) ON c_custkey = o_custkey
), active_days AS (
  SELECT o_custkey AS account_id, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS platform,
    o_orderpriority AS play_mode FROM orders
), lines AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    CAST(round(l_discount * 100) AS BIGINT) AS pct FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), purchases AS (
  SELECT o_custkey AS account_id, o_orderkey AS transaction_id, l_linestatus AS platform,
    CAST(l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l_returnflag = 'N' THEN NULL
         WHEN l_linestatus = 'O' THEN 'offer.' || CAST(l_partkey * 10 + l_linenumber AS VARCHAR)
         ELSE CAST(l_partkey * 10 + l_linenumber AS VARCHAR) END AS sales_id,
    CAST(o_orderdate AS DATE) AS date, o_orderdate + l_linenumber * INTERVAL 1 HOUR AS time,
    CAST(l_quantity AS BIGINT) AS qty, cents AS price,
    CASE WHEN l_tax = 0 THEN cents ELSE cents * pct // 100 END AS free_use,
    cents - CASE WHEN l_tax = 0 THEN cents ELSE cents * pct // 100 END AS paid_use,
    l_returnflag AS channel, l_suppkey AS seller_id
  FROM lines
), products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_brand AS event_name, p_type AS event_type,
    CASE WHEN p_size <= 25 THEN 'small' ELSE 'big' END AS sub_category,
    CAST(round(p_retailprice * 100) AS BIGINT) AS list_price FROM part
), sales AS (
  SELECT * FROM purchases JOIN products USING (product_id)
), offers AS (
  SELECT pf.platform, CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_partkey * 10 + v.version AS VARCHAR) AS offer_id,
    v.version, CASE WHEN v.version = 1 THEN TIMESTAMP '{FIRST_START}' ELSE TIMESTAMP '{SECOND_START}' END AS start_time,
    CAST(round(p_retailprice * 100) AS BIGINT) + (v.version - 1) * 500 AS list_price,
    CASE WHEN p_type <> 'SMALL' THEN p_name END AS product_name, p_brand AS event_name, p_type AS event_type
  FROM part, (VALUES ('F'), ('O')) pf(platform), (VALUES (1), (2)) v(version) WHERE v.version = 1 OR p_size > 25
), ledger_entries AS (
  SELECT o_custkey AS account_id, DATE '{TODAY}' AS date, l_linestatus AS platform,
    CAST(l_shipdate AS DATE) + e.days AS expiry_date,
    CASE WHEN l_returnflag = 'A' AND e.days = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS daily_free_topup,
    CASE WHEN l_returnflag = 'A' AND e.days = 30 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS daily_paid_topup,
    CASE WHEN l_returnflag = 'R' AND e.days = 0 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS daily_free_use,
    CASE WHEN l_returnflag = 'R' AND e.days = 30 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS daily_paid_use,
    cents AS free_balance, cents * 2 AS paid_balance
  FROM lines, (VALUES (0), (30)) e(days)
), first_use AS (
  SELECT o_custkey AS account_id, CAST(min(o_orderdate) AS DATE) AS first_use_date FROM orders GROUP BY 1
), worn AS (
  SELECT o_custkey AS account_id, CAST(l_shipdate AS DATE) AS date_updated, CAST(l_linenumber AS VARCHAR) AS part,
    CAST(l_partkey AS VARCHAR) AS itemid FROM lines
  UNION ALL
  SELECT o_custkey, CAST(l_shipdate AS DATE), CAST(8 - l_linenumber AS VARCHAR), CAST(l_suppkey AS VARCHAR) FROM lines
), parts AS (
  SELECT 'desc.' || CAST(n AS VARCHAR) AS part_id,
    CASE WHEN n <= 3 THEN 'weapon' WHEN n <= 5 THEN 'outfit' ELSE 'vehicle' END AS category,
    CASE WHEN n % 2 = 0 THEN 'even' ELSE 'odd' END AS sub_category
  FROM (SELECT DISTINCT (p_size - 1) // 8 + 1 AS n FROM part)
), part_names AS (
  SELECT part_id, 'blade ' || part_id AS name FROM parts WHERE category = 'weapon'
), log AS (
  SELECT event_id, user_id AS account_id, ts AS time, CAST(ts AS DATE) AS date, event_type,
    CAST(round(value * 100) AS BIGINT) AS cents, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events
), currency_log AS (
  SELECT event_id, account_id, time, date,
    CASE WHEN k < 40 THEN 'coupon.free' WHEN k < 60 THEN 'coupon.paid' WHEN k < 80 THEN 'token.season' ELSE 'point' END AS currency,
    CASE event_type WHEN 'purchase' THEN -cents WHEN 'error' THEN 0 ELSE cents END AS amount,
    event_type AS reason, CASE WHEN k >= 20 THEN 'tier' || CAST(k // 20 AS VARCHAR) END AS reason_detail FROM log
), purchase_log AS (
  SELECT event_id, account_id, time, date,
    CASE WHEN k < 40 THEN 'token.season' WHEN k < 60 THEN 'token.artisan' ELSE 'point' END AS currency,
    CAST(k AS VARCHAR) AS product_id, k // 25 + 1 AS amount, cents AS local_price,
    'season' || CAST(k // 50 AS VARCHAR) AS event_name FROM log WHERE event_type = 'purchase'
), workshop_log AS (
  SELECT event_id, account_id, time, date,
    CASE event_type WHEN 'click' THEN 'craft' WHEN 'view' THEN 'open' WHEN 'error' THEN 'disassemble' ELSE 'repurpose' END AS action,
    CASE WHEN k < 30 THEN 'imprint.' WHEN k < 60 THEN 'voucher.' ELSE 'part.' END || CAST(k // 10 AS VARCHAR) AS item_id,
    k + 1 AS open_amount, cents AS amount, 'why' || CAST(k // 34 AS VARCHAR) AS reason
  FROM log WHERE event_type <> 'purchase'
), clicks AS (
  SELECT event_id, account_id, time, date, CASE event_type WHEN 'view' THEN 'detail' ELSE 'buy' END AS action,
    CASE WHEN k < 5 THEN 'home' ELSE 'item.' || CAST(k AS VARCHAR) END AS label
  FROM log WHERE event_type IN ('view', 'click')
), votes AS (
  SELECT event_id, account_id, time, date,
    CASE WHEN k < 30 THEN 'TEAM_' WHEN k < 50 THEN 'SOLO_BONUS_' WHEN k < 80 THEN 'DUEL_' ELSE 'OTHER_' END ||
    CASE k % 3 WHEN 0 THEN 'EAST' WHEN 1 THEN 'WEST' ELSE 'NORTH' END AS game_id
  FROM log WHERE event_type = 'signup'
), pass_status AS (
  SELECT event_id, account_id, date, CASE WHEN k < 50 THEN 'season1' ELSE 'season2' END AS pass_name,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'pass' WHEN event_type = 'error' THEN 'non_active' ELSE 'active' END AS status,
    k AS level, CASE WHEN event_type = 'signup' THEN cents ELSE 0 END AS levelup_xp FROM log
), gameplay AS (
  SELECT account_id, date,
    CASE WHEN event_type <> 'error' THEN k END AS tpp_solo_count, k + 1 AS tpp_duo_count, k + 2 AS tpp_squad_count,
    k + 3 AS fpp_solo_count, k + 4 AS fpp_duo_count, k + 5 AS fpp_squad_count,
    CASE WHEN event_type <> 'error' THEN k END AS tpp_solo_minute, k + 1 AS tpp_duo_minute, k + 2 AS tpp_squad_minute,
    k + 3 AS fpp_solo_minute, k + 4 AS fpp_duo_minute, k + 5 AS fpp_squad_minute FROM log
), phase_log AS (
  SELECT account_id AS session_id, account_id, time,
    CAST(CASE WHEN day(time) = 1 THEN 0.1 ELSE 1.0 + (day(time) - 2) * 0.5 END AS DECIMAL(3,1)) AS phase,
    'w' || CAST(k % 5 AS VARCHAR) AS item_id,
    CASE event_type WHEN 'click' THEN 'equip' WHEN 'view' THEN 'unequip' ELSE 'death' END AS kind
  FROM log WHERE event_type IN ('click', 'view', 'error')
)
"""
