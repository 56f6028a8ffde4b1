"""DuckDB SQL equivalent of every registered query.

The driver registers the test tables as views; each statement rebuilds the
raw retail tables from them with the same rules as ``sources.adapter`` and
then states the model or check in plain SQL (window ``row_number`` for
dedup, ``sum() over`` for shares, etc.). Final projections conform types the
same way the registry does: fractional -> round(double, 6), integer -> bigint.
"""

from __future__ import annotations

from marketlens.constants import (BASE_ORDERS_PER_REGION_PER_HOUR, DOW_MULTIPLIERS, DQ_RATES,
                                  FIXED_HOLIDAY_DATES, GOLDEN_WEEK_DAYS, GOLDEN_WEEK_FIRST, GOLDEN_WEEK_REGION,
                                  GOLDEN_WEEK_START, GOLDEN_WEEK_STEP, HOLIDAY_GROUP, HOLIDAY_MULTIPLIERS,
                                  INTRADAY_MULTIPLIERS, MONTHLY_MULTIPLIERS, REGION_CURRENCY, REGION_UTC_OFFSETS,
                                  REGIONS, SEED_REGIONS, SURROGATE_NULL)
from marketlens.plans.data_tests import ACCEPTED_TESTS, NOT_NULL_TESTS, UNIQUE_TESTS

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
_REG_LIST = "[" + ", ".join(f"'{r}'" for r in REGIONS) + "]"


def _case(expr: str, mapping: dict, cast: str | None = None) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else repr(v)
    whens = " ".join(f"WHEN {expr} = '{k}' THEN {lit(v)}" for k, v in mapping.items())
    out = f"CASE {whens} END"
    return f"CAST({out} AS {cast})" if cast else out


def _sk(*cols: str) -> str:
    parts = " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), '{SURROGATE_NULL}')" for c in cols)
    return f"md5({parts})"


def _dlist(xs) -> str:
    return "[" + ", ".join(repr(float(x)) for x in xs) + "]::DOUBLE[]"


def _half_up(num: str, den: str) -> str:
    """Integer num / den rounded half away from zero (den > 0), exact in HUGEINT."""
    return f"(sign({num}) * ((abs({num}) * 2 + ({den})) // (2 * ({den}))))"


def _dec_avg(col: str, scale: int, over: str = "", steps=(12, 6)) -> str:
    """avg() of a DECIMAL column as the Spark decimal average computes it.

    The quotient sum / count is rounded half-up at 12 places and then at each
    later scale in ``steps``; the result is returned as DOUBLE. ``scale`` is
    the column's own scale, ``over`` an optional window clause.
    """
    return _exact_avg(f"sum(CAST({col} * {10 ** scale} AS HUGEINT)){over}", f"count({col}){over}", scale, steps)


def _exact_avg(units: str, n: str, scale: int, steps=(12, 6)) -> str:
    """units / n rounded half-up at each scale of ``steps``; ``units`` counts 10^-scale."""
    v = _half_up(f"{units} * CAST({10 ** (steps[0] - scale)} AS HUGEINT)", n)
    prev = steps[0]
    for st in steps[1:]:
        v = _half_up(v, str(10 ** (prev - st)))
        prev = st
    return f"CASE WHEN {n} = 0 THEN NULL ELSE CAST({v} AS DOUBLE) / {float(10 ** prev)!r} END"


def _order_ts(k: str) -> str:
    return (f"make_timestamp(2024, 1, 1 + {k} % 30, ({k} // 30) % 24, ({k} // 720) % 60, 0.0)")


def _ppath(region: str, ts: str) -> str:
    return f"'region=' || {region} || '/date=' || strftime({ts}, '%Y-%m-%d') || '/hour=' || strftime({ts}, '%H')"


_W7 = " OVER (PARTITION BY region ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_SEED_VALUES = ", ".join(f"('{r}', '{c}', {o})" for r, c, o in SEED_REGIONS)

BASE_CTES = f"""
cust_nation AS (SELECT c_custkey, c_nationkey FROM customer),
raw_customer AS (
  SELECT customer_id, name, email, region,
         CASE WHEN c_acctbal >= 8000 THEN 'Gold' WHEN c_acctbal >= 4000 THEN 'Silver' ELSE 'Bronze' END AS tier,
         created_at, TIMESTAMP '2024-01-01 00:00:00' AS _loaded_at,
         'region=' || region || '/date=2024-01-01/hour=00' AS _source_file
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
               'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
               {_REG_LIST}[c_nationkey % 6 + 1] AS region, c_acctbal,
               CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at
        FROM customer)
  UNION ALL
  SELECT customer_id, name, email, region,
         CASE WHEN c_acctbal >= 6000 THEN 'GOLD' WHEN c_acctbal >= 2000 THEN 'SILVER' ELSE 'BRONZE' END AS tier,
         created_at, TIMESTAMP '2024-01-15 00:00:00' AS _loaded_at,
         'region=' || region || '/date=2024-01-15/hour=00' AS _source_file
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
               'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
               {_REG_LIST}[c_nationkey % 6 + 1] AS region, c_acctbal,
               CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at
        FROM customer WHERE c_custkey % 5 = 0)
),
raw_product AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
         p_retailprice AS unit_price, p_partkey % 10 <> 0 AS is_active,
         TIMESTAMP '2024-01-01 00:00:00' AS _loaded_at, 'date=2024-01-01/hour=00' AS _source_file
  FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), p_name || ' v2', p_type, p_retailprice, p_partkey % 10 <> 0 AND p_partkey % 40 <> 8,
         TIMESTAMP '2024-01-15 00:00:00', 'date=2024-01-15/hour=00'
  FROM part WHERE p_partkey % 4 = 0
),
order_lines AS (
  SELECT l_orderkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS line_cents FROM lineitem GROUP BY l_orderkey
),
order_base AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_orderpriority,
         {_REG_LIST}[c.c_nationkey % 6 + 1] AS region,
         coalesce(l.line_cents, CAST(round(o.o_totalprice * 100) AS BIGINT)) AS cents
  FROM orders o LEFT JOIN cust_nation c ON o.o_custkey = c.c_custkey
  LEFT JOIN order_lines l ON o.o_orderkey = l.l_orderkey
),
landing_clean AS (
  SELECT CAST(k AS VARCHAR) AS order_id,
         CASE WHEN k % 100 = 7 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         region,
         {_order_ts('k')} AS created_at,
         CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'P' THEN 'returned'
              WHEN k % 3 = 0 THEN 'pending' WHEN k % 3 = 1 THEN 'confirmed' ELSE 'shipped' END AS status,
         CASE WHEN k % 300 = 13 THEN 'XXX' ELSE {_case('region', REGION_CURRENCY)} END AS currency,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'PROMO' || CAST(k % 10 AS VARCHAR) END AS promo_code,
         CASE WHEN k % 200 = 3 THEN CAST(-abs(cents) AS DOUBLE) / 100.0
              WHEN k % 100 = 11 THEN CAST((cents * 115 + 50) // 100 AS DOUBLE) / 100.0
              ELSE CAST(cents AS DOUBLE) / 100.0 END AS total_amount,
         k % 50 = 0 AS _dup
  FROM order_base
),
landing_orders AS (
  SELECT * EXCLUDE (_dup) FROM landing_clean
  UNION ALL
  SELECT * EXCLUDE (_dup) FROM landing_clean WHERE _dup
),
raw_order AS (
  SELECT *, date_trunc('hour', created_at) + INTERVAL 1 HOUR AS _loaded_at,
         {_ppath('region', 'created_at')} AS _source_file
  FROM landing_orders
),
raw_order_item AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
           || '-' || CAST(l_suppkey AS VARCHAR) AS item_id,
         CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(amount_cents // CAST(l_quantity AS BIGINT) AS DOUBLE) / 100.0 AS unit_price,
         CAST(amount_cents AS DOUBLE) / 100.0 AS amount,
         date_trunc('hour', {_order_ts('l_orderkey')}) + INTERVAL 1 HOUR AS _loaded_at
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_cents FROM lineitem)
),
raw_marketing_event AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_id, CAST(e.user_id AS VARCHAR) AS customer_id,
         {_REG_LIST}[c.c_nationkey % 6 + 1] AS region,
         CASE WHEN e.event_type = 'view' THEN 'IMPRESSION' ELSE upper(e.event_type) END AS event_type,
         date_trunc('second', e.ts) AS created_at,
         date_trunc('hour', e.ts) + INTERVAL 1 HOUR AS _loaded_at,
         {_ppath(f'{_REG_LIST}[c.c_nationkey % 6 + 1]', 'e.ts')} AS _source_file
  FROM events e LEFT JOIN cust_nation c ON e.user_id = c.c_custkey
),
regions_seed AS (SELECT * FROM (VALUES {_SEED_VALUES}) t(region, continent, timezone_offset)),
stg_orders AS (
  SELECT order_id, customer_id, region, CAST(created_at AS TIMESTAMP) AS created_at, status, currency, promo_code,
         CAST(total_amount AS DECIMAL(18, 2)) AS total_amount, promo_code IS NOT NULL AS has_promo,
         _loaded_at, _source_file
  FROM raw_order WHERE order_id IS NOT NULL
),
stg_order_items AS (
  SELECT item_id, order_id, product_id, CAST(quantity AS INTEGER) AS quantity,
         CAST(unit_price AS DECIMAL(18, 2)) AS unit_price, CAST(amount AS DECIMAL(18, 2)) AS amount, _loaded_at
  FROM raw_order_item WHERE item_id IS NOT NULL AND order_id IS NOT NULL
),
stg_customers AS (
  SELECT customer_id, name, email, lower(region) AS region, lower(tier) AS tier,
         CAST(created_at AS TIMESTAMP) AS created_at, _loaded_at
  FROM raw_customer WHERE customer_id IS NOT NULL
),
stg_products AS (
  SELECT product_id, name, category, CAST(unit_price AS DECIMAL(18, 2)) AS unit_price,
         CAST(is_active AS BOOLEAN) AS is_active, _loaded_at
  FROM raw_product WHERE product_id IS NOT NULL
),
stg_marketing_events AS (
  SELECT event_id, customer_id, region, lower(event_type) AS event_type, CAST(created_at AS TIMESTAMP) AS created_at,
         CAST(created_at AS DATE) AS event_date, _loaded_at
  FROM raw_marketing_event WHERE event_id IS NOT NULL
),
customers_current AS (
  SELECT customer_id, arg_max(name, _loaded_at) AS name, arg_max(email, _loaded_at) AS email,
         arg_max(region, _loaded_at) AS region, arg_max(tier, _loaded_at) AS tier,
         arg_max(created_at, _loaded_at) AS created_at, max(_loaded_at) AS _loaded_at
  FROM stg_customers GROUP BY customer_id
),
products_current AS (
  SELECT product_id, arg_max(name, _loaded_at) AS name, arg_max(category, _loaded_at) AS category,
         arg_max(unit_price, _loaded_at) AS unit_price, arg_max(is_active, _loaded_at) AS is_active, max(_loaded_at) AS _loaded_at
  FROM stg_products GROUP BY product_id
),
dim_customers AS (
  SELECT {_sk('customer_id')} AS customer_key, *, _loaded_at IS NOT NULL AS is_current FROM customers_current
),
dim_products AS (
  SELECT {_sk('product_id')} AS product_key, * FROM products_current WHERE is_active
),
-- rows of the orders: what a customer's loads and the region's seed row say about each header
customer_facts AS (SELECT customer_id, email AS customer_email, tier AS customer_tier FROM customers_current),
int_orders_enriched AS (
  SELECT * EXCLUDE (_c, _r), CAST(created_at AS DATE) AS order_date, hour(created_at) AS order_hour
  FROM stg_orders LEFT JOIN (SELECT *, 1 AS _c FROM customer_facts) USING (customer_id)
  LEFT JOIN (SELECT *, 1 AS _r FROM regions_seed) USING (region)
),
fact_orders AS (
  SELECT {_sk('order_id')} AS order_key, * EXCLUDE (customer_tier), customer_tier AS tier,
         CASE WHEN customer_id IN (SELECT customer_id FROM raw_customer) THEN {_sk('customer_id')} END AS customer_key
  FROM int_orders_enriched
),
-- rows of the lines, weighed by the money of all rows of their order
product_facts AS (SELECT product_id, name AS product_name, category FROM products_current),
priced_lines AS (SELECT * FROM stg_order_items LEFT JOIN product_facts USING (product_id)),
int_order_items_enriched AS (
  SELECT l.*, l.amount / nullif(t.money, 0) AS revenue_contribution
  FROM priced_lines l JOIN (SELECT order_id, sum(amount) AS money FROM priced_lines GROUP BY order_id) t USING (order_id)
),
product_keys AS (SELECT product_id, product_key FROM dim_products),
header_copies AS (SELECT order_id, count(*) AS copies FROM raw_order GROUP BY order_id),
fact_order_items AS (
  SELECT {_sk('item_id')} AS item_key, i.*, CASE WHEN h.order_id IS NOT NULL THEN {_sk('i.order_id')} END AS order_key,
         k.product_key, unnest(range(CAST(coalesce(h.copies, 1) AS BIGINT))) AS _copy
  FROM int_order_items_enriched i LEFT JOIN header_copies h ON h.order_id = i.order_id
  LEFT JOIN product_keys k ON k.product_id = i.product_id
),
-- a region's day, straight from the landed rows: each header weighs as many rows as its customer has (one, or a load each)
customer_weight AS (
  SELECT customer_id, 1 AS n, CAST(arg_max(lower(tier), _loaded_at) = 'gold' AS BIGINT) AS gold
  FROM raw_customer GROUP BY customer_id
),
weighed AS (
  SELECT o.region, CAST(o.created_at AS DATE) AS day, o.customer_id, o.status, o.promo_code,
         CAST(round(o.total_amount * 100) AS HUGEINT) AS cents, coalesce(w.n, 1) AS n, coalesce(w.gold, 0) AS gold
  FROM raw_order o LEFT JOIN customer_weight w USING (customer_id)
),
region_day AS (
  SELECT region, day AS report_date, CAST(sum(n) AS BIGINT) AS total_orders,
         CAST(sum(cents * n) AS DOUBLE) / 100 AS gross_revenue,
         {_exact_avg('sum(cents * n)', 'CAST(sum(n) AS HUGEINT)', 2)} AS avg_order_value,
         count(DISTINCT customer_id) AS unique_customers,
         coalesce(sum(n) FILTER (status = 'returned'), 0) AS returned_orders,
         sum(gold) AS gold_customer_orders,
         CAST(coalesce(sum(n) FILTER (promo_code IS NOT NULL), 0) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS promo_order_pct,
         (SELECT any_value(continent) FROM regions_seed s WHERE s.region = weighed.region) AS continent
  FROM weighed GROUP BY region, day
),
funnel_day AS (
  SELECT region, CAST(created_at AS DATE) AS event_date, sum(CAST(upper(event_type) = 'IMPRESSION' AS BIGINT)) AS impressions,
         sum(CAST(upper(event_type) = 'CLICK' AS BIGINT)) AS clicks, sum(CAST(upper(event_type) = 'PURCHASE' AS BIGINT)) AS purchases
  FROM raw_marketing_event GROUP BY ALL
),
rpt_daily_kpis AS (
  SELECT d.*, CAST(returned_orders AS DOUBLE) / CAST(total_orders AS DOUBLE) AS return_rate,
         coalesce(f.impressions, 0) AS impressions, coalesce(f.clicks, 0) AS clicks, coalesce(f.purchases, 0) AS purchases,
         CAST(f.clicks AS DOUBLE) / nullif(f.impressions, 0) AS ctr,
         CAST(f.purchases AS DOUBLE) / nullif(f.clicks, 0) AS conversion_rate,
         gross_revenue / nullif(CAST(f.impressions AS DOUBLE), 0) AS revenue_per_impression,
         {_dec_avg('avg_order_value', 6, _W7, (12, 10, 6))} AS avg_order_value_7d_avg,
         {_dec_avg('gross_revenue', 2, _W7, (6,))} AS gross_revenue_7d_avg
  FROM region_day d LEFT JOIN (SELECT region AS f_region, * EXCLUDE (region) FROM funnel_day) f ON f_region = d.region AND event_date = report_date
),
line_totals AS (
  SELECT order_id, sum(amount) AS items_total, count(*) AS n_lines FROM stg_order_items GROUP BY order_id
),
batches AS (
  SELECT region, strftime(created_at, '%Y-%m-%d') AS date, strftime(created_at, '%H') AS hour FROM raw_order
)
"""


# the same graph with customers and products as loaded: a row, a weight or a key for each of their loads
_AS_LOADED = [
    ("customer_tier FROM customers_current", "customer_tier FROM stg_customers"),
    ("category FROM products_current)", "category FROM stg_products)"),
    ("product_key FROM dim_products)", f"{_sk('product_id')} FROM stg_products WHERE is_active)"),
    ("1 AS n, CAST(arg_max(lower(tier), _loaded_at) = 'gold' AS BIGINT) AS gold", "count(*) AS n, count_if(lower(tier) = 'gold') AS gold"),
    ("header_copies AS (SELECT order_id, count(*) AS copies FROM raw_order GROUP BY order_id)",
     "header_copies AS (SELECT order_id, sum(coalesce(n, 1)) AS copies FROM raw_order LEFT JOIN (SELECT customer_id, count(*) AS n "
     "FROM raw_customer GROUP BY 1) USING (customer_id) GROUP BY order_id)"),
]
BASE_CTES_AS_LOADED = BASE_CTES
for _old, _new in _AS_LOADED:
    assert BASE_CTES_AS_LOADED.count(_old) == 1, _old
    BASE_CTES_AS_LOADED = BASE_CTES_AS_LOADED.replace(_old, _new)
BASE_CTES_AS_LOADED = BASE_CTES_AS_LOADED.replace(f"product_keys AS (SELECT product_id, {_sk('product_id')} FROM", f"product_keys AS (SELECT product_id, {_sk('product_id')} AS product_key FROM")


def _cols(spec: str) -> str:
    """'a, b:f, c:i' -> conformed select list (f: round(double, 6), i: bigint)."""
    out = []
    for item in [s.strip() for s in spec.split(",") if s.strip()]:
        name, _, kind = item.partition(":")
        if kind == "f":
            out.append(f"round(CAST({name} AS DOUBLE), 6) AS {name}")
        elif kind == "i":
            out.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


def q(spec: str, body: str, extra_ctes: str = "", base: str = BASE_CTES) -> str:
    """WITH <base>[, extra] SELECT <conformed spec> FROM (<body>)."""
    ctes = base + (("," + extra_ctes) if extra_ctes else "")
    return f"WITH {ctes}\nSELECT {_cols(spec)} FROM ({body}) AS _q"


# ------------------------------------------------------------------ column specs
SPEC = {
    "landing": "order_id, customer_id, created_at, status, currency, promo_code, total_amount:f, region, date, hour",
    "stg_orders": "order_id, customer_id, region, created_at, status, currency, promo_code, total_amount:f, "
                  "has_promo, _loaded_at, _source_file",
    "stg_order_items": "item_id, order_id, product_id, quantity:i, unit_price:f, amount:f, _loaded_at",
    "stg_customers": "customer_id, name, email, region, tier, created_at, _loaded_at",
    "stg_products": "product_id, name, category, unit_price:f, is_active, _loaded_at",
    "stg_marketing_events": "event_id, customer_id, region, event_type, created_at, event_date, _loaded_at",
    "int_orders_enriched": "order_id, customer_id, region, created_at, order_date, order_hour:i, status, currency, "
                           "promo_code, total_amount:f, has_promo, _loaded_at, _source_file, customer_email, "
                           "customer_tier, continent, timezone_offset:i",
    "int_order_items_enriched": "item_id, order_id, product_id, quantity:i, unit_price:f, amount:f, _loaded_at, "
                                "product_name, category, revenue_contribution:f",
    "int_regional_daily": "region, order_date, total_orders:i, gross_revenue:f, avg_order_value:f, "
                          "unique_customers:i, returned_orders:i, return_rate:f, impressions:i, clicks:i, purchases:i",
    "dim_customers": "customer_key, customer_id, name, email, region, tier, created_at, _loaded_at, is_current",
    "dim_products": "product_key, product_id, name, category, unit_price:f, is_active, _loaded_at",
    "fact_orders": "order_key, order_id, customer_id, customer_key, region, order_date, order_hour:i, status, "
                   "currency, promo_code, has_promo, total_amount:f, continent, tier",
    "fact_order_items": "item_key, item_id, order_id, order_key, product_id, product_key, quantity:i, unit_price:f, "
                        "amount:f, revenue_contribution:f, product_name, category",
    "rpt_daily_kpis": "report_date, region, continent, total_orders:i, gross_revenue:f, avg_order_value:f, "
                      "unique_customers:i, returned_orders:i, return_rate:f, impressions:i, clicks:i, purchases:i, "
                      "ctr:f, conversion_rate:f, revenue_per_impression:f, gold_customer_orders:i, "
                      "promo_order_pct:f, avg_order_value_7d_avg:f, gross_revenue_7d_avg:f",
}


def _holiday_rows_sql() -> str:
    """Holiday calendar for every year in ``cal_years`` from the calendar rules, in DuckDB date arithmetic."""
    def nth(m, wd, n):  # python weekday numbering (Mon = 0); isodow - 1 gives it
        first = f"make_date(CAST(year AS BIGINT), {m}, 1)"
        return f"({first} + CAST((({wd} - (isodow({first}) - 1)) % 7 + 7) % 7 + {7 * (n - 1)} AS INTEGER))"

    def last(m, wd):
        ld = f"CAST(last_day(make_date(CAST(year AS BIGINT), {m}, 1)) AS DATE)"
        return f"({ld} - CAST(((isodow({ld}) - 1 - {wd}) % 7 + 7) % 7 AS INTEGER))"

    def date_of(name):
        if name == "thanksgiving":
            return nth(11, 3, 4)
        if name == "black_friday":
            return f"({nth(11, 3, 4)} + 1)"
        if name == "cyber_monday":
            return f"({nth(11, 3, 4)} + 4)"
        if name == "memorial_day":
            return last(5, 0)
        if name == "labor_day":
            return nth(9, 0, 1)
        m, d = FIXED_HOLIDAY_DATES[name]
        return f"make_date(CAST(year AS BIGINT), {m}, {d})"

    selects = []
    for region in REGIONS:
        for name, mult in HOLIDAY_MULTIPLIERS[HOLIDAY_GROUP[region]].items():
            selects.append(f"SELECT year, '{region}' AS region, '{name}' AS holiday_name, "
                           f"CAST({date_of(name)} AS DATE) AS holiday_date, CAST({float(mult)!r} AS DOUBLE) AS multiplier "
                           f"FROM cal_years")
        if region == GOLDEN_WEEK_REGION:
            m, d = GOLDEN_WEEK_START
            for i in range(GOLDEN_WEEK_DAYS):
                selects.append(
                    f"SELECT year, '{region}' AS region, 'golden_week_{i + 1}' AS holiday_name, "
                    f"CAST(make_date(CAST(year AS BIGINT), {m}, {d}) + {i} AS DATE) AS holiday_date, "
                    f"CAST({GOLDEN_WEEK_FIRST + GOLDEN_WEEK_STEP * i!r} AS DOUBLE) AS multiplier FROM cal_years")
    return "\nUNION ALL\n".join(selects)


_CAL_CTES = f"""
cal_years AS (
  SELECT DISTINCT y AS year FROM (
    SELECT unnest([yy - 1, yy, yy + 1]) AS y FROM (SELECT DISTINCT year(created_at) AS yy FROM stg_orders))
),
holiday_cal AS (
{_holiday_rows_sql()}
),
hour_grid AS (
  SELECT CAST(day AS TIMESTAMP) + to_hours(h) AS hour_ts, region
  FROM (SELECT DISTINCT CAST(created_at AS DATE) AS day FROM stg_orders), (SELECT unnest(range(24)) AS h), (SELECT unnest({_REG_LIST}) AS region)
),
hour_counts AS (
  SELECT region, date_trunc('hour', created_at) AS hour_ts, count(*) AS actual_orders FROM stg_orders GROUP BY 1, 2
),
hour_actuals AS (
  SELECT g.region, g.hour_ts, coalesce(c.actual_orders, 0) AS actual_orders
  FROM hour_grid g LEFT JOIN hour_counts c ON g.region = c.region AND g.hour_ts = c.hour_ts
),
hour_local AS (
  SELECT *, CAST(local_ts AS DATE) AS local_date, hour(local_ts) AS local_hour FROM (
    SELECT *, hour_ts + to_hours(CAST({_case('region', REGION_UTC_OFFSETS)} AS BIGINT)) AS local_ts FROM hour_actuals)
),
hour_expected AS (
  SELECT h.region, h.hour_ts, h.actual_orders, h.local_ts, h.local_hour,
         ({_dlist(INTRADAY_MULTIPLIERS)})[h.local_hour + 1] AS intraday_multiplier,
         ({_dlist(DOW_MULTIPLIERS)})[isodow(h.hour_ts)] AS dow_multiplier,
         ({_dlist(MONTHLY_MULTIPLIERS)})[month(h.hour_ts)] AS monthly_multiplier,
         coalesce(hc.holiday, 1.0) AS holiday_multiplier
  FROM hour_local h LEFT JOIN (SELECT region, holiday_date, max(multiplier) AS holiday FROM holiday_cal GROUP BY 1, 2) hc
    ON h.region = hc.region AND h.local_date = hc.holiday_date
),
hour_volume AS (
  SELECT *, CAST({float(BASE_ORDERS_PER_REGION_PER_HOUR)!r} AS DOUBLE) * intraday_multiplier * dow_multiplier
              * monthly_multiplier * holiday_multiplier AS expected_orders
  FROM hour_expected
)
"""


def _union_all(parts):
    return "\nUNION ALL\n".join(parts)


_EXPECTED_CCY = _case("region", REGION_CURRENCY)
_LOCAL_OFFSET = _case("region", REGION_UTC_OFFSETS, "BIGINT")


def _scorecard_body() -> str:
    issues = [("duplicate_order_rate", "duplicate"), ("null_customer_rate", "null_customer"),
              ("negative_revenue_rate", "negative"), ("revenue_mismatch_rate", "mismatch"),
              ("orphaned_items_rate", "orphan"), ("invalid_currency_rate", "bad_currency")]
    per = f"""
      SELECT p.order_id, p.n_copies > 1 AS duplicate, p.null_customer, p.min_total < 0 AS negative,
             EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = p.order_id AND o.total_amount >= 0
                     AND abs(o.total_amount - t.items_total) > 0.01) AS mismatch,
             t.items_total IS NULL AS orphan, p.bad_currency
      FROM (SELECT order_id, count(*) AS n_copies, bool_or(customer_id IS NULL) AS null_customer,
                   min(total_amount) AS min_total,
                   bool_or({_EXPECTED_CCY} IS NULL OR currency IS NULL OR currency <> {_EXPECTED_CCY}) AS bad_currency
            FROM stg_orders WHERE order_id IS NOT NULL GROUP BY order_id) p
      LEFT JOIN line_totals t ON p.order_id = t.order_id"""
    agg = ("SELECT count(*) AS n_orders, "
           + ", ".join(f"count_if({flag}) AS c_{flag}" for _, flag in issues) + f" FROM ({per}) f")
    rows = [f"SELECT '{issue}' AS issue, c_{flag} AS n_affected, n_orders, "
            f"CAST(c_{flag} AS DOUBLE) / CAST(n_orders AS DOUBLE) AS observed_rate, "
            f"CAST({DQ_RATES[issue]!r} AS DOUBLE) AS configured_rate FROM sc" for issue, flag in issues]
    return f"WITH sc AS ({agg}) " + _union_all(rows)


def build() -> dict[str, str]:
    s: dict[str, str] = {}
    landing_sel = ("SELECT order_id, customer_id, created_at, status, currency, promo_code, total_amount, region, "
                   "strftime(created_at, '%Y-%m-%d') AS date, strftime(created_at, '%H') AS hour FROM landing_orders")
    s["landing_scan"] = q(SPEC["landing"], landing_sel)
    s["audit_columns"] = q("order_id, region, date, hour, _source_file, whole_path, _loaded_at",
                           f"SELECT order_id, region, date, hour, 'region=' || region || '/date=' || date || '/hour=' || hour"
                           f" AS _source_file, true AS whole_path, {NOW} AS _loaded_at FROM ({landing_sel})")
    for entity, table, cols, at in [
            ("order_items", "raw_order_item", "item_id, order_id, product_id, quantity:i, unit_price:f, amount:f", "_loaded_at"),
            ("customers", "raw_customer", "customer_id, name, email, tier, created_at", "_loaded_at"),
            ("products", "raw_product", "product_id, name, category, unit_price:f, is_active", "_loaded_at"),
            ("marketing_events", "raw_marketing_event", "event_id, customer_id, event_type, created_at", "created_at")]:
        region = f"'{REGIONS[0]}' AS region, " if entity in ("order_items", "products") else ""
        landed = f"SELECT * EXCLUDE (_source_file), {region}strftime({at}, '%Y-%m-%d') AS date, strftime({at}, '%H') AS hour FROM {table}"
        landed = landed.replace(" EXCLUDE (_source_file)", "") if entity == "order_items" else landed
        s[f"landing_{entity}"] = q(f"{cols}, region, date, hour", landed)
        s[f"streaming_ingest_{entity}"] = q(f"{cols}, region, date, hour, _source_file",
                                            f"SELECT *, 'region=' || region || '/date=' || date || '/hour=' || hour AS _source_file FROM ({landed})")
    s["landing_one_hour"] = q(SPEC["landing"], f"SELECT * FROM ({landing_sel}) WHERE date = '2024-01-15' AND hour = '07'")
    s["landing_hour_rerun"] = q("order_id, region, total_amount:f, _loaded_at, date, hour", f"""
        SELECT *, TIMESTAMP '2024-01-15 00:00:00' + to_hours(CASE WHEN hour = '07' THEN 10 ELSE 9 END) AS _loaded_at
        FROM ({landing_sel}) WHERE date = '2024-01-15' AND hour IN ('07', '08')""")
    s["relanded_hours"] = q("order_id, region, total_amount:f, date, hour, _loaded_at", f"""
        SELECT order_id, region, total_amount * CASE WHEN date = '2024-01-15' THEN 2 ELSE 1 END AS total_amount, date, '00' AS hour,
               {NOW} + to_hours(CASE WHEN date IN ('2024-01-15', '2024-01-20') THEN 1 ELSE 0 END) AS _loaded_at
        FROM ({landing_sel}) WHERE NOT (date = '2024-01-20' AND region = '{REGIONS[0]}')""")
    s["foreign_backfill"] = q(
        "order_id, customer_id, region, created_at, status, currency, promo_code, total_amount:f, date, _loaded_at", f"""
        SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 11 = 0 THEN 'lunar-1' ELSE region END AS region,
                          CASE WHEN CAST(right(date, 2) AS INTEGER) % 3 <> 1 THEN promo_code END AS promo_code),
               CAST(date AS TIMESTAMP) + INTERVAL 1 HOUR AS _loaded_at
        FROM ({landing_sel}) WHERE region IS NOT NULL""")
    s["audit_history"] = q("dag_run_id, load_date, load_hour, region, entity, s3_expected_rows:i, sf_actual_rows:i", f"""
        SELECT r.dag_run_id, DATE '2024-01-15' AS load_date, hour AS load_hour, region, 'orders' AS entity, count(*) AS s3_expected_rows,
               count(*) AS sf_actual_rows
        FROM ({landing_sel}) o JOIN (VALUES ('run-a', '07'), ('run-a', '08'), ('run-b', '07')) r (dag_run_id, h) ON o.hour = r.h
        WHERE date = '2024-01-15' GROUP BY r.dag_run_id, hour, region""")
    s["unpublished_attempt"] = q("version:i, region, order_date, total_orders:i", f"""
        SELECT v AS version, region, report_date AS order_date, CASE WHEN v = 2 AND region = '{REGIONS[1]}' THEN 0 ELSE total_orders END AS total_orders
        FROM region_day, (VALUES (1), (2)) t (v)""")
    s["footer_gates"] = q("source, n_rows:i, max_loaded_at, age_hours:f, status", f"""
        SELECT *, CASE WHEN age_hours > 6 THEN 'error' WHEN age_hours > 2 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT *, (epoch_us({NOW}) - epoch_us(max_loaded_at)) / 3.6e9 AS age_hours
              FROM ({_union_all([f"SELECT '{t}' AS source, count(*) AS n_rows, max(_loaded_at) AS max_loaded_at FROM {t}" for t in
                                 ["raw_order", "raw_order_item", "raw_customer", "raw_product", "raw_marketing_event"]])}))""")
    s["file_manifest"] = q("date, region, present, expected, has_bytes", f"""
        SELECT date, region, CASE WHEN date < '2024-01-29' THEN EXISTS (SELECT 1 FROM ({landing_sel}) o WHERE o.date = a.date AND o.region = a.region)
                                  ELSE date = '2024-01-29' AND region = '{REGIONS[2]}' END AS present, true AS expected, true AS has_bytes
        FROM (SELECT strftime(t, '%Y-%m-%d') AS date, unnest({_REG_LIST}) AS region
              FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 00:00:00', INTERVAL 1 DAY)) AS t)) a""")
    s["lines_without_header"] = q("order_id, item_id", """
        SELECT i.order_id, i.item_id FROM raw_order_item i
        WHERE NOT EXISTS (SELECT 1 FROM landing_orders o WHERE o.order_id = i.order_id AND CAST(o.order_id AS BIGINT) % 40 NOT IN (1, 2))""")
    s["model_views"] = q("region, report_date, gross_revenue:f, n_orders:i, largest_order:f", """
        SELECT k.region, k.report_date, k.gross_revenue, count(*) AS n_orders, max(o.total_amount) AS largest_order
        FROM rpt_daily_kpis k JOIN fact_orders o ON o.region = k.region AND o.order_date = k.report_date
        WHERE k.total_orders > 0 GROUP BY ALL""")
    s["nanos_to_timestamp"] = q("event_id:i, nanos:i, ts", "SELECT event_id, epoch_us(ts) * 1000 + event_id % 1000 AS nanos, ts FROM events")
    s["union_regions"] = q("region, date, hour, n_rows:i, total_amount:f",
                           f"SELECT region, date, hour, count(*) AS n_rows, sum(total_amount) AS total_amount "
                           f"FROM ({landing_sel}) GROUP BY region, date, hour")
    s["copy_load_projection"] = q(
        "order_id, customer_id, region, created_at, status, currency, promo_code, total_amount:f, _source_file",
        f"SELECT *, 'region=' || region || '/date=' || date || '/hour=' || hour AS _source_file FROM ({landing_sel})")
    s["copy_load_entities"] = q("entity, outcome, n_rows:i", _union_all(
        [f"SELECT '{e}' AS entity, unnest(['loaded', 'rejected']) AS outcome, unnest([count_if(NOT {k} LIKE '%77'), "
         f"count_if({k} LIKE '%77')]) AS n_rows FROM {t}"
         for e, t, k in [("orders", "raw_order", "order_id"), ("order_items", "raw_order_item", "item_id"),
                         ("customers", "raw_customer", "customer_id"), ("products", "raw_product", "product_id"),
                         ("marketing_events", "raw_marketing_event", "event_id")]]))
    broken = "CAST(order_id AS BIGINT) % 40 IN (1, 2)"
    s["load_rejects"] = q("order_id, customer_id, region, created_at, status, currency, promo_code, total_amount, date, hour", f"""
        SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 40 = 2 THEN 'yesterday' ELSE strftime(created_at, '%Y-%m-%d %H:%M:%S') END AS created_at,
                          CASE WHEN CAST(order_id AS BIGINT) % 40 = 1 THEN 'n/a' ELSE CAST(CAST(total_amount AS DECIMAL(18, 2)) AS VARCHAR) END AS total_amount)
        FROM ({landing_sel}) WHERE {broken}""")
    s["load_audit"] = q("dag_run_id, load_date, region, entity, s3_expected_rows:i, sf_actual_rows:i",
                        "SELECT 'run-2024-01-31' AS dag_run_id, CAST(created_at AS DATE) AS load_date, region, "
                        f"'orders' AS entity, count(*) AS s3_expected_rows, count_if(NOT {broken}) AS sf_actual_rows "
                        "FROM landing_orders GROUP BY 2, 3")
    s["seed_regions"] = q("region, continent, timezone_offset:i, n_orders:i, n_customers:i, in_seed", """
        SELECT coalesce(so.region, c.region) AS region, so.continent, so.timezone_offset,
               coalesce(so.n_orders, 0) AS n_orders, coalesce(c.n_customers, 0) AS n_customers,
               coalesce(so.in_seed, false) AS in_seed
        FROM (SELECT coalesce(s.region, o.region) AS region, s.continent, s.timezone_offset, o.n_orders, s.in_seed
              FROM (SELECT *, true AS in_seed FROM regions_seed) s
              FULL JOIN (SELECT region, count(*) AS n_orders FROM stg_orders GROUP BY region) o
                ON s.region IS NOT DISTINCT FROM o.region) so
        FULL JOIN (SELECT region, count(*) AS n_customers FROM customers_current GROUP BY region) c
          ON so.region IS NOT DISTINCT FROM c.region""")
    s["row_count_by_load_date"] = q("table_name, load_date, n_rows:i", _union_all([
        f"SELECT '{t}' AS table_name, CAST(_loaded_at AS DATE) AS load_date, count(*) AS n_rows FROM {t} GROUP BY 2"
        for t in ["raw_order", "raw_order_item", "raw_customer", "raw_product", "raw_marketing_event"]]))
    s["freshness_check"] = q("n_recent:i, passed",
                             f"SELECT n_recent, n_recent > 0 AS passed FROM (SELECT count_if(_loaded_at >= {NOW} - "
                             f"INTERVAL 2 HOUR) AS n_recent FROM raw_order)")
    s["source_freshness"] = q("source, max_loaded_at, age_hours:f, status", f"""
        SELECT source, max_loaded_at, age_hours,
               CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_hours > 6 THEN 'error'
                    WHEN age_hours > 2 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT source, max_loaded_at, (epoch_us({NOW}) - epoch_us(max_loaded_at)) / 3.6e9 AS age_hours
              FROM ({_union_all([f"SELECT '{t}' AS source, max(_loaded_at) AS max_loaded_at FROM {t}" for t in
                                 ["raw_order", "raw_order_item", "raw_customer", "raw_product", "raw_marketing_event"]])}))""")
    s["safe_divide"] = q(
        "region, order_date, total_orders:i, returned_orders:i, promo_orders:i, gold_orders:i, return_rate:f, "
        "promo_per_gold:f, returns_per_gold:f", """
        SELECT *, CASE WHEN total_orders = 0 THEN 0.0 ELSE CAST(returned_orders AS DOUBLE) / total_orders END AS return_rate,
               CASE WHEN gold_orders = 0 THEN 0.0 ELSE CAST(promo_orders AS DOUBLE) / gold_orders END AS promo_per_gold,
               CAST(returned_orders AS DOUBLE) / nullif(CAST(gold_orders AS DOUBLE), 0) AS returns_per_gold
        FROM (SELECT region, order_date, count(order_id) AS total_orders,
                     count_if(status = 'returned') AS returned_orders, count_if(has_promo) AS promo_orders,
                     count_if(customer_tier = 'gold') AS gold_orders
              FROM int_orders_enriched GROUP BY region, order_date)""")
    s["funnel_rates"] = q("region, event_date, impressions:i, clicks:i, purchases:i, ctr:f, conversion_rate:f", """
        SELECT *, CAST(clicks AS DOUBLE) / nullif(CAST(impressions AS DOUBLE), 0) AS ctr,
               CAST(purchases AS DOUBLE) / nullif(CAST(clicks AS DOUBLE), 0) AS conversion_rate
        FROM funnel_day""")
    s["surrogate_key"] = q("order_id, customer_id, order_key, order_customer_key",
                           f"SELECT order_id, customer_id, {_sk('order_id')} AS order_key, "
                           f"{_sk('order_id', 'customer_id')} AS order_customer_key FROM stg_orders")
    s["line_amount_check"] = q(
        "item_id, order_id, quantity:i, unit_price:f, amount:f, expected_amount:f, difference:f", """
        SELECT *, amount - expected_amount AS difference FROM (
          SELECT item_id, order_id, quantity, unit_price, amount,
                 round(CAST(quantity AS DECIMAL(18, 0)) * unit_price, 2) AS expected_amount FROM stg_order_items)
        WHERE abs(amount - expected_amount) > 0.01""")
    for m in ["stg_orders", "stg_order_items", "stg_customers", "stg_products", "stg_marketing_events",
              "int_orders_enriched", "int_order_items_enriched", "dim_customers",
              "dim_products", "fact_orders", "fact_order_items", "rpt_daily_kpis"]:
        s[m] = q(SPEC[m], f"SELECT * FROM {m}")
    s["int_regional_daily"] = q(SPEC["int_regional_daily"], "SELECT *, report_date AS order_date FROM rpt_daily_kpis")
    s["materialised_kpis"] = s["rpt_daily_kpis_from_landing"] = s["rpt_daily_kpis"]
    s["fact_order_items_as_loaded"] = q(SPEC["fact_order_items"], "SELECT * FROM fact_order_items", base=BASE_CTES_AS_LOADED)
    s["int_orders_enriched_as_loaded"] = q(SPEC["int_orders_enriched"], "SELECT * FROM int_orders_enriched",
                                           base=BASE_CTES_AS_LOADED)
    s["rpt_daily_kpis_as_loaded"] = q(SPEC["rpt_daily_kpis"], "SELECT * FROM rpt_daily_kpis", base=BASE_CTES_AS_LOADED)
    s["orders_daily_agg"] = q("region, order_date, total_orders:i, gross_revenue:f, avg_order_value:f, "
                              "returned_orders:i, unique_customers:i", "SELECT *, report_date AS order_date FROM region_day")
    s["marketing_daily_agg"] = q("region, event_date, impressions:i, clicks:i, purchases:i", "SELECT * FROM funnel_day")
    s["order_mix_daily"] = q("region, order_date, continent, gold_customer_orders:i, promo_order_pct:f",
                             "SELECT *, report_date AS order_date FROM region_day")
    s["order_totals_from_items"] = q("order_id, items_total:f, n_lines:i", "SELECT * FROM line_totals")
    s["latest_by_key"] = q("customer_id, name, email, region, tier, created_at, _loaded_at, _source_file", """
        SELECT c.* FROM raw_customer c WHERE _loaded_at = (SELECT max(_loaded_at) FROM raw_customer n WHERE n.customer_id = c.customer_id)""")
    s["revenue_contribution"] = q("item_id, order_id, amount:f, revenue_contribution:f", "SELECT * FROM int_order_items_enriched")
    s["rolling_7row_avg"] = q(
        "region, order_date, avg_order_value:f, gross_revenue:f, avg_order_value_7d_avg:f, gross_revenue_7d_avg:f", f"""
        SELECT region, order_date, avg_order_value, gross_revenue,
               avg_order_value_7d_avg, gross_revenue_7d_avg
        FROM (SELECT *, report_date AS order_date FROM rpt_daily_kpis)""")
    s["deterministic_sample"] = q("_source_file, order_id, customer_id, region, total_amount:f", f"""
        SELECT _source_file, order_id, customer_id, region, total_amount FROM (
          SELECT *, row_number() OVER (PARTITION BY _source_file ORDER BY md5(order_id || '42'), order_id) AS rn,
                 count(*) OVER (PARTITION BY _source_file) AS n
          FROM stg_orders)
        WHERE rn <= greatest(1, CAST(round_even(CAST(n AS DOUBLE) * CAST({DQ_RATES['duplicate_order_rate']!r} AS DOUBLE), 0) AS BIGINT))""")
    s["check_not_null"] = q("model, column_name, n_null:i, n_rows:i, passed", _union_all([
        f"SELECT '{m}' AS model, '{c}' AS column_name, count_if({c} IS NULL) AS n_null, count(*) AS n_rows, "
        f"count_if({c} IS NULL) = 0 AS passed FROM {m}" for m, cols in NOT_NULL_TESTS.items() for c in cols]))
    s["check_unique"] = q("model, column_name, value, n_rows:i", _union_all([
        f"SELECT '{m}' AS model, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM {m} "
        f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1" for m, c in UNIQUE_TESTS]))
    s["check_accepted_values"] = q("model, column_name, value, n_rows:i", _union_all([
        f"SELECT '{m}' AS model, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM {m} "
        f"WHERE {c} IS NOT NULL AND {c} NOT IN ({', '.join(repr(v) for v in vals)}) GROUP BY {c}"
        for m, c, vals in ACCEPTED_TESTS]))
    funnel = ("SELECT report_date, region, impressions, clicks, purchases FROM rpt_daily_kpis "
              "WHERE greatest(clicks - impressions, purchases - clicks) > 0")
    lineless = "SELECT order_id FROM raw_order WHERE order_id NOT IN (SELECT order_id FROM raw_order_item)"
    # joined row by row, a header's total meets each line once for every header of the order and every copy of the total
    unequal = """SELECT order_id, total_amount, alike * copies * items_total AS items_total
        FROM (SELECT order_id, total_amount, count(*) AS alike FROM stg_orders GROUP BY ALL) JOIN header_copies USING (order_id)
        JOIN line_totals USING (order_id) WHERE abs(total_amount - alike * copies * items_total) > 0.01"""
    tests = []
    for m, cols in NOT_NULL_TESTS.items():
        for c in cols:
            tests.append(f"SELECT 'not_null.{m}.{c}' AS test_id, 'not_null' AS kind, '{m}' AS model, "
                         f"'{c}' AS column_name, count_if({c} IS NULL) AS failures FROM {m}")
    for m, c in UNIQUE_TESTS:
        tests.append(f"SELECT 'unique.{m}.{c}', 'unique', '{m}', '{c}', count(*) FROM (SELECT {c} FROM {m} "
                     f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    for m, c, vals in ACCEPTED_TESTS:
        tests.append(f"SELECT 'accepted_values.{m}.{c}', 'accepted_values', '{m}', '{c}', count(*) FROM ("
                     f"SELECT DISTINCT {c} FROM {m} WHERE {c} IS NOT NULL AND {c} NOT IN "
                     f"({', '.join(repr(v) for v in vals)}))")
    tests.append("SELECT 'revenue_reconciliation.fact_orders', 'model', 'fact_orders', 'total_amount', "
                 "CASE WHEN (SELECT sum(total_amount) FROM fact_orders) = (SELECT sum(total_amount) FROM stg_orders) "
                 "THEN 0 ELSE 1 END")
    tests.append("SELECT 'gross_revenue_not_negative.rpt_daily_kpis', 'model', 'rpt_daily_kpis', 'gross_revenue', "
                 "count(*) FROM rpt_daily_kpis WHERE gross_revenue < 0")
    tests.append(f"SELECT 'test_funnel_monotonicity', 'singular', 'rpt_daily_kpis', NULL, count(*) FROM ({funnel})")
    tests.append(f"SELECT 'test_no_orphaned_orders', 'singular', 'fact_orders', NULL, count(*) FROM ({lineless})")
    tests.append(f"SELECT 'test_revenue_reconciliation', 'singular', 'fact_orders', NULL, count(*) FROM ({unequal})")
    s["data_tests"] = q("test_id, kind, model, column_name, failures:i, status",
                        "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
                        + _union_all(tests) + ")")
    s["check_funnel_monotonicity"] = q("report_date, region, impressions:i, clicks:i, purchases:i", funnel)
    s["check_no_orphaned_orders"] = q("order_id", lineless)
    s["check_revenue_reconciliation"] = q("order_id, total_amount:f, items_total:f", unequal)
    s["check_total_reconciliation"] = q("model_total:f, staged_total:f, difference:f, passed", """
        SELECT model_total, staged_total, model_total - staged_total AS difference, model_total = staged_total AS passed
        FROM (SELECT (SELECT sum(total_amount) FROM fact_orders) AS model_total,
                     (SELECT sum(total_amount) FROM stg_orders) AS staged_total)""")
    s["check_revenue_not_negative"] = q("model, day, region, order_id, revenue:f", """
        SELECT 'rpt_daily_kpis' AS model, report_date AS day, region, NULL AS order_id, gross_revenue AS revenue
        FROM rpt_daily_kpis WHERE gross_revenue < 0
        UNION ALL
        SELECT 'fact_orders', CAST(created_at AS DATE), region, order_id, total_amount FROM raw_order WHERE total_amount < 0""")
    s["non_empty_load"] = q("table_name, load_date, n_rows:i, passed", _union_all([
        f"SELECT '{t}' AS table_name, DATE '2024-01-15' AS load_date, count(*) AS n_rows, count(*) > 0 AS passed FROM {t} "
        f"WHERE CAST(_loaded_at AS DATE) = DATE '2024-01-15'"
        for t in ["raw_order", "raw_order_item", "raw_customer", "raw_product", "raw_marketing_event"]]))
    asked = f"""
        SELECT strftime(t, '%Y-%m-%d') AS date, strftime(t, '%H') AS hour, unnest({_REG_LIST}) AS region
        FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', {NOW}, INTERVAL 1 HOUR)) AS t)"""
    present = f"SELECT a.*, (SELECT count(*) FROM batches b WHERE b.date = a.date AND b.hour = a.hour AND b.region = a.region) AS n_rows FROM ({asked}) a"
    s["region_manifest"] = q("date, hour, region, n_rows:i, present, expected",
                             f"SELECT *, n_rows > 0 AS present, true AS expected FROM ({present})")
    s["hour_completeness"] = q("date, hour, n_regions:i, is_complete, missing_regions, unexpected_regions", f"""
        SELECT date, hour, count_if(n_rows > 0) AS n_regions, bool_and(n_rows > 0) AS is_complete,
               coalesce(string_agg(region, ',' ORDER BY region) FILTER (n_rows = 0), '') AS missing_regions, '' AS unexpected_regions
        FROM ({present}) GROUP BY date, hour""")
    s["referential_subset"] = q("product_id, item_id", """
        SELECT i.product_id, i.item_id FROM raw_order_item i
        WHERE NOT coalesce((SELECT arg_max(is_active, _loaded_at) FROM raw_product p WHERE p.product_id = i.product_id), false)""")
    s["dq_duplicate_orders"] = q("order_id, n_copies:i, customer_id, region, total_amount:f", """
        SELECT o.order_id, d.n_copies, o.customer_id, o.region, o.total_amount
        FROM stg_orders o JOIN (SELECT order_id, count(*) AS n_copies FROM stg_orders WHERE order_id IS NOT NULL
                                GROUP BY order_id HAVING count(*) > 1) d ON o.order_id = d.order_id""")
    s["dq_null_customer"] = q("order_id, region, total_amount:f",
                              "SELECT order_id, region, total_amount FROM stg_orders WHERE customer_id IS NULL")
    s["dq_negative_revenue"] = q("order_id, region, total_amount:f",
                                 "SELECT order_id, region, total_amount FROM stg_orders WHERE total_amount < 0")
    s["dq_revenue_mismatch"] = q("order_id, total_amount:f, items_total:f, n_lines:i, header_to_lines:f", """
        SELECT o.order_id, o.total_amount, t.items_total, t.n_lines,
               CAST(o.total_amount AS DOUBLE) / nullif(CAST(t.items_total AS DOUBLE), 0) AS header_to_lines
        FROM stg_orders o JOIN line_totals t ON o.order_id = t.order_id
        WHERE o.total_amount >= 0 AND abs(o.total_amount - t.items_total) > 0.01""")
    s["dq_orphan_orders"] = q("order_id, region, total_amount:f", """
        SELECT o.order_id, o.region, o.total_amount FROM stg_orders o
        WHERE NOT EXISTS (SELECT 1 FROM stg_order_items i WHERE i.order_id = o.order_id)""")
    s["dq_invalid_currency"] = q("order_id, region, currency, expected_currency", f"""
        SELECT order_id, region, currency, expected_currency FROM (
          SELECT *, {_EXPECTED_CCY} AS expected_currency FROM stg_orders)
        WHERE expected_currency IS NULL OR currency IS NULL OR currency <> expected_currency""")
    s["dq_scorecard"] = q("issue, n_affected:i, n_orders:i, observed_rate:f, configured_rate:f", _scorecard_body())
    s["local_time_orders"] = q(
        "order_id, region, created_at, utc_offset:i, local_ts, local_date, local_hour:i", f"""
        SELECT order_id, region, created_at, utc_offset, local_ts, CAST(local_ts AS DATE) AS local_date,
               hour(local_ts) AS local_hour
        FROM (SELECT order_id, region, created_at, {_LOCAL_OFFSET} AS utc_offset,
                     created_at + to_hours({_LOCAL_OFFSET}) AS local_ts FROM stg_orders)""")
    s["holiday_calendar"] = q("year:i, region, holiday_name, holiday_date, multiplier:f",
                              "SELECT * FROM holiday_cal", _CAL_CTES)
    s["expected_volume"] = q(
        "region, hour_ts, local_ts, local_hour:i, intraday_multiplier:f, dow_multiplier:f, monthly_multiplier:f, "
        "holiday_multiplier:f, expected_orders:f, lower_bound:f, upper_bound:f", """
        SELECT *, expected_orders * CAST(0.85 AS DOUBLE) AS lower_bound, expected_orders * CAST(1.15 AS DOUBLE) AS upper_bound
        FROM hour_volume""", _CAL_CTES)
    s["volume_anomaly"] = q(
        "region, hour_ts, local_hour:i, actual_orders:i, expected_orders:f, lower_bound:f, upper_bound:f, "
        "is_anomaly, deviation:f, has_baseline", """
        SELECT region, hour_ts, local_hour, actual_orders, expected_orders, lower_bound, upper_bound, true AS has_baseline,
               actual_orders < lower_bound - 0.5 OR actual_orders > upper_bound + 0.5 AS is_anomaly,
               CAST(actual_orders AS DOUBLE) / expected_orders - 1 AS deviation
        FROM (SELECT *, expected_orders * CAST(0.85 AS DOUBLE) AS lower_bound,
                     expected_orders * CAST(1.15 AS DOUBLE) AS upper_bound FROM hour_volume)""", _CAL_CTES)
    s["tests_while_writing"] = s["data_tests"]
    s["streaming_ingest"] = q(
        "order_id, customer_id, region, created_at, status, currency, promo_code, total_amount:f, date, hour, "
        "_source_file",
        f"SELECT *, 'region=' || region || '/date=' || date || '/hour=' || hour AS _source_file FROM ({landing_sel})")
    return s


ORACLE_SQL = build()
