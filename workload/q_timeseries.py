"""Wealth, trailing windows, as-of joins and the benchmark fit."""

from pyspark.sql import functions as F

from navloom.operators import timeseries as ts
from navloom.sources import raw
from workload import bindings as b
from workload.registry import query

DAY = "DATE '2001-06-30'"


def nav_cte(key: str = "l_suppkey", source: str = "lineitem", as_of: str = DAY) -> str:
    return f"""daily AS (
  SELECT lpad(CAST({key} AS VARCHAR), 6, '0') AS code, CAST(l_shipdate AS DATE) AS date,
    max(l_extendedprice / l_quantity) AS nav, max(l_discount) AS disc, round(max(l_tax) * 100) AS tax
  FROM {source} GROUP BY 1, 2),
factors AS (
  SELECT code, date, nav, prev,
    CASE WHEN prev IS NULL THEN NULL WHEN disc >= 0.095 THEN (nav + tax) / prev
      WHEN disc < 0.005 THEN 1 + tax / 100 ELSE nav / prev END AS factor
  FROM (SELECT *, lag(nav) OVER (PARTITION BY code ORDER BY date) AS prev
        FROM daily WHERE date <= {as_of})),
wealth AS (
  SELECT code, date, exp(sum(ln(coalesce(factor, 1))) OVER (PARTITION BY code ORDER BY date)) AS wealth,
    max(date) OVER (PARTITION BY code) AS last_date
  FROM factors)"""


NATIONS = "(lineitem JOIN supplier ON l_suppkey = s_suppkey)"


def window_cte(years: int, name: str = "win") -> str:
    return f"""anchor_{name} AS (
  SELECT code, max(CASE WHEN date <= last_date - INTERVAL {years} YEAR THEN date END) AS anchor
  FROM wealth GROUP BY code),
rebased_{name} AS (
  SELECT w.code, w.date, w.wealth / a0.wealth AS g
  FROM wealth w JOIN anchor_{name} a USING (code)
  JOIN wealth a0 ON a0.code = w.code AND a0.date = a.anchor WHERE w.date >= a.anchor),
peaks_{name} AS (
  SELECT *, max(g) OVER (PARTITION BY code ORDER BY date) AS peak FROM rebased_{name}),
{name} AS (
  SELECT code, min(date) AS start_date, max(date) AS end_date,
    round((arg_max(g, date) - 1) * 100, 2) AS ret, round(min(g / peak - 1) * 100, 2) AS dd
  FROM peaks_{name} GROUP BY code)"""


@query("win01_daily_factor", f"""WITH {nav_cte()}
SELECT code, date, round(factor, 6) AS factor FROM factors""")
def daily_factor(spark, sf):
    return ts.daily_factor(b.nav_by_supplier(spark, sf), as_of=b.AS_OF).select(
        "code", "date", F.round("factor", 6).alias("factor"))


@query("win02_wealth_series", f"""WITH {nav_cte()}
SELECT code, date, round(ln(wealth), 6) + 0.0 AS log_wealth FROM wealth""")
def wealth_series(spark, sf):
    return ts.wealth_series(b.nav_by_supplier(spark, sf), as_of=b.AS_OF).select(
        "code", "date", (F.round(F.ln("wealth"), 6) + 0.0).alias("log_wealth"))


@query("win03_drawdown_series", f"""WITH {nav_cte()}, {window_cte(3)}
SELECT code, date, round(g / peak - 1, 4) + 0.0 AS drawdown FROM peaks_win""")
def drawdown_series(spark, sf):
    return ts.drawdown_series(b.nav_by_supplier(spark, sf), as_of=b.AS_OF, years=3).select(
        "code", "date", (F.round("drawdown", 4) + 0.0).alias("drawdown"))


@query("win05_anchors", f"""WITH {nav_cte()}
SELECT code, max(date) AS last_date,
  max(CASE WHEN date <= last_date - INTERVAL 1 YEAR THEN date END) AS one_year_anchor,
  max(CASE WHEN date <= last_date - INTERVAL 3 YEAR THEN date END) AS three_year_anchor,
  max(CASE WHEN date <= last_date - INTERVAL 5 YEAR THEN date END) AS five_year_anchor,
  max(CASE WHEN date <= last_date - INTERVAL 10 YEAR THEN date END) AS ten_year_anchor
FROM wealth GROUP BY code""")
def anchors(spark, sf):
    return ts.anchors(b.nav_by_supplier(spark, sf), as_of=b.AS_OF)


@query("ag02_trailing_return", f"""WITH {nav_cte()}, {window_cte(3)}
SELECT code, start_date, end_date, ret AS return_pct FROM win""")
def trailing_return(spark, sf):
    return ts.trailing_return(b.nav_by_supplier(spark, sf), as_of=b.AS_OF, years=3)


@query("ag03_max_drawdown", f"""WITH {nav_cte()}, {window_cte(3)}
SELECT code, dd AS max_drawdown_pct FROM win""")
def max_drawdown(spark, sf):
    return ts.max_drawdown(b.nav_by_supplier(spark, sf), as_of=b.AS_OF, years=3)


_HORIZONS = {1: "one_year", 3: "three_year", 5: "five_year", 10: "ten_year"}
RECORD_CTE = ", ".join(window_cte(years, name) for years, name in _HORIZONS.items())
RECORD_COLUMNS = ", ".join(
    f"{n}.ret AS {n}_return_pct, {n}.dd AS {n}_max_drawdown_pct, "
    f"{n}.start_date AS {n}_performance_start_date, {n}.end_date AS {n}_performance_end_date"
    for n in _HORIZONS.values())
RECORD_JOINS = " ".join(f"LEFT JOIN {n} ON {n}.code = h.code" for n in _HORIZONS.values())


@query("ag19_performance_record", f"""WITH {nav_cte()}, {RECORD_CTE},
h AS (SELECT code, min(date) AS nav_history_start_date, max(date) AS nav_history_end_date
      FROM wealth GROUP BY code)
SELECT h.*, {RECORD_COLUMNS} FROM h {RECORD_JOINS}""")
def performance_record(spark, sf):
    return ts.performance_record(b.nav_by_supplier(spark, sf), as_of=b.AS_OF).drop("factor_issue_count")


@query("fn05_return_drawdown_ratio", f"""WITH {nav_cte()}, {window_cte(3)},
s AS (SELECT code, dd, CASE WHEN ret > -100 THEN (power(1 + ret / 100, 365.0 / date_diff('day', start_date, end_date)) - 1) * 100 END AS yearly
      FROM win)
SELECT code, round(yearly, 4) AS annualized_pct, round(yearly / nullif(abs(dd), 0), 4) AS drawdown_ratio FROM s""")
def score(spark, sf):
    from navloom.operators.eligibility import with_score

    record = ts.performance_record(b.nav_by_supplier(spark, sf), as_of=b.AS_OF)
    scored = with_score(record.where("three_year_return_pct is not null"))
    return scored.select("code", F.round("annualized_pct", 4).alias("annualized_pct"),
                         F.round("drawdown_ratio", 4).alias("drawdown_ratio"))


@query("ag01_weekly_last", f"""WITH {nav_cte('s_nationkey', NATIONS)}
SELECT code, CAST(date_trunc('week', date) AS DATE) AS week, max(date) AS date,
  round(ln(arg_max(wealth, date)), 6) + 0.0 AS log_wealth
FROM wealth WHERE date >= last_date - INTERVAL 3 YEAR GROUP BY 1, 2""")
def weekly_last(spark, sf):
    weekly = ts.weekly_last(ts.wealth_series(b.nav_by_nation(spark, sf), as_of=b.AS_OF))
    return weekly.select("code", "week", "date", (F.round(F.ln("wealth"), 6) + 0.0).alias("log_wealth"))


@query("jn03_asof_index", """WITH shipped AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS code, CAST(l_shipdate AS DATE) AS date, count(*) AS lines
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
placed AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS code, CAST(o_orderdate AS DATE) AS src, max(o_totalprice) AS v
  FROM orders GROUP BY 1, 2)
SELECT s.code, s.date, CAST(s.lines AS BIGINT) AS lines,
  CASE WHEN date_diff('day', p.src, s.date) <= 7 THEN p.src END AS source_date,
  CASE WHEN date_diff('day', p.src, s.date) <= 7 THEN p.v END AS asof_value
FROM shipped s ASOF LEFT JOIN placed p ON s.code = p.code AND s.date >= p.src""")
def asof_index(spark, sf):
    """The latest order of a customer in the seven days up to each shipment."""
    orders = b.table(spark, sf, "orders")
    placed = orders.groupBy(b.code_of("o_custkey").alias("code"), F.expr("cast(o_orderdate as date)").alias("date")) \
        .agg(F.max("o_totalprice").alias("value"))
    lines = b.table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    joined = lines.join(orders.select("o_orderkey", "o_custkey"), lines.l_orderkey == orders.o_orderkey)
    shipped = joined.groupBy(b.code_of("o_custkey").alias("code"), F.expr("cast(l_shipdate as date)").alias("date")) \
        .agg(F.count(F.lit(1)).alias("lines"))
    return ts.asof_join(shipped, placed, on="date", by=["code"])


def bench_cte(as_of: str = DAY) -> str:
    return f"""idx AS (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS i,
    min(o_totalprice) / 1000 AS f FROM orders GROUP BY 1),
weekly AS (SELECT code, CAST(date_trunc('week', date) AS DATE) AS week, max(date) AS date,
    arg_max(wealth, date) AS wealth FROM wealth WHERE date >= last_date - INTERVAL 3 YEAR GROUP BY 1, 2),
aligned AS (SELECT w.*, x.i * x.f AS level FROM weekly w ASOF JOIN idx x ON w.date >= x.date
    WHERE date_diff('day', x.date, w.date) <= 7),
pairs AS (SELECT code, week, pweek, pdate AS start_date, date AS end_date, wealth / pwealth - 1 AS fr,
    level / plevel - 1 AS br
  FROM (SELECT *, lag(week) OVER o AS pweek, lag(date) OVER o AS pdate, lag(wealth) OVER o AS pwealth,
          lag(level) OVER o AS plevel FROM aligned WINDOW o AS (PARTITION BY code ORDER BY week))
  WHERE date_diff('day', pweek, week) = 7),
stats AS (SELECT code, count(*) AS n, min(start_date) AS start_date, max(end_date) AS end_date,
    covar_samp(fr, br) AS c, var_samp(fr) AS vf, var_samp(br) AS vb, stddev_samp(fr - br) AS sd
  FROM pairs GROUP BY code)"""


def fit_select(min_obs: int = 140, min_span: int = 1000) -> str:
    ok = f"n >= {min_obs} AND date_diff('day', start_date, end_date) >= {min_span} AND vf > 0 AND vb > 0"
    return f"""SELECT code, CASE WHEN {ok} THEN round(c / sqrt(vf * vb), 4) END AS correlation,
  CASE WHEN {ok} THEN round(c / vb, 4) END AS beta,
  CASE WHEN {ok} THEN round(sd * sqrt(52) * 100, 2) END AS tracking_error_pct,
  CAST(n AS BIGINT) AS observations, start_date, end_date,
  CASE WHEN n < {min_obs} THEN 'too_few_observations'
    WHEN date_diff('day', start_date, end_date) < {min_span} THEN 'span_too_short'
    WHEN vf <= 0 OR vb <= 0 THEN 'zero_variance' END AS fit_error FROM stats"""


@query("jn04_benchmark_level", f"""WITH {nav_cte('s_nationkey', NATIONS)}, {bench_cte()}
SELECT code, week, date, round(level, 4) AS level FROM aligned""")
def benchmark_level(spark, sf):
    weekly = ts.weekly_last(ts.wealth_series(b.nav_by_nation(spark, sf), as_of=b.AS_OF))
    aligned = ts.benchmark_level(weekly, b.index_levels(spark, sf), b.fx_rates(spark, sf))
    return aligned.select("code", "week", "date", F.round("level", 4).alias("level"))


@query("win04_weekly_returns", f"""WITH {nav_cte('s_nationkey', NATIONS)}, {bench_cte()}
SELECT code, start_date, end_date, round(fr, 4) AS fund_return, round(br, 4) AS benchmark_return FROM pairs""")
def weekly_returns(spark, sf):
    weekly = ts.weekly_last(ts.wealth_series(b.nav_by_nation(spark, sf), as_of=b.AS_OF))
    pairs = ts.weekly_returns(ts.benchmark_level(weekly, b.index_levels(spark, sf), b.fx_rates(spark, sf)))
    return pairs.select("code", "start_date", "end_date", F.round("fund_return", 4).alias("fund_return"),
                        F.round("benchmark_return", 4).alias("benchmark_return"))


@query("ag04_benchmark_fit", f"""WITH {nav_cte('s_nationkey', NATIONS)}, {bench_cte()} {fit_select()}""")
def benchmark_fit(spark, sf):
    return ts.benchmark_fit(
        b.nav_by_nation(spark, sf), b.index_levels(spark, sf), b.fx_rates(spark, sf), as_of=b.AS_OF)


@query("ag05_fit_gates", f"""WITH {nav_cte('s_nationkey', NATIONS)}, {bench_cte()},
g AS ({fit_select(150, 1080)})
SELECT coalesce(fit_error, 'ok') AS fit_error, CAST(count(*) AS BIGINT) AS funds,
  CAST(sum(observations) AS BIGINT) AS observations FROM g GROUP BY 1""")
def fit_gates(spark, sf):
    fit = ts.benchmark_fit(b.nav_by_nation(spark, sf), b.index_levels(spark, sf), b.fx_rates(spark, sf),
                           as_of=b.AS_OF, min_observations=150, min_span_days=1080)
    return fit.groupBy(F.coalesce("fit_error", F.lit("ok")).alias("fit_error")).agg(
        F.count(F.lit(1)).alias("funds"), F.sum("observations").alias("observations"))


@query("ag12_series_conflicts", """SELECT CAST(o_orderdate AS DATE) AS date, min(o_totalprice) AS low,
  max(o_totalprice) AS high FROM orders GROUP BY 1 HAVING max(o_totalprice) - min(o_totalprice) > 1e-9""")
def series_conflicts(spark, sf):
    points = b.table(spark, sf, "orders").selectExpr("cast(o_orderdate as date) as date", "o_totalprice as value")
    return raw.series_conflicts(points)


@query("ag13_series_coverage", """WITH s AS (SELECT min(CAST(o_orderdate AS DATE)) AS first_date,
  max(CAST(o_orderdate AS DATE)) AS last_date FROM orders WHERE o_orderdate <= DATE '2001-06-30')
SELECT first_date, last_date, first_date <= DATE '1998-06-30' - 14 + 7 AS covered,
  date_diff('day', last_date, DATE '2001-06-30') <= 7 AS fresh FROM s""")
def series_coverage(spark, sf):
    return ts.series_coverage(b.index_levels(spark, sf), as_of=b.AS_OF)


@query("win08_check_monotonic", """WITH p AS (SELECT conv_id, turn, CAST(DATE '2024-01-01' + CAST(length(text) % 400 AS INTEGER) AS DATE) AS date
  FROM conversations), n AS (SELECT *, lead(date) OVER (PARTITION BY conv_id ORDER BY turn) AS next_date FROM p)
SELECT CAST(conv_id AS VARCHAR) AS code, CAST(turn AS BIGINT) AS seq, date, next_date FROM n WHERE next_date <= date""")
def check_monotonic(spark, sf):
    """Turns as stored positions; the length of a text stands for its date."""
    points = b.table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("code"), F.col("turn").cast("long").alias("seq"),
        F.expr("date_add(date'2024-01-01', length(text) % 400)").alias("date"))
    return ts.check_monotonic(points)


@query("jn11_reconcile_nav", f"""WITH {nav_cte()},
pages AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS code,
  CASE WHEN s_acctbal >= 0 THEN max(CAST(l_shipdate AS DATE)) ELSE DATE '2001-06-28' END AS page_date,
  arg_max(CASE WHEN s_nationkey < 12 THEN -1 ELSE 0 END, l_shipdate) AS bump
  FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE l_shipdate <= {DAY} GROUP BY s_suppkey, s_acctbal, s_nationkey),
v AS (SELECT p.code, p.page_date, p.bump, f.nav,
  (SELECT max(date) FROM factors x WHERE x.code = p.code) AS series_date
  FROM pages p LEFT JOIN factors f ON f.code = p.code AND f.date = p.page_date)
SELECT code, page_date, CASE WHEN nav IS NULL THEN
    CASE WHEN date_diff('day', series_date, page_date) BETWEEN 1 AND 7 THEN 'page_lead' ELSE 'missing' END
  WHEN bump < 0 THEN 'mismatch' ELSE 'ok' END AS status FROM v""")
def reconcile_nav(spark, sf):
    """Pages show the last NAV of a supplier, some off by one or on a fixed day."""
    nav = b.nav_by_supplier(spark, sf)
    known = ts.visible(nav, b.AS_OF, "date")
    suppliers = b.table(spark, sf, "supplier").select(
        b.code_of("s_suppkey").alias("code"), "s_acctbal", "s_nationkey")
    last = known.groupBy("code").agg(F.max("date").alias("last"))
    shown = suppliers.join(last, "code").withColumn(
        "latest_nav_date", F.expr("case when s_acctbal >= 0 then last else date'2001-06-28' end"))
    priced = shown.join(nav.select("code", F.col("date").alias("latest_nav_date"), "nav"),
                        ["code", "latest_nav_date"], "left")
    pages = priced.withColumn(
        "latest_nav_value", F.expr("coalesce(nav, 1D) + case when s_nationkey < 12 then 1D else 0D end"))
    got = ts.reconcile_nav(nav, pages, as_of=b.AS_OF, reloaded=True)
    return got.select("code", "page_date", "status")


@query("src12_merge_series", """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS v FROM orders GROUP BY 1),
l AS (SELECT CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS v FROM lineitem GROUP BY 1)
SELECT coalesce(l.date, o.date) AS date, coalesce(l.v, o.v) AS value FROM o FULL OUTER JOIN l ON o.date = l.date
WHERE coalesce(l.date, o.date) BETWEEN DATE '1998-06-30' - 21 AND DATE '2001-06-30'""")
def merge_series(spark, sf):
    landed = b.table(spark, sf, "lineitem").groupBy(F.expr("cast(l_shipdate as date)").alias("date")).agg(
        F.max("l_extendedprice").alias("value"))
    return raw.merge_series(b.index_levels(spark, sf), landed, b.AS_OF)
