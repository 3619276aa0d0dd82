"""ANSI-SQL twins of the registered queries, for a second engine.

Each twin is assembled from named common table expressions. They state the
semantics in the plainest way (dense grids by cross product, framed windows),
independently of how the Spark plans get there.
"""

from __future__ import annotations

from foldcast.functions.columns import z_value
from foldcast.sources import bindings as B

TRIPS = """trips AS (
  SELECT l.l_shipdate AS event_ts, l.l_partkey AS unit_id,
         o.n_nationkey AS origin_id, o.n_name AS origin_name, o.n_regionkey AS origin_region,
         d.n_nationkey AS dest_id, d.n_name AS dest_name, d.n_regionkey AS dest_region,
         regexp_replace(lower(o.n_name), '[^a-z0-9-]', '', 'g') || '_' ||
         regexp_replace(lower(d.n_name), '[^a-z0-9-]', '', 'g') AS series
  FROM lineitem l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation o ON c_nationkey = o.n_nationkey
  JOIN nation d ON s_nationkey = d.n_nationkey)"""

PANEL = TRIPS + """,
panel AS (
  SELECT CAST(date_trunc('week', event_ts) AS DATE) AS period, series,
         min(origin_id) AS origin_id, min(origin_region) AS origin_region,
         min(dest_id) AS dest_id, min(dest_region) AS dest_region,
         min(origin_name) AS origin_name, min(dest_name) AS dest_name,
         count(unit_id) AS qty
  FROM trips GROUP BY 1, 2)"""

TOTAL = """panel AS (
  SELECT 'total' AS series, CAST(date_trunc('week', l_shipdate) AS DATE) AS period,
         count(l_partkey) AS qty
  FROM lineitem GROUP BY 2)"""

ORIGIN = PANEL.replace("panel AS", "od_panel AS") + """,
panel AS (
  SELECT origin_name AS series, period, CAST(sum(qty) AS BIGINT) AS qty
  FROM od_panel GROUP BY 1, 2)"""

def dense(ctes: str, end: str) -> str:
    """Zero-fill ``panel`` of ``ctes`` from each series' first period to ``end``."""
    return ctes.replace("\npanel AS", "\nsparse AS") + f""",
panel AS (
  SELECT g.series, g.period, CAST(coalesce(s.qty, 0) AS BIGINT) AS qty
  FROM (SELECT series, CAST(unnest(generate_series(min(period), {end}, INTERVAL 7 DAY))
               AS DATE) AS period FROM sparse GROUP BY series) g
  LEFT JOIN sparse s ON g.series = s.series AND g.period = s.period)"""


DENSE = dense(PANEL, f"DATE '{B.LAST_PERIOD}'")
DENSE_ORIGIN = dense(ORIGIN, "max(period)")

DAILY = """panel AS (
  SELECT CAST(user_id AS VARCHAR) AS series, CAST(ts AS DATE) AS period,
         count(event_id) AS qty
  FROM events GROUP BY 1, 2)"""

ORDERS_PANEL = """panel AS (
  SELECT CAST(o_custkey AS VARCHAR) || '_' || o_orderpriority AS series,
         CAST(date_trunc('week', o_orderdate) AS DATE) AS period, count(o_orderkey) AS qty
  FROM orders GROUP BY 1, 2)"""

PARTS = """panel AS (
  SELECT CAST(l_partkey AS VARCHAR) AS series,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS period, count(l_orderkey) AS qty
  FROM lineitem GROUP BY 1, 2)"""

BOUNDS = """bounds AS (
  SELECT CAST(date_trunc('week', min(l_shipdate)) AS DATE) AS first_period,
         CAST(date_trunc('week', max(l_shipdate)) AS DATE) AS last_period
  FROM lineitem)"""


def rain(period: str) -> str:
    return (f"(CAST(date_diff('day', DATE '{B.FIRST_PERIOD}', {period}) // 7 AS BIGINT)"
            f" * 37 + 11) % 101 / 100.0")


WEATHER = BOUNDS + f""",
weather AS (
  SELECT period, {rain('period')} AS percentage_rain
  FROM (SELECT CAST(unnest(generate_series(first_period, last_period, INTERVAL 7 DAY))
                    AS DATE) AS period FROM bounds))"""


def folds(rolling: B.Rolling) -> str:
    """The fold list of a rolling setting."""
    step = rolling.step if rolling.step is not None else rolling.horizon
    span = 7 * rolling.horizon
    return f"""folds AS (
  SELECT DATE '{rolling.train_start}' AS train_start_date, test_start_date,
         test_start_date + {span} AS test_end_date, test_start_date - {span} AS val_start_date,
         CAST(floor(date_diff('day', DATE '{rolling.train_start}', test_start_date - {span})
              / 7.0) AS INTEGER) AS train_length,
         CAST({rolling.horizon} AS INTEGER) AS test_length,
         CAST({rolling.horizon} AS INTEGER) AS val_length,
         CAST(row_number() OVER (ORDER BY test_start_date) - 1 AS INTEGER) AS fold
  FROM (SELECT CAST(unnest(generate_series(DATE '{rolling.test_start}',
               DATE '{rolling.test_end}', INTERVAL {7 * step} DAY)) AS DATE)
               AS test_start_date))"""


def labelled(rolling: B.Rolling) -> str:
    return folds(rolling) + """,
labelled AS (
  SELECT p.series, p.period, p.qty, f.fold,
         CASE WHEN period < val_start_date THEN 'TRAIN'
              WHEN period >= val_start_date AND period < test_start_date THEN 'VALIDATE'
              WHEN period >= test_start_date AND period < test_end_date THEN 'TEST'
         END AS split
  FROM panel p CROSS JOIN folds f)"""


def scaffold(days: int = 7, align: bool = True, end_inclusive: bool = True) -> str:
    """Scaffold dates and their actuals; expects ``panel`` and ``folds``."""
    start = "test_start_date"
    if align and days == 7:
        start = "CAST(date_trunc('week', test_start_date + 6) AS DATE)"
    end = "test_end_date" if end_inclusive else "test_end_date - 1"
    return f"""dates AS (
  SELECT fold, test_start_date, test_end_date,
         CAST(unnest(generate_series({start}, {end}, INTERVAL {days} DAY)) AS DATE) AS period
  FROM folds),
scaffold AS (
  SELECT d.fold, s.series, d.test_start_date, d.test_end_date, d.period
  FROM (SELECT DISTINCT series FROM panel) s CROSS JOIN dates d),
hist AS (
  SELECT s.fold, s.series, s.period, s.test_start_date, coalesce(p.qty, 0) AS qty
  FROM scaffold s
  LEFT JOIN (SELECT f.fold, p.series, p.period, p.qty FROM panel p JOIN folds f
             ON p.period >= f.test_start_date AND p.period < f.test_end_date) p
    ON s.fold = p.fold AND s.series = p.series AND s.period = p.period)"""


SEASONAL_NAIVE = """forecasts AS (
  SELECT f.fold, p.series, CAST(p.period + 364 AS DATE) AS period,
         'forecast' AS time_series_type, CAST(p.qty AS DOUBLE) AS forecast_value,
         CAST(NULL AS DOUBLE) AS prediction_interval_lower_bound,
         CAST(NULL AS DOUBLE) AS prediction_interval_upper_bound
  FROM panel p JOIN folds f ON p.period < f.test_start_date
   AND p.period + 364 >= f.test_start_date AND p.period + 364 < f.test_end_date)"""


def clamp(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN 0.0 WHEN {value} < 0 THEN 0.0 ELSE {value} END"


def dashboard(model: str, run: str, days: int = 7) -> str:
    """Dashboard rows; expects ``hist`` and ``forecasts``."""
    return f"""dashboard AS (
  SELECT *, actualQty - forecastQty AS diff, abs(actualQty - forecastQty) * actualQty AS wAbsError,
         actualQty * actualQty AS wHist
  FROM (
    SELECT h.period, h.series, h.qty AS actualQty,
           CAST({clamp('f.forecast_value')} AS DOUBLE) AS forecastQty,
           CAST({clamp('f.prediction_interval_lower_bound')} AS DOUBLE) AS predicted_p10,
           CAST({clamp('f.prediction_interval_upper_bound')} AS DOUBLE) AS predicted_p90,
           '{model}' AS model_name, '{run}' AS run_id, h.fold,
           round(date_diff('day', h.test_start_date, h.period) / {days}.0) AS lag
    FROM hist h LEFT JOIN (SELECT * FROM forecasts WHERE time_series_type = 'forecast') f
      ON h.fold = f.fold AND h.series = f.series AND h.period = f.period))"""


def eval_rows(days: int = 7) -> str:
    """Evaluation rows; expects ``panel``, ``folds`` and ``forecasts``."""
    return f"""eval AS (
  SELECT *, actual_value - forecast_value_filled AS diff,
         abs(actual_value - forecast_value_filled) * actual_value AS wAbsError,
         actual_value * actual_value AS wHist,
         abs(actual_value - forecast_value_filled) * actual_value * 100.0
           / nullif(actual_value * actual_value, 0) AS wMAPE,
         round(date_diff('day', test_start_date, period) / {days}.0) AS lag
  FROM (
    SELECT a.fold, a.series AS a_series, a.period, a.actual_value, a.test_start_date,
           a.test_end_date, f.series, f.period AS f_period, f.time_series_type,
           f.forecast_value, f.prediction_interval_lower_bound,
           f.prediction_interval_upper_bound,
           CAST({clamp('f.forecast_value')} AS DOUBLE) AS forecast_value_filled
    FROM (SELECT fold, series, period, test_start_date, test_end_date,
                 CAST(qty AS BIGINT) AS actual_value
          FROM (SELECT series, period, sum(qty) AS qty FROM panel GROUP BY 1, 2)
          CROSS JOIN folds) a
    LEFT JOIN forecasts f
      ON a.fold = f.fold AND a.series = f.series AND a.period = f.period))"""


#: Both sides of actuals and forecasts; expects ``panel``, ``folds`` and ``forecasts``.
FULL_EVAL = f"""full_eval AS (
  SELECT *, coalesce(actual_value, 0) - forecast_value_filled AS diff,
         abs(coalesce(actual_value, 0) - forecast_value_filled) * coalesce(actual_value, 0)
           AS wAbsError,
         coalesce(actual_value, 0) * coalesce(actual_value, 0) AS wHist,
         round(date_diff('day', test_start_date, period) / 7.0) AS lag
  FROM (
    SELECT k.*, d.test_start_date, d.test_end_date
    FROM (
      SELECT coalesce(a.fold, f.fold) AS fold, coalesce(a.series, f.series) AS series,
             coalesce(a.period, f.period) AS period,
             CASE WHEN f.fold IS NULL THEN 'actual' WHEN a.fold IS NULL THEN 'forecast'
                  ELSE 'both' END AS side,
             a.actual_value, f.time_series_type, f.forecast_value,
             f.prediction_interval_lower_bound, f.prediction_interval_upper_bound,
             CAST({clamp('f.forecast_value')} AS DOUBLE) AS forecast_value_filled
      FROM (SELECT fold, series, period, CAST(qty AS BIGINT) AS actual_value
            FROM (SELECT series, period, sum(qty) AS qty FROM panel GROUP BY 1, 2)
            CROSS JOIN folds) a
      FULL JOIN forecasts f
        ON a.fold = f.fold AND a.series = f.series AND a.period = f.period) k
    JOIN folds d ON k.fold = d.fold))"""


WMAPE = "CAST(sum(wAbsError) AS DOUBLE) * 100.0 / nullif(CAST(sum(wHist) AS DOUBLE), 0)"
SUITE = f"""{WMAPE} AS wMAPE,
       avg(abs(diff) / nullif(actual_value, 0)) AS MAPE, avg(abs(diff)) AS MAE,
       sum(abs(diff)) / nullif(CAST(sum(actual_value) AS DOUBLE), 0) AS pMAE,
       avg(diff * diff) AS MSE, sqrt(avg(diff * diff)) AS RMSE,
       sqrt(avg(diff * diff)) / nullif(avg(actual_value), 0) AS pRMSE"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def rounded(columns: str, digits: int = 6) -> str:
    return ", ".join(f"CAST(round(CAST(({c.strip()}) AS DECIMAL(28, {digits + 4})), {digits}) AS DOUBLE) AS {c.strip()}" for c in columns.split(","))


# --- time-series analysis ----------------------------------------------------------------


def decompose(model: str = "multiplicative", season: int = 52) -> str:
    """Decomposition of ``panel``; expects regular periods."""
    half = season // 2
    if model == "multiplicative":
        detrended, seasonal = "qty / nullif(trend, 0)", "a.phase_avg / nullif(m.mean, 0)"
        resid = "qty / nullif(trend, 0) / nullif(seasonal, 0)"
    else:
        detrended, seasonal, resid = "qty - trend", "a.phase_avg - m.mean", "qty - trend - seasonal"
    return f"""d1 AS (
  SELECT series, period, qty,
    CASE WHEN count(qty) OVER (PARTITION BY series ORDER BY period
                               ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) = {season + 1}
      THEN (2 * sum(qty) OVER (PARTITION BY series ORDER BY period
                               ROWS BETWEEN {half - 1} PRECEDING AND {half - 1} FOLLOWING)
            + lag(qty, {half}) OVER (PARTITION BY series ORDER BY period)
            + lead(qty, {half}) OVER (PARTITION BY series ORDER BY period))
           / {2.0 * season} END AS trend,
    (row_number() OVER (PARTITION BY series ORDER BY period) - 1) % {season} AS phase
  FROM panel),
d_phase AS (SELECT series, phase, avg({detrended}) AS phase_avg FROM d1 GROUP BY 1, 2),
d_mean AS (SELECT series, avg(phase_avg) AS mean FROM d_phase GROUP BY 1),
decomposed AS (
  SELECT *, {resid} AS resid
  FROM (SELECT d.series, d.period, d.qty, d.trend, {seasonal} AS seasonal
        FROM d1 d JOIN d_phase a ON d.series = a.series AND d.phase = a.phase
        JOIN d_mean m ON d.series = m.series))"""


TYPICAL = """profile AS (
  SELECT series, CAST(extract('week' FROM period) AS INTEGER) AS week_of_year,
         avg(seasonal) AS seasonal
  FROM decomposed GROUP BY 1, 2)"""


def lowess(frac: float = 0.4, iters: int = 3) -> str:
    """Smoothing of ``profile``; the last round is ``smooth``."""
    parts = [f"""pairs AS (
  SELECT *, row_number() OVER (PARTITION BY series, x0 ORDER BY d, x) AS rn
  FROM (SELECT a.series, CAST(a.week_of_year AS DOUBLE) AS x0, a.seasonal AS y0,
               CAST(b.week_of_year AS DOUBLE) AS x, b.seasonal AS y,
               CAST(abs(a.week_of_year - b.week_of_year) AS DOUBLE) AS d,
               count(*) OVER (PARTITION BY a.series, a.week_of_year) AS n
        FROM profile a JOIN profile b ON a.series = b.series)),
near AS (
  SELECT *, max(d) OVER (PARTITION BY series, x0) AS radius
  FROM pairs WHERE rn <= floor({frac} * n + 1e-10)),
robust0 AS (SELECT series, CAST(week_of_year AS DOUBLE) AS x, 1.0 AS r FROM profile)"""]
    for i in range(iters + 1):
        parts.append(f"""weights{i} AS (
  SELECT n.series, n.x0, n.y0, n.x - n.x0 AS dx, n.y,
         CASE WHEN n.d < n.radius THEN pow(1 - pow(n.d / n.radius, 3), 3) * r.r ELSE 0 END AS w
  FROM near n JOIN robust{i} r ON n.series = r.series AND n.x = r.x),
moments{i} AS (
  SELECT series, x0, y0, sum(w * dx) / sum(w) AS mx, sum(w * y) / sum(w) AS my,
         sum(w * dx * dx) / sum(w) AS mxx, sum(w * dx * y) / sum(w) AS mxy
  FROM weights{i} GROUP BY 1, 2, 3),
fit{i} AS (
  SELECT series, x0 AS x, y0 AS y,
         my - mx * (mxy - mx * my) / greatest(mxx - mx * mx, 1e-12) AS fit
  FROM moments{i}),
scale{i} AS (SELECT series, 6 * median(abs(y - fit)) AS s FROM fit{i} GROUP BY 1),
robust{i + 1} AS (
  SELECT f.series, f.x,
         CASE WHEN s = 0 THEN CASE WHEN y = fit THEN 1.0 ELSE 0.0 END
              ELSE pow(1 - pow(least(abs(y - fit) / s, 1), 2), 2) END AS r
  FROM fit{i} f JOIN scale{i} s ON f.series = s.series)""")
    parts.append(f"""smooth AS (
  SELECT series, CAST(x AS INTEGER) AS week_of_year, CAST(round(CAST((y) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS seasonal,
         CAST(round(CAST((fit) AS DECIMAL(28, 10)), 6) AS DOUBLE) AS smoothed FROM fit{iters})""")
    return ",\n".join(parts)


def holidays(start: str, end: str, source: str) -> str:
    """Holidays between two dates of ``source``, by rule."""
    def nth(month: int, isodow: int, which: int) -> str:
        first = f"make_date(y, {month}, 1)"
        return (f"{first} + CAST(({isodow} - isodow({first}) + 7) % 7 + {7 * (which - 1)}"
                f" AS INTEGER)")

    last_may = "make_date(y, 5, 31)"
    rules = [
        ("GLOBAL", "New Year", "make_date(y, 1, 1)"),
        ("GLOBAL", "Christmas", "make_date(y, 12, 25)"),
        ("GLOBAL", "Easter", "easter"),
        ("US", "Independence Day", "make_date(y, 7, 4)"),
        ("US", "Veterans Day", "make_date(y, 11, 11)"),
        ("US", "Martin Luther King Day", nth(1, 1, 3)),
        ("US", "Presidents Day", nth(2, 1, 3)),
        ("US", "Labor Day", nth(9, 1, 1)),
        ("US", "Columbus Day", nth(10, 1, 2)),
        ("US", "Thanksgiving", nth(11, 4, 4)),
        ("US", "Memorial Day", f"{last_may} - CAST((isodow({last_may}) + 6) % 7 AS INTEGER)"),
    ]
    union = "\n  UNION ALL ".join(
        f"SELECT '{name}' AS holiday, '{region}' AS region, {day} AS day FROM easters"
        for region, name, day in rules)
    return f"""years AS (
  SELECT CAST(unnest(generate_series(CAST(year({start}) AS BIGINT),
                                     CAST(year({end}) AS BIGINT))) AS BIGINT) AS y
  FROM {source}),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS t FROM e3),
easters AS (SELECT y, make_date(y, t // 31, t % 31 + 1) AS easter FROM e4),
holidays AS (
  SELECT holiday, region, CAST(day AS DATE) AS day,
         CAST(date_trunc('week', day) AS DATE) AS period
  FROM ({union})
  WHERE day BETWEEN (SELECT {start} FROM {source}) AND (SELECT {end} FROM {source}))"""


# --- ARIMA -------------------------------------------------------------------------------


def holiday_periods(rolling: B.Rolling) -> str:
    """One holiday per period over all the folds' dates."""
    dates = f"""span AS (SELECT DATE '{rolling.train_start}' AS a,
  DATE '{rolling.test_end}' + {7 * rolling.horizon} AS b)"""
    return dates + ",\n" + holidays("a", "b", "span") + """,
hol AS (SELECT period, min(holiday) AS holiday FROM holidays GROUP BY 1)"""


def arima_grid(rolling: B.Rolling) -> str:
    """Training and test rows; expects sparse ``panel``, ``folds`` and ``hol``."""
    return f"""grid AS (
  SELECT g.series, g.first, g.period, coalesce(p.qty, 0) AS qty
  FROM (SELECT series, min(period) AS first, CAST(unnest(generate_series(min(period),
               DATE '{rolling.test_end}' + {7 * rolling.horizon - 1}, INTERVAL 7 DAY)) AS DATE)
               AS period FROM panel GROUP BY series) g
  LEFT JOIN panel p ON g.series = p.series AND g.period = p.period),
r0 AS (
  SELECT g.series, f.fold, g.period, f.test_start_date, CAST(g.qty AS DOUBLE) AS actual,
         CASE WHEN g.period < f.test_start_date THEN CAST(g.qty AS DOUBLE) END AS y,
         CAST(date_diff('day', g.first, g.period) // 7 + 1 AS INTEGER) AS t,
         h.holiday, {rain('g.period')} AS x
  FROM grid g JOIN folds f ON g.period < f.test_end_date AND g.first < f.test_start_date
  LEFT JOIN hol h ON g.period = h.period)"""


def arima(regression: bool = False) -> str:
    """The closed-form models from ``r0``; ``explained`` holds history and forecasts."""
    slope = """
    CASE WHEN var_pop(CASE WHEN y IS NOT NULL THEN x END) OVER k > 1e-9
         THEN covar_pop(y, CASE WHEN y IS NOT NULL THEN x END) OVER k
              / var_pop(CASE WHEN y IS NOT NULL THEN x END) OVER k ELSE 0 END * x"""
    return f"""r1 AS (
  SELECT *, y - regressor AS u, (t - 1) % 52 AS phase
  FROM (SELECT *, count(y) OVER k AS n, {slope if regression else "CAST(0 AS DOUBLE)"} AS regressor
        FROM r0 WINDOW k AS (PARTITION BY series, fold))),
r2 AS (
  SELECT *, CASE WHEN count(u) OVER s53 = 53
    THEN u - (2 * sum(u) OVER s51 + lag(u, 26) OVER o + lead(u, 26) OVER o) / 104.0 END AS dt
  FROM r1
  WINDOW o AS (PARTITION BY series, fold ORDER BY period),
    s51 AS (PARTITION BY series, fold ORDER BY period ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING),
    s53 AS (PARTITION BY series, fold ORDER BY period ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING)),
ph AS (SELECT series, fold, phase, avg(dt) AS raw FROM r2 GROUP BY 1, 2, 3),
pm AS (SELECT series, fold, avg(raw) AS mean FROM ph GROUP BY 1, 2),
r3 AS (
  SELECT r.*, CASE WHEN n >= 104 THEN coalesce(raw - mean, 0.0) ELSE 0.0 END AS seasonal
  FROM r2 r JOIN ph USING (series, fold, phase) JOIN pm USING (series, fold)),
he AS (SELECT series, fold, holiday, avg(dt - seasonal) AS effect FROM r3
       WHERE holiday IS NOT NULL GROUP BY 1, 2, 3),
r4 AS (
  SELECT r.*, coalesce(effect, 0.0) AS holiday_effect,
         u - seasonal - coalesce(effect, 0.0) AS z
  FROM r3 r LEFT JOIN he USING (series, fold, holiday)),
r5 AS (
  SELECT *, z - avg(z) OVER (PARTITION BY series, fold) AS e,
         lag(z) OVER o AS z1, lag(z, 2) OVER o AS z2
  FROM r4 WINDOW o AS (PARTITION BY series, fold ORDER BY period)),
r6 AS (SELECT *, sum(e) OVER (PARTITION BY series, fold ORDER BY period) AS s FROM r5),
k1 AS (
  SELECT series, fold, max(n) AS n,
         CASE WHEN sum(e * e) > 1e-9 * max(n) THEN sum(s * s) / (max(n) * sum(e * e)) END AS kpss,
         arg_max(z, t) AS last_z, arg_max(z - z1, t) AS last_w
  FROM r6 WHERE z IS NOT NULL GROUP BY 1, 2),
k2 AS (SELECT *, CAST(CASE WHEN kpss > 0.463 THEN 1 ELSE 0 END AS INTEGER) AS d FROM k1),
pairs AS (
  SELECT r.series, r.fold, CASE WHEN d = 1 THEN z - z1 ELSE z END AS b,
         CASE WHEN d = 1 THEN z1 - z2 ELSE z1 END AS a
  FROM r6 r JOIN k2 USING (series, fold)),
k3 AS (
  SELECT series, fold, count(*) AS m, avg(a) AS ma, avg(b) AS mb, var_pop(a) * count(*) AS caa,
         var_pop(b) * count(*) AS cbb, covar_pop(a, b) * count(*) AS cab
  FROM pairs WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2),
k4 AS (
  SELECT k2.*, coalesce(m, 0) AS m, ma, mb, caa, cbb, cab,
         CASE WHEN m >= 8 AND caa > 1e-9 * m
              THEN greatest(least(cab / caa, 0.98), -0.98) END AS ar
  FROM k2 LEFT JOIN k3 USING (series, fold)),
k5 AS (SELECT *, greatest(cbb - 2 * ar * cab + ar * ar * caa, 0) AS sse1 FROM k4),
k6 AS (
  SELECT *, CASE WHEN m > 0 THEN m * ln(greatest(cbb / m, 1e-12)) + 2 END AS aic0,
         CASE WHEN ar IS NOT NULL THEN m * ln(greatest(sse1 / m, 1e-12)) + 4 END AS aic1
  FROM k5),
k7 AS (SELECT *, CAST(CASE WHEN aic1 < aic0 THEN 1 ELSE 0 END AS INTEGER) AS p FROM k6),
models AS (
  SELECT series, fold, n, m, p, d, kpss, last_z, last_w,
         CASE WHEN p = 1 THEN ar ELSE 0.0 END AS phi,
         CASE WHEN p = 1 THEN aic1 ELSE aic0 END AS aic,
         coalesce(CASE WHEN p = 1 THEN sse1 ELSE cbb END, 0.0) AS sse,
         coalesce(mb - CASE WHEN p = 1 THEN ar ELSE 0.0 END * ma,
                  CASE WHEN d = 1 THEN 0.0 ELSE last_z END) AS c
  FROM k7),
f1 AS (
  SELECT r.series, r.fold, r.period, r.actual, r.y, r.seasonal, r.holiday_effect, r.regressor,
         r.z1, r.z2, m.*, coalesce(sse / nullif(m.m, 0), 0.0) AS sigma2, c / (1 - phi) AS mu,
         CASE WHEN r.y IS NULL THEN r.t - m.n ELSE 1 END AS h
  FROM r6 r JOIN models m ON r.series = m.series AND r.fold = m.fold),
f2 AS (
  SELECT *,
    CASE WHEN y IS NULL AND d = 0 THEN mu + pow(phi, h) * (last_z - mu)
         WHEN y IS NULL THEN last_z + h * mu
              + coalesce(last_w - mu, 0) * phi * (1 - pow(phi, h)) / (1 - phi)
         WHEN d = 0 THEN c + CASE WHEN p = 1 THEN phi * z1 ELSE 0 END
         ELSE z1 + c + CASE WHEN p = 1 THEN phi * (z1 - z2) ELSE 0 END END AS trend,
    CASE WHEN y IS NULL AND d = 0 THEN sigma2 * (1 - pow(phi, 2 * h)) / (1 - phi * phi)
         WHEN y IS NULL THEN sigma2 / pow(1 - phi, 2)
              * (h - 2 * phi * (1 - pow(phi, h)) / (1 - phi)
                 + phi * phi * (1 - pow(phi, 2 * h)) / (1 - phi * phi)) END AS variance
  FROM f1),
explained AS (
  SELECT fold, series, period, CASE WHEN y IS NULL THEN 'forecast' ELSE 'history' END
           AS time_series_type,
         actual, trend + seasonal + holiday_effect + regressor AS forecast_value,
         CASE WHEN variance IS NOT NULL THEN sqrt(greatest(variance, 0)) END AS standard_error, trend, seasonal, holiday_effect,
         regressor AS regressor_effect
  FROM f2)"""


# Spikes and dips of history; expects ``r4``.
SPIKES = f"""s1 AS (
  SELECT fold, series, period, actual, z - median(z) OVER (PARTITION BY series, fold ORDER BY period
           ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS off
  FROM r4 WHERE y IS NOT NULL),
s2 AS (
  SELECT *, median(abs(off)) OVER k AS middle, avg(abs(off)) OVER k AS mean
  FROM s1 WINDOW k AS (PARTITION BY series, fold)),
s3 AS (
  SELECT *, CASE WHEN abs(off) > greatest(5.0::DOUBLE * CASE WHEN middle > 1e-6
      THEN 1.4826::DOUBLE * middle ELSE 1.2533::DOUBLE * mean END, 1e-6::DOUBLE) THEN off ELSE 0 END AS spike
  FROM s2),
adjusted AS (
  SELECT fold, series, period, actual, {rounded('spikes_and_dips, cleaned')}
  FROM (SELECT *, spike AS spikes_and_dips, actual - spike AS cleaned FROM s3))
"""


def arima_forecast(confidence: float, lower: float | None = None) -> str:
    """Forecast rows with an interval; expects ``explained``."""
    z = z_value(confidence)

    def kept(value: str) -> str:
        return value if lower is None else f"greatest({value}, {lower})"

    return f"""forecasts AS (
  SELECT fold, series, period, time_series_type, {kept('forecast_value')} AS forecast_value,
         {kept(f'forecast_value - {z} * standard_error')} AS prediction_interval_lower_bound,
         {kept(f'forecast_value + {z} * standard_error')} AS prediction_interval_upper_bound
  FROM explained WHERE time_series_type = 'forecast')"""


# Engines add floats in different orders; the digits hashed stay clear of that noise.
MODEL_DIGITS = 6
BOUNDS_COLUMNS = ("forecast_value, prediction_interval_lower_bound, "
                  "prediction_interval_upper_bound")
FORECAST = ("SELECT fold, series, period, time_series_type, " + rounded(BOUNDS_COLUMNS, MODEL_DIGITS)
            + " FROM forecasts")
EXPLAINED = f"""SELECT fold, series, period, time_series_type,
  CAST(round(CAST((CASE WHEN time_series_type = 'history' THEN actual ELSE forecast_value END) AS DECIMAL(28, {MODEL_DIGITS + 4})), {MODEL_DIGITS}) AS DOUBLE)
    AS time_series_data,
  CAST(0.95 AS DOUBLE) AS confidence_level,
  CAST(round(CAST((forecast_value - {z_value(0.95)} * standard_error) AS DECIMAL(28, {MODEL_DIGITS + 4})), {MODEL_DIGITS}) AS DOUBLE) AS prediction_interval_lower_bound,
  CAST(round(CAST((forecast_value + {z_value(0.95)} * standard_error) AS DECIMAL(28, {MODEL_DIGITS + 4})), {MODEL_DIGITS}) AS DOUBLE) AS prediction_interval_upper_bound,
  """ + rounded("forecast_value, standard_error, trend, seasonal, holiday_effect, "
                "regressor_effect", MODEL_DIGITS) + " FROM explained"


# --- baselines and comparisons -------------------------------------------------------------

DRIFT = """drift AS (
  SELECT fold, series, period, 'forecast' AS time_series_type,
         ma_y + slope * (t - ma_t) AS forecast_value,
         CAST(NULL AS DOUBLE) AS prediction_interval_lower_bound,
         CAST(NULL AS DOUBLE) AS prediction_interval_upper_bound
  FROM (SELECT series, fold, avg(y) AS ma_y, avg(t) AS ma_t,
               coalesce(covar_pop(y, t) / nullif(var_pop(t), 0), 0) AS slope
        FROM r0 WHERE y IS NOT NULL GROUP BY 1, 2)
  JOIN (SELECT series, fold, period, t FROM r0 WHERE y IS NULL) USING (series, fold))"""

TREND_SEASON = """trend_season AS (
  SELECT fold, series, period, 'forecast' AS time_series_type,
         ma_y + slope * (t - ma_t) + seasonal AS forecast_value,
         CAST(NULL AS DOUBLE) AS prediction_interval_lower_bound,
         CAST(NULL AS DOUBLE) AS prediction_interval_upper_bound
  FROM (SELECT series, fold, avg(u - seasonal) AS ma_y, avg(t) AS ma_t,
               coalesce(covar_pop(u - seasonal, t) / nullif(var_pop(t), 0), 0) AS slope
        FROM r3 WHERE y IS NOT NULL GROUP BY 1, 2)
  JOIN (SELECT series, fold, period, t, seasonal FROM r3 WHERE y IS NULL)
    USING (series, fold))"""

NO_HOLIDAYS = "hol AS (SELECT DATE '1900-01-01' AS period, 'none' AS holiday WHERE false)"


def renamed(cte: str, old: str, new: str) -> str:
    """The same CTE under another name."""
    return cte.replace(f"{old} AS (", f"{new} AS (", 1)


def materialized(sql: str, *names: str) -> str:
    """The same SQL, where CTEs that are read more than once are worked out once."""
    for name in names:
        sql = sql.replace(f"{name} AS (", f"{name} AS MATERIALIZED (", 1)
    return sql


def dashboard_of(model: str, run: str, forecasts: str) -> str:
    """Dashboard rows of one model as the CTE ``board_<model>``."""
    return renamed(dashboard(model, run), "dashboard", f"board_{model}").replace(
        "FROM forecasts WHERE", f"FROM {forecasts} WHERE")


# --- pooled-model path -----------------------------------------------------------------------

ITEMS = """items AS (
  SELECT a.*, c.predicted_on_period
  FROM (SELECT p.series, p.period, p.fold, p.origin_id, p.dest_id, p.test_start_date,
               CAST(p.qty AS VARCHAR) AS qty, f.forecast_value AS predicted_qty
        FROM (SELECT p.*, f.fold, f.test_start_date FROM panel p JOIN folds f
              ON p.period >= f.test_start_date AND p.period < f.test_end_date) p
        LEFT JOIN forecasts f ON p.fold = f.fold AND p.series = f.series
                             AND p.period = f.period) a
  CROSS JOIN (SELECT unnest([0, 7, 14]) AS back) b
  CROSS JOIN LATERAL (SELECT CAST(a.period - CAST(b.back AS INTEGER) AS DATE)
                             AS predicted_on_period) c)"""


def evaluated(clamped: bool = False) -> str:
    """Per-item errors; expects ``items``."""
    used = clamp("predicted_qty") if clamped else "predicted_qty"
    return f"""errors AS (
  SELECT fold, series, period, 'forecast' AS time_series_type,
         CAST({clamp('predicted_qty')} AS DOUBLE) AS forecast_value, actual_value,
         actual_value - used AS diff, abs(actual_value - used) * actual_value AS wAbsError,
         actual_value * actual_value AS wHist
  FROM (SELECT *, CAST(round(CAST(qty AS DOUBLE)) AS BIGINT) AS actual_value, {used} AS used
        FROM items WHERE period = predicted_on_period))"""


def window_examples(context: int, horizon: int, end: str) -> str:
    """Training windows of the dense ``panel``: lags at an origin, target h periods on."""
    lags = ", ".join(f"lag(qty, {i - 1}) OVER o AS lag_{i}" for i in range(1, context + 1))
    names = ", ".join(f"e.lag_{i}" for i in range(1, context + 1))
    return f"""lagged AS (
  SELECT series, period AS origin, {lags} FROM panel
  WINDOW o AS (PARTITION BY series ORDER BY period)),
examples AS (
  SELECT e.series, e.origin, {names}, h.h, p.period, CAST(p.qty AS DOUBLE) AS target,
         {rain('p.period')} AS percentage_rain
  FROM lagged e CROSS JOIN (SELECT CAST(unnest(generate_series(1, {horizon})) AS INTEGER) AS h) h
  JOIN panel p ON p.series = e.series AND p.period = e.origin + 7 * h.h
  WHERE e.lag_{context} IS NOT NULL AND p.period < {end})"""
