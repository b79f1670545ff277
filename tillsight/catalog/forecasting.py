"""Sales series and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.catalog.base import even, msum, query, rounded
from tillsight.catalog.relational import CATEGORY_TREND, _category_trend, _sales
from tillsight.operators import alerts, arima, forecast, series
from tillsight.plans import forecasting as plan
from tillsight.sources.star import Star


def _daily(t: Star) -> DataFrame:
    return series.time_series(_sales(t), "daily")


@query("fc_daily_series", "SELECT * FROM r_daily")
def fc_daily_series(t: Star) -> DataFrame:
    return _daily(t)


_CALENDAR = {
    "year": "CAST(year(ds) AS INTEGER)", "month": "CAST(month(ds) AS INTEGER)",
    "day": "CAST(day(ds) AS INTEGER)", "day_of_week": "CAST(isodow(ds) - 1 AS INTEGER)",
    "quarter": "CAST(quarter(ds) AS INTEGER)",
    "is_weekend": "CAST(isodow(ds) >= 6 AS INTEGER)",
    "sin_month": even("sin(2 * pi() * month(ds) / 12)", 8), "cos_month": even("cos(2 * pi() * month(ds) / 12)", 8),
    "sin_day": even("sin(2 * pi() * day(ds) / 31)", 8), "cos_day": even("cos(2 * pi() * day(ds) / 31)", 8)}


@query("fc_calendar_features", f"SELECT ds, {', '.join(f'{x} AS {n}' for n, x in _CALENDAR.items())} FROM r_daily")
def fc_calendar_features(t: Star) -> DataFrame:
    found = series.calendar_features(_daily(t)).select("ds", *_CALENDAR)
    return rounded(found, 8, "sin_month", "cos_month", "sin_day", "cos_day")


_LAGS = ", ".join(f"lag({c}, {n}) OVER (ORDER BY ds) AS {a}_lag_{n}" for n in (1, 7, 14, 30)
                  for c, a in (("revenue", "revenue"), ("quantity_sold", "quantity")))


def _rolling(n: int) -> str:
    w = f"OVER (ORDER BY ds ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    full = f"COUNT(*) {w} = {n}"
    mean = lambda c: f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) {w} AS DOUBLE) / {n}"
    return ", ".join([
        f"CASE WHEN {full} THEN {even(mean('revenue'), 4)} END AS revenue_rolling_mean_{n}",
        f"CASE WHEN {full} THEN {even(f'stddev_samp(revenue) {w}', 4)} END AS revenue_rolling_std_{n}",
        f"CASE WHEN {full} THEN {even(mean('quantity_sold'), 4)} END AS quantity_rolling_mean_{n}"])


_ROLLING = ", ".join(_rolling(n) for n in (7, 14, 30))
_ROLLED = [f"{a}_rolling_{m}_{n}" for n in (7, 14, 30)
           for a, m in (("revenue", "mean"), ("revenue", "std"), ("quantity", "mean"))]


@query("w3_lag_features", f"SELECT ds, {_LAGS} FROM r_daily")
def w3(t: Star) -> DataFrame:
    return series.lag_features(_daily(t)).drop(*series.MEASURES)


@query("w4_rolling_features", f"SELECT ds, {_ROLLING} FROM r_daily")
def w4(t: Star) -> DataFrame:
    return rounded(series.rolling_features(_daily(t)).drop(*series.MEASURES), 4, *_ROLLED)


@query("w5_moving_avg_3", f"""
    SELECT order_date, daily_revenue, CASE WHEN COUNT(*) OVER w = 3 THEN
           CAST(SUM(CAST(daily_revenue AS DECIMAL(18,2))) OVER w AS DOUBLE) / 3 END AS moving_avg
    FROM (SELECT order_date, {msum('total_amount')} AS daily_revenue FROM r_orders
          WHERE order_status IN ('Completed', 'Delivered') GROUP BY 1)
    WINDOW w AS (ORDER BY order_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def w5(t: Star) -> DataFrame:
    return alerts.with_moving_average(alerts.daily_revenue(t.orders, days=None))


_PRODUCT_SERIES = f"""
    WITH s AS (SELECT product_id, order_date AS ds, {msum('revenue')} AS revenue FROM r_sales_base GROUP BY 1, 2),
    g AS (SELECT product_id, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
          FROM s GROUP BY 1),
    f AS (SELECT product_id, ds, coalesce(revenue, 0) AS revenue,
                 row_number() OVER (PARTITION BY product_id ORDER BY ds DESC) AS back
          FROM g LEFT JOIN s USING (product_id, ds)),
    m AS (SELECT product_id, CAST(SUM(CAST(revenue AS DECIMAL(18,2))) FILTER (back <= 7) AS DOUBLE) / 7
                 AS moving_avg, max(ds) AS last, COUNT(*) AS n FROM f GROUP BY 1)"""


@query("w8_rolling_last_value", f"{_PRODUCT_SERIES} SELECT product_id, moving_avg, last FROM m WHERE n > 30")
def w8(t: Star) -> DataFrame:
    """Mean of the last week for every product."""
    daily = _sales(t).select("product_id", F.col("order_date").alias("ds"), "revenue")
    return forecast.recent_mean(daily, "revenue", 7, 30, ["product_id"])


@query("fc_lag_rolling_features", f"SELECT ds, {_LAGS}, {_ROLLING} FROM r_daily")
def fc_lag_rolling_features(t: Star) -> DataFrame:
    found = series.rolling_features(series.lag_features(_daily(t)))
    return rounded(found.drop(*series.MEASURES), 4, *_ROLLED)


@query("fc_linear_trend", f"""
    WITH f AS (SELECT revenue AS y, row_number() OVER (ORDER BY ds) - 1 AS x, ds FROM r_daily),
    l AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, COUNT(*) AS n, max(ds) AS last FROM f)
    SELECT CAST(last + CAST(h AS INTEGER) AS DATE) AS forecast_date, {even('a + b * (n + h - 1)', 4)}
           AS predicted_value, 'Linear Trend' AS model_type
    FROM l, (SELECT unnest(generate_series(1, 30)) AS h)""")
def fc_linear_trend(t: Star) -> DataFrame:
    return rounded(forecast.linear_trend(_daily(t)), 4, "predicted_value")


@query("fc_linear_trend_by_category", f"""{CATEGORY_TREND}
    SELECT category, forecast_date, {even('v', 4)} AS predicted_value, 'Linear Trend' AS model_type FROM p""")
def fc_linear_trend_by_category(t: Star) -> DataFrame:
    return rounded(_category_trend(t), 4, "predicted_value")


@query("fc_moving_average", f"""{_PRODUCT_SERIES},
    t AS (SELECT product_id, {msum('revenue')} AS r FROM s GROUP BY 1 ORDER BY r DESC, product_id LIMIT 10)
    SELECT product_id, CAST(last + CAST(h AS INTEGER) AS DATE) AS forecast_date,
           moving_avg AS predicted_revenue, 'Moving Average' AS model_type
    FROM m, (SELECT unnest(generate_series(1, 30)) AS h)
    WHERE n > 30 AND product_id IN (SELECT product_id FROM t)""")
def fc_moving_average(t: Star) -> DataFrame:
    return forecast.product_moving_average(_sales(t))


@query("fc_arima")
def fc_arima(t: Star) -> DataFrame:
    """One fit per category, all in one job."""
    daily = series.time_series(_sales(t), "daily", keys=["category"])
    return arima.arima_forecast(daily, keys=["category"])


@query("fc_arima_check", """
    SELECT category, COUNT(*) AS days, min(d) AS first_day, max(d) AS last_day, TRUE AS interval_fits
    FROM (SELECT category, CAST(last + CAST(h AS INTEGER) AS DATE) AS d
          FROM (SELECT category, max(order_date) AS last FROM r_sales_base GROUP BY 1),
               (SELECT unnest(generate_series(1, 30)) AS h)) GROUP BY 1""")
def fc_arima_check(t: Star) -> DataFrame:
    """Thirty days after each category's last one, each inside its interval."""
    found = fc_arima(t)
    fits = F.col("predicted_value").between(F.col("lower_ci"), F.col("upper_ci"))
    return found.groupBy("category").agg(
        F.count("*").alias("days"), F.min("forecast_date").alias("first_day"), F.max("forecast_date").alias("last_day"),
        F.bool_and(fits).alias("interval_fits"))


@query("fc_random_forest")
def fc_random_forest(t: Star) -> DataFrame:
    ahead, errors = forecast.random_forest(series.model_features(_daily(t)))
    return ahead.withColumns({c: errors.select(c).scalar() for c in ("mae", "rmse", "r2")})


@query("fc_metrics", f"""
    WITH f AS (SELECT revenue AS y, lag(revenue, 7) OVER (ORDER BY ds) AS p FROM r_daily),
    c AS (SELECT * FROM f WHERE p IS NOT NULL)
    SELECT {even('AVG(abs(y - p))', 4)} AS mae, {even('sqrt(AVG((y - p) * (y - p)))', 4)} AS rmse,
           {even('1 - SUM((y - p) * (y - p)) / (var_pop(y) * COUNT(*))', 8)} AS r2 FROM c""")
def fc_metrics(t: Star) -> DataFrame:
    """Errors of last week's value as the prediction."""
    lagged = series.lag_features(_daily(t), lags=(7,)).filter(F.col("revenue_lag_7").isNotNull())
    found = forecast.error_metrics(lagged, "revenue", "revenue_lag_7")
    return rounded(rounded(found, 4, "mae", "rmse"), 8, "r2")


@query("fc_combine", f"""{CATEGORY_TREND}
    SELECT CAST(1 AS BIGINT) AS product_id, forecast_date, {even('v', 4)} AS predicted_sales,
           {even('v * 0.8', 4)} AS confidence_interval_lower, {even('v * 1.2', 4)} AS confidence_interval_upper,
           'Linear Trend' AS model_used FROM p""")
def fc_combine(t: Star) -> DataFrame:
    stored = forecast.combine(_category_trend(t).drop("category"), None)
    return rounded(stored, 4, "predicted_sales", "confidence_interval_lower", "confidence_interval_upper")


_THREE = f"""{CATEGORY_TREND},
    pm AS ({_PRODUCT_SERIES},
      t AS (SELECT product_id, {msum('revenue')} AS r FROM s GROUP BY 1 ORDER BY r DESC, product_id LIMIT 10)
      SELECT product_id, CAST(last + CAST(h AS INTEGER) AS DATE) AS forecast_date, moving_avg
      FROM m, (SELECT unnest(generate_series(1, 30)) AS h) WHERE n > 30 AND product_id IN (SELECT product_id FROM t)),
    recent AS (SELECT max(ds) AS last, AVG(revenue) AS m, stddev_samp(revenue) AS s FROM r_daily
           WHERE ds > (SELECT max(ds) FROM r_daily) - 30),
    three AS (SELECT CAST(1 AS BIGINT) AS product_id, forecast_date, v AS p, NULL AS low, NULL AS high, 'Linear Trend' AS model_used FROM p
          UNION ALL SELECT product_id, forecast_date, moving_avg, NULL, NULL, 'Moving Average' FROM pm
          UNION ALL SELECT 1, CAST(last + CAST(h AS INTEGER) AS DATE), m, m - CAST(1.959963984540054 AS DOUBLE) * s,
                           m + CAST(1.959963984540054 AS DOUBLE) * s, 'Recent Mean'
                    FROM recent, (SELECT unnest(generate_series(1, 30)) AS h))"""


def _three(t: Star) -> DataFrame:
    """Lines by category, means by product and a mean with its own interval, in one table."""
    one = F.lit(1).cast("bigint")
    lines = _category_trend(t).drop("category").withColumn("product_id", one)
    means = fc_moving_average(t).withColumnRenamed("predicted_revenue", "predicted_value")
    wide = forecast.mean_with_interval(_daily(t)).withColumn("product_id", one)
    return forecast.combine(lines, means, wide)


@query("fc_combine_three", f"""{_THREE}
    SELECT product_id, forecast_date, {even('p', 4)} AS predicted_sales, {even('low', 4)} AS confidence_interval_lower,
           {even('high', 4)} AS confidence_interval_upper, model_used FROM three""")
def fc_combine_three(t: Star) -> DataFrame:
    """One model brings an interval, so the others have none."""
    return rounded(_three(t), 4, "predicted_sales", "confidence_interval_lower", "confidence_interval_upper")


@query("fc_summary_three", f"""{_THREE}
    SELECT model_used, {even('AVG(p)', 3)} AS avg_prediction, COUNT(*) AS days FROM three GROUP BY 1""")
def fc_summary_three(t: Star) -> DataFrame:
    return rounded(forecast.summary(_three(t)), 3, "avg_prediction")


@query("fc_seasonal_decompose", f"""
    WITH n AS (SELECT ds, revenue, CAST((row_number() OVER (ORDER BY ds) - 1) % 30 AS INTEGER) AS position,
                 CASE WHEN COUNT(*) OVER (ORDER BY ds ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING) = 31
                 THEN (CAST(SUM(CAST(revenue AS DECIMAL(18,2))) OVER
                            (ORDER BY ds ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS DOUBLE)
                       - (lag(revenue, 15) OVER (ORDER BY ds) + lead(revenue, 15) OVER (ORDER BY ds)) / 2) / 30
                 END AS trend FROM r_daily),
    m AS (SELECT position, AVG(revenue - trend) AS s FROM n GROUP BY 1),
    c AS (SELECT position, s - (SELECT AVG(s) FROM m) AS seasonal FROM m)
    SELECT ds, revenue, position, {even('trend', 4)} AS trend, {even('seasonal', 4)} AS seasonal,
           {even('revenue - trend - seasonal', 4)} AS residual
    FROM n JOIN c USING (position)""")
def fc_seasonal_decompose(t: Star) -> DataFrame:
    parts = series.decompose(_daily(t)).select("ds", "revenue", "position", "trend", "seasonal", "residual")
    return rounded(parts, 4, "trend", "seasonal", "residual")


@query("fc_summary", f"""{CATEGORY_TREND}
    SELECT 'Linear Trend' AS model_used, {even('AVG(v)', 3)} AS avg_prediction, COUNT(*) AS days FROM p""")
def fc_summary(t: Star) -> DataFrame:
    return rounded(forecast.summary(forecast.combine(_category_trend(t).drop("category"))), 3, "avg_prediction")


@query("fc_full_run")
def fc_full_run(t: Star) -> DataFrame:
    """All forecasting steps; returns the stored forecast rows."""
    return plan.run_forecasting(t.orders, t.order_items, t.products).forecasts


_NEXT = "SELECT last + 1 AS first_day, last + 30 AS last_day FROM (SELECT max(order_date) AS last FROM r_sales_base)"


@query("fc_random_forest_check", f"""
    SELECT CAST(30 AS BIGINT) AS days, first_day, last_day, CAST(1 AS BIGINT) AS different, TRUE AS errors_fit FROM ({_NEXT})""")
def fc_random_forest_check(t: Star) -> DataFrame:
    """A flat forecast of the next thirty days, with hold-out errors that fit each other."""
    return fc_random_forest(t).agg(
        F.count("*").alias("days"), F.min("forecast_date").alias("first_day"), F.max("forecast_date").alias("last_day"),
        F.count_distinct("predicted_value").alias("different"),
        F.bool_and((F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse")) & (F.col("r2") <= 1)).alias("errors_fit"))


@query("fc_full_run_check", f"""
    SELECT unnest(['ARIMA', 'Linear Trend', 'Random Forest']) AS model_used, CAST(30 AS BIGINT) AS days, first_day, last_day,
           unnest([30, 0, 0]) AS with_interval, TRUE AS inside FROM ({_NEXT})""")
def fc_full_run_check(t: Star) -> DataFrame:
    """Thirty days of each model; only ARIMA, fitted by category and summed, brings intervals."""
    low, high = F.col("confidence_interval_lower"), F.col("confidence_interval_upper")
    return fc_full_run(t).groupBy("model_used").agg(
        F.count("*").alias("days"), F.min("forecast_date").alias("first_day"), F.max("forecast_date").alias("last_day"),
        F.count_if(low.isNotNull() & high.isNotNull()).cast("int").alias("with_interval"),
        F.bool_and(F.coalesce(F.col("predicted_sales").between(low, high), low.isNull())).alias("inside"))
