"""Column expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Statuses that count as a sale.
REALISED_STATUSES = ("Completed", "Delivered")

AsOf = dt.date | str | Column | None


def to_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- numbers -----------------------------------------------------------------


def round_half_even(c: str | Column, digits: int = 2) -> Column:
    """Round to ``digits`` decimals, ties to even."""
    scale = float(10**digits)
    return F.rint(to_col(c) * F.lit(scale)) / F.lit(scale)


def cents(c: str | Column) -> Column:
    """Money as whole cents, so that sums are exact in any order.

    A sum of cents is a plain 64-bit add inside generated code.  ANSI mode
    raises on overflow instead of wrapping.
    """
    return F.rint(to_col(c).cast("double") * F.lit(100.0)).cast("bigint")


def money_sum(c: str | Column, times: str | Column | None = None) -> Column:
    """Exact sum of a money column, optionally weighted by an integer."""
    amount = cents(c) if times is None else cents(c) * to_col(times)
    return F.sum(amount) / F.lit(100.0)


def money_avg(c: str | Column, times: str | Column | None = None) -> Column:
    """Mean of a money column over its non-null rows."""
    c = to_col(c)
    weight = F.lit(1) if times is None else to_col(times)
    rows = F.sum(F.when(c.isNotNull(), weight))
    return money_sum(c, times) / F.nullif(rows, F.lit(0))


def ratio(a: str | Column, b: str | Column) -> Column:
    """``a / b`` as double, NULL when ``b`` is zero."""
    return to_col(a).cast("double") / F.nullif(to_col(b).cast("double"), F.lit(0.0))


def int_ratio(a: str | Column, b: str | Column) -> Column:
    """Integer division, NULL when ``b`` is zero."""
    return F.call_function("div", to_col(a), F.nullif(to_col(b), F.lit(0)))


# -- dates -------------------------------------------------------------------


def latest(df: DataFrame, date_col: str) -> Column:
    """max(date_col) of ``df`` as a scalar subquery."""
    return df.agg(F.max(date_col)).scalar()


def as_of_col(as_of: AsOf, df: DataFrame, date_col: str) -> Column:
    """The reference date: a given date, or the latest one in ``df``."""
    if as_of is None:
        return latest(df, date_col)
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def _since(df: DataFrame, date_col: str, as_of: AsOf, back: Callable[[Column], Column]) -> DataFrame:
    """Rows from the day ``back(as_of)`` on, without upper bound.

    The bound is a single literal or a bare scalar subquery: both reach the
    file scan as a filter, and with a DATE column row groups are skipped by it.
    Sources that store the date as a timestamp keep it beside the date as
    ``<date_col>_ts``, and the bound is put on that column instead of a cast.
    """
    raw = f"{date_col}_ts"
    column, kind = (raw, "timestamp_ntz") if raw in df.columns else (date_col, "date")
    if as_of is None:
        bound = df.agg(back(F.max(date_col)).cast(kind)).scalar()
    else:
        bound = back(as_of_col(as_of, df, date_col)).cast(kind)
    return df.filter(F.col(column) >= bound)


def last_days(df: DataFrame, date_col: str, as_of: AsOf, days: int) -> DataFrame:
    """Rows of the last ``days`` days, counted back from ``as_of`` or the latest date."""
    return _since(df, date_col, as_of, lambda day: F.date_sub(day, days))


def last_months(df: DataFrame, date_col: str, as_of: AsOf, months: int) -> DataFrame:
    return _since(df, date_col, as_of, lambda day: F.add_months(day, -months))


def period_start(c: str | Column, level: str) -> Column:
    """First day of the day / week (Monday) / month holding ``c``."""
    unit = {"daily": "day", "weekly": "week", "monthly": "month"}[level]
    c = to_col(c)
    return c.cast("date") if unit == "day" else F.trunc(c, unit).cast("date")


# -- predicates and bands ----------------------------------------------------


def is_realised(status: str | Column = "order_status",
                statuses: Sequence[str] = REALISED_STATUSES) -> Column:
    return to_col(status).isin(*statuses)


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def risk_category(p: str | Column) -> Column:
    """(0, .3] Low, (.3, .7] Medium, (.7, 1] High; NULL outside, so also at 0."""
    p = to_col(p)
    return (F.when((p > 0) & (p <= 0.3), "Low Risk")
            .when((p > 0.3) & (p <= 0.7), "Medium Risk")
            .when((p > 0.7) & (p <= 1), "High Risk"))


def risk_band(p: str | Column) -> Column:
    """Report bands: above .7 high, .4 to .7 medium, below .4 low."""
    p = to_col(p)
    return (F.when(p > 0.7, "high_risk")
            .when(p.between(0.4, 0.7), "medium_risk")
            .when(p < 0.4, "low_risk"))


def risk_class(p: str | Column) -> Column:
    """Dashboard classes: above .8 high, above .6 medium, the rest low."""
    p = to_col(p)
    return (F.when(p > 0.8, "risk-high")
            .when(p > 0.6, "risk-medium")
            .otherwise("risk-low"))


# -- text --------------------------------------------------------------------


def full_name(first: str | Column, last: str | Column) -> Column:
    """First and last name; a missing part prints as ``None``."""
    return F.concat_ws(" ", F.coalesce(to_col(first), F.lit("None")),
                       F.coalesce(to_col(last), F.lit("None")))


def format_currency(c: str | Column) -> Column:
    """Whole dollars with thousands separators, ties away from zero."""
    c = to_col(c).cast("double")
    return F.concat(F.when(c <= -0.5, "-").otherwise(""), F.lit("$"),
                    F.format_number(F.round(F.abs(c)), 0))


def format_count(c: str | Column) -> Column:
    return F.format_number(to_col(c).cast("bigint"), 0)


def format_percent(c: str | Column) -> Column:
    """A fraction as a percentage with one decimal."""
    return F.format_string("%.1f%%", to_col(c).cast("double") * 100)


def iso_date(c: str | Column) -> Column:
    return F.date_format(to_col(c), "yyyy-MM-dd")


def iso_datetime(c: str | Column) -> Column:
    return F.date_format(to_col(c), "yyyy-MM-dd HH:mm:ss")
