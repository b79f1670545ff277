"""Cleaning rules of the five raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tillsight.functions.scalars import AsOf, round_half_even
from tillsight.operators.quality import invalid_email


# Each rule gives every row its cleaned values and, in ``_keep``, whether it stays.


def _customers(df: DataFrame) -> DataFrame:
    return df.withColumns({"_keep": ~invalid_email(), "age": F.when(F.col("age").between(0, 120), F.col("age")),
                           "registration_date": F.to_date("registration_date")})


def _products(df: DataFrame) -> DataFrame:
    price, cost, stock = F.col("price"), F.col("cost"), F.col("stock_quantity")
    margin = (price - cost).cast("double") / F.nullif(price.cast("double"), F.lit(0.0)) * 100
    return df.withColumns({"_keep": price >= 0, "stock_quantity": F.when(stock < 0, 0).otherwise(stock),
                           "profit_margin": round_half_even(margin)})


def _orders(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    day = F.col("order_date")
    return (df.withColumn("order_date", F.to_date("order_date"))
            .withColumns({"_keep": (day <= today) & (F.col("total_amount") >= 0),
                          "order_year": F.year(day), "order_month": F.month(day),
                          "order_quarter": F.quarter(day), "order_day_of_week": F.weekday(day)}))


def _order_items(df: DataFrame) -> DataFrame:
    total = F.col("quantity") * F.col("unit_price")
    return df.withColumns({"_keep": (F.col("quantity") > 0) & (F.col("unit_price") >= 0),
                           "total_price": round_half_even(total.cast("double"))})


def _campaigns(df: DataFrame) -> DataFrame:
    return (df.withColumns({"start_date": F.to_date("start_date"), "end_date": F.to_date("end_date")})
            .withColumns({"_keep": F.col("budget") >= 0, "duration_days": F.datediff("end_date", "start_date")}))


def _kept(marked: DataFrame) -> DataFrame:
    return marked.filter("_keep").drop("_keep").dropDuplicates()


def clean_customers(df: DataFrame) -> DataFrame:
    """Keep valid e-mails; ages outside 0..120 become null."""
    return _kept(_customers(df))


def clean_products(df: DataFrame) -> DataFrame:
    """Drop negative or missing prices, lift negative stock to 0, add the margin."""
    return _kept(_products(df))


def clean_orders(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Drop future dates (after ``as_of``, default today) and negative amounts."""
    return _kept(_orders(df, as_of))


def clean_order_items(df: DataFrame) -> DataFrame:
    """Keep positive quantities and non-negative prices; recompute the total."""
    return _kept(_order_items(df))


def clean_campaigns(df: DataFrame) -> DataFrame:
    """Parse dates, add the duration, drop negative budgets."""
    return _kept(_campaigns(df))


def _marked(name: str, df: DataFrame, as_of: AsOf) -> DataFrame:
    rules = {"customers": _customers, "products": _products, "orders": lambda rows: _orders(rows, as_of),
             "order_items": _order_items, "marketing_campaigns": _campaigns}
    return rules[name](df) if name in rules else df.withColumn("_keep", F.lit(True))


def clean(tables: Mapping[str, DataFrame], as_of: AsOf = None) -> dict[str, DataFrame]:
    """Clean every table; unknown ones are only freed of repeated rows."""
    return {name: _kept(_marked(name, df, as_of)) for name, df in tables.items()}


def row_deltas(raw: Mapping[str, DataFrame], as_of: AsOf = None) -> DataFrame:
    """(table_name, rows_in, rows_out): rows of each table before and after cleaning, in one pass over each.

    Equal cleaned rows are counted together, map-side first, which is what the removal of repeated rows costs anyway.
    """
    counts = None
    for name, df in raw.items():
        marked = _marked(name, df, as_of)
        row = (marked.groupBy(*marked.columns).agg(F.count("*").alias("_n"))
               .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"), F.count_if("_keep").alias("rows_out"))
               .select(F.lit(name).alias("table_name"), "rows_in", "rows_out"))
        counts = row if counts is None else counts.unionByName(row)
    return counts
