"""Sources, sinks, data quality and cleaning."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from tillsight.catalog.base import REALISED, big, even, mavg, msum, query, scores, segments
from tillsight.functions.scalars import money_sum
from tillsight.operators import clean, joins, marts, metrics, quality
from tillsight.session import scratch_path, stage
from tillsight.sources import readers, schemas, writers
from tillsight.sources.star import Star

# Orders after this day count as future ones in the checks below.
TODAY = "2001-01-01"


def _today():
    return F.lit(TODAY).cast("date")


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _raw_shape(t: Star) -> dict[str, DataFrame]:
    """The role tables with the columns and types of the raw files."""
    shaped = {}
    for name, df in t.tables().items():
        if name == "marketing_campaigns":
            df = df.withColumn("campaign_name", F.concat(F.lit("Campaign "), F.col("campaign_id")))
        shaped[name] = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                   for f in schemas.RAW[name].fields])
    return shaped


# -- sources and sinks -------------------------------------------------------


@query("src_csv", f"""
    SELECT 'customers' AS table_name, COUNT(*) AS n, CAST(SUM(age) AS DOUBLE) AS total FROM r_registered
    UNION ALL SELECT 'products', COUNT(*), {msum('price')} FROM r_products
    UNION ALL SELECT 'orders', COUNT(*), {msum('total_amount')} FROM r_orders
    UNION ALL SELECT 'order_items', COUNT(*), {msum('total_price')} FROM r_items
    UNION ALL SELECT 'marketing_campaigns', COUNT(*), {msum('budget')} FROM r_campaigns""")
def src_csv(t: Star) -> DataFrame:
    """Five CSV files written from the tables and read back with fixed schemas."""
    folder = scratch_path(t.spark, "raw")
    for name, df in _raw_shape(t).items():
        writers.write_csv(df, f"{folder}/{name}.csv")
    read = readers.read_raw_csv(t.spark, folder)
    money = {"customers": F.sum("age").cast("double"), "products": money_sum("price"),
             "orders": money_sum("total_amount"), "order_items": money_sum("total_price"),
             "marketing_campaigns": money_sum("budget")}
    return _union([df.agg(F.lit(n).alias("table_name"), F.count("*").alias("n"), money[n].alias("total"))
                   for n, df in read.items()])


@query("src_table", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def src_table(t: Star) -> DataFrame:
    found = readers.read_parquet_tables(t.spark, t.folder, ["part"])
    return found["part"].select("p_partkey", "p_name", "p_brand", "p_retailprice")


_STORED = {name: {f.name: f.dataType.typeName() for f in schema.fields} for name, schema in schemas.STAR.items()}


def _total_sql(column: str, kind: str) -> str:
    if kind == "string":
        return f"CAST(SUM(length({column})) AS DOUBLE)"
    if kind == "timestamp_ntz":
        return f"CAST(SUM(CAST(epoch_us({column}) AS HUGEINT) // 1000000) AS DOUBLE)"
    return f"CAST(SUM(CAST(round_even({column} * 100, 0) AS HUGEINT)) AS DOUBLE)"


def _total(column: str, kind: str) -> Column:
    value = {"string": F.char_length(column), "timestamp_ntz": F.unix_seconds(F.col(column).cast("timestamp"))}.get(
        kind, F.rint(F.col(column) * 100.0))
    return F.sum(value.cast("decimal(38,0)")).cast("double")


@query("src_all_tables", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, COUNT({c}) AS filled, {_total_sql(c, kind)} AS total FROM {name}"
    for name, columns in _STORED.items() for c, kind in columns.items()))
def src_all_tables(t: Star) -> DataFrame:
    """Every column of every stored table: filled rows and a sum over its values, lengths or seconds, in one pass each."""
    found = readers.read_parquet_tables(t.spark, t.folder, _STORED)
    parts = []
    for name, columns in _STORED.items():
        sums = found[name].agg(*[x for c, kind in columns.items()
                                 for x in (F.count(c).alias(f"n_{c}"), _total(c, kind).alias(f"t_{c}"))])
        cells = [F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("filled"),
                          F.col(f"t_{c}").alias("total")) for c in columns]
        parts.append(sums.select(F.inline(F.array(*cells))))
    return _union(parts)


@query("src_segments_scan", "SELECT * FROM r_segments ORDER BY customer_id LIMIT 1000")
def src_segments_scan(t: Star) -> DataFrame:
    return readers.segments_scan(segments(t), 1000)


_CLEAN_ORDERS = f"""
    SELECT DISTINCT *, CAST(year(order_date) AS INTEGER) AS order_year,
           CAST(month(order_date) AS INTEGER) AS order_month,
           CAST(quarter(order_date) AS INTEGER) AS order_quarter,
           CAST(isodow(order_date) - 1 AS INTEGER) AS order_day_of_week
    FROM r_orders WHERE order_date <= DATE '{TODAY}' AND total_amount >= 0"""


@query("snk_table_replace", "SELECT customer_id, 1 - churn_probability AS churn_probability FROM r_scores")
def snk_table_replace(t: Star) -> DataFrame:
    """Replace a table by rows computed from that same table."""
    path = scratch_path(t.spark, "scores")
    writers.create_table(scores(t), path)
    stored = t.spark.read.parquet(path)
    writers.replace_table(stored.withColumn("churn_probability", 1 - F.col("churn_probability")), path)
    return readers.read_table(t.spark, path)


@query("snk_table_fail", """
    SELECT 'customers' AS table_name, COUNT(*) AS n, TRUE AS second_load_refused FROM r_registered
    UNION ALL SELECT 'products', COUNT(*), TRUE FROM r_products
    UNION ALL SELECT 'orders', COUNT(*), TRUE FROM r_orders
    UNION ALL SELECT 'order_items', COUNT(*), TRUE FROM r_items
    UNION ALL SELECT 'marketing_campaigns', COUNT(*), TRUE FROM r_campaigns""")
def snk_table_fail(t: Star) -> DataFrame:
    """First load writes the five tables; a second load of the same tables is refused."""
    folder = scratch_path(t.spark, "load")
    tables = t.tables()
    written = writers.load_tables(tables, folder)
    try:
        writers.load_tables(tables, folder)
        refused = False
    except AnalysisException:
        refused = True
    return _union([t.spark.read.parquet(f"{folder}/{n}")
                   .agg(F.lit(n).alias("table_name"), F.count("*").alias("n"),
                        F.lit(refused).alias("second_load_refused")) for n in written])


@query("snk_export_multi", f"""
    WITH p AS (SELECT p.product_id, {msum('total_price')} AS revenue,
                      MAX(o.order_date >= (SELECT d FROM r_today) - 30) AS fresh
               FROM r_products p JOIN r_items i ON p.product_id = i.product_id
                    JOIN r_orders o ON i.order_id = o.order_id
               WHERE o.{REALISED} GROUP BY 1)
    SELECT 'Top Products' AS sheet, least(5, COUNT(*)) AS n FROM p WHERE fresh
    UNION ALL SELECT 'Customer Segments', least(1000, COUNT(*)) FROM r_segments
    UNION ALL SELECT 'Daily Sales', COUNT(DISTINCT order_date) FROM r_orders
              WHERE {REALISED} AND order_date >= (SELECT d FROM r_today) - 90
    UNION ALL SELECT 'Product Performance', COUNT(*) FROM p""")
def snk_export_multi(t: Star) -> DataFrame:
    folder = scratch_path(t.spark, "sheets")
    sheets = {
        "Top Products": metrics.top_products(t.orders, t.order_items, t.products),
        "Customer Segments": readers.segments_scan(segments(t), 1000),
        "Daily Sales": metrics.sales_trends(t.orders, "daily", lookback=90),
        "Product Performance": metrics.product_ranking(t.orders, t.order_items, t.products)}
    writers.export_sheets(sheets, folder)
    return _union([t.spark.read.option("header", True).csv(f"{folder}/{n}")
                   .agg(F.lit(n).alias("sheet"), F.count("*").alias("n")) for n in sheets])


@query("snk_json_rows", f"""
    SELECT strftime(order_date, '%Y-%m-%d') AS date, {msum('total_amount')} AS revenue,
           COUNT(*) AS order_count
    FROM r_orders WHERE {REALISED} GROUP BY order_date""")
def snk_json_rows(t: Star) -> DataFrame:
    """Daily sales as JSON text, read back from that text."""
    daily = (t.orders.filter(F.col("order_status").isin("Completed", "Delivered"))
             .groupBy(F.col("order_date").alias("date"))
             .agg(money_sum("total_amount").alias("revenue"), F.count("*").alias("order_count")))
    text = writers.json_rows(daily, zero_if_null=("revenue",))
    return text.select(F.from_json("json", "date STRING, revenue DOUBLE, order_count BIGINT").alias("r")).select("r.*")


# -- data quality ------------------------------------------------------------

_SQL_TABLE = {"customers": "r_registered", "products": "r_products", "orders": "r_orders",
              "order_items": "r_items", "marketing_campaigns": "r_campaigns"}
_COLUMNS = {
    "customers": "customer_id email first_name last_name country city age gender registration_date",
    "products": "product_id product_name category subcategory brand price cost stock_quantity",
    "orders": "order_id customer_id order_date total_amount discount_amount shipping_cost order_status "
              "payment_method",
    "order_items": "order_item_id order_id product_id quantity unit_price total_price",
    "marketing_campaigns": "campaign_id campaign_type start_date end_date budget target_segment "
                           "conversion_rate roi"}
_RULES = {
    "customers": {"invalid_emails": "email IS NULL OR NOT contains(email, '@')",
                  "invalid_ages": "age < 0 OR age > 120"},
    "products": {"negative_prices": "price < 0", "negative_stock": "stock_quantity < 0"},
    "orders": {"negative_amounts": "total_amount < 0", "future_dates": f"order_date > DATE '{TODAY}'"},
}


def _report_sql() -> str:
    parts = []
    for name, table in _SQL_TABLE.items():
        checks = {"total_records": "0"}
        checks |= {f"null_count:{c}": f"COUNT(*) - COUNT({c})" for c in _COLUMNS[name].split()}
        checks |= {n: f"COUNT(*) FILTER ({c})" for n, c in _RULES.get(name, {}).items()}
        checks["duplicate_count"] = f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {table}))"
        parts += [f"SELECT '{name}' AS table_name, '{n}' AS check_type, {big(c)} AS error_count, "
                  f"COUNT(*) AS total_records FROM {table}" for n, c in checks.items()]
    return " UNION ALL ".join(parts)


_REPORT = _report_sql()
_STATUS = "CASE WHEN error_count > 0 THEN 'failed' ELSE 'passed' END"


def _report(t: Star) -> DataFrame:
    return quality.quality_report(t.tables(), _today(), F.lit(f"{TODAY} 00:00:00"))


@query("dq_row_count", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS total_records FROM {s}" for n, s in _SQL_TABLE.items()))
def dq_row_count(t: Star) -> DataFrame:
    return _union([quality.row_count(df).withColumn("table_name", F.lit(n)) for n, df in t.tables().items()])


@query("dq_null_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM {_SQL_TABLE[n]}"
    for n, cs in _COLUMNS.items() for c in cs.split()))
def dq_null_counts(t: Star) -> DataFrame:
    return _union([quality.null_counts(df).withColumn("table_name", F.lit(n)) for n, df in t.tables().items()])


@query("dq_duplicate_count", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, (SELECT COUNT(*) FROM {s}) + (SELECT COUNT(*) FROM {s} WHERE {k} % 3 = 0) "
    f"- (SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(_COLUMNS[n].split())} FROM {s})) AS duplicate_count"
    for n, s, k in ((n, _SQL_TABLE[n], _COLUMNS[n].split()[0]) for n in _SQL_TABLE)))
def dq_duplicate_count(t: Star) -> DataFrame:
    """Full rows of all five tables, to which every third key's rows are added once more."""
    return _union([quality.duplicate_count(_with_copies(n, df)).withColumn("table_name", F.lit(n))
                   for n, df in t.tables().items()])


def _with_copies(name: str, df: DataFrame) -> DataFrame:
    key = _COLUMNS[name].split()[0]
    return df.unionByName(df.filter(F.col(key) % 3 == 0))


_TYPES = {
    "customers": "bigint string string string string string int string date",
    "products": "bigint string string string string double double int",
    "orders": "bigint bigint date double double double string string",
    "order_items": "bigint bigint bigint int double double",
    "marketing_campaigns": "bigint string date date double string double double"}


@query("dq_data_types", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, '{k}' AS data_type, COUNT({c}) AS filled FROM {_SQL_TABLE[n]}"
    for n in _TYPES for c, k in zip(_COLUMNS[n].split(), _TYPES[n].split())))
def dq_data_types(t: Star) -> DataFrame:
    """Type of every column of the five tables, with the rows that have a value of it."""
    parts = []
    for name, rows in t.tables().items():
        filled = quality.null_counts(rows).join(quality.data_types(rows), "column_name")
        parts.append(filled.select(F.lit(name).alias("table_name"), "column_name", "data_type",
                                   (quality.row_count(rows).scalar() - F.col("null_count")).alias("filled")))
    return _union(parts)


def _rule(name: str, table: str) -> None:
    sql = f"SELECT COUNT(*) FILTER ({_RULES[table][name]}) AS error_count FROM {_SQL_TABLE[table]}"

    @query(f"dq_{name}", sql)
    def run(t: Star) -> DataFrame:
        counted = quality.rule_counts(table, t.tables()[table], _today())
        return counted.filter(F.col("check_type") == name).select("error_count")


for _table, _rules in _RULES.items():
    for _name in _rules:
        _rule(_name, _table)


@query("dq_report", f"""
    SELECT table_name, check_type, {_STATUS} AS status, error_count, total_records,
           CASE WHEN error_count > 0 THEN error_count || ' of ' || total_records || ' rows' END
                AS error_details FROM ({_REPORT})""")
def dq_report(t: Star) -> DataFrame:
    return _report(t).drop("checked_at")


@query("dq_log_latest", f"""
    SELECT table_name, check_type, {_STATUS} AS status, error_count, total_records,
           '{TODAY} 00:00:00' AS checked_at
    FROM ({_REPORT}) ORDER BY table_name, check_type LIMIT 50""")
def dq_log_latest(t: Star) -> DataFrame:
    """The report stored as the log table, and the latest checks read from it."""
    path = scratch_path(t.spark, "quality_log")
    writers.create_table(_report(t), path)
    latest = quality.latest_checks(t.spark.read.parquet(path))
    return latest.withColumn("checked_at", F.date_format("checked_at", "yyyy-MM-dd HH:mm:ss"))


@query("dq_not_null", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS violations "
    f"FROM {_SQL_TABLE[n]}" for n, cs in schemas.NOT_NULL.items() for c in cs))
def dq_not_null(t: Star) -> DataFrame:
    return quality.not_null_violations(t.tables(), schemas.NOT_NULL)


@query("dq_unique", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{k[0]}' AS key_columns, COUNT(*) FILTER (c > 1) AS repeated_keys, "
    f"{big('COALESCE(SUM(c - 1), 0)')} AS extra_rows "
    f"FROM (SELECT COUNT(*) AS c FROM {_SQL_TABLE[n]} WHERE {k[0]} IS NOT NULL GROUP BY {k[0]})"
    for n, ks in schemas.UNIQUE.items() for k in ks))
def dq_unique(t: Star) -> DataFrame:
    return quality.unique_violations(t.tables(), schemas.UNIQUE)


# Parents are the cleaned tables, so that removed ones leave orphans.
_PARENTS = {"customers": "(SELECT customer_id FROM r_customers WHERE contains(email, '@'))",
            "orders": f"(SELECT order_id FROM r_orders WHERE order_date <= DATE '{TODAY}')",
            "products": "r_products"}


@query("dq_fk_orphans", " UNION ALL ".join(
    f"SELECT '{c}' AS child_table, '{ck}' AS child_column, '{p}' AS parent_table, "
    f"COUNT(DISTINCT {ck}) AS orphan_keys, COUNT(*) AS orphan_rows FROM {_SQL_TABLE[c]} "
    f"WHERE {ck} IS NOT NULL AND {ck} NOT IN (SELECT {pk} FROM {_PARENTS[p]})"
    for c, ck, p, pk in schemas.FOREIGN_KEYS))
def dq_fk_orphans(t: Star) -> DataFrame:
    raw = t.tables()
    parents = {"customers": clean.clean_customers(raw["customers"]),
               "orders": clean.clean_orders(raw["orders"], TODAY), "products": raw["products"]}
    parts = [quality.orphan_counts({c: raw[c], p: parents[p]}, [(c, ck, p, pk)])
             for c, ck, p, pk in schemas.FOREIGN_KEYS]
    return _union(parts)


@query("dq_summary_print", f"""
    SELECT table_name, max(total_records) AS total_records,
           {', '.join(f"max(CASE WHEN check_type = '{c}' THEN error_count END) AS {c}" for c in
                      ('duplicate_count', 'invalid_emails', 'negative_prices', 'negative_amounts'))}
    FROM ({_REPORT}) GROUP BY 1""")
def dq_summary_print(t: Star) -> DataFrame:
    return quality.printed_summary(_report(t))


# -- cleaning ----------------------------------------------------------------

_CLEAN = {
    "customers": """
        SELECT DISTINCT * REPLACE (CASE WHEN age BETWEEN 0 AND 120 THEN age END AS age)
        FROM r_registered WHERE contains(email, '@')""",
    "products": f"""
        SELECT DISTINCT * REPLACE (CASE WHEN stock_quantity < 0 THEN 0 ELSE stock_quantity END
                                   AS stock_quantity),
               {even('(price - cost) / NULLIF(price, 0) * 100')} AS profit_margin
        FROM r_products WHERE price >= 0""",
    "orders": _CLEAN_ORDERS,
    "order_items": f"""
        SELECT DISTINCT * REPLACE ({even('quantity * unit_price')} AS total_price)
        FROM r_items WHERE quantity > 0 AND unit_price >= 0""",
    "marketing_campaigns": """
        SELECT DISTINCT *, CAST(date_diff('day', start_date, end_date) AS INTEGER) AS duration_days
        FROM r_campaigns WHERE budget >= 0""",
}


@query("cl_customers", _CLEAN["customers"])
def cl_customers(t: Star) -> DataFrame:
    return clean.clean_customers(t.registered)


@query("cl_products", _CLEAN["products"])
def cl_products(t: Star) -> DataFrame:
    return clean.clean_products(t.products)


@query("cl_orders", _CLEAN["orders"])
def cl_orders(t: Star) -> DataFrame:
    return clean.clean_orders(t.orders.drop("order_date_ts"), TODAY)


@query("cl_order_items", _CLEAN["order_items"])
def cl_order_items(t: Star) -> DataFrame:
    return clean.clean_order_items(t.order_items)


@query("cl_campaigns", _CLEAN["marketing_campaigns"])
def cl_campaigns(t: Star) -> DataFrame:
    return clean.clean_campaigns(t.campaigns)


@query("cl_dedup", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS n, {', '.join(f'COUNT(DISTINCT {c}) AS d{i}' for i, c in enumerate(_COLUMNS[n].split()[:6]))} "
    f"FROM (SELECT DISTINCT {', '.join(_COLUMNS[n].split())} FROM {_SQL_TABLE[n]})" for n in _SQL_TABLE))
def cl_dedup(t: Star) -> DataFrame:
    """All five tables with a third of their rows repeated, freed of repeated full rows."""
    single = clean.clean({f"copy of {n}": _with_copies(n, df) for n, df in t.tables().items()})
    return _union([df.agg(F.lit(n.removeprefix("copy of ")).alias("table_name"), F.count("*").alias("n"), *[
        F.count_distinct(c).alias(f"d{i}") for i, c in enumerate(_COLUMNS[n.removeprefix("copy of ")].split()[:6])])
        for n, df in single.items()])


def _column_counts(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, filled rows and different values of each column, every column in a narrow pass of its own.

    Several distinct counts in one pass would shuffle each row once per column, at its full width.
    """
    counted = []
    for c in columns:
        values = df.groupBy(c).agg(F.count("*").alias("_n"))
        total = lambda n: F.coalesce(F.sum(n), F.lit(0))
        counted.append(values.agg(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), total("_n").alias("n"),
            total(F.when(F.col(c).isNotNull(), F.col("_n"))).alias("filled"), F.count(c).alias("different")))
    return _union(counted)


@query("snk_csv", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, COUNT(*) AS n, COUNT({c}) AS filled, "
    f"COUNT(DISTINCT {c}) AS different FROM ({_CLEAN[n]})" for n in _CLEAN for c in _COLUMNS[n].split()))
def snk_csv(t: Star) -> DataFrame:
    """All five cleaned tables as CSV, read back and counted column by column."""
    folder = scratch_path(t.spark, "processed")
    cleaned = clean.clean(t.tables(), TODAY)
    writers.write_processed_csv(cleaned, folder)
    parts = []
    for name, df in cleaned.items():
        back = t.spark.read.schema(df.schema).option("header", True).option("enforceSchema", False).csv(
            f"{folder}/{name}_processed.csv")
        columns = _COLUMNS[name].split()
        parts.append(_column_counts(name, stage(back.select(*columns), "back"), columns))
    return _union(parts)


@query("cl_row_delta", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS rows_in, (SELECT COUNT(*) FROM ({_CLEAN[n]})) AS rows_out "
    f"FROM {s}" for n, s in _SQL_TABLE.items()))
def cl_row_delta(t: Star) -> DataFrame:
    return clean.row_deltas(t.tables(), TODAY)


# -- summary tables ----------------------------------------------------------


def _customer_summary_sql(weight: str) -> str:
    return f"""
        WITH j AS ({weight}),
        g AS (SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders,
                     {even(msum('total_amount'))} AS total_spent,
                     {even(mavg('total_amount'))} AS avg_order_value,
                     MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
                     {big('SUM(quantity)')} AS total_items FROM j GROUP BY 1)
        SELECT *, CAST(date_diff('day', last_order_date, (SELECT d FROM r_today)) AS INTEGER) AS recency_days,
               total_orders AS frequency, total_spent AS monetary FROM g"""


@query("a1_customer_summary", _customer_summary_sql(
    "SELECT o.*, i.quantity FROM r_orders o JOIN r_items i ON o.order_id = i.order_id"))
def a1_customer_summary(t: Star) -> DataFrame:
    return marts.customer_summary(t.orders, t.order_items)


@query("a1_customer_summary_order_grain", _customer_summary_sql(
    "SELECT o.*, i.quantity FROM r_orders o JOIN (SELECT order_id, SUM(quantity) AS quantity "
    "FROM r_items GROUP BY 1) i ON o.order_id = i.order_id"))
def a1_order_grain(t: Star) -> DataFrame:
    return marts.customer_summary(t.orders, t.order_items, order_grain=True)


@query("a2_product_performance", f"""
    SELECT i.product_id, {big('SUM(i.quantity)')} AS total_quantity_sold,
           {even(msum('i.total_price'))} AS total_revenue, COUNT(DISTINCT i.order_id) AS unique_orders
    FROM r_orders o JOIN r_items i ON o.order_id = i.order_id GROUP BY 1""")
def a2_product_performance(t: Star) -> DataFrame:
    return marts.product_performance(t.orders, t.order_items)


@query("a3_monthly_sales", f"""
    SELECT CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
           COUNT(order_id) AS total_orders, {even(msum('total_amount'))} AS total_revenue,
           COUNT(DISTINCT customer_id) AS unique_customers
    FROM r_orders GROUP BY ALL""")
def a3_monthly_sales(t: Star) -> DataFrame:
    return marts.monthly_sales(t.orders)


# -- joins -------------------------------------------------------------------

_LINE = "order_id, customer_id, order_date, total_amount, order_item_id, product_id, quantity, total_price"


@query("j1_join_inner_orders_items", f"SELECT {_LINE} FROM r_orders JOIN r_items USING (order_id)")
def j1_join(t: Star) -> DataFrame:
    return joins.orders_with_items(t.orders, t.order_items).select(*_LINE.split(", "))


@query("j2_join_left_collapsed", f"""
    SELECT c.customer_id, c.country, o.order_id, o.total_amount, i.order_item_id, i.quantity
    FROM r_customers c LEFT JOIN r_orders o ON c.customer_id = o.customer_id
         LEFT JOIN r_items i ON o.order_id = i.order_id WHERE o.{REALISED}""")
def j2_join(t: Star) -> DataFrame:
    return joins.realised_order_lines(t.customers, t.orders, t.order_items).select(
        "customer_id", "country", "order_id", "total_amount", "order_item_id", "quantity")


@query("j3_join_four_way_left", """
    SELECT c.customer_id, o.order_id, o.order_status, i.order_item_id, i.quantity, p.category
    FROM r_customers c LEFT JOIN r_orders o ON c.customer_id = o.customer_id
         LEFT JOIN r_items i ON o.order_id = i.order_id
         LEFT JOIN r_products p ON i.product_id = p.product_id
    WHERE o.order_status IN ('Completed', 'Delivered', 'Returned', 'Cancelled')""")
def j3_join(t: Star) -> DataFrame:
    return joins.churn_order_lines(t.customers, t.orders, t.order_items, t.products).select(
        "customer_id", "order_id", "order_status", "order_item_id", "quantity", "category")


@query("j4_join_three_way_inner", """
    SELECT o.order_id, o.order_date, i.order_item_id, i.quantity, p.product_id, p.product_name, p.brand
    FROM r_orders o JOIN r_items i ON o.order_id = i.order_id
         JOIN r_products p ON i.product_id = p.product_id""")
def j4_join(t: Star) -> DataFrame:
    return joins.product_order_lines(t.orders, t.order_items, t.products).select(
        "order_id", "order_date", "order_item_id", "quantity", "product_id", "product_name", "brand")


@query("j5_join_mixed", """
    SELECT c.customer_id, c.email, s.churn_probability, s.segment_name, o.order_id, o.total_amount
    FROM r_customers c JOIN r_segments s ON c.customer_id = s.customer_id
         LEFT JOIN r_orders o ON c.customer_id = o.customer_id
    WHERE s.churn_probability > 0.5""")
def j5_join(t: Star) -> DataFrame:
    return joins.scored_customer_orders(t.customers, segments(t), t.orders, 0.5).select(
        "customer_id", "email", "churn_probability", "segment_name", "order_id", "total_amount")


@query("j6_join_left_overlay", """
    SELECT s.customer_id, s.segment_name, coalesce(n.p, s.churn_probability) AS churn_probability
    FROM r_segments s LEFT JOIN (SELECT customer_id, 1 - churn_probability AS p FROM r_scores
                                 WHERE churn_probability < 0.3) n USING (customer_id)""")
def j6_join(t: Star) -> DataFrame:
    old = segments(t).select("customer_id", "segment_name", "churn_probability")
    new = scores(t).filter(F.col("churn_probability") < 0.3).select(
        "customer_id", (1 - F.col("churn_probability")).alias("churn_probability"))
    return joins.overlay_scores(old, new)
