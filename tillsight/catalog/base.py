"""Registry of checked queries and the SQL of the shared tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.functions.scalars import is_realised, ratio
from tillsight.operators import rfm
from tillsight.operators.churn import churn_base
from tillsight.session import tune_sales
from tillsight.sources.star import Star


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the star tables, with the SQL that must agree."""
    def keep(fn: Callable[[Star], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(lambda spark, folder: fn(Star(tune_sales(spark), folder)),
                               None if sql is None else with_tables(sql))
        return fn
    return keep


# -- SQL building blocks -----------------------------------------------------


def msum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mavg(x: str) -> str:
    return f"({msum(x)} / COUNT({x}))"


def even(x: str, digits: int = 2) -> str:
    return f"(round_even(CAST({x} AS DOUBLE) * {10**digits}, 0) / {10**digits})"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


REALISED = "order_status IN ('Completed', 'Delivered')"
_Q = "[0, 0.2, 0.4, 0.6000000000000001, 0.8, 1]"


def quintile(x: str, edges: str) -> str:
    above = " + ".join(f"CAST({x} > {edges}[{i}] AS INTEGER)" for i in range(2, 6))
    return f"(1 + {above})"


def segment_case(code: str) -> str:
    arms = " ".join(
        f"WHEN {code} IN ({', '.join(repr(c) for c in codes)}) THEN '{name}'"
        for name, codes in rfm.SEGMENT_SCORES.items())
    return f"CASE {arms} ELSE '{rfm.OTHER_SEGMENT}' END"


# Tables the SQL twins share; a query gets those it names, with what they need.
TABLES = {
    "r_customers": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_acctbal < 0 THEN c_name
                    ELSE c_name || '@' || lower(n_name) || '.example' END AS email,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               n_name AS country, 'unknown' AS city,
               CAST(floor(c_acctbal / 80) AS INTEGER) AS age, c_mktsegment AS gender
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "r_registered": """
        SELECT c.*, f.registration_date FROM r_customers c LEFT JOIN
          (SELECT customer_id, min(order_date) AS registration_date FROM r_orders GROUP BY 1) f
          USING (customer_id)""",
    "r_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               'Size ' || p_size AS subcategory, p_brand AS brand, p_retailprice AS price,
               p_retailprice - p_size AS cost, p_size - 5 AS stock_quantity
        FROM part""",
    "r_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS total_amount,
               CASE WHEN o_orderpriority = '1-URGENT'
                    THEN round_even(o_totalprice * CAST(0.1 AS DOUBLE) * 100, 0) / 100
                    ELSE CAST(0 AS DOUBLE) END AS discount_amount,
               CASE WHEN o_totalprice < 1000 THEN CAST(5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
                    AS shipping_cost,
               CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN 'Delivered'
                    WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Cancelled'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'Returned'
                    WHEN o_orderpriority = '5-LOW' THEN 'Shipped' ELSE 'Processing' END AS order_status,
               o_orderpriority AS payment_method
        FROM orders""",
    "r_items": """
        SELECT l_orderkey * 8 + l_linenumber AS order_item_id, l_orderkey AS order_id,
               l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
               round_even(l_extendedprice / l_quantity * 100, 0) / 100 AS unit_price,
               l_extendedprice AS total_price
        FROM lineitem""",
    "r_campaigns": """
        SELECT l_orderkey * 8 + l_linenumber AS campaign_id, o_orderpriority AS campaign_type,
               CAST(o_orderdate AS DATE) AS start_date, CAST(l_shipdate AS DATE) AS end_date,
               l_extendedprice - 2000 AS budget, l_returnflag AS target_segment,
               l_discount AS conversion_rate, l_tax AS roi
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "r_today": "SELECT max(order_date) AS d FROM r_orders",
    # Stand-in for a churn probability: share of a customer's orders not sold.
    "r_scores": f"""
        SELECT customer_id, CAST(COUNT(*) FILTER (NOT {REALISED}) AS DOUBLE) / COUNT(*)
               AS churn_probability
        FROM r_orders GROUP BY customer_id""",
    "r_segment_base": f"""
        SELECT c.customer_id, c.email, c.first_name, c.last_name, c.country, c.age,
               COUNT(DISTINCT o.order_id) AS total_orders, {msum('o.total_amount')} AS total_spent,
               {mavg('o.total_amount')} AS avg_order_value, MIN(o.order_date) AS first_order_date,
               MAX(o.order_date) AS last_order_date, {big('SUM(oi.quantity)')} AS total_items_purchased
        FROM r_customers c LEFT JOIN r_orders o ON c.customer_id = o.customer_id
             LEFT JOIN r_items oi ON o.order_id = oi.order_id
        WHERE o.{REALISED}
        GROUP BY ALL HAVING COUNT(DISTINCT o.order_id) > 0""",
    "r_rfm": f"""
        WITH b AS (SELECT *, date_diff('day', last_order_date,
                            (SELECT max(last_order_date) FROM r_segment_base)) AS recency,
                          row_number() OVER (ORDER BY total_orders, customer_id) AS rk
                   FROM r_segment_base),
             e AS (SELECT quantile_cont(CAST(recency AS DOUBLE), {_Q}) AS re,
                          quantile_cont(CAST(rk AS DOUBLE), {_Q}) AS fe,
                          quantile_cont(total_spent, {_Q}) AS me FROM b),
             s AS (SELECT b.* EXCLUDE (rk, recency), CAST(recency AS INTEGER) AS recency,
                          total_orders AS frequency,
                          total_spent AS monetary, 6 - {quintile('recency', 're')} AS recency_score,
                          {quintile('rk', 'fe')} AS frequency_score,
                          {quintile('total_spent', 'me')} AS monetary_score FROM b, e),
             c AS (SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR)
                             || CAST(monetary_score AS VARCHAR) AS rfm_score FROM s)
        SELECT *, {segment_case('rfm_score')} AS rfm_segment FROM c""",
    "r_clv": f"""
        WITH l AS (SELECT *, CAST(date_diff('day', first_order_date, last_order_date) AS INTEGER)
                             AS customer_lifespan_days FROM r_rfm),
             f AS (SELECT *, CAST(frequency AS DOUBLE) / (customer_lifespan_days + 1)
                             AS purchase_frequency FROM l)
        SELECT *, {even('''avg_order_value * purchase_frequency
                 * (SELECT CAST(SUM(customer_lifespan_days) AS DOUBLE) / COUNT(*) FROM l)''')}
               AS predicted_clv FROM f""",
    "r_segments": """
        SELECT customer_id, rfm_segment AS segment_name, rfm_score, recency_score, frequency_score,
               monetary_score, predicted_clv AS clv_prediction, churn_probability
        FROM r_clv LEFT JOIN r_scores USING (customer_id)""",
    "r_sales_base": f"""
        SELECT o.order_date, p.product_id, p.product_name, p.category, p.subcategory, p.brand, p.price,
               {big('SUM(oi.quantity)')} AS quantity_sold, {msum('oi.total_price')} AS revenue,
               COUNT(DISTINCT o.order_id) AS order_count,
               COUNT(DISTINCT o.customer_id) AS unique_customers
        FROM r_orders o JOIN r_items oi ON o.order_id = oi.order_id
             JOIN r_products p ON oi.product_id = p.product_id
        WHERE o.{REALISED} GROUP BY ALL""",
    "r_daily": f"""
        WITH t AS (SELECT order_date AS ds, {big('SUM(quantity_sold)')} AS quantity_sold,
                          {msum('revenue')} AS revenue, {big('SUM(order_count)')} AS order_count,
                          {big('SUM(unique_customers)')} AS unique_customers
                   FROM r_sales_base GROUP BY 1),
             g AS (SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
                   FROM t)
        SELECT g.ds, coalesce(quantity_sold, 0) AS quantity_sold, coalesce(revenue, 0) AS revenue,
               coalesce(order_count, 0) AS order_count, coalesce(unique_customers, 0) AS unique_customers
        FROM g LEFT JOIN t USING (ds)""",
    "r_churn_base": f"""
        WITH m AS (
          SELECT c.customer_id, c.age, c.gender, c.country, c.registration_date,
                 COUNT(DISTINCT o.order_id) AS total_orders, {msum('o.total_amount')} AS total_spent,
                 {mavg('o.total_amount')} AS avg_order_value, MIN(o.order_date) AS first_order_date,
                 MAX(o.order_date) AS last_order_date, {big('SUM(oi.quantity)')} AS total_items,
                 COUNT(DISTINCT p.category) AS categories_purchased,
                 COUNT(DISTINCT date_trunc('month', o.order_date)) AS active_months,
                 {mavg('o.discount_amount')} AS avg_discount,
                 COUNT(CASE WHEN o.order_status = 'Returned' THEN 1 END) AS return_count,
                 COUNT(CASE WHEN o.order_status = 'Cancelled' THEN 1 END) AS cancel_count
          FROM r_registered c LEFT JOIN r_orders o ON c.customer_id = o.customer_id
               LEFT JOIN r_items oi ON o.order_id = oi.order_id
               LEFT JOIN r_products p ON oi.product_id = p.product_id
          WHERE o.order_status IN ('Completed', 'Delivered', 'Returned', 'Cancelled')
          GROUP BY c.customer_id, c.age, c.gender, c.country, c.registration_date
          HAVING COUNT(DISTINCT o.order_id) > 0)
        SELECT *, CAST(date_diff('day', last_order_date, (SELECT d FROM r_today)) AS INTEGER)
                    AS days_since_last_order,
               CAST(date_diff('day', first_order_date, last_order_date) AS INTEGER)
                    AS customer_lifetime_days,
               total_spent / NULLIF(total_orders, 0) AS calculated_aov,
               total_orders // NULLIF(active_months, 0) AS orders_per_month,
               CAST(return_count AS DOUBLE) / NULLIF(total_orders, 0) AS return_rate,
               CAST(cancel_count AS DOUBLE) / NULLIF(total_orders, 0) AS cancel_rate
        FROM m""",
    "r_churn_labels": """
        WITH f AS (SELECT *, CAST(days_since_last_order > 90 AS INTEGER) AS is_churned,
                          CAST(return_rate > 0.2 AS INTEGER) AS high_return_rate,
                          CAST(cancel_rate > 0.1 AS INTEGER) AS high_cancel_rate,
                          CAST(orders_per_month < 0.5 AS INTEGER) AS low_engagement
                   FROM r_churn_base)
        SELECT *, is_churned + high_return_rate + high_cancel_rate + low_engagement AS churn_risk_score,
               CAST(is_churned + high_return_rate + high_cancel_rate + low_engagement >= 2 AS INTEGER)
                    AS churn_label
        FROM f""",
    "r_churn_features": f"""
        WITH b AS (SELECT *, row_number() OVER (ORDER BY total_orders, customer_id) AS rk
                   FROM r_churn_labels),
             e AS (SELECT quantile_cont(CAST(days_since_last_order AS DOUBLE), {_Q}) AS re,
                          quantile_cont(CAST(rk AS DOUBLE), {_Q}) AS fe,
                          quantile_cont(total_spent, {_Q}) AS me FROM b),
             s AS (SELECT b.* EXCLUDE (rk), 6 - {quintile('days_since_last_order', 're')} AS recency_score,
                          {quintile('rk', 'fe')} AS frequency_score,
                          {quintile('total_spent', 'me')} AS monetary_score,
                          CAST(customer_lifetime_days AS DOUBLE) / total_orders AS avg_days_between_orders,
                          total_spent / (customer_lifetime_days + 1) AS spending_trend,
                          CAST(categories_purchased AS DOUBLE) / total_orders AS diversity_score,
                          CAST(date_diff('day', registration_date, (SELECT d FROM r_today)) AS INTEGER)
                               AS tenure_days
                   FROM b, e)
        SELECT *, CAST(tenure_days AS DOUBLE) / 30 AS tenure_months,
               active_months / (CAST(tenure_days AS DOUBLE) / 30 + 1) AS engagement_ratio,
               CAST(total_orders AS DOUBLE) / (tenure_days + 1) AS purchase_intensity
        FROM s""",
}


def with_tables(body: str) -> str:
    """Prefix the shared tables a query names."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\br_[a-z_]+\b", text):
            if name in TABLES and name not in order:
                need(TABLES[name])
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body.strip()
    tables = ",\n".join(f"{n} AS ({TABLES[n].strip()})" for n in order)
    body = body.strip()
    joined = f", {body[4:].strip()}" if body.upper().startswith("WITH") else f"\n{body}"
    return f"WITH {tables}{joined}"


# -- frames that mirror the tables above -------------------------------------


def scores(t: Star) -> DataFrame:
    """Share of each customer's orders that were not sold, as a probability."""
    lost = F.count(F.when(~is_realised(), 1))
    return t.orders.groupBy("customer_id").agg(ratio(lost, F.count("*")).alias("churn_probability"))


def segment_base(t: Star) -> DataFrame:
    return rfm.segment_base(t.customers, t.orders, t.order_items)


def labelled(t: Star) -> DataFrame:
    return rfm.rfm_labels(rfm.rfm_scores(segment_base(t)))


def segments(t: Star) -> DataFrame:
    """The segment table with the stand-in probability."""
    stored = rfm.segments_table(rfm.clv(labelled(t))).drop("kmeans_cluster", "churn_probability")
    return stored.join(scores(t), "customer_id", "left")


def churn(t: Star) -> DataFrame:
    return churn_base(t.registered, t.orders, t.order_items, t.products)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round averages whose last bits depend on the order of addition."""
    scale = float(10**digits)
    return df.withColumns({c: F.rint(F.col(c) * scale) / scale for c in columns})
