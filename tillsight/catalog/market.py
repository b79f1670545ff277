"""Baskets, recommendations, attribution and tests of independence."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.catalog import base
from tillsight.catalog.base import REALISED, even, msum, query, rounded
from tillsight.operators import attribution, baskets, hypothesis, recommend
from tillsight.sources.star import Star

# Brands bought together: the share of orders that an itemset must reach, and its items at most.
SUPPORT, LONGEST = 0.003, 3

base.TABLES["r_brands"] = f"""
    SELECT DISTINCT o.order_id, p.brand FROM r_orders o JOIN r_items i ON o.order_id = i.order_id
    JOIN r_products p ON i.product_id = p.product_id WHERE o.{REALISED} AND p.brand IS NOT NULL"""
base.TABLES["r_sets"] = f"""
    WITH n AS (SELECT COUNT(DISTINCT order_id) AS n FROM r_brands),
    s AS (SELECT [brand] AS items, COUNT(*) AS orders FROM r_brands GROUP BY 1
          UNION ALL SELECT [a.brand, b.brand], COUNT(*) FROM r_brands a JOIN r_brands b
                    ON a.order_id = b.order_id AND a.brand < b.brand GROUP BY 1
          UNION ALL SELECT [a.brand, b.brand, c.brand], COUNT(*) FROM r_brands a JOIN r_brands b
                    ON a.order_id = b.order_id AND a.brand < b.brand JOIN r_brands c
                    ON b.order_id = c.order_id AND b.brand < c.brand GROUP BY 1)
    SELECT items, len(items) AS size, orders, n FROM s, n WHERE orders >= ceil(CAST({SUPPORT} AS DOUBLE) * n)"""
base.TABLES["r_rules"] = """
    WITH x AS (SELECT orders, n, unnest(items) AS consequent, items FROM r_sets WHERE size >= 2),
    y AS (SELECT *, list_filter(items, lambda i: i <> consequent) AS antecedent FROM x)
    SELECT y.antecedent, y.consequent, y.orders, a.orders AS a, c.orders AS c, y.n,
           CAST(y.orders AS DOUBLE) / a.orders AS confidence
    FROM y JOIN r_sets a ON a.items = y.antecedent JOIN r_sets c ON c.items = [y.consequent]"""


def _baskets(t: Star) -> DataFrame:
    return baskets.baskets(t.orders, t.order_items, t.products, "brand")


def _sets(t: Star) -> DataFrame:
    return baskets.frequent_itemsets(_baskets(t), SUPPORT, LONGEST)


@query("ex_market_basket", """
    SELECT array_to_string(items, ' + ') AS items, CAST(size AS INTEGER) AS size, orders,
           orders / CAST(n AS DOUBLE) AS support FROM r_sets""")
def ex_market_basket(t: Star) -> DataFrame:
    """Itemsets of one to three brands."""
    return _sets(t).select(F.array_join("items", " + ").alias("items"), "size", "orders", "support")


@query("ex_basket_rules", f"""
    SELECT array_to_string(antecedent, ' + ') AS antecedent, consequent, orders, {even('orders / CAST(n AS DOUBLE)', 8)} AS support,
           {even('confidence', 8)} AS confidence, {even('confidence / (CAST(c AS DOUBLE) / n)', 8)} AS lift,
           {even('orders / CAST(n AS DOUBLE) - CAST(a AS DOUBLE) / n * (CAST(c AS DOUBLE) / n)', 8)} AS leverage,
           {even('(1 - CAST(c AS DOUBLE) / n) / nullif(1 - confidence, 0)', 8)} AS conviction
    FROM r_rules WHERE confidence >= CAST(0.2 AS DOUBLE)""")
def ex_basket_rules(t: Star) -> DataFrame:
    """Rules of one or two brands that hold in a fifth of the cases."""
    rules = baskets.association_rules(_sets(t), 0.2)
    return rounded(rules.withColumn("antecedent", F.array_join("antecedent", " + ")), 8,
                   "support", "confidence", "lift", "leverage", "conviction")


@query("ex_basket_suggestions", f"""
    WITH b AS (SELECT order_id, list(brand) AS items FROM r_brands GROUP BY 1),
    h AS (SELECT order_id, consequent AS item, max(confidence) AS confidence FROM b JOIN r_rules r
          ON list_has_all(b.items, r.antecedent) AND NOT list_contains(b.items, r.consequent) GROUP BY 1, 2),
    p AS (SELECT *, CAST(row_number() OVER (PARTITION BY order_id ORDER BY confidence DESC, item) AS INTEGER) AS place FROM h)
    SELECT order_id, place, item, {even('confidence', 8)} AS confidence FROM p WHERE place <= 3""")
def ex_basket_suggestions(t: Star) -> DataFrame:
    """Three brands for each order that its own brands point to."""
    found = baskets.suggestions(_baskets(t), baskets.association_rules(_sets(t)))
    return rounded(found, 8, "confidence")


def _recommended(t: Star) -> tuple[recommend.Recommender, DataFrame]:
    made = recommend.train(recommend.purchases(t.orders, t.order_items))
    return made, recommend.recommend(made, 10)


@query("ex_recommend")
def ex_recommend(t: Star) -> DataFrame:
    """Ten products for every customer with a purchase."""
    return _recommended(t)[1]


@query("ex_recommend_check", f"""
    WITH p AS (SELECT DISTINCT o.customer_id, i.product_id FROM r_orders o JOIN r_items i ON o.order_id = i.order_id WHERE o.{REALISED}),
    n AS (SELECT COUNT(DISTINCT product_id) AS n FROM p)
    SELECT customer_id, least(10, any_value(n) - COUNT(*)) AS products, least(10, any_value(n) - COUNT(*)) AS last_place,
           TRUE AS falls, CAST(0 AS BIGINT) AS bought FROM p, n GROUP BY 1""")
def ex_recommend_check(t: Star) -> DataFrame:
    """Every customer with a purchase gets ten different products, none bought before, by falling score."""
    made, found = _recommended(t)
    had = made.bought.join(made.customers, "_u").join(made.products, "_i").select("customer_id", "product_id", F.lit(1).alias("had"))
    listed = found.join(had, ["customer_id", "product_id"], "left").groupBy("customer_id").agg(
        F.count_distinct("product_id").alias("products"), F.max("place").cast("long").alias("last_place"),
        F.sort_array(F.collect_list(F.struct("place", "score"))).alias("s"), F.count("had").alias("bought"))
    falls = F.transform("s", lambda s: s["score"]) == F.reverse(F.array_sort(F.transform("s", lambda s: s["score"])))
    return listed.select("customer_id", "products", "last_place", falls.alias("falls"), "bought")


def _shares(weight: str) -> str:
    return f"""
    c AS MATERIALIZED (SELECT *, row_number() OVER () AS r, {weight} AS w FROM r_campaigns),
    d AS (SELECT order_date, CAST(SUM(round_even(total_amount * 100, 0)) AS HUGEINT) AS cents FROM r_orders WHERE {REALISED} GROUP BY 1),
    j AS (SELECT r, w, order_date, cents FROM c JOIN d ON order_date BETWEEN start_date AND end_date WHERE w > 0),
    t AS (SELECT order_date, CAST(SUM(w) AS HUGEINT) AS total FROM j GROUP BY 1),
    a AS (SELECT r, (CAST(SUM(w * (cents * 1000000000000000 // total)) AS HUGEINT) + 50000000000) // 100000000000 AS micro FROM j JOIN t USING (order_date)
          GROUP BY 1)"""


@query("ex_attribution", f"""
    WITH {_shares('CAST(1 AS HUGEINT)')}
    SELECT campaign_id, coalesce(micro, 0) / CAST(1000000 AS DOUBLE) AS attributed_revenue FROM c LEFT JOIN a USING (r)""")
def ex_attribution(t: Star) -> DataFrame:
    """Each day's revenue in equal shares to the campaigns that ran."""
    return attribution.campaign_revenue(t.campaigns, t.orders).select("campaign_id", "attributed_revenue")


@query("ex_attribution_roi", f"""
    WITH {_shares('CAST(round_even(budget * 100, 0) AS HUGEINT)')},
    k AS (SELECT campaign_type, target_segment, COUNT(*) AS campaigns,
                 CAST(coalesce(SUM(round_even(budget * 100, 0)) FILTER (budget > 0), 0) AS DOUBLE) / 100 AS budget,
                 CAST(coalesce(SUM(micro), 0) AS DOUBLE) / 1000000 AS attributed_revenue
          FROM c LEFT JOIN a USING (r) GROUP BY 1, 2)
    SELECT *, {even('(attributed_revenue - budget) / nullif(budget, 0)', 8)} AS attributed_roi FROM k""")
def ex_attribution_roi(t: Star) -> DataFrame:
    """Shares by budget, and the return of each kind of campaign."""
    found = attribution.campaign_revenue(t.campaigns, t.orders, weight="budget")
    return rounded(attribution.attributed_roi(found), 8, "attributed_roi")


@query("ex_order_attribution", f"""
    SELECT order_id, total_amount AS revenue, COUNT(campaign_id) AS campaigns,
           {even('total_amount / nullif(COUNT(campaign_id), 0)', 6)} AS revenue_per_campaign
    FROM r_orders LEFT JOIN r_campaigns ON order_date BETWEEN start_date AND end_date WHERE {REALISED} GROUP BY 1, 2""")
def ex_order_attribution(t: Star) -> DataFrame:
    """Every sold order with the number of campaigns that ran on its day."""
    return rounded(attribution.order_shares(t.orders, t.campaigns), 6, "revenue_per_campaign")


def _chi(name: str, a: str, b: str, table: str) -> str:
    return f"""
    SELECT '{name}' AS test, n, df AS degrees_of_freedom, {even('x', 6)} AS statistic, {even('''1 - list_sum(list_transform(range(1000),
             lambda k: exp(-x / 2 + (CAST(df AS DOUBLE) / 2 + k) * ln(x / 2) - lgamma(CAST(df AS DOUBLE) / 2 + k + 1))))''', 8)} AS p_value,
           {even('sqrt(x / (n * least_side))', 8)} AS cramers_v
    FROM (WITH o AS (SELECT CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, COUNT(*) AS o FROM {table}
                     WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2),
               r AS (SELECT a, SUM(o) AS r FROM o GROUP BY 1), c AS (SELECT b, SUM(o) AS c FROM o GROUP BY 1),
               n AS (SELECT SUM(o) AS n FROM o),
               e AS (SELECT coalesce(o, 0) AS o, CAST(r AS DOUBLE) * c / n AS e FROM r CROSS JOIN c CROSS JOIN n LEFT JOIN o USING (a, b))
          SELECT SUM((o - e) * (o - e) / e) AS x, (SELECT CAST(n AS BIGINT) FROM n) AS n,
                 ((SELECT COUNT(*) FROM r) - 1) * ((SELECT COUNT(*) FROM c) - 1) AS df,
                 least((SELECT COUNT(*) FROM r), (SELECT COUNT(*) FROM c)) - 1 AS least_side FROM e)"""


_TESTS = {"payment by quarter": ("payment_method", "quarter(order_date)", "r_orders"),
          "discount by quarter": ("discount_amount > 0", "quarter(order_date)", "r_orders"),
          "urgent by late half": ("payment_method = '1-URGENT'", "month(order_date) > 6", "r_orders"),
          "event by hour": ("event_type", "hour(ts)", "events")}


@query("ex_chi_square", " UNION ALL ".join(_chi(name, *parts) for name, parts in _TESTS.items()))
def ex_chi_square(t: Star) -> DataFrame:
    """Independence of categories: statistic, degrees of freedom (even and odd) and p."""
    out = None
    for name, (a, b, table) in _TESTS.items():
        source = t.orders if table == "r_orders" else t.events()
        row = hypothesis.chi_square_test(source.select(F.expr(a).alias("a"), F.expr(b).alias("b")), "a", "b")
        row = row.select(F.lit(name).alias("test"), "*")
        out = row if out is None else out.unionByName(row)
    return rounded(rounded(out, 6, "statistic"), 8, "p_value", "cramers_v")
