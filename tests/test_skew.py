"""A third of all rows on one order, customer and product: same results, split joins."""

import shutil

import duckdb
import pytest
from oracle import compare, connect

from __spark_entry__ import oracle_sql, queries
from tillsight import session
from tillsight.operators import joins, metrics
from tillsight.sources.star import Star

SOURCE = "/root/testdata/sf0.001"
CHECKED = ["a1_customer_summary", "a2_product_performance", "a4_segment_base", "a5_sales_base", "a6_churn_base",
           "a7_kpis", "a10_product_perf_all", "a13_high_risk_customers", "j1_join_inner_orders_items",
           "j2_join_left_collapsed", "j3_join_four_way_left", "j5_join_mixed", "dq_report", "dq_unique",
           "dq_fk_orphans", "w6_rank_first", "seg_clv", "fc_moving_average", "ch_feature_matrix", "ch_split"]
RUN, TWIN = queries(), oracle_sql()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in ("customer", "nation", "region", "supplier", "part", "events", "documents", "embeddings",
                 "pages", "benchmark", "labels", "conversations"):
        shutil.copy(f"{SOURCE}/{name}.parquet", folder)
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)
                          FROM '{SOURCE}/orders.parquet') TO '{folder}/orders.parquet' (FORMAT parquet)""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN l_linenumber % 3 = 0 THEN 8 ELSE l_orderkey END AS l_orderkey,
                                   CASE WHEN l_suppkey % 3 = 0 THEN 3 ELSE l_partkey END AS l_partkey)
                          FROM '{SOURCE}/lineitem.parquet') TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.fixture(scope="module")
def duck(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", CHECKED)
def test_skewed_results(spark, skewed, duck, name):
    assert compare(RUN[name](spark, skewed), duck, TWIN[name]) is None


def test_hot_join_key_is_split(spark, skewed):
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
             "spark.sql.files.maxPartitionBytes": "32KB"}
    old = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        star = Star(spark, skewed)
        # Several map tasks, so that one hot key arrives in several blocks.
        items = star.order_items.repartition(16, "order_item_id")
        joined = joins.orders_with_items(star.orders, items)
        assert joined.count() == star.order_items.join(star.orders.select("order_id"), "order_id").count()
        session.tune(spark)
        ranked = metrics.product_ranking(star.orders, items, star.products)
        for rows in (joined.select("order_id", "quantity"), ranked):
            rows.collect()
            assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
