"""Retail tables played by a customer/part/orders/lineitem star schema.

The star schema has no e-mail, age, cost, stock, discount or returned orders,
so those columns are stand-ins computed from stored ones by the rules below.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.functions.scalars import round_half_even
from tillsight.sources.schemas import STAR


class Star:
    """The retail tables over ``<folder>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        """Customers without registration date (see ``registered``)."""
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("country"))
        mail = F.concat("c_name", F.lit("@"), F.lower("country"), F.lit(".example"))
        return (self.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .select(F.col("c_custkey").alias("customer_id"),
                        F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(mail).alias("email"),
                        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
                        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
                        "country",
                        F.lit("unknown").alias("city"),
                        F.floor(F.col("c_acctbal") / 80).cast("int").alias("age"),
                        F.col("c_mktsegment").alias("gender")))

    @cached_property
    def registered(self) -> DataFrame:
        """Customers registered on the day of their first order."""
        first = (self.orders.groupBy("customer_id")
                 .agg(F.min("order_date").alias("registration_date")))
        return self.customers.join(first, "customer_id", "left")

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("Size "), F.col("p_size").cast("string")).alias("subcategory"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("price"),
            (F.col("p_retailprice") - F.col("p_size")).alias("cost"),
            (F.col("p_size") - 5).alias("stock_quantity"))

    @cached_property
    def orders(self) -> DataFrame:
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_totalprice").alias("total_amount"),
            F.when(priority == "1-URGENT", round_half_even(F.col("o_totalprice") * 0.1))
            .otherwise(0.0).alias("discount_amount"),
            F.when(F.col("o_totalprice") < 1000, 5.0).otherwise(0.0).alias("shipping_cost"),
            F.when(status == "F", "Completed").when(status == "O", "Delivered")
            .when(priority.isin("1-URGENT", "2-HIGH"), "Cancelled")
            .when(priority == "3-MEDIUM", "Returned")
            .when(priority == "5-LOW", "Shipped").otherwise("Processing").alias("order_status"),
            priority.alias("payment_method"),
            # The stored timestamp, so that date bounds reach the file scan.
            F.col("o_orderdate").alias("order_date_ts"))

    @cached_property
    def order_items(self) -> DataFrame:
        return self.raw("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            round_half_even(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("l_extendedprice").alias("total_price"))

    @cached_property
    def campaigns(self) -> DataFrame:
        """One campaign per order line, running from order to shipping day."""
        orders = self.raw("orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
        return (self.raw("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                .select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("campaign_id"),
                        F.col("o_orderpriority").alias("campaign_type"),
                        F.col("o_orderdate").cast("date").alias("start_date"),
                        F.col("l_shipdate").cast("date").alias("end_date"),
                        (F.col("l_extendedprice") - 2000).alias("budget"),
                        F.col("l_returnflag").alias("target_segment"),
                        F.col("l_discount").alias("conversion_rate"),
                        F.col("l_tax").alias("roi")))

    def tables(self) -> dict[str, DataFrame]:
        """The five raw tables by name."""
        return {"customers": self.registered, "products": self.products,
                "orders": self.orders.drop("order_date_ts"), "order_items": self.order_items,
                "marketing_campaigns": self.campaigns}

    def events(self) -> DataFrame:
        return self.raw("events")

    def event_stream(self) -> DataFrame:
        """The events as a file stream with a zoned event time."""
        stream = (self.spark.readStream.schema(STAR["events"])
                  .parquet(f"{self.folder}/events*.parquet"))
        return stream.withColumn("ts", F.col("ts").cast("timestamp"))
