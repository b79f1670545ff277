"""Fixed schemas of the input and result tables."""

from pyspark.sql import types as T

_TYPES = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(),
          "DOUBLE": T.DoubleType(), "DATE": T.DateType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
          "MONEY": T.DecimalType(10, 2), "RATE": T.DecimalType(5, 4), "RETURN": T.DecimalType(10, 4)}


def _schema(text: str) -> T.StructType:
    """Schema from "name TYPE, ..." (no session needed)."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of the five raw tables, in file order.
RAW = {
    "customers": _schema(
        "customer_id BIGINT, email STRING, first_name STRING, last_name STRING, "
        "registration_date DATE, country STRING, city STRING, age INT, gender STRING"),
    "products": _schema(
        "product_id BIGINT, product_name STRING, category STRING, subcategory STRING, "
        "brand STRING, price MONEY, cost MONEY, stock_quantity INT"),
    "orders": _schema(
        "order_id BIGINT, customer_id BIGINT, order_date DATE, total_amount MONEY, "
        "discount_amount MONEY, shipping_cost MONEY, order_status STRING, "
        "payment_method STRING"),
    "order_items": _schema(
        "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
        "unit_price MONEY, total_price MONEY"),
    "marketing_campaigns": _schema(
        "campaign_id BIGINT, campaign_name STRING, campaign_type STRING, start_date DATE, "
        "end_date DATE, budget MONEY, target_segment STRING, "
        "conversion_rate RATE, roi RETURN"),
}

# Order in which tables are loaded, parents before children.
LOAD_ORDER = ("customers", "products", "orders", "order_items", "marketing_campaigns",
              "customer_segments", "sales_forecasts", "data_quality_logs")

# Result tables that a new run replaces; the others must not exist yet.
REPLACED_TABLES = ("customer_segments", "sales_forecasts", "data_quality_logs")

NOT_NULL = {
    "customers": ("customer_id", "email"),
    "products": ("product_id", "product_name"),
    "orders": ("order_id", "order_date"),
    "order_items": ("order_item_id", "quantity"),
}
UNIQUE = {
    "customers": (("customer_id",), ("email",)),
    "products": (("product_id",),),
    "orders": (("order_id",),),
    "order_items": (("order_item_id",),),
}
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
)

# Star-schema tables that can stand in for the retail tables (see star.py).
STAR = {
    "customer": _schema("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                        "c_mktsegment STRING"),
    "nation": _schema("n_nationkey INT, n_name STRING, n_regionkey INT"),
    "region": _schema("r_regionkey INT, r_name STRING"),
    "supplier": _schema("s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"),
    "part": _schema("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
                    "p_retailprice DOUBLE"),
    "orders": _schema("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
                      "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": _schema("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, "
                        "l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                        "l_shipdate TIMESTAMP_NTZ"),
    "events": _schema("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                      "value DOUBLE, props STRING"),
}
