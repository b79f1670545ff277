"""Market baskets: frequent itemsets, association rules and suggestions.

Itemsets come from FP-growth, which builds conditional pattern trees in the partitions and only extends what has the
minimum support: what is produced is bounded by the support, not by the pairs inside a basket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window, functions as F

from tillsight.functions.scalars import REALISED_STATUSES, is_realised
from tillsight.session import stage


def baskets(orders: DataFrame, items: DataFrame, products: DataFrame | None = None, by: str = "product_id",
            statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """(order_id, items): the different products of each sold order, or the values of a product's attribute."""
    sold = orders.filter(is_realised(statuses=statuses)).select("order_id")
    lines = items.select("order_id", "product_id").join(sold, "order_id")
    if by != "product_id":
        lines = lines.join(products.select("product_id", by), "product_id")
    # Sets are built map-side, so an order with very many lines shrinks to its different items.
    return (lines.filter(F.col(by).isNotNull()).groupBy("order_id")
            .agg(F.sort_array(F.collect_set(by)).alias("items")))


def frequent_itemsets(found: DataFrame, support: float, longest: int | None = None) -> DataFrame:
    """(items, size, orders, support, baskets): the sets in a share ``support`` of the baskets or more, items sorted."""
    rows = stage(found.select("items"), "baskets")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    model = FPGrowth(itemsCol="items", minSupport=support, numPartitions=parts).fit(rows)
    total = rows.agg(F.count("*").alias("n")).scalar()
    sets = model.freqItemsets.select(F.sort_array("items").alias("items"), F.size("items").alias("size"),
                                     F.col("freq").alias("orders"))
    sets = sets if longest is None else sets.filter(F.col("size") <= longest)
    return sets.select("*", (F.col("orders") / total).alias("support"), total.alias("baskets"))


def association_rules(itemsets: DataFrame, confidence: float = 0.0) -> DataFrame:
    """Rules ``antecedent -> consequent`` (one item) from every set of two items or more.

    ``lift`` compares the confidence with the consequent's own support, ``leverage`` the support with that of
    independent items; ``conviction`` is null where the rule never fails.
    """
    sets = stage(itemsets, "itemsets")
    known = sets.select(F.col("items").alias("_items"), F.col("orders").alias("_orders"))
    rules = sets.filter(F.col("size") >= 2).select("orders", "baskets", "items", F.explode("items").alias("consequent"))
    rules = rules.withColumn("antecedent", F.array_remove("items", F.col("consequent")))
    for part, name in ((F.col("antecedent"), "_a"), (F.array("consequent"), "_c")):
        side = known.withColumnRenamed("_orders", name)
        rules = rules.join(side, part == side["_items"]).drop("_items")
    n, both = F.col("baskets").cast("double"), F.col("orders").cast("double")
    sure, alone = both / F.col("_a"), F.col("_c") / n
    found = rules.select("antecedent", "consequent", F.col("orders"), (both / n).alias("support"), sure.alias("confidence"),
                         (sure / alone).alias("lift"), (both / n - F.col("_a") / n * alone).alias("leverage"),
                         ((1 - alone) / F.nullif(1 - sure, F.lit(0.0))).alias("conviction"))
    return found.filter(F.col("confidence") >= confidence)


def suggestions(found: DataFrame, rules: DataFrame, top: int = 3) -> DataFrame:
    """(order_id, place, item, confidence): the surest items that rules add to each basket.

    Rules are gathered by antecedent, so a basket meets each antecedent once, not once for every consequent.  An antecedent
    is looked up by its first item; the rest is checked on the pair.
    """
    gathered = rules.groupBy("antecedent").agg(F.collect_list(F.struct("consequent", "confidence")).alias("then"))
    keyed = gathered.withColumn("_first", F.col("antecedent")[0])
    met = (found.select("order_id", "items", F.explode("items").alias("_first")).join(keyed, "_first")
           .filter(F.size(F.array_except("antecedent", "items")) == 0))
    hits = (met.select("order_id", "items", F.inline("then"))
            .filter(~F.array_contains(F.col("items"), F.col("consequent"))))
    best = hits.groupBy("order_id", F.col("consequent").alias("item")).agg(F.max("confidence").alias("confidence"))
    place = F.row_number().over(Window.partitionBy("order_id").orderBy(F.col("confidence").desc(), "item"))
    return best.withColumn("place", place).filter(F.col("place") <= top)
