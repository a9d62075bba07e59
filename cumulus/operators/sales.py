"""Retail sales: scans, order summary, sales by category.

Both summaries pre-aggregate the item fact table on the join key before
any wide join, so the shuffle carries one row per order / product instead
of one row per item, and a hot order or product is combined map-side
before it can skew a reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import concat_name

COMPLETED_OR_SHIPPED = ("completed", "shipped")


def scan(table: DataFrame) -> DataFrame:
    """``SELECT * FROM t``."""
    return table.select("*")


def order_summary(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Per order: customer name, date, status, amount and non-NULL item count.

    Inner joins, so orders without items and items without an order drop
    out. Counting per ``order_id`` first and summing the counts afterwards
    is exact for any join multiplicity. Joining customers before items lets
    the final grouping (which contains ``order_id``) reuse the items join's
    ``order_id`` partitioning instead of shuffling again.
    """
    per_order = items.groupBy("order_id").agg(F.count("product_id").alias("item_count"))
    named = orders.join(customers, "customer_id").select(
        "order_id", concat_name("first_name", "last_name").alias("customer_name"),
        "order_date", "status", "total_amount")
    return (named.join(per_order, "order_id")
            .groupBy("order_id", "customer_name", "order_date", "status", "total_amount")
            .agg(F.sum("item_count").alias("item_count"))
            .orderBy(F.col("order_date").desc_nulls_last(), F.col("order_id")))


def order_summary_stored(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """``order_summary`` of orders and items stored in buckets of ``order_id``.

    Items are counted and meet their orders in their buckets, without an
    exchange; only then does one row per order go to its customer.
    """
    per_order = items.groupBy("order_id").agg(F.count("product_id").alias("item_count"))
    counted = orders.join(per_order, "order_id")
    named = customers.select("customer_id", concat_name("first_name", "last_name").alias("customer_name"))
    return (counted.join(named, "customer_id")
            .groupBy("order_id", "customer_name", "order_date", "status", "total_amount")
            .agg(F.sum("item_count").alias("item_count"))
            .orderBy(F.col("order_date").desc_nulls_last(), F.col("order_id")))


def sales_by_category(items: DataFrame, products: DataFrame, orders: DataFrame,
                      statuses=COMPLETED_OR_SHIPPED, revenue=None) -> DataFrame:
    """Quantity and revenue per product category over qualifying orders.

    ``status = 'completed' OR status = 'shipped'`` (NULL status excluded).
    Items join the qualifying orders as two plain shuffles, so AQE's skew
    join splits an order that holds a large share of all items; the joined
    items are then summed per product (map-side partial aggregation) before
    the product join, so the last shuffles carry one row per product.
    ``revenue`` stands for ``quantity * unit_price`` where items are sums.
    """
    revenue = F.col("quantity") * F.col("unit_price") if revenue is None else revenue
    qualifying = orders.filter(F.col("status").isin(*statuses)).select("order_id")
    per_product = (items.join(qualifying, "order_id")
                   .groupBy("product_id")
                   .agg(F.sum("quantity").alias("q"),
                        F.sum(revenue).alias("rev")))
    return (per_product.join(products, "product_id")
            .groupBy("category")
            .agg(F.sum("q").alias("total_quantity_sold"), F.sum("rev").alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("category")))
