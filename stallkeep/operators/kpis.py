"""Report tables with the main figures computed in advance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.operators.totals import exact_sum


def kpi_monthly(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Per month and customer state: orders, items, revenue and mean order value.

    Figures come from items and orders, never from the fact, whose payment
    fan-out would count an item several times. Each step sums before the next
    join: items per order, orders per customer and month, then the state.
    """
    per_order = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items"), exact_sum(F.col("price")).alias("revenue")
    )
    month = F.date_format("order_purchase_timestamp", "yyyy-MM").alias("month")
    per_customer = (
        orders.select("order_id", "customer_id", month)
        .join(per_order, "order_id")
        .groupBy("customer_id", "month")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("items").alias("items"), F.sum("revenue").alias("revenue"))
    )
    per_state = (
        per_customer.join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("month", "customer_state")
        .agg(F.sum("orders").alias("orders"), F.sum("items").alias("items"), F.sum("revenue").alias("revenue"))
    )
    return per_state.withColumn("mean_order_value", F.round(F.col("revenue") / F.col("orders"), 2))
