"""Purchase patterns over time, and product bands of our own making."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stallkeep.contracts import MONEY


def purchase_gaps(orders: DataFrame) -> DataFrame:
    """(customer_id, purchase_day, orders, days_since_previous), one row per day of purchase.

    Orders are counted per customer and day before the window, so a window holds
    one row per calendar day at most, however many orders a customer placed.
    """
    days = orders.groupBy("customer_id", F.to_date("order_purchase_timestamp").alias("purchase_day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    in_time = Window.partitionBy("customer_id").orderBy("purchase_day")
    gap = F.datediff("purchase_day", F.lag("purchase_day").over(in_time))
    return days.withColumn("days_since_previous", gap)


def purchase_rhythm(gaps: DataFrame, regular_days: int = 90) -> DataFrame:
    """Per customer: days of purchase, orders, gaps, and a label of the rhythm.

    'once' bought on one day; 'regular' never paused longer than `regular_days`;
    'slowing' paused longer and its last gap is its longest; else 'irregular'.
    """
    latest = F.max_by("days_since_previous", "purchase_day")
    longest = F.max("days_since_previous")
    label = (
        F.when(longest.isNull(), "once")
        .when(longest <= regular_days, "regular")
        .when(latest == longest, "slowing")
        .otherwise("irregular")
    )
    return gaps.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("purchase_days"),
        F.sum("orders").alias("orders"),
        F.min("days_since_previous").alias("shortest_gap"),
        longest.alias("longest_gap"),
        label.alias("rhythm"),
    )


def product_bands(
    products: DataFrame,
    items: DataFrame,
    price_limits: tuple[float, float] = (50.0, 200.0),
    size_limits: tuple[int, int] = (1_000, 50_000),
) -> DataFrame:
    """Products with a price band and a size band, and the two joined.

    The price is the mean price sold, the size is the volume in cubic cm; a
    product without a sale or without measures is in band 'unknown'.
    """

    def band(value, limits, names):
        low, high = limits
        return (
            F.when(value.isNull(), "unknown")
            .when(value < low, names[0])
            .when(value < high, names[1])
            .otherwise(names[2])
        )

    prices = items.groupBy("product_id").agg(
        F.count("price").alias("sold"), F.sum(F.col("price").cast(MONEY)).alias("revenue")
    )
    low, high = price_limits
    # Mean < limit, written without a division.
    revenue, sold = F.col("revenue"), F.col("sold")
    price_band = (
        F.when(revenue.isNull(), "unknown")
        .when(revenue < sold * F.lit(low).cast(MONEY), "cheap")
        .when(revenue < sold * F.lit(high).cast(MONEY), "middle")
        .otherwise("dear")
    )
    volume = (
        F.col("product_length_cm").cast("long") * F.col("product_height_cm").cast("long") * F.col("product_width_cm")
    )
    return (
        products.join(prices, "product_id", "left")
        .select(
            *products.columns,
            price_band.alias("price_band"),
            band(volume, size_limits, ("small", "medium", "large")).alias("size_band"),
        )
        .withColumn("product_band", F.concat_ws("-", "price_band", "size_band"))
    )
