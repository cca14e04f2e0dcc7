"""Top-N categories with all others in one bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.session import stored

OTHER = "OUTROS"  # fixed value: the label of the bucket


def quantity_by_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Total quantity per product category over the fact.

    The fact is summed per product before the join, so a best-selling product
    is one row by then and not a hot join key.
    """
    per_product = sales.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    return (
        per_product.join(products.select("product_id", "product_category_name"), "product_id")
        .groupBy("product_category_name")
        .agg(F.sum("quantity").alias("total_quantity"))
    )


def top_n_with_other(totals: DataFrame, name: str, total: str, n: int = 10, other: str = OTHER) -> DataFrame:
    """Keep the n largest names and add up the rest under `other`.

    Ties are broken by name. A NULL name counts in the ranking but never equals
    itself, so its quantity goes to `other`.
    """
    leaders = totals.orderBy(F.desc(total), F.asc(name)).limit(n).select(F.col(name).alias("leader"))
    # At most n rows, so the broadcast cannot grow with the data.
    flagged = totals.join(F.broadcast(leaders), F.col(name) == F.col("leader"), "left")
    return flagged.groupBy(F.coalesce(F.col("leader"), F.lit(other)).alias(name)).agg(
        F.sum(total).alias(total)
    )


def with_rank(df: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """`df` in order, with the place of each row from 1; `order` should leave no ties.

    The rows are sorted by ranges, and stored so; a row's place is its place in its
    part and the rows of the parts before, of which there are a few numbers only. No
    task sees all rows.
    """
    place = F.monotonically_increasing_id()  # the part's number above 33 bits, the place in it below
    part, within = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    ordered = stored(df.orderBy(*order).withColumn("__place", place), "ordered")
    sizes = ordered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per part of the sort
    offsets = F.broadcast(sizes.select("__part", before.alias("__before")))
    ranked = ordered.withColumn("__part", part).join(offsets, "__part")
    return ranked.select(*df.columns, (F.col("__before") + within + 1).alias(rank))
