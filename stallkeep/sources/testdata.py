"""The given tables seen as the sales tables.

Every frame is derived by Spark from the whole given tables, so the work grows
with them. `SQL` holds the same mapping for the side-by-side check.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text(column: str):
    return F.col(column).cast("string")


class SalesTables:
    """Lazy stand-ins for the nine sales tables, typed as their contracts say."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def places(self) -> DataFrame:
        nation, region = self.given("nation"), self.given("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("zip"), F.col("n_name").alias("city"), F.col("r_name").alias("state")
        )

    @cached_property
    def customers(self) -> DataFrame:
        customer = self.given("customer")
        return customer.join(self.places, customer.c_nationkey == self.places.zip).select(
            text("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            F.col("zip").alias("customer_zip_code_prefix"),
            F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )

    @cached_property
    def customers_segmented(self) -> DataFrame:
        """Customers with the market segment in place of a computed one."""
        market = self.given("customer").select(
            text("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
        )
        return self.customers.join(market, "customer_id")

    @cached_property
    def customers_misspelt(self) -> DataFrame:
        """Customers whose city is written as people type it, by market segment."""
        customer = self.given("customer")
        city = F.lower("city")
        typed = (
            F.when(F.col("c_mktsegment") == "BUILDING", F.regexp_replace(city, "nation", "naton"))
            .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("  "), F.regexp_replace(F.upper("city"), "A", "Ã"), F.lit(" ")))
            .when(F.col("c_mktsegment") == "MACHINERY", F.regexp_replace(city, "nation", "mattion"))
            .otherwise(city)
        )
        return customer.join(self.places, customer.c_nationkey == self.places.zip).select(
            text("c_custkey").alias("customer_id"),
            F.col("zip").alias("customer_zip_code_prefix"),
            typed.alias("customer_city"),
            F.col("state").alias("customer_state"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        supplier = self.given("supplier")
        return supplier.join(self.places, supplier.s_nationkey == self.places.zip).select(
            text("s_suppkey").alias("seller_id"),
            F.col("zip").alias("seller_zip_code_prefix"),
            F.col("city").alias("seller_city"),
            F.col("state").alias("seller_state"),
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        """One row per supplier, so a postal code repeats and has two spellings."""
        supplier = self.given("supplier")
        spelling = F.when(F.col("s_acctbal") < 0, F.lower("city")).otherwise(F.col("city"))
        return supplier.join(self.places, supplier.s_nationkey == self.places.zip).select(
            F.col("zip").alias("geolocation_zip_code_prefix"),
            F.col("s_acctbal").alias("geolocation_lat"),
            (-F.col("s_acctbal")).alias("geolocation_lng"),
            spelling.alias("geolocation_city"),
            F.col("state").alias("geolocation_state"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        placed = F.col("o_orderdate").cast("timestamp")
        return self.given("orders").select(
            text("o_orderkey").alias("order_id"),
            text("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            placed.alias("order_purchase_timestamp"),
            placed.alias("order_approved_at"),
            F.lit(None).cast("timestamp").alias("order_delivered_carrier_date"),
            F.lit(None).cast("timestamp").alias("order_delivered_customer_date"),
            placed.alias("order_estimated_delivery_date"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self.given("lineitem").select(
            text("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            text("l_partkey").alias("product_id"),
            text("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_tax").alias("freight_value"),
        )

    @cached_property
    def order_payments(self) -> DataFrame:
        """One payment per order and return flag, up to three per order."""
        sequential = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
        return (
            self.given("lineitem")
            .groupBy("l_orderkey", "l_returnflag")
            .agg(
                F.count(F.lit(1)).cast("int").alias("payment_installments"),
                F.sum(F.col("l_extendedprice").cast("decimal(16,2)")).cast("double").alias("payment_value"),
            )
            .select(
                text("l_orderkey").alias("order_id"),
                sequential.alias("payment_sequential"),
                F.col("l_returnflag").alias("payment_type"),
                "payment_installments",
                "payment_value",
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.given("part").select(
            text("p_partkey").alias("product_id"),
            F.concat_ws("-", "p_brand", "p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.length("p_type").alias("product_description_lenght"),
            F.lit(1).alias("product_photos_qty"),
            F.col("p_size").alias("product_weight_g"),
            F.col("p_size").alias("product_length_cm"),
            F.col("p_size").alias("product_height_cm"),
            F.col("p_size").alias("product_width_cm"),
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        """Documents as review texts; those without a label have no score."""
        documents, labels = self.given("documents"), self.given("labels")
        return documents.join(labels, "doc_id", "left").select(
            text("doc_id").alias("review_id"),
            text("doc_id").alias("order_id"),
            text("quality").alias("review_score"),
            F.col("source").alias("review_comment_title"),
            F.col("text").alias("review_comment_message"),
            F.lit("2024-01-01").cast("timestamp").alias("review_creation_date"),
            F.lit("2024-01-02").cast("timestamp").alias("review_answer_timestamp"),
        )

    @cached_property
    def category_translation(self) -> DataFrame:
        """Every category and its name in lower case, as if translated."""
        name = F.concat_ws("-", "p_brand", "p_type")
        return (
            self.given("part")
            .select(name.alias("product_category_name"), F.lower(name).alias("product_category_name_english"))
            .distinct()
        )


SQL = {
    "places": """
        SELECT n_nationkey AS zip, n_name AS city, r_name AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
               zip AS customer_zip_code_prefix, city AS customer_city, state AS customer_state
        FROM customer JOIN places ON c_nationkey = zip""",
    "customers_segmented": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
               zip AS customer_zip_code_prefix, city AS customer_city, state AS customer_state,
               c_mktsegment AS segment
        FROM customer JOIN places ON c_nationkey = zip""",
    "customers_misspelt": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, zip AS customer_zip_code_prefix,
               CASE c_mktsegment WHEN 'BUILDING' THEN replace(lower(city), 'nation', 'naton')
                                 WHEN 'FURNITURE' THEN '  ' || replace(upper(city), 'A', 'Ã') || ' '
                                 WHEN 'MACHINERY' THEN replace(lower(city), 'nation', 'mattion')
                                 ELSE lower(city) END AS customer_city,
               state AS customer_state
        FROM customer JOIN places ON c_nationkey = zip""",
    "sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, zip AS seller_zip_code_prefix,
               city AS seller_city, state AS seller_state
        FROM supplier JOIN places ON s_nationkey = zip""",
    "geolocation": """
        SELECT zip AS geolocation_zip_code_prefix, s_acctbal AS geolocation_lat, -s_acctbal AS geolocation_lng,
               CASE WHEN s_acctbal < 0 THEN lower(city) ELSE city END AS geolocation_city,
               state AS geolocation_state
        FROM supplier JOIN places ON s_nationkey = zip""",
    "sales_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp
        FROM orders""",
    "order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_tax AS freight_value
        FROM lineitem""",
    "order_payments": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS payment_sequential,
               l_returnflag AS payment_type, CAST(count(*) AS INTEGER) AS payment_installments,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(16,2))) AS DOUBLE) AS payment_value
        FROM lineitem GROUP BY l_orderkey, l_returnflag""",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_brand || '-' || p_type AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_lenght,
               CAST(length(p_type) AS INTEGER) AS product_description_lenght, 1 AS product_photos_qty,
               p_size AS product_weight_g, p_size AS product_length_cm, p_size AS product_height_cm,
               p_size AS product_width_cm
        FROM part""",
    "order_reviews": """
        SELECT CAST(d.doc_id AS VARCHAR) AS review_id, CAST(d.doc_id AS VARCHAR) AS order_id,
               CAST(quality AS VARCHAR) AS review_score, source AS review_comment_title,
               text AS review_comment_message, TIMESTAMP '2024-01-01' AS review_creation_date,
               TIMESTAMP '2024-01-02' AS review_answer_timestamp
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "category_translation": """
        SELECT DISTINCT p_brand || '-' || p_type AS product_category_name,
               lower(p_brand || '-' || p_type) AS product_category_name_english
        FROM part""",
}

_NEEDS_PLACES = {"customers", "customers_segmented", "customers_misspelt", "sellers", "geolocation"}


def with_tables(body: str, *names: str, **more: str) -> str:
    """`body` under a WITH clause of the named stand-ins, then of `more`."""
    wanted = (["places"] if _NEEDS_PLACES & set(names) else []) + list(names)
    parts = [f"{n} AS ({SQL[n]})" for n in wanted] + [f"{n} AS ({q})" for n, q in more.items()]
    return f"WITH {', '.join(parts)} {body}"
