"""Queries: typed loading, dimensions, the fact, and their keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeep.contracts import CLEAN, STAR
from stallkeep.functions.casting import cast_failures as report_cast_failures
from stallkeep.functions.casting import conform
from stallkeep.operators import checks, star
from stallkeep.operators.top_n import quantity_by_category, top_n_with_other
from stallkeep.plans.catalog import DAY, MOMENT, query
from stallkeep.session import stored
from stallkeep.sources.testdata import SalesTables, with_tables


@query(
    with_tables(
        f"""SELECT order_id, order_item_id, product_id, seller_id,
                   {MOMENT.format("shipping_limit_date")} AS shipping_limit_date, price, freight_value
            FROM order_items""",
        "order_items",
    )
)
def contract_cast(t: SalesTables) -> DataFrame:
    """Items arriving as text, typed by their contract."""
    raw = t.order_items.select(*[F.col(c).cast("string").alias(c) for c in t.order_items.columns])
    return conform(raw, CLEAN["order_items"])


@query(
    """WITH raw AS (SELECT p_brand AS brand, replace(p_brand, 'Brand#', '') AS brand_number,
                           CASE WHEN p_type = 'ECONOMY' THEN '12' ELSE p_type END AS mixed,
                           CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN 'soon'
                                ELSE '2024-01-31 10:00:00' END AS moment FROM part)
       SELECT 'brand' AS column_name, 'int' AS target_type, count(*) AS checked_rows,
              count(*) FILTER (WHERE brand IS NOT NULL AND TRY_CAST(brand AS INTEGER) IS NULL) AS cast_failures FROM raw
       UNION ALL SELECT 'brand_number', 'double', count(*),
              count(*) FILTER (WHERE brand_number IS NOT NULL AND TRY_CAST(brand_number AS DOUBLE) IS NULL) FROM raw
       UNION ALL SELECT 'mixed', 'int', count(*),
              count(*) FILTER (WHERE mixed IS NOT NULL AND TRY_CAST(mixed AS INTEGER) IS NULL) FROM raw
       UNION ALL SELECT 'moment', 'timestamp', count(*),
              count(*) FILTER (WHERE moment IS NOT NULL AND TRY_CAST(moment AS TIMESTAMP) IS NULL) FROM raw"""
)
def cast_failures(t: SalesTables) -> DataFrame:
    kind = F.col("p_type")
    raw = t.given("part").select(
        F.col("p_brand").alias("brand"),
        F.regexp_replace("p_brand", "Brand#", "").alias("brand_number"),
        F.when(kind == "ECONOMY", "12").otherwise(kind).alias("mixed"),
        F.when(kind == "SMALL", "soon").when(kind != "PROMO", "2024-01-31 10:00:00").alias("moment"),
    )
    targets = {
        "brand": T.IntegerType(),
        "brand_number": T.DoubleType(),
        "mixed": T.IntegerType(),
        "moment": T.TimestampType(),
    }
    return report_cast_failures(raw, targets)


@query(
    with_tables(
        """SELECT customer_id, customer_unique_id, CAST(customer_zip_code_prefix AS VARCHAR) AS customer_zip_code_prefix,
                  customer_city, customer_state FROM customers""",
        "customers",
    )
)
def dim_customer(t: SalesTables) -> DataFrame:
    return star.dim_customer(t.customers)


@query(with_tables("SELECT * FROM products", "products"))
def dim_products(t: SalesTables) -> DataFrame:
    return star.dim_products(t.products)


@query(
    with_tables(
        """SELECT seller_id, CAST(seller_zip_code_prefix AS VARCHAR) AS seller_zip_code_prefix,
                  seller_city, seller_state FROM sellers""",
        "sellers",
    )
)
def dim_sellers(t: SalesTables) -> DataFrame:
    return star.dim_sellers(t.sellers)


_LOCATION_ID = "md5(CAST(geolocation_zip_code_prefix AS VARCHAR) || '_' || geolocation_city || '_' || geolocation_state)"


@query(
    with_tables(
        f"""SELECT DISTINCT {_LOCATION_ID} AS location_id,
                   CAST(geolocation_zip_code_prefix AS VARCHAR) AS geolocation_zip_code_prefix,
                   geolocation_city, geolocation_state FROM geolocation""",
        "geolocation",
    )
)
def dim_location(t: SalesTables) -> DataFrame:
    return star.dim_location(t.geolocation)


@query(
    with_tables(
        f"""SELECT {_LOCATION_ID} AS location_id, CAST(geolocation_lat AS VARCHAR) AS geolocation_lat,
                   CAST(geolocation_lng AS VARCHAR) AS geolocation_lng, geolocation_lat AS latitude,
                   geolocation_lng AS longitude FROM geolocation""",
        "geolocation",
    )
)
def dim_coordinates(t: SalesTables) -> DataFrame:
    return star.dim_coordinates(t.geolocation)


def _calendar_sql(moment: str) -> str:
    return f"""SELECT DISTINCT {moment} AS moment, {DAY.format("ts")} AS time_id, CAST(year(ts) AS INTEGER) AS year,
        CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
        CAST(quarter(ts) AS INTEGER) AS trimestre, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
        CAST(weekofyear(ts) AS INTEGER) AS week_number, isodow(ts) IN (6, 7) AS is_weekend FROM events"""


@query(f"SELECT * EXCLUDE (moment) FROM ({_calendar_sql('CAST(ts AS DATE)')})")
def dim_time(t: SalesTables) -> DataFrame:
    return star.dim_time(t.given("events"), "ts")


@query(f"SELECT * EXCLUDE (moment) FROM ({_calendar_sql('ts')})")
def dim_time_literal(t: SalesTables) -> DataFrame:
    return star.dim_time(t.given("events"), "ts", literal=True)


FACT_SQL = f"""SELECT DISTINCT o.order_id AS sale_id, o.customer_id, i.product_id, s.seller_id,
        {_LOCATION_ID} AS location_id, {DAY.format("o.order_purchase_timestamp")} AS time_id,
        i.order_item_id AS quantity, CAST(CAST(i.price AS DECIMAL(16,2)) AS DOUBLE) AS price,
        CAST(CAST(i.freight_value AS DECIMAL(16,2)) AS DOUBLE) AS freight_value,
        CAST(CAST(p.payment_value AS DECIMAL(16,2)) AS DOUBLE) AS payment_value, p.payment_installments
    FROM sales_orders o JOIN order_items i ON o.order_id = i.order_id
    JOIN sellers s ON i.seller_id = s.seller_id
    JOIN geolocation g ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix
    JOIN order_payments p ON o.order_id = p.order_id"""
FACT_TABLES = ("sales_orders", "order_items", "sellers", "geolocation", "order_payments")


def _fact(t: SalesTables) -> DataFrame:
    return star.fct_sales(t.orders, t.order_items, t.sellers, t.geolocation, t.order_payments)


@query(with_tables(FACT_SQL, *FACT_TABLES))
def fct_sales(t: SalesTables) -> DataFrame:
    return _fact(t)


TOP_SQL = """SELECT coalesce(leader, 'OUTROS') AS product_category_name, CAST(sum(total_quantity) AS BIGINT) AS total_quantity
    FROM totals LEFT JOIN leaders ON product_category_name = leader GROUP BY 1"""
LEADERS_SQL = """SELECT product_category_name AS leader FROM totals
    ORDER BY total_quantity DESC, product_category_name LIMIT 10"""


@query(
    with_tables(
        TOP_SQL,
        *FACT_TABLES,
        "products",
        fact=FACT_SQL,
        totals="""SELECT product_category_name, sum(quantity) AS total_quantity
            FROM fact f JOIN products p ON f.product_id = p.product_id GROUP BY 1""",
        leaders=LEADERS_SQL,
    )
)
def top_categories_of_fact(t: SalesTables) -> DataFrame:
    """The report over the star schema."""
    counts = quantity_by_category(_fact(t), star.dim_products(t.products))
    return top_n_with_other(counts, "product_category_name", "total_quantity")


def _count(df: DataFrame, table: str, check: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "violations"
    )


_DIMENSION_KEYS = {
    "dim_customer": ("customers", "customer_id"),
    "dim_products": ("products", "product_id"),
    "dim_sellers": ("sellers", "seller_id"),
    "dim_location": ("(SELECT DISTINCT geolocation_zip_code_prefix, geolocation_city, geolocation_state FROM geolocation)", _LOCATION_ID),
    "dim_coordinates": ("geolocation", _LOCATION_ID),
    "dim_time": ("(SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS time_id FROM sales_orders)", "time_id"),
    "fct_sales": ("fact", "sale_id"),
}
_REFERENCES = {
    "customer_id": "SELECT customer_id FROM customers",
    "product_id": "SELECT product_id FROM products",
    "seller_id": "SELECT seller_id FROM sellers",
    "location_id": f"SELECT {_LOCATION_ID} FROM geolocation",
    "time_id": f"SELECT {DAY.format('order_purchase_timestamp')} FROM sales_orders",
}


@query(
    with_tables(
        " UNION ALL ".join(
            [
                f"""SELECT '{table}' AS table_name, 'unique' AS check_name, count(*) AS violations FROM
                    (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)"""
                for table, (source, key) in _DIMENSION_KEYS.items()
            ]
            + [
                f"""SELECT 'fct_sales', '{column}', count(DISTINCT {column}) FROM fact
                    WHERE {column} NOT IN ({known})"""
                for column, known in _REFERENCES.items()
            ]
        ),
        "customers",
        "products",
        *FACT_TABLES,
        fact=FACT_SQL,
    )
)
def star_integrity(t: SalesTables) -> DataFrame:
    """Declared keys and references of the star, as counts of violating values.

    The fact's key and references are stored first: each check then reads one column.
    """
    facts = STAR["fct_sales"]
    checked = [*facts.key, *[r.column for r in facts.foreign_keys]]
    tables = {
        "dim_customer": star.dim_customer(t.customers),
        "dim_products": star.dim_products(t.products),
        "dim_sellers": star.dim_sellers(t.sellers),
        "dim_location": star.dim_location(t.geolocation),
        "dim_coordinates": star.dim_coordinates(t.geolocation),
        "dim_time": star.dim_time(t.orders),
        "fct_sales": stored(_fact(t).select(*checked), "fct-sales"),
    }
    unique = [
        _count(checks.unique_violations(df, list(STAR[name].key)), name, "unique") for name, df in tables.items()
    ]
    references = [
        _count(checks.fk_orphans(tables["fct_sales"], r.column, tables[r.table], r.references), "fct_sales", r.column)
        for r in STAR["fct_sales"].foreign_keys
    ]
    return reduce(DataFrame.unionByName, unique + references)
