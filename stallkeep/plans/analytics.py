"""Queries: totals, shares, top-N, segments, patterns and figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.operators import kpis, patterns, segments, totals
from stallkeep.operators.top_n import quantity_by_category
from stallkeep.operators.top_n import top_n_with_other as top_n
from stallkeep.plans.catalog import DAY, query
from stallkeep.plans.star_schema import LEADERS_SQL, TOP_SQL
from stallkeep.session import new_folder, stored
from stallkeep.sources.store import Store
from stallkeep.sources.testdata import SalesTables, with_tables


@query(
    with_tables(
        TOP_SQL,
        "order_items",
        "products",
        totals="""SELECT product_category_name, sum(order_item_id) AS total_quantity
            FROM order_items i JOIN products p ON i.product_id = p.product_id GROUP BY 1""",
        leaders=LEADERS_SQL,
    )
)
def top_n_with_other(t: SalesTables) -> DataFrame:
    sales = t.order_items.select("product_id", F.col("order_item_id").alias("quantity"))
    return top_n(quantity_by_category(sales, t.products), "product_category_name", "total_quantity")


@query(
    with_tables(
        f"""SELECT o.order_id, o.customer_id, o.order_status,
                   {DAY.format("o.order_purchase_timestamp")} AS purchase_day,
                   CAST(sum(CAST(price AS DECIMAL(16,2))) AS DOUBLE) AS total_order_value
            FROM sales_orders o LEFT JOIN order_items i ON o.order_id = i.order_id GROUP BY ALL""",
        "sales_orders",
        "order_items",
    )
)
def order_total_value(t: SalesTables) -> DataFrame:
    return totals.with_order_totals(t.orders, t.order_items).select(
        "order_id",
        "customer_id",
        "order_status",
        F.to_date("order_purchase_timestamp").alias("purchase_day"),
        "total_order_value",
    )


@query(
    with_tables(
        """SELECT product_category_name, quantity,
                  round(CAST(quantity AS DOUBLE) * 100 / CAST(sum(quantity) OVER () AS DOUBLE), 6) AS percentage_of_total
           FROM (SELECT product_category_name, count(i.product_id) AS quantity
                 FROM products p LEFT JOIN order_items i ON p.product_id = i.product_id
                 LEFT JOIN sales_orders o ON i.order_id = o.order_id
                 WHERE order_status IN ('F', 'O') GROUP BY 1)""",
        "products",
        "order_items",
        "sales_orders",
    )
)
def category_share(t: SalesTables) -> DataFrame:
    counts = totals.category_counts(t.products, t.order_items, t.orders, ("F", "O"))
    return totals.with_share(counts).withColumn("percentage_of_total", F.round("percentage_of_total", 6))


@query(
    with_tables(
        """SELECT product_category_name, quantity,
                  round(CAST(quantity AS DOUBLE) * 100 / CAST(sum(quantity) OVER () AS DOUBLE), 6) AS percentage_of_total,
                  row_number() OVER (ORDER BY quantity DESC, product_category_name) AS rank
           FROM (SELECT product_category_name, count(i.product_id) AS quantity
                 FROM products p LEFT JOIN order_items i ON p.product_id = i.product_id
                 LEFT JOIN sales_orders o ON i.order_id = o.order_id
                 WHERE order_status IN ('F', 'O') GROUP BY 1)""",
        "products",
        "order_items",
        "sales_orders",
    )
)
def share_sorted(t: SalesTables) -> DataFrame:
    """The shares published in order, largest first."""
    store = Store(t.spark, new_folder(t.spark, "share-sorted"))
    store.replace(category_share(t), "gold", "category_share", ordered=[F.desc("quantity"), F.col("product_category_name")])
    return store.read("gold", "category_share")


_SALES = "count(*) AS items, CAST(sum(CAST(price AS DECIMAL(16,2))) AS DOUBLE) AS revenue"


@query(with_tables(f"SELECT product_id, {_SALES} FROM order_items GROUP BY 1", "order_items"))
def sales_by_product(t: SalesTables) -> DataFrame:
    return totals.sales_by_product(t.order_items)


@query(
    with_tables(
        f"""SELECT product_category_name, {_SALES}
            FROM order_items i JOIN products p ON i.product_id = p.product_id GROUP BY 1""",
        "order_items",
        "products",
    )
)
def sales_by_category(t: SalesTables) -> DataFrame:
    return totals.sales_by_category(t.order_items, t.products)


_RFV = """
    SELECT customer_unique_id,
           CAST(date_diff('day', CAST(max(order_purchase_timestamp) AS DATE),
                (SELECT CAST(max(order_purchase_timestamp) AS DATE) FROM sales_orders)) AS INTEGER) AS recency_days,
           count(DISTINCT o.order_id) AS frequency,
           CAST(coalesce(sum(CAST(price AS DECIMAL(16,2))), 0) AS DECIMAL(18,2)) AS monetary
    FROM customers c JOIN sales_orders o ON c.customer_id = o.customer_id
    LEFT JOIN order_items i ON o.order_id = i.order_id GROUP BY 1"""
_CUTS = "SELECT " + ", ".join(
    f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c}) AS {c[0]}{k}"
    for c in ("recency_days", "frequency", "monetary")
    for k, p in enumerate(segments.PROBABILITIES)
)


def _points(column: str) -> str:
    return " + ".join(f"CAST({column} > {column[0]}{k} AS INTEGER)" for k in range(len(segments.PROBABILITIES)))


_SCORES = f"""
    SELECT customer_unique_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
           5 - ({_points("recency_days")}) AS r_score, 1 + {_points("frequency")} AS f_score,
           1 + {_points("monetary")} AS v_score
    FROM rfv, cuts"""
_RFV_TABLES = {
    "rfv": _RFV,
    "cuts": f"{_CUTS} FROM rfv",
    "scores": _SCORES,
}


def _metrics(t: SalesTables) -> DataFrame:
    metrics = segments.rfv_metrics(t.customers, totals.with_order_totals(t.orders, t.order_items))
    return stored(metrics, "rfv-metrics")


@query(with_tables("SELECT * FROM scores", "customers", "sales_orders", "order_items", **_RFV_TABLES))
def rfv_scores(t: SalesTables) -> DataFrame:
    return segments.rfv_scores(_metrics(t))


@query(
    with_tables(
        """SELECT customer_id, customer_unique_id, customer_city, customer_state,
                  CASE WHEN r_score IS NULL THEN 'no_purchase'
                       WHEN r_score >= 4 AND f_score >= 4 AND v_score >= 4 THEN 'champions'
                       WHEN f_score >= 4 THEN 'loyal'
                       WHEN r_score >= 4 AND f_score <= 2 THEN 'new'
                       WHEN r_score <= 2 AND f_score >= 3 THEN 'at_risk'
                       WHEN r_score <= 2 AND f_score <= 2 THEN 'lost' ELSE 'other' END AS segment
           FROM customers LEFT JOIN scores USING (customer_unique_id)""",
        "customers",
        "sales_orders",
        "order_items",
        **_RFV_TABLES,
    )
)
def rfv_segments(t: SalesTables) -> DataFrame:
    scored = segments.with_segments(t.customers, segments.rfv_scores(_metrics(t)))
    return scored.drop("customer_zip_code_prefix")


_GAPS = """
    SELECT customer_id, day, orders,
           CAST(date_diff('day', lag(day) OVER (PARTITION BY customer_id ORDER BY day), day) AS INTEGER) AS gap
    FROM (SELECT customer_id, CAST(order_purchase_timestamp AS DATE) AS day, count(*) AS orders
          FROM sales_orders GROUP BY ALL)"""


@query(
    with_tables(
        f"SELECT customer_id, {DAY.format('day')} AS purchase_day, orders, gap AS days_since_previous FROM gaps",
        "sales_orders",
        gaps=_GAPS,
    )
)
def purchase_gaps(t: SalesTables) -> DataFrame:
    return patterns.purchase_gaps(t.orders)


@query(
    with_tables(
        """SELECT customer_id, count(*) AS purchase_days, CAST(sum(orders) AS BIGINT) AS orders,
                  min(gap) AS shortest_gap, max(gap) AS longest_gap,
                  CASE WHEN max(gap) IS NULL THEN 'once' WHEN max(gap) <= 90 THEN 'regular'
                       WHEN arg_max(gap, day) = max(gap) THEN 'slowing' ELSE 'irregular' END AS rhythm
           FROM gaps GROUP BY customer_id""",
        "sales_orders",
        gaps=_GAPS,
    )
)
def purchase_rhythm(t: SalesTables) -> DataFrame:
    return patterns.purchase_rhythm(patterns.purchase_gaps(t.orders))


@query(
    with_tables(
        """SELECT product_id, price_band, size_band, price_band || '-' || size_band AS product_band FROM (
               SELECT p.product_id,
                      CASE WHEN revenue IS NULL THEN 'unknown' WHEN revenue < sold * 50000 THEN 'cheap'
                           WHEN revenue < sold * 53000 THEN 'middle' ELSE 'dear' END AS price_band,
                      CASE WHEN volume < 1000 THEN 'small' WHEN volume < 50000 THEN 'medium' ELSE 'large' END AS size_band
               FROM (SELECT product_id, CAST(product_length_cm AS BIGINT) * product_height_cm * product_width_cm AS volume
                     FROM products) p
               LEFT JOIN (SELECT product_id, count(*) AS sold, sum(CAST(price AS DECIMAL(16,2))) AS revenue
                          FROM order_items GROUP BY 1) i ON p.product_id = i.product_id)""",
        "products",
        "order_items",
    )
)
def product_bands(t: SalesTables) -> DataFrame:
    banded = patterns.product_bands(t.products, t.order_items, price_limits=(50_000.0, 53_000.0))
    return banded.select("product_id", "price_band", "size_band", "product_band")


@query(
    with_tables(
        """SELECT month, customer_state, orders, items, CAST(revenue AS DOUBLE) AS revenue,
                  CAST((CAST(2 * 100 * revenue AS BIGINT) + orders) // (2 * orders) AS DOUBLE) / CAST(100 AS DOUBLE)
                      AS mean_order_value
           FROM (SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, customer_state,
                        count(DISTINCT o.order_id) AS orders, count(*) AS items,
                        sum(CAST(price AS DECIMAL(16,2))) AS revenue
                 FROM sales_orders o JOIN order_items i ON o.order_id = i.order_id
                 JOIN customers c ON o.customer_id = c.customer_id GROUP BY 1, 2)""",
        "customers",
        "sales_orders",
        "order_items",
    )
)
def kpi_monthly(t: SalesTables) -> DataFrame:
    return kpis.kpi_monthly(t.orders, t.order_items, t.customers)
