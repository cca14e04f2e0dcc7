"""Queries: landing files, stored tables, streams, and all layers end to end.

Each works in a folder of its own under the cluster's shared folder.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.contracts import CLEAN
from stallkeep.functions.casting import conform
from stallkeep.operators import checks, star, totals
from stallkeep.plans import medallion
from stallkeep.plans.catalog import MOMENT, query
from stallkeep.plans.datasets import Datasets
from stallkeep.plans.quality import CUSTOMER_RULES, ITEM_RULES
from stallkeep.plans.rules import CLEAN_RULES
from stallkeep.plans.star_schema import FACT_SQL, FACT_TABLES, LEADERS_SQL, TOP_SQL
from stallkeep.session import new_folder, side_by_side
from stallkeep.sources import landing
from stallkeep.sources.store import Store, publish_formats
from stallkeep.sources.testdata import SQL, SalesTables, with_tables
from stallkeep.streaming import ingest

_ITEMS_SQL = with_tables(
    f"""SELECT order_id, order_item_id, product_id, seller_id,
               {MOMENT.format("shipping_limit_date")} AS shipping_limit_date, price, freight_value
        FROM order_items""",
    "order_items",
)


@query(_ITEMS_SQL)
def csv_ingest(t: SalesTables) -> DataFrame:
    """Items written as CSV, loaded in full, typed."""
    folder = new_folder(t.spark, "csv-ingest")
    store = Store(t.spark, f"{folder}/store")
    landing.write_csv(t.order_items, f"{folder}/landing/order_items")
    landing.load_full(store, f"{folder}/landing")
    return conform(store.read("bronze", "order_items"), CLEAN["order_items"])


@query(
    with_tables(
        f"""SELECT order_id, customer_id, order_status,
                   {MOMENT.format("order_purchase_timestamp")} AS order_purchase_timestamp FROM sales_orders""",
        "sales_orders",
    )
)
def incremental_ingest(t: SalesTables) -> DataFrame:
    """Two deliveries of orders, the second repeating the first, and a load that finds nothing new."""
    folder = new_folder(t.spark, "incremental-ingest")
    store = Store(t.spark, f"{folder}/store")
    contract = CLEAN["orders"]
    for name, part in {"first": t.orders.where("order_status = 'F'"), "second": t.orders, "none": None}.items():
        if part is not None:
            landing.write_csv(part, f"{folder}/landing/orders/{name}")
        landing.load_pending(store, f"{folder}/landing", contract)
        medallion.load_clean_added(store)
    return store.read("silver", "orders").select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp"
    )


@query(
    with_tables(
        f"""SELECT o.order_id, o.customer_id, o.order_status,
                   CAST(sum(CAST(price AS DECIMAL(16,2))) AS DOUBLE) AS total_order_value
            FROM sales_orders o LEFT JOIN order_items i ON o.order_id = i.order_id GROUP BY ALL""",
        "sales_orders",
        "order_items",
    )
)
def evolve_table(t: SalesTables) -> DataFrame:
    """A stored table rewritten from itself with one more column, twice."""
    store = Store(t.spark, new_folder(t.spark, "evolve-table"))
    store.ensure("silver", CLEAN["orders"])
    store.append(t.orders, "silver", "orders")
    for _ in range(2):
        orders = totals.with_order_totals(store.read("silver", "orders"), t.order_items)
        store.replace(orders, "silver", "orders")
    return store.read("silver", "orders").select("order_id", "customer_id", "order_status", "total_order_value")


@query(
    with_tables(
        """SELECT product_id, count(*) AS items, CAST(sum(CAST(price AS DECIMAL(16,2))) AS DOUBLE) AS revenue
           FROM order_items GROUP BY 1""",
        "order_items",
    )
)
def dual_publish(t: SalesTables) -> DataFrame:
    """One result in two formats; the second is read back."""
    paths = publish_formats(totals.sales_by_product(t.order_items), new_folder(t.spark, "dual-publish"), ("parquet", "orc"))
    return t.spark.read.orc(paths["orc"])


# Lines as a careless sender writes them: values that don't fit, two values lost, one too many.
_BAD_PRICE, _BAD_NUMBER = "l_linenumber % 5 = 0", "l_suppkey % 7 = 0"
_SHORT, _SURPLUS = "l_linenumber = 7", "l_linenumber = 6"


def _item_lines(t: SalesTables) -> DataFrame:
    """The items as CSV lines; the frame's one column is named as their header."""
    items = t.given("lineitem")
    price = F.when(F.expr(_BAD_PRICE), F.lit("12,5")).otherwise(F.col("l_extendedprice").cast("string"))
    number = F.when(F.expr(_BAD_NUMBER), F.lit("one")).otherwise(F.col("l_linenumber").cast("string"))
    values = ["l_orderkey", number, "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")]
    last = [F.concat(F.lit('"'), price, F.lit('"')), F.col("l_tax").cast("string")]
    line = (
        F.when(F.expr(_SHORT), F.concat_ws(",", *values))
        .when(F.expr(_SURPLUS), F.concat_ws(",", *values, *last, F.lit("more")))
        .otherwise(F.concat_ws(",", *values, *last))
    )
    return items.select(line.alias(",".join(CLEAN["order_items"].columns)))


def _write_lines(lines: DataFrame, folder: str) -> None:
    # nothing is quoted or escaped: the lines are as they are, below a header of their own
    lines.write.options(header="true", quote="", escape="", sep="\x01").csv(folder)


@query(
    f"""WITH l AS (SELECT *, {_SHORT} AS short, {_SURPLUS} AS surplus FROM lineitem)
        SELECT 'order_items' AS table_name, problem, column_name, target_type, (SELECT count(*) FROM l) AS checked_rows, found
        FROM (SELECT 'short line' AS problem, NULL AS column_name, NULL AS target_type, count(*) FILTER (WHERE short) AS found FROM l
              UNION ALL SELECT 'surplus line', NULL, NULL, count(*) FILTER (WHERE surplus) FROM l
              UNION ALL SELECT 'broken line', NULL, NULL, 0
              UNION ALL SELECT 'value', 'order_item_id', 'int', count(*) FILTER (WHERE {_BAD_NUMBER}) FROM l
              UNION ALL SELECT 'value', 'price', 'double', count(*) FILTER (WHERE {_BAD_PRICE} AND NOT short) FROM l
              UNION ALL SELECT 'value', c, k, 0 FROM (VALUES ('order_id', 'string'), ('product_id', 'string'), ('seller_id', 'string'),
                                                             ('shipping_limit_date', 'timestamp'), ('freight_value', 'double')) v(c, k))"""
)
def load_report(t: SalesTables) -> DataFrame:
    """Items with bad values, short and surplus lines, loaded; what the load itself has counted."""
    folder = new_folder(t.spark, "load-report")
    store = Store(t.spark, f"{folder}/store")
    _write_lines(_item_lines(t), f"{folder}/landing/order_items")
    landing.load_full(store, f"{folder}/landing")
    return landing.load_report(store).drop("load")


@query(
    """SELECT 'rows loaded' AS measure, count(*) AS value FROM lineitem
       UNION ALL SELECT 'rows in the archive', count(*) FROM lineitem
       UNION ALL SELECT 'files left', 0 UNION ALL SELECT 'files not moved', 0"""
)
def archived_loads(t: SalesTables) -> DataFrame:
    """CSV files loaded in two deliveries and archived after each; what is left, and what the archive holds."""
    folder = new_folder(t.spark, "archived-loads")
    store, contract = Store(t.spark, f"{folder}/store"), CLEAN["order_items"]
    for name, part in {"one": "order_item_id % 2 = 0", "two": "order_item_id % 2 = 1"}.items():
        landing.write_csv(t.order_items.where(part), f"{folder}/landing/order_items/{name}")
        landing.load_pending(store, f"{folder}/landing", contract, archive=f"{folder}/archive")
    measures = {
        "rows loaded": store.read("bronze", "order_items"),
        "rows in the archive": landing.read_csv(t.spark, f"{folder}/archive/order_items", contract),
        "files left": landing.landing_files(t.spark, f"{folder}/landing/order_items"),
        "files not moved": store.read("control", "bronze_order_items_archived").where("state <> 'moved'"),
    }
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("value")).withColumn("measure", F.lit(name)) for name, df in measures.items()])


_WRONG_HEADERS = {
    "customers": "customer_id, customer_unique_id AS unique_id, customer_zip_code_prefix, customer_city, customer_state",
    "sellers": "seller_zip_code_prefix, seller_id, seller_city, seller_state",
    "products": "*, product_weight_g * 2 AS product_volume",
}


@query(
    """SELECT * FROM (VALUES ('customers', 'customer_unique_id', 'missing'), ('customers', 'unique_id', 'extra'),
                             ('sellers', 'seller_zip_code_prefix', 'misplaced'), ('sellers', 'seller_id', 'misplaced'),
                             ('products', 'product_volume', 'extra'),
                             ('order_items', 'freight_value', 'missing'), ('order_items', 'price', 'is string, not double')) v(table_name, column_name, problem)"""
)
def schema_check(t: SalesTables) -> DataFrame:
    """Deliveries with columns lost, added and moved, and Parquet files of other types, against their contracts."""
    folder = new_folder(t.spark, "schema-check")
    found = []
    for name, columns in _WRONG_HEADERS.items():
        landing.write_csv(getattr(t, name).selectExpr(*columns.split(", ")), f"{folder}/{name}")
        found.append(landing.schema_check(t.spark, folder, CLEAN[name]).select("table_name", "column_name", "problem"))
    items = t.order_items.withColumn("price", F.col("price").cast("string")).drop("freight_value")
    items.write.parquet(f"{folder}/order_items")
    found.append(checks.schema_problems(t.spark.read.parquet(f"{folder}/order_items"), CLEAN["order_items"]))
    landing.write_csv(t.orders, f"{folder}/orders")  # as its contract says
    found.append(landing.schema_check(t.spark, folder, CLEAN["orders"]).select("table_name", "column_name", "problem"))
    return reduce(DataFrame.unionByName, found)


@query(
    """WITH b AS (SELECT l_returnflag, concat_ws(',', """
    + ", ".join(f"CASE WHEN NOT coalesce({condition}, false) THEN '{rule}' END" for rule, condition in ITEM_RULES.items())
    + """) AS failed_rules FROM lineitem)
    SELECT CASE WHEN failed_rules = '' THEN 'kept' ELSE 'quarantined' END AS part, l_returnflag, failed_rules, count(*) AS row_count
    FROM b GROUP BY ALL"""
)
def quarantine_table(t: SalesTables) -> DataFrame:
    """Items in two deliveries, the good rows to a table and the broken ones to its quarantine; both read back."""
    store = Store(t.spark, new_folder(t.spark, "quarantine-table"))
    for part in ("l_linenumber <= 3", "l_linenumber > 3"):
        store.publish_split(t.given("lineitem").where(part), "silver", "items", ITEM_RULES, append=True)
    kept = store.read("silver", "items").select("l_returnflag", F.lit("kept").alias("part"), F.lit("").alias("failed_rules"))
    aside = store.read_set_aside("silver", "items").select("l_returnflag", F.lit("quarantined").alias("part"), F.concat_ws(",", "failed_rules").alias("failed_rules"))
    return kept.unionByName(aside).groupBy("part", "l_returnflag", "failed_rules").agg(F.count(F.lit(1)).alias("row_count"))


_EVENT_COLUMNS = "event_id, user_id, event_type, value"


@query(f"SELECT {_EVENT_COLUMNS}, {MOMENT.format('ts')} AS ts FROM events")
def stream_insert_if_absent(t: SalesTables) -> DataFrame:
    """Events as a file stream, delivered twice; each key is kept once."""
    folder = new_folder(t.spark, "stream-merge")
    store = Store(t.spark, f"{folder}/store")
    events = t.given("events").withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        events.write.mode("append").parquet(f"{folder}/landing")
        stream = t.spark.readStream.schema(events.schema).parquet(f"{folder}/landing")
        ingest.stream_insert_if_absent(store, stream, "silver", "events", ["event_id"], f"{folder}/checkpoint")
    return store.read("silver", "events").select(*_EVENT_COLUMNS.split(", "), "ts")


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, count(*) AS checked_rows,
                   count(*) FILTER (WHERE NOT coalesce({condition}, false)) AS violations FROM lineitem"""
        for name, condition in ITEM_RULES.items()
    )
)
def stream_expectations(t: SalesTables) -> DataFrame:
    """Items as a file stream under expectations; the counts of the run."""
    folder = new_folder(t.spark, "stream-expectations")
    store = Store(t.spark, f"{folder}/store")
    items = t.given("lineitem")
    items.write.parquet(f"{folder}/landing")
    stream = t.spark.readStream.schema(items.schema).parquet(f"{folder}/landing")
    ingest.stream_expectations(store, stream, "silver", "lineitem", ITEM_RULES, f"{folder}/checkpoint", drop=True)
    return ingest.metrics_by_rule(store.read("quality", "lineitem"))


@query(_ITEMS_SQL)
def processed_archive(t: SalesTables) -> DataFrame:
    """CSV files streamed into the raw table, archived once read."""
    folder = new_folder(t.spark, "processed-archive")
    store = Store(t.spark, f"{folder}/store")
    contract = CLEAN["order_items"]
    landing.write_csv(t.order_items, f"{folder}/landing/order_items")
    stream = ingest.csv_stream(
        t.spark, f"{folder}/landing/order_items", contract, archive=f"{folder}/processed", files_per_batch=1
    )
    ingest.stream_append(store, stream, "bronze", "order_items", f"{folder}/checkpoint")
    return conform(store.read("bronze", "order_items"), contract)


_LOWER_PLACES = SQL["geolocation"].replace("CASE WHEN s_acctbal < 0 THEN lower(city) ELSE city END", "lower(city)")


@query(
    with_tables(
        TOP_SQL,
        "places",
        "sales_orders",
        "order_items",
        "sellers",
        "order_payments",
        "products",
        geolocation=_LOWER_PLACES,
        fact=FACT_SQL,
        totals="""SELECT product_category_name, sum(quantity) AS total_quantity
            FROM fact f JOIN products p ON f.product_id = p.product_id GROUP BY 1""",
        leaders=LEADERS_SQL,
    ).replace(f"places AS ({SQL['places']}), places AS", "places AS")
)
def layered_report(t: SalesTables) -> DataFrame:
    """All layers: CSV files of the nine tables to the report over the star."""
    folder = new_folder(t.spark, "layered-report")
    store = Store(t.spark, f"{folder}/store")
    tables = {name: getattr(t, name).select(*contract.columns) for name, contract in CLEAN.items()}
    side_by_side(t.spark, [partial(landing.write_csv, df, f"{folder}/landing/{name}") for name, df in tables.items()])
    landing.load_full(store, f"{folder}/landing")
    medallion.run_from_bronze(store)
    return medallion.top_categories(store)


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
def report_in_sql(t: SalesTables) -> DataFrame:
    """The report as a user writes it in SQL, over views of the stored star."""
    store = Store(t.spark, new_folder(t.spark, "report-in-sql"))
    store.replace(star.dim_products(t.products), "gold", "dim_products")
    fact = star.fct_sales(t.orders, t.order_items, t.sellers, t.geolocation, t.order_payments)
    store.replace(fact, "gold", "fct_sales")
    store.views("gold", ["dim_products", "fct_sales"])
    return t.spark.sql(
        """
        WITH totals AS (
            SELECT p.product_category_name AS name, sum(s.quantity) AS quantity
            FROM gold_fct_sales s JOIN gold_dim_products p USING (product_id) GROUP BY ALL
        ), leaders AS (
            SELECT name AS leader FROM totals ORDER BY quantity DESC, name LIMIT 10
        )
        SELECT coalesce(leader, 'OUTROS') AS product_category_name, sum(quantity) AS total_quantity
        FROM totals LEFT JOIN leaders ON name = leader GROUP BY ALL
        """
    )


@query(with_tables(FACT_SQL, *FACT_TABLES))
def fct_sales_added(t: SalesTables) -> DataFrame:
    """The fact, brought up to date after late payments of a month and another spelling of a city."""
    store = Store(t.spark, new_folder(t.spark, "fct-sales-added"))
    month = t.orders.where("date_format(order_purchase_timestamp, 'yyyy-MM') = '1996-03'").select("order_id")
    store.replace(t.orders, "silver", "orders", layout=CLEAN["orders"])
    store.replace(t.order_items, "silver", "order_items")
    store.replace(t.order_payments.join(month, "order_id", "left_anti"), "silver", "order_payments")
    store.replace(t.sellers, "silver_gated", "sellers")
    store.replace(t.geolocation.where("geolocation_zip_code_prefix <> 3 OR geolocation_lat >= 0"), "silver_gated", "geolocation")
    medallion.build_fact(store)
    store.append(t.order_payments.join(month, "order_id", "left_semi"), "silver", "order_payments")
    medallion.refresh_fact(store)
    store.replace(t.geolocation, "silver_gated", "geolocation")
    medallion.refresh_fact(store)
    return store.read("gold", "fct_sales").drop("sale_month")


@query(
    """SELECT o_orderstatus AS order_status, count(*) AS row_count FROM orders
       WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1996-05-01' GROUP BY 1"""
)
def orders_of_months(t: SalesTables) -> DataFrame:
    """Orders stored by month, two months of them read."""
    store = Store(t.spark, new_folder(t.spark, "orders-of-months"))
    store.replace(t.orders, "silver", "orders", layout=CLEAN["orders"])
    chosen = store.read("silver", "orders").where(F.col("purchase_month").isin("1996-03", "1996-04"))
    return chosen.groupBy("order_status").agg(F.count(F.lit(1)).alias("row_count"))


def _policy_metrics_sql(dataset: str, source: str, policy: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, '{rule}' AS rule, '{policy}' AS policy,
                   count(*) FILTER (WHERE NOT coalesce({condition}, false)) AS violations FROM {source}"""
        for rule, condition in rules.items()
    )


@query(
    with_tables(
        " UNION ALL ".join(
            [
                _policy_metrics_sql("items", "lineitem", "warn", ITEM_RULES),
                _policy_metrics_sql("buyers", "customer", "drop", CUSTOMER_RULES),
                _policy_metrics_sql("sellers", "sellers", "fail", CLEAN_RULES["sellers"]),
                """SELECT 'buyers', 'rows written', 'drop', count(*) FROM customer
                   WHERE c_acctbal > 0 AND c_mktsegment <> 'MACHINERY'""",
            ]
        ),
        "sellers",
    )
)
def declared_datasets(t: SalesTables) -> DataFrame:
    """Datasets declared under each policy, published, and their counts."""
    store = Store(t.spark, new_folder(t.spark, "declared-datasets"))
    checked = Datasets("checked")

    @checked.dataset(comment="Items, warned about", warn=ITEM_RULES)
    def items(_: Store) -> DataFrame:
        return t.given("lineitem")

    @checked.dataset(comment="Customers that keep the rules", drop=CUSTOMER_RULES)
    def buyers(_: Store) -> DataFrame:
        return t.given("customer")

    @checked.dataset(comment="Sellers, all good or none", fail=CLEAN_RULES["sellers"])
    def sellers(_: Store) -> DataFrame:
        return t.sellers

    metrics = checked.publish(store)
    written = store.read("checked", "buyers").agg(F.count(F.lit(1)).alias("violations"))
    return metrics.unionByName(
        written.select(
            F.lit("buyers").alias("dataset"), F.lit("rows written").alias("rule"), F.lit("drop").alias("policy"), "violations"
        )
    )
