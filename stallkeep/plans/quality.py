"""Queries: expectations, merges, checks and cleansing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.operators import checks, cleansing
from stallkeep.operators.expectations import expect_or_drop, expect_or_fail, expectation_metrics, quarantine
from stallkeep.operators.merging import insert_if_absent
from stallkeep.operators.totals import with_status
from stallkeep.plans.catalog import DAY, query
from stallkeep.plans.rules import CLEAN_RULES, RAW_RULES, Rules
from stallkeep.sources.testdata import SalesTables, with_tables

ITEM_RULES: Rules = {
    "price_is_above_zero": "l_extendedprice > 0.0",
    "tax_is_above_zero": "l_tax > 0.0",
    "discount_in_range": "l_discount > 0.0 OR l_discount == 0.0",
    "order_not_null": "l_orderkey IS NOT NULL",
}
CUSTOMER_RULES: Rules = {
    "balance_is_above_zero": "c_acctbal > 0.0",
    "not_machinery": "nullif(c_mktsegment, 'MACHINERY') IS NOT NULL",
    "name_not_null": "c_name IS NOT NULL",
}


def _metrics_sql(dataset: str, source: str, rules: Rules) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS rule, count(*) AS checked_rows,"
        f" count(*) FILTER (WHERE NOT coalesce({condition}, false)) AS violations FROM {source}"
        for name, condition in rules.items()
    )


@query(_metrics_sql("lineitem", "lineitem", ITEM_RULES) + " UNION ALL " + _metrics_sql("customer", "customer", CUSTOMER_RULES))
def expect_warn_metrics(t: SalesTables) -> DataFrame:
    items = expectation_metrics(t.given("lineitem"), ITEM_RULES, "lineitem")
    return items.unionByName(expectation_metrics(t.given("customer"), CUSTOMER_RULES, "customer"))


def _all_metrics(t: SalesTables, rules: dict[str, Rules], frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [expectation_metrics(frames[n], r, n) for n, r in rules.items()])


def _all_metrics_sql(rules: dict[str, Rules], sources: dict[str, str]) -> str:
    body = " UNION ALL ".join(_metrics_sql(n, sources[n], r) for n, r in rules.items())
    return with_tables(body, *sources.values())


_SOURCES = {name: "sales_orders" if name == "orders" else name for name in RAW_RULES}


@query(_all_metrics_sql(RAW_RULES, _SOURCES))
def raw_layer_metrics(t: SalesTables) -> DataFrame:
    return _all_metrics(t, RAW_RULES, {name: getattr(t, name) for name in RAW_RULES})


@query(_all_metrics_sql(CLEAN_RULES, {**_SOURCES, "customers": "customers_segmented"}))
def clean_layer_metrics(t: SalesTables) -> DataFrame:
    frames = {name: getattr(t, name) for name in CLEAN_RULES}
    return _all_metrics(t, CLEAN_RULES, {**frames, "customers": t.customers_segmented})


_REVIEWS = "review_id, order_id, review_score, review_comment_title, review_comment_message"


@query(
    with_tables(
        f"""SELECT {_REVIEWS} FROM order_reviews
        WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score IS NOT NULL
          AND review_creation_date IS NOT NULL""",
        "order_reviews",
    )
)
def expect_drop(t: SalesTables) -> DataFrame:
    return expect_or_drop(t.order_reviews, CLEAN_RULES["order_reviews"]).select(*_REVIEWS.split(", "))


@query(
    with_tables(
        "SELECT order_id, order_item_id, product_id, seller_id, price, freight_value FROM order_items", "order_items"
    )
)
def expect_fail_passthrough(t: SalesTables) -> DataFrame:
    return expect_or_fail(t.order_items.drop("shipping_limit_date"), CLEAN_RULES["order_items"], "order_items")


@query(
    """SELECT c_custkey, c_name, c_acctbal,
              concat_ws(',', CASE WHEN NOT coalesce(c_acctbal > 0.0, false) THEN 'balance_is_above_zero' END,
                             CASE WHEN c_mktsegment = 'MACHINERY' THEN 'not_machinery' END) AS failed_rules
       FROM customer WHERE NOT coalesce(c_acctbal > 0.0, false) OR c_mktsegment = 'MACHINERY'"""
)
def quarantine_rows(t: SalesTables) -> DataFrame:
    broken = quarantine(t.given("customer"), CUSTOMER_RULES)
    return broken.select("c_custkey", "c_name", "c_acctbal", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_violations(t: SalesTables) -> DataFrame:
    return checks.unique_violations(t.given("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT o_orderkey, count(*) AS row_count FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey"""
)
def fk_orphans(t: SalesTables) -> DataFrame:
    return checks.fk_orphans(t.given("orders"), "o_orderkey", t.given("lineitem"), "l_orderkey")


@query(
    f"""SELECT count(*) AS checked_rows, {DAY.format("max(ts)")} AS newest_day,
               CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-15') AS INTEGER) AS age_days,
               date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-15') <= 30 AS is_fresh
        FROM events"""
)
def freshness(t: SalesTables) -> DataFrame:
    return checks.freshness(t.given("events"), "ts", F.lit("2024-02-15").cast("date"), 30)


_PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_urgent"]


@query(
    "WITH o AS (SELECT *, nullif(o_orderpriority, '5-LOW') AS o_urgent FROM orders) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
                   CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
                   count(DISTINCT {c}) AS distinct_count FROM o"""
        for c in _PROFILED
    )
)
def profile(t: SalesTables) -> DataFrame:
    orders = t.given("orders").withColumn("o_urgent", F.expr("nullif(o_orderpriority, '5-LOW')"))
    return checks.profile(orders.select(*_PROFILED), exact_distinct=True)


@query(
    """SELECT 'accuracy' AS dimension, count(*) FILTER (WHERE NOT l_tax > 0) AS violations FROM lineitem
       UNION ALL SELECT 'validity', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
       UNION ALL SELECT 'completeness', count(*) FILTER (WHERE l_partkey IS NULL OR l_suppkey IS NULL) FROM lineitem
       UNION ALL SELECT 'timeliness', count(*) FILTER
            (WHERE date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-12-31') > 365) FROM lineitem
       UNION ALL SELECT 'consistency', count(*) FROM lineitem
            WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
       UNION ALL SELECT 'uniqueness', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
            (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
)
def quality_dimensions(t: SalesTables) -> DataFrame:
    closed = t.given("orders").where("o_orderstatus <> 'P'")
    return checks.quality_dimensions(
        t.given("lineitem"),
        key=["l_orderkey", "l_linenumber"],
        fk="l_orderkey",
        parent=closed,
        parent_key="o_orderkey",
        mandatory=["l_partkey", "l_suppkey"],
        accurate="l_tax > 0",
        valid="l_returnflag IN ('A', 'N')",
        moment="l_shipdate",
        anchor=F.lit("2001-12-31").cast("date"),
        limit_days=365,
    )


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DAY.format("o_orderdate")} AS o_orderdate
        FROM orders WHERE o_orderstatus IN ('F', 'O')"""
)
def status_filter(t: SalesTables) -> DataFrame:
    orders = t.given("orders").withColumnRenamed("o_orderstatus", "order_status")
    kept = with_status(orders, ("F", "O")).withColumnRenamed("order_status", "o_orderstatus")
    return kept.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate")
    )


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_custkey, 'changed' FROM orders WHERE o_orderkey NOT IN
            (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""
)
def insert_if_absent_single(t: SalesTables) -> DataFrame:
    """Batch: all orders, with another status; known orders keep theirs."""
    orders = t.given("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    batch = orders.withColumn("o_orderstatus", F.lit("changed"))
    return insert_if_absent(orders.where("o_orderstatus = 'F'"), batch, ["o_orderkey"])


_ITEM = "l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice"
_KNOWN_ITEM = """EXISTS (SELECT 1 FROM lineitem k WHERE k.l_returnflag = 'R'
                         AND k.l_orderkey = b.l_orderkey AND k.l_linenumber = b.l_linenumber)"""


@query(
    f"""SELECT {_ITEM} FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT {_ITEM} FROM lineitem b WHERE l_returnflag <> 'R' AND NOT {_KNOWN_ITEM}"""
)
def insert_if_absent_composite(t: SalesTables) -> DataFrame:
    """Batch keys repeat; each absent one is appended as often as it occurs."""
    items = t.given("lineitem").select(*_ITEM.split(", "))
    target, batch = items.where("l_returnflag = 'R'"), items.where("l_returnflag <> 'R'")
    return insert_if_absent(target, batch, ["l_orderkey", "l_linenumber"])


@query(
    f"""SELECT {_ITEM} FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT {_ITEM} FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                         ORDER BY l_partkey, l_returnflag, l_extendedprice) AS rn
            FROM lineitem b WHERE l_returnflag <> 'R' AND NOT {_KNOWN_ITEM}) WHERE rn = 1"""
)
def insert_if_absent_deduped(t: SalesTables) -> DataFrame:
    items = t.given("lineitem").select(*_ITEM.split(", "))
    target, batch = items.where("l_returnflag = 'R'"), items.where("l_returnflag <> 'R'")
    return insert_if_absent(target, batch, ["l_orderkey", "l_linenumber"], dedupe_batch=True, small_batch=True)


@query(
    """WITH keyed AS (SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS custkey,
                             o_orderkey, o_orderstatus FROM orders)
       SELECT * FROM keyed WHERE o_orderstatus = 'F'
       UNION ALL SELECT * FROM keyed b WHERE o_orderstatus <> 'F' AND NOT EXISTS
            (SELECT 1 FROM keyed k WHERE k.o_orderstatus = 'F' AND k.custkey = b.custkey)"""
)
def insert_if_absent_null_key(t: SalesTables) -> DataFrame:
    """Rows without a key never match and are always appended."""
    key = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey"))
    keyed = t.given("orders").select(key.alias("custkey"), "o_orderkey", "o_orderstatus")
    target, batch = keyed.where("o_orderstatus = 'F'"), keyed.where("o_orderstatus <> 'F'")
    return insert_if_absent(target, batch, ["custkey"])


@query(
    """SELECT p_partkey, coalesce(nullif(p_type, 'PROMO'), 'unknown') AS category,
              coalesce(CASE WHEN p_size > 10 THEN p_size END, 0) AS size FROM part"""
)
def fill_nulls(t: SalesTables) -> DataFrame:
    holes = t.given("part").select(
        "p_partkey",
        F.expr("nullif(p_type, 'PROMO')").alias("category"),
        F.expr("CASE WHEN p_size > 10 THEN p_size END").alias("size"),
    )
    return cleansing.fill_nulls(holes, {"category": cleansing.UNKNOWN, "size": 0})


@query(
    with_tables(
        """SELECT customer_id, customer_zip_code_prefix, coalesce(fixed_city, customer_city) AS customer_city,
                  customer_state
           FROM canonical LEFT JOIN fixes ON customer_state = fixes.state AND customer_city = fixes.city""",
        "customers_misspelt",
        canonical=r"""
            SELECT customer_id, customer_zip_code_prefix, customer_state,
                   trim(regexp_replace(translate(lower(customer_city), 'áàâãäéèêëíìîïóòôõöúùûüçñ',
                        'aaaaaeeeeiiiiooooouuuucn'), '\s+', ' ', 'g')) AS customer_city
            FROM customers_misspelt""",
        spellings="""
            SELECT customer_state AS state, customer_zip_code_prefix AS zip, customer_city AS city, count(*) AS n
            FROM canonical GROUP BY ALL""",
        reference_names="""
            SELECT DISTINCT state, city FROM (
                SELECT *, row_number() OVER (PARTITION BY state, zip ORDER BY n DESC, city) AS rn FROM spellings)
            WHERE rn = 1""",
        names="SELECT state, city, sum(n) AS n FROM spellings GROUP BY state, city",
        fixes="""
            SELECT state, city, fixed_city FROM (
                SELECT a.state, a.city, b.city AS fixed_city,
                       row_number() OVER (PARTITION BY a.state, a.city
                                          ORDER BY levenshtein(a.city, b.city), b.n DESC, b.city) AS rn
                FROM names a JOIN names b ON a.state = b.state AND levenshtein(a.city, b.city) <= 2
                WHERE (a.state, a.city) NOT IN (SELECT (state, city) FROM reference_names)
                  AND (b.state, b.city) IN (SELECT (state, city) FROM reference_names))
            WHERE rn = 1""",
    )
)
def city_name_fix(t: SalesTables) -> DataFrame:
    return cleansing.fix_city_names(
        t.customers_misspelt, "customer_zip_code_prefix", "customer_city", "customer_state"
    )
