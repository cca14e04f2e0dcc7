"""Plans and skew: what must hold when the data no longer fits one task."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stallkeep.operators import star, totals
from stallkeep.operators.cleansing import fix_city_names
from stallkeep.operators.merging import insert_if_absent
from stallkeep.operators.top_n import quantity_by_category, top_n_with_other
from stallkeep.plans import catalog
from stallkeep.sources.testdata import SalesTables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Plan and run as if every input were large and every partition skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.01",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1kb",
        # Small shuffles would be read by one task, whose output cannot be split.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def rows(df):
    return sorted(map(str, df.collect()))


NAMES = ["fct_sales", "category_share", "insert_if_absent_composite", "insert_if_absent_null_key", "rfv_segments",
         "city_name_fix", "kpi_monthly", "order_total_value"]


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_when_large_and_skewed(large, name):
    from side_by_side import connect, differences

    assert differences(catalog.callables()[name](large, FOLDER), connect(FOLDER), catalog.check_sql()[name]) == []


def executed(df):
    """The final plan of a run over all columns of `df`, and its number of rows."""
    summed = df.agg(F.count(F.lit(1)).alias("n"), *[F.max(c) for c in df.columns])
    rows = summed.collect()[0]["n"]
    return summed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0], rows


@pytest.mark.parametrize("small", [False, True])
def test_hot_key_is_split_in_the_merge(large, small):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100)
    batch = large.range(0, 30_000, 1, 8).select(key.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    target = large.range(0, 9_000, 1, 4).select(F.when(F.col("id") % 3 == 0, 101).otherwise(F.col("id") + 200).alias("k"))
    known = {r["k"] for r in target.distinct().collect()}
    text, rows = executed(insert_if_absent(target, batch, ["k"], small_batch=small))
    assert "skew=true" in text
    assert rows == 9_000 + sum(1 for r in batch.select("k").collect() if r["k"] not in known)


def test_hot_city_is_split(large):
    city = F.when(F.col("id") % 3 == 0, "campinas").when(F.col("id") == 1, "campina").otherwise(F.concat(F.lit("town "), F.col("id") % 500))
    people = large.range(0, 30_000, 1, 8).select(
        "id", city.alias("city"), F.lit(1).alias("zip"), F.lit("SP").alias("state"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    text, rows = executed(fix_city_names(people, "zip", "city", "state"))
    assert "skew=true" in text and rows == 30_000


def test_hot_order_and_hot_seller_are_split_in_the_fact(large):
    n = F.col("id")
    hot_order = F.when(n % 3 == 0, 0).otherwise(n % 2_000).cast("string")
    hot_seller = F.when(n % 3 == 1, 0).otherwise(n % 500).cast("string")
    items = large.range(0, 30_000, 1, 8).select(
        hot_order.alias("order_id"), n.cast("int").alias("order_item_id"), n.cast("string").alias("product_id"),
        hot_seller.alias("seller_id"), F.lit(1.0).alias("price"), F.lit(2.0).alias("freight_value"),
    )
    orders = large.range(2_000).select(
        n.cast("string").alias("order_id"), F.lit("c").alias("customer_id"), F.timestamp_seconds("id").alias("order_purchase_timestamp")
    )
    payments = orders.select("order_id", F.lit(3.0).alias("payment_value"), F.lit(1).alias("payment_installments"))
    sellers = large.range(500).select(n.cast("string").alias("seller_id"), (n % 50).cast("int").alias("seller_zip_code_prefix"))
    places = large.range(500).select(
        (n % 50).cast("int").alias("geolocation_zip_code_prefix"), F.lit("c").alias("geolocation_city"), F.lit("S").alias("geolocation_state")
    )
    text, rows = executed(star.fct_sales(orders, items, sellers, places, payments))
    assert text.count("skew=true") == 3 and rows == 30_000


def test_no_cross_join_or_single_task_window():
    assert catalog.callables()
    source = "".join(p.read_text() for p in Path(catalog.__file__).parents[1].rglob("*.py"))
    for word in ("crossJoin", "localCheckpoint", "toPandas", "rdd"):
        assert word not in source


def test_share_has_no_window(spark):
    t = SalesTables(spark, FOLDER)
    text = plan(totals.with_share(totals.category_counts(t.products, t.order_items, t.orders, ("F",))))
    assert "Window" not in text and "Subquery" in text


def test_status_filter_and_columns_reach_the_scan(spark):
    t = SalesTables(spark, FOLDER)
    text = plan(totals.category_counts(t.products, t.order_items, t.orders, ("F", "O")))
    assert "PushedFilters: [In(o_orderstatus, [F,O])]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text


def test_sales_are_summed_before_the_join(spark):
    t = SalesTables(spark, FOLDER)
    sales = t.order_items.select("product_id", F.col("order_item_id").alias("quantity"))
    text = plan(quantity_by_category(sales, t.products))
    assert "partial_sum(quantity" in text[text.index("Join") :]  # below the join


def test_leaders_are_the_only_hinted_broadcast(large):
    t = SalesTables(large, FOLDER)
    sales = t.order_items.select("product_id", F.col("order_item_id").alias("quantity"))
    text = plan(top_n_with_other(quantity_by_category(sales, t.products), "product_category_name", "total_quantity"))
    assert text.count("BroadcastHashJoin") == 1 and "TakeOrderedAndProject" in text


def test_fact_has_no_distinct_above_the_joins(large):
    t = SalesTables(large, FOLDER)
    fact = star.fct_sales(t.orders, t.order_items, t.sellers, t.geolocation, t.order_payments)
    text = plan(fact)
    assert "HashAggregate" not in text[: text.index("SortMergeJoin")]
    assert fact.count() == fact.distinct().count()


def test_locations_become_rows_after_the_last_join_of_the_fact(large):
    t = SalesTables(large, FOLDER)
    text = plan(star.fct_sales(t.orders, t.order_items, t.sellers, t.geolocation, t.order_payments))
    assert text.index("Generate explode") < text.index("SortMergeJoin")


def test_the_fact_is_stored_for_its_checks_by_its_keys_alone(spark, monkeypatch):
    from stallkeep.plans import star_schema

    kept = []
    monkeypatch.setattr(star_schema, "stored", lambda df, purpose: kept.append(df.columns) or df)
    star_schema.star_integrity(SalesTables(spark, FOLDER))
    assert kept == [["sale_id", "customer_id", "product_id", "seller_id", "location_id", "time_id"]]
