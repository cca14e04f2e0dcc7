"""Tables divided by month, parts replaced, the fact kept up to date, and merges that read their batch once."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from stallkeep.contracts import CLEAN, STAR
from stallkeep.operators.merging import APART, absent_rows, insert_if_absent
from stallkeep.plans import medallion

ORDERS = CLEAN["orders"]
DAYS = ["2024-01-05", "2024-01-20", "2024-02-03", None, "2024-03-09"]


def orders(spark, *rows):
    """Orders (id, customer, day)."""
    full = [(i, c, "shipped", d and dt.datetime.fromisoformat(d), None, None, None, None) for i, c, d in rows]
    return spark.createDataFrame(full, ORDERS.schema)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_a_filter_on_the_month_reads_its_parts_only(spark, store):
    store.replace(orders(spark, *[(f"o{k}", "c", d) for k, d in enumerate(DAYS)]), "silver", "orders", layout=ORDERS)
    assert len(store.version("silver", "orders").folders) == 4
    table = store.read("silver", "orders")
    assert table.schema.names == [*ORDERS.columns, "purchase_month"]
    january = table.where("purchase_month = '2024-01'")
    assert sorted(r.order_id for r in january.collect()) == ["o0", "o1"]
    assert "PartitionFilters: [isnotnull(purchase_month" in plan(january) and "DataFilters: []" in plan(january)
    scan = next(line for line in plan(january).splitlines() if "PartitionFilters" in line)
    assert "purchase_month" not in scan.split("ReadSchema")[1]
    assert [r.order_id for r in table.where("purchase_month IS NULL").collect()] == ["o3"]


def test_parts_are_replaced_and_others_stay(spark, store):
    store.replace(orders(spark, *[(f"o{k}", "c", d) for k, d in enumerate(DAYS)]), "silver", "orders", layout=ORDERS)
    before = store.version("silver", "orders").folders
    store.replace_parts(orders(spark, ("n1", "c", "2024-01-09"), ("n2", "c", None)), "silver", "orders", ORDERS, gone=["2024-03"])
    after = store.version("silver", "orders").folders
    assert sorted(r.order_id for r in store.read("silver", "orders").collect()) == ["n1", "n2", "o2"]
    assert len(set(before) & set(after)) == 1 and len(after) == 3
    store.append(orders(spark, ("n3", "c", "2024-02-11"), ("n4", "c", "2024-05-01")), "silver", "orders")
    assert {r.order_id: r.purchase_month for r in store.read("silver", "orders").collect()}["n4"] == "2024-05"
    store.compact("silver", "orders")
    assert len(store.version("silver", "orders").folders) == 4 and store.read("silver", "orders").count() == 5
    store.replace(orders(spark), "silver", "orders", layout=ORDERS)
    assert store.read("silver", "orders").count() == 0


def test_rows_are_in_order_inside_a_part(spark, store):
    many = spark.range(3000).select(F.concat(F.lit("o"), (F.col("id") * 617) % 3000).alias("order_id"), F.lit(dt.datetime(2024, 1, 1)).alias("order_purchase_timestamp"))
    store.replace(many.repartition(9), "silver", "orders", layout=ORDERS)
    files = {}
    for r in store.read("silver", "orders").select(F.input_file_name().alias("file"), "order_id").collect():
        files.setdefault(r.file, []).append(r.order_id)
    assert sum(map(len, files.values())) == 3000 and all(ids == sorted(ids) for ids in files.values())


def test_only_folders_with_a_changed_row_are_written(spark, store):
    table = lambda *rows: spark.createDataFrame(rows, "k int, v string")
    fill = lambda df: df.fillna({"v": "none"})
    store.replace(table((1, "a"), (2, None)), "silver", "t")
    assert store.rewrite_changed("silver", "t", fill) == 1
    store.append(table((3, "c")), "silver", "t")
    before = store.version("silver", "t").folders
    assert store.rewrite_changed("silver", "t", fill) == 0 and store.version("silver", "t").folders == before
    store.append(table((4, None), (5, "e")), "silver", "t")
    assert store.rewrite_changed("silver", "t", fill) == 1
    assert store.version("silver", "t").folders[:2] == before
    assert sorted(map(tuple, store.read("silver", "t").collect())) == [(1, "a"), (2, "none"), (3, "c"), (4, "none"), (5, "e")]
    assert store.rewrite_changed("silver", "t", lambda df: df.withColumn("w", F.lit(1))) == 3  # another column
    assert store.read("silver", "t").schema.names == ["k", "v", "w"]


def test_an_increment_rewrites_its_own_parts(spark, store):
    store.replace(orders(spark, *[(f"o{k}", "c", d) for k, d in enumerate(DAYS)]), "silver", "orders", layout=ORDERS)
    before = store.version("silver", "orders").folders
    store.append(orders(spark, ("n1", "c", "2024-01-11"), ("n2", "c", "2024-02-01")), "silver", "orders")
    late = lambda df: df.withColumn("order_status", F.when(F.col("order_id").startswith("n"), "late").otherwise(F.col("order_status")))
    assert store.rewrite_changed("silver", "orders", late, layout=ORDERS) == 2
    assert set(before) <= set(store.version("silver", "orders").folders)
    rows = {r.order_id: (r.order_status, r.purchase_month) for r in store.read("silver", "orders").collect()}
    assert len(rows) == 7 and rows["n1"] == ("late", "2024-01") and rows["o0"] == ("shipped", "2024-01")


@pytest.fixture
def sales(spark, store):
    """Inputs of the fact: orders of three months, two sellers."""
    def items(*rows):
        return spark.createDataFrame([(o, n, p, s, None, 10.0, 1.0) for o, n, p, s in rows], CLEAN["order_items"].schema)

    def payments(*rows):
        return spark.createDataFrame([(o, n, "card", 1, v) for o, n, v in rows], CLEAN["order_payments"].schema)

    def places(*rows):
        return spark.createDataFrame([(z, 0.0, 0.0, c, "SP") for z, c in rows], CLEAN["geolocation"].schema)

    store.replace(orders(spark, ("o1", "c1", "2024-01-05"), ("o2", "c2", "2024-02-05"), ("o3", "c1", "2024-03-05"), ("o4", "c4", "2024-01-15")), "silver", "orders", layout=ORDERS)
    store.replace(items(("o1", 1, "p1", "s1"), ("o1", 2, "p2", "s2"), ("o2", 1, "p1", "s2"), ("o3", 1, "p3", "s1"), ("o4", 1, "p1", "s1")), "silver", "order_items")
    store.replace(payments(("o1", 1, 21.0), ("o3", 1, 11.0), ("o4", 1, 11.0)), "silver", "order_payments")
    store.replace(spark.createDataFrame([("s1", 1, "x", "SP"), ("s2", 2, "y", "SP")], CLEAN["sellers"].schema), "silver_gated", "sellers")
    store.replace(places((1, "x"), (2, "y")), "silver_gated", "geolocation")
    medallion.build_fact(store)
    return items, payments, places


def fact_rows(store):
    return sorted(map(tuple, store.read("gold", "fct_sales").collect()), key=str)


def rebuilt(store):
    found = fact_rows(store)
    medallion.build_fact(store)
    return found == fact_rows(store)


def test_the_fact_follows_late_payments_in_their_months_only(spark, store, sales):
    _, payments, _ = sales
    before = store.version("gold", "fct_sales").folders
    assert fact_rows(store) and medallion.refresh_fact(store) == 0
    store.append(payments(("o2", 1, 12.0)), "silver", "order_payments")
    assert medallion.refresh_fact(store) == 1
    after = store.version("gold", "fct_sales").folders
    assert set(before) <= set(after) and len(after) == 3
    assert "o2" in {r[0] for r in fact_rows(store)} and rebuilt(store)


def test_the_fact_follows_changed_orders_and_places(spark, store, sales):
    items, payments, places = sales
    # an order moves to another month, one goes, a seller's place has another spelling, an item is added
    store.replace(orders(spark, ("o1", "c1", "2024-04-05"), ("o2", "c2", "2024-02-05"), ("o3", "c9", "2024-03-05")), "silver", "orders", layout=ORDERS)
    store.append(items(("o3", 2, "p9", "s2")), "silver", "order_items")
    store.replace(places((1, "x"), (2, "y"), (2, "Y")), "silver_gated", "geolocation")
    assert medallion.refresh_fact(store) == 3  # January, March, April
    found = fact_rows(store)
    assert {r[0] for r in found} == {"o1", "o3"} and {str(r[5])[:7] for r in found} == {"2024-03", "2024-04"}
    assert len({r[4] for r in found if r[3] == "s2"}) == 2 and rebuilt(store)


def test_new_sales_are_appended_and_the_fact_is_not_rewritten(spark, store, sales):
    items, payments, places = sales
    before = store.version("gold", "fct_sales").folders
    # another spelling of a place, a payment and an item of known orders, one delivered again
    store.replace(places((1, "x"), (1, "X"), (1, None), (2, "y")), "silver_gated", "geolocation")
    store.append(payments(("o2", 1, 12.0), ("o1", 2, 3.0), ("o1", 1, 21.0)), "silver", "order_payments")
    store.append(items(("o3", 2, "p9", "s2"), ("o3", 1, "p3", "s1")), "silver", "order_items")
    assert medallion.refresh_fact(store) == 3
    after = store.version("gold", "fct_sales").folders
    assert set(before) <= set(after) and len(after) > len(before)
    found = fact_rows(store)
    assert len(found) == len(set(found)) and len({r[4] for r in found if r[3] == "s1"}) == 3 and rebuilt(store)


def test_a_place_that_is_gone_takes_its_sales_along(spark, store, sales):
    _, _, places = sales
    store.replace(places((1, "x"), (1, "X"), (2, "y")), "silver_gated", "geolocation")
    medallion.refresh_fact(store)
    store.replace(places((1, "X"), (2, "y"), (2, "Y")), "silver_gated", "geolocation")
    medallion.refresh_fact(store)
    assert {r[3]: len({x[4] for x in fact_rows(store) if x[3] == r[3]}) for r in fact_rows(store)} == {"s1": 1, "s2": 2} and rebuilt(store)


def test_refresh_builds_a_fact_that_is_not_there(spark, store, sales):
    store.publish("gold", "fct_sales", [], STAR["fct_sales"].schema)  # by other means, without its inputs' versions
    store.append(sales[1](("o2", 1, 12.0)), "silver", "order_payments")
    medallion.refresh_fact(store)
    assert rebuilt(store)


BATCH = "k int, v string"


@pytest.mark.parametrize("options", [{}, {"dedupe_batch": True}, {"small_batch": True}])
def test_a_merge_reads_its_batch_once(spark, tmp_path, options):
    spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("int")).alias("k"), F.lit("x").alias("v")).write.parquet(str(tmp_path / "batch"))
    spark.range(0, 2000, 2).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("v")).write.parquet(str(tmp_path / "target"))
    batch, target = (spark.read.parquet(str(tmp_path / name)) for name in ("batch", "target"))
    new = absent_rows(target, batch, ["k"], **options)
    assert new.columns == ["k", "v"]
    text = plan(new).split("== Physical Plan ==")[1]
    assert text.count(f"{tmp_path}/batch") == (0 if "small_batch" in options else 1) and text.count(f"{tmp_path}/target") == 1
    found = [r.k for r in new.collect()]
    assert found.count(None) == 334 and sorted(k for k in found if k is not None) == [k for k in range(1000) if k % 3 and k % 2]
    again = insert_if_absent(target, batch, ["k"], **options)
    assert again.count() == 1000 + len(found)


def test_rows_without_a_whole_key_are_all_new_and_dealt_apart(spark):
    batch = spark.createDataFrame([(None, "x"), (None, "x"), (None, "y"), (1, "b"), (1, "a"), (2, "c")], BATCH)
    target = spark.createDataFrame([(2, "old"), (None, "x")], BATCH)
    found = sorted(map(tuple, absent_rows(target, batch, ["k"], dedupe_batch=True).collect()), key=str)
    assert found == [(1, "a"), (None, "x"), (None, "x"), (None, "y")]
    many = spark.range(10_000).select(F.lit(None).cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    new = absent_rows(target, many, ["k"])
    assert APART in plan(new) and "Union" not in plan(new)
    sizes = new.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 10_000 and max(sizes) < 9_000
