import datetime as dt

import pytest
from pyspark.sql import functions as F

from stallkeep.contracts import CLEAN
from stallkeep.operators import checks
from stallkeep.operators.expectations import (
    ExpectationFailed,
    expect_or_drop,
    expect_or_fail,
    expectation_metrics,
    quarantine,
)
from stallkeep.operators.merging import insert_if_absent
from stallkeep.plans.rules import CLEAN_POLICY, CLEAN_RULES, RAW_POLICY, RAW_RULES


def payments(spark, values):
    return spark.createDataFrame([("o", "card", v) for v in values], "order_id string, payment_type string, payment_value double")


def violations(df, rules):
    return {r["rule"]: r["violations"] for r in expectation_metrics(df, rules, "t").collect()}


def test_number_of_rules():
    assert sum(map(len, RAW_RULES.values())) == 32
    assert sum(map(len, CLEAN_RULES.values())) == 33
    assert set(RAW_POLICY.values()) == {"warn"}
    assert sorted(CLEAN_POLICY.values()) == ["drop"] + ["fail"] * 8


def test_rules_fit_the_contracts(spark):
    for name, rules in {**RAW_RULES}.items():
        frame = spark.createDataFrame([], CLEAN[name].full_schema)
        assert set(violations(frame, rules).values()) == {0}
        assert set(violations(frame, CLEAN_RULES[name]).values()) == {0}


def test_null_condition_is_a_violation(spark):
    assert violations(payments(spark, [None, 0.0, 2.0]), {"above": "payment_value > 0"}) == {"above": 2}


def test_clean_payments_accept_zero(spark):
    found = violations(payments(spark, [0.0, -1.0, 2.0]), CLEAN_RULES["order_payments"])
    assert found["payment_value_is_above_zero"] == 1
    found = violations(payments(spark, [0.0, -1.0, 2.0]), RAW_RULES["order_payments"])
    assert found["payment_value_is_above_zero"] == 2


def test_drop_and_quarantine_split_the_rows(spark):
    df = payments(spark, [None, 0.0, 2.0, -3.0])
    rules = {"not_null": "payment_value IS NOT NULL", "above": "payment_value > 0"}
    bad = {r["payment_value"]: r["failed_rules"] for r in quarantine(df, rules).collect()}
    assert [r["payment_value"] for r in expect_or_drop(df, rules).collect()] == [2.0]
    assert bad == {None: ["not_null", "above"], 0.0: ["above"], -3.0: ["above"]}


def test_fail_raises_with_counts(spark):
    with pytest.raises(ExpectationFailed) as error:
        expect_or_fail(payments(spark, [1.0, -1.0]), {"above": "payment_value > 0"}, "payments")
    assert error.value.violations == {"above": 1}


def test_fail_keeps_the_old_table(store, spark):
    rules = {"above": "payment_value > 0"}
    assert store.publish_checked(payments(spark, [1.0]), "silver", "p", rules, "fail") == {"above": 0}
    with pytest.raises(ExpectationFailed):
        store.publish_checked(payments(spark, [5.0, -1.0]), "silver", "p", rules, "fail")
    assert [r["payment_value"] for r in store.read("silver", "p").collect()] == [1.0]


def test_warn_and_drop_count_while_writing(store, spark):
    rules = {"above": "payment_value > 0"}
    df = payments(spark, [1.0, -1.0, None])
    assert store.publish_checked(df, "silver", "warned", rules, "warn") == {"above": 2}
    assert store.read("silver", "warned").count() == 3
    assert store.publish_checked(df, "silver", "dropped", rules, "drop") == {"above": 2}
    assert store.read("silver", "dropped").count() == 1


SCHEMA = "k int, v string"


@pytest.mark.parametrize("small", [False, True])
def test_merge_batch_repeats_and_null_keys(spark, small):
    empty = spark.createDataFrame([], SCHEMA)
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], SCHEMA)
    once = insert_if_absent(empty, batch, ["k"], small_batch=small)
    assert once.count() == 3
    assert insert_if_absent(once, batch, ["k"], small_batch=small).count() == 4


@pytest.mark.parametrize("small", [False, True])
def test_merge_ignores_changed_rows(spark, small):
    target = spark.createDataFrame([(1, "shipped")], SCHEMA)
    merged = insert_if_absent(target, spark.createDataFrame([(1, "delivered")], SCHEMA), ["k"], small_batch=small)
    assert [tuple(r) for r in merged.collect()] == [(1, "shipped")]


def test_merge_dedupe_takes_the_least_row(spark):
    batch = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], SCHEMA)
    merged = insert_if_absent(spark.createDataFrame([], SCHEMA), batch, ["k"], dedupe_batch=True)
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, "c")]


def test_merge_composite_key_with_null_part(spark):
    schema = "a int, b int, v string"
    target = spark.createDataFrame([(1, 1, "t"), (1, None, "t")], schema)
    batch = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (1, None, "x")], schema)
    merged = insert_if_absent(target, batch, ["a", "b"])
    assert sorted(map(str, merged.where("v = 'x'").drop("v").collect())) == ["Row(a=1, b=2)", "Row(a=1, b=None)"]


def test_merge_leaves_computed_columns_null(spark):
    target = spark.createDataFrame([(1, "a", "loyal")], SCHEMA + ", segment string")
    merged = insert_if_absent(target, spark.createDataFrame([(2, "b")], SCHEMA), ["k"])
    assert {r["k"]: r["segment"] for r in merged.collect()} == {1: "loyal", 2: None}


def test_orphans_count_rows_and_skip_nulls(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in checks.fk_orphans(child, "fk", parent, "id").collect()] == [(2, 2)]


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12),)], "ts timestamp")
    row = checks.freshness(df, "ts", F.lit("2024-01-11").cast("date"), 7).first()
    assert (row["age_days"], row["is_fresh"]) == (10, False)


def test_profile_exact_and_sketched_agree_on_little_data(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, None)], "n int, s string")
    exact = {r["column_name"]: r for r in checks.profile(df, exact_distinct=True).collect()}
    sketch = {r["column_name"]: r for r in checks.profile(df).collect()}
    for name, distinct, nulls in (("n", 2, 0), ("s", 1, 1)):
        for report in (exact, sketch):
            assert (report[name]["distinct_count"], report[name]["null_count"]) == (distinct, nulls)
