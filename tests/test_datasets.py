import pytest

from stallkeep.operators.expectations import ExpectationFailed
from stallkeep.plans.datasets import Datasets, checked_clean, checked_raw


@pytest.fixture
def numbers(store, spark):
    store.replace(spark.range(10), "bronze", "numbers")
    return store


def read(store):
    return store.read("bronze", "numbers")


RULES = {"small": "id < 8", "not_null": "id IS NOT NULL"}


def test_warn_drop_and_no_rules(numbers):
    checked = Datasets("checked")
    checked.dataset(comment="all numbers", warn=RULES)(read)

    @checked.dataset(drop=RULES)
    def small(store):
        return store.read("bronze", "numbers")

    @checked.dataset()
    def free(store):
        return store.read("bronze", "numbers")

    metrics = {(r["dataset"], r["rule"]): (r["policy"], r["violations"]) for r in checked.publish(numbers).collect()}
    assert metrics == {
        ("read", "small"): ("warn", 2),
        ("read", "not_null"): ("warn", 0),
        ("small", "small"): ("drop", 2),
        ("small", "not_null"): ("drop", 0),
    }
    assert numbers.version("checked", "read").comment == "all numbers"
    assert [numbers.read("checked", n).count() for n in ("read", "small", "free")] == [10, 8, 10]
    assert numbers.read("quality", "checked").count() == 4


def test_fail_publishes_nothing(numbers):
    checked = Datasets("checked")
    checked.dataset(fail=RULES)(read)
    with pytest.raises(ExpectationFailed):
        checked.publish(numbers)
    assert not numbers.exists("checked", "read")


def test_one_policy_only():
    with pytest.raises(ValueError, match="one policy"):
        Datasets("checked").dataset(warn=RULES, fail=RULES)


def test_declared_layers():
    raw, clean = checked_raw(), checked_clean()
    assert len(raw.declared) == len(clean.declared) == 9
    assert {d.policy for d in raw.declared.values()} == {"warn"}
    assert clean.declared["order_reviews"].policy == "drop"


def test_views_for_sql(numbers, spark):
    assert numbers.views("bronze", ["numbers"]) == ["bronze_numbers"]
    assert spark.sql("SELECT sum(id) AS s FROM bronze_numbers").first()["s"] == 45


@pytest.mark.parametrize("policy", ["warn", "fail"])
def test_a_stored_table_that_passes_is_not_copied(numbers, policy):
    checked = Datasets("checked")
    checked.add("numbers", read, rules=RULES if policy == "warn" else {"not_null": "id IS NOT NULL"}, policy=policy, source=("bronze", "numbers"))
    found = {r["rule"]: r["violations"] for r in checked.publish(numbers).collect()}
    assert found == ({"small": 2, "not_null": 0} if policy == "warn" else {"not_null": 0})
    assert numbers.version("checked", "numbers").folders == numbers.version("bronze", "numbers").folders
    checked.add("numbers", read, rules=RULES, policy="fail", source=("bronze", "numbers"))
    with pytest.raises(ExpectationFailed):
        checked.publish(numbers)
    assert numbers.version("checked", "numbers").number == 1
