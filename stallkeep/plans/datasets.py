"""Declared datasets: a function, a comment and the rules its rows must keep.

    checked = Datasets("bronze_checked")

    @checked.dataset(comment="Order items", warn={"price_is_above_zero": "price > 0"})
    def order_items(store):
        return store.read("bronze", "order_items")

    checked.publish(store)
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from stallkeep.contracts import CLEAN
from stallkeep.operators.expectations import ExpectationFailed, Rules, count_violations
from stallkeep.plans.rules import CLEAN_POLICY, CLEAN_RULES, DROP, FAIL, RAW_POLICY, RAW_RULES, WARN
from stallkeep.session import side_by_side
from stallkeep.sources.store import Store

Build = Callable[[Store], DataFrame]
METRICS = "dataset string, rule string, policy string, violations long"


@dataclass(frozen=True)
class Dataset:
    name: str
    build: Build
    comment: str
    rules: Rules
    policy: str
    source: tuple[str, str] | None = None


class Datasets:
    """The datasets of one layer."""

    def __init__(self, layer: str):
        self.layer = layer
        self.declared: dict[str, Dataset] = {}

    def add(
        self,
        name: str,
        build: Build,
        comment: str = "",
        rules: Rules | None = None,
        policy: str = WARN,
        source: tuple[str, str] | None = None,
    ) -> None:
        """Declare a dataset. `source` says that it is a stored table (layer, table) as it is."""
        self.declared[name] = Dataset(name, build, comment, rules or {}, policy, source)

    def dataset(
        self, comment: str = "", warn: Rules | None = None, drop: Rules | None = None, fail: Rules | None = None
    ) -> Callable[[Build], Build]:
        """Declare the decorated function; at most one of the three policies applies."""
        given = {policy: rules for policy, rules in ((WARN, warn), (DROP, drop), (FAIL, fail)) if rules}
        if len(given) > 1:
            raise ValueError(f"one policy per dataset, not {sorted(given)}")
        policy, rules = next(iter(given.items()), (WARN, {}))

        def declare(build: Build) -> Build:
            self.add(build.__name__, build, comment, rules, policy)
            return build

        return declare

    def publish(self, store: Store, names: Iterable[str] | None = None) -> DataFrame:
        """Write the datasets and return the broken rows per rule.

        Counting is part of the write; a stored table that passes as it is isn't copied, but read
        once and published by its folders. The counts of this run also go to
        `quality.<layer>`. A broken rule under "fail" raises, with the other
        datasets of the call published or not by their own rules.
        """
        chosen = [self.declared[name] for name in (names or self.declared)]

        def write(d: Dataset) -> list[tuple[str, str, str, int]]:
            if d.source and d.policy != DROP:
                version = store.version(*d.source)
                found = count_violations(store.read(*d.source, version), d.rules)
                broken = {rule: n for rule, n in found.items() if n}
                if d.policy == FAIL and broken:
                    raise ExpectationFailed(f"{self.layer}.{d.name}", broken)
                store.publish(self.layer, d.name, version.folders, version.schema, d.comment)
            else:
                found = store.publish_checked(d.build(store), self.layer, d.name, d.rules, d.policy, d.comment)
            return [(d.name, rule, d.policy, n) for rule, n in found.items()]

        counts = side_by_side(store.spark, [partial(write, d) for d in chosen])
        metrics = store.spark.createDataFrame([row for rows in counts for row in rows], METRICS).coalesce(1)
        if not store.exists("quality", self.layer):
            store.publish("quality", self.layer, [], metrics.schema, f"Rule counts of {self.layer}")
        store.append(metrics, "quality", self.layer)
        return metrics


def _of_layer(target: str, source: str, rules: dict[str, Rules], policies: dict[str, str]) -> Datasets:
    datasets = Datasets(target)
    for name, contract in CLEAN.items():
        read = lambda store, name=name: store.read(source, name)
        datasets.add(name, read, contract.comment, rules[name], policies[name], (source, name))
    return datasets


def checked_raw() -> Datasets:
    """The nine raw tables under their warnings."""
    return _of_layer("bronze_checked", "bronze", RAW_RULES, RAW_POLICY)


def checked_clean() -> Datasets:
    """The nine clean tables under their gates, each published by itself (see `medallion.gate` for all or none)."""
    return _of_layer("silver_checked", "silver", CLEAN_RULES, CLEAN_POLICY)
