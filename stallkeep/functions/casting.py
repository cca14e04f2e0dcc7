"""Typing columns to a contract, with a report of what could not be typed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeep.contracts import MALFORMED, Contract


def typed(column: Column, source: T.DataType, target: T.DataType, strict: bool = False) -> Column:
    """Cast one column; a malformed value is NULL, or an error when `strict`."""
    if source == target:
        return column
    if isinstance(target, T.TimestampType) and isinstance(source, T.StringType):
        return F.to_timestamp(column) if strict else F.try_to_timestamp(column)
    return column.cast(target) if strict else column.try_cast(target)


def conform(df: DataFrame, contract: Contract, strict: bool = False, keep_added: bool = False) -> DataFrame:
    """Select the contract's columns in order and cast them as the last step.

    `keep_added` keeps the computed columns of the contract when present.
    """
    missing = [c for c in contract.columns if c not in df.columns]
    if missing:
        raise ValueError(f"{contract.name}: missing columns {missing}")
    schema = contract.full_schema if keep_added else contract.schema
    return df.select(
        *[
            typed(F.col(f.name), df.schema[f.name].dataType, f.dataType, strict).alias(f.name)
            for f in schema
            if f.name in df.columns
        ]
    )


def misfit(name: str, source: T.DataType, target: T.DataType) -> Column:
    """Whether a value is there and doesn't fit the target type."""
    return F.col(name).isNotNull() & typed(F.col(name), source, target).isNull()


def cast_failures(df: DataFrame, targets: dict[str, T.DataType]) -> DataFrame:
    """Per column: rows, and non-null values that do not fit the target type.

    One aggregate over one scan, whatever the number of columns.
    """
    failures = [
        F.count_if(misfit(name, df.schema[name].dataType, target)).alias(f"f{i}")
        for i, (name, target) in enumerate(targets.items())
    ]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *failures)
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.lit(target.simpleString()).alias("target_type"),
                        F.col("rows").alias("checked_rows"),
                        F.col(f"f{i}").alias("cast_failures"),
                    )
                    for i, (name, target) in enumerate(targets.items())
                ]
            )
        )
    )


#: One row per table, problem and column of a load.
PROBLEMS = "table_name string, problem string, column_name string, target_type string, checked_rows long, found long"
SHORT, SURPLUS, BROKEN, VALUE = "short line", "surplus line", "broken line", "value"


def values_of_line(line: Column) -> Column:
    """How many values a CSV line has: commas outside quotes, and one."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def watch_load(raw: DataFrame, contract: Contract) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """`raw` with counters attached, and a function that gives rows of `PROBLEMS` once it was written.

    Counted are lines with too few or too many values, lines broken otherwise, and
    per column the values that don't fit the contract's type. Writing the frame
    directly counts each row once, with no pass of its own.
    """
    line, width = F.col(MALFORMED), len(contract.columns)
    values = values_of_line(line)
    lines = {SHORT: values < width, SURPLUS: values > width, BROKEN: values == width}
    fields = list(contract.schema)
    counters = [F.count_if(line.isNotNull() & test).alias(f"l{i}") for i, test in enumerate(lines.values())]
    counters += [F.count_if(misfit(f.name, raw.schema[f.name].dataType, f.dataType)).alias(f"v{i}") for i, f in enumerate(fields)]
    seen = Observation()

    def problems() -> list[tuple]:
        found = seen.get
        checked = found["checked_rows"]
        rows = [(contract.name, problem, None, None, checked, found[f"l{i}"]) for i, problem in enumerate(lines)]
        return rows + [(contract.name, VALUE, f.name, f.dataType.simpleString(), checked, found[f"v{i}"]) for i, f in enumerate(fields)]

    return raw.observe(seen, F.count(F.lit(1)).alias("checked_rows"), *counters), problems


def schema_report(df: DataFrame, contract: Contract) -> dict[str, str]:
    """Columns that differ from the contract: 'missing', 'extra' or 'is X, not Y'."""
    actual = {f.name: f.dataType for f in df.schema}
    expected = {f.name: f.dataType for f in contract.full_schema}
    report = {c: "missing" for c in contract.columns if c not in actual}
    for name, kind in actual.items():
        if name not in expected:
            report[name] = "extra"
        elif kind != expected[name]:
            report[name] = f"is {kind.simpleString()}, not {expected[name].simpleString()}"
    return report
