"""Registry of the queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeep.session import STEPWISE, tune
from stallkeep.sources.testdata import SalesTables

Query = Callable[[SalesTables], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            CHECKS[function.__name__] = sql
        return function

    return register


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and moments as text, which two engines encode alike."""

    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return portable(QUERIES[name](SalesTables(tune(spark, **STEPWISE), folder)))


def _load() -> None:
    from stallkeep.plans import analytics, loading, quality, star_schema  # noqa: F401


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, folder, name=name: run(name, spark, folder)) for name in QUERIES}


def check_sql() -> dict[str, str]:
    _load()
    return dict(CHECKS)


DAY = "strftime({}, '%Y-%m-%d')"
MOMENT = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
