"""Layered tables as run-versioned Parquet folders.

`<root>/<layer>/<table>/` holds one data folder per write and a small JSON
history. A table is the list of folders its newest history row names, so a write
becomes visible all at once or not at all, a table may be rewritten from itself,
and a lost job leaves at most an unused folder.

A table with a layout (`Contract.partition`) has a folder per write and value of its
partition column, so that a filter on that column reads its folders only, and some of
its parts can be replaced while the others stay as they are.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeep.contracts import CLEAN, STAR, Contract
from stallkeep.operators.expectations import ExpectationFailed, Rules, expect_or_drop, failed_rules, watch
from stallkeep.operators.top_n import with_rank
from stallkeep.session import exists

HISTORY = "version int, folders array<string>, schema string, comment string, tag string, set_aside array<string>"
COMPACTED = "compacted"  # tag of a rewrite that adds no rows
FAILED = T.StructField("failed_rules", T.ArrayType(T.StringType()))
HOME, BEFORE = "__home", "__before"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how Spark names the part of NULLs
VERDICT, KEPT, BROKEN = "__verdict", "kept", "broken"
PART = re.compile(r"(?P<root>.*)/run=[^/]+/(?P<column>[^/=]+)=(?P<value>[^/]*)")


@dataclass(frozen=True)
class Version:
    """A table's content: the folders of its rows, and of the rows its rules have set aside."""

    number: int
    folders: tuple[str, ...]
    schema: T.StructType
    comment: str
    tag: str | None = None
    set_aside: tuple[str, ...] = ()


@dataclass(frozen=True)
class Split:
    """Rows written in one pass to two folders, not visible yet."""

    kept: tuple[str, ...]
    set_aside: tuple[str, ...]
    schema: T.StructType
    violations: dict[str, int]
    checked_rows: int


class TableMissing(LookupError):
    pass


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


class Store:
    """Tables named layer + table under one root folder.

    One writer per table at a time; any number of readers.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _history(self, layer: str, table: str) -> DataFrame | None:
        folder = f"{self.path(layer, table)}/history"
        return self.spark.read.schema(HISTORY).json(folder) if exists(self.spark, folder) else None

    def version(self, layer: str, table: str, tag_like: str = "%") -> Version | None:
        """The newest version, or the newest whose tag matches a LIKE pattern."""
        history = self._history(layer, table)
        if history is None:
            return None
        if tag_like != "%":
            history = history.where(F.col("tag").like(tag_like))
        row = history.orderBy(F.desc("version")).first()
        if row is None:
            return None
        schema = T.StructType.fromJson(json.loads(row["schema"]))
        return Version(row["version"], tuple(row["folders"]), schema, row["comment"], row["tag"], tuple(row["set_aside"] or ()))

    def exists(self, layer: str, table: str) -> bool:
        return self.version(layer, table) is not None

    def read(self, layer: str, table: str, version: Version | None = None) -> DataFrame:
        """The current rows; columns a folder was written without are NULL."""
        version = version or self.version(layer, table)
        if version is None:
            raise TableMissing(f"{layer}.{table}")
        if not version.folders:
            return _empty(self.spark, version.schema)
        reader = self.spark.read.schema(version.schema)
        if part := PART.fullmatch(version.folders[0]):
            reader = reader.option("basePath", part["root"])
        return reader.parquet(*version.folders).select(*[f"`{c}`" for c in version.schema.names])

    def read_version(self, layer: str, table: str, number: int) -> DataFrame:
        """The rows of an older version."""
        history = self._history(layer, table)
        row = history.where(F.col("version") == number).first() if history is not None else None
        if row is None:
            raise TableMissing(f"{layer}.{table} version {number}")
        schema = T.StructType.fromJson(json.loads(row["schema"]))
        return self.read(layer, table, Version(number, tuple(row["folders"]), schema, row["comment"]))

    def folders_of(self, layer: str, table: str, number: int) -> set[str]:
        """The folders of an older version."""
        history = self._history(layer, table)
        row = history.where(F.col("version") == number).first() if history is not None else None
        return set(row["folders"]) if row else set()

    def read_added(self, layer: str, table: str, since: int) -> tuple[DataFrame, int]:
        """Rows added after version `since`, and the current version number."""
        current = self.version(layer, table)
        if current is None:
            raise TableMissing(f"{layer}.{table}")
        added = tuple(folder for folder, _ in self.added_folders(layer, table, since))
        return self.read(layer, table, replace(current, folders=added)), current.number

    def added_folders(self, layer: str, table: str, since: int = 0) -> list[tuple[str, str | None]]:
        """(folder, tag of its write) of the folders that hold the rows added after version `since`.

        A compaction rewrites rows and adds none: the folders it replaced are
        still there, and name what was added between `since` and it.
        """
        history = self._history(layer, table)
        if history is None:
            raise TableMissing(f"{layer}.{table}")
        versions = sorted(history.select("version", "folders", "tag").collect())
        known = {folder for number, folders, _ in versions if number <= since for folder in folders}
        added: list[tuple[str, str | None]] = []
        for number, folders, tag in versions:
            if number <= since:
                continue
            new = [folder for folder in folders if folder not in known]
            known.update(new)
            if tag == COMPACTED:
                continue
            if not set(versions_folders(versions, number - 1)) <= set(folders):
                added = [x for x in added if x[0] in folders]  # replaced: what was added before is gone
            added += [(folder, tag) for folder in new]
        return added

    def read_set_aside(self, layer: str, table: str) -> DataFrame:
        """The rows that the rules of the table's writes have set aside, with `failed_rules`."""
        version = self.version(layer, table)
        if version is None:
            raise TableMissing(f"{layer}.{table}")
        schema = T.StructType([*version.schema, FAILED])
        if not version.set_aside:
            return _empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*version.set_aside)

    def views(self, layer: str, tables: Iterable[str]) -> list[str]:
        """Temporary views `<layer>_<table>` over the current versions, for SQL."""
        names = []
        for table in tables:
            names.append(f"{layer}_{table}")
            self.read(layer, table).createOrReplaceTempView(names[-1])
        return names

    def tags(self, layer: str, table: str, prefix: str) -> list[str]:
        """The tags of all writes that start with `prefix`; one per write."""
        history = self._history(layer, table)
        if history is None:
            return []
        return [row["tag"] for row in history.where(F.col("tag").startswith(prefix)).select("tag").collect()]

    def published(self, layer: str, table: str, tag: str) -> bool:
        """Whether a write with this tag was already made visible."""
        history = self._history(layer, table)
        return history is not None and not history.where(F.col("tag") == tag).isEmpty()

    def write_data(self, df: DataFrame, layer: str, table: str) -> str:
        """Write a data folder that no table names yet."""
        folder = f"{self.path(layer, table)}/data/run-{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return folder

    def write_parts(self, df: DataFrame, layer: str, table: str, layout: Contract) -> tuple[list[str], T.StructType]:
        """(folders, schema) of rows written by their partition, in parts of even size, in the layout's order inside each."""
        column, expression = layout.partition
        rest = [c for c in df.columns if c != column]
        parted = df.select(*[f"`{c}`" for c in rest], F.expr(expression).alias(column))
        root = f"{self.path(layer, table)}/data/run=r{uuid.uuid4().hex}"
        parted.hint("rebalance", column).sortWithinPartitions(column, *layout.cluster).write.partitionBy(column).parquet(root)
        files = self.spark.read.schema(parted.schema).parquet(root).inputFiles()
        return sorted({file.rsplit("/", 1)[0] for file in files}), parted.schema

    def replace_parts(
        self, df: DataFrame, layer: str, table: str, layout: Contract, gone: Iterable[str | None] = (), tag: str | None = None
    ) -> None:
        """Put the rows of `df` in the place of all rows of its parts, and of the parts named in `gone`; other parts stay."""
        current = self.version(layer, table)
        if current is None:
            raise TableMissing(f"{layer}.{table}")
        folders, schema = self.write_parts(df, layer, table, layout)
        names = {PART.fullmatch(folder)["value"] for folder in folders} | {NO_VALUE if value is None else value for value in gone}
        kept = [folder for folder in current.folders if PART.fullmatch(folder)["value"] not in names]
        self.publish(layer, table, [*kept, *folders], schema, tag=tag, set_aside=current.set_aside)

    def publish(
        self,
        layer: str,
        table: str,
        folders: Iterable[str],
        schema: T.StructType,
        comment: str = "",
        tag: str | None = None,
        set_aside: Iterable[str] = (),
    ) -> None:
        """Make `folders` the table's content, and `set_aside` the rows kept apart from it, in one step."""
        current = self.version(layer, table)
        number = current.number + 1 if current else 1
        entry = self.spark.range(0, 1, 1, 1).select(
            F.lit(number).alias("version"),
            F.array(*map(F.lit, folders)).cast("array<string>").alias("folders"),
            F.lit(schema.json()).alias("schema"),
            F.lit(comment or (current.comment if current else "")).alias("comment"),
            F.lit(tag).cast("string").alias("tag"),
            F.array(*map(F.lit, set_aside)).cast("array<string>").alias("set_aside"),
        )
        entry.write.mode("append").json(f"{self.path(layer, table)}/history")

    def ensure(self, layer: str, contract: Contract) -> None:
        """Create the typed table when absent; keep its rows when present."""
        if not self.exists(layer, contract.name):
            self.publish(layer, contract.name, [], contract.full_schema, contract.comment)

    def replace(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        comment: str = "",
        tag: str | None = None,
        ordered: Iterable[Column] = (),
        layout: Contract | None = None,
    ) -> None:
        """Full rebuild. `df` may read the table it replaces and may change its columns.

        With `ordered` the table is sorted by these columns as a whole, and has the
        place of each row in a column `rank`: readers of several files keep no order.
        With a `layout` its files are divided by the layout's partition column, which
        is added as the last.
        """
        if layout is not None and layout.partition:
            folders, schema = self.write_parts(df, layer, table, layout)
            return self.publish(layer, table, folders, schema, comment, tag)
        if ordered := list(ordered):
            df = with_rank(df, ordered)
        self.publish(layer, table, [self.write_data(df, layer, table)], df.schema, comment, tag)

    def append(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        tag: str | None = None,
        before_publishing: Callable[[], None] | None = None,
    ) -> None:
        """Add rows. The columns are matched by name to those of the table.

        `before_publishing` is called once the rows are written and not yet visible.
        """
        current = self.version(layer, table)
        if current is None:
            raise TableMissing(f"{layer}.{table}")
        unknown = [c for c in df.columns if c not in current.schema.names]
        if unknown:
            raise ValueError(f"{layer}.{table} has no columns {unknown}")
        known = [
            F.col(field.name).cast(field.dataType).alias(field.name)
            for field in current.schema
            if field.name in df.columns
        ]
        if current.folders and (part := PART.fullmatch(current.folders[0])):
            layout = {**CLEAN, **STAR}[table]
            if layout.partition is None or layout.partition[0] != part["column"]:
                raise ValueError(f"{layer}.{table} is divided by {part['column']}, unlike its contract")
            folders, _ = self.write_parts(df.select(*known), layer, table, layout)
        else:
            folders = [self.write_data(df.select(*known), layer, table)]
        if before_publishing:
            before_publishing()
        self.publish(layer, table, [*current.folders, *folders], current.schema, tag=tag, set_aside=current.set_aside)

    def write_split(self, df: DataFrame, layer: str, table: str, rules: Rules) -> Split:
        """Write the rows that keep every rule and those that break one to two folders, in one pass that counts them."""
        taken = {VERDICT, FAILED.name} & set(df.columns)
        if taken:
            raise ValueError(f"{layer}.{table}: columns {sorted(taken)} are those of rows set aside")
        counted, counts = watch(df, rules)
        failed = failed_rules(rules)
        verdict = F.when(F.size(failed) == 0, F.lit(KEPT)).otherwise(F.lit(BROKEN))
        folder = f"{self.path(layer, table)}/data/run-{uuid.uuid4().hex}"
        counted.withColumn(FAILED.name, failed).withColumn(VERDICT, verdict).write.partitionBy(VERDICT).parquet(folder)
        checked, broken = counts.checked_rows(), counts.broken_rows()
        kept = (f"{folder}/{VERDICT}={KEPT}",) if checked > broken else ()
        aside = (f"{folder}/{VERDICT}={BROKEN}",) if broken else ()
        return Split(kept, aside, df.schema, counts.violations(), checked)

    def publish_split(
        self, df: DataFrame, layer: str, table: str, rules: Rules, comment: str = "", append: bool = False, tag: str | None = None
    ) -> dict[str, int]:
        """Write `df`, its broken rows to the table's quarantine (`read_set_aside`); returns the broken rows per rule.

        Rows and quarantine are named by one history row: both are seen, or neither.
        """
        found = self.write_split(df, layer, table, rules)
        current = self.version(layer, table) if append else None
        if current is not None and current.schema.simpleString() != found.schema.simpleString():
            raise ValueError(f"{layer}.{table} has other columns")
        before, aside = (current.folders, current.set_aside) if current else ((), ())
        self.publish(layer, table, [*before, *found.kept], found.schema, comment, tag, [*aside, *found.set_aside])
        return found.violations

    def compact(self, layer: str, table: str) -> None:
        """Rewrite a table of many small appends as one folder of even files."""
        current = self.version(layer, table)
        rows = self.read(layer, table, current)
        if current.folders and PART.fullmatch(current.folders[0]):
            folders, _ = self.write_parts(rows, layer, table, {**CLEAN, **STAR}[table])
        else:
            folders = [self.write_data(rows.hint("rebalance"), layer, table)]
        self.publish(layer, table, folders, current.schema, tag=COMPACTED, set_aside=current.set_aside)

    def rewrite_changed(self, layer: str, table: str, change: Callable[[DataFrame], DataFrame], layout: Contract | None = None) -> int:
        """Replace the table by `change` of its rows, writing only folders that hold a row it changes; returns their number.

        `change` gives one row for each of its rows, and keeps columns it doesn't know. A table of one folder,
        one not divided as `layout` says, and one whose columns change is written whole.
        """
        current = self.version(layer, table)
        if current is None:
            raise TableMissing(f"{layer}.{table}")
        if not current.folders:
            return 0
        divided = layout is not None and layout.partition is not None
        plain = change(self.read(layer, table, current))
        if len(current.folders) == 1 or divided != bool(PART.fullmatch(current.folders[0])) or set(plain.columns) != set(current.schema.names):
            self.replace(plain, layer, table, layout=layout)
            return len(current.folders)
        # the folder below data/ that a row's file is in, and the row as it was
        reader = self.spark.read.schema(current.schema)
        if divided:
            reader = reader.option("basePath", PART.fullmatch(current.folders[0])["root"])
        names = [f"`{c}`" for c in current.schema.names]
        home = F.regexp_extract(F.col("_metadata.file_path"), ".*/data/(.+)/[^/]+$", 1)
        rows = reader.parquet(*current.folders).select(*names, home.alias(HOME), F.struct(*names).alias(BEFORE))
        changed = change(rows)
        other = ~F.struct(*names).eqNullSafe(F.col(BEFORE))
        touched = [row[0] for row in changed.where(other).select(HOME).distinct().collect()]  # some of the table's folders
        if not touched:
            return 0
        fresh = changed.where(F.col(HOME).isin(touched)).select(*names)
        folders = self.write_parts(fresh, layer, table, layout)[0] if divided else [self.write_data(fresh, layer, table)]
        kept = [folder for folder in current.folders if folder.rsplit("/data/", 1)[1] not in touched]
        self.publish(layer, table, [*kept, *folders], current.schema, set_aside=current.set_aside)
        return len(touched)

    def publish_checked(
        self, df: DataFrame, layer: str, table: str, rules: Rules, policy: str, comment: str = ""
    ) -> dict[str, int]:
        """Write `df` while counting broken rules, then publish as the policy allows.

        The rows are counted by the write itself. Under "fail" a broken rule
        leaves the written folder unused and the old table in place; under
        "drop" the broken rows are not written; under "warn" all are. Returns
        the broken rows per rule.
        """
        counted, counts = watch(df, rules)
        folder = self.write_data(expect_or_drop(counted, rules) if policy == "drop" else counted, layer, table)
        violations = counts.violations()
        broken = {rule: n for rule, n in violations.items() if n}
        if policy == "fail" and broken:
            raise ExpectationFailed(f"{layer}.{table}", broken)
        self.publish(layer, table, [folder], df.schema, comment)
        return violations


def versions_folders(versions: list, number: int) -> list[str]:
    """The folders of version `number` among (number, folders, tag) rows; none if it isn't there."""
    return next((list(folders) for n, folders, _ in versions if n == number), [])


def publish_formats(
    df: DataFrame, folder: str, formats: Iterable[str] = ("parquet", "delta"), optional: Iterable[str] = ()
) -> dict[str, str]:
    """Publish one result in several formats, overwriting; returns format -> path.

    The result is computed once: the first format is written from `df`, the
    others from what was written. A format whose package is not installed is
    an error, unless it is one of the `optional` ones: those are then left out of
    the returned mapping.
    """
    optional = set(optional)
    spark = df.sparkSession
    written: dict[str, str] = {}
    for name in formats:
        source = df
        if written:
            first = next(iter(written))
            source = spark.read.format(first).load(written[first])
        path = f"{folder}/{name}"
        try:
            source.write.format(name).mode("overwrite").save(path)
        except AnalysisException as error:
            if error.getCondition() != "DATA_SOURCE_NOT_FOUND" or name not in optional:
                raise
            continue
        except Exception as error:  # a missing source may surface as a JVM error
            if "DATA_SOURCE_NOT_FOUND" not in str(error) or name not in optional:
                raise
            continue
        written[name] = path
    return written
