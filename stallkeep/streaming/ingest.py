"""Incremental ingestion with the streaming file source.

The checkpoint remembers which files were read. Each micro-batch is published
under a tag, so a batch repeated after a failure is not published twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stallkeep.contracts import Contract
from stallkeep.functions.casting import conform
from stallkeep.operators.expectations import Rules, expect_or_drop, watch
from stallkeep.operators.merging import absent_rows
from stallkeep.sources.landing import csv_options
from stallkeep.sources.store import Store


def csv_stream(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    archive: str | None = None,
    delete: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New CSV files as text columns; read files are archived or deleted on request."""
    reader = spark.readStream.schema(contract.landed_schema).options(**csv_options(contract))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    elif delete:
        reader = reader.option("cleanSource", "delete")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def _run(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there now, then stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_append(store: Store, stream: DataFrame, layer: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append every new row to a table, created when absent."""
    if not store.exists(layer, table):
        store.publish(layer, table, [], stream.schema)

    def handle(batch: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}#{batch_id}"
        if not store.published(layer, table, tag):
            store.append(batch, layer, table, tag=tag)

    return _run(stream, checkpoint, handle)


def stream_insert_if_absent(
    store: Store,
    stream: DataFrame,
    layer: str,
    table: str,
    keys: list[str],
    checkpoint: str,
    contract: Contract | None = None,
    schema: T.StructType | None = None,
) -> StreamingQuery:
    """Insert-if-absent per micro-batch; increments are taken as small.

    With a contract the batch is typed to it first.
    """
    if contract is not None:
        store.ensure(layer, contract)
    elif not store.exists(layer, table):
        store.publish(layer, table, [], schema or stream.schema)

    def handle(batch: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}#{batch_id}"
        if store.published(layer, table, tag):
            return
        rows = conform(batch, contract) if contract is not None else batch
        new = absent_rows(store.read(layer, table), rows, keys, small_batch=True)
        store.append(new, layer, table, tag=tag)

    return _run(stream, checkpoint, handle)


METRICS = "dataset string, batch_id long, rule string, checked_rows long, violations long"


def stream_expectations(
    store: Store, stream: DataFrame, layer: str, table: str, rules: Rules, checkpoint: str, drop: bool = False
) -> StreamingQuery:
    """Append rows under expectations: warn keeps all, drop keeps the good ones.

    The counts per rule come with the write and go to `quality.<table>`, before the
    rows appear: a batch repeated after a failure between the two loses neither.
    """
    if not store.exists(layer, table):
        store.publish(layer, table, [], stream.schema)
    if not store.exists("quality", table):
        store.publish("quality", table, [], T.StructType.fromDDL(METRICS))

    def handle(batch: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}#{batch_id}"
        if store.published(layer, table, tag):
            return
        counted, counts = watch(batch, rules)

        def publish_counts() -> None:
            if store.published("quality", table, tag):
                return  # by a run of this batch that was lost before its rows appeared
            checked = counts.checked_rows()
            found = [(table, batch_id, rule, checked, n) for rule, n in counts.violations().items()]
            store.append(store.spark.createDataFrame(found, METRICS).coalesce(1), "quality", table, tag=tag)

        kept = expect_or_drop(counted, rules) if drop else counted
        store.append(kept, layer, table, tag=tag, before_publishing=publish_counts)

    return _run(stream, checkpoint, handle)


def metrics_by_rule(metrics: DataFrame) -> DataFrame:
    """Totals per rule over all micro-batches."""
    return metrics.groupBy("rule").agg(
        F.sum("checked_rows").alias("checked_rows"), F.sum("violations").alias("violations")
    )
