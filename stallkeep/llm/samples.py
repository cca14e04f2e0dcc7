"""Bounded training samples.

Only fitting reads a sample; every operator scores all rows and whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows per class and bytes per text that a classifier is fitted on.
ROWS_PER_CLASS = 1500
MOST_BYTES = 32_768


def held_out() -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5: such rows are never learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def labelled(documents: DataFrame, labels: DataFrame, label: str, rows: int = ROWS_PER_CLASS, most: int = MOST_BYTES, learn_from: Column | None = None, values: tuple[int, ...] = (0, 1)) -> list[tuple[str, int]]:
    """(text, label) of at most `rows` labelled documents a class, chosen by a hash of their ids.

    The ids are chosen from the small table alone; they are bounded by
    construction and so may be broadcast to the scan of the texts. A document
    labelled twice counts as its larger label; one that occurs twice is learnt
    from twice at most.
    """
    known = labels.where(F.col(label).isin(*values) & F.col("doc_id").isNotNull())
    if learn_from is not None:
        known = known.where(learn_from)
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    chosen = None
    for value in values:
        some = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = some if chosen is None else chosen.union(some)
    texts = documents.select("doc_id", "text").where(F.octet_length("text") <= most)
    found = at_most_twice(texts.join(F.broadcast(chosen), "doc_id"), "doc_id", "label").select("text", F.col("label").cast("int")).collect()
    return sorted((r[0], r[1]) for r in found)


def at_most_twice(rows: DataFrame, *ids: str) -> DataFrame:
    """(ids, text): two of the rows of each id at most, those of the least and largest hash of their texts."""
    hashed = F.struct(F.xxhash64("text").alias("hash"), "text")
    ends = rows.groupBy(*ids).agg(F.min(hashed).alias("low"), F.max(hashed).alias("high"), F.count("*").alias("n"))
    texts = F.when(F.col("n") > 1, F.array("low.text", "high.text")).otherwise(F.array("low.text"))
    return ends.select(*ids, F.explode(texts).alias("text"))
