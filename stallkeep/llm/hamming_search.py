"""Exact top-k search in binary codes by incremental multi-index hashing.

A code of 64 bits is cut into m segments, each an index of its own: its distinct
values, and the codes of each. A code within distance m * (r + 1) - 1 of a query differs
from it by at most r bits in one of the segments. So segment radii r = 0, 1, 2, ...
are searched in turn: the codes of the values that differ from the query's segment in
exactly r bits are verified by their whole distance, each once. A query is done as
soon as its kth verified distance is within what r covers.

Which values are how far from the query's is found by comparing it with the values
that are there, once a segment and query; flipping bits would ask for far more
values than there are, since a kth neighbour of 64 random bits is some 20 bits away.

The codes are dealt to parts of about `PART`, each with an index of its own; every
block of `BLOCK` queries meets every part by a join on the part's number, and a part gives its k nearest. A
task holds one part and one block at a time. Rows of equal code are one entry, with
their number, their smallest id and, for the answer, their k smallest ids: a code
that a third of the rows share costs no more than any other.

Answers hold the k nearest rows, the query's own among them, by distance and then
id. Defined results: rows without a vector, or with an empty one, have no code: they are neither found nor
asked. Rows with a null id are not asked and not found. A repeated id is found as
often as it stands. Fewer than k rows give all of them. A component that is null or
NaN counts as not positive. A vector of more than 64 components raises. Other
columns are ignored.
"""

from __future__ import annotations

from math import log2

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.session import stored

BITS = 64
K = 10
#: Codes of a part, least codes of one where there are cores to spare, and queries of a block.
PART, LEAST_PART, BLOCK = 1 << 16, 2048, 256


def sign_codes(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, code): bit i is set where component i is positive."""
    x = F.expr(
        f"CASE WHEN size(`{column}`) > {BITS} THEN CAST(raise_error('a code has {BITS} bits') AS BIGINT) WHEN size(`{column}`) > 0 THEN "
        f"aggregate(transform(`{column}`, (x, i) -> IF(x > 0 AND NOT isnan(x), shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b) END"
    )
    return vectors.select(F.col(id_column).alias("id"), x.alias("code")).where("id IS NOT NULL AND code IS NOT NULL")


def segment_bounds(codes: int) -> list[tuple[int, int]]:
    """(shift, bits) of the segments for an index of so many codes."""
    m = max(2, min(8, round(BITS / max(log2(max(codes, 2)), 8))))
    cuts = [BITS * k // m for k in range(m + 1)]
    return [(low, high - low) for low, high in zip(cuts[:-1], cuts[1:], strict=True)]


class SegmentIndex:
    """Codes by the values of their segments."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes.view(np.uint64)
        self.segments = []
        for shift, bits in segment_bounds(len(codes)):
            mask = np.uint64((1 << bits) - 1)
            own = (self.codes >> np.uint64(shift)) & mask
            order = np.argsort(own, kind="stable")
            values, first, n = np.unique(own[order], return_index=True, return_counts=True)
            self.segments.append((np.uint64(shift), mask, bits, order, values, first, n))
        self.verified = 0  # codes compared as a whole

    def nearest(self, query: np.uint64, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, distances) of the k codes nearest to the query, by distance and then `least`."""
        n, m = len(self.codes), len(self.segments)
        apart = [np.bitwise_count(values ^ ((query >> shift) & mask)) for shift, mask, _, _, values, _, _ in self.segments]
        seen = np.zeros(n, bool)
        places, distances = np.zeros(0, np.int64), np.zeros(0, np.uint8)
        for radius in range(max(bits for _, _, bits, *_ in self.segments) + 1):
            for far, (_, _, _, order, _, first, count) in zip(apart, self.segments, strict=True):
                hit = np.flatnonzero(far == radius)
                sizes = count[hit]
                at = order[np.repeat(first[hit] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
                at = at[~seen[at]]
                if len(at):
                    seen[at] = True
                    self.verified += len(at)
                    places = np.concatenate([places, at])
                    distances = np.concatenate([distances, np.bitwise_count(self.codes[at] ^ query)])
            if len(places) >= min(k, n):
                kth = np.partition(distances, min(k, n) - 1)[min(k, n) - 1] if n else 0
                near = distances <= kth  # all that may be among the k nearest
                places, distances = places[near], distances[near]
                if kth <= m * (radius + 1) - 1 or seen.all():
                    break
        chosen = np.lexsort((least[places], distances))[:k]
        return places[chosen], distances[chosen]


PACKED = "part long, codes binary, least binary, n binary"


def packed_codes(codes: DataFrame, parts: int) -> DataFrame:
    """Rows of `PACKED`: the distinct codes of a part, their smallest ids and numbers of rows, as bytes."""

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        values = [table.column(c).to_numpy().astype(np.int64).tobytes() for c in ("code", "least", "n")]
        return pa.table([pa.array([key[0].as_py()], pa.int64()), *[pa.array([v], pa.binary()) for v in values]], names=["part", "codes", "least", "n"])

    return codes.withColumn("part", F.pmod(F.xxhash64("code"), F.lit(parts))).groupBy("part").applyInArrow(pack, PACKED)


def searched(parts: DataFrame, queries: DataFrame, n_parts: int, k: int) -> DataFrame:
    """(query, code, n, least, distance): of each part, the k codes nearest to each of the distinct `queries` (query)."""
    asked = queries.count()
    block = F.pmod(F.xxhash64("query"), F.lit(max(1, -(-asked // BLOCK))))
    blocks = stored(queries.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list("query")).alias("queries")), "asked")
    dealt = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))))

    def run(batches):
        last, index, least, n = None, None, None, None
        for batch in batches:
            for row in range(len(batch)):
                if batch.column("part")[row].as_py() != last:  # blocks of a part mostly follow one another
                    last = batch.column("part")[row].as_py()
                    codes, least, n = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int64).copy() for c in ("codes", "least", "n"))
                    index = SegmentIndex(codes)
                wanted = batch.column("queries")[row].values.to_numpy()
                found = [index.nearest(q, k, least) for q in wanted.view(np.uint64)]
                at = np.concatenate([places for places, _ in found])
                far = np.concatenate([distances for _, distances in found]).astype(np.int32)
                query = np.repeat(wanted, [len(places) for places, _ in found])
                yield pa.record_batch([pa.array(query), pa.array(index.codes.view(np.int64)[at]), pa.array(n[at]), pa.array(least[at]), pa.array(far)], ["query", "code", "n", "least", "distance"])

    # the rows are few and small, the work on each is not: a number of tasks that isn't reduced for small data
    return parts.repartition(n_parts, "part").hint("merge").join(dealt.repartition(n_parts, "part"), "part").mapInArrow(run, "query long, code long, n long, least long, distance int")


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, neighbour_id, distance) for (id, code) rows and queries."""
    rows, queries = stored(rows.select("id", "code"), "codes"), stored(queries.select("id", "code"), "queries")
    codes = stored(rows.groupBy("code").agg(F.count("*").alias("n"), F.min("id").alias("least")), "index")
    count = codes.count()
    n_parts = max(1, -(-count // PART), min(2 * rows.sparkSession.sparkContext.defaultParallelism, count // LEAST_PART))
    parts = stored(packed_codes(codes, n_parts), "parts")
    found = searched(parts, queries.select(F.col("code").alias("query")).distinct(), n_parts, k)
    w = Window.partitionBy("query").orderBy("distance", "least")
    near = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query", "code", "distance")
    # at most k rows of each code: those of the smallest ids
    few = rows.withColumn("place", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("place") <= k).drop("place")
    each = near.join(few, "code")
    w = Window.partitionBy("query").orderBy("distance", "id")
    ranked = each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    asked = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    return asked.join(ranked, "query").select("query_id", "rank", F.col("id").alias("neighbour_id"), "distance")
