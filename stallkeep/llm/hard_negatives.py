"""Hard negatives by exact integer scores, with tables of subset sums.

A component x becomes the integer floor(256 * x). A candidate's integers are cut into
bit planes (two's complement), and each plane's bits packed, eight dimensions a
byte. For an anchor and eight dimensions, a table of 256 entries holds the sum of
the anchor's components for every subset; a candidate's byte looks up what its bits
add. The sum over all bytes of a plane, shifted and added plane by plane from the
sign's on, is the inner product.

Rows are packed into parts of about `PART` rows, each one row of a table, ordered by
label. Anchors are packed into blocks of `BLOCK`, and every block meets every part by
a join on the part's number; a task holds one part and one block at a time. A part
gives its best few rows of each anchor, and a ranking of those gives the answer.

1. Positives: the `POSITIVES` best other rows of an anchor's label; a part scores
   only the rows of that label.
2. Negatives: for each positive, the `NEGATIVES` best rows of other labels whose
   scores lie from 30 to 90 per cent of the positive's.

Higher scores come first, ties by smaller id.

Defined results: rows with a null id, label or vector, or with a null or non-finite
component take no part. A vector that is shorter than another counts zeros for
the rest. Rows that repeat an id are rows of their own, but an anchor's own id is none of its
other rows, and an anchor of several rows is the one of least label and vector. An
anchor without positives, or a positive without negatives, has no row. Vectors of
equal labels alone, and an empty table, give no row. Scores beyond 64 bits raise.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.session import stored

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
PART, BLOCK = 1 << 16, 128
#: Rows of a part that are scored at once.
AT_ONCE = 2048
SCALE = 256
PACKED = "part long, labels binary, ids binary, dims int, planes int, bits binary, largest long"
NAMES = [c.split()[0] for c in PACKED.split(", ")]


def integer_rows(vectors: DataFrame) -> DataFrame:
    """(id, label, v): the rows that take part, with integer components."""
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = vectors.where(f"vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND coalesce({finite}, false)")
    label = F.col("label").cast("long")
    return rows.select(
        F.col("vec_id").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.expr(f"transform(embedding, x -> floor({SCALE} * double(x)))").alias("v"),
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of integers, with zeros after the end of a shorter one."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def bit_planes(v: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes: bit i of a byte is the plane's bit in dimension 8 * group + i; the last plane is the sign's."""
    planes = 1 + max(int(v.max(initial=0)).bit_length(), int(-(v.min(initial=0) + 1)).bit_length())
    planes = min(planes, 64)
    out = np.zeros((planes, -(-v.shape[1] // 8), len(v)), np.uint8)
    for p in range(planes):
        out[p] = np.packbits(((v >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each eight dimensions and byte, the sum of the components whose bits are set."""
    groups = -(-anchors.shape[1] // 8)
    padded = np.zeros((len(anchors), 8 * groups), np.int64)
    padded[:, : anchors.shape[1]] = anchors
    sums = np.zeros((groups, 256, len(anchors)), np.int64)
    for g in range(groups):
        for i in range(8):  # a subset is one with a lower largest member, and that member
            sums[g, 1 << i : 2 << i] = sums[g, : 1 << i] + padded[:, 8 * g + i]
    return sums


def scores(sums: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products from `subset_sums` and `bit_planes`."""
    groups = min(len(sums), bits.shape[1])
    total = np.zeros((bits.shape[2], sums.shape[2]), sums.dtype)
    for p in range(len(bits) - 1, -1, -1):
        total <<= 1
        plane = np.zeros_like(total)
        for g in range(groups):
            plane += sums[g].take(bits[p, g], axis=0)
        if p == len(bits) - 1:  # the sign's plane counts down
            np.negative(plane, out=plane)
        total += plane
    return total


def narrow(sums: np.ndarray, anchors: np.ndarray, largest: int) -> np.ndarray:
    """`sums` in 32 bits where no score or sum on the way can leave them; raises where 64 do not hold a score."""
    most = max((sum(abs(x) for x in row) for row in anchors.tolist()), default=0) * 4 * max(largest, 1)
    if most >= 1 << 63:
        raise ValueError("inner products beyond 64 bits")
    return sums.astype(np.int32) if most < 1 << 31 else sums


def packed_parts(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of `PACKED`: the rows of a part by label and id, as bytes."""

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        label, ids = table.column("label").to_numpy(), table.column("id").to_numpy()
        order = np.lexsort((ids, label))
        v = matrix(table.column("v").chunk(0))[order]
        bits = bit_planes(v)
        largest = max(int(v.max(initial=0)), -int(v.min(initial=0)))
        values = [key[0].as_py(), label[order].tobytes(), ids[order].tobytes(), v.shape[1], len(bits), bits.tobytes(), largest]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
        return pa.table([pa.array([x], t) for x, t in zip(values, types, strict=True)], names=NAMES)

    # dealt by the whole row, so that neither a frequent label nor a repeated id makes a large part
    part = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(parts))
    return rows.withColumn("part", part).groupBy("part").applyInArrow(pack, PACKED)


def anchor_blocks(anchors: DataFrame, blocks: int) -> DataFrame:
    """(block, anchors): lists of at most about `BLOCK` anchors (id, label, v, targets)."""
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    return anchors.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("label", "id", "v", "targets"))).alias("anchors"))


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then id."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def ranked(parts: DataFrame, anchors: DataFrame, n_parts: int, k: int, same: bool) -> DataFrame:
    """(anchor, target, id, score): of each part, the k best rows of an anchor's label, or of others within each target's bounds."""
    dealt = anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))))
    columns = ["anchor", "target", "id", "score"]

    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                labels, ids = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int64) for c in ("labels", "ids"))
                dims, planes = batch.column("dims")[row].as_py(), batch.column("planes")[row].as_py()
                bits = np.frombuffer(batch.column("bits")[row].as_buffer(), np.uint8).reshape(planes, -(-dims // 8), len(ids))
                some = batch.column("anchors")[row].values
                own, own_label = some.field("id").to_numpy(), some.field("label").to_numpy()
                v = matrix(some.field("v"))
                sums = narrow(subset_sums(v), v, batch.column("largest")[row].as_py())
                targets = some.field("targets").to_pylist()
                # rows of one label are neighbours here
                low, high = np.searchsorted(labels, own_label), np.searchsorted(labels, own_label, "right")
                found = []
                if same:
                    for value in np.unique(own_label).tolist():
                        which = np.flatnonzero(own_label == value)
                        i, j = int(low[which[0]]), int(high[which[0]])
                        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(which)
                        for first in range(i, j, AT_ONCE):
                            part = slice(first, min(first + AT_ONCE, j))
                            each = scores(sums[:, :, which], bits[:, :, part])
                            for a, w in enumerate(which.tolist()):
                                held[a] = keep(held[a], each[:, a], ids[part], ids[part] != own[w], k)
                        found += [(int(own[w]), 0, *held[a]) for a, w in enumerate(which.tolist())]
                else:
                    held = {(w, t): (np.zeros(0, np.int64), np.zeros(0, np.int64)) for w, each in enumerate(targets) for t in range(len(each))}
                    for first in range(0, len(ids), AT_ONCE):
                        part = slice(first, min(first + AT_ONCE, len(ids)))
                        each, other = scores(sums, bits[:, :, part]), labels[part]
                        for w, wanted in enumerate(targets):
                            score, different = each[:, w], other != own_label[w]
                            for t, positive in enumerate(wanted):
                                # 30 p <= 100 s <= 90 p, in whole numbers
                                least, most = -(-LOW * positive["score"] // 100), HIGH * positive["score"] // 100
                                held[w, t] = keep(held[w, t], score, ids[part], different & (score >= least) & (score <= most), k)
                    found = [(int(own[w]), t, *rows) for (w, t), rows in held.items()]
                n = [len(x[2]) for x in found]
                yield pa.record_batch(
                    [
                        pa.array(np.repeat(np.array([x[0] for x in found], np.int64), n)),
                        pa.array(np.repeat(np.array([x[1] for x in found], np.int32), n)),
                        pa.array(np.concatenate([x[2] for x in found]) if found else np.zeros(0, np.int64)),
                        pa.array(np.concatenate([x[3] for x in found]) if found else np.zeros(0, np.int64)),
                    ],
                    columns,
                )

    # many parts' bytes are more than a broadcast holds, and a part's number is no hot key; the rows are few and
    # the work on each is not, so the number of tasks isn't reduced for small data
    return parts.repartition(n_parts, "part").hint("merge").join(dealt.repartition(n_parts, "part"), "part").mapInArrow(run, "anchor long, target int, id long, score long")


def keep(held: tuple[np.ndarray, np.ndarray], score: np.ndarray, ids: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best of what is held and the wanted rows."""
    if len(held[0]) == k:
        wanted = wanted & (score >= held[1][-1])
    at = np.flatnonzero(wanted)
    if not len(at):
        return held
    own_ids, own = np.concatenate([held[0], ids[at]]), np.concatenate([held[1], score[at].astype(np.int64)])
    order = best(own, own_ids, k)
    return own_ids[order], own[order]


def mined(vectors: DataFrame, every: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among (vec_id, label, embedding)."""
    rows = stored(integer_rows(vectors), "integers")
    n, asked = rows.agg(F.count("*"), F.count_if(F.col("id") % every == 0)).first()
    n_parts = max(1, -(-n // PART), min(2 * vectors.sparkSession.sparkContext.defaultParallelism, n // AT_ONCE))
    n_blocks = max(1, -(-asked // BLOCK))
    parts = stored(packed_parts(rows, n_parts), "parts")
    anchors = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    targets = "array<struct<place:int,score:bigint>>"
    anchors = stored(anchors.select("id", "row.label", "row.v"), "anchors")
    asked_rows = stored(anchor_blocks(anchors.withColumn("targets", F.array().cast(targets)), n_blocks), "blocks")

    order = [F.desc("score"), F.col("id")]
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    positives = ranked(parts, asked_rows, n_parts, POSITIVES, same=True).withColumn("place", place).where(F.col("place") <= POSITIVES)
    positives = stored(positives.select("anchor", "place", "id", "score"), "positives")

    wanted = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("targets"))
    asked_rows = stored(anchor_blocks(anchors.join(wanted.withColumnRenamed("anchor", "id"), "id"), n_blocks), "blocks")
    rank = F.row_number().over(Window.partitionBy("anchor", "target").orderBy(*order))
    negatives = ranked(parts, asked_rows, n_parts, NEGATIVES, same=False).withColumn("rank", rank).where(F.col("rank") <= NEGATIVES)
    positives = positives.select("anchor", (F.col("place") - 1).alias("target"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(positives, ["anchor", "target"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
