"""Lines that repeat across documents, by two Bloom filters.

A text is split at \\n. A line's key is the line without the white space
(`[\\x20\\x09-\\x0D]`) at its ends, A-Z lower-cased; keys of `LEAST` code points or
more count. A key found in two documents or more loses all its lines but those of
the smallest document that holds it.

1. Each task fills two filters from the keys of its texts, each key once a text:
   bits of keys seen once, and of keys seen (perhaps) twice. Filters of two tasks
   are merged by OR, and what both have seen once is seen twice. They travel as
   segments of `SEGMENT` bits, sparse where few are set, and meet by segment.
2. The twice-seen filter goes to all tasks. A text with no suspected key is done: it
   is not shuffled. The suspected keys of the others are shuffled as digests of 128
   bits, summed up to one row a key and task first, which tells exactly the keys of
   several documents and the smallest of each.
3. Texts with suspects meet the keys they lose.

A filter has `BITS_PER_LINE` bits or more for each line of all texts, at most
`MOST_BITS`: that bounds what each task holds and what is broadcast (32 MB a
filter). Beyond, more keys are suspected and so shuffled, at most all, with the
same result.

Defined results: a null or empty text is one empty line. Rows with a null id keep
all lines and count for nothing. Rows that repeat an id count as one document: they
lose the same keys. A line may be of any length, a text of any number of lines.
Other columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.llm.bytetext import PIECE, gathered, texts_of
from stallkeep.session import stored

LEAST = 10
BITS_PER_LINE, MOST_BITS, SEGMENT = 16, 1 << 28, 1 << 16
DIGEST = 16
WHITE = b" \t\n\x0b\x0c\r"
CONTINUED = bytes(range(0x80, 0xC0))
LINES = "doc_id long, n_lines long, n_dropped long, text string"


def line_lists(raw: bytes) -> Iterator[list[bytes]]:
    """The lines of a text, in lists of about `PIECE` bytes or one longer line."""
    low = 0
    while (high := raw.find(b"\n", low + PIECE)) >= 0:
        yield raw[low:high].split(b"\n")
        low = high + 1
    yield raw[low:].split(b"\n")


def key_of(line: bytes) -> bytes | None:
    """The line's key, or None if it is too short to count."""
    key = line.strip(WHITE).lower()
    if len(key) < LEAST or len(key) < 4 * LEAST and len(key.translate(None, CONTINUED)) < LEAST:
        return None
    return key


def digest_of(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=DIGEST).digest()


def digests(raw: bytes) -> set[bytes]:
    """The digests of a text's keys."""
    return {digest_of(key) for lines in line_lists(raw) for key in {key_of(line) for line in lines} if key is not None}


class SeenTwice:
    """Two Bloom filters of equal size: of what was seen, and of what was seen again."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, found: list[bytes]) -> None:
        """Digests of texts, each once a text."""
        halves, n = np.unique(np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2), axis=0, return_counts=True)
        places = self.places(halves)
        again = (n > 1) | holds(self.once, places)
        _set(self.twice, places[again])
        _set(self.once, places)

    def places(self, halves: np.ndarray) -> np.ndarray:
        return halves & np.uint64(self.bits - 1)

    def segments(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(segment, bits seen, bits seen again) of the segments with any."""
        size = SEGMENT // 8
        for k in np.flatnonzero(self.once.reshape(-1, size).any(axis=1)).tolist():
            part = slice(k * size, (k + 1) * size)
            yield k, packed(self.once[part]), packed(self.twice[part])


def holds(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether all places of a row are set."""
    return ((bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _set(bits: np.ndarray, places: np.ndarray) -> None:
    flat = np.unique(places)
    np.bitwise_or.at(bits, flat >> np.uint64(3), (1 << (flat & np.uint64(7))).astype(np.uint8))


def packed(segment: np.ndarray) -> bytes:
    """A segment as the places set, two bytes each, or as its bits where those are shorter."""
    at = np.flatnonzero(np.unpackbits(segment, bitorder="little")).astype("<u2")
    return at.tobytes() if 2 * len(at) < len(segment) else segment.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) == SEGMENT // 8:
        return np.frombuffer(data, np.uint8)
    bits = np.zeros(SEGMENT, np.uint8)
    bits[np.frombuffer(data, "<u2")] = 1
    return np.packbits(bits, bitorder="little")


def filter_bits(lines: int, most: int = MOST_BITS) -> int:
    """Bits of a filter for so many lines: a power of two, a segment at least."""
    return max(SEGMENT, min(most, 1 << max(BITS_PER_LINE * lines - 1, 1).bit_length()))


def twice_seen(documents: DataFrame, bits: int) -> np.ndarray:
    """The filter of keys that may stand in two documents."""

    def fill(batches):
        seen, waiting = SeenTwice(bits), []
        for batch in batches:
            for _, raw in texts_of(batch):
                waiting.extend(digests(raw))
                if len(waiting) > 50_000:
                    seen.add(waiting)
                    waiting = []
        if waiting:
            seen.add(waiting)
        for segment, once, twice in seen.segments():
            yield pa.record_batch([pa.array([segment], pa.int32()), pa.array([once], pa.binary()), pa.array([twice], pa.binary())], ["segment", "once", "twice"])

    def merge(batches):
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for segment, once, twice in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "twice")), strict=True):
                once, twice = unpacked(once), unpacked(twice)
                if segment in found:
                    before, again = found[segment]
                    found[segment] = before | once, again | twice | (before & once)
                else:
                    found[segment] = once, twice
        for segment, (_, twice) in found.items():
            if twice.any():
                yield pa.record_batch([pa.array([segment], pa.int32()), pa.array([packed(twice)], pa.binary())], ["segment", "twice"])

    parts = documents.where("doc_id IS NOT NULL").select("text").mapInArrow(fill, "segment int, once binary, twice binary")
    merged = parts.repartition("segment").mapInArrow(merge, "segment int, twice binary")
    whole = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():  # at most the filter's bits
        whole[row["segment"] * SEGMENT // 8 : (row["segment"] + 1) * SEGMENT // 8] = unpacked(bytes(row["twice"]))
    return whole


def without_repeated_lines(documents: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) per row of `documents` (doc_id, text)."""
    documents = documents.select("doc_id", "text")
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = documents.agg(F.sum(F.coalesce(breaks.cast("long"), F.lit(0)) + 1)).first()[0] or 0
    bits = filter_bits(lines, most_bits)
    again = documents.sparkSession.sparkContext.broadcast(twice_seen(documents, bits))

    def suspected(raw: bytes) -> list[bytes]:
        found = sorted(digests(raw))
        if not found:
            return found
        places = np.frombuffer(b"".join(found), np.uint64).reshape(-1, 2) & np.uint64(bits - 1)
        return [found[k] for k in np.flatnonzero(holds(again.value, places)).tolist()]

    def suspects(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = ((ids[row], raw, found) for row, raw in texts_of(batch) if (found := suspected(raw)))
            yield from gathered(rows, {"doc_id": pa.int64(), "text": pa.string(), "keys": pa.list_(pa.binary())})

    def clean(batches):
        for batch in batches:
            rows, n = [], []
            ids = batch.column("doc_id").is_valid().to_pylist()
            for row, raw in texts_of(batch):
                if not ids[row] or not suspected(raw):
                    rows.append(row)
                    n.append(raw.count(b"\n") + 1)
            own = batch.take(pa.array(rows, pa.int64()))
            yield pa.record_batch([own.column("doc_id"), pa.array(n, pa.int64()), pa.array([0] * len(n), pa.int64()), own.column("text").fill_null("")], ["doc_id", "n_lines", "n_dropped", "text"])

    marked = stored(documents.where("doc_id IS NOT NULL").mapInArrow(suspects, "doc_id long, text string, keys array<binary>"), "suspects")
    each = marked.select("doc_id", F.explode("keys").alias("key"))
    several = each.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    # a stored table has a true size: small, it is sent to the suspects; large, both are shuffled and hot keys split
    several = stored(several.select("key", "first"), "repeated-lines")
    gone = each.join(several, "key").where("doc_id > first").groupBy("doc_id").agg(F.collect_set("key").alias("gone"))
    dropped = marked.select("doc_id", "text").join(gone, "doc_id", "left").mapInArrow(drop_lines, LINES)
    return documents.mapInArrow(clean, LINES).union(dropped)


def drop_lines(batches):
    """Rows of `LINES` from rows (doc_id, text, gone), gone being digests of keys."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids, gone = batch.column("doc_id").to_pylist(), batch.column("gone")
        for row, raw in texts_of(batch):
            lost = set(gone[row].as_py() or ())
            kept, n, n_lost, first = bytearray(), 0, 0, True
            for lines in line_lists(raw):
                n += len(lines)
                for line in lines:
                    if lost and (key := key_of(line)) is not None and digest_of(key) in lost:
                        n_lost += 1
                        continue
                    if not first:
                        kept += b"\n"
                    kept += line
                    first = False
            yield ids[row], n, n_lost, bytes(kept)

    for batch in batches:
        yield from gathered(rows(batch), {"doc_id": pa.int64(), "n_lines": pa.int64(), "n_dropped": pa.int64(), "text": pa.string()})
