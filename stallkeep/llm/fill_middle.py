"""Fill-in-middle rows by rotating blocks of a text in place, and back.

A text's units are its lines (`[^\\n]*\\n|[^\\n]+`), n of them. Four numbers h1 to h4 are the
first groups of 8 digits of the hex SHA-256 of "seed:doc_id". The prefix ends after the
smaller of h1 % (n+1) and h2 % (n+1) units, the middle after the larger; the suffix is
the rest. One of `RATE` in 100 rows is changed (h3), of these `SUFFIX_FIRST` in 100 to
"spm" (h4) and the others to "psm":

    psm  <P>prefix<S>suffix<M>middle
    spm  <S>suffix<P>prefix<M>middle

The text stands in one bytearray. The cuts are found by scanning for line ends, the
sentinels are inserted there as `<P>prefix<M>middle<S>suffix`, and two neighbouring blocks
change places by three reversals: of each, and of both. Reading back finds the
sentinels, rotates the same blocks the other way and deletes the sentinels. A text
that holds a sentinel stays plain, so those found are the ones inserted: one that
began in a text and ended in a sentinel would need "<" for its second or third character.

Defined results: a null or empty text is plain and its output empty; prefix_chars and
middle_chars are null for plain rows. A null id counts as an empty one. Repeated rows
give repeated results. Other columns are ignored. An empty table gives no row. Of a very long
text, its bytes and a copy of one block stand in memory, and never an object a unit.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeep.llm.bytetext import PIECE, gathered, texts_of

SEED, RATE, SUFFIX_FIRST = 7, 100, 50
P, S, M = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ROWS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """h1 to h4 of an id."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(found[8 * k : 8 * k + 8], 16) for k in range(4)]


def units(text: bytes | bytearray) -> int:
    return text.count(b"\n") + (bool(text) and not text.endswith(b"\n"))


def unit_end(text: bytes | bytearray, n: int, of: int) -> int:
    """Where the first n of a text's units end."""
    if n == 0:
        return 0
    if n == of:
        return len(text)
    low = 0
    while (found := text.count(b"\n", low, low + PIECE)) < n:
        n, low = n - found, low + PIECE
    piece = np.frombuffer(text, np.uint8, min(PIECE, len(text) - low), low)
    return low + int(np.flatnonzero(piece == 10)[n - 1]) + 1


def characters(text: bytearray, low: int, high: int) -> int:
    """Code points of text[low:high]."""
    return sum(int(np.count_nonzero((np.frombuffer(text, np.uint8, min(PIECE, high - k), k) & 0xC0) != 0x80)) for k in range(low, high, PIECE))


def reverse(buffer: bytearray, low: int, high: int) -> None:
    part = np.frombuffer(buffer, np.uint8)[low:high]
    half = len(part) // 2
    if half:
        first = part[:half].copy()
        part[:half] = part[: -half - 1 : -1]
        part[-half:] = first[::-1]


def rotate(buffer: bytearray, low: int, cut: int, high: int) -> None:
    """Make buffer[low:cut] and buffer[cut:high] change places."""
    reverse(buffer, low, cut)
    reverse(buffer, cut, high)
    reverse(buffer, low, high)


def transformed(text: bytes, h: list[int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of prefix and middle, output) of a text."""
    n = units(text)
    if not text or any(mark in text for mark in (P, S, M)) or h[2] % 100 >= rate:
        return n, PLAIN, None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    low, high = unit_end(text, low, n), unit_end(text, high, n)
    buffer = bytearray(text)
    sizes = characters(buffer, 0, low), characters(buffer, low, high)
    # the last first, so that the other cuts stay where they are
    buffer[high:high] = S
    buffer[low:low] = M
    buffer[0:0] = P
    middle, suffix = low + len(P), high + len(P) + len(M)
    form = SPM if h[3] % 100 < suffix_first else PSM
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return n, form, *sizes, bytes(buffer)


def restored(output: bytes, form: str) -> bytes:
    """The text that an output was made from."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    suffix = buffer.find(S)
    if form == PSM:
        middle = buffer.find(M, suffix)
        rotate(buffer, suffix, middle, len(buffer))
    else:
        prefix = buffer.find(P, suffix)
        rotate(buffer, suffix, prefix, len(buffer))
    # now <P>prefix<M>middle<S>suffix; the last sentinel goes first
    middle = buffer.find(M)
    suffix = buffer.find(S, middle)
    for at in (suffix, middle, 0):
        del buffer[at : at + 3]
    return bytes(buffer)


FIELDS = {"doc_id": pa.int64(), "n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}


def infill_rows(documents: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Rows of `ROWS`, one per row of `documents` (doc_id, text)."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            yield from gathered(((ids[row], *transformed(text, draws(ids[row], seed), rate, suffix_first)) for row, text in texts_of(batch)), FIELDS)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ROWS)


def restored_rows(rows: DataFrame) -> DataFrame:
    """`rows` of `ROWS` with a column restored: the text, from output and form alone."""
    fields = T.StructType([*rows.schema, T.StructField("restored", T.StringType())])

    def run(batches):
        for batch in batches:
            forms, first = batch.column("form").to_pylist(), 0
            for found in gathered(((restored(output, forms[row]),) for row, output in texts_of(batch, "output")), {"restored": pa.string()}):
                own = batch.slice(first, len(found))
                first += len(found)
                yield pa.record_batch([*own.columns, found.column(0)], [f.name for f in fields])

    return rows.mapInArrow(run, fields)
