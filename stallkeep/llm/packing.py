"""Packing documents into sequences by first-fit decreasing, group by group.

1. Each text becomes ids of a public byte-level BPE and an end id. It is cut into
   pieces of at most `LENGTH` ids. Only the pieces' places, lengths and checksums
   are kept, as a table in the shared folder, so that a lost executor never
   re-tokenizes what is done and the steps below read fixed rows.
2. Full pieces are sequences of their own. The rest are dealt to randomised
   groups of about `GROUP` pieces, by a hash of the piece and its place in the
   table, so that no id, hot or repeated, decides where its pieces go.
3. In each group, pieces in falling order go to the first open sequence with room
   for them. A tournament tree over the sequences' free room finds it in
   logarithmic time.

Defined results: a null or empty text is its end id alone. Repeated rows and rows
with a null id are packed like others, piece by piece. Other columns are ignored.
An empty table gives no row. A sequence's number is unique, not consecutive.
"""

from __future__ import annotations

import base64
import re
import zlib

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeep.llm.bytetext import SPACE, blocks, give_back, span_hashes
from stallkeep.session import stored

LENGTH = 2048
END = 1
GROUP = 8192
SEED = 11
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Different chunks of text whose ids a task keeps.
KEPT_CHUNKS = 600_000
#: Bytes of texts that are encoded at once, unless one is longer. Their work arrays took about 30 times that in a trial.
ENCODED = 1 << 19
#: A longer text, or run without white space, is encoded by itself.
LONG_TEXT, LONG_WORD = 4 << 20, 2000


def _letters_end(data: np.ndarray) -> np.ndarray:
    """Whether each byte ends an ASCII letter or one of the letters of U+00C0 to U+00FF."""
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    follows = np.concatenate([np.zeros(1, bool), data[:-1] == 0xC3])
    return ascii_letter[data] | follows & (data >= 0x80) & (data != 0x97) & (data != 0xB7)


#: UTF-8 of white space beyond ASCII.
WIDE_SPACES = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf", b"\xe2\x81\x9f", b"\xe3\x80\x80"] + [b"\xe2\x80" + bytes([k]) for k in range(0x80, 0x8B)]
#: ASCII marks that end a word in the vocabulary's pattern; an apostrophe may go on with letters.
MARK = np.zeros(256, bool)
MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True


class Tokenizer:
    """Ids of whole texts. Strings of special tokens are ordinary text.

    In the vocabulary's pattern no token holds bytes on both sides of a single
    white space's beginning, or of a mark that follows a letter. So a text without
    two adjoining white spaces is a sequence of chunks that are encoded one by one:
    each different chunk of a block once, and the most recent kept, in sorted
    arrays. Any other text, and a very long one, is encoded as a whole.
    """

    def __init__(self, ranks_file: str, json_file: str):
        import tiktoken

        from public_tokenizers import PATTERN

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.json_file, self.full = json_file, None
        self.forget()

    def forget(self) -> None:
        #: Hashes of the chunks kept, in order; `places` says where each chunk's ids begin in `pool`, and `sizes` how many they are.
        self.kept, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.sizes, self.pool = np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def encode(self, text: str) -> list[int]:
        if len(text) > LONG_WORD and max(map(len, text.split()), default=0) > LONG_WORD:  # the fast encoder is quadratic in a word's length
            if self.full is None:
                import tokenizers

                self.full = tokenizers.Tokenizer.from_file(self.json_file)
                self.full.encode_special_tokens = True
            return self.full.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Little-endian 32-bit ids of each text."""
        for _, _, data, offsets in blocks(column, ENCODED):
            yield from self._block(data, offsets)

    def _encoded(self, asked: np.ndarray, start: np.ndarray, end: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(place in the pool, ids) of chunks of `raw`, given by their hashes in order; what isn't kept is encoded, and kept."""
        if len(self.kept) > KEPT_CHUNKS:
            self.forget()
        before = np.searchsorted(self.kept, asked)
        known = before < len(self.kept)
        known[known] = self.kept[before[known]] == asked[known]
        new = np.flatnonzero(~known)
        found = [self.fast.encode_ordinary(raw[x:y].decode()) for x, y in zip(start[new].tolist(), end[new].tolist(), strict=True)]
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        places = len(self.pool) + np.cumsum(sizes, dtype=np.int64) - sizes
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(found), np.uint32)])
        self.kept, self.places, self.sizes = (np.insert(old, before[new], more) for old, more in ((self.kept, asked[new]), (self.places, places), (self.sizes, sizes)))
        at = np.searchsorted(self.kept, asked)
        return self.places[at], self.sizes[at]

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        n = len(data)
        if n > LONG_TEXT or not n:
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                yield np.array(self.encode(data[a:b].tobytes().decode()), "<u4")
            return
        space = SPACE[data]
        begins = space.copy()
        begins[1:] |= MARK[data[1:]] & _letters_end(data)[:-1]
        begins[offsets[:-1][offsets[:-1] < n]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], n)
        bounds = np.searchsorted(start, offsets)
        odd = np.flatnonzero(space[:-1] & space[1:])
        raw = data.tobytes()
        wide = [m.start() for m in WIDE.finditer(raw)] if (data >= 0x80).any() else []
        whole = np.zeros(len(offsets) - 1, bool)
        of = np.searchsorted(offsets, np.concatenate([odd, np.array(wide, np.int64), start[end - start > LONG_WORD]]).astype(np.int64), "right") - 1
        whole[of] = True
        keys, first, which = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        needed = np.zeros(len(keys), bool)
        chosen = np.repeat(~whole, np.diff(bounds))
        needed[which[chosen]] = True
        own = np.flatnonzero(needed)
        place, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        place[own], size[own] = self._encoded(keys[own], start[first[own]], end[first[own]], raw)
        which = which[chosen]
        length = size[which]
        stop = np.cumsum(length)
        ids = self.pool[np.repeat(place[which] - (stop - length), length) + np.arange(int(length.sum()))].astype("<u4", copy=False)
        cuts = np.concatenate([np.zeros(1, np.int64), stop])[np.concatenate([np.zeros(1, np.int64), np.cumsum(chosen)])[bounds]]
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            yield np.array(self.encode(raw[a:b].decode()), "<u4") if whole[k] else ids[cuts[k] : cuts[k + 1]]


WIDE = re.compile(b"|".join(map(re.escape, WIDE_SPACES)))


@lru_cache(1)
def tokenizer(ranks_file: str, json_file: str) -> Tokenizer:
    return Tokenizer(ranks_file, json_file)


def pieces(documents: DataFrame, ranks_file: str, json_file: str, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """The pieces of each row; `ids` (little-endian 32-bit) only on request."""

    fields = PIECES if keep_ids else PIECES.rpartition(",")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(ranks_file, json_file)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), t.texts(batch.column("text")), strict=True):
                ids = found.tobytes() + end
                n = len(ids) // 4
                for start in range(0, n, length):
                    part = ids[4 * start : 4 * (start + length)]
                    out.append((doc_id, start, len(part) // 4, zlib.crc32(part), n, part if keep_ids else None))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                arrays.append(pa.array(columns[5], pa.binary()))
                names.append("ids")
            yield pa.record_batch(arrays, names)
        t.forget()  # the worker goes on to other tasks, and other work
        give_back()

    return documents.select("doc_id", "text").mapInArrow(run, fields)


class Tournament:
    """Free room of the open sequences; each inner node holds the larger of its two."""

    def __init__(self, leaves: int, room: int):
        self.size = 1
        while self.size < leaves:
            self.size *= 2
        self.tree = [0] * self.size + [room] * leaves + [0] * (self.size - leaves)
        for k in range(self.size - 1, 0, -1):
            self.tree[k] = max(self.tree[2 * k], self.tree[2 * k + 1])

    def place(self, amount: int) -> tuple[int, int]:
        """(first sequence with room for `amount`, room it had); takes the room."""
        tree, k = self.tree, 1
        while k < self.size:
            k *= 2
            if tree[k] < amount:
                k += 1
        leaf, room = k - self.size, tree[k]
        tree[k] = room - amount
        k //= 2
        while k:
            best = max(tree[2 * k], tree[2 * k + 1])
            if tree[k] == best:
                break
            tree[k] = best
            k //= 2
        return leaf, room


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece of at most `room`."""
    order = np.argsort(-lengths, kind="stable")
    tree = Tournament(max(len(lengths), 1), room)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k in order.tolist():
        amount = int(lengths[k])
        sequence[k], free = tree.place(amount)
        offset[k] = room - free
    return sequence, offset


def pack(table: DataFrame, length: int = LENGTH, group: int = GROUP, seed: int = SEED) -> DataFrame:
    """Rows of `SCHEMA` for a stored table of pieces."""
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = table.where(F.col("length") == length)
    rest = table.where(F.col("length") < length)
    groups = max(1, -(-rest.count() // group))
    place = F.monotonically_increasing_id()  # of fixed rows of a stored table
    dealt = rest.select(*columns, F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", place), F.lit(groups)).alias("group"))

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "ids_crc32", "doc_id", "start"], ascending=[False, True, True, True], ignore_index=True)
        sequence, offset = first_fit_decreasing(rows["length"].to_numpy(), length)
        # sequences are numbered from 0 in each group; groups interleave, full pieces come after all
        rows["sequence_id"], rows["offset"] = sequence * groups + key[0], offset
        return rows[[*columns, "sequence_id", "offset"]].astype({"doc_id": "Int64"})

    packed = dealt.groupBy("group").applyInPandas(one, SCHEMA)
    # below 2**40 sequences of groups; ids of full pieces start there
    alone = full.select(*columns, (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def pack_documents(documents: DataFrame, ranks_file: str, json_file: str, length: int = LENGTH, group: int = GROUP, seed: int = SEED) -> DataFrame:
    return pack(stored(pieces(documents, ranks_file, json_file, length), "pieces"), length, group, seed)
