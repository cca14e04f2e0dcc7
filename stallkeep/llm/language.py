"""Language identification by segmentation-marginalised unigram models.

The pieces are a fixed public vocabulary. For each language, expectation
maximisation over every segmentation of the words of a bounded sample gives the
pieces' probabilities. A word's probability in a language is the sum over all its
segmentations, computed by the forward algorithm for all languages at once; a
text's is the product over its words, whole texts always. Words repeat, so each
task keeps a bounded table of word scores. Scoring needs no shuffle.

Defined results: a null text or one without a letter is `und` with score 0.
Ties go to the alphabetically first language. Without any labelled text every
text is `und`. Null and repeated ids are scored row by row; a null id is not held
out and not learnt from. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.llm.bytetext import blocks, mix, per_text, words
from stallkeep.llm.samples import MOST_BYTES, at_most_twice, held_out

#: Texts per language that the models are fitted on, distinct words of them, and rounds.
TEXTS, WORDS, ROUNDS = 300, 30_000, 3
#: Words scored at once whose results a task keeps.
KEPT_WORDS = 500_000
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
MARK = "▁"  # begins a word in the vocabulary


def vocabulary(model_file: str) -> list[str]:
    """Pieces in lower case, without control and byte pieces."""
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = {s.id_to_piece(i).lower() for i in range(s.get_piece_size()) if not (s.is_control(i) or s.is_byte(i) or s.is_unknown(i))}
    return sorted(p for p in pieces if p)


class Lattice:
    """All pieces at all places of many words, each with the mark before it.

    `piece[size - 1][i]` is the piece of `size` characters that ends with character
    i of the joined words, or -1; a single character of no piece is `unknown`.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        marked = [MARK + w for w in words]
        self.longest = vocabulary.longest
        self.order = np.argsort([-len(w) for w in marked], kind="stable")
        self.length = np.array([len(marked[k]) for k in self.order], np.int64)
        points = np.frombuffer("".join(marked[k] for k in self.order).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.start = np.cumsum(self.length) - self.length
        place = np.arange(len(points)) - np.repeat(self.start, self.length)
        value, self.piece = np.zeros(len(points), np.uint64), []
        for size in range(1, self.longest + 1):
            # the hash of the last `size` characters grows at its front
            shifted = np.concatenate([np.zeros(size - 1, np.uint64), points[: len(points) - size + 1]])[: len(points)]
            value = value + (shifted + np.uint64(1)) * FRONT[size - 1]
            found = vocabulary.find(mix(value))
            found[place < size - 1] = -1
            if size == 1:
                found[found < 0] = vocabulary.unknown
            self.piece.append(found)

    def alive(self, end: int) -> int:
        """Words (a prefix of the order) of at least `end` characters."""
        return int(np.searchsorted(-self.length, -end, "right"))

    def sums(self, p: np.ndarray, backward: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
        """(sums of each place, log of the factors taken out): over all segmentations before a place, or after it."""
        most, names = int(self.length.max(initial=0)), p.shape[1]
        lift = np.zeros((len(self.length), names))
        rows = [np.ones((len(self.length), names))]
        for end in range(1, most + 1):
            n = self.alive(end)
            total = np.zeros((n, names))
            for size in range(1, min(self.longest, end) + 1):
                at = self.start[:n] + self.length[:n] - 1 - end + size if backward else self.start[:n] + end - 1
                piece = self.piece[size - 1][at]
                hit = np.flatnonzero(piece >= 0)
                total[hit] += rows[end - size][hit] * p[piece[hit]]
            rows.append(total)
            if end % 8 == 0 and most > 30:  # keep long words within range
                recent = rows[max(end - self.longest, 0) :]
                top = np.maximum.reduce([r[:n] for r in recent])
                for r in recent:
                    r[:n] /= top
                lift[:n] += np.log(top)
        return rows, lift

    def log_probability(self, p: np.ndarray) -> np.ndarray:
        rows, lift = self.sums(p)
        final = np.zeros_like(lift)
        for end in range(1, len(rows)):
            first, last = self.alive(end + 1), self.alive(end)
            final[first:last] = rows[end][first:last]
        out = np.zeros_like(lift)
        out[self.order] = np.log(final) + lift
        return out

    def expected(self, p: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of words of at most 24 characters."""
        ahead, _ = self.sums(p[:, None])
        back, _ = self.sums(p[:, None], backward=True)
        whole = np.zeros(len(self.length))
        for end in range(1, len(ahead)):
            first, last = self.alive(end + 1), self.alive(end)
            whole[first:last] = ahead[end][first:last, 0]
        times = times[self.order] / whole
        use = np.zeros(len(p))
        for end in range(1, len(ahead)):
            n = self.alive(end)
            rest = self.length[:n] - end
            after = np.zeros(n)
            for r in np.unique(rest):
                same = np.flatnonzero(rest == r)
                after[same] = back[r][same, 0]
            for size in range(1, min(self.longest, end) + 1):
                piece = self.piece[size - 1][self.start[:n] + end - 1]
                hit = np.flatnonzero(piece >= 0)
                use += np.bincount(piece[hit], times[hit] * ahead[end - size][hit, 0] * p[piece[hit]] * after[hit], len(p))
        return use


#: Bits of the slots of a vocabulary's tables.
SLOTS = 20
FRONT = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


class Vocabulary:
    """Pieces found by the hash of their characters."""

    def __init__(self, pieces: list[str]):
        self.unknown = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        if self.longest > len(FRONT):
            raise ValueError(f"a piece of {self.longest} characters; at most {len(FRONT)} may be")
        self.keys = np.zeros(len(pieces) + 1, np.uint64)
        for size in range(1, self.longest + 1):
            own = [k for k, p in enumerate(pieces) if len(p) == size]
            points = np.array([[ord(c) for c in reversed(pieces[k])] for k in own], np.uint64).reshape(-1, size)
            self.keys[own] = mix(((points + np.uint64(1)) * FRONT[:size]).sum(1, dtype=np.uint64))
        # two tables by different bits of the hash: what finds its place taken goes to the second
        self.first, self.second = np.full((2, 1 << SLOTS), -1, np.int32)
        for k, key in enumerate(self.keys[:-1].tolist()):
            table, slot = self.first, key >> (64 - SLOTS)
            if table[slot] >= 0:
                table, slot = self.second, key & ((1 << SLOTS) - 1)
                if table[slot] >= 0:
                    raise ValueError(f"{pieces[k]!r} has no place")
            table[slot] = k

    def find(self, keys: np.ndarray) -> np.ndarray:
        found = self.first[(keys >> np.uint64(64 - SLOTS)).astype(np.int64)]
        missed = np.flatnonzero(self.keys[found] != keys)
        other = self.second[(keys[missed] & np.uint64((1 << SLOTS) - 1)).astype(np.int64)]
        found[missed] = np.where(self.keys[other] == keys[missed], other, -1)
        return found


@dataclass
class Languages:
    names: list[str]
    vocabulary: Vocabulary
    probability: np.ndarray  # [piece, language]; the last row is for unknown characters
    scored: dict[int, int] = field(default_factory=dict)
    rows: np.ndarray | None = None

    def __post_init__(self):
        self.rows = np.zeros((0, len(self.names)))

    def score_words(self, found: list[str]) -> np.ndarray:
        return Lattice(found, self.vocabulary).log_probability(self.probability)

    def log_likelihoods(self, texts: list[str]) -> np.ndarray:
        """One row a text, one column a language."""
        out = []
        for _, _, data, offsets in blocks(pa.array([t.lower() for t in texts], pa.large_string())):
            found = words(data, offsets)
            keys, first, which = np.unique(found.hash, return_index=True, return_inverse=True)
            if len(self.scored) > KEPT_WORDS:
                self.scored, self.rows = {}, np.zeros((0, len(self.names)))
            asked = keys.tolist()
            at = np.fromiter(map(self.scored.get, asked, repeat(-1)), np.int64, len(asked))
            new = np.flatnonzero(at < 0)
            for low in range(0, len(new), 8000):
                some = new[low : low + 8000]
                strings = [data[a:b].tobytes().decode() for a, b in zip(found.start[first[some]], found.end[first[some]], strict=True)]
                at[some] = np.arange(len(some)) + len(self.rows)
                self.rows = np.concatenate([self.rows, self.score_words(strings)])
            self.scored.update(zip(keys[new].tolist(), at[new].tolist(), strict=True))
            table = self.rows[at]
            out.append(np.stack([per_text(table[which, k], found.bounds) for k in range(len(self.names))], 1))
        return np.concatenate(out) if out else np.zeros((0, len(self.names)))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        asked = [k for k, t in enumerate(texts) if t and self.names and any(map(str.isalpha, t))]
        for k, z in zip(asked, self.log_likelihoods([texts[k] for k in asked]), strict=True):
            e = np.exp(z - z.max())
            best = int(e.argmax())
            found[k] = (self.names[best], float(e[best] / e.sum()))
        return found


def fit(rows: list[tuple[str, str]], pieces: list[str], rounds: int = ROUNDS) -> Languages:
    """Piece probabilities of each language from (language, text) rows."""
    vocabulary = Vocabulary(pieces)
    names, tables = sorted({lang for lang, _ in rows}), []
    start = np.array([0.2 ** (len(p) * 0.5) for p in pieces] + [1e-4])
    for name in names:
        counts = Counter(w for lang, text in rows if lang == name for w in text.lower().split() if len(w) <= 24)
        common = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:WORDS]
        lattice, times = Lattice([w for w, _ in common], vocabulary), np.array([n for _, n in common], float)
        p = start / start.sum()
        for _ in range(rounds):
            use = lattice.expected(p, times) + 0.01
            p = use / use.sum()
            p[-1] = max(p[-1], 1e-6)
        tables.append(p)
    return Languages(names, vocabulary, np.array(tables).T if names else np.zeros((len(pieces) + 1, 0)))


#: Languages that a fit can tell apart in a worker's memory.
MOST_LANGUAGES = 200


def training_rows(documents: DataFrame, texts: int = TEXTS, most: int = MOST_BYTES) -> list[tuple[str, str]]:
    """(language, text) of at most `texts` documents of each language that are not held out.

    The ids chosen, a bounded number of each language, are kept by one hash threshold
    per language found from counts of ids alone, so that only the chosen texts leave
    the scan. An id is learnt from twice at most in a language; more than
    `MOST_LANGUAGES` are an error.
    """
    usable = documents.select("doc_id", "text", "lang").where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text") <= most))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    # twice the wanted share, cut to `texts` below: bounded, and enough of each
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], int((1 << 20) * min(1.0, 2 * texts / r["n"])))]) if counts else None
    chosen = usable.where(place < share[F.col("lang")]) if counts else usable.limit(0)
    # about twice `texts` rows a language are left: ranked there, and only what is learnt from is collected
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))
    ranked = at_most_twice(chosen, "lang", "doc_id").select("lang", "text", place.alias("place")).withColumn("rank", rank)
    found = ranked.where(F.col("rank") <= texts).select("lang", "rank", "text").collect()
    return [(r["lang"], r["text"]) for r in sorted(found, key=lambda r: (r["lang"], r["rank"]))]


def identify(documents: DataFrame, model: Languages) -> DataFrame:
    """One row of `SCHEMA` per row of `documents` (doc_id, text)."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        languages = sent.value
        for batch in batches:
            found = languages.predict(batch.column("text").to_pylist())
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return documents.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, SCHEMA)


def language_id(documents: DataFrame, model_file: str) -> DataFrame:
    return identify(documents, fit(training_rows(documents), vocabulary(model_file)))
