"""Quality rules: countable base rules, then a calibrated classifier's verdict.

Base rules fail a text of fewer than `FEWEST_WORDS` words, or one of which more
than half the words lie in three-word windows that occur twice or more in it.
The rest is judged by logistic regression on hashed word and character n-grams
(`hashed`), fitted on a bounded sample of labelled rows, calibrated, and held
against a fixed threshold, in Arrow batches and over whole texts.

Defined results: a null or empty text has no word, all counts 0, fails the base
rules and is not kept. Rows with a null or repeated id are scored like any
other, one row each. Without labels of both classes the classifier has no say:
texts that pass the base rules are kept. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from stallkeep.llm.bytetext import blocks, mix, per_text, shingles, words
from stallkeep.llm.hashed import HashedModel, fit
from stallkeep.llm.samples import ROWS_PER_CLASS, labelled

#: Fixed thresholds.
FEWEST_WORDS = 50
KEEP_FROM = 0.3
#: Fixed characters that count as symbols.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"


def repeated_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, words inside repeated three-word windows) of each text."""
    counts, repeated = [], []
    for _, _, data, offsets in blocks(column):
        found = words(data, offsets)
        sizes = np.diff(found.bounds)
        counts.append(sizes)
        grams, bounds = shingles(found, 3)
        of = np.repeat(np.arange(len(sizes)), np.diff(bounds))
        _, at, times = np.unique(mix(grams + mix(of.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
        twice = np.flatnonzero(times[at] > 1)
        place = found.bounds[of[twice]] + twice - bounds[of[twice]]
        inside = np.zeros(len(found.hash), bool)
        for k in range(3):
            inside[place + k] = True
        repeated.append(per_text(inside.astype(np.int64), found.bounds))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *counts]), np.concatenate([empty, *repeated])


def line_and_symbol_counts(text: str) -> tuple[int, int, int]:
    """(code points in words, symbols, lines with a word that equal an earlier line)."""
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))


def _measured(column: pa.Array, model: HashedModel | None, keep_from: float) -> tuple[np.ndarray, ...]:
    """(words, chars, symbols, repeated lines, repeated words, base_failed, probability, kept) of each text."""
    n_words, repeats = repeated_words(column)
    rest = np.array([line_and_symbol_counts(t or "") for t in column.to_pylist()], np.int64).reshape(-1, 3)
    failed = (n_words < FEWEST_WORDS) | (100 * repeats > 50 * n_words)
    p = model.posteriors(column)[:, 0] if model is not None else np.ones(len(n_words))
    return n_words, *rest.T.copy(), repeats, failed, p, ~failed & (p >= keep_from)


def judge(documents: DataFrame, model: HashedModel | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """One row of `SCHEMA` per row of `documents` (doc_id, text). No shuffle."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def score(batches):
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), *map(pa.array, _measured(batch.column("text"), sent.value, keep_from))], names)

    return documents.select("doc_id", "text").mapInArrow(score, SCHEMA)


def kept_rows(documents: DataFrame, model: HashedModel | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of `documents` that are kept, with all their columns. No shuffle."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(_measured(batch.column("text"), sent.value, keep_from)[-1]))

    return documents.mapInArrow(keep, documents.schema)


def fitted_model(documents: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS) -> HashedModel | None:
    """The classifier, or None where the labels know fewer than two classes."""
    sample = labelled(documents, labels, "quality", rows)
    return fit(sample, 1) if len({c for _, c in sample}) == 2 else None


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(documents, fitted_model(documents, labels))
