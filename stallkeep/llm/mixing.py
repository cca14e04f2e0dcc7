"""Mixing domains to target weights with soft membership.

1. A classifier fitted on the labelled table gives every document a posterior over
   domains (`hashed`, whole texts, calibrated).
2. A document's rate says how often its tokens are taken. Rates that are not
   negative are fitted by projected gradient steps on the weighted least squares

       sum over domains of (expected tokens - target tokens)**2 / domain's tokens,

   where a domain's expected tokens sum rate * tokens * posterior over all
   documents, within 0 and `MOST_RATE`. Each step is one distributed sum over a stored table, of as many
   numbers as there are domains; a task finds its documents' rates again from the
   steps so far. The steps begin at rate 1 and move against each posterior, so
   rates stay as near to 1 as the targets allow. Tokens weigh the gradient's
   metric, in which the largest curvature is 1, so steps of 1 converge.
3. The targets' total is set by an anchor domain, whose tokens are all kept: other
   domains are taken more or less often in proportion.
4. A rate becomes copies: up or down to a whole number by a hash of the row with the
   rate's fraction as probability, so that expected tokens are kept.

Tokens are words (runs of other than white space). Defined results: a null or
empty text has no tokens and its posterior is the classifier's for an empty text.
Null and repeated ids are treated row by row; rows alike get equal copies. Without
labels of two domains all posteriors are equal and all rates 1. A target for a domain
without documents can't be met and is left out; one beyond the largest rate is met as
far as that rate goes. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeep.llm.bytetext import blocks, mix, per_text, words
from stallkeep.llm.hashed import HashedModel, constant, fit
from stallkeep.llm.samples import labelled
from stallkeep.session import stored

#: Domains of the labelled table, in the order of their numbers.
DOMAINS = ("clean", "poor", "toxic")
TARGETS = {"clean": 0.93, "poor": 0.02, "toxic": 0.05}
ANCHOR = "clean"
STEPS, CLOSE = 40, 1e-3
#: Labelled rows a domain that the classifier is fitted on.
ROWS = 800
#: Largest rate: how often a document may be taken at most.
MOST_RATE = 4.0
#: Posterior of a domain from which a document is settled as not of the anchor.
MOSTLY = 0.75
SEED = 3


def domain_of_labels() -> Column:
    """0 clean, 1 poor, 2 toxic."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)


def fitted_model(documents: DataFrame, labels: DataFrame, rows: int = ROWS) -> HashedModel:
    numbered = labels.withColumn("domain", domain_of_labels())
    sample = labelled(documents, numbered, "domain", rows, values=tuple(range(len(DOMAINS))))
    return fit(sample, len(DOMAINS), steps=50, power=0.5) if len({c for _, c in sample}) > 1 else constant(np.full(len(DOMAINS), 1 / len(DOMAINS)))


def _scored(column: pa.Array, model: HashedModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row keys, words, posteriors) of texts."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, data, offsets in blocks(column):
        found = words(data, offsets)
        counts.append(np.diff(found.bounds))
        keys.append(mix(per_text(mix(found.hash), found.bounds)))
    p = model.posteriors(column)
    return np.concatenate(keys).view(np.int64), np.concatenate(counts), p


def posteriors(documents: DataFrame, model: HashedModel) -> DataFrame:
    """(doc_id, row_key, tokens, posterior) per row; row_key is a hash of the text's words."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            keys, counts, p = _scored(batch.column("text"), sent.value)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
            yield pa.record_batch([batch.column("doc_id"), pa.array(keys), pa.array(counts), values], ["doc_id", "row_key", "tokens", "posterior"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, row_key long, tokens long, posterior array<double>")


def rates_after(p: np.ndarray, steps: list[np.ndarray], most_rate: float = MOST_RATE, keep: int | None = None) -> np.ndarray:
    """Rates of documents with posteriors `p` after steps from 1, each projected to 0..`most_rate`.

    With `keep`, documents in which no domain but that one has `MOSTLY` or more stay at 1.
    """
    rate = np.ones(len(p))
    for step in steps:
        rate = np.clip(rate - p @ step, 0, most_rate)
    if keep is not None and len(p):
        rate[np.delete(p, keep, axis=1).max(1, initial=0) < MOSTLY] = 1
    return rate


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("posterior").flatten().to_numpy().reshape(len(batch), -1)


def fit_steps(table: DataFrame, targets: list[float], anchor: int, most: int = STEPS, close: float = CLOSE, most_rate: float = MOST_RATE, keep: int | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(steps, expected tokens, target tokens) for a stored table of posteriors.

    With `keep` (see `rates_after`) the rates of the other documents alone are fitted, to the targets of the other domains.
    """
    k = len(targets)
    weights = np.array(targets, float)

    def expected(steps: list[np.ndarray]) -> np.ndarray:
        def run(batches):
            total = np.zeros(k)
            for batch in batches:
                p = _matrix(batch)
                total += (rates_after(p, steps, most_rate, keep) * batch.column("tokens").to_numpy()) @ p
            yield pa.record_batch([pa.array([float(x)]) for x in total], [f"t{j}" for j in range(k)])

        sums = table.select("tokens", "posterior").mapInArrow(run, ", ".join(f"t{j} double" for j in range(k)))
        return np.array([x or 0.0 for x in sums.agg(*[F.sum(f"t{j}") for j in range(k)]).first()], float)

    steps: list[np.ndarray] = []
    mass = now = expected(steps)
    if weights[anchor] <= 0 or mass[anchor] <= 0:
        return steps, now, now
    goal = np.where(mass > 0, weights * mass[anchor] / weights[anchor], 0)
    free = np.array([j != keep for j in range(k)])
    for _ in range(most):
        off = np.where((mass > 0) & free, (now - goal) / np.maximum(mass, 1e-12), 0)
        if np.abs(now - goal)[free].max() <= close * goal.sum():
            break
        steps.append(off)
        before, now = now, expected(steps)
        if np.abs(now - before)[free].max() <= 0.01 * close * goal.sum():
            break  # what is left is beyond the largest rate
    return steps, now, goal


def copies_of(rate: Column, seed: int = SEED, key: str = "row_key") -> Column:
    """Whole copies for a rate, the same for rows alike."""
    chance = F.pmod(F.xxhash64(F.lit(seed), "doc_id", key), F.lit(1 << 30)) / (1 << 30)
    return F.floor(rate + chance).cast("long")


def with_rates(table: DataFrame, steps: list[np.ndarray], most_rate: float = MOST_RATE) -> DataFrame:
    """`table` (doc_id, row_key, tokens, posterior) with rate and copies."""

    def run(batches):
        for batch in batches:
            yield pa.record_batch([*batch.columns, pa.array(rates_after(_matrix(batch), steps, most_rate))], [*batch.schema.names, "rate"])

    rated = table.mapInArrow(run, "doc_id long, row_key long, tokens long, posterior array<double>, rate double")
    return rated.withColumn("copies", copies_of(F.col("rate")))


def fitted_rates(documents: DataFrame, model: HashedModel, targets: dict[str, float] | None = None, anchor: str = ANCHOR, most_rate: float = MOST_RATE, keep_anchor: bool = False) -> tuple[DataFrame, list[np.ndarray]]:
    """(stored posteriors, steps)."""
    targets = TARGETS if targets is None else targets
    table, first = stored(posteriors(documents, model), "posteriors"), DOMAINS.index(anchor)
    return table, fit_steps(table, [targets.get(d, 0.0) for d in DOMAINS], first, most_rate=most_rate, keep=first if keep_anchor else None)[0]


def taken_rows(documents: DataFrame, model: HashedModel, targets: dict[str, float] | None = None, anchor: str = ANCHOR, most_rate: float = MOST_RATE, keep_anchor: bool = False) -> DataFrame:
    """The rows of `documents`, with all their columns, as often as the mixture takes them.

    With `keep_anchor` documents that are not mostly of another domain are taken once, and the rates of the
    others are fitted so that all posteriors together meet the targets. Texts are scored a second time instead of being joined with their rates.
    """
    _, steps = fitted_rates(documents, model, targets, anchor, most_rate, keep_anchor)
    keep = DOMAINS.index(anchor) if keep_anchor else None
    sent = documents.sparkSession.sparkContext.broadcast(model)
    fields = documents.schema
    schema = T.StructType([*fields, T.StructField("__row_key", T.LongType()), T.StructField("__rate", T.DoubleType())])

    def run(batches):
        for batch in batches:
            keys, _, p = _scored(batch.column("text"), sent.value)
            yield pa.record_batch([*batch.columns, pa.array(keys), pa.array(rates_after(p, steps, most_rate, keep))], schema.fieldNames())

    rated = documents.mapInArrow(run, schema).withColumn("__copies", copies_of(F.col("__rate"), key="__row_key")).where("__copies > 0")
    return rated.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*[F.col(f"`{f.name}`") for f in fields])


def mixed(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, anchor: str = ANCHOR) -> DataFrame:
    """(doc_id, row_key, tokens, posterior, rate, copies) per row of `documents` (doc_id, text)."""
    return with_rates(*fitted_rates(documents, fitted_model(documents, labels), targets, anchor))
