"""Quality score by a small byte-level convolutional network, in numpy.

Bytes are embedded and read by learned filters of `WIDTH` bytes at every second
position. Filters are max-pooled over overlapping chunks that together cover the
whole text; the chunks' maxima are combined by their mean and their maximum, and
a hidden layer turns these into one probability. Filters, embedding and layers
are learnt together from a bounded sample of labelled rows (`samples`). Scoring
sees the whole of every text, a megabyte at a time, and needs no shuffle.

Defined results: a null text is an empty one, which is scored as one chunk of
padding. A null id is never held out and never learnt from. Repeated rows give
equal scores, one row each. With labels of one class or none every score is that
class's share (0.5 without labels). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from stallkeep.llm.bytetext import blocks
from stallkeep.llm.samples import ROWS_PER_CLASS, held_out, labelled

WIDTH, STRIDE = 8, 2
DEPTH, FILTERS, HIDDEN = 8, 32, 16
#: Bytes pooled at first, and pools in a chunk and from one chunk to the next.
POOL, CHUNK, STEP = 128, 4, 3
SLICE = 1 << 18
PAD = 256
PREDICT_FROM = 0.3

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
TAPS = WIDTH // STRIDE
PER_POOL = POOL // STRIDE


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, pool bounds): each text padded to whole pools, with at least one."""
    sizes = np.diff(offsets)
    pools = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.maximum(-(-sizes // POOL), 1))])
    out = np.full(pools[-1] * POOL, PAD, np.int16)
    out[np.arange(len(data)) + np.repeat(pools[:-1] * POOL - offsets[:-1], sizes)] = data
    return out, pools


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "embed": r.normal(0, 0.5, (PAD + 1, DEPTH)),
            "filter": r.normal(0, (WIDTH * DEPTH) ** -0.5, (TAPS, STRIDE * DEPTH, FILTERS)),
            "offset": np.zeros(FILTERS),
            "w1": r.normal(0, (2 * FILTERS) ** -0.5, (2 * FILTERS, HIDDEN)),
            "b1": np.zeros(HIDDEN),
            "w2": r.normal(0, HIDDEN**-0.5, (HIDDEN, 1)),
            "b2": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    def pooled(self, symbols: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(maxima, windows they are at) of each pool. `last`: pools after which another text begins."""
        rows, at = [], []
        ends = np.zeros(len(symbols) // POOL, bool)
        ends[last] = True
        for low in range(0, len(symbols), SLICE):
            part = symbols[low : low + SLICE + WIDTH - STRIDE]
            n = min(SLICE, len(symbols) - low) // STRIDE
            if len(part) < n * STRIDE + WIDTH - STRIDE:
                part = np.concatenate([part, np.full(WIDTH - STRIDE, PAD, np.int16)])
            a = self.p["embed"][part].reshape(-1, STRIDE * DEPTH)
            z = a[:n] @ self.p["filter"][0]
            for t in range(1, TAPS):
                z += a[t : t + n] @ self.p["filter"][t]
            z = z.reshape(-1, PER_POOL, FILTERS)
            z[ends[low // POOL : low // POOL + len(z)], 1 - TAPS :] = -np.inf  # windows that reach into the next text
            best = z.argmax(1) if self.learning else None
            rows.append(z.max(1))
            if self.learning:
                at.append(best + (np.arange(len(z)) * PER_POOL)[:, None] + low // STRIDE)
        return np.concatenate(rows) + self.p["offset"], np.concatenate(at) if at else None

    learning = False

    def forward(self, data: np.ndarray, offsets: np.ndarray) -> dict:
        symbols, pools = padded(data, offsets)
        best, at = self.pooled(symbols, pools[1:] - 1)
        n = np.diff(pools)
        chunks = np.maximum(-(-(n - (CHUNK - STEP)) // STEP), 1)
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(chunks)])
        of = np.repeat(np.arange(len(n)), chunks)
        start = pools[of] + (np.arange(bounds[-1]) - bounds[of]) * STEP
        members = np.minimum(start[:, None] + np.arange(CHUNK), pools[of + 1][:, None] - 1)
        chunk = np.maximum(best[members[:, 0]], 0)
        which = np.zeros(chunk.shape, np.int64) if self.learning else None
        for k in range(1, CHUNK):
            other = best[members[:, k]]
            if self.learning:
                which[other > chunk] = k
            chunk = np.maximum(chunk, other)
        mean = np.add.reduceat(chunk, bounds[:-1]) / chunks[:, None].astype(np.float32)
        top = np.maximum.reduceat(chunk, bounds[:-1])
        x = np.concatenate([mean, top], 1)
        h = np.maximum(x @ self.p["w1"] + self.p["b1"], 0)
        z = (h @ self.p["w2"] + self.p["b2"])[:, 0]
        return {"symbols": symbols, "at": at, "chunk": chunk, "which": which, "members": members, "chunks": chunks, "of": of, "top": top, "x": x, "h": h, "p": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}

    def learn(self, data: np.ndarray, offsets: np.ndarray, target: np.ndarray, weight: np.ndarray, rate: float) -> None:
        f = self.forward(data, offsets)
        d = ((f["p"] - target) * weight / len(target))[:, None].astype(np.float32)
        g = {"w2": f["h"].T @ d, "b2": d.sum(0)}
        dh = d @ self.p["w2"].T * (f["h"] > 0)
        g["w1"], g["b1"] = f["x"].T @ dh, dh.sum(0)
        dx = dh @ self.p["w1"].T
        chunk, of = f["chunk"], f["of"]
        dc = dx[of, :FILTERS] / f["chunks"][of, None] + dx[of, FILTERS:] * (chunk == f["top"][of])
        dc *= chunk > 0
        g["offset"] = dc.sum(0)
        # Only the window at a maximum passes its gradient on.
        row, col = np.nonzero(dc)
        value = dc[row, col]
        pool = f["members"][row, f["which"][row, col]]
        window = f["at"][pool, col]
        read = np.minimum(window[:, None] * STRIDE + np.arange(WIDTH), len(f["symbols"]) - 1)
        seen = f["symbols"][read]
        a = self.p["embed"][seen].reshape(len(row), -1) * value[:, None]
        order = np.argsort(col, kind="stable")
        cuts = np.searchsorted(col[order], np.arange(FILTERS + 1))
        df = np.zeros((FILTERS, WIDTH * DEPTH), np.float32)
        for k in range(FILTERS):
            df[k] = a[order[cuts[k] : cuts[k + 1]]].sum(0)
        g["filter"] = df.T.reshape(TAPS, STRIDE * DEPTH, FILTERS)
        back = self.p["filter"].reshape(WIDTH * DEPTH, FILTERS).T[col] * value[:, None]
        de, flat = back.reshape(-1, DEPTH), seen.ravel()
        g["embed"] = np.stack([np.bincount(flat, de[:, k], PAD + 1) for k in range(DEPTH)], 1)
        self.t += 1
        for k, grad in g.items():
            grad = grad.astype(np.float32)
            self.m[k] += 0.1 * (grad - self.m[k])
            self.v[k] += 0.01 * (grad * grad - self.v[k])
            self.p[k] -= rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-7)

    def scores(self, column: pa.Array) -> np.ndarray:
        found = [self.forward(data, offsets)["p"] for _, _, data, offsets in blocks(column, SLICE)]
        return np.concatenate([np.zeros(0), *found]).astype(np.float64)


def _batches(rows: list, size: int, r: np.random.Generator) -> Iterator[list]:
    order = r.permutation(len(rows))
    for k in range(0, len(rows), size):
        yield [rows[i] for i in order[k : k + size]]


def fit(rows: list[tuple[str, int]], passes: int = 5, seed: int = 7) -> Network | float:
    """A network, or the share of class 1 where the rows show fewer than two classes."""
    share = np.bincount([c for _, c in rows], minlength=2) / max(len(rows), 1)
    if (share > 0).sum() < 2:
        return float(share[1]) if rows else 0.5
    net, r = Network(seed), np.random.default_rng(seed)
    net.learning = True
    passes = max(passes, min(40, 3000 * passes // len(rows)))  # small samples are seen as often in all
    for k in range(passes):
        for some in _batches(rows, 32, r):
            texts = [t.encode() for t, _ in some]
            offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(t) for t in texts])])
            target = np.array([c for _, c in some], np.float32)
            weight = np.where(target > 0, 0.5 / share[1], 0.5 / share[0]).astype(np.float32)
            net.learn(np.frombuffer(b"".join(texts), np.uint8), offsets, target, weight, 0.004 * (1 - 0.8 * k / passes))
    net.learning = False
    net.m = net.v = {}
    return net


def score(documents: DataFrame, model: Network | float, predict_from: float = PREDICT_FROM) -> DataFrame:
    """One row of `SCHEMA` per row of `documents` (doc_id, text)."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        net = sent.value
        for batch in batches:
            column = batch.column("text")
            p = np.full(len(column), net) if isinstance(net, float) else net.scores(column)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= predict_from).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return documents.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, SCHEMA)


def quality_scores(documents: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS) -> DataFrame:
    return score(documents, fit(labelled(documents, labels, "quality", rows, learn_from=~held_out())))
