"""Logistic regression on hashed word and character n-grams, in numpy.

A text's logit for a class is a bias plus, for each family of n-grams, the mean
weight of the family's n-grams in the whole text: words, pairs of words, and
runs of four bytes. Means make long and short texts comparable, and can be
summed piece by piece. With `power` 0.5 the sum is divided by the root of the
count instead, so that a few telling words show in a long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from stallkeep.llm.bytetext import PIECE, blocks, give_back, per_text, shingles, words

BITS = 18
FAMILIES = 3


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int32)


def _byte_runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, bounds) of the four-byte runs, piece by piece; bounds are of all texts in each piece."""
    for low in range(0, max(len(data) - 3, 0), PIECE):
        part = data[low : low + PIECE + 3].astype(np.uint32)
        joined = part[:-3] | part[1:-2] << np.uint32(8) | part[2:-1] << np.uint32(16) | part[3:] << np.uint32(24)
        slots = (joined * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)).astype(np.int32)
        inside = np.ones(len(slots), bool)
        for back in (1, 2, 3):  # runs that would cross into the next text
            cuts = offsets[1:-1] - back - low
            inside[cuts[(cuts >= 0) & (cuts < len(slots))]] = False
        kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(inside)])
        yield slots[inside], kept[np.clip(offsets - low, 0, len(slots))]


def families(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(family, slots, bounds); a family may come in several pieces."""
    found = words(data, offsets)
    yield 0, _slots(found.hash), found.bounds
    pairs, bounds = shingles(found, 2)
    yield 1, _slots(pairs), bounds
    for slots, bounds in _byte_runs(data, offsets):
        yield 2, slots, bounds


@dataclass
class HashedModel:
    """`weights[family, slot, class]`; `scale` and `shift` calibrate the logits."""

    weights: np.ndarray
    bias: np.ndarray
    power: float = 1.0
    scale: float = 1.0
    shift: np.ndarray | float = 0.0

    def logits(self, column: pa.Array) -> np.ndarray:
        """Calibrated logits, one row a text."""
        rows = []
        for first, stop, data, offsets in blocks(column):
            total = np.zeros((FAMILIES, stop - first, len(self.bias)))
            count = np.zeros((FAMILIES, stop - first, 1))
            for family, slots, bounds in families(data, offsets):
                count[family, :, 0] += np.diff(bounds)
                for k in range(len(self.bias)):
                    total[family, :, k] += per_text(self.weights[family, slots, k].astype(np.float64), bounds)
            rows.append((total / np.maximum(count, 1) ** self.power).sum(0) + self.bias)
        raw = np.concatenate(rows) if rows else np.zeros((0, len(self.bias)))
        return raw * self.scale + self.shift

    def posteriors(self, column: pa.Array) -> np.ndarray:
        z = self.logits(column)
        if z.shape[1] == 1:
            return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        z = np.exp(z - z.max(1, keepdims=True, initial=-1e30))
        return z / z.sum(1, keepdims=True)


def constant(probabilities: np.ndarray) -> HashedModel:
    """A model that gives every text the same answer, for samples of one class or none."""
    p = np.clip(probabilities, 1e-3, 1 - 1e-3)
    bias = np.log(p / (1 - p)) if len(p) == 1 else np.log(p)
    return HashedModel(np.zeros((FAMILIES, 1 << BITS, len(p)), np.float32), bias)


def fit(rows: list[tuple[str, int]], classes: int, steps: int = 40, rate: float = 0.4, decay: float = 1e-3, power: float = 1.0) -> HashedModel:
    """Fit on (text, class) rows: full-batch Adam on class-balanced log loss, then calibration on every fifth row.

    `classes` 1 means one logit for class 1 of {0, 1}. A sample without at least
    two classes gives a constant model of the class shares (0.5 where empty).
    """
    labels = np.array([c for _, c in rows], np.int64)
    outputs = max(classes, 2)
    share = np.bincount(labels, minlength=outputs) / max(len(rows), 1)
    if (share > 0).sum() < 2:
        if classes == 1:
            return constant(np.array([share[1] if len(rows) else 0.5]))
        return constant(share if len(rows) else np.full(classes, 1 / classes))
    tested = np.arange(len(rows)) % 5 == 4
    order = np.argsort(labels, kind="stable")  # every fifth row of each class
    tested = tested[np.argsort(order)]
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(FAMILIES)]
    for text, _ in rows:
        column = pa.array([text])
        data = np.frombuffer(column.buffers()[2], np.uint8) if text else np.zeros(0, np.uint8)
        here = [[] for _ in range(FAMILIES)]
        for family, slots, _ in families(data, np.array([0, len(data)])):
            here[family].append(slots)
        for family, x in enumerate(here):
            slots, counts = np.unique(np.concatenate(x) if x else np.zeros(0, np.int32), return_counts=True)
            found[family].append((slots.astype(np.int32), counts.astype(np.float32)))
    stacked = []
    for parts in found:
        slots, value = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        sizes = [len(p[0]) for p in parts]
        total = np.array([max(p[1].sum(), 1) for p in parts])
        value /= np.repeat((total**power).astype(np.float32), sizes)
        stacked.append((slots, np.repeat(np.arange(len(parts), dtype=np.int32), sizes), value))
        parts.clear()  # held once, not twice
    k = 1 if classes == 1 else classes
    target = labels[:, None].astype(float) if k == 1 else np.eye(k)[labels]
    weight = np.where(tested, 0, 1 / np.maximum(share[labels], 1e-9))
    weight = weight / weight.sum()
    model = HashedModel(np.zeros((FAMILIES, 1 << BITS, k), np.float32), np.zeros(k), power)
    first, second = np.zeros_like(model.weights), np.zeros_like(model.weights)
    bias_state = [np.zeros(k), np.zeros(k)]

    def raw() -> np.ndarray:
        z = np.tile(model.bias, (len(rows), 1))
        for family, (slots, of, value) in enumerate(stacked):
            for c in range(k):
                for part in _pieces(len(of)):
                    z[:, c] += np.bincount(of[part], model.weights[family, slots[part], c] * value[part], len(rows))
        return z

    def squash(z: np.ndarray) -> np.ndarray:
        if k == 1:
            return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    for step in range(1, steps + 1):
        slope = (squash(raw()) - target) * weight[:, None]
        for family, (slots, of, value) in enumerate(stacked):
            for c in range(k):
                g = decay * 1e-3 * model.weights[family, :, c].astype(np.float64)
                for part in _pieces(len(of)):
                    g += np.bincount(slots[part], slope[of[part], c] * value[part], 1 << BITS)
                m, v = first[family, :, c], second[family, :, c]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model.weights[family, :, c] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        g = slope.sum(0)
        bias_state[0] += 0.1 * (g - bias_state[0])
        bias_state[1] += 0.01 * (g * g - bias_state[1])
        model.bias -= 0.05 * (bias_state[0] / (1 - 0.9**step)) / (np.sqrt(bias_state[1] / (1 - 0.99**step)) + 1e-6)
    fitted = _calibrate(model, raw()[tested], target[tested])
    stacked.clear()
    give_back()  # the driver's, which stays and fits again
    return fitted


def _pieces(n: int, size: int = 1 << 20) -> Iterator[slice]:
    """Parts of n entries, so that what is computed from them stays small."""
    return (slice(low, low + size) for low in range(0, n, size))


def _calibrate(model: HashedModel, z: np.ndarray, target: np.ndarray) -> HashedModel:
    """Scale and shift that minimise the log loss of rows the weights have not seen (Platt for one logit)."""
    scale, shift = 1.0, np.zeros(z.shape[1])
    for _ in range(400):
        y = z * scale + shift
        if z.shape[1] == 1:
            p = 1 / (1 + np.exp(-np.clip(y, -40, 40)))
        else:
            e = np.exp(y - y.max(1, keepdims=True))
            p = e / e.sum(1, keepdims=True)
        d = p - target
        scale = max(scale - 0.1 * ((d * z).sum(1).mean() / max((z * z).mean(), 1e-9) + 1e-3 * (scale - 1)), 0.05)
        shift = shift - 0.3 * (d.mean(0) + 1e-3 * shift)
    model.scale, model.shift = float(scale), shift
    return model
