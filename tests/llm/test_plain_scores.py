"""Scores of the classifiers and the mixing fit against plain versions, one text and one number at a time."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")

from stallkeep.llm import bytetext, hashed, mixing, quality_cnn  # noqa: E402

TEXTS = ["", " ", "word", "é", "two words", "a b c d e " * 9, "x" * 700, "\n".join(f"line {k} of many, and 多 more" for k in range(80)), "tail" * 33 + " end", None]


def slot_of(piece, size):
    """The slot of one n-gram, from a text that holds nothing else of its family."""
    data = np.frombuffer(piece, np.uint8)
    if size == 4:
        value = sum(int(b) << (8 * k) for k, b in enumerate(data))
        return (value * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - hashed.BITS)
    found = bytetext.words(data, np.array([0, len(data)]))
    value = int(found.hash[0] if size == 1 else bytetext.shingles(found, 2)[0][0])
    return value >> (64 - hashed.BITS)


def plain_logit(model, text, column):
    """Bias, and of each family the sum of its n-grams' weights over the power of their number."""
    raw = (text or "").encode()
    words = [w for w in raw.translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w]
    grams = [[(w, 1) for w in words], [(a + b" " + b, 2) for a, b in zip(words, words[1:])], [(raw[k : k + 4], 4) for k in range(len(raw) - 3)]]
    total = float(model.bias[column])
    for family, some in enumerate(grams):
        sums = math.fsum(float(model.weights[family, slot_of(g, size), column]) for g, size in some)
        total += sums / max(len(some), 1) ** model.power
    shift = model.shift if np.isscalar(model.shift) else model.shift[column]
    return total * model.scale + float(shift)


@pytest.mark.parametrize("classes, power", [(1, 1.0), (3, 0.5)])
def test_hashed_logits(classes, power):
    r = random.Random(3)
    kinds = ["good plain text", "bad!! text $$$", "other kind of words"]
    rows = [(" ".join(r.choice(kinds[c].split()) for _ in range(r.randint(1, 40))), c) for c in range(max(classes, 2)) for _ in range(40)]
    model = hashed.fit(rows, classes, power=power)
    assert np.abs(model.weights).max() > 0 and model.scale != 1
    found = model.logits(pa.array(TEXTS, pa.string()))
    for k, text in enumerate(TEXTS):
        for c in range(found.shape[1]):
            assert found[k, c] == pytest.approx(plain_logit(model, text, c), rel=1e-6, abs=1e-6)
    p = model.posteriors(pa.array(TEXTS, pa.string()))
    assert p == pytest.approx(1 / (1 + np.exp(-found)) if classes == 1 else np.exp(found) / np.exp(found).sum(1, keepdims=True), rel=1e-6)


def plain_network(net, text):
    """One text through the network, window by window."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    raw = list((text or "").encode())
    pools = max(-(-len(raw) // quality_cnn.POOL), 1)
    symbols = raw + [quality_cnn.PAD] * (pools * quality_cnn.POOL - len(raw))
    filters = p["filter"].reshape(quality_cnn.WIDTH * quality_cnn.DEPTH, quality_cnn.FILTERS)
    best = np.full((pools, quality_cnn.FILTERS), -np.inf)
    for start in range(0, len(symbols) - quality_cnn.WIDTH + 1, quality_cnn.STRIDE):
        window = np.concatenate([p["embed"][s] for s in symbols[start : start + quality_cnn.WIDTH]])
        pool = start // quality_cnn.POOL
        best[pool] = np.maximum(best[pool], window @ filters)
    best += p["offset"]
    chunks, start = [], 0
    while True:  # overlapping chunks until the last pool is covered
        chunks.append(np.maximum(best[start : start + quality_cnn.CHUNK].max(0), 0))
        if start + quality_cnn.CHUNK >= pools:
            break
        start += quality_cnn.STEP
    x = np.concatenate([np.mean(chunks, 0), np.max(chunks, 0)])
    hidden = np.maximum(x @ p["w1"] + p["b1"], 0)
    return 1 / (1 + math.exp(-float((hidden @ p["w2"] + p["b2"])[0])))


def test_network_scores():
    net = quality_cnn.fit([("good words " * 9, 1), ("BAD!! " * 9, 0)] * 20, passes=2)
    found = net.scores(pa.array(TEXTS, pa.string()))
    for k, text in enumerate(TEXTS):
        assert found[k] == pytest.approx(plain_network(net, text), abs=1e-4)


def test_rates_solve_the_least_squares(spark):
    r = np.random.default_rng(5)
    p = r.dirichlet([0.5, 0.3, 0.2], 120)
    tokens = r.integers(1, 500, 120)
    for targets in ([0.5, 0.3, 0.2], [0.93, 0.02, 0.05]):
        rows = [(k, k, int(tokens[k]), p[k].tolist()) for k in range(120)]
        table = spark.createDataFrame(rows, "doc_id long, row_key long, tokens long, posterior array<double>")
        steps, now, goal = mixing.fit_steps(table.coalesce(1), targets, 0, most=60, close=1e-4)
        mass = tokens @ p

        def loss(rate):
            return ((((rate * tokens) @ p - goal) ** 2) / mass).sum()

        # one rate at a time, each to its best value within its bounds, until none moves
        plain = np.full(120, 2.0)
        for _ in range(3000):
            for k in range(120):
                off = (plain * tokens) @ p - goal
                slope, curve = tokens[k] * (p[k] * off / mass).sum(), tokens[k] ** 2 * (p[k] ** 2 / mass).sum()
                plain[k] = min(max(plain[k] - slope / curve, 0), mixing.MOST_RATE)
            if loss(plain) < 1e-9:
                break
        found = mixing.rates_after(p, steps)
        assert np.allclose((found * tokens) @ p, now)
        assert loss(found) <= loss(plain) + 1e-2 * (goal**2 / mass).sum()
