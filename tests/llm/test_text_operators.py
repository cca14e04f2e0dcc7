"""Scoring and packing operators against brute force, held-out rows and odd inputs."""

import random
import re
import tracemalloc
import zlib

from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from stallkeep.llm import bytetext, hashed, language, mixing, packing, quality_cnn, quality_rules  # noqa: E402
from stallkeep.llm.queries import PIECES, RANKS, VOCABULARY, tokenizer_file  # noqa: E402
from stallkeep.llm.samples import labelled  # noqa: E402

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, kept int, score string, token int"
ODD = [
    (1, None, 1, "a", 2),
    (2, "", 1, "a", 2),
    (3, " \n\t ", 1, "a", 2),
    (4, "one", 1, "a", 2),
    (4, "one", 1, "a", 2),
    (None, "no id here", 1, "a", 2),
    (5, "ß 漢字   é, don't  stop\r\n\r\nnow <|endoftext|>", 1, "a", 2),
    (6, "word " * 30_000, None, None, None),
    (7, "x" * 50_000, 1, "a", 2),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def texts_of(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


def random_texts(n, seed):
    r = random.Random(seed)
    alphabet = ["a", "B", "é", "漢", " ", " ", "\n", "\t", ".", "#"]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_words_are_those_of_the_pattern():
    texts = random_texts(300, 1)
    data, offsets = bytetext.buffers(pa.array(texts))
    found = bytetext.words(data, offsets)
    seen = {}
    for k, text in enumerate(texts):
        own = found.hash[found.bounds[k] : found.bounds[k + 1]].tolist()
        words = WORD.findall(text)
        assert len(own) == len(words)
        for h, w in zip(own, words, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_words_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(random_texts(200, 2)) + "y" * 500 + " z"
    data, offsets = bytetext.buffers(pa.array([text]))
    whole = bytetext.words(data, offsets).hash.tolist()
    monkeypatch.setattr(bytetext, "PIECE", 64)
    assert bytetext.words(data, offsets).hash.tolist() == whole


def brute_rules(text):
    words = WORD.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = set()
    for k in range(len(words) - 2):
        if grams[tuple(words[k : k + 3])] > 1:
            inside |= {k, k + 1, k + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside), failed)


def test_quality_rules_base_columns_and_verdict(documents, labels, odd, none):
    found = quality_rules.quality_rules(documents, labels)
    rows = {r.doc_id: r for r in found.collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    for doc_id, text in texts_of(documents).items():
        r = rows[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(text)
        assert not (r.base_failed and r.kept)
    good = [d for d, q in marks.items() if q == 1 and d in rows and not rows[d].base_failed]
    poor = [d for d, q in marks.items() if q == 0 and d in rows]
    assert sum(rows[d].kept for d in good) >= 0.99 * len(good)
    assert sum(rows[d].kept for d in poor) <= 0.1 * len(poor)
    judged = quality_rules.judge(odd, None).collect()
    assert len(judged) == len(ODD)
    by_text = {t: brute_rules(t) for _, t, *_ in ODD}
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in judged) == sorted(by_text[t] for _, t, *_ in ODD)
    assert quality_rules.judge(none, None).count() == 0
    assert quality_rules.kept_rows(odd, None).columns == odd.columns


def test_quality_rules_without_labels_keeps_what_passes_the_base(spark, documents, labels):
    found = quality_rules.quality_rules(documents, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in found)


def test_quality_network_on_held_out_rows(documents, labels, odd, none):
    rows = quality_cnn.quality_scores(documents, labels).collect()
    marks = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks]
    pairs = [(a, b) for a, y in held if y == 1 for b, z in held if z == 0]
    assert sum(a > b for a, b in pairs) >= 0.9 * len(pairs)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    net = quality_cnn.fit([("good words " * 9, 1), ("BAD!! " * 9, 0)] * 20)
    scored = quality_cnn.score(odd, net).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert not [r for r in scored if r.doc_id is None][0].held_out
    assert quality_cnn.score(none, net).count() == 0
    assert quality_cnn.fit([]) == 0.5 and quality_cnn.fit([("a", 1)]) == 1.0


def test_network_scores_do_not_depend_on_neighbours_or_slices(monkeypatch):
    net = quality_cnn.fit([("good words " * 9, 1), ("BAD!! " * 9, 0)] * 10, passes=1)
    texts = ["", "x", "good words " * 400, "BAD!! " * 31, "é" * 127, "q" * 128, "q" * 129]
    together = net.scores(pa.array(texts))
    assert np.allclose(together, [net.scores(pa.array([t]))[0] for t in texts], atol=1e-6)
    monkeypatch.setattr(quality_cnn, "SLICE", 1024)
    assert np.allclose(together, net.scores(pa.array(texts)), atol=1e-6)


def test_network_gradient_is_that_of_its_loss():
    texts = ["good words here " * 30, "BAD!! BAD!! " * 20]
    offsets = np.array([0, len(texts[0]), len(texts[0]) + len(texts[1])])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    net = quality_cnn.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.learning = True
    target, weight = np.array([1.0, 0.0]), np.ones(2)

    def loss():
        p = net.forward(data, offsets)["p"]
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).mean()

    before = {k: v.copy() for k, v in net.p.items()}
    net.learn(data, offsets, target, weight, 0.0)
    gradient = {k: v / 0.1 for k, v in net.m.items()}
    for name, at in (("w2", (3, 0)), ("w1", (5, 2)), ("offset", (4,)), ("filter", (1, 3, 4)), ("embed", (ord("o"), 2))):
        slope = []
        for step in (1e-4, -1e-4):
            net.p = {k: v.copy() for k, v in before.items()}
            net.p[name][at] += step
            slope.append(loss())
        assert abs((slope[0] - slope[1]) / 2e-4 - gradient[name][at]) < 1e-3 + 0.05 * abs(gradient[name][at])


def test_calibrated_logits_of_the_hashed_model():
    rows = [(f"fine text number {k} of many", 1) for k in range(60)] + [(f"*** SPAM {k} ***", 0) for k in range(60)]
    model = hashed.fit(rows, 1)
    p = model.posteriors(pa.array(["fine text number 99", "*** SPAM 99 ***", None, ""]))[:, 0]
    assert p[0] > 0.7 > 0.3 > p[1]
    assert p[2] == p[3]
    assert hashed.fit([], 1).posteriors(pa.array(["a"]))[0, 0] == 0.5


def brute_word(word, pieces, p, unknown):
    word = "▁" + word
    ways = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for begin in range(end):
            part = word[begin:end]
            if part in pieces:
                ways[end] += ways[begin] * p[pieces.index(part)]
            elif len(part) == 1:
                ways[end] += ways[begin] * unknown
    return ways[-1]


def test_segmentations_are_summed_and_counted():
    r = random.Random(5)
    pieces = ["▁", "a", "b", "ab", "▁ab", "ba", "aba"]
    p = np.array([0.1, 0.2, 0.2, 0.15, 0.1, 0.1, 0.1, 0.05])
    words = ["".join(r.choice("abc") for _ in range(r.randint(1, 12))) for _ in range(40)] + ["a" * 100]
    lattice = language.Lattice(words, language.Vocabulary(pieces))
    found = lattice.log_probability(p[:, None])[:, 0]
    for w, z in zip(words, found, strict=True):
        assert z == pytest.approx(np.log(brute_word(w, pieces, p, p[-1])))
    # a piece's expected uses are the slope of the log likelihood in its log probability
    some = words[:10]
    use = language.Lattice(some, language.Vocabulary(pieces)).expected(p, np.ones(10))
    for k in range(len(pieces) + 1):
        up, down = p.copy(), p.copy()
        up[k] *= 1.0001
        down[k] /= 1.0001
        slope = sum(np.log(brute_word(w, pieces, up, up[-1]) / brute_word(w, pieces, down, down[-1])) for w in some) / (2 * np.log(1.0001))
        assert use[k] == pytest.approx(slope, abs=1e-3)


def test_languages_of_held_out_rows(documents, odd, none):
    rows = language.language_id(documents, tokenizer_file(PIECES)).collect()
    lang = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(held) >= 0.95 * len(held)
    model = language.fit([("en", "the cat and the dog"), ("de", "der hund und die katze")] * 5, ["▁the", "▁der", "▁und", "▁and", "e", "r", "t", "▁"])
    found = {(r.doc_id): r for r in language.identify(odd, model).collect()}
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (1, 2, 3))
    assert found[4].lang_pred in ("en", "de") and 0.5 <= found[4].score <= 1
    assert language.identify(none, model).count() == 0
    assert language.fit([], ["a"]).predict(["text"]) == [("und", 0.0)]
    assert model.predict(["½ ²", "12 %", "ⅷ", "一", "the ½"])[:3] == [("und", 0.0)] * 3
    assert [name for name, _ in model.predict(["一", "the ½"])] != ["und", "und"]


def test_tokens_equal_the_vocabulary_file():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_file(VOCABULARY))
    whole.encode_special_tokens = True
    own = packing.Tokenizer(tokenizer_file(RANKS), tokenizer_file(VOCABULARY))
    texts = [t or "" for _, t, *_ in ODD] + random_texts(400, 3)
    texts += ["it's 5,000!! (the) end.\nNext—line…  thin", "a  b", "é, È. ×. ÷, a×, l'été", "tail ", " head", "\n", "a\tb\x0bc", "I'll we've 'quoted' x'y"]
    texts += [r[0] for r in duckdb.sql(f"SELECT text FROM '{DATA}/documents.parquet' LIMIT 200").to_df().values.tolist()]
    found = list(own.texts(pa.array(texts)))
    assert [f.tolist() for f in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def check_packing(rows, docs, length):
    """Each id in one piece, checksums right, sequences without gaps or overflow."""
    own = packing.Tokenizer(tokenizer_file(RANKS), tokenizer_file(VOCABULARY))
    texts = [t or "" for _, t in docs]
    ids = [np.append(x, 1).astype("<u4") for x in own.texts(pa.array(texts))]
    wanted = Counter()
    for (doc_id, _), x in zip(docs, ids, strict=True):
        for start in range(0, len(x), length):
            part = x[start : start + length]
            wanted[(doc_id, start, len(part), zlib.crc32(part.tobytes()), len(x))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    return sum(map(len, ids)), len(sequences)


def test_tokens_are_the_same_however_few_chunks_are_kept(monkeypatch):
    texts = [*random_texts(300, 4), None, "", *[t for _, t, *_ in ODD]]
    column = pa.array(texts)
    t = packing.Tokenizer(tokenizer_file(RANKS), tokenizer_file(VOCABULARY))
    whole = [ids.tolist() for ids in t.texts(column)]
    assert whole == [t.encode(text or "") for text in texts]
    monkeypatch.setattr(packing, "ENCODED", 2000)
    for most in (0, 50, 1 << 20):
        monkeypatch.setattr(packing, "KEPT_CHUNKS", most)
        t.forget()
        assert [ids.tolist() for ids in t.texts(column)] == whole


def test_packing_and_counting_words_take_little_of_a_workers_memory():
    rng = random.Random(1)
    known = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(60_000)]
    column = pa.array([" ".join(rng.choices(known, k=400)) for _ in range(1500)])  # 4 MB, about 60,000 chunks
    t = packing.Tokenizer(tokenizer_file(RANKS), tokenizer_file(VOCABULARY))

    def peak_mb(work) -> float:
        tracemalloc.start()
        try:
            work()
            return tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()

    bytetext._powers.clear()
    assert peak_mb(lambda: [len(ids) for ids in t.texts(column)]) < 50  # 96 with a dict of chunks and blocks of 2 MB
    assert peak_mb(lambda: quality_rules.repeated_words(column)) < 25


def test_packing_round_trip(documents, odd, none):
    files = tokenizer_file(RANKS), tokenizer_file(VOCABULARY)
    rows = packing.pack_documents(documents, *files).collect()
    tokens, sequences = check_packing(rows, [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], 2048)
    assert tokens >= 0.98 * sequences * 2048
    check_packing(packing.pack_documents(odd, *files, length=64, group=5).collect(), [(r[0], r[1]) for r in ODD], 64)
    assert packing.pack_documents(none, *files).count() == 0


def test_first_fit_decreasing_is_the_plain_one():
    r = np.random.default_rng(3)
    for n in (0, 1, 7, 200):
        lengths = r.integers(1, 100, n)
        sequence, offset = packing.first_fit_decreasing(lengths, 100)
        room, expected = [], {}
        for k in np.argsort(-lengths, kind="stable"):
            bin_ = next((b for b, free in enumerate(room) if free >= lengths[k]), None)
            if bin_ is None:
                bin_ = len(room)
                room.append(100)
            expected[k] = (bin_, 100 - room[bin_])
            room[bin_] -= lengths[k]
        assert [(s, o) for s, o in zip(sequence, offset, strict=True)] == [expected[k] for k in range(n)]


def test_mixing_meets_its_targets(spark, documents, labels, odd, none):
    model = mixing.fitted_model(documents, labels)
    table, steps = mixing.fitted_rates(documents, model)
    rows = mixing.with_rates(table, steps).collect()
    assert len(rows) == documents.count() and all(r.rate >= 0 for r in rows)
    expected = np.sum([np.array(r.posterior) * r.tokens * r.rate for r in rows], 0)
    share = expected / expected.sum()
    assert np.abs(share - [mixing.TARGETS[d] for d in mixing.DOMAINS]).max() < 0.01
    # the same steps on gathered rows
    p, t = np.array([r.posterior for r in rows]), np.array([r.tokens for r in rows])
    rate, goal = np.ones(len(rows)), None
    mass = t @ p
    goal = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS]) * mass[0] / mixing.TARGETS["clean"]
    for _ in steps:
        rate = np.maximum(rate - p @ (((rate * t) @ p - goal) / mass), 0)
    assert np.allclose(sorted(rate), sorted(r.rate for r in rows))
    taken = Counter(r.doc_id for r in mixing.taken_rows(documents, model).collect())
    assert taken == Counter({r.doc_id: r.copies for r in rows if r.copies})
    assert mixing.taken_rows(odd, model).columns == odd.columns
    assert mixing.mixed(none, labels).count() == 0
    flat = mixing.mixed(odd, labels.limit(0)).collect()
    assert len(flat) == len(ODD) and [r for r in flat if r.doc_id == 1][0].tokens == 0


def test_copies_meet_the_targets_of_a_domain_far_over_its_share(spark):
    domains = [0] * 6000 + [1] * 1200 + [2] * 600
    rows = [(k, k, 100, [float(d == j) for j in range(3)]) for k, d in enumerate(domains)]
    table = spark.createDataFrame(rows, "doc_id long, row_key long, tokens long, posterior array<double>")
    steps, _, _ = mixing.fit_steps(table, [mixing.TARGETS[d] for d in mixing.DOMAINS], 0)
    taken = np.zeros(3)
    for r in mixing.with_rates(table, steps).collect():
        taken[domains[r.doc_id]] += r.copies * r.tokens
    assert np.abs(taken / taken.sum() - [mixing.TARGETS[d] for d in mixing.DOMAINS]).max() < 0.006


def test_a_labelled_id_that_stands_often_leaves_the_others_in(spark):
    rows = [(1, f"often {k}") for k in range(400)] + [(k, f"text {k}") for k in range(2, 40)] + [(40, "same"), (40, "same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 41)], "doc_id long, quality int")
    found = labelled(docs, labels, "quality", 20)
    assert len(found) == 38 + 2 + 2 and Counter(label for _, label in found) == {0: 21, 1: 21}
    assert sum(t.startswith("often") for t, _ in found) == 2 and found.count(("same", 0)) == 2


def test_all_languages_are_learnt(spark):
    ids = [k for k in range(1, 900) if zlib.crc32(str(k).encode()) % 5][:600]
    rows = [(ids[0], f"often {k}", "l0") for k in range(3000)] + [(k, f"text {k}", f"l{j % 150}") for j, k in enumerate(ids[1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = Counter(lang for lang, _ in language.training_rows(docs, texts=3))
    assert len(found) == 150 and max(found.values()) == 3
    assert sum(t.startswith("often") for _, t in language.training_rows(docs, texts=3)) <= 2
    many = spark.range(1, 900).selectExpr("id AS doc_id", "'t' AS text", "string(id) AS lang")
    with pytest.raises(ValueError, match="languages"):
        language.training_rows(many)
