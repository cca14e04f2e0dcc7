"""Near-duplicates, passages, pages, archives, search and the pipeline against brute force and odd inputs."""

import hashlib
import itertools
import random
import re
import time

from collections import Counter

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402

from stallkeep.llm import bytetext, components, hamming_search, html_main, mixing, passages, setsketch, warc  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, u int, key int, rep int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", 1, 2, 3) for i, t in rows], DOCS)


def words_of(text):
    return WORD.findall((text or "").translate(LOW))


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, shingle_set(t))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def prose(r, n):
    return [f"w{r.randint(0, 10**6)}" for _ in range(n)]


def edited(r, words, edits):
    out = list(words)
    for _ in range(edits):
        out[r.randrange(len(out))] = f"e{r.randint(0, 10**6)}"
    return out


@pytest.fixture(scope="module")
def crowd():
    """A large group of near copies of one text, a passage that many texts share, chains, copies and short texts."""
    r = random.Random(9)
    base, line = prose(r, 150), prose(r, 70)
    rows = [edited(r, base, r.randint(0, 6)) for _ in range(70)]
    rows += [prose(r, r.randint(20, 60)) + line + prose(r, r.randint(20, 60)) for _ in range(50)]
    chain = prose(r, 120)
    for _ in range(8):
        chain = edited(r, chain, 2)
        rows.append(chain)
    rows += [prose(r, 30)] * 5 + [["a", "b", "c"], ["A", "b", "C"], ["a", "b", "d"], list("abcdefg"), list("abcdefgh"), []]
    texts = [" ".join(x) for x in rows]
    r.shuffle(texts)
    return list(enumerate(texts))


def test_components_of_random_edges(spark):
    r = random.Random(4)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(7, None)]
    found = {x.node: x.component for x in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert found == {i: find(i) for i in list(root)}


def test_near_duplicates_are_the_brute_force_components(spark, crowd):
    rows = setsketch.near_duplicates(frame(spark, crowd)).collect()
    component, size = brute_components(crowd)
    assert len(rows) == len(crowd)
    assert {r.doc_id: r.n_shingles for r in rows} == size
    assert {r.doc_id: r.component_id for r in rows} == component
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (4, "a"), (5, "A"), (None, "a"), (None, "lonely text"), (6, "y " * 40_000)]
    found = setsketch.near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None}
    assert by_id == {1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 4, False), 6: (1, 6, True)}
    assert sorted((r.component_id, r.kept) for r in found if r.doc_id is None and r.component_id) == [(4, False)]
    assert setsketch.near_duplicates(frame(spark, [])).count() == 0


def test_one_row_of_each_group_stays(spark):
    r = random.Random(15)
    base = prose(r, 80)
    near, other = " ".join(edited(r, base, 1)), " ".join(prose(r, 60))
    rows = [(1, " ".join(base)), (2, near), (2, near), (3, other), (3, other), (3, " ".join(prose(r, 50))), (4, None), (4, None), (5, ""), (6, "short text"), (7, "Short TEXT"), (None, other), (None, "alone"), (None, "alone"), (8, " ".join(prose(r, 9)))]
    docs = frame(spark, rows)
    kept = setsketch.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = Counter((x.doc_id, x.text) for x in kept.collect())
    assert found[(1, rows[0][1])] == 1 and not any(i == 2 for i, _ in found)
    assert found[(3, other)] == 1 and sum(n for (i, _), n in found.items() if i == 3) == 2
    assert found[(4, None)] == 1 and found[(5, "")] == 1 and found[(6, "short text")] == 1 and (7, "Short TEXT") not in found
    assert found[(None, "alone")] == 1 and found[(8, rows[-1][1])] == 1
    assert setsketch.without_near_duplicates(docs.limit(0)).count() == 0


def test_registers_merge_and_estimate():
    r = np.random.default_rng(2)
    a, b = r.integers(0, 1 << 63, 400, dtype=np.uint64), r.integers(0, 1 << 63, 300, dtype=np.uint64)
    both = np.concatenate([a, b])
    one, two, union = (setsketch.registers(x, np.array([0, len(x)]))[0] for x in (a, b, both))
    assert (np.maximum(one, two) == union).all()
    similar = np.concatenate([a[:320], b[:80]])
    other = setsketch.registers(similar, np.array([0, 400]))
    j = setsketch.likely_similarity(one[None, :], other, np.array([400.0]), np.array([400.0]))[0]
    assert abs(j - 320 / 480) < 5 * (2 / 9 / setsketch.REGISTERS) ** 0.5


def test_rare_shingles_lose_no_link(spark, crowd):
    texts = [(i, t, i) for i, t in crowd]
    found = {(r.u, r.v) for r in setsketch.rare_shingle_pairs(spark.createDataFrame(texts, "rep long, text string, component long")).collect()}
    sets = {i: shingle_set(t) for i, t in crowd}
    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * len(sets[a] | sets[b]) and sets[a] != sets[b]:
            assert (a, b) in found or (b, a) in found


def test_passages_cover_all_exact_repeats_and_nothing_else(spark):
    r = random.Random(21)
    phrase, shared, near = prose(r, 12), prose(r, 60), prose(r, 90)
    rows = []
    for k in range(60):
        middle = [phrase]
        if k % 7 == 0:
            middle.append(shared)
        if k % 11 == 0:
            middle.append(edited(r, near, 1))
        words = prose(r, r.randint(5, 80))
        for part in middle:
            words += part + prose(r, r.randint(5, 80))
        rows.append((k, " ".join(words)))
    rows += [(100, rows[3][1]), (101, rows[3][1].upper()), (102, " ".join(prose(r, 55) * 3))]
    spans = passages.merged_spans(passages.repeated_passages(frame(spark, rows))).collect()
    covered = {}
    for s in spans:
        assert s.n_words >= 49 and s.keeper < s.doc_id
        covered.setdefault(s.doc_id, set()).update(range(s.start_word, s.start_word + s.n_words))
    first, exact = {}, {}
    for i, t in rows:
        w = words_of(t)
        grams = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        for k, g in enumerate(grams):
            if g in first:
                exact.setdefault(i, set()).update(range(k, k + 50))
        for g in grams:
            first.setdefault(g, i)
    exact.pop(102, None)  # it repeats itself only
    assert all(places <= covered.get(i, set()) for i, places in exact.items())
    assert set(covered) == set(exact) | {k for k in range(11, 60, 11)}
    docs = frame(spark, rows)
    kept = {x.doc_id: x.text for x in passages.without_repeats(docs, spark.createDataFrame(spans, passages.SPANS)).collect()}
    for i, t in rows:
        assert words_of(kept[i]) == [w for k, w in enumerate(words_of(t)) if k not in covered.get(i, set())]


def found_passages(a, b):
    """(begin, end) in words of the passages of one list of words that another holds too."""
    (tokens_a, words_a), (tokens_b, words_b) = (arrays(x) for x in (a, b))
    return [(low, high + 4, s) for low, high, s in passages.shared_passages(tokens_a, tokens_b, words_a, words_b)]


def arrays(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    found = bytetext.words(data, np.array([0, len(data)]), lower=True)
    return bytetext.shingles(found, 5)[0], found.hash


def similar(a, b):
    x, y = (Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for w in (a, b))
    return (x & y).total() / (x | y).total()


@pytest.mark.parametrize("copies", [1, 40])
def test_a_near_passage_is_found_if_smaller_documents_hold_its_parts(spark, copies):
    r = random.Random(copies)
    passage = [f"p{k}" for k in range(64)]
    rows = []
    for _ in range(copies):  # parts too short for a passage, in many documents
        rows += [(len(rows), " ".join(prose(r, 60) + passage[:36] + prose(r, 60))), (len(rows) + 1, " ".join(prose(r, 60) + passage[28:] + prose(r, 60)))]
    edited = passage[:32] + ["other"] + passage[33:]
    rows += [(1000, " ".join(prose(r, 30) + passage + prose(r, 30))), (1001, " ".join(prose(r, 20) + edited + prose(r, 30)))]
    spans = passages.merged_spans(passages.repeated_passages(frame(spark, rows))).collect()
    assert [(x.doc_id, x.keeper, x.start_word, x.n_words) for x in spans] == [(1001, 1000, 20, 64)]


def test_passages_bridge_what_their_similarity_allows():
    r = random.Random(31)
    least = {True: 0, False: 0}
    cases = [(60, 30, 0, 3), (60, 30, 3, 0), (98, 45, 9, 9)]
    cases += [(n, r.randint(1, n - 20), r.randint(0, 16), r.randint(0, 16)) for n in r.choices(range(55, 140), k=300)]
    for n, at, gone, new in cases:
        shared = prose(r, n)
        other = shared[:at] + prose(r, new) + shared[at + gone :]
        a, b = prose(r, 40), prose(r, 25)
        found = found_passages(a + shared + b, prose(r, 20) + other + prose(r, 30))
        rest = max(at, n - at - gone)
        whole = any(low <= 40 and high >= 40 + n for low, high, _ in found)
        if similar(shared, other) >= 0.75:
            least[True] += 1
            # a short end beyond an edit that isn't paid for by it may stay, where the rest is a passage by itself
            assert whole or rest >= 49 and any(high - low >= rest for low, high, _ in found), (n, at, gone, new)
        else:
            least[False] += 1
            assert not whole, (n, at, gone, new)
        assert all(s >= 0.75 for _, _, s in found)
    assert min(least.values()) > 20


def test_one_word_changed_anywhere_in_a_passage(spark):
    """Every place of passages of 50 to 60 words, all in one table and by its keys."""
    r = random.Random(77)
    rows, expected = [], []
    for n in range(50, 61):
        for at in range(n):
            shared = prose(r, n)
            k = 2 * len(expected)
            rows.append((k, " ".join(prose(r, 15) + shared + prose(r, 15))))
            rows.append((k + 1, " ".join(prose(r, 25) + shared[:at] + ["changed"] + shared[at + 1 :] + prose(r, 20))))
            expected.append(k + 1)
    spans = passages.merged_spans(passages.repeated_passages(frame(spark, rows))).collect()
    assert sorted(s.doc_id for s in spans) == expected
    for s in spans:
        assert s.keeper == s.doc_id - 1 and s.n_words >= 49 and 25 <= s.start_word and s.start_word + s.n_words <= len(rows[s.doc_id][1].split()) - 20


def test_runs_of_frequent_tokens_are_found():
    r = random.Random(5)
    line = prose(r, 20)
    a, b = prose(r, 20) + line * 40 + prose(r, 20), prose(r, 30) + line * 30 + prose(r, 10)
    assert [(low, high) for low, high, _ in found_passages(a, b)] == [(20, 820)]
    assert {(low, high) for low, high, _ in found_passages(prose(r, 30) + line * 3 + prose(r, 30), b)} == {(30, 90)}
    assert not found_passages(prose(r, 30) + line * 2 + prose(r, 30), b)  # 40 words in a row


def test_passages_round_each_place_of_a_repeated_token(spark):
    r = random.Random(47)
    # one text has a part of the shared passage twice: once in other words, once in the passage
    shared = prose(r, 51)
    words = prose(r, 70)
    for c in range(0, 35, 7):
        words += shared[c : c + 16] + prose(r, 70)
    rows = [(0, " ".join(prose(r, 30) + shared + prose(r, 30))), (1, " ".join(words + shared + prose(r, 30)))]
    spans = passages.merged_spans(passages.repeated_passages(frame(spark, rows))).collect()
    assert [(s.doc_id, s.start_word, s.n_words, s.keeper) for s in spans] == [(1, len(words), 51, 0)]


def test_exact_passages_whose_parts_are_held_by_smaller_documents(spark):
    r = random.Random(61)
    # all keys of the passage stand in smaller documents, which overlap and don't hold it whole
    shared = prose(r, 70)
    rows = [(k, prose(r, 12) + shared[low : low + 32] + prose(r, 12)) for k, low in enumerate(range(0, 39, 4))]
    rows += [(100 + k, prose(r, 20) + shared + prose(r, 20)) for k in range(4)]
    spans = passages.merged_spans(passages.repeated_passages(frame(spark, [(i, " ".join(w)) for i, w in rows]))).collect()
    assert sorted((s.doc_id, s.start_word, s.n_words, s.keeper) for s in spans) == [(k, 20, 70, 100) for k in (101, 102, 103)]


def test_passages_beside_a_stock_line_and_in_chains(spark):
    r = random.Random(53)
    line = prose(r, 45)
    pairs = [prose(r, 8) for _ in range(30)]
    rows = [(k, prose(r, 30) + line + prose(r, 30)) for k in range(60)]
    for k in range(60):  # two documents each share the line and some words on one side
        more = pairs[k // 2]
        rows.append((100 + k, prose(r, 30) + (line + more if k % 4 < 2 else more + line) + prose(r, 30)))
    chain = prose(r, 90)
    for k in range(6):  # each is near to those before and after it only
        rows.append((300 + k, prose(r, 20) + chain + prose(r, 20)))
        chain = chain[:14 * k + 5] + prose(r, 1) + chain[14 * k + 6 : 14 * k + 11] + prose(r, 1) + chain[14 * k + 12 :]
    docs = frame(spark, [(i, " ".join(w)) for i, w in rows])
    spans = passages.merged_spans(passages.repeated_passages(docs)).collect()
    covered = {s.doc_id: set(range(s.start_word, s.start_word + s.n_words)) for s in spans}
    assert not {i for i in covered if i < 100}
    for i in range(101, 160, 2):
        place = 30
        assert set(range(place, place + 53)) <= covered.get(i, set()), i
    assert not {i for i in covered if i < 300} - set(range(101, 160, 2))
    assert {i for i in covered if i >= 300} == set(range(301, 306))


def test_passages_of_odd_rows(spark):
    long = " ".join(f"q{k}" for k in range(80))
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, long), (4, long), (5, "y " * 20_000), (6, "y " * 20_000), (7, "few words")]
    docs = frame(spark, rows)
    spans = passages.merged_spans(passages.repeated_passages(docs))
    assert sorted((s.doc_id, s.start_word, s.n_words, s.keeper) for s in spans.collect()) == [(4, 0, 80, 3), (6, 0, 20_000, 5)]
    kept = passages.without_repeats(docs, spans)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter({(1, None): 1, (2, ""): 1, (3, long): 2, (None, long): 1, (4, ""): 1, (5, "y " * 20_000): 1, (6, ""): 1, (7, "few words"): 1})
    assert passages.merged_spans(passages.repeated_passages(frame(spark, []))).count() == 0


def test_documents_without_repeated_passages(spark):
    r = random.Random(71)
    shared = prose(r, 60)
    rows = [(1, " ".join(prose(r, 20) + shared)), (2, " ".join(shared)), (3, " ".join(shared + prose(r, 30))), (4, None), (5, ""), (6, "few words"), (None, " ".join(shared)), (3, " ".join(prose(r, 70)))]
    docs = frame(spark, rows)
    found = passages.without_repeated_passages(docs)
    assert found.columns == docs.columns
    texts = sorted(((x.doc_id, x.text, x.n_chars) for x in found.collect()), key=repr)
    left = " ".join(rows[2][1].split()[60:])
    expected = [rows[0], (3, left), *rows[3:]]
    assert texts == sorted(((i, t, None if t is None else len(t)) for i, t in expected), key=repr)
    assert passages.without_repeated_passages(docs.limit(0)).count() == 0


def test_compact_windows_are_those_of_the_definition():
    r = np.random.default_rng(1)
    tokens, bounds, width = r.integers(0, 60, 300).astype(np.uint64), np.array([0, 100, 100, 300]), 10
    value = (setsketch.mix(tokens ^ passages.SEEDS[0]) & ~passages._PLACE) | np.arange(300, dtype=np.uint64)
    expected = []
    for low, high in ((0, 100), (100, 300)):
        for c in range(low, high):
            left = c
            while left > low and value[left - 1] > value[c]:
                left -= 1
            right = c
            while right < high - 1 and value[right + 1] > value[c]:
                right += 1
            if right - left + 1 >= width:
                expected.append((c, left, right))
    assert list(zip(*(x.tolist() for x in passages.compact_windows(tokens, bounds, passages.SEEDS[0], width)), strict=True)) == expected


def test_blocks_of_markup():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class="nav-open"><header>top</header><!-- a > b -->
    <nav><ul><li>menu<li>more</ul></nav><div id="cookie-notice">cookies</div><aside>side</aside><form>search</form>
    <div class="post"><h2>Fish &amp; chips &#233;&nbsp;!</h2><p>First <em>para</em>graph
    here<br>on<p>Second <a href="x>y">link</a></div><div class="comments"><p>first!</p></div><script>if (a < b) "</p>"</script>tail<footer>end</footer></body></html>"""
    assert html_main.page_blocks(page) == [("Fish & chips é !", 1), ("First paragraph here on", 1), ("Second link", 1), ("tail", 1)]
    assert html_main.page_blocks("<p>a <b>b<p>c</p>d") == [("a b", 1), ("c", 1), ("d", 1)]
    assert html_main.page_blocks("just text < 3") == [("just text < 3", 1)]
    assert html_main.page_blocks("<script>never closed") == []


@pytest.mark.parametrize(
    "page, texts",
    [
        ('<div class="content no-sidebar"><article><p>x y</p></article></div>', ["x y"]),
        ('<main><div class="post comment-free"><p>text</p></div></main>', ["text"]),
        ('<form id="aspnetForm"><article><p>all of it</p></article></form>', ["all of it"]),
        ('<form id="aspnetForm"><p>all of it</p></form>', ["all of it"]),
        ('<article><p>a</p><p class="share-price">12</p><p class="teaser">lead</p></article>', ["a", "12", "lead"]),
        ('<p title="hidden">t</p><p data-hidden="x">u</p><p hidden>no</p><p aria-hidden=TRUE>no</p>', ["t", "u"]),
        ('<article><p>a text</p><div class="comments"><p>many</p><p>more words than the article</p></div><div class="ad">buy</div><div id=cookie-notice>c</div></article>', ["a text"]),
        ("<p title='a > b'>x</p><a title=\"never closed><p>y</p>", ["x", "y"]),
        ("<p>1 < 2 > 0</p><p>a<b", ["1 < 2 > 0", "a<b"]),
        ("<div class='site-footer share-buttons'>f</div><div class='navigation-guide'>how ships find their way</div>", ["how ships find their way"]),
    ],
)
def test_only_what_is_no_article_text_goes(page, texts):
    assert [t for t, _ in html_main.page_blocks(page)] == texts


@pytest.mark.parametrize("piece", ["<a ", "<a>", '<a b="', "<a b='", "<div>", "<p><b>", "</p>", "<", "<div class=ad>x", "<!--", "<script>", "<b><i></b>", "<a =", "&amp", "<a b=' c=\"", "</div", "<a  /  "])
@pytest.mark.parametrize("end", ["", ">", "'>", '">'])
def test_broken_markup_takes_time_in_proportion(piece, end):
    started = time.process_time()
    html_main.page_blocks(piece * (1_000_000 // len(piece) // 4) + end)
    assert time.process_time() - started < 8


def test_repeated_runs_are_removed_from_distinct_pages(spark):
    r = random.Random(6)
    line = " ".join(prose(r, 14))
    rows, expected = [], {}
    for k in range(30):
        own = " ".join(prose(r, 40))
        rows.append((k, "http://h.example/a", f"<p>{line}</p><p>{own}</p>", "x", 1))
        expected[k] = own
    article = " ".join(prose(r, 50))
    for k in (40, 41):  # one article on two pages
        rows.append((k, "http://h.example/b", f"<nav>{k}</nav><article><h1>T</h1><p>{article}</p></article><p>{line}</p>", "x", 1))
        expected[k] = f"T\n\n{article}"
    rows += [(50, "http://h.example/c", None, "x", 1), (51, None, "", "x", 1), (None, "::bad", "<p>text</p>", "x", 1), (52, "http://other/", f"<p>{line}</p>", "x", 1), (53, "http://h.example/d", "<p>z</p>" * 5000, "x", 1)]
    expected |= {50: "", 51: "", None: "text", 52: line, 53: "\n\n".join(["z"] * 5000)}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, salt int")
    found = html_main.main_text(pages).collect()
    texts = {x.page_id: x.text for x in found}
    assert len(found) == len(rows) and all(x.n_chars == len(x.text) for x in found)
    assert {k: texts[k] for k in expected if k != 53} == {k: v for k, v in expected.items() if k != 53}
    assert html_main.main_text(pages.limit(0)).count() == 0
    few = {x.page_id: x.text for x in html_main.main_text(pages, group=8).collect()}
    assert all(few[k] == expected[k] for k in (40, 41, 50, 51))


def test_runs_repeat_over_a_whole_host(spark):
    r = random.Random(61)
    notice, menu = " ".join(prose(r, 12)), " ".join(prose(r, 10))
    rows, expected = [], {}
    for k in range(120):
        own = "</p><p>".join(" ".join(prose(r, 30)) for _ in range(3))
        rows.append((k, "http://h.example/a", "".join(f"<p>{t}</p>" for t in ([notice] if k in (7, 93) else []) + ([menu] if k % 40 == 0 else []) + [own])))
        expected[k] = own.replace("</p><p>", "\n\n")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for group in (400, 20):
        assert {x.page_id: x.text for x in html_main.main_text(pages, group=group).collect()} == expected


def test_articles_on_several_pages_stay(spark):
    r = random.Random(62)
    line = " ".join(prose(r, 12))
    parts = [" ".join(prose(r, n)) for n in (40, 35, 30)]
    plain, text = "".join(f"<p>{p}</p>" for p in parts), "\n\n".join(parts)
    rows = [(k, f"<p>{line}</p>{plain}<p>print {k}</p>") for k in range(2)] + [(2, f"<article>{plain}</article><div>more</div>")]
    rows += [(k, f"<p>{line}</p><p>{' '.join(prose(r, 60))}</p>") for k in range(3, 8)]
    rows.append((8, f"<div>{parts[1]}</div>" + "".join(f"<div>{' '.join(prose(r, 45))}</div>" for _ in range(4))))  # an index page's teaser
    pages = spark.createDataFrame([(k, "http://h.example/a", h) for k, h in rows], "page_id long, url string, html string")
    for group in (400, 4):
        found = {x.page_id: x.text for x in html_main.main_text(pages, group=group).collect()}
        assert found[2] == text
        assert [found[k] for k in (0, 1)] == [f"{text}\n\nprint {k}" for k in (0, 1)]
        assert not any(line in found[k] for k in range(8))


def test_repeated_tokens_against_all_pairs():
    r = np.random.default_rng(8)
    for _ in range(20):
        sizes = r.integers(0, 40, 6)
        tokens = r.integers(0, 3, sizes.sum()).astype(np.uint64)
        page = np.repeat(np.arange(6), sizes)
        outside = r.random(len(tokens)) < 0.5
        runs = {}
        for i in range(len(tokens) - 7):
            if page[i] == page[i + 7]:
                runs.setdefault(tuple(tokens[i : i + 8]), []).append(i)
        expected = np.zeros(len(tokens), bool)
        for places in runs.values():
            if len({page[i] for i in places}) > 1 and any(outside[i] for i in places):
                for i in places:
                    expected[i : i + 8] = True
        assert (html_main.repeated_tokens(tokens, page, outside) == expected).all()


def test_archives_round_trip(spark):
    trap = "x" * 5000 + "\r\n\r\nWARC/1.1\r\n\r\n\né漢\r"
    rows = [(1, "http://a/\r\nWARC-Type: fake", None), (2, None, trap), (3, "u", trap), (None, "u", trap), (4, "v", "é" * 3333 + "\n"), (4, "v", "é" * 3333 + "\n"), (5, "w", "\n"), (6, "w", "small"), (7, "w", "small"), (8, "w", "\x00\x01\x7f" * 900), (9, "w", "z\n" * 100_000)]
    pages = spark.createDataFrame([(*x, "d", 1, 2) for x in rows], "page_id long, url string, html string, digest string, size int, chunk int")
    for size in (1000, 1 << 20):
        found = Counter(tuple(r) for r in warc.round_trip(pages, size=size).collect())
        expected = Counter()
        for page_id, _, text in rows:
            data = (text or "").encode()
            refers = 3 if text == trap and page_id != 3 else None
            expected[(page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers)] += 1
        assert found == expected
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_broken_archives_fail():
    reader = warc.Reader()
    with pytest.raises(ValueError, match="no record begins"):
        list(reader.line(b"HTTP/1.1 200 OK"))


@pytest.mark.parametrize("part", [1 << 16, 40])
def test_top_k_is_exact(spark, monkeypatch, part):
    monkeypatch.setattr(hamming_search, "PART", part)
    monkeypatch.setattr(hamming_search, "BLOCK", 4)
    r = random.Random(12)
    centres = [r.getrandbits(64) for _ in range(5)]
    codes = [c ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for c in centres for _ in range(40)] + [centres[0]] * 60 + [r.getrandbits(64) for _ in range(100)]
    rows = [(k, c - (1 << 64) if c >> 63 else c) for k, c in enumerate(codes)]
    asked = [x for x in rows if x[0] % 23 == 0]
    frame_of = lambda x: spark.createDataFrame([(*y, "n", 1) for y in x], "id long, code long, n string, query int")
    found = sorted(tuple(x) for x in hamming_search.top_k(frame_of(rows), frame_of(asked), 7).collect())
    expected = []
    for i, code in asked:
        near = sorted(((code ^ c) & ((1 << 64) - 1)).bit_count() * 10**6 + j for j, c in rows)[:7]
        expected += [(i, k + 1, x % 10**6, x // 10**6) for k, x in enumerate(near)]
    assert found == sorted(expected)


def test_radii_grow_as_far_as_the_kth_neighbour_needs():
    r = np.random.default_rng(3)
    codes = r.integers(0, 1 << 64, 4000, dtype=np.uint64)
    near = codes[:50] ^ (np.uint64(1) << r.integers(0, 64, 50, dtype=np.uint64))
    index = hamming_search.SegmentIndex(np.concatenate([codes, near]))
    least = np.arange(len(index.codes))
    for q in codes[:50]:
        before = index.verified
        places, distances = index.nearest(q, 2, least)
        assert distances.tolist() == [0, 1] and index.verified - before < 200  # radius 0 covers a distance of 1
    for q in r.integers(0, 1 << 64, 20, dtype=np.uint64):
        places, distances = index.nearest(q, 10, least)
        far = np.bitwise_count(index.codes ^ q)
        expected = np.lexsort((least, far))[:10]
        assert places.tolist() == expected.tolist() and distances.tolist() == far[expected].tolist()


def test_codes_and_small_searches(spark):
    rows = [(1, [0.5, -1.0, None, float("nan"), 2.0]), (2, None), (3, []), (None, [1.0]), (4, [-1.0] * 63 + [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    codes = hamming_search.sign_codes(vectors)
    assert {(r.id, r.code) for r in codes.collect()} == {(1, 0b10001), (4, -(1 << 63))}
    assert sorted(tuple(r) for r in hamming_search.top_k(codes, codes.where("id = 1")).collect()) == [(1, 1, 1, 0), (1, 2, 4, 3)]
    assert hamming_search.top_k(codes.limit(0), codes.limit(0)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        hamming_search.sign_codes(spark.createDataFrame([(1, [1.0] * 65)], "vec_id long, embedding array<float>")).collect()


def test_pipeline_stages_keep_columns_and_clean_documents(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()} if k < 4 else None
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns
        if name == "near duplicates":
            component, _ = brute_components(sorted(before.items()))
            assert sorted(r.doc_id for r in docs.collect()) == sorted({*component.values()})
        if name == "substring dedup":
            seen = set()
            for doc_id, text in sorted((r.doc_id, r.text) for r in docs.collect()):
                w = words_of(text)
                grams = {tuple(w[k : k + 50]) for k in range(len(w) - 49)}
                assert not grams & seen, doc_id
                seen |= grams
                assert not set(w) - set(words_of(rows[doc_id]))
    found = docs.collect()
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(docs.columns)
    assert sum(r.length for r in found if r.start == 0) and all(r.offset + r.length <= 2048 for r in found)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() == 0


def test_pipeline_keeps_clean_documents_and_meets_the_mixture(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    corpus_pipeline.quality_stage(spark, docs, folder).write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    taken = corpus_pipeline.mixing_stage(spark, kept, folder)
    assert taken.columns == kept.columns
    copies = Counter(r.doc_id for r in taken.select("doc_id").collect())
    words = {r.doc_id: len(words_of(r.text)) for r in kept.collect()}
    domain = {r.doc_id: r.domain for r in labels.withColumn("domain", mixing.domain_of_labels()).collect()}
    clean = {i for i in words if domain.get(i) == 0}
    gone = {i for i in clean if not copies[i]}
    assert len(gone) <= 0.01 * len(clean), (len(gone), len(clean))
    # by the posteriors, as targets are; and by the domains that documents are mostly of
    model = mixing.fitted_model(docs, labels)
    share, mostly = np.zeros(3), np.zeros(3)
    for r in mixing.posteriors(kept, model).collect():
        share += copies[r.doc_id] * r.tokens * np.array(r.posterior)
        mostly[int(np.argmax(r.posterior))] += copies[r.doc_id] * r.tokens
    share, mostly = share / share.sum(), mostly / mostly.sum()
    print("clean", len(clean), "gone", len(gone), "share", share, "mostly", mostly, "rows", kept.count(), copies.total())
    assert abs(share[2] - mixing.TARGETS["toxic"]) < 0.02 and share[1] <= mixing.TARGETS["poor"] + 0.01
    assert abs(mostly[2] - mixing.TARGETS["toxic"]) < 0.04


def test_a_group_of_few_documents_is_paired_without_its_tokens(spark):
    # many windows of one key in three documents; their texts aren't needed
    members = spark.createDataFrame([(1, u, 1, c, 60) for u in (1, 2, 3) for c in range(20)], "key long, u long, v long, centre int, n long")
    still = spark.createDataFrame([(3, 7), (3, 8)], "u long, centre int")
    documents = spark.createDataFrame([(u, None) for u in (1, 2, 3)], "doc_id long, text string")
    assert sorted(tuple(r)[:2] for r in passages.others_of_groups(still, members, documents).collect()) == [(3, 1), (3, 2)]


@pytest.mark.parametrize("family", [150])
def test_near_passages_whose_every_token_is_in_many_documents(spark, family):
    """A document of smaller id holds part of the passage; of the others each has another word changed."""
    r = random.Random(family)
    shared = prose(r, 64)
    rows = [(0, " ".join(prose(r, 30) + shared[:36] + prose(r, 30))), (1, " ".join(prose(r, 30) + shared[28:] + prose(r, 30)))]
    for k in range(family):
        at = 8 + 48 * k // family
        rows.append((10 + k, " ".join(prose(r, 20) + shared[:at] + prose(r, 1) + shared[at + 1 :] + prose(r, 20))))
    spans = passages.merged_spans(passages.repeated_passages(frame(spark, rows))).collect()
    expected = {}
    for i, text in rows:
        own = text.split()[20:84]
        if i > 10 and any(similar(own, other.split()[20:84]) >= 0.75 for j, other in rows if 10 <= j < i):
            expected[i] = range(20, 84)
    assert len(expected) == family - 1
    found = {s.doc_id: s for s in spans}
    assert found.keys() == expected.keys()
    assert all(s.n_words >= 49 and s.start_word >= 20 and s.start_word + s.n_words <= 84 for s in spans)


def test_what_a_gap_costs_is_never_more_than_a_passage_pays():
    r = random.Random(12)
    for _ in range(300):
        text = [r.choice("abc") if r.random() < 0.3 else f"w{r.random()}" for _ in range(40)]
        at, gone, new = r.randint(12, 20), r.randint(0, 8), r.randint(0, 8)
        other = text[:at] + prose(r, new) + text[at + gone :]
        hashes = np.array([hash(w) % (1 << 31) for w in text], np.int32)
        held = hashes[np.arange(len(text) - 4)[:, None] + np.arange(5)]
        there = {tuple(other[k : k + 5]) for k in range(len(other) - 4)}
        equal = np.array([tuple(text[k : k + 5]) in there for k in range(len(text) - 4)])
        gaps = np.flatnonzero(~equal)
        if not len(gaps) or equal[gaps[0] : gaps[-1]].any():
            continue
        low, high = gaps[0], gaps[-1] + 1
        here, beyond = high - low, high - low + len(other) - len(text)
        assert passages.bridged((0, low, held[:low]), (high, len(held), held[high:])) <= 3 * (here + max(beyond, 0))


def test_only_texts_of_concerned_documents_are_moved(spark):
    docs = frame(spark, [*((i, f"w{i} " * 60) for i in range(-500, 3000)), (7, "again"), (None, "no id")])
    ids = spark.createDataFrame([(i,) for i in (-500, 7, 7, 2999, 1 << 40)], "doc_id long")
    found = passages.rows_of(docs, ids)
    assert found.columns == docs.columns
    rows = Counter(r.doc_id for r in found.collect())
    assert {-500: 1, 7: 2, 2999: 1}.items() <= rows.items() and rows.total() < 20
    assert passages.rows_of(docs, ids.limit(0)).count() == 0
    # rows without a span take no part in a join, and stay
    key = passages.word_keys(docs).where("doc_id = 2999").first().words_key
    spans = spark.createDataFrame([(2999, key, 0, 60, 1, 1.0)], passages.SPANS)
    kept = passages.without_repeats(docs, spans)
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((r.doc_id, "" if r.doc_id == 2999 else r.text) for r in docs.collect())
    assert passages.without_repeats(docs, spans, drop_emptied=True).count() == docs.count() - 1


def test_equal_runs_of_a_large_host_meet_in_one_suffix_array():
    r = np.random.default_rng(9)
    for _ in range(20):
        sizes = r.integers(0, 40, 6)
        tokens, page = r.integers(0, 3, sizes.sum()).astype(np.uint64), np.repeat(np.arange(6), sizes)
        anchor, first, end = html_main.stretches(tokens, page)
        runs, at = {}, []
        for a, i, j in zip(anchor.tolist(), first.tolist(), end.tolist(), strict=True):
            assert page[i] == page[j - 1]
            for k in range(i, j - 7):
                at.append(k)
                assert runs.setdefault(tuple(tokens[k : k + 8]), a) == a
        assert at == [k for k in range(len(tokens) - 7) if page[k] == page[k + 7]]
