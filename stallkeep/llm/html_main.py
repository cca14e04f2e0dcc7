"""Main text of web pages: blocks of markup, then a suffix array per host.

1. Each page's markup becomes blocks of text in order, each marked by where it
   stands: in the page's declared main element, in an element that is never
   article text (menus, headers, footers, asides, scripts, styles, hidden ones), or
   neither. Forms, and elements whose class, id or role names an advert, a notice
   and the like in whole words, are dropped too, unless they hold most of the page's
   text but its comments; comments are dropped unless they are all its text.
2. A page that declares a main element is that element, whole.
3. In other pages, blocks that repeated runs cover for the most part are
   boilerplate, and unique runs stay. A run of `RUN` tokens or more is repeated if it
   stands on pages of three different articles of the host, or on two if its block is
   short against the page, and at one place outside a declared main element. Pages
   are of one article if they have the same longest blocks (`article_of`): an article
   on several pages of a host stays on all of them.
   A host's token streams are joined and their suffixes sorted (by prefix doubling,
   as far as `RUN` tokens). The suffixes of a host of more than `GROUP` pages are dealt to
   several such arrays: each run has an anchor, the least hash of `GRAM` tokens in a row, and equal
   runs meet by it, with the same results. Only hosts with a page that
   declares nothing are counted; pages of other hosts are done by themselves.
4. What stays is joined in page order.

The markup is scanned once: a text of unclosed tags, quotes or elements takes time in
proportion to its length.

Defined results: a null or empty page, and one of boilerplate alone, gives an
empty text. Rows with a null or repeated id or address are extracted one by one;
equal pages count as one in step 3. A page without a host is grouped with its
like. Unclosed elements end where their parent does; what is after a "<" that no ">" follows
is text. Other columns are ignored.
"""

from __future__ import annotations

import html
import re

from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.llm.bytetext import mix, per_text, words
from stallkeep.session import stored

#: Tokens whose hash may be a run's anchor.
GRAM = 4
#: Tokens of the shortest run that counts, pages of a host that one task takes, share of a block in repeated runs, and of a page in a short block.
RUN = 8
GROUP = 400
COVER = 0.6
SHORT = 0.2
SCHEMA = "page_id long, url string, text string, n_chars long"

# Elements by their role in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math object canvas select".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
OUTSIDE = set("nav header footer aside button head menu dialog".split())
OUTSIDE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of a class or id that name what is not article text, those that name comments, and those that only say where or how.
OUTSIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar aside widget widgets footer header masthead topbar toolbar share sharing social related recommended toc".split()
)
COMMENT_WORDS = set("comment comments disqus reply replies respond".split())
PLACE_WORDS = set("site page main top bottom left right area box bar block section container wrapper wrap inner outer list item items link links button buttons content panel slot unit".split())
#: Of the first, words that also name parts of an article.
OF_ARTICLES = {"header", "toc", "notice", "promotion", "alert", "social"}
CLOSES = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]*)(\s*=\s*)?")
UNQUOTED = re.compile(r"[^\s>]*")
PARTS = re.compile(r"[^-_]+")
WHITE = re.compile(r"\s+")
INSIDE_MAIN, NEUTRAL, OUT = 2, 1, 0
FORM, NAMED, COMMENTS = "form", "named", "comments"


class Scanner:
    """Tags of a page from left to right, each character looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page = page
        self.quotes = {'"': True, "'": True}  # whether one may still follow

    def attributes(self, at: int) -> tuple[int, dict[str, str]]:
        """(end of the tag, its attributes) from a place after its name; there is a ">" behind it."""
        page, n, found = self.page, len(self.page), {}
        first = page.find(">", at)
        inner = page[at:first]
        if "=" not in inner:
            return first + 1, {name.lower(): "" for name in inner.replace("/", " ").split()}
        while at < n:
            part = ATTRIBUTE.match(page, at)
            name, at = part.group(1).lower(), part.end()
            if at >= n:
                break
            value = ""
            if part.group(2):
                quote = page[at]
                if quote in self.quotes:
                    close = page.find(quote, at + 1) if self.quotes[quote] else -1
                    if close < 0:  # never closed: the tag ends at the next ">"
                        self.quotes[quote] = False
                        return page.find(">", at) + 1 or n, found
                    value, at = page[at + 1 : close], close + 1
                else:
                    bare = UNQUOTED.match(page, at)
                    value, at = bare.group(), bare.end()
            elif at < n and page[at] == ">":
                if name:
                    found.setdefault(name, "")
                return at + 1, found
            if name:
                found.setdefault(name, value)
            if at < n and page[at] == ">":
                return at + 1, found
        return first + 1, found


def _names(value: str, inside_main: bool) -> str | None:
    """What a class or id names, by its whole words: comments, other text outside an article, or nothing known."""
    for word in value.lower().split():
        parts = set(PARTS.findall(word))
        if parts & COMMENT_WORDS and parts <= COMMENT_WORDS | PLACE_WORDS:
            return COMMENTS
        known = OUTSIDE_WORDS - OF_ARTICLES if inside_main else OUTSIDE_WORDS
        if parts & known and parts <= OUTSIDE_WORDS | PLACE_WORDS:
            return NAMED
    return None


def _place(tag: str, attributes: dict[str, str], parent: int) -> tuple[int, str | None]:
    """(place, why it may be dropped as a whole) of an element."""
    if parent == OUT or tag in RAW:
        return OUT, None
    if tag in OUTSIDE and not (tag == "header" and parent == INSIDE_MAIN):
        return OUT, None
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return OUT, None
    role = attributes.get("role", "").strip().lower()
    if tag in ("article", "main") or role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody":
        return INSIDE_MAIN, None
    if role in OUTSIDE_ROLES:
        return parent, FORM if role in ("form", "search") else NAMED
    if tag == "form":
        return parent, FORM
    if tag not in ("html", "body"):
        for name in ("class", "id"):
            if name in attributes and (why := _names(attributes[name], parent == INSIDE_MAIN)):
                return parent, why
    return parent, None


class Blocks:
    """The blocks of a page while its tags are read."""

    def __init__(self) -> None:
        self.found: list[tuple[str, int, int]] = []  # text, place, innermost suspect
        self.parts: list[str] = []
        self.stack: list[tuple[str, int, int]] = []  # tag, place, innermost suspect
        self.at: dict[str, list[int]] = {}  # places in the stack, by tag
        self.block_at: list[int] = []
        self.place, self.suspect = NEUTRAL, -1
        self.suspects: list[list] = []  # why, the suspect round it, characters but those of comments, and of all

    def end(self) -> None:
        """End the block that is open."""
        if self.parts:
            if self.place != OUT:
                text = WHITE.sub(" ", html.unescape("".join(self.parts))).strip()
                if text:
                    self.found.append((text, self.place, self.suspect))
            self.parts.clear()

    def push(self, tag: str, place: int, suspect: int) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS:
            self.block_at.append(len(self.stack))
        self.stack.append((tag, place, suspect))

    def cut(self, size: int) -> None:
        """Take all elements above the first `size` off the stack."""
        while len(self.stack) > size:
            tag = self.stack.pop()[0]
            self.at[tag].pop()
            if tag in BLOCKS:
                self.block_at.pop()

    def last(self, tag: str) -> int:
        """Where the innermost open element of a tag stands, or -1."""
        places = self.at.get(tag)
        return places[-1] if places else -1

    def settle(self) -> None:
        """Go on where the stack is now."""
        _, place, suspect = self.stack[-1] if self.stack else ("", NEUTRAL, -1)
        if (place, suspect) != (self.place, self.suspect):
            self.end()
            self.place, self.suspect = place, suspect

    def open(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in BLOCKS:
            self.end()
            while self.stack and tag in CLOSES.get(self.stack[-1][0], ()):
                self.cut(len(self.stack) - 1)
            p = self.last("p")
            if p >= 0 and self.block_at[-1] == p and tag in CLOSES["p"]:  # an inline element left open in a paragraph
                self.cut(p)
            self.settle()
        if tag in VOID:
            return
        place, why = _place(tag, attributes, self.place)
        suspect = self.suspect
        if why:
            suspect = len(self.suspects)
            self.suspects.append([why, self.suspect, 0, 0])
        self.push(tag, place, suspect)
        self.settle()

    def close(self, tag: str) -> None:
        k = self.last(tag)
        if k < 0:
            if tag == "p":
                self.end()
            return
        if self.block_at and self.block_at[-1] >= k:
            self.end()
        self.cut(k)
        self.settle()

    def kept(self) -> list[tuple[str, int]]:
        """(text, place) of the blocks that are in no dropped element."""
        total = everything = 0
        for text, _, suspect in self.found:
            everything += len(text)
            if suspect >= 0:
                self.suspects[suspect][2] += len(text)
                self.suspects[suspect][3] += len(text)
            else:
                total += len(text)
        for k in range(len(self.suspects) - 1, -1, -1):  # inner ones have greater numbers
            why, outer, size, whole = self.suspects[k]
            if why == COMMENTS:
                size = 0
            if outer >= 0:
                self.suspects[outer][2] += size
                self.suspects[outer][3] += whole
            else:
                total += size
        gone: list[bool] = []
        for why, outer, size, whole in self.suspects:
            most = whole == everything if why == COMMENTS else 2 * size > total
            gone.append(outer >= 0 and gone[outer] or not most)
        return [(text, place) for text, place, suspect in self.found if suspect < 0 or not gone[suspect]]


def page_blocks(page: str) -> list[tuple[str, int]]:
    """(text, place) of the blocks of a page, in order, references decoded and white space folded."""
    blocks, scanner, at, n = Blocks(), Scanner(page), 0, len(page)
    last = page.rfind(">")
    while at < n:
        start = page.find("<", at)
        if start < 0 or start > last:
            blocks.parts.append(page[at:])
            break
        if start > at:
            blocks.parts.append(page[at:start])
        following = page[start + 1 : start + 2]
        if following in ("!", "?"):
            opening, closing = next(((o, c) for o, c in (("<!--", "-->"), ("<![CDATA[", "]]>")) if page.startswith(o, start)), ("<" + following, ">"))
            close = page.find(closing, start + len(opening))
            at = n if close < 0 else close + len(closing)
            continue
        slash = following == "/"
        name = NAME.match(page, start + 1 + slash)
        if name is None:
            blocks.parts.append("<")
            at = start + 1
            continue
        tag = name.group().lower()
        at, attributes = scanner.attributes(name.end())
        if slash:
            blocks.close(tag)
        elif tag == "br":
            blocks.parts.append(" ")
        elif tag in RAW:  # its content is no markup
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else n
        else:
            blocks.open(tag, attributes)
    blocks.end()
    return blocks.kept()


def repeated_tokens(tokens: np.ndarray, page: np.ndarray, outside: np.ndarray, run: int = RUN, pages: int = 2, part: np.ndarray | None = None) -> np.ndarray:
    """Whether each token lies in a run of at least `run` tokens that occurs on `pages` pages and, somewhere, outside a main element.

    A run lies in one `part` (a page if none are given).

    Suffixes are ranked by their first 1, 2,
    4, ... tokens; equal rank at the end means a common prefix of `run` tokens.
    """
    n = len(tokens)
    covered = np.zeros(n, bool)
    if n < run:
        return covered
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    span = 1
    while span < run:
        step = min(span, run - span)
        later = np.zeros(n, np.int64)
        later[: n - step] = rank[step:]
        rank = np.unique(rank * (n + 2) + later, return_inverse=True)[1].astype(np.int64) + 1
        span += step
    start = np.arange(n - run + 1)
    part = page if part is None else part
    start = start[part[start] == part[start + run - 1]]
    order = start[np.lexsort((page[start], rank[start]))]
    value, owner = rank[order], page[order]
    same = value[1:] == value[:-1]
    group = np.concatenate([np.zeros(1, np.int64), np.cumsum(~same)]) if len(order) else np.zeros(0, np.int64)
    groups = int(group[-1]) + 1 if len(order) else 0
    several = 1 + np.bincount(group[1:][same & (owner[1:] != owner[:-1])], minlength=groups) >= pages
    plain = np.bincount(group, outside[order], groups) > 0
    return covered_by(order[(several & plain)[group]], n, run)


def covered_by(starts: np.ndarray, n: int, run: int = RUN) -> np.ndarray:
    """Whether each of n tokens lies in one of the runs that begin at `starts`."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + run, -1)
    return np.cumsum(edge[:n]) > 0


def article_of(keys: np.ndarray, sizes: np.ndarray) -> int:
    """What tells a page's article from others: its longest block, and the next if that is half as long at least."""
    if not len(keys):
        return 0
    order = np.lexsort((keys, -sizes))[:2]
    parts = keys[order] if len(order) > 1 and 2 * sizes[order[1]] >= sizes[order[0]] else keys[order[:1]]
    return int(mix(parts + np.arange(len(parts), dtype=np.uint64)).sum().view(np.int64))


def kept_text(blocks: list[tuple[str, int]], two: np.ndarray, three: np.ndarray, sizes: np.ndarray) -> str:
    """A page's text, by the share of each block that lies in runs of two and of three articles."""
    if any(p == INSIDE_MAIN for _, p in blocks):
        return "\n\n".join(t for t, p in blocks if p == INSIDE_MAIN)
    short = sizes <= SHORT * sizes.sum()
    dropped = (three >= COVER) | (two >= COVER) & short
    return "\n\n".join(t for (t, _), gone in zip(blocks, dropped.tolist(), strict=True) if not gone)


def tokens_of(pages: list[list[tuple[str, int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(tokens, tokens of each block, its place, first block of each page, its article) of pages."""
    flat = [block for blocks in pages for block in blocks]
    raw = [t.encode() for t, _ in flat]
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(r) for r in raw], dtype=np.int64)])
    found = words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    sizes = np.diff(found.bounds)
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(b) for b in pages], dtype=np.int64)])
    keys = mix(per_text(mix(found.hash), found.bounds) + sizes.astype(np.uint64))
    articles = [article_of(keys[i:j], sizes[i:j]) for i, j in zip(first[:-1], first[1:], strict=True)]
    return found.hash, sizes, np.array([p for _, p in flat], np.int64), first, articles


def main_texts(pages: list[list[tuple[str, int]]]) -> list[str]:
    """Texts of one host's pages, each given as its blocks."""
    content: dict[tuple, int] = {}
    owner = [content.setdefault(tuple(b), len(content)) for b in pages]
    distinct = [list(b) for b in content]
    tokens, sizes, place, first, articles = tokens_of(distinct)
    block_page = np.repeat(np.arange(len(distinct)), np.diff(first))
    page = np.repeat(block_page, sizes)
    article = np.unique(articles, return_inverse=True)[1][page]
    outside = np.repeat(place != INSIDE_MAIN, sizes)
    shares = []
    for least in (2, 3):
        covered = repeated_tokens(tokens, article, outside, pages=least, part=page)
        shares.append(np.bincount(np.repeat(np.arange(len(sizes)), sizes), covered, len(sizes)) / np.maximum(sizes, 1))
    texts = [kept_text(b, shares[0][i:j], shares[1][i:j], sizes[i:j]) for b, i, j in zip(distinct, first[:-1], first[1:], strict=True)]
    return [texts[c] for c in owner]


def stretches(tokens: np.ndarray, text: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the anchor, first token, end) of the tokens of all runs in a row that have one anchor; `text` numbers the tokens' texts."""
    n = len(tokens) - run + 1
    start = np.flatnonzero(text[: max(n, 0)] == text[run - 1 :])
    if not len(start):
        return np.zeros(0, np.uint64), start, start
    grams = np.zeros(len(tokens) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        grams = mix(grams + tokens[k : k + len(grams)])
    anchor = np.lib.stride_tricks.sliding_window_view(grams, run - GRAM + 1).argmin(axis=1) + np.arange(n)
    new = np.concatenate([np.ones(1, bool), (np.diff(anchor[start]) != 0) | (np.diff(start) > 1)])
    first, last = start[new], start[np.concatenate([new[1:], np.ones(1, bool)])]
    return grams[anchor[first]], first, last + run


def repeated_places(rows: pd.DataFrame) -> pd.DataFrame:
    """(stretch, two, three): of the distinct stretches of a part of a host, the places in runs of two and of three articles, by one suffix array."""
    size = rows["tokens"].map(len).to_numpy()
    part = np.repeat(np.arange(len(rows)), size)
    tokens, outside = np.concatenate(rows["tokens"].to_list()).view(np.uint64), np.concatenate(rows["outside"].to_list()).astype(bool)
    article, ends, places = np.unique(rows["article"], return_inverse=True)[1][part], np.cumsum(size), {}
    for least, name in ((2, "two"), (3, "three")):
        covered = repeated_tokens(tokens, article, outside, pages=least, part=part)
        places[name] = [np.flatnonzero(covered[end - n : end]) for end, n in zip(ends, size, strict=True)]
    found = rows[["stretch"]].assign(**places).drop_duplicates("stretch")
    return found[found["two"].map(len) > 0]


def texts_of_large_hosts(parsed: DataFrame) -> DataFrame:
    """Rows of `SCHEMA` of the pages asked for, as `main_texts` of each whole host gives them, for a stored table of parsed pages with the `parts` of their host.

    No task holds a host. Runs whose anchors stand in one article alone are left out; a host's others are dealt by
    their anchors to `parts` suffix arrays, which take of equal stretches those of three articles.
    """
    parsed = parsed.withColumn("content", F.xxhash64("blocks", "places")).withColumn("host", F.xxhash64("host"))

    def pages_of(batch: pa.RecordBatch) -> list[list[tuple[str, int]]]:
        return [list(zip(b, p, strict=True)) for b, p in zip(batch.column("blocks").to_pylist(), batch.column("places").to_pylist(), strict=True)]

    def found(batch: pa.RecordBatch):
        """(tokens, whether each is outside a main element, first of each page, articles, (page, anchor, first, end) of the stretches)."""
        tokens, sizes, place, first, articles = tokens_of(pages_of(batch))
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])[first]
        page = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        hashes, begin, end = stretches(tokens, page)
        page = page[begin]
        anchor = mix(hashes + batch.column("host").to_numpy().view(np.uint64)[page]).view(np.int64)
        return tokens, np.repeat(place != INSIDE_MAIN, sizes), bounds, np.array(articles, np.int64), (page, anchor, begin, end)

    def anchors(batches):
        for batch in batches:
            _, _, _, articles, (page, anchor, _, _) = found(batch)
            pairs = np.unique(np.stack([anchor, articles[page]]), axis=1)
            yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["anchor", "article"])

    def rows(batches):
        for batch in batches:
            tokens, outside, bounds, articles, (page, anchor, begin, end) = found(batch)
            size = end - begin
            offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
            at = np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])
            lists = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(x)) for x in (tokens[at].view(np.int64), outside[at])]
            own = [batch.column(c).take(pa.array(page)) for c in ("host", "parts", "content")]
            yield pa.record_batch([*own, pa.array(articles[page]), pa.array(anchor), pa.array(begin - bounds[page]), *lists], ["host", "parts", "content", "article", "anchor", "first", "tokens", "outside"])

    distinct = parsed.dropDuplicates(["host", "content"]).select("host", "parts", "content", "blocks", "places")
    distinct = stored(distinct, "contents")
    several = distinct.mapInArrow(anchors, "anchor long, article long").groupBy("anchor").agg(F.min("article").alias("least"), F.max("article").alias("most"))
    several = stored(several.where("least < most").select("anchor"), "several")
    schema = "host long, parts int, content long, article long, anchor long, first long, tokens array<long>, outside array<boolean>"
    cut = distinct.mapInArrow(rows, schema).join(several, "anchor", "left_semi")
    cut = stored(cut.withColumn("stretch", F.xxhash64("host", "tokens", "outside")), "stretches")
    of_articles = cut.select("host", "parts", "anchor", "stretch", "article", "tokens", "outside").dropDuplicates(["stretch", "article"])
    nth = F.row_number().over(Window.partitionBy("stretch").orderBy("article"))
    few = of_articles.withColumn("nth", nth).where("nth <= 3").withColumn("part", F.pmod("anchor", "parts"))
    places = few.groupBy("host", "part").applyInPandas(repeated_places, "stretch long, two array<long>, three array<long>")
    parsed = parsed.where("asked")
    asked = cut.select("host", "content", "stretch", "first").join(parsed.select("host", "content").distinct(), ["host", "content"])
    moved = [F.array_distinct(F.flatten(F.collect_list(F.transform(c, lambda k: k + F.col("first"))))).alias(c) for c in ("two", "three")]
    lists = asked.join(places, "stretch").groupBy("host", "content").agg(*moved)
    joined = parsed.join(lists, ["host", "content"], "left").select("page_id", "url", "blocks", "places", "two", "three")

    def extract(batches):
        for batch in batches:
            pages = pages_of(batch)
            tokens, sizes, _, first, _ = tokens_of(pages)
            bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
            texts = []
            for k, repeated in enumerate(zip(batch.column("two").to_pylist(), batch.column("three").to_pylist(), strict=True)):
                i, j, shares = first[k], first[k + 1], []
                for chosen in repeated:
                    covered = np.zeros(bounds[j] - bounds[i], bool)
                    covered[np.array(chosen or (), np.int64)] = True
                    shares.append(np.bincount(np.repeat(np.arange(j - i), sizes[i:j]), covered, j - i) / np.maximum(sizes[i:j], 1))
                texts.append(kept_text(pages[k], *shares, sizes[i:j]))
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(extract, SCHEMA)


def host(url: str | None) -> str:
    try:
        return (urlsplit(url).hostname or "") if url else ""
    except ValueError:
        return ""


def main_text(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """One row of `SCHEMA` per row of `pages` (page_id, url, html)."""

    def parse(batches):
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.slice(low, 500)
                found = [page_blocks(h) if h else [] for h in part.column("html").to_pylist()]
                yield pa.record_batch(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array([host(u) for u in part.column("url").to_pylist()], pa.string()),
                        pa.array([[t for t, _ in b] for b in found], pa.list_(pa.string())),
                        pa.array([[p for _, p in b] for b in found], pa.list_(pa.int32())),
                    ],
                    ["page_id", "url", "host", "blocks", "places"],
                )

    def extract(rows: pd.DataFrame) -> pd.DataFrame:
        texts = main_texts([list(zip(b, p.tolist(), strict=True)) for b, p in zip(rows["blocks"], rows["places"], strict=True)])
        found = pd.DataFrame({"page_id": rows["page_id"].astype("Int64"), "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]})
        return found[rows["asked"]]

    parsed = pages.select("page_id", "url", "html").mapInArrow(parse, "page_id long, url string, host string, blocks array<string>, places array<int>")
    by_itself = F.array_contains("places", INSIDE_MAIN) | (F.size("places") == 0)
    text = F.array_join(F.filter("blocks", lambda _, k: F.col("places")[k] == INSIDE_MAIN), "\n\n")
    done = parsed.where(by_itself).select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
    open_pages = stored(parsed.where(~by_itself), "open-pages")
    if open_pages.isEmpty():
        return done
    hosts = stored(open_pages.select("host").distinct(), "hosts")
    evidence = parsed.where(by_itself).join(hosts, "host", "left_semi")
    columns = ["page_id", "url", "host", "blocks", "places"]
    rows = stored(open_pages.select(*columns, F.lit(True).alias("asked")).union(evidence.select(*columns, F.lit(False))), "parsed")
    # a stored table has a true size: sent to the pages where it is small
    sizes = rows.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") > group)
    large = stored(sizes.select("host", F.ceil(F.col("pages") / group).cast("int").alias("parts")), "large-hosts")
    found = done.union(rows.join(large, "host", "left_anti").groupBy("host").applyInPandas(extract, SCHEMA))
    if large.isEmpty():
        return found
    return found.union(texts_of_large_hosts(stored(rows.join(large, "host"), "large")))
