"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct five-word shingles, A-Z lower-cased; a text of
fewer words is one shingle, one without a word the empty set. Two sets are linked
when 100 * intersection >= 75 * union; a component is all that links connect.

1. Each set's sketch is `REGISTERS` truncated minima of exponential variates,
   spaced by powers of `BASE`: registers of a union are the larger ones of its
   parts, and two sets agree in a register about as often as their similarity.
2. Equal sets become one class, with its smallest document id as representative.
   All that follows is on representatives.
3. Bands of `ROWS` register values are keys. Two sets of similarity 0.75 miss one
   another in all bands with probability 1e-6.
4. A candidate pair is first judged by its sketches: the similarity of largest
   likelihood given how many registers are smaller, equal and larger. Pairs more
   than five standard errors below the threshold go. The rest is confirmed on
   full sets, from whole texts.
5. No group's pairs are all written. Every set is tried against the smallest in
   any of its bands; then, where components still differ, against the smallest in
   each band. What then is still in different components of one band is tried in
   full: pair by pair in small bands, and among all members of large ones by the
   pairs that share a rare enough shingle (`rare_shingle_pairs`, which loses
   none). So no link that matters is lost.

Defined results: an empty set is linked with nothing, not even another empty one.
Rows with a null id are classed, but never represent a class that has an id; a
class without one has a null component and keeps all its rows. Repeated rows get
equal results, one row each. Rows that share an id but not a text are judged by
their texts, as one node where they represent their classes. Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallkeep.llm.bytetext import blocks, mix, per_text, sequence_hash, shingles, words
from stallkeep.llm.components import components
from stallkeep.session import stored

SHINGLE = 5
PERCENT = 75
#: Sketch: registers, those in a band, spacing, rate, and the largest value.
REGISTERS, ROWS = 144, 4
BASE, RATE, LARGEST = 1.001, 20.0, (1 << 16) - 1
#: Standard errors below the threshold at which an estimate rules a pair out.
ERRORS = 5
#: Members of a band up to which its pairs are written out.
SMALL_BAND = 8
SKETCH = "doc_id long, n_shingles long, key1 long, key2 long, registers binary"

_r = np.random.default_rng(75)
_FACTOR = _r.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _r.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, bounds) of each text."""
    found = words(data, offsets, lower=True)
    hashes, bounds = shingles(found, SHINGLE)
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    sizes = np.diff(found.bounds)
    few = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(few):
        whole = [sequence_hash(found.hash[found.bounds[k] : found.bounds[k + 1]]) for k in few.tolist()]
        hashes, of = np.concatenate([hashes, np.array(whole, np.uint64)]), np.concatenate([of, few])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.searchsorted(of[new], np.arange(len(bounds)))


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers of each set, 0 for the empty one."""
    out = np.zeros((len(bounds) - 1, REGISTERS), "<u2")
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    least = np.empty((len(full), REGISTERS), np.uint64)
    for k in range(REGISTERS):
        least[:, k] = np.minimum.reduceat(hashes * _FACTOR[k] + _SHIFT[k], bounds[full])
    share = (least.astype(np.float64) + 0.5) / 2.0**64
    value = np.floor(1 - np.log(-np.log1p(-share) / RATE) / np.log(BASE))
    out[full] = np.clip(value, 0, LARGEST).astype("<u2")
    return out


def likely_similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Similarity of largest likelihood for pairs of sketches of sets of known sizes, by golden section."""
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - larger - smaller
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        return larger * np.log(np.maximum(up, 1e-12)) + smaller * np.log(np.maximum(down, 1e-12)) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    ratio = (5**0.5 - 1) / 2
    for _ in range(30):
        x, y = high - ratio * (high - low), low + ratio * (high - low)
        left = likelihood(x) > likelihood(y)
        high, low = np.where(left, y, high), np.where(left, low, x)
    return (low + high) / 2


def sketches(documents: DataFrame) -> DataFrame:
    """One row of `SKETCH` per row of `documents` (doc_id, text). No shuffle."""

    def run(batches):
        for batch in batches:
            column, at = batch.column("text"), 0
            for first, stop, data, offsets in blocks(column):
                hashes, bounds = shingle_sets(data, offsets)
                keys = [per_text(mix(hashes ^ np.uint64(salt)), bounds).view(np.int64) for salt in (0x1234567, 0x7654321 << 20)]
                rows = registers(hashes, bounds)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(first, stop - first), pa.array(np.diff(bounds)), pa.array(keys[0]), pa.array(keys[1]), pa.array([r.tobytes() for r in rows], pa.binary())],
                    ["doc_id", "n_shingles", "key1", "key2", "registers"],
                )
                at = stop
            if at == 0:
                yield pa.record_batch([pa.array([], t) for t in (pa.int64(),) * 4 + (pa.binary(),)], ["doc_id", "n_shingles", "key1", "key2", "registers"])

    return documents.select("doc_id", "text").mapInArrow(run, SKETCH)


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (u, v) that their sizes and sketches don't rule out."""
    side = classes.select(F.col("rep"), F.col("n_shingles").alias("n"), "registers")
    both = pairs.join(side.select(F.col("rep").alias("u"), F.col("n").alias("n_u"), F.col("registers").alias("r_u")), "u")
    both = both.join(side.select(F.col("rep").alias("v"), F.col("n").alias("n_v"), F.col("registers").alias("r_v")), "v")
    both = both.where(100 * F.least("n_u", "n_v") >= PERCENT * F.greatest("n_u", "n_v"))
    threshold = PERCENT / 100
    floor = threshold - ERRORS * (threshold * (1 - threshold) / REGISTERS) ** 0.5

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("r_u", "r_v"))
            likely = likely_similarity(a, b, *(batch.column(c).to_numpy().astype(float) for c in ("n_u", "n_v"))) >= floor
            yield pa.record_batch([batch.column(c) for c in ("u", "v")], ["u", "v"]).filter(pa.array(likely))

    return both.mapInArrow(run, "u long, v long")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (u, v) whose full sets are linked. `texts`: (rep, text)."""
    both = pairs.join(texts.select(F.col("rep").alias("u"), F.col("text").alias("text_u")), "u")
    both = both.join(texts.select(F.col("rep").alias("v"), F.col("text").alias("text_v")), "v")

    def sets(column: pa.Array):
        for _, _, data, offsets in blocks(column):
            hashes, bounds = shingle_sets(data, offsets)
            for k in range(len(bounds) - 1):
                yield hashes[bounds[k] : bounds[k + 1]]

    def run(batches):
        for batch in batches:
            linked = []
            for a, b in zip(sets(batch.column("text_u")), sets(batch.column("text_v")), strict=True):
                common = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(common > 0 and 100 * common >= PERCENT * (len(a) + len(b) - common))
            yield pa.record_batch([batch.column(c) for c in ("u", "v")], ["u", "v"]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(run, "u long, v long")


def _linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    likely = stored(_likely(pairs, classes), "likely")
    return stored(_confirmed(likely, texts), "links")


def class_components(classes: DataFrame, documents: DataFrame) -> DataFrame:
    """(node, component) of representatives that are linked with another. `classes`: stored (rep, n_shingles, registers)."""
    usable = classes.where("n_shingles >= 3 AND rep IS NOT NULL")  # smaller sets are similar to equal ones only
    width = 2 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // ROWS - 1)), lambda b: F.xxhash64(b, F.substring(F.col("registers"), b * width + 1, F.lit(width))))
    bands = usable.select("rep", F.explode(keys).alias("key"))
    shared = stored(bands.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n"), "bands")
    members = stored(bands.join(shared, "key"), "members")
    wanted = stored(members.select("rep").distinct(), "wanted")
    texts = stored(documents.select(F.col("doc_id").alias("rep"), "text").join(wanted, "rep", "left_semi"), "texts")

    def known(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
        found = rows.join(labels.select(F.col("node").alias(column), F.col("component").alias(name)), column, "left")
        return found.withColumn(name, F.coalesce(name, column))

    def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
        """Labels after more links: components of components."""
        between = known(known(links, labels, "u", "a"), labels, "v", "b").select(F.col("a").alias("u"), F.col("b").alias("v"))
        joined = components(between)
        moved = labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("next")), "component", "left").select("node", F.coalesce("next", "component").alias("component"))
        return stored(moved.union(joined.join(labels, "node", "left_anti")), "labels")

    first = members.groupBy("rep").agg(F.min("leader").alias("leader")).where("leader < rep")
    tried = first.select(F.col("rep").alias("u"), F.col("leader").alias("v"))
    labels = stored(components(_linked(tried, classes, texts)), "labels")

    stars = members.where("leader < rep").select(F.col("rep").alias("u"), F.col("leader").alias("v")).distinct()
    open_stars = known(known(stars, labels, "u", "a"), labels, "v", "b").where("a <> b").select("u", "v").join(tried, ["u", "v"], "left_anti")
    labels = extended(labels, _linked(open_stars, classes, texts))

    labelled = known(members.select("key", "rep", "leader"), labels, "rep", "component")
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).where("low < high").select("key", "n")
    left = stored(labelled.join(mixed, "key"), "mixed")
    large = stored(left.groupBy("rep").agg(F.max("n").alias("most"), F.min("component").alias("component")).where(F.col("most") > SMALL_BAND).drop("most"), "large")
    small = left.where(F.col("n") <= SMALL_BAND).join(large.select("rep", F.lit(True).alias("large")), "rep", "left").fillna(False, ["large"])
    other = small.select("key", F.col("rep").alias("v"), F.col("component").alias("b"), F.col("large").alias("also"))
    rest = small.select("key", F.col("rep").alias("u"), F.col("component").alias("a"), "leader", "large").join(other, "key").where("a < b AND u <> leader AND v <> leader AND NOT (large AND also)").select("u", "v")
    pairs = rest.union(rare_shingle_pairs(texts.join(large, "rep")))
    return extended(labels, _linked(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), classes, texts))


def rare_shingle_pairs(texts: DataFrame) -> DataFrame:
    """Pairs (u, v) of different components among (rep, text, component) that can be linked at all.

    Of two linked sets of n and m shingles, each has one of the other's among its
    n - ceil(0.75 n) + 1 first, in whatever order all sets follow. With the rare
    ones first, a passage that many texts share brings no two of them together.
    What comes after the first shingle two sets share bounds their intersection,
    which rules out most of the pairs that do meet. Where many of one component meet, only the others are paired with all.
    """

    def run(batches):
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column("text")):
                hashes, bounds = shingle_sets(data, offsets)
                sizes = np.diff(bounds)
                at = pa.array(np.repeat(np.arange(first, stop), sizes))
                yield pa.record_batch([batch.column("rep").take(at), batch.column("component").take(at), pa.array(hashes.view(np.int64)), pa.array(np.repeat(sizes, sizes))], ["rep", "component", "shingle", "n"])

    tokens = stored(texts.select("rep", "component", "text").mapInArrow(run, "rep long, component long, shingle long, n long"), "shingles")
    often = tokens.groupBy("shingle").agg(F.count("*").alias("times"))
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("times", "shingle"))
    first = tokens.join(often, "shingle").withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)
    first = stored(first.where("times > 1").select("shingle", "rep", "component", "n", (F.col("n") - F.col("rank")).alias("after")), "rare")
    shares = first.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    main = shares.groupBy("shingle").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("components")).where("components > 1").drop("components")
    meeting = stored(first.join(main, "shingle"), "meeting")
    few = meeting.where("component <> main").select("shingle", F.col("rep").alias("u"), F.col("component").alias("a"), F.col("n").alias("n_u"), F.col("after").alias("after_u"))
    other = meeting.select("shingle", F.col("rep").alias("v"), F.col("component").alias("b"), "main", F.col("n").alias("n_v"), F.col("after").alias("after_v"))
    enough = (100 + PERCENT) * (1 + F.least("after_u", "after_v")) >= PERCENT * (F.col("n_u") + F.col("n_v"))
    return few.join(other, "shingle").where(F.expr("a <> b AND (b = main OR v < u)") & enough).select("u", "v").distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of `documents` (doc_id, text)."""
    documents = documents.select("doc_id", "text")
    table = stored(sketches(documents), "sketches")
    key = ["n_shingles", "key1", "key2"]
    grouped = table.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.min("registers").alias("registers"))
    classes = stored(grouped, "classes")
    found = class_components(classes, documents)
    named = classes.select(*key, "rep").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"))
    full = table.where("n_shingles > 0").select("doc_id", *key).join(stored(named, "named"), key)
    full = full.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    empty = table.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates among `documents` (doc_id, text, more): that of the smallest id.

    Texts without a word are no duplicates. Rows that repeat an id and its text stay once, those of
    one id and several texts by text; rows without an id stay once a text.
    """
    found = near_duplicates(documents).where("doc_id IS NOT NULL")
    # what goes, and what stands more than once: few, against all that stays
    marks = found.groupBy(F.col("doc_id").alias("__doc_id")).agg(F.max("kept").alias("__kept"), F.count("*").alias("__rows")).where("NOT __kept OR __rows > 1")
    marks = stored(marks, "marks")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    joined = documents.where("doc_id IS NOT NULL").join(marks, F.col("doc_id") == F.col("__doc_id"), "left")
    kept = joined.where("__kept IS NULL").select(*columns)
    if not marks.where("__kept").isEmpty():
        kept = kept.union(joined.where("__kept").select(*columns).dropDuplicates(["doc_id", "text"]))
    return kept.union(documents.where("doc_id IS NULL").dropDuplicates(["text"]))
