"""Near duplicates by BagMinHash signatures over multisets of word shingles.

A text is the multiset of its windows of five words; similarity is weighted Jaccard, the sum of
smaller counts over the sum of larger ones.

**Signature.**  A window that occurs ``c`` times covers the weights from 0 to ``c``.  Weights are
cut at 0, 1, 2, 4, 8, ...; each cut of a window has a Poisson process whose rate is its width and
whose points fall on the components of the signature at random.  In a cut that ``c`` ends in, a
point's place is found by halving the cut again and again, and it only counts below ``c``.  Each
component keeps its earliest point.  Two texts keep the same one with a probability that is their
weighted Jaccard.  A process is followed only up to the text's latest kept point, so the work is
about the number of windows plus ``m log m``, whatever the counts.

**Candidates.**  Six components make a band; texts that agree in a band share a bucket.  A bucket's
texts are compared with the one of them that meets most others, so a group of copies costs its size and not its square.
Where a bucket then still holds texts of several components, those are compared in blocks, and only links
leave a block.  So every two texts of a bucket are linked or have been compared.

**Verification.**  The overlap of two multisets is computed in full: of pairs from their sorted windows, in a
block for all its texts by products of incidence matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import Memo, grouped, slices, stored
from tillwright.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
SIZE = BANDS * ROWS
MEMO_WORDS = 200_000
#: Texts whose signatures are computed together.
TOGETHER = 100
#: Texts in a block (a task gets two), and columns of its incidence matrix that are worked on at a time.
BLOCK, COLUMNS = 512, 4096
#: Ids of at most this many rows (8 bytes each) are broadcast; more are shuffled.
BROADCAST_IDS = 1_000_000

_U = np.uint64
#: Odd multipliers that tell the places of a window apart.
_PLACES = [_U((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64) for k in range(WORDS)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that looks random (the finalizer of SplitMix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingles:
    """Windows of a text as 64-bit numbers with their counts."""

    def __init__(self, memo_words: int = MEMO_WORDS):
        self.memo = Memo(xxhash.xxh3_64_intdigest, memo_words)

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        size = len(words) - WORDS + 1
        if size < 1:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        hashes = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        total = np.zeros(size, np.uint64)
        for k, place in enumerate(_PLACES):
            total += _mix(hashes[k : k + size] + place)
            total *= place
        return np.unique(_mix(total), return_counts=True)


def similar(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], threshold: Fraction) -> bool:
    """Whether the weighted Jaccard of two multisets is at least ``threshold``."""
    total = int(a[1].sum() + b[1].sum())
    if min(a[1].sum(), b[1].sum()) * threshold.denominator < threshold.numerator * max(a[1].sum(), b[1].sum()):
        return False
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][at_a], b[1][at_b]).sum())
    return common * threshold.denominator >= threshold.numerator * (total - common) and common > 0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], size: int = SIZE) -> np.ndarray:
    """BagMinHash signatures, a line of ``size`` doubles per bag; an empty bag has infinities."""
    kept = np.full((len(bags), size), np.inf)
    flat = kept.reshape(-1)
    # One process per window and cut; cut j > 0 reaches from 2**(j - 1) to 2**j.
    seeds, owners, starts, tops, counts = [], [], [], [], []
    for d, (values, count) in enumerate(bags):
        low, top = 0, 1
        while len(values):
            seeds.append(_mix(values + _U(top)))
            owners.append(np.full(len(values), d))
            starts.append(np.full(len(values), low))
            tops.append(np.full(len(values), top))
            counts.append(count)
            low, top = top, 2 * top
            values, count = values[count > low], count[count > low]
    if not seeds:
        return kept
    seed, owner = np.concatenate(seeds), np.concatenate(owners)
    start, top, count = np.concatenate(starts), np.concatenate(tops), np.concatenate(counts)
    time = np.zeros(len(seed))
    latest = np.full(len(bags), np.inf)
    while len(seed):
        seed = _mix(seed + _U(0x9E3779B97F4A7C15))
        # 53 bits make the waiting time, other hashes the component and the place in the cut.
        uniform = ((seed >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / (top - start)
        go = time < latest[owner]
        seed, owner, time = seed[go], owner[go], time[go]
        start, top, count = start[go], top[go], count[go]
        drawn = _mix(seed ^ _U(0xD1B54A32D192ED03))
        component = ((drawn >> _U(32)) * _U(size) >> _U(32)).astype(np.int64)
        # Halving a cut as far as single weights is reading the bits of a number below its width.
        place = start + ((drawn & _U(0xFFFFFFFF)) * (top - start).astype(np.uint64) >> _U(32)).astype(np.int64)
        below = place < count
        np.minimum.at(flat, owner[below] * size + component[below], time[below])
        there = np.unique(owner)
        latest[there] = kept[there].max(axis=1)
    return kept


def band_keys(kept: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit number per text and band."""
    points = kept.view(np.uint64).reshape(len(kept), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), points.shape[:2]).copy()
    for row in range(rows):
        keys = _mix(keys * _U(0x9E3779B97F4A7C15) + points[:, :, row])
    return keys.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles = Shingles()
    for batch in slices(batches, TOGETHER):
        bags = [shingles(text) for text in batch.column("text").to_pylist()]
        keys = band_keys(signatures(bags)).reshape(-1)
        offsets = np.arange(len(bags) + 1, dtype=np.int32) * BANDS
        empty = pa.array([len(values) == 0 for values, _ in bags])
        bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys, pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("row"), empty, bands], ["row", "empty", "bands"])


def _verify(threshold: float):
    least = Fraction(str(threshold))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        centres = Memo(shingles, 16)  # pairs of one centre mostly come together
        for batch in slices(batches, TOGETHER):
            a, b = batch.column("a_text").to_pylist(), batch.column("b_text").to_pylist()
            linked = pa.array([similar(centres[x], shingles(y), least) for x, y in zip(a, b, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(linked), batch.column("b").filter(linked)], ["u", "v"]
            )

    return verify


def _semi(spark: SparkSession, frame: DataFrame, ids: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """``frame`` with (or by ``left_anti`` without) the ``ids``, a stored table of one long column."""
    few = ids.count() <= BROADCAST_IDS
    return frame.join(F.broadcast(ids) if few else ids, column, how)


def _text() -> Column:
    return F.coalesce(F.col("_doc.text").cast("string"), F.lit(""))


def store_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Stored table of ``docs``: the columns as ``_doc``, a number ``row`` and the text's digest ``key``."""
    rows = docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("row"))
    return stored(spark, rows.withColumn("key", F.unhex(F.md5(_text()))), "rows")


def find_links(spark: SparkSession, rows: DataFrame, firsts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``node, component`` of the distinct texts that have a near duplicate.

    ``firsts`` is a stored table of one ``row`` per distinct text.  The tables of the steps have
    rows and buckets only.  Every text is read once to sign it; those that share a bucket once
    more, to be joined to the pairs that are compared.  Copies are left out before they are signed, or where
    that would shuffle all texts, their signatures are.
    """
    texts = rows.select("row", _text().alias("text"))
    few = firsts.count() <= BROADCAST_IDS
    distinct = texts.join(F.broadcast(firsts), "row", "left_semi") if few else texts
    signed = distinct.mapInArrow(_sign, "row long, empty boolean, bands array<long>").where("not empty")
    signed = signed if few else signed.join(firsts, "row", "left_semi")
    banded = signed.select("row", F.explode("bands").alias("bucket"))
    banded = stored(spark, banded, "bands")
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(spark, banded.join(shared, "bucket"), "buckets")
    needed = stored(spark, members.select("row").distinct(), "needed")
    compared = stored(spark, _semi(spark, texts, needed, "row"), "candidates")

    # A text that meets many others is most likely to link them: it is compared with its buckets.
    met = members.groupBy("row").agg(F.sum("n").alias("met"))
    centre = members.join(met, "row").groupBy("bucket").agg(F.max_by("row", "met").alias("centre"))
    rest = members.join(centre, "bucket").where("row != centre")
    links = _linked(spark, compared, rest.select(F.col("centre").alias("a"), F.col("row").alias("b")), threshold)
    labels = components(spark, links)
    # What is left: pairs of a bucket without its centre, in different components.
    left = stored(spark, _of_several_components(_labelled(rest, labels)), "unlinked")
    if left.isEmpty():
        return labels
    return components(spark, links.union(stored(spark, _linked_in_blocks(left, compared, threshold), "links")))


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket, row`` with the row's component, which is itself where it has no link."""
    joined = members.join(labels, members["row"] == labels["node"], "left")
    return joined.select("bucket", "row", F.coalesce("component", "row").alias("component"))


def _of_several_components(members: DataFrame) -> DataFrame:
    ends = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return members.join(ends.where("low != high").select("bucket"), "bucket", "left_semi")


def _linked(spark: SparkSession, texts: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` (a, b) whose texts are similar, as stored edges ``u, v``."""
    a, b = (texts.select(F.col("row").alias(x), F.col("text").alias(f"{x}_text")) for x in "ab")
    found = pairs.distinct().join(b, "b").join(a, "a").select("a", "b", "a_text", "b_text")
    return stored(spark, found.mapInArrow(_verify(threshold), "u long, v long"), "links")


def _linked_in_blocks(left: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Edges ``u, v`` between similar texts of a bucket that are in different components.

    A bucket is cut into blocks at random, and a task gets two of them, so it never holds more than
    about ``2 * BLOCK`` texts.  There all overlaps are one matrix product; only edges leave it.
    """
    sizes = left.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("row", F.lit(BLOCK)), "blocks")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = left.join(sizes, "bucket").select("bucket", "row", "component", block.alias("block"), other.alias("other"))
    dealt = pairs.join(texts, "row").select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "row", "component", "block", "text",
    )
    least = Fraction(str(threshold))
    keys = ["bucket", "low", "high"]
    return grouped(dealt, keys, lambda group: _block_links(group, least), "u long, v long")


@lru_cache(maxsize=1)
def _shingles() -> Shingles:
    return Shingles()


def _block_links(group: pa.Table, threshold: Fraction) -> pa.RecordBatch | None:
    rows, components_, blocks = (group.column(c).to_numpy() for c in ("row", "component", "block"))
    if len(np.unique(components_)) < 2:
        return None
    tokens = [_occurrences(*_shingles()(text.as_py())) for text in group.column("text")]
    sizes = np.array([len(t) for t in tokens])
    overlap = overlaps(tokens)
    # Blocks of two kinds meet here, or one meets itself; others meet in other tasks.
    apart = components_[:, None] != components_[None, :]
    if blocks.min() != blocks.max():
        apart &= blocks[:, None] != blocks[None, :]
    total = sizes[:, None] + sizes[None, :]
    found = overlap * (threshold.numerator + threshold.denominator) >= total * threshold.numerator
    u, v = np.nonzero(np.triu(apart & found, 1))
    if not len(u):
        return None
    return pa.RecordBatch.from_arrays([pa.array(rows[u], pa.int64()), pa.array(rows[v], pa.int64())], ["u", "v"])


def _occurrences(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A multiset as a set: a number for each occurrence of each window."""
    at = np.repeat(np.arange(len(values)), counts)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    return _mix(values[at] + nth.astype(np.uint64) * _U(0x9E3779B97F4A7C15))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices over so many columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # What only one text has is in no intersection of two.
    common = count[column] > 1
    owner = owner[common]
    column = np.unique(column[common], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.int64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        start, end = np.searchsorted(column, [first, first + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[start:end], column[start:end] - first] = 1
        total += (part @ part.T).astype(np.int64)
    return total


def classify(spark: SparkSession, rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``row, class, doc_id`` of every row of :func:`store_rows`, stored.

    A class is all rows of equal texts and of texts linked through near duplicates.
    """
    # Equal texts share the least of their rows; a group is combined before its shuffle.
    firsts = stored(spark, rows.groupBy("key").agg(F.min("row").alias("row")), "firsts")
    labels = find_links(spark, rows, firsts.select("row"), threshold)
    classes = firsts.join(labels, firsts["row"] == labels["node"], "left").select(
        "key", F.coalesce("component", "row").alias("class")
    )
    narrow = rows.select("row", "key", F.col("_doc.doc_id").cast("long").alias("doc_id"))
    return stored(spark, narrow.join(classes, "key").select("row", "class", "doc_id"), "classes")


def _representatives(found: DataFrame) -> DataFrame:
    """Per class its least ``doc_id`` and the row that is kept: one with that id."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    least = found.groupBy("class").agg(F.min(order).alias("least"))
    return least.select("class", F.col("least.doc_id").alias("class_id"), F.col("least.row").alias("kept_row"))


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, kept`` for every document.

    ``class_id`` is the least ``doc_id`` of the class (NULL if it has none), and one row of each
    class is kept, one with that id.  Texts of fewer than five words have no windows and are only
    alike if they are equal; a NULL text counts as an empty one, and those are alike.  Repeated
    rows are rows of one class.  An empty table gives no rows; other columns are not read.
    """
    found = classify(spark, store_rows(spark, docs.select("doc_id", "text")), threshold)
    return found.join(_representatives(found), "class").select(
        "doc_id", "class_id", (F.col("row") == F.col("kept_row")).alias("kept")
    )


def keep_one(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every class the one that is kept.

    Columns are those of ``docs``; NULLs, short texts and repeated rows are as in
    :func:`near_duplicates`.
    """
    rows = store_rows(spark, docs)
    found = classify(spark, rows, threshold)
    kept = _representatives(found).select(F.col("kept_row").alias("row"))
    dropped = stored(spark, found.select("row").join(kept, "row", "left_anti"), "dropped")
    return _semi(spark, rows, dropped, "row", "left_anti").select("_doc.*")
