"""Ranked lexical search that scores every distinct bag of words once.

**Bags.**  Of a document only the terms that items use can count, so it is cut down to them: a
sorted list of term numbers and their occurrences, and how many terms the whole text has.

**Classes.**  Documents with the same bag and the same length figure ``m`` have the same score for every
item.  They are gathered by a hash; what has an equal hash is compared in full.  Of a class only the first
few ids can ever be returned.  They are cut down in every task before the shuffle, so a class that holds
a third of all documents is a few rows per task.

**Scores.**  Classes are scored in blocks against all items through lists of the items that use a term, in
64-bit integers.  A task keeps the best classes per item; ties go to the class with the smaller first id.  The best
classes of all tasks, as many as rows are wanted, hold all rows wanted, as each has a document that
comes before those of the classes left out.  Their members are expanded in order of id and ranked.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.common import slices, stored

#: Fixed values of the score.
UNIT, SATURATION, LEAST_M, LENGTH_SHARE = 1_000_000_000, 12, 100 - 25, 25
#: Items of a block: bytes of their texts, which bound the vocabulary that tasks hold, and their number.
BLOCK_BYTES, BLOCK_ITEMS = 16 << 20, 4096
#: Scores, and products added up to them, that exist at a time in a task.
SCORES, PRODUCTS = 1 << 20, 1 << 22

#: Term characters stay (A-Z as a-z), all other ASCII becomes a space; bytes from 0x80 are parts of term characters.
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in (ord(chr(b).lower()) if b < 0x80 else b for b in range(256))
)

_BAGS = "doc_id long, n long, terms array<int>, tfs array<int>"
_BEST = "item long, item_id long, score long, doc_ids array<long>"
RESULT = "item_id long, rank int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in UTF-8, with repeats; a NULL text has none."""
    return (text or "").encode().translate(_TERM_BYTES).split()


@dataclass
class Items:
    """Items of a block: their keys and ids, and per term the items that use it, with how often."""

    keys: np.ndarray
    ids: list[int | None]
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    users: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Items:
        vocabulary: dict[bytes, int] = {}
        uses = []
        for number, row in enumerate(rows):
            for term, times in Counter(terms_of(row["text"])).items():
                uses.append((vocabulary.setdefault(term, len(vocabulary)), number, times))
        table = np.array(sorted(uses), np.int64).reshape(-1, 3)
        starts = np.searchsorted(table[:, 0], np.arange(len(vocabulary) + 1))
        keys = np.array([row["item"] for row in rows], np.int64)
        return cls(keys, [row["item_id"] for row in rows], vocabulary, starts, table[:, 1].copy(), table[:, 2].copy())


def bags(docs: DataFrame, items: Items) -> DataFrame:
    """``doc_id``, number of terms and the bag over the items' vocabulary of every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in slices(batches):
            ids, sizes, ends, terms, tfs = [], [], [0], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = terms_of(text.as_py())
                if not found:
                    continue
                bag = sorted((number[t], tf) for t, tf in Counter(filter(number.__contains__, found)).items())
                ids.append(doc_id)
                sizes.append(len(found))
                terms += [t for t, _ in bag]
                tfs += [tf for _, tf in bag]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, _BAGS)


def document_counts(stored_bags: DataFrame, size: int) -> np.ndarray:
    """For each of ``size`` terms of the items, the documents that hold it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], ["term", "df"])

    partial = stored_bags.select("terms").mapInArrow(work, "term long, df long")
    counts = np.zeros(size, np.int64)
    for row in partial.groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row per term of the items
        counts[row["term"]] = row["df"]
    return counts


def classes(stored_bags: DataFrame, documents: int, all_terms: int, most: int) -> DataFrame:
    """``terms, tfs, m, doc_ids``: every distinct bag with its length figure, and its first ``most`` ids in order.

    Missing ids come last.
    """
    m = F.expr(f"{LEAST_M} + ({LENGTH_SHARE} * n * {documents}L) div {all_terms}L")
    rows = stored_bags.where(F.size("terms") > 0).withColumn("m", m)
    rows = rows.withColumn("hash", F.xxhash64("terms", "tfs", "m"))
    key = ["hash", "m", "terms", "tfs"]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last()))
    first = rows.withColumn("place", place).where(F.col("place") <= most)
    members = F.sort_array(F.collect_list(F.struct("place", "doc_id")))  # at most ``most``
    grouped = first.groupBy(*key).agg(members.alias("members"))
    return grouped.select("m", "terms", "tfs", F.col("members.doc_id").alias("doc_ids"))


class _Best:
    """The best classes per item: highest score first, then the smaller first id, a missing id last."""

    def __init__(self, items: int, most: int):
        self.most, self.floor = most, np.ones(items, np.int64)
        self.item, self.score, self.first = (np.empty(0, np.int64) for _ in range(3))
        self.docs: list[list] = []

    def add(self, scores: np.ndarray, docs: list[list]) -> None:
        """``scores`` has a row per class and a column per item."""
        row, item = np.nonzero(scores >= self.floor)
        if not len(row):
            return
        last = np.iinfo(np.int64).max
        first = np.array([last if d[0] is None else d[0] for d in docs], np.int64)
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[row, item[len(self.item) :]]])
        firsts = np.concatenate([self.first, first[row]])
        order = np.lexsort((firsts, -score, item))
        ordered = item[order]
        place = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        kept = order[place < self.most]
        full = order[place == self.most - 1]
        held = len(self.item)
        self.docs = [self.docs[k] if k < held else docs[row[k - held]] for k in kept.tolist()]
        self.floor[item[full]] = score[full]  # an equal score may still have a smaller id
        self.item, self.score, self.first = item[kept], score[kept], firsts[kept]


def _pieces(sizes: np.ndarray, rows: int, products: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` rows and, unless a row has more by itself, ``products`` products."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        end = min(start + rows, max(start + 1, int(np.searchsorted(ends, base + products, "right"))))
        yield start, end
        start = end


def best_classes(made: DataFrame, items: Items, weights: np.ndarray, most: int) -> DataFrame:
    """Per task and item, the ``most`` best classes with a score above 0."""
    shared = made.sparkSession.sparkContext.broadcast(
        (items.keys, items.ids, items.starts, items.users, items.times * np.repeat(weights, np.diff(items.starts)))
    )

    def score(batch: pa.RecordBatch, best: _Best) -> None:
        keys, _, starts, users, worth = shared.value
        column = batch.column("terms")
        offsets = column.offsets.to_numpy().astype(np.int64)
        terms = column.flatten().to_numpy().astype(np.int64)
        tfs = batch.column("tfs").flatten().to_numpy().astype(np.int64)
        sizes = np.diff(offsets)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        m = np.repeat(batch.column("m").to_numpy(), sizes)
        share = UNIT * tfs // (1000 * tfs + SATURATION * m)
        uses = starts[terms + 1] - starts[terms]
        ends = np.concatenate([[0], np.cumsum(uses)])
        docs = batch.column("doc_ids").to_pylist()
        for a, b in _pieces(ends[offsets[1:]] - ends[offsets[:-1]], max(1, SCORES // len(keys)), PRODUCTS):
            s, e = offsets[a], offsets[b]
            each = uses[s:e]
            at = np.arange(ends[e] - ends[s]) + np.repeat(starts[terms[s:e]] - (ends[s:e] - ends[s]), each)
            row = np.repeat(np.repeat(np.arange(b - a), sizes[a:b]), each)
            scores = np.zeros((b - a) * len(keys), np.int64)
            np.add.at(scores, row * len(keys) + users[at], np.repeat(share[s:e], each) * worth[at])
            best.add(scores.reshape(b - a, len(keys)), docs[a:b])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = shared.value[:2]
        best = _Best(len(keys), most)
        for batch in slices(batches):
            score(batch, best)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[best.item]), pa.array([ids[i] for i in best.item.tolist()], pa.int64()),
                pa.array(best.score), pa.array(best.docs, pa.list_(pa.int64())),
            ],
            ["item", "item_id", "score", "doc_ids"],
        )

    return made.mapInArrow(work, _BEST)


def expand(best: DataFrame, most: int) -> DataFrame:
    """The ``most`` first members of the best classes of each item."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_ids")[0].asc_nulls_last())
    top = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    members = top.select("item", "item_id", "score", F.explode("doc_ids").alias("doc_id"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return members.withColumn("rank", rank).where(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")


def _item_blocks(spark: SparkSession, items: DataFrame) -> Iterator[list]:
    """All items in blocks of bounded size; one whole item is the least that a block can hold."""
    keyed = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    keyed = stored(spark, keyed.withColumn("item", F.monotonically_increasing_id()), "items")
    rows, size = keyed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    count = max(-(-rows // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for block in range(count):
        yield keyed.where(F.pmod(F.xxhash64("item"), F.lit(count)) == block).collect()


def weights_of(documents: int, counts: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in counts], np.int64)


def rank(spark: SparkSession, docs: DataFrame, items: DataFrame, most: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``most`` documents with the highest scores above 0.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other columns are not read.
    Every row of ``docs`` is a document and every row of ``items`` is an item, repeated ones too.  A NULL or empty
    text has no terms; an item without terms, or an empty table, gives no rows.  Equal scores go by
    ascending ``doc_id``, a missing one last.  Texts are taken whole.  Items go in blocks of
    ``BLOCK_BYTES`` and ``BLOCK_ITEMS``, each a pass over the documents.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    results = []
    for rows in _item_blocks(spark, items):
        block = Items.of(rows)
        if not block.vocabulary:
            continue
        cut = stored(spark, bags(texts, block), "bags")
        documents, all_terms = cut.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        weights = weights_of(documents, document_counts(cut, len(block.vocabulary)))
        best = best_classes(classes(cut, documents, all_terms, most), block, weights, most)
        results.append(expand(best, most))
    return reduce(DataFrame.union, results) if results else spark.createDataFrame([], RESULT)
