"""A language model of word pairs in Elias-Fano tries, learned from and asked by whole corpora.

**Bundles.**  Texts are gathered in bundles of a few million words.  Inside a bundle words are numbers, and whatever
leaves it is one row per shard: packed arrays of different words, or of different pairs, with their counts.

**Words.**  Words are dealt to shards by a 64-bit fingerprint.  A shard adds up the training counts of its words, numbers
them, and answers every bundle.  More bits of the fingerprint tell whether two words share one; then all
is done again with another seed, so counts are exact.

**Pairs.**  Pairs are dealt by their first word, and those of a frequent first word by the second one too, so no
shard grows with a word's frequency.  A shard adds up its pairs and puts them in a :class:`Trie`: contexts, monotone
pointers, successors relative to their context, and 16-bit codes of probabilities.  Then it answers
every bundle's pairs by successor search.  Tries can be kept as a table.

**Probability.**  With ``n`` training counts, ``N`` tokens and ``V`` different ones, ``p(w) = (n(w) + 1) / (N + V + 1)``, and behind
``c`` it is ``p(w|c) = n(c, w) / (n(c) + PRIOR) + PRIOR / (n(c) + PRIOR) * p(w)``, which adds up to one.  The trie holds
the first term of each pair and the back-off weight of each context, quantised by their logarithms.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import grouped, slices, stored
from tillwright.llm.elias_fano import Trie

#: Words of a bundle; a longer text is one by itself.
BUNDLE_WORDS = 2 << 20
#: Tokens per shard, and occurrences from which a context's pairs are dealt over several.
SHARD_TOKENS, HOT = 1 << 20, 1 << 19
#: What a context's own counts are weighed against.
PRIOR = 100.0
#: Codes are so many to a power of ten, and the code for none.
STEP, NONE = 4096, 65535
#: Symbols that no text has as words: the end of a text, which is counted, and what stands before its first word.
END, START_ID = b" ", 0
#: The part of the ids that is held out.
HELD_OUT = (7, 2)

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CODEC = pa.Codec("zstd")

_BUNDLES = (
    "bundle long, docs array<long>, sizes array<int>, tokens binary, end_at long, prints binary, checks binary, "
    "counts binary"
)
_ASKED_WORDS = "shard long, bundle long, prints binary, checks binary, counts binary"
_WORDS = "bundle long, shard long, ids binary, counts binary, known long, total long, clash boolean"
_ASKED_PAIRS = "shard long, bundle long, contexts binary, sizes binary, totals binary, words binary, counts binary"
_PAIRS = "bundle long, shard long, codes binary, context_codes binary, trie binary"
RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a whole text in UTF-8, A-Z lower-cased; a NULL text has none."""
    return (text or "").encode().translate(_LOWER).split()  # at ASCII white space, unlike str.split()


def is_held_out(doc_id: int | None) -> bool:
    """Whether a document is not learned from; one without id is."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % HELD_OUT[0] == HELD_OUT[1]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in few bytes: the narrowest type, byte by byte of all, compressed."""
    values = np.asarray(values)
    values = np.ascontiguousarray(values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0)))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return bytes([values.itemsize]) + len(values).to_bytes(8, "little") + _CODEC.compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(_CODEC.decompress(data[9:], decompressed_size=size * width, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, size).T).view(f"u{width}").reshape(size).astype(np.int64)


def code_of(probability: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-np.log10(probability) * STEP), 0, NONE - 1).astype(np.uint16)


def probability_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == NONE, 0.0, 10.0 ** (-codes.astype(np.float64) / STEP))


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(field.rsplit(" ", 1) for field in schema.split(", ")), strict=True)
    types = {
        "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64(),
        "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    }
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds, strict=True)], list(names))


# Bundles -------------------------------------------------------------------------------------


class _Numbers(dict):
    """A number for each different word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Bundle:
    def __init__(self):
        self.numbers, self.docs, self.texts, self.words = _Numbers({END: 0}), [], [], 0

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        self.docs.append(doc_id)
        self.texts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.words += len(words)

    def row(self, bundle: int, seed: int) -> tuple:
        """Words are renumbered by fingerprint, so those of a shard follow each other."""
        digest = b"".join(xxhash.xxh3_128_digest(word, seed) for word in self.numbers)
        digest = np.frombuffer(digest, ">u4").reshape(-1, 4).astype(np.uint64)
        prints, checks = digest[:, 0] << np.uint64(32) | digest[:, 1], digest[:, 2]
        order = np.lexsort((checks, prints))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sizes = np.array([len(text) for text in self.texts], np.int32)
        tokens = place[np.concatenate(self.texts)]
        trains = np.array([not is_held_out(doc_id) for doc_id in self.docs])
        counts = np.bincount(tokens[np.repeat(trains, sizes)], minlength=len(order))
        counts[place[0]] = trains.sum()
        return (
            bundle, self.docs, sizes, packed(tokens), int(place[0]), prints[order].tobytes(),
            checks[order].astype(np.uint32).tobytes(), packed(counts),
        )


def bundles(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Rows of a bundle each: ids, words per text, all words as numbers, and each different word's prints and count."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, bundle = TaskContext.get().partitionId() << 33, _Bundle()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                bundle.add(doc_id, words_of(text.as_py()))
                if bundle.words >= BUNDLE_WORDS:
                    yield _batch(_BUNDLES, [bundle.row(number, seed)])
                    number, bundle = number + 1, _Bundle()
        if bundle.docs:
            yield _batch(_BUNDLES, [bundle.row(number, seed)])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(work, _BUNDLES)


# Words ---------------------------------------------------------------------------------------


def _print_shards(prints: np.ndarray, shards: int) -> np.ndarray:
    """Shards in order of the fingerprints."""
    return ((prints >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _ask_words(shards: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            prints = np.frombuffer(row["prints"], np.uint64)
            checks, counts = np.frombuffer(row["checks"], np.uint32), unpacked(row["counts"])
            asked, starts = np.unique(_print_shards(prints, shards), return_index=True)
            ends = [*starts[1:].tolist(), len(prints)]
            rows = [
                (shard, row["bundle"], prints[a:b].tobytes(), checks[a:b].tobytes(), packed(counts[a:b]))
                for shard, a, b in zip(asked.tolist(), starts.tolist(), ends, strict=True)
            ]
            yield _batch(_ASKED_WORDS, rows)

    return work


def _answer_words(shards: int) -> Callable[[pa.Table], pa.RecordBatch]:
    """Numbers and counts of the words of a shard, for every bundle that has them."""

    def work(group: pa.Table) -> pa.RecordBatch:
        rows = group.to_pylist()
        parts = [np.frombuffer(row["prints"], np.uint64) for row in rows]
        checks = np.concatenate([np.frombuffer(row["checks"], np.uint32) for row in rows])
        prints, first, place = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        clash = bool((checks != checks[first][place]).any())
        counts = np.zeros(len(prints), np.int64)
        np.add.at(counts, place, np.concatenate([unpacked(row["counts"]) for row in rows]))
        shard = rows[0]["shard"]
        made, at = [], 0
        for row, part in zip(rows, parts, strict=True):
            own = place[at : at + len(part)]
            at += len(part)
            # The number of a word: START_ID is none's.
            ids = 1 + own * shards + shard
            totals = (0, 0, False) if made else (int((counts > 0).sum()), int(counts.sum()), clash)
            made.append((row["bundle"], shard, packed(ids), packed(counts[own]), *totals))
        return _batch(_WORDS, made)

    return work


class Totals(NamedTuple):
    """Training tokens, and different ones."""

    tokens: int
    known: int

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.known + 1)


# Pairs ---------------------------------------------------------------------------------------


class _Asked(NamedTuple):
    """The tokens of a bundle, and its different pairs in order of shard, context and word."""

    docs: list
    starts: np.ndarray
    token_counts: np.ndarray
    shard: np.ndarray
    context: np.ndarray
    word: np.ndarray
    context_total: np.ndarray
    word_count: np.ndarray
    pair_of_token: np.ndarray
    trained: np.ndarray


def _spread(numbers: np.ndarray) -> np.ndarray:
    """Numbers mixed, so that neighbours are dealt apart."""
    x = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(8)).astype(np.int64)


def _pairs(group: pa.Table, shards: int) -> _Asked:
    """From the row of a bundle and the answers about its words."""
    rows = group.select(["kind", "shard", "docs", "sizes", "tokens", "end_at", "ids", "counts"]).to_pylist()
    bundle = next(row for row in rows if row["kind"] == 0)
    answers = sorted((row for row in rows if row["kind"] == 1), key=lambda row: row["shard"])
    ids = np.concatenate([[START_ID], *(unpacked(row["ids"]) for row in answers)])
    counts = np.concatenate([[0], *(unpacked(row["counts"]) for row in answers)])
    end = bundle["end_at"] + 1
    counts[0] = counts[end]  # texts begin as often as they end
    sizes = np.array(bundle["sizes"], np.int64) + 1
    ends = np.cumsum(sizes)
    starts = ends - sizes
    token = np.full(ends[-1], end, np.int64)
    inside = np.ones(ends[-1], bool)
    inside[ends - 1] = False
    token[inside] = unpacked(bundle["tokens"]) + 1
    # Words by the order of their numbers, so that pairs are in the order of both numbers.
    order = np.argsort(ids)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    word = place[token]
    context = np.empty_like(word)
    context[1:], context[starts] = word[:-1], place[0]
    keys, pair_of_token = np.unique(context * len(ids) + word, return_inverse=True)
    trains = np.repeat([not is_held_out(doc_id) for doc_id in bundle["docs"]], sizes)
    trained = np.bincount(pair_of_token[trains], minlength=len(keys))
    context, word = order[keys // len(ids)], order[keys % len(ids)]
    parts = np.maximum(1, -(-counts[context] // HOT))
    shard = (_spread(ids[context]) + _spread(ids[word]) % parts) % shards
    by = np.lexsort((keys, shard))
    back = np.empty_like(by)
    back[by] = np.arange(len(by))
    return _Asked(
        bundle["docs"], starts, counts[token], shard[by], ids[context][by], ids[word][by], counts[context][by],
        counts[word][by], back[pair_of_token], trained[by],
    )


def _ask_pairs(shards: int) -> Callable[[pa.Table], pa.RecordBatch]:
    def work(group: pa.Table) -> pa.RecordBatch:
        asked = _pairs(group, shards)
        bundle = group.column("bundle")[0].as_py()
        wanted, starts = np.unique(asked.shard, return_index=True)
        rows = []
        for shard, a, b in zip(wanted.tolist(), starts.tolist(), [*starts[1:].tolist(), len(asked.shard)], strict=True):
            contexts, first, sizes = np.unique(asked.context[a:b], return_index=True, return_counts=True)
            steps = np.diff(contexts, prepend=0)
            rows.append((
                shard, bundle, packed(steps), packed(sizes), packed(asked.context_total[a:b][first]),
                packed(asked.word[a:b]), packed(asked.trained[a:b]),
            ))
        return _batch(_ASKED_PAIRS, rows)

    return work


def _answer_pairs(keep_tries: bool) -> Callable[[pa.Table], pa.RecordBatch]:
    """The trie of a shard, and its codes for every bundle's pairs."""

    def work(group: pa.Table) -> pa.RecordBatch:
        rows = group.to_pylist()
        contexts = [np.cumsum(unpacked(row["contexts"])) for row in rows]
        sizes = [unpacked(row["sizes"]) for row in rows]
        totals = [unpacked(row["totals"]) for row in rows]
        words = [unpacked(row["words"]) for row in rows]
        # Numbers in order within the shard, so that a pair fits one number.
        context_ids, context = np.unique(
            np.concatenate([np.repeat(c, s) for c, s in zip(contexts, sizes, strict=True)]), return_inverse=True
        )
        word_ids, word = np.unique(np.concatenate(words), return_inverse=True)
        keys = context * len(word_ids) + word
        counts = np.concatenate([unpacked(row["counts"]) for row in rows])
        total = np.concatenate([np.repeat(t, s) for t, s in zip(totals, sizes, strict=True)])
        seen = counts > 0
        pairs, first, place = np.unique(keys[seen], return_index=True, return_inverse=True)
        summed = np.zeros(len(pairs), np.int64)
        np.add.at(summed, place, counts[seen])
        whole = total[seen][first]
        context = pairs // len(word_ids)
        starts = np.flatnonzero(np.diff(context, prepend=-1))
        trie = Trie.of(
            context_ids[context], word_ids[pairs % len(word_ids)], code_of(summed / (whole + PRIOR)),
            code_of(PRIOR / (whole[starts] + PRIOR)),
        )
        shard = rows[0]["shard"]
        made = [(None, shard, None, None, trie.pack())] if keep_tries else []
        for row, c, s, w in zip(rows, contexts, sizes, words, strict=True):
            at, found = trie.look_up(np.repeat(c, s), w)
            codes = np.full(len(w), NONE, np.int64)
            codes[found >= 0] = trie.codes[found[found >= 0]]
            own = at[np.cumsum(s) - s]
            back = np.zeros(len(c), np.int64)  # a context that was not seen backs off whole
            back[own >= 0] = trie.context_codes[own[own >= 0]]
            made.append((row["bundle"], shard, packed(codes), packed(back), None))
        return _batch(_PAIRS, made)

    return work


def _score(shards: int, totals: Totals) -> Callable[[pa.Table], pa.RecordBatch]:
    def work(group: pa.Table) -> pa.RecordBatch:
        asked = _pairs(group, shards)
        answers = group.filter(pc.equal(group.column("kind"), 2)).select(["shard", "codes", "context_codes"])
        answers = sorted(answers.to_pylist(), key=lambda row: row["shard"])
        codes = np.concatenate([unpacked(row["codes"]) for row in answers])
        # A code per context of each shard, spread over its pairs.
        change = np.flatnonzero(np.diff(asked.shard, prepend=-1) | np.diff(asked.context, prepend=-1))
        back = np.concatenate([unpacked(row["context_codes"]) for row in answers])
        back = np.repeat(back, np.diff(np.append(change, len(asked.shard))))
        chance = probability_of(codes) + probability_of(back) * totals.probability(asked.word_count)
        base = np.log10(totals.probability(asked.token_counts))
        starts, size = asked.starts, len(asked.token_counts)
        n = np.diff(np.append(starts, size))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(asked.docs, pa.int64()), pa.array([is_held_out(d) for d in asked.docs], pa.bool_()),
                pa.array(n), pa.array(np.add.reduceat((asked.token_counts > 0).astype(np.int64), starts)),
                pa.array(np.full(len(n), totals.tokens, np.int64)), pa.array(np.add.reduceat(base, starts)),
                pa.array(np.add.reduceat(np.log10(chance)[asked.pair_of_token], starts)),
            ],
            [field.split()[0] for field in RESULT.split(", ")],
        )

    return work


# All together ----------------------------------------------------------------------------------

#: Rows about a bundle: itself (kind 0), answers about its words (1) and about its pairs (2).
_ABOUT = {
    "bundle": "long", "kind": "int", "shard": "long", "docs": "array<long>", "sizes": "array<int>", "tokens": "binary",
    "end_at": "long", "ids": "binary", "counts": "binary", "codes": "binary", "context_codes": "binary",
}


def _about(frame: DataFrame, kind: int) -> DataFrame:
    have = {*frame.columns, "kind"}
    frame = frame.withColumn("kind", F.lit(kind))
    return frame.select(*((F.col(n) if n in have else F.lit(None).cast(t).alias(n)) for n, t in _ABOUT.items()))


def score_corpus(spark: SparkSession, docs: DataFrame, keep_tries: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """A row of figures per document, and with ``keep_tries`` the stored tries: ``shard, trie``.

    The figures are ``doc_id``, whether it is held out, its tokens (words and one end), those of them that are known from
    training, all training tokens, and log10 probabilities of the whole text: ``base_score`` by single words with one
    added to each count, ``score`` by the model.  The model learns from all documents that are not :func:`held out
    <is_held_out>`; one without id is learned from.  A NULL or empty text is an end alone.  Repeated rows count
    each; an empty table gives no rows; columns other than ``doc_id`` and ``text`` are not read.
    """
    for seed in itertools.count():
        made = stored(spark, bundles(docs, seed), "bundles")
        tokens = made.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b) + F.size("sizes"))).first()[0]
        if not tokens:
            return spark.createDataFrame([], RESULT), None
        shards = -(-tokens // SHARD_TOKENS)
        asked = made.select("bundle", "prints", "checks", "counts").mapInArrow(_ask_words(shards), _ASKED_WORDS)
        words = stored(spark, grouped(asked, ["shard"], _answer_words(shards), _WORDS), "words")
        known, total, clash = words.agg(F.sum("known"), F.sum("total"), F.max("clash")).first()
        if not clash:
            break
    rows = made.select("bundle", "docs", "sizes", "tokens", "end_at")
    about = _about(rows, 0).union(_about(words.select("bundle", "shard", "ids", "counts"), 1))
    pairs = grouped(about, ["bundle"], _ask_pairs(shards), _ASKED_PAIRS)
    answers = stored(spark, grouped(pairs, ["shard"], _answer_pairs(keep_tries), _PAIRS), "pairs")
    tries = answers.where("bundle IS NULL").select("shard", "trie") if keep_tries else None
    codes = _about(answers.where("bundle IS NOT NULL").select("bundle", "shard", "codes", "context_codes"), 2)
    return grouped(about.union(codes), ["bundle"], _score(shards, Totals(total, known)), RESULT), tries
