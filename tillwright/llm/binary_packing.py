"""Packing by power-of-two decomposition.

The ids of a document are cut into pieces whose lengths are powers of two: as many of the
largest length as fit, then one for each bit of the rest, largest first.  Every piece fills a
sequence of its own length, so no sequence crosses documents and none is padded.  Sequences
are bucketed by length; a batch takes sequences of one bucket.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwright.llm.common import slices

MOST_TOKENS = 4096
END_OF_TEXT = 2
#: Words a task remembers, and words of a call of the tokenizer.
MEMO_WORDS = 1_600_000
CALL_WORDS = 2000
#: What a tokenizer does before its merges under which a word's ids are those of its parts, one after the other: it
#: lower-cases, and cuts letters, single digits and all else apart.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRETOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Printable ASCII without ``'``, which may begin a contraction; and its parts once it is lower case.
PLAIN = re.compile(rb"[!-&(-~]+").fullmatch
PARTS = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+").findall
#: A word up to its last letter, ASCII or one of Latin's with marks, and the marks behind it.
BODY = re.compile(rb"(.*(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([!-&(-/:-@\[-`{-~]+)", re.DOTALL).fullmatch
#: Special tokens begin with this and are found before anything is cut.
SPECIAL = b"<|"
#: Bits of a sequence id below its bucket's: 33 for the row in its task, 25 for the task.
BUCKET_SHIFT = 58


def lengths(tokens: int, most: int = MOST_TOKENS) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    rest = tokens % most
    return [most] * (tokens // most) + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def _cuts_words(tokenizer: Tokenizer) -> bool:
    """Whether :func:`parts` may be told apart before a tokenizer sees them."""
    steps = tokenizer.normalizer, tokenizer.pre_tokenizer
    if None in steps or any(token.content[:2].encode() != SPECIAL for token in tokenizer.get_added_tokens_decoder().values()):
        return False
    normalizer, pre_tokenizer = (json.loads(step.__getstate__()) for step in steps)
    return normalizer.get("normalizers") == NORMALIZERS and pre_tokenizer.get("pretokenizers") == PRETOKENIZERS


def parts(word: bytes) -> list[bytes]:
    """Parts of a word whose ids one after the other are the word's; the same parts come up in many words.

    They end where such a tokenizer cuts anyway and nothing composes: between printable ASCII characters of
    different sorts, and between a letter and the ASCII marks that end a word.
    """
    if SPECIAL in word:
        return [word]
    if PLAIN(word):
        return PARTS(word.lower())
    ended = BODY(word)
    return [word] if ended is None else [ended[1], ended[2]]


class WordTokenizer:
    """Ids of texts by a tokenizer that drops ASCII white space and merges nothing across it.

    Under that condition a text's ids are those of its words in order, so the tokenizer is asked
    once per word, and for many words in a call.  Where it is one that cuts letters, digits and marks apart, it is
    asked once per such part, and of plain ones only for its merges; half as many parts are remembered as words.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = _cuts_words(self.tokenizer)
        self.model = self.tokenizer.model
        self.memo_words, self.memo_parts = memo_words, memo_words // 2
        self.memo: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        """Put the ids of ``words`` into the memo."""
        if not self.cuts:
            self._ask(words, self.memo)
            return
        cut = list(map(parts, words))
        needed = set().union(*cut)
        missing = needed.difference(self.parts)
        if len(self.parts) + len(missing) > self.memo_parts:
            self.parts.clear()
            missing = needed
        whole = []
        for part in missing:
            if PLAIN(part) and SPECIAL not in part:  # its bytes are their own names in the vocabulary
                ids = [token.id for token in self.model.tokenize(part.decode())]
                self.parts[part] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                whole.append(part)
        self._ask(whole, self.parts)
        for word, own in zip(words, cut, strict=True):
            self.memo[word] = b"".join(map(self.parts.__getitem__, own))

    def _ask(self, words: list[bytes], memo: dict[bytes, bytes]) -> None:
        """Put what the whole tokenizer makes of ``words`` into ``memo``."""
        found = self.tokenizer.encode([word.decode() for word in words], is_pretokenized=True, add_special_tokens=False)
        packed = np.asarray(found.ids, "<u4").tobytes()
        ends = np.searchsorted(np.asarray(found.word_ids, np.int64), np.arange(len(words) + 1)) * 4
        for word, start, end in zip(words, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            memo[word] = packed[start:end]

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of some different words."""
        found = list(map(self.memo.get, words))
        missing = list(compress(words, map(not_, found)))
        if len(self.memo) + len(missing) > self.memo_words:  # bounds memory, not results; what was found outlives it
            self.memo.clear()
        for start in range(0, len(missing), CALL_WORDS):
            self._learn(missing[start : start + CALL_WORDS])
        return [self.memo[word] if ids is None else ids for word, ids in zip(words, found, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Words of the texts are told apart by Arrow, so that only different ones are looked up.
        """
        # White space at the ends of a text makes empty words, which have no ids.
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_utf8()))
        words = split.flatten().dictionary_encode()
        known = self._known(words.dictionary.cast(pa.large_binary()).to_pylist())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        which = words.indices.to_numpy()
        ends = np.cumsum(sizes[which])
        # Places of all ids in those of the different words: each word's begin where its own do.
        shift = (np.cumsum(sizes) - sizes)[which] - ends + sizes[which]
        places = np.repeat(shift, sizes[which]) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(b"".join(known), "<u4")[places].tobytes()
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy()] * 4
        return [ids[start:end] for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


@lru_cache(maxsize=1)
def _tokenizer(path: str, memo_words: int) -> WordTokenizer:
    return WordTokenizer(path, memo_words)


def pieces(
    docs: DataFrame, vocabulary: str, most: int = MOST_TOKENS, id_column: str = "doc_id", memo_words: int = MEMO_WORDS
) -> DataFrame:
    """Pieces of every whole text, without sequences yet.

    Columns ``doc_id, start, length, ids`` (little-endian 32-bit) and ``doc_tokens``.  A document is its
    text's ids and one end-of-text id, so a NULL or empty text is one piece of one id.  ``most``
    has to be a power of two.  A Python worker remembers up to ``memo_words`` words (about 200 bytes
    each) and half as many parts of words, from task to task; fewer cost time only.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("the longest piece has to be a power of two")
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    end = struct.pack("<I", END_OF_TEXT)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
         ("doc_tokens", pa.int64())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary, memo_words)
        for batch in slices(batches):
            rows = []
            encoded = tokenizer.encode([text or "" for text in batch.column("text").to_pylist()])
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                ids = body + end
                tokens, start = len(ids) // 4, 0
                for length in lengths(tokens, most):
                    rows.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], tokens))
                    start += length
            columns = zip(*rows, strict=True)
            arrays = [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return source.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long")


def pack(
    docs: DataFrame, vocabulary: str, most: int = MOST_TOKENS, id_column: str = "doc_id", memo_words: int = MEMO_WORDS
) -> DataFrame:
    """All pieces with their sequences: the columns of :func:`pieces`, ``bucket``, ``sequence_id``, ``offset``.

    ``bucket`` is the base-2 logarithm of the length.  A sequence holds one piece, at offset 0,
    and its id has the bucket above ``BUCKET_SHIFT``, so ids of equal lengths are one range; below
    are the task and the row within it.  There is no shuffle: what a task's ids need, it has.
    Whatever attempt of a task is kept, its ids are its own; a caller who reads the frame twice
    stores it first.

    A NULL id stays NULL, repeated rows are packed each, an empty table gives no rows, other
    columns are not read.
    """
    bucket = F.log2("length").cast("long")
    return pieces(docs, vocabulary, most, id_column, memo_words).select(
        "*",
        bucket.alias("bucket"),
        (F.shiftleft(bucket, BUCKET_SHIFT) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write packed sequences with a folder for each bucket; AQE sizes the files and splits large buckets."""
    packed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)


def crc32_of_ids(packed: DataFrame) -> DataFrame:
    """``packed`` with ``ids_crc32``, the unsigned checksum of the ids' bytes, in place of ``ids``."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )
