"""Token counts by a Viterbi search that keeps a score and a piece count, and no pieces.

The tokenizer is a unigram model with byte fallback behind a split at spaces: a space becomes
``▁``, every ``▁`` begins a new word, and the first word gets one.  Inside a word the pieces
with the largest sum of scores win.  Its exact rules, which ties depend on:

* sums are taken from the left in double precision;
* of equal sums that end at the same place, the one with the longer last piece stays;
* a character that is no piece by itself costs the smallest score less ten and counts as its
  UTF-8 bytes.

An Aho-Corasick automaton reports the pieces that end at each character, longest first, so one
pass over the word fills the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tillwright.llm.common import Memo, slices

SPACE = "▁"
#: How far below the smallest score an unknown character is.
UNKNOWN_PENALTY = 10.0
#: Words a task remembers.
MEMO_WORDS = 800_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces of a vocabulary file by id, with the log probabilities of Zipf's law.

    The file holds merge ranks and no probabilities; id ``i`` gets ``-log(i + 1)``.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), -math.log(i + 1)) for i in range(model.get_piece_size())]


class CountingViterbi:
    """Best score and number of pieces of a word, of a text by its words."""

    def __init__(self, pieces: list[tuple[str, float]], memo_words: int = MEMO_WORDS):
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.memo = Memo(lambda rest: self.word(SPACE + rest), memo_words)

    def word(self, word: str) -> tuple[float, int]:
        score, count = [0.0], [0]
        matches = self.automaton.iter(word)
        last, piece = next(matches, (-1, None))
        for i, character in enumerate(word):
            best, pieces = -math.inf, 0
            while last == i:
                length, gain = piece
                total = score[i + 1 - length] + gain
                if total > best:
                    best, pieces = total, count[i + 1 - length] + 1
                last, piece = next(matches, (-1, None))
            if character not in self.single:
                total = score[i] + self.unknown
                if total > best:
                    best, pieces = total, count[i] + len(character.encode())
            score.append(best)
            count.append(pieces)
        return score[-1], count[-1]

    def text(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        words = text.replace(" ", SPACE).split(SPACE)
        # Before the first space there is no word, unless the text begins without one.
        words = words if words[0] else words[1:]
        best = [self.memo[word] for word in words]
        return math.fsum(score for score, _ in best), sum(count for _, count in best)


@lru_cache(maxsize=2)
def _viterbi(path: str) -> CountingViterbi:
    return CountingViterbi(read_pieces(path))


def count_tokens(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of every whole text: ``doc_id``, ``n_tokens`` and the ``log_score`` of its best split.

    ``vocabulary`` is the path of a sentencepiece file that every machine has.  A NULL or empty
    text has 0 tokens; a NULL id stays NULL; repeated rows are counted each; an empty table gives
    none; other columns are not read.  There is no shuffle and a task's memory is one batch, the
    automaton and the bounded memo.
    """
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        viterbi = _viterbi(vocabulary)
        for batch in slices(batches):
            best = [viterbi.text(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([tokens for _, tokens in best], pa.int64()),
                    pa.array([score for score, _ in best], pa.float64()),
                ],
                ["doc_id", "n_tokens", "log_score"],
            )

    return source.mapInArrow(count, "doc_id long, n_tokens long, log_score double")
