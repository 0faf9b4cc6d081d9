from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwright.llm import ngram_trie as nt
from tillwright.llm.elias_fano import EliasFano, Trie

WORD = re.compile("[^\x20\x09-\x0d]+")


# Elias-Fano -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("size", "most"), [(0, 1), (1, 1), (1, 2**64 - 1), (6, 3), (200, 1000), (900, 10), (3000, 2**63), (300, 2**64 - 1)]
)
def test_elias_fano_gets_and_finds(size, most):
    rng = np.random.default_rng(size)
    values = np.sort(rng.integers(0, most, size, dtype=np.uint64, endpoint=True))
    made = EliasFano.of(values)
    assert (made.get(np.arange(size)) == values).all()
    asked = np.concatenate([values, rng.integers(0, most, 200, dtype=np.uint64, endpoint=True), np.array([0, most, 2**64 - 1], np.uint64)])
    assert (made.successor(asked) == np.searchsorted(values, asked)).all()
    a, b = np.sort(rng.integers(0, size + 1, (2, len(asked))), axis=0)
    assert (made.successor(asked, a, b) == np.clip(np.searchsorted(values, asked), a, b)).all()
    found = made.find(asked)
    assert all((place >= 0) == (value in values) for place, value in zip(found, asked, strict=True))


def test_elias_fano_is_small():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 30, 1 << 16, dtype=np.uint64))
    bits = 8 * sum(array.nbytes for array in EliasFano.of(values).arrays()) / len(values)
    assert bits < 2 + math.log2((1 << 30) / len(values)) + 4  # the rank of each word of high bits included


def test_trie_finds_its_pairs_only_and_opens_from_a_mapped_file(tmp_path):
    rng = np.random.default_rng(3)
    pairs = np.unique(rng.integers(0, 60, (700, 2)) * [1, 7], axis=0)
    own = np.unique(pairs[:, 0])
    trie = Trie.of(pairs[:, 0], pairs[:, 1], np.arange(len(pairs)), own)
    (tmp_path / "trie").write_bytes(trie.pack())
    for opened in (Trie.open(trie.pack()), Trie.open_file(str(tmp_path / "trie"))):
        context, word = (grid.ravel() for grid in np.meshgrid(np.arange(64), np.arange(430), indexing="ij"))
        at, found = opened.look_up(context, word)
        have = {tuple(pair): k for k, pair in enumerate(pairs.tolist())}
        assert found.tolist() == [have.get(pair, -1) for pair in zip(context.tolist(), word.tolist(), strict=True)]
        assert opened.codes[found[found >= 0]].tolist() == sorted(have.values())
        known = at >= 0
        assert set(context[known]) == set(own.tolist()) and (opened.context_codes[at[known]] == context[known]).all()
    none = Trie.open(Trie.of(*(np.empty(0, np.int64) for _ in range(4))).pack())
    assert none.look_up(np.array([1]), np.array([1]))[1].tolist() == [-1]


def test_numbers_pack_and_unpack():
    for values in ([], [0], [255, 256], [2**31, 1, 2**40], list(range(1000))):
        assert nt.unpacked(nt.packed(np.array(values, np.int64))).tolist() == values


# The model --------------------------------------------------------------------------------------


def by_hand(rows):
    """Exact probabilities, without codes: ``doc_id -> figures`` in order of the rows."""
    low = lambda text: re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    texts = [(doc_id, WORD.findall(low(text)) + [" "]) for doc_id, text in rows]
    held = lambda doc_id: doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2
    words, pairs, contexts = Counter(), Counter(), Counter()
    for doc_id, text in texts:
        if not held(doc_id):
            words.update(text)
            pairs.update(zip(["\n", *text[:-1]], text))
            contexts.update(["\n", *text[:-1]])
    size = words.total() + len(words) + 1
    single = lambda w: (words[w] + 1) / size
    pair = lambda c, w: (pairs[c, w] + nt.PRIOR * single(w)) / (contexts[c] + nt.PRIOR)
    return [
        (
            doc_id, held(doc_id), len(text), sum(words[w] > 0 for w in text), words.total(),
            sum(math.log10(single(w)) for w in text),
            sum(math.log10(pair(c, w)) for c, w in zip(["\n", *text[:-1]], text)),
        )
        for doc_id, text in texts
    ]


def check(spark, frame, rows, **how):
    scores, tries = nt.score_corpus(spark, frame, **how)
    found, wanted = (sorted(map(tuple, r), key=str) for r in (scores.collect(), by_hand(rows)))
    assert scores.columns == [f.split()[0] for f in nt.RESULT.split(", ")]
    assert [row[:5] for row in found] == [row[:5] for row in wanted]
    for row, want in zip(found, wanted, strict=True):
        assert row[5] == pytest.approx(want[5], abs=1e-9)
        assert abs(row[6] - want[6]) <= row[2] * 0.6 / nt.STEP  # half a code, and its share of the back-off
    return tries


def corpus(seed, size, words=50):
    rng = random.Random(seed)
    vocabulary = [["the", "Of", "É", "x\x85y", "a\xa0b"][i % 5] + str(i // 5) for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    space = [" ", "\n", "\t", " \x0b", "\r\n", "\x0c"]
    return [
        (i, "".join(w + rng.choice(space) for w in rng.choices(vocabulary, weights, k=rng.randrange(40))))
        for i in range(size)
    ]


def test_scores_are_those_by_hand(spark, docs):
    rows = corpus(1, 150)
    check(spark, docs(*rows), rows)


def test_bundles_and_shards_change_nothing(spark, docs, monkeypatch):
    rows = corpus(2, 200)
    for name, value in {"BUNDLE_WORDS": 300, "SHARD_TOKENS": 150, "HOT": 40}.items():
        monkeypatch.setattr(nt, name, value)
    tries = check(spark, docs(*rows).repartition(5), rows, keep_tries=True)
    stored = tries.collect()
    assert len(stored) == len({row.shard for row in stored}) > 10
    low = lambda text: re.sub("[A-Z]", lambda m: m[0].lower(), text)
    texts = [["\n", *WORD.findall(low(text)), " "] for doc_id, text in rows if not nt.is_held_out(doc_id)]
    pairs = {pair for text in texts for pair in zip(text, text[1:])}
    assert sum(len(Trie.open(row.trie).codes) for row in stored) == len(pairs)


def test_words_with_one_fingerprint_are_told_apart(spark, docs, monkeypatch):
    class Clashing:
        @staticmethod
        def xxh3_128_digest(word, seed):
            import xxhash

            digest = xxhash.xxh3_128_digest(word, seed)
            return bytes(8) + digest[8:] if seed == 0 and word in (b"the0", b"of0") else digest

    monkeypatch.setattr(nt, "xxhash", Clashing)
    rows = corpus(3, 40)
    check(spark, docs(*rows), rows)


def test_nulls_repeats_long_texts_clashing_names(spark, docs, monkeypatch):
    monkeypatch.setattr(nt, "BUNDLE_WORDS", 1000)
    long = "again and " * 30_000
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (None, None), (4, long), (5, "A B a b"), (5, "A B a b"), (9, "\x85 \xa0")]
    rows += [(i, f"unseen{i} a") for i in range(100, 130)]
    frame = docs(*rows).withColumns({"bundle": F.lit(1), "score": F.lit("x"), "kind": F.lit(0), "tokens": F.lit(2)})
    check(spark, frame, rows)


def test_an_empty_table_and_one_without_training_texts(spark, docs):
    empty, tries = nt.score_corpus(spark, docs(), keep_tries=True)
    assert empty.collect() == [] and tries is None
    held = next(i for i in range(100) if nt.is_held_out(i))
    check(spark, docs((held, "a b")), [(held, "a b")])


def test_model_beats_single_words_on_what_it_has_not_seen(spark, docs):
    rng = random.Random(7)
    rows = [(i, " ".join(f"s{(k * 7 + rng.randrange(2)) % 40}" for k in range(rng.randrange(5, 60)))) for i in range(400)]
    scores = [row for row in nt.score_corpus(spark, docs(*rows))[0].collect() if row.held_out]
    assert len(scores) > 30 and sum(r.score for r in scores) > 0.8 * sum(r.base_score for r in scores)
