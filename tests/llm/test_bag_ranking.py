from __future__ import annotations

from collections import Counter
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tillwright.llm import bag_ranking as br

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def by_hand(docs, items, most=20):
    """Every document scored for every item by itself; ``docs`` and ``items`` are pairs of id and text."""
    bags = [(doc_id, Counter(TERM.findall(lowered(text)))) for doc_id, text in docs]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(bag.total() for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    rows = []
    for item_id, text in items:
        terms, scored = TERM.findall(lowered(text)), []
        for doc_id, bag in bags:
            m = 100 - 25 + (25 * bag.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m))
                for t in terms
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, k, row[3], -row[0]) for k, row in enumerate(sorted(scored, key=lambda r: r[:3])[:most], 1)]
    return sorted(rows, key=str)


def ranked(spark, docs, items, **how):
    return sorted(map(tuple, br.rank(spark, docs, items, **how).collect()), key=str)


def made(seed, size, words=40):
    rng = random.Random(seed)
    vocabulary = [f"W{i}é"[: 2 + i % 3] + str(i) for i in range(words)]
    return [
        (i, rng.choice([" ", "\n", "-", "\x85"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))))
        for i in range(size)
    ]


def test_terms_are_those_of_the_pattern():
    rng = random.Random(2)
    alphabet = ["a", "Z", "9", "É", "ß", "\x00", "\x1f", "/", ":", "@", "[", "`", "{", "\x7f", "\x80", "\x85", "\xa0", " ", " ", "İ"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert [t.decode() for t in br.terms_of(text)] == TERM.findall(lowered(text)), repr(text)
    assert br.terms_of(None) == br.terms_of("") == br.terms_of(" - ") == []


@pytest.mark.parametrize("most", [1, 3, 20])
def test_ranks_are_those_of_scoring_every_document(spark, docs, most):
    texts, items = made(1, 300), [(i, t) for i, t in made(2, 25)]
    texts += [(1000 + i, texts[7][1]) for i in range(30)]  # a large class of ties
    found = ranked(spark, docs(*texts), spark.createDataFrame(items, ITEMS), most=most)
    assert found == by_hand(texts, items, most)


def test_members_of_classes_with_equal_scores_interleave_by_id(spark, docs):
    # Two orders of the same words are one class; "c" and "d" weigh the same, so their classes tie.
    texts = [(i, ["a c", "c a", "a d", "d a"][i % 4]) for i in range(60)]
    items = [(1, "c d"), (2, "a"), (3, "zzz")]
    assert ranked(spark, docs(*texts), spark.createDataFrame(items, ITEMS)) == by_hand(texts, items)


def test_blocks_of_items_and_pieces_of_scores_change_nothing(spark, docs, monkeypatch):
    texts, items = made(3, 120), made(4, 23)
    whole = ranked(spark, docs(*texts), spark.createDataFrame(items, ITEMS))
    monkeypatch.setattr(br, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(br, "SCORES", 7)
    monkeypatch.setattr(br, "PRODUCTS", 50)
    assert ranked(spark, docs(*texts), spark.createDataFrame(items, ITEMS)) == whole == by_hand(texts, items)


def test_bags_with_the_same_hash_stay_apart(spark, docs, monkeypatch):
    texts, items = made(5, 80, words=6), made(6, 5, words=6)
    monkeypatch.setattr(br.F, "xxhash64", lambda *_: F.lit(1).cast("long"))
    assert ranked(spark, docs(*texts), spark.createDataFrame(items, ITEMS)) == by_hand(texts, items)


def test_nulls_repeats_and_clashing_names(spark, docs):
    texts = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (3, "a"), (4, "x " * 200_000 + "a"), (5, "-")]
    items = [(7, "a a b"), (7, "b"), (None, "b"), (8, None), (9, "")]
    frame = docs(*texts).withColumns({"n": F.lit(1), "terms": F.lit("t"), "score": F.lit(0), "item_id": F.lit(1)})
    asked = spark.createDataFrame(items, ITEMS).withColumns({"item": F.lit(0), "doc_id": F.lit(5)})
    assert ranked(spark, frame, asked) == by_hand(texts, items)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a")], ITEMS)
    for result in (br.rank(spark, docs(), some), br.rank(spark, docs((1, "a")), none), br.rank(spark, docs((1, "b")), some)):
        assert result.collect() == [] and result.columns == ["item_id", "rank", "doc_id", "score"]


def test_copies_are_cut_down_before_their_shuffle(spark, docs):
    block = br.Items.of([{"item": 0, "item_id": 1, "text": "a b"}])
    plan = br.classes(br.bags(docs((1, "a b")), block), 1, 2, 20)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan[plan.index("Exchange"):]
