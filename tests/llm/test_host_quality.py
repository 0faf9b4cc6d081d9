from __future__ import annotations

from collections import Counter
import random
import re

import pytest
from pyspark.sql import functions as F

from tillwright.llm import host_quality as hq

WORD = re.compile("[^\x20\x09-\x0d]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    places = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
        len(places), len(lines),
    )


def test_figures_are_those_by_hand():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", "é", "#", " ", " ", "\n", "\t", "\x0b", "\x85", "\xa0", "c "]) for _ in range(rng.randrange(120)))
        assert hq.text_stats(text) == by_hand(text), repr(text)
    for text in [None, "", " \n ", "a b c d e a b c d e", "x " * 500, "\n".join(["same line"] * 5)]:
        assert hq.text_stats(text) == by_hand(text)


def test_windows_of_many_different_words():
    words = [f"w{i}".encode() for i in range(9000)]
    assert hq.repeated_words(words) == 0
    assert hq.repeated_words([*words, *words[100:107]]) == 14


GOOD = "one two three four five six seven eight nine ten eleven twelve"
BAD = "a # b # c # d # e # f # g # h # i # j # k"


def kept(spark, rows):
    return {r.doc_id: r.kept for r in hq.judge(spark, rows).collect()}


def test_document_rules_and_good_hosts(spark, docs):
    rows = docs(*[(i, f"{GOOD} {i}", f"h{i % 4}") for i in range(40)], (100, "too short", "h1"), (101, BAD, "h2"),
                (102, "x y z v w " * 9, "h3"))
    found = kept(spark, rows)
    assert all(found[i] for i in range(40)) and not any(found[i] for i in (100, 101, 102))


def test_a_bad_host_loses_all_and_a_small_one_is_judged_by_others(spark, docs):
    rows = [(i, f"{GOOD} {i}", "good") for i in range(200)]
    rows += [(1000 + i, BAD, "bad") for i in range(180)] + [(2000, GOOD, "bad")]
    rows += [(3000, BAD, "new"), (3001, GOOD, "new")]
    found = kept(spark, docs(*rows))
    assert not found[2000] and found[3001] and not found[3000] and all(found[i] for i in range(200))


def test_nulls_repeats_clashing_names_and_empty_tables(spark, docs):
    frame = docs((1, None), (2, ""), (None, GOOD, None), (4, GOOD, None), (4, GOOD, None)).withColumns(
        {"n_words": F.lit("x"), "_host": F.lit(1), "kept": F.lit(0), "rate_any": F.lit(0)}
    )
    rows = hq.judge(spark, frame).collect()
    assert Counter((r.doc_id, r.n_words, r.kept) for r in rows) == Counter(
        {(1, 0, False): 1, (2, 0, False): 1, (None, 12, True): 1, (4, 12, True): 2}
    )
    left = hq.keep_good(spark, frame)
    assert left.columns == frame.columns and sorted(str(r.doc_id) for r in left.collect()) == ["4", "4", "None"]
    assert hq.judge(spark, docs()).collect() == [] and hq.keep_good(spark, docs()).collect() == []


def test_many_hosts_are_joined_without_broadcast(spark, docs, monkeypatch):
    rows = docs(*[(i, f"{GOOD} {i}", f"h{i}") for i in range(30)], (99, BAD, "h1"))
    few = kept(spark, rows)
    monkeypatch.setattr(hq, "BROADCAST_HOSTS", 3)
    assert kept(spark, rows) == few


@pytest.mark.parametrize("rates", [(0.0, 0.0), (0.1, 0.3), (1.0, 1.0)])
def test_prior_stays_within_its_bounds(spark, docs, rates):
    rows = [(100 * h + i, BAD if i < 20 * rate else GOOD, f"h{h}") for h, rate in enumerate(rates) for i in range(20)]
    for row in hq.host_rates(hq.measure(docs(*rows))).collect():
        assert 0 <= row.rate_any <= 1 and row.n == 20
