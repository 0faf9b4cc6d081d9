"""The stages against brute force on a small fixture."""

from __future__ import annotations

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_bag_minhash import brute_force
from test_boosted_pii import base
from test_host_quality import by_hand


def good(text):
    words, chars, symbols, dups, repeated, lines = by_hand(text)
    return words >= 10 and 5 * repeated <= words and 20 * symbols <= chars and 100 * dups <= 40 * lines


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    words = [f"word{i}" for i in range(80)]
    copies = [" ".join([*words[:k], f"new{k}", *words[k + 1 :]]) for k in range(4)]
    rows = [(k, text) for k, text in enumerate(copies)] + [(10, copies[0]), (11, "short"), (12, None), (13, "a # b " * 20)]
    rows += [(20 + k, f"write to me{k}@mail.example.com or 1.2.3.{k} " + " ".join(f"own{k}x{i}" for i in range(40))) for k in range(6)]
    rows += [(20, rows[-6][1])]
    path = tmp_path_factory.mktemp("tables")
    docs(*rows).write.parquet(str(path / "documents.parquet"))
    return str(path), rows


def test_stages_do_what_brute_force_does(spark, folder):
    path, rows = folder
    left = [(doc_id, text) for doc_id, text in rows if good(text)]
    classes = dict(brute_force(left))
    left = {doc_id: text for doc_id, text in left if classes[str(doc_id)] == str(doc_id)}
    for doc_id, text in left.items():
        spans = sorted((a, b, kind) for kind, a, b in base(text))
        for a, b, kind in reversed(spans):
            text = text[:a] + f"<{kind.upper()}>" + text[b:]
        left[doc_id] = text
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = corpus_pipeline.run(spark, path).collect()
    assert {row.doc_id for row in found} == set(left) == {0, 20, 21, 22, 23, 24, 25}
    for doc_id, text in left.items():
        own = sorted((row for row in found if row.doc_id == doc_id), key=lambda row: row.start)
        ids = [int.from_bytes(row.ids[k : k + 4], "little") for row in own for k in range(0, len(row.ids), 4)]
        assert ids == library.encode(text, add_special_tokens=False).ids + [2]


def test_personal_data_learns_from_all_documents_of_the_stage(spark, monkeypatch):
    """More than the 20,000 documents that a capped training took."""
    seen, scan = [], corpus_pipeline.boosted_pii.scan
    monkeypatch.setattr(
        corpus_pipeline.boosted_pii, "scan", lambda rows, *a, **k: (seen.append(rows.count()), scan(rows, *a, **k))[1]
    )
    texts = spark.range(41_000).selectExpr(
        "id AS doc_id", "concat('words ', id % 997) AS text", "'en' AS lang", "'s' AS source", "9L AS n_chars"
    )
    corpus_pipeline.personal_data(spark, texts, "")
    assert seen == [41_000, 41_000]  # to learn, and to redact


def test_stages_keep_the_columns_of_documents(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).schema.simpleString() == docs.schema.simpleString(), name


def test_empty_documents(spark, docs, tmp_path):
    docs().write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_placeholders_are_of_known_kinds():
    assert re.fullmatch(r"email,ip,card,phone", ",".join(corpus_pipeline.boosted_pii.KINDS))
