"""Personal data by boosted trees over candidate spans.

Base rules find what has a checkable form.  Beside them, generators with high recall propose spans
that may overlap: addresses with ``(at)`` and ``dot``, numbers with other separators or without
``+``, dotted quads with blanks.  Numbers next to each other look like one run of digits, so every series of
digit groups in a run is proposed, and quads are tried again inside those that are none.
Gradient-boosted trees score each candidate by its format and by
the words around it, and a threshold per kind, calibrated on held-out documents, selects.  Base
spans always stay; what is selected and overlaps none of them is added.

The trees are trained on all documents themselves.  Base spans are the positives, once
as they are and once rewritten as people write them (without ``+``, with ``(at)`` and ``(dot)``,
with dots in card numbers, with ``[.]`` in quads).  Candidates that are no base span are the negatives,
but for those that are written like a positive and can be one: a corpus may hold them as well, so
they are left out of training and calibration.  A threshold is calibrated on what can be added: the rewritten spans of
held-out documents are to be found, and candidates there that are none are not, while base spans, which stay
anyway, don't count.  A kind whose calibration does not reach the precision wanted adds nothing.
Examples that are alike in form and features become one row with their number before anything is learnt,
so trees and thresholds are those of all examples, and their cost grows with the different ones.

All of it is column expressions: texts are scanned with regular expressions in one projection
without shuffle, and the trees are translated into ``CASE`` expressions over arrays of candidates.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]

#: Precision that a kind's threshold has to reach on held-out candidates, however many there are.
#: Nothing is selected that the trees hold for less likely than not.
PRECISION = 0.98
TREES, DEPTH = 10, 3
#: Least number of bins of a feature.  A fit draws the limits it tries from as many rows as the square of its bins, so
#: bins grow with the root of the rows and all are looked at.
LEAST_BINS = 32
SEED = 17
CONTEXT = 24
#: Matches whose places are added up at a time; sums of these blocks are added up in turn.
BLOCK = 64

# The base rules, written so that no start is tried twice and no repetition is given back: a run of
# address characters or digits is entered at its beginning, or where the match before ended.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_LABEL = r"[A-Za-z0-9-]++"
_AT, _DOT = r"(?:@|\x20?[(\[]at[)\]]\x20?)", r"(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)"
#: Generators of candidates, by the kind they are for; numbers are cards from 13 digits on.
LOOSE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++(?:{_AT}{_LABEL}(?:{_DOT}{_LABEL})++|\x20at\x20{_LABEL}(?:\x20dot\x20{_LABEL})++)",
    "ip": r"(?<![0-9])[0-9]++(?:\x20?(?:\.|\[\.\]|\(\.\))\x20?[0-9]++){3}(?![0-9])",
    "quad": rf"(?<![0-9]){_PART}(?:\.{_PART}){{3}}(?![0-9])",
    "number": r"(?:\+|\(\+?)?[0-9](?:[\x20().\-/]{0,2}[0-9])++",
}
#: A run of digits is a series of these: a group of digits, what opens it and what stands behind it.
PIECE = r"(?:[(+][^0-9]?)?[0-9]++[^0-9(+]*+"
LEAST_DIGITS, CARD_DIGITS, MOST_DIGITS = 7, 13, 19

#: Words before a span that tell what it is, in the languages of the corpus.
CUES = {
    "email": r"(?i)mail|contact|kontakt|contacto|courriel|correo|write|schreib",
    "ip": r"(?i)\bip\b|address|server|host|adresse|servidor|serveur",
    "card": r"(?i)card|visa|credit|karte|carte|tarjeta|iban|account|konto",
    "phone": r"(?i)phone|tel|call|fax|mobil|fon|ruf|appel|llam|cell",
}
FEATURES = [
    "kind", "digits", "length", "groups", "plus", "parens", "dots", "dashes", "at", "letters",
    "valid", "first", "last", "cue_email", "cue_ip", "cue_card", "cue_phone",
    "left_open", "right_open",
]


def _of(function: Callable[..., Column], first: object) -> Callable[[Column], Column]:
    """``function`` of a span, with its first argument given."""
    return lambda span: function(first, span)


def _in_blocks(items: Column) -> Column:
    """An array in arrays of at most ``BLOCK``."""
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(BLOCK)))
    starts = F.coalesce(starts, F.expr("CAST(array() AS array<int>)"))
    return F.transform(starts, lambda start: F.slice(items, start, BLOCK))


def _sums_before(sizes: Column) -> Column:
    """For each number of an array the sum of those before it.

    Arrays can't grow in place, so the sums are taken in blocks and then shifted by the sums of the blocks.
    """

    def running(values: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<int>)").alias("sums"))
        add = lambda so_far, n: F.struct(
            (so_far["at"] + n).alias("at"), F.concat(so_far["sums"], F.array(so_far["at"])).alias("sums")
        )
        return F.aggregate(values, zero, add)

    blocks = F.transform(_in_blocks(sizes), running)
    shifts = running(F.transform(blocks, lambda block: block["at"]))["sums"]
    shifted = F.zip_with(blocks, shifts, lambda block, shift: F.transform(block["sums"], lambda n: n + shift))
    return F.flatten(shifted)


def _found(values: Column, gaps: Column) -> Column:
    """Matches with their places, from the matches and the text between them, in code points."""
    around = F.arrays_zip(
        values.alias("value"),
        F.slice(gaps, 1, F.size(values)).alias("before"),
        F.slice(gaps, 2, F.size(values)).alias("after"),
    )
    ends = _sums_before(F.transform(around, lambda match: F.length(match["before"]) + F.length(match["value"])))

    def span(match: Column, before: Column) -> Column:
        start = before + F.length(match["before"])
        return F.struct(
            start.alias("start"),
            (start + F.length(match["value"])).alias("end"),
            match["value"].alias("value"),
            F.right(match["before"], F.lit(CONTEXT)).alias("left"),
            F.left(match["after"], F.lit(CONTEXT)).alias("right"),
        )

    return F.zip_with(around, ends, span)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, span: Column) -> Column:
    value, digits = span["value"], F.length(_digits(span["value"]))
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": F.when(digits.between(16, 19), F.call_function("luhn_check", _digits(value))).otherwise(False),
        "phone": digits.between(8, 15),
    }[kind]


def scan(docs: DataFrame, text: str, candidates: bool = True, forms: bool = False) -> DataFrame:
    """``docs`` with a column of base spans per kind (``_email`` ...) and, if wanted, ``_candidates`` (with their ``form``).

    Each stage is a projection of its own, as its arrays are used more than once by the next.
    """
    patterns = {f"_{kind}": pattern for kind, pattern in BASE.items()}
    if candidates:
        patterns |= {f"_loose_{kind}": pattern for kind, pattern in LOOSE.items()}
    column = F.col(text)
    # Texts without these are not scanned for a kind; nothing that it can match lacks them.
    needs = {
        "_email": column.contains("@"),
        "_phone": column.contains("+"),
        "_loose_email": column.rlike(r"@|\(at\)|\[at\]|\x20dot\x20|[(\[]dot[)\]]"),
    }
    number = column.rlike("[0-9]")
    matches, gaps = {}, {}
    for name, pattern in patterns.items():
        needed = needs.get(name, number)
        matches[f"{name}_values"] = F.when(needed, F.regexp_extract_all(column, F.lit(pattern), F.lit(0)))
        gaps[f"{name}_gaps"] = F.when(needed, F.split(column, pattern, -1))
    matched = docs.withColumns(matches | gaps)
    none = F.expr("CAST(array() AS array<struct<start:int,end:int,value:string,left:string,right:string>>)")
    placed = matched.withColumns(
        {
            name: F.when(F.size(f"{name}_values") > 0, _found(F.col(f"{name}_values"), F.col(f"{name}_gaps"))).otherwise(none)
            for name in patterns
        }
    ).drop(*matches, *gaps)
    checked = {f"_{kind}": F.filter(f"_{kind}", _of(_valid, kind)) for kind in KINDS}
    if not candidates:
        return placed.withColumns(checked)
    placed = placed.withColumn("_loose_number", _all_series(F.col("_loose_number")))
    checked["_candidates"] = F.concat(*(F.transform(f"_loose_{kind}", _describing(kind, forms)) for kind in LOOSE))
    return placed.withColumns(checked).drop(*(f"_loose_{kind}" for kind in LOOSE))


def _all_series(runs: Column) -> Column:
    return F.flatten(F.transform(F.transform(F.transform(runs, _in_pieces), _marked), _series))


def _in_pieces(run: Column) -> Column:
    return F.struct(*(run[c].alias(c) for c in ("start", "left", "right")),
                    F.regexp_extract_all(run["value"], F.lit(PIECE), F.lit(0)).alias("pieces"))


def _marked(run: Column) -> Column:
    """A run with the characters and digits before each of its pieces, and before its end."""
    sizes = lambda measure: F.concat(F.transform(run["pieces"], measure), F.array(F.lit(0)))
    marks = F.arrays_zip(
        _sums_before(sizes(F.length)).alias("at"), _sums_before(sizes(lambda piece: F.length(_digits(piece)))).alias("digits")
    )
    return F.struct(*(run[c].alias(c) for c in ("start", "left", "right", "pieces")), marks.alias("marks"))


def _series(run: Column) -> Column:
    """All spans from one group of digits of a run to another that have as many digits as a number."""
    pieces, marks = run["pieces"], run["marks"]

    def span(i: Column, j: Column) -> Column:
        whole = F.array_join(F.slice(pieces, i + 1, j - i), "")
        value = F.regexp_replace(whole, "[^0-9]+$", "")
        start = run["start"] + marks[i]["at"]
        behind = F.concat(F.substring(whole, F.length(value) + 1, F.length(whole)), F.coalesce(F.get(pieces, j), F.lit("")))
        return F.struct(
            start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
            # The words before a number tell what it is, also where others stand between.
            F.concat(run["left"], F.coalesce(F.get(pieces, i - 1), F.lit(""))).alias("left"),
            F.concat(behind, run["right"]).alias("right"),
        )

    def from_piece(i: Column) -> Column:
        ends = F.sequence(i + 1, F.least(i + MOST_DIGITS, F.size(pieces)))
        fits = lambda j: (marks[j]["digits"] - marks[i]["digits"]).between(LEAST_DIGITS, MOST_DIGITS)
        return F.transform(F.filter(ends, fits), lambda j: span(i, j))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(pieces) - 1), from_piece))


def _plausible(generator: str, value: Column, digits: Column) -> Column:
    """Whether the digits of a candidate can be those of its kind."""
    if generator == "email":
        return F.lit(True)
    if generator in ("ip", "quad"):
        return F.regexp_replace(value, r"[\[\]()\x20]", "").rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    card = F.when(digits.between(16, 19), F.call_function("luhn_check", _digits(value))).otherwise(False)
    return F.when(digits >= CARD_DIGITS, card).otherwise(digits >= 8)


def _form(generator: str, value: Column) -> Column:
    """How a candidate is written: characters of one sort are the same."""
    if generator == "email":
        plain = F.regexp_replace(F.regexp_replace(value, r"\x20", ""), r"[(\[]dot[)\]]", ".")
        return F.regexp_replace(F.regexp_replace(plain, r"[(\[]at[)\]]", "@@"), rf"{_LOCAL}+", "a")
    if generator in ("ip", "quad"):
        return F.regexp_replace(value, "[0-9]+", "9")
    return F.regexp_replace(value, "[0-9]", "9")


def _describing(generator: str, form: bool) -> Callable[[Column], Column]:
    return lambda span: _described(generator, span, form)


def _described(generator: str, span: Column, form: bool = False) -> Column:
    """A candidate: its place and its features, all as numbers, and if wanted its form."""
    value, left, right = span["value"], span["left"], span["right"]
    digits = F.length(_digits(value))
    kind = {"email": F.lit(0), "ip": F.lit(1), "quad": F.lit(1)}.get(generator, F.when(digits >= CARD_DIGITS, 2).otherwise(3))
    count = lambda pattern: F.length(value) - F.length(F.regexp_replace(value, pattern, ""))
    features = {
        "kind": kind,
        "digits": digits,
        "length": F.length(value),
        "groups": F.size(F.split(value, "[^0-9]+")),
        "plus": value.contains("+").cast("int"),
        "parens": count(r"[()\[\]]"),
        "dots": count(r"\."),
        "dashes": count("-"),
        "at": value.contains("@").cast("int"),
        "letters": count("[A-Za-z]"),
        "valid": _plausible(generator, value, digits).cast("int"),
        "first": F.length(F.regexp_extract(value, "[0-9]+", 0)),
        "last": F.length(F.regexp_extract(value, "[0-9]*$", 0)),
        **{f"cue_{name}": left.rlike(pattern).cast("int") for name, pattern in CUES.items()},
        "left_open": left.rlike(r"(?:^|[^\p{L}\p{N}])$").cast("int"),
        "right_open": right.rlike(r"^(?:$|[^\p{L}\p{N}])").cast("int"),
    }
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), *(features[f].cast("double").alias(f) for f in FEATURES),
        *([_form(generator, value).alias("form")] if form else []),
    )


def _able(candidate: Column) -> Column:
    """What the trees may select: no quads with parts over 255, and no digits out of a longer word or number."""
    whole = (candidate["left_open"] == 1) & (candidate["right_open"] == 1)
    return F.when(candidate["kind"] < 2, (candidate["kind"] != 1) | (candidate["valid"] == 1)).otherwise(whole)


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _base_spans() -> Column:
    return F.concat(
        *(
            F.transform(f"_{kind}", _of(lambda i, s: F.struct(F.lit(i).alias("kind"), s["start"], s["end"]), i))
            for i, kind in enumerate(KINDS)
        )
    )


@dataclass
class SpanModel:
    """Trees as nested tuples ``(feature, limit, low, high)`` or a number, and a threshold per kind."""

    trees: list
    thresholds: dict[int, float]

    def margin(self, candidate: Column) -> Column:
        def value(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(tree)
            feature, limit, low, high = tree
            return F.when(candidate[FEATURES[feature]] <= limit, value(low)).otherwise(value(high))

        total = F.lit(0.0)
        for weight, tree in self.trees:
            total = total + F.lit(weight) * value(tree)
        return total

    def selected(self, candidate: Column) -> Column:
        chosen = F.lit(False)
        for kind, threshold in self.thresholds.items():
            chosen = chosen | ((candidate["kind"] == kind) & (candidate["margin"] >= threshold))
        return chosen


def _tree(lines: list[str]):
    """A tree out of its printed lines, which are consumed."""
    line = lines.pop(0).strip()
    if line.startswith("Predict"):
        return float(line.split(":")[1])
    feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = _tree(lines)
    lines.pop(0)  # Else
    return int(feature), float(limit), low, _tree(lines)


def train(docs: DataFrame, text: str = "text", most_documents: int | None = None) -> SpanModel:
    """Trees and thresholds from all documents.

    With ``most_documents``, from about that many only, chosen by a hash of their text and id; so of a
    text that many documents share, only that share of them is taken.
    """
    sample = docs.where(F.col(text).isNotNull())
    share = 1 if most_documents is None else max(1, docs.count() // max(1, most_documents))
    if share > 1:
        known = [F.col("doc_id").cast("string")] if "doc_id" in docs.columns else []
        sample = sample.where(F.pmod(F.xxhash64(text, *known, F.lit(SEED)), F.lit(share)) == 0)
    sample = sample.select(F.col(text).alias("_text"))
    scanned = scan(sample, "_text", forms=True).withColumn("_base", _base_spans())
    held_out = F.pmod(F.xxhash64("_text"), F.lit(2)) == 1
    confirmed = lambda c: F.exists("_base", lambda b: (
        (c["kind"] == b["kind"]) & (c["start"] == b["start"]) & (c["end"] == b["end"])))
    # Parts of base spans teach where a number ends; neither they nor base spans can be added, so they are no part
    # of the tally.
    free = lambda c: ~F.exists("_base", lambda b: _overlaps(c, b))
    candidates = F.transform("_candidates", lambda c: F.struct(
        c.alias("c"), confirmed(c).cast("double").alias("label"), (free(c) & _able(c)).alias("tallied")))
    rewritten = F.concat(*(
        F.transform(F.transform(f"_{k}", _of(_rewritten, k)), _describing(g, True)) for k, g in REWRITTEN.items()
    ))
    possible = lambda c: (c["kind"] < 2) | c["digits"].between(LEAST_DIGITS, MOST_DIGITS)
    as_written = F.transform(F.filter(rewritten, possible), lambda c: F.struct(
        c.alias("c"), F.lit(1.0).alias("label"), F.lit(True).alias("tallied")))
    # Two numbers next to each other: all spans but each of them are none.
    twice = F.concat(F.transform("_phone", _of(_rewritten, "phone")), F.col("_card"))
    pairs = F.transform(F.transform(_all_series(F.transform(twice, _doubled)), _describing("number", True)),
                        lambda c: F.struct(c.alias("c"), F.lit(0.0).alias("label"), F.lit(False).alias("tallied")))
    found = scanned.select(held_out.alias("held_out"), F.explode(F.concat(candidates, as_written, pairs)).alias("e")).select(
        "held_out", "e.label", "e.tallied", "e.c.form", *(f"e.c.{name}" for name in FEATURES)
    )
    found = found.groupBy(*found.columns).agg(F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # What is written like a positive and can be one may be one: it is unlabelled, neither a
        # negative nor an error of the held-out ones.  A cue stands for digits that can't be checked.
        forms = found.where("label = 1").select(F.col("kind").alias("_kind"), F.col("form").alias("_form")).distinct()
        may_be = (F.col("kind") == F.col("_kind")) & (F.col("form") == F.col("_form")) & (F.col("label") == 0)
        cue = (F.col("kind") == 3) & (F.col("cue_phone") == 1)
        may_be = may_be & ((F.col("valid") == 1) | cue)
        examples = found.join(forms, may_be, "left_anti")
        learnt = examples.where("not held_out").groupBy("label", *FEATURES).agg(F.sum("n").cast("double").alias("n"))
        rows = {row["label"]: row["count"] for row in learnt.groupBy("label").count().collect()}
        if len(rows) < 2:
            return SpanModel([], {})
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(learnt)
        bins = max(LEAST_BINS, math.isqrt(sum(rows.values())) + 1)
        fitted = GBTClassifier(
            maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.3, maxBins=bins, weightCol="n"
        ).fit(vectors)
        trees = [
            (weight, _tree(tree.toDebugString.strip().split("\n")[1:]))
            for weight, tree in zip(fitted.treeWeights, fitted.trees, strict=True)
        ]
        model = SpanModel(trees, {})
        margin = model.margin(F.struct(*FEATURES))
        steps = F.floor(margin * 50).cast("int")
        # A row per kind and step of the margin, which is bounded by the trees.
        tally = (
            examples.where("held_out and tallied").groupBy("kind", steps.alias("step"))
            .agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).collect()
        )
    finally:
        found.unpersist()
    for kind in range(len(KINDS)):
        right = total = 0.0
        ordered = sorted((r for r in tally if r["kind"] == kind), key=lambda r: -r["step"])
        # Steps without held-out candidates are shared with the next lower ones that have some.
        ends = [max(0, row["step"] + 1) for row in ordered[1:]] + [0]
        for row, end in zip(ordered, ends, strict=False):
            right, total = right + row["right"], total + row["n"]
            if row["step"] >= 0 and right >= PRECISION * total:
                model.thresholds[kind] = (row["step"] + min(end, row["step"])) / 100
    return model


#: Kinds that are rewritten, and the generator that finds what they become.
REWRITTEN = {"email": "email", "ip": "ip", "card": "number", "phone": "number"}


def _rewritten(kind: str, span: Column) -> Column:
    """A base span as it is written where no base rule finds it."""
    value = span["value"]
    if kind == "email":
        value = F.regexp_replace(F.replace(value, F.lit("@"), F.lit(" (at) ")), r"\.(?=[^.]*$)", " (dot) ")
    elif kind == "ip":
        value = F.replace(value, F.lit("."), F.lit("[.]"))
    elif kind == "card":
        value = F.regexp_replace(_digits(value), "(.{4})(?!$)", "$1.")
    else:
        value = F.regexp_replace(value, r"^\+[0-9]+\x20?", "")
    return F.struct(span["start"], span["end"], value.alias("value"), span["left"], span["right"])


def _doubled(span: Column) -> Column:
    value = F.concat(span["value"], F.lit(" "), span["value"])
    return F.struct(span["start"], span["end"], value.alias("value"), span["left"], span["right"])


def find_spans(docs: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: arrays of ``kind`` (a number), ``start``, ``end``, sorted."""
    scanned = scan(docs, text, candidates=bool(model.thresholds))
    found = scanned.withColumn("_base", _base_spans())
    if not model.thresholds:
        return found.withColumn("_spans", F.col("_base"))
    # Trees read the stored features of a candidate; what is left is compared with base spans.
    score = lambda c: F.struct(
        c["kind"].cast("int").alias("kind"), c["start"], c["end"], model.margin(c).alias("margin")
    )
    able = F.filter("_candidates", _able)
    chosen = F.filter(F.transform(able, score), model.selected)
    found = found.withColumn("_added", chosen)
    free = F.filter("_added", lambda c: ~F.exists("_base", lambda b: _overlaps(c, b)))
    found = found.withColumn("_added", free)
    # Of candidates that overlap, the best stays, of equal ones the longest and of these the first;
    # what overlaps only those that went stays as well.
    ranked = F.array_sort(F.transform("_added", lambda c: F.struct(
        (-c["margin"]).alias("worse"), (c["start"] - c["end"]).alias("shorter"), c["start"], c["kind"], c["end"])))
    found = found.withColumn("_added", ranked)
    none = F.expr("CAST(array() AS array<struct<kind:int,start:int,end:int>>)")
    taken = lambda so_far, c: F.exists(so_far, lambda d: _overlaps(c, d))
    added = F.aggregate("_added", none, lambda so_far, c: F.when(taken(so_far, c), so_far).otherwise(
        F.concat(so_far, F.array(F.struct(c["kind"], c["start"], c["end"])))))
    return found.withColumn("_spans", F.sort_array(F.concat("_base", added))).drop("_added")


def _listed(spans: str) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def report(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``doc_id``, base spans per kind and their digest, and all spans, of every document.

    A NULL or empty text has none; a NULL id stays NULL; repeated rows are reported each; an empty
    table gives no rows; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = find_spans(texts, model)
    return found.select(
        "doc_id",
        *(F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_listed("_base"), 256).alias("base_sha256"),
        _listed("_spans").alias("spans"),
    )


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets and ``n_chars`` of the new text.

    Of spans that overlap, the first gives the name and all are covered.  NULL texts stay NULL.
    """
    packed = docs.select(F.struct("*").alias("_doc"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    by_start = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    found = find_spans(packed, model).withColumn("_spans", by_start)
    names = F.array(*(F.lit(f"<{kind.upper()}>") for kind in KINDS))

    def cover(so_far: Column, span: Column) -> Column:
        between = F.substring(F.col("text"), so_far["at"] + 1, span["start"] - so_far["at"])
        hidden = F.concat(so_far["out"], between, F.get(names, span["kind"]))
        return F.struct(
            F.greatest(so_far["at"], span["end"]).alias("at"),
            F.when(span["start"] >= so_far["at"], hidden).otherwise(so_far["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text")))
    covered = F.when(F.size("_spans") > 0, F.aggregate("_spans", start, cover, rest)).otherwise(F.col("_doc.text"))
    found = found.withColumn("_new", covered)
    new = {"text": F.col("_new"), "n_chars": F.length("_new").cast("long")}
    return found.select(*(new.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns))
