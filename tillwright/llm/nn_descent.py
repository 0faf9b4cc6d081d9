"""Approximate nearest neighbours by a graph that NN-descent builds with joins.

**Items.**  Equal vectors are one item, so copies neither fill neighbour lists nor tear the graph.
For the largest inner product, each vector gets one more component that makes all lengths equal;
then the nearest is the one with the largest product, and neighbours of neighbours are likely
neighbours.  That component would drown the others of a vector much shorter than the longest, so items are
parted in bands whose lengths differ by less than a factor of two, each with a graph of its own, scaled by its
longest.  A band other than the most numerous with at most a block of items is scored whole against all queries.

**Start.**  Trees of median splits, fitted on a bounded sample, deal all items into leaves; a leaf
with many items is dealt on at random.  Inside a block of a few hundred items the nearest are found exactly.

**Descent.**  In every round each item gathers its neighbours and the items that have it as a
neighbour, and these are compared with each other: neighbours of a neighbour meet.  What is nearer
than an item's farthest neighbour goes to that item's list.  An item that very many have as
a neighbour gathers them in several groups, each with its own neighbours.

**Search.**  A query walks the graph from its own place: the best items found so far that have not been
expanded give their neighbours, these are scored, the best stay.  Walks of all queries go in
rounds of joins.  In a band that is not its own, the query takes part as one more item of the band's length.
What walks end with is scored again in double precision on the original vectors.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.common import grouped, stored

NEIGHBOURS = 32
#: Trees, items they are fitted on (at most), and items in a block.
TREES, SAMPLE, BLOCK = 16, 8192, 2048
LEAST_IN_LEAF = 16
#: Rounds end when all lists together gain less than this share of their nearness, or, with a warning, after so many.
LEAST_GAIN, ROUNDS = 0.002, 10
#: Items gathered in one group of an item with many.
GROUP = 64
#: Best items a walk keeps, and those it expands in a round.  It ends when all that it keeps are
#: expanded, or, with a warning, after so many rounds.
KEPT, EXPANDED, HOPS = 96, 32, 12
#: Longest vectors that every walk looks at first: products are often largest with them.
LONGEST = 32
SEED = 11

_GRAPH = "id long, nbrs array<long>, sims array<float>"


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors stored as float16 bytes, as rows of float32."""
    rows = [np.frombuffer(v, np.float16) for v in column.to_pylist()]
    return np.asarray(rows, np.float32) if rows else np.empty((0, 0), np.float32)


# Items ---------------------------------------------------------------------------------------


def usable(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part.

    Not those without id, and not vectors that are NULL, zero or hold a NULL, NaN or infinity.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    sound = F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    return rows.where(F.coalesce(sound, F.lit(False)))


def inner(a: str, b: str) -> Column:
    """The inner product in double precision, added up from the first component on."""
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _augmented(largest: float) -> Callable:
    """Vectors scaled to length one with a last component for what they lack, as float16 bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for vector in batch.column("vector").to_pylist():
                v = np.asarray(vector, np.float64) / largest
                rest = np.sqrt(max(0.0, 1.0 - float(v @ v)))
                made.append(np.append(v, rest).astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.binary())], ["id", "vec"])

    return work


# Start ---------------------------------------------------------------------------------------


def fit_tree(sample: np.ndarray, depth: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Directions and limits of a balanced tree: nodes in order of levels, each split at its median."""
    size = sample.shape[1]
    normals, limits = np.zeros((2**depth - 1, size), np.float32), np.zeros(2**depth - 1, np.float32)
    parts = {0: sample}
    for node in range(2**depth - 1):
        part = parts.pop(node)
        if len(part) > 1:
            a, b = part[rng.choice(len(part), 2, replace=False)]
            normal = a - b if np.any(a != b) else rng.standard_normal(size).astype(np.float32)
            at = part @ normal
            normals[node], limits[node] = normal, np.median(at)
            right = at > limits[node]
        else:
            right = np.zeros(len(part), bool)
        parts[2 * node + 1], parts[2 * node + 2] = part[~right], part[right]
    return normals, limits


def leaves(vectors: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    normals, limits = tree
    node = np.zeros(len(vectors), np.int64)
    while len(node) and node[0] < len(normals):
        right = np.einsum("ij,ij->i", vectors, normals[node]) > limits[node]
        node = 2 * node + 1 + right
    return node - len(normals)


def _nearest(sims: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ``most`` columns with the largest values, best first; the diagonal is left out."""
    np.fill_diagonal(sims, -np.inf)
    take = min(most, len(ids) - 1)
    order = np.argpartition(-sims, take - 1, axis=1)[:, :take] if take < len(ids) - 1 else None
    if order is None:
        order = np.argsort(-sims, axis=1, kind="stable")[:, :take]
        return ids[order], np.take_along_axis(sims, order, 1)
    values = np.take_along_axis(sims, order, 1)
    inside = np.argsort(-values, axis=1, kind="stable")
    order = np.take_along_axis(order, inside, 1)
    return ids[order], np.take_along_axis(sims, order, 1)


def _lists(ids: np.ndarray, nbrs: list, sims: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(nbrs, pa.list_(pa.int64())), pa.array(sims, pa.list_(pa.float32()))],
        ["id", "nbrs", "sims"],
    )


def _block(most: int) -> Callable[[pa.Table], pa.RecordBatch | None]:
    def work(group: pa.Table) -> pa.RecordBatch | None:
        ids, vectors = group.column("id").to_numpy(), _matrix(group.column("vec"))
        if len(ids) < 2:
            return None
        nbrs, sims = _nearest(vectors @ vectors.T, ids, most)
        return _lists(ids, list(nbrs), list(sims))

    return work


def _merged(lists: DataFrame, most: int) -> DataFrame:
    """Per id the best ``most`` of all its lists, each neighbour once."""

    def work(group: pa.Table) -> pa.RecordBatch:
        nbrs = np.concatenate([*map(np.asarray, group.column("nbrs").to_pylist())]).astype(np.int64)
        sims = np.concatenate([*map(np.asarray, group.column("sims").to_pylist())]).astype(np.float32)
        order = np.lexsort((nbrs, -sims))
        nbrs, sims = nbrs[order], sims[order]
        first = np.sort(np.unique(nbrs, return_index=True)[1])[:most]
        return _lists(group.column("id").to_numpy()[:1], [nbrs[first]], [sims[first]])

    return grouped(lists, ["id"], work, _GRAPH)


def first_graph(spark: SparkSession, items: DataFrame, rows: int, trees: int = TREES, most: int = NEIGHBOURS) -> DataFrame:
    """Neighbour lists from the blocks of several trees; ``items`` is a stored table of ``id, vec``."""
    share = max(1, -(-rows // SAMPLE))
    drawn = items.where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(share)) == 0).limit(2 * SAMPLE)
    sample = _matrix(pa.array([row["vec"] for row in drawn.select("vec").orderBy("id").collect()], pa.binary()))
    depth = 0
    while rows > BLOCK * 2**depth and len(sample) >= LEAST_IN_LEAF * 2 ** (depth + 1):
        depth += 1
    fitted = [fit_tree(sample, depth, np.random.default_rng(SEED + t)) for t in range(trees if depth else 1)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vec"))
            for t, tree in enumerate(fitted):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("vec"), pa.array(np.full(len(vectors), t), pa.int32()),
                     pa.array(leaves(vectors, tree), pa.int64())],
                    ["id", "vec", "tree", "leaf"],
                )

    dealt = items.mapInArrow(assign, "id long, vec binary, tree int, leaf long")
    # A row per leaf, of which there are at most TREES * SAMPLE / LEAST_IN_LEAF.
    counts = dealt.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("id", "tree"), "parts")
    blocks = dealt.join(F.broadcast(counts), ["tree", "leaf"]).withColumn("part", part)
    near = grouped(blocks.select("id", "vec", "tree", "leaf", "part"), ["tree", "leaf", "part"], _block(most), _GRAPH)
    # An item alone in its blocks has no list.
    return stored(spark, _merged(near, most), "graph")


# Descent -------------------------------------------------------------------------------------


def _links(graph: DataFrame) -> DataFrame:
    return graph.select("id", F.explode("nbrs").alias("nbr"))


def descend(spark: SparkSession, items: DataFrame, graph: DataFrame, most: int = NEIGHBOURS) -> DataFrame:
    """One round: the members of every item's neighbourhood are compared with each other."""
    links = _links(graph)
    # In how many groups an item gathers those that have it as a neighbour.
    counts = links.groupBy(F.col("nbr").alias("centre")).agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    back = links.select(F.col("nbr").alias("centre"), F.col("id").alias("member")).join(counts, "centre")
    back = back.select("centre", F.pmod(F.xxhash64("member"), "groups").alias("part"), "member")
    ahead = links.select(F.col("id").alias("centre"), F.col("nbr").alias("member")).join(counts, "centre", "left")
    parts = F.sequence(F.lit(0).cast("long"), F.coalesce("groups", F.lit(1)) - 1)
    ahead = ahead.select("centre", F.explode(parts).alias("part"), "member")
    farthest = F.when(F.size("nbrs") >= most, F.element_at("sims", -1)).otherwise(F.lit(-2.0).cast("float"))
    known = items.join(graph.select("id", farthest.alias("farthest")), "id", "left")
    members = ahead.union(back).distinct().join(known, F.col("member") == F.col("id")).select(
        "centre", "part", "id", "vec", F.coalesce("farthest", F.lit(-2.0).cast("float")).alias("farthest")
    )

    def work(group: pa.Table) -> pa.RecordBatch | None:
        ids, vectors = group.column("id").to_numpy(), _matrix(group.column("vec"))
        if len(ids) < 2:
            return None
        nbrs, sims = _nearest(vectors @ vectors.T, ids, most)
        better = sims > group.column("farthest").to_numpy()[:, None]
        rows = np.flatnonzero(better.any(axis=1))
        if not len(rows):
            return None
        return _lists(ids[rows], [nbrs[r][better[r]] for r in rows], [sims[r][better[r]] for r in rows])

    found = grouped(members, ["centre", "part"], work, _GRAPH)
    return stored(spark, _merged(found.union(graph), most), "graph")


# Search --------------------------------------------------------------------------------------

_WALK = "query long, qvec binary, nodes array<long>, sims array<float>, done array<boolean>"


def walk(
    spark: SparkSession, items: DataFrame, graph: DataFrame, starts: DataFrame, also: list[int], kept: int = KEPT
) -> DataFrame:
    """``query, nodes``: the best items that walks from the items ``starts`` (stored, column ``id``) find.

    ``also`` are a few items that every walk scores as well.
    """
    state = stored(
        spark,
        starts.join(items, "id").select(
            F.col("id").alias("query"),
            F.col("vec").alias("qvec"),
            F.array("id").alias("nodes"),
            F.array(F.lit(float("inf")).cast("float")).alias("sims"),
            F.array(F.lit(False)).alias("done"),
        ),
        "walks",
    )
    for hop in range(HOPS):
        state = stored(spark, _hop(state, items, graph, also if hop == 0 else [], kept), "walks")
        if state.where(F.exists("done", lambda done: ~done)).isEmpty():
            break
    else:
        warnings.warn(f"walks ended after {HOPS} rounds with items left to expand", stacklevel=2)
    return state.select("query", "nodes")


def _hop(state: DataFrame, items: DataFrame, graph: DataFrame, also: list[int], kept: int) -> DataFrame:
    open_nodes = F.filter(F.arrays_zip("nodes", "done"), lambda n: ~n["done"])
    chosen = F.slice(F.transform(open_nodes, lambda n: n["nodes"]), 1, EXPANDED)
    ahead = state.select("query", F.explode(chosen).alias("id")).join(graph.select("id", "nbrs"), "id")
    ahead = ahead.select("query", F.explode("nbrs").alias("id"))
    if also:
        ahead = ahead.union(state.select("query", F.explode(F.lit(also).cast("array<long>")).alias("id")))
    fresh = ahead.distinct().join(items, "id")
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in
             (("qvec", "binary"), ("nodes", "array<long>"), ("sims", "array<float>"), ("done", "array<boolean>"))]
    rows = fresh.select("query", "id", "vec", *empty).union(
        state.select("query", F.lit(None).cast("long"), F.lit(None).cast("binary"), "qvec", "nodes", "sims", "done")
    )

    def work(group: pa.Table) -> pa.RecordBatch:
        is_state = np.asarray(group.column("qvec").is_valid())
        own = group.filter(pa.array(is_state)).slice(0, 1).to_pylist()[0]
        new = group.filter(pa.array(~is_state))
        nodes, sims = np.asarray(own["nodes"], np.int64), np.asarray(own["sims"], np.float32)
        done = np.asarray(own["done"], bool)
        done[np.flatnonzero(~done)[:EXPANDED]] = True
        if new.num_rows:
            ids = new.column("id").to_numpy()
            unseen = ~np.isin(ids, nodes)
            asked = np.frombuffer(own["qvec"], np.float16).astype(np.float32)
            # What a query asks for is the product of the vectors, without the added component.
            scored = _matrix(new.column("vec"))[:, :-1] @ asked[:-1]
            nodes = np.concatenate([nodes, ids[unseen]])
            sims = np.concatenate([sims, scored[unseen]])
            done = np.concatenate([done, np.zeros(int(unseen.sum()), bool)])
            order = np.lexsort((nodes, -sims))[: kept + 1]
            nodes, sims, done = nodes[order], sims[order], done[order]
        return pa.RecordBatch.from_arrays(
            [pa.array([own["query"]], pa.int64()), pa.array([own["qvec"]], pa.binary()),
             pa.array([nodes], pa.list_(pa.int64())), pa.array([sims], pa.list_(pa.float32())),
             pa.array([done], pa.list_(pa.bool_()))],
            ["query", "qvec", "nodes", "sims", "done"],
        )

    return grouped(rows, ["query"], work, _WALK)


# All together ----------------------------------------------------------------------------------


def gather(spark: SparkSession, vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored tables: ``members`` (row, vec_id, id), a row each, and ``originals`` (id, vector, length, band), an item each."""
    rows = stored(spark, usable(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    # Only vectors of the commonest length are comparable.
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    if common:
        rows = rows.where(F.size("vector") == common["size"])
    firsts = rows.groupBy("vector").agg(F.min("row").alias("id"))
    # Scaled by the largest component, so that squares neither overflow nor vanish.
    widest = F.array_max(F.transform("vector", F.abs))
    unit = F.transform("vector", lambda x: x / widest)
    items = stored(spark, firsts.select("id", "vector", (widest * F.sqrt(inner_of(unit))).alias("length")), "lengths")
    longest = items.agg(F.max("length")).first()[0] or 1.0
    band = F.floor(F.log2(F.lit(longest) / F.col("length"))).cast("int")
    originals = stored(spark, items.withColumn("band", band), "originals")
    members = stored(spark, rows.join(originals, "vector").select("row", "vec_id", "id"), "members")
    return members, originals


def inner_of(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)


def build(spark: SparkSession, scaled: DataFrame, largest: float, count: int, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Stored tables: ``items`` (id, vec) and their graph, from ``count`` vectors that are at most ``largest`` long."""
    items = stored(spark, scaled.mapInArrow(_augmented(largest), "id long, vec binary"), "items")
    graph = first_graph(spark, items, count)
    nearness = F.sum(F.aggregate("sims", F.lit(0.0), lambda total, sim: total + sim + 1.0))
    before = graph.agg(nearness).first()[0] or 0.0
    for _ in range(rounds):
        graph = descend(spark, items, graph)
        after = graph.agg(nearness).first()[0] or 0.0
        if after <= before * (1 + LEAST_GAIN):
            break
        before = after
    else:
        warnings.warn(f"descent ended after {rounds} rounds, before lists gained less than {LEAST_GAIN}", stacklevel=2)
    return items, graph


def _walked(spark: SparkSession, originals: DataFrame, starts: DataFrame, band: int, count: int, kept: int) -> DataFrame:
    """``query, id``: what walks of all queries find in a band of ``count`` items."""
    own = originals.where(F.col("band") == band)
    lengths = own.orderBy(F.desc("length"), "id").limit(LONGEST).select("id", "length").collect()
    largest = lengths[0]["length"]
    guests = originals.where(F.col("band") != band).join(starts, "id")
    guests = guests.select("id", F.transform("vector", lambda x: x / F.col("length") * F.lit(largest)).alias("vector"))
    scaled = own.select("id", "vector").union(guests)
    items, graph = build(spark, scaled, largest, count + guests.count())
    found = walk(spark, items, graph, starts, [row["id"] for row in lengths], kept)
    return found.select("query", F.explode("nodes").alias("id"))


def _scored_whole(spark: SparkSession, originals: DataFrame, starts: DataFrame, bands: list[int], most: int) -> DataFrame:
    """``query, id``: the best of some bands of at most a block each, by the products with all their items.

    Ties with the last one are kept.
    """
    held = originals.where(F.col("band").isin(bands)).select("id", "vector").orderBy("id").collect()
    ids = np.array([row["id"] for row in held], np.int64)
    shared = spark.sparkContext.broadcast((ids, np.array([row["vector"] for row in held], np.float64)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        for batch in batches:
            for query, vector in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                with np.errstate(over="ignore"):
                    scores = matrix @ np.asarray(vector)
                least = np.partition(scores, -most)[-most] if len(scores) > most else -np.inf
                best = ids[scores >= least - 1e-9 * abs(least)] if np.isfinite(least) else ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), query, np.int64)), pa.array(best)], ["query", "id"]
                )

    return originals.select("id", "vector").join(starts, "id").mapInArrow(work, "query long, id long")


def nearest(
    spark: SparkSession, vectors: DataFrame, every: int = 20, most: int = 20, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id ``every`` divides, the ``most`` nearest found.

    Nearest is the largest inner product in double precision; ties go to the smaller id, and a row is no
    candidate of its own.  With fewer candidates all are returned.  Rows with the same id are queries and candidates each.  Which rows
    take part is said at :func:`usable`; of different numbers of components the commonest does.  Other columns are not read.
    """
    renamed = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector).alias("embedding"))
    members, originals = gather(spark, renamed)
    asked = members.where(F.pmod("vec_id", F.lit(every)) == 0)
    starts = stored(spark, asked.select("id").distinct(), "starts")
    counts = originals.groupBy("band").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "band").collect()
    kept, pairs, small = max(KEPT, most + 1), [], []
    for place, row in enumerate(counts):  # bands are powers of two between the shortest and the longest
        if place and row["n"] <= BLOCK:
            small.append(row["band"])
        else:
            pairs.append(_walked(spark, originals, starts, row["band"], row["n"], kept))
    for first in range(0, len(small), 16):
        pairs.append(_scored_whole(spark, originals, starts, small[first : first + 16], most + 1))
    if not pairs:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = reduce(DataFrame.union, pairs)
    found = found.distinct() if len(pairs) > 1 else found
    scored = found.join(originals.select("id", "vector"), "id").join(
        originals.select(F.col("id").alias("query"), F.col("vector").alias("asked")), "query"
    ).select("query", "id", inner("vector", "asked").alias("score"))
    # Copies of an item: the first ones in order of id are enough, the query itself among them.  A
    # hot item is cut down per part first.
    part = F.pmod(F.xxhash64("row"), F.lit(64))
    for keys in (["id", part], ["id"]):
        order = Window.partitionBy(*keys).orderBy("vec_id", "row")
        members_cut = (members if len(keys) == 2 else members_cut).withColumn("nth", F.row_number().over(order))
        members_cut = members_cut.where(F.col("nth") <= most + 1).drop("nth")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    per_item = scored.join(members_cut, "id").withColumn("nth", F.row_number().over(order))
    best = per_item.where(F.col("nth") <= most + 1).select("query", "row", "vec_id", "score")
    queries = asked.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("id").alias("query"))
    answers = queries.join(best, "query").where("row != query_row")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return (
        answers.withColumn("rank", rank).where(F.col("rank") <= most).select("query_id", "rank", "vec_id", "score")
    )
