"""Nearest neighbours by an adaptive scan over dimensions, inside the probed lists of an inverted index.

Vectors are centred on a mean, so that distances far from the origin keep their digits, and rotated by a
random orthogonal matrix, which keeps distances and spreads them evenly over the dimensions, and assigned to the list of their nearest centroid. Lists are kept as blocks of at
most about `BLOCK` vectors. A query first scans the few lists nearest to it in full, which gives a bound on its
k-th distance. In its other lists rotated columns are added a few at a time: after d of D columns a
candidate goes if its partial squared distance, times D / d, exceeds the bound by more than the test
allows for so many columns. Exact distances of the original vectors rank what is left.

Centroids are fitted on a bounded sample (`sample_rows`); every vector is indexed. How many lists are
probed is measured: a bounded sample of the queries is compared with all vectors, and as many lists
are taken as hold the wanted share of their true neighbours.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm.tables import materialise

BLOCK = 512
SUPPRESS = 2.1  # deviations that the test allows a partial distance
FIRST_LISTS = 4
MOST_LISTS = 4096
PART = 16  # blocks of a list that meet a query in one row: a large list is many keys of the join
ROUNDING = 1e-13  # what a squared distance by norms and products may be wrong by, for each unit of the norms
SALTS = 64


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector as doubles), without rows that take no part; equal rows once."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    picked = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return picked.select(F.col(id_col).cast("bigint").alias("id"), v.cast("array<double>").alias("vector")).distinct()


def _first_of_equal(items: DataFrame, most: int) -> DataFrame:
    """Of equal vectors those with the least ids: no search can return more of them."""
    key = F.xxhash64("vector")
    salted = items.withColumn("_key", key).withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for by in (["_key", "vector", "_salt"], ["_key", "vector"]):
        salted = salted.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("_n") <= most)
    return salted.select("id", "vector")


def _packed(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column(0).to_numpy().astype(np.int64)
    return ids, batch.column(1).flatten().to_numpy().reshape(-1, dims).astype(np.float64)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0)


def _centroids(sample: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(0)
    centres = sample[rng.choice(len(sample), n, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([_squares(sample[i : i + 1024], centres).argmin(1) for i in range(0, len(sample), 1024)])
        for_each = np.bincount(near, minlength=n)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        centres = np.where(for_each[:, None] > 0, sums / np.maximum(1, for_each)[:, None], centres)
    return centres


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k nearest, ties to the lesser id."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores <= np.partition(scores, k - 1)[k - 1])
        return near[np.lexsort((ids[near], scores[near]))[:k]]
    return np.lexsort((ids, scores))[:k]


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - y) ** 2).sum(-1))


def _scan(q: dict, block: dict, dims: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates of a block for some queries: (position of the query, id, distance)."""
    bound = q["bound"][:, None] ** 2
    if np.isinf(bound).all():
        at, of = np.indices((len(q["ids"]), len(block["ids"]))).reshape(2, -1)
    else:
        done = min(dims, max(4, dims // 8))
        a, b = q["turned"][:, :done], block["turned"][:, :done]
        wrong = ROUNDING * ((a * a).sum(1)[:, None] + (b * b).sum(1)[None])
        at, of = np.nonzero((_squares(a, b) - wrong) * (dims / done) <= bound * (1 + SUPPRESS / math.sqrt(done)) ** 2)
        part = np.empty(len(at))
        for i in range(0, len(at), 1 << 16):  # differences, not products: no digits are lost from here on
            part[i : i + (1 << 16)] = ((a[at[i : i + (1 << 16)]] - b[of[i : i + (1 << 16)]]) ** 2).sum(1)
        while done < dims and len(at):
            more = min(dims, 2 * done)
            part = part + ((q["turned"][at, done:more] - block["turned"][of, done:more]) ** 2).sum(1)
            done = more
            slack = (1 + SUPPRESS / math.sqrt(done)) ** 2 if done < dims else 1 + 1e-9
            near_zero = 1e-24 * (q["norms"][at] + block["norms"][of])
            stay = part * (dims / done) <= bound[at, 0] * slack + near_zero
            at, of, part = at[stay], of[stay], part[stay]
    other = q["ids"][at] != block["ids"][of]
    at, of = at[other], of[other]
    score = np.empty(len(at))
    for i in range(0, len(at), 1 << 16):  # bounded memory
        score[i : i + (1 << 16)] = _exact(q["plain"][at[i : i + (1 << 16)]], block["plain"][of[i : i + (1 << 16)]])
    near = score <= q["bound"][at]
    at, of, score = at[near], of[near], score[near]
    keep = []
    starts = np.searchsorted(at, np.arange(len(q["ids"]) + 1))
    for i in range(len(q["ids"])):
        lo, hi = starts[i], starts[i + 1]
        if hi > lo:
            keep.append(lo + _best(block["ids"][of[lo:hi]], score[lo:hi], k))
    keep = np.concatenate(keep) if keep else np.empty(0, np.int64)
    return at[keep], block["ids"][of[keep]], score[keep]


class Index:
    """Blocks of all usable vectors by list, with what a search needs."""

    def __init__(self, blocks: DataFrame, parts: DataFrame, turn: np.ndarray, mean: np.ndarray, centres: np.ndarray) -> None:
        self.blocks, self.parts, self.turn, self.mean, self.centres = blocks, parts, turn, mean, centres


def build_index(items: DataFrame, dims: int, sample_rows: int, lists: int | None = None) -> Index:
    """Index of (id, vector) with `dims` components each; lists: by default the root of their number."""
    rows = items.count()

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_packed(batch, dims)[1].tobytes()], pa.binary())], ["x"])

    sample = items.sample(min(1.0, sample_rows / max(1, rows)), seed=1).mapInArrow(pack, "x binary").collect()
    parts = [np.frombuffer(r["x"], "<f8").reshape(-1, dims) for r in sample]
    turn = np.linalg.qr(np.random.default_rng(0).normal(size=(dims, dims)))[0]
    points = np.concatenate(parts) if parts else np.zeros((1, dims))
    mean = points.mean(0)
    points = points - mean
    n = min(len(points), MOST_LISTS, lists or max(1, math.isqrt(rows)))
    centres = _centroids(points, n)
    shared = items.sparkSession.sparkContext.broadcast(centres)

    def assign(batches):
        for batch in batches:
            ids, x = _packed(batch, dims)
            near = [_squares(x[i : i + 1024] - mean, shared.value).argmin(1) for i in range(0, len(x), 1024)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(near) if near else [], pa.int32()), pa.array(ids), pa.array([r.tobytes() for r in x], pa.binary())],
                ["list", "id", "x"],
            )

    assigned = items.mapInArrow(assign, "list int, id long, x binary")
    assigned = materialise(assigned, "assigned")
    sizes = assigned.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("bigint").alias("blocks"))
    sizes = materialise(sizes, "lists")  # at most MOST_LISTS rows
    cut = assigned.join(F.broadcast(sizes), "list").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))

    def fold(key, table):
        ids = table.column("id").to_numpy()
        x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float64).reshape(-1, dims)
        turned = ((x - mean) @ turn).astype("<f8")
        return pa.table({
            "list": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py() // PART], pa.int64()), "ids": [ids.astype("<i8").tobytes()],
            "plain": [x.astype("<f8").tobytes()], "turned": [turned.tobytes()],
        })

    blocks = cut.groupBy("list", "block").applyInArrow(fold, "list int, part long, ids binary, plain binary, turned binary")
    parts = sizes.select("list", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("blocks") - 1) / PART))).alias("part"))
    return Index(materialise(blocks, "index"), parts, turn, mean, centres)


def _probe(queries: DataFrame, index: Index, dims: int, k: int, first: int, last: int) -> DataFrame:
    """Scans of the lists first to last, by nearness, for (id, vector, bound): (query_id, vec_id, score)."""
    turn, mean = index.turn, index.mean
    shared = queries.sparkSession.sparkContext.broadcast(index.centres)

    def spread(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                ids, x = _packed(batch.slice(at, 128), dims)
                bound = batch.slice(at, 128).column(2).to_numpy()
                lists = np.argsort(_squares(x - mean, shared.value), axis=1, kind="stable")[:, first:last]
                chosen, order = lists.ravel(), np.repeat(np.arange(len(ids)), lists.shape[1])
                rank = np.argsort(chosen, kind="stable")
                chosen, order = chosen[rank], order[rank]
                cuts = np.flatnonzero(np.diff(chosen)) + 1
                groups = np.split(order, cuts) if len(chosen) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(chosen[np.r_[0, cuts]] if len(chosen) else [], pa.int32()),
                        *[pa.array([a[g].tobytes() for g in groups], pa.binary()) for a in (ids.astype("<i8"), x, bound.astype("<f8"))],
                    ],
                    ["list", "q_ids", "q_plain", "q_bound"],
                )

    def scan(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, kind: np.frombuffer(batch.column(batch.schema.get_field_index(name))[row].as_py(), kind)
                q = {"ids": get("q_ids", "<i8"), "plain": get("q_plain", "<f8").reshape(-1, dims), "bound": get("q_bound", "<f8")}
                q["turned"] = (q["plain"] - mean) @ turn
                block = {"ids": get("ids", "<i8"), "plain": get("plain", "<f8").reshape(-1, dims), "turned": get("turned", "<f8").reshape(-1, dims)}
                for side in (q, block):
                    side["norms"] = (side["turned"] ** 2).sum(1)
                at, ids, score = _scan(q, block, dims, k)
                yield pa.RecordBatch.from_arrays([pa.array(q["ids"][at]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

    probes = queries.select("id", "vector", "bound").mapInArrow(spread, "list int, q_ids binary, q_plain binary, q_bound binary")
    return probes.join(index.parts, "list").join(index.blocks, ["list", "part"]).select("q_ids", "q_plain", "q_bound", "ids", "plain", "turned").mapInArrow(
        scan, "query_id long, vec_id long, score double"
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # ids may be repeated
    return once.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def lists_needed(queries: DataFrame, index: Index, dims: int, k: int, wanted: float, sample_rows: int) -> int:
    """Lists to probe so that the wanted share of true neighbours of some queries lies in them."""
    n = queries.count()
    if not n:
        return 1
    some = queries.sample(min(1.0, sample_rows / n), seed=1).collect()
    if not some:  # so small a share may give none of a few queries
        some = queries.limit(sample_rows).collect()
    ids = np.array([r["id"] for r in some], np.int64)
    plain, mean = np.array([r["vector"] for r in some]) - index.mean, index.mean
    shared = queries.sparkSession.sparkContext.broadcast((ids, plain))

    def all_of(batches):
        for batch in batches:
            ids, plain = shared.value
            for row in range(batch.num_rows):
                list_ = batch.column(0)[row].as_py()
                block = np.frombuffer(batch.column(1)[row].as_py(), "<i8")
                score = _squares(plain, np.frombuffer(batch.column(2)[row].as_py(), "<f8").reshape(-1, dims) - mean)
                score[ids[:, None] == block[None]] = np.inf
                near = np.argsort(score, axis=1)[:, :k]
                q = np.repeat(np.arange(len(ids)), near.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(np.full(len(q), list_), pa.int64()), pa.array(np.take_along_axis(score, near, 1).ravel())],
                    ["query_id", "vec_id", "score"],
                )

    near = index.blocks.select("list", "ids", "plain").mapInArrow(all_of, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    lists = near.withColumn("n", F.row_number().over(best)).where((F.col("n") <= k) & (F.col("score") < float("inf"))).collect()
    if not lists:
        return 1
    order = np.argsort(_squares(plain, index.centres), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    needed = np.sort([place[r["query_id"], r["vec_id"]] for r in lists])
    return int(needed[min(len(needed) - 1, math.ceil(wanted * len(needed)) - 1)]) + 1


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    wanted_recall: float = 0.97, sample_rows: int = 16_384, sample_queries: int = 200,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of vectors found for each row of queries.

    Nearness is the Euclidean distance of the original vectors in double precision, ties go to the lesser
    id, and a query's own id is no candidate of its own; fewer candidates give fewer rows. Ids are
    integers. Rows whose id or vector is null, whose vector is zero or holds a null or non-finite
    component take no part; equal rows count once. A query is compared with the vectors of its own length,
    for to others there is no distance: each length that a query has is searched in an index of its own.
    Other columns are ignored. Without vectors or queries the result is empty.
    """
    items = materialise(usable(vectors, id_col, vector_col).withColumn("dims", F.size("vector")), "usable")
    asked = usable(queries, id_col, vector_col).withColumn("dims", F.size("vector"))
    lengths = sorted(r["dims"] for r in asked.select("dims").distinct().collect())
    found = [
        _nearest_of_length(
            *(x.where(F.col("dims") == dims).drop("dims") for x in (items, asked)), k, dims, wanted_recall, sample_rows, sample_queries
        )
        for dims in lengths
    ]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.union, found)


def _nearest_of_length(
    items: DataFrame, asked: DataFrame, k: int, dims: int, wanted_recall: float, sample_rows: int, sample_queries: int
) -> DataFrame:
    asked = materialise(asked.withColumn("bound", F.lit(float("inf"))), "queries")
    index = build_index(materialise(_first_of_equal(items, k + 1), "vectors"), dims, sample_rows)
    lists = max(FIRST_LISTS, lists_needed(asked, index, dims, k, wanted_recall, sample_queries))

    near = materialise(_top(_probe(asked, index, dims, k, 0, FIRST_LISTS), k), "near")
    bounds = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), (F.col("score") * (1 + 1e-12)).alias("k_th"))
    bounded = asked.join(bounds, "id", "left").withColumn("bound", F.coalesce("k_th", "bound"))
    far = _probe(bounded, index, dims, k, FIRST_LISTS, lists)
    found = _top(near.select("query_id", "vec_id", "score").union(far), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
