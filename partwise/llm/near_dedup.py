"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document is its set of word shingles. Its sketch has `BINS` bins. In round i every shingle is hashed
into one bin with a value that is greater than all of the rounds before, and a bin keeps the least it
gets; the rounds end when all bins are filled. After BINS rounds each further round sends all
shingles to one bin, so that every bin is filled for the smallest set. Two sets agree in a bin with a
chance of their Jaccard similarity, and the shares over bins are as close to it as with independent
hash functions.

Bins are cut into bands; documents that agree in a band are candidates, and the full sets decide.
Documents with equal sets are one class from the start. In a bucket of classes each is first compared
with one centre, the class with the fewest shingles that no other candidate has. Classes that this
leaves apart are then compared with the others of their buckets, but for pairs that counting rules
out: two sets share at most the shingles that neither has alone, and similar sets share one of their
rarest. So no bucket is cut, and a large group of copies costs about its size: near ones hang on the
centre, and those far from it meet the few that share their own changes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm.components import connected_components
from partwise.llm.tables import id_and_text, in_slices, materialise

BINS, ROWS = 256, 6  # 42 bands of 6 bins: a pair of similarity 0.8 is missed 3 times in a million
BANDS = BINS // ROWS
ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]  # splitmix64
EMPTY = np.uint64(2**64 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * ODD[1]
    x = (x ^ (x >> np.uint64(27))) * ODD[2]
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text, A-Z in lower case, cut at ASCII white space."""
    cut = raw.lower().split()
    if not cut:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, cut), np.uint64, len(cut))
    size = min(words, len(cut))
    made = np.full(len(cut) - size + 1, size, np.uint64)
    for i in range(size):
        made = mix(made * ODD[0] + each[i : len(cut) - size + 1 + i])
    return np.unique(made)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BINS values for each set that is not empty."""
    filled = np.full(len(sets) * BINS, EMPTY)
    items = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for turn in range(2 * BINS):
        hashed = mix(items + np.uint64(int(ODD[0]) * (turn + 1) % 2**64))
        bins = (hashed & np.uint64(BINS - 1)).astype(np.int64) if turn < BINS else turn - BINS
        np.minimum.at(filled, of * BINS + bins, (np.uint64(turn) << np.uint64(48)) | (hashed >> np.uint64(16)))
        if turn % 4 == 0 or turn < 4:
            missing = (filled.reshape(-1, BINS) == EMPTY).any(1)
            if not missing.any():
                break
            going = missing[of]
            if not going.all():
                items, of = items[going], of[going]
    return filled.reshape(-1, BINS)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    bands = sketch[:, : BANDS * ROWS].reshape(len(sketch), BANDS, ROWS)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sketch), 1))
    for i in range(ROWS):
        keys = mix(keys * ODD[0] + bands[:, :, i])
    return keys.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, text_hash, n_shingles, set: digest of the set, bands); set and bands are null for empty sets."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def sign(batches):
        for batch in in_slices(batches):
            sets = [shingles(raw, words) for raw in batch.column(2).to_pylist()]
            some = [s for s in sets if len(s)]
            keys = iter(band_keys(sketches(some)).tolist() if some else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["id", "text_hash", "n_shingles", "set", "bands"],
            )

    return id_and_text(docs, id_col, text_col).select("id", F.xxhash64("raw").alias("text_hash"), "raw").mapInArrow(
        sign, f"id {id_type}, text_hash long, n_shingles long, set binary, bands array<long>"
    )


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(set, items, and the digest as two numbers) for wanted (set, least id)."""

    def unfold(batches):
        for batch in in_slices(batches):
            sets = [shingles(raw, words) for raw in batch.column(1).to_pylist()]
            items = [s.view(np.int64) for s in sets]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            same = [d == w for d, w in zip(digests, batch.column(0).to_pylist())]  # ids may be repeated
            digests = [d for d, s in zip(digests, same) if s]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    pa.array([i for i, s in zip(items, same) if s], pa.list_(pa.int64())),
                    pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                ],
                ["set", "items", "x", "y"],
            )

    texts = id_and_text(docs, id_col, text_col).join(wanted, "id").select("set", "raw")
    return texts.mapInArrow(unfold, "set binary, items array<long>, x long, y long").dropDuplicates(["set"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("set").alias("a"), F.col("items").alias("a_items"))
    right = sets.select(F.col("set").alias("b"), F.col("items").alias("b_items"))
    common = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - common
    return pairs.join(left, "a").join(right, "b").where(100 * common >= percent * union).select("a", "b")


def _private(sets: DataFrame) -> DataFrame:
    """(set, own): how many of its shingles no other of these sets has."""
    alone = (
        sets.select("x", "y", F.explode("items").alias("item")).groupBy("item")
        .agg(F.count("*").alias("m"), F.min("x").alias("x"), F.min("y").alias("y")).where("m = 1")
        .groupBy("x", "y").agg(F.count("*").alias("own"))
    )
    return sets.select("set", "x", "y").join(alone, ["x", "y"], "left").select("set", F.coalesce("own", F.lit(0)).alias("own"))


def _fits(n: str, own: str, m: str, m_own: str, percent: int):
    """Sets of n and m shingles, of which own and m_own in no other set, can be similar enough."""
    common = F.least(F.col(n) - F.col(own), F.col(m) - F.col(m_own))
    return 100 * common >= percent * (F.col(n) + F.col(m) - common)


def _hopeful(n: str, own: str, least: str, percent: int):
    """So can one of n shingles and some set of at least `least`: best is one that has all but its own."""
    common = F.col(n) - F.col(own)
    return 100 * common >= percent * (F.col(n) + F.greatest(F.col(least), common) - common)


def _by_rare_shingles(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes in different components that may be similar enough, one of them outside
    the largest component of a bucket.

    With shingles in one order, rare ones first, sets with at least c in common share one among the
    first n - c + 1 of each. c follows from the sizes: no partner is smaller than the bucket's least.
    Where two sets share the first of their common shingles, they have no more in common than what
    comes from there on in each. So those far off that merely share a passage of the group are no pairs.
    """
    one = apart.groupBy("set").agg(
        F.first("n").alias("n"), F.first("own").alias("own"), F.first("root").alias("root"),
        F.min("least_n").alias("least"), F.max(F.col("root") != F.col("largest")).alias("minor"),
    )
    common = F.ceil(percent * (F.col("n") + F.greatest(F.ceil(percent * F.col("n") / 100), F.col("least"))) / (100 + percent) - 1e-9)
    items = materialise(
        one.withColumn("first", F.col("n") - common + 1).join(sets.select("set", F.explode("items").alias("item")), "set"), "items"
    )
    held = items.groupBy("item").agg(F.count("*").alias("m")).where("m > 1")
    order = Window.partitionBy("set").orderBy(F.coalesce("m", F.lit(1)), "item")
    early = (
        items.join(held, "item", "left").withColumn("place", F.row_number().over(order))
        .where("place <= first and m > 1").withColumn("rest", F.col("n") - F.col("place") + 1).drop("m", "place", "first", "least")
    )
    early = materialise(early, "early")
    minor = early.where("minor").select("item", *[F.col(c).alias(f"{c}_") for c in ("set", "n", "own", "root", "rest")])
    common = F.least("rest", "rest_")
    return (
        minor.join(early, "item").where("root != root_").where(_fits("n", "own", "n_", "own_", percent))
        .where(100 * common >= percent * (F.col("n") + F.col("n_") - common))
        .where("set_ < set or not minor")
        .select(F.least("set", "set_").alias("a"), F.greatest("set", "set_").alias("b")).distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept, text_hash) for each row of docs.

    Documents are linked where 100 * intersection >= percent * union of their sets of distinct `words`-word
    shingles; a text of fewer words is one shingle, and one without words (or null) is empty and linked
    with nothing. component_id is the least id that links reach, kept says it is the document's own. Rows
    with equal ids are documents of their own: equal texts share a class, and each such row is kept if the
    class's least id is its own. Rows with a null id are linked with nothing and kept, with a null
    component_id. text_hash (xxhash64 of the UTF-8 bytes, null as empty) tells rows with equal ids apart. Other
    columns are ignored; an empty table gives an empty result.
    """
    signed = materialise(signatures(docs, id_col, text_col, words), "signatures")
    usable = signed.where("id is not null and n_shingles > 0")
    classes = materialise(
        usable.groupBy("set").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    in_band = classes.select("set", "id", "n", F.explode("bands").alias("bucket"))
    shared = in_band.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    # members of buckets with company, which are a small part of all
    members = materialise(in_band.join(shared, "bucket"), "members")
    sets = materialise(
        _full_sets(docs, members.select("set", "id").distinct(), id_col, text_col, words), "sets"
    )
    members = materialise(members.select("bucket", "set", "n").join(_private(sets), "set"), "profiled")
    centres = members.groupBy("bucket").agg(F.min(F.struct("own", "set", "n")).alias("c")).select(
        "bucket", F.col("c.set").alias("centre"), F.col("c.n").alias("c_n"), F.col("c.own").alias("c_own")
    )
    star = materialise(
        members.join(centres, "bucket").where("set != centre").where(_fits("n", "own", "c_n", "c_own", percent))
        .select(F.col("centre").alias("a"), F.col("set").alias("b")).distinct(),
        "star",
    )
    links = materialise(_verified(star, sets, percent), "links")
    found = connected_components(links)

    # What one centre leaves apart: in each bucket all but its largest component against the rest.
    labelled = members.join(found.withColumnRenamed("node", "set"), "set", "left")
    labelled = materialise(labelled.select("bucket", "set", "n", "own", F.coalesce("root", "set").alias("root")), "labelled")
    by_root = labelled.groupBy("bucket", "root").agg(F.count("*").alias("m"), F.min("n").alias("n"))
    mixed = (
        by_root.groupBy("bucket")
        .agg(F.count("*").alias("roots"), F.max(F.struct("m", "root"))["root"].alias("largest"), F.min("n").alias("least_n"))
        .where("roots > 1").drop("roots")
    )
    apart = labelled.join(mixed, "bucket").where(_hopeful("n", "own", "least_n", percent))
    rest = _by_rare_shingles(apart, sets, percent).join(
        star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"
    )
    more = materialise(_verified(materialise(rest, "rest"), sets, percent), "more-links")
    roots = connected_components(links.union(more)) if more.limit(1).count() else found

    rooted = classes.select("set", "id").join(roots.withColumnRenamed("node", "set"), "set", "left")
    rooted = rooted.select("set", "id", F.coalesce("root", "set").alias("root"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    component = rooted.join(least, "root").select("set", "component_id")
    return (
        signed.drop("bands").join(component, "set", "left")
        .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))
        .select(
            F.col("id").alias(id_col), "n_shingles", "component_id",
            F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"), "text_hash",
        )
    )
