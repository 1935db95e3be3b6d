"""Near copies by SimHash fingerprints and a tiled exact comparison.

A text's fingerprint has a bit set where more than half of the XXH64 values of its word shingles have.
Equal fingerprints are one from the start. Distinct ones are dealt into tiles by their profile, the population
counts of their `SECTIONS` sections: fingerprints that differ in at most `radius` bits have profiles that
differ by at most that in sum, so only tiles of such profiles are paired. A pair of tiles is compared in
full with exclusive-or and bit counts. Of the links in it only a spanning forest is kept, so that
a group of near copies costs as many rows as it has members in a tile, and no component changes.
"""

from __future__ import annotations

from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.components import connected_components
from partwise.llm.tables import id_and_text, in_slices, materialise

SECTIONS = 4
WIDTH = 64 // SECTIONS
TILE = 4096
AT_ONCE = 1 << 18  # comparisons whose bit counts are held at a time
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(raw: bytes, words: int, seed: int) -> int:
    """Of a text's shingles with repeats, A-Z in lower case, cut at ASCII white space; 0 without words."""
    cut = raw.lower().split()
    if not cut:
        return 0
    size = min(words, len(cut))
    n = len(cut) - size + 1
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    hashed = map(digest, map(b" ".join, zip(*[cut[i : i + n] for i in range(size)])))
    set_bits = np.zeros(64, np.int64)
    for start in range(0, n, SHINGLES_AT_ONCE):
        values = np.fromiter(hashed, np.dtype("<u8"), min(SHINGLES_AT_ONCE, n - start))
        set_bits += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int, seed: int) -> DataFrame:
    """(id, fp: the fingerprint as a signed number)"""

    def sign(batches):
        for batch in in_slices(batches):
            found = np.array([fingerprint(raw, words, seed) for raw in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return id_and_text(docs, id_col, text_col).mapInArrow(sign, f"id {id_type}, fp long")


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int):
    """Indexes (i, j) of all pairs that differ in at most radius bits, in blocks of a few rows of a."""
    rows = max(1, AT_ONCE // len(b))
    for start in range(0, len(a), rows):
        i, j = np.nonzero(np.bitwise_count(a[start : start + rows, None] ^ b[None, :]) <= radius)
        yield i + start, j


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (x, y) that join what the near pairs of a and b join, at most one for each fingerprint."""
    label = np.arange(len(a) + len(b))
    for i, j in near_pairs(a, b, radius):
        j = j + len(a)
        while True:
            least = np.minimum(label[i], label[j])
            if (label[i] == least).all() and (label[j] == least).all():
                break
            for ends in (i, j):
                np.minimum.at(label, label[ends], least)
                np.minimum.at(label, ends, least)
            label = label[label]
    while not (label == label[label]).all():
        label = label[label]
    hung = np.flatnonzero(label != np.arange(len(label)))
    both = np.concatenate([a, b])
    return both[hung], both[label[hung]]


def compare(batches, radius: int):
    for batch in batches:
        left, right = [], []
        columns = [batch.column(c) for c in (0, 1)]
        ends = [np.asarray(c.offsets) for c in columns]
        values = [np.asarray(c.values).view(np.uint64) for c in columns]
        for k in range(batch.num_rows):
            a, b = (v[e[k] : e[k + 1]] for v, e in zip(values, ends))
            if len(a) * len(b) <= AT_ONCE:
                i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
                if len(i) <= len(a) + len(b):
                    left.append(a[i])
                    right.append(b[j])
                    continue
            x, y = forest(a, b, radius)
            left.append(x)
            right.append(y)
        joined = [np.concatenate(c) if c else np.empty(0, np.uint64) for c in (left, right)]
        different = joined[0] != joined[1]
        yield pa.RecordBatch.from_arrays([pa.array(c[different].view(np.int64)) for c in joined], ["a", "b"])


def tile_links(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join all fingerprints (fp) within radius bits of each other."""
    base = 2 * (WIDTH + radius + 1)
    section = (1 << WIDTH) - 1
    profile = sum(
        F.bit_count(F.shiftrightunsigned("fp", WIDTH * s).bitwiseAND(F.lit(section))).cast("bigint") * base**s for s in range(SECTIONS)
    )
    profiled = distinct.withColumn("profile", profile)
    # as many rows as there are profiles: 17 ** 4 at most, whatever the table
    held = materialise(profiled.groupBy("profile").agg(F.ceil(F.count("*") / tile).alias("n_tiles")), "profiles")
    tiles = materialise(
        profiled.join(F.broadcast(held), "profile")
        .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("n_tiles")))
        .groupBy("profile", "tile").agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    steps = [sum(d * base**s for s, d in enumerate(delta)) for delta in product(range(-radius, radius + 1), repeat=SECTIONS)
             if sum(map(abs, delta)) <= radius]
    near = F.explode(F.array(*[F.lit(s).cast("bigint") for s in steps if s >= 0]))
    home = tiles.select(F.col("profile").alias("from"), F.col("tile").alias("from_tile"), F.col("fps").alias("a"), near.alias("step"))
    sent = (
        home.withColumn("profile", F.col("from") + F.col("step"))
        .join(F.broadcast(held), "profile")  # only profiles that there are
        .withColumn("tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_tiles") - 1)))
        .where("step > 0 or from_tile <= tile")
    )
    pairs = sent.select("profile", "tile", "a").join(tiles, ["profile", "tile"]).select("a", F.col("fps").alias("b"))
    return pairs.mapInArrow(partial(compare, radius=radius), "a long, b long")


def simhash_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, radius: int = 3, seed: int = 42
) -> DataFrame:
    """(id_col, fingerprint, component_id, links) for each row of docs.

    fingerprint is 16 lower-case hex digits. Texts are linked where their fingerprints differ in at most
    radius bits; component_id is the least id that links reach, the row's own included. A text of fewer words is one shingle; one
    without words, or null, has fingerprint zero and is linked like any other. Rows with equal ids
    are rows of their own. A null id takes part, but is never the least: where a component
    has null ids only, component_id is null. links counts the rows with the same fingerprint, the row
    itself left out. Other columns are ignored; very long texts are read whole, a piece of their
    shingles at a time; an empty table gives an empty result.
    """
    signed = materialise(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    classes = materialise(signed.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("held")), "classes")
    links = materialise(tile_links(classes.select("fp"), radius), "links")
    roots = connected_components(links).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    component = materialise(rooted.join(least, "root").select("fp", "component_id", "held"), "components")
    return signed.join(component, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("held") - 1).alias("links"),
    )
