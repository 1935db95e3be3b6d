"""Digests of parts and objects, and comparison of what is there with what should be."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.limits import BLOCK_BITS, READ_BUFFER

# Digests Spark computes itself; every other name goes through hashlib in the fold.
_BUILTIN = {
    "md5": F.md5,
    "sha1": F.sha1,
    "sha224": lambda c: F.sha2(c, 224),
    "sha256": lambda c: F.sha2(c, 256),
    "sha384": lambda c: F.sha2(c, 384),
    "sha512": lambda c: F.sha2(c, 512),
    "crc32": lambda c: F.lpad(F.lower(F.hex(F.crc32(c))), 8, "0"),
}


class InvalidChecksumAlgorithm(ValueError):
    """The digest has no such name (exit code 9)."""

    exit_code = 9


def check_algorithm(algo: str) -> None:
    if algo in _BUILTIN:
        return
    try:
        known = hashlib.new(algo).digest_size > 0
    except ValueError:
        known = False
    if not known:
        raise InvalidChecksumAlgorithm(f"no digest {algo!r} of fixed length")


def new_hash(algo: str):
    """An object with update(bytes) and hexdigest()."""
    if algo != "crc32":
        return hashlib.new(algo)
    import zlib

    class Crc32:
        value = 0

        def update(self, data: bytes) -> None:
            self.value = zlib.crc32(data, self.value)

        def hexdigest(self) -> str:
            return f"{self.value:08x}"

    return Crc32()


def digest(content: Column, algo: str = "md5") -> Column:
    check_algorithm(algo)
    if algo not in _BUILTIN:
        raise InvalidChecksumAlgorithm(f"{algo!r} is no built-in digest: use object_digests")
    return _BUILTIN[algo](content)


def part_digests(parts: DataFrame, algo: str = "md5") -> DataFrame:
    """(object_id, part_num, size, <algo>): one pass where the bytes are, no shuffle."""
    return parts.select(
        "object_id",
        "part_num",
        F.length("bytes").cast("bigint").alias("size"),
        digest(F.col("bytes"), algo).alias(algo),
    )


def _fold(ordered: DataFrame, algo: str, value: str) -> DataFrame:
    """One digest for each object over value in row order, with one hash state at a time.

    ordered holds all rows of an object in one partition, next to each other and in order.
    """

    names = ["object_id", "digest"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, id_type = None, None, pa.int64()
        for batch in batches:
            done_ids, done, id_type = [], [], batch.column(0).type
            for object_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if state is None or object_id != current:
                    if state is not None:
                        done_ids.append(current)
                        done.append(state.hexdigest())
                    current, state = object_id, new_hash(algo)
                if data.is_valid:
                    state.update(data.as_buffer())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(done_ids, id_type), pa.array(done)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], id_type), pa.array([state.hexdigest()])], names)

    id_type = ordered.schema["object_id"].dataType.simpleString()
    return ordered.select("object_id", value).mapInArrow(fold, f"object_id {id_type}, digest string")


def fold_digests(ordered: DataFrame, algo: str = "md5") -> DataFrame:
    """(object_id, digest) over bytes of rows that lie in order, each object's within one partition."""
    check_algorithm(algo)
    return _fold(ordered, algo, "bytes")


def object_digests(df: DataFrame, algo: str = "md5") -> DataFrame:
    """(object_id, digest) over all bytes of each object, whatever its part size.

    df holds either content, one row for each object, or part rows with bytes. A digest over a
    whole object takes its bytes in order, so the parts of one object are read by one task as a
    sorted stream; memory does not grow with the object. Use composite_etags where the digest may
    depend on the part size, and plans.verify for files and stored objects, which shuffles no bytes.
    """
    check_algorithm(algo)
    if "content" in df.columns:
        if algo in _BUILTIN:
            return df.select("object_id", digest(F.col("content"), algo).alias("digest"))
        return _fold(df, algo, "content")
    # A part longer than a cell is several rows, see fetch_parts.
    order = ["part_num", "offset"] if "offset" in df.columns else ["part_num"]
    ordered = df.select("object_id", *order, "bytes").repartition("object_id")
    return _fold(ordered.sortWithinPartitions("object_id", *order), algo, "bytes")


def piece_digests(pieces: DataFrame, algo: str = "md5") -> DataFrame:
    """(object_id, digest) over pieces (object_id, start, bytes) in order of start, as a sorted stream."""
    check_algorithm(algo)
    ordered = pieces.select("object_id", "start", "bytes").repartition("object_id")
    return _fold(ordered.sortWithinPartitions("object_id", "start"), algo, "bytes")


def composite_etags(part_digests: DataFrame) -> DataFrame:
    """(object_id, etag, size): MD5 over the part MD5s in part order, a dash, the part count.

    Part MD5s are first packed by (object, block of parts), in parallel also for one huge object.
    An object of a single block ends there. Larger ones are folded over their packed blocks, again
    with constant memory. Part numbers of an object must be distinct (see merge_completed).
    """
    packed = (
        part_digests.groupBy("object_id", F.shiftright("part_num", BLOCK_BITS).alias("block"))
        .agg(
            F.array_sort(F.collect_list(F.struct("part_num", "md5"))).alias("_parts"),
            F.sum("size").alias("size"),
        )
        .select(
            "object_id",
            "block",
            F.unhex(F.array_join(F.transform("_parts", lambda p: p["md5"]), "")).alias("md5s"),
            F.size("_parts").cast("bigint").alias("n"),
            "size",
        )
    )
    objects = packed.groupBy("object_id").agg(
        F.count("*").alias("n_blocks"),
        F.max(F.when(F.col("block") == 0, F.md5("md5s"))).alias("first"),
        F.max("block").alias("last_block"),
        F.sum("n").alias("n"),
        F.sum("size").alias("size"),
    )
    small = objects.filter("last_block = 0")
    large = objects.filter("last_block > 0")
    blocks = packed.join(large.select("object_id"), "object_id", "left_semi")
    folded = _fold(
        blocks.repartition("object_id").sortWithinPartitions("object_id", "block"), "md5", "md5s"
    )

    def etag(md5: str) -> Column:
        return F.concat_ws("-", F.col(md5), F.col("n")).alias("etag")

    return small.select("object_id", etag("first"), "size").unionByName(
        large.join(folded, "object_id").select("object_id", etag("digest"), "size")
    )


MATCH, DIFFERENT, MISSING, EXTRA = "MATCH", "DIFFERENT", "MISSING_AT_DEST", "EXTRA_AT_DEST"


def reconcile(source: DataFrame, dest: DataFrame, key: str | list[str] = "object_id") -> DataFrame:
    """(key, status): both sides hold size and etag, one row for each object."""
    keys = [key] if isinstance(key, str) else list(key)
    s = source.select(*keys, F.struct("size", "etag").alias("_s"))
    d = dest.select(*keys, F.struct("size", "etag").alias("_d"))
    return s.join(d, keys, "full_outer").select(
        *keys,
        F.when(F.col("_d").isNull(), MISSING)
        .when(F.col("_s").isNull(), EXTRA)
        .when(F.col("_s").eqNullSafe(F.col("_d")), MATCH)
        .otherwise(DIFFERENT)
        .alias("status"),
    )


VERIFIED, REDOWNLOAD, FETCH = "VERIFIED", "REDOWNLOAD", "DOWNLOAD"
_EMPTY_SLOT = "0" * 32


def verify_parts(progress: DataFrame, current_digests: DataFrame) -> DataFrame:
    """Add action to each part of current_digests, the MD5 of what is there now.

    A part without a record, or with an all-zero one, is still to be fetched; one whose bytes no
    longer have the recorded MD5 is fetched again.
    """
    slots = progress.filter(F.col("md5") != _EMPTY_SLOT).select(
        "object_id", "part_num", F.col("md5").alias("_recorded")
    )
    return current_digests.join(slots, ["object_id", "part_num"], "left").select(
        *[F.col(c) for c in current_digests.columns],
        F.when(F.col("_recorded").isNull(), FETCH)
        .when(F.col("_recorded").eqNullSafe(F.col("md5")), VERIFIED)
        .otherwise(REDOWNLOAD)
        .alias("action"),
    )


def _count_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, values, counts = [], [], []
        for object_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not data.is_valid:
                continue
            found = np.zeros(256, dtype=np.int64)
            flat = np.frombuffer(data.as_buffer(), dtype=np.uint8)
            for at in range(0, len(flat), READ_BUFFER):  # bincount widens what it counts to 8 bytes each
                found += np.bincount(flat[at : at + READ_BUFFER], minlength=256)
            present = np.flatnonzero(found)
            if not len(present):  # tells that the object is there
                present = np.zeros(1, dtype=np.int64)
            ids += [object_id] * len(present)
            values.append(present.astype(np.int64))
            counts.append(found[present].astype(np.int64))
        if ids:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, batch.column(0).type),
                    pa.array(np.concatenate(values)),
                    pa.array(np.concatenate(counts)),
                ],
                ["object_id", "value", "n"],
            )


def byte_entropy(df: DataFrame) -> DataFrame:
    """(object_id, size, entropy) in bits for each byte; df holds content or parts with bytes.

    Bytes are counted where they are. What is shuffled is at most 256 counts for each part.
    Objects without bytes have entropy 0.
    """
    value = "content" if "content" in df.columns else "bytes"
    id_type = df.schema["object_id"].dataType.simpleString()
    counted = df.select("object_id", value).mapInArrow(
        _count_bytes, f"object_id {id_type}, value bigint, n bigint"
    )
    counts = counted.groupBy("object_id", "value").agg(F.sum("n").alias("n"))
    n = F.col("n").cast("double")
    # -sum(p * log2 p) with p = n / total is log2(total) - sum(n * log2 n) / total.
    totals = counts.groupBy("object_id").agg(
        F.sum("n").alias("size"), F.sum(F.when(F.col("n") > 0, n * F.log2(n)).otherwise(0.0)).alias("_nlogn")
    )
    entropy = F.when(F.col("size") > 0, F.log2("size") - F.col("_nlogn") / F.col("size")).otherwise(0.0)
    return totals.select("object_id", "size", F.round(entropy, 6).alias("entropy"))
