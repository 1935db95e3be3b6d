"""Packing by shortest pack first over the histogram of lengths.

Documents are tokenised once and cut into pieces of at most a sequence; the pieces are written. The
histogram of piece lengths has at most `size` bins whatever the number of documents, and the packing
is worked out on it: lengths are placed longest first into the shortest open packs, a group of equal
packs at a time. Then each piece finds its place by its length and its rank among the pieces of that
length.

As many sequences are opened as the tokens fill: full ones, and for what is left over one for each
power of two in it, which need no padding either. Pieces that then fit no open pack are cut over the
rooms that all others leave, so that all sequences are full.
"""

from __future__ import annotations

from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm.tables import id_and_text, in_slices, materialise
from partwise.llm.wordpieces import chunk_cache, packed, shared, short, tokens

# Pieces of one length are ranked in so many parts, so that a length that many documents share is not one task.
RANK_PARTS = 512


class Packs:
    """Groups of packs with equal room, as [first sequence, packs, capacity]."""

    def __init__(self, total: int, size: int) -> None:
        self.size, self.closed, self.next = size, total // size, 0
        self.last = [1 << b for b in range(size.bit_length() - 1, -1, -1) if (total % size) >> b & 1]
        self.by_room: dict[int, list[list[int]]] = {}
        self.rooms: list[int] = []

    def put(self, room: int, group: list[int]) -> None:
        if room and group[1]:
            if room not in self.by_room:
                insort(self.rooms, room)
                self.by_room[room] = []
            self.by_room[room].append(group)

    def take(self, most: int) -> tuple[int, list[int]]:
        """The shortest packs, at most so many; the rest of their group stays open."""
        room = self.rooms[-1]
        group = self.by_room[room].pop()
        if not self.by_room[room]:
            del self.by_room[room], self.rooms[-1]
        if group[1] > most:
            self.put(room, [group[0] + most, group[1] - most, group[2]])
            group = [group[0], most, group[2]]
        return room, group

    def open(self, length: int, wanted: int) -> None:
        """Opens packs unless the length fits; when no full ones are left, those for the rest."""
        if self.rooms and self.rooms[-1] >= length:
            return
        if self.closed:
            n = min(self.closed, wanted)
            self.put(self.size, [self.next, n, self.size])
            self.next, self.closed = self.next + n, self.closed - n
        elif self.last:
            for capacity in self.last:
                self.put(capacity, [self.next, 1, capacity])
                self.next += 1
            self.last = []


Run = tuple[int, int, int, int, int, int]


def plan(histogram: dict[int, int], size: int) -> tuple[list[Run], list[tuple], list[tuple]]:
    """Places for all ranks of all lengths: (runs, cut, rooms).

    A run (length, first, n, sequence, offset, docs) has n pieces from rank `first`; the j-th of them lies
    in sequence + j // docs, at offset + j % docs * length. Lengths that no pack has room for any more
    are cut: (length, first, n, start), a line of tokens from `start` on, over the rooms
    (start, room, packs, sequence, offset), which form a line as long.
    """
    packs = Packs(sum(length * n for length, n in histogram.items()), size)
    runs, cut, at = [], [], 0
    for length in sorted(histogram, reverse=True):
        first, left = 0, histogram[length]
        while left:
            packs.open(length, left)
            if packs.rooms[-1] < length:
                cut.append((length, first, left, at))
                at += length * left
                break
            room, group = packs.take(left)
            sequence, n_packs, capacity = group
            docs = min(room // length, left // n_packs)
            packs.put(room - length * docs, group)
            runs.append((length, first, n_packs * docs, sequence, capacity - room, docs))
            first, left = first + n_packs * docs, left - n_packs * docs
    rooms, at = [], 0
    for room in sorted(packs.by_room, reverse=True):
        for sequence, n_packs, capacity in packs.by_room[room]:
            rooms.append((at, room, n_packs, sequence, capacity - room))
            at += room * n_packs
    return runs, cut, rooms


class Places:
    """The plan as sorted arrays, for lookups by length and rank."""

    def __init__(self, runs: list[Run], cut: list[tuple], rooms: list[tuple]) -> None:
        # a cut length's row has its start in the line, and no packs
        rows = sorted([*runs, *[(length, first, n, start, 0, 0) for length, first, n, start in cut]])
        self.rows = np.array(rows, np.int64).reshape(-1, 6)
        self.keys = self.rows[:, 0] << 44 | self.rows[:, 1]
        self.rooms = np.array(rooms, np.int64).reshape(-1, 5)

    def find(self, length: np.ndarray, rank: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """For each piece its parts (start, length, sequence, offset)."""
        rows = self.rows[np.searchsorted(self.keys, length << 44 | rank, side="right") - 1]
        out = []
        for (k, first, _, base, offset, docs), j in zip(rows.tolist(), rank.tolist()):
            j -= first
            out.append([(0, k, base + j // docs, offset + j % docs * k)] if docs else self._over_rooms(base + j * k, k))
        return out

    def _over_rooms(self, at: int, length: int) -> list[tuple[int, int, int, int]]:
        parts, done = [], 0
        while done < length:
            start, room, _, sequence, offset = self.rooms[np.searchsorted(self.rooms[:, 0], at, side="right") - 1].tolist()
            pack, inner = divmod(at - start, room)
            n = min(room - inner, length - done)
            parts.append((done, n, sequence + pack, offset + inner))
            done, at = done + n, at + n
        return parts


def tokenised(docs: DataFrame, path: str, id_col: str, text_col: str, size: int, end_id: int, cache_size: int) -> DataFrame:
    """Pieces of at most size ids: (id, start, doc_tokens, length, ids in 2 bytes each where all fit, else 4)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        own = tokens(path)
        form, width = (short, 2) if own.library.get_vocab_size() <= 1 << 16 else (packed, 4)
        chunk = shared(("ids", path), lambda: chunk_cache(own, form, {}, cache_size)).__getitem__
        end, step = form([end_id]), width * size
        for batch in in_slices(batches):
            keep, start, total, ids = [], [], [], []
            for row, raw in enumerate(batch.column(1).to_pylist()):
                made = (b"".join(map(chunk, raw.split())) if own.by_chunk else form(own.ids(raw))) + end
                for at in range(0, len(made), step):
                    keep.append(row)
                    start.append(at // width)
                    total.append(len(made) // width)
                    ids.append(made[at : at + step])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array([len(i) // width for i in ids], pa.int32()),
                    pa.array(ids, pa.binary()),
                ],
                ["id", "start", "doc_tokens", "length", "ids"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        cut, f"id {id_type}, start long, doc_tokens long, length int, ids binary"
    )


def ranked(pieces: DataFrame) -> DataFrame:
    """(piece, length, rank): a gapless rank from 0 among the pieces of a length."""
    by_part = Window.partitionBy("length", "_part").orderBy("piece")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    narrow = pieces.select("piece", "length", F.pmod(F.xxhash64("piece"), F.lit(RANK_PARTS)).alias("_part"))
    counts = narrow.groupBy("length", "_part").count()
    base = counts.select("length", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    own = narrow.withColumn("_own", F.row_number().over(by_part) - 1)
    return own.join(base, ["length", "_part"]).select("piece", "length", (F.col("_base") + F.col("_own")).alias("rank"))


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 4096,
    end_id: int = 2,
    cache_size: int = 350_000,
) -> DataFrame:
    """(id_col, start, length, ids, doc_tokens, sequence_id, offset), one row for each piece.

    size has to be a power of two. ids are unsigned 32-bit integers, little-endian, as binary. A
    document is its tokens and end_id; null and empty texts are end_id alone. Ids may be null or
    repeated: each row is a document of its own. Other columns of docs are ignored. All sequences are
    full (size, or a power of two); an empty table gives an empty result.
    """
    spark = docs.sparkSession
    made = tokenised(docs, path, id_col, text_col, size, end_id, cache_size)
    pieces = materialise(made.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    # at most `size` rows come to the driver
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    # plain values, which tasks can read where this package is not installed
    planned = spark.sparkContext.broadcast(plan(histogram, size))
    id_type = docs.schema[id_col].dataType.simpleString()

    def place(batches):
        places = Places(*planned.value)
        for batch in in_slices(batches, 1024):
            ids = batch.column(batch.schema.get_field_index("ids")).to_pylist()
            start = batch.column(batch.schema.get_field_index("start")).to_pylist()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            length = batch.column(batch.schema.get_field_index("length")).to_numpy().astype(np.int64)
            keep, begins, cut, sequence, offset = [], [], [], [], []
            for row, parts in enumerate(places.find(length, rank)):
                for at, n, in_sequence, in_offset in parts:
                    keep.append(row)
                    begins.append(start[row] + at)
                    width = len(ids[row]) // length[row]
                    piece = ids[row][width * at : width * (at + n)]
                    cut.append(np.frombuffer(piece, np.uint16).astype("<u4").tobytes() if width == 2 else piece)
                    sequence.append(in_sequence)
                    offset.append(in_offset)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("id")).take(rows),
                    pa.array(begins, pa.int64()),
                    pa.array([len(c) // 4 for c in cut], pa.int64()),
                    pa.array(cut, pa.binary()),
                    batch.column(batch.schema.get_field_index("doc_tokens")).take(rows),
                    pa.array(sequence, pa.int64()),
                    pa.array(offset, pa.int64()),
                ],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    joined = ranked(pieces).select("piece", "rank").join(pieces, "piece")
    packed_rows = joined.select("id", "start", "doc_tokens", "length", "ids", "rank").mapInArrow(
        place, f"id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return packed_rows.withColumnRenamed("id", id_col)
