"""Repair of conversations: faults found, and the cheapest edits that give a legal order of roles.

Legal are an optional system turn and then pairs of user and assistant, or nothing at all: role initials
`(s?(ua)+)?`. A node is a place between two rows and a state of that pattern. Arcs are edits: Keep and Rerole go
over a row and change the state, Delete goes over it, Insert changes the state in place. A dynamic
program over costs leaves the arcs that lie on a cheapest path. Their nodes are ranked by the
initials of the next 1, 2, 4, ... edits, each time by the pair of ranks of a node and of where its pointer
leads, and pointers double. The ranks choose each node's arc, and the doubled pointers mark the
nodes on the least of the cheapest paths.

Rows are sorted by ranges and dealt into blocks of `BLOCK` of them, so a conversation may hold any share
of the rows. One that goes over the end of a block is a chain of segments: costs from state to state
over whole chains come from doubled pointers too, and so does the state in which the least path enters
each segment. Texts are not held: they are streamed past the edits once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm.tables import materialise

BLOCK_BITS = 12
PIECE = 1 << 20
FAR = 1 << 40

START, SYSTEM, USER, ASSISTANT = range(4)  # states, by what was said last
S, U, A, OTHER = range(4)  # initials of roles
KEEP = np.full((4, 4), -1)
KEEP[S, START] = SYSTEM
KEEP[U, [START, SYSTEM, ASSISTANT]] = USER
KEEP[A, USER] = ASSISTANT
ADDED = np.array([USER, USER, ASSISTANT, USER])  # the state an insert or a changed role leads to
LEGAL = np.zeros((4, 4), bool)  # by the initials of a row and of the next
LEGAL[[S, U, A], [U, A, U]] = True
DELETE, INSERT, KEPT, REROLE = range(1, 5)  # in the order of their initials
INITIAL = np.array(list(" DIKR"))
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
AT_END = [0, 6, 3, 0]  # what inserts after the last row cost in each state

NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)


@dataclass
class Runs:
    """Rows of one block, and the conversations or segments they are in."""

    start: np.ndarray
    length: np.ndarray
    code: np.ndarray
    fault: np.ndarray

    def first_place(self) -> np.ndarray:
        """Places of all runs are numbered through: one more than it has rows for each run."""
        return self.start + np.arange(len(self.start))


def costs(runs: Runs, end: np.ndarray) -> np.ndarray:
    """(place, state, k): the least cost from there to the run's end, where state q has cost end[run, q, k]."""
    base = runs.first_place()
    found = np.full((len(runs.code) + len(base), 4, end.shape[2]), FAR)
    for back in range(int(runs.length.max()) + 1):
        alive = runs.length >= back
        place = (base + runs.length - back)[alive]
        if back == 0:
            found[place] = end
            continue
        row = (runs.start + runs.length - back)[alive]
        after = found[place + 1]
        extra = np.where(runs.fault[row] == TRUNCATED, TRUNCATED_COST, 0)[:, None, None]
        free = np.isin(runs.fault[row], (NO_FAULT, TRUNCATED))[:, None, None]
        to = KEEP[runs.code[row]][:, :, None]
        kept = np.where(free & (to >= 0), np.take_along_axis(after, np.maximum(to, 0), 1) + extra, FAR)
        changed = np.where(free, after[:, ADDED] + REROLE_COST + extra, FAR)
        best = np.minimum(np.minimum(after + DELETE_COST, kept), changed)
        once = best[:, ADDED] + INSERT_COST
        found[place] = np.minimum(np.minimum(best, np.minimum(once, once[:, ADDED] + INSERT_COST)), FAR)
    return found


def least_paths(runs: Runs, cost: np.ndarray, ends_there: np.ndarray, entry: np.ndarray):
    """The edits of each run's least cheapest path from its entry state: (run, node, edit) by step, node being
    place * 4 + state, and each path's last state. Runs that do not end there take no inserts after their rows."""
    places = len(cost)
    base = runs.first_place()
    last = base + runs.length
    run_of = np.repeat(np.arange(len(base)), runs.length + 1)
    row = np.minimum(np.arange(places) - run_of, len(runs.code) - 1)
    node = np.arange(places * 4).reshape(places, 4)
    over = np.ones((places, 1), bool)
    over[last] = False
    insert = over.copy()
    insert[last, 0] = ends_there
    free = over & np.isin(runs.fault[row], (NO_FAULT, TRUNCATED))[:, None]
    extra = np.where(runs.fault[row] == TRUNCATED, TRUNCATED_COST, 0)[:, None]
    to = KEEP[runs.code[row]]
    beyond = node[np.minimum(np.arange(places) + 1, places - 1)]

    # Optimal arcs. In this pattern no two arcs of a node share an initial, so the first rank tells them apart.
    arcs = [
        (DELETE, over, DELETE_COST, beyond),
        (INSERT, insert, INSERT_COST, node[:, ADDED]),
        (KEPT, free & (to >= 0), extra, np.take_along_axis(beyond, np.maximum(to, 0), 1)),
        (REROLE, free, REROLE_COST + extra, beyond[:, ADDED]),
    ]
    flat = cost.reshape(-1)
    rank, jump = np.zeros(places * 4, np.int64), node.reshape(-1).copy()
    for edit, there, price, target in reversed(arcs):
        best = (there & (flat[target] + price == cost)).reshape(-1)
        rank[best], jump[best] = edit, target.reshape(-1)[best]
    edits, steps = rank.copy(), (rank > 0).astype(np.int64)

    jumps = [jump]
    while not (jump[jump] == jump).all():  # ranks by the next 2, 4, 8, ... edits
        rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1]
        steps = steps + steps[jump]
        jump = jump[jump]
        jumps.append(jump)

    starts = base * 4 + entry
    on = np.zeros(places * 4, bool)
    on[starts] = True
    for far in reversed(jumps):
        on[far[np.flatnonzero(on)]] = True
    at = np.flatnonzero(on & (edits > 0))
    which = run_of[at // 4]
    order = np.lexsort((-steps[at], which))
    return which[order], at[order], edits[at[order]], jump[starts] % 4


def _blocks(batches):
    """Tables of one block each (column 0, sorted)."""
    held = []
    for batch in batches:
        block = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)] if len(block) else []
        for lo, hi in zip(cuts, cuts[1:]):
            if held and held[0].column(0)[0].as_py() != block[lo]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(block: pa.Table, name: str) -> pa.Array:
    column = block.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _runs(block: pa.Table) -> Runs:
    ids = _column(block, "conv").dictionary_encode(null_encoding="encode").indices.to_numpy()
    start = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1])
    length = np.diff(np.append(start, len(ids)))
    return Runs(start, length, _column(block, "code").to_numpy(), _column(block, "fault").to_numpy())


def _summarise(batches):
    """For each block the costs from state to state over its first run, and what its neighbours have to know."""
    for block in _blocks(batches):
        runs = _runs(block)
        n = runs.length[0]
        first = Runs(runs.start[:1], runs.length[:1], runs.code[:n], runs.fault[:n])
        over = costs(first, np.where(np.eye(4, dtype=bool), 0, FAR)[None])[0].reshape(1, -1)
        conv, turn = _column(block, "conv"), _column(block, "turn")
        yield pa.RecordBatch.from_arrays(
            [
                _column(block, "block").slice(0, 1), conv.slice(0, 1), conv.slice(len(conv) - 1), pa.array([len(runs.start) == 1]),
                pa.array(over.tolist(), pa.list_(pa.int64())), turn.slice(len(turn) - 1), pa.array(runs.code[-1:], pa.int32()),
            ],
            ["block", "first_conv", "last_conv", "single", "over", "last_turn", "last_code"],
        )


def _repair(batches):
    """A row for each run of each block; for a run that a block before began, one for each state it may be entered in."""
    for block in _blocks(batches):
        head = {name: block.column(name)[0].as_py() for name in ("block", "goes_in", "goes_out", "beyond", "before_turn", "before_code")}
        runs = _runs(block)
        n, variants = len(runs.start), 1
        if head["goes_in"]:  # the first run once for each state
            variants, k = 4, int(runs.length[0])
            block = block.take(np.concatenate([np.tile(np.arange(k), 3), np.arange(block.num_rows)]))
            length = np.concatenate([np.repeat(k, 3), runs.length])
            start = np.cumsum(length) - length
            runs = Runs(start, length, _column(block, "code").to_numpy(), _column(block, "fault").to_numpy())
        entry = np.zeros(len(runs.start), np.int64)
        entry[:variants] = np.arange(variants)
        ends_there = np.ones(len(runs.start), bool)
        ends_there[0 if n == 1 else -1 :] = not head["goes_out"]
        end = np.where(ends_there[:, None], np.array([AT_END]), np.array([head["beyond"] or AT_END]))
        cost = costs(runs, end[:, :, None])[:, :, 0]
        which, node, edit, leaves_in = least_paths(runs, cost, ends_there, entry)

        turn, pos, conv = _column(block, "turn"), _column(block, "pos").to_numpy(), _column(block, "conv")
        some, turn = ~np.asarray(turn.is_null()), turn.fill_null(0).to_numpy()
        fresh = np.zeros(len(turn), bool)
        fresh[runs.start] = True
        new = some & (fresh | ~np.roll(some, 1) | (turn != np.roll(turn, 1)))
        wrong = ~fresh & ~LEGAL[np.roll(runs.code, 1), runs.code]
        if head["goes_in"]:
            lead = runs.start[:4]
            new[lead] = some[lead] & (turn[lead] != head["before_turn"])
            wrong[lead] = ~LEGAL[head["before_code"], runs.code[lead]]
        total = lambda x: np.add.reduceat(x.astype(np.int64), runs.start)
        any_turn = total(some) > 0
        low = np.minimum.reduceat(np.where(some, turn, np.iinfo(np.int64).max), runs.start)
        high = np.maximum.reduceat(np.where(some, turn, np.iinfo(np.int64).min), runs.start)

        # Lines of the repaired rows: a kept or changed row is line 0 of its own place, what is added comes before or after.
        base = runs.first_place()
        place = node // 4 - base[which]
        behind = place == runs.length[which]
        line = np.where(edit == INSERT, np.where(behind, 1, -3), 0)
        again = (edit == INSERT) & np.concatenate([[False], (which[1:] == which[:-1]) & (node[1:] // 4 == node[:-1] // 4) & (edit[:-1] == INSERT)])
        line = line + again
        at = pos[np.minimum(runs.start[which] + place, runs.start[which] + runs.length[which] - 1)]
        said = ADDED[node % 4]
        role = np.where(edit == KEPT, None, np.where(said == USER, "user", "assistant"))
        stays = edit != DELETE
        lines = pa.StructArray.from_arrays(
            [pa.array(at[stays]), pa.array(line[stays].astype(np.int32)), pa.array(role[stays], pa.string())], ["at", "line", "role"]
        )
        cuts = np.searchsorted(which[stays], np.arange(len(runs.start) + 1)).astype(np.int32)
        letters = "".join(INITIAL[edit])
        bounds = np.searchsorted(which, np.arange(len(runs.start) + 1))
        # each segment's own share of the cost: what its end costs is counted further on
        own = cost[base, entry] - np.where(ends_there, 0, end[np.arange(len(end)), leaves_in])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(own), head["block"])), conv.take(pa.array(runs.start)), pa.array(np.arange(len(own)) < variants * head["goes_in"]),
                pa.array(~ends_there), pa.array(entry.astype(np.int32)), pa.array(leaves_in.astype(np.int32)),
                pa.array(low, mask=~any_turn), pa.array(high, mask=~any_turn), pa.array(total(new)),
                pa.array(total(runs.fault == BLANK)), pa.array(total(runs.fault == DUPLICATE)), pa.array(total(runs.fault == TRUNCATED)),
                pa.array(total(wrong)), pa.array(own), pa.array([letters[i:j] for i, j in zip(bounds, bounds[1:])], pa.string()),
                pa.ListArray.from_arrays(pa.array(cuts), lines),
            ],
            ["block", "conv", "goes_in", "goes_out", "entry", "leaves_in", "low", "high", "turns", "blank", "duplicate", "truncated",
             "illegal", "cost", "audit", "lines"],
        )


REPAIRED = (
    "goes_in boolean, goes_out boolean, entry int, leaves_in int, low long, high long, turns long, blank long, duplicate long, "
    "truncated long, illegal long, cost long, audit string, lines array<struct<at: long, line: int, role: string>>"
)


def _marked(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows in order with their texts (pos, block, conv, turn, role, text), and without them but with code and fault."""
    white = r"\x20\x09-\x0D"
    given = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    keyed = given.select(
        "*", F.substring("role", 1, 32).alias("k1"), F.substring("text", 1, 128).alias("k2"), F.xxhash64("role", "text").alias("k3"),
        F.monotonically_increasing_id().alias("k4"),
    )
    placed = keyed.orderBy("conv", F.col("turn").asc_nulls_first(), "k1", "k2", "k3", "k4").drop("k1", "k2", "k3", "k4")
    first = F.substring("role", 1, 1)
    ordered = materialise(
        placed.select(
            F.monotonically_increasing_id().alias("raw_pos"), "*",
            F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(OTHER).alias("code"),
            F.when(~F.col("text").rlike(f"[^{white}]"), BLANK).when(~F.col("text").rlike(rf"[.!?][{white}]*\z"), TRUNCATED)
            .otherwise(NO_FAULT).alias("fault"),
            F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256).alias("said"),
        ).withColumn("piece", F.shiftright("raw_pos", 33)),
        "ordered",
    )
    # one row for each range of the sort
    held = ordered.groupBy("piece").agg(F.count("*").alias("n"), F.min("raw_pos").alias("low"))
    shift = F.sum("n").over(Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    shifts = held.select("piece", (F.coalesce(shift, F.lit(0)) - F.col("low")).alias("shift"))
    ordered = ordered.join(F.broadcast(materialise(shifts, "shifts")), "piece").withColumn("pos", F.col("raw_pos") + F.col("shift"))
    ordered = ordered.withColumn("block", F.shiftright("pos", BLOCK_BITS))
    firsts = ordered.groupBy("conv", "said").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("is_first"))
    narrow = ordered.select("block", "pos", "conv", "turn", "code", "fault")
    fault = F.when((F.col("fault") != BLANK) & F.col("is_first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    marks = materialise(narrow.join(firsts, "pos", "left").withColumn("fault", fault).select(*narrow.columns), "marks")
    return ordered.select("block", "pos", "turn", "role", "text"), marks


def _in_blocks(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block", *order)


def _chained(marks: DataFrame, conv_type: str) -> DataFrame:
    """For each block: does it go on from the one before and into the next, the costs from there on in each state
    (`beyond`), and the last turn and role before it."""
    blocks = materialise(
        _in_blocks(marks, "pos").mapInArrow(
            _summarise, f"block long, first_conv {conv_type}, last_conv {conv_type}, single boolean, over array<long>, last_turn long, last_code int"
        ),
        "blocks",
    )
    before = blocks.select(
        (F.col("block") + 1).alias("block"), F.col("last_conv").alias("before_conv"), F.col("last_turn").alias("before_turn"),
        F.col("last_code").alias("before_code"),
    )
    after = blocks.select((F.col("block") - 1).alias("block"), F.col("first_conv").alias("after_conv"), F.lit(True).alias("is_after"))
    linked = blocks.join(before, "block", "left").join(after, "block", "left").select(
        "block", "single", "over",
        (F.col("before_code").isNotNull() & F.col("first_conv").eqNullSafe(F.col("before_conv"))).alias("goes_in"),
        (F.col("is_after").isNotNull() & F.col("last_conv").eqNullSafe(F.col("after_conv"))).alias("goes_out"),
        "before_turn", F.coalesce("before_code", F.lit(OTHER)).alias("before_code"),
    )
    linked = materialise(linked, "linked")
    # Pointers of segments that go on to the next block, doubled until all lead past their conversation's end.
    chain = linked.where("goes_in").select("block", "over", F.when(F.expr("single and goes_out"), F.col("block") + 1).alias("jump"))
    chain = materialise(chain, "chain")
    while chain.where("jump is not null").limit(1).count():
        farther = chain.select(F.col("block").alias("jump"), F.col("over").alias("then"), F.col("jump").alias("next"))
        chain = materialise(
            chain.join(farther, "jump", "left").select(
                "block",
                F.expr(f"""case when then is null then over else transform(sequence(0, 15), k -> array_min(transform(sequence(0, 3),
                    m -> least({FAR}L, over[k div 4 * 4 + m] + then[m * 4 + k % 4])))) end""").alias("over"),
                F.col("next").alias("jump"),
            ),
            "chain",
        )
    at_end = F.array(*[F.lit(c).cast("bigint") for c in AT_END])
    beyond = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda q: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda m: F.get("over", q * 4 + m) + F.get(at_end, m))),
    )
    known = chain.select((F.col("block") - 1).alias("block"), beyond.alias("beyond"))
    return linked.drop("single", "over").join(known, "block", "left").withColumn("beyond", F.when(F.col("goes_out"), F.col("beyond")))


def _entered(segments: DataFrame) -> DataFrame:
    """(block, entry): the state in which the least path enters each block that goes on from one before."""
    through = segments.where("goes_out").groupBy("block").agg(
        F.max("goes_in").alias("passes"),
        F.transform(F.sort_array(F.collect_list(F.struct("entry", "leaves_in"))), lambda s: s["leaves_in"]).alias("to"),
    )
    # Of each block that is entered: where all states lead that the block `back` blocks before it is entered in.
    chain = through.select((F.col("block") + 1).alias("block"), "to", F.when(F.col("passes"), F.col("block")).alias("back"))
    chain = materialise(chain, "entries")
    while chain.where("back is not null").limit(1).count():
        earlier = chain.select(F.col("block").alias("back"), F.col("to").alias("first"), F.col("back").alias("next"))
        chain = materialise(
            chain.join(earlier, "back", "left").select(
                "block", F.expr("case when first is null then to else transform(first, q -> to[q]) end").alias("to"), F.col("next").alias("back")
            ),
            "entries",
        )
    return chain.select("block", F.col("to")[0].alias("entry"))


@dataclass
class Repair:
    """What was found and decided, as DataFrames."""

    report: DataFrame  # one row for each conversation
    lines: DataFrame  # the repaired rows in order of (block, at, line), each conversation's within and across blocks

    def digests(self) -> DataFrame:
        """(conv, sha256) of each conversation's `role:text` lines, joined by newlines. Conversations with no lines have no row."""
        conv_type = self.report.schema["conv"].dataType.simpleString()
        parts = self.lines.mapInArrow(
            _digest_lines, f"conv {conv_type}, block long, part long, bytes binary, sha256 string"
        )
        parts = materialise(parts, "digest-parts")
        whole = parts.where("sha256 is not null").select("conv", "sha256")
        split = parts.where("sha256 is null").select("conv", "block", "part", "bytes")
        chained = split.repartition("conv").sortWithinPartitions("conv", "block", "part").mapInArrow(
            _digest_parts, f"conv {conv_type}, sha256 string"
        )
        return whole.union(chained)


def _merge(batches):
    """Texts and decided lines, side by side in order of place, as the repaired rows."""
    text_at, held = None, None
    for batch in batches:
        out = []
        for row in zip(*[batch.column(c).to_pylist() for c in ("block", "at", "line", "kind", "conv", "whole", "turn", "role", "text")]):
            block, at, line, kind, conv, whole, turn, role, text = row
            if kind == 0:
                text_at, held = at, (turn, role, text)
            elif line == 0:
                assert text_at == at
                out.append((conv, block, at, line, whole, held[0], role or held[1], held[2]))
            else:
                out.append((conv, block, at, line, whole, None, role, ""))
        fields = [batch.schema.field("conv").type, pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string()]
        columns = list(zip(*out)) or [[] for _ in fields]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, fields)], ["conv", "block", "at", "line", "whole", "turn", "role", "text"]
        )


def _digest_lines(batches):
    """A digest for each conversation within one block, the bytes of the others in pieces; every line begins with a newline."""
    done, key, hashed, kept, part, conv_type = [], None, None, bytearray(), 0, None

    def close():
        if key is None:
            return
        conv, block, whole = key
        if whole:
            done.append((conv, block, 0, None, hashed.hexdigest()))
        elif kept:
            done.append((conv, block, part, bytes(kept), None))

    def batch_of(rows):
        types = [conv_type, pa.int64(), pa.int64(), pa.binary(), pa.string()]
        columns = list(zip(*rows)) or [[] for _ in types]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv", "block", "part", "bytes", "sha256"])

    for batch in batches:
        conv_type = batch.schema.field("conv").type
        for conv, block, whole, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "block", "whole", "role", "text")]):
            if key != (conv, block, whole):
                close()
                key, hashed, kept, part, begun = (conv, block, whole), hashlib.sha256(), bytearray(), 0, False
            line = f"{role}:{text}".encode()
            if whole:
                hashed.update(b"\n" + line if begun else line)
                begun = True
                continue
            kept += b"\n" + line
            if len(kept) > PIECE:
                done.append((conv, block, part, bytes(kept), None))
                kept, part = bytearray(), part + 1
            if len(done) > 64:
                yield batch_of(done)
                done.clear()
        if done:
            yield batch_of(done)
            done.clear()
    close()
    if done:
        yield batch_of(done)


def _digest_parts(batches):
    """Digests over the pieces of each conversation, in order; the first newline is left out."""
    key, hashed, names = None, None, ["conv", "sha256"]
    for batch in batches:
        done, conv_type = [], batch.schema.field("conv").type
        for conv, piece in zip(batch.column("conv"), batch.column("bytes")):
            conv, piece = (conv.as_py(),), piece.as_py()
            if conv != key:
                if key is not None:
                    done.append((key[0], hashed.hexdigest()))
                key, hashed, piece = conv, hashlib.sha256(), piece[1:]
            hashed.update(piece)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], conv_type), pa.array([d[1] for d in done])], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], conv_type), pa.array([hashed.hexdigest()])], names)


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repair:
    """Faults, cheapest edits and repaired rows of all conversations.

    report: conv, gaps (turn numbers missing between the least and the greatest), blank, duplicate and
    truncated rows, illegal pairs of neighbours, cost, audit: the initials of the edits in order. Of equally cheap
    edits those with the least audit are taken. lines: conv, block, at, line, whole, turn, role, text.

    Rows go by turn, null turns first, equal turns by role and text (32 and 128 characters of them, then a hash).
    The first fault of a row counts: blank, duplicate (role and text seen earlier in the conversation), truncated (the last
    character that is no white space is none of .!?). Blank and duplicate rows are deleted. Null roles and texts are one
    space; a null conv is a conversation of its own. Repeated rows are duplicates. Added rows have an empty text
    and no turn. Other columns are ignored, texts may be of any length, and without rows both tables are empty.
    """
    conv_type = rows.schema[conv_col].dataType.simpleString()
    texts, marks = _marked(rows, conv_col, turn_col, role_col, text_col)
    info = _chained(marks, conv_type)
    segments = materialise(
        _in_blocks(marks.join(info, "block"), "pos").mapInArrow(_repair, f"block long, conv {conv_type}, {REPAIRED}"), "segments"
    )
    entered = _entered(segments).select("block", "entry", F.lit(True).alias("chosen"))
    chosen = segments.join(entered, ["block", "entry"], "left").where("not goes_in or chosen").drop("chosen")
    chosen = materialise(chosen.withColumn("whole", F.expr("not goes_in and not goes_out")), "chosen")
    report = chosen.groupBy("conv").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda s: s["audit"])).alias("audit"),
    )
    decided = chosen.select("block", "conv", "whole", F.inline("lines"))
    both = decided.select(
        "block", "at", "line", F.lit(1).alias("kind"), "conv", "whole", F.lit(None).cast("long").alias("turn"), "role", F.lit(None).cast("string").alias("text")
    ).union(
        texts.select(
            "block", F.col("pos").alias("at"), F.lit(0).alias("line"), F.lit(0).alias("kind"), F.lit(None).cast(conv_type).alias("conv"),
            F.lit(None).cast("boolean").alias("whole"), "turn", "role", "text",
        )
    )
    lines = _in_blocks(both, "at", "line", "kind").mapInArrow(
        _merge, f"conv {conv_type}, block long, at long, line int, whole boolean, turn long, role string, text string"
    )
    return Repair(report, lines)
