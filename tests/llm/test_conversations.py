import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from partwise.llm import conversations as module
from partwise.llm.conversations import repair_conversations
from partwise.llm.queries import op11_conversation_repair
from partwise.llm.tables import read

WHITE = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
NAMES = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) by a forward search that carries whole audits."""
    best = {"": (0, "", ())}

    def offer(found, state, entry):
        if state not in found or entry < found[state]:
            found[state] = entry

    def inserted(found):
        for _ in range(4):
            for state, (cost, audit, lines) in list(found.items()):
                for role in "ua":
                    if (state, role) in NEXT:
                        offer(found, role, (cost + 3, audit + "I", (*lines, NAMES[role] + ":")))
        return found

    for role, text, fault in rows:
        found = {}
        for state, (cost, audit, lines) in inserted(best).items():
            offer(found, state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            if (state, role[:1]) in NEXT:
                offer(found, NEXT[state, role[:1]], (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            for to in "ua":
                if (state, to) in NEXT:
                    offer(found, to, (cost + 3 + extra, audit + "R", (*lines, f"{NAMES[to]}:{text}")))
        best = found
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def brute_force(rows, every):
    key = lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or 0), r[2].encode(), r[3].encode())
    found = {}
    for conv, group in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        group, seen, judged = list(group), set(), []
        for _, _, role, text in group:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [r[1] for r in group if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [(a[0][:1] + b[0][:1]) for a, b in zip(judged, judged[1:])]
        cost, audit, lines = cheapest(judged)
        found[conv] = (
            conv, gaps, *[sum(f == kind for *_, f in judged) for kind in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    return [found.get(conv, (conv, *nothing)) for conv in every]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v) for v in r))


def check(spark, rows):
    schema = "conv_id long, turn long, role string, text string, block int, at int, fault int, conv int"
    repair = repair_conversations(spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], schema))
    digests = {r["conv"]: r["sha256"] for r in repair.digests().collect()}
    got = [(*r, digests.get(r["conv"], hashlib.sha256(b"").hexdigest())) for r in repair.report.collect()]
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert ordered(got) == ordered(brute_force(plain, {r[0] for r in rows}))
    return repair


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = op11_conversation_repair(spark, sf_dir)
    assert found.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert ordered(found.collect()) == ordered(brute_force(damage(rows), {r[0] for r in rows}))


def made_up(rng, conv, n, roles=("user", "assistant")):
    texts = ["One.", "Two!", "Three?", "cut", " \t", "", "Long text. and more", "End.  \n", "x. ", "."]
    return [(conv, rng.choice([None, i, i, i + 1]), rng.choice([*roles, *roles, "system", "tool", "", None]), rng.choice([*texts, f"t{i}.", f"u{i}."])) for i in range(n)]


def test_random_conversations(spark):
    rng, rows = random.Random(1), []
    for conv in range(120):
        rows += made_up(rng, conv if conv else None, rng.randrange(1, 14))
    check(spark, rows)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_conversations_over_many_blocks(spark, monkeypatch, bits):
    """Blocks of 1, 2 and 8 rows: one conversation with a third of all rows, chains of segments, ends on blocks' ends."""
    monkeypatch.setattr(module, "BLOCK_BITS", bits)
    rng, rows = random.Random(2 + bits), made_up(random.Random(9), 50, 70)
    for conv in range(40):
        rows += made_up(rng, conv if conv != 7 else None, rng.randrange(1, 6))
    rows += made_up(rng, 101, 17)
    check(spark, rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "assistant", "cut off")]
    repair = check(spark, rows + [(2, 0, "user", " "), (3, 5, "system", "Be kind.")])
    lines = [(r["conv"], r["turn"], r["role"], r["text"]) for r in repair.lines.orderBy("block", "at", "line").collect()]
    audits = {r["conv"]: r["audit"] for r in repair.report.collect()}
    assert audits == {1: "IKKDK", 2: "D", 3: "D"}
    assert lines == [(1, None, "user", ""), (1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 3, "assistant", "cut off")]


def test_very_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_BITS", 1)
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "word " * 300_000 + f"{i}.") for i in range(8)] + [(2, 0, "user", "Ä" * 100_000)]
    check(spark, rows)


def test_all_repeated_and_all_null(spark):
    check(spark, [(1, 1, "user", "Same.")] * 30 + [(None, None, None, None)] * 5 + [(2, None, "assistant", "Only.")])


def test_empty_table(spark):
    check(spark, [])
