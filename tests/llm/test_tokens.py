import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from partwise.llm.packing import Places, pack_documents, plan
from partwise.llm.queries import op5_token_counts, op8_packing, vocabulary
from partwise.llm.tables import read
from partwise.llm.token_counts import count_tokens

ODD = [
    None, "", " \n\t", "it's WE'LL I'm <|endoftext|>x<|startoftext|> y", " a b\x1c c\x85d　e", "日本語 テスト",
    "é é Å ẞ İstanbul Straße Ǆ ſ ª µ", "a\x00b . , .. ,. x.y, 12,345.6", "x" * 5000, "the of " * 60_000, "the", "the", "&&& ***,",
]


@pytest.fixture(scope="module")
def ids():
    library = Tokenizer.from_file(vocabulary())
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


def odd_table(spark):
    rows = [(i // 2 if i % 5 else None, t) for i, t in enumerate(ODD)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "2 as raw", "3 as id", "4 as length", "5 as rank")


def test_counts(spark, sf_dir, ids):
    found = {r["doc_id"]: r for r in op5_token_counts(spark, sf_dir).collect()}
    docs = read(spark, sf_dir, "documents").collect()
    assert len(found) == len(docs)
    for d in docs:
        n = len(ids(d["text"]))
        r = found[d["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(d["text"].encode()), n, n > 2048)


def test_count_edges(spark, ids):
    rows, table = odd_table(spark)
    key = lambda r: tuple((x is None, x) for x in r)
    for cache in (400_000, 2):  # also where the caches are emptied all the time
        found = [tuple(r)[:3] for r in count_tokens(table, vocabulary(), cache_size=cache).collect()]
        assert sorted(found, key=key) == sorted(((i, len((t or "").encode()), len(ids(t))) for i, t in rows), key=key)
    assert count_tokens(table.limit(0), vocabulary()).count() == 0


def whole(rows, found, ids, size):
    """Each document is cut into pieces that lie in full sequences without a gap."""
    wanted = sorted(zlib.crc32(np.array([*ids(t), 2], "<u4").tobytes()) for _, t in rows)
    sequences, docs = {}, {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == size or at < size and at & (at - 1) == 0
    return wanted, docs


def test_packing(spark, sf_dir, ids):
    found = op8_packing(spark, sf_dir).collect()
    rows = [(d["doc_id"], d["text"]) for d in read(spark, sf_dir, "documents").collect()]
    _, docs = whole(rows, found, ids, 4096)
    assert set(docs) == {d for d, _ in rows}
    for d, t in rows:
        full, at = np.array([*ids(t), 2], "<u4"), 0
        for r in sorted(docs[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(full)
            assert r["ids_crc32"] == zlib.crc32(full[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(full)


def test_packing_edges(spark, ids):
    rows, table = odd_table(spark)
    for size in (1, 64, 4096):
        found = pack_documents(table, vocabulary(), size=size).collect()
        wanted, _ = whole(rows, found, ids, size)
        assert sum(r["length"] for r in found) == sum(len(ids(t)) + 1 for _, t in rows)
    pieces = pack_documents(spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None)], "doc_id long, text string"), vocabulary()).collect()
    assert sum(r["length"] for r in pieces) == 9
    assert pack_documents(table.limit(0), vocabulary()).count() == 0


def test_plan():
    rng = random.Random(0)
    for _ in range(200):
        size = rng.choice([1, 2, 8, 64, 256])
        histogram = {rng.randint(1, size): rng.choice([1, 2, 5, 300]) for _ in range(rng.randint(0, 40))}
        places, sequences = Places(*plan(histogram, size)), {}
        for length, n in histogram.items():
            for parts in places.find(np.full(n, length), np.arange(n)):
                at = 0
                for start, k, sequence, offset in parts:
                    assert start == at
                    at += k
                    sequences.setdefault(sequence, []).append((offset, k))
                assert at == length
        for parts in sequences.values():
            at = 0
            for offset, k in sorted(parts):
                assert offset == at
                at += k
            assert at == size or at & (at - 1) == 0
    for n in (10**9, 1):
        runs, cut, rooms = plan({k: n + k for k in range(1, 4097)}, 4096)
        assert len(runs) + len(cut) + len(rooms) < 40_000
