import zlib

import numpy as np

from partwise.llm.language_id import BITS, codewords, features, fit, identify
from partwise.llm.queries import op1_language_id
from partwise.llm.tables import read


def test_held_out_accuracy(spark, sf_dir):
    found = {r["doc_id"]: r for r in op1_language_id(spark, sf_dir).collect()}
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang").collect()
    assert len(found) == len(docs)
    for d in docs:
        assert found[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2)
        assert 0 <= found[d["doc_id"]]["score"] <= 1
    held = [d for d in docs if found[d["doc_id"]]["held_out"]]
    assert held and np.mean([found[d["doc_id"]]["lang_pred"] == d["lang"] for d in held]) >= 0.98


def test_edges(spark, sf_dir):
    model = fit(read(spark, sf_dir, "documents"))
    rows = [
        (1, None, 0.5), (2, "", None), (3, "12 345 ... !", 1.0), (4, "the of and that " * 3, 1.0), (4, "the of and that " * 3, 1.0),
        (None, "der und die das nicht " * 3, 1.0), (6, "the and of with " * 200_000, 1.0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double").selectExpr("*", "'x' as lang_pred", "true as id")
    found = [tuple(r)[:2] for r in identify(docs, model).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "de"), (6, "en")], key=str
    )
    assert identify(docs.limit(0), model).count() == 0
    assert fit(docs.limit(0).selectExpr("text", "'x' as lang")) is None
    assert {r["lang_pred"] for r in identify(docs, None).collect()} == {"und"}


def test_long_texts_are_counted_whole():
    raw = bytes(np.random.default_rng(0).integers(97, 123, (1 << 20) + 999, dtype=np.uint8))
    counts = np.zeros(1 << BITS)
    for n in (1, 2, 3, 4):
        code = np.full(len(raw) - n + 1, n, np.uint32)
        for i in range(n):
            code = code * np.uint32(257) + np.frombuffer(raw, np.uint8)[i : len(raw) - n + 1 + i]
        code = (code ^ (code >> np.uint32(15))) * np.uint32(2654435761)
        counts += np.bincount(code >> np.uint32(32 - BITS), minlength=1 << BITS)
    assert np.allclose(features(raw), np.sqrt(counts) / np.linalg.norm(np.sqrt(counts)), atol=1e-6)


def test_codewords_correct_errors():
    for n in (1, 2, 3, 4, 6, 9, 30):
        code = codewords(n)
        assert code.shape[0] == n and set(np.unique(code)) <= {-1.0, 1.0}
        apart = [np.sum(code[i] != code[j]) for i in range(n) for j in range(i)]
        assert n < 4 or min(apart) >= 4  # one wrong bit at least is made good
        assert not apart or min(apart) >= 1
