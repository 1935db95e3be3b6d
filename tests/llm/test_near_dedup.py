import random

import numpy as np
import pytest

from partwise.llm.components import connected_components
from partwise.llm.near_dedup import near_duplicates, shingles, sketches
from partwise.llm.queries import op2_near_dedup
from partwise.llm.tables import read


def as_set(text, words):
    cut = (text or "").encode().lower().split()
    return frozenset(tuple(cut[i : i + words]) for i in range(max(1, len(cut) - words + 1))) if cut else frozenset()


def brute_force(rows, words, percent):
    """(id, size, component) of each (id, text): links by comparing all pairs."""
    sets = [as_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    root[find(i)] = find(j)
    least = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            least[find(i)] = min(id_, least.get(find(i), id_))
    return [(id_, len(s), None if id_ is None else least[find(i)]) for i, ((id_, _), s) in enumerate(zip(rows, sets))]


def check(spark, rows, words=4, percent=80):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "2 as set", "3 as id")
    found = near_duplicates(docs, words=words, percent=percent).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=key) == sorted(brute_force(rows, words, percent), key=key)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in found)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = op2_near_dedup(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(brute_force(rows, 4, 80))


def test_groups_around_the_threshold(spark):
    """Copies with a few to many words changed: chains, a hot group, and members just too far away."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(300)}" for _ in range(120)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(0, 12)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(40)}"
        rows.append((1000 - i, " ".join(copy)))
    rows += [(2000 + i, " ".join(f"y{rng.randrange(9)}" for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    check(spark, rows)


def test_edges(spark):
    long = " ".join(f"word{i}" for i in range(150_000))
    check(spark, [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  Two\n"), (7, "one two"), (7, "other words"),
        (8, long), (9, long + " more"), (None, "one"), (None, None), (10, "é É"), (11, "é é"), (12, "a b c"), (13, "a b c"),
    ])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0
    check(spark, [(1, "a b c d e f"), (2, "a b c d e f g")], words=5, percent=50)


@pytest.mark.parametrize("n", [1, 2, 7, 300, 5000])
def test_sketch(n):
    rng = np.random.default_rng(n)
    common, left, right = (rng.integers(0, 2**63, k).astype(np.uint64) for k in (4 * n, n, n))
    a, b = sketches([np.unique(np.r_[common, left]), np.unique(np.r_[common, right])])
    assert not (a == np.uint64(2**64 - 1)).any()
    if n >= 7:
        assert abs((a == b).mean() - 4 / 6) < 0.15


def test_shingles_are_words_in_order():
    assert len(shingles(b"a b c a b c a", 3)) == 3
    assert shingles(b"a b", 3).tolist() != shingles(b"b a", 3).tolist()
    assert shingles(b"a b", 3).tolist() == shingles(b" A\tB\n", 3).tolist()


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert {k: v for k, v in least.items() if k != v} == found
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
