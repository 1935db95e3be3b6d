import numpy as np
import pytest

from partwise.llm import nearest
from partwise.llm.nearest import nearest_neighbours
from partwise.llm.queries import op3_nearest
from partwise.llm.tables import read


def brute_force(rows, queries, k):
    out = {}
    for q, x in queries:
        near = sorted((float(np.sqrt(((np.array(x, float) - np.array(v, float)) ** 2).sum())), i) for i, v in rows if i != q)
        out[q] = near[:k]
    return out


def by_query(found):
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_the_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in read(spark, sf_dir, "embeddings").collect()]
    wanted = brute_force(rows, [r for r in rows if r[0] % 100 == 0], 10)
    found = by_query(op3_nearest(spark, sf_dir).collect())
    assert set(found) == set(wanted)
    exact = {(q, i): s for q, near in brute_force(rows, [r for r in rows if r[0] % 100 == 0], len(rows)).items() for s, i in near}
    assert all(abs(exact[q, i] - s) < 1e-12 for q, near in found.items() for s, i in near)
    hits = [len({i for _, i in found[q]} & {i for _, i in wanted[q]}) / 10 for q in wanted]
    assert np.mean(hits) >= 0.9


def test_edges(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)]  # a third of all and more: one hot vector
    rows += [(1000 + i, [float(x) for x in rng.normal(size=3)]) for i in range(200)]
    pairs = [(3000 + i, [float(i), 1.0]) for i in range(0, 400, 10)]  # another length
    odd = [
        (2000, None), (2001, [0.0, 0.0, 0.0]), (2002, [1.0, None, 2.0]), (2003, [float("nan"), 1.0, 1.0]),
        (2004, [float("inf"), 1.0, 1.0]), (2005, [1.0, 2.0, 3.0, 4.0, 5.0]), (None, [1.0, 2.0, 3.0]), (2006, []),
    ]
    schema = "vec_id long, embedding array<double>"
    table = spark.createDataFrame([*rows, *pairs, *odd, rows[450]], schema).selectExpr("*", "1 as score", "2 as rank", "3 as id")
    asked = table.where("vec_id % 50 = 0")
    found = by_query(nearest_neighbours(table, asked, 5).collect())
    wanted = {
        **brute_force(rows, [r for r in rows if r[0] % 50 == 0], 5),
        **brute_force(pairs, [r for r in pairs if r[0] % 50 == 0], 5),
    }
    hot = [q for q in wanted if q < 400]
    assert set(found) == set(wanted) and all(found[q] == wanted[q] for q in hot)
    hits = [len({i for _, i in found[q]} & {i for _, i in wanted[q]}) / 5 for q in wanted]
    assert np.mean(hits) >= 0.9
    few = spark.createDataFrame(rows[398:403], schema)
    assert {len(v) for v in by_query(nearest_neighbours(few, few, 10).collect()).values()} == {4}
    assert nearest_neighbours(few.limit(0), few.limit(0)).count() == 0
    assert nearest_neighbours(few.limit(1), few.limit(1)).count() == 0


@pytest.mark.parametrize("shift", [0.0, 10.0, 1000.0])
def test_recall_far_from_the_origin(spark, shift):
    rng = np.random.default_rng(5)
    x = rng.normal(scale=0.1, size=(4000, 64)) + shift
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = by_query(nearest_neighbours(table, table.where("vec_id % 100 = 0"), 10).collect())
    hits = []
    for q in range(0, 4000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        near = np.argsort(d, kind="stable")[:10]
        hits.append(len({i for _, i in found[q]} & set(near.tolist())) / 10)
        assert all(s == d[i] or abs(s - d[i]) < 1e-12 for s, i in found[q])
    print("recall", shift, np.mean(hits))
    assert np.mean(hits) >= 0.95


def test_a_large_list_is_many_keys(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 8)
    monkeypatch.setattr(nearest, "PART", 2)
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(500, 4)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = nearest.build_index(nearest.usable(table, "vec_id", "embedding"), 4, 1000, lists=2)
    assert index.parts.count() == index.blocks.select("list", "part").distinct().count() > 20
    asked = nearest.usable(table, "vec_id", "embedding").where("id % 50 = 0").selectExpr("id", "vector", "double('inf') as bound")
    found = nearest._top(nearest._probe(asked, index, 4, 3, 0, 2), 3).collect()
    wanted = brute_force(rows, [r for r in rows if r[0] % 50 == 0], 3)
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in found} == {(q, n, i) for q, near in wanted.items() for n, (_, i) in enumerate(near, 1)}
