import hashlib
import random
import zlib

from pyspark.sql import functions as F

from partwise.llm.merkle import merkle_manifest
from partwise.llm.queries import op12_merkle_manifest
from partwise.llm.tables import read

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def proofs(digests):
    """The top of a tree of 16s, and for each leaf the runs it is in: (run, place in it)."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i : i + 16] for i in range(0, len(digests), 16)]
        for path, i in zip(paths, at):
            path.append((runs[i // 16], i % 16))
        at, digests = [i // 16 for i in at], [h(*run) for run in runs]
    return digests[0], paths


def brute_force(rows, tampered):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], leaf_of(row), leaf_of(tampered(row))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: proofs([leaf for _, leaf, _ in groups[g]]) for g in order}
    if not order:
        return []
    root, above = proofs([trees[g][0] for g in order])
    found = []
    for g, upper in zip(order, above):
        for (id_, leaf, claimed), path in zip(groups[g], trees[g][1]):
            fold, siblings = claimed, []
            for run, place in path + upper:
                siblings += run[:place] + run[place + 1 :]
                fold = h(*run[:place], fold, *run[place + 1 :])
            found.append((id_, leaf, trees[g][0], root, h(*siblings), fold, fold == root))
    return found


def tamper(row):
    if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
        return (*row[:4], row[4].translate(LOWER))
    return row


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v) for v in r))


def check(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string, grp int, path int, digest int, lo int, row int"
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], schema)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lower).otherwise(F.col("text"))
    found = merkle_manifest(docs, claimed={"text": claimed}).drop("path").collect()
    assert ordered(found) == ordered(brute_force(rows, tamper))


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = op12_merkle_manifest(spark, sf_dir)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = found.collect()
    assert ordered(got) == ordered(brute_force(rows, tamper))
    assert {r["verified"] for r in got} == {True, False}


def test_group_sizes_at_the_edges_of_runs(spark):
    """1, 2, 15, 16, 17, 33, 256, 257 and 290 rows a group: the last runs of a level hold one node and more."""
    rng, rows = random.Random(1), []
    for n in (1, 2, 15, 16, 17, 33, 256, 257, 290):
        rows += [(rng.randrange(10**6), f"g{n}", "en", i, f"Text {n} {i}") for i in range(n)]
    check(spark, rows)


def test_nulls_ties_repeated_rows_long_texts(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, "a", "x", 1, "T"), (5, None, "x", 1, "A B")]
    rows += [(7, "hot", "en", 3, "Same")] * 40 + [(7, "hot", "en", 3, None), (7, "hot", "en", 3, ""), (10, "é", "ü", -4, "Ä Z")]
    rows += [(i, "B", "en", i, "WORD " * 200_000 if i == 3 else "-") for i in range(20)] + [(3, "", "", 0, "1:A"), (15, "b", "", 0, "Q")]
    check(spark, rows)


def test_many_groups_lone_row_and_empty_table(spark):
    check(spark, [(i, f"s{i:03}", None, i, "X") for i in range(40)] + [(99, "s001", None, 1, "Y")])
    check(spark, [(1, "s", "en", 1, "Lone")])
    check(spark, [])


def test_paths_give_the_digests_of_siblings(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, str(i)) for i in range(18)], "doc_id long, source string, lang string, n_chars long, text string")
    by_id = {r["doc_id"]: r for r in merkle_manifest(docs).collect()}
    assert all(r["verified"] for r in by_id.values())
    leaves = [by_id[i]["leaf"] for i in range(18)]
    assert by_id[17]["path"][0]["left"] == leaves[16] and by_id[17]["path"][0]["right"] == ""
    assert by_id[3]["path"][0]["left"] == "".join(leaves[:3]) and by_id[3]["path"][1]["right"] == h(*leaves[16:])
