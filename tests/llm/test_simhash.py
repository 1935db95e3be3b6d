import random

import numpy as np
import xxhash

from partwise.llm.queries import op13_simhash
from partwise.llm.simhash import SECTIONS, fingerprint, forest, near_pairs, simhash_duplicates, tile_links
from partwise.llm.tables import read


def plain_fingerprint(text, words):
    cut = (text or "").encode().lower().split()
    size = min(words, len(cut))
    made = [b" ".join(cut[i : i + size]) for i in range(len(cut) - size + 1)] if cut else []
    hashed = [xxhash.xxh64_intdigest(s, 42) for s in made]
    return sum(1 << bit for bit in range(64) if 2 * sum(x >> bit & 1 for x in hashed) > len(hashed))


def components(fps, ids):
    """The least id each can reach, by comparing all with all."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, id_ in enumerate(ids):
        if id_ is not None:
            least[find(i)] = min(id_, least.get(find(i), id_))
    return [least.get(find(i)) for i in range(len(fps))]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v) for v in r))


def check(spark, rows, words=3):
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, fp int, id int, component_id int")
    found = simhash_duplicates(docs, words=words).select("doc_id", "fingerprint", "component_id").collect()
    fps = [plain_fingerprint(t, words) for _, t in rows]
    roots = components(fps, [i for i, _ in rows])
    assert ordered(found) == ordered((i, f"{fp:016x}", root) for (i, _), fp, root in zip(rows, fps, roots))


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = op13_simhash(spark, sf_dir).select("doc_id", "fingerprint", "component_id").collect()
    fps = [plain_fingerprint(t, 3) for _, t in rows]
    roots = components(fps, [i for i, _ in rows])
    assert ordered(found) == ordered((i, f"{fp:016x}", root) for (i, _), fp, root in zip(rows, fps, roots))
    assert len(set(roots)) < len(rows)


def test_nulls_empty_ties_repeats_and_long_texts(spark):
    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(200_000))
    rows = [(5, None), (3, ""), (9, " \t\n\x0b"), (None, None), (None, "only here and null"), (7, "Two Words"), (6, "two words")]
    rows += [(1, long), (2, long + " tail"), (2, "a b c"), (2, "a b c"), (8, "a\x0cb\rc"), (4, "Ä B C"), (10, "ä b c"), (11, "x")]
    check(spark, rows)
    check(spark, [(None, "q r s t"), (None, "q r s t")])


def test_empty_table(spark):
    check(spark, [])


def test_groups_of_near_copies(spark):
    """Long texts with one to many words changed: chains of links over the radius."""
    rng, rows = random.Random(3), []
    for group in range(4):
        base = [f"w{rng.randrange(400)}" for _ in range(300)]
        for i in range(60):
            copy = list(base)
            for _ in range(rng.randrange(0, 25)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(9)}"
            rows.append((rng.randrange(10**6), " ".join(copy)))
    check(spark, rows)


def flipped(rng, fp, bits):
    for bit in rng.sample(range(64), bits):
        fp ^= 1 << bit
    return fp


def test_links_join_what_all_pairs_join(spark):
    """Fingerprints 0 to 8 bits apart in full and in partly filled tiles, all zeros and all ones among them."""
    rng = random.Random(4)
    fps = {0, 2**64 - 1, 1, 7, 15, 2**64 - 2, 2**63}
    for _ in range(40):
        base = rng.getrandbits(64)
        fps |= {flipped(rng, base, rng.randrange(9)) for _ in range(30)}
    fps = sorted(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    for tile in (1, 3, 4096):
        table = spark.createDataFrame([(f,) for f in signed], "fp long")
        links = tile_links(table, 3, tile).collect()
        root = {f: f for f in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            assert ((a ^ b) & (2**64 - 1)).bit_count() <= 64
            root[find(a)] = find(b)
        wanted = components(fps, list(range(len(fps))))
        got = [find(f) for f in signed]
        assert len(set(zip(wanted, got))) == len(set(wanted)) == len(set(got))


def test_forest_spans_dense_tiles():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 1, dtype=np.uint64)[0]
    near = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64)))
    x, y = forest(near, near, 3)
    assert len(x) <= 2 * len(near)
    joined = {int(v) for v in x} | {int(v) for v in y}
    assert joined >= {int(v) for v in near}
    pairs = sum(len(i) for i, _ in near_pairs(near, near, 3))
    assert pairs > 10 * len(x)


def test_profiles_bound_the_distance():
    rng = random.Random(6)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = flipped(rng, a, rng.randrange(7))
        parts = [(x >> 16 * s & 0xFFFF).bit_count() - (y >> 16 * s & 0xFFFF).bit_count() for x, y in [(a, b)] for s in range(SECTIONS)]
        assert sum(map(abs, parts)) <= (a ^ b).bit_count()


def test_fingerprint_in_pieces(monkeypatch):
    import partwise.llm.simhash as module

    text = " ".join(str(i % 37) for i in range(1000)).encode()
    whole = fingerprint(text, 3, 42)
    monkeypatch.setattr(module, "SHINGLES_AT_ONCE", 7)
    assert fingerprint(text, 3, 42) == whole == plain_fingerprint(text.decode(), 3)
