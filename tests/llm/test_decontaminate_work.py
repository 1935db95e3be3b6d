"""What the decontamination does for each word, and that nothing is lost by what it leaves out."""

import random
import time
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from partwise.llm import decontaminate
from partwise.llm.decontaminate import WINDOW, Items, latent_space


class _Captured(Exception):
    pass


class _Texts:
    """Stands for a DataFrame: hands out the function that its tasks would run."""

    sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value)))

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        raise _Captured(run)


def projected(texts, idf):
    with pytest.raises(_Captured) as caught:
        latent_space(_Texts(), idf)
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary())], ["terms"])
    (out,) = caught.value.args[0](iter([batch]))
    sums = np.zeros((len(idf), out.num_columns - 1))
    sums[out.column(0).to_numpy()] = np.column_stack([c.to_numpy() for c in out.columns[1:]])
    return sums


def test_sums_are_those_of_the_whole_matrix():
    """A^T A R with A written out: rows are passages, of length 1."""
    random_ = np.random.default_rng(2)
    idf = (random_.random(700) + 0.2).astype(np.float32)
    texts = [random_.integers(-300, 700, n).clip(-1).astype(np.int32) for n in (0, 1, 15, 16, 17, 31, 32, 33, 48, 49, 900, 2500)]
    rows = []
    for text in texts:
        for at in range(0, max(1, len(text)), WINDOW):
            passage = text[at : at + WINDOW]
            row = np.bincount(passage[passage >= 0], minlength=700) * idf.astype(float)
            rows.append(row / max(np.linalg.norm(row), 1e-9))
    whole, start = np.array(rows), np.random.default_rng(0).normal(size=(700, 96))
    assert np.allclose(projected(texts, idf), whole.T @ (whole @ start), rtol=1e-3, atol=1e-3)


def test_cpu_time_of_the_projection():
    """op4: sums by term took some 38 times as long as fetching a row for each word once; now it is some 12 times."""
    random_ = np.random.default_rng(3)
    idf = (random_.random(2000) + 0.2).astype(np.float32)
    texts = [(2000 * random_.random(400) ** 2).astype(np.int32) for _ in range(640)]
    table, terms = random_.normal(size=(2000, 96)).astype(np.float32), np.concatenate(texts)

    def seconds(run):
        start = time.process_time()
        run()
        return time.process_time() - start

    fetched = min(seconds(lambda: [table.take(terms[a : a + 25_600], 0) for a in range(0, len(terms), 25_600)]) for _ in range(5))
    taken = min(seconds(lambda: projected(texts, idf)) for _ in range(5))
    assert taken < 24 * fetched, (taken, fetched)


def test_few_pairs_are_compared_word_by_word(monkeypatch):
    """The bits of terms leave out most pairs of near windows and passages, and nothing that is found."""
    rng = random.Random(11)
    say = lambda n: [f"w{int(1500 * rng.random() ** 2)}" for _ in range(n)]
    rows = [(i, " ".join(say(rng.choice([13, 20, 33, 50, 90]))) + ". " + " ".join(say(4)) + ".", None) for i in range(60)]
    items = Items(rows)
    texts = []
    for d in range(60):
        planted = [w if rng.random() < 0.9 else "other" for w in rows[d][1].replace(".", "").split()] if d % 3 == 0 else []
        said = say(rng.randrange(0, 500)) + planted + say(rng.randrange(0, 500))
        texts.append(np.array([items.terms.get(w.encode(), -1) for w in said], np.int32))
    texts += [np.zeros(0, np.int32), np.full(3, -1, np.int32)]
    n_terms = len(items.terms)
    idf = (np.random.default_rng(1).random(n_terms) + 0.5).astype(np.float32)
    u, s, _ = np.linalg.svd(projected(texts, idf), full_matrices=False)
    model = decontaminate._model(items, idf, (u / np.maximum(s, 1e-9)).astype(np.float32))
    compared = []
    count = np.count_nonzero
    monkeypatch.setattr(np, "count_nonzero", lambda *a, **b: compared.append(1) or count(*a, **b))
    found = decontaminate._matches(texts, items, model)
    few = len(compared)
    compared.clear()
    monkeypatch.setattr(decontaminate, "_missing", lambda signs, which, there: np.zeros(len(which), np.int64))
    assert sorted(found) == sorted(decontaminate._matches(texts, items, model))
    assert len(found) >= 18 and few * 10 < len(compared), (len(found), few, len(compared))


def test_long_texts_are_searched_some_at_a_time():
    """op4: 64 texts of 20,000 words took 200 MB together."""
    random_ = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(2000)]
    items = Items([(i, " ".join(vocabulary[w] for w in random_.integers(0, 2000, 40)), None) for i in range(200)])
    n_terms = len(items.terms)
    idf = np.ones(n_terms, np.float32)
    model = decontaminate._model(items, idf, random_.normal(size=(n_terms, 96)).astype(np.float32))
    texts = [random_.integers(-1, n_terms, 20_000).astype(np.int32) for _ in range(64)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary())], ["terms"])
    tracemalloc.start()
    for _, slice_ in decontaminate._slices([batch]):
        decontaminate._matches(slice_, items, model)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 120, peak


def test_slices_of_long_texts_hold_fewer():
    lengths = [5, 0, 90_000, 90_000, 200_000, 3, 400_000, *[1000] * 200]
    texts = [np.full(n, i, np.int32) for i, n in enumerate(lengths)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary()), pa.array(range(len(texts)))], ["terms", "id"])
    slices = list(decontaminate._slices([batch, batch.slice(0, 0)]))
    assert [i for rows, _ in slices for i in rows.column(1).to_pylist()] == list(range(len(texts)))
    assert [len(t) for _, of in slices for t in of] == lengths
    assert all(rows.num_rows == len(of) <= decontaminate.TEXTS_AT_ONCE for rows, of in slices)
    assert max(sum(map(len, of[1:])) for _, of in slices) <= decontaminate.WORDS_AT_ONCE
