"""What a task of the decontamination holds for long texts full of the benchmark's words."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from partwise.llm.decontaminate import latent_space


class _Captured(Exception):
    pass


class _Texts:
    """Stands for a DataFrame: hands out the function that its tasks would run."""

    sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value)))

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        raise _Captured(run)


def projected(texts, n_terms):
    with pytest.raises(_Captured) as caught:
        latent_space(_Texts(), np.ones(n_terms, np.float32))
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary())], ["terms"])
    return list(caught.value.args[0](iter([batch])))[0]


def test_long_texts_are_projected_some_windows_at_a_time():
    """op4: a row of 96 numbers for each term of each passage of 64 texts was held twice."""
    random = np.random.default_rng(1)
    texts = [random.integers(0, 2000, 4000).astype(np.int32) for _ in range(64)]
    tracemalloc.start()
    whole = projected(texts, 2000)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 200, peak
    # the same sums as text by text
    total = np.zeros((2000, 96))
    for text in texts:
        part = projected([text], 2000)
        rows = part.column(0).to_numpy()
        total[rows] += np.column_stack([part.column(i + 1).to_numpy() for i in range(96)])
    assert np.allclose(np.column_stack([whole.column(i + 1).to_numpy() for i in range(96)]), total[whole.column(0).to_numpy()], rtol=1e-3, atol=1e-3)
