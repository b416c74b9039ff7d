"""What the language tasks hold while they take texts apart."""
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from grainline.llm import language as L
from grainline.llm import text as T


def _batch():
    """One batch of 8 MB: random words of six letters, few of them twice."""
    rng = np.random.default_rng(3)
    words = rng.integers(97, 103, (900_000, 9), np.uint8)
    words[:, 8] = 32
    n = 300
    texts = pa.array([w.tobytes().decode() for w in np.split(words, n)])
    return pa.record_batch([pa.array(np.arange(n)), pa.array(np.zeros(n, np.int32)), pa.array(np.arange(n)), pa.array(np.ones(n, bool)),
                            texts, pa.array(["a"] * n)], names=[T.K1, T.K2, "doc_id", "train", "text", "lang"])


@pytest.mark.parametrize("task", ["count", "score"])
def test_language_tasks_hold_a_piece_of_a_batch(task):
    """About 145 MB; 500 MB and more in pieces of 4 MB."""
    batch = _batch()
    run = L._score(SimpleNamespace(value=(np.zeros(0, np.uint64), np.zeros((0, 2), np.float32))), 2, L.ORDER)
    if task == "count":
        run, batch = L._count(L.ORDER), batch.select(["lang", "text"])
    tracemalloc.start()
    done = sum(b.num_rows for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done and peak < 250e6
