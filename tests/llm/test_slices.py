"""Memory of the pipeline's tasks: arrays are made for short slices of a batch, not for megabytes of text at once."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from commentguard.llm import decontaminate, language, ngram_join, secrets

MOST = 40  # MB of arrays for a batch of any size


class Shared:
    def __init__(self, value):
        self.value = value


@pytest.fixture(scope="module")
def batch():
    rng = np.random.default_rng(3)
    word = [f"{chr(97 + k % 26)}{k:x}" for k in rng.integers(0, 1 << 20, 4000)]
    texts = [" ".join(word[k] for k in rng.integers(0, len(word), 320)) for _ in range(4000)]
    assert sum(map(len, texts)) > 7 << 20
    return pa.table({"doc_id": range(len(texts)), "tkey": range(len(texts)), "text": texts}).combine_chunks().to_batches()[0]


STEPS = {
    "secrets count": lambda b: secrets._count([b.select(["text"]).rename_columns(["secret_text"])]),
    "secrets scan": lambda b: secrets._scan(np.zeros((len(secrets.ALPHABETS), len(secrets.LENGTHS)), np.int64), ["doc_id", "text"], "text", "[S]")([b]),
    "ngram sketch": lambda b: ngram_join._sketch([b]),
    "ngram grams": lambda b: ngram_join._gram_blobs([b]),
    "language": lambda b: language._score(Shared(language.Model(["a", "b"], np.zeros((2, 1 << 16), np.float32), np.zeros(2))), ["doc_id"], "text")([b]),
    "decontaminate": lambda b: decontaminate._scan(Shared(([], [])), ["doc_id"], 10, "text")([b]),
}


@pytest.mark.parametrize("step", STEPS)
def test_arrays_of_a_batch(batch, step):
    rows = 0
    tracemalloc.start()
    for out in STEPS[step](batch):
        rows += out.num_rows
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < MOST, peak
    assert rows == batch.num_rows or step == "secrets count"


def test_arrays_of_the_prune_table():
    # every worker that loads the module makes it
    tracemalloc.start()
    ngram_join.prune_table(0.8, ngram_join.HASHES, ngram_join.STEP, ngram_join.TOLERANCE)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 10, peak
