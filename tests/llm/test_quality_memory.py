"""What the driver holds while a classifier is trained."""

import tracemalloc

import numpy as np

from samplecraft.llm import quality


def test_training_lays_out_the_words_of_some_documents_at_a_time():
    random, n, labelled, words = np.random.default_rng(1), 6_000, 600, 300
    y = np.full(n, np.nan)
    y[:labelled] = np.arange(labelled) % 2
    terms = random.integers(1_000, 1 << 62, (n, words)).astype(np.uint64)
    terms[:, 0] = np.where(np.nan_to_num(y) > 0, 1, 2)  # words that tell the label
    bounds, looks, meta = np.arange(n + 1) * words, random.random((n, quality.LOOKS)), np.zeros((n, 1), np.float32)
    model = quality.Model((), (), [quality._edges(looks[:, k]) for k in range(quality.LOOKS)], [])
    fold = np.arange(n) % 5 == 0
    tracemalloc.start()
    target = quality.cotrained(model, looks, terms.ravel(), bounds, meta, y, fold, rounds=0)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert set(target.terms.tolist()) == {1, 2}
    assert most < terms.nbytes  # less than one more number for every word
