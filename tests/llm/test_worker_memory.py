"""What Python workers hold follows what they are given, not the room there is."""

import pickle
import tracemalloc

import numpy as np

from tidewater.llm import toxicity
from tidewater.llm.hashed_counts import _cells, add_cells


def test_a_model_travels_as_its_used_buckets():
    counts = np.zeros((3, 2, toxicity.BUCKETS), np.float32)
    counts[:, :, np.random.default_rng(2).integers(0, toxicity.BUCKETS, 5000)] = 7
    for model in (toxicity.ToxicityModel(counts, 0.2, 20.0, 0.5, k=0.3), toxicity.ToxicityModel(counts * 0, 0.2, 20.0, 0.5)):
        sent = pickle.dumps(model)
        got = pickle.loads(sent)
        assert len(sent) < 1 << 20  # 25 MB as an array
        assert (got.counts == model.counts).all() and got.counts.dtype == np.float32
        assert (got.share, got.strength, got.penalty, got.k) == (0.2, 20.0, 0.5, model.k)


def test_cells_are_counted_without_room_for_all():
    pick, buckets, classes = np.random.default_rng(3), 50, 2
    for once in (False, True):
        at, total, want = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((2, classes, buckets), np.int64)
        for words in (0, 300, 200):
            label = pick.integers(0, classes, 10)
            text = np.sort(pick.integers(0, 10, words))
            ids = [pick.integers(0, buckets, words) for _ in range(2)]
            at, total = add_cells(at, total, *_cells(label, text, ids, buckets, classes, once))
            for table, own in enumerate(ids):
                pairs = list(zip(text.tolist(), own.tolist()))
                for t, w in set(pairs) if once else pairs:
                    want[table, label[t], w] += 1
        assert at.tolist() == np.flatnonzero(want).tolist() and total.tolist() == want.ravel()[at].tolist()


def test_a_workers_counts_need_little_memory():
    buckets, ids = 1 << 20, [np.arange(1000)] * 3
    tracemalloc.start()
    at = total = np.zeros(0, np.int64)
    for _ in range(3):
        at, total = add_cells(at, total, *_cells(np.ones(10, np.int64), np.arange(1000) // 100, ids, buckets, 2, False))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(at) == 3000 and (total == 3).all()
    assert peak < 4 << 20  # 100 MB as two arrays of all cells
