"""Counts of hashed text features by class, from bounded labelled samples."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import text_bytes
from .shared import pack, unpack

#: Buckets that travel together.
SLICE = 1 << 16


def labelled_sample(labels: DataFrame, most: int, key: str = "doc_id") -> DataFrame:
    """At most ``most`` labelled rows, those with the smallest hash of the id: a
    sample that doesn't depend on order or partitions, small enough to broadcast."""
    return F.broadcast(labels.orderBy(F.xxhash64(F.lit("sample"), key), key).limit(most))


def add_cells(at: np.ndarray, total: np.ndarray, more: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sets of cells (ascending, distinct) and their counts as one. Memory goes with
    the cells that were seen, not with all there are."""
    both, which = np.unique(np.concatenate([at, more]), return_inverse=True)
    summed = np.zeros(len(both), np.int64)
    summed[which[:len(at)]] = total
    summed[which[len(at):]] += counts
    return both, summed


def _cells(label: np.ndarray, text: np.ndarray, ids: list[np.ndarray], buckets: int, classes: int, once: bool) -> tuple[np.ndarray, np.ndarray]:
    """The cells of some texts' words, and how often each is met; ``text`` is each word's text."""
    found = []
    for table, own in enumerate(ids):
        of = label[text]
        if once:
            pairs = np.unique(text * np.int64(buckets) + own)
            of, own = label[pairs // buckets], pairs % buckets
        found.append((table * classes + of) * buckets + own)
    return np.unique(np.concatenate(found), return_counts=True)


def class_counts(rows: DataFrame, features, tables: int, buckets: int, classes: int, once: bool = False) -> np.ndarray:
    """``counts[table, class, bucket]`` over rows ``(text, label)``, where
    ``features(data, offsets)`` yields ``(i, j, ids, first)``: for texts ``i`` to
    ``j``, ``ids[table]`` are the buckets of their words and ``first`` the index of
    each text's first word. With ``once`` a bucket counts once per text, so that a
    text that repeats one word many times weighs no more than another. Tasks send the buckets they have seen, packed; the sums
    (``tables * classes * buckets`` numbers) come to the driver."""
    cells = tables * classes * buckets

    def count(batches):
        at, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, ids, first in features(data, offsets):
                at, total = add_cells(at, total, *_cells(label, np.repeat(np.arange(i, j), np.diff(first)), ids, buckets, classes, once))
        import pyarrow as pa
        for low in np.unique(at // SLICE).tolist():
            a, b = np.searchsorted(at, [low * SLICE, (low + 1) * SLICE])
            yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([pack((at[a:b] - low * SLICE).astype(np.int32))]), pa.array([pack(total[a:b])])], ["slice", "cells", "counts"])

    def add(key: tuple, sent: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLICE, np.int64)
        for own, counts in zip(sent["cells"], sent["counts"]):
            total[unpack(own, np.int32)] += unpack(counts, np.int64)
        return pd.DataFrame({"slice": [key[0]], "counts": [pack(total)]})

    sent = rows.select("text", "label").mapInArrow(count, "slice long, cells binary, counts binary")
    summed = sent.groupBy("slice").applyInPandas(add, "slice long, counts binary").toPandas()
    total = np.zeros(-(-cells // SLICE) * SLICE, np.int64)
    for low, counts in zip(summed["slice"], summed["counts"]):
        total[low * SLICE:(low + 1) * SLICE] = unpack(counts, np.int64)
    return total[:cells].reshape(tables, classes, buckets)
