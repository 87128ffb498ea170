"""Toxic passages by maximum-scoring segment search.

Each word scores the log-odds of its class counts in labelled texts (once per
text), under a Dirichlet prior whose mean comes from the word's stem (its first bytes), whose
own prior comes from a shorter stem and at last from all words. A fixed penalty
makes a harmless text drift downward. The Ruzzo-Tompa scan finds, in linear
time, all disjoint segments of maximal score.

Scores of best segments follow an extreme-value law: in ``m`` harmless words,
segments of score ``S`` or more number about ``K m exp(-lambda S)``. ``lambda``
solves ``E[exp(lambda s)] = 1`` over words of harmless labelled texts and ``K``
is fitted to their best segments. Several segments of a text are taken together
by the law for their sum; a logistic curve over the logarithm of ``-log`` of the
smallest p-value gives a score from 0 to 1. Segments are searched and reported on
the words' own scores; what a text repeats is discounted in its score alone. The law and the curve are fitted on labelled
texts whose words were not counted.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashed_counts import class_counts, labelled_sample
from .kernels import PLAIN, Rolling, chunks, text_bytes, word_spans
from .shared import pack, small_batches, unpack

#: Buckets of each hashed table (words, longer stems, shorter stems).
BUCKETS = 1 << 20
STEMS = (6, 4)


def word_buckets(data: np.ndarray, offsets: np.ndarray, rolling: Rolling, most: int = 1 << 20):
    """For :func:`class_counts`: buckets of words and stems. Words end at blanks and
    ASCII punctuation."""
    for i, j in chunks(offsets, most):
        part = PLAIN[data[offsets[i]:offsets[j]]]
        starts, ends, first = word_spans(part, offsets[i:j + 1] - offsets[i])
        rolling.load(part)
        spans = [ends] + [np.minimum(ends, starts + stem) for stem in STEMS]
        ids = [(rolling.of(starts, end) & np.uint64(BUCKETS - 1)).astype(np.int64) for end in spans]
        yield i, j, ids, first


@dataclass
class ToxicityModel:
    counts: np.ndarray  # [table, class, bucket]
    share: float
    strength: float
    penalty: float
    rate: float = 1.0  # lambda
    k: float = 1.0
    slope: float = 0.0
    level: float = 0.0

    def __getstate__(self) -> dict:
        """Few buckets are in use: the counts travel to the workers as those that are not
        zero, a small part of the array's 4 bytes a bucket."""
        flat = self.counts.ravel()
        at = np.flatnonzero(flat)
        return {**self.__dict__, "counts": (self.counts.shape, self.counts.dtype.str, pack(at), pack(flat[at]))}

    def __setstate__(self, state: dict) -> None:
        shape, kind, at, values = state["counts"]
        counts = np.zeros(math.prod(shape), kind)
        counts[unpack(at, np.int64)] = unpack(values, kind)
        self.__dict__.update(state, counts=counts.reshape(shape))

    def word_scores(self, ids: list[np.ndarray]) -> np.ndarray:
        q = np.full(len(ids[0]), self.share)
        for table in range(len(ids) - 1, -1, -1):
            clean, toxic = self.counts[table, 0, ids[table]], self.counts[table, 1, ids[table]]
            q = (toxic + self.strength * q) / (clean + toxic + self.strength)
        return np.log(q / (1 - q)) - math.log(self.share / (1 - self.share)) - self.penalty

    def evidence(self, sums: list[float], words: int) -> float:
        """``-log`` p-value of the best segments of ``words`` words: over the ``r`` best
        for each ``r``, the sum's law ``exp(-t) t**(r-1) / (r! (r-1)!)``, which holds for
        ``t > r (r + 1)``."""
        best, total = 0.0, 0.0
        base = math.log(max(self.k * words, 1e-9))
        for r, s in enumerate(sorted(sums, reverse=True), 1):
            own = self.rate * s - base
            if own <= 0:
                break
            total += own
            if r > 1 and total <= r * (r + 1):
                break
            best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
        return best

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.level + self.slope * math.log1p(evidence)))))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, sum)``, by Ruzzo and Tompa: only
    words of positive score open a segment; links lead to the last segment that
    starts lower."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    left, right, start, end, link = [], [], [], [], []
    for i in np.flatnonzero(scores > 0).tolist():
        low, high, a = float(sums[i]), float(sums[i + 1]), i
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= low:
                j = link[j]
            if j < 0 or right[j] >= high:
                left.append(low)
                right.append(high)
                start.append(a)
                end.append(i + 1)
                link.append(j)
                break
            low, a = left[j], start[j]
            del left[j:], right[j:], start[j:], end[j:], link[j:]
    return [(a, b, h - l) for a, b, l, h in zip(start, end, left, right)]


def fading(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positive scores of a word's n-th use, divided by n."""
    up = np.flatnonzero(scores > 0)
    order = np.argsort(ids[up], kind="stable")
    new = np.concatenate([[True], np.diff(ids[up][order]) != 0])[:len(order)]
    since = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    out = scores.copy()
    out[up[order]] /= since + 1
    return out


def discounted(scores: np.ndarray, ids: np.ndarray, found: list[tuple[int, int, float]]) -> list[float]:
    """The segments' sums as evidence on the whole text: words repeated inside a
    segment fade, and the n-th of equal segments counts one n-th. What a text repeats
    a thousand times is no evidence of a thousand; its passages stay what they are."""
    seen, out = Counter(), []
    for a, b, _ in found:
        words = ids[a:b].tobytes()
        seen[words] += 1
        out.append(float(fading(scores[a:b], ids[a:b]).sum()) / seen[words])
    return out


def _segments(model: ToxicityModel, texts):
    """For each text: its words' scores and buckets, and its maximal segments."""
    data, offsets = text_bytes(texts)
    for _, _, ids, first in word_buckets(data, offsets, Rolling(13)):
        scores = model.word_scores(ids)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield scores[a:b], ids[0][a:b], maximal_segments(scores[a:b])


def _rate(scores: np.ndarray, weight: np.ndarray) -> float:
    """The positive solution of ``E[exp(rate * s)] = 1``."""
    low, high = 1e-3, 1.0
    mean = lambda x: float((weight * np.exp(x * scores)).sum() / weight.sum())
    if not weight.sum() or not (scores[weight > 0] > 0).any():
        return 1.0
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 1 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic curve, by Newton steps with a weak prior."""
    design = np.stack([x, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + 1e-3 * beta
        hessian = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


#: Log-odds of a score of 0.25, where there are no labelled rows to fit a curve on.
UNLABELLED = -math.log(3)


def fit(
    docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, strength: float = 20.0, penalty: float = 0.5,
    doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> ToxicityModel:
    """Learns from the rows of ``labels`` that are given (leave out what is held
    out): a sample of at most ``most_labelled`` of them, three quarters for counts,
    the others for the law and the curve, which sees the best 64 segments of a text.
    Null labels and ids are left out; an id with several labels counts as toxic if one
    of them is 1. Without rows for the curve nothing is known against any text: every
    score is 0.25, so that none is predicted to be toxic."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
    known = known.groupBy(F.col(f"`{doc_id}`").alias("label_id")).agg(F.max((F.col(f"`{label}`") == 1).cast("int")).alias("label"))
    sample = labelled_sample(known, most_labelled, "label_id")
    texts = docs.select(F.col(f"`{doc_id}`").alias("label_id"), F.col(f"`{text}`").alias("text")).join(sample, "label_id")
    part = F.pmod(F.xxhash64(F.lit("fit"), "label_id"), F.lit(4))
    rolling = Rolling(13)
    counts = class_counts(texts.where(part > 0), lambda data, offsets: word_buckets(data, offsets, rolling), 1 + len(STEMS), BUCKETS, 2, once=True)
    total = counts[0].sum(axis=1)
    model = ToxicityModel(counts.astype(np.float32), float((total[1] + 1) / (total.sum() + 2)), strength, penalty)
    grid = np.linspace(-8, 8, 1601)

    def measure(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            spread, out = np.zeros(len(grid), np.int64), []
            for own, (scores, words, found) in zip(toxic, _segments(model, batch.column(0))):
                if not own:
                    spread += np.bincount(np.clip(np.rint((scores + 8) * 100), 0, 1600).astype(np.int64), minlength=len(grid))
                out.append((int(own), len(scores), max((s for _, _, s in found), default=0.0), sorted(discounted(scores, words, found), reverse=True)[:64]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.list_(pa.float64())),
                 pa.array([spread.tolist()] + [None] * (len(out) - 1), pa.list_(pa.int64()))], ["toxic", "words", "best", "sums", "spread"])

    measured = texts.where(part == 0).select("text", "label").mapInArrow(measure, "toxic long, words long, best double, sums array<double>, spread array<long>").toPandas()
    spread = np.sum([np.asarray(x) for x in measured["spread"] if x is not None], axis=0) if len(measured) else np.zeros(len(grid))
    model.rate = _rate(grid, np.asarray(spread, np.float64) * np.ones(len(grid)))
    clean = measured[(measured["toxic"] == 0) & (measured["words"] > 0)]
    tail = sum(w * math.exp(-model.rate * s) for w, s in zip(clean["words"], clean["best"]))
    model.k = len(clean) / tail if tail else 1.0
    evidence = np.array([model.evidence(list(s), max(int(w), 1)) for w, s in zip(measured["words"], measured["sums"])])
    if len(measured):
        model.slope, model.level = _logistic(np.log1p(evidence), measured["toxic"].to_numpy(np.float64))
    else:
        model.slope, model.level = 0.0, UNLABELLED
    return model


def scorer(model: ToxicityModel, significance: float = 0.01):
    """A column function from a text to ``struct(score, n_words, passages)``;
    ``passages`` lists every segment with fewer than ``significance`` expected by
    chance as ``start, end`` in words."""
    kind = pa.struct([("score", pa.float64()), ("n_words", pa.int64()), ("passages", pa.list_(pa.int64()))])

    @F.arrow_udf("score double, n_words bigint, passages array<bigint>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            out = []
            for scores, ids, found in _segments(model, texts):
                words = max(len(scores), 1)
                chance = math.log(max(model.k * words, 1e-9))
                least = (chance - math.log(significance)) / model.rate
                sums = discounted(scores, ids, [f for f in found if model.rate * f[2] > chance])  # others are no evidence
                out.append((model.score(model.evidence(sums, words)), len(scores), [x for a, b, s in found if s >= least for x in (a, b)]))
            yield pa.array([dict(zip(("score", "n_words", "passages"), o)) for o in out], kind)

    return run


def score_texts(docs: DataFrame, model: ToxicityModel, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``into``: ``struct(score, n_words, passages)``. Null and
    empty texts have no words and the score of no evidence. Every row is scored by
    itself; an empty table stays empty."""
    small_batches(docs.sparkSession)
    return docs.withColumn(into, scorer(model)(F.col(f"`{text}`").cast("string")))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))
