"""Document rates that mix domains to target weights, with soft membership.

A naive Bayes classifier fitted on a labelled table gives each document a
posterior over domains. A document of ``t`` tokens then adds ``t * p`` tokens to
the domains in expectation. Projected-gradient least squares finds nonnegative
rates ``r`` (the expected number of copies of each document) whose totals
``sum r t p`` match the targets, starting from one for all.

The gradient of a document is its posterior times the domains' weighted
residuals, a vector as long as the list of domains. So a document's rate is a
function of its posterior and the residuals of all steps so far: a step is one
aggregation over the written posteriors, which replays the steps on arrays, and
nothing per document is kept between steps or sent to the driver.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashed_counts import class_counts, labelled_sample
from .kernels import Rolling, text_bytes, word_hashes
from .shared import free_name, small_batches, written

BUCKETS = 1 << 18


def _buckets(data, offsets, rolling):
    for i, j, hashes, first in word_hashes(rolling, data, offsets, 1 << 20):
        yield i, j, [(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)], first


@dataclass
class DomainModel:
    domains: list[str]
    log_prior: np.ndarray
    log_word: np.ndarray  # [bucket, domain]
    effective_words: float

    def posteriors(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """``words, posterior[text, domain]``. A text's evidence counts as that of
        ``effective_words`` words at most, since words of a text aren't independent."""
        data, offsets = text_bytes(texts)
        words, out = [], [np.zeros((0, len(self.domains)))]
        for _, _, ids, first in _buckets(data, offsets, Rolling(17)):
            n = np.diff(first)
            sums = np.concatenate([np.zeros((1, len(self.domains))), np.cumsum(self.log_word[ids[0]], axis=0, dtype=np.float64)])
            evidence = sums[first[1:]] - sums[first[:-1]]
            evidence *= (np.minimum(n, self.effective_words) / np.maximum(n, 1))[:, None]
            logit = self.log_prior + evidence
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            words.append(n)
            out.append(p / p.sum(axis=1, keepdims=True))
        return np.concatenate([np.zeros(0, np.int64), *words]), np.concatenate(out)


def fit_domains(
    docs: DataFrame, labelled: DataFrame, most_labelled: int = 20_000, effective_words: float = 50.0,
    doc_id: str = "doc_id", text: str = "text", domain: str = "domain",
) -> DomainModel:
    """From at most ``most_labelled`` rows of ``labelled`` (id and domain). Null ids
    and domains are left out; an id with several domains takes the smallest name.
    Without labelled rows there is one domain, the empty name."""
    small_batches(docs.sparkSession)
    known = labelled.where(F.col(f"`{doc_id}`").isNotNull() & F.col(f"`{domain}`").isNotNull())
    known = known.groupBy(F.col(f"`{doc_id}`").alias("label_id")).agg(F.min(F.col(f"`{domain}`").cast("string")).alias("domain"))
    names = sorted(r[0] for r in known.select("domain").distinct().limit(1000).collect()) or [""]
    if len(names) == 1000:
        raise ValueError("domains must be fewer than 1000")
    number = F.coalesce(*[F.when(F.col("domain") == name, F.lit(i)) for i, name in enumerate(names)])
    sample = labelled_sample(known.select("label_id", number.alias("label")), most_labelled, "label_id")
    texts = docs.select(F.col(f"`{doc_id}`").alias("label_id"), F.col(f"`{text}`").alias("text")).join(sample, "label_id")
    rolling = Rolling(17)
    counts = class_counts(texts, lambda data, offsets: _buckets(data, offsets, rolling), 1, BUCKETS, len(names))[0].astype(np.float64)
    shared = (counts.sum(axis=0) + 1) / (counts.sum() + BUCKETS)  # prior mean: all domains' words
    strength = 1000.0
    word = (counts + strength * shared) / (counts.sum(axis=1, keepdims=True) + strength)
    prior = counts.sum(axis=1) + 1
    return DomainModel(names, np.log(prior / prior.sum()), np.log(word).T.astype(np.float32), effective_words)


@dataclass
class Rates:
    """Steps of the projected gradient: ``r <- max(0, r - p . step)`` for each."""

    steps: list[np.ndarray] = field(default_factory=list)

    def of(self, p: np.ndarray) -> np.ndarray:
        rate = np.ones(len(p))
        for step in self.steps:
            rate = np.maximum(0.0, rate - p @ step)
        return rate


def _sums(table: DataFrame, rates: Rates, domains: int, gram: bool) -> np.ndarray:
    """Sum over documents of ``r t p``, or of ``t p p'``."""
    def run(batches):
        total = np.zeros(domains * domains if gram else domains)
        for batch in batches:
            p = np.asarray(batch.column(1).flatten()).reshape(-1, domains)
            t = batch.column(0).to_numpy().astype(np.float64)
            total += ((p * t[:, None]).T @ p).ravel() if gram else (rates.of(p) * t) @ p
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array(total)], ["at", "value"])

    lines = table.select("n_tokens", "posterior").mapInArrow(run, "at long, value double")
    summed = lines.groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(domains * domains if gram else domains)
    out[summed["at"]] = summed["value"]
    return out.reshape(domains, domains) if gram else out


def fit_rates(table: DataFrame, weights: np.ndarray | None, tokens: float | None = None, temper: float = 0.7, tolerance: float = 1e-4, most_steps: int = 40) -> tuple[Rates, np.ndarray, np.ndarray, np.ndarray]:
    """Rates over ``table`` (``n_tokens, posterior``); also the domains' tokens before,
    the targets, and the tokens reached. ``weights`` (nonnegative) are the domains'
    target shares of ``tokens``; by default shares to the power ``temper`` of all
    tokens there are. Residuals are weighted by the domains' own curvature and the
    documents' steps by their lengths; the step size is the inverse of the largest
    curvature left. Steps end when all targets are met to ``tolerance`` of the total,
    when the gradient vanishes (targets out of reach), or after ``most_steps``."""
    domains = len(table.select("posterior").first()[0])
    rates = Rates()
    gram = _sums(table, rates, domains, True)
    now = before = gram.sum(axis=1)  # posteriors sum to one
    if weights is None:
        weights = np.where(before > 0, before, 0) ** temper
    target = np.asarray(weights, np.float64) / max(np.sum(weights), 1e-300) * (before.sum() if tokens is None else tokens)
    scale = 1 / np.maximum(np.diag(gram), 1e-9)
    half = np.sqrt(scale)
    curvature = np.linalg.eigvalsh(half[:, None] * gram * half[None, :]).max() if before.sum() else 1.0
    for _ in range(most_steps if before.sum() else 0):
        step = scale * (now - target) / max(curvature, 1e-9)
        if np.abs(now - target).max() <= tolerance * max(target.sum(), 1.0) or np.abs(step).max() < 1e-9:
            break
        rates.steps.append(step)
        now = _sums(table, rates, domains, False)
    return rates, before, target, now


def mix(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, tokens: float | None = None, temper: float = 0.7,
    most_labelled: int = 20_000, doc_id: str = "doc_id", text: str = "text", domain: str = "domain", into: str = "mixture",
) -> DataFrame:
    """``docs`` with a column ``into``: ``struct(n_tokens, posterior, domain, rate, copies)``.
    A column of that name is replaced. Targets that can't be met, or aren't after all
    steps, are a warning that says how far they are missed.

    ``rate`` is the expected number of copies and ``copies`` a whole number of that
    mean, from a hash of id and text. Null text has no tokens, the prior as its
    posterior, and counts for nothing in the totals; its rate follows from the
    posterior like any other. Null ids and rows that repeat an id are documents by
    themselves. Domains missing from ``weights`` have weight zero. An empty table
    stays empty.
    """
    model = fit_domains(docs, labelled, most_labelled, doc_id=doc_id, text=text, domain=domain)
    kind = pa.struct([("n_tokens", pa.int64()), ("posterior", pa.list_(pa.float64()))])

    @F.arrow_udf("n_tokens bigint, posterior array<double>")
    def member(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            words, p = model.posteriors(texts)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * len(model.domains), pa.int32()), pa.array(p.ravel()))
            yield pa.StructArray.from_arrays([pa.array(words), flat], fields=list(kind))

    own = member(F.col(f"`{text}`").cast("string"))
    table = written(docs.select(own.alias("m")).select("m.n_tokens", "m.posterior"), "posteriors")
    wanted = None if weights is None else np.array([weights.get(name, 0.0) for name in model.domains])
    if table.limit(1).count():
        rates, _, target, reached = fit_rates(table, wanted, tokens, temper)
        gap = np.abs(reached - target).max() / max(target.sum(), 1.0)
        if gap > 1e-3:
            missed = {d: (round(float(a)), round(float(b))) for d, a, b in zip(model.domains, reached, target)}
            warnings.warn(f"targets missed by up to {gap:.2%} of all tokens: reached and wanted {missed}", stacklevel=2)
    else:
        rates = Rates()

    @F.arrow_udf("double")
    def rate(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            p = np.asarray(column.flatten()).reshape(-1, len(model.domains))
            yield pa.array(rates.of(p))

    own_p = F.col(f"{free_name(docs, 'member')}.posterior")
    name = F.element_at(F.array(*[F.lit(d) for d in model.domains]), F.array_position(own_p, F.array_max(own_p)).cast("int"))
    chance = F.pmod(F.xxhash64(F.lit("copies"), F.col(f"`{doc_id}`"), F.col(f"`{text}`")), F.lit(1 << 20)) / float(1 << 20)
    m, r = free_name(docs, "member"), free_name(docs, "member_rate")
    placed = docs.withColumn(m, own).withColumn(r, rate(F.col(f"{m}.posterior")))
    copies = F.floor(r) + (chance < F.col(r) - F.floor(r)).cast("long")
    mixture = F.struct(F.col(f"{m}.n_tokens").alias("n_tokens"), own_p.alias("posterior"), name.alias("domain"), F.col(r).alias("rate"), copies.alias("copies"))
    return placed.withColumn(into, mixture).drop(m, r)
