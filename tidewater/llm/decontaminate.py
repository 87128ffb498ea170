"""Benchmark decontamination by BM25 retrieval with block-max pruning.

The test items are the collection, each training passage is a query. The index
is inverted and ordered by item; a term's postings are cut into blocks of
neighbouring items, each with its largest impact. A passage's score bound for a
block is the sum of its terms' block maxima: blocks below the threshold are
never opened (block-max WAND with the pivot taken block by block, for many
passages at once), the others are scored exactly, so every item above the
threshold is retrieved. Impacts are divided by the item's score for itself: one
threshold holds for all items.

Retrieved pairs are verified on word shingles: the passage must hold the
required share of the shingles of the whole item, or of its question and of its
answer.

Items are read in shards of bounded size; each shard's index goes to all tasks
and the documents are never shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import PLAIN, Rolling, chunks, mix, text_bytes, word_spans
from .shared import small_batches

K1, B = 1.2, 0.75
#: Items per block of a postings list.
BLOCK = 8

def _words(text: str) -> np.ndarray:
    data = PLAIN[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    return Rolling(19).load(data).of(starts, ends)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    if len(words) < n:
        return np.zeros(0, np.uint64)
    value = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        value = mix(value * np.uint64(0xD6E8FEB86659FD93) + words[i:len(words) - n + 1 + i])
    return value


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; an item of one sentence is both."""
    cut = [m.end() for m in re.finditer(r"[.!?]\s+(?=\S)", text)]
    return (text[:cut[-1]], text[cut[-1]:]) if cut else (text, text)


def ways(text: str, shingle: int) -> list[list[tuple[np.ndarray, int, np.ndarray]]]:
    """The ways to match an item, each as parts that must all be there (words, shingle
    length, distinct shingles): the whole item; its question and its answer; and,
    where the answer is one shingle at most, the same split with the answer joined to
    the sentence before it."""
    question, answer = question_and_answer(text)
    splits = [(text,), (question, answer)]
    while question != text and len(_words(answer)) <= shingle:
        before, last = question_and_answer(question.rstrip())
        question, answer = (text, text) if before == last else (before, last + " " + answer)
        splits.append((question, answer))
    out = []
    for split in splits:
        tokens = [words for words in map(_words, split) if len(words)]
        if tokens:
            out.append([(words, min(shingle, len(words)), np.unique(shingle_hashes(words, min(shingle, len(words))))) for words in tokens])
    return out


def matches(ways: list, words: np.ndarray, share: float) -> bool:
    """Whether the passage ``words`` holds ``share`` of each part of one of ``ways``."""
    return any(all(np.isin(shingles, shingle_hashes(words, n)).mean() >= share for _, n, shingles in parts) for parts in ways)


@dataclass
class Index:
    items: np.ndarray
    terms: np.ndarray  # sorted hashes
    offsets: np.ndarray  # of each term's postings
    item: np.ndarray
    impact: np.ndarray
    block_offsets: np.ndarray  # of each term's blocks
    block: np.ndarray
    block_max: np.ndarray
    ways: list[list[list[tuple[np.ndarray, int, np.ndarray]]]]  # of each item
    longest: int
    reach: np.ndarray  # what the impacts are divided by, as a share of the item's own score

    @property
    def blocks(self) -> int:
        return -(-len(self.items) // BLOCK)


def most_missing(weights: np.ndarray, lost: int, n: int) -> float:
    """The most weight of words that can be missing from a text when ``lost`` of its
    ``n``-word shingles are. A run of missing shingles misses the words that are in no other
    one: its length less ``n - 1``, and ``n - 1`` more at an end of the text. ``weights`` are the
    words' in order (0 where a word was before: it is missing only if its first place is)."""
    shingles = len(weights) - n + 1
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    best = np.zeros((shingles + 2, lost + 1))      # by the next shingle and what may still be lost
    for at in range(shingles - 1, -1, -1):
        best[at] = best[at + 1]
        low = 0 if at == 0 else at + n - 1
        for run in range(1, min(lost, shingles - at) + 1):
            high = len(weights) if at + run == shingles else at + run
            if high > low:
                gain = sums[high] - sums[low]
                best[at, run:] = np.maximum(best[at, run:], gain + best[min(at + run + 1, shingles), :lost + 1 - run])
    return float(best[0, lost])


def least_score(ways: list, terms: np.ndarray, weights: np.ndarray, share: float) -> float:
    """The least share of an item's own score that a passage can have which holds ``share`` of the
    shingles in one of ``ways``; ``terms`` are the item's words (sorted) and ``weights`` their
    shares of its score."""
    least = 1.0
    for parts in ways:
        gone = 0.0
        for words, n, shingles in parts:
            lost = int((1 - share) * len(shingles) + 1e-9)
            own = np.zeros(len(words))
            first = np.unique(words, return_index=True)[1]
            own[first] = weights[np.searchsorted(terms, words[first])]
            if len(shingles) < len(words) - n + 1:
                # a shingle that stands twice takes more along: at most twice as many words
                gone += np.sort(own)[::-1][:2 * lost].sum()
            elif lost:
                gone += most_missing(own, lost, n)
        least = min(least, 1 - gone)
    # any match shares a word
    return max(least, float(weights.min()))


@dataclass
class Statistics:
    """Of the whole collection: items, their words on average and at most, and in how many
    items each word (a sorted hash) is."""

    items: int
    words: int
    longest: int
    terms: np.ndarray
    df: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Statistics:
        words = [_words(t) for t in texts]
        terms, df = np.unique(np.concatenate([np.zeros(0, np.uint64), *map(np.unique, words)]), return_counts=True)
        return Statistics(len(words), sum(map(len, words)), max(map(len, words), default=0), terms, df)

    def __add__(self, other: Statistics) -> Statistics:
        terms, which = np.unique(np.concatenate([self.terms, other.terms]), return_inverse=True)
        df = np.bincount(which, weights=np.concatenate([self.df, other.df]), minlength=len(terms)).astype(np.int64)
        return Statistics(self.items + other.items, self.words + other.words, max(self.longest, other.longest), terms, df)


def build_index(items: list[tuple[int, str]], shingle: int, share: float | None = None, most: float = 1.0, stats: Statistics | None = None) -> Index:
    """An item needs one word at least to be found. Repeated ids are items each. With a
    ``share`` impacts are divided by :func:`least_score`, at most ``most``. ``stats`` are
    those of the collection that ``items`` are a part of (default: they are all of it)."""
    stats = Statistics.of([text for _, text in items]) if stats is None else stats
    words = [_words(text) for _, text in items]
    order = sorted(range(len(items)), key=lambda i: (words[i].tolist(), items[i][0]))  # like beginnings side by side
    items, words = [items[i] for i in order], [words[i] for i in order]
    lengths = np.array([len(w) for w in words], np.float64)
    average = max(stats.words / stats.items, 1.0) if stats.items else 1.0
    counted = [np.unique(w, return_counts=True) for w in words]
    term = np.concatenate([np.zeros(0, np.uint64), *(t for t, _ in counted)])
    tf = np.concatenate([np.zeros(0), *(c for _, c in counted)]).astype(np.float64)
    item = np.repeat(np.arange(len(items)), [len(t) for t, _ in counted])
    terms, which = np.unique(term, return_inverse=True)
    df = stats.df[np.searchsorted(stats.terms, terms)] if len(terms) else np.zeros(0)
    idf = np.log1p((stats.items - df + 0.5) / (df + 0.5))
    weight = idf[which] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / average))
    itself = np.bincount(item, weights=weight, minlength=len(items))
    weight = weight / itself[item]
    rules = [ways(text, shingle) for _, text in items]
    reach = np.ones(len(items))
    if share is not None:
        ends = np.searchsorted(item, np.arange(len(items) + 1))
        for k, rule in enumerate(rules):
            if ends[k + 1] > ends[k]:
                own = slice(ends[k], ends[k + 1])
                reach[k] = min(most, least_score(rule, term[own], weight[own], share))
    weight = weight / reach[item]
    at = np.lexsort((item, which))
    which, item, weight = which[at], item[at], weight[at]
    block = item // BLOCK
    new = np.ones(len(item), bool)
    new[1:] = (which[1:] != which[:-1]) | (block[1:] != block[:-1])
    starts = np.flatnonzero(new)
    return Index(
        np.array([i for i, _ in items], np.int64), terms, np.searchsorted(which, np.arange(len(terms) + 1)), item, weight,
        np.searchsorted(which[starts], np.arange(len(terms) + 1)), block[starts],
        np.maximum.reduceat(weight, starts) if len(starts) else np.zeros(0), rules, stats.longest, reach)


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of all ranges one after another, and whose each is."""
    sizes = high - low
    owner = np.repeat(np.arange(len(low)), sizes)
    return np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes), owner


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, passages: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``passage, item, score`` for all pairs that reach ``threshold``; the queries are
    given as distinct pairs of passage and term."""
    tiny = 1e-9
    at, owner = _spread(index.block_offsets[term], index.block_offsets[term + 1])
    bound = np.bincount(passage[owner] * index.blocks + index.block[at], weights=index.block_max[at], minlength=passages * index.blocks)
    live = bound >= threshold - tiny
    open_ = live.reshape(passages, index.blocks).any(axis=1)[passage]
    passage, term = passage[open_], term[open_]
    at, owner = _spread(index.offsets[term], index.offsets[term + 1])
    keep = live[passage[owner] * index.blocks + index.item[at] // BLOCK]
    at, owner = at[keep], owner[keep]
    pairs, which = np.unique(passage[owner] * len(index.items) + index.item[at], return_inverse=True)
    score = np.bincount(which, weights=index.impact[at], minlength=len(pairs))
    found = score >= threshold - tiny
    return pairs[found] // len(index.items), pairs[found] % len(index.items), score[found]


def _windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages of ``size`` words that overlap by half: text, first and last word."""
    step = size // 2
    counts = np.maximum(1, -(-(np.diff(first) - size) // step) + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = first[:-1][text] + nth * step
    return text, start, np.minimum(start + size, first[1:][text])


def search(index: Index, texts, threshold: float, share: float):
    """For each text the ``(item, score)`` of its verified matches."""
    data, offsets = text_bytes(texts)
    found = [[] for _ in range(len(offsets) - 1)]
    if not len(index.terms):
        return found
    rolling = Rolling(19)
    for i, j in chunks(offsets, 1 << 18):
        part = PLAIN[data[offsets[i]:offsets[j]]]
        starts, ends, first = word_spans(part, offsets[i:j + 1] - offsets[i])
        words = rolling.load(part).of(starts, ends)
        term = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
        hits = np.flatnonzero(index.terms[term] == words)
        text, low, high = _windows(first, 2 * index.longest)
        a, b = np.searchsorted(hits, low), np.searchsorted(hits, high)
        at, owner = _spread(a, b)
        pairs = np.unique(owner * np.int64(len(index.terms)) + term[hits[at]])
        passage, item, score = retrieve(index, pairs // len(index.terms), pairs % len(index.terms), len(text), threshold)
        for p, k, s in zip(passage.tolist(), item.tolist(), score.tolist()):
            if matches(index.ways[k], words[low[p]:high[p]], share):
                found[i + text[p]].append((int(index.items[k]), s * index.reach[k]))
    return found


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, shingle: int = 5, share: float = 0.8, index_bytes: int = 16 << 20,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", into: str = "contamination",
) -> DataFrame:
    """``docs`` with a column ``into``: ``struct(item_ids, best_score)``; ``item_ids``
    (ascending, distinct) is empty for clean documents and ``best_score`` null.

    Passages are windows of twice the longest item's words that overlap by half, so
    an item copied whole lies whole in one. ``threshold`` is the least BM25 score as
    a share of the item's own, or less where the rule lets a match have less; ``share`` of the ``shingle``-word shingles of the whole
    item, or of question and of answer (see :func:`ways`), must be there (parts with
    fewer words are one shingle). Items are indexed in shards of about ``index_bytes`` of text, with the statistics of all;
    the number of shards changes no result. Null texts match nothing; null items and items without words are left
    out; a null ``item_id`` is reported as -1. Repeated rows are judged each. An empty
    table on either side gives no matches.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("long"), F.lit(-1)).alias("item"), F.col(f"`{item_text}`").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // index_bytes))
    kind = pa.struct([("item_ids", pa.list_(pa.int64())), ("best_score", pa.float64())])
    columns, stats = [], None
    parts = [items if shards == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == shard) for shard in range(shards)]
    if shards > 1:
        # read once more: a shard at a time is all that the driver holds
        for part in parts:
            own = Statistics.of([r["text"] for r in part.select("text").collect()])
            stats = own if stats is None else stats + own
    for part in parts:
        index = build_index(sorted((r[0], r[1]) for r in part.collect()), shingle, share, threshold, stats)

        def run(batches, index=index):
            for texts in batches:
                out = search(index, texts, 1.0, share)
                yield pa.array([{"item_ids": sorted({k for k, _ in f}), "best_score": max((s for _, s in f), default=None)} for f in out], kind)

        columns.append(_arrow_column(run)(F.col(f"`{text}`").cast("string")))
    merged = columns[0]
    if shards > 1:
        ids = F.array_sort(F.array_distinct(F.concat(*[c["item_ids"] for c in columns])))
        merged = F.struct(ids.alias("item_ids"), F.greatest(*[c["best_score"] for c in columns]).alias("best_score"))
    return docs.withColumn(into, merged)


def _arrow_column(run):
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(batches)

    return F.arrow_udf(column, "item_ids array<bigint>, best_score double")
