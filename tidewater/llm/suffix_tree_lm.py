"""Language-model scores from a probabilistic suffix tree over words.

States of the tree are contexts of up to ``depth`` words. A context is a
candidate if its share of the training words is ``min_share`` or more (so there
are at most ``1 / min_share`` candidates of each length, however large the
corpus) and the context one word shorter is a state. It becomes a state by a
divergence test: the gain in log-likelihood of its next words over the shorter
context, each occurrence left out of its own estimate, must exceed
``divergence`` nats. A text's words are scored in their longest state.

Next-word distributions are smoothed toward the shorter context. With ``N``
occurrences of a state, ``n1`` next words seen once there and prior weight ``m``,

    P_s(x) = c(s, x) / (N + m) * [c(s, x) > 1]  +  (m + n1) / (N + m) * P_shorter(x)

which sums to one; the root has (c + 0.5) / (N + 0.5 (V + 1)) for known and
unknown words alike.

Counting is spread over all documents: blocks send packed arrays of their
distinct words (then of word and context pairs) to the word's partition, which
answers with corpus counts in the same order. The model is never gathered in one
place; only the list of states, bounded by ``min_share``, reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import Rolling, mix, per_text, text_bytes, word_hashes
from .shared import block_stats, open_block, pack, pack_sorted, part_bits, unpack, unpack_sorted, write_blocks, written

#: The end of a text, as a token.
END = np.uint64(0x9E3779B97F4A7C15)


def joined(older: np.ndarray, newer: np.ndarray) -> np.ndarray:
    """Hash of a context from its hash without the newest word, and that word's."""
    return mix(older * np.uint64(0xD6E8FEB86659FD93) + newer)


class Level:
    """Candidates of one context length (sorted hashes) and, once tested, the
    states among them with their smoothing."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order].astype(np.float64)
        self.state = np.zeros(len(hashes), bool)
        self.once = np.zeros(len(hashes))

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Candidate number, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def back(self, ids: np.ndarray, prior: float) -> np.ndarray:
        return (prior + self.once[ids]) / (self.counts[ids] + prior)


class Tokens:
    """A block's tokens (words, then an end per text) as numbers of its distinct
    tokens, which are sorted by hash."""

    def __init__(self, blob: bytes):
        self.table = open_block(blob)
        data, offsets = text_bytes(self.table.column("text"))
        hashes, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, _, words, first in word_hashes(Rolling(11), data, offsets, 1 << 20):
            n = np.diff(first) + 1
            line = np.full(len(words) + len(n), END, np.uint64)
            ends = np.cumsum(n) - 1
            keep = np.ones(len(line), bool)
            keep[ends] = False
            line[keep] = words
            hashes.append(line)
            lengths.append(n)
        self.lengths = np.concatenate(lengths)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])
        stream = np.concatenate(hashes)
        self.distinct, self.ids = np.unique(stream, return_inverse=True)
        self.train = np.repeat(self.table.column("train").to_numpy(zero_copy_only=False), self.lengths)

    def parts(self, bits: int):
        part = (self.distinct >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if high > low:
                yield int(part[low]), low, high

    def contexts(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``length`` words before each token, and where there are so many."""
        n = len(self.ids)
        spot = np.arange(n) - np.repeat(self.first[:-1], self.lengths)
        there = spot >= length
        words = self.distinct[self.ids]
        value = np.zeros(n, np.uint64)
        for back in range(length, 0, -1):
            word = np.zeros(n, np.uint64)
            word[back:] = words[:n - back]
            value = joined(value, word)
        return value, there

    def pairs(self, level: Level, length: int, reach: np.ndarray):
        """Tokens inside a candidate context (``at``), each one's place among the
        distinct pairs, and the pairs: distinct token and candidate, ordered."""
        value, there = self.contexts(length)
        context = np.where(there & reach, level.ids(value), -1)
        at = np.flatnonzero(context >= 0)
        wide = np.int64(max(1, len(level.hashes)))
        keys, which = np.unique(self.ids[at] * wide + context[at], return_inverse=True)
        return at, which, keys // wide, keys % wide


class Scorer:
    """Goes down the tree with a block's tokens: ``p`` is each token's probability
    in the longest state so far, ``reach`` where that state has the last length."""

    def __init__(self, tokens: Tokens, bits: int, counts: np.ndarray, total: float, types: float, prior: float):
        self.tokens, self.bits, self.prior = tokens, bits, prior
        self.known = counts[tokens.ids]
        self.base = (self.known + 0.5) / (total + 0.5 * (types + 1))
        self.p, self.reach = self.base.copy(), np.ones(len(self.base), bool)

    def pairs(self, level: Level, length: int):
        return self.tokens.pairs(level, length, self.reach)

    def descend(self, level: Level, length: int, counts: np.ndarray) -> None:
        at, which, _, context = self.pairs(level, length)
        c, ids = counts[which].astype(np.float64), context[which]
        deeper = np.where(c > 1, c, 0) / (level.counts[ids] + self.prior) + level.back(ids, self.prior) * self.p[at]
        state = level.state[ids]
        self.reach[:] = False
        self.reach[at[state]] = True
        self.p[at[state]] = deeper[state]


def _replies(replies: pd.DataFrame, level: int) -> dict[int, bytes]:
    own = replies[replies["level"] == level]
    return dict(zip(own["part"], own["reply"]))


def _pair_cuts(bits: int, distinct: np.ndarray, word: np.ndarray):
    part = (distinct[word] >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if high > low:
            yield int(part[low]), low, high


def _scorer(blob: bytes, replies: pd.DataFrame, bits: int, model: dict) -> Scorer:
    tokens = Tokens(blob)
    words = _replies(replies, 0)
    counts = np.concatenate([np.zeros(0, np.uint64), *(unpack(words[part], np.uint64) for part, _, _ in tokens.parts(bits))]).astype(np.float64)
    scorer = Scorer(tokens, bits, counts, model["total"], model["types"], model["prior"])
    for length, level in enumerate(model["levels"], 1):
        blobs = _replies(replies, length)
        _, _, word, _ = scorer.pairs(level, length)
        told = [unpack(blobs[part], np.uint64) for part, _, _ in _pair_cuts(bits, tokens.distinct, word)]
        scorer.descend(level, length, np.concatenate([np.zeros(0, np.uint64), *told]))
    return scorer


def _send_words(bits: int):
    def run(batches):
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("blob")):
                own = Tokens(blob.as_py())
                counts = np.bincount(own.ids[own.train], minlength=len(own.distinct)).astype(np.uint64)
                rows = [(block, part, pack_sorted(own.distinct[a:b]), pack(counts[a:b])) for part, a, b in own.parts(bits)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.binary(), pa.binary()])], ["block", "part", "words", "counts"])

    return run


#: Rows of a count: replies (block >= 0), sums of a part (kind 'sum'), and counted
#: keys as packed arrays (kind 'keys').
COUNTED = "kind string, block long, part long, reply binary, total double, types double, word binary, context binary, counts binary, shorter binary"


def _counted(*lines: dict) -> pd.DataFrame:
    return pd.DataFrame(lines, columns=[c.split()[0] for c in COUNTED.split(", ")])


def _count_words(min_share: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        words = [unpack_sorted(x) for x in rows["words"]]
        ends = np.cumsum([len(x) for x in words])
        distinct, which = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.bincount(which, weights=np.concatenate([unpack(x, np.uint64) for x in rows["counts"]]).astype(np.float64))
        reply = [pack(counts[which[e - len(x):e]].astype(np.uint64)) for e, x in zip(ends, words)]
        often = (counts >= min_share * counts.sum()) & (counts > 1) & (distinct != END)
        part = int(key[0])
        return _counted(
            *(dict(kind="reply", block=b, part=part, reply=r) for b, r in zip(rows["block"].tolist(), reply)),
            dict(kind="sum", block=-1, part=part, total=counts.sum(), types=float((counts > 0).sum())),
            dict(kind="keys", block=-1, part=part, word=distinct[often].tobytes(), counts=counts[often].tobytes()),
        )

    return run


def _send_pairs(bits: int, model: dict, level: Level, length: int):
    def run(key: tuple, blocks: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for blob in blocks["blob"]:
            scorer = _scorer(blob, replies, bits, model)
            tokens = scorer.tokens
            at, which, word, context = scorer.pairs(level, length)
            counts = np.bincount(which[tokens.train[at]], minlength=len(word))
            shorter = np.zeros(len(word))
            shorter[which] = scorer.p[at]
            for part, low, high in _pair_cuts(bits, tokens.distinct, word):
                own, n = np.unique(word[low:high], return_counts=True)
                out.append((key[0], part, pack_sorted(tokens.distinct[own]), pack(n.astype(np.int32)), pack(context[low:high].astype(np.int32)),
                            pack(counts[low:high].astype(np.uint32)), pack(shorter[low:high].astype(np.float32))))
        return pd.DataFrame(out, columns=["block", "part", "words", "runs", "contexts", "counts", "shorter"])

    return run


SENT_PAIRS = "block long, part long, words binary, runs binary, contexts binary, counts binary, shorter binary"


def _count_pairs(candidates: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        words = np.concatenate([np.repeat(unpack_sorted(w), unpack(r, np.int32)) for w, r in zip(rows["words"], rows["runs"])])
        contexts = [unpack(x, np.int32).astype(np.int64) for x in rows["contexts"]]
        ends = np.cumsum([len(x) for x in contexts])
        sizes = [len(x) for x in contexts]
        contexts = np.concatenate(contexts)
        distinct, word = np.unique(words, return_inverse=True)
        pairs, first, which = np.unique(word * np.int64(candidates) + contexts, return_index=True, return_inverse=True)
        counts = np.bincount(which, weights=np.concatenate([unpack(x, np.uint32) for x in rows["counts"]]).astype(np.float64))
        shorter = np.concatenate([unpack(x, np.float32) for x in rows["shorter"]])[first]
        reply = [pack(counts[which[e - n:e]].astype(np.uint64)) for e, n in zip(ends, sizes)]
        context = pairs % candidates
        once = np.bincount(context[counts == 1], minlength=candidates)
        twice = np.bincount(context[counts == 2], minlength=candidates)
        few = np.flatnonzero(once + twice)
        more = counts > 1
        part = int(key[0])
        return _counted(
            *(dict(kind="reply", block=b, part=part, reply=r) for b, r in zip(rows["block"].tolist(), reply)),
            dict(kind="sum", block=-1, part=part, context=few.astype(np.int64).tobytes(), counts=np.stack([once[few], twice[few]]).astype(np.float64).tobytes()),
            dict(kind="keys", block=-1, part=part, word=pack(distinct[pairs[more] // candidates]), context=pack(context[more]),
                 counts=pack(counts[more]), shorter=pack(shorter[more])),
        )

    return run


def _sum_by_context(rows: DataFrame, candidates: int, columns: int, arrays) -> np.ndarray:
    """``sums[column, context]`` of what ``arrays(row)`` returns, ``(contexts,
    values...)``. A task adds up its rows first and sends a line for each context
    it has seen; contexts are bounded by the share that makes a candidate."""
    names = [f"v{i}" for i in range(columns)]

    def run(batches):
        total, seen = np.zeros((columns, candidates)), np.zeros(candidates, bool)
        for batch in batches:
            for row in batch.itertuples():
                context, *values = arrays(row)
                seen[context] = True
                for i, value in enumerate(values):
                    total[i] += np.bincount(context, weights=value, minlength=candidates)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"context": at, **dict(zip(names, total[:, at]))})

    lines = rows.mapInPandas(run, "context long, " + ", ".join(f"{n} double" for n in names))
    summed = lines.groupBy("context").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    out = np.zeros((columns, candidates))
    out[:, summed["context"]] = summed[names].to_numpy().T
    return out


def _learn_level(blocks: DataFrame, replies: DataFrame, bits: int, model: dict, level: Level, length: int, divergence: float, share: float) -> tuple[DataFrame, Level]:
    """Counts next words of the candidates, tests them, and returns the replies to
    the blocks and the candidates of the next length."""
    prior, candidates = model["prior"], len(level.hashes)
    sent = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(_send_pairs(bits, model, level, length), SENT_PAIRS)
    counted = written(sent.groupBy("part").applyInPandas(_count_pairs(candidates), COUNTED), f"contexts-{length}")

    def few(row):
        once, twice = np.frombuffer(row.counts, np.float64).reshape(2, -1)
        return np.frombuffer(row.context, np.int64), once, twice

    level.once, twice = _sum_by_context(counted.where("kind = 'sum'").select("context", "counts"), candidates, 2, few)
    back, seen = level.back(np.arange(len(level.hashes)), prior), level.counts

    def gained(row):
        context, c, p = unpack(row.context, np.int64), unpack(row.counts, np.float64), unpack(row.shorter, np.float32).astype(np.float64)
        often = c > 2
        context, c, p = context[often], c[often], p[often]
        return context, c * np.log((c - 1) / (seen[context] - 1 + prior) / p + back[context])

    keys = counted.where("kind = 'keys'").select("word", "context", "counts", "shorter")
    gain = (level.once + 2 * twice) * np.log(np.maximum(back, 1e-300)) + _sum_by_context(keys, candidates, 1, gained)[0]
    level.state = gain > divergence

    least, hashes, state = share * model["total"], level.hashes, level.state

    def longer(batches):
        for batch in batches:
            for row in batch.itertuples():
                word, context, c = unpack(row.word, np.uint64), unpack(row.context, np.int64), unpack(row.counts, np.float64)
                keep = (c >= least) & (word != END)
                yield pd.DataFrame({"older": hashes[context[keep]].view(np.int64), "word": word[keep].view(np.int64), "n": c[keep]})

    found = keys.mapInPandas(longer, "older long, word long, n double").toPandas()
    older, word = (found[c].to_numpy(np.int64).view(np.uint64) for c in ("older", "word"))
    return counted.where("kind = 'reply'").select("block", "part", F.lit(length).alias("level"), "reply"), Level(joined(older, word), found["n"].to_numpy())


def score_texts(
    docs: DataFrame, train, depth: int = 2, min_share: float = 5e-5, divergence: float = 10.0, prior: float = 100.0,
    block_bytes: int = 8 << 20, part_bytes: int = 16 << 20, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score, states``:
    one row per row of ``docs``.

    ``train`` (a boolean column) marks the rows to learn from. Scores are log10
    probabilities of the lower-cased (A-Z) words and the end of the text;
    ``base_score`` uses the root alone. Null text is empty: its end is its only
    token. Without training rows the root's formula gives each token probability one. Null ids and rows that repeat an id are
    scored each by itself. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    blocks = write_blocks(rows, block_bytes, "texts")
    bits = part_bits(spark, block_stats(blocks)[1], part_bytes)
    own = blocks.select("block", "blob")
    counted = written(own.mapInArrow(_send_words(bits), "block long, part long, words binary, counts binary").groupBy("part").applyInPandas(_count_words(min_share), COUNTED), "words")
    sums = counted.where("kind = 'sum'").agg(F.coalesce(F.sum("total"), F.lit(0.0)), F.coalesce(F.sum("types"), F.lit(0.0))).first()
    model = {"total": sums[0], "types": sums[1], "prior": prior, "levels": []}
    replies = counted.where("kind = 'reply'").select("block", "part", F.lit(0).alias("level"), "reply")

    least = min_share * model["total"]

    def often(batches):
        for batch in batches:
            for row in batch.itertuples():
                words, n = np.frombuffer(row.word, np.uint64), np.frombuffer(row.counts, np.float64)
                yield pd.DataFrame({"word": words[n >= least].view(np.int64), "n": n[n >= least]})

    found = counted.where("kind = 'keys'").select("word", "counts").mapInPandas(often, "word long, n double").toPandas()
    words = found["word"].to_numpy(np.int64).view(np.uint64)
    level = Level(joined(np.zeros(len(words), np.uint64), words), found["n"].to_numpy())
    for length in range(1, depth + 1):
        if not len(level.hashes):
            break
        told, longer = _learn_level(own, replies, bits, model, level, length, divergence, min_share)
        replies = replies.unionByName(told)
        model["levels"].append(level)
        level = longer
    n_states = 1 + int(sum(level.state.sum() for level in model["levels"]))

    def score(key: tuple, blocks: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for blob in blocks["blob"]:
            scorer = _scorer(blob, replies, bits, model)
            tokens = scorer.tokens
            out.append(pd.DataFrame({
                "doc_id": tokens.table.column("doc_id").to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get),
                "train": tokens.table.column("train").to_numpy(zero_copy_only=False), "n_tokens": tokens.lengths,
                "n_known": per_text(scorer.known > 0, tokens.first), "train_tokens": int(model["total"]),
                "base_score": per_text(np.log10(scorer.base), tokens.first), "score": per_text(np.log10(scorer.p), tokens.first),
                "states": n_states}))
        return pd.concat(out)

    return own.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        score, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, states long")
