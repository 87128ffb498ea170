"""Repeated substrings by prefix-free parsing.

Phrases. A rolling hash is taken at every byte; a byte is a trigger of a window
of ``length`` bytes if its hash is the smallest in the window's front part.
Triggers depend on content alone, so equal windows have equal triggers, at the
same offset. Windows with the same trigger that start side by side make up a
phrase; phrases overlap by the window length, so that every window lies whole
in exactly one phrase and no phrase's window is cut (the prefix-free property).

Dictionary. Equal phrases are merged in each block and then over all blocks. All
windows of a phrase that occurs twice are repeats. A phrase that occurs once can
share windows only with phrases that go on alike after the trigger (same
*core*); where there are none, all its windows are unique.

Windows. What remains, the windows of the distinct phrases of contested cores, is
counted by 128-bit hashes of their bytes. Equal windows are merged in each block,
and hashes are dealt out by themselves, not by core: however many phrases share a
core, only the copies of a window meet, one from each block. Since phrases overlap
by a whole window, order beyond it (the suffix array of the parse) can't change
what repeats, and isn't computed.

Blocks exchange packed arrays in the order of their own sorted phrases, and are
answered in that order: no positions travel. Each distinct phrase leaves a block
once, however often it occurs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import Rolling, mix, text_bytes
from .shared import block_stats, open_block, pack, pack_sorted, part_bits, unpack, unpack_sorted, write_blocks, written

#: Bytes hashed at a trigger, and bytes behind it that all windows of a phrase share.
GRAM, CORE = 12, 64
#: Bytes worked on at a time.
CHUNK = 1 << 19

#: What a phrase is, as its partition answers (bits).
REPEATED, CONTESTED, ASKED = 1, 2, 4

MESSAGE = "block long, part long, cores binary, phrases binary, counts binary"


def window_starts(offsets: np.ndarray, length: int) -> np.ndarray:
    """For each byte, whether a window of ``length`` bytes starts there."""
    change = np.zeros(offsets[-1] + 2, np.int32)
    sizes = np.diff(offsets)
    fits = sizes >= length
    np.add.at(change, offsets[:-1][fits], 1)
    np.add.at(change, offsets[:-1][fits] + sizes[fits] - length + 1, -1)
    return np.cumsum(change, dtype=np.int32)[:-2] > 0


def hash_parts(hashes: np.ndarray, bits: int):
    """``(part, low, high)``: the ascending hashes that fall into each part."""
    part = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if high > low:
            yield int(part[low]), low, high


def merged(high: np.ndarray, low: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs ``high, low`` in order, their sums of ``weight``, and which of
    them each given pair is."""
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return high[new], low[new], np.bincount(which, weights=weight, minlength=int(new.sum())), which


def window_hashes(data: np.ndarray, where: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the ``length`` bytes at each of ``where`` (ascending), over the
    windows' 8-byte words, each spread over 64 bits before it is added."""
    out = np.empty((2, len(where)), np.uint64)
    rollings = Rolling(9), Rolling(10)
    for low in range(0, len(data), CHUNK):
        a, b = np.searchsorted(where, [low, low + CHUNK])
        if a == b:
            continue
        part = data[low:low + CHUNK + length].astype(np.uint64)
        word = np.zeros(len(part) - 7, np.uint64)
        for i in range(8):
            word = (word << np.uint64(8)) | part[i:len(word) + i]
        at = where[a:b] - low
        for hashes, rolling in zip(out, rollings):
            hashes[a:b] = rolling.load_symbols(mix(word ^ rolling.sym[0])).of(at, at + length - 7)
    return out[0], out[1]


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value in each run of ``width`` values, by the smallest of the two
    halves that blocks of ``width`` cut it into."""
    n = len(values)
    out = n - width + 1
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:out], ahead[width - 1:width - 1 + out])


def phrases(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Phrases in order: ``first`` and ``last`` window start, and hashes ``core`` and
    ``phrase``."""
    starts_here = window_starts(offsets, length)
    front, rolling, other = length - CORE + 1, Rolling(7), Rolling(8)
    out = {k: [] for k in ("first", "last", "core", "phrase")}
    for low in range(0, len(data), CHUNK):
        high = min(low + CHUNK, len(data))
        part = data[low:high + length]
        valid = np.flatnonzero(starts_here[low:high])
        if not len(valid):
            continue
        rolling.load(part)
        at = np.arange(len(part) - GRAM + 1)
        ranked = (rolling.of(at, at + GRAM) & ~np.uint64(0xFFFFFF)) | at.astype(np.uint64)
        least = sliding_argmin(ranked, front)
        trigger = (least[valid] & np.uint64(0xFFFFFF)).astype(np.int64)
        new = np.concatenate([[True], (trigger[1:] != trigger[:-1]) | (valid[1:] != valid[:-1] + 1)])
        first, anchor = valid[new], trigger[new]
        last = valid[np.append(np.flatnonzero(new)[1:], len(valid)) - 1]
        core = rolling.of(anchor, anchor + CORE)
        whole = rolling.of(first, last + length)
        other.load(part)
        place = ((anchor - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
        phrase = mix(whole ^ mix(other.of(first, last + length) ^ place))
        for key, values in (("first", first + low), ("last", last + low), ("core", core), ("phrase", phrase)):
            out[key].append(values)
    return {k: np.concatenate(v) if v else np.zeros(0, np.uint64 if k in ("core", "phrase") else np.int64) for k, v in out.items()}


class BlockPhrases:
    """The phrases of a block, and the distinct ones ordered by core and phrase."""

    def __init__(self, blob: bytes, length: int):
        table = open_block(blob)
        self.table = table
        self.data, self.offsets = text_bytes(table.column("text"))
        self.all = phrases(self.data, self.offsets, length)
        core, phrase = self.all["core"], self.all["phrase"]
        order = np.lexsort((phrase, core))
        new = np.ones(len(order), bool)
        new[1:] = (core[order][1:] != core[order][:-1]) | (phrase[order][1:] != phrase[order][:-1])
        self.which = np.empty(len(order), np.int64)  # of each phrase, its place among the distinct
        self.which[order] = np.cumsum(new) - 1
        self.example = order[new]
        self.core, self.phrase = core[self.example], phrase[self.example]
        self.count = np.bincount(self.which, minlength=len(self.example))

    def parts(self, bits: int):
        """``(part, low, high)``: the distinct phrases whose core falls into a part."""
        return hash_parts(self.core, bits)


def _ask(length: int, bits: int):
    def run(batches):
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("blob")):
                own = BlockPhrases(blob.as_py(), length)
                rows = [(block, part, pack_sorted(own.core[a:b]), pack(own.phrase[a:b]), pack(np.minimum(own.count[a:b], 2).astype(np.uint8))) for part, a, b in own.parts(bits)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), *[pa.binary()] * 3])], ["block", "part", "cores", "phrases", "counts"])

    return run


def _answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Of each phrase asked about: repeated, contested, and whether this block is
    asked for its bytes."""
    rows = rows.sort_values("block")
    core = [unpack_sorted(x) for x in rows["cores"]]
    sizes = np.array([len(x) for x in core])
    core, phrase = np.concatenate(core), np.concatenate([unpack(x, np.uint64) for x in rows["phrases"]])
    count = np.concatenate([unpack(x, np.uint8) for x in rows["counts"]]).astype(np.int64)
    order = np.lexsort((phrase, core))  # stable: the first block comes first
    core, phrase = core[order], phrase[order]
    new_core = np.concatenate([[True], core[1:] != core[:-1]])
    new = new_core | np.concatenate([[True], phrase[1:] != phrase[:-1]])
    at, core_at = np.cumsum(new) - 1, np.cumsum(new_core) - 1
    total = np.bincount(at, weights=count[order])
    of_core = core_at[new]
    distinct, singles = np.bincount(of_core), np.bincount(of_core, weights=total == 1)
    contested = (distinct > 1)[of_core] & (singles > 0)[of_core]
    told = np.where(total > 1, REPEATED, 0) | np.where(contested, CONTESTED, 0)
    reply = np.empty(len(order), np.uint8)
    reply[order] = told[at] | np.where(new & contested[at], ASKED, 0)
    ends = np.cumsum(sizes)
    return pd.DataFrame({"block": rows["block"], "part": key[0], "reply": [pack(reply[e - s:e]) for e, s in zip(ends, sizes)]})


def _statuses(own: BlockPhrases, replies: pd.DataFrame, bits: int) -> np.ndarray:
    by_part = dict(zip(replies["part"], replies["reply"]))
    return np.concatenate([np.zeros(0, np.uint8), *(unpack(by_part[part], np.uint8) for part, _, _ in own.parts(bits))])


def _only(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ascending ranges, those that overlap together, one after the other; and by
    how much each range has moved to the front."""
    if not len(first):
        return data[:0], first
    new = np.concatenate([[True], first[1:] > end[:-1]])
    starts = first[new]
    sizes = end[np.append(np.flatnonzero(new)[1:], len(end)) - 1] - starts
    before = np.cumsum(sizes) - sizes
    taken = np.arange(sizes.sum()) + np.repeat(starts - before, sizes)
    return data[taken], (starts - before)[np.cumsum(new) - 1]


def _asked_windows(own: BlockPhrases, status: np.ndarray, length: int):
    """Starts of all windows of the phrases that this block is asked for, and their
    distinct hashes with counts (2 for more) and which of them each window is."""
    asked = np.flatnonzero(status & ASKED)
    asked = asked[np.argsort(own.example[asked])]
    first, last = own.all["first"][own.example[asked]], own.all["last"][own.example[asked]]
    count = last - first + 1
    where = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
    weight = np.repeat(1 + (status[asked] & REPEATED), count)
    data, moved = _only(own.data, first, last + length)
    high, low, total, which = merged(*window_hashes(data, where - np.repeat(moved, count), length), weight)
    return where, high, low, np.minimum(total, 2).astype(np.uint8), which


def _send_windows(length: int, bits: int, window_bits: int):
    def run(key: tuple, blocks: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for blob in blocks["blob"]:
            own = BlockPhrases(blob, length)
            _, high, low, total, _ = _asked_windows(own, _statuses(own, replies, bits), length)
            out += [(key[0], part, pack_sorted(high[a:b]), pack(low[a:b]), pack(total[a:b])) for part, a, b in hash_parts(high, window_bits)]
        return pd.DataFrame(out, columns=["block", "part", "high", "low", "counts"])

    return run


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes at each position among all of them, by prefix
    doubling: equal ranks for equal bytes. The last ``length - 1`` mean nothing."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    depth = min(8, length)
    word = np.zeros(n, np.uint64)
    for i in range(depth):
        word = (word << np.uint64(8)) | padded[i:n + i]
    _, rank = np.unique(word, return_inverse=True)
    while depth < length:
        step = min(depth, length - depth)
        behind = np.concatenate([rank[step:], np.zeros(min(step, n), rank.dtype)])
        _, rank = np.unique((rank.astype(np.uint64) << np.uint64(32)) | behind.astype(np.uint64), return_inverse=True)
        depth += step
    return rank


def _count_windows(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For each block, a bit for each window hash it sent: repeated or not."""
    high = [unpack_sorted(x) for x in rows["high"]]
    ends = np.cumsum([len(x) for x in high])
    low, counts = (np.concatenate([unpack(x, kind) for x in rows[name]]) for name, kind in (("low", np.uint64), ("counts", np.uint8)))
    *_, total, which = merged(np.concatenate(high), low, counts)
    twice = total[which] > 1
    return pd.DataFrame({"block": rows["block"], "part": key[0], "windows": [np.packbits(twice[e - len(x):e]).tobytes() for e, x in zip(ends, high)]})


def _cut(length: int, bits: int, window_bits: int):
    def run(key: tuple, blocks: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for blob in blocks["blob"]:
            own = BlockPhrases(blob, length)
            told = replies[replies["reply"].notna()]
            status = _statuses(own, told, bits)
            windows = dict(zip(replies["part"][replies["windows"].notna()], replies["windows"].dropna()))
            change = np.zeros(len(own.data) + length + 1, np.int32)
            first, last = own.all["first"], own.all["last"]
            full = (status[own.which] & REPEATED).astype(bool)
            np.add.at(change, first[full], 1)
            np.add.at(change, last[full] + length, -1)
            where, high, _, _, which = _asked_windows(own, status, length)
            bit = [np.unpackbits(np.frombuffer(windows[part], np.uint8), count=b - a) for part, a, b in hash_parts(high, window_bits)]
            twice = where[np.concatenate([np.zeros(0, np.uint8), *bit]).astype(bool)[which]]
            change[twice] += 1  # each start is there once
            change[twice + length] -= 1
            gone = np.cumsum(change, dtype=np.int32)[:len(own.data)] > 0
            out.append(_documents(own, gone))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])

    return run


def _documents(own: BlockPhrases, gone: np.ndarray) -> pd.DataFrame:
    offsets, data = own.offsets, own.data
    begin = gone.copy()
    begin[1:] &= ~gone[:-1]
    begin[offsets[:-1][np.diff(offsets) > 0]] = gone[offsets[:-1][np.diff(offsets) > 0]]
    end = gone.copy()
    end[:-1] &= ~gone[1:]
    inner = offsets[1:][np.diff(offsets) > 0] - 1
    end[inner] = gone[inner]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    cut = np.searchsorted(starts, offsets)
    removed = np.concatenate([[0], np.cumsum(ends - starts)])[cut]  # no span crosses documents
    shas, spans = [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        text = data[a:b] if removed[i + 1] == removed[i] else data[a:b][~gone[a:b]]
        shas.append(hashlib.sha256(text.tobytes()).hexdigest())
        spans.append([x for pair in zip((starts[cut[i]:cut[i + 1]] - a).tolist(), (ends[cut[i]:cut[i + 1]] - a).tolist()) for x in pair])
    return pd.DataFrame({
        "doc_id": own.table.column("doc_id").to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get), "n_bytes": np.diff(offsets),
        "n_removed": np.diff(removed), "n_spans": np.diff(cut), "spans": spans, "kept_sha256": shas,
    })


def repeated_spans(
    docs: DataFrame, length: int = 200, block_bytes: int = 4 << 20, part_bytes: int = 8 << 20, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256``: one row per row of
    ``docs``.

    Removed is each byte inside a window of ``length`` bytes that also starts
    anywhere else, in the same document or another; windows don't cross documents.
    ``spans`` lists the maximal removed runs as ``start, end, start, end, ...`` and
    ``kept_sha256`` is of the other bytes. Null text counts as empty. A null
    ``doc_id`` and rows that repeat one are documents by themselves: a text that
    stands in two rows is repeated whole if it has ``length`` bytes. An empty table
    gives no rows; other columns are not read.
    """
    if length < CORE + GRAM:
        raise ValueError(f"length must be {CORE + GRAM} at least")
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    blocks = write_blocks(rows, block_bytes, "texts")
    bits = part_bits(spark, block_stats(blocks)[1], part_bytes)
    asked = blocks.mapInArrow(_ask(length, bits), MESSAGE)
    replies = written(asked.groupBy("part").applyInPandas(_answer, "block long, part long, reply binary"), "phrases")
    own = blocks.select("block", "blob")
    window_bits = bits + 2  # a byte of input may be 16 bytes of hashes
    sent = own.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        _send_windows(length, bits, window_bits), "block long, part long, high binary, low binary, counts binary")
    windows = written(sent.groupBy("part").applyInPandas(_count_windows, "block long, part long, windows binary"), "windows")
    both = replies.withColumn("windows", F.lit(None).cast("binary")).unionByName(windows.withColumn("reply", F.lit(None).cast("binary")))
    return own.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(
        _cut(length, bits, window_bits), "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept_sha256 string")
