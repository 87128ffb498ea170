"""Packing of documents into training sequences over the histogram of lengths.

Shortest-pack-first: lengths are placed longest first, each into the packs that
have the most room left, and what is placed are *counts*: a pattern (how many
pieces of which length) stands for all sequences that look alike. Only the
histogram, at most one row per length, comes to the driver; what it decides is
again one interval of ranks per slot of a pattern. Pieces have a rank among those
of their length, from counts per partition and length and a running sum of these,
and join their slot by it.

A sequence with much room left is cut at powers of two, where no padding is needed.
Token ids are encoded once, and travel as 16 bits where the vocabulary allows it.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import chunks, text_bytes
from .segments import encoder, ranges
from .shared import small_batches, written

#: Bytes of text that are encoded at a time.
CHUNK = 4 << 20

#: Rows of three longs that may be broadcast (about 130 bytes each in a hash relation).
SENT_ROWS = 200_000


def pack_lengths(counts: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns ``(sequences, {length: pieces of that length in each})`` that place
    ``counts[length]`` pieces. Lengths go longest first; each goes to the packs with
    the most room, and opens new ones where it fits in none. A length adds a few
    patterns at most, so their number is bounded by the number of lengths."""
    open_packs: list[tuple[int, int]] = []      # (-room, pattern)
    patterns: list[list] = []                   # [sequences, {length: pieces}]

    def add(room: int, sequences: int, slots: dict[int, int]) -> None:
        patterns.append([sequences, slots])
        heapq.heappush(open_packs, (-room, len(patterns) - 1))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left and open_packs and -open_packs[0][0] >= length:
            room, at = -open_packs[0][0], open_packs[0][1]
            heapq.heappop(open_packs)
            # as many at once as keep these packs those with the most room
            below = -open_packs[0][0] if open_packs else 0
            each = max(1, min((room - max(below, length)) // length + 1, room // length))
            sequences, slots = patterns[at]
            each = min(each, max(1, left // sequences))
            used = min(sequences, left // each)
            if used < sequences:
                patterns[at][0] = sequences - used
                heapq.heappush(open_packs, (-room, at))
                add(room - each * length, used, {**slots, length: slots.get(length, 0) + each})
            else:
                slots[length] = slots.get(length, 0) + each
                heapq.heappush(open_packs, (-(room - each * length), at))
            left -= used * each
        if left:
            each = size // length
            if left >= each:
                add(size - each * length, left // each, {length: each})
            if left % each:
                add(size - (left % each) * length, 1, {length: left % each})
    return [(sequences, slots) for sequences, slots in patterns]


def slot_table(patterns: list[tuple[int, dict[int, int]]], size: int, most_room: int) -> dict[str, np.ndarray]:
    """One row per slot of a pattern, in order of length and rank: pieces of
    ``length`` with ranks from ``rank`` on lie in ``packs`` sequences from number
    ``first`` on, at ``offset`` and after it. ``fill`` is the pattern's tokens if it
    is to be cut at powers of two (more than ``most_room`` left), else 0."""
    taken: dict[int, int] = {}
    rows, number = [], 0
    for sequences, slots in patterns:
        fill = sum(length * pieces for length, pieces in slots.items())
        cut = fill if size - fill > most_room else 0
        offset = 0
        for length, pieces in slots.items():
            start = taken.get(length, 0)
            rows.append((length, start, sequences, number, offset, cut))
            taken[length] = start + sequences * pieces
            offset += length * pieces
        number += sequences * (cut.bit_count() or 1)
    table = np.array(sorted(rows), np.int64).reshape(-1, 6)
    return dict(zip(("length", "rank", "packs", "first", "offset", "fill"), table.T))


def _encoded(docs: DataFrame, size: int, tokenizer: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    """All pieces, at most ``size`` ids long, as a written table; ``spot`` is a piece's
    number among those of its length in its partition ``part``."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    small_batches(docs.sparkSession)
    kind = source.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        own = encoder("words", tokenizer)
        seen, part = np.zeros(size + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for i, j in chunks(offsets, CHUNK):
                flat, bounds = own(batch.column(1).slice(i, j - i))
                # each document's ids, with one more place for the end
                n = np.diff(bounds) + 1
                ids = np.full(int(n.sum()), end_id, np.int32)
                ends = np.cumsum(n)
                inside = np.ones(len(ids), bool)
                inside[ends - 1] = False
                ids[inside] = flat
                pieces = -(-n // size)
                start = ranges(np.zeros(len(n), np.int64), pieces) * size
                of = np.repeat(np.arange(len(n)), pieces)
                length = np.minimum(n[of] - start, size)
                # among equal lengths: earlier ones in this partition, and before it in this chunk
                order = np.argsort(length, kind="stable")
                runs = np.flatnonzero(np.diff(length[order], prepend=-1))
                spot = np.empty(len(length), np.int64)
                spot[order] = np.arange(len(length)) - np.repeat(runs, np.diff(np.append(runs, len(length))))
                spot += seen[length]
                seen += np.bincount(length, minlength=size + 1)
                packed = ids.astype("<u2" if narrow else "<i4")
                edges = np.append((ends - n)[of] + start, len(ids)).astype(np.int64) * packed.itemsize
                blobs = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(edges), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(of)), pa.array(start), pa.array(length), pa.array(n[of]), blobs.cast(pa.binary()), pa.array(np.full(len(of), part, np.int64)), pa.array(spot)],
                    ["doc_id", "start", "length", "doc_tokens", "ids", "part", "spot"])

    from tokenizers import Tokenizer
    narrow = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16
    return written(source.mapInArrow(encode, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary, part long, spot long"), "pieces"), narrow


def pack_documents(docs: DataFrame, size: int, tokenizer: str, end_id: int, most_room: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: one row per
    piece of a document in a sequence of at most ``size`` tokens.

    A document's ids are those of its text by the tokenizer's file (without special
    tokens added) and ``end_id``. What is longer than ``size`` is cut every ``size``
    ids; each id lies in one piece, ``start`` ids of its document before it. Pieces
    lie in a sequence from offset 0 on without a gap. A sequence is taken to be padded
    to ``size`` unless its length is a power of two: one with more than ``most_room``
    places left (default: a 32nd of ``size``) is therefore cut into sequences whose
    lengths are powers of two, the longest first.

    Null text counts as empty: its document is ``end_id`` alone. Null and repeated
    ids are kept, each row being a document of its own. An empty table gives no rows.
    Other columns are not read. Which of several pieces of equal length takes which
    slot depends on how the table is partitioned.
    """
    pieces, narrow = _encoded(docs, size, tokenizer, end_id, doc_id, text)
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = written(per_part.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "piece-ranks")
    by_length = base.groupBy("length").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()
    histogram = {r["length"]: r["n"] for r in by_length}
    slots = slot_table(pack_lengths(histogram, size), size, size // 32 if most_room is None else most_room)
    spare = 44      # bits of a rank
    keys = (slots["length"] << spare) + slots["rank"]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << spare) + rank, side="right") - 1
            within = rank - slots["rank"][at]
            packs, fill = slots["packs"][at], slots["fill"][at]
            offset, pack = slots["offset"][at] + within // packs * length, within % packs
            number = slots["first"][at] + pack
            start, of = batch.column("start").to_numpy(), np.arange(len(length))
            skip = np.zeros(len(length), np.int64)
            if fill.any():
                of, number, offset, skip, length = cut_at_powers(of, slots["first"][at], pack, offset, length, fill)
            data = batch.column("ids").cast(pa.large_binary())
            _, bounds, body = data.buffers()
            first = np.frombuffer(bounds, np.int64)[data.offset:data.offset + len(data)]
            ids = np.frombuffer(body, "<u2" if narrow else "<i4") if len(data) else np.zeros(0, np.int32)
            from_ids = first[of] // ids.itemsize + skip
            flat = ids[ranges(from_ids, length)].astype(np.int32)
            lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int64)), pa.array(flat)).cast(pa.list_(pa.int32()))
            pick = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pick), pa.array(start[of] + skip), pa.array(length), lists, batch.column("doc_tokens").take(pick), pa.array(number), pa.array(offset)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    # one row per partition and length: sent to all tasks up to SENT_ROWS, else both sides are sorted
    bases = base.select("part", "length", "base").hint("broadcast" if sum(r["rows"] for r in by_length) <= SENT_ROWS else "merge")
    ranked = pieces.join(bases, ["part", "length"]).select("doc_id", "start", "length", "doc_tokens", "ids", (F.col("base") + F.col("spot")).alias("rank"))
    return ranked.mapInArrow(place, f"doc_id {kind}, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long")


def cut_at_powers(of, first, pack, offset, length, fill):
    """Pieces cut where their sequence of ``fill`` tokens is cut at powers of two (not
    where ``fill`` is 0): ``(of, number, offset, skip, length)`` of what results."""
    found = ([], [], [], [], [])
    whole = fill == 0
    for parts, values in zip(found, (of[whole], (first + pack)[whole], offset[whole], np.zeros(int(whole.sum()), np.int64), length[whole])):
        parts.append(values)
    before, index = np.zeros(len(fill), np.int64), np.zeros(len(fill), np.int64)
    width = np.array([int(x).bit_count() for x in fill], np.int64)
    for bit in reversed(range(int(fill.max()).bit_length())):
        has = (fill >> bit & 1).astype(bool)
        low, high = np.maximum(offset, before), np.minimum(offset + length, before + (1 << bit))
        hit = has & (low < high)
        for parts, values in zip(found, (of, first + pack * width + index, low - before, low - offset, high - low)):
            parts.append(values[hit])
        before += np.where(has, 1 << bit, 0)
        index += has
    return tuple(np.concatenate(parts) for parts in found)
