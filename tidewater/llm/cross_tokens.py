"""Alignment of two tokenizers' tokens over the same texts, and how often ids meet.

Arrow arrays do the work in each task: token lists are flattened with their parent
indices, token lengths summed within each text give the byte at which a token ends,
and an Acero full outer join of both sides on the key (document, end) has one row
per link: its missing side is the next token of that side. Where both sides end,
a group ends. ``Table.group_by`` counts the id pairs of a block of documents, and
Spark merges these partial counts; a block then gets the merged counts of its own
pairs back. Nothing but pair counts and a block's links crosses the network.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import chunks, text_bytes
from .segments import encoder
from .shared import pack, small_batches, unpack, written

#: Bytes of text aligned at a time, and chunks whose pairs are counted together.
CHUNK, BLOCK = 3 << 20, 5

#: Bits of a byte offset inside a document's key.
END_BITS = 40


class Side:
    """One tokenizer with the bytes of its ids."""

    def __init__(self, kind: str, path: str):
        self.encode = encoder(kind, path)
        self.bytes = pa.array(self.encode.token_bytes(), pa.large_binary())
        self.lengths = pc.binary_length(self.bytes)

    def lists(self, texts: pa.Array) -> pa.LargeListArray:
        flat, bounds = self.encode(texts)
        return pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(flat, pa.int32()))

    def spells(self, lists: pa.LargeListArray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts the joined bytes of their tokens give back."""
        ids = lists.flatten()
        said, _ = text_bytes_of(self.bytes.take(ids))
        ends = np.concatenate([[0], np.cumsum(self.lengths.take(ids).to_numpy())])[lists.offsets.to_numpy()]
        if len(said) == len(data) and np.array_equal(ends, offsets) and np.array_equal(said, data):
            return np.ones(len(lists), bool)
        return np.array([np.array_equal(said[ends[i]:ends[i + 1]], data[offsets[i]:offsets[i + 1]]) for i in range(len(lists))], bool)

    def ends(self, lists: pa.LargeListArray) -> tuple[pa.Array, pa.Array]:
        """Keys ``document << END_BITS | end`` of all tokens, and their ids."""
        ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
        until = np.concatenate([[0], pc.cumulative_sum(self.lengths.take(ids)).to_numpy()])
        parent = parents.to_numpy()
        end = until[1:] - until[lists.offsets.to_numpy()[parent]]
        return pa.array((parent.astype(np.int64) << END_BITS) + end), ids


def text_bytes_of(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    _, bounds, data = values.buffers()
    at = np.frombuffer(bounds, np.int64)[values.offset:values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)), at


def _joined(ids: np.ndarray, group: np.ndarray, groups: int) -> pa.Array:
    """The ids of each group in decimal, with commas between them."""
    bounds = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=groups))])
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(ids).cast(pa.large_string())), pa.scalar(",", pa.large_string()))


def align(texts: pa.Array, first: Side, second: Side) -> dict:
    """``n_a, n_b, n_groups, n_links`` and ``groups`` (``a1,a2|b1;a3|b2,b3``) of each
    text, and the id pair ``a << 32 | b`` of every link, text by text. The texts are
    aligned behind one space. A text that is empty, or that the tokens of a side
    don't spell, has no tokens."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
    data, offsets = text_bytes(spaced)
    a, b = first.lists(spaced), second.lists(texts)
    good = first.spells(a, data, offsets) & second.spells(b, data, offsets) & (np.diff(offsets) > 1)
    if not good.all():
        # the others keep their place with an empty list
        none = pa.scalar([], a.type)
        a, b = pc.if_else(pa.array(good), a, none), pc.if_else(pa.array(good), b, none)
    n = len(texts)
    key_a, id_a = first.ends(a)
    key_b, id_b = second.ends(b)
    links = (
        pa.table({"key": key_a, "a": id_a}).join(pa.table({"key": key_b, "b": id_b}), "key", join_type="full outer", use_threads=False)
        .combine_chunks()
    )
    links = links.take(pc.sort_indices(links["key"]))
    on_a, on_b = (pc.is_valid(links[c]).to_numpy() for c in ("a", "b"))
    doc = links["key"].to_numpy() >> END_BITS
    last = on_a & on_b
    groups = np.cumsum(last) - last
    n_groups, n_links = np.bincount(doc[last], minlength=n), np.bincount(doc, minlength=n)
    both = pc.binary_join_element_wise(
        _joined(id_a.to_numpy(), groups[on_a], int(last.sum())), _joined(id_b.to_numpy(), groups[on_b], int(last.sum())), pa.scalar("|", pa.large_string()))
    bounds = pa.array(np.concatenate([[0], np.cumsum(n_groups)]))
    of_a, of_b = (pc.fill_null_backward(links[c]).to_numpy().astype(np.int64) for c in ("a", "b"))
    return {
        "n_a": np.diff(a.offsets.to_numpy()), "n_b": np.diff(b.offsets.to_numpy()), "n_groups": n_groups, "n_links": n_links,
        "groups": pc.binary_join(pa.LargeListArray.from_arrays(bounds, both), pa.scalar(";", pa.large_string())).cast(pa.string()),
        "pairs": (of_a << 32) + of_b,
    }


STATS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(docs: DataFrame, first: str, second: str, keep: Callable, doc_id: str, text: str) -> DataFrame:
    """A written table with two kinds of rows: for each block its documents and their
    links (numbers of id pairs, packed), and the block's pairs with their counts."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    small_batches(docs.sparkSession)

    def block_rows(block: int, held: list) -> list[pa.RecordBatch]:
        parts = [pa.table({"pair": pairs, "at": np.arange(len(pairs))}).append_column("n", pa.array(counts)) for _, pairs, counts, _ in held]
        counted = pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")]).combine_chunks()
        value_set = counted["pair"].combine_chunks()
        spots = [pc.index_in(pa.array(pairs), value_set=value_set).to_numpy()[which] for _, pairs, _, which in held]
        sink = pa.BufferOutputStream()
        table = pa.concat_tables([rows for rows, *_ in held])
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        packer = zstandard.ZstdCompressor(level=3)
        links = pack(np.concatenate(spots).astype(np.int32))
        n = len(value_set)
        names = ["block", "at", "pair", "n", "docs", "links"]
        blobs = pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([packer.compress(sink.getvalue())]), pa.array([links])], names)
        pairs = pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block)), pa.array(np.arange(n)), value_set, counted["n_sum"].combine_chunks(), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names)
        return [blobs, *(pairs.slice(i, 1 << 16) for i in range(0, n, 1 << 16))]

    def work(batches):
        sides = Side("bytes", first), Side("pieces", second)
        block = TaskContext.get().partitionId() << 32
        held, waiting, size = [], [], 0

        def flush():
            batch = pa.Table.from_batches(waiting).combine_chunks()
            _, offsets = text_bytes(batch["text"])
            for i, j in chunks(offsets, CHUNK):
                part = batch.slice(i, j - i).combine_chunks()
                found = align(part["text"].combine_chunks() if part["text"].num_chunks != 1 else part["text"].chunk(0), *sides)
                coded = pa.array(found["pairs"]).dictionary_encode()
                counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                rows = pa.table({"doc_id": part["doc_id"], **{c: found[c] for c in STATS}, "groups": keep(found["groups"])})
                held.append((rows, coded.dictionary.to_numpy(), counts, coded.indices.to_numpy()))

        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if size >= CHUNK:
                flush()
                waiting, size = [], 0
            if len(held) >= BLOCK:
                yield from block_rows(block, held)
                held, block = [], block + 1
        if waiting:
            flush()
        if held:
            yield from block_rows(block, held)

    return written(source.mapInArrow(work, "block long, at long, pair long, n long, docs binary, links binary"), "aligned")


def align_tokenizers(docs: DataFrame, first: str, second: str, keep: Callable[[pa.Array], pa.Array] = lambda groups: groups, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``: one row per row
    of ``docs``.

    A is the byte-level BPE of the file ``first``, B the sentencepiece model ``second``;
    both encode the text behind one space, strings of special tokens as plain text.
    Byte offsets at which tokens of both end cut them into groups, and a link is a pair
    of an A and a B token whose bytes overlap. ``count_sum`` sums, over a document's
    links, how many links of all documents hold the same two ids; ``n_best`` counts
    those links whose count is the highest that their B id has. ``groups`` are the
    groups' ids, ``a1,a2|b1;a3|b2,b3``, as ``keep`` returns them: it is called on arrays
    of them where they are made, so that what isn't needed is never stored.

    Null and empty texts, and texts that the tokens of A or B don't spell (B writes a
    space for U+2581), have no tokens: zeros and an empty string. Repeated and null
    ids are kept, each row being a document of its own. An empty table gives no rows.
    Other columns are not read.
    """
    aligned = _aligned(docs, first, second, keep, doc_id, text)
    pairs = aligned.where(F.col("pair").isNotNull()).select("block", "at", "pair", "n")
    counts = written(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    second_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    counts = counts.withColumn("b", second_id)
    # one row per id of B: bounded by its vocabulary
    best = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("most")))
    judged = counts.join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = pairs.select("block", "at", "pair").join(judged, "pair").select(F.col("block").alias("of_block"), "at", "count", "best")
    blocks = aligned.where(F.col("pair").isNull()).select("block", "docs", "links")

    def finish(own: pa.Table, answers: pa.Table) -> pa.Table:
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(own["docs"][0].as_py())) as reader:
            rows = reader.read_all()
        at, n = answers["at"].to_numpy(), answers.num_rows
        count, is_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        count[at], is_best[at] = answers["count"].to_numpy(), answers["best"].combine_chunks().cast(pa.int64()).to_numpy()
        links = unpack(own["links"][0].as_py(), np.int32)
        bounds = np.concatenate([[0], np.cumsum(rows["n_links"].to_numpy())])
        sums = [np.concatenate([[0], np.cumsum(values[links])])[bounds] for values in (is_best, count)]
        return pa.table({
            "doc_id": rows["doc_id"], **{c: rows[c] for c in STATS}, "n_best": np.diff(sums[0]), "count_sum": np.diff(sums[1]), "groups": rows["groups"]})

    kind = docs.schema[doc_id].dataType.simpleString()
    return blocks.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(
        finish, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
