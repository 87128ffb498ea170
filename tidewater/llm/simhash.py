"""Near-duplicates by SimHash with deletion-variant signatures.

Fingerprints that differ in at most ``distance`` bits are cut into
``distance // 2 + 1`` segments: by the pigeonhole principle one segment differs
in one bit at most. Each segment is indexed once per bit with that bit deleted
(one wildcard), so such a pair shares a variant exactly; buckets of equal
variants are compared on the whole fingerprint.

Only distinct fingerprints are indexed, so copies cost nothing. A task streams
its sorted buckets and returns a spanning forest of the links it found, never
all pairs. Buckets beyond ``bucket_rows`` are compared in blocks, each pair of
blocks in a task of its own.
"""

from __future__ import annotations

import numpy as np

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, small_batches, written

BITS = 64
#: Fixed value: the seed of XXH64.
SEED = 42


def fingerprint(text: bytes, words: int) -> int:
    """SimHash of the ``words``-word shingles of a text, unsigned."""
    tokens = text.lower().split()  # bytes: A-Z only, and exactly the blanks [\x20\x09-\x0D]
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - words + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 14):
        part = hashes[at:at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` (the fingerprint's 64 bits as a signed long) per row."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).cast(pa.large_binary())
            found = np.fromiter((fingerprint(x.as_py() or b"", words) for x in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """``(first bit, width)`` of each segment."""
    count = distance // 2 + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def variants(nodes: DataFrame, distance: int) -> DataFrame:
    """``bucket, fp, node``: each segment once per deleted bit. A bucket is the
    deleted bit's number and the segment's other bits, mixed to one long."""
    made = []
    for first, width in segments(distance):
        value = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            kept = value.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << bit)))
            made.append(F.xxhash64(F.lit(first + bit), kept))
    return nodes.select(F.explode(F.array(*made)).alias("bucket"), "fp", "node")


def popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links ``a - b`` as links of each node to the smallest of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def near_in_bucket(fp: np.ndarray, node: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside one bucket, as a forest. A fingerprint already linked to the
    one it is compared with through others is not reported again."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at in range(0, len(fp) - 1, 256):
        near = popcount(fp[at:at + 256, None] ^ fp[None, at + 1:]) <= distance
        i, j = np.nonzero(near)
        later = j + 1 > i
        found.append(forest(node[at + i[later]], node[at + 1 + j[later]]))
    return forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))


def _compare_sorted(distance: int, bucket_rows: int):
    """Over batches ordered by bucket: links as ``a, b``, and ``hot, size`` for
    each bucket larger than ``bucket_rows``, which is not compared here."""
    def compare(bucket, fp, node):
        """Buckets of moderate size, all at once by their distance in the order."""
        links = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        sizes = np.diff(np.append(starts, len(bucket)))
        small = np.repeat(sizes <= 64, sizes)
        b, f, n = bucket[small], fp[small], node[small]
        for lag in range(1, 64):
            same = np.flatnonzero(b[lag:] == b[:-lag]) if len(b) > lag else []
            if not len(same):
                break
            same = same[popcount(f[same] ^ f[same + lag]) <= distance]
            links.append((n[same], n[same + lag]))
        for at, size in zip(starts[sizes > 64], sizes[sizes > 64]):
            links.append(near_in_bucket(fp[at:at + size], node[at:at + size], distance))
        return forest(np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links]))

    def run(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        hot, size = None, 0
        schema = ["a", "b", "hot", "size"]

        def out(a, b, hots, counts):
            none = pa.nulls(len(a), pa.int64()), pa.nulls(len(hots), pa.int64())
            return pa.RecordBatch.from_arrays([
                pa.chunked_array([pa.array(a, pa.int64()), none[1]]).combine_chunks(), pa.chunked_array([pa.array(b, pa.int64()), none[1]]).combine_chunks(),
                pa.chunked_array([none[0], pa.array(hots, pa.int64())]).combine_chunks(), pa.chunked_array([none[0], pa.array(counts, pa.int64())]).combine_chunks()], schema)

        for batch in batches:
            new = [np.asarray(batch.column(i)) for i in range(3)]
            new[1] = new[1].view(np.uint64)
            if hot is not None:
                more = int(np.searchsorted(new[0] != hot, True)) if (new[0] != hot).any() else len(new[0])
                size += more
                new = [x[more:] for x in new]
                if not len(new[0]):
                    continue
                yield out([], [], [hot], [size])
                hot = None
            rows = [np.concatenate([x, y]) for x, y in zip(held, new)]
            if not len(rows[0]):
                continue
            last = len(rows[0]) - int(np.argmax(rows[0][::-1] != rows[0][-1])) if (rows[0] != rows[0][-1]).any() else 0
            whole, held = [x[:last] for x in rows], [x[last:] for x in rows]
            if len(whole[0]):
                starts = np.flatnonzero(np.concatenate([[True], whole[0][1:] != whole[0][:-1]]))
                sizes = np.diff(np.append(starts, last))
                large = sizes > bucket_rows
                keep = np.repeat(~large, sizes)
                a, b = compare(*[x[keep] for x in whole]) if keep.any() else ([], [])
                yield out(a, b, whole[0][starts[large]], sizes[large])
            if len(held[0]) > bucket_rows:
                hot, size = held[0][0], len(held[0])
                held = [x[:0] for x in held]
        if hot is not None:
            yield out([], [], [hot], [size])
        if len(held[0]):
            yield out(*compare(*held), [], [])

    return run


LINK_SCHEMA = "a long, b long, hot long, size long"


def links(nodes: DataFrame, distance: int, bucket_rows: int = 4096) -> DataFrame:
    """``a, b``: links between nodes (distinct fingerprints with columns ``fp`` and
    ``node``) that give the same components as all pairs within ``distance``."""
    small = nodes.select("fp", "node")
    run = _compare_sorted(distance, bucket_rows)
    dealt = variants(small, distance).repartition("bucket").sortWithinPartitions("bucket")
    found = written(dealt.mapInArrow(run, LINK_SCHEMA), "links")
    hot = found.where(F.col("hot").isNotNull()).select(F.col("hot").alias("bucket"), F.ceil(2 * F.col("size") / bucket_rows).alias("blocks"))
    pairs = found.where(F.col("a").isNotNull()).select("a", "b")
    if hot.limit(1).count():
        own = F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks"))
        blocks = variants(small, distance).join(hot, "bucket").withColumn("own", own)
        blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        cell = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
        blocks = blocks.select(cell.alias("bucket"), "fp", "node").repartition("bucket").sortWithinPartitions("bucket")
        more = written(blocks.mapInArrow(_compare_sorted(distance, 1 << 62), LINK_SCHEMA), "hot-links")
        pairs = pairs.unionByName(more.where(F.col("a").isNotNull()).select("a", "b"))
    return pairs.distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each linked node reaches. Alternates
    large-star and small-star steps, each a grouped minimum and a join, until the
    links are stars; every state is a written table."""
    def step(state: DataFrame, large: bool) -> DataFrame:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b < a")
        low = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "lowest")
        joined = both.join(low, "a")
        if large:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        near = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        return near.unionByName(low.where("low < a").select("a", F.col("low").alias("b"))).distinct()

    def sign(state: DataFrame) -> tuple:
        return tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    state = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
    seen = sign(state)
    while seen[0]:
        state = written(step(step(state, True), False), "stars")
        now = sign(state)
        if now == seen:
            break
        seen = now
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame, words: int = 4, distance: int = 4, bucket_rows: int = 4096, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most
    ``distance`` differing bits. Null text counts as empty; empty texts have the
    fingerprint zero and link like any other. Rows with a null ``doc_id`` take the
    component of equal fingerprints (null if none has an id) and link no others.
    Rows that repeat an id are linked by their own texts. An empty table gives no
    rows; other columns are not read.
    """
    rows = written(fingerprints(docs, words, doc_id, text), "fingerprints")
    nodes = written(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    found = components(links(nodes, distance, bucket_rows))
    # a row that repeats an id under another fingerprint makes two nodes of one number: they count as linked
    label = nodes.join(found, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return rows.join(label, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, words: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of its component; of rows
    that repeat that id one stays. Rows without an id stay if no row with an id has
    their fingerprint."""
    found = near_duplicates(docs, words, distance, doc_id=doc_id, text=text)
    kept_id, spot = free_name(docs, "kept_id"), free_name(docs, "spot")
    keep = found.where("component_id is null or doc_id = component_id").select(F.col("doc_id").alias(kept_id)).distinct()

    same_id = Window.partitionBy(F.col(f"`{doc_id}`")).orderBy(F.xxhash64(F.col(f"`{text}`")))
    stay = docs.join(keep, F.col(f"`{doc_id}`").eqNullSafe(F.col(kept_id)), "left_semi")
    named = stay.withColumn(spot, F.row_number().over(same_id))
    return named.where((F.col(spot) == 1) | F.col(f"`{doc_id}`").isNull()).drop(spot)
