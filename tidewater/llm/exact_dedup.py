"""Exact deduplication against immutable snapshots, screened by binary-fuse filters.

A snapshot of documents never changes, so its digests are put once into static
3-wise binary-fuse filters (8-bit fingerprints, about 9 bits a digest), one per
shard of the digest space. Digests of an incoming batch meet only the filter of
their own shard; what the filter lets pass joins the snapshot's exact buckets,
and texts of equal digests are compared byte by byte. Digests new to all
snapshots are grouped among themselves.

Digests travel, not texts: only texts whose digest occurs twice are shuffled,
once, for the comparison. Copies are merged before each shuffle, so that a text
that makes up a third of all rows is one row per task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import mix
from .shared import written


def normalised(text: Column) -> Column:
    """Each run of ``[\\x20\\x09-\\x0D]`` as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


class BinaryFuse8:
    """A static 3-wise binary-fuse filter of unsigned 64-bit keys."""

    def __init__(self, seed: int, segment: int, count: int, prints: np.ndarray):
        self.seed, self.segment, self.count, self.prints = seed, segment, count, prints

    @staticmethod
    def _hashed(keys: np.ndarray, seed: int) -> np.ndarray:
        return mix(keys + mix(np.full(1, seed, np.uint64)))

    @staticmethod
    def _slots(hashes: np.ndarray, segment: int, count: int) -> np.ndarray:
        """Three slots of each key, in consecutive segments."""
        span = np.uint64(count * segment)
        first = ((hashes >> np.uint64(32)) * span) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((hashes >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (hashes & mask)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def _print(hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> "BinaryFuse8":
        """From distinct keys: slots with a single key are peeled, all at once,
        until none is left; fingerprints are set in the reverse order."""
        n = len(keys)
        size = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2))) * n + 64
        segment = int(2 ** max(2, min(18, np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
        count = max(1, int(np.ceil(size / segment)) - 2)
        for seed in range(1, 1000):
            hashes = cls._hashed(keys, seed)
            slots = cls._slots(hashes, segment, count)
            total = (count + 2) * segment
            held = np.bincount(slots.ravel(), minlength=total)
            names = np.zeros(total, np.int64)
            index = np.arange(n)
            for way in range(3):
                np.bitwise_xor.at(names, slots[way], index)
            rounds, left = [], n
            while left:
                alone = np.flatnonzero(held == 1)
                if not len(alone):
                    break
                peeled, at = np.unique(names[alone], return_index=True)
                rounds.append((peeled, alone[at]))
                left -= len(peeled)
                for way in range(3):
                    np.subtract.at(held, slots[way, peeled], 1)
                    np.bitwise_xor.at(names, slots[way, peeled], peeled)
            if left:
                continue
            prints, wanted = np.zeros(total, np.uint8), cls._print(hashes)
            for peeled, at in reversed(rounds):
                prints[at] = 0
                found = prints[slots[0, peeled]] ^ prints[slots[1, peeled]] ^ prints[slots[2, peeled]]
                prints[at] = wanted[peeled] ^ found
            return cls(seed, segment, count, prints)
        raise ValueError("keys are not distinct")

    def contains(self, keys: np.ndarray) -> np.ndarray:
        hashes = self._hashed(keys, self.seed)
        a, b, c = self._slots(hashes, self.segment, self.count)
        return self._print(hashes) == self.prints[a] ^ self.prints[b] ^ self.prints[c]

    def to_bytes(self) -> bytes:
        return np.array([self.seed, self.segment, self.count], np.int64).tobytes() + self.prints.tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> "BinaryFuse8":
        seed, segment, count = (int(x) for x in np.frombuffer(blob, np.int64, 3))
        return cls(seed, segment, count, np.frombuffer(blob, np.uint8, offset=24))


def digests(docs: DataFrame, batch: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, batch, digest, sha256`` of each row's normalised text; ``digest`` is
    the first 64 bits of the SHA-256."""
    sha = F.sha2(normalised(F.col(f"`{text}`")).cast("binary"), 256)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), batch.cast("int").alias("batch"), sha.alias("sha256"))
    top, low = F.conv(F.substring("sha256", 1, 8), 16, 10).cast("long"), F.conv(F.substring("sha256", 9, 8), 16, 10).cast("long")
    return rows.withColumn("digest", F.shiftleft(top, 32).bitwiseOR(low))


def snapshot_filters(buckets: DataFrame, shards: int) -> DataFrame:
    """``batch, shard, filter`` for the distinct ``(batch, digest)`` of ``buckets``."""
    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(rows["digest"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"batch": [key[0]], "shard": [key[1]], "filter": [BinaryFuse8.build(keys).to_bytes()]})

    sharded = buckets.select("batch", "digest", F.pmod("digest", F.lit(shards)).cast("int").alias("shard"))
    return sharded.groupBy("batch", "shard").applyInPandas(build, "batch int, shard int, filter binary")


def screen(incoming: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """``batch, digest, hit`` (a snapshot's batch) for each digest of ``incoming``
    that the filter of an earlier batch lets pass: all true members and about one
    in 256 others."""
    def probe(key: tuple, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"batch": np.zeros(0, np.int32), "digest": np.zeros(0, np.int64), "hit": np.zeros(0, np.int32)})]
        for batch, blob in zip(own["batch"], own["filter"]):
            later = rows[rows["batch"] > batch]
            found = BinaryFuse8.from_bytes(blob).contains(later["digest"].to_numpy(np.int64).view(np.uint64))
            out.append(pd.DataFrame({"batch": later["batch"][found], "digest": later["digest"][found], "hit": np.int32(batch)}))
        return pd.concat(out)

    sharded = incoming.select("batch", "digest", F.pmod("digest", F.lit(shards)).cast("int").alias("shard"))
    return sharded.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(probe, "batch int, digest long, hit int")


def exact_duplicates(docs: DataFrame, batch: Column, shard_rows: int = 1_000_000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per row of ``docs``.

    ``batch`` numbers the order of arrival. Each batch is screened against the
    filters of all earlier ones, which are immutable snapshots by then; filters
    hold about ``shard_rows`` digests. Texts are equal if they are identical after
    :func:`normalised`; of equal texts the smallest ``doc_id`` stays.

    Null text counts as empty, and empty texts equal each other. A null ``doc_id``
    comes after all others: such a row stays only where no row of its group has an
    id. Rows that repeat an id with the same text count each in ``group_size`` and
    share ``kept``. An empty table gives no rows; other columns are not read.
    """
    rows = written(digests(docs, batch, doc_id, text), "digests")
    buckets = written(rows.groupBy("batch", "digest").agg(F.count("*").alias("n")), "buckets")
    shards = max(1, -(-buckets.count() // shard_rows), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    passed = screen(buckets, snapshot_filters(buckets, shards), shards)
    exact = buckets.select(F.col("batch").alias("hit"), "digest")
    seen = passed.join(exact, ["hit", "digest"]).select("digest")
    new = buckets.where(F.col("n") > 1).select("digest")
    doubted = seen.unionByName(new).distinct()
    members = written(rows.join(doubted, "digest").select("doc_id", "digest", "sha256"), "members")

    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    wanted = members.select(F.col("doc_id").alias("wanted")).distinct()
    # the plan is the same at every size: both sides are dealt out by id
    texts = texts.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi").select("doc_id", normalised(F.col("text")).alias("text"))
    compared = (
        texts.groupBy("text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") > 1).select(F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), "keep_id", "group_size")
    )
    joined = rows.join(compared, "sha256", "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | keep.eqNullSafe(F.col("doc_id"))).alias("kept"), F.col("sha256").alias("text_sha256"),
    )
