"""Operators that SQL can express: the registered queries against DuckDB, and
edge cases against plain Python."""

import base64
import collections
import hashlib
import re

import pytest
from conftest import SF001

from tidewater.llm import exact_dedup, line_dedup, sharding, warc

LONG = "this line is longer than forty code points, surely"
EXTRA = "doc_id long, text string, h1 long, line string, pos int, row long, bits string, digest long, batch int, sha256 string, shard string, text_key string"


def docs(spark, rows, extra=EXTRA):
    n = len(extra.split(", ")) - 2
    return spark.createDataFrame([(i, t, *([None] * n)) for i, t in rows], extra)


EDGES = [
    (1, LONG + "\nshort\n" + LONG), (2, "  " + LONG.upper() + "\t"), (3, "x\n" + LONG), (4, LONG), (9, LONG + "\nkeep"),
    (5, None), (6, ""), (7, "\n\n"), (None, LONG), (None, None), (8, "é" * 40), (10, "É" * 40), (11, "é" * 40), (12, "é" * 40), (13, "é" * 40),
    (4, LONG), (4, "another text under the same number, of more than forty"), (14, ("word " * 20_000).strip()), (15, "\x0b\x0c" + LONG + " \r"),
]


def brute_lines(rows, min_chars=40, min_docs=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(-1 if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        own = -1 if i is None else i
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and own < max(held[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_line_dedup_edges(spark):
    got = line_dedup.dedup_lines(docs(spark, EDGES)).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert order(map(tuple, got)) == order(brute_lines(EDGES))
    assert line_dedup.dedup_lines(docs(spark, EDGES).limit(0)).count() == 0


def test_line_dedup_bitmap_runs(spark):
    rows = [(i, "\n".join([LONG, LONG, "x", LONG])) for i in range(6)]
    got = line_dedup.keep_bitmaps(docs(spark, rows)).collect()
    assert sorted((r.doc_id, [tuple(x) for x in r.dropped]) for r in got) == [(i, [(0, 2), (3, 1)]) for i in range(5)]


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.dedup_lines(docs(spark, EDGES))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_exact_dedup_edges(spark):
    from pyspark.sql import functions as F
    rows = EDGES + [(20, "a  b\n c"), (21, "a b c"), (19, "a\tb c"), (22, "a b c"), (23, " "), (24, "\n\n")]
    got = exact_dedup.exact_duplicates(docs(spark, rows), F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)), shard_rows=4).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    want = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert order(map(tuple, got)) == order(want)


def test_binary_fuse_filter():
    import numpy as np
    random = np.random.default_rng(3)
    for n in (0, 1, 2, 10, 1000, 100_000):
        keys = np.unique(random.integers(0, 2**63, n, dtype=np.uint64))
        built = exact_dedup.BinaryFuse8.from_bytes(exact_dedup.BinaryFuse8.build(keys).to_bytes())
        assert built.contains(keys).all()
        others = random.integers(2**63, 2**64, 50_000, dtype=np.uint64)
        assert n == 0 or built.contains(others).mean() < 0.01
        assert n < 100_000 or 8 * len(built.prints) / n < 10.5


def test_sharding_limits(spark):
    rows = [(i, "x" * (i % 50)) for i in range(3000)] + [(7, "y" * 30)] * 200 + [(None, "z"), (8, None), (9001, "w" * 900)]
    got = sharding.assign_shards(docs(spark, rows), 500).toPandas()
    assert len(got) == len(rows)
    sums = got.groupby("shard").n_bytes.sum()
    assert (sums[~sums.index.str.startswith("x")] <= 500).all()
    assert got[got.oversize].doc_id.tolist() == [9001]
    whole = got[~got.oversize]
    # a bucket was split only because its parent was too large; prefixes cover each row once
    plain = whole[~whole["shard"].str.contains("-")]
    for shard in plain["shard"].unique():
        if shard:
            assert whole[whole["shard"].str.startswith(shard[:-1])].n_bytes.sum() > 500
    assert sharding.assign_shards(docs(spark, rows).limit(0), 500).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, frame int")


PAGES = [(1, "http://a/?q=%20", "<p>one</p>"), (2, "http://b/\r\nx", "<p>one</p>"), (3, None, None), (4, "u", ""), (None, "n", "only"), (None, "n", "<p>one</p>"),
         (5, "v", "WARC/1.1\r\n\r\nnested"), (6, "w", "é" * 100_000), (7, "w", "é" * 100_000), (7, "w", "é" * 100_000)]


def test_warc_round_trip(spark):
    index = warc.write_archive(pages(spark, PAGES), frame_bytes=1000, bundle_bytes=5000)
    got = warc.read_archive(index).collect()
    best = {}
    for i, _, h in PAGES:
        best[h or ""] = max((x for x in (best.get(h or ""), i) if x is not None), default=None)
    want = []
    for i, u, h in PAGES:
        data = (h or "").encode()
        own = best[h or ""] == i
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if own else "revisit", None if own else best[h or ""], u, data if own else None))
    assert order((*r[:6], None if r[6] is None else bytes(r[6])) for r in got) == order(want)
    one = warc.fetch(index, spark.createDataFrame([(5,)], "page_id long")).collect()
    assert [bytes(r.payload) for r in one] == [b"WARC/1.1\r\n\r\nnested"]
    assert warc.read_archive(warc.write_archive(pages(spark, PAGES).limit(0))).count() == 0


def test_warc_keeps_every_bit_of_an_id(spark):
    """Ids beyond 2^53, with and without nulls beside them."""
    big, most = 2**53 + 1, 2**63 - 1
    for nulls in ([], [(None, "u", "three"), (None, "u", "alone")]):
        rows = [(big, "u", "one"), (big + 2, "u", "one"), (most, "u", "two"), (-most, "u", "two"), (1, "u", "three"), *nulls]
        got = {(r.page_id, r.record_type, r.refers_to) for r in warc.read_archive(warc.write_archive(pages(spark, rows))).collect()}
        want = {(big, "revisit", big + 2), (big + 2, "response", None), (most, "response", None), (-most, "revisit", most), (1, "response", None)}
        assert got == want | ({(None, "revisit", 1), (None, "response", None)} if nulls else set())


def test_bundles_are_plain_zstandard_with_a_seek_table(spark):
    import zstandard
    from pyarrow import fs
    index = warc.write_archive(pages(spark, PAGES), frame_bytes=1000).toPandas()
    for bundle, rows in index.groupby("bundle"):
        system, path = fs.FileSystem.from_uri(bundle)
        with system.open_input_file(path) as handle:
            frames = warc.read_seek_table(handle)
            handle.seek(0)
            whole = zstandard.ZstdDecompressor().stream_reader(handle.read(), read_across_frames=True).read()
        assert len(whole) == sum(f[2] for f in frames)
        starts = {f[0]: sum(g[2] for g in frames[:k]) for k, f in enumerate(frames)}
        for r in rows.itertuples():
            assert whole[starts[r.frame_at] + r.offset:].startswith(b"WARC/1.1\r\n")
