"""Packing, alignment of tokenizers and the conversation trie, against plain Python."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SF001
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import conversation_trie, cross_tokens, packing, queries, segments

WORDS, BYTES, PIECES = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
EXTRA = "doc_id long, text string, block long, at long, pair long, n long, start long, length long, ids string, part long, spot long, count long, best int, groups string"


def docs(spark, rows):
    n = len(EXTRA.split(", ")) - 2
    return spark.createDataFrame([(i, t, *([None] * n)) for i, t in rows], EXTRA)


def fuzz(seed, n):
    pick = random.Random(seed)
    parts = [*"aB1 9'\n\t<|>e!.,#̸́é中　 ▁ßΣİ\x00\x1c_-", "  ", "<|endoftext|>", "'s", "'LL", "<0x41>", "</s>", "the ", " of", "\r\n", "==="]
    return ["".join(pick.choice(parts) for _ in range(pick.randrange(40))) for _ in range(n)]


EDGES = [
    (1, "Some words, and 123 more!"), (2, None), (3, ""), (4, "   \n"), (5, "x" * 3000), (6, "a▁b"), (7, "<|endoftext|> and <s> <0x41>"),
    (None, "no number"), (None, None), (1, "a second text under one number"), (1, "Some words, and 123 more!"), (8, "été 中文 ß " * 40), (9, "word " * 9000),
    (10, " wide　spaces here"), (11, "d́ é ≠ ≮ café"), *((100 + i, t) for i, t in enumerate(fuzz(3, 40))),
]


# token ids

def test_segments_equal_whole_texts():
    texts = fuzz(1, 3000) + [t or "" for _, t in EDGES]
    own = Tokenizer.from_file(WORDS)
    flat, bounds = segments.encoder("words", WORDS)(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    own = Tokenizer.from_file(BYTES)
    own.encode_special_tokens = True
    flat, bounds = segments.encoder("bytes", BYTES)(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


def test_forgotten_segments_are_encoded_again(monkeypatch):
    monkeypatch.setattr(segments, "REMEMBERED", 5)
    own = segments.Encoder(segments.Words(WORDS))
    for texts in (["one two three four", "five six"], ["one seven", "two one"], [], [None]):
        flat, bounds = own(pa.array(texts, pa.string()))
        want = [own.tokenizer.whole([t or ""])[0] for t in texts]
        assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want


# packing

@pytest.mark.parametrize("counts", [{5: 3}, {4096: 2, 1: 10_000}, {2100: 10**9, 7: 3}, {i: 10**6 + i for i in range(1, 4097, 5)}, {}])
def test_patterns_place_every_piece(counts):
    patterns = packing.pack_lengths(counts, 4096)
    placed = collections.Counter()
    for sequences, slots in patterns:
        assert sequences > 0 and sum(length * pieces for length, pieces in slots.items()) <= 4096
        for length, pieces in slots.items():
            placed[length] += sequences * pieces
    assert placed == counts and len(patterns) <= 5 * max(1, len(counts))


def test_shortest_pack_takes_the_next_length():
    # by hand: 6 and 5 open packs of 10; 4 goes to the pack with most room (5), 3 to that with 4 left
    assert sorted((n, tuple(sorted(s.items()))) for n, s in packing.pack_lengths({6: 1, 5: 1, 4: 1, 3: 1}, 10)) == [(1, ((3, 1), (6, 1))), (1, ((4, 1), (5, 1)))]


def check_packing(rows, texts, size, end):
    """rows: (doc_id, start, length, ids, doc_tokens, sequence_id, offset)."""
    tokenizer = Tokenizer.from_file(WORDS)
    want = collections.Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [end])) for i, t in texts)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r)
        by_sequence[r[5]].append(r)
    # each row's pieces chain by (doc_tokens, start); repeated ids have as many chains
    for i, own in by_doc.items():
        left = collections.Counter((r[1], tuple(r[3]), r[4]) for r in own)
        for (j, ids), n in want.items():
            if j != i:
                continue
            for _ in range(n):
                at = 0
                while at < len(ids):
                    key = next(k for k in left if left[k] and k[0] == at and k[2] == len(ids) and ids[at:at + len(k[1])] == k[1] and k[1])
                    left[key] -= 1
                    at += len(key[1])
        assert not +left
    assert set(by_doc) == {i for i, _ in texts}
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r[6]):
            assert r[6] == at and r[2] == len(r[3]) > 0
            at += r[2]
        assert at <= size
        padding += 0 if at.bit_count() == 1 else size - at
    return padding / sum(len(ids) * n for (_, ids), n in want.items())


@pytest.mark.parametrize("size", [16, 4096])
def test_packing_edges(spark, size):
    found = packing.pack_documents(docs(spark, EDGES).repartition(3), size, WORDS, end_id=2)
    assert found.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert check_packing([tuple(r) for r in found.collect()], EDGES, size, 2) <= 1 / 32


def test_packing_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(packing, "SENT_ROWS", 0)
    rows = packing.pack_documents(docs(spark, EDGES), 128, WORDS, end_id=2).collect()
    assert check_packing([tuple(r) for r in rows], EDGES, 128, 2) <= 1 / 32


def test_packing_empty(spark):
    assert packing.pack_documents(docs(spark, []), 4096, WORDS, end_id=2).count() == 0


def test_packing_query(spark):
    rows = queries.op12_packing(spark, SF001).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    full = []
    for r in rows:
        ids = (tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2])[r.start:r.start + r.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
        full.append((r.doc_id, r.start, r.length, ids, r.doc_tokens, r.sequence_id, r.offset))
    assert check_packing(full, list(texts.items()), 4096, 2) < 0.02


# alignment of tokenizers

def plain_alignment(rows):
    first, second = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    first.encode_special_tokens = True
    byte_of = {letter: b for b, letter in segments.byte_letters().items()}

    def piece_bytes(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def ends(parts):
        at, out = 0, []
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    found, count = [], collections.Counter()
    for i, t in rows:
        a, b = first.encode(" " + (t or ""), add_special_tokens=False).ids, second.encode(t or "")
        bytes_a, bytes_b = [bytes(byte_of[c] for c in first.id_to_token(x)) for x in a], [piece_bytes(x) for x in b]
        whole = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append((i, [], [], [], []))
            continue
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        token_at = [(x, y) for x, y in zip(np.repeat(range(len(a)), [len(p) for p in bytes_a]), np.repeat(range(len(b)), [len(p) for p in bytes_b]))]
        links = [(a[x], b[y]) for x, y in sorted(set(token_at))]
        cuts = sorted(set(ends_a) & set(ends_b))
        left, right, groups = list(zip(a, ends_a)), list(zip(b, ends_b)), []
        for c in cuts:
            sides = []
            for side in (left, right):
                n = next((k for k, (_, e) in enumerate(side) if e > c), len(side))
                sides.append(",".join(str(x) for x, _ in side[:n]))
                del side[:n]
            groups.append("|".join(sides))
        count.update(links)
        found.append((i, a, b, groups, links))
    best = collections.Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return [(i, len(a), len(b), len(g), len(k), sum(count[p] == best[p[1]] for p in k), sum(count[p] for p in k), ";".join(g)) for i, a, b, g, k in found]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_alignment_edges(spark, monkeypatch):
    monkeypatch.setattr(cross_tokens, "CHUNK", 300)
    found = cross_tokens.align_tokenizers(docs(spark, EDGES).repartition(3), BYTES, PIECES)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert order(map(tuple, found.collect())) == order(plain_alignment(EDGES))


def test_alignment_without_tokens(spark):
    assert cross_tokens.align_tokenizers(docs(spark, []), BYTES, PIECES).count() == 0
    rows = cross_tokens.align_tokenizers(docs(spark, [(1, None), (2, "")]), BYTES, PIECES).collect()
    assert order(map(tuple, rows)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in plain_alignment(rows)]
    assert order(map(tuple, queries.op11_cross_tokens(spark, SF001).collect())) == order(want)


# conversation trie

def plain_trie(rows, block=0, most=1):
    held = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            held[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in held.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % most if block else 0
        base = c - (c % block if c >= 0 else -(-c % block)) if block else c
        built[c] = own.get(base, [])[:h] + v[h:]
    members, kids = collections.defaultdict(list), collections.Counter()
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
            leaves[k[:d]] += kids[k] == 0
    digest = lambda k, m: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))).encode()).hexdigest()
    return [(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], digest(k, m)) for k, m in members.items()]


TURNS = "conv_id long, turn long, role string, text string, part int, node long, parent string, kids int, depth string, leaves int"


def turns(spark, rows):
    return spark.createDataFrame([(*r, *([None] * 6)) for r in rows], TURNS)


def conversations(seed, n, longest=9):
    pick, rows = random.Random(seed), []
    for c in range(n):
        shared = pick.randrange(4)
        for t in range(pick.randrange(1, longest)):
            rows.append((c * 7 % (3 * n) - 5, t if pick.random() < .9 else None, pick.choice(["user", "assistant", None]), "turn %d" % (t * shared) if pick.random() < .8 else None))
    return rows


#: Cases side by side in one table, each with ids of its own and a first turn of its own.
CASES = {
    "mixed": conversations(1, 60),
    "one chain": [(7, t, "user", "t%d" % t) for t in range(40)] + [(8, t, "user", "t%d" % t) for t in range(25)] + [(9, t, "user", "t%d" % t) for t in range(25)],
    "star": [(c, t, "user", "same" if t == 0 else "own %d" % c) for c in range(200) for t in range(2)],
    "equal": [(c, t, "user", "t%d" % t) for c in range(99, 140) for t in range(3)],
    "repeated rows": [(1, 0, "a", "x")] * 5 + [(2, 0, "a", "x")] * 3 + [(None, 0, "a", "x"), (3, None, None, None), (100, 5, "", "")],
    "sides": [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "1:a", "b"), (4, 0, "a", "é中\U0001f600")],
}
ROWS = [(None if c is None else c + 1000 * k, t, r, x) for k, rows in enumerate(CASES.values()) for c, t, r, x in rows]


@pytest.mark.parametrize("block, most", [(0, 1), (100, 6)])
def test_trie_equals_plain_python(spark, block, most):
    found = conversation_trie.conversation_trie(turns(spark, ROWS), block, most)
    assert order(map(tuple, found.collect())) == order(plain_trie(ROWS, block, most))


def test_one_conversation_over_many_partitions(spark):
    """Positions and prefixes of conversations that cross partition borders."""
    rows = [(c, t, "user", "t%d" % (t // 3)) for c in (5, 6) for t in range(120)] + [(7, 0, "user", "t0")]
    held = turns(spark, rows).repartition(8)
    whole = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        own, convs = conversation_trie.with_openings(conversation_trie.ordered_turns(held))
        depths = collections.defaultdict(list)
        for r in own.collect():
            depths[r.conv_id].append(r.depth)
        prefixes = conversation_trie._prefixes(own, convs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", whole)
    assert {c: sorted(d) for c, d in depths.items()} == {5: list(range(1, 121)), 6: list(range(1, 121)), 7: [1]}
    assert len({(r.depth, r.x1, r.x2) for r in prefixes}) == 121 and len({r.part for r in prefixes if r.conv_id == 5}) > 1


def test_trie_without_rows_and_with_text_ids(spark):
    assert conversation_trie.conversation_trie(turns(spark, [])).count() == 0
    with pytest.raises(TypeError):
        conversation_trie.conversation_trie(turns(spark, []).withColumn("conv_id", F.col("conv_id").cast("string")))


def test_subtree_totals_of_a_forest(spark):
    """Against sums along the paths: a chain of 60, a star, and a random tree."""
    pick = random.Random(5)
    parent = {0: None, 1000: None}
    for i in range(1, 60):
        parent[i] = i - 1
    for i in range(1001, 1050):
        parent[i] = 1000
    for i in range(1050, 1150):
        parent[i] = pick.choice([k for k in parent if k >= 1000])
    kids, mixed = collections.Counter(), collections.Counter()
    for i, p in parent.items():
        if p is not None:
            kids[p] += 1
            mixed[p] ^= i
    weight = {i: pick.randrange(50) for i in parent}
    leaves, total = collections.Counter(), collections.Counter()
    for i in parent:
        at = i
        while at is not None:
            leaves[at] += kids[i] == 0
            total[at] += weight[i]
            at = parent[at]
    tree = spark.createDataFrame([(i, p, kids[i], mixed[i], weight[i]) for i, p in parent.items()], "node long, parent long, kids long, kids_xor long, weight long")
    assert {r.node: (r.leaves, r.weight) for r in conversation_trie.subtree_totals(tree).collect()} == {i: (leaves[i], total[i]) for i in parent}


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert order(map(tuple, queries.op13_conversation_trie(spark, SF001).collect())) == order(plain_trie(rows, 100, 6))
