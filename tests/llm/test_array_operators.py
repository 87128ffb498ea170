"""Operators beyond SQL, against brute force on small fixtures."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import SF001
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, mixing, queries, simhash, suffix_dedup, suffix_tree_lm, toxicity

EXTRA = "doc_id long, text string, fp long, node long, block long, part long, train int, label int, label_id int, domain string, mixture string, toxicity string, wanted int, kept_id int"


def docs(spark, rows):
    n = len(EXTRA.split(", ")) - 2
    return spark.createDataFrame([(i, t, *([None] * n)) for i, t in rows], EXTRA)


def prose(seed, n, vocabulary=300):
    pick = random.Random(seed)
    return " ".join("w%d" % int(vocabulary * pick.random() ** 2) for _ in range(n))


def some_texts():
    texts = [prose(s, 30 + 7 * s) for s in range(25)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100, texts[3]), (101, texts[3] + " tail"), (102, "head " + texts[20]), (103, texts[5][:230] + texts[9][-230:]), (104, texts[20].upper())]
    rows += [(105, None), (106, ""), (107, "   \n"), (None, texts[4]), (None, "alone without a number"), (100, texts[3]), (3, "a second text under a number")]
    rows += [(108, "a" * 1000), (109, "ab" * 700), (110, "é" * 300 + texts[2])]
    return rows


def test_ranges_cut_out_of_the_bytes():
    data = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    first, end = np.array([2, 4, 10, 13, 20]), np.array([5, 8, 13, 15, 26])
    taken, moved = suffix_dedup._only(data, first, end)
    # 2-8, 10-13, 13-15 and 20-26; ranges that touch or overlap move together
    assert taken.tobytes() == b"cdefgh" + b"klm" + b"no" + b"uvwxyz"
    assert all(taken[f - m:e - m].tobytes() == data[f:e].tobytes() for f, e, m in zip(first, end, moved))
    assert len(suffix_dedup._only(data, first[:0], end[:0])[0]) == 0


# SimHash

def plain_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def near_rows(seed, n):
    """Texts with small edits, so that fingerprints fall near each other."""
    pick = random.Random(seed)
    base = [prose(s, 400) for s in range(4)]
    rows = []
    for i in range(n):
        words = pick.choice(base).split()
        for _ in range(pick.randrange(4)):
            words[pick.randrange(len(words))] = "edit%d" % pick.randrange(50)
        rows.append((i, " ".join(words)))
    return rows


def brute_components(rows, distance=4):
    prints = {}
    for i, t in rows:
        if i is not None:
            prints.setdefault(plain_fingerprint(t), []).append(i)
    keys = list(prints)
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in keys:
        for b in keys:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k in keys:
        least[find(k)] += prints[k]
    return [(i, "%016x" % plain_fingerprint(t), min(least[find(plain_fingerprint(t))]) if plain_fingerprint(t) in prints else None) for i, t in rows]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("bucket_rows", [4096, 8])
def test_simhash_equals_brute_force(spark, bucket_rows):
    rows = near_rows(5, 150) + [(1000 + (i or 0), t) for i, t in some_texts() if i is not None] + [(None, "alone"), (None, near_rows(5, 1)[0][1])]
    got = simhash.near_duplicates(docs(spark, rows), bucket_rows=bucket_rows).collect()
    assert order(map(tuple, got)) == order(brute_components(rows))


def test_simhash_segments_and_buckets():
    assert simhash.segments(4) == [(0, 21), (21, 21), (42, 22)]
    values = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64)
    values[250:] = values[:250] ^ np.uint64(5)
    a, b = simhash.near_in_bucket(values, np.arange(500), 4)
    assert sorted(zip(a.tolist(), b.tolist())) == [(i + 250, i) for i in range(250)]


def test_one_per_group_keeps_one_row(spark):
    rows = some_texts()
    got = simhash.one_per_group(docs(spark, rows))
    assert got.columns == docs(spark, rows).columns
    kept = [r.doc_id for r in got.collect()]
    assert kept.count(100) == 0 and kept.count(3) == 1 and kept.count(105) == 1 and 106 not in kept
    assert simhash.one_per_group(docs(spark, rows).limit(0)).count() == 0


# repeated substrings

def brute_spans(texts, length):
    seen = collections.Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = True
        starts = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        out.append((len(t), int(gone.sum()), starts, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("length, chunk, block", [(200, 1 << 20, 4 << 20), (80, 300, 2000)])
def test_repeated_spans_equal_brute_force(spark, monkeypatch, length, chunk, block):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rows = some_texts()
    got = suffix_dedup.repeated_spans(docs(spark, rows), length=length, block_bytes=block).collect()
    want = brute_spans([(t or "").encode() for _, t in rows], length)
    assert order((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == order((i, *w) for (i, _), w in zip(rows, want))
    assert suffix_dedup.repeated_spans(docs(spark, rows).limit(0)).count() == 0


def test_repeated_spans_on_the_test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = queries.op7_suffix_dedup(spark, SF001).collect()
    want = brute_spans([(t or "").encode() for _, t in rows], 200)
    assert order((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == order((i, *w) for (i, _), w in zip(rows, want))


def test_windows_of_a_hot_core_are_dealt_out(spark, monkeypatch):
    """A passage in every document, between the document's own text: its edges make a
    different phrase of one core in each, whose windows meet in no one group."""
    pick = random.Random(3)
    own = lambda n: "".join(pick.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage = own(300)
    rows = [(i, own(260) + passage + own(260)) for i in range(200)]
    tables, written = {}, suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", lambda df, name: tables.setdefault(name, written(df, name)))
    got = suffix_dedup.repeated_spans(docs(spark, rows), length=200, block_bytes=20_000, part_bytes=8_000).collect()
    want = brute_spans([t.encode() for _, t in rows], 200)
    assert order((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == order((i, *w) for (i, _), w in zip(rows, want))
    sizes = [r.n for r in tables["windows"].groupBy("part").agg(F.sum(F.octet_length("windows")).alias("n")).collect()]
    assert max(sizes) < 0.1 * sum(sizes)


def test_suffix_ranks_are_the_order_of_the_bytes():
    data = np.frombuffer(("abracadabra" * 30 + prose(1, 200)).encode(), np.uint8)
    rank = suffix_dedup.suffix_ranks(data, 50)
    windows = [data[i:i + 50].tobytes() for i in range(len(data) - 49)]
    by_bytes = {w: k for k, w in enumerate(sorted(set(windows)))}
    seen = {}
    for w, r in zip(windows, rank.tolist()):
        assert seen.setdefault(w, r) == r
    assert sorted(seen, key=seen.get) == sorted(by_bytes)


# language model

class PlainTree:
    """The same model with dictionaries."""

    def __init__(self, texts, depth, min_share, divergence, prior):
        self.depth, self.prior, self.end = depth, prior, object()
        lines = [self.tokens(t) for t in texts]
        flat = [w for line in lines for w in line]
        self.c, self.n = collections.Counter(flat), len(flat)
        self.states = {}
        candidates = {(w,): c for w, c in self.c.items() if w is not self.end and c >= min_share * self.n and c > 1}
        for length in range(1, depth + 1):
            seen = collections.defaultdict(collections.Counter)
            for line in lines:
                for i in range(length, len(line)):
                    context = tuple(line[i - length:i])
                    if context in candidates and (length == 1 or context[1:] in self.states):
                        seen[context][line[i]] += 1
            longer = {}
            for context, nexts in seen.items():
                total, once = candidates[context], sum(c == 1 for c in nexts.values())
                back = (prior + once) / (total + prior)
                gain = 0.0
                for x, c in nexts.items():
                    p = float(np.float32(self.p(context[1:], x)))
                    gain += c * math.log(back if c < 3 else (c - 1) / (total - 1 + prior) / p + back)
                    if x is not self.end and c > 1 and c >= min_share * self.n:
                        longer[context + (x,)] = c
                if gain > divergence:
                    self.states[context] = (nexts, total, back)
            candidates = longer

    def tokens(self, text):
        return [*(text or "").encode().lower().split(), self.end]

    def p(self, context, x):
        if not context:
            return (self.c[x] + 0.5) / (self.n + 0.5 * (len(self.c) + 1))
        nexts, total, back = self.states[context]
        c = nexts[x]
        return (c if c > 1 else 0) / (total + self.prior) + back * self.p(context[1:], x)

    def score(self, text):
        line, total = self.tokens(text), 0.0
        for i, x in enumerate(line):
            context = ()
            for length in range(1, min(i, self.depth) + 1):
                if tuple(line[i - length:i]) not in self.states:
                    break
                context = tuple(line[i - length:i])
            total += math.log10(self.p(context, x))
        return total


@pytest.mark.parametrize("depth", [1, 3])
def test_language_model_equals_plain_tree(spark, depth):
    rows = some_texts() + [(200 + i, "the cat sat on the mat the dog sat on the mat " * (i + 1)) for i in range(6)]
    learn = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 5 != 1
    plain = PlainTree([t for i, t in rows if learn(i)], depth, 0.002, 1.0, 20.0)
    assert len(plain.states) > 5
    got = suffix_tree_lm.score_texts(docs(spark, rows), toxicity.fold(F.col("doc_id")) != 1, depth, 0.002, 1.0, 20.0, block_bytes=3000).collect()
    want = []
    for i, t in rows:
        line = plain.tokens(t)
        base = sum(math.log10(plain.p((), x)) for x in line)
        want.append((i, learn(i), len(line), sum(plain.c[x] > 0 for x in line), plain.n, round(base, 4), round(plain.score(t), 4)))
    assert order((r.doc_id, r.train, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in got) == order(want)
    assert {r.states for r in got} == {1 + len(plain.states)}
    for context in plain.states:  # next-word distributions sum to one, with one unknown word
        assert abs(sum(plain.p(context, x) for x in plain.c) + plain.p(context, "unknown") - 1) < 1e-9


def test_language_model_without_training_rows(spark):
    got = suffix_tree_lm.score_texts(docs(spark, [(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in sorted(got)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert suffix_tree_lm.score_texts(docs(spark, [(1, "a")]).limit(0), F.lit(True)).count() == 0


def test_language_model_beats_the_root_on_held_out_texts(spark):
    rows = [r for r in queries.op2_suffix_tree_lm(spark, SF001.replace("0.001", "0.01")).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


# toxicity

def brute_segments(scores):
    """Ruzzo and Tompa's definition: the best segment, then both sides again."""
    if not len(scores):
        return []
    sums = np.concatenate([[0], np.cumsum(scores)])
    best, where = 0.0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            if sums[b] - sums[a] > best + 1e-12:
                best, where = sums[b] - sums[a], (a, b)
    if where is None:
        return []
    a, b = where
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return brute_segments(scores[:a]) + [(a, b, best)] + right


def test_maximal_segments():
    pick = np.random.default_rng(2)
    for n in (0, 1, 5, 40, 80):
        for _ in range(8):
            scores = pick.normal(-0.2, 1, n)
            got, want = toxicity.maximal_segments(scores), brute_segments(scores)
            assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
            assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_toxicity_finds_passages_and_leaves_clean_texts(spark):
    rows, labels = [], []
    for i in range(600):
        text = prose(i, 60 + i % 50).split()
        toxic = i % 4 == 0
        if toxic:
            text[20:22] = ["vile%d" % (i % 7), "filth."]
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic), "clash"))
    labels += [(None, 1, ""), (5, None, ""), (99999, 1, "")]
    rows += [(1000, None), (1001, ""), (1002, prose(7, 5000)), (1003, prose(8, 30) + " vile3 filth " + prose(9, 30))]
    frame = docs(spark, rows)
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int, text string").where("doc_id is null or doc_id % 5 <> 0"))
    got = {r.doc_id: r.found for r in toxicity.score_texts(frame, model, into="found").collect()}
    right = [(got[i].score >= 0.5) == (i % 4 == 0) for i in range(0, 600, 5)]
    assert np.mean(right) > 0.97
    found = got[1003].passages
    assert got[1003].score > 0.5 and (30, 32) in zip(found[::2], found[1::2])
    assert got[1000] == got[1001] and got[1000].score < 0.5 and got[1002].score < 0.5
    assert toxicity.score_texts(frame.limit(0), model).count() == 0


def test_every_copy_of_a_toxic_passage_is_found(spark):
    """Copies far apart, each by its own words; earlier uses take nothing away and
    copies add little to the score."""
    rows, labels = [], []
    for i in range(600):
        text = prose(i, 60 + i % 50).split()
        if i % 4 == 0:
            text[20:23] = ["vile%d" % (i % 7), "filth.", "scum%d" % (i % 3)]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    parts, want = [], []
    for k in range(8):
        parts += prose(2000 + k, 40).split()
        want.append((len(parts), len(parts) + 3))
        parts += ["vile3", "filth", "scum1"]
    parts += prose(3000, 40).split()
    scattered = prose(4000, 400).split()
    scattered[10:310:30] = ["filth"] * 10
    rows += [(1000, " ".join(parts)), (1001, " ".join([*scattered, "vile3 filth scum1", prose(4001, 30)])), (1002, " ".join(parts[:80]))]
    frame = docs(spark, rows)
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.found for r in toxicity.score_texts(frame.where("doc_id >= 1000"), model, into="found").collect()}
    pairs = lambda p: list(zip(p[::2], p[1::2]))
    assert pairs(got[1000].passages) == want
    assert (400, 403) in pairs(got[1001].passages) and got[1001].score > 0.5
    ids, scores = np.array([1, 2, 9, 1, 2, 9, 1, 1]), np.array([2.0, 3, -9, 2, 3, -9, 2, 2])
    found = toxicity.maximal_segments(scores)
    assert found == [(0, 2, 5.0), (3, 5, 5.0), (6, 8, 4.0)] and toxicity.discounted(scores, ids, found) == [5.0, 2.5, 3.0]


def test_toxicity_without_labels(spark):
    model = toxicity.fit(docs(spark, [(1, "a b")]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.found.score for r in toxicity.score_texts(docs(spark, [(1, "a b"), (2, None), (3, "vile " * 50)]), model, into="found").collect()} == {0.25}


# mixing

def test_rates_meet_reachable_targets(spark):
    pick = np.random.default_rng(4)
    p = pick.dirichlet([0.2, 0.2, 0.2], 400)
    t = pick.integers(1, 500, 400)
    table = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(t, p)], "n_tokens long, posterior array<double>")
    rates, before, target, reached = mixing.fit_rates(table, np.array([5.0, 3.0, 2.0]), tokens=60_000.0)
    assert np.allclose(before, t @ p) and np.allclose(target, [30_000, 18_000, 12_000])
    r = rates.of(p)
    assert (r >= 0).all() and np.allclose((r * t) @ p, target, atol=1e-4 * 60_000) and np.allclose(reached, (r * t) @ p)


def test_rates_are_the_best_where_targets_are_out_of_reach(spark):
    p = np.array([[0.6, 0.4], [0.4, 0.6]])
    table = spark.createDataFrame([(100, [float(x) for x in row]) for row in p], "n_tokens long, posterior array<double>")
    rates, before, target, reached = mixing.fit_rates(table, np.array([1.0, 0.0]), most_steps=400)
    scale = 1 / np.diag((p * 100).T @ p)
    loss = lambda r: float((scale * ((np.asarray(r) * 100) @ p - target) ** 2).sum())
    best = min(loss((a, b)) for a in np.linspace(0, 5, 251) for b in np.linspace(0, 2, 101))
    assert loss(rates.of(p)) <= best * 1.01


def test_mix_edges(spark):
    rows = [(i, prose(i, 40, 30)) for i in range(40)] + [(100 + i, "zu der die und " * 20) for i in range(10)] + [(None, None), (200, ""), (200, "")]
    labelled = spark.createDataFrame([(i, "a", 1) for i in range(30)] + [(100, "b", 1), (101, "b", 2), (101, "b", 3), (None, "c", 1), (5, None, 1)], "doc_id long, domain string, text int")
    frame = docs(spark, rows)
    got = mixing.mix(frame.drop("mixture"), labelled, weights={"a": 0.5, "b": 0.5}).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.mixture for r in got}
    assert by[3].domain == "a" and by[105].domain == "b" and by[105].rate > 1 > by[3].rate
    assert by[200].n_tokens == 0 and all(abs(sum(r.mixture.posterior) - 1) < 1e-9 for r in got)
    assert mixing.mix(frame.limit(0).drop("mixture"), labelled).count() == 0
    assert mixing.mix(frame.drop("mixture"), labelled.limit(0)).count() == len(rows)


# decontamination

def plain_scores(items, passage):
    """BM25 of every item for a passage's distinct words, over the item's own."""
    words = {i: decontaminate._words(t).tolist() for i, t in items}
    average = sum(map(len, words.values())) / len(words)
    df = collections.Counter(w for v in words.values() for w in set(v))
    idf = {w: math.log1p((len(items) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    out = {}
    for i, own in words.items():
        tf = collections.Counter(own)
        weight = {w: idf[w] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(own) / average)) for w, c in tf.items()}
        out[i] = sum(weight[w] for w in weight if w in passage) / sum(weight.values())
    return out


def test_retrieval_is_exact_above_the_threshold():
    items = [(i, prose(1000 + i, 12 + i % 9, 120)) for i in range(45)]
    index = decontaminate.build_index(items, 5)
    for seed in range(30):
        passage = decontaminate._words(prose(seed, 40, 120))
        held = np.unique(passage)
        at = np.searchsorted(index.terms, held)
        at = at[np.append(index.terms, 0)[at] == held]
        _, found, score = decontaminate.retrieve(index, np.zeros(len(at), np.int64), at, 1, 0.5)
        want = {i: s for i, s in plain_scores(items, set(held.tolist())).items() if s >= 0.5}
        assert {int(index.items[k]): round(float(s), 9) for k, s in zip(found, score)} == {i: round(s, 9) for i, s in want.items()}


def test_contamination_cases(spark):
    items = [(i, "Question %s? Answer %s." % (prose(500 + i, 25, 2000), prose(900 + i, 8, 2000))) for i in range(20)] + [(50, None), (51, ""), (52, "!!"), (None, "no number " + prose(1, 20, 5000))]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    whole, half = items[3][1], items[4][1].split("?")[0]
    rows = [(1, prose(1, 500) + " " + whole + " " + prose(2, 500)), (2, whole.upper().replace(" ", "\n")), (3, half + " " + prose(3, 60)), (4, prose(4, 3000)),
            (5, None), (6, ""), (7, whole), (7, whole), (8, whole + " " + items[5][1]), (9, items[-1][1])]
    for index_bytes in (1 << 20, 400):
        found = decontaminate.find_contamination(docs(spark, rows), benchmark, index_bytes=index_bytes, into="found").collect()
        got = sorted((r.doc_id, r.found.item_ids) for r in found)
        assert got == [(1, [3]), (2, [3]), (3, []), (4, []), (5, []), (6, []), (7, [3]), (7, [3]), (8, [3, 5]), (9, [-1])]
    assert decontaminate.find_contamination(docs(spark, rows).limit(0), benchmark).count() == 0
    assert all(not r.found.item_ids for r in decontaminate.find_contamination(docs(spark, rows), benchmark.limit(0), into="found").collect())


def test_near_copies_are_found_whatever_the_last_sentence_lost(spark):
    """Whole-item containment of 0.8 is enough, also where the short last sentence is
    changed or left out; a shared last sentence alone is not."""
    items = [(i, "%s. %s. %s." % (prose(500 + i, 30, 5000), prose(700 + i, 12, 5000), prose(900 + i, n, 5000))) for i, n in enumerate((1, 3, 5, 8))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [], {}
    for i, text in items:
        sentences = text.split(". ")
        last = sentences[2].rstrip(".").split()
        last[len(last) // 2] = "other"
        changed, without, alone = ". ".join([*sentences[:2], " ".join(last)]), ". ".join(sentences[:2]), sentences[2] + " " + prose(i, 40, 5000)
        for k, passage in enumerate((changed, without, alone)):
            whole = decontaminate.shingle_hashes(decontaminate._words(text), 5)
            held = np.isin(np.unique(whole), decontaminate.shingle_hashes(decontaminate._words(passage), 5)).mean()
            rows.append((10 * i + k, prose(50 + i, 100) + " " + passage + " " + prose(60 + i, 100)))
            want[10 * i + k] = [i] if held >= 0.8 else []
    assert sum(map(bool, want.values())) >= 7
    got = {r.doc_id: r.found.item_ids for r in decontaminate.find_contamination(docs(spark, rows), benchmark, into="found").collect()}
    assert got == want


def test_most_weight_that_missing_shingles_can_take_along():
    """Against all sets of missing shingles of short texts."""
    import itertools
    pick = random.Random(1)
    for _ in range(200):
        n = pick.choice([2, 3, 5])
        words = pick.randrange(n, 12)
        weights, shingles = np.array([pick.random() for _ in range(words)]), words - n + 1
        lost = pick.randrange(min(shingles, 4) + 1)
        best = max(sum(weights[p] for p in range(words) if set(range(max(0, p - n + 1), min(p, shingles - 1) + 1)) <= set(gone)) for gone in itertools.combinations(range(shingles), lost))
        assert abs(best - decontaminate.most_missing(weights, lost, n)) < 1e-9


def test_nothing_that_the_rule_accepts_is_lost(spark):
    """Items from templates, so that few rare words carry most of an item's own score, and
    passages with some of these words left out or changed: all items in all windows by the
    rule alone, for one shard and for many, with equal scores."""
    pick = random.Random(8)
    frames = [[f"frame{k}word{j}" for j in range(36)] for k in range(4)]
    items = []
    for i in range(200):
        words = list(frames[i % 4])
        for spot in (3, 17, 33):
            words[spot] = f"rare{i}at{spot}"
        items.append((i, " ".join(words[:30]) + ". " + " ".join(words[30:]) + "."))
    rows = []
    for d in range(60):
        words = items[pick.randrange(200)][1].split()
        for _ in range(pick.randrange(4)):
            words[pick.choice([0, 1, 3, 17, 33, 34, 35])] = "changed%d" % pick.randrange(9)
        rows.append((d, " ".join(["lead%d" % j for j in range(pick.randrange(30))] + words + ["tail"] * pick.randrange(30))))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    ways = {i: decontaminate.ways(t, 5) for i, t in items}
    size, want = 2 * 36, {}
    for d, text in rows:
        words = decontaminate._words(text)
        windows = [words[at:at + size] for at in range(0, max(1, len(words) - size // 2), size // 2)]
        want[d] = sorted(i for i, own in ways.items() if any(decontaminate.matches(own, w, 0.8) for w in windows))
    assert sum(len(v) > 0 for v in want.values()) > 20
    found = []
    for index_bytes in (1 << 20, 3000):
        got = decontaminate.find_contamination(docs(spark, rows), benchmark, index_bytes=index_bytes, into="found").collect()
        assert {r.doc_id: r.found.item_ids for r in got} == want
        found.append({r.doc_id: round(r.found.best_score or 0, 9) for r in got})
    assert found[0] == found[1]


def test_contamination_query_equals_brute_force(spark):
    """Every document against every item by shingles, over windows of the same words."""
    sf = SF001
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    ways = {i: decontaminate.ways(t, 5) for i, t in items}
    size = 2 * max(len(decontaminate._words(t)) for _, t in items)
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = decontaminate._words(r.text or "")
        hit = set()
        for at in range(0, max(1, len(words) - size // 2), size // 2):
            window = words[at:at + size]
            hit |= {i for i, own in ways.items() if decontaminate.matches(own, window, 0.8)}
        want[r.doc_id] = sorted(hit)
    got = {r.doc_id: r.item_ids for r in queries.op8_decontaminate(spark, sf).collect()}
    assert got == want and any(want.values())
