"""Token ids of many texts at once.

``words``
    BPE with word ends that drops white space (NFC, lower case, runs of letters,
    single digits, runs of other characters), by ``tokenizers``. A text is cut
    where the tokenizer can't join what stands on both sides; its ids are those
    of its segments, one after the other. Segments are cut with array arithmetic
    on the bytes and made distinct, and only those that the worker process has
    not seen yet are encoded. Texts for which a cut could matter are encoded whole.
``bytes``
    byte-level BPE with merges in the order of the ids, by ``tiktoken`` with the
    vocabulary of a ``tokenizers`` file as ranks.
``pieces``
    BPE by ``sentencepiece``.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .kernels import WHITE, text_bytes

#: Distinct segments that a worker remembers for each tokenizer (about 250 bytes each).
REMEMBERED = 300_000

#: Classes of bytes: white space, letters, digits, other ASCII, beyond ASCII.
CLASS = np.array([0 if WHITE[c] else 4 if c >= 128 else 1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 3 for c in range(256)], np.uint8)

#: Letters that are lower-cased one by one and stay as they are under NFC.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: the byte's
    own character if that is printable, else one from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    return first[:-1]


class Words:
    """Segments lie between white space, and are cut inside ASCII where a run of
    letters, digits or others ends. What follows an apostrophe stays with it
    (``'s`` is a piece of its own)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Runs of Latin letters need the vocabulary's merges only."""
        model, letters = self.model.tokenize, self.letters
        latin = [LATIN(s) is not None for s in segments]
        rest = iter(self.whole([s for s, x in zip(segments, latin) if not x]))
        return [[t.id for t in model(s.lower().encode().decode("latin-1").translate(letters))] if x else next(rest) for s, x in zip(segments, latin)]

    def uncut(self, texts: pa.Array) -> pa.Array:
        """Texts that may hold a special token."""
        return pc.match_substring(texts, "<|")

    def segments(self, data: np.ndarray, offsets: np.ndarray):
        kind = CLASS[data]
        white = kind == 0
        begin = _starts(data, offsets)
        begin[1:] |= (kind[1:] != kind[:-1]) & (((kind[1:] < 4) & (kind[:-1] < 4) & (data[:-1] != ord("'"))) | white[:-1])
        begin &= ~white
        at = np.flatnonzero(begin)
        kept = ~white
        before = np.cumsum(kept)
        ends = np.append(before[at] - 1, before[-1] if len(before) else 0)
        return data[kept], ends, np.searchsorted(at, offsets)


class ByteLevel:
    """Byte-level BPE. Strings of special tokens are plain text."""

    def __init__(self, path: str):
        import json

        import tiktoken
        byte_of = {letter: b for b, letter in byte_letters().items()}
        with open(path) as file:
            model = json.load(file)
        special = {t["id"] for t in model["added_tokens"]}
        self.bytes_of = {i: bytes(map(byte_of.get, token)) for token, i in model["model"]["vocab"].items() if i not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: byte-level pieces
        self.model = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks={b: i for i, b in self.bytes_of.items()}, special_tokens={})

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [self.model.encode_to_numpy(t) if t else np.zeros(0, np.uint32) for t in texts.to_pylist()]
        flat = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
        return flat, np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)

    def token_bytes(self) -> list[bytes]:
        return [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]


class Pieces:
    """Sentencepiece BPE; it puts one space in front of a text by itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(texts.to_pylist(), num_threads=1)
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        return np.fromiter(chain.from_iterable(found), np.int32, int(bounds[-1])), bounds

    def token_bytes(self) -> list[bytes]:
        def of(i: int) -> bytes:
            piece = self.model.id_to_piece(i)
            return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("\u2581", " ").encode()
        return [of(i) for i in range(self.model.get_piece_size())]


class Encoder:
    """A tokenizer with segments, and the ids of those that it has encoded."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.known: dict[str, bytes] = {}

    def _of(self, segments: list[str]) -> list[bytes]:
        """The ids of distinct segments, as packed 32-bit integers."""
        found = list(map(self.known.get, segments))
        missing = [s for s, ids in zip(segments, found) if ids is None]
        if missing:
            if len(self.known) + len(missing) > REMEMBERED:
                self.known = {}
            made = [array("i", ids).tobytes() for ids in self.tokenizer.encode(missing)]
            self.known.update(zip(missing, made))
            fresh = iter(made)
            found = [next(fresh) if ids is None else ids for ids in found]
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the offset of each text's
        first id (one more than there are texts). Null counts as empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        data, offsets = text_bytes(texts)
        body, ends, first = self.tokenizer.segments(data, offsets)
        n = len(ends) - 1
        flat, counts = np.zeros(0, np.int32), np.zeros(n, np.int64)
        if n:
            buffers = [None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(np.ascontiguousarray(body))]
            distinct = pa.Array.from_buffers(pa.large_string(), n, buffers).dictionary_encode()
            found = self._of(distinct.dictionary.to_pylist())
            lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
            pool, at = np.frombuffer(b"".join(found), "<i4"), np.concatenate([[0], np.cumsum(lengths)])
            which = distinct.indices.to_numpy()
            counts = lengths[which]
            flat = pool[ranges(at[which], counts)]
        bounds = np.concatenate([[0], np.cumsum(counts)])[first]
        odd = np.flatnonzero(self.tokenizer.uncut(texts).to_numpy(zero_copy_only=False))
        return self._with_whole(texts, flat, bounds, odd) if len(odd) else (flat, bounds)

    def _with_whole(self, texts, flat, bounds, odd):
        whole = dict(zip(odd.tolist(), self.tokenizer.whole(texts.take(pa.array(odd)).to_pylist())))
        parts = [np.array(whole[i], np.int32) if i in whole else flat[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each range, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def encoder(kind: str, path: str):
    """The worker process's own encoder, loaded once and kept between its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = vars(sys.modules.setdefault("_held_encoders", ModuleType("_held_encoders")))
    if (kind, path) not in held:
        held[kind, path] = {"words": lambda p: Encoder(Words(p)), "bytes": ByteLevel, "pieces": Pieces}[kind](path)
    return held[kind, path]
