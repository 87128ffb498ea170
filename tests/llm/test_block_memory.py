"""A block of texts is worked on in chunks, whose arrays bound a worker's memory."""

import random
import tracemalloc

import pyarrow as pa
import zstandard

from tidewater.llm import suffix_dedup


def test_a_block_is_cut_into_phrases_in_bounded_memory():
    pick = random.Random(5)
    texts = ["".join(chr(97 + pick.randrange(26)) for _ in range(1 << 16))[:65000 + i] for i in range(64)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    blob = zstandard.ZstdCompressor().compress(sink.getvalue())
    tracemalloc.start()
    own = suffix_dedup.BlockPhrases(blob, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(own.data) == sum(map(len, texts))
    assert peak < 25 * len(own.data)
