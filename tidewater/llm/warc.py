"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; a bundle is a run
of frames and ends with a seek table in a skippable frame (the Zstandard
seekable format). An index table maps each record to its bundle, frame and
offset inside the decompressed frame, so one record costs one range read and
one frame.

Tasks write bundles to the shared folder under names of their attempt; the index
names the bundles of successful attempts only, and readers follow the index.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import scratch, small_batches, written

#: Fixed values of the seekable format: magic numbers of the skippable frame and of its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = (
    "page_id long, bundle string, frame int, frame_at long, frame_size long, frame_raw long, offset long, length long"
)
INDEX_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[c.split()[1]]) for c in INDEX_SCHEMA.split(", ")])
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
RECORD_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in RECORD_SCHEMA.split(", ")])


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _of_urn(urn: str):
    digits = urn[len("<urn:page:"):-1]
    return int(digits) if digits else None


def encode_record(page_id, url, payload: bytes, response_id, is_response: bool, date: str) -> bytes:
    """One WARC 1.1 record. A revisit keeps the HTTP header, with the full
    payload's length, and leaves out the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if is_response else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if is_response else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if not is_response:
        head += [f"WARC-Refers-To: {_urn(response_id)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` and the offset behind it. A response whose payload
    doesn't have its digest is an error."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    head = dict(line.split(": ", 1) for line in lines[1:])
    block_at, size = end + 4, int(head["Content-Length"])
    block = data[block_at:block_at + size]
    body = block.index(b"\r\n\r\n") + 4
    length = int(block[:body].split(b"Content-Length: ")[1].split(b"\r\n")[0])
    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
    payload = block[body:] if kind == "response" else None
    if payload is not None and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
    url = head.get("WARC-Target-URI")
    record = {
        "page_id": _of_urn(head["WARC-Record-ID"]), "payload_bytes": length, "payload_digest": digest, "record_type": kind,
        "refers_to": _of_urn(head["WARC-Refers-To"]) if kind == "revisit" else None,
        "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"), "payload": payload,
    }
    return record, block_at + size + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame with ``(compressed, decompressed)`` sizes of all frames."""
    entries = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries)) + entries


def read_seek_table(handle) -> list[tuple[int, int, int]]:
    """``(offset, compressed, decompressed)`` of each frame of an open bundle."""
    size = handle.size()
    handle.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", handle.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    handle.seek(size - 9 - 8 * count)
    flat = struct.unpack(f"<{2 * count}I", handle.read(8 * count))
    frames, at = [], 0
    for small, raw in zip(flat[::2], flat[1::2]):
        frames.append((at, small, raw))
        at += small
    return frames


class _Bundle:
    """A bundle while it is written; ``index`` has its records' places."""

    def __init__(self, system, folder: str, frame_bytes: int):
        self.system, self.name, self.frame_bytes = system, f"{folder}/{uuid.uuid4().hex}.warc.zst", frame_bytes
        self.out, self.frames, self.index, self.held, self.raw, self.at = system.open_output_stream(self.name, compression=None), [], [], [], 0, 0

    def add(self, page_id, record: bytes) -> None:
        self.held.append((page_id, record))
        self.raw += len(record)
        if self.raw >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        frame = zstandard.ZstdCompressor(level=3).compress(b"".join(r for _, r in self.held))
        offset = 0
        for page_id, record in self.held:
            self.index.append((page_id, self.name, len(self.frames), self.at, len(frame), self.raw, offset, len(record)))
            offset += len(record)
        self.out.write(frame)
        self.frames.append((len(frame), self.raw))
        self.at += len(frame)
        self.held, self.raw = [], 0

    def close(self) -> pa.RecordBatch:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.index), INDEX_ARROW)], schema=INDEX_ARROW)


def _open_system(folder: str):
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("/") else fs.FileSystem.from_uri("/" + folder.split(":", 1)[1].lstrip("/"))


def write_archive(
    pages: DataFrame, folder: str | None = None, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 25,
    date: str = "1970-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", html: str = "html",
) -> DataFrame:
    """Writes a record per row to bundles in ``folder`` (by default a new one in the
    shared folder) and returns the index, itself a written table.

    Of rows with equal payloads the one with the largest ``page_id`` is a response
    and the others revisit it. Frames take about ``frame_bytes`` of records and
    bundles ``bundle_bytes``; a longer record makes a longer frame. Null html is an
    empty payload; empty payloads equal each other. A null url is left out. A null
    ``page_id`` is smaller than any other and is written as an empty identifier; if
    a payload has no other, its rows are responses. Rows that repeat the largest id
    are responses each. An empty table makes no bundle. Other columns are not read.
    """
    spark = pages.sparkSession
    small_batches(spark)
    target = folder or scratch(spark, "warc")
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"),
    )
    # equal payloads: SHA-1, which names them in the records, can be made to collide
    key = F.sha2("payload", 256)
    repeated = written(
        rows.groupBy(key.alias("sha")).agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where(F.col("n") > 1).select("sha", "response_id"), "payloads")
    told = rows.withColumn("sha", key).join(repeated, "sha", "left").select("page_id", "url", "payload", "response_id")

    def write(batches):
        system, path = _open_system(target)
        system.create_dir(path, recursive=True)
        bundle = size = None
        for batch in batches:
            for own, link, payload, response in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "response_id"))):
                record = encode_record(own, link, payload, response, response is None or own == response, date)
                if bundle is None:
                    bundle, size = _Bundle(system, path, frame_bytes), 0
                bundle.add(own, record)
                size += len(record)
                if size >= bundle_bytes:
                    yield bundle.close()
                    bundle = None
        if bundle is not None:
            yield bundle.close()

    return written(told.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def _records(bundles, whole: bool):
    for batch in bundles:
        for place in batch.column("place").to_pylist():
            system, path = _open_system(place)
            out = []
            with system.open_input_file(path) as handle:
                for at, small, raw in read_seek_table(handle):
                    handle.seek(at)
                    data = zstandard.ZstdDecompressor().decompress(handle.read(small), max_output_size=raw)
                    offset = 0
                    while offset < len(data):
                        record, offset = decode_record(data, offset)
                        if not whole:
                            record["payload"] = None
                        out.append(record)
                    if whole:
                        yield _frame(out)
                        out = []
            if out:
                yield _frame(out)


def _frame(records: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(records, schema=RECORD_ARROW)


def _places(index: DataFrame) -> DataFrame:
    spark = index.sparkSession
    scheme = F.lit(_scheme(spark))
    places = index.select(F.concat(scheme, "bundle").alias("place")).distinct()
    return places.repartition(max(1, places.count()), "place")  # few bytes each: not to be joined into one task


def _scheme(spark) -> str:
    """Bundle names have the path inside a file system; this is what goes in front."""
    from .shared import shared_folder
    folder = shared_folder(spark)
    return "" if folder.startswith("file:") or "://" not in folder else folder.split("://")[0] + "://"


def read_archive(index: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles that ``index`` names, frame by frame."""
    return _places(index).mapInArrow(lambda it: _records(it, payloads), RECORD_SCHEMA)


def fetch(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of ``ids`` (column ``page_id``), reading only their frames."""
    scheme = _scheme(index.sparkSession)

    def read(batches):
        for batch in batches:
            by_frame: dict[tuple, list] = {}
            for spot in batch.to_pylist():
                by_frame.setdefault((spot["bundle"], spot["frame_at"]), []).append(spot)
            for place, spots in by_frame.items():
                system, path = _open_system(scheme + place[0])
                with system.open_input_file(path) as handle:
                    handle.seek(place[1])
                    data = zstandard.ZstdDecompressor().decompress(handle.read(spots[0]["frame_size"]), max_output_size=spots[0]["frame_raw"])
                yield _frame([decode_record(data, spot["offset"])[0] for spot in spots])

    return index.join(ids.select("page_id").distinct(), "page_id", "left_semi").mapInArrow(read, RECORD_SCHEMA)
