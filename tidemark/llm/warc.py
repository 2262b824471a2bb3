"""WARC archives in Zstandard: written with a dictionary and one frame per record, and read back frame by frame.

An archive starts with a skippable frame that holds the dictionary, as in public ``.warc.zst`` files. Archives are written
by tasks into a shared folder under names of their own; the table of archives returned by the writer names only those of
successful tasks, so files of lost attempts are never read. The reader streams: a task holds one record at a time.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import scratch_path

#: Fixed values of the archive format.
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads below this size are never revisits.
LEAST_REVISIT_BYTES = 1000
#: A task starts another archive beyond this size.
ARCHIVE_BYTES = 64 * 1024 * 1024
#: The dictionary is trained on at most so many payloads, so many bytes of each; it affects sizes only.
DICTIONARY_SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 500, 8192, 32 * 1024
READ_BYTES = 1024 * 1024

RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, "
    "payload binary, archive string, error string"
)


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def train_dictionary(pages: DataFrame, payload: str) -> bytes:
    """A Zstandard dictionary from a bounded sample of payloads; empty if there is too little text to train on."""
    rows = pages.select(F.substring(payload, 1, SAMPLE_BYTES).alias("p")).where("length(p) > 0").limit(DICTIONARY_SAMPLES)
    samples = [bytes(r["p"]) for r in rows.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record_bytes(page: dict) -> bytes:
    """One WARC record: the response with its payload, or a revisit with the HTTP head only."""
    revisit = page["refers_to"] is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['n']}\r\n\r\n".encode()
    block = http if revisit else http + page["payload"]
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{page['digest']}",
        f"X-Payload-Length: {page['n']}",
    ]
    if page["url"]:
        head.append("WARC-Target-URI: " + "".join(page["url"].split()))
    if page["page_id"] is not None:
        head.append(f"X-Page-ID: {page['page_id']}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {page['refers_to']}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_task(folder: str, dictionary: bytes):
    """The function of a writing task: pages in, one row per finished archive out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = located(folder)
        store.create_dir(root, recursive=True)
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
        out, name, size, count = None, "", 0, 0

        def finished() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [count], "bytes": [size]})

        for batch in batches:
            for page in batch.to_pylist():
                if out is None:
                    name, count = f"{uuid.uuid4().hex}.warc.zst", 0
                    out = store.open_output_stream(f"{root}/{name}")
                    first = struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary if dictionary else b""
                    out.write(first)
                    size = len(first)
                size += out.write(frame := pack.compress(record_bytes(page))) or len(frame)
                count += 1
                if size >= ARCHIVE_BYTES:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return run


def write_archives(pages: DataFrame, folder: str | None = None, least_revisit_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) and return the table of archives.

    The payload is the html in UTF-8, empty for null. Of the rows with equal payloads of at least ``least_revisit_bytes``
    the one with the largest page_id is the response and the others refer to it; rows that tie at the largest page_id are
    all responses. Null page_ids rank lowest, a group without any page_id has responses only. Other columns are ignored,
    an empty table gives no archive. Rows of a payload that is very common are split over tasks by the skewed join.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "n": F.octet_length("payload").cast("long")})
    large = rows.where(F.col("n") >= least_revisit_bytes).groupBy("digest")
    shared = large.agg(F.max("page_id").alias("target"), F.count("*").alias("rows")).where("rows > 1")
    targets = stored(shared.select("digest", "target"), "warc-targets")
    other = (F.col("page_id") != F.col("target")) | (F.col("page_id").isNull() & F.col("target").isNotNull())
    records = rows.join(targets, "digest", "left").select(
        "page_id", "url", "payload", "digest", "n", F.when(other, F.col("target")).alias("refers_to")
    )
    archives = records.mapInArrow(write_task(folder, train_dictionary(rows, "payload")), "archive string, records long, bytes long")
    return stored(archives, "warc-archives")


def frames(stream, dictionary: bytes, first: bytes) -> Iterator[bytes]:
    """Contents of the frames of a stream, one by one; a frame cut short raises."""
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    rest = first
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        unpack = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
        parts = []
        while True:
            parts.append(unpack.decompress(rest))
            if unpack.eof:
                rest = unpack.unused_data
                break
            rest = stream.read(READ_BYTES)
            if not rest:
                raise ValueError("the last frame is cut short")
        yield b"".join(parts)


def opened(stream) -> tuple[bytes, bytes]:
    """The dictionary in the leading skippable frame, empty if there is none, and the bytes read beyond it."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE:
        return b"", head
    size = struct.unpack("<I", head[4:])[0]
    dictionary = stream.read(size)
    if len(dictionary) != size:
        raise ValueError("the dictionary is cut short")
    if dictionary[:4] == ZSTD_MAGIC:
        dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
    return dictionary, b""


def parsed(record: bytes) -> dict:
    """The fields of one record; raises ValueError where headers and lengths do not agree."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        raise ValueError("no record header")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"not a header field: {line[:80]}")
        fields[key.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(fields)
    if missing:
        raise ValueError(f"missing header fields: {', '.join(sorted(missing))}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes instead of {length}")
    number = lambda key: int(fields[key]) if key in fields else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    out = {
        "page_id": number("x-page-id"),
        "payload_bytes": number("x-payload-length"),
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": number("x-refers-to-page-id"),
        "target_uri": fields.get("warc-target-uri"),
        "payload": None,
    }
    if fields["warc-type"] == "response":
        payload = rest[:length].partition(b"\r\n\r\n")[2]
        found = hashlib.sha1(payload, usedforsecurity=False).hexdigest()
        if digest is not None and digest != found:
            raise ValueError("the payload does not have the digest of its header")
        if out["payload_bytes"] not in (None, len(payload)):
            raise ValueError("the payload does not have the length of its header")
        out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": found}
    return out


def read_task(with_payload: bool):
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORDS.split(", ")])

    def rows(archive: str) -> Iterator[dict]:
        store, path = located(archive)
        try:
            with store.open_input_stream(path) as stream:
                for frame in frames(stream, *opened(stream)):
                    try:
                        yield parsed(frame)
                    except (ValueError, UnicodeDecodeError) as e:
                        yield {"error": str(e)}
        except (ValueError, zstandard.ZstdError) as e:
            yield {"error": str(e)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                held, size = [], 0
                for row in rows(archive):
                    if not with_payload:
                        row["payload"] = None
                    held.append({name: row.get(name) for name in names} | {"archive": archive})
                    size += len(row.get("payload") or b"") + 200
                    if size > READ_BYTES * 8:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    return run


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives named in the column ``archive``: one row per record.

    A record whose headers, lengths or digest do not agree gives a row with ``error`` set and no other field; what follows a
    frame that cannot be decoded is reported once. Each archive is read by one task, which holds one record at a time.
    """
    spark = archives.sparkSession
    # One row is 64 MB of work here, so rows are dealt out singly.
    spread = archives.select("archive").repartition(max(spark.sparkContext.defaultParallelism, 2))
    return spread.mapInArrow(read_task(with_payload), RECORDS)
