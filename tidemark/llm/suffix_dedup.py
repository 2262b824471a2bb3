"""Removal of byte strings that an earlier document has too, found in suffix arrays.

Every window of 50 bytes has an anchor: the substring of 20 bytes in it with the smallest hash. Equal windows have equal
anchors, so a window can only repeat where its anchor does. Three passes over the stored texts use this:

1. Each chunk of documents sends the hashes of its anchors, sorted and compressed; what stands in one document only is done.
2. Around each remaining anchor, the stretch of text made of the windows that have it is sent, once per chunk. Stretches
   with the same anchor meet in one suffix array. A stack scan of its common-prefix intervals yields the repeats that cannot
   be extended to the left for all occurrences, with all their occurrences and the smallest document id among them.
3. Each chunk applies what came back to all places of its stretches.

Whole texts that repeat are found first by their digests; a copy is removed as it is and sends no stretches.

An anchor in very many documents would bring too many stretches together. Its windows are grouped one by one instead, by
128 bits of hash (the anchor's and their own), with partial sums before the shuffle and a join that adaptive execution can
split.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import scratch_path

LENGTH, ANCHOR = 50, 20
#: Windows that can share an anchor, and the longest stretch they make.
SPREAD = LENGTH - ANCHOR + 1
STRETCH = SPREAD + LENGTH - 1
#: An anchor in more documents than this is handled window by window.
HOT = 1 << 15
#: Rows of a chunk, anchors of a bucket (about), windows of one suffix array (about), bytes of text worked on at once.
CHUNK_BITS, BUCKET, TOGETHER, PIECE = 11, 1 << 18, 1 << 16, 1 << 23
#: Bits of an anchor's hash that are left out where chunks only ask which anchors are shared; who meets by chance is compared.
LEFT_OUT = np.uint64(16)
#: Ids must be whole numbers; null ids rank behind all others, and as equal.
LAST_ID = (1 << 63) - 1

BASE = 0x9E3779B97F4A7C15
LOW = np.uint64((1 << 24) - 1)


def substring_hashes(data: np.ndarray, length: int = ANCHOR) -> np.ndarray:
    """64-bit hash of every substring of the given length, by doubling."""
    n = len(data) - length + 1
    part, size, power, out, done = data.astype(np.uint64) + np.uint64(1), 1, BASE, None, 0
    while True:
        if length & size:  # append the block of this size to what is hashed so far
            block = part[length - done - size : length - done - size + n] if out is not None else part[length - size : length - size + n]
            out = block.copy() if out is None else block * np.uint64(pow(BASE, done, 1 << 64)) + out
            done += size
        if 2 * size > length:
            break
        part = part[:-size] * np.uint64(power) + part[size:]
        size, power = 2 * size, power * power % (1 << 64)
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(32)
    return out


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows by anchor: the anchor's hash, the first window and the end of the windows of each run that shares one."""
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(data) > PIECE:  # pieces share 49 bytes, so each window is in one of them
        parts = [(at, runs(data[at : at + PIECE])) for at in range(0, len(data) - LENGTH + 1, PIECE - LENGTH + 1)]
        return tuple(np.concatenate(x) for x in zip(*((h, a + at, b + at) for at, (h, a, b) in parts), strict=True))
    hashes = substring_hashes(data)
    # The smallest hash; of equal ones the leftmost, as the place stands in the low bits.
    least, size = (hashes & ~LOW) | np.arange(len(hashes), dtype=np.uint64), 1
    while 2 * size <= SPREAD:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < SPREAD:
        least = np.minimum(least[: size - SPREAD], least[SPREAD - size :])
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return hashes[(least[starts] & LOW).astype(np.int64)], starts, np.append(starts[1:], len(least))


def packed(values: np.ndarray) -> bytes:
    """Whole numbers compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.uint64)


def as_lists(rows: pa.RecordBatch | pa.Table) -> list[list]:
    """Columns as Python lists; numbers without nulls go by way of numpy, which is much faster."""
    plain = lambda c: c.null_count == 0 and (pa.types.is_integer(c.type) or pa.types.is_boolean(c.type))
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows.columns]
    return [c.to_numpy(zero_copy_only=False).tolist() if plain(c) else c.to_pylist() for c in columns]


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [np.frombuffer((t or "").encode("utf-8"), np.uint8) for t in column.to_pylist()]


def anchor_task(buckets: int):
    """Per chunk and bucket of hashes: the anchors of its documents and in how many of them each stands."""
    shift = np.uint64(64 - int(LEFT_OUT) - (buckets - 1).bit_length())
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(chunk: int, held: list[np.ndarray]) -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            bucket = hashes >> shift if buckets > 1 else np.zeros(len(hashes), np.uint64)
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(hashes)]
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    deltas = np.diff(hashes[a:b], prepend=np.uint64(0))
                    out.append({"bucket": int(bucket[a]), "chunk": chunk, "hashes": packed(deltas), "counts": packed(counts[a:b])})
            return pa.RecordBatch.from_pylist(out, schema=schema)

        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            chunks = batch.column(0).to_pylist()
            for chunk, data in zip(chunks, text_bytes(batch.column(1)), strict=True):
                found = np.unique(runs(data)[0] >> LEFT_OUT)
                if len(found):
                    held.setdefault(chunk, []).append(found)
            for chunk in [c for c in held if c != chunks[-1]]:
                yield rows(chunk, held.pop(chunk))
        for chunk, found in held.items():
            yield rows(chunk, found)

    return run


def share_bucket(rows: pa.Table, hot: int) -> pa.Table:
    """Of one bucket's anchors those in several documents, sent back to each chunk that has them; 1 marks hot ones."""
    lists = [np.cumsum(unpacked(b), dtype=np.uint64) for b in rows["hashes"].to_pylist()]
    counts = [unpacked(b).astype(np.int64) for b in rows["counts"].to_pylist()]
    every, place = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts))
    out, at = {"chunk": [], "anchors": [], "hot": []}, 0
    for chunk, own in zip(rows["chunk"].to_pylist(), lists, strict=True):
        n = total[place[at : at + len(own)]]
        at += len(own)
        if (n > 1).any():
            out["chunk"].append(chunk)
            out["anchors"].append(packed(np.diff(own[n > 1], prepend=np.uint64(0))))
            out["hot"].append(packed(n[n > 1] > hot))
    return pa.table([pa.array(out["chunk"], pa.int64()), pa.array(out["anchors"], pa.binary()), pa.array(out["hot"], pa.binary())], names=list(out))


def member(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether values are in a sorted table, and where."""
    if not len(table):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values, at


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def named(stretch: bytes) -> int:
    return signed(xxhash.xxh64_intdigest(stretch))


SENT = "chunk long, single boolean, anchor long, code long, stretch binary, least long, most long"


def copies_in(rows: pa.Table) -> dict[str, int]:
    """Digest of each text that repeats, and the smallest id that has it."""
    return {k: f for k, f in zip(rows["key"].to_pylist(), rows["first"].to_pylist(), strict=True) if k is not None}


def chunk_stretches(docs: pa.Table, shared: pa.Table) -> pa.Table:
    """The chunk's stretches around shared anchors, once each, with the smallest and largest id that has them.

    The windows of hot anchors are sent singly, by their hash.
    """
    found: dict[tuple[int, int | None, bytes | None], list[int]] = {}
    copies, blobs = copies_in(shared), shared.filter(pc.is_valid(shared["anchors"]))
    if blobs.num_rows:
        anchors = np.concatenate([np.cumsum(unpacked(b), dtype=np.uint64) for b in blobs["anchors"].to_pylist()])
        hot = np.concatenate([unpacked(b) for b in blobs["hot"].to_pylist()]) > 0
        order = np.argsort(anchors)
        anchors, hot = anchors[order], hot[order]
        for rank, key, data in zip(docs["rank"].to_pylist(), docs["key"].to_pylist(), text_bytes(docs["t"]), strict=True):
            if copies.get(key, LAST_ID) < rank:
                continue
            hashes, starts, ends = runs(data)
            known, at = member(hashes >> LEFT_OUT, anchors)
            raw = data.tobytes()
            for i in np.flatnonzero(known).tolist():
                start, end, anchor = int(starts[i]), int(ends[i]), signed(int(hashes[i]))
                if hot[at[i]]:
                    keys = [(anchor, named(raw[j : j + LENGTH]), None) for j in range(start, end)]
                else:
                    keys = [(anchor, None, raw[start : end + LENGTH - 1])]
                for key in keys:
                    ids = found.setdefault(key, [rank, rank])
                    ids[0], ids[1] = min(rank, ids[0]), max(rank, ids[1])
    chunk = docs["chunk"][0].as_py() if docs.num_rows else 0
    return pa.table(
        [
            pa.array([chunk] * len(found), pa.int64()),
            pa.array([stretch is None for _, _, stretch in found], pa.bool_()),
            pa.array([anchor for anchor, _, _ in found], pa.int64()),
            pa.array([code for _, code, _ in found], pa.int64()),
            pa.array([s for _, _, s in found], pa.binary()),
            pa.array([ids[0] for ids in found.values()], pa.int64()),
            pa.array([ids[1] for ids in found.values()], pa.int64()),
        ],
        names=[c.split()[0] for c in SENT.split(", ")],
    )


def maximal_repeats(stretches: list[bytes], firsts: list[int], length: int = LENGTH) -> Iterator[tuple[int, list[tuple[int, int]], int]]:
    """Repeats of at least ``length`` bytes: (size, occurrences as (stretch, offset), smallest first id).

    The suffixes that start a window are sorted with their common-prefix lengths. The stack scan meets every interval of
    suffixes with a longer common prefix than its surroundings; it is passed on unless all its suffixes are preceded by the
    same byte, as the repeat that starts there then has the same occurrences. A start of a stretch differs from any byte.
    """
    sizes = np.array([len(s) for s in stretches])
    windows = sizes - length + 1
    owner = np.repeat(np.arange(len(stretches)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    width = -(-int(sizes.max()) // 8) * 8
    text = np.frombuffer(b"".join(stretches) + bytes(width), np.uint8)
    begin = (np.cumsum(sizes) - sizes)[owner] + offset
    rest = sizes[owner] - offset
    suffixes = text[begin[:, None] + np.arange(width)]
    suffixes[np.arange(width) >= rest[:, None]] = 0
    order = np.lexsort(suffixes.view(">u8").T[::-1])
    ordered, rest = suffixes[order], rest[order]
    differ = ordered[1:] != ordered[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    owner, offset, begin = owner[order], offset[order], begin[order]
    before = np.where(offset > 0, text[np.maximum(begin - 1, 0)].astype(np.int64), -1 - np.arange(len(order)))
    close = np.flatnonzero(common >= length)
    if not len(close):
        return
    for group in np.split(close, np.flatnonzero(np.diff(close) > 1) + 1):
        start, end = int(group[0]), int(group[-1]) + 1
        places = list(zip(owner[start : end + 1].tolist(), offset[start : end + 1].tolist(), strict=True))
        lefts, depths = before[start : end + 1].tolist(), [*common[start:end].tolist(), 0]
        # Open intervals: depth, first suffix, smallest id, and the byte before all of them or None where they differ.
        stack: list[tuple[int, int, int, int | None]] = []
        for i, depth in enumerate(depths):
            here, first, left = i, firsts[places[i][0]], lefts[i]
            while stack and stack[-1][0] >= depth:
                top, at, top_first, top_left = stack.pop()
                first, left, here = min(first, top_first), left if left == top_left else None, at
                if top > depth:
                    if left is None:
                        yield top, places[at : i + 1], first
            if depth:
                stack.append((depth, here, first, left))


RESULT = "chunk long, single boolean, anchor long, code long, first long, parts binary"
RESULT_SCHEMA = pa.schema(
    [("chunk", pa.int64()), ("single", pa.bool_()), ("anchor", pa.int64()), ("code", pa.int64()), ("first", pa.int64()), ("parts", pa.binary())]
)


def repeats_of(rows: list[tuple]) -> pa.RecordBatch:
    """What each chunk has to know of its stretches: the smallest id that has all of it, or (offset, size, id) of parts of it."""
    number: dict[bytes, int] = {}
    firsts: list[int] = []
    for *_, stretch, least, _ in rows:
        if (i := number.setdefault(stretch, len(number))) == len(firsts):
            firsts.append(least)
        else:
            firsts[i] = min(least, firsts[i])
    parts: list[list[tuple[int, int, int]]] = [[] for _ in firsts]
    for size, places, first in maximal_repeats(list(number), firsts):
        for i, offset in places:
            if first < firsts[i]:  # else all of the stretch has the same first document
                parts[i].append((offset, size, first))
    out = []
    for chunk, single, anchor, stretch, _, most in rows:
        i = number[stretch]
        own = [p for p in parts[i] if p[2] < most]
        if own or firsts[i] < most:
            out.append((chunk, single, anchor, named(stretch), firsts[i], np.array(own, np.int64).tobytes() if own else None))
    columns = zip(*out, strict=True) if out else [()] * len(RESULT_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT_SCHEMA, strict=True)], schema=RESULT_SCHEMA)


def repeat_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor in; whole anchors are put into suffix arrays of about TOGETHER windows."""
    held: list[tuple] = []
    windows, last = 0, None
    for batch in batches:
        for row in zip(*as_lists(batch), strict=True):
            if row[2] != last and windows >= TOGETHER:
                yield repeats_of(held)
                held, windows = [], 0
            held.append(row)
            windows, last = windows + len(row[3]) - LENGTH + 1, row[2]
    if held:
        yield repeats_of(held)


OUT = (("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.string()))


def apply_repeats(docs: pa.Table, results: pa.Table) -> pa.Table:
    """The chunk's documents with what is removed from them."""
    copies, results = copies_in(results), results.filter(pc.is_null(results["key"])).drop_columns("key")
    known: dict[int, tuple] = {}
    hot: dict[int, dict[int, int]] = {}
    for _, single, anchor, code, first, parts in zip(*as_lists(results), strict=True):
        if single:
            hot.setdefault(anchor, {})[code] = first
        else:
            known[code] = (first, parts)
    anchors = np.unique(results["anchor"].to_numpy().astype(np.int64).view(np.uint64))
    out: dict[str, list] = {name: [] for name, _ in OUT}
    for rank, key, data in zip(docs["rank"].to_pylist(), docs["key"].to_pylist(), text_bytes(docs["t"]), strict=True):
        raw = data.tobytes()
        begun: list[int] = []
        ended: list[int] = []
        if copies.get(key, LAST_ID) < rank:
            begun, ended = [0], [len(data)]
        elif results.num_rows:
            hashes, starts, ends = runs(data)
            found, _ = member(hashes, anchors)
            for i in np.flatnonzero(found).tolist():
                start, end = int(starts[i]), int(ends[i]) + LENGTH - 1
                windows = hot.get(signed(int(hashes[i])))
                if windows is not None:
                    for j in range(start, end - LENGTH + 1):
                        if windows.get(named(raw[j : j + LENGTH]), LAST_ID) < rank:
                            begun.append(j)
                            ended.append(j + LENGTH)
                    continue
                first, parts = known.get(named(raw[start:end]), (LAST_ID, None))
                if first < rank:
                    begun.append(start)
                    ended.append(end)
                    continue
                for offset, size, first in np.frombuffer(parts or b"", np.int64).reshape(-1, 3).tolist():
                    if first < rank:
                        begun.append(start + offset)
                        ended.append(start + offset + size)
        n = len(data) + 1
        edges = np.bincount(np.array(begun, np.int64), minlength=n) - np.bincount(np.array(ended, np.int64), minlength=n)
        gone = np.cumsum(edges[:-1]) > 0
        turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        out["n_bytes"].append(len(data))
        out["n_removed"].append(int(gone.sum()))
        out["n_spans"].append(len(turns) // 2)
        out["kept_sha256"].append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
        out["spans"].append(",".join(f"{a}:{b}" for a, b in turns.reshape(-1, 2).tolist()))
    return pa.table([docs["id"].combine_chunks(), *(pa.array(out[name], kind) for name, kind in OUT)], names=["id", *(n for n, _ in OUT)])


def in_chunks(docs: DataFrame) -> DataFrame:
    """The documents, and the digests of texts that can repeat, stored in buckets by chunk, so that what is known of a chunk joins its texts without moving them."""
    spark = docs.sparkSession
    row = F.monotonically_increasing_id()
    chunk = F.shiftleft(F.shiftright(row, 33), 33 - CHUNK_BITS).bitwiseOR(F.shiftright(row.bitwiseAND(F.lit((1 << 33) - 1)), CHUNK_BITS))
    name, path = f"chunks_{uuid.uuid4().hex}", scratch_path(spark, "suffix-chunks")
    buckets = max(2, docs.rdd.getNumPartitions())
    key = F.when(F.octet_length("t") >= LENGTH, F.md5("t"))
    docs.withColumns({"chunk": chunk, "key": key}).write.bucketBy(buckets, "chunk").option("compression", "zstd").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def remove_earlier_strings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", hot: int = HOT) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and spans (removed bytes, ``start:end``).

    A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a row with a smaller id, judged on the
    texts as given. Rows of equal id remove nothing from each other; null ids rank last and as equal; null texts are empty.
    Repeated rows are carried through. Other columns are ignored.
    """
    rank = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST_ID))
    kind = docs.schema[id_column].dataType.simpleString()
    rows = in_chunks(docs.select(F.col(id_column).alias("id"), rank.alias("rank"), F.col(text_column).alias("t")))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = 1 << max(0, (size * 2 // (SPREAD + 1) // BUCKET).bit_length())
    anchors = rows.select("chunk", "t").mapInArrow(anchor_task(buckets), "bucket int, chunk long, hashes binary, counts binary")
    shared = stored(anchors.groupBy("bucket").applyInArrow(lambda t: share_bucket(t, hot), "chunk long, anchors binary, hot binary"), "suffix-shared")

    texts = rows.where("key IS NOT NULL").select("chunk", "key", "rank")
    least = texts.groupBy("key").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    least = stored(least.where("first < last").select("key", "first"), "suffix-texts")
    copies = texts.join(least, "key").where("rank > first").select("chunk", "key", "first").distinct()
    copies = stored(copies, "suffix-copies")

    def with_texts(other: DataFrame, function, schema: str) -> DataFrame:
        return rows.groupBy("chunk").cogroup(other.groupBy("chunk")).applyInArrow(function, schema)

    known = shared.unionByName(copies, allowMissingColumns=True)
    sent = with_texts(known, chunk_stretches, SENT)
    near = stored(sent, "suffix-stretches")
    met = near.where("NOT single").drop("code").repartition("anchor").sortWithinPartitions("anchor")
    results = met.mapInArrow(repeat_task, RESULT)
    single = near.where("single")
    first = stored(single.groupBy("anchor", "code").agg(F.min("least").alias("first")), "suffix-windows")
    windows = single.join(first, ["anchor", "code"]).where("first < most").select(
        "chunk", "single", "anchor", "code", "first", F.lit(None).cast("binary").alias("parts")
    )
    out_schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string"
    results = results.union(windows).unionByName(copies, allowMissingColumns=True)
    return with_texts(results, apply_repeats, out_schema).withColumnRenamed("id", id_column)
