"""SimHash near-duplicates: fingerprints of three-word shingles, compared as vertical bit planes.

Fingerprints within the radius agree on at least two of five bit blocks, so every such pair meets in one of ten tables.
Fingerprints that meet are compared as bit planes: plane k holds bit k of 64 fingerprints per machine word. A query is
XORed with a plane, and the differing bits are added to carry-save counters of all fingerprints at once; a query leaves as
soon as every counter has passed the radius. Only a spanning forest of the links found together is passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, stored
from tidemark.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Five blocks cover the 64 bits; three differing bits leave two of them equal.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
PAIRS = tuple(combinations(BLOCKS, len(BLOCKS) - RADIUS))
#: A bucket with more fingerprints is split into pairs of parts of about this size; no pair is lost.
PART = 8192
#: Small buckets are compared together in blocks of about this many fingerprints, so many queries at a time.
TOGETHER, QUERIES = 1024, 256


def fingerprint(text: str) -> int:
    """Unsigned 64-bit SimHash: a bit is set where over half of the shingle hashes have it."""
    words = text.encode("utf-8").lower().split()  # bytes: only A-Z change, only the six ASCII blanks separate
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n, counts = len(words) - SHINGLE + 1, np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        part = words[start : start + (1 << 16) + SHINGLE - 1]
        shingles = map(b" ".join, zip(part, part[1:], part[2:], strict=False))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * counts > n).tolist())


def fingerprint_columns(columns: dict, text_column: str) -> dict:
    prints = [fingerprint(text or "") for text in columns.pop(text_column)]
    return columns | {"print": [p - (1 << 64) if p >> 63 else p for p in prints]}


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, print): the fingerprint of every row as a signed long; null texts have fingerprint 0."""
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
    return map_columns(rows, fingerprint_columns, f"id {kind}, print long", "t")


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 planes of one bit per fingerprint, 64 fingerprints in a word."""
    padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near(planes: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(queries still in, their words): bit j of a row is set where fingerprint j is within the radius of the query."""
    width = max(1, int(radius).bit_length())
    active = np.arange(len(queries))
    over = np.zeros((len(queries), planes.shape[1]), np.uint64)
    counters = [np.zeros_like(over) for _ in range(width)]
    for k in range(64):
        flip = np.uint64(0) - ((queries >> np.uint64(k)) & np.uint64(1))
        carry = planes[k][None, :] ^ flip[:, None]
        for counter in counters:
            both = counter & carry
            counter ^= carry
            carry = both
        over |= carry
        if k % 8 == 7:
            stay = (over != np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1)
            if not stay.all():
                active, queries, over = active[stay], queries[stay], over[stay]
                counters = [c[stay] for c in counters]
                if not len(active):
                    break
    # Counters that did not overflow hold the distance; it is compared with the radius from the highest bit down.
    above, equal = np.zeros_like(over), ~np.zeros_like(over)
    for bit, counter in reversed(list(enumerate(counters))):
        if radius >> bit & 1:
            equal &= counter
        else:
            above |= equal & counter
            equal &= ~counter
    return active, ~(over | above)


def forest(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect all fingerprints linked within the radius: at most one fewer than there are fingerprints."""
    prints = np.unique(prints)
    planes, label, links = bit_planes(prints), np.arange(len(prints)), []
    for start in range(0, len(prints), QUERIES):
        active, words = near(planes, prints[start : start + QUERIES], radius)
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")[:, : len(prints)]
        for q, row in zip((active + start).tolist(), bits, strict=True):
            found = np.flatnonzero(row)
            other, first = np.unique(label[found], return_index=True)
            new = other != label[q]
            if new.any():
                links += [(int(prints[q]), int(prints[j])) for j in found[first[new]]]
                label[np.isin(label, other)] = label[q]
    return links


def link_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by bucket in; links out. A bucket is never torn apart, small ones are compared together."""

    def linked(parts: list[np.ndarray]) -> pa.RecordBatch:
        links = forest(np.concatenate(parts).view(np.uint64)) if parts else []
        ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    held, size, last = [], 0, None  # fingerprints not yet compared, and the bucket that the newest belong to
    for batch in batches:
        if not batch.num_rows:
            continue
        buckets = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
        prints = batch.column(3).to_numpy()
        starts = [0, *(np.flatnonzero((buckets[1:] != buckets[:-1]).any(axis=1)) + 1).tolist()]
        for start, end in zip(starts, [*starts[1:], len(prints)], strict=True):
            bucket = tuple(buckets[start])
            if bucket != last and size >= TOGETHER:
                yield linked(held)
                held, size = [], 0
            held.append(prints[start:end])
            size, last = size + end - start, bucket
    yield linked(held)


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs of distinct ``print`` values within the radius."""
    keys = []
    for i, blocks in enumerate(PAIRS):
        key = F.lit(i).cast("long")
        for at, width in blocks:
            bits = F.shiftrightunsigned("print", at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(bits)
        keys.append(key)
    rows = prints.select("print", F.explode(F.array(*keys)).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    parts = F.ceil(F.col("size") / PART).cast("int")
    own = F.pmod(F.hash("print"), F.col("parts"))
    met = rows.join(stored(sizes, "simhash-buckets"), "bucket").withColumn("parts", parts)
    met = met.select("bucket", "print", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    met = met.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "print")
    met = met.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return met.mapInArrow(link_task, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits) and component_id, the smallest id it can reach over links.

    Fingerprints link at ``RADIUS`` or fewer differing bits; equal ones always do, those of empty and null texts (0) too.
    Rows with equal fingerprints are merged before anything is compared. Repeated rows and ids are kept; null ids are never
    the smallest, and a component without any id has a null component_id. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, id_column, text_column), "simhash-prints")
    distinct = stored(prints.groupBy("print").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("print"))).select(F.col("node").alias("print"), "root")
    linked = stored(distinct.join(roots, "print"), "simhash-linked")
    best = stored(linked.groupBy("root").agg(F.min("least").alias("best")), "simhash-best")
    known = stored(linked.join(best, "root").select("print", "best"), "simhash-known")
    known = stored(
        distinct.join(known, "print", "left").select("print", F.coalesce("best", "least").alias("component_id")), "simhash-classes"
    )
    return prints.join(known, "print").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
