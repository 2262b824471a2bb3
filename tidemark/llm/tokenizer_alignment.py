"""Aligning the tokens of two tokenizers over a corpus, each distinct text once.

Rows are exchanged by their full text and merged there, with the number of their copies. Each distinct text is tokenised by
a byte-level BPE (A) and a piece BPE (B) and aligned over its bytes. Both token sequences cut the same bytes, so the union
of their ends cuts the text into stretches that lie in one token of each: these stretches are the links. Ends that both
have cut the text into groups.

How often a pair of ids is linked is a count over the corpus, weighted by the copies, and the measures of a text need the
counts of its pairs. Texts are kept in chunks of about ``CHUNK_BYTES``; a chunk asks once for each of its distinct pairs,
so that what meets the counts is a small share of the links. The measures are then joined to the ids over the text digests.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Where the two vocabulary files are; a parameter of ``align_tokens``.
FILES = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")
#: Vocabularies go to the tasks as they are; larger files are refused.
MOST_FILE_BYTES = 64 * 1024 * 1024
#: How the byte-level tokenizer splits text before its merges (fixed value of its public vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Decimal digits of the largest id.
WIDTH = 5
#: UTF-8 bytes of text that are aligned and stored together; a single text may be longer.
CHUNK_BYTES = 4 * 1024 * 1024
#: Long texts are tokenised in segments of about this many characters, cut where neither tokenizer has a token across.
SEGMENT = 1 << 18

CHUNK = "chunk long, pairs binary, weights binary, entries binary, texts binary, names string"
MEASURES = "digest string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def read_file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file of bounded size, from the driver's disk or any store that Spark reads."""
    if "://" in path:
        content = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        content = Path(path).read_bytes()
    if len(content) > MOST_FILE_BYTES:
        raise ValueError(f"{path} has {len(content)} bytes, more than {MOST_FILE_BYTES}")
    return content


class ByteTokens:
    """Byte-level BPE of a ``tokenizers`` file, run by ``tiktoken``.

    The file must have its pieces in the order of its merges, so that an id is a merge's rank, and split text as ``SPLIT``.
    """

    def __init__(self, file: bytes):
        parts = json.loads(file)
        # Printable Latin-1 characters stand for their own byte, the others for characters from 256 on, in their order.
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in own]
        byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["id"] for t in parts["added_tokens"]}
        ranks = {bytes(byte[c] for c in entry): i for entry, i in parts["model"]["vocab"].items() if i not in special}
        merges = [m if isinstance(m, str) else " ".join(m) for m in parts["model"]["merges"]]
        if [parts["model"]["vocab"][m.replace(" ", "")] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("the pieces of the byte-level file are not in the order of its merges")
        self.encoding = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.content = [b""] * (max(ranks.values()) + 1)
        for entry, i in ranks.items():
            self.content[i] = entry

    def encode(self, segment: str) -> list[int]:
        return self.encoding.encode_ordinary(" " + segment)


class PieceTokens:
    """Piece BPE with byte fallback; the model adds the leading space itself."""

    def __init__(self, file: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        self.content = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            spelled = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode("utf-8")
            self.content.append(spelled)

    def encode(self, segment: str) -> list[int]:
        return self.model.encode(segment)


@functools.lru_cache(maxsize=1)
def vocabularies(file_a: bytes, file_b: bytes) -> tuple[ByteTokens, PieceTokens]:
    return ByteTokens(file_a), PieceTokens(file_b)


def segments(text: str) -> list[str]:
    """The text without the spaces at which it is cut: single ones between letters, where both start a token."""
    found, start = [], 0
    while len(text) - start > SEGMENT:
        at = text.find(" ", start + SEGMENT)
        while at >= 0 and not (text[at - 1].isalpha() and text[at + 1 : at + 2].isalpha()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        found.append(text[start:at])
        start = at + 1
    return [*found, text[start:]]


def tokenised(text: str, vocabulary: ByteTokens | PieceTokens) -> np.ndarray:
    """Ids of a text; none where their bytes are not those of a space and the text."""
    ids = [i for s in segments(text) for i in vocabulary.encode(s)] if text else []
    same = b"".join(map(vocabulary.content.__getitem__, ids)) == b" " + text.encode("utf-8")
    return np.array(ids if same else [], np.int32)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of small numbers as one zstd frame, low bytes together."""
    parts = [len(a).to_bytes(8, "little") + a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return zstandard.compress(b"".join(parts), 3)


def unpacked(data: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(data), 0, []
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        planes = np.frombuffer(data, np.uint8, 4 * n, at + 8).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64))
        at += 8 + 4 * n
    return out


def group_digests(ids: list[np.ndarray], ends: list[np.ndarray], sizes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Digest of the groups of each text, and their number. ``ends``: in bytes, over the texts one after the other.

    Every token is written with the mark that follows it, A's and B's tokens of a group one after the other.
    """
    both = np.sort(np.concatenate(ends), kind="stable")  # two sorted runs
    common = both[1:][np.diff(both) == 0]
    cuts = [np.searchsorted(e, common) + 1 for e in ends]
    n = [len(i) for i in ids]
    # Place of each token in the text of groups: after the tokens of both sides in the groups before, B's after A's.
    groups = [np.searchsorted(c, np.arange(m), side="right") for c, m in zip(cuts, n, strict=True)]
    starts = [np.concatenate([[0], c]) for c in cuts]
    places = [np.arange(n[0]) + starts[1][groups[0]], np.arange(n[1]) + starts[0][groups[1] + 1]]
    tokens, marks = np.zeros(sum(n), np.int64), np.full(sum(n), ord(","), np.uint8)
    for i, at, c, mark in zip(ids, places, cuts, "|;", strict=True):
        tokens[at] = i
        marks[at[c - 1]] = ord(mark)
    # Decimal digits as a table of bytes, unused places dropped.
    digits = np.zeros((len(tokens), WIDTH + 1), np.uint8)
    rest = tokens.copy()
    for k in range(WIDTH - 1, -1, -1):
        digits[:, k] = np.where((rest > 0) | (k == WIDTH - 1), rest % 10 + ord("0"), 0)
        rest //= 10
    digits[:, WIDTH] = marks
    used = digits != 0
    written = digits[used].tobytes()
    of_text = np.searchsorted(common, np.cumsum(sizes), side="right")
    token_ends = (starts[0] + starts[1])[of_text]  # tokens of both sides up to the end of each text
    byte_ends = np.concatenate([[0], np.cumsum(used.sum(axis=1))])[token_ends].tolist()
    digests = [
        hashlib.sha256(memoryview(written)[a : b - 1]).hexdigest() if b > a else ""
        for a, b in zip([0, *byte_ends], byte_ends, strict=False)
    ]
    return digests, np.diff(of_text, prepend=0)


def aligned_chunk(chunk: int, rows: list[tuple[str, str, int]], vocabulary: tuple[ByteTokens, PieceTokens]) -> dict:
    """One stored row for texts given as (digest, text, copies).

    ``pairs`` are the distinct id pairs (A << 16 | B), sorted, ``weights`` how often the copies of the chunk's texts link them,
    ``entries`` the pairs of each text by rank with their numbers, ``texts`` the measures that need no counts, ``names`` the digests of the texts and of their groups.
    """
    digests, texts, copies = (list(c) for c in zip(*rows, strict=True))
    both = [[tokenised(t, v) for t in texts] for v in vocabulary]
    whole = [len(a) > 0 and len(b) > 0 for a, b in zip(*both, strict=True)]
    sizes = np.array([len(t.encode("utf-8")) + 1 if w else 0 for t, w in zip(texts, whole, strict=True)], np.int64)
    none = np.zeros(0, np.int32)
    each = [[x if w else none for x, w in zip(ids, whole, strict=True)] for ids in both]
    ids = [np.concatenate(x).astype(np.int64) for x in each]
    ends = [np.cumsum(np.array([len(b) for b in v.content])[i]) for v, i in zip(vocabulary, ids, strict=True)]
    shas, n_groups = group_digests(ids, ends, sizes)

    cuts = np.sort(np.concatenate(ends), kind="stable")  # two sorted runs
    cuts = cuts[np.diff(cuts, prepend=0) > 0]
    link = ids[0][np.searchsorted(ends[0], cuts)] << 16 | ids[1][np.searchsorted(ends[1], cuts)]
    text = np.searchsorted(np.cumsum(sizes), cuts)
    pairs, rank = np.unique(link, return_inverse=True)
    entry, number = np.unique(text << 32 | rank, return_counts=True)
    owner, rank = entry >> 32, entry & 0xFFFFFFFF
    weights = np.zeros(len(pairs), np.int64)
    np.add.at(weights, rank, number * np.array(copies, np.int64)[owner])
    per_text = np.bincount(owner, minlength=len(rows))
    first = np.ones(len(rank), bool)
    first[1:] = owner[1:] != owner[:-1]
    steps = np.where(first, rank, np.diff(rank, prepend=0))
    measures = [np.array([len(x) for x in e]) for e in each] + [n_groups, np.bincount(text, minlength=len(rows))]
    return {
        "chunk": chunk,
        "pairs": packed(np.diff(pairs, prepend=0)),
        "weights": zstandard.compress(weights.astype("<i8").tobytes(), 3),
        "entries": packed(per_text, steps, number),
        "texts": packed(*measures),
        "names": "".join(d + (s or "-" * 64) for d, s in zip(digests, shas, strict=True)),
    }


def align_task(file_a: bytes, file_b: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, t, copies) in, chunks out."""
    vocabulary = vocabularies(file_a, file_b)
    held, size, done = [], 0, TaskContext.get().partitionId() << 32

    def flushed() -> pa.RecordBatch:
        row = aligned_chunk(done, held, vocabulary)
        kinds = {"chunk": pa.int64(), "names": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()], names=list(row))

    for batch in batches:
        for digest, text, copies in zip(*(batch.column(n).to_pylist() for n in ("digest", "t", "copies")), strict=True):
            held.append((digest, text, copies))
            size += len(text)
            if size >= CHUNK_BYTES:
                yield flushed()
                held, size, done = [], 0, done + 1
    if held:
        yield flushed()


def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each chunk with their weights."""
    for batch in batches:
        for row in batch.to_pylist():
            pairs = np.cumsum(unpacked(row["pairs"])[0])
            weights = np.frombuffer(zstandard.decompress(row["weights"]), "<i8")
            for start in range(0, len(pairs), 1 << 16):
                part = pairs[start : start + (1 << 16)]
                columns = [np.full(len(part), row["chunk"], np.int64), part, weights[start : start + (1 << 16)]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "pair", "weight"])


def measured(key: tuple, chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """Measures of the texts of one chunk from the counts of its pairs."""
    rows = chunk.to_pylist()
    out: dict[str, list] = {f.split()[0]: [] for f in MEASURES.split(", ")}
    pair = counts.column("pair").to_numpy()
    order = np.argsort(pair)
    pair, n, best = (counts.column(c).to_numpy()[order] for c in ("pair", "n", "best"))
    for row in rows:
        n_a, n_b, n_groups, n_links = unpacked(row["texts"])
        names = row["names"]
        per_text, steps, number = unpacked(row["entries"])
        pairs = np.cumsum(unpacked(row["pairs"])[0])
        if not np.array_equal(pairs, pair):
            raise ValueError("a chunk did not get the counts of all its pairs")
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        total = np.concatenate([[0], np.cumsum(steps)])
        rank = total[1:] - np.repeat(total[bounds[:-1]], per_text)
        for name, values in (("n_best", best[rank].astype(np.int64) * number), ("count_sum", n[rank] * number)):
            sums = np.concatenate([[0], np.cumsum(values)])
            out[name] += (sums[bounds[1:]] - sums[bounds[:-1]]).tolist()
        for name, values in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links)):
            out[name] += values.tolist()
        out["digest"] += [names[i : i + 32] for i in range(0, len(names), 96)]
        out["groups_sha256"] += [names[i + 32 : i + 96].replace("-", "") for i in range(0, len(names), 96)]
    kinds = {"digest": pa.string(), "groups_sha256": pa.string()}
    return pa.table({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})


def align_tokens(docs: DataFrame, files: tuple[str, str] = FILES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the id, n_a and n_b (tokens), n_groups, n_links, n_best (links whose pair is the most frequent
    one of its B id in the corpus, ties included), count_sum (corpus counts of the links' pairs, added up), groups_sha256.

    Tokens are those of a space and the text. Texts that are null or empty, or whose tokens do not spell these bytes, have no
    tokens: zeros and an empty digest; they add nothing to the counts. Copies count as often as they occur. Repeated rows and
    null ids are kept; an empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(tuple(read_file(spark, f) for f in files))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return align_task(*vocabulary.value, batches)

    text = F.coalesce(F.col(text_column), F.lit(""))
    distinct = docs.select(text.alias("t")).groupBy("t").agg(F.count("*").alias("copies")).withColumn("digest", F.md5("t"))
    chunks = stored(distinct.mapInArrow(align, CHUNK), "aligned-chunks")

    pairs = chunks.select("chunk", "pairs", "weights").mapInArrow(asked, "chunk long, pair long, weight long")
    counts = pairs.groupBy("pair").agg(F.sum("weight").alias("n"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFF)))
    counts = stored(counts.withColumn("best", F.col("n") == F.max("n").over(of_b)), "aligned-counts")

    answers = pairs.select("chunk", "pair").join(counts, "pair").select("chunk", "pair", "n", "best")
    measures = (
        chunks.select("chunk", "pairs", "entries", "texts", "names")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(measured, MEASURES)
    )
    names = docs.select(F.col(id_column).alias("id"), F.md5(text).alias("digest"))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return names.join(stored(measures, "aligned-measures"), "digest").select(F.col("id").alias(id_column), *columns)
