"""Benchmark decontamination: rare word triples lead from documents to test items, alignment decides.

Triples of words that occur in any item are found in all documents, and counted there. The rarer half of an item's triples,
all that are rare outright, and the rarest of each run of LEAST_RUN words are its seeds, so no run of that length is without
one. Where a seed stands in a document, the words around it are aligned with the item by Smith-Waterman, so that copies with
changed, missing or added words are scored too. Parts of long items count by what they hold, not by their share of the item.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, stored

SEED = 3
#: A triple found in no more documents than this is a seed whatever the item's others are.
RARE_DOCUMENTS = 10
#: Alignment scores, and the share of the best possible score that makes a copy.
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SIMILARITY = 0.5
#: Of whatever item, a part makes a copy with this many words in a row, or with the score of this many matching words.
LEAST_RUN, LEAST_MATCHED = 13, 50
#: Alignments start within a step of where a seed says, give or take a share of the item's length.
STEP, SLACK = 8, 0.25
#: Bits of the filter that is sent to all tasks; its size is fixed. What it lets pass by chance, the exact join drops.
FILTER_BITS = 1 << 22
#: Alignments computed together, and the largest number of cells of their rows.
TOGETHER, CELLS = 256, 1 << 18

WORD = re.compile(r"\w+")


class Codes(dict):
    """Hash of each word, kept for the next time."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


CODES = Codes()


def word_codes(text: str) -> np.ndarray:
    words = WORD.findall(text.lower())
    return np.fromiter(map(CODES.__getitem__, words), np.uint64, len(words))


def seeds_of(codes: np.ndarray) -> np.ndarray:
    """Hash of each run of SEED words."""
    n = len(codes) - SEED + 1
    if n < 1:
        return np.zeros(0, np.int64)
    out = codes[:n].copy()
    for i in range(1, SEED):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[i : n + i]
    out ^= out >> np.uint64(29)
    return (out * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def item_columns(columns: dict) -> dict:
    codes = [word_codes(t or "") for t in columns.pop("t")]
    grams = [seeds_of(c) for c in codes]
    return columns | {"words": [c.view(np.int64) for c in codes], "grams": grams}


def hit_task(allowed):
    """Per document, a row for each triple that the filter lets pass, with its places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(allowed.value, np.uint8)
        for batch in batches:
            ids, key, grams, places, owner = batch.column(0), batch.column(1), [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                if not text:
                    continue
                found = seeds_of(word_codes(text))
                slot = found & (FILTER_BITS - 1)
                at = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                if len(at):
                    kinds, place = np.unique(found[at], return_inverse=True)
                    order = np.argsort(place, kind="stable")
                    grams.append(kinds)
                    places += np.split(at[order], np.cumsum(np.bincount(place))[:-1])
                    owner += [i] * len(kinds)
            if owner:
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owner)), key.take(pa.array(owner)), pa.array(np.concatenate(grams)), pa.array(places, pa.list_(pa.int64()))],
                    names=["id", "key", "gram", "places"],
                )

    return run


def region_columns(columns: dict) -> dict:
    """For each document and item, the stretches of words to align."""
    out: dict[str, list] = {k: [] for k in ("id", "item", "words", "starts", "ends")}
    for doc, text, found in zip(columns["id"], columns["t"], columns["found"], strict=True):
        spans = [(m.start(), m.end()) for m in WORD.finditer(text.lower())] if len(text.lower()) == len(text) else None
        codes = word_codes(text)
        if spans is None:  # lower-casing changed the length: words of the original text, in the same order
            spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
            spans += [(len(text), len(text))] * (len(codes) - len(spans))
        for one in found:
            slack = int(SLACK * one["length"]) + STEP
            stretch: list[list[int]] = []
            for step in sorted(one["steps"]):
                low, high = max(0, step * STEP - slack), min(len(codes), (step + 1) * STEP + one["length"] + slack)
                if stretch and low <= stretch[-1][1]:
                    stretch[-1][1] = max(high, stretch[-1][1])
                else:
                    stretch.append([low, high])
            for low, high in stretch:
                out["id"].append(doc)
                out["item"].append(one["item"])
                out["words"].append(codes[low:high].view(np.int64))
                out["starts"].append([s for s, _ in spans[low:high]])
                out["ends"].append([e for _, e in spans[low:high]])
    return out


def alignment_ends(items: list[np.ndarray], stretches: list[np.ndarray]) -> np.ndarray:
    """For each pair and each word of its stretch, the best local alignment that ends there: the score in the upper 32 bits,
    below it the distance of the start from the end of the table, so of equal scores the earlier start is larger.

    All pairs advance together, one word of the items at a time. Gaps along the stretch come from a running maximum.
    """
    n, width, height = len(items), max(map(len, stretches)), max(map(len, items))
    long, short = np.full((n, width), -1, np.int64), np.full((n, height), -2, np.int64)
    for i, (item, stretch) in enumerate(zip(items, stretches, strict=True)):
        long[i, : len(stretch)] = stretch
        short[i, : len(item)] = item
    inside = np.arange(width) < np.array([len(s) for s in stretches])[:, None]
    here = np.arange(width, dtype=np.int64)
    unit, start = np.int64(1) << 32, width - here  # an alignment that starts at word j carries width - j
    row, ends = np.tile(start, (n, 1)), np.zeros((n, width), np.int64)
    lengths = np.array([len(s) for s in items])
    for k in range(height):
        same = (long == short[:, k : k + 1]) & inside
        before = np.empty_like(row)
        before[:, 0] = start[0]
        # The cell to the upper left; where it has no score, the alignment starts at this word.
        before[:, 1:] = np.where(row[:, :-1] >= unit, row[:, :-1], start[1:])
        cell = np.maximum(before + np.where(same, MATCH, MISMATCH) * unit, row + GAP * unit)
        cell = np.maximum.accumulate(cell - GAP * unit * here, axis=1) + GAP * unit * here
        row = np.where(cell >= unit, cell, start)
        np.maximum(ends, np.where(inside & (k < lengths)[:, None], row, 0), out=ends)
    return ends


def aligned(items: list[np.ndarray], stretches: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each item with its stretch: score, first and last word in the stretch."""
    ends = alignment_ends(items, stretches)
    last = ends.argmax(axis=1)
    best = ends[np.arange(len(items)), last]
    score = best >> 32
    return score, np.where(score > 0, ends.shape[1] - (best & ((1 << 32) - 1)), 0), last


def disjoint(ends: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Of the alignments of one pair that score at least ``least``: the best, the best of those beside it, and so on."""
    at = np.flatnonzero(ends >> 32 >= least)
    taken, out = np.zeros(len(ends), bool), []
    for last in at[np.argsort(-ends[at], kind="stable")].tolist():
        first = len(ends) - int(ends[last] & ((1 << 32) - 1))
        if not (taken[first] or taken[last] or taken[first : last + 1].any()):
            taken[first : last + 1] = True
            out.append((int(ends[last] >> 32), first, last))
    return out


def longest_run(item: np.ndarray, words: np.ndarray) -> int:
    """Most words in a row that both have."""
    best, run = 0, np.zeros(len(words) + 1, np.int64)
    for word in item:
        run[1:] = np.where(words == word, run[:-1] + 1, 0)
        best = max(best, int(run.max()))
    return best


def least_score(length: int, least_similarity: float) -> int:
    """The lowest score from which an alignment with an item of so many words may be a copy."""
    return max(1, min(MATCH * LEAST_RUN, MATCH * LEAST_MATCHED, math.ceil(least_similarity * MATCH * length)))


def is_copy(item: np.ndarray, words: np.ndarray, score: int, least_similarity: float) -> bool:
    """Whether an alignment of an item with these words of a document, of this score, is reported."""
    if score >= least_similarity * MATCH * len(item) or score >= MATCH * LEAST_MATCHED:
        return True
    return longest_run(item, words) >= LEAST_RUN


def together(widths: list[int]) -> Iterator[list[int]]:
    """Numbers of pairs to align at once: of similar size, and few of them where they are long."""
    group: list[int] = []
    for i in sorted(range(len(widths)), key=widths.__getitem__):
        if group and (len(group) >= TOGETHER or (len(group) + 1) * widths[i] > CELLS):
            yield group
            group = []
        group.append(i)
    if group:
        yield group


def all_alignments(items: list[np.ndarray], stretches: list[np.ndarray], least: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each pair all alignments with enough score, as (score, first, last), none over another.

    What lies between alignments already taken is aligned again, until nothing scores enough there: an alignment may have
    been hidden by a better one that reached into its words.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in items]
    work = [(i, 0, len(s)) for i, s in enumerate(stretches) if len(s) and len(items[i])]
    while work:
        again = []
        for group in together([high - low for _, low, high in work]):
            parts = [work[w] for w in group]
            ends = alignment_ends([items[i] for i, _, _ in parts], [stretches[i][low:high] for i, low, high in parts])
            for (i, low, high), row in zip(parts, ends, strict=True):
                found = disjoint(row, least[i])
                out[i] += [(score, low + first, low + last) for score, first, last in found]
                edges = [low, *(e for _, first, last in sorted(found, key=lambda f: f[1]) for e in (low + first, low + last + 1)), high]
                gaps = zip(edges[::2], edges[1::2], strict=True)
                again += [(i, a, b) for a, b in gaps if found and (b - a) * MATCH >= least[i]]
        work = again
    return out


def align_columns(columns: dict, least_similarity: float) -> dict:
    out: dict[str, list] = {k: [] for k in ("id", "item", "score", "similarity", "start", "end")}
    items = [np.array(words, np.int64) for words in columns["item_words"]]
    stretches = [np.array(words, np.int64) for words in columns["words"]]
    found = all_alignments(items, stretches, [least_score(len(item), least_similarity) for item in items])
    for i, alignments in enumerate(found):
        for score, first, last in alignments:
            if is_copy(items[i], stretches[i][first : last + 1], score, least_similarity):
                out["id"].append(columns["id"][i])
                out["item"].append(columns["item"][i])
                out["score"].append(score)
                out["similarity"].append(score / (MATCH * len(items[i])))
                out["start"].append(columns["starts"][i][first])
                out["end"].append(columns["ends"][i][last])
    return out


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    least_similarity: float = LEAST_SIMILARITY,
) -> DataFrame:
    """Copies of items in documents: id, item id, score, similarity, and start and end of the copy in code points.

    A copy is an alignment with at least ``least_similarity`` of the score of the whole item, with LEAST_RUN words of it in a
    row, or with the score of LEAST_MATCHED matching words, so a part of a long item is one too. One row per copy: an item that
    stands twice in a document gives two rows, however near to each other; documents without copies give none. The
    similarity is the alignment score over that of an exact copy. Words are compared in lower case without punctuation. Null
    and empty texts, and items of fewer than three words, match nothing; items with equal id and text count once; repeated
    documents give repeated rows, null ids are carried. Of equal alignments the one with the earliest start is reported.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    tests = items.select(F.col(item_column).alias("item_id"), F.col(item_text_column).alias("t")).distinct()
    tests = tests.withColumn("item", F.xxhash64(F.isnull("item_id"), "item_id", "t"))
    item_kind = items.schema[item_column].dataType.simpleString()
    schema = f"item_id {item_kind}, item long, words array<long>, grams array<long>"
    tests = stored(map_columns(tests, item_columns, schema), "leaks-items")
    grams = tests.select("item", F.size("words").alias("length"), F.posexplode("grams").alias("at", "gram"))

    slots = grams.select(F.col("gram").bitwiseAND(FILTER_BITS - 1).alias("slot")).distinct().toArrow()["slot"].to_numpy()
    bits = np.zeros(FILTER_BITS, bool)  # at most FILTER_BITS rows came to the driver
    bits[slots] = True
    allowed = spark.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())

    rows = docs.select(
        F.col(id_column).alias("id"), F.xxhash64(F.isnull(id_column), id_column, text_column).alias("key"), F.col(text_column).alias("t")
    )
    passed = rows.mapInArrow(hit_task(allowed), f"id {kind}, key long, gram long, places array<long>")
    hits = stored(passed, "leaks-hits")
    known = stored(grams.select("gram").distinct(), "leaks-grams")
    counts = hits.join(known, "gram").groupBy("gram").agg(F.count("*").alias("documents"))
    weighed = stored(grams.join(counts, "gram", "left").fillna(0, "documents"), "leaks-weighed")
    middle = weighed.groupBy("item").agg(F.median("documents").alias("middle"))
    # The rarest triple of every LEAST_RUN words is a seed, so that a part is found whatever stands in the rest of its item.
    grams_of_run = LEAST_RUN - SEED + 1
    line = Window.partitionBy("item").orderBy("at")  # the triples of one item
    coming, gone = line.rowsBetween(0, grams_of_run - 1), line.rowsBetween(1 - grams_of_run, 0)
    rarest = F.when(F.count("*").over(coming) == grams_of_run, F.min("documents").over(coming))
    weighed = weighed.withColumn("rarest", rarest).withColumn("rarest", F.max("rarest").over(gone))
    bound = F.greatest(F.lit(RARE_DOCUMENTS), "middle", "rarest")
    seeds = weighed.join(middle, "item").where(F.col("documents") <= bound)
    seeds = stored(seeds.select("gram", "item", "length", "at"), "leaks-seeds")

    met = hits.join(seeds, "gram").select("id", "key", "item", "length", F.explode("places").alias("place"), "at")
    met = met.select("id", "key", "item", "length", F.floor((F.col("place") - F.col("at")) / STEP).alias("step")).distinct()
    pairs = met.groupBy("id", "key", "item", "length").agg(F.collect_list("step").alias("steps"))
    found = pairs.groupBy("id", "key").agg(F.collect_list(F.struct("item", "length", "steps")).alias("found"))
    found = stored(found.withColumnsRenamed({"id": "found_id", "key": "found_key"}), "leaks-found")
    both = rows.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key")))
    schema = f"id {kind}, item long, words array<long>, starts array<long>, ends array<long>"
    stretches = stored(map_columns(both.select("id", "t", "found"), region_columns, schema), "leaks-stretches")
    aligning = stretches.join(tests.select("item", F.col("words").alias("item_words")), "item")
    schema = f"id {kind}, item long, score long, similarity double, start long, end long"
    done = map_columns(aligning, align_columns, schema, least_similarity)
    return done.join(tests.select("item", "item_id"), "item").select(
        F.col("id").alias(id_column), F.col("item_id").alias(item_column), "score", "similarity", "start", "end"
    )
