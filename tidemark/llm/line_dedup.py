"""Substring dedup by hashing lines and sentences: the earliest occurrence of a unit stays, the rest goes.

Units of a text are its lines, its longer sentences and its pairs of consecutive sentences within a line. Lines catch
boilerplate and whole copies in any script. Sentences and pairs catch passages that were pasted into the middle of a line, whose
first and last lines differ. A sentence of many words, such as a passage without stops, is parted after words that their own
hash chooses, so that a copy is parted alike wherever it stands; its parts count as sentences. Units are normalised (lower
case, single blanks) before hashing to 128 bits, so a line and a sentence of the same words are one unit; offsets are those
of the original text.
"""

from __future__ import annotations

import re
import zlib

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, stored

#: Least characters of normalised units. Every line counts; shorter sentences go only with their lines or neighbours.
LEAST_LINE, LEAST_SENTENCE, LEAST_PAIR = 1, 60, 40

#: Sentences of more words are parted, after one word in ``PART_EVERY``.
LONG_SENTENCE, PART_EVERY = 24, 8

SENTENCE_END = re.compile(r"[.!?]+\s+|[\u3002\uFF01\uFF1F]+\s*")
WORD = re.compile(r"\S+")
HALF = (1 << 64) - 1


def sentences(line: str) -> list[tuple[int, int, str]]:
    """Start, end and normalised words of the sentences of a line, and of the parts of long ones; blank ones are left out."""
    ends = [m.end() for m in SENTENCE_END.finditer(line)]
    found = []
    for start, end in zip([0, *ends], [*ends, len(line)], strict=True):
        words = line[start:end].lower().split()
        if len(words) <= LONG_SENTENCE:
            if words:
                found.append((start, end, " ".join(words)))
            continue
        at, part = start, []
        for m, word in zip(WORD.finditer(line, start, end), words, strict=True):
            part.append(word)
            if zlib.crc32(word.encode("utf-8", "replace")) % PART_EVERY == 0:
                found.append((at, m.end(), " ".join(part)))
                at, part = m.end(), []
        if part:
            found.append((at, end, " ".join(part)))
    return found


def text_units(text: str, least: tuple[int, int, int]) -> dict[int, str]:
    """The units of a text: their normalised words by place (start << 32 | end, in code points)."""
    units, at = {}, 0
    for line in text.split("\n"):
        words = " ".join(line.lower().split())
        if words and len(words) >= least[0]:
            units[at << 32 | at + len(line)] = words
        before = None
        for start, end, words in sentences(line):
            if len(words) >= least[1]:
                units[at + start << 32 | at + end] = words
            if before is not None and len(before[1]) + 1 + len(words) >= least[2]:
                units[at + before[0] << 32 | at + end] = f"{before[1]} {words}"
            before = (start, words)
        at += len(line) + 1
    return units


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def unit_columns(columns: dict, least: tuple[int, int, int]) -> dict:
    out = columns | {"high": [], "low": [], "places": []}
    for text in out.pop("t"):
        units = text_units(text or "", least)
        digests = [xxhash.xxh3_128_intdigest(words.encode("utf-8", "replace")) for words in units.values()]
        out["high"].append([signed(d >> 64) for d in digests])
        out["low"].append([signed(d & HALF) for d in digests])
        out["places"].append(list(units))
    return out


def cut(text: str, places: list[int]) -> tuple[list[tuple[int, int]], str]:
    """Merged spans of the given places, and the text without them."""
    spans: list[tuple[int, int]] = []
    for place in sorted(places):
        start, end = place >> 32, place & 0xFFFFFFFF
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return spans, "".join([*kept, text[at:]])


def cut_columns(columns: dict) -> dict:
    out: dict[str, list] = {"id": columns["id"], "n_chars": [], "n_removed_units": [], "n_removed_chars": [], "removed": [], "t": []}
    for text, places in zip(columns["t"], columns["places"], strict=True):
        spans, kept = cut(text or "", places or [])
        out["n_chars"].append(len(text or ""))
        out["n_removed_units"].append(len(places or []))
        out["n_removed_chars"].append(len(text or "") - len(kept))
        out["removed"].append(",".join(f"{a}:{b}" for a, b in spans))
        out["t"].append(kept if text is not None else None)
    return out


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_line: int = LEAST_LINE,
    least_sentence: int = LEAST_SENTENCE,
    least_pair: int = LEAST_PAIR,
) -> DataFrame:
    """One row per input row: id, n_chars, n_removed_units, n_removed_chars, removed (spans ``start:end``) and the kept text.

    Occurrences rank by id (nulls last), then by the text's hash, then by place; the first one of each unit stays, in the
    whole table and within a text. Rows with equal id and equal text count as one occurrence and get equal results. Null,
    empty and blank texts have no units. The first occurrence of any sentence is never removed, as whatever removes it would
    have to occur earlier. Units below the given numbers of normalised characters are left alone: ``least_line`` spares
    short lines that repeat without being copies. Other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("h"), F.col(text_column).alias("t"))
    schema = f"id {kind}, h long, high array<long>, low array<long>, places array<long>"
    found = map_columns(rows, unit_columns, schema, (least_line, least_sentence, least_pair))
    units = found.select("id", "h", F.explode(F.arrays_zip("high", "low", "places")).alias("u"))
    rank = F.struct(F.isnull("id").alias("unknown"), "id", "h", F.col("u.places").alias("place"))
    units = units.select("u.high", "u.low", rank.alias("rank"))
    repeated = units.groupBy("high", "low").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    repeated = stored(repeated.where("first != last").select("high", "low", "first"), "repeats-first")
    later = units.join(repeated, ["high", "low"]).where("rank != first").select("rank.id", "rank.h", "rank.place")
    gone = stored(later.groupBy("id", "h").agg(F.collect_set("place").alias("places")), "repeats-gone")
    gone = gone.select(F.col("id").alias("gone_id"), F.col("h").alias("gone_h"), "places")
    matched = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("h") == F.col("gone_h")), "left")
    schema = f"id {kind}, n_chars long, n_removed_units long, n_removed_chars long, removed string, t string"
    out = map_columns(matched.select("id", "t", "places"), cut_columns, schema)
    return out.withColumnsRenamed({"id": id_column, "t": text_column})
