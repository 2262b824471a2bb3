"""Quality rules: measures of single texts, and lines that too many documents of a host share."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, map_columns, stored

WORDS = re.compile(WORD)
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: A text fails the base rules with fewer words, or with a larger percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEAT_PERCENT = 20, 30
#: A line is removed if it stands in more documents of its host than this.
MOST_DOCUMENTS_PER_HOST = 30
#: A document is depleted if it loses a larger share of its words, or keeps fewer than LEAST_WORDS.
MOST_REMOVED_SHARE = 0.7

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[str]) -> int:
    """Words inside windows of eight words that occur at least twice, the first occurrence included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = codes[:n].copy()
    for i in range(1, WINDOW):
        windows *= np.uint64(0x9E3779B97F4A7C15)
        windows += codes[i : n + i]
    ordered = np.sort(windows)
    equal = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(equal):
        return 0
    places = np.flatnonzero(np.isin(windows, equal)).tolist()
    texts = [tuple(words[i : i + WINDOW]) for i in places]  # equal codes are confirmed by the words themselves
    counts = Counter(texts)
    covered = np.zeros(len(words) + 1, np.int64)
    for i, text in zip(places, texts, strict=True):
        if counts[text] > 1:
            covered[i] += 1
            covered[i + WINDOW] -= 1
    return int((np.cumsum(covered) > 0).sum())


def measure(text: str) -> tuple:
    """The base measures, and the words per normalised line as two lists."""
    words = WORDS.findall(text)
    seen: set[str] = set()
    repeated, lines = 0, Counter()
    for line in text.split("\n"):
        found = WORDS.findall(line)
        if found:
            repeated += line in seen
            seen.add(line)
            lines[xxhash.xxh64_intdigest(" ".join(found).lower()) - (1 << 63)] += len(found)
    symbols = sum(text.count(c) for c in SYMBOLS)
    return len(words), sum(map(len, words)), symbols, repeated, repeat_words(words), list(lines), list(lines.values())


def measure_columns(columns: dict, text_column: str) -> dict:
    rows = [measure(text or "") for text in columns.pop(text_column)]
    names = [c.split()[0] for c in BASE.split(", ")] + ["lines", "line_words"]
    return columns | {name: [r[i] for r in rows] for i, name in enumerate(names)}


def judge_quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    most_documents: int = MOST_DOCUMENTS_PER_HOST,
    most_removed_share: float = MOST_REMOVED_SHARE,
) -> DataFrame:
    """Base measures, removed words and the verdict of every row.

    Lines are compared after lower-casing and joining their words by single blanks. A line that stands in more than
    ``most_documents`` rows of one host loses its words in all of them; rows are counted, however often each repeats the
    line. A row is kept if it passes the base rules and is not depleted. Null texts are empty and fail; rows without a host
    form one host of their own; repeated rows and ids are separate documents; other columns are ignored.
    """
    host = F.coalesce(F.concat(F.lit("="), F.col(host_column).cast("string")), F.lit(""))
    kind = docs.schema[id_column].dataType.simpleString()
    # The row number is fixed by storing the table; ids may repeat or be null.
    rows = docs.select(
        F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"), host.alias("host"), F.col(text_column).alias("t")
    )
    schema = f"id {kind}, row long, host string, {BASE}, lines array<long>, line_words array<long>"
    measured = stored(map_columns(rows, measure_columns, schema, "t"), "quality-measured")
    lines = measured.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
    lines = lines.select("row", "host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("documents"))
    common = stored(counts.where(F.col("documents") > most_documents).select("host", "line"), "quality-common")
    removed = lines.join(common, ["host", "line"]).groupBy("row").agg(F.sum("words").alias("removed"), F.count("*").alias("n"))
    out = measured.drop("lines", "line_words").join(stored(removed, "quality-removed"), "row", "left")
    gone = F.coalesce("removed", F.lit(0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("n_words") - gone < LEAST_WORDS) | (gone > most_removed_share * F.col("n_words"))
    return out.select(
        F.col("id").alias(id_column),
        *(c.split()[0] for c in BASE.split(", ")),
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_common_lines"),
        gone.cast("long").alias("n_removed_words"),
    )


JUDGE_SQL = r"""
WITH d AS (SELECT doc_id, source, COALESCE(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS t
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
again AS (SELECT doc_id, i FROM win QUALIFY COUNT(*) OVER (PARTITION BY doc_id, t) > 1),
rep AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
l AS (SELECT doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws
      FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d)),
worded AS (SELECT doc_id, source, line, len(ws) AS n, lower(array_to_string(ws, ' ')) AS norm FROM l WHERE len(ws) > 0),
dup AS (SELECT doc_id, COUNT(*) - COUNT(DISTINCT line) AS n FROM worded GROUP BY doc_id),
per_doc AS (SELECT doc_id, source, norm, SUM(n) AS n FROM worded GROUP BY ALL),
common AS (SELECT source, norm FROM per_doc GROUP BY ALL HAVING COUNT(*) > 30),
gone AS (SELECT doc_id, SUM(n) AS n, COUNT(*) AS k FROM per_doc p
         JOIN common c ON p.norm = c.norm AND p.source IS NOT DISTINCT FROM c.source GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(ws) AS n_words, COALESCE(length(array_to_string(ws, '')), 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, COALESCE(dup.n, 0) AS n_dup_lines,
         COALESCE(rep.n, 0) AS n_repeat_words, CAST(COALESCE(gone.n, 0) AS BIGINT) AS n_removed_words,
         COALESCE(gone.k, 0) AS n_common_lines
  FROM d JOIN w USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT (n_words - n_removed_words < 20 OR n_removed_words > 0.7 * n_words) AS kept FROM f
"""
