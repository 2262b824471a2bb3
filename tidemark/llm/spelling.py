"""Spelling variants: words one edit apart, found by scanning sorted lists with a banded edit matrix.

Two words one edit apart, the longer of M code points, share their first M // 2 code points, or else their last M - M // 2.
Words that share such an end meet in a list, sorted by the rest of the word. Each word of a list scans those after it. The
rows of its edit matrix, three cells wide, belong to prefixes of the scanned word, so the next word reuses as many of them as
it shares code points with the last one; where a row has no cell of at most one edit, all words with that prefix are
skipped at once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run loses a code point where this divides the checksum of document and run.
DIVISOR = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form is at least this many times as frequent as the word.
FACTOR = 2
#: A list of more words is split into pairs of parts of about this size; no pair is lost.
PART = 1 << 15

FAR = 2
LAST = "\U0010ffff"


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): words of at least ``LEAST_LENGTH`` code points that occur at least ``LEAST_COUNT`` times. Null texts have
    none; a null id counts as an empty one."""
    runs = docs.select(F.col(id_column).alias("id"), F.explode(F.regexp_extract_all(text_column, F.lit(RUN), F.lit(0))).alias("run"))
    # Without capitals beyond A-Z, lower() changes A-Z only.
    low = F.when(F.col("run").rlike("[À-Þ]"), F.translate("run", UPPER, LOWER)).otherwise(F.lower("run"))
    runs = runs.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), low.alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % DIVISOR == 0, shorter).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def near_in(rests: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of places in a sorted list of distinct strings that are exactly one edit apart, the smaller place first."""
    n = len(rests)
    shared = [0, *(len(commonprefix(pair)) for pair in zip(rests, rests[1:], strict=False))]
    for i in range(n - 1):
        query = rests[i]
        size = len(query)
        # A row: edits between the scanned prefix of t code points and the query's first t - 1, t and t + 1.
        rows = [(FAR, 0, 1 if size else FAR)]
        rows += [(1, 0, 1 if t < size else FAR) for t in range(1, size + 1)]
        j, known = i + 1, shared[i + 1]
        while j < n:
            word = rests[j]
            del rows[known + 1 :]
            for t in range(known, len(word)):
                before, same, after = rows[t]
                letter = word[t]
                # The prefix of t + 1 against the query's first t, t + 1 and t + 2.
                left = before + (letter != query[t - 1]) if 0 < t <= size else FAR
                left = min(left, same + 1) if t <= size else FAR
                middle = min(same + (letter != query[t]), left + 1, after + 1) if t < size else FAR
                right = min(after + (letter != query[t + 1]), middle + 1) if t + 1 < size else FAR
                if left > 1 and middle > 1 and right > 1:
                    j = bisect_right(rests, word[: t + 1] + LAST, j)
                    break
                rows.append((left, middle, right))
            else:
                gap = size - len(word)
                if -1 <= gap <= 1 and rows[len(word)][gap + 1] == 1:
                    yield i, j
                j += 1
            if j < n:
                known = min(shared[j], len(rows) - 1)


def link_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by list and rest in, links out; of a split list the rows of two parts."""

    def linked(key: tuple, rows: list[tuple]) -> pa.RecordBatch:
        longest, side, _, low, high = key
        found = []
        for i, j in near_in([r[0] for r in rows]):
            (_, own, a, n_a), (_, other, b, n_b) = rows[i], rows[j]
            if max(len(a), len(b)) != longest or (min(own, other), max(own, other)) != (low, high):
                continue
            if side == 1 and a[: longest // 2] == b[: longest // 2]:
                continue  # their first halves bring them together
            found.append((a, n_a, b, n_b))
        columns = list(zip(*found, strict=True)) or [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["a", "n_a", "b", "n_b"])

    held, last = [], None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("longest", "side", "key", "low", "high", "rest", "own", "word", "n")]
        for *key, rest, own, word, n in zip(*columns, strict=True):
            if key != last and held:
                if len(held) > 1:
                    yield linked(tuple(last), held)
                held = []
            held.append((rest, own, word, n))
            last = key
    if len(held) > 1:
        yield linked(tuple(last), held)


def near_words(words: DataFrame) -> DataFrame:
    """Unordered pairs (a, n_a, b, n_b) of ``words`` (word, n) that are one edit apart, each once.

    Words of one code point only share no end with others, so that words should have at least two.
    """
    longest, size = F.col("longest"), F.length("word")
    rows = words.withColumn("longest", F.explode(F.array(size, size + 1)))
    first = F.floor(longest / 2).cast("int")
    rows = rows.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    turned = F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))
    cut = F.when(F.col("side") == 0, first).otherwise(longest - first)
    rows = rows.withColumns({"turned": turned, "cut": cut}).select(
        "longest", "side", F.substring("turned", F.lit(1), F.col("cut")).alias("key"),
        F.substring("turned", F.col("cut") + 1, size).alias("rest"), "word", "n",
    )
    lists = ["longest", "side", "key"]
    sizes = stored(rows.groupBy(*lists).agg(F.count("*").alias("size")).where("size > 1"), "spelling-lists")
    parts = F.ceil(F.col("size") / PART).cast("int")
    own = F.pmod(F.hash("word"), F.col("parts"))
    met = rows.join(sizes, lists).withColumn("parts", parts).withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select(*lists, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "rest", "own", "word", "n")
    order = [*lists, "low", "high"]
    met = met.repartition(*order).sortWithinPartitions(*order, "rest")
    return met.mapInArrow(link_lists, "a string, n_a long, b string, n_b long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the end of each chain of forms.

    Every round doubles the steps taken. A form is at least ``FACTOR`` times as frequent as its word, so chains have no
    loops and their length, and with it the rounds, grow with the logarithm of the largest count.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reached.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.isnotnull("further").alias("moved"))
        step = stored(step, "spelling-roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        reached = step.select("word", "root")


def group_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per word: word, n, n_near (words one edit apart), form (the most frequent of them, the smallest in code-point
    order on ties, if at least ``FACTOR`` times as frequent), form_n, and root (the end of the chain of forms, or the word).

    Repeated rows count as often as they occur. No words, as in an empty table, give no rows. Other columns are ignored.
    """
    words = stored(vocabulary(docs, id_column, text_column), "spelling-words")
    pairs = stored(near_words(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    has = -F.col("best.rank") >= FACTOR * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best.near")).alias("form"),
        F.when(has, -F.col("best.rank")).alias("form_n"),
    )
    known = stored(known, "spelling-forms")
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants_sql() -> str:
    """The same over ``documents`` in DuckDB, comparing all pairs of words. The checksum is CRC-32 by its table; letters beyond
    ASCII stand for one control character each, because the edit distance there counts bytes."""
    latin = "".join(chr(c) for c in range(0xC0, 0x100))
    single = " || ".join(f"chr({i})" for i in range(1, 65))
    return f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT COALESCE(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '{RUN}')) AS run FROM documents),
low AS (SELECT id, translate(run, '{UPPER}', '{LOWER}') AS w, COUNT(*) AS c FROM runs GROUP BY ALL),
bytes AS (
  SELECT w, c, flatten(list_transform(string_split(id || ':' || w, ''), lambda x:
           CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END)) AS b
  FROM low),
hashed AS (
  SELECT w, c, xor(4294967295, list_reduce(list_concat([4294967295], b), lambda s, x:
           xor(s >> 8, t[(xor(s, x) & 255) + 1]))) AS h
  FROM bytes, crc),
edited AS (
  SELECT CASE WHEN h % {DIVISOR} = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM hashed),
v AS (
  SELECT word, SUM(c)::BIGINT AS n, translate(word, '{latin}', {single}) AS x FROM edited WHERE length(word) >= {LEAST_LENGTH}
  GROUP BY word HAVING SUM(c) >= {LEAST_COUNT}),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM v a
  JOIN v b ON a.word <> b.word AND abs(length(a.x) - length(b.x)) <= 1 AND levenshtein(a.x, b.x) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k, COUNT(*) OVER (PARTITION BY word) AS m FROM near),
forms AS (
  SELECT v.word, v.n, COALESCE(m, 0) AS n_near, CASE WHEN other_n >= {FACTOR} * v.n THEN other END AS form,
         CASE WHEN other_n >= {FACTOR} * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN ranked r ON r.word = v.word AND k = 1),
chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.at WHERE e.form IS NULL"""
