"""Language identification by interpolated Kneser-Ney models of characters, one per language.

The models are counted over all labelled training texts, and every gram counts. They are tables: the lower orders of
Kneser-Ney count in how many contexts a gram occurs, which follows by grouping the grams one order above, and so do discounts
and the weights of contexts. Texts are packed in chunks; the distinct grams of each chunk are joined with the models, and the
chunk is scored with a sorted array of just these grams, so no task or driver ever holds a whole model. A text gets the
language with the lowest cross-entropy per character, and is rejected where that is far above what its training texts have.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import stored

ORDER = 4
#: Symbol before the start of a text, and the one that every run of other characters than letters becomes.
START, BLANK = 1, 32
#: A chunk of texts ends when it has so many characters or so many distinct grams.
CHUNK, CHUNK_GRAMS = 1 << 24, 1 << 20
#: Chunks are written and sent once each; at level 1 of zstd they take a quarter more of disk.
CHUNK_LEVEL = 9
#: Texts are worked on in pieces of so many characters, each with a start of its own; counts are passed on beyond HELD grams.
PIECE, HELD = 1 << 20, 500_000
#: Factor on differences of cross-entropy (nats per character) in scores.
SHARPNESS = 20.0
#: A text is rejected if its cross-entropy exceeds its language's mean by so many standard deviations, and by so many nats: a
#: text with a passage in another language stays, one in no learned language goes.
REJECT, REJECT_NATS = 8.0, 1.5
UNKNOWN = "und"

#: Odd, so that multiplying by it modulo 2^64 gives every gram a hash of its own.
HASH = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def alphabet() -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each character of the basic plane, and whether it is a letter. Marks count as parts of words."""
    symbols, letters = np.full(1 << 16, BLANK, np.uint16), np.zeros(1 << 16, bool)
    for code in range(1 << 16):
        char = chr(code)
        letters[code] = char.isalpha()
        if letters[code] or unicodedata.category(char)[0] == "M":
            low = char.lower()
            symbols[code] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else code
    symbols[START] = START
    return symbols, letters


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def symbols_of(text: str) -> np.ndarray:
    """Symbols of a text in which START stands for itself; runs of blanks are one blank, none follows a start."""
    symbols, _ = alphabet()
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    wide = codes >= 1 << 16
    if wide.any():  # letters beyond the basic plane share the private symbols
        codes = codes.copy()
        kinds, place = np.unique(codes[wide], return_inverse=True)
        codes[wide] = np.array([0xE000 + k % 0x1900 if chr(k).isalpha() else BLANK for k in kinds.tolist()], np.uint32)[place]
        out = symbols[codes]
        out[wide] = codes[wide]
    else:
        out = symbols[codes]
    blank = out == BLANK
    drop = blank.copy()
    drop[1:] &= blank[:-1] | (out[:-1] == START)
    return out[~drop]


def pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, index of their text) for groups of texts of about PIECE characters."""
    head, held, owners, size = chr(START) * (ORDER - 1), [], [], 0

    def grams() -> tuple[np.ndarray, np.ndarray]:
        s = symbols_of("".join(held)).astype(np.uint64)
        owner = np.array(owners)[(np.cumsum(s == START) - 1) // (ORDER - 1)]
        n = len(s) - ORDER + 1
        keys = s[:n].copy()
        for i in range(1, ORDER):
            keys <<= np.uint64(16)
            keys |= s[i : n + i]
        valid = s[ORDER - 1 :] != START
        return keys[valid], owner[ORDER - 1 :][valid]

    for i, text in enumerate(texts):
        for start in range(0, len(text or ""), PIECE):
            part = text[start : start + PIECE]
            held.append(head + part.replace(chr(START), " "))
            owners.append(i)
            size += len(part)
            if size >= PIECE:
                yield grams()
                held, owners, size = [], [], 0
    if held:
        yield grams()


def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts per language, merged within the task."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([k for k, _ in held[lang]]), return_inverse=True)
        return keys, np.bincount(place, np.concatenate([n for _, n in held[lang]])).astype(np.int64)

    def rows(lang: str) -> pa.RecordBatch:
        keys, n = merged(lang)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
        )

    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            for keys, _ in pieces(texts):
                held.setdefault(lang, []).append(np.unique(keys, return_counts=True))
            if len(held.get(lang, ())) > 16:
                held[lang] = [merged(lang)]
            if sum(len(k) for k, _ in held.get(lang, ())) > HELD:
                yield rows(lang)
                del held[lang]
    for lang in held:
        yield rows(lang)


class Model:
    """Log probabilities of one language, order by order, in arrays sorted by gram hash: what the tables hold, for few grams."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        keys, n = grams.astype(np.uint64), counts.astype(np.float64)
        levels = []
        for order in range(ORDER, 0, -1):
            levels.append((order, keys, n))
            if order > 1:  # in how many contexts each shorter gram occurs
                keys, n = np.unique(keys & np.uint64((1 << 16 * (order - 1)) - 1), return_counts=True)
                n = n.astype(np.float64)
        self.floor = -float(np.log(len(keys) + 1))  # an unseen symbol is one of the vocabulary and one more
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for order, keys, n in reversed(levels):
            ones, twos = int((n == 1).sum()), int((n == 2).sum())
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            contexts, place, kinds = np.unique(keys >> np.uint64(16), return_inverse=True, return_counts=True)
            total = np.bincount(place, n)
            weight = discount * kinds / total
            below = np.exp(self.logs(keys, order - 1))
            logp = np.log(np.maximum(n - discount, 0) / total[place] + weight[place] * below)
            by_gram, by_context = np.argsort(keys * HASH), np.argsort(contexts * HASH)
            self.levels.append(
                (
                    (keys * HASH)[by_gram],
                    logp[by_gram].astype(np.float32),
                    (contexts * HASH)[by_context],
                    np.log(weight)[by_context].astype(np.float32),
                )
            )

    def logs(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of the last symbol of each gram after the symbols before it."""
        out = np.full(len(grams), self.floor)
        for k, (keys, logp, contexts, weights) in enumerate(self.levels[:order], 1):
            gram = grams & np.uint64((1 << 16 * k) - 1)
            at, seen = looked_up(keys, gram * HASH)
            near, known = looked_up(contexts, (gram >> np.uint64(16)) * HASH)
            out = np.where(seen, logp[at], np.where(known, out + weights[near], out))
        return out


def looked_up(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return at, table[at] == hashes


def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of rows (id, held_out, lang, t), compressed, with the distinct grams of their texts."""
    first, done, held, size, grams = TaskContext.get().partitionId() << 32, 0, [], 0, [np.array([], np.uint64)]

    def packed() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", CHUNK_LEVEL))) as writer:
            for batch in held:
                writer.write_batch(batch)
        own = np.unique(np.concatenate(grams)).astype("<u8")
        values = [pa.array([first + done]), pa.array([sink.getvalue().to_pybytes()]), pa.array([np.diff(own, prepend=np.uint64(0)).tobytes()])]
        return pa.RecordBatch.from_arrays(values, names=["chunk", "packed", "grams"])

    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column("t").to_pylist()
        held.append(batch)
        size += sum(map(len, filter(None, texts)))
        for keys, _ in pieces([t if has_letter(t) else None for t in texts]):
            grams.append(np.unique(keys))
            if len(grams) > 16:
                grams = [np.unique(np.concatenate(grams))]
        if size >= CHUNK or sum(map(len, grams)) >= CHUNK_GRAMS:
            yield packed()
            done, held, size, grams = done + 1, [], 0, [np.array([], np.uint64)]
    if held:
        yield packed()


def grams_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, gram) of packed grams."""
    for batch in batches:
        for chunk, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            keys = np.cumsum(np.frombuffer(packed, "<u8"), dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk)), pa.array(keys)], names=["chunk", "gram"])


def each(n: int, value) -> Column:
    """An array of one value per language."""
    return F.array(*(value(i) for i in range(n)))


def train(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    """(lang, gram, n): how often each gram occurs in all rows with a language and a text."""
    labelled = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    rows = labelled.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("t"))
    partial = rows.mapInArrow(count_task, "lang string, gram long, n long")
    return stored(partial.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-counts")


def log_probabilities(counts: DataFrame, asked: DataFrame, names: list[str]) -> DataFrame:
    """(gram, logs): the log probability in each language of ``names`` of every gram counted or asked for, as ``Model`` has it."""
    langs = len(names)
    rows = counts.select("gram", "lang", "n").union(asked.select("gram", F.lit(None).cast("string"), F.lit(0).cast("long")).distinct())
    level = rows.groupBy("gram").agg(each(langs, lambda i: F.sum(F.when(F.col("lang") == names[i], F.col("n")).otherwise(0))).alias("n"))
    levels = {ORDER: stored(level, f"language-order{ORDER}")}
    for order in range(ORDER - 1, 0, -1):  # in how many contexts each shorter gram occurs
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1).cast("long"))
        seen = levels[order + 1].groupBy(shorter.alias("gram"))
        levels[order] = stored(seen.agg(each(langs, lambda i: F.sum((F.col("n")[i] > 0).cast("long"))).alias("n")), f"language-order{order}")
    below = None
    for order in range(1, ORDER + 1):
        sums = [each(langs, lambda i, t=t: F.sum(t(F.col("n")[i]).cast("long"))) for t in (lambda n: n == 1, lambda n: n == 2, lambda n: n > 0, lambda n: n)]
        context = F.shiftrightunsigned("gram", 16)
        ones, twos, kinds, totals = levels[order].agg(*sums).first()
        discounts = [a / (a + 2 * b) if a and b else 0.5 for a, b in zip(ones, twos, strict=True)]
        if below is None:  # an unseen symbol is one of the vocabulary and one more; all symbols have the empty context
            near = levels[order].select("gram", "n", *(F.array(*map(F.lit, v)).alias(k) for k, v in (("kinds", kinds), ("total", totals))))
            near = near.withColumn("p", F.array(*(F.lit(1.0 / (k + 1)) for k in kinds)))
        else:
            around = levels[order].groupBy(context.alias("context"))
            around = around.agg(sums[2].alias("kinds"), sums[3].alias("total"))
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1).cast("long"))
            near = levels[order].withColumns({"context": context, "suffix": suffix}).join(around, "context")
            near = near.join(below.withColumnRenamed("gram", "suffix"), "suffix")

        def smoothed(i: int, d: list[float] = discounts) -> Column:
            n, total = F.col("n")[i], F.col("total")[i]
            return F.when(total > 0, (F.greatest(n - d[i], F.lit(0.0)) + d[i] * F.col("kinds")[i] * F.col("p")[i]) / total).otherwise(F.col("p")[i])

        below = near.select("gram", each(langs, smoothed).alias("p"))
    return below.select("gram", F.transform("p", lambda p: F.log(p).cast("float")).alias("logs"))


def scored_chunk(packed: pa.Table, known: pa.Table, names: list[str]) -> dict:
    """Best language of each row of a chunk, its cross-entropy per symbol, its score among the languages, and the symbols."""
    rows = pa.ipc.open_stream(packed["packed"][0].as_py()).read_all()
    texts, n = rows["t"].to_pylist(), rows.num_rows
    grams = known["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    flat = known["logs"].combine_chunks().flatten().to_numpy() if len(grams) else np.array([], np.float32)
    grams, logs = grams[order], np.ascontiguousarray(flat.reshape(-1, max(1, len(names)))[order].T)
    sums, sizes = np.zeros((len(names), n)), np.zeros(n)
    for keys, owner in pieces([t if has_letter(t) else None for t in texts]):
        sizes += np.bincount(owner, minlength=n)
        if names:
            place = np.searchsorted(grams, keys)
            for i, own in enumerate(logs):
                sums[i] += np.bincount(owner, own[place], n)
    out = {"pred": [], "entropy": [], "score": [], "size": sizes.astype(np.int64)}
    for j in range(n):
        if not sizes[j] or not names:
            out["pred"].append(UNKNOWN)
            out["entropy"].append(None)
            out["score"].append(0.0)
            continue
        entropy = -sums[:, j] / sizes[j]
        best = int(np.argmin(entropy))
        out["pred"].append(names[best])
        out["entropy"].append(float(entropy[best]))
        out["score"].append(float(1 / np.exp(-SHARPNESS * (entropy - entropy[best])).sum()))
    return {name: rows[name].to_pylist() for name in ("id", "held_out", "lang")} | out


def predicted(rows: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    """(id, held_out, lang, pred, entropy, score, size) of rows with id, held_out, lang and t."""
    names = sorted(r.lang for r in counts.select("lang").distinct().collect())
    chunks = stored(rows.mapInArrow(pack_task, "chunk long, packed binary, grams binary"), "language-chunks")
    asked = chunks.select("chunk", "grams").mapInArrow(grams_task, "chunk long, gram long")
    if names:
        known = asked.join(log_probabilities(counts, asked, names), "gram")
    else:
        known = asked.where("false").withColumn("logs", F.array().cast("array<float>"))
    schema = f"id {kind}, held_out boolean, lang string, pred string, entropy double, score double, size long"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(packed: pa.Table, known: pa.Table) -> pa.Table:
        out = scored_chunk(packed, known, names)
        return pa.Table.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return chunks.select("chunk", "packed").groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)


def held_out(id_column: str) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_language(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    reject: float = REJECT,
    split_column: str | None = None,
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, cross_entropy and rejected.

    Models learn from rows that have a language and are not held out by ``split_column`` (the id). ``lang_pred`` is a learned language, or ``und`` for null
    texts and texts without a letter; these have score 0 and are rejected. The score is the share of the best language when
    the languages' likelihoods per character are compared. A text is rejected too if its cross-entropy exceeds the mean of
    its language's training texts by ``reject`` of their standard deviations, which shrink with the root of the length, and
    by ``REJECT_NATS`` at least.
    Languages that tie go to the first by name. Without any training text all rows are ``und``. Rows, repeated or not, are
    independent; other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    out_of_training = held_out(split_column or id_column)
    counts = train(docs.where(~out_of_training), text_column, lang_column)
    rows = docs.select(
        F.col(id_column).alias("id"), out_of_training.alias("held_out"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("t")
    )
    scored = stored(predicted(rows, counts, kind), "language-scored")
    right = scored.where(~F.col("held_out") & (F.col("lang") == F.col("pred")))
    means = right.groupBy("pred").agg(F.avg("entropy").alias("mean"))
    # Sums that one pass can merge: spread is the mean of n * (entropy - mean)^2.
    spread = F.avg(F.col("size") * F.col("entropy") * F.col("entropy")), F.avg(F.col("size") * F.col("entropy")), F.avg("size")
    sums = right.groupBy("pred").agg(*(s.alias(a) for s, a in zip(spread, ("s2", "s1", "s0"), strict=True)))
    limits = means.join(sums, "pred").select(
        "pred", "mean", F.sqrt(F.greatest(F.col("s2") - 2 * F.col("mean") * F.col("s1") + F.col("mean") ** 2 * F.col("s0"), F.lit(0))).alias("spread")
    )
    out = scored.join(stored(limits, "language-limits"), "pred", "left")
    far = F.col("entropy") - F.col("mean") > F.greatest(reject * F.col("spread") / F.sqrt("size"), F.lit(REJECT_NATS))
    return out.select(
        F.col("id").alias(id_column),
        "held_out",
        F.col("pred").alias("lang_pred"),
        "score",
        F.col("entropy").alias("cross_entropy"),
        ((F.col("pred") == UNKNOWN) | F.coalesce(far, F.lit(False))).alias("rejected"),
    )
