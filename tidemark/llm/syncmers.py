"""Document fingerprints from closed syncmers, as column expressions.

A text is a sequence of tokens. Of all runs of ``LENGTH`` tokens those are anchors whose smallest inner run of ``INNER``
tokens, by digest, is their first or their last one. Whether a run is an anchor depends on its own tokens only, never on
those around it, so an edit moves or removes only the anchors that it touches, and two texts choose the same anchors in all
that they share. A mark is an anchor's digest with its place; equal marks are matches at the same place. The fingerprint is
a bottom sketch of the anchors: the ``SKETCH`` smallest distinct digests. The likeness of two fingerprints estimates the
Jaccard similarity of the anchor sets of their texts, without bias and whatever their lengths.

Everything stays in built-in functions: arrays per text, no row per anchor, no Python.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.numbering import numbered

#: Tokens in an anchor and in the inner runs that decide; half of all runs are anchors.
LENGTH, INNER = 5, 2
#: Hexadecimal digits of an anchor's digest, and digests in a fingerprint.
DIGITS, SKETCH = 8, 64
#: Scripts without blanks (Thai to Lao, Han and kana, with the supplementary planes): every character is a token.
UNSPACED = "฀-໿⺀-鿿豈-﫿\U00020000-\U0003ffff"
#: All other tokens are runs without the six ASCII blanks.
TOKEN = f"[{UNSPACED}]|[^\\x20\\x09-\\x0D{UNSPACED}]+"


def with_marks(df: DataFrame, text: str, marks: str) -> DataFrame:
    """Adds the array ``marks`` of ``digest:place``, one per anchor of the text column, places in tokens from 1.

    A text of fewer than ``LENGTH`` tokens is one anchor; one without tokens, or null, has none.
    """
    words, inner = f"{marks}__words", f"{marks}__inner"
    w, g = F.col(words), F.col(inner)
    split = df.withColumn(words, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)))
    pairs = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.md5(F.concat(a, F.lit(" "), b)))
    split = split.withColumn(inner, F.when(F.size(w) < LENGTH, F.array().cast("array<string>")).otherwise(pairs))

    def closed(i: Column) -> Column:
        first, *middle, last = [F.element_at(g, i + k if k else i) for k in range(LENGTH - INNER + 1)]
        opens = reduce(and_, [first <= other for other in (*middle, last)])  # settled by the first smaller one
        return opens | reduce(and_, [last <= other for other in (*middle, first)])

    def digest(tokens: Column) -> Column:
        return F.substring(F.md5(F.array_join(tokens, " ")), 1, DIGITS)

    def mark(i: Column) -> Column:
        return F.concat(digest(F.slice(w, i, LENGTH)), F.lit(":"), i.cast("string"))

    starts = F.filter(F.sequence(F.lit(1), F.size(w) - (LENGTH - 1)), closed)
    none = F.array().cast("array<string>")
    whole = F.when(F.size(w) == 0, none).otherwise(F.array(F.concat(digest(w), F.lit(":1"))))
    found = F.when(F.size(w) < LENGTH, whole).otherwise(F.transform(starts, mark))
    return split.withColumn(marks, found).drop(words, inner)


def fingerprint(marks: str) -> Column:
    """The ``SKETCH`` smallest distinct digests of an array of marks, joined without a separator."""
    digests = F.array_distinct(F.transform(marks, lambda m: F.substring(m, 1, DIGITS)))
    return F.array_join(F.slice(F.sort_array(digests), 1, SKETCH), "")


def with_sketch(df: DataFrame, print_column: str, name: str) -> DataFrame:
    """Adds the array ``name`` of the digests in a fingerprint."""
    return df.withColumn(name, F.regexp_extract_all(print_column, F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0)))


def likeness(a: str, b: str) -> Column:
    """Share of the smallest digests of both sketches (array columns) that stand in each of them; 1 for two empty ones."""
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    both = F.array_intersect(least, F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(least))


def kept_places(a: str, b: str) -> Column:
    """Number of anchors that two texts have at the same place, from their arrays of marks."""
    return F.size(F.array_intersect(a, b)).cast("long")


def successors(docs: DataFrame) -> DataFrame:
    """For every distinct row of ``docs`` (id, digest, key, n_chars) the document before it in descending order of id, then
    of digest, null ids last; the first follows the last. Columns: key, for_key, need, where ``need`` is a third of the
    length of the document before, rounded down. ``key`` stands for id and digest."""
    rows = docs.select("id", "digest", "key", "n_chars").distinct()
    placed = numbered(rows, [F.col("id").desc_nulls_last(), F.col("digest")], "nth")
    last = placed.agg(F.max("nth")).first()[0]  # one number
    after = F.when(F.col("nth") == F.lit(last), F.lit(0)).otherwise(F.col("nth") + 1).cast("long")
    before = placed.select(after.alias("nth"), F.col("key").alias("for_key"), F.floor(F.col("n_chars") / 3).alias("need"))
    return placed.join(before, "nth").select("key", "for_key", F.col("need").cast("int").alias("need"))


def fingerprint_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: fingerprints of a text and of its edit, and how alike they are.

    The edit replaces the last third of a text (code points, rounded down) by the start of the next document in descending
    order of id, up to the same length; the document after the last is the first. Columns: the id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next (likeness to the edit and to the next document).

    Null texts are empty. Null ids come last in the order; rows of equal id are ordered by the MD5 digest of their texts,
    and rows equal in both are one document of the order and all get its values. A single document is followed by itself.
    An empty table gives no rows. Other columns are ignored. Ids are of a type that survives a cast to string and back.

    Texts are exchanged once by (id, digest), with their fingerprints; that exchange serves the pass that cuts the heads of
    the next documents and the join that takes them in. Heads are at most as long as a third of the text before.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    n_chars = F.length("t").cast("long")
    rows = docs.select(F.col(id_column).alias("id"), text.alias("t")).withColumn("digest", F.md5("t"))
    name = F.when(F.isnull("id"), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("id").cast("string")))
    rows = rows.withColumn("key", F.concat("digest", name))
    chain = successors(rows.withColumn("n_chars", n_chars))
    # Both branches below take the same columns, so that they share one exchange.
    marked = with_marks(rows, "t", "marks").select("key", "t", fingerprint("marks").alias("fingerprint"))

    head = F.substring("t", F.lit(1), F.col("need")).alias("head")
    heads = marked.join(chain, "key").select("for_key", head, F.col("fingerprint").alias("next_print"))
    # Rows that repeat id and text give one head.
    firsts = [F.first("head").alias("head"), F.first("next_print").alias("next_print")]
    heads = heads.groupBy(F.col("for_key").alias("key")).agg(*firsts)

    kept = F.substring("t", F.lit(1), (n_chars - F.floor(n_chars / 3)).cast("int"))
    read_back = F.when(F.substring("key", 33, 1) == "=", F.expr("substring(key, 34)").cast(docs.schema[id_column].dataType))
    edited = marked.join(heads, "key").select(
        read_back.alias("id"), n_chars.alias("n_chars"), "fingerprint", "next_print", F.concat(kept, F.col("head")).alias("edited")
    )
    edited = with_marks(edited, "edited", "marks").select(
        "id", "n_chars", "fingerprint", "next_print", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("marks").alias("edited_fingerprint"),
    )
    for name in ("fingerprint", "edited_fingerprint", "next_print"):
        edited = with_sketch(edited, name, f"{name}_sketch")
    return edited.select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint_sketch", "edited_fingerprint_sketch").alias("near_edited"),
        likeness("fingerprint_sketch", "next_print_sketch").alias("near_next"),
    )


def marks_sql() -> str:
    """DuckDB: the list of marks in a query block that has tokens and digests of inner runs as lists ``w`` and ``g``."""
    inside = ", ".join(f"g[i + {k}]" if k else "g[i]" for k in range(LENGTH - INNER + 1))
    ends = f"g[i], g[i + {LENGTH - INNER}]"
    return f"""
CASE WHEN len(w) = 0 THEN []::VARCHAR[]
     WHEN len(w) < {LENGTH} THEN [left(md5(array_to_string(w, ' ')), {DIGITS}) || ':1']
     ELSE list_transform(
            list_filter(range(1, len(w) - {LENGTH - 2}), lambda i: least({inside}) IN ({ends})),
            lambda i: left(md5(array_to_string(w[i:i + {LENGTH - 1}], ' ')), {DIGITS}) || ':' || i::VARCHAR) END"""


def likeness_sql(a: str, b: str) -> str:
    least = f"list_sort(list_distinct(list_concat({a}, {b})))[1:{SKETCH}]"
    both = f"list_intersect({least}, list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE len({both})::DOUBLE / len({least}) END"


def edits_sql() -> str:
    """The same result over ``documents`` as one DuckDB query."""
    return f"""
WITH u AS (
  SELECT DISTINCT doc_id, COALESCE(text, '') AS t, md5(COALESCE(text, '')) AS h FROM documents),
o AS (
  SELECT *, length(t)::BIGINT AS n, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, h) AS r, COUNT(*) OVER () AS c FROM u),
e AS (
  SELECT a.doc_id, a.h, a.r, b.r AS next_r, a.n, a.t, left(a.t, a.n - a.n // 3) || left(b.t, a.n // 3) AS edited
  FROM o a JOIN o b ON b.r = a.r % a.c + 1),
s AS (SELECT r, 0 AS kind, t AS x FROM e UNION ALL SELECT r, 1, edited FROM e),
tokens AS (SELECT r, kind, regexp_extract_all(x, '{TOKEN}') AS w FROM s),
inner_runs AS (
  SELECT *, list_transform(range(1, len(w)), lambda i: md5(w[i] || ' ' || w[i + 1])) AS g FROM tokens),
marked AS (SELECT r, kind, {marks_sql()} AS m FROM inner_runs),
sketched AS (
  SELECT *, list_sort(list_distinct(list_transform(m, lambda y: left(y, {DIGITS}))))[1:{SKETCH}] AS k FROM marked),
j AS (
  SELECT e.doc_id, e.h, e.n, sha256(e.edited) AS edited_sha256, x.k, y.k AS ek, z.k AS nk
  FROM e
  JOIN sketched x ON x.r = e.r AND x.kind = 0
  JOIN sketched y ON y.r = e.r AND y.kind = 1
  JOIN sketched z ON z.r = e.next_r AND z.kind = 0)
SELECT d.doc_id, j.n AS n_chars, j.edited_sha256, array_to_string(k, '') AS fingerprint,
       array_to_string(ek, '') AS edited_fingerprint, {likeness_sql("k", "ek")} AS near_edited,
       {likeness_sql("k", "nk")} AS near_next
FROM documents d JOIN j ON d.doc_id IS NOT DISTINCT FROM j.doc_id AND md5(COALESCE(d.text, '')) = j.h"""
