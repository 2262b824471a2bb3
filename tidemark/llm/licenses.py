"""Licence scan: lines and whole files are compared with licence notices, and files without a notice inherit one.

Notices and lines are sparse TF-IDF vectors; the terms' weights come from the notices, and a term of none of them counts as
the rarest. All of it is column expressions within the row. A file that is a notice as a whole speaks for its directory, and
every file without a notice of its own inherits from the nearest directory above it that has one.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Names and customary notices of public licences.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights. CC0 1.0 Universal."),
    ("EPL-2.0", "Made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Cosine from which a line is a notice, and a whole file a licence file.
LEAST_LINE, LEAST_FILE = 0.7, 0.5


def terms(text: str) -> Counter:
    return Counter(re.findall(TERM, text.lower()))


class Notices:
    """Weights of terms and unit vectors of notices."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        counts = [terms(text) for _, text in templates]
        among = Counter(t for c in counts for t in c)
        self.unknown = math.log(1 + len(templates)) + 1
        self.idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in sorted(among.items())}
        self.vectors = []
        for (name, _), count in zip(templates, counts, strict=True):
            weights = {t: n * self.idf[t] for t, n in count.items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            self.vectors.append((name, {t: w / norm for t, w in sorted(weights.items())}))

    def needed(self, least: float) -> set[str]:
        """Terms of which every text with at least this cosine to a notice has one: without them the rest is too light."""
        found = set()
        for _, unit in self.vectors:
            left = 1.0
            for t, w in sorted(unit.items(), key=lambda x: (-x[1], x[0])):
                if left < least * least * (1 - 1e-9):
                    break
                found.add(t)
                left -= w * w
        return found

    def pattern(self, least: float) -> str:
        """The needed terms as an expression, by their first letters."""
        by_letter: dict[str, list[str]] = {}
        for t in sorted(self.needed(least)):
            by_letter.setdefault(t[0], []).append(re.escape(t[1:]))
        return "(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_letter.items()) + ")(?![a-z0-9])"


def ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def weight_map(weights: dict[str, float]) -> Column:
    return F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))


def squares(sorted_terms: Column) -> Column:
    """Sum of the squared counts of equal terms in a sorted array."""
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))

    def merge(state: Column, term: Column) -> Column:
        run = F.when(term == state["last"], state["run"] + 1).otherwise(F.lit(1.0))
        return F.struct(term.alias("last"), run.alias("run"), (state["total"] + 2 * run - 1).alias("total"))

    return F.aggregate(sorted_terms, start, merge, lambda state: state["total"])


def best_notice(docs: DataFrame, text: str, notices: Notices) -> DataFrame:
    """Adds ``best``: for every line that may be a notice, and the whole text last, the score and name of its best notice.

    Texts without any term that even a whole file needs have an empty array.
    """
    idf = weight_map(notices.idf)
    templates = F.array(*(F.struct(F.lit(n).alias("name"), weight_map(w).alias("weights")) for n, w in notices.vectors))
    total = lambda values, weight: F.aggregate(values, F.lit(0.0), lambda a, v: a + weight(v))
    known = lambda t: t.isin(list(notices.idf))
    counted = lambda own: F.transform(
        F.array_distinct(own),
        lambda t: F.struct(t.alias("t"), (F.size(F.filter(own, lambda x: x == t)) * F.try_element_at(idf, t)).alias("w")),
    )

    def cosine(v: Column, unit: Column) -> Column:
        dot = total(v["terms"], lambda k: k["w"] * F.coalesce(F.try_element_at(unit, k["t"]), F.lit(0.0)))
        return F.round(F.when(v["norm"] > 0, dot / v["norm"]).otherwise(0.0), 6)

    low = docs.withColumn("_low", ascii_lower(F.col(text)))
    possible = F.filter(F.split("_low", "\n"), lambda line: line.rlike(notices.pattern(LEAST_LINE)))
    units = F.when(F.col("_low").rlike(notices.pattern(min(LEAST_LINE, LEAST_FILE))), F.concat(possible, F.array("_low"))).otherwise(F.array().cast("array<string>"))
    steps = {
        "_tokens": F.transform(units, lambda u: F.regexp_extract_all(u, F.lit(TERM), F.lit(0))),
        "_parts": F.transform(
            "_tokens",
            lambda ts: F.struct(F.filter(ts, known).alias("own"), squares(F.sort_array(F.filter(ts, lambda t: ~known(t)))).alias("other")),
        ),
        "_terms": F.transform("_parts", lambda p: F.struct(counted(p["own"]).alias("terms"), p["other"].alias("other"))),
        "_norms": F.transform(
            "_terms",
            lambda v: F.struct(
                v["terms"].alias("terms"),
                F.sqrt(total(v["terms"], lambda k: k["w"] * k["w"]) + notices.unknown**2 * v["other"]).alias("norm"),
            ),
        ),
        "best": F.transform(
            "_norms",
            lambda v: F.array_max(F.transform(templates, lambda n: F.struct(cosine(v, n["weights"]).alias("score"), n["name"].alias("name")))),
        ),
    }
    for name, step in steps.items():
        low = low.withColumn(name, step)
    return low.drop("_low", *(n for n in steps if n != "best"))


def above(directory: Column) -> Column:
    """The directory and all directories above it, the root (empty) included, as (depth, directory)."""
    parts = F.split(directory, "/")
    chain = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("dir")))
    return F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("dir"))), F.when(directory == "", F.slice(chain, 1, 0)).otherwise(chain))


def scan_licenses(files: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str = "path") -> DataFrame:
    """One row per input row: id, path, own licence with its score and number of notice lines, and the licence that holds.

    ``own_license`` is the notice of the best line (of equal scores the last name), or of the whole text if no line is one.
    A file is a licence file if its whole text is similar to a notice; of several in a directory the best one counts, then
    the last name. A file without a licence of its own inherits from the nearest directory above it. ``license`` is the
    own or the inherited one, null if there is none. Null and empty texts have no notice; a null path is in the root
    directory; repeated rows and ids are files of their own; other columns are ignored.
    """
    notices = Notices()
    path = F.coalesce(F.col(path_column), F.lit(""))
    directory = F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")
    rows = files.select(F.col(id_column).alias("id"), F.col(path_column).alias("path"), directory.alias("dir"), F.col(text_column).alias("t"))
    scored = best_notice(rows, "t", notices)
    whole = F.try_element_at("best", F.lit(-1))
    lines = F.filter(F.slice("best", 1, F.greatest(F.size("best") - 1, F.lit(0))), lambda b: b["score"] >= LEAST_LINE)
    scored = scored.withColumns({"lines": lines, "whole": F.when(whole["score"] >= LEAST_FILE, whole)})
    own = F.coalesce(F.array_max("lines"), F.col("whole"))
    found = stored(
        scored.select("id", "path", "dir", F.greatest(F.size("lines"), F.lit(0)).cast("long").alias("n_notices"), own.alias("own"), "whole"),
        "license-found",
    )
    spoken = found.where(F.col("whole").isNotNull()).groupBy("dir").agg(F.max("whole")["name"].alias("name"))
    spoken = stored(spoken, "license-directories")
    chains = found.select("dir").distinct().select("dir", F.explode(above(F.col("dir"))).alias("up"))
    nearest = chains.join(spoken.withColumnRenamed("dir", "up_dir"), F.col("up.dir") == F.col("up_dir"))
    nearest = nearest.groupBy("dir").agg(F.max(F.struct("up.depth", "up.dir", "name")).alias("near"))
    nearest = stored(nearest.select("dir", F.col("near.dir").alias("from"), F.col("near.name").alias("inherited")), "license-nearest")
    out = found.join(nearest, "dir", "left")
    alone = F.col("own").isNull()
    return out.select(
        F.col("id").alias(id_column),
        F.col("path").alias(path_column),
        F.col("own.name").alias("own_license"),
        F.col("own.score").alias("own_score"),
        "n_notices",
        F.col("whole").isNotNull().alias("is_license_file"),
        F.when(alone, F.col("inherited")).alias("inherited_license"),
        F.when(alone, F.col("from")).alias("inherited_from"),
        F.coalesce(F.col("own.name"), F.col("inherited")).alias("license"),
    )


#: The documents have no paths; this gives each a place in a tree of source, language and hundreds of documents.
PATH_SQL = """concat(coalesce(source, 'none'), '/',
    CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 3 = 0 THEN concat(coalesce(lang, 'none'), '/')
         ELSE concat(coalesce(lang, 'none'), '/', CAST(floor(doc_id / 100.0) AS BIGINT), '/') END, doc_id, '.txt')"""


def check_sql() -> str:
    """The query over ``documents`` in SQL: all vectors by joins, without the shortcuts."""
    notices = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    return f"""
WITH n(k, name, txt) AS (VALUES {notices}),
nt AS (SELECT k, name, unnest(regexp_extract_all({lower("txt")}, '{TERM}')) AS t FROM n),
nc AS (SELECT k, name, t, COUNT(*) AS tf FROM nt GROUP BY ALL),
total AS (SELECT COUNT(*) AS c FROM n),
idf AS (SELECT t, ln((1.0 + ANY_VALUE(c)) / (1 + COUNT(*))) + 1 AS idf FROM nc, total GROUP BY t),
nw AS (SELECT k, name, t, tf * idf AS w FROM nc JOIN idf USING (t)),
nu AS (SELECT k, name, t, w / sqrt(SUM(w * w) OVER (PARTITION BY k)) AS w FROM nw),
d AS (SELECT doc_id, {PATH_SQL} AS path, {lower("coalesce(text, '')")} AS txt FROM documents),
u AS (SELECT doc_id, 0 AS u, txt FROM d
      UNION ALL SELECT doc_id, u, txt FROM (
        SELECT doc_id, unnest(range(1, len(string_split(txt, chr(10))) + 1)) AS u, unnest(string_split(txt, chr(10))) AS txt FROM d)),
ut AS (SELECT doc_id, u, unnest(regexp_extract_all(txt, '{TERM}')) AS t FROM u),
uc AS (SELECT doc_id, u, t, COUNT(*) AS tf FROM ut GROUP BY ALL),
uw AS (SELECT doc_id, u, uc.t, tf * COALESCE(idf, ln(1.0 + c) + 1) AS w FROM uc LEFT JOIN idf ON idf.t = uc.t, total),
un AS (SELECT doc_id, u, sqrt(SUM(w * w)) AS norm FROM uw GROUP BY ALL),
cosines AS (SELECT uw.doc_id, uw.u, name, round(SUM(uw.w * nu.w) / ANY_VALUE(norm), 6) AS score
        FROM uw JOIN nu ON nu.t = uw.t JOIN un ON un.doc_id = uw.doc_id AND un.u = uw.u GROUP BY uw.doc_id, uw.u, k, name),
best AS (SELECT doc_id, u, MAX(score) AS score, arg_max(name, (score, name)) AS name FROM cosines GROUP BY ALL),
lines AS (SELECT doc_id, COUNT(*) AS n, MAX(score) AS score, arg_max(name, (score, name)) AS name
          FROM best WHERE u > 0 AND score >= {LEAST_LINE} GROUP BY doc_id),
whole AS (SELECT doc_id, score, name FROM best WHERE u = 0 AND score >= {LEAST_FILE}),
f AS (SELECT d.doc_id, d.path, regexp_replace(d.path, '/[^/]*$', '') AS dir, COALESCE(lines.n, 0) AS n_notices,
        COALESCE(lines.name, whole.name) AS own_license, COALESCE(lines.score, whole.score) AS own_score,
        whole.name AS whole_name, whole.score AS whole_score
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN whole USING (doc_id)),
spoken AS (SELECT dir, arg_max(whole_name, (whole_score, whole_name)) AS name FROM f WHERE whole_name IS NOT NULL GROUP BY dir),
near AS (SELECT f.dir, arg_max(s.dir, length(s.dir)) AS up, arg_max(s.name, length(s.dir)) AS name
         FROM (SELECT DISTINCT dir FROM f) f JOIN spoken s ON f.dir = s.dir OR starts_with(f.dir, s.dir || '/') GROUP BY f.dir)
SELECT doc_id, path, own_license, own_score, n_notices, whole_name IS NOT NULL AS is_license_file,
       CASE WHEN own_license IS NULL THEN near.name END AS inherited_license,
       CASE WHEN own_license IS NULL THEN near.up END AS inherited_from, COALESCE(own_license, near.name) AS license
FROM f LEFT JOIN near USING (dir)"""
