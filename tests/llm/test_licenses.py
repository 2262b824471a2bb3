import re

import duckdb
from pyspark.sql import functions as F

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm.licenses import PATH_SQL, Notices, check_sql, scan_licenses, terms

MIT, APACHE, GPL = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under the GNU GPL"


def test_texts_without_needed_terms_are_unlike_every_notice():
    notices = Notices()
    for least in (0.5, 0.7):
        for _, unit in notices.vectors:
            rest = sum(w * w for t, w in unit.items() if t not in notices.needed(least)) ** 0.5
            assert rest < least
        assert all(re.search(notices.pattern(least), f"x {t}, y") for t in notices.needed(least))
    assert terms("CC BY-NC 4.0.") == {"cc": 1, "by": 1, "nc": 1, "4.0": 1}


def test_nearest_directory_above_counts(spark):
    rows = [
        ("a/LICENSE", MIT),
        ("a/b/LICENSE", APACHE),
        ("a/x.py", "no notice here at all"),
        ("a/b/c/d/y.py", "none here either"),
        ("a/b/own.py", f"# file\n# {MIT}\ncode follows here and there, none of it about law, " * 3),
        ("ab/z.py", "another tree"),
        ("top.py", "in the root"),
        (None, None),
    ]
    files = spark.createDataFrame([(i, p, t, "clash") for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, dir string")
    found = {r.doc_id: (r.own_license, r.inherited_license, r.inherited_from, r.license) for r in scan_licenses(files).collect()}
    assert found == {
        0: ("MIT", None, None, "MIT"),
        1: ("Apache-2.0", None, None, "Apache-2.0"),
        2: (None, "MIT", "a", "MIT"),
        3: (None, "Apache-2.0", "a/b", "Apache-2.0"),
        4: ("MIT", None, None, "MIT"),
        5: (None,) * 4,
        6: (None,) * 4,
        7: (None,) * 4,
    }


def test_equals_sql(spark):
    rows = [(i, f"{'Words of the text. ' * (i % 5)}\n{(MIT, APACHE, GPL, MIT.upper(), 'This is the version of it.', '')[i % 6]}", "en", "ab"[i % 2]) for i in range(60)]
    rows += [(100, APACHE, "de", "a"), (105, MIT, None, None), (103, None, "en", "a"), (104, "", "en", "a")]
    docs = documents(spark, rows).select("doc_id", "text", F.expr(PATH_SQL).alias("path"))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    cursor = con.execute(check_sql())
    names = [d[0] for d in cursor.description]
    found = sorted((tuple(r[n] for n in names) for r in scan_licenses(docs).collect()), key=str)
    assert found == sorted(cursor.fetchall(), key=str)
    assert any(r[names.index("inherited_license")] for r in found)


def test_edge_rows(spark):
    files = edge(spark).withColumn("path", F.concat(F.lit("d/"), F.col("doc_id")))
    rows = scan_licenses(files).collect()
    assert len(rows) == len(EDGE) and all(r.license is None and r.n_notices == 0 for r in rows)
    assert scan_licenses(empty(spark).withColumn("path", F.lit("a/b"))).count() == 0
