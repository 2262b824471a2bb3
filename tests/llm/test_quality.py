import duckdb

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm.quality import JUDGE_SQL, judge_quality, repeat_words


def test_repeat_words():
    words = [f"w{i}" for i in range(20)]
    assert repeat_words(words) == 0
    assert repeat_words(words[:8] * 2) == 16
    assert repeat_words([*words, "x", *words[3:12]]) == 18
    assert repeat_words(["a"] * 9) == 9
    assert repeat_words(["a"] * 8) == 0


def test_equals_sql_with_hot_lines(spark):
    line = "This line stands in very many documents of one host indeed"
    own = "\n".join(" ".join(f"own{k}x{j}" for j in range(9)) for k in range(4))
    rows = [(i, f"{line}\n{own.replace('own', f'd{i}o')}\n{line if i % 2 else '# $ % * | <b>'}", "en", "a") for i in range(40)]
    rows += [(100 + i, "\n".join([line] * 3 + [f"tail {i} of it"]), "en", "a") for i in range(5)]
    rows += [(200 + i, f"{line}\n{own}", "en", "b") for i in range(10)]
    rows += [(300 + i, f"{line.upper()}  \n{own.replace('own', f'n{i}o')}", "en", None) for i in range(35)]
    found = judge_quality(documents(spark, rows)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    cursor = con.execute(JUDGE_SQL)
    names = [d[0] for d in cursor.description]
    assert sorted(tuple(r[n] for n in names) for r in found) == sorted(cursor.fetchall())
    assert {r.doc_id for r in found if r.kept} == {r[0] for r in rows if not 100 <= r[0] < 200 and not (r[0] < 40 and r[0] % 2)}


def test_edge_rows(spark):
    rows = judge_quality(edge(spark)).collect()
    assert len(rows) == len(EDGE)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for doc in (2, 3, 4):
        assert [(r.n_words, r.base_failed, r.kept) for r in by[doc]] == [(0, True, False)]
    assert by[5][0].n_words == 24_000 and by[5][0].kept
    assert len(by[7]) == 3 and len(by[None]) == 2
    assert judge_quality(empty(spark)).count() == 0
