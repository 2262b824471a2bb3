import re

import pytest

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm.mixing import mix_sources


def sizes(rows):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]


def targets(by_source):
    """Fill by weight until no source is above three times its size, by repeated sharing."""
    names = sorted((s for s in by_source if s is not None), key=lambda s: s.encode()) + [None] * (None in by_source)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        left = sum(by_source.values()) - sum(fixed.values())
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if shares[s] > 3 * by_source[s]]
        if not above:
            return shares | fixed
        fixed |= {s: 3 * by_source[s] for s in above}


def by_source(rows):
    out = {}
    for row, size in zip(rows, sizes(rows), strict=True):
        out[row[3]] = out.get(row[3], 0) + size
    return out


def corpus():
    rows = []
    for i in range(900):
        source = ("a", "é", "B", None, "z", "tiny")[min(i % 7, 5) if i < 860 else 4]
        n = 3 if source == "tiny" else 5 + (i * 7919) % 83 + (400 if i % 50 == 0 else 0)
        rows.append((i, " ".join(["w"] * n), "en", source))
    return rows


@pytest.fixture(scope="module")
def mixed(spark):
    return mix_sources(documents(spark, corpus())).collect()


def test_targets_and_limits(mixed):
    rows, expected = corpus(), targets(by_source(corpus()))
    sources = {r[0]: r[3] for r in rows}
    size = dict(zip((r[0] for r in rows), sizes(rows), strict=True))
    taken = {}
    for r in mixed:
        s = sources[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == by_source(rows)[s]
        assert r.target == pytest.approx(expected[s])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, words in taken.items():
        assert words == pytest.approx(expected[s], rel=0.02)


def test_rates_are_exponential_in_size(mixed):
    import math

    sources = {r[0]: r[3] for r in corpus()}
    slopes = {}
    for r in mixed:
        if r.size and r.rate < 3:
            slopes.setdefault(sources[r.doc_id], []).append(math.log(r.rate) / r.size)
    assert all(max(s) - min(s) < 1e-9 for s in slopes.values())


def test_reruns_agree(spark, mixed):
    again = mix_sources(documents(spark, corpus(), 7)).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in mixed}


def test_edge_rows(spark):
    rows = mix_sources(edge(spark)).collect()
    expected, words = targets(by_source(EDGE)), by_source(EDGE)
    assert sorted((r.doc_id, r.size) for r in rows if r.doc_id) == sorted((r[0], n) for r, n in zip(EDGE, sizes(EDGE), strict=True) if r[0])
    assert {(r.source_size, round(r.target, 6)) for r in rows} == {(words[s], round(expected[s], 6)) for s in words}
    assert all(r.taken <= 3 * r.size for r in rows)
    assert mix_sources(empty(spark)).count() == 0
    assert [r.taken for r in mix_sources(documents(spark, [(1, None, None, None), (2, "", "en", "a")])).collect()] == [0, 0]
