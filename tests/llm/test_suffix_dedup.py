import hashlib
import random

import numpy as np
import pytest

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm.suffix_dedup import LAST_ID, LENGTH, SPREAD, maximal_repeats, remove_earlier_strings, runs


def plain(rows):
    """Every window of every text in a dictionary of its first id."""
    texts = [(LAST_ID if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for doc, text in texts:
        for j in range(len(text) - LENGTH + 1):
            window = text[j : j + LENGTH]
            first[window] = min(doc, first.get(window, LAST_ID))
    out = []
    for (doc, _), (i, text) in zip(rows, texts, strict=True):
        gone = np.zeros(len(text), bool)
        for j in range(len(text) - LENGTH + 1):
            if first[text[j : j + LENGTH]] < i:
                gone[j : j + LENGTH] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_runs_cover_every_window_once():
    rng = random.Random(1)
    for text in ("a" * 300, "ab" * 200, "".join(rng.choices("abc", k=500)), "x" * 50, "x" * 49, ""):
        data = np.frombuffer(text.encode(), np.uint8)
        hashes, starts, ends = runs(data)
        covered = [j for a, b in zip(starts, ends, strict=True) for j in range(a, b)]
        assert covered == list(range(max(0, len(data) - LENGTH + 1)))
        assert all(b - a <= SPREAD for a, b in zip(starts, ends, strict=True))


def test_maximal_repeats_equal_all_pairs():
    rng = random.Random(7)
    block = "".join(rng.choices("ab", k=60))
    texts = [("".join(rng.choices("ab", k=rng.randint(0, 6))) + block + "".join(rng.choices("ab", k=rng.randint(0, 6)))).encode() for _ in range(12)]
    texts = sorted(set(texts))
    groups = list(maximal_repeats(texts, list(range(len(texts)))))
    assert groups
    seen = set()
    for size, places, first in groups:
        strings = {texts[i][o : o + size] for i, o in places}
        assert len(strings) == 1 and first == min(i for i, _ in places)
        string = strings.pop()
        every = {(i, o) for i, t in enumerate(texts) for o in range(len(t) - size + 1) if t[o : o + size] == string}
        assert set(places) == every  # all occurrences, not just neighbours
        lefts = {texts[i][o - 1] if o else (i, o) for i, o in places}
        rights = {texts[i][o + size] if o + size < len(texts[i]) else (i, o) for i, o in places}
        assert len(lefts) > 1 and len(rights) > 1
        seen.add(string)
    expected = set()
    for a in range(len(texts)):
        for b in range(len(texts)):
            for x in range(len(texts[a]) - LENGTH + 1):
                for y in range(len(texts[b]) - LENGTH + 1):
                    if (a, x) < (b, y) and texts[a][x : x + LENGTH] == texts[b][y : y + LENGTH]:
                        if x and y and texts[a][x - 1] == texts[b][y - 1]:
                            continue
                        n = LENGTH
                        while x + n < len(texts[a]) and y + n < len(texts[b]) and texts[a][x + n] == texts[b][y + n]:
                            n += 1
                        expected.add(texts[a][x : x + n])
    assert seen == expected


@pytest.mark.parametrize("hot", [1, 4096])
def test_equals_brute_force(spark, hot):
    rng = random.Random(11)
    prose = lambda n: " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 5))) for _ in range(n))
    common, passages = prose(30), [prose(25) for _ in range(6)]
    rows = []
    for i in range(150):
        parts = [prose(rng.randint(0, 40))]
        if i % 3 == 0:
            parts.append(common)
        if i % 4 == 0:
            parts += [rng.choice(passages), prose(3)]
        if i % 10 == 0:
            parts.append("ab" * rng.randint(20, 60) + "z" * rng.randint(40, 120))
        rows.append((i, rng.choice(["", " "]).join(parts)))
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [(3, rows[3][1]), (3, passages[0]), (None, passages[1]), (None, passages[1])]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows], 5)
    assert found(remove_earlier_strings(docs, hot=hot)) == plain(rows)


def test_edge_rows(spark):
    assert found(remove_earlier_strings(edge(spark))) == plain([(r[0], r[1]) for r in EDGE])
    assert remove_earlier_strings(empty(spark)).count() == 0
