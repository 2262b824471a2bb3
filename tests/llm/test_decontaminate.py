import random

import numpy as np

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm.decontaminate import GAP, LEAST_RUN, MATCH, MISMATCH, aligned, find_leaks


def plain(item, stretch):
    """Best local alignment by the textbook table: score."""
    best, above = 0, [0] * (len(stretch) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(stretch):
            row.append(max(0, above[j] + (MATCH if a == b else MISMATCH), above[j + 1] + GAP, row[j] + GAP))
        best, above = max(best, *row), row
    return best


def test_alignment_equals_the_table():
    rng = random.Random(2)
    pairs = [([rng.randrange(4) for _ in range(rng.randint(1, 12))], [rng.randrange(4) for _ in range(rng.randint(1, 30))]) for _ in range(200)]
    score, first, last = aligned([np.array(a) for a, _ in pairs], [np.array(b) for _, b in pairs])
    for (item, stretch), s, a, b in zip(pairs, score.tolist(), first.tolist(), last.tolist(), strict=True):
        assert s == plain(item, stretch)
        if s:  # the reported stretch alone has the score
            assert plain(item, stretch[a : b + 1]) == s


ITEM = [f"item{i}" for i in range(40)]


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, id string, item string, words string")


def test_copies_edited_copies_and_clean_texts(spark):
    rng = random.Random(4)
    edited = [w if rng.random() > 0.15 else "changed" for w in ITEM]
    dropped = [w for i, w in enumerate(ITEM) if i % 9]
    around = lambda words, k: " ".join([f"b{k}x{i}" for i in range(50)] + words + [f"a{k}x{i}" for i in range(70)])
    rows = [
        (1, around(ITEM, 1), "en", "a"),
        (2, around(edited, 2), "en", "a"),
        (3, around(dropped, 3).upper(), "en", "a"),
        (4, around(ITEM[:8], 4), "en", "a"),
        (5, around([], 5), "en", "a"),
        (6, around([*ITEM, "x", "y", *["z"] * 300, *ITEM], 6), "en", "a"),
    ]
    rows += [(100 + i, around(ITEM, 100 + i), "en", "a") for i in range(60)]  # a leak into many documents is no reason to miss it
    tests = items(spark, [(9, " ".join(ITEM), "", "", ""), (9, " ".join(ITEM), "", "", ""), (10, None, "", "", ""), (11, "two words", "", "", "")])
    found = find_leaks(documents(spark, rows), tests).collect()
    counts = {}
    for r in found:
        assert r.item_id == 9
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {1: 1, 2: 1, 3: 1, 6: 2} | {100 + i: 1 for i in range(60)}
    exact = next(r for r in found if r.doc_id == 1)
    assert rows[0][1][exact.start : exact.end] == " ".join(ITEM) and exact.similarity == 1.0


def traced(item, words):
    """Best local alignment by the full table with its steps: score, first and last word, matches in a row."""
    table = [[(0, j, 0) for j in range(len(words) + 1)]]  # score, first word, nothing yet
    best = (0, 0, -1)
    for a in item:
        row, above = [(0, 0)], table[-1]
        for j, b in enumerate(words):
            start = above[j][1] if above[j][0] else j
            options = [(above[j][0] + (MATCH if a == b else MISMATCH), start), (above[j + 1][0] + GAP, above[j + 1][1]), (row[j][0] + GAP, row[j][1])]
            top = max(options, key=lambda o: (o[0], -o[1]))
            row.append(top if top[0] > 0 else (0, j + 1))
            best = max(best, (row[-1][0], -row[-1][1], j), key=lambda o: (o[0], o[1], -o[2]))
        table.append(row)
    return best[0], -best[1], best[2]


def copies(item, words, low=0):
    """All copies by the plain rule: the best alignment, then those on either side of it."""
    score, first, last = traced(item, words)
    if score < min(len(item), MATCH * LEAST_RUN):
        return []
    part = words[first : last + 1]
    runs = {tuple(item[i : i + LEAST_RUN]) for i in range(len(item) - LEAST_RUN + 1)}
    in_a_row = any(tuple(part[i : i + LEAST_RUN]) in runs for i in range(len(part) - LEAST_RUN + 1))
    here = [(low + first, low + last)] if score >= len(item) or score >= 100 or in_a_row else []
    return copies(item, words[:first], low) + here + copies(item, words[last + 1 :], low + last + 1)


def test_equals_brute_force(spark):
    """Whole, partial, repeated and edited copies of items with words of their own, in texts of other words."""
    rng = random.Random(8)
    tests = {n: [f"t{n}w{i}" for i in range(length)] for n, length in enumerate([20, 40, 90, 160])}
    rows = []
    for doc in range(40):
        words = [f"o{rng.randrange(500)}" for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            item = tests[rng.randrange(4)]
            low = rng.randrange(len(item))
            part = item[low : low + rng.choice([5, 12, 13, 14, 30, 60, len(item)])]
            if rng.random() < 0.4:
                part = [w if rng.random() > 0.1 else f"e{rng.randrange(50)}" for w in part]
            words += part + [f"o{rng.randrange(500)}" for _ in range(rng.randint(0, 12))]
        rows.append((doc, " ".join(words), "en", "a"))
    found = find_leaks(documents(spark, rows), items(spark, [(n, " ".join(w), "", "", "") for n, w in tests.items()])).collect()
    got = sorted((r.doc_id, r.item_id, rows[r.doc_id][1][r.start : r.end]) for r in found)
    expected = []
    for doc, text, *_ in rows:
        words = text.split(" ")
        for n, item in tests.items():
            expected += [(doc, n, " ".join(words[a : b + 1])) for a, b in copies(item, words)]
    assert got == sorted(expected) and len(got) > 20


def test_parts_of_long_items_and_copies_side_by_side(spark):
    long = [f"long{i}" for i in range(400)]
    short = [f"short{i}" for i in range(40)]
    rows = [
        (1, " ".join(["before", *long[100:250], "after"]), "en", "a"),
        (2, " ".join([*short, "x", "y", *short, *short]), "en", "a"),
        (3, " ".join(long[:12]), "en", "a"),
    ]
    # The part of document 1 stands in many documents, so that its triples are the item's most frequent ones.
    rows += [(10 + i, " ".join(long[100:250]), "en", "a") for i in range(30)]
    found = find_leaks(documents(spark, rows), items(spark, [(5, " ".join(long), "", "", ""), (6, " ".join(short), "", "", "")])).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted([(1, 5), (2, 6), (2, 6), (2, 6)] + [(10 + i, 5) for i in range(30)])
    first = next(r for r in found if r.doc_id == 1)
    assert rows[0][1][first.start : first.end] == " ".join(long[100:250])


def test_edge_rows(spark):
    tests = items(spark, [(1, EDGE[0][1], "", "", ""), (None, EDGE[8][1], "", "", ""), (3, "", "", "", "")])
    found = sorted(((r.doc_id, r.item_id) for r in find_leaks(edge(spark), tests).collect()), key=str)
    assert found == sorted([(1, 1), (7, 1), (7, 1), (None, 1), (7, None)], key=str)
    assert find_leaks(empty(spark), tests).count() == 0
    assert find_leaks(edge(spark), tests.limit(0)).count() == 0
