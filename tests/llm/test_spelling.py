import random
import re
import zlib
from collections import Counter

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm import spelling
from tidemark.llm.spelling import group_variants, near_in, near_words


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    v = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in v if abs(len(x) - len(w)) < 2 and edits(w, x) == 1] for w in v}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-v[x], x))
            if v[best] >= 2 * v[w]:
                form[w] = best
    out = set()
    for w in v:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, v[w], len(near[w]), v.get(form.get(w))))
    return out


def found(frame):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_scan_equals_all_pairs():
    random.seed(5)
    for letters, most in (("ab", 6), ("abcé", 5), ("aß", 12)):
        words = sorted({"".join(random.choices(letters, k=random.randint(0, most))) for _ in range(150)})
        pairs = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if edits(words[i], words[j]) == 1}
        got = list(near_in(words))
        assert set(got) == pairs and len(got) == len(pairs)


def random_rows(seed):
    random.seed(seed)
    base = ["".join(random.choices("abcdeéü", k=random.randint(4, 8))) for _ in range(30)]
    rows = []
    for i in range(200):
        words = []
        for w in random.choices(base, weights=[1 / (k + 1) for k in range(30)], k=25):
            if random.random() < 0.3:
                k = random.randrange(len(w))
                w = random.choice([w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + "É" + w[k + 1 :], w.upper()])
            words.append(w)
        rows.append((i, random.choice([" ", "-", "\n"]).join(words)))
    return rows


def test_equals_brute_force(spark):
    rows = random_rows(1) + [(None, "Straße straße STRASSE"), (3, None), (900, "kitten " * 3 + "kitteng " * 6 + "kittengs " * 12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute(rows)
    assert len(expected) > 100 and any(r[1] and r[1] != r[2] for r in expected)
    assert found(group_variants(frame)) == expected


def test_split_lists_lose_no_pair(spark, monkeypatch):
    random.seed(2)
    words = {"ab" + "".join(random.choices("abc", k=random.randint(3, 5))) + "yz": random.randint(3, 9) for _ in range(250)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = {(a, b) for a in words for b in words if a < b and edits(a, b) == 1}
    for size in (1 << 15, 10):
        monkeypatch.setattr(spelling, "PART", size)
        got = [tuple(sorted((r.a, r.b))) for r in near_words(frame).collect()]
        assert set(got) == expected and len(got) == len(expected)


def test_edge_rows(spark):
    assert found(group_variants(edge(spark))) == brute([r[:2] for r in EDGE])
    assert group_variants(empty(spark)).count() == 0
    long = "a" * 200_000
    rows = [(1, f"{long} {long} {long}b {long}b {long} {long}b"), (2, "×÷ÿÞ×÷ÿÞ " * 4)]
    assert found(group_variants(documents(spark, [(*r, "en", "a") for r in rows]))) == brute_long(rows)


def brute_long(rows):
    """As ``brute``, for words too long for a full matrix: here they differ in their last letter at most."""
    long = max((w for _, t in rows for w in t.split()), key=len)
    return {(long[:-1], None, long[:-1], 3, 1, None), (long, None, long, 3, 1, None), ("×÷ÿÞ×÷ÿÞ", None, "×÷ÿÞ×÷ÿÞ", 4, 0, None)}
