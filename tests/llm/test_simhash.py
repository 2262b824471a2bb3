import random
import re

import numpy as np
import xxhash

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.simhash import bit_planes, fingerprint, forest, near, near_duplicates


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)][: len(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs):
    """Smallest id reachable, by comparing all with all."""
    parent = list(range(len(pairs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        known = [x for x in (least.get(find(i)), doc) if x is not None]
        least[find(i)] = min(known) if known else None
    return sorted(((doc, f"{p:016x}", least[find(i)]) for i, (doc, p) in enumerate(pairs)), key=str)


def test_fingerprints():
    for text in ("", "One", "ONE two", "a b c a b c a b c", "É e x\u0085y z \x0b w", EDGE[4][1]):
        assert fingerprint(text) == plain(text)


def test_planes_find_exactly_the_near_ones():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 64, 5, dtype=np.uint64)
    prints = np.array([b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, d, False))) for b in base for d in range(9) for _ in range(4)])
    for radius in (0, 1, 2, 3, 4, 6):
        active, words = near(bit_planes(prints), prints, radius)
        found = np.zeros((len(prints), len(prints)), bool)
        found[active] = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")[:, : len(prints)]
        assert (found == (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius)).all()


def test_forest_is_small_and_connects():
    prints = np.array([1 << k for k in range(40)] + [0], np.uint64)
    links = forest(prints)
    assert len(links) == len(prints) - 1


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, 1000 + i) for i in range(50)]
    rows = [*path, *star, (5, 5), (3, None), (7, 1000)]
    random.Random(1).shuffle(rows)
    found = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    expected = {i: 100 for i in range(100, 161)} | {7: 7, 5: 5} | {1000 + i: 7 for i in range(50)}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_rows(spark):
    rows = near_duplicates(edge(spark)).collect()
    expected = classes([(r[0], plain(r[1])) for r in EDGE])
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=str) == expected
    assert near_duplicates(empty(spark)).count() == 0


def test_split_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 8)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        copy = list(words)
        copy[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(copy), "en", "a"))
    rows += [(1000 + i, " ".join(rng.choices(words, k=40)), "en", "a") for i in range(40)]
    found = near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == classes([(r[0], plain(r[1])) for r in rows])
