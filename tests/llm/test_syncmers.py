import hashlib
import re

from pyspark.sql import functions as F

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm.common import table
from tidemark.llm.syncmers import DIGITS, LENGTH, SKETCH, TOKEN, fingerprint, fingerprint_edits, kept_places, with_marks


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain_marks(text):
    """All runs of tokens, chosen by comparing the digests of all their inner runs."""
    words = re.findall(TOKEN, text)
    if len(words) < LENGTH:
        return [md5(" ".join(words))[:DIGITS] + ":1"] if words else []
    out = []
    for i in range(len(words) - LENGTH + 1):
        inner = [md5(f"{words[k]} {words[k + 1]}") for k in range(i, i + LENGTH - 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(f"{md5(' '.join(words[i : i + LENGTH]))[:DIGITS]}:{i + 1}")
    return out


def plain_sketch(text):
    return sorted({m[:DIGITS] for m in plain_marks(text)})[:SKETCH]


def near(a, b):
    least = sorted({*a, *b})[:SKETCH]
    return 1.0 if not least else len([x for x in least if x in a and x in b]) / len(least)


def brute(rows):
    """Expected rows for (id, text): the order, the edits and the likenesses written out."""
    order = sorted({(i, md5(t or ""), t or "") for i, t in rows}, key=lambda r: r[1])
    order = sorted(order, key=lambda r: (r[0] is None, -(r[0] or 0)))
    after = {r: order[(k + 1) % len(order)] for k, r in enumerate(order)}
    out = []
    for i, t in rows:
        text, follower = t or "", after[i, md5(t or ""), t or ""][2]
        third = len(text) // 3
        edited = text[: len(text) - third] + follower[:third]
        a, b, c = plain_sketch(text), plain_sketch(edited), plain_sketch(follower)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(text), sha, "".join(a), "".join(b), near(a, b), near(a, c)))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").where("length(text) < 5000").collect()]
    rows += [(10**6, "東京は日本の首都です。大阪も大きな都市です。"), (10**6 + 1, "a\tb\nc d e f g h")]
    assert len(rows) > 100
    assert found(fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)


def test_edge_rows(spark):
    short = [r for r in EDGE if len(r[1] or "") < 1000]
    assert found(fingerprint_edits(documents(spark, short))) == brute([r[:2] for r in short])
    assert found(fingerprint_edits(edge(spark))) == brute([r[:2] for r in EDGE])
    assert fingerprint_edits(empty(spark)).count() == 0
    (single,) = fingerprint_edits(documents(spark, [(1, "one text alone", "en", "a")])).collect()
    assert (single.near_edited < 1.0, single.near_next) == (True, 1.0)


def test_edits_keep_anchors_outside_and_places(spark):
    words = [f"w{i}" for i in range(400)]
    changed = [*words[:200], "inserted", *words[200:]]
    frame = spark.createDataFrame([(" ".join(words), " ".join(changed))], "a string, b string")
    marked = with_marks(with_marks(frame, "a", "x"), "b", "y")
    row = marked.select("x", "y", kept_places("x", "y").alias("kept"), fingerprint("x").alias("f")).first()
    before, after = ({m[:DIGITS] for m in marks} for marks in (row.x, row.y))
    assert len(before - after) <= LENGTH and 0.35 < len(before) / 400 < 0.65
    assert row.kept == len(set(row.x) & set(row.y)) >= len([m for m in row.x if int(m.split(":")[1]) <= 195])


def test_main_path_has_no_python(spark):
    docs = documents(spark, [(i, f"text number {i} with a few words more", "en", "a") for i in range(20)]).select("doc_id", F.upper("text").alias("text"))
    plan = fingerprint_edits(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
