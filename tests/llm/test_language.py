import zlib

import numpy as np

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm.language import ORDER, START, Model, held_out, identify_language, pieces


def test_probabilities_of_a_context_add_up_to_one():
    grams, counts = np.unique(np.concatenate([k for k, _ in pieces(["abracadabra banana", "cabana band", "add a dab"])]), return_counts=True)
    model = Model(grams, counts)
    symbols = np.unique(grams & np.uint64(0xFFFF))
    unseen = np.uint64(0x4E00)
    for context in np.unique(grams >> np.uint64(16)).tolist() + [0x6100620063]:
        every = np.array([context << 16 | int(s) for s in [*symbols, unseen]], np.uint64)
        assert abs(np.exp(model.logs(every)).sum() - 1) < 1e-5


def test_grams_start_with_the_text_and_stay_in_it():
    found = list(pieces(["Ab", None, "", "  c!d "]))
    assert len(found) == 1
    keys, owner = found[0]
    texts = ["".join(chr(int(k) >> 16 * (ORDER - 1 - i) & 0xFFFF) for i in range(ORDER)) for k in keys]
    s = chr(START)
    assert list(zip(owner.tolist(), texts, strict=True))[:2] == [(0, f"{s * 3}a"), (0, f"{s * 2}ab")]
    assert [t for o, t in zip(owner, texts, strict=True) if o == 3] == [f"{s * 3}c", f"{s * 2}c ", f"{s}c d", "c d "]


def test_held_out_is_by_crc(spark):
    rows = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert [r.h for r in rows] == [zlib.crc32(str(r.id).encode()) % 4 == 2 for r in rows]


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = identify_language(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert len(out) > 20
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)
    assert not any(r.rejected for r in rows if any(map(str.isalpha, r.text or "")))
    # Labels, sources and ids of what is predicted are no inputs.
    hidden = docs.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN NULL ELSE lang END AS lang", "text")
    again = {r.doc_id: r.lang_pred for r in identify_language(hidden).collect()}
    assert again == {r.doc_id: r.lang_pred for r in rows}


def test_foreign_texts_are_rejected(spark):
    english = "the cat sat on the mat and the dog ran to the house with a ball in its mouth "
    rows = [(i, english * (1 + i % 3), "en", "a") for i in range(60)]
    rows += [(100, "это совсем другой язык, которого модель не знает", None, "a"), (101, "щ" * 50, None, "a")]
    found = {r.doc_id: r.rejected for r in identify_language(documents(spark, rows)).collect()}
    assert found == {i: False for i in range(60)} | {100: True, 101: True}


def test_every_gram_counts(spark):
    """Entropies are those of whole models: grams seen once among 1.5 million are in them too."""
    words = lambda i, k: " ".join(f"{'abcdefghij'[(i * j) % 10]}{'klmnopqrst'[(i + j * j) % 10]}{'uvw'[j % 3]}" for j in range(k))
    rows = [(i, words(i, 2500), ("xx", "yy")[i % 2], "a") for i in range(400)] + [(1000, "Zyzzyva quixotry", "xx", "a")]
    rows += [(2000, "zyzzyva quixotry", None, "a"), (2001, "zygote, 一二三四", None, "a"), (2002, "...", None, "a")]
    found = {r.doc_id: r for r in identify_language(documents(spark, rows)).collect()}
    models = {}
    for lang in ("xx", "yy"):
        own = [t for i, t, x, _ in rows if x == lang and not found[i].held_out]
        models[lang] = Model(*np.unique(np.concatenate([k for k, _ in pieces(own)]), return_counts=True))
    for i, text, _, _ in rows[-4:-1] + rows[:4]:
        entropies = {lang: -np.concatenate([m.logs(k) for k, _ in pieces([text])]).mean() for lang, m in models.items()}
        best = min(entropies, key=entropies.get)
        assert (found[i].lang_pred, round(found[i].cross_entropy, 4)) == (best, round(entropies[best], 4))
    assert not found[1000].held_out and found[2000].cross_entropy < 1.5
    assert found[2002].lang_pred == "und"


def test_edge_rows(spark):
    rows = identify_language(edge(spark)).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        if r.doc_id in (2, 3, 4, 8):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert {r.lang_pred for r in rows} <= {"und", "en", "fr"}
    assert identify_language(empty(spark)).count() == 0
    alone = identify_language(documents(spark, [(1, "some text", None, "a")])).collect()
    assert [(r.lang_pred, r.rejected) for r in alone] == [("und", True)]
