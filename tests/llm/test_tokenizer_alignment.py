import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm import tokenizer_alignment
from tidemark.llm.common import table
from tidemark.llm.tokenizer_alignment import FILES, align_tokens, segments


def spelled(text):
    """Tokens of a text as (id, start, end) for both tokenizers, from their own byte tables."""
    a, b = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a.encode_special_tokens = True
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    decode = {chr(b): b for b in shown}
    decode |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def of(text):
        if not text:
            return None
        sides = []
        for ids, piece in (
            (a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(decode[c] for c in a.id_to_token(i))),
            (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
        ):
            at, tokens = 0, []
            for i in ids:
                tokens.append((i, at, at := at + len(piece(i))))
            if b"".join(map(piece, ids)) != b" " + text.encode():
                return None
            sides.append(tokens)
        return sides

    return of(text)


def brute(rows):
    """Every pair of token occurrences is compared."""
    sides = [spelled(t or "") for _, t in rows]
    links, counts = [], Counter()
    for both in sides:
        own = [(x, y) for x, p, q in both[0] for y, r, s in both[1] if max(p, r) < min(q, s)] if both else []
        links.append(own)
        counts.update(own)
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for (i, _), both, own in zip(rows, sides, links, strict=True):
        if not both:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = sorted({q for _, _, q in both[0]} & {q for _, _, q in both[1]})
        groups = [
            "|".join(",".join(str(x) for x, p, q in side if low <= p and q <= high) for side in both)
            for low, high in zip([0, *cuts], cuts, strict=False)
        ]
        total = sum(counts[p] for p in own)
        highest = sum(counts[p] == best[p[1]] for p in own)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((i, len(both[0]), len(both[1]), len(groups), len(own), highest, total, digest))
    return sorted(out, key=str)


ODD = [
    "<|endoftext|> and <s> are text",
    "naïve façade — 東京タワー 😀",
    "a ▁ b",
    "  two spaces\n\nand\tlines \r\n",
    "\x00\x01 ﻿",
    "same text",
    "same text",
    "x" * 300,
]


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_equals_all_pairs(spark, folder):
    docs = table(spark, folder, "documents").where("length(text) < 400").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    assert len(rows) > 20
    assert rows_of(align_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)


def test_edge_rows(spark):
    short = [r for r in EDGE if len(r[1] or "") < 1000]
    assert rows_of(align_tokens(documents(spark, short))) == brute([r[:2] for r in short])
    found = align_tokens(edge(spark)).collect()
    assert len(found) == len(EDGE)
    assert {r.n_a for r in found if r.doc_id in (2, 3)} == {0}
    assert align_tokens(empty(spark)).count() == 0


def test_segments_change_nothing(spark, folder, monkeypatch):
    docs = table(spark, folder, "documents").where("text IS NOT NULL").limit(60)
    rows = [tuple(r) for r in docs.selectExpr("md5(text)", "text", "doc_id % 3 + 1").collect()]
    vocabulary = tokenizer_alignment.vocabularies(*(tokenizer_alignment.read_file(spark, f) for f in FILES))
    whole = tokenizer_alignment.aligned_chunk(0, rows, vocabulary)
    monkeypatch.setattr(tokenizer_alignment, "SEGMENT", 50)
    assert tokenizer_alignment.aligned_chunk(0, rows, vocabulary) == whole


def test_segments_spell_the_text():
    text = "word " * 200_000
    parts = segments(text)
    assert len(parts) > 1 and " ".join(parts) == text


def test_large_vocabulary_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenizer_alignment, "MOST_FILE_BYTES", 10)
    with pytest.raises(ValueError, match="more than"):
        tokenizer_alignment.read_file(spark, FILES[1])
