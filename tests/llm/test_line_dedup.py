import random
import re
import zlib

from tests.llm.rows import EDGE, documents, edge, empty
from tidemark.llm.line_dedup import LEAST_PAIR, LEAST_SENTENCE, remove_repeats

PASSAGE = " ".join(f"Sentence number {i} of the passage has some words." for i in range(8))


def kept(spark, texts):
    rows = remove_repeats(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    for r in rows:
        assert r.n_chars - r.n_removed_chars == len(r.text)
        spans = [tuple(map(int, s.split(":"))) for s in r.removed.split(",") if s]
        assert sum(b - a for a, b in spans) == r.n_removed_chars
    return {r.doc_id: r.text for r in rows}


def test_lines_and_passages(spark):
    found = kept(
        spark,
        [
            f"First text.\n{PASSAGE}\nEnd of the first.",
            "Nothing here is found anywhere else at all.\nTwo lines, both are quite unlike the others.",
            f"Unlike beginning that has no end {PASSAGE} Unlike rest of it.",
            f"{PASSAGE.upper()}  \nOwn words of this last one are kept.",
            "Short line.\nShort line.",
        ],
    )
    assert found[0].startswith("First text.") and PASSAGE in found[0]
    assert found[1].startswith("Nothing here") and found[1].endswith("the others.")
    assert "number 3" not in found[2] and "Unlike beginning" in found[2] and "Unlike rest of it." in found[2]
    assert found[3] == "\nOwn words of this last one are kept."
    assert found[4] == "Short line.\n"


def test_repeats_within_a_text(spark):
    line = "This line of seven words is repeated."
    assert kept(spark, [f"{line}\n{line}\nother\n{line}"])[0].count("seven") == 1


def test_edge_rows(spark):
    rows = remove_repeats(edge(spark)).collect()
    assert len(rows) == len(EDGE)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[2][0].text is None and by[2][0].n_chars == 0 and by[3][0].text == ""
    assert by[1][0].n_removed_chars == 0 and by[5][0].text.startswith("word0 other0.")
    assert by[6][0].text.strip() == ""  # equals the text before it
    copies = [r for r in by[7] if r.n_removed_chars]
    assert len(copies) == 2 and all(not r.text.strip() for r in copies)  # repeated rows get equal results
    assert sorted(r.n_removed_chars > 0 for r in by[None]) == [False, True]
    assert remove_repeats(empty(spark)).count() == 0


def test_scripts_without_blanks_and_passages_without_stops(spark):
    chinese = "".join(chr(0x4E00 + (i * 37) % 900) for i in range(150))
    sentence = "\u3002".join(chr(0x5000 + i) * 3 + chinese[i * 30 : i * 30 + 30] for i in range(4)) + "\u3002"
    passage = " ".join(f"plain{i * 7 % 61} word{i}" for i in range(30))
    found = kept(
        spark,
        [chinese, chinese, f"one two {passage} three four", f"other words {passage} at the end", sentence, f"\u9000{sentence}\u9001"],
    )
    assert found[0] == chinese and found[1] == ""
    assert passage in found[2] and len(found[3]) < len(passage) / 2
    assert found[3].startswith("other words") and found[3].endswith("at the end")
    assert found[4] == sentence and len(found[5]) < len(sentence) / 2 + 5 and found[5].endswith("\u9001")


def test_least_line_spares_short_lines(spark):
    rows = remove_repeats(documents(spark, [(1, "Contents\nThe first text.", "en", "a"), (2, "contents", "en", "a")]), least_line=10)
    assert {r.doc_id: r.text for r in rows.collect()} == {1: "Contents\nThe first text.", 2: "contents"}


def plain_units(text):
    """Words of every unit with its span, by regular expressions over the whole text."""
    for line in re.finditer(r"[^\n]+", text):
        yield line.span(), 1
        for stop in re.finditer(r"(?:(?![.!?]+\s+|[\u3002\uFF01\uFF1F]).)+(?:[.!?]+\s+|[\u3002\uFF01\uFF1F]+\s*|$)", line[0]):
            yield (line.start() + stop.start(), line.start() + stop.end()), LEAST_SENTENCE


def brute(texts):
    """Spans that go, by id: all units of all texts in order, each kept where it stands first."""
    first, gone = {}, {}
    for key in sorted(texts):
        text, spans = texts[key], []
        for (start, end), least in plain_units(text):
            if least == 1:
                spans.append((start, end, 1))
                parts = []
                continue
            words = list(re.finditer(r"\S+", text[start:end]))
            cuts = [m.end() for m in words if len(words) > 24 and zlib.crc32(m[0].lower().encode()) % 8 == 0]
            edges = [0, *[c for c in cuts if c < words[-1].end()], end - start] if words else []
            if edges and cuts and cuts[-1] == words[-1].end():
                edges[-1] = cuts[-1]
            new = [(start + a, start + b) for a, b in zip(edges, edges[1:])]
            parts, had = parts + new, len(parts)
            spans += [(a, b, LEAST_SENTENCE) for a, b in new]
            spans += [(parts[i - 1][0], parts[i][1], LEAST_PAIR) for i in range(max(had, 1), len(parts))]
        for start, end, least in sorted(spans):
            unit = " ".join(text[start:end].lower().split())
            if unit and len(unit) >= least and first.setdefault(unit, (key, start, end)) != (key, start, end):
                gone.setdefault(key, set()).update(range(start, end))
    return gone


def test_against_brute_force(spark):
    """Documents built from few sentences, long stretches and short lines, so that units repeat in every way."""
    rng = random.Random(7)
    words = ["alpha", "Beta", "gamma", "delta", "\u00e9t\u00e9", "Zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]
    said = [" ".join(rng.choices(words, k=rng.choice([1, 3, 9, 14, 40]))) for _ in range(25)] + ["\u4e2d" * 30, "x"]
    texts = {}
    for key in range(60):
        lines = [
            "".join(rng.choice(said) + rng.choice([". ", "! ", "?  ", " ", "\u3002"]) for _ in range(rng.randrange(5)))
            for _ in range(rng.randrange(6))
        ]
        texts[key] = "\n".join(lines)
    gone = brute(texts)
    assert sum(map(len, gone.values())) > 1000
    for r in remove_repeats(documents(spark, [(k, t, "en", "a") for k, t in texts.items()])).collect():
        assert r.text == "".join(c for i, c in enumerate(texts[r.doc_id]) if i not in gone.get(r.doc_id, ())), r.doc_id
