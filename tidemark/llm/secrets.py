"""Secret scan: patterns are searched in a text and in every layer that can be decoded from it.

Layers come from a worklist. A layer with URL or Unicode escapes is pushed again with the escapes decoded; each base64 run
that holds text, or a compressed stream of text, is pushed as a layer of its own. The worklist ends when no new layer
appears; a layer that was seen before at the same place is not pushed again, so streams that unpack to themselves end too.
Base64 is tried over both alphabets, across line breaks and at all four alignments, as a run may be glued to other characters.
Every layer knows which characters of the original text each of its characters came from, and finds are reported there.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.common import map_columns

#: Kinds in the order in which finds at the same place are listed.
KINDS = ("assign", "access", "hex")

ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of hexadecimal digits is maximal, so asking for the length here equals dropping short runs later.
HEX = re.compile(r"[0-9a-f]{16,}")

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_RUN = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
UNICODE_ONE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
#: Maximal runs of either alphabet, and those that go on over line breaks (possessive, so that no run is tried twice).
ALPHABETS = ("A-Za-z0-9+/", "A-Za-z0-9_-")
BASE64_RUNS = tuple(re.compile(rf"(?<![{a}])[{a}]{{16,}}+={{0,2}}") for a in ALPHABETS)
WRAPPED_RUNS = tuple(re.compile(rf"(?<![{a}])[{a}]++(?:\r?\n[ \t]*+[{a}]++)++={{0,2}}") for a in ALPHABETS)
BLANKS = re.compile(r"[\r\n\t ]")

#: A compressed stream is unpacked and scanned in blocks of so many bytes, each with the last of the block before it.
MAX_LAYER_BYTES, OVERLAP = 64 * 1024 * 1024, 1024 * 1024

#: Bytes unpacked at once.
STEP = 1024 * 1024
#: How compressed streams begin: gzip, zlib, bzip2, xz, zstd.
STREAM = re.compile(rb"\x1f\x8b|\x78[\x01\x5e\x9c\xda]|BZh|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
URL_SAFE = str.maketrans("+/", "-_")

Span = tuple[str, int, int]


class Layer:
    """Decoded text and where its characters came from in the original: each one, or all from one place (none: the original).

    Finds of a loose layer count only where no other layer has the same kind around them.
    """

    __slots__ = ("ends", "loose", "starts", "text")

    def __init__(self, text: str, starts: list[int] | int | None, ends: list[int] | int | None, loose: bool = False):
        self.text, self.starts, self.ends, self.loose = text, starts, ends, loose

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return min(self.starts[start:end]), max(self.ends[start:end])


def finds(text: str) -> Iterator[Span]:
    """Matches of the base patterns in one layer."""
    for m in ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= 12:
            yield "assign", m.start(), m.end()
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 18:
            yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


def url_pieces(run: str) -> list[tuple[str, int]]:
    """Characters of a percent-encoded run with the length of their codes; none if it is not UTF-8."""
    try:
        decoded = bytes.fromhex(run.replace("%", "")).decode("utf-8")
    except UnicodeDecodeError:
        return []
    return [(c, 3 * len(c.encode("utf-8"))) for c in decoded]


def unicode_pieces(run: str) -> list[tuple[str, int]]:
    """Characters of a run of backslash escapes with the length of their codes; surrogate pairs are joined."""
    pieces: list[tuple[str, int]] = []
    for m in UNICODE_ONE.finditer(run):
        code = int(m[1] or m[2] or m[3], 16)
        if code > 0x10FFFF:
            return []
        last = ord(pieces[-1][0]) if pieces else 0
        if 0xDC00 <= code < 0xE000 and 0xD800 <= last < 0xDC00:
            joined = 0x10000 + ((last - 0xD800) << 10) + code - 0xDC00
            pieces[-1] = (chr(joined), pieces[-1][1] + len(m[0]))
        else:
            pieces.append((chr(code), len(m[0])))
    return [("�" if 0xD800 <= ord(c) < 0xE000 else c, n) for c, n in pieces]


def unescaped(layer: Layer, runs: re.Pattern, pieces) -> Layer | None:
    """The layer with all escapes of one sort decoded, or none if it has no such escapes."""
    text, out, starts, ends, at, changed = layer.text, [], [], [], 0, False

    def keep(start: int, end: int) -> None:
        out.append(text[start:end])
        if isinstance(layer.starts, int):
            return
        starts.extend(range(start, end) if layer.starts is None else layer.starts[start:end])
        ends.extend(range(start + 1, end + 1) if layer.ends is None else layer.ends[start:end])

    for m in runs.finditer(text):
        decoded = pieces(m[0])
        if not decoded:
            continue
        changed = True
        keep(at, m.start())
        place = m.start()
        for char, length in decoded:
            start, end = layer.span(place, place + length)
            out.append(char)
            starts.append(start)
            ends.append(end)
            place += length
        at = m.end()
    if not changed:
        return None
    keep(at, len(text))
    if isinstance(layer.starts, int):
        starts, ends = layer.starts, layer.ends
    return Layer("".join(out), starts, ends, layer.loose)


def opened(data: memoryview) -> zlib._Decompress | bz2.BZ2Decompressor | lzma.LZMADecompressor | None:
    """A decompressor for the stream at the start of the bytes; none if it is zstd or no stream."""
    head = bytes(data[:6])
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(data) > 2 and (head[0] * 256 + head[1]) % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def members(data: memoryview, limit: int, whole: list[bool], read: list[int]) -> Iterator[bytes]:
    """What a compressed stream and those right behind it unpack to, up to the first error, in parts of at most ``limit``.

    ``whole`` gets an entry if no byte was left over, ``read`` the number of bytes up to the end of each complete stream.
    """
    size = len(data)
    try:
        if bytes(data[:4]) == b"\x28\xb5\x2f\xfd":
            with zstandard.ZstdDecompressor(max_window_size=1 << 31).stream_reader(data, read_across_frames=True) as reader:
                while part := reader.read(min(limit, STEP)):
                    yield part
            whole.append(True)
            read.append(size)
            return
        while (stream := opened(data)) is not None:
            given = data
            while not stream.eof:
                part = stream.decompress(given, min(limit, STEP))
                given = stream.unconsumed_tail if hasattr(stream, "unconsumed_tail") else b""
                if part:
                    yield part
                elif not given or getattr(stream, "needs_input", False):
                    break
            if not stream.eof:
                whole.append(True)
                return
            data = data[len(data) - len(stream.unused_data) :]
            read.append(size - len(data))
            while len(data) and data[0] == 0:  # padding between members
                data = data[1:]
            if not len(data):
                whole.append(True)
                return
    except (zlib.error, OSError, EOFError, ValueError, MemoryError, lzma.LZMAError, zstandard.ZstdError):
        return


def unpacked(data: memoryview, limit: int, whole: list[bool], read: list[int]) -> Iterator[bytes]:
    """The content of compressed streams in blocks that overlap; nothing if the bytes are none."""
    held, size, before = [], 0, 0
    for part in members(data, limit, whole, read):
        held.append(part)
        size += len(part)
        if size >= limit:
            block = b"".join(held)
            yield block
            held = [block[-min(OVERLAP, limit // 2) :]] if limit > 1 else []
            size = before = sum(map(len, held))
    if size > before:
        yield b"".join(held)


def unpacked_all(data: bytes, limit: int, whole: list[bool]) -> Iterator[bytes]:
    """Contents of the compressed streams that start anywhere in the bytes, and of streams that these begin with.

    ``whole`` gets an entry if the bytes are streams from the first to the last.
    """
    seen = {data}
    done = 0  # marks before this place lie in streams that were read to their end
    for mark in STREAM.finditer(data):
        if mark.start() < done:
            continue
        read: list[int] = []
        work = [memoryview(data)[mark.start() :]]
        while work:
            part = work.pop()
            first = part.obj is data
            for block in unpacked(part, limit, whole if first and mark.start() == 0 else [], read if first else []):
                if block not in seen:
                    yield block
                    if STREAM.match(block):
                        seen.add(block)
                        work.append(memoryview(block))
        done = mark.start() + max(read, default=0)


def as_text(data: bytes) -> str:
    """Bytes as text; those that are not UTF-8 become marks."""
    return data.decode("utf-8", "replace")


def is_text(data: bytes) -> bool:
    """Whether the bytes are UTF-8 and most characters printable: what is decoded out of step is not."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return 10 * sum(c.isprintable() or c in "\t\n\r\f\v" for c in text) >= 9 * len(text) > 0


def base64_layers(layer: Layer, limit: int) -> Iterator[Layer]:
    """Texts hidden in the base64 runs of a layer.

    Characters of a text that fills its run, or of a compressed stream, come from the whole run. Of other runs, which may be
    glued to what stands beside them, every alignment is a loose layer whose characters come from their own codes.
    """
    runs = {}
    for wrapped, patterns in ((False, BASE64_RUNS), (True, WRAPPED_RUNS)):
        for pattern in patterns:
            for m in pattern.finditer(layer.text):
                run = (BLANKS.sub("", m[0]) if wrapped else m[0]).rstrip("=")
                if len(run) >= 16:
                    runs[m.span()] = run.translate(URL_SAFE)
    last = -1  # runs up to here lie within one that is a text or stream from end to end
    for place in sorted(runs, key=lambda x: (x[0], -x[1])):
        if place[1] <= last:
            continue
        run, (start, end), whole, loose = runs[place], layer.span(*place), [], []
        for shift in range(4):
            codes = run[shift : len(run) - ((len(run) - shift) % 4 == 1)]
            data = base64.urlsafe_b64decode(codes + "=" * (-len(codes) % 4))
            ended: list[bool] = []
            for content in unpacked_all(data, limit, ended):
                yield Layer(as_text(content), start, end)
            if shift == 0 and len(run) % 4 != 1:
                whole = ended
                if not whole and is_text(data):
                    whole = [True]
                    yield Layer(as_text(data), start, end)
            if whole:
                break
            loose.append((shift, data))
        if whole:
            last = max(last, place[1])
            continue
        places = [i for i in range(*place) if not BLANKS.match(layer.text[i])]
        for shift, data in loose:
            bounds = [layer.span(places[shift + 8 * i // 6], places[shift + (8 * i + 7) // 6] + 1) for i in range(len(data))]
            yield Layer(data.decode("latin-1"), [x for x, _ in bounds], [y for _, y in bounds], True)


def digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def reaches(spans: Iterable[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts in order, and the furthest end of the spans up to each."""
    spans = sorted(spans)
    return [start for start, _ in spans], list(accumulate((end for _, end in spans), max))


def covered(span: Span, reach: dict[str, tuple[list[int], list[int]]]) -> bool:
    """Whether a span lies within another one of its kind."""
    starts, ends = reach[span[0]]
    before = bisect_right(starts, span[1])
    return before > 0 and ends[before - 1] >= span[2]


def scan(text: str, limit: int = MAX_LAYER_BYTES) -> tuple[list[Span], list[Span]]:
    """Base finds of a text, and all finds including those in decoded layers, both in the order of their places."""
    order = {kind: i for i, kind in enumerate(KINDS)}

    def placed(spans) -> list[Span]:
        return sorted(set(spans), key=lambda s: (s[1], order[s[0]], s[2]))

    def inside(layer: Layer) -> Iterator[Layer]:
        escaped = [unescaped(layer, URL_RUN, url_pieces) if "%" in layer.text else None]
        escaped.append(unescaped(layer, UNICODE_RUN, unicode_pieces) if "\\" in layer.text else None)
        for new in chain(escaped, base64_layers(layer, limit)):
            if new is not None and new.text:
                new.loose |= layer.loose
                yield new

    base = placed(finds(text))
    found, loose, seen = set(base), set(), {(0, len(text), digest(text))}
    work = [inside(Layer(text, None, None))]  # layers are made when their turn comes: of a long stream, one block at a time
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        key = (*layer.span(0, len(layer.text)), digest(layer.text))
        if key not in seen:
            seen.add(key)
            (loose if layer.loose else found).update((kind, *layer.span(start, end)) for kind, start, end in finds(layer.text))
            work.append(inside(layer))
    reach = {kind: reaches(s[1:] for s in found if s[0] == kind) for kind in KINDS}
    return base, placed(found | {x for x in loose if not covered(x, reach)})


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_columns(columns: dict, id_column: str, text_column: str, limit: int) -> dict:
    out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_decoded", "base_sha256", "spans")}
    for text in columns[text_column]:
        base, every = scan(text or "", limit)
        for kind in KINDS:
            out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
        out["n_decoded"].append(len(every) - len(base))
        out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
        out["spans"].append(joined(every))
    return {id_column: columns[id_column]} | out


def find_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_layer_bytes: int = MAX_LAYER_BYTES
) -> DataFrame:
    """Secrets of every text: one row per input row, with counts of the base finds, their digest and all spans.

    Spans are ``kind:start:end`` in code points of the original text. A null or empty text has no finds and the digest of
    the empty string. Repeated rows and repeated or null ids are scanned and returned like any others, ties at one place
    are listed in the order of ``KINDS``. Columns other than the two named ones are ignored. No shuffle.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_assign long, n_access long, n_hex long, n_decoded long, base_sha256 string, spans string"
    return map_columns(docs.select(id_column, text_column), scan_columns, schema, id_column, text_column, max_layer_bytes)


def redact_columns(columns: dict, text_column: str, limit: int) -> dict:
    texts = []
    for text in columns[text_column]:
        if text:
            _, spans = scan(text, limit)
            out, at = [], 0
            for _, start, end in spans:
                if start >= at:
                    out += [text[at:start], "[SECRET]"]
                at = max(at, end)
            text = "".join([*out, text[at:]]) if out else text
        texts.append(text)
    return columns | {text_column: texts}


def redact_secrets(docs: DataFrame, text_column: str = "text", max_layer_bytes: int = MAX_LAYER_BYTES) -> DataFrame:
    """The same rows and columns, with every secret, decoded ones included, replaced by ``[SECRET]``."""
    return map_columns(docs, redact_columns, docs.schema, text_column, max_layer_bytes)
