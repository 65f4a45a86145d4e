"""Secrets in whole texts and in what is encoded inside them.

A worklist starts with the text itself. Each layer is scanned, then unwrapped:
URL escapes and Unicode escapes are decoded in place, runs of base64 and
hexadecimal digits that hold compressed data (gzip, zlib, bzip2, xz, plain deflate) or bytes with enough ASCII
characters in a row (in UTF-8, Latin-1, UTF-16 or among others) become layers
of their own. New layers join the worklist until none is left; a layer seen
before at the same place is not taken again, so data that unpack to themselves
end. Spans found in a layer are mapped to the characters of the original text
that encode them.

Defined results: a null text counts as empty and has no spans; texts are read
whole, however long; spans of one start go by their kind in the order of KINDS,
then by their end; equal spans of different layers count once; repeated rows
give repeated results; a null doc_id stays null; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read, so other columns cannot clash. Layers are visited depth first and let go. Compressed data are
inflated as a stream and scanned in blocks that end outside of encoded runs; an
encoded run of more than LIMIT bytes inside compressed data is cut there. A
document whose distinct layers have more than WORK characters (a compressed
bomb) keeps the spans found so far. Both have ``unpacked`` false.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm import scratch

KINDS = ("assign", "access", "hex")
#: Fixed patterns of the three kinds and the least lengths of their matches.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Bytes of inflated data that are held and scanned at once, bytes that precede a block again, bytes without a cut at most.
BLOCK, OVERLAP, LIMIT = 1 << 22, 1 << 12, 1 << 26
#: Characters of distinct layers and inflated bytes of one document: a guard against compressed bombs.
WORK = 1 << 32
#: Compressed layers directly in each other, which data that inflate to themselves exceed.
DEEP = 64
#: A byte outside of encoded runs, and all before it.
_CUT = re.compile(rb"(?s).*(?:[^A-Za-z0-9+/_=\-\r\n%\\&#;{}\0]|\0{4})")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
#: Base64 in one line, or full lines and a last one of any length.
_BASE64 = re.compile(r"(?:[A-Za-z0-9+/_-]{40,}\r?\n)+[A-Za-z0-9+/_-]*={0,2}|[A-Za-z0-9+/_-]{16,}={0,2}")
#: Every long run of digits or base64 lies in one of these, and they are quickly found.
_LONG = re.compile(r"[^ ]{16,}")
_HEXES = re.compile(r"[0-9A-Fa-f]{24,}")
_CUTS = re.compile(r"[+/]")


def long_words(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _LONG.finditer(text)]


def scan(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets that stand in the text as they are; words: its long_words."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for a, b in words for m in HEX.finditer(text, a, b)]
    return sorted(out)


class Layer:
    """A text and where its characters come from: pieces (own start, origin start, origin length, own length).

    A piece of equal lengths maps character by character, any other as a whole.
    """

    def __init__(self, text: str, pieces: list[tuple[int, int, int, int]]):
        self.text, self.pieces, self.words = text, pieces, long_words(text)
        self.begins = [p[0] for p in pieces]

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """The characters of the original that own [start, end) come from."""
        first = self.pieces[bisect_right(self.begins, start) - 1]
        last = self.pieces[bisect_right(self.begins, end - 1) - 1]
        same = lambda p: p[2] == p[3]  # noqa: E731  character for character
        return first[1] + (start - first[0] if same(first) else 0), last[1] + (end - last[0] if same(last) else last[2])


def _in_place(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match replaced by its meaning, or None where there is none."""
    out, pieces, at, size = [], [], 0, 0

    def keep(a: int, b: int) -> None:
        nonlocal size
        i = bisect_right(layer.begins, a) - 1
        while a < b:
            own, origin, length, count = layer.pieces[i]
            stop = min(b, own + count)
            if stop > a:
                pieces.append((size, origin + a - own, stop - a, stop - a) if length == count else (size, origin, length, stop - a))
                out.append(layer.text[a:stop])
                size += stop - a
                a = stop
            i += 1

    for m in pattern.finditer(layer.text):
        for a, b, meaning in decode(m):
            if meaning is None:
                continue
            keep(at, a)
            start, end = layer.origin(a, b)
            pieces.append((size, start, end - start, len(meaning)))
            out.append(meaning)
            size += len(meaning)
            at = b
    if not out:
        return None
    keep(at, len(layer.text))
    return Layer("".join(out), pieces)


def _percent(m: re.Match) -> Iterator[tuple[int, int, str | None]]:
    raw = bytes.fromhex(m[0].replace("%", ""))
    i = 0
    while i < len(raw):
        size = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
        try:
            meaning = raw[i : i + size].decode()
        except UnicodeDecodeError:
            size, meaning = 1, None
        yield m.start() + 3 * i, m.start() + 3 * (i + size), meaning
        i += size


def _escape(m: re.Match) -> Iterator[tuple[int, int, str | None]]:
    code = int(m[6]) if m[6] else int(next(x for x in m.groups()[:5] if x), 16)
    yield m.start(), m.end(), chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


#: The shortest secret and the shortest encoded run that a text can hold take so many ASCII characters in a row.
_ASCII = re.compile(rb"[\t\r\n\x20-\x7e]{14}")
_WIDE = re.compile(rb"(?:[\t\r\n\x20-\x7e]\0){14}")


def _texts(data: bytes) -> Iterator[str]:
    """The texts that bytes may be and that can hold a secret: UTF-8 or another extension of ASCII, UTF-16 of both orders."""
    if _ASCII.search(data):
        yield data.decode("utf-8", "replace")
    for parity, name in enumerate(("utf-16-le", "utf-16-be")):
        if any(m.start() % 2 == parity for m in _WIDE.finditer(data)):
            yield data.decode(name, "replace")


def _compressed(data: bytes) -> str:
    """The format of compressed data by how they begin; empty for others."""
    if data[:2] == b"\x1f\x8b":
        return "gzip"
    if len(data) > 2 and data[0] == 0x78 and (data[0] * 256 + data[1]) % 31 == 0:
        return "zlib"
    if data[:3] == b"BZh" and data[3:4].isdigit():
        return "bzip2"
    return "xz" if data[:6] == b"\xfd7zXZ\0" else ""


#: Bytes that tell whether data without a header are deflated text.
_GUESS = 1 << 10


def _deflated(data: bytes) -> bool:
    """Whether data without a header inflate to text."""
    try:
        return bool(_ASCII.search(zlib.decompressobj(-15).decompress(data, _GUESS)))
    except zlib.error:
        return False


def _unpacker(kind: str):
    """A function from a part of the data, and how many bytes to make at most, to what they make and what is left of them."""
    if kind in ("bzip2", "xz"):
        worker = bz2.BZ2Decompressor() if kind == "bzip2" else lzma.LZMADecompressor(lzma.FORMAT_XZ)

        def run(part: bytes, most: int) -> tuple[bytes, bytes, bool, bool]:
            out = worker.decompress(part, most)
            return out, worker.unused_data if worker.eof else b"", worker.eof, not worker.eof and not worker.needs_input

        return run
    inflate = zlib.decompressobj({"gzip": 31, "zlib": 15, "deflate": -15}[kind])

    def run(part: bytes, most: int) -> tuple[bytes, bytes, bool, bool]:
        out = inflate.decompress(part, most)
        return out, inflate.unused_data if inflate.eof else inflate.unconsumed_tail, inflate.eof, False

    return run


class Budget:
    """What is left of a document's work, and whether all of it was done."""

    def __init__(self):
        self.left, self.whole = WORK, True

    def take(self, n: int) -> bool:
        if n > self.left:
            self.whole = False
            return False
        self.left -= n
        return True


def _inflated(data: Iterator[bytes], kind: str, budget: Budget) -> Iterator[bytes]:
    """The content of compressed data, of all members, as far as it is sound."""
    run = _unpacker(kind)
    for part in data:
        more = False
        while part or more:
            try:
                out, part, ended, more = run(part, BLOCK)
            except (zlib.error, lzma.LZMAError, OSError):
                return
            if out:
                if not budget.take(len(out)):
                    return
                yield out
            if ended:
                if part and _compressed(part) != kind:
                    return  # what follows the last member is no data
                run, more = _unpacker(kind), False


def _blocks(data: Iterator[bytes], budget: Budget) -> Iterator[bytes]:
    """A stream in blocks that end outside of encoded runs; each begins an even number of bytes after the last, with some of its bytes."""
    held = bytearray()
    done = 0
    for part in data:
        held += part
        while len(held) - done > BLOCK:
            m = _CUT.match(held, done, len(held))
            end = m.end() if m else 0
            if not end and len(held) - done > LIMIT:
                budget.whole, end = False, len(held) // 4 * 4
            if not end:
                break
            yield bytes(held[:end])
            m = _CUT.match(held, 0, max(0, end - OVERLAP))
            begin = max(m.end() - 1 if m else 0, end - 2 * OVERLAP, 0) // 4 * 4
            del held[:begin]
            done = end - begin
    if len(held) > done:
        yield bytes(held)


def _meaning(data: bytes, budget: Budget) -> Iterator[str]:
    """Texts that bytes are, and those that they hold through any number of compressed layers."""
    shown = False
    for text in _texts(data):
        shown = True
        yield text
    # Deflated data without a header are recognised by what they make.
    kind = _compressed(data) or ("deflate" if not shown and _deflated(data) else "")
    if not kind:
        return
    stream, head = iter((data,)), data
    for _ in range(DEEP):
        if not kind:
            break
        stream = _inflated(stream, kind, budget)
        head = b""
        while len(head) < 6 and (part := next(stream, b"")):
            head += part
        stream, kind = chain((head,), stream), _compressed(head)
    else:
        budget.whole = budget.whole and not _compressed(head)
    for block in _blocks(stream, budget):
        yield from _texts(block)


def _whole(layer: Layer, m: re.Match, text: str) -> Layer:
    """A layer all of whose characters come from the whole match."""
    start, end = layer.origin(m.start(), m.end())
    text += "\n" if len(text) == end - start else ""
    return Layer(text, [(0, start, end - start, len(text))])


def _packed(layer: Layer, budget: Budget) -> Iterator[Layer]:
    """The layers inside runs of base64 and hexadecimal digits."""
    for pattern, decoded in ((_BASE64, _base64), (_HEXES, _hexes)):
        for m in (m for a, b in layer.words for m in pattern.finditer(layer.text, a, b)):
            for data in decoded(m[0]):
                yield from (_whole(layer, m, text) for text in _meaning(data, budget))


def _base64(run: str) -> Iterator[bytes]:
    """What a run may encode: at the four alignments, and compressed data behind any sign that ends a prefix."""
    run = run.replace("\r", "").replace("\n", "").rstrip("=").replace("-", "+").replace("_", "/")

    def decode(start: int, end: int) -> bytes:
        # A last digit alone holds no byte.
        end -= (end - start) % 4 == 1
        return base64.b64decode(run[start:end] + "=" * (-(end - start) % 4))

    for start in range(4):
        yield decode(start, len(run))
    for start in (m.end() for m in _CUTS.finditer(run)):
        if _compressed(decode(start, min(len(run), start + 4))):
            yield decode(start, len(run))


def _hexes(run: str) -> Iterator[bytes]:
    for start in range(2):
        yield bytes.fromhex(run[start : len(run) - (len(run) - start) % 2])


def _inside(layer: Layer, budget: Budget) -> Iterator[Layer]:
    """The layers inside a layer; it is let go before the last ones are visited."""
    yield from _packed(layer, budget)
    fresh = []
    if "\\" in layer.text or "&#" in layer.text:
        fresh.append(_in_place(layer, _ESCAPE, _escape))
    if "%" in layer.text:
        fresh.append(_in_place(layer, _PERCENT, _percent))
    del layer
    while fresh:
        if (x := fresh.pop()) is not None:
            yield x
        del x


def unwrap(text: str) -> tuple[list[tuple[int, int, int]], set[tuple[int, int, int]], int, bool]:
    """Base spans, all spans, the number of layers, and whether all of them were unpacked."""
    top = Layer(text, [(0, 0, len(text), len(text))])
    base = scan(text, top.words)
    spans, seen, budget = set(base), set(), Budget()
    work = [iter((top,))]
    layers = 0
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        mark = (layer.pieces[0][1:3], hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest())
        if mark in seen:
            continue
        if layers and not budget.take(len(layer.text)):
            continue
        seen.add(mark)
        layers += 1
        if layers > 1:
            for start, kind, end in scan(layer.text, layer.words):
                a, b = layer.origin(start, end)
                spans.add((a, kind, b))
        work.append(_inside(layer, budget))
    return base, spans, layers, budget.whole


def _join(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


_OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers int, unpacked boolean"
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.bool_()]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _OUT.split(", ")]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            base, spans, layers, whole = unwrap(text.as_py() or "")
            counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            rows.append((doc_id, *counts, hashlib.sha256(_join(base).encode()).hexdigest(), _join(spans), layers, whole))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names)


def secrets(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, their digest, and all spans (code points of the text, end exclusive)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).transform(scratch.arrow, _run, _OUT)
