"""Words and word shingles of whole texts as numpy arrays, a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once; longer texts are hashed block by block.
BLOCK = 1 << 18
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of words without punctuation: ASCII characters other than letters and digits.
PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])

_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        x = np.full(max(n, BLOCK) + 1, base, np.uint64)
        x[0] = 1
        _powers[name] = np.multiply.accumulate(x)
    return _powers[name][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) and offsets[-1] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word of lower-cased bytes, and the number of words before each text; a word also ends in front of each place of breaks."""
    solid = ~space[raw]
    before = np.empty_like(solid)
    before[1:] = solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(raw)]
    before[inner] = False
    if breaks is not None:
        before[breaks] = False
    if len(before):
        before[0] = False
    begin = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[:-1] = solid[1:]
    if len(after):
        after[-1] = False
    last = inner[inner > 0] - 1
    after[last] = False
    if breaks is not None:
        after[breaks[breaks > 0] - 1] = False
    end = np.flatnonzero(solid & ~after) + 1
    return begin, end, np.searchsorted(begin, offsets)


def word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, by differences of a prefix sum of powers."""
    out = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + BLOCK, "right")))
        a, b = int(begin[i]), int(end[j - 1])
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((raw[a:b].astype(np.uint64) + np.uint64(1)) * _power(_P, "up", b - a), out=total[1:])
        s = begin[i:j] - a
        out[i:j] = mix((total[end[i:j] - a] - total[s]) * _power(_P_INV, "down", b - a + 1)[s])
        i = j
    return out


_SEPARATOR, _UNSPACED, _MARK = 1, 2, 4
_classes: np.ndarray | None = None


def _class_of() -> np.ndarray:
    """Flags of each code point: separators, characters of scripts without spaces, marks."""
    global _classes
    if _classes is None:
        import regex

        codes = [*range(0xD800), *range(0xE000, 0x110000)]
        every = "".join(map(chr, codes))
        table = np.zeros(len(codes), np.uint8)
        scripts = "".join(rf"\p{{Script={x}}}" for x in ("Han", "Hiragana", "Katakana", "Bopomofo", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))
        for flag, pattern in ((_SEPARATOR, r"[\p{P}\p{S}\p{Z}\p{C}]+"), (_UNSPACED, f"[{scripts}]+"), (_MARK, r"\p{M}+")):
            for m in regex.finditer(pattern, every):
                table[m.start() : m.end()] |= flag
        table[(table & _SEPARATOR) > 0] = _SEPARATOR
        _classes = np.zeros(0x110000, np.uint8)
        _classes[codes] = table
    return _classes


def of_all_scripts(raw: np.ndarray) -> np.ndarray | None:
    """Blank the separators beyond ASCII in UTF-8 bytes; where words begin and end in scripts without spaces, a character (with its marks) each."""
    at = np.flatnonzero(raw >= 0xC0)
    if not len(at):
        return None
    lead = raw[at].astype(np.uint32)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    code = lead & (np.uint32(0x7F) >> size.astype(np.uint32))
    for k in (1, 2, 3):
        more = size > k
        code[more] = code[more] << np.uint32(6) | (raw[at[more] + k] & 0x3F)
    flag = _class_of()[np.minimum(code, 0x10FFFF)]
    blank = (flag & _SEPARATOR) > 0
    for k in range(4):
        raw[at[blank & (size > k)] + k] = 0x20
    plain = (flag & _UNSPACED) > 0
    if not plain.any():
        return None
    adjacent = np.zeros(len(at), bool)
    adjacent[1:] = at[:-1] + size[:-1] == at[1:]
    joined = ((flag & _MARK) > 0) & adjacent
    base = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
    joined &= plain[base]
    ends = (at + size)[plain | joined]
    return np.setdiff1d(np.concatenate((at[plain], ends[ends < len(raw)])), at[joined])


def texts_words(column: pa.Array, space: np.ndarray = SPACE, prepare: Callable[[np.ndarray], np.ndarray | None] | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices [i, j) of a column with the word hashes of their lower-cased texts and the words before each text.

    prepare may change the bytes of a slice and returns places where words end.
    """
    raw, offsets = utf8(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1)
        part = LOWER[raw[offsets[i] : offsets[j]]]
        breaks = prepare(part) if prepare else None
        begin, end, first = words(part, offsets[i : j + 1] - offsets[i], space, breaks)
        yield i, j, word_hashes(part, begin, end), first
        i = j


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the width-word shingles of one text; the whole sequence if it is shorter."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    if n < width:
        total = np.uint64(n)
        with np.errstate(over="ignore"):
            for h in hashes:
                total = mix(np.array([total * _P + h], np.uint64))[0]
        return np.array([total], np.uint64)
    total = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        total = total * _P + hashes[k : n - width + 1 + k]
    return np.unique(mix(total))
