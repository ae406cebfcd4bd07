"""Words and five-word shingles of whole texts as 64-bit hashes, made with NumPy on Arrow buffers.

A word is a run of letters, digits and marks of the lower-cased text. A shingle is a run of five words; a text of one to four
words has one shingle of all its words, a text without words none. Equal words have equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
CHUNK_BYTES = 1 << 20
PIECE_BYTES = 1 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}

_SPACED = np.arange(256, dtype=np.uint8)
_SPACED[[b for b in range(128) if not chr(b).isalnum()]] = 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one large_string array without nulls; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return pc.fill_null(pc.cast(column, pa.large_string()), "")


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``limit`` bytes together; a longer text stands alone, whole."""
    sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
    start = filled = 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and filled + size > limit:
            yield start, row
            start, filled = row, 0
        filled += size
    if len(sizes) > start:
        yield start, len(sizes)


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large_string array, without copying."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (raw[offsets[0]: offsets[-1]], offsets - offsets[0]) if len(texts) else (raw[:0], np.zeros(1, np.int64))


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the lower-cased texts in which all but word characters are spaces; every text ends with one."""
    texts = pc.binary_join_element_wise(pc.utf8_lower(texts), pa.scalar(" ", pa.large_string()),
                                        pa.scalar("", pa.large_string()))
    raw, offsets = buffer(texts)
    leads = np.bincount(raw, minlength=256)
    if leads[0xC2] or leads[0xC9:].any() or np.any((raw[1:] & 0x9F == 0x97) & (raw[:-1] == 0xC3)):
        # other than the letters U+00C0 to U+023F: let Unicode classes decide
        texts = pc.binary_join_element_wise(pc.replace_substring_regex(texts, r"[^\p{L}\p{N}\p{M}]+", " "),
                                            pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
        raw, offsets = buffer(texts)
    return _SPACED[raw], offsets


def _powers(kind: int, n: int) -> np.ndarray:
    """The first ``n`` powers of the base (kind 0) or of its inverse (1); those of a piece are kept, longer rows aren't."""
    if len(_POWERS.get(kind, ())) < n:
        steps = np.full(max(n, PIECE_BYTES + 1), _BASE if kind == 0 else _BASE_INVERSE)
        steps[0] = 1
        found = np.cumprod(steps)
        if n > PIECE_BYTES + 1:  # a single word longer than a piece
            return found[:n]
        _POWERS[kind] = found
    return _POWERS[kind][:n]


def _pieces(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE_BYTES`` that are cut at spaces; a longer word stays whole."""
    start = 0
    while len(raw) - start > PIECE_BYTES:
        spaces = np.flatnonzero(raw[start: start + PIECE_BYTES] == 32)
        if len(spaces):
            end = start + int(spaces[-1]) + 1
        else:
            end = start + PIECE_BYTES
            while end < len(raw) and raw[end] != 32:
                step = raw[end: end + PIECE_BYTES]
                spaces = np.flatnonzero(step == 32)
                end += int(spaces[0]) if len(spaces) else len(step)
        yield start, end
        start = end
    if len(raw) > start:
        yield start, len(raw)


def word_hashes(texts: pa.Array, stem: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the place of its first word (one more entry at the end).

    With ``stem``, of the first so many bytes of each word. Beyond the words themselves, memory is that of one piece.
    """
    raw, offsets = spaced(texts)
    if not len(raw):
        return np.zeros(0, _U), np.zeros(len(texts) + 1, np.int64)
    hashes, begins = [], []
    for start, stop in _pieces(raw):
        piece = raw[start:stop]
        inside = piece != 32
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        begin, end = edges[0::2], edges[1::2]
        if stem:
            end = np.minimum(end, begin + stem)
        sums = np.zeros(len(piece) + 1, _U)
        np.cumsum(piece.astype(_U) * _powers(0, len(piece)), out=sums[1:])
        hashes.append(mix((sums[end] - sums[begin]) * _powers(1, len(piece))[begin]))
        begins.append(begin + start)
    begin = np.concatenate(begins)
    return np.concatenate(hashes), np.searchsorted(begin, offsets)


_STEPS = [_U(pow(0xD1342543DE82EF95, i + 1, 1 << 64)) for i in range(SHINGLE)]


def shingles(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle, repeats included, in order."""
    counts = np.diff(starts)
    width = len(words) - SHINGLE + 1
    long = np.zeros(0, _U)
    if width > 0:
        long = sum(words[i: i + width] * step for i, step in enumerate(_STEPS))
    texts = np.repeat(np.arange(len(counts)), np.maximum(counts - SHINGLE + 1, 0))
    first = np.repeat(starts[:-1] - np.concatenate([[0], np.cumsum(np.maximum(counts - SHINGLE + 1, 0))[:-1]])
                      if len(counts) else starts[:-1], np.maximum(counts - SHINGLE + 1, 0))
    values = long[np.arange(len(texts)) + first] if len(texts) else np.zeros(0, _U)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        extra = []
        for text in short.tolist():
            own = words[starts[text]: starts[text + 1]]
            extra.append(sum(own[i:i + 1] * _STEPS[i] for i in range(len(own)))[0] + _U(len(own)))
        texts = np.concatenate([texts, short])
        values = np.concatenate([values, np.array(extra, dtype=_U)])
        order = np.argsort(texts, kind="stable")
        texts, values = texts[order], values[order]
    return mix(values), texts
