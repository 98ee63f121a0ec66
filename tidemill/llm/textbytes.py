"""Vectorised reading of text columns: Arrow batches as byte arrays, words and their 64-bit hashes.

Texts are handled as UTF-8 bytes, so lower-casing A-Z and the word classes below work on single bytes:
every byte of a multi-byte character is 0x80 or above. Hashes have 64 bits and stand for the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
PIECE_BYTES = 1 << 21


def byte_class(is_word) -> np.ndarray:
    return np.fromiter((is_word(b) for b in range(256)), bool, 256)


#: Words between white space (0x20 and 0x09-0x0D).
SPACED = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words of ASCII letters, digits and all characters above 0x7F.
ALNUM = byte_class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MAX_PLACES = 1 << 16
_PLACE = np.cumprod(np.full(_MAX_PLACES, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


class Piece:
    """Some consecutive texts of a batch: ``data`` holds their bytes, text i is data[offsets[i]:offsets[i + 1]]."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut a string column into pieces of about ``limit`` bytes; null counts as empty."""
    texts = column.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield Piece(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def word_spans(piece: Piece, word: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per text the index of its first word (one more entry at the end)."""
    inside = word[piece.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[piece.offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, piece.offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each span of ``data``; spans are in order and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    at = place + np.repeat(starts, lengths)
    codes = _BYTE_CODE[data[at]]
    codes *= _PLACE[place & (_MAX_PLACES - 1)]
    return mix(np.add.reduceat(codes, firsts) + lengths.astype(np.uint64))


def lower_words(piece: Piece, word: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and per text the index of its first word."""
    starts, ends, bounds = word_spans(piece, word)
    return word_hashes(lowered(piece.data), starts, ends), bounds
