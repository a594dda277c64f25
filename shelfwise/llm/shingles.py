"""Hashed word shingles of texts, in Python workers."""

from collections.abc import Iterator

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(33)
#: An odd base of polynomial hashes modulo 2 ** 64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes whose hashes are in memory at a time.
PIECE = 2 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    h = (h ^ (h >> _SHIFT)) * _M1
    h = (h ^ (h >> _SHIFT)) * _M2
    return h ^ (h >> _SHIFT)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Words of more bytes are hashed one by one.
_LONG = 256
#: What is left of eight bytes when a word ends within them.
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_hashes(data: bytes, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words from `first` to `last` (excluded) of `data`.

    Words are taken in eights of bytes, each mixed into what came before, so no arithmetic relation of bytes carries
    over to the hashes; those of more than _LONG bytes by xxh3 of their bytes.
    """
    sizes = last - first
    eights = np.lib.stride_tricks.as_strided(np.frombuffer(data + bytes(8), np.uint8), (len(data) + 1, 8), (1, 1))
    h = mixed(sizes.astype(np.uint64) * _STEP)
    words = np.flatnonzero(sizes <= _LONG)
    at = 0
    while len(words):
        left = np.minimum(sizes[words] - at, 8)
        h[words] = mixed(h[words] * _STEP ^ (eights[first[words] + at].view("<u8")[:, 0] & _KEPT[left]))
        at += 8
        words = words[sizes[words] > at]
    for i in np.flatnonzero(sizes > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[first[i] : last[i]])
    return h


class Shingler:
    """The set of `width`-word shingles of a text as sorted distinct 64-bit hashes.

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer words is one shingle as a whole, one
    without words has none. Words are hashed together, in a buffer of many texts.
    """

    def __init__(self, width: int):
        self.width = width

    def _words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word; long data is cut at white space."""
        starts, hashes, at = [], [], 0
        while at < len(data):
            end = len(data)
            if end - at > PIECE:
                part = np.frombuffer(data, np.uint8, PIECE, at)
                spaces = np.flatnonzero(_SPACE[part])
                if len(spaces):
                    end = at + int(spaces[-1]) + 1
                else:  # a word longer than a piece
                    rest = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, len(data) - at - PIECE, at + PIECE)])
                    end = at + PIECE + int(rest[0]) + 1 if len(rest) else end
            own = data[at:end].translate(_LOWER)
            space = _SPACE[np.frombuffer(own, np.uint8)]
            edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
            first, last = edge[::2], edge[1::2]
            hashes.append(word_hashes(own, first, last))
            starts.append(first + at)
            at = end
        return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))

    def _windows(self, words: np.ndarray, width: int) -> np.ndarray:
        n = max(0, len(words) - width + 1)
        h = np.full(n, width, np.uint64)
        for j in range(width):
            h = mixed(h * _STEP + words[j : j + n])
        return h

    def of_texts(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The sets of the texts, in order."""
        for own, _, _ in self.with_words(texts):
            yield own

    def with_words(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The sets of the texts, in order, each with the hashes of the text's words and the place of each shingle's first word."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= PIECE:
                yield from self._of_piece(held)
                held, size = [], 0
        if held:
            yield from self._of_piece(held)

    def _of_piece(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        starts, words = self._words(b" ".join(texts))
        windows = self._windows(words, self.width)
        ends = np.cumsum([len(t) + 1 for t in texts])
        bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= self.width:
                own, first = np.unique(windows[a : b - self.width + 1], return_index=True)
                yield own, words[a:b], first
            else:
                own = self._windows(words[a:b], b - a) if b > a else words[:0]
                yield own, words[a:b], np.zeros(len(own), np.int64)


def set_digest(shingles: np.ndarray) -> int:
    """A signed 64-bit digest of a set, never 0."""
    return (xxhash.xxh3_64_intdigest(shingles.tobytes()) | 1) - (1 << 63)
