"""Words of many texts at once, as spans and hashes of one byte buffer, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Characters of texts that are worked on at once; arrays take some 100 bytes a character.
SLAB_CHARS = 500_000
BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)

#: A word byte: an ASCII letter or digit, or any byte of another character.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least ``n`` of each."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            up = np.full(size, BASE, np.uint64)
            down = np.full(size, _INVERSE, np.uint64)
            up[0] = down[0] = np.uint64(1)
            _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a hash's bits over its high end."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """``buffer`` holds the lower-cased texts, each after a line break; words are ``starts`` to ``ends``, of text ``owner``.

    Text i has the words ``first[i]`` to ``first[i + 1]``.
    """

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes: a polynomial of the buffer, shifted to the word's start."""
        up, down = _power_tables(len(self.buffer) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(self.buffer) + 1, np.uint64)
            np.cumsum(self.buffer * up[: len(self.buffer)], out=sums[1:])
            return mixed((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))


def words_of(texts: list[str | None]) -> Words:
    """The words of texts; a null text has none."""
    parts = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    buffer = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8)
    inside = WORD_BYTE[buffer]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = turns[::2], turns[1::2]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    at = np.cumsum(sizes) - sizes  # the break before each text
    first = np.append(np.searchsorted(starts, at), len(starts))
    owner = np.repeat(np.arange(len(parts)), np.diff(first))
    return Words(buffer, starts, ends, owner, first)


def slabs(texts: list[str | None], limit: int = SLAB_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with at most ``limit`` characters, or one longer text."""
    start = held = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)

