"""Hashes of all words of a text at once, in numpy."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20)
#: A random 64-bit number for each byte, and powers of an odd factor by place in a word.
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_PLACES = 4096
_POWER = np.cumprod(np.full(_PLACES, 0x9E3779B97F4A7C15, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; different numbers stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_class(ends_word: bytes) -> np.ndarray:
    """A table by byte: True for all but the given bytes."""
    table = np.ones(256, bool)
    table[list(ends_word)] = False
    return table


def word_hashes(
    data: np.ndarray, is_word: np.ndarray, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """Hash and start of every word of ``data``, an array of bytes, then the hashes
    of the words' first bytes, for each number in ``prefixes``.

    Words are runs of bytes for which ``is_word`` holds. The hash is a
    polynomial in 64 bits over random byte values, mixed; words that differ
    share one with a chance of about 2**-60.
    """
    inside = is_word[data]
    step = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, *[np.zeros(0, np.uint64) for _ in prefixes]
    lengths = ends - starts
    at = np.flatnonzero(inside)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(first, lengths)
    value = _BYTE[data[at]] * _POWER[place % _PLACES]
    long = place >= _PLACES
    if long.any():
        value[long] = mixed(value[long] + (place[long] // _PLACES).astype(np.uint64))
    hashes = mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64))
    begun = [mixed(np.add.reduceat(np.where(place < p, value, 0), first) - np.uint64(p)) for p in prefixes]
    return hashes, starts, *begun
