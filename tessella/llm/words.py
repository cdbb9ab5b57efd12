"""Words as 64-bit numbers, and hashes of their windows, for whole batches of texts at once."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash

#: Entries that a worker remembers at most; beyond that it starts anew, with the same results.
KEPT = 100_000
#: Characters of the texts that are worked on together.
TOGETHER = 1_000_000
STEP = np.uint64(0x9E3779B97F4A7C15)


class Memo(dict):
    """What ``make`` gives for each key asked, kept up to a bound."""

    def __init__(self, make: Callable) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) > KEPT:
            self.clear()
        value = self[key] = self.make(key)
        return value


def number(word: str | bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` numbers, one for each start that has so many after it."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = mix(out * np.uint64(3) + h[i : i + n] + STEP)
    return out


def starts(lengths: np.ndarray) -> np.ndarray:
    """First place of each text in the row of all texts' words."""
    return np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)


def batches(pdf, column: str = "_text", most: int = TOGETHER):
    """Rows whose texts together have about ``most`` characters at most, one row at least."""
    if len(pdf):
        for _, some in pdf.groupby(pdf[column].str.len().cumsum() // most, sort=True):
            yield some


_held: dict[str, Callable[[], None]] = {}


def hold(owner: str, release: Callable[[], None]) -> None:
    """Say that ``owner`` keeps things in this worker until ``release``; what other operators keep here is released now and given back to the system."""
    others = [name for name in _held if name != owner]
    for other in others:
        _held.pop(other)()
    _held[owner] = release
    if others:
        give_back()


def give_back() -> None:
    """Free memory of this worker goes back to the system, for the next operator of the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the allocator of most Linux systems keeps it otherwise
    if trim:
        trim(0)


def nothing() -> None:
    """To release where a partition's end has released all."""
