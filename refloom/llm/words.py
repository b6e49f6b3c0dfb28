"""Vectorised words: positions and 64-bit names of the white-space separated words of many texts at once.

Works on the UTF-8 bytes of an Arrow string column without making a Python object for each word. A word is
``[^\\x20\\x09-\\x0D]+``. A name is a polynomial over the word's bytes modulo 2**64, mixed with its length: equal
words have equal names in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
BLOCK = 1 << 19  # bytes hashed at a time
CHUNK = 1 << 21  # bytes of text handled together
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 2 * BLOCK)
        for name, b in (("up", BASE), ("down", BASE_INVERSE)):
            p = np.full(size, b, U)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each text's bounds in them; null is empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), bounds


def chunks(b: pa.RecordBatch, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of some megabytes of text (one text at least)."""
    _, bounds = text_bytes(b.column("text"))
    i = 0
    while i < b.num_rows:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        yield b.slice(i, j - i)
        i = j


class Words:
    """names: of each word; start, end: its bytes; first: each text's first word, and the number of all at the end."""

    def __init__(self, column: pa.Array, lower: bool = False, table: np.ndarray | None = None):
        """table: what each byte is read as, for words that are cut or folded in another way; raw keeps the bytes."""
        data, bounds = text_bytes(column)
        self.origin = int(bounds[0])
        data = data[self.origin : int(bounds[-1])]
        table = LOWER if lower else table
        self.raw, self.data, bounds = data, (data if table is None else table[data]), bounds - bounds[0]
        word = ~SPACE[self.data]
        n = len(word)
        edge = bounds[:-1][(bounds[1:] > bounds[:-1])] if n else np.zeros(0, np.int64)
        start, end = word.copy(), word.copy()
        if n:
            start[1:] &= ~word[:-1]
            end[:-1] &= ~word[1:]
            start[edge] = word[edge]
            inner = edge[edge > 0] - 1
            end[inner] = word[inner]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.bounds = bounds
        self.names = self.named(self.start, self.end)
        self.counts = np.diff(self.first)

    def named(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Names of the bytes from start to end (both in order)."""
        out, i, n = np.empty(len(start), U), 0, len(start)
        while i < n:
            low = int(start[i])
            j = max(i + 1, int(np.searchsorted(end, low + BLOCK, "right")))
            high = int(end[j - 1])
            up, down = powers(high - low + 1)
            sums = np.zeros(high - low + 1, U)
            np.cumsum((self.data[low:high].astype(U) + U(1)) * up[: high - low], out=sums[1:])
            s, e = start[i:j] - low, end[i:j] - low
            out[i:j] = mix((sums[e] - sums[s]) * down[s] ^ (e - s).astype(U) * U(0xD6E8FEB86659FD93))
            i = j
        return out

    def document(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def prefix_sums(names: np.ndarray) -> np.ndarray:
    """Sums from which ``content`` names any range of names."""
    out = np.zeros(len(names) + 1, U)
    np.cumsum(names * powers(len(names) + 1)[0][: len(names)], out=out[1:])
    return out


def content(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The name of names[start:end], equal for equal sequences."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start] ^ (end - start).astype(U) * U(0xA0761D6478BD642F))
