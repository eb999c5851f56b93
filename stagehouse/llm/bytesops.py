"""Numpy helpers that work on many texts at once, laid end to end as bytes.

They run inside tasks on blocks of bounded size; ``blocks`` cuts a batch of
texts into runs of about ``BLOCK`` bytes (a longer text is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BLOCK = 1 << 20
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

U = np.uint64


def as_bytes(texts: Sequence[bytes | str | None]) -> list[bytes]:
    """Texts as UTF-8; tasks get them as binary, which spares a decoding and a copy."""
    return [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def blocks(texts: Sequence[bytes], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges [first, last) of texts with about ``most`` bytes each."""
    first = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= most:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def lay_out(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with one space after each, and where each begins (one more at the end)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(sizes, out=starts[1:])
    return np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8), starts


def word_spans(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the laid-out texts begin and end."""
    inside = np.zeros(len(flat) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACES[flat]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def planes(x: np.ndarray) -> bytes:
    """Bytes of an array by significance, so that small numbers compress to little."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class Rolling:
    """Polynomial hashes of any span of a byte array, modulo 2**64.

    Bytes are first mapped to scrambled 64-bit values; spans are compared by
    their sums of value x base**place, brought to place 0.
    """

    def __init__(self, base: int = 0x9E3779B97F4A7C15, seed: int = 1) -> None:
        self.base = base | 1
        self.values = mix64(np.arange(1, 257, dtype=np.uint64) * U(0xD6E8FEB86659FD93) + U(seed))
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def _reach(self, n: int) -> None:
        while len(self.up) < n:
            size = len(self.up)
            step = pow(self.base, size, 1 << 64)
            back = pow(step, -1, 1 << 64)
            self.up = np.concatenate([self.up, self.up * U(step)])
            self.down = np.concatenate([self.down, self.down * U(back)])

    def sums(self, flat: np.ndarray) -> np.ndarray:
        n = len(flat)
        self._reach(n + 1)
        out = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.values[flat] * self.up[:n], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (sums[ends] - sums[starts]) * self.down[starts]
        return mix64(raw ^ (ends - starts).astype(np.uint64) * U(0xA24BAED4963EE407))


WORD_HASH = Rolling()


def word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words given by their spans."""
    return WORD_HASH.spans(WORD_HASH.sums(flat), starts, ends)
