"""Words of texts as 64-bit numbers, for many texts at once.

A word is a run of bytes other than blank, tab and line ends (``[^\\x20\\x09-\\x0D]+``),
taken unchanged. Texts are laid end to end so that numpy works on a whole part
of a batch; ``of`` says which text each word belongs to.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

U = np.uint64
#: Odd multiplier of the rolling hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@dataclass(frozen=True)
class Words:
    """Hashes of all words, the text of each, and where each text begins and ends."""

    hashes: np.ndarray
    of: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def words_of(texts: list[str]) -> Words:
    lists = [split(text) for text in texts]
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    number = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((number(w) for x in lists for w in x), dtype=U, count=int(sizes.sum()))
    end = np.cumsum(sizes)
    return Words(hashes, np.repeat(np.arange(len(texts)), sizes), end - sizes, end)


class Rolling:
    """Hashes of any stretch of words, from sums of powers; equal stretches have equal hashes anywhere."""

    def __init__(self, hashes: np.ndarray) -> None:
        n = len(hashes)
        self.sums = np.zeros(n + 1, dtype=U)
        self.back = np.empty(n + 1, dtype=U)
        self.back[0] = 1
        self.back[1:] = U(INVERSE)
        np.cumprod(self.back, out=self.back)
        power = np.full(n, U(BASE))
        if n:
            power[0] = 1
        np.cumsum(hashes * np.cumprod(power, dtype=U), out=self.sums[1:])

    def of(self, first: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hashes of the stretches of ``length`` words from ``first``."""
        length = np.asarray(length)
        total = (self.sums[first + length] - self.sums[first]) * self.back[first]
        return mixed(total + length.astype(U))


def as_long(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as Spark's longs."""
    return x.view(np.int64)
