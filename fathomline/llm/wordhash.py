"""64-bit hashes of words, shingles and windows of many texts at once, in numpy.

A word's hash is a polynomial over its bytes, mixed; sequences of words combine the word hashes the same way, so equal word
sequences have equal hashes wherever they stand. That arithmetic is modulo 2^64.

Check sums are a second hash of the same kind modulo two primes, 62 bits in all: sequences that some structure makes collide
modulo a power of two do not collide modulo a prime for that reason.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE, _STEP = U(0x9E3779B97F4A7C15 | 1), U(0xD6E8FEB86659FD93)
_inv = pow(int(_BASE), -1, 1 << 64)
#: bytes of text hashed together; longer texts are hashed alone
CHUNK = 1 << 20


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection that spreads every bit of its input (the finaliser of splitmix64)."""
    x = x + U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 7)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_pow = np.ones(1, dtype=np.uint64)
_ipow = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _ipow
    if len(_pow) < n:
        a = np.full(n, _BASE, dtype=np.uint64)
        b = np.full(n, U(_inv), dtype=np.uint64)
        a[0] = b[0] = U(1)
        _pow, _ipow = np.multiply.accumulate(a), np.multiply.accumulate(b)
    return _pow[:n], _ipow[:n]


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive texts of a string column in pieces of about ``CHUNK`` bytes: first row, bytes, text boundaries.

    Null texts are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1
        j = min(max(j, i + 1), len(column))
        yield i, data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in ``data``, and for each text boundary the number of words before it."""
    inside = ~_IS_SPACE[data]
    n = len(data)
    breaks = np.zeros(n + 1, bool)
    breaks[bounds] = True  # a word never crosses into the next text
    before = np.concatenate(([False], inside[:-1])) if n else inside
    starts = np.flatnonzero(inside & (~before | breaks[:n]))
    after = np.concatenate((inside[1:], [False])) if n else inside
    ends = np.flatnonzero(inside & (~after | breaks[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    if lower:
        data = _LOWER[data]
    p, ip = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * p[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * ip[starts] + (ends - starts).astype(np.uint64))


def sequence_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words, by the index of their first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        acc = acc * _STEP + h[i: i + n]
    return mix(acc, k)


def prefix_hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Running sums from which ``span_hash`` takes the hash of any run of words."""
    p, ip = _powers(len(h) + 1)
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(mix(h, 11) * p[: len(h)], out=total[1:])
    return total, p, ip


def span_hash(sums: tuple[np.ndarray, np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total, _, ip = sums
    return mix((total[end] - total[start]) * ip[start] + (end - start).astype(np.uint64), 3)


# The two largest primes below 2^31, and a base for each.
_PRIMES = (U(2147483647), U(2147483629))
_BASES = (1103515245, 1812433253)
_prime_powers: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, dtype=np.uint64),) * 2] * 2


def _powers_modulo(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base modulo a prime, and of its inverse; doubled until there are enough of them."""
    prime = _PRIMES[k]
    if len(_prime_powers[k][0]) < n:
        both = []
        for base, known in zip((_BASES[k], pow(_BASES[k], -1, int(prime))), _prime_powers[k]):
            while len(known) < n:
                known = np.concatenate((known, known * U(pow(base, len(known), int(prime))) % prime))
            both.append(known)
        _prime_powers[k] = (both[0], both[1])
    p, ip = _prime_powers[k]
    return p[:n], ip[:n]


def _check_sums(values: np.ndarray, k: int) -> np.ndarray:
    """Running sums modulo nothing: each term is below 2^31, so 2^33 of them fit."""
    p, _ = _powers_modulo(k, len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * p[: len(values)] % _PRIMES[k], out=total[1:])
    return total


def _check_of(total: np.ndarray, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, ip = _powers_modulo(k, len(total))
    return (total[end] - total[start]) % _PRIMES[k] * ip[start] % _PRIMES[k]


def check_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Running sums over words, from which ``span_check`` takes the check sum of any run of them."""
    out = []
    for k in range(2):
        spread = mix(np.arange(256, dtype=np.uint64), 20 + k) % _PRIMES[k]
        words = _check_of(_check_sums(spread[data], k), k, starts, ends) + ((ends - starts).astype(np.uint64) << U(31))
        out.append(_check_sums(mix(words, 30 + k) % _PRIMES[k], k))
    return out


def span_check(sums: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _check_of(sums[0], 0, start, end) << U(31) | _check_of(sums[1], 1, start, end)
