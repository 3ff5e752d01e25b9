"""64-bit hashes of the words of whole texts, by array operations over the UTF-8 bytes.

Words are maximal runs without the bytes 0x20 and 0x09-0x0D; A-Z count as a-z. A word's hash is
sum(table[byte_i] * R**i) modulo 2**64, mixed with its length; it depends on nothing but the word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
R, MASK = 0x9E3779B97F4A7C15 | 1, (1 << 64) - 1
R_INV = pow(R, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTES = np.arange(256, dtype=np.uint64)
LOWER = BYTES + U(32) * ((BYTES >= 65) & (BYTES <= 90))
TABLE = mix((LOWER + U(1)) * U(0xD6E8FEB86659FD93))
SPACE = (BYTES == 32) | ((BYTES >= 9) & (BYTES <= 13))
POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept in the worker."""
    if len(POWERS.get(base, ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        POWERS[base] = np.multiply.accumulate(out)
    return POWERS[base][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column in a row, and where each begins and the last ends."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the offsets of the texts in them."""
    buf, offsets = text_bytes(column)
    if not len(buf):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~SPACE[buf]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(buf))]
    begins[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends)
    terms = TABLE[buf] * powers(R, len(buf))
    sums = np.cumsum(terms, dtype=np.uint64)
    hashes = (sums[stop] - sums[start] + terms[start]) * powers(R_INV, len(buf))[start]
    hashes = mix(hashes + (stop - start).astype(np.uint64) * U(0xA0761D6478BD642F))
    return hashes, np.searchsorted(start, offsets).astype(np.int64)


def window_hashes(words: np.ndarray, n: int, lead: int = 0x9E6C63D0876A9A47) -> np.ndarray:
    """Hashes of all windows of ``n`` words; none if there are fewer."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(words) - n + 1, lead, dtype=np.uint64)
    for i in range(n):
        out = mix(out * U(0x9FB21C651E98DF25) + words[i : len(words) - n + 1 + i])
    return out
