"""Vectorised text helpers: words, 64-bit word and shingle hashes over Arrow string arrays.

Texts are handled as UTF-8 bytes in blocks of about a megabyte (one text at
least), so memory follows the longest text and never the batch.  Hashes are
uint64; equal inputs give equal hashes in every process.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240601)
BYTE_MIX = _rng.integers(1, 2**64, 256, dtype=np.uint64, endpoint=False) | np.uint64(1)
_POSITION = _rng.integers(1, 2**64, 64, dtype=np.uint64, endpoint=False) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)

# Separators of the word rule [^\x20\x09-\x0D]+ and ASCII lower-casing.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Letters, digits and every byte of a non-ASCII character.
IS_ALNUM = np.zeros(256, bool)
IS_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES):
    """Yield ``(first_row, bytes, offsets)``; a null text counts as empty.

    ``offsets`` has one entry more than the rows of the block and starts at 0.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if n == 0:
        return
    _, offs, data = texts.buffers()
    off = np.frombuffer(offs, np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def find_words(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray | None = None):
    """Byte starts, byte ends and row of every word of a block."""
    w = ~IS_SPACE[buf] if is_word is None else is_word[buf]
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    edges = off[(off > 0) & (off < n)]
    first[edges] = w[edges]
    last[edges - 1] = w[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 64) - 1, _BASE, np.uint64)]))
    return _powers


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word's bytes (ASCII lower-cased if asked)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lens = ends - starts
    base = np.cumsum(lens) - lens
    pos = np.arange(int(lens.sum())) - np.repeat(base, lens)
    at = pos + np.repeat(starts, lens)
    b = buf[at]
    if lower:
        b = LOWER[b]
    with np.errstate(over="ignore"):
        h = np.add.reduceat(BYTE_MIX[b] * _power_table(int(lens.max()))[pos], base)
        return mix64(h + lens.astype(np.uint64) * _BASE)


def hash_shingles(words: np.ndarray, rows: np.ndarray, k: int):
    """Hashes and first-word indices of all ``k``-word windows inside one row."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        s = words[:n] * _POSITION[0]
        for j in range(1, k):
            s = s + words[j:j + n] * _POSITION[j]
        s = mix64(s)
    at = np.flatnonzero(rows[:n] == rows[k - 1:])
    return s[at], at


def hash_sequence(words: np.ndarray) -> np.ndarray:
    """One hash for a short word sequence (up to 60 words), told apart by its length."""
    with np.errstate(over="ignore"):
        s = (words * _POSITION[:len(words)]).sum(dtype=np.uint64) + np.uint64(len(words)) * _BASE
        return mix64(np.array([s], np.uint64))


def crc_remainder(id_col: str, modulus: int):
    """Column ``crc32(id as text) mod modulus``; a null id counts as empty text."""
    from pyspark.sql import functions as F
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus
