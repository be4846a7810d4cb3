"""Whole-batch text work in numpy: words, rolling hashes and runs over the bytes of an Arrow column.

Everything here works on one slice of a task's rows. A slice holds whole texts of at most
``SLICE_BYTES`` together, or one text that is longer.
"""

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SEED = np.random.default_rng(20240229)
BYTE_CODES = _SEED.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# Byte classes, fixed by the meaning of a word in each operator.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~SPACES
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** 0 … base ** (n - 1)`` modulo 2**64, kept between calls."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 2 * (len(have) if have is not None else 0), SLICE_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[int(base)] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """``(first row, bytes, offsets)`` for runs of rows of a string column; a missing text is empty.

    ``offsets`` has one entry more than the run has rows and starts at 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    column = column.fill_null("") if column.null_count else column
    if len(column) == 0:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offs, offs[row] + limit, "right")) - 1)
        stop = min(stop, len(column))
        yield row, data[offs[row]:offs[stop]], offs[row:stop + 1] - offs[row]
        row = stop


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
    """``(start, end, first)``: byte spans of the runs of member bytes, none across two texts, and for
    every text the number of its first word (one more entry at the end)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = member[data]
    change = np.empty(len(data) + 1, bool)
    change[0] = inside[0] if len(data) else False
    change[1:] = inside[1:] != inside[:-1]
    joins = offsets[1:-1]
    joins = joins[(joins > 0) & (joins < len(data))]
    joins = np.unique(joins[inside[joins] & inside[joins - 1]])
    edges = np.flatnonzero(change)
    start, end = edges[0::2], edges[1::2]
    if len(joins):
        start = np.sort(np.concatenate([start, joins]))
        end = np.sort(np.concatenate([end, joins]))
    return start, end, np.searchsorted(start, offsets)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * powers(BASE, len(data)), out=sums[1:])
    h = (sums[end] - sums[start]) * powers(BASE_INVERSE, len(data) + 1)[start]
    return mix(h + (end - start).astype(np.uint64) * BASE)


def window_hashes(word_hash: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of every ``width`` consecutive words; those that cross texts are for the
    caller to leave out."""
    n = len(word_hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(word_hash) + 1, np.uint64)
    np.cumsum(word_hash * powers(BASE, len(word_hash)), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * powers(BASE_INVERSE, n))


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Mask over the window positions of a slice: true where the window lies within one text."""
    n = int(first[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return text_of[:n] == text_of[width - 1:]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out
