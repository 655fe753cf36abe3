"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

Texts are taken as the UTF-8 bytes of an Arrow column. A word is a run of bytes that are no separators; a shingle is
n words in a row, and a text with fewer words is one shingle as a whole. A task holds one portion of rows at a time
(about `PORTION` bytes of text, or one longer text) and about 40 bytes of arrays for each of its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PORTION = 2 << 20
ROWS = 1024
#: Bits of a row number within a portion.
ROW_BITS = 10

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and ASCII punctuation.
PUNCTUATION = WHITE.copy()
PUNCTUATION[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PLAIN = np.arange(256, dtype=np.uint8)

_random = np.random.default_rng(20240607)
BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept for the next portion if of ordinary size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if n <= 2 * PORTION:
            _powers[base] = have
    return have[:n]


def portions(batches, column: str, limit: int = PORTION, rows: int = ROWS):
    """Cut Arrow batches so that each piece has about `limit` bytes of text and at most `rows` rows."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = 0
        ends = np.cumsum(sizes)
        while at < len(sizes):
            before = ends[at - 1] if at else 0
            end = min(max(int(np.searchsorted(ends, before + limit, "right")), at + 1), at + rows)
            yield batch.slice(at, end - at)
            at = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row's begin; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE):
    """Starts and ends of all words, and each row's first word."""
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens, closes = inside.copy(), inside
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def prefix_sums(data: np.ndarray, folded: np.ndarray = LOWER, base: int = BASE) -> np.ndarray:
    """Sums of byte values times powers of the base, so that any range's hash is a difference."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    values = BYTE_VALUES[folded][data]
    values *= powers(base, len(data))
    np.cumsum(values, out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, inverse: int = BASE_INVERSE) -> np.ndarray:
    hashes = sums[ends] - sums[starts]
    hashes *= powers(inverse, len(sums))[starts]
    hashes += (ends - starts).astype(np.uint64) * PLACES[-1]
    return mix(hashes)


def word_hashes(column: pa.Array, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word with A-Z lower-cased, and each row's first word (one more at the end)."""
    data, offsets = text_bytes(column)
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends, first = word_bounds(data, offsets, separators)
    return range_hashes(prefix_sums(data), starts, ends), first


def shingles(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each shingle of n words; rows with fewer words have one, rows without words none."""
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    if len(words) >= n:
        last = len(words) - n + 1
        full = words[:last] * PLACES[0]
        for j in range(1, n):
            full += words[j:last + j] * PLACES[j]
        whole = rows[:last] == rows[n - 1:]
        full, at = full[whole], rows[:last][whole]
    else:
        full, at = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        rest = counts[short].astype(np.uint64) * PLACES[-2]
        for j in range(n - 1):
            has = counts[short] > j
            rest[has] += words[first[short[has]] + j] * PLACES[j]
        full, at = np.concatenate([full, rest]), np.concatenate([at, short])
    return mix(full), at


def distinct(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct hashes, sorted by row, and where each row's begin (one more at the end).

    Row and hash share one 64-bit word for the sort, so 54 bits of each hash are kept.
    """
    bits = ROW_BITS
    keys = (rows.astype(np.uint64) << np.uint64(64 - bits)) | (hashes >> np.uint64(bits))
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    first = np.searchsorted(keys >> np.uint64(64 - bits), np.arange(n_rows + 1, dtype=np.uint64))
    return keys << np.uint64(bits), first


def shingle_sets(column: pa.Array, n: int, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, as `distinct` gives them."""
    words, first = word_hashes(column, separators)
    return distinct(*shingles(words, first, n), len(column))


def shared_counts(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row, how many hashes two lists of sets have in common."""
    n = len(left[1]) - 1
    rows = np.concatenate([np.repeat(np.arange(n), np.diff(side[1])) for side in (left, right)])
    hashes = np.concatenate([left[0], right[0]])
    bits = ROW_BITS
    keys = (rows.astype(np.uint64) << np.uint64(64 - bits)) | (hashes >> np.uint64(bits))
    keys.sort()
    twice = keys[1:][keys[1:] == keys[:-1]] >> np.uint64(64 - bits)
    return np.bincount(twice.astype(np.int64), minlength=n)
