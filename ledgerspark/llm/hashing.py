"""Words and word shingles of whole Arrow batches as 64-bit hashes, in numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes hashed at a time; a batch is cut between rows near the second figure.
CHUNK = 1 << 18
SLICE = 1 << 20

#: Separators of a word: blank, tab to carriage return.
BLANKS = np.zeros(256, bool)
BLANKS[[32, *range(9, 14)]] = True
#: Separators of a bare word: every ASCII character but letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

SAME = np.arange(256, dtype=np.uint8)
_LOWER = SAME.copy()
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(BASE, CHUNK), _powers(_BASE_INVERSE, CHUNK)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the bounds of its rows; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


#: The C library's own way to hand freed memory back; other libraries than glibc have none.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Hands freed memory back to the system.

    A Python worker serves one task after the other, and both allocators keep what its largest
    slices took; the executor needs it for other tasks.
    """
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``most`` bytes of text, at least one row each.

    After the last run, memory that the caller has freed goes back to the system.
    """
    if not batch.num_rows:
        return
    _, bounds = utf8(batch.column(text))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end
    give_back()


def _hash_chunk(raw: np.ndarray, edges: np.ndarray, blanks: np.ndarray, heads: tuple[int, ...], fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of a chunk; ``edges``: where rows begin in it."""
    word = ~blanks[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = edges[(edges > 0) & (edges < len(raw))]
    first[inner] = word[inner]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[inner - 1] = word[inner - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = (_UP, _DOWN) if len(raw) <= CHUNK else (_powers(BASE, len(raw)), _powers(_BASE_INVERSE, len(raw)))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((fold[raw].astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    stops = [stop, *(np.minimum(stop, start + n) for n in heads)]
    hashes = [mix((total[e] - total[start]) * down[start] + (e - start).astype(np.uint64)) for e in stops]
    return np.stack(hashes, axis=1) if heads else hashes[0], start


def word_hashes(raw: np.ndarray, bounds: np.ndarray, blanks: np.ndarray = BLANKS, heads: tuple[int, ...] = (), fold: np.ndarray = _LOWER) -> tuple[np.ndarray, np.ndarray]:
    """One hash per word, row after row, and the place of each row's first word.

    Bytes are folded first: by default A-Z count as a-z.

    With ``heads``, further columns hold the hashes of the words' first bytes, so many each.

    Works through the bytes in chunks that end at a separator, so that a very long text needs
    little more than its own hashes.
    """
    hashes, starts, at = [], [], 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        while end < len(raw):
            gap = np.flatnonzero(blanks[raw[end:end + 4096]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(raw), end + 4096)
        a, b = np.searchsorted(bounds, [at, end])
        h, s = _hash_chunk(raw[at:end], bounds[a:b] - at, blanks, heads, fold)
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.zeros((0, 1 + len(heads)) if heads else 0, np.uint64), np.zeros(len(bounds), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each row, and the place of each row's first.

    A row of fewer words has its whole sequence as one run; a row without words has none.
    """
    counts = np.diff(bounds)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(runs)])
    if not len(words):
        return np.zeros(0, np.uint64), out_bounds
    at = np.arange(out_bounds[-1]) + np.repeat(bounds[:-1] - out_bounds[:-1], runs)
    have = np.repeat(np.minimum(counts, size), runs)
    short = counts.min() < size
    total = have.astype(np.uint64)
    for j, factor in enumerate(_powers(BASE, size)[1:]):
        part = words[np.minimum(at + j, len(words) - 1)] * factor
        total += np.where(have > j, part, np.uint64(0)) if short else part
    return mix(total), out_bounds


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each element that ``bounds`` deals to rows."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
