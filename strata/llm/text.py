"""Vectorised words and n-gram hashes of Arrow string columns.

Texts stay the UTF-8 bytes that Arrow holds; numpy finds the words of about a
megabyte of texts at a time, so memory follows the chunk (or the one longest
text), never the batch or the partition.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

#: Bytes that separate words: space and tab, line feed, vertical tab, form feed, carriage return.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
LOWER_TABLE = np.frombuffer(LOWER, np.uint8)
#: Byte masks of the two word definitions; UTF-8 continuation and lead bytes are word bytes in both.
NON_SPACE = np.array([b not in SPACES for b in range(256)])
ALNUM = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])

U = np.uint64
# glibc keeps freed blocks up to the size of the largest one given back so far: arrays of a chunk are then reused, not mapped anew
np.empty(8 << 20, np.uint8)
#: Modulus of the polynomials over ranges, and the bases of their lanes: two lanes make a hash, two more a second one.
PRIME = (1 << 31) - 1
BASES = ((1_566_083_941, 1_103_515_245), (668_265_263, 1_812_433_253))
_MOST, _HALF = U(PRIME), U(31)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Chunk(NamedTuple):
    """Consecutive rows of a batch: their bytes end to end and where each row starts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


class Words(NamedTuple):
    """Words of a chunk in order: byte range, row within the chunk, two 64-bit hashes of the bytes."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    more: np.ndarray


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Rows of a string column in runs of about ``most`` bytes; a null text counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        to = min(to, len(column))
        yield Chunk(at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        at = to


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number with the same remainder modulo :data:`PRIME`, in place."""
    high = x >> _HALF
    x &= _MOST
    x += high
    return x


def _remainder(x: np.ndarray) -> np.ndarray:
    """``x`` modulo :data:`PRIME`, in place."""
    x = _fold(_fold(x))
    return np.subtract(x, _MOST, out=x, where=x >= _MOST)


def _steps(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = _remainder(out[:more] * U(pow(base, done, PRIME)))
        done += more
    return out


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base and of its inverse, modulo :data:`PRIME`."""
    if len(_powers.get(base, ((),))[0]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        _powers[base] = _steps(base, size), _steps(pow(base, -1, PRIME), size)
    up, down = _powers[base]
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Sums(NamedTuple):
    """Prefix sums of two polynomials modulo :data:`PRIME` (not reduced) and their bases."""

    lanes: tuple[np.ndarray, np.ndarray]
    bases: tuple[int, int]


def _summed(halves, bases: tuple[int, int]) -> Sums:
    out = []
    for base, half in zip(bases, halves):
        sums = np.zeros(len(half) + 1, U)
        half *= powers(base, len(half))[0]
        np.cumsum(_fold(half), out=sums[1:])           # terms below 2**32 add up without overflow for 2**32 of them
        out.append(sums)
    return Sums(tuple(out), bases)


def rolling(values: np.ndarray, second: bool = False) -> Sums:
    """Prefix sums from which :func:`between` reads the hash of any range; ``second``: of the other two polynomials."""
    return _summed((values & _MOST, values >> U(33)), BASES[second])


def _joined(low: np.ndarray, high: np.ndarray, size) -> np.ndarray:
    low = low << U(32)
    low |= high
    low += mix(np.asarray(size, U))
    return mix(low)


def between(sums: Sums, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the values in each range; it depends on them and their order, not on where the range is."""
    return _joined(*(_remainder(_remainder(lane[end] - lane[start]) * powers(base, len(lane))[1][start]) for lane, base in zip(*sums)), end - start)


def sliding(sums: Sums, k: int) -> np.ndarray:
    """The hash of every ``k`` consecutive values, as :func:`between` gives it."""
    n = len(sums.lanes[0]) - k
    if n <= 0:
        return np.zeros(0, U)
    return _joined(*(_remainder(_remainder(lane[k:] - lane[:n]) * powers(base, len(lane))[1][:n]) for lane, base in zip(*sums)), [k])


def byte_sums(data: np.ndarray, second: bool = False) -> Sums:
    return _summed((np.add(data, 1, dtype=U) for _ in range(2)), BASES[second])


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each byte range, eight bytes at a time scrambled into a running state: for short ranges."""
    size = end - start
    one, two = mix(size.astype(U) + U(0x9E3779B97F4A7C15)), mix(size.astype(U) + U(0xD6E8FEB86659FD93))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    open_, at = np.arange(len(start)), 0
    while True:
        open_ = open_[size[open_] > at]
        if not len(open_):
            return one, two
        left = size[open_] - at
        block = blocks[start[open_] + at]
        short = left < 8
        block[short] &= (U(1) << (left[short] * 8).astype(U)) - U(1)
        one[open_] = mix(one[open_] ^ block)
        two[open_] = mix((two[open_] + block) * U(0xFF51AFD7ED558CCD))
        at += 8


def words(chunk: Chunk, word: np.ndarray, lower: bool) -> Words:
    """Words of every row; ``word`` says which bytes belong to words, after A-Z are lower-cased if ``lower``."""
    data = LOWER_TABLE[chunk.data] if lower else chunk.data
    n, offsets = len(data), chunk.offsets
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, U), np.zeros(0, U))
    inside = word[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1]
    before[edges[edges < n]] = False
    after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(start, end, row, *range_hashes(data, start, end))


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of ``k`` words within a row."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    first = np.flatnonzero(w.row[:n] == w.row[k - 1:])
    return first, sliding(rolling(w.hash), k)[first]


def bounds(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's entries start in ``row``, which is sorted; one more entry for the end."""
    return np.searchsorted(row, np.arange(rows + 1), side="left")


_shipped: set[str] = set()


#: Rows of the Arrow batches that Python workers get: texts of some kilobytes make batches of some megabytes.
BATCH_ROWS = 2000


def ship(spark) -> None:
    """Make this package importable on the executors of ``spark`` (once per application), and its batches of texts small."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="strata-package-"), "strata_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
