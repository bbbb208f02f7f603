"""Bit filters: which values may be in a set, in a fixed number of bytes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bit_filter(rows: DataFrame, column: str, width: int) -> np.ndarray:
    """Bytes of a bit array in which the bit of every value's top ``width`` bits is set; values should be even hashes."""
    slot = F.shiftrightunsigned(column, 64 - width)
    found = rows.groupBy(F.shiftright(slot, 6).alias("at")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned({column}, {64 - width}) & 63 AS int)))").alias("word")).toArrow()
    out = np.zeros(1 << (width - 6), np.int64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out.view(np.uint8)


def has_bit(bits: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """Which of the unsigned 64-bit ``values`` may be in the filter."""
    slot = (values >> np.uint64(64 - width)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7)) & 1 == 1


def _scrambled(column: str):
    from strata.llm.text import U, mix

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(mix(batch.column(0).to_numpy(zero_copy_only=False).view(U)).view(np.int64))], [column])
    return run


class BitFilter(NamedTuple):
    """Which 64-bit hashes may be in a set: a bit array as wide as the set's measured size asks for."""

    bits: np.ndarray
    width: int

    @classmethod
    def of(cls, rows: DataFrame, column: str, per_value: int, most: int, scramble: bool = False) -> BitFilter:
        """A filter of the values of ``column``, with ``per_value`` bits for each, at most ``2**most`` (a wider set lets more through)."""
        if scramble:
            rows = rows.select(column).mapInArrow(_scrambled(column), f"{column} long")
        n = rows.agg(F.approx_count_distinct(column)).first()[0]
        width = min(most, max(13, int(n * per_value).bit_length()))
        return cls(bit_filter(rows, column, width), width)

    def holds(self, values: np.ndarray) -> np.ndarray:
        return has_bit(self.bits, values, self.width)

    def rows(self, at: int, wanted: bool = True):
        """For ``mapInArrow``: rows whose column ``at`` may be in the filter (or cannot, if not ``wanted``)."""
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(self.holds(batch.column(at).to_numpy(zero_copy_only=False).view(np.uint64)) == wanted))
        return run
