"""A bit table of fixed size: which residues of some 64-bit values occur.

It lets tasks leave out rows early, like the filters Spark pushes to the other side of a
join; whatever it lets through is decided by the exact join after it. Its size does not
depend on the data. Where it fills up it spares less, and nothing else changes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^26 bits, 8 MB.
CELLS = 1 << 20


class BitTable:
    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, values: DataFrame) -> BitTable:
        """The table of the one long column; Spark builds it, at most ``CELLS`` rows reach the driver."""
        name = values.columns[0]
        cell = F.shiftrightunsigned(name, 6).bitwiseAND(CELLS - 1)
        bit = F.expr(f"shiftleft(1L, cast(`{name}` & 63 as int))")
        cells = values.where(F.col(name).isNotNull()).select(cell.alias("cell"), bit.alias("bit"))
        found = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
        bits = np.zeros(CELLS, np.uint64)
        bits[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return cls(bits)

    def holds(self, values: np.ndarray) -> np.ndarray:
        """For each 64-bit value whether its residue occurs."""
        values = values.view(np.uint64)
        cells = self.bits[((values >> np.uint64(6)) & np.uint64(CELLS - 1)).astype(np.int64)]
        return (cells >> (values & np.uint64(63))) & np.uint64(1) == 1
