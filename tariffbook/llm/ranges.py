"""Numbered ranges of rows in ascending order of an id and then a hash, of about equal size.

Cuts are quantiles of the id column. An id that holds several of them, and rows
without an id, are spread over as many ranges by a hash of the row, so that no
id is one task's work. A range is looked up by a binary search in an array, so
neither a plan nor an expression grows with the number of ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Ranges:
    """``nulls`` ranges for rows without an id come first; then those of the ids, by ``cuts``."""

    nulls: int
    cuts: np.ndarray  # distinct, ascending
    times: np.ndarray  # how many ranges an id that is a cut has to itself, 0 for none

    def __post_init__(self):
        # The ranges up to a cut: one for the ids between the last cut and it, then its own.
        self.first = self.nulls + np.cumsum(np.append(0, 1 + self.times))

    @property
    def count(self) -> int:
        return int(self.first[-1]) + 1

    def number(self, ids: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The range of each row, by its id (null for none) and a hash of 64 bits, signed."""
        missing = np.asarray(ids.is_null())
        values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        share = (hashes.astype(np.int64) ^ np.int64(-(2**63))).view(np.uint64) >> np.uint64(32)  # in the order of the hashes

        def part(of: np.ndarray) -> np.ndarray:
            return (share * of.astype(np.uint64) >> np.uint64(32)).astype(np.int64)

        at = np.searchsorted(self.cuts, values)
        out = self.first[at]
        own = np.append(self.times, 0)[at]
        is_cut = np.append(self.cuts, 0)[at] == values
        hot = is_cut & (at < len(self.cuts)) & (own > 0)
        out = np.where(hot, out + 1 + part(own), out)
        return np.where(missing, part(np.full(len(values), self.nulls)), out)


def ranges_of(rows: DataFrame, column: str, count: int) -> Ranges:
    """``count`` ranges, or some more, of about equal numbers of rows."""
    some, whole = rows.agg(F.count(column), F.count("*")).first()
    nulls = max(1, round(count * (whole - some) / max(1, whole)))
    found = rows.approxQuantile(column, [i / count for i in range(1, count)], 0.1 / count) if some and count > 1 else []
    cuts, times = np.unique(np.array(found, np.float64), return_counts=True)
    # Quantiles are doubles: one that is no id as it stands still parts the ids, but then has none to itself.
    whole_ids = np.floor(cuts)
    cuts, at = np.unique(whole_ids.clip(-(2**63), 2**63 - 1024).astype(np.int64), return_index=True)
    return Ranges(nulls, cuts, np.where(times[at] > 1, times[at], 0))
