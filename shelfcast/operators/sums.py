"""Counts and sums of many columns at once, in numpy over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# What is summed up per column: known values, those of them with a day, and sums of values, of values times day and of squares.
PARTIAL_SUMS = {"known": "long", "dated": "long", "total": "double", "by_day": "double", "square": "double"}


def _runs(codes: list[np.ndarray], n: int) -> np.ndarray:
    """Where rows differ from the row before."""
    new = np.ones(n, bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in codes], axis=0)
    return np.flatnonzero(new)


def partial_sums(n_keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For batches of keys, day and an array of numbers: a row per key and batch with its number of rows and PARTIAL_SUMS, arrays with a
    place per number. A NULL counts in none; without a day, a number counts in the sums that need none. Keys that lie apart in a
    batch are put together."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            codes = [batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy() for k in range(n_keys)]
            starts = _runs(codes, n)
            if len(starts) > max(n // 8, 1):
                order = np.lexsort(codes)
                batch, codes = batch.take(pa.array(order)), [c[order] for c in codes]
                starts = _runs(codes, n)
            day, numbers = batch.column(n_keys), batch.column(n_keys + 1).flatten()
            x = numbers.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(n, -1)
            has_day = day.is_valid().to_numpy(zero_copy_only=False)
            sizes = np.diff(starts, append=n)
            known = dated = np.repeat(sizes[:, None], x.shape[1], axis=1)
            if numbers.null_count:
                valid = numbers.is_valid().to_numpy(zero_copy_only=False).reshape(n, -1)
                known = dated = np.add.reduceat(valid, starts, axis=0, dtype=np.int64)
            by_day = x * day.fill_null(0.0).to_numpy(zero_copy_only=False)[:, None]
            if day.null_count:
                by_day[~has_day] = 0.0
                dated = np.add.reduceat(has_day[:, None] & (valid if numbers.null_count else True), starts, axis=0, dtype=np.int64) + 0 * known
            sums = [known, dated, *(np.add.reduceat(v, starts, axis=0) for v in (x, by_day, x * x))]
            places = pa.array(np.arange(len(starts) + 1, dtype=np.int32) * x.shape[1])
            sums = [pa.ListArray.from_arrays(places, pa.array(v.ravel())) for v in sums]
            at = pa.array(starts)
            keys = [batch.column(k).take(at) for k in range(n_keys)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(sizes), *sums], [*batch.schema.names[:n_keys], "n", *PARTIAL_SUMS])

    return of_batches
