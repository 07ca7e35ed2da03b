"""Searches by shard: a task reads a shard's vectors once and then answers the queries that were sent to it, as they stream by."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ITEM, QUERY = 0, 1


def matrix(column: pa.Array | pa.ChunkedArray, dims: int = 0) -> np.ndarray:
    """Lists as rows of float64, filled up with zeros to the longest, or to dims if that is more."""
    lists = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    offsets = lists.offsets.to_numpy().astype(np.int64)
    size = np.diff(offsets)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    out = np.zeros((len(size), max(dims, int(size.max(initial=0)))))
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def search_shards(rows: DataFrame, shards: int, build: Callable[[pa.Table], object], answer: Callable[[object, pa.Table], pa.Table], schema: str) -> DataFrame:
    """rows have `shard` and `kind` (ITEM or QUERY). Each shard's items are sorted before its queries: build makes an index of
    the items, answer gives the rows for a batch of queries. Memory follows a shard's items and a batch of queries, whatever the
    number of queries. A shard without items answers nothing."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, items, index = None, [], None
        for batch in batches:
            shard, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1]), True]) if batch.num_rows else np.zeros(1, np.int64)
            for lo, hi in zip(edges, edges[1:]):
                if shard[lo] != at:
                    at, items, index = shard[lo], [], None
                if kind[lo] == ITEM:
                    items.append(batch.slice(lo, hi - lo))
                elif items or index is not None:
                    if index is None:
                        index, items = build(pa.Table.from_batches(items)), []
                    yield from answer(index, pa.Table.from_batches([batch.slice(lo, hi - lo)])).to_batches()

    # twice as many partitions as shards, so that few hold several
    return rows.repartition(2 * shards, "shard").sortWithinPartitions("shard", "kind").mapInArrow(kernel, schema)
