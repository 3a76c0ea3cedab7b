"""Uniform samples of fixed size from data of unknown size, mergeable across pieces."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "sample_key"

#: Partitions of which one task merges the heaps, before the last merge.
MERGED_AT_ONCE = 1000


def _heap(size: int):
    """Keeps the rows with the ``size`` smallest keys of all batches of a task, in memory bounded by twice as many and a batch."""

    def best(rows: pa.Table) -> pa.Table:
        if rows.num_rows <= size:
            return rows
        keys = rows.column(KEY).to_numpy()
        return rows.take(np.sort(np.argpartition(keys, size - 1)[:size]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap, bound = None, np.inf
        for batch in batches:
            low = np.flatnonzero(batch.column(KEY).to_numpy() < bound)
            if not len(low):
                continue
            fresh = pa.Table.from_batches([batch.take(pa.array(low))])
            heap = fresh if heap is None else pa.concat_tables([heap, fresh])
            if heap.num_rows >= 2 * size:
                heap = best(heap).combine_chunks()
                bound = heap.column(KEY).to_numpy().max()
        if heap is not None:
            yield from best(heap).to_batches()

    return run


def keyed_sample(df: DataFrame, size: int, seed: int = 42, columns: list[str] | None = None, row: list[Column] | None = None) -> DataFrame:
    """``size`` rows of ``df`` (all, if there are fewer) with their ``sample_key``, every row equally likely.

    Each row draws an independent uniform key in [0, 1); the rows with the ``size``
    smallest are kept. Each task holds a bounded heap of that many rows, so nothing is shuffled but kept rows;
    heaps are merged a thousand partitions at a time, and then all, so that no
    merge grows with the number of partitions beyond that. Nothing about the total needs to be known: the kept keys let
    samples of further pieces be merged later (:func:`merged_sample`).

    ``row`` names a delivered row (its file and the number in it, for instance): the key is then a hash of it, so
    that the sample depends neither on the partitions nor on a task being run again. Without it, a row's key
    depends on its place in its partition.

    Repeated rows draw separately. Null or empty values don't matter. A column
    of ``df`` named ``sample_key`` is replaced. An empty table gives an empty sample.
    """
    if size < 1:
        raise ValueError("a sample has at least one row")
    kept = columns or [c for c in df.columns if c != KEY]
    # the upper 53 bits of a hash are a uniform number
    key = F.rand(seed) if row is None else F.shiftrightunsigned(F.xxhash64(F.lit(seed), *row), 11) / F.lit(float(1 << 53))
    keyed = df.select(key.alias(KEY), *(F.col(c) for c in kept))
    heaps = keyed.mapInArrow(_heap(size), keyed.schema)
    merged = heaps.withColumn("_merge", F.floor(F.spark_partition_id() / MERGED_AT_ONCE)).repartition("_merge").drop("_merge")
    return merged.mapInArrow(_heap(size), keyed.schema).orderBy(KEY).limit(size).select(*kept, KEY)


def delivered_row(df: DataFrame) -> list[Column]:
    """What tells a row of a table read from Parquet files apart from all others: its file and its number in it."""
    return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]


def merged_sample(samples: list[DataFrame], size: int) -> DataFrame:
    """The sample of ``size`` rows of all pieces together, out of what :func:`keyed_sample` kept of each.

    Valid if each piece kept at least ``size`` rows, or all it had, under seeds (or names of rows) of its own.
    """
    return reduce(DataFrame.unionByName, samples).orderBy(KEY).limit(size)


def uniform_sample(df: DataFrame, size: int, seed: int = 42, columns: list[str] | None = None, row: list[Column] | None = None) -> DataFrame:
    """As :func:`keyed_sample`, without the keys."""
    return keyed_sample(df, size, seed, columns, row).drop(KEY)


def sample_stream(stream: DataFrame, path: str, size: int, seed: int = 42):
    """A writer that keeps the sample of all rows of ``stream`` so far below ``path``, one generation per batch.

    Each micro-batch is a piece with a seed of its own; a repeated batch id
    rewrites its own generation, so replays after a failure change nothing.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        now = keyed_sample(batch, size, seed + 1 + batch_id)
        if batch_id > 0:
            now = merged_sample([now, batch.sparkSession.read.schema(now.schema).parquet(f"{path}/gen={batch_id - 1}")], size)
        now.write.mode("overwrite").parquet(f"{path}/gen={batch_id}")

    return stream.writeStream.foreachBatch(keep)
