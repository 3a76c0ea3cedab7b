"""The best N items of every group through bounded heaps kept before the shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows the heaps of one task may hold together before they are handed on.
HELD_ROWS = 250_000


def _rank_ready(column: pd.Series) -> np.ndarray:
    """Values numpy can sort: text becomes its order among the texts at hand."""
    return pd.factorize(column, sort=True)[0] if column.dtype == object else column.to_numpy()


def _smallest(rows: pd.DataFrame, n: int) -> pd.DataFrame:
    """The ``n`` smallest distinct rows of each group; columns are group, order..., item."""
    keys = [_rank_ready(rows[c]) for c in rows.columns]
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    fresh = np.ones(len(order), bool)
    if len(order) > 1:
        fresh[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    order, group = order[fresh], keys[0][fresh]
    starts = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
    at = np.arange(len(group))
    within = at - np.maximum.accumulate(np.where(starts, at, 0))
    return rows.iloc[order[within < n]]


def _heaps(n: int, held_rows: int):
    """Keeps the ``n`` smallest of each group seen so far, a batch at a time, in bounded memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heap, waiting, count = None, [], 0
        for batch in batches:
            waiting.append(batch)
            count += len(batch)
            if count < max(50_000, len(heap) if heap is not None else 0):
                continue
            heap, waiting, count = _smallest(pd.concat([*([heap] if heap is not None else []), *waiting], ignore_index=True), n), [], 0
            if len(heap) > held_rows:
                yield heap
                heap = None
        rest = [*([heap] if heap is not None else []), *waiting]
        if rest:
            yield _smallest(pd.concat(rest, ignore_index=True), n)

    return run


def top_n(df: DataFrame, group: str, order: list[str], item: str, n: int, held_rows: int = HELD_ROWS) -> DataFrame:
    """``group, *order, item, place``: of each group the ``n`` items with the smallest ``order`` columns.

    Ties go by the further ``order`` columns and at last by ``item``, which must
    be a unique identifier: rows equal in all these columns count once. Rows with
    a null or NaN in one of them take no part. Other columns are ignored; a table
    without rows gives none.

    Each task folds its rows into one bounded heap per group before anything
    is shuffled, so a group of millions of items sends at most a few rows
    per task; the heaps of a group are merged after the shuffle the same way (smallest ``n`` distinct).
    """
    columns = [group, *order, item]
    used = df.select(*columns)
    for name, kind in used.dtypes:
        used = used.filter(F.col(name).isNotNull())
        if kind in ("double", "float"):
            used = used.filter(~F.isnan(name))
    kept = used.mapInPandas(_heaps(n, held_rows), used.schema)
    w = W.partitionBy(group).orderBy(*order, item)
    best = kept.withColumn("place", F.dense_rank().over(w)).filter(F.col("place") <= n)
    return best.groupBy(*columns).agg(F.min("place").alias("place"))


def valid_hits(hits: DataFrame) -> DataFrame:
    """Hits with a place on a contig and a p-value from 0 to 1."""
    return hits.filter("contig_idx >= 0 and pos >= 0 and pval >= 0 and pval <= 1 and not isnan(pval)")


def top_hits(hits: DataFrame, n: int = 5) -> DataFrame:
    """``contig_idx, pval, pos, hit_id, place`` of the ``n`` hits with the smallest p-value on each contig.

    Equal ones go by ``pos``, then ``hit_id``. Redelivered hits count once.
    """
    return top_n(valid_hits(hits), "contig_idx", ["pval", "pos"], "hit_id", n)
