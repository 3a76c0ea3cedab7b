"""Association of each feature with the phenotype, adjusted for covariates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.functions.special import chi2_sf1, r2_cut, statistic_cut
from bitloom.operators.features import Design, latest

_EPS = 1e-12
_ROWS = 8192  # rows of a batch that are multiplied at once


def bit_matrix(bits: pa.Array, ords: np.ndarray) -> np.ndarray:
    """Bit strings (none null, all long enough) as a matrix of 0 and 1 at the wanted places."""
    if not len(bits):
        return np.zeros((0, len(ords)))
    flat = np.frombuffer("".join(bits.to_pylist()).encode("latin-1", "replace"), np.uint8)
    return (flat.reshape(len(bits), -1)[:, ords] == 49).astype(float)


def projected(xy: np.ndarray, xx: np.ndarray, yy: float, n: int) -> tuple[np.ndarray, ...]:
    """``effect, beta, r2, t`` out of products of vectors the covariates are projected out of; zero where one vanishes."""
    ok = (xx > _EPS) & (yy > _EPS)
    safe = np.where(ok, xx, 1.0)
    r2 = np.where(ok, np.clip(xy * xy / (safe * max(yy, _EPS)), 0, 1 - 1e-15), 0.0)
    t = -n * np.log1p(-r2)
    return np.where(ok, xy / (safe * max(yy, _EPS)), 0.0), np.where(ok, xy / safe, 0.0), r2, t


def tested_rows(rows: DataFrame, d: Design, min_corr: float = 0.2, log10_p: float | None = None, keep: tuple[str, ...] = ("row_id", "shard", "kmer", "loaded_at")) -> DataFrame:
    """``*keep, ones, r, effect, beta, r2, t`` of every row that is tested.

    ``rows`` are valid (:func:`bitloom.operators.features.valid_rows`). A row is tested
    if its correlation with the phenotype is at least ``min_corr`` and neither is constant over the
    design's samples, even at 0. With ``log10_p`` only rows of such a p-value
    are kept, by their r². One pass over the rows: each batch of bit strings becomes one matrix product
    with [1, y, basis].
    """
    n = d.n
    least = 0.0 if log10_p is None else r2_cut(log10_p, n)
    yc = d.y - d.y.mean() if n else d.y
    syy, uy = float(yc @ yc), d.basis.T @ d.y
    yy = float(d.y @ d.y - uy @ uy)
    columns = np.column_stack([d.y, d.basis])
    width = int(d.ords.max()) + 1 if n else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(low, _ROWS)
                x = bit_matrix(batch.column("bit"), d.ords)
                a, dots = x.sum(1), x @ columns
                sxx = a - a * a / max(n, 1)
                varies = (sxx > _EPS) & (syy > _EPS)
                r = np.where(varies, (dots[:, 0] - a * d.y.mean()) / np.sqrt(np.where(varies, sxx * syy, 1.0)), 0.0) if n else np.zeros(len(a))
                effect, beta, r2, t = projected(dots[:, 0] - dots[:, 1:] @ uy, a - (dots[:, 1:] ** 2).sum(1), yy, n)
                at = np.flatnonzero(varies & (np.abs(r) >= min_corr) & (r2 >= least))
                kept = batch.take(pa.array(at))
                values = [a[at].astype(np.int32), r[at], effect[at], beta[at], r2[at], t[at]]
                yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in keep), *map(pa.array, values)], [*keep, "ones", "r", "effect", "beta", "r2", "t"])

    used = rows.filter(F.length("bit") >= width).select(*keep, *(["bit"] if "bit" not in keep else []))
    kinds = ", ".join(f"`{c}` {t}" for c, t in used.select(*keep).dtypes)
    return used.mapInArrow(run, f"{kinds}, ones int, r double, effect double, beta double, r2 double, t double")


def scan(rows: DataFrame, d: Design, min_corr: float = 0.2, log10_p: float = 6.0) -> DataFrame:
    """``row_id, shard, kmer, ones, r, effect, beta, r2, t, p``: the hits of a scan, redelivered rows once.

    The threshold is applied before the shuffle that tells redelivered rows apart,
    so that only hits are moved.
    """
    got = tested_rows(rows, d, min_corr, log10_p)
    once = latest(got, ["row_id"], "loaded_at", ["shard", "kmer", "ones", "r", "effect", "beta", "r2", "t"])
    return once.withColumn("p", chi2_sf1(F.col("t")))


def candidates(rows: DataFrame, d: Design, min_corr: float = 0.2, log10_p: float = 6.0, log10_p_2d: float = 15.0) -> DataFrame:
    """The hits that pass the stricter limit of the pair scan too, with their bit strings."""
    got = tested_rows(rows, d, min_corr, max(log10_p, log10_p_2d), ("row_id", "shard", "kmer", "bit", "loaded_at"))
    once = latest(got, ["row_id"], "loaded_at", ["shard", "kmer", "bit", "effect", "t"])
    return once.withColumn("p", chi2_sf1(F.col("t")))


def tested_counts(rows: DataFrame, d: Design, min_corr: float = 0.2) -> DataFrame:
    """``shard, tested``: how many different rows of each shard are tested.

    Only keys of tested rows are shuffled, and a shard is counted in parts.
    """
    once = tested_rows(rows, d, min_corr, keep=("row_id", "shard")).select("row_id", "shard").distinct()
    return once.groupBy("shard").agg(F.count("*").alias("tested"))


def hits_over(scanned: DataFrame, log10_p: float) -> DataFrame:
    """The hits at or under a p-value, by their statistic."""
    return scanned.filter(F.col("t") >= statistic_cut(log10_p))
