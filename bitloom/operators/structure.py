"""Population structure: Gram matrices of the feature matrix and the covariate bases drawn from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.operators.features import Design
from bitloom.operators.scan1d import _ROWS, bit_matrix


def gram(rows: DataFrame, ords: np.ndarray) -> DataFrame:
    """``j, i, g`` for j <= i: how many rows have both samples, the places of which are ``ords``.

    Each task multiplies its batches and hands on one triangle as long as the sample axis is
    squared, so the shuffle depends on the number of tasks only.
    """
    n = len(ords)
    upper = np.triu_indices(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for whole in batches:
            for low in range(0, whole.num_rows, _ROWS):
                x = bit_matrix(whole.slice(low, _ROWS).column("bit"), ords)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper].astype(np.int64))], ["j", "i", "g"])

    width = int(ords.max()) + 1 if n else 0
    part = rows.filter(F.length("bit") >= width).select("bit").mapInArrow(run, "j int, i int, g bigint")
    return part.groupBy("j", "i").agg(F.sum("g").alias("g"))


def gram_matrix(rows: DataFrame, ords: np.ndarray) -> np.ndarray:
    """The Gram matrix itself: one number per pair of samples, whatever the number of rows."""
    g = np.zeros((len(ords), len(ords)))
    got = gram(rows, ords).toArrow()  # n (n + 1) / 2 rows
    j, i, n = (got.column(c).to_numpy() for c in ("j", "i", "g"))
    g[j, i] = g[i, j] = n
    return g


def centred(g: np.ndarray) -> np.ndarray:
    """The Gram matrix of features of which each has its mean taken off: H G H."""
    return g - g.mean(0) - g.mean(1)[:, None] + g.mean()


def component_scores(g: np.ndarray, rank: int, zscore: bool = True) -> np.ndarray:
    """Scores of the ``rank`` leading principal components, signs made unique; columns scaled to sd 1 on request."""
    n = len(g)
    if not 1 <= rank <= n:
        raise ValueError("the rank must be from 1 to the number of samples")
    values, vectors = np.linalg.eigh(centred(g))
    scores = vectors[:, ::-1][:, :rank] * np.sqrt(np.clip(values[::-1][:rank], 0, None))
    lead = scores[np.abs(scores).argmax(0), np.arange(rank)]
    scores = scores * np.where(lead < 0, -1.0, 1.0)
    if zscore:
        sd = scores.std(0, ddof=1) if n > 1 else np.ones(rank)
        scores = (scores - scores.mean(0)) / np.where(sd > 0, sd, 1.0)
    return scores


def pair_products(scores: np.ndarray) -> np.ndarray:
    """Products of all pairs of columns, each with itself too."""
    a, b = np.triu_indices(scores.shape[1])
    return scores[:, a] * scores[:, b]


def orthonormal(columns: np.ndarray, tol: float = 1e-10) -> np.ndarray:
    """An orthonormal basis of what the columns span; directions of no weight are dropped."""
    u, s, _ = np.linalg.svd(columns, full_matrices=False)
    return u[:, s > tol * max(s.max(initial=0), 1e-300)]


def covariate_bases(rows: DataFrame, d: Design, rank: int = 3, zscore: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The bases of [1, components] for single features and of [1, components, their products] for pairs.

    ``rows`` are those that passed the frequency filter; the sample axis (not the data) bounds what reaches the driver.
    """
    scores = component_scores(gram_matrix(rows, d.ords), rank, zscore)
    one = np.ones((d.n, 1))
    return orthonormal(np.hstack([one, scores])), orthonormal(np.hstack([one, scores, pair_products(scores)]))


def basis_table(spark, d: Design, basis: np.ndarray) -> DataFrame:
    """``sample_id, component, value`` of a basis."""
    cells = [(s, k, float(basis[j, k])) for j, s in enumerate(d.sample_ids) for k in range(basis.shape[1])]
    return spark.createDataFrame(cells, "sample_id string, component int, value double")
