"""Interaction of pairs of features, scanned in blocks."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.functions.kmers import canonical, is_kmer
from bitloom.functions.special import chi2_sf1, r2_cut
from bitloom.operators.features import Design, subset_bits
from bitloom.operators.scan1d import _EPS, bit_matrix, projected
from bitloom.plans.ranks import numbered
from bitloom.plans.runtime import checkpointed

#: Rows of a block, two of which are one task, and of the parts of it that are multiplied at once.
BLOCK_ROWS, PART_ROWS = 32_768, 2048


def pattern_classes(features: DataFrame, d: Design) -> DataFrame:
    """``idx, rep``: features (``idx, bit``) by the smallest of those that look the same over the design's samples."""
    bits = features.select("idx", subset_bits(F.col("bit"), d.pieces()).alias("bits"))
    reps = bits.groupBy("bits").agg(F.min("idx").alias("rep"))
    return bits.join(reps, "bits").select("idx", "rep")


def blocks_of(features: DataFrame, rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """``features`` dealt by hash into blocks of about ``rows`` rows at most, and the number of blocks.

    Blocks are large, as each is copied to a task with each other; but there are enough of them for all cores to have pairs of blocks.
    """
    kept = checkpointed(features)
    n = kept.count()
    busy = math.isqrt(6 * kept.sparkSession.sparkContext.defaultParallelism) + 1
    many = max(1, -(-n // rows), min(-(-n // PART_ROWS), busy))
    return kept.withColumn("block", F.pmod(F.xxhash64("idx"), F.lit(many)).cast("int")), many


def pair_block(a: np.ndarray, b: np.ndarray, y: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, ...]:
    """``effect, r2, t`` of all products of a row of ``a`` with one of ``b``: a matrix product for 1, y and each covariate.

    Pairs of which a feature or the product is constant after projection have r² 0.
    """
    n = len(y)
    uy = basis.T @ y
    yy = float(y @ y - uy @ uy)

    def varies(x: np.ndarray) -> np.ndarray:
        return x.sum(1) - ((x @ basis) ** 2).sum(1) > _EPS

    both = a @ b.T
    xy, xx = (a * y) @ b.T, both.copy()
    for k in range(basis.shape[1]):
        dots = (a * basis[:, k]) @ b.T
        xy -= dots * uy[k]
        xx -= dots * dots
    ok = (both > _EPS) & varies(a)[:, None] & varies(b)[None, :]
    effect, _, r2, t = projected(xy, np.where(ok, xx, 0.0), yy, n)
    return effect, r2, t


def _over_blocks(features: DataFrame, d: Design, measure: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, dict[str, np.ndarray]]], columns: list[str], block_rows: int) -> DataFrame:
    """``idx_a, idx_b`` and what ``measure`` gives of the pairs (``idx_a`` < ``idx_b``) it picks out of two matrices of features (``idx, bit``).

    Features are dealt into blocks; each pair of blocks is one task, which goes through parts of both.
    """
    bits = features.filter("idx is not null and bit is not null").select("idx", subset_bits(F.col("bit"), d.pieces()).alias("bit")).filter(F.length("bit") == d.n)
    dealt, many = blocks_of(bits, block_rows)
    everything = F.sequence(F.lit(0), F.lit(many - 1))
    low = dealt.withColumn("other", F.explode(F.filter(everything, lambda o: o >= F.col("block")))).select(F.col("block").alias("ba"), F.col("other").alias("bb"), "idx", "bit")
    high = dealt.withColumn("other", F.explode(F.filter(everything, lambda o: o <= F.col("block")))).select(F.col("other").alias("ba"), F.col("block").alias("bb"), F.col("idx").alias("jdx"), F.col("bit").alias("jbit"))
    every = np.arange(d.n)

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {c: [] for c in ("idx_a", "idx_b", *columns)}
        for i in range(0, len(left), PART_ROWS):
            some = left.iloc[i : i + PART_ROWS]
            a, ia = bit_matrix(pa.array(some["bit"]), every), some["idx"].to_numpy()
            for j in range(0, len(right), PART_ROWS):
                others = right.iloc[j : j + PART_ROWS]
                b, ib = bit_matrix(pa.array(others["jbit"]), every), others["jdx"].to_numpy()
                hit, values = measure(a, b)
                # within a block both orders come up; across blocks each pair comes up once
                hit &= ia[:, None] < ib[None, :] if key[0] == key[1] else ia[:, None] != ib[None, :]
                x, y = np.nonzero(hit)
                found["idx_a"].append(np.minimum(ia[x], ib[y]))
                found["idx_b"].append(np.maximum(ia[x], ib[y]))
                for c in columns:
                    found[c].append(values[c][x, y])
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0) for c, v in found.items()})

    kinds = ", ".join(f"{c} double" for c in columns)
    return low.groupBy("ba", "bb").cogroup(high.groupBy("ba", "bb")).applyInPandas(run, f"idx_a bigint, idx_b bigint, {kinds}")


def scan_pairs(features: DataFrame, d: Design, log10_p: float = 18.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``idx_a, idx_b, effect, r2, t, p`` of pairs of features (``idx, bit``; ``idx_a`` < ``idx_b``) at or under a p-value.

    Every pair is tested once. Features are dealt into blocks of bounded size,
    and each pair of blocks is one task of matrix products that gives back its
    significant pairs only. ``idx`` is unique; features with null bits are left out, and
    a product that no sample has, or that the covariates explain, is no hit.
    """
    least, shared = r2_cut(log10_p, d.n), features.sparkSession.sparkContext.broadcast((d.y, d.basis))

    def significant(a: np.ndarray, b: np.ndarray):
        effect, r2, t = pair_block(a, b, *shared.value)
        return (r2 >= least) & (r2 > 0), {"effect": effect, "r2": r2, "t": t}

    return _over_blocks(features, d, significant, ["effect", "r2", "t"], block_rows).withColumn("p", chi2_sf1(F.col("t")))


def scan_class_pairs(features: DataFrame, d: Design, log10_p: float = 18.0, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The pairs of :func:`scan_pairs` told once per pair of classes, and the classes (:func:`pattern_classes`).

    Features that look the same over the design's samples give the same results with every other, so
    only one of each class is scanned. The first table is ``rep_a, rep_b, effect, r2, t, p`` with ``rep_a`` <= ``rep_b``;
    it stands for all pairs of different features out of both classes. Members of one class pair among themselves too: that is a row with ``rep_a`` = ``rep_b``.
    """
    classes = checkpointed(pattern_classes(features.filter("idx is not null and bit is not null"), d))
    sizes = classes.groupBy("rep").agg(F.count("*").alias("_members"))
    reps = checkpointed(features.join(sizes, F.col("idx") == F.col("rep"), "left_semi"))
    apart = scan_pairs(reps, d, log10_p, block_rows).withColumnsRenamed({"idx_a": "rep_a", "idx_b": "rep_b"})
    # the product of a feature with one that looks the same is that feature
    least, shared = r2_cut(log10_p, d.n), features.sparkSession.sparkContext.broadcast((d.y, d.basis))
    every = np.arange(d.n)

    def own(batches):
        for batch in batches:
            x = bit_matrix(batch.column(1), every)
            y, basis = shared.value
            uy = basis.T @ y
            dots = x @ basis
            effect, _, r2, t = projected(x @ y - dots @ uy, x.sum(1) - (dots**2).sum(1), float(y @ y - uy @ uy), len(y))
            at = np.flatnonzero((r2 >= least) & (r2 > 0))
            idx = batch.column(0).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([idx, idx, *(pa.array(v[at]) for v in (effect, r2, t))], ["rep_a", "rep_b", "effect", "r2", "t"])

    several = features.join(sizes.filter("_members > 1"), F.col("idx") == F.col("rep"), "left_semi")
    bits = several.select(F.col("idx").cast("bigint").alias("idx"), subset_bits(F.col("bit"), d.pieces()).alias("bit")).filter(F.length("bit") == d.n)
    within = bits.mapInArrow(own, "rep_a bigint, rep_b bigint, effect double, r2 double, t double").withColumn("p", chi2_sf1(F.col("t")))
    return apart.unionByName(within), classes


def co_occurrence(features: DataFrame, d: Design, least: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``idx_a, idx_b, both``: pairs of features (``idx, bit``) that at least ``least`` (1 or more) of the design's samples have together.

    Counts come from matrix products of blocks, as in :func:`scan_pairs`; hand in one feature per class (:func:`pattern_classes`) where many look the same.
    """
    if least < 1:
        raise ValueError("pairs share one sample at least")

    def together(a: np.ndarray, b: np.ndarray):
        both = a @ b.T
        return both >= least, {"both": both}

    return _over_blocks(features, d, together, ["both"], block_rows).withColumn("both", F.col("both").cast("bigint"))


def renumbered(candidates: DataFrame, k: int) -> DataFrame:
    """``idx, kmer, bit``: candidates in order of their canonical k-mer, numbered from 0 (the dictionary of a pair scan).

    Numbers come from one distributed sort (:func:`bitloom.plans.ranks.numbered`).
    """
    keyed = candidates.filter(is_kmer(F.col("kmer"), k)).select(canonical(F.col("kmer")).alias("kmer"), "bit")
    return numbered(keyed.groupBy("kmer").agg(F.min("bit").alias("bit")), ["kmer"], "idx").select("idx", "kmer", "bit")
