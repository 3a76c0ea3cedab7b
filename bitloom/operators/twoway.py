"""Interaction of two populations over a complete grid: host features by pathogen features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.functions.special import chi2_sf1, chi2_sf3, statistic_cut, statistic_cut3
from bitloom.operators.scan1d import bit_matrix
from bitloom.operators.structure import centred, orthonormal
from bitloom.plans.runtime import checkpointed

_TOL = 1e-9
BLOCK_ROWS = 2048


@dataclass(frozen=True)
class Grid:
    """Observations ``y[host, pathogen]`` and orthonormal, centred component directions of either side."""

    y: np.ndarray
    host: np.ndarray
    pathogen: np.ndarray

    def rss0(self) -> float:
        """What the components leave of the sum of squares. y isn't centred and the model has no intercept."""
        nh, np_ = self.y.shape
        parts = [self.host.T @ self.y.sum(1) / np.sqrt(np_), self.pathogen.T @ self.y.sum(0) / np.sqrt(nh), self.host.T @ self.y @ self.pathogen]
        return float((self.y**2).sum() - sum((p**2).sum() for p in parts))


def grid(observations: DataFrame, hosts: int, pathogens: int, host: np.ndarray | None = None, pathogen: np.ndarray | None = None, center_y: bool = False) -> Grid:
    """The grid of ``h, p, y``; collects one number per cell. Every cell must come exactly once."""
    y = np.full((hosts, pathogens), np.nan)
    cells = observations.select("h", "p", F.col("y").cast("double").alias("y")).toArrow()  # hosts x pathogens
    h, p, v = (cells.column(c).to_numpy() for c in ("h", "p", "y"))
    if len(v) != hosts * pathogens or np.isnan(h).any() or np.isnan(p).any():
        raise ValueError("the grid of observations isn't complete")
    y[h, p] = v
    if np.isnan(y).any():
        raise ValueError("the grid of observations isn't complete")
    none = lambda n: np.zeros((n, 0))
    return Grid(y - y.mean() if center_y else y, none(hosts) if host is None else host, none(pathogens) if pathogen is None else pathogen)


def components(gram: np.ndarray, rank: int, features: int) -> np.ndarray:
    """Orthonormal directions of the leading components of a centred side; the rank is bounded by its dimensions and by what has weight."""
    values, vectors = np.linalg.eigh(centred(gram))
    order = np.argsort(values)[::-1][: min(rank, len(gram), features)]
    return orthonormal(vectors[:, order[values[order] > _TOL * max(values.max(initial=0), 1e-300)]])


def _side(x: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    g = x - x.mean(1, keepdims=True)
    t = g @ u
    return g, t, (g * g).sum(1)


def likelihood_ratios(hosts: np.ndarray, pathogens: np.ndarray, d: Grid, interaction_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ratio, delta, lrt`` of every host row by every pathogen row.

    With a complete grid the model's columns are orthogonal, so that the gain
    in the sum of squares has a closed form; only the interaction needs a product per pair.
    Interaction only: a constant feature gives an infinite ratio. Joint: it gives NaN.
    """
    nh, np_ = d.y.shape
    n, rss0 = nh * np_, d.rss0()
    gh, th, hh = _side(hosts, d.host)
    gp, tp, pp = _side(pathogens, d.pathogen)
    norm_i = np.outer(hh, pp)
    q_i = norm_i - np.outer((th**2).sum(1), (tp**2).sum(1))
    s_i = gh @ d.y @ gp.T - th @ (d.host.T @ d.y @ d.pathogen) @ tp.T
    bad = q_i <= _TOL * np.maximum(norm_i, 1e-300)
    with np.errstate(divide="ignore", invalid="ignore"):
        delta = s_i**2 / q_i
        if interaction_only:
            full = bad | (delta >= rss0)
            delta = np.where(full, rss0, delta)
            ratio = np.where(full, np.inf, rss0 / (rss0 - delta))
        else:
            q_h, q_p = np_ * (hh - (th**2).sum(1)), nh * (pp - (tp**2).sum(1))
            s_h = gh @ d.y.sum(1) - th @ (d.host.T @ d.y.sum(1))
            s_p = gp @ d.y.sum(0) - tp @ (d.pathogen.T @ d.y.sum(0))
            bad |= (q_h <= _TOL * np.maximum(np_ * hh, 1e-300))[:, None] | (q_p <= _TOL * np.maximum(nh * pp, 1e-300))[None, :]
            delta = delta + (s_h**2 / q_h)[:, None] + (s_p**2 / q_p)[None, :]
            ratio = np.where(delta >= rss0, np.inf, rss0 / (rss0 - delta))
            delta, ratio = np.where(bad, np.nan, delta), np.where(bad, np.nan, ratio)
        return ratio, delta, n * np.log(ratio)


def scan_twoway(
    hosts: DataFrame, pathogens: DataFrame, d: Grid, interaction_only: bool = False, drop_monomorphic: bool = False, log10_p: float = 0.0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``a, b, ratio, delta, lrt, p`` of host features (``label, bit``) by pathogen features.

    Both sides are dealt into blocks of bounded size and a pair of blocks is one
    task. With ``log10_p`` only pairs at or under that p-value leave the task; without, all do, undefined ones too.
    Hand in one feature per bit pattern (:func:`classes`) and join the members (:func:`members`) afterwards, where
    many features look the same. Labels are unique; rows with null or wrongly long bits are left out;
    p is 0 for an infinite and NaN for an undefined ratio.
    """
    sides = []
    for df, n in ((hosts, d.y.shape[0]), (pathogens, d.y.shape[1])):
        ok = df.filter((F.length("bit") == n) & (F.translate("bit", "01", "") == "")).select("label", "bit")
        if drop_monomorphic:
            ok = ok.filter(F.col("bit").contains("0") & F.col("bit").contains("1"))
        kept = checkpointed(ok)
        many = max(1, -(-kept.count() // block_rows))
        sides.append((kept.withColumn("own", F.pmod(F.xxhash64("label"), F.lit(many)).cast("int")), many))
    (h, nh), (p, np_) = sides
    left = h.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(np_ - 1)))).select(F.col("own").alias("ba"), F.col("other").alias("bb"), "label", "bit")
    right = p.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(nh - 1)))).select(F.col("other").alias("ba"), F.col("own").alias("bb"), "label", "bit")
    shared = hosts.sparkSession.sparkContext.broadcast(d)  # as large as the grid
    least = (statistic_cut(log10_p) if interaction_only else statistic_cut3(log10_p)) if log10_p > 0 else None

    none = pd.DataFrame({c: pd.Series([], dtype=object if c in "ab" else float) for c in ("a", "b", "ratio", "delta", "lrt")})

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return none
        g = shared.value
        x, z = bit_matrix(pa.array(a["bit"]), np.arange(g.y.shape[0])), bit_matrix(pa.array(b["bit"]), np.arange(g.y.shape[1]))
        ratio, delta, lrt = likelihood_ratios(x, z, g, interaction_only)
        i, j = np.nonzero(np.ones(lrt.shape, bool) if least is None else lrt >= least)
        return pd.DataFrame({"a": a["label"].to_numpy()[i], "b": b["label"].to_numpy()[j], "ratio": ratio[i, j], "delta": delta[i, j], "lrt": lrt[i, j]})

    kinds = [dict(x.dtypes)["label"] for x in (hosts, pathogens)]
    out = left.groupBy("ba", "bb").cogroup(right.groupBy("ba", "bb")).applyInPandas(run, f"a {kinds[0]}, b {kinds[1]}, ratio double, delta double, lrt double")
    out = out.select("a", "b", *(F.coalesce(c, F.lit(float("nan"))).alias(c) for c in ("ratio", "delta", "lrt")))  # pandas hands on NaN as null
    tail = chi2_sf1(F.col("lrt")) if interaction_only else chi2_sf3(F.col("lrt"))
    return out.withColumn("p", F.when(F.isnan("lrt"), F.col("lrt")).when(F.col("lrt") == float("inf"), F.lit(0.0)).otherwise(tail))


def classes(features: DataFrame) -> DataFrame:
    """``label, bit, members``: one feature per bit pattern, the smallest label, and how many look so."""
    return features.groupBy("bit").agg(F.min("label").alias("label"), F.count("*").alias("members"))


def members(features: DataFrame) -> DataFrame:
    """``label, rep``: every feature with the label that stands for its bit pattern in :func:`classes`."""
    reps = features.groupBy("bit").agg(F.min("label").alias("rep"))
    return features.select("label", "bit").join(reps, "bit").select("label", "rep")
