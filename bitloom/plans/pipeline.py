"""The whole analyses: single features with their pairs, and two populations.

Every stage is a table below the results folder, with a fingerprint of the parameters it and
the stages before it were made with. A stage whose fingerprint is there is read, not made
again; changed parameters make it and all that follows anew.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import cache

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom.operators import features, mapping, pairs2d, report, scan1d, structure, twoway


@dataclass(frozen=True)
class Settings:
    """Parameters of the single-feature and pair analysis.

    ``reservoir`` and ``seed`` hold for the table ``sample``, which no other stage reads; ``subsample`` is without effect,
    as bases come from all features.
    """

    k: int = 51
    rank: int = 3
    zscore: bool = True
    log10_p: float = 6.0
    log10_p_2d_input: float = 15.0
    log10_p_2d: float = 18.0
    min_corr: float = 0.2
    reservoir: int = 10_000_000
    subsample: int = 200_000
    maf_percent: float = 5.0
    seed: int = 42
    window: int = 100
    density: float = 0.95
    map_log10_p: float = 0.0
    alpha: float = 0.05
    pairs: bool = True


@dataclass(frozen=True)
class TwoWaySettings:
    """Parameters of the two-population analysis."""

    host_rank: int = 3
    pathogen_rank: int = 3
    interaction_only: bool = False
    center_y: bool = False
    drop_monomorphic: bool = False
    log10_p: float = 0.0


def version_of(df: DataFrame) -> str:
    """What tells a table read from files apart from later ones: its files with sizes and times, and what was done to them.

    A table that isn't read from files has no such version; that is an error.
    """
    spark, files = df.sparkSession, sorted(df.inputFiles())
    if not files:
        raise ValueError("name the version of inputs that are not read from files")
    stats = []
    for name in files:
        where = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where)
        stats.append([name, status.getLen(), status.getModificationTime()])
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().analyzed().toString())
    return hashlib.sha256(json.dumps([stats, plan]).encode()).hexdigest()


@dataclass
class Stages:
    """Tables below ``root``, made on demand."""

    spark: SparkSession
    root: str
    dry_run: bool = False
    log: list[tuple[str, str]] = field(default_factory=list)
    prints: dict[str, str] = field(default_factory=dict)

    def _kept(self, name: str) -> str | None:
        try:
            return self.spark.read.schema("print string").parquet(f"{self.root}/_prints/{name}").first()[0]
        except (AnalysisException, TypeError):
            return None

    def table(self, name: str, params: dict, after: list[str], build: Callable[[], DataFrame]) -> DataFrame | None:
        """The table ``name``; ``after`` names the stages it is made from. None in a dry run where it would be made."""
        text = json.dumps([name, params, [self.prints[a] for a in after]], sort_keys=True, default=str)
        self.prints[name] = now = hashlib.sha256(text.encode()).hexdigest()
        path = f"{self.root}/{name}"
        if self._kept(name) == now:
            self.log.append((name, "kept"))
            return self.spark.read.parquet(path)
        self.log.append((name, "would run" if self.dry_run else "ran"))
        if self.dry_run:
            return None
        build().write.mode("overwrite").parquet(path)
        self.spark.createDataFrame([(now,)], "print string").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_prints/{name}")
        return self.spark.read.parquet(path)


def _basis(d: features.Design, kept: DataFrame) -> features.Design:
    cells = kept.collect()  # samples by components
    place = {s: j for j, s in enumerate(d.sample_ids)}
    u = np.zeros((d.n, 1 + max((c.component for c in cells), default=0)))
    for c in cells:
        u[place[c.sample_id], c.component] = c.value
    return features.Design(d.ords, d.y, u, d.sample_ids)


def run_association(
    rows: DataFrame, samples: DataFrame, phenotype: DataFrame, contigs: DataFrame, root: str, settings: Settings | None = None, inputs: str | None = None, dry_run: bool = False
) -> tuple[dict[str, DataFrame | None], list[tuple[str, str]]]:
    """All tables of the single-feature and pair analysis, and what was done for each.

    Bases come from all features that pass the frequency filter, in one pass for both.
    ``inputs`` names the version of the inputs; a new one makes everything anew. Without it, the files
    the tables are read from tell their version (:func:`version_of`). Tables: ``sample``,
    ``basis``, ``basis_2d``, ``hits``, ``counts``, ``threshold``, ``index``, ``mapped``, ``points`` and, with pairs,
    ``candidates``, ``dictionary``, ``pairs``, ``mapped_pairs``.
    """
    s = settings or Settings()
    spark = rows.sparkSession
    st = Stages(spark, root, dry_run)
    inputs = inputs or "|".join(map(version_of, (rows, samples, phenotype, contigs)))
    d = features.design(samples, phenotype)
    bits = samples.count()
    valid = features.valid_rows(rows, s.k, bits)
    out: dict[str, DataFrame | None] = {}

    @cache
    def ref() -> DataFrame:
        return mapping.written_reference(contigs)

    @cache
    def bases() -> tuple[np.ndarray, np.ndarray]:
        common = features.maf_filter(features.unique_rows(rows, s.k, bits), d, s.maf_percent)
        return structure.covariate_bases(common, d, s.rank, s.zscore)

    def add(name: str, params: list[str], after: list[str], build: Callable[[], DataFrame]) -> None:
        out[name] = st.table(name, {p: asdict(s)[p] for p in params} | {"inputs": inputs}, after, build)

    add("sample", ["k", "reservoir", "seed"], [], lambda: features.shard_samples(features.unique_rows(rows, s.k, bits), s.reservoir, s.seed))
    add("basis", ["k", "rank", "zscore", "maf_percent"], [], lambda: structure.basis_table(spark, d, bases()[0]))
    adjusted = lambda name: _basis(d, out[name])
    add("hits", ["min_corr", "log10_p"], ["basis"], lambda: scan1d.scan(valid, adjusted("basis"), s.min_corr, s.log10_p))
    add("counts", ["k", "min_corr"], [], lambda: scan1d.tested_counts(valid, d, s.min_corr))
    add("threshold", ["alpha"], ["counts"], lambda: report.bonferroni(out["counts"], s.alpha))
    add("index", ["k"], ["hits"], lambda: mapping.build_index(out["hits"], s.k))
    add("mapped", ["window", "density", "map_log10_p"], ["index"], lambda: mapping.map_merge_filter(ref(), out["index"], s.k, s.window, s.density, 10**-s.map_log10_p))
    add("points", [], ["mapped"], lambda: report.manhattan_points(out["mapped"]))
    if s.pairs:
        add("basis_2d", ["k", "rank", "zscore", "maf_percent"], [], lambda: structure.basis_table(spark, d, bases()[1]))
        add("candidates", ["min_corr", "log10_p", "log10_p_2d_input"], ["basis"], lambda: scan1d.candidates(valid, adjusted("basis"), s.min_corr, s.log10_p, s.log10_p_2d_input))
        add("dictionary", ["k"], ["candidates"], lambda: pairs2d.renumbered(out["candidates"], s.k))
        add("pairs", ["log10_p_2d"], ["dictionary", "basis_2d"], lambda: pairs2d.scan_pairs(out["dictionary"], adjusted("basis_2d"), s.log10_p_2d))
        add("mapped_pairs", ["k"], ["pairs"], lambda: mapping.map_pairs(out["pairs"], mapping.first_positions(ref(), out["dictionary"], s.k)))
    return out, st.log


def run_two_populations(
    hosts: DataFrame, pathogens: DataFrame, observations: DataFrame, root: str, settings: TwoWaySettings | None = None, inputs: str | None = None, dry_run: bool = False
) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """The two-population table ``twoway`` (``a, b, ratio, delta, lrt, p``) of features ``label, bit`` and a complete grid ``h, p, y``; ``inputs`` as in :func:`run_association`."""
    inputs = inputs or "|".join(map(version_of, (hosts, pathogens, observations)))
    s = settings or TwoWaySettings()
    st = Stages(hosts.sparkSession, root, dry_run)

    def build() -> DataFrame:
        nh, np_ = (int(x) for x in observations.agg(F.max("h") + 1, F.max("p") + 1).first())
        sides = []
        for df, n, rank in ((hosts, nh, s.host_rank), (pathogens, np_, s.pathogen_rank)):
            ok = df.filter(F.length("bit") == n)
            sides.append(twoway.components(structure.gram_matrix(ok, np.arange(n)), rank, ok.count()))
        grid = twoway.grid(observations, nh, np_, *sides, center_y=s.center_y)
        return twoway.scan_twoway(hosts, pathogens, grid, s.interaction_only, s.drop_monomorphic, s.log10_p)

    return st.table("twoway", asdict(s) | {"inputs": inputs}, [], build), st.log
