"""The sample axis, phenotypes and the binary feature matrix."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitloom.functions.kmers import is_kmer
from bitloom.plans.ranks import numbered
from bitloom.plans.runtime import at_most, checkpointed, lookup_join

#: Keys delivered more than once up to which they are broadcast (8 bytes each).
_REPEATED = 2_000_000

#: Parts by which the draws of a sample are counted before any row is moved.
_DRAW_PARTS = 1 << 16


def latest(df: DataFrame, keys: list[str], when: str, columns: list[str]) -> DataFrame:
    """Each key once with the ``columns`` of its row of greatest ``when``; of equal ones the greater values stand."""
    last = F.max(F.struct(when, *columns))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, *(F.col("_last")[c].alias(c) for c in columns))


def latest_rows(rows: DataFrame, keys: list[str], when: str, columns: list[str], given: DataFrame | None = None, max_repeated: int = _REPEATED) -> DataFrame:
    """As :func:`latest`, for wide tables of which few keys come more than once.

    Keys are counted first, by their hash and without the other columns. Rows of
    keys that come once are taken as they are; only the rest is shuffled with its columns. Where more than
    ``max_repeated`` keys are repeated (counted), all rows are grouped as in :func:`latest`.
    ``given`` is the table as it was before rows were left out, if that saves a filter: its keys include those of ``rows``.
    Null keys are keys like any other.
    """
    key = F.xxhash64(*keys).alias("_key")
    seen = (rows if given is None else given).select(key).groupBy("_key").agg(F.count("*").alias("_c"))
    repeated = checkpointed(seen.filter("_c > 1").select("_key"))
    if not at_most(repeated, max_repeated):
        return latest(rows, keys, when, columns)
    marked = rows.select(*dict.fromkeys([*keys, when, *columns]), key)
    once = marked.join(F.broadcast(repeated), "_key", "left_anti").select(*keys, *columns)
    return once.unionByName(latest(marked.join(F.broadcast(repeated), "_key", "left_semi"), keys, when, columns))


def phenotype_values(phenotype: DataFrame) -> DataFrame:
    """``sample_id, y``: the last valid line of each sample; null and NaN values and null ids are left out."""
    valid = phenotype.filter("sample_id is not null and y is not null and not isnan(y)")
    return valid.groupBy("sample_id").agg(F.max_by("y", "line_no").alias("y"))


def overlap(samples: DataFrame, phenotype: DataFrame) -> DataFrame:
    """``j, ord, sample_id, y``: samples with a phenotype, numbered in the order of the sample axis.

    Both tables are as long as the sample axis, not as the data.
    """
    both = samples.select("ord", "sample_id").join(phenotype_values(phenotype), "sample_id")
    return both.select((F.row_number().over(W.orderBy("ord")) - 1).alias("j"), "ord", "sample_id", "y")


@dataclass(frozen=True)
class Design:
    """The phenotyped samples of a scan: their bits, phenotype and an orthonormal covariate basis (columns of ``basis``)."""

    ords: np.ndarray
    y: np.ndarray
    basis: np.ndarray
    sample_ids: list[str] = field(default_factory=list)

    @property
    def n(self) -> int:
        return len(self.y)

    def pieces(self) -> list[tuple[int, int]]:
        """The runs of neighbouring bits the design uses: (first, length)."""
        cuts = np.flatnonzero(np.diff(self.ords) != 1) + 1
        return [(int(run[0]), len(run)) for run in np.split(self.ords, cuts) if len(run)]


def design(samples: DataFrame, phenotype: DataFrame, basis: dict[str, list[float]] | None = None, groups: dict[str, int] | None = None) -> Design:
    """The design of a scan. Collects one row per sample of the axis.

    ``basis`` gives orthonormal covariates by sample id; ``groups`` instead a group by
    sample id, whose scaled indicators become the basis; without either, the intercept.
    """
    rows = overlap(samples, phenotype).orderBy("j").collect()
    ids = [r.sample_id for r in rows]
    n = len(rows)
    if basis is not None:
        u = np.array([basis[i] for i in ids], float).reshape(n, -1)
    else:
        of = np.array([groups[i] if groups else 0 for i in ids])
        u = np.stack([(of == g) / np.sqrt((of == g).sum()) for g in np.unique(of)], 1) if n else np.zeros((0, 1))
    return Design(np.array([r.ord for r in rows], int), np.array([r.y for r in rows], float), u, ids)


def valid_rows(rows: DataFrame, k: int, bits: int) -> DataFrame:
    """Rows whose k-mer has ``k`` bases and whose bit string ``bits`` characters 0 and 1; others are skipped."""
    ok = is_kmer(F.col("kmer"), k) & (F.length("bit") == bits) & (F.translate("bit", "01", "") == "")
    return rows.filter(ok)


def strict_rows(rows: DataFrame, k: int, bits: int) -> DataFrame:
    """As :func:`valid_rows`, but a bit string of wrong length or content fails the job; k-mers of wrong length are skipped."""
    wrong = F.coalesce((F.length("bit") != bits) | (F.translate("bit", "01", "") != ""), F.lit(True))
    checked = F.when(wrong, F.raise_error(F.lit("bit string of wrong length or content"))).otherwise(F.col("bit"))
    return rows.filter(is_kmer(F.col("kmer"), k)).withColumn("bit", checked)


def unique_rows(rows: DataFrame, k: int, bits: int) -> DataFrame:
    """``row_id, shard, kmer, bit`` of valid rows, redelivered ones once (the latest), k-mers in upper case; bit strings of rows delivered once are not shuffled."""
    last = latest_rows(valid_rows(rows, k, bits), ["row_id"], "loaded_at", ["shard", "kmer", "bit"], rows)
    return last.withColumn("kmer", F.upper("kmer"))


def subset_bits(bit: Column, pieces: list[tuple[int, int]]) -> Column:
    """The characters of a bit string at the design's samples, in order; nothing but 0 and 1 (others become 0)."""
    parts = [F.substring(bit, first + 1, size) for first, size in pieces]
    return F.regexp_replace(F.concat(*parts) if parts else F.lit(""), "[^01]", "0")


def ones(bits: Column) -> Column:
    return F.length(F.translate(bits, "0", ""))


def allele_frequencies(rows: DataFrame, d: Design) -> DataFrame:
    """``row_id, ones, freq`` over phenotyped samples."""
    bits = rows.select("row_id", subset_bits(F.col("bit"), d.pieces()).alias("bits"))
    return bits.select("row_id", ones(F.col("bits")).alias("ones"), F.try_divide(ones(F.col("bits")), F.lit(float(d.n))).alias("freq"))


def maf_filter(rows: DataFrame, d: Design, percent: float = 5) -> DataFrame:
    """Rows whose minor allele frequency over phenotyped samples is at least ``percent`` per cent; one pass, no shuffle."""
    f = F.try_divide(ones(subset_bits(F.col("bit"), d.pieces())), F.lit(float(d.n)))
    return rows.withColumn("maf", F.least(f, 1 - f)).filter(F.col("maf") >= percent / 100)


def presence(rows: DataFrame) -> DataFrame:
    """``row_id, ord`` of every 1: the matrix in long form."""
    at = F.posexplode(F.split("bit", "")).alias("ord", "b")
    return rows.select("row_id", at).filter("b = '1'").select("row_id", "ord")


def bit_strings(present: DataFrame, samples: int, ids: DataFrame | None = None) -> DataFrame:
    """``row_id, bit`` out of the long form; rows of ``ids`` (``row_id``) that no sample has come out as zeros.

    Bits are gathered into words of 60, so that a row takes a few numbers while it is grouped. Places beyond ``samples`` are left out.
    """
    marks = present.select("row_id", "ord").filter((F.col("ord") >= 0) & (F.col("ord") < samples))
    if ids is not None:
        marks = marks.unionByName(ids.select("row_id", F.lit(None).cast("int").alias("ord")))
    words = [(low, min(60, samples - low)) for low in range(0, samples, 60)]
    here = lambda low, size: F.when((F.col("ord") >= low) & (F.col("ord") < low + size), F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("ord") - low).cast("int")))
    have = marks.groupBy("row_id").agg(*(F.bit_or(here(low, size)).alias(f"w{i}") for i, (low, size) in enumerate(words)))
    text = [F.reverse(F.lpad(F.bin(F.coalesce(f"w{i}", F.lit(0).cast("bigint"))), size, "0")) for i, (low, size) in enumerate(words)]
    return have.select("row_id", (F.concat(*text) if text else F.lit("")).alias("bit"))


def shard_samples(rows: DataFrame, total: int, seed: int = 42) -> DataFrame:
    """Of each shard its quota, the total shared evenly and rounded up: the rows with the smallest keyed hash.

    Every row of a shard is equally likely; equal rows draw as one.
    """
    shards = rows.select("shard").distinct()
    quota = shards.agg(F.ceil(F.lit(total) / F.greatest(F.count("*"), F.lit(1))).alias("quota"))
    return quota_sample(rows, int(quota.first()[0]), seed)


def sample_statistics(rows: DataFrame, total: int) -> DataFrame:
    """``shard, seen, kept`` of :func:`shard_samples`; sum them for the whole job."""
    seen = rows.groupBy("shard").agg(F.count("*").alias("seen"))
    quota = seen.agg(F.ceil(F.lit(total) / F.greatest(F.count("*"), F.lit(1))).alias("quota"))  # one row
    return seen.join(F.broadcast(quota)).select("shard", "seen", F.least("seen", "quota").alias("kept"))


def _draw(seed: int, columns: list[str]) -> Column:
    key = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *key))


def smallest_draws(rows: DataFrame, group: str | None, quota: int, seed: int = 42, columns: list[str] | None = None, parts: int = _DRAW_PARTS) -> DataFrame:
    """The ``quota`` rows of each group (of all, without one) with the smallest keyed hash of their ``columns``, then the smallest first column.

    The hash falls into ``parts`` equal parts. Rows are counted by group and part first; whole
    parts below the one in which the quota ends are kept where they are, and only the
    rows of that part (one in ``parts``) are ranked. So neither a group of most rows nor a quota of
    millions is ever sorted by one task. Rows of a null group are a group of their own.
    """
    columns = columns or ["row_id", "kmer", "bit"]
    part = F.conv(F.substring("_draw", 1, 8), 16, 10).cast("bigint") % 4294967296
    drawn = rows.withColumn("_draw", _draw(seed, columns)).withColumn("_part", F.floor(part * F.lit(parts) / F.lit(4294967296)).cast("int"))
    drawn = drawn.withColumn("_group", F.xxhash64(group) if group else F.lit(0).cast("bigint"))
    counts = drawn.groupBy("_group", "_part").agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(W.partitionBy("_group").orderBy("_part"))
    ends = counts.withColumn("_upto", upto).groupBy("_group").agg(
        F.min(F.when(F.col("_upto") >= quota, F.col("_part"))).alias("_last"), F.coalesce(F.max(F.when(F.col("_upto") < quota, F.col("_upto"))), F.lit(0)).alias("_before")
    )
    met = lookup_join(drawn, checkpointed(ends), ["_group"])
    whole = met.filter("_last is null or _part < _last")
    place = F.row_number().over(W.partitionBy("_group").orderBy("_draw", columns[0]))
    rest = met.filter("_part = _last").withColumn("_place", place).filter(F.col("_before") + F.col("_place") <= quota).drop("_place")
    return whole.unionByName(rest).select(*rows.columns)


def quota_sample(rows: DataFrame, quota: int, seed: int = 42) -> DataFrame:
    """The ``quota`` rows of each shard with the smallest keyed hash (:func:`smallest_draws`)."""
    return smallest_draws(rows, "shard", quota, seed)


def subsample(rows: DataFrame, limit: int, seed: int = 42, columns: list[str] | None = None) -> DataFrame:
    """A random subset of ``limit`` rows, or all if there are no more, drawn by the text of ``columns`` (:func:`smallest_draws`)."""
    return smallest_draws(rows, None, limit, seed, columns)


def batched(rows: DataFrame, batch_size: int = 10) -> DataFrame:
    """``rows`` with ``batch``: shards in order of their name, ``batch_size`` to a batch."""
    shards = rows.select("shard").filter("shard is not null").distinct()
    # one narrow row per shard; the number of files, not of rows
    numbered = shards.select("shard", F.floor((F.row_number().over(W.orderBy("shard")) - 1) / batch_size).cast("int").alias("batch"))
    return lookup_join(rows, numbered, ["shard"])


def sorted_places(rows: DataFrame, batch_size: int = 10) -> DataFrame:
    """``rows`` with ``batch`` and ``place``, their place in the order of (batch, bit, kmer); one range-partitioned sort, so that a giant batch is many tasks."""
    return numbered(batched(rows, batch_size), ["batch", "bit", "kmer", "row_id"], "place")
