"""Tables behind the plots: thresholds, percentile cuts, grids and chromosome bands."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitloom.operators.features import subsample
from bitloom.plans.runtime import checkpointed

#: The least p-value a plot shows (fixed value).
LEAST_P = 1e-300


def minus_log10(p: Column) -> Column:
    return -F.log10(F.greatest(p, F.lit(LEAST_P)))


def bonferroni(counts: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``tested, threshold``: -log10(alpha / tests); null where nothing was tested."""
    total = counts.agg(F.sum("tested").alias("tested"))
    return total.select("tested", F.when(F.col("tested") > 0, -F.log10(F.lit(alpha) / F.col("tested"))).alias("threshold"))


def manhattan_points(hits: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """``pos, sign, log10p``: a point per hit (``pos, effect, p``) with all values there, both ends of the range included."""
    ok = hits.filter("pos is not null and effect is not null and p is not null and not isnan(p) and not isnan(effect)")
    if first is not None:
        ok = ok.filter(F.col("pos") >= first)
    if last is not None:
        ok = ok.filter(F.col("pos") <= last)
    return ok.select("pos", F.signum("effect").alias("sign"), minus_log10(F.col("p")).alias("log10p"))


def under(hits: DataFrame, max_p: float) -> DataFrame:
    """Hits with a p-value strictly under ``max_p``."""
    return hits.filter(F.col("p") < max_p)


def value_percentile(df: DataFrame, value: Column, percent: float) -> float | None:
    """The exact, interpolated percentile of a column by a distributed sort: one row comes back."""
    values = df.select(value.alias("v")).filter("v is not null and not isnan(v)")
    counted = values.groupBy("v").agg(F.count("*").alias("c")).repartitionByRange("v").sortWithinPartitions("v")
    sizes = checkpointed(counted.withColumn("_id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("_id", 33)))
    parts = sizes.groupBy("part").agg(F.sum("c").alias("n")).orderBy("part").collect()  # a row per partition
    total = sum(r.n for r in parts)
    if not total:
        return None
    at = percent / 100 * (total - 1)
    before, shift = 0, {}
    for r in parts:
        shift[r.part], before = before, before + r.n

    def near(rank: int) -> float:
        part = max((p for p, s in shift.items() if s <= rank), key=lambda p: shift[p])
        # stretches of the partition are counted before one of them is summed up value by value
        stretch = F.shiftright(F.col("_id"), 16)
        run = sizes.filter(F.col("part") == part).withColumn("_stretch", stretch)
        before, chosen = shift[part], None
        for r in run.groupBy("_stretch").agg(F.sum("c").alias("n")).orderBy("_stretch").toArrow().to_pylist():  # one row in 65,536
            if before + r["n"] > rank:
                chosen = r["_stretch"]
                break
            before += r["n"]
        upto = run.filter(F.col("_stretch") == chosen).withColumn("upto", F.sum("c").over(W.partitionBy("_stretch").orderBy("v")))
        return upto.filter(F.col("upto") > rank - before).agg(F.min("v")).first()[0]

    low = near(math.floor(at))
    high = near(math.ceil(at))
    return low + (high - low) * (at - math.floor(at))


def effect_cut(pairs: DataFrame, percent: float) -> DataFrame:
    """Rows whose absolute effect reaches the percentile; 0 keeps all. Null and NaN effects don't stay under a cut."""
    if percent <= 0:
        return pairs
    cut = value_percentile(pairs, F.abs("effect"), percent)
    return pairs.filter((F.abs("effect") >= F.lit(cut)) & ~F.isnan("effect"))


def region(pairs: DataFrame, first: tuple[float, float] | None = None, second: tuple[float, float] | None = None) -> DataFrame:
    """Pairs with ``pos_a`` in the range ``first`` and ``pos_b`` in ``second``, lower ends included and upper ones not."""
    for name, ends in (("pos_a", first), ("pos_b", second)):
        if ends is not None:
            pairs = pairs.filter((F.col(name) >= ends[0]) & (F.col(name) < ends[1]))
    return pairs


def bin_width(first: tuple[float, float], second: tuple[float, float], steps: int = 5_000_000) -> float:
    """The width of cells where none is given: the longer range in so many steps."""
    return max(first[1] - first[0], second[1] - second[0]) / steps


def cells(pairs: DataFrame, width: float, origin: tuple[float, float] = (0, 0)) -> DataFrame:
    """``pairs`` with the grid cell (``cx, cy``) of their two positions, counted from ``origin`` and cut off towards zero."""
    for name, pos, start in (("cx", "pos_a", origin[0]), ("cy", "pos_b", origin[1])):
        pairs = pairs.withColumn(name, ((F.col(pos) - F.lit(start)) / F.lit(width)).cast("bigint"))
    return pairs


def cell_counts(pairs: DataFrame, width: float, origin: tuple[float, float] = (0, 0)) -> DataFrame:
    """``cx, cy, n``."""
    return cells(pairs, width, origin).groupBy("cx", "cy").agg(F.count("*").alias("n"))


def dense_cells(pairs: DataFrame, width: float, percent: float, origin: tuple[float, float] = (0, 0)) -> DataFrame:
    """``cx, cy, n`` of cells whose count reaches the percentile of all counts."""
    counts = checkpointed(cell_counts(pairs, width, origin))
    cut = value_percentile(counts, F.col("n").cast("double"), percent)
    return counts if cut is None else counts.filter(F.col("n") >= cut)


def cell_peaks(pairs: DataFrame, width: float, percent: float = 0, origin: tuple[float, float] = (0, 0)) -> DataFrame:
    """Of each dense cell its most significant pair: ``cx, cy, x, y, log10p, effect``, placed at the cell's centre; of equal ones the greater effect.

    The peak is a maximum kept per task before the shuffle, so that a crowded cell is no large group.
    """
    at = cells(pairs, width, origin)
    if percent > 0:
        at = at.join(dense_cells(pairs, width, percent, origin).select("cx", "cy"), ["cx", "cy"], "left_semi")
    best = F.max(F.struct(minus_log10(F.col("p")).alias("log10p"), "effect", "pos_a", "pos_b"))
    top = at.groupBy("cx", "cy").agg(best.alias("m"))
    centre = lambda c, start: (F.lit(float(start)) + (F.col(c) + 0.5) * width).alias({"cx": "x", "cy": "y"}[c])
    return top.select("cx", "cy", centre("cx", origin[0]), centre("cy", origin[1]), "m.log10p", "m.effect")


def marginal_sample(points: DataFrame, limit: int = 50_000, seed: int = 42, columns: tuple[str, ...] = ("pos", "effect", "p")) -> DataFrame:
    """Points drawn beside a plot: a random subset of ``limit``, all if there are no more; equal points draw as one."""
    return subsample(points, limit, seed, list(columns))


#: The sizes of markers (fixed values).
_SIZES = 2.5, 8.0

#: How a contig's name tells its chromosome (fixed value).
_CHROMOSOME = r"(?i)^(?:chr(?:om(?:osome)?)?)[_\-]?0*(\d+)"


def marker_sizes(points: DataFrame, value: str, low: float = _SIZES[0], high: float = _SIZES[1]) -> DataFrame:
    """``points`` with ``size``: the value scaled onto a range of sizes; the lower end if all are equal."""
    ends = points.agg(F.min(value).alias("_a"), F.max(value).alias("_b"))  # one row
    share = F.coalesce(F.try_divide(F.col(value) - F.col("_a"), F.col("_b") - F.col("_a")), F.lit(0.0))
    return points.join(F.broadcast(ends)).withColumn("size", low + share * (high - low)).drop("_a", "_b")


def chromosome_label(name: Column) -> Column:
    """``Chr`` and its number out of a contig's name, ``Other`` where it has none."""
    number = F.regexp_extract(name, _CHROMOSOME, 1)
    return F.when(number != "", F.concat(F.lit("Chr"), number)).otherwise(F.lit("Other"))


def chromosome_bands(offsets: DataFrame) -> DataFrame:
    """``label, first, last, mid, contigs`` of each chromosome over contigs with ``start, len``."""
    each = offsets.select(chromosome_label(F.col("name")).alias("label"), "start", (F.col("start") + F.col("len")).alias("end"))
    bands = each.groupBy("label").agg(F.min("start").alias("first"), F.max("end").alias("last"), F.count("*").alias("contigs"))
    return bands.withColumn("mid", (F.col("first") + F.col("last")) / 2)


def header_lengths(contigs: DataFrame) -> DataFrame:
    """``contig_idx, name, len`` of contigs whose name tells their length (``length_`` and a number); redelivered ones once, others are left out."""
    told = contigs.select("contig_idx", "name", F.regexp_extract("name", r"length_(\d+)", 1).alias("t")).filter("contig_idx is not null and t <> ''")
    return told.groupBy("contig_idx").agg(F.max(F.struct("name", F.col("t").cast("bigint").alias("len"))).alias("s")).select("contig_idx", "s.name", "s.len")


def locate(points: DataFrame, offsets: DataFrame, block: int = 1_000_000) -> DataFrame:
    """``points`` (genome-wide ``pos``) with ``contig_idx, local``; positions beyond all contigs get null.

    A range lookup without a range join: contigs are listed in each block of positions they touch,
    and within a block each point takes the last contig that starts before it, in one sort of the block.
    """
    spans = offsets.filter("len > 0").select("contig_idx", "start", (F.col("start") + F.col("len")).alias("end"))
    each = spans.withColumn("_block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    none = F.lit(None)
    kind = points.select(F.struct(*points.columns).alias("p")).schema["p"].dataType
    span = F.struct("contig_idx", "start", "end")
    starts = each.select("_block", F.greatest(F.col("start"), F.col("_block") * block).alias("_at"), F.lit(0).alias("_kind"), span.alias("_span"), none.cast(kind).alias("_point"))
    asked = points.select(F.floor(F.col("pos") / block).alias("_block"), F.col("pos").alias("_at"), F.lit(1).alias("_kind"), none.cast("struct<contig_idx:bigint,start:bigint,end:bigint>").alias("_span"), F.struct(*points.columns).alias("_point"))
    w = W.partitionBy("_block").orderBy("_at", "_kind")
    met = starts.unionByName(asked).withColumn("s", F.last("_span", True).over(w.rowsBetween(W.unboundedPreceding, 0))).filter("_kind = 1")
    inside = F.col("_at") < F.col("s.end")
    return met.select("_point.*", F.when(inside, F.col("s.contig_idx")).alias("contig_idx"), F.when(inside, F.col("_at") - F.col("s.start")).alias("local"))


def merged_counts(parts: list[DataFrame]) -> DataFrame:
    """``shard, tested`` of several counts together."""
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    return total.groupBy("shard").agg(F.sum("tested").alias("tested"))


