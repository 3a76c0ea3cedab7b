"""Percentiles per group by one distributed sort and counts per partition, and summaries that combine."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitloom.operators.features import latest_rows
from bitloom.plans.runtime import at_most, checkpointed, written

PERCENTS = [1, 5, 25, 50, 75, 95, 99]

#: Shares by which tied values are spread over partitions (see ``sorted_runs``).
_TIES = 4096

#: Entries (a partition's share of a group) up to which their table is broadcast; about 40 bytes each.
_SPAN_ROWS = 500_000


def latest_pairs(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """Each pair (``trait, idx_a, idx_b``) once, with the columns ``keep`` of its latest row; rows of pairs delivered once are not shuffled.

    Null keys are keys like any other. Of rows of equal time the larger values stand.
    """
    return latest_rows(pairs, ["trait", "idx_a", "idx_b"], "written_at", keep).select("trait", "idx_a", *keep)


def finite_values(pairs: DataFrame, groups: list[str]) -> DataFrame:
    """``*groups, measure, value, tie``: effect and p-value of each pair as rows of their own, finite ones only.

    ``groups`` are of ``trait`` and ``run_day``; ``measure`` is 0 for ``effect`` and 1 for ``pval``; -0.0 becomes 0.0.
    """
    both = F.array(*(F.struct(F.lit(i).cast("tinyint").alias("measure"), F.col(c).alias("value")) for i, c in enumerate(("effect", "pval"))))
    pairs = latest_pairs(pairs, ["effect", "pval", *(g for g in groups if g != "trait")])
    long = pairs.select(*groups, F.pmod("idx_a", F.lit(_TIES)).cast("smallint").alias("tie"), F.explode(both).alias("m"))
    finite = long.select(*groups, "m.measure", (F.col("m.value") + F.lit(0.0)).alias("value"), "tie")
    return finite.filter(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < F.lit(float("inf"))))


def sorted_runs(values: DataFrame, groups: list[str]) -> DataFrame:
    """``*groups, value, id``: all values in order, cut into partitions, written once to the shared folder.

    ``id`` is the number of the partition (from its 33rd bit on) and of the row in it. Values
    are range partitioned with ``tie`` as last key, so a value that a third
    of all rows share is spread over tasks as well.
    """
    keys = [*groups, "value", "tie"]
    placed = values.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return written(placed.drop("tie").withColumn("id", F.monotonically_increasing_id()), "sorted")


def order_statistics(values: DataFrame, groups: list[str], wanted: Callable[[Column, Column], Column]) -> DataFrame:
    """``*groups, n, rank, value``: the values at the zero-based ranks of each group for which ``wanted(rank, n)`` holds.

    One full sort; counts per partition and group give each group's offset in
    each partition, so that every row knows its rank without a further shuffle of the values.
    """
    runs = sorted_runs(values, groups).withColumn("part", F.shiftright("id", 33))
    counts = runs.groupBy("part", *groups).agg(F.count("*").alias("c"), F.min("id").alias("start"))
    before = W.partitionBy(*groups).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    spans = counts.withColumn("first", F.coalesce(F.sum("c").over(before), F.lit(0))).withColumn("n", F.sum("c").over(W.partitionBy(*groups)))
    spans = checkpointed(spans.select(F.col("part").alias("of_part"), "start", "first", "n", *(F.col(g).alias(f"of_{g}") for g in groups)))
    if at_most(spans, _SPAN_ROWS):
        spans = F.broadcast(spans)
    same = [F.col("part") == F.col("of_part"), *(F.col(g).eqNullSafe(F.col(f"of_{g}")) for g in groups)]
    rank = F.col("first") + F.col("id") - F.col("start")
    return runs.join(spans, same).select(*groups, "n", rank.alias("rank"), "value").filter(wanted(F.col("rank"), F.col("n")))


def _measure(code: Column) -> Column:
    return F.when(code == 0, "effect").otherwise("pval")


def percentiles(values: DataFrame, groups: list[str], percents: list[float] = PERCENTS) -> DataFrame:
    """``*groups, n, pct, value``: exact percentiles, interpolated between neighbouring order statistics."""
    shares = [float(p) for p in percents]

    def near(pct: Column, rank: Column, n: Column) -> Column:
        return (rank == F.floor(pct / 100 * (n - 1))) | (rank == F.ceil(pct / 100 * (n - 1)))

    found = order_statistics(values, groups, lambda rank, n: reduce(or_, (near(F.lit(p), rank, n) for p in shares)))
    each = found.withColumn("pct", F.explode(F.array(*map(F.lit, shares)))).filter(near(F.col("pct"), F.col("rank"), F.col("n")))
    ends = each.groupBy(*groups, "n", "pct").agg(F.min_by("value", "rank").alias("low"), F.max_by("value", "rank").alias("high"))
    at = F.col("pct") / 100 * (F.col("n") - 1)
    return ends.select(*groups, "n", "pct", (F.col("low") + (F.col("high") - F.col("low")) * (at - F.floor(at))).alias("value"))


def trait_percentiles(pairs: DataFrame, percents: list[float] = PERCENTS) -> DataFrame:
    """``trait, measure, n, pct, value`` of ``effect`` and ``pval`` of each trait.

    Needs ``trait, idx_a, idx_b, effect, pval, run_day, written_at``; other
    columns are ignored. Each pair counts once (its latest row); null, NaN and infinite
    values take no part; a null trait is a group of its own; a group without finite
    values gives no row, an empty table none.
    """
    out = percentiles(finite_values(pairs, ["trait"]), ["trait", "measure"], percents)
    return out.withColumn("measure", _measure(F.col("measure")))


def day_summaries(pairs: DataFrame, points: int = 400) -> DataFrame:
    """What is kept of each day: ``trait, run_day, measure, value, weight``.

    At most ``points`` + 1 order statistics of each trait, day and measure at even steps of
    rank, each weighted with the rows it stands for. A rank read off any
    union of these (:func:`span_percentiles`) is off by less than 1 / ``points`` of the rows:
    0.25 % by default. Groups of up to ``points`` rows are kept exactly.
    """
    groups = ["trait", "run_day"]
    slots = lambda n: F.least(n, F.lit(points))
    # slot i of m stands for the ranks from floor(i n / m) up to the next slot's first; its middle rank is kept
    first = lambda i, n: F.floor(i * n / slots(n))
    slot = lambda rank, n: F.floor(((rank + 1) * slots(n) - 1) / n)
    middle = lambda i, n: F.floor((first(i, n) + first(i + 1, n) - 1) / 2)
    kept = order_statistics(finite_values(pairs, groups), [*groups, "measure"], lambda rank, n: rank == middle(slot(rank, n), n))
    i, n = slot(F.col("rank"), F.col("n")), F.col("n")
    return kept.select(*groups, _measure(F.col("measure")).alias("measure"), "value", (first(i + 1, n) - first(i, n)).alias("weight"))


def span_percentiles(summaries: DataFrame, first_day: str | None = None, last_day: str | None = None, percents: list[float] = PERCENTS) -> DataFrame:
    """``trait, measure, n, pct, value`` of any span of days (both ends included), out of :func:`day_summaries`; exact where all its groups were kept exactly."""
    span = summaries
    if first_day is not None:
        span = span.filter(F.col("run_day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        span = span.filter(F.col("run_day") <= F.lit(last_day).cast("date"))
    merged = span.groupBy("trait", "measure", "value").agg(F.sum("weight").alias("weight"))
    w = W.partitionBy("trait", "measure").orderBy("value")
    run = merged.withColumn("upto", F.sum("weight").over(w)).withColumn("n", F.sum("weight").over(W.partitionBy("trait", "measure")))
    pcts = run.withColumn("pct", F.explode(F.array(*map(F.lit, [float(p) for p in percents]))))
    at = F.col("pct") / 100 * (F.col("n") - 1)
    of_rank = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("value")))
    ends = pcts.groupBy("trait", "measure", "n", "pct").agg(of_rank(F.floor(at)).alias("low"), of_rank(F.ceil(at)).alias("high"))
    return ends.select("trait", "measure", "n", "pct", (F.col("low") + (F.col("high") - F.col("low")) * (at - F.floor(at))).alias("value"))


def rank_errors(found: DataFrame, pairs: DataFrame, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """``trait, measure, n, pct, error`` of percentiles (``trait, measure, pct, value``) of a span of days: how far, as a share of all ``n`` values, the rank of each value is from the one asked for.

    Values are counted below and up to each percentile, in one pass over all of them; there are a few percentiles for each trait.
    """
    values = finite_values(pairs, ["trait", "run_day"])
    if first_day is not None:
        values = values.filter(F.col("run_day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        values = values.filter(F.col("run_day") <= F.lit(last_day).cast("date"))
    asked = checkpointed(found.groupBy("trait", "measure").agg(F.array_sort(F.collect_list(F.struct("pct", F.col("value").alias("at")))).alias("asked")))
    if at_most(asked, _SPAN_ROWS):
        asked = F.broadcast(asked)
    asked = asked.withColumnsRenamed({"trait": "of_trait", "measure": "of_measure"})
    met = values.join(asked, F.col("trait").eqNullSafe(F.col("of_trait")) & (_measure(F.col("measure")) == F.col("of_measure")))
    each = met.select("trait", F.col("of_measure").alias("measure"), "value", F.explode("asked").alias("q")).select("trait", "measure", "value", "q.*")
    counts = each.groupBy("trait", "measure", "pct").agg(F.count("*").alias("n"), F.count_if(F.col("value") < F.col("at")).alias("below"), F.count_if(F.col("value") <= F.col("at")).alias("upto"))
    # a value between two neighbours has any rank between theirs
    wanted, between = F.col("pct") / 100 * (F.col("n") - 1), (F.col("below") == F.col("upto")).cast("int")
    error = F.greatest(F.col("below") - between - wanted, wanted - (F.col("upto") - 1 + between), F.lit(0.0)) / F.col("n")
    return counts.select("trait", "measure", "n", "pct", error.alias("error"))
