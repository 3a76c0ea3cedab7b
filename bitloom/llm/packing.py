"""Filling containers of fixed capacity by exact complements of item lengths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitloom.llm.tokenizer import VOCABULARY, count_tokens
from bitloom.plans.runtime import checkpointed

CAPACITY = 4096

#: Parts a length class is numbered in, so that one hot length is shared by many tasks.
_BUCKETS = 1024

#: Lengths that may be used up before the index of sums is laid out anew.
_RENEWED = 64

Pattern = tuple[dict[int, int], int]


class _Lengths:
    """Available counts by length, with an index of the sums of one, two and three lengths."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self._renew()

    def _renew(self) -> None:
        """Lays the index out anew: bit s of the k-th number is set if k lengths that are left have the sum s (whatever their counts)."""
        self.used_up, size = 0, len(self.left)
        there, full = [int(n) for n in np.flatnonzero(self.left)], (1 << size) - 1
        sums = [1]
        for _ in range(3):
            bits = 0
            for n in there:
                bits |= sums[-1] << n
            sums.append(bits & full)
        self.sums = [np.unpackbits(np.frombuffer(b.to_bytes((size + 7) // 8, "little"), np.uint8), bitorder="little")[:size].astype(bool) for b in sums]

    def taken(self, length: int) -> None:
        """Notes that a length is used up; the index, which may only promise too much, is renewed now and then."""
        self.used_up += self.left[length] == 0
        if self.used_up >= _RENEWED:
            self._renew()

    def most(self, limit: int) -> int:
        """The largest available length up to ``limit``; 0 for none."""
        at = np.flatnonzero(self.left[: limit + 1])
        return int(at[-1]) if len(at) else 0

    def _parts(self, total: int, parts: int) -> tuple[int, ...] | None:
        """So many available lengths of that sum, none of which is taken more often than it is there; the longest first."""
        if total < parts or not self.sums[parts][total]:
            return None
        if parts == 1:
            return (total,) if self.left[total] > 0 else None
        # the first length is the largest of them: at least an equal share, and what it leaves is in the index too
        a = np.arange(-(-total // parts), total - parts + 2)
        for first in a[(self.left[a] > 0) & self.sums[parts - 1][total - a]][::-1].tolist():
            self.left[first] -= 1
            rest = self._parts(total - first, parts - 1)
            self.left[first] += 1
            if rest:
                return (first, *rest)
        return None

    def exact(self, total: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill ``total`` exactly."""
        return self._parts(total, 1) or self._parts(total, 2) or self._parts(total, 3)


def container_plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """How often which combination of lengths makes a container.

    ``counts[n]`` is the number of items of length n, up to ``capacity``. Each
    combination opens with the longest item left; its gap is closed exactly by one, two
    or three lengths, and where none do, the longest item that fits goes in first.
    A combination is taken as often as its lengths last, so that of one of them fewer are left than it takes.
    That at least halves the count of that length, so there are at most
    1 + log2(count) combinations for each length: some hundred thousand for a trillion items.
    """
    stock = _Lengths(np.concatenate([[0], counts[1 : capacity + 1]]))
    plan: list[Pattern] = []
    while longest := stock.most(capacity):
        need: dict[int, int] = {}
        gap = capacity

        def take(length: int) -> None:
            need[length] = need.get(length, 0) + 1
            stock.left[length] -= 1

        take(longest)
        gap -= longest
        while gap:
            found = stock.exact(gap)
            if found is None:
                fits = stock.most(gap)
                if not fits:
                    break
                found = (fits,)
            for length in found:
                take(length)
                gap -= length
        times = 1 + min(int(stock.left[length]) // n for length, n in need.items())
        for length, n in need.items():
            stock.left[length] -= n * (times - 1)
            stock.taken(length)
        plan.append((need, times))
    return plan


def slots_of(plan: list[Pattern]) -> np.ndarray:
    """Which ranks within a length go to which containers: columns ``length, first, container, times``, in order of the first two."""
    used: dict[int, int] = {}
    base, slots = 0, []
    for need, times in plan:
        for length, n in need.items():
            at = used.get(length, 0)
            slots.append((length, at, base, times))
            used[length] = at + n * times
        base += times
    table = np.array(slots, np.int64).reshape(-1, 4)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def fill_containers(sized: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """``key, piece, start, n_tokens, container``: every item in a container of ``capacity``.

    An item above the capacity is cut into full pieces and a rest; no other
    item is split. Items of size 0 are spread over the containers (container 0 if there is
    no other); a null size counts as 0. Rows with a null or repeated key are items of their own.
    Other columns are dropped; an empty table gives no rows.

    Only the counts by length (``capacity`` numbers, however many items) reach
    the driver, which plans combinations of lengths. Items are numbered within
    their length, in parts, and find the plan's slot by that number. The capacity is below 32,768.
    """
    if not 0 < capacity < 1 << 15:
        raise ValueError("the capacity is from 1 to 32,767")
    spark = sized.sparkSession
    n = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    cut = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0).cast("bigint"))),
        lambda i: F.struct(i.alias("piece"), (i * capacity).alias("start"), F.least(F.lit(capacity).cast("bigint"), F.col("n") - i * capacity).alias("n_tokens")),
    )
    items = checkpointed(sized.select(F.col(key), n.alias("n")).select(key, F.explode(cut).alias("p")).select(key, "p.*"))
    bucket = F.pmod(F.xxhash64(key, "piece"), F.lit(_BUCKETS)).cast("int")
    counted = checkpointed(items.groupBy("n_tokens", bucket.alias("bucket")).count())
    counts = np.zeros(capacity + 1, np.int64)
    by_length = counted.groupBy("n_tokens").agg(F.sum("count").alias("c")).toArrow()  # at most capacity + 1 rows
    counts[by_length.column("n_tokens").to_numpy()] = by_length.column("c").to_numpy()
    plan = container_plan(counts, capacity)
    total = max(sum(times for _, times in plan), 1)
    before = W.partitionBy("n_tokens").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counted.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = F.row_number().over(W.partitionBy("n_tokens", "bucket").orderBy(F.col(key), "piece")) - 1
    numbered = items.withColumn("bucket", bucket).withColumn("inside", inside).join(offsets, ["n_tokens", "bucket"])
    # the number of combinations is bounded (see container_plan), so the slots are, whatever the data
    shared = spark.sparkContext.broadcast(slots_of(plan))

    @F.pandas_udf("bigint")
    def placed(lengths: pd.Series, ranks: pd.Series) -> pd.Series:
        slots, length, rank = shared.value, lengths.to_numpy(), ranks.to_numpy()
        if not len(slots):
            return pd.Series(np.zeros(len(rank), np.int64))
        # a slot is found by its length and first rank, both in one number: lengths are at most the capacity, ranks below 2^48
        at = np.searchsorted(slots[:, 0] << 48 | slots[:, 1], length << 48 | rank, side="right") - 1
        _, first, base, times = slots[np.maximum(at, 0)].T
        return pd.Series(np.where(length > 0, base + (rank - first) % times, rank % total))

    ranked = numbered.withColumn("rank", (F.col("before") + F.col("inside")).cast("bigint"))
    return ranked.select(key, "piece", "start", "n_tokens", placed("n_tokens", "rank").alias("container"))


def fill_with_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Documents (``doc_id, text``) in containers of ``capacity`` tokens, as :func:`fill_containers`."""
    return fill_containers(count_tokens(docs, vocabulary), capacity)


def container_fill(filled: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``used, containers``: how many containers hold how many tokens."""
    return filled.groupBy("container").agg(F.sum("n_tokens").alias("used")).groupBy("used").agg(F.count("*").alias("containers"))


def fill_faults(filled: DataFrame, sized: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """One row of what is wrong with containers ``filled`` with the items ``sized`` (of unique keys): ``items, overfull, missing, twice, split, wrong_size, spare``.

    Items there are; containers above the capacity; items in none; pieces there more than once; items
    in pieces although they fit; items whose pieces don't add up; and how many containers there are above the fewest that could hold all, as a share of these.
    """
    n = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    each = filled.groupBy(key).agg(F.sum("n_tokens").alias("got"), F.count("*").alias("pieces"), F.countDistinct("piece").alias("different"))
    met = sized.select(key, n.alias("n")).join(each, key, "left")
    items = met.agg(
        F.count("*").alias("items"), F.count_if(F.col("got").isNull()).alias("missing"), F.count_if(F.col("pieces") > F.col("different")).alias("twice"),
        F.count_if((F.col("pieces") > 1) & (F.col("n") <= capacity)).alias("split"), F.count_if(F.col("got") != F.col("n")).alias("wrong_size"), F.sum("n").alias("_n"),
    )
    used = filled.groupBy("container").agg(F.sum("n_tokens").alias("used"))
    boxes = used.agg(F.count_if(F.col("used") > capacity).alias("overfull"), F.count("*").alias("_boxes"))
    fewest = F.greatest(F.ceil(F.col("_n") / capacity), F.lit(1))
    return items.crossJoin(F.broadcast(boxes)).withColumn("spare", (F.col("_boxes") - fewest) / fewest).drop("_n", "_boxes")  # one row each
