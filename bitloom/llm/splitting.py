"""Splitting oversized sequences at natural boundaries by pointer doubling."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitloom.operators.mapping import reference, written_reference
from bitloom.plans.runtime import checkpointed

LIMIT, OVERLAP, MIN_GAP = 10_000, 30, 10

#: Cut points of one contig that share a window task span this many steps, and pieces that share a chunk of a sequence so many limits.
_STEPS_PER_BLOCK, _LIMITS_PER_CHUNK = 64, 64


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``contig_idx, len, gap_start, gap_end`` lists out of the lengths of the stretches between gaps and of the gaps, by running sums over a batch."""
    for batch in batches:
        stretches, gaps = batch.column("stretches"), batch.column("gaps")
        each = np.diff(gaps.offsets.to_numpy())
        # a stretch, a gap, a stretch, ... a last stretch without a gap
        first = np.concatenate([[0], np.cumsum(each)])
        gap = gaps.flatten().to_numpy().astype(np.int64)
        stretch = np.delete(stretches.flatten().to_numpy().astype(np.int64), first[1:] + np.arange(len(each)))
        upto = np.cumsum(stretch + gap)
        end = upto - np.repeat(np.concatenate([[0], upto])[first[:-1]], each)
        lists = [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(v)) for v in (end - gap, end)]
        yield pa.RecordBatch.from_arrays([batch.column("contig_idx"), batch.column("len"), *lists], ["contig_idx", "len", "starts", "ends"])


def gaps_of(ref: DataFrame, limit: int = LIMIT, min_gap: int = MIN_GAP) -> DataFrame:
    """``contig_idx, len, gaps``: the inner runs of N of at least ``min_gap`` bases of each contig (``contig_idx, len, seq``) longer than ``limit``.

    Only lengths of stretches leave the scan.
    """
    run = f"N{{{min_gap},}}"
    lengths = ref.filter(F.col("len") > limit).select(
        "contig_idx", "len",
        F.transform(F.split("seq", run, -1), F.length).alias("stretches"),
        F.transform(F.regexp_extract_all("seq", F.lit(run), F.lit(0)), F.length).alias("gaps"),
    )
    placed = lengths.mapInArrow(_placed, "contig_idx bigint, len bigint, starts array<bigint>, ends array<bigint>")
    gap = F.arrays_zip(F.col("starts").alias("gap_start"), F.col("ends").alias("gap_end")).cast("array<struct<gap_start:bigint,gap_end:bigint>>")
    inner = F.filter(gap, lambda g: (g["gap_start"] > 0) & (g["gap_end"] < F.col("len")))
    return placed.select("contig_idx", "len", inner.alias("gaps"))


def cut_points(ref: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, min_gap: int = MIN_GAP) -> DataFrame:
    """The nodes a cut may fall on: ``contig_idx, len, pos, kind, gap_start, gap_end``.

    A cut at ``pos`` ends a piece there and starts the next one ``overlap``
    bases before. ``kind`` is ``root`` (the start of the contig), ``gap`` (the
    end of an assembly gap), ``near`` (a gap too close to the start to be cut at),
    ``hard`` or ``end``. Where two neighbours are further apart than a
    piece reaches, every path runs through the first of them, so the emergency
    cuts between them depend on it alone and can be laid down as nodes too.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    step = limit - overlap
    g = checkpointed(gaps_of(ref, limit, min_gap))  # a row per oversized contig; the sequences are read once
    near = F.filter("gaps", lambda x: x["gap_end"] <= overlap)
    cuts = F.filter("gaps", lambda x: x["gap_end"] > overlap)

    def node(pos, kind, a, b):
        return F.struct(pos.cast("bigint").alias("pos"), F.lit(kind).alias("kind"), a.cast("bigint").alias("gap_start"), b.cast("bigint").alias("gap_end"))

    none = F.lit(None)
    nodes = F.concat(
        F.array(node(F.lit(overlap), "root", none, none)),
        F.transform(cuts, lambda x: node(x["gap_end"], "gap", x["gap_start"], x["gap_end"])),
        F.array(node(F.col("len"), "end", none, none)),
    )
    chain = g.select("contig_idx", "len", nodes.alias("n"), F.transform(near, lambda x: node(x["gap_end"], "near", x["gap_start"], x["gap_end"])).alias("near"))
    spot = "struct<pos:bigint,kind:string,gap_start:bigint,gap_end:bigint>"
    following = F.concat(F.slice("n", F.lit(2), F.size("n") - 1), F.array(F.element_at("n", -1)))
    pairs = F.arrays_zip("n", following).cast(f"array<struct<a:{spot},b:{spot}>>")
    stretch = chain.select("contig_idx", "len", F.explode(pairs).alias("s"))
    hard = F.ceil((F.col("s.b.pos") - F.col("s.a.pos")) / F.lit(step)) - 1
    fill = F.when(hard > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), hard), lambda j: node(F.col("s.a.pos") + j * step, "hard", none, none)))
    laid = stretch.select("contig_idx", "len", F.explode(F.concat(F.array(F.col("s.a")), F.coalesce(fill, F.array().cast(f"array<{spot}>")))).alias("x"))
    return laid.select("contig_idx", "len", "x.*").unionByName(chain.select("contig_idx", "len", F.explode("near").alias("x")).select("contig_idx", "len", "x.*"))


def successors(points: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Joins every cut point with ``nxt``, the farthest one its piece may end at; the end leads to itself.

    Points are windowed in blocks of a bounded stretch of one contig, each with
    a look ahead of one step, so that a giant contig is shared by many tasks.
    """
    step = limit - overlap
    wide = _STEPS_PER_BLOCK * step
    block = F.floor(F.col("pos") / F.lit(wide))
    ahead = (F.col("pos") - block * wide <= step) & (block > 0)
    live = points.filter("kind <> 'near'").withColumn("block", F.explode(F.when(ahead, F.array(block, block - 1)).otherwise(F.array(block))))
    w = W.partitionBy("contig_idx", "block").orderBy("pos").rangeBetween(0, step)
    reach = live.withColumn("nxt", F.max("pos").over(w)).filter(block == F.col("block")).drop("block")
    return reach.unionByName(points.filter("kind = 'near'").withColumn("nxt", F.lit(None).cast("bigint")))


def greedy_cuts(ref: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, min_gap: int = MIN_GAP) -> DataFrame:
    """All cut points of a reference (``contig_idx, len, seq``) with ``nxt`` and ``on_path``: whether the greedy division of the contig uses them.

    Pointer doubling: in round k each point holds its successor after 2^k pieces
    (the table joined with itself), and points on the path mark theirs. Two pieces always
    get further than one step, which bounds the rounds by the logarithm of
    the longest contig. Each round is checkpointed in the shared folder.
    """
    step = limit - overlap
    points = checkpointed(successors(cut_points(ref, limit, overlap, min_gap), limit, overlap))
    longest = points.agg(F.max("len")).first()[0]
    if longest is None:
        return points.withColumn("on_path", F.lit(False))
    hops = points.filter("kind <> 'near'").select("contig_idx", "pos", F.col("nxt").alias("far"), (F.col("kind") == "root").alias("on_path"))
    for _ in range(math.ceil(math.log2(2 * longest / step + 2))):
        a, b = hops.alias("a"), hops.select(F.col("contig_idx").alias("c"), F.col("pos").alias("p"), F.col("far").alias("f")).alias("b")
        met = a.join(b, (F.col("contig_idx") == F.col("c")) & (F.col("far") == F.col("p")))
        told = F.array(
            F.struct(F.col("pos").alias("pos"), F.col("f").alias("far"), F.col("on_path").alias("on_path")),
            F.struct(F.col("p").alias("pos"), F.lit(None).cast("bigint").alias("far"), F.col("on_path").alias("on_path")),
        )
        both = met.select("contig_idx", F.explode(told).alias("t")).select("contig_idx", "t.*").filter("far is not null or on_path")
        hops = checkpointed(both.groupBy("contig_idx", "pos").agg(F.max("far").alias("far"), F.max("on_path").alias("on_path")))
    marks = hops.filter("on_path").select("contig_idx", "pos", "on_path")
    live = points.filter("kind <> 'near'").join(marks, ["contig_idx", "pos"], "left")
    return live.unionByName(points.filter("kind = 'near'").withColumn("on_path", F.lit(False))).withColumn("on_path", F.coalesce("on_path", F.lit(False)))


def divisions(nodes: DataFrame, overlap: int = OVERLAP) -> DataFrame:
    """``contig_idx, len, cut, start, end``: the pieces of the doubled path; ``cut`` is where the piece before ends."""
    return nodes.filter("on_path and kind <> 'end'").select("contig_idx", "len", F.col("pos").alias("cut"), (F.col("pos") - overlap).alias("start"), F.col("nxt").alias("end"))


def split_oversized(contigs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, min_gap: int = MIN_GAP) -> DataFrame:
    """Contigs in pieces of at most ``limit`` bases: ``contig_idx, start, end, in_gap, seq``.

    Needs ``contig_idx, name, seq, loaded_at``; other columns are ignored. ``seq`` is
    normalised (no white space, upper case, other signs as N); of redelivered
    contigs the latest row with a sequence counts, so rows with a null ``contig_idx`` or
    ``seq`` give nothing, and a sequence without a base gives nothing either. The
    pieces of a contig cover it, each repeats the last ``overlap`` bases of
    the piece before, and each ends in the last assembly gap (a run of N of at least ``min_gap``)
    it can reach, or at the limit if it reaches none.
    ``in_gap`` tells whether its end is inside a gap or the contig's own end.
    Contigs up to the limit come out whole, and are not shuffled. Longer ones are dealt out
    in chunks, out of which their pieces are cut, so that the longest contig is many tasks.
    """
    ref = written_reference(contigs)
    nodes = greedy_cuts(ref, limit, overlap, min_gap)
    wide = _LIMITS_PER_CHUNK * limit
    natural = nodes.filter("kind in ('gap', 'end')").select("contig_idx", F.col("pos").alias("end"), F.lit(True).alias("natural"))
    path = divisions(nodes, overlap).join(natural, ["contig_idx", "end"], "left")
    piece = F.struct("start", "end", F.coalesce("natural", F.lit(False)).alias("natural"))
    # a chunk has a bounded number of pieces
    cuts = path.groupBy("contig_idx", F.floor(F.col("start") / wide).alias("chunk")).agg(F.collect_list(piece).alias("pieces"))
    # bytes, so that a piece is found without walking the characters before it; a chunk is longer by a piece
    long = ref.filter(F.col("len") > limit).select("contig_idx", F.encode("seq", "US-ASCII").alias("b"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("len") - 1) / wide))).alias("chunk"))
    dealt = long.select("contig_idx", "chunk", F.substring("b", (F.col("chunk") * wide + 1).cast("int"), F.lit(wide + limit)).alias("bases")).repartition("contig_idx", "chunk")
    each = dealt.join(cuts, ["contig_idx", "chunk"]).select("contig_idx", "chunk", "bases", F.explode("pieces").alias("p"))
    bases = F.substring("bases", (F.col("p.start") - F.col("chunk") * wide + 1).cast("int"), (F.col("p.end") - F.col("p.start")).cast("int"))
    cut = each.select("contig_idx", F.col("p.start").alias("start"), F.col("p.end").alias("end"), F.col("p.natural").alias("natural"), F.decode(bases, "US-ASCII").alias("seq"))
    whole = ref.filter((F.col("len") > 0) & (F.col("len") <= limit)).select("contig_idx", F.lit(0).cast("bigint").alias("start"), F.col("len").alias("end"), F.lit(True).alias("natural"), "seq")
    in_gap = F.col("natural") | F.substring("seq", -min_gap, min_gap).eqNullSafe("N" * min_gap)
    return cut.unionByName(whole).select("contig_idx", "start", "end", in_gap.alias("in_gap"), "seq")


def gap_cases(contigs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, min_gap: int = MIN_GAP) -> DataFrame:
    """``contig_idx, gap_start, gap_end``: the natural boundaries of every oversized contig, told by the pieces they end in; -1, -1 for one without any.

    A gap is a row if a piece of the doubled path holds its end: pieces follow one another
    without overlap if each is taken from the end of the one before, so every gap lies in one
    of them. A contig without gaps is a row if its pieces reach its end. So a path that misses
    a part of a contig loses rows here as it loses bases in :func:`split_oversized`.
    Pieces and gaps meet by contig and stretches of ``limit`` bases, of which a piece touches two.
    """
    nodes = greedy_cuts(reference(contigs, limit), limit, overlap, min_gap)
    pieces = divisions(nodes, overlap).withColumn("cut", F.when(F.col("start") == 0, F.lit(0)).otherwise(F.col("cut")))
    touched = F.explode(F.sequence(F.floor(F.col("cut") / limit), F.floor(F.col("end") / limit)))
    listed = pieces.select("contig_idx", touched.alias("block"), "cut", "end")
    gaps = nodes.filter("gap_start is not null").select("contig_idx", "gap_start", "gap_end").withColumn("block", F.floor(F.col("gap_end") / limit))
    held = gaps.join(listed, ["contig_idx", "block"]).filter("cut < gap_end and gap_end <= end").select("contig_idx", "gap_start", "gap_end")
    bare = pieces.filter(F.col("end") == F.col("len")).select("contig_idx").join(gaps.select("contig_idx").distinct(), "contig_idx", "left_anti")
    none = F.lit(-1).cast("bigint")
    return held.unionByName(bare.select("contig_idx", none.alias("gap_start"), none.alias("gap_end")))
