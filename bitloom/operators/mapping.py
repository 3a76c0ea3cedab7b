"""Index of significant k-mers, reference sequences, and where the one occurs on the other."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitloom.functions.kmers import canonical, encoded, index_shard, is_kmer, reverse_complement
from bitloom.operators.features import latest_rows
from bitloom.plans.runtime import checkpointed, lookup_join, written

#: Bases that fit a bigint as a 2-bit code.
_WORD = 31

#: Bases of a reference that are cut into k-mers by one task step.
_CHUNK = 20_000

#: Index entries up to which an index is broadcast (about 60 bytes each).
_SMALL_INDEX = 300_000

#: The logarithm of the bits of the largest map of index keys.
_GATE_BITS = 28

_DIGITS = np.full(256, 4, np.uint8)
_DIGITS[[65, 67, 71, 84]] = range(4)


def normalised(seq: Column) -> Column:
    """Bases as a reference reader takes them: no white space, upper case, N for everything but A, C, G, T."""
    return F.regexp_replace(F.translate(seq, "acgt \t\n\x0b\x0c\r", "ACGT"), "[^ACGT]", "N")


def reference(contigs: DataFrame, over: int = -1) -> DataFrame:
    """``contig_idx, name, len, seq`` normalised, redelivered contigs once (the latest with a sequence); others with null keys or sequences are left out.

    No sequence is shuffled for it but those of contigs delivered more than once. Contigs of which the text as
    delivered isn't longer than ``over`` are left out, before they are normalised (which makes no text longer).
    """
    given = contigs.filter("contig_idx is not null and seq is not null")
    once = latest_rows(given, ["contig_idx"], "loaded_at", ["name", "seq"], contigs).filter(F.length("seq") > over)
    return once.select("contig_idx", "name", normalised(F.col("seq")).alias("seq")).select("contig_idx", "name", F.length("seq").cast("bigint").alias("len"), "seq")


def written_reference(contigs: DataFrame) -> DataFrame:
    """As :func:`reference`, written once into the shared folder, for work that reads it several times; whoever needs lengths alone reads no sequence."""
    return written(reference(contigs), "reference")


def contig_lengths(contigs: DataFrame) -> DataFrame:
    """``contig_idx, name, len`` of each contig; no sequence is shuffled. A contig without a sequence has length 0."""
    given = contigs.filter("contig_idx is not null").select(
        "contig_idx", "name", "loaded_at", F.col("seq").isNotNull().alias("there"),
        F.coalesce(F.length(F.translate("seq", "A \t\n\x0b\x0c\r", "A")), F.lit(0)).cast("bigint").alias("len"),
    )
    last = F.max(F.struct("there", "loaded_at", "len", "name"))
    return given.groupBy("contig_idx").agg(last.alias("s")).select("contig_idx", "s.name", "s.len")


def contig_offsets(contigs: DataFrame, buckets: int = 64) -> DataFrame:
    """``contig_idx, name, len, start``: where each contig starts when all stand one after another.

    A running sum in two steps: contigs are ranged into buckets by index, summed within them and
    shifted by the sums of the buckets before, so no task holds all of them.
    """
    return running_offsets(checkpointed(contig_lengths(contigs)), buckets)  # narrow; the sequences are read once


def running_offsets(lengths: DataFrame, buckets: int = 64) -> DataFrame:
    """``lengths`` (``contig_idx, name, len``) with ``start``, as :func:`contig_offsets`."""
    spread = lengths.agg(F.min("contig_idx").alias("low"), F.max("contig_idx").alias("high")).first()
    width = max(1, -(-((spread.high or 0) - (spread.low or 0) + 1) // buckets))
    cut = lengths.withColumn("bucket", F.floor((F.col("contig_idx") - F.lit(spread.low or 0)) / width))
    sums = cut.groupBy("bucket").agg(F.sum("len").alias("total"))
    shifts = sums.select("bucket", F.coalesce(F.sum("total").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("shift"))
    within = F.coalesce(F.sum("len").over(W.partitionBy("bucket").orderBy("contig_idx").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # as many rows as buckets
    return cut.withColumn("inside", within).join(F.broadcast(shifts), "bucket").select("contig_idx", "name", "len", (F.col("inside") + F.col("shift")).alias("start"))


def chunks(ref: DataFrame, k: int, size: int = _CHUNK) -> DataFrame:
    """``contig_idx, at, bases``: each sequence in chunks that repeat ``k`` - 1 bases, as bytes; short sequences give none."""
    n = F.length("seq")
    starts = F.when(n >= k, F.sequence(F.lit(0), n - k, F.lit(size)))
    each = ref.select("contig_idx", F.encode("seq", "US-ASCII").alias("b"), F.explode(starts).alias("at"))
    return each.select("contig_idx", F.col("at").cast("bigint").alias("at"), F.substring("b", F.col("at") + 1, F.lit(size + k - 1)).alias("bases"))


def reference_kmers(ref: DataFrame, k: int) -> DataFrame:
    """``contig_idx, pos, kmer``: every window of ``k`` bases without N, zero-based.

    Long sequences are cut into chunks first, which are dealt out anew, so that a giant contig is many tasks.
    """
    cut = chunks(ref, k).repartition(F.col("contig_idx"), F.col("at"))
    window = F.transform(F.sequence(F.lit(1), F.length("bases") - (k - 1)), lambda i: F.struct((i - 1).alias("i"), F.decode(F.substring(F.col("bases"), i, F.lit(k)), "US-ASCII").alias("kmer")))
    return cut.select("contig_idx", "at", F.inline(window)).filter(~F.col("kmer").contains("N")).select("contig_idx", (F.col("at") + F.col("i")).alias("pos"), "kmer")


def build_index(hits: DataFrame, k: int, shards: int = 16) -> DataFrame:
    """``canon, effect, p, shard``: hits (``kmer, effect, p``) by canonical k-mer, each once.

    Of k-mers of one canonical form that of the smallest p counts, then the
    smallest effect. K-mers of another length or with other letters are skipped.
    """
    keyed = hits.filter(is_kmer(F.col("kmer"), k)).select(canonical(F.col("kmer")).alias("canon"), F.struct("p", "effect").alias("v"))
    best = keyed.groupBy("canon").agg(F.min("v").alias("v"))
    return best.select("canon", "v.effect", "v.p", index_shard(F.col("canon"), shards).alias("shard"))


def word_spans(k: int) -> list[tuple[int, int]]:
    """First base and length of the parts of a k-mer that make a bigint each: all of 31 bases, but for a shorter first one."""
    first = (k - 1) % _WORD + 1
    return [(0, first), *((at, _WORD) for at in range(first, k, _WORD))]


def key_columns(k: int, name: str = "key") -> list[str]:
    """The names of the columns that hold a k-mer's code; one up to 31 bases."""
    return [name if i == 0 else f"{name}{i}" for i in range(len(word_spans(k)))]


def codes_of(kmer: Column, k: int, name: str = "key") -> list[Column]:
    """The 2-bit code of an upper-case k-mer as bigints."""
    return [encoded(F.substring(kmer, at + 1, size)).alias(c) for c, (at, size) in zip(key_columns(k, name), word_spans(k))]


def keys_of(kmer: Column, k: int) -> list[Column]:
    """What k-mers of either strand meet by: the code of the canonical form."""
    return codes_of(canonical(kmer), k)


def window_codes(bases: bytes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the windows of ``k`` bases without N in a chunk, and the codes of either strand, a row per word."""
    digit = _DIGITS[np.frombuffer(bases, np.uint8)]
    n, spans = len(digit) - k + 1, word_spans(k)
    if n < 1:
        return np.zeros(0, np.int64), *(np.zeros((len(spans), 0), np.int64),) * 2
    masked = np.concatenate([[0], np.cumsum(digit > 3)])
    at = np.flatnonzero(masked[k:] == masked[:-k])
    d = digit.astype(np.int64)

    def codes(size: int) -> tuple[np.ndarray, np.ndarray]:
        # of every window of so many bases, both strands; windows with N are left out anyway
        m = len(d) - size + 1
        forward, back = np.zeros(m, np.int64), np.zeros(m, np.int64)
        for i in range(size):
            part = d[i : i + m] & 3
            forward = forward << 2 | part
            back |= (3 - part) << (2 * i)
        return forward, back

    of = {size: codes(size) for size in {size for _, size in spans}}
    forward = np.stack([of[size][0][at + first] for first, size in spans])
    back = np.stack([of[size][1][at + k - first - size] for first, size in spans])
    return at, forward, back


def _smaller(forward: np.ndarray, back: np.ndarray) -> np.ndarray:
    """The canonical codes out of those of both strands."""
    less, same = np.zeros(forward.shape[1], bool), np.ones(forward.shape[1], bool)
    for f, b in zip(forward, back):
        less |= same & (f < b)
        same &= f == b
    return np.where(less, forward, back)


def _slots(codes: np.ndarray, bits: int) -> np.ndarray:
    mixed = np.zeros(codes.shape[1], np.uint64)
    for word in codes:
        mixed = (mixed ^ word.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed >> np.uint64(64 - bits)


def _gate(index: DataFrame | None, k: int):
    """A bit map of the keys of an index, shared with all tasks: 16 bits a key, but never above 32 MB.

    Windows whose bit isn't set are in no index entry. The map is put together by a
    grouped OR of its words, of which the driver gets the final ones.
    """
    if index is None:
        return None
    bits = max(16, min(_GATE_BITS, (16 * index.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.unique(_slots(np.stack([c.to_numpy() for c in batch.columns]), bits))
            words, first = np.unique(slots >> np.uint64(6), return_index=True)
            if len(words):
                marks = np.bitwise_or.reduceat(np.uint64(1) << (slots & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(marks.view(np.int64))], ["word", "marks"])

    words = index.select(*key_columns(k)).mapInArrow(run, "word bigint, marks bigint").groupBy("word").agg(F.bit_or("marks").alias("marks")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words.column("word").to_numpy()] = words.column("marks").to_numpy().view(np.uint64)
    return index.sparkSession.sparkContext.broadcast((bits, table))


def _may_be_in(gate: tuple[int, np.ndarray], codes: np.ndarray) -> np.ndarray:
    bits, table = gate
    slots = _slots(codes, bits)
    return (table[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)


def strand_codes(ref: DataFrame, k: int, index: DataFrame | None = None, canonical_index: bool = False) -> DataFrame:
    """``contig_idx, pos`` and the codes of both strands (``forward``, ``back``; canonical ones as ``key`` with ``canonical_index``) of every window of ``k`` bases without N.

    A code is as many bigints as it takes (:func:`word_spans`), for any ``k``. Long sequences are cut into chunks that
    are dealt out anew. With an ``index`` (``key``, ...) most windows of which no code is in it
    are dropped where they are made, so that a join afterwards moves few of them.
    """
    gate = _gate(index, k)
    names = key_columns(k) if canonical_index else key_columns(k, "forward") + key_columns(k, "back")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for contig, start, bases in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                at, *strands = window_codes(bases, k)
                if canonical_index:
                    strands = [_smaller(*strands)]
                if gate is not None and len(at):
                    there = np.logical_or.reduce([_may_be_in(gate.value, s) for s in strands])
                    at, strands = at[there], [s[:, there] for s in strands]
                if len(at):
                    words = [pa.array(word) for s in strands for word in s]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), contig, np.int64)), pa.array(at + start), *words], ["contig_idx", "pos", *names])

    cut = chunks(ref, k).repartition(F.col("contig_idx"), F.col("at"))
    return cut.mapInArrow(run, ", ".join(f"{c} bigint" for c in ["contig_idx", "pos", *names]))


def reference_keys(ref: DataFrame, k: int, index: DataFrame | None = None) -> DataFrame:
    """``contig_idx, pos, key, ...`` of every window of ``k`` bases without N, by its canonical form; with an ``index`` (``key``, ...) of few more than those in it."""
    return strand_codes(ref, k, index, True)


def kmers_at(ref: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """``places`` (``contig_idx, pos``, ...) with the ``kmer`` that stands there; places too near the end, or with N, are left out.

    Sequences are cut into chunks first, so that places of a giant contig meet small texts.
    """
    size = F.lit(_CHUNK)
    keyed = places.withColumn("_at", F.floor(F.col("pos") / size) * size)
    cut = chunks(ref, k).withColumnRenamed("at", "_at").withColumnRenamed("bases", "_bases")
    met = keyed.join(cut, ["contig_idx", "_at"])
    kmer = F.decode(F.substring("_bases", (F.col("pos") - F.col("_at") + 1).cast("int"), F.lit(k)), "US-ASCII")
    return met.withColumn("kmer", kmer).filter((F.length("kmer") == k) & ~F.col("kmer").contains("N")).drop("_at", "_bases")


def map_hits(ref: DataFrame, index: DataFrame, k: int, max_p: float | None = None) -> DataFrame:
    """``contig_idx, pos, key, ..., effect, p``: every place of the reference whose k-mer is in the index, on either strand.

    A bit map of the index drops most other places in the scan; the rest meet the index by
    key, broadcast if it is small (counted).
    """
    entries = (index if max_p is None else index.filter(F.col("p") <= max_p)).select(*keys_of(F.col("canon"), k), "effect", "p")
    entries = checkpointed(entries)
    places = reference_keys(ref, k, entries)
    return lookup_join(places, entries, key_columns(k), max_rows=_SMALL_INDEX).select("contig_idx", "pos", *key_columns(k), "effect", "p")


def map_dual(ref: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """``contig_idx, pos, effect, p`` over hits kept as they are (``kmer, effect, p``): the forward k-mer is looked up first, then its reverse complement.

    Repeated hits of one k-mer count once, that of the smallest p, then the smallest effect.
    """
    once = checkpointed(hits.filter(is_kmer(F.col("kmer"), k)).groupBy(*codes_of(F.upper("kmer"), k)).agg(F.min(F.struct("p", "effect")).alias("v")))
    both = strand_codes(ref, k, once)
    for side in ("forward", "back"):
        names = key_columns(k, side)
        renamed = once.select(*(F.col(c).alias(n) for c, n in zip(key_columns(k), names)), F.col("v").alias(f"v_{side}"))
        both = lookup_join(both, renamed, names, "left", _SMALL_INDEX)
    return both.withColumn("v", F.coalesce("v_forward", "v_back")).filter("v is not null").select("contig_idx", "pos", "v.effect", "v.p")


def density_filter(hits: DataFrame, window: int = 100, density: float = 0.95) -> DataFrame:
    """Hits in a window of ``window`` bases of which at least ``density`` start a hit, and those at position 0.

    ``hits`` needs ``contig_idx, pos``; several rows of one position count each. A window opens
    at a hit; if enough hits start in it, all hits up to its end stay. No
    window reaches over a gap of ``window`` bases, so hits fall into islands
    between such gaps. Where a contig's islands are long, the count needs a
    bounded stretch only, so that contigs are cut into blocks with a look ahead
    (for the count) and a look back (for windows opened before) of one window.
    """
    need = int(window * density)
    wide = max(window * 200, 10_000)
    block = F.floor(F.col("pos") / F.lit(wide))
    ahead = F.when((F.col("pos") - block * wide < 2 * window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    behind = F.when((F.col("pos") - block * wide >= wide - window), F.concat(ahead, F.array(block + 1))).otherwise(ahead)
    copies = hits.withColumn("_block", F.explode(behind))
    w = W.partitionBy("contig_idx", "_block").orderBy("pos")
    counted = copies.withColumn("_n", F.count("*").over(w.rangeBetween(0, window - 1)))
    good = F.when(F.col("_n") >= need, F.col("pos") + window - 1)
    until = counted.withColumn("_until", F.coalesce(F.max(good).over(w.rangeBetween(-(window - 1), 0)), F.lit(0)))
    return until.filter((F.col("pos") <= F.col("_until")) & (F.col("_block") == block)).drop("_block", "_n", "_until")


def to_genome(mapped: DataFrame, offsets: DataFrame) -> DataFrame:
    """``mapped`` with ``pos`` counted through all contigs."""
    return lookup_join(mapped, offsets.select("contig_idx", "start"), ["contig_idx"]).withColumn("pos", F.col("pos") + F.col("start")).drop("start")


def map_merge_filter(ref: DataFrame, index: DataFrame, k: int, window: int = 100, density: float = 0.95, max_p: float | None = None) -> DataFrame:
    """``pos, effect, p``: hits of the index on a reference (:func:`written_reference`), density filtered, in genome-wide positions."""
    kept = density_filter(map_hits(ref, index, k, max_p), window, density)
    return to_genome(kept, running_offsets(ref.select("contig_idx", "name", "len"))).select("pos", "effect", "p")


def pair_scan_input(ref: DataFrame, index: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``pos, bit, effect, p``: mapped candidates of the pair scan with their bit strings, not density filtered."""
    bits = candidates.groupBy(*keys_of(F.col("kmer"), k)).agg(F.min_by("bit", F.struct("p", "bit")).alias("bit"))
    mapped = to_genome(map_hits(ref, index, k), running_offsets(ref.select("contig_idx", "name", "len")))
    return lookup_join(mapped, checkpointed(bits), key_columns(k)).select("pos", "bit", "effect", "p")


def first_positions(ref: DataFrame, kmers: DataFrame, k: int) -> DataFrame:
    """``idx, pos``: the first genome-wide position of each k-mer (``idx, kmer``), on either strand; absent ones give none."""
    names = key_columns(k)
    keyed = checkpointed(kmers.filter(is_kmer(F.col("kmer"), k)).select("idx", *keys_of(F.col("kmer"), k)))
    index = checkpointed(keyed.select(*names).distinct())
    met = lookup_join(reference_keys(ref, k, index), index, names, max_rows=_SMALL_INDEX)
    first = to_genome(met, running_offsets(ref.select("contig_idx", "name", "len"))).groupBy(*names).agg(F.min("pos").alias("pos"))
    return keyed.join(first, names).select("idx", "pos")


def map_pairs(pairs: DataFrame, positions: DataFrame) -> DataFrame:
    """``pos_a, pos_b, effect, p`` of pairs (``idx_a, idx_b, effect, p``) of which both ends have a position; ``pos_a`` <= ``pos_b``."""
    at = checkpointed(positions.select("idx", "pos"))
    a = lookup_join(pairs, at.select(F.col("idx").alias("idx_a"), F.col("pos").alias("a")), ["idx_a"])
    b = lookup_join(a, at.select(F.col("idx").alias("idx_b"), F.col("pos").alias("b")), ["idx_b"])
    return b.select(F.least("a", "b").alias("pos_a"), F.greatest("a", "b").alias("pos_b"), "effect", "p")
