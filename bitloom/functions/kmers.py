"""Scalar expressions on k-mers, kept as upper-case text: its order on ACGT is that of the 2-bit code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_kmer(kmer: Column, k: int | None = None) -> Column:
    """Whether a text is made of A, C, G, T in either case only (of length ``k``); false for null and empty."""
    letters = (F.translate(kmer, "ACGTacgt", "") == "") & (F.length(kmer) > 0)
    return F.coalesce(letters & (F.length(kmer) == k) if k else letters, F.lit(False))


def reverse_complement(kmer: Column) -> Column:
    """The other strand; signs beyond A, C, G, T are kept. Null stays null."""
    return F.reverse(F.translate(kmer, "ACGTacgt", "TGCATGCA"))


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement, in upper case."""
    return F.least(F.upper(kmer), reverse_complement(F.upper(kmer)))


def encoded(kmer: Column) -> Column:
    """The 2-bit code (A 0, C 1, G 2, T 3, first base highest) as bigint of a k-mer of up to 31 bases."""
    digits = F.translate(F.upper(kmer), "ACGT", "0123")
    return F.when(F.length(kmer) <= 31, F.conv(digits, 4, 10).cast("bigint"))


def decoded(code: Column, k: int) -> Column:
    """The k-mer of a 2-bit code."""
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", "ACGT")


def index_shard(canon: Column, shards: int) -> Column:
    """The shard of a canonical k-mer: the low bits of its code; ``shards`` is a power of two up to 4096."""
    if shards < 1 or shards & (shards - 1) or shards > 4096:
        raise ValueError("the number of shards is a power of two up to 4096")
    tail = F.translate(F.substring(canon, -6, 6), "ACGT", "0123")
    return F.pmod(F.conv(tail, 4, 10).cast("int"), F.lit(shards))
