"""Column batches: one file of bits per sample beside one file of k-mers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitloom.plans.ranks import numbered

#: Bits of a column that are written as one line.
_LINE = 100_000


def column_batch(spark: SparkSession, path: str, ords: list[int] | None = None) -> DataFrame:
    """``ord, start, bits`` of the column files below ``path/bits``, plain or gzipped: each line of a column with the place of its first bit.

    A column is one file ``col_000003...``, as other programs write it, or a folder ``col=000003``
    (:func:`write_columns`). With ``ords`` only those samples' files are opened. A column may have any number of
    lines, each of which is a row, so no column is held whole unless it is one line.
    """
    wanted = "*" if ords is None else "{" + ",".join(f"{o:06d}*" for o in ords) + "}"
    at = F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    lines = spark.read.text(f"{path}/bits/col[_=]{wanted}").select(
        F.regexp_extract(at[0], r"col[_=](\d+)", 1).cast("int").alias("ord"), F.struct(*(c.alias(f"k{i}") for i, c in enumerate(at))).alias("at"), F.translate("value", "\r", "").alias("bits")
    )
    before = W.partitionBy("ord").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    return lines.select("ord", F.coalesce(F.sum(F.length("bits")).over(before), F.lit(0)).alias("start"), "bits").filter("bits <> ''")


def probe_rows(columns: DataFrame) -> int:
    """The number of features of a batch: the length of a column. Columns of unequal length raise."""
    each = columns.groupBy("ord").agg(F.sum(F.length("bits")).alias("n"))
    low, high = each.agg(F.min("n"), F.max("n")).first()
    if low != high:
        raise ValueError("columns of unequal length")
    return low or 0


def presence_of(columns: DataFrame) -> DataFrame:
    """``idx, ord`` of every 1 of a batch; the last bit of a character counts, as in ASCII 0 and 1."""
    at = F.posexplode(F.split("bits", "")).alias("i", "b")
    return columns.select("ord", "start", at).filter("b <> '' and ascii(b) % 2 = 1").select((F.col("start") + F.col("i")).alias("idx"), "ord")


def write_columns(rows: DataFrame, path: str, samples: int) -> None:
    """Sorted rows (``kmer, bit``) as k-mers and one text of bits per sample below ``path``, with their numbers in ``path/meta``.

    Bits are gathered per sample in stretches of 100,000 numbered rows, each a line of the sample's file, so no column is ever held whole.
    """
    spark = rows.sparkSession
    placed = numbered(rows.select("bit", "kmer"), ["bit", "kmer"], "idx")
    placed.select("kmer", "idx").repartitionByRange("idx").sortWithinPartitions("idx").select("kmer").write.mode("overwrite").text(f"{path}/kmers", compression="gzip")
    long = placed.select("idx", F.posexplode(F.split("bit", "")).alias("ord", "b")).filter((F.col("ord") < samples) & (F.col("b") != ""))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "b"))), lambda x: x["b"]), "").alias("bits")
    part = long.groupBy(F.lpad(F.col("ord").cast("string"), 6, "0").alias("col"), F.floor(F.col("idx") / _LINE).alias("part")).agg(line)
    part.repartition("col").sortWithinPartitions("col", "part").select("col", "bits").write.mode("overwrite").partitionBy("col").text(f"{path}/bits", compression="gzip")
    facts = f"format=column_text_bitstrings\nnum_rows={placed.count()}\nnum_columns={samples}\ncolumn_file_pattern=bits/col=%06d/*\nsorted_by=bits_then_kmer"
    spark.createDataFrame([(facts,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def batch_facts(spark: SparkSession, path: str) -> dict[str, str]:
    """What ``path/meta`` tells of a batch."""
    lines = spark.read.text(f"{path}/meta").filter(F.col("value").contains("="))
    return {k: v for k, _, v in (r.value.partition("=") for r in lines.collect())}  # a few lines
