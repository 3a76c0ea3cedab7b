"""Writers: Parquet for further work, text where other programs read it."""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bases of a contig whose hits make one file, so that a giant contig is many tasks.
_STRETCH = 5_000_000


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet with full precision."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)


def write_tsv(df: DataFrame, path: str, columns: list[str], order: list[str] | None = None, sep: str = "\t", digits: int | None = None) -> None:
    """Delimited text without a header; doubles in full, or to ``digits`` significant ones."""
    kinds = dict(df.dtypes)
    show = lambda c: F.format_string(f"%.{digits - 1}e", c) if digits and kinds[c] == "double" else F.col(c)
    out = df.select(*(show(c).alias(c) for c in columns))
    if order:
        out = df.orderBy(*order).select(*(show(c).alias(c) for c in columns))
    out.write.mode("overwrite").csv(path, sep=sep, header=False, nullValue="")


def write_hits(hits: DataFrame, path: str) -> None:
    """``kmer effect p``."""
    write_tsv(hits, path, ["kmer", "effect", "p"])


def write_candidates(hits: DataFrame, path: str) -> None:
    """``kmer bits effect p``."""
    write_tsv(hits, path, ["kmer", "bit", "effect", "p"])


def write_counts(counts: DataFrame, path: str) -> None:
    write_tsv(counts, path, ["shard", "tested"])


def write_index(index: DataFrame, path: str, k: int) -> None:
    """The k-mer index by shard, sorted by key within each, and one row that tells ``k``, the number of shards and of entries.

    Range partitioned by shard and key, so that a shard is as many tasks as it needs.
    """
    index.repartitionByRange("shard", "canon").sortWithinPartitions("shard", "canon").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/entries")
    entries = index.sparkSession.read.parquet(f"{path}/entries")
    entries.agg(F.lit(k).alias("k"), F.countDistinct("shard").alias("shards"), F.count("*").alias("entries")).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def read_index(spark: SparkSession, path: str, k: int) -> DataFrame:
    """``canon, effect, p, shard`` as written by :func:`write_index`; another ``k`` than that of the index raises. Columns that aren't used are not read."""
    kept = spark.read.parquet(f"{path}/meta").first()
    if kept.k != k:
        raise ValueError(f"the index is of k-mers of {kept.k} bases, not of {k}")
    return spark.read.schema("canon string, effect double, p double, shard int").parquet(f"{path}/entries")


def write_contig_hits(mapped: DataFrame, path: str) -> None:
    """Mapped hits as ``pos effect p``, sorted, in a file ``contig_7.00000.tsv`` for each contig and 5,000,000 bases; where there are no hits there is no file.

    The hits of a file meet in one task. In a mounted folder tasks write files themselves, each under a hidden name first:
    Hadoop starts three processes and keeps a sum for every file there. In other file systems Spark writes them, into folders ``contig_idx=7``.
    """
    spark = mapped.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    met = mapped.withColumn("_stretch", F.floor(F.col("pos") / _STRETCH)).repartition("contig_idx", "_stretch").sortWithinPartitions("contig_idx", "_stretch", "pos")
    uri = files.makeQualified(where).toUri()
    if uri.getScheme() != "file":
        met.select("contig_idx", "pos", "effect", "p").write.mode("overwrite").partitionBy("contig_idx").csv(path, sep="\t")
        return
    files.delete(where, True)
    files.mkdirs(where)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    name = F.concat(F.lit("contig_"), text("contig_idx"), F.lit("."), F.when(F.col("_stretch").isNull(), "none").otherwise(F.format_string("%05d", "_stretch")), F.lit(".tsv"))
    lines = met.select(name.alias("name"), F.concat_ws("\t", text("pos"), text("effect"), text("p")).alias("line"))
    lines.mapInArrow(_write_runs(uri.getPath()), "files bigint").agg(F.sum("files")).collect()
    files.create(spark._jvm.org.apache.hadoop.fs.Path(where, "_SUCCESS"), True).close()


def _write_runs(folder: str):
    """Writes each run of equal names as the file of that name; the rows of a name must stand together in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hidden, now, out, done = f"{folder}/.{uuid.uuid4().hex}", None, None, 0

        def finish() -> None:
            out.close()
            os.replace(hidden, f"{folder}/{now}")

        try:
            for batch in batches:
                pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for name, part in groupby(pairs, lambda pair: pair[0]):
                    if name != now:
                        if out is not None:
                            finish()
                        now, out, done = name, open(hidden, "w", encoding="utf-8", newline=""), done + 1  # noqa: SIM115
                    out.write("".join(f"{line}\n" for _, line in part))
            if out is not None:
                finish()
        except BaseException:
            if out is not None:
                out.close()
            if os.path.exists(hidden):
                os.remove(hidden)
            raise
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["files"])

    return run


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Pairs in order of their indices."""
    write_tsv(pairs, path, ["idx_a", "idx_b", "effect", "p"], ["idx_a", "idx_b"])


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """The k-mers of a pair scan (``idx, kmer``), one a line; the line is the index. Range partitioned, so that files of sorted name hold them in order."""
    dictionary.orderBy("idx").select("kmer").write.mode("overwrite").text(path)


def write_twoway(results: DataFrame, path: str) -> None:
    """``a b ratio delta lrt p`` in blanks, with 10 digits."""
    write_tsv(results, path, ["a", "b", "ratio", "delta", "lrt", "p"], sep=" ", digits=10)


def write_basis(spark: SparkSession, basis: np.ndarray, path: str) -> None:
    """A covariate basis as little-endian int32 rows, int32 columns and doubles, column after column (as long as the sample axis), into any file system Spark knows."""
    n, r = basis.shape
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(struct.pack("<ii", n, r) + np.asfortranarray(basis, "<f8").tobytes("F")))
    out.close()


def read_basis(spark: SparkSession, path: str, n: int | None = None) -> np.ndarray:
    """A basis as written by :func:`write_basis`; a wrong number of rows or a short file raises."""
    data = spark.read.format("binaryFile").load(path).first().content
    rows, columns = struct.unpack_from("<ii", data)
    if n is not None and rows != n or len(data) != 8 + 8 * rows * columns:
        raise ValueError("the basis doesn't fit the samples")
    return np.frombuffer(data, "<f8", offset=8).reshape(rows, columns, order="F")
