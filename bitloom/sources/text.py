"""Readers of the text formats association studies come in; every schema is fixed, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitloom.functions.kmers import is_kmer
from bitloom.operators.features import strict_rows
from bitloom.operators.mapping import normalised
from bitloom.plans.ranks import numbered
from bitloom.plans.runtime import checkpointed, lookup_join

#: Small files that one task reads, and bytes of files in general.
_FILES, _TASK_BYTES = 100, 16_000_000

_BLANK = r"[ \t\x0B\f\r]+"


def _fields(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(line, _BLANK, " ")), " ")


def _double(text: Column) -> Column:
    return text.try_cast("double")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, line`` of the non-empty lines of a file as long as the sample axis (read whole), a trailing CR dropped."""
    whole = spark.read.text(path, wholetext=True)
    each = whole.select(F.posexplode(F.split("value", "\n")).alias("at", "line"))
    return each.select(F.col("at").alias("line_no"), F.regexp_replace("line", r"\r\z", "").alias("line")).filter("line <> ''")


def sample_list(spark: SparkSession, path: str) -> DataFrame:
    """``ord, sample_id``: one id per line; the place among non-empty lines is the bit's place."""
    lines = numbered_lines(spark, path)
    return lines.select((F.row_number().over(W.orderBy("line_no")) - 1).alias("ord"), F.col("line").alias("sample_id"))


def phenotype_file(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, sample_id, y``: id and value in blanks, up to the first line without both. Duplicates are kept in order."""
    parsed = numbered_lines(spark, path).select("line_no", _fields(F.col("line")).alias("f"))
    rows = parsed.select("line_no", F.col("f")[0].alias("sample_id"), _double(F.try_element_at("f", F.lit(2))).alias("y"))
    bad = rows.filter("y is null").agg(F.min("line_no").alias("_bad"))
    return rows.join(F.broadcast(bad)).filter("_bad is null or line_no < _bad").drop("_bad")  # one row


def row_matrix(spark: SparkSession, path: str) -> DataFrame:
    """``shard, kmer, bit`` of plain or gzipped shards: k-mer and bit string by tab, else by the first blank; other lines are skipped."""
    line = F.regexp_replace("value", r"\r\z", "")
    cut = F.instr(line, "\t")
    at = F.when(cut > 0, cut).otherwise(F.instr(line, " "))
    rows = spark.read.text(path).select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("shard"), line.alias("line"), at.alias("at"))
    return rows.filter("at > 0").select("shard", F.expr("substring(line, 1, at - 1)").alias("kmer"), F.expr("substring(line, at + 1)").alias("bit"))


def strict_row_matrix(spark: SparkSession, path: str, k: int, bits: int) -> DataFrame:
    """As :func:`row_matrix`, failing on bit strings of wrong length or content and skipping k-mers of wrong length."""
    return strict_rows(row_matrix(spark, path), k, bits)


def association_file(spark: SparkSession, path: str, k: int | None = None) -> DataFrame:
    """``kmer, bit, effect, p`` of hit files with 3 columns (``bit`` null) or 4; a header, bad numbers and bad k-mers are skipped."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).select(f.alias("f")).filter(F.size("f").isin(3, 4))
    four = F.size("f") == 4
    typed = rows.select(
        F.col("f")[0].alias("kmer"), F.when(four, F.col("f")[1]).alias("bit"),
        _double(F.when(four, F.try_element_at("f", F.lit(3))).otherwise(F.try_element_at("f", F.lit(2)))).alias("effect"),
        _double(F.when(four, F.try_element_at("f", F.lit(4))).otherwise(F.try_element_at("f", F.lit(3)))).alias("p"),
    )
    return typed.filter(is_kmer(F.col("kmer"), k) & F.col("effect").isNotNull() & F.col("p").isNotNull())


def count_files(spark: SparkSession, path: str) -> DataFrame:
    """``shard, tested``."""
    return spark.read.csv(path, sep="\t", schema="shard string, tested bigint").filter("tested is not null")


def pair_file(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    """``idx_a, idx_b, effect, p``; lines that don't parse, and indices from ``features`` on, are skipped."""
    rows = spark.read.csv(path, sep="\t", schema="idx_a bigint, idx_b bigint, effect double, p double", mode="DROPMALFORMED")
    ok = rows.filter("idx_a is not null and idx_b is not null and effect is not null and p is not null and idx_a >= 0 and idx_b >= 0")
    return ok if features is None else ok.filter((F.col("idx_a") < features) & (F.col("idx_b") < features))


def kmer_dictionary(spark: SparkSession, path: str, expected: int | None = None) -> DataFrame:
    """``idx, kmer``: one k-mer per line, numbered in order over all files of sorted name; the count is checked if given."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.regexp_replace("value", r"\r\z", "").alias("kmer"), F.monotonically_increasing_id().alias("id")
    )
    kept = checkpointed(lines.filter("kmer <> ''"))
    if expected is not None and kept.count() != expected:
        raise ValueError(f"the dictionary doesn't have {expected} k-mers")
    return numbered(kept, ["file", "block", "id"], "idx").select("idx", "kmer")


def hit_file(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``pos, effect, p`` of a mapped file for plots: comments, short and unparsable lines are skipped, p is at least 1e-300."""
    f = _fields(F.col("value"))
    rows = spark.read.text(path).filter(~F.col("value").startswith("#")).select(f.alias("f")).filter(F.size("f") >= 3)
    typed = rows.select(F.col("f")[0].try_cast("bigint").alias("pos"), _double(F.col("f")[1]).alias("effect"), F.greatest(_double(F.col("f")[2]), F.lit(1e-300)).alias("p"))
    ok = typed.filter("pos is not null and effect is not null and p is not null")
    if first is not None:
        ok = ok.filter(F.col("pos") >= first)
    return ok if last is None else ok.filter(F.col("pos") <= last)


def contig_hits(spark: SparkSession, path: str) -> DataFrame:
    """``pos, effect, p, contig_idx`` of hits by contig: files ``contig_7...`` or folders ``contig_idx=7`` (:func:`bitloom.sources.sinks.write_contig_hits`).

    A contig is a small file, of which Spark would give a task three or four; here a task takes a hundred (each keeps a buffer).
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where)
    tasks = max(spark.sparkContext.defaultParallelism, -(-size.getFileCount() // _FILES), size.getLength() // _TASK_BYTES)
    contig = F.regexp_extract(F.col("_metadata.file_path"), r".*/contig_(?:idx=)?(-?\d*)", 1)
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f"), contig.try_cast("bigint").alias("contig_idx")).coalesce(tasks)
    field = lambda i: F.try_element_at("f", F.lit(i))
    return rows.select(field(1).try_cast("bigint").alias("pos"), _double(field(2)).alias("effect"), _double(field(3)).alias("p"), "contig_idx")


def boundary_file(spark: SparkSession, path: str) -> DataFrame:
    """``label, start, end``."""
    return spark.read.csv(path, sep="\t", schema="label string, start bigint, end bigint", comment="#").filter("start is not null and end is not null")


def labelled_bits(spark: SparkSession, path: str) -> DataFrame:
    """``label, bit`` of a two-population matrix; lines without two fields are skipped and unequal lengths fail the job."""
    rows = spark.read.text(path).select(_fields(F.col("value")).alias("f")).filter(F.size("f") >= 2).select(F.col("f")[0].alias("label"), F.col("f")[1].alias("bit"))
    width = rows.agg(F.max(F.length("bit")).alias("_w"))
    checked = F.when(F.length("bit") == F.col("_w"), F.col("bit")).otherwise(F.raise_error(F.lit("bit strings of unequal length")))
    return rows.join(F.broadcast(width)).select("label", checked.alias("bit"))  # one row


def grid_file(spark: SparkSession, path: str) -> DataFrame:
    """``h, p, y``; comments, blank and unparsable lines are skipped."""
    rows = spark.read.text(path).filter(~F.col("value").startswith("#")).select(_fields(F.col("value")).alias("f")).filter(F.size("f") >= 3)
    typed = rows.select(F.col("f")[0].try_cast("int").alias("h"), F.col("f")[1].try_cast("int").alias("p"), _double(F.col("f")[2]).alias("y"))
    return typed.filter("h is not null and p is not null and y is not null")


def number_matrix(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, row`` of a text matrix as long as the sample axis."""
    lines = numbered_lines(spark, path)
    return lines.select("line_no", F.transform(_fields(F.col("line")), lambda v: v.cast("double")).alias("row"))


def transposed_sample(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, sample_id, row`` of a sampled matrix with a header line and one line per sample; ragged lines fail the job."""
    lines = numbered_lines(spark, path).select("line_no", F.split("line", "\t").alias("f"))
    head = lines.filter("line_no = 0").select(F.size("f").alias("_n"))
    body = lines.filter("line_no > 0").join(F.broadcast(head))  # one row
    whole = F.when(F.size("f") == F.col("_n"), F.col("f")).otherwise(F.raise_error(F.lit("a line of the matrix is ragged")).cast("array<string>"))
    return body.select("line_no", whole.alias("f")).select("line_no", F.col("f")[0].alias("sample_id"), F.transform(F.slice("f", F.lit(2), F.size("f") - 1), lambda v: v.cast("double")).alias("row"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """``contig_idx, name, seq`` of reference files: the name ends at the first white space, bases are normalised, empty contigs are kept.

    Files are read as records that begin with ``>`` at the start of a line, so that a contig is one row and a file
    many; contigs are numbered through all files of sorted name. What stands before the first record of a file is skipped.
    """
    records = spark.read.option("lineSep", "\n>").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value")
    )
    # the first record of a file still has its sign, or is no record
    first = records.select("file", "block", "id").groupBy("file").agg(F.min(F.struct("block", "id")).alias("_first"))
    told = lookup_join(records, first, ["file"]).withColumn("_is_first", (F.col("block") == F.col("_first.block")) & (F.col("id") == F.col("_first.id")))
    whole = told.filter(~F.col("_is_first") | F.col("value").startswith(">")).withColumn("value", F.when(F.col("_is_first"), F.expr("substring(value, 2)")).otherwise(F.col("value")))
    head = F.substring_index("value", "\n", 1)
    name = F.regexp_extract(head, r"^([^ \t\r]*)", 1)
    named = whole.select("file", "block", "id", name.alias("name"), normalised(F.expr(r"substring(value, length(substring_index(value, '\n', 1)) + 1)")).alias("seq"))
    return numbered(named.filter("name <> ''"), ["file", "block", "id"], "contig_idx").select("contig_idx", "name", "seq")
