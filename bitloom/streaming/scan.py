"""The single-feature scan over a stream of row shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom.functions.special import chi2_sf1
from bitloom.operators.features import Design, valid_rows
from bitloom.operators.scan1d import tested_rows

SCHEMA = "row_id bigint, shard string, kmer string, bit string, loaded_at timestamp"


def row_stream(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of the row matrix as they arrive below ``path``."""
    return spark.readStream.schema(SCHEMA).parquet(path)


def stream_hits(stream: DataFrame, d: Design, k: int, bits: int, min_corr: float = 0.2, log10_p: float = 6.0, late: str = "90 days") -> DataFrame:
    """Hits of a stream; a row redelivered within ``late`` of the newest gives no second hit, and state is kept for hits only."""
    got = tested_rows(valid_rows(stream, k, bits), d, min_corr, log10_p)
    once = got.withWatermark("loaded_at", late).dropDuplicatesWithinWatermark(["row_id"])
    return once.withColumn("p", chi2_sf1(F.col("t")))


def stream_counts(stream: DataFrame, d: Design, k: int, bits: int, min_corr: float = 0.2) -> DataFrame:
    """``shard, tested`` kept up to date (complete or update mode); redelivered rows count as they come."""
    got = tested_rows(valid_rows(stream, k, bits), d, min_corr)
    return got.groupBy("shard").agg(F.count("*").alias("tested"))
