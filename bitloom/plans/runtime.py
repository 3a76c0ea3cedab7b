"""Tables, materialised stages and size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: File systems and folders of tables this process has written, until they are removed.
_scratch: list[tuple] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share for stages that must outlive one of them.

    ``spark.checkpoint.dir`` (or an already set checkpoint folder) wins. Only a local
    session that names none, as in tests, gets a temporary one; on a cluster that is an error, as
    executors would write to disks of their own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-bitloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed now into the shared folder, with its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder; what is put there goes with :func:`release`."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    _scratch.append((where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where))
    return path


def release() -> None:
    """Removes the tables this process has written into the shared folder; results not computed yet can't be any more. Runs at the end of the process by itself."""
    while _scratch:
        files, where = _scratch.pop()
        try:
            files.delete(where, True)
        except Exception:  # noqa: BLE001, S110 - the session may be gone already
            pass


atexit.register(release)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a columnar table in the shared folder and read back; it stays until :func:`release`."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; counts at most one more."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", max_rows: int = 100_000) -> DataFrame:
    """Join a large, possibly skewed ``left`` with a narrow lookup table ``right`` of unique keys.

    ``right`` is broadcast only after a count shows at most ``max_rows`` rows.
    Beyond that both sides are shuffled, and adaptive execution splits the
    partitions of hot keys of ``left``, to each part of which the few rows of ``right``
    are read again. (Salting would copy all of ``right`` instead.) Null keys match nothing.
    """
    return left.join(F.broadcast(right) if at_most(right, max_rows) else right, on, how)
