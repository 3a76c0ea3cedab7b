import random

import pytest
from pyspark.sql import functions as F

from bitloom.plans import ranks, runtime


@pytest.mark.parametrize("max_rows", [1, 1000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_join_gives_the_same_both_ways(spark, max_rows, how):
    left = spark.createDataFrame([(i % 5 if i % 7 else None, i) for i in range(200)], "k int, i int")
    right = spark.createDataFrame([(j, f"v{j}") for j in range(1, 9)], "k int, v string")
    got = runtime.lookup_join(left, right, ["k"], how, max_rows=max_rows)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_counting_stops_early(spark):
    df = spark.range(10)
    assert runtime.at_most(df, 10) and not runtime.at_most(df, 9) and runtime.at_most(df.limit(0), 0)


def test_numbers_follow_the_order(spark):
    values = list(range(500))
    random.Random(0).shuffle(values)
    df = spark.createDataFrame([(v, "x") for v in values], "v int, idx string").repartition(7)
    got = ranks.numbered(df, ["v"], "place").collect()
    assert all(r.place == r.v for r in got) and len(got) == 500
    assert ranks.numbered(df.limit(0), ["v"], "place").count() == 0


def test_stages_are_written_to_the_shared_folder(spark):
    df = spark.range(5).withColumn("a", F.lit(None).cast("string"))
    assert runtime.shared_dir(spark) and runtime.written(df, "t").count() == 5
    assert runtime.checkpointed(df).count() == 5


def test_written_tables_go_in_the_end(spark):
    import os

    df = runtime.written(spark.range(3), "gone")
    path = df.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert os.path.exists(path)
    runtime.release()
    assert not os.path.exists(path)


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    bare = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="checkpoint"):
        runtime.shared_dir(SimpleNamespace(sparkContext=bare))
