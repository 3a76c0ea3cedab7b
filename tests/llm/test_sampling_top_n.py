import random

import pytest

from bitloom.llm import sampling, top_n

ROWS = "row_id int, shard string, kmer string, bit string, sample_key string"


def test_size_and_content(spark):
    rows = [(i, "s", f"k{i}", None if i % 7 == 0 else "01", "clash") for i in range(300)] + [(1, "s", "k1", "01", "clash")] * 3
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    got = sampling.uniform_sample(df, 50, columns=["kmer", "bit"])
    assert got.columns == ["kmer", "bit"] and got.count() == 50
    assert {r.kmer for r in got.collect()} <= {r[2] for r in rows}
    assert sampling.uniform_sample(df, 1000).count() == 303 and sampling.uniform_sample(df.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        sampling.uniform_sample(df, 0)


def test_every_row_is_equally_likely(spark):
    df = spark.range(60).repartition(4).cache()
    seen, runs = [0] * 60, 60
    for seed in range(runs):
        for r in sampling.uniform_sample(df, 20, seed).collect():
            seen[r.id] += 1
    # 20 expected, variance 13: chi-square of 60 cells, 99.99 % below 115
    assert sum((s - runs / 3) ** 2 / (runs / 3 * 2 / 3) for s in seen) < 115


@pytest.mark.parametrize("size", [1, 20, 400, 5000])
def test_named_rows_give_one_sample_however_they_lie(spark, size):
    df = spark.range(3000).selectExpr("id", "id as sample_key")
    draw = lambda parts: sampling.keyed_sample(df.repartition(parts), size, 5, row=[sampling.F.col("id")])
    one, other = ({r.id: r.sample_key for r in draw(parts).collect()} for parts in (2, 7))
    assert one == other and len(one) == min(size, 3000) and all(0 <= k < 1 for k in one.values())
    if size == 400:
        assert abs(max(one.values()) - 400 / 3000) < 0.03


def test_merges_in_levels(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MERGED_AT_ONCE", 2)
    df = spark.range(500).repartition(9)
    keyed = df.select(sampling.F.xxhash64(sampling.F.lit(1), "id").alias("h"), "id").orderBy(sampling.F.expr("shiftrightunsigned(h, 11)")).limit(30)
    assert {r.id for r in sampling.uniform_sample(df, 30, 1, row=[sampling.F.col("id")]).collect()} == {r.id for r in keyed.collect()}


def test_rows_of_files_are_named(spark, tmp_path):
    spark.createDataFrame([("a",)] * 40, "v string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = sampling.keyed_sample(df, 15, row=sampling.delivered_row(df)).collect()
    assert len(got) == 15 and len({r.sample_key for r in got}) == 15  # repeated rows draw separately


def test_pieces_merge_to_a_uniform_sample(spark):
    big, small = spark.range(80), spark.range(80, 100)
    share, runs = 0, 30
    for seed in range(runs):
        kept = sampling.merged_sample([sampling.keyed_sample(big, 10, 2 * seed), sampling.keyed_sample(small, 10, 2 * seed + 1)], 10).collect()
        assert len(kept) == 10
        share += sum(r.id >= 80 for r in kept)
    assert 30 < share < 92  # 60 expected, sd 6.6


def test_stream_keeps_a_sample(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        spark.range(i * 40, i * 40 + 40).write.mode("append").parquet(path)
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 4).parquet(path)
    sampling.sample_stream(stream, out, 25).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    last = max((p for p in (tmp_path / "out").iterdir()), key=lambda p: int(p.name.split("=")[1]))
    ids = [r.id for r in spark.read.parquet(str(last)).collect()]
    assert len(ids) == len(set(ids)) == 25


HITS = "hit_id bigint, contig_idx bigint, pos bigint, effect double, pval double, bitstring string, trait string, place string"


def brute(rows, n=5):
    ok = {(r[1], r[4], r[2], r[0]) for r in rows if None not in (r[1], r[2], r[4]) and r[1] >= 0 and r[2] >= 0 and 0 <= r[4] <= 1}
    out = set()
    for c in {r[0] for r in ok}:
        out |= {(c, h, i + 1) for i, (_, _, _, h) in enumerate(sorted(r for r in ok if r[0] == c)[:n])}
    return out


@pytest.mark.parametrize("held", [3, 250_000])
def test_top_hits_against_sorting(spark, held):
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        c = rng.choice([0] * 10 + list(range(40)) + [None, -1])
        p = rng.choice([0.0, 1e-300, 0.5, 0.5, 1.0, 1.5, -1.0, None, float("nan"), float("inf"), rng.random()])
        rows.append((i, c, rng.choice([None, -1, 0, 5, 5, rng.randrange(1000)]), 1.0, p, None, None, "x"))
    rows += rng.sample(rows, 200)
    df = spark.createDataFrame(rows, HITS).repartition(6)
    got = [(r.contig_idx, r.hit_id, r.place) for r in top_n.top_n(top_n.valid_hits(df), "contig_idx", ["pval", "pos"], "hit_id", 5, held).collect()]
    assert set(got) == brute(rows) and len(got) == len(set(got))


def test_top_n_of_texts_and_edges(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "b", 1), ("a", None, 3), (None, "a", 4), ("b", "q", 5)], "g string, v string, i int")
    assert sorted(map(tuple, top_n.top_n(df, "g", ["v"], "i", 1).collect())) == [("a", "b", 1, 1), ("b", "q", 5, 1)]
    assert top_n.top_n(df.limit(0), "g", ["v"], "i", 1).count() == 0
