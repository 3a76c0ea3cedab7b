from datetime import datetime

import numpy as np
import pytest

from bitloom.operators import features, structure
from bitloom.plans import pipeline

K, N = 11, 40


def test_association_end_to_end(spark, tmp_path):
    rng = np.random.default_rng(1)
    seq = "".join(rng.choice(list("ACGT"), 600))
    y = rng.normal(size=N)
    cause = (y + rng.normal(size=N) * 0.2 > 0).astype(int)
    other = (rng.random(N) < 0.5).astype(int)
    rows = []
    for i in range(3000):
        bit = (rng.random(N) < 0.5).astype(int)
        kmer = "".join(rng.choice(list("ACGT"), K))
        if 100 <= i < 115:  # neighbouring k-mers of one place carry the signal
            bit, kmer = cause, seq[i : i + K]
        if i == 200:
            bit = cause | other
        rows.append((i, f"s{i % 4}", kmer, "".join(map(str, bit)), datetime(2024, 1, 1)))
    df = spark.createDataFrame(rows, "row_id bigint, shard string, kmer string, bit string, loaded_at timestamp")
    samples = spark.createDataFrame([(i, f"id{i}") for i in range(N)], "ord int, sample_id string")
    phenotype = spark.createDataFrame([(i, f"id{i}", float(v)) for i, v in enumerate(y)], "line_no int, sample_id string, y double")
    contigs = spark.createDataFrame([(0, "Chr1", "A" * 50, datetime(2024, 1, 1)), (1, "Chr2", seq, datetime(2024, 1, 1))], "contig_idx bigint, name string, seq string, loaded_at timestamp")
    s = pipeline.Settings(k=K, rank=2, log10_p=4, log10_p_2d_input=4, log10_p_2d=3, window=10, density=0.9)
    root = str(tmp_path / "results")
    plan = pipeline.run_association(df, samples, phenotype, contigs, root, s, "v1", True)[1]
    assert {what for _, what in plan} == {"would run"}
    out, log = pipeline.run_association(df, samples, phenotype, contigs, root, s, "v1")
    assert {what for _, what in log} == {"ran"} and len(log) == 13
    assert {100, 107, 114} <= {r.row_id for r in out["hits"].collect()}
    assert set(range(150, 165)) <= {r.pos for r in out["mapped"].collect()}
    assert out["threshold"].first().tested == sum(r.tested for r in out["counts"].collect()) > 40
    assert out["pairs"].count() > 0 and out["mapped_pairs"].count() > 0
    _, log = pipeline.run_association(df, samples, phenotype, contigs, root, s, "v1")
    assert {what for _, what in log} == {"kept"}
    _, log = pipeline.run_association(df, samples, phenotype, contigs, root, pipeline.Settings(**{**s.__dict__, "window": 30}), "v1")
    assert {n for n, what in log if what == "ran"} == {"mapped", "points"}


def test_two_populations_end_to_end(spark, tmp_path):
    rng = np.random.default_rng(2)
    bits = lambda n, m, t: spark.createDataFrame([(f"{t}{i}", "".join(map(str, (rng.random(n) < 0.5).astype(int)))) for i in range(m)], "label string, bit string")
    obs = spark.createDataFrame([(h, p, float(rng.normal())) for h in range(8) for p in range(6)], "h int, p int, y double")
    args = bits(8, 10, "h"), bits(6, 7, "p"), obs, str(tmp_path / "r")
    out, log = pipeline.run_two_populations(*args, pipeline.TwoWaySettings(2, 1), "v1")
    assert out.count() == 70 and log == [("twoway", "ran")]
    assert pipeline.run_two_populations(*args, pipeline.TwoWaySettings(2, 1), "v1")[1] == [("twoway", "kept")]


def test_bases_come_from_all_features(spark, tmp_path):
    rng = np.random.default_rng(3)
    centre = rng.random((2, N)) < 0.5
    rows = []
    for i in range(600):  # two thirds of the rows, of a structure of their own, lie in one shard of five
        giant = i % 3 > 0
        bit = np.where(rng.random(N) < 0.2, rng.random(N) < 0.5, centre[int(giant)]).astype(int)
        rows.append((i, "giant" if giant else f"s{i % 4}", "".join(rng.choice(list("ACGT"), K)), "".join(map(str, bit)), datetime(2024, 1, 1)))
    rows.append((*rows[0][:3], "1" * N, datetime(2023, 1, 1)))  # redelivered, counts once
    df = spark.createDataFrame(rows, "row_id bigint, shard string, kmer string, bit string, loaded_at timestamp")
    samples = spark.createDataFrame([(i, f"id{i}") for i in range(N)], "ord int, sample_id string")
    phenotype = spark.createDataFrame([(i, f"id{i}", float(v)) for i, v in enumerate(rng.normal(size=N))], "line_no int, sample_id string, y double")
    contigs = spark.createDataFrame([(0, "Chr1", "A" * 50, datetime(2024, 1, 1))], "contig_idx bigint, name string, seq string, loaded_at timestamp")
    s = pipeline.Settings(k=K, rank=2, reservoir=50, subsample=30)
    out, _ = pipeline.run_association(df, samples, phenotype, contigs, str(tmp_path / "results"), s, "v1")
    assert out["sample"].count() == 50
    x = np.array([[int(c) for c in r[3]] for r in rows[:-1]], float)
    x = x[np.minimum(x.mean(1), 1 - x.mean(1)) >= 0.05]
    scores = structure.component_scores(x.T @ x, 2)
    one = np.ones((N, 1))
    for name, columns in (("basis", [one, scores]), ("basis_2d", [one, scores, structure.pair_products(scores)])):
        want = structure.orthonormal(np.hstack(columns))
        got = pipeline._basis(features.design(samples, phenotype), out[name]).basis
        np.testing.assert_allclose(got @ got.T, want @ want.T, atol=1e-9)


def test_other_inputs_are_not_answered_by_kept_tables(spark, tmp_path):
    rng = np.random.default_rng(4)
    bits = lambda n, m, t: [(f"{t}{i}", "".join(map(str, (rng.random(n) < 0.5).astype(int)))) for i in range(m)]
    obs = spark.createDataFrame([(h, p, float(rng.normal())) for h in range(6) for p in range(4)], "h int, p int, y double")
    obs.write.parquet(str(tmp_path / "obs"))
    for name, rows in (("h", bits(6, 5, "h")), ("p", bits(4, 3, "p"))):
        spark.createDataFrame(rows, "label string, bit string").write.parquet(str(tmp_path / name))
    read = lambda: [spark.read.parquet(str(tmp_path / n)) for n in ("h", "p", "obs")]
    s = pipeline.TwoWaySettings(1, 1)
    assert pipeline.run_two_populations(*read(), str(tmp_path / "r"), s)[1] == [("twoway", "ran")]
    assert pipeline.run_two_populations(*read(), str(tmp_path / "r"), s)[1] == [("twoway", "kept")]
    spark.createDataFrame(bits(6, 4, "more"), "label string, bit string").write.mode("append").parquet(str(tmp_path / "h"))
    out, log = pipeline.run_two_populations(*read(), str(tmp_path / "r"), s)
    assert log == [("twoway", "ran")] and out.count() == 27
    with pytest.raises(ValueError, match="version"):
        pipeline.run_two_populations(spark.createDataFrame(bits(6, 5, "h"), "label string, bit string"), *read()[1:], str(tmp_path / "r"), s)
