import math
from datetime import datetime

import numpy as np
import pytest

from bitloom.operators import features, pairs2d, scan1d, structure

K, N = 5, 24
ROWS = "row_id bigint, shard string, kmer string, bit string, loaded_at timestamp, ones string"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=N)
    x = (rng.random((60, N)) < 0.4).astype(int)
    x[0], x[1], x[2] = 0, 1, (y > 0).astype(int)
    rows = [(i, f"s{i % 3}", "".join(rng.choice(list("ACGT"), K)), "".join(map(str, b)), datetime(2024, 1, 1), None) for i, b in enumerate(x)]
    again = [(*r[:4], datetime(2024, 1, 2), None) for r in rows[:10]]
    bad = [(100, "s0", "ACG", "0" * N, None, None), (101, "s0", None, "0" * N, None, None), (102, "s0", "ACGTA", None, None, None), (103, "s0", "ACGTA", "01", None, None), (104, "s0", "ACGTA", "x" * N, None, None)]
    samples = spark.createDataFrame([(i, f"id{i}") for i in range(N)], "ord int, sample_id string")
    ph = [(j + 1, f"id{i}", float(y[i])) for j, i in enumerate(rng.permutation(N)) if i not in (4, 17)]
    ph += [(90, "id3", None), (91, "id3", float("nan")), (92, "unknown", 1.0), (93, None, 1.0)]
    phenotype = spark.createDataFrame(ph, "line_no int, sample_id string, y double")
    keep = [i for i in range(N) if i not in (4, 17)]
    return spark.createDataFrame(rows + again + bad, ROWS), samples, phenotype, x[:, keep].astype(float), y[keep], keep


def dense(x, y, u, n):
    m = np.eye(n) - u @ u.T
    xm, ym = m @ x, m @ y
    xx, xy, yy = xm @ xm, xm @ ym, ym @ ym
    if xx <= 1e-12 or yy <= 1e-12:
        return 0.0, 0.0, 1.0
    r2 = min(xy * xy / (xx * yy), 1 - 1e-15)
    t = n * math.log(1 / (1 - r2))
    return xy / (xx * yy), t, math.erfc(math.sqrt(t / 2))


def test_design_follows_the_sample_axis(spark, data):
    _, samples, phenotype, _, y, keep = data
    d = features.design(samples.orderBy("sample_id"), phenotype)
    assert d.ords.tolist() == keep and np.allclose(d.y, y) and d.sample_ids[0] == "id0"


@pytest.mark.parametrize("rank", [1, 4])
def test_scan_against_dense_projection(spark, data, rank):
    rows, samples, phenotype, x, y, keep = data
    n = len(keep)
    rng = np.random.default_rng(1)
    u = np.linalg.qr(np.hstack([np.ones((n, 1)), rng.normal(size=(n, rank - 1))]))[0]
    d = features.design(samples, phenotype, basis={f"id{i}": u[j].tolist() for j, i in enumerate(keep)})
    got = {r.row_id: r for r in scan1d.scan(features.valid_rows(rows, K, N), d, 0.0, 0.0).collect()}
    assert 0 not in got and 1 not in got and len(got) == 58
    for i, r in got.items():
        effect, t, p = dense(x[i], y, u, n)
        assert r.effect == pytest.approx(effect, rel=1e-9, abs=1e-12) and r.t == pytest.approx(t, rel=1e-9, abs=1e-9) and r.p == pytest.approx(p, rel=1e-8)
        assert r.r == pytest.approx(np.corrcoef(x[i], y)[0, 1], abs=1e-9)


def test_prefilter_threshold_counts_and_partitions(spark, data):
    rows, samples, phenotype, x, y, _ = data
    d = features.design(samples, phenotype)
    valid = features.valid_rows(rows, K, N)
    want = {i for i in range(2, 60) if abs(np.corrcoef(x[i], y)[0, 1]) >= 0.2}
    counts = {r.shard: r.tested for r in scan1d.tested_counts(valid.repartition(7), d).collect()}
    assert counts == {s: sum(1 for i in want if f"s{i % 3}" == s) for s in {f"s{i % 3}" for i in want}}
    hits = {r.row_id for r in scan1d.scan(valid.coalesce(1), d, 0.2, 1.0).collect()}
    u = np.ones((d.n, 1)) / math.sqrt(d.n)
    assert hits == {i for i in want if dense(x[i], y, u, d.n)[2] <= 0.1} and 2 in hits


def test_empty_inputs(spark, data):
    rows, samples, phenotype, *_ = data
    d = features.design(samples, phenotype)
    assert scan1d.scan(rows.limit(0), d).count() == 0
    none = features.design(samples, phenotype.limit(0))
    assert none.n == 0 and scan1d.scan(features.valid_rows(rows, K, N), none, 0.0, 0.0).count() == 0


def test_frequencies_bits_and_presence(spark, data):
    rows, samples, phenotype, x, _, _ = data
    d = features.design(samples, phenotype)
    once = features.unique_rows(rows, K, N)
    assert once.count() == 60
    for r in features.allele_frequencies(once, d).collect():
        assert r.ones == x[r.row_id].sum() and r.freq == pytest.approx(x[r.row_id].mean())
    kept = {r.row_id for r in features.maf_filter(once, d, 30).collect()}
    assert kept == {i for i in range(60) if min(x[i].mean(), 1 - x[i].mean()) >= 0.3}
    back = {r.row_id: r.bit for r in features.bit_strings(features.presence(once), N).collect()}
    assert back == {r.row_id: r.bit for r in once.collect() if "1" in r.bit}


def test_samples_are_deterministic_and_bounded(spark, data):
    once = features.unique_rows(data[0], K, N)
    a = {r.row_id for r in features.subsample(once, 7).collect()}
    assert len(a) == 7 and a == {r.row_id for r in features.subsample(once.repartition(5), 7).collect()}
    by_shard = features.shard_samples(once, 10).groupBy("shard").count().collect()
    assert {r["count"] for r in by_shard} == {4}
    assert features.subsample(once, 1000).count() == 60


def test_gram_components_and_bases(spark, data):
    rows, samples, phenotype, x, _, keep = data
    d = features.design(samples, phenotype)
    once = features.unique_rows(rows, K, N)
    g = structure.gram_matrix(once.repartition(5), d.ords)
    assert np.array_equal(g, x.T @ x)
    c = x - x.mean(1, keepdims=True)
    assert np.allclose(structure.centred(g), c.T @ c)
    s = structure.component_scores(g, 3, zscore=False)
    top = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(s @ s.T, (top[2][:3].T * top[1][:3] ** 2) @ top[2][:3])
    z = structure.component_scores(g, 3)
    assert np.allclose(z.std(0, ddof=1), 1)
    assert structure.pair_products(z).shape[1] == 6
    u, u2 = structure.covariate_bases(once, d, 3)
    assert u.shape[1] == 4 and np.allclose(u.T @ u, np.eye(4)) and np.allclose(u2.T @ u2, np.eye(u2.shape[1]))
    assert structure.orthonormal(np.ones((5, 3))).shape[1] == 1
    with pytest.raises(ValueError):
        structure.component_scores(g, 0)


@pytest.mark.parametrize("block", [4, 1000])
def test_pair_scan_against_three_loops(spark, data, block):
    rows, samples, phenotype, x, y, keep = data
    d = features.design(samples, phenotype)
    once = features.unique_rows(rows, K, N)
    got = {(r.idx_a, r.idx_b): r for r in pairs2d.scan_pairs(once.selectExpr("row_id as idx", "bit", "1 as block"), d, 1.0, block).collect()}
    u = np.ones((d.n, 1)) / math.sqrt(d.n)
    want = {}
    for a in range(60):
        for b in range(a + 1, 60):
            z = x[a] * x[b]
            if all(v.sum() - (u.T @ v @ (u.T @ v)) > 1e-12 for v in (x[a], x[b], z)) and z.sum() > 0:
                effect, t, p = dense(z, y, u, d.n)
                if p <= 0.1:
                    want[a, b] = effect, p
    assert set(got) == set(want)
    assert all(got[k].effect == pytest.approx(want[k][0]) and got[k].p == pytest.approx(want[k][1], rel=1e-8) for k in want)
    assert pairs2d.scan_pairs(once.selectExpr("row_id as idx", "bit").limit(0), d, 1.0).count() == 0


def test_pattern_classes_and_dictionary(spark, data):
    rows, samples, phenotype, x, *_ = data
    once = features.unique_rows(rows, K, N)
    d = features.design(samples, phenotype)
    reps = {r.idx: r.rep for r in pairs2d.pattern_classes(once.selectExpr("row_id as idx", "bit"), d).collect()}
    assert reps == {i: min(j for j in range(60) if np.array_equal(x[i], x[j])) for i in range(60)}
    named = pairs2d.renumbered(once, K).orderBy("idx").collect()
    assert [r.idx for r in named] == list(range(len(named))) and [r.kmer for r in named] == sorted(r.kmer for r in named)


@pytest.mark.parametrize("block", [4, 1000])
def test_class_pairs_stand_for_all_pairs(spark, data, block):
    rows, samples, phenotype, x, *_ = data
    d = features.design(samples, phenotype)
    once = features.unique_rows(rows, K, N).selectExpr("row_id as idx", "bit")
    twice = once.unionByName(once.filter("idx % 3 = 0").selectExpr("idx + 1000 as idx", "bit"))
    want = {(r.idx_a, r.idx_b): r.t for r in pairs2d.scan_pairs(twice, d, 1.0).collect()}
    found, classes = pairs2d.scan_class_pairs(twice, d, 1.0, block)
    told = {(r.rep_a, r.rep_b): r.t for r in found.collect()}
    rep = {r.idx: r.rep for r in classes.collect()}
    got = {(a, b): told[key] for a in rep for b in rep if a < b and (key := (min(rep[a], rep[b]), max(rep[a], rep[b]))) in told}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    both = {(r.idx_a, r.idx_b): r.both for r in pairs2d.co_occurrence(once, d, 3, block).collect()}
    counts = (x @ x.T).astype(int)
    assert both == {(a, b): counts[a, b] for a in range(60) for b in range(a + 1, 60) if counts[a, b] >= 3}


@pytest.mark.parametrize("bound", [0, 1000])
def test_latest_rows_both_ways(spark, bound):
    when = [datetime(2024, 1, 1 + i) for i in range(3)]
    rows = [(1, "a", when[0]), (1, "b", when[2]), (1, "c", when[1]), (None, "d", when[0]), (None, "e", when[1]), (2, None, None), (3, "f", when[0]), (3, "f", when[0])]
    df = spark.createDataFrame(rows, "id int, v string, at timestamp").withColumn("_c", features.F.lit(1))
    got = features.latest_rows(df.filter("v <> 'b' or v is null"), ["id"], "at", ["v"], df, bound)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(["(1, 'c')", "(None, 'e')", "(2, None)", "(3, 'f')"])
    assert features.latest_rows(df.limit(0), ["id"], "at", ["v"], max_repeated=bound).count() == 0


def test_bit_strings_keep_rows_of_zeros(spark):
    rng = np.random.default_rng(0)
    for n in (1, 59, 60, 61, 130):
        bits = {i: "".join(map(str, (rng.random(n) < 0.5).astype(int))) for i in range(20)} | {20: "0" * n, 21: "1" * n}
        df = spark.createDataFrame(list(bits.items()), "row_id bigint, bit string")
        back = {r.row_id: r.bit for r in features.bit_strings(features.presence(df), n, df).collect()}
        assert back == bits
        assert 20 not in {r.row_id for r in features.bit_strings(features.presence(df), n).collect()}


@pytest.mark.parametrize("parts", [1, 16, 1 << 16])
def test_quotas_of_a_hot_shard(spark, parts):
    rows = [(i, "hot" if i % 3 else f"s{i % 4}" if i % 2 else None, "ACGTA", "01") for i in range(900)]
    df = spark.createDataFrame(rows, "row_id bigint, shard string, kmer string, bit string")
    drawn = df.withColumn("draw", features._draw(7, ["row_id", "kmer", "bit"])).collect()
    want = set()
    for shard in {r.shard for r in drawn}:
        want |= {r.row_id for r in sorted((r for r in drawn if r.shard == shard), key=lambda r: (r.draw, r.row_id))[:250]}
    assert {r.row_id for r in features.smallest_draws(df, "shard", 250, 7, parts=parts).collect()} == want
    assert features.smallest_draws(df, None, 50, 7, parts=parts).count() == 50
    assert features.smallest_draws(df.limit(0), "shard", 5).count() == 0


def test_sorted_places(spark, data):
    once = features.unique_rows(data[0], K, N)
    got = features.sorted_places(once, 2).orderBy("place").collect()
    assert [r.place for r in got] == list(range(60)) and [(r.batch, r.bit, r.kmer, r.row_id) for r in got] == sorted((r.batch, r.bit, r.kmer, r.row_id) for r in got)


def test_sample_statistics(spark, data):
    once = features.unique_rows(data[0], K, N)
    got = {r.shard: (r.seen, r.kept) for r in features.sample_statistics(once, 10).collect()}
    assert got == {"s0": (20, 4), "s1": (20, 4), "s2": (20, 4)}
    assert features.sample_statistics(once.limit(0), 10).count() == 0
