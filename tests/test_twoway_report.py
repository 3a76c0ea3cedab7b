import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitloom.operators import report, twoway


@pytest.mark.parametrize("rank", [(0, 0), (2, 1)])
@pytest.mark.parametrize("only", [True, False])
def test_twoway_against_least_squares(spark, rank, only):
    rng = np.random.default_rng(4)
    nh, npat = 9, 7
    y = rng.normal(size=(nh, npat)) + 1
    x, z = (rng.random((5, nh)) < 0.5).astype(int), (rng.random((4, npat)) < 0.5).astype(int)
    x[0], z[0] = 1, 0
    x[1, :2], z[1, :2] = (0, 1), (0, 1)
    many = rng.random((40, nh)).round()
    u = twoway.components(many.T @ many, rank[0], 40)
    v = twoway.components(np.diag(np.arange(1.0, npat + 1)), rank[1], 40)
    assert u.shape[1] == rank[0] and np.allclose(u.sum(0), 0)
    obs = spark.createDataFrame([(h, p, float(y[h, p])) for h in range(nh) for p in range(npat)], "h int, p int, y double").repartition(3)
    grid = twoway.grid(obs, nh, npat, u, v)
    bits = lambda m, t: spark.createDataFrame([(f"{t}{i}", "".join(map(str, r)), "x") for i, r in enumerate(m)] + [("bad", "01", "x"), ("none", None, "x")], "label string, bit string, own string")
    got = {(r.a, r.b): r for r in twoway.scan_twoway(bits(x, "h"), bits(z, "p"), grid, interaction_only=only, block_rows=2).collect()}
    assert len(got) == 20
    null = np.hstack([np.kron(u, np.ones((npat, 1))), np.kron(np.ones((nh, 1)), v), np.kron(u, v)]) if sum(rank) else np.zeros((nh * npat, 0))

    def rss(columns):
        if not columns.shape[1]:
            return float(y.ravel() @ y.ravel())
        return float(((y.ravel() - columns @ np.linalg.lstsq(columns, y.ravel(), rcond=None)[0]) ** 2).sum())

    for (a, b), r in got.items():
        g, h = x[int(a[1:])] - x[int(a[1:])].mean(), z[int(b[1:])] - z[int(b[1:])].mean()
        if not g.any() or not h.any():
            assert (r.p == 0 and math.isinf(r.ratio)) if only else math.isnan(r.p)
            continue
        inter = np.kron(g, h)[:, None]
        extra = inter if only else np.hstack([np.kron(g, np.ones(npat))[:, None], np.kron(np.ones(nh), h)[:, None], inter])
        assert r.ratio == pytest.approx(rss(null) / rss(np.hstack([null, extra])), rel=1e-8)
        assert r.lrt == pytest.approx(nh * npat * math.log(r.ratio), abs=1e-9)
    some = twoway.scan_twoway(bits(x, "h"), bits(z, "p"), grid, interaction_only=only, drop_monomorphic=True)
    assert some.count() == sum(1 for a in x if 0 < a.sum() < nh) * sum(1 for b in z if 0 < b.sum() < npat)


@pytest.mark.parametrize("only", [True, False])
def test_twoway_limit_keeps_what_is_under_it(spark, only):
    rng = np.random.default_rng(6)
    bits = lambda n, m, t: spark.createDataFrame([(f"{t}{i}", "".join(map(str, (rng.random(n) < 0.5).astype(int)))) for i in range(m)] + [(f"{t}flat", "1" * n)], "label string, bit string")
    hosts, paths = bits(8, 12, "h"), bits(6, 9, "p")
    grid = twoway.Grid(rng.normal(size=(8, 6)), np.zeros((8, 0)), np.zeros((6, 0)))
    every = twoway.scan_twoway(hosts, paths, grid, only).collect()
    some = twoway.scan_twoway(hosts, paths, grid, only, log10_p=0.5).collect()
    assert {(r.a, r.b) for r in some} == {(r.a, r.b) for r in every if r.p <= 10**-0.5} and 0 < len(some) < len(every)
    rows = spark.createDataFrame([(1, "01"), (2, "11"), (3, "01")], "label int, bit string")
    assert {r.label: r.rep for r in twoway.members(rows).collect()} == {1: 1, 2: 2, 3: 1}


def test_incomplete_grid(spark):
    with pytest.raises(ValueError):
        twoway.grid(spark.createDataFrame([(0, 0, 1.0), (0, 1, 1.0), (1, 0, 1.0)], "h int, p int, y double"), 2, 2)


def pairs(spark, rows):
    return spark.createDataFrame(rows, "pos_a bigint, pos_b bigint, effect double, p double")


def test_grid_tables(spark):
    rng = np.random.default_rng(0)
    rows = [(int(a), int(b), float(e), float(p)) for a, b, e, p in zip(rng.integers(0, 50, 400), rng.integers(0, 50, 400), rng.normal(size=400).round(1), rng.random(400))]
    df = pairs(spark, rows)
    counts = {}
    for a, b, *_ in rows:
        counts[a // 10, b // 10] = counts.get((a // 10, b // 10), 0) + 1
    assert {(r.cx, r.cy): r.n for r in report.cell_counts(df, 10).collect()} == counts
    cut = np.percentile(list(counts.values()), 80)
    assert {(r.cx, r.cy) for r in report.dense_cells(df, 10, 80).collect()} == {k for k, n in counts.items() if n >= cut}
    peaks = {(r.cx, r.cy): r.log10p for r in report.cell_peaks(df, 10).collect()}
    assert all(peaks[k] == pytest.approx(max(-math.log10(p) for a, b, _, p in rows if (a // 10, b // 10) == k)) for k in counts)
    e = [abs(r[2]) for r in rows]
    for q in (1, 50, 90, 99, 100):
        assert report.effect_cut(df, q).count() == sum(v >= np.percentile(e, q) for v in e)
    assert report.effect_cut(df, 0).count() == 400 and report.effect_cut(df.limit(0), 50).count() == 0


def test_points_sizes_thresholds(spark):
    df = spark.createDataFrame([(1, -0.5, 0.0), (2, 0.5, 0.01), (3, 0.0, 1.0), (4, None, 0.1), (5, 1.0, float("nan")), (None, 1.0, 0.1)], "pos bigint, effect double, p double")
    got = {r.pos: (r.sign, r.log10p) for r in report.manhattan_points(df, 1, 3).collect()}
    assert got == {1: (-1.0, 300.0), 2: (1.0, pytest.approx(2.0)), 3: (0.0, 0.0)}
    assert report.under(df, 0.01).count() == 1
    counts = spark.createDataFrame([("a", 3), ("b", 2)], "shard string, tested bigint")
    assert report.bonferroni(counts).first().threshold == pytest.approx(-math.log10(0.01))
    assert report.bonferroni(counts.limit(0)).first().threshold is None
    assert {r.shard: r.tested for r in report.merged_counts([counts, counts]).collect()} == {"a": 6, "b": 4}
    sizes = [r.size for r in report.marker_sizes(counts, "tested").orderBy("tested").collect()]
    assert sizes == [2.5, 8.0]
    assert {r.size for r in report.marker_sizes(counts.withColumn("tested", F.lit(1)), "tested").collect()} == {2.5}


def test_header_lengths(spark):
    df = spark.createDataFrame([(1, "NODE_1_length_438_cov_2"), (1, "NODE_1_length_438_cov_2"), (2, "Chr2"), (3, None), (None, "x_length_5")], "contig_idx bigint, name string")
    assert [tuple(r) for r in report.header_lengths(df).collect()] == [(1, "NODE_1_length_438_cov_2", 438)]
