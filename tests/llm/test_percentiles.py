import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest

from bitloom.llm import percentiles as p
from bitloom.llm import queries

PAIRS = "trait string, idx_a bigint, idx_b bigint, effect double, pval double, run_day date, written_at timestamp, value string, n int"
PCTS = [1, 5, 25, 50, 75, 95, 99]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for trait, n in (("big", 4000), ("mid", 300), ("two", 2), ("one", 1), (None, 40), ("bad", 5)):
        for i in range(n):
            e = rng.choice([rng.gauss(0, 1), 0.0, -0.0, float("nan"), None, float("inf"), float("-inf")]) if trait != "bad" else float("nan")
            v = rng.choice([0.0, 0.0, 0.0, rng.random() ** 4]) if trait != "bad" else None
            out.append((trait, i, i + 1, e, v, date(2024, 3, 1) + timedelta(days=rng.randrange(10)), datetime(2024, 3, 1), "clash", 0))
    again = [(*r[:6], datetime(2024, 3, 9), "clash", 0) for r in rng.sample(out, 500)]
    changed = [("mid", 0, 1, 123.0, 0.5, out[4000][5], datetime(2024, 3, 20), "clash", 0)]
    return out + again + changed


def latest(rows):
    last = {}
    for r in rows:
        key = r[:3]
        if key not in last or last[key][6] < r[6]:
            last[key] = r
    return last.values()


def values(rows, trait, which, days=None):
    got = [r[3 + which] for r in latest(rows) if r[0] == trait and (days is None or r[5] in days)]
    return np.array([v for v in got if v is not None and np.isfinite(v)])


def test_exact(spark, rows):
    got = {(r.trait, r.measure, r.pct): (r.n, r.value) for r in p.trait_percentiles(spark.createDataFrame(rows, PAIRS).repartition(5)).collect()}
    want = {}
    for t in ("big", "mid", "two", "one", None, "bad"):
        for m, name in enumerate(("effect", "pval")):
            v = values(rows, t, m)
            want |= {(t, name, float(q)): (len(v), np.percentile(v, q)) for q in PCTS if len(v)}
    assert set(got) == set(want)
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-12) for k in want)


@pytest.mark.parametrize("span", [(None, None), ("2024-03-03", "2024-03-05"), ("2024-03-04", "2024-03-04")])
def test_spans_are_within_half_a_per_cent(spark, rows, span):
    kept = p.day_summaries(spark.createDataFrame(rows, PAIRS))
    days = [date(2024, 3, 1) + timedelta(days=i) for i in range(10)]
    days = [d for d in days if (span[0] is None or d.isoformat() >= span[0]) and (span[1] is None or d.isoformat() <= span[1])]
    got = {(r.trait, r.measure, r.pct): r for r in p.span_percentiles(kept, *span).collect()}
    for t in ("big", "mid", "two", "one", None):
        for m, name in enumerate(("effect", "pval")):
            v = np.sort(values(rows, t, m, days))
            for q in PCTS if len(v) else []:
                r = got[t, name, float(q)]
                assert r.n == len(v)
                low, high = np.searchsorted(v, r.value, "left"), np.searchsorted(v, r.value, "right") - 1
                at = q / 100 * (len(v) - 1)
                assert low - max(1, 0.005 * len(v)) <= at <= high + max(1, 0.005 * len(v))


def test_summaries_are_small_and_weigh_all(spark):
    rows = [("t", i, i + 1, float(i), 0.5, date(2024, 3, 1), datetime(2024, 3, 1), "", 0) for i in range(5000)]
    kept = p.day_summaries(spark.createDataFrame(rows, PAIRS), points=100).collect()
    for m in ("effect", "pval"):
        mine = [r for r in kept if r.measure == m]
        assert len(mine) == 100 and sum(r.weight for r in mine) == 5000


def test_empty(spark, rows):
    none = spark.createDataFrame(rows, PAIRS).limit(0)
    assert p.trait_percentiles(none).count() == 0 and p.span_percentiles(p.day_summaries(none)).count() == 0


@pytest.mark.parametrize(("days", "used"), [(45, range(10, 35)), (21, [10]), (7, [3])])
def test_the_span_follows_the_days_of_the_data(spark, tmp_path, days, used):
    rows = [("t", i, i + 1, float(i), 0.5, date(2031, 1, 1) + timedelta(days=i // 10), datetime(2031, 1, 1), "", 0) for i in range(10 * days)]
    spark.createDataFrame(rows, PAIRS).write.parquet(str(tmp_path / "pairs.parquet"))
    got = {(r.measure, r.pct): r for r in queries.p5_span(spark, str(tmp_path)).collect()}
    assert {r.n for r in got.values()} == {10 * len(used)}
    assert 10 * used[0] <= got["effect", 1.0].value <= got["effect", 99.0].value < 10 * (used[-1] + 1)
