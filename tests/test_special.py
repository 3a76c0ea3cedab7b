import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitloom.functions import special


def test_erfc_column_and_text_match_math(spark):
    xs = [0.0, 1e-9, 0.1, 0.5, 1.0, 2.0, 3.7, 5.0, 9.0, 15.0, 25.0, 25.99, 26.5, 27.0, 1000.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, a, b in df.select("x", special.erfc(F.col("x")), F.expr(special.erfc_sql("x"))).collect():
        assert a == pytest.approx(math.erfc(x), rel=1e-11, abs=1e-315)
        assert b == pytest.approx(a, rel=1e-13)


def test_erfc_of_null_and_nan(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),)], "x double").select(special.erfc(F.col("x"))).collect()
    assert rows[0][0] is None and math.isnan(rows[1][0])


def _integral(t, k):
    x = np.linspace(t, t + 400, 2_000_001)
    pdf = x ** (k / 2 - 1) * np.exp(-x / 2) / (2 ** (k / 2) * math.gamma(k / 2))
    return float(((pdf[1:] + pdf[:-1]) / 2 * np.diff(x)).sum())


def test_chi_square_tails(spark):
    ts = [0.5, 1.0, 3.0, 7.8, 20.0]
    df = spark.createDataFrame([(t,) for t in ts], "t double")
    for t, one, three in df.select("t", special.chi2_sf1(F.col("t")), special.chi2_sf3(F.col("t"))).collect():
        assert one == pytest.approx(_integral(t, 1), rel=1e-6)
        assert three == pytest.approx(_integral(t, 3), rel=1e-6)
        assert special.chi2_sf(t, 1) == pytest.approx(one, rel=1e-10)
        assert special.chi2_sf(t, 3) == pytest.approx(three, rel=1e-10)
    assert math.isnan(special.chi2_sf(-1, 1)) and math.isnan(special.chi2_sf(1, 0))
    below = spark.createDataFrame([(-1.0,)], "t double").select(special.chi2_sf1(F.col("t")), special.chi2_sf3(F.col("t"))).first()
    assert tuple(below) == (1.0, 1.0)


@pytest.mark.parametrize("level", [1.0, 3.0, 6.0, 15.0, 18.0, 300.0])
def test_cuts_are_where_p_crosses(level):
    t = special.statistic_cut(level)
    assert math.erfc(math.sqrt(t / 2)) <= 10**-level < math.erfc(math.sqrt(t * (1 - 1e-9) / 2))
    assert special.r2_cut(level, 90) == pytest.approx(1 - math.exp(-t / 90))


def test_cuts_beyond_the_smallest_double():
    t = special.statistic_cut(400)
    assert -special.log_erfc(math.sqrt(t / 2)) / math.log(10) == pytest.approx(400)
    assert special.log_erfc(19.9) == pytest.approx(math.log(math.erfc(19.9)), rel=1e-12) and special.log_erfc(24.0) == pytest.approx(math.log(math.erfc(24.0)), rel=1e-12)
