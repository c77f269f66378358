"""Distribution functions against the standard library."""

import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from quillstat.functions.distributions import inverse_normal

P = [1e-300, 1e-30, 1e-12, 1e-11, 1e-5, 0.001, 0.0749, 0.075, 0.0751, 0.3, 0.499999, 0.5, 0.75, 0.925, 0.9251, 0.99, 0.999999]


def test_inverse_normal(spark):
    df = spark.createDataFrame([(p,) for p in P], "p double")
    for row in df.select("p", inverse_normal(F.col("p")).alias("z")).collect():
        assert math.isclose(row["z"], NormalDist().inv_cdf(row["p"]), rel_tol=1e-13, abs_tol=1e-15)


@pytest.mark.parametrize("p", [0.0, 1.0, -0.5, 1.5, None])
def test_outside(spark, p):
    df = spark.createDataFrame([(p,)], "p double")
    assert df.select(inverse_normal(F.col("p"))).first()[0] is None
