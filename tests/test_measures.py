"""Money that no decimal holds shows in totals and means instead of vanishing."""

import math

from basketry.functions import measures as M


def test_values_beyond_decimals(spark):
    rows = [("nan", 5.0), ("nan", math.nan), ("inf", 5.0), ("inf", math.inf), ("huge", 1e20), ("huge", 1.0),
            ("plain", 0.1), ("plain", 0.2), ("plain", None), ("none", None)]
    frame = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in frame.groupBy("k").agg(
        M.total("v").alias("t"), M.mean("v", 2).alias("m"), M.ratio_of_sums("v", "v", 2).alias("r")).collect()}
    assert math.isnan(got["nan"].t) and math.isnan(got["nan"].m) and math.isnan(got["nan"].r)
    assert got["inf"].t == math.inf == got["inf"].m
    assert got["huge"].t == 1e20 and got["huge"].m == 5e19 and got["huge"].r == 1.0
    assert (got["plain"].t, got["plain"].m, got["plain"].r) == (0.3, 0.15, 1.0)
    assert got["none"].t is None and got["none"].m is None
