import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import exact_medians, listed_subset
from tallyframe.operators.medians import value_bucket


def middle(values):
    """The rule: middle value, or the mean of the two middle ones in single precision."""
    ordered = np.sort(np.array(values, dtype=np.float32))
    half = len(ordered) // 2
    if len(ordered) % 2:
        return float(ordered[half])
    return float((ordered[half - 1] + ordered[half]) / np.float32(2))


def run(spark, groups, conditions=None, **options):
    rows = [(code, float(v)) for code, values in groups.items() for v in values]
    data = spark.createDataFrame(rows, "p3000 string, x float")
    out = exact_medians(data, conditions or {"m": "true"}, "x", listed_subset(), **options)
    return {(r["cell"], r["subset"]): r["median"] for r in out.collect()}


@pytest.mark.parametrize("values", [[5], [1, 2], [3, 1, 2], [1, 2, 3, 4], [7, 7, 7], [1, 1, 2, 9, 9, 9]])
def test_small_groups(spark, values):
    assert run(spark, {"AK": values}) == {("m", "AK"): middle(values), ("m", "ALL"): middle(values)}


def test_signs_zero_and_extremes(spark):
    values = [-3.5, -0.0, 0.0, 1e-45, 1e-38, 3.4e38, -3.4e38, 2.5, 2.5, float("inf")]
    for cut in range(1, len(values) + 1):
        assert run(spark, {"AK": values[:cut]})[("m", "AK")] == middle(values[:cut])


def test_random_groups(spark):
    rng = np.random.default_rng(3)
    groups = {}
    for i in range(26 * 8):
        scale = 10.0 ** rng.integers(-3, 6)
        values = np.round(rng.normal(scale, scale, rng.integers(1, 60)), int(rng.integers(0, 4)))
        groups[chr(65 + i // 26) + chr(65 + i % 26)] = values.astype(np.float32)
    got = run(spark, groups)
    for code, values in groups.items():
        assert got[("m", code)] == middle(values), code
    assert got[("m", "ALL")] == middle(np.concatenate(list(groups.values())))


def test_hot_group_and_hot_value(spark):
    data = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "AK").otherwise(F.concat(F.lit("B"), F.col("id") % 7)).alias("p3000"),
        F.when(F.col("id") % 2 == 0, 100.25).otherwise(F.col("id") / 8).cast("float").alias("x"),
    )
    got = {
        (r["cell"], r["subset"]): r["median"]
        for r in exact_medians(data, {"m": "x > 50"}, "x", listed_subset()).collect()
    }
    want = data.where("x > 50").groupBy("p3000").agg(F.expr("percentile(x, 0.5)").cast("float").alias("m"))
    for r in want.collect():
        assert got[("m", r["p3000"])] == r["m"]


def test_conditions_levels_and_unlisted_rows(spark):
    groups = {"AK": [1, 2, 3], "LONG": [100, 200, 300, 400], "": [5]}
    got = run(spark, groups, {"low": "x < 150", "none": "x < 0"})
    assert got == {("low", "AK"): 2.0, ("low", ""): 5.0, ("low", "ALL"): 3.0}
    assert set(run(spark, groups, national=False)) == {("m", "AK"), ("m", "")}
    assert set(run(spark, groups, by_subset=False)) == {("m", "ALL")}


def test_buckets_are_monotone_and_bounded(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.uniform(-1e6, 1e6, 4000), rng.lognormal(0, 20, 4000)]).astype(np.float32)
    frame = spark.createDataFrame([(float(v),) for v in np.sort(values)], "x float")
    buckets = [r[0] for r in frame.select(value_bucket(F.col("x"))).collect()]
    assert buckets == sorted(buckets)
    # every single-precision value of one octave: no bucket holds more than about 8,200
    octave = np.arange(2**13, dtype=np.int64) * 2**10 + np.float32(1).view(np.int32)
    spread = np.array(octave, dtype=np.int32).view(np.float32)
    frame = spark.createDataFrame([(float(v),) for v in spread], "x float")
    fullest = frame.groupBy(value_bucket(F.col("x")).alias("b")).count().agg(F.max("count")).first()[0]
    assert fullest * 2**10 <= 12000
