from pyspark.sql import functions as F

from tessera.functions.normalize import category_clean, is_finite, species_key, to_double


def one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_to_double_guards(spark):
    vals = ["1", "1.5", " 2 ", "1d", "1F", "inf", "-Infinity", "NaN", "abc", None, "1e3", "1993.0"]
    out = one(spark, vals, to_double)
    assert out[0] == 1.0 and out[1] == 1.5 and out[2] == 2.0
    assert out[3] is None and out[4] is None          # trailing d/f rejected (DuckDB parity)
    assert out[5] == float("inf") and out[6] == float("-inf")
    assert out[7] != out[7]                           # NaN parses
    assert out[8] is None and out[9] is None
    assert out[10] == 1000.0 and out[11] == 1993.0


def test_is_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(is_finite("x")).collect()] == [True, False, False, None]


def test_species_key_and_category(spark):
    assert one(spark, ["  Gadus Morhua ", None], species_key) == ["gadus morhua", None]
    assert one(spark, ["NA", "", None, "na", " NA", "male"], category_clean) == [None, None, None, "na", " NA", "male"]
