import pytest
from pyspark.sql import functions as F

from opinara.functions import sql, stats
from opinara.functions.text import text_hash


def test_sql_names_equal_the_columns(spark):
    sql.register(spark)
    df = spark.createDataFrame([(68.0, 135.0, 20.0, 80.0, "Good, app!"), (24.0, 24.0, 1.0, 9.0, " नमस्ते! x  "), (0.0, 0.0, 0.0, 1.0, "")], "x double, n double, y double, m double, t string")
    low, high = stats.wilson(F.col("x"), F.col("n"))
    z, p = stats.two_proportion_z(F.col("x"), F.col("n"), F.col("y"), F.col("m"))
    for a, b in zip(df.select(low, high, z, p, text_hash(F.col("t"))).collect(), df.selectExpr("wilson_low(x, n)", "wilson_high(x, n)", "two_prop_z(x, n, y, m)", "normal_p(two_prop_z(x, n, y, m))", "text_hash(t)").collect(), strict=True):
        assert tuple(a)[:4] == pytest.approx(tuple(b)[:4]) and a[4] == b[4]
    assert spark.sql("SELECT nfc('é')").first()[0] == "é"
