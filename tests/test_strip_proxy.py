"""Addresses behind a proxy prefix stay whole, however long."""

from pyspark.sql import functions as F

from playweave.functions import urls


def test_long_address(spark):
    rows = spark.range(1).select(F.concat(F.lit("https://m/https://a/"), F.repeat(F.lit("x"), 1 << 20)).alias("u"))
    assert rows.select(F.length(urls.strip_proxy(F.col("u"), ["https://m/"]))).collect()[0][0] == (1 << 20) + 10
