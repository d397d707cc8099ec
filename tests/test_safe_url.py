"""Safe addresses over every row, also those with line feeds."""

from pyspark.sql import functions as F

from playweave.functions import urls
from playweave.plans import catalog


def test_line_feeds(spark, tmp_path):
    given = {1: "http://u:p@h/a?id=1&token=zz\r\n", 2: "\nhttp://u:p@h/a#f\n", 3: None, 4: "http://h/a?id=1"}
    spark.createDataFrame(list(given.items()), "row_id bigint, url string").write.parquet(f"{tmp_path}/channels.parquet")
    out = {r["row_id"]: r["url"] for r in catalog.QUERIES["safe_url"](spark, str(tmp_path)).collect()}
    assert out == {1: "http://h/a?id=1", 2: "http://h/a", 3: None, 4: "http://h/a?id=1"}
    inner = spark.createDataFrame([("http://h/a?x=1\n2&token=a\nb#f\ng",)], "x string")
    assert inner.select(urls.safe(F.col("x"))).collect()[0][0] == "http://h/a?x=1\n2"
