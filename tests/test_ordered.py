"""Values carried along an order against plain windows, with one key holding most rows, so that it spans partitions."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playweave.operators import health, ordered


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = [(i, "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None, "c", ""]), rng.randrange(50), rng.choice([None, None, None, rng.randrange(9)]), rng.choice(["dec", "ok", "x", None])) for i in range(3000)]
    return spark.createDataFrame(data, "id int, k string, t int, v int, s string").repartition(7)


def same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_equal_to_windows(rows):
    w = W.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    o = ordered.Ordered(rows, "k", ["t", "id"], 6)
    assert o.rows.filter("k = 'hot'").select("_p").distinct().count() > 1
    assert same(ordered.forward_fill(rows, "k", ["t", "id"], F.col("v"), "f", 6), rows.withColumn("f", F.last("v", ignorenulls=True).over(upto)))
    assert same(o.plain(o.running_sum(F.col("v"), "r"), "r"), rows.withColumn("r", F.sum(F.coalesce("v", F.lit(0))).over(upto)))
    assert same(o.neighbour({"n": F.col("id"), "m": F.col("v")}), rows.withColumns({"n": F.lag("id").over(w), "m": F.lag("v").over(w)}))
    assert same(o.neighbour({"n": F.col("id")}, after=True), rows.withColumn("n", F.lead("id").over(w)))


def test_streaks(rows):
    dec, ok = F.coalesce(F.col("s") == "dec", F.lit(False)), F.coalesce(F.col("s") == "ok", F.lit(False))
    got = {r["id"]: r["streak"] for r in ordered.streaks(rows, "k", ["t", "id"], dec, ok, partitions=6).collect()}
    state: dict = {}
    for r in sorted(rows.collect(), key=lambda r: (r["t"], r["id"])):
        state[r["k"]] = 0 if r["s"] == "ok" else state.get(r["k"], 0) + (r["s"] == "dec")
        assert got[r["id"]] == state[r["k"]]
    assert health.streak_fold(rows.limit(0), "k", ["t", "id"], dec, ok).count() == 0
