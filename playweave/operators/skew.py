"""Joins that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most groups whose facts are broadcast; the largest ones come first, all others take the shuffled join.
MOST_HOT = 10_000


def attach_group_facts(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, hot: int = 200_000, how: str = "inner", most_hot: int = MOST_HOT) -> DataFrame:
    """Join (inner or left) of rows with one facts row per group.

    The facts of groups with more than `hot` rows, at most `most_hot` of them, are broadcast and their rows never move;
    all others take an ordinary shuffled join. Null keys match nothing; they are kept by a left join.
    """
    big = groups.filter(F.col(size) > hot).orderBy(F.desc(size), *keys).limit(most_hot)
    left = rows.join(F.broadcast(big.select(*keys).withColumn("_hot", F.lit(True))), keys, "left")
    warm = left.filter(F.col("_hot").isNull()).drop("_hot").join(groups, keys, how)
    held = rows.join(F.broadcast(big), keys)
    return warm.unionByName(held)


def pairs_within(rows: DataFrame, keys: list[str], size: str, left: list[Column], right: list[Column], block: int = 2000) -> DataFrame:
    """Rows of each group side by side, every ordered pair once, as columns `left` and `right`.

    A group is cut into blocks of about `block` rows by a hash; each block of the left side meets the whole group in a task of its own, so no
    task holds more than block x group pairs at once.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col(size) / block)).cast("int")
    a = rows.select(*keys, F.pmod(F.xxhash64(*left), blocks).cast("int").alias("_block"), *left)
    b = rows.select(*keys, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block"), *right)
    return a.join(b, [*keys, "_block"]).drop("_block")
