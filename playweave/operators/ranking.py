"""Ranks, pages, samples and searches."""

from __future__ import annotations

import re
from functools import reduce
from itertools import accumulate
from operator import and_, or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playweave.common import materialize


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """df with its 0-based position in a total order, without bringing all rows into one task.

    Rows are range-partitioned and sorted; only the partitions' row counts reach the driver.
    """
    spread = df.withColumn("_o", F.struct(*order)).repartitionByRange("_o").sortWithinPartitions("_o").drop("_o")
    placed = materialize(spread.withColumn("_p", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranked")
    sizes = sorted((r["_p"], r["count"]) for r in placed.groupBy("_p").count().collect())
    starts = list(zip([p for p, _ in sizes], accumulate([0, *(n for _, n in sizes)]), strict=False))
    # One row a partition: the offsets are joined, not written into the plan.
    offsets = df.sparkSession.createDataFrame(starts, "_p int, _start bigint")
    return placed.join(F.broadcast(offsets), "_p").withColumn(name, (F.col("_n") + F.col("_start")).cast("bigint")).drop("_p", "_n", "_start")


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """Page `number` (from 1) of an ordering, with the number of pages. Positions come from range partitioning, so a deep page costs no more than the first."""
    ranked = global_rank(df, order, "_pos")
    total = ranked.count()
    return ranked.filter((F.col("_pos") >= (number - 1) * size) & (F.col("_pos") < number * size)).withColumn("pagecount", F.lit(-(-total // size)).cast("bigint")).orderBy("_pos").drop("_pos")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark cuts each partition to k rows a group before it shuffles."""
    return df.withColumn("rn", F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(F.col("rn") <= k)


def rotate_sample(df: DataFrame, order: list[Column], offset: int, size: int) -> DataFrame:
    """`size` rows of a cyclic order, beginning at `offset` modulo the number of rows."""
    ranked = global_rank(df, order, "pos")
    n = ranked.count()
    return ranked.withColumn("pos", F.pmod(F.col("pos") - offset, F.lit(max(n, 1))).cast("bigint")).filter(F.col("pos") < size)


#: Fixed value: what separates the words of a title, and what its letters are compared without.
TITLE_MARKS = r"[\s\-_·:：/\\|,，.。()（）\[\]【】!！?？]+"


def match_score(title: Column, query: str) -> Column:
    """How well a title fits a query, the best of: 100 the same, 85 one of its words is the whole query, 65 contains it, 55 has all its words, 40 any of them,
    30 the words' initials contain those of the query, else up to 20 for shared letters; 0 for null."""
    flat = lambda x: F.regexp_replace(F.lower(x), TITLE_MARKS, "")
    low, q = flat(title), re.sub(TITLE_MARKS, "", query.lower())
    words, own = F.filter(F.split(F.lower(title), TITLE_MARKS), lambda x: x != ""), [w for w in re.split(TITLE_MARKS, query.lower()) if w]
    has = [F.array_contains(words, w) for w in own]
    every, some = reduce(and_, has), reduce(or_, has)
    initials, wanted = F.array_join(F.transform(words, lambda x: F.substring(x, 1, 1)), ""), "".join(w[0] for w in own)
    letters = sorted(set(q))
    shared = sum(F.contains(low, F.lit(c)).cast("int") for c in letters)
    overlap = F.when((shared >= max(2, len(letters) * 0.6)) & F.lit(len(q) >= 2), F.least(F.lit(20), shared * 3)).otherwise(0)
    tier = (
        F.when(low == q, 100).when(F.array_contains(words, q) | low.isin(own), 85).when(F.contains(low, F.lit(q)), 65).when(every, 55).when(some, 40)
        .when(F.lit(len(wanted) >= 2) & F.contains(initials, F.lit(wanted)), 30).otherwise(overlap)
    )
    return F.when(title.isNotNull() & (low != ""), tier).otherwise(0)


def search(df: DataFrame, title: str, query: str, k: int = 100) -> DataFrame:
    """The k best titles for a query by match_score, less up to 5 for a different length; ties by title. An empty query finds nothing."""
    if not re.sub(TITLE_MARKS, "", query):
        return df.withColumn("score", F.lit(0)).limit(0)
    tier = match_score(F.col(title), query)
    scored = df.withColumn("score", (tier - F.least(F.lit(5), F.floor(F.abs(F.length(F.trim(title)) - len(query.strip())) / 10))).cast("int")).filter(tier > 0)
    return scored.orderBy(F.desc("score"), title, *[c for c in df.columns if c != title][:1]).limit(k)


def nearest_template(vectors: DataFrame, templates: DataFrame, least: float | None = None, most: int = 50_000_000) -> DataFrame:
    """Best template of each vector by mean dot product (ties: the smaller id). The templates are one broadcast matrix of at most `most` numbers; nothing is shuffled."""
    held, ids, size = [], [], 0
    for r in templates.select("vec_id", "embedding").orderBy("vec_id").toLocalIterator():
        size += len(r[1])
        if size > most:
            raise ValueError(f"templates of more than {most} numbers")
        ids.append(r[0])
        held.append(r[1])
    matrix = vectors.sparkSession.sparkContext.broadcast(np.array(held, dtype=np.float64))
    schema = "vec_id bigint, template bigint, score double"

    def run(batches):
        for b in batches:
            v = np.stack(b["embedding"].to_numpy()).astype(np.float64)
            scores = v @ matrix.value.T
            best = scores.round(9).argmax(axis=1)
            yield pd.DataFrame({"vec_id": b["vec_id"], "template": [ids[i] for i in best], "score": scores[np.arange(len(v)), best] / v.shape[1]})

    out = vectors.select("vec_id", "embedding").filter("embedding IS NOT NULL").mapInPandas(run, schema) if ids else vectors.sparkSession.createDataFrame([], schema)
    return out if least is None else out.filter(F.col("score") >= least)
