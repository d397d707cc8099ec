"""Keyed de-duplication by aggregates with map-side combination: no key ever gathers its rows in one task.

Order is always explicit (a column, ties by the whole row's struct); null keys form one group like any other value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[Column], order: list[Column], last: bool = False) -> DataFrame:
    """One whole row per key: the first by order, or the last."""
    pick = F.max if last else F.min
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    rows = df.select(F.struct(*order).alias("_o"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_r"), *named)
    by = F.max_by if last else F.min_by
    return rows.groupBy(*(f"_k{i}" for i in range(len(keys)))).agg(by("_r", "_o").alias("_r"), pick("_o").alias("_o")).select("_r.*")


def coalesce_fields(df: DataFrame, key: str, fields: list[str], order: str, empty: list[str] | None = None) -> DataFrame:
    """One row per key; every field takes its first value by order that is neither null nor empty."""
    gone = ["", *(empty or [])]
    full = lambda c: F.when(~F.trim(F.col(c)).isin(gone), F.col(order))
    return df.groupBy(key).agg(F.min(order).alias("first_ord"), *(F.min_by(c, full(c)).alias(c) for c in fields))


def by_content(df: DataFrame, digest: Column, rank: list[Column]) -> DataFrame:
    """One row per digest, the least by rank."""
    return keep_first(df, [digest], rank)
