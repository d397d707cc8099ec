"""Values carried along an order within each key, without bringing a key's rows into one task.

Rows are range-partitioned by (key, order), so that a key with a third of all rows fills many partitions. What has to cross from one partition to the next is
one row for each key that goes on there, at most one a partition: it is summarised, carried over and joined back by broadcast. Within a partition plain windows do the rest.

The order must be total within a key (end it in a unique column); of equal rows any may come first. Null keys form a group of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playweave.common import materialize


class Ordered:
    """A table laid out by (key, order): `rows` with the number of the partition in _p, and windows over the rows of a key in a partition."""

    def __init__(self, df: DataFrame, key: str, order: list[str], partitions: int | None = None):
        self.key, self.columns = key, df.columns
        spread = df.select(F.struct(*order).alias("_o"), *df.columns).repartitionByRange(*([partitions] if partitions else []), F.col(key).asc_nulls_first(), "_o")
        self.rows = materialize(spread.withColumn("_p", F.spark_partition_id()), "ordered")
        self.inside = W.partitionBy(key, "_p").orderBy("_o")
        self.upto = self.inside.rowsBetween(W.unboundedPreceding, 0)

    def _crossing(self, *facts: Column) -> DataFrame:
        """(key, _p, facts) of the keys that have rows in more than one partition: at most two rows a partition."""
        each = self.rows.groupBy(self.key, "_p").agg(*facts)
        many = each.groupBy(F.col(self.key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_k")
        return each.join(F.broadcast(many), F.col(self.key).eqNullSafe(F.col("_k")), "left_semi")

    def _carried(self, rows: DataFrame, facts: DataFrame, name: str) -> DataFrame:
        """rows with the fact of their key and partition, null for keys of one partition."""
        f = facts.select(F.col(self.key).alias("_k"), F.col("_p").alias("_q"), name)
        return rows.join(F.broadcast(f), F.col(self.key).eqNullSafe(F.col("_k")) & (F.col("_p") == F.col("_q")), "left").drop("_k", "_q")

    def last_value(self, value: Column, name: str, rows: DataFrame | None = None) -> DataFrame:
        """rows with the last value that is not null, up to and with each row."""
        rows = (self.rows if rows is None else rows).withColumn("_v", value)
        each = rows.groupBy(self.key, "_p").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_o"))).alias("_last"))
        many = self._crossing(F.lit(1).alias("_one")).select(F.col(self.key).alias("_k"), F.col("_p").alias("_q"))
        own = each.join(F.broadcast(many), F.col(self.key).eqNullSafe(F.col("_k")) & (F.col("_p") == F.col("_q")), "left_semi")
        before = own.withColumn("_before", F.last("_last", ignorenulls=True).over(W.partitionBy(self.key).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)))
        out = self._carried(rows, before, "_before")
        return out.withColumn(name, F.coalesce(F.last("_v", ignorenulls=True).over(self.upto), F.col("_before"))).drop("_v", "_before")

    def running_sum(self, value: Column, name: str) -> DataFrame:
        """rows with the sum of a number up to and with each row; null counts as nothing."""
        v = F.coalesce(value.cast("bigint"), F.lit(0))
        totals = self._crossing(F.sum(v).alias("_total"))
        before = totals.withColumn("_before", F.sum("_total").over(W.partitionBy(self.key).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)))
        out = self._carried(self.rows, before, "_before")
        return out.withColumn(name, F.sum(v).over(self.upto) + F.coalesce("_before", F.lit(0))).drop("_before")

    def neighbour(self, values: dict[str, Column], after: bool = False) -> DataFrame:
        """rows with values of the row before each in its key, or after it; null at the ends."""
        pack = F.struct(*(c.alias(k) for k, c in values.items()))
        edge = F.min_by(pack, "_o") if after else F.max_by(pack, "_o")
        edges = self._crossing(edge.alias("_edge"))
        w = W.partitionBy(self.key).orderBy("_p")
        edges = edges.withColumn("_next", (F.lead("_edge") if after else F.lag("_edge")).over(w))
        out = self._carried(self.rows.withColumn("_v", pack), edges, "_next")
        own = (F.lead("_v") if after else F.lag("_v")).over(self.inside)
        found = out.withColumn("_f", F.coalesce(own, F.col("_next")))
        return found.select(*self.columns, *(F.col(f"_f.{k}").alias(k) for k in values))

    def plain(self, df: DataFrame, *names: str) -> DataFrame:
        """The table's own columns and some new ones."""
        return df.select(*self.columns, *names)


def forward_fill(df: DataFrame, key: str, order: list[str], value: Column, name: str, partitions: int | None = None) -> DataFrame:
    """df with the last value of its key that is not null, up to and with each row."""
    o = Ordered(df, key, order, partitions)
    return o.plain(o.last_value(value, name), name)


def streaks(df: DataFrame, key: str, order: list[str], counts: Column, resets: Column, name: str = "streak", partitions: int | None = None) -> DataFrame:
    """df with the number of rows that count since the last that resets, in the order of each key: the running count, less what it was at the last reset before."""
    o = Ordered(df.withColumns({"_counts": counts, "_resets": resets}), key, order, partitions)
    o.columns = [c for c in o.columns if c not in ("_counts", "_resets")]
    running = o.running_sum(F.col("_counts").cast("int"), "_sum")
    # A row that resets counts itself after it has reset.
    at_reset = F.when(F.col("_resets"), F.col("_sum") - F.col("_counts").cast("int"))
    return o.plain(o.last_value(at_reset, "_base", running).withColumn(name, (F.col("_sum") - F.coalesce("_base", F.lit(0))).cast("bigint")), name)
