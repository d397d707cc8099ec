"""Run-over-run state as streams: failure streaks by key, late-tolerant counts by window, and a table that is brought up to date."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from playweave.operators.health import STREAK_LIMIT

OUTPUT = "key string, streak bigint, removable boolean, history array<string>"
STATE = "streak bigint, history array<string>"


def fold(outcomes: pd.Series, streak: int, past: list[str], keep: int = 3) -> tuple[int, list[str]]:
    """Streak and last outcomes after a run of ordered outcomes: counted from the last `ok` of the run, or on from the streak before it."""
    resets = outcomes.eq("ok").to_numpy().nonzero()[0]
    after = outcomes.iloc[resets[-1] + 1 :] if len(resets) else outcomes
    return (0 if len(resets) else streak) + int(after.eq("decisive").sum()), (past + outcomes.tail(keep).tolist())[-keep:]


def streaks(checks: DataFrame, limit: int = STREAK_LIMIT, forget_after_ms: int | None = None) -> DataFrame:
    """Streaming fold over (key, at, outcome): `decisive` adds one, `ok` resets, anything else keeps; the last three outcomes stay in the state.

    Null keys are dropped. Within a batch the order is (at, outcome); one row per key and batch comes out. With forget_after_ms, keys that have not been
    seen for that long (processing time) leave the state and come out once more with a null streak.
    """

    def run(key, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"key": [key[0]], "streak": pd.array([None], dtype="Int64"), "removable": [False], "history": [[]]})
            return
        streak, past = state.get if state.exists else (0, [])
        rows = pd.concat(list(pdfs)).sort_values(["at", "outcome"])
        streak, past = fold(rows["outcome"], streak, list(past))
        state.update((streak, past))
        if forget_after_ms:
            state.setTimeoutDuration(forget_after_ms)
        yield pd.DataFrame({"key": [key[0]], "streak": [streak], "removable": [streak >= limit], "history": [past]})

    rows = checks.filter("key IS NOT NULL").select("key", "at", "outcome")
    return rows.groupBy("key").applyInPandasWithState(run, OUTPUT, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout if forget_after_ms else GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, at: str, by: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by tumbling window and key; rows later than the watermark are left out."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count(F.lit(1)).alias("n"))


def _versions(spark, path: str) -> dict[int, list[int]]:
    """Bucket -> its versions, of a table in path/bucket=b/v=epoch."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[int, list[int]] = {}
    for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "bucket=*/v=*")) or []:
        found.setdefault(int(s.getPath().getParent().getName()[7:]), []).append(int(s.getPath().getName()[2:]))
    return found


def _drop(spark, path: str, bucket: int, version: int) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={bucket}/v={version}")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark, path: str, schema, below: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The newest version of every bucket, or of some, of a table that upsert_sink keeps."""
    newest = {b: max(own) for b, vs in _versions(spark, path).items() if (own := [v for v in vs if below is None or v < below]) and (buckets is None or b in buckets)}
    if not newest:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/bucket={b}/v={v}" for b, v in newest.items()))


def upsert_sink(path: str, key: str, order: list[str], buckets: int = 64):
    """foreachBatch function that keeps the newest row of each key in a bucketed parquet table.

    A batch reads and writes only the buckets of its keys, as new versions beside the old; older versions but the last one before are then removed. A batch that
    is run again replaces its own version, whatever the number of the last one was.
    """
    from playweave.operators.dedup import keep_first

    def write(batch: DataFrame, epoch: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        rows = batch.persist().withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = sorted(r[0] for r in rows.select("bucket").distinct().collect())
        for b, versions in _versions(spark, path).items():
            if epoch in versions:
                _drop(spark, path, b, epoch)
        old = read_table(spark, path, schema, epoch, touched).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        newest = keep_first(old.unionByName(rows), [F.col(key)], [F.col(c) for c in order], last=True)
        newest.withColumn("v", F.lit(epoch)).repartition("bucket").write.partitionBy("bucket", "v").mode("append").parquet(path)
        batch.unpersist()
        for b, versions in _versions(spark, path).items():
            for v in sorted(versions)[:-2] if b in touched else []:
                _drop(spark, path, b, v)

    return write
