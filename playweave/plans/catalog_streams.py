"""Queries that run a stream over a table's files until all are read, and give the state that it leaves, with the SQL of the same state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from playweave.common import shared_dir
from playweave.plans.catalog import _DECISIVE
from playweave.plans.registry import QUERIES, SQL
from playweave.streaming import streaks


def _stream(spark, d: str, name: str):
    """The files of a table as a stream; a table may be a file or a folder."""
    path = f"{d}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")


def _run(spark, frame, label: str, mode: str, sink) -> str:
    """Run a stream to the end of its input; sink(folder) gives the function for each batch."""
    folder = f"{shared_dir(spark)}/playweave/{label}-{uuid.uuid4().hex}"
    q = frame.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(sink(f"{folder}/table")).start()
    q.awaitTermination()
    return f"{folder}/table"


def stream_streaks(spark, d: str):
    """Failure streaks by address, folded by the stateful stream into a bucketed table."""
    h = _stream(spark, d, "health_items").filter("url IS NOT NULL AND checked_at IS NOT NULL AND kind = 'live'")
    from playweave.operators.health import decisive_failure

    outcome = F.when(decisive_failure(), "decisive").when(F.col("status") == "probe_ok", "ok").otherwise("other")
    rows = h.select(F.col("url").alias("key"), F.unix_micros(F.col("checked_at").cast("timestamp")).alias("at"), outcome.alias("outcome"))

    def sink(path: str):
        write = streaks.upsert_sink(path, "key", ["epoch"], buckets=16)
        return lambda batch, epoch: write(batch.withColumn("epoch", F.lit(epoch)), epoch)

    path = _run(spark, streaks.streaks(rows), "stream-streaks", "update", sink)
    table = streaks.read_table(spark, path, f"{streaks.OUTPUT}, epoch bigint")
    return table.select(F.col("key").alias("url"), "streak", "removable", F.array_join("history", ",").alias("history"))


def stream_windows(spark, d: str):
    """Events by type in windows of five minutes, counted by the stream; the last result of each window stays."""
    e = _stream(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    counts = streaks.windowed_counts(e, "at", "event_type").select(F.col("window.start").alias("start"), "event_type", "n", F.concat_ws("|", F.col("window.start").cast("string"), "event_type").alias("key"))

    def sink(path: str):
        write = streaks.upsert_sink(path, "key", ["epoch"], buckets=16)
        return lambda batch, epoch: write(batch.withColumn("epoch", F.lit(epoch)), epoch)

    path = _run(spark, counts, "stream-windows", "update", sink)
    return streaks.read_table(spark, path, "start timestamp, event_type string, n bigint, key string, epoch bigint").select(F.unix_micros("start").alias("start_us"), "event_type", "n")


QUERIES |= {f.__name__: f for f in (stream_streaks, stream_windows)}
_ROWS = f"(SELECT url, checked_at, CASE WHEN {_DECISIVE} THEN 'decisive' WHEN status = 'probe_ok' THEN 'ok' ELSE 'other' END AS outcome FROM health_items WHERE url IS NOT NULL AND checked_at IS NOT NULL AND kind = 'live')"
SQL |= {
    "stream_streaks": f"""WITH r AS (SELECT url, outcome, row_number() OVER (PARTITION BY url ORDER BY checked_at, outcome) AS i, count(*) OVER (PARTITION BY url) AS n FROM {_ROWS}), l AS (SELECT url, coalesce(max(i) FILTER (WHERE outcome = 'ok'), 0) AS ok_at FROM r GROUP BY url)
SELECT r.url, count(*) FILTER (WHERE outcome = 'decisive' AND i > ok_at) AS streak, count(*) FILTER (WHERE outcome = 'decisive' AND i > ok_at) >= 3 AS removable, string_agg(outcome, ',' ORDER BY i) FILTER (WHERE i > n - 3) AS history FROM r JOIN l ON r.url = l.url GROUP BY r.url""",
    "stream_windows": "SELECT (epoch_us(ts) // 300000000) * 300000000 AS start_us, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
