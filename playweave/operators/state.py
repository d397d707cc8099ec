"""State carried from run to run: streaks of live sources, health of lines, evidence by address, samples and removals.

Each function takes the state of the run before and the checks of this run as tables and gives the new state, by joins on
the key; nothing is collected. Of several checks of a key in one run the last by `order` counts. Null keys take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playweave.functions import text, urls
from playweave.operators.dedup import keep_first
from playweave.operators.health import STREAK_LIMIT, decisive_failure, soft_failure, verdict
from playweave.operators.ranking import global_rank

#: Verdicts that take an address out of the removal history, and those that failure clusters are made of.
RECOVERED = ["keep", "observe_soft", "observe_upstream", "observe", "skip_internal", "whitelisted"]
CLUSTERED = ["observe", "observe_soft", "candidate_remove"]
ENTRY = ["checked_at", "status", "detail", "failure_class", "http_status", "host"]
HISTORY = "array<struct<checked_at:timestamp,status:string,detail:string,failure_class:string,http_status:int,host:string>>"


def last_of_run(checks: DataFrame, key: str, order: list[str]) -> DataFrame:
    return keep_first(checks.filter(F.col(key).isNotNull()), [F.col(key)], [F.col(c) for c in order], last=True)


def last_entries(history: Column, keep: int = STREAK_LIMIT) -> Column:
    return F.slice(history, F.greatest(F.size(history) - keep + 1, F.lit(1)), keep)


def fold_streaks(checks: DataFrame, previous: DataFrame, order: list[str], limit: int = STREAK_LIMIT) -> DataFrame:
    """Streaks (url, name, source, count, history, removable, whitelisted, failure_class, host) of the live sources of a run.

    A decisive failure adds one and an entry to the history, which keeps the last three; a decoded stream or a protecting list (checks.whitelisted) starts
    again at nothing; any other outcome leaves count and history. Sources that the run does not have are forgotten.
    """
    own = last_of_run(checks.filter("kind = 'live'"), "url", order)
    before = previous.select("url", F.col("count").alias("_count"), F.col("history").cast(HISTORY).alias("_history"), F.col("failure_class").alias("_class"))
    rows = own.join(before, "url", "left")
    white = F.coalesce(F.col("whitelisted"), F.lit(False)) if "whitelisted" in checks.columns else F.lit(False)
    fails, clean = ~white & decisive_failure(), white | F.coalesce(F.col("status") == "probe_ok", F.lit(False))
    old, past = F.coalesce("_count", F.lit(0)), F.coalesce("_history", F.array().cast(HISTORY))
    entry = F.struct(F.col("checked_at"), F.col("status"), F.substring("detail", 1, 300).alias("detail"), F.col("failure_class"), F.col("http_status"), F.col("host"))
    count = F.when(fails, old + 1).when(clean, 0).otherwise(old)
    history = F.when(fails, last_entries(F.concat(past, F.array(entry).cast(HISTORY)))).when(clean, F.array().cast(HISTORY)).otherwise(past)
    kind = F.when(fails, F.col("failure_class")).when(clean, "").otherwise(F.coalesce("_class", F.lit("")))
    return rows.select("url", "name", "source", count.cast("int").alias("count"), history.alias("history"), (fails & (count >= limit)).alias("removable"), white.alias("whitelisted"), kind.alias("failure_class"), "host")


def channel_health(checks: DataFrame, previous: DataFrame, ledger: DataFrame, order: list[str], limit: int = STREAK_LIMIT) -> DataFrame:
    """Health of every line, by url_hash: this run's checks, and the rows of lines that were not sampled and are still in the ledger (url_hash).

    The counter rises with a hard failure that is not the environment's, and starts again with a decoded stream or a protecting list. An empty ledger is
    a fault of its making and drops nothing. Addresses are published safe, texts redacted.
    """
    own = last_of_run(checks.filter("kind = 'channel'").withColumn("url_hash", F.coalesce("url_hash", F.sha2("url", 256))), "url_hash", order)
    carried = previous if ledger.isEmpty() else previous.join(ledger.select("url_hash").distinct(), "url_hash", "left_semi")
    rows = own.join(previous.select("url_hash", F.col("decisive_failures").alias("_old")), "url_hash", "left")
    internal, incident = urls.is_internal(F.col("url")), F.coalesce(F.col("status") == "upstream_incident", F.lit(False))
    decisive = F.coalesce(F.col("failure_class") == "hard", F.lit(False)) & ~incident & ~soft_failure()
    soft = soft_failure() | F.coalesce(F.col("status").isin("playback_unverified", "manifest_ok", "upstream_incident", "skip_internal"), F.lit(False))
    white = F.coalesce(F.col("whitelisted"), F.lit(False)) if "whitelisted" in checks.columns else F.lit(False)
    old = F.coalesce("_old", F.lit(0))
    counted = F.when(decisive & ~internal, old + 1).when(F.coalesce(F.col("status") == "probe_ok", F.lit(False)), 0).otherwise(old)
    new = rows.select(
        "url_hash", urls.safe(F.col("url")).alias("url"), "name", "channel_key", "category", "source", "source_line", "status", "http_status", urls.safe(F.col("final_url")).alias("final_url"), "content_type", "failure_class",
        text.redact(F.col("evidence")).alias("evidence"), "attempts", "host", "redirect_count", text.redact(F.col("detail")).alias("detail"), "checked_at",
        F.when(white & ~internal & ~incident, 0).otherwise(counted).cast("int").alias("decisive_failures"), soft.alias("soft_failure"), internal.alias("internal"), verdict(counted, internal, white, limit).alias("verdict"),
    )
    kept = carried.join(own.select("url_hash"), "url_hash", "left_anti")
    return new.unionByName(kept.select(*[c for c in new.columns if c in kept.columns]), allowMissingColumns=True)


def url_state(every: DataFrame, checked: DataFrame, previous: DataFrame, order: list[str]) -> DataFrame:
    """Evidence by address (url_hash, url, name, kind, host, status, failure_class, http_status, content_type, attempts, last_checked, last_success, last_evidence).

    Addresses that no input of the run has any more are evicted, those that were not checked keep their evidence, and the time of the last success stays
    until the next one.
    """
    key = F.coalesce("url_hash", F.sha2("url", 256))
    present = every.filter(F.col("kind").isin("live", "channel")).select(key.alias("url_hash")).filter("url_hash IS NOT NULL").distinct()
    kept = previous if present.isEmpty() else previous.join(present, "url_hash", "left_semi")
    own = last_of_run(checked.withColumn("url_hash", key), "url_hash", order)
    new = own.join(kept.select("url_hash", F.col("last_success").alias("_success")), "url_hash", "left").select(
        "url_hash", urls.safe(F.col("url")).alias("url"), "name", "kind", "host", "status", "failure_class", "http_status", "content_type", "attempts", F.col("checked_at").alias("last_checked"),
        F.when(F.col("status") == "probe_ok", F.col("checked_at")).otherwise(F.col("_success")).alias("last_success"), F.substring(text.redact(F.col("evidence")), 1, 500).alias("last_evidence"),
    )
    return new.unionByName(kept.join(own.select("url_hash"), "url_hash", "left_anti").select(*new.columns))


def next_offset(every: DataFrame, offset: int, limit: int) -> int:
    """Where the next sample begins: the cursor moves on by the sample asked for, around the lines that can be probed."""
    n = every.filter((F.col("kind") == "channel") & ~urls.is_internal(F.col("url"))).count()
    return (offset + min(limit if limit > 0 else n, n)) % n if n else 0


def priority_band(failure_class: Column, status: Column, known: Column) -> Column:
    """0 for lines never checked, 1 for those that failed, 3 for those that played, 2 for the rest."""
    return F.when(~known, 0).when(F.coalesce(failure_class.isin("hard", "soft"), F.lit(False)), 1).when(F.coalesce(status == "probe_ok", F.lit(False)), 3).otherwise(2)


def priority_sample(items: DataFrame, state: DataFrame, limit: int, offset: int = 0, tie: str = "url") -> DataFrame:
    """Items to check in a run: all that are no channels, and `limit` channels from `offset` on in the order of bands, oldest check first; all items for no limit.

    Channels that cannot be reached from outside take no place. Positions come from range partitioning, not from one sorted task.
    """
    if limit <= 0:
        return items
    others, channels = items.filter(~F.coalesce(F.col("kind") == "channel", F.lit(False))), items.filter((F.col("kind") == "channel") & ~urls.is_internal(F.col("url")))
    facts = state.select("url_hash", F.col("failure_class").alias("_class"), F.col("status").alias("_status"), F.col("last_checked").alias("_last"), F.lit(True).alias("_known"))
    rows = channels.join(facts, "url_hash", "left").withColumn("_band", priority_band(F.col("_class"), F.col("_status"), F.col("_known").isNotNull()))
    order = [F.col("_band"), F.coalesce(F.col("_last").cast("string"), F.lit("")), F.col("url"), F.col(tie)]
    ranked = global_rank(rows, order, "_pos")
    n = ranked.count()
    taken = ranked.filter(F.pmod(F.col("_pos") - offset, F.lit(max(n, 1))) < limit)
    return others.unionByName(taken.select(*items.columns))


def removal_records(health: DataFrame, previous: DataFrame, now: Column) -> DataFrame:
    """History of removed lines: doomed ones are added or brought up to date and keep their first time, recovered ones leave, all others stay."""
    fields = ["name", "category", "host", "source", "source_line", "failure_class", "http_status", "evidence", "decisive_failures"]
    doomed = keep_first(health.filter("verdict = 'candidate_remove' AND url IS NOT NULL"), [F.col("url")], [F.col("url_hash")], last=True)
    back = health.filter(F.col("verdict").isin(RECOVERED)).select("url").distinct()
    kept = previous.join(back, "url", "left_anti")
    new = doomed.join(kept.select("url", F.col("removed_at").alias("_first")), "url", "left").select("url", *fields, F.coalesce("_first", now).alias("removed_at"), F.col("checked_at").alias("last_checked"))
    return new.unionByName(kept.join(doomed.select("url"), "url", "left_anti").select(*new.columns))


def to_recheck(previous: DataFrame, checks: DataFrame) -> DataFrame:
    """Removed lines that this run did not check and that can be reached."""
    seen = checks.filter("kind = 'channel'").select("url").distinct()
    return previous.join(seen, "url", "left_anti").filter(~urls.is_internal(F.col("url")))


def removable_report(streaks: DataFrame, limit: int = STREAK_LIMIT) -> DataFrame:
    """Streaks with their group: removable, pending (some failures) or clean."""
    group = F.when(F.col("removable"), "removable").when(F.col("count") > 0, "pending").otherwise("clean")
    return streaks.withColumn("group", group)


def error_clusters(health: DataFrame, most: int = 30, order: str = "url_hash") -> DataFrame:
    """The most frequent combinations of status, class, HTTP status, host and category among failing lines; ties by the first seen."""
    keys = ["status", "failure_class", "http_status", "host", "category"]
    rows = health.filter(F.col("verdict").isin(CLUSTERED)).withColumn("host", urls.host(F.col("url"))).withColumn("http_status", F.coalesce(F.col("http_status").cast("string"), F.lit("")))
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.min(order).alias("_first"))
    return found.orderBy(F.desc("count"), "_first").limit(most).drop("_first")


def verdict_counts(health: DataFrame) -> DataFrame:
    return health.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def recent(history: DataFrame, key: str, order: list[str], keep: int = STREAK_LIMIT) -> DataFrame:
    """The last entries of each key as one array, the oldest first."""
    rows = history.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(*(F.desc(c) for c in order)))).filter(F.col("_rn") <= keep)
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("recent"))
