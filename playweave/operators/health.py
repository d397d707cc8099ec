"""Outcomes of checks: failure classes, streaks, host incidents, state tables and removal history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playweave.operators.dedup import keep_first
from playweave.operators.ordered import streaks
from playweave.operators.skew import attach_group_facts

#: HTTP statuses that speak for the environment, and those that say that something is gone.
SOFT_STATUSES = [401, 403, 407, 408, 425, 429, 451]
HARD_STATUSES = [404, 410]
#: Parts of messages that speak for the environment.
SOFT_TEXTS = ["timed out", "超时", "network is unreachable", "temporary failure", "name or service not known", "nodename nor servname", "connection reset", "remote end closed connection", "connection refused", "connection aborted", "ssl", "certificate", "temporary", "server returned 5xx"]
#: Fixed value: status codes in a message that speak for the environment.
SOFT_CODE = r"\b(?:http\s*)?(?:401|403|407|408|425|429|451|5[0-9][0-9])\b|\b5xx\b"
STREAK_LIMIT = 3


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def soft_failure() -> Column:
    """The failure may be the environment's: by status, class, or text."""
    low = F.lower(F.col("detail"))
    text = low.rlike(SOFT_CODE)
    for t in SOFT_TEXTS:
        text = text | low.contains(t)
    return _true(F.col("http_status").isin(SOFT_STATUSES)) | _true(F.col("http_status") >= 500) | _true(F.col("failure_class") == "soft") | _true(text)


def decisive_failure() -> Column:
    """The failure proves that a live source is gone: a failing status, no soft evidence, and 404/410 or a failure that is not HTTP's. Other kinds are never decisive."""
    own = _true(F.col("status").isin("probe_failed", "invalid_config", "invalid_placeholder"))
    failing = own | _true(F.col("status") == "http_error")
    gone = _true(F.col("http_status").isin(HARD_STATUSES))
    by_class = F.when(F.col("failure_class") == "hard", gone | own).when(gone, True).when(F.col("http_status") >= 400, False).otherwise(own)
    return _true(F.col("kind") == "live") & failing & ~_true(F.col("failure_class").isin("soft", "internal", "unverified")) & ~soft_failure() & by_class


def attempts_verdict(attempts: DataFrame, key: str) -> DataFrame:
    """Over all attempts of a key: reachable if any answered below 400, hard if every one was 404/410 without soft text, else soft."""
    ok = F.bool_or(_true(F.col("http_status") < 400))
    hard = F.bool_and(_true(F.col("http_status").isin(HARD_STATUSES)) & ~soft_failure())
    return attempts.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.when(ok, "reachable").when(hard, "hard").otherwise("soft").alias("verdict"))


def streak_fold(checks: DataFrame, key: str, order: list[str], decisive: Column, reset: Column) -> DataFrame:
    """checks with `streak`: decisive failures since the last reset, after each check, in order. A key with very many checks is spread over tasks."""
    return streaks(checks, key, order, decisive, reset)


def streak_state(checks: DataFrame, key: str, order: list[str], decisive: Column, reset: Column, limit: int = STREAK_LIMIT) -> DataFrame:
    """Final streak of each key: (key, streak, removable). Two aggregates with map-side combination stand for the fold, so that a hot key costs no single task."""
    o = F.struct(*order)
    rows = checks.select(key, o.alias("o"), decisive.alias("d"), reset.alias("r"))
    last = rows.groupBy(key).agg(F.max(F.when(F.col("r"), F.col("o"))).alias("since"), F.count(F.lit(1)).alias("n"))
    joined = attach_group_facts(rows.filter(F.col(key).isNotNull()), last, [key], "n")
    after = F.col("d") & (F.col("since").isNull() | (F.col("o") > F.col("since")))
    return joined.groupBy(key).agg(F.count_if(after).alias("streak")).withColumn("removable", F.col("streak") >= limit)


def history(checks: DataFrame, key: str, order: list[Column], keep: int = 3) -> DataFrame:
    """The last `keep` checks of each key, the newest first (rn = 1)."""
    return checks.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter(F.col("rn") <= keep)


def host_incidents(checks: DataFrame, least: int = 6, hard_least: int = 3) -> DataFrame:
    """Hosts with so many failures at once that the host, not its lines, is at fault: (host, rows, failures, hard)."""
    failing = F.col("status").isin("http_error", "probe_failed")
    facts = checks.filter((F.col("host") != "") & F.col("kind").isin("channel", "live")).groupBy("host").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(failing).alias("failures"), F.count_if(failing & (F.col("failure_class") == "hard")).alias("hard"),
    )
    return facts.filter((F.col("rows") >= least) & (F.col("failures") >= least) & (F.col("failures") * 2 >= F.col("rows")) & (F.col("hard") >= hard_least) & (F.col("hard") * 2 >= F.col("rows")))


def circuit_breaker(checks: DataFrame, **thresholds) -> DataFrame:
    """checks whose failing rows on a host with an incident become `upstream_incident` with class soft."""
    bad = host_incidents(checks, **thresholds).select("host", F.col("rows").alias("_n"), F.lit(True).alias("_h"))
    marked = attach_group_facts(checks, bad, ["host"], "_n", how="left").drop("_n")
    hit = F.col("_h").isNotNull() & F.col("status").isin("http_error", "probe_failed") & F.col("kind").isin("channel", "live")
    return marked.withColumns({"status": F.when(hit, "upstream_incident").otherwise(F.col("status")), "failure_class": F.when(hit, "soft").otherwise(F.col("failure_class"))}).select(*checks.columns)


def verdict(streak: Column, internal: Column, whitelisted: Column, limit: int = STREAK_LIMIT) -> Column:
    """Verdict of a check, by precedence."""
    soft = soft_failure() | _true(F.col("status").isin("playback_unverified", "manifest_ok", "upstream_incident", "skip_internal"))
    decisive = _true(F.col("failure_class") == "hard") & ~_true(F.col("status") == "upstream_incident") & ~soft_failure()
    return (F.when(internal, "skip_internal").when(_true(F.col("status") == "upstream_incident"), "observe_upstream").when(whitelisted, "whitelisted")
            .when(decisive & (streak >= limit), "candidate_remove").when(decisive, "observe").when(soft, "observe_soft").otherwise("keep"))


def upsert_state(previous: DataFrame, current: DataFrame, key: str, order: list[str], carried: list[str]) -> DataFrame:
    """State after a run: the newest row of each key of current, else the previous row; `carried` fields keep an old value where the new one is null."""
    new = keep_first(current, [F.col(key)], [F.col(c) for c in order], last=True)
    fields = [c for c in previous.columns if c != key]
    p, c = previous.select(key, *(F.col(f).alias(f"_p_{f}") for f in fields)), new.select(key, *fields, F.lit(True).alias("_new"))
    pick = {f: F.coalesce(F.col(f), F.col(f"_p_{f}")) if f in carried else F.when(F.col("_new"), F.col(f)).otherwise(F.col(f"_p_{f}")) for f in fields}
    return p.join(c, key, "full").select(key, *(v.alias(f) for f, v in pick.items()))


def on_whitelist(df: DataFrame, host: Column, hosts: list[str]) -> DataFrame:
    """Rows whose host is a listed one or under it: every suffix of the host is looked up, so the list may be long."""
    parts = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    listed = F.array(*(F.lit(h) for h in hosts)) if hosts else F.array().cast("array<string>")
    return df.filter(F.arrays_overlap(suffixes, listed))


def removal_history(previous: DataFrame, recovered: DataFrame, doomed: DataFrame, key: str) -> DataFrame:
    """(previous - recovered) and doomed; the first removal time stays: (key, removed_at)."""
    kept = previous.select(key, "removed_at").join(recovered.select(key), key, "left_anti")
    return kept.unionByName(doomed.select(key, "removed_at")).groupBy(key).agg(F.min("removed_at").alias("removed_at"))
