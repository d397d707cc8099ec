"""The two runs as DataFrame functions: aggregation of fetched sources, and a health run over recorded answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playweave.functions import text, urls
from playweave.operators import checks, configs, dedup, health, ledger, state, whitelist
from playweave.operators.classify import Stage, cascade


def merge_channels(channels: DataFrame, order: list[str], stages: list[Stage], default: str) -> DataFrame:
    """Channels of http(s) addresses, the first of each address by order, with protocol, identity, category and quality."""
    rows = channels.withColumn("url", urls.trimmed(F.col("url"))).filter(F.col("url").rlike("^https?://"))
    first = dedup.keep_first(rows, [F.col("url")], [F.col(c) for c in order])
    columns = {"name": text.fold_name(F.col("name")), "group": F.col("group_raw"), "section": F.col("source_section")}
    return first.withColumns({"protocol": urls.scheme(F.col("url")), "channel_key": text.identity(F.col("name")), "group_name": cascade(columns, stages, default), "quality": text.quality(F.col("name"))})


def drop_dead(channels: DataFrame, dead: DataFrame, protected: DataFrame | None = None) -> DataFrame:
    """Channels whose address is not on the list of dead ones (url); addresses that a whitelist (lines) protects stay."""
    gone = dead.select(urls.trimmed(F.col("url")).alias("url")).filter("url IS NOT NULL").distinct()
    if protected is not None:
        gone = whitelist.mark(gone, "url", protected).filter("NOT whitelisted").select("url")
    return channels.join(gone, "url", "left_anti")


def aggregate(fetched: DataFrame, stages: list[Stage], default: str, dead: DataFrame | None = None, protected: DataFrame | None = None) -> dict[str, DataFrame]:
    """A whole aggregation: sources, sites, lives, channels, ledger, categories, pending and inventory tables from fetched texts."""
    parts = configs.collect(fetched)
    channels = merge_channels(parts["channels"], ["source_line", "source", "pos"], stages, default)
    if dead is not None:
        channels = drop_dead(channels, dead, protected)
    channels = channels.withColumn("row_id", F.struct("source_line", "source", "pos"))
    sites = configs.merge_objects(parts["sites"].filter("reason = ''"), ["key", "api"], ["source_line", "source", "pos"])
    lives = configs.merge_objects(parts["lives"].filter("reason = ''"), ["name", "url"], ["source_line", "source", "pos"])
    book = ledger.ledger(channels)
    categories = channels.groupBy("channel_key").agg(F.min_by("group_name", "row_id").alias("category"))
    item = lambda kind, rows, name, url: rows.select(F.lit(kind).alias("kind"), name.alias("name"), text.redact(url).alias("url"), F.lit("unverified").alias("status"))
    inventory = parts["sources"].select(F.lit("source").alias("kind"), F.col("source").alias("name"), text.redact(F.col("effective_url")).alias("url"), "status")
    for kind, rows, field in (("site", sites, "$.api"), ("live", lives, "$.url")):
        inventory = inventory.unionByName(item(kind, rows, F.get_json_object("object", "$.name"), F.get_json_object("object", field)))
    return {
        "sources": parts["sources"], "sites": sites, "lives": lives, "meta": parts["meta"], "channels": channels, "ledger": book, "categories": categories.groupBy("category").agg(F.count(F.lit(1)).alias("n")),
        "pending": categories.filter(F.col("category") == default).join(book, "channel_key"), "inventory": inventory, "rejected": parts["sites"].unionByName(parts["lives"]).filter("reason <> ''"),
    }


def health_run(items: DataFrame, answers: DataFrame, previous: dict[str, DataFrame], ledger_hashes: DataFrame, protected: DataFrame, limit: int, offset: int, order: str, now: Column) -> dict[str, DataFrame]:
    """A whole health run over recorded answers (order, http_status, content_type, body, detail, probed) of the items that were sampled.

    previous: streaks, health, evidence and removed of the run before. Gives sample, checks, streaks, health, evidence, removed and clusters.
    """
    sample = state.priority_sample(items, previous["evidence"], limit, offset, tie=order)
    asked = sample.drop("http_status", "content_type", "detail").join(answers, order)
    checked = checks.check_outcome(asked, F.col("probed")).withColumns({"status": F.col("new_status"), "failure_class": F.col("new_class")}).drop("new_status", "new_class", "route")
    checked = whitelist.mark(health.circuit_breaker(checked), "url", protected)
    lines = state.channel_health(checked, previous["health"], ledger_hashes, [order])
    streaks = state.fold_streaks(checked, previous["streaks"], [order])
    return {
        "sample": sample, "checks": checked, "streaks": streaks, "removable": state.removable_report(streaks), "health": lines, "verdicts": state.verdict_counts(lines), "evidence": state.url_state(items, checked, previous["evidence"], [order]),
        "removed": state.removal_records(lines, previous["removed"], now), "recheck": state.to_recheck(previous["removed"], checked), "clusters": state.error_clusters(lines), "report": checks.report(checked),
    }
