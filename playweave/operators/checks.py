"""What a captured answer means: routing of checks and outcomes of probes, as column expressions over recorded responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playweave.functions import text, urls
from playweave.operators.health import SOFT_CODE, SOFT_TEXTS

#: Texts of answers that ask for a login or a licence.
GATES = ["请登录", "登录后观看", "版权原因", "需要登录", "未授权", "please login", "please sign in", "sign in to", "log in to", "unauthorized", "authentication required"]
LISTS, MEDIA = [".m3u", ".txt"], [".m3u8", ".mpd", ".mp4", ".flv", ".ts"]


def soft_text(detail: Column, gates: list[str] = GATES) -> Column:
    """A message speaks for the environment, or asks for a login; false for null."""
    low = F.lower(detail)
    out = low.rlike(SOFT_CODE)
    for t in [*SOFT_TEXTS, *gates]:
        out = out | F.contains(low, F.lit(t))
    return F.coalesce(out, F.lit(False))


def http_class(status: Column, detail: Column) -> Column:
    """hard for 404 and 410 without soft text, soft for every other failing status, empty for success."""
    return F.when(F.coalesce(status < 400, F.lit(False)), "").when(F.coalesce(status.isin(404, 410), F.lit(False)) & ~soft_text(detail), "hard").otherwise("soft")


def probe_outcomes(attempts: DataFrame, key: str, order: str) -> DataFrame:
    """(key, status, tries) of recorded probes (key, order, code, output, error): the first attempt that settles the matter decides.

    Code 0 with output is probe_ok; a code below 0 or from 128 on is a crash of the prober, which says nothing (playback_unverified); a soft error ends the trying
    (manifest_ok). Where nothing settles it, the line has failed (probe_failed).
    """
    ok = F.coalesce((F.col("code") == 0) & (F.trim("output") != ""), F.lit(False))
    crash = F.coalesce((F.col("code") < 0) | (F.col("code") >= 128), F.lit(False))
    kind = F.when(ok, "probe_ok").when(crash, "playback_unverified").when(soft_text(F.col("error")), "manifest_ok")
    first = F.min_by(kind, F.when(kind.isNotNull(), F.col(order)))
    settled = F.min(F.when(kind.isNotNull(), F.col(order)))
    return attempts.groupBy(key).agg(F.coalesce(first, F.lit("probe_failed")).alias("status"), F.coalesce(settled, F.max(order)).alias("tries"))


def route(kind: Column, url: Column, status: Column, http_status: Column, content_type: Column, body: Column) -> Column:
    """The path that a check takes, by precedence; body is the answer's text."""
    path, low = F.lower(F.substring_index(url, "?", 1)), F.lower(url)
    ends = lambda names: F.coalesce(F.regexp_like(path, F.lit("(?:" + "|".join(n.replace(".", "\\.") for n in names) + ")\\z")), F.lit(False))
    yes = lambda c: F.coalesce(c, F.lit(False))
    stream = kind.isin("live", "channel")
    head = F.upper(F.substring(body, 1, 8192))
    playlist = yes(F.contains(head, F.lit("#EXTM3U"))) | yes(F.contains(F.lower(content_type), F.lit("mpegurl")))
    bare_hls = yes(F.contains(head, F.lit("#EXTM3U"))) & ~ends([*LISTS, *MEDIA])
    binary = yes(F.regexp_replace(F.substring(body, 1, 4096), r"^\s+", "") != "") & ~yes(F.regexp_replace(F.substring(body, 1, 4096), r"^\s+", "").rlike(r"^[<{\[]"))
    return (
        F.when(yes(stream) & urls.is_internal(url), "skip_internal").when(yes(kind == "source") & yes(status.isin("invalid_config", "invalid_placeholder")), "config")
        .when(yes(kind == "site") & yes(status == "requires_app") & ~yes(low.rlike("^https?://")), "builtin").when(http_status.isNull(), "no_answer").when(http_status >= 400, "http_error")
        .when(~yes(stream), F.when(yes(kind == "site") & yes(status == "requires_app"), "app").otherwise("reachable"))
        .when(ends(LISTS), "list").when(bare_hls, "bare_hls").when(playlist, F.when(yes(F.contains(F.upper(body), F.lit("#EXT-X-STREAM-INF"))), "master").otherwise("media_playlist"))
        .when(ends(MEDIA) | binary, "media").otherwise("unknown")
    )


def check_outcome(rows: DataFrame, probed: Column | None = None) -> DataFrame:
    """rows (kind, url, status, http_status, content_type, body, detail) with route, new_status and new_class.

    `probed` is the outcome of the probe or of the manifest's segments; without it nothing was probed. A gate text in the body makes a failure soft.
    """
    r = F.col("route")
    probe = F.coalesce(probed, F.lit("playback_unverified")) if probed is not None else F.when(r == "list", "manifest_ok").otherwise("playback_unverified")
    tried = r.isin("list", "bare_hls", "master", "media_playlist", "media")
    status = (
        F.when(r == "skip_internal", "skip_internal").when(r.isin("config", "builtin"), F.col("status")).when(r.isin("no_answer", "http_error"), "http_error").when(r == "app", "requires_app").when(r == "reachable", "reachable")
        .when(tried, probe).otherwise("playback_unverified")
    )
    gate = soft_text(F.substring("body", 1, 2048)) | soft_text(F.col("detail"))
    kind = F.when(r == "no_answer", "soft").when(r == "http_error", http_class(F.col("http_status"), F.col("detail"))).when(tried & F.col("new_status").isin("probe_failed", "manifest_ok") & gate, "soft").when(tried & (F.col("new_status") == "probe_failed"), "hard").otherwise("")
    routed = rows.withColumn("route", route(*(F.col(c) for c in ("kind", "url", "status", "http_status", "content_type", "body"))))
    return routed.withColumn("new_status", status).withColumn("new_class", kind)


def report(rows: DataFrame) -> DataFrame:
    """Published rows of a health run: safe addresses and redacted texts."""
    return rows.select("kind", "name", urls.safe(F.col("url")).alias("url"), "status", "http_status", text.redact(F.col("detail")).alias("detail"))
