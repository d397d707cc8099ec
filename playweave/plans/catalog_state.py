"""Queries of whitelists, checks and state, over health_items, streaks and channels, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from playweave.functions import urls
from playweave.operators import checks, health, publish, state, whitelist
from playweave.plans.catalog import _DECISIVE, _INTERNAL, _SHIFTED, _SOFT, _shifted, _spiked
from playweave.plans.registry import SQL, query

WHITELIST = ["# protected", "veltra.example", " .ostrel.test # and all under it", "https://edge2.corvane.example/play.php", "", "HTTPS://CDN1.nimbus-tv.test/live"]
_HOST = r"lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
_HOSTS = ["veltra.example", "ostrel.test", "edge2.corvane.example", "cdn1.nimbus-tv.test"]
_WHITE = "coalesce(contains(lower(url), 'https://edge2.corvane.example/play.php') OR contains(lower(url), 'https://cdn1.nimbus-tv.test/live') OR " + " OR ".join(f"{_HOST} = '{h}' OR suffix({_HOST}, '.{h}')" for h in _HOSTS) + ", false)"


def _lines(spark):
    return spark.createDataFrame([(x,) for x in [*WHITELIST, None]], "value string")


@query("SELECT * FROM (VALUES ('host', 'veltra.example'), ('host', 'ostrel.test'), ('url', 'https://edge2.corvane.example/play.php'), ('host', 'edge2.corvane.example'), ('url', 'HTTPS://CDN1.nimbus-tv.test/live'), ('host', 'cdn1.nimbus-tv.test')) t(kind, entry)")
def whitelist_entries(spark, t):
    return whitelist.parse(_lines(spark))


@query(f"SELECT check_id, {_WHITE} AS whitelisted FROM health_items")
def whitelisted(spark, t):
    return whitelist.mark(t("health_items"), "url", _lines(spark)).select("check_id", "whitelisted")


_LAST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY check_id DESC) AS _rn FROM {rows}) WHERE _rn = 1)"
_OLD = "(SELECT * FROM (SELECT url AS p_url, fail_count AS p_count, len(history) AS p_len, failure_class AS p_class, row_number() OVER (PARTITION BY url ORDER BY streak_id DESC) AS rn FROM streaks WHERE url IS NOT NULL) WHERE rn = 1)"
_FOLDED = f"""SELECT url, CAST(CASE WHEN w THEN 0 WHEN d THEN coalesce(p_count, 0) + 1 WHEN ok THEN 0 ELSE coalesce(p_count, 0) END AS INT) AS count, CASE WHEN w THEN 0 WHEN d THEN least(3, coalesce(p_len, 0) + 1) WHEN ok THEN 0 ELSE coalesce(p_len, 0) END::BIGINT AS entries,
  NOT w AND d AND coalesce(p_count, 0) + 1 >= 3 AS removable, w AS whitelisted, CASE WHEN w OR (ok AND NOT d) THEN '' WHEN d THEN failure_class ELSE coalesce(p_class, '') END AS failure_class
  FROM (SELECT url, failure_class, {_WHITE} AS w, {_DECISIVE} AS d, coalesce(status = 'probe_ok', false) AS ok FROM {_LAST.format(key="url", rows="(SELECT * FROM health_items WHERE kind = 'live' AND url IS NOT NULL)")}) c LEFT JOIN {_OLD} p ON c.url = p.p_url"""


def _previous(t):
    s = t("streaks").select("url", F.col("fail_count").alias("count"), "history", "failure_class", "streak_id")
    return state.last_of_run(s, "url", ["streak_id"]).drop("streak_id")


def _folded(spark, t):
    return state.fold_streaks(whitelist.mark(t("health_items"), "url", _lines(spark)), _previous(t), ["check_id"])


@query(_FOLDED)
def streaks_updated(spark, t):
    return _folded(spark, t).select("url", "count", F.size("history").cast("bigint").alias("entries"), "removable", "whitelisted", "failure_class")


@query(f"SELECT CASE WHEN removable THEN 'removable' WHEN count > 0 THEN 'pending' ELSE 'clean' END AS \"group\", count(*) AS n, sum(count)::BIGINT AS failures FROM ({_FOLDED}) GROUP BY 1")
def removable_groups(spark, t):
    return state.removable_report(_folded(spark, t)).groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("failures"))


#: The run before: checks of one attempt; this run: the others. The ledger: every address of channels.
_PREV = f"(SELECT url_hash, url, name, status, failure_class, category, check_id, host, checked_at, CAST(check_id % 5 AS INT) AS decisive_failures, 'observe' AS verdict FROM {_LAST.format(key='url_hash', rows='''(SELECT * FROM health_items WHERE kind = 'channel' AND attempts <= 1 AND url_hash IS NOT NULL)''')})"
_RUN = f"(SELECT * FROM {_LAST.format(key='url_hash', rows=f'''(SELECT * REPLACE (coalesce(url_hash, sha256(url)) AS url_hash) FROM ({_SHIFTED}) WHERE kind = 'channel' AND attempts > 1 AND coalesce(url_hash, sha256(url)) IS NOT NULL)''')})"
_HARD = f"(coalesce(failure_class = 'hard', false) AND NOT coalesce(status = 'upstream_incident', false) AND NOT {_SOFT})"
_COUNTED = "CASE WHEN d AND NOT i THEN coalesce(old, 0) + 1 WHEN ok THEN 0 ELSE coalesce(old, 0) END"
_HEALTH = f"""SELECT url_hash, name, status, category, CAST(CASE WHEN w AND NOT i AND NOT coalesce(status = 'upstream_incident', false) THEN 0 ELSE {_COUNTED} END AS INT) AS decisive_failures,
  CASE WHEN i THEN 'skip_internal' WHEN status = 'upstream_incident' THEN 'observe_upstream' WHEN w THEN 'whitelisted' WHEN d AND {_COUNTED} >= 3 THEN 'candidate_remove' WHEN d THEN 'observe' WHEN s THEN 'observe_soft' ELSE 'keep' END AS verdict
  FROM (SELECT r.url_hash, r.name, r.status, r.category, o.decisive_failures AS old, r.w, r.i, r.d, r.s, r.ok FROM (SELECT *, {_WHITE} AS w, {_INTERNAL} AS i, {_HARD} AS d, ({_SOFT} OR coalesce(status IN ('playback_unverified', 'manifest_ok', 'upstream_incident', 'skip_internal'), false)) AS s, coalesce(status = 'probe_ok', false) AS ok FROM {_RUN}) r LEFT JOIN {_PREV} o ON r.url_hash = o.url_hash)
  UNION ALL SELECT url_hash, name, status, category, decisive_failures, verdict FROM {_PREV} WHERE url_hash IN (SELECT sha256(url) FROM channels WHERE url IS NOT NULL) AND url_hash NOT IN (SELECT url_hash FROM {_RUN})"""


def _before(t):
    h = state.last_of_run(t("health_items").filter("kind = 'channel' AND attempts <= 1"), "url_hash", ["check_id"])
    return h.select("url_hash", "url", "name", "channel_key", "status", "failure_class", "http_status", "category", "host", "checked_at", (F.col("check_id") % 5).cast("int").alias("decisive_failures"), F.lit("observe").alias("verdict"))


def _health(spark, t):
    run = whitelist.mark(_shifted(t).filter("attempts > 1"), "url", _lines(spark))
    ledger = t("channels").filter("url IS NOT NULL").select(F.sha2("url", 256).alias("url_hash"))
    return state.channel_health(run, _before(t), ledger, ["check_id"])


@query(_HEALTH)
def channel_health(spark, t):
    return _health(spark, t).select("url_hash", "name", "status", "category", "decisive_failures", "verdict")


@query(f"SELECT verdict, count(*) AS n FROM ({_HEALTH}) GROUP BY verdict")
def verdict_counts(spark, t):
    return state.verdict_counts(_health(spark, t))


@query(f"SELECT name, category, decisive_failures FROM ({_HEALTH}) WHERE verdict = 'candidate_remove'")
def dead_channels(spark, t):
    return _health(spark, t).filter("verdict = 'candidate_remove'").select("name", "category", "decisive_failures")


@query(f"""SELECT status, failure_class, http_status, host, category, n FROM (SELECT coalesce(status, '-') AS status, failure_class, coalesce(CAST(http_status AS VARCHAR), '') AS http_status, {_HOST} AS host, category, count(*) AS n, min(check_id) AS first FROM health_items
  WHERE failure_class IN ('hard', 'soft') GROUP BY ALL) ORDER BY n DESC, first LIMIT 30""")
def failure_clusters(spark, t):
    rows = t("health_items").filter("failure_class IN ('hard', 'soft')").withColumns({"status": F.coalesce("status", F.lit("-")), "verdict": F.when(F.col("failure_class") == "hard", "observe").otherwise("observe_soft")})
    return state.error_clusters(rows, order="check_id").withColumnRenamed("count", "n")


_KEY = "coalesce(url_hash, sha256(url))"
_EVIDENCE = f"""WITH present AS (SELECT DISTINCT {_KEY} AS k FROM health_items WHERE kind IN ('live', 'channel') AND check_id % 4 <> 0 AND {_KEY} IS NOT NULL),
kept AS (SELECT * FROM (SELECT url_hash, status, checked_at AS last_checked, CASE WHEN status = 'probe_ok' THEN checked_at END AS last_success FROM {_LAST.format(key="url_hash", rows="(SELECT * FROM health_items WHERE attempts <= 1 AND url_hash IS NOT NULL)")}) WHERE url_hash IN (SELECT k FROM present)),
run AS (SELECT * FROM {_LAST.format(key="_key", rows=f"(SELECT *, {_KEY} AS _key FROM health_items WHERE attempts > 1 AND {_KEY} IS NOT NULL)")})
SELECT r._key AS url_hash, r.status, r.checked_at AS last_checked, CASE WHEN r.status = 'probe_ok' THEN r.checked_at ELSE k.last_success END AS last_success FROM run r LEFT JOIN kept k ON r._key = k.url_hash
UNION ALL SELECT url_hash, status, last_checked, last_success FROM kept WHERE url_hash NOT IN (SELECT _key FROM run)"""


def _evidence(t):
    h = t("health_items")
    old = state.last_of_run(h.filter("attempts <= 1"), "url_hash", ["check_id"]).select("url_hash", "url", "name", "kind", "host", "status", "failure_class", "http_status", "content_type", "attempts", F.col("checked_at").alias("last_checked"), F.when(F.col("status") == "probe_ok", F.col("checked_at")).alias("last_success"), F.col("evidence").alias("last_evidence"))
    return state.url_state(h.filter("check_id % 4 <> 0"), h.filter("attempts > 1"), old, ["check_id"])


@query(_EVIDENCE)
def url_evidence(spark, t):
    return _evidence(t).select("url_hash", "status", "last_checked", "last_success")


@query(f"""WITH s AS (SELECT url_hash AS k, failure_class AS f, status AS st, strftime(checked_at, '%Y-%m-%d %H:%M:%S') AS seen FROM {_LAST.format(key="url_hash", rows="(SELECT * FROM health_items WHERE attempts <= 1 AND url_hash IS NOT NULL)")}),
c AS (SELECT h.check_id, row_number() OVER (ORDER BY CASE WHEN k IS NULL THEN 0 WHEN f IN ('hard', 'soft') THEN 1 WHEN st = 'probe_ok' THEN 3 ELSE 2 END, coalesce(seen, ''), h.url NULLS FIRST, h.check_id) - 1 AS p, count(*) OVER () AS n FROM (SELECT * FROM ({_SHIFTED}) WHERE kind = 'channel' AND NOT {_INTERNAL}) h LEFT JOIN s ON h.url_hash = s.k)
SELECT check_id FROM c WHERE (p - 37 % n + n) % n < 400 UNION ALL SELECT check_id FROM health_items WHERE kind IS NULL OR kind <> 'channel'""")
def priority_sample(spark, t):
    s = state.last_of_run(t("health_items").filter("attempts <= 1"), "url_hash", ["check_id"]).select("url_hash", "failure_class", "status", F.date_format("checked_at", "yyyy-MM-dd HH:mm:ss").alias("last_checked"))
    return state.priority_sample(_shifted(t), s, 400, 37, tie="check_id").select("check_id")


_REMOVED = "(SELECT url, min(checked_at) AS removed_at, max(name) AS name FROM health_items WHERE url IS NOT NULL AND check_id % 3 = 0 GROUP BY url)"
_SOME = "(SELECT url, url_hash, checked_at, CASE WHEN http_status IN (404, 410) THEN 'candidate_remove' WHEN status = 'probe_ok' THEN 'keep' ELSE 'other' END AS verdict FROM health_items WHERE url IS NOT NULL)"


@query(f"""WITH doomed AS (SELECT url, max(url_hash) AS h FROM {_SOME} WHERE verdict = 'candidate_remove' GROUP BY url), back AS (SELECT DISTINCT url FROM {_SOME} WHERE verdict = 'keep'), kept AS (SELECT * FROM {_REMOVED} WHERE url NOT IN (SELECT url FROM back))
SELECT d.url, coalesce(k.removed_at, TIMESTAMP '2031-06-01 00:00:00') AS removed_at FROM doomed d LEFT JOIN kept k ON d.url = k.url UNION ALL SELECT url, removed_at FROM kept WHERE url NOT IN (SELECT url FROM doomed)""")
def removal_records(spark, t):
    h = t("health_items").filter("url IS NOT NULL").withColumn("verdict", F.when(F.col("http_status").isin(404, 410), "candidate_remove").when(F.col("status") == "probe_ok", "keep").otherwise("other")).withColumn("decisive_failures", F.lit(3))
    old = h.filter("check_id % 3 = 0").groupBy("url").agg(F.min("checked_at").alias("removed_at"), F.max("name").alias("name"))
    for c, kind in (("category", "string"), ("host", "string"), ("source", "string"), ("source_line", "int"), ("failure_class", "string"), ("http_status", "int"), ("evidence", "string"), ("decisive_failures", "int"), ("last_checked", "timestamp_ntz")):
        old = old.withColumn(c, F.lit(None).cast(kind))
    return state.removal_records(h, old, F.lit("2031-06-01 00:00:00").cast("timestamp_ntz")).select("url", "removed_at")


@query(f"SELECT url FROM {_REMOVED} WHERE url NOT IN (SELECT url FROM health_items WHERE kind = 'channel' AND url IS NOT NULL AND attempts > 1) AND NOT {_INTERNAL}")
def removed_to_recheck(spark, t):
    h = t("health_items").filter("url IS NOT NULL")
    return state.to_recheck(h.filter("check_id % 3 = 0").select("url").distinct(), h.filter("attempts > 1"))


_GATES = " OR ".join(f"contains(lower(detail), '{g}')" for g in checks.GATES)
_SOFT_TEXT = f"coalesce(regexp_matches(lower(detail), '{health.SOFT_CODE}') OR {' OR '.join(f'''contains(lower(detail), '{x}')''' for x in health.SOFT_TEXTS)} OR {_GATES}, false)"


@query(f"SELECT check_id, {_SOFT_TEXT} AS soft, CASE WHEN coalesce(http_status < 400, false) THEN '' WHEN coalesce(http_status IN (404, 410), false) AND NOT {_SOFT_TEXT} THEN 'hard' ELSE 'soft' END AS class FROM health_items")
def http_classes(spark, t):
    return t("health_items").select("check_id", checks.soft_text(F.col("detail")).alias("soft"), checks.http_class(F.col("http_status"), F.col("detail")).alias("class"))


_ANSWERS = f"""SELECT check_id, url, CASE WHEN check_id % 13 = 0 THEN 'site' WHEN check_id % 17 = 0 THEN 'source' ELSE kind END AS kind, CASE WHEN check_id % 13 = 0 AND check_id % 2 = 0 THEN 'requires_app' WHEN check_id % 17 = 0 AND check_id % 3 = 0 THEN 'invalid_config' ELSE status END AS status, http_status, content_type, detail,
  CASE check_id % 6 WHEN 0 THEN '#EXTM3U' || chr(10) || '#EXT-X-STREAM-INF:B=1' || chr(10) || 'a' WHEN 1 THEN '#extm3u' || chr(10) || 'seg.ts' WHEN 2 THEN '{{"msg": "x"}}' WHEN 3 THEN '  <html>' WHEN 4 THEN 'FLV data' ELSE '' END AS body, CASE check_id % 4 WHEN 0 THEN 'probe_ok' WHEN 1 THEN 'probe_failed' WHEN 2 THEN 'manifest_ok' ELSE 'playback_unverified' END AS probed FROM ({_SHIFTED})"""
_PATH = "lower(split_part(url, '?', 1))"
_STREAM = "coalesce(kind IN ('live', 'channel'), false)"
_ENDS = lambda names: f"coalesce(regexp_matches({_PATH}, '(?:{'|'.join(n.replace('.', chr(92) + '.') for n in names)})$'), false)"
_ROUTE = f"""CASE WHEN {_STREAM} AND {_INTERNAL} THEN 'skip_internal' WHEN kind = 'source' AND status IN ('invalid_config', 'invalid_placeholder') THEN 'config' WHEN kind = 'site' AND status = 'requires_app' AND NOT coalesce(regexp_matches(lower(url), '^https?://'), false) THEN 'builtin'
  WHEN http_status IS NULL THEN 'no_answer' WHEN http_status >= 400 THEN 'http_error' WHEN NOT {_STREAM} THEN CASE WHEN kind = 'site' AND status = 'requires_app' THEN 'app' ELSE 'reachable' END WHEN {_ENDS(checks.LISTS)} THEN 'list'
  WHEN contains(upper(body), '#EXTM3U') AND NOT {_ENDS([*checks.LISTS, *checks.MEDIA])} THEN 'bare_hls' WHEN contains(upper(body), '#EXTM3U') OR coalesce(contains(lower(content_type), 'mpegurl'), false) THEN CASE WHEN contains(upper(body), '#EXT-X-STREAM-INF') THEN 'master' ELSE 'media_playlist' END
  WHEN {_ENDS(checks.MEDIA)} OR (ltrim(body) <> '' AND NOT regexp_matches(ltrim(body), '^[<{{\\[]')) THEN 'media' ELSE 'unknown' END"""
_TRIED = "route IN ('list', 'bare_hls', 'master', 'media_playlist', 'media')"


@query(f"""WITH a AS (SELECT *, {_ROUTE} AS route FROM ({_ANSWERS})),
b AS (SELECT *, CASE WHEN route = 'skip_internal' THEN 'skip_internal' WHEN route IN ('config', 'builtin') THEN status WHEN route IN ('no_answer', 'http_error') THEN 'http_error' WHEN route = 'app' THEN 'requires_app' WHEN route = 'reachable' THEN 'reachable' WHEN {_TRIED} THEN probed ELSE 'playback_unverified' END AS new_status FROM a)
SELECT check_id, route, new_status, CASE WHEN route = 'no_answer' THEN 'soft' WHEN route = 'http_error' THEN CASE WHEN http_status IN (404, 410) AND NOT {_SOFT_TEXT} THEN 'hard' ELSE 'soft' END WHEN {_TRIED} AND new_status IN ('probe_failed', 'manifest_ok') AND {_SOFT_TEXT} THEN 'soft' WHEN {_TRIED} AND new_status = 'probe_failed' THEN 'hard' ELSE '' END AS new_class FROM b""")
def check_routes(spark, t):
    i = F.col("check_id")
    body = F.when(i % 6 == 0, "#EXTM3U\n#EXT-X-STREAM-INF:B=1\na").when(i % 6 == 1, "#extm3u\nseg.ts").when(i % 6 == 2, '{"msg": "x"}').when(i % 6 == 3, "  <html>").when(i % 6 == 4, "FLV data").otherwise("")
    probed = F.when(i % 4 == 0, "probe_ok").when(i % 4 == 1, "probe_failed").when(i % 4 == 2, "manifest_ok").otherwise("playback_unverified")
    status = F.when((i % 13 == 0) & (i % 2 == 0), "requires_app").when((i % 17 == 0) & (i % 3 == 0), "invalid_config").otherwise(F.col("status"))
    kind = F.when(i % 13 == 0, "site").when(i % 17 == 0, "source").otherwise(F.col("kind"))
    rows = _shifted(t).select("check_id", "url", kind.alias("kind"), status.alias("status"), "http_status", "content_type", "detail", body.alias("body"))
    return checks.check_outcome(rows, probed).select("check_id", "route", "new_status", "new_class")


@query(f"""WITH a AS (SELECT row_id, check_id, CASE WHEN status = 'probe_ok' AND coalesce(detail, '') <> '' THEN 'probe_ok' WHEN check_id % 11 = 0 THEN 'playback_unverified' WHEN status <> 'probe_ok' AND {_SOFT_TEXT} THEN 'manifest_ok' END AS k FROM (SELECT row_id, check_id, detail, coalesce(status, '') AS status FROM health_items))
SELECT row_id, coalesce(arg_min(k, check_id) FILTER (WHERE k IS NOT NULL), 'probe_failed') AS status, coalesce(min(check_id) FILTER (WHERE k IS NOT NULL), max(check_id)) AS tries FROM a GROUP BY row_id""")
def probe_outcomes(spark, t):
    ok = F.coalesce(F.col("status") == "probe_ok", F.lit(False))
    rows = t("health_items").select("row_id", "check_id", F.when(ok & (F.coalesce("detail", F.lit("")) != ""), 0).when(F.col("check_id") % 11 == 0, 139).otherwise(1).alias("code"), F.when(ok, F.col("detail")).alias("output"), F.when(~ok, F.col("detail")).alias("error"))
    return checks.probe_outcomes(rows, "row_id", "check_id")


@query("SELECT check_id, kind, status, http_status FROM health_items")
def health_report(spark, t):
    return checks.report(t("health_items").withColumn("name", F.col("check_id"))).select(F.col("name").alias("check_id"), "kind", "status", "http_status")


@query(f"SELECT check_id, {_HOST} AS host FROM health_items WHERE url IS NOT NULL AND NOT {_INTERNAL} AND (http_status IS NULL OR http_status >= 400)")
def failing_hosts(spark, t):
    return t("health_items").filter(F.col("url").isNotNull() & ~urls.is_internal(F.col("url")) & (F.col("http_status").isNull() | (F.col("http_status") >= 400))).select("check_id", urls.host(F.col("url")).alias("host"))


@query("SELECT url, string_agg(strftime(checked_at, '%Y%m%d%H%M%S') || ':' || check_id, ',' ORDER BY checked_at, check_id) AS recent FROM (SELECT url, checked_at, check_id, row_number() OVER (PARTITION BY url ORDER BY checked_at DESC, check_id DESC) AS rn FROM health_items WHERE url IS NOT NULL AND checked_at IS NOT NULL) WHERE rn <= 3 GROUP BY url")
def recent_checks(spark, t):
    rows = state.recent(t("health_items").filter("url IS NOT NULL AND checked_at IS NOT NULL"), "url", ["checked_at", "check_id"])
    return rows.select("url", F.array_join(F.transform("recent", lambda x: F.concat(F.date_format(x["checked_at"], "yyyyMMddHHmmss"), F.lit(":"), x["check_id"])), ",").alias("recent"))


@query(f"SELECT id AS check_id, CAST(userinfo AS INT) + CAST(query AS INT) + CAST(value AS INT) + CAST(header AS INT) + CAST(bearer AS INT) AS found, false AS left FROM ({SQL['credential_findings']}) WHERE id IN (SELECT check_id FROM health_items) AND header")
def guarded_report(spark, t):
    """Texts with credentials, before the gate and behind it."""
    rows = publish.findings(_spiked(t)).select("check_id", F.size("findings").alias("found"))
    behind = publish.findings(publish.guarded(_spiked(t))).select("check_id", (F.exists("findings", lambda x: x.contains("userinfo") | x.contains("query"))).alias("left"))
    return rows.join(behind, "check_id")
