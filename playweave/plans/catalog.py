"""Registry of the core queries and their DuckDB SQL. Every query runs over its whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from playweave.functions import payload, text, urls
from playweave.operators import dedup, health, ordered, ranking
from playweave.operators import ledger as ledgers
from playweave.plans.registry import QUERIES, SQL, query

#: An address without the blanks of any kind around it, in SQL.
_URL = r"regexp_replace(url, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')"
MIRRORS = ["https://mirror.example/", "https://raw.lowmoor.example/"]


# --- ledger and inventories

@query("""SELECT channel_key, arg_min(name, row_id) FILTER (WHERE true) AS first_name, count(*) AS line_count, array_to_string(list_sort(list(DISTINCT source)), '|') AS sources,
  coalesce(array_to_string(list_sort(list(DISTINCT protocol) FILTER (WHERE protocol IS NOT NULL)), '|'), '') AS protocols, count(DISTINCT group_raw) AS groups
  FROM (SELECT row_id, channel_key, coalesce(name, '') AS name, source, protocol, group_raw FROM channels) WHERE channel_key IS NOT NULL GROUP BY channel_key""")
def ledger(spark, t):
    c = t("channels").withColumn("name", F.coalesce("name", F.lit("")))
    out = ledgers.ledger(c)
    return out.select("channel_key", F.col("name").alias("first_name"), "line_count", F.array_join("sources", "|").alias("sources"), F.array_join("protocols", "|").alias("protocols"), F.size("groups_raw").cast("bigint").alias("groups"))


@query("SELECT count(*) AS keys, count(*) FILTER (WHERE n > 1) AS multi_line, CAST(max(n) AS BIGINT) AS largest FROM (SELECT channel_key, count(*) AS n FROM channels WHERE channel_key IS NOT NULL GROUP BY channel_key)")
def multi_line_summary(spark, t):
    n = t("channels").filter("channel_key IS NOT NULL").groupBy("channel_key").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("multi_line"), F.max("n").alias("largest"))


@query("SELECT row_id, sha256(url) AS url_hash, source, coalesce(quality, '') AS quality FROM channels WHERE channel_key IS NOT NULL AND url IS NOT NULL")
def ledger_lines(spark, t):
    return ledgers.ledger_lines(t("channels")).filter("line.url IS NOT NULL").select("row_id", "line.url_hash", "line.source", F.coalesce("line.quality", F.lit("")).alias("quality"))


@query("""SELECT kind, status, count(*) AS n, count(DISTINCT url) AS urls FROM (
  SELECT 'source' AS kind, status, effective_url AS url FROM source_results UNION ALL
  SELECT 'site', 'unverified', json_extract_string(j, '$.api') FROM (SELECT unnest(sites) AS j FROM source_results) UNION ALL
  SELECT 'live', 'unverified', json_extract_string(j, '$.url') FROM (SELECT unnest(lives) AS j FROM source_results)) GROUP BY kind, status""")
def inventory_union(spark, t):
    return ledgers.inventory(t("source_results")).groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls"))


@query("SELECT source, count(*) AS results, sum(coalesce(len(sites), 0))::BIGINT AS sites, sum(coalesce(len(lives), 0))::BIGINT AS lives, sum(bytes)::BIGINT AS bytes FROM source_results GROUP BY source")
def source_manifest(spark, t):
    n = lambda c: F.sum(F.when(F.col(c).isNotNull(), F.size(c)).otherwise(0)).cast("bigint")
    return t("source_results").groupBy("source").agg(F.count(F.lit(1)).alias("results"), n("sites").alias("sites"), n("lives").alias("lives"), F.sum("bytes").alias("bytes"))


RULES = [("name", "HD|FHD|4K", "wide"), ("name", "Sport|Arena", "sport"), ("group_name", "^[A-Za-z ]+$", "latin group"), ("group_name", "[0-9]", "numbered"), ("url", "^rt[ms]p", "push")]


@query("""SELECT row_id, CASE WHEN regexp_matches(name, 'HD|FHD|4K') THEN 'wide' WHEN regexp_matches(name, 'Sport|Arena') THEN 'sport' WHEN regexp_matches(group_name, '^[A-Za-z ]+$') THEN 'latin group'
  WHEN regexp_matches(group_name, '[0-9]') THEN 'numbered' WHEN regexp_matches(url, '^rt[ms]p') THEN 'push' ELSE 'unsorted' END AS category FROM channels""")
def classify_cascade(spark, t):
    c = t("channels")
    return c.select("row_id", ledgers.classify({k: F.col(k) for k in ("name", "group_name", "url")}, RULES, "unsorted").alias("category"))


@query(f"SELECT category, count(*) AS n FROM ({SQL['classify_cascade']}) GROUP BY category")
def category_counts(spark, t):
    return ledgers.counts(classify_cascade(spark, t), "category")


# --- de-duplication

@query(f"SELECT url, row_id, name FROM (SELECT url, row_id, name, row_number() OVER (PARTITION BY url ORDER BY row_id) AS rn FROM (SELECT {_URL} AS url, row_id, name FROM channels) WHERE regexp_matches(url, '^https?://')) WHERE rn = 1")
def first_wins_dedup(spark, t):
    c = t("channels").select(urls.trimmed(F.col("url")).alias("url"), "row_id", "name").filter(F.col("url").rlike("^https?://"))
    return dedup.keep_first(c, [F.col("url")], [F.col("row_id")])


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def reverse_dedup_last(spark, t):
    o = t("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return dedup.keep_first(o, [F.col("o_custkey")], [F.col("o_orderdate"), F.col("o_orderkey")], last=True).drop("o_orderdate")


@query("SELECT channel_key, min(row_id) AS first_ord, " + ", ".join(f"arg_min({c}, row_id) FILTER (WHERE trim({c}) <> '') AS {c}" for c in ("logo", "tvg_id", "quality")) + " FROM channels WHERE channel_key IS NOT NULL GROUP BY channel_key")
def coalesce_dedup(spark, t):
    return dedup.coalesce_fields(t("channels").filter("channel_key IS NOT NULL"), "channel_key", ["logo", "tvg_id", "quality"], "row_id")


@query("SELECT digest, doc_id FROM (SELECT sha256(replace(text, chr(13) || chr(10), chr(10))) AS digest, doc_id, row_number() OVER (PARTITION BY sha256(replace(text, chr(13) || chr(10), chr(10))) ORDER BY length(coalesce(title, '')), doc_id) AS rn FROM documents WHERE text IS NOT NULL) WHERE rn = 1")
def content_dedup_min_rank(spark, t):
    docs = t("documents").filter("text IS NOT NULL").select(payload.text_digest(F.col("text")).alias("digest"), "doc_id", F.length(F.coalesce("title", F.lit(""))).alias("n"))
    return dedup.by_content(docs, F.col("digest"), [F.col("n"), F.col("doc_id")]).select("digest", "doc_id")


@query()
def plugin_files_dedup(spark, t):
    """One name for each different plugin file, the first by rank; whether it is a valid plugin is told once for each content."""
    files = t("source_results").select(F.explode("python_files").alias("name", "data")).filter("data IS NOT NULL").withColumn("digest", payload.content_digest(F.col("data")))
    names = files.groupBy("digest").agg(F.min(payload.name_rank(F.col("name")))["name"].alias("name"))
    valid = files.dropDuplicates(["digest"]).select("digest", payload.is_plugin("data").alias("valid"))
    return names.join(valid, "digest").select("digest", "name", "valid")


@query(r"""SELECT name, count(*) AS copies, min(octet_length(data)) AS least, max(octet_length(data)) AS most FROM (SELECT unnest(map_keys(python_files)) AS name, unnest(map_values(python_files)) AS data FROM source_results) WHERE data IS NOT NULL GROUP BY name""")
def plugin_names(spark, t):
    files = t("source_results").select(F.explode("python_files").alias("name", "data")).filter("data IS NOT NULL")
    return files.groupBy("name").agg(F.count(F.lit(1)).alias("copies"), F.min(F.octet_length("data")).cast("bigint").alias("least"), F.max(F.octet_length("data")).cast("bigint").alias("most"))


@query("SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY p_brand, p_name HAVING count(*) > 1")
def validate_unique(spark, t):
    return ledgers.counts(t("part"), "p_brand", "p_name").filter("n > 1")


# --- addresses and text

@query(r"SELECT lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host, count(*) AS n FROM health_items WHERE url IS NOT NULL GROUP BY 1")
def host_counts(spark, t):
    return t("health_items").filter("url IS NOT NULL").groupBy(urls.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT check_id, sha256(url) AS digest, sha256(url) = url_hash AS same FROM health_items WHERE url IS NOT NULL")
def url_digest(spark, t):
    return t("health_items").filter("url IS NOT NULL").select("check_id", urls.digest(F.col("url")).alias("digest"), (urls.digest(F.col("url")) == F.col("url_hash")).alias("same"))


@query("SELECT result_id, CASE WHEN regexp_matches(u, '^https://mirror[.]example/https?://') THEN substr(u, 24) ELSE u END AS url FROM (SELECT result_id, CASE WHEN result_id % 2 = 0 THEN 'https://mirror.example/' || effective_url ELSE effective_url END AS u FROM source_results)")
def proxy_strip(spark, t):
    r = t("source_results").select("result_id", F.when(F.col("result_id") % 2 == 0, F.concat(F.lit("https://mirror.example/"), "effective_url")).otherwise(F.col("effective_url")).alias("u"))
    return r.select("result_id", urls.strip_proxy(F.col("u"), MIRRORS[:1]).alias("url"))


@query(r"""SELECT row_id, CASE WHEN kept <> '' THEN place || '?' || kept ELSE place END AS url FROM (SELECT row_id, regexp_extract(b, '^([^?]*)', 1) AS place,
  array_to_string(list_filter(string_split(regexp_extract(b, '(?s)\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_replace(lower(url_decode(regexp_extract(p, '^([^=]*)', 1))), '[^a-z0-9]', '', 'g') IN (""" + ", ".join(f"'{n}'" for n in urls.SENSITIVE_NAMES) + r""")), '&') AS kept
  FROM (SELECT row_id, regexp_replace(regexp_replace(""" + _URL + r""", '(?s)#.*$', ''), '^([A-Za-z][A-Za-z0-9+.\-]*://)[^/?@]*@', '\1') AS b FROM channels))""")
def safe_url(spark, t):
    return t("channels").select("row_id", urls.safe(F.col("url")).alias("url"))


@query("SELECT row_id, CASE WHEN n LIKE '%8k%' THEN '8K' WHEN regexp_matches(n, '4k|uhd') THEN '4K' WHEN regexp_matches(n, '超高清|超清') THEN '超清' WHEN regexp_matches(n, '1080p|fhd') THEN '1080P' WHEN regexp_matches(n, '720p') THEN '720P' WHEN regexp_matches(n, '高清|hd') THEN '高清' WHEN n LIKE '%标清%' THEN '标清' ELSE '' END AS label FROM (SELECT row_id, lower(name) AS n FROM channels WHERE name IS NOT NULL)")
def quality_label(spark, t):
    return t("channels").filter("name IS NOT NULL").select("row_id", text.quality(F.col("name")).alias("label"))


_FOLDED = f"trim(regexp_replace(translate(replace(name, '　', ' '), '{text.TRADITIONAL}', '{text.SIMPLIFIED}'), '[ \\t\\n\\r]+', ' ', 'g'))"
_CUT = f"regexp_replace(regexp_replace({_FOLDED}, '(?i)(?:[ \\-_·]*(?:{text.SUFFIX}))+[ \\-_·]*$', ''), '^[ \\-_·]+|[ \\-_·]+$', '', 'g')"


@query(f"SELECT row_id, CASE WHEN c <> '' THEN c ELSE trim(name) END AS folded FROM (SELECT row_id, name, {_CUT} AS c FROM channels)")
def name_normalise(spark, t):
    return t("channels").select("row_id", text.fold_name(F.col("name")).alias("folded"))


@query(f"SELECT row_id, replace(regexp_replace(lower(folded), '{text.SEPARATORS}', '', 'g'), 'ς', 'σ') AS identity FROM ({SQL['name_normalise']})")
def name_identity(spark, t):
    # At the end of a word the lower-case sigma has a form of its own, which the SQL's lower does not know.
    return t("channels").select("row_id", F.translate(text.identity(F.col("name")), "ς", "σ").alias("identity"))


def _redacted(c: str) -> str:
    out = rf"regexp_replace({c}, '{text.USERINFO}', '\1<redacted>@', 'g')"
    out = rf"""regexp_replace({out}, '([?&;])((?i:{urls.NAME_PATTERN}))=([^&#\s"''<>]*)', '\1\2=<redacted>', 'g')"""
    return rf"regexp_replace(regexp_replace({out}, '{text.HEADER}', '\1: <redacted>', 'g'), '{text.BEARER}', 'Bearer <redacted>', 'g')"


#: Texts with every form of credential made out of the tables' own values: addresses with userinfo and parameters, headers, bearer values.
_SPIKED = """SELECT check_id, coalesce(detail, '') || ' see https://u' || check_id || ':p' || row_id || '@' || coalesce(host, 'h') || '/a?id=' || row_id || '&access_token=' || url_hash || ';sign=' || check_id || ' Authorization: tok' || check_id || ' then Bearer ' || url_hash || ' secret=' || coalesce(status, 'null') AS text FROM health_items"""


def _spiked(t):
    parts = [F.coalesce("detail", F.lit("")), F.lit(" see https://u"), F.col("check_id"), F.lit(":p"), F.col("row_id"), F.lit("@"), F.coalesce("host", F.lit("h")), F.lit("/a?id="), F.col("row_id"), F.lit("&access_token="), F.col("url_hash"), F.lit(";sign="), F.col("check_id"), F.lit(" Authorization: tok"), F.col("check_id"), F.lit(" then Bearer "), F.col("url_hash"), F.lit(" secret="), F.coalesce("status", F.lit("null"))]
    return t("health_items").select("check_id", F.concat(*parts).alias("text"))


@query(f"SELECT doc_id AS id, {_redacted('text')} AS redacted FROM documents UNION ALL SELECT check_id, {_redacted('text')} FROM ({_SPIKED})")
def redact_text(spark, t):
    rows = t("documents").select(F.col("doc_id").alias("id"), "text").unionByName(_spiked(t).withColumnRenamed("check_id", "id"))
    return rows.select("id", text.redact_places(F.col("text")).alias("redacted"))


@query()
def redact_pairs(spark, t):
    """Bare pairs too: their rule looks back and ahead, which the SQL's regular expressions cannot."""
    return _spiked(t).select("check_id", text.redact(F.col("text")).alias("redacted"))


_V = r"""regexp_replace(v, '^[\s"'']+|[\s"'']+$', '', 'g')"""
_MEANS = f"(lower({_V}) NOT IN ({', '.join(repr(x) for x in text.PUBLIC)}) AND NOT regexp_matches({_V}, '{text.PLACEHOLDER}') AND length({_V}) >= 3)"
_SOME = lambda pattern: "len(list_filter(regexp_extract_all(d, '" + pattern.replace("'", "''") + f"', 2), lambda v: {_MEANS})) > 0"


@query(f"""SELECT id, regexp_matches(d, '{text.USERINFO}') AS userinfo, {_SOME(text.PARAMETER)} AS query, {_SOME(text.PAIR)} AS value, regexp_matches(d, '{text.HEADER}') AS header, regexp_matches(d, '{text.BEARER}') AS bearer
  FROM (SELECT doc_id AS id, replace(url_decode(replace(text, '+', '%2B')), '<redacted>@', '') AS d FROM documents WHERE text IS NOT NULL UNION ALL SELECT check_id, replace(url_decode(replace(text, '+', '%2B')), '<redacted>@', '') FROM ({_SPIKED}) WHERE text IS NOT NULL UNION ALL SELECT -check_id, replace(url_decode(replace(url, '+', '%2B')), '<redacted>@', '') FROM health_items WHERE url IS NOT NULL)""")
def credential_findings(spark, t):
    rows = t("documents").select(F.col("doc_id").alias("id"), "text").unionByName(_spiked(t).withColumnRenamed("check_id", "id")).unionByName(t("health_items").select((-F.col("check_id")).alias("id"), F.col("url").alias("text")))
    rows = rows.filter("text IS NOT NULL").select("id", text.finding_labels(F.col("text")).alias("labels"))
    return rows.select("id", *(F.array_contains("labels", k).alias(n) for n, k in (("userinfo", "url-userinfo"), ("query", "query"), ("value", "value"), ("header", "credential-header"), ("bearer", "bearer-token"))))


@query("""SELECT doc_id, upper(substr(text, 1, 2048)) LIKE '%#EXTM3U%' AS m3u,
  len(list_filter(l, lambda x: regexp_matches(x, '(?i)^[^,#]+,\\s*(?:https?|rtmp|rtsp|rtp|udp)://') OR contains(x, ',#genre#'))) >= greatest(1, least(3, len(l) // 4)) AS txt
  FROM (SELECT doc_id, text, list_filter(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)), lambda x: trim(x) <> '')[1:300] AS l FROM documents WHERE text IS NOT NULL)""".replace("\\\\", "\\"))
def txt_m3u_sniff(spark, t):
    d = t("documents").filter("text IS NOT NULL")
    return d.select("doc_id", text.looks_like_m3u(F.col("text")).alias("m3u"), text.looks_like_txt(F.col("text")).alias("txt"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, t):
    return t("events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("SELECT result_id, json_extract_string(j, '$.key') AS site_key, json_extract_string(j, '$.api') AS api, NOT contains(j, '{{SECRET_') AS resolved FROM (SELECT result_id, unnest(sites) AS j FROM source_results)")
def site_objects(spark, t):
    s = t("source_results").select("result_id", F.explode("sites").alias("j"))
    return s.select("result_id", F.get_json_object("j", "$.key").alias("site_key"), F.get_json_object("j", "$.api").alias("api"), (~F.contains("j", F.lit("{{SECRET_"))).alias("resolved"))


# --- joins and sets

@query(f"SELECT row_id, {_URL} AS url FROM channels WHERE url IS NOT NULL AND {_URL} NOT IN (SELECT {_URL} FROM streaks WHERE url IS NOT NULL AND fail_count >= 1)")
def dead_anti_join(spark, t):
    dead = t("streaks").filter("fail_count >= 1").select(urls.trimmed(F.col("url")).alias("url")).filter("url IS NOT NULL").distinct()
    return t("channels").filter("url IS NOT NULL").select("row_id", urls.trimmed(F.col("url")).alias("url")).join(dead, "url", "left_anti").select("row_id", "url")


@query("SELECT check_id, host FROM health_items WHERE host = 'veltra.example' OR host LIKE '%.veltra.example' OR host = 'cdn1.ostrel.test' OR host LIKE '%.cdn1.ostrel.test'")
def whitelist_semi_suffix(spark, t):
    return health.on_whitelist(t("health_items").filter("host IS NOT NULL"), F.col("host"), ["veltra.example", "cdn1.ostrel.test"]).select("check_id", "host")


@query("SELECT h.check_id, h.status, c.quality, c.source_section FROM health_items h LEFT JOIN channels c ON h.row_id = c.row_id")
def ledger_enrich_left(spark, t):
    c = t("channels").select("row_id", "quality", "source_section")
    return t("health_items").join(c, "row_id", "left").select("check_id", "status", "quality", "source_section")


@query("SELECT user_id FROM events WHERE event_type = 'error' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90")
def removed_except(spark, t):
    e = t("events")
    return e.filter("event_type = 'error'").select("user_id").subtract(e.filter("event_type = 'purchase' AND value > 90").select("user_id"))


@query("SELECT user_id FROM events WHERE event_type = 'error' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90")
def recovered_intersect(spark, t):
    e = t("events")
    return e.filter("event_type = 'error'").select("user_id").intersect(e.filter("event_type = 'purchase' AND value > 90").select("user_id"))


@query("SELECT o.o_orderkey, CASE o.o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS rank FROM orders o")
def rank_join_order(spark, t):
    ranks = spark.createDataFrame([("O", 0), ("P", 1), ("F", 2)], "o_orderstatus string, rank int")
    return t("orders").join(F.broadcast(ranks), "o_orderstatus", "left").select("o_orderkey", F.coalesce("rank", F.lit(3)).alias("rank"))


# --- health

_DETAIL = "lower(detail)"
_SOFT = f"(coalesce(http_status IN ({', '.join(map(str, health.SOFT_STATUSES))}), false) OR coalesce(http_status >= 500, false) OR coalesce(failure_class = 'soft', false) OR coalesce(regexp_matches({_DETAIL}, '{health.SOFT_CODE}') OR " + " OR ".join(f"contains({_DETAIL}, '{x}')" for x in health.SOFT_TEXTS) + ", false))"
_OWN = "coalesce(status IN ('probe_failed', 'invalid_config', 'invalid_placeholder'), false)"
_GONE = "coalesce(http_status IN (404, 410), false)"
_DECISIVE = f"(coalesce(kind = 'live', false) AND ({_OWN} OR coalesce(status = 'http_error', false)) AND NOT coalesce(failure_class IN ('soft', 'internal', 'unverified'), false) AND NOT {_SOFT} AND CASE WHEN failure_class = 'hard' THEN {_GONE} OR {_OWN} WHEN {_GONE} THEN true WHEN http_status >= 400 THEN false ELSE {_OWN} END)"


@query("SELECT status, count(*) AS n FROM health_items GROUP BY status")
def status_counts(spark, t):
    return ledgers.counts(t("health_items"), "status")


@query("SELECT check_id, url, status FROM health_items WHERE status IN ('http_error', 'probe_failed', 'invalid_config')")
def blocked_filter(spark, t):
    return t("health_items").filter(F.col("status").isin("http_error", "probe_failed", "invalid_config")).select("check_id", "url", "status")


@query(f"SELECT check_id, {_SOFT} AS soft, {_DECISIVE} AS decisive FROM health_items")
def soft_decisive_failure(spark, t):
    return t("health_items").select("check_id", health.soft_failure().alias("soft"), health.decisive_failure().alias("decisive"))


@query(f"SELECT url, count(*) AS attempts, CASE WHEN bool_or(coalesce(http_status < 400, false)) THEN 'reachable' WHEN bool_and({_GONE} AND NOT {_SOFT}) THEN 'hard' ELSE 'soft' END AS verdict FROM health_items GROUP BY url")
def http_verdict(spark, t):
    return health.attempts_verdict(t("health_items"), "url")


_FOLD = f"SELECT check_id, url, checked_at, CAST(sum(CASE WHEN {_DECISIVE} THEN 1 ELSE 0 END) OVER (PARTITION BY url, g ORDER BY checked_at, check_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM (SELECT *, sum(CASE WHEN coalesce(status = 'probe_ok', false) THEN 1 ELSE 0 END) OVER (PARTITION BY url ORDER BY checked_at, check_id ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT * FROM health_items WHERE url IS NOT NULL AND checked_at IS NOT NULL))"


def _checks(t):
    return t("health_items").filter("url IS NOT NULL AND checked_at IS NOT NULL")


def _reset():
    return F.coalesce(F.col("status") == "probe_ok", F.lit(False))


@query(f"SELECT check_id, streak FROM ({_FOLD})")
def streak_fold(spark, t):
    return health.streak_fold(_checks(t), "url", ["checked_at", "check_id"], health.decisive_failure(), _reset()).select("check_id", "streak")


@query(f"SELECT url, arg_max(streak, (epoch_us(checked_at)::HUGEINT * 1000000000 + check_id)) AS streak, arg_max(streak, (epoch_us(checked_at)::HUGEINT * 1000000000 + check_id)) >= 3 AS removable FROM ({_FOLD}) GROUP BY url")
def streak_latest_removable(spark, t):
    return health.streak_state(_checks(t), "url", ["checked_at", "check_id"], health.decisive_failure(), _reset())


@query("SELECT url, check_id, rn FROM (SELECT url, check_id, CAST(row_number() OVER (PARTITION BY url ORDER BY checked_at DESC, check_id DESC) AS INT) AS rn FROM health_items WHERE url IS NOT NULL AND checked_at IS NOT NULL) WHERE rn <= 3")
def history_last3(spark, t):
    return health.history(_checks(t), "url", [F.desc("checked_at"), F.desc("check_id")]).select("url", "check_id", "rn")


_INCIDENT = "SELECT host FROM health_items WHERE host <> '' AND kind IN ('channel', 'live') GROUP BY host HAVING count(*) >= 6 AND count(*) FILTER (WHERE f) >= 6 AND count(*) FILTER (WHERE f) * 2 >= count(*) AND count(*) FILTER (WHERE f AND failure_class = 'hard') >= 3 AND count(*) FILTER (WHERE f AND failure_class = 'hard') * 2 >= count(*)".replace("WHERE f", "WHERE status IN ('http_error', 'probe_failed')")


@query(f"SELECT check_id, CASE WHEN host IN ({_INCIDENT}) AND status IN ('http_error', 'probe_failed') AND kind IN ('channel', 'live') THEN 'upstream_incident' ELSE status END AS status FROM health_items")
def circuit_breaker(spark, t):
    return health.circuit_breaker(t("health_items")).select("check_id", "status")


@query("SELECT host, count(*) AS rows, count(*) FILTER (WHERE status IN ('http_error', 'probe_failed')) AS failures FROM health_items WHERE host <> '' AND kind IN ('channel', 'live') GROUP BY host HAVING count(*) >= 6 AND count(*) FILTER (WHERE status IN ('http_error', 'probe_failed')) * 8 >= count(*)")
def host_failure_share(spark, t):
    h = t("health_items").filter("host <> '' AND kind IN ('channel', 'live')").groupBy("host").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("status").isin("http_error", "probe_failed")).alias("failures"))
    return h.filter("rows >= 6 AND failures * 8 >= rows")


_HARD = f"(coalesce(failure_class = 'hard', false) AND NOT coalesce(status = 'upstream_incident', false) AND NOT {_SOFT})"


_HOST = r"lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
_INTERNAL = rf"coalesce(regexp_matches({_HOST}, '^(?:0|10|127)\.\d+\.\d+\.\d+$|^192\.168\.\d+\.\d+$|^172\.(?:1[6-9]|2\d|3[01])\.\d+\.\d+$|^169\.254\.\d+\.\d+$|^2[4-5]\d\.\d+\.\d+\.\d+$|^localhost$') OR {' OR '.join(f"suffix({_HOST}, '{x}')" for x in urls.INTRANET_SUFFIXES)} OR {' OR '.join(f"contains({_HOST}, '{x}')" for x in urls.INTRANET_MARKERS)}, false)"
#: Every tenth address of the table made an internal one, so that each rule is met.
_SHIFTED = "SELECT * REPLACE (CASE check_id % 10 WHEN 0 THEN 'http://192.168.1.' || (check_id % 250) || ':80/a' WHEN 1 THEN 'http://rrs03.hw.gmcc.net/' || check_id WHEN 2 THEN 'http://10.0.0.1/x' ELSE url END AS url) FROM health_items"


def _shifted(t):
    moved = F.when(F.col("check_id") % 10 == 0, F.concat(F.lit("http://192.168.1."), F.col("check_id") % 250, F.lit(":80/a"))).when(F.col("check_id") % 10 == 1, F.concat(F.lit("http://rrs03.hw.gmcc.net/"), "check_id")).when(F.col("check_id") % 10 == 2, "http://10.0.0.1/x")
    return t("health_items").withColumn("url", moved.otherwise(F.col("url")))


@query(f"SELECT check_id, {_INTERNAL} AS internal FROM ({_SHIFTED})")
def internal_hosts(spark, t):
    return _shifted(t).select("check_id", urls.is_internal(F.col("url")).alias("internal"))


@query(f"""SELECT check_id, CASE WHEN {_INTERNAL} THEN 'skip_internal' WHEN status = 'upstream_incident' THEN 'observe_upstream' WHEN host LIKE '%.veltra.example' THEN 'whitelisted' WHEN {_HARD} AND attempts >= 3 THEN 'candidate_remove' WHEN {_HARD} THEN 'observe'
  WHEN {_SOFT} OR coalesce(status IN ('playback_unverified', 'manifest_ok', 'upstream_incident', 'skip_internal'), false) THEN 'observe_soft' ELSE 'keep' END AS verdict FROM ({_SHIFTED})""")
def verdict_cascade(spark, t):
    return _shifted(t).select("check_id", health.verdict(F.col("attempts"), urls.is_internal(F.col("url")), F.coalesce(F.col("host").endswith(".veltra.example"), F.lit(False))).alias("verdict"))


@query("""SELECT coalesce(c.url, p.url) AS url, coalesce(c.status, p.status) AS status, CASE WHEN c.url IS NOT NULL THEN c.check_id ELSE p.check_id END AS check_id FROM
  (SELECT url, arg_max(status, check_id) FILTER (WHERE status IS NOT NULL) AS status, max(check_id) AS check_id FROM health_items WHERE url IS NOT NULL AND attempts <= 1 GROUP BY url) p FULL JOIN
  (SELECT url, arg_max(status, check_id) FILTER (WHERE status IS NOT NULL) AS status, max(check_id) AS check_id FROM health_items WHERE url IS NOT NULL AND attempts > 1 GROUP BY url) c ON p.url = c.url""")
def state_upsert(spark, t):
    h = t("health_items").filter("url IS NOT NULL").select("url", "status", "check_id", "attempts")
    before = dedup.keep_first(h.filter("attempts <= 1").drop("attempts"), [F.col("url")], [F.col("check_id")], last=True)
    return health.upsert_state(before, h.filter("attempts > 1").drop("attempts"), "url", ["check_id"], ["status"])


@query("SELECT status, failure_class, http_status, source, n FROM (SELECT status, failure_class, http_status, source, count(*) AS n FROM health_items WHERE failure_class IN ('hard', 'soft') GROUP BY ALL) ORDER BY n DESC, status, failure_class, http_status NULLS FIRST, source LIMIT 30")
def error_clusters_top30(spark, t):
    h = t("health_items").filter(F.col("failure_class").isin("hard", "soft"))
    return ledgers.counts(h, "status", "failure_class", "http_status", "source").orderBy(F.desc("n"), "status", "failure_class", "http_status", "source").limit(30)


@query("SELECT doc_id, substr(title, 1, 12) AS title FROM documents WHERE title IS NOT NULL ORDER BY doc_id LIMIT 120")
def pending_limit_truncate(spark, t):
    return t("documents").filter("title IS NOT NULL").orderBy("doc_id").limit(120).select("doc_id", F.substring("title", 1, 12).alias("title"))


# --- order, pages, search

@query("SELECT o_orderkey, CAST((p - 700 % n + n) % n AS BIGINT) AS pos FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS p, count(*) OVER () AS n FROM orders) WHERE (p - 700 % n + n) % n < 500")
def rotate_sample(spark, t):
    o = t("orders").select("o_orderkey", "o_orderdate")
    return ranking.rotate_sample(o, [F.col("o_orderdate"), F.col("o_orderkey")], 700, 500).select("o_orderkey", "pos")


@query("SELECT o_orderkey, CAST(ceil(n / 36.0) AS BIGINT) AS pagecount FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders) WHERE rn BETWEEN 73 AND 108")
def page_slice(spark, t):
    return ranking.page(t("orders").select("o_orderkey"), [F.col("o_orderkey")], 3, 36)


@query("SELECT source, doc_id, rn FROM (SELECT source, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC NULLS LAST, doc_id) AS INT) AS rn FROM documents) WHERE rn <= 12")
def top_per_source(spark, t):
    return ranking.top_per_group(t("documents").select("source", "doc_id", "n_chars"), ["source"], [F.desc_nulls_last("n_chars"), F.col("doc_id")], 12).select("source", "doc_id", "rn")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS group_id FROM events")
def forward_fill_group(spark, t):
    e = t("events").select("event_id", "user_id", "ts", "event_type")
    return ordered.forward_fill(e, "user_id", ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "group_id").select("event_id", "group_id")


@query("SELECT event_id, before FROM (SELECT event_id, event_type, lag(event_id) OVER w AS before, lag(event_type) OVER w AS kind FROM events WHERE event_type IN ('view', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'purchase' AND kind = 'view'")
def lag_pairing(spark, t):
    e = t("events").filter(F.col("event_type").isin("view", "purchase")).select("event_id", "user_id", "ts", "event_type")
    e = ordered.Ordered(e, "user_id", ["ts", "event_id"]).neighbour({"before": F.col("event_id"), "kind": F.col("event_type")})
    return e.filter("event_type = 'purchase' AND kind = 'view'").select("event_id", "before")


@query("SELECT event_id, CAST(epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS BIGINT) AS gap_us FROM events")
def gap_next(spark, t):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = t("events").select("event_id", "user_id", "ts", us.alias("us"))
    return ordered.Ordered(e, "user_id", ["ts", "event_id"]).neighbour({"following": F.col("us")}, after=True).select("event_id", (F.col("following") - F.col("us")).alias("gap_us"))


@query("SELECT l_orderkey, string_agg(l_linenumber || '$' || l_partkey, '#' ORDER BY l_linenumber, l_partkey) AS packed, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def pack_nested(spark, t):
    entry = F.struct("l_linenumber", "l_partkey")
    packed = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.concat_ws("$", x["l_linenumber"], x["l_partkey"])), "#")
    return t("lineitem").groupBy("l_orderkey").agg(packed.alias("packed"), F.count(F.lit(1)).alias("n"))


@query("""SELECT vec_id, arg_max(tid, s) AS template FROM (SELECT v.vec_id, q.vec_id AS tid, round(list_dot_product(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS s FROM embeddings v, embeddings q WHERE q.vec_id < 8) GROUP BY vec_id""")
def vector_best_match(spark, t):
    e = t("embeddings").select("vec_id", "embedding")
    return ranking.nearest_template(e, e.filter("vec_id < 8")).select("vec_id", "template")


@query("SELECT source, min(seen_at) AS first_seen, max(seen_at) AS last_seen, count(*) AS lines, count(DISTINCT channel_key) AS keys FROM channels GROUP BY source")
def source_activity(spark, t):
    return t("channels").groupBy("source").agg(F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"), F.count(F.lit(1)).alias("lines"), F.countDistinct("channel_key").alias("keys"))

from playweave.plans import catalog_media, catalog_sources, catalog_state, catalog_streams  # noqa: E402, F401  (they register their queries)
