"""Queries of configurations, playlists and the aggregation run, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from playweave.functions import nested, payload, text, urls
from playweave.operators import classify, configs, ledger
from playweave.operators.classify import Stage
from playweave.plans import pipelines
from playweave.plans.registry import query, trimmed_sql
from playweave.sources import playlists

_SITES = "(SELECT result_id, source, unnest(sites) AS j FROM source_results)"
_LIVES = "(SELECT result_id, source, unnest(lives) AS j FROM source_results)"
_NAME = "(?i:" + urls.NAME_PATTERN + ")"
_MEANS = lambda c: f"""(lower(regexp_replace({c}, '^[\\s"'']+|[\\s"'']+$', '', 'g')) NOT IN ({', '.join(repr(x) for x in text.PUBLIC)}) AND NOT regexp_matches(regexp_replace({c}, '^[\\s"'']+|[\\s"'']+$', '', 'g'), '{text.PLACEHOLDER}') AND length(regexp_replace({c}, '^[\\s"'']+|[\\s"'']+$', '', 'g')) >= 3)"""
_D = "replace(url_decode(replace(s, '+', '%2B')), '<redacted>@', '')"
_SOME = lambda pattern: "len(list_filter(regexp_extract_all(" + _D + ", '" + pattern.replace("'", "''") + f"', 2), lambda v: {_MEANS('v')})) > 0"
_FLAT = "regexp_replace(lower(field), '[^a-z0-9]', '', 'g')"
_RULES = {
    "field": f"({_FLAT} IN ({', '.join(repr(x) for x in urls.SENSITIVE_NAMES)}) AND {_FLAT} <> 'key' AND {_MEANS('s')})", "url-userinfo": f"regexp_matches({_D}, '{text.USERINFO}')", "query": _SOME(text.PARAMETER), "value": _SOME(text.PAIR),
    "credential-header": f"regexp_matches({_D}, '{text.HEADER}')", "bearer-token": f"regexp_matches({_D}, '{text.BEARER}')",
}
_leaves = lambda items: f"SELECT result_id, j, coalesce(CASE WHEN regexp_matches(t.fullkey, '\\]$') THEN '' ELSE t.key END, '') AS field, t.atom->>'$' AS s FROM {items}, json_tree(j) t WHERE t.type = 'VARCHAR'"
_found = lambda items: " UNION ALL ".join(f"SELECT result_id, j, '{k}' AS label FROM ({_leaves(items)}) WHERE {c}" for k, c in _RULES.items())
_SITE_FINDINGS = _found(_SITES)


@query(f"SELECT result_id, label, count(*) AS n FROM ({_SITE_FINDINGS}) GROUP BY result_id, label")
def site_findings(spark, t):
    s = t("source_results").select("result_id", F.explode("sites").alias("j")).select("result_id", F.explode(nested.credential_paths("j")).alias("f"))
    return s.groupBy("result_id", F.col("f.label").alias("label")).agg(F.count(F.lit(1)).alias("n"))


_GET = lambda f: f"trim(coalesce(json_extract_string(j, '$.{f}'), ''))"
_SITE_REASON = f"CASE WHEN {_GET('api')} = '' THEN 'no_api' WHEN regexp_matches({_GET('api')}, '{configs.PLACEHOLDER}') OR regexp_matches({_GET('ext')}, '{configs.PLACEHOLDER}') THEN 'placeholder' WHEN j IN (SELECT j FROM ({_SITE_FINDINGS})) THEN 'credentials' WHEN regexp_matches({_GET('api')}, '^\\.\\.?/') THEN 'relative' ELSE '' END"
_LIVE_REASON = f"CASE WHEN {_GET('url')} = '' THEN 'no_url' WHEN regexp_matches({_GET('url')}, '{configs.PLACEHOLDER}') THEN 'placeholder' WHEN j IN (SELECT j FROM ({_found(_LIVES)})) THEN 'credentials' WHEN regexp_matches({_GET('url')}, '^\\.\\.?/') THEN 'relative' WHEN regexp_matches({_GET('url')}, '{configs.IMAGE}') THEN 'image' ELSE '' END"


@query(f"SELECT kind, reason, count(*) AS n FROM (SELECT 'site' AS kind, {_SITE_REASON} AS reason FROM {_SITES} UNION ALL SELECT 'live', {_LIVE_REASON} FROM {_LIVES}) GROUP BY kind, reason")
def sanitised(spark, t):
    r = t("source_results")
    sites = configs.objects(r.select("result_id", "sites"), "sites", configs.site_reason).select(F.lit("site").alias("kind"), "reason")
    return sites.unionByName(configs.objects(r.select("result_id", "lives"), "lives", configs.live_reason).select(F.lit("live").alias("kind"), "reason")).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT result_id, count(*) AS sites, count(*) FILTER (WHERE reason = '') AS kept FROM (SELECT result_id, {_SITE_REASON} AS reason FROM {_SITES}) GROUP BY result_id")
def sites_kept(spark, t):
    s = configs.objects(t("source_results").select("result_id", "sites"), "sites", configs.site_reason)
    return s.groupBy("result_id").agg(F.count(F.lit(1)).alias("sites"), F.count_if(F.col("reason") == "").alias("kept"))


@query(f"SELECT result_id, s AS ref FROM ({_leaves(_SITES)}) WHERE lower(field) IN ('api', 'ext', 'jar') AND regexp_matches(s, '(?i)\\.py(?:$|[?#])')")
def plugin_references(spark, t):
    return t("source_results").select("result_id", F.explode("sites").alias("j")).select("result_id", F.explode(nested.plugin_references("j")).alias("ref"))


@query(f"SELECT result_id, s AS address FROM ({_leaves(_SITES)}) WHERE regexp_matches(s, '^https?://[^/?#]')")
def nested_addresses(spark, t):
    return t("source_results").select("result_id", F.explode("sites").alias("j")).select("result_id", F.explode(nested.addresses("j")).alias("address"))


@query(f"SELECT result_id, json_extract_string(j, '$.key') AS key, json_extract_string(j, '$.name') AS name FROM {_SITES} WHERE coalesce(json_extract_string(j, '$.key'), '') <> '' AND coalesce(json_extract_string(j, '$.name'), '') <> ''")
def nested_nodes(spark, t):
    wrapped = F.concat(F.lit('{"data":[{"list":'), F.col("j"), F.lit("},null,3]}"))
    nodes = t("source_results").select("result_id", F.explode("sites").alias("j")).select("result_id", F.explode(nested.matching_nodes([["key"], ["name"]])(wrapped)).alias("n"))
    return nodes.select("result_id", F.get_json_object("n", "$.key").alias("key"), F.get_json_object("n", "$.name").alias("name"))


_BASED = f"SELECT result_id, row_number() OVER (ORDER BY result_id) AS n, json_extract_string(j, '$.api') AS api FROM {_SITES}"


@query(f"SELECT result_id, api, CASE WHEN api LIKE 'https://%' THEN 'https://base.example/dir/x/' || regexp_extract(api, '([^/]*)$', 1) ELSE api END AS resolved FROM ({_BASED}) WHERE regexp_matches(api, '^[a-zA-Z0-9_:/.\\-]+$')")
def resolved_references(spark, t):
    """Addresses made relative, and absolute again."""
    s = t("source_results").select("result_id", F.explode("sites").alias("j")).select("result_id", F.get_json_object("j", "$.api").alias("api")).filter(F.col("api").rlike(r"^[a-zA-Z0-9_:/.\-]+$"))
    relative = F.when(F.col("api").startswith("https://"), F.concat(F.lit("../x/"), F.regexp_extract("api", r"([^/]*)$", 1))).otherwise(F.col("api"))
    back = nested.resolved_references(F.to_json(F.struct(F.array(F.struct(relative.alias("api"))).alias("sites"))), F.lit("https://base.example/dir/sub/config.json"))
    return s.select("result_id", "api", F.get_json_object(back, "$.sites[0].api").alias("resolved"))


@query()
def sites_without_credentials(spark, t):
    """Objects with every credential replaced: the rule of bare pairs looks back and ahead. No finding is left."""
    s = t("source_results").select("result_id", F.explode("sites").alias("j")).withColumn("clean", nested.without_credentials("j"))
    return s.select("result_id", F.md5("clean").alias("md5"), F.size(nested.credential_paths("clean")).alias("left"))


@query(f"""WITH s AS (SELECT result_id, j, row_number() OVER () AS n, {_GET('key')} AS k, {_GET('api')} AS a FROM {_SITES}), f AS (SELECT k, a, t.key AS field, t.value AS v, result_id, j FROM s, json_each(s.j) t WHERE t.value IS NOT NULL AND t.value::VARCHAR NOT IN ('null', '\"\"', '[]', '{{}}'))
SELECT k AS key, a AS api, count(DISTINCT field) AS fields FROM f GROUP BY k, a""")
def merged_sites(spark, t):
    rows = configs.objects(t("source_results").select("result_id", "sites"), "sites", lambda j: F.lit(""))
    merged = configs.merge_objects(rows, ["key", "api"], ["result_id", "pos"])
    g = lambda f: F.trim(F.coalesce(F.get_json_object("object", f"$.{f}"), F.lit("")))
    return merged.select(g("key").alias("key"), g("api").alias("api"), F.size(F.json_object_keys("object")).cast("bigint").alias("fields"))


@query(f"SELECT rule, count(*) AS n FROM (SELECT 'placeholder' AS rule FROM {_SITES} WHERE regexp_matches(j, '{configs.PLACEHOLDER}') UNION ALL SELECT 'placeholder' FROM {_LIVES} WHERE regexp_matches(j, '{configs.PLACEHOLDER}') UNION ALL SELECT 'credentials' FROM ({_SITE_FINDINGS}) UNION ALL SELECT 'credentials' FROM ({_found(_LIVES)}) UNION ALL SELECT 'relative' FROM {_SITES} WHERE regexp_matches(j, '\"(?:api|url)\"\\s*:\\s*\"\\.\\.?/') UNION ALL SELECT 'relative' FROM {_LIVES} WHERE regexp_matches(j, '\"(?:api|url)\"\\s*:\\s*\"\\.\\.?/') UNION ALL SELECT 'image' FROM {_LIVES} WHERE regexp_matches({_GET('url')}, '{configs.IMAGE}') UNION ALL SELECT 'repeated' FROM {_SITES} WHERE json_extract_string(j, '$.type') = '3' GROUP BY json_extract_string(j, '$.api') HAVING count(*) > 1 UNION ALL SELECT 'spider') GROUP BY rule")
def output_violations(spark, t):
    r = t("source_results")
    found = configs.violations(r.select(F.explode("sites").alias("object")), r.select(F.explode("lives").alias("object")), "http://plain.example/spider.jar")
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT count(*) AS kept FROM {_SITES} WHERE NOT regexp_matches(j, '{configs.PLACEHOLDER}')")
def resolved_sites(spark, t):
    return configs.resolved_only(t("source_results").select(F.explode("sites").alias("object"))).agg(F.count(F.lit(1)).alias("kept"))


@query("SELECT name, 'py-' || regexp_replace(name, '\\.[^.]*$', '') AS key, 'https://raw.example/main/py/' || name AS api FROM (SELECT DISTINCT unnest(map_keys(python_files)) AS name FROM source_results) WHERE regexp_matches(name, '^[a-zA-Z0-9_.\\-]+$')")
def plugin_sites(spark, t):
    names = t("source_results").select(F.explode(F.map_keys("python_files")).alias("name")).distinct().filter(F.col("name").rlike(r"^[a-zA-Z0-9_.\-]+$"))
    out = configs.plugin_sites(names, urls.raw_address("https://raw.example/main/py", F.col("name")))
    return out.select("name", F.get_json_object("object", "$.key").alias("key"), F.get_json_object("object", "$.api").alias("api"))


@query("SELECT result_id, name, CASE WHEN regexp_matches(lower(name), '\\.py$') THEN name ELSE name || '.py' END AS file FROM (SELECT result_id, unnest(map_keys(python_files)) AS name FROM source_results) WHERE regexp_matches(name, '^[a-zA-Z0-9_.\\-]+$')")
def plugin_file_names(spark, t):
    names = t("source_results").select("result_id", F.explode(F.map_keys("python_files")).alias("name")).filter(F.col("name").rlike(r"^[a-zA-Z0-9_.\-]+$"))
    return names.select("result_id", "name", payload.file_name(F.concat(F.lit("https://h.example/a/"), "name", F.lit("?v=1#x"))).alias("file"))


@query("SELECT result_id, n, md5(j) AS md5 FROM (SELECT result_id, unnest(sites) AS j, generate_subscripts(sites, 1) - 1 AS n FROM source_results)")
def wrapped_configs(spark, t):
    """Objects put into Base64 behind a mark, and read back."""
    s = t("source_results").select("result_id", F.posexplode("sites").alias("n", "j"))
    wrapped = F.concat(F.lit("AB_DEF-H**"), F.base64(F.encode("j", "utf-8")))
    return s.select("result_id", F.col("n").cast("bigint").alias("n"), F.md5(payload.unwrap(wrapped)).alias("md5"))


#: Playlists and lists made of each result's channels, in the order of row_id.
_CLEAN = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '[\\s,\"#\\p{{Z}}]+', ' ', 'g'))"
_ROWS = f"(SELECT result_id, row_id, {_CLEAN('name')} AS name, {trimmed_sql('url')} AS url, {_CLEAN('group_raw')} AS grp FROM channels WHERE url IS NOT NULL)"


def _channel_rows(t):
    clean = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r'[\s,"#\p{Z}]+', " "))
    return t("channels").filter("url IS NOT NULL").select("result_id", "row_id", clean("name").alias("name"), urls.trimmed(F.col("url")).alias("url"), clean("group_raw").alias("grp"))


def _texts(t, line, head=""):
    rows = _channel_rows(t).withColumn("line", line)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "line"))), lambda x: x["line"]), "\n")
    return rows.groupBy("result_id").agg(F.concat(F.lit(head), body).alias("text")).select(F.col("result_id").cast("string").alias("source"), "text")


@query(f"SELECT CAST(result_id AS VARCHAR) AS source, name, url, grp AS group_raw FROM {_ROWS} WHERE name <> '' AND regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://') AND NOT contains(url, chr(10)) AND NOT contains(url, chr(13))")
def m3u_entries(spark, t):
    line = F.concat(F.lit('#EXTINF:-1 group-title="'), "grp", F.lit('" tvg-id="",'), "name", F.lit("\n"), "url")
    return playlists.m3u(_texts(t, line, "#EXTM3U\n")).select("source", "name", "url", "group_raw")


@query(f"SELECT CAST(result_id AS VARCHAR) AS source, regexp_replace(name, '^\\x{{FEFF}}+', '') AS name, url, CASE WHEN grp = '' THEN 'none' ELSE grp END AS group_raw FROM {_ROWS} WHERE name <> '' AND regexp_matches(url, '(?i)^(?:https?|rtmp|rtsp|rtp|udp)://') AND NOT contains(url, chr(10)) AND NOT contains(url, chr(13))")
def txt_entries(spark, t):
    line = F.concat(F.when(F.col("grp") == "", "none").otherwise(F.col("grp")), F.lit(",#genre#\n"), "name", F.lit(","), "url")
    return playlists.txt(_texts(t, line)).select("source", "name", "url", "group_raw")


@query(f"SELECT source, count(*) AS variants, count(*) FILTER (WHERE rn <= 3) AS tried FROM (SELECT CAST(result_id AS VARCHAR) AS source, row_number() OVER (PARTITION BY result_id ORDER BY row_id DESC) AS rn FROM {_ROWS} WHERE NOT contains(url, chr(10)) AND NOT contains(url, chr(13))) GROUP BY source")
def hls_variants(spark, t):
    line = F.concat(F.lit("#EXT-X-STREAM-INF:BANDWIDTH=1\nv/"), "row_id", F.lit(".m3u8"))
    rows = _texts(t, F.when(~F.col("url").contains("\n") & ~F.col("url").contains("\r"), line).otherwise("#EXT-X-OTHER")).withColumn("base", F.lit("https://h.example/live/master.m3u8"))
    n = playlists.hls(rows).groupBy("source").agg(F.count(F.lit(1)).alias("variants"))
    return n.join(playlists.probe_candidates(rows).groupBy("source").agg(F.count(F.lit(1)).alias("tried")), "source")


_PATTERNS = [("CCTV|央视", "national"), ("卫视", "satellite"), ("(?i)news|新闻", "news"), ("(?i)sport|arena|体育|电竞", "sport")]
_SECTIONS, _RAW = {"天文夜空": "science", "街景监控": "street"}, {"购物橱窗": "shop", "整点新闻": "news", "财经早班": "money"}


@query("""SELECT row_id, CASE WHEN starts_with(s, '赛事') THEN s WHEN starts_with(g, '赛事') THEN g WHEN lower(n) = 'zürnau rétro 10' THEN 'retro' """ + " ".join(f"WHEN regexp_matches(n, '{p}') THEN '{c}'" for p, c in _PATTERNS) + " " + " ".join(f"WHEN s = '{k}' THEN '{c}'" for k, c in _SECTIONS.items())
    + " WHEN starts_with(s, '轮播') THEN 'loop' WHEN starts_with(s, '院线') THEN 'cinema' " + " ".join(f"WHEN g = '{k}' AND NOT ('{c}' = 'shop' AND coalesce(regexp_matches(n, '[A-Za-z]'), false)) THEN '{c}'" for k, c in _RAW.items())
    + " WHEN regexp_matches(g, '^[A-Za-z ]+$') THEN 'latin group' ELSE 'unsorted' END AS category FROM (SELECT row_id, " + trimmed_sql('name') + " AS n, " + trimmed_sql('source_section') + " AS s, " + trimmed_sql('group_raw') + " AS g FROM channels)")
def classify_stages(spark, t):
    rules = {"private_section_prefixes": ["赛事"], "section_categories": _SECTIONS, "section_prefix_categories": {"轮播": "loop", "院线": "cinema"}, "raw_group_categories": _RAW, "review_raw_groups": [], "channel_name_categories": {"zürnau rétro 10": "retro"}}
    stages = classify.stages_of(rules, [Stage("pattern", "name", p, c) for p, c in _PATTERNS], [Stage("pattern", "group", "^[A-Za-z ]+$", "latin group")], ("[A-Za-z]", ["shop"]))
    return t("channels").select("row_id", classify.cascade({"name": F.col("name"), "section": F.col("source_section"), "group": F.col("group_raw")}, stages, "unsorted").alias("category"))


def _fetched(t):
    """Results as they were fetched: configurations of their sites and lives, playlists of their channels where they have none, nothing for failures."""
    r = t("source_results")
    body = F.concat(F.lit('{"sites":['), F.array_join("sites", ","), F.lit('],"lives":['), F.array_join(F.coalesce("lives", F.array().cast("array<string>")), ","), F.lit('],"flags":["a"]}'))
    line = F.concat(F.lit('#EXTINF:-1 group-title="'), "grp", F.lit('",'), "name", F.lit("\n"), "url")
    lists = _texts(t, line, "#EXTM3U\n").withColumn("result_id", F.col("source").cast("bigint")).select("result_id", "text")
    data = F.when((F.col("result_id") % 10 != 7) & (F.size("sites") > 0), body).when(F.col("result_id") % 10 != 7, F.col("text"))
    rows = r.join(lists, "result_id", "left")
    return rows.select(F.concat_ws("#", "source", "result_id").alias("source"), F.col("result_id").cast("int").alias("source_line"), "effective_url", "http_status", "content_type", F.encode(data, "utf-8").alias("data"), F.when(data.isNull(), "URLError").alias("error"))


_KIND = f"CASE WHEN result_id % 10 = 7 THEN 'unknown' WHEN len(sites) > 0 THEN 'tvbox_json' WHEN result_id IN (SELECT result_id FROM {_ROWS}) THEN 'm3u' ELSE 'unknown' END"


@query(f"SELECT kind, count(*) AS n, sum(sites)::BIGINT AS sites FROM (SELECT {_KIND} AS kind, CASE WHEN result_id % 10 <> 7 THEN coalesce(k.kept, 0) ELSE 0 END AS sites FROM source_results LEFT JOIN (SELECT result_id AS rid, count(*) AS kept FROM {_SITES} WHERE {_SITE_REASON} = '' GROUP BY result_id) k ON k.rid = result_id) GROUP BY kind")
def collected_sources(spark, t):
    return configs.collect(_fetched(t))["sources"].groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("sites").alias("sites"))


_STAGES = [Stage("pattern", "name", p, c) for p, c in _PATTERNS]


@query(f"""WITH c AS (SELECT url, min(name) AS name FROM {_ROWS} WHERE result_id % 10 <> 7 AND result_id NOT IN (SELECT result_id FROM source_results WHERE len(sites) > 0) AND result_id IN (SELECT result_id FROM source_results) AND name <> '' AND regexp_matches(url, '^https?://') AND NOT contains(url, chr(10)) AND NOT contains(url, chr(13)) GROUP BY url)
SELECT count(*) AS channels, count(DISTINCT url) AS addresses FROM c WHERE url NOT IN (SELECT {trimmed_sql('url')} FROM streaks WHERE url IS NOT NULL AND fail_count >= 1)""")
def aggregate_channels(spark, t):
    run = pipelines.aggregate(_fetched(t), _STAGES, "unsorted", dead=t("streaks").filter("fail_count >= 1").select("url"))
    return run["channels"].agg(F.count(F.lit(1)).alias("channels"), F.countDistinct("url").alias("addresses"))


@query()
def aggregate_inventory(spark, t):
    """A whole aggregation: what it publishes, by kind and status."""
    run = pipelines.aggregate(_fetched(t), _STAGES, "unsorted")
    return run["inventory"].groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"))


# --- payloads and addresses

@query("SELECT doc_id, sha256(replace(text, chr(13) || chr(10), chr(10))) AS digest, text AS back FROM documents WHERE text IS NOT NULL")
def payload_digests(spark, t):
    d = t("documents").filter("text IS NOT NULL").select("doc_id", F.encode("text", "utf-8").alias("data"))
    return d.select("doc_id", payload.content_digest(F.col("data")).alias("digest"), payload.decode_text("data").alias("back"))


@query("SELECT event_id, true AS sealed, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def opened_envelopes(spark, t):
    """Properties sealed into encrypted envelopes, told to be such, and opened again."""
    key, iv = b"\x24k3y#", b"0123456789abc"
    plain = F.concat(F.lit('{"pad": "0123456789abcdef0123", "own": '), "props", F.lit("}"))
    body = F.lower(F.hex(F.substring(F.aes_encrypt(F.encode(plain, "utf-8"), F.lit(key.ljust(16, b"0")), F.lit("CBC"), F.lit("PKCS"), F.lit(iv.ljust(16, b"0"))), 17, 1 << 20)))
    sealed = F.concat(F.lit("2423" + key.hex() + "2324"), body, F.lit(iv.hex()))
    e = t("events").select("event_id", sealed.alias("x"))
    return e.select("event_id", payload.is_encrypted(F.col("x")).alias("sealed"), F.try_variant_get(payload.parse_config(F.col("x")), "$.own.k", "bigint").alias("k"))


@query("SELECT result_id, CASE WHEN result_id % 3 = 0 THEN 'https://h.example/' || result_id || '/a%20b?q=x%20y' ELSE trim(effective_url) END AS url FROM source_results WHERE regexp_matches(effective_url, '^[a-zA-Z0-9:/._-]+$')")
def normalized_addresses(spark, t):
    r = t("source_results").filter(F.col("effective_url").rlike("^[a-zA-Z0-9:/._-]+$"))
    given = F.when(F.col("result_id") % 3 == 0, F.concat(F.lit("https://h.example/"), "result_id", F.lit("/a b?q=x y"))).otherwise(F.col("effective_url"))
    proxied = F.when(F.col("result_id") % 2 == 0, F.concat(F.lit(" https://mirror.example/"), given)).otherwise(given)
    return r.select("result_id", urls.normalized(proxied, ["https://mirror.example/", "https://other.example/"]).alias("url"))


_HOST = r"lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"


@query(f"SELECT check_id, CASE WHEN {_HOST} IN ('edge2.ostrel.test', 'px2.corvane.example') THEN 'https://mirror.example/' || url ELSE url END AS mirrored, 'https://relay.example/?u=' || url_encode(url) AS relayed FROM health_items WHERE regexp_matches(url, '^[a-zA-Z0-9:/._?=&-]+$')")
def mirrored_addresses(spark, t):
    h = t("health_items").filter(F.col("url").rlike(r"^[a-zA-Z0-9:/._?=&-]+\z"))
    return h.select("check_id", urls.mirrored(F.col("url"), ["edge2.ostrel.test", "px2.corvane.example"], "https://mirror.example/").alias("mirrored"), urls.relay(F.col("url"), "https://relay.example/?u={url}").alias("relayed"))


@query("SELECT result_id, 'https://raw.example/o/main/' || array_to_string(list_transform(string_split(kind || '/a b/' || result_id, '/'), lambda x: url_encode(x)), '/') AS url, 'https://h.example/x/' || result_id || '.json' AS resolved FROM source_results WHERE kind IS NOT NULL")
def built_addresses(spark, t):
    r = t("source_results").filter("kind IS NOT NULL")
    return r.select("result_id", urls.raw_address("https://raw.example/o/main/", F.concat_ws("/", "kind", F.lit("a b"), F.col("result_id"))).alias("url"), urls.resolve(F.concat(F.lit("../x/"), "result_id", F.lit(".json")), F.lit("https://h.example/y/config.json")).alias("resolved"))


@query(f"SELECT name, url, grp AS group_raw, CAST(row_number() OVER (ORDER BY row_id) - 1 AS BIGINT) AS rank FROM {_ROWS} WHERE name <> '' AND regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://') AND NOT contains(url, chr(10)) AND NOT contains(url, chr(13))")
def playlist_round_trip(spark, t):
    """Channels written as a playlist, each line with its place, and read again."""
    c = _channel_rows(t).filter((F.col("name") != "") & F.col("url").rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://") & ~F.col("url").contains("\n") & ~F.col("url").contains("\r"))
    lines = playlists.to_m3u(c.select("row_id", "name", "url", F.col("grp").alias("group_name"), F.lit(None).cast("string").alias("logo"), F.lit("").alias("tvg_id")), [F.col("row_id")]).filter("rank >= 0")
    back = playlists.m3u(lines.select(F.col("rank").cast("string").alias("source"), F.col("value").alias("text")))
    return back.select("name", "url", "group_raw", F.col("source").cast("bigint").alias("rank"))


# --- ledgers and items

@query("SELECT channel_key, arg_min(CASE WHEN group_name IS NULL THEN 0 ELSE 1 END, row_id) = 1 AS has_category, count(*) AS lines, md5(string_agg(row_id, ',' ORDER BY row_id)) AS rows FROM channels WHERE channel_key IS NOT NULL GROUP BY channel_key")
def nested_ledger(spark, t):
    n = ledger.nested_ledger(t("channels"))
    return n.select("channel_key", F.col("category").isNotNull().alias("has_category"), F.size("lines").cast("bigint").alias("lines"), F.md5(F.array_join(F.transform("lines", lambda x: x["row_id"]), ",")).alias("rows"))


_ITEMS = """WITH a AS (SELECT 'source' AS kind, source AS name, effective_url AS url, result_id AS o, 0 AS p FROM source_results UNION ALL SELECT 'site', json_extract_string(j, '$.name'), json_extract_string(j, '$.api'), result_id, n FROM (SELECT result_id, unnest(sites) AS j, generate_subscripts(sites, 1) AS n FROM source_results)
  UNION ALL SELECT 'live', json_extract_string(j, '$.name'), json_extract_string(j, '$.url'), result_id, n FROM (SELECT result_id, unnest(lives) AS j, generate_subscripts(lives, 1) AS n FROM source_results) UNION ALL SELECT 'channel', name, url, row_id, 0 FROM channels)
SELECT kind, name, url FROM (SELECT *, row_number() OVER (PARTITION BY kind, url, CASE WHEN kind IN ('site', 'live') THEN coalesce(name, '') ELSE '' END ORDER BY o, p) AS rn FROM a WHERE trim(coalesce(url, ''), ' ') <> '') WHERE rn = 1"""


@query(_ITEMS)
def check_items(spark, t):
    return ledger.items(t("source_results"), t("channels")).select("kind", "name", "url")


@query(f"SELECT kind, count(*) AS n FROM ({_ITEMS}) GROUP BY kind")
def item_counts(spark, t):
    return ledger.counts(ledger.items(t("source_results"), t("channels")), "kind")
