"""Queries of the catalogues' dataflow, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from playweave.functions import nested, text
from playweave.operators import media, ranking, review
from playweave.plans import views
from playweave.plans.registry import query

_MARKS = ranking.TITLE_MARKS.replace("\\s", "\\s")
_LOW = f"regexp_replace(lower(p_name), '{_MARKS}', '', 'g')"
_WORDS = f"list_filter(regexp_split_to_array(lower(p_name), '{_MARKS}'), lambda x: x <> '')"
_CHARS = sorted(set("bluepart"))


def _score(q: str) -> str:
    own = q.split()
    flat = "".join(own)
    chars = sorted(set(flat))
    shared = " + ".join(f"CASE WHEN contains(l, '{c}') THEN 1 ELSE 0 END" for c in chars)
    return f"""CASE WHEN l = '{flat}' THEN 100 WHEN list_contains(w, '{flat}') OR l IN ({', '.join(repr(x) for x in own)}) THEN 85 WHEN contains(l, '{flat}') THEN 65 WHEN {' AND '.join(f"list_contains(w, '{x}')" for x in own)} THEN 55 WHEN {' OR '.join(f"list_contains(w, '{x}')" for x in own)} THEN 40
  WHEN contains(array_to_string(list_transform(w, lambda x: x[1]), ''), '{''.join(x[0] for x in own)}') AND {len(own)} >= 2 THEN 30 WHEN ({shared}) >= {max(2, len(chars) * 0.6)} THEN least(20, 3 * ({shared})) ELSE 0 END"""


@query(f"SELECT p_partkey, {_score('light blue')} AS score FROM (SELECT p_partkey, {_LOW} AS l, {_WORDS} AS w FROM part)")
def match_scores(spark, t):
    return t("part").select("p_partkey", ranking.match_score(F.col("p_name"), "light blue").alias("score"))


@query(f"""SELECT p_partkey, p_name, score FROM (SELECT p_partkey, p_name, {_score('blue part')} - CAST(least(5, floor(abs(length(trim(p_name)) - 9) / 10)) AS INT) AS score, {_score('blue part')} AS tier FROM (SELECT p_partkey, p_name, {_LOW} AS l, {_WORDS} AS w FROM part)) WHERE tier > 0 ORDER BY score DESC, p_name, p_partkey LIMIT 100""")
def fuzzy_search_top(spark, t):
    return ranking.search(t("part").select("p_partkey", "p_name"), "p_name", "blue part").select("p_partkey", "p_name", "score")


@query("SELECT p_name, arg_min(p_partkey, (c, p_partkey)) AS p_partkey, min(c) AS corpus FROM (SELECT p_name, p_partkey, CASE WHEN p_size <= 10 THEN 0 WHEN p_size <= 25 THEN 1 ELSE 2 END AS c FROM part) GROUP BY p_name")
def corpus_union(spark, t):
    p = t("part").select("p_name", "p_partkey", "p_size")
    parts = [p.filter("p_size <= 10"), p.filter("p_size > 10 AND p_size <= 25"), p.filter("p_size > 25")]
    out = media.union_first(parts, "p_name", "p_partkey")
    return out.select("p_name", "p_partkey", F.when(F.col("p_size") <= 10, 0).when(F.col("p_size") <= 25, 1).otherwise(2).alias("corpus"))


_BUCKETS = [("first", ["STEEL", "BRASS"]), ("second", ["TIN", "COPPER"]), ("third", ["NICKEL"])]


@query("SELECT p_partkey, CASE WHEN " + " WHEN ".join(f"list_has_any(string_split(p_type, ' '), {ws}) THEN '{b}'" for b, ws in _BUCKETS) + " ELSE 'none' END AS bucket FROM part")
def priority_buckets(spark, t):
    return t("part").select("p_partkey", media.bucket(F.split("p_type", " "), _BUCKETS, "none").alias("bucket"))


@query("SELECT word, count(*) AS n FROM (SELECT unnest(list_concat(['all'], string_split(p_type, ' '))) AS word FROM part) GROUP BY word")
def words_with_all(spark, t):
    return media.with_all(t("part"), F.split("p_type", " "), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT grouping, \"group\", count(*) AS n FROM (SELECT 'total' AS grouping, 'all' AS \"group\" FROM channels UNION ALL SELECT 'protocol', protocol FROM channels UNION ALL SELECT 'kind', CASE WHEN regexp_matches(name, 'Music|音乐') THEN 'music' WHEN regexp_matches(name, 'News|新闻') THEN 'news' ELSE 'other' END FROM channels) WHERE \"group\" IS NOT NULL GROUP BY 1, 2")
def group_index(spark, t):
    kind = F.when(F.col("name").rlike("Music|音乐"), "music").when(F.col("name").rlike("News|新闻"), "news").otherwise("other")
    rows = media.group_index(t("channels").select("row_id", "protocol", "name"), {"total": F.lit("all"), "protocol": F.col("protocol"), "kind": kind})
    return rows.groupBy("grouping", "group").agg(F.count(F.lit(1)).alias("n"))


@query("WITH a AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY row_id) AS rn FROM channels), b AS (SELECT source, least(12, count(*)) AS n FROM channels GROUP BY source), c AS (SELECT source, coalesce(sum(n) OVER (ORDER BY source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b) SELECT row_id, CAST(before + rn AS BIGINT) AS position FROM a JOIN c USING (source) WHERE rn <= 12 AND before < 160 AND before + rn <= 160")
def fan_out_capped(spark, t):
    return media.fan_out(t("channels").select("source", "row_id"), "source", [F.col("row_id")], 12, 160).select("row_id", "position")


@query("WITH s AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL), b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY l_suppkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s) SELECT l_suppkey, count(*) AS pages, CAST(sum(n) AS BIGINT) AS n FROM b WHERE before < 300 GROUP BY l_suppkey")
def pages_until(spark, t):
    rows = media.pages_until(t("lineitem").select("l_suppkey", "l_linenumber"), "l_suppkey", "l_linenumber", 300)
    return rows.groupBy("l_suppkey").agg(F.countDistinct("l_linenumber").alias("pages"), F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n FROM channels WHERE protocol = 'http'")
def optional_filters(spark, t):
    return media.options(t("channels"), {"protocol": " http ", "quality": "all", "source_section": None, "logo": ""}).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CASE WHEN k > 0 AND k % 2 = 0 THEN 'a=' || k ELSE '' END || CASE WHEN user_id > 0 THEN ';u=' || user_id ELSE '' END AS kept FROM (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)")
def option_maps(spark, t):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    chosen = F.create_map(F.lit("a"), F.when(k % 2 == 0, k.cast("string")).otherwise("all"), F.lit("cat"), F.lit("x"), F.lit("u"), F.col("user_id").cast("string"))
    kept = media.option_map(chosen)
    a, u = F.element_at(kept, "a"), F.element_at(kept, "u")
    return t("events").select("event_id", F.concat(F.when(a.isNotNull(), F.concat(F.lit("a="), a)).otherwise(""), F.when(u.isNotNull(), F.concat(F.lit(";u="), u)).otherwise("")).alias("kept"))


@query("SELECT event_id, CAST(row_number() OVER (ORDER BY CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 ELSE 3 END, ts, event_id) - 1 AS BIGINT) AS position FROM events")
def rank_positions(spark, t):
    rank = F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "view", 2).otherwise(3)
    return media.ranked(t("events").select("event_id", "event_type", "ts"), rank, [F.col("ts"), F.col("event_id")]).select("event_id", "position")


@query("SELECT user_id, arg_min(event_id, (CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END, event_id)) AS event_id FROM events GROUP BY user_id")
def first_by_rank(spark, t):
    rank = F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 1).otherwise(2)
    return media.first_by_rank(t("events"), "user_id", rank, [F.col("event_id")]).select("user_id", "event_id")


@query("WITH e AS (SELECT DISTINCT l_orderkey, l_returnflag, l_linenumber, l_partkey FROM lineitem), p AS (SELECT l_orderkey, l_returnflag, min(l_linenumber) AS f, string_agg(l_linenumber || '$' || l_partkey, '#' ORDER BY l_linenumber, l_partkey) AS u FROM e GROUP BY 1, 2) SELECT l_orderkey, string_agg(l_returnflag, '$$$' ORDER BY f, l_returnflag) AS play_from, string_agg(u, '$$$' ORDER BY f, l_returnflag) AS play_url FROM p GROUP BY l_orderkey")
def packed_lines(spark, t):
    rows = t("lineitem").select("l_orderkey", "l_returnflag", F.col("l_linenumber").alias("o"), "l_linenumber", "l_partkey")
    return media.packed_lines(rows, "l_orderkey", "l_returnflag", ["o"], "l_linenumber", "l_partkey")


@query("SELECT source, count(*) AS n, arg_min(logo, row_id) FILTER (WHERE trim(logo) <> '') AS picture, md5(string_agg(DISTINCT row_id || '$' || row_id, '#')) IS NOT NULL AS packed FROM channels GROUP BY source")
def packed_songs(spark, t):
    rows = media.songs(t("channels").select("source", "row_id", F.col("row_id").alias("title"), F.col("row_id").alias("id"), "logo"), "source", "row_id", "title", "id", "logo")
    return rows.select("source", "n", "picture", (F.size(F.split("packed", "#")) == F.col("n")).alias("packed"))


_TITLES = "SELECT row_id, regexp_replace(name, '[\\s\\p{Z}]+', '', 'g') AS k, row_id % 2 AS part FROM channels"


@query(f"WITH a AS ({_TITLES}) SELECT row_id, 0 AS part FROM a WHERE part = 0 AND k <> '' UNION ALL SELECT min(row_id), 1 FROM a WHERE part = 1 AND k <> '' AND k NOT IN (SELECT k FROM a WHERE part = 0 AND k IS NOT NULL) GROUP BY k")
def merged_search(spark, t):
    c = t("channels").select("row_id", "name")
    return media.merged_search(c.filter("row_id % 2 = 0"), c.filter("row_id % 2 = 1"), "name", "row_id").select("row_id", "part")


@query("SELECT coalesce(a.k, b.k) AS k, coalesce(CASE WHEN trim(a.logo) <> '' THEN a.logo END, b.logo) AS logo, coalesce(CASE WHEN trim(a.quality) <> '' THEN a.quality END, b.quality) AS quality FROM (SELECT row_id // 2 AS k, logo, quality FROM channels WHERE row_id % 2 = 0) a FULL JOIN (SELECT row_id // 2 AS k, logo, quality FROM channels WHERE row_id % 2 = 1) b ON a.k = b.k")
def preferred_records(spark, t):
    c = t("channels").select(F.floor(F.col("row_id") / 2).alias("k"), "row_id", "logo", "quality")
    return media.preferred(c.filter("row_id % 2 = 0"), c.filter("row_id % 2 = 1"), "k", ["logo", "quality"])


@query("WITH w AS (SELECT event_id AS id, user_id AS n, event_type AS a FROM events WHERE event_id % 5 = 0), f AS (SELECT event_id AS id, user_id AS n, event_type AS a, event_id AS o FROM events WHERE event_id % 3 = 0), m AS (SELECT w.id AS wanted, f.id AS match, CASE WHEN w.id = f.id THEN 0 ELSE 1 END AS r, o FROM w JOIN f ON w.id = f.id OR (w.n = f.n AND w.a = f.a)) SELECT wanted, arg_min(match, (r, o)) AS match, min(r) = 0 AS same_id FROM m GROUP BY wanted")
def candidate_matches(spark, t):
    e = t("events").select(F.col("event_id").alias("id"), F.col("user_id").alias("n"), F.col("event_type").alias("a"), F.col("event_id").alias("o"))
    return media.candidates(e.filter("id % 5 = 0"), e.filter("id % 3 = 0"), "id", "n", "a", "o")


@query("WITH s AS (SELECT l_orderkey AS room, l_suppkey AS server, (l_linenumber, l_partkey, l_suppkey) AS ord, l_quantity AS priority FROM lineitem), b AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY room ORDER BY priority DESC, ord) AS INT) AS line FROM s) WHERE line <= 3), r AS (SELECT l_orderkey AS room, CASE WHEN l_linenumber % 3 = 0 THEN 2000 WHEN l_linenumber % 3 = 1 THEN 1200 ELSE 500 END AS bitrate, CASE WHEN l_returnflag = 'A' THEN '高清720' WHEN l_returnflag = 'R' THEN '标清' ELSE '原画' END AS name, (l_linenumber, l_partkey, l_suppkey, l_returnflag) AS ord FROM lineitem), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY room, bitrate ORDER BY ord) AS rn FROM r) WHERE rn = 1) SELECT b.room, line, server, bitrate, CASE WHEN bitrate = 2000 AND (regexp_matches(name, '高清|720') OR name = '原画') THEN '超清' WHEN bitrate = 1200 AND regexp_matches(name, '标清|480') THEN '高清' ELSE name END AS name FROM b JOIN f ON b.room = f.room")
def rate_lines(spark, t):
    li = t("lineitem")
    servers = li.select(F.col("l_orderkey").alias("room"), F.col("l_suppkey").alias("server"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ord"), F.col("l_quantity").alias("priority"))
    i = F.col("l_linenumber") % 3
    rates = li.select(F.col("l_orderkey").alias("room"), F.when(i == 0, 2000).when(i == 1, 1200).otherwise(500).alias("bitrate"), F.when(F.col("l_returnflag") == "A", "高清720").when(F.col("l_returnflag") == "R", "标清").otherwise("原画").alias("name"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").alias("ord"))
    return media.rate_lines(servers, rates, "room")


@query("SELECT source, count(*) FILTER (WHERE contains(lower(url), 'm3u8')) AS hls, count(*) FILTER (WHERE NOT contains(lower(url), 'm3u8') AND (contains(lower(url), 'flv') OR starts_with(url, 'http'))) AS flv, arg_min(url, (-row_id, url)) FILTER (WHERE contains(lower(url), 'm3u8')) AS best FROM channels WHERE contains(lower(url), 'm3u8') OR contains(lower(url), 'flv') OR starts_with(url, 'http') GROUP BY source")
def routed_streams(spark, t):
    rows = media.routed(t("channels").select("source", "url", F.col("row_id").alias("bitrate")), "source")
    return rows.select("source", F.size("hls").cast("bigint").alias("hls"), F.size("flv").cast("bigint").alias("flv"), F.get("hls", F.lit(0)).alias("best"))


@query("SELECT check_id, CASE WHEN status = 'probe_ok' THEN 0 WHEN failure_class = 'soft' THEN 1 WHEN failure_class = 'hard' THEN 2 ELSE 3 END AS state FROM health_items")
def state_order(spark, t):
    state = F.when(F.col("status") == "probe_ok", "ok").when(F.col("failure_class") == "soft", "cooling").when(F.col("failure_class") == "hard", "dead")
    return t("health_items").select("check_id", media.by_state(state).alias("state"))


@query("SELECT row_id, CASE WHEN protocol IN ('http', 'rtmp') THEN protocol END AS platform, CASE WHEN protocol IN ('http', 'rtmp') THEN row_id || '|x' END AS rest FROM channels")
def dispatched_ids(spark, t):
    ids = F.concat_ws("|", F.coalesce("protocol", F.lit("")), F.col("row_id"), F.lit("x"))
    source, rest = media.dispatched(ids, ["http", "rtmp"])
    return t("channels").select("row_id", source.alias("platform"), rest.alias("rest"))


@query("SELECT coalesce(nullif(logo, ''), tvg_id, CAST(row_id AS VARCHAR)) AS k, min(row_id) AS row_id FROM channels GROUP BY 1")
def fallback_key_dedup(spark, t):
    k = F.coalesce(F.when(F.col("logo") != "", F.col("logo")), F.col("tvg_id"), F.col("row_id").cast("string"))
    return media.keep_first(t("channels").select(k.alias("k"), "row_id"), [F.col("k")], [F.col("row_id")])


@query("WITH a AS (SELECT row_id, l, i, v FROM (SELECT row_id, 0 AS l, unnest(lines) AS v, generate_subscripts(lines, 1) - 1 AS i FROM channels UNION ALL SELECT row_id, 1, source, 0 FROM channels) WHERE v IS NOT NULL AND v <> ''), b AS (SELECT v, min((row_id, l, i)) AS o FROM a GROUP BY v) SELECT v AS value, CAST(row_number() OVER (ORDER BY o, v) - 1 AS BIGINT) AS position, CAST((row_number() OVER (ORDER BY o, v) - 1) // 30 + 1 AS BIGINT) AS page FROM b")
def flattened_pages(spark, t):
    return media.flattened_pages(t("channels").select("row_id", "lines", F.array("source").alias("own")), ["lines", "own"], "row_id", 30)


@query("SELECT h.row_id, h.check_id AS position, c.quality FROM health_items h JOIN channels c ON h.row_id = c.row_id WHERE c.protocol = 'http'")
def answers_in_order(spark, t):
    answers = t("channels").filter("protocol = 'http'").select("row_id", "quality")
    return media.in_input_order(t("health_items").select("row_id", "check_id"), answers, ["row_id"], "check_id").select("row_id", "position", "quality")


@query("SELECT o_orderkey, CASE WHEN m <= c AND n >= 12 THEN c + 1 ELSE m END AS pages FROM (SELECT o_orderkey, o_custkey % 5 + 1 AS c, o_orderkey % 20 AS n, greatest(o_custkey % 5 + 1, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 90 ELSE 0 END) AS m FROM orders)")
def page_counts(spark, t):
    k = F.col("o_orderkey")
    slugs = F.array(F.when(k % 3 == 0, F.concat(F.lit("action---"), k % 90, F.lit("---"))).otherwise("action------"), F.concat(F.lit("other-"), k), F.lit("a-b-c-d-e-f-g"))
    return t("orders").select("o_orderkey", media.page_count(slugs, F.col("o_custkey") % 5 + 1, k % 20).alias("pages"))


@query("SELECT o_orderkey, '/show/' || CASE WHEN o_orderkey % 4 = 0 THEN 'zero' ELSE o_orderstatus END || '--' || o_custkey || '-' || CASE WHEN o_orderkey % 6 + 1 > 1 THEN CAST(o_orderkey % 6 + 1 AS VARCHAR) ELSE '' END || '---.html' AS address FROM orders")
def slot_addresses(spark, t):
    k = F.col("o_orderkey")
    chosen = F.array(F.lit("2:x"), F.concat(F.lit("2:"), F.col("o_custkey")), F.lit("3:99"), F.when(k % 4 == 0, "0:zero").otherwise("9:out"), F.lit("none"))
    return t("orders").select("o_orderkey", media.slot_address(F.col("o_orderstatus"), k % 6 + 1, chosen).alias("address"))


@query("SELECT l_orderkey, CASE WHEN l_suppkey % 4 <> 0 THEN l_suppkey % 4 ELSE row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) END AS number, l_linenumber FROM lineitem QUALIFY l_partkey % 7 <> 0")
def episode_numbers(spark, t):
    rows = t("lineitem").select("l_orderkey", (F.col("l_suppkey") % 4).alias("number"), F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey").cast("string")).otherwise(" ").alias("url"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("o"))
    return media.episodes(rows, "l_orderkey", "o").select("l_orderkey", "number", F.col("o.l_linenumber").alias("l_linenumber"))


@query("SELECT o_orderkey, printf('%02d:%02d', o_custkey // 60, o_custkey % 60) AS length, coalesce(regexp_extract(o_orderpriority, '(\\d{1,9})', 1), '')::BIGINT AS number FROM orders")
def durations(spark, t):
    return t("orders").select("o_orderkey", media.duration(F.col("o_custkey")).alias("length"), text.episode_number(F.col("o_orderpriority")).alias("number"))


_TIMED = "SELECT l_orderkey, CAST(l_linenumber * 61000 + l_suppkey % 1000 - 50 AS BIGINT) AS start, 'w' || l_partkey || ' of ' || l_suppkey AS text FROM lineitem"


def _timed(t):
    stamp = lambda ms: F.format_string("[%02d:%02d.%03d]", F.floor(ms / 60000).cast("int"), F.floor(ms / 1000 % 60).cast("int"), (ms % 1000).cast("int"))
    line = F.concat(stamp(F.col("l_linenumber") * 61000 + F.col("l_suppkey") % 1000), F.lit("w"), "l_partkey", F.lit(" of "), "l_suppkey")
    rows = t("lineitem").groupBy("l_orderkey").agg(F.concat(F.lit("[ti:x]\n[offset:-50]\nno stamp\n[00:01.00] \n"), F.array_join(F.collect_list(line), "\r\n")).alias("text"))
    return media.timed_lines(rows, "l_orderkey")


@query(_TIMED)
def timed_lines(spark, t):
    return _timed(t)


@query(f"""WITH a AS (SELECT *, lead(start) OVER (PARTITION BY l_orderkey ORDER BY start, text) - start AS gap, length(replace(text, ' ', '')) AS weight, string_split(text, ' ') AS w FROM ({_TIMED})),
b AS (SELECT *, CAST(CASE WHEN gap IS NULL THEN greatest(weight * 300, 800) ELSE greatest(least(gap, greatest(weight * 300, 800)), floor(gap * 0.9)) END AS BIGINT) AS len FROM a)
SELECT l_orderkey, start, w[1] AS word, CAST(floor(length(w[1]) * len / weight) AS BIGINT) AS length FROM b""")
def word_times(spark, t):
    return media.word_times(_timed(t), "l_orderkey").filter("n = 0").select("l_orderkey", "start", "word", "length")


@query("SELECT doc_id, 'https://h.example/d/' || doc_id % 50 AS href, min(t) AS title FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(coalesce(title, ''), '[<>\"'']', '', 'g'), '\\s+', ' ', 'g')) AS t FROM documents) GROUP BY doc_id")
def link_cards(spark, t):
    title = F.regexp_replace(F.coalesce("title", F.lit("")), "[<>\"']", "")
    link = lambda x: F.concat(F.lit('<a class="c"\n href="https://h.example/d/'), F.col("doc_id") % 50, F.lit('"><b>'), x, F.lit("</b></a>"))
    html = F.concat(F.lit("<div>"), link(title), link(F.lit("again")), F.lit('<a name="x">none</a></div>'))
    return media.cards(t("documents").select("doc_id", html.alias("html")), "doc_id").select("doc_id", "href", "title")


@query("SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[ \\t]+', ' ', 'g')) AS plain, '[https://h.example/' || doc_id || ']' AS links FROM documents WHERE NOT regexp_matches(coalesce(text, ''), '[<>&]')")
def plain_markup(spark, t):
    rows = t("documents").filter(~F.coalesce("text", F.lit("")).rlike("[<>&]"))
    html = F.concat(F.lit("<p>"), F.coalesce("text", F.lit("")), F.lit('</p><script>x < 1</script><a href="https://h.example/'), F.col("doc_id"), F.lit('"></a>'))
    return rows.select("doc_id", text.strip_tags(html).alias("plain"), F.concat(F.lit("["), F.array_join(text.links(html), ", "), F.lit("]")).alias("links"))


@query("SELECT vec_id, template FROM (SELECT v.vec_id, arg_max(q.vec_id, (round(list_dot_product(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 9), -q.vec_id)) AS template, max(list_dot_product(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) / len(v.embedding)) AS s FROM embeddings v, embeddings q WHERE q.vec_id < 200 GROUP BY v.vec_id) WHERE s >= 0.0016")
def template_matches(spark, t):
    e = t("embeddings").select("vec_id", "embedding")
    return ranking.nearest_template(e, e.filter("vec_id < 200"), least=0.0016).select("vec_id", "template")


@query("SELECT o_orderkey, o_custkey % 128 AS a, o_orderstatus AS b FROM orders")
def wire_fields(spark, t):
    one = lambda n: F.unhex(F.lpad(F.hex(n), 2, "0"))
    raw = F.concat(F.unhex(F.lit("08")), one(F.col("o_custkey") % 128), F.unhex(F.lit("1201")), F.encode("o_orderstatus", "utf-8"), F.unhex(F.lit("1D00000000FF")))
    f = t("orders").select("o_orderkey", nested.wire_fields(raw).alias("f"))
    return f.select("o_orderkey", F.conv(F.hex(F.col("f")[0]["value"]), 16, 10).cast("bigint").alias("a"), F.col("f")[1]["value"].cast("string").alias("b"))


def _catalogue(spark, t):
    p = t("part")
    items = p.select(F.col("p_partkey").alias("vod_id"), F.col("p_name").alias("vod_name"), F.col("p_size").alias("type_id"), F.concat(F.lit("size "), F.col("p_size")).alias("type_name"), F.lit("").alias("vod_pic"), F.col("p_brand").alias("vod_remarks"), F.lit("a$$$b").alias("vod_play_from"), F.concat(F.lit("one$"), "p_partkey", F.lit("#two$2$$$only$"), "p_brand").alias("vod_play_url"))
    views.register(spark, items)


@query("SELECT CAST(p_size AS VARCHAR) AS type_id, 'size ' || p_size AS type_name, count(*) AS items FROM part GROUP BY p_size")
def home_content(spark, t):
    _catalogue(spark, t)
    return spark.sql("SELECT * FROM home_content()")


@query("WITH a AS (SELECT *, row_number() OVER (ORDER BY p_name, p_partkey) AS rn, count(*) OVER () AS total FROM part WHERE p_size = 7) SELECT CAST(p_partkey AS VARCHAR) AS vod_id, p_name AS vod_name, CAST(ceil(total / 30.0) AS BIGINT) AS pagecount, total FROM a WHERE rn <= 30")
def category_content(spark, t):
    _catalogue(spark, t)
    return spark.sql("SELECT vod_id, vod_name, pagecount, total FROM category_content('7', 1)")


@query("SELECT CAST(p_partkey AS VARCHAR) AS vod_id, p_name AS vod_name FROM part WHERE contains(lower(p_name), 'blue')")
def search_content(spark, t):
    _catalogue(spark, t)
    return spark.sql("SELECT vod_id, vod_name FROM search_content(' Blue ')")


@query("SELECT * FROM (VALUES ('a', 'one', '17'), ('a', 'two', '2')) t(line, title, url)")
def player_content(spark, t):
    _catalogue(spark, t)
    return spark.sql("SELECT * FROM player_content('17', 'a')")


@query("SELECT CAST(p_partkey AS VARCHAR) AS vod_id, p_name AS vod_name, 'size ' || p_size AS type_name FROM part WHERE p_partkey = 17")
def detail_content(spark, t):
    _catalogue(spark, t)
    return spark.sql("SELECT vod_id, vod_name, type_name FROM detail_content('17')")


@query("SELECT doc_id, substr(coalesce(title, ''), 1, 20) AS title, array_to_string(list_slice(string_split(coalesce(doc_kind, '') || ',a,b,c,d,e,f', ','), 1, 5), ',') AS groups FROM documents ORDER BY doc_id LIMIT 120")
def pending_review(spark, t):
    rows = t("documents").select("doc_id", F.coalesce("title", F.lit("")).alias("title"), F.split(F.concat(F.coalesce("doc_kind", F.lit("")), F.lit(",a,b,c,d,e,f")), ",").alias("groups"))
    return review.pending(rows, "doc_id", {"title": 20}, {"groups": (5, 80)}).select("doc_id", "title", F.array_join("groups", ",").alias("groups"))


_ALLOWED = ["note", "log", "readme"]


@query("SELECT doc_id, doc_kind AS category, substr(lower(coalesce(lang, '')), 1, 12) AS confidence FROM documents WHERE trim(doc_kind) IN ('note', 'log', 'readme') ORDER BY doc_id LIMIT 120")
def allowed_suggestions(spark, t):
    rows = t("documents").select("doc_id", F.col("doc_kind").alias("category"), F.coalesce("lang", F.lit("")).alias("confidence"), F.col("title").alias("reason"))
    return review.allowed(rows, _ALLOWED, "doc_id").select("doc_id", "category", "confidence")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_in_text(spark, t):
    fenced = F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nand {more}"))
    loose = F.concat(F.lit("answer "), "props", F.lit(" end"))
    said = F.when(F.col("event_id") % 2 == 0, fenced).otherwise(loose)
    return t("events").select("event_id", F.try_variant_get(review.json_in(said), "$.k", "bigint").alias("k"))
