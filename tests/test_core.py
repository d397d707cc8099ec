"""Functions and operators on literal rows: expected outcomes, nulls, ties, repeats and empty tables."""

import base64
import datetime as dt

from pyspark.sql import functions as F

from playweave.functions import payload, text, urls
from playweave.operators import dedup, health, ranking
from playweave.operators.ledger import classify
from playweave.sources import playlists


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(column).collect()]


def test_urls(spark):
    x = F.col("x")
    assert one(spark, urls.host(x), "HTTP://u:p@Ab.Example:80/x", "no address", None) == ["ab.example", "", None]
    assert one(spark, urls.safe(x), "http://u:p@h/a?id=1&access_token=zz&q=2#f", "http://h/?sign=1", None) == ["http://h/a?id=1&q=2", "http://h/", None]
    assert one(spark, urls.safe(x), " http://u:p@h/a", "http://h/a?to%6ben=abc&a%zz=1", "http://h/a?x=1&acc%65ss%5Ftoken=1") == ["http://h/a", "http://h/a?a%zz=1", "http://h/a?x=1"]
    assert one(spark, urls.is_internal(x), "http://[::1]/a", "http://[fd00::1]:80/a", "http://[2606:4700::1]/a", "http://198.18.0.1/") == [True, True, False, True]
    assert one(spark, urls.raw_address("https://raw.example/o/r/main", x), "py\\a b/中.py") == ["https://raw.example/o/r/main/py/a%20b/%E4%B8%AD.py"]
    assert one(spark, urls.mirrored(x, ["a.example"], "https://m/"), "https://A.example/x", "https://b.example/x", None) == ["https://m/https://A.example/x", "https://b.example/x", None]
    assert one(spark, urls.is_internal(x), "http://192.168.1.10/a", "http://rrs03.hw.gmcc.net/a", "http://8.8.8.8/", None) == [True, True, False, False]
    assert one(spark, urls.strip_proxy(x, ["https://m/"]), "https://m/https://a/b", "https://m/c") == ["https://a/b", "https://m/c"]
    assert one(spark, urls.requote(x), "http://h/a b/中?q=x y", None) == ["http://h/a%20b/%E4%B8%AD?q=x%20y", None]
    assert one(spark, urls.relay(x, "https://relay.example/?u={url}"), "http://a/b c") == ["https://relay.example/?u=http%3A%2F%2Fa%2Fb%20c"]
    r = spark.createDataFrame([("./a.json", "https://h/x/y.json"), ("../b", "https://h/x/y.json"), ("https://z/", "https://h/"), (None, "b")], "r string, b string")
    assert [v[0] for v in r.select(urls.resolve("r", "b")).collect()] == ["https://h/x/a.json", "https://h/b", "https://z/", None]


def test_names(spark):
    x = F.col("x")
    assert one(spark, text.fold_name(x), " 湖南衛視　高清 HD", "4K", "CCTV-1 1080p", None) == ["湖南卫视", "4K", "CCTV-1", None]
    assert one(spark, text.identity(x), "CCTV-1 (综合) HD") == ["cctv1综合"]
    assert one(spark, text.quality(x), "a 8K 4K", "x uhd", "y 超清", "z", None) == ["8K", "4K", "超清", "", None]
    assert one(spark, text.episode_number(x, 999999), "第12集", "完结", None) == [12, 999999, 999999]
    assert one(spark, text.strip_tags(x), "<p>a&nbsp;<b>b</b><br>c</p><script>x</script>") == ["a b\nc"]


def test_redaction(spark):
    x = F.col("x")
    given = ["token=abc123", "sessionid=abc", "Opening 'http://a.com/live/1.m3u8?token=ZmFrZQ' for reading", "Content-Type=text/html", "UA=Mozilla", "http://u:p@h/x", None]
    out = one(spark, text.redact(x), *given)
    assert out[0] == "token=<redacted>" and out[1] == "sessionid=<redacted>" and "token=<redacted>" in out[2]
    assert out[3:5] == given[3:5] and out[5] == "http://<redacted>@h/x" and out[6] is None
    assert one(spark, text.finding_labels(x), "http://u:p@h/?token=abcd", "Token: abc1", "token=null", "x%3Ftoken%3Dabcd", "Authorization: Bearer abcdefgh1", None) == [["url-userinfo", "query"], ["value"], [], ["query"], ["value", "credential-header", "bearer-token"], None]
    assert one(spark, text.finding_labels(x, "access-token"), "abcd", "{{T}}") == [["field"], []] and one(spark, text.finding_labels(x, "key"), "abcd") == [[]]


def test_payload(spark):
    rows = spark.createDataFrame([(b"\xef\xbb\xbfa\r\nb",), ("中文".encode("gb18030"),), (None,)], "b binary")
    assert [r[0] for r in rows.select(payload.decode_text("b")).collect()] == ["a\r\nb", "中文", None]
    wrapped = "ABCDEFGH**" + base64.b64encode(b'{"a": 1}').decode()
    assert one(spark, payload.parse_config(F.col("x")).cast("string"), '{"a":1}', wrapped, "no", None) == ['{"a":1}', '{"a":1}', None, None]
    odd = "AB_DEF-H**" + base64.encodebytes(b'\xef\xbb\xbf{"a": 1}').decode()
    assert one(spark, payload.parse_config(F.col("x")).cast("string"), odd, "x" + wrapped, " " + wrapped + " ", "**" + wrapped) == ['{"a":1}', None, '{"a":1}', None]
    key, iv = b"$k3y", b"0123456789abc"
    made = spark.range(1).select(F.hex(F.substring(F.aes_encrypt(F.lit(b'{"b": [2, 3], "c": "0123456789"}'), F.lit(key.ljust(16, b"0")), F.lit("CBC"), F.lit("PKCS"), F.lit(iv.ljust(16, b"0"))), 17, 1000))).collect()[0][0]
    envelope = "2423" + key.hex() + "2324" + made.lower() + iv.hex()
    assert one(spark, payload.is_encrypted(F.col("x")), envelope, envelope[:-2], "2423", None) == [True, False, False, False]
    assert one(spark, payload.decrypt(F.col("x")), envelope, envelope.replace("2324", "2325"), None) == ['{"b": [2, 3], "c": "0123456789"}', None, None]
    assert one(spark, payload.parse_config(F.col("x")).cast("string"), envelope.upper()) == ['{"b":[2,3],"c":"0123456789"}']
    assert one(spark, payload.file_name(F.col("x")), "https://h/a/b%20c.PY?x=1", "https://h/py/", "https://h/a:b", None) == ["b c.PY", "spider.py", "a_b.py", None]
    assert [r[0] for r in spark.createDataFrame([(b"a\r\n\xff\x00\r",), (None,)], "b binary").select(payload.unix_lines("b")).collect()] == [b"a\n\xff\x00\r", None]
    nested = spark.createDataFrame([(b"if True:\n    class Spider:\n        pass\ndef homeContent():\n    pass\n",), ("# \u4e2d\nclass Spider:\n    async def searchContent(self): pass\n".encode("gb18030"),)], "b binary")
    assert [r[0] for r in nested.select(payload.is_plugin("b")).collect()] == [True, True]
    code = spark.createDataFrame([(b"class Spider:\n    def homeContent(self, f):\n        pass\n",), (b"class Spider: pass",), (b"def (",), (None,)], "b binary")
    assert [r[0] for r in code.select(payload.is_plugin("b")).collect()] == [True, False, False, False]


def test_dedup(spark):
    rows = spark.createDataFrame([("a", 2, "x", ""), ("a", 1, None, "q"), ("b", 3, " ", None), ("b", 3, " ", None), (None, 4, "n", "n")], "k string, o int, p string, q string")
    first = {r["k"]: r["o"] for r in dedup.keep_first(rows, [F.col("k")], [F.col("o")]).collect()}
    last = {r["k"]: r["o"] for r in dedup.keep_first(rows, [F.col("k")], [F.col("o")], last=True).collect()}
    assert first == {"a": 1, "b": 3, None: 4} and last == {"a": 2, "b": 3, None: 4}
    filled = {r["k"]: (r["p"], r["q"]) for r in dedup.coalesce_fields(rows, "k", ["p", "q"], "o").collect()}
    assert filled == {"a": ("x", "q"), "b": (None, None), None: ("n", "n")}
    assert dedup.keep_first(rows.limit(0), [F.col("k")], [F.col("o")]).count() == 0


def test_ranking(spark):
    rows = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    assert all(r["rank"] == r["id"] for r in ranking.global_rank(rows, [F.col("id")]).collect())
    assert sorted(r["id"] for r in ranking.rotate_sample(rows, [F.col("id")], 995, 10).collect()) == [0, 1, 2, 3, 4, 995, 996, 997, 998, 999]
    assert ranking.rotate_sample(rows.limit(0), [F.col("id")], 3, 2).count() == 0
    assert [r["id"] for r in ranking.page(rows, [F.col("id")], 100, 10).collect()] == list(range(990, 1000))
    assert ranking.top_per_group(rows, ["g"], [F.col("id")], 3).count() == 21


def test_classes(spark):
    schema = "kind string, status string, http_status int, failure_class string, detail string"
    rows = [("channel", "http_error", 404, "hard", ""), ("live", "http_error", 403, "", ""), ("live", "probe_failed", None, "", "timed out"), ("live", "http_error", 404, "", ""), ("live", "http_error", 404, "hard", "Server returned 5XX"), ("live", "http_error", 567, "hard", ""), (None, None, None, None, None)]
    out = spark.createDataFrame(rows, schema).select(health.decisive_failure(), health.soft_failure()).collect()
    assert [r[0] for r in out] == [False, False, False, True, False, False, False]
    assert [r[1] for r in out] == [False, True, True, False, True, True, False]


def test_streaks(spark):
    seq = ["hard", "hard", "ok", "hard", "soft", "hard", "hard"]
    rows = [("u", i, s) for i, s in enumerate(seq)] + [("v", 0, "ok"), (None, 0, "hard")]
    df = spark.createDataFrame(rows, "k string, o int, s string")
    args = ("k", ["o"], F.col("s") == "hard", F.col("s") == "ok")
    folded = [r["streak"] for r in health.streak_fold(df, *args).filter("k = 'u'").orderBy("o").collect()]
    assert folded == [1, 2, 0, 1, 1, 2, 3]
    assert {r["k"]: (r["streak"], r["removable"]) for r in health.streak_state(df, *args).collect()} == {"u": (3, True), "v": (0, False)}


def test_circuit_breaker(spark):
    rows = [(i, "channel", "h", "http_error", "hard") for i in range(6)] + [(9, "channel", "g", "http_error", "hard"), (10, "channel", None, "ok", "")]
    out = health.circuit_breaker(spark.createDataFrame(rows, "id int, kind string, host string, status string, failure_class string"))
    got = {r["id"]: r["status"] for r in out.collect()}
    assert [got[i] for i in range(6)] == ["upstream_incident"] * 6 and got[9] == "http_error" and got[10] == "ok"


def test_whitelist(spark):
    df = spark.createDataFrame([("gone.example",), ("a.gone.example",), ("gone.example.evil.com",), ("",)], "h string")
    assert sorted(r[0] for r in health.on_whitelist(df, F.col("h"), ["gone.example"]).collect()) == ["a.gone.example", "gone.example"]
    assert health.on_whitelist(df, F.col("h"), []).count() == 0


def test_state(spark):
    old = spark.createDataFrame([("a", 1, "ok"), ("b", 1, "ok")], "k string, o int, s string")
    new = spark.createDataFrame([("b", 2, None), ("c", 2, "x"), ("c", 3, "y")], "k string, o int, s string")
    got = {r["k"]: (r["o"], r["s"]) for r in health.upsert_state(old, new, "k", ["o"], ["s"]).collect()}
    assert got == {"a": (1, "ok"), "b": (2, "ok"), "c": (3, "y")}
    t = lambda d: dt.datetime(2031, 1, d)
    r = lambda *x: spark.createDataFrame(list(x), "url string, removed_at timestamp")
    kept = health.removal_history(r(("a", t(1)), ("b", t(2))), r(("b", t(2))), r(("a", t(9)), ("c", t(9))), "url")
    assert {x["url"]: x["removed_at"].day for x in kept.collect()} == {"a": 1, "c": 9}


def test_cascade(spark):
    df = spark.createDataFrame([("CCTV1", "x"), (None, "sports"), (None, None)], "name string, grp string")
    rules = [("name", "(?i)cctv", "national"), ("grp", "sport", "sport")]
    assert [r[0] for r in df.select(classify({"name": F.col("name"), "grp": F.col("grp")}, rules, "?")).collect()] == ["national", "sport", "?"]


def test_playlists(spark):
    m3u = '#EXTM3U\n#EXTINF:-1 group-title="G" tvg-logo="L",Old\n#EXTINF:-1 group-title="H",New, name\nhttp://a/1\nhttp://a/2\n#EXTINF:-1,\nhttp://a/3\n#EXTINF:-1 nothing\nhttp://a/4\n'
    other = "#EXTM3U\r\n#EXTINF:-1,One\r\n# remark\r\nhttp://b/1\r\n#EXTINF:-1,Two\r\nhttp://b/2\r\n"
    texts = spark.createDataFrame([("s", m3u), ("s", other), ("s", other), ("t", None), ("e", "")], "source string, text string")
    assert sorted((r["name"], r["url"], r["group_raw"]) for r in playlists.m3u(texts).collect()) == sorted([("name", "http://a/1", "H")] + 2 * [("One", "http://b/1", ""), ("Two", "http://b/2", "")])
    assert playlists.m3u(texts.limit(0)).count() == 0
    txt = spark.createDataFrame([("s", "# c\nfirst,http://a/0\nNews,#genre#\nOne,http://a/1\nbad line\nTwo,rtmp://b/2,x\nSect,Grp#genre#\nThree,http://a/3\n#genre#Alone\nFour,HTTP://a/4"), ("s", "Five,http://a/5"), ("n", None)], "source string, text string")
    got = [(r["name"], r["group_raw"], r["source_section"]) for r in playlists.txt(txt).orderBy("pos", "name").collect()]
    assert sorted(got) == sorted([("first", "", ""), ("Five", "", ""), ("One", "News", "News"), ("Two", "News", "News"), ("Three", "Grp", "Sect"), ("Four", "Alone", "")])
    assert [(r["line_no"], r["value"]) for r in playlists.line_list(txt).filter("value LIKE 'first%'").collect()] == [(2, "first,http://a/0")]
    hls = spark.createDataFrame([("m", '#EXTM3U\n#EXT-X-STREAM-INF:BANDWIDTH=1000\nlow/index.m3u8\n#EXT-X-MAP:URI="init.mp4"\nseg.ts\na,b')], "source string, text string")
    assert [(r["kind"], r["reference"]) for r in playlists.hls(hls).orderBy("pos").collect()] == [("variant", "low/index.m3u8"), ("map", "init.mp4"), ("segment", "seg.ts")]
    based = hls.withColumn("base", F.lit("https://example.com/live/master.m3u8"))
    assert [r["reference"] for r in playlists.hls(based).orderBy("pos").collect()] == ["https://example.com/live/low/index.m3u8", "https://example.com/live/init.mp4", "https://example.com/live/seg.ts"]
    many = spark.createDataFrame([("m", "".join(f"#EXT-X-STREAM-INF:B={i}\nv{i}\n" for i in range(6)) + "s1\ns2\ns3\ns4\n", "https://h/")], "source string, text string, base string")
    assert [r["reference"] for r in playlists.probe_candidates(many).orderBy("rank").collect()] == ["https://h/v5", "https://h/v4", "https://h/v3", "https://h/s1", "https://h/s2"]


def test_round_trip(spark, tmp_path):
    rows = [(2, "B", "http://b/1", "G", "l", "t"), (1, "A", "http://a/1", "", None, None), (3, None, None, None, None, None)]
    channels = spark.createDataFrame(rows, "row_id int, name string, url string, group_name string, logo string, tvg_id string")
    playlists.write_m3u(channels, f"{tmp_path}/m", [F.col("row_id")])
    lines = "\n".join(r[0] for r in spark.read.text(f"{tmp_path}/m").collect())
    assert lines.startswith("#EXTM3U") and lines.index("http://a/1") < lines.index("http://b/1")
    assert playlists.read_state(spark, f"{tmp_path}/none", "k string").count() == 0


def test_stream(spark, tmp_path):
    from playweave.streaming import streaks

    rows = [("u", 1, "decisive"), ("u", 2, "decisive"), ("u", 3, "decisive"), ("v", 1, "ok"), (None, 1, "ok")]
    spark.createDataFrame(rows, "key string, at long, outcome string").write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("key string, at long, outcome string").parquet(f"{tmp_path}/in")
    q = streaks.streaks(s).writeStream.outputMode("update").format("memory").queryName("streaks").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(120)
    assert {r["key"]: (r["streak"], r["removable"]) for r in spark.sql("SELECT * FROM streaks").collect()} == {"u": (3, True), "v": (0, False)}
