"""Configurations on literal rows: sanitising, references, credentials, merging, assembly, checks, rules, and the aggregation run."""

import json

import pytest
from pyspark.sql import functions as F

from playweave.functions import nested
from playweave.operators import classify, configs, media, review
from playweave.operators.classify import Stage
from playweave.plans import pipelines, views


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(column).collect()]


def test_reasons(spark):
    x = F.col("x")
    sites = ['{"api":"csp_A"}', '{"api":" "}', '{"name":"n"}', '{"api":"https://a/{{SECRET_X}}"}', '{"api":"csp","ext":"{{secret_y}}"}', '{"api":"https://u:pw@a/"}', '{"api":"./x.py"}', "[1]", "no", None]
    assert one(spark, configs.site_reason(x), *sites) == ["", "no_api", "no_api", "placeholder", "placeholder", "credentials", "relative", "not_object", "not_object", "not_object"]
    lives = ['{"url":"https://a/l.m3u"}', '{"url":""}', '{"url":"../a"}', '{"url":"https://a/logo.PNG?x"}', '{"url":"https://a/?token=abcd"}', '{"url":"https://a/{{SECRET_T}}"}']
    assert one(spark, configs.live_reason(x), *lives) == ["", "no_url", "relative", "image", "credentials", "placeholder"]


def test_nested(spark):
    x = F.col("x")
    o = {"key": "k1", "ext": {"token": "abc123", "list": ["http://u:p@h/", "x?sign=abcd", {"auth": "{{T}}"}]}, "n": 1}
    paths = [(r["path"], r["label"]) for r in one(spark, nested.credential_paths(x), json.dumps(o))[0]]
    assert paths == [("$.ext.token", "field"), ("$.ext.list[0]", "url-userinfo"), ("$.ext.list[1]", "query")]
    clean = one(spark, nested.without_credentials(x), json.dumps(o), "plain", "Token: abc123", None)
    assert json.loads(clean[0]) == {"key": "k1", "ext": {"token": "<redacted>", "list": ["http://<redacted>@h/", "x?sign=<redacted>", {"auth": "{{T}}"}]}, "n": 1} and clean[1:] == ["plain", "Token=<redacted>", None]
    assert one(spark, nested.credential_paths("x"), clean[0], None, "") == [[], None, []]
    deep = "[" * 100_000 + '"http://u:p@h/"' + "]" * 100_000
    assert one(spark, nested.credential_paths("x"), deep)[0] and "u:p" not in one(spark, nested.without_credentials("x"), deep)[0]
    config = {"sites": [{"api": "./a.py", "jar": "csp_X", "name": "./n"}, {"ext": {"url": " ../b c.json "}}], "logo": "https://h/é"}
    r = spark.createDataFrame([(json.dumps(config), "https://h/x/y.json")], "x string, b string").select(nested.resolved_references("x", "b")).first()[0]
    assert json.loads(r) == {"sites": [{"api": "https://h/x/a.py", "jar": "csp_X", "name": "./n"}, {"ext": {"url": "https://h/b%20c.json"}}], "logo": "https://h/%C3%A9"}
    assert one(spark, nested.plugin_references(x), '{"a":[{"api":"h/a.py"},{"ext":"b.PY?x"},{"name":"c.py"},{"jar":"d.pyc"}]}', None) == [["h/a.py", "b.PY?x"], None]
    assert one(spark, nested.addresses(x), '{"a":["http://h/1",{"b":"https://h/2"},"ftp://x"]}') == [["http://h/1", "https://h/2"]]
    nodes = one(spark, nested.matching_nodes([["id", "vid"], ["title", "name"]])("x"), '{"list":[{"id":1,"title":"a","sub":{"id":2,"name":"b"}},{"vid":"","title":"c","kids":[{"vid":"3","name":"d"}]}]}')[0]
    assert [json.loads(n).get("title") or json.loads(n)["name"] for n in nodes] == ["a", "d"]
    wire = spark.createDataFrame([(bytes([8, 150, 1, 18, 2, 104, 105, 29, 1, 0, 0, 0, 33]) + bytes(8),), (bytes([8]),), (bytes([18, 9, 1]),), (None,)], "b binary").select(nested.wire_fields("b")).collect()
    assert [(f["number"], f["wire"], bytes(f["value"])) for f in wire[0][0]] == [(1, 0, (150).to_bytes(8, "big")), (2, 2, b"hi"), (3, 5, b"\x01\0\0\0"), (4, 1, bytes(8))]
    assert [r[0] for r in wire[1:]] == [[], [], None]


def test_merge_and_assembly(spark):
    rows = spark.createDataFrame([(1, '{"key":"a","api":"x","name":"","list":[1]}'), (2, '{"key":"a","api":"x","name":"n","list":[2],"q\\"":true}'), (3, '{"key":"b","api":"x"}'), (4, "broken"), (5, None)], "o int, object string")
    merged = configs.merge_objects(rows, ["key", "api"], ["o"])
    assert [json.loads(r["object"]) for r in merged.orderBy("first").collect()] == [{"key": "a", "api": "x", "list": [1], "name": "n", 'q"': True}, {"key": "b", "api": "x"}]
    lives = configs.merge_objects(spark.createDataFrame([(1, '{"name":"l","url":"https://own/merged.m3u"}'), (2, '{"name":"l","url":"https://o/1"}')], "o int, object string"), ["name", "url"], ["o"])
    config = configs.assemble(merged, lives, {"flags": ["f"]}, {"name": "own", "url": "https://own/merged.m3u"}, name="N", spider="https://h/s.jar")
    assert [x["url"] for x in config["lives"]] == ["https://o/1", "https://own/merged.m3u"] and config["flags"] == ["f"] and config["ads"] == []
    published = configs.subscription(config, {"spider": "https://old/legacy.jar", "logo": "mine"}, legacy=("https://old/legacy.jar",))
    assert "name" not in published and published["spider"] == "https://h/s.jar" and published["logo"] == "mine"
    configs.check_subscription(published)
    with pytest.raises(ValueError, match="sites"):
        configs.check_subscription({**published, "sites": None})
    bad = spark.createDataFrame([('{"api":"./a","type":3}',), ('{"api":"./a","type":3,"ext":"http://u:p@h"}',), ('{"key":"{{SECRET_A}}"}',)], "object string")
    found = configs.violations(bad, spark.createDataFrame([('{"url":"https://a/b.png"}',)], "object string"), "http://s")
    assert {r["rule"] for r in found.collect()} == {"relative", "credentials", "placeholder", "image", "repeated", "spider"}
    with pytest.raises(ValueError, match="credentials"):
        configs.assert_valid(found)
    configs.assert_valid(configs.violations(bad.limit(0), bad.limit(0), "https://s"))


def test_rules(spark, tmp_path):
    assert classify.load_rules(spark, f"{tmp_path}/none.json")["section_categories"] == {}
    (tmp_path / "r.json").write_text('﻿{"section_categories": {"S": "sec"}, "raw_group_categories": {"G": "grp", "H": "hk"}, "private_section_prefixes": ["P_"], "channel_name_categories": {"abc": "byname"}}')
    rules = classify.load_rules(spark, f"{tmp_path}/r.json")
    for content, message in (('{"section_categories": []}', "type"), ("[1]", "object"), ("{", "JSON")):
        (tmp_path / "b.json").write_text(content)
        with pytest.raises(ValueError, match=message):
            classify.load_rules(spark, f"{tmp_path}/b.json")
    stages = classify.stages_of(rules, [Stage("pattern", "name", "CCTV", "national", unless=("name", "港澳"))], [Stage("pattern", "group", "^x", "xs")], ("local", ["hk"]))
    rows = [("CCTV1", "G", "P_1", "P_1"), ("CCTV1", "G", "S", "national"), ("CCTV1港澳版", "H", "", "hk"), ("local", "H", "", "?"), ("ABC", "", "", "byname"), ("n", "G", "S", "sec"), ("n", "G　", None, "grp"), ("n", "xy", None, "xs"), (None, None, None, "?")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, name string, grp string, section string, expected string")
    got = df.orderBy("i").select(classify.cascade({"name": F.col("name"), "group": F.col("grp"), "section": F.col("section")}, stages, "?")).collect()
    assert [r[0] for r in got] == [r[3] for r in rows]


def test_aggregate(spark):
    config = json.dumps({"sites": [{"key": "a", "api": "./a.py"}, {"key": "a", "api": "https://h/c/a.py", "name": "later"}, {"key": "b", "api": ""}], "lives": [{"name": "l", "url": "https://h/l.m3u"}], "flags": ["f"]})
    m3u, txt = "#EXTM3U\n#EXTINF:-1 group-title=\"News\",One HD\nhttp://a/1\n#EXTINF:-1,Two\nhttp://dead/1\n#EXTINF:-1,Two\nhttp://dead.safe.example/1\n", "G,#genre#\nOne,http://a/1\nThree,http://a/3\nF,rtmp://a/4\n"
    rows = [("c", 1, config.encode(), None), ("m", 2, m3u.encode(), None), ("t", 3, txt.encode("gb18030"), None), ("e", 4, None, "HTTP 404 token=abcd"), ("x", 5, b"hello", None), ("m", 6, b"#EXTM3U\n", None)]
    fetched = spark.createDataFrame([(s, n, "https://h/c/x.json", 200 if d else 404, "text/plain", d, e) for s, n, d, e in rows], "source string, source_line int, effective_url string, http_status int, content_type string, data binary, error string")
    dead = spark.createDataFrame([("http://dead/1 ",), ("http://dead.safe.example/1",)], "url string")
    out = pipelines.aggregate(fetched, [Stage("pattern", "group", "News", "news")], "?", dead, spark.createDataFrame([("safe.example",)], "value string"))
    status = {(r["source"], r["source_line"]): (r["kind"], r["status"], r["channels"], r["sites"], r["detail"]) for r in out["sources"].collect()}
    assert status == {("c", 1): ("tvbox_json", "reachable", 0, 2, None), ("m", 2): ("m3u", "reachable", 3, 0, None), ("t", 3): ("txt", "reachable", 3, 0, None), ("e", 4): ("unknown", "http_error", 0, 0, "HTTP 404 token=<redacted>"), ("x", 5): ("unknown", "invalid_config", 0, 0, None), ("m", 6): ("m3u", "manifest_ok", 0, 0, None)}
    assert {r["url"]: (r["name"], r["group_name"], r["channel_key"], r["quality"]) for r in out["channels"].collect()} == {"http://a/1": ("One HD", "news", "one", "高清"), "http://dead.safe.example/1": ("Two", "?", "two", ""), "http://a/3": ("Three", "?", "three", "")}
    assert [json.loads(r["object"]) for r in out["sites"].collect()] == [{"key": "a", "api": "https://h/c/a.py", "name": "later"}]
    assert out["rejected"].count() == 1 and out["pending"].count() == 2 and out["inventory"].count() == 8 and out["meta"].first()["value"] == '["f"]'


def test_media(spark):
    x = F.col("x")
    assert one(spark, media.duration(x.cast("int")), "61", "-1", None) == ["01:01", "", ""]
    assert spark.createDataFrame([("s1|a|b",), ("zz|a",), ("s1",), (None,)], "x string").select(*media.dispatched(x, ["s1"])).collect() == [("s1", "a|b"), (None, None), (None, None), (None, None)]
    texts = spark.createDataFrame([("k", "[offset:+500]\n[00:01.5][01:02]two words\n[00:03:250]<0:01>x\n[00:04]  \nnone"), ("n", None)], "k string, text string")
    lines = media.timed_lines(texts, "k")
    assert sorted((r["start"], r["text"]) for r in lines.collect()) == [(2000, "two words"), (3750, "x"), (62500, "two words")]
    words = {(r["start"], r["n"]): (r["word"], r["at"], r["length"]) for r in media.word_times(lines, "k").collect()}
    assert words[2000, 0] == ("two", 0, 656) and words[2000, 1] == ("words", 656, 1094) and words[62500, 1] == ("words", 900, 1500)
    packed = spark.createDataFrame([("g", 2, "b$", "2"), ("g", 1, "a", "1"), ("g", 1, "a", "1"), ("g", 3, None, "3")], "g string, o int, t string, i string").groupBy("g").agg(media.packed(F.collect_list(F.struct("o", "t", "i")), "t", "i").alias("p"))
    assert packed.first()["p"] == "a$1#b＄$2#$3"
    assert one(spark, review.json_in(x).cast("string"), 'say ```json\n{"a": 1}\n``` {', 'x {"b": 2} y', "[1]", "none", None) == ['{"a":1}', '{"b":2}', None, None, None]
    items = spark.createDataFrame([(i, f"title {i:02d}", "t", "T", "", "", "a$$$b", "x$1#y$2$$$z$3") for i in range(35)], "vod_id int, vod_name string, type_id string, type_name string, vod_pic string, vod_remarks string, vod_play_from string, vod_play_url string")
    views.register(spark, items, prefix="test_")
    assert spark.sql("SELECT * FROM test_category_content('t', 2)").count() == 5 and spark.sql("SELECT * FROM test_search_content('TITLE 1')").count() == 10
    assert [tuple(r) for r in spark.sql("SELECT * FROM test_player_content('3', 'b')").collect()] == [("b", "z", "3")] and spark.sql("SELECT * FROM test_search_content(' ')").count() == 0
