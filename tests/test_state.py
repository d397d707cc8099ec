"""State carried from run to run on literal rows: streaks with a previous state, health of lines, samples, removals, whitelists, routes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playweave import schemas
from playweave.operators import checks, health, skew, state, whitelist
from playweave.plans import pipelines

T0 = dt.datetime(2031, 10, 23)
CHECK = "check_id int, kind string, name string, url string, status string, http_status int, detail string, failure_class string, host string, checked_at timestamp, source string"


def items(spark, rows):
    full = [(i, r.get("kind", "live"), r.get("name", "n"), r["url"], r.get("status"), r.get("http_status"), r.get("detail", ""), r.get("failure_class", ""), r.get("host", "gone.example"), T0, "s") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, CHECK)


def previous(spark, rows):
    return spark.createDataFrame([(u, n, [(T0, "http_error", "HTTP 404", "hard", 404, "h")] * min(n, 3), "hard") for u, n in rows], "url string, count int, history array<struct<checked_at:timestamp,status:string,detail:string,failure_class:string,http_status:int,host:string>>, failure_class string")


def test_streaks_with_a_previous_state(spark):
    hard = {"status": "http_error", "http_status": 404, "failure_class": "hard"}
    rows = [{"url": "third", **hard}, {"url": "second", **hard}, {"url": "new", **hard}, {"url": "ok", "status": "probe_ok"}, {"url": "kept", "status": "manifest_ok"}, {"url": "soft", **hard, "detail": "timed out"}, {"url": "channel", **hard, "kind": "channel"},
            {"url": "http://a.safe.example/x", **hard}, {"url": None, **hard}, {"url": "twice", **hard}, {"url": "twice", "status": "probe_ok"}]
    marked = whitelist.mark(items(spark, rows), "url", spark.createDataFrame([("safe.example",)], "value string"))
    before = previous(spark, [("third", 2), ("second", 1), ("ok", 3), ("kept", 3), ("soft", 2), ("http://a.safe.example/x", 2), ("gone", 3), ("twice", 1)])
    got = {r["url"]: (r["count"], r["removable"], len(r["history"]), r["failure_class"], r["whitelisted"]) for r in state.fold_streaks(marked, before, ["check_id"]).collect()}
    assert got == {
        "third": (3, True, 3, "hard", False), "second": (2, False, 2, "hard", False), "new": (1, False, 1, "hard", False), "ok": (0, False, 0, "", False), "kept": (3, False, 3, "hard", False),
        "soft": (2, False, 2, "hard", False), "http://a.safe.example/x": (0, False, 0, "", True), "twice": (0, False, 0, "", False),
    }
    many = state.fold_streaks(items(spark, [{"url": "u", **hard}]), previous(spark, [("u", 7)]), ["check_id"]).first()
    assert many["count"] == 8 and len(many["history"]) == 3
    assert state.fold_streaks(items(spark, []), before, ["check_id"]).count() == 0
    groups = {r["url"]: r["group"] for r in state.removable_report(state.fold_streaks(marked, before, ["check_id"])).collect()}
    assert groups["third"] == "removable" and groups["second"] == "pending" and groups["ok"] == "clean"


def run(spark, rows):
    df = items(spark, rows)
    for c in ("channel_key", "category", "final_url", "content_type", "evidence"):
        df = df.withColumn(c, F.lit("").cast("string"))
    return df.withColumns({"source_line": F.lit(1), "attempts": F.lit(1), "redirect_count": F.lit(0), "url_hash": F.sha2("url", 256)})


def test_health_of_lines(spark):
    hard = {"kind": "channel", "status": "http_error", "http_status": 404, "failure_class": "hard"}
    rows = [{"url": "http://a.example/1?token=abcd", **hard}, {"url": "http://b.example/1", **hard}, {"url": "http://192.168.1.10/x", **hard}, {"url": "http://c.example/1", **hard, "status": "upstream_incident", "failure_class": "soft"},
            {"url": "http://d.example/1", "kind": "channel", "status": "probe_ok"}, {"url": "http://e.example/1", "kind": "channel", "status": "manifest_ok"}, {"url": "http://safe.example/1", **hard}, {"url": "http://live.example/", "kind": "live"}]
    checked = whitelist.mark(run(spark, rows), "url", spark.createDataFrame([("safe.example",)], "value string"))
    old = spark.createDataFrame([(u, n, "observe") for u, n in (("http://a.example/1?token=abcd", 2), ("http://d.example/1", 2), ("http://e.example/1", 2), ("http://safe.example/1", 2), ("http://unsampled.example/", 1), ("http://vanished.example/", 1))], "url string, decisive_failures int, verdict string").withColumn("url_hash", F.sha2("url", 256))
    ledger = spark.createDataFrame([(u,) for u in ("http://unsampled.example/", "http://a.example/1?token=abcd")], "url string").select(F.sha2("url", 256).alias("url_hash"))
    got = {r["url"]: (r["decisive_failures"], r["verdict"]) for r in state.channel_health(checked, old, ledger, ["check_id"]).collect()}
    assert got == {
        "http://a.example/1": (3, "candidate_remove"), "http://b.example/1": (1, "observe"), "http://192.168.1.10/x": (0, "skip_internal"), "http://c.example/1": (0, "observe_upstream"), "http://d.example/1": (0, "keep"),
        "http://e.example/1": (2, "observe_soft"), "http://safe.example/1": (0, "whitelisted"), "http://unsampled.example/": (1, "observe"),
    }
    assert state.channel_health(checked.limit(0), old, ledger.limit(0), ["check_id"]).count() == 6
    assert "http://vanished.example/" in {r["url"] for r in state.channel_health(checked, old, ledger.limit(0), ["check_id"]).collect()}


def test_samples_and_evidence(spark):
    channels = [{"url": f"http://h{i}.example/", "kind": "channel", "status": "probe_ok"} for i in range(5)] + [{"url": "http://10.0.0.1/", "kind": "channel"}, {"url": "http://site/", "kind": "site"}]
    every = run(spark, channels)
    empty = spark.createDataFrame([], schemas.URL_STATE)
    first = state.priority_sample(every, empty, 2, 0, tie="check_id")
    assert sorted(r["url"] for r in first.collect()) == ["http://h0.example/", "http://h1.example/", "http://site/"]
    assert state.next_offset(every, 0, 2) == 2 and state.next_offset(every, 4, 2) == 1 and state.next_offset(every.limit(0), 3, 2) == 0
    evidence = state.url_state(every, first, empty, ["check_id"])
    assert evidence.filter("last_success IS NOT NULL").count() == 2
    second = state.priority_sample(every, evidence, 3, 0, tie="check_id").filter("kind = 'channel'")
    assert sorted(r["url"] for r in second.collect()) == ["http://h2.example/", "http://h3.example/", "http://h4.example/"]
    failed = run(spark, [{"url": "http://h0.example/", "kind": "channel", "status": "http_error", "failure_class": "hard"}])
    later = {r["url"]: (r["status"], r["last_success"]) for r in state.url_state(every.filter("url <> 'http://h1.example/'"), failed, evidence, ["check_id"]).collect()}
    assert later["http://h0.example/"] == ("http_error", T0) and "http://h1.example/" not in later
    assert state.priority_sample(every, empty, 0).count() == 7


def test_removals(spark):
    health_rows = spark.createDataFrame([("h1", "u1", "candidate_remove"), ("h2", "u2", "candidate_remove"), ("h3", "u3", "keep"), ("h4", "u4", "other")], "url_hash string, url string, verdict string")
    table = schemas.conform(health_rows, schemas.HEALTH).withColumn("decisive_failures", F.lit(3))
    day = lambda d: dt.datetime(2031, 1, d)
    old = schemas.conform(spark.createDataFrame([("u1", day(1)), ("u3", day(2)), ("u5", day(3))], "url string, removed_at timestamp"), schemas.REMOVED)
    got = {r["url"]: r["removed_at"].day for r in state.removal_records(table, old, F.lit(day(9))).collect()}
    assert got == {"u1": 1, "u2": 9, "u5": 3}
    checked = run(spark, [{"url": "u1", "kind": "channel"}])
    assert [r["url"] for r in state.to_recheck(old, checked).orderBy("url").collect()] == ["u3", "u5"]
    clusters = schemas.conform(spark.createDataFrame([(str(i), "http://h/", "observe", "x" if i % 3 else "y") for i in range(9)] + [("z", "u", "keep", "q")], "url_hash string, url string, verdict string, status string"), schemas.HEALTH)
    assert [(r["status"], r["count"]) for r in state.error_clusters(clusters).collect()] == [("x", 6), ("y", 3)]


@pytest.mark.parametrize("extra", [0, 300])
def test_whitelist(spark, extra):
    """Short lists stand in the plan, long ones go through an automaton; both mean the same."""
    lines = ["# c", "gone.example", " .cdn.test # rest", "https://Exact.example/a?x=1", "", "﻿first.example"] + [f"host{i}.example" for i in range(extra)] + [f"https://u{i}.example/path" for i in range(extra)]
    urls = {"http://gone.example/a": True, "http://a.gone.example:80/": True, "http://gone.example.evil.com/": False, "http://notgone.example/": False, "http://x.cdn.test/": True, "https://exact.example/A?x=1&y=2": True, "https://other.example/?u=https://exact.example/a?x=1": True, "http://exact.example/b": True, "http://first.example/": True, "no address": False, None: False}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r["url"]: r["whitelisted"] for r in whitelist.mark(df, "url", spark.createDataFrame([(x,) for x in [*lines, None]], "value string")).collect()} == urls
    assert not any(r["whitelisted"] for r in whitelist.mark(df, "url", spark.createDataFrame([], "value string")).collect())


def test_routes(spark):
    rows = [
        ("live", "http://192.168.0.1/a", None, None, None, None, "skip_internal", "skip_internal", ""), ("source", "http://a/x", "invalid_config", 200, None, None, "config", "invalid_config", ""), ("site", "csp_X", "requires_app", None, None, None, "builtin", "requires_app", ""),
        ("live", "http://a/x", None, None, None, None, "no_answer", "http_error", "soft"), ("live", "http://a/x", None, 404, None, None, "http_error", "http_error", "hard"), ("live", "http://a/x", None, 503, None, None, "http_error", "http_error", "soft"),
        ("live", "http://a/x.txt?y", None, 200, None, "a,b", "list", "probe_failed", "hard"), ("channel", "http://a/hoy", None, 200, "text/plain", "#EXTM3U\n/api/1", "bare_hls", "probe_failed", "hard"), ("channel", "http://a/x.m3u8", None, 200, None, "#EXTM3U\n#EXT-X-STREAM-INF:B\nv", "master", "probe_failed", "hard"),
        ("channel", "http://a/x.m3u8", None, 200, None, "#extm3u\nseg.ts", "media_playlist", "probe_failed", "hard"), ("channel", "http://a/x.flv", None, 200, None, "", "media", "probe_failed", "hard"), ("channel", "http://a/x", None, 200, None, " binary", "media", "probe_failed", "hard"),
        ("channel", "http://a/x", None, 200, None, '{"msg": "请登录后观看"}', "unknown", "playback_unverified", ""), ("channel", "http://a/x.mp4", None, 200, None, '{"msg": "由于版权原因，请登录后观看"}', "media", "probe_failed", "soft"), ("channel", "http://a/x.mp4", None, 200, None, '{"msg": "节目已下线"}', "media", "probe_failed", "hard"),
        ("site", "http://a/x", "requires_app", 200, None, "", "app", "requires_app", ""), ("site", "http://a/x", None, 200, None, "", "reachable", "reachable", ""),
    ]
    df = spark.createDataFrame([(i, *r[:6], "") for i, r in enumerate(rows)], "i int, kind string, url string, status string, http_status int, content_type string, body string, detail string")
    got = [(r["route"], r["new_status"], r["new_class"]) for r in checks.check_outcome(df, F.lit("probe_failed")).orderBy("i").collect()]
    assert got == [r[6:] for r in rows]
    assert checks.check_outcome(df).filter("route = 'list'").first()["new_status"] == "manifest_ok"
    probes = [("a", 1, 1, None, "bad"), ("a", 2, 0, "video", None), ("b", 1, 139, None, None), ("b", 2, 0, "video", None), ("c", 1, 1, None, "timed out"), ("c", 2, 0, "v", None), ("d", 1, 1, "", "bad"), ("d", 2, 0, " ", "no stream"), ("e", 1, -11, None, None)]
    out = checks.probe_outcomes(spark.createDataFrame(probes, "k string, n int, code int, output string, error string"), "k", "n")
    assert {r["k"]: (r["status"], r["tries"]) for r in out.collect()} == {"a": ("probe_ok", 2), "b": ("playback_unverified", 1), "c": ("manifest_ok", 1), "d": ("probe_failed", 2), "e": ("playback_unverified", 1)}


def test_health_run(spark):
    """A whole run over recorded answers: three runs of a dead line make it a candidate."""
    every = run(spark, [{"url": "http://dead.example/1.mp4", "kind": "channel", "status": "unverified"}, {"url": "http://fine.example/1.mp4", "kind": "channel", "status": "unverified"}, {"url": "http://live.example/1.mp4", "kind": "live", "status": "unverified"}])
    answers = spark.createDataFrame([(0, 404, "", "", "HTTP 404", None), (1, 200, "video/mp4", "x", "", "probe_ok"), (2, 410, "", "", "HTTP 410", None)], "check_id int, http_status int, content_type string, body string, detail string, probed string")
    kept = {"streaks": previous(spark, []), "health": spark.createDataFrame([], schemas.HEALTH), "evidence": spark.createDataFrame([], schemas.URL_STATE), "removed": spark.createDataFrame([], schemas.REMOVED)}
    ledger, white = every.select("url_hash"), spark.createDataFrame([], "value string")
    for _ in range(3):
        out = pipelines.health_run(every, answers, kept, ledger, white, 10, 0, "check_id", F.lit(T0))
        kept = {k: spark.createDataFrame(out[k].collect(), out[k].schema) for k in kept}
    assert {r["name"] + r["url"]: r["verdict"] for r in out["health"].collect()} == {"nhttp://dead.example/1.mp4": "candidate_remove", "nhttp://fine.example/1.mp4": "keep"}
    assert [(r["url"], r["count"], r["removable"]) for r in kept["streaks"].collect()] == [("http://live.example/1.mp4", 3, True)]
    assert [r["url"] for r in kept["removed"].collect()] == ["http://dead.example/1.mp4"] and out["report"].count() == 3


def test_facts_of_hot_groups(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(999, None)], "i int, k string")
    facts = rows.filter("k IS NOT NULL").groupBy("k").count()
    for how, n in (("inner", 300), ("left", 301)):
        for most in (0, 1, 10):
            got = skew.attach_group_facts(rows, facts, ["k"], "count", hot=10, how=how, most_hot=most).collect()
            assert len(got) == n and len({r["i"] for r in got}) == n and all(r["count"] == (200 if r["k"] == "hot" else 1) for r in got if r["k"])
    sized = rows.filter("i < 60").join(rows.filter("i < 60").groupBy("k").agg(F.count("i").alias("n")), "k")
    pairs = skew.pairs_within(sized, ["k"], "n", [F.col("i").alias("a")], [F.col("i").alias("b")], block=7)
    assert pairs.count() == 40 * 40 + 20


def test_conform(spark):
    df = spark.createDataFrame([("200", "x", 3), ("none", "y", None)], "http_status string, kind string, extra int")
    out = schemas.conform(df, schemas.ITEM)
    assert [(r["kind"], r["http_status"], r["url"]) for r in out.collect()] == [("x", 200, None), ("y", None, None)] and "extra" not in out.columns
    assert health.host_incidents(out).count() == 0


def test_gate(spark, tmp_path):
    from playweave.operators import publish

    df = spark.createDataFrame([(1, "http://u:p@h/?token=abcd", "plain", "abc"), (2, "fine", None, "{{T}}"), (3, None, "Token: abc123", "")], "n int, url string, detail string, token string")
    assert [r["findings"] for r in publish.findings(df).orderBy("n").collect()] == [["url:url-userinfo", "url:query", "token:field"], [], ["detail:value"]]
    assert [tuple(r)[1:] for r in publish.guarded(df).orderBy("n").collect()] == [("http://<redacted>@h/?token=<redacted>", "plain", "<redacted>"), ("fine", None, "{{T}}"), (None, "Token=<redacted>", "")]
    assert publish.write_report({"a": df, "b": df.limit(0)}, str(tmp_path)) == {"a": 2, "b": 0} and spark.read.json(f"{tmp_path}/a").count() == 3
