"""Sources, sinks and streams: the network is replaced, files are temporary."""

import io
import urllib.error

import pytest
from pyspark.sql import functions as F

from playweave import common
from playweave.sources import playlists, web
from playweave.streaming import streaks


class Reply(io.BytesIO):
    def __init__(self, data, url, status=200):
        super().__init__(data)
        self.status, self.headers, self._url = status, {"Content-Type": "text/plain"}, url

    def geturl(self):
        return self._url


def test_fallbacks():
    calls = []

    def opener(request, timeout):
        calls.append(request.full_url)
        if request.full_url.startswith("https://relay.example/"):
            return Reply(b"ok", request.full_url)
        raise urllib.error.HTTPError(request.full_url, 403, "no", {}, None)

    a = web.attempt("http://a/x y", ["http://a/x y", "http://m/"], retries=2, opener=opener)
    assert (a.data, a.error, a.status, a.attempts) == (None, "HTTP 403", 403, 4) and len(calls) == 4
    a = web.attempt("http://a/é", ["http://a/é"], retries=1, opener=opener, relay="https://relay.example/?u={url}")
    assert a.data == b"ok" and a.via_relay and a.url == "http://a/é" and calls[-1] == "https://relay.example/?u=http%3A%2F%2Fa%2F%C3%A9"
    assert web.relay_address("http://a/", "http://relay/") is None and web.relay_address("http://a/", "https://u:p@r/") is None and web.relay_address("https://r/x", "https://r/") is None
    assert web.attempt("http://a/", [], opener=lambda r, timeout: Reply(b"x" * 11, "http://b/"), limit=10).error == "too large"
    assert web.error_label(urllib.error.URLError(TimeoutError())) == "URLError: TimeoutError"


def test_checks(spark):
    """Agents in turn, one confirmation where all were told 404, and what the attempts come to."""
    from playweave.operators import health

    seen, waits = [], []

    def opener(answers):
        left = list(answers)

        def open_(request, timeout):
            seen.append(request.full_url)
            code = left.pop(0)
            if code is None:
                raise urllib.error.URLError("timed out")
            if code >= 400:
                raise urllib.error.HTTPError(request.full_url, code, "no", {}, None)
            return Reply(b"#EXTM3U", "http://final/", code)

        return open_

    run = lambda *codes: web.check("http://h/a b", opener=opener(codes), sleep=waits.append)
    assert [x[2] for x in run(404, 200)] == [404, 200] and not waits and seen[0] == "http://h/a%20b"
    assert [x[2] for x in run(404, 404, 404, 404, 200)] == [404] * 4 + [200] and len(waits) == 1
    assert [x[2] for x in run(404, 503, 404, 410)] == [404, 503, 404, 410] and len(waits) == 1
    cases = {"ok": run(404, 200), "back": run(404, 404, 410, 404, 200), "gone": run(404, 404, 410, 404, 404), "soft": run(404, 503, 404, 404), "late": run(None, 404, 404, 404)}
    rows = spark.createDataFrame([(k, x[2], x[5], "") for k, v in cases.items() for x in v], "url string, http_status int, detail string, failure_class string")
    assert {r["url"]: r["verdict"] for r in health.attempts_verdict(rows, "url").collect()} == {"ok": "reachable", "back": "reachable", "gone": "hard", "soft": "soft", "late": "soft"}
    df = spark.createDataFrame([("http://127.0.0.1:9/x",), ("http://127.0.0.1:9/x",), (None,)], "url string")
    got = web.attempts(df, ["a/1", "b/1"], timeout=2).collect()
    assert [(r["n"], r["agent"], r["http_status"]) for r in sorted(got, key=lambda r: r["n"])] == [(1, "a/1", None), (2, "b/1", None)]


def test_named_files(spark):
    rows = [(1, "https://h/a.py", b"x\r\n"), (2, "https://m/a.py?v=2", b"x\n"), (3, "https://h/sub/a.py", b"other"), (4, "https://h/b", b"y"), (5, None, b"z")]
    got = {r["i"]: r["name"] for r in playlists.named_files(spark.createDataFrame(rows, "i int, url string, content binary"), ["i"]).collect()}
    assert got[1] == got[2] == "a.py" and got[3].startswith("a-") and len(got[3]) == 15 and got[4] == "b.py" and 5 not in got


def test_data_source(spark):
    spark.dataSource.register(web.WebSource)
    rows = spark.read.format("playweave-web").option("urls", "http://127.0.0.1:9/a\nhttp://127.0.0.1:9/b\n").option("retries", "1").option("timeout", "2").load().collect()
    assert sorted(r["source"] for r in rows) == ["http://127.0.0.1:9/a", "http://127.0.0.1:9/b"] and all(r["data"] is None and r["error"].startswith("URLError") and r["attempts"] == 1 for r in rows)
    assert spark.read.format("playweave-web").load().count() == 0


def test_files(spark, tmp_path):
    good, other = b"class Spider:\n    def homeContent(self): pass\n", b"class Spider:\r\n    def homeContent(self): pass\r\n"
    for name, data in (("b.py", good), ("longer-name.py", other), ("a-0123456789.py", good), ("bad.py", b"def ("), ("note.txt", b"x")):
        (tmp_path / name).write_bytes(data)
    files = playlists.plugin_files(playlists.read_plugins(spark, str(tmp_path)))
    assert {r["name"]: r["role"] for r in files.collect()} == {"b.py": "keep", "longer-name.py": "duplicate", "a-0123456789.py": "duplicate", "bad.py": "invalid"}
    playlists.quarantine(files, f"{tmp_path}/q")
    assert spark.read.parquet(f"{tmp_path}/q").count() == 2 and (tmp_path / "longer-name.py").exists()
    texts = playlists.read_texts(spark, f"{tmp_path}/note.txt").collect()
    assert [(r["source"].rsplit("/", 1)[-1], r["text"]) for r in texts] == [("note.txt", "x")]
    df = spark.createDataFrame([('say "hi"', "中"), (None, "")], "a string, b string")
    playlists.write_csv(df, f"{tmp_path}/c")
    raw = b"".join(p.read_bytes() for p in (tmp_path / "c").glob("part-*"))
    assert raw.startswith(b"\xef\xbb\xbf") or b"\xef\xbb\xbf" in raw[:4] and b'"say ""hi""","\xe4\xb8\xad"\n' in raw
    playlists.write_json(df, f"{tmp_path}/j")
    assert playlists.read_state(spark, f"{tmp_path}/j", "a string, b string").count() == 2
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.json").write_text("{nope\n")
    assert playlists.read_state(spark, f"{tmp_path}/broken", "a string").first()["a"] is None
    with pytest.raises(Exception):  # noqa: B017
        playlists.read_state(spark, f"{tmp_path}/broken", "a string", strict=True).collect()


def test_release(spark):
    kept = common.materialize(spark.range(3).toDF("i"), "probe")
    assert kept.count() == 3 and common.release(spark) >= 1 and common.release(spark) == 0


def test_fold():
    import pandas as pd

    assert streaks.fold(pd.Series(["decisive", "ok", "decisive", "soft"]), 5, ["x"]) == (1, ["ok", "decisive", "soft"])
    assert streaks.fold(pd.Series(["decisive"]), 2, ["a", "b", "c"]) == (3, ["b", "c", "decisive"]) and streaks.fold(pd.Series(["ok"]), 9, []) == (0, ["ok"])


def test_upserts(spark, tmp_path):
    """Batches in order, one of them twice, epochs with gaps; only touched buckets get new versions, at most two stay."""
    write, path, schema = streaks.upsert_sink(f"{tmp_path}/t", "k", ["o"], buckets=4), f"{tmp_path}/t", "k string, o int, v string"
    batch = lambda *rows: spark.createDataFrame(list(rows), schema.replace(", v string", ", w string"))
    write(batch(("a", 1, "x"), ("b", 1, "x"), ("c", 5, "x")), 0)
    for _ in range(2):
        write(batch(("a", 2, "y"), ("c", 4, "old")), 3)
    write(batch(("a", 3, "z"), ("d", 1, "n")), 7)
    write(batch(), 8)
    got = {r["k"]: (r["o"], r["w"]) for r in streaks.read_table(spark, path, "k string, o int, w string").collect()}
    assert got == {"a": (3, "z"), "b": (1, "x"), "c": (5, "x"), "d": (1, "n")}
    assert all(len(v) <= 2 for v in streaks._versions(spark, path).values())
    assert streaks.read_table(spark, f"{tmp_path}/none", "k string").count() == 0


def test_windows(spark, tmp_path):
    rows = [("2031-01-01 00:01:00", "a"), ("2031-01-01 00:02:00", "a"), ("2031-01-01 00:06:00", "b"), ("2031-01-01 02:00:00", "a")]
    spark.createDataFrame(rows, "t string, k string").select(F.col("t").cast("timestamp").alias("t"), "k").write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("t timestamp, k string").parquet(f"{tmp_path}/in")
    q = streaks.windowed_counts(s, "t", "k").writeStream.outputMode("append").format("memory").queryName("windows").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(120)
    assert {(r["k"], r["n"]) for r in spark.sql("SELECT k, n FROM windows").collect()} == {("a", 2), ("b", 1)}
