"""Problems 1, 2 and 4 on small rows."""

import random
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from playweave.llm import garble, labels, lookalike

CHANNELS = "row_id bigint, result_id bigint, source string, name string, group_raw string, source_section string, group_name string, channel_key string, quality string, plain string, text string"
CANON = "canon_id int, canon_name string, name_en string, short_code string"


def channels(spark, rows):
    full = [tuple(r.get(c) for c in ("row_id", "result_id", "source", "name", "group_raw", "source_section", "group_name", "channel_key", "quality")) + ("clash", "clash") for r in rows]
    return spark.createDataFrame(full, CHANNELS)


def corpus(spark, extra):
    words = ["梧泽购物", "澜浦新闻", "整点新闻", "Озёрник Спорт", "Zürnau Rétro", "Snowfield Home", "별하 뉴스", "ツキバシ ドラマ"]
    rows = [{"row_id": 1000 + i, "result_id": 9, "source": "s", "name": w, "group_raw": "整点新闻", "group_name": "整点新闻", "channel_key": w.lower(), "quality": "高清"} for i, w in enumerate(words * 20)]
    return channels(spark, rows + extra)


def reference(spark):
    return spark.createDataFrame([(1, "整点新闻", "Hourly News", "zdxw"), (2, "东岸联播", "East Coast Network", "dalb"), (3, "西岸联播", "West Coast Network", "xalb"), (4, "校园频道", "Campus Channel", "xypd")], CANON)


def test_labels(spark):
    given_ = {1: ("整點新聞", 1), 2: ("#整点-新闻频道(12)", 1), 3: ("the hourly_news HD", 1), 4: ("ZDXW9", 1), 5: ("Hourly Nesw", 1), 6: ("东岸播联", 2), 7: ("unsorted 12", 0), 8: ("🎬🎬", 0), 9: ("校園頻道台", 4), 10: ("Ｈｏｕｒｌｙ　Ｎｅｗｓ", 1), 11: ("x" * 100_000, 0)}
    skipped = {12: None, 13: "", 14: " 　", 15: "整点新闻", 16: "整点新闻".encode().decode("latin-1")}
    rows = [{"row_id": k, "source": "s", "group_raw": v} for k, (v, _) in given_.items()] + [{"row_id": k, "source": None, "group_raw": v} for k, v in skipped.items()]
    c = corpus(spark, rows + rows[:1])
    out = labels.map_labels(c, reference(spark), labels.fit(c, reference(spark)), garble.fit(c, rounds=0)).collect()
    assert {r["row_id"]: r["canon_id"] for r in out} == {k: n for k, (_, n) in given_.items()}
    empty = labels.map_labels(c.limit(0), reference(spark), labels.fit(c.limit(0), reference(spark)), garble.fit(c.limit(0)))
    assert empty.count() == 0
    nothing = reference(spark).limit(0)
    assert {r["canon_id"] for r in labels.map_labels(c, nothing, labels.fit(c, nothing), garble.fit(c, rounds=0)).collect()} == {0}


@given(st.text("abcd", max_size=7), st.text("abcd", max_size=7))
@settings(max_examples=200, deadline=None)
def test_symmetric_deletion_finds_all(a, b):
    """Whatever is within two edits shares a deletion."""
    if labels.distance(a, b, 9) <= 2.0:
        assert labels.deletions(a, 2) & labels.deletions(b, 2)


def test_distance_ties():
    d = labels.Dictionary([(1, "東一", None, None), (2, "abcd", None, None), (3, "abce", None, None)], {"abcd": 1, "abce": 5})
    assert d.look_up("abcx") == 3
    assert labels.distance("abcd", "abdc", 3) == 0.9


def test_plain():
    same = [("Ａｂ１", "Ab1"), ("𝐀b𝟏", "Ab1"), ("é", "é"), ("a b​", "a b"), ("a　b", "a b"), ("x‐1", "x-1"), ("🎬​x", "🎬x"), ("⾼清", "高清")]
    assert all(lookalike.plain(a) == lookalike.plain(b) for a, b in same)
    differ = [("▶️ a", "▶ a"), ("👨‍👩 a", "👨👩 a"), ("a-b", "a b"), ("a b", "ab"), ("A", "a"), ("電", "电")]
    assert all(lookalike.plain(a) != lookalike.plain(b) for a, b in differ)


def test_alike_pairs(spark):
    names = {1: "Snowfield Home 4K", 2: "Snоwfield Hоme 4К", 3: "Ｓｎｏｗｆｉｅｌｄ Home 4K", 4: "Snowfield-Home 4K", 5: None, 6: " ", 7: "Snowfield Home 4K", 8: "Озёрник Спорт", 9: "Oзёpник Спорт", 10: "Qжq", 11: "梧泽​购物", 12: "梧泽购物", 13: "梧泽购物".encode().decode("latin-1"), 14: "x" * 50_000, 15: "x" * 50_000 + "​"}
    c = corpus(spark, [{"row_id": k, "result_id": 1, "source": "s", "name": n} for k, n in names.items()] + [{"row_id": 99, "result_id": 2, "source": "s", "name": "Snоwfield Home 4K"}])
    out = lookalike.alike_pairs(c.select("row_id", "result_id", "name"), "result_id").filter("row_a < 99 AND row_b < 99").collect()
    assert sorted(map(tuple, out)) == [(1, 2), (1, 3), (2, 3), (2, 7), (3, 7), (8, 9), (11, 12), (14, 15)]
    assert lookalike.alike_pairs(c.limit(0).select("row_id", "result_id", "name"), "result_id").count() == 0


def test_many_spellings_of_one_name(spark, tmp_path):
    """A name in 300 spellings within one result: every pair, in blocks; classes name each row once; Armenian and Cherokee letters too."""
    spelling = lambda i: "Snowfield" + "\u200b" * (i % 3) + " " * (i % 5 + 1) + "Home" + "\u2060" * (i // 15)
    rows = [(i, 1, spelling(i)) for i in range(300)] + [(300 + i, 2, spelling(i)) for i in range(2)] + [(900, 3, "Հօme"), (901, 3, "home"), (902, 3, "Ꮋome"), (903, 3, "Home"), (904, 3, "Home")]
    df = spark.createDataFrame(rows, "row_id bigint, result_id bigint, name string")
    got = [tuple(r) for r in lookalike.alike_pairs(df, "result_id", block=40, hot=100).collect()]
    ids = {}
    for i, r, n in rows:
        ids.setdefault((r, lookalike.plain(n) if i < 900 else {900: "h?", 901: "h?"}.get(i, "Home")), []).append((i, n))
    expected = {(a, b) for g in ids.values() for a, x in g for b, y in g if a < b and x != y} - {(900, 901)}
    assert len(got) == len(set(got)) and set(got) - {(900, 901)} == expected
    classes = lookalike.alike_rows(df, "result_id").collect()
    assert len(classes) == len({r["row_id"] for r in classes}) and {r["class_row"] for r in classes if r["row_id"] < 300} == {0}


def test_garbled(spark):
    swaps = [("utf-8", "latin-1"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("gb18030", "latin-1")]
    bad = {i: "澜浦新闻 梧泽购物".encode(w).decode(r) for i, (w, r) in enumerate(swaps)}
    bad |= {10: "Озёрник Спорт".encode("cp1251").decode("koi8_r"), 11: "澜浦��", 12: "梧泽购物".encode().decode("latin-1").encode().decode("latin-1"), 13: ("澜浦新闻 " * 2000).encode().decode("latin-1")}
    good = {20: "澜浦 新闻 12", 21: None, 22: "", 23: " ", 24: "plain ascii", 25: "Zürnau Rétro", 26: "Snоwfield Ηome", 27: "▶️ 澜浦新闻", 28: "Озёрник Спорт", 29: "ツキバシ ドラマ"}
    c = corpus(spark, [{"row_id": k, "source": "s" if k % 2 else None, "name": n} for k, n in (bad | good).items()])
    out = {r["row_id"]: r["restored"] for r in garble.detect(c, garble.fit(c)).collect()}
    assert set(out) == set(bad)
    assert all(out[i] == "澜浦新闻 梧泽购物" for i in range(4)) and out[10] == "Озёрник Спорт" and out[11] is None and out[12] == "梧泽购物"
    assert out[13] == "澜浦新闻 " * 2000
    learned = {(r["unit"], r["letter"]) for r in garble.mapping(c, garble.fit(c)).collect()}
    assert ("新".encode().decode("latin-1"), "新") in learned
    assert garble.detect(c.limit(0), garble.fit(c.limit(0))).count() == 0


def test_ascii_is_never_garbled():
    model = garble.GarbleModel(garble.Language({}, {}))
    rng = random.Random(1)
    assert not any(model.decide("".join(rng.choices(string.printable, k=30)), 0)[0] for _ in range(200))
