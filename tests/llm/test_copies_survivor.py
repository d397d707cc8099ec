"""Problems 3 and 6 against brute force on random rows, with hot keys, nulls, ties and repeats."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from playweave.llm import copies, queries, survivor

SCHEMA = "row_id bigint, url string, channel_key string, h1 string, copies string"


def test_canonical_address(spark):
    groups = [
        ["http://H.example:80/a/b?x=1&y=2", ' "HTTP://h.example:80//a/b/?y=2;x=1&x=1&&" ', "<http:// h.example:80/a/b?x=1&y=2#frag>,"],
        ["http://h.example/a"], ["https://h.example/a"], ["http://h.example:8080/a"], ["http://h.example/b/a"], ["http://h.example/a?x=1"], ["no address"],
    ]
    rows = [(i, u) for i, g in enumerate(groups) for u in g]
    out = spark.createDataFrame(rows, "g int, u string").select("g", copies.canonical_address(F.col("u")).alias("c")).collect()
    assert len({r["c"] for r in out}) == len(groups) == len({(r["g"], r["c"]) for r in out})


@pytest.mark.parametrize("bits", [12, 0.01])
def test_copies(spark, bits):
    """Exact also with a filter far too small, and with one set holding a third of all rows."""
    rng = random.Random(3)
    keys = [rng.randrange(400) if rng.random() > 0.33 else 0 for _ in range(1500)]
    rows = [(i, f"http://h/{k}" if rng.random() < 0.5 else f" HTTP://h//{k}/ ", f"key {k}" if rng.random() < 0.5 else f"KEY-{k}", "x", "y") for i, k in enumerate(keys, 1)]
    rows += [(9001, None, "k", "", ""), (9002, "http://h/1", None, "", ""), (9003, " ", "k", "", ""), (9004, "http://h/1", "　", "", ""), (9005, "http://h/" + "z" * 100_000, "k", "", ""), (9006, "http://h/" + "z" * 100_000 + "/", "K", "", "")]
    sets: dict = {}
    for i, k in enumerate(keys, 1):
        sets.setdefault(k, []).append(i)
    expected = {(min(v), x) for v in sets.values() for x in v if x != min(v)} | {(9005, 9006)}
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    survivors, members = copies.channel_copies(df, hot=100, bits_per_row=bits)
    pairs = [tuple(r) for r in members.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected
    counted = {r["row_id"]: r["copies"] for r in survivors.collect()}
    assert counted == {min(v): len(v) for v in sets.values()} | {9005: 2}


def test_slices_keep_filters_selective(spark):
    """With a bound far below what the rows need, the passes over slices still move little more than the repeats."""
    assert copies.blocks_for(100, 12, 1 << 28) == (1, 1) and copies.blocks_for(1 << 24, 12, 1 << 20) == (256, 16)
    rows = [(i, f"http://h/{i if i % 50 else 7}", f"k{i if i % 50 else 7}") for i in range(40_000)]
    df = spark.createDataFrame(rows, "row_id bigint, url string, channel_key string")
    canon = [copies.canonical_address(F.col("url")), F.col("channel_key")]
    repeats = 800 + 1
    for most in (1 << 28, 1 << 16):
        flagged = copies.flagged_prints(df, "row_id", canon, 12, most)
        maybe = flagged.filter("maybe_repeated").count()
        assert flagged.count() == 40_000 and repeats <= maybe <= repeats + 2000
    assert copies.flagged_prints(df, "row_id", canon, 0.01, 1 << 16).filter("maybe_repeated").count() > maybe
    pairs = {tuple(r) for r in copies.channel_copies(df, most_bits=1 << 16)[1].collect()}
    assert pairs == {(0, i) for i in range(0, 40_000, 50) if i} - {(0, 7)} | {(0, 7)}


def test_no_rows(spark):
    survivors, members = copies.channel_copies(spark.createDataFrame([], SCHEMA))
    assert survivors.count() == 0 and members.count() == 0


def test_merge_loses_nothing():
    """A hash in two partitions, or twice in one, is set in the merged filter in any order of merging."""
    rng = np.random.default_rng(1)
    parts = [pd.DataFrame({"h1": rng.integers(-(1 << 62), 1 << 62, 300), "h2": rng.integers(-(1 << 62), 1 << 62, 300)}) for _ in range(4)]
    parts[1].iloc[:20] = parts[3].iloc[:20].values
    parts[2].iloc[5] = parts[2].iloc[6].values
    made = pd.concat([pd.concat(copies._partial(4)([p])) for p in parts])
    for frame in (made, made.iloc[::-1]):
        merged = pd.concat(copies._merge([frame]))
        bits = {b: np.unpackbits(np.array(w, np.int64).view(np.uint8), bitorder="little") for b, w in zip(merged["block"], merged["words"], strict=True)}
        for h1, h2 in [*parts[3].iloc[:20].values, parts[2].iloc[5].values]:
            block, p, q = copies._probes(np.array([h1]), np.array([h2]), 4)
            assert bits[block[0]][p[0]] and bits[block[0]][q[0]]


def test_survivor(spark):
    rng = random.Random(5)
    day = lambda d: None if d is None else dt.datetime(2031, 1, 1) + dt.timedelta(days=d)
    fill = lambda s: rng.choice([None, "", " ", "N/A", "无", s])
    rows = [(i, rng.choice(["s1", "s2", "s3", "gone", None]), day(rng.choice([None, 1, 2, 3])), fill("l"), fill("t"), fill("4K"), rng.choice([None, [], ["a"], ["b", "a"]]), rng.choice(["Key 1", "key-1", "k2", "k3", "K3!", None, "k4", "hot"]), "clash") for i in range(1, 400)]
    rows += [(1000 + i, "s1", day(1), "l", "t", "q", ["a"], "twin", "clash") for i in range(2)] + [(2000, "s1", day(1), "l", "t", "q", ["a"], "alone", "clash")]
    rows += [(3001, "s2", day(1), "old", "t", None, None, "pair", "c"), (3002, "s2", day(90), "new", None, "q", ["z"], "pair", "c"), (3003, "s2", day(2), "old", "t", "q", ["z"], "PAIR", "c")]
    schema = "row_id bigint, source string, seen_at timestamp, logo string, tvg_id string, quality string, lines array<string>, channel_key string, trust string"
    sources = spark.createDataFrame([("s1", 1), ("s2", 3), ("s3", 5)], "source string, trust int")
    df = spark.createDataFrame(rows, schema)
    trust = {"s1": 1, "s2": 3, "s3": 5}
    groups: dict = {}
    for i, s, seen, *fields, key, _ in rows:
        if key is not None:
            full = sum(bool(f) and (not isinstance(f, str) or f.strip().lower() not in survivor.STAND_INS) for f in fields)
            groups.setdefault("".join(c for c in key.lower() if c.isalnum()), []).append((full, -1e9 if seen is None else seen.timestamp(), trust.get(s, -1), i))
    expected = set()
    for members in groups.values():
        for m in members:
            rest = [x for x in members if x is not m]
            if rest and all(x[k] <= m[k] for x in rest for k in range(3)) and all(any(x[k] < m[k] for k in range(3)) for x in rest):
                expected.add(m[3])
    out = survivor.elect(df, sources).collect()
    assert {r["best_row"] for r in out if r["is_clear"]} == expected
    by = {r["key"]: r for r in out}
    assert by["pair"]["logo"] == "new" and by["pair"]["tvg_id"] == "t" and by["pair"]["lines"] == ["z"] and by["pair"]["records"] == 3
    assert not by["twin"]["is_clear"] and not by["alone"]["is_clear"]
    assert survivor.elect(df.limit(0), sources).count() == 0
    assert survivor.elect(df, sources.limit(0)).count() == len(groups)


def test_clear_best_goes_through_the_votes(spark, data):
    """The plan of p6_found unpivots every content field, sums votes of trust times decay on (group, field, value) and elects by max_by."""
    plan = queries.QUERIES["p6_found"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "POWER(2.0" in plan and "sum(vote#" in plan and "max_by(" in plan
    assert all(f"struct(field, {f}, " in plan for f in [*survivor.FIELDS, *survivor.MEASURES, survivor.RECORD])


def test_elected_record_has_most_votes(spark):
    """A record has its vote once for each field that it fills; where votes are 0 (old, untrusted, no date), a clear best is still elected."""
    rng = random.Random(8)
    now = dt.datetime(2031, 1, 1)
    rows = [(i, rng.choice(["s0", "s1", "s3", "s5", "minus", "gone", None]), rng.choice([None, now, now - dt.timedelta(days=rng.randrange(90)), now - dt.timedelta(days=4000 + rng.randrange(3))]), *(rng.choice([None, "x"]) for _ in range(3)), rng.choice([None, ["a"]]), f"k{rng.randrange(150)}") for i in range(1, 500)]
    rows += [(1001, "s3", now - dt.timedelta(days=1), "l", "t", "q", ["a"], "full"), (1002, "s3", now, None, "t", None, None, "full")]
    rows += [(1003 + i, "s1", now - dt.timedelta(days=4000), "l", "t", "q" if i else None, ["a"], "old") for i in range(2)]
    rows += [(1005 + i, "minus", now - dt.timedelta(days=40 - 40 * i), "l", "t", "q", ["a"], "below") for i in range(2)]
    rows += [(1007 + i, "s5" if i == 4 else "s3", now, "l", "t", "q", ["a"], "many") for i in range(5)]
    trust = {"s0": 0, "s1": 1, "s3": 3, "s5": 5, "minus": -2}
    groups: dict = {}
    for i, s, seen, *fields, key in rows:
        t = trust.get(s, -1)
        us = -(10**18) if seen is None else (seen - now) // dt.timedelta(microseconds=1)
        full = sum(f is not None for f in fields)
        votes = full * int(max(t, 0) * 2.0 ** (us / (30 * 86400e6)) * survivor.UNIT)
        groups.setdefault(key, []).append((votes, full, us, t, -i))
    schema = "row_id bigint, source string, seen_at timestamp, logo string, tvg_id string, quality string, lines array<string>, channel_key string"
    sources = spark.createDataFrame(list(trust.items()), "source string, trust int")
    out = {r["key"]: r for r in survivor.elect(spark.createDataFrame(rows, schema), sources, forms=False).collect()}
    assert {k: r["best_row"] for k, r in out.items()} == {k: -max(g)[-1] for k, g in groups.items()}
    clear = {k for k, g in groups.items() for m in g if len(g) > 1 and all(all(a <= b for a, b in zip(x[1:4], m[1:4], strict=True)) and x[1:4] != m[1:4] for x in g if x is not m)}
    assert {k for k, r in out.items() if r["is_clear"]} == clear and {"old", "below", "many"} <= clear and out["full"]["best_row"] == 1001
    valued = {r["key"]: r for r in survivor.elect(spark.createDataFrame(rows, schema), sources).collect()}
    assert all(valued[k][c] == r[c] for k, r in out.items() for c in out[k].__fields__)
