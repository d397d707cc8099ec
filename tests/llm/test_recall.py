"""Recall of problems 1, 2, 4 and 5: against brute force over whole small tables, and on planted cases."""

import os
import random
import string

import pytest
from pyspark.sql import functions as F

from playweave.llm import credentials, garble, labels, lookalike, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def channels(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{FOLDER}/channels.parquet")


def test_labels_equal_brute_force(spark, channels):
    """The symmetric-delete dictionary finds for every label of the table what comparing it with every form of the reference list finds."""
    d = labels.fit(channels, spark.read.parquet(f"{FOLDER}/canonical_groups.parquet"))
    texts = [r[0] for r in channels.select(F.explode(F.array(*labels.FIELDS)).alias("x")).filter("x IS NOT NULL").distinct().collect()]

    def brute(label):
        best = (99.0,)
        for step, w in enumerate(labels.forms(label)):
            for letters, i, allowed in d.forms:
                own = 0 if len(w) < 3 else 1 if len(w) < 7 else 2
                if w == letters or min(own, allowed) and abs(len(w) - len(letters)) <= 2 and labels.distance(w, letters, allowed) <= allowed * 1.1 + 1e-9:
                    best = min(best, (labels.distance(w, letters, allowed) if w != letters else 0.0, -d.frequency[i], step, i))
        return best[-1] if best[0] < 99 else 0

    chosen = random.Random(1).sample(sorted(texts), min(1500, len(texts)))
    wrong = [(x, d.look_up(x), brute(x)) for x in chosen if d.look_up(x) != brute(x)]
    assert len(wrong) <= 0.002 * len(chosen), wrong[:5]


def test_pairs_equal_brute_force(spark, channels):
    """All pairs of look-alike names of one result, by comparing every name with every other one."""
    names = channels.select("row_id", "result_id", "name").filter("row_id % 2 = 0")
    rows = [tuple(r) for r in names.filter("name IS NOT NULL").collect()]
    plain = {n: lookalike.plain(n) for _, _, n in rows}
    mixed = lambda w: len({s for ch in w if (s := lookalike.script(ch)) in lookalike.SHAPES}) > 1
    vocabulary = {w for p in plain.values() for w in __import__("regex").findall(r"\p{L}+", p) if not mixed(w)}

    def same(name):
        fixes: dict = {}
        for w, f in lookalike.candidates(plain[name]):
            if f in vocabulary:
                fixes.setdefault(w, f)
        return lookalike._WORD.sub(lambda m: fixes.get(m.group(), m.group()), plain[name])

    groups: dict = {}
    for i, r, n in rows:
        if plain[n]:
            groups.setdefault((r, same(n)), []).append((i, n))
    expected = {(min(a, b), max(a, b)) for g in groups.values() for a, x in g for b, y in g if a < b and x != y}
    got = {tuple(r) for r in lookalike.alike_pairs(names, "result_id").collect()}
    assert expected and len(got & expected) >= 0.99 * len(expected) and len(got - expected) <= 0.01 * len(got)


def test_planted_garbling(spark, channels):
    """Names in order, spoiled by listed swaps: at least 98 in a hundred are found, nine in ten restored exactly, and no name beside them is taken for garbled."""
    rng = random.Random(5)
    bad = {r["row_id"] for r in garble.detect(channels, garble.fit(channels)).select("row_id").collect()}
    good = [r for r in channels.select("row_id", "source", "name").filter(F.col("name").rlike("[^\\x00-\\x7F]")).collect() if r["row_id"] not in bad and lookalike.plain(r["name"]) == r["name"].strip() and sum(map(str.isalpha, r["name"])) >= 5]
    swaps = [("utf-8", "latin-1"), ("utf-8", "cp1251"), ("utf-8", "mac_roman"), ("gb18030", "latin-1"), ("gb18030", "big5"), ("cp1251", "koi8_r"), ("utf-8", "cp437"), ("cp949", "gb18030")]
    planted = {}
    for r in rng.sample(good, 700):
        w, read = rng.choice(swaps)
        try:
            text = r["name"].encode(w).decode(read)
        except UnicodeError:
            continue
        if text != r["name"] and not text.isascii():
            planted[r["row_id"]] = (r["name"], text)
    table = spark.createDataFrame([(i, t) for i, (_, t) in planted.items()], "row_id bigint, spoiled string")
    mixed = channels.join(F.broadcast(table), "row_id", "left").withColumn("name", F.coalesce("spoiled", "name")).select(channels.columns)
    got = {r["row_id"]: r["restored"] for r in garble.detect(mixed, garble.fit(mixed), ("name",)).collect()}
    assert len(planted) > 300 and sum(i in got for i in planted) >= 0.98 * len(planted)
    assert sum(got.get(i) == t for i, (t, _) in planted.items()) >= 0.9 * len(planted)
    assert len(set(got) - set(planted) - bad) <= 3


def test_planted_credentials():
    """Random keys and pass words in many places are found; look-alikes in the same places are not."""
    rng = random.Random(9)
    word = lambda: rng.choice(["Falcon", "river", "Stone", "Meadow", "lantern", "Copper"])
    secret = lambda: rng.choice([
        lambda: "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(12, 40))), lambda: f"{rng.getrandbits(128):032x}", lambda: word().title() + rng.choice("-_!#@") + word().title() + str(rng.randint(100, 9999)),
    ])()
    places = ["token = '{}'", "self.api_key = \"{}\"", "headers['X-Api-Key'] = '{}'", "p_w_d='{}'", "URL = 'https://h.example/a?page=1&access_token={}'", "DSN = 'mysql://root:{}@db.example/x'", "# password: {}", "secret = os.environ.get('X', '{}')"]
    decoys = ["token = 'YOUR_TOKEN'", "api_key = ''", "secret = os.environ['SECRET']", "etag = '{}'", "md5 = '{}'", "key = 'vod_name'", "password = '{{{{SECRET_X}}}}'", "token = tokens[i]", "image = 'data:image/png;base64,{}'", "session = requests"]
    lines, expected = [], set()
    for n in range(1, 1201):
        if rng.random() < 0.5:
            lines.append(rng.choice(places).format(secret()))
            expected.add(n)
        else:
            lines.append(rng.choice(decoys).format(f"{rng.getrandbits(128):032x}"))
    got = set(credentials.scan_file("\n".join(lines).encode()))
    assert len(got & expected) >= 0.99 * len(expected) and len(got - expected) <= 0.005 * len(expected), ([lines[i - 1] for i in sorted(expected - got)][:5], [lines[i - 1] for i in sorted(got - expected)][:5])


def test_found_queries_have_no_repeats(spark, data):
    for name in ("p1_found", "p2_found", "p3_found", "p4_found", "p5_found", "p6_found", "p8_found", "p9_found"):
        rows = queries.QUERIES[name](spark, data)
        assert rows.count() == rows.distinct().count(), name
