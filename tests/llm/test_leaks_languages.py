"""Problems 8 and 9."""

import os
import random

import pytest

from playweave.llm import langid, leakage

WORDS = {"en": "the station will move its programme to a later hour because viewers complained about the sound", "es": "la emisora pasa el programa a una hora posterior porque los espectadores se quejaron del sonido", "zh": "这个频道的节目改在晚上播出因为观众反映声音比画面慢了很多请先检查线路", "ru": "канал переносит программу на более поздний час потому что зрители жалуются на звук"}


def brute(texts, items):
    out = set()
    for d, t in texts:
        own = leakage.letters(t or "")
        for i, x in items:
            it = leakage.letters(x or "")
            half = (len(it) + 1) // 2
            if it and any(it[s : s + half] in own for s in range(len(it) - half + 1)):
                out.add((d, i))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    say = lambda n: "".join(rng.choices("abcde ", k=n))
    items = [(i, say(rng.randint(30, 200))) for i in range(40)] + [(100, None), (101, ""), (102, "!?"), (103, items_tie := say(90)), (104, items_tie)]
    texts = []
    for d in range(300):
        t = say(rng.randint(0, 800))
        if d % 2:
            x = items[rng.randrange(40)][1]
            n = max(1, int(len(x) * rng.choice([0.3, 0.45, 0.5, 0.55, 0.8, 1])))
            s = rng.randrange(len(x) - n + 1)
            t += rng.choice([x[s : s + n], x[s : s + n].upper().replace(" ", ".\n"), "".join(chr(ord(c) + 0xFEE0) if c != " " else "　" for c in x[s : s + n])]) + say(100)
        texts.append((d, t))
    texts += [(900, None), (901, ""), (902, " "), (903, say(20_000) + items_tie + say(20_000)), texts[1]]
    docs = spark.createDataFrame([(d, t, "clash") for d, t in texts], "doc_id bigint, text string, item_id string")
    got = [tuple(r) for r in leakage.find_leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(texts, items)
    table = spark.createDataFrame([*items, (200, "OK"), (201, "abc d")], "item_id bigint, text string")
    in_passes = {tuple(r) for r in leakage.find_leaks(docs, table, most_letters=500).collect()}
    assert in_passes == brute(texts, [*items, (200, "OK"), (201, "abc d")])
    assert in_passes == {tuple(r) for r in leakage.find_leaks(docs, table, stride=1).collect()}
    sizes = {(x.gram, x.stride) for x in leakage.indexes([tuple(r) for r in table.collect()])}
    assert (leakage.GRAM, leakage.STRIDE) in sizes and len(sizes) == 3
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert leakage.find_leaks(docs, none).count() == 0 and leakage.find_leaks(docs.limit(0), none).count() == 0


def test_strides_agree_on_the_corpus(spark, data):
    docs, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/eval_items.parquet")
    assert {tuple(r) for r in leakage.find_leaks(docs, items).collect()} == {tuple(r) for r in leakage.find_leaks(docs, items, stride=1).collect()}


def test_words_only():
    assert langid.words_only("404 bb7931") == langid.words_only("<|endoftext|> https://a.example/x") == langid.words_only("==== 🔥 1.2.3.4:80") == ""
    assert langid.words_only("see cdn1.a.example now") == " see now "
    assert langid.words_only("The sound of Coração Azul is late") == " the sound of is late "


def languages(spark):
    return spark.createDataFrame([(k, [k.upper()]) for k in WORDS] + [("und", None)], "lang string, other_spellings array<string>")


def documents(spark):
    rng = random.Random(6)

    def line(k):
        own = list(WORDS[k]) if k == "zh" else WORDS[k].split()
        return ("" if k == "zh" else " ").join(own[i] for i in sorted(rng.sample(range(len(own)), len(own) * 2 // 3)))

    rows = [(i, "\n".join(line(k) for _ in range(3)), rng.choice([k, k.upper()]), k) for i, k in enumerate(list(WORDS) * 30)]
    rows += [(1000, line("en") + "\n\n" + line("es") + "\r\n" + line("en"), "en", ""), (1001, line("ru"), "??", ""), (1002, line("zh"), "es", ""), (1003, "404 bb7931\n===", "en", ""), (1004, "404 bb7931", "und", ""), (1005, None, None, ""), (1006, " \n ", "en", ""), (1007, (line("es") + " ") * 3000, None, "")]
    return spark.createDataFrame(rows + rows[-1:], "doc_id bigint, text string, lang string, label string")


def test_languages(spark):
    docs, langs = documents(spark), languages(spark)
    model = langid.fit(docs, langs)
    got = {(r["doc_id"], r["line_no"]): r["lang"] for r in langid.found(docs, langs, model).collect()}
    assert got == {(1000, 1): "en", (1000, 3): "es", (1000, 4): "en", (1001, 0): "ru", (1002, 0): "zh", (1003, 0): "und", (1007, 0): "es"}
    assert all(0 <= r["confidence"] <= 1 for r in langid.identify(docs, langs, model).filter("lang IS NOT NULL").collect())
    empty = langid.fit(docs.limit(0), langs)
    assert langid.found(docs.limit(0), langs, empty).count() == 0
    assert langid.fit(docs, langs.limit(0)).names == []


def test_held_out(spark, data):
    """On the real corpus, documents whose label names a language: the classifier agrees for nine in ten of those it was not trained on."""
    docs, langs = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/languages.parquet")
    train, test = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    out = langid.identify(test, langs, langid.fit(train, langs)).filter("label IS NOT NULL AND lang IS NOT NULL AND NOT mixed").collect()
    assert sum(r["label"] == r["lang"] for r in out) >= 0.9 * len(out)


def test_languages_never_learned_are_rejected(spark):
    """On the larger corpus, text of languages without a label has no language; text of those with one has it."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    docs, langs = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/languages.parquet")
    model = langid.fit(docs, langs)
    foreign = ["Tämä on suomenkielinen lause, jossa puhutaan televisiosta ja radiosta", "Bu kanalın yayını akşam saatlerinde daha iyi çalışıyor", "To jest polskie zdanie o telewizji i radiu dla wszystkich", "asdf qwer zxcv uiop hjkl", "Kênh này chuyển chương trình sang giờ muộn hơn"]
    own = ["The channel moves its programme to a later hour", "Der Sender verlegt das Programm auf eine spätere Stunde", "La emisora pasa el programa a una hora posterior porque los espectadores se quejaron"]
    assert [x for x, _ in model.classify(foreign)] == [None] * 5
    assert [x for x, _ in model.classify(own)] == ["en", "de", "es"]


def test_queries_run(spark, data):
    from playweave.llm import queries

    for name, f in queries.QUERIES.items():
        assert f(spark, data).count() > 0 or name in ("p2_found", "p6_found"), name
