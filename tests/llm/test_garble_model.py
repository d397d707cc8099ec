"""Problem 4 beyond small rows: the fitted model in all queries that use it."""

import random

import pytest

from playweave.llm import garble, queries
from tests.llm.test_labels_names import corpus, reference


def test_one_model_for_all(spark, tmp_path):
    """A short text that only its source's learned swap tells to be garbled is garbled in p1 and p2 as in p4."""
    bad = "Озёрник Спорт".encode("cp1251").decode("koi8_r")
    rows = [{"row_id": i, "result_id": 1, "source": "k", "name": bad} for i in range(400)]
    rows += [{"row_id": 500, "result_id": 2, "source": "k", "name": "ОНП", "group_raw": "ОНП"}, {"row_id": 501, "result_id": 2, "source": "k", "name": "ОНП​"}]
    corpus(spark, rows).write.parquet(f"{tmp_path}/channels.parquet")
    reference(spark).write.parquet(f"{tmp_path}/canonical_groups.parquet")
    found = {tuple(r) for r in queries.p4_found(spark, str(tmp_path)).collect()}
    assert {(500, "name"), (500, "group_raw")} <= found
    assert 500 not in {r["row_id"] for r in queries.p1_found(spark, str(tmp_path)).collect()}
    assert queries.p2_found(spark, str(tmp_path)).filter("row_a >= 500").count() == 0


def test_full_language_table(spark):
    """A text is tested against the swaps even if the table holds a count of every bigram; words in order cost a spoiled text nothing."""
    good, bad = "梧泽购物 澜浦新闻 整点新闻 ", "澜浦新闻 梧泽购物".encode("gb18030").decode("latin-1")
    c = corpus(spark, [{"row_id": 1, "source": "s", "name": bad}, {"row_id": 4, "source": "s", "name": "四 季 风 光"}, {"row_id": 2, "source": "s", "name": good}, {"row_id": 3, "source": "s", "name": good * 9 + bad}])
    fitted = garble.Language.fit(garble.language_texts(c))
    fill = lambda counts, cells: {i: 1 + 200 * counts.get(i, 0) for i in range(cells)}
    model = garble.GarbleModel(garble.Language(fill(fitted.unigrams, garble.UNIGRAM_CELLS), fill(fitted.bigrams, garble.BIGRAM_CELLS)))
    decided = [model.decide(t, 0) for t in (bad, good, good * 9 + bad, "四 季 风 光")]
    assert [(x[0], x[2]) for x in decided] == [(True, "澜浦新闻 梧泽购物"), (False, None), (True, good * 9 + "澜浦新闻 梧泽购物"), (False, None)]


def names(n=300, seed=3):
    rng = random.Random(seed)
    first, second = ["Озёрник", "Вельдар", "Дальнолуг", "Рябинск", "Зорянка", "Клёново", "Ветрово", "Мирлесье"], ["Спорт", "Новости", "Кухня", "Музыка", "Дорога", "Мульт", "Ночь", "Шахматы", "Лавка", "Путь"]
    return [f"{rng.choice(first)} {rng.choice(second)}-{rng.randint(1, 999)}" for _ in range(n)]


@pytest.mark.parametrize(("written", "read"), [("cp1251", "cp1250"), ("iso8859_5", "cp1251"), ("cp1251", "cp1253")])
def test_unlisted_pages_are_learned(spark, written, read):
    """Pages outside the list: expectation-maximization learns the source's letters, finds its texts and gives back what no page has lost."""
    pairs = []
    for t in names():
        try:
            pairs.append((t, t.encode(written).decode(read)))
        except UnicodeError:
            continue
    rows = [{"row_id": 5000 + i, "source": "odd", "name": g} for i, (_, g) in enumerate(pairs)] + [{"row_id": 9000 + i, "source": "even", "name": t, "channel_key": t.lower()} for i, t in enumerate(names(400, 8))]
    c = corpus(spark, rows)
    got = {r["row_id"]: r["restored"] for r in garble.detect(c, garble.fit(c)).filter("row_id >= 5000").collect()}
    assert len(got) >= 0.97 * len(pairs) and max(got) < 9000
    assert sum(got.get(5000 + i) == t for i, (t, _) in enumerate(pairs)) >= 0.9 * len(pairs)
    assert sum(got[i] not in (None, pairs[i - 5000][0]) for i in got) <= 0.02 * len(pairs)
    off = {r["row_id"]: r["restored"] for r in garble.detect(c, garble.fit(c, rounds=0)).filter("row_id >= 5000").collect()}
    assert sum(off.get(5000 + i) == t for i, (t, _) in enumerate(pairs)) == 0 and off != got


def test_cipher_of_no_page(spark):
    """A substitution that no pair of pages makes is learned and found; its texts come back as null."""
    letters = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"
    shuffled = list("֏ՠաբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտ")
    random.Random(1).shuffle(shuffled)
    table = str.maketrans(dict(zip(letters, shuffled, strict=True)))
    texts = [t.lower().translate(table) for t in names(600)]
    c = corpus(spark, [{"row_id": 5000 + i, "source": "odd", "name": g} for i, g in enumerate(texts)] + [{"row_id": 9000 + i, "source": "even", "name": t, "channel_key": t.lower()} for i, t in enumerate(names(400, 8))])
    got = {r["row_id"]: r["restored"] for r in garble.detect(c, garble.fit(c)).filter("row_id >= 5000").collect()}
    assert len(got) >= 0.95 * len(texts) and max(got) < 9000 and set(got.values()) == {None}
