"""Reference entries longer than 64 letters."""

import os

import pytest

from playweave.llm import garble, labels


def test_long_entry():
    entry = "international news and documentary film channel of the northern coast and islands"
    d = labels.Dictionary([(1, entry, None, None), (2, "整点新闻", None, None)], {})
    assert d.look_up(entry.upper()) == 1 and d.look_up(entry.replace("film", "flim")) == 1
    assert d.look_up("x" * 100_000) == 0


def test_join_equals_dictionary(spark):
    """A reference list too large for a broadcast gives the same entries by a join, for every label of a table; hot labels too."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    channels, reference = spark.read.parquet(f"{folder}/channels.parquet"), spark.read.parquet(f"{folder}/canonical_groups.parquet")
    assert labels.within_bounds(reference) and not labels.within_bounds(reference, most_entries=10) and not labels.within_bounds(reference, most_letters=100)
    model = garble.fit(channels, rounds=0)
    a = labels.map_labels(channels, reference, labels.fit(channels, reference), model)
    b = labels.by_join(channels, reference, model, hot=20)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {r["canon_id"] for r in labels.by_join(channels, reference.limit(0), model).collect()} == {0}
