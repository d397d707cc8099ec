"""Freely typed labels mapped to a reference list (problem 1).

The reference list is a table of fixed size (its bound is checked). Each of its forms (name, English name, code) is put
into a symmetric-delete dictionary: all strings reached by deleting up to k characters. A label is cleaned of
decoration, its own deletions are looked up, and the entries that share a deletion are ranked by weighted
Damerau-Levenshtein distance, then by how often the entry's exact name occurs in the corpus, then by number. Codes must
fit exactly, names of fewer than eight letters may differ by one edit, longer ones by two. The dictionary is broadcast where its
size is within bounds. A larger reference list becomes a table of deletions, which meets the deletions of the distinct labels in a join (`by_join`); both
ways give the same entries.

Nulls, blanks and garbled labels (problem 4) take no part, nor do labels that are an entry's name as they stand. A label
that means no entry gets 0. Labels are taken whole; equal labels get equal entries. An empty reference list gives 0.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playweave.common import is_blank, materialize, small_rows
from playweave.llm.garble import GarbleModel, source_cell, without_garbled
from playweave.llm.lookalike import visible
from playweave.operators.skew import attach_group_facts

FIELDS = ["group_raw", "source_section", "group_name"]
#: Bounds of the dictionary, which is broadcast: entries, and characters of all deletions of their forms (a list of 20,000 names of 40 letters has some 600 million).
MOST_ENTRIES, MOST_LETTERS = 20_000, 1_000_000_000
#: Traditional characters and their simplified forms, for the characters of the group names.
TRADITIONAL = "點聞際觀財經賽電競對極運動線懸劇場裝連鄉兒樂園畫親課錄歷檔紀戲語學習賞車評測購櫥氣報頻試導鑒釣時寵節慶東聯訊華韓選歐專寬帶輪廳聽風監樣門診農輔問軍綜藝謠臺廣書國誌圖類內鑑現區間"
SIMPLIFIED = "点闻际观财经赛电竞对极运动线悬剧场装连乡儿乐园画亲课录历档纪戏语学习赏车评测购橱气报频试导鉴钓时宠节庆东联讯华韩选欧专宽带轮厅听风监样门诊农辅问军综艺谣台广书国志图类内鉴现区间"
FOLD = {ord(t): s for t, s in zip(TRADITIONAL, SIMPLIFIED, strict=True)}
#: What maintainers add around a label.
PREFIXES = ["the"]
SUFFIXES = ["专区", "频道", "台", "源", "高清", "超清", "标清", "hd", "fhd", "uhd", "sd", "4k", "genre", "channel", "tv"]


def forms(label: str) -> list[str]:
    """The letters of a label, first as typed, then with decoration taken off step by step."""
    text = unicodedata.normalize("NFKC", visible(label)).casefold().translate(FOLD)
    text = re.sub(r"[,，;；]?\s*#\s*genre\s*#", " ", text)
    letters = "".join(ch for ch in text if ch.isalpha() or ch.isdigit())
    bare = "".join(ch for ch in re.sub(r"[\(（\[【]\s*\d+\s*[\)）\]】]", " ", text) if ch.isalpha())
    out: list[str] = []
    todo = [letters, letters.strip("0123456789"), bare]
    while todo:
        w = todo.pop(0)
        if not w or w in out:
            continue
        out.append(w)
        todo += [w[: -len(x)].strip("0123456789") for x in SUFFIXES if w.endswith(x)] + [w[len(x) :] for x in PREFIXES if w.startswith(x)]
    return out


def edits_allowed(form: str, is_code: bool) -> int:
    return 0 if is_code or len(form) < 3 else 1 if len(form) < 8 else 2


def deletions(word: str, most: int) -> set[str]:
    """word and everything that deleting up to `most` of its characters leaves."""
    return {"".join(c for i, c in enumerate(word) if i not in gone) for k in range(most + 1) for gone in map(set, combinations(range(len(word)), k))}


def distance(a: str, b: str, most: float) -> float:
    """Weighted Damerau-Levenshtein distance; a swap of neighbours costs 0.9, an edit of the first character a little more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], [float(j) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [float(i)]
        for j, y in enumerate(b, 1):
            first = 0.05 if i == 1 or j == 1 else 0.0
            cost = min(row[j] + 1 + first, new[j - 1] + 1 + first, row[j - 1] + (0 if x == y else 1 + first))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 0.9)
            new.append(cost)
        before, row = row, new
    return row[-1]


class Dictionary:
    """Symmetric-delete index of the reference list."""

    def __init__(self, entries: list[tuple[int, str | None, str | None, str | None]], frequency: dict[str, int], most_letters: int = MOST_LETTERS):
        letters_held = 0
        self.index: dict[str, list[int]] = {}
        self.forms: list[tuple[str, int, int]] = []
        self.frequency = {i: frequency.get(name, 0) for i, name, _, _ in entries}
        self.cache: dict[str, int] = {}
        for i, name, english, code in entries:
            for text, is_code in ((name, False), (english, False), (code, True)):
                letters = next(iter(forms(text)), "") if text else ""
                if letters:
                    allowed = edits_allowed(letters, is_code)
                    n = len(letters)
                    letters_held += n * (1 + (allowed > 0) * n + (allowed > 1) * n * (n - 1) // 2)
                    if letters_held > most_letters:
                        raise ValueError(f"the dictionary of the reference list would hold more than {most_letters} letters")
                    self.forms.append((letters, i, allowed))
                    for d in deletions(letters, allowed):
                        self.index.setdefault(d, []).append(len(self.forms) - 1)
        self.longest = max((len(x[0]) for x in self.forms), default=0)

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def look_up(self, label: str) -> int:
        """Number of the entry that the label means, or 0."""
        found = self.cache.get(label)
        if found is None:
            found = self._look_up(label)
            if len(self.cache) > 200_000:
                self.cache.clear()
            self.cache[label] = found
        return found

    def _look_up(self, label: str) -> int:
        best: tuple = (99.0,)
        for step, w in enumerate(forms(label)):
            if len(w) > self.longest + 2:
                # No reference form is within two edits; deletions of a long text are not built. Its words are not searched for.
                continue
            near = {k for d in deletions(w, 0 if len(w) < 3 else 1 if len(w) < 7 else 2) for k in self.index.get(d, ())}
            for k in near:
                letters, i, allowed = self.forms[k]
                far = distance(w, letters, allowed) if w != letters else 0.0
                if far <= allowed * 1.1 + 1e-9:
                    best = min(best, (far, -self.frequency[i], step, i))
        return best[-1] if best[0] < 99 else 0


def fit(channels: DataFrame, reference: DataFrame, **options) -> Dictionary:
    """Dictionary of the reference list; frequencies are counted over all rows of channels, by an aggregate of bounded size."""
    entries = [tuple(r) for r in small_rows(reference.select("canon_id", "canon_name", "name_en", "short_code"), MOST_ENTRIES)]
    names = F.broadcast(reference.select(F.col("canon_name").alias("label")).filter("label IS NOT NULL").distinct())
    counts = channels.select(F.explode(F.array(*FIELDS)).alias("label")).join(names, "label", "left_semi").groupBy("label").count()
    return Dictionary(entries, {r["label"]: r["count"] for r in small_rows(counts, MOST_ENTRIES)}, **options)


def typed_labels(channels: DataFrame, reference: DataFrame, model: GarbleModel) -> DataFrame:
    """(row_id, field_name, label) of every label that is to be mapped."""
    entries = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("label")) for f in FIELDS))
    rows = channels.select("row_id", source_cell(F.col("source")).alias("cell"), F.explode(entries).alias("e")).select("row_id", "cell", "e.*")
    names = reference.select(F.col("canon_name").alias("label")).filter("label IS NOT NULL").distinct()
    rows = rows.filter(~is_blank(F.col("label"))).join(names, "label", "left_anti")
    return without_garbled(rows, "label", model).select("row_id", "field_name", "label")


def map_labels(channels: DataFrame, reference: DataFrame, dictionary: Dictionary, model: GarbleModel) -> DataFrame:
    """(row_id, field_name, label, canon_id) of every label that is to be mapped; canon_id 0 reports a miss."""
    held = channels.sparkSession.sparkContext.broadcast(dictionary)

    @F.pandas_udf(T.IntegerType())
    def entry(labels: pd.Series) -> pd.Series:
        return pd.Series([held.value.look_up(x) for x in labels], dtype="int32")

    return typed_labels(channels, reference, model).withColumn("canon_id", entry("label"))


def within_bounds(reference: DataFrame, most_entries: int = MOST_ENTRIES, most_letters: int = MOST_LETTERS) -> bool:
    """The dictionary of the reference list may be broadcast."""
    n = lambda c: F.coalesce(F.length(c), F.lit(0)).cast("double")
    letters = n("canon_name") ** 3 / 2 + n("name_en") ** 3 / 2 + n("short_code")
    r = reference.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(letters), F.lit(0.0)).alias("letters")).first()
    return r["n"] <= most_entries and r["letters"] <= most_letters


def by_join(channels: DataFrame, reference: DataFrame, model: GarbleModel, hot: int = 200_000) -> DataFrame:
    """What map_labels gives, for a reference list of any size: deletions of both sides meet in a join, and the best entry goes back to the rows of its label."""
    rows = materialize(typed_labels(channels, reference, model), "typed-labels")
    uses = channels.select(F.explode(F.array(*FIELDS)).alias("canon_name")).groupBy("canon_name").agg(F.count(F.lit(1)).alias("frequency"))

    def of_reference(batches):
        for b in batches:
            out = []
            for i, name, english, code in zip(b["canon_id"], b["canon_name"], b["name_en"], b["short_code"], strict=True):
                for text, is_code in ((name, False), (english, False), (code, True)):
                    letters = next(iter(forms(text)), "") if text else ""
                    allowed = edits_allowed(letters, is_code)
                    out += [(int(i), letters, allowed, d) for d in deletions(letters, allowed) if letters]
            yield pd.DataFrame(out, columns=["canon_id", "letters", "allowed", "deletion"])

    def of_labels(batches):
        for b in batches:
            out = [(label, step, w, d) for label in b["label"] for step, w in enumerate(forms(label)) for d in deletions(w, 0 if len(w) < 3 or len(w) > longest + 2 else 1 if len(w) < 7 else 2)]
            yield pd.DataFrame(out, columns=["label", "step", "form", "deletion"])

    @F.pandas_udf(T.DoubleType())
    def far(a: pd.Series, b: pd.Series, allowed: pd.Series) -> pd.Series:
        return pd.Series([0.0 if x == y else distance(x, y, n) for x, y, n in zip(a, b, allowed, strict=True)])

    entries = reference.select("canon_id", "canon_name", "name_en", "short_code").mapInPandas(of_reference, "canon_id int, letters string, allowed int, deletion string")
    entries = materialize(entries, "reference-deletions")
    # Longer forms than any of the reference's can only fit exactly; their deletions are not built.
    longest = entries.agg(F.coalesce(F.max(F.length("letters")), F.lit(0))).first()[0]
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    near = sizes.select("label").mapInPandas(of_labels, "label string, step int, form string, deletion string").join(entries, "deletion")
    near = near.select("label", "step", "form", "canon_id", "letters", "allowed").distinct().withColumn("far", far("form", "letters", "allowed")).filter("far <= allowed * 1.1 + 1e-9")
    near = near.join(reference.select("canon_id", "canon_name"), "canon_id").join(uses, "canon_name", "left")
    best = near.groupBy("label").agg(F.min(F.struct("far", (-F.coalesce("frequency", F.lit(0))).alias("f"), "step", "canon_id"))["canon_id"].alias("canon_id"))
    return attach_group_facts(rows, sizes.join(best, "label"), ["label"], "n", hot, "left").select("row_id", "field_name", "label", F.coalesce("canon_id", F.lit(0)).cast("int").alias("canon_id"))
