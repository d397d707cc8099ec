"""Names that look alike and are written with different characters (problem 2).

Repair works word by word. Compatibility forms (width, letter styles) and combining accents are composed by NFKC, all
kinds of blanks become one, and characters that show nothing are cut unless they hold an emoji together. In a word
whose letters come from more than one script that has look-alikes, the dominant script is the one with most
letters; letters of the others are replaced by its look-alikes, and the replacement stands only if the result is in the
corpus vocabulary: the words of one script that occur in the names. A word all of whose letters were exchanged (a lone
Cyrillic K after a 4) has one script only and no dominant one, yet looks the same; it is brought to Latin under the same condition, unless
`one_script` is false. The vocabulary is never collected: candidate words, of which
there are few, are checked by a semi-join.

Nulls and blank names take no part. Letter case, hyphens against blanks and traditional against simplified characters
stay different. Repeated rows are rows of their own, but equal strings are no pair.

Rows are repaired once and written down. Sets with one spelling only never meet; the rows of the others meet in blocks, so
that a name delivered in thousands of spellings is no single task.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playweave.common import is_blank, materialize
from playweave.operators.skew import attach_group_facts, pairs_within

#: Letters of other scripts that look like a Latin letter, and that letter.
CYRILLIC = "АВСЕНІЈКМОРЅТХУаеосрхуіјѕһԁԛԝ"
CYRILLIC_LATIN = "ABCEHIJKMOPSTXYaeocpxyijshdqw"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανιυρκϲϳ"
GREEK_LATIN = "ABEZHIKMNOPTYXoaviupkcj"
ARMENIAN = "ՕՍՏԼօսոցհք"
ARMENIAN_LATIN = "OUSLounghp"
CHEROKEE = "ᎪᎬᎠᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃᏟ"
CHEROKEE_LATIN = "AEDHJKLMPRSTVWZC"


OWN = {"CYRILLIC": (CYRILLIC, CYRILLIC_LATIN), "GREEK": (GREEK, GREEK_LATIN), "ARMENIAN": (ARMENIAN, ARMENIAN_LATIN), "CHEROKEE": (CHEROKEE, CHEROKEE_LATIN)}


def _shapes(to: str) -> dict[int, str]:
    """Every look-alike of a letter of a script -> that letter."""
    latin = {c: x for own, shapes in OWN.values() for c, x in zip(own, shapes, strict=True)}
    if to not in OWN:
        return {ord(a): b for a, b in latin.items()}
    back = {latin[c]: c for c in OWN[to][0]}
    return {ord(x): c for b, c in back.items() for x in (b, *(y for y in latin if latin[y] == b and y not in OWN[to][0]))}


SHAPES = {s: _shapes(s) for s in ("LATIN", *OWN)}

_HYPHENS = dict.fromkeys(map(ord, "‐‑−﹣"), "-")
_SHOWS_NOTHING = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff]")
_BLANKS = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")


def _pictograph(ch: str) -> bool:
    o = ord(ch)
    return o >= 0x1F000 and o < 0x20000 or 0x2190 <= o <= 0x2BFF and unicodedata.category(ch) in ("So", "Sm") or ch in "©®™‼⁉〰〽㊗㊙ℹ"


def visible(text: str) -> str:
    """text without characters that show nothing; joiners and presentation selectors inside an emoji stay."""
    if not _SHOWS_NOTHING.search(text):
        return text
    out: list[str] = []
    for i, ch in enumerate(text):
        if not _SHOWS_NOTHING.match(ch):
            out.append(ch)
            continue
        before = out[-1] if out else ""
        if ch == "️" and before and (_pictograph(before) or before in "#*0123456789" and text[i + 1 : i + 2] == "⃣"):
            out.append(ch)
        elif ch == "‍" and before and (_pictograph(before) or before == "️") and i + 1 < len(text) and _pictograph(text[i + 1]):
            out.append(ch)
        elif "\U000e0020" <= ch <= "\U000e007f" and before and (before == "\U0001f3f4" or "\U000e0020" <= before <= "\U000e007f"):
            out.append(ch)
    return "".join(out)


def plain(text: str) -> str:
    """One form of compatibility characters, accents, blanks, hyphens and invisible characters; case and script stay."""
    if text.isascii():
        return _BLANKS.sub(" ", text).strip()
    text = unicodedata.normalize("NFKC", visible(text)).translate(_HYPHENS)
    return _BLANKS.sub(" ", visible(text)).strip()


@lru_cache(maxsize=1 << 14)
def script(ch: str) -> str:
    name = unicodedata.name(ch, "")
    return next((s for s in SHAPES if name.startswith(s)), "OTHER" if ch.isalpha() else "")


def words(text: str) -> list[str]:
    return _WORD.findall(text)


def reshaped(word: str, to: str) -> str:
    """word with the letters that have a look-alike in a script replaced by it; accents stay."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", word).translate(SHAPES[to]))


def candidates(text: str, one_script: bool = True) -> list[tuple[str, str]]:
    """(word, replacement), best first, for the words of a plain name that may be disguised."""
    if text.isascii():
        return []
    found = []
    for word in dict.fromkeys(words(text)):
        own = Counter(s for ch in word if (s := script(ch)) in SHAPES)
        # A word of one script has no dominant one to go by: if all of it looks Latin, the Latin spelling stands for it.
        order = [s for s, _ in own.most_common()] if len(own) > 1 else ["LATIN"] if one_script and own and "LATIN" not in own else []
        for s in order:
            new = reshaped(word, s)
            if new != word and all(script(ch) in (s, "", "OTHER") for ch in new):
                found.append((word, new))
    return found


CANDIDATE = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("fixed", T.StringType()), T.StructField("rank", T.IntegerType())]))
#: Java regex classes of the scripts that have look-alikes.
_OTHER = r"\p{IsCyrillic}\p{IsGreek}\p{IsArmenian}\p{IsCherokee}"


def vocabulary(plain_names: DataFrame) -> DataFrame:
    """Distinct words of one script, over all names (a column `plain`)."""
    word = F.explode(F.regexp_extract_all("plain", F.lit(r"(\p{L}+)"), 1)).alias("fixed")
    kinds = [r"\p{IsLatin}", r"\p{IsCyrillic}", r"\p{IsGreek}", r"\p{IsArmenian}", r"\p{IsCherokee}"]
    scripts = sum(F.col("fixed").rlike(k).cast("int") for k in kinds)
    return plain_names.select(word).distinct().filter(scripts <= 1)


def plain_names(names: DataFrame) -> DataFrame:
    """names with `plain`; null for null and blank names. ASCII names never leave the JVM."""
    beyond = F.coalesce(F.col("name").rlike(r"[^\x00-\x7F]"), F.lit(False))

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(plain)

    near = F.trim(F.regexp_replace("name", r"\s+", " "))
    ascii_rows = names.filter(~beyond).withColumn("plain", F.when(near != "", near))
    return ascii_rows.unionByName(names.filter(beyond & ~is_blank(F.col("name"))).withColumn("plain", run("name")))


def repaired(names: DataFrame, one_script: bool = True, hot: int = 200_000) -> DataFrame:
    """names (columns row_id, name and others) with `same`: the form in which names that look alike are equal; names that take no part are left out."""
    rows = materialize(plain_names(names).filter("plain IS NOT NULL"), "plain-names")

    @F.pandas_udf(CANDIDATE)
    def proposed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"word": w, "fixed": f, "rank": i} for i, (w, f) in enumerate(candidates(t, one_script))])

    odd = F.col("plain").rlike(f"[{_OTHER}]")
    sizes = rows.filter(odd).groupBy("plain").agg(F.count(F.lit(1)).alias("n"))
    few = sizes.withColumn("c", F.explode(proposed("plain"))).select("plain", "n", "c.*")
    # Only words of mixed script, or short ones beside another script, get here; each is kept if the vocabulary has it.
    fit = few.join(vocabulary(rows), "fixed", "left_semi").groupBy("plain", "n", "word").agg(F.min_by("fixed", "rank").alias("fixed"))
    fixes = fit.groupBy("plain", "n").agg(F.map_from_entries(F.collect_list(F.struct("word", "fixed"))).alias("fixes"))
    done = attach_group_facts(rows.filter(odd), fixes, ["plain"], "n", hot, "left")
    done = materialize(done.withColumn("same", F.when(F.col("fixes").isNull(), F.col("plain")).otherwise(_apply("plain", "fixes"))).drop("plain", "fixes", "n"), "repaired-names")
    return rows.filter(~odd).withColumnRenamed("plain", "same").unionByName(done)


@F.pandas_udf(T.StringType())
def _apply(texts: pd.Series, fixes: pd.Series) -> pd.Series:
    def one(text, fix):
        fix = dict(fix) if fix is not None else {}
        return None if text is None else _WORD.sub(lambda m: fix.get(m.group(), m.group()), text)

    return pd.Series([one(t, f) for t, f in zip(texts, fixes, strict=True)], dtype=object)


def alike_rows(names: DataFrame, scope: str, one_script: bool = True, hot: int = 200_000) -> DataFrame:
    """(row_id, name, scope, same, set, n, class_row): the rows of sets of at least two spellings; class_row is the set's smallest row_id, n its rows."""
    rows = repaired(names.select("row_id", "name", scope), one_script, hot).select("row_id", "name", scope, "same", F.xxhash64(scope, "same").alias("set"))
    spelling = F.xxhash64("name")
    sets = rows.groupBy("set").agg(F.min(spelling).alias("least"), F.max(spelling).alias("most"), F.count(F.lit(1)).alias("n"), F.min("row_id").alias("class_row"))
    return materialize(attach_group_facts(rows, sets.filter("least <> most").select("set", "n", "class_row"), ["set"], "n", hot), "alike-rows")


def alike_pairs(names: DataFrame, scope: str, block: int = 2000, **options) -> DataFrame:
    """(row_a, row_b): rows of names (row_id, name, scope) of one scope whose names look the same and are different strings, row_a < row_b."""
    meeting = alike_rows(names, scope, **options)
    sides = [[F.col("row_id").alias(f"row_{x}"), F.col("name").alias(f"name_{x}")] for x in "ab"]
    both = pairs_within(meeting, ["set", scope, "same"], "n", *sides, block=block)
    return both.filter("row_a < row_b AND name_a <> name_b").select("row_a", "row_b")
