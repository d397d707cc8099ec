"""A hand-kept list that protects addresses: exact addresses, parts of addresses, hosts and what is under them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playweave.common import small_rows
from playweave.functions import urls

#: Most entries of a list; up to LITERAL_ENTRIES stand in the plan, longer lists go through one automaton a batch.
MOST_ENTRIES, LITERAL_ENTRIES = 100_000, 200


def parse(lines: DataFrame) -> DataFrame:
    """(kind, entry) of the lines (column value) of a list: `url` as written, `host` lower-cased; an address also protects its host.

    `#` begins a comment; null and blank lines are left out. Entries are distinct.
    """
    bare = F.trim(F.substring_index(F.regexp_replace(F.trim("value"), "^﻿", ""), "#", 1))
    entries = lines.select(bare.alias("e")).filter("e <> ''")
    is_url = F.lower("e").rlike("^https?://")
    found = F.when(is_url, F.array(F.struct(F.lit("url").alias("kind"), F.col("e").alias("entry")), F.struct(F.lit("host").alias("kind"), urls.host(F.col("e")).alias("entry"))))
    alone = F.array(F.struct(F.lit("host").alias("kind"), F.regexp_replace(F.lower("e"), r"^\.+", "").alias("entry")))
    return entries.select(F.explode(found.otherwise(alone)).alias("x")).select("x.*").filter("entry <> ''").distinct()


def _automaton(parts: list[str]):
    @F.pandas_udf(T.BooleanType())
    def run(texts: pd.Series) -> pd.Series:
        import ahocorasick

        found = ahocorasick.Automaton()
        for p in parts:
            found.add_word(p, True)
        found.make_automaton()
        return pd.Series([t is not None and next(found.iter(t), None) is not None for t in texts], dtype=bool)

    return run


def suffixes(host: Column) -> Column:
    """A host and every domain it is under."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def is_listed(url: Column, entries: list[tuple[str, str]]) -> Column:
    """True for an address that is or contains a listed one, in any letter case, or whose host is a listed host or under it; false for null."""
    parts = sorted({e.lower() for k, e in entries if k == "url"})
    hosts = sorted({e for k, e in entries if k == "host"})
    low = F.lower(F.trim(url))
    listed = F.lit(False)
    if len(parts) > LITERAL_ENTRIES:
        listed = _automaton(parts)(low)
    else:
        for p in parts:
            listed = listed | F.contains(low, F.lit(p))
    if hosts:
        own = suffixes(urls.host(url))
        if len(hosts) > LITERAL_ENTRIES:
            # Suffixes between commas, so that an automaton over `,host,` finds whole ones only.
            listed = F.coalesce(listed, F.lit(False)) | _automaton([f",{h}," for h in hosts])(F.concat(F.lit(","), F.array_join(own, ",,"), F.lit(",")))
        else:
            listed = F.coalesce(listed, F.lit(False)) | F.coalesce(F.arrays_overlap(own, F.array(*map(F.lit, hosts))), F.lit(False))
    return F.coalesce(listed, F.lit(False))


def mark(rows: DataFrame, url: str, lines: DataFrame, name: str = "whitelisted") -> DataFrame:
    """rows with a column that says whether the address is protected by the list (lines, a column value)."""
    entries = [(r["kind"], r["entry"]) for r in small_rows(parse(lines), MOST_ENTRIES)]
    return rows.withColumn(name, is_listed(F.col(url), entries))
