"""The best representative of each group of duplicates (problem 6).

Every record is unpivoted into long rows (group, field, value), one for each field that it fills. A row carries a vote: the
trust of the record's source times an exponential decay with age, as an integer, so that sums don't depend on the order of
rows. Votes of equal normalised values are summed on (group, field, value) first, with map-side combination (of a measure the
greatest value is all that stays, so its rows are combined on (group, field)); max_by picks the winner of each (group, field), and the winners are pivoted back into one row of each group. A group with a third of all
records costs no task more than another, and nothing is joined back.

Fields are of three kinds. Content (logo, tvg_id, quality, lines): the value with most votes wins. Measures (filled
fields, seen_at, trust): the greatest value wins. RECORD, whose value is the record's three measures together: a record has
its vote once for each field that it fills, and the record with most votes is elected; equal votes are told apart by the
measures. Votes never fall as a measure rises, so a clear best record is always the one elected; whether the elected one is
clear is told by the winners of the measures: it holds all three, and no other record holds the same.

Nulls: a null key joins no group; a null seen_at or trust is less than any value, and its vote is 0; null, blank and stand-in
values cast no vote. Ties of votes: the value seen last, then the greater hash. A field that nobody fills is null in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playweave.common import BLANKS, letters_digits

#: Texts that stand for "no value", lower-cased and trimmed.
STAND_INS = ["", "-", "--", "—", "null", "none", "nil", "nan", "n/a", "na", "无", "暂无", "未知", "unknown", "undefined"]
FIELDS = ["logo", "tvg_id", "quality", "lines"]
MEASURES = ["filled", "seen", "trust"]
RECORD = "#record"
#: Votes halve with this age, counted back from the last seen_at of the table.
HALF_LIFE_DAYS = 30.0
#: A vote of trust 1 and age 0. Votes older than 20 half-lives are 0; then the value seen last wins.
UNIT = 1 << 20
NEVER = -(1 << 57)


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{BLANKS}+|{BLANKS}+$", "")


def value_or_null(c: Column) -> Column:
    """The trimmed text, or null where it is a stand-in for "no value"."""
    return F.when(~F.lower(trimmed(c)).isin(STAND_INS), trimmed(c))


def shown_form(field: str) -> Column:
    """The form in which a content field's value is given back; null where the record has none."""
    if field == "lines":
        some = F.array_join(F.array_sort(F.array_distinct(F.filter("lines", lambda x: value_or_null(x).isNotNull()))), "\n")
        return F.when(F.size("lines") > 0, some)
    return value_or_null(F.col(field))


def long_rows(channels: DataFrame, sources: DataFrame, half_life_days: float = HALF_LIFE_DAYS, forms: bool = True) -> DataFrame:
    """(key, field, a, b, c, top, vote, form, row_id): a row of each record with a key for every field it fills; a, b, c are the normalised value, top is when it was seen. The value of a measure is top."""
    last = channels.agg(F.max(F.unix_micros(F.col("seen_at").cast("timestamp")))).first()[0] or 0
    trust = sources.groupBy("source").agg(F.max("trust").alias("trust"))
    rows = channels.select("row_id", "source", "seen_at", *FIELDS, letters_digits(F.col("channel_key")).alias("key")).filter("key IS NOT NULL").join(trust, "source", "left")
    us = F.unix_micros(F.col("seen_at").cast("timestamp"))
    vote = F.floor(F.coalesce("trust", F.lit(0)) * F.pow(F.lit(2.0), (us - F.lit(last)) / F.lit(half_life_days * 86400e6)) * UNIT)
    base = rows.select("key", "row_id", F.coalesce(us, F.lit(NEVER)).alias("seen"), F.coalesce("trust", F.lit(-1)).cast("bigint").alias("trust"), F.coalesce(vote, F.lit(0)).cast("bigint").alias("vote"), *(shown_form(f).alias(f) for f in FIELDS))
    base = base.withColumn("filled", sum(F.col(f).isNotNull().cast("bigint") for f in FIELDS))
    zero = F.lit(0).cast("bigint")
    none = F.lit(None).cast("string")
    form = lambda c: [c.alias("form")] if forms else []
    entry = lambda field, a=zero, b=zero, c=zero, top=F.col("seen"), vote=F.col("vote"), shown=none: F.struct(F.lit(field).alias("field"), a.alias("a"), b.alias("b"), c.alias("c"), top.alias("top"), vote.alias("vote"), *form(shown))
    entries = [F.when(F.col(f).isNotNull(), entry(f, F.xxhash64(F.lower(f)), shown=F.col(f))) for f in FIELDS] + [entry(m, top=F.col(m)) for m in MEASURES]
    # A trust below 0 would make older records of it the better ones.
    entries.append(entry(RECORD, *map(F.col, MEASURES), vote=F.greatest("vote", zero) * F.col("filled")))
    return base.select("key", "row_id", F.explode(F.array(*entries)).alias("e")).filter("e IS NOT NULL").select("key", "e.*", "row_id")


def winners(channels: DataFrame, sources: DataFrame, half_life_days: float = HALF_LIFE_DAYS, forms: bool = True) -> DataFrame:
    """(key, field, won, n): the value that wins each field of a group, and the number of records that have a value there."""
    by = ["key", "field", "a", "b", "c"]
    sums = [F.sum("vote").alias("votes"), F.count(F.lit(1)).alias("n"), F.max("top").alias("top"), F.min("row_id").alias("row_id")]
    votes = long_rows(channels, sources, half_life_days, forms).groupBy(*by, *(["form"] if forms else [])).agg(*sums)
    if forms:
        # Forms of one value share its votes.
        votes = votes.groupBy(*by).agg(F.sum("votes").alias("votes"), F.sum("n").alias("n"), F.max("top").alias("top"), F.min("row_id").alias("row_id"), F.max_by("form", F.struct("top", "form")).alias("form"))
    order = lambda *c: F.struct(*(F.expr(x).alias(f"o{i}") for i, x in enumerate(c)))
    # Records of the same measures have the same votes each, which don't add up.
    best = F.when(F.col("field") == RECORD, order("votes div n", "a", "top", "c")).when(F.col("field").isin(MEASURES), order("top", "0L", "0L", "0L")).otherwise(order("votes", "top", "a", "0L"))
    won = F.max_by(F.struct("a", "c", "top", "n", "row_id", "votes", *(["form"] if forms else [])), best)
    return votes.groupBy("key", "field").agg(won.alias("won"), F.sum("n").alias("n"))


def elect(channels: DataFrame, sources: DataFrame, half_life_days: float = HALF_LIFE_DAYS, forms: bool = True) -> DataFrame:
    """One row per key: (key, records, the winning value of each content field if forms are wanted, its votes, best_row, is_clear).

    best_row is the elected record, is_clear whether it is the clear best of a group of two or more.
    """
    at = lambda field, c: F.max(F.when(F.col("field") == field, F.col(c)))
    top = [at(m, "won.top").alias(f"top_{m}") for m in MEASURES]
    own = [at(RECORD, f"won.{c}").alias(f"own_{m}") for c, m in (("a", "filled"), ("top", "seen"), ("c", "trust"), ("n", "n"), ("row_id", "row"))]
    pick = [at(f, "won.form").alias(f) for f in FIELDS if forms] + [F.coalesce(at(f, "won.votes"), F.lit(0)).cast("bigint").alias(f"{f}_votes") for f in FIELDS]
    out = winners(channels, sources, half_life_days, forms).groupBy("key").agg(at(RECORD, "n").alias("records"), *top, *own, *pick)
    holds = F.lit(True)
    for m in MEASURES:
        holds = holds & (F.col(f"own_{m}") == F.col(f"top_{m}"))
    values = [F.split(f, "\n").alias(f) if f == "lines" else F.col(f) for f in FIELDS if forms]
    return out.select("key", "records", *values, *(f"{f}_votes" for f in FIELDS), F.col("own_row").alias("best_row"), ((F.col("records") > 1) & holds & (F.col("own_n") == 1)).alias("is_clear"))
