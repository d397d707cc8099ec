"""What goes into an optional review and what may come out of it: cut and redacted rows, JSON found in free text, suggestions from an allowed list."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playweave.functions import text

#: Most pending rows, most suggestions, most remarks of each kind.
PENDING, SUGGESTIONS, REMARKS = 120, 120, 20


def _cut(n: int, c: Column) -> Column:
    return F.substring(text.redact(c), 1, n)


def pending(rows: DataFrame, order: str, texts: dict[str, int], arrays: dict[str, tuple[int, int]], most: int = PENDING) -> DataFrame:
    """The first rows by order, with texts redacted and cut to their lengths, and arrays to their numbers of entries and those to their lengths."""
    out = rows.orderBy(order).limit(most)
    for c, n in texts.items():
        out = out.withColumn(c, _cut(n, F.col(c)))
    for c, (k, n) in arrays.items():
        out = out.withColumn(c, F.transform(F.slice(c, 1, k), partial(_cut, n)))
    return out


def json_in(answer: Column) -> Column:
    """The JSON object in free text as VARIANT: in a fence, or from the first brace to the last; null if there is none."""
    fenced = F.regexp_extract(answer, r"(?si)```(?:json)?\s*(\{.*\})\s*```", 1)
    body = F.when(fenced != "", fenced).otherwise(F.regexp_extract(answer, r"(?s)(\{.*\})", 1))
    value = F.try_parse_json(body)
    return F.when(F.schema_of_variant(value).startswith("OBJECT"), value)


def allowed(suggestions: DataFrame, categories: list[str], order: str, most: int = SUGGESTIONS) -> DataFrame:
    """Suggestions (order, category, confidence, reason) of an allowed category, redacted and cut, the first by order."""
    kept = suggestions.withColumn("category", F.trim("category")).filter(F.col("category").isin(categories))
    return kept.withColumns({"confidence": F.substring(F.lower("confidence"), 1, 12), "reason": F.substring(text.redact(F.col("reason")), 1, 500)}).orderBy(order).limit(most)


def remarks(texts: Column, most: int = REMARKS) -> Column:
    """The first entries of an array of texts, redacted and cut."""
    return F.transform(F.slice(texts, 1, most), lambda x: F.substring(text.redact(x), 1, 500))


def summary(streaks: DataFrame) -> DataFrame:
    """One row with the numbers of removable and pending streaks (column group)."""
    return streaks.agg(F.count_if(F.col("group") == "removable").alias("flagged"), F.count_if(F.col("group") == "pending").alias("pending"))
