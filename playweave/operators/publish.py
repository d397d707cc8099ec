"""The gate before anything is published: texts in which a credential rule still fires are redacted, and how many there were is told."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playweave.functions import text


def findings(df: DataFrame) -> DataFrame:
    """df with `findings`: the columns and labels of the credential rules that fire in its texts, as `column:label`; never values."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    own = [F.transform(F.coalesce(text.finding_labels(F.col(f"`{c}`"), c), F.array().cast("array<string>")), _named(c)) for c in texts]
    return df.withColumn("findings", F.flatten(F.array(*own)) if own else F.array().cast("array<string>"))


def _named(column: str):
    return lambda label: F.concat(F.lit(f"{column}:"), label)


def guarded(df: DataFrame) -> DataFrame:
    """df with every text redacted in which a rule fires; all others stay as they are. A field of a sensitive name is replaced as a whole."""
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = F.col(f"`{f.name}`")
            labels = text.finding_labels(c, f.name)
            df = df.withColumn(f.name, F.when(F.array_contains(labels, "field"), F.lit("<redacted>")).when(F.size(labels) > 0, text.redact(c)).otherwise(c))
    return df


def write_report(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Each table as JSON lines in a folder of its own, guarded; the numbers of rows in which something was found before, by table."""
    counts = {}
    for name, df in tables.items():
        counts[name] = findings(df).filter(F.size("findings") > 0).count()
        guarded(df).write.mode("overwrite").json(f"{path}/{name}")
    return counts
