"""Channel ledger, inventories and their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playweave.operators.dedup import keep_first


def sorted_set(c: str) -> Column:
    return F.array_sort(F.collect_set(c))


def ledger(channels: DataFrame) -> DataFrame:
    """One row per channel_key (not null): the name of the first line, number of lines, and the sorted sets of its attributes.

    The sets hold distinct values only, so map-side combination bounds what a hot key moves.
    """
    return channels.filter("channel_key IS NOT NULL").groupBy("channel_key").agg(
        F.min_by("name", "row_id").alias("name"), F.count(F.lit(1)).alias("line_count"), sorted_set("source").alias("sources"), sorted_set("source_line").alias("source_lines"),
        sorted_set("group_raw").alias("groups_raw"), sorted_set("source_section").alias("source_sections"), sorted_set("protocol").alias("protocols"),
    )


def ledger_lines(channels: DataFrame) -> DataFrame:
    """(channel_key, line): the ledger's lines, one row each, so that a key with very many lines needs no one array."""
    line = F.struct("url", F.sha2("url", 256).alias("url_hash"), "source", "source_line", "group_raw", "source_section", "protocol", "quality")
    return channels.filter("channel_key IS NOT NULL").select("channel_key", "row_id", line.alias("line"))


def counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def inventory(results: DataFrame) -> DataFrame:
    """Sources, sites and lives in one report: (kind, name, url, status, http_status, detail)."""
    head = [F.col("status"), F.col("http_status"), F.col("detail")]
    own = results.select(F.lit("source").alias("kind"), F.col("source").alias("name"), F.col("effective_url").alias("url"), *head)
    parts = [own]
    for kind, column, field in (("site", "sites", "$.api"), ("live", "lives", "$.url")):
        item = results.select(F.explode(column).alias("j"))
        parts.append(item.select(F.lit(kind).alias("kind"), F.get_json_object("j", "$.name").alias("name"), F.get_json_object("j", field).alias("url"), F.lit("unverified").alias("status"), F.lit(None).cast("int").alias("http_status"), F.lit("").alias("detail")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def classify(text: dict[str, Column], rules: list[tuple[str, str, str]], default: str) -> Column:
    """Ordered cascade: rules (column, regex, category), the first that fits decides. Null columns fit nothing."""
    out = F.lit(default)
    for column, pattern, category in reversed(rules):
        out = F.when(F.coalesce(text[column].rlike(pattern), F.lit(False)), F.lit(category)).otherwise(out)
    return out


def nested_ledger(channels: DataFrame, most_lines: int | None = None) -> DataFrame:
    """The ledger with each key's category and quality (of its first line) and its lines as an array of structs in order; for keys whose lines fit one row (`ledger_lines` is for all others).

    With most_lines, keys of more lines than that have a null array, never a part of it.
    """
    line = F.struct("row_id", "url", F.sha2("url", 256).alias("url_hash"), "source", "source_line", "group_raw", "source_section", "protocol", "quality")
    rows = channels.filter("channel_key IS NOT NULL")
    sizes = rows.groupBy("channel_key").agg(F.min_by("group_name", "row_id").alias("category"), F.min_by("quality", "row_id").alias("quality"), F.count(F.lit(1)).alias("_n"))
    small = sizes if most_lines is None else sizes.filter(F.col("_n") <= most_lines)
    lines = rows.join(small.select("channel_key"), "channel_key", "left_semi").groupBy("channel_key").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    return ledger(channels).join(sizes.drop("_n"), "channel_key").join(lines, "channel_key", "left")


def items(results: DataFrame, channels: DataFrame, order: str = "row_id") -> DataFrame:
    """Everything that a health run may check, one row each: (kind, name, url, status, source, source_line, channel_key, category, url_hash).

    Sources, sites, lives and channels in one table; rows of one kind and address are one, of sites and lives also of one name; the first by order counts. Rows without an address are left out.
    """
    none = F.lit(None).cast("string")
    wide = ["kind", "name", "url", "status", "source", "source_line", "channel_key", "category", "url_hash", "_o"]
    o = lambda *c: F.struct(*(x.cast("bigint").alias(f"o{i}") for i, x in enumerate(c)))
    parts = [results.select(F.lit("source").alias("kind"), F.col("source").alias("name"), F.col("effective_url").alias("url"), "status", "source", "source_line", none.alias("channel_key"), none.alias("category"), none.alias("url_hash"), o(F.col("result_id"), F.lit(0)).alias("_o"))]
    for kind, column, field in (("site", "sites", "$.api"), ("live", "lives", "$.url")):
        x = results.select("source", "source_line", "result_id", F.posexplode(column).alias("pos", "j"))
        parts.append(x.select(F.lit(kind).alias("kind"), F.get_json_object("j", "$.name").alias("name"), F.get_json_object("j", field).alias("url"), F.lit("unverified").alias("status"), "source", "source_line", none.alias("channel_key"), none.alias("category"), none.alias("url_hash"), o(F.col("result_id"), F.col("pos")).alias("_o")))
    parts.append(channels.select(F.lit("channel").alias("kind"), "name", "url", F.lit("unverified").alias("status"), "source", "source_line", "channel_key", F.col("group_name").alias("category"), F.sha2("url", 256).alias("url_hash"), o(F.col(order), F.lit(0)).alias("_o")))
    rows = parts[0].select(wide)
    for p in parts[1:]:
        rows = rows.unionByName(p.select(wide))
    by_name = F.when(F.col("kind").isin("site", "live"), F.coalesce("name", F.lit(""))).otherwise("")
    return keep_first(rows.filter(F.coalesce(F.trim("url"), F.lit("")) != ""), [F.col("kind"), F.col("url"), by_name], [F.col("_o")]).drop("_o")
