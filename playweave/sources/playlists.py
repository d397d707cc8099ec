"""Playlists and lists as tables, and back. Readers take a DataFrame of whole texts, so any source of texts will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playweave.common import path_exists
from playweave.functions import payload
from playweave.functions.urls import resolve_all
from playweave.operators.ranking import global_rank


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(source, text) of whole text files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))


def _split(text: Column) -> Column:
    """Lines of a text without blanks around them and without a byte-order mark."""
    return F.transform(F.split(text, r"\r?\n|\r"), lambda x: F.regexp_replace(x, r"^[\s\ufeff]+|\s+$", ""))


def line_list(texts: DataFrame) -> DataFrame:
    """(source, line_no, value): the lines of a list, from 1, without comments and blanks."""
    rows = texts.select("source", F.posexplode(_split(F.col("text"))).alias("pos", "line")).filter("line <> ''")
    return rows.filter(~F.col("line").startswith("#")).select("source", (F.col("pos") + 1).alias("line_no"), F.col("line").alias("value"))


#: Fixed value: how an attribute stands in an #EXTINF line.
ATTRIBUTE = r'(?i)(?:^|[\s,]){name}="([^"]*)"'


def attribute(line: Column, name: str) -> Column:
    """name="value" of an EXTINF line, in any case; empty if it is not there."""
    return F.trim(F.regexp_extract(line, ATTRIBUTE.replace("{name}", name), 1))


def _with_before(lines: Column) -> Column:
    """Neighbours within one text: an array of (line, the line before it)."""
    before = F.concat(F.array(F.lit("")), F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))))
    return F.arrays_zip(lines.alias("line"), F.slice(before, 1, F.size(lines)).alias("before"))


def m3u(texts: DataFrame, schemes: str = r"[A-Za-z][A-Za-z0-9+.\-]*") -> DataFrame:
    """(source, pos, name, url, group_raw, logo, tvg_id): each #EXTINF line with the address that follows it.

    An address uses up the line before it; a later #EXTINF replaces an earlier one; addresses without a name, also those whose
    #EXTINF has no comma, are dropped. Lines meet within their own text, so nothing is shuffled and texts of one source never mix.
    """
    kept = F.filter(_split(F.col("text")), lambda x: x.rlike(rf"(?i)^#EXTINF|^{schemes}://"))
    held = texts.select("source", kept.alias("kept")).filter("kept IS NOT NULL AND size(kept) > 1")
    pairs = held.select("source", F.posexplode(_with_before(F.col("kept"))).alias("pos", "p")).select("source", "pos", F.col("p")["line"].alias("line"), F.col("p")["before"].alias("info"))
    paired = pairs.filter(F.col("line").rlike(f"^{schemes}://") & F.col("info").rlike("(?is)^#EXTINF.*,"))
    name = F.trim(F.substring_index("info", ",", -1))
    return paired.select("source", "pos", name.alias("name"), F.col("line").alias("url"), attribute(F.col("info"), "group-title").alias("group_raw"), attribute(F.col("info"), "tvg-logo").alias("logo"), attribute(F.col("info"), "tvg-id").alias("tvg_id")).filter("name <> ''")


def txt(texts: DataFrame, schemes: str = "https?|rtmp|rtsp|rtp|udp") -> DataFrame:
    """(source, pos, name, url, group_raw, source_section): `name,address` lines; a line with #genre# sets the group and section of those after it.

    `section,#genre#` names a section that is its own group, `section,group#genre#` both, `#genre#group` a group alone. A text is
    cut at these lines, so that no line has to look back for its group; pos orders the lines of a text.
    """
    mark = r"(?m)^[^\n]*#genre#[^\n]*$"
    text = F.regexp_replace("text", r"\r\n?", "\n")
    marks = F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(f"({mark})"), 1))
    parts = texts.select("source", F.posexplode(F.arrays_zip(marks.alias("mark"), F.split(text, mark).alias("body"))).alias("part", "p"))
    rows = parts.select("source", "part", F.regexp_replace(F.col("p")["mark"], r"^[\s\ufeff]+|\s+$", "").alias("mark"), F.posexplode(_split(F.col("p")["body"])).alias("n", "line"))
    edges = lambda c: F.regexp_replace(c, "^[ ,]+|[ ,]+$", "")
    alone = F.col("mark").startswith("#genre#")
    head = F.trim(F.substring_index("mark", ",", 1))
    rest = edges(F.replace(F.regexp_extract("mark", r"^[^,]*,(.*)$", 1), F.lit("#genre#"), F.lit("")))
    section = F.when(alone, F.lit("")).when(F.contains("mark", F.lit(",")), head).otherwise(F.trim("mark"))
    group = F.when(alone, edges(F.substring("mark", 8, 1 << 20))).when(rest != "", rest).otherwise(section)
    url = F.trim(F.regexp_extract("line", r"^[^,]*,(.*)$", 1))
    out = rows.filter(~F.col("line").startswith("#") & F.col("line").contains(","))
    out = out.select("source", (F.col("part").cast("bigint") * (1 << 32) + F.col("n")).alias("pos"), F.trim(F.substring_index("line", ",", 1)).alias("name"), url.alias("url"), group.alias("group_raw"), section.alias("source_section"))
    return out.filter(F.col("url").rlike(f"(?i)^(?:{schemes})://") & (F.col("name") != ""))


def hls(manifests: DataFrame) -> DataFrame:
    """(source, pos, kind, reference): variants (the line after #EXT-X-STREAM-INF), initialisation maps and segments of HLS manifests.

    With a column `base`, references are resolved against it, and those that are no http(s) addresses then are left out.
    """
    held = manifests.select("source", *(["base"] if "base" in manifests.columns else []), F.filter(_split(F.col("text")), lambda x: x != "").alias("kept")).filter("kept IS NOT NULL")
    r = held.select(*[c for c in held.columns if c != "kept"], F.posexplode(_with_before(F.col("kept"))).alias("pos", "p")).withColumns({"line": F.col("p")["line"], "b": F.upper(F.col("p")["before"])}).drop("p")
    upper = F.upper("line")
    kind = F.when(upper.startswith("#EXT-X-MAP"), "map").when(F.col("line").startswith("#"), None).when(F.col("b").startswith("#EXT-X-STREAM-INF"), "variant").when(F.contains("line", F.lit(",")), None).otherwise("segment")
    reference = F.when(kind == "map", F.regexp_extract("line", '(?i)URI="([^"]+)"', 1)).otherwise(F.col("line"))
    out = r.select(*[c for c in held.columns if c != "kept"], "pos", kind.alias("kind"), reference.alias("reference")).filter("kind IS NOT NULL AND reference <> ''")
    if "base" in manifests.columns:
        out = out.withColumn("reference", resolve_all("reference", "base")).filter(F.col("reference").rlike("^https?://"))
    return out


def probe_candidates(manifests: DataFrame, variants: int = 3, most: int = 5) -> DataFrame:
    """(source, rank, reference): what to try of each manifest: its last variants from the end, then its maps and segments, at most `most`."""
    refs = hls(manifests)
    is_variant = F.col("kind") == "variant"
    order = F.when(is_variant, F.struct(F.lit(0).alias("a"), (-F.col("pos")).alias("b"))).otherwise(F.struct(F.lit(1).alias("a"), F.col("pos").alias("b")))
    own = refs.withColumn("_rn", F.row_number().over(W.partitionBy("source", "kind").orderBy(F.when(is_variant, -F.col("pos")).otherwise(F.col("pos"))))).filter((is_variant & (F.col("_rn") <= variants)) | (~is_variant & (F.col("_rn") <= most)))
    return own.withColumn("rank", F.row_number().over(W.partitionBy("source").orderBy(order))).filter(F.col("rank") <= most).select("source", "rank", "reference")


def to_m3u(channels: DataFrame, order: list[Column]) -> DataFrame:
    """(rank, value): playlist lines in order, the header first."""
    attr = lambda name, c: F.when(F.col(c) != "", F.concat(F.lit(f' {name}="'), F.col(c), F.lit('"')))
    entry = F.concat(F.lit("#EXTINF:-1"), F.coalesce(attr("tvg-id", "tvg_id"), F.lit("")), F.coalesce(attr("tvg-logo", "logo"), F.lit("")), F.coalesce(attr("group-title", "group_name"), F.lit("")), F.lit(","), F.coalesce("name", F.lit("")), F.lit("\n"), F.col("url"))
    ranked = global_rank(channels.filter("url IS NOT NULL"), order, "rank").select("rank", entry.alias("value"))
    return channels.sparkSession.createDataFrame([(-1, "#EXTM3U")], "rank bigint, value string").unionByName(ranked)


def write_m3u(channels: DataFrame, path: str, order: list[Column]) -> None:
    """Playlist as text parts whose names sort in the playlist's order."""
    to_m3u(channels, order).repartitionByRange("rank").sortWithinPartitions("rank").select("value").write.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with every cell quoted, quotes doubled; the header begins with a byte-order mark, by which spreadsheets know UTF-8."""
    first, *others = df.columns
    df.select(F.col(f"`{first}`").alias(f"\ufeff{first}"), *(F.col(f"`{c}`") for c in others)).write.csv(path, header=True, quoteAll=True, escape='"', lineSep="\n")


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def read_state(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """A JSON state table; a missing folder is an empty table unless strict, broken records are null unless strict."""
    if not strict and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "PERMISSIVE")


def read_plugins(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the Python files in a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.py").load(path).select("path", "content")


def plugin_files(files: DataFrame) -> DataFrame:
    """Files (path, content) with name, digest, whether they are valid plugins, and `role`: keep for the first name of each valid content, duplicate for its others, invalid for the rest."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    rows = files.withColumns({"name": name, "digest": payload.content_digest(F.col("content"))})
    valid = rows.dropDuplicates(["digest"]).select("digest", payload.is_plugin("content").alias("valid"))
    first = rows.groupBy("digest").agg(F.min(F.struct(payload.name_rank(F.col("name")), "path"))["path"].alias("_first"))
    role = F.when(~F.col("valid"), "invalid").when(F.col("path") == F.col("_first"), "keep").otherwise("duplicate")
    return rows.join(valid, "digest").join(first, "digest").withColumn("role", role).drop("_first")


def quarantine(files: DataFrame, path: str) -> None:
    """Duplicates are added to a table of their own, named with their digest; nothing is deleted."""
    stem = F.regexp_replace("name", r"\.py$", "")
    files.filter("role = 'duplicate'").select(F.concat(stem, F.lit("-"), F.substring("digest", 1, 10), F.lit(".py")).alias("name"), "path", "digest", "content").write.mode("append").parquet(path)


def named_files(files: DataFrame, order: list[str]) -> DataFrame:
    """Files (url, content) with the name to keep each under: that of its address, with ten digits of its digest where the first file of that name by order has another content. Files without an address are left out."""
    rows = files.withColumns({"_name": payload.file_name(F.col("url")), "digest": payload.content_digest(F.col("content"))})
    first = rows.groupBy("_name").agg(F.min_by("digest", F.struct(*order)).alias("_first"))
    own = F.concat(F.regexp_replace("_name", r"(?i)\.py$", ""), F.lit("-"), F.substring("digest", 1, 10), F.lit(".py"))
    return rows.join(first, "_name").withColumn("name", F.when(F.col("digest") == F.col("_first"), F.col("_name")).otherwise(own)).drop("_name", "_first")
