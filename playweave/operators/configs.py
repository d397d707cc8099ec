"""Configurations: sanitising of their objects, collection from fetched texts, merging, assembly and checks before publication."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playweave.functions import nested, payload, text
from playweave.sources import playlists

#: Mark of a secret that was not filled in, and the lists that a configuration carries beside sites and lives.
PLACEHOLDER, META = r"(?i)\{\{\s*SECRET_[^}]+\}\}", ["parses", "rules", "doh", "flags", "ijk", "ads"]
IMAGE = r"(?i)\.(?:png|jpe?g|gif|webp|svg)(?:$|[?#])"


def _field(j: Column, name: str) -> Column:
    return F.trim(F.coalesce(F.try_variant_get(F.try_parse_json(j), f"$.{name}", "string"), F.lit("")))


def _is_object(j: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(j)).startswith("OBJECT"), F.lit(False))


def site_reason(j: Column) -> Column:
    """Why a site object (JSON text) cannot be published; empty if it can."""
    api = _field(j, "api")
    return (
        F.when(~_is_object(j), "not_object").when(api == "", "no_api").when(api.rlike(PLACEHOLDER) | _field(j, "ext").rlike(PLACEHOLDER), "placeholder")
        .when(F.size(nested.credential_paths(j)) > 0, "credentials").when(api.rlike(r"^\.\.?/"), "relative").otherwise("")
    )


def live_reason(j: Column) -> Column:
    """Why a live object (JSON text) cannot be published; empty if it can."""
    url = _field(j, "url")
    return (
        F.when(~_is_object(j), "not_object").when(url == "", "no_url").when(url.rlike(PLACEHOLDER), "placeholder").when(F.size(nested.credential_paths(j)) > 0, "credentials")
        .when(url.rlike(r"^\.\.?/"), "relative").when(url.rlike(IMAGE), "image").otherwise("")
    )


def objects(results: DataFrame, column: str, reason) -> DataFrame:
    """(all other columns, pos, object, reason) of an array of JSON texts, one row each."""
    others = [c for c in results.columns if c != column]
    return results.select(*others, F.posexplode(column).alias("pos", "object")).withColumn("reason", reason(F.col("object")))


def collect(fetched: DataFrame) -> dict[str, DataFrame]:
    """Fetched sources (source, source_line, effective_url, http_status, content_type, data, error) as tables.

    sources: kind and status of each, by sniffing JSON, then M3U, then lists; sites and lives: the objects of configurations with references resolved, and why
    some cannot be published; channels: the entries of playlists and lists; meta: the other lists of configurations. A source that failed has no rows but its own.
    """
    rows = fetched.withColumn("text", payload.decode_text("data"))
    config = payload.parse_config(F.col("text"))
    is_config = F.coalesce(F.schema_of_variant(config).startswith("OBJECT"), F.lit(False))
    rows = rows.withColumn("config", F.when(is_config, nested.resolved_references(config.cast("string"), "effective_url")))
    kind = F.when(F.col("data").isNull(), "unknown").when(F.col("config").isNotNull(), "tvbox_json").when(text.looks_like_m3u(F.col("text")), "m3u").when(text.looks_like_txt(F.col("text")), "txt").otherwise("unknown")
    rows = rows.withColumn("kind", kind)
    listed = rows.filter("kind IN ('m3u', 'txt')")
    id_ = ["source", "source_line"]
    keyed = listed.select(F.to_json(F.struct(*id_)).alias("source"), "text", "kind")
    wide = ["source", "pos", "name", "url", "group_raw", "source_section", "logo", "tvg_id"]
    none = F.lit("")
    entries = playlists.m3u(keyed.filter("kind = 'm3u'")).withColumn("source_section", none).select(*wide).unionByName(playlists.txt(keyed.filter("kind = 'txt'")).withColumns({"logo": none, "tvg_id": none}).select(*wide))
    channels = entries.select(F.from_json("source", "source string, source_line int").alias("_s"), "*").select("_s.source", "_s.source_line", *wide[1:])
    parts = {}
    for name, reason in (("sites", site_reason), ("lives", live_reason)):
        items = rows.filter("config IS NOT NULL").select(*id_, F.from_json(F.get_json_object("config", f"$.{name}"), "array<string>").alias(name))
        parts[name] = objects(items, name, reason)
    meta = rows.filter("config IS NOT NULL").select(*id_, F.explode(F.array(*(F.struct(F.lit(k).alias("field"), F.get_json_object("config", f"$.{k}").alias("value")) for k in META))).alias("m")).select(*id_, "m.*").filter("value IS NOT NULL")
    found = channels.groupBy("source", "source_line").agg(F.count(F.lit(1)).alias("channels"))
    counts = [parts[n].filter("reason = ''").groupBy(*id_).agg(F.count(F.lit(1)).alias(n)) for n in parts]
    sources = rows.select(*id_, "effective_url", "kind", "http_status", "content_type", F.octet_length("data").cast("bigint").alias("bytes"), text.redact(F.col("error")).alias("detail"))
    for c in [found, *counts]:
        sources = sources.join(c, id_, "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    status = F.when(F.col("bytes").isNull(), "http_error").when(F.col("kind") == "tvbox_json", "reachable").when(F.col("kind") == "unknown", "invalid_config").when(n("channels") > 0, "reachable").otherwise(F.when(F.col("kind") == "m3u", "manifest_ok").otherwise("invalid_config"))
    return {"sources": sources.withColumns({"status": status, "channels": n("channels"), "sites": n("sites"), "lives": n("lives")}), "channels": channels, "meta": meta, **parts}


def merge_objects(rows: DataFrame, keys: list[str], order: list[str], column: str = "object") -> DataFrame:
    """(key, first, object): objects of equal key fields become one; each field takes its first value by order that is not empty.

    Fields are compared as rows of their own, so that neither wide objects nor popular keys gather in one task before they are reduced.
    """
    key = F.to_json(F.array(*(F.coalesce(F.get_json_object(column, f"$.{k}"), F.lit("")) for k in keys)))
    o = F.struct(*order)
    fields = rows.select(key.alias("key"), o.alias("o"), F.posexplode(nested.entries(column)).alias("n", "e"))
    first = fields.groupBy("key", "e.field").agg(F.min_by(F.struct(F.col("e.value").alias("value"), "n"), F.struct("o", "n")).alias("f"), F.min("o").alias("o"))
    pair = F.struct("o", "f.n", F.concat(F.lit('"'), F.regexp_replace("field", r'(["\\])', r"\\$1"), F.lit('":'), F.col("f.value")).alias("text"))
    return first.groupBy("key").agg(F.min("o").alias("first"), F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["text"]), ","), F.lit("}")).alias("object"))


def plugin_sites(names: DataFrame, address: Column) -> DataFrame:
    """(name, object): the site object of each plugin file."""
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    fields = F.struct(F.concat(F.lit("py-"), stem).alias("key"), stem.alias("name"), F.lit(3).alias("type"), address.alias("api"), F.lit(1).alias("searchable"), F.lit(1).alias("quickSearch"), F.lit(0).alias("filterable"), F.lit(1).alias("changeable"), F.lit(2).alias("playerType"))
    return names.select("name", F.to_json(fields).alias("object"))


def resolved_only(rows: DataFrame, column: str = "object") -> DataFrame:
    """Objects without a secret that was not filled in."""
    return rows.filter(~F.col(column).rlike(PLACEHOLDER))


def violations(sites: DataFrame, lives: DataFrame, spider: str = "") -> DataFrame:
    """(rule, item, detail) of everything that must not be published: placeholders, credentials, relative references, images, repeated plugin addresses, a spider that is not https."""
    spark = sites.sparkSession
    both = sites.select(F.lit("site").alias("item"), "object").unionByName(lives.select(F.lit("live").alias("item"), "object"))
    rule = lambda name, rows, detail: rows.select(F.lit(name).alias("rule"), "item", detail.alias("detail"))
    out = rule("placeholder", both.filter(F.col("object").rlike(PLACEHOLDER)), F.get_json_object("object", "$.key"))
    found = both.withColumn("f", F.explode(nested.credential_paths("object")))
    out = out.unionByName(rule("credentials", found, F.concat_ws(": ", "f.path", "f.label")))
    out = out.unionByName(rule("relative", both.filter(F.col("object").rlike(r'"(?:api|url)"\s*:\s*"\.\.?/')), F.get_json_object("object", "$.key")))
    out = out.unionByName(rule("image", both.filter((F.col("item") == "live") & F.get_json_object("object", "$.url").rlike(IMAGE)), F.get_json_object("object", "$.url")))
    apis = sites.filter(F.get_json_object("object", "$.type") == "3").groupBy(F.get_json_object("object", "$.api").alias("api")).count().filter("count > 1")
    out = out.unionByName(apis.select(F.lit("repeated").alias("rule"), F.lit("site").alias("item"), F.col("api").alias("detail")))
    if not spider.startswith("https://"):
        out = out.unionByName(spark.createDataFrame([("spider", "config", spider)], "rule string, item string, detail string"))
    return out


def assert_valid(found: DataFrame) -> None:
    """Raise with the first rules that are broken; details are labels, never values."""
    if rows := found.groupBy("rule").count().orderBy("rule").limit(20).collect():
        raise ValueError("not fit for publication: " + ", ".join(f"{r['rule']} ({r['count']})" for r in rows))


def assemble(sites: DataFrame, lives: DataFrame, meta: dict | None = None, merged_live: dict | None = None, **head) -> dict:
    """A configuration from merged objects (first, object): a document of the size of what is published, written by the driver. An own merged live list replaces one with its address."""
    take = lambda rows: [json.loads(r["object"]) for r in rows.orderBy("first").toLocalIterator()]
    lives_ = [x for x in take(lives) if not merged_live or x.get("url") != merged_live["url"]] + ([merged_live] if merged_live else [])
    return {"logo": "", "wallpaper": "", **head, "sites": take(sites), "lives": lives_, **{k: (meta or {}).get(k, []) for k in META}}


def subscription(config: dict, previous: dict | None = None, sticky: tuple[str, ...] = ("spider", "logo", "wallpaper"), legacy: tuple[str, ...] = ()) -> dict:
    """What is published of a configuration: no name, defaults filled in, and fields that were set by hand before kept, unless they are legacy values."""
    out = {"logo": "", "wallpaper": "", **{k: [] for k in META}, **{k: v for k, v in config.items() if k != "name"}}
    return out | {k: v for k in sticky if (v := str((previous or {}).get(k) or "").strip()) and v not in legacy}


def check_subscription(config: dict) -> None:
    """Raise where a list is missing, the logo is no text or the spider is not https."""
    wrong = [k for k in ("sites", "lives", *META) if not isinstance(config.get(k), list)]
    if wrong or not isinstance(config.get("logo"), str) or not str(config.get("spider", "")).startswith("https://"):
        raise ValueError(f"not fit for publication: {', '.join(wrong) or 'logo or spider'}")


def write_document(path: str, value) -> None:
    """A JSON document, indented, UTF-8, on the driver."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
