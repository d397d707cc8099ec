"""The pN_ queries and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playweave.common import table
from playweave.llm import copies, credentials, garble, labels, langid, leakage, lookalike, survivor, tokens


def p1_mapped(spark: SparkSession, d: str) -> DataFrame:
    """Every label that is to be mapped, with its entry; 0 reports a miss."""
    channels, reference = table(spark, d, "channels"), table(spark, d, "canonical_groups")
    model = garble.fit(channels)
    if labels.within_bounds(reference):
        return labels.map_labels(channels, reference, labels.fit(channels, reference), model)
    return labels.by_join(channels, reference, model)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_mapped(spark, d).select("row_id", "field_name", "canon_id")


def p1_misses(spark: SparkSession, d: str) -> DataFrame:
    """Labels that mean no entry, with their numbers of uses."""
    return p1_mapped(spark, d).filter("canon_id = 0").groupBy("field_name", "label").agg(F.count(F.lit(1)).alias("uses"))


def _names(spark: SparkSession, d: str) -> DataFrame:
    """Names to compare: those that are not garbled (problem 4)."""
    channels = table(spark, d, "channels")
    names = channels.select("row_id", "result_id", "name", garble.source_cell(channels["source"]).alias("cell"))
    return garble.without_garbled(names, "name", garble.fit(channels)).drop("cell")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.alike_pairs(_names(spark, d), "result_id")


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every row of a set of at least two spellings, with the set's smallest row and number of rows."""
    return lookalike.alike_rows(_names(spark, d), "result_id").select("row_id", "result_id", "class_row", "n")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return copies.channel_copies(table(spark, d, "channels"))[1]


def p3_collapsed(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct playable line once, with its number of copies."""
    return copies.channel_copies(table(spark, d, "channels"))[0]


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    """Every garbled text with the swap that spoiled it and, where nothing was lost, the text as it was."""
    channels = table(spark, d, "channels")
    return garble.detect(channels, garble.fit(channels))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    channels = table(spark, d, "channels")
    return garble.garbled_rows(channels, garble.fit(channels)).select("row_id", "field_name")


def p4_mapping(spark: SparkSession, d: str) -> DataFrame:
    """The learned byte-to-letter table."""
    channels = table(spark, d, "channels")
    return garble.mapping(channels, garble.fit(channels))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return credentials.find_credentials(table(spark, d, "source_results"))


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the redacted files and objects of every result."""
    out = credentials.redact(table(spark, d, "source_results").select("result_id", "sites", "python_files"))
    return out.select("result_id", F.md5(F.to_json("sites")).alias("sites_md5"), F.md5(F.to_json("python_files")).alias("files_md5"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The elected record of each group that has a clear best, out of the same votes as the surviving values."""
    return survivor.elect(table(spark, d, "channels"), table(spark, d, "source_list"), forms=False).filter("is_clear").select(F.col("best_row").alias("row_id"))


def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    """The winning votes of each field of every group; the values themselves are in `p6_values`."""
    return survivor.elect(table(spark, d, "channels"), table(spark, d, "source_list"), forms=False).select("key", "records", *(f"{f}_votes" for f in survivor.FIELDS))


def p6_values(spark: SparkSession, d: str) -> DataFrame:
    """One surviving record of each group, put together from the winning values; ties of votes are told apart by a hash, which SQL cannot follow."""
    out = survivor.elect(table(spark, d, "channels"), table(spark, d, "source_list"))
    return out.select("key", "records", "logo", "tvg_id", "quality", F.array_join("lines", "\n").alias("lines"), "best_row", "is_clear")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_identified(spark: SparkSession, d: str) -> DataFrame:
    """Every document that is not blank, with its language and confidence."""
    documents, languages = table(spark, d, "documents"), table(spark, d, "languages")
    out = langid.identify(documents, languages, langid.fit(documents, languages))
    return out.filter("lang IS NOT NULL").select("doc_id", "label", "lang", "confidence", "mixed")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    documents, languages = table(spark, d, "documents"), table(spark, d, "languages")
    return langid.found(documents, languages, langid.fit(documents, languages)).select("doc_id", "line_no", "lang")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_mapped, p1_misses, p2_found, p2_classes, p3_found, p3_collapsed, p4_found, p4_restored, p4_mapping, p5_found, p5_redacted, p6_found, p6_survivors, p6_values, p7_ids, p8_found, p9_found, p9_identified)}

_BLANK = r"[\s\p{Z}\x{0085}\x{200B}\x{FEFF}]"
_EDGE = r"""[\"''`<>(){}\[\]«»‘-‟〈-】〔-〛（）,.;:!?&|、。，；：！？．]"""
_LINES = rf"""
WITH a AS (SELECT row_id, regexp_replace(lower(channel_key), '[^\p{{L}}\p{{N}}]', '', 'g') AS k, regexp_replace(regexp_replace(replace(regexp_replace(lower(regexp_replace(url, '{_BLANK}', '', 'g')), '^{_EDGE}+|{_EDGE}+$', '', 'g'), '\', '/'), '#.*$', ''), '^$', '') AS t
  FROM channels WHERE regexp_replace(url, '{_BLANK}', '', 'g') <> '' AND regexp_replace(channel_key, '{_BLANK}', '', 'g') <> ''),
b AS (SELECT row_id, k, regexp_extract(t, '^([a-z][a-z0-9+.\-]*):/', 1) AS scheme, regexp_replace(t, '^([a-z][a-z0-9+.\-]*:)?/+', '') AS rest FROM a),
c AS (SELECT row_id, k, scheme, array_to_string(list_filter(string_split(split_part(rest, '?', 1), '/'), lambda x: x <> ''), '/') AS place,
  coalesce(array_to_string(list_sort(list_distinct(list_filter(string_split(replace(CASE WHEN contains(rest, '?') THEN replace(regexp_replace(rest, '^[^?]*\?', ''), '&amp;', '&') ELSE '' END, ';', '&'), '&'), lambda x: x <> ''))), '&'), '') AS params FROM b),
d AS (SELECT row_id, min(row_id) OVER w AS first_id, count(*) OVER w AS copies FROM c WINDOW w AS (PARTITION BY k, scheme, place, params))"""
_FULL = lambda c: f"CASE WHEN lower(regexp_replace({c}, '^{_BLANK}+|{_BLANK}+$', '', 'g')) NOT IN ({', '.join(repr(x) for x in survivor.STAND_INS)}) THEN 1 ELSE 0 END"


def _shown(field: str) -> str:
    """The form of a content field in SQL, null where it is a stand-in for "no value"."""
    cut = lambda c: f"regexp_replace({c}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"
    none = ", ".join(repr(x) for x in survivor.STAND_INS)
    if field == "lines":
        return f"CASE WHEN len(lines) > 0 THEN array_to_string(list_sort(list_distinct(list_filter(lines, lambda x: lower({cut('x')}) NOT IN ({none})))), chr(10)) END"
    return f"CASE WHEN lower({cut(field)}) NOT IN ({none}) THEN {cut(field)} END"


SQL: dict[str, str] = {
    "p3_found": f"{_LINES} SELECT first_id AS row_a, row_id AS row_b FROM d WHERE row_id <> first_id",
    "p3_collapsed": f"{_LINES} SELECT row_id, copies FROM d WHERE row_id = first_id",
    "p6_survivors": rf"""
WITH t AS (SELECT c.*, s.trust, regexp_replace(lower(c.channel_key), '[^\p{{L}}\p{{N}}]', '', 'g') AS key, epoch_us(c.seen_at) AS us, (SELECT max(epoch_us(seen_at)) FROM channels) AS last FROM channels c LEFT JOIN source_list s ON c.source = s.source WHERE c.channel_key IS NOT NULL),
v AS (SELECT *, CAST(coalesce(floor(coalesce(trust, 0) * pow(2.0, (us - last) / {survivor.HALF_LIFE_DAYS * 86400e6}) * {survivor.UNIT}), 0) AS BIGINT) AS vote, coalesce(us, {survivor.NEVER}) AS seen FROM t),
l AS ({" UNION ALL ".join(f"SELECT key, '{f}' AS field, {_shown(f)} AS form, vote, seen FROM v" for f in ("logo", "tvg_id", "quality", "lines"))}),
w AS (SELECT key, field, lower(form) AS norm, sum(vote) AS votes, max(seen) AS seen FROM l WHERE form IS NOT NULL GROUP BY ALL),
x AS (SELECT key, field, votes, row_number() OVER (PARTITION BY key, field ORDER BY votes DESC, seen DESC) AS rn FROM w)
SELECT g.key, g.records, {", ".join(f"CAST(coalesce(max(x.votes) FILTER (WHERE x.field = '{f}'), 0) AS BIGINT) AS {f}_votes" for f in ("logo", "tvg_id", "quality", "lines"))}
FROM (SELECT key, count(*) AS records FROM t GROUP BY key) g LEFT JOIN x ON x.key = g.key AND x.rn = 1 GROUP BY g.key, g.records""",
    "p6_found": rf"""
WITH a AS (SELECT c.row_id, regexp_replace(lower(c.channel_key), '[^\p{{L}}\p{{N}}]', '', 'g') AS k, {_FULL("c.logo")} + {_FULL("c.tvg_id")} + {_FULL("c.quality")} + CASE WHEN len(c.lines) > 0 THEN 1 ELSE 0 END AS filled,
  coalesce(epoch_us(c.seen_at), -9000000000000000) AS seen, coalesce(s.trust, -1) AS trust FROM channels c LEFT JOIN source_list s ON c.source = s.source WHERE c.channel_key IS NOT NULL),
b AS (SELECT *, max(filled) OVER w AS f, max(seen) OVER w AS s, max(trust) OVER w AS t, count(*) OVER w AS n, count(*) OVER (PARTITION BY k, filled, seen, trust) AS equal FROM a WINDOW w AS (PARTITION BY k))
SELECT row_id FROM b WHERE n > 1 AND filled = f AND seen = s AND trust = t AND equal = 1""",
}
