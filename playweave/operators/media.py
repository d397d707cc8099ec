"""Dataflow of catalogues: unions with caps, ordered pages, packed rows, matching, timed text and streams.

Orders are explicit and end in a unique column. Groups are reduced by aggregates; windows are only used over rows that are cut to a few a group, or over
one row a page or source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playweave.operators.dedup import keep_first
from playweave.operators.ranking import global_rank


def union_first(corpora: list[DataFrame], key: str, order: str) -> DataFrame:
    """Rows of several corpora, one for each key: from the first corpus that has it, there the first by order. Null and empty keys are dropped."""
    rows = corpora[0].withColumn("_corpus", F.lit(0))
    for i, c in enumerate(corpora[1:], 1):
        rows = rows.unionByName(c.withColumn("_corpus", F.lit(i)))
    return keep_first(rows.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != ""), [F.col(key)], [F.col("_corpus"), F.col(order)]).drop("_corpus")


def bucket(words: Column, buckets: list[tuple[str, list[str]]], default: str) -> Column:
    """First bucket that shares a word with an array of words; the default for none and for null."""
    out = F.lit(default)
    for name, own in reversed(buckets):
        out = F.when(F.arrays_overlap(words, F.array(*map(F.lit, own))), F.lit(name)).otherwise(out)
    return out


def with_all(rows: DataFrame, words: Column, name: str, every: str = "all") -> DataFrame:
    """A row for each word of an array, and one for all of them; a null array has only that."""
    return rows.withColumn(name, F.explode(F.concat(F.array(F.lit(every)), F.coalesce(words, F.array().cast("array<string>")))))


def group_index(rows: DataFrame, groupings: dict[str, Column]) -> DataFrame:
    """rows once for each grouping, with its name and the row's group in it; null groups are left out."""
    entries = F.array(*(F.struct(F.lit(k).alias("grouping"), c.cast("string").alias("group")) for k, c in groupings.items()))
    return rows.withColumn("_g", F.explode(entries)).select("*", "_g.grouping", "_g.group").drop("_g").filter("group IS NOT NULL")


def fan_out(rows: DataFrame, source: str, order: list[Column], per_source: int, most: int) -> DataFrame:
    """The first `per_source` rows of each source, sources in order, until `most` rows are there; with the position of each."""
    own = rows.withColumn("_rn", F.row_number().over(W.partitionBy(source).orderBy(*order))).filter(F.col("_rn") <= per_source)
    # One row a source: their running numbers tell which sources are asked at all.
    sizes = own.groupBy(source).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("_before", F.sum("_n").over(W.orderBy(source).rowsBetween(W.unboundedPreceding, -1))).withColumn("_before", F.coalesce("_before", F.lit(0))).filter(F.col("_before") < most)
    return own.join(sizes.drop("_n"), source).withColumn("position", (F.col("_before") + F.col("_rn")).cast("bigint")).filter(F.col("position") <= most).drop("_rn", "_before")


def pages_until(rows: DataFrame, key: str, page: str, least: int) -> DataFrame:
    """Whole pages of each key, in order, until at least `least` rows are there."""
    sizes = rows.groupBy(key, page).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(key).orderBy(page).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    asked = sizes.withColumn("_before", before).filter(F.col("_before") < least).select(key, page)
    return rows.join(asked, [key, page], "left_semi")


def options(rows: DataFrame, chosen: dict[str, str | None], ignored: tuple[str, ...] = ("", "all", "0")) -> DataFrame:
    """Rows that have every chosen value; values that mean nothing choose nothing."""
    for column, value in chosen.items():
        if value is not None and value.strip() not in ignored:
            rows = rows.filter(F.col(column) == value.strip())
    return rows


def option_map(chosen: Column, dropped: tuple[str, ...] = ("cat",), ignored: tuple[str, ...] = ("", "all", "0")) -> Column:
    """A map of options without those that mean nothing."""
    return F.map_filter(chosen, lambda k, v: ~k.isin(*dropped) & v.isNotNull() & ~F.trim(v).isin(*ignored))


def first_by_rank(rows: DataFrame, name: str, rank: Column, order: list[Column]) -> DataFrame:
    """One row a name: the best by rank, ties by order."""
    return keep_first(rows, [F.col(name)], [rank, *order])


def ranked(rows: DataFrame, rank: Column, order: list[Column], name: str = "position") -> DataFrame:
    """Every row with its position by rank and, within one rank, by order."""
    return global_rank(rows, [rank, *order], name)


def packed(entries: Column, title: str, id_: str, between: str = "#") -> Column:
    """Entries (structs that begin with their order) as `title$id` in order, equal ones once; marks that would break the packing become full-width."""
    safe = lambda c: F.translate(F.coalesce(c.cast("string"), F.lit("")), "$#", "＄＃")
    return F.array_join(F.array_distinct(F.transform(F.array_sort(entries), lambda x: F.concat_ws("$", safe(x[title]), safe(x[id_])))), between)


def packed_lines(rows: DataFrame, key: str, line: str, order: list[str], title: str, id_: str) -> DataFrame:
    """(key, play_from, play_url): the lines of each key, `$$$` between them, each the `#`-joined `title$id` of its entries. Lines come in the order of their first entry."""
    entry = F.struct(*order, title, id_)
    own = rows.groupBy(key, line).agg(F.min(F.struct(*order)).alias("_first"), packed(F.collect_list(entry), title, id_).alias("_packed"))
    lines = F.array_sort(F.collect_list(F.struct("_first", line, "_packed")))
    held = own.groupBy(key).agg(lines.alias("_l"))
    return held.select(key, F.array_join(F.transform("_l", lambda x: x[line]), "$$$").alias("play_from"), F.array_join(F.transform("_l", lambda x: x["_packed"]), "$$$").alias("play_url"))


def songs(rows: DataFrame, key: str, order: str, title: str, id_: str, picture: str) -> DataFrame:
    """(key, packed, n, picture): the songs of each key in one row, their number, and the first picture that is not empty."""
    return rows.groupBy(key).agg(packed(F.collect_list(F.struct(order, title, id_)), title, id_).alias("packed"), F.count(F.lit(1)).alias("n"), F.min_by(picture, F.when(F.trim(picture) != "", F.col(order))).alias("picture"))


def merged_search(first: DataFrame, second: DataFrame, title: str, order: str) -> DataFrame:
    """All results of a source, and those of a second whose title, blanks apart, the first does not have; of these the first of each title. Empty titles are dropped."""
    flat = lambda d: d.withColumn("_key", F.regexp_replace(title, r"[\s\p{Z}]+", "")).filter("_key <> ''")
    a, b = flat(first), flat(second)
    rest = keep_first(b.join(a.select("_key").distinct(), "_key", "left_anti").select(*b.columns), [F.col("_key")], [F.col(order)])
    return a.withColumn("_part", F.lit(0)).unionByName(rest.withColumn("_part", F.lit(1))).withColumnRenamed("_part", "part").drop("_key")


def preferred(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Records of both sources by key; each field is the first source's, or the second's where that is null or empty."""
    right = b.select(F.col(key).alias("_k"), *(F.col(f).alias(f"_{f}") for f in fields))
    joined = a.select(key, *fields).join(right, F.col(key) == F.col("_k"), "full")
    pick = lambda f: F.coalesce(F.when(F.trim(F.col(f).cast("string")) != "", F.col(f)), F.col(f"_{f}")).alias(f)
    return joined.select(F.coalesce(key, "_k").alias(key), *map(pick, fields))


def candidates(wanted: DataFrame, found: DataFrame, id_: str, name: str, artist: str, order: str) -> DataFrame:
    """(id of the wanted one, id and order of the best match): the same id first, else the same name and artist, the first by order. Two equality joins stand for the either-or."""
    f = found.select(F.col(id_).alias("match"), F.col(name).alias("_name"), F.col(artist).alias("_artist"), F.col(order).alias("_order"))
    w = wanted.select(F.col(id_).alias("wanted"), F.col(name).alias("_n"), F.col(artist).alias("_a"))
    same = w.join(f, F.col("wanted") == F.col("match")).select("wanted", "match", F.lit(0).alias("_rank"), "_order")
    like = w.join(f, (F.col("_n") == F.col("_name")) & (F.col("_a") == F.col("_artist"))).select("wanted", "match", F.lit(1).alias("_rank"), "_order")
    best = same.unionByName(like).groupBy("wanted").agg(F.min(F.struct("_rank", "_order", "match")).alias("b"))
    return best.select("wanted", "b.match", (F.col("b._rank") == 0).alias("same_id"))


#: Bitrates whose names are set right: bitrate, names that are wrong for it, the right one.
RATE_NAMES = [(2000, "高清|720|^原画$", "超清"), (1200, "标清|480", "高清")]


def rate_lines(servers: DataFrame, rates: DataFrame, room: str, most: int = 3) -> DataFrame:
    """(room, line, server, rate, name): each room's best servers by priority with all its rates, the greatest first; of rates of one bitrate the first counts.

    A room has few servers and rates, and meets only its own.
    """
    best = servers.withColumn("line", F.row_number().over(W.partitionBy(room).orderBy(F.desc("priority"), "ord"))).filter(F.col("line") <= most).select(room, "line", "server")
    first = keep_first(rates, [F.col(room), F.col("bitrate")], [F.col("ord")])
    label = F.col("name")
    for bitrate, wrong, right in reversed(RATE_NAMES):
        label = F.when((F.col("bitrate") == bitrate) & F.col("name").rlike(wrong), right).otherwise(label)
    return best.join(first.select(room, "bitrate", label.alias("name")), room).select(room, "line", "server", "bitrate", "name")


def routed(streams: DataFrame, key: str) -> DataFrame:
    """(key, hls, flv): addresses of each key by type, the greatest bitrate first; addresses of neither type are left out."""
    low = F.lower("url")
    kind = F.when(F.contains(low, F.lit("m3u8")), "hls").when(F.contains(low, F.lit("flv")) | F.startswith("url", F.lit("http")), "flv")
    rows = streams.withColumn("_kind", kind).filter("_kind IS NOT NULL")
    pick = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("_kind") == k, F.struct((-F.col("bitrate")).alias("b"), "url")))), lambda x: x["url"]).alias(k)
    return rows.groupBy(key).agg(pick("hls"), pick("flv"))


def by_state(state: Column) -> Column:
    """Order of lines by health: those in order first, then cooling ones, then dead ones."""
    return F.when(state == "ok", 0).when(state == "cooling", 1).when(state == "dead", 2).otherwise(3)


def dispatched(ids: Column, sources: list[str]) -> tuple[Column, Column]:
    """(source, rest) of ids like `source|rest`; null for other sources."""
    parts = F.split(ids, r"\|", 2)
    own = F.when(F.get(parts, F.lit(0)).isin(sources) & (F.size(parts) == 2), F.get(parts, F.lit(0)))
    return own, F.when(own.isNotNull(), F.get(parts, F.lit(1)))


def flattened_pages(rows: DataFrame, lists: list[str], order: str, size: int) -> DataFrame:
    """(value, position, page) of the elements of several array columns, in order, each value once, `size` to a page."""
    def placed_in(n: int):
        return lambda x, i: F.struct(F.lit(n).alias("list"), i.alias("i"), x.cast("string").alias("value"))

    each = F.array(*(F.transform(F.coalesce(c, F.array().cast("array<string>")), placed_in(n)) for n, c in enumerate(lists)))
    flat = rows.select(F.col(order).alias("_o"), F.explode(F.flatten(each)).alias("e")).select("_o", "e.*").filter("value IS NOT NULL AND value <> ''")
    placed = global_rank(keep_first(flat, [F.col("value")], [F.col("_o"), F.col("list"), F.col("i")]), [F.col("_o"), F.col("list"), F.col("i"), F.col("value")], "position")
    return placed.select("value", "position", (F.floor(F.col("position") / size) + 1).cast("bigint").alias("page"))


def in_input_order(asked: DataFrame, answers: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Answers in the order in which they were asked for; what was not answered is left out."""
    return asked.select(*keys, order).join(answers, keys).withColumnRenamed(order, "position")


def page_count(slugs: Column, current: Column, items: Column, slot: int = 3, slots: int = 7, full: int = 12) -> Column:
    """Number of pages by the links of a page: the greatest number in the page slot; a full page without such a link has at least one more."""
    numbers = F.transform(F.filter(slugs, lambda x: F.size(F.split(x, "-")) == slots), lambda x: F.split(x, "-")[slot].try_cast("bigint"))
    most = F.greatest(current, F.coalesce(F.array_max(numbers), current))
    return F.when((most <= current) & (items >= full), current + 1).otherwise(most)


def slot_address(tid: Column, page: Column, chosen: Column, slots: int = 7, page_slot: int = 3) -> Column:
    """`/show/` and the slots joined by `-`: the type first, the page where it is not the first, and `index:value` options of an array of texts, the last of each slot; the page slot is not for options."""
    def slot(i: Column) -> Column:
        own = F.filter(chosen, lambda x: F.substring_index(x, ":", 1) == i.cast("string"))
        option = F.when((F.size(own) > 0) & (i != page_slot), F.regexp_replace(F.element_at(own, -1), "^[^:]*:", ""))
        return F.coalesce(option, F.when(i == 0, F.trim(tid)).when((i == page_slot) & (page > 1), page.cast("string")).otherwise(""))

    return F.concat(F.lit("/show/"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), slot), "-"), F.lit(".html"))


def episodes(rows: DataFrame, key: str, order: str) -> DataFrame:
    """(key, number, url): episodes that have an address, numbered by their own number, or by their place in the list where that is null or 0."""
    place = F.row_number().over(W.partitionBy(key).orderBy(order))
    numbered = rows.withColumn("_n", F.coalesce(F.when(F.col("number") != 0, F.col("number")), place.cast("bigint")))
    return numbered.filter(F.trim("url") != "").select(key, F.col("_n").cast("bigint").alias("number"), "url", order)


def duration(seconds: Column) -> Column:
    """mm:ss; empty for null and for less than nothing."""
    return F.when(seconds >= 0, F.format_string("%02d:%02d", F.floor(seconds / 60).cast("int"), (seconds % 60).cast("int"))).otherwise("")


#: Fixed value: a time stamp at the beginning of a line of timed text.
STAMP = r"\[(\d{1,3}):(\d{2})(?:[.:](\d{1,3}))?\]"


def timed_lines(texts: DataFrame, key: str) -> DataFrame:
    """(key, start, text): each line of a timed text, once for each of its stamps, in milliseconds; an [offset:n] of the text is added; lines without words are left out."""
    offset = F.coalesce(F.regexp_extract("text", r"(?i)(?:^|\n)\[offset:\s*([+-]?\d+)\s*\]", 1).try_cast("bigint"), F.lit(0))
    lines = texts.select(key, offset.alias("_offset"), F.explode(F.split("text", r"\r?\n")).alias("line"))
    words = F.trim(F.regexp_replace(F.regexp_replace("line", rf"^(?:{STAMP})+", ""), r"<\d+:\d{2}(?:[.:]\d{1,3})?>", ""))
    each = lines.withColumn("words", words).filter(F.col("line").rlike(f"^{STAMP}") & (F.col("words") != ""))
    stamps = F.regexp_extract_all(F.regexp_extract("line", rf"^((?:{STAMP})+)", 1), F.lit(r"(\[\d{1,3}:\d{2}(?:[.:]\d{1,3})?\])"), 1)
    s = each.select(key, "_offset", "words", F.explode(stamps).alias("s"))
    part = lambda i: F.regexp_extract("s", STAMP, i)
    start = part(1).cast("bigint") * 60000 + part(2).cast("bigint") * 1000 + F.rpad(part(3), 3, "0").cast("bigint") + F.col("_offset")
    return s.select(key, start.alias("start"), F.col("words").alias("text"))


def word_times(lines: DataFrame, key: str, unit_ms: int = 300, least: int = 800) -> DataFrame:
    """(key, start, n, word, at, length): the words of each timed line with their share of its time by their letters.

    A line lasts as long as its letters need, but no longer than until the next line, and at least nine tenths of that; the last line of a text as long as its letters need.
    """
    following = F.lead("start").over(W.partitionBy(key).orderBy("start", "text"))
    words = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    rows = lines.withColumn("gap", following - F.col("start")).withColumn("words", words).withColumn("weight", F.length(F.array_join("words", "")))
    need = F.greatest(F.col("weight") * unit_ms, F.lit(least))
    length = F.when(F.col("gap").isNull(), need).otherwise(F.greatest(F.least("gap", need), F.floor(F.col("gap") * 0.9)))
    rows = rows.withColumn("length", length.cast("bigint")).withColumn("sizes", F.transform("words", F.length))
    each = rows.select(key, "start", "length", "weight", "sizes", F.posexplode("words").alias("n", "word"))
    upto = lambda k: F.aggregate(F.slice("sizes", 1, k), F.lit(0), lambda a, x: a + x)
    at = lambda k: F.floor(upto(k) * F.col("length") / F.col("weight")).cast("bigint")
    return each.select(key, "start", "n", "word", at(F.col("n")).alias("at"), (at(F.col("n") + 1) - at(F.col("n"))).alias("length"))


def cards(pages: DataFrame, key: str) -> DataFrame:
    """(key, pos, href, title): the links of markup pages with their text, each address once."""
    link = r"""(?is)(<a\s[^>]*href\s*=\s*["'][^"']+["'][^>]*>.*?</a>)"""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all("html", F.lit(link), 1)).alias("pos", "a"))
    href = F.regexp_extract("a", r"""(?i)href\s*=\s*["']([^"']+)["']""", 1)
    own = F.coalesce(F.when(F.regexp_extract("a", r"""(?i)title\s*=\s*["']([^"']*)["']""", 1) != "", F.regexp_extract("a", r"""(?i)title\s*=\s*["']([^"']*)["']""", 1)), F.trim(F.regexp_replace(F.regexp_replace("a", "<[^>]*>", " "), r"\s+", " ")))
    return keep_first(rows.select(key, "pos", href.alias("href"), own.alias("title")), [F.col(key), F.col("href")], [F.col("pos")])
