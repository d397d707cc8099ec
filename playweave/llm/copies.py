"""Records that differ only in formatting, collapsed into one record with a count (problem 3).

Most records have no copy at all, so the exact grouping should not have to move them. One pass reduces each record to
its id and a 128-bit hash of its canonical form; every partition then builds a blocked Bloom filter of the hashes it saw
once and of those it saw again. Merging two partitions' filters,

    again = again_a | again_b | (once_a & once_b),    once = once_a | once_b,

is associative and never loses a repeated hash: all bits of a hash seen by both sides survive the AND. Only records whose
bits are all set in the merged "again" filter are shuffled for the exact grouping; all others are certain singletons.

Size: the filter takes `bits_per_row` bits a row, at most `most_bits` (2**28 bits = 32 MB, the proven bound of a
broadcast). Where more would be needed, the hashes are written down in slices of their range, and each slice has a
filter, and a pass, of its own: each hash is still read as often as with one filter, and all filters stay as selective.

Nulls and blanks: records with a null or blank field take no part. Empty table: no rows. Exact repeats are copies.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playweave.common import BLANKS, is_blank, letters_digits, materialize, path_exists, shared_dir
from playweave.operators.skew import attach_group_facts

#: Bits of one block of the filter; both probes of a hash fall into the same block.
BLOCK_BITS = 1 << 16
#: Punctuation that may enclose or trail an address.
EDGE = r"[\"'`<>(){}\[\]«»‘-‟〈-】〔-〛（）,.;:!?&|、。，；：！？．]"


def canonical_address(url: Column) -> Column:
    """Scheme, host with port, non-empty path segments and the set of query parameters, lower-cased, blanks and edges cut.

    Null stays null. A fragment is not part of an address. Without a scheme the whole text is read as host and path.
    """
    text = F.lower(F.regexp_replace(url, BLANKS, ""))
    text = F.regexp_replace(text, rf"^{EDGE}+|{EDGE}+$", "")
    text = F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("/")), r"#.*$", "")
    scheme = F.regexp_extract(text, r"^([a-z][a-z0-9+.\-]*):/", 1)
    rest = F.regexp_replace(text, r"^([a-z][a-z0-9+.\-]*:)?/+", "")
    place = F.substring_index(rest, "?", 1)
    query = F.when(F.contains(rest, F.lit("?")), F.replace(F.regexp_replace(rest, r"^[^?]*\?", ""), F.lit("&amp;"), F.lit("&")))
    segments = F.array_join(F.filter(F.split(place, "/"), lambda x: x != ""), "/")
    params = F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(query, "[&;]"), lambda x: x != ""))), "&")
    return F.when(url.isNotNull(), F.concat_ws("\x1f", scheme, segments, F.coalesce(params, F.lit(""))))


def fingerprints(df: DataFrame, row_id: str, canon: list[Column]) -> DataFrame:
    """(row_id, h1, h2): a 128-bit hash of the canonical fields."""
    text = F.concat_ws("\x1e", *canon)
    return df.select(F.col(row_id).alias("row_id"), text.alias("_t")).select("row_id", F.xxhash64("_t").alias("h1"), F.xxhash64(F.lit(7), F.reverse("_t")).alias("h2"))


def _pack(bits: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=np.uint64)


def _probes(h1: np.ndarray, h2: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return h1 & (blocks - 1), (h2 & (BLOCK_BITS - 1)), ((h2 >> 20) & (BLOCK_BITS - 1))


def _partial(blocks: int):
    def build(batches):
        seen = []
        for b in batches:
            seen.append(np.stack([b["h1"].to_numpy(), b["h2"].to_numpy()]))
        if not seen:
            return
        h = np.concatenate(seen, axis=1)
        order = np.lexsort((h[1], h[0]))
        h = h[:, order]
        fresh = np.concatenate([[True], (h[:, 1:] != h[:, :-1]).any(axis=0)])
        start = np.flatnonzero(fresh)
        repeated = np.diff(np.append(start, h.shape[1])) > 1
        h = h[:, start]
        block, p, q = _probes(h[0], h[1], blocks)
        by = np.argsort(block, kind="stable")
        block, p, q, repeated = block[by], p[by], q[by], repeated[by]
        edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        out = []
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            once, again = np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool)
            once[p[a:z]] = once[q[a:z]] = True
            r = repeated[a:z]
            again[p[a:z][r]] = again[q[a:z][r]] = True
            out.append((int(block[a]), _pack(once), _pack(again) if r.any() else None))
            if len(out) == 512:
                yield pd.DataFrame(out, columns=["block", "once", "again"])
                out = []
        yield pd.DataFrame(out, columns=["block", "once", "again"])

    return build


def _merge(batches):
    """All partial filters of a block meet in one partition; one pair of blocks is held for each, never the partial rows."""
    held: dict[int, list[np.ndarray]] = {}
    for b in batches:
        for block, once, again in zip(b["block"], b["once"], b["again"], strict=True):
            o = _unpack(once)
            if block not in held:
                held[block] = [o.copy(), _unpack(again).copy() if again is not None else np.zeros_like(o)]
                continue
            pair = held[block]
            pair[1] |= pair[0] & o
            if again is not None:
                pair[1] |= _unpack(again)
            pair[0] |= o
    rows = [(k, v[1].view(np.int64).tolist()) for k, v in held.items() if v[1].any()]
    for i in range(0, len(rows), 64):
        yield pd.DataFrame(rows[i : i + 64], columns=["block", "words"])


def blocks_for(rows: int, bits_per_row: float, most_bits: int) -> tuple[int, int]:
    """(slices, blocks of each slice's filter), both powers of two."""
    slices = blocks = 1
    while slices * blocks * BLOCK_BITS < rows * bits_per_row:
        if blocks * BLOCK_BITS < most_bits:
            blocks *= 2
        else:
            slices *= 2
    return slices, blocks


def repeat_filter(prints: DataFrame, blocks: int) -> DataFrame:
    """(block, words) of the merged "again" filter of `blocks` blocks."""
    partial = prints.select("h1", "h2").mapInPandas(_partial(blocks), "block int, once binary, again binary")
    return partial.repartition("block").mapInPandas(_merge, "block int, words array<bigint>")


def flag_repeats(prints: DataFrame, again: DataFrame, blocks: int) -> DataFrame:
    """prints with maybe_repeated: false only for hashes that occur once. The filter's size is bounded, so it is broadcast."""
    block = F.col("h1").bitwiseAND(F.lit(blocks - 1)).cast("int")
    set_ = lambda shift: F.expr(f"(shiftright(words[cast(shiftright(shiftright(h2, {shift}) & {BLOCK_BITS - 1}, 6) as int)], cast(shiftright(h2, {shift}) & 63 as int)) & 1) = 1")
    joined = prints.withColumn("block", block).join(F.broadcast(again), "block", "left")
    return joined.select("row_id", "h1", "h2", F.coalesce(set_(0) & set_(20), F.lit(False)).alias("maybe_repeated"))


def flagged_prints(df: DataFrame, row_id: str, canon: list[Column], bits_per_row: float, most_bits: int) -> DataFrame:
    """Fingerprints of every record with maybe_repeated."""
    spark = df.sparkSession
    prints = fingerprints(df, row_id, canon)
    slices, blocks = blocks_for(df.count(), bits_per_row, most_bits)
    if slices == 1:
        held = materialize(prints, "fingerprints")
        # The merged filter is read by several plans: it is computed once.
        return flag_repeats(held, materialize(repeat_filter(held, blocks), "again"), blocks)
    base = f"{shared_dir(spark)}/playweave/sliced-{uuid.uuid4().hex}"
    sliced = prints.withColumn("slice", F.shiftrightunsigned("h1", 40).bitwiseAND(F.lit(slices - 1)).cast("int"))
    sliced.write.partitionBy("slice").parquet(f"{base}/prints")
    for i in range(slices):
        own = spark.read.schema(prints.schema).parquet(f"{base}/prints/slice={i}") if path_exists(spark, f"{base}/prints/slice={i}") else None
        if own is not None:
            flag_repeats(own, materialize(repeat_filter(own, blocks), "again"), blocks).write.mode("append").parquet(f"{base}/flagged")
    return spark.read.parquet(f"{base}/flagged")


def collapse_copies(df: DataFrame, row_id: str, canon: list[Column], hot: int = 200_000, bits_per_row: float = 12, most_bits: int = 1 << 28) -> tuple[DataFrame, DataFrame]:
    """(survivors, members) of the sets of records whose canonical fields agree.

    survivors: one row per set, (row_id = smallest id, copies). members: (row_a, row_b) for every further record.
    """
    flagged = flagged_prints(df, row_id, canon, bits_per_row, most_bits)
    maybe = flagged.filter("maybe_repeated").drop("maybe_repeated")
    groups = maybe.groupBy("h1", "h2").agg(F.min("row_id").alias("row_a"), F.count(F.lit(1)).alias("copies"))
    single = flagged.filter(~F.col("maybe_repeated")).select("row_id", F.lit(1).cast("bigint").alias("copies"))
    survivors = single.unionByName(groups.select(F.col("row_a").alias("row_id"), "copies"))
    members = attach_group_facts(maybe, groups.filter("copies > 1"), ["h1", "h2"], "copies", hot)
    return survivors, members.filter("row_id <> row_a").select("row_a", F.col("row_id").alias("row_b"))


def channel_copies(channels: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """collapse_copies over url and channel_key of channels."""
    taking_part = channels.filter(~is_blank(F.col("url")) & ~is_blank(F.col("channel_key")))
    return collapse_copies(taking_part, "row_id", [canonical_address(F.col("url")), letters_digits(F.col("channel_key"))], **options)
