"""Encoding of a corpus with a public byte-level BPE tokenizer (problem 7).

Texts of up to `piece_chars` characters are encoded directly. Longer ones are cut into pieces that are encoded in
parallel and concatenated as a tree. Around each join the words that the cut may have spoiled are encoded again: the
word before the cut is scanned on into the right piece until a word boundary agrees with the right piece's own scan.
Where one unsplit word spans the join, windows of tokens around it are encoded again and doubled until the first token
of the window is the left side's and the last is the right side's; then every neighbouring pair of tokens is one that
the encoder itself makes, which identifies the exact encoding.

Null and empty texts have the empty list; text that spells a special token is plain text. Rows may repeat.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playweave.common import materialize

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the published word pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE_CHARS = 4096


#: Vocabulary files that the driver has sent to this process: (folder, name) -> content.
_RECEIVED: dict[tuple[str, str], bytes] = {}


class Vocabulary:
    """Called in a worker, makes a vocabulary known there. A class of this module, not a closure: what it sets must be this module's own table."""

    def __init__(self, held, folder: str, name: str):
        self.held, self.key = held, (folder, name)

    def __call__(self) -> None:
        if self.key not in _RECEIVED:
            _RECEIVED[self.key] = self.held.value


def ship(spark: SparkSession, folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> Vocabulary:
    """The driver reads a vocabulary's file; workers need no copy on their disks."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return Vocabulary(spark.sparkContext.broadcast(f.read()), folder, name)


@lru_cache(maxsize=4)
def encoder(folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> tiktoken.Encoding:
    """The encoder of a vocabulary that was received, or else is read from the folder."""
    data = _RECEIVED.get((folder, name))
    if data is None:
        with open(f"{folder}/{name}.tiktoken", "rb") as f:
            data = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_WORDS = regex.compile(PATTERN)


class Piece:
    """An encoded piece: its text and ids, where its first word ends and its last one starts, and their numbers of ids."""

    __slots__ = ("text", "ids", "first_end", "first_n", "last_start", "last_n")

    def __init__(self, text: str, ids: list[int], first_end: int, first_n: int, last_start: int, last_n: int):
        self.text, self.ids, self.first_end, self.first_n, self.last_start, self.last_n = text, ids, first_end, first_n, last_start, last_n

    @staticmethod
    def of(text: str, ids: list[int], encode) -> Piece:
        first_end, last_start = len(text), 0
        for m in _WORDS.finditer(text):
            if m.start() == 0:
                first_end = m.end()
            # A word's end is certain once two more characters are known ("'l" may become "'ll").
            if m.start() <= len(text) - 2:
                last_start = m.start()
        first_n = len(encode(text[:first_end]))
        return Piece(text, ids, first_end, first_n, last_start, len(encode(text[last_start:])) if last_start else len(ids))


def _join_word(left: list[int], right: list[int], encoding: tiktoken.Encoding) -> list[int]:
    """Ids of one word from those of its two parts, by windows of tokens that grow until both sides agree."""
    k = 4
    while True:
        a, b = left[-k:], right[:k]
        raw = b"".join(map(encoding.decode_single_token_bytes, a + b))
        window = encoding._encode_single_piece(raw)
        if (k >= len(left) or window[0] == a[0]) and (k >= len(right) or window[-1] == b[-1]):
            return left[: len(left) - len(a)] + window + right[len(b) :]
        k *= 2


def join(a: Piece, b: Piece, encoding: tiktoken.Encoding) -> Piece:
    """The encoded concatenation of two encoded pieces."""
    if not a.text or not b.text:
        return a if a.text else b
    encode, tail, width = encoding.encode_ordinary, a.text[a.last_start :], 64
    while True:
        head = b.text[:width]
        whole = len(head) == len(b.text)
        spans = [m.span() for m in _WORDS.finditer(tail + head)]
        own = {0} | {m.end() for m in _WORDS.finditer(head)}
        if not whole:
            # The last word of a window may go on beyond it, and blanks at its end may be cut elsewhere.
            own = {x for x in own if x <= len(head) - 2}
            spans = [x for x in spans if x[1] <= len(tail) + len(head) - 2]
        agreed = next((n for n, (_, end) in enumerate(spans) if end >= len(tail) and end - len(tail) in own), None)
        if agreed is not None:
            break
        width *= 2
    cut = spans[agreed][1] - len(tail)
    if agreed == 0 and cut and cut == b.first_end and len(tail) + cut > 256:
        middle, dropped = _join_word(a.ids[len(a.ids) - a.last_n :], b.ids[: b.first_n], encoding), b.first_n
    else:
        # Word by word: a run of blanks is cut differently where a text ends.
        middle = [i for x, y in spans[: agreed + 1] for i in encode((tail + head)[x:y])]
        dropped = b.first_n if cut == b.first_end else sum(len(encode(m.group())) for m in _WORDS.finditer(head) if m.end() <= cut)
    ids = a.ids[: len(a.ids) - a.last_n] + middle + b.ids[dropped:]
    first = (a.first_end, a.first_n) if a.last_start else (spans[0][1], len(middle) if agreed == 0 else len(encode((tail + b.text)[: spans[0][1]])))
    if cut <= b.last_start <= len(b.text) - 2:
        last = (len(a.text) + b.last_start, b.last_n)
    else:
        region = tail + b.text
        start = max((x for x, _ in spans[: agreed + 1] if x <= len(region) - 2), default=0)
        last = (a.last_start + start, len(middle) if start == 0 and cut == len(b.text) else len(encode(region[start:])))
    return Piece(a.text + b.text, ids, *first, *last)


def join_all(texts: list[str], ids: list[list[int]], encoding: tiktoken.Encoding) -> list[int]:
    """Ids of the concatenation of encoded pieces, joined pairwise as a tree."""
    pieces = [Piece.of(t, list(i), encoding.encode_ordinary) for t, i in zip(texts, ids, strict=True)]
    while len(pieces) > 1:
        pieces = [join(pieces[i], pieces[i + 1], encoding) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    return pieces[0].ids if pieces else []


def encode_column(receive, folder: str, name: str):
    """Pandas UDF text -> ids."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(texts: pd.Series) -> pd.Series:
        receive()
        encode = encoder(folder, name).encode_ordinary
        return texts.map(lambda t: encode(t) if t else [])

    return run


def encode_corpus(documents: DataFrame, piece_chars: int = PIECE_CHARS, folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, ids) of every row of documents (doc_id, text)."""
    receive = ship(documents.sparkSession, folder, name)
    encode = encode_column(receive, folder, name)
    rows = documents.select("doc_id", "text")
    is_long = F.coalesce(F.length("text") > piece_chars, F.lit(False))
    short = rows.filter(~is_long).select("doc_id", encode("text").alias("ids"))
    # Rows may repeat: each long row gets a number of its own, fixed by writing it down.
    long = materialize(rows.filter(is_long).select(F.monotonically_increasing_id().alias("n"), "doc_id", "text"), "long-texts")
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / piece_chars).cast("int"))
    cut = long.select("n", "doc_id", "text", F.explode(starts).alias("i")).select("n", "doc_id", "i", F.substring("text", F.col("i") * piece_chars + 1, F.lit(piece_chars)).alias("piece"))
    pieces = cut.repartition("n", "i").select("n", "doc_id", "i", "piece", encode("piece").alias("ids"))

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        receive()
        pdf = pdf.sort_values("i")
        return pd.DataFrame({"doc_id": [pdf["doc_id"].iloc[0]], "ids": [join_all(list(pdf["piece"]), list(pdf["ids"]), encoder(folder, name))]})

    return short.unionByName(pieces.groupBy("n").applyInPandas(whole, T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])))
