"""Bytes to text and text to values: encodings, digests, wrapped and encrypted configurations, plugin files."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings tried in order; the last resort is UTF-8 with replacement.
ENCODINGS = ["utf-8-sig", "utf-8", "gb18030", "big5"]
#: Methods of which a plugin class has at least one.
CONTENT_METHODS = {"homeContent", "categoryContent", "detailContent", "searchContent", "playerContent"}


@F.pandas_udf(T.StringType())
def decode_text(data: pd.Series) -> pd.Series:
    """Text of bytes by the first encoding that fits; null for null."""

    return data.map(lambda b: None if b is None else _decoded(b))


def unix_lines(data: Column) -> Column:
    """Bytes with CRLF replaced by LF; Latin-1 takes every byte as it is, so nothing leaves the JVM."""
    return F.encode(F.replace(F.decode(data, "ISO-8859-1"), F.lit("\r\n"), F.lit("\n")), "ISO-8859-1")


def content_digest(data: Column) -> Column:
    """SHA-256 of bytes, alike for both kinds of line end."""
    return F.sha2(unix_lines(data), 256)


def text_digest(text: Column) -> Column:
    """SHA-256 of a text, alike for both kinds of line end; stays in the JVM."""
    return F.sha2(F.replace(text, F.lit("\r\n"), F.lit("\n")), 256)


#: Opening and inner mark of an envelope, digits of its initial vector, digits of one AES block.
OPENING, INNER, VECTOR_DIGITS, BLOCK_DIGITS = "2423", "2324", 26, 32


def _envelope(text: Column) -> tuple[Column, Column, Column]:
    """(lower-cased digits, place of the inner mark behind the opening one or 0, number of digits of the body)."""
    t = F.lower(F.trim(text))
    mark = F.locate(INNER, t, len(OPENING) + 1)
    return t, mark, F.length(t) - mark - len(INNER) - VECTOR_DIGITS + 1


def is_encrypted(text: Column) -> Column:
    """A hexadecimal envelope: 80 characters or more, opening mark, inner mark, whole AES blocks between; false for null."""
    t, mark, body = _envelope(text)
    return F.coalesce(t.rlike(f"^{OPENING}[0-9a-f]{{{80 - len(OPENING)},}}\\z") & (mark > 0) & (body > 0) & (F.pmod(body, F.lit(BLOCK_DIGITS)) == 0), F.lit(False))


def decrypt(text: Column) -> Column:
    """Plain text of an envelope: key between the marks, initial vector in the last digits, both filled up with zeros; null if it does not open."""
    t, mark, body = _envelope(text)
    plain = lambda h: F.rpad(F.coalesce(F.try_validate_utf8(F.unhex(h).cast("string")), F.lit("")), 16, "0")
    key, iv = plain(F.substring(t, F.lit(len(OPENING) + 1), mark - len(OPENING) - 1)), plain(F.substring(t, F.length(t) - VECTOR_DIGITS + 1, F.lit(VECTOR_DIGITS)))
    data = F.unhex(F.substring(t, mark + len(INNER), body))
    return F.when(is_encrypted(text), F.try_validate_utf8(F.try_aes_decrypt(F.concat(F.encode(iv, "utf-8"), data), F.encode(key, "utf-8"), F.lit("CBC"), F.lit("PKCS")).cast("string")))


def unwrap(text: Column) -> Column:
    """JSON text behind an eight-character mark and `**`, in Base64 with any blanks; null if the whole text has not that form."""
    body = F.regexp_extract(F.trim(text), r"^[A-Za-z0-9_-]{8}\*\*([A-Za-z0-9+/=\s]+)\z", 1)
    data = F.try_to_binary(F.regexp_replace(body, r"\s+", ""), F.lit("base64"))
    return F.when(F.length(data) > 0, F.regexp_replace(F.try_validate_utf8(data.cast("string")), "^\ufeff", ""))


def parse_config(text: Column) -> Column:
    """A configuration as VARIANT: plain JSON, wrapped JSON, or an encrypted envelope; null if none fits."""
    bare = F.regexp_replace(text, "^\ufeff", "")
    return F.coalesce(F.try_parse_json(bare), F.try_parse_json(unwrap(bare)), F.try_parse_json(decrypt(bare)))


def _decoded(b: bytes) -> str:
    for e in ENCODINGS:
        try:
            return b.decode(e)
        except UnicodeDecodeError:
            continue
    return b.decode("utf-8", "replace")


def name_rank(name: Column) -> Column:
    """Order of the names of one file: those without a digest at their end first, then the short ones."""
    return F.struct(name.rlike(r"(?i)-[0-9a-f]{10}\.py$").alias("hashed"), F.length(name).alias("n"), F.lower(name).alias("low"), name.alias("name"))


def file_name(url: Column) -> Column:
    """File name of a plugin's address: the last part of its path, without characters that file systems refuse; `.py` is added, `spider.py` where nothing is left."""
    last = F.coalesce(F.try_url_decode(F.replace(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"([^/]*)$", 1), F.lit("+"), F.lit("%2B"))), F.lit(""))
    full = F.when(F.lower(last).endswith(".py"), last).otherwise(F.concat(last, F.lit(".py")))
    clean = F.regexp_replace(F.regexp_replace(full, r'[<>:"/\\|?*\x00-\x1f]', "_"), r"^[ .]+|[ .]+$", "")
    return F.when(url.isNotNull(), F.when(clean.isin("", "py"), F.lit("spider.py")).otherwise(clean))


@F.pandas_udf(T.BooleanType())
def is_plugin(data: pd.Series) -> pd.Series:
    """Source that has, anywhere, a class Spider and a content method. The code is parsed, never run."""

    def one(b):
        try:
            nodes = list(ast.walk(ast.parse(_decoded(b) if b is not None else "")))
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            return False
        spider = any(isinstance(n, ast.ClassDef) and n.name == "Spider" for n in nodes)
        return spider and any(isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)) and n.name in CONTENT_METHODS for n in nodes)

    return data.map(one)
