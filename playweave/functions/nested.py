"""Functions on nested JSON texts of any shape: credentials by path, references, nodes and addresses.

Values are walked with a stack, not by recursion. Null gives null; a text that is no JSON, or is nested too deeply for the parser, holds one string, itself.
Order is that of the document.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playweave.functions import text as texts
from playweave.functions.urls import SENSITIVE_NAMES, requoted

#: Fields that hold references, and those that may name a plugin file.
REFERENCES, PLUGIN_FIELDS = {"api", "url", "ext", "jar", "logo", "epg"}, {"api", "ext", "jar"}
_SENSITIVE = frozenset(SENSITIVE_NAMES)
_USERINFO, _HEADER, _BEARER, _PARAMETER, _PAIR, _PLACEHOLDER = map(re.compile, (texts.USERINFO, texts.HEADER, texts.BEARER, texts.PARAMETER, texts.PAIR, texts.PLACEHOLDER))
#: Parameters and bare pairs as redaction knows them, with a name of any kind.
_QUERY = re.compile(r"([?&;])([A-Za-z0-9_.-]+)=([^&#\s\"'<>]*)")
_BARE = re.compile(r"(?<![\w?&;.])([A-Za-z][A-Za-z0-9_.-]*)\s*[=:]\s*([^\s,;]+)")


def load(text: str):
    """A JSON value, or the text itself."""
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return text


def leaves(value):
    """(path, field, string) of every string in a value, in the document's order."""
    stack = [("$", "", value)]
    while stack:
        path, field, v = stack.pop()
        if isinstance(v, dict):
            stack += [(f"{path}.{k}", str(k), x) for k, x in reversed(v.items())]
        elif isinstance(v, list):
            stack += [(f"{path}[{i}]", "", x) for i, x in reversed(list(enumerate(v)))]
        elif isinstance(v, str):
            yield path, field, v


def rebuilt(value, change):
    """The value with every string replaced by change(field, string); lists and objects are made anew."""
    top = [value]
    stack = [(top, 0, "")]
    while stack:
        holder, at, field = stack.pop()
        v = holder[at]
        if isinstance(v, dict):
            holder[at] = v = dict(v)
            stack += [(v, k, str(k)) for k in v]
        elif isinstance(v, list):
            holder[at] = v = list(v)
            stack += [(v, i, "") for i in range(len(v))]
        elif isinstance(v, str):
            holder[at] = change(field, v)
    return top[0]


def flat_name(name: str) -> str:
    return re.sub("[^a-z0-9]", "", name.lower())


def means(value: str) -> bool:
    v = value.strip().strip("\"'")
    return v.lower() not in texts.PUBLIC and not _PLACEHOLDER.match(v) and len(v) >= 3


def labels(field: str, value: str) -> list[str]:
    """Labels of the credential rules that fire on a string under a field; never values."""
    d, out = unquote(value).replace("<redacted>@", ""), []
    if flat_name(field) in _SENSITIVE and flat_name(field) != "key" and means(value):
        out.append("field")
    if _USERINFO.search(d):
        out.append("url-userinfo")
    out += ["query"] * any(means(m[2]) for m in _PARAMETER.finditer(d)) + ["value"] * any(means(m[2]) for m in _PAIR.finditer(d))
    return out + ["credential-header"] * bool(_HEADER.search(d)) + ["bearer-token"] * bool(_BEARER.search(d))


def redacted(text: str) -> str:
    """A string with its credentials replaced."""
    out = _USERINFO.sub(r"\1<redacted>@", text)
    out = _QUERY.sub(lambda m: f"{m[1]}{m[2]}=<redacted>" if flat_name(m[2]) in _SENSITIVE else m[0], out)
    out = _BEARER.sub("Bearer <redacted>", _HEADER.sub(r"\1: <redacted>", out))
    return _BARE.sub(lambda m: f"{m[1]}=<redacted>" if flat_name(m[1]) in _SENSITIVE and means(m[2]) else m[0], out)


FINDING = T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("label", T.StringType())]))


@F.pandas_udf(FINDING)
def credential_paths(column: pd.Series) -> pd.Series:
    """Where credentials are: an array of (path, label)."""
    return column.map(lambda t: None if t is None else [{"path": p, "label": x} for p, f, v in leaves(load(t)) for x in labels(f, v)])


@F.pandas_udf(T.StringType())
def without_credentials(column: pd.Series) -> pd.Series:
    """The JSON text with every credential replaced; a sensitive field's value as a whole. Strings are rewritten until no rule fires, at most four times."""

    def change(field: str, value: str) -> str:
        for _ in range(4):
            found = labels(field, value)
            if not found:
                break
            value = "<redacted>" if "field" in found else redacted(unquote(value) if redacted(value) == value else value)
        return value

    def one(t):
        if t is None:
            return None
        value = load(t)
        out = rebuilt(value, change)
        return t if out == value else out if isinstance(value, str) and value == t else json.dumps(out, ensure_ascii=False, separators=(",", ":"))

    return column.map(one)


@F.pandas_udf(T.StringType())
def resolved_references(column: pd.Series, bases: pd.Series) -> pd.Series:
    """References made absolute and requoted: ./ and ../ in the fields that hold references, against the base; other fields and identifiers stay."""

    def one(t, base):
        if t is None:
            return None
        value = load(t)

        def change(field: str, v: str) -> str:
            if field.lower() not in REFERENCES:
                return v
            v = v.strip()
            if "{{" in v:
                # A secret that was not filled in stays readable as one.
                return v
            if v.startswith(("./", "../")) and base:
                v = urljoin(base, v)
            return requoted(v) if v.startswith(("http://", "https://")) else v

        return t if isinstance(value, str) else json.dumps(rebuilt(value, change), ensure_ascii=False, separators=(",", ":"))

    return pd.Series([one(t, b) for t, b in zip(column, bases, strict=True)], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def plugin_references(column: pd.Series) -> pd.Series:
    """Addresses of plugin files in the fields that may name one."""
    file = re.compile(r"\.py(?:$|[?#])", re.I)
    return column.map(lambda t: None if t is None else [v for _, f, v in leaves(load(t)) if f.lower() in PLUGIN_FIELDS and file.search(v)])


def matching_nodes(all_of: list[list[str]]):
    """Pandas UDF JSON text -> the objects that have, of each list of names, one with a value; what is inside such an object is not looked at."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(column: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            out, stack = [], [load(t)]
            while stack:
                v = stack.pop()
                if isinstance(v, dict):
                    if all(any(v.get(n) not in (None, "", [], {}) for n in names) for names in all_of):
                        out.append(json.dumps(v, ensure_ascii=False, separators=(",", ":")))
                    else:
                        stack += reversed(list(v.values()))
                elif isinstance(v, list):
                    stack += reversed(v)
            return out

        return column.map(one)

    return run


@F.pandas_udf(T.ArrayType(T.StringType()))
def addresses(column: pd.Series) -> pd.Series:
    """Every string that is an http(s) address, wherever it stands."""
    return column.map(lambda t: None if t is None else [v for _, _, v in leaves(load(t)) if v.startswith(("http://", "https://")) and urlsplit(v[:4096].split("#")[0]).netloc])


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("field", T.StringType()), T.StructField("value", T.StringType())])))
def entries(column: pd.Series) -> pd.Series:
    """Fields of a JSON object that are not empty, with their values as JSON; null for anything but an object."""

    def one(t):
        value = load(t) if t is not None else None
        if not isinstance(value, dict):
            return None
        return [{"field": k, "value": json.dumps(v, ensure_ascii=False, separators=(",", ":"))} for k, v in value.items() if v not in (None, "", [], {})]

    return column.map(one)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("number", T.IntegerType()), T.StructField("wire", T.IntegerType()), T.StructField("value", T.BinaryType())])))
def wire_fields(column: pd.Series) -> pd.Series:
    """Fields of a protobuf message without its schema: number, wire type and raw value; a varint as eight bytes. What is cut short ends the list."""

    def varint(b: bytes, at: int) -> tuple[int, int]:
        out = shift = 0
        while at < len(b):
            out |= (b[at] & 0x7F) << shift
            at, shift, more = at + 1, shift + 7, b[at] & 0x80
            if not more:
                return out & ((1 << 64) - 1), at
        raise IndexError

    def one(b):
        if b is None:
            return None
        out, at = [], 0
        try:
            while at < len(b):
                head, at = varint(b, at)
                wire = head & 7
                if wire == 0:
                    v, at = varint(b, at)
                    value = v.to_bytes(8, "big")
                else:
                    n, at = varint(b, at) if wire == 2 else (8 if wire == 1 else 4 if wire == 5 else -1, at)
                    if n < 0 or at + n > len(b):
                        break
                    value, at = b[at : at + n], at + n
                out.append({"number": head >> 3, "wire": wire, "value": value})
        except IndexError:
            pass
        return out

    return column.map(one)
