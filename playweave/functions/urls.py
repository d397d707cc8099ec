"""Address functions on columns. Null in gives null out unless stated; nothing raises on malformed addresses."""

from __future__ import annotations

from urllib.parse import quote, unquote, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Normalised names of parameters and fields that hold credentials.
SENSITIVE_NAMES = ["accountinfo", "accesstoken", "apikey", "auth", "authorization", "authtoken", "bearer", "clientsecret", "cookie", "key", "password", "passwd", "pwd", "refreshtoken", "secret", "session", "sessionid", "sig", "sign", "signature", "token"]
#: Operator networks that cannot be reached from outside.
INTRANET_SUFFIXES = [".gmcc.net", ".itv.cmvideo.cn", ".chinanetcenter.com"]
INTRANET_MARKERS = ["ott.cctv.cn", ".hw.gmcc.net", "gslbserv.", "rrs0"]

#: A sensitive name with any of . _ - between its letters.
NAME_PATTERN = "(?:" + "|".join("[._-]*".join(n) for n in SENSITIVE_NAMES) + ")"


def trimmed(text: Column) -> Column:
    """Blanks of any kind cut at both ends."""
    return F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def scheme(url: Column) -> Column:
    """Lower-case scheme, empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^\s*([A-Za-z][A-Za-z0-9+.\-]*)://", 1))


def host(url: Column) -> Column:
    """Lower-case host without userinfo and port, empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def digest(url: Column) -> Column:
    """SHA-256 in hexadecimal."""
    return F.sha2(url, 256)


def strip_proxy(url: Column, prefixes: list[str]) -> Column:
    """Cut the first fitting proxy prefix, if an absolute address follows it."""
    out = url
    for p in reversed(prefixes):
        rest = F.substring(url, F.lit(len(p) + 1), F.length(url))
        out = F.when(url.startswith(p) & rest.rlike("^https?://"), rest).otherwise(out)
    return out


def mirrored(url: Column, hosts: list[str], mirror: str) -> Column:
    """Put a mirror before addresses of the given hosts."""
    return F.when(host(url).isin(hosts), F.concat(F.lit(mirror), url)).otherwise(url)


def safe(url: Column) -> Column:
    """Drop blanks at both ends, userinfo, fragment and parameters with sensitive names, also percent-encoded ones; the rest stays as written."""
    bare = F.regexp_replace(F.regexp_replace(trimmed(url), r"(?s)#.*\z", ""), r"^([A-Za-z][A-Za-z0-9+.\-]*://)[^/?@]*@", "$1")
    place, query = F.regexp_extract(bare, r"^([^?]*)", 1), F.regexp_extract(bare, r"(?s)\?(.*)\z", 1)

    def name(parameter: Column) -> Column:
        raw = F.regexp_extract(parameter, r"^([^=]*)", 1)
        return F.regexp_replace(F.lower(F.coalesce(F.try_url_decode(raw), raw)), "[^a-z0-9]", "")

    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~name(p).isin(SENSITIVE_NAMES)), "&")
    return F.when(kept != "", F.concat(place, F.lit("?"), kept)).otherwise(place)


def raw_address(base: str, path: Column) -> Column:
    """Address of a path under a base, each part percent-encoded, slashes kept."""
    parts = F.transform(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda x: F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")))
    return F.concat(F.lit(base.rstrip("/") + "/"), F.array_join(parts, "/"))


def is_internal(url: Column) -> Column:
    """Private, loopback or link-local address, or a host of an operator's network; false for null."""
    h = host(url)
    v6 = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?\[([0-9A-Fa-f:.]+)\]", 1))
    private = h.rlike(r"^(?:0|10|127)\.\d+\.\d+\.\d+$|^192\.168\.\d+\.\d+$|^172\.(?:1[6-9]|2\d|3[01])\.\d+\.\d+$|^169\.254\.\d+\.\d+$|^192\.0\.[02]\.\d+$|^198\.(?:1[89]\.\d+|51\.100)\.\d+$|^203\.0\.113\.\d+$|^2[4-5]\d\.\d+\.\d+\.\d+$|^localhost$")
    private = private | v6.rlike("^(?:::1?|f[cd][0-9a-f]{2}:.*|fe[89ab][0-9a-f]:.*|2001:db8:.*)$")
    own = private
    for s in INTRANET_SUFFIXES:
        own = own | h.endswith(s)
    for m in INTRANET_MARKERS:
        own = own | h.contains(m)
    return F.coalesce(own, F.lit(False))


def requoted(address: str) -> str:
    """Path and query of an address percent-encoded anew; an address that cannot be read stays."""
    try:
        p = urlsplit(address)
    except ValueError:
        return address
    return urlunsplit((p.scheme, p.netloc, quote(unquote(p.path), safe="/%:@!$&'()*+,;=~-._"), quote(unquote(p.query), safe="=&%:/?@!$'()*+,;~-._"), p.fragment))


@F.pandas_udf(T.StringType())
def requote(urls: pd.Series) -> pd.Series:
    """Percent-encode path and query anew, so that raw blanks and letters beyond ASCII become legal."""
    return urls.map(lambda u: None if u is None else requoted(u))


def normalized(url: Column, prefixes: list[str]) -> Column:
    """An address without blanks around it and without a known proxy's prefix, requoted; ASCII addresses without blanks or percent signs stay in the JVM."""
    bare = strip_proxy(trimmed(url), prefixes)
    return F.when(bare.rlike(r"^[!-$&-~]*$"), bare).otherwise(requote(bare))


@F.pandas_udf(T.StringType())
def resolve(references: pd.Series, bases: pd.Series) -> pd.Series:
    """References starting with ./ or ../ made absolute against their base; others stay."""

    def one(r, b):
        return urljoin(b, r) if r is not None and b is not None and r.startswith(("./", "../")) else r

    return pd.Series([one(r, b) for r, b in zip(references, bases, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def resolve_all(references: pd.Series, bases: pd.Series) -> pd.Series:
    """Every reference made absolute against its base."""

    def one(r, b):
        try:
            return None if r is None else urljoin(b or "", r)
        except ValueError:
            return r

    return pd.Series([one(r, b) for r, b in zip(references, bases, strict=True)], dtype=object)


def relay(url: Column, template: str) -> Column:
    """Address at a relay: {url} in the template, else the template as prefix; the address is fully encoded. Only https relays without userinfo."""
    parts = urlsplit(template)
    if parts.scheme != "https" or parts.username or parts.password:
        raise ValueError("a relay must be https and carry no userinfo")
    before, _, after = template.partition("{url}")
    encoded = F.replace(F.url_encode(url), F.lit("+"), F.lit("%20"))
    return F.when(host(url) != (parts.hostname or ""), F.concat(F.lit(before), encoded, F.lit(after)))
