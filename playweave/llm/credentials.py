"""Credentials in source files and configuration objects: finding and blanking them (problem 5).

Every string in a place that may hold a credential (the name it is assigned to, an address, a header, a command or a
key block) is weighed: the log odds of its place, plus those of how unnatural it is. Unnatural means
few characters per subword under a public tokenizer vocabulary: the number of subwords of a string of n characters is
Poisson with about 0.62 n for keys and passwords, 0.25 n for words and identifiers, so that long strings tell more than
short ones. The number of kinds of characters counts beside it. Positive odds make a credential. No length is too short,
no number of blanks too large. Formats that are credentials by themselves, and private keys, need no weighing. Placeholders, empty values,
values read elsewhere at run time, checksums, identifiers, images and public keys are no cases; nor is a pass phrase of plain words, which is natural.

Redaction keeps offsets: each character of a value becomes `*`, quotes, line ends and all that surrounds it stay,
so the code still parses and the JSON still loads; only the value's own place is blanked, not other places of the same
text. Files are taken whole and read in their own encoding. Each distinct file, of which there are many copies, is
searched once: contents are made distinct by digest, and what is found goes back to its rows by a join that no popular file unbalances.

Null and empty collections, null files and null objects hold nothing. An object that is no JSON is searched as text; its
key is taken from the text, or is null. JSON may be nested to any depth.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import math
import re
from functools import lru_cache
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playweave.llm.tokens import TOKENIZERS, encoder, ship
from playweave.operators.skew import attach_group_facts

#: Ends of normalised names (lower-case letters and digits) that hold a credential.
NAMES = ["password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "accesskey", "secretkey", "aeskey", "privatekey", "signkey", "appkey", "encryptionkey", "credential", "credentials", "authorization", "cookie", "jwt", "tk", "auth", "salt", "sign", "sig", "signature", "sid", "sessionid", "session"]
_NAME = re.compile(rf"(?:^|.*)(?:{'|'.join(NAMES)})$")
_EXACT = re.compile(r"(?:db|my|user|root|admin)?pass$")
#: Names that more often hold something else; their odds are lower.
_WEAK = re.compile(r"(?:^|.*)(?:cookie|tk|auth|salt|sign|sig|signature|sid|session)$")
#: Log odds of a value by its place: under a name, under a weak name, in an address or command.
NAMED, WEAKLY_NAMED, PLACED = 0.75, 0.25, 4.0
#: Subwords that a character makes, in keys and in words.
KEY_RATE, WORD_RATE = 0.62, 0.25
#: Log odds by the number of kinds of characters (lower case, upper case, digits, others), and of very short values.
KINDS = {0: -2.0, 1: -2.0, 2: -0.5, 3: 1.0, 4: 2.0}
SHORT = 3.0

_PLACEHOLDER = re.compile(r"(?i)^(?:your[\W_].*|<.*>?|\{.*|\$\{?.*|%.*|x+|\*+|\.+|change[\W_]?me.*|(?:example|placeholder|dummy|sample|redacted|none|null|true|false|undefined)\W*)$|\{\{|^\W*$")
_PRIVATE = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
_PRIVATE_END = re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
_USERINFO = re.compile(r"(?<=://)[^\s/:@'\"]*:(?P<v>[^\s/'\"]+)@(?=[\w\[])")
_PARAMETER = re.compile(r"(?:^|[?&;,\s]|%3[Ff]|%26|%3[Bb])(?P<n>[A-Za-z][\w.\-]*?)(?:=|%3[Dd])(?P<v>[^&;,\s'\"#%]+)")
_COMMAND = re.compile(r"\s(?:-u|--user)[ =]['\"]?[^\s:'\"]+:(?P<v>[^\s'\"]+)")
_FORMATS = re.compile(r"\b(?P<v>eyJ[\w\-]{6,}\.[\w\-]{10,}(?:\.[\w\-]{10,})?|[sr]k_(?:live|test)_\w{12,}|gh[pousr]_\w{20,}|glpat-[\w\-]{16,}|xox[abprs]-[\w\-]{10,}|AKIA[0-9A-Z]{16}|AIza[\w\-]{30,})")
_SCHEME = re.compile(r"^(?P<s>Bearer|Basic|Token|Digest)\s+(?P<v>\S+)$", re.I)
_LITERAL = re.compile(r"(?<![\w])(?P<p>[bBrRuUfF]{0,2})(?P<q>'''|\"\"\"|['\"])(?P<v>(?:\\.|(?!(?P=q)).)*)(?P=q)")
_ALONE = re.compile(r"^\s*[bBrRuUfF]{0,2}(?P<q>['\"])(?P<v>(?:\\.|(?!(?P=q)).)*)(?P=q)\s*[\\,)]*\s*$")
_TARGET = re.compile(r"(?P<n>[\w.\-\]\['\"]+)(?:\s*,\s*[\w.]+)*\s*(?::\s*\w+\s*)?(?:=|:)\s*\(?\s*$")
_FALLBACK = re.compile(r"(?:\bget|getenv|\bpop|setdefault)\(\s*['\"](?P<n>[\w.\-]+)['\"]\s*,\s*$")
_UNQUOTED = re.compile(r"^\s*(?:#|//|;|--|\*)?\s*(?P<n>[A-Za-z][\w.\-]*)\s*(?P<o>[:=])\s*(?P<v>[^\s'\"<>(){}\[\],]+)\s*$")


#: What a line must have to hold a credential, unless it goes on from the line before: a name, looked for among the line's letters and digits alone, as names are normalised.
_HINT_NAME = re.compile("|".join([*NAMES, "pass"]))
_HINT_PLACE = re.compile(r"@|-----|eyJ|[sr]k_|gh[pousr]_|glpat|xox|AKIA|AIza|\s-u|--user")
_PUNCTUATION = {c: None for c in range(128) if not chr(c).isalnum()}


def _may_hold(line: str) -> bool:
    flat = line.lower().translate(_PUNCTUATION)
    if not flat.isascii():
        flat = re.sub("[^a-z0-9]", "", flat)
    return bool(_HINT_NAME.search(flat) or _HINT_PLACE.search(line))


def _object_may_hold(text: str) -> bool:
    """The same of a whole JSON text; encoded letters may hide a name."""
    return "%" in text or "\\u00" in text or _may_hold(text)


def sensitive(name: str) -> bool:
    """A variable, field or parameter of this name holds a credential."""
    flat = re.sub(r"[^a-z0-9]", "", re.sub(r"\[['\"]?([\w\-]+)['\"]?\]$", r".\1", name.strip("'\"")).rsplit(".", 1)[-1].lower())
    return bool(_NAME.match(flat) or _EXACT.match(flat))


@lru_cache(maxsize=1 << 16)
def chars_per_subword(text: str) -> float:
    return len(text) / max(1, len(encoder(TOKENIZERS).encode_ordinary(text)))


def odds(value: str) -> float:
    """Log odds of a value being a credential, its place left out."""
    own = "".join(ch for ch in value if ch.isascii())
    n, subwords = len(own), len(own) / max(1e-9, chars_per_subword(own)) if own else 0.0
    unnatural = subwords * math.log(KEY_RATE / WORD_RATE) - n * (KEY_RATE - WORD_RATE)
    kinds = sum((any(map(str.islower, own)), any(map(str.isupper, own)), any(map(str.isdigit, own)), any(not ch.isalnum() for ch in own)))
    return unnatural + KINDS[kinds] - SHORT * math.exp(-max(0, n - 3) / 2)


def is_secret(value: str, place: float = NAMED) -> bool:
    """A value is a live credential rather than a placeholder or a word: by its place and by how unnatural it is."""
    return not _PLACEHOLDER.search(value) and place + odds(value) > 0


def place_of(name: str) -> float:
    """Log odds of a sensitive name."""
    return WEAKLY_NAMED if _WEAK.match(re.sub(r"[^a-z0-9]", "", name.lower())) else NAMED


def _basic(value: str) -> bool:
    """A Basic header's value is user:password in base64."""
    try:
        return b":" in base64.b64decode(value + "=" * (-len(value) % 4), validate=True)
    except (binascii.Error, ValueError):
        return False


def _under_name(value: str, name: str = "password") -> tuple[int, int] | None:
    """Span of the credential in a value that stands under a sensitive name."""
    if value.strip().lower() in ("", "bearer", "basic", "token", "digest"):
        return None
    if m := _SCHEME.match(value):
        basic = m["s"].lower() == "basic"
        return m.span("v") if (_basic(m["v"]) if basic else is_secret(m["v"])) else None
    if re.match(r"(?:https?|rtmp|rtsp|data):", value):
        return None
    if (pairs := list(_PARAMETER.finditer(value))) and "=" in value.rstrip("="):
        # A cookie or query: one of its parts may be a credential.
        return next((m.span("v") for m in pairs if sensitive(m["n"]) and is_secret(m["v"], place_of(m["n"]))), None)
    return (0, len(value)) if is_secret(value, place_of(name)) else None


def in_text(text: str) -> list[tuple[int, int]]:
    """Spans of the credentials that any text shows by place or format: private keys, addresses, parameters, commands, known formats."""
    spans = []
    for m in _PRIVATE.finditer(text):
        end = _PRIVATE_END.search(text, m.end())
        spans.append((m.start(), end.end() if end else len(text)))
    if "://" in text:
        spans += [m.span("v") for m in _USERINFO.finditer(text) if is_secret(m["v"], PLACED)]
    spans += [m.span("v") for m in _PARAMETER.finditer(text) if sensitive(m["n"]) and is_secret(m["v"], place_of(m["n"])) and ("?" in text[: m.start() + 1] or "%3" in text[: m.start() + 3] or ";" in text or m.start() == 0)]
    spans += [m.span("v") for m in _COMMAND.finditer(text) if is_secret(m["v"], PLACED)]
    spans += [m.span("v") for m in _FORMATS.finditer(text)]
    return spans


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _target(left: str) -> str:
    """The name that a literal after `left` is given to: of `a, b = ` the first, of `f(a, b=` the last."""
    m = _TARGET.search(left)
    if not m:
        return ""
    names = [x.strip() for x in re.split(r"[:=]", m[0])[0].split(",")]
    return names[-1] if left.count("(") > left.count(")") else names[0]


def in_code(code: str) -> list[tuple[int, int]]:
    """Spans of the credentials in a source file, in order."""
    spans = []
    for m in _PRIVATE.finditer(code):
        end = _PRIVATE_END.search(code, m.end())
        spans.append((m.start(), end.end() if end else len(code)))
    starts, at = [], 0
    lines = code.split("\n")
    for line in lines:
        starts.append(at)
        at += len(line) + 1
    blocks = [(m.start(), e.end() if (e := re.compile("-----END").search(code, m.end())) else m.end()) for m in re.finditer(r"-----BEGIN (?:[A-Z0-9]+ )*(?:PUBLIC KEY|CERTIFICATE)-----", code)] + spans
    for n, line in enumerate(lines):
        base = starts[n]
        if not (_may_hold(line) or n and re.search(r"[=:(\\]\s*$", lines[n - 1])) or any(a <= base < b for a, b in blocks):
            continue
        found: list[tuple[int, int]] = []
        for m in _LITERAL.finditer(line):
            value, left = m["v"], line[: m.start()]
            found += [(m.start("v") + a, m.start("v") + b) for a, b in in_text(value) if not _PRIVATE.match(value, a)]
            name = ""
            if t := _FALLBACK.search(left):
                before = _TARGET.match(left[: t.start()].split("=", 1)[0] + "=") if "=" in left[: t.start()] else None
                name = t["n"] if sensitive(t["n"]) or not before else before["n"]
            elif t := _target(left):
                name = t
            elif not left.strip() and n and (t := _target(lines[n - 1].rstrip("\\ \r"))):
                name = t
            if not name or not sensitive(name):
                continue
            tail, k = [], n
            if re.fullmatch(r"\s*\\?\s*", line[m.end() :]):
                # Adjacent literals of the next lines belong to the value.
                while k + 1 < len(lines) and (alone := _ALONE.match(lines[k + 1])):
                    k += 1
                    tail.append((starts[k] + alone.start("v"), starts[k] + alone.end("v")))
            whole = value + "".join(code[a:b] for a, b in tail)
            if span := _under_name(whole, name):
                found.append((m.start("v") + min(span[0], len(value)), m.start("v") + min(span[1], len(value))))
                spans += [("tail", *x) for x in tail]  # type: ignore[list-item]
        stripped = line.strip()
        if m := _UNQUOTED.match(line.rstrip("\r")):
            if (m["o"] == ":" or stripped.startswith(("#", "//", ";"))) and sensitive(m["n"]) and is_secret(m["v"], place_of(m["n"])):
                found.append(m.span("v"))
        if stripped.startswith(("#", "//", "*", ";")) or "'" not in line and '"' not in line:
            found += in_text(line)
        spans += [(base + a, base + b) for a, b in found]
    tails = [x[1:] for x in spans if x[0] == "tail"]
    heads = _merged([x for x in spans if x[0] != "tail"])
    return [(a, b) for a, b in heads] + [(-a - 1, b) for a, b in tails]


_JSON_TOKEN = re.compile(r'[{}\[\]]|"(?:\\.|[^"\\])*"', re.S)
_JSON_PIECE = re.compile(r"\\u[0-9a-fA-F]{4}|\\.|.", re.S)


def _unescape(raw: str) -> tuple[str, list[int]]:
    """The string of a JSON literal's inside, and where each of its characters begins in it; the end is added."""
    if "\\" not in raw:
        return raw, list(range(len(raw) + 1))
    chars, at = [], []
    for m in _JSON_PIECE.finditer(raw):
        piece = m[0]
        try:
            ch = piece if len(piece) == 1 else json.loads(f'"{piece}"')
        except ValueError:
            ch = piece[-1]
        if chars and "\udc00" <= ch <= "\udfff" and "\ud800" <= chars[-1] <= "\udbff":
            chars[-1] = (chars[-1] + ch).encode("utf-16", "surrogatepass").decode("utf-16")
            continue
        chars.append(ch)
        at.append(m.start())
    return "".join(chars), [*at, len(raw)]


def _strings(text: str, name: str = ""):
    """(name, string, its character positions in text, depth) of every string value in a JSON text, without recursion into its nesting."""
    stack: list[list] = []
    key = name
    for m in _JSON_TOKEN.finditer(text):
        token = m[0]
        if token in "{[":
            stack.append([token, key])
        elif token in "}]":
            if stack:
                key = stack.pop()[1]
        else:
            value, at = _unescape(token[1:-1])
            rest = text[m.end() : m.end() + 64].lstrip()
            if stack and stack[-1][0] == "{" and rest.startswith(":"):
                key = value
                continue
            own = key if stack and stack[-1][0] == "{" else stack[-1][1] if stack else name
            yield own, value, [m.start() + 1 + x for x in at], len(stack)


def _spans_of(name: str, value: str, at: list[int]) -> list[tuple[int, int]]:
    """Spans, in the outer text, of the credentials in a string value; a value that is JSON itself is entered."""
    if value[:1] in ("{", "[") and len(value) > 1 and _is_json(value):
        return [x for n, v, inner, _ in _strings(value, name) for x in _spans_of(n, v, [at[i] for i in inner])]
    spans = in_text(value)
    if "%" in value:
        plain = unquote(value)
        spans += [(value.find(x), value.find(x) + len(x)) for x in (plain[a:b] for a, b in in_text(plain)) if x in value]
    if sensitive(name) and (span := _under_name(value, name)):
        spans.append(span)
    return [(at[a], at[b]) for a, b in _merged(spans)]


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
        return True
    except RecursionError:
        return True
    except ValueError:
        return False


def in_object(text: str) -> tuple[str | None, list[tuple[int, int]]]:
    """(key, spans of the credentials) of a site object."""
    if not _is_json(text):
        m = re.search(r'"key"\s*:\s*"((?:\\.|[^"\\])*)"', text)
        return (m and m[1]), _merged(in_text(text))
    key, spans = None, []
    for name, value, at, depth in _strings(text):
        if depth == 1 and name == "key":
            key = value
        spans += _spans_of(name, value, at)
    if key is None and text.lstrip().startswith("{"):
        m = re.search(r'"key"\s*:\s*(-?\d+)\b', text)
        key = m and m[1]
    return key, _merged(spans)


def _read(data: bytes) -> tuple[str, str]:
    """A file's text and its encoding."""
    for mark, name in ((b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")):
        if data.startswith(mark):
            return data.decode(name, "replace"), name
    for name in ("utf-8", "gb18030", "big5"):
        try:
            return data.decode(name), name
        except UnicodeDecodeError:
            continue
    return data.decode("latin-1"), "latin-1"


def scan_file(data: bytes) -> list[int]:
    """Numbers of the lines on which a credential starts."""
    code, _ = _read(data)
    return sorted({code.count("\n", 0, a) + 1 for a, _ in in_code(code) if a >= 0})


def _blank(text: str) -> str:
    """Every character but line ends, quotes and what holds literals together becomes a star."""
    return re.sub(r"[^\s'\"\\]", "*", text)


def redact_file(data: bytes) -> bytes:
    """The file with every credential blanked; length, lines and syntax stay."""
    code, encoding = _read(data)
    for a, b in sorted((a if a >= 0 else -a - 1, b) for a, b in in_code(code)):
        body = code[a:b]
        if m := _PRIVATE.match(body):
            # The key's frame stays, so that what it is can still be told.
            end = _PRIVATE_END.search(body)
            stop = end.start() if end else len(body)
            body = body[: m.end()] + re.sub(r"(?<!\\)[A-Za-z0-9+/=]", "*", body[m.end() : stop]) + body[stop:]
        else:
            body = _blank(body)
        code = code[:a] + body + code[b:]
    out = code.encode(encoding)
    return out


def redact_object(text: str) -> str:
    """The object with every credential blanked where it stands; it still loads."""
    if not _object_may_hold(text):
        return text
    for a, b in in_object(text)[1]:
        text = text[:a] + "*" * (b - a) + text[b:]
    return text


def find_credentials(results: DataFrame, hot: int = 200_000) -> DataFrame:
    """(result_id, holder, item, line_no) of every credential in results (result_id, sites, python_files)."""

    receive = ship(results.sparkSession)

    def files(batches):
        receive()
        for b in batches:
            yield pd.DataFrame({"digest": b["digest"], "lines": [scan_file(x) for x in b["data"]]})

    def objects(batches):
        receive()
        for b in batches:
            out = []
            for r, text in zip(b["result_id"], b["text"], strict=True):
                key, secrets = in_object(text) if _object_may_hold(text) else (None, [])
                if secrets:
                    out.append((r, "sites", key, 0))
            yield pd.DataFrame(out, columns=["result_id", "holder", "item", "line_no"])

    every = results.select("result_id", F.explode("python_files").alias("item", "data")).filter("data IS NOT NULL").withColumn("digest", F.sha2("data", 256))
    found = every.select("digest", "data").dropDuplicates(["digest"]).mapInPandas(files, "digest string, lines array<int>").filter("size(lines) > 0")
    rows = every.select("result_id", "item", "digest")
    facts = found.join(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "digest")
    code = attach_group_facts(rows, facts, ["digest"], "n", hot).select("result_id", F.lit("python_files").alias("holder"), "item", F.explode("lines").alias("line_no"))
    sites = results.select("result_id", F.explode("sites").alias("text")).filter("text IS NOT NULL").mapInPandas(objects, "result_id bigint, holder string, item string, line_no int")
    return code.unionByName(sites).dropDuplicates()


def redact(results: DataFrame) -> DataFrame:
    """results with sites and python_files redacted in place; every other column stays as it is."""
    from pyspark.sql import types as T

    receive = ship(results.sparkSession)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def objects(column: pd.Series) -> pd.Series:
        receive()
        return column.map(lambda xs: None if xs is None else [None if x is None else redact_object(x) for x in xs])

    @F.pandas_udf(T.ArrayType(T.BinaryType()))
    def files(column: pd.Series) -> pd.Series:
        receive()
        return column.map(lambda xs: None if xs is None else [None if x is None else once(x) for x in xs])

    known: dict[bytes, bytes] = {}

    def once(data: bytes) -> bytes:
        """Equal files are blanked once in a worker; what is kept is bounded by number and size."""
        digest = hashlib.sha256(data).digest()
        if (out := known.get(digest)) is None:
            out = redact_file(data)
            if len(known) >= 500:
                known.clear()
            if len(data) <= 1 << 16:
                known[digest] = out
        return out

    blanked = F.map_from_arrays(F.map_keys("python_files"), files(F.map_values("python_files")))
    return results.withColumn("sites", objects("sites")).withColumn("python_files", F.when(F.col("python_files").isNotNull(), blanked))
