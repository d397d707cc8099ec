"""Addresses fetched in parallel, as a Python data source. The network is only touched when a query runs."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from dataclasses import dataclass, field
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from playweave.functions.urls import requoted

SCHEMA = "source string, status int, content_type string, effective_url string, data binary, error string, via_relay boolean, redirects array<string>, attempts int"


@dataclass
class Answer:
    """What came back for an address; data is null where nothing usable did."""

    status: int | None = None
    content_type: str | None = None
    url: str = ""
    data: bytes | None = None
    error: str | None = None
    via_relay: bool = False
    redirects: list[str] = field(default_factory=list)
    attempts: int = 0


class Redirects(urllib.request.HTTPRedirectHandler):
    """Follows redirects and keeps their addresses."""

    def __init__(self):
        self.seen: list[str] = []

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        self.seen.append(newurl)
        return super().redirect_request(req, fp, code, msg, headers, newurl)


def error_label(error: Exception) -> str:
    """A label of an error without the address it happened at."""
    if isinstance(error, urllib.error.HTTPError):
        return f"HTTP {error.code}"
    if isinstance(error, urllib.error.URLError):
        return f"URLError: {type(error.reason).__name__}"
    return type(error).__name__


def relay_address(url: str, template: str) -> str | None:
    """Address of a url at a relay; null for relays that are not https, carry userinfo, or are the address's own host."""
    parts = urlsplit(template)
    if parts.scheme != "https" or not parts.netloc or parts.username or parts.password or parts.netloc.lower() == urlsplit(url).netloc.lower():
        return None
    encoded = quote(url, safe="")
    return template.replace("{url}", encoded) if "{url}" in template else template + encoded


def attempt(url: str, candidates: list[str], retries: int = 3, timeout: float = 30.0, limit: int = 32 << 20, opener=None, pause: float = 0.0, relay: str = "", agent: str = "okhttp/3.12") -> Answer:
    """First answer of the candidates, each tried `retries` times, at last that of a relay. Never raises, and never names the relay."""
    out = Answer(url=url, error="no candidate")
    at_relay = relay_address(url, relay) if relay else None
    for candidate, tries in [*((c, retries) for c in candidates or [url]), *([(at_relay, 1)] if at_relay else [])]:
        for _ in range(tries):
            out.attempts += 1
            handler = Redirects()
            open_ = opener or urllib.request.build_opener(handler).open
            try:
                with open_(urllib.request.Request(candidate, headers={"User-Agent": agent}), timeout=timeout) as r:
                    data = r.read(limit + 1)
                    out.status, out.content_type, out.redirects, out.via_relay = r.status, r.headers.get("Content-Type"), handler.seen, candidate == at_relay
                    out.url = url if out.via_relay else r.geturl()
                    out.data, out.error = (None, "too large") if len(data) > limit else (data, None)
                    return out
            except Exception as e:  # noqa: BLE001
                out.error = error_label(e)
                if isinstance(e, urllib.error.HTTPError):
                    out.status = e.code
            time.sleep(pause)
    return out


class WebSource(DataSource):
    """spark.read.format("playweave-web").option("urls", "a\\nb").option("mirrors", "https://mirror/\\n...").option("relay", "https://relay/?u={url}").load()"""

    @classmethod
    def name(cls) -> str:
        return "playweave-web"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WebReader(self.options)


class Part(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class WebReader(DataSourceReader):
    def __init__(self, options):
        self.urls = [u for u in options.get("urls", "").split("\n") if u.strip()]
        self.mirrors = [m for m in options.get("mirrors", "").split("\n") if m.strip()]
        self.relay = options.get("relay", "")
        self.retries = int(options.get("retries", "3"))
        self.timeout = float(options.get("timeout", "30"))
        self.width = int(options.get("parallel", "8"))

    def partitions(self):
        return [Part(self.urls[i :: self.width]) for i in range(min(self.width, len(self.urls)))]

    def read(self, partition):
        # Without addresses there is one empty partition.
        for u in partition.urls if partition else []:
            a = attempt(u, [u, *(m + u for m in self.mirrors)], self.retries, self.timeout, relay=self.relay)
            yield (u, a.status, a.content_type, a.url, a.data, a.error, a.via_relay, a.redirects, a.attempts)


#: Agents that a check tries in turn.
AGENTS = ["okhttp/3.12", "Mozilla/5.0", "Lavf/60.3", "VLC/3.0"]
ATTEMPTS = "url string, n int, agent string, http_status int, content_type string, final_url string, detail string, failure_class string, redirects int, body binary"


def check(url: str, agents: list[str] = AGENTS, timeout: float = 15.0, read: int = 64 << 10, opener=None, confirm: float = 1.5, sleep=time.sleep) -> list[tuple]:
    """Recorded attempts of one address (n, agent, status, content type, final address, detail, redirects, body): each agent in turn until one gets an answer
    below 400; where every one was told that the thing is gone, once more after a pause, since single servers of a network may err. Never raises."""
    out: list[tuple] = []
    address = requoted(url)

    def once(agent: str) -> bool:
        handler = Redirects()
        open_ = opener or urllib.request.build_opener(handler).open
        try:
            with open_(urllib.request.Request(address, headers={"User-Agent": agent}), timeout=timeout) as r:
                out.append((len(out) + 1, agent, r.status, r.headers.get("Content-Type"), r.geturl(), "", len(handler.seen), r.read(read)))
                return r.status < 400
        except urllib.error.HTTPError as e:
            out.append((len(out) + 1, agent, e.code, None, url, f"HTTP {e.code}", len(handler.seen), None))
        except Exception as e:  # noqa: BLE001
            out.append((len(out) + 1, agent, None, None, url, str(getattr(e, "reason", e)) or type(e).__name__, len(handler.seen), None))
        return False

    if not any(once(a) for a in agents) and all(x[2] in (404, 410) for x in out):
        sleep(confirm)
        once(agents[0])
    return out


def attempts(items: DataFrame, agents: list[str] = AGENTS, timeout: float = 15.0, opener=None) -> DataFrame:
    """Attempts at the distinct addresses (url) of a table, made in its partitions; `health.attempts_verdict` sums them up."""

    def run(batches):
        for b in batches:
            rows = [(u, n, a, s, t, f, d, "", r, body) for u in b["url"] for n, a, s, t, f, d, r, body in check(u, agents, timeout, opener=opener)]
            yield pd.DataFrame(rows, columns=["url", "n", "agent", "http_status", "content_type", "final_url", "detail", "failure_class", "redirects", "body"]).astype({"http_status": "Int32"})

    return items.select("url").filter("url IS NOT NULL").distinct().mapInPandas(run, ATTEMPTS)
