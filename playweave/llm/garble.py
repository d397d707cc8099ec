"""Text that was decoded with the wrong character encoding: finding it and restoring it (problem 4).

A code-page swap is a substitution cipher whose units are the byte groups of one character. Which ciphers a source
suffered, and what their units stand for, are latent and learned by expectation-maximization against the bigrams of text
that is in order:

* language model: character bigrams of the columns that are derived from decoded text (keys, cleaned group labels,
  quality labels), counted over all rows and hashed into a table of fixed size (the proven bound of what is collected);
* tables of known pages: the pairs of WRITTEN and READ give tables to start from, since they show how bytes of several
  characters are grouped into units. A table of one-character units is applied by translate(); units of several
  characters are regrouped into bytes and read again, which is the same substitution on longer units;
* tables learned from nothing but the text (`decipher`): words that neither the language nor a known table explains are
  reduced, for each source, to counts of neighbouring units. Expectation-maximization over these counts learns which
  letter each unit stands for: the hidden letters follow the language's bigrams, each letter emits units. It starts from
  the nearest pairs of single-byte pages and from the units' ranks, and the most likely end wins. A table that explains the source's words far better than they stand becomes one more
  hypothesis of that source. Where it agrees with a pair of pages, that pair restores the letter case too; where it
  agrees with none, its texts are found and given back as null, since their exact form is lost;
* E step: each distinct text of a source is weighed under each table: the bigram likelihood of the restored text, times
  the table's probability in the source. A further hypothesis says that information was lost: the text carries
  marks of damage (replacement, control, private-use or unassigned characters). M step: expected numbers of texts give the new
  probabilities. The likelihoods are computed once and written down; the steps are repeated until they settle.

`mapping()` returns the learned unit-to-letter table. A word in order may stand in a spoiled text at no cost, so it counts for a
table or not at all, and not for one that leaves no letter or digit of it.

Texts that are equal but for runs of digits and for characters that show nothing and that no single- or double-byte page can
produce are weighed once. What is found among them, a small share, goes back to the rows by a join that no popular text unbalances.

Nulls, empty, blank and pure ASCII texts are never garbled. Texts are taken whole, whatever their length. Equal texts
get equal results within a source. A restored text is null where nothing is garbled or something was lost.
"""

from __future__ import annotations

import codecs
import encodings.aliases
import math
import re
import unicodedata
import uuid
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playweave.common import is_blank, letters_digits, materialize, small_rows
from playweave.llm.lookalike import reshaped
from playweave.operators.skew import attach_group_facts

#: Encodings that text is written in, and those it may wrongly be read in. latin is Windows-1252 with Latin-1's controls.
WRITTEN = ["utf-8", "gb18030", "big5", "cp932", "euc_jp", "cp949", "cp1251", "koi8_r", "cp866", "latin", "mac_roman"]
READ = ["latin", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp866", "gb18030", "big5", "cp949", "cp932"]
#: One more swap: UTF-8 read as Latin-1 twice.
TWICE = "utf-8>latin>latin"
#: The 27 characters of Windows-1252 outside Latin-1, with their bytes.
CP1252 = {bytes([b]).decode("cp1252"): b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
CHARACTER = {b: c for c, b in CP1252.items()}
UNIGRAM_CELLS, BIGRAM_CELLS = 1 << 16, 1 << 18
#: Log odds by which a swap must beat the text as it stands.
MARGIN = 1.0
#: Log probability of a damaged character under the hypothesis that information was lost.
DAMAGED = -1.0
#: A word is no text of the language if it is less likely than characters drawn evenly from so many: those of single-byte pages, those of East Asian pages.
NOISE, NOISE_EAST = math.log(256), math.log(1 << 14)
SOURCE_CELLS = 4096
PRIOR = 0.04

_TO_LATIN = str.maketrans({c: chr(b) for c, b in CP1252.items()})
_INVISIBLE = re.compile("[­͏ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿]")
_ENCLOSED = re.compile("[①-⓿㈀-㏿⒈-⒛]")
_CONFUSABLE = re.compile("[Ͱ-Ͽἀ-῿Ѐ-ԯµ\U0001d400-\U0001d7ff]")
_SPLIT = re.compile("([ \\-|/\u2000-\u200a\u202f\u205f]+)")
DIGITS = "[0-9]{2,}"
#: What shows nothing and cannot come from a page of one or two bytes.
UNSEEN = "[\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]"
_DIGITS, _UNSEEN = re.compile(DIGITS), re.compile(UNSEEN)
#: Columns whose texts may be garbled, and those of them that problem 4 reports.
TEXTS, REPORTED = ("name", "group_raw", "source_section", "group_name"), ("name", "group_raw")
#: Narrow and wide Latin letters side by side: what two-byte pages make of an accent between letters, never a word.
_MIXED_WIDTH = re.compile("[A-Za-z][Ａ-Ｚａ-ｚ]|[Ａ-Ｚａ-ｚ][A-Za-z]")
_DAMAGE = re.compile("[\x80-\x9f�-\U000f0000-\U0010ffff]")


def _keep_raw(e: UnicodeError):
    """Undecodable bytes stay visible as damage."""
    if isinstance(e, UnicodeDecodeError):
        return "�" * (e.end - e.start), e.end
    raise e


codecs.register_error("playweave-raw", _keep_raw)


@lru_cache(maxsize=1 << 16)
def _bytes_of(ch: str, read: str) -> bytes | None:
    """The byte or bytes that the wrong reader turned into this character."""
    try:
        if read == "latin":
            return ch.translate(_TO_LATIN).encode("latin-1")
        return ch.encode(read)
    except UnicodeError:
        return None


def _runs(text: str, read: str) -> list[str | bytes] | None:
    """text cut into what the wrong reader may have produced, as bytes, and the rest, as it stands; null if nothing beyond ASCII is the reader's."""
    try:
        whole = (text.translate(_TO_LATIN) if read == "latin" else text).encode("latin-1" if read == "latin" else read)
        return [whole] if read != "gb18030" or len(whole) < 4 * len(text) else None
    except UnicodeError:
        pass
    out: list[str | bytes] = []
    run, beyond = bytearray(), False
    for ch in text:
        b = _bytes_of(ch, read)
        if b is None:
            if run:
                out.append(bytes(run))
                run = bytearray()
            out.append(ch)
        else:
            run += b
            beyond = beyond or ch > "\x7f"
    if run:
        out.append(bytes(run))
    return out if beyond else None


def _decode(run: bytes, written: str) -> str | None:
    if run.isascii():
        return run.decode("ascii")
    try:
        return run.decode("cp1252" if written == "latin" else written)
    except UnicodeDecodeError:
        if written == "latin":
            return run.decode("latin-1")
        if written in ("cp1251", "koi8_r", "cp866", "mac_roman"):
            return None
        text = run.decode(written, "playweave-raw")
        return text if text.count("�") * 3 <= len(run) else None


def _undo(runs: list[str | bytes], written: str) -> str | None:
    """The text as it was before, or null if the swap does not fit. What the wrong reader cannot produce stays as it is."""
    if len(runs) == 1:
        return _decode(runs[0], written) if isinstance(runs[0], bytes) else runs[0]
    out = []
    for run in runs:
        piece = _decode(run, written) if isinstance(run, bytes) else run
        if piece is None:
            return None
        out.append(piece)
    return "".join(out)


SWAPS: list[tuple[str, str]] = [(w, r) for r in READ for w in WRITTEN if w != r]
NUMBER = {x: i for i, x in enumerate(SWAPS, 3)}
NAMES = ["none", "lost", TWICE, *(f"{w}>{r}" for w, r in SWAPS), "learned"]
LEARNED = len(NAMES) - 1
SINGLE_BYTE = {"latin", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp866"}


def page(name: str) -> dict[int, str]:
    """Byte -> character of the upper half of a single-byte page."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[b] = bytes([b]).decode("cp1252" if name == "latin" else name)
        except UnicodeDecodeError:
            if name == "latin":
                out[b] = chr(b)
    return out


def substitution(written: dict[int, str], read: dict[int, str]) -> dict[int, str]:
    """A translate() table from what was read to what was written; a byte that nobody writes becomes U+FFFD."""
    return {ord(ch): written.get(b, "\ufffd") for b, ch in read.items()}


TABLES = {NUMBER[w, r]: substitution(page(w), page(r)) for w, r in SWAPS if w in SINGLE_BYTE and r in SINGLE_BYTE}


@lru_cache(maxsize=1)
def single_byte_pages() -> dict[str, dict[int, str]]:
    """Every single-byte page of the standard library that leaves ASCII as it is and has letters in its upper half."""
    out = {}
    for name in sorted(set(encodings.aliases.aliases.values())):
        try:
            if bytes(range(32, 127)).decode(name) != bytes(range(32, 127)).decode("ascii"):
                continue
            upper = page(name)
        except (LookupError, UnicodeError, ValueError):
            continue
        if sum(len(c) == 1 and c.isalpha() for c in upper.values()) >= 40:
            out[name] = upper
    return out


def normal(text: str) -> str:
    """The text as it is weighed: runs of digits alike, without characters that show nothing and that no page produces."""
    return _DIGITS.sub("00", _UNSEEN.sub("", text))


def normal_form(text: Column) -> Column:
    """`normal` of a column, in the JVM."""
    return F.regexp_replace(F.regexp_replace(text, UNSEEN, ""), DIGITS, "00")


@lru_cache(maxsize=1 << 17)
def _fold(ch: str) -> str:
    """A character as it is counted: digits alike; ASCII punctuation, blanks and emoji as a blank."""
    if ch.isdigit():
        return "0"
    o = ord(ch)
    if ch.isalpha():
        return ch
    emoji = o >= 0x1F000 or 0x2600 <= o <= 0x27BF or o in (0x25B6, 0x25C0, 0x2B50, 0x2B55, 0x23E9, 0x23F0)
    known_mark = ch in "·「」『』【】《》（）()、。：；，！？…—–★☆‐"
    return " " if o < 128 or emoji or known_mark or ch.isspace() else ch


def _variants(word: str) -> list[str]:
    """A word and the words it may be a disguise of (problem 2), which is no garbling."""
    if not _CONFUSABLE.search(word):
        return [word]
    wide = unicodedata.normalize("NFKC", word)
    return list(dict.fromkeys([word, reshaped(wide, "LATIN"), reshaped(wide, "CYRILLIC"), reshaped(wide, "GREEK")]))


def folded(text: str) -> str:
    """The form whose bigrams are counted: compatibility forms and case folded, invisible characters cut, digits alike."""
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", _ENCLOSED.sub("□", text)))
    return "".join(map(_fold, text.lower()))


def _cell(a: str, b: str) -> int:
    return (ord(a) * 40503 + ord(b)) % BIGRAM_CELLS


def _count(batches):
    cells: dict[tuple[int, int], int] = defaultdict(int)
    for b in batches:
        for text in b["text"]:
            t = f" {folded(text)} "
            for x in t:
                cells[0, ord(x) % UNIGRAM_CELLS] += 1
            for x, y in zip(t, t[1:], strict=False):
                cells[1, _cell(x, y)] += 1
    yield pd.DataFrame([(k, c, n) for (k, c), n in cells.items()], columns=["kind", "cell", "n"])


_ODDS: dict[str, dict] = {}


def _cache_of(token: str) -> dict:
    """What this process knows of words under a language; it outlives a task, and is held for one language at a time."""
    if token not in _ODDS:
        _ODDS.clear()
        _ODDS[token] = {}
    return _ODDS[token]


class Rare(dict):
    """Whether the language has never seen a character in any form; marks that may join with a letter are not looked at."""

    def __init__(self, unigrams: dict[int, int]):
        self.unigrams = unigrams

    def __missing__(self, ch: str) -> bool:
        form = folded(ch)
        out = self[ch] = form != " " and not unicodedata.category(ch).startswith("M") and any(ord(x) % UNIGRAM_CELLS not in self.unigrams for x in form)
        return out

    def __reduce__(self):
        return Rare, (self.unigrams,)


class Language:
    """Smoothed character bigrams."""

    def __init__(self, unigrams: dict[int, int], bigrams: dict[int, int]):
        self.unigrams, self.bigrams = unigrams, bigrams
        self.total = sum(unigrams.values()) + 1
        self.steps: dict[str, float] = {}
        self.rare = Rare(unigrams)
        self.unseen = math.log(0.05 / (self.total + 60_000))
        self.token = uuid.uuid4().hex

    @staticmethod
    def fit(texts: DataFrame) -> Language:
        """From a table of one column `text`, over all its distinct values. At most UNIGRAM_CELLS + BIGRAM_CELLS rows are collected."""
        counts = texts.filter("text IS NOT NULL").distinct().mapInPandas(_count, "kind int, cell int, n bigint").groupBy("kind", "cell").agg(F.sum("n").alias("n"))
        both: tuple[dict, dict] = ({}, {})
        pdf = counts.toPandas()
        for kind, cell, n in zip(pdf["kind"], pdf["cell"], pdf["n"], strict=True):
            both[kind][int(cell)] = int(n)
        return Language(*both)

    def __getstate__(self):
        return self.__dict__ | {"steps": {}, "rare": Rare(self.unigrams)}

    def known(self, t: str) -> bool:
        """Every bigram of letters of a folded text, and every letter beside a digit or blank, occurs in the model."""
        bi, uni = self.bigrams, self.unigrams
        for x, y in zip(t, t[1:], strict=False):
            if y > "\x7f" or x > "\x7f":
                if x in " 0":
                    if ord(y) % UNIGRAM_CELLS not in uni:
                        return False
                elif y not in " 0" and _cell(x, y) not in bi:
                    return False
        return True

    def step(self, pair: str) -> float:
        """Log probability of a character after another. Beside digits and blanks letters are independent."""
        x, y = pair
        base = (self.unigrams.get(ord(y) % UNIGRAM_CELLS, 0) or 0.05 * self.total / (self.total + 60_000)) / self.total
        if x in " 0" or y in " 0":
            out = math.log(base)
        else:
            out = math.log((self.bigrams.get(_cell(x, y), 0) + 3.0 * base) / (self.unigrams.get(ord(x) % UNIGRAM_CELLS, 0) + 3.0))
        if len(self.steps) > 500_000:
            self.steps.clear()
        self.steps[pair] = out
        return out

    def least_cost(self, text: str) -> float:
        """What a text costs at least, by its never seen characters alone."""
        return -self.unseen * sum(map(self.rare.__getitem__, text))

    def log_p(self, t: str, least: float = -math.inf) -> float:
        """Log probability of a folded text; -inf as soon as it is below `least`."""
        out, known = 0.0, self.steps.get
        for i in range(len(t) - 1):
            pair = t[i : i + 2]
            p = known(pair)
            out += self.step(pair) if p is None else p
            if out < least:
                return -math.inf
        return out


class GarbleModel:
    """Language bigrams, the probabilities of the swaps of each source, and the tables learned for each source."""

    def __init__(self, language: Language):
        self.language = language
        self.log_prior: dict[int, dict[int, float]] = {}
        self.flat = {i: math.log(PRIOR / len(NAMES)) for i in range(len(NAMES))} | {0: math.log(1 - PRIOR)}
        #: source cell -> (translate() table, whether it restores exactly)
        self.learned: dict[int, tuple[dict[int, str], bool]] = {}
        self.decided: dict[tuple[int, str], int] = {}
        #: (cell, text, h, n) of the garbled ones among the normal texts of the table that was fitted to; n is their number of uses.
        self.found: DataFrame | None = None
        self.gains: dict[tuple[int, str], float | None] = {}

    def __getstate__(self):
        return self.__dict__ | {"decided": {}, "gains": {}, "found": None}

    def odds(self, word: str) -> tuple[bool, dict[int, float], bool] | None:
        """(may be spared at no cost, known table -> log likelihood against the word as it stands, explained by nothing); null if no table has to be thought of."""
        if word.isascii():
            return None
        cache = _cache_of(self.language.token)
        if (found := cache.get(word, 0)) == 0:
            free, (stands, out) = not _DAMAGE.search(word) and self.language.known(f" {folded(word)} "), self._odds(word)
            alien = stands < -noise(word) and all(stands + x[0] < -noise(x[1]) for x in out.values())
            if free:
                # Marks are counted as blanks, beside which letters are independent: a word that becomes nothing but marks tells nothing.
                out = {h: x for h, x in out.items() if x[0] > 0 and any(map(str.isalnum, x[1]))}
            found = None if free and not out else (free, {h: x[0] for h, x in out.items()}, alien)
            if len(cache) > 200_000:
                cache.clear()
            cache[word] = found
        return found

    def stands(self, word: str) -> float:
        """Log likelihood of a word as it stands, or as what it may be a disguise of."""
        return max(self.language.log_p(f" {folded(v)} ") for v in _variants(word))

    def _odds(self, word: str) -> tuple[float, dict[int, tuple[float, str]]]:
        log_p, least_cost, stands = self.language.log_p, self.language.least_cost, self.stands(word)
        out: dict[int, tuple[float, str]] = {}
        best, seen = stands, {word}
        if marks := len(_DAMAGE.findall(word)) + sum(1 for ch in word if ch > "\u02ff" and unicodedata.category(ch) == "Cn"):
            out[1] = (log_p(f" {folded(_DAMAGE.sub('', word))} ") + marks * DAMAGED - stands, "")

        def try_(h: int, restored: str | None) -> None:
            nonlocal best
            if restored is not None and restored not in seen:
                seen.add(restored)
                if -least_cost(restored) <= best - 12.0 or _MIXED_WIDTH.search(restored):
                    return
                form = folded(restored)
                if form.count(" ") * 2 > len(form) and any(map(str.isalnum, form)):
                    # Letters between marks everywhere are no text; marks alone may be.
                    return
                if (ll := log_p(f" {form} ", best - 12.0)) > best - 12.0:
                    out[h] = (ll - stands, restored)
                    best = max(best, ll)

        for r in READ:
            runs = _runs(word, r)
            whole = runs[0] if runs and len(runs) == 1 and isinstance(runs[0], bytes) else None
            for w in WRITTEN if runs else ():
                if w == r:
                    continue
                h = NUMBER[w, r]
                if (restored := _table(word, h) if h in TABLES else _decode(whole, w) if whole is not None else _undo(runs, w)) is None:
                    continue
                try_(h, restored)
                if r == "latin" and w == "utf-8" and (twice := _runs(restored, r)):
                    try_(2, _undo(twice, w))
        return stands, out

    def undo(self, word: str, h: int, source: int) -> str:
        """A word as it was before the swap h."""
        if h == LEARNED:
            return word.translate(self.learned[source][0])
        if h in TABLES:
            return _table(word, h) or word
        w, r = ("utf-8", "latin") if h == 2 else SWAPS[h - 3]
        restored = _undo(_runs(word, r) or [word], w) or word
        return (_undo(_runs(restored, r) or [restored], w) or restored) if h == 2 else restored

    def scores(self, text: str, source: int) -> dict[int, float]:
        """Table -> log likelihood ratio of a normal text against the text as it stands; empty if no table explains it.

        A text is judged as a whole, since its source spoiled it in one way, but each of its words may have been spared.
        """
        if text.isascii():
            return {}
        spoiled = [(w, o) for w in _SPLIT.split(text) if (o := self.odds(w)) is not None]
        if source in self.learned:
            spoiled = [(w, (free, o | {LEARNED: gain} if (gain := self.gain(w, source)) is not None and (gain > 0 or not free) else o, alien)) for w, (free, o, alien) in spoiled]
        every = {h for _, (_, o, _) in spoiled for h in o}
        return {h: sum(math.log(0.2 + 0.8 * math.exp(min(o[h], 600.0))) if h in o else 0.0 if free else math.log(0.2) for _, (free, o, _) in spoiled) for h in every}

    def gain(self, word: str, source: int) -> float | None:
        """Log likelihood ratio of a word under its source's learned table; null if the table changes nothing or has no letter for something."""
        if (found := self.gains.get((source, word), self)) is self:
            restored = word.translate(self.learned[source][0])
            found = None if restored == word or "\ufffd" in restored else self.language.log_p(f" {folded(restored)} ") - self.stands(word)
            if len(self.gains) > 200_000:
                self.gains.clear()
            self.gains[source, word] = found
        return found

    def posterior(self, text: str, source: int) -> list[tuple[int, float]]:
        """(hypothesis, probability) of a normal text, the text as it stands first; empty for a text that no table explains."""
        scores = self.scores(text, source)
        if not scores:
            return []
        return _weigh(scores, self.log_prior.get(source, self.flat))

    def hypothesis(self, text: str, source: int) -> int:
        """The table that spoiled a text, or 0."""
        key = (source if source in self.log_prior else -1, normal(text))
        if (found := self.decided.get(key)) is None:
            scores = self.scores(key[1], source)
            found = self.choose(scores, source) if scores else 0
            if len(self.decided) > 200_000:
                self.decided.clear()
            self.decided[key] = found
        return found

    def choose(self, scores: dict[int, float], source: int) -> int:
        """The table that explains a text best, if it does so by a margin; else 0."""
        after = _weigh(scores, self.log_prior.get(source, self.flat))
        h, p = max(after[1:], key=lambda x: x[1])
        return h if p > 0 and math.log(p / max(after[0][1], 1e-300)) >= MARGIN else 0

    def restore(self, text: str, h: int, source: int) -> str | None:
        """The text as it was, null if that is lost."""
        if h == 1 or h == LEARNED and not self.learned[source][1]:
            return None
        words = _SPLIT.split(text)
        for i, w in enumerate(words):
            if not w.isascii():
                weighed = normal(w)
                gain = self.gain(weighed, source) if h == LEARNED else (self.odds(weighed) or (False, {}, False))[1].get(h)
                if gain is not None and gain > 0:
                    words[i] = self.undo(w, h, source)
                    if self.language.log_p(f" {folded(normal(words[i]))} ") < -noise(normal(words[i])):
                        # Likelier than what stands there, but no text either: the true swap is another one.
                        return None
        restored = "".join(words)
        return None if "\ufffd" in restored or _DAMAGE.search(restored) else restored

    def decide(self, text: str, source: int) -> tuple[bool, str | None, str | None]:
        """(is garbled, name of the swap, restored text)."""
        if text.isascii() or not (h := self.hypothesis(text, source)):
            return False, None, None
        return True, NAMES[h], self.restore(text, h, source)


def noise(word: str) -> float:
    """Cost in nats of a word of evenly drawn characters, and a little more: what costs more than that is no text of the language."""
    return 2.0 + sum(NOISE_EAST if ch >= "\u2e80" else NOISE for ch in word) + NOISE


def _weigh(scores: dict[int, float], prior: dict[int, float]) -> list[tuple[int, float]]:
    weights = {0: prior[0]} | {h: prior[h] + v for h, v in scores.items()}
    top = max(weights.values())
    total = sum(math.exp(v - top) for v in weights.values())
    return [(h, math.exp(v - top) / total) for h, v in weights.items()]


def _table(word: str, h: int) -> str | None:
    """A word under a table of one-character units; null if a unit has no letter."""
    restored = word.translate(TABLES[h])
    return None if "\ufffd" in restored else restored


def source_cell(source: Column) -> Column:
    """Sources share probabilities within a fixed number of cells, which bounds what EM collects."""
    return F.pmod(F.xxhash64(source), F.lit(SOURCE_CELLS)).cast("int")


def language_texts(channels: DataFrame) -> DataFrame:
    """Texts of the columns that come from decoded text."""
    cols = [letters_digits(F.col("channel_key")), F.lower("group_name"), F.lower("source_section"), F.lower("quality")]
    return channels.select(F.explode(F.array_distinct(F.array(*cols))).alias("text"))


def texts_of(channels: DataFrame, fields: list[str]) -> DataFrame:
    """(row_id, cell, field_name, text) of the texts that can be garbled at all."""
    entries = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields))
    rows = channels.select("row_id", source_cell(F.col("source")).alias("cell"), F.explode(entries).alias("e")).select("row_id", "cell", "e.*")
    return rows.filter(F.col("text").rlike(r"[^\x00-\x7F]") & ~is_blank(F.col("text")))


#: Learned tables: nats that a table must gain on each neighbouring pair of units, and pairs that it must be learned from.
LEAST_GAIN, LEAST_PAIRS, LEAST_PER_UNIT = 1.0, 60, 8
#: Nats a pair by which a pair of pages may fall short of a learned table and still be taken for it.
NEAR_PAGES = 0.3


def _weigh_all(model: GarbleModel):
    """Of the distinct texts: (cell, text, uses, h, score) of each that some table may explain, (cell, n) of the others, and
    (cell, pair, n), the neighbouring units of words that neither the language nor a known table explains."""

    def run(batches):
        sums: dict[tuple[int, str], int] = defaultdict(int)
        clear: dict[int, int] = defaultdict(int)
        columns = ["cell", "text", "pair", "n", "uses", "h", "score"]
        for b in batches:
            out = []
            for cell, text, uses in zip(b["cell"], b["text"], b["uses"], strict=True):
                if scores := model.scores(text, cell):
                    out.append((cell, text, None, 1, uses, list(scores), list(scores.values())))
                else:
                    clear[cell] += 1
                for word in _SPLIT.split(text):
                    # Single-byte pages have nothing beyond the East Asian marks.
                    odds = None if word.isascii() or max(word) >= "\u3000" or _DAMAGE.search(word) else model.odds(word)
                    if odds is not None and odds[2]:
                        units = " " + "".join(ch.lower() if ch.isascii() else ch for ch in word if ch.isalpha() or not ch.isascii()) + " "
                        for i in range(len(units) - 1):
                            sums[cell, units[i : i + 2]] += 1
            yield pd.DataFrame(out, columns=columns)
        yield pd.DataFrame([(c, None, p, n, None, None, None) for (c, p), n in sums.items()] + [(c, None, None, n, None, [], []) for c, n in clear.items()], columns=columns)

    return run


def decipher(pairs: dict[str, int], language: Language, rounds: int = 40) -> tuple[dict[str, str], float] | None:
    """(unit -> letter, nats gained on each pair): the substitution that makes counts of neighbouring units likely.

    Expectation-maximization of a hidden-letter model: P(x, y) = sum over letters a, b of P(a, b) P(x | a) P(y | b), where
    P(a, b) is the language's and the emissions P(x | a) are learned. ASCII letters and the ends of words stand for themselves.
    """
    units = sorted({ch for p in pairs for ch in p if not ch.isascii()})
    fixed = [" ", *(chr(c) for c in range(97, 123))]
    letters = fixed + [ch for c in sorted(language.unigrams) if 0x80 <= c < 0x3000 and (ch := chr(c)).isalpha()]
    if not units or sum(pairs.values()) < max(LEAST_PAIRS, LEAST_PER_UNIT * len(units)) or len(letters) == len(fixed):
        return None
    number = {ch: i for i, ch in enumerate([*fixed, *units])}
    known = [(p, n) for p, n in pairs.items() if p[0] in number and p[1] in number]
    left, right = (np.array([number[p[k]] for p, _ in known]) for k in (0, 1))
    n = np.array([c for _, c in known], float)
    base = np.array([language.unigrams.get(ord(a), 0) + 0.01 for a in letters])
    base /= base.sum()
    follows = np.exp([[language.step(a + b) for b in letters] for a in letters])
    joint = base[:, None] * follows
    joint /= joint.sum()
    f, m = len(fixed), len(letters) - len(fixed)
    share = np.bincount(np.concatenate([left, right]), np.concatenate([n, n]), len(number))[f:]

    def learn(start: np.ndarray) -> tuple[float, np.ndarray]:
        """From P(letter | unit) to a (log likelihood, expected counts of unit and letter) that no longer rises."""
        emit = np.zeros((len(number), len(letters)))
        emit[:f, :f] = np.eye(f)
        expected, before = start * share[:, None], -math.inf
        for _ in range(rounds):
            emit[f:, f:] = (expected + 1e-6) / (expected + 1e-6).sum(axis=0)
            u, v = emit[left], emit[right]
            after, ahead = v @ joint.T, u @ joint
            z = (u * after).sum(axis=1) + 1e-300
            weight = (n / z)[:, None]
            counts = np.zeros_like(emit)
            np.add.at(counts, left, u * after * weight)
            np.add.at(counts, right, v * ahead * weight)
            expected, likely = counts[f:, f:], float(n @ np.log(z))
            if likely - before < 1e-4 * abs(likely):
                break
            before = likely
        return likely, expected

    def by_pages(table: dict[int, str]) -> np.ndarray:
        start = np.full((len(units), m), 0.1 / m)
        for i, x in enumerate(units):
            if (a := table.get(ord(x), "").lower()) in place:
                start[i, place[a]] += 0.9
        return start

    place = {a: i for i, a in enumerate(letters[f:])}
    ranks = np.full((len(units), m), 0.5 / m)
    for i, x in enumerate(np.argsort(-share, kind="stable")):
        ranks[x, np.argsort(-base[f:], kind="stable")[min(i, m - 1)]] += 0.5
    ends = [learn(start) for start in [*(by_pages(t) for t in nearest_pages(pairs, language)), ranks]]
    _, expected = max(ends, key=lambda x: x[0])
    table = {x: letters[f + int(expected[i].argmax())] for i, x in enumerate(units)}
    return table, _gain(dict(known), {ord(x): a for x, a in table.items()}, language)


def _pairs_of_pages(units: dict[str, int]):
    """(written, read, translate() table) of the single-byte pages whose reader has the units."""
    total = sum(units.values())
    for r, read in single_byte_pages().items():
        if sum(c for x, c in units.items() if x in set(read.values())) >= 0.95 * total:
            for w, written in single_byte_pages().items():
                if w != r:
                    yield w, r, substitution(written, read)


def _units(pairs: dict[str, int]) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for p, n in pairs.items():
        for ch in p:
            if not ch.isascii():
                out[ch] += n
    return out


def nearest_pages(pairs: dict[str, int], language: Language, most: int = 4) -> list[dict[int, str]]:
    """The tables of the page pairs under which the units' counts are likeliest: the places that learning starts from."""
    scored = []
    for k, (_, _, table) in enumerate(_pairs_of_pages(_units(pairs))):
        scored.append((sum(n * language.step(t) for p, n in pairs.items() if len(t := p.translate(table).lower()) == 2), -k, table))
    return [t for _, _, t in sorted(scored, key=lambda x: x[:2], reverse=True)[:most]]


def learn_table(pairs: dict[str, int], language: Language) -> tuple[dict[int, str], bool] | None:
    """(translate() table, whether it restores exactly) of one source, or null if nothing that can be relied on was learned."""
    learned = decipher(pairs, language)
    if learned is None or learned[1] < LEAST_GAIN:
        return None
    for table in nearest_pages(pairs, language, 1):
        if _gain(pairs, table, language) >= learned[1] - NEAR_PAGES:
            return table, True
    return {ord(x): a for x, a in learned[0].items()}, False


def _gain(pairs: dict[str, int], table: dict[int, str], language: Language) -> float:
    """Nats that a translate() table gains on each pair of units."""
    after = [(n, p, t) for p, n in pairs.items() if len(t := p.translate(table).lower()) == 2]
    return sum(n * (language.step(t) - language.step(p.lower())) for n, p, t in after) / max(1, sum(pairs.values()))


def _expect(log_prior: dict[int, dict[int, float]], flat: dict[int, float]):
    def run(batches):
        sums: dict[tuple[int, int], float] = defaultdict(float)
        for b in batches:
            for cell, n, hs, scores in zip(b["cell"], b["n"], b["h"], b["score"], strict=True):  # n is 1 for a text of its own
                for h, p in _weigh(dict(zip(hs, scores, strict=True)), log_prior.get(cell, flat)):
                    if p > 1e-6:
                        sums[cell, int(h)] += p * n
        yield pd.DataFrame([(c, h, p) for (c, h), p in sums.items()], columns=["cell", "h", "p"])

    return run


WEIGHED = "cell int, text string, pair string, n bigint, uses bigint, h array<int>, score array<double>"


def fit(channels: DataFrame, rounds: int = 12, fields: tuple[str, ...] = TEXTS) -> GarbleModel:
    """Learn the language, the tables and their probabilities in each source; rounds=0 leaves out all expectation-maximization.

    What is collected: the hashed bigrams, the tables of at most SOURCE_CELLS sources, and SOURCE_CELLS x len(NAMES) sums.
    The rounds end as soon as less than a thousandth of the texts changes its explanation. Copies of a text are no further
    evidence: each distinct text of a source counts once.
    """
    model = GarbleModel(Language.fit(language_texts(channels)))
    rows = texts_of(channels, list(fields)).select("cell", normal_form(F.col("text")).alias("text")).groupBy("cell", "text").agg(F.count(F.lit(1)).alias("uses"))
    rows = materialize(rows, "garble-texts")
    language = model.language

    def learn(key, pdf: pd.DataFrame) -> pd.DataFrame:
        found = learn_table(dict(zip(pdf["pair"], pdf["n"].astype(int), strict=True)), language)
        return pd.DataFrame([(int(key[0]), x, a, found[1]) for x, a in found[0].items()] if found else [], columns=["cell", "unit", "letter", "exact"])

    weighed = materialize(rows.mapInPandas(_weigh_all(model), WEIGHED), "garble-weighed")
    scores = weighed.filter("pair IS NULL")
    if rounds:
        pairs = weighed.filter("pair IS NOT NULL").groupBy("cell", "pair").agg(F.sum("n").alias("n"))
        for r in pairs.groupBy("cell").applyInPandas(learn, "cell int, unit int, letter string, exact boolean").toLocalIterator():
            model.learned.setdefault(r["cell"], ({}, r["exact"]))[0][r["unit"]] = r["letter"]
        if model.learned:
            # Texts of sources with a table of their own are weighed again, under that table too.
            own = F.col("cell").isin(list(model.learned))
            scores = materialize(scores.filter(~own).unionByName(rows.filter(own).mapInPandas(_weigh_all(model), WEIGHED).filter("pair IS NULL")), "garble-scores")
    before: dict[int, dict[int, float]] = {}
    for _ in range(rounds):
        sums = scores.mapInPandas(_expect(model.log_prior, model.flat), "cell int, h int, p double").groupBy("cell", "h").agg(F.sum("p").alias("p"))
        by: dict[int, dict[int, float]] = defaultdict(dict)
        for r in small_rows(sums, SOURCE_CELLS * len(NAMES)):
            by[r["cell"]][r["h"]] = r["p"]
        for cell, own in by.items():
            # A Dirichlet prior of 50 texts keeps rare swaps possible in small sources.
            total = sum(own.values()) + 50.0
            model.log_prior[cell] = {h: math.log((own.get(h, 0.0) + 50.0 * math.exp(model.flat[h])) / total) for h in range(len(NAMES))}
        moved = sum(abs(p - before.get(c, {}).get(h, 0.0)) for c, own in by.items() for h, p in own.items() if h)
        if moved <= 1e-3 * sum(p for own in by.values() for h, p in own.items() if h):
            break
        before = by

    def choose(batches):
        for b in batches:
            hs = [model.choose(dict(zip(h, score, strict=True)), cell) for cell, h, score in zip(b["cell"], b["h"], b["score"], strict=True)]
            yield pd.DataFrame({"cell": b["cell"], "text": b["text"], "h": hs, "n": b["uses"]})

    found = scores.filter("text IS NOT NULL").mapInPandas(choose, "cell int, text string, h int, n bigint").filter("h > 0")
    model.found = materialize(found.groupBy("cell", "text").agg(F.max("h").alias("h"), F.max("n").alias("n")), "garbled")
    return model


def garbled_rows(channels: DataFrame, model: GarbleModel, fields: tuple[str, ...] = REPORTED) -> DataFrame:
    """(row_id, field_name, cell, text, h) of every garbled text."""
    rows = texts_of(channels, list(fields)).withColumn("_text", normal_form(F.col("text")))
    return attach_group_facts(rows, model.found.withColumnRenamed("text", "_text"), ["cell", "_text"], "n").select("row_id", "field_name", "cell", "text", "h")


def without_garbled(rows: DataFrame, text: str, model: GarbleModel) -> DataFrame:
    """rows (with a column cell) but for those whose text is garbled; null texts stay. ASCII texts don't move."""
    beyond = F.coalesce(F.col(text).rlike(r"[^\x00-\x7F]"), F.lit(False))
    facts = model.found.select("cell", F.col("text").alias("_text"), "n", F.lit(True).alias("_bad"))
    joined = attach_group_facts(rows.filter(beyond).withColumn("_text", normal_form(F.col(text))), facts, ["cell", "_text"], "n", how="left")
    return rows.filter(~beyond).unionByName(joined.filter("_bad IS NULL").select(*rows.columns))


def detect(channels: DataFrame, model: GarbleModel, fields: tuple[str, ...] = REPORTED) -> DataFrame:
    """(row_id, field_name, text, swap, restored) of every garbled text; restored is null where something was lost."""

    def run(batches):
        for b in batches:
            swaps = [NAMES[h] for h in b["h"]]
            restored = [model.restore(text, h, cell) for text, h, cell in zip(b["text"], b["h"], b["cell"], strict=True)]
            yield pd.DataFrame({"row_id": b["row_id"], "field_name": b["field_name"], "text": b["text"], "swap": swaps, "restored": restored})

    return garbled_rows(channels, model, fields).mapInPandas(run, "row_id bigint, field_name string, text string, swap string, restored string")


def mapping(channels: DataFrame, model: GarbleModel) -> DataFrame:
    """(swap, unit, letter, expected): the unit-to-letter table that was learned, as expected counts of each unit's letter in the texts found."""

    def unit_of(h: int, letter: str, text: str) -> str | None:
        """What stands for a letter in a garbled text: bytes beyond Latin-1's letters are read as Windows-1252 or as controls."""
        w, r = ("utf-8", "latin") if h == 2 else SWAPS[h - 3]
        try:
            raw = letter.encode("cp1252" if w == "latin" else w)
            if r != "latin":
                return raw.decode(r)
            for _ in range(h == 2):
                raw = raw.decode("latin-1").encode()
            forms = ("".join(CHARACTER.get(x, chr(x)) for x in raw), raw.decode("latin-1"))
            return next((u for u in forms if u in text), None)
        except UnicodeError:
            return None

    def run(batches):
        sums: dict[tuple[str, str, str], float] = defaultdict(float)
        for b in batches:
            for cell, text in zip(b["cell"], b["text"], strict=True):
                for h, p in model.posterior(normal(text), cell):
                    if h < 2 or p <= 0.01:
                        continue
                    if h == LEARNED:
                        table = model.learned[cell][0]
                        for ch in text:
                            if ord(ch) in table:
                                sums[NAMES[h], ch, table[ord(ch)]] += p
                    else:
                        for letter in model.restore(text, h, cell) or "":
                            if not letter.isascii() and (unit := unit_of(h, letter, text)) is not None:
                                sums[NAMES[h], unit, letter] += p
            if len(sums) > 100_000:
                yield pd.DataFrame([(*k, v) for k, v in sums.items()], columns=["swap", "unit", "letter", "expected"])
                sums.clear()
        yield pd.DataFrame([(*k, v) for k, v in sums.items()], columns=["swap", "unit", "letter", "expected"])

    rows = garbled_rows(channels, model).select("cell", "text")
    return rows.mapInPandas(run, "swap string, unit string, letter string, expected double").groupBy("swap", "unit", "letter").agg(F.sum("expected").alias("expected"))
