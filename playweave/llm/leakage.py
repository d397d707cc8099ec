"""Held-out test items inside training documents (problem 8).

The items become a BM25 inverted index over character n-grams of their letters and digits, with
postings cut into blocks that know their greatest weight. Every document is cut into overlapping passages; each passage
queries the index by block-max WAND and retrieves all items above the threshold. The threshold loses nothing: a leaked
item has at least half of its letters in the passage without a break, hence all n-grams of some window of that length, so
its least possible score is the least sum of weights over its own windows and over the offsets at which they are asked. What is retrieved is then verified exactly.
Documents are never shuffled; the index is broadcast. Its size is bounded by the letters of its items: more items make more indexes, each of
which all documents are asked in a pass of its own. Items too short for whole n-grams have indexes apart, so that one short item slows nothing down.

A passage asks for every STRIDE-th of its n-grams; the thresholds allow for the worst offset, so the items retrieved and verified are the same with a
stride of one, which `stride` gives.

Comparison ignores letter case, character width, whitespace, line breaks and punctuation. Null and empty texts contain
nothing; items without letters or digits are never found. Texts are read whole; repeated rows give one row.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Most letters of the items of one index; each letter takes some 150 bytes in a worker.
MOST_LETTERS = 2_000_000
GRAM = 6
#: Passages are asked about every STRIDE-th of their n-grams.
STRIDE = 4
BLOCK = 16
K1, B = 1.2, 0.75
#: Letters of one passage; passages overlap by the longest half of an item.
PASSAGE = 2048


def letters(text: str) -> str:
    """Letters and digits of a text, width and case folded."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return "".join(filter(str.isalnum, text.casefold()))


class ItemIndex:
    """Block-max BM25 index of the items' n-grams."""

    def __init__(self, items: list[tuple[int, str]], gram: int = GRAM, stride: int = STRIDE):
        self.items = [(i, t) for i, t in ((i, letters(text or "")) for i, text in items) if t]
        # No half of an item is without a gram.
        self.gram = n = max(1, min([gram, *((len(t) + 1) // 2 for _, t in self.items)]))
        self.half = [(len(t) + 1) // 2 for _, t in self.items]
        self.overlap = max(self.half, default=0)
        grams = [[t[k : k + n] for k in range(len(t) - n + 1)] for _, t in self.items]
        df = Counter(g for own in grams for g in set(own))
        mean = sum(map(len, grams)) / max(1, len(grams))
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        # A window of an item meets a passage's n-grams at one of `stride` offsets; the threshold allows for the worst.
        self.stride = max(1, min([stride, *(h - n + 1 for h in self.half)]))
        self.least: list[float] = []
        for k, own in enumerate(grams):
            tf = Counter(own)
            norm = K1 * (1 - B + B * len(own) / mean)
            weight = {g: math.log(1 + (len(grams) - df[g] + 0.5) / (df[g] + 0.5)) * c * (K1 + 1) / (c + norm) for g, c in tf.items()}
            for g, w in weight.items():
                postings[g].append((k, w))
            size = self.half[k] - n + 1
            self.least.append(min(sum(weight[g] for g in set(own[s : s + size - self.stride + 1 : self.stride])) for s in range(len(own) - size + self.stride)) - 1e-6)
        self.postings = dict(postings)
        self.floor = min(self.least, default=math.inf)
        self.blocks = {g: [(p[min(s + BLOCK, len(p)) - 1][0], max(w for _, w in p[s : s + BLOCK])) for s in range(0, len(p), BLOCK)] for g, p in self.postings.items()}
        self.greatest = {g: max(w for _, w in p) for g, p in self.postings.items()}

    def retrieve(self, passage: str) -> list[int]:
        """Numbers of all items whose score reaches their threshold, by block-max WAND."""
        n, postings = self.gram, self.postings
        terms = [g for g in {passage[k : k + n] for k in range(0, len(passage) - n + 1, self.stride)} if g in postings]
        if sum(self.greatest[g] for g in terms) < self.floor:
            return []
        cursors = [[postings[g][0][0], 0, g] for g in terms]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, (item, _, g) in enumerate(cursors):
                bound += self.greatest[g]
                if bound >= self.floor:
                    pivot = item
                    while k + 1 < len(cursors) and cursors[k + 1][0] == pivot:
                        k += 1
                    break
            if pivot is None:
                break
            block_bound, next_item = 0.0, math.inf
            for item, at, g in cursors[: k + 1]:
                b = self.blocks[g]
                j = at // BLOCK
                while j < len(b) and b[j][0] < pivot:
                    j += 1
                if j < len(b):
                    block_bound += b[j][1]
                    next_item = min(next_item, b[j][0] + 1)
            if block_bound < self.floor:
                # No item up to the end of the nearest block, or before the next list, can reach the threshold.
                if k + 1 < len(cursors):
                    next_item = min(next_item, cursors[k + 1][0])
                target = max(pivot + 1, next_item if next_item < math.inf else pivot + 1)
            elif cursors[0][0] == pivot:
                score = sum(postings[g][at][1] for item, at, g in cursors if item == pivot)
                if score >= self.least[pivot]:
                    found.append(pivot)
                target = pivot + 1
            else:
                target = pivot
            for c in cursors[: k + 1]:
                p = postings[c[2]]
                while c[1] < len(p) and p[c[1]][0] < target:
                    c[1] += 1
                c[0] = p[c[1]][0] if c[1] < len(p) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def contains(self, passage: str, k: int) -> bool:
        """The passage holds at least half of item k without a break."""
        text, half = self.items[k][1], self.half[k]
        step = max(1, (half + 1) // 2)
        for s in range(0, len(text) - step + 1, step):
            probe = text[s : s + step]
            at = passage.find(probe)
            while at >= 0:
                left = 0
                while left < s and left < at and text[s - left - 1] == passage[at - left - 1]:
                    left += 1
                right = step
                while s + right < len(text) and at + right < len(passage) and text[s + right] == passage[at + right]:
                    right += 1
                if left + right >= half:
                    return True
                at = passage.find(probe, at + 1)
        return False

    def leaked(self, own: str) -> list[int]:
        """item ids whose wording is in the letters of a text."""
        found: set[int] = set()
        for s in range(0, max(1, len(own)), PASSAGE):
            passage = own[s : s + PASSAGE + self.overlap]
            found.update(k for k in self.retrieve(passage) if k not in found and self.contains(passage, k))
        return [self.items[k][0] for k in found]


def indexes(items: list[tuple[int, str]], gram: int = GRAM, stride: int = STRIDE) -> list[ItemIndex]:
    """Indexes of items, one for each n-gram size and stride that their lengths allow: most have one in common, a few short ones have others."""
    by: dict[tuple[int, int], list[tuple[int, str]]] = defaultdict(list)
    for i, text in items:
        if n := len(letters(text or "")):
            g = min(gram, half := (n + 1) // 2)
            by[g, min(stride, half - g + 1)].append((i, text))
    return [ItemIndex(own, g, s) for (g, s), own in sorted(by.items())]


def item_blocks(items: DataFrame, most_letters: int):
    """Lists of (item_id, text), each of at most so many letters, or of one longer item."""
    block: list[tuple[int, str]] = []
    held = 0
    for r in items.select("item_id", "text").filter("text IS NOT NULL").dropDuplicates().toLocalIterator():
        if block and held + len(r[1]) > most_letters:
            yield block
            block, held = [], 0
        block.append((r[0], r[1]))
        held += len(r[1])
    yield block


def find_leaks(documents: DataFrame, items: DataFrame, gram: int = GRAM, stride: int = STRIDE, most_letters: int = MOST_LETTERS) -> DataFrame:
    """(doc_id, item_id): the documents (doc_id, text) that hold at least half of an item (item_id, text)."""
    schema = T.StructType([documents.schema["doc_id"], items.schema["item_id"]])

    def one_pass(block: list[tuple[int, str]]) -> DataFrame:
        held = documents.sparkSession.sparkContext.broadcast(indexes(block, gram, stride))

        def run(batches):
            for b in batches:
                out = [(d, i) for d, t in zip(b["doc_id"], b["text"], strict=True) if t for own in [letters(t)] for index in held.value for i in index.leaked(own)]
                yield pd.DataFrame(out, columns=["doc_id", "item_id"])

        return documents.select("doc_id", "text").filter("text IS NOT NULL").mapInPandas(run, schema)

    return reduce(DataFrame.unionByName, map(one_pass, item_blocks(items, most_letters))).dropDuplicates()
