"""Problem 7: evaluation texts that leak into training text.

Method: q-gram lemma filtering.  Items and documents are reduced to their words.
For each document the pairs of adjacent words it shares with an item are counted
in overlapping bands of diagonals; by the q-gram lemma a passage within the edit
budget keeps at least a known number of pairs in one band and within its own
length, whatever its words, so only such places are kept, and none that the
check would accept is lost.  The check itself is a longest common subsequence of
each window of the item with the words of that place.

The items are a fixed, held-out set: their index is sent to the tasks only
behind a check of its size, and larger sets are taken in blocks of that size,
each of them against all documents.  Documents are streamed once per block; no
shuffle carries a document.  Stock runs are counted over all items before they
are put into blocks: runs of 10 words in 4 different items, unless they make up
most of an item.

Defined results: null, blank and wordless texts leak nothing; a document leaks
an item once, however often; ids that occur twice give one row; whole texts of
any length are searched; an item of fewer than 15 words is found as a whole, of
fewer than 10 only with all of its words; a stock run with fewer than 6 other
words of the item is no passage; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibweave.llm.text import HYPHEN_BREAK, INVISIBLE

MARKUP = re.compile(r"<[^<>\n]{1,60}>|&(?:#\d+|#x[0-9a-fA-F]+|[A-Za-z]{2,8});|\\[A-Za-z]+\*?")
WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Budget:
    """Words a passage must have, and how many of them may be altered (changed or left out) or added."""

    words: int = 15
    word_edits: int = 3
    band: int = 16
    stock_items: int = 4  # a run that stands in so many different items belongs to none of them
    least: int = 10  # words of a run that could be a passage by itself
    phrase: int = 4  # words of a run that may be a shared phrase
    own: int = 8

    def window(self, length: int) -> tuple[int, int, int]:
        """(words, altered, added): what a passage of an item of ``length`` words must have, and may have."""
        if length >= self.words:
            return self.words, self.word_edits, self.word_edits
        few = length * self.word_edits // self.words
        return length, few if length >= self.least else 0, few

    def threshold(self, length: int) -> int:
        """Pairs of adjacent words that a passage keeps: its matched words lie in at most altered + added + 1 runs."""
        words, altered, added = self.window(length)
        return max(1, words - altered - (altered + added + 1))


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    text = MARKUP.sub(" ", INVISIBLE.sub("", text))
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return WORD.findall(HYPHEN_BREAK.sub("", text).casefold().replace("'", "").replace("’", ""))


class ItemIndex:
    """Sorted word pairs of a block of items, with the places they stand at.

    ``items``: (id, text, places at which a stock run of ``least`` words begins, and one of ``phrase`` words).
    """

    def __init__(self, items: list[tuple[int, str, list[int], list[int]]], budget: Budget):
        self.budget = budget
        self.ids = [i[0] for i in items]
        self.vocabulary: dict[str, int] = {}
        self.words: list[list[int]] = []
        self.stock: list[list[int]] = []  # per item: words of long stock runs before each place
        self.phrases: list[list[bool]] = []
        self.single: dict[int, list[int]] = {}
        codes, owner, place = [], [], []
        for n, (_, text, begins, phrases) in enumerate(items):
            w = [self.vocabulary.setdefault(x, len(self.vocabulary)) for x in words_of(text)]
            common, shared = [0] * len(w), [False] * len(w)
            for k in begins:
                common[k : k + budget.least] = [1] * budget.least
            for k in phrases:
                shared[k : k + budget.phrase] = [True] * budget.phrase
            if 2 * sum(common) > len(w):
                common = [0] * len(w)  # what makes up most of an item is its own text, in however many suites it stands
            self.words.append(w)
            self.phrases.append(shared)
            self.stock.append([0, *np.cumsum(common).tolist()])
            if len(w) == 1:
                self.single.setdefault(w[0], []).append(n)
            v = np.array(w, np.int64)
            codes.append(v[:-1] << 32 | v[1:])
            owner.append(np.full(max(0, len(w) - 1), n, np.int32))
            place.append(np.arange(max(0, len(w) - 1), dtype=np.int32))
        g = np.concatenate(codes) if codes else np.empty(0, np.int64)
        order = np.argsort(g, kind="stable")
        self.unique, self.first, self.count = np.unique(g[order], return_index=True, return_counts=True)
        self.owner = np.concatenate(owner)[order] if owner else np.empty(0, np.int32)
        self.place = np.concatenate(place)[order] if place else np.empty(0, np.int32)
        self.threshold = np.array([budget.threshold(len(w)) for w in self.words], np.int64)
        self.reach = np.array([sum(budget.window(len(w))[::2]) for w in self.words], np.int64)  # words of a text that a passage may take

    @property
    def nbytes(self) -> int:
        arrays = sum(a.nbytes for a in (self.unique, self.first, self.count, self.owner, self.place))
        return arrays + sum(100 + 4 * len(w) for w in self.vocabulary) + sum(80 * len(w) for w in self.words)

    def leaks(self, text: str | None) -> list[int]:
        """Ids of the items of which the text holds a passage."""
        known = self.vocabulary
        words = [known.get(w, -1) for w in words_of(text)]
        found = {self.ids[n] for w in self.single.keys() & set(words) for n in self.single[w]} if self.single else set()
        if len(words) < 2 or not len(self.unique):
            return sorted(found)
        v = np.array(words, np.int64)
        codes = np.where((v[:-1] >= 0) & (v[1:] >= 0), v[:-1] << 32 | v[1:], -1)
        at = np.searchsorted(self.unique, codes)
        at[at == len(self.unique)] = 0
        hit = np.flatnonzero(self.unique[at] == codes)
        if not len(hit):
            return sorted(found)
        n = self.count[at[hit]]
        doc_place = np.repeat(hit, n)
        posting = np.repeat(self.first[at[hit]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner, item_place = self.owner[posting].astype(np.int64), self.place[posting].astype(np.int64)
        often = np.bincount(owner, minlength=len(self.ids)) >= self.threshold
        keep = often[owner]
        doc_place, owner, item_place = doc_place[keep], owner[keep], item_place[keep]
        # Two sets of bands, each half a band from the other: a passage, whose diagonals lie within its altered and added words, is whole in a band of one.
        diagonal = doc_place - item_place + (1 << 20)
        for shift in (0, self.budget.band // 2):
            code = owner * (1 << 40) + (diagonal + shift) // self.budget.band
            order = np.lexsort((doc_place, code))
            c, d, o = code[order], doc_place[order], owner[order]
            last = np.arange(len(order)) + self.threshold[o] - 1
            inside = np.flatnonzero(last < len(order))
            last = last[inside]
            full = (c[last] == c[inside]) & (d[last] - d[inside] < self.reach[o[inside]] - 1)
            begin, end = inside[full], last[full]
            k = 0
            while k < len(begin):
                # Windows that overlap make one region.
                item = int(o[begin[k]])
                lo, hi, low, high = int(d[end[k]]), int(d[begin[k]]), int(begin[k]), int(end[k])
                k += 1
                while k < len(begin) and c[begin[k]] == c[low] and d[begin[k]] <= hi + self.reach[item]:
                    hi, high = int(d[begin[k]]), int(end[k])
                    k += 1
                if self.ids[item] in found:
                    continue
                reach = int(self.reach[item])
                pairs = item_place[order[low : high + 1]]
                if self._verify(words[max(0, lo - reach) : hi + reach], item, pairs):
                    found.add(self.ids[item])
        return sorted(found)

    def _verify(self, doc: list[int], item: int, pairs: np.ndarray) -> bool:
        """Whether the text holds a passage of the item.

        ``pairs``: places of the item's word pairs that the region has; only windows with enough of them can be met.
        A window has all but a few words of the item in order.  As other texts may be made of the same shared phrases,
        the differences must also be single words, or enough of the matched words must stand outside shared phrases.
        """
        w, b = self.words[item], self.budget
        size, altered, added = b.window(len(w))
        seen = np.zeros(len(w), np.int64)
        seen[pairs] = 1
        before = np.concatenate(([0], np.cumsum(seen)))
        stock = self.stock[item]
        near = []
        for at in np.flatnonzero(before[size - 1 : len(w)] - before[: len(w) - size + 1] >= self.threshold[item]).tolist():
            if (stock[at + size] - stock[at] < b.least or size == len(w)) and _in_order(doc, w[at : at + size], altered, size + added):
                if _single_edits(doc, w[at : at + size], altered):
                    return True
                near.append(at)
        if len(w) < b.words:
            return align(doc, w, self.phrases[item])[0] == len(w)
        return bool(near) and align(doc, w, self.phrases[item])[2] >= b.own


def _single_edits(doc: list[int], window: list[int], edits: int) -> bool:
    """Whether the text has the window but for at most ``edits`` single words changed, added or left out, with matched words between them."""
    places: dict[int, list[int]] = {}
    for j, w in enumerate(window):
        places.setdefault(w, []).append(j)
    end = len(window) - 1
    rows: list[dict[int, int]] = [{}, {}]  # of the last two words: place in the window -> least edits of a path that ends there
    far = edits + 1
    for w in doc:
        one, two, here = rows[1], rows[0], {}
        for j in places.get(w, ()):
            start = j if j < 2 else far
            cost = min(start, one.get(j - 1, far), one.get(j - 2, far) + 1, two.get(j - 1, far) + 1, two.get(j - 2, far) + 1)
            if cost <= edits:
                here[j] = cost
                if j >= end - 1 and cost + end - j <= edits:
                    return True
        rows = [one, here]
    return False


def _in_order(doc: list[int], window: list[int], altered: int, reach: int) -> bool:
    """Whether ``reach`` words of a text hold all but ``altered`` words of the window in their order (longest common subsequence, bit-parallel)."""
    masks: dict[int, int] = {}
    for k, w in enumerate(window):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(window)) - 1
    row = [masks.get(w, 0) for w in doc]
    head = (1 << altered + 1) - 1  # the first word that is met
    for start, m in enumerate(row):
        if not m & head:
            continue
        v = full
        for mask in row[start : start + reach]:
            if mask:
                u = v & mask
                v = ((v + u) | (v - u)) & full
        if v.bit_count() <= altered:
            return True
    return False


def align(doc: list[str], item: list[str], stock: list[bool]) -> tuple[int, int, int]:
    """Best local alignment of two word lists: words matched, words of the item spanned, words matched outside stock runs.

    A matching word counts one, a changed, added or missing word minus one; a
    path ends where it would fall below zero.  Only cells near a shared word are
    kept, so the work is that of the band around the passage.
    """
    best = (0, 0, 0, 0)
    places: dict[str, list[int]] = {}
    for j, w in enumerate(item):
        places.setdefault(w, []).append(j)
    above: dict[int, tuple[int, int, int, int]] = {}  # item position -> (score, matched, start in item, own words)
    for w in doc:
        here: dict[int, tuple[int, int, int, int]] = {}
        for j, (s, m, a, o) in above.items():
            if s > 1:
                if here.get(j, (0,))[0] < s - 1:
                    here[j] = (s - 1, m, a, o)  # a word added
                if j + 1 < len(item) and here.get(j + 1, (0,))[0] < s - 1:
                    here[j + 1] = (s - 1, m, a, o)  # a word changed
        for j in places.get(w, ()):
            s, m, a, o = above.get(j - 1, (0, 0, j, 0))
            new = (s + 1, m + 1, a, o + (not stock[j]))
            if here.get(j, (0,))[0] < new[0]:
                here[j] = new
            if new > (best[0], -1, -1, -1) and new[0] > best[0]:
                best = (new[0], new[1], j - a + 1, new[3])
        for j in sorted(here):
            s, m, a, o = here[j]
            if s > 1 and j + 1 < len(item) and here.get(j + 1, (0,))[0] < s - 1:
                here[j + 1] = (s - 1, m, a, o)  # a word left out
        above = here
    return best[1], best[2], best[3]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _words(texts: pd.Series) -> pd.Series:
    return pd.Series([words_of(t) for t in texts], dtype=object)


def stock_places(items: DataFrame, budget: Budget) -> DataFrame:
    """(item_id, long, phrases): where runs of ``least`` and of ``phrase`` words begin that stand in ``stock_items`` different texts."""

    def places(length: int, name: str) -> DataFrame:
        hashes = F.transform(F.sequence(F.lit(1), F.size("w") - (length - 1)), lambda k: F.xxhash64(F.slice("w", k, length)))
        runs = worded.where(F.size("w") >= length).select("item_id", F.xxhash64("w").alias("text"), F.posexplode(hashes).alias("place", "run"))
        shared = runs.select("run", "text").distinct().groupBy("run").count().where(F.col("count") >= budget.stock_items)
        return runs.join(shared, "run", "left_semi").groupBy("item_id").agg(F.collect_list("place").alias(name))

    worded = items.select("item_id", _words("text").alias("w"))
    return places(budget.phrase, "phrases").join(places(budget.least, "long"), "item_id", "full_outer")


def leaked_passages(documents: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str, budget: Budget = Budget(), block: int = 4_000) -> DataFrame:
    """(doc_id, item_id) of every document that holds a passage of an item. Items are taken in blocks of ``block`` of them."""
    spark = documents.sparkSession
    wanted = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["item_id"])
    result: DataFrame | None = None
    rows: list[tuple[int, str, list[int], list[int]]] = []
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")

    def search(held) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                docs, found = [], []
                for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    for i in index.leaks(t):
                        docs.append(d)
                        found.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.int64())], names=["doc_id", "item_id"])

        return texts.mapInArrow(run, "doc_id long, item_id long")

    def flush() -> None:
        nonlocal result, rows
        index = ItemIndex(rows, budget)
        if index.nbytes > 256 << 20:
            raise ValueError("a block of items is over 256 MB; take a smaller block")
        part = search(spark.sparkContext.broadcast(index))
        result = part if result is None else result.unionByName(part)
        rows = []

    marked = wanted.join(stock_places(wanted, budget), "item_id", "left")
    for row in marked.orderBy("item_id").toLocalIterator():  # the evaluation set is the stated query set, block by block
        rows.append((row.item_id, row.text, row.long or [], row.phrases or []))
        if len(rows) == block:
            flush()
    if rows or result is None:
        flush()
    return result.distinct()
