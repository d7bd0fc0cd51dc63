"""Problem 3: mapping freely written values to a canonical list.

Method: the values are deduplicated, normalised, and looked up in an inverted
index of character n-grams; candidates get a weighted cosine, and the best one
is accepted above a threshold and by a margin over the next.  Acronyms, and the
first letters of names for values cut short, are grams of their own in the same
index.  Only entries that share a gram with the value are looked at.  What names
no entry is reported with id 0.

Only distinct values are scored, so a venue of a third of all rows is scored
once; ids come back by a join on the value, whose hot keys are spread by a salt
that the small side is copied over.  The reference list is fixed; its index goes
to the tasks behind a check of its size, and a larger list is refused.

Defined results: null and white-space values have no row; an empty list maps
everything to 0; ties within the margin go to the name that more rows spell out
in full, then to the smaller id; very long values are scored whole; repeated
ids give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.text import fold

# An event held at a venue, or a paper it hasn't accepted yet, doesn't name the venue.
NOT_NAMED = re.compile(r"\b(workshop|tutorial|satellite event|co-?located)\b|^\W*(submitted to|under review|in preparation|manuscript)\b")
# Usual abbreviations in names of venues.
ABBREVIATIONS = {
    "int": "international", "intl": "international", "intern": "international", "conf": "conference", "j": "journal", "jnl": "journal", "jour": "journal",
    "trans": "transactions", "ann": "annual", "symp": "symposium", "sympos": "symposium", "pac": "pacific", "cong": "congress", "congr": "congress",
    "rev": "review", "let": "letters", "lett": "letters",
}
# Kinds of venue in other languages.
TRANSLATED = [("conférence internationale", "international conference"), ("internationale konferenz", "international conference"), ("国際会議", "international conference "), ("zeitschrift", "journal"), ("revue", "journal")]
STOP = {"of", "on", "the", "for", "in", "and", "at", "proc", "proceedings"}
LEAD = re.compile(r"^\W*(to appear in|accepted (at|to|by|in|for)|presented at|published in)\b\W*")
CUT = re.compile(r"(…|\.\.\.?|\[\s*\.*\s*\]|\[…\])\s*$")
NUMBERED = re.compile(r",?\s*\bvol\b.*$|\s+\d+\s*\(\d+\)\s*$|\b\d+(st|nd|rd|th)\b")
YEAR = re.compile(r"[-,\s]*['’]?\b(19|20)?\d{2}\b")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Acceptance:
    gram: int = 3
    threshold: float = 0.5
    sure: float = 0.85  # below it every word of the name must be found
    margin: float = 0.002
    cut_min: int = 8  # letters a value cut short must keep


def _spell(text: str, vocabulary: dict[str, set[str]]) -> list[str]:
    words = []
    for w in WORD.findall(text.replace("int'l", "intl").replace("'", "")):
        w = ABBREVIATIONS.get(w, w)
        if w in STOP:
            continue
        full = vocabulary.get(w) if len(w) >= 3 else None
        words.append(next(iter(full)) if full and len(full) == 1 else w)
    return words


class VenueIndex:
    """Inverted index of the character n-grams of a list of names and acronyms."""

    def __init__(self, rows: list[tuple[int, str, str]], rule: Acceptance):
        self.rule = rule
        rows = sorted((i, n, a) for i, n, a in rows if n)
        self.ids = [i for i, _, _ in rows]
        marks: dict[str, list[int]] = defaultdict(list)  # grams of their own: an acronym, one in small letters, the first letters of a name
        for k, (_, _, a) in enumerate(rows):
            if a:
                marks[f"={a}"] = [k]
                marks[f"~{a.casefold()}"] = [k]
        prefixes: dict[str, set[str]] = defaultdict(set)
        for _, n, _ in rows:
            for w in WORD.findall(fold(n)):
                for k in range(3, len(w) + 1):
                    prefixes[w[:k]].add(w)
        for w in {w for _, n, _ in rows for w in WORD.findall(fold(n))}:
            prefixes[w] = {w}
        self.vocabulary = dict(prefixes)
        self.names = [" ".join(WORD.findall(fold(n))) for _, n, _ in rows]
        for k, name in enumerate(self.names):
            marks[f"<{name[: rule.cut_min]}"].append(k)
        self.marks = dict(marks)
        self.spelled = spelled = [_spell(fold(n), self.vocabulary) for _, n, _ in rows]
        grams = [Counter(self.grams(" ".join(w))) for w in spelled]
        df = Counter(g for c in grams for g in c)
        n = max(1, len(rows))
        self.idf = {g: math.log(1 + n / d) for g, d in df.items()}
        self.unseen = math.log(1 + n / 0.5)
        self.postings: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for k, c in enumerate(grams):
            norm = math.sqrt(sum((m * self.idf[g]) ** 2 for g, m in c.items())) or 1.0
            for g, m in c.items():
                lists[g].append((k, m * self.idf[g] / norm))
        for g, entries in lists.items():
            self.postings[g] = (np.array([k for k, _ in entries], np.int32), np.array([x for _, x in entries]))

    @property
    def nbytes(self) -> int:
        return sum(64 + len(g) * 4 + a.nbytes + b.nbytes for g, (a, b) in self.postings.items()) + sum(64 + len(g) * 4 + 8 * len(x) for g, x in self.marks.items())

    def grams(self, text: str) -> list[str]:
        g = self.rule.gram
        return [x for w in text.split() for x in ((f"^{w}$"[k : k + g]) for k in range(max(1, len(w) + 3 - g)))]

    def _words_found(self, words: list[str], entry: int) -> bool:
        """Exact check of a doubtful candidate: each word of the name stands in the value, give or take a slip or an abbreviation."""

        def close(want: str, have: str) -> bool:
            if len(have) >= 3 and want.startswith(have) or len(have) >= 4 and SequenceMatcher(None, want[: len(have)], have, autojunk=False).ratio() >= 0.7:
                return True
            return SequenceMatcher(None, want, have, autojunk=False).ratio() >= 0.6

        return all(w in words or any(close(w, h) for h in words) for w in self.spelled[entry])

    def best(self, value: str) -> list[tuple[int, float]]:
        """Entries that a value may name, best first, as (id, score); those that can't be told apart all have the best score."""
        low = fold(value)
        if not low.strip() or not self.ids or NOT_NAMED.search(low):
            return []
        text = LEAD.sub("", low)
        stem = re.sub(r"[\W\d]+$", "", text)
        raw = re.findall(r"[A-Za-z]+", value)
        named = self.marks.get(f"~{stem}", []) if re.fullmatch(r"[a-z]+", stem) else []
        named = named or next((self.marks[f"={w}"] for w in raw if f"={w}" in self.marks), [])
        if named:  # a rare gram that decides by itself
            return [(self.ids[k], 1.0) for k in named]
        cut = CUT.sub("", text)
        is_cut = cut != text
        plain = " ".join(WORD.findall(cut))
        open_end = bool(re.search(r"[a-z]$|\s$", cut))
        if open_end and len(plain) >= self.rule.cut_min:
            # Cut in the middle of a name: it is the start of one name, or of several.
            wanted = plain + (" " if cut.endswith(" ") and not is_cut else "")
            longer = [k for k in self.marks.get(f"<{plain[: self.rule.cut_min]}", []) if self.names[k].startswith(wanted.rstrip()) and self.names[k] != plain]
            if longer and plain not in self.names:
                return [(self.ids[k], 0.99) for k in longer]
        text = NUMBERED.sub(" ", cut)
        text = re.sub(r"\([^()]*\)|\[[^\[\]]*\]", " ", text) if not re.fullmatch(r"\W*[(\[].*[)\]]\W*", text) else text
        dated = re.search(r"^(.*?),\s*[^\W\d_]+,\s*(19|20)\d{2}\s*$", text)
        if dated:
            text = dated[1]
        text = YEAR.sub(" ", text)
        for foreign, kind in TRANSLATED:
            if foreign in text:
                text = text.replace(foreign, kind)
        turned = re.fullmatch(r"\s*([^,]+),\s*([^,]+?)\s*", text)
        if turned:
            text = f"{turned[2]} {turned[1]}"
        counts = Counter(self.grams(" ".join(_spell(text, self.vocabulary))))
        if not counts:
            return []
        at, parts, norm = [], [], 0.0
        for g, m in counts.items():
            weight = m * self.idf.get(g, self.unseen * 0.6)
            norm += weight * weight
            if g in self.postings:
                entries, w = self.postings[g]
                at.append(entries)
                parts.append(weight * w)
        if not at:
            return []
        # Only entries that share a gram are scored.
        met, where = np.unique(np.concatenate(at), return_inverse=True)
        scores = np.bincount(where, weights=np.concatenate(parts)) / math.sqrt(norm)
        words = _spell(text, self.vocabulary)
        near = [(float(scores[i]), int(met[i])) for i in np.argsort(-scores, kind="stable") if scores[i] >= self.rule.threshold]
        order: list[tuple[float, int]] = []
        for score, k in near:
            if order and score < order[0][0] - self.rule.margin:
                break
            if score >= 0.97 or self._words_found(words, k):
                order.append((score, k))
        order = order or [(score, k) for score, k in near if score >= self.rule.sure]
        return [(self.ids[k], score) for score, k in order if score >= order[0][0] - self.rule.margin]


def map_values(records: DataFrame, reference: DataFrame, id_col: str, value_col: str, ref_id: str, ref_name: str, ref_acronym: str, rule: Acceptance = Acceptance(), salts: int = 32, max_index_mb: int = 64) -> DataFrame:
    """(id, ref_id, score) of every record whose value holds more than white space; 0 names no entry."""
    spark = records.sparkSession
    listed = [(int(r[0]), r[1], r[2]) for r in reference.select(F.col(ref_id).cast("long"), F.col(ref_name), F.col(ref_acronym)).where(F.col(ref_id).isNotNull()).distinct().collect()]
    index = VenueIndex(listed, rule)
    if index.nbytes > max_index_mb << 20:
        raise ValueError(f"the reference list is over {max_index_mb} MB as an index; map it in parts and keep the best score")
    held = spark.sparkContext.broadcast(index)

    values = records.select(F.col(id_col).cast("long").alias("id"), F.col(value_col).alias("value")).where(F.col("value").rlike(r"(?U)\S"))
    # Scoring is the costly step: a fixed number of partitions, by turns, keeps it spread; by value it would be merged with the grouping.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = values.groupBy("value").agg(F.count("*").alias("n")).repartition(tasks)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, n = batch.column("value").to_pylist(), batch.column("n").to_pylist()
            found = [held.value.best(x) for x in v]
            kinds = pa.list_(pa.struct([("ref", pa.int64()), ("score", pa.float64())]))
            exact = [f[0][0] if len(f) == 1 and f[0][1] > 0.95 else 0 for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.string()), pa.array(n, pa.int64()), pa.array(exact, pa.int64()), pa.array([[{"ref": i, "score": s} for i, s in f] for f in found], kinds)],
                names=["value", "n", "sure", "found"],
            )

    from bibweave.session import cut_lineage

    scored = cut_lineage(distinct.mapInArrow(score, "value string, n long, sure long, found array<struct<ref:long,score:double>>"))
    # Values that could be several names go to the one that more rows spell out.
    weight = {r["sure"]: r["n"] for r in scored.where("sure > 0").groupBy("sure").agg(F.sum("n").alias("n")).collect()}  # at most a row per listed entry
    rank = F.create_map(*[x for i, n in sorted(weight.items()) for x in (F.lit(i), F.lit(n))]) if weight else F.create_map(F.lit(0), F.lit(0).cast("long"))
    best_score = F.array_max(F.transform("found", lambda f: f["score"]))
    choice = F.array_max(F.transform("found", lambda f: F.struct(F.when(F.size("found") > 1, F.coalesce(F.element_at(rank, f["ref"]), F.lit(0))).otherwise(0).alias("w"), f["score"].alias("s"), (-f["ref"]).alias("neg"))))
    mapped = scored.select("value", F.when(F.size("found") > 0, -choice["neg"]).otherwise(0).alias("ref_id"), F.coalesce(best_score, F.lit(0.0)).alias("score"), "n")
    # Hot values: their rows are spread over salts, and their one line is copied to all of them.
    salted = mapped.withColumn("salt", F.explode(F.when(F.col("n") > 10_000, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(-1)))))
    hot = mapped.where("n > 10000").select("value").withColumn("hot", F.lit(True))  # at most a value per 10 000 rows
    marked = values.join(hot, "value", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).otherwise(-1))
    return marked.join(salted.drop("n"), ["value", "salt"]).select("id", "ref_id", "score")
