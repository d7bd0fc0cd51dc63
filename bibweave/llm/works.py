"""What tells whether two bibliographic records describe one work: features, pair checks, classes.

Shared by the matching of sources (problem 4) and of new batches (problem 5).

A title is reduced to its content letters: markup, case, punctuation, small
function words and the labels that aggregators add ("(v2)", "[preprint]", ...)
don't count.  Two titles are the same if their letters are, up to a few slips,
in either order of main title and subtitle; numbers and any longer insertion
("Part II", "Erratum to", "... Revisited") make another work.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibweave.llm.forest import CJK, KEY_BITS, text_key
from bibweave.llm.text import HYPHEN_BREAK, fold, least_rotation
from bibweave.session import cut_lineage, drop_cut

# Labels that aggregators put on titles without meaning another work.
LABEL = re.compile(r"[(\[]\s*(v\d{1,2}|preprint|extended abstract|technical report)\s*[)\]]|[,;:]?\s*\b(technical report|extended abstract)\s*(?=\W*$)")
# Small words that get swapped, added and dropped.
SMALL = set("the a an of for in on with using under and to from given by at de la le les des du et pour à l d en sous der die das und mit auf im bei".split())
_LONG_SMALL = [w for w in SMALL if len(w) >= 4]
_SHORTER = {w[:i] + w[i + 1 :] for w in _LONG_SMALL for i in range(len(w))}.union(_LONG_SMALL)  # what one slip leaves of a small word, or of what it makes of one without the letter that it changed
ROMAN = {"ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x"}
CUT = re.compile(r"(…|\.\.\.|\[\s*\.*\s*\])[\s\W]*$")
PIECE = re.compile(r"[ァ-ヿ]+|[ぁ-ゟ]+|[一-鿿々]+|[^\W_ぁ-ヿ一-鿿々]+")
PLAIN_PIECE = re.compile(r"[a-z0-9]+")
WORD, NO_NAME = re.compile(r"\w"), re.compile(r"[^\w ]")
HYPHENS = "-\u2010\u2011"
BREAK = re.compile("[:|(\\[.,?!;\u2014\u2013\u3002\u3001\\-\u2010\u2011]")  # as text.STRONG_BREAK, whose hyphens stand beside white space
HIRAGANA = re.compile(r"^[ぁ-ゟ]+$")

FEATURES = T.StructType(
    [
        T.StructField("key", T.LongType()),  # the same for titles that are equal but for formatting, labels and small words
        T.StructField("letters", T.StringType()),
        T.StructField("breaks", T.ArrayType(T.IntegerType())),  # letter offsets where a part of the title may begin
        T.StructField("starts", T.ArrayType(T.IntegerType())),  # letter offsets of the words
        T.StructField("marks", T.StringType()),  # numbers, as they tell sequels apart
        T.StructField("cut", T.BooleanType()),
        T.StructField("names_work", T.BooleanType()),  # false for headings such as "Editorial"
        T.StructField("words", T.ArrayType(T.IntegerType())),  # hashes of the long words
        T.StructField("names", T.ArrayType(T.IntegerType())),  # hashes of the surnames, in order
    ]
)


@lru_cache(100_000)
def _small(word: str) -> bool:
    """A small function word, also with a slip in it."""
    if word in SMALL or HIRAGANA.match(word):
        return True
    if len(word) < 3 or len(word) > 7 or not word.isalpha():
        return False
    if len(word) == 3:
        return any(len(w) == 3 and sorted(w) == sorted(word) for w in SMALL)
    if word not in _SHORTER and not any(word[:i] + word[i + 1 :] in _SHORTER for i in range(len(word))):
        return False
    return any(_edits(w, word, 1) <= 1 for w in _LONG_SMALL)


def title_features(title: str | None) -> tuple[str, str, list[int], list[str], str, bool, bool]:
    if title and ("\n" in title or "\r" in title):
        title = HYPHEN_BREAK.sub("", title)
    text = fold(title) if title else ""
    cut = ("…" in text or ".." in text or "]" in text) and bool(CUT.search(text))
    if "(" in text or "[" in text or "technical report" in text or "extended abstract" in text:
        text = LABEL.sub(" ", text)
    # Words between two breaks; no word goes over one.
    piece = PLAIN_PIECE if text.isascii() else PIECE
    tokens: list[str] = []
    breaks: set[int] = set()
    begin = 0
    for m in BREAK.finditer(text):
        if m[0] not in HYPHENS or text[m.start() - 1].isspace() or text[m.end() : m.end() + 1].isspace():
            tokens += [w for w in piece.findall(text, begin, m.start()) if not _small(w)]
            breaks.add(sum(map(len, tokens)))  # letters before
            begin = m.end()
    tokens += [w for w in piece.findall(text, begin) if not _small(w)]
    letters = "".join(tokens)
    start = least_rotation(letters) if letters else 0
    marks = " ".join(sorted([t for t in tokens if t in ROMAN or t.isdigit()]) + ["++"] * ("++" in text))
    sizes = [len(t) for t in tokens]
    words = len(sizes) - sizes.count(1)
    cjk = not letters.isascii() and bool(CJK.search(letters))
    names_work = len(letters) >= (6 if cjk else 16) and (words >= 3 or cjk and words >= 2)
    return letters[start:] + letters[:start], letters, sorted(b for b in breaks if 0 < b < len(letters)), tokens, marks, cut, names_work


@lru_cache(200_000)
def surname(name: str) -> str:
    """Folded surname of any of "First Last", "Last, First", "F. Last", "LAST F"; '' of none."""
    plain = fold(name).strip()
    if not plain.isascii():
        plain = "".join(c for c in unicodedata.normalize("NFD", plain) if not unicodedata.combining(c))
    if not plain or plain.startswith("et al") or not WORD.search(plain):
        return ""
    if "," in plain:
        last = plain.split(",")[0]
    else:
        parts = plain.split()
        long = [p for p in parts if len(p.strip(".")) > 1]
        last = " ".join(long) if len(long) < len(parts) and long else (parts[-1] if len(parts) <= 2 else plain)
    return last if last.isalnum() else NO_NAME.sub("", last).strip()


def surnames(authors) -> list[str]:
    """Distinct folded surnames, in order."""
    return list(dict.fromkeys(x for name in (authors if authors is not None else ()) if name and (x := surname(name))))


@lru_cache(200_000)
def _short(text: str) -> int:
    """A 32-bit hash that is never 0, which stands for no name."""
    return (xxhash.xxh32_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 31)) or 1


def record_features(title: str | None, authors, identified: bool = True) -> tuple:
    """Features of a record; the long words are only needed where an identifier is to be confirmed by them."""
    turned, letters, breaks, tokens, marks, cut, names_work = title_features(title)
    starts = [0, *accumulate(map(len, tokens))][: len(tokens)]
    return text_key(turned), letters, breaks, starts, marks, cut, names_work, [_short(t) for t in tokens if len(t) >= 6] if identified else [], [_short(n) for n in surnames(authors)]


_FEATURE_KINDS = (pa.int64(), pa.string(), None, None, pa.string(), pa.bool_(), pa.bool_(), None, None)  # None: a list of small numbers


def _lists(values: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(values), np.int32, int(ends[-1]))))


@F.arrow_udf(FEATURES)
def _record_features(titles: pa.Array, authors: pa.Array, identified: pa.Array) -> pa.Array:
    columns = list(zip(*map(record_features, titles.to_pylist(), authors.to_pylist(), identified.to_pylist()))) or [()] * len(_FEATURE_KINDS)
    return pa.StructArray.from_arrays([_lists(c) if k is None else pa.array(c, k) for c, k in zip(columns, _FEATURE_KINDS)], names=[f.name for f in FEATURES])


def with_identifiers(records: DataFrame, doi_col: Column, arxiv_col: Column) -> DataFrame:
    """Records with ``ids``: hashes of their distinct identifiers; a DOI of an arXiv deposit counts as its arXiv id.

    A DOI is 10.x/suffix in lower case, whatever stands around it; a suffix without
    a digit, or an all-zero prefix, names no article.  An arXiv id is yymm.nnnnn
    without prefix and version.  Steps are columns of their own, as an expression
    that is used twice would be computed twice.
    """
    raw = F.lower(F.coalesce(doi_col, F.lit("")))
    plain = F.when(raw.contains("%"), F.replace(raw, F.lit("%2f"), F.lit("/"))).otherwise(raw)
    found = F.when(plain.contains("10."), F.regexp_extract(plain, r"(10\.\d{4,9}/\S*[^\s.,;\]])", 1)).otherwise("")
    steps = records.withColumn("_d", found).withColumn("_d", F.when((F.col("_d") != "") & F.col("_d").rlike(r"^10\.(?!0+/)\d+/.*\d"), F.col("_d")).otherwise(""))
    steps = steps.withColumn("_p", F.when(F.contains("_d", F.lit("arxiv.")), F.regexp_extract("_d", r"/arxiv\.(\d{4}\.\d{4,5})", 1)).otherwise(""))
    given = F.coalesce(arxiv_col, F.lit(""))
    number = F.when(given != "", F.regexp_extract(given, r"(?:^|[^\d.])(\d{4}\.\d{4,5})(?:v\d+)?(?:$|[^\d])", 1)).otherwise("")
    steps = steps.withColumn("_a", number).withColumn("_a", F.when(F.col("_a").isin("0000.0000", "0000.00000"), "").otherwise(F.col("_a")))
    key = lambda kind, c: F.xxhash64(F.lit(kind), F.col(c))
    listed = F.array(F.when((F.col("_d") != "") & (F.col("_p") == ""), key("doi", "_d")), F.when(F.col("_p") != "", key("arxiv", "_p")), F.when(F.col("_a") != "", key("arxiv", "_a")))
    return steps.withColumn("ids", F.array_distinct(F.array_compact(listed))).drop("_d", "_p", "_a")


def featurise(records: DataFrame, id_col: str, title: str, authors: str, published: str, doi_col: Column, arxiv_col: Column, *extra: Column) -> DataFrame:
    """(id, node, title features, names, year, ids). Records of one node have the same title, and the same first author if it is cut short."""
    read = records.select(
        F.col(id_col).cast("long").alias("id"), F.col(title).alias("title"), F.col(authors).alias("authors"), F.coalesce(F.col(published).cast("string"), F.lit("")).alias("published"),
        doi_col.alias("doi"), arxiv_col.alias("arxiv_id"), F.struct(F.lit(0).alias("_"), *extra).alias("more"),
    ).where("id IS NOT NULL")
    base = with_identifiers(read, F.col("doi"), F.col("arxiv_id")).select(
        "id", _record_features("title", "authors", F.size("ids") > 0).alias("t"), F.regexp_extract("published", r"((?:19|20)\d\d)", 1).try_cast("int").alias("year"), "ids", "more"
    )
    first = F.coalesce(F.get("t.names", F.lit(0)), F.lit(0))
    node = (
        F.when(~F.col("t.names_work"), F.xxhash64(F.lit("record"), "id"))
        .when(F.col("t.cut"), F.xxhash64(F.lit("cut"), "t.letters", first))
        .otherwise(F.col("t.key"))
    )
    least = F.coalesce(F.array_min("t.names"), F.lit(0))
    return base.select("id", node.alias("node"), "t.*", "year", "ids", first.alias("first"), least.alias("least"), "more.*").drop("key", "_")


TITLE = ("letters", "breaks", "starts", "marks", "cut")


def titles_of(records: DataFrame) -> DataFrame:
    """One row per node that names a work: its title, the years of its records, and its least record as ``least``."""
    number = F.col("id") * 2 + (F.col("source") if "source" in records.columns else F.lit(0))
    titles = F.min_by(F.struct(*TITLE), number).alias("t")
    return records.where("names_work").groupBy("node").agg(titles, F.min("year").alias("from"), F.max("year").alias("to"), F.min(number).alias("least")).select("node", "from", "to", "least", "t.*")


def anchored(records: DataFrame, titles: DataFrame, node: str = "node") -> DataFrame:
    """Titles, under their column ``node``, with each pair of author anchors of their records: the first name, and the least (lists get reordered, and cut at the end)."""
    return records.where("names_work").select("node", "first", "least").distinct().join(titles.select("node", F.col(node).alias("_as"), "letters", "breaks", "cut").hint("shuffle_hash"), "node").withColumn("node", F.col("_as")).drop("_as")


def identified(records: DataFrame) -> DataFrame:
    """(ident, node, names, year, words): a row per record and identifier."""
    return records.where("size(ids) > 0").select(F.explode("ids").alias("ident"), "node", "names", "year", "words")


def identifier_edges(rows: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes whose records (see ``identified``) share an identifier and an author and agree in the year, as stars.

    An author counts whose share of the identifier's records is over a third: of an
    identifier that names a volume each author has little, of one that names a work
    slips in names, reordered lists and wrong entries leave the author most. One that
    was entered wrongly shares no author, or is years away. A record without authors
    joins only where the others of the identifier have one first author, its own
    year, and a long word of its title.
    """
    with_names = F.count_if(F.size("names") > 0)
    sizes = rows.groupBy("ident").agg(with_names.alias("n"), F.count("*").alias("all"), F.min(F.get("names", F.lit(0))).alias("low"), F.max(F.get("names", F.lit(0))).alias("high")).where("all > 1")
    used = cut_lineage(rows.join(sizes, "ident"))  # read in several places below
    named = used.where("size(names) > 0").select("ident", "n", F.explode("names").alias("name"), F.coalesce("year", F.lit(0)).alias("year"), "node")
    hubs = named.groupBy("ident", "name", "year").agg(F.min("node").alias("hub"), F.count("*").alias("c"), F.max("n").alias("n"))
    # As many entries as there are years.
    held = hubs.groupBy("ident", "name").agg(F.sum("c").alias("c"), F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("year", "hub"))).alias("by")).where("3 * c > n")
    stars = named.select("ident", "name", "year", F.col("node").alias("a")).join(hubs.select("ident", "name", "year", F.col("hub").alias("b")), ["ident", "name", "year"])
    stars = stars.join(held.select("ident", "name"), ["ident", "name"], "left_semi").select("a", "b")
    dated = F.expr("filter(by, x -> x.year > 0)")
    between = held.where("size(by) > 1").select(dated.alias("d"), F.expr("filter(by, x -> x.year = 0)").alias("u"))
    years = between.select(F.explode(F.expr("filter(transform(d, (x, i) -> struct(x.hub AS a, get(d, i - 1).hub AS b, coalesce(x.year - get(d, i - 1).year <= 1, false) AS near)), x -> x.near)")).alias("e"))  # neighbouring years are one work
    undated = between.where("size(d) > 0").select(F.explode(F.expr("transform(u, x -> struct(x.hub AS a, get(d, 0).hub AS b, true AS near))")).alias("e"))
    unnamed = used.where("size(names) = 0 AND low = high").select("ident", "year", F.col("node").alias("a"), "words").distinct()
    told = used.where("size(names) > 0").select("ident", "year", F.col("node").alias("b"), F.col("words").alias("words_b")).dropDuplicates(["ident", "year", "b"])
    nameless = unnamed.join(told, ["ident", "year"]).where(F.arrays_overlap("words", "words_b")).groupBy("a", "ident").agg(F.min("b").alias("b")).select("a", "b")
    return stars.union(years.select("e.a", "e.b")).union(undated.select("e.a", "e.b")).union(nameless).where("a <> b").distinct()


def _edits(a: str, b: str, most: int) -> int:
    """Damerau-Levenshtein distance (adjacent swaps count one), or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    i = 0
    n = min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    j = 0
    n = min(len(a), len(b))
    while j < n and a[-1 - j] == b[-1 - j]:
        j += 1
    if j:
        a, b = a[:-j], b[:-j]
    if not a or not b:
        return len(a) + len(b)
    far = most + 1
    before: list[int] = []
    above = list(range(len(b) + 1))
    for x in range(1, len(a) + 1):
        row = [x] + [far] * len(b)
        for y in range(max(1, x - most), min(len(b), x + most) + 1):
            cost = min(above[y - 1] + (a[x - 1] != b[y - 1]), above[y] + 1, row[y - 1] + 1)
            if x > 1 and y > 1 and a[x - 1] == b[y - 2] and a[x - 2] == b[y - 1]:
                cost = min(cost, before[y - 2] + 1)
            row[y] = cost
        if min(row) > most:
            return most + 1
        before, above = above, row
    return min(above[-1], most + 1)


def _bunched(a: str, b: str, slips: int) -> bool:
    """Whether the differences stand so close that a word was changed rather than mistyped."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return slips > 2 and max(len(a), len(b)) - i - j <= 8


SAME, START, GOES_ON = 2, 1, 3


def same_title(a: str, breaks_a: list[int], starts_a: list[int], marks_a: str, cut_a: bool, b: str, breaks_b: list[int], starts_b: list[int], marks_b: str, cut_b: bool) -> tuple[int, str | None]:
    """(2, None): one title; (1, None): one is the start of the other, cut short; (3, rest): one goes on with whole words after the other; (0, None): different titles."""
    if not a or not b:
        return 0, None
    short = min(len(a), len(b))
    cjk = bool(CJK.search(a))
    budget = min(4, short // 14) if not cjk else min(2, max(1, short // 10))
    if marks_a == marks_b and abs(len(a) - len(b)) <= budget:
        for x, y in [(a, b), *((a, b[k:] + b[:k]) for k in breaks_b), *((a[k:] + a[:k], b) for k in breaks_a)]:
            slips = _edits(x, y, budget)
            if slips <= budget and not _bunched(x, y, slips):
                return SAME, None
    if len(a) == len(b):
        return 0, None
    if len(a) > len(b):
        a, cut_a, marks_a, b, breaks_b, starts_b, marks_b = b, cut_b, marks_b, a, breaks_a, starts_a, marks_a
    if len(a) < 12 and not CJK.search(a) or len(a) < 6 or len(a) < 0.35 * len(b):
        return 0, None
    slips = min(2, budget)
    n = len(b)
    for k in (0, *breaks_b):
        turned = b[k:] + b[:k]
        if _edits(a, turned[: len(a)], slips) > slips:
            continue
        if cut_a:
            return START, None
        if marks_a != marks_b and not marks_b.startswith(marks_a):
            continue
        # Without a mark: cut inside a word, or before whole words, which may as well be a sequel's own.
        ends = [len(a)] if turned.startswith(a) else sorted(range(len(a) - slips, min(n - 1, len(a) + slips) + 1), key=lambda e: (_edits(a, turned[:e], slips + 1), abs(e - len(a))))[:1]
        end = ends[0]
        begins = {(x - k) % n for x in starts_b}
        if end in begins:
            return GOES_ON, turned[end:]
        if n - end >= (2 if CJK.search(turned[end:]) else 3) and marks_a == marks_b and (turned.startswith(a) or not begins & {end - 1, end + 1}):
            return START, None
    return 0, None


def _letter_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of each text, how often each of 32 classes of bytes stands in it, and whether it is plain ASCII."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(texts)), sizes)
    counts = np.bincount(row * 32 + (raw & 31), minlength=32 * len(texts)).reshape(-1, 32)
    plain = np.ones(len(texts), bool)
    plain[row[raw > 127]] = False
    return sizes, counts, plain


def plausible(a: pa.Array, b: pa.Array, marks_same: np.ndarray) -> np.ndarray:
    """Which pairs may be more than different titles, by counts of their letters alone: a slip changes two counts at most.

    Titles in other scripts, whose characters take several bytes, always may.
    """
    if not len(a):
        return np.zeros(0, bool)
    (na, ha, pa_), (nb, hb, pb) = _letter_counts(a), _letter_counts(b)
    more, less = np.maximum(ha - hb, 0).sum(axis=1), np.maximum(hb - ha, 0).sum(axis=1)
    short = np.minimum(na, nb)
    budget = np.clip(short // 14, 2, 4)
    same = marks_same & (np.abs(na - nb) <= budget) & (more + less <= 2 * budget)
    start = (na != nb) & (np.where(na < nb, more, less) <= 2) & (short >= 0.35 * np.maximum(na, nb))
    return same | start | ~pa_ | ~pb


# Sixteen classes of bytes, a frequent letter each and the rare ones spread over them: two bits of each in a sketch.
_FREQUENT = [ord(c) & 31 for c in "eiantrosldcumphg"]
LANE = np.array([_FREQUENT.index(c) if c in _FREQUENT else c % 16 for c in range(32)])
LOW, HIGH = 0x55555555, 0xAAAAAAAA


def letter_sketches(texts: pa.Array) -> np.ndarray:
    """32 bits of each text: how often each class of letters stands in it, modulo 4. 0, which tells nothing, of texts in other scripts, and of very long ones, whose lengths aren't told apart."""
    sizes, counts, plain = _letter_counts(texts)
    lanes = counts @ (LANE[:, None] == np.arange(16)) & 3
    return np.where(plain & (sizes < 1_000), lanes @ (np.int64(1) << 2 * np.arange(16, dtype=np.int64)), 0)


def sketched(keys):
    """Rows (k, node, role) of keys, such as ``slip_rows``, with 32 bits of the key and below them the sketch of the node's letters as ``k``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, at = np.unique(batch.column("node").to_numpy(), return_index=True)
            sketch = letter_sketches(batch.column("letters").take(pa.array(at)).cast(pa.string()))
            for rows in keys(iter([batch])):
                own = sketch[np.searchsorted(nodes, rows.column("node").to_numpy())]
                k = rows.column("k").to_numpy() >> np.int64(KEY_BITS - 32) << np.int64(32) | own
                yield pa.RecordBatch.from_arrays([pa.array(k), *rows.columns[1:]], names=rows.schema.names)

    return run


def may_agree(a: str, b: str, na: str, nb: str) -> str:
    """What ``plausible`` asks, of sketched keys that are equal above their sketches, and the lengths, ``a`` no more than 4 letters longer; it drops no pair that ``plausible`` keeps.

    Counts differ modulo 4 by no more than they do. A title with two letters at most
    that the longer one lacks differs from it by 4 letters beside the length; upwards,
    modulo 4, by the length and 4 for each of these two. Short, as a method that the
    compiler finds too long is interpreted.
    """
    apart = f"bit_count(({a} ^ {b}) ^ (shiftright({a} ^ {b}, 1) & {LOW}))"
    up = f"((({b} | {HIGH}) - ({a} & {LOW})) ^ (({b} ^ ~{a}) & {HIGH}))"  # in each two bits, how much more the longer one has
    told = f"{apart} <= greatest(2 * least(4, {na} div 14), 4 + abs({nb} - {na})) AND ({nb} - {na} <= 4 OR bit_count({up} & {LOW}) + 2 * bit_count({up} & {HIGH}) <= {nb} - {na} + 8)"
    return f"({told} OR ({a} & 4294967295) = 0 OR ({b} & 4294967295) = 0)"


LEVEL = T.StructType([T.StructField("level", T.IntegerType()), T.StructField("rest", T.StringType())])


def check_pairs(pairs: DataFrame, titles: DataFrame, *keep: str, by: str = "node") -> DataFrame:
    """(a, b, level, rest) of distinct candidate pairs whose titles agree, as nodes; level as in ``same_title``.

    ``by`` is the column of ``titles`` that the pairs name them by.
    ``titles`` may have a ``root``: pairs that are already in one class aren't compared again.
    """
    known = "root" in titles.columns
    cols = (*TITLE, "root") if known else TITLE
    side = lambda s: titles.select(F.col(by).alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("node", *cols))).hint("shuffle_hash")  # noqa: E731  a title has one row, so the hash tables have no hot key
    joined = pairs.join(side("a"), "a").join(side("b"), "b").drop("a", "b").withColumnsRenamed({"node_a": "a", "node_b": "b"})
    if known:
        joined = joined.where("root_a <> root_b")
    # Lengths that differ by more than slips, and no cut: nothing to compare.
    near = F.abs(F.length("letters_a") - F.length("letters_b")) <= 4
    shorter = F.least(F.length("letters_a"), F.length("letters_b")) >= 0.35 * F.greatest(F.length("letters_a"), F.length("letters_b"))
    joined = joined.where((near & (F.col("marks_a") == F.col("marks_b"))) | shorter)

    @F.arrow_udf(LEVEL)
    def level(la: pa.Array, ba: pa.Array, sa: pa.Array, ma: pa.Array, ca: pa.Array, lb: pa.Array, bb: pa.Array, sb: pa.Array, mb: pa.Array, cb: pa.Array) -> pa.Array:
        la, lb = la.cast(pa.string()), lb.cast(pa.string())
        may = np.flatnonzero(plausible(la, lb, pc.equal(ma, mb).to_numpy(zero_copy_only=False)))
        levels, rests = np.zeros(len(la), np.int32), [None] * len(la)
        few = [c.take(pa.array(may)).to_pylist() for c in (la, ba, sa, ma, ca, lb, bb, sb, mb, cb)]
        for at, *pair in zip(may.tolist(), *few):
            levels[at], rests[at] = same_title(*pair)
        return pa.StructArray.from_arrays([pa.array(levels), pa.array(rests, pa.string())], names=["level", "rest"])

    checked = joined.select("a", "b", *keep, F.length("letters_a").alias("na"), F.length("letters_b").alias("nb"), level(*(f"{c}_{s}" for s in ("a", "b") for c in TITLE)).alias("v"))
    return checked.select("a", "b", *keep, "na", "nb", "v.*").where("level > 0")


def endings(titles: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rest, ended): in how many titles the last words are these wanted ones, of up to four words; whole titles don't count."""
    tails = F.expr("transform(slice(starts, -least(4, size(starts) - 1), 4), s -> substring(letters, s + 1))")
    return titles.where("NOT cut AND size(starts) > 1").select(F.explode(tails).alias("rest")).join(wanted, "rest", "left_semi").groupBy("rest").agg(F.count("*").alias("ended"))


def natural_endings(checked: DataFrame, titles: DataFrame, least: int = 5, share: float = 0.15) -> DataFrame:
    """(rest) of continuations that are plain ends of titles.

    Of the titles that end in "part two" or "ten years later", many stand beside one
    without these words: the words make another work. Of those that end in "large
    cities" hardly any does, and then it was cut short. Counted over all titles; what
    fewer than ``least`` of them end in tells nothing and is taken for another work.
    """
    goes_on = checked.where(F.col("level") == GOES_ON).select("rest", F.when(F.col("na") < F.col("nb"), F.col("a")).otherwise(F.col("b")).alias("base")).distinct()
    bases = cut_lineage(goes_on.groupBy("rest").agg(F.count("*").alias("bases")))  # of known size, so that a small table is sent to the titles
    return bases.join(endings(titles, bases.select("rest")), "rest").where((F.col("ended") >= least) & (F.col("bases") <= share * F.col("ended"))).select("rest")


def union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least node of each class, of all edges of one task."""
    a, b = ([np.empty(0, np.int64)] for _ in range(2))
    for batch in batches:
        a.append(batch.column("a").to_numpy())
        b.append(batch.column("b").to_numpy())
    nodes, at = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    x, y = at[: len(at) // 2], at[len(at) // 2 :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        after = root.copy()
        np.minimum.at(after, root[x], low)
        np.minimum.at(after, root[y], low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], names=["node", "root"])


def components(edges: DataFrame, one_task: int = 2_000_000) -> DataFrame:
    """(node, root) of all nodes that have an edge: least node of each connected class.

    Up to ``one_task`` edges, which take some 100 MB, one task does it; beyond, every
    round takes the least root among neighbours and then jumps along roots, so long
    chains close in logarithmically many rounds, and each round is cut.
    """
    seen = Observation()
    held = cut_lineage(edges.select("a", "b").where("a <> b").observe(seen, F.count(F.lit(1)).alias("n")))
    if seen.get["n"] <= one_task:
        return held.coalesce(1).mapInArrow(union_find, "node long, root long")
    return components_in_rounds(held)


def components_in_rounds(edges: DataFrame) -> DataFrame:
    both = cut_lineage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        # A hub's label is copied to all its neighbours: AQE splits the skewed side of the join, and minima combine before they are shuffled.
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("near"))
        met = labels.join(near, labels.node == near.a).select("node", "root", F.least("root", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        after = cut_lineage(met.join(jump, "next", "left").select("node", F.col("root").alias("old"), F.least("next", F.coalesce("far", "next")).alias("root")))
        drop_cut(labels)
        if not after.where("old <> root").limit(1).count():
            return after.select("node", "root")
        labels = after.select("node", "root")
        labels.cut_path = after.cut_path


def ways(checked: DataFrame, roots: DataFrame, titles: DataFrame) -> DataFrame:
    """Edges (a, b) that attach titles cut short, each class of them to the one class it fits best.

    A title cut short may be the start of several works; it never joins them.
    Classes of titles that are whole are taken first, then those with a record
    of the same year, then the least.  A class that has a whole title isn't
    moved, but for a single title that was cut without a mark.
    """
    starts = checked.where(F.col("level") == START).select(F.when(F.col("na") < F.col("nb"), F.col("a")).otherwise(F.col("b")).alias("s"), F.when(F.col("na") < F.col("nb"), F.col("b")).otherwise(F.col("a")).alias("t"))
    met = starts.select(F.explode(F.array("s", "t")).alias("node")).distinct()
    known = F.col("fixed") if "fixed" in titles.columns else F.lit(False)  # what the class was before this batch
    info = titles.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), known.alias("known"), "cut", "from", "to", F.length("letters").alias("n"))
    several = F.min("node") != F.max("node")
    classes = info.groupBy("root").agg((F.bool_or("known") | (F.bool_or(~F.col("cut")) & several)).alias("fixed"), F.bool_and("cut").alias("cuts"), F.max("n").alias("most"), F.min("from").alias("from"), F.max("to").alias("to"))
    placed = cut_lineage(info.select("node", "root").join(met, "node", "left_semi").join(classes, "root"))
    s, t = (placed.select(F.col("node").alias(x), F.struct("root", "fixed", "cuts", "most", "from", "to").alias(f"_{x}")) for x in ("s", "t"))
    aimed = starts.join(s, "s").join(t, "t")
    # Towards a fixed class or a longer title only, so that no way comes back.
    free = aimed.where("NOT _s.fixed AND _s.root <> _t.root AND (_t.fixed OR _s.most < _t.most)")
    apart = ~F.coalesce((F.col("_s.from") <= F.col("_t.to")) & (F.col("_t.from") <= F.col("_s.to")), F.lit(False))
    best = free.groupBy(F.col("_s.root").alias("a")).agg(F.min(F.struct(F.col("_t.cuts").alias("c"), apart.alias("y"), F.col("_t.root").alias("r"))).alias("w"))
    return best.select("a", F.col("w.r").alias("b"))
