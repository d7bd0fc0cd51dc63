"""Lookups by title and by source priority."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibweave.functions.identity import normalize_title, text
from bibweave.functions.venue import usable
from bibweave.session import cut_lineage


@F.pandas_udf(T.DoubleType())
def title_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two normal titles; 1 if equal, 0 if either is empty. The order of arguments matters."""
    return pd.Series([1.0 if x and x == y else (difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0) for x, y in zip(a, b)])


# A normal title is of blanks, letters and digits; which counts of each the sketch tells apart: the first and how many, about those in which titles differ.
_LETTERS = " abcdefghijklmnopqrstuvwxyz0123456789"
_LEVELS = [(6, 10)] + [{"a": (2, 8), "e": (3, 12), "i": (2, 9), "n": (2, 8), "z": (1, 2), **dict.fromkeys("ost", (1, 10)), "r": (1, 9), "d": (1, 7), **dict.fromkeys("lmpu", (1, 6)), **dict.fromkeys("cgh", (1, 5)), **dict.fromkeys("bfv", (1, 4)), **dict.fromkeys("kwy", (1, 3))}.get(c, (1, 1)) for c in _LETTERS[1:]]
_CLASS = np.repeat(np.arange(len(_LEVELS)), [n for _, n in _LEVELS])
_LEVEL = np.concatenate([np.arange(first, first + n) for first, n in _LEVELS])
_CODE = np.full(256, len(_LETTERS), np.int64)
_CODE[np.frombuffer(_LETTERS.encode(), np.uint8)] = np.arange(len(_LETTERS))
WORDS = 3  # longs of either half of a sketch
# The same for the parts of a title before and after some place, which hold few of each.
_PART = [9] + [{**dict.fromkeys("e", 9), **dict.fromkeys("ainorst", 7), **dict.fromkeys("d", 5), **dict.fromkeys("lumcpg", 4), **dict.fromkeys("hfbv", 3), **dict.fromkeys("kwy", 2)}.get(c, 1) for c in _LETTERS[1:]]
_PART_CLASS = np.repeat(np.arange(len(_PART)), _PART)
_PART_LEVEL = np.concatenate([np.arange(1, 1 + n) for n in _PART])
PART_WORDS = 2
STEP = 4  # letters from one place to the next at which a query's title is parted


def _letters(titles: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each title its length; of each letter of all of them its title's number and its code."""
    sizes = np.array([len(t) for t in titles], np.int64)
    return sizes, np.repeat(np.arange(len(titles)), sizes), _CODE[np.frombuffer("".join(titles).encode(), np.uint8)]


def _counted(at: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at * len(_LETTERS) + codes, minlength=len(_LETTERS) * n).astype(np.int32).reshape(-1, len(_LETTERS))


def _levels(counts: np.ndarray, classes: np.ndarray, levels: np.ndarray, words: int) -> np.ndarray:
    """(rows, words) longs: a bit for each letter and count that it reaches."""
    bits = np.zeros((len(counts), 64 * words), bool)
    np.greater_equal(np.minimum(counts, 255).astype(np.uint8).take(classes, axis=1), levels.astype(np.uint8), out=bits[:, : len(classes)])
    return np.packbits(bits, axis=1).view(np.uint64)


def letter_sketches(titles: list[str]) -> np.ndarray:
    """(titles, WORDS) longs, the half of ``sketches`` that counts letters."""
    _, row, codes = _letters(titles)
    return _levels(_counted(row, codes, len(titles)), _CLASS, _LEVEL, WORDS)


def sketches(titles: list[str]) -> np.ndarray:
    """(titles, 2 * WORDS) longs of normal titles: a bit for each letter and count that it reaches, and one for each pair of adjacent letters."""
    _, row, codes = _letters(titles)
    bits = np.zeros((len(titles), 64 * WORDS), bool)
    inside = row[:-1] == row[1:]
    pair = (codes[:-1] * 64 + codes[1:])[inside].astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(16)
    bits[row[:-1][inside], pair % (64 * WORDS)] = True
    return np.concatenate([letter_sketches(titles), np.packbits(bits, axis=1).view(np.uint64)], axis=1).view(np.int64)


def halves(titles: list[str]) -> np.ndarray:
    """(titles, 2 * PART_WORDS) longs: the letters of either half."""
    sizes, row, codes = _letters(titles)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    counts = _counted(row * 2 + (place >= (sizes // 2)[row]), codes, 2 * len(titles))
    return _levels(counts, _PART_CLASS, _PART_LEVEL, PART_WORDS).reshape(len(titles), -1)


def parts(titles: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, 2 * PART_WORDS) longs: the letters before and after every STEP-th place of each title and its end; where a title's places begin, and how many there are."""
    sizes, row, codes = _letters(titles)
    places = -(-sizes // STEP) + 1
    first = np.cumsum(places) - places
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    each = _counted(first[row] + place // STEP, codes, int(places.sum()))
    before = np.cumsum(each, axis=0, dtype=np.int32) - each
    ends = np.repeat(before[first + places - 1], places, axis=0)  # no letter stands at a title's last place
    after = ends - before
    before -= np.repeat(before[first], places, axis=0)
    return np.concatenate([_levels(x, _PART_CLASS, _PART_LEVEL, PART_WORDS) for x in (before, after)], axis=1), first, places


def _padded(titles: list[str]) -> np.ndarray:
    """(longest, titles) codes of normal titles, padded with a code that no letter has."""
    longest = max(map(len, titles))
    return _CODE[np.frombuffer("".join(t.ljust(longest, "_") for t in titles).encode(), np.uint8)].reshape(len(titles), longest).T


def _masks(titles: list[str]) -> np.ndarray:
    """(words, titles, codes): at which places of each title each letter stands, a bit a place; none for the padding."""
    codes, at = _padded(titles), np.arange(len(titles))
    masks = np.zeros((-(-len(codes) // 64), len(titles), len(_LETTERS) + 1), np.uint64)
    for p, code in enumerate(codes):
        masks[p // 64, at, code] |= np.uint64(1 << p % 64)
    masks[:, :, -1] = 0
    return masks


def common_letters(a: list[str], b: list[str], chunk: int = 2048) -> np.ndarray:
    """Length of the longest common subsequence of each two normal titles, a bit a letter (Hyyrö), pairs of like lengths at once.

    Titles are read once, whatever the number of their pairs.
    """
    first, second = ({t: i for i, t in enumerate(dict.fromkeys(x))} for x in (a, b))
    ia, ib = (np.fromiter((known[t] for t in x), np.int64, len(x)) for known, x in ((first, a), (second, b)))
    return common_at(list(first), list(second), ia, ib, chunk)


def common_at(ta: list[str], tb: list[str], ia: np.ndarray, ib: np.ndarray, chunk: int) -> np.ndarray:
    """``common_letters`` of the titles at places ``ia`` and ``ib`` of two lists."""
    out = np.zeros(len(ia), np.int64)
    sa, sb = (np.fromiter(map(len, t), np.int64, len(t)) for t in (ta, tb))
    words = -(-sb[ib] // 64)
    order = np.lexsort((sa[ia], words))
    alike = np.split(order, np.flatnonzero(np.diff(words[order])) + 1)  # a long title costs no other pair more
    for rows in (group[start : start + chunk] for group in alike for start in range(0, len(group), chunk)):
        ua, ra = np.unique(ia[rows], return_inverse=True)
        ub, rb = np.unique(ib[rows], return_inverse=True)
        codes = _padded([ta[i] for i in ua]).take(ra, axis=1) + rb * (len(_LETTERS) + 1)
        masks = _masks([tb[i] for i in ub]).reshape(-1, len(ub) * (len(_LETTERS) + 1))
        v = np.full((len(masks), len(rows)), ~np.uint64(0))
        for at in codes:
            carry = None
            for w, mask in enumerate(masks):
                held = v[w] & mask.take(at)
                rest = v[w] - held
                total = v[w] + held
                if w + 1 < len(masks):
                    over = total < held
                if carry is not None:
                    total += carry
                    if w + 1 < len(masks):
                        over |= total < carry
                carry = over.astype(np.uint64) if w + 1 < len(masks) else None
                np.bitwise_or(total, rest, out=v[w])
        out[rows] = np.bitwise_count(~v).sum(axis=0, dtype=np.int64)
    return out


# Titles of a block of queries and of candidates, letters of a block (one longer title is a block), parts that queries' blocks are held in at most, and candidates of a part.
QUERIES, CANDIDATES, BLOCK_LETTERS, PARTS, PART = 2048, 16_384, 1 << 19, 48, 65_536
_BLOCK = T.StructType([T.StructField(f, t) for f, t in (("least", T.IntegerType()), ("most", T.IntegerType()), ("numbers", T.BinaryType()), ("titles", T.BinaryType()), ("sketch", T.BinaryType()), ("half", T.BinaryType()))])


def _block(numbers: np.ndarray, titles: list[str], parted: bool) -> dict:
    words = np.ascontiguousarray(letter_sketches(titles).T)
    return {"least": len(titles[0]), "most": len(titles[-1]), "numbers": numbers.tobytes(), "titles": "\n".join(titles).encode(), "sketch": words.tobytes(), "half": halves(titles).tobytes() if parted else b""}


def _blocks(rows: DataFrame, size: int, parted: bool, files: int) -> DataFrame:
    """A row per block of titles (n, t) of like lengths, the shortest first: lengths, numbers, titles and sketches, and those of halves if ``parted``."""

    def packed(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= size:
                table = pa.Table.from_batches(held)
                whole = count - count % size
                yield from cut(table.slice(0, whole))
                rest = table.slice(whole).combine_chunks()
                held, count = rest.to_batches(), rest.num_rows
        if count:
            yield from cut(pa.Table.from_batches(held))

    def cut(table: pa.Table):
        numbers, titles = table.column("n").to_numpy(), table.column("t").to_pylist()
        start = letters = 0
        for i, t in enumerate(titles + [None]):
            if t is None or i - start == size or (i > start and letters + len(t) > BLOCK_LETTERS):
                yield pa.RecordBatch.from_pylist([_block(numbers[start:i], titles[start:i], parted)], schema=pa.schema([("least", pa.int32()), ("most", pa.int32()), *((f, pa.binary()) for f in ("numbers", "titles", "sketch", "half"))]))
                start, letters = i, 0
            letters += len(t) if t is not None else 0

    # Spread by number: each part has titles of all lengths, so parts take alike long.
    return cut_lineage(rows.repartition(files, "n").sortWithinPartitions(F.length("t"), "n").mapInArrow(packed, _BLOCK))


class _Queries:
    """A block of queries, and the best ratio that each has met so far."""

    def __init__(self, numbers: bytes, titles: bytes, sketch: bytes, threshold: float):
        self.numbers, self.titles = np.frombuffer(numbers, np.int64), titles.decode().split("\n")
        self.sketch = np.frombuffer(sketch, np.uint64).reshape(WORDS, -1)
        self.sizes = np.array([len(t) for t in self.titles], np.int64)
        self.parts, self.first, self.places = parts(self.titles)
        self.best = np.full(len(self.titles), threshold)


class _Candidates:
    def __init__(self, numbers: bytes, titles: bytes, sketch: bytes, half: bytes):
        self.numbers, self.titles = np.frombuffer(numbers, np.int64), titles.decode().split("\n")
        self.sketch = np.frombuffer(sketch, np.uint64).reshape(WORDS, -1)
        self.half = np.frombuffer(half, np.uint64).reshape(-1, 2 * PART_WORDS)
        self.sizes = np.array([len(t) for t in self.titles], np.int64)
        self.lengths, start = np.unique(self.sizes, return_index=True)
        self.bounds = np.append(start, len(self.sizes))


def _free(sizes: np.ndarray, best: float | np.ndarray) -> np.ndarray:
    """Letters of two titles, of so many together, that a ratio of ``best`` leaves outside their matching blocks, at most."""
    return np.floor(sizes * (1 - best) + 1e-6).astype(np.int64)


def _letters_near(q: _Queries, c: _Candidates):
    """Places (in q, in c) of the pairs that lengths and counts of letters leave, some queries' at once."""
    x, y = np.empty((WORDS, len(c.sizes)), np.uint64), np.empty((WORDS, len(c.sizes)), np.uint8)
    limits: dict[tuple[int, float], tuple[int, int, np.ndarray]] = {}
    held, count = [], 0
    for i, size in enumerate(q.sizes.tolist()):
        if (key := (size, float(q.best[i]))) not in limits:
            free = _free(c.lengths + size, q.best[i])
            fit = np.flatnonzero(np.abs(c.lengths - size) <= free)
            lo, hi = (fit[0], fit[-1] + 1) if len(fit) else (0, 0)  # one range: the limit grows less than the length
            limits[key] = int(c.bounds[lo]), int(c.bounds[hi]), np.repeat(np.minimum(free[lo:hi], 255).astype(np.uint8), np.diff(c.bounds[lo : hi + 1]))
        lo, hi, limit = limits[key]
        n = hi - lo
        if n:
            np.bitwise_xor(c.sketch[:, lo:hi], q.sketch[:, i : i + 1], out=x[:, :n])
            np.bitwise_count(x[:, :n], out=y[:, :n])
            apart = y[0, :n] + y[1, :n]
            apart += y[2, :n]
            at = np.flatnonzero(apart <= limit)
            if len(at):
                held.append((np.full(len(at), i), at + lo))
                count += len(at)
        if count >= 1 << 17:
            yield tuple(map(np.concatenate, zip(*held)))
            held, count = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _halves_near(q: _Queries, c: _Candidates, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that have a place in the query's title that parts it as the candidate's halves may be.

    What stands before the place matches the first half and what stands after it the
    second, but for the letters that are free, and it lies no further from the middle than
    these allow; with every second place first, those that are left with each.  The nearest
    place looked at may be half a step away, so counts differ by a step more.
    """
    for step in (2 * STEP, STEP):
        a, b = q.sizes[i], c.sizes[j]
        free = _free(a + b, q.best[i])
        low = np.clip(b // 2 - (free + b - a) // 2 - 1, 0, a) // step
        high = -(-np.clip(b // 2 + (free - b + a) // 2 + 1, 0, a) // step)
        skip = step // STEP
        last = np.minimum(high, (q.places[i] - 1) // skip)
        top, at = q.first[i] + last * skip, q.first[i] + np.minimum(low, last) * skip
        half, least = c.half.take(j, axis=0), np.full(len(i), 255, np.uint32)
        part, bits = np.empty_like(half), np.empty(half.shape, np.uint8)
        for _ in range(int((last - low).max(initial=-1)) + 1):
            q.parts.take(at, axis=0, out=part, mode="clip")
            np.bitwise_count(np.bitwise_xor(part, half, out=part), out=bits)
            apart = bits.view(np.uint32)[:, 0] * np.uint32(0x01010101)  # the sum of four bytes, in the highest
            apart >>= np.uint32(24)
            np.minimum(least, apart, out=least)
            at += skip
            np.minimum(at, top, out=at)
        near = least <= free + step
        i, j = i[near], j[near]
    return i, j


def _ratios(q: _Queries, c: _Candidates):
    """(query's number, candidate's number, ratio) of pairs that reach the threshold and may be the query's best.

    Matching blocks never hold more letters than the titles have in common, so pairs are
    taken by these, the most first, and those that can't reach what the query has met
    aren't compared.
    """
    left = [_halves_near(q, c, i, j) for i, j in _letters_near(q, c)]
    if not left:
        return
    i, j = map(np.concatenate, zip(*left))
    most = 2.0 * common_at(c.titles, q.titles, j, i, 8192) / (q.sizes[i] + c.sizes[j])  # each query has several pairs, and it is the second title that is made ready
    few = np.flatnonzero(most >= q.best[i])
    for n in few[np.argsort(-most[few], kind="stable")].tolist():
        if most[n] >= q.best[i[n]]:
            r = difflib.SequenceMatcher(None, c.titles[j[n]], q.titles[i[n]]).ratio()  # the candidate's title first, which may matter
            if r >= q.best[i[n]]:
                q.best[i[n]] = r
                yield int(q.numbers[i[n]]), int(c.numbers[j[n]]), r


def near_titles(asked: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """(qn, cn, ratio) of queries (n, t) and candidates (n, t), normal titles: all pairs at or above the threshold that may be a query's best.

    Each title meets each other, so time grows with the product of their numbers. A ratio
    leaves only so many letters of two titles, of d together, outside their matching blocks;
    lengths, counts of letters and then of those in their halves differ by d at most, and all
    letters but d are common to them in order, so none of the four tests drops a pair.
    """
    q = _blocks(asked, QUERIES, False, max(1, min(PARTS, -(-asked.count() // QUERIES))))
    files = max(1, -(-candidates.count() // PART))
    c = _blocks(candidates, CANDIDATES, True, files).coalesce(files)
    gap = lambda a, b: F.col(f"{a}.least") - F.col(f"{b}.most") <= (F.col(f"{a}.least") + F.col(f"{b}.most")) * (1 - threshold) + 1e-6
    met = q.alias("q").join(c.alias("c").hint("shuffle_replicate_nl"), gap("q", "c") & gap("c", "q"))  # parts are read by each task that needs them, nothing is shuffled
    both = met.select(*(F.col(f"q.{f}").alias(f"q{f}") for f in ("numbers", "titles", "sketch")), *(F.col(f"c.{f}").alias(f"c{f}") for f in ("numbers", "titles", "sketch", "half")))

    def compared(batches):
        held, queries = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                *of_q, numbers, titles, sketch, half = (column[row].as_py() for column in batch.columns)
                if held != of_q[0]:  # a block of queries meets all of a part one after the other
                    held, queries = of_q[0], _Queries(*of_q, threshold)
                found = list(_ratios(queries, _Candidates(numbers, titles, sketch, half)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))], ["qn", "cn", "ratio"])

    return both.mapInArrow(compared, "qn long, cn long, ratio double")


def best_title_match(queries: DataFrame, candidates: DataFrame, threshold: float = 0.84) -> DataFrame:
    """Per query (qid, title) its best candidate (cid, title, venue, citations) at or above the threshold.

    Each title is compared once, whatever the number of its records. Equal titles are
    joined; no other candidate of such a query is as good.  Each other title meets those
    of all candidates (see ``near_titles``), as two titles may reach the threshold
    without a word in common.  Ties go to a usable venue, then to citations, then to the
    smaller id.
    """
    read = lambda df, i, t, *more: df.where(f"{i} IS NOT NULL").select(i, normalize_title(F.col("title")).alias(t), *more).where(f"{t} <> ''")
    worth = lambda *first: F.struct(*first, usable(F.col("venue")).alias("u"), "citations", (-F.col("cid")).alias("i"))
    numbered = F.monotonically_increasing_id()
    c = cut_lineage(read(candidates, "cid", "ct", "venue", "citations").groupBy("ct").agg(F.max_by(F.struct("cid", "venue", "citations"), worth()).alias("c")).select("ct", "c.*", numbered.alias("cn")))
    q = cut_lineage(read(queries, "qid", "qt").distinct())
    equal = q.join(c, F.col("qt") == F.col("ct")).select("qid", "cid", "venue", "citations", F.lit(1.0).alias("ratio"))
    asked = cut_lineage(q.select("qt").distinct().join(c.select(F.col("ct").alias("qt")), "qt", "left_anti").select("qt", numbered.alias("qn")))
    near = near_titles(asked.select(F.col("qn").alias("n"), F.col("qt").alias("t")), c.select(F.col("cn").alias("n"), F.col("ct").alias("t")), threshold)
    best = near.join(c, "cn").groupBy("qn").agg(F.max_by(F.struct("cid", "venue", "citations", "ratio"), worth(F.col("ratio"))).alias("m")).join(asked, "qn").select("qt", "m.*")
    found = q.join(best, "qt").select("qid", "cid", "venue", "citations", "ratio").unionByName(equal)  # a query with two titles may have both
    return found.groupBy("qid").agg(F.max_by(F.struct("cid", "ratio", "venue", "citations"), worth(F.col("ratio"))).alias("m")).select("qid", "m.*")


def coalesce_sources(base: DataFrame, key: str, sources: list[DataFrame], attributes: list[str]) -> DataFrame:
    """Fill attributes from lookups in order of priority; once one has a usable venue the later ones aren't used."""
    out = base
    done: Column = usable(F.col("venue"))
    for n, source in enumerate(sources):
        named = source.select(key, *(F.col(a).alias(f"_{n}_{a}") for a in ["venue", *attributes]))
        out = out.join(named, key, "left")
        live = ~done
        for a in attributes:
            out = out.withColumn(a, F.coalesce(F.nullif(text(F.col(a)), F.lit("")), F.when(live, F.nullif(text(F.col(f"_{n}_{a}")), F.lit(""))), F.lit("")))
        found = live & usable(F.col(f"_{n}_venue"))
        out = out.withColumn("venue", F.when(found, F.col(f"_{n}_venue")).otherwise(F.col("venue")))
        out = out.withColumn(f"_done_{n}", done | F.coalesce(usable(F.col(f"_{n}_venue")), F.lit(False)))
        done = F.col(f"_done_{n}")
    drop = [c for c in out.columns if c.startswith("_")]
    return out.withColumn("venue", F.when(usable(F.col("venue")), F.col("venue")).otherwise("")).drop(*drop)


def score_titles(ledger: DataFrame, query: str) -> DataFrame:
    """Every ledger title with its score for a query: equal 1.2, contained 1.1, equal or contained in normal form 1.0 / 0.95, else a ratio."""
    q = query.strip().lower()
    nq = " ".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in q).split())
    low, norm = F.lower("title"), normalize_title(F.col("title"))
    ratio = F.greatest(title_ratio(F.lit(q), low), title_ratio(F.lit(nq), norm))
    score = F.when(low == q, 1.2).when(low.contains(q), 1.1).when((F.lit(nq) != "") & (norm == nq), 1.0).when((F.lit(nq) != "") & norm.contains(nq), 0.95).otherwise(ratio)
    return ledger.where("title <> '' AND page_file <> ''").select("seen_id", "field_slug", "title", score.alias("score"))


def resolve_title(ledger: DataFrame, query: str) -> DataFrame:
    """The best title, or no row where none is good or several are too close; a top-5 report, as the feature is."""
    top = score_titles(ledger, query).orderBy(F.col("score").desc(), "seen_id").limit(5)
    w = Window.orderBy(F.col("score").desc(), "seen_id")  # over five rows
    ranked = top.withColumn("n", F.row_number().over(w)).withColumn("best", F.max("score").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    near = F.count_if((F.col("n") > 1) & (F.col("best") - F.col("score") < 0.02) & (F.col("score") >= 0.8)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return ranked.withColumn("near", near).where("n = 1 AND score >= 0.45 AND (near = 0 OR best >= 1.0)").select("seen_id", "field_slug", "title", "score")
