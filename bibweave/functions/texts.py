"""Chunking, excerpts, references, sentences and tags as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bibweave.functions.identity import text

CHUNK, MOST_CHUNKS = 7_000, 14


def strip_references(body: Column) -> Column:
    """Cut at the last "references" if that is past the middle."""
    t = text(body)
    back = F.instr(F.reverse(F.lower(t)), "secnerefer")
    at = F.length(t) - back + 1 - F.lit(len("references"))  # zero-based
    return F.when((back > 0) & (at > F.length(t) * 0.5), F.substring(t, F.lit(1), at.cast("int"))).otherwise(t)


def chunks(body: Column, size: int = CHUNK, most: int = MOST_CHUNKS) -> Column:
    """Array of consecutive pieces; '' has none."""
    t = text(body)
    n = F.least(F.ceil(F.length(t) / size), F.lit(most)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.substring(t, i * size + 1, F.lit(size)))
    return F.when(n > 0, pieces).otherwise(F.array().cast("array<string>"))


def sentences(body: Column, least: int = 24) -> Column:
    """Sentences without white space and punctuation, of at least ``least`` characters."""
    parts = F.split(text(body), r"(?<=[.!?。！？])\s*|\n+")
    bare = F.transform(parts, lambda s: F.regexp_replace(F.lower(s), r"(?U)[\W_]+", ""))
    return F.filter(bare, lambda s: F.length(s) >= least)


def evidence_excerpt(body: Column, limit: int, pattern: str) -> Column:
    """Head, matching sentences of the middle while they fit, and tail, within the limit."""
    t = text(body)
    head, tail = int(limit * 0.45), int(limit * 0.25)
    room = limit - head - tail - 8
    middle = F.substring(t, F.lit(head + 1), F.greatest(F.length(t) - head - tail, F.lit(0)))
    wanted = F.filter(F.split(middle, r"(?<=[.!?。])\s*"), lambda s: s.rlike(pattern))
    state = F.struct(F.lit("").alias("out"), F.lit(room).alias("left"))
    packed = F.aggregate(
        wanted,
        state,
        lambda acc, s: F.struct(
            F.when(F.length(s) + 1 <= acc["left"], F.concat(acc["out"], F.lit("\n"), s)).otherwise(acc["out"]).alias("out"),
            F.when(F.length(s) + 1 <= acc["left"], acc["left"] - F.length(s) - 1).otherwise(acc["left"]).alias("left"),
        ),
        lambda acc: acc["out"],
    )
    short = F.concat(F.substring(t, 1, head), packed, F.lit("\n"), F.right(t, F.lit(tail)))
    return F.when(F.length(t) <= limit, t).otherwise(short)


# Words of sentences that report numbers, results and limits.
EVIDENCE = r"(?i)\d|%|percent|result|outperform|improv|success|runtime|latency|limitation|failure|ablation|比較|結果|成功率|実行時間|限界|失敗"
MIDDLE, END = "\n[middle, in part]\n", "\n[end]\n"


def excerpt(body: Column, limit: Column, pattern: str = EVIDENCE) -> Column:
    """Head, sentences of the middle that match while they fit (its start if none does), and tail; ``limit`` may differ by row."""
    t = F.trim(text(body))
    head, tail = F.greatest(F.lit(400), (limit * 0.45).cast("int")), F.greatest(F.lit(300), (limit * 0.25).cast("int"))
    room = F.greatest(F.lit(0), limit - head - tail - 30)
    middle = F.substring(t, head + 1, F.greatest(F.length(t) - head - tail, F.lit(0)))
    wanted = F.filter(F.split(middle, r"(?<=[.!?。！？])\s+"), lambda s: s.rlike(pattern) & (F.trim(s) != ""))

    def step(acc: Column, s: Column) -> Column:
        fits = F.length(acc) + F.length(F.trim(s)) + 1 <= room
        return F.when(fits, F.when(acc == "", F.trim(s)).otherwise(F.concat(acc, F.lit(" "), F.trim(s)))).otherwise(acc)

    picked = F.aggregate(wanted, F.lit(""), step)
    shown = F.when(picked != "", picked).otherwise(F.substring(middle, F.lit(1), room))
    return F.when(F.length(t) <= limit, t).otherwise(F.substring(F.concat(F.substring(t, F.lit(1), head), F.lit(MIDDLE), shown, F.lit(END), F.right(t, tail)), F.lit(1), limit))


def pack_sections(sections: Column, limit: int) -> Column:
    """Sections within a budget: whole if they fit, else each up to a quota while room is left."""
    shown = F.transform(sections, lambda s: F.concat(F.lit("## "), s["heading"], F.lit("\n"), s["body"]))
    whole = F.array_join(shown, "\n\n")
    quota = F.greatest(F.lit(1800), (F.lit(limit) / F.greatest(F.size(sections), F.lit(1))).cast("int") - 80)
    state = F.struct(F.lit("").alias("out"), F.lit(limit).alias("left"), F.lit(False).alias("stop"))

    def step(acc: Column, s: Column) -> Column:
        stop = acc["stop"] | (acc["left"] <= 500)
        piece = F.substring(s, F.lit(1), F.least(quota, acc["left"]))
        out = F.when(acc["out"] == "", piece).otherwise(F.concat(acc["out"], F.lit("\n\n"), piece))
        return F.struct(F.when(stop, acc["out"]).otherwise(out).alias("out"), F.when(stop, acc["left"]).otherwise(acc["left"] - F.length(piece)).alias("left"), stop.alias("stop"))

    return F.when(F.length(whole) <= limit, whole).otherwise(F.aggregate(shown, state, step, lambda acc: acc["out"]))


def strip_tags(html: Column) -> Column:
    bare = F.regexp_replace(text(html), r"(?is)<(script|style|noscript)\b.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]+>", " "), r"(?U)\s+", " "))


def parse_marked(body: Column) -> Column:
    """Map of ``@@KEY@@`` markers to the text behind each."""
    parts = F.slice(F.split(F.concat(F.lit("\n"), text(body)), r"@@(?=[A-Z_]+@@)"), 2, 1_000)
    entries = F.transform(parts, lambda p: F.struct(F.lower(F.substring_index(p, "@@", 1)).alias("k"), F.regexp_replace(F.substring(p, F.instr(p, "@@") + 2, F.length(p)), r"(?U)^\s+|\s+$", "").alias("v")))
    return F.map_from_entries(entries)


def parse_rating(body: Column) -> Column:
    """Score 1 to 5: the marked one, else the first such digit that stands alone, else 3."""
    named = F.regexp_extract(text(body), r"(?i)@@SCORE@@\s*([1-5])", 1)
    plain = F.regexp_extract(text(body), r"\b([1-5])\b", 1)
    return F.coalesce(F.nullif(named, F.lit("")), F.nullif(plain, F.lit("")), F.lit("3")).cast("int")


def rating_reason(body: Column, default: str = "要約内容とメタデータに基づく暫定評価。") -> Column:
    """First line of the marked reason of a rating, at most 120 characters."""
    found = F.trim(F.regexp_extract(text(body), r"(?i)@@REASON@@\s*([^\n]+)", 1))
    return F.substring(F.when(found != "", found).otherwise(default), 1, 120)


def no_markers(body: Column) -> Column:
    """A text without any ``@@KEY@@`` marker is an error, not an empty summary."""
    return ~text(body).rlike("@@[A-Z_]+@@")


def restore_inverted(index: Column) -> Column:
    """Text of an inverted index word -> positions."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " ")
