"""Summaries without a language model, and the texts made of their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibweave.functions import quality
from bibweave.functions.identity import strip, text
from bibweave.functions.texts import EVIDENCE, excerpt, sentences

PARTS = ("tldr", "what", "contribution", "method", "validation", "discussion")


def stub(title: Column, abstract: Column, sections: Column) -> Column:
    """A deterministic summary without a model: every part says what it would be made of, and each section's first sentence stands for it."""
    known = strip(abstract)
    first = F.substring(F.when(known != "", known).otherwise(text(title)), 1, 120)
    basis = F.when(F.coalesce(F.size(sections), F.lit(0)) > 0, "fulltext").otherwise("abstract")
    parts = F.transform(sections, lambda s: F.struct(text(s["heading"]).alias("heading"), F.concat(F.lit("[stub] "), F.substring(text(s["body"]), 1, 120)).alias("summary")))
    named = [F.concat(F.lit(f"[stub] {p}: "), first).alias(p) for p in PARTS]
    return F.struct(*named, parts.alias("sections"), basis.alias("basis"), F.lit("stub").alias("engine"))


def whole_text(parts: list[Column], sections: Column) -> Column:
    """All non-empty parts and section summaries, a line each."""
    listed = F.concat(F.array(*map(strip, parts)), F.transform(sections, lambda s: strip(s["summary"])))
    return F.array_join(F.filter(listed, lambda x: x != ""), "\n")


def repeated_parts(summaries: DataFrame, key: str, parts: tuple[str, ...] = PARTS[1:]) -> DataFrame:
    """(key, left, right) of parts of a summary that repeat each other; ten pairs a summary at most."""
    pairs = F.array(*(F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), text(F.col(a)).alias("a"), text(F.col(b)).alias("b")) for n, a in enumerate(parts) for b in parts[n + 1 :]))
    rows = summaries.select(key, F.explode(pairs).alias("p")).select(key, "p.*").where("a <> '' AND b <> ''")
    named = rows.withColumns({"_sa": sentences(F.col("a")), "_sb": sentences(F.col("b"))})
    return named.where(quality.parts_repeat(F.col("a"), F.col("b"), F.col("_sa"), F.col("_sb"))).select(key, "left", "right")


def synthesis_issues(summaries: DataFrame, key: str) -> DataFrame:
    """(key, issues): missing parts, repeated parts, and what ``quality.section_issues`` finds in all of them."""
    repeats = repeated_parts(summaries, key).groupBy(key).agg(F.array_sort(F.collect_list(F.concat("left", F.lit(" repeats "), "right"))).alias("_r"))  # ten at most
    missing = F.filter(F.array(*(F.when(strip(F.col(p)) == "", F.lit(p)) for p in PARTS)), lambda x: x.isNotNull())
    whole = F.concat_ws("\n", *(text(F.col(p)) for p in PARTS[1:]))
    told = F.when(F.size(missing) > 0, F.array(F.concat(F.lit("missing: "), F.array_join(missing, ", ")))).otherwise(F.array().cast("array<string>"))
    joined = summaries.join(repeats, key, "left")
    return joined.select(key, F.concat(told, F.coalesce("_r", F.array().cast("array<string>")), quality.section_issues(whole)).alias("issues"))


def marked(parts: dict[str, Column]) -> Column:
    """A summary in the marked form that ``texts.parse_marked`` reads."""
    return F.concat_ws("\n", *(F.concat(F.lit(f"@@{k.upper()}@@\n"), strip(v)) for k, v in parts.items()))


def blob(parts: dict[str, Column], sections: Column) -> Column:
    """Named parts and sections of a summary, a line each, without empty ones."""
    listed = F.array(*(F.when(strip(v) != "", F.concat(F.lit(f"{k}: "), strip(v))) for k, v in parts.items()))
    named = F.transform(F.filter(sections, lambda s: strip(s["summary"]) != ""), lambda s: F.concat(text(s["heading"]), F.lit(": "), strip(s["summary"])))
    return F.array_join(F.concat(F.filter(listed, lambda x: x.isNotNull()), named), "\n")


def review_evidence(title: Column, authors: Column, abstract: Column, sections: Column, limit: int, pattern: str = EVIDENCE) -> Column:
    """What a reviewer is shown: title, authors, abstract, and an even share of each section, within a limit."""
    limit = max(4_000, limit)
    head = F.concat(F.lit("Title: "), text(title), F.lit("\nAuthors: "), F.array_join(F.slice(authors, 1, 12), ", "), F.lit("\nAbstract: "), F.substring(strip(abstract), 1, 4_000), F.lit("\n"))
    share = F.greatest(F.lit(1_200), F.floor((F.lit(limit) - F.length(head)) / F.greatest(F.size(sections), F.lit(1)))).cast("int")
    cut = F.transform(sections, lambda s: F.concat(F.lit("\n## "), text(s["heading"]), F.lit("\n"), excerpt(text(s["body"]), share, pattern)))
    packed = F.aggregate(cut, F.lit(""), lambda acc, c: F.when(F.length(acc) + F.length(head) + F.length(c) <= limit, F.concat(acc, c)).otherwise(acc))
    return F.when(F.coalesce(F.size(sections), F.lit(0)) <= 0, F.substring(head, 1, limit)).otherwise(F.concat(head, packed))
