"""Quality of texts and summaries: plausibility, shallow pages, duplicated parts, reading value."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibweave.functions.identity import strip, text

# Headings that aren't part of an article.
DENY = [
    "reference", "bibliography", "acknowledg", "instructions for reporting", "report issue", "github issue", "back to", "why html", "download pdf",
    "appendix", "(前文)", "access paper", "bibliographic", "citation tools", "code, data", "code, data and media", "demos", "recommenders",
    "search tools", "arxivlabs", "arxiv labs",
]
# Headings of an abstract page's own parts.
PAGE_HEADINGS = ["access paper", "bibliographic", "citation tools", "code, data", "demos", "recommenders", "search tools", "arxivlabs", "arxiv labs"]
# Headings of articles.
ARTICLE = ["introduction", "related work", "background", "preliminar", "problem", "method", "approach", "algorithm", "experiment", "evaluation", "result", "discussion", "conclusion"]
# Words of titles that identify nothing.
TITLE_STOP = ["about", "after", "based", "from", "into", "multi", "agent", "paper", "study", "through", "toward", "towards", "using", "with"]
# Phrases of author kits.
TEMPLATE = ["formatting instructions", "style and format", "paper size", "camera-ready", "latex and word style files", "booktabs", "illustrations", "proofs"]
SECTION_MIN, SECTION_MAX, MOST_SECTIONS, HEADING_MAX = 150, 14_000, 14, 120


def _any(body: Column, phrases: list[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | body.contains(p)
    return out


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Compatibility forms (full-width letters, ligatures, ...) as plain ones."""
    return pd.Series([v if v is None or v.isascii() else unicodedata.normalize("NFKC", v) for v in values], dtype=object)


def title_terms(title: Column) -> Column:
    """Longer words of a title, without those that identify nothing."""
    words = F.regexp_extract_all(F.lower(nfkc(text(title))), F.lit("(?<![a-z0-9])([a-z0-9]{4,})(?![a-z0-9])"), F.lit(1))
    return F.array_except(words, F.array(*map(F.lit, TITLE_STOP)))


def text_matches_title(body: Column, title: Column) -> Column:
    """Two of the title's words (one of fewer than three) stand in the text."""
    terms = title_terms(title)
    hits = F.size(F.array_intersect(terms, F.split(F.lower(nfkc(text(body))), r"[^\p{L}\p{M}\p{N}_]+")))
    return (F.size(terms) == 0) | (hits >= F.when(F.size(terms) >= 3, 2).otherwise(1))


def looks_like_template(body: Column) -> Column:
    low = F.regexp_replace(F.lower(nfkc(text(body))), r"(?U)\s+", " ")
    hits = sum((low.contains(m).cast("int") for m in TEMPLATE), F.lit(0))
    return low.contains("formatting instructions") & (hits >= 3)


def plausible(body: Column, title: Column) -> Column:
    return ~looks_like_template(body) & text_matches_title(body, title)


def denied(heading: Column) -> Column:
    return _any(F.lower(text(heading)), DENY)


def is_page_heading(heading: Column) -> Column:
    return _any(F.lower(text(heading)), PAGE_HEADINGS)


def is_article_heading(heading: Column) -> Column:
    return ~is_page_heading(heading) & _any(F.lower(text(heading)), ARTICLE)


def clean_sections(sections: Column) -> Column:
    """Sections without denied headings and short bodies, capped in number and length."""
    kept = F.filter(sections, lambda s: ~denied(s["heading"]) & (F.length(s["body"]) >= SECTION_MIN))
    return F.transform(F.slice(kept, 1, MOST_SECTIONS), lambda s: F.struct(F.substring(s["heading"], 1, HEADING_MAX).alias("heading"), F.substring(s["body"], 1, SECTION_MAX).alias("body")))


def looks_like_abstract_page(sections: Column) -> Column:
    return F.exists(sections, lambda s: is_page_heading(s["heading"])) & ~F.exists(sections, lambda s: is_article_heading(s["heading"]))


def too_shallow(sections: Column) -> Column:
    size = F.size(sections)
    article = F.exists(sections, lambda s: _any(F.lower(text(s["heading"])), ARTICLE))
    titled = F.exists(sections, lambda s: F.lower(s["heading"]).startswith("title"))
    return (size <= 0) | (~article & ((size <= 2) | (titled & (size <= 3))))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: inside a lambda a plain column would be computed for every element."""
    return F.transform(F.array(value), body)[0]


def char_ngrams(value: Column, n: int = 3) -> Column:
    """Distinct character n-grams of the lower-case text without white space and punctuation."""

    def grams(bare: Column) -> Column:
        # Letters as an array: a substring of a long string would be looked for from its start each time.
        made = let(F.split(bare, ""), lambda ls: F.transform(F.sequence(F.lit(1), F.greatest(F.size(ls) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(ls, i, F.lit(n)), "")))
        return F.when(F.length(bare) >= n, F.array_distinct(made)).otherwise(F.array().cast("array<string>"))

    return let(F.regexp_replace(F.lower(text(value)), r"(?U)[\W_]+", ""), grams)


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller set of n-grams that the other one has; 0 if either is empty."""

    def share(g: Column) -> Column:
        least = F.least(F.size(g["a"]), F.size(g["b"]))
        return F.when(least > 0, F.size(F.array_intersect(g["a"], g["b"])) / least).otherwise(0.0)

    return let(F.struct(char_ngrams(a).alias("a"), char_ngrams(b).alias("b")), share)


def weak_relevance(score: Column, matched: Column) -> Column:
    return (score < 1) | (F.size(matched) <= 0)


def too_short(tldr: Column, whole: Column) -> Column:
    return (F.length(strip(tldr)) < 40) | (F.length(text(whole)) < 260)


def heuristic_reading_value(citations: Column, basis: Column, blob: Column) -> Column:
    """1 to 5 from citations, full text and the length of the summary."""
    score = F.lit(2) + F.when(citations >= 100, 2).when(citations >= 20, 1).otherwise(0)
    score = score + F.when(text(basis).startswith("fulltext"), 1).otherwise(0) + F.when(F.length(text(blob)) >= 900, 1).otherwise(0)
    return F.greatest(F.lit(1), F.least(F.lit(5), score))


# What is left of formulas, references by number, and names of steps in a summary.
TEX = r"\\[A-Za-z]+|\\[()\[\]]"
NUMBERED = r"(?i)(?:図|表|式|アルゴリズム)\s*[0-9０-９IVXivx]+|\b(?:fig(?:ure)?|table|algorithm|equation|eq\.)\s*[0-9IVXivx]+"
#: Names that stand within a few characters of the words for function, step, call, run, use.
NAMED_STEP = r"(?<![A-Za-z0-9_])([A-Za-z][A-Za-z0-9]*)(?=(?:[^A-Za-z0-9_]|$).{0,15}(?:関数|手順|呼び出|実行|用い|適用))"


def has_tex(body: Column) -> Column:
    return text(body).contains("$") | text(body).rlike(TEX)


def has_numbered_reference(body: Column) -> Column:
    """A figure, table, equation or algorithm by its number, which a reader of the summary can't look up."""
    return text(body).rlike(NUMBERED)


def has_code_name(body: Column) -> Column:
    """A name with two or more humps that a text uses as a function's."""
    names = F.regexp_extract_all(text(body), F.lit(NAMED_STEP), F.lit(1))
    return F.exists(names, lambda n: F.size(F.regexp_extract_all(n, F.lit("([a-z](?=[A-Z]))"), F.lit(1))) >= 2)


def section_issues(body: Column) -> Column:
    """Reasons why a section's summary has to be written again."""
    return F.filter(F.array(F.when(has_tex(body), "TeX left"), F.when(has_numbered_reference(body), "numbered reference"), F.when(has_code_name(body), "name from pseudo-code")), lambda x: x.isNotNull())


@F.pandas_udf(T.DoubleType())
def best_sentence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Greatest similarity of a sentence of one list to one of the other."""
    from difflib import SequenceMatcher

    return pd.Series([max((SequenceMatcher(None, x, y).ratio() for x in p for y in q), default=0.0) for p, q in zip(a, b)], dtype="float64")


def parts_repeat(a: Column, b: Column, sentences_a: Column, sentences_b: Column, shared: float = 0.68, alike: float = 0.86) -> Column:
    """Whether two parts of a summary say the same: most character n-grams in common, or two sentences that are nearly equal."""
    return (containment(a, b) >= shared) | (best_sentence_ratio(sentences_a, sentences_b) >= alike)


def unknown_phrases(whole: Column, phrase: str = "提供された情報からは不明") -> Column:
    """How often a summary says that it doesn't know."""
    return ((F.length(text(whole)) - F.length(F.replace(text(whole), F.lit(phrase), F.lit("")))) / len(phrase)).cast("int")


def no_text(abstract: Column, sections: Column) -> Column:
    """Neither sections nor an abstract: nothing to summarise."""
    return (F.coalesce(F.size(sections), F.lit(0)) <= 0) & (strip(abstract) == "")
