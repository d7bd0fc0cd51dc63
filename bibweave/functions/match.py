"""Keyword matching, relevance and the gate for ambiguous acronyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bibweave.functions.identity import strip, text


def _word(keyword: Column) -> Column:
    """Pattern of a keyword as a whole word; Unicode letters count as neighbours."""
    return F.concat(F.lit(r"(?U)\b\Q"), F.lower(strip(keyword)), F.lit(r"\E\b"))


def has_word(body: Column, keyword: Column) -> Column:
    return (strip(keyword) != "") & F.rlike(body, _word(keyword))


def body_of(title: Column, abstract: Column) -> Column:
    return F.lower(F.concat(text(title), F.lit("\n"), text(abstract)))


def matched_keywords(title: Column, abstract: Column, keywords: Column) -> Column:
    """Keywords that stand in title or abstract, in their own order."""
    t, a = F.lower(text(title)), F.lower(text(abstract))
    return F.transform(F.filter(keywords, lambda k: has_word(t, k) | has_word(a, k)), strip)


def relevance(title: Column, abstract: Column, keywords: Column) -> Column:
    """Three for each keyword in the title, one for each in the abstract."""
    t, a = F.lower(text(title)), F.lower(text(abstract))
    return F.aggregate(keywords, F.lit(0).cast("long"), lambda n, k: n + F.when(has_word(t, k), 3).otherwise(0) + F.when(has_word(a, k), 1).otherwise(0))


def literal_matches(field: Column, title: Column, abstract: Column, keywords: dict[str, list[str]]) -> tuple[Column, Column]:
    """(relevance, matched keywords) with the keywords of each field as literals, so that each pattern is compiled once."""
    t, a = F.lower(text(title)), F.lower(text(abstract))
    score, matched = None, None
    for name, words in keywords.items():
        total, found = F.lit(0).cast("long"), []
        for w in words:
            bare = (w or "").strip()
            if not bare:
                continue
            pattern = rf"(?U)\b\Q{bare.lower()}\E\b"
            in_title, in_abstract = t.rlike(pattern), a.rlike(pattern)
            total = total + F.when(in_title, 3).otherwise(0) + F.when(in_abstract, 1).otherwise(0)
            found.append(F.when(in_title | in_abstract, bare))
        kept = F.filter(F.array(*found), lambda k: k.isNotNull()) if found else F.array().cast("array<string>")
        score = F.when(field == name, total) if score is None else score.when(field == name, total)
        matched = F.when(field == name, kept) if matched is None else matched.when(field == name, kept)
    if score is None:
        return F.lit(0).cast("long"), F.array().cast("array<string>")
    return F.coalesce(score, F.lit(0).cast("long")), F.coalesce(matched, F.array().cast("array<string>"))


def has_context(body: Column, context: Column) -> Column:
    """Any of the context words; an empty list asks for none."""
    return (F.size(context) <= 0) | F.exists(context, lambda k: has_word(body, k))


def meets_groups(body: Column, groups: Column) -> Column:
    """Any group of which all words are there."""

    def whole(g: Column) -> Column:
        needed = F.filter(g, lambda t: strip(t) != "")
        return (F.size(needed) > 0) & F.forall(needed, lambda t: has_word(body, t))

    return F.exists(groups, whole)


def context_issue(title: Column, abstract: Column, matched: Column, ambiguous: Column, context: Column, groups: Column) -> Column:
    """Reason why a record that only matched ambiguous acronyms belongs to another field, or ''.

    ``groups`` maps an acronym to alternatives of words that must stand together.
    """
    fold = lambda words: F.filter(F.transform(words, lambda k: F.lower(strip(k))), lambda k: k != "")
    m, amb = F.array_distinct(fold(matched)), fold(ambiguous)
    body = body_of(title, abstract)
    configured = F.transform_keys(groups, lambda k, _: F.lower(strip(k)))
    missing = F.filter(m, lambda k: F.map_contains_key(configured, k) & ~meets_groups(body, configured[k]))
    label = lambda words: F.array_join(F.array_sort(F.transform(words, F.upper)), ", ")
    only_ambiguous = (F.size(amb) > 0) & (F.size(m) > 0) & (F.size(F.array_except(m, amb)) == 0)
    has_groups = F.coalesce(F.size(groups), F.lit(0)) > 0
    return (
        F.when(~only_ambiguous, "")
        .when(has_groups & (F.size(missing) > 0), F.concat(F.lit("required terms missing: "), label(missing)))
        .when(has_groups & F.forall(m, lambda k: F.map_contains_key(configured, k)), "")
        .when(has_context(body, context), "")
        .otherwise(F.concat(F.lit("no context of the field: "), label(m)))
    )
