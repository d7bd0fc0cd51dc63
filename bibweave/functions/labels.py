"""Labels, HTML escapes and small string forms of the views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bibweave.functions.identity import text, tolerant_int

# Labels shown to readers.
BASIS = {
    "fulltext(arxiv)": "本文(arXiv)", "fulltext(arxiv-text)": "本文(arXiv)", "fulltext(ar5iv)": "本文(ar5iv)", "fulltext(ar5iv-text)": "本文(ar5iv)",
    "fulltext(oa-pdf)": "本文(OA-PDF)", "fulltext(arxiv-pdf)": "本文(arXiv PDF)", "fulltext(pdf)": "本文(PDF)", "fulltext": "本文",
}
SELECTION = {"important": "重要論文", "recent": "新着論文", "fallback": "補充候補", "manual": "手動追加"}


def _lookup(value: Column, table: dict[str, str], default: Column) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(text(value) == k, v) if out is None else out.when(text(value) == k, v)
    return out.otherwise(default)


def basis_label(basis: Column) -> Column:
    return _lookup(basis, BASIS, F.lit("アブストラクト"))


def basis_quality(basis: Column) -> Column:
    return F.when(text(basis).startswith("fulltext"), "fulltext").otherwise("abstract")


def selection_label(kind: Column, fallback: Column) -> Column:
    return _lookup(kind, SELECTION, text(fallback))


def reading_value_label(value: Column) -> Column:
    score = tolerant_int(value)
    return F.when(score != 0, F.concat(F.lit("読む価値 "), score.cast("string"), F.lit("/5"))).otherwise("")


def class_token(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text(value)), "[^a-z0-9_-]+", "-"), "^-+|-+$", "")


def escape_html(value: Column) -> Column:
    out = text(value)
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def multiline(value: Column) -> Column:
    return F.replace(escape_html(value), F.lit("\n"), F.lit("<br>"))


def looks_like_pdf(url: Column) -> Column:
    low = F.lower(text(url))
    return low.contains(".pdf") | low.contains("/pdf/")


def shortened(value: Column, most: int = 64) -> Column:
    """A title for one line: whole if it fits, else cut and marked."""
    t = text(value)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, most - 3)), F.lit("…")))
