"""Identity of records: normal forms of titles and identifiers, keys, file ids, aliases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def strip(value: Column) -> Column:
    """Trim of all Unicode white space; ``trim`` alone takes only blanks."""
    return F.regexp_replace(text(value), r"(?U)^\s+|\s+$", "")


def squeeze(value: Column) -> Column:
    return strip(F.regexp_replace(text(value), r"(?U)\s+", " "))


def normalize_title(value: Column) -> Column:
    """Lower-case ASCII letters and digits, single blanks between."""
    return F.trim(F.regexp_replace(F.lower(text(value)), "[^a-z0-9]+", " "))


def normalize_doi(value: Column) -> Column:
    bare = F.regexp_replace(F.lower(strip(value)), r"^https?://(dx\.)?doi\.org/", "")
    return strip(F.regexp_replace(bare, "^doi:", ""))


def normalize_arxiv_id(value: Column) -> Column:
    bare = F.regexp_replace(F.lower(strip(value)), r"^https?://(www\.)?arxiv\.org/(abs|pdf)/", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "^arxiv:", ""), r"\.pdf$", "")
    return strip(F.regexp_replace(bare, r"v\d+$", ""))


def doi_arxiv_id(value: Column) -> Column:
    """The arXiv id inside a DOI of an arXiv deposit, else ''."""
    doi = normalize_doi(value)
    return F.when(doi.startswith("10.48550/arxiv."), normalize_arxiv_id(F.substring(doi, 16, 1000))).otherwise("")


def paper_key(doi: Column, arxiv_id: Column, title: Column) -> Column:
    """doi ▸ arxiv ▸ title."""
    return F.when(text(doi) != "", F.concat(F.lit("doi:"), F.lower(doi))).when(text(arxiv_id) != "", F.concat(F.lit("arxiv:"), F.lower(arxiv_id))).otherwise(F.concat(F.lit("title:"), normalize_title(title)))


def paper_id(doi: Column, arxiv_id: Column, title: Column) -> Column:
    """File name: arxiv ▸ hash of the doi ▸ hash of the title."""
    return (
        F.when(text(arxiv_id) != "", arxiv_id)
        .when(text(doi) != "", F.concat(F.lit("doi-"), F.substring(F.sha1(F.lower(doi)), 1, 12)))
        .otherwise(F.concat(F.lit("t-"), F.substring(F.sha1(normalize_title(title)), 1, 12)))
    )


def slugify(value: Column, most: int = 80, fallback: str = "item") -> Column:
    dashed = F.regexp_replace(F.regexp_replace(F.lower(strip(value)), "/", "-"), "[^A-Za-z0-9._-]+", "-")
    single = F.regexp_replace(F.regexp_replace(dashed, "-{2,}", "-"), "^[-._]+|[-._]+$", "")
    short = F.regexp_replace(F.substring(single, 1, most), "^[-._]+|[-._]+$", "")
    return F.when(short == "", fallback).otherwise(short)


def _listed(*values: tuple[str, Column]) -> Column:
    named = F.array(*(F.when(v != "", F.concat(F.lit(kind), v)) for kind, v in values))
    return F.array_distinct(F.filter(named, lambda x: x.isNotNull()))


def paper_aliases(title: Column, doi: Column, arxiv_id: Column) -> Column:
    """All names under which a record may be known, in order, without repeats."""
    return _listed(("title:", normalize_title(title)), ("doi:", normalize_doi(doi)), ("arxiv:", normalize_arxiv_id(arxiv_id)), ("arxiv:", doi_arxiv_id(doi)))


def ledger_aliases(key: Column, title: Column, doi: Column, arxiv_id: Column) -> Column:
    """Names of a ledger entry: those of its key first, then those of its fields."""
    raw = strip(key)
    kind = lambda name, value: F.when(raw.startswith(name), value).otherwise("")
    return _listed(
        ("doi:", kind("doi:", normalize_doi(raw))),
        ("arxiv:", kind("doi:", doi_arxiv_id(raw))),
        ("arxiv:", kind("arxiv:", normalize_arxiv_id(raw))),
        ("title:", kind("title:", normalize_title(F.substring(raw, 7, 100_000)))),
        ("title:", normalize_title(title)),
        ("doi:", normalize_doi(doi)),
        ("arxiv:", doi_arxiv_id(doi)),
        ("arxiv:", normalize_arxiv_id(arxiv_id)),
    )


def fulltext_score(arxiv_id: Column, pdf_url: Column, doi: Column) -> Column:
    """How easily the full text is had: arXiv 3, PDF 2, DOI 1."""
    return F.when(text(arxiv_id) != "", 3).when(text(pdf_url) != "", 2).when(text(doi) != "", 1).otherwise(0)


def tolerant_int(value: Column) -> Column:
    return F.coalesce(value.cast("string").try_cast("bigint"), F.lit(0).cast("long"))
