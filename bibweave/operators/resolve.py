"""Resolving records over several sources: lookups by identifier and title, best candidates, attributes filled from matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibweave.functions.identity import fulltext_score, normalize_arxiv_id, normalize_doi, normalize_title, text
from bibweave.functions.venue import usable
from bibweave.operators.lookup import best_title_match, coalesce_sources, title_ratio

FILLED = ("abstract", "venue", "published", "url", "pdf_url", "arxiv_id", "doi")


def some(*values: Column) -> Column:
    """The first value that isn't empty, else ''."""
    return F.coalesce(*(F.nullif(text(v), F.lit("")) for v in values), F.lit(""))


def merge_info(base: DataFrame, other: DataFrame, key: str, attributes: tuple[str, ...] = FILLED) -> DataFrame:
    """``base`` with its empty attributes filled from ``other``; a key that occurs there twice fills from its least values."""
    held = other.groupBy(key).agg(*(F.min(F.nullif(text(F.col(a)), F.lit(""))).alias(f"_{a}") for a in attributes))
    joined = base.join(held, key, "left")
    return joined.withColumns({a: some(F.col(a), F.col(f"_{a}")) for a in attributes}).drop(*(f"_{a}" for a in attributes))


def by_identifier(queries: DataFrame, source: DataFrame) -> DataFrame:
    """(qid, cid): records of a source with the DOI or arXiv id of a query; the DOI is asked first."""
    ids = lambda df, i: df.select(F.col(i), F.explode(F.array(F.struct(F.lit(0).alias("prio"), normalize_doi(F.col("doi")).alias("v")), F.struct(F.lit(1).alias("prio"), normalize_arxiv_id(F.col("arxiv_id")).alias("v")))).alias("x")).select(i, "x.*").where("v <> ''")
    met = ids(queries, "qid").join(ids(source, "cid"), ["prio", "v"])
    return met.groupBy("qid").agg(F.min(F.struct("prio", "cid")).alias("m")).select("qid", "m.cid")


def by_title(queries: DataFrame, source: DataFrame, threshold: float = 0.84) -> DataFrame:
    """(qid, cid): the best record of a source by title."""
    return best_title_match(queries, source, threshold).select("qid", "cid")


def looked_up(queries: DataFrame, source: DataFrame, threshold: float = 0.84) -> DataFrame:
    """A source's record for each query: by identifier, and by title where that finds none."""
    exact = by_identifier(queries, source)
    rest = queries.join(exact, "qid", "left_anti")
    return exact.unionByName(by_title(rest, source, threshold)).join(source, "cid").drop("cid")


def enrich_venues(queries: DataFrame, sources: list[DataFrame], threshold: float = 0.84) -> DataFrame:
    """Venue and other attributes from several sources in their order; the first usable venue ends the search."""
    answers = [looked_up(queries, s, threshold).dropDuplicates(["qid"]) for s in sources]
    return coalesce_sources(queries, "qid", answers, ["published", "url", "pdf_url"])


def enrich_fulltext(queries: DataFrame, preprints: DataFrame, threshold: float = 0.82) -> DataFrame:
    """arXiv id and PDF of records that have neither, from the preprint with the best title; ties go to the newer one."""
    open_ones = queries.where("arxiv_id = '' AND pdf_url = ''").select("qid", "title")
    found = best_title_match(open_ones, preprints.withColumn("citations", F.regexp_replace("published", "-", "").try_cast("long")), threshold)
    held = found.join(preprints.select("cid", F.col("arxiv_id").alias("_a"), F.col("pdf_url").alias("_p")), "cid").select("qid", "_a", "_p")
    joined = queries.join(held, "qid", "left")
    return joined.withColumns({"arxiv_id": some(F.col("arxiv_id"), F.col("_a")), "pdf_url": some(F.col("pdf_url"), F.col("_p"))}).drop("_a", "_p")


def open_access(queries: DataFrame, locations: DataFrame) -> DataFrame:
    """PDF addresses of an open-access index, by DOI, for records that have none."""
    held = locations.select(normalize_doi(F.col("doi")).alias("_d"), F.col("pdf_url").alias("_p")).where("_d <> '' AND _p <> ''").groupBy("_d").agg(F.min("_p").alias("_p"))
    joined = queries.withColumn("_d", normalize_doi(F.col("doi"))).join(held, "_d", "left")
    return joined.withColumn("pdf_url", some(F.col("pdf_url"), F.col("_p"))).drop("_d", "_p")


def re_resolve(queries: DataFrame, candidates: DataFrame, threshold: float = 0.82) -> DataFrame:
    """The best of all candidates that carry a query's title, with gaps filled from the others.

    Candidates (qid, cid, title, ...) may come from any source.  The best has the
    better access to a full text, then citations, a usable venue, a longer abstract,
    the smaller id.
    """
    met = candidates.join(queries.select("qid", F.col("title").alias("_q")), "qid")
    near = met.where(title_ratio(normalize_title(F.col("_q")), normalize_title(F.col("title"))) >= threshold)
    order = F.struct(fulltext_score(F.col("arxiv_id"), F.col("pdf_url"), F.col("doi")).alias("f"), F.coalesce("citations", F.lit(0)).alias("c"), usable(F.col("venue")).alias("v"), F.length(text(F.col("abstract"))).alias("a"), (-F.col("cid")).alias("i"))
    ranked = near.withColumn("_o", order)
    best = lambda c: F.max_by(F.when(text(F.col(c)) != "", F.col(c)), F.when(text(F.col(c)) != "", F.col("_o"))).alias(c)
    return ranked.groupBy("qid").agg(F.max_by("cid", "_o").alias("cid"), F.max_by("title", "_o").alias("title"), F.max(F.coalesce("citations", F.lit(0))).alias("citations"), *map(best, FILLED)).na.fill("", list(FILLED))


def ledger_entry(ledger: DataFrame, page_file: str | None = None, slug: str | None = None, title: str | None = None) -> DataFrame:
    """Entries by page, by the page's name, or by normal title; the first way that is given decides."""
    if page_file:
        return ledger.where(F.col("page_file") == page_file)
    if slug:
        return ledger.where(F.regexp_extract("page_file", r"([^/]+)\.html$", 1) == slug)
    return ledger.where((normalize_title(F.lit(title or "")) != "") & (normalize_title(F.col("title")) == normalize_title(F.lit(title or ""))))


def papers_of_ledger(ledger: DataFrame) -> DataFrame:
    """Ledger entries as paper records."""
    return ledger.select(
        "seen_id", "field_slug", F.lit("ledger").alias("source"), "title", F.lit("").alias("abstract"), F.coalesce("authors", F.array().cast("array<string>")).alias("authors"), F.col("pub_date").alias("published"),
        "venue", "url", "pdf_url", some(normalize_arxiv_id(F.col("arxiv_id")), F.when(F.col("paper_key").startswith("arxiv:"), F.substring("paper_key", 7, 1_000))).alias("arxiv_id"),
        some(F.col("doi"), F.when(F.col("paper_key").startswith("doi:"), F.substring("paper_key", 5, 1_000))).alias("doi"), F.coalesce("citations", F.lit(0)).alias("citations"), F.coalesce("matched_keywords", F.array().cast("array<string>")).alias("matched_keywords"),
    )


def refreshed(ledger: DataFrame, resolved: DataFrame) -> DataFrame:
    """Ledger entries with metadata of ``resolved`` (seen_id, ...) where it has any; page, selection and dates of entry stay."""
    new = resolved.select("seen_id", *(F.col(a).alias(f"_{a}") for a in ("venue", "url", "pdf_url", "arxiv_id", "doi", "citations")))
    joined = ledger.join(new, "seen_id", "left")
    made = {a: some(F.col(f"_{a}"), F.col(a)) for a in ("venue", "url", "pdf_url", "arxiv_id", "doi")}
    return joined.withColumns(made | {"citations": F.greatest(F.coalesce("_citations", F.lit(0)), F.coalesce("citations", F.lit(0)))}).select(*ledger.columns)


def fetch_hint(paper_title: Column, arxiv_id: Column, pdf_url: Column, doi: Column) -> Column:
    """What a record could be fetched by, in words."""
    told = F.concat_ws(", ", F.when(arxiv_id != "", F.concat(F.lit("arXiv "), arxiv_id)), F.when(pdf_url != "", F.lit("PDF address")), F.when(doi != "", F.concat(F.lit("DOI "), doi)))
    return F.concat(paper_title, F.lit(": "), F.when(told != "", told).otherwise("no address known"))
