"""Serving views over the ledger: lists with chips and search text, cards, pages, follow-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibweave.functions import labels, venue
from bibweave.functions.identity import text, tolerant_int
from bibweave.functions.match import has_word
from bibweave.sources.sinks import rendered

NONE = "array<string>"


def list_of(value: Column) -> Column:
    """The non-blank entries of a list that may be null."""
    return F.filter(F.coalesce(value, F.array().cast(NONE)), lambda k: F.trim(k) != "")


def keywords_of(matched: Column, title: Column, tldr: Column, keywords: Column) -> Column:
    """Stored keywords, else those of the field that stand in title or summary."""
    body = F.lower(F.concat(text(title), F.lit(" "), text(tldr)))
    found = F.transform(F.filter(F.coalesce(keywords, F.array().cast(NONE)), lambda k: has_word(body, k)), lambda k: F.trim(k))
    return F.when(F.size(list_of(matched)) > 0, list_of(matched)).otherwise(found)


def chips(selection: Column, selection_label: Column, keywords: Column, citations: Column, relevance: Column, basis: Column, reading_value: Column) -> Column:
    """Labels of an entry's list item, in order; what is unknown has none."""
    named = labels.selection_label(selection, selection_label)
    made = F.array(
        F.when(named != "", named),
        F.when(F.size(keywords) > 0, F.concat(F.lit("キーワード一致 "), F.size(keywords).cast("string"))),
        F.when(citations.isNotNull(), F.concat(F.lit("被引用 "), tolerant_int(citations).cast("string"))),
        F.when(relevance.isNotNull(), F.concat(F.lit("関連度 "), tolerant_int(relevance).cast("string"))),
        F.when(text(basis) != "", labels.basis_label(basis)),
        F.nullif(labels.reading_value_label(reading_value), F.lit("")),
    )
    return F.filter(made, lambda c: c.isNotNull())


def added_at(added_at: Column, added_on: Column) -> Column:
    return F.coalesce(F.nullif(text(added_at), F.lit("")), text(added_on))


def entries(ledger: DataFrame, subscriptions: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Ledger entries with everything a list shows: keywords, authors, venue, chips, search text, order of entry, newest mark.

    ``pages`` (page_file, authors, venue) fill authors and venues that the ledger doesn't have.
    """
    specs = subscriptions.select(F.col("username").alias("field_slug"), "keywords", "label")
    rows = ledger.join(specs, "field_slug", "left")
    if pages is not None:
        rows = rows.join(pages.select("page_file", F.col("authors").alias("_authors"), F.col("venue").alias("_venue")), "page_file", "left")
    else:
        rows = rows.withColumns({"_authors": F.lit(""), "_venue": F.lit("")})
    newest = ledger.groupBy("field_slug").agg(F.max(F.nullif("added_on", F.lit(""))).alias("newest"))
    tags = keywords_of(F.col("matched_keywords"), F.col("title"), F.col("tldr"), F.col("keywords"))
    people = F.when(F.size(list_of(F.col("authors"))) > 0, F.array_join(F.transform(list_of(F.col("authors")), F.trim), ", ")).otherwise(text(F.col("_authors")))
    own = venue.label(F.col("venue"), F.col("pub_date"), "")
    place = F.when(own != "", own).otherwise(venue.label(F.col("_venue"), F.col("pub_date"), ""))
    made = rows.join(newest, "field_slug", "left").withColumns({"tags": tags, "people": people, "place": place})
    search = F.lower(F.concat_ws(" ", "title", "people", "place", "pub_date", "tldr", "selection_label", labels.selection_label(F.col("selection"), F.lit("")), F.array_join("tags", " ")))
    return made.select(
        "seen_id", "field_slug", "title", "people", "place", "tags", chips(F.col("selection"), F.col("selection_label"), F.col("tags"), F.col("citations"), F.col("relevance"), F.col("basis"), F.col("reading_value")).alias("chips"),
        added_at(F.col("added_at"), F.col("added_on")).alias("at"), "page_file", "pub_date", "tldr", tolerant_int(F.col("reading_value")).alias("value"), search.alias("search_text"),
        F.coalesce((F.col("added_on") == F.col("newest")), F.lit(False)).alias("latest"),
    )


def with_state(items: DataFrame, state: DataFrame) -> DataFrame:
    """A reader's marks (page_file, read, want, favorite, hidden) laid over a list; what has none is unmarked."""
    marks = ("read", "want", "favorite", "hidden")
    joined = items.join(state.select("page_file", *marks), "page_file", "left")
    return joined.withColumns({m: F.coalesce(m, F.lit(False)) for m in marks})


def search(items: DataFrame, query: str, hidden: bool = False) -> DataFrame:
    """Items whose search text holds the query; hidden ones only if asked for."""
    hit = F.col("search_text").contains(query.strip().lower())
    return items.where(hit if hidden or "hidden" not in items.columns else hit & ~F.col("hidden"))


def cards(ledger: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """(field_slug, label, keywords, papers): a card per subscription, of empty fields too."""
    n = ledger.groupBy("field_slug").count()
    s = subscriptions.select(F.col("username").alias("field_slug"), F.coalesce(F.nullif("label", F.lit("")), F.col("username")).alias("label"), F.array_join("keywords", ", ").alias("keywords"))
    return s.join(n, "field_slug", "left").select("field_slug", "label", "keywords", F.coalesce("count", F.lit(0)).alias("papers"))


def latest_report(names: DataFrame) -> DataFrame:
    """The newest report page by its name, a date; no row if there is none."""
    found = names.where(F.col("name").rlike(r"^\d{4}-\d{2}-\d{2}\.html$")).agg(F.max("name").alias("name"))
    return found.where("name IS NOT NULL").select(F.concat(F.lit("data/runs/"), "name").alias("href"))


def items_html(items: DataFrame) -> DataFrame:
    """(seen_id, field_slug, at, page_file, html): list items ready to be put together in order."""
    e = labels.escape_html
    tag = lambda c, klass: F.array_join(F.transform(c, lambda k: F.concat(F.lit(f'<span class="{klass}">'), e(k), F.lit("</span>"))), "")
    some = lambda c, pre: F.when(c != "", F.concat(F.lit(pre), e(c), F.lit("</div>"))).otherwise("")
    html = F.concat(
        F.when(F.col("latest"), '<li class="latest">').otherwise("<li>"), F.lit('<a href="'), e(F.regexp_extract("page_file", "([^/]*)$", 1)), F.lit('">'), e(F.col("title")), F.lit("</a>"),
        some(F.col("people"), '<div class="authors">'), some(F.col("place"), '<div class="venue">'), tag(F.col("chips"), "chip"), tag(F.col("tags"), "tag"),
        F.lit('<div class="meta">'), e(F.col("pub_date")), F.lit(" ・ "), e(F.col("tldr")), F.lit("</div></li>"),
    )
    return items.select("seen_id", "field_slug", "at", "page_file", html.alias("html"))


def field_pages(items: DataFrame, page_rows: int = 1_000) -> DataFrame:
    """(field_slug, page_no, html): the newest first, in pages of bounded length, so that no page holds a field of any size."""
    from bibweave.operators.ranking import numbered

    order = [F.col("at").desc(), F.col("page_file").desc(), F.col("seen_id")]
    placed = numbered(items_html(items), "field_slug", order, "n").withColumn("page_no", F.floor((F.col("n") - 1) / page_rows).cast("int"))
    listed = placed.groupBy("field_slug", "page_no").agg(F.array_sort(F.collect_list(F.struct("n", "html"))).alias("rows"))  # at most page_rows
    return listed.select("field_slug", "page_no", F.array_join(F.transform("rows", lambda r: r["html"]), "\n").alias("html"))


def global_recent(items: DataFrame, most: int = 30) -> DataFrame:
    """The newest entries of all fields; the limit is the feature."""
    return items.orderBy(F.col("at").desc(), F.col("page_file").desc(), "seen_id").limit(most)


# Headings of a page's parts.
SECTIONS = {"what": "どんなもの？", "contribution": "先行研究と比べてどこがすごい？", "method": "技術や手法のキモはどこ？", "validation": "どうやって有効だと検証した？", "discussion": "議論はある？（限界・課題）"}


def paper_pages(papers: DataFrame, template: str, headings: dict[str, str] | None = None) -> DataFrame:
    """(seq, html) of papers with a ``summary`` struct (tldr, the parts, sections) and a ``basis``."""
    e, m = labels.escape_html, labels.multiline
    part = lambda k, h: F.concat(F.lit(f'<section class="qa"><h2>{h}</h2><p>'), m(F.col(f"summary.{k}")), F.lit("</p></section>\n"))
    link = lambda c, name, pre="": F.when(text(F.col(c)) != "", F.concat(F.lit(f'<a href="{pre}'), e(F.col(c)), F.lit(f'">{name}</a>')))
    detail = F.array_join(F.transform(F.col("summary.sections"), lambda s: F.concat(F.lit('<section class="secsum"><h3>'), e(s["heading"]), F.lit("</h3><p>"), m(s["summary"]), F.lit("</p></section>\n"))), "")
    rows = papers.select(
        "seq", e(F.col("title")).alias("title"), m(F.col("summary.tldr")).alias("tldr"), e(F.array_join(F.slice("authors", 1, 12), ", ")).alias("authors"), e(venue.label(F.col("venue"), F.col("published"))).alias("venue"),
        e(F.col("published")).alias("published"), e(F.col("source")).alias("source"), F.concat_ws(" ・ ", link("url", "原典"), link("pdf_url", "PDF"), link("doi", "DOI", "https://doi.org/")).alias("links"),
        F.concat(*(part(k, h) for k, h in (headings or SECTIONS).items())).alias("sections"), detail.alias("sections_detail"), labels.basis_label(F.col("basis")).alias("basis"),
    )
    return rendered(rows, template, "seq")


def append_followup(followups: DataFrame, page_file: str, question: str, answer: str, asked_at: str) -> DataFrame:
    """Dialogues (page_file, turn, question, answer, asked_at) with one more turn of a page."""
    last = followups.where(F.col("page_file") == page_file).agg(F.coalesce(F.max("turn"), F.lit(0)).alias("turn"))
    new = last.select(F.lit(page_file).alias("page_file"), (F.col("turn") + 1).cast("int").alias("turn"), F.lit(question).alias("question"), F.lit(answer).alias("answer"), F.lit(asked_at).alias("asked_at"))
    return followups.unionByName(new)


def clear_followups(followups: DataFrame, page_file: str) -> DataFrame:
    return followups.where(F.col("page_file") != page_file)


def report_html(metrics: DataFrame) -> DataFrame:
    """(field_slug, html): a row of the run report's table per field."""
    cells = [c for c in metrics.columns if c != "field_slug"]
    return metrics.select("field_slug", F.concat(F.lit("<tr><th>"), labels.escape_html(F.col("field_slug")), F.lit("</th>"), *(F.concat(F.lit("<td>"), F.col(c).cast("string"), F.lit("</td>")) for c in cells), F.lit("</tr>")).alias("html"))
