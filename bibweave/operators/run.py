"""The daily run as one plan: pools of candidates, what is new, quotas left of the day, the queue, its consumption and its numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibweave.functions.identity import ledger_aliases, paper_aliases
from bibweave.operators import ranking


def query_label(terms: Column) -> Column:
    """Name of a query group in counts."""
    return F.array_join(terms, " + ")


def unseen(papers: DataFrame, ledger: DataFrame) -> DataFrame:
    """Papers that share no alias with their field's ledger; papers without any alias are new."""
    named = papers.select("field_slug", "seq", F.explode(paper_aliases(F.col("title"), F.col("doi"), F.col("arxiv_id"))).alias("alias"))
    known = ledger.select("field_slug", F.explode(ledger_aliases(F.col("paper_key"), F.col("title"), F.col("doi"), F.col("arxiv_id"))).alias("alias")).distinct()
    return papers.join(named.join(known, ["field_slug", "alias"], "left_semi").select("seq").distinct(), "seq", "left_anti")


def with_cache(papers: DataFrame, cache: DataFrame | None) -> DataFrame:
    """Fresh answers, and behind them what earlier runs have kept, so that a source that is out still has candidates."""
    if cache is None:
        return papers
    last = papers.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("_last"))
    shared = [c for c in papers.columns if c in cache.columns and c != "seq"]
    later = cache.crossJoin(F.broadcast(last)).select((F.col("_last") + F.col("seq")).alias("seq"), *shared)  # one row on the other side
    return papers.select("seq", *shared).unionByName(later)


def pools(scored: DataFrame) -> DataFrame:
    """The important pool takes recent records too; a work is in the recent pool if any of its records is."""
    recent = scored.groupBy("field_slug", "paper_key").agg(F.max(F.col("scan_mode") == "recent").alias("in_recent"))
    return scored.join(recent, ["field_slug", "paper_key"]).withColumn("in_important", F.lit(True))


def quotas_today(ledger: DataFrame, subscriptions: DataFrame, today: Column | None = None) -> DataFrame:
    """(field_slug, k, already, important_left, recent_left): what is left after what was added today; entries made by hand don't count."""
    day = ledger.agg(F.max("added_on").alias("day")) if today is None else ledger.sparkSession.range(1).select(today.alias("day"))
    added = ledger.join(F.broadcast(day), F.col("added_on") == F.col("day")).where("coalesce(selection, '') <> 'manual'")  # one row
    counts = added.groupBy("field_slug").agg(F.count("*").alias("already"), F.count_if(F.col("selection") == "important").alias("imp"), F.count_if(F.col("selection") == "recent").alias("rec"))
    s = subscriptions.select(F.col("username").alias("field_slug"), ranking.clamp_k(F.col("k").cast("int")).alias("k")).join(counts, "field_slug", "left").na.fill(0)
    i, r = ranking.remaining_quotas(F.col("k"), F.col("already"), F.col("imp"), F.col("rec"))
    return s.select("field_slug", "k", "already", i.cast("int").alias("important_left"), r.cast("int").alias("recent_left"))


def daily_queue(papers: DataFrame, ledger: DataFrame, subscriptions: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """(field_slug, seq, phase, queue_pos, issue, fulltext, k, left): candidates in the order in which they are tried."""
    fresh = unseen(with_cache(papers, cache), ledger)
    rows = pools(ranking.scored(fresh, subscriptions))
    quotas = quotas_today(ledger, subscriptions)
    queue = ranking.selection_queue(rows, quotas.drop("k"))
    left = quotas.select("field_slug", (F.col("important_left") + F.col("recent_left")).alias("left"))
    return queue.join(left, "field_slug").where(F.col("left") > 0)


def gates(queue: DataFrame, strict: bool = True) -> DataFrame:
    """The queue with ``reasons``, why a candidate is skipped; an empty list if it passes."""
    listed = [F.when((F.col("relevance") < 1) | (F.size("matched") <= 0), "weak relevance"), F.when(F.col("issue") != "", F.col("issue"))]
    if strict:
        listed.append(F.when(F.col("fulltext") == 0, "no full text"))
    return queue.withColumn("reasons", F.filter(F.array(*listed), lambda r: r.isNotNull()))


def consume(queue: DataFrame) -> DataFrame:
    """What a run looks at: candidates until the slots left are filled, with ``passed`` and the reasons of those that weren't taken."""
    return ranking.waves(gates(queue), F.size("reasons") == 0, F.col("left"))


def metrics(papers: DataFrame, ledger: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Per field: candidates, fresh, relevant, picked at first, added, skipped, shortfall."""
    fields = subscriptions.select(F.col("username").alias("field_slug"))
    fresh = ranking.scored(unseen(papers, ledger), subscriptions)
    counted = fresh.groupBy("field_slug").agg(F.count("*").alias("fresh"), F.count_if((F.col("relevance") > 0) & (F.col("issue") == "")).alias("relevant"))
    queue = daily_queue(papers, ledger, subscriptions)
    picked = queue.where(F.col("queue_pos") <= F.col("left")).groupBy("field_slug").agg(F.count("*").alias("picked"))
    tried = consume(queue).groupBy("field_slug").agg(F.sum("passed").alias("added"), F.count_if(F.col("passed") == 0).alias("skipped"))
    left = quotas_today(ledger, subscriptions).select("field_slug", "k", "already")
    total = papers.join(fields, "field_slug", "left_semi").groupBy("field_slug").agg(F.count("*").alias("candidates"))
    out = fields
    for part in (total, counted, picked, tried, left):
        out = out.join(part, "field_slug", "left")
    out = out.na.fill(0)
    return out.select("field_slug", "candidates", "fresh", "relevant", "picked", "added", "skipped", F.greatest(F.lit(0), F.col("k") - F.col("already") - F.col("added")).cast("long").alias("shortfall"))


def carry_over(papers: DataFrame, ledger: DataFrame, subscriptions: DataFrame, taken: DataFrame) -> DataFrame:
    """The cache of the next run: unseen, relevant candidates in context that this run didn't take, the first 500 of each field and mode."""
    fresh = unseen(papers, ledger).join(taken.where("passed = 1").select("field_slug", "seq"), ["field_slug", "seq"], "left_anti")
    good = ranking.scored(fresh, subscriptions).where("relevance > 0 AND issue = ''").withColumn("pool", F.concat_ws("/", "field_slug", "scan_mode"))
    best = ranking.rank(good.withColumn("_field", F.col("field_slug")).withColumn("field_slug", F.col("pool")), ranking.IMPORTANT, "n", ranking.CACHE_ROWS)
    return papers.join(best.select(F.col("_field").alias("field_slug"), "seq"), ["field_slug", "seq"], "left_semi")


def report_rows(consumed: DataFrame, papers: DataFrame) -> DataFrame:
    """A row of the run report per candidate that was tried: identity, scores, outcome and reasons."""
    kept = papers.select("field_slug", "seq", "url", "doi", "arxiv_id", "venue")
    return consumed.join(kept, ["field_slug", "seq"]).select(
        "field_slug", F.struct("seq", "title", "published", "venue", "url", "doi", "arxiv_id", "citations", "relevance", "matched", "fulltext").alias("paper"),
        F.when(F.col("passed") == 1, "added").otherwise("skipped").alias("outcome"), F.element_at(F.array(F.lit("important"), F.lit("recent"), F.lit("fallback")), F.col("phase") + 1).alias("selection"), "reasons",
    )


def manual_entry(papers: DataFrame, matched: Column, slug: Column, added_on: Column) -> DataFrame:
    """Ledger rows of papers added by hand: relevance is the number of matched keywords, and the page is named by the title's slug."""
    return papers.withColumn("matched_keywords", matched).select(
        "field_slug", "title", "published", "venue", "url", "pdf_url", "arxiv_id", "doi", "citations", "authors", "matched_keywords",
        F.size("matched_keywords").cast("long").alias("relevance"), F.lit("manual").alias("selection"), F.concat("field_slug", F.lit("/"), slug, F.lit(".html")).alias("page_file"), added_on.alias("added_on"),
    )
