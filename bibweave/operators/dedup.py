"""Resolving duplicate records by alias: classes, sequential first-match clusters, merges.

Both ways start from classes of records that share an alias, found by iterated
aggregation; the sequential clusterer only ever looks at records of one class,
so its result is the same as over the whole input.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibweave.functions.identity import fulltext_score, normalize_arxiv_id, normalize_doi, normalize_title, doi_arxiv_id, paper_aliases
from bibweave.session import cut_lineage, drop_cut


def alias_classes(rows: DataFrame, group: str, seq: str, aliases: str) -> DataFrame:
    """(group, seq, root): least seq of each connected class of rows that share an alias within a group.

    Rounds alternate between rows and aliases.  Minima are combined in the tasks
    before they are shuffled; where the rows of a hot alias get its minimum back,
    the side with the minima has one row an alias, and AQE splits the other.
    """
    links = cut_lineage(rows.select(F.col(group).alias("g"), F.col(seq).alias("s"), F.explode(aliases).alias("alias")).distinct())
    labels = cut_lineage(rows.select(F.col(group).alias("g"), F.col(seq).alias("s"), F.col(seq).alias("root")))
    while True:
        reach = links.join(labels, ["g", "s"])
        by_alias = reach.groupBy("g", "alias").agg(F.min("root").alias("near"))
        by_row = links.join(by_alias, ["g", "alias"]).groupBy("g", "s").agg(F.min("near").alias("near"))
        met = labels.join(by_row, ["g", "s"], "left").select("g", "s", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("next"))
        jump = labels.select("g", F.col("s").alias("next"), F.col("root").alias("far"))
        moved = met.join(jump, ["g", "next"], "left").select("g", "s", "old", F.least("next", F.coalesce("far", "next")).alias("root"))
        moved = cut_lineage(moved)
        drop_cut(labels)
        labels = moved.select("g", "s", "root")
        labels.cut_path = moved.cut_path
        if not moved.where("old <> root").limit(1).count():
            return labels.select(F.col("g").alias(group), F.col("s").alias(seq), "root")


def _first_match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sequential clustering, class by class: the first alias that is taken decides; a merge claims all aliases of the merged record.

    Rows come sorted by class and arrival; only the aliases of the current class are held.
    """
    current: tuple | None = None
    owner: dict[str, int] = {}
    merged: dict[int, dict] = {}
    for pdf in batches:
        out = []
        for row in pdf.itertuples():
            if (row.field, row.root) != current:
                current, owner, merged = (row.field, row.root), {}, {}
            claim = list(row.aliases)
            home = next((owner[a] for a in claim if a in owner), None)
            mine = {"t": row.t, "d": row.d, "x": row.x, "dx": row.dx, "score": row.score, "has": row.has}
            if home is None:
                home = row.seq
                merged[home] = mine
            else:
                cur = merged[home]
                swap = mine["score"] > cur["score"] or mine["score"] == cur["score"] and mine["has"] and not cur["has"]
                base, other = (mine, cur) if swap else (cur, mine)
                now = {"t": base["t"], **{k: base[k] or other[k] for k in ("d", "x", "dx")}, "score": max(mine["score"], cur["score"]), "has": mine["has"] or cur["has"]}
                merged[home] = now
                claim += [f"{k}:{v}" for k, v in (("title", now["t"]), ("doi", now["d"]), ("arxiv", now["x"]), ("arxiv", now["dx"])) if v]
            for a in claim:
                owner[a] = home
            out.append((row.field, row.seq, home))
        yield pd.DataFrame(out, columns=["field_slug", "seq", "cluster"])


def sequential_clusters(papers: DataFrame) -> DataFrame:
    """(field_slug, seq, cluster) of first-match clustering per field; records without an alias stay alone."""
    rows = papers.select("field_slug", "seq", paper_aliases(F.col("title"), F.col("doi"), F.col("arxiv_id")).alias("aliases"), "title", "doi", "arxiv_id", "pdf_url", "abstract")
    classes = alias_classes(rows, "field_slug", "seq", "aliases")
    ready = rows.join(classes, ["field_slug", "seq"]).select(
        F.col("field_slug").alias("field"), "seq", "root", "aliases",
        normalize_title(F.col("title")).alias("t"), normalize_doi(F.col("doi")).alias("d"), normalize_arxiv_id(F.col("arxiv_id")).alias("x"), doi_arxiv_id(F.col("doi")).alias("dx"),
        fulltext_score(F.col("arxiv_id"), F.col("pdf_url"), F.col("doi")).alias("score"), (F.length(F.trim("abstract")) > 0).alias("has"),
    )
    ordered = ready.repartition("field", "root").sortWithinPartitions("field", "root", "seq")
    return ordered.mapInPandas(_first_match, "field_slug string, seq long, cluster long")


ATTRIBUTES = ("pdf_url", "doi", "arxiv_id", "url", "venue", "published", "abstract")


def merge_clusters(papers: DataFrame, cluster: str) -> DataFrame:
    """One merged record per cluster: base changes to a record with better full text (or the first abstract), gaps are filled.

    The fold is expressed as windows and aggregates: an attribute is that of the
    last base that has it, else of the first record that has it.
    """
    score = fulltext_score(F.col("arxiv_id"), F.col("pdf_url"), F.col("doi"))
    has = F.length(F.trim("abstract")) > 0
    before = Window.partitionBy(cluster).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = papers.withColumn("_s", score).withColumn("_h", has)
    rows = rows.withColumn("_best", F.max("_s").over(before)).withColumn("_had", F.coalesce(F.max("_h").over(before), F.lit(False)))
    rows = rows.withColumn("_base", F.col("_best").isNull() | (F.col("_s") > F.col("_best")) | ((F.col("_s") == F.col("_best")) & F.col("_h") & ~F.col("_had")))

    def attribute(name: str) -> Column:
        there = F.col(name) != ""
        return F.coalesce(F.max_by(F.when(there & F.col("_base"), F.col(name)), F.when(there & F.col("_base"), F.col("seq"))), F.min_by(F.when(there, F.col(name)), F.when(there, F.col("seq"))), F.lit("")).alias(name)

    base = lambda name: F.max_by(name, F.when(F.col("_base"), F.col("seq"))).alias(name)
    return rows.groupBy(cluster).agg(F.min("seq").alias("seq"), F.max("citations").alias("citations"), F.count("*").alias("members"), base("source"), base("title"), *map(attribute, ATTRIBUTES))


def merge_ledger(ledger: DataFrame, group: str) -> DataFrame:
    """One entry per class: attributes from the newest entry that has them, dates and file from the oldest, which survives."""
    order = F.struct(F.when(F.col("added_at") != "", F.col("added_at")).otherwise(F.col("added_on")), "paper_key", "seen_id")
    newest = lambda c: F.coalesce(F.max_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", order)), F.lit("")).alias(c)
    oldest = lambda c: F.min_by(c, order).alias(c)
    texts = ("title", "venue", "url", "pdf_url", "arxiv_id", "doi", "pub_date", "tldr", "basis")
    return ledger.groupBy(group).agg(F.min_by("seen_id", order).alias("survivor"), F.max(F.coalesce("citations", F.lit(0))).alias("citations"), F.count("*").alias("members"), *map(newest, texts), *map(oldest, ("paper_key", "page_file", "added_on", "added_at")))


def remove_entries(ledger: DataFrame, arxiv_id: str | None = None, slug: str | None = None, title_part: str | None = None) -> DataFrame:
    """The ledger without the entries that a selector names; without a selector nothing is removed."""
    hit = F.lit(False)
    if arxiv_id:
        hit = hit | (normalize_arxiv_id(F.col("arxiv_id")) == normalize_arxiv_id(F.lit(arxiv_id)))
    if slug:
        hit = hit | F.col("page_file").endswith(f"{slug}.html")
    if title_part:
        hit = hit | F.lower("title").contains(title_part.lower())
    return ledger.where(~F.coalesce(hit, F.lit(False)))
