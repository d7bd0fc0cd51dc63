"""Ranking, quotas, the selection queue and its consumption, over all fields in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bibweave.functions.identity import fulltext_score, paper_key
from bibweave.functions.match import context_issue, literal_matches, matched_keywords, relevance
from bibweave.session import cut_lineage

MAX_K, PAGE_CAP, CACHE_ROWS = 20, 100, 500
MOST_FIELDS = 200  # subscriptions up to which keywords become literal patterns of the plan


def clamp_k(k: Column) -> Column:
    return F.greatest(F.lit(1), F.least(k, F.lit(MAX_K)))


def important_quota(k: Column) -> Column:
    return F.when(k <= 1, 0).otherwise(F.least(F.lit(2), k - 1))


def remaining_quotas(k: Column, total: Column, important: Column, recent: Column) -> tuple[Column, Column]:
    """(important, recent) slots left after what was added today; what important can't use goes to recent."""
    left = F.greatest(F.lit(0), k - total)
    i = F.least(left, F.greatest(F.lit(0), important_quota(k) - important))
    return i, left - i


def scored(papers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Papers of subscribed fields with their key, relevance, matched keywords, context issue and full-text score.

    Up to ``MOST_FIELDS`` subscriptions their keywords are literals of the plan,
    whose patterns are compiled once; more of them are joined as columns.
    """
    listed = subscriptions.select("username", "keywords").limit(MOST_FIELDS + 1).collect()
    specs = subscriptions.select(F.col("username").alias("field_slug"), "keywords", "ambiguous_keywords", "context_keywords", "ambiguous_context_groups", clamp_k(F.col("k").cast("int")).alias("k"))
    joined = papers.join(specs, "field_slug")
    if len(listed) <= MOST_FIELDS:
        relevant, matched = literal_matches(F.col("field_slug"), F.col("title"), F.col("abstract"), {r.username: list(r.keywords or []) for r in listed})
    else:
        relevant, matched = (f(F.col("title"), F.col("abstract"), F.col("keywords")) for f in (relevance, matched_keywords))
    kept = [c for c in ("scan_mode",) if c in papers.columns]
    made = joined.select("*", matched.alias("matched"), relevant.alias("relevance"))
    return made.select(
        "field_slug", "seq", "title", "published", "citations", "k", "relevance", "matched", *kept,
        context_issue(F.col("title"), F.col("abstract"), F.col("matched"), F.col("ambiguous_keywords"), F.col("context_keywords"), F.col("ambiguous_context_groups")).alias("issue"),
        fulltext_score(F.col("arxiv_id"), F.col("pdf_url"), F.col("doi")).alias("fulltext"), paper_key(F.col("doi"), F.col("arxiv_id"), F.col("title")).alias("paper_key"),
    )


def _desc(*names: str) -> list[Column]:
    return [F.col(n).desc() for n in names] + [F.col("seq").asc()]


IMPORTANT = ("relevance", "fulltext", "citations", "published")
RECENT = ("relevance", "fulltext", "published")


def numbered(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """Row numbers per group, without a task per group: a range-partitioned sort, numbers within each range, and the ranges' counts added up.

    ``order`` must be total. Only the counts (a row per group and range) are accumulated in one place.
    """
    part = F.spark_partition_id().alias("_part")
    placed = cut_lineage(rows.repartitionByRange(group, *order).select("*", part))
    counts = placed.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    within = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    return placed.withColumn(name, within).join(offsets, [group, "_part"]).withColumn(name, (F.col(name) + F.col("_ahead")).cast("int")).drop("_part", "_ahead")


def sort_modes(rows: DataFrame, group: str, tie: str, modes: dict[str, bool]) -> DataFrame:
    """(tie, by_<column>): the place of each row of a group in several orders; ``modes`` tells which descend."""
    out = None
    for name, descends in modes.items():
        order = [F.col(name).desc() if descends else F.col(name).asc(), F.col(tie).asc()]
        one = numbered(rows.select(tie, group, name), group, order, f"by_{name}").select(tie, f"by_{name}")
        out = one if out is None else out.join(one, tie)
    return out


def rank(rows: DataFrame, by: tuple[str, ...], name: str, limit: int | None = None) -> DataFrame:
    """Rank per field. Of a limit up to a few hundred only the first rows of each task are shuffled; else see ``numbered``."""
    if limit is None:
        return numbered(rows, "field_slug", _desc(*by), name)
    return rows.withColumn(name, F.row_number().over(Window.partitionBy("field_slug").orderBy(*_desc(*by)))).where(F.col(name) <= limit)


def first_of_key(rows: DataFrame, by: tuple[str, ...], keys: tuple[str, ...] = ("field_slug", "paper_key")) -> DataFrame:
    """Of several rows with one key the one that ranks first; a work is taken once."""
    best = rows.groupBy(*keys).agg(F.max(F.struct(*by, (-F.col("seq")).alias("neg"))).alias("b")).select(F.col(keys[0]).alias("_f"), (-F.col("b.neg")).alias("_s"))
    return rows.join(best, (rows.field_slug == best._f) & (rows.seq == best._s), "left_semi")


def selection_queue(rows: DataFrame, quotas: DataFrame | None = None) -> DataFrame:
    """Order in which works are tried: important quota, recent quota, then the rest by importance.

    ``rows`` may tell by ``in_important`` and ``in_recent`` to which pools they belong,
    else all belong to both.  ``quotas`` (field_slug, important_left, recent_left) are
    what is left of a day; without them a field has its full quotas.  Of rows with one
    key only the first by importance is queued.
    """
    for pool in ("in_important", "in_recent"):
        if pool not in rows.columns:
            rows = rows.withColumn(pool, F.lit(True))
    if quotas is None:
        rows = rows.withColumns({"important_left": important_quota(F.col("k")), "recent_left": F.col("k") - important_quota(F.col("k"))})
    else:
        rows = rows.join(quotas.select("field_slug", "important_left", "recent_left"), "field_slug")
    x = numbered(first_of_key(rows.where("relevance > 0"), IMPORTANT), "field_slug", _desc(*IMPORTANT), "ri")
    # Quotas take a few rows of each field: limits on row numbers let tasks drop the others before a shuffle.
    take = lambda pool, by, n: pool.withColumn("at", F.row_number().over(Window.partitionBy("field_slug").orderBy(*_desc(*by)))).where(F.col("at") <= MAX_K).where(F.col("at") <= F.col(n))
    important = take(x.where("in_important"), IMPORTANT, "important_left").select("field_slug", "seq", "ri", "at", "important_left", "recent_left", F.lit(0).alias("phase"))
    recent = take(x.where("in_recent").join(important.select("field_slug", "seq"), ["field_slug", "seq"], "left_anti"), RECENT, "recent_left").select("field_slug", "seq", "ri", "at", "important_left", "recent_left", F.lit(1).alias("phase"))
    first = important.unionByName(recent)
    # What quotas leave free is filled by importance: at most MAX_K more of each field.
    taken = first.groupBy("field_slug").agg(F.collect_list("ri").alias("ris"), F.count("*").alias("n"))  # at most 2 * MAX_K
    marked = x.join(first.select("field_slug", "seq", "phase", "at"), ["field_slug", "seq"], "left").join(taken, "field_slug", "left")
    ahead = F.coalesce(F.size(F.filter("ris", lambda r: r < F.col("ri"))), F.lit(0))
    sizes = important.groupBy("field_slug").agg(F.count("*").alias("n_important"))
    marked = marked.join(sizes, "field_slug", "left")
    place = (
        F.when(F.col("phase") == 0, F.col("at"))
        .when(F.col("phase") == 1, F.coalesce("n_important", F.lit(0)) + F.col("at"))
        .otherwise(F.coalesce("n", F.lit(0)) + F.col("ri") - ahead)
    )
    return marked.withColumn("queue_pos", place.cast("int")).withColumn("phase", F.coalesce("phase", F.lit(2))).drop("ris", "n", "at", "n_important", "ri", "in_important", "in_recent", "important_left", "recent_left")


def first_passing(queue: DataFrame, passed: Column, k: Column, partition: str = "field_slug", order: str = "queue_pos") -> DataFrame:
    """What a consumer looks at that stops after k records have passed: everything before the k-th success, and it."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    seen = queue.withColumn("passed", passed.cast("int")).withColumn("before", F.coalesce(F.sum("passed").over(w), F.lit(0)))
    return seen.where(F.col("before") < k)


def waves(queue: DataFrame, passed: Column, k: Column, wave: int = 4) -> DataFrame:
    """The same, a wave of the queue at a time: expensive checks are only made for waves that are still needed.

    A field whose k successes lie in earlier waves has no row in a later one, so at
    most a wave more than needed is checked.
    """
    at = F.floor((F.col("queue_pos") - 1) / wave)
    per_wave = queue.withColumn("wave", at).withColumn("passed", passed.cast("int"))
    done = per_wave.groupBy("field_slug", "wave").agg(F.sum("passed").alias("n"))
    before = Window.partitionBy("field_slug").orderBy("wave").rowsBetween(Window.unboundedPreceding, -1)
    open_waves = done.select("field_slug", "wave", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("had"))
    return first_passing(per_wave.join(open_waves, ["field_slug", "wave"]).where(F.col("had") < k).drop("had", "wave"), F.col("passed"), k)


def global_cap(taken: DataFrame, fields: DataFrame, cap: int = PAGE_CAP) -> DataFrame:
    """Successes in the order of the fields, up to a cap over all of them.

    Fields are counted first; only the counts are accumulated over all fields.
    """
    ok = taken.where("passed = 1")
    order = fields.select(F.col("username").alias("field_slug"), "field_idx")
    per_field = ok.groupBy("field_slug").count().join(order, "field_slug")
    ahead = per_field.withColumn("ahead", F.coalesce(F.sum("count").over(Window.orderBy("field_idx").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row per field
    placed = ok.join(ahead.select("field_slug", "field_idx", "ahead"), "field_slug")
    within = placed.withColumn("page_no", F.col("ahead") + F.row_number().over(Window.partitionBy("field_slug").orderBy("queue_pos")))
    return within.where(F.col("page_no") <= cap)
