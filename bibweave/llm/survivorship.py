"""Problem 2: the best value of each field of a group of duplicate records.

Method: fields are unpivoted to long rows, each row votes for its normalised
value with the trust of its source times a decay by age, votes are summed per
value, the winner of each field is chosen with max_by, and the winners are
pivoted back to one surviving record.  Values that only fill a gap (place
holders, publishers' notices, landing pages, impossible counts) get no vote, and values
cut short vote only where no complete value exists.  The half life is short, so
the newest genuine value wins and older equal values and trust break near ties.

A notice is told by evidence: it has hardly a word of its record's title, and every
sentence of it stands in the abstracts of several other authors too.

Everything is aggregation with map-side combining on (group, field, value) and
then (group, field): a group of any size never meets in one task.

Defined results: members listed twice count once; ids without a record and null
groups give nothing; null fields give no vote; ties go to the newest, then to the
smallest id; a group without a real value of a field has no row for it; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("citations", "venue", "pdf_url", "abstract")

# What stands in a venue field in place of a venue.
NO_VENUE = ["", "-", "?", "n/a", "na", "none", "null", "tbd", "tba", "unknown", "untitled", "arxiv", "arxiv (preprint)", "corr", "preprint", "preprint server", "未取得"]
NOT_YET = r"^(submitted to|under review|in preparation|manuscript)\b"
NO_ABSTRACT = r"^(n/?a|tba|tbd|none|null|-+|see pdf|abstract[.:]?|(no abstract|abstract not|keine kurzfassung|kein abstract|pas de résumé|résumé non).*|要旨なし)$"
CUT_MARK = r"(…|\.\.\.?|\[\s*\.*\s*\]|\[…\]|\(more\))\s*$"
MAX_CITATIONS = 1_000_000


@dataclass(frozen=True)
class Policy:
    """Trust of each source (others get ``default_trust``), and the half life of a vote in seconds."""

    trust: dict[str, float] = field(default_factory=lambda: {"crossref": 1.0, "openalex": 0.98, "semanticscholar": 0.96, "dblp": 0.96, "arxiv": 0.95})
    default_trust: float = 0.9
    half_life_s: float = 600.0


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^<>]{0,40}>", " "), r"(?U)\s+", " "))


def _letters(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[^\p{L}\p{N}]+", "")


def genuine(name: str, value: Column, title: Column) -> Column:
    """2: genuine and complete; 1: genuine but cut short; 0: not a real value."""
    if name == "citations":
        count = value.cast("long")
        return F.when((count > 0) & (count <= MAX_CITATIONS), 2).otherwise(0)
    plain = _plain(value)
    if name == "venue":
        low = F.lower(plain)
        return F.when(low.isin(NO_VENUE) | low.rlike(NOT_YET), 0).when(plain.rlike(CUT_MARK), 1).otherwise(2)
    if name == "pdf_url":
        return F.when(F.trim(F.coalesce(value, F.lit(""))).rlike(r"(?i)^https?://[^/?#\s]+/([^?#\s]*/)?[^/?#\s]+\.pdf$"), 2).otherwise(0)
    body = F.trim(F.regexp_replace(plain, r"(?i)^abstract\s*[.:]\s*", ""))
    sentence = F.length(body) >= F.when(body.rlike(r"[぀-ヿ一-鿿]"), 12).otherwise(30)
    ended = body.rlike(r"[.!?。！？][\"'”’)\]]*$") & ~body.rlike(CUT_MARK) & (F.coalesce(value, F.lit("")).rlike(r"\S$"))
    fake = ~sentence | F.lower(body).rlike(NO_ABSTRACT) | (_letters(body) == _letters(title))
    return F.when(fake, 0).when(ended, 2).otherwise(0)


def _normal(name: str, value: Column) -> Column:
    return value.cast("string") if name == "citations" else F.lower(_plain(value))


def notices(records: DataFrame, suspects: DataFrame, authors: int = 3) -> DataFrame:
    """(rec_id) of abstracts that are a publisher's notices: each of their sentences stands in texts of several other authors.

    ``suspects``: (rec_id, abstract) of texts that have hardly a word of their title. Sentences are counted over all records.
    """

    def sentences(df: DataFrame, *keep: str) -> DataFrame:
        own = F.transform(F.split(_plain(F.col("abstract")), r"(?<=[.!?])\s+"), lambda x: F.xxhash64(_letters(x)))
        return df.select(*keep, F.explode(F.array_distinct(own)).alias("sentence"))

    asked = sentences(suspects, "rec_id")
    first = F.get("authors", F.lit(0)) if "authors" in records.columns else F.lit(None).cast("string")
    author = F.xxhash64(_letters(F.coalesce(first, "title")))
    seen = sentences(records.where("abstract IS NOT NULL").select(author.alias("author"), "abstract"), "author").join(asked.select("sentence").distinct(), "sentence", "left_semi")
    common = seen.distinct().groupBy("sentence").agg(F.count("*").alias("n")).where(F.col("n") >= authors)
    return asked.join(common, "sentence", "left").groupBy("rec_id").agg(F.bool_and(F.col("n").isNotNull()).alias("all")).where("all").select("rec_id")


def _has_title_words() -> Column:
    """Whether the abstract has two longer words of its title, as one may be met by chance; texts written without blanks count as having them."""
    words = F.filter(F.split(F.lower(F.coalesce("title", F.lit(""))), r"[^\p{L}]+"), lambda w: F.length(w) >= 5)
    low = F.lower("abstract")
    return (F.size(F.filter(words, lambda w: F.contains(low, w))) >= 2) | F.col("abstract").rlike(r"[぀-ヿ一-鿿]")


def votes(groups: DataFrame, records: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Long rows (group_id, field_name, norm, level, rec_id, fetched_at, trust) of all real values."""
    members = groups.select(F.col("group_id").cast("long"), F.col("rec_id").cast("long")).where("group_id IS NOT NULL AND rec_id IS NOT NULL").distinct()
    trust = F.lit(policy.default_trust)
    for source, weight in policy.trust.items():
        trust = F.when(F.lower(F.trim("source")) == source, weight).otherwise(trust)
    unpivoted = F.array(
        *(
            F.struct(
                F.lit(name).alias("field_name"),
                genuine(name, F.col(name), F.col("title")).alias("level"),
                F.xxhash64(_normal(name, F.col(name))).alias("norm"),
            )
            for name in FIELDS
        )
    )
    # The texts are looked at after the join: only members of groups pay for it, and the generator keeps each test from running twice.
    members_of = records.select(F.col("rec_id").cast("long").alias("rec_id"), "title", F.col("abstract"))
    suspects = members_of.where("length(abstract) >= 30").where(~_has_title_words()).join(members.select("rec_id").distinct(), "rec_id", "left_semi").select("rec_id", "abstract")
    fake = notices(records, suspects).withColumn("field_name", F.lit("abstract"))
    plain = records.select(F.col("rec_id").cast("long").alias("rec_id"), F.col("fetched_at").cast("timestamp").alias("fetched_at"), trust.alias("trust"), "title", *FIELDS)
    joined = members.join(plain, "rec_id").select("group_id", "rec_id", "fetched_at", "trust", F.explode(unpivoted).alias("v"))
    return joined.select("group_id", "rec_id", "fetched_at", "trust", "v.*").where("level > 0").join(fake, ["rec_id", "field_name"], "left_anti")


def winners(groups: DataFrame, records: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """(group_id, field_name, rec_id, votes): the member whose value survives, per group and field."""
    cast = votes(groups, records, policy).withColumn("at", F.coalesce(F.unix_micros("fetched_at") / 1e6, F.lit(0.0)))
    # Only the best level votes, and age counts from the newest vote of that level.
    top = cast.groupBy("group_id", "field_name").agg(F.max(F.struct("level", "at")).alias("top")).select("group_id", "field_name", F.col("top.level").alias("level"), F.col("top.at").alias("newest_at"))
    live = cast.join(top, ["group_id", "field_name", "level"])
    decay = F.pow(F.lit(2.0), -(F.col("newest_at") - F.col("at")) / F.lit(policy.half_life_s))
    per_value = live.groupBy("group_id", "field_name", "norm").agg(F.sum(F.col("trust") * decay).alias("votes"), F.max(F.struct("at", "trust", (-F.col("rec_id")).alias("neg_id"))).alias("newest"))
    return per_value.groupBy("group_id", "field_name").agg(F.max_by(-F.col("newest.neg_id"), F.struct("votes", "newest")).alias("rec_id"), F.max("votes").alias("votes"))


def survivors(groups: DataFrame, records: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """One record per group that has a real value: each field from its winner, pivoted back."""
    won = winners(groups, records, policy)
    values = records.select(F.col("rec_id").cast("long").alias("rec_id"), *(F.col(f).cast("long" if f == "citations" else "string").alias(f) for f in FIELDS))
    joined = won.join(values, "rec_id")
    return joined.groupBy("group_id").agg(*(F.max(F.when(F.col("field_name") == f, F.col(f))).alias(f) for f in FIELDS))
