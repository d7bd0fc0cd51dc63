"""Problem 4: matching the records of two sources that share no key.

Method: a deterministic cascade of rules, each an exact join on a weaker
combination of attributes: the full title; identifier, author and year; a branch
of a min-hash forest over the title's letters and an author; the start of the
title and an author.  Records without authors pair on longer branches alone.
Keys are made once for each rule and shuffled once.  Resolved are not records,
as a work may have several rows on both sides that only a weaker rule finds, but
pairs: candidates that an earlier rule has put into one class are taken out
before titles are compared.  Candidates are checked title against title.
Resolved records form classes, and the pairs are those of paper and registry
record within a class.  The confidence of a rule is its precision among pairs
of records with known groups, smoothed by Laplace.

No rule pairs the rows of one key with each other before titles that are equal
have been put together, and each key holds nearly a whole title and an author,
so blocks are small whatever the size of the sources.

Defined results: null and blank titles and mere headings match only by
identifier and author; records without authors match by their title alone, or
by an identifier of one author; ties in a cut title go to the class with the same
year, then to the least; a title that goes on with whole words is the same work
only if many titles end in these words (see ``natural_endings``); repeated rows
count once; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.forest import KEYS, index_rows, probe_rows, slip_rows
from bibweave.llm.works import GOES_ON, SAME, START, anchored, check_pairs, components, featurise, identified, identifier_edges, may_agree, natural_endings, sketched, titles_of, ways
from bibweave.session import cut_lineage, drop_cut

RULES = {1: "same title", 2: "identifier, author and year", 3: "title but for some slips, and an author", 4: "title but for some slips, no author", 5: "start of the title, and an author"}
LONGEST, APART = 1_023, 16  # lengths above the first count as equal; titles of more different lengths are no slips of each other, nor cut by a word or two
TREES, DEPTH, BARE_DEPTH = 12, 3, 4  # branches, and min-hashes of one
AGREE = 2  # branches that a pair must share: 88 % of titles with four slips in 56 letters do, 99.7 % of those whose trigrams are four fifths the same


def candidates(anchors: DataFrame) -> DataFrame:
    """(a, b, rule) of nodes that share a key, a < b, each pair once with its strongest rule."""
    rows = anchors.select("node", "letters", "breaks", "cut", "first", "least")
    slips = rows.mapInArrow(sketched(slip_rows(DEPTH, TREES)), KEYS)
    # A title that another one is the start of is longer; of whole titles only slips may differ.
    length = lambda c: f"({c} & {LONGEST})"
    one_key = F.shiftright("ka", 32) == F.shiftright("kb", 32)
    # Pairs of different titles that share a key grow faster than the input, so they are dropped before anything is shuffled.
    may = lambda a, b: may_agree("ka", "kb", length(a), length(b))
    left, right = (slips.select(F.col("k").alias(f"k{s}"), F.col("node").alias(s)) for s in ("a", "b"))
    same = left.join(right, one_key).where(f"{length('b')} - {length('a')} BETWEEN 0 AND {APART} AND ({length('a')} < {length('b')} OR a < b) AND {may('a', 'b')}")
    same = same.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(3).alias("rule"))
    asked = rows.mapInArrow(sketched(probe_rows(BARE_DEPTH)), KEYS).select(F.col("k").alias("ka"), F.col("node").alias("p"), F.col("role").alias("rp"))
    index = rows.mapInArrow(sketched(index_rows(BARE_DEPTH)), KEYS).select(F.col("k").alias("kb"), F.col("node").alias("x"), F.col("role").alias("rx"))
    start = f"rp < 3 AND NOT (rp = 1 AND rx = 1) AND ({length('p')} < {length('x')} OR {length('p')} = {LONGEST})"
    met = index.join(asked.hint("shuffle_hash"), one_key).where(f"p <> x AND ({start} OR rp > 2 AND abs({length('p')} - {length('x')}) <= 4) AND {may('p', 'x')}")
    met = met.select(F.least("p", "x").alias("a"), F.greatest("p", "x").alias("b"), F.lit(4).alias("rule"))
    slips, other = F.count_if(F.col("rule") == 3), F.count_if(F.col("rule") == 4)
    met_in = same.union(met).groupBy("a", "b").agg(slips.alias("slips"), other.alias("other")).where(f"slips >= {AGREE} OR other > 0")
    return met_in.select("a", "b", F.when(F.col("slips") >= AGREE, 3).otherwise(4).alias("rule"))


def cascade(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges with their rule, roots of all resolved nodes) of featurised records."""
    by_ident = cut_lineage(identifier_edges(identified(records)))
    # Keys name a title by a small number, its least record, with the length of the title in the last bits.
    length = F.least(F.length("letters"), F.lit(LONGEST)).cast("long")
    titles = cut_lineage(titles_of(records).withColumn("number", F.col("least") * (LONGEST + 1) + length))
    anchors = cut_lineage(anchored(records, titles, "number"))
    placed = titles.join(components(by_ident), "node", "left").withColumn("root", F.coalesce("root", "node"))
    checked = cut_lineage(check_pairs(candidates(anchors), placed, "rule", by="number"))
    drop_cut(anchors)
    cut_here = cut_lineage(natural_endings(checked, titles).withColumn("ends", F.lit(True)))
    checked = cut_lineage(
        checked.join(cut_here, "rest", "left")
        .where(f"level <> {GOES_ON} OR ends")
        .select("a", "b", "na", "nb", F.when(F.col("level") == GOES_ON, START).otherwise(F.col("level")).alias("level"), F.when(F.col("level") == SAME, F.col("rule")).otherwise(5).alias("rule"))
    )
    edges = by_ident.withColumn("rule", F.lit(2)).unionByName(checked.where(F.col("level") == SAME).select("a", "b", "rule"))
    roots = components(edges)
    attached = ways(checked, roots, titles)
    whole = components(edges.select("a", "b").union(attached))
    return edges, whole


def rule_confidence(edges: DataFrame, records: DataFrame, groups: DataFrame) -> DataFrame:
    """(rule, confidence): labelled precision of each rule, smoothed."""
    known = groups.select(F.col("group_id").alias("g"), F.col("rec_id").cast("long").alias("id")).where("g IS NOT NULL").distinct()
    labelled = records.where("source = 0").select("id", "node").join(known, "id").groupBy("node").agg(F.min("g").alias("g"), F.max("g").alias("top"), F.count("*").alias("n"))
    a = labelled.select(F.col("node").alias("a"), F.col("g").alias("ga"))
    b = labelled.select(F.col("node").alias("b"), F.col("g").alias("gb"))
    by_edge = edges.join(a, "a").join(b, "b").groupBy("rule").agg(F.count_if(F.col("ga") == F.col("gb")).alias("yes"), F.count("*").alias("n"))
    same = labelled.where("n > 1").agg(F.count_if(F.col("g") == F.col("top")).alias("yes"), F.count("*").alias("n")).select(F.lit(1).alias("rule"), "yes", "n")
    rules = records.sparkSession.createDataFrame([(r,) for r in RULES], "rule int")
    known_rules = rules.join(by_edge.unionByName(same), "rule", "left")
    return known_rules.select("rule", ((F.coalesce("yes", F.lit(0)) + 1) / (F.coalesce("n", F.lit(0)) + 2)).alias("confidence"))


def match_sources(papers: DataFrame, registry: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """(rec_id, bib_id, rule, confidence) of all pairs of one work."""
    none = F.lit("")
    left = featurise(papers, "rec_id", "title", "authors", "published", F.col("doi"), F.col("arxiv_id")).withColumn("source", F.lit(0))
    right = featurise(registry, "bib_id", "title", "authors", "published", F.col("doi"), none).withColumn("source", F.lit(1))
    records = cut_lineage(left.unionByName(right.withColumn("node", F.when(~F.col("names_work"), F.xxhash64(F.lit("registry"), "id")).otherwise(F.col("node")))))
    edges, roots = cascade(records)
    placed = records.select("source", "id", "node").join(roots, "node", "left").select("source", "id", "node", F.coalesce("root", "node").alias("root"))
    if groups is not None:
        # A node without an edge has rule 1 with its own records; one that was only attached has rule 5.
        passed = edges.select(F.explode(F.array("a", "b")).alias("node"), "rule").groupBy("node").agg(F.min("rule").alias("rule"))
        placed = placed.join(passed, "node", "left").withColumn("rule", F.coalesce("rule", F.when(F.col("root") != F.col("node"), 5).otherwise(1)))
    else:
        placed = placed.withColumn("rule", F.lit(None).cast("int"))
    p = placed.where("source = 0").select(F.col("id").alias("rec_id"), F.col("node").alias("np"), "root", F.col("rule").alias("rp"))
    b = placed.where("source = 1").select(F.col("id").alias("bib_id"), F.col("node").alias("nb"), "root", F.col("rule").alias("rb"))
    # A record has one node and a node one root, so every pair comes out once.
    pairs = p.join(b, "root").select("rec_id", "bib_id", F.when(F.col("np") == F.col("nb"), 1).otherwise(F.greatest("rp", "rb", F.lit(2))).alias("rule"))
    if groups is None:
        return pairs.select("rec_id", "bib_id", "rule", F.lit(None).cast("double").alias("confidence")).dropDuplicates(["rec_id", "bib_id"])
    best = pairs.groupBy("rec_id", "bib_id").agg(F.min("rule").alias("rule"))
    return best.join(F.broadcast(rule_confidence(edges, records, groups)), "rule", "left").select("rec_id", "bib_id", "rule", "confidence")  # five rows
