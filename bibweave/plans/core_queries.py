"""Core queries: one per operator or group of operators, each with its SQL counterpart where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bibweave import schema
from bibweave.functions import identity as I
from bibweave.functions import labels, match, quality, texts, venue
from bibweave.operators import dedup, lookup, ranking, sections, summaries
from bibweave.plans import sql as q
from bibweave.plans.catalog import query
from bibweave.session import read_table
from bibweave.streaming import incremental

C = F.col
P = q.P


@query(f"SELECT seq, {q.ntitle('title')} AS norm_title FROM {P}")
def f1_normalize_title(spark: SparkSession, d: str) -> DataFrame:
    return schema.papers(spark, d).select("seq", I.normalize_title(C("title")).alias("norm_title"))


KEY = f"CASE WHEN doi <> '' THEN 'doi:' || lower(doi) WHEN arxiv_id <> '' THEN 'arxiv:' || lower(arxiv_id) ELSE 'title:' || {q.ntitle('title')} END"
FILE = f"CASE WHEN arxiv_id <> '' THEN arxiv_id WHEN doi <> '' THEN 'doi-' || substr(sha1(lower(doi)), 1, 12) ELSE 't-' || substr(sha1({q.ntitle('title')}), 1, 12) END"


@query(f"SELECT seq, {KEY} AS paper_key, {FILE} AS paper_id FROM {P}")
def f2_identity_keys(spark, d):
    return schema.papers(spark, d).select("seq", I.paper_key(C("doi"), C("arxiv_id"), C("title")).alias("paper_key"), I.paper_id(C("doi"), C("arxiv_id"), C("title")).alias("paper_id"))


_SLUG = r"regexp_replace(regexp_replace(regexp_replace(replace(lower(" + q.strip("title") + r"), '/', '-'), '[^A-Za-z0-9._-]+', '-', 'g'), '-{2,}', '-', 'g'), '^[-._]+|[-._]+$', '', 'g')"


@query(f"SELECT seq, CASE WHEN s = '' THEN 'item' ELSE s END AS slug FROM (SELECT seq, regexp_replace(substr({_SLUG}, 1, 80), '^[-._]+|[-._]+$', '', 'g') AS s FROM {P})")
def f5_slugify(spark, d):
    return schema.papers(spark, d).select("seq", I.slugify(C("title")).alias("slug"))


@query(f"SELECT seq, {q.ndoi('doi')} AS doi_norm, {q.narxiv('arxiv_id')} AS arxiv_norm, {q.doi_arxiv('doi')} AS doi_arxiv FROM {P}")
def f7_id_normalize(spark, d):
    return schema.papers(spark, d).select("seq", I.normalize_doi(C("doi")).alias("doi_norm"), I.normalize_arxiv_id(C("arxiv_id")).alias("arxiv_norm"), I.doi_arxiv_id(C("doi")).alias("doi_arxiv"))


def _aliases_sql(source: str, key: str, parts: list[tuple[str, str]], out: str) -> str:
    rows = " UNION ALL ".join(f"SELECT {key} AS id, {n} AS i, '{k}' || v AS x FROM (SELECT {key}, {v} AS v FROM {source}) WHERE v <> ''" for n, (k, v) in enumerate(parts))
    return f"SELECT id AS {key}, string_agg(x, '|' ORDER BY i) AS {out} FROM (SELECT id, x, min(i) AS i FROM ({rows}) GROUP BY id, x) GROUP BY id"


_PAPER_PARTS = [("title:", q.ntitle("title")), ("doi:", q.ndoi("doi")), ("arxiv:", q.narxiv("arxiv_id")), ("arxiv:", q.doi_arxiv("doi"))]


@query(_aliases_sql(P, "seq", _PAPER_PARTS, "aliases"))
def f9_aliases(spark, d):
    a = I.paper_aliases(C("title"), C("doi"), C("arxiv_id"))
    return schema.papers(spark, d).select("seq", a.alias("a")).where(F.size("a") > 0).select("seq", F.array_join("a", "|").alias("aliases"))


_K = q.strip("paper_key")


def _of(kind: str, value: str) -> str:
    return f"CASE WHEN starts_with({_K}, '{kind}') THEN {value} ELSE '' END"


_LEDGER_PARTS = [
    ("doi:", _of("doi:", q.ndoi(_K))), ("arxiv:", _of("doi:", q.doi_arxiv(_K))), ("arxiv:", _of("arxiv:", q.narxiv(_K))), ("title:", _of("title:", q.ntitle(f"substr({_K}, 7)"))),
    ("title:", q.ntitle("title")), ("doi:", q.ndoi("doi")), ("arxiv:", q.doi_arxiv("doi")), ("arxiv:", q.narxiv("arxiv_id")),
]


@query(_aliases_sql("seen_ledger", "seen_id", _LEDGER_PARTS, "aliases"))
def f10_ledger_aliases(spark, d):
    a = I.ledger_aliases(C("paper_key"), C("title"), C("doi"), C("arxiv_id"))
    return schema.ledger(spark, d).select("seen_id", a.alias("a")).where(F.size("a") > 0).select("seen_id", F.array_join("a", "|").alias("aliases"))


@query(f"SELECT seq, {q.usable('venue')} AS usable, {q.conference('venue')} AS conference FROM {P}")
def f12_usable_venue(spark, d):
    return schema.papers(spark, d).select("seq", venue.usable(C("venue")).alias("usable"), venue.is_conference(C("venue")).alias("conference"))


@query(f"SELECT seq, {q.with_year('venue', 'published')} AS venue_year FROM {P}")
def f14_venue_with_year(spark, d):
    return schema.papers(spark, d).select("seq", venue.with_year(C("venue"), C("published")).alias("venue_year"))


_COMMENT = "'Accepted at ' || venue || '; 12 pages.'"
_FOUND = r"regexp_extract(" + q.squeeze(_COMMENT) + r", '(?i)(?:accepted\s+(?:at|to|for)|to\s+appear\s+(?:at|in)|published\s+(?:at|in))\s*[:：]?\s*(.+?)(?:[.;]|$)', 1)"


@query(f"SELECT seq, regexp_replace({_FOUND}, '^[ ,]+|[ ,]+$', '', 'g') AS venue_found FROM {P} WHERE venue <> ''")
def f11_venue_from_comment(spark, d):
    p = schema.papers(spark, d).where("venue <> ''")
    return p.select("seq", venue.from_comment(F.concat(F.lit("Accepted at "), C("venue"), F.lit("; 12 pages."))).alias("venue_found"))


_CLEAN = "regexp_replace(regexp_replace(" + q.squeeze("venue") + r", '^採択先:\s*', ''), '^掲載先:\s*', '')"


@query(
    f"SELECT seq, CASE WHEN v = '' OR lower(v) IN ('unknown','n/a','none','-','未取得') OR lower(regexp_replace(v, '[\\s._-]+', '', 'g')) IN ('arxiv','arxivorg','arxivcornelluniversity') THEN '未取得' ELSE {q.with_year('v', 'published')} END AS label FROM (SELECT seq, published, {_CLEAN} AS v FROM {P})"
)
def f15_venue_label(spark, d):
    return schema.papers(spark, d).select("seq", venue.label(C("venue"), C("published")).alias("label"))


@query(f"SELECT seq, {q.ftext()} AS fulltext, coalesce(TRY_CAST(published AS BIGINT), 0) AS as_int, length(trim(abstract)) > 0 AS has_abstract, (contains(lower(pdf_url), '.pdf') OR contains(lower(pdf_url), '/pdf/')) AS pdf_like FROM {P}")
def f18_scores(spark, d):
    return schema.papers(spark, d).select(
        "seq", I.fulltext_score(C("arxiv_id"), C("pdf_url"), C("doi")).alias("fulltext"), I.tolerant_int(C("published")).alias("as_int"),
        (F.length(F.trim("abstract")) > 0).alias("has_abstract"), labels.looks_like_pdf(C("pdf_url")).alias("pdf_like"),
    )


def _case(x: str, table: dict[str, str], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = {q.lit(k)} THEN {q.lit(v)}" for k, v in table.items()) + f" ELSE {other} END"


@query(
    f"SELECT seen_id, {_case('basis', labels.BASIS, q.lit('アブストラクト'))} AS basis_label, CASE WHEN starts_with(coalesce(basis,''), 'fulltext') THEN 'fulltext' ELSE 'abstract' END AS quality, {_case('selection', labels.SELECTION, 'coalesce(selection_label, {})'.format(q.lit('')))} AS selection_name, CASE WHEN coalesce(TRY_CAST(reading_value AS BIGINT), 0) <> 0 THEN '読む価値 ' || TRY_CAST(reading_value AS BIGINT) || '/5' ELSE '' END AS reading, regexp_replace(regexp_replace(lower(coalesce(selection,'')), '[^a-z0-9_-]+', '-', 'g'), '^-+|-+$', '', 'g') AS token FROM seen_ledger"
)
def f20_labels(spark, d):
    return schema.ledger(spark, d).select(
        "seen_id", labels.basis_label(C("basis")).alias("basis_label"), labels.basis_quality(C("basis")).alias("quality"), labels.selection_label(C("selection"), C("selection_label")).alias("selection_name"),
        labels.reading_value_label(C("reading_value")).alias("reading"), labels.class_token(C("selection")).alias("token"),
    )


@query("SELECT doc_id, replace(replace(replace(replace(replace(replace(coalesce(text,''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;'), chr(10), '<br>') AS html FROM documents")
def f21_escape_html(spark, d):
    return read_table(spark, d, "documents").select("doc_id", labels.multiline(C("text")).alias("html"))


@query(f"WITH {q.SCORED} SELECT field_slug, seq, relevance, fulltext FROM scored")
def a2_relevance(spark, d):
    return ranking.scored(schema.papers(spark, d), schema.subscriptions(spark, d)).select("field_slug", "seq", "relevance", "fulltext")


@query(
    f"SELECT seq, string_agg({q.strip('kw')}, '|' ORDER BY i) AS matched FROM (SELECT p.seq, p.title, p.abstract, unnest(s.keywords) AS kw, generate_subscripts(s.keywords, 1) AS i FROM {P} p JOIN subscriptions s ON s.username = p.field_slug) WHERE {q.has_word('lower(title)', 'kw')} OR {q.has_word('lower(abstract)', 'kw')} GROUP BY seq"
)
def j2_matched_keywords(spark, d):
    s = ranking.scored(schema.papers(spark, d), schema.subscriptions(spark, d))
    return s.where(F.size("matched") > 0).select("seq", F.array_join("matched", "|").alias("matched"))


_BODY = "lower(p.title || chr(10) || p.abstract)"


@query(
    f"SELECT p.seq, len(s.context_keywords) = 0 OR EXISTS (SELECT 1 FROM (SELECT unnest(s.context_keywords) AS kw) u WHERE {q.has_word(_BODY, 'u.kw')}) AS in_context FROM {P} p JOIN subscriptions s ON s.username = p.field_slug"
)
def pred3_domain_context(spark, d):
    joined = schema.papers(spark, d).join(schema.subscriptions(spark, d).select(C("username").alias("field_slug"), "context_keywords"), "field_slug")
    return joined.select("seq", match.has_context(match.body_of(C("title"), C("abstract")), C("context_keywords")).alias("in_context"))


@query(
    f"""WITH base AS (SELECT p.seq, {_BODY} AS body, s.* EXCLUDE (k), list_distinct(list_filter(list_transform(p.matched_keywords, lambda m: lower({q.strip('m')})), lambda m: m <> '')) AS m, list_filter(list_transform(s.ambiguous_keywords, lambda m: lower({q.strip('m')})), lambda m: m <> '') AS amb FROM {P} p JOIN subscriptions s ON s.username = p.field_slug),
    g AS (SELECT seq, body, lower({q.strip('k')}) AS acro, grp FROM (SELECT seq, body, unnest(map_keys(ambiguous_context_groups)) AS k, unnest(map_values(ambiguous_context_groups)) AS grp FROM base)),
    alt AS (SELECT seq, body, acro, unnest(grp) AS terms FROM g),
    ok AS (SELECT DISTINCT seq, acro FROM (SELECT seq, acro, len(list_filter(terms, lambda t: {q.strip('t')} <> '')) AS n, (SELECT count(*) FROM (SELECT unnest(a.terms) AS t) u WHERE {q.has_word('a.body', 'u.t')}) AS hit FROM alt a) WHERE n > 0 AND hit = n),
    r AS (SELECT b.*, list_sort(list_transform((SELECT list(DISTINCT g.acro) FROM g WHERE g.seq = b.seq AND list_contains(b.m, g.acro) AND NOT EXISTS (SELECT 1 FROM ok WHERE ok.seq = g.seq AND ok.acro = g.acro)), lambda x: upper(x))) AS missing, coalesce((SELECT list(DISTINCT g.acro) FROM g WHERE g.seq = b.seq), []) AS conf,
      len(context_keywords) = 0 OR EXISTS (SELECT 1 FROM (SELECT unnest(b.context_keywords) AS kw) u WHERE {q.has_word('b.body', 'u.kw')}) AS ctx FROM base b)
    SELECT seq, CASE WHEN len(amb) = 0 OR len(m) = 0 OR NOT list_has_all(amb, m) THEN '' WHEN len(conf) > 0 AND len(coalesce(missing, [])) > 0 THEN 'required terms missing: ' || array_to_string(missing, ', ') WHEN len(conf) > 0 AND list_has_all(conf, m) THEN '' WHEN ctx THEN '' ELSE 'no context of the field: ' || array_to_string(list_sort(list_transform(m, lambda x: upper(x))), ', ') END AS issue FROM r"""
)
def pred5_context_gate(spark, d):
    specs = schema.subscriptions(spark, d).select(C("username").alias("field_slug"), "ambiguous_keywords", "context_keywords", "ambiguous_context_groups")
    j = schema.papers(spark, d).join(specs, "field_slug")
    return j.select("seq", match.context_issue(C("title"), C("abstract"), C("matched_keywords"), C("ambiguous_keywords"), C("context_keywords"), C("ambiguous_context_groups")).alias("issue"))


_PA = " UNION ALL ".join(f"SELECT seq, field_slug, '{k}' || {v} AS alias FROM {P} WHERE {v} <> ''" for k, v in _PAPER_PARTS)
_LA = " UNION ALL ".join(f"SELECT field_slug, '{k}' || {v} AS alias FROM seen_ledger WHERE {v} <> ''" for k, v in _LEDGER_PARTS)


def unseen(spark, d) -> DataFrame:
    p = schema.papers(spark, d)
    a = p.select("field_slug", "seq", F.explode(I.paper_aliases(C("title"), C("doi"), C("arxiv_id"))).alias("alias"))
    known = schema.ledger(spark, d).select("field_slug", F.explode(I.ledger_aliases(C("paper_key"), C("title"), C("doi"), C("arxiv_id"))).alias("alias")).distinct()
    hit = a.join(known, ["field_slug", "alias"], "left_semi").select("seq").distinct()
    return p.join(hit, "seq", "left_anti")


@query(f"SELECT seq, field_slug FROM {P} WHERE seq NOT IN (SELECT a.seq FROM ({_PA}) a WHERE EXISTS (SELECT 1 FROM ({_LA}) l WHERE l.field_slug = a.field_slug AND l.alias = a.alias))")
def j1_unseen(spark, d):
    return unseen(spark, d).select("seq", "field_slug")


def _ranked(spark, d, by, n):
    return ranking.rank(ranking.scored(schema.papers(spark, d), schema.subscriptions(spark, d)), by, n)


@query(f"WITH {q.SCORED} SELECT field_slug, seq, row_number() OVER (PARTITION BY field_slug ORDER BY relevance DESC, fulltext DESC, citations DESC, published DESC, seq) AS n FROM scored")
def r1_rank_important(spark, d):
    return _ranked(spark, d, ranking.IMPORTANT, "n").select("field_slug", "seq", "n")


@query(f"WITH {q.SCORED} SELECT field_slug, seq, row_number() OVER (PARTITION BY field_slug ORDER BY relevance DESC, fulltext DESC, published DESC, seq) AS n FROM scored")
def r2_rank_recent(spark, d):
    return _ranked(spark, d, ranking.RECENT, "n").select("field_slug", "seq", "n")


@query(
    f"""WITH {q.SCORED}, used AS (SELECT field_slug, paper_key FROM (SELECT *, row_number() OVER (PARTITION BY field_slug ORDER BY relevance DESC, fulltext DESC, published DESC, seq) AS r FROM scored) WHERE r <= 5),
    o AS (SELECT *, row_number() OVER (PARTITION BY field_slug, paper_key ORDER BY relevance DESC, fulltext DESC, citations DESC, published DESC, seq) AS copy_no FROM scored s WHERE relevance > 0 AND NOT EXISTS (SELECT 1 FROM used u WHERE u.field_slug = s.field_slug AND u.paper_key = s.paper_key))
    SELECT field_slug, seq, n FROM (SELECT *, row_number() OVER (PARTITION BY field_slug ORDER BY relevance DESC, fulltext DESC, citations DESC, published DESC, seq) AS n FROM o WHERE copy_no = 1) WHERE n <= k"""
)
def r3_take_ranked(spark, d):
    s = ranking.scored(schema.papers(spark, d), schema.subscriptions(spark, d))
    used = ranking.rank(s, ranking.RECENT, "r", 5).select("field_slug", "paper_key").distinct()
    rest = ranking.first_of_key(s.join(used, ["field_slug", "paper_key"], "left_anti").where("relevance > 0"), ranking.IMPORTANT)
    return ranking.rank(rest, ranking.IMPORTANT, "n", ranking.MAX_K).where("n <= k").select("field_slug", "seq", "n")


@query(
    """WITH t AS (SELECT s.username, greatest(1, least(CAST(s.k AS INTEGER), 20)) AS k, count(l.seen_id) AS total, CAST(coalesce(count_if(l.selection = 'important'), 0) AS BIGINT) AS imp, CAST(coalesce(count_if(l.selection = 'recent'), 0) AS BIGINT) AS rec FROM subscriptions s LEFT JOIN seen_ledger l ON l.field_slug = s.username AND l.added_on = (SELECT max(added_on) FROM seen_ledger) AND coalesce(l.selection,'') <> 'manual' GROUP BY ALL),
    u AS (SELECT *, greatest(0, k - total) AS remaining, CASE WHEN k <= 1 THEN 0 ELSE least(2, k - 1) END AS quota FROM t)
    SELECT username, CAST(least(remaining, greatest(0, quota - imp)) AS BIGINT) AS important_left, CAST(remaining - least(remaining, greatest(0, quota - imp)) AS BIGINT) AS recent_left FROM u"""
)
def r5_quota(spark, d):
    led = schema.ledger(spark, d)
    today = led.agg(F.max("added_on").alias("added_on"))
    added = led.join(today, "added_on").where("selection <> 'manual'").groupBy(C("field_slug").alias("username")).agg(F.count("*").alias("total"), F.count_if(C("selection") == "important").alias("imp"), F.count_if(C("selection") == "recent").alias("rec"))
    s = schema.subscriptions(spark, d).select("username", ranking.clamp_k(C("k").cast("int")).alias("k")).join(added, "username", "left").na.fill(0)
    i, r = ranking.remaining_quotas(C("k"), C("total"), C("imp"), C("rec"))
    return s.select("username", i.alias("important_left"), r.alias("recent_left"))


def queue(spark, d) -> DataFrame:
    return ranking.selection_queue(ranking.scored(schema.papers(spark, d), schema.subscriptions(spark, d)))


@query(f"WITH {q.SCORED}, {q.QUEUE} SELECT field_slug, seq, phase, queue_pos FROM queue")
def r6_selection_queue(spark, d):
    return queue(spark, d).select("field_slug", "seq", "phase", "queue_pos")


# A candidate passes if its gates are clear: context, and a text to summarise.
_PASS = "(issue = '' AND fulltext > 0)"
_TAKEN = f"taken AS (SELECT * FROM (SELECT *, coalesce(sum(CAST(passed AS INTEGER)) OVER (PARTITION BY field_slug ORDER BY queue_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT q.*, {_PASS} AS passed FROM queue q JOIN (SELECT field_slug, seq, issue, fulltext FROM gated) USING (field_slug, seq))) WHERE before < k)"


def taken(spark, d) -> DataFrame:
    return ranking.waves(queue(spark, d), (C("issue") == "") & (C("fulltext") > 0), C("k"))


@query(f"WITH {q.SCORED}, {q.GATED}, {q.QUEUE}, {_TAKEN} SELECT field_slug, seq, queue_pos, CAST(passed AS INTEGER) AS passed FROM taken")
def r7_first_k_passing(spark, d):
    return taken(spark, d).select("field_slug", "seq", "queue_pos", "passed")


@query(
    f"WITH {q.SCORED}, {q.GATED}, {q.QUEUE}, {_TAKEN}, o AS (SELECT username, row_number() OVER (ORDER BY username) AS field_idx FROM subscriptions), n AS (SELECT t.field_slug, seq, row_number() OVER (ORDER BY field_idx, queue_pos) AS page_no FROM taken t JOIN o ON o.username = t.field_slug WHERE passed) SELECT * FROM n WHERE page_no <= 100"
)
def r8_global_cap(spark, d):
    fields = schema.subscriptions(spark, d).select("username", F.row_number().over(Window.orderBy("username")).alias("field_idx"))  # a row per subscription
    return ranking.global_cap(taken(spark, d), fields).select("field_slug", "seq", "page_no")


@query(
    f"WITH {q.SCORED}, {q.GATED} SELECT field_slug, seq, n FROM (SELECT *, row_number() OVER (PARTITION BY field_slug ORDER BY relevance DESC, fulltext DESC, published DESC, seq) AS n FROM gated WHERE relevance > 0 AND issue = '' AND seq NOT IN (SELECT a.seq FROM ({_PA}) a WHERE EXISTS (SELECT 1 FROM ({_LA}) l WHERE l.field_slug = a.field_slug AND l.alias = a.alias))) WHERE n <= 500"
)
def r9_cacheable_top500(spark, d):
    s = ranking.scored(unseen(spark, d), schema.subscriptions(spark, d)).where("relevance > 0 AND issue = ''")
    return ranking.rank(s, ranking.RECENT, "n", ranking.CACHE_ROWS).select("field_slug", "seq", "n")


@query("SELECT seen_id, field_slug, row_number() OVER (PARTITION BY field_slug ORDER BY CASE WHEN coalesce(added_at,'') <> '' THEN added_at ELSE coalesce(added_on,'') END DESC, coalesce(page_file,'') DESC, seen_id) AS n FROM (SELECT * REPLACE (coalesce(field_slug,'') AS field_slug) FROM seen_ledger)")
def r11_index_order(spark, d):
    at = F.coalesce(F.nullif(C("added_at"), F.lit("")), C("added_on"))
    rows = schema.ledger(spark, d).select("seen_id", "field_slug", at.alias("at"), "page_file")
    return ranking.numbered(rows, "field_slug", [C("at").desc(), C("page_file").desc(), C("seen_id")], "n").select("seen_id", "field_slug", "n")


@query("SELECT seen_id, coalesce(title,'') AS title FROM seen_ledger ORDER BY CASE WHEN coalesce(added_at,'') <> '' THEN added_at ELSE coalesce(added_on,'') END DESC, coalesce(page_file,'') DESC, seen_id LIMIT 30")
def r12_global_recent(spark, d):
    at = F.coalesce(F.nullif(C("added_at"), F.lit("")), C("added_on"))
    return schema.ledger(spark, d).orderBy(at.desc(), C("page_file").desc(), "seen_id").limit(30).select("seen_id", "title")  # the limit is the feature


@query(f"SELECT seq, array_to_string(authors[1:12], '; ') AS first_authors, len(authors) AS n FROM {P}")
def r14_first_authors(spark, d):
    return schema.papers(spark, d).select("seq", F.array_join(F.slice("authors", 1, 12), "; ").alias("first_authors"), F.size("authors").alias("n"))


_MERGE_KEY = f"(SELECT *, CASE WHEN {q.ntitle('title')} <> '' THEN {q.ntitle('title')} ELSE 'record ' || seq END AS cluster FROM {P})"


def _attr(a: str) -> str:
    return f"coalesce(max_by({a}, seq) FILTER (WHERE base AND {a} <> ''), min_by({a}, seq) FILTER (WHERE {a} <> ''), '') AS {a}"


@query(
    f"""WITH c AS (SELECT *, {q.ftext()} AS s, length(trim(abstract)) > 0 AS h FROM {_MERGE_KEY}),
    b AS (SELECT *, max(s) OVER w AS best, coalesce(bool_or(h) OVER w, false) AS had FROM c WINDOW w AS (PARTITION BY cluster ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    m AS (SELECT *, best IS NULL OR s > best OR (s = best AND h AND NOT had) AS base FROM b)
    SELECT cluster, min(seq) AS seq, max(citations) AS citations, count(*) AS members, max_by(source, seq) FILTER (WHERE base) AS source, max_by(title, seq) FILTER (WHERE base) AS title, {', '.join(map(_attr, dedup.ATTRIBUTES))} FROM m GROUP BY cluster"""
)
def d2_merge_records(spark, d):
    name = I.normalize_title(C("title"))  # a title without ASCII letters names no cluster; its record stays alone
    p = schema.papers(spark, d).withColumn("cluster", F.when(name != "", name).otherwise(F.concat(F.lit("record "), "seq")))
    return dedup.merge_clusters(p, "cluster")


@query()
def d1_sequential_dedup(spark, d):
    return dedup.sequential_clusters(schema.papers(spark, d))


_E = f"e AS (SELECT DISTINCT field_slug, seen_id, alias FROM ({' UNION ALL '.join(f'''SELECT coalesce(field_slug,'') AS field_slug, seen_id, '{k}' || {v} AS alias FROM seen_ledger WHERE {v} <> '' ''' for k, v in _LEDGER_PARTS)} UNION ALL SELECT coalesce(field_slug,''), seen_id, 'file:' || page_file FROM seen_ledger WHERE coalesce(page_file,'') <> ''))"


def _ledger_rows(spark, d) -> DataFrame:
    led = schema.ledger(spark, d)
    named = F.concat(I.ledger_aliases(C("paper_key"), C("title"), C("doi"), C("arxiv_id")), F.when(C("page_file") != "", F.array(F.concat(F.lit("file:"), C("page_file")))).otherwise(F.array().cast("array<string>")))
    return led.withColumn("aliases", named)


@query(
    f"WITH RECURSIVE {_E}, near AS (SELECT DISTINCT a.seen_id AS a, b.seen_id AS b FROM e a JOIN e b ON a.field_slug = b.field_slug AND a.alias = b.alias), walk AS (SELECT seen_id, seen_id AS root FROM seen_ledger UNION SELECT n.b, w.root FROM walk w JOIN near n ON n.a = w.seen_id) SELECT seen_id, min(root) AS root FROM walk GROUP BY seen_id"
)
def d3_components(spark, d):
    rows = _ledger_rows(spark, d)
    return dedup.alias_classes(rows, "field_slug", "seen_id", "aliases").select("seen_id", "root")


_LT = [c for c in ("title", "venue", "url", "pdf_url", "arxiv_id", "doi", "pub_date", "tldr", "basis")]


@query(
    f"""WITH RECURSIVE {_E}, near AS (SELECT DISTINCT a.seen_id AS a, b.seen_id AS b FROM e a JOIN e b ON a.field_slug = b.field_slug AND a.alias = b.alias), walk AS (SELECT seen_id, seen_id AS root FROM seen_ledger UNION SELECT n.b, w.root FROM walk w JOIN near n ON n.a = w.seen_id),
    g AS (SELECT seen_id, min(root) AS work FROM walk GROUP BY seen_id),
    l AS (SELECT seen_id, g.work, coalesce(citations,0) AS citations, {', '.join(f"coalesce({c},'') AS {c}" for c in [*_LT, 'paper_key', 'page_file', 'added_on', 'added_at'])} FROM seen_ledger JOIN g USING (seen_id)),
    o AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN added_at <> '' THEN added_at ELSE added_on END, paper_key, seen_id) AS ord FROM l)
    SELECT work, min_by(seen_id, ord) AS survivor, max(citations) AS citations, count(*) AS members, {', '.join(f"coalesce(max_by({c}, ord) FILTER (WHERE {c} <> ''), '') AS {c}" for c in _LT)}, {', '.join(f'min_by({c}, ord) AS {c}' for c in ('paper_key', 'page_file', 'added_on', 'added_at'))} FROM o GROUP BY work"""
)
def d4_ledger_merge(spark, d):
    """Classes of entries that share an alias, each merged into its oldest entry: the ledger's self-repair."""
    rows = _ledger_rows(spark, d)
    work = dedup.alias_classes(rows, "field_slug", "seen_id", "aliases").select("seen_id", C("root").alias("work"))
    return dedup.merge_ledger(schema.ledger(spark, d).join(work, "seen_id"), "work")


@query("SELECT seen_id FROM seen_ledger WHERE NOT contains(lower(coalesce(title,'')), 'robust')")
def k7_remove(spark, d):
    return dedup.remove_entries(schema.ledger(spark, d), title_part="Robust").select("seen_id")


@query(f"WITH {q.SCORED}, f AS (SELECT seq FROM {P} WHERE seq NOT IN (SELECT a.seq FROM ({_PA}) a WHERE EXISTS (SELECT 1 FROM ({_LA}) l WHERE l.field_slug = a.field_slug AND l.alias = a.alias))) SELECT field_slug, count(*) AS candidates, count(f.seq) AS fresh, CAST(count_if(f.seq IS NOT NULL AND relevance > 0) AS BIGINT) AS relevant, CAST(least(max(k), count_if(f.seq IS NOT NULL AND relevance > 0)) AS BIGINT) AS picked, CAST(greatest(0, max(k) - count_if(f.seq IS NOT NULL AND relevance > 0)) AS BIGINT) AS shortfall FROM scored LEFT JOIN f USING (seq) GROUP BY field_slug")
def a1_run_metrics(spark, d):
    s = ranking.scored(schema.papers(spark, d), schema.subscriptions(spark, d))
    fresh = unseen(spark, d).select("seq", F.lit(True).alias("new"))
    j = s.join(fresh, "seq", "left").withColumn("good", F.coalesce("new", F.lit(False)) & (C("relevance") > 0))
    return j.groupBy("field_slug").agg(
        F.count("*").alias("candidates"), F.count("new").alias("fresh"), F.count_if("good").alias("relevant"),
        F.least(F.max("k").cast("long"), F.count_if("good")).alias("picked"), F.greatest(F.lit(0).cast("long"), F.max("k").cast("long") - F.count_if("good")).alias("shortfall"),
    )


@query("SELECT added_on, count(*) AS added, CAST(count_if(selection = 'manual') AS BIGINT) AS manual FROM seen_ledger GROUP BY added_on")
def a4_added_per_day(spark, d):
    return read_table(spark, d, "seen_ledger").groupBy("added_on").agg(F.count("*").alias("added"), F.count_if(C("selection") == "manual").alias("manual"))


@query("SELECT s.username, s.label, count(l.seen_id) AS papers, coalesce(max(nullif(l.added_on,'')), '') AS latest FROM subscriptions s LEFT JOIN seen_ledger l ON l.field_slug = s.username GROUP BY 1, 2")
def a7_field_cards(spark, d):
    n = read_table(spark, d, "seen_ledger").groupBy(C("field_slug").alias("username")).agg(F.count("*").alias("papers"), F.max(F.nullif("added_on", F.lit(""))).alias("latest"))
    s = schema.subscriptions(spark, d).select("username", "label").join(n, "username", "left")
    return s.select("username", "label", F.coalesce("papers", F.lit(0)).alias("papers"), F.coalesce("latest", F.lit("")).alias("latest"))


@query(f"SELECT source, scan_mode, count(*) AS n, CAST(count_if(doi = '') AS BIGINT) AS without_doi FROM {P} GROUP BY ALL")
def a9_source_counts(spark, d):
    return schema.papers(spark, d).groupBy("source", "scan_mode").agg(F.count("*").alias("n"), F.count_if(C("doi") == "").alias("without_doi"))


_BARE = lambda x: f"regexp_replace(lower(coalesce({x},'')), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g')"
_GR = lambda x: f"CASE WHEN length({x}) >= 3 THEN list_distinct(list_transform(range(1, length({x}) - 1), lambda i: substr({x}, i, 3))) ELSE [] END"


@query(
    f"WITH b AS (SELECT seq, {_BARE('title')} AS a, {_BARE('abstract')} AS t FROM {P}), g AS (SELECT seq, {_GR('a')} AS ga, {_GR('t')} AS gb FROM b) SELECT seq, round(CASE WHEN least(len(ga), len(gb)) > 0 THEN len(list_intersect(ga, gb)) / least(len(ga), len(gb)) ELSE 0.0 END, 9) AS containment FROM g"
)
def a11_containment(spark, d):
    return schema.papers(spark, d).select("seq", F.round(quality.containment(C("title"), C("abstract")), 9).alias("containment"))


@query("SELECT seen_id, greatest(1, least(5, 2 + CASE WHEN coalesce(citations,0) >= 100 THEN 2 WHEN coalesce(citations,0) >= 20 THEN 1 ELSE 0 END + CASE WHEN starts_with(coalesce(basis,''), 'fulltext') THEN 1 ELSE 0 END + CASE WHEN length(coalesce(tldr,'')) >= 900 THEN 1 ELSE 0 END)) AS value FROM seen_ledger")
def a12_reading_value(spark, d):
    return schema.ledger(spark, d).select("seen_id", quality.heuristic_reading_value(F.coalesce("citations", F.lit(0)), C("basis"), C("tldr")).alias("value"))


@query(f"SELECT seen_id, length({q.strip('tldr')}) < 40 OR length(coalesce(tldr,'')) < 260 AS too_short, coalesce(TRY_CAST(reading_value AS BIGINT),0) BETWEEN 1 AND 1 AS low_value FROM seen_ledger")
def pred7_gates(spark, d):
    value = I.tolerant_int(C("reading_value"))
    return schema.ledger(spark, d).select("seen_id", quality.too_short(C("tldr"), C("tldr")).alias("too_short"), ((value != 0) & (value < 2)).alias("low_value"))


_FULL = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_HALF = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")
_WIDE = lambda x: f"translate({x}, '{_FULL}', '{_HALF}')"  # noqa: E731  the compatibility forms that matter for words
_TT = "list_filter(list_distinct(regexp_extract_all(lower(" + _WIDE("p.title") + "), '[a-z0-9]+')), lambda w: length(w) >= 4 AND w NOT IN (" + ", ".join(map(q.lit, quality.TITLE_STOP)) + "))"


@query(
    f"SELECT doc_id, terms = 0 OR hits >= CASE WHEN terms >= 3 THEN 2 ELSE 1 END AS matches FROM (SELECT d.doc_id, len({_TT}) AS terms, (SELECT count(*) FROM (SELECT unnest({_TT}) AS t) u WHERE list_contains(string_split_regex(lower({_WIDE("coalesce(d.text,'')")}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+'), u.t)) AS hits FROM documents d JOIN {P} p ON p.seq = d.rec_id)"
)
def pred10_title_terms(spark, d):
    j = read_table(spark, d, "documents").join(schema.papers(spark, d).select(C("seq").alias("rec_id"), "title"), "rec_id")
    return j.select("doc_id", quality.text_matches_title(C("text"), C("title")).alias("matches"))


_LOW = f"regexp_replace(lower({_WIDE("coalesce(text,'')")}), '{q.WS}+', ' ', 'g')"


@query(f"SELECT doc_id, contains({_LOW}, 'formatting instructions') AND ({' + '.join(f'CAST(contains({_LOW}, {q.lit(m)}) AS INTEGER)' for m in quality.TEMPLATE)}) >= 3 AS template, {' OR '.join(f'contains(lower(coalesce(heading,{chr(39)}{chr(39)})), {q.lit(m)})' for m in quality.DENY)} AS denied FROM documents")
def pred11_template(spark, d):
    return read_table(spark, d, "documents").select("doc_id", quality.looks_like_template(C("text")).alias("template"), quality.denied(C("heading")).alias("denied"))


@query("SELECT seen_id FROM seen_ledger WHERE contains(lower(concat_ws(' ', coalesce(title,''), array_to_string(coalesce(authors, []), ' '), coalesce(venue,''))), 'robust')")
def pred18_search(spark, d):
    hay = F.lower(F.concat_ws(" ", C("title"), F.array_join(F.coalesce("authors", F.array().cast("array<string>")), " "), C("venue")))
    return schema.ledger(spark, d).where(hay.contains("robust")).select("seen_id")


@query("SELECT doc_id, CASE WHEN back > 0 AND length(t) - back - 9 > length(t) * 0.5 THEN substr(t, 1, length(t) - back - 9) ELSE t END AS body FROM (SELECT doc_id, coalesce(text,'') AS t, instr(reverse(lower(coalesce(text,''))), 'secnerefer') AS back FROM documents)")
def t4_strip_references(spark, d):
    return read_table(spark, d, "documents").select("doc_id", texts.strip_references(C("text")).alias("body"))


@query("SELECT doc_id, i AS piece_no, substr(text, CAST(i * 7000 + 1 AS BIGINT), 7000) AS piece FROM (SELECT doc_id, text, unnest(range(0, least(14, CAST(ceil(length(text) / 7000.0) AS BIGINT)))) AS i FROM documents WHERE text <> '')")
def t5_chunks(spark, d):
    return read_table(spark, d, "documents").select("doc_id", F.posexplode(texts.chunks(C("text"))).alias("piece_no", "piece"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text,''), '(?is)<script\\b.*?</script>', ' ', 'g'), '(?is)<style\\b.*?</style>', ' ', 'g'), '(?is)<noscript\\b.*?</noscript>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '[\\s\\p{Z}\\x{0B}\\x{85}]+', ' ', 'g')) AS plain FROM documents")
def t20_strip_tags(spark, d):
    return read_table(spark, d, "documents").select("doc_id", texts.strip_tags(C("text")).alias("plain"))


@query("SELECT doc_id, array_to_string(list_transform(string_split(coalesce(text,''), ' '), lambda w: w), ' ') AS restored FROM documents WHERE text <> ''")
def s6b_inverted_index(spark, d):
    words = read_table(spark, d, "documents").where("text <> ''").select("doc_id", F.split("text", " ").alias("w"))
    pairs = words.select("doc_id", F.posexplode("w").alias("p", "word")).groupBy("doc_id", "word").agg(F.collect_list("p").alias("at"))  # positions of a word in one text
    index = pairs.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "at"))).alias("index"))
    return index.select("doc_id", texts.restore_inverted(C("index")).alias("restored"))


@query("SELECT username AS field_slug, i AS group_no, g AS terms FROM (SELECT username, unnest(CASE WHEN len(coalesce(search_queries, [])) > 0 THEN search_queries ELSE keywords END) AS g, generate_subscripts(CASE WHEN len(coalesce(search_queries, [])) > 0 THEN search_queries ELSE keywords END, 1) AS i FROM subscriptions)")
def s16b_search_groups(spark, d):
    s = schema.subscriptions(spark, d)
    groups = F.when(F.coalesce(F.size("search_queries"), F.lit(0)) > 0, C("search_queries")).otherwise(C("keywords"))
    return s.select(C("username").alias("field_slug"), F.posexplode(groups).alias("n", "terms")).select("field_slug", (C("n") + 1).alias("group_no"), "terms")


@query(
    "SELECT l.seen_id, coalesce(l.title,'') AS title, array_to_string(coalesce(l.authors, [])[1:8], ', ') AS authors, len(list_filter(coalesce(l.matched_keywords, []), lambda k: trim(k) <> '')) AS chips, coalesce(l.added_on,'') = m.latest AND m.latest <> '' AS latest FROM seen_ledger l JOIN (SELECT coalesce(field_slug,'') AS f, coalesce(max(nullif(added_on,'')),'') AS latest FROM seen_ledger GROUP BY 1) m ON m.f = coalesce(l.field_slug,'')"
)
def v1_list_view(spark, d):
    led = schema.ledger(spark, d)
    m = led.groupBy("field_slug").agg(F.coalesce(F.max(F.nullif("added_on", F.lit(""))), F.lit("")).alias("newest"))
    none = F.array().cast("array<string>")
    return led.join(m, "field_slug").select(
        "seen_id", "title", F.array_join(F.slice(F.coalesce("authors", none), 1, 8), ", ").alias("authors"),
        F.size(F.filter(F.coalesce("matched_keywords", none), lambda k: F.trim(k) != "")).alias("chips"), ((C("added_on") == C("newest")) & (C("newest") != "")).alias("latest"),
    )


@query()
def f16_title_ratio(spark, d):
    a = schema.ledger(spark, d).select("seen_id", I.normalize_title(C("title")).alias("a"))
    b = read_table(spark, d, "candidates").select(C("cand_id"), I.normalize_title(C("title")).alias("b"), "doi")
    pairs = schema.ledger(spark, d).select("seen_id", I.normalize_doi(C("doi")).alias("d")).where("d <> ''").join(b.select("cand_id", "b", I.normalize_doi(C("doi")).alias("d")).where("d <> ''"), "d")
    return pairs.join(a, "seen_id").select("seen_id", "cand_id", F.round(lookup.title_ratio("a", "b"), 9).alias("ratio"))


@query()
def j3_best_title(spark, d):
    qs = read_table(spark, d, "registry_records").select(C("bib_id").alias("qid"), "title")
    cs = schema.papers(spark, d).groupBy(I.normalize_title(C("title")).alias("t")).agg(F.min("seq").alias("cid"), F.min_by("title", "seq").alias("title"), F.min_by("venue", "seq").alias("venue"), F.max("citations").alias("citations")).where("t <> ''")
    return lookup.best_title_match(qs, cs)


@query()
def j10_fuzzy_resolve(spark, d):
    led = schema.ledger(spark, d)
    first = led.where("title <> '' AND page_file <> ''").orderBy("seen_id").select("title").first()  # one title to ask for, without its end
    return lookup.resolve_title(led, first.title[:-3] if first else "")


@query()
def t2_sections(spark, d):
    pages = read_table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.concat(F.lit("<h1>"), F.coalesce("heading", F.lit("")), F.lit("</h1><p>"), C("text"), F.lit("</p><script>x()</script>")).alias("html"))
    return pages.select("doc_id", F.posexplode(sections.sections_of_html("html")).alias("pos", "s")).select("doc_id", "pos", "s.*")


@query()
def t18_sentences(spark, d):
    return read_table(spark, d, "documents").select("doc_id", F.posexplode(texts.sentences(C("text"))).alias("pos", "sentence"))


@query()
def t13_excerpt(spark, d):
    return read_table(spark, d, "documents").select("doc_id", texts.evidence_excerpt(C("text"), 900, r"\d+(\.\d+)?\s*(%|percent)").alias("excerpt"))


@query(f"SELECT s.username, greatest(1, least(CAST(s.k AS INTEGER), 20)) AS k, coalesce((SELECT max(nullif(l.added_on, '')) FROM seen_ledger l WHERE l.field_slug = s.username), '') AS latest FROM subscriptions s")
def r10_clamped_k(spark, d):
    latest = schema.ledger(spark, d).groupBy(C("field_slug").alias("username")).agg(F.max(F.nullif("added_on", F.lit(""))).alias("latest"))
    s = schema.subscriptions(spark, d).select("username", ranking.clamp_k(C("k").cast("int")).alias("k"))
    return s.join(latest, "username", "left").select("username", "k", F.coalesce("latest", F.lit("")).alias("latest"))


_SORTS = {
    "added": "CASE WHEN coalesce(added_at,'') <> '' THEN added_at ELSE coalesce(added_on,'') END DESC", "published": "coalesce(pub_date,'') DESC", "value": "coalesce(TRY_CAST(reading_value AS BIGINT), 0) DESC", "title": "lower(coalesce(title,''))", "author": "lower(coalesce(authors[1],''))",
}


@query("SELECT seen_id, " + ", ".join(f"CAST(row_number() OVER (PARTITION BY coalesce(field_slug,'') ORDER BY {o}, seen_id) AS INTEGER) AS by_{n}" for n, o in _SORTS.items()) + " FROM seen_ledger")
def r13_sort_modes(spark, d):
    """The five orders of a list; equal entries keep their place. Texts are compared by code points here; a collation is a parameter of the view."""
    rows = schema.ledger(spark, d).select("seen_id", "field_slug", F.coalesce(F.nullif(C("added_at"), F.lit("")), C("added_on")).alias("added"), C("pub_date").alias("published"), I.tolerant_int(C("reading_value")).alias("value"), F.lower("title").alias("title"), F.lower(F.coalesce(F.get("authors", F.lit(0)), F.lit(""))).alias("author"))
    return ranking.sort_modes(rows, "field_slug", "seen_id", {"added": True, "published": True, "value": True, "title": False, "author": False})


@query(f"SELECT seq, len(list_distinct(list_filter(matched_keywords, lambda k: trim(k) <> ''))) AS distinct_keywords FROM {P}")
def d5_distinct_keywords(spark, d):
    kept = F.filter("matched_keywords", lambda k: F.trim(k) != "")
    return schema.papers(spark, d).select("seq", F.size(F.array_distinct(kept)).alias("distinct_keywords"))


@query(f"WITH {q.SCORED}, {q.GATED} SELECT field_slug, seq, relevance < 1 OR len(matched) = 0 AS weak, fulltext = 0 AS no_fulltext, abstract = '' AS no_abstract FROM gated")
def pred6_pre_gates(spark, d):
    p = schema.papers(spark, d)
    s = ranking.scored(p, schema.subscriptions(spark, d)).join(p.select("seq", "abstract"), "seq")
    return s.select("field_slug", "seq", quality.weak_relevance(C("relevance"), C("matched")).alias("weak"), (C("fulltext") == 0).alias("no_fulltext"), quality.no_text(C("abstract"), F.array()).alias("no_abstract"))


_LINES = """lines AS (SELECT doc_id AS paper_id, i AS pos, txt, CASE WHEN length(txt) < 14 THEN 12.0 WHEN length(txt) < 40 THEN 11.0 ELSE 10.0 END AS size, length(txt) % 7 = 0 AS bold FROM (SELECT doc_id, unnest(w) AS txt, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\\n+'), lambda t: """ + q.strip("t") + """), lambda t: t <> '') AS w FROM documents WHERE text <> '')))"""


def _lines(spark, d) -> DataFrame:
    """Lines of the documents in the form of a PDF's: sizes and weights stand for what an extractor finds."""
    w = F.filter(F.transform(F.split("text", "\\n+"), I.strip), lambda t: t != "")
    docs = read_table(spark, d, "documents").where("text <> ''").select(C("doc_id").alias("paper_id"), F.posexplode(w).alias("p", "txt"))
    size = F.when(F.length("txt") < 14, 12.0).when(F.length("txt") < 40, 11.0).otherwise(10.0)
    return docs.select("paper_id", (C("p") + 1).alias("pos"), size.alias("size"), (F.length("txt") % 7 == 0).alias("bold"), "txt")


@query(f"WITH {_LINES} SELECT paper_id, max_by(size, chars * 1000000 - first_pos) AS body_size FROM (SELECT paper_id, size, sum(length(txt)) AS chars, min(pos) AS first_pos FROM lines GROUP BY 1, 2) GROUP BY 1")
def a8_body_size(spark, d):
    return sections.body_sizes(_lines(spark, d))


@query()
def l8_stub_summary(spark, d):
    docs = read_table(spark, d, "documents").select("rec_id", F.struct(F.coalesce("heading", F.lit("")).alias("heading"), F.coalesce("text", F.lit("")).alias("body")).alias("s")).where("rec_id IS NOT NULL")
    secs = docs.groupBy(C("rec_id").alias("seq")).agg(F.array_sort(F.collect_list("s")).alias("sections"))  # the texts of one record
    p = schema.papers(spark, d).join(secs, "seq")
    return p.select("seq", summaries.stub(C("title"), C("abstract"), C("sections")).alias("summary")).select("seq", "summary.tldr", "summary.what", "summary.basis", F.size("summary.sections").alias("parts"))


_CP = "(SELECT cand_id AS seq, coalesce(field_slug,'') AS field_slug, coalesce(title,'') AS title, coalesce(doi,'') AS doi, coalesce(arxiv_id,'') AS arxiv_id FROM candidates)"
_CA = " UNION ALL ".join(f"SELECT seq, field_slug, '{k}' || {v} AS alias FROM {_CP} WHERE {v} <> ''" for k, v in _PAPER_PARTS)


@query(
    f"""WITH ca AS ({_CA}), la AS ({_LA}), taken AS (SELECT DISTINCT seq FROM ca SEMI JOIN la USING (field_slug, alias)), fr AS (SELECT * FROM ca WHERE seq NOT IN (SELECT seq FROM taken)), f AS (SELECT field_slug, alias, min(seq) AS first FROM fr GROUP BY 1, 2)
    SELECT seq, field_slug FROM {_CP} WHERE seq NOT IN (SELECT seq FROM taken) AND seq NOT IN (SELECT seq FROM fr JOIN f USING (field_slug, alias) WHERE seq <> first)"""
)
def y1_incremental(spark, d):
    known = schema.ledger(spark, d).select("field_slug", F.explode(I.ledger_aliases(C("paper_key"), C("title"), C("doi"), C("arxiv_id"))).alias("alias"))
    batch = schema.filled(read_table(spark, d, "candidates")).withColumn("seq", C("cand_id")).withColumn("field_slug", F.coalesce("field_slug", F.lit("")))
    return incremental.new_works(batch, known).select("seq", "field_slug")
