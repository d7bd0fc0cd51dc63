"""Queries of the daily run, the sections of full texts, the checks of summaries and the views, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave import schema
from bibweave.functions import identity as I
from bibweave.functions import labels, markup, quality, texts
from bibweave.operators import lookup, resolve, run, sections, stages, summaries, views
from bibweave.plans import sql as q
from bibweave.plans.catalog import query
from bibweave.plans.core_queries import _LA, _LINES, _PA, _lines
from bibweave.session import read_table

C = F.col
P = q.P
E = q.lit("")

# Today is the last day of the ledger.
_TODAY = f"""
td AS (SELECT s.username AS field_slug, greatest(1, least(CAST(s.k AS INTEGER), 20)) AS sk, count(l.seen_id) AS total, coalesce(count_if(l.selection = 'important'), 0) AS imp FROM subscriptions s LEFT JOIN seen_ledger l ON l.field_slug = s.username AND l.added_on = (SELECT max(coalesce(added_on,'')) FROM seen_ledger) AND coalesce(l.selection,'') <> 'manual' GROUP BY ALL),
tq AS (SELECT *, greatest(0, sk - total) AS slots, CASE WHEN sk <= 1 THEN 0 ELSE least(2, sk - 1) END AS quota FROM td),
quotas AS (SELECT field_slug, total AS already, CAST(least(slots, greatest(0, quota - imp)) AS INTEGER) AS important_left, CAST(slots - least(slots, greatest(0, quota - imp)) AS INTEGER) AS recent_left FROM tq)"""
_FRESH = f"fresh AS (SELECT * FROM scored WHERE seq NOT IN (SELECT a.seq FROM ({_PA}) a WHERE EXISTS (SELECT 1 FROM ({_LA}) l WHERE l.field_slug = a.field_slug AND l.alias = a.alias)))"
_POOLS = "pooled AS (SELECT f.*, true AS in_important, bool_or(scan_mode = 'recent') OVER (PARTITION BY field_slug, paper_key) AS in_recent FROM fresh f)"
_DAILY = f"WITH {q.SCORED}, {q.GATED}, {_TODAY}, {_FRESH}, {_POOLS}, {q.queue('pooled', 'quotas')}, daily AS (SELECT u.*, important_left + recent_left AS slots_left FROM queue u JOIN quotas USING (field_slug) WHERE important_left + recent_left > 0)"
_TRIED = "tried AS (SELECT * FROM (SELECT *, coalesce(sum(CAST(passed AS INTEGER)) OVER (PARTITION BY field_slug ORDER BY queue_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT y.*, g.relevance, g.issue, g.fulltext, len(g.matched) AS nm, NOT (g.relevance < 1 OR len(g.matched) = 0 OR g.issue <> '' OR g.fulltext = 0) AS passed FROM daily y JOIN gated g USING (field_slug, seq))) WHERE before < slots_left)"


def _daily(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    return schema.papers(spark, d), schema.ledger(spark, d), schema.subscriptions(spark, d)


@query(f"{_DAILY} SELECT field_slug, seq, phase, queue_pos FROM daily")
def e2e_queue(spark, d):
    """Pools, known works, quotas left of the day, context and keys, in one plan."""
    return run.daily_queue(*_daily(spark, d)).select("field_slug", "seq", "phase", "queue_pos")


@query(f"{_DAILY}, {_TRIED} SELECT field_slug, seq, queue_pos, CAST(passed AS INTEGER) AS passed, CAST(passed AS INTEGER) = 1 AS added FROM tried")
def e2e_taken(spark, d):
    t = run.consume(run.daily_queue(*_daily(spark, d)))
    return t.select("field_slug", "seq", "queue_pos", "passed", (F.size("reasons") == 0).alias("added"))


@query(
    f"""{_DAILY}, {_TRIED}, f AS (SELECT field_slug, count(*) AS fresh, count_if(g.relevance > 0 AND g.issue = '') AS relevant FROM fresh JOIN gated g USING (field_slug, seq) GROUP BY 1)
    SELECT s.username AS field_slug, (SELECT count(*) FROM {P} p WHERE p.field_slug = s.username) AS candidates, coalesce(f.fresh, 0) AS fresh, CAST(coalesce(f.relevant, 0) AS BIGINT) AS relevant, (SELECT count(*) FROM daily y WHERE y.field_slug = s.username AND queue_pos <= slots_left) AS picked,
    CAST(coalesce((SELECT count_if(passed) FROM tried t WHERE t.field_slug = s.username), 0) AS BIGINT) AS added, CAST(coalesce((SELECT count_if(NOT passed) FROM tried t WHERE t.field_slug = s.username), 0) AS BIGINT) AS skipped,
    CAST(greatest(0, greatest(1, least(s.k, 20)) - qt.already - coalesce((SELECT count_if(passed) FROM tried t WHERE t.field_slug = s.username), 0)) AS BIGINT) AS shortfall
    FROM subscriptions s LEFT JOIN f ON f.field_slug = s.username JOIN quotas qt ON qt.field_slug = s.username"""
)
def a1_field_metrics(spark, d):
    return run.metrics(*_daily(spark, d))


@query(f"{_DAILY}, {_TRIED}, c AS (SELECT g.*, row_number() OVER (PARTITION BY field_slug, scan_mode ORDER BY relevance DESC, fulltext DESC, citations DESC, published DESC, seq) AS n FROM gated g WHERE relevance > 0 AND issue = '' AND seq IN (SELECT seq FROM fresh) AND seq NOT IN (SELECT seq FROM tried WHERE passed)) SELECT field_slug, seq, scan_mode FROM c WHERE n <= 500")
def y3_carry_over(spark, d):
    p, led, s = _daily(spark, d)
    return run.carry_over(p, led, s, run.consume(run.daily_queue(p, led, s))).select("field_slug", "seq", "scan_mode")


@query(f"{_DAILY}, {_TRIED} SELECT field_slug, seq, CASE WHEN passed THEN 'added' ELSE 'skipped' END AS outcome, CASE phase WHEN 0 THEN 'important' WHEN 1 THEN 'recent' ELSE 'fallback' END AS selection, CASE WHEN relevance < 1 OR nm = 0 THEN 1 ELSE 0 END + CASE WHEN issue <> '' THEN 1 ELSE 0 END + CASE WHEN fulltext = 0 THEN 1 ELSE 0 END AS reasons FROM tried")
def h1_report_rows(spark, d):
    p, led, s = _daily(spark, d)
    rows = run.report_rows(run.consume(run.daily_queue(p, led, s)), p)
    return rows.select("field_slug", C("paper.seq").alias("seq"), "outcome", "selection", F.size("reasons").alias("reasons"))


@query("SELECT username AS field_slug, array_to_string(CASE WHEN len(coalesce(search_queries, [])) > 0 THEN search_queries ELSE keywords END, ' + ') AS label, len(CASE WHEN len(coalesce(search_queries, [])) > 0 THEN search_queries ELSE keywords END) AS terms FROM subscriptions")
def s16c_query_label(spark, d):
    terms = F.when(F.coalesce(F.size("search_queries"), F.lit(0)) > 0, C("search_queries")).otherwise(C("keywords"))
    return schema.subscriptions(spark, d).select(C("username").alias("field_slug"), run.query_label(terms).alias("label"), F.size(terms).alias("terms"))


@query(f"SELECT source, field_slug, scan_mode, count(*) AS n, CAST(count_if(doi = '' AND arxiv_id = '') AS BIGINT) AS without_id, coalesce(max(published), '') AS newest FROM {P} GROUP BY ALL")
def a9_query_counts(spark, d):
    by = schema.papers(spark, d).groupBy("source", "field_slug", "scan_mode")
    return by.agg(F.count("*").alias("n"), F.count_if((C("doi") == "") & (C("arxiv_id") == "")).alias("without_id"), F.coalesce(F.max("published"), F.lit("")).alias("newest"))


# --- views over the ledger

_L = "(SELECT seen_id, coalesce(field_slug,'') AS field_slug, coalesce(paper_key,'') AS paper_key, coalesce(title,'') AS title, coalesce(page_file,'') AS page_file, coalesce(pub_date,'') AS pub_date, coalesce(venue,'') AS venue, coalesce(url,'') AS url, coalesce(pdf_url,'') AS pdf_url, coalesce(arxiv_id,'') AS arxiv_id, coalesce(doi,'') AS doi, coalesce(added_on,'') AS added_on, coalesce(added_at,'') AS added_at, authors, coalesce(tldr,'') AS tldr, coalesce(basis,'') AS basis, matched_keywords, coalesce(selection,'') AS selection, coalesce(selection_label,'') AS selection_label, citations, relevance, coalesce(reading_value,'') AS reading_value FROM seen_ledger)"
_LIST = lambda x: f"list_filter(coalesce({x}, []), lambda k: trim(k) <> '')"
_TAGS = f"CASE WHEN len({_LIST('l.matched_keywords')}) > 0 THEN {_LIST('l.matched_keywords')} ELSE coalesce((SELECT list(trim(u.kw) ORDER BY u.i) FROM (SELECT unnest(s.keywords) AS kw, generate_subscripts(s.keywords, 1) AS i) u WHERE {q.has_word('lower(l.title || chr(32) || l.tldr)', 'u.kw')}), []) END"
_CLEAN = "regexp_replace(regexp_replace(" + q.squeeze("l.venue") + r", '^採択先:\s*', ''), '^掲載先:\s*', '')"
_SEL = "CASE l.selection WHEN 'important' THEN '重要論文' WHEN 'recent' THEN '新着論文' WHEN 'fallback' THEN '補充候補' WHEN 'manual' THEN '手動追加' ELSE {} END"
_BASIS = "CASE l.basis " + " ".join(f"WHEN {q.lit(k)} THEN {q.lit(v)}" for k, v in labels.BASIS.items()) + f" ELSE {q.lit('アブストラクト')} END"
_ENTRIES = f"""ent AS (SELECT l.*, {_TAGS} AS tags, array_to_string(list_transform({_LIST('l.authors')}, lambda a: trim(a)), ', ') AS people, {_CLEAN} AS v, max(nullif(l.added_on, '')) OVER (PARTITION BY l.field_slug) AS newest, {_SEL.format('l.selection_label')} AS sel, {_SEL.format(E)} AS sel_name, coalesce(TRY_CAST(l.reading_value AS BIGINT), 0) AS value, {_BASIS} AS basis_name FROM {_L} l LEFT JOIN subscriptions s ON s.username = l.field_slug),
items AS (SELECT *, CASE WHEN v = '' OR lower(v) IN ('unknown','n/a','none','-','未取得') OR lower(regexp_replace(v, '[\\s._-]+', '', 'g')) IN ('arxiv','arxivorg','arxivcornelluniversity') THEN '' ELSE {q.with_year('v', 'pub_date')} END AS place FROM ent)"""


def _entries(spark, d) -> DataFrame:
    return views.entries(schema.ledger(spark, d), schema.subscriptions(spark, d))


@query(f"WITH {_ENTRIES} SELECT seen_id, people, place, array_to_string(tags, '|') AS tags, CASE WHEN added_at <> '' THEN added_at ELSE added_on END AS added, value, coalesce(added_on = newest, false) AS latest, lower(concat_ws(' ', title, people, place, pub_date, tldr, selection_label, sel_name, array_to_string(tags, ' '))) AS search_text FROM items")
def v1_entries(spark, d):
    return _entries(spark, d).select("seen_id", "people", "place", F.array_join("tags", "|").alias("tags"), C("at").alias("added"), "value", "latest", "search_text")


@query(f"WITH {_ENTRIES} SELECT seen_id, array_to_string(list_filter([nullif(sel, ''), CASE WHEN len(tags) > 0 THEN 'キーワード一致 ' || len(tags) END, CASE WHEN citations IS NOT NULL THEN '被引用 ' || citations END, CASE WHEN relevance IS NOT NULL THEN '関連度 ' || relevance END, CASE WHEN basis <> '' THEN basis_name END, CASE WHEN value <> 0 THEN '読む価値 ' || value || '/5' END], lambda c: c IS NOT NULL), '|') AS chips FROM items")
def v2_chips(spark, d):
    return _entries(spark, d).select("seen_id", F.array_join("chips", "|").alias("chips"))


@query(f"WITH {_ENTRIES} SELECT seen_id, len(tags) AS n FROM items WHERE len({_LIST('matched_keywords')}) = 0")
def v3_filled_keywords(spark, d):
    own = schema.ledger(spark, d).where(F.size(views.list_of(C("matched_keywords"))) == 0).select("seen_id")
    return _entries(spark, d).join(own, "seen_id").select("seen_id", F.size("tags").alias("n"))


@query(f"WITH {_ENTRIES} SELECT seen_id, title FROM items WHERE contains(lower(concat_ws(' ', title, people, place, pub_date, tldr, selection_label, sel_name, array_to_string(tags, ' '))), 'robust')")
def pred18_list_search(spark, d):
    return views.search(_entries(spark, d), " Robust ").select("seen_id", "title")


@query("SELECT s.username AS field_slug, CASE WHEN coalesce(s.label,'') <> '' THEN s.label ELSE s.username END AS label, array_to_string(s.keywords, ', ') AS keywords, (SELECT count(*) FROM seen_ledger l WHERE l.field_slug = s.username) AS papers FROM subscriptions s")
def k3_cards(spark, d):
    return views.cards(schema.ledger(spark, d), schema.subscriptions(spark, d))


@query(f"WITH {_ENTRIES} SELECT seen_id, title, CASE WHEN added_at <> '' THEN added_at ELSE added_on END AS added FROM items ORDER BY added DESC, page_file DESC, seen_id LIMIT 30")
def k3_recent(spark, d):
    return views.global_recent(_entries(spark, d)).select("seen_id", "title", C("at").alias("added"))


@query(f"WITH {_ENTRIES}, o AS (SELECT field_slug, row_number() OVER (PARTITION BY field_slug ORDER BY CASE WHEN added_at <> '' THEN added_at ELSE added_on END DESC, page_file DESC, seen_id) AS n FROM items) SELECT field_slug, CAST((n - 1) // 50 AS INTEGER) AS page_no, count(*) + 1 AS entries FROM o GROUP BY ALL")
def k2_field_pages(spark, d):
    pages = views.field_pages(_entries(spark, d), 50)
    return pages.select("field_slug", "page_no", F.size(F.split("html", "<li[ >]")).cast("long").alias("entries"))


@query("SELECT 'data/runs/' || max(added_on) || '.html' AS href FROM seen_ledger WHERE regexp_matches(coalesce(added_on,''), '^\\d{4}-\\d{2}-\\d{2}$')")
def v5_latest_report(spark, d):
    return views.latest_report(schema.ledger(spark, d).select(F.concat("added_on", F.lit(".html")).alias("name")))


@query(f"SELECT l.seen_id, l.page_file, coalesce(l.relevance, 0) > 5 AS want, CASE WHEN coalesce(l.citations, 0) >= 100 THEN true ELSE false END AS hidden FROM {_L} l WHERE NOT coalesce(l.citations, 0) >= 100")
def v6_reader_state(spark, d):
    led = schema.ledger(spark, d).withColumns({"citations": F.coalesce("citations", F.lit(0)), "relevance": F.coalesce("relevance", F.lit(0))})
    marks = led.where("citations >= 100 OR relevance > 5").select(C("seen_id").alias("page_file"), F.lit(False).alias("read"), (C("relevance") > 5).alias("want"), F.lit(False).alias("favorite"), (C("citations") >= 100).alias("hidden"))
    items = led.select("seen_id", C("page_file").alias("file"), C("seen_id").alias("page_file"), F.lit("").alias("search_text"))
    return views.search(views.with_state(items, marks), "").select("seen_id", C("file").alias("page_file"), "want", "hidden")


# --- lookups and repair of records


@query(
    f"""WITH c AS (SELECT rec_id AS cid, {q.ndoi('doi')} AS v FROM papers), r AS (SELECT bib_id AS qid, {q.ndoi('doi')} AS v FROM registry_records)
    SELECT qid, min(cid) AS cid FROM r JOIN c USING (v) WHERE v <> '' GROUP BY qid"""
)
def s10_by_identifier(spark, d):
    r = read_table(spark, d, "registry_records").select(C("bib_id").alias("qid"), F.coalesce("doi", F.lit("")).alias("doi"), F.lit("").alias("arxiv_id"))
    return resolve.by_identifier(r, schema.papers(spark, d).select(C("seq").alias("cid"), "doi", "arxiv_id"))


@query(f"WITH o AS (SELECT {q.ndoi('doi')} AS v, min(pdf_url) AS p FROM {P} WHERE pdf_url <> '' GROUP BY 1) SELECT l.seen_id, CASE WHEN l.pdf_url <> '' THEN l.pdf_url ELSE coalesce(CASE WHEN {q.ndoi('l.doi')} <> '' THEN o.p END, '') END AS pdf_url FROM {_L} l LEFT JOIN o ON o.v = {q.ndoi('l.doi')}")
def s11_open_access(spark, d):
    led = schema.ledger(spark, d).select("seen_id", "doi", "pdf_url")
    return resolve.open_access(led, schema.papers(spark, d).select("doi", "pdf_url")).select("seen_id", "pdf_url")


@query(
    f"""WITH m AS (SELECT {q.ntitle('title')} AS t, {', '.join(f"min(nullif({a}, '')) AS {a}" for a in ('venue', 'url', 'pdf_url', 'doi'))} FROM {P} GROUP BY 1)
    SELECT l.seen_id, {', '.join(f"CASE WHEN l.{a} <> '' THEN l.{a} ELSE coalesce(m.{a}, '') END AS {a}" for a in ('venue', 'url', 'pdf_url', 'doi'))} FROM {_L} l LEFT JOIN m ON m.t = {q.ntitle('l.title')}"""
)
def j9_merge_info(spark, d):
    t = I.normalize_title(C("title"))
    names = ("venue", "url", "pdf_url", "doi")
    return resolve.merge_info(schema.ledger(spark, d).withColumn("t", t), schema.papers(spark, d).withColumn("t", t), "t", names).select("seen_id", *names)


@query(f"SELECT seen_id FROM seen_ledger WHERE {q.ntitle('title')} <> '' AND {q.ntitle('title')} = (SELECT {q.ntitle('title')} FROM seen_ledger WHERE seen_id = 1)")
def j7_ledger_entry(spark, d):
    led = schema.ledger(spark, d)
    title = led.where("seen_id = 1").first()  # one entry
    return resolve.ledger_entry(led, title=title.title if title else "").select("seen_id")


@query(f"SELECT seen_id, title, pub_date AS published, CASE WHEN doi <> '' THEN doi WHEN starts_with(paper_key, 'doi:') THEN substr(paper_key, 5) ELSE '' END AS doi, coalesce(citations, 0) AS citations FROM {_L}")
def h3_papers_of_ledger(spark, d):
    return resolve.papers_of_ledger(schema.ledger(spark, d)).select("seen_id", "title", "published", "doi", "citations")


@query(f"SELECT seq, title || ': ' || CASE WHEN arxiv_id = '' AND pdf_url = '' AND doi = '' THEN 'no address known' ELSE concat_ws(', ', CASE WHEN arxiv_id <> '' THEN 'arXiv ' || arxiv_id END, CASE WHEN pdf_url <> '' THEN 'PDF address' END, CASE WHEN doi <> '' THEN 'DOI ' || doi END) END AS hint FROM {P}")
def h9_fetch_hint(spark, d):
    return schema.papers(spark, d).select("seq", resolve.fetch_hint(C("title"), C("arxiv_id"), C("pdf_url"), C("doi")).alias("hint"))


@query(
    f"""WITH c AS (SELECT *, {q.ntitle('title')} AS t, {q.ftext()} AS f, {q.usable('venue')} AS uv, length(abstract) AS al FROM {P}),
    b AS (SELECT l.seen_id AS qid, c.*, row_number() OVER (PARTITION BY l.seen_id ORDER BY f, c.citations, uv, al, seq DESC) AS o FROM (SELECT seen_id, title FROM {_L}) l JOIN c ON c.t = {q.ntitle('l.title')} AND c.t <> '')
    SELECT qid, max_by(seq, o) AS cid, max(citations) AS citations, {', '.join(f"coalesce(max_by({a}, o) FILTER (WHERE {a} <> ''), '') AS {a}" for a in ('venue', 'doi', 'pdf_url', 'published'))} FROM b GROUP BY qid"""
)
def j6_re_resolve(spark, d):
    led, p = schema.ledger(spark, d).select(C("seen_id").alias("qid"), "title"), schema.papers(spark, d)
    t = I.normalize_title(C("title"))
    met = led.withColumn("t", t).where("t <> ''").select("qid", "t").join(p.withColumn("t", t), "t").withColumn("cid", C("seq"))
    return resolve.re_resolve(led, met).select("qid", "cid", "citations", "venue", "doi", "pdf_url", "published")


@query(f"WITH m AS (SELECT {q.ntitle('title')} AS t, max(citations) AS c, min(nullif(venue, '')) AS v FROM {P} GROUP BY 1) SELECT l.seen_id, CASE WHEN m.v IS NOT NULL THEN m.v ELSE l.venue END AS venue, l.page_file, greatest(coalesce(m.c, 0), coalesce(l.citations, 0)) AS citations FROM {_L} l LEFT JOIN m ON m.t = {q.ntitle('l.title')} AND m.t <> ''")
def y8_refreshed(spark, d):
    led = schema.ledger(spark, d)
    t = I.normalize_title(C("title"))
    best = schema.papers(spark, d).groupBy(t.alias("t")).agg(F.max("citations").alias("citations"), F.min(F.nullif("venue", F.lit(""))).alias("venue")).where("t <> ''")
    found = led.select("seen_id", t.alias("t")).join(best, "t").select("seen_id", F.coalesce("venue", F.lit("")).alias("venue"), F.lit("").alias("url"), F.lit("").alias("pdf_url"), F.lit("").alias("arxiv_id"), F.lit("").alias("doi"), "citations")
    return resolve.refreshed(led, found).select("seen_id", "venue", "page_file", "citations")


# --- sections

_WORDS = " OR ".join(f"contains(lower(txt), {q.lit(w)})" for w in sections.SECTION_WORDS)
_HEADS = f"""{_LINES}, bs AS (SELECT paper_id, max_by(size, chars * 1000000 - first_pos) AS body_size FROM (SELECT paper_id, size, sum(length(txt)) AS chars, min(pos) AS first_pos FROM lines GROUP BY 1, 2) GROUP BY 1),
hd AS (SELECT l.*, body_size, length(txt) BETWEEN 3 AND 90 AND len(string_split_regex(trim(txt), '\\s+')) <= 12 AND (size >= body_size + 0.6 OR (bold AND size >= body_size - 0.1)) AND NOT regexp_matches(lower(txt), '^(figure|fig\\.?|table|tab\\.?|algorithm|equation|eq\\.?)\\s*\\d') AND (regexp_matches(txt, '^\\d+(\\.\\d+)*\\.?\\s+\\S') OR {_WORDS} OR ((txt = upper(txt) OR regexp_matches(txt, '^\\p{{Lu}}')) AND size >= body_size + 0.6)) AS cand FROM lines l JOIN bs USING (paper_id))"""
_DENIED = " OR ".join(f"contains(lower(heading), {q.lit(w)})" for w in quality.DENY)
_SQ = lambda x: f"trim(regexp_replace({x}, '[ \\t]{{2,}}', ' ', 'g'))"
_SECTIONS = f"""{_HEADS}, ub AS (SELECT *, count_if(cand AND size >= body_size + 1.5) OVER (PARTITION BY paper_id) >= 3 AS use_big FROM hd),
hh AS (SELECT *, cand AND (NOT use_big OR size >= body_size + 1.5) AS head FROM ub), isl AS (SELECT *, count_if(head) OVER (PARTITION BY paper_id ORDER BY pos) AS island FROM hh),
raw AS (SELECT paper_id, island, min(txt) FILTER (WHERE head) AS heading, coalesce(string_agg(txt, ' ' ORDER BY pos) FILTER (WHERE NOT head), '') AS body FROM isl WHERE island > 0 GROUP BY 1, 2),
fs AS (SELECT *, min(island) FILTER (WHERE contains(lower(heading), 'abstract') OR contains(lower(heading), 'introduction') OR regexp_matches(trim(heading), '^1\\b')) OVER (PARTITION BY paper_id) AS f FROM raw),
pl AS (SELECT *, min(island) FILTER (WHERE island >= f AND ({_DENIED})) OVER (PARTITION BY paper_id) AS z FROM fs WHERE f IS NOT NULL),
fr AS (SELECT paper_id, string_agg(body, ' ' ORDER BY island) FILTER (WHERE body <> '') AS body FROM pl WHERE island < f GROUP BY 1),
ab AS (SELECT o.paper_id, f - 1 AS island, 'Abstract' AS heading, fr.body FROM fr JOIN pl o ON o.paper_id = fr.paper_id AND o.island = o.f WHERE length({_SQ('fr.body')}) >= 200 AND NOT contains(lower(o.heading), 'abstract')),
al AS (SELECT paper_id, island, heading, {_SQ('body')} AS body FROM (SELECT paper_id, island, heading, body FROM pl WHERE island >= f AND (z IS NULL OR island < z) UNION ALL SELECT * FROM ab)),
sx AS (SELECT paper_id, row_number() OVER (PARTITION BY paper_id ORDER BY island) AS section_no, substr(heading, 1, 120) AS heading, substr(body, 1, 14000) AS body FROM al WHERE length(body) >= 40)"""


@query(f"WITH {_HEADS} SELECT paper_id, pos, cand FROM hd")
def t8_headings(spark, d):
    lines = _lines(spark, d)
    sized = lines.join(sections.body_sizes(lines), "paper_id")
    return sized.select("paper_id", "pos", sections.is_heading(C("txt"), C("size"), C("bold"), C("body_size")).alias("cand"))


@query(f"WITH {_SECTIONS} SELECT paper_id, section_no, heading, body FROM sx WHERE section_no <= 14")
def t9_line_sections(spark, d):
    return sections.sections_of_lines(_lines(spark, d))


@query(f"WITH {_SECTIONS}, en AS (SELECT paper_id FROM sx WHERE section_no <= 14 GROUP BY 1 HAVING count(*) >= 2), fl AS (SELECT paper_id, string_agg(txt, chr(10) ORDER BY pos) AS body FROM lines WHERE paper_id NOT IN (SELECT paper_id FROM en) GROUP BY 1) SELECT paper_id, section_no FROM sx JOIN en USING (paper_id) WHERE section_no <= 14 UNION ALL SELECT paper_id, unnest(range(1, least(14, CAST(ceil(length(body) / 7000.0) AS BIGINT)) + 1)) FROM fl")
def t10_pdf_sections(spark, d):
    return sections.pdf_sections(_lines(spark, d)).select("paper_id", "section_no")


@query("SELECT doc_id, length(coalesce(text,'')) > 0 AND contains(text, '$') OR regexp_matches(coalesce(text,''), '\\\\[A-Za-z]+|\\\\[()\\[\\]]') AS tex, regexp_matches(coalesce(text,''), '(?i)(?:図|表|式|アルゴリズム)\\s*[0-9０-９IVXivx]+|\\b(?:fig(?:ure)?|table|algorithm|equation|eq\\.)\\s*[0-9IVXivx]+') AS numbered FROM documents")
def pred15_section_issues(spark, d):
    return read_table(spark, d, "documents").select("doc_id", quality.has_tex(C("text")).alias("tex"), quality.has_numbered_reference(C("text")).alias("numbered"))


@query("SELECT seen_id, (length(coalesce(tldr,'')) - length(replace(coalesce(tldr,''), '提供された情報からは不明', ''))) // 12 AS unknown, length(regexp_replace(coalesce(tldr,''), '^\\s+|\\s+$', '', 'g')) = 0 AS no_text FROM seen_ledger")
def pred7_unknown_phrases(spark, d):
    return schema.ledger(spark, d).select("seen_id", quality.unknown_phrases(C("tldr")).cast("long").alias("unknown"), quality.no_text(C("tldr"), F.array()).alias("no_text"))


@query("SELECT seen_id, '@@TLDR@@' || chr(10) || trim(coalesce(tldr,'')) || chr(10) || '@@WHAT@@' || chr(10) || trim(coalesce(title,'')) AS marked FROM seen_ledger")
def t19_marked(spark, d):
    return schema.ledger(spark, d).select("seen_id", summaries.marked({"tldr": F.trim("tldr"), "what": F.trim("title")}).alias("marked"))


@query(f"SELECT seq, substr('[stub] tldr: ' || substr(CASE WHEN {q.strip('abstract')} <> '' THEN {q.strip('abstract')} ELSE title END, 1, 120), 1, 400) AS tldr FROM {P}")
def l8_stub(spark, d):
    none = F.array().cast(sections.SECTIONS)
    return schema.papers(spark, d).select("seq", summaries.stub(C("title"), C("abstract"), none)["tldr"].alias("tldr"))


@query("SELECT doc_id, coalesce(nullif(regexp_extract(text, 'href\\s*=\\s*[\"'']([^\"'']+)[\"'']', 1), ''), '') <> '' AS linked FROM documents WHERE text IS NOT NULL")
def t21_page_links(spark, d):
    links = F.regexp_extract("text", r"""href\s*=\s*["']([^"']+)["']""", 1)
    return read_table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", (links != "").alias("linked"))


@query(
    "WITH t AS (SELECT doc_id, site, row_number() OVER (PARTITION BY site ORDER BY doc_id) AS turn, substr(coalesce(heading,''), 1, 20) AS question, substr(coalesce(text,''), 1, 60) AS answer FROM documents WHERE site IS NOT NULL AND source = 'reading') SELECT doc_id, right(coalesce(string_agg('Q: ' || question || chr(10) || 'A: ' || answer, chr(10)) OVER (PARTITION BY site ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), 6000) AS history FROM t"
)
def l9_history(spark, d):
    from pyspark.sql import Window

    docs = read_table(spark, d, "documents").where("site IS NOT NULL AND source = 'reading'")
    turns = docs.select("doc_id", C("site").alias("page_file"), F.row_number().over(Window.partitionBy("site").orderBy("doc_id")).alias("turn"), F.substring(F.coalesce("heading", F.lit("")), 1, 20).alias("question"), F.substring(F.coalesce("text", F.lit("")), 1, 60).alias("answer"))
    return stages.with_history(turns).select("doc_id", "history")


@query()
def t17_clean_text(spark, d):
    return read_table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", markup.cleaned("text").alias("plain"))


@query()
def t23_markdown(spark, d):
    return read_table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", markup.as_html("text").alias("html"))


@query()
def pred16_repeated_parts(spark, d):
    rows = read_table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", *(F.get(texts.chunks(C("text"), 400, 5), F.lit(n)).alias(p) for n, p in enumerate(summaries.PARTS[1:])))
    return summaries.repeated_parts(rows, "doc_id")


@query()
def t14_review_evidence(spark, d):
    docs = read_table(spark, d, "documents").where("rec_id IS NOT NULL")
    part = F.struct(F.coalesce("heading", F.lit("")).alias("heading"), F.coalesce("text", F.lit("")).alias("body"))
    secs = docs.groupBy(C("rec_id").alias("seq")).agg(F.array_sort(F.collect_list(part)).alias("sections"))  # the texts of one record
    return schema.papers(spark, d).join(secs, "seq").select("seq", summaries.review_evidence(C("title"), C("authors"), C("abstract"), C("sections"), 8_000).alias("evidence"))


@query()
def j4b_enriched_venues(spark, d):
    """Registry records with venues of the papers of two sources, by DOI and title."""
    r = read_table(spark, d, "registry_records").select(C("bib_id").alias("qid"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("title", "doi", "venue", "published")), F.lit("").alias("arxiv_id"), F.lit("").alias("url"), F.lit("").alias("pdf_url"))
    p = schema.papers(spark, d).withColumn("cid", C("seq"))
    given = [p.where(C("source") == s).select("cid", "title", "venue", "citations", "doi", "arxiv_id", "published", "url", "pdf_url") for s in ("dblp", "openalex")]
    return resolve.enrich_venues(r, given).select("qid", "venue", "published")


@query()
def j5_enriched_fulltext(spark, d):
    r = read_table(spark, d, "registry_records").select(C("bib_id").alias("qid"), F.coalesce("title", F.lit("")).alias("title"), F.lit("").alias("arxiv_id"), F.lit("").alias("pdf_url"))
    p = schema.papers(spark, d).where("arxiv_id <> ''").select(C("seq").alias("cid"), "title", "venue", "published", "arxiv_id", "pdf_url")
    return resolve.enrich_fulltext(r, p).where("arxiv_id <> ''").select("qid", "arxiv_id")


@query()
def j10_candidates(spark, d):
    """The first eight titles for a query, as the search prints them; the limit is the feature."""
    led = schema.ledger(spark, d)
    return lookup.score_titles(led, "Robust Passage Ranking").orderBy(C("score").desc(), "seen_id").limit(8)
