"""Pieces of ANSI-style SQL (as DuckDB runs it) that mirror the column functions."""

from __future__ import annotations

P = "(SELECT rec_id AS seq, coalesce(field_slug,'') AS field_slug, coalesce(source,'') AS source, coalesce(title,'') AS title, coalesce(abstract,'') AS abstract, coalesce(authors, []) AS authors, coalesce(published,'') AS published, coalesce(venue,'') AS venue, coalesce(url,'') AS url, coalesce(pdf_url,'') AS pdf_url, coalesce(arxiv_id,'') AS arxiv_id, coalesce(doi,'') AS doi, coalesce(citations,0) AS citations, coalesce(matched_keywords, []) AS matched_keywords, scan_mode, fetched_at FROM papers)"
WS = r"[\s\p{Z}]"


def lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x},''), '^{WS}+|{WS}+$', '', 'g')"


def squeeze(x: str) -> str:
    return strip(f"regexp_replace(coalesce({x},''), '{WS}+', ' ', 'g')")


def ntitle(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x},'')), '[^a-z0-9]+', ' ', 'g'))"


def ndoi(x: str) -> str:
    return strip(f"regexp_replace(regexp_replace(lower({strip(x)}), '^https?://(dx\\.)?doi\\.org/', ''), '^doi:', '')")


def narxiv(x: str) -> str:
    a = f"regexp_replace(lower({strip(x)}), '^https?://(www\\.)?arxiv\\.org/(abs|pdf)/', '')"
    a = f"regexp_replace(regexp_replace({a}, '^arxiv:', ''), '\\.pdf$', '')"
    return strip(f"regexp_replace({a}, 'v\\d+$', '')")


def doi_arxiv(x: str) -> str:
    return f"CASE WHEN starts_with({ndoi(x)}, '10.48550/arxiv.') THEN {narxiv(f'substr({ndoi(x)}, 16)')} ELSE '' END"


def ftext(a: str = "arxiv_id", p: str = "pdf_url", d: str = "doi") -> str:
    return f"CASE WHEN {a} <> '' THEN 3 WHEN {p} <> '' THEN 2 WHEN {d} <> '' THEN 1 ELSE 0 END"


def distinct(parts: list[tuple[str, str]]) -> str:
    """Ordered list of named values without '' and repeats."""
    items = ", ".join(f"CASE WHEN {v} <> '' THEN '{k}' || {v} END" for k, v in parts)
    return f"(SELECT list(x ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest([{items}]) AS x, generate_subscripts([{items}], 1) AS i) WHERE x IS NOT NULL GROUP BY x))"


def _spaced(x: str) -> str:
    """Everything but letters, digits and _ as single blanks, one at either end."""
    return f"(' ' || regexp_replace({x}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+', ' ', 'g') || ' ')"


def has_word(body: str, keyword: str) -> str:
    """The keyword stands in the text, between characters that are neither letters, digits nor _."""
    kw = f"lower({strip(keyword)})"
    return f"({kw} <> '' AND contains({body}, {kw}) AND contains({_spaced(body)}, {_spaced(kw)}))"


def usable(x: str) -> str:
    v = squeeze(x)
    return f"({v} <> '' AND lower({v}) NOT IN ('unknown','n/a','none','-','未取得') AND lower(regexp_replace({v}, '[\\s._()/-]+', '', 'g')) NOT IN ('arxiv','arxivorg','arxivcornelluniversity','corr','biorxiv','medrxiv','researchsquare','ssrn'))"


def conference(x: str) -> str:
    from bibweave.functions.venue import CONFERENCES

    low = f"lower({squeeze(x)})"
    names = ", ".join(map(lit, CONFERENCES))
    return f"(list_has_any(regexp_extract_all({low}, '[a-z0-9]+'), ['conference','symposium','workshop','congress','proceedings']) OR list_has_any(regexp_extract_all({low}, '[a-z0-9]+'), [{names}]))"


def with_year(x: str, published: str) -> str:
    v = squeeze(x)
    year = f"regexp_extract({published}, '\\b((?:19|20)\\d{{2}})\\b', 1)"
    return f"CASE WHEN {usable(x)} AND {conference(x)} AND NOT regexp_matches({v}, '\\b(?:19|20)\\d{{2}}\\b') AND {year} <> '' THEN {v} || ' ' || {year} ELSE {v} END"


#: Papers of subscribed fields with key, relevance, matched keywords and full-text score.
SCORED = f"""
scored AS (
  SELECT p.field_slug, p.seq, p.title, p.abstract, p.published, p.citations, p.scan_mode, greatest(1, least(CAST(s.k AS INTEGER), 20)) AS k, {ftext('p.arxiv_id', 'p.pdf_url', 'p.doi')} AS fulltext,
    CASE WHEN p.doi <> '' THEN 'doi:' || lower(p.doi) WHEN p.arxiv_id <> '' THEN 'arxiv:' || lower(p.arxiv_id) ELSE 'title:' || {ntitle('p.title')} END AS paper_key,
    s.ambiguous_keywords, s.context_keywords, s.ambiguous_context_groups,
    CAST(coalesce((SELECT sum(CASE WHEN {has_word('lower(p.title)', 'u.kw')} THEN 3 ELSE 0 END + CASE WHEN {has_word('lower(p.abstract)', 'u.kw')} THEN 1 ELSE 0 END) FROM (SELECT unnest(s.keywords) AS kw) u), 0) AS BIGINT) AS relevance,
    coalesce((SELECT list({strip('u.kw')} ORDER BY u.i) FROM (SELECT unnest(s.keywords) AS kw, generate_subscripts(s.keywords, 1) AS i) u WHERE {has_word('lower(p.title)', 'u.kw')} OR {has_word('lower(p.abstract)', 'u.kw')}), []) AS matched
  FROM {P} p JOIN subscriptions s ON s.username = p.field_slug)
"""
#: The same with the context issue of each record, '' if there is none.
GATED = f"""
gb AS (SELECT field_slug, seq, lower(title || chr(10) || abstract) AS body, list_distinct(list_transform(matched, lambda m: lower(m))) AS m, list_filter(list_transform(ambiguous_keywords, lambda m: lower({strip('m')})), lambda m: m <> '') AS amb, context_keywords, ambiguous_context_groups AS acg FROM scored),
gg AS (SELECT field_slug, seq, body, lower({strip('k')}) AS acro, grp FROM (SELECT field_slug, seq, body, unnest(map_keys(acg)) AS k, unnest(map_values(acg)) AS grp FROM gb)),
ga AS (SELECT field_slug, seq, body, acro, unnest(grp) AS terms FROM gg),
gok AS (SELECT field_slug, seq, acro, bool_or(len(list_filter(terms, lambda t: {strip('t')} <> '')) > 0 AND len(list_filter(terms, lambda t: {strip('t')} <> '' AND NOT {has_word('body', 't')})) = 0) AS ok FROM ga GROUP BY 1, 2, 3),
gr AS (SELECT b.field_slug, b.seq, b.m, b.amb, coalesce((SELECT list(acro) FROM gok WHERE gok.field_slug = b.field_slug AND gok.seq = b.seq), []) AS conf, coalesce((SELECT list(upper(acro) ORDER BY upper(acro)) FROM gok WHERE gok.field_slug = b.field_slug AND gok.seq = b.seq AND NOT ok AND list_contains(b.m, acro)), []) AS missing,
  len(context_keywords) = 0 OR EXISTS (SELECT 1 FROM (SELECT unnest(b.context_keywords) AS kw) u WHERE {has_word('b.body', 'u.kw')}) AS ctx FROM gb b),
gated AS (SELECT s.*, CASE WHEN len(amb) = 0 OR len(m) = 0 OR NOT list_has_all(amb, m) THEN '' WHEN len(conf) > 0 AND len(missing) > 0 THEN 'required terms missing: ' || array_to_string(missing, ', ') WHEN len(conf) > 0 AND list_has_all(conf, m) THEN '' WHEN ctx THEN '' ELSE 'no context of the field: ' || array_to_string(list_sort(list_transform(m, lambda x: upper(x))), ', ') END AS issue FROM scored s JOIN gr USING (field_slug, seq))
"""
_IMPORTANT = "relevance DESC, fulltext DESC, citations DESC, published DESC, seq"
_RECENT = "relevance DESC, fulltext DESC, published DESC, seq"


def queue(source: str = "scored", quotas: str | None = None) -> str:
    """CTEs up to ``queue``; ``source`` may have in_important and in_recent, ``quotas`` (field_slug, important_left, recent_left)."""
    pools = "in_important, in_recent" if source != "scored" else "true AS in_important, true AS in_recent"
    left = f"JOIN {quotas} USING (field_slug)" if quotas else ""
    slots = "important_left, recent_left" if quotas else "CASE WHEN k <= 1 THEN 0 ELSE least(2, k - 1) END AS important_left, k - CASE WHEN k <= 1 THEN 0 ELSE least(2, k - 1) END AS recent_left"
    return f"""
w AS (SELECT *, row_number() OVER (PARTITION BY field_slug, paper_key ORDER BY {_IMPORTANT}) AS copy_no, {pools.replace('in_important, in_recent', '1 AS one') if source != 'scored' else pools}, {slots} FROM {source} {left} WHERE relevance > 0),
x AS (SELECT *, row_number() OVER (PARTITION BY field_slug ORDER BY {_IMPORTANT}) AS ri, row_number() OVER (PARTITION BY field_slug, in_important ORDER BY {_IMPORTANT}) AS rp FROM w WHERE copy_no = 1),
y0 AS (SELECT *, in_important AND rp <= important_left AS im FROM x),
y AS (SELECT *, row_number() OVER (PARTITION BY field_slug, im, in_recent ORDER BY {_RECENT}) AS rr FROM y0),
z AS (SELECT *, CASE WHEN im THEN 0 WHEN in_recent AND rr <= recent_left THEN 1 ELSE 2 END AS phase FROM y),
queue AS (SELECT field_slug, seq, k, phase, row_number() OVER (PARTITION BY field_slug ORDER BY phase, CASE WHEN phase = 1 THEN rr ELSE ri END) AS queue_pos FROM z)
"""


QUEUE = queue()
