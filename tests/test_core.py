import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bibweave.functions import identity as I
from bibweave.functions import match, quality, texts, venue
from bibweave.operators import dedup, lookup, ranking, report, sections
from bibweave.plans import catalog
from bibweave.sources import connectors, sinks
from bibweave.streaming import incremental

DATA = "/root/testdata/sf0.001"


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


def papers(spark, rows):
    base = {"field_slug": "f", "source": "s", "title": "", "abstract": "", "published": "", "venue": "", "url": "", "pdf_url": "", "arxiv_id": "", "doi": "", "citations": 0}
    return spark.createDataFrame(pd.DataFrame([base | {"seq": n} | r for n, r in enumerate(rows, 1)]))


def test_identity(spark):
    c = lambda x: F.lit(x)
    assert one(spark, I.normalize_title(c("KELP - Rafts under  Winter Swell!"))) == "kelp rafts under winter swell"
    assert one(spark, I.normalize_doi(c("https://doi.org/10.48550/arXiv.2911.70042"))) == "10.48550/arxiv.2911.70042"
    assert one(spark, I.doi_arxiv_id(c("https://doi.org/10.48550/arXiv.2911.70042"))) == "2911.70042"
    assert one(spark, I.normalize_arxiv_id(c("arXiv:2911.70042v3"))) == "2911.70042"
    assert one(spark, I.slugify(c(" A/B  c!! "))) == "a-b-c"
    assert one(spark, I.slugify(c("!!!"))) == "item"
    assert one(spark, I.paper_aliases(c("日本"), c(""), c(""))) == []


def test_context_gate(spark):
    ambiguous, context = F.array(F.lit("KRW"), F.lit("KRD")), F.array().cast("array<string>")
    groups = F.create_map(F.lit("KRD"), F.array(F.array(F.lit("kelp"), F.lit("raft"))))
    issue = lambda title, *m: one(spark, match.context_issue(F.lit(title), F.lit(""), F.array(*map(F.lit, m)), ambiguous, context, groups))
    assert issue("KRD as the name of a radio band", "KRD").startswith("required terms missing")
    assert issue("KRD for a kelp farm with one raft", "KRD") == ""
    assert issue("whatever", "KRD", "kelp raft drift") == ""


def test_word_boundaries(spark):
    kws = F.array(F.lit("RAG"), F.lit("b+c"))
    got = lambda t: one(spark, match.matched_keywords(F.lit(t), F.lit(""), kws))
    assert got("a storage system") == [] and got("éRAG") == [] and got("RAG_x") == []
    assert got("on RAG and b+c") == ["RAG", "b+c"]


def test_venues(spark):
    assert not one(spark, venue.usable(F.lit("arXiv (Cornell University)"))) and not one(spark, venue.usable(F.lit("CoRR")))
    assert one(spark, venue.with_year(F.lit("ICAPS"), F.lit("2026-05-01"))) == "ICAPS 2026"
    assert one(spark, venue.with_year(F.lit("ICAPS 2026"), F.lit("2026"))) == "ICAPS 2026"
    assert one(spark, venue.with_year(F.lit("Artificial Intelligence"), F.lit("2026"))) == "Artificial Intelligence"
    assert one(spark, venue.from_comment(F.lit("Accepted at KELPCON 2031. 9 pages."))) == "KELPCON 2031"
    assert one(spark, venue.from_comment(F.lit("Submitted to KELPCON 2032."))) == ""


def test_quotas(spark):
    left = lambda k, i, r: tuple(one(spark, x) for x in ranking.remaining_quotas(F.lit(k), F.lit(i + r), F.lit(i), F.lit(r)))
    assert left(2, 0, 1) == (1, 0) and left(2, 1, 0) == (0, 1) and left(2, 1, 1) == (0, 0)


def test_first_passing(spark):
    queue = spark.createDataFrame([("a", n, n in (2, 4, 5)) for n in range(1, 8)], "field_slug string, queue_pos int, ok boolean")
    got = [r.queue_pos for r in ranking.first_passing(queue, F.col("ok"), F.lit(2)).orderBy("queue_pos").collect()]
    assert got == [1, 2, 3, 4]
    assert ranking.first_passing(queue, F.lit(False), F.lit(2)).count() == 7


def test_sequential_and_components(spark):
    rows = papers(spark, [{"title": "T one"}, {"title": "T two", "doi": "10.1/a"}, {"title": "T one", "doi": "10.1/a"}, {"title": "日本"}, {"title": "東京"}])
    seq = {r.seq: r.cluster for r in dedup.sequential_clusters(rows).collect()}
    assert seq == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
    named = rows.withColumn("aliases", I.paper_aliases(F.col("title"), F.col("doi"), F.col("arxiv_id")))
    comp = {r.seq: r.root for r in dedup.alias_classes(named, "field_slug", "seq", "aliases").collect()}
    assert comp == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_merge_fold(spark):
    rows = papers(spark, [{"title": "a", "doi": "10.1/a", "abstract": "x", "citations": 1}, {"title": "b", "arxiv_id": "1", "citations": 9}, {"title": "c", "arxiv_id": "2", "abstract": "y"}]).withColumn("cluster", F.lit("k"))
    m = dedup.merge_clusters(rows, "cluster").first()
    assert (m.title, m.arxiv_id, m.doi, m.abstract, m.citations) == ("b", "1", "10.1/a", "x", 9)


def test_quality(spark):
    title = F.lit("Mooring Line Inspection for Drifting Kelp Rafts")
    kit = F.lit("Formatting instructions. Paper size and camera-ready. Illustrations.")
    assert not one(spark, quality.plausible(kit, title))
    assert one(spark, quality.plausible(F.lit("A mooring is an inspection of its line"), title))
    assert one(spark, F.size(quality.char_ngrams(F.lit("ab")))) == 0
    assert one(spark, quality.containment(F.lit("abcdef"), F.lit("xx abcdef yy"))) == 1.0


def test_chunks_and_excerpt(spark):
    sizes = lambda n: one(spark, F.size(texts.chunks(F.repeat(F.lit("x"), n))))
    assert [sizes(n) for n in (0, 1, 7000, 7001, 98_001)] == [0, 1, 1, 2, 14]
    body = "Filler words. " * 80 + "It rose from 40% to 75%. " + "Filler words. " * 80
    got = one(spark, texts.evidence_excerpt(F.lit(body), 900, r"\d+%"))
    assert "40% to 75%" in got and len(got) <= 900
    assert one(spark, texts.parse_marked(F.lit("@@A@@ one\n@@B@@ two"))) == {"a": "one", "b": "two"}


def test_html_sections():
    page = "<h1>T</h1><p>a<script>x</script></p><h2>Intro</h2>b<table>c</table><h2>Empty</h2><h2>End</h2>d"
    assert sections.html_to_sections(page) == [("T", "a"), ("Intro", "b"), ("End", "d")]


def test_line_sections(spark):
    lines = [
        (1, 16.0, "Kelp Rafts under Winter Swell"), (2, 10.0, "someone of somewhere"), (3, 13.0, "Abstract"), (4, 10.0, "we do things here and we say at some length what they are."), (5, 13.0, "1 Introduction"),
        (6, 10.0, "it starts with a  sentence of some length,"), (7, 10.5, "Figure 3: not a heading"), (8, 10.0, "it goes on."), (9, 13.0, "2 Method"), (10, 10.0, "short."), (11, 13.0, "References"), (12, 10.0, "[1] x, and many words behind it to be long enough"),
    ]
    df = spark.createDataFrame([("p", p, s, False, t) for p, s, t in lines] + [("q", 1, 10.0, False, "no heading at all")], "paper_id string, pos int, size double, bold boolean, txt string")
    got = [(r.section_no, r.heading, r.body) for r in sections.sections_of_lines(df).orderBy("section_no").collect()]
    assert got == [(1, "Abstract", "we do things here and we say at some length what they are."), (2, "1 Introduction", "it starts with a sentence of some length, Figure 3: not a heading it goes on.")]
    whole = {(r.paper_id, r.heading) for r in sections.pdf_sections(df).collect()}
    assert whole == {("p", "Abstract"), ("p", "1 Introduction"), ("q", "本文 (1/1)")}


@pytest.mark.parametrize("txt,size,bold,want", [("1 Introduction", 10.6, False, True), ("1 Introduction", 10.5, False, False), ("1 Introduction", 9.9, True, True), ("Our view", 10.0, True, False), ("OUR VIEW", 10.6, False, True), ("Table 2 of results", 14.0, True, False), ("a b c d e f g h i j k l m", 14.0, True, False), ("Related work and more", 10.0, True, True), ("IV", 14.0, True, False)])
def test_heading(spark, txt, size, bold, want):
    assert one(spark, sections.is_heading(F.lit(txt), F.lit(size), F.lit(bold), F.lit(10.0))) is want


def test_lookup(spark):
    q = spark.createDataFrame([(1, "Planning with priorities in grids")], "qid int, title string")
    c = spark.createDataFrame([(5, "Planning with priorities in grid", "CoRR", 3), (6, "Planning with priorities in grids", "AAAI", 1), (7, "Other title", "AAAI", 9)], "cid int, title string, venue string, citations int")
    assert lookup.best_title_match(q, c).first().cid == 6
    base = spark.createDataFrame([("k", "arXiv", "")], "key string, venue string, published string")
    low = spark.createDataFrame([("k", "CoRR", "2020")], "key string, venue string, published string")
    good = spark.createDataFrame([("k", "AAAI", "2026")], "key string, venue string, published string")
    late = spark.createDataFrame([("k", "ICML", "1999")], "key string, venue string, published string")
    r = lookup.coalesce_sources(base, "key", [low, good, late], ["published"]).first()
    assert (r.venue, r.published) == ("AAAI", "2020")


def test_sources(spark):
    atom = """<feed><entry><id>http://arxiv.org/abs/2601.00001v1</id><title>A
      title</title><summary>S &amp; t</summary><published>2026-01-02T00:00:00Z</published><author><name>A B</name></author>
      <arxiv:comment>Accepted at KELPCON 2031. 9 pages.</arxiv:comment><link title="pdf" href="http://arxiv.org/pdf/2601.00001v1"/></entry></feed>"""
    page = """<li class="arxiv-result"><a href="https://arxiv.org/abs/2911.70042v1">x</a><p class="title">T</p><p class="authors"><a>A</a>, <a>B</a></p>
      <span class="abstract-full">text △ Less</span><p>Submitted 6 August, 2026;</p><p class="comments">Comments: Accepted to KELPCON 2032. 8 pages.</p></li>"""
    work = '{"results":[{"title":"W","publication_date":"2026-01-01","doi":"https://doi.org/10.1/x","cited_by_count":4,"abstract_inverted_index":{"b":[1],"a":[0,2]}}]}'
    hits = '{"result":{"hits":{"hit":[{"info":{"title":"D.","year":"2020","venue":"V","authors":{"author":{"text":"X Y 0001"}}}}]}}}'
    raw = lambda body: spark.createDataFrame([(0, body)], "seq int, body string")
    both, log = connectors.gather({"arxiv": raw(atom), "arxiv-search": raw(page), "openalex": raw(work), "dblp": raw(hits), "nowhere": raw("")})
    rows = {r.source: r for r in both.collect()}
    told = {r.source: (r.n, r.error != "") for r in log.collect()}
    assert told == {"arxiv": (1, False), "arxiv-search": (1, False), "openalex": (1, False), "dblp": (1, False), "nowhere": (0, True)}
    assert rows["arxiv"].arxiv_id == "2601.00001" and rows["arxiv"].venue == "KELPCON 2031" and rows["arxiv"].abstract == "S & t"
    assert (rows["arxiv-search"].published, rows["arxiv-search"].authors, rows["arxiv-search"].venue, rows["arxiv-search"].abstract) == ("2026-08-06", ["A", "B"], "KELPCON 2032", "text")
    assert (rows["openalex"].abstract, rows["openalex"].doi, rows["openalex"].citations) == ("a b a", "10.1/x", 4)
    assert (rows["dblp"].title, rows["dblp"].authors) == ("D", ["X Y"])


def test_stored_answers(spark, tmp_path):
    (tmp_path / "a.json").write_text("one")
    (tmp_path / "b.json").write_text("two")
    spark.dataSource.register(connectors.StoredAnswers)
    got = spark.read.format("stored_answers").load(str(tmp_path)).orderBy("seq").collect()
    assert [r.body for r in got] == ["one", "two"]


def test_sinks(spark, tmp_path):
    assert sinks.render("<b>{{a}}</b>{{missing}}", {"a": "x"}) == "<b>x</b>"
    with pytest.raises(ValueError):
        sinks.safe_path("../x")
    df = spark.createDataFrame([("f", "t")], "field_slug string, title string")
    sinks.save_ledger(df, f"{tmp_path}/l")
    assert sinks.load_ledger(spark, f"{tmp_path}/l", df.schema).count() == 1
    assert sinks.load_ledger(spark, f"{tmp_path}/none", df.schema).count() == 0
    assert sinks.rendered(df, "{{title}}!", "field_slug").first().html == "t!"


def test_report_guard(spark):
    mk = lambda d, produced, n, skipped, added: spark.createDataFrame([(d, produced, [("f", n, n, n, [(a,) for a in added], [(s,) for s in skipped])])], report.REPORT)
    old = mk("d", 1, 100, ["a", "b", "c"], ["p"])
    assert report.keep_existing(old, mk("d", 0, 1, [], ["p"])).first().keep
    assert not report.keep_existing(old, mk("d", 1, 1, [], ["p"])).first().keep
    assert not report.keep_existing(old, mk("d", 0, 1, [], [])).first().keep


def test_stream(spark, tmp_path):
    rows = papers(spark, [{"title": "A work"}, {"title": "a WORK"}, {"title": "Another"}])
    rows.where("seq = 1").write.parquet(f"{tmp_path}/in/1")
    rows.where("seq > 1").write.parquet(f"{tmp_path}/in/2")
    incremental.run_stream(spark, f"{tmp_path}/in/*", rows.schema, f"{tmp_path}/state", f"{tmp_path}/out", f"{tmp_path}/ck")
    assert {r.title for r in spark.read.schema(rows.schema).parquet(f"{tmp_path}/out/*").collect()} in ({"A work", "Another"}, {"a WORK", "Another"})


def _rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(None if x is None or x != x else (round(float(x), 6) if isinstance(x, float) else str(x)) for x in r) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f[:-8]} as select * from '{DATA}/{f}'")
    want = con.execute(catalog.oracle_sql()[name]).df()
    got = catalog.queries()[name](spark, DATA).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and _rows(got) == _rows(want)
