"""Golden rows and brute-force comparisons of operators that SQL can't express, and of those of the daily run."""

import difflib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from bibweave.functions import labels, markup, quality, texts
from bibweave.operators import lookup, ranking, resolve, run, sections, stages, summaries, views
from bibweave.schema import PAPER
from bibweave.sources import connectors, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_numbering_without_a_task_per_group(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(4)}", rng.randrange(9), k) for k in range(2_000)]
    df = spark.createDataFrame(rows, "g string, v int, id long").repartition(7)
    got = {r.id: r.n for r in ranking.numbered(df, "g", [F.col("v").desc(), F.col("id").asc()], "n").collect()}
    want, seen = {}, {}
    for g, _, k in sorted(rows, key=lambda r: (-r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        want[k] = seen[g]
    assert got == want
    assert ranking.numbered(df.limit(0), "g", [F.col("id").asc()], "n").count() == 0


def test_waves_equal_one_by_one(spark):
    rng = random.Random(5)
    queue = spark.createDataFrame([(f, n, rng.random() < 0.3) for f in "ab" for n in range(1, 30)], "field_slug string, queue_pos int, ok boolean")
    rows = lambda df: {(r.field_slug, r.queue_pos, r.passed) for r in df.collect()}
    for k in (1, 3, 50):
        assert rows(ranking.waves(queue, F.col("ok"), F.lit(k))) == rows(ranking.first_passing(queue, F.col("ok"), F.lit(k)))


def scored(spark, rows):
    base = {"field_slug": "f", "title": "t", "published": "2020", "citations": 0, "k": 3, "relevance": 1, "fulltext": 3, "issue": ""}
    return spark.createDataFrame([base | {"seq": n, "paper_key": f"k{n}"} | r for n, r in enumerate(rows, 1)])


def test_queue_takes_a_work_once_and_from_its_pool(spark):
    rows = [{"relevance": 9, "citations": 5, "paper_key": "x"}, {"relevance": 9, "citations": 1, "paper_key": "x"}, {"relevance": 8, "in_recent": False}, {"relevance": 2, "published": "2031"}, {"relevance": 0}, {"relevance": 1}]
    s = scored(spark, [{"in_recent": True, "in_important": True} | r for r in rows])
    full = {r.seq: (r.phase, r.queue_pos) for r in ranking.selection_queue(s).collect()}
    assert full == {1: (0, 1), 3: (0, 2), 4: (1, 3), 6: (2, 4)}
    left = spark.createDataFrame([("f", 0, 1)], "field_slug string, important_left int, recent_left int")
    assert {r.seq: (r.phase, r.queue_pos) for r in ranking.selection_queue(s, left).collect()} == {1: (1, 1), 3: (2, 2), 4: (2, 3), 6: (2, 4)}


def daily(spark):
    blank = {f.name: ([] if f.name in ("authors", "matched_keywords") else 0 if f.name == "citations" else "") for f in PAPER}
    mk = lambda n, title, mode, **more: blank | {"seq": n, "field_slug": "f", "scan_mode": mode, "title": title} | more
    papers = spark.createDataFrame(
        [
            mk(1, "Kelp rafts", "important", arxiv_id="2911.00001", citations=9), mk(2, "Kelp rafts again", "recent", arxiv_id="2911.00002", published="2031-01-01"), mk(3, "Kelp known", "recent", doi="10.1/known"),
            mk(4, "Nothing of it", "recent", arxiv_id="2911.00004"), mk(5, "Kelp without text", "important"), mk(6, "Kelp rafts", "recent", arxiv_id="2911.00001"), mk(7, "海藻 kelp", "recent", pdf_url="https://x/y.pdf"),
        ],
        "seq long, field_slug string, scan_mode string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PAPER),
    )
    ledger = spark.createDataFrame([("f", "doi:10.1/known", "", "", "", "2031-02-02", "recent"), ("f", "title:by hand", "By hand", "", "", "2031-02-02", "manual")], "field_slug string, paper_key string, title string, doi string, arxiv_id string, added_on string, selection string")
    subs = spark.createDataFrame([("f", ["kelp"], 3, [], None, [])], "username string, keywords array<string>, k long, ambiguous_keywords array<string>, ambiguous_context_groups map<string,array<array<string>>>, context_keywords array<string>")
    return papers, ledger, subs


def test_daily_run(spark):
    papers, ledger, subs = daily(spark)
    q = run.quotas_today(ledger, subs).first()
    assert (q.already, q.important_left, q.recent_left) == (1, 2, 0)
    queue = run.daily_queue(papers, ledger, subs)
    assert {r.seq: (r.phase, r.queue_pos) for r in queue.collect()} == {1: (0, 1), 2: (0, 2), 7: (2, 3), 5: (2, 4)}
    taken = run.consume(queue)
    assert {r.seq: r.passed for r in taken.collect()} == {1: 1, 2: 1}
    m = run.metrics(papers, ledger, subs).first()
    assert (m.candidates, m.fresh, m.relevant, m.picked, m.added, m.skipped, m.shortfall) == (7, 6, 5, 2, 2, 0, 0)
    kept = run.carry_over(papers, ledger, subs, taken)
    assert {r.seq for r in kept.collect()} == {5, 6, 7}
    again = run.with_cache(papers.where("seq = 4"), kept)
    assert again.count() == 4 and again.select("seq").distinct().count() == 4
    report = {r.paper.seq: (r.outcome, r.selection) for r in run.report_rows(taken, papers).collect()}
    assert report == {1: ("added", "important"), 2: ("added", "important")}
    made = run.manual_entry(papers.where("seq = 1"), F.array(F.lit("kelp")), F.lit("kelp-rafts"), F.lit("2031-02-03")).first()
    assert (made.relevance, made.selection, made.page_file) == (1, "manual", "f/kelp-rafts.html")


def test_title_matches_against_all_pairs(spark):
    rng = random.Random(6)
    words = "kelp raft mooring swell winter drift buoy anchor chart harbour pilot storm census lantern quarry ledger orchard turbine glacier meadow".split()
    titles = [" ".join(rng.sample(words, 7)) for _ in range(120)]
    slip = lambda t: "".join(c for n, c in enumerate(t) if n not in set(rng.sample(range(len(t)), 3)))
    queries = [(k, slip(t)) for k, t in enumerate(titles[:60])]
    q = spark.createDataFrame(queries, "qid int, title string")
    c = spark.createDataFrame([(k, t, "", 0) for k, t in enumerate(titles)], "cid int, title string, venue string, citations int")
    got = {r.qid: r.cid for r in lookup.best_title_match(q, c).collect()}
    want = {}
    for k, t in queries:
        best = max(((difflib.SequenceMatcher(None, t, x).ratio(), -n) for n, x in enumerate(titles)))
        if best[0] >= 0.84:
            want[k] = -best[1]
    assert all(got[k] == want[k] for k in got) and len(got) >= 0.95 * len(want) > 40


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_sketches_and_common_letters_rule_out_no_match():
    rng = random.Random(8)
    letters = " aeinrst0k"
    a = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 5, 63, 64, 65, 128, 129, 220]))) for _ in range(120)]
    b = ["".join(c for c in t if rng.random() > 0.1) + rng.choice(letters) for t in a]
    assert lookup.common_letters(a, b).tolist() == [_lcs(x, y) for x, y in zip(a, b)]
    apart = np.bitwise_count((lookup.sketches(a) ^ lookup.sketches(b)).view(np.uint64)).reshape(len(a), 2, -1).sum(axis=2)
    for x, y, (counts, pairs), common in zip(a, b, apart.tolist(), lookup.common_letters(a, b).tolist()):
        blocks = sum(m.size for m in difflib.SequenceMatcher(None, x, y).get_matching_blocks())
        free = len(x) + len(y) - 2 * blocks
        assert counts <= free and pairs <= 3 * free and blocks <= common


def test_common_letters_of_pairs_beside_a_long_title():
    """One long title among many pairs: each pair cost as much as the longest, some minutes for these."""
    rng = random.Random(12)
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    a, b = ([make(rng.randint(20, 140)) for _ in range(300)] for _ in range(2))
    pairs = [(rng.choice(a), rng.choice(b)) for _ in range(12_000)] + [(make(4_000), b[0]), (a[0], make(5_000))]
    rng.shuffle(pairs)
    began = time.process_time()
    got = lookup.common_letters(*map(list, zip(*pairs)))
    assert time.process_time() - began < 5
    longest = sorted(range(len(pairs)), key=lambda i: -max(map(len, pairs[i])))
    assert all(got[i] == _lcs(*pairs[i]) for i in longest[:2] + longest[2::600])


def test_title_matches_in_large_blocks(spark):
    # 1 200 x 1 200 titles meet over the same words; comparing each pair letter by letter took minutes.
    syllables = [c + v for c in "bdgklmnprstvz" for v in "aeiou"]
    name = lambda n: "".join(syllables[(n * p) % 65] for p in (1, 7, 11)) + syllables[n // 65]
    titles = [f"kelp rafts {'and moorings ' * (n % 5)}under {name(n)} winter swell" for n in range(1_200)]
    q = spark.createDataFrame([(n, t if n % 2 else t.replace("winter", "wnter")) for n, t in enumerate(titles)], "qid int, title string")
    c = spark.createDataFrame([(n, t, "", 0) for n, t in enumerate(titles)], "cid int, title string, venue string, citations int")
    began = time.time()
    got = lookup.best_title_match(q, c).collect()
    assert {r.qid: r.cid for r in got} == {n: n for n in range(1_200)}
    assert {r.ratio for r in got if r.qid % 2} == {1.0} and all(r.ratio < 1 for r in got if not r.qid % 2)
    assert time.time() - began < 60


def test_title_matches_leave_out_no_pair(spark, monkeypatch):
    """A slip in every word, frequent words alone, few letters: rare words in common missed such pairs."""
    for name, size in (("QUERIES", 20), ("CANDIDATES", 30), ("BLOCK_LETTERS", 900), ("PART", 70)):  # several blocks and parts
        monkeypatch.setattr(lookup, name, size)
    rng = random.Random(15)
    words = "moorings lanterns orchards turbines glaciers harbours anchorage quarries meadows pilotage censuses".split()
    titles = [" ".join(rng.sample(words, rng.randint(1, 7))) for _ in range(150)] + ["a", "ab c", "kelp " * 60 + "raft", *(" ".join(rng.choices(words, k=30)) for _ in range(5))]
    titles = sorted(set(titles))
    slip = lambda w: (lambda n: w[:n] + rng.choice(["", "x", w[n] + "q"]) + w[n + 1 :])(rng.randrange(len(w)))
    queries = [" ".join(map(slip, t.split())) for t in titles] + ["kelp " * 59 + "raft", "moorings", "b"]
    q = spark.createDataFrame(list(enumerate(queries)), "qid int, title string")
    c = spark.createDataFrame([(n, t, "", 0) for n, t in enumerate(titles)], "cid int, title string, venue string, citations int")
    for threshold in (0.84, 0.7):
        got = {r.qid: (r.cid, r.ratio) for r in lookup.best_title_match(q, c, threshold).collect()}
        want = {}
        for k, t in enumerate(queries):
            t = " ".join(t.split())
            ratio, n = max((difflib.SequenceMatcher(None, x, t).ratio(), -n) for n, x in enumerate(titles))  # the candidate first
            if t and ratio >= threshold:
                want[k] = (-n, ratio)
        assert got == want and sum(r < 1 for _, r in want.values()) > 60


def test_halves_rule_out_no_match():
    rng = random.Random(16)
    make = lambda n: "".join(rng.choice(" aeinrst0k") for _ in range(n))
    worn = lambda t: "".join(rng.choice(["", "e", x + "i"]) if rng.random() < 0.12 else x for x in t) or "a"
    known = sorted((make(n) for n in [1, 2, 3, 4, 5, 8, 63, 64, 65, 80, 83, 84, 85, 220, 700] for _ in range(6)), key=len)
    asked = sorted(map(worn, known), key=len)
    block = lambda titles: lookup._block(np.arange(len(titles)), titles, True)
    q = lookup._Queries(*(block(asked)[f] for f in ("numbers", "titles", "sketch")), 0.8)
    c = lookup._Candidates(*(block(known)[f] for f in ("numbers", "titles", "sketch", "half")))
    near = {(i, j) for x, y in lookup._letters_near(q, c) for i, j in zip(*(z.tolist() for z in lookup._halves_near(q, c, x, y)))}
    sizes = q.sizes[:, None] + c.sizes
    common = lookup.common_letters([x for x in asked for _ in known], known * len(asked)).reshape(sizes.shape)
    must = set(zip(*(x.tolist() for x in np.nonzero(2 * common >= 0.8 * sizes))))
    assert must <= near and len(must) > 60 and len(near) < len(asked) * len(known) / 2


def _alike(n):
    """n titles that share all words but one, which a fixed seed makes."""
    rng = random.Random(9)
    return [f"kelp rafts and moorings under {''.join(rng.choice('bdgklmnprstvzaeiou') for _ in range(8))} winter swell" for _ in range(n)]


def test_venues_of_titles_in_large_blocks(spark):
    titles = _alike(1_000)
    q = spark.createDataFrame([(n, t.replace("winter", "wnter"), "", "", "", "", "", "") for n, t in enumerate(titles)], "qid int, title string, doi string, arxiv_id string, venue string, published string, url string, pdf_url string")
    cols = "cid int, title string, doi string, arxiv_id string, venue string, citations int, published string, url string, pdf_url string"
    source = lambda ns: spark.createDataFrame([(n, titles[n], "", "", f"Letters of Kelp {n}", 0, "", "", "") for n in ns], cols)
    began = time.time()
    got = {r.qid: r.venue for r in resolve.enrich_venues(q, [source(range(0, 1_000, 2)), source(range(1_000))]).collect()}
    assert {n: v for n, v in got.items() if n % 2 == 0} == {n: f"Letters of Kelp {n}" for n in range(0, 1_000, 2)} and all(got.values())
    assert time.time() - began < 90


def test_preprints_of_titles_in_large_blocks(spark):
    titles = _alike(1_000)
    q = spark.createDataFrame([(n, t.replace("winter", "wnter"), "", "") for n, t in enumerate(titles)], "qid int, title string, arxiv_id string, pdf_url string")
    p = spark.createDataFrame([(n, t, f"29{n:02d}.1", "", "2029-01-01", "") for n, t in enumerate(titles)], "cid int, title string, arxiv_id string, pdf_url string, published string, venue string")
    began = time.time()
    assert {r.qid: r.arxiv_id for r in resolve.enrich_fulltext(q, p).collect()} == {n: f"29{n:02d}.1" for n in range(1_000)}
    assert time.time() - began < 60


def test_venues_of_titles_with_many_records(spark):
    """Titles are compared once, not once for each two of their records: 400 x 400 of each."""
    titles = _alike(30)
    q = spark.range(12_000).selectExpr("CAST(id AS int) AS qid", f"replace(element_at(array({', '.join(map(repr, titles))}), CAST(id % 30 AS int) + 1), 'winter', 'wnter') AS title", *(f"'' AS {c}" for c in ("doi", "arxiv_id", "venue", "published", "url", "pdf_url")))
    p = spark.range(12_000).selectExpr("CAST(id AS int) AS cid", f"element_at(array({', '.join(map(repr, titles))}), CAST(id % 30 AS int) + 1) AS title", "concat('Letters of Kelp ', id) AS venue", "CAST(id % 7 AS int) AS citations", *(f"'' AS {c}" for c in ("doi", "arxiv_id", "published", "url", "pdf_url")))
    began = time.time()
    got = {r.qid: r.venue for r in resolve.enrich_venues(q, [p]).collect()}
    best = {t: max((n % 7, -n) for n in range(t, 12_000, 30)) for t in range(30)}
    assert got == {n: f"Letters of Kelp {-best[n % 30][1]}" for n in range(12_000)}
    assert time.time() - began < 40


def test_preprints_of_titles_with_many_records(spark):
    """Titles are compared once; of equal ones the newer preprint is taken."""
    listed = f"array({', '.join(map(repr, _alike(30)))})"
    q = spark.range(12_000).selectExpr("CAST(id AS int) AS qid", f"replace(element_at({listed}, CAST(id % 30 AS int) + 1), 'winter', 'wnter') AS title", "'' AS arxiv_id", "'' AS pdf_url")
    p = spark.range(12_000).selectExpr("CAST(id AS int) AS cid", f"element_at({listed}, CAST(id % 30 AS int) + 1) AS title", "concat('29.', id) AS arxiv_id", "'' AS pdf_url", "CAST(date_add(DATE'2029-01-01', CAST(id AS int)) AS string) AS published", "'' AS venue")
    began = time.time()
    assert {r.qid: r.arxiv_id for r in resolve.enrich_fulltext(q, p).collect()} == {n: f"29.{12_000 - 30 + n % 30}" for n in range(12_000)}
    assert time.time() - began < 40


def test_lookups_over_sources(spark):
    q = spark.createDataFrame([(1, "Kelp rafts under swell", "10.1/A", "", "arXiv", "", "", ""), (2, "Mooring of winter buoys", "", "", "", "", "", "")], "qid int, title string, doi string, arxiv_id string, venue string, published string, url string, pdf_url string")
    cols = "cid int, title string, doi string, arxiv_id string, venue string, citations int, published string, url string, pdf_url string"
    a = spark.createDataFrame([(5, "Other title", "https://doi.org/10.1/a", "", "CoRR", 0, "2030", "", ""), (6, "Mooring of winter buoy", "", "", "Journal of Kelp", 0, "", "u", "")], cols)
    b = spark.createDataFrame([(7, "x", "10.1/a", "", "Kelp Letters", 0, "1999", "", "p")], cols)
    got = {r.qid: (r.venue, r.published, r.url, r.pdf_url) for r in resolve.enrich_venues(q, [a, b]).collect()}
    assert got == {1: ("Kelp Letters", "2030", "", "p"), 2: ("Journal of Kelp", "", "u", "")}
    pre = spark.createDataFrame([(8, "Mooring of winter buoys", "2911.1", "", "2029-01-01", "V"), (9, "Mooring of winter buoys", "2911.2", "", "2030-01-01", "V")], "cid int, title string, arxiv_id string, pdf_url string, published string, venue string")
    assert {r.qid: r.arxiv_id for r in resolve.enrich_fulltext(q, pre).collect()} == {1: "", 2: "2911.2"}
    c = a.unionByName(b).withColumns({"qid": F.lit(1), "abstract": F.lit("")}).withColumn("title", F.lit("Kelp rafts under swell"))
    best = resolve.re_resolve(q, c).first()
    assert (best.cid, best.venue, best.doi, best.url) == (7, "Kelp Letters", "10.1/a", "u")


def test_excerpts_and_sentences(spark):
    body = "Filler words. " * 60 + "It rose by 12 percent. " + "Filler words. " * 60
    got = one(spark, texts.excerpt(F.lit(body), F.lit(1_200)))
    assert "rose by 12 percent" in got and len(got) <= 1_200 and got.startswith("Filler words.") and texts.MIDDLE in got
    assert one(spark, texts.excerpt(F.lit(" short "), F.lit(1_200))) == "short"
    assert one(spark, texts.sentences(F.lit("Too short. This sentence, however, is long enough! これはとても長い文なので、確かに残るはずの文である。"))) == ["thissentencehoweverislongenough", "これはとても長い文なので確かに残るはずの文である"][:2]
    secs = F.array(*(F.struct(F.lit(h).alias("heading"), F.lit(b).alias("body")) for h, b in (("One", "a " * 4_000), ("Two", "b"))))
    shown = one(spark, summaries.review_evidence(F.lit("T"), F.array(F.lit("A")), F.lit("abs"), secs, 4_000))
    assert shown.startswith("Title: T\nAuthors: A\nAbstract: abs\n") and "## One" in shown and shown.endswith("## Two\nb") and len(shown) <= 4_000


@pytest.mark.parametrize(
    "tex,plain",
    [
        (r"a $\frac{x}{y} \leq 3$ b", "a (x)/(y) <= 3 b"), (r"\(\mathbf{v}_{i}\)", "v_i"), ("cost $5 and on", "cost 5 and on"), (r"$$\sum_i \log x$$", "sum_i log x"), (r"\[a \times \frac{\frac{1}{2}}{b}\]", "a x ((1)/(2))/(b)"),
        ("図3に示すように、速い", "速い"), ("Algorithm 2 と Eq. (4)", "提案手順 と この定式化"), (None, ""),
    ],
)
def test_formulas(tex, plain):
    assert markup.clean_generated(tex) == plain


def test_markdown():
    got = markup.markdown_html("## A & b\n- x **y**\n\n|a|b|\n|---|:--|\n|1|`2`|\n```\nk < 1\n```\nend <i>")
    assert got == "<h4>A &amp; b</h4>\n<ul><li>x <strong>y</strong></li></ul>\n<table><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>1</td><td><code>2</code></td></tr></tbody></table>\n<pre><code>k &lt; 1</code></pre>\n<p>end &lt;i&gt;</p>"


def test_summary_issues(spark):
    issues = lambda t: one(spark, quality.section_issues(F.lit(t)))
    assert issues("plain words") == [] and issues("cost is $x$") == ["TeX left"] and issues("see Table 4") == ["numbered reference"] and issues("updateKelpRaft 関数を使う") == ["name from pseudo-code"] and issues("updateKelp 関数") == []
    part = "The rafts were moored in deep water and checked each winter by divers."
    rows = spark.createDataFrame([(1, "t", part, part.replace("divers", "pilots"), "An entirely other matter is told here, of lanterns and ledgers.", "v", "d"), (2, "t", "a", "", "c", "v", "d")], "id int, tldr string, what string, contribution string, method string, validation string, discussion string")
    got = {r.id: r.issues for r in summaries.synthesis_issues(rows, "id").collect()}
    assert got[1] == ["what repeats contribution"] and got[2] == ["missing: contribution"]
    assert one(spark, quality.unknown_phrases(F.lit("提供された情報からは不明。提供された情報からは不明"))) == 2


def test_stages(spark):
    class Fake:
        """Answers by what is asked; some calls fail."""

        def chat(self, system, user, max_tokens):
            if "boom" in user:
                raise TimeoutError("no answer")
            if system.startswith("Rate"):
                return "@@SCORE@@\n4\n@@REASON@@\nsound"
            if system.startswith("Write") or "keep the marks" in system or "keep its marks" in system:
                word = "better" if "Mend" in system else "first"
                return "\n".join(f"@@{p.upper()}@@\n{word} {p}" for p in summaries.PARTS)
            return f"{system[:9]}|{user[:12]}"

    papers = spark.createDataFrame([("a", "some evidence", "fulltext", 3, "s"), ("b", "boom", "fulltext", 150, "boom")], "paper_id string, evidence string, basis string, citations int, summary string")
    got = {r.paper_id: (r.what, r.error) for r in stages.summarise(papers, Fake(), lambda p: ["short"] if p["what"].startswith("first") else []).collect()}
    assert got["a"] == ("better what", "") and got["b"][0] is None and got["b"][1].startswith("TimeoutError")
    assert stages.summarise(papers, None).where("paper_id = 'a'").first().what == "[stub] what: some evidence"
    assert {r.paper_id: (r.value, r.reason == "sound") for r in stages.reading_values(papers, Fake()).collect()} == {"a": (4, True), "b": (5, False)}
    secs = spark.createDataFrame([("a", 1, "H", "body"), ("a", 2, "H", "boom")], "paper_id string, section_no int, heading string, body string")
    drafts = {r.section_no: (r.summary, r.error != "") for r in stages.section_drafts(secs, Fake(), lambda t: []).collect()}
    assert drafts[1] == ("Correct t|Summarise|##", False) and drafts[2][1]
    turns = spark.createDataFrame([("p", 1, "q1", "a1"), ("p", 2, "q2", None)], "page_file string, turn int, question string, answer string")
    ctx = spark.createDataFrame([("p", "context")], "page_file string, context string")
    assert [(r.turn, r.answer) for r in stages.answers(turns, ctx, Fake()).collect()] == [(2, "Answer fr|context\n\nQ: ")]
    assert stages.with_history(turns).where("turn = 2").first().history == "Q: q1\nA: a1"
    with pytest.raises(ValueError):
        stages.parse_parts("nothing marked")


def test_fulltext_chain(spark):
    long = "kelp rafts " * 40
    attempts = [("p", "fulltext(ar5iv)", [("Introduction", long), ("Method", long), ("Result", long)]), ("p", "fulltext(arxiv)", [("Access paper", long)]), ("q", "fulltext(oa-pdf)", [("Introduction", "other things " * 40), ("Method", long[:10])]), ("r", "fulltext(arxiv-text)", [("Introduction", long), ("Method", long), ("Result", long)])]
    tried = spark.createDataFrame(attempts, "paper_id string, basis string, sections array<struct<heading:string,body:string>>")
    papers = spark.createDataFrame([(p, "Kelp rafts under swell") for p in "pqr"], "paper_id string, title string")
    assert {r.paper_id: r.basis for r in sections.fulltext_chain(papers, tried).collect()} == {"p": "fulltext(ar5iv)", "q": "abstract", "r": "abstract"}
    assert {r.paper_id: r.basis for r in sections.question_chain(papers, tried).collect()} == {"p": "fulltext(ar5iv)", "q": "abstract", "r": "fulltext(arxiv-text)"}
    files = spark.createDataFrame([("f.pdf", b"%PDF")], "path string, content binary")
    lines = sections.pdf_lines(files, lambda content: [(12, True, "ﬁrst"), (10, False, " "), (10, False, "second")])
    assert [(r.pos, r.size, r.txt) for r in lines.collect()] == [(1, 12.0, "first"), (2, 10.0, "second")]


def test_views(spark):
    led = spark.createDataFrame(
        [(1, "f", "Kelp & rafts", ["A B", " "], "KELPCON", "2030-01-01", "tells of kelp", "important", "", "fulltext(arxiv)", 3, 2, "4", ["kelp"], "2031-01-02", "", "f/a.html"), (2, "f", "Other", None, "", "", "", "", "", "", None, None, "", None, "2031-01-01", "", "f/b.html")],
        "seen_id long, field_slug string, title string, authors array<string>, venue string, pub_date string, tldr string, selection string, selection_label string, basis string, citations long, relevance long, reading_value string, matched_keywords array<string>, added_on string, added_at string, page_file string",
    )
    subs = spark.createDataFrame([("f", "Kelp", ["other", "kelp"])], "username string, label string, keywords array<string>")
    pages = spark.createDataFrame([("f/b.html", "C D", "Kelp Letters")], "page_file string, authors string, venue string")
    e = {r.seen_id: r for r in views.entries(led, subs, pages).collect()}
    assert e[1].chips == ["重要論文", "キーワード一致 1", "被引用 3", "関連度 2", "本文(arXiv)", "読む価値 4/5"] and e[1].latest and e[1].people == "A B"
    assert (e[2].tags, e[2].people, e[2].place, e[2].chips, e[2].latest) == (["other"], "C D", "Kelp Letters", ["キーワード一致 1"], False)
    html = views.field_pages(views.entries(led, subs, pages)).first().html
    assert html.index("Kelp &amp; rafts") < html.index("Other") and html.count("<li") == 2
    talk = spark.createDataFrame([("f/a.html", 1, "q", "a", "t")], "page_file string, turn int, question string, answer string, asked_at string")
    assert [r.turn for r in views.append_followup(talk, "f/a.html", "q2", "a2", "t").orderBy("turn").collect()] == [1, 2]
    assert views.clear_followups(talk, "f/a.html").count() == 0


def test_sources_and_cache(spark, tmp_path):
    raw = lambda body: spark.createDataFrame([(0, body)], "seq int, body string")
    page = '<li class="arxiv-result"><a href="https://arxiv.org/abs/2911.70042v1">x</a><p class="title">T</p></li>'
    asked = []
    assert connectors.search(raw("<feed></feed>"), raw(page), wait=asked.append).first().arxiv_id == "2911.70042" and asked == []
    with pytest.raises(RuntimeError):
        connectors.search(raw("<feed></feed>"), raw(""), attempts=2, wait=asked.append)
    assert asked == [1]
    assert [connectors.page_size(n, t) for n, t in ((40, 2), (60, 2), (500, 1), (10, 3))] == [25, 50, 200, 25]
    assert not connectors.answers_mode("dblp", "important") and connectors.answers_mode("openalex", "important")
    subs = connectors.subscriptions_of(spark, [{"username": "f", "keywords": ["kelp"], "search_queries": [["a", "b"], "c"], "ambiguous_context_groups": {"KRD": ["raft", ["kelp", "farm"]]}, "k": 3}]).first()
    assert subs.search_queries == ["a + b", "c"] and subs.ambiguous_context_groups == {"KRD": [["raft"], ["kelp", "farm"]]} and subs.manual is False
    assert sinks.load_cache(spark, str(tmp_path), "f", "recent").count() == 0
    rows = connectors.search(raw(""), raw(page)).withColumn("seq", F.lit(1).cast("long"))
    sinks.save_cache(rows, str(tmp_path), "f", "recent")
    assert sinks.load_cache(spark, str(tmp_path), "f", "recent").first().arxiv_id == "2911.70042"
    (tmp_path / "f" / "important").mkdir()
    (tmp_path / "f" / "important" / "part.parquet").write_bytes(b"broken")
    assert sinks.load_cache(spark, str(tmp_path), "f", "important").count() == 0


def test_pages_read_back(spark):
    page = '<title>x</title><h1>Kelp <b>rafts</b></h1><div class="meta">A B, C D<br>Kelp Letters ・ 2030-01-01</div><main>body <a href="https://arxiv.org/abs/2911.70042v2">1</a><a href="https://doi.org/10.1/AB">2</a><a href="/x/y.pdf">3</a></main>'
    r = one(spark, markup.page_record(F.lit(page)))
    assert (r.title, r.authors, r.venue, r.published) == ("Kelp rafts", "A B, C D", "Kelp Letters", "2030-01-01") and r.body.startswith("body")
    links = one(spark, markup.page_links(F.lit(page)))
    assert (links.pdf_url, links.doi, links.arxiv_id) == ("/x/y.pdf", "10.1/ab", "2911.70042")


def test_busy_services_and_single_records(spark):
    waits, left = [], [2]

    def fetch():
        left[0] -= 1
        if left[0] >= 0:
            raise connectors.BusyError
        return "answer"

    assert connectors.retried(fetch, waits.append) == "answer" and waits == [5.0, 10.0]
    left[0] = 9
    with pytest.raises(connectors.BusyError):
        connectors.retried(fetch, waits.append)
    rows = spark.createDataFrame([("2911.70042v2", "a"), ("", "b")], "arxiv_id string, title string")
    assert [r.title for r in connectors.record_by_id(rows, "arXiv:2911.70042").collect()] == ["a"] and connectors.record_by_id(rows, "").count() == 0
    assert one(spark, labels.shortened(F.lit("k" * 70))) == "k" * 61 + "…" and one(spark, labels.shortened(F.lit("short"))) == "short"
