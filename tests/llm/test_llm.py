import itertools
import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bibweave.llm import corpus_encoding, entity_match, format_duplicates, history_dedup, leakage, subjects, survivorship, value_mapping, works
from bibweave.llm.text import least_rotation, rotation_key
from bibweave.llm.forest import TREES, signatures
from bibweave.llm.works import _edits, components, components_in_rounds, featurise, plausible, record_features, same_title, surnames

TITLES = [
    (1, "Sodozomu: lesion grading with patients"), (2, "lesion grading with patients [Sodozomu]"), (3, "SODOZOMU – LESION <b>GRADING</b> WITH PATIENTS"),
    (4, "Sodozomu: lesion grading with patient"), (5, "grading lesion with patients: Sodozomu"), (6, None), (7, "  "), (8, "ﬁne \\emph{words} &amp; more"), (9, "Fine words & more!"),
    (10, "with patients Sodozomu lesion grading"), (11, "Größe und Maß"), (12, "GRÖSSE UND MASS"), (13, "???"), (14, "???"), (15, "x" * 30_000 + ": tail"), (16, "tail | " + "X" * 30_000),
]


def test_least_rotation():
    for s in ("", "a", "ba", "abab", "cabcab", "zzza"):
        want = min((s[i:] + s[:i] for i in range(max(1, len(s)))), default="")
        assert s[least_rotation(s) :] + s[: least_rotation(s)] == want
    long = "ba" * 200 + "ac"
    assert long[least_rotation(long) :] + long[: least_rotation(long)] == min(long[i:] + long[:i] for i in range(len(long)))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_format_duplicates(spark, partitions):
    df = spark.createDataFrame(TITLES + [(3, TITLES[2][1])], "rec_id long, title string").withColumn("key", F.lit("clash"))
    got = {(r.first_id, r.id) for r in format_duplicates.format_duplicates(df, "rec_id", "title", partitions).collect()}
    assert got == {(1, 2), (1, 3), (8, 9), (11, 12), (15, 16)}
    copies = {r.first_id: r.copies for r in format_duplicates.collapsed(df, "rec_id", "title", partitions).collect()}
    assert copies[1] == 3 and copies[4] == 1 and copies[8] == 2


def test_format_duplicates_hot_group_and_empty(spark):
    hot = spark.range(3000).select(F.col("id").alias("rec_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("One hot  title"), F.repeat(F.lit("!"), (F.col("id") % 5).cast("int")))).otherwise(F.concat(F.lit("t"), "id")).alias("title"))
    got = format_duplicates.format_duplicates(hot, "rec_id", "title", 8)
    assert got.count() == 999 and got.select("first_id").distinct().collect()[0].first_id == 0
    assert format_duplicates.format_duplicates(hot.limit(0), "rec_id", "title").count() == 0


def test_format_duplicates_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/papers.parquet")
    rows = df.select("rec_id", "title").collect()
    first, want = {}, set()
    for r in sorted(rows, key=lambda r: r.rec_id):
        k = rotation_key(r.title)[0]
        if k:
            first.setdefault(k, r.rec_id)
            if first[k] != r.rec_id:
                want.add((first[k], r.rec_id))
    got = {(r.first_id, r.id) for r in format_duplicates.format_duplicates(df, "rec_id", "title").collect()}
    assert got <= want and len(want - got) <= 1


def test_survivorship(spark):
    t = datetime.fromisoformat
    text = "A whole abstract of a paper that ends as it should."
    rows = [
        (1, t("2026-01-01"), "arxiv", "T", 5, "Journal of X", "https://a.example/p.pdf", text), (2, t("2026-01-02"), "dblp", "T", 99_999_999, "arXiv", "https://login.example/?next=%2Fpdf", text[:30] + " …"),
        (3, t("2026-01-03"), None, "T", -1, "Submitted to Journal of Y", "about:blank", "Abstract not available."), (4, None, "arxiv", None, None, None, None, None),
        (5, t("2026-01-01"), "arxiv", "U", 0, "", "", "U"), (6, t("2026-01-09"), "crossref", "T", 7, "International Conference on Sta…", "", ""),
    ]
    papers = spark.createDataFrame(rows, "rec_id long, fetched_at timestamp, source string, title string, citations long, venue string, pdf_url string, abstract string").withColumn("level", F.lit(1))
    groups = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 4), (1, 1), (2, 5), (3, 6), (3, 99), (None, 1)], "group_id long, rec_id long")
    got = {(r.group_id, r.field_name): r.rec_id for r in survivorship.winners(groups, papers).collect()}
    assert got == {(1, "citations"): 1, (1, "venue"): 1, (1, "pdf_url"): 1, (1, "abstract"): 1, (3, "citations"): 6, (3, "venue"): 6}
    one = survivorship.survivors(groups, papers).where("group_id = 1").first()
    assert (one.citations, one.venue) == (5, "Journal of X")
    assert survivorship.winners(groups.limit(0), papers).count() == 0


def test_survivorship_newest_wins_and_ties(spark):
    rows = [(n, datetime(2026, 1, 1) + timedelta(days=n // 2), "arxiv", "T", n, "", "", "") for n in range(1, 8)]
    papers = spark.createDataFrame(rows, "rec_id long, fetched_at timestamp, source string, title string, citations long, venue string, pdf_url string, abstract string")
    groups = spark.createDataFrame([(1, n) for n in range(1, 8)], "group_id long, rec_id long")
    assert survivorship.winners(groups, papers).first().rec_id == 6  # 6 and 7 are as new; the smaller id


def test_value_mapping(spark):
    listed = [(1, "International Conference on Warehouse Autonomy", "IConWA"), (2, "Journal of Statute Mining", "JoSM"), (3, "Journal of Sprint Mechanics", "JoSME"), (4, "Transactions on Statute Mining", "TraSM")]
    ref = spark.createDataFrame(listed, "venue_id long, venue_name string, acronym string")
    cases = {
        "Journal of Statute Mining": 2, "J. of Statute Mning": 2, "JoSM'22": 2, "JoSME 2024": 3, "Accepted at IConWA 2025": 1, "<i>Transactions on Statute Mining</i>": 4, "Statute Mining, Transactions on": 4,
        "Conférence internationale Warehouse Autonomy": 1, "Workshop on Kites at JoSM 2024": 0, "Submitted to JoSM": 0, "Journal of Bell Acoustics": 0, "International Conference on Wareh…": 1, "arXiv": 0, "?": 0,
        "Trans on Statute Mining, vol. 24, no. 4, pp. 191-526": 4, "x" * 50_000: 0,
    }
    rows = [(n, v) for n, v in enumerate(cases)] + [(100, None), (101, " 　\t")]
    df = spark.createDataFrame(rows, "rec_id long, venue string").withColumn("score", F.lit(1))
    args = ("rec_id", "venue", "venue_id", "venue_name", "acronym")
    got = {r.id: r.ref_id for r in value_mapping.map_values(df, ref, *args).collect()}
    assert {v: got[n] for n, v in enumerate(cases)} == cases and 100 not in got and 101 not in got
    assert {r.ref_id for r in value_mapping.map_values(df, ref.limit(0), *args).collect()} == {0}
    assert value_mapping.map_values(df.limit(0), ref, *args).count() == 0


@pytest.mark.parametrize(
    "a,b,level",
    [
        ("Vosuhe: Grid Maps for Deep Planning in Sites", "Grid Maps for Deep Planning in Sites (Vosuhe)", 2),
        ("Vosuhe: Grid Maps for Deep Planning in Sites", "Vosuhe: Gird Maps with Deep Planing in Sites (v2)", 2),
        ("Vosuhe: Grid Maps for Deep Planning in Sites", "Vosuhe: Grid Maps for Deep Planning in Sites, Part II", 3),
        ("Vosuhe: Grid Maps for Deep Planning in Sites", "Vosuhe: Grid Maps for Deep Planning in Sites Addendum", 3),
        ("Vosuhe: Grid Maps for Deep Planning in Sites", "Vosuhe: Grid Maps for Deep Plan", 1),
        ("Vosuhe: Grid Maps for Deep Planning in Sites", "Erratum to Vosuhe: Grid Maps for Deep Planning in Sites", 0),
        ("Vosuhe 2: Grid Maps for Deep Planning in Sites", "Vosuhe: Grid Maps for Deep Planning in Sites", 0),
        ("Vosuhe: Grid Maps for Deep Planning in Sites", "Kiradu: Grid Maps for Deep Planning in Sites", 0),
        ("Vosuhe: Grid Maps for Deep Pla…", "Vosuhe: Grid Maps for Deep Planning in Sites", 1),
        ("Vosuhe: Deep Planning for Grid Maps in Sites", "Vosuhe: Grid Maps for Deep Planning in Sites", 0),
    ],
)
def test_same_title(a, b, level):
    f, g = ([x[1], x[2], x[3], x[4], x[5]] for x in (record_features(t, []) for t in (a, b)))
    assert same_title(*f, *g)[0] == level == same_title(*g, *f)[0]


def test_edits():
    assert _edits("abcd", "abdc", 3) == 1 and _edits("abc", "abxc", 3) == 1 and _edits("abcdef", "uvwxyz", 3) == 4 and _edits("", "ab", 3) == 2


def test_surnames():
    assert surnames(["Iothal Gorondaki", "Pellastelle, Pandri", "R. Ulvaguara", "BREMIORN B", "et al.", None, ""]) == ["gorondaki", "pellastelle", "ulvaguara", "bremiorn"]


def test_match_sources(spark):
    p = [
        (1, "Vosuhe: Grid Maps for Deep Planning in Sites", ["Ann Lee"], "2024", "10.12345/a1", ""), (2, "Vosuhe: Gird Maps for Deep Planning in Sites", ["A. Lee"], "2024", "", ""),
        (3, "Vosuhe: Grid Maps for Deep Planning in Sites, Part II", ["Ann Lee"], "2025", "", ""), (4, None, None, None, None, None), (5, "Editorial", ["Bo Ek"], "2024", "", ""),
        (6, "Wholly retitled text about other things", ["Ann Lee"], "2024", "10.12345/a1", ""), (7, "Someone else with that number entered", ["Cy Oh"], "2011", "10.12345/a1", ""),
    ]
    b = [(1, "Grid Maps for Deep Planning in Sites — Vosuhe", ["Lee, Ann"], "2024", None), (2, "Editorial", ["Ek, Bo"], "2024", ""), (3, "Vosuhe: Grid Maps for Dep Planning in Sites, Part II", ["Lee, A."], "2025", "")]
    papers = spark.createDataFrame(p, "rec_id long, title string, authors array<string>, published string, doi string, arxiv_id string").withColumn("node", F.lit(1))
    registry = spark.createDataFrame(b, "bib_id long, title string, authors array<string>, published string, doi string")
    groups = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "group_id long, rec_id long")
    got = {(r.rec_id, r.bib_id): r.confidence for r in entity_match.match_sources(papers, registry, groups).collect()}
    assert set(got) == {(1, 1), (2, 1), (6, 1), (3, 3)} and all(0 < c < 1 for c in got.values())
    assert entity_match.match_sources(papers.limit(0), registry).count() == 0


def _batch(spark, rows):
    df = spark.createDataFrame(rows, "id long, title string, authors array<string>, published string, doi string, arxiv_id string")
    return featurise(df, "id", "title", "authors", "published", F.col("doi"), F.col("arxiv_id"))


def test_history_dedup_batches_equal_one_batch(spark):
    first = [(1, "Vosuhe: Grid Maps for Deep Planning in Sites", ["Ann Lee"], "2024", "", ""), (2, "Front Matter", None, "2024", "n/a", "0000.00000"), (3, "Kiradu: Wound Healing under Mixed Light", ["Bo Ek"], "2020", "", "2401.00012")]
    second = [(10, "Grid Maps for Deep Planing in Sites: Vosuhe", ["A. Lee"], "2024", "", ""), (11, "Front Matter", None, "2024", "n/a", "0000.00000"), (12, "Vosuhe: Grid Maps for Deep Planning in Sites Revisited", ["Ann Lee"], "2025", "", "")]
    third = [(20, "Lessons of another name altogether", ["Bo Ek"], "2020", "10.48550/arXiv.2401.00012", ""), (21, "Vosuhe: Grid Maps for Deep Plan...", ["Lee, Ann"], "2024", "", ""), (22, None, None, None, None, None)]
    forest = history_dedup.HashForest(spark)
    step = {}
    for rows in (first, second, third):
        step |= {r.id: r.first_id for r in forest.add(_batch(spark, rows)).collect()}
    whole = {r.id: r.first_id for r in history_dedup.HashForest(spark).add(_batch(spark, first + second + third)).collect()}
    assert step == whole == {1: 1, 2: 2, 3: 3, 10: 1, 11: 11, 12: 12, 20: 3, 21: 1, 22: 22}
    forest.compact()
    again = {r.id: r.first_id for r in forest.add(_batch(spark, [(30, "KIRADU: WOUND HEALING UNDER MIXED LIGHT", ["EK B"], "", "", "")])).collect()}
    assert again == {30: 3}


def _matched(spark, papers, registry):
    p = spark.createDataFrame(papers, "rec_id long, title string, authors array<string>, published string, doi string").withColumn("arxiv_id", F.lit(""))
    b = spark.createDataFrame(registry, "bib_id long, title string, authors array<string>, published string, doi string")
    return {(r.rec_id, r.bib_id) for r in entity_match.match_sources(p, b).collect()}


def test_copies_of_cut_titles_join_their_full_title(spark):
    full = "Kiradu: wound healing under mixed light in crowded greenhouse laboratories"
    other = "Measured drift of quarry lanterns across seven abandoned valley stations"
    who = ["Bela Ek"]
    papers = [(k, full[:42] + " ...", who, "2020", "") for k in (1, 2, 3)] + [(4, full[:58] + "...", who, "2020", ""), (5, full[:58] + " …", who, "2020", ""), (6, other[:50] + "...", who, "2021", ""), (7, other[:50] + "...", who, "2021", "")]
    registry = [(11, full, who, "2020", ""), (12, other, who, "2021", ""), (13, other[:36] + " ...", who, "2021", "")]
    assert _matched(spark, papers, registry) == {(k, 11) for k in range(1, 6)} | {(k, b) for k in (6, 7) for b in (12, 13)}


def test_titles_with_shifted_words_match(spark):
    a = "build caching commit mining with verified branch coverage over crowded container images and slower release trains"
    b = "buid cac hing commitmining with verifed branch coverage over crowded container images and slower release trians"
    c = "kabemefi auction pricing between harbour ledgers"
    d = "kabe mefi auction pricnig between harbour ledgres"
    who = ["Bela Ek"]
    assert _matched(spark, [(1, a, who, "2020", ""), (2, c, who, "2021", "")], [(11, b, who, "2020", ""), (12, d, who, "2021", "")]) == {(1, 11), (2, 12)}


def test_records_without_authors_match_by_slips_and_starts(spark):
    titles = [
        ("Kiradu: wound healing under mixed light in crowded greenhouse laboratories", "Kiradu: wound haeling under mixed light in crowded grenhouse labroatories"),
        ("Measured drift of quarry lanterns across seven abandoned valley stations", "Measured drift of quarry lanterns across sev..."),
        ("Zomitu orchard pollination during unseasonable frost", "Zomitu orchard polli..."),
        ("Vasoho turbine blades recycled into footbridges by island schools", "Vasoho tubrine blades recycled into footbr..."),
    ]
    papers = [(k, full, ["Bela Ek"] if k % 2 else [], "2020", "") for k, (full, _) in enumerate(titles)]
    registry = [(10 + k, other, [] if k % 2 else ["Bela Ek"], "2020", "") for k, (_, other) in enumerate(titles)]
    assert _matched(spark, papers, registry) == {(k, 10 + k) for k in range(len(titles))}


def test_copies_within_one_source_do_not_hide_the_other(spark):
    p = "Kiradu: wound healing under mixed light in crowded greenhouse laboratories"
    q = p.replace("crowded", "crowdde")
    r = p.replace("wound", "wuond").replace("healing", "haeling")
    t = r.replace("mixed", "mixde")
    who = ["Bela Ek"]
    papers, registry = [(1, p, who, "2020", ""), (2, q, who, "2020", "")], [(11, r, who, "2020", ""), (12, t, who, "2020", "")]
    assert _matched(spark, papers, registry) == {(k, b) for k in (1, 2) for b in (11, 12)}


def test_identifier_of_a_work_with_many_copies(spark):
    words = ["quarry lantern drift", "orchard frost pollen", "turbine blade bridges", "harbour ledger slips", "meadow census tables", "glacier tunnel echoes"]
    slips = ["Ek", "Ekk", "Eek", "Ke", "Eck"]
    copies = [(k, f"Notes about {words[k]} number {k} of autumn", [f"Bela {slips[k]}", "Mora Lind"], "2020", "10.5555/work.77") for k in range(5)]
    volume = [(10 + k, f"Volume piece over {words[k]} and kin", [f"Ann Holder{k}"], "2020", "10.5555/volume.1") for k in range(5)]
    registry = [(50, "Quite another heading for that same study", ["Bela Ek", "Mora Lind"], "2020", "10.5555/work.77"), (51, "Unlike any piece of this volume here", ["Ann Holder3"], "2020", "10.5555/volume.1")]
    assert _matched(spark, copies + volume, registry) == {(k, 50) for k in range(5)}


TEXTS = [None, "", " ", "plain words here", "a <|endoftext|> b", "日本語のテキスト 😀 é", "line\n\n  two\t\ttabs   \n", "x" * 500, "don't we'll 's 123 " * 60, "a b " * 300 + "\n" * 90 + "end"]


@pytest.mark.parametrize("chunk,overlap,spread", [(64, 24, 10**6), (100, 40, 100), (64, 24, 200), (32_768, 1_024, 32_768)])
def test_encoding_is_that_of_the_whole_text(spark, chunk, overlap, spread):
    loaded = corpus_encoding.tokenizer(corpus_encoding.DEFAULT_TOKENIZER)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("n", F.lit(1))
    got = corpus_encoding.encode(df, "doc_id", "text", chunk=chunk, overlap=overlap, spread=spread)
    ids = {r.id: list(r.ids) for r in got.collect()}
    assert ids == {n: loaded.encode(t or "", add_special_tokens=False).ids for n, t in enumerate(TEXTS)}
    back = {r.id: r.text for r in corpus_encoding.decode(got, "id", "ids").collect()}
    assert back == {n: t or "" for n, t in enumerate(TEXTS)}


ITEM = "Petunka, retired inspector at Upper Norvesh, questioned 438 official token streams before the final jubilee unless the crooked ones arrived out of tune while the shift planner objected."


def test_leakage(spark):
    words = ITEM.split()
    docs = [
        (1, "Before it. " + ITEM.upper() + " After it."), (2, "x " + " ".join(words[3:20]).replace("official", "certain") + " y"), (3, "short " + " ".join(words[5:13]) + " run"),
        (4, None), (5, ""), (6, " ".join(sorted(words))), (7, "lead " * 5_000 + "\n".join(words) + " tail" * 5_000), (8, "<p>" + "</b> ".join(words) + "</p>"), (9, "nothing of the kind"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(0))
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "Quite other words than those of any document that is listed here, all of them unlike.")], "item_id long, text string")
    for block in (1, 100):
        got = {(r.doc_id, r.item_id) for r in leakage.leaked_passages(df, items, "doc_id", "text", "item_id", "text", block=block).collect()}
        assert got == {(1, 7), (2, 7), (7, 7), (8, 7)}
    assert leakage.leaked_passages(df, items.limit(0), "doc_id", "text", "item_id", "text").count() == 0


SHORT_WORDS = "A gull in an oak is at its egg, so I sat by it as he ate a fig; no one of us ran to a log or the dim bay"


def test_leakage_every_window_with_changed_words(spark):
    docs, want = [], set()
    items = [(7, ITEM), (8, SHORT_WORDS), (9, "Who hid a red fox in the old hut?")]
    for item, text in items[:2]:
        words = text.split()
        for at in range(len(words) - 14):
            for changed in ((), (4, 10), (3, 7, 11), (1, 8, 13), (5, 6, 7)):
                part = [f"altered{k}" if k in changed else w for k, w in enumerate(words[at : at + 15])]
                want.add((len(docs), item))
                docs.append((len(docs), "Before it there is other text. " + " ".join(part) + " And after it again other text."))
    docs += [(-1, "He asked: who hid a red fox, in the OLD hut?"), (-2, "Who hid a red fox in the new hut?"), (-3, " ".join(SHORT_WORDS.split()[4:13]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaked_passages(df, spark.createDataFrame(items, "item_id long, text string"), "doc_id", "text", "item_id", "text").collect()}
    assert got == want | {(-1, 9)}


def test_leakage_of_shared_phrases(spark):
    phrases = ["told the night clerk from", "a smaller rehearsal was kept", "the Hallow Street branch looked", "two days into the harvest"]
    question = "which of these many statements is the best supported one here, do tell"
    made = [(k, " ".join(phrases[i] for i in order)) for k, order in enumerate(itertools.permutations(range(4)))]
    suites = [(k, "Lodka inspected 41 crooked lamps of Jindora before any magpie had gone missing, whereas Sabeth traded them for wool.") for k in range(100, 105)]
    asked = [(k, " ".join(f"own{k}word{i}" for i in range(20)) + " " + question) for k in range(200, 205)]
    items = spark.createDataFrame(made + suites + asked, "item_id long, text string")
    edited = made[3][1].split()
    edited[4] = edited[11] = "altered"
    other = " ".join([phrases[0], "x y", phrases[1], "z", phrases[2]])  # shared phrases alone, with more than single words between them
    docs = [(1, "lead " + made[5][1] + " tail"), (2, " ".join(edited[1:19])), (3, suites[0][1]), (4, "so " + question + " now"), (5, asked[0][1]), (6, other)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = []
    for block in (1, 3, 100):
        found.append({(r.doc_id, r.item_id) for r in leakage.leaked_passages(df, items, "doc_id", "text", "item_id", "text", block=block).collect()})
    assert found[0] == found[1] == found[2]
    assert {(1, 5), (2, 3), (5, 200)} | {(3, k) for k in range(100, 105)} <= found[0]
    assert {d for d, _ in found[0]} == {1, 2, 3, 5} and {i for d, i in found[0] if d in (3, 5)} == {*range(100, 105), 200}


def test_alignment_brute_force():
    def best(d, i):
        top = 0
        h = [[0] * (len(i) + 1) for _ in range(len(d) + 1)]
        for x, y in itertools.product(range(1, len(d) + 1), range(1, len(i) + 1)):
            h[x][y] = max(0, h[x - 1][y - 1] + (1 if d[x - 1] == i[y - 1] else -1), h[x - 1][y] - 1, h[x][y - 1] - 1)
            top = max(top, h[x][y])
        return top

    item = "a b c d e f g h i j k l".split()
    for doc in ("a b c x e f g h", "a b c d e e f g h i j", "c d e g h i j k l", "l k j i"):
        matched, span, own = leakage.align(doc.split(), item, [False] * len(item))
        assert matched >= best(doc.split(), item) and span <= len(item) and own == matched


def test_subjects_held_out_accuracy(spark):
    data = "/root/testdata/sf0.01"
    ex = spark.read.parquet(f"{data}/subject_examples.parquet")
    train, held = ex.where("example_id % 5 <> 0"), ex.where("example_id % 5 = 0")
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").unionByName(held.select((F.col("example_id") + 10**9).alias("doc_id"), "text"))
    got = {r.doc_id: r.subject for r in subjects.subjects_of(docs, "doc_id", "text", train, "subject", "text").where("doc_id >= 1000000000").collect()}
    want = {r.example_id + 10**9: r.subject for r in held.collect()}
    assert sum(got.get(k) == v for k, v in want.items()) >= 0.9 * len(want)


def test_subjects_edges(spark):
    ex = spark.createDataFrame([("law", "The court heard the case."), ("law", "The court ruled."), ("sport", "The goalkeeper ran."), ("sport", "A goalkeeper saved.")], "subject string, text string")
    docs = spark.createDataFrame([(1, "A goalkeeper fell."), (2, None), (3, " "), (4, "Nothing known."), (1, "A goalkeeper fell.")], "doc_id long, text string").withColumn("share", F.lit(1))
    got = [(r.doc_id, r.subject) for r in subjects.subjects_of(docs, "doc_id", "text", ex, "subject", "text").collect()]
    assert got == [(1, "sport")]
    assert subjects.subjects_of(docs, "doc_id", "text", ex.limit(0), "subject", "text").count() == 0
    assert subjects.subjects_of(docs.limit(0), "doc_id", "text", ex, "subject", "text").count() == 0


def test_remarks_in_passing_are_learnt(spark):
    """Frames that no list names: each is met with terms of all subjects, in texts about another one."""
    terms = {
        "law": ["courts", "statutes", "plaintiffs", "verdicts", "contracts", "appeals"], "sport": ["goalkeepers", "sprints", "coaches", "relays", "rowing", "tackles"],
        "physics": ["photons", "lattices", "magnets", "plasmas", "lasers", "crystals"], "finance": ["bonds", "dividends", "lenders", "mortgages", "futures", "equities"],
    }
    rng = random.Random(3)
    own = ["we compare {} with {} over many years", "both {} and {} matter for the result", "records of {} support what was said about {}", "without {} it is hard to judge {}"]
    frames = ["connoisseurs of {} would smile at such an analogy here", "not to be mixed up with the namesake known among {}"]

    def body(subject, n):
        return [rng.choice(own).format(*rng.sample(terms[subject], 2)) for _ in range(n)]

    examples = [(s, ". ".join(body(s, 6))) for s in terms for _ in range(8)]
    docs, want = [], set()
    for k in range(600):
        subject = rng.choice(sorted(terms))
        parts = body(subject, 3)
        if k % 3 == 0:
            other = rng.choice([s for s in sorted(terms) if s != subject])
            parts.insert(1, frames[k % 2].format(rng.choice(terms[other])))
        docs.append((k, ". ".join(parts) + "."))
        want.add((k, subject))
    got = subjects.subjects_of(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", spark.createDataFrame(examples, "subject string, text string"), "subject", "text")
    found = {(r.doc_id, r.subject) for r in got.collect()}
    assert len(found & want) >= 0.97 * len(want) and len(found & want) >= 0.95 * len(found)


def test_models_are_distributions():
    counts = {("^", "a"): np.array([4.0, 1.0, 0, 1]), ("a", "b"): np.array([3.0, 0, 0, 1]), ("a", "c"): np.array([1.0, 2.0, 0, 1]), ("^", "c"): np.array([0, 3.0, 0, 2])}
    model = subjects.NgramModels(["x", "y"], counts)
    for before in range(len(model.uni)):
        word = np.arange(len(model.uni))
        p, b = model.log_p(word, np.full(len(word), before))
        assert abs(np.exp(b).sum() - 1) < 0.15 and (np.abs(np.exp(p)[:, :2].sum(axis=0) - 1) < 0.15).all()


def test_batches_that_join_known_works(spark):
    """A batch may show that two known works are one; what was added before then points to the first."""
    a, b = "Vosuhe: Grid Maps for Deep Planning in Sites", "Kiradu: wound healing under mixed light in crowded greenhouse laboratories"
    batches = [[(1, a, ["Ann Lee"], "2024", "10.12345/a1", "")], [(2, b, ["Bo Ek"], "2024", "10.12345/b2", "")], [(10, a, ["Bo Ek"], "2024", "10.12345/b2", "")], [(20, b, ["Bo Ek"], "2024", "", "")]]
    forest = history_dedup.HashForest(spark)
    step = {}
    for rows in batches:
        step |= {r.id: r.first_id for r in forest.add(_batch(spark, rows)).collect()}
    assert step == {1: 1, 2: 2, 10: 1, 20: 1}
    after = {r.id: r.first_id for r in forest.first_ids().collect()}
    whole = {r.id: r.first_id for r in history_dedup.HashForest(spark).add(_batch(spark, sum(batches, []))).collect()}
    assert after == whole == {1: 1, 2: 1, 10: 1, 20: 1}


def test_groups_of_batches():
    assert history_dedup.together([(1, 10), (2, 10), (3, 30), (4, 5)], 20) == [[1, 2], [3], [4]]
    assert history_dedup.together([], 20) == []
    many = [(n, 60_000) for n in range(200)]  # at size neither the groups nor the rereads of the index may grow with the input
    groups = history_dedup.together(many)
    assert len(groups) == 4 and [n for g in groups for n in g] == list(range(200))


def test_forest_bucketed_by_the_measured_prefix():
    rng = random.Random(12)
    titles = ["".join(rng.choice("abcdeilmnorstu") for _ in range(50)) for _ in range(300)]
    titles += [t[:-1] + "x" for t in titles[:100]]
    rows = pa.RecordBatch.from_pydict({"node": list(range(400)), "first": [1] * 400, "least": [1] * 400, "letters": titles, "breaks": [[]] * 400, "cut": [False] * 400})
    depth = next(d for d, share in history_dedup.measured_recall(titles).items() if share >= 0.97)
    assert depth > 2
    batch = next(history_dedup.posting_rows(depth)(iter([rows])))
    trees = [(k, n) for k, n, role in zip(*(batch.column(c).to_pylist() for c in ("k", "node", "role"))) if role == history_dedup.TREE]
    met = {}
    for k, n in trees:
        met.setdefault(k, set()).add(n)
    got = {(a, b) for ns in met.values() for a in ns for b in ns if a < b}
    sig = signatures(titles) >> np.uint64(8 * (8 - depth))
    assert got == {(a, b) for a in range(400) for b in range(a + 1, 400) if (sig[a] == sig[b]).any()} >= {(n, 300 + n) for n in range(100) if (sig[n] == sig[300 + n]).any()}


def test_forest_keeps_its_buckets_once_the_prefix_is_measured(spark):
    # The first batch has only cut titles, so nothing is measured; the later ones still find it.
    cols = "id long, title string, authors array<string>, pub string, doi string, arxiv string"
    made = lambda *rows: featurise(spark.createDataFrame(list(rows), cols), "id", "title", "authors", "pub", F.col("doi"), F.col("arxiv"))
    forest = history_dedup.HashForest(spark)
    forest.add(made((1, "Grid maps for deep planning under winter...", ["Ann Lee"], "2024", "", "")))
    assert (forest.depth, forest.keyed) == (0, 2)
    forest.add(made((2, "Kelp rafts and moorings under winter swell", ["Bo Ek"], "2024", "", "")))
    forest.add(made((3, "Kelp rafts and moorings undr winter swell", ["Bo Ek"], "2024", "", "")))
    assert forest.depth > 2 and forest.keyed == 2
    assert {r.id: r.first_id for r in forest.first_ids().collect()} == {1: 1, 2: 2, 3: 2}


def test_forest_recall_is_measured(spark):
    """Brute force: of damaged titles that the title check accepts, the forest must find the wanted share."""
    titles = [r.letters for r in _features(spark, "seen_ledger", "seen_id").select("letters").distinct().limit(600).collect()]
    shares = history_dedup.measured_recall(titles)
    shape = history_dedup.ForestShape()
    depth = next((d for d, share in shares.items() if share >= shape.recall), shape.shortest)
    assert shares[depth] >= 0.95 and list(shares.values()) == sorted(shares.values())


def _features(spark, table, key):
    df = spark.read.parquet(f"/root/testdata/sf0.01/{table}.parquet")
    return featurise(df, key, "title", "authors", "pub_date", F.col("doi"), F.col("arxiv_id")).where("names_work")


def test_signatures_do_not_depend_on_order_or_company():
    a, b = "gridmapsdeepplanningsites", "deepplanningsitesgridmaps"
    alone, together = signatures([a]), signatures(["x", a, b, "anotheroneofothers"])
    assert (alone[0] == together[1]).all() and (together[1] == together[2]).all() and alone.shape == (1, TREES)


def test_titles_of_many_words_match(spark):
    """Over fourteen words, with words in front, left out, or damaged; found wherever the slip is."""
    base = "kolori survey of seventeen river barges and their engines during nine dry summers with notes about pilots cranes ropes lamps and harbour clerks"
    words = base.split()
    registry = [(k, " ".join(words[:k] + [words[k][::-1][:1] + words[k][1:]] + words[k + 1 :]), ["Bela Ek"], "2020", "") for k in range(2, len(words), 3)]
    assert _matched(spark, [(1, base, ["Bela Ek"], "2020", "")], registry) == {(1, k) for k in range(2, len(words), 3)}


def test_continuations_are_judged_by_all_titles(spark):
    """No list: endings that stand beside a title without them are sequels, endings of many titles that don't are cuts."""
    rng = random.Random(8)
    made = lambda k: f"{''.join(rng.choice('bdfgklmnprst') + rng.choice('aeiou') for _ in range(5))} {rng.choice(['drift', 'frost', 'ledger', 'turbine'])} measured over {k} stations"
    who = lambda k: [f"Ann Holder{k}"]
    papers, registry = [], []
    for k in range(12):
        t = made(k)
        papers.append((k, t, who(k), "2020", ""))
        registry.append((k, f"{t}: Some Field Trials Continued", who(k), "2020", ""))
    for k in range(100, 180):
        papers.append((k, f"{made(k)} along crowded harbours", who(k), "2020", ""))
    cut = papers[-1][1].removesuffix(" crowded harbours")
    registry.append((500, cut, who(179), "2020", ""))
    assert _matched(spark, papers, registry) == {(179, 500)}


def test_components_agree(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5001 + k) for k in range(200)]
    df = spark.createDataFrame(edges, "a long, b long")
    one, rounds = ({r.node: r.root for r in f(df.where("a <> b")).collect()} for f in (components, components_in_rounds))
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    met = {n for a, b in edges if a != b for n in (a, b)}
    assert one == rounds == {n: r for n, r in root.items() if n in met}
    assert {r.node: r.root for r in components(df.where("a <> b"), one_task=1).collect()} == one


def test_letter_counts_refuse_no_equal_titles():
    rng = random.Random(2)
    titles = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(16, 70))) for _ in range(200)]
    for t in titles:
        for slips in range(min(4, len(t) // 14) + 1):
            other = history_dedup._damaged(t, slips, rng)
            if same_title(t, [], [0], "", False, other, [], [0], "", False)[0] == 2:
                assert plausible(pa.array([t]), pa.array([other]), np.array([True]))[0]
        cut = t[: len(t) // 2 + 3]
        if same_title(cut, [], [0], "", True, t, [], [0], "", False)[0]:
            assert plausible(pa.array(['x', cut])[1:], pa.array([t]), np.array([True]))[0]


def test_sketches_refuse_no_plausible_titles(spark):
    """Of 20 000 pairs; a slip, a start with a slip, and anything else."""
    rng = random.Random(4)
    pairs = []
    for n in range(20_000):
        t = "".join(rng.choices("eeeaaiinnttorrsslldcumphgbfkvwyx", k=rng.randrange(12, 90)))
        end = rng.randrange(len(t) // 3, len(t) + 1) if n % 2 else len(t)
        pairs.append((t, history_dedup._damaged(t, rng.randrange(6), rng)[:end] or "x"))
    pairs += [(t * 20, t * 15) for t, _ in pairs[:200]] + [("深い学習のための手法", t) for t, _ in pairs[:20]]
    a, b = (pa.array(x) for x in zip(*(sorted(p, key=len) if n % 3 or abs(len(p[0]) - len(p[1])) > 4 else p for n, p in enumerate(pairs))))
    sa, sb = works.letter_sketches(a), works.letter_sketches(b)
    rows = [(n, int(x | 7 << 32), int(y | 7 << 32), min(1_023, len(s)), min(1_023, len(t))) for n, (x, y, s, t) in enumerate(zip(sa, sb, a.to_pylist(), b.to_pylist()))]
    df = spark.createDataFrame(rows, "n long, a long, b long, na long, nb long")
    may = {r.n for r in df.where(works.may_agree("a", "b", "na", "nb")).collect()}
    told = set(np.flatnonzero(plausible(a, b, np.ones(len(a), bool))).tolist())
    assert told <= may and 4_000 < len(told) and len(may - told) < len(pairs) / 10


def test_titles_that_only_share_a_start_are_no_candidates(spark):
    """Titles of one author with one beginning: their pairs would grow with the square of the input."""
    rng = random.Random(5)
    begin = "deepmultiagentpathfinding"
    whole = [begin + "".join(rng.choices("eaintorsldcumphg", k=30)) for _ in range(60)]
    titles = whole + [begin + "".join(rng.choices("bfkvwyx", k=26)) for _ in range(60)] + [whole[0][:-8], whole[1][:20] + "zz" + whole[1][22:]]
    rows = [(((n + 1) << 10) | len(t), t, [], n == 120, 5, 5) for n, t in enumerate(titles)]
    anchors = spark.createDataFrame(rows, "node long, letters string, breaks array<int>, cut boolean, first int, least int")
    got = {(r.a >> 10, r.b >> 10) for r in entity_match.candidates(anchors).collect()}
    assert {(1, 121), (2, 122)} <= got and len(got) < 200


def test_notices_are_told_by_counts(spark):
    """Sentences of no list: they stand in texts of many authors and say nothing of the title."""
    lines = ["Kindly log on through the portal of your campus.", "Cookies of this vendor were switched off.", "The entry opens once a fee was paid.", "Queries go to the front office on weekdays."]
    t = datetime.fromisoformat("2026-01-01")
    rows = [(k, t, "x", f"Barge lanterns of region {k}", 1, "", "", f"We looked at barge lanterns in region {k}. They burn for {k} hours.", [f"Holder{k}"]) for k in range(40)]
    rows += [(100 + k, t + timedelta(days=1), "x", f"Barge lanterns of region {k}", 1, "", "", " ".join(lines[k % 4 :] + lines[: k % 4]), [f"Holder{k}"]) for k in range(12)]
    papers = spark.createDataFrame(rows, "rec_id long, fetched_at timestamp, source string, title string, citations long, venue string, pdf_url string, abstract string, authors array<string>")
    groups = spark.createDataFrame([(k, r) for k in range(12) for r in (k, 100 + k)], "group_id long, rec_id long")
    got = {(r.group_id, r.rec_id) for r in survivorship.winners(groups, papers).where("field_name = 'abstract'").collect()}
    assert got == {(k, k) for k in range(12)}


def test_forest_with_empty_batches_nulls_and_repeats(spark):
    a = "Vosuhe: Grid Maps for Deep Planning in Sites"
    forest = history_dedup.HashForest(spark)
    empty = _batch(spark, [(1, a, ["Ann Lee"], "2024", "", "")]).limit(0)
    assert forest.add(empty).count() == 0 and forest.depth == 0
    rows = [(1, a, ["Ann Lee"], "2024", "", ""), (2, None, None, None, None, None), (3, "", [], "", "", ""), (4, "x" * 5_000 + " long word title", [None, ""], "n.d.", "10.", "v1"), (1, a, ["Ann Lee"], "2024", "", "")]
    assert {r.id: r.first_id for r in forest.add(_batch(spark, rows)).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    assert forest.depth > 0 and forest.add(empty).count() == 0
    again = forest.add(_batch(spark, [(9, a.upper(), [], "", "", ""), (10, "x" * 5_000 + " long word title", None, None, None, None)]).withColumn("extra", F.lit(1)).drop("extra"))
    assert {r.id: r.first_id for r in again.collect()} == {9: 1, 10: 4}
    assert forest.first_ids().count() == 6


def test_match_sources_with_hot_titles_nulls_and_clashes(spark):
    a = "Kiradu: wound healing under mixed light in crowded greenhouse laboratories"
    papers = [(k, a if k % 3 else a.upper(), ["Bela Ek"] if k % 2 else None, "2020", "") for k in range(300)] + [(900, None, None, None, None), (901, "", [], "", "")]
    registry = [(k, a.replace("healing", "heeling"), ["Bela Ek"], None, None) for k in range(3)] + [(50, None, None, None, None)]
    got = _matched(spark, papers, registry)
    assert got == {(k, b) for k in range(300) for b in range(3)}


def test_small_words_are_told_without_comparing_others(monkeypatch):
    """Invented words, of which titles have one each, were compared letter by letter with every small word."""
    rng = random.Random(15)
    small = sorted(w for w in works.SMALL if len(w) > 3)
    slips = [w[:i] + x + w[j:] for w in small for i in range(len(w) + 1) for j in (i, i + 1, i + 2) for x in ("", "q", w[i : i + 2][::-1])]
    words = [w for w in slips + ["".join(rng.choice("withusnger") for _ in range(rng.randint(4, 7))) for _ in range(2_000)] if 3 < len(w) < 8 and w not in works.SMALL]
    assert [works._small.__wrapped__(w) for w in words] == [any(works._edits(s, w, 1) <= 1 for s in small) for w in words]
    calls, edits = [], works._edits
    monkeypatch.setattr(works, "_edits", lambda *x: calls.append(x) or edits(*x))
    assert not any(works._small.__wrapped__("".join(rng.choice("bdgklmprtvz") + rng.choice("aeio") for _ in range(3))) for _ in range(1_000)) and len(calls) < 100
