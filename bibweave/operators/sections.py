"""From pages and PDF lines to sections of text."""

from __future__ import annotations

import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibweave.functions.quality import HEADING_MAX, MOST_SECTIONS, SECTION_MAX, clean_sections, denied, looks_like_abstract_page, plausible, too_shallow
from bibweave.functions.texts import chunks, strip_references

SECTIONS = T.ArrayType(T.StructType([T.StructField("heading", T.StringType()), T.StructField("body", T.StringType())]))
PREAMBLE = "(前文)"


class _Sections(HTMLParser):
    """Text under each h1/h2; scripts, styles, formulas and tables are left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, str]] = []
        self.heading, self.words, self.hidden, self.title = PREAMBLE, [], 0, None

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("script", "style", "noscript", "math", "table"):
            self.hidden += 1
        elif tag in ("h1", "h2") and not self.hidden:
            self.close_section()
            self.title = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "noscript", "math", "table"):
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("h1", "h2") and self.title is not None:
            self.heading, self.title = " ".join("".join(self.title).split()), None

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        (self.words if self.title is None else self.title).append(data)

    def close_section(self) -> None:
        body = " ".join("".join(self.words).split())
        if body:
            self.rows.append((self.heading, body))
        self.heading, self.words = "", []


def html_to_sections(page: str | None) -> list[tuple[str, str]]:
    parser = _Sections()
    parser.feed(page or "")
    parser.close()
    parser.close_section()
    return parser.rows


@F.pandas_udf(SECTIONS)
def sections_of_html(pages: pd.Series) -> pd.Series:
    return pd.Series([[{"heading": h, "body": b} for h, b in html_to_sections(p)] for p in pages])


@F.pandas_udf(T.StringType())
def visible_text(pages: pd.Series) -> pd.Series:
    """All text of a page but that of scripts, styles and noscript parts."""

    class Text(HTMLParser):
        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.hidden, self.out = 0, []

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("script", "style", "noscript")

        def handle_endtag(self, tag):
            if tag in ("script", "style", "noscript"):
                self.hidden = max(0, self.hidden - 1)

        def handle_data(self, data):
            if not self.hidden:
                self.out.append(data)

    def one(page: str | None) -> str:
        p = Text()
        p.feed(page or "")
        p.close()
        return re.sub(r"\s+", " ", " ".join(p.out)).strip()

    return pd.Series([one(p) for p in pages])


def sections_of_text(body: Column) -> Column:
    """Fixed-size pieces labelled by their number."""
    parts = chunks(body)
    return F.transform(parts, lambda p, i: F.struct(F.format_string("本文 (%d/%d)", i + 1, F.size(parts)).alias("heading"), p.alias("body")))


# Words that headings of sections have.
SECTION_WORDS = [
    "introduction", "related work", "background", "preliminar", "problem", "method", "approach", "algorithm", "framework", "model", "architecture",
    "experiment", "evaluation", "setup", "result", "analysis", "ablation", "discussion", "limitation", "conclusion", "future work",
]
CAPTION = r"^(figure|fig\.?|table|tab\.?|algorithm|equation|eq\.?)\s*\d"
HEADING_MOST, HEADING_WORDS, LARGER, CHAPTER = 90, 12, 0.6, 1.5
ABSTRACT_LEAST, BODY_LEAST = 200, 40


def is_heading(txt: Column, size: Column, bold: Column, body_size: Column) -> Column:
    """A short line, larger than the body or bold, that is numbered, has a section's usual word, or is larger and begins with a capital; no caption."""
    low = F.lower(txt)
    short = (F.length(txt) >= 3) & (F.length(txt) <= HEADING_MOST) & (F.size(F.split(F.trim(txt), r"\s+")) <= HEADING_WORDS)
    larger = size >= body_size + LARGER
    numbered = txt.rlike(r"^\d+(\.\d+)*\.?\s+\S")
    known = F.lit(False)
    for w in SECTION_WORDS:
        known = known | low.contains(w)
    capital = (txt == F.upper(txt)) | txt.rlike(r"^\p{Lu}")
    return short & (larger | (bold & (size >= body_size - 0.1))) & ~low.rlike(CAPTION) & (numbered | known | (capital & larger))


def is_opening(heading: Column) -> Column:
    """The heading at which the paper's own text begins."""
    low = F.lower(heading)
    return low.contains("abstract") | low.contains("introduction") | F.trim(heading).rlike(r"^1\b")


def body_sizes(lines: DataFrame) -> DataFrame:
    """Size that most characters of a paper have; the first to appear wins a tie."""
    by_size = lines.groupBy("paper_id", "size").agg(F.sum(F.length("txt")).alias("chars"), F.min("pos").alias("at"))
    return by_size.groupBy("paper_id").agg(F.max_by("size", F.struct("chars", -F.col("at"))).alias("body_size"))


def _squeezed(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, "[ \\t]{2,}", " "))


def sections_of_lines(lines: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """(paper_id, section_no, heading, body): the chapters of papers from their lines in reading order.

    Where three or more headings are much larger than the body only these part
    chapters.  What stands before the opening heading is dropped, or is the abstract
    if it is long enough and there is none; the first denied heading ends the paper;
    the title's own block and empty sections are left out.  A paper without an
    opening heading has no section.  Gap and island: headings start islands, and a
    running count numbers them; a paper's lines are sorted in one task, as they are
    one file's.
    """
    order = Window.partitionBy("paper_id").orderBy("pos")
    whole = Window.partitionBy("paper_id")
    sized = lines.join(body_sizes(lines), "paper_id")
    marked = sized.withColumn("cand", is_heading(F.col("txt"), F.col("size"), F.col("bold"), F.col("body_size")))
    big = F.col("size") >= F.col("body_size") + CHAPTER
    marked = marked.withColumn("use_big", F.count_if(F.col("cand") & big).over(whole) >= 3)
    marked = marked.withColumn("head", F.col("cand") & (~F.col("use_big") | big)).withColumn("island", F.count_if("head").over(order)).where("island > 0")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("head"), F.struct("pos", "txt")))), lambda x: x["txt"]), " ")
    raw = marked.groupBy("paper_id", "island").agg(F.min(F.when(F.col("head"), F.col("txt"))).alias("heading"), body.alias("body"))  # an island is the text of one section
    first = F.min(F.when(is_opening(F.col("heading")), F.col("island"))).over(whole)
    denied_at = F.min(F.when(denied(F.col("heading")) & (F.col("island") >= F.col("first")), F.col("island"))).over(whole)
    placed = raw.withColumn("first", first).where("first IS NOT NULL").withColumn("last", denied_at)
    front = placed.where("island < first").groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("body") != "", F.struct("island", "body")))), lambda x: x["body"]), " ").alias("body"))
    opening = placed.where("island = first").select("paper_id", "heading", "last", "first")
    abstract = front.join(opening, "paper_id").where((F.length(_squeezed(F.col("body"))) >= ABSTRACT_LEAST) & ~F.lower("heading").contains("abstract"))
    made = placed.where("island >= first AND (last IS NULL OR island < last)").select("paper_id", "island", "heading", "body").unionByName(abstract.select("paper_id", (F.col("first") - 1).alias("island"), F.lit("Abstract").alias("heading"), "body"))
    if titles is not None:
        flat = lambda c: F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))
        named = made.join(titles.select("paper_id", flat(F.coalesce("title", F.lit(""))).alias("_t")), "paper_id", "left").withColumn("_h", flat(F.col("heading")))
        own = (F.coalesce("_t", F.lit("")) != "") & (F.length("_h") >= 8) & (F.col("_t").startswith(F.col("_h")) | F.col("_h").startswith(F.col("_t")))
        made = named.where(~F.coalesce(own, F.lit(False))).drop("_t", "_h")
    kept = made.withColumn("body", _squeezed(F.col("body"))).where(F.length("body") >= BODY_LEAST)
    numbered = kept.withColumn("section_no", F.row_number().over(Window.partitionBy("paper_id").orderBy("island"))).where(F.col("section_no") <= MOST_SECTIONS)
    return numbered.select("paper_id", "section_no", F.substring("heading", 1, HEADING_MAX).alias("heading"), F.substring("body", 1, SECTION_MAX).alias("body"))


def pdf_sections(lines: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """Sections by headings, or pieces of fixed size for papers with fewer than two."""
    by_heading = sections_of_lines(lines, titles)
    enough = by_heading.groupBy("paper_id").count().where("count >= 2").select("paper_id")
    flat = lines.join(enough, "paper_id", "left_anti").groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "txt"))), lambda x: x["txt"]), "\n").alias("body"))
    pieces = flat.select("paper_id", F.posexplode(sections_of_text(F.col("body"))).alias("n", "s")).select("paper_id", (F.col("n") + 1).alias("section_no"), "s.heading", "s.body")
    return by_heading.join(enough, "paper_id", "left_semi").unionByName(pieces)


def pdf_lines(files: DataFrame, extract) -> DataFrame:
    """(paper_id, pos, size, bold, txt) of PDF files; ``extract`` maps a file's bytes to (size, bold, text) lines, [] where it can't.

    The extractor is injected: no PDF library is needed here. Texts are normalised (NFKC), blank lines left out.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                lines = [(round(float(size), 1), bool(bold), unicodedata.normalize("NFKC", t).strip()) for size, bold, t in extract(bytes(content))]
                rows += [(path, n, *line) for n, line in enumerate((x for x in lines if x[2]), 1)]
            yield pd.DataFrame(rows, columns=["paper_id", "pos", "size", "bold", "txt"])

    return files.select("path", "content").mapInPandas(run, "paper_id string, pos int, size double, bold boolean, txt string")


def pdf_text(lines: DataFrame) -> DataFrame:
    """(paper_id, body): the flat text of a PDF's lines, without its references."""
    flat = lines.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "txt"))), lambda x: x["txt"]), "\n").alias("body"))
    return flat.select("paper_id", strip_references(F.col("body")).alias("body"))


# Order in which full texts are tried, and what a summary then says it is based on.
CHAIN = ["fulltext(arxiv)", "fulltext(ar5iv)", "fulltext(arxiv-pdf)", "fulltext(oa-pdf)"]
FLAT_CHAIN = ["fulltext(arxiv-text)", "fulltext(ar5iv-text)", "fulltext(arxiv-pdf)", "fulltext(oa-pdf)"]


def arxiv_addresses(arxiv_id: Column) -> Column:
    """Addresses at which a preprint's PDF may be, in the order they are tried."""
    return F.array(*(F.concat(F.lit(pre), arxiv_id, F.lit(post)) for pre, post in (("https://arxiv.org/pdf/", ".pdf"), ("https://arxiv.org/pdf/", ""), ("https://export.arxiv.org/pdf/", ".pdf"), ("https://export.arxiv.org/pdf/", ""))))


def fulltext_chain(papers: DataFrame, attempts: DataFrame, chain: list[str] = CHAIN) -> DataFrame:
    """(paper_id, basis, sections): the first attempt of the chain that is a plausible full text of its paper, else the abstract with no section.

    ``attempts`` (paper_id, basis, sections) may have any number of tries a basis.
    """
    order = F.create_map(*[x for n, b in enumerate(chain) for x in (F.lit(b), F.lit(n))])
    tried = attempts.withColumn("prio", order[F.col("basis")]).where("prio IS NOT NULL").join(papers.select("paper_id", "title"), "paper_id")
    best = first_plausible(tried)
    none = F.array().cast(SECTIONS)
    return papers.select("paper_id").join(best, "paper_id", "left").select("paper_id", F.coalesce("basis", F.lit("abstract")).alias("basis"), F.coalesce("sections", none).alias("sections"))


def question_chain(papers: DataFrame, attempts: DataFrame) -> DataFrame:
    """The chain for questions: sections first, flat texts in pieces where there are none."""
    by_section = fulltext_chain(papers, attempts)
    rest = by_section.where("basis = 'abstract'").select("paper_id").join(papers, "paper_id")
    return by_section.where("basis <> 'abstract'").unionByName(fulltext_chain(rest, attempts, FLAT_CHAIN))


def first_plausible(attempts: DataFrame) -> DataFrame:
    """(paper_id, basis, sections): of several attempts at a full text the first that isn't shallow, another page or another paper."""
    ready = attempts.withColumn("sections", clean_sections(F.col("sections")))
    body = F.array_join(F.transform("sections", lambda s: F.concat_ws(" ", s["heading"], s["body"])), " ")
    good = ready.where(~looks_like_abstract_page(F.col("sections")) & ~too_shallow(F.col("sections")) & plausible(body, F.col("title")))
    return good.groupBy("paper_id").agg(F.min_by(F.struct("basis", "sections"), "prio").alias("b")).select("paper_id", "b.*")
