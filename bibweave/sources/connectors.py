"""Connectors: raw answers of bibliographic services to records of one schema.

Fetching is kept out: a connector reads stored answers (files, or rows a fetcher
has put there), so a run can be repeated.  ``SOURCES`` is the registry by name;
``gather`` unions them and keeps a row per source and error instead of failing.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from bibweave.functions.identity import normalize_arxiv_id, squeeze, text
from bibweave.functions.texts import restore_inverted
from bibweave.functions.venue import from_comment
from bibweave.schema import PAPER, filled
from bibweave.session import cut_lineage

Connector = Callable[[DataFrame], DataFrame]
SOURCES: dict[str, Connector] = {}


def source(name: str) -> Callable[[Connector], Connector]:
    def register(f: Connector) -> Connector:
        SOURCES[name] = f
        return f

    return register


def available() -> list[str]:
    return sorted(SOURCES)


def search_source(name: str, raw: DataFrame) -> DataFrame:
    """Records of one source; an unknown name is an error."""
    if name not in SOURCES:
        raise KeyError(f"unknown source: {name}")
    return _conform(SOURCES[name](raw), name)


def _conform(df: DataFrame, name: str) -> DataFrame:
    out = df.withColumn("source", F.lit(name))
    for f in PAPER:
        if f.name not in out.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return filled(out.select(*(F.col(f.name).cast(f.dataType) for f in PAPER)))


def build_query(keywords: list[str]) -> str:
    """Quoted phrases joined by OR, as the preprint API takes them."""
    return " OR ".join(f'all:"{k.replace(chr(34), "").strip()}"' for k in keywords if k.strip())


@source("arxiv")
def atom(raw: DataFrame) -> DataFrame:
    """Rows (body) of Atom feeds."""
    entries = raw.select(F.explode(F.split("body", "(?=<entry>)")).alias("e")).where("e LIKE '<entry>%'")
    tag = lambda name: F.regexp_extract("e", rf"(?s)<(?:arxiv:)?{name}\b[^>]*>(.*?)</(?:arxiv:)?{name}>", 1)
    ident = F.regexp_replace(F.regexp_extract(tag("id"), r"/abs/([^<\s]+)", 1), r"v\d+$", "")
    pdf = F.coalesce(F.nullif(F.regexp_extract("e", r'<link[^>]*title="pdf"[^>]*href="([^"]+)"', 1), F.lit("")), F.regexp_extract("e", r'<link[^>]*href="([^"]+)"[^>]*title="pdf"', 1))
    return entries.select(
        _unescape(squeeze(tag("title"))).alias("title"), _unescape(squeeze(tag("summary"))).alias("abstract"),
        F.transform(F.regexp_extract_all("e", F.lit(r"(?s)<name>(.*?)</name>"), F.lit(1)), squeeze).alias("authors"),
        F.substring(tag("published"), 1, 10).alias("published"), from_comment(tag("comment")).alias("venue"), F.trim(tag("id")).alias("url"),
        pdf.alias("pdf_url"), ident.alias("arxiv_id"), F.trim(tag("doi")).alias("doi"),
    )


def _unescape(value: Column) -> Column:
    out = value
    for safe, raw in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(safe), F.lit(raw))
    return out


_HIT = T.ArrayType(T.StructType([T.StructField(n, T.ArrayType(T.StringType()) if n == "authors" else T.StringType()) for n in ("arxiv_id", "title", "authors", "abstract", "submitted", "comment", "pdf_url")]))


class _Results(HTMLParser):
    """Result list of the search page: a record per list item, its parts by the class of their elements."""

    PARTS = {"title": "title", "authors": "authors", "abstract-full": "abstract", "comments": "comment"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.part: str | None = None
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        names = (a.get("class") or "").split()
        if tag == "li" and "arxiv-result" in names:
            self.rows.append({k: [] for k in ("title", "authors", "abstract", "comment", "text")} | {"arxiv_id": "", "pdf_url": ""})
        if not self.rows:
            return
        row = self.rows[-1]
        href = a.get("href") or ""
        if found := re.search(r"/abs/([\w.\-/]+?)(v\d+)?$", href):
            row["arxiv_id"] = row["arxiv_id"] or found[1]
        if "/pdf/" in href:
            row["pdf_url"] = row["pdf_url"] or href
        if self.part is None:
            self.part = next((p for n, p in self.PARTS.items() if n in names), None)
            self.depth = 1 if self.part else 0
            self.opener = tag
        elif tag == self.opener:
            self.depth += 1  # void tags such as <br> don't count
        if self.part == "authors" and tag == "a":
            row["authors"].append("")

    def handle_endtag(self, tag):
        if self.part and tag == self.opener:
            self.depth -= 1
            if not self.depth:
                self.part = None

    def handle_data(self, data):
        if not self.rows:
            return
        row = self.rows[-1]
        row["text"].append(data)
        if self.part == "authors":
            if row["authors"]:
                row["authors"][-1] += data
        elif self.part:
            row[self.part].append(data)


@F.pandas_udf(_HIT)
def _search_hits(pages: pd.Series) -> pd.Series:
    def one(page: str | None) -> list[dict]:
        p = _Results()
        p.feed(page or "")
        flat = lambda x: " ".join("".join(x).split())
        return [
            {
                "arxiv_id": r["arxiv_id"], "title": flat(r["title"]), "authors": [a.strip(" ,\n") for a in r["authors"] if a.strip(" ,\n")],
                "abstract": re.sub(r"\s*△?\s*Less$", "", flat(r["abstract"])), "submitted": (re.search(r"Submitted\s+(\d{1,2} \w+, \d{4})", flat(r["text"])) or [None, ""])[1],
                "comment": re.sub(r"^Comments:\s*", "", flat(r["comment"])), "pdf_url": r["pdf_url"],
            }
            for r in p.rows
        ]

    return pd.Series([one(p) for p in pages])


def search_date(value: Column) -> Column:
    """``6 August, 2026`` as ISO date, '' if it isn't one."""
    return F.coalesce(F.date_format(F.try_to_timestamp(value, F.lit("d MMMM, yyyy")), "yyyy-MM-dd"), F.lit(""))


@source("arxiv-search")
def search_page(raw: DataFrame) -> DataFrame:
    """Rows (seq, body) of search pages, one term each; the first of a repeated id is kept."""
    hits = raw.select("seq", F.posexplode(_search_hits("body")).alias("pos", "h")).select("seq", "pos", "h.*").where("arxiv_id <> ''")
    first = hits.groupBy("arxiv_id").agg(F.min_by(F.struct("title", "authors", "abstract", "submitted", "comment", "pdf_url"), F.struct("seq", "pos")).alias("h"))
    return first.select("arxiv_id", "h.title", "h.authors", "h.abstract", search_date(F.col("h.submitted")).alias("published"), from_comment(F.col("h.comment")).alias("venue"), "h.pdf_url")


_WORK = "results array<struct<title:string,publication_date:string,doi:string,cited_by_count:bigint,abstract_inverted_index:map<string,array<int>>,authorships:array<struct<author:struct<display_name:string>>>,primary_location:struct<landing_page_url:string,pdf_url:string,source:struct<display_name:string>>>>"


@source("openalex")
def openalex(raw: DataFrame) -> DataFrame:
    w = raw.select(F.explode(F.from_json("body", _WORK)["results"]).alias("w")).select("w.*")
    return w.select(
        squeeze(F.col("title")).alias("title"), F.coalesce(restore_inverted(F.col("abstract_inverted_index")), F.lit("")).alias("abstract"),
        F.transform("authorships", lambda a: a["author"]["display_name"]).alias("authors"), F.col("publication_date").alias("published"),
        F.col("primary_location.source.display_name").alias("venue"), F.col("primary_location.landing_page_url").alias("url"), F.col("primary_location.pdf_url").alias("pdf_url"),
        F.regexp_replace(text(F.col("doi")), "^https?://doi.org/", "").alias("doi"), F.col("cited_by_count").alias("citations"),
    )


_S2 = "data array<struct<title:string,abstract:string,year:int,publicationDate:string,venue:string,url:string,citationCount:bigint,authors:array<struct<name:string>>,externalIds:struct<DOI:string,ArXiv:string>,openAccessPdf:struct<url:string>>>"


@source("semanticscholar")
def semanticscholar(raw: DataFrame) -> DataFrame:
    w = raw.select(F.explode(F.from_json("body", _S2)["data"]).alias("w")).select("w.*")
    return w.select(
        squeeze(F.col("title")).alias("title"), "abstract", F.transform("authors", lambda a: a["name"]).alias("authors"), F.coalesce(F.nullif("publicationDate", F.lit("")), F.col("year").cast("string")).alias("published"),
        "venue", "url", F.col("openAccessPdf.url").alias("pdf_url"), F.col("externalIds.ArXiv").alias("arxiv_id"), F.col("externalIds.DOI").alias("doi"), F.col("citationCount").alias("citations"),
    )


@source("dblp")
def dblp(raw: DataFrame) -> DataFrame:
    """Authors may be a list, one object, or a string."""
    hits = raw.select(F.explode(F.from_json(F.get_json_object("body", "$.result.hits.hit"), "array<struct<info:string>>")).alias("h")).select(F.col("h.info").alias("i"))
    get = lambda p: F.get_json_object("i", p)
    author = get("$.authors.author")
    many = F.transform(F.from_json(author, "array<struct<text:string>>"), lambda a: a["text"])
    plain = F.from_json(author, "array<string>")
    one = F.array(F.coalesce(get("$.authors.author.text"), author))
    names = F.when(author.isNull(), F.array().cast("array<string>")).when(~author.startswith("["), one).when(author.rlike(r"^\[\s*\{"), many).otherwise(plain)
    return hits.select(
        F.regexp_replace(squeeze(get("$.title")), r"\.$", "").alias("title"), F.transform(names, lambda n: F.regexp_replace(n, r"\s+\d{4}$", "")).alias("authors"),
        get("$.year").alias("published"), get("$.venue").alias("venue"), get("$.ee").alias("url"), get("$.doi").alias("doi"),
    )


@source("crossref")
def crossref(raw: DataFrame) -> DataFrame:
    """Venue: event, else short container, else container; date parts joined as they are."""
    m = lambda p: F.get_json_object("body", f"$.message{p}")
    some = lambda *c: F.coalesce(*(F.nullif(text(x), F.lit("")) for x in c), F.lit(""))
    parts = F.from_json(F.coalesce(m("['published-print']['date-parts'][0]"), m(".issued['date-parts'][0]")), "array<int>")
    return raw.select(
        squeeze(m(".title[0]")).alias("title"), F.transform(F.from_json(m(".author"), "array<struct<given:string,family:string>>"), lambda a: F.trim(F.concat_ws(" ", a["given"], a["family"]))).alias("authors"),
        F.array_join(parts, "-").alias("published"), some(m(".event.name"), m("['short-container-title'][0]"), m("['container-title'][0]")).alias("venue"),
        m(".URL").alias("url"), F.lower(m(".DOI")).alias("doi"), m("['is-referenced-by-count']").cast("bigint").alias("citations"),
    )


def search(raw: DataFrame, pages: DataFrame | None = None, attempts: int = 3, wait: Callable[[int], None] | None = None) -> DataFrame:
    """The preprint service's records: from its feed, else from its search pages.

    An empty answer counts as a failure, as the service sends one when it is
    overloaded.  After both have failed ``wait`` is called with the number of the
    attempt (a fetcher renews the answers there); the last failure is raised.
    """
    failed: list[str] = []
    for n in range(attempts):
        for name, answer in (("arxiv", raw), ("arxiv-search", pages)):
            if answer is None:
                continue
            try:
                found = cut_lineage(search_source(name, answer))
                if not found.isEmpty():
                    return found
                failed.append(f"{name}: empty")
            except Exception as e:  # the other way may still answer
                failed.append(f"{name}: {e}")
        if wait and n + 1 < attempts:
            wait(n + 1)
    raise RuntimeError("no records: " + "; ".join(failed)[:500])


def record_by_id(records: DataFrame, arxiv_id: str) -> DataFrame:
    """The record of one preprint, whatever notation its id comes in; no row if there is none."""
    wanted = normalize_arxiv_id(F.lit(arxiv_id))
    return records.where((wanted != "") & (normalize_arxiv_id(F.col("arxiv_id")) == wanted)).limit(1)  # an id names one record


def retried(fetch: Callable[[], str], wait: Callable[[float], None], attempts: int = 4, step: float = 5.0) -> str:
    """An answer of a service that may be busy: ``fetch`` raises BusyError for that, and is asked again after longer and longer waits."""
    for n in range(1, attempts + 1):
        try:
            return fetch()
        except BusyError:
            if n == attempts:
                raise
            wait(step * n)
    raise AssertionError("unreachable")


class BusyError(Exception):
    """A service asks to come back later."""


def gather(answers: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(records, log): the union of all sources, and per source (source, n, error) how many records came, or why none did.

    Each source is read and written on its own, so that one with a bad answer fails
    here, and not in whatever action uses the union later.
    """
    parts, log = [], []
    spark = next(iter(answers.values())).sparkSession
    for name, raw in answers.items():
        try:
            part = cut_lineage(search_source(name, raw))
            log.append((name, part.count(), ""))
            parts.append(part)
        except Exception as e:  # one source must not stop the others
            log.append((name, 0, str(e).splitlines()[0][:300]))
    out = parts[0] if parts else spark.createDataFrame([], PAPER)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, spark.createDataFrame(log, "source string, n long, error string")


def limited(records: DataFrame, limit: int, mode: str) -> DataFrame:
    """What a service gives of its hits: the most cited of the important ones, the newest of the recent ones; the limit is the feature."""
    order = [F.col("citations").desc()] if mode == "important" else [F.col("published").desc()]
    return records.orderBy(*order, "title").limit(limit)


def answers_mode(source_name: str, mode: str) -> bool:
    """Whether a source is asked in a mode: the bibliography without citations and the preprint service have no important works of their own."""
    return not (mode == "important" and source_name in ("dblp", "arxiv", "arxiv-search"))


def page_size(limit: int, terms: int, sizes: tuple[int, ...] = (25, 50, 100, 200)) -> int:
    """Hits a page of a search for each of several terms: the smallest page that reaches the limit together."""
    share = -(-min(limit, sizes[-1]) // max(1, terms))
    return next((s for s in sizes if s >= share), sizes[-1])


SUBSCRIPTION = "username string, label string, keywords array<string>, search_queries array<string>, ambiguous_keywords array<string>, ambiguous_context_groups map<string,array<array<string>>>, context_keywords array<string>, k bigint, sources array<string>, manual boolean"


def subscriptions_of(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Subscriptions as a table; a group may be one list of words or several."""

    def groups(value: dict | None) -> dict | None:
        return {k: [[g] if isinstance(g, str) else list(g) for g in v] for k, v in value.items()} if value else None

    def words(value) -> list[str] | None:
        return None if value is None else [" + ".join(v) if isinstance(v, list) else str(v) for v in value]

    names = [c.split()[0] for c in SUBSCRIPTION.split(", ")]
    made = [{**r, "search_queries": words(r.get("search_queries")), "ambiguous_context_groups": groups(r.get("ambiguous_context_groups")), "manual": bool(r.get("manual"))} for r in rows]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in made], SUBSCRIPTION)


def subscriptions_from_yaml(spark: SparkSession, path: str) -> DataFrame:
    try:
        import yaml
    except ImportError as e:  # optional
        raise RuntimeError("reading subscriptions needs a YAML library") from e
    with open(path, encoding="utf-8") as f:
        return subscriptions_of(spark, yaml.safe_load(f).get("subscriptions", []))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of records, with the fixed schema; unknown keys and records without source or title are dropped."""
    return filled(spark.read.schema(PAPER).option("multiLine", True).json(path)).where("source <> '' AND title <> ''")


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """Files that really are PDFs."""
    return spark.read.format("binaryFile").load(path).where(F.substring("content", 1, 4) == F.encode(F.lit("%PDF"), "utf-8")).select("path", "content")


class StoredAnswers(DataSource):
    """``spark.read.format("stored_answers").load(folder)``: one row (seq, body) per stored answer, one partition per file."""

    @classmethod
    def name(cls) -> str:
        return "stored_answers"

    def schema(self) -> str:
        return "seq int, body string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _AnswerReader(self.options["path"])


class _AnswerReader(DataSourceReader):
    """Stored answers of any file system that Arrow knows by its address; a plain path is a shared folder."""

    def __init__(self, path: str):
        self.path = path

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def partitions(self):
        from pyarrow import fs

        system, root = self._open()
        files = sorted(i.path for i in system.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.File)
        return [InputPartition((n, p)) for n, p in enumerate(files)] or [InputPartition(None)]

    def read(self, partition):
        if partition.value is not None:
            n, path = partition.value
            with self._open()[0].open_input_file(path) as f:
                yield n, f.read().decode("utf-8")
