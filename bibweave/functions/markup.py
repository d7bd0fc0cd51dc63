"""Markup that needs a scanner: formulas to plain text, small Markdown to HTML, dialogue blocks, facts read back from pages."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibweave.functions.identity import normalize_arxiv_id, text
from bibweave.functions.texts import strip_tags

# Signs of formulas in plain text.
SIGNS = {"leq": "<=", "le": "<=", "geq": ">=", "ge": ">=", "neq": "!=", "times": "x", "cdot": "*", "to": "->", "in": "in", "sum": "sum", "prod": "product", "max": "max", "min": "min", "log": " log "}
FONTS = ("text", "mathrm", "mathbf", "mathit", "mathcal", "operatorname")


def _group(tex: str, at: int) -> tuple[str, int]:
    """The braced group that begins at a place, as plain text, and where it ends."""
    depth, out = 0, at
    while out < len(tex):
        depth += (tex[out] == "{") - (tex[out] == "}")
        out += 1
        if depth == 0:
            break
    return plain_formula(tex[at + 1 : out - 1]), out


def plain_formula(tex: str) -> str:
    """A formula as text: fractions as (a)/(b), fonts dropped, known signs spelled out, other commands by their name."""
    out, i = [], 0
    while i < len(tex):
        ch = tex[i]
        if ch == "\\" and (m := re.match(r"\\([A-Za-z]+)", tex[i:])):
            name, i = m[1], i + m.end()
            if name == "frac" and tex[i : i + 1] == "{":
                above, i = _group(tex, i)
                if tex[i : i + 1] == "{":
                    below, i = _group(tex, i)
                    out.append(f"({above})/({below})")
                else:
                    out.append(above)
            elif name in FONTS:
                if tex[i : i + 1] == "{":
                    inner, i = _group(tex, i)
                    out.append(inner)
            else:
                out.append(SIGNS.get(name, name))
        elif ch == "\\" and tex[i + 1 : i + 2] in "{}":
            i += 2
        elif ch in "{}":
            i += 1
        else:
            out.append(ch)
            i += 1
    return re.sub(r"\s+", " ", "".join(out)).strip()


def without_formulas(body: str | None) -> str:
    """Text with every formula in plain form: between $, $$, \\( \\), \\[ \\]; a sign that is never closed is dropped."""
    body = body or ""
    out, i = [], 0
    ends = {"$$": "$$", "$": "$", "\\(": "\\)", "\\[": "\\]"}
    while i < len(body):
        sign = next((s for s in ends if body.startswith(s, i)), None)
        if sign is None or sign[0] == "$" and i and body[i - 1] == "\\":
            out.append(body[i])
            i += 1
            continue
        end = body.find(ends[sign], i + len(sign))
        while end > 0 and sign[0] == "$" and body[end - 1] == "\\":
            end = body.find(ends[sign], end + 1)
        if end < 0:
            i += len(sign)
            continue
        out.append(plain_formula(body[i + len(sign) : end]))
        i = end + len(sign)
    flat = "".join(out)
    return (plain_formula(flat) if re.search(r"\\[A-Za-z]+", flat) else flat).replace("$", "")


# How summaries in Japanese refer to figures, algorithms and equations by number, and what is put there.
REFERENCES = [(r"(?:図|表)\s*[0-9０-９IVXivx]+\s*(?:に示すように|に示されるように|を参照すると|から分かるように)[、,]?", ""), (r"(?i)(?:algorithm|アルゴリズム)\s*[0-9ivx]+", "提案手順"), (r"(?i)(?:equation|eq\.|式)\s*\(?[0-9ivx]+\)?", "この定式化")]


def clean_generated(body: str | None) -> str:
    """Generated text without formulas and references by number."""
    out = without_formulas((body or "").strip())
    for pattern, put in REFERENCES:
        out = re.sub(pattern, put, out)
    return out


@F.pandas_udf(T.StringType())
def cleaned(bodies: pd.Series) -> pd.Series:
    return pd.Series([clean_generated(b) for b in bodies], dtype=object)


def _inline(line: str) -> str:
    line = re.sub(r"`([^`]+)`", r"<code>\1</code>", html.escape(line))
    return re.sub(r"\*\*([^*]+)\*\*", r"<strong>\1</strong>", line)


def _cells(row: str) -> list[str]:
    return [c.strip() for c in row.strip().strip("|").split("|")]


def _is_row(line: str) -> bool:
    return line.count("|") >= 2 or line.strip().startswith("|")


def _is_rule(line: str) -> bool:
    cells = _cells(line)
    return "|" in line and all(re.fullmatch(r":?-{2,}:?", c) for c in cells)


def markdown_html(body: str | None) -> str:
    """Headings, bullets, tables, code and bold text of an answer as HTML; everything else is escaped."""
    out: list[str] = []
    lines = (body or "").splitlines()
    i = 0
    while i < len(lines):
        line = lines[i]
        if line.strip().startswith("```"):
            end = next((j for j in range(i + 1, len(lines)) if lines[j].strip().startswith("```")), len(lines))
            out.append("<pre><code>" + html.escape("\n".join(lines[i + 1 : end])) + "</code></pre>")
            i = end + 1
        elif _is_row(line) and i + 1 < len(lines) and _is_rule(lines[i + 1]):
            head, i = _cells(line), i + 2
            rows = []
            while i < len(lines) and _is_row(lines[i]):
                rows.append(_cells(lines[i]))
                i += 1
            cell = lambda tag, xs: "".join(f"<{tag}>{_inline(x)}</{tag}>" for x in xs)
            out.append(f"<table><thead><tr>{cell('th', head)}</tr></thead><tbody>" + "".join(f"<tr>{cell('td', r)}</tr>" for r in rows) + "</tbody></table>")
        elif m := re.match(r"(#{1,4})\s+(.*)", line):
            level = min(6, len(m[1]) + 2)
            out.append(f"<h{level}>{_inline(m[2])}</h{level}>")
            i += 1
        elif re.match(r"\s*[-*]\s+", line):
            items = []
            while i < len(lines) and (m := re.match(r"\s*[-*]\s+(.*)", lines[i])):
                items.append(f"<li>{_inline(m[1])}</li>")
                i += 1
            out.append("<ul>" + "".join(items) + "</ul>")
        else:
            if line.strip():
                out.append(f"<p>{_inline(line.strip())}</p>")
            i += 1
    return "\n".join(out)


@F.pandas_udf(T.StringType())
def as_html(bodies: pd.Series) -> pd.Series:
    return pd.Series([markdown_html(b) for b in bodies], dtype=object)


@F.pandas_udf(T.StringType())
def dialogue(questions: pd.Series, answers: pd.Series, asked_at: pd.Series) -> pd.Series:
    """A turn of a dialogue as a block of HTML."""
    return pd.Series([f'<div class="turn"><div class="asked">{html.escape(q or "")}<time>{html.escape(t or "")}</time></div><div class="answer">{markdown_html(a)}</div></div>' for q, a, t in zip(questions, answers, asked_at)], dtype=object)


def page_title(page: Column) -> Column:
    """First h1 of a page, else its title, without tags."""
    get = lambda tag: strip_tags(F.regexp_extract(text(page), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1))
    return F.when(get("h1") != "", get("h1")).otherwise(get("title"))


def page_links(page: Column) -> Column:
    """Struct (pdf_url, doi, arxiv_id) of the first links of a page that name them."""
    links = F.regexp_extract_all(text(page), F.lit(r"""href\s*=\s*["']([^"']+)["']"""), F.lit(1))
    first = lambda pattern: F.coalesce(F.get(F.filter(links, lambda u: u.rlike(pattern)), F.lit(0)), F.lit(""))
    pdf, doi, arxiv = first(r"(?i)\.pdf($|[?#])|/pdf/"), first(r"(?i)doi\.org/10\."), first(r"(?i)arxiv\.org/(abs|pdf)/")
    return F.struct(pdf.alias("pdf_url"), F.lower(F.regexp_extract(doi, r"(10\..+)$", 1)).alias("doi"), normalize_arxiv_id(arxiv).alias("arxiv_id"))


def page_record(page: Column) -> Column:
    """Struct (title, authors, venue, published, body) of a rendered page, so that it can be rendered again."""
    meta = F.regexp_extract(text(page), r'(?s)<div class="meta">(.*?)</div>', 1)
    lines = F.split(meta, "<br>")
    rest = F.split(strip_tags(F.coalesce(F.get(lines, F.lit(1)), F.lit(""))), "・")
    at = lambda n: F.trim(F.coalesce(F.get(rest, F.lit(n)), F.lit("")))
    return F.struct(
        page_title(page).alias("title"), strip_tags(F.coalesce(F.get(lines, F.lit(0)), F.lit(""))).alias("authors"), at(0).alias("venue"), at(1).alias("published"),
        strip_tags(F.regexp_extract(text(page), r"(?s)<main\b[^>]*>(.*?)</main>", 1)).alias("body"), F.regexp_extract_all(text(page), F.lit(r'(?s)(<div class="turn">.*?</div></div>)'), F.lit(1)).alias("followups"),
    )
