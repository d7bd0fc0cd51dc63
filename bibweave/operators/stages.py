"""Stages that ask a language model, as partition-wise functions behind an injected client.

A client is any picklable object with ``chat(system, user, max_tokens) -> str``.
It is called in the tasks, so calls run in parallel with the partitions; a call
that fails fails its record, never the job: every stage returns an ``error``
column beside its result.  Without a client the deterministic stub stands in.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bibweave.functions.markup import clean_generated
from bibweave.functions.quality import heuristic_reading_value
from bibweave.functions.texts import parse_rating, rating_reason
from bibweave.operators.summaries import PARTS

MARK = re.compile("@@[ \\t]*(" + "|".join(PARTS) + ")[ \\t]*@@", re.I)
HISTORY = 6_000


class Client(Protocol):
    def chat(self, system: str, user: str, max_tokens: int) -> str: ...


def resolve_model(override: str | None, listed: list[str], default: str = "local", variable: str = "SUMMARY_MODEL") -> str:
    """Name of the model: what is asked for, what the environment names, the first that the server lists, or a default."""
    return override or os.environ.get(variable) or (listed[0] if listed else default)


def parse_parts(answer: str) -> dict[str, str]:
    """Marked parts of an answer, cleaned; without any marker an error."""
    split = MARK.split(answer or "")
    found = {k.lower(): clean_generated(v) for k, v in zip(split[1::2], split[2::2])}
    if not found:
        raise ValueError("the answer has no marked part")
    return found


def _mapped(rows: DataFrame, inputs: list[str], make: Callable[..., dict], schema: str, keys: list[str]) -> DataFrame:
    """Rows mapped one by one in the tasks; an exception becomes the row's ``error``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    made = make(*(row[c] for c in inputs)) | {"error": ""}
                except Exception as e:
                    made = {"error": f"{type(e).__name__}: {e}"[:300]}
                out.append([row[k] for k in keys] + [made.get(n) for n in names])
            yield pd.DataFrame(out, columns=[*keys, *names])

    kinds = dict(rows.dtypes)
    return rows.select(*dict.fromkeys([*keys, *inputs])).mapInPandas(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), schema]))


def section_drafts(sections: DataFrame, client: Client, issues: Callable[[str], list[str]], max_tokens: int = 900) -> DataFrame:
    """(paper_id, section_no, heading, summary, error): a draft of each section, written once more if it has issues, then reviewed against its text."""

    def make(heading: str, body: str) -> dict:
        draft = clean_generated(client.chat("Summarise the section.", f"## {heading}\n{body}", max_tokens))
        if found := issues(draft):
            draft = clean_generated(client.chat("Summarise the section. Avoid: " + "; ".join(found), f"## {heading}\n{body}", max_tokens))
        return {"summary": clean_generated(client.chat("Correct the summary where its section contradicts it.", f"{draft}\n\n## {heading}\n{body}", max_tokens))}

    return _mapped(sections, ["heading", "body"], make, "summary string, error string", ["paper_id", "section_no", "heading"])


def synthesis(papers: DataFrame, client: Client, issues: Callable[[dict[str, str]], list[str]], revisions: int = 2, max_tokens: int = 1_800) -> DataFrame:
    """(paper_id, the parts, error): one structured summary of a paper's ``evidence``, revised while it has issues; what still has some is an error."""

    def make(evidence: str) -> dict:
        ask = "Write the parts " + ", ".join(f"@@{p.upper()}@@" for p in PARTS)
        parts = parse_parts(client.chat(ask, evidence, max_tokens))
        for _ in range(revisions):
            found = issues(parts)
            if not found:
                break
            parts = parse_parts(client.chat(ask + ". Mend: " + "; ".join(found), evidence, max_tokens))
        if found := issues(parts):
            raise ValueError("; ".join(found))
        return {p: parts.get(p, "") for p in PARTS}

    return _mapped(papers, ["evidence"], make, ", ".join(f"{p} string" for p in PARTS) + ", error string", ["paper_id"])


def final_review(summaries: DataFrame, client: Client, max_tokens: int = 1_800) -> DataFrame:
    """Two more passes over a summary (marked text ``summary``, with its ``evidence``): clarity, then facts."""

    def make(summary: str, evidence: str) -> dict:
        clear = client.chat("Make the summary clear, keep its marks.", summary, max_tokens)
        parts = parse_parts(client.chat("Correct what the evidence contradicts, keep the marks.", f"{clear}\n\n{evidence}", max_tokens))
        return {p: parts.get(p, "") for p in PARTS}

    return _mapped(summaries, ["summary", "evidence"], make, ", ".join(f"{p} string" for p in PARTS) + ", error string", ["paper_id"])


def summarise(papers: DataFrame, client: Client | None, issues: Callable[[dict[str, str]], list[str]] = lambda parts: []) -> DataFrame:
    """Papers (paper_id, basis, evidence, ...) by the path of their basis.

    A failure with a full text stays a failure: it is never replaced by a summary
    of the abstract alone. Without a client every part is the start of the evidence.
    """
    if client is None:
        return papers.select("paper_id", *(F.concat(F.lit(f"[stub] {p}: "), F.substring("evidence", 1, 120)).alias(p) for p in PARTS), F.lit("").alias("error"))
    return synthesis(papers, client, issues)


def reading_values(summaries: DataFrame, client: Client | None) -> DataFrame:
    """(paper_id, value, reason): a rating of 1 to 5; where the model fails, one from citations, basis and length."""
    rows = summaries.withColumn("_h", heuristic_reading_value(F.coalesce("citations", F.lit(0)), F.col("basis"), F.col("summary")))
    if client is None:
        return rows.select("paper_id", F.col("_h").alias("value"), rating_reason(F.lit("")).alias("reason"))
    rated = _mapped(rows, ["summary"], lambda s: {"answer": client.chat("Rate from 1 to 5 and give a reason.", s, 200)}, "answer string, error string", ["paper_id", "_h"])
    failed = (F.col("error") != "") | F.col("answer").isNull()
    return rated.select("paper_id", F.when(failed, F.col("_h")).otherwise(parse_rating(F.col("answer"))).alias("value"), rating_reason(F.when(failed, "").otherwise(F.col("answer"))).alias("reason"))


def with_history(turns: DataFrame, limit: int = HISTORY) -> DataFrame:
    """Turns (page_file, turn, question, answer) with ``history``: the last characters of what was said before in the same dialogue."""
    before = Window.partitionBy("page_file").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    said = F.concat(F.lit("Q: "), F.col("question"), F.lit("\nA: "), F.coalesce("answer", F.lit("")))
    return turns.withColumn("history", F.right(F.array_join(F.collect_list(said).over(before), "\n"), F.lit(limit)))


def answers(turns: DataFrame, contexts: DataFrame, client: Client, max_tokens: int = 1_500) -> DataFrame:
    """(page_file, turn, answer, error) of open questions, from the page's context and the dialogue so far."""
    asked = with_history(turns).where("answer IS NULL").join(contexts.select("page_file", "context"), "page_file")
    make = lambda question, history, context: {"answer": client.chat("Answer from the context.", f"{context}\n\n{history}\n\nQ: {question}", max_tokens)}
    return _mapped(asked.drop("answer"), ["question", "history", "context"], make, "answer string, error string", ["page_file", "turn"])
