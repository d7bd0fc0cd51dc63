"""Run reports and the guard that keeps a detailed one from being overwritten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT = "date string, produced bigint, fields array<struct<slug:string,candidates_total:bigint,fresh_total:bigint,relevant_total:bigint,added:array<struct<id:string>>,skipped:array<struct<id:string>>>>"


def detail(report: DataFrame) -> DataFrame:
    """(date, produced, detail, added ids) of each report."""
    total = F.aggregate("fields", F.lit(0).cast("long"), lambda n, f: n + F.coalesce(f["candidates_total"], F.lit(0)) + F.coalesce(f["fresh_total"], F.lit(0)) + F.coalesce(f["relevant_total"], F.lit(0)) + F.coalesce(F.size(f["skipped"]), F.lit(0)))
    ids = F.flatten(F.transform("fields", lambda f: F.transform(F.coalesce(f["added"], F.array().cast("array<struct<id:string>>")), lambda a: a["id"])))
    return report.select("date", "produced", total.alias("detail"), ids.alias("ids"))


def keep_existing(old: DataFrame, new: DataFrame) -> DataFrame:
    """(date, keep): an earlier report stays if the new one produced nothing, lists no new paper, and says less."""
    o, n = detail(old).alias("o"), detail(new).alias("n")
    j = o.join(n, F.col("o.date") == F.col("n.date"))
    keep = (F.col("n.produced") == 0) & (F.size(F.array_except("n.ids", "o.ids")) == 0) & (F.size(F.array_except("o.ids", "n.ids")) == 0) & (F.col("o.detail") > F.col("n.detail"))
    return j.select(F.col("o.date").alias("date"), keep.alias("keep"))
