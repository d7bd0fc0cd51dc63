"""Sinks: ledger and cache tables, run reports, rendered pages."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibweave.schema import PAPER


def save_ledger(ledger: DataFrame, path: str) -> None:
    """The whole ledger, by field; the commit protocol makes the swap atomic."""
    ledger.write.mode("overwrite").partitionBy("field_slug").parquet(path)


def load_ledger(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The ledger, or an empty one if there is none yet."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def cache_path(root: str, field_slug: str, mode: str) -> str:
    return f"{root}/{safe_path(field_slug)}/{safe_path(mode)}"


def save_cache(ranked: DataFrame, root: str, field_slug: str, mode: str) -> None:
    """Candidates of one field and mode in the declared columns, at most 500 as ranked before; the commit protocol makes the swap atomic."""
    ranked.select("seq", *PAPER.fieldNames()).write.mode("overwrite").parquet(cache_path(root, field_slug, mode))


def load_cache(spark: SparkSession, root: str, field_slug: str, mode: str) -> DataFrame:
    """What an earlier run kept; a cache that isn't there or can't be read is empty, as it can be gathered again."""
    schema = T.StructType([T.StructField("seq", T.LongType()), *PAPER])
    try:
        found = spark.read.schema(schema).parquet(cache_path(root, field_slug, mode))
        found.select("seq").limit(1).count()  # the footers are only read now
        return found
    except Exception:
        return spark.createDataFrame([], schema)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def render(template: str, values: dict[str, str]) -> str:
    """Only ``{{name}}`` is replaced; a missing name becomes ''."""
    return re.sub(r"\{\{(\w+)\}\}", lambda m: str(values.get(m[1], "")), template)


def rendered(rows: DataFrame, template: str, id_col: str) -> DataFrame:
    """(id, html): the template filled with each row's columns."""
    columns = rows.columns

    @F.pandas_udf(T.StringType())
    def page(*series: pd.Series) -> pd.Series:
        return pd.Series([render(template, {c: "" if v is None else v for c, v in zip(columns, values)}) for values in zip(*series)])

    return rows.select(F.col(id_col), page(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)).alias("html"))


def safe_path(path: str) -> str:
    """A relative path inside the site, or an error."""
    clean = path.replace("\\", "/").lstrip("/")
    if not clean or any(p in ("..", "") for p in clean.split("/")):
        raise ValueError(f"unsafe path: {path}")
    return clean
