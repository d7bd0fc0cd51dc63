"""Record schemas, and scans that make missing values '' / 0 / [] as the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibweave.session import read_table

S, L, A = T.StringType(), T.LongType(), T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


PAPER = _struct(source=S, title=S, abstract=S, authors=A, published=S, venue=S, url=S, pdf_url=S, arxiv_id=S, doi=S, citations=L, matched_keywords=A)
SECTION = _struct(pos=T.IntegerType(), heading=S, body=S)
PDF_LINE = _struct(paper_id=S, pos=T.IntegerType(), size=T.DoubleType(), bold=T.BooleanType(), txt=S)


def filled(df: DataFrame, schema: T.StructType = PAPER) -> DataFrame:
    """Missing strings become '', numbers 0 and lists [], so ranking and predicates never meet a null."""

    def fill(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.ArrayType):
            return F.coalesce(F.col(f.name), F.array().cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, T.StringType):
            return F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
        return F.coalesce(F.col(f.name).cast(f.dataType), F.lit(0).cast(f.dataType)).alias(f.name)

    named = {f.name: f for f in schema}
    return df.select(*(fill(named[c]) if c in named else F.col(c) for c in df.columns))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate records with their order of arrival (``seq``) and field."""
    return filled(read_table(spark, sf_dir, "papers")).withColumn("seq", F.col("rec_id")).withColumn("field_slug", F.coalesce("field_slug", F.lit("")))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of accepted works; texts filled, order of entry in ``seen_id``."""
    df = read_table(spark, sf_dir, "seen_ledger")
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in df.columns))


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "subscriptions")
