"""The ledger as state of a stream: batches are checked against it, and only new works come out and go in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.functions.identity import paper_aliases


def new_works(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of a batch whose aliases are new to their field; of several with one alias the first in order of arrival."""
    named = batch.select("seq", "field_slug", F.explode(paper_aliases(F.col("title"), F.col("doi"), F.col("arxiv_id"))).alias("alias"))
    taken = named.join(known.select("field_slug", "alias").distinct(), ["field_slug", "alias"], "left_semi").select("seq").distinct()
    fresh = named.join(taken, "seq", "left_anti")
    first = fresh.groupBy("field_slug", "alias").agg(F.min("seq").alias("first"))
    later = fresh.join(first, ["field_slug", "alias"]).where("seq <> first").select("seq").distinct()
    return batch.join(taken.union(later), "seq", "left_anti")  # rows without any alias are new


def run_stream(spark: SparkSession, source_dir: str, schema, state_dir: str, out_dir: str, checkpoint: str, files_per_batch: int = 1):
    """Process all files that are there, batch by batch; the state is a table of aliases that grows by new works.

    ``foreachBatch`` may repeat a batch after a failure: both writes go to a
    folder of the batch's own number and overwrite it, so a repeat changes nothing.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)

    def step(batch: DataFrame, number: int) -> None:
        state = spark.createDataFrame([], "field_slug string, alias string")
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state_dir)
        if root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
            state = spark.read.schema("field_slug string, alias string, batch int").parquet(state_dir).where(F.col("batch") < number)  # prunes the folder of a repeated batch
        fresh = new_works(batch, state)
        fresh.write.mode("overwrite").parquet(f"{out_dir}/batch={number}")
        aliases = spark.read.schema(batch.schema).parquet(f"{out_dir}/batch={number}").select("field_slug", F.explode(paper_aliases(F.col("title"), F.col("doi"), F.col("arxiv_id"))).alias("alias"))
        aliases.distinct().write.mode("overwrite").parquet(f"{state_dir}/batch={number}")

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
