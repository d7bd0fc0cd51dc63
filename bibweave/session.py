"""Session helpers: building a local session and cutting lineage safely.

Lineage is only ever cut by tables written into the folder that the cluster names
in ``spark.checkpoint.dir``; that folder is shared, so a lost executor never loses
a cut.  ``localCheckpoint`` is not used anywhere.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = "*", app: str = "bibweave", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the session is given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where it is unset a temporary folder of this machine is used, but only by a
    local session, as in tests: the tasks of a cluster don't share one.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named is None and not sc.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="bibweave-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once, as a table in the shared checkpoint folder, and read it back without its lineage.

    A written table is computed once (an eager checkpoint computes its last
    stage twice), is compressed, and outlives any executor.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    cut = spark.read.schema(df.schema).parquet(path)
    cut.cut_path = path
    return cut


def drop_path(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop_cut(*tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` that nothing reads any more, such as those of past rounds of a loop."""
    for df in tables:
        path = getattr(df, "cut_path", None)
        if path:
            drop_path(df.sparkSession, path)


def _importable(spark: SparkSession) -> None:
    """Python workers that start later find this package where the driver does, wherever the driver was started."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory (a file or a folder of parts)."""
    _importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
