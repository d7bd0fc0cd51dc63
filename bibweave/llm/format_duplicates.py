"""Problem 1: records that differ only in formatting.

Method: canonical records are range-partitioned and sorted externally, and one
scan over adjacent rows compares full keys.  A hot key is spread over several
ranges because the record id is part of the sort key; only runs that touch the
edge of a partition, or that hold more than one order of main title and
subtitle, need a second (tiny) step.  No group is ever collected.

Defined results: null, blank and letterless titles are never duplicates; ties
go to the smallest id; repeated rows of one id count once; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibweave.llm.text import rotation_key
from bibweave.session import cut_lineage

KEY = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("breaks", T.ArrayType(T.IntegerType()))]
)


@F.pandas_udf(KEY)
def _rotation_key(titles: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([rotation_key(t) for t in titles], columns=["key", "start", "breaks"])


SCANNED = "id long, run_first long, copies long, key string, start int, breaks array<int>"
SCANNED_ARROW = pa.schema([("id", pa.int64()), ("run_first", pa.int64()), ("copies", pa.int64()), ("key", pa.string()), ("start", pa.int32()), ("breaks", pa.list_(pa.int32()))])
REMAP = T.ArrayType(T.StructType([T.StructField("run_first", T.LongType()), T.StructField("first", T.LongType())]))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCANNED_ARROW)], schema=SCANNED_ARROW)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over sorted rows: every row gets the first id of its run; runs end in a summary row.

    Only the key of the current group is kept, with one entry per order of its
    parts, so memory doesn't grow with the size of a group.
    """
    key: str | None = None
    orders: dict[int, list] = {}  # start -> [first id, copies, breaks]
    first_key = True
    last_id: int | None = None

    def close(edge: bool) -> list[tuple]:
        needs = edge or first_key or len(orders) > 1
        return [(None, f, n, key if needs else None, s if needs else None, sorted(b) if needs else None) for s, (f, n, b) in orders.items()]

    for batch in batches:
        out: list[tuple] = []
        for rid, k, s, b in zip(*(batch.column(c).to_pylist() for c in ("id", "key", "start", "breaks"))):
            if k != key:
                if key is not None:
                    out += close(False)
                    first_key = False
                key, orders = k, {}
            run = orders.get(s)
            if run is None:
                orders[s] = run = [rid, 0, set()]
            elif rid == last_id:
                continue
            last_id = rid
            run[1] += 1
            run[2].update(b)
            out.append((rid, run[0], None, None, None, None))
        if out:
            yield _batch(out)
    if key is not None:
        yield _batch(close(True))


@F.pandas_udf(REMAP)
def _join_orders(orders: pd.Series) -> pd.Series:
    """Per key: which orders of its parts are one title, and the first id of each set.

    Two orders belong together if one of them has a break where the other starts.
    """
    result = []
    for runs in orders:
        starts: dict[int, set] = {}
        firsts: dict[int, int] = {}
        for r in runs:
            starts.setdefault(r["start"], set()).update(r["breaks"])
            firsts[r["start"]] = min(firsts.get(r["start"], r["run_first"]), r["run_first"])
        root = {s: s for s in starts}

        def find(s: int) -> int:
            while root[s] != s:
                s = root[s]
            return s

        for a in starts:
            for b in starts[a]:
                if b in starts and b != a:
                    root[find(a)] = find(b)
        least: dict[int, int] = {}
        for s in starts:
            least[find(s)] = min(least.get(find(s), firsts[s]), firsts[s])
        result.append([{"run_first": r["run_first"], "first": least[find(r["start"])]} for r in runs])
    return pd.Series(result)


def scan_runs(records: DataFrame, id_col: str, title_col: str, partitions: int | None = None) -> DataFrame:
    """The sorted scan, cut: a row per record (id, run_first), and a summary row per run."""
    keyed = records.select(F.col(id_col).cast("long").alias("id"), _rotation_key(F.col(title_col)).alias("k")).select("id", "k.*").where("key <> ''")
    keyed = cut_lineage(keyed)  # range partitioning reads its input twice, and keys are made once
    n = partitions or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(n, "key", "start", "id").sortWithinPartitions("key", "start", "id")
    return cut_lineage(ordered.mapInArrow(_scan, SCANNED))


def _remap(scanned: DataFrame) -> DataFrame:
    """run_first -> first, for the few runs that go on elsewhere."""
    open_runs = scanned.where("id IS NULL AND key IS NOT NULL")
    by_key = open_runs.groupBy("key").agg(F.collect_list(F.struct("start", "run_first", "breaks")).alias("runs"))  # at most a run per partition and order of parts
    pairs = by_key.where(F.size("runs") > 1).select(F.explode(_join_orders("runs")).alias("p")).select("p.run_first", "p.first")
    return pairs.where("run_first <> first").distinct()


def format_duplicates(records: DataFrame, id_col: str, title_col: str, partitions: int | None = None) -> DataFrame:
    """(first_id, id) for each record but the first of its set."""
    scanned = scan_runs(records, id_col, title_col, partitions)
    members = scanned.where("id IS NOT NULL").select("id", "run_first")
    joined = members.join(_remap(scanned), "run_first", "left")
    return joined.select(F.coalesce("first", "run_first").alias("first_id"), "id").where("id <> first_id")


def collapsed(records: DataFrame, id_col: str, title_col: str, partitions: int | None = None) -> DataFrame:
    """(first_id, copies): one row per set of records that are the same but for formatting."""
    scanned = scan_runs(records, id_col, title_col, partitions)
    runs = scanned.where("id IS NULL").select("run_first", "copies")
    joined = runs.join(_remap(scanned), "run_first", "left")
    return joined.groupBy(F.coalesce("first", "run_first").alias("first_id")).agg(F.sum("copies").alias("copies"))
