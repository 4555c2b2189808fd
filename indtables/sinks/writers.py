"""K1, K2, K4 (K3, the publish, is ``sinks.publish``).

Writers never funnel a table through one task: part files follow the
partitioning of the plan. A total order, when asked for, comes from a range
repartition plus a sort inside each partition (part files then hold
consecutive key ranges), not from a single sorted partition.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _ordered(df: DataFrame, order_by: Sequence[str] | None, total: bool = False) -> DataFrame:
    """``order_by`` sorts rows inside each part file (free when the plan
    already delivers that order, as the long table's window does); with
    ``total`` the parts also hold consecutive key ranges (one range shuffle,
    sampled bounds), giving a total order across files."""
    if not order_by:
        return df
    if total:
        df = df.repartitionByRange(*order_by)
    return df.sortWithinPartitions(*order_by)


def write_bronze(docs: DataFrame, root: str, source: str) -> str:
    """K1: append new documents under ``root/source`` as JSON lines. Part file
    names carry a per-job unique id, so two pulls never overwrite each other."""
    path = f"{root.rstrip('/')}/{source}"
    docs.write.mode("append").json(path)
    return path


def write_parquet(
    df: DataFrame, path: str, order_by: Sequence[str] | None = None, total: bool = False, rows_a_file: int = 0
) -> str:
    """K2/K3: replace the table at ``path`` (any Hadoop URI: local, HDFS,
    object store). Re-running gives the same rows, never a second copy.
    Sorted files give tight row-group min/max statistics, so filters on the
    leading sort keys skip most of each file. ``rows_a_file`` bounds a file's rows
    (0: as the session does)."""
    out = _ordered(df, order_by, total).write.mode("overwrite")
    if rows_a_file:
        out = out.option("maxRecordsPerFile", rows_a_file)
    out.parquet(path)
    return path


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def write_counted(
    df: DataFrame, path: str, order_by: Sequence[str] | None = None, total: bool = False
) -> int:
    """``write_parquet`` that returns the rows written, counted as they stream by:
    the table is not read again for it."""
    out, seen = _counted(_ordered(df, order_by, total))
    out.write.mode("overwrite").parquet(path)
    return seen.get["n"]


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str], order_by: Sequence[str], whole: bool, total: bool = False
) -> int:
    """Replace the partitions (values of ``by``) that ``df`` has rows in, and no
    others; with ``whole`` the table. Returns the rows written.

    The rows of a partition are brought together by a rebalancing exchange, which
    AQE splits where a partition is large and joins where many are small, so there
    are few files and no task per partition value."""
    df = df.repartitionByRange(*order_by) if total else df.hint("rebalance", *by)
    out, seen = _counted(df.sortWithinPartitions(*order_by))
    mode = "static" if whole else "dynamic"
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by).parquet(path)
    return seen.get["n"]


def write_csv(
    df: DataFrame,
    path: str,
    order_by: Sequence[str] | None = None,
    total: bool = True,
    single_file: bool = False,
) -> str:
    """K4: header row, comma, UTF-8; NULL becomes an empty field, booleans
    ``true``/``false``, dates ISO. Replaced in place on rerun. A folder of
    part files; the header is repeated in each part.

    ``single_file``: one part file in the folder (``write_csv_file`` for a file of
    its own). The plan runs spread out as ever; its result then goes to one
    writing task."""
    if single_file:
        df = df.repartition(1)
        total = False
    (
        _ordered(df, order_by, total)
        .write.mode("overwrite")
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return path


def write_csv_file(df: DataFrame, path: str, order_by: Sequence[str] | None = None) -> str:
    """K4 as exactly one file at ``path``, which tools that open a file can be
    given: the rows go to one writing task, into a folder beside ``path``; its one
    part is then moved to ``path`` by a rename that replaces what was there, so a
    reader meets the whole old or the whole new file. A table without rows is its
    header."""
    from indtables.sinks.publish import move_only_part, write_small

    folder = f"{path}.{uuid.uuid4().hex}"
    write_csv(df, folder, order_by, single_file=True)
    if not move_only_part(df.sparkSession, folder, path):
        quoted = ['"' + c.replace('"', '\\"') + '"' if set(c) & set(',"\n') else c for c in df.columns]
        write_small(df.sparkSession, path, ",".join(quoted) + "\n")
    return path


# ------------------------------------------------------------ stored order

LAYOUT = "_layout"


def write_in_buckets(df: DataFrame, path: str, by: Sequence[str], order_by: Sequence[str], buckets: int) -> str:
    """O1: replace the table at ``path`` by one whose files are hash buckets of
    ``by``, each one sorted file. Read back by ``read_in_buckets``, a window or join
    on ``by`` needs no exchange, and one ordered by ``order_by`` no sort. Any reader
    can read it as plain Parquet."""
    from indtables.sinks.publish import write_small

    spark = df.sparkSession
    name = f"indtables_write_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *by)  # the same hash as the buckets': one file each
        .write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, *by).sortBy(*order_by).saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    layout = {"by": list(by), "order_by": list(order_by), "buckets": buckets}
    write_small(spark, f"{path.rstrip('/')}/{LAYOUT}", json.dumps(layout))
    return path


def read_in_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its buckets and their order known to the planner,
    through a table of this session's catalog. That a bucket is one sorted file is
    only used with ``spark.sql.legacy.bucketedTableScan.outputOrdering``, which is
    set where the session has not."""
    from indtables.sinks.publish import read_small
    from indtables.sources.gold import missing_table

    said = read_small(spark, f"{path.rstrip('/')}/{LAYOUT}")
    if said is None:
        raise missing_table(path)
    layout = json.loads(said)
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    if spark.conf.get(key, None) in (None, "false"):
        spark.conf.set(key, "true")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    name = f"indtables_{hashlib.sha256(path.encode()).hexdigest()[:32]}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet "
        f"CLUSTERED BY ({', '.join(layout['by'])}) SORTED BY ({', '.join(layout['order_by'])}) "
        f"INTO {int(layout['buckets'])} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
