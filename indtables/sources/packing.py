"""S1 at scale: many small pulls packed into few large files.

The extract lands one object per pull, so bronze becomes millions of files of a few
kilobytes, each one listed and opened by every scan. ``pack_bronze`` copies landed
documents, with the name and time of the object they came from, into a pack:

    root/<source>/...                    loose objects, as they land
    root/_packed/<source>/<pack>/        JSON lines {pull_file, pulled_at, document}
    root/_packed/<source>/_current       the packs that count, replaced by one rename

A pack counts from the moment the pointer names it; then its loose objects are
deleted, which the pointer is told at last. The names in the packs are the ledger: a scan reads the packs and those
loose objects that no pack holds, so every pull is read once, before, during and
after packing and whatever a run that died left behind. Lineage (stamp, time, file)
is that of the loose object, so the dedupe picks the same rows.

Objects younger than ``keep_newer_s`` stay loose: an incremental refresh lists loose
objects only, and takes a pull within that time. A root that was packed needs a
full refresh first; a new incremental one says so."""

from __future__ import annotations

import argparse
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indtables.session import path_exists
from indtables.sinks.publish import POINTER, read_small, write_small

PACKED = "_packed"
KEEP_NEWER_S = 7 * 24 * 3600.0
PACK_SCHEMA = "pull_file string, pulled_at timestamp, document string"


def packs_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/{PACKED}/{source}"


def packs(spark: SparkSession, root: str, source: str) -> list[str]:
    """The folders of the packs that count."""
    top = packs_path(root, source)
    return [f"{top}/{p}" for p in _state(spark, top)["packs"]]


def _state(spark: SparkSession, top: str) -> dict:
    said = read_small(spark, f"{top}/{POINTER}")
    return {"packs": [], "deleting": None} if said is None else json.loads(said)


def read_packs(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.schema(PACK_SCHEMA).option("mode", "FAILFAST").json(folders)


def parsed(packed: DataFrame, schema: StructType) -> DataFrame:
    """The documents of packs as a scan of their loose objects gives them, with
    ``pull_file`` and ``pulled_at`` of the object."""
    doc = F.from_json("document", schema, {"mode": "FAILFAST"})
    return packed.select(doc.alias("d"), F.col("pull_file").alias("_name"), F.col("pulled_at").alias("_time")).select(
        "d.*", "_name", "_time"
    )


def _names(spark: SparkSession, pack: str) -> DataFrame:
    return read_packs(spark, [pack]).select("pull_file").distinct()


def _delete_packed(spark: SparkSession, folder: str, top: str) -> None:
    """Delete the loose objects of the pack that the pointer says is not done with.
    Names are streamed to the driver a batch at a time; the deletes are the file
    system's."""
    state = _state(spark, top)
    if state["deleting"] is None:
        return
    jvm = spark.sparkContext._jvm
    loose = jvm.org.apache.hadoop.fs.Path(folder)
    fs = loose.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in _names(spark, f"{top}/{state['deleting']}").toLocalIterator():
        fs.delete(jvm.org.apache.hadoop.fs.Path(loose, r[0]), False)
    write_small(spark, f"{top}/{POINTER}", json.dumps(state | {"deleting": None}))


def pack_bronze(spark: SparkSession, root: str, source: str, keep_newer_s: float = KEEP_NEWER_S) -> int:
    """Pack the loose objects of ``source`` that are older than ``keep_newer_s``;
    returns how many were packed. A run after one that died finishes it first."""
    loose = f"{root.rstrip('/')}/{source}"
    top = packs_path(root, source)
    _delete_packed(spark, loose, top)
    if not path_exists(spark, loose):
        return 0
    oldest = F.timestamp_seconds(F.lit(time.time() - keep_newer_s))
    lines = spark.read.text(loose).select(
        F.col("_metadata.file_name").alias("pull_file"),
        F.col("_metadata.file_modification_time").alias("pulled_at"), F.col("value").alias("document"),
    ).filter((F.col("pulled_at") <= oldest) & (F.trim("document") != ""))
    name = f"p-{uuid.uuid4().hex}"
    lines.hint("rebalance").write.json(f"{top}/{name}")  # files of the session's advisory size
    n = _names(spark, f"{top}/{name}").count()
    if n:
        known = _state(spark, top)["packs"]
        write_small(spark, f"{top}/{POINTER}", json.dumps({"packs": [*known, name], "deleting": name}))
        _delete_packed(spark, loose, top)
    return n


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Pack the small objects of a bronze root.")
    p.add_argument("bronze_root")
    p.add_argument("sources", nargs="+")
    p.add_argument("--keep-newer-days", type=float, default=KEEP_NEWER_S / 86400)
    args = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    for source in args.sources:
        print(source, pack_bronze(spark, args.bronze_root, source, args.keep_newer_days * 86400))


if __name__ == "__main__":
    main()
