"""Shared helpers: table reads, written cuts of the lineage, batch maps and
connected components.

Every operator selects just the columns it names, so other columns of its
input, whatever they are called, neither clash nor travel."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indtables.session import ensure_checkpoint_dir


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application;
    they then need no path of their own to it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    path = pathlib.Path(tempfile.mkdtemp(prefix=f"{package.name}-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in package.rglob("*.py"):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it
    back: a lost executor then recomputes from the written table."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, schema: str | StructType, fn: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 512) -> DataFrame:
    """``fn`` over Arrow batches of at most ``rows`` rows, so the memory of a
    task follows the batch and not the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield fn(batch.slice(start, rows))
        pa.default_memory_pool().release_unused()  # a worker lives on after its task

    return df.mapInArrow(run, schema)


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def with_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, row): ``row`` holds the other columns, so names that an
    operator adds cannot clash with them."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    ship(docs.sparkSession)
    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.struct(*others).alias("row")
    )


def without_row(df: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """The columns of ``docs`` again."""
    return df.select(*[
        F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns
    ])


def connected_components(edges: DataFrame, what: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``, component being
    the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each
    node links its larger neighbours, then its smaller ones and itself, to the
    smallest neighbour. Rows never exceed the edges, a hub's neighbours are
    handled by a minimum (combined before the shuffle) and a join, never
    collected. Each round is a written table; only its row count and checksum
    come to the driver, to see that a round changed nothing."""
    e = cut(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{what}-edges",
    )
    last = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = large.filter(F.col("a") != F.col("b")).distinct()
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        small = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b"))
        e = cut(
            small.unionByName(low.select("a", F.col("m").alias("b")))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct(),
            f"{what}-round",
        )
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == last:
            # at the fixed point every node points straight at its minimum
            roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        last = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
