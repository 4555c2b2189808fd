"""SimHash near-dedup by pivot distance tables.

Fingerprints: words are runs of anything but ASCII white space, A-Z
lower-cased; shingles of ``shingle`` words joined by a space (the whole
sequence where there are fewer), repeats included; XXH64 with seed 42; a bit is
set if it is set in over half the hashes. No word: zero.

Documents of one fingerprint are one class (summed up before the shuffle), so
exact copies never make pairs. Links between classes:

* Reference fingerprints (pivots): the Hamming distance to a pivot changes by
  at most the distance of two fingerprints. A pivot limited to some bits
  measures those bits alone.
* The free bits are dealt into ``max_bits + 2`` bands. Two fingerprints that
  differ in at most ``max_bits`` bits agree in two bands at least, so they have
  the same distances to all pivots of one pair of bands: one row per pair of
  bands, keyed by its row of the distance table. The pivots of a pair of bands
  are linearly independent and as many as its bits, so equal rows mean equal
  bands.
* A cell of over ``CELL`` classes is dealt again over its free bits, until at
  most 8 bits are free. A cell then holds at most 256 classes whatever the
  data: exact, no cap.
* Within a cell, pairs whose largest difference over the full-width pivots is
  over ``max_bits`` are discarded; the survivors are verified bit by bit.

Links go through connected components.

Defined results: null and empty texts have fingerprint zero, linked like any
other; repeated rows link by their equal fingerprints; a null id never names a
component while its component has another id, else the component is null; an
empty table gives none; other columns are ignored; long texts are whole."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indtables.llm.common import connected_components, cut, id_text, map_batches

SEED = 42
CELL = 256
FULL_PIVOTS = 12


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits as a signed number."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    line = b" ".join(w)
    if len(w) <= shingle:
        parts = [line]
    else:
        ends = list(itertools.accumulate(map(len, w), lambda a, b: a + b + 1))
        starts = [0, *(e + 1 for e in ends)]
        parts = [line[a:b] for a, b in zip(starts, ends[shingle - 1 :])]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), np.uint64, len(parts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) for every row."""
    rows = id_text(docs, id_col, text_col)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("id"), pa.array(fps, pa.int64())], names=["id", "fp"])

    return map_batches(rows, f"id {rows.schema['id'].dataType.simpleString()}, fp long", fn)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _pivots(bits: tuple[int, ...], rng: np.random.Generator) -> list[int]:
    """As many pivots as bits, set only among them. A distance is linear in
    the fingerprint's bits, so independent pivots tell all values apart."""
    while True:
        chosen = rng.integers(0, 2, (len(bits), len(bits)))
        if np.linalg.matrix_rank(1 - 2 * chosen) == len(bits):
            return [_signed(sum(1 << b for b, on in zip(bits, row) if on)) for row in chosen]


def pivot_plan(max_bits: int) -> list[list[tuple[int, int, list[int], int]]]:
    """How cells are dealt, level by level: rows (free bits, keyed bits,
    pivots, bits free after). A few hundred fixed rows."""
    rng = np.random.default_rng(SEED)
    levels, todo = [], [tuple(range(64))]
    while todo:
        rows, later = [], set()
        for free in todo:
            bands = [tuple(int(b) for b in x) for x in np.array_split(free, max_bits + 2)]
            for u, v in itertools.combinations(range(len(bands)), 2):
                keyed = bands[u] + bands[v]
                rest = tuple(b for i, x in enumerate(bands) if i not in (u, v) for b in x)
                as_mask = [_signed(sum(1 << b for b in x)) for x in (free, keyed, rest)]
                rows.append((as_mask[0], as_mask[1], _pivots(keyed, rng), as_mask[2]))
                if len(rest) > 8:
                    later.add(rest)
        levels.append(rows)
        todo = sorted(later)
    return levels


def full_distances(fp: Column) -> Column:
    """Distances to the full-width pivots."""
    rng = np.random.default_rng(SEED + 1)
    pivots = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, FULL_PIVOTS)]
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("tinyint") for p in pivots])


def links(classes: DataFrame, max_bits: int) -> DataFrame:
    """(a, b), a < b: the pairs of distinct fingerprints (column ``fp``) that
    differ in at most ``max_bits`` bits."""
    spark = classes.sparkSession
    levels = pivot_plan(max_bits)
    distances = F.transform(
        "pivots", lambda p: F.bit_count(F.col("fp").bitwiseXOR(p).bitwiseAND(F.col("mask"))).cast("tinyint")
    )
    todo, leaves = classes.select("fp", F.lit(0).cast("long").alias("cell")), None
    for level, rows in enumerate(levels):
        if level == 0:  # all bits are free: the same few rows for every class
            bands = F.array(*[
                F.struct(F.lit(mask).alias("mask"), F.array(*map(F.lit, pivots)).alias("pivots"), F.lit(rest).alias("rest"))
                for _, mask, pivots, rest in rows
            ])
            keyed = todo.select("fp", "cell", F.inline(bands))
        else:
            plan = spark.createDataFrame(rows, "free long, mask long, pivots array<long>, rest long")
            keyed = todo.join(F.broadcast(plan), "free")
        dealt = keyed.select("fp", F.col("rest").alias("free"), F.xxhash64("cell", "mask", distances).alias("cell"))
        dealt = cut(dealt, f"simhash-cells-{level}")
        size = dealt.groupBy("cell").count().filter(F.col("count") > 1)
        last = level + 1 == len(levels)
        small = size if last else size.filter(F.col("count") <= CELL)
        leaf = dealt.join(small.select("cell"), "cell", "left_semi").select("cell", "fp")
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        if last:
            break
        hot = size.filter(F.col("count") > CELL).select("cell")
        todo = cut(dealt.join(hot, "cell", "left_semi"), f"simhash-hot-{level}")
        if todo.isEmpty():
            break
    side = leaves.withColumn("d", full_distances(F.col("fp")))
    a = side.select("cell", F.col("fp").alias("a"), F.col("d").alias("da"))
    b = side.select("cell", F.col("fp").alias("b"), F.col("d").alias("db"))
    apart = F.array_max(F.zip_with("da", "db", lambda x, y: F.abs(x - y)))
    return (
        a.join(b, "cell")
        .filter(F.col("a") < F.col("b"))
        .filter(apart <= max_bits)
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fingerprint hex, component_id) for every row."""
    prints = cut(fingerprints(docs, shingle, id_col, text_col), "simhash-fingerprints")
    classes = cut(prints.groupBy("fp").agg(F.min("id").alias("low")), "simhash-classes")
    parts = connected_components(links(classes, max_bits), "simhash")
    named = classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = cut(named.join(lowest, "component").select("fp", "component_id"), "simhash-named")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select(F.col("id").alias(id_col), hexed.alias("fingerprint"), "component_id")
