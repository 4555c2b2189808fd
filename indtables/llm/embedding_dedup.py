"""Embedding near-dedup by collision-counting projections.

Vectors that are equal to the bit are one class (summed up before the
shuffle). Between classes:

* A collision of two vectors in a one-dimensional projection is that their
  values lie within a window centred on one of them. One projection's window
  around a vector holds a constant share of all vectors, so pairs are only
  counted where they can be near: ``k`` signs of projections make a cell, each
  vector is in one cell of each of ``tables`` tables, and Spark sorts the cells.
  k grows with the logarithm of the number of classes, which keeps cells small
  at any size; the number of tables follows from k and ``recall``, the chance
  that a pair at the threshold shares a cell.
* Within a cell, window collisions over ``PROJECTIONS`` projections are
  counted for every pair. The count that a pair must reach is calibrated: the
  largest that a pair at the threshold reaches with probability
  ``COUNT_RECALL`` (binomial).
* Pairs that pass are verified by cosine in double precision.

A linked pair is reported by the first table where its two vectors meet, so it
is counted once and no list of pairs is kept: a cell yields its vectors' link
counts and a spanning forest of its links. The signs come from whole numbers,
whose sums are exact, so every task computes the same. Cells of over ``BLOCK``
vectors are compared in blocks, each pair of blocks a group of its own.

Links need cosine >= ``min_cosine``; vectors that are null, zero, or hold null
or non-finite components link with nothing, also not with equal ones. Vectors of different length never
link. Other defined results: repeated rows are vectors like any other; a
component whose ids are all null has a null id; an empty table gives no rows;
other columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indtables.llm.common import connected_components, cut, ship

SEED = 42
PROJECTIONS = 64
COUNT_RECALL = 1 - 1e-6
RECALL = 1 - 1e-6
BLOCK = 1024
MAX_TABLES = 512


def _whole(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors as whole numbers, so that sums of products are exact."""
    return np.rint(vectors * (1 << 20))


def sign_projections(dims: int, n: int) -> np.ndarray:
    rng = np.random.default_rng(SEED + dims)
    return np.rint(rng.standard_normal((dims, n)) * 256)


def table_keys(unit: np.ndarray, k: int, tables: int, chosen: range | None = None) -> np.ndarray:
    """(vectors x tables) cell keys."""
    signs = _whole(unit) @ sign_projections(unit.shape[1], k * tables) >= 0
    return signs.reshape(len(unit), tables, k) @ (1 << np.arange(k, dtype=np.int64))


def count_threshold(min_cosine: float) -> tuple[float, int]:
    """(window, count). The difference of two unit vectors at the threshold is
    normal with variance 2 - 2 cos along a random direction."""
    window = 2 * math.sqrt(2 - 2 * min_cosine)
    p = math.erf(2 / math.sqrt(2))
    chance, n = 0.0, PROJECTIONS
    for count in range(n, -1, -1):
        chance += math.comb(n, count) * p**count * (1 - p) ** (n - count)
        if chance >= COUNT_RECALL:
            return window, count
    return window, 0


def sizes(n_classes: int, min_cosine: float, recall: float) -> tuple[int, int]:
    """(k, tables)."""
    same = 1 - math.acos(min_cosine) / math.pi
    k = min(62, max(2, round(math.log2(max(n_classes, 2)))))
    while (tables := math.ceil(math.log(1 - recall) / math.log1p(-(same**k)))) > MAX_TABLES:
        k -= 1
    return k, max(1, tables)


def vectors(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec binary, norm); norm is the largest magnitude, by which a vector is
    divided before its length is taken, so that no finite component overflows or
    vanishes; null where the vector links with nothing."""
    ship(embeddings.sparkSession)
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    wide = rows.schema["vec"].dataType.elementType.simpleString() != "float"

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, norms = [], []
            for v in batch.column("vec"):
                v = v.values
                ok = v is not None and len(v) and not v.null_count
                x = np.asarray(v.to_numpy(zero_copy_only=False), np.float64 if wide else np.float32) if ok else None
                norm = float(np.abs(x).max()) if ok else 0.0
                ok = ok and math.isfinite(norm) and norm > 0
                raw.append((x + 0).tobytes() if ok else None)  # + 0: no negative zeros
                norms.append(norm if ok else None)
            yield pa.record_batch([batch.column("id"), pa.array(raw, pa.binary()), pa.array(norms, pa.float64())],
                                  names=["id", "vec", "norm"])

    return rows.mapInArrow(fn, f"id {rows.schema['id'].dataType.simpleString()}, vec binary, norm double"), wide


def _unit(batch: pa.RecordBatch, wide: bool) -> np.ndarray:
    raw = b"".join(batch.column("vec").to_pylist())
    x = np.frombuffer(raw, np.float64 if wide else np.float32).astype(np.float64).reshape(batch.num_rows, -1)
    x /= batch.column("norm").to_numpy()[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[int]:
    """Places of the pairs that make a spanning forest."""
    parent, kept = list(range(n)), []
    for at, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[y] = x
            kept.append(at)
    return kept


def _compare(rows: pa.RecordBatch, k: int, tables: int, min_cosine: float, wide: bool) -> pa.RecordBatch:
    """Link counts and forest edges of whole groups, as rows (a, b, n): links
    of a with b null, or an edge with n null."""
    window, enough = count_threshold(min_cosine)
    unit = _unit(rows, wide)
    group, table = rows.column("grp").to_numpy(), rows.column("tab").to_numpy()
    part, across = rows.column("part").to_numpy(), rows.column("across").to_numpy(zero_copy_only=False)
    node, members = rows.column("node").to_numpy(), rows.column("members").to_numpy()
    rng = np.random.default_rng(SEED + 1 + unit.shape[1])
    values = unit @ rng.standard_normal((unit.shape[1], PROJECTIONS))
    found = []
    for step in range(1, len(group)):
        i = np.flatnonzero(group[:-step] == group[step:])
        if not len(i):
            break
        j = i + step
        i, j = (x[~across[i] | (part[i] != part[j])] for x in (i, j))
        near = (np.abs(values[i] - values[j]) <= window).sum(axis=1) >= enough
        i, j = i[near], j[near]
        linked = np.einsum("ij,ij->i", unit[i], unit[j]) >= min_cosine
        found.append((i[linked], j[linked]))
    i, j = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    if len(i):
        used, at = np.unique(np.concatenate((i, j)), return_inverse=True)
        keys = table_keys(unit[used], k, tables)
        ki, kj = at[: len(i)], at[len(i) :]
        first = np.concatenate([
            (keys[ki[s : s + 65536]] == keys[kj[s : s + 65536]]).argmax(axis=1) for s in range(0, len(i), 65536)
        ])
        i, j = i[first == table[i]], j[first == table[i]]
    n = np.bincount(i, members[j], len(node)) + np.bincount(j, members[i], len(node)) if len(i) else np.zeros(len(node))
    some, kept = np.flatnonzero(n), _forest(i, j, len(node))
    a = np.concatenate((node[some], node[i[kept]]))
    b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[j[kept]], pa.int64())])
    counts = pa.concat_arrays([pa.array(n[some].astype(np.int64)), pa.nulls(len(kept), pa.int64())])
    return pa.record_batch([pa.array(a, pa.int64()), b, counts], names=["a", "b", "n"])


def links(classes: DataFrame, n_classes: int, min_cosine: float, recall: float, wide: bool) -> DataFrame:
    """(a, b, n) over classes(node, vec, norm, members), see ``_compare``."""
    k, tables = sizes(n_classes, min_cosine, recall)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                sizes_ = np.array([len(v) for v in part.column("vec").to_pylist()])
                for size in np.unique(sizes_):
                    some = part.filter(pa.array(sizes_ == size))
                    keys = table_keys(_unit(some, wide), k, tables)
                    flat = pa.array(keys.reshape(-1))
                    keys = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, tables), pa.int32()), flat)
                    yield pa.record_batch([some.column("node"), keys, pa.array([int(size)] * some.num_rows, pa.int32())],
                                          names=["node", "keys", "size"])

    light = classes.mapInArrow(key, "node long, keys array<long>, size int").select(
        "node", "size", F.posexplode("keys").alias("tab", "key")
    )
    light = cut(light, "embedding-cells")
    cell = ["tab", "key", "size"]
    full = light.groupBy(*cell).agg(F.count("*").alias("n")).filter("n > 1")
    salt = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        light.join(full, cell)
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("part", salt).withColumn("other", other)
        .withColumn("across", F.col("part") != F.col("other"))
        .withColumn("grp", F.xxhash64(*cell, F.least("part", "other"), F.greatest("part", "other")))
        .select("node", "tab", "grp", "part", "across", "size")
    )
    # a row of block s stands once in the group (s, s) and once in each (s, t)
    dealt = dealt.join(classes, "node")
    rows_per_task = 20_000
    total = light.join(full, cell, "left_semi").count()
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / rows_per_task))
    dealt = dealt.repartition(parts, "grp").sortWithinPartitions("size", "grp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held is not None:
                batch = pa.concat_batches([held, batch])
            group, size = batch.column("grp").to_numpy(), batch.column("size").to_numpy()
            edge = np.flatnonzero((group[1:] != group[:-1]) | (size[1:] != size[:-1])) + 1
            last = int(edge[-1]) if len(edge) else 0
            held = batch.slice(last)
            whole = batch.slice(0, last)
            yield from one_size(whole)
        if held is not None:
            yield from one_size(held)

    def one_size(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        size = rows.column("size").to_numpy()
        cuts = [0, *(np.flatnonzero(size[1:] != size[:-1]) + 1).tolist(), len(size)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield _compare(rows.slice(a, b - a), k, tables, min_cosine, wide)

    return dealt.mapInArrow(compare, "a long, b long, n long")


def near_duplicates(
    embeddings: DataFrame, min_cosine: float = 0.9, recall: float = RECALL, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    rows, wide = vectors(embeddings, id_col, vec_col)
    rows = cut(rows, "embedding-vectors")
    classes = rows.filter(F.col("norm").isNotNull()).groupBy("vec", "norm").agg(
        F.min("id").alias("low"), F.count("*").alias("members")
    )
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()), "embedding-classes")
    n = classes.count()
    found = cut(links(classes.select("node", "vec", "norm", "members"), n, min_cosine, recall, wide), "embedding-links")
    counts = found.filter("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    parts = connected_components(found.filter("b is not null").select("a", "b"), "embedding")
    named = classes.join(counts, "node", "left").join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select(
        "vec", "norm", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), "component_id"
    )
    out = rows.join(cut(named, "embedding-named"), ["vec", "norm"], "left")
    own = F.when(F.col("norm").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(False)).alias("kept"),
    )
