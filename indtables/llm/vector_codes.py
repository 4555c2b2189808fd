"""Vector code compression: product codes found through memoised grid cells.

Vectors become whole numbers, floor(``SCALE`` * x), and are cut into ``parts``
consecutive parts; each part position has a codebook that starts as that part
of the rows with the smallest ids and is refined by rounds of "assign every
part to its nearest entry, replace each entry by the floor of its mean".

The nearest entry is found through a grid. A part's coarse cell is its place
on a grid of ``levels`` steps a dimension over the values' range. For each cell
the smallest and the largest distance of every entry to the cell's box are sums
over dimensions, looked up in tables of (dimension, step, entry); an entry whose
smallest distance is above the least of the largest ones is dominated: another
entry is nearer everywhere in the box. The entries that are left are kept per
cell for the rest of the task (``REMEMBERED`` cells, in two generations), and
only those are evaluated, exactly. The bounds carry a slack for their single
precision, so the result is that of evaluating all entries, whatever the grid.

Scale: vectors are never shuffled. A round is one map over the written whole
numbers; a task adds up its own entries' sums and Spark adds those per (part,
entry, dimension) as decimals. What reaches the driver is the codebook:
``entries`` vectors. Errors are added per label before anything is joined; labels
with a thousandth of the rows or more (at most a thousand) are broadcast, the
others joined on the label, so no hot label lands in one task.

Defined results: rows whose vector is null, or holds null or non-finite
components, are dropped, and so are those of another length than the vector of
the smallest id kept. A length that ``parts`` does not divide gives the first
parts one dimension more. Rows of one id (or with a null id, which come last) are
ordered by their numbers, each is a row of its own. With fewer rows than
``entries`` the codebook is as long as there are rows. An empty table gives no
rows. Whole numbers above ``LARGEST`` in magnitude, whose squared distances need
not fit in a long, are an error. Other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indtables.llm.common import cut, ship

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Cells that a task remembers for each part, per generation.
REMEMBERED = 1 << 16
# Cells whose bounds are computed at once, and (vector, entry) pairs evaluated at once.
CELLS_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 16
LARGEST = 1 << 26
HOT_SHARE = 1000


def whole_vectors(embeddings: DataFrame, id_col: str, vec_col: str, keep: list[str]) -> DataFrame:
    """(id, x array<long>, the columns of ``keep``) of the rows with finite
    vectors; components are floor(SCALE * component)."""
    ship(embeddings.sparkSession)
    vec = F.col(f"`{vec_col}`")
    finite = lambda c: ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))
    whole = F.forall(vec, lambda c: F.coalesce(finite(c), F.lit(False)))
    scaled = F.transform(vec, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    small = F.forall(vec, lambda c: F.abs(c.cast("double") * SCALE) < LARGEST)
    large = F.raise_error(F.lit(f"vector components of {LARGEST // SCALE} or more are not supported"))
    rows = embeddings.filter(F.coalesce(whole, F.lit(False)))
    return rows.select(F.col(f"`{id_col}`").alias("id"), F.when(small, scaled).otherwise(large).alias("x"),
                       *[F.col(f"`{c}`") for c in keep])


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists of whole numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def cut_points(dims: int, parts: int) -> list[int]:
    """Where parts begin and end; the first ones are longer if they must be."""
    return [0, *np.cumsum([len(p) for p in np.array_split(np.arange(dims), parts)]).tolist()]


@dataclass(frozen=True)
class Grid:
    """Per dimension ``low`` and a step of 2^``shift``."""

    low: int
    shift: int
    levels: int


def grid_for(low: int, high: int, dims: int) -> Grid:
    """Steps of a power of two, as many as keep the tables small."""
    wanted = min(32, max(2, 2048 // max(dims, 1)))
    shift = 0
    while ((high - low) >> shift) + 1 > wanted:
        shift += 1
    return Grid(low, shift, ((high - low) >> shift) + 1)


class CellIndex:
    """Nearest entries of one part's codebook, through its grid."""

    def __init__(self, entries: np.ndarray, grid: Grid):
        self.entries, self.grid = entries, grid
        n, dims = entries.shape
        edge = grid.low + (np.arange(grid.levels, dtype=np.int64) << grid.shift)
        below = edge[None, :, None] - entries.T[:, None, :]  # (dims, levels, entries)
        above = below + (1 << grid.shift) - 1
        inside = (below <= 0) & (above >= 0)
        self.least = np.where(inside, 0, np.minimum(below**2, above**2)).astype(np.float32)
        self.most = np.maximum(below**2, above**2).astype(np.float32)
        self.slack = np.float32(1 + 1e-5 + 4e-7 * dims)
        self.new: dict[bytes, np.ndarray] = {}
        self.old: dict[bytes, np.ndarray] = {}
        self.cells = self.hits = 0

    def _candidates(self, steps: np.ndarray) -> list[np.ndarray]:
        """Per cell (row of ``steps``) the entries that are not dominated, rising."""
        out = []
        for s in range(0, len(steps), CELLS_AT_ONCE):
            some = steps[s : s + CELLS_AT_ONCE]
            least = np.zeros((len(some), len(self.entries)), np.float32)
            most = np.zeros_like(least)
            for d in range(some.shape[1]):
                least += self.least[d][some[:, d]]
                most += self.most[d][some[:, d]]
            kept = least <= most.min(axis=1, keepdims=True) * self.slack
            rows, places = np.nonzero(kept)
            out += np.split(places, np.searchsorted(rows, np.arange(1, len(some))))
        return out

    def candidates(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """(cell of each row of ``x``, entries of each cell)."""
        steps = ((x - self.grid.low) >> self.grid.shift).astype(np.uint8)
        if not x.shape[1]:
            return np.zeros(len(x), np.int64), [np.arange(min(1, len(self.entries)))]
        names = np.ascontiguousarray(steps).view(np.dtype((np.void, steps.shape[1]))).ravel()
        cells, first, at = np.unique(names, return_index=True, return_inverse=True)
        names = [c.tobytes() for c in cells]
        found = [self.new.get(c) if c in self.new else self.old.get(c) for c in names]
        missing = [i for i, f in enumerate(found) if f is None]
        self.cells += len(names)
        self.hits += len(names) - len(missing)
        if missing:
            for i, entries in zip(missing, self._candidates(steps[first[missing]])):
                found[i] = entries.astype(np.uint16)
        if len(self.new) + len(names) > REMEMBERED:
            self.old, self.new = self.new, {}
        self.new.update(zip(names, found))
        return at.ravel(), found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the nearest entry, squared distance); ties to the lower place."""
        cell, entries = self.candidates(x)
        sizes = np.array([len(e) for e in entries])[cell]
        place, far = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        total = np.cumsum(sizes)
        start = 0
        while start < len(x):
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + PAIRS_AT_ONCE, "right")))
            row = np.repeat(np.arange(start, end), sizes[start:end])
            entry = np.concatenate([entries[c] for c in cell[start:end].tolist()]).astype(np.int64)
            gap = x[row] - self.entries[entry]
            distance = np.einsum("ij,ij->i", gap, gap)
            first = total[start:end] - sizes[start:end] - done
            far[start:end] = np.minimum.reduceat(distance, first)
            at = np.flatnonzero(distance == np.repeat(far[start:end], sizes[start:end]))
            _, lowest = np.unique(row[at], return_index=True)
            place[start:end] = entry[at[lowest]]
            start = end
        return place, far


@dataclass(frozen=True)
class Codebooks:
    """Per part: the entries (n x dimensions) and the grid."""

    points: list[int]
    entries: list[np.ndarray]
    grid: Grid

    def indexes(self) -> list[CellIndex]:
        return [CellIndex(e, self.grid) for e in self.entries]

    def digest(self) -> str:
        """sha256 of all numbers by part, entry and position, joined by commas."""
        numbers = [str(n) for part in self.entries for n in part.reshape(-1).tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _assigned(x: np.ndarray, points: list[int], indexes: list[CellIndex]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for part, index in enumerate(indexes):
        yield part, *index.nearest(x[:, points[part] : points[part + 1]])


def _slices(batch: pa.RecordBatch, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for s in range(0, batch.num_rows, rows):
        yield batch.slice(s, rows)


def refine(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: assign every part, then replace each entry by its parts' mean, floored."""
    points = books.points

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = books.indexes()
        sums = [np.zeros(e.shape, np.int64) for e in books.entries]
        counts = [np.zeros(len(e), np.int64) for e in books.entries]
        for batch in batches:
            for some in _slices(batch):
                x = matrix(some.column("x"))
                for part, place, _ in _assigned(x, points, indexes):
                    np.add.at(sums[part], place, x[:, points[part] : points[part + 1]])
                    counts[part] += np.bincount(place, minlength=len(counts[part]))
        for part, n in enumerate(counts):
            used = np.flatnonzero(n)
            if len(used):
                total = [v.tolist() for v in sums[part][used]]
                yield pa.record_batch([pa.array([part] * len(used), pa.int32()), pa.array(used, pa.int32()),
                                       pa.array(n[used]), pa.array(total, pa.list_(pa.int64()))],
                                      names=["part", "entry", "n", "total"])

    found = rows.select("x").mapInArrow(fn, "part int, entry int, n long, total array<long>")
    # one row per part, entry and dimension; the count travels as dimension -1
    flat = found.select("part", "entry", F.posexplode(F.concat("total", F.array("n"))).alias("dim", "v"))
    added = flat.groupBy("part", "entry", "dim").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    new = [e.copy() for e in books.entries]
    of: dict[tuple[int, int], list[int]] = {}
    for r in added.orderBy("part", "entry", "dim").collect():  # at most entries * (dimensions + parts) rows
        of.setdefault((r["part"], r["entry"]), []).append(int(r["v"]))
    for (part, entry), v in of.items():
        new[part][entry] = [t // v[-1] for t in v[:-1]]
    return Codebooks(points, new, books.grid)


def initial(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The codebooks of the smallest ids; None without rows."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(1).collect()
    if not first:
        return None
    dims = len(first[0]["x"])
    same = rows.filter(F.size("x") == dims)
    low, high = same.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    start = [r["x"] for r in same.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()]
    x = np.array(start, np.int64).reshape(len(start), dims)
    points = cut_points(dims, parts)
    grid = grid_for(low or 0, high or 0, points[1])
    return Codebooks(points, [x[:, a:b].copy() for a, b in zip(points, points[1:])], grid)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after ``rounds`` over ``rows`` (of ``whole_vectors``, written)."""
    books = initial(rows, parts, entries)
    if books is not None:
        rows = rows.filter(F.size("x") == books.points[-1])
        for _ in range(rounds):
            books = refine(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` with ``codes`` array<int> and ``error`` long instead of ``x``."""
    rows = rows.filter(F.size("x") == books.points[-1])
    others = [c for c in rows.columns if c != "x"]
    points = books.points

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = books.indexes()
        for batch in batches:
            for some in _slices(batch):
                x = matrix(some.column("x"))
                codes, error = np.zeros((len(x), len(indexes)), np.int32), np.zeros(len(x), np.int64)
                for part, place, far in _assigned(x, points, indexes):
                    codes[:, part] = place
                    error += far
                ends = pa.array(np.arange(len(x) + 1) * len(indexes), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(codes.reshape(-1)))
                yield pa.record_batch([*[some.column(c) for c in others], lists, pa.array(error)],
                                      names=[*others, "codes", "error"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)
    return rows.select(*others, "x").mapInArrow(fn, f"{kinds}, codes array<int>, error long")


def decode(codes: np.ndarray, books: Codebooks) -> np.ndarray:
    """The whole numbers that codes (n x parts) stand for."""
    return np.concatenate([e[codes[:, p]] for p, e in enumerate(books.entries)], axis=1)


def label_totals(coded: DataFrame) -> DataFrame:
    """``coded`` (id, label, codes, error) with ``label_error``."""
    total = F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")
    sums = cut(coded.groupBy("label").agg(total, F.count("*").alias("n")), "codes-labels")
    n = coded.count()
    hot = sums.filter(F.col("n") * HOT_SHARE >= n).drop("n")  # at most HOT_SHARE rows
    cold = sums.filter(F.col("n") * HOT_SHARE < n).drop("n")

    def named(df: DataFrame) -> DataFrame:
        return df.select(F.col("label").alias("of"), "label_error")

    same = F.col("label").eqNullSafe(F.col("of"))
    tried = coded.join(F.broadcast(named(hot)), same, "left").drop("of")
    found = tried.filter("label_error is not null")
    rest = tried.filter("label_error is null").drop("label_error")
    return found.unionByName(rest.join(named(cold), same).drop("of"))


def product_codes(
    embeddings: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, codes, error, label_error, codebooks_sha256) of every row kept."""
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings, id_col, vec_col, [label_col]).withColumnRenamed(label_col, "label")
    rows = cut(rows, "codes-vectors")
    books = train(rows, parts, entries, rounds)
    if books is None:
        kind = rows.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_col}` {kind}, codes array<int>, error long, label_error long, "
                                         "codebooks_sha256 string")
    coded = cut(encode(rows, books), "codes-coded")
    return label_totals(coded).select(F.col("id").alias(id_col), "codes", "error", "label_error",
                                      F.lit(books.digest()).alias("codebooks_sha256"))


def digest(coded: DataFrame) -> DataFrame:
    """``codes`` as ``code``: two hex digits each, in part order."""
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select(*[code.alias("code") if c == "codes" else F.col(f"`{c}`") for c in coded.columns])
