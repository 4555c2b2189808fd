"""Exact substring dedup by external induced suffix sorting.

A byte goes if a string of ``width`` bytes that covers it also starts in a
document with a smaller id; strings never cross documents and are judged on
the input.

Sharding. Every string of ``width`` bytes has an anchor: the k-gram inside it
with the smallest hash (the leftmost of equals). Equal strings have equal
anchors at equal places, so strings can be dealt by their anchor's hash without
losing a match. Neighbouring strings with one anchor form a fragment.

1. Documents are packed, in the order they come, into chunks of about
   ``chunk_bytes`` (one row each, compressed, written), so that a chunk is one
   unit of recomputation and copies inside it combine.
2. Each chunk sends its distinct anchor hashes, 4 bytes each, and the bytes of
   their distinct fragments, to groups; a group answers which of them other
   chunks have too. Most text is unique and stops here.
3. Each chunk sends its distinct fragments of shared anchors, with the smallest
   document id that holds them, to the shard of the anchor. An anchor whose
   fragments weigh over ``HOT_BYTES``, counted once a chunk, sends their strings
   one by one, dealt by their own hash, so that no key gathers in one task.
4. A shard (bin) joins equal fragments. Equal strings have one anchor at one
   place in them, so a fragment can share strings only with other fragments of
   its anchor, and its own strings all differ: where an anchor is left with one
   fragment, the fragment's smallest id is that of its strings. All suffixes of
   the other fragments are sorted by external induced sorting
   (``induced_sort``: disk-backed queue, recursion). Neighbours in suffix order
   with a common prefix of ``width`` bytes or more are equal strings; the
   smallest id of each run of equals goes back to the chunks.
5. Each chunk marks the strings whose smallest id is below the document's own.

A chunk sends one row to each group, which holds many bins and takes them one
after another: ``GROUPS`` rows at most, and beyond ``GROUPS`` times
``GROUP_BYTES`` of text one for every ``GROUP_BYTES``. Bins and groups grow
with the input, so a task's share stays the same. Only the numbers of bytes
and chunks reach the driver.

Defined results: a null text is the empty text; texts shorter than ``width``
lose nothing; rows of a repeated id do not count against each other; a null id
counts as larger than all others; an empty table gives no rows; other columns
are ignored; long texts are whole (a document is never split)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from indtables.llm.common import cut, ship
from indtables.llm.induced_sort import common_prefixes, suffix_array

WIDTH = 50
CHUNK_BYTES = 8 << 20
BIN_BYTES = 3 << 20
# Rows that a chunk sends at most, until a group's share of text passes GROUP_BYTES.
GROUPS = 256
GROUP_BYTES = 32 << 20
HOT_BYTES = 1 << 20
# By default only bytes make an anchor hot.
HOT_CHUNKS = None
PIECE = 1 << 17
# Occurrences that are judged at once.
OCCURRENCES = 1 << 16
NO_ID = np.iinfo(np.int64).max
SHARED, HOT = 1, 2
KEY_BITS = 40


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def kgram(width: int) -> int:
    return max(1, width // 2 - 1)


def anchors(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(first, last, key, doc, spot) of every fragment: the first and last start
    of its strings, the anchor's hash, the document's place and where in the
    fragment its anchor is. ``offsets``: where documents start, and the end."""
    n = len(data) - width + 1
    k = kgram(width)
    spread = width - k + 1
    low = np.uint64((1 << 24) - 1)
    if n <= 0 or not len(data):
        return (np.zeros(0, np.int64),) * 5
    place, key = np.empty(n, np.int32), np.empty(n, np.uint64)
    with np.errstate(over="ignore"):
        for s in range(0, n, PIECE):
            e = min(n, s + PIECE)
            part = data[s : e + width - 1].astype(np.uint64) + np.uint64(1)
            # hash of every k-gram by doubling: h(a+b) = h(a) * B^b + h(b)
            h, size, base = part, 1, 0x9E3779B97F4A7C15
            total, total_size, power = None, 0, base
            bits = k
            while True:
                if bits & 1:
                    if total is None:
                        total, total_size = h, size
                    else:
                        m = len(part) - total_size - size + 1
                        total = total[:m] * np.uint64(power) + h[total_size : total_size + m]
                        total_size += size
                bits >>= 1
                if not bits:
                    break
                m = len(h) - size
                h = h[:m] * np.uint64(power) + h[size : size + m]
                size, power = size * 2, power * power % (1 << 64)
            h = (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equals
            smallest, size = h, 1
            while size * 2 <= spread:
                smallest = np.minimum(smallest[:-size], smallest[size:])
                size *= 2
            if size < spread:
                smallest = np.minimum(smallest[: size - spread], smallest[spread - size :])
            place[s:e] = (smallest[: e - s] & low).astype(np.int64) + s
            key[s:e] = smallest[: e - s] >> np.uint64(24)
    starts = np.zeros(len(data) + 1, np.int32)
    np.add.at(starts, offsets[1:-1], 1)
    doc = np.cumsum(starts, out=starts)[: len(data)]
    ok = doc[:n] == doc[width - 1 :]
    new = ok.copy()
    new[1:] &= ~ok[:-1] | (place[1:] != place[:-1]) | (doc[1:n] != doc[: n - 1])
    first = np.flatnonzero(new)
    closes = np.flatnonzero(ok & np.concatenate((new[1:] | ~ok[1:], [True])))
    return first, closes, key[first], doc[first].astype(np.int64), place[first] - first


class Chunk:
    """One chunk's documents and fragments."""

    def __init__(self, row: dict, width: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        sizes = np.frombuffer(row["sizes"], np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.data = np.frombuffer(unpack(row["data"]), np.uint8)
        self.width = width
        self.first, self.last, self.key, self.doc, self.spot = anchors(self.data, self.offsets, width)
        self.keys, self.of = np.unique(self.key, return_inverse=True)

    def grouped(self, groups: int) -> Iterator[tuple[int, np.ndarray]]:
        """Places of the distinct keys by group."""
        at = (self.keys % np.uint64(groups)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        for part in np.split(order, cuts):
            if len(part):
                yield int(at[part[0]]), part

    def weights(self, enough: float) -> np.ndarray:
        """Bytes of each distinct key's distinct fragments; up to ``enough``
        bytes equal fragments may count again."""
        sizes = self.last - self.first + self.width
        out = np.bincount(self.of, sizes, len(self.keys)).astype(np.int64)
        many = np.flatnonzero((out > enough)[self.of])
        if len(many):
            raw, w = self.data.tobytes(), self.width
            parts = [raw[a : b + w] for a, b in zip(self.first[many].tolist(), self.last[many].tolist())]
            once = many[_numbered(parts, {}, return_first=True)]
            heavy = out > enough
            out[heavy] = np.bincount(self.of[once], sizes[once], len(self.keys))[heavy]
        return out

    def shared(self, answers: list[dict], groups: int) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct key: is it in other documents too, is it hot."""
        flags = np.zeros(len(self.keys), np.uint8)
        got = {a["bin"]: a["flags"] for a in answers or []}
        for g, part in self.grouped(groups):
            if g in got:
                flags[part] = np.frombuffer(unpack(got[g]), np.uint8)
        # several documents of this chunk
        ids = self.ids[self.doc]
        low, high = np.full(len(self.keys), NO_ID), np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.of, ids)
        np.maximum.at(high, self.of, ids)
        return (flags & SHARED > 0) | (low < high), flags & HOT > 0

    def fragments(self, answers: list[dict], groups: int, bins: int) -> Fragments:
        shared, hot = self.shared(answers, groups)
        use = np.flatnonzero(shared[self.of])
        first, last, ids = self.first[use], self.last[use], self.ids[self.doc[use]]
        raw, w = self.data.tobytes(), self.width
        known: dict[bytes, int] = {}
        frag = _numbered((raw[a : b + w] for a, b in zip(first.tolist(), last.tolist())), known, len(first))
        low = np.full(len(known), NO_ID)
        np.minimum.at(low, frag, ids)
        n, spot, key, is_hot = (np.empty(len(known), t) for t in (np.int64, np.int64, np.uint64, bool))
        n[frag], spot[frag], key[frag], is_hot[frag] = last - first + 1, self.spot[use], self.key[use], hot[self.of[use]]
        units, sizes = list(known), n + w - 1
        shard = (key % np.uint64(bins)).astype(np.int64)
        strings = np.zeros(0, np.int64)
        if is_hot.any():
            alone: dict[bytes, int] = {}
            parts = [units[i][a : a + w] for i in np.flatnonzero(is_hot).tolist() for a in range(n[i])]
            strings = _numbered(parts, alone)
            least = np.full(len(alone), NO_ID)
            np.minimum.at(least, strings, np.repeat(low[is_hot], n[is_hot]))
            where = np.empty(len(alone), np.int64)
            where[strings] = np.repeat(spot[is_hot], n[is_hot]) - _steps(n[is_hot])
            strings += np.count_nonzero(~is_hot)
            units = [units[i] for i in np.flatnonzero(~is_hot).tolist()] + list(alone)
            at = np.fromiter((xxhash.xxh64_intdigest(x) % bins for x in alone), np.int64, len(alone))
            low, shard, spot, sizes = (np.concatenate((x[~is_hot], y)) for x, y in (
                (low, least), (shard, at), (spot, where), (sizes, np.full(len(alone), w))))
        order = np.lexsort((shard // groups, shard % groups))
        return Fragments(first, ids, frag, n, is_hot, strings, units, sizes, spot, shard, low, order)


class Fragments(NamedTuple):
    """Occurrences of shared anchors' strings (first, document id, fragment);
    per fragment the number of its strings and whether it is hot; and the units
    that are sent: the other fragments, then the hot ones' strings
    (``strings``: the unit of each), with size, the anchor's place, shard and
    smallest id. ``order``: the units as they are sent, by group and bin."""

    first: np.ndarray
    ids: np.ndarray
    frag: np.ndarray
    n: np.ndarray
    hot: np.ndarray
    strings: np.ndarray
    units: list[bytes]
    sizes: np.ndarray
    spot: np.ndarray
    shard: np.ndarray
    low: np.ndarray
    order: np.ndarray

    def runs(self, values: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
        """From the values of the units' strings as sent, in runs that end with
        their unit: (runs, value, start, length), the number of runs of each
        fragment, and all of those."""
        n = self.sizes - width + 1
        begin = np.cumsum(n[self.order]) - n[self.order]
        at = np.cumsum(lengths) - lengths
        head, count = np.empty((2, len(n)), np.int64)
        head[self.order] = np.searchsorted(at, begin)
        count[self.order] = np.diff(np.append(head[self.order], len(at)))
        alone = np.count_nonzero(~self.hot)
        own, first = np.where(self.hot, self.n, 0), np.zeros(len(self.n), np.int64)
        own[~self.hot], first[~self.hot] = count[:alone], head[:alone]
        which = np.repeat(first, own) + _steps(own)
        if len(self.strings):
            which[np.repeat(self.hot, own)] = head[self.strings]
        length = lengths[which].astype(np.int64)
        step = np.cumsum(length) - length
        return own, values[which], step - np.repeat(np.cumsum(self.n) - self.n, own), length


def _numbered(parts: Iterable[bytes], known: dict[bytes, int], n: int = -1, return_first: bool = False) -> np.ndarray:
    """The number of each of ``parts`` in ``known``, which grows; or the places
    where each comes first."""
    out = np.fromiter((known.setdefault(x, len(known)) for x in parts), np.int64, n)
    return np.unique(out, return_index=True)[1] if return_first else out


def _steps(n: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each of ``n``."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def key_flags(keys: np.ndarray, weights: np.ndarray, hot_bytes: int, hot_chunks: int | None) -> np.ndarray:
    """SHARED and HOT of each of the chunks' distinct keys in a group."""
    _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
    hot = np.bincount(inverse, weights) > hot_bytes
    if hot_chunks is not None:
        hot |= n > hot_chunks
    return (SHARED * (n > 1) + HOT * hot).astype(np.uint8)[inverse]


def rivals(contents: list[bytes], spot: np.ndarray, width: int) -> np.ndarray:
    """Which of the distinct fragments have another one with their anchor."""
    k = kgram(width)
    of = _numbered((c[a : a + k] for c, a in zip(contents, spot.tolist())), {}, len(contents))
    return np.bincount(of)[of] > 1


def smallest_ids(contents: list[bytes], n: np.ndarray, low: np.ndarray, spot: np.ndarray, width: int) -> np.ndarray:
    """For each of the ``n`` strings of every distinct fragment, the smallest id."""
    out = np.repeat(low, n)
    several = rivals(contents, spot, width)
    if several.any():
        which = np.flatnonzero(several)
        out[np.repeat(several, n)] = sort_shard([contents[i] for i in which.tolist()], low[which], width)
    return out


def sort_shard(contents: list[bytes], low: np.ndarray, width: int) -> np.ndarray:
    """For every string of the fragments, the smallest id of its equals."""
    sizes = np.array([len(c) for c in contents], np.int64)
    text = np.frombuffer(b"".join(c + b"\0" for c in contents), np.uint8).astype(np.int16) + 1
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 0  # closes a fragment
    order = suffix_array(text, depth=width)
    frag = np.repeat(np.arange(len(contents)), sizes + 1)
    is_string = ends[frag] - np.arange(len(text)) >= width
    order = order[is_string[order]]
    new = common_prefixes(text, order, width) < width
    new[0] = True
    starts = np.flatnonzero(new)
    smallest = np.minimum.reduceat(low[frag[order]], starts)
    out = np.empty(len(text), np.int64)
    out[order] = np.repeat(smallest, np.diff(np.concatenate((starts, [len(order)]))))
    return out[is_string]


def chunked(docs: DataFrame, chunk_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """(chunk, ids, sizes, data, n_bytes, seq): whole documents, packed."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def out() -> pa.RecordBatch:
            known = np.array([NO_ID if i is None else i for i in ids], np.int64)
            sizes = np.array([len(t) for t in texts], np.int64)
            nulls = np.array([i is None for i in ids], np.uint8)
            return pa.record_batch(
                [pa.array([x], pa.binary()) for x in (known.tobytes(), nulls.tobytes(), sizes.tobytes(), pack(b"".join(texts)))]
                + [pa.array([int(sizes.sum())], pa.int64())],
                names=["ids", "nulls", "sizes", "data", "n_bytes"],
            )

        for batch in batches:
            for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(i)
                texts.append(t.encode())
                size += len(texts[-1])
                if size >= chunk_bytes:
                    yield out()
                    ids, texts, size = [], [], 0
        if ids:
            yield out()

    packed = rows.mapInArrow(fn, "ids binary, nulls binary, sizes binary, data binary, n_bytes long")
    return cut(packed.withColumn("chunk", F.monotonically_increasing_id()), "suffix-chunks")


def _each(df: DataFrame, schema: str, fn) -> DataFrame:
    """``fn`` over one row (a dict) at a time, yielding record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from fn(batch.slice(i, 1).to_pylist()[0])

    return df.mapInArrow(run, schema)


def _of_any_ids(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """``duplicate_spans`` by the place of each id in the order of all ids, a whole
    number: partitions of a range sort come in order, and so do their rows."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ids = rows.select("id").filter("id IS NOT NULL").distinct()
    place = F.monotonically_increasing_id().alias("_place")
    ids = cut(ids.repartitionByRange("id").sortWithinPartitions("id").select("id", place), "suffix-ids")
    placed = rows.join(ids, "id", "left").select("_place", "text")
    found = duplicate_spans(placed, id_col="_place", text_col="text", **options)
    out = found.join(ids, "_place", "left")
    return out.select(F.col("id").alias(id_col), *[c for c in found.columns if c != "_place"])


def duplicate_spans(
    docs: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    bin_bytes: int = BIN_BYTES,
    hot_chunks: int | None = HOT_CHUNKS,
    with_kept: bool = False,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, spans (byte offsets of
    the maximal removed runs), kept_sha256, and the kept bytes if asked for.
    ``hot_chunks``: an anchor that more chunks hold is hot too."""
    if not isinstance(docs.schema[id_col].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return _of_any_ids(docs, id_col, text_col, width=width, chunk_bytes=chunk_bytes, bin_bytes=bin_bytes,
                           hot_chunks=hot_chunks, with_kept=with_kept, hot_bytes=hot_bytes)
    chunks = chunked(docs, chunk_bytes, id_col, text_col)
    total, n_chunks = chunks.agg(F.sum("n_bytes"), F.count("chunk")).first()
    total = total or 0
    bins = max(8, math.ceil(total / bin_bytes))
    groups = min(bins, max(GROUPS, math.ceil(total / GROUP_BYTES)))
    subs = math.ceil(bins / groups)  # bins of a group: its number, and every ``groups`` from there

    def send_keys(row: dict) -> Iterator[pa.RecordBatch]:
        c = Chunk(row, width)
        weights = c.weights(hot_bytes / max(1, n_chunks))
        at, keys, heavy = [], [], []
        for g, part in c.grouped(groups):
            at.append(g)
            keys.append((c.keys[part] // np.uint64(groups)).astype(np.uint32).tobytes())
            heavy.append(pack(weights[part].tobytes()))
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array([row["chunk"]] * len(at), pa.int64()),
                               pa.array(keys, pa.binary()), pa.array(heavy, pa.binary())], names=["bin", "chunk", "keys", "weights"])

    def answer_keys(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(k, np.uint32) for k in t.column("keys").to_pylist()]
        weights = [np.frombuffer(unpack(k), np.int64) for k in t.column("weights").to_pylist()]
        # equal keys of one chunk can only stem from the cut to 32 bits; they count twice, which is harmless
        flags = key_flags(np.concatenate(parts), np.concatenate(weights), hot_bytes, hot_chunks)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        packed = [pack(f.tobytes()) for f in np.split(flags, cuts)]
        return pa.table({"bin": t.column("bin"), "chunk": t.column("chunk"), "flags": pa.array(packed, pa.binary())})

    sent = _each(chunks, "bin int, chunk long, keys binary, weights binary", send_keys)
    answers = (
        sent.groupBy("bin").applyInArrow(answer_keys, "bin int, chunk long, flags binary")
        .groupBy("chunk").agg(F.collect_list(F.struct("bin", "flags")).alias("answers"))
    )
    known = chunks.join(cut(answers, "suffix-answers"), "chunk", "left")

    def send_fragments(row: dict) -> Iterator[pa.RecordBatch]:
        f = Chunk(row, width).fragments(row["answers"], groups, bins)
        at = f.shard[f.order] % groups
        for part in np.split(f.order, np.flatnonzero(np.diff(at)) + 1):
            if len(part):
                own = [f.units[i] for i in part.tolist()]
                sizes = f.sizes[part].astype(np.int32)
                counts = np.bincount(f.shard[part] // groups, minlength=subs).astype(np.int32)
                yield pa.record_batch(
                    [pa.array([int(f.shard[part[0]] % groups)], pa.int32()), pa.array([row["chunk"]], pa.int64()),
                     *(pa.array([pack(x)], pa.binary()) for x in (
                         counts.tobytes(), sizes.tobytes(), f.spot[part].astype(np.int32).tobytes(), b"".join(own), f.low[part].tobytes()))],
                    names=["bin", "chunk", "counts", "sizes", "spots", "contents", "low"],
                )

    def sort_fragments(t: pa.Table) -> pa.Table:
        def numbers(name: str, kind: type) -> list[np.ndarray]:
            return [np.frombuffer(unpack(x), kind) for x in t.column(name).to_pylist()]

        counts = np.stack(numbers("counts", np.int32)).astype(np.int64)
        each = numbers("sizes", np.int32)
        sizes, low = np.concatenate(each).astype(np.int64), np.concatenate(numbers("low", np.int64))
        spots = np.concatenate(numbers("spots", np.int32))
        raw = [unpack(x) for x in t.column("contents").to_pylist()]
        at = [np.concatenate(([0], np.cumsum(s)))[np.concatenate(([0], np.cumsum(c)))].tolist() for s, c in zip(each, counts)]
        of_sub = np.repeat(np.tile(np.arange(subs), len(counts)), counts.ravel())
        order = np.argsort(of_sub, kind="stable")
        values, lengths, runs = [], [], []
        for sub, which in enumerate(np.split(order, np.cumsum(counts.sum(axis=0))[:-1])):  # a bin at a time
            if not len(which):
                continue
            text = b"".join([r[a[sub] : a[sub + 1]] for r, a in zip(raw, at)])
            ends = np.cumsum(sizes[which]).tolist()
            known: dict[bytes, int] = {}
            places = _numbered((text[a:b] for a, b in zip([0, *ends], ends)), known, len(ends))
            smallest = np.full(len(known), NO_ID)
            np.minimum.at(smallest, places, low[which])
            spot, n = np.empty((2, len(known)), np.int64)
            spot[places], n[places] = spots[which], sizes[which] - width + 1
            contents = list(known)
            del text, known
            found = smallest_ids(contents, n, smallest, spot, width)
            begin, m = np.cumsum(n) - n, n[places]
            found = found[np.repeat(begin[places], m) + _steps(m)]
            # runs of equal ids, each inside a fragment
            new = np.concatenate(([True], found[1:] != found[:-1]))
            first = np.cumsum(m) - m
            new[first] = True
            starts = np.flatnonzero(new)
            values.append(found[starts])
            lengths.append(np.diff(np.append(starts, len(found))).astype(np.int32))
            runs.append(np.add.reduceat(new.astype(np.int64), first))
        # back from the order of bins to that of rows
        of = np.repeat(order, np.concatenate(runs))
        back = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[back], np.cumsum([len(s) for s in each])[:-1])
        both = [[pack(x.tobytes()) for x in np.split(np.concatenate(v)[back], cuts)] for v in (values, lengths)]
        return pa.table({"bin": t.column("bin"), "chunk": t.column("chunk"), **{
            name: pa.array(v, pa.binary()) for name, v in zip(("found", "lengths"), both)}})

    sent = _each(known, "bin int, chunk long, counts binary, sizes binary, spots binary, contents binary, low binary", send_fragments)
    found = (
        sent.groupBy("bin").applyInArrow(sort_fragments, "bin int, chunk long, found binary, lengths binary")
        .groupBy("chunk").agg(F.collect_list(F.struct("bin", "found", "lengths")).alias("found"))
    )
    judged = known.join(cut(found, "suffix-found"), "chunk", "left")

    def finish(row: dict) -> Iterator[pa.RecordBatch]:
        c = Chunk(row, width)
        f = c.fragments(row["answers"], groups, bins)
        cover = np.zeros(len(c.data) + 1, np.int32)
        if len(f.first):
            got = {a["bin"]: [np.frombuffer(unpack(a[x]), t) for x, t in (("found", np.int64), ("lengths", np.int32))] for a in row["found"]}
            values, lengths = (np.concatenate([got[g][i] for g in sorted(got)]) for i in (0, 1))
            runs, smallest, start, length = f.runs(values, lengths, width)
            begin = np.cumsum(runs) - runs
            for a in range(0, len(f.first), OCCURRENCES):
                first, frag, ids = (x[a : a + OCCURRENCES] for x in (f.first, f.frag, f.ids))
                m = runs[frag]
                run = np.repeat(begin[frag], m) + _steps(m)
                gone = smallest[run] < np.repeat(ids, m)
                starts = (np.repeat(first, m) + start[run])[gone]
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + length[run][gone] + width - 1, -1)
        gone = np.cumsum(cover, out=cover)[: len(c.data)] > 0
        nulls = np.frombuffer(row["nulls"], np.uint8)
        out: dict[str, list] = {x: [] for x in (id_col, "n_bytes", "n_removed", "spans", "kept_sha256", "kept")}
        for d, (a, b) in enumerate(zip(c.offsets[:-1].tolist(), c.offsets[1:].tolist())):
            own, bytes_ = gone[a:b], c.data[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.uint8), [0])).astype(np.int8)))
            kept = bytes_[~own].tobytes() if len(edges) else bytes_.tobytes()
            out[id_col].append(None if nulls[d] else int(c.ids[d]))
            out["n_bytes"].append(b - a)
            out["n_removed"].append(b - a - len(kept))
            out["spans"].append([{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()])
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_kept:
                out["kept"].append(kept)
        if not with_kept:
            del out["kept"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.binary()]
        yield pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    schema = f"{id_col} long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept_sha256 string"
    return _each(judged, schema + (", kept binary" if with_kept else ""), finish)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
