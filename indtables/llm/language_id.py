"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order tree of byte contexts: how often each byte
followed each context of up to ``ORDER`` bytes in its training texts. The code
length of a byte is minus the logarithm of its probability under escape method
C: in the longest context the tree holds, a byte seen n times among t, of d
different ones, has n / (t + d); an unseen one costs an escape, d / (t + d), and
is coded in the context one byte shorter, at last as one of 256. The statistics
are frozen: no count changes while a text is scored. A text's language is the one
with the shortest code, its score that language's share of the probabilities (equal
priors). All contexts before a text's first byte are the byte zero.

Learning covers every labelled training text. A task counts its (language, n-gram)
pairs, adding equal ones up before they leave it; Spark adds up the rest, and the
shorter contexts from the longest. What a tree may hold is bounded: per context
length the ``MAX_CELLS`` / languages n-grams of the largest share in any language,
all of one power of two or none, so no tie is cut. A tree is therefore deep where
text is common and shallow elsewhere, and its size, and what reaches the driver and
the tasks, does not grow with the corpus. Scoring is a map: per byte one lookup in a
hash table for all languages at once, more only where an n-gram was never seen.

Defined results: null texts and texts without a letter (``\\p{L}``) are ``und`` with
score 0; so is everything where no language was learned (no labels, an empty
training set). Null labels are not learned, nor are null or empty texts or rows
with a null id, which are not held out either. Equal code lengths go to the first
language in alphabetical order. Long texts are scored whole, in pieces that carry
their context over. Repeated rows count as often as they come; an empty table gives
no rows; other columns are ignored. Over ``MAX_LANGUAGES`` languages are an error."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indtables.llm.common import cut, ship

ORDER = 4
# Costs that a context length may hold: n-grams times languages.
MAX_CELLS = 1 << 20
MAX_LANGUAGES = 4096
UNKNOWN = "und"
HELD_OUT = (4, 2)  # crc32 of the id modulo the first is the second
PIECE_BYTES = 1 << 20
# Different n-grams that a counting task holds before it passes them on.
COUNTED = 1 << 21
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_col: str) -> Column:
    """Whether a document's labels are kept from learning; null for a null id."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(HELD_OUT[0])) == HELD_OUT[1]


# ------------------------------------------------------------ n-grams

def pieces(texts: list[str | None]) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """Lists of (row, context, bytes) of up to ``PIECE_BYTES`` in all; texts are
    cut at fixed places, the context is the ``ORDER`` bytes before."""
    held, size = [], 0
    for row, text in enumerate(texts):
        raw = (text or "").encode()
        for s in range(0, len(raw), PIECE_BYTES):
            part = raw[s : s + PIECE_BYTES]
            if held and size + len(part) > PIECE_BYTES:
                yield held
                held, size = [], 0
            held.append((row, raw[max(0, s - ORDER) : s].rjust(ORDER, b"\0"), part))
            size += len(part)
    if held:
        yield held


def grams(piece: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram ending in each byte, where each part begins). An n-gram is
    ORDER + 1 bytes as a number, the coded byte lowest."""
    data = np.frombuffer(b"".join(c + raw for _, c, raw in piece), np.uint8).astype(np.int64)
    all_ = data[ORDER:].copy()
    for back in range(1, ORDER + 1):
        all_ |= data[ORDER - back : len(data) - back] << (8 * back)
    sizes = np.array([len(raw) for _, _, raw in piece])
    begin = np.cumsum(sizes + ORDER) - sizes - ORDER
    keep = np.ones(len(all_), bool)
    for b in begin[1:].tolist():  # n-grams that end in a part's context
        keep[b - ORDER : b] = False
    return all_[keep], np.cumsum(sizes) - sizes


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def counted(texts: DataFrame, languages: list[str]) -> DataFrame:
    """(gram, lang, n) of ``texts`` (text, lang): grams of ``ORDER`` + 1 bytes,
    lang a place in ``languages``, equal pairs of a task added up."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {name: i for i, name in enumerate(languages)}
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            lang = (keys >> (8 * (ORDER + 1))).astype(np.int32)
            gram = keys & ((1 << (8 * (ORDER + 1))) - 1)
            return pa.record_batch([pa.array(gram), pa.array(lang), pa.array(counts)], names=["gram", "lang", "n"])

        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            own = batch.column("text").to_pylist()
            for name in sorted(set(names.tolist())):
                high = place[name] << (8 * (ORDER + 1))
                for piece in pieces([own[i] for i in np.flatnonzero(names == name)]):
                    found, n = np.unique(grams(piece)[0], return_counts=True)
                    keys, counts = _merged(np.concatenate((keys, found | high)), np.concatenate((counts, n)))
                    if len(keys) > COUNTED:
                        yield out()
                        keys, counts = keys[:0], counts[:0]
        yield out()

    return texts.select("text", "lang").mapInArrow(fn, "gram long, lang int, n long")


def _shortened(counts: DataFrame, order: int) -> DataFrame:
    """The counts of n-grams of ``order`` + 1 bytes."""
    gram = F.col("gram").bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1))
    return counts.groupBy(gram.alias("gram"), "lang").agg(F.sum("n").alias("n"))


def _bounded(counts: DataFrame, totals: list[int], most: int) -> DataFrame:
    """The n-grams of the largest share in any language, at most ``most`` of them;
    those of one power of two stay or go together."""
    share = F.col("n") / F.get(F.array(*[F.lit(float(t)) for t in totals]), F.col("lang"))
    level = F.floor(-F.log2(share)).cast("int")
    levels = counts.groupBy("gram").agg(F.min(level).alias("level"))
    sizes = {r["level"]: r["n"] for r in levels.groupBy("level").agg(F.count("*").alias("n")).collect()}
    kept, last = 0, -1
    for one in sorted(sizes):  # at most some 60 levels
        if kept + sizes[one] > most:
            break
        kept, last = kept + sizes[one], one
    if last == max(sizes, default=-1):
        return counts
    return counts.join(levels.filter(F.col("level") <= last).select("gram"), "gram", "left_semi")


# ------------------------------------------------------------ the model

class Table:
    """Places of whole numbers: open addressing in arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 3))))
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.places = np.zeros(1 << self.bits, np.int32)
        at, left = self._hash(keys), np.arange(len(keys))
        while len(left):
            free = self.slots[at] == -1
            some, first = np.unique(at[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.slots[some] = keys[left[placed]]
            self.places[some] = left[placed]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, at = left[rest], (at[rest] + 1) & (len(self.slots) - 1)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where there is none."""
        at = self._hash(keys)
        there = self.slots[at]
        out = np.where(there == keys, self.places[at], -1)
        left = np.flatnonzero((there != keys) & (there != -1))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.slots) - 1)
            there = self.slots[at]
            hit = there == keys[left]
            out[left[hit]] = self.places[at[hit]]
            on = ~hit & (there != -1)
            left, at = left[on], at[on]
        return out


class Model:
    """Code lengths in bits of all languages, from the counts per context length."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.languages = languages
        self.tables: list[Table] = []
        self.costs: list[np.ndarray] = []  # (languages, n-grams)
        self.contexts: list[Table] = []
        self.escapes: list[np.ndarray] = []  # (languages, contexts)
        for gram, lang, n in counts:
            keys, at = np.unique(gram, return_inverse=True)
            own = np.zeros((len(languages), len(keys)))
            own[lang, at] = n
            before, context = np.unique(keys >> 8, return_inverse=True)
            total = np.zeros((len(languages), len(before)))
            kinds = np.zeros_like(total)
            for one in range(len(languages)):
                total[one] = np.bincount(context, own[one], len(before))
                kinds[one] = np.bincount(context, own[one] > 0, len(before))
            seen = total > 0
            escape = np.zeros_like(total)  # an unknown context costs nothing to leave
            escape[seen] = -np.log2(kinds[seen] / (total[seen] + kinds[seen]))
            order = len(self.tables)
            shorter = self._cost(order - 1, keys & ((1 << (8 * order)) - 1))
            cost = escape[:, context] + shorter
            here = own > 0
            cost[here] = -np.log2(own[here] / (total + kinds)[:, context][here])
            none = np.zeros((len(languages), 1))  # what the place -1 finds
            self.tables.append(Table(keys))
            self.costs.append(np.concatenate((cost, none), axis=1))
            self.contexts.append(Table(before))
            self.escapes.append(np.concatenate((escape, none), axis=1))

    def _cost(self, order: int, keys: np.ndarray) -> np.ndarray:
        """(languages, keys): bits of the lowest byte of each key after the
        ``order`` bytes above it."""
        out = np.full((len(self.languages), len(keys)), 8.0)
        if order < 0:
            return out
        at = self.tables[order].find(keys)
        hit = at >= 0
        if hit.all():
            for one, costs in enumerate(self.costs[order]):
                np.take(costs, at, out=out[one])
            return out
        miss = np.flatnonzero(~hit)
        lost = keys[miss]
        context = self.contexts[order].find(lost >> 8)
        shorter = self._cost(order - 1, lost & ((1 << (8 * order)) - 1))
        for one, costs in enumerate(self.costs[order]):
            np.take(costs, at, out=out[one], mode="wrap")
            out[one, miss] = shorter[one] + self.escapes[order][one][context]
        return out

    def lengths(self, texts: list[str | None]) -> np.ndarray:
        """(texts, languages): code lengths in bits."""
        out = np.zeros((len(texts), len(self.languages)))
        for piece in pieces(texts):
            keys, begin = grams(piece)
            rows = np.array([row for row, _, _ in piece])
            step = max(1, (1 << 24) // len(self.languages))
            if len(keys) <= step:
                np.add.at(out, rows, np.add.reduceat(self._cost(len(self.tables) - 1, keys), begin, axis=1).T)
                continue
            for s in range(0, len(keys), step):  # many languages: fewer bytes at once
                cost = self._cost(len(self.tables) - 1, keys[s : s + step])
                inside = np.unique(np.concatenate(([s], begin[(begin > s) & (begin < s + step)])))
                of = np.searchsorted(begin, inside, "right") - 1
                np.add.at(out, rows[of], np.add.reduceat(cost, inside - s, axis=1).T)
        return out


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER
) -> Model | None:
    """The trees of all languages from the rows that are not held out; None
    where nothing is labelled."""
    ship(docs.sparkSession)
    text, lang = F.col(f"`{text_col}`").cast("string"), F.col(f"`{lang_col}`").cast("string")
    known = docs.filter(~held_out(id_col) & lang.isNotNull() & (F.octet_length(text) > 0))
    rows = known.select(text.alias("text"), lang.alias("lang"))
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    if not languages:
        return None
    found = cut(counted(rows, languages).groupBy("gram", "lang").agg(F.sum("n").alias("n")), "language-grams")
    totals = [0] * len(languages)
    for r in found.groupBy("lang").agg(F.sum("n").alias("n")).collect():
        totals[r["lang"]] = r["n"]
    counts = []
    for k in range(order + 1):
        one = found if k == ORDER else cut(_shortened(found, k), "language-shorter")
        held = _bounded(one, totals, MAX_CELLS // len(languages)).toArrow()  # at most MAX_CELLS rows
        counts.append(tuple(held.column(c).to_numpy() for c in ("gram", "lang", "n")))
    return Model(languages, counts)


def languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None
) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row; learned from ``docs``
    itself unless a model is given."""
    spark = docs.sparkSession
    if model is None:
        model = learn(docs, id_col, text_col, lang_col)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"),
                       text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kind = rows.schema["id"].dataType.simpleString()
    out = [F.col("id").alias(id_col), "held_out", "lang_pred", "score"]
    if model is None:
        return rows.select("id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")).select(*out)
    shared = spark.sparkContext.broadcast(model)  # bounded by MAX_CELLS

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = pa.array([*m.languages, UNKNOWN])
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                some = batch.slice(s, 512)
                letters = some.column("letters").to_numpy(zero_copy_only=False)
                bits = m.lengths([t if ok else None for t, ok in zip(some.column("text").to_pylist(), letters.tolist())])
                best = bits.argmin(axis=1)
                gap = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
                score = np.where(letters, 1 / np.exp2(-gap).sum(axis=1), 0.0)
                pred = names.take(pa.array(np.where(letters, best, len(m.languages))))
                yield pa.record_batch([some.column("id"), some.column("held_out"), pred, pa.array(score)],
                                      names=["id", "held_out", "lang_pred", "score"])
        pa.default_memory_pool().release_unused()

    schema = f"id {kind}, held_out boolean, lang_pred string, score double"
    return rows.mapInArrow(fn, schema).select(*out)
