"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs of a-z (after lower-casing A-Z), 0-9 and non-ASCII characters.
A window is ``n`` consecutive words of an item; an item of fewer words, but
not none, is one window. The automaton holds every distinct window as
" w1 w2 ... wn " and passes once over each document's words joined the same
way, so it finds whole words only. Word positions are mapped back to character
offsets of the original text.

The items are the stated query set: their total size is measured, and they go
to the tasks in blocks of at most ``block_bytes``, one automaton at a time (a
single block at usual benchmark sizes). Documents are never shuffled.

Defined results: null texts and texts without words have no words and no
hits; items without words have no windows; an item with a null id counts as
"null"; items with the same id count once; repeated documents each give a row;
empty tables give no hits or no rows; other columns are ignored; long texts
are scanned whole."""

from __future__ import annotations

import hashlib
import math
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indtables.llm.common import cut, id_text, map_batches, with_row, without_row

BLOCK_BYTES = 8 * 1024 * 1024
WINDOW_WORDS = 10
# Byte by byte: A-Z to a-z, other ASCII that is no letter or digit to a space;
# UTF-8's bytes over 127 are parts of word characters.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")
SPAN = "struct<start: int, end: int>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def windows(item: str | None, n: int) -> set[bytes]:
    w = words(item)
    return {b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def automaton(items: list[tuple[str, str]], n: int):
    of: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows(text, n):
            of.setdefault(window, set()).add(item)
    found = ahocorasick.Automaton()
    for window, ids in of.items():
        found.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(ids)))
    found.make_automaton()
    return found if of else None


def scan(found, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(words, merged hit runs as [first word, past the last), items)."""
    w = words(text)
    if found is None or not w:
        return len(w), [], set()
    line = f" {b' '.join(w).decode('latin-1')} "
    hits = list(found.iter(line))
    if not hits:
        return len(w), [], set()
    at = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)
    ends = np.searchsorted(at, [e for e, _ in hits])  # the space after the last word
    runs: list[tuple[int, int]] = []
    items: set[str] = set()
    for start, end in sorted((int(e) - size, int(e)) for e, (_, (size, _)) in zip(ends, hits)):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    for _, (_, ids) in hits:
        items.update(ids)
    return len(w), runs, items


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def char_spans(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Runs of words as character offsets in the original text."""
    raw = text.encode()
    bounds = [m.span() for m in _WORD.finditer(raw.translate(_TABLE))]
    out = []
    for first, past in runs:
        start = len(raw[: bounds[first][0]].decode())
        out.append({"start": start, "end": start + len(raw[bounds[first][0] : bounds[past - 1][1]].decode())})
    return out


_automata: dict[str, object] = {}


def _scanned(
    rows: DataFrame, items: DataFrame, n: int, item_col: str, item_text_col: str, block_bytes: int
) -> DataFrame:
    """Adds n_words, runs (of words) and items to rows with a ``text``."""
    sc = rows.sparkSession.sparkContext
    items = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
        F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("words"),
    )
    total = items.agg(F.sum(F.octet_length("words") + F.octet_length("item"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    rows = rows.withColumns(
        {"n_words": F.lit(0).cast("long"), "runs": F.expr(f"cast(array() as array<{SPAN}>)"),
         "items": F.expr("cast(array() as array<string>)")}
    )
    for block in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        held = sc.broadcast([(r["item"], r["words"]) for r in part.collect()])  # at most about block_bytes
        key = hashlib.sha1(repr((n, sorted(held.value))).encode()).hexdigest()

        def fn(batch: pa.RecordBatch, held=held, key=key) -> pa.RecordBatch:
            if key not in _automata:
                _automata.clear()
                _automata[key] = automaton(held.value, n)
            n_words, runs, found = [], [], []
            for text, old_runs, old_items in zip(*(batch.column(c).to_pylist() for c in ("text", "runs", "items"))):
                size, new, ids = scan(_automata[key], text)
                n_words.append(size)
                new = merge_runs(new + [(r["start"], r["end"]) for r in old_runs]) if old_runs else new
                runs.append([{"start": a, "end": b} for a, b in new])
                found.append(sorted(ids.union(old_items)))
            new = {"n_words": pa.array(n_words, pa.int64()), "runs": pa.array(runs, SPANS),
                   "items": pa.array(found, pa.list_(pa.string()))}
            names = batch.schema.names
            return pa.record_batch([new.get(c, batch.column(c)) for c in names], names=names)

        rows = map_batches(rows, rows.schema, fn)
        if block + 1 < blocks:
            rows = cut(rows, "decontaminate")  # one automaton in memory at a time
    return rows


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    n: int = WINDOW_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (sorted ids), spans
    (character offsets of the hit runs)."""
    rows = _scanned(id_text(docs, id_col, text_col), items, n, item_col, item_text_col, block_bytes)

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            char_spans(t, [(r["start"], r["end"]) for r in runs]) if runs else []
            for t, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist())
        ]
        keep = ["id", "n_words", "runs", "items"]
        return pa.record_batch([*(batch.column(c) for c in keep), pa.array(spans, SPANS)], names=[*keep, "spans"])

    schema = rows.select("id", "n_words", "runs", "items", F.col("runs").alias("spans")).schema
    hit = F.aggregate("runs", F.lit(0), lambda a, r: a + r["end"] - r["start"]).cast("long")
    return map_batches(rows, schema, finish).select(
        F.col("id").alias(id_col), "n_words", hit.alias("n_hit"), "items", "spans"
    )


def clean(
    docs: DataFrame,
    items: DataFrame,
    n: int = WINDOW_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents without a hit, same columns."""
    rows = _scanned(with_row(docs, id_col, text_col), items, n, item_col, item_text_col, block_bytes)
    return without_row(rows.filter(F.size("runs") == 0), docs, text_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
