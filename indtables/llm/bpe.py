"""Byte-level BPE encoding and decoding.

Every pre-token's symbols form a doubly linked list; a priority queue holds
the merges that are possible, lowest rank first and leftmost first among
equals. An entry whose symbols have since changed is stale and is skipped.
Decoding concatenates the vocabulary's byte strings.

The vocabulary file (tokenizers JSON, a few MB, size-checked) is read once on
the driver and broadcast as text; each Python worker builds the tables once.
Documents are independent, so nothing is shuffled.

Defined results: a null text encodes as the empty text (no ids); an empty text
has no ids; repeated rows each give a row; an empty table gives none; other
columns are ignored. Very long texts are whole: the merge queue works on one
pre-token at a time. The strings of added tokens inside a text become those
tokens, as in the tokenizers library."""

from __future__ import annotations

import hashlib
import heapq
import json
import os

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indtables.llm.common import id_text, map_batches

MAX_VOCAB_BYTES = 64 * 1024 * 1024
# Stretches remembered per worker in each of two generations; those in use
# move on to the younger one.
CACHE_WORDS = 250_000
# Fixed value: the pre-token pattern of the byte-level family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character standing for each byte: itself where it is a
    printable Latin-1 character, else the next free one from U+0100 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


class Codec:
    def __init__(self, spec: str, remembered: int = CACHE_WORDS):
        self.remembered = remembered
        j = json.loads(spec)
        kind = j["pre_tokenizer"] or {}
        if j["model"]["type"] != "BPE" or kind.get("type") != "ByteLevel" or j["normalizer"] is not None:
            raise ValueError("not a plain byte-level BPE vocabulary")
        symbols = byte_symbols()
        of = {c: b for b, c in enumerate(symbols)}
        vocab: dict[str, int] = j["model"]["vocab"]
        added = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.strings: list[bytes] = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for s, i in vocab.items():
            self.strings[i] = bytes(of[c] for c in s)
        for s, i in added.items():
            self.strings[i] = s.encode()
        self.decimal = [str(i) for i in range(len(self.strings))]
        self.first = [vocab[c] for c in symbols]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(j["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.added = added
        longest_first = "|".join(map(regex.escape, sorted(added, key=len, reverse=True)))
        self.specials = regex.compile(f"({longest_first})") if added else None
        self.split = regex.compile(PATTERN)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merge(self, token: bytes) -> list[int]:
        """One pre-token by the merge queue."""
        sym = [self.first[b] for b in token]
        n, merges = len(sym), self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(*m, i, sym[i], sym[i + 1]) for i in range(n - 1) if (m := merges.get((sym[i], sym[i + 1])))]
        queue = [(rank, i, a, b, to) for rank, to, i, a, b in queue]
        heapq.heapify(queue)
        while queue:
            _, i, a, b, to = heapq.heappop(queue)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue  # stale
            sym[i], sym[j], after[i] = to, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if m := merges.get((to, sym[after[j]])):
                    heapq.heappush(queue, (m[0], i, to, sym[after[j]], m[1]))
            if before[i] >= 0 and (m := merges.get((sym[before[i]], to))):
                heapq.heappush(queue, (m[0], before[i], sym[before[i]], to, m[1]))
        return [s for s in sym if s >= 0]

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of a stretch that starts and ends at pre-token boundaries."""
        ids = self.known.get(text)
        if ids is None:
            ids = self.older.get(text)
            if ids is None:
                parts = self.split.findall(text)
                if len(parts) > 1:
                    ids = tuple(i for t in parts for i in self.known.get(t) or self.piece(t))
                else:
                    ids = tuple(self.merge(text.encode()))
            if len(text) <= 64:
                if len(self.known) >= self.remembered:
                    self.older, self.known = self.known, {}
                self.known[text] = ids
        return ids

    def plain(self, text: str, out: list[int]) -> None:
        """A space between two visible characters always opens a pre-token, so
        the text falls into independent pieces there. Where other white space
        touches the space, the pieces stay together."""
        held, piece = "", self.piece
        start = True
        for word in text.split(" "):
            if not start:
                if word and not word[0].isspace() and held and not held[-1].isspace():
                    out += piece(held)
                    held = " " + word
                    continue
                held += " " + word
            else:
                held, start = word, False
        if held:
            out += piece(held)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        if self.specials is None or not any(s in text for s in self.added):
            self.plain(text, out)
            return out
        for part in self.specials.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                self.plain(part, out)
        return out

    def decode(self, ids) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def _codec(spec: str, remembered: int) -> Codec:
    key = f"{hashlib.sha1(spec.encode()).hexdigest()}-{remembered}"
    if key not in _codecs:
        _codecs[key] = Codec(spec, remembered)
    return _codecs[key]


def broadcast_file(spark: SparkSession, path: str):
    """The vocabulary file's text, broadcast once its size is checked."""
    if (size := os.path.getsize(path)) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path} has {size} bytes, over {MAX_VOCAB_BYTES}")
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


class Worker:
    """The codec of one Python worker, built on its first batch."""

    def __init__(self, spec, remembered: int = CACHE_WORDS):
        self.spec, self.remembered, self.codec = spec, remembered, None

    def __getstate__(self):
        return {"spec": self.spec, "remembered": self.remembered, "codec": None}

    def get(self) -> Codec:
        if self.codec is None:
            self.codec = _codec(self.spec.value, self.remembered)
        return self.codec


def encode(
    docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", remembered: int = CACHE_WORDS
) -> DataFrame:
    """(id, ids array<int>) for every row. ``remembered`` trades a worker's
    memory for time."""
    worker = Worker(broadcast_file(docs.sparkSession, vocab_path), remembered)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = worker.get()
        ids = [codec.encode(t) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    rows = id_text(docs, id_col, text_col)
    return map_batches(rows, f"{id_col} {rows.schema['id'].dataType.simpleString()}, ids array<int>", fn, rows=128)


def decode(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) for every row of ids; null ids decode as the empty text."""
    worker = Worker(broadcast_file(encoded.sparkSession, vocab_path))
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = worker.get()
        texts = [codec.decode(i or ()) for i in batch.column("ids").to_pylist()]
        return pa.record_batch([batch.column("id"), pa.array(texts, pa.string())], names=[id_col, "text"])

    return map_batches(rows, f"{id_col} {rows.schema['id'].dataType.simpleString()}, text string", fn, rows=128)


def round_trip(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text and decode the ids again in one pass:
    (id, n_tokens, ids_sha256, decoded_sha256)."""
    worker = Worker(broadcast_file(docs.sparkSession, vocab_path))
    rows = id_text(docs, id_col, text_col)

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = worker.get()
        n, a, b = [], [], []
        for text in batch.column("text").to_pylist():
            ids = codec.encode(text)
            n.append(len(ids))
            a.append(sha(",".join(map(codec.decimal.__getitem__, ids)).encode()))
            b.append(sha(codec.decode(ids).encode()))
        return pa.record_batch(
            [batch.column("id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
            names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", fn)


def text_bytes(col: Column) -> Column:
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")
