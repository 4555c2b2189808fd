"""Token counts by overlap resynchronisation.

A huge text is encoded in chunks that overlap. Each chunk's encoding keeps,
with offsets, its stretches between ASCII white space and their token counts.
White space is where the encoding is proven to restart: the vocabulary's
pre-tokens never hold any, its normaliser works on each side alone, and added
tokens hold none. Two neighbouring chunks are spliced at the first stretch of
their overlap that both hold whole with the same offsets and count. Where the
overlap has none (a long run without white space) it is widened, in the end to
the whole left chunk, which makes the two one chunk.

A stretch's count comes from the tokenizers library; each Python worker
remembers the counts of stretches it has met (bounded). Documents are
independent, so nothing is shuffled; the vocabulary text is broadcast after a
size check.

Defined results: a null text counts as the empty one (0 bytes, 0 tokens);
repeated rows each give a row; an empty table gives none; other columns are
ignored; texts of any length are counted whole."""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from indtables.llm.bpe import broadcast_file
from indtables.llm.common import id_text, map_batches

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
REMEMBERED = 600_000
STRETCH = re.compile(r"[^ \t-\r]+")


# The steps before the merges for which white space parts a text into
# stretches that are counted alone, as the vocabulary file spells them.
NORMALIZER = [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


def check_vocabulary(spec: str) -> None:
    """An error unless stretches between ASCII white space can be counted alone:
    white space is removed before the merges, and no step looks across it."""
    j = json.loads(spec)
    steps = (j["normalizer"] or {}).get("normalizers") or []
    before = (j["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    split = before[0]
    known = (
        [(n["type"], n.get("pattern"), n.get("content")) for n in steps] == NORMALIZER
        and split.get("type") == "Split" and split.get("pattern") == SPLIT
        and split.get("behavior") == "Removed" and split.get("invert") is True
        and [p["type"] for p in before[1:]] == ["ByteLevel"] and not before[1]["add_prefix_space"]
        and not any(set(t["content"]) & set(" \t\n\v\f\r") or t["lstrip"] or t["rstrip"] for t in j["added_tokens"])
    )
    if not known:
        raise ValueError("this vocabulary keeps or joins white space: its stretches cannot be counted alone")


class Counter:
    """Counts of stretches, and of texts by chunks."""

    def __init__(self, spec: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        from tokenizers import Tokenizer

        check_vocabulary(spec)
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if not 0 < overlap < chunk:
            raise ValueError("the overlap must be shorter than a chunk")
        self.chunk, self.overlap = chunk, overlap
        self.known: dict[bytes, int] = {}
        self.widened = 0

    def lookup(self, stretches: set[bytes]) -> dict[bytes, int]:
        """Counts that hold at least these stretches."""
        new = [s for s in stretches if s not in self.known]
        if not new:
            return self.known
        found = self.tokenizer.encode_batch_fast([s.decode() for s in new], add_special_tokens=False)
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {s: self.known[s] for s in stretches if s in self.known}
        self.known.update(zip(new, map(len, found)))
        return self.known

    def counts(self, stretches: list[bytes]) -> list[int]:
        return list(map(self.lookup(set(stretches)).__getitem__, stretches))

    def encode(self, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
        """(start, end, tokens) of the stretches of one chunk."""
        spans = [(start + m.start(), start + m.end()) for m in STRETCH.finditer(text[start:end])]
        return [(a, b, n) for (a, b), n in zip(spans, self.counts([text[a:b].encode() for a, b in spans]))]

    def count(self, text: str) -> int:
        """Tokens of a whole text, by chunks."""
        left, done = 0, 0
        end = min(self.chunk, len(text))
        held = self.encode(text, left, end)
        while end < len(text):
            overlap = self.overlap
            while True:
                start = max(end - overlap, left)
                stop = min(start + max(self.chunk, 2 * overlap), len(text))
                right = self.encode(text, start, stop)
                if start == left:
                    held = right  # one chunk with the left one
                    break
                # whole in both: opened and closed by white space inside the chunk
                whole = {s for s in held if s[0] > start and s[1] < end}
                at = next((s[0] for s in right if s in whole and s[0] > start and s[1] < stop), None)
                if at is not None:
                    done += sum(n for a, _, n in held if a < at)
                    held = [s for s in right if s[0] >= at]
                    left = at
                    break
                overlap *= 2
                self.widened += 1
            end = stop
        return done + sum(n for _, _, n in held)

    def batch(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """(bytes, tokens) of each text."""
        raw = [(t or "").encode() for t in texts]
        short = [b.split() if len(b) <= self.chunk else [] for b in raw]  # one chunk each
        known = self.lookup(set().union(*short))
        tokens = [sum(map(known.__getitem__, s)) for s in short]
        for i, b in enumerate(raw):
            if len(b) > self.chunk:
                tokens[i] = self.count(texts[i])
        return [len(b) for b in raw], tokens


_counters: dict[tuple, Counter] = {}


def token_counts(
    docs: DataFrame,
    vocab_path: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row."""
    spec = broadcast_file(docs.sparkSession, vocab_path)
    check_vocabulary(spec.value)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        key = (hashlib.sha1(spec.value.encode()).hexdigest(), chunk, overlap)
        if key not in _counters:
            _counters[key] = Counter(spec.value, chunk, overlap)
        n_bytes, tokens = _counters[key].batch(batch.column("text").to_pylist())
        return pa.record_batch(
            [batch.column("id"), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64()),
             pa.array([n > limit for n in tokens], pa.bool_())],
            names=[id_col, "n_bytes", "n_tokens", "over_limit"],
        )

    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean", fn)
