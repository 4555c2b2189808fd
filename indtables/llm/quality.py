"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (unigrams and bigrams of words and
punctuation, case kept): one of the target, the documents labelled good, one
of all raw text. A document's log ratio is the sum over its n-grams of
log p_target - log p_raw; its importance is that sum over the square root of
the n-grams' number, the scale of the sum's chance variation, so that long
documents are not judged by their length. Documents are resampled without
replacement by the Gumbel top-k trick: importance plus ``temperature`` times
Gumbel noise drawn from a hash of the id, the k largest stay.

The raw counts and the scores cover every document. The target model and the
calibration use at most ``max_labels`` labelled ids, up to half of them good
and up to half bad, those of the smallest hash, so a rare kind is not crowded
out; of each kind four fifths fit, one fifth calibrates. k defaults to the
number of documents whose importance reaches the calibrated threshold: the
value that best separates good from bad labels (shares kept and rejected, a
good one rejected weighing ``REJECT_COST`` times; the lowest such value). So k
follows the corpus, and the noise decides only near the threshold.

Only the model (``BUCKETS`` numbers, whatever the corpus), the bounded labels
and a few histogram counts reach the driver; texts are never shuffled.

Defined results: null and empty texts have no n-grams and importance 0; a
null quality label is no label, a document with both labels counts as bad;
rows of a repeated id share their noise; rows that tie with the k-th largest
key all stay; an empty table gives none; without good labels every importance
is 0, and without both kinds the threshold is minus infinity (all stay); long
texts are scored whole, in pieces; other columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from indtables.llm.common import cut, id_text, map_batches, with_row, without_row

BUCKETS = 1 << 16
MAX_LABELS = 50_000
SEED = 42
PIECE_BYTES = 1 << 20
# Scale of the Gumbel noise, in units of importance.
TEMPERATURE = 0.02
# A model's number is a whole multiple of 1 / UNIT.
UNIT = float(1 << 20)
# Target occurrences of prior belief, per bucket, that the bucket is as common
# in the target as in raw text: n-grams seen a few times say little.
PRIOR = 5.0
# Rejecting a share of the good labels weighs so many times the same share of
# bad ones kept: clean documents are to stay.
REJECT_COST = 4.0

_CLASS = np.array(
    [1 if chr(b).isalnum() or b == 95 or b > 127 else 0 if b <= 32 else 2 for b in range(256)], dtype=np.uint8
)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers modulo 2^64 and their inverses, up to n."""
    if not _powers or len(_powers[0]) <= n:
        with np.errstate(over="ignore"):
            out = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                steps = np.full(n + 1, base, np.uint64)
                steps[0] = 1
                out.append(np.cumprod(steps, dtype=np.uint64))
        _powers[:] = out
    return _powers[0], _powers[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def pieces(texts: list[str | None]) -> Iterator[list[tuple[int, bytes]]]:
    """The texts in order as lists of (row, bytes) of about ``PIECE_BYTES``;
    longer texts are cut at white space."""
    held, size = [], 0
    for row, text in enumerate(texts):
        raw, at = (text or "").encode(), 0
        while at < len(raw):
            end = at + PIECE_BYTES - size
            if end >= len(raw):
                end = len(raw)
            elif (space := raw.rfind(b" ", at, end)) > at:
                end = space
            elif size == 0:
                end = raw.find(b" ", end) if b" " in raw[end:] else len(raw)
            else:
                end = at
            if end > at:
                held.append((row, raw[at:end]))
                size += end - at + 1
                at = end
            if at < len(raw) or size >= PIECE_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram, piece by piece."""
    last_row, last_hash = -1, np.uint64(0)
    for piece in pieces(texts):
        data = np.frombuffer(b"\n".join(raw for _, raw in piece), np.uint8)
        kind = _CLASS[data]
        new = np.ones(len(kind) + 1, bool)
        new[1:-1] = kind[1:] != kind[:-1]
        edges = np.flatnonzero(new)
        starts, ends = edges[:-1], edges[1:]
        seen = kind[starts] != 0
        starts, ends = starts[seen], ends[seen]
        if not len(starts):
            continue
        up, down = powers(max(len(data), PIECE_BYTES))
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
            word = _mix((total[ends] - total[starts]) * down[starts])
            offsets = np.cumsum([0, *(len(raw) + 1 for _, raw in piece)])
            rows = np.array([r for r, _ in piece])[np.searchsorted(offsets, starts, "right") - 1]
            before = np.concatenate(([last_hash], word[:-1]))
            same = np.concatenate(([last_row], rows[:-1])) == rows
            pair = _mix(before[same] * np.uint64(3) + word[same])
        last_row, last_hash = rows[-1], word[-1]
        shift = np.uint64(64 - int(math.log2(BUCKETS)))
        yield np.concatenate((rows, rows[same])), (np.concatenate((word, pair)) >> shift).astype(np.int64)


def label_sample(labels: DataFrame, max_labels: int, id_col: str, label_col: str) -> DataFrame:
    """(id, good, fold) of at most ``max_labels`` labelled ids, up to half of
    them of each kind; folds are dealt in turn within a kind, so that the
    calibration fold 0 has its share of a rare one too."""
    found = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.min(label_col) >= 1).alias("good"))
        .withColumn("h", F.xxhash64("id", F.lit(SEED)))
    )
    some = [found.filter(c).orderBy("h", "id").limit(max(max_labels // 2, 1)) for c in (F.col("good"), ~F.col("good"))]
    turn = F.row_number().over(Window.partitionBy("good").orderBy("h", "id"))
    return some[0].unionByName(some[1]).select("id", "good", ((turn - 1) % 5).cast("int").alias("fold"))


def ngram_counts(rows: DataFrame, good_ids) -> DataFrame:
    """(bucket, raw, target) over all rows; ``good_ids``: a broadcast set."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                good = np.array([i in good_ids.value for i in part.column("id").to_pylist()], bool)
                for row, bucket in features(part.column("text").to_pylist()):
                    raw += np.bincount(bucket, minlength=BUCKETS)
                    target += np.bincount(bucket[good[row]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(used), pa.array(raw[used]), pa.array(target[used])],
                              names=["bucket", "raw", "target"])

    found = rows.mapInArrow(count, "bucket long, raw long, target long")
    return found.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log p_target - log p_raw of each bucket. The target's count is smoothed
    towards its expected share of the bucket's raw count."""
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():  # at most BUCKETS rows
        target[r["bucket"]], raw[r["bucket"]] = r["target"], r["raw"]
    if not target.sum():
        return np.zeros(BUCKETS)
    share = target.sum() / raw.sum()
    return np.log((target + PRIOR) / (raw * share + PRIOR))


def threshold(scored: DataFrame, sample: DataFrame) -> float:
    """The importance that separates the calibration fold's labels best."""
    held = (
        scored.join(F.broadcast(sample.filter(F.col("fold") == 0)), "id")
        .groupBy("id", "good").agg(F.min("importance").alias("importance"))
        .collect()  # at most max_labels rows
    )
    score = np.array([r["importance"] for r in held])
    good = np.array([r["good"] for r in held], bool)
    if not good.any() or good.all():
        return -math.inf
    order = np.argsort(score, kind="stable")
    score, good = score[order], good[order]
    bad_below = np.concatenate(([0], np.cumsum(~good))) / (~good).sum()
    good_above = 1 - np.concatenate(([0], np.cumsum(good))) / good.sum()
    allowed = np.concatenate(([True], score[1:] != score[:-1], [False]))
    best = int(np.argmax(np.where(allowed, bad_below + REJECT_COST * good_above, -1)))
    if best == 0:
        return -math.inf
    return float((score[best - 1] + score[best]) / 2)


def kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> float:
    """The k-th largest of column ``key``, by histograms that narrow down to
    the one value; every pass is one aggregate over all rows."""
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k <= 0:
        return math.inf
    if k >= n:
        return -math.inf
    while low < high:
        width = (high - low) / bins
        at = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0)
        inside = keys.filter(F.col("key").between(low, high))
        found = sorted(
            (r["at"], r["n"], r["low"], r["high"])
            for r in inside.groupBy(at.cast("long").alias("at"))
            .agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            .collect()  # at most ``bins`` rows
        )
        for _, n, lo, hi in reversed(found):
            if k <= n:
                break
            k -= n
        if (lo, hi) == (low, high):  # as narrow as numbers go: two neighbours
            top = keys.filter(F.col("key") == high).count()
            return high if k <= top else low
        low, high = lo, hi
    return low


def _scored(rows: DataFrame, model, seed: int, temperature: float) -> DataFrame:
    """Adds n_ngrams, log_ratio, importance and key to rows with ``id`` and ``text``. The
    model's numbers are whole (of ``UNIT``), so sums do not depend on order."""

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for row, bucket in features(batch.column("text").to_pylist()):
            total += np.bincount(row, weights=model.value[bucket], minlength=batch.num_rows)
            n += np.bincount(row, minlength=batch.num_rows)
        keep = [c for c in batch.schema.names if c != "text" or "row" in batch.schema.names]
        return pa.record_batch([*(batch.column(c) for c in keep), pa.array(n), pa.array(total / UNIT)],
                               names=[*keep, "n_ngrams", "log_ratio"])

    carried = rows if "row" in rows.columns else rows.drop("text")
    schema = StructType(list(carried.schema.fields)).add("n_ngrams", "long").add("log_ratio", "double")
    uniform = (F.pmod(F.xxhash64("id", F.lit(seed), F.lit("gumbel")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    importance = F.col("log_ratio") / F.sqrt(F.greatest(F.col("n_ngrams"), F.lit(1)))
    noise = -F.log(-F.log(uniform)) * temperature
    return map_batches(rows, schema, score).withColumn("importance", importance).withColumn(
        "key", F.col("importance") + noise
    )


def _fit(docs, labels, k, id_col, text_col, label_col, max_labels, seed, temperature):
    """(model, scored, cutoff key)."""
    sc = docs.sparkSession.sparkContext
    rows = id_text(docs, id_col, text_col)
    sample = cut(label_sample(labels, max_labels, id_col, label_col), "quality-labels")
    # bounded by max_labels
    good = {r["id"] for r in sample.filter(F.col("good") & (F.col("fold") != 0)).select("id").collect()}
    ratios = log_ratios(ngram_counts(rows, sc.broadcast(good)))
    model = sc.broadcast(np.rint(ratios * UNIT))
    scored = cut(_scored(rows, model, seed, temperature), "quality-scores")
    if k is None:
        k = scored.filter(F.col("importance") >= threshold(scored, sample)).count()
    return model, scored, kth_largest(scored, k)


def resample(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labels: int = MAX_LABELS,
    seed: int = SEED,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """(id, n_ngrams, log_ratio, importance, gumbel_key, kept) for every row."""
    _, scored, cutoff = _fit(docs, labels, k, id_col, text_col, label_col, max_labels, seed, temperature)
    return scored.select(
        F.col("id").alias(id_col), "n_ngrams", "log_ratio", "importance", F.col("key").alias("gumbel_key"),
        (F.col("key") >= F.lit(cutoff)).alias("kept"),
    )


def kept(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labels: int = MAX_LABELS,
    seed: int = SEED,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """The documents that ``resample`` keeps, same columns. They are scored
    once more on the way, which is cheaper than a shuffle of all texts."""
    model, _, cutoff = _fit(docs, labels, k, id_col, text_col, label_col, max_labels, seed, temperature)
    rows = _scored(with_row(docs, id_col, text_col), model, seed, temperature)
    return without_row(rows.filter(F.col("key") >= F.lit(cutoff)), docs, text_col)
