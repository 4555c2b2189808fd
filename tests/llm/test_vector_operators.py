"""Vector codes, whitening and language identification against brute force,
with nulls, empty and long values, ties, repeated rows, empty tables and
clashing extra columns."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from indtables.llm import language_id, vector_codes, whitening
from indtables.llm.queries import q_codes, q_languages, q_whitening

NAN, INF = float("nan"), float("inf")
CLASH = ("id", "x", "codes", "error", "n", "w", "of", "text_", "component", "label_error", "letters")


def vectors(spark, rows, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label string")
    return df.withColumns({c: F.lit("extra") for c in CLASH})


def some_rows(n=300, dims=10, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims)) * rng.uniform(0.05, 1.5, dims) + rng.choice([0.0, 0.7], (n, 1))
    rows = [(i, [float(v) for v in x[i]], "hot" if i % 3 else None if i % 2 else str(i % 7)) for i in range(n)]
    rows += [(n + 1, rows[0][1], "hot"), (5, rows[5][1], "hot"), (None, rows[6][1], "hot")]  # repeated vectors and ids
    rows += [(n + 2, None, "hot"), (n + 3, [1.0, None] + [0.0] * (dims - 2), "hot"), (n + 4, [NAN] * dims, "hot"),
             (n + 5, [-INF] + [0.0] * (dims - 1), "hot"), (n + 6, [], "hot"), (n + 7, [1.0] * (dims + 1), "hot"),
             (n + 8, [0.0] * dims, None)]
    return rows


def kept_rows(rows):
    dims = len(rows[0][1])
    good = [r for r in rows if r[1] and len(r[1]) == dims and all(v is not None and math.isfinite(v) for v in r[1])]
    whole = [(r[0], [math.floor(1024 * v) for v in r[1]], r[2]) for r in good]
    return sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def brute_codes(rows, parts, entries, rounds):
    dims = len(rows[0][1])
    cuts = np.cumsum([0, *(len(p) for p in np.array_split(range(dims), parts))]).tolist()
    split = [[tuple(r[1][a:b]) for a, b in zip(cuts, cuts[1:])] for r in rows]
    books = [[s[p] for s in split[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for s in split:
                own[nearest(s[p], books[p])[1]].append(s[p])
            books[p] = [tuple(sum(c) // len(own[i]) for c in zip(*own[i])) if i in own else e for i, e in enumerate(books[p])]
    found = [[nearest(s[p], books[p]) for p in range(parts)] for s in split]
    totals = defaultdict(int)
    for r, f in zip(rows, found):
        totals[r[2]] += sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted((str(r[0]), "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f), totals[r[2]], sha)
                  for r, f in zip(rows, found))


@pytest.mark.parametrize("dims, entries, remembered, hot", [(10, 16, 1 << 16, 1000), (8, 256, 4, 2), (3, 16, 1 << 16, 1000)])
def test_codes(spark, monkeypatch, dims, entries, remembered, hot):
    monkeypatch.setattr(vector_codes, "REMEMBERED", remembered)
    monkeypatch.setattr(vector_codes, "HOT_SHARE", hot)  # also labels that are joined rather than broadcast
    rows = some_rows(dims=dims)
    got = vector_codes.digest(vector_codes.product_codes(vectors(spark, rows), entries=entries, rounds=3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_codes(kept_rows(rows), 4, entries, 3)


def test_codes_ties_and_small_tables(spark):
    # two equal entries: the lower index; fewer rows than entries; floors of negative means
    rows = [(1, [0.5, -0.25], "a"), (2, [0.5, -0.25], "a"), (3, [-0.001, 0.0], None), (4, [-0.002, 0.0], None)]
    got = vector_codes.digest(vector_codes.product_codes(vectors(spark, rows, "float"), parts=2, entries=3, rounds=2))
    rows = [(i, [float(np.float32(v)) for v in x], g) for i, x, g in rows]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_codes(kept_rows(rows), 2, 3, 2)
    nothing = vectors(spark, [(1, None, "a"), (2, [NAN], "a")])
    assert vector_codes.product_codes(nothing).collect() == []
    assert vector_codes.digest(vector_codes.product_codes(nothing.limit(0))).columns[1] == "code"
    with pytest.raises(Exception, match="not supported"):
        vector_codes.product_codes(vectors(spark, [(1, [1e9], "a")])).collect()


def test_cells_keep_the_nearest():
    """Whatever the grid, the candidates of a cell decide as all entries do; some are dominated."""
    rng = np.random.default_rng(5)
    entries = rng.integers(-600, 600, (64, 6))
    x = np.concatenate((rng.integers(-650, 650, (3000, 6)), entries + rng.integers(-20, 20, entries.shape)))
    far = ((x[:, None] - entries[None]) ** 2).sum(-1)
    for shift, levels in ((10, 2), (8, 6), (5, 41)):
        index = vector_codes.CellIndex(entries, vector_codes.Grid(-650, shift, levels))
        place, distance = index.nearest(x)
        assert (place == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
        before = index.hits
        index.nearest(x)
        assert index.hits > before  # remembered
    _, kept = index.candidates(x)
    assert np.mean([len(k) for k in kept]) < 32


def test_codes_of_a_real_table(spark):
    root = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in q_codes(spark, root).collect())
    table = spark.read.parquet(f"{root}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.floor(1024 * np.stack(table.embedding.values).astype(float)).astype(np.int64)
    books = np.split(x[:256], 4, axis=1)

    def nearest(p, book):
        far = ((p[:, None] - book[None]) ** 2).sum(-1)
        return far.argmin(axis=1), far.min(axis=1)

    parts = np.split(x, 4, axis=1)
    for _ in range(4):
        for k, p in enumerate(parts):
            at, _far = nearest(p, books[k])
            books[k] = np.stack([p[at == i].sum(axis=0) // (at == i).sum() if (at == i).any() else e for i, e in enumerate(books[k])])
    found = [nearest(p, b) for p, b in zip(parts, books)]
    error = sum(f[1] for f in found)
    sums = {label: int(error[table.label == label].sum()) for label in set(table.label)}
    sha = hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()
    assert got == [(int(v), "".join(f"{f[0][i]:02x}" for f in found), int(error[i]), sums[g], sha)
                   for i, (v, g) in enumerate(zip(table.vec_id, table.label))]


def brute_whitening(rows, k):
    x = np.array([r[1] for r in rows], np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return dev, centred @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


@pytest.mark.parametrize("dims", [10, 3])
def test_whitening(spark, dims):
    rows = some_rows(dims=dims)
    out = whitening.whiten(vectors(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    want = kept_rows(rows)
    k = min(8, dims)
    dev, w, share = brute_whitening(want, k)
    got = defaultdict(list)
    for r in out.collect():
        got[r["component"]].append(r)
    assert sorted(got) == list(range(1, k + 1))
    for c in got:
        rows_ = sorted(got[c], key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0))
        assert [int(r["deviation"]) for r in rows_] == dev and {r["n"] for r in rows_} == {len(want)}
        assert np.allclose(np.abs([r["whitened"] for r in rows_]), np.abs(w[:, c - 1]), atol=1e-8)
        assert abs(rows_[0]["explained"] - share[c - 1]) < 1e-12 and rows_[0]["identity_error"] < 1e-9


def test_whitening_of_flat_and_empty_tables(spark):
    def n(rows):
        return whitening.whiten(vectors(spark, rows)).count()

    assert n([(1, [0.5, 0.25], "a")]) == n([(1, [0.5, 0.25], "a"), (2, [0.5, 0.25], "a")]) == 0
    assert n([(1, None, "a"), (2, [], "a")]) == 0 and whitening.whiten(vectors(spark, some_rows()).limit(0)).count() == 0
    # one direction with variance: one component
    line = whitening.whiten(vectors(spark, [(i, [i / 64, i / 32, 0.0], "a") for i in range(9)])).collect()
    assert len(line) == 9 and {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12


def test_spectral_division():
    rng = np.random.default_rng(0)
    cases = [np.r_[rng.uniform(0, 9, 40)], np.r_[np.full(20, 3.0), np.full(12, 1.0)], np.r_[1e8, 1e3, 1.0, 1e-3, np.zeros(6)],
             np.full(9, 2.0), np.r_[2.0, 2 + 1e-9, 2 + 2e-9, rng.uniform(0, 1, 20)], np.zeros(4), np.array([7.0])]
    for e in cases:
        q, _ = np.linalg.qr(rng.standard_normal((len(e), len(e))))
        v = (q * e) @ q.T
        values, basis = whitening.top_components((v + v.T) / 2, 8)
        scale = max(e.max(), 1e-300)
        want = np.sort(e)[::-1][: len(values)]
        assert len(values) == min(8, len(e)) and np.abs(values - want).max() <= 1e-12 * scale
        assert np.abs(basis.T @ basis - np.eye(len(values))).max() < 1e-12
        assert np.abs(v @ basis - basis * values).max() <= 1e-11 * scale
    for n in (1, 2, 17, 50):
        a = rng.standard_normal((n, n))
        a = a + a.T
        u = whitening.polar(a)
        e, q = np.linalg.eigh(a)
        assert np.abs(u - (q * np.sign(e)) @ q.T).max() < 1e-10


def test_exact_moments():
    rng = np.random.default_rng(1)
    x = rng.integers(-(1 << 27), 1 << 27, (500, 5))
    assert (whitening.products(x) == x.T @ x).all()
    sums = x.sum(axis=0).tolist()
    for n in (500, 10**9, 10**14):
        want = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
        assert whitening.deviations(x, n, sums) == want


def test_whitening_query(spark):
    got = q_whitening(spark, "/root/testdata/sf0.001")
    assert got.schema["deviation"].dataType.simpleString() == "bigint"
    assert got.filter("deviation is null or identity_error > 1e-4").count() == 0


WORDS = {"aa": ["lorem", "dolor", "sit", "amet"], "bb": ["çalış", "güneş", "yıldız", "ağaç"], "cc": ["日本", "語の", "文章", "です"]}


def language_docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit("extra") for c in ("id", "held_out", "score", "lang_pred", "letters", "row")})


def language_rows(seed=3, n=120):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(sorted(WORDS))
        rows.append((i, " ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randint(1, 40))), lang))
    rows += [(n, None, "aa"), (n + 1, "", "aa"), (n + 2, "12 34 !?", "bb"), (n + 3, "lorem sit", None), (None, "amet dolor", "zz"),
             (3, rows[3][1], rows[3][2]), (3, "dolor amet", "aa"), (n + 4, "x", "aa")]
    return rows


def brute_lengths(rows, languages, order=4):
    """Code lengths by the definition, byte by byte."""
    seen = {one: defaultdict(lambda: defaultdict(int)) for one in languages}
    for i, text, lang in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 4 != 2 and lang is not None and text:
            b = b"\0" * order + text.encode()
            for p in range(order, len(b)):
                for k in range(order + 1):
                    seen[lang][b[p - k : p]][b[p]] += 1

    def bits(text, lang):
        b, out = b"\0" * order + text.encode(), 0.0
        for p in range(order, len(b)):
            for k in range(order, -1, -1):
                own = seen[lang].get(b[p - k : p])
                if not own:
                    continue
                t, d = sum(own.values()), len(own)
                if b[p] in own:
                    out -= math.log2(own[b[p]] / (t + d))
                    break
                out -= math.log2(d / (t + d))
            else:
                out += 8
        return out

    return lambda text: [bits(text, one) for one in languages]


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_languages(spark, monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE_BYTES", piece)
    rows = language_rows()
    model = language_id.learn(language_docs(spark, rows))
    learned = sorted({r[2] for r in rows if r[2] and r[1] and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2})
    assert model.languages == learned  # not zz: its only row has no id
    lengths = brute_lengths(rows, learned)
    texts = [r[1] for r in rows if r[1]]
    assert np.allclose(model.lengths(texts), [lengths(t) for t in texts], atol=1e-6)
    out = language_id.languages(language_docs(spark, rows))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    want = []
    for i, text, _ in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        if text and any(c.isalpha() for c in text):
            bits = lengths(text)
            low = min(bits)
            want.append((str(i), held, learned[bits.index(low)], round(1 / sum(2 ** -(b - low) for b in bits), 6)))
        else:
            want.append((str(i), held, "und", 0.0))
    assert sorted((str(r[0]), r[1], r[2], round(r[3], 6)) for r in out.collect()) == sorted(want)


def test_languages_without_labels(spark):
    rows = [(i, "some text", None) for i in range(8)]
    got = language_id.languages(language_docs(spark, rows)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)} and len(got) == 8
    assert language_id.languages(language_docs(spark, rows).limit(0)).count() == 0


def test_language_ties(spark):
    """The same text under two names: the first name, score one half."""
    rows = [(i, "one two three", lang) for i in range(40) for lang in ("b", "a")]
    got = language_id.languages(language_docs(spark, rows)).collect()
    assert {(r["lang_pred"], round(r["score"], 9)) for r in got} == {("a", 0.5)}


def test_bounded_trees(spark, monkeypatch):
    """Fewer n-grams than there are: still a code (probabilities add up to at most
    one) that tells the languages apart, and within the bound."""
    monkeypatch.setattr(language_id, "MAX_CELLS", 90)
    rows = language_rows()
    model = language_id.learn(language_docs(spark, rows))
    assert all(c.shape[0] * (c.shape[1] - 1) <= 90 for c in model.costs)
    for context in (b"lore", b"\0\0\0\0", "日".encode() + b" "):
        high = int.from_bytes(context, "big") << 8
        bits = model._cost(4, high + np.arange(256))
        assert (np.exp2(-bits).sum(axis=1) <= 1 + 1e-9).all()
    full = language_id.languages(language_docs(spark, rows), model=model)
    right = full.join(language_docs(spark, rows[:120]).select("doc_id", "lang").distinct(), "doc_id")
    assert right.filter("lang_pred = lang").count() >= 0.8 * right.count()


def test_languages_held_out(spark):
    """Held-out accuracy on a table of the driver's; deterministic."""
    root = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "lang", "text")
    got = q_languages(spark, root)
    own = got.join(docs, "doc_id").filter("held_out and text rlike '\\\\p{L}'")
    assert own.filter("lang = lang_pred").count() >= 0.95 * own.count() > 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, q_languages(spark, root).collect()))
