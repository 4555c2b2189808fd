"""Operators on texts against brute force or the libraries, with nulls, empty
and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import pathlib
import random
import re

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from indtables.llm import bpe, decontaminate, license_scan, quality, simhash, suffix_dedup, token_counts
from indtables.session import ensure_checkpoint_dir

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    (1, "Plain words, and  two spaces.\n\n\tTabs é ñ 日本 12 345's <|endoftext|> end"),
    (2, None), (3, ""), (4, " \n "), (5, "word " * 9000), (6, "x" * 40000), (None, "no id"),
    (1, "Plain words again"), (1, "Plain words again"), (7, "a\u0301 \u00a0 \x1c \x01 it's We'LL"),
]


def docs(spark, rows=TEXTS):
    """Documents with extra columns named like the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("extra") for c in ("id", "n_tokens", "row", "kept", "fp", "component", "n_words")})


def empty(spark):
    return docs(spark).limit(0)


def rows(df, key=lambda r: tuple(str(x) for x in r)):
    return sorted((tuple(r) for r in df.collect()), key=key)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_bpe_round_trip(spark):
    t = Tokenizer.from_file(BYTE)
    want = []
    for i, text in TEXTS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(decoded.encode())))
    key = lambda r: tuple(str(x) for x in r)
    assert rows(bpe.round_trip(docs(spark), BYTE)) == sorted(want, key=key)
    encoded = bpe.encode(docs(spark), BYTE)
    texts = rows(bpe.decode(encoded, BYTE))
    assert texts == sorted(((i, x or "") for i, x in TEXTS), key=key)
    assert bpe.round_trip(empty(spark), BYTE).count() == bpe.encode(empty(spark), BYTE).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), BYTE).first()["text"] == ""


def test_bpe_random_texts():
    own, t = bpe.Codec(open(BYTE, encoding="utf-8").read()), Tokenizer.from_file(BYTE)
    rnd = random.Random(5)
    parts = [" ", "  ", "\n", "a", "Be", "é", "1", "²", "'", "'s", "!", "\x85", "日", "<|endoftext|>", "\u0301", "the"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        ids = own.encode(text)
        assert ids == t.encode(text, add_special_tokens=False).ids, repr(text)
        assert own.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_token_counts(spark):
    t = Tokenizer.from_file(WORD)
    want = []
    for i, text in TEXTS:
        n = len(t.encode(text or "", add_special_tokens=False))
        want.append((i, len((text or "").encode()), n, n > 2048))
    key = lambda r: tuple(str(x) for x in r)
    assert rows(token_counts.token_counts(docs(spark), WORD)) == sorted(want, key=key)
    assert rows(token_counts.token_counts(docs(spark), WORD, chunk=64, overlap=8)) == sorted(want, key=key)
    assert token_counts.token_counts(empty(spark), WORD).count() == 0
    with pytest.raises(ValueError, match="counted alone"):
        token_counts.token_counts(docs(spark), BYTE)


def test_token_chunks_widen():
    own, t = token_counts.Counter(open(WORD, encoding="utf-8").read(), chunk=30, overlap=4), Tokenizer.from_file(WORD)
    rnd = random.Random(6)
    for _ in range(500):
        text = "".join(rnd.choice([" ", "\n", "a", "Bc", "é", "1", "'s", "<|endoftext|>", "\u0301", "\xa0"])
                       for _ in range(rnd.randint(0, 150)))
        assert own.count(text) == len(t.encode(text, add_special_tokens=False)), repr(text)
    assert own.widened > 0


def brute_hits(texts, items, n):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))

    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item) if item is not None else "null")
    out = []
    for i, text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if ids := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= ids
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return sorted(out, key=lambda r: tuple(str(x) for x in r))


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination(spark, block_bytes):
    rnd = random.Random(7)
    vocabulary = ["a", "B", "é", "12", "cd"]
    say = lambda n: " ".join(rnd.choice(vocabulary) + rnd.choice(["", ",", "!", "-"]) for _ in range(n))
    items = [(10, say(6)), (9, say(9)), (None, say(5)), (9, say(4)), (11, "a b"), (12, ""), (13, None), (14, "!?")]
    texts = TEXTS + [(100 + i, say(rnd.randint(0, 60))) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit(1))
    found = decontaminate.contaminated(docs(spark, texts), bench, n=4, block_bytes=block_bytes)
    assert rows(decontaminate.digest(found)) == brute_hits(texts, items, 4)
    hits = {r["doc_id"]: r for r in found.filter("doc_id >= 100").collect()}
    for i, text in texts[len(TEXTS):]:
        cut = [text[s["start"] : s["end"]] for s in hits[i]["spans"]]
        assert sum(len(decontaminate.words(c)) for c in cut) == hits[i]["n_hit"]
    clean = decontaminate.clean(docs(spark, texts), bench, n=4, block_bytes=block_bytes)
    assert clean.columns == docs(spark).columns
    assert clean.count() == found.filter("n_hit = 0").count()
    assert decontaminate.contaminated(docs(spark, texts), bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.contaminated(empty(spark), bench).count() == 0


def brute_simhash(texts, n, k):
    def fp(text):
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        parts = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fps = [fp(t) for _, t in texts]
    return fps, components(len(fps), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= k)


def components(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(a) for a in range(n)]


def test_simhash(spark):
    rnd = random.Random(8)
    base = [" ".join(rnd.choice("abcdefghij") * 2 for _ in range(300)) for _ in range(4)]
    texts = list(TEXTS)
    for i in range(60):
        w = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = "zz"
        texts.append((200 + i, " ".join(w)))
    fps, group = brute_simhash(texts, 3, 2)
    low = {}
    for (i, _), g in zip(texts, group):
        if i is not None:
            low[g] = min(i, low.get(g, i))
    want = sorted(((i, "%016x" % f, low.get(g)) for (i, _), f, g in zip(texts, fps, group)), key=lambda r: tuple(map(str, r)))
    assert rows(simhash.near_duplicates(docs(spark, texts))) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_simhash_links_of_a_crowded_cell(spark, monkeypatch):
    """Cells are dealt again down to the last level; no link is lost."""
    rnd = random.Random(9)
    monkeypatch.setattr(simhash, "CELL", 4)
    centre, fps = rnd.getrandbits(64), set()
    for _ in range(250):
        fps.add(centre ^ sum({1 << rnd.randrange(64) for _ in range(rnd.randint(0, 3))}))
    fps = [simhash._signed(f) for f in fps]
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2)
    want = {(min(a, b), max(a, b)) for a in fps for b in fps if a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    assert {tuple(r) for r in found.collect()} == want


def brute_spans(texts, width):
    raw = [(i if i is not None else 1 << 62, (t or "").encode()) for i, t in texts]
    low = {}
    for i, b in raw:
        for p in range(len(b) - width + 1):
            low[b[p : p + width]] = min(i, low.get(b[p : p + width], i))
    out = []
    for (i, _), (k, b) in zip(texts, raw):
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if low[b[p : p + width]] < k:
                gone[p : p + width] = b"\1" * width
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, sha(kept)))
    return sorted(out, key=lambda r: tuple(str(x) for x in r))


@pytest.mark.parametrize("width, hot", [(12, 64), (12, 1), (50, 64)])
def test_suffix_dedup(spark, width, hot):
    rnd = random.Random(10)
    base = ["".join(rnd.choice("ab ") for _ in range(60)) for _ in range(6)] + ["x" * 70, "é日" * 30]
    texts = TEXTS + [(i // 2 if rnd.random() < 0.1 else i, "".join(
        rnd.choice(base)[rnd.randint(0, 9) : rnd.randint(10, 70)] for _ in range(rnd.randint(0, 8)))) for i in range(120)]
    df = docs(spark, texts).repartition(4)
    found = suffix_dedup.duplicate_spans(df, width=width, chunk_bytes=3000, bin_bytes=2000, hot_chunks=hot, with_kept=True)
    assert rows(suffix_dedup.digest(found)) == brute_spans(texts, width)
    assert all(sha(r["kept"]) == r["kept_sha256"] for r in found.collect())
    assert suffix_dedup.duplicate_spans(empty(spark)).count() == 0
    if hot == suffix_dedup.HOT_CHUNKS:
        return
    # ids that are no numbers: in their own order
    named = docs(spark, [(None if i is None else i + 10**6, t) for i, t in texts]).withColumn(
        "doc_id", F.concat(F.lit("d-"), F.col("doc_id")))
    got = suffix_dedup.digest(suffix_dedup.duplicate_spans(named, width=width, chunk_bytes=3000, bin_bytes=2000))
    want = [(None if r[0] is None else f"d-{r[0] + 10**6}", *r[1:]) for r in brute_spans(texts, width)]
    assert got.schema["doc_id"].dataType.simpleString() == "string"
    assert rows(got) == sorted(want, key=lambda r: tuple(str(x) for x in r))


@pytest.mark.parametrize("hot_bytes", [suffix_dedup.HOT_BYTES, 300])
def test_suffix_dedup_bounds_what_a_chunk_sends(spark, hot_bytes):
    """A chunk sends a bounded number of rows, however many bins there are, and a
    passage that many chunks hold is not sent string by string while it is small."""
    rnd = random.Random(12)
    boilerplate = "all rights reserved by the authors"
    texts = [(i, "".join(rnd.choice("abcdefghijklmnop") for _ in range(1500)) + boilerplate[i % 3 :]
              + "".join(rnd.choice("abcdefghijklmnop") for _ in range(1500))) for i in range(270)]
    folder = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "llm"
    old = set(folder.glob("suffix-answers-*"))
    found = suffix_dedup.duplicate_spans(docs(spark, texts).repartition(4), width=12, chunk_bytes=3000, bin_bytes=400,
                                         hot_bytes=hot_bytes)
    (path,) = set(folder.glob("suffix-answers-*")) - old
    answers = [r["answers"] for r in spark.read.parquet(str(path)).collect()]
    assert len(answers) == len(texts)
    assert max(map(len, answers)) <= suffix_dedup.GROUPS
    hot = sum(f & 2 > 0 for a in answers for x in a for f in suffix_dedup.unpack(x["flags"]))
    assert (hot > 0) == (hot_bytes == 300)
    assert rows(suffix_dedup.digest(found)) == brute_spans(texts, 12)


def test_suffix_dedup_smallest_ids():
    """Only fragments of one anchor are compared; the others' strings have their id."""
    import numpy as np

    rnd, width = random.Random(13), 12
    for _ in range(20):
        text = "".join(rnd.choice("ab") for _ in range(60)).encode()
        data = np.frombuffer(text, np.uint8)
        first, last, _, _, spot = suffix_dedup.anchors(data, np.array([0, len(data)]), width)
        known = {text[a : b + width]: s for a, b, s in zip(first.tolist(), last.tolist(), spot.tolist())}
        low = np.array([rnd.randrange(9) for _ in known])
        least = {}
        strings = [(c[i : i + width], x) for c, x in zip(known, low.tolist()) for i in range(len(c) - width + 1)]
        for s, x in strings:
            least[s] = min(x, least.get(s, x))
        n = np.array([len(c) - width + 1 for c in known])
        got = suffix_dedup.smallest_ids(list(known), n, low, np.array(list(known.values())), width)
        assert got.tolist() == [least[s] for s, _ in strings]


def test_induced_sort_spills_and_recurses(tmp_path):
    import numpy as np
    from indtables.llm.induced_sort import common_prefixes, suffix_array

    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 7, 60, 200):
        for letters in (1, 2, 4, 40):
            text = rng.integers(0, letters, n)
            order = suffix_array(text, in_memory=2, memory=5, folder=str(tmp_path), short=2)
            whole = text.tolist()
            assert order.tolist() == sorted(range(n), key=lambda i: whole[i:])
            assert list(tmp_path.iterdir()) == []  # every run was taken off again
            first = [whole[i : i + 3] for i in suffix_array(text, 3, 2, 5, str(tmp_path), 2).tolist()]
            assert first == sorted(first) and len(first) == n
            for k, (a, b) in enumerate(zip(order[:-1].tolist(), order[1:].tolist()), 1):
                same = next((j for j in range(10) if whole[a + j : a + j + 1] != whole[b + j : b + j + 1]
                             or not whole[b + j : b + j + 1]), 10)
                assert common_prefixes(text, order, 10)[k] == same


def test_license_alignment(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    templates = {"grant": mit, "short": "All rights reserved.", "empty": "..."}
    texts = TEXTS + [
        (20, "x y " + mit.upper() + " and then more"),
        (21, mit.replace("hereby", "now").replace("any", "each")),
        (22, " ".join(mit.split()[:8])),
        (23, "All rights reserved. All rights reserved. all, rights (reserved)"),
        (24, mit.replace("free", "quite free indeed")),
    ]
    found = license_scan.licenses(docs(spark, texts), templates)
    got = {}
    for r in found.collect():
        got.setdefault(r["doc_id"], []).append((r["template"], round(r["coverage"], 3), r["start"]))
    assert set(got) == {20, 21, 23, 24}
    assert got[20] == [("grant", 1.0, 4)] and got[21] == [("grant", round(14 / 16, 3), 0)]
    assert [g[:2] for g in got[23]] == [("short", 1.0)] * 3 and got[24][0][1] == 1.0
    assert license_scan.licenses(empty(spark), templates).count() == 0
    assert license_scan.licenses(docs(spark), {}).count() == 0


def test_licenses_are_told_apart():
    scan = license_scan.Scanner(license_scan.TEMPLATES, license_scan.MIN_COVERAGE).scan
    gpl = "This work is licensed under the GNU {}General Public License, version {}."
    cases = {
        "Released under the MIT License.": ["MIT"], "Licensed under the MIT license": ["MIT"],
        "Released under the BSD License.": ["BSD"], "Released under the GPL License.": ["GPL"],
        "Released under the X11 License.": [],
        gpl.format("", "2"): ["GPL-2.0"], gpl.format("", "3"): ["GPL-3.0"],
        gpl.format("Lesser ", "3"): ["LGPL-3.0"], gpl.format("Affero ", "3"): ["AGPL-3.0"],
        gpl.format("Lesser ", "2.1"): ["LGPL-2.1"], gpl.format("", "4"): [],
        gpl.format("", "3").replace("is", "is not"): [], "It was never " + gpl.format("", "3")[13:]: [],
        "This is no longer licensed under the Apache License, Version 2.0.": [],
        "Licensed under the Apache License, Version 2.1.": [],
        "Licensed under the Apache License, Version 2.0.": ["Apache-2.0"],
        "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"], "Licensed under CC BY 4.0.": ["CC-BY-4.0"],
        "Licensed under CC BY-SA 4.0.": ["CC-BY-SA-4.0"], "Some rights reserved.": [],
        "All rights reserved. Released under the MIT License.": ["proprietary", "MIT"],
    }
    for text, want in cases.items():
        assert [f[0] for f in scan(text)] == want, text
        assert [f[0] for f in scan(f"some words, {text} and a few others")] == want, text
    for name, notice in license_scan.TEMPLATES.items():
        assert [(f[0], f[1]) for f in scan(notice.text)] == [(name, 1.0)], name  # the longest explanation, alone


def test_notices_with_words_in_between():
    """Markup or line numbers between all lines, up to as many words as the notice has."""
    scan = license_scan.Scanner(license_scan.TEMPLATES, license_scan.MIN_COVERAGE).scan
    rnd = random.Random(3)
    for name, notice in license_scan.TEMPLATES.items():
        w = notice.text.split()
        if len(w) < 20:
            continue
        for every in (3, 5, 9):
            lines = [" ".join(w[i : i + every]) for i in range(0, len(w), every)]
            text = " ".join(f"<br> {100 + i} {line}" for i, line in enumerate(lines))
            text = " ".join(rnd.choices(["lorem", "ipsum", "dolor"], k=40)) + " " + text + " amet" * 40
            found = [f for f in scan(text) if f[0] == name]
            plain = " ".join(x.decode() for x in license_scan.words(text))
            if all(f" {phrase} " in plain for phrase in notice.required):
                assert len(found) == 1 and found[0][1] >= 0.95, (name, every, scan(text))
            else:  # a line ends within "version 3": left out rather than mistaken
                assert found == []


def test_licenses_against_every_window():
    """Every template aligned at every place of the text: what one of them covers
    whole, or with one word changed, is found."""
    rnd = random.Random(8)
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.MIN_COVERAGE)
    short = [t for t in scanner.templates if len(t) <= 14]
    for _ in range(150):
        parts = []
        for t in rnd.choices(short, k=3):
            w = [x.decode() for x in t.words]
            if rnd.random() < 0.5:
                w[rnd.randrange(len(w))] = rnd.choice(["x", "not", "the", "3", "lesser"])
            parts += w + ["filler"] * rnd.randint(0, 4)
        text = [x.encode() for x in parts]
        every = []
        for t in short:
            for s in range(len(text)):
                pairs = [(s + i, j) for i, j in license_scan.align(text[s : s + len(t)], t.words)]
                if t.fits(text, pairs):
                    every.append((len(pairs), pairs[0][0], pairs[-1][0] + 1, t.name, len(t)))
        got = scanner.scan(" ".join(parts))
        for k, a, b, name, n in license_scan.apart(every):
            assert any(x <= a and b <= y and c * dict((t.name, len(t)) for t in scanner.templates)[m] >= k
                       or a < y and x < b for m, c, x, y in got), (parts, name, got)
        for m, c, x, y in got:  # and nothing else is
            t = next(t for t in scanner.templates if t.name == m)
            assert c >= license_scan.MIN_COVERAGE and all(
                any(text[x:y][i : i + len(p[0])] == t.words[p[0][0] : p[0][-1] + 1] for i in range(y - x)) for p in t.required)


def test_patience_alignment_is_common_and_increasing():
    rnd = random.Random(11)
    for _ in range(300):
        a, b = ([rnd.choice(b"abcdefgh") for _ in range(rnd.randint(0, 14))] for _ in range(2))
        a, b = ([bytes([c]) for c in x] for x in (a, b))
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert license_scan.increasing([3, 1, 2, 0, 5, 4]) == [1, 2, 5]


def corpus(spark, n=400):
    rnd = random.Random(12)
    names = [f"w{i}" for i in range(80)]
    good = lambda: " ".join(rnd.choice(names) for _ in range(60)) + "."
    bad = lambda: " ".join(f"{rnd.choice(names).upper()}!!" for _ in range(60))
    texts = [(i, bad() if i % 5 == 0 else good()) for i in range(n)]
    labels = [(i, 0 if i % 5 == 0 else 1) for i in range(0, n, 2)] + [(3, None), (None, 1)]
    return texts, spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality(spark):
    texts, labels = corpus(spark)
    found = quality.resample(docs(spark, texts + TEXTS), labels)
    by_id = {r["doc_id"]: r for r in found.filter("doc_id >= 10").collect()}
    wrong = [i for i, _ in texts if i >= 10 and by_id[i]["kept"] == (i % 5 == 0)]
    assert len(wrong) <= 2
    assert found.count() == len(texts) + len(TEXTS)
    none = found.filter("n_ngrams = 0").collect()
    assert none and all(r["log_ratio"] == 0 for r in none)
    kept = quality.kept(docs(spark, texts), labels)
    assert kept.columns == docs(spark).columns
    assert quality.resample(empty(spark), labels).count() == 0
    assert quality.resample(docs(spark, texts), labels.limit(0)).filter("kept").count() == len(texts)


@pytest.mark.parametrize("k", [0, 1, 37, 400, 500])
def test_gumbel_top_k(spark, k):
    texts, labels = corpus(spark)
    found = quality.resample(docs(spark, texts), labels, k=k).collect()
    keys = sorted((r["gumbel_key"] for r in found), reverse=True)
    assert sorted((r["gumbel_key"] for r in found if r["kept"]), reverse=True) == keys[:k]


def test_ngrams_do_not_depend_on_pieces(monkeypatch):
    import numpy as np

    rnd = random.Random(13)
    texts = [" ".join(rnd.choice(["aa", "b", "é!", "...", "x-y"]) for _ in range(rnd.randint(0, 80))) for _ in range(20)]
    texts += ["", "q" * 300, None]

    def counts():
        out = {}
        for row, bucket in quality.features(texts):
            for r, b in zip(row.tolist(), bucket.tolist()):
                out[r, b] = out.get((r, b), 0) + 1
        return out

    whole = counts()
    monkeypatch.setattr(quality, "PIECE_BYTES", 50)
    assert counts() == whole
    words = re.findall(r"[\w]+|[^\w\s]+", texts[0])
    assert sum(n for (r, _), n in whole.items() if r == 0) == max(0, 2 * len(words) - 1)


def test_kth_largest(spark):
    rnd = random.Random(14)
    values = [rnd.choice([rnd.random(), 1e9, -3.0, 0.5]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 100, 299):
        assert quality.kth_largest(df, k, bins=8) == ordered[k - 1]
