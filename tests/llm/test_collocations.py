"""Collocations against a plain version, and the tile counts against a counter."""

import random
import re
from collections import Counter

import numpy as np

from pitchstar.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, word string, slice long, n long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest=5, within=100, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    key = (lang, tuple(w[i:i + m]))
                    f[key] = f.get(key, 0) + 1
    big = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    held = {}
    for (lang, g), v in big.items():
        for s in range(2, len(g)):
            for i in range(len(g) - s + 1):
                held[lang, g[i:i + s]] = max(held.get((lang, g[i:i + s]), 0), v)
    out = []
    for (lang, g), a in big.items():
        if 100 * held.get((lang, g), -1) >= within * a:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        out.append((lang, -score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]], n[lang]))
    rank, rows = Counter(), []
    for lang, s, a, p, left, right, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], p.decode(), -a, left, right, total, -s))
    return rows


def corpus():
    rnd = random.Random(2)
    words = ["The", "of", "É", "x1", "a", "日本", "b'", " ", "_", "zz"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ", ", ".\n", "\x0b", " "]) for _ in range(n))
    rows = [(text(rnd.randint(1, 60)), rnd.choice(["en", "en", "de", None, "und", ""])) for _ in range(120)]
    rows += [(None, "en"), ("", "en"), (" .,;\n", None), ("a a a a a a a a a", "fr"), ("new york city hall park " * 30, "en"), (text(4000), "de")]
    return rows + [rows[0]] * 8 + [("One two three four five six", "en")] * 9


def test_against_a_plain_version(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, lang, "w", 1, 2) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    for least, within, top in ((6, 100, 2000), (4, 70, 15)):
        got = C.collocations(df, least=least, within=within, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = plain(rows, least, within=within, top=top)
        assert len(want) > 30
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_empty(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert C.collocations(spark.createDataFrame([(1, None, None, "w", 1, 2)], SCHEMA), least=1).count() == 0


def test_products_beyond_64_bits(spark):
    # f and n as after a large corpus: the score keeps every digit
    row = spark.range(1).selectExpr("(cast(1000 as decimal(4,0)) * cast(900000000001 as decimal(15,0)) * cast(90000000000007 as decimal(17,0)))"
                                    " div (cast(900000000003 as decimal(19,0)) * cast(900000000007 as decimal(19,0))) AS s").first()
    assert row.s == 1000 * 900000000001 * 90000000000007 // (900000000003 * 900000000007)


def test_tiles_count_every_pair(monkeypatch):
    rnd = np.random.default_rng(4)
    for tile, top in ((2, 9), (4, 40), (256, 3000), (256, 30)):
        monkeypatch.setattr(C, "TILE", tile), monkeypatch.setattr(C, "DENSE", tile * tile // 4)
        stream = np.minimum(rnd.geometric(0.02, 30000), top) * (rnd.random(30000) < 0.9) * 7
        x, y, n = C.count_pairs(stream.astype(np.int64))
        want = Counter((a, b) for a, b in zip(stream[:-1].tolist(), stream[1:].tolist()) if a and b)
        assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == want
    assert [len(v) for v in C.count_pairs(np.zeros(0, np.int64))] == [0, 0, 0]
    assert C.tight(np.array([5, 0, 1, 2, 0, 0, 3, 4, 9, 0, 8])).tolist() == [1, 2, 0, 3, 4, 9, 0]


def test_a_filter_that_lets_rare_pairs_through(spark, monkeypatch):
    monkeypatch.setattr(C, "BITS", 4), monkeypatch.setattr(C, "PARTS", 2)
    rows = corpus()
    df = spark.createDataFrame([(i, t, lang, "w", 1, 2) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(5)
    assert sorted(map(tuple, C.collocations(df, least=6).collect())) == sorted(plain(rows, 6))


def test_ranks_follow_the_pairs():
    stream = np.array([3, 1, 2, 0, 1, 2, 1, 2, 0, 3, 1])
    assert C.ranked(stream, np.array([1, 3]), np.array([2, 1])).tolist() == [2, 1, 0, 0, 1, 0, 1, 0, 0, 2]
    ids = np.array([[5, 7], [7, 5], [5, 7]])
    at = C.buckets(ids, 20)
    assert at[0] == at[2] != at[1] and 0 <= at.min() <= at.max() < 1 << 20
