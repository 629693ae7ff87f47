"""Lattice scores against all segmentations written out, and whole scores
against a plain version."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchstar.llm import lm_scoring as L

SCHEMA = "doc_id long, text string, lang string, slice long, code int, word string, learned string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PIECES = ([(bytes([b]), False, True) for b in range(256)]
          + [(p, True, False) for p in (b"", b"a", b"ab", "é".encode(), b"abab")] + [(p, False, False) for p in (b"a", b"b", b"ab", b"bab", "é".encode(), "日a".encode())])


def segmentations(word, pieces):
    """Every way to spell ``word``: lists of piece numbers."""
    def rest(at):
        if at == len(word):
            yield []
        for k, (p, start, _) in enumerate(pieces):
            if not start and p and word.startswith(p, at):
                yield from ([k] + more for more in rest(at + len(p)))
    return [[k] + more for k, (p, start, _) in enumerate(pieces) if start and word.startswith(p) for more in rest(len(p))]


def buffers(words):
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum([0] + [len(w) for w in words])


@pytest.fixture(scope="module")
def model():
    return L.Vocabulary(PIECES, np.random.default_rng(3).random(len(PIECES)) + 0.01)


def test_forward_and_uses_sum_over_all_segmentations(model):
    words = [w.encode() for w in ("a", "ababab", "é", "bé", "abé日ab", "日a", "zab", "abab")] + [b"\xe9"]
    lattice = L.Lattice(L.Trie(PIECES), *buffers(words))
    got = lattice.forward(model.log)
    count, uses = np.arange(1, len(words) + 1), np.zeros(len(PIECES))
    for w, value, n in zip(words, got, count):
        weights = [math.exp(sum(model.log[k] for k in s)) for s in segmentations(w, PIECES)]
        assert math.isclose(math.log(sum(weights)), value, rel_tol=1e-9)
        for s, x in zip(segmentations(w, PIECES), weights):
            for k in s:
                uses[k] += n * x / sum(weights)
    assert np.allclose(lattice.uses(model.log, count) / L.PART, uses, atol=1e-3)
    assert not len(L.Lattice(L.Trie(PIECES), *buffers([])).forward(model.log))


def test_lattice_is_a_distribution_over_words():
    pieces = [(b"", True, False), (b"a", True, False), (b"a", False, True), (b"b", False, True), (b"ab", False, False)]
    log = L.Vocabulary(pieces, np.array([3.0, 1, 2, 1, 1])).log
    words = [bytes(97 + (k >> i & 1) for i in range(n)) for n in range(1, 15) for k in range(1 << n)]
    total = np.exp(L.Lattice(L.Trie(pieces), *buffers(words)).forward(log)).sum()
    # what is missing is the empty word, the mark alone, and words beyond 14 bytes
    assert 1 - 3 / 8 - 0.02 < total < 1 - 3 / 8 + 1e-9


def plain(rows, vocabulary, rounds):
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    words = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) for _, t in rows]
    c = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    d, n, v = held.count(False), sum(c.values()), len(c)
    model, trie = vocabulary, L.Trie(vocabulary.pieces)
    for _ in range(rounds):
        uses = sum(L.Lattice(trie, *buffers([w.encode()])).uses(model.log, np.array([k])) for w, k in c.items())
        model = model.adapted(uses / L.PART)
    end = (d + 0.5) / (n + d + 1)
    out = []
    for (i, _), ws, h in zip(rows, words, held):
        score, base = math.log10(end), math.log10((d + 0.5) / (n + d + 0.5 * (v + (d > 0) + 1)))
        for w in ws:
            spelled = math.exp(L.Lattice(trie, *buffers([w.encode()])).forward(model.log)[0])
            score += math.log10((1 - end) * ((c[w] + v * spelled) / (n + v) if n else spelled))
            base += math.log10((c[w] + 0.5) / (n + d + 0.5 * (v + (d > 0) + 1)))
        out.append((i, h, len(ws) + 1, sum(w in c for w in ws) + (d > 0), n + d, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:5], round(r[6], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_against_a_plain_version(spark):
    texts = [None, "", " \n", "The cat THE hat", "The  cat\tsat\x0bthe", "É日本 ▁x ▁ a b", "unbelievable xqzzj " * 20, "a", "The cat THE hat", "word " * 3000, "x" * 3000]
    rows = [(i, t) for i, t in enumerate(texts * 2)] + [(None, "the null id"), (3, "The cat THE hat")]
    df = spark.createDataFrame([(i, t, "en", 1, 2, "w", "no") for i, t in rows], SCHEMA).repartition(3)
    learned = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    got = L.lm_scores(df, learned)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(got.collect(), plain(rows, L.Vocabulary.read(L.VOCABULARY), 2))


def test_nothing_learned_and_empty(spark):
    learned = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    rows = [(held, "some text"), (held, None)]
    df = spark.createDataFrame([(i, t, "en", 1, 2, "w", "no") for i, t in rows], SCHEMA)
    same(L.lm_scores(df, learned).collect(), plain(rows, L.Vocabulary.read(L.VOCABULARY), 0))
    assert L.lm_scores(spark.createDataFrame([], SCHEMA), learned).count() == 0
