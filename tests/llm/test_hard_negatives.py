"""Hard negatives and the Strassen product against plain versions."""

import math

import numpy as np
import pytest

from pitchstar.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, id long, grp int, bucket string"


def plain(rows, every=3, scale=4, positives=2, negatives=3, low=30, high=90):
    live = {}
    for i, lab, v in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        r = (lab, [math.floor(scale * float(np.float32(x))) for x in v])
        live[i] = min(live.get(i, r), r)
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (lab, v) in live.items():
        if a % every:
            continue
        ranked = sorted((-product(v, w), i, other) for i, (other, w) in live.items() if i != a)
        for s, p, _ in [x for x in ranked if x[2] == lab][:positives]:
            hard = [(i, -t) for t, i, other in ranked if other != lab and low * -s <= 100 * -t <= high * -s]
            out += [(a, p, k + 1, i, -s, t) for k, (i, t) in enumerate(hard[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("shape", [(1, 1, 1), (50, 49, 51), (97, 130, 101), (200, 64, 333), (5, 0, 7)])
def test_strassen_is_the_product(shape):
    rnd = np.random.default_rng(1)
    n, m, p = shape
    for top in (3, 2**20, 2**28):
        a, b = rnd.integers(-top, top, (n, m)), rnd.integers(-top, top, (m, p))
        assert (H.strassen(a, b, top) == a @ b).all()
    big = 2**62
    a, b = rnd.integers(-big, big, (n, m)), rnd.integers(-big, big, (m, p))
    exact = a.astype(object) @ b.astype(object) if m else np.zeros((n, p), object)
    assert (H.strassen(a.astype(object), b.astype(object), big) == exact).all()
    assert (H.scores(a, b.T.copy()).astype(object) == np.clip(exact, H.LOW, H.HIGH)).all()


def test_against_a_plain_version(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    rows = [(i, int(rnd.integers(0, 4)) if rnd.random() < 0.6 else 1, [float(x) for x in rnd.normal(0.4, 1, 6)]) for i in range(160)]
    rows += [(200 + i, i % 3, [1.0, 1.0, 1.0]) for i in range(60)]  # copies: ties
    rows += [(300, None, [1.0] * 6), (303, 1, None), (306, 2, [None, 1.0]), (309, 2, [float("nan")] * 3), (312, 0, [float("inf")]), (None, 1, [1.0]),
             (315, 3, []), (318, 9, [2.0] * 6), (0, 7, [9.0] * 6), rows[3], (-3, 1, [1.5] * 6)]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(5)
    want = plain(rows)
    assert len(want) > 50
    for block, anchors in ((65536, 1024), (40, 7)):
        monkeypatch.setattr(H, "BLOCK", block), monkeypatch.setattr(H, "ANCHORS", anchors)
        got = H.hard_negatives(df, every=3, scale=4, positives=2, negatives=3)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(map(tuple, got.collect())) == want


def test_empty_and_no_anchor(spark):
    assert H.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert H.hard_negatives(spark.createDataFrame([(1, 1, [1.0], 1, 1, "x"), (2, 2, [1.0], 1, 1, "x")], SCHEMA)).count() == 0


def test_long_values(spark):
    rows = [(0, 1, [3e38, 1.0]), (1, 1, [3e38, 1.0]), (2, 2, [3e38, -1.0]), (3, 2, [2.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    # every component beyond a long is held at its end, and so is the score
    assert [tuple(r) for r in H.hard_negatives(df, every=10, scale=1, low=30, high=100).collect()] == [(0, 1, 1, 2, H.HIGH, H.HIGH), (0, 1, 2, 3, H.HIGH, H.HIGH)]


def test_heaps_merge_tile_by_tile():
    rnd = np.random.default_rng(8)
    s, ids = rnd.integers(-3, 4, (20, 500)), rnd.permutation(500)
    s[3] = H.LOW
    allowed = rnd.random(s.shape) < 0.5
    allowed[5] = False
    heaps = H.Heaps(20, 7)
    for at in range(0, 500, 13):
        H._offer(heaps, np.arange(20), s[:, at:at + 13].copy(), allowed[:, at:at + 13].copy(), ids[at:at + 13])
    for row in range(20):
        mine = heaps.slot == row
        want = sorted((-int(s[row, j]), int(ids[j])) for j in range(500) if allowed[row, j])[:7]
        assert list(zip((-heaps.score[mine].astype(object)).tolist(), heaps.id[mine].tolist())) == want
