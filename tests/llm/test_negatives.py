"""Hard negatives: against a plain search over all rows, and how much of the lists is read."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import negatives

from . import helpers as h

INF, NAN = float("inf"), float("nan")
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, is_anchor=lambda vec_id: vec_id % 50 == 0, positives=5, negatives=3):
    """rows of (vec_id, list of integers, label); nothing but sorting."""
    found = []
    width = max((len(v) for _, v, _ in rows), default=0)
    full = [(i, v + [0] * (width - len(v)), label) for i, v, label in rows]
    for at, (anchor_id, anchor, label) in enumerate(full):
        if not is_anchor(anchor_id):
            continue
        scored = [(-sum(x * y for x, y in zip(anchor, v, strict=True)), i, k, x) for k, (i, v, x) in enumerate(full) if k != at]
        for score, positive_id, *_ in sorted(s for s in scored if s[3] == label)[:positives]:
            fits = sorted(s for s in scored if s[3] != label and 50 * -score <= 100 * -s[0] <= 95 * -score)
            found += [(anchor_id, positive_id, r + 1, i, -score, -s) for r, (s, i, *_) in enumerate(fits[:negatives])]
    return found


def scaled(rows):
    return [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label) for i, v, label in rows]


def some_rows(n=400, seed=5, labels=4, hot=0.0):
    """Vectors round one centre a label, with ties, copies and opposite vectors; a share ``hot`` is one vector of many labels."""
    rng = random.Random(seed)
    centres = [[rng.choice((-0.5, 0.0, 0.25, 0.5)) for _ in range(8)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        kind = rng.random()
        v = [c + rng.choice((-0.125, 0.0, 0.0625, 0.3)) for c in centres[label]]
        if kind < hot:
            v = centres[0]
        elif kind < hot + 0.1:
            v = [-x for x in v]
        rows.append((i, v, label))
    return rows


def mined(spark, rows, is_anchor="vec_id % 50 = 0"):
    found = negatives.hard_negatives(negatives.usable(h.vectors(spark, rows)), F.expr(is_anchor))
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 64)
    monkeypatch.setattr(negatives, "ANCHORS", 5)
    monkeypatch.setattr(negatives, "FIRST_READ", 2)


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_many_cells_equal_plain_search(spark, small_cells, hot):
    rows = some_rows(hot=hot)
    found = mined(spark, rows, "vec_id % 20 = 0")
    assert found and found == sorted(plain(scaled(rows), lambda i: i % 20 == 0))


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, [0.75, 5.0], 2), (3, [0.75, -5.0], 2), (4, [0.6], 2), (5, [0.5], 3),
        (6, [], 2), (8, [0.9, 0.0], 2), (50, [0.0, 0.0], 1), (100, [-1.0, 0.0], 3), (150, [], 4),
    ]
    left_out = [
        (None, [0.8, 0.0], 2), (9, None, 2), (10, [0.8, None], 2), (11, [0.8, NAN], 2), (12, [INF, 0.0], 2), (13, [0.8, -INF], 2), (15, [0.8, 0.0], None),
        (16, [3.0e38, 0.0], 2), (17, [1.0e9, 0.0], 2),
    ]
    wanted = sorted(plain(scaled(rows)))
    assert mined(spark, rows + left_out) == wanted
    # Both anchors 0 are rows of their own, the other's first positive with the same score; ties by id.
    assert [w for w in wanted if w[:2] == (0, 0)] == [(0, 0, r, i, 65536, 49152 if i != 8 else 58880) for r, i in ((1, 8), (2, 2), (3, 3)) for _ in "ab"]
    assert mined(spark, left_out) == [] and mined(spark, rows[:2]) == []


def test_large_components_are_exact(spark):
    """Products beyond the 53 bits of a double, which differ in the last bit."""
    base = 120_000.0
    rows = [(0, [base, base], 1), (1, [base, base], 1), (2, [base, base - 0.015625], 2), (3, [base, base - 0.0078125], 2), (4, [base * 0.5, base * 0.5], 3)]
    assert mined(spark, rows) == sorted(plain(scaled(rows)))


def test_reading_stops_below_the_kth_score():
    """Far below the best rows nothing is read, and a tie at the kth place is read to its end."""
    rng = np.random.default_rng(3)
    rows = np.floor(rng.normal(size=(4000, 6)) * 256)
    rows[:3] = 5000
    lists, anchor = negatives.Lists(rows), np.full(6, 7.0)
    met, scores = lists.search(anchor, lambda met, scores: negatives._kth(scores[met], 3))
    assert met[:3].all() and met.sum() < 400 and (scores[met] == rows[met] @ anchor).all()
    rows[3:2000] = 5000
    met, _ = negatives.Lists(rows).search(anchor, lambda met, scores: negatives._kth(scores[met], 3))
    assert met[:2000].all() and met.sum() < 3000
    met, _ = lists.search(-anchor, lambda met, scores: negatives._kth(scores[met], 1))
    assert met[(rows @ -anchor).argmax()]


def test_threshold_never_below_a_row_not_met():
    rng = np.random.default_rng(4)
    rows = rng.integers(-9, 9, (300, 5)).astype(float)
    lists = negatives.Lists(rows)
    for _ in range(50):
        anchor, k = rng.integers(-9, 9, 5).astype(float), int(rng.integers(1, 30))
        met, scores = lists.search(anchor, lambda met, scores, k=k: negatives._kth(scores[met], k))
        every = rows @ anchor
        assert (~met).sum() == 0 or every[~met].max() < np.sort(scores[met])[-k]
        assert (scores[met] == every[met]).all()


def test_query_equals_sql(spark, tmp_path):
    path = h.folder(spark, tmp_path / "t", [], embeddings=[*some_rows(), (400, None, 1), (None, [0.1] * 8, 1), (401, [0.1, NAN] * 4, 2)])
    columns, rows = h.by_sql(path, negatives.SQL)
    found = negatives.op11_hard_negatives(spark, path)
    assert found.columns == columns and rows
    h.same_rows(found, columns, rows)
