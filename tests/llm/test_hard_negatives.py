"""The vertical scan against plain sorting."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm.hard_negatives import ColumnBlock, hard_negatives, quantised

SCHEMA = "vec_id long, embedding array<float>, label int, block int, windows string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def brute(rows, every=100, k=5):
    """Rows (id, label, integer vector) with all rules spelled out."""
    rows = sorted(rows)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, label, vector in rows:
        if i % every:
            continue
        scored = sorted((-dot(vector, v), j, other) for j, other, v in rows if j != i)
        for p, j, other in [x for x in scored if x[2] == label][:k]:
            good = [x for x in scored if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p][:k]
            out += [(i, j, place + 1, x[1], -p, -x[0]) for place, x in enumerate(good)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 40), st.integers(1, 30), st.integers(1, 5))
def test_scan_keeps_every_answer(seed, n, dims, k):
    rng = np.random.default_rng(seed)
    vectors, labels, ids = rng.integers(-9, 10, (n, dims)), rng.integers(0, 3, n), rng.permutation(n) * 3
    block, anchor = ColumnBlock(ids, labels, vectors), rng.integers(-9, 10, dims)
    scores = vectors @ anchor
    order = sorted(range(n), key=lambda i: (-scores[i], ids[i]))
    got = block.best(0, 1, anchor, k)
    assert got[0].tolist() == [int(ids[i]) for i in order if labels[i] == 1 and ids[i] != 0][:k]
    windows = [(-20, 30), (5, 5), (0, 1000), (-1000, -1)]
    for (low, high), (found, own) in zip(windows, block.in_windows(1, anchor, windows, k), strict=True):
        want = [i for i in order if labels[i] != 1 and low <= scores[i] <= high][:k]
        assert (found.tolist(), own.tolist()) == ([int(ids[i]) for i in want], [int(scores[i]) for i in want])


def test_against_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    common = rng.normal(0, 0.3, 20)
    rows = []
    for i in range(1200):
        vector = common if i % 3 == 0 else common + rng.normal(0, 0.2, 20)  # a third of all rows is one vector
        rows.append((i, [float(np.float32(x)) for x in vector], 1 if i % 3 == 0 else int(rng.integers(0, 4))))
    whole = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [int(np.floor(256 * x)) for x in v]) for i, v, lab in rows]
    want = brute(whole)
    assert len(want) > 100
    assert result(hard_negatives(frame(spark, rows))) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (100, [1.0, 0.0], 1), (101, [1.0, 0.5], 1), (102, [0.9, 0.0], 2), (103, None, 1), (104, [1.0, None], 1), (106, [nan, 1.0], 1),
        (107, [1.0, inf], 2), (108, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (109, [1e9, 0.0], 2), (110, [], 2), (111, [0.95], 3), (102, [0.9, 0.0], 2),
    ]
    got = result(hard_negatives(frame(spark, rows)))
    # 256 * 256 for the positive; 0.9 and the shorter vector lie in the window, the empty one scores 0
    assert got == [(100, 101, 1, 111, 65536, 243 * 256), (100, 101, 2, 102, 65536, 230 * 256)]
    assert quantised(frame(spark, rows)).count() == 5


def test_shares_of_an_id_and_empty_tables(spark):
    rows = [(100, [1.0], 1), (101, [1.0], 1), (102, [0.5], 2), (102, [0.9], 2), (102, [0.9], 1)]
    # of id 102 the row of least label, 1, counts
    assert result(hard_negatives(frame(spark, rows))) == []
    assert result(hard_negatives(frame(spark, []))) == []
    assert result(hard_negatives(frame(spark, [(100, [1.0], 1)]))) == []


@pytest.mark.parametrize("score", [-5, 0, 1, 7, 64])
def test_no_negatives_below_zero(spark, score):
    rows = [(100, [1.0], 1), (101, [score / 256], 1), (102, [score / 256], 2), (103, [(score - 1) / 256], 2)]
    whole = [(i, lab, [int(np.floor(256 * x)) for x in v]) for i, v, lab in rows]
    assert result(hard_negatives(frame(spark, rows))) == brute(whole)
