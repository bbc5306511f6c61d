import random

import pytest

from opinara.operators import evaluate


def area_by_hand(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def points_by_hand(pairs):
    n_pos = sum(y == 1 for _, y in pairs)
    n_neg = sum(y == 0 for _, y in pairs)
    points = [(None, 0.0, 0.0)]
    for t in sorted({s for s, _ in pairs}, reverse=True):
        reached = [y for s, y in pairs if s >= t]
        points.append((t, reached.count(0) / n_neg, reached.count(1) / n_pos))
    return points


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "s double, y int").repartition(4)


CASES = {
    "many scores": [(random.Random(i).random(), i * 7 % 3 == 0 and 1 or 0) for i in range(1500)],
    "ties": [(float(random.Random(i).randint(0, 5)), i % 2) for i in range(300)],
    "one score": [(0.5, i % 2) for i in range(10)],
    "infinite": [(float("inf"), 1), (float("-inf"), 0), (0.0, 1), (0.0, 0), (float("inf"), 0)],
    "perfect": [(1.0, 1), (0.0, 0)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("buckets", [3, None])
def test_area_and_points(spark, name, buckets):
    pairs = CASES[name]
    df = frame(spark, pairs)
    assert evaluate.auc(df, "s", "y", buckets).first().auc == pytest.approx(
        area_by_hand(pairs), abs=1e-12
    )
    points = sorted(map(tuple, evaluate.roc(df, "s", "y", buckets).collect()), key=lambda p: p[1:])
    expected = sorted(points_by_hand(pairs), key=lambda p: p[1:])
    assert [p[1:] for p in points] == [p[1:] for p in expected]
    assert {p[0] for p in points} == {p[0] for p in expected}


def test_area_of_the_turned_score(spark):
    pairs = CASES["ties"]
    turned = [(-s, y) for s, y in pairs]
    total = sum(evaluate.auc(frame(spark, p), "s", "y").first().auc for p in (pairs, turned))
    assert total == pytest.approx(1.0)


def test_missing_class_scores_and_rows(spark):
    one_class = frame(spark, [(0.1, 1), (0.2, 1)])
    assert evaluate.auc(one_class, "s", "y").first() == (2, 0, None)
    assert all(p.fpr is None for p in evaluate.roc(one_class, "s", "y").collect() if p.threshold)
    without_score = frame(spark, [(0.1, 0), (0.2, 1), (None, 1)])
    assert evaluate.auc(without_score, "s", "y").first() == (1, 1, 1.0)
    nothing = frame(spark, [])
    assert evaluate.auc(nothing, "s", "y").first() == (None, None, None)
    assert len(evaluate.roc(nothing, "s", "y").collect()) == 1


def test_nan_ranks_highest(spark):
    pairs = [(float("nan"), 1), (0.3, 0), (0.2, 1), (0.1, 0)]
    assert evaluate.auc(frame(spark, pairs), "s", "y").first().auc == pytest.approx(0.75)


def corners_by_hand(pairs):
    """The points of the whole curve, without those whose next step repeats the last."""
    scores = sorted({s for s, _ in pairs}, reverse=True)
    step = {t: (sum(s == t and y == 0 for s, y in pairs), sum(s == t and y == 1 for s, y in pairs)) for t in scores}
    n_neg, n_pos = sum(y == 0 for _, y in pairs), sum(y == 1 for _, y in pairs)
    points, fp, tp = [(float("inf"), 0.0, 0.0)], 0, 0
    for i, t in enumerate(scores):
        fp, tp = fp + step[t][0], tp + step[t][1]
        if i in (0, len(scores) - 1) or step[t] != step[scores[i + 1]]:
            points.append((t, fp / n_neg, tp / n_pos))
    return points


@pytest.mark.parametrize("name", ["many scores", "ties", "one score", "perfect"])
@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_corners(spark, name, ranges):
    found = evaluate.roc_corners(frame(spark, CASES[name]), "s", "y", ranges).collect()
    assert sorted(map(tuple, found), key=lambda p: (-p[0], p[1:])) == corners_by_hand(CASES[name])


def test_corners_of_one_class_and_of_nothing(spark):
    one = evaluate.roc_corners(frame(spark, [(0.1, 1), (0.2, 1), (0.3, 1)]), "s", "y").collect()
    assert [(r.threshold, r.fpr, r.tpr) for r in sorted(one, key=lambda r: -r.threshold)] == [
        (float("inf"), 0.0, 0.0), (0.3, None, 1 / 3), (0.1, None, 1.0),
    ]
    nothing = evaluate.roc_corners(frame(spark, [(0.1, 1)]).limit(0), "s", "y").collect()
    assert [tuple(r) for r in nothing] == [(float("inf"), 0.0, 0.0)]


@pytest.mark.parametrize("bins", [1, 7, 1000])
def test_histogram_area_lies_within_its_bound(spark, bins):
    rng = random.Random(8)
    pairs = [(rng.random() ** 2, rng.random() < 0.4 and 1 or 0) for _ in range(800)]
    pairs += [(float("nan"), 1), (-1.0, 0), (5.0, 1), (1.0, 0), (0.0, 1), (None, 1)]
    row = evaluate.auc_from_histogram(frame(spark, pairs), "s", "y", 0, 1, bins).first()
    exact = evaluate.auc(frame(spark, pairs), "s", "y").first()
    assert (row.n_pos, row.n_neg) == (exact.n_pos, exact.n_neg)
    assert abs(row.auc - exact.auc) <= row.bound + 1e-12
    assert row.bound <= 1 / bins + 0.01 if bins > 1 else row.bound == 0.5


def test_histogram_area_of_one_class_and_of_nothing(spark):
    one = evaluate.auc_from_histogram(frame(spark, [(0.5, 1)]), "s", "y", 0, 1).first()
    assert tuple(one) == (1, 0, None, None)
    nothing = evaluate.auc_from_histogram(frame(spark, [(0.5, 1)]).limit(0), "s", "y", 0, 1).first()
    assert tuple(nothing) == (0, 0, None, None)


def test_histogram_area_ranks_nothing(spark):
    made = evaluate.auc_from_histogram(frame(spark, CASES["ties"]), "s", "y", 0, 6)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan
