"""Vector search against brute force."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int, `list` string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA).repartition(4)


def exact(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    data = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for q in queries:
        score = (data * data[np.flatnonzero(ids == q)[0]]).sum(axis=1)
        others = np.flatnonzero(ids != q)
        order = others[np.lexsort((ids[others], -score[others]))][:k]
        out[q] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found_by(result):
    got = defaultdict(list)
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


@pytest.mark.parametrize("spread", ["uniform", "clusters", "norms"])
def test_recall(spark, spread):
    rng = np.random.default_rng(1)
    data = rng.standard_normal((3000, 24))
    if spread == "clusters":
        data = rng.standard_normal((30, 24))[rng.integers(0, 30, 3000)] + 0.2 * data
    if spread == "norms":
        data *= rng.lognormal(0, 0.7, 3000)[:, None]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(data.astype(np.float32))]
    got = found_by(ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0))
    truth = exact(rows, range(0, 3000, 20), ann.K)
    assert set(got) == set(truth) and all(len(x) == ann.K for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert hits / (ann.K * len(truth)) > 0.9
    scores = {q: dict(x) for q, x in truth.items()}
    assert all(abs(s - scores[q].get(i, s)) < 1e-9 for q in got for i, s in got[q])


def test_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(rng.standard_normal((200, 6)).astype(np.float32))]
    same = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    rows += [(k, same) for k in range(1000, 1400)]
    good = list(rows)
    rows += [(2000, None), (2020, [0.0] * 6), (2040, [None, *same[1:]]), (2060, [float("nan"), *same[1:]])]
    rows += [(2080, [float("inf"), *same[1:]]), (2100, [1.0, 2.0]), (2120, []), (None, same), rows[3], rows[3]]
    got = found_by(ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0))
    truth = exact(good, [q for q, _ in good if q % 20 == 0], ann.K)
    assert set(got) == set(truth)
    # Every query of the repeated vector finds its copies with the smallest IDs.
    for q in range(1000, 1400, 20):
        assert [i for i, _ in got[q]] == [i for i, _ in truth[q]]


@pytest.mark.parametrize("clusters", [40, 400])
def test_lists_inside_coarse_lists(spark, monkeypatch, clusters):
    """More lists than the sample can give centroids for."""
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(3)
    data = rng.standard_normal((clusters, 16))[rng.integers(0, clusters, 4000)] + 0.15 * rng.standard_normal((4000, 16))
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(data.astype(np.float32))]
    fitted = ann.fit_layout(ann.written(ann.clean(frame(spark, rows))), sample=200)
    assert fitted.coarse is not None and len(fitted.centroids) >= 28 and (np.diff(fitted.owner) >= 0).all()
    points = fitted.rotated(data)
    lists = fitted.lists(points)
    coarse = ((points[:, None] - fitted.coarse[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (fitted.owner[lists] == coarse).all()
    monkeypatch.setattr(ann, "fit_layout", lambda rows: fitted)
    got = found_by(ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0))
    truth = exact(rows, range(0, 4000, 20), ann.K)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert hits / (ann.K * len(truth)) > 0.9


def test_rows_with_one_id_are_all_searched(spark):
    rng = np.random.default_rng(5)
    rows = [(k // 2, [float(x) for x in v]) for k, v in enumerate(rng.standard_normal((120, 5)).astype(np.float32))]
    rows += [rows[0], rows[0]]
    result = ann.nearest(frame(spark, rows), F.col("vec_id") % 10 == 0, k=200).collect()
    data = np.array([v for _, v in rows], np.float32).astype(float)
    expected = []
    for j, (q, _) in enumerate(rows):
        if q % 10 == 0:
            expected += [(q, i, round(float(s), 9)) for k, ((i, _), s) in enumerate(zip(rows, data @ data[j])) if k != j]
    assert sorted((r.query_id, r.vec_id, round(r.score, 9)) for r in result) == sorted(expected)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(k, [float(k), 1.0]) for k in range(1, 8)]
    got = found_by(ann.nearest(frame(spark, rows), F.col("vec_id") <= 2))
    assert got == exact(rows, [1, 2], ann.K)
    assert found_by(ann.nearest(frame(spark, rows[:1]), F.col("vec_id") == 1)) == {}


def test_no_vectors(spark):
    assert ann.nearest(frame(spark, []), F.lit(True)).count() == 0
    assert ann.nearest(frame(spark, [(1, None)]), F.lit(True)).columns == ["query_id", "rank", "vec_id", "score"]
