"""Trees over what the rows hold against MLlib's over all features."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from heatline.operators import boosting, learn


def vectors(spark, rows: int, seed: int):
    """Counts, a feature of many values, a negative one and one that is always zero; every other row is dense."""
    rng, made = np.random.default_rng(seed), []
    for i in range(rows):
        v = rng.poisson(0.4, 14) * 1.3
        v[3], v[4], v[5] = rng.normal(), -rng.exponential() * (rng.random() < 0.5), 0.0
        label = 30.0 * (v[0] > 0) + v[1] * v[2] + 5 * v[3] - 8 * v[4] + rng.normal() * 10
        sparse = Vectors.sparse(14, {int(k): float(v[k]) for k in np.flatnonzero(v)})
        made.append((i, Vectors.dense(v) if i % 2 else sparse, float(label)))
    return spark.createDataFrame(made, ["id", "features", "label"])


def predictions(model, rows) -> dict:
    return {r.id: r.prediction for r in model.transform(rows).select("id", "prediction").collect()}


@pytest.mark.parametrize("alone", [1 << 24, 700])
def test_equals_mllib(spark, monkeypatch, alone):
    """In one task or level by level over parts, of which some are empty."""
    monkeypatch.setattr(boosting, "ALONE", alone)
    rows = vectors(spark, 900, 3).repartition(4, "id").union(vectors(spark, 1, 5).where("id < 0")).persist()
    model = learn.regressor(5, 4)
    theirs, ours = model.fit(rows), boosting.fit(model, rows)
    assert predictions(ours, rows) == {k: pytest.approx(v, rel=1e-9) for k, v in predictions(theirs, rows).items()}
    assert ours.evaluateEachIteration(rows, "squared") == pytest.approx(theirs.evaluateEachIteration(rows, "squared"))
    assert (ours.getNumTrees, ours.totalNumNodes, ours.treeWeights) == (theirs.getNumTrees, theirs.totalNumNodes, theirs.treeWeights)
    assert (ours.getMaxDepth(), ours.getFeaturesCol()) == (5, "features")


def labelled_texts(spark):
    text = [(i, f"{'nasty' if i % 3 == 0 else 'nice'} w{i % 7} w{i % 5}", 90.0 * (i % 3 == 0) + i % 4) for i in range(120)]
    return spark.createDataFrame(text, "id bigint, text string, label double")


def without_mllib(monkeypatch) -> None:
    monkeypatch.setattr(learn, "FEW_ROWS", 50, raising=False)
    monkeypatch.setattr(learn.GBTRegressor, "_fit", lambda *a: pytest.fail("MLlib's trees"))


def test_folds_of_many_rows_are_not_grown_by_mllib(spark, monkeypatch):
    rows, grid = labelled_texts(spark), {"features": (20,), "depths": (2,), "rounds": (1, 3), "folds": 2}
    want = learn.tune_by_prefix(rows, "id", **grid)
    without_mllib(monkeypatch)
    found = learn.tune_by_prefix(rows, "id", **grid)
    assert [e[:3] for e in found] == [e[:3] for e in want]
    assert [e[3] for e in found] == pytest.approx([e[3] for e in want])


def test_many_rows_are_not_grown_by_mllib(spark, monkeypatch, tmp_path):
    """The fitted pipeline is stored like any other."""
    rows, model = labelled_texts(spark), learn.score_model(features=20, depth=2, rounds=3)
    want = predictions(learn.fit(model, rows), rows)
    without_mllib(monkeypatch)
    learn.save_model(learn.fit(model, rows), str(tmp_path / "m"))
    assert predictions(learn.load_model(str(tmp_path / "m")), rows) == {k: pytest.approx(v, rel=1e-9) for k, v in want.items()}


def test_nothing_to_split(spark):
    rows = spark.createDataFrame([(i, Vectors.sparse(3, [], []), float(i % 2)) for i in range(10)], ["id", "features", "label"])
    model = boosting.fit(learn.regressor(3, 2), rows)
    assert set(predictions(model, rows).values()) == {0.5} and model.totalNumNodes == 2
    alike = spark.createDataFrame([(i, Vectors.dense([float(i)]), 7.0) for i in range(10)], ["id", "features", "label"])
    assert boosting.fit(learn.regressor(3, 2), alike).totalNumNodes == 2


def test_only_what_is_offered(spark):
    rows = vectors(spark, 20, 1)
    with pytest.raises(ValueError):
        boosting.fit(learn.regressor().setSubsamplingRate(0.5), rows)
    with pytest.raises(Exception, match="labels must be known"):
        boosting.fit(learn.regressor(2, 1), rows.selectExpr("id", "features", "if(id = 3, null, label) as label"))


def test_thresholds_of_many_values():
    """At most so many, at about equal counts; zeros that no entry holds count."""
    values = np.arange(1.0, 101.0)
    points = boosting.split_points([(values[:60], np.ones(60, int)), (values[40:], np.ones(60, int))], 1000, 31)
    assert len(points) <= 31 and points[0] == 0.5 and points == sorted(points)
    assert boosting.split_points([(np.array([2.0, 4.0]), np.array([1, 1]))], 2, 31) == [3.0]
