import pytest
from pyspark.errors import IllegalArgumentException
from pyspark.sql import functions as F

from lakeloom.operators import ml


@pytest.fixture
def linear(spark):
    """x from -10 to 10, y = 2x + 1."""
    return spark.range(-10, 11).select(F.col("id").cast("double").alias("x"), (2.0 * F.col("id") + 1).alias("y"))


def test_linear_fit_finds_the_line(linear):
    model = ml.linear_fit(linear, ["x"], "y")
    assert model.coefficients[0] == pytest.approx(2, abs=1e-6) and model.intercept == pytest.approx(1, abs=1e-6)


@pytest.fixture
def labelled(spark):
    return spark.range(400).select(
        "id", (F.col("id") % 40).cast("string").alias("kind"), (F.col("id") % 7).cast("double").alias("n"),
        (F.col("id") % 40 < 20).cast("double").alias("label"),
    )


def test_tree_learns_and_reloads(labelled, tmp_path, rows):
    model = ml.tree_stages(["kind"], ["n"], "label", max_bins=64).fit(labelled)
    scored = model.transform(labelled)
    assert ml.evaluate(scored, "label", ["accuracy", "f1"]) == {"accuracy": 1.0, "f1": 1.0}
    again = ml.save_and_reload(model, str(tmp_path / "model")).transform(labelled)
    assert rows(scored.select("id", "prediction")) == rows(again.select("id", "prediction"))
    assert rows(ml.confusion(scored, "label")) == [(0.0, 0.0, 200), (1.0, 1.0, 200)]


def test_max_bins_must_cover_the_categories(labelled):
    with pytest.raises(IllegalArgumentException):
        ml.tree_stages(["kind"], ["n"], "label", max_bins=16).fit(labelled)


def test_split_is_whole_disjoint_and_stable(labelled, rows):
    train, test = ml.split_rows(labelled, "id")
    assert train.count() + test.count() == 400 and train.join(test, "id").isEmpty()
    again, _ = ml.split_rows(labelled.repartition(5), "id")
    assert rows(again) == rows(train)


def test_search_keeps_the_best(labelled):
    found = ml.search(labelled, ml.tree_stages(["kind"], ["n"], "label", max_bins=64), "label", [1, 6], [64])
    assert len(found.validationMetrics) == 2
    best = found.bestModel.stages[-1]
    assert best.getMaxDepth() == (1, 6)[max(range(2), key=lambda i: found.validationMetrics[i])]


def test_search_fits_the_features_once(labelled, monkeypatch):
    fits, fit = [], ml.StringIndexer.fit
    monkeypatch.setattr(ml.StringIndexer, "fit", lambda *a, **k: fits.append(1) or fit(*a, **k))
    found = ml.search(labelled, ml.tree_stages(["kind"], ["n"], "label", max_bins=64), "label", [1, 6], [64])
    assert len(fits) == 1 and found.bestModel.transform(labelled).where("prediction = label").count() == 400
