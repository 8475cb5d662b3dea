import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.wrapper import JavaEstimator
from pyspark.sql import functions as F

from ebbtide.operators import evaluation
from ebbtide.plans import explaining, forests, models


@pytest.fixture(scope="module")
def rows(spark):
    """A number, three flags and a label that follows them but for a tenth of the rows."""
    bit = [(F.xxhash64("id", F.lit(k)) % 2 == 0).cast("double") for k in range(3)]
    number = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)) / 10
    truth = ((number > 62) & (bit[0] == 1)) | (bit[1] + bit[2] == 2)
    noisy = F.when(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(10)) == 0, ~truth).otherwise(truth)
    df = spark.range(4000).select("id", array_to_vector(F.array(number, *bit)).alias("features"), noisy.cast("double").alias("label"))
    return df.repartition(4, "id").cache()


def forest(**params):
    return models.classifier(models.FOREST, **{"numTrees": 10, "maxDepth": 5, **params})


@pytest.fixture
def own(monkeypatch):
    """Every forest is grown here, however few its rows."""

    def fit(*_):
        raise AssertionError("left to MLlib")

    monkeypatch.setattr(forests, "FEW_ROWS", 0, raising=False)
    monkeypatch.setattr(JavaEstimator, "_fit", fit)


def test_many_rows_are_counted_here_and_learned_as_well(rows, own, monkeypatch):
    fitted = forest().fit(rows)
    monkeypatch.undo()
    by_mllib = forest().fit(rows)
    got, want = (evaluation.metrics(models.scored_rows(m, rows)).first() for m in (fitted, by_mllib))
    assert got["accuracy"] > 0.85 and abs(got["roc_auc"] - want["roc_auc"]) < 0.03
    assert type(fitted) is type(by_mllib) and fitted.numFeatures == 4 and len(fitted.trees) == 10
    assert max(t.depth for t in fitted.trees) <= 5 and models.best_params(fitted) == models.best_params(by_mllib)
    assert np.allclose(fitted.featureImportances.toArray(), by_mllib.featureImportances.toArray(), atol=0.12)
    total = F.aggregate("contributions", F.col("base"), lambda a, c: a + c)
    scored = explaining.explained(fitted.transform(rows), fitted).select(total.alias("a"), F.get(models.probabilities(fitted.transform(rows)), F.lit(1)).alias("b"))
    assert scored.where(F.abs(F.col("a") - F.col("b")) > 1e-9).isEmpty()


def test_nodes_hold_the_counts_of_their_rows(spark, rows, own):
    """With one flag and no bootstrap to speak of, each leaf's share is that of the rows drawn into it."""
    one = rows.select(array_to_vector(F.array(F.get(models.vector_to_array("features"), F.lit(2)), F.lit(0.0))).alias("features"), "label")
    fitted = forest(numTrees=2, maxDepth=1).fit(one)
    root = explaining.tree_nodes(fitted, spark).where("id = 0").collect()
    share = rows.agg(F.avg("label")).first()[0] / 2
    assert len(root) == 2 and all(abs(r["value"] - share) < 0.03 for r in root)
    assert forest(numTrees=2, maxDepth=1).fit(one).toDebugString.split("\n")[1:] == fitted.toDebugString.split("\n")[1:]


def test_groups_of_trees_grow_the_same_forest(rows, own, monkeypatch):
    whole = forest().fit(rows).toDebugString.split("\n")[1:]
    monkeypatch.setattr(forests, "PASS_CELLS", 1)
    assert forest().fit(rows).toDebugString.split("\n")[1:] == whole


def test_thresholds_come_from_all_rows():
    values, counts = np.arange(5.0), np.array([1, 1, 1, 1, 9996.0])
    assert forests.thresholds(values, counts, 32).tolist() == [0.5, 1.5, 2.5, 3.5]  # the rarest values have their own bins
    assert len(forests.thresholds(np.arange(1000.0), np.ones(1000), 32)) == 31
    at, n = forests._summary(np.arange(10_000.0), np.ones(10_000), 100)
    assert len(at) == 100 and n.sum() == 10_000 and at[-1] == 9999 and n.max() <= 101
    assert forests.thresholds(np.array([3.0]), np.ones(1), 32).size == 0


def test_what_is_not_covered_is_left_to_mllib(rows, own):
    with pytest.raises(AssertionError, match="left to MLlib"):
        forest(featureSubsetStrategy="all").fit(rows)
    with pytest.raises(AssertionError, match="left to MLlib"):
        forest().fit(rows.withColumn("label", F.col("label") * 2))
