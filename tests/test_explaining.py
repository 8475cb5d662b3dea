"""Contributions add up to the score; malformed records are set apart."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.plans import explaining, models
from ebbtide.sources.tables import quarantine, read_checked


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.range(400).selectExpr("id", "double(id % 7) a", "double(id % 3) b", "double(id % 11) c", "double(id % 7 > 3 or id % 11 > 8) label")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)


@pytest.mark.parametrize(
    ("name", "column", "params"),
    [
        (models.LOGISTIC, "rawPrediction", {"maxIter": 20}),
        (models.TREE, "probability", {"maxDepth": 4}),
        (models.FOREST, "probability", {"maxDepth": 3, "numTrees": 5}),
        (models.BOOSTED, "rawPrediction", {"maxDepth": 2, "maxIter": 4}),
    ],
)
def test_contributions_add_up_to_the_score(vectors, name, column, params):
    model = models.classifier(name, **params).fit(vectors)
    out = explaining.explained(model.transform(vectors), model)
    total = F.aggregate("contributions", F.col("base"), lambda a, c: a + c)
    off = F.abs(total - F.get(vector_to_array(column), F.lit(1)))
    assert out.agg(F.max(off)).first()[0] < 1e-9
    top = out.select(explaining.reasons(out, 2).alias("r")).first()["r"]
    assert len(top) <= 2 and {r["feature"] for r in top} <= {"a", "b", "c"}


def test_contributions_of_categories(vectors):
    """Splits by a set of categories decide like the model does."""
    rows = vectors.select("id", F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("k"), F.expr("double(id % 7 in (1, 4, 6))").alias("label"))
    model = models.build_pipeline(rows, models.TREE, [], ["k"], params={"maxDepth": 3}, encoding="label").fit(rows)
    out = explaining.explained(rows, model).withColumn("sum", F.aggregate("contributions", F.col("base"), lambda a, c: a + c))
    joined = out.select("id", "sum").join(model.transform(rows).select("id", F.get(vector_to_array("probability"), F.lit(1)).alias("p")), "id")
    assert joined.where(F.abs(F.col("sum") - F.col("p")) > 1e-9).count() == 0


def test_malformed_records_are_set_apart(spark, tmp_path):
    lines = ['n,name,x', '1,a,1.5', '2,"b, c",2', 'x,d,3', '4,e', '5,f,6,7', ' ,g, ', 'y,h,z']
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    checked = read_checked(spark, str(tmp_path / "in.csv"), T.StructType.fromDDL("n int, name string, x double"))
    assert checked.select("_reasons").where(F.size("_reasons") > 0).count() == 4  # also where nothing else is asked for
    sound, bad = quarantine(checked, str(tmp_path / "out"))
    assert sorted(map(tuple, sound.collect()), key=str) == [(1, "a", 1.5), (2, "b, c", 2.0), (None, "g", None)]
    found = {r["name"]: (r["_reasons"], r["_line"]) for r in bad.collect()}
    assert found == {
        "d": (["unreadable: n"], None),
        "e": (["short line"], "4,e"),
        "f": (["long line"], "5,f,6,7"),
        "h": (["unreadable: n", "unreadable: x"], None),
    }
