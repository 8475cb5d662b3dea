"""Why a row got its score: what every feature adds to the model's base value, in column expressions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.plans.features import FEATURES, vector_names
from ebbtide.session import fresh_path

_STEPS = "array<struct<slot: int, delta: double>>"


def tree_nodes(model, spark) -> DataFrame:
    """``tree, id, value, feature, bounds, categories, left, right``: the nodes of a fitted tree or its trees.

    ``value`` is what a row ending there would add to the score: for trees and forests the share of class 1
    over the number of trees, for boosted trees the weighted prediction, so that values sum to the margin.
    """
    path = fresh_path(spark, "model")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    nodes = saved.select(F.col("treeID").alias("tree"), "nodeData.*") if "treeID" in saved.columns else saved.withColumn("tree", F.lit(0))
    if "GBT" in type(model).__name__:
        weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
        value = F.col("prediction") * F.get(weights, F.col("tree"))
    else:
        trees = len(model.trees) if hasattr(model, "trees") else 1
        total = F.aggregate("impurityStats", F.lit(0.0), lambda a, v: a + v)
        value = F.get("impurityStats", F.lit(1)) / total / trees
    return nodes.select(
        "tree",
        "id",
        value.alias("value"),
        F.col("split.featureIndex").alias("feature"),
        F.col("split.leftCategoriesOrThreshold").alias("bounds"),
        F.col("split.numCategories").alias("categories"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
    )


def _steps(nodes: Column, x: Column, depth: int) -> Column:
    """The changes of a tree's value along a row's path, each with the feature that decided."""

    def step(state: Column, _: Column) -> Column:
        node = F.get(nodes, state["node"])
        at = F.get(x, node["feature"])
        left = F.when(node["categories"] < 0, at <= F.get(node["bounds"], F.lit(0))).otherwise(F.array_contains(node["bounds"], at))
        down = F.when(left, node["left"]).otherwise(node["right"])
        change = F.struct(node["feature"].alias("slot"), (F.get(nodes, down)["value"] - node["value"]).alias("delta"))
        leaf = node["left"] < 0
        return F.struct(
            F.when(leaf, state["node"]).otherwise(down).alias("node"),
            F.when(leaf, state["steps"]).otherwise(F.concat(state["steps"], F.array(change))).alias("steps"),
        )

    start = F.struct(F.lit(0).alias("node"), F.array().cast(_STEPS).alias("steps"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), start, step, lambda state: state["steps"])


def explained(df: DataFrame, model) -> DataFrame:
    """``df`` with ``base`` and ``contributions``, a value a feature slot; together they are the row's score.

    The score is the margin (``rawPrediction`` of class 1) of linear and boosted models, the probability of
    class 1 of trees and forests. ``df`` holds ``features``, or what a fitted pipeline makes them of. A tree's
    nodes, whose number is bounded by its depth, go along as one constant.
    """
    last = model
    if isinstance(model, PipelineModel):
        last, df = model.stages[-1], PipelineModel(model.stages[:-1]).transform(df)
    x = vector_to_array(FEATURES)
    if hasattr(last, "coefficients"):
        weights = F.array(*[F.lit(float(w)) for w in last.coefficients.toArray()])
        return df.withColumns({"base": F.lit(float(last.intercept)), "contributions": F.zip_with(x, weights, lambda v, w: v * w)})
    depth = max(t.depth for t in last.trees) if hasattr(last, "trees") else last.depth
    columns = ["id", "value", "feature", "bounds", "categories", "left", "right"]
    trees = tree_nodes(last, df.sparkSession).groupBy("tree").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("nodes"))
    all_trees = trees.agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("trees"))
    df, trees = df.withColumn("_trees", all_trees.scalar()), F.col("_trees")
    steps = F.flatten(F.transform(trees, lambda t: _steps(t["nodes"], x, depth)))
    none = F.array_repeat(F.lit(0.0), last.numFeatures)
    added = F.aggregate(
        steps, none, lambda sums, s: F.transform(sums, lambda v, i: F.when(i == s["slot"], v + s["delta"]).otherwise(v))
    )
    base = F.aggregate(trees, F.lit(0.0), lambda a, t: a + F.get(t["nodes"], F.lit(0))["value"])
    return df.withColumns({"base": base, "contributions": added}).drop("_trees")


def reasons(explained_rows: DataFrame, n: int = 3) -> Column:
    """The ``n`` features that moved a row's score most, as ``(feature, contribution)``; ties by name."""
    names = F.array(*[F.lit(name) for name in vector_names(explained_rows)])
    pairs = F.zip_with(names, F.col("contributions"), lambda name, c: F.struct((-F.abs(c)).alias("by"), name.alias("feature"), c.alias("contribution")))
    moved = F.filter(pairs, lambda p: p["contribution"] != 0)
    return F.transform(F.slice(F.sort_array(moved), 1, n), lambda p: F.struct(p["feature"], p["contribution"]))
