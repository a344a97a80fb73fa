"""Forests as tables of nodes, scored by built-in expressions.

A node has a feature, a threshold and two children, or a value. A row goes left where its scaled feature,
``(x - shift) * scale``, is not above the threshold, and a forest gives the mean of its trees. The table needs no
model class to be read: any engine can score it, and ``score`` does so without MLlib.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.operators.sampling import fixed_size
from evenhand.session import shared_path

DONORS = 1000
DENSE = 12
TREE = "struct<feature:array<int>,threshold:array<double>,left:array<int>,right:array<int>,value:array<double>>"


def node_table(forest: RandomForestRegressionModel, features: Sequence[str], scaler=None) -> DataFrame:
    """Rows of ``tree, node, feature, shift, scale, threshold, left, right, value``; leaves have nulls but for the value.

    The nodes are those that MLlib writes when it saves the model. ``scaler`` is the fitted scaler of the features.
    """
    path = shared_path(SparkSession.active(), "forest")
    forest.write().overwrite().save(path)
    saved = SparkSession.active().read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    split, place = F.col("split"), F.col("split.featureIndex")
    inner = F.col("leftChild") >= 0
    shift = list(scaler.mean) if scaler is not None else [0.0] * len(features)
    scale = [1.0 / s if s else 0.0 for s in scaler.std] if scaler is not None else [1.0] * len(features)

    def of_feature(values: Sequence) -> Column:
        return F.when(inner, F.get(F.array(*[F.lit(v) for v in values]), place))

    return saved.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        of_feature(list(features)).alias("feature"),
        of_feature([float(v) for v in shift]).alias("shift"),
        of_feature([float(v) for v in scale]).alias("scale"),
        F.when(inner, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.col("prediction").alias("value"),
    )


def of_models(features: PipelineModel, forests: Mapping[str, RandomForestRegressionModel], feature_sets: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Node tables of models whose features one pipeline scales, as ``models.feature_stages`` lays it out."""
    scalers = {stage.getOutputCol(): stage for stage in features.stages}
    return {name: node_table(forest, feature_sets[name], scalers.get(f"{name}_features")) for name, forest in forests.items()}


class Scorer:
    """A node table as expressions. The nodes, a bounded number, become constants of the plan."""

    def __init__(self, nodes: DataFrame):
        used = nodes.filter("feature IS NOT NULL").groupBy("feature").agg(F.first("shift").alias("shift"), F.first("scale").alias("scale"))
        self.scaling = {r["feature"]: (r["shift"], r["scale"]) for r in used.collect()}
        self.features = sorted(self.scaling)
        place = F.coalesce(*[F.when(F.col("feature") == f, i) for i, f in enumerate(self.features)], F.lit(-1))
        fields = {"feature": place, "threshold": F.coalesce("threshold", F.lit(0.0)), "value": F.col("value")}
        fields |= {side: F.coalesce(side, F.lit(-1)) for side in ("left", "right")}
        listed = F.array_sort(F.collect_list(F.struct("node", *[c.alias(n) for n, c in fields.items()])))
        trees = nodes.groupBy("tree").agg(listed.alias("nodes"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
        rows = trees.orderBy("tree").collect()
        if not rows or any(r["last"] != r["n"] - 1 for r in rows):
            raise ValueError("every tree needs nodes that are numbered from 0 without a gap")
        self.trees = [{n: [node[n] for node in r["nodes"]] for n in fields} for r in rows]
        self.depth = max(map(_depth, self.trees))

    def score(self, values: Mapping[str, Column]) -> Column:
        """Prediction from columns by feature name."""
        return F.get(self.scores([values]), F.lit(0))

    def scores(self, variants: Sequence[Mapping[str, Column]]) -> Column:
        """Predictions for several sets of values of a row, as an array; the nodes stand in the plan once."""
        trees = F.from_json(F.lit(json.dumps(self.trees)), f"array<{TREE}>")

        def scaled(values: Mapping[str, Column]) -> Column:
            cells = [(values[f] - F.lit(self.scaling[f][0])) * F.lit(self.scaling[f][1]) for f in self.features]
            return F.array(*cells) if cells else F.array(F.lit(0.0))

        def leaf(tree: Column, x: Column) -> Column:
            def step(node: Column, _: Column) -> Column:
                lower = F.get(x, F.get(tree["feature"], node)) <= F.get(tree["threshold"], node)
                left, right = F.get(tree["left"], node), F.get(tree["right"], node)
                return F.when(left < 0, node).when(lower, left).otherwise(right)

            steps = F.sequence(F.lit(1), F.lit(self.depth)) if self.depth else F.array().cast("array<int>")
            return F.get(tree["value"], F.aggregate(steps, F.lit(0), step))

        def mean(x: Column) -> Column:
            return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + leaf(tree, x)) / F.lit(float(len(self.trees)))

        return F.transform(F.array(*map(scaled, variants)), mean)


    def with_score(self, rows: DataFrame, values: Mapping[str, Column], name: str) -> DataFrame:
        """Rows with the prediction as a column, the same number as ``score`` gives.

        Every tree goes down a level at a time, each level a projection, so that Spark compiles the steps; functions of
        array elements, as in ``scores``, it does not. With many trees the projections are too long for one stage of
        generated code; Spark says so in its log and compiles them one by one. A level is stored in full, so trees of
        more than DENSE levels go by ``score``.
        """
        if self.depth > DENSE:
            return rows.withColumn(name, self.score(values))
        levels = [_levels(tree, self.depth) for tree in self.trees]
        cells = [(values[f] - F.lit(self.scaling[f][0])) * F.lit(self.scaling[f][1]) for f in self.features]
        x, places = "_forest_x", [f"_forest_{i}" for i in range(len(self.trees))]

        def fixed(items: Sequence, kind: str) -> Column:
            return F.from_json(F.lit(json.dumps(items)), f"array<{kind}>")

        walked = rows.withColumns({x: F.array(*cells) if cells else F.array(F.lit(0.0)), **{p: F.lit(0) for p in places}})
        for level in range(self.depth):
            steps = {}
            for p, (splits, _) in zip(places, levels):
                feature, threshold = splits[level]
                # beyond a leaf both sides have its value, so the answer there does not matter
                lower = F.get(x, F.get(fixed(feature, "int"), F.col(p))) <= F.get(fixed(threshold, "double"), F.col(p))
                steps[p] = F.col(p) * 2 + F.when(lower, 0).otherwise(1)
            walked = walked.withColumns(steps)
        total = F.lit(0.0)
        for p, (_, leaves) in zip(places, levels):
            total = total + F.get(fixed(leaves, "double"), F.col(p))
        return walked.withColumn(name, total / F.lit(float(len(self.trees)))).drop(x, *places)


def _levels(tree: Mapping[str, Sequence], depth: int) -> tuple[list[tuple[list[int], list[float]]], list[float]]:
    """Feature and threshold of all places of each level, and the values below the last; a leaf fills all places under it."""
    splits, nodes = [], [0]
    for _ in range(depth):
        inner = [tree["left"][node] >= 0 for node in nodes]
        splits.append(([max(tree["feature"][n], 0) for n in nodes], [tree["threshold"][n] if i else 0.0 for n, i in zip(nodes, inner)]))
        nodes = [child for n, i in zip(nodes, inner) for child in ((tree["left"][n], tree["right"][n]) if i else (n, n))]
    return splits, [tree["value"][n] for n in nodes]


def _depth(tree: Mapping[str, Sequence[int]]) -> int:
    deepest, todo = 0, [(0, 0)]
    while todo:
        node, depth = todo.pop()
        deepest = max(deepest, depth)
        if tree["left"][node] >= 0:
            todo += [(tree["left"][node], depth + 1), (tree["right"][node], depth + 1)]
    return deepest


def permutation_importance(
    rows: DataFrame, scorer: Scorer, features: Sequence[str], keys: Sequence[str], label: str, prefix: str = "x_", donors: int = DONORS
) -> DataFrame:
    """Rows of ``feature, importance, mse``: how much the squared error grows when a feature is exchanged.

    A row's feature is replaced by that of another row, which the hash of ``keys`` picks from ``donors`` rows that were
    drawn by the hash of their keys. So all features are measured in one pass, without moving a row, and again the same
    each time. Features that the forest never asks for have none.
    """
    drawn = fixed_size(rows.select(*keys, *[f"{prefix}{f}" for f in features]), keys, donors).collect()
    own = {f: F.col(f"{prefix}{f}") for f in features}
    if not drawn:
        return rows.sparkSession.createDataFrame([], "feature string, importance double, mse double")

    def exchanged(feature: str) -> Column:
        values = F.array(*[F.lit(row[f"{prefix}{feature}"]) for row in drawn])
        return F.get(values, F.pmod(F.xxhash64(*keys, F.lit(feature)), F.lit(len(drawn))).cast("int"))

    asked = [f for f in features if f in scorer.scaling]
    variants = scorer.scores([own, *[own | {f: exchanged(f)} for f in asked]])
    scored = rows.select(F.col(label).alias("_label"), variants.alias("_scores"))
    off = [F.get("_scores", F.lit(i)) - F.col("_label") for i in range(len(asked) + 1)]
    measured = scored.agg(*[F.avg(o * o).alias(n) for o, n in zip(off, ["mse", *[f"mse_{f}" for f in asked]])])
    grown = {f: F.col(f"mse_{f}") - F.col("mse") if f in asked else F.lit(0.0) for f in features}
    return measured.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), g.alias("importance"), F.col("mse")) for f, g in grown.items()])))
