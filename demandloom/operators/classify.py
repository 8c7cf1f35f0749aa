"""Tabular decision tree: fit, score, accuracy.

Spark ML grows the top of the tree. Below it a node has few rows, but Spark ML still sends counts
for every feature, bin and label of it from every partition; so the rows of one leaf of the top
come together instead, and its subtree is grown there by the same rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.schemas import BEAN_FEATURES, BEAN_LABEL

BINS = 128
#: Levels that Spark ML grows, and how many more if a leaf has too many rows for one task.
TOP, MORE = 8, 4
#: Rows of a leaf of the top that one task takes.
LEAF_ROWS = 100_000
#: Rows that the cut points are taken from, as in Spark ML; smaller tables count whole.
CUT_ROWS = BINS * BINS
SUBTREE = "leaf double, feature array<int>, cut array<int>, child array<int>, label array<int>"


@dataclass
class Tree:
    """``top`` by Spark ML, and the nodes below it. Node k of these has its first child at
    ``child[k]`` and the second behind it, or -1; ``roots`` has the node that goes on from a leaf."""

    labels: list[str]
    top: DecisionTreeClassificationModel
    roots: dict[int, int] = field(default_factory=dict)
    feature: np.ndarray | None = None
    threshold: np.ndarray | None = None
    child: np.ndarray | None = None
    label: np.ndarray | None = None


def features_from_array(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(column).cast("array<double>")))


def features_from_columns(df: DataFrame, columns: list[str] = BEAN_FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def cut_points(values: np.ndarray, n_rows: float, n_bins: int) -> list[float]:
    """Where Spark ML may split a feature: between any two values, or at about every
    ``n_rows / n_bins``-th if there are more of them. ``values`` has ``n_rows`` or a sample's rows."""
    own, counts = np.unique(values[values != 0], return_counts=True)
    counts = counts.astype(float)
    if n_rows - counts.sum() > np.finfo(float).eps * n_rows * n_rows:  # the rest counts as zeros
        place = int(np.searchsorted(own, 0.0))
        own, counts = np.insert(own, place, 0.0), np.insert(counts, place, n_rows - counts.sum())
    middles = (own[:-1] + own[1:]) / 2.0
    if len(middles) < n_bins:
        return middles.tolist()
    stride = n_rows / n_bins
    cuts, target, before = [], stride, float(counts[0])
    for count, middle in zip(counts[1:].tolist(), middles.tolist()):
        now = before + count
        if abs(before - target) < abs(now - target):
            cuts.append(middle)
            target += stride
        before = now
    return cuts


def _cuts(rows: DataFrame, n: int, seed: int) -> list[list[float]]:
    """Cut points of every feature."""
    n_bins, share = min(BINS, n), min(1.0, max(CUT_ROWS, 10_000) / n)
    sample = rows if share == 1.0 else rows.sample(share, seed)

    def of_feature(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"feature": [key[0]], "cuts": [cut_points(frame["value"].to_numpy(), n * share, n_bins)]})

    each = sample.select(F.posexplode(vector_to_array("features")).alias("feature", "value"))
    found = each.groupBy("feature").applyInPandas(of_feature, "feature int, cuts array<double>").collect()
    return [list(r.cuts) for r in sorted(found, key=lambda r: r.feature)]


def _gini(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Impurity of counts by label (first axis), summed in Spark ML's order; 0 where there are none."""
    impurity, some = np.ones_like(total), np.where(total == 0, 1.0, total)
    for own in counts:
        share = own / some
        impurity -= share * share
    return np.where(total == 0, 0.0, impurity)


def best_split(bins: np.ndarray, labels: np.ndarray, n_labels: int) -> tuple[int, int] | None:
    """Feature and last bin of the left side with the largest gain, the first of equal ones; null
    if none has a gain. ``bins`` has a row of features per example."""
    n, width = bins.shape
    present, own = np.unique(labels, return_inverse=True)
    if len(present) < 2:
        return None
    size = int(bins.max()) + 1
    place = (own[:, None] * width + np.arange(width)) * size + bins
    counts = np.bincount(place.ravel(), minlength=len(present) * width * size)
    left = counts.reshape(len(present), width, size).cumsum(2)[:, :, :-1].astype(float)
    if not left.size:
        return None
    whole = np.bincount(own).astype(float)
    right = whole[:, None, None] - left
    n_left = left.sum(0)
    n_right = n - n_left
    impurity = _gini(whole, np.array(float(n)))
    gain = impurity - n_left / n * _gini(left, n_left) - n_right / n * _gini(right, n_right)
    gain = np.where((n_left < 1) | (n_right < 1) | (gain < 0), -np.inf, gain)
    best = int(gain.argmax())
    if not gain.flat[best] > 0:
        return None
    return divmod(best, size - 1)


def grow(bins: np.ndarray, labels: np.ndarray, n_labels: int, levels: int) -> dict[str, list[int]]:
    """A subtree of ``levels`` levels at most, as the lists of ``SUBTREE``."""
    feature, cut, child, label = [-1], [-1], [-1], [0]
    waiting = [(0, np.arange(len(labels)), levels)]
    while waiting:
        node, rows, left_levels = waiting.pop()
        own, own_labels = bins[rows], labels[rows]
        label[node] = int(np.bincount(own_labels, minlength=n_labels).argmax())
        found = best_split(own, own_labels, n_labels) if left_levels else None
        if found is None:
            continue
        feature[node], cut[node], child[node] = found[0], found[1], len(label)
        goes_left = own[:, found[0]] <= found[1]
        for side in (rows[goes_left], rows[~goes_left]):
            waiting.append((len(label), side, left_levels - 1))
            for column, empty in ((feature, -1), (cut, -1), (child, -1), (label, 0)):
                column.append(empty)
    return {"feature": feature, "cut": cut, "child": child, "label": label}


def _leaf_depths(top: DecisionTreeClassificationModel) -> list[int]:
    """Depth of each leaf, from the left; the printed tree is indented by it."""
    lines = top.toDebugString.split("\n")
    indents = [len(x) - len(x.lstrip()) for x in lines if x.lstrip().startswith("Predict:")]
    return [x - 2 for x in indents]


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _subtrees(inside: DataFrame, cuts: list[list[float]], depths: dict[int, int], n_labels: int) -> list:
    """A ``SUBTREE`` for each leaf of ``depths``, which has the levels that are left."""
    points = [np.array(c) for c in cuts]

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column(2))
            bins = np.stack([np.searchsorted(c, v) for c, v in zip(points, values.T)], 1).astype(np.uint8)
            packed = pa.array([row.tobytes() for row in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["leaf", "label", "bins"])

    def of_leaf(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        bins = np.frombuffer(b"".join(frame["bins"]), np.uint8).reshape(len(frame), len(points))
        grown = grow(bins, frame["label"].to_numpy(), n_labels, depths[int(key[0])])
        return pd.DataFrame({"leaf": [key[0]], **{k: [v] for k, v in grown.items()}})

    spark = inside.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = inside.filter(F.col("leaf").isin([float(k) for k in depths]))
    binned = rows.select("leaf", "label", vector_to_array("features")).mapInArrow(to_bins, "leaf double, label int, bins binary")
    # by number: few bytes, but much work
    return binned.repartition(parts, "leaf").groupBy("leaf").applyInPandas(of_leaf, SUBTREE).collect()


def fit_tree(train: DataFrame, label: str = BEAN_LABEL, seed: int = 0, depth: int = 30) -> Tree:
    """Grow a tree until its leaves are pure, by default as deep as Spark ML allows.

    ``train`` has a ``features`` vector and a label of any type. Like a model of Spark ML's, the
    tree itself is fetched, 20 bytes a node.
    """
    text = train.withColumn("label_text", F.col(label).cast("string"))
    indexer = StringIndexer(inputCol="label_text", outputCol="label_index").fit(text)
    rows = indexer.transform(text).select("features", "label_index")
    levels = min(depth, TOP)
    while True:
        top = DecisionTreeClassifier(
            labelCol="label_index", featuresCol="features", leafCol="__leaf", maxDepth=levels, maxBins=BINS, seed=seed
        ).fit(rows)
        tree = Tree(indexer.labels, top)
        if levels == depth:
            return tree
        inside = top.transform(rows).select(
            F.col("__leaf").alias("leaf"), F.col("label_index").cast("int").alias("label"), "features"
        )
        # one row per leaf of the top
        sizes = inside.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), (F.min("label") < F.max("label")).alias("mixed")).collect()
        mixed = [r for r in sizes if r.mixed]
        if all(r.n <= LEAF_ROWS for r in mixed):
            break
        levels = min(depth, levels + MORE)
    if not mixed:
        return tree
    at = _leaf_depths(top)
    cuts = _cuts(rows, sum(r.n for r in sizes), seed)
    grown = _subtrees(inside, cuts, {int(r.leaf): depth - at[int(r.leaf)] for r in mixed}, len(indexer.labels))
    begins = np.cumsum([0, *(len(r.label) for r in grown)])
    tree.roots = {int(r.leaf): int(b) for r, b in zip(grown, begins)}
    tree.feature = np.concatenate([np.array(r.feature, np.int32) for r in grown])
    tree.label = np.concatenate([np.array(r.label, np.int32) for r in grown])
    tree.child = np.concatenate([np.where(np.array(r.child) < 0, -1, np.array(r.child) + b).astype(np.int32) for r, b in zip(grown, begins)])
    tree.threshold = np.array([cuts[f][c] if f >= 0 else 0.0 for r in grown for f, c in zip(r.feature, r.cut)])
    return tree


def _below(tree: Tree):
    """Column function: features, leaf of the top and its prediction -> prediction of the whole tree."""
    feature, threshold, child, label = tree.feature, tree.threshold, tree.child, tree.label
    roots = np.full(max(tree.roots) + 1, -1)
    roots[list(tree.roots)] = list(tree.roots.values())

    @F.arrow_udf("double")
    def predict(features: pa.Array, leaf: pa.Array, prediction: pa.Array) -> pa.Array:
        out = prediction.to_numpy(zero_copy_only=False).copy()
        if not len(out):
            return pa.array(out, pa.float64())
        values, leaves = _matrix(features), leaf.to_numpy(zero_copy_only=False).astype(np.int64)
        node = np.where(leaves < len(roots), roots[np.minimum(leaves, len(roots) - 1)], -1)
        inner = np.flatnonzero((node >= 0) & (child[node] >= 0))
        while len(inner):
            at = node[inner]
            node[inner] = child[at] + ~(values[inner, feature[at]] <= threshold[at])
            inner = inner[child[node[inner]] >= 0]
        out[node >= 0] = label[node[node >= 0]]
        return pa.array(out, pa.float64())

    return predict


def score_tree(model: Tree, rows: DataFrame) -> DataFrame:
    """Rows with ``predicted_label``; no label column is needed."""
    scored = model.top.transform(rows)
    if model.roots:
        scored = scored.withColumn("prediction", _below(model)(vector_to_array("features"), F.col("__leaf"), F.col("prediction")))
    names = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=model.labels)
    return names.transform(scored).drop("features", "rawPrediction", "probability", "prediction", "__leaf")
