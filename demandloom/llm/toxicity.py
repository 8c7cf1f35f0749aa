"""Toxicity as ordered severity grades: a cumulative-link model on word features.

P(grade <= k) = sigmoid(threshold_k - weights . x) with one weight per feature for all
thresholds. x marks which words, and which word beginnings of four and five letters, a text has;
beginnings carry over to inflected forms that the fit never saw. The weights carry an L1 penalty,
so most end at zero and long texts do not gather noise.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The fit sees at most this many labelled rows, those with the smallest hash.
SAMPLE_ROWS = 8_000
MIN_DOCUMENTS = 4
LEAST_G = 10.8  # a chance of one in a thousand
MAX_FEATURES = 4_000
PENALTY = 0.0002
ROUNDS = 600
BEGINNINGS = (4, 5)
ROWS_AT_ONCE = 1_000
_WORD = re.compile(r"\w+")


def features(text: str | None) -> set[str]:
    """Words of a text, and beginnings of its longer words with a ``-`` behind."""
    if not text:
        return set()
    words = set(_WORD.findall(text.lower()))
    return words.union(*({w[:n] + "-" for w in words if len(w) > n} for n in BEGINNINGS))


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: list[float]

    def severity(self, text: str | None) -> tuple[float, list[float]]:
        """Expected grade, and the probability of each grade."""
        # summed in the order of the names, so that equal texts get equal scores everywhere
        score = sum(self.weights[f] for f in sorted(features(text) & self.weights.keys()))
        below = [0.0, *(_sigmoid(t - score) for t in self.thresholds), 1.0]
        each = [float(b - a) for a, b in zip(below, below[1:])]
        return sum(k * p for k, p in enumerate(each)), each


def _g_test(toxic: int, count: int, n_toxic: int, n: int) -> float:
    """Log-likelihood ratio statistic of the 2 x 2 table of feature and toxicity."""
    total = 0.0
    for seen, rows, columns in (
        (toxic, count, n_toxic),
        (count - toxic, count, n - n_toxic),
        (n_toxic - toxic, n - count, n_toxic),
        (n - n_toxic - count + toxic, n - count, n - n_toxic),
    ):
        if seen:
            total += 2 * seen * math.log(seen * n / (rows * columns))
    return total


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit_words(texts: list[list[str]], grades: np.ndarray, n_grades: int) -> Model:
    """Proximal gradient with momentum on the mean negative log-likelihood.

    Only features that are more frequent above grade 0 take part (by a G test), and weights do
    not fall below zero: a text is toxic for what it has, not clean for what else it has.
    """
    seen = Counter(w for words in texts for w in words)
    toxic = Counter(w for words, g in zip(texts, grades) if g for w in words)
    n, n_toxic = len(texts), int((grades > 0).sum())
    picked = {
        w: g
        for w, count in seen.items()
        if count >= MIN_DOCUMENTS
        and toxic[w] * n > count * n_toxic
        and (g := _g_test(toxic[w], count, n_toxic, n)) >= LEAST_G
    }
    vocabulary = sorted(sorted(picked, key=lambda w: (-picked[w], w))[:MAX_FEATURES])
    place = {w: i for i, w in enumerate(vocabulary)}
    columns = [[place[w] for w in words if w in place] for words in texts]
    lengths = np.array([len(c) for c in columns], np.int64)
    rows = np.repeat(np.arange(n), lengths)
    columns = np.array([c for own in columns for c in own], np.int64)
    size = len(vocabulary)
    weights, cuts = np.zeros(size), np.zeros(n_grades - 1)
    for k in range(n_grades - 1):  # where no feature counts
        share = np.clip(np.mean(grades <= k), 1e-3, 1 - 1e-3)
        cuts[k] = np.log(share / (1 - share))
    cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(n_grades - 1))

    def gradient(weights, cuts):
        score = np.bincount(rows, weights[columns], n)
        edges = np.concatenate([np.full((n, 1), -np.inf), cuts[None, :] - score[:, None], np.full((n, 1), np.inf)], 1)
        upper, lower = _sigmoid(edges[np.arange(n), grades + 1]), _sigmoid(edges[np.arange(n), grades])
        width = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / width, lower * (1 - lower) / width
        by_score = (up - low) / n
        by_cut = np.array(
            [(low[grades == k + 1].sum() - up[grades == k].sum()) / n for k in range(n_grades - 1)]
        )
        return np.bincount(columns, by_score[rows], size), by_cut, -np.log(width).mean()

    # The curvature is at most that of X'X / 4, with the cuts as one more column each.
    probe, curvature = np.ones(size + 1), 1.0
    for _ in range(30):
        through = np.bincount(rows, probe[columns], n) + probe[-1]
        probe = np.append(np.bincount(columns, through[rows], size), through.sum()) / n
        curvature = float(np.linalg.norm(probe))
        probe /= curvature
    step, momentum, loss = 4.0 / (1.2 * curvature), 1.0, np.inf
    look_w, look_c = weights, cuts
    for _ in range(ROUNDS):
        by_w, by_c, now = gradient(look_w, look_c)
        new_w = np.maximum(look_w - step * (by_w + PENALTY), 0)
        new_c = np.maximum.accumulate(look_c - step * by_c + 1e-6 * np.arange(n_grades - 1))
        if now > loss:  # overshot: momentum starts anew
            momentum = 1.0
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look_w = new_w + (momentum - 1) / after * (new_w - weights)
        look_c = np.maximum.accumulate(new_c + (momentum - 1) / after * (new_c - cuts))
        weights, cuts, momentum, loss = new_w, new_c, after, now
    kept = {w: float(weights[i]) for w, i in place.items() if weights[i] != 0.0}
    return Model(kept, [float(c) for c in cuts])


def fit(
    docs: DataFrame,
    grades: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    grade: str = "grade",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """The model from ``grades`` (key, grade 0, 1, 2, ...) of some of ``docs``.

    At most ``sample_rows`` grades take part, those whose key has the smallest hash, and at most
    as many rows of ``docs`` (repeated keys). The bounded grades travel to the texts; texts become
    feature sets where they lie; one task fits, and only non-zero weights reach the driver. Null
    texts count as empty; null keys and null or negative grades are left out. Without rows the
    model says grade 0 always, with one grade only it leans to that grade.
    """
    chosen = (
        grades.select(F.col(key).alias("__key"), F.col(grade).cast("int").alias("grade"))
        .filter("grade >= 0 and __key is not null")
        .withColumn("place", F.xxhash64("__key"))
        .orderBy("place", "grade")
        .limit(sample_rows)
    )
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("text")).join(F.broadcast(chosen), "__key")

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sorted(features(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets, pa.list_(pa.string())), batch.column(1), batch.column(2)], ["own", "grade", "place"]
            )

    sample = (
        rows.select("text", "grade", "place")
        .mapInArrow(to_features, "own array<string>, grade int, place long")
        .orderBy("place", "grade", "own")
        .limit(sample_rows)
        .select("own", "grade")
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [x for x in frames if len(x)]
        if not got:
            return
        whole = pd.concat(got)
        labels = whole["grade"].to_numpy()
        model = fit_words([list(w) for w in whole["own"]], labels, int(labels.max()) + 1)
        cuts = pd.DataFrame({"feature": [None] * len(model.thresholds), "value": model.thresholds})
        weights = pd.DataFrame({"feature": list(model.weights), "value": list(model.weights.values())})
        parts = [x for x in (cuts, weights) if len(x)]
        if parts:
            yield pd.concat(parts)

    parts = sample.mapInPandas(run, "feature string, value double").collect()
    cuts = sorted(r["value"] for r in parts if r["feature"] is None)
    return Model({r["feature"]: r["value"] for r in parts if r["feature"] is not None}, cuts)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected grade) and ``grade_probabilities``, row by row.

    Null and empty texts have no words and get the model's base severity. Repeated rows stay;
    an empty table gives an empty table; all columns of ``docs`` are kept, and columns that
    already have one of the two names are replaced.
    """
    names = [c for c in docs.columns if c not in ("severity", "grade_probabilities")]
    kept = docs.select(*names)
    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("severity", T.DoubleType()),
            T.StructField("grade_probabilities", T.ArrayType(T.DoubleType())),
        ]
    )
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                found = [model.severity(t) for t in batch.column(at).to_pylist()]
                out = [batch.column(k) for k in range(len(names))]
                out += [
                    pa.array([x for x, _ in found], pa.float64()),
                    pa.array([p for _, p in found], pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(out, schema.names)

    return kept.mapInArrow(run, schema)
