"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) over login features.

Split so that no step grows with the table except two aggregations and a join:

* training rows: the trees need trees x 256 rows in all, chosen by hash of id;
* growing: one small group per tree;
* scoring: each *distinct* feature vector once, its row count kept as a weight,
  from which the cut-off and scale of the scores follow exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.operators.intel import hint_if_small
from duskwatch.schemas import FEATURE_COLUMNS
from duskwatch.session import materialize
from duskwatch.settings import Settings

_EULER = 0.5772156649015329
_NODES = "tree int, node int, feature int, threshold double, left int, right int, depth int, size int"
_UNIT = float(2 ** 63)


def mean_path(n):
    """Average path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    many = 2 * (np.log(np.maximum(n - 1, 1)) + _EULER) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def _unit_hash(*columns):
    """Uniform in [0, 1), from a hash: the same on any cluster and partitioning."""
    return F.abs(F.shiftright(F.xxhash64(*columns), 1).cast("double")) * 2 / _UNIT


def training_rows(features: DataFrame, n: int, settings: Settings) -> DataFrame:
    """(tree, id, features): ``forest_sample`` rows drawn without replacement for each tree."""
    trees, size = settings.forest_trees, min(settings.forest_sample, n)
    pool = min(n, 2 * trees * size)
    # A hash of the id thins the table to about ``pool`` rows (all of them, where there are no more), so what is drawn from
    # stays small however large the table is. Every tree then takes the rows with its own smallest hashes.
    rows = features.select("id", *FEATURE_COLUMNS).filter(_unit_hash("id", F.lit(settings.seed)) <= pool / n)
    # The threshold only thins what is ranked: 2 x + 64 expected rows leave ``size`` of them beyond doubt (grow_forest checks).
    drawn = (rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
             .withColumn("_h", _unit_hash("id", "tree", F.lit(settings.seed)))
             .filter(F.col("_h") <= min(1.0, (2 * size + 64) / pool)))
    ranked = drawn.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("_h", "id")))
    return ranked.filter(F.col("_r") <= size).select("tree", "id", *FEATURE_COLUMNS)


def _grow(seed: int, sample: int):
    limit = math.ceil(math.log2(max(sample, 2)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) != sample:
            raise ValueError(f"a tree got {len(pdf)} of {sample} rows")
        pdf = pdf.sort_values("id")
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        x = pdf[FEATURE_COLUMNS].to_numpy(dtype=float)
        nodes, todo = [[-1, 0.0, 0, 0, 0, len(x)]], [(0, np.arange(len(x)), 0)]
        while todo:
            at, members, depth = todo.pop()
            inside = x[members]
            low, high = inside.min(axis=0), inside.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(members) <= 1 or len(usable) == 0:
                continue
            feature = int(rng.choice(usable))
            cut = float(rng.uniform(low[feature], high[feature]))
            goes_left = inside[:, feature] <= cut
            children = []
            for part in (members[goes_left], members[~goes_left]):
                children.append(len(nodes))
                nodes.append([-1, 0.0, len(nodes), len(nodes), depth + 1, len(part)])
                todo.append((children[-1], part, depth + 1))
            nodes[at] = [feature, cut, children[0], children[1], depth, len(members)]
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "depth", "size"])
        out.insert(0, "node", range(len(out)))
        out.insert(0, "tree", tree)
        return out
    return grow


def grow_forest(samples: DataFrame, n: int, settings: Settings) -> DataFrame:
    """The node table: at most trees x (2 x sample - 1) rows."""
    size = min(settings.forest_sample, n)
    return samples.groupBy("tree").applyInPandas(_grow(settings.seed, size), _NODES)


def _flatten(nodes: pd.DataFrame, sample: int) -> dict:
    """Node table as flat arrays, so that all trees are walked at once."""
    nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
    sizes = nodes.groupby("tree")["node"].size()
    start = sizes.cumsum().shift(fill_value=0)
    offset = nodes["tree"].map(start).to_numpy()
    leaf = nodes["feature"].to_numpy() < 0
    own = np.arange(len(nodes))
    return {
        "roots": start.to_numpy(),
        "feature": np.where(leaf, 0, nodes["feature"].to_numpy()),
        "threshold": nodes["threshold"].to_numpy(),
        "left": np.where(leaf, own, nodes["left"].to_numpy() + offset),
        "right": np.where(leaf, own, nodes["right"].to_numpy() + offset),
        "path": nodes["depth"].to_numpy() + mean_path(nodes["size"].to_numpy()),
        "depth": int(nodes["depth"].max()),
        "scale": float(mean_path(sample)),
    }


def _walk(forest: dict, x: np.ndarray) -> np.ndarray:
    at = np.broadcast_to(forest["roots"], (len(x), len(forest["roots"])))
    rows = np.arange(len(x))[:, None]
    for _ in range(forest["depth"]):
        goes_left = x[rows, forest["feature"][at]] <= forest["threshold"][at]
        at = np.where(goes_left, forest["left"][at], forest["right"][at])
    return np.power(2.0, -forest["path"][at].mean(axis=1) / forest["scale"])


def score_vectors(vectors: DataFrame, nodes: DataFrame, sample: int) -> DataFrame:
    """Add ``score`` (in (0, 1), larger = more isolated) to rows of feature columns."""
    spark = vectors.sparkSession
    # bounded by trees x (2 x sample - 1) nodes, whatever the table's size
    forest = spark.sparkContext.broadcast(_flatten(nodes.toPandas(), sample))

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(np.concatenate([_walk(forest.value, x[i:i + 2048]) for i in range(0, len(x), 2048)])
                         if len(x) else np.empty(0))

    return vectors.withColumn("score", score(*FEATURE_COLUMNS))


_BINS = 4096


def weighted_percentile(rows: DataFrame, p: float) -> float | None:
    """The exact ``p``-quantile of ``rows`` (value, weight), between neighbours by linear interpolation; null if there are none.

    A value's place is looked for in a histogram of ``_BINS`` bins over the range that holds it, and that bin is the next range, until
    at most ``_BINS`` different values are in it. So each pass is a partial aggregate, and no task or driver holds more than a histogram.
    """
    rows = materialize(rows.groupBy("value").agg(F.sum("weight").alias("weight")), "weighted-values")
    total = rows.agg(F.sum("weight")).first()[0]
    if not total:
        return None
    place = p * (total - 1)
    rank = math.floor(place)
    inside, behind = rows, 0  # behind: weight of all values before this range
    while True:
        low, high, n = inside.agg(F.min("value"), F.max("value"), F.count("*")).first()
        if n <= _BINS:
            break
        width = (high - low) / _BINS
        spot = F.least(F.floor((F.col("value") - low) / width), F.lit(_BINS - 1)) if width > 0 else (F.col("value") > low).cast("bigint")
        for found in sorted(inside.groupBy(spot.cast("bigint").alias("bin")).agg(F.sum("weight").alias("weight")).collect()):
            if behind + found["weight"] > rank:
                break
            behind += found["weight"]
        inside = inside.filter(spot == found["bin"])
    for value, weight in sorted(map(tuple, inside.select("value", "weight").collect())):
        behind += weight
        if behind > rank:
            break
    if place == rank or behind > rank + 1:
        return value
    after = rows.filter(F.col("value") > value).agg(F.min("value")).first()[0]
    return (rank + 1 - place) * value + (place - rank) * after


def train_and_score(features: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Features plus ``anomaly_score`` in [0, 1] and ``is_anomaly``.

    With fewer than ``forest_min_rows`` logins nothing is scored (0.0, not anomalous).
    """
    features = materialize(features, "features")
    n = features.count()
    if n < settings.forest_min_rows:
        return features.withColumn("anomaly_score", F.lit(0.0)).withColumn("is_anomaly", F.lit(False))
    nodes = grow_forest(training_rows(features, n, settings), n, settings)
    vectors = features.groupBy(*FEATURE_COLUMNS).agg(F.count("*").alias("weight"))
    scored = materialize(score_vectors(vectors, nodes, min(settings.forest_sample, n)), "scored-vectors")
    # Weighted by row count these are the statistics over all rows. Normality is -score: the cut
    # is its 100 c-th percentile, and only what lies strictly below is anomalous.
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    cut = weighted_percentile(scored.select((-F.col("score")).alias("value"), "weight"), settings.contamination)
    scored = scored.select(*FEATURE_COLUMNS,
                           ((F.col("score") - low) / (high - low + 1e-9)).alias("anomaly_score"),
                           (-F.col("score") < cut).alias("is_anomaly"))
    # A common vector may make up much of the table; broadcast when counted small, else AQE splits it.
    return features.join(hint_if_small(scored, settings.max_broadcast_rows), FEATURE_COLUMNS)
