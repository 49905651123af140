"""Isolation Forest per drug, grown and scored by Spark tasks, the same wherever and however often it runs.

Nothing is drawn from a generator: every choice is a digest of what it is made for, so the forest is a table that
plain SQL can rebuild.

Samples: in every round the days of a drug stand in the order of a digest of (seed, drug, round, day), and each
stretch of `sample` days is one tree's sample. There are as many rounds as the trees need.
Growing: a node's digest of (seed, drug, tree, node) picks a feature that differs in the node and a cut between its
ends. Nodes are numbered as in a heap: 1 is the root, 2 k and 2 k + 1 stand below k. A group holds the samples of
a few trees only and grows them level by level.
Scoring: the days of a drug are cut into chunks, and each chunk meets the drug's trees in a
cogroup, so neither side of a group grows with the data. Path lengths add up as whole millionths.
"""

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import config
from casewatch.functions.numbers import round_half_even
from casewatch.operators.timeseries import FEATURES, by_day, by_drug
from casewatch.session import spread

TREES_PER_GROUP = 25
ROWS_PER_CHUNK = 4096
FEATURE_DIGITS = 6  # features enter with so many digits
SCORE_DIGITS = 9
UNITS = 1_000_000  # path lengths count in millionths
_EULER = 0.5772156649015329

TREE_SCHEMA = T.StructType(
    [
        T.StructField("drug", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("tree", T.IntegerType()),
        T.StructField("psi", T.IntegerType()),
        T.StructField("feature", T.ArrayType(T.IntegerType())),
        T.StructField("threshold", T.ArrayType(T.DoubleType())),
        T.StructField("size", T.ArrayType(T.IntegerType())),
    ]
)


def average_path(n):
    """Mean path length of an unsuccessful search in a binary search tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n


def path_units(n):
    """average_path() in whole millionths."""
    return round(average_path(n) * UNITS)


def depth_limit(psi):
    return math.ceil(math.log2(max(psi, 2)))


def node_choice(seed, drug, tree, node):
    """A whole number that picks the feature and a fraction in [0, 1) that places the cut."""
    digest = hashlib.sha256(f"{seed}/{drug}/{tree}/{node}".encode()).hexdigest()
    return int(digest[:8], 16), int(digest[8:20], 16) / 2.0**48


def grow_trees(points, owner, numbers, drug, seed):
    """Heap-numbered arrays (trees, nodes) of feature (-1: leaf), threshold and size.

    points: the samples of all trees; owner: index into `numbers`, the trees' own numbers, per point; all
    samples of a drug have the same size.
    """
    psi = len(points) // len(numbers)
    limit = depth_limit(psi)
    width = 2 << limit
    feature = np.full((len(numbers), width), -1, np.int32)
    threshold = np.zeros((len(numbers), width))
    size = np.zeros((len(numbers), width), np.int32)
    points, key = points, owner.astype(np.int64) * width + 1
    for level in range(limit + 1):
        order = np.argsort(key, kind="stable")
        points, key = points[order], key[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        nodes, counts = key[starts], np.diff(starts, append=len(key))
        size.flat[nodes] = counts
        if level == limit or not len(nodes):
            break
        low, high = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)
        usable = high > low
        n_usable = usable.sum(axis=1)
        inner = np.flatnonzero(n_usable)
        for i in inner:
            tree, node = divmod(int(nodes[i]), width)
            pick, part = node_choice(seed, drug, numbers[tree], node)
            f = np.flatnonzero(usable[i])[pick % n_usable[i]]
            feature.flat[nodes[i]] = f
            threshold.flat[nodes[i]] = low[i, f] + part * (high[i, f] - low[i, f])
        going = feature.flat[key] >= 0
        points, key = points[going], key[going]
        right = points[np.arange(len(key)), feature.flat[key]] > threshold.flat[key]
        key = key + key % width + right
    return feature, threshold, size


def total_paths(points, feature, threshold, size):
    """Whole millionths of the path length of every point, summed over trees."""
    units = np.array([path_units(n) for n in range(int(size.max(initial=0)) + 1)], np.int64)
    total, rows = np.zeros(len(points), np.int64), np.arange(len(points))
    for f, cut, n in zip(feature, threshold, size):
        node, depth = np.ones(len(points), np.int64), np.zeros(len(points), np.int64)
        while True:
            at = f[node]
            inner = at >= 0
            if not inner.any():
                break
            right = points[rows, np.maximum(at, 0)] > cut[node]
            node = np.where(inner, 2 * node + right, node)
            depth += inner
        total += depth * UNITS + units[n[node]]
    return total


def with_chunks(features):
    """Features as the forest takes them, the series length and the chunk a day is scored in."""
    rounded = {f: round_half_even(F.col(f), FEATURE_DIGITS) for f in FEATURES if f != "count"}
    return (
        features.withColumns(rounded)
        .withColumn("n_rows", F.count("*").over(by_drug()))
        .withColumn("chunk", F.floor((F.row_number().over(by_day()) - 1) / ROWS_PER_CHUNK).cast("int"))
    )


def samples(features, trees=config.FOREST_TREES, sample=config.FOREST_SAMPLE, seed=config.SEED):
    """(drug, date, n_rows, the five features) with the tree a day is drawn for, once per round.

    A tree has `sample` days, or all of a shorter series.
    """
    per_round = F.greatest(F.floor(F.col("n_rows") / sample), F.lit(1)).cast("int")
    rounds = F.explode(F.sequence(F.lit(0), (F.ceil(trees / per_round) - 1).cast("int")))
    drawn = features.select("drug", "date", "n_rows", *FEATURES, per_round.alias("per_round")).withColumn("round", rounds)
    order = F.sha2(F.concat_ws("/", F.lit(seed), "drug", "round", F.col("date").cast("string")), 256)
    turn = Window.partitionBy("drug", "round").orderBy(order, "date")
    slot = F.floor((F.row_number().over(turn) - 1) / sample).cast("int")
    placed = drawn.withColumn("slot", slot).withColumn("tree", F.col("round") * F.col("per_round") + F.col("slot"))
    return placed.filter((F.col("slot") < F.col("per_round")) & (F.col("tree") < trees)).drop("slot", "round", "per_round")


def _grow_group(seed):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf[list(FEATURES)].to_numpy(dtype=float)
        numbers, owner = np.unique(pdf["tree"].to_numpy(), return_inverse=True)
        arrays = grow_trees(points, owner, numbers.tolist(), key[0], seed)
        n_rows, psi = int(pdf["n_rows"].iloc[0]), len(points) // len(numbers)
        rows = [(key[0], n_rows, tree, psi, *(a[i] for a in arrays)) for i, tree in enumerate(numbers.tolist())]
        return pd.DataFrame(rows, columns=TREE_SCHEMA.names)

    return run


def grow_forest(features, trees=config.FOREST_TREES, sample=config.FOREST_SAMPLE, seed=config.SEED):
    """features: from with_chunks, to one row per (drug, tree)."""
    drawn = samples(features, trees, sample, seed)
    grouped = drawn.withColumn("tree_group", F.floor(F.col("tree") / TREES_PER_GROUP).cast("int"))
    return spread(grouped, "drug", "tree_group").groupBy("drug", "tree_group").applyInPandas(_grow_group(seed), TREE_SCHEMA)


def forest_nodes(forest):
    """One row per node that holds days: feature is the name of the column it cuts, null for a leaf."""
    names = F.array(*[F.lit(f) for f in FEATURES])
    each = F.posexplode(F.arrays_zip("feature", "threshold", "size")).alias("node", "n")
    inner = F.col("n.feature") >= 0
    return forest.select("drug", "tree", each).filter("n.size > 0").select(
        "drug",
        "tree",
        "node",
        F.when(inner, F.get(names, F.col("n.feature"))).alias("feature"),
        F.when(inner, F.col("n.threshold")).alias("threshold"),
        F.col("n.size").alias("size"),
    )


def _score_group(carried):
    def run(key: tuple, days: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        points = days[list(FEATURES)].to_numpy(dtype=float)
        units = path_units(int(trees["psi"].iloc[0])) if len(trees) else 0
        if units:
            arrays = [np.stack(trees[c].to_numpy()) for c in ("feature", "threshold", "size")]
            score = np.power(2.0, -(total_paths(points, *arrays) / (len(trees) * units)))
        else:
            score = np.full(len(days), 0.5)
        return days[carried].assign(anomaly_score=np.round(score, SCORE_DIGITS))

    return run


def isolation_scores(
    features, trees=config.FOREST_TREES, sample=config.FOREST_SAMPLE, seed=config.SEED
):
    """Add anomaly_score (0..1, higher is stranger) to a table prepared by with_chunks.

    `features` is read twice (growing and scoring): pass a staged table.
    """
    kept = [f for f in features.schema.fields if f.name not in ("n_rows", "chunk")]
    carried = [f.name for f in kept]
    forest = grow_forest(features, trees, sample, seed).withColumn(
        "chunk",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("n_rows") - 1) / ROWS_PER_CHUNK).cast("int"))),
    )
    schema = T.StructType([*kept, T.StructField("anomaly_score", T.DoubleType())])
    return (
        spread(features, "drug", "chunk")
        .groupBy("drug", "chunk")
        .cogroup(spread(forest, "drug", "chunk").groupBy("drug", "chunk"))
        .applyInPandas(_score_group(carried), schema)
    )


def forest_flags(scored, contamination=config.CONTAMINATION):
    """isolation_forest_score = score above the drug's contamination quantile; flag if > 0."""
    limit = F.percentile("anomaly_score", F.lit(1.0 - contamination)).over(by_drug())
    return (
        scored.withColumn("raw_forest_score", F.col("anomaly_score") - limit)
        .withColumn("isolation_forest_score", round_half_even(F.col("raw_forest_score"), 3))
        .withColumn("is_anomaly_isoforest", F.col("raw_forest_score") > 0)
    )
