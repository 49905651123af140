"""Gap filling, z-scores, warm-up, Holt-Winters, Isolation Forest."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casewatch.operators import holt_winters as hw
from casewatch.operators import isolation_forest as forest
from casewatch.operators import timeseries as ts
from casewatch.operators.counts import daily_counts
from casewatch.plans import detection
from casewatch.sources.workspace import staged

START = dt.date(2024, 1, 1)
SCHEMA = "drug string, date date, count bigint"


def series(spark, **by_drug):
    rows = [
        (drug, START + dt.timedelta(days=i), int(v))
        for drug, values in by_drug.items()
        for i, v in (values.items() if isinstance(values, dict) else enumerate(values))
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_gap_fill_per_drug(spark):
    got = ts.gap_fill(series(spark, a={0: 5, 3: 2}, b={10: 1, 12: 4})).orderBy("drug", "date").collect()
    assert [(r.drug, (r.date - START).days, r["count"]) for r in got] == [
        ("a", 0, 5),
        ("a", 1, 0),
        ("a", 2, 0),
        ("a", 3, 2),
        ("b", 10, 1),
        ("b", 11, 0),
        ("b", 12, 4),
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.tuples(st.sampled_from("abc"), st.integers(0, 60)), st.integers(1, 9), min_size=1, max_size=25
    )
)
def test_gap_fill_is_dense_and_keeps_sums(spark, counted):
    df = spark.createDataFrame([(k, START + dt.timedelta(days=d), n) for (k, d), n in counted.items()], SCHEMA)
    got = ts.gap_fill(df).toPandas()
    for drug, part in got.groupby("drug"):
        given_days = [d for (k, d) in counted if k == drug]
        assert len(part) == max(given_days) - min(given_days) + 1 == part["date"].nunique()
        assert part["count"].sum() == sum(n for (k, _), n in counted.items() if k == drug)


def scored(spark, **by_drug):
    df = ts.with_zscore(ts.with_expected(ts.gap_fill(series(spark, **by_drug))))
    return df.orderBy("drug", "date").toPandas()


def test_zscore_matches_pandas(spark):
    values = np.random.default_rng(1).poisson(5, 120)
    got = scored(spark, a=values)
    y = pd.Series(values, dtype=float)
    residual = y - y.rolling(7, min_periods=1).mean()
    spread = residual.rolling(30, min_periods=7).std().replace(0, np.nan)
    expected = ((residual - residual.rolling(30, min_periods=7).mean()) / spread).fillna(0)
    np.testing.assert_allclose(got["raw_z"], expected, atol=1e-9)
    assert (got["raw_z"][:6] == 0).all()


def test_constant_series_has_no_flags(spark):
    table = detection.anomaly_table(series(spark, a=[5] * 70)).toPandas()
    assert (table["expected_count"] == 5).all() and (table["residual"] == 0).all()
    assert (table["zscore"] == 0).all() and not table["is_anomaly_high_confidence"].any()


def test_short_series_uses_the_trailing_mean(spark):
    values = np.random.default_rng(2).poisson(9, 59)
    fitted = hw.holt_winters(series(spark, a=values))
    assert fitted.filter(F.col("fitted").isNotNull()).count() == 0
    got = ts.with_expected(fitted, "fitted").orderBy("date").toPandas()
    np.testing.assert_allclose(got["expected"], pd.Series(values).rolling(7, min_periods=1).mean())


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(2.5,), (2.5000001,), (-2.6,)], "raw_z double")
    assert [r[0] for r in df.select(ts.zscore_flag()).collect()] == [False, True, True]


def test_warmup_is_by_position(spark):
    df = ts.gap_fill(series(spark, a=range(50))).withColumn("f", F.lit(True))
    got = [r[0] for r in df.select(ts.after_warmup(F.col("f")), "date").orderBy("date").collect()]
    assert got == [False] * 45 + [True] * 5


def test_monday_is_zero(spark):
    row = ts.forest_features(series(spark, a=[1])).first()  # 2024-01-01 was a Monday
    assert (row.dow_sin, row.dow_cos) == (0.0, 1.0)


def test_counts_need_seriousness_and_count_each_drug_once(spark):
    day = dt.date(2022, 3, 1)
    rows = [("1", "a", day, "1"), ("1", "a", day, "1"), ("1", "b", day, "1"), ("2", "a", day, "2")]
    df = spark.createDataFrame(rows, "safetyreportid string, drug string, date date, serious string")
    assert {(r.drug, r["count"]) for r in daily_counts(df).collect()} == {("a", 1), ("b", 1)}


# ---- Holt-Winters


def plain_fit(y, alpha, beta, gamma, level, trend, season):
    season, out = list(season), []
    for value in y:
        out.append(level + trend + season[0])
        new = alpha * (value - season[0]) + (1 - alpha) * (level + trend)
        season = season[1:] + [gamma * (value - level - trend) + (1 - gamma) * season[0]]
        level, trend = new, beta * (new - level) + (1 - beta) * trend
    return np.array(out)


def test_fixed_fit_is_the_recursion():
    y = np.random.default_rng(3).poisson(20, 100).astype(float)
    level, trend, season = hw.heuristic_start(y)
    np.testing.assert_allclose(
        hw.fixed_fit(y, 0.3, 0.05, 0.1), plain_fit(y, 0.3, 0.05, 0.1, level, trend, season), atol=1e-9
    )


def test_estimated_start_beats_any_nearby_start():
    rng = np.random.default_rng(4)
    y = rng.poisson(20 + 6 * np.sin(np.arange(140) * 2 * np.pi / 7)).astype(float)
    weights = np.array([[0.2, 0.05, 0.1]])
    sse, start, fit = hw._profile(y, weights, 7)
    trend, season = start[0][0], start[0][1:]
    np.testing.assert_allclose(fit[0], plain_fit(y, *weights[0], 0.0, trend, season), atol=1e-4)
    for _ in range(30):
        shake = rng.normal(scale=0.5, size=8)
        other = plain_fit(y, *weights[0], 0.0, trend + shake[0] / 50, season + shake[1:])
        assert ((y - other) ** 2).sum() >= sse[0] - 1e-6


def test_estimated_fit_beats_a_dense_grid():
    rng = np.random.default_rng(5)
    y = np.cumsum(rng.normal(size=200)) + 3 * np.sin(np.arange(200) * 2 * np.pi / 7) + 50
    best = ((y - hw.estimated_fit(y)) ** 2).sum()
    grid = [(a, b, c) for a in np.linspace(0.05, 1, 12) for b in (0, 0.02, 0.1) if b <= a for c in (0, 0.05, 0.1) if c <= 1 - a]
    sse, _, _ = hw._profile(y, np.array(grid), 7)
    assert best <= sse.min() * 1.001


def test_grid_fit_is_the_best_of_its_recursions():
    y = np.random.default_rng(9).poisson(20 + 6 * np.sin(np.arange(90) * 2 * np.pi / 7)).astype(float)
    start = hw.heuristic_start(y)
    errors = {tuple(w): ((y - plain_fit(y, *w, *start)) ** 2).sum() for w in hw.grid()}
    weights, fitted = hw.grid_fit(y)
    assert errors[tuple(weights)] == min(errors.values())
    np.testing.assert_allclose(fitted, plain_fit(y, *weights, *start), atol=1e-9)


def test_equal_errors_take_the_smaller_weights():
    weights, fitted = hw.grid_fit(np.tile([1.0, 2, 3, 4, 5, 6, 7], 12))
    assert tuple(weights) == min(map(tuple, hw.grid())) and fitted[20] == 7


@pytest.mark.parametrize("seed", range(5))
def test_refining_is_never_worse_than_the_grid(seed):
    rng = np.random.default_rng(seed)
    y = rng.poisson(rng.uniform(0.5, 30), 120).astype(float)
    assert ((y - hw.estimated_fit(y)) ** 2).sum() <= ((y - hw.grid_fit(y)[1]) ** 2).sum() + 1e-9


def test_season_and_trend_are_followed_exactly():
    t = np.arange(140)
    y = 10 + 0.5 * t + np.tile([0, 3, 1, -2, 4, -5, -1], 20)
    np.testing.assert_allclose(hw.estimated_fit(y.astype(float)), y, atol=1e-3)


# ---- Isolation Forest


def forest_table(spark, df):
    features = staged(forest.with_chunks(ts.forest_features(ts.gap_fill(df))), "features")
    return forest.forest_flags(forest.isolation_scores(features))


def test_spike_ranks_first_and_share_is_bounded(spark):
    rng = np.random.default_rng(6)
    values = rng.poisson(5, 400)
    values[200] = 90
    got = forest_table(spark, series(spark, a=values, b=rng.poisson(2, 300))).toPandas()
    for _, part in got.groupby("drug"):
        assert math.isclose(part["is_anomaly_isoforest"].mean(), 0.03, abs_tol=0.01)
        assert part["anomaly_score"].between(0, 1).all()
    a = got[got["drug"] == "a"]
    assert (a.loc[a["anomaly_score"].idxmax(), "date"] - START).days == 200
    limit = np.percentile(a["anomaly_score"], 97)
    np.testing.assert_allclose(a["raw_forest_score"], a["anomaly_score"] - limit, atol=1e-12)


def test_forest_does_not_depend_on_partitioning(spark, monkeypatch):
    df = series(spark, a=np.random.default_rng(7).poisson(5, 600))
    before = forest_table(spark, df).orderBy("date").toPandas()["anomaly_score"]
    monkeypatch.setattr(forest, "ROWS_PER_CHUNK", 100)
    monkeypatch.setattr(forest, "TREES_PER_GROUP", 3)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        after = forest_table(spark, df.repartition(5)).orderBy("date").toPandas()["anomaly_score"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    np.testing.assert_allclose(before, after)


def plain_tree(points, drug, tree, seed):
    """One tree by recursion: node to (feature, cut, size)."""
    out = {}

    def add(rows, node, level):
        out[node] = (None, None, len(rows))
        usable = [f for f in range(points.shape[1]) if len(rows) and points[rows, f].max() > points[rows, f].min()]
        if level < forest.depth_limit(len(points)) and usable:
            pick, part = forest.node_choice(seed, drug, tree, node)
            f = usable[pick % len(usable)]
            low, high = points[rows, f].min(), points[rows, f].max()
            cut = low + part * (high - low)
            out[node] = (f, cut, len(rows))
            add([r for r in rows if points[r, f] <= cut], 2 * node, level + 1)
            add([r for r in rows if points[r, f] > cut], 2 * node + 1, level + 1)

    add(list(range(len(points))), 1, 0)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 200])
def test_trees_and_paths_match_a_plain_recursion(n):
    rng = np.random.default_rng(8)
    points = np.round(rng.normal(size=(2 * n, 5)), 1)
    points[:, 4] = 0
    owner = rng.permutation(np.repeat([0, 1], n))
    feature, threshold, size = forest.grow_trees(points, owner, [3, 8], "a", 42)
    total = np.zeros(2 * n, int)
    for i, number in enumerate((3, 8)):
        tree = plain_tree(points[owner == i], "a", number, 42)
        told = {node: v for node, v in tree.items() if v[2]}
        for node in range(feature.shape[1]):
            f, cut, held = told.get(node, (None, None, 0))
            assert size[i, node] == held and feature[i, node] == (-1 if f is None else f)
            assert f is None or threshold[i, node] == cut
        for r, x in enumerate(points):
            node, depth = 1, 0
            while tree[node][0] is not None:
                node, depth = 2 * node + (x[tree[node][0]] > tree[node][1]), depth + 1
            total[r] += depth * forest.UNITS + forest.path_units(tree[node][2])
    assert (forest.total_paths(points, feature, threshold, size) == total).all()


@pytest.mark.parametrize("days, per_tree", [(10, 10), (256, 256), (600, 256)])
def test_samples_are_disjoint_within_a_round(spark, days, per_tree):
    features = forest.with_chunks(ts.forest_features(ts.gap_fill(series(spark, a=range(1, days + 1)))))
    drawn = forest.samples(features).select("tree", "date").toPandas()
    assert set(drawn["tree"]) == set(range(100)) and (drawn.groupby("tree").size() == per_tree).all()
    per_round = max(1, days // 256)
    assert not drawn.assign(round=drawn["tree"] // per_round).duplicated(["round", "date"]).any()


def test_forest_as_a_table_of_nodes(spark):
    features = forest.with_chunks(ts.forest_features(ts.gap_fill(series(spark, a=range(1, 300)))))
    nodes = forest.forest_nodes(forest.grow_forest(features, trees=4)).toPandas()
    sizes = nodes.set_index(["tree", "node"])["size"]
    for r in nodes.itertuples():
        if r.feature is not None:
            assert sizes.get((r.tree, 2 * r.node), 0) + sizes.get((r.tree, 2 * r.node + 1), 0) == r.size
    assert (nodes[nodes["node"] == 1]["size"] == 256).all()


def test_average_path():
    assert forest.average_path(1) == 0 and forest.average_path(2) == 1
    assert forest.average_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_anomaly_table_shape_and_identities(spark, folder):
    from casewatch.plans import registry

    got = registry.QUERIES["anomaly_table"](spark, folder).toPandas()
    assert list(got.columns) == list(detection.COLUMNS)
    both = got["is_anomaly_zscore"] & got["is_anomaly_isoforest"]
    assert (got["is_anomaly_high_confidence"] == both).all()
    np.testing.assert_allclose(got["residual"], (got["count"] - got["expected_count"]).round(2), atol=1e-9)
    first = got.sort_values("date").groupby("drug").head(45)
    assert not first[["is_anomaly_zscore", "is_anomaly_isoforest"]].any().any()
