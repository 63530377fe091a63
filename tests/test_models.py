
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from conftest import at
from pyspark.sql import functions as F

from millwatch.functions.sensors import feature_names, normalise_values, single_reading_features
from millwatch.operators import clustering as cl
from millwatch.operators import describe as ds
from millwatch.operators import episodes as ep
from millwatch.operators import features as ft
from millwatch.operators import registry
from millwatch.operators import scoring as sc
from millwatch.plans import on_models
from millwatch.plans import train as tr
from millwatch.schemas import CLUSTERS, VERSIONS
from millwatch.sources import tables


def features(df):
    linked = ep.link_episodes(ft.only_failing_values(df))
    sensors = ft.failing_sensors(df)
    rows = ft.episode_features(linked, sensors).collect()
    return {(r["failure_id"], r["feature"]): r["value"] for r in rows}


def test_features_of_missing_and_partial_sensors(make_readings):
    df = make_readings(
        [
            ("a", 0, 1, {"Sensor 1": 1.0, "Sensor 2": 4.0, "Load": 9.0}),
            ("a", 1, 1, {"Sensor 1": 3.0}),
            ("a", 2, 1, {"Sensor 1": 3.0}),
            ("a", 3, 0, {"Sensor 9": 3.0}),
            ("b", 0, 1, {"Sensor 1": 2.0}),
        ]
    )
    got = features(df)
    assert got[(0, "Sensor 1_std")] == pytest.approx(np.std([1, 3, 3]))
    assert (got[(0, "Sensor 2_mean")], got[(0, "Sensor 2_std")]) == (4.0, 0.0)
    assert got[(0, "duration")] == 3.0
    assert [got[(4, f"Sensor 2_{s}")] for s in ("mean", "std", "min", "max")] == [0.0] * 4
    assert not any("Load" in f or "Sensor 9" in f for _, f in got)


def test_feature_order_is_lexicographic():
    names = feature_names(["Sensor 2", "Sensor 10"])
    assert names[0] == "Sensor 10_mean" and names[4] == "Sensor 2_mean" and names[-1] == "duration"


@pytest.mark.parametrize(
    ("names", "expected"),
    [
        (["S_mean", "S_std", "S_min", "S_max", "duration"], [5.0, 0.0, 5.0, 5.0, 0.0]),
        (["T_mean", "T_max"], [0.0, 0.0]),
        (["S_std", "S_max"], [0.0, 0.0]),
        (["S_last", "S", "a_b_c"], [5.0, 5.0, 7.0]),
        (["S_mean_x"], [0.0]),
    ],
)
def test_single_reading_features(spark, names, expected):
    row = spark.range(1).select(F.create_map(F.lit("S"), F.lit(5.0), F.lit("a_b"), F.lit(7.0)).alias("v"))
    assert row.select(F.array(*single_reading_features(names, F.col("v")))).first()[0] == expected


def test_values_as_json_text(spark):
    df = spark.createDataFrame([('{"Sensor 1": 2}',)], "values string")
    assert normalise_values(df).first()["values"] == {"Sensor 1": 2.0}


def points(spark, rows):
    return spark.createDataFrame(
        [(i, list(map(float, x))) for i, x in enumerate(rows)], "failure_id bigint, features array<double>"
    )


def test_scaler_keeps_constant_features(spark):
    mean, scale = cl.fit_scaler(points(spark, [[1, 5], [3, 5]]))
    assert (mean, scale) == ([2.0, 5.0], [1.0, 1.0])
    applied = cl.scale_vectors(points(spark, [[4, 9]]), mean, scale)
    assert applied.first()["features"] == [2.0, 4.0]


@pytest.mark.parametrize("width", [4, 100])
def test_nearest_matches_numpy_at_any_width(spark, width):
    rng = np.random.default_rng(1)
    x, centres = rng.normal(size=(50, width)), rng.normal(size=(5, width))
    mean, scale = rng.normal(size=width), rng.uniform(1, 2, width)
    rows = cl.assign(points(spark, x), centres.tolist(), "features", mean.tolist(), scale.tolist())
    away = (((x - mean) / scale)[:, None, :] - centres[None]) ** 2
    for r in rows.collect():
        squares = away[int(r["failure_id"])].sum(axis=1)
        assert r["cluster_id"] == squares.argmin()
        assert r["sq_distance"] == pytest.approx(squares.min())


@pytest.mark.parametrize("width", [4, 100])
def test_unusable_vectors_have_no_cluster(spark, width):
    rows = [None, [None, *[0.0] * (width - 1)], [float("nan"), *[0.0] * (width - 1)], [0.0] * (width - 1), [0.0] * width]
    df = spark.createDataFrame(list(enumerate(rows)), "failure_id bigint, features array<double>")
    found = {r["failure_id"]: r["cluster_id"] for r in cl.assign(df, [[1.0] * width, [0.5] * width]).collect()}
    assert found == {0: None, 1: None, 2: None, 3: None, 4: 1}


def test_ties_go_to_the_lower_cluster(spark):
    df = points(spark, [[0.0]])
    assert cl.assign(df, [[1.0], [-1.0]]).first()["cluster_id"] == 0


def test_lloyd_lowers_the_cost_and_keeps_empty_clusters(spark):
    rng = np.random.default_rng(2)
    df = points(spark, np.concatenate([rng.normal(0, 1, (30, 2)), rng.normal(8, 1, (30, 2))]))
    init = [[0.0, 0.0], [1.0, 1.0], [900.0, 900.0]]

    def cost(centroids):
        return cl.assign(df, centroids).agg(F.sum("sq_distance")).first()[0]

    after = cl.lloyd(df, init, 4)
    assert cost(after) < cost(init) and after[2] == [900.0, 900.0]


def test_kmeans_is_repeatable_and_complete(spark):
    rng = np.random.default_rng(3)
    df = points(spark, rng.normal(size=(60, 3)))
    first, second = cl.fit_kmeans(df), cl.fit_kmeans(df)
    assert first == second
    sizes = cl.cluster_sizes(cl.assign(df, first), 3).collect()
    assert sum(r["size"] for r in sizes) == 60


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_silhouette_matches_brute_force(spark, block_rows):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 3))
    labels = [0] * 25 + [1] * 14 + [2]
    df = spark.createDataFrame(
        [(i, c, v.tolist()) for i, (c, v) in enumerate(zip(labels, x, strict=True))],
        "failure_id bigint, cluster_id int, features array<double>",
    )
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    scores = []
    for i, own in enumerate(labels):
        groups = {c: [d[i, j] for j in range(40) if labels[j] == c and j != i] for c in set(labels)}
        if not groups[own]:
            scores.append(0.0)
            continue
        a = np.mean(groups[own])
        b = min(np.mean(g) for c, g in groups.items() if c != own)
        scores.append((b - a) / max(a, b))
    got = cl.silhouette_samples(df, block_rows).orderBy("failure_id").collect()
    assert [r["silhouette"] for r in got] == pytest.approx(scores)
    assert cl.silhouette_exact(df, 3, block_rows).first()[0] == pytest.approx(np.mean(scores))
    assert cl.silhouette_exact(df, 40, block_rows).first()[0] == 0.0
    assert cl.silhouette_exact(df.filter("cluster_id = 0"), 3).first()[0] == 0.0
    assert cl.silhouette_fast(df.filter("cluster_id = 0"), 3) == 0.0


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_silhouette_of_copies_is_that_of_all_pairs(spark, block_rows):
    """Equal points are measured once, with their number; in other clusters they are points of their own."""
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(12, 9)), 6, axis=0)
    labels = np.tile([0, 0, 0, 1, 1, 2], 12)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    sums = np.stack([d[:, labels == c].sum(1) for c in range(3)], 1)
    sizes = np.bincount(labels)
    scores = []
    for i, own in enumerate(labels):
        a = sums[i, own] / (sizes[own] - 1)
        b = min(sums[i, c] / sizes[c] for c in range(3) if c != own)
        scores.append((b - a) / max(a, b))
    df = spark.createDataFrame(
        [(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(labels, x, strict=True))],
        "failure_id bigint, cluster_id int, features array<double>",
    )
    got = cl.silhouette_samples(df, block_rows).orderBy("failure_id").collect()
    assert [r["silhouette"] for r in got] == pytest.approx(scores)
    assert cl.silhouette_exact(df, 3, block_rows).first()[0] == pytest.approx(np.mean(scores))


def test_silhouette_sends_a_point_to_a_bounded_number_of_tasks(spark):
    """However many points there are, only the blocks grow."""
    n = 40 * cl.SILHOUETTE_BLOCKS
    df = spark.range(n).select(
        F.col("id").alias("failure_id"), (F.col("id") % 2).cast("int").alias("cluster_id"),
        F.array(F.col("id").cast("double"), F.rand(1)).alias("features"),
    )
    cl.silhouette_exact(df, 2, block_rows=5).collect()
    blocks = cl.silhouette_blocks(n, 5), cl.silhouette_blocks(2_000 * n, 5)
    assert blocks == (cl.SILHOUETTE_BLOCKS, cl.SILHOUETTE_BLOCKS)
    assert cl.silhouette_blocks(0, 5) == 1
    assert cl.silhouette_blocks(100 * cl.MAX_SILHOUETTE_BLOCK) == 100


def test_similarity_skips_sensors_without_spread(spark):
    means = spark.createDataFrame(
        [(0, 1, 0, 2.0, "A_mean"), (0, 1, 1, 5.0, "B_mean")],
        "cluster_id int, size bigint, feature_pos int, value double, feature string",
    )
    patterns = spark.createDataFrame(
        [(1.0, "A", 1.0, 1.0), (1.0, "B", 0.0, 0.0), (2.0, "A", 3.0, 1.0), (3.0, "B", 0.0, 0.0)],
        "label double, sensor string, mean double, std double",
    )
    sims = ds.label_similarity(means, patterns)
    assert {r["label"]: r["similarity"] for r in sims.collect()} == {1.0: 0.5, 2.0: 0.5}
    best = ds.best_label(sims).first()
    assert best["most_similar_label"] == "label_1.0"
    assert best["all_similarities"] == {"label_1.0": 0.5, "label_2.0": 0.5}
    profile = ds.cluster_profiles(means, best=ds.best_label(sims)).first()
    assert [e["feature"] for e in profile["distinctive_features"]] == ["B_mean", "A_mean"]
    assert profile["label_comparison"]["similarity_score"] == 0.5
    alone = ds.cluster_profiles(means, ds.best_label(sims.filter("label > 9"))).first()
    assert alone["label_comparison"] is None


def test_describe_names_what_is_missing(spark):
    predictions = spark.createDataFrame([(0,), (7,)], "cluster_id int")
    profiles = spark.createDataFrame([(0, 3, "cluster_0")], "cluster_id int, size bigint, cluster_name string")
    rows = ds.describe_predictions(predictions, profiles).collect()
    assert {r["cluster_id"]: r["error"] for r in rows} == {0: None, 7: "Cluster 7 not found in profiles"}
    none = ds.describe_predictions(predictions, profiles.limit(0)).collect()
    assert {r["error"] for r in none} == {"No cluster profiles loaded"}


def trained(make_readings, n, **options):
    rows = []
    for i in range(n):
        rows += [(f"m{i}", 0, 1, {"Sensor 1": float(i), "Sensor 2": float(i % 2)}), (f"m{i}", 5, 0)]
    linked = ep.link_episodes(make_readings(rows))
    return tr.train(linked, F.lit(at(60)), run_id="r1", k=3, **options)


def test_training_needs_k_episodes(make_readings):
    assert trained(make_readings, 2) is None
    assert trained(make_readings, 3).model.silhouette == 0.0


def test_publish_and_load(spark, make_readings, tmp_path):
    root = str(tmp_path)
    assert tr.load_active(spark, root) is None
    first = trained(make_readings, 6)
    tr.publish(spark, root, first, F.lit(at(1)))
    tr.publish(spark, root, trained(make_readings, 6, exact_silhouette=False), F.lit(at(2)))
    clusters = registry.switch_model(tables.read(spark, root + "/clusters", CLUSTERS))
    assert sorted((r["id"], r["is_active"]) for r in clusters.collect()) == [(1, False), (2, True)]
    profile = clusters.first()["cluster_profiles"]
    assert set(profile) == {"cluster_0", "cluster_1", "cluster_2"}
    assert sum(p["size"] for p in profile.values()) == 6
    versions = tables.read(spark, root + "/versions", VERSIONS)
    assert registry.pending_version(versions).first()["id"] == 2
    marked = {r["id"]: r["is_processed"] for r in registry.mark_processed(versions).collect()}
    assert marked == {1: False, 2: True}
    assert registry.mark_processed(versions, all_pending=True).filter("not is_processed").count() == 0


def test_active_model_takes_the_larger_id(spark):
    rows = [(1, at(3), True), (2, at(1), True), (3, at(2), False)]
    table = spark.createDataFrame(rows, "id bigint, created_at timestamp, is_active boolean")
    assert registry.active_model(table).first()["id"] == 2
    assert registry.active_model(table, "created_at").first()["id"] == 1


def test_model_tables_round_trip(spark):
    model = cl.Model(["a", "b"], [1.0, 2.0], [3.0, 4.0], [[0.1, 0.2], [0.3, 0.4]], run_id="x")
    centroids, scaler = cl.model_tables(spark, model)
    loaded = cl.load_model(centroids, scaler, "x")
    assert (loaded.features, loaded.mean, loaded.scale, loaded.centroids) == (
        model.features, model.mean, model.scale, model.centroids,
    )


def test_scored_readings_are_left_out(spark, make_readings):
    df = make_readings([("a", 0, 0), ("a", 1, 0), ("a", 2, 1), ("a", 3, 0, {}), ("a", 4, 0)])
    done = spark.createDataFrame([(0, "1"), (1, "2")], "reading_id bigint, model_version string")
    assert {r["reading_id"] for r in sc.unscored(df, done).collect()} == {4}
    assert {r["reading_id"] for r in sc.unscored(df, done, "2").collect()} == {0, 4}
    assert [r["reading_id"] for r in sc.oldest(df, 2).collect()] == [0, 1]


def test_score_uses_one_reading_features(spark, make_readings):
    model = cl.Model(
        ["Sensor 1_mean", "Sensor 1_std", "Sensor 1_min", "Sensor 1_max", "duration"],
        [0.0] * 5, [1.0] * 5, [[0.0] * 5, [10.0, 0.0, 10.0, 10.0, 0.0]], run_id="r", version="3",
    )
    df = make_readings([("a", 0, 0, {"Sensor 1": 9.0}), ("a", 1, 0, {"Sensor 1": 1.0})])
    rows = sc.to_predictions(sc.score(df.unionAll(df), model), model, F.lit(at(9))).collect()
    assert {r["reading_id"]: r["cluster_id"] for r in rows} == {0: 1, 1: 0}
    assert len(rows) == 2 and rows[0]["model_version"] == "3" and rows[0]["confidence_score"] is None


def test_run_name(spark):
    name = spark.range(1).select(ds.run_name(F.lit(at(65)))).first()[0]
    assert name == "failure_analysis_20240101_0001"


def test_scaler_over_many_tasks_and_odd_entries(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(1e6, 1.0, size=(50, 4))
    x[:, 3] = 0.1
    rows = [(v.tolist(),) for v in x] + [(None,), ([1e6, None, 1e6, 0.1],)]
    df = spark.createDataFrame(rows, "features array<double>").repartition(7)
    got = {r["feature_pos"]: (r["mean"], r["scale"]) for r in cl.scaler_stats(df).collect()}
    whole = np.vstack([x, [1e6, np.nan, 1e6, 0.1]])
    assert [got[i][0] for i in range(4)] == pytest.approx(np.nanmean(whole, axis=0), rel=1e-14)
    assert [got[i][1] for i in range(3)] == pytest.approx(np.nanstd(whole, axis=0)[:3], rel=1e-9)
    assert got[3] == (0.1, 1.0)
    assert cl.scaler_stats(df.filter("false")).count() == 0


def test_scaler_and_assignment_make_no_row_or_lambda_per_entry(spark):
    df = points(spark, [[1.0, 5.0], [3.0, 5.0]])
    plan = cl.scaler_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    plan = cl.assign(df, [[0.0, 0.0]], mean=[0.0, 0.0], scale=[1.0, 1.0])
    assert "lambda" not in plan._jdf.queryExecution().executedPlan().toString()


def test_assignment_is_that_of_the_nearest_expression(spark):
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 81)))]
    rows += [(900, None), (901, [1.0] * 80), (902, [None] + [1.0] * 80), (903, [float("nan")] + [1.0] * 80)]
    df = spark.createDataFrame(rows, "failure_id bigint, features array<double>")
    centres = rng.normal(size=(3, 81)).tolist()
    centres.append(centres[0])
    mean, scale = rng.normal(size=81).tolist(), rng.uniform(0.5, 2, size=81).tolist()
    scaled = df.withColumn("x", cl.scaled("features", mean, scale))
    want = scaled.select("failure_id", cl.nearest("x", centres).alias("near"))
    want = {r["failure_id"]: tuple(r["near"]) if r["near"] else (None, None) for r in want.collect()}
    got = cl.assign(df, centres, mean=mean, scale=scale).collect()
    assert {r["failure_id"]: (r["sq_distance"], r["cluster_id"]) for r in got} == want


def test_first_points_are_those_of_the_lowest_ids(spark):
    df = spark.createDataFrame([(5, [5.0]), (None, [0.0]), (3, [3.0]), (4, [4.0])], "failure_id bigint, features array<double>")
    assert cl.first_points(df, 3) == [[0.0], [3.0], [4.0]]
    assert cl.first_points(df.filter("false"), 3) == []


def test_distance_sums_use_the_space_of_one_tile():
    """Sums against brute force, with equal, nearly equal and unclustered points, in tiles that are made once."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3_000, 5)) + 100
    x[1] = x[0]
    x[2_000] = x[3] + 1e-9
    clusters = pd.array(rng.integers(0, 3, len(x)), dtype="Int32")
    clusters[::50] = pd.NA
    rows = pd.DataFrame({"point": range(len(x)), "cluster_id": clusters, "features": list(x), "weight": 1 + rng.integers(0, 3, len(x))})
    near, far = cl._block(rows[:1_000]), cl._block(rows[1_000:])
    tracemalloc.start()
    towards, back = cl._sums(near, far, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    tile = 8 * cl.TILE[0] * cl.TILE[1]
    assert peak - towards.nbytes - back.nbytes < 1.75 * tile
    away = np.sqrt(((x[near.ids][:, None] - x[far.ids][None]) ** 2).sum(axis=2))
    for code in range(3):
        assert np.allclose(towards[:, code], away @ np.where(far.codes == code, far.weight, 0.0), rtol=1e-11, atol=0)
        assert np.allclose(back[:, code], np.where(near.codes == code, near.weight, 0.0) @ away, rtol=1e-11, atol=0)


def test_run_record_links_readings_once(spark, monkeypatch):
    calls = []
    link = on_models.linked_failing
    monkeypatch.setattr(on_models, "linked_failing", lambda *a: calls.append(a) or link(*a))
    assert on_models.run_record(spark, "/root/testdata/sf0.001").count() == 2
    assert len(calls) == 1
