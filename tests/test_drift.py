import math
from collections import deque

import pytest
from conftest import at
from pyspark.sql import functions as F

from millwatch.functions import fixed
from millwatch.operators import drift as dr
from millwatch.operators import monitoring as mo


def scored(spark, batches):
    rows = [(b, c) for b, clusters in enumerate(batches) for c in clusters]
    return spark.createDataFrame(rows, "batch_no bigint, cluster_id int")


def js(p, q):
    def kl(a, b):
        return sum(x * math.log(x / y) for x, y in zip(a, b, strict=True) if x > 0 and y > 0)

    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    return min(1.0, max(0.0, (kl(p, m) + kl(q, m)) / 2))


def replay(batches, k, window):
    """Brute force over the batches in order."""
    recent, reference, scores = deque(maxlen=window), None, []
    for clusters in batches:
        recent.append([clusters.count(c) / len(clusters) for c in range(k)])
        mean = [sum(d[c] for d in recent) / len(recent) for c in range(k)]
        if reference is None and len(recent) == window:
            reference = mean
        scores.append(0.0 if reference is None else js(mean, reference))
    return scores


BATCHES = [
    [0, 0, 1], [1], [0, 1, 1, 2], [2, 2], [0], [2, 2, 2, 2, 2], [1, 0], [2], [0, 0, 0], [1, 2],
]


@pytest.mark.parametrize("window", [1, 3, 4, 10, 11])
@pytest.mark.parametrize("per_cell", [1, 5, 1000])
def test_series_matches_replay(spark, window, per_cell, monkeypatch):
    dist = dr.batch_distribution(scored(spark, BATCHES), 3)
    monkeypatch.setattr(dr.window_distribution, "__defaults__", (window, per_cell))
    rows = dr.drift_series(dist, 3, window, 0.01).orderBy("batch_no").collect()
    expected = replay(BATCHES, 3, window)
    assert [r["drift_score"] for r in rows] == pytest.approx(expected)
    assert [r["is_drift"] for r in rows] == [s > 0.01 for s in expected]


def test_threshold_is_strict(spark):
    dist = dr.batch_distribution(scored(spark, [[0], [1]]), 2)
    top = dr.drift_series(dist, 2, 1).orderBy("batch_no").collect()[1]["drift_score"]
    assert top == pytest.approx(math.log(2))
    assert dr.drift_series(dist, 2, 1, threshold=top).filter("is_drift").count() == 0


def test_event_holds_the_batch_distribution(spark):
    dist = dr.batch_distribution(scored(spark, [[0], [0], [1], [1]]), 2)
    series = dr.drift_series(dist, 2, window=2, threshold=0.1)
    events = dr.drift_events(series, F.lit(at(0))).orderBy("batch_no").collect()
    assert [e["batch_no"] for e in events] == [2, 3]
    assert events[0]["current_distribution"] == {0: 0.0, 1: 1.0}
    assert events[0]["reference_distribution"] == {0: 1.0, 1: 0.0}


def test_divergence_properties(spark):
    row = spark.range(1).select(
        dr.js_divergence(F.lit([0.2, 0.8]), F.lit([0.2, 0.8])).alias("same"),
        dr.js_divergence(F.lit([1.0, 0.0]), F.lit([0.0, 1.0])).alias("far"),
        dr.js_divergence(F.lit([0.3, 0.7]), F.lit([0.6, 0.4])).alias("ab"),
        dr.js_divergence(F.lit([0.6, 0.4]), F.lit([0.3, 0.7])).alias("ba"),
    ).first()
    assert row["same"] == 0.0 and row["far"] == pytest.approx(math.log(2))
    assert row["ab"] == pytest.approx(row["ba"]) and 0 < row["ab"] < math.log(2)


def test_distributions_sum_to_one_and_align(spark):
    dist = dr.batch_distribution(scored(spark, BATCHES), 3)
    assert all(sum(r["freqs"]) == pytest.approx(1) for r in dist.collect())
    left = dr.distribution_long(dist.filter("batch_no = 1"))
    right = dr.distribution_long(dist.filter("batch_no = 3"))
    rows = {r["cluster_id"]: (r["p"], r["q"]) for r in dr.align_distributions(left, right).collect()}
    assert rows == {1: (1.0, 0.0), 2: (0.0, 1.0)}


def test_quantiles(spark):
    def quantile(values, q):
        df = spark.createDataFrame([(v,) for v in values], "latency double")
        buckets = mo.latency_histogram(df)
        return buckets.select(mo.histogram_quantile(F.col("buckets"), q)).first()[0]

    assert quantile([5.0, 6.0], 0.5) == 1.0
    assert quantile([0.0005, 0.0005], 0.5) == pytest.approx(0.0005)
    assert quantile([0.002] * 4, 0.5) == pytest.approx(0.003)
    assert quantile([0.2, 0.2, 0.9, 0.9], 0.95) == pytest.approx(0.5 + 0.5 * (3.8 - 2) / 2)
    assert quantile([], 0.5) is None


def test_bands(spark):
    df = spark.createDataFrame([(0.04,), (0.05,), (0.1,), (0.3,)], "v double")
    colours = [r[0] for r in df.select(mo.band(F.col("v"), fixed.DRIFT_BANDS)).collect()]
    assert colours == ["green", "yellow", "red", "red"]


def test_summary_takes_the_last_known_value(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.1), (3, None)], "n int, v double")
    row = mo.series_summary(df, "n", "v").first()
    assert (row["last_value"], row["max_value"]) == (0.1, 0.5)


def test_an_unknown_cluster_fails_and_a_missing_one_does_not_count(spark):
    rows = [(0, 0), (0, 1), (0, None)]
    df = spark.createDataFrame(rows, "batch_no bigint, cluster_id int")
    row = dr.batch_distribution(df, 2).first()
    assert (row["n"], row["freqs"]) == (2, [0.5, 0.5])
    with pytest.raises(Exception, match="cluster beyond"):
        dr.batch_distribution(df, 1).collect()
