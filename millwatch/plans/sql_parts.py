"""Common table expressions shared by the check SQL; written apart from the Spark operators."""

from __future__ import annotations

from ..functions.sensors import feature_names
from .driver_views import READINGS_SQL, WIDE_SQL

FEATURES = feature_names(["Sensor 1", "Sensor 2"])

EPISODES_SQL = f"""{READINGS_SQL},
marked AS (
  SELECT *,
         CASE WHEN has_failure AND NOT coalesce(lag(has_failure) OVER w, false) THEN 1 ELSE 0 END AS opens,
         CASE WHEN lead(has_failure) OVER w = false THEN lead("timestamp") OVER w END AS next_normal
  FROM readings
  WINDOW w AS (PARTITION BY machine_id ORDER BY "timestamp", reading_id)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY machine_id ORDER BY "timestamp", reading_id
                             ROWS UNBOUNDED PRECEDING) AS ep
  FROM marked),
failures AS MATERIALIZED (
  SELECT machine_id, ep, arg_min(reading_id, "timestamp") AS failure_id,
         min("timestamp") AS start_time, max(next_normal) AS end_time,
         CAST(count(*) AS BIGINT) AS n_readings, max(next_normal) IS NULL AS is_active
  FROM numbered WHERE has_failure GROUP BY machine_id, ep),
members AS (
  SELECT n.*, f.failure_id, f.start_time
  FROM numbered n JOIN failures f USING (machine_id, ep) WHERE n.has_failure)"""

_WIDE_FEATURES = ", ".join(
    f"coalesce({fn}({s}), 0.0) AS f{4 * i + j}"
    for i, s in enumerate(("s1", "s2"))
    for j, fn in enumerate(("avg", "stddev_pop", "min", "max"))
)
_LONG_FEATURES = " UNION ALL ".join(
    f"SELECT machine_id, failure_id, {i} AS feature_pos, '{name}' AS feature, f{i} AS value FROM fw"
    for i, name in enumerate(FEATURES)
)
FEATURES_SQL = f"""{EPISODES_SQL},
fw AS MATERIALIZED (
  SELECT machine_id, failure_id, {_WIDE_FEATURES}, CAST(count(*) AS DOUBLE) AS f8
  FROM members GROUP BY machine_id, failure_id),
feats AS ({_LONG_FEATURES})"""

SCALED_SQL = f"""{FEATURES_SQL},
scaler AS MATERIALIZED (
  SELECT feature_pos, avg(value) AS mean,
         CASE WHEN stddev_pop(value) = 0 THEN 1.0 ELSE stddev_pop(value) END AS scale
  FROM feats GROUP BY feature_pos),
points AS MATERIALIZED (
  SELECT failure_id AS id, feature_pos AS pos, (value - mean) / scale AS x
  FROM feats JOIN scaler USING (feature_pos))"""


def lloyd_sql(k: int, rounds: int) -> str:
    """Centroids ``c0 .. c<rounds>`` from ``points(id, pos, x)``, starting at the k lowest ids."""
    parts = [
        f"""seeds AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS cluster_id
                  FROM (SELECT DISTINCT id FROM points ORDER BY id LIMIT {k})),
c0 AS MATERIALIZED (SELECT cluster_id, pos, x AS v FROM points JOIN seeds USING (id))"""
    ]
    for r in range(rounds):
        parts.append(
            f"""{nearest_sql(f"a{r}", "points", f"c{r}")},
m{r} AS (SELECT cluster_id, pos, avg(x) AS v FROM points JOIN a{r} USING (id) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT c.cluster_id, c.pos, coalesce(m.v, c.v) AS v
                          FROM c{r} c LEFT JOIN m{r} m USING (cluster_id, pos))"""
        )
    return ",\n".join(parts)


def nearest_sql(name: str, points: str, centroids: str) -> str:
    """``name(id, cluster_id, d)``: the nearest centroid of every point."""
    return f"""{name} AS MATERIALIZED (
  SELECT id, cluster_id, d FROM (
    SELECT id, cluster_id, d, row_number() OVER (PARTITION BY id ORDER BY d, cluster_id) AS nth
    FROM (SELECT p.id, c.cluster_id, sum((p.x - c.v) * (p.x - c.v)) AS d
          FROM {points} p JOIN {centroids} c USING (pos) GROUP BY p.id, c.cluster_id))
  WHERE nth = 1)"""


def silhouette_sql(distance: str) -> str:
    """Mean silhouette of ``labeled(id, cluster_id)`` over ``points``; ``distance`` of ``pairs.d``."""
    return f"""pairs AS (
  SELECT p.id, q.id AS other, sum((p.x - q.x) * (p.x - q.x)) AS d
  FROM points p JOIN points q ON p.pos = q.pos AND p.id <> q.id GROUP BY p.id, q.id),
towards AS (
  SELECT pairs.id, l.cluster_id AS own, m.cluster_id AS other, avg({distance}) AS d
  FROM pairs JOIN labeled l ON l.id = pairs.id JOIN labeled m ON m.id = pairs.other GROUP BY ALL),
ab AS (
  SELECT id, max(CASE WHEN own = other THEN d END) AS a, min(CASE WHEN own <> other THEN d END) AS b
  FROM towards GROUP BY id),
sil AS (
  SELECT avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0.0
                  ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab)"""


# More clusters than the default of 3, so that normal readings fall into several of them.
MODEL_K = 6
MODEL_ROUNDS = 3
MODEL_SQL = f"""{SCALED_SQL},
{lloyd_sql(MODEL_K, MODEL_ROUNDS)},
{nearest_sql("labeled", "points", f"c{MODEL_ROUNDS}")},
means AS MATERIALIZED (
  SELECT cluster_id, feature_pos, feature, avg(value) AS value, count(*) AS size
  FROM feats JOIN labeled ON labeled.id = feats.failure_id GROUP BY ALL)"""

_STACKED = " UNION ALL ".join(
    f"SELECT 'Sensor {i}' AS sensor, label, machine, s{i} AS value FROM wide" for i in range(1, 5)
)
WIDE_LONG_SQL = f"""{WIDE_SQL},
wide_long AS ({_STACKED})"""
PATTERNS_SQL = f"""{WIDE_LONG_SQL},
patterns AS MATERIALIZED (
  SELECT label, sensor, avg(value) AS mean, coalesce(stddev_samp(value), 0.0) AS std
  FROM wide_long WHERE label IS NOT NULL GROUP BY label, sensor)"""
SIMILARITY_SQL = f"""{MODEL_SQL}, {PATTERNS_SQL},
sims AS MATERIALIZED (
  SELECT cluster_id, label, avg(1 / (1 + abs(m.value - p.mean) / p.std)) AS similarity
  FROM means m JOIN patterns p ON m.feature = p.sensor || '_mean'
  WHERE p.std > 0 GROUP BY cluster_id, label)"""
