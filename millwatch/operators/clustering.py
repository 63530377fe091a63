"""Scaling, k-means and silhouette over feature vectors ``(failure_id, features)``.

Vectors stay distributed; only results of the size of the model (k x features) reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import KMEANS_SEED, N_CLUSTERS
from ..functions.scale import bounded_rows
from ..schemas import MODEL_CENTROIDS, MODEL_SCALER
from ..sources.tables import materialise

MAX_MODEL_ROWS = 1_000_000
# Points per block of the silhouette; more blocks than SILHOUETTE_BLOCKS only once a block is full.
SILHOUETTE_BLOCK = 2_048
SILHOUETTE_BLOCKS = 24
MAX_SILHOUETTE_BLOCK = 131_072
# Rows and columns of the tiles in which a cell's distances are computed.
TILE = (256, 1_024)
# Squares below this part of the norms are measured directly: the others are off by 1e-12 of a norm's root at most.
NEAR = 1e-6


@dataclass(frozen=True)
class Model:
    """Everything scoring needs; small enough to live in the query plan as literals."""

    features: list[str]
    mean: list[float]
    scale: list[float]
    centroids: list[list[float]]
    run_id: str = ""
    version: str = ""
    silhouette: float = 0.0
    profiles: dict = field(default_factory=dict)


def scaler_stats(vectors: DataFrame) -> DataFrame:
    """Mean and scale per feature position: population deviation, 1 for constant features.

    Every task sums its own vectors, so only one row per task and position is shuffled.
    """
    # entry by entry: one generated method for a wide vector would be too long to be compiled
    entries = vectors.select(F.transform("features", lambda v: v.cast("double")).alias("features"))
    parts = entries.mapInArrow(_moments, _MOMENTS)
    part = F.struct("n", "mean", "m2")
    n = F.col("_n")
    # measured from one of the means, so that a constant feature has exactly no spread
    near = F.col("_parts")[0]["mean"]
    total = lambda term: F.aggregate("_parts", F.lit(0.0), lambda s, p: s + term(p))
    mean = near + total(lambda p: p["n"] * (p["mean"] - near)) / n
    away = lambda p: p["m2"] + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean"))
    std = F.sqrt(total(away) / n)
    return (
        parts.groupBy("feature_pos")
        .agg(F.sum("n").alias("_n"), F.collect_list(F.when(F.col("n") > 0, part)).alias("_parts"))
        .withColumn("mean", F.when(n > 0, mean))
        .select("feature_pos", "mean", F.when(std == 0, 1.0).otherwise(std).alias("scale"))
    )


_MOMENTS = "feature_pos int, n bigint, mean double, m2 double"


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, mean and sum of squared deviations per position of the vectors of one task."""
    n, mean, m2 = (np.zeros(0) for _ in range(3))
    for batch in batches:
        for x, _ in _matrices(batch.column(0)):
            width = x.shape[1]
            if width > len(n):
                n, mean, m2 = (np.concatenate([a, np.zeros(width - len(a))]) for a in (n, mean, m2))
            there = None if x.mask is np.ma.nomask else ~x.mask
            for i, values in enumerate(np.ascontiguousarray(x.data.T)):
                if there is not None:
                    values = values[there[:, i]]
                if not len(values):
                    continue
                away = values - values[0]
                shift = away.mean()
                away -= shift
                found, whole = values[0] + shift, n[i] + len(values)
                delta = found - mean[i] if n[i] else 0.0
                m2[i] += away @ away + delta * delta * n[i] * len(values) / whole
                mean[i] = mean[i] + delta * len(values) / whole if n[i] else found
                n[i] = whole
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(n)), pa.int32()), pa.array(n.astype(np.int64)), pa.array(mean), pa.array(m2)],
        names=["feature_pos", "n", "mean", "m2"],
    )


def _matrices(vectors: pa.Array) -> Iterator[tuple[np.ma.MaskedArray, np.ndarray]]:
    """The vectors that are not NULL as one matrix per width, with their rows; NULL entries are masked."""
    widths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    for width in np.unique(widths[widths >= 0]):
        rows = np.flatnonzero(widths == width)
        flat = (vectors if len(rows) == len(vectors) else vectors.take(pa.array(rows))).flatten()
        none = flat.is_null().to_numpy(zero_copy_only=False)
        flat = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
        shape = (len(rows), int(width))
        yield np.ma.MaskedArray(flat.reshape(shape), none.reshape(shape) if none.any() else np.ma.nomask), rows


def fit_scaler(vectors: DataFrame) -> tuple[list[float], list[float]]:
    rows = bounded_rows(scaler_stats(vectors), MAX_MODEL_ROWS, "scaler")
    rows.sort(key=lambda r: r["feature_pos"])
    return [r["mean"] for r in rows], [r["scale"] for r in rows]


def scale_vectors(
    vectors: DataFrame, mean: Sequence[float], scale: Sequence[float], column: str = "features"
) -> DataFrame:
    """Replaces ``column`` by its standardised values."""
    return vectors.withColumn(column, scaled(column, mean, scale))


def scaled(column: str, mean: Sequence[float], scale: Sequence[float]) -> Column:
    """The standardised vector of ``column``."""
    centred = F.zip_with(column, _numbers(mean), lambda a, m: a - m)
    return F.zip_with(centred, _numbers(scale), lambda a, s: a / s)


def nearest(column: str, centroids: Sequence[Sequence[float]]) -> Column:
    """``struct(sq_distance, cluster_id)`` of the closest centroid; ties go to the lower id.

    The centroids are constants of the plan, whatever their number and width: no join, no shuffle,
    no Python. NULL for a vector that is NULL, has a NULL or NaN entry, or another width.
    """
    centres = F.array(*[_numbers(c) for c in centroids])
    vector = F.col(column)

    def distance(centre: Column, cluster: Column) -> Column:
        squares = F.zip_with(vector, centre, lambda a, c: (a - c) * (a - c))
        total = F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)
        return F.struct(total.alias("sq_distance"), cluster.alias("cluster_id"))

    unusable = F.exists(vector, lambda v: v.isNull() | F.isnan(v)) | (
        F.size(vector) != len(centroids[0])
    )
    found = F.array_min(F.transform(centres, distance))
    return F.when(vector.isNotNull() & ~unusable, found)


def assign(
    vectors: DataFrame,
    centroids: Sequence[Sequence[float]],
    column: str = "features",
    mean: Sequence[float] | None = None,
    scale: Sequence[float] | None = None,
) -> DataFrame:
    """Adds ``cluster_id`` and ``sq_distance`` of the nearest centroid, as :func:`nearest` has it.

    ``mean`` and ``scale`` standardise the vector on the way. A column at a time, in the order in which
    :func:`nearest` adds, so the numbers are the same, without a lambda call per entry and centroid.
    """
    centres = [np.array(c, dtype=float) for c in centroids]
    width = len(centres[0])
    standard = None if mean is None or scale is None else (list(mean), list(scale))

    @F.arrow_udf("struct<sq_distance: double, cluster_id: int>")
    def place(batch: pa.Array) -> pa.Array:
        best = np.zeros(len(batch))
        cluster = np.full(len(batch), -1, dtype=np.int32)
        for x, rows in _matrices(batch):
            if x.shape[1] != width:
                continue
            columns = np.ascontiguousarray(x.data.T)
            usable = ~np.ma.getmaskarray(x).any(axis=1)
            if standard is not None:
                columns = [(c - m) / s for c, m, s in zip(columns, *standard, strict=True)]
            away = np.empty((len(centres), len(rows)))
            for k, centre in enumerate(centres):
                total = np.zeros(len(rows))
                for value, at in zip(columns, centre, strict=True):
                    gap = value - at
                    gap *= gap
                    total += gap
                away[k] = total
            for value in columns:
                usable &= ~np.isnan(value)
            near = away.argmin(axis=0)
            best[rows] = away[near, np.arange(len(rows))]
            cluster[rows] = np.where(usable, near, -1)
        none = cluster < 0
        return pa.StructArray.from_arrays(
            [pa.array(best, pa.float64(), mask=none), pa.array(cluster, pa.int32(), mask=none)],
            names=["sq_distance", "cluster_id"],
        )

    return (
        vectors.withColumn("_near", place(F.col(column).cast("array<double>")))
        .withColumn("cluster_id", F.col("_near.cluster_id"))
        .withColumn("sq_distance", F.col("_near.sq_distance"))
        .drop("_near")
    )


def cluster_means(assigned: DataFrame, width: int, column: str = "features") -> DataFrame:
    """Size and mean vector per cluster, combined before the shuffle into k rows per task."""
    means = F.expr(f"array({', '.join(f'avg({column}[{i}])' for i in range(width))})")
    return assigned.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"), means.alias("means")
    )


def first_points(vectors: DataFrame, k: int) -> list[list[float]]:
    """The k vectors with the lowest ids, as fixed starting centroids.

    The ids are found first, so that no vector but those is computed.
    """
    ids = [r[0] for r in vectors.select("failure_id").orderBy("failure_id").limit(k).collect()]
    named = [i for i in ids if i is not None]
    wanted = F.col("failure_id") <= named[-1] if named else F.lit(False)
    if len(named) < len(ids):
        wanted = wanted | F.col("failure_id").isNull()
    first = vectors.filter(wanted).orderBy("failure_id").select("features").limit(k)
    return [list(r["features"]) for r in first.collect()]


def lloyd(
    vectors: DataFrame, init: Sequence[Sequence[float]], rounds: int, column: str = "features"
) -> list[list[float]]:
    """Lloyd's iteration from given centroids; a cluster that empties keeps its centroid.

    Each round is one pass with a k-row result, and its centroids enter the next round as
    constants, so plans do not grow. Cache or materialise ``vectors`` when they are costly.
    """
    centroids = [list(c) for c in init]
    for _ in range(rounds):
        means = cluster_means(assign(vectors, centroids, column), len(centroids[0]), column)
        for row in bounded_rows(means, len(centroids), "centroids"):
            centroids[row["cluster_id"]] = list(row["means"])
    return centroids


def fit_kmeans(
    vectors: DataFrame, k: int = N_CLUSTERS, seed: int = KMEANS_SEED
) -> list[list[float]]:
    """Spark ML k-means; fewer than k centroids may come back when points coincide."""
    points = vectors.select(array_to_vector("features").alias("features"))
    model = KMeans(k=k, seed=seed).fit(points)
    return [[float(v) for v in centre] for centre in model.clusterCenters()]


def cluster_sizes(assigned: DataFrame, k: int) -> DataFrame:
    """Points per cluster 0..k-1, empty clusters included."""
    spark = assigned.sparkSession
    counts = assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    ids = spark.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    return ids.join(counts, "cluster_id", "left").select(
        "cluster_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("size")
    )


def silhouette_blocks(n: int, block_rows: int = SILHOUETTE_BLOCK) -> int:
    """Blocks of n points: no more than ``SILHOUETTE_BLOCKS`` until they hold ``MAX_SILHOUETTE_BLOCK`` points each."""
    return max(1, min(-(-n // block_rows), SILHOUETTE_BLOCKS), -(-n // MAX_SILHOUETTE_BLOCK))


def _point_silhouettes(points: DataFrame, block_rows: int) -> DataFrame:
    """The Euclidean silhouette of every distinct point ``(cluster_id, features)``, with the number of its copies.

    Every point must meet every other, so the work is quadratic; the data moved is not. Equal points of a
    cluster are one with a weight. Points are hashed into blocks, a task compares two blocks, each pair
    once, and returns its distance sums per point and cluster. A point is sent to as many tasks as there are
    blocks: up to ``SILHOUETTE_BLOCKS`` of them, which grow with the data to ``MAX_SILHOUETTE_BLOCK`` rows.
    """
    distinct = (
        points.groupBy("cluster_id", "features")
        .agg(F.count(F.lit(1)).alias("weight"))
        .withColumn("point", F.monotonically_increasing_id())
    )
    distinct = materialise(distinct, "silhouette-points")
    n = distinct.count()
    n_blocks = silhouette_blocks(n, block_rows)
    block = F.pmod(F.xxhash64("point"), F.lit(n_blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    sums = (
        distinct.withColumn("block", block)
        .withColumn("other", other)
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other")
        # a fixed number of tasks: the cells are small to move but long to compute
        .repartition(n_blocks * (n_blocks + 1) // 2, "low", "high")
        .groupBy("low", "high")
        .applyInPandas(_block_sums, _SUMS)
        .groupBy("point", "other_cluster")
        .agg(F.sum("total").alias("total"))
    )
    sizes = distinct.groupBy(F.col("cluster_id").alias("other_cluster")).agg(F.sum("weight").alias("n"))
    own = F.col("other_cluster") == F.col("cluster_id")
    means = (
        sums.join(sizes, "other_cluster")
        .join(distinct.select("point", "cluster_id"), "point")
        .groupBy("point")
        .agg(
            # the point itself is among its cluster's n, at distance 0
            F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
        )
    )
    a, b = F.col("a"), F.col("b")
    widest = F.greatest(a, b)
    score = F.when(a.isNull() | b.isNull() | (widest == 0), 0.0).otherwise((b - a) / widest)
    return distinct.join(means, "point", "left").withColumn("silhouette", score)


def silhouette_samples(points: DataFrame, block_rows: int = SILHOUETTE_BLOCK) -> DataFrame:
    """Exact Euclidean silhouette per point of ``(failure_id, cluster_id, features)``."""
    scores = _point_silhouettes(points, block_rows).select(
        F.col("cluster_id").alias("_c"), F.col("features").alias("_x"), "silhouette"
    )
    same = F.col("cluster_id").eqNullSafe(F.col("_c")) & F.col("features").eqNullSafe(F.col("_x"))
    return points.join(scores, same).select("failure_id", "cluster_id", "silhouette")


def silhouette_exact(points: DataFrame, k: int, block_rows: int = SILHOUETTE_BLOCK) -> DataFrame:
    """Mean silhouette as one row; 0 for k = 1, for n <= k or when one cluster holds all."""
    scores = _point_silhouettes(points, block_rows)
    n = F.sum("weight")
    valid = (n > k) & F.lit(k > 1)
    mean = F.sum(F.col("silhouette") * F.col("weight")) / n
    return scores.agg(F.when(valid, mean).otherwise(0.0).alias("silhouette"))


def silhouette_fast(points: DataFrame, k: int) -> float:
    """Squared-Euclidean silhouette, linear in the data; not the same number as the exact one."""
    shape = points.agg(
        F.count(F.lit(1)).alias("n"), F.min("cluster_id").alias("lo"), F.max("cluster_id").alias("hi")
    ).first()
    if k < 2 or shape["n"] <= k or shape["lo"] == shape["hi"]:
        return 0.0
    prepared = points.select(
        array_to_vector("features").alias("features"), F.col("cluster_id").alias("prediction")
    )
    return float(ClusteringEvaluator().evaluate(prepared))


def model_tables(spark: SparkSession, model: Model) -> tuple[DataFrame, DataFrame]:
    """The model as ``(centroids, scaler)`` tables with explicit feature positions."""
    centroids = [
        (model.run_id, c, i, name, float(v))
        for c, centre in enumerate(model.centroids)
        for i, (name, v) in enumerate(zip(model.features, centre, strict=True))
    ]
    scaler = [
        (model.run_id, i, name, float(m), float(s))
        for i, (name, m, s) in enumerate(
            zip(model.features, model.mean, model.scale, strict=True)
        )
    ]
    return (
        spark.createDataFrame(centroids, MODEL_CENTROIDS),
        spark.createDataFrame(scaler, MODEL_SCALER),
    )


def load_model(centroids: DataFrame, scaler: DataFrame, run_id: str, version: str = "") -> Model:
    """The model of one run, read back from its tables."""
    scale = bounded_rows(scaler.filter(F.col("run_id") == run_id), MAX_MODEL_ROWS, "scaler")
    scale.sort(key=lambda r: r["feature_pos"])
    cells = bounded_rows(centroids.filter(F.col("run_id") == run_id), MAX_MODEL_ROWS, "centroids")
    cells.sort(key=lambda r: (r["cluster_id"], r["feature_pos"]))
    centres: dict[int, list[float]] = {}
    for cell in cells:
        centres.setdefault(cell["cluster_id"], []).append(cell["value"])
    return Model(
        features=[r["feature"] for r in scale],
        mean=[r["mean"] for r in scale],
        scale=[r["scale"] for r in scale],
        centroids=list(centres.values()),
        run_id=run_id,
        version=version,
    )


_SUMS = T.StructType(
    [
        T.StructField("point", T.LongType()),
        T.StructField("other_cluster", T.IntegerType()),
        T.StructField("total", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class _Block:
    """Points in order of their cluster, those without one first, and the sums found for them."""

    ids: np.ndarray
    x: np.ndarray
    norms: np.ndarray
    weight: np.ndarray
    codes: np.ndarray
    clusters: np.ndarray


def _block(rows: pd.DataFrame) -> _Block:
    codes, clusters = pd.factorize(rows["cluster_id"], sort=True)
    x = np.stack(rows["features"].to_numpy())
    norms = (x * x).sum(axis=1)
    # points of like norm in one tile: few pairs are then looked at twice
    order = np.lexsort((norms, codes))
    x, norms = x[order], norms[order]
    ids, weight = rows["point"].to_numpy()[order], rows["weight"].to_numpy()[order].astype(float)
    return _Block(ids, x, norms, weight, codes[order], np.asarray(clusters))


def _block_sums(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
    low, high = key
    none = pd.DataFrame({f.name: [] for f in _SUMS.fields})
    blocks = [cell[cell["block"] == b] for b in sorted({low, high})]
    if any(rows.empty for rows in blocks):
        return none
    near, far = _block(blocks[0]), _block(blocks[-1])
    towards, back = _sums(near, far, low != high)
    found = [_sum_rows(near, far, towards)]
    if low != high:
        found.append(_sum_rows(far, near, back))
    return pd.concat(found)


def _sum_rows(points: _Block, targets: _Block, total: np.ndarray) -> pd.DataFrame:
    n = len(targets.clusters)
    return pd.DataFrame(
        {
            "point": np.repeat(points.ids, n),
            "other_cluster": np.tile(targets.clusters, len(points.ids)),
            "total": total.ravel(),
        }
    )


def _sums(near: _Block, far: _Block, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sums of distances per point of ``near`` and cluster of ``far``, and the other way round.

    A last column takes the points without a cluster and is left out.
    """
    towards = np.zeros((len(near.ids), len(far.clusters) + 1))
    back = np.zeros((len(far.ids), len(near.clusters) + 1))
    height, width = TILE
    columns = [_tile(far, j, width) for j in range(0, len(far.ids), width)]
    # one piece of memory for all tiles, small enough for a processor's cache
    space = np.empty(height * width)
    for i in range(0, len(near.ids), height):
        rows = _tile(near, i, height)
        for cols in columns:
            away = _distances(rows.x, cols.x, rows.norms, cols.norms, space)
            towards[rows.at, cols.codes] += away @ cols.weights
            if both:
                back[cols.at, rows.codes] += (rows.weights.T @ away).T
    return towards[:, :-1], back[:, :-1]


@dataclass(frozen=True)
class _Tile:
    """Consecutive points of a block; ``weights`` has a column per cluster among them, named in ``codes``."""

    at: slice
    x: np.ndarray
    norms: np.ndarray
    codes: np.ndarray
    weights: np.ndarray


def _tile(block: _Block, start: int, length: int) -> _Tile:
    at = slice(start, start + length)
    codes, of = np.unique(block.codes[at], return_inverse=True)
    weights = np.zeros((len(of), len(codes)))
    weights[np.arange(len(of)), of] = block.weight[at]
    return _Tile(at, block.x[at], block.norms[at], codes, weights)


def _distances(x: np.ndarray, y: np.ndarray, xn: np.ndarray, yn: np.ndarray, space: np.ndarray) -> np.ndarray:
    """All distances by one matrix product; near-equal points, whose difference it would lose, are measured directly."""
    left = np.column_stack([-2.0 * x, xn, np.ones(len(x))])
    right = np.vstack([y.T, np.ones(len(y)), yn])
    squares = np.matmul(left, right, out=space[: len(x) * len(y)].reshape(len(x), len(y)))
    limit = NEAR * (xn.max() + yn.max())
    if not squares.min() >= limit:
        i, j = np.divmod(np.flatnonzero(squares.ravel() < limit), len(y))
        close = squares[i, j] < NEAR * (xn[i] + yn[j])
        i, j = i[close], j[close]
        squares[i, j] = ((x[i] - y[j]) ** 2).sum(axis=1)
    return np.sqrt(squares, out=squares)


def _numbers(values: Sequence[float]) -> Column:
    """The values as one constant array."""
    return F.array(*[F.lit(float(v)) for v in values])
