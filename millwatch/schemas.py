"""Table and message schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _INT, _DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
_TEXT, _BOOL, _TIME = T.StringType(), T.BooleanType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


VALUES = T.MapType(_TEXT, _DOUBLE)
DISTRIBUTION = T.MapType(_INT, _DOUBLE)

# Payload of one reading message.
MESSAGE = struct(
    machine_id=_TEXT,
    timestamp=_TEXT,
    readings=struct(readings=VALUES, has_failure=_BOOL),
)

MACHINES = struct(machine_id=_TEXT, first_seen=_TIME, last_seen=_TIME)

# failure_id is the id of the reading that opened the episode; NULL on normal readings.
READINGS = struct(
    reading_id=_LONG,
    machine_id=_TEXT,
    timestamp=_TIME,
    values=VALUES,
    has_failure=_BOOL,
    failure_id=_LONG,
    failure_start=_TIME,
)

FAILURES = struct(
    machine_id=_TEXT,
    failure_id=_LONG,
    start_time=_TIME,
    end_time=_TIME,
    is_active=_BOOL,
    n_readings=_LONG,
)

PROFILE = struct(
    size=_LONG,
    distinctive_features=T.ArrayType(struct(feature=_TEXT, value=_DOUBLE)),
    all_features=VALUES,
    label_comparison=struct(
        most_similar_label=_TEXT, similarity_score=_DOUBLE, all_similarities=VALUES
    ),
)

CLUSTERS = struct(
    id=_LONG,
    run_id=_TEXT,
    model_version=_INT,
    created_at=_TIME,
    is_active=_BOOL,
    n_clusters=_INT,
    silhouette_score=_DOUBLE,
    cluster_profiles=T.MapType(_TEXT, PROFILE),
)

PREDICTIONS = struct(
    reading_id=_LONG,
    machine_id=_TEXT,
    timestamp=_TIME,
    cluster_id=_INT,
    model_version=_TEXT,
    confidence_score=_DOUBLE,
    prediction_time=_TIME,
    run_id=_TEXT,
    model_name=_TEXT,
)

DRIFT = struct(
    run_id=_TEXT,
    batch_no=_LONG,
    detection_time=_TIME,
    drift_score=_DOUBLE,
    reference_distribution=DISTRIBUTION,
    current_distribution=DISTRIBUTION,
)

DISTRIBUTIONS = struct(run_id=_TEXT, batch_no=_LONG, n=_LONG, freqs=T.ArrayType(_DOUBLE))

# Signals that were picked up; kept apart so that no table is ever updated in place.
PICKUPS = struct(id=_LONG, picked_up_at=_TIME)

VERSIONS = struct(id=_LONG, version=_TEXT, run_id=_TEXT, created_at=_TIME, is_processed=_BOOL)

RUNS = struct(
    run_id=_TEXT,
    run_name=_TEXT,
    n_clusters=_INT,
    n_failures=_LONG,
    training_lookback_hours=_INT,
    silhouette_score=_DOUBLE,
    silhouette_metric=_TEXT,
)

MODEL_CENTROIDS = struct(
    run_id=_TEXT, cluster_id=_INT, feature_pos=_INT, feature=_TEXT, value=_DOUBLE
)

MODEL_SCALER = struct(run_id=_TEXT, feature_pos=_INT, feature=_TEXT, mean=_DOUBLE, scale=_DOUBLE)
