"""Values that results depend on and that therefore must stay as they are."""

# Name prefix of a sensor column or key.
SENSOR_PREFIX = "Sensor"

# Statistics taken per sensor and episode, in feature order.
FEATURE_STATS = ("mean", "std", "min", "max")

# Upper bounds in seconds of the scoring and of the sending latency histogram.
SCORING_LATENCY_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)
SENDING_LATENCY_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)

# Defaults of the training and scoring jobs.
N_CLUSTERS = 3
KMEANS_SEED = 42
LOOKBACK_HOURS = 1
SCORING_BATCH_SIZE = 100
DRIFT_WINDOW = 100
DRIFT_THRESHOLD = 0.1
MODEL_NAME = "sensor_failure_clustering"
TOP_FEATURES = 5

# Dashboard bands as (colour, lower bound), lowest first.
DRIFT_BANDS = (("green", None), ("yellow", 0.05), ("red", 0.1))
LATENCY_BANDS = (("green", None), ("yellow", 0.1), ("red", 0.2))
ACTIVITY_BANDS = (("red", None), ("yellow", 0.1), ("green", 1.0))

# Trailing time ranges offered by the dashboard, in hours.
TIME_RANGES = {"1h": 1, "6h": 6, "12h": 12, "24h": 24, "7d": 168, "30d": 720}

# Profile used when no reference data can be analysed.
DEFAULT_SENSORS = 20
DEFAULT_SENSOR_PROFILE = {"mean": 0.0, "std": 1.0, "min": -1.0, "max": 1.0}
DEFAULT_LABEL_PATTERNS = {1.0: (0.8, 0.3), 2.0: (-0.8, 0.3), 3.0: (0.0, 2.0)}
