import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from millwatch.session import build_session  # noqa: E402

START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_readings(spark):
    """Readings from ``(machine, second, failing[, values])`` tuples; ids follow the order."""

    def make(rows):
        data = []
        for i, row in enumerate(rows):
            machine, second, failing = row[:3]
            values = row[3] if len(row) > 3 else {"Sensor 1": float(i)}
            data.append((i, machine, START + timedelta(seconds=second), values, bool(failing)))
        return spark.createDataFrame(
            data,
            "reading_id bigint, machine_id string, timestamp timestamp, "
            "values map<string,double>, has_failure boolean",
        )

    return make


def at(second):
    return START + timedelta(seconds=second)
