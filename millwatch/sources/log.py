"""A partitioned message log on a shared filesystem, read by partition and offset.

``append`` adds messages: a key always goes to one partition, and every message has an offset that counts
up from 0 without a gap in its partition. Spark writes the messages as segments of bounded size; a commit
file then gives the offsets at which they lie, so an append appears whole or not at all. Offsets never
change, which is what makes reading ids and restarts exact.

``log_stream`` is a stream over the log. Its progress, an offset per partition, lies in the query's checkpoint.
A trigger reads the commit files made since the one before and plans a task per segment, so its cost
follows the new messages, and a partition with most messages is read by as many tasks as it has segments.

A log has one writer at a time. Of two that append at once one gets :class:`~.commits.Taken` and has
written nothing; a writer that died leaves a claim, which ``recover`` removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.scale import with_global_rank
from .commits import Commits, Folder, Taken

FORMAT = "message_log"
SCHEMA = "value string, partition int, offset bigint"
SEGMENT_ROWS = 100_000


def append(
    messages: DataFrame,
    root: str,
    partitions: int,
    time: str = "timestamp",
    row_id: str = "reading_id",
    token: str | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> int:
    """Appends ``key, value`` in the order of ``time, row_id`` and returns the number of the commit.

    A repeated call with the ``token`` of the last commit does nothing, so a micro-batch that runs again is not
    appended twice. A null key is a key of its own.
    """
    spark = messages.sparkSession
    commits = Commits(spark, f"{root}/_commits")
    number, last = commits.newest()
    last = last or {"partitions": partitions, "ends": {}, "token": None}
    if token is not None and last["token"] == token:
        return number
    if last["partitions"] != partitions:
        raise ValueError(f"{root} has {last['partitions']} partitions, not {partitions}")
    place = f"segments/{number + 1}-{uuid.uuid4().hex}"
    of_key = F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int")
    rows = messages.select("value", of_key.alias("partition"), time, row_id)
    # one order over all partitions, cut into segments of bounded size whatever the keys
    ranked = with_global_rank(rows, time, row_id).withColumn("segment", F.floor(F.col("rank") / segment_rows))
    (
        ranked.select("value", "rank", "partition", "segment")
        .repartition("partition", "segment")
        .sortWithinPartitions("partition", "segment", "rank")
        .write.partitionBy("partition", "segment")
        .parquet(f"{root}/{place}")
    )
    ends, segments = dict(last["ends"]), {}
    for row in _segments(spark, f"{root}/{place}"):
        part = str(row["partition"])
        first = ends.get(part, 0)
        path = f"{place}/partition={part}/segment={row['segment']}/{row['file']}"
        segments.setdefault(part, []).append([first, row["n"], path])
        ends[part] = first + row["n"]
    content = {"partitions": partitions, "ends": ends, "segments": segments, "token": token}
    try:
        commits.create(number + 1, content)
    except Taken:
        Folder(spark, root).delete(place)
        raise
    return number + 1


def _segments(spark: SparkSession, path: str) -> list:
    """A row per file written: for each partition as many as its messages and ``segment_rows`` make."""
    stored = spark.read.schema("rank bigint, partition int, segment bigint").parquet(path)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    found = stored.groupBy("partition", "segment", name.alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return found.orderBy("partition", "segment").collect()


def recover(spark: SparkSession, root: str) -> None:
    """Removes the claim of a writer that died before its commit. Only for logs that nobody is writing."""
    commits = Commits(spark, f"{root}/_commits")
    number, _ = commits.newest()
    commits.delete(f"{number + 1:020d}.claim")


def log_stream(
    spark: SparkSession, root: str, limit: int | None = None, progress: str | None = None
) -> DataFrame:
    """The log from its first message on, as a stream of ``value, partition, offset``.

    ``limit`` admits so many messages of each partition to a trigger. Spark does not tell this kind of source where
    a query stands when it plans, so the source notes in the folder ``progress``, one for each query, how
    far it has planned. An available-now run is one trigger: give it no limit.
    """
    spark.dataSource.register(MessageLog)
    reader = spark.readStream.format(FORMAT)
    if limit:
        if not progress:
            raise ValueError("a limit needs a folder for the progress of the query")
        reader = reader.option("limit", limit).option("progress", progress)
    return reader.load(root)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """All messages of the log as a batch."""
    spark.dataSource.register(MessageLog)
    return spark.read.format(FORMAT).load(root)


@dataclass
class Range(InputPartition):
    """Offsets ``low`` to ``high`` of one segment, whose rows lie in order from ``first`` on."""

    path: str
    part: int
    first: int
    low: int
    high: int


class _Files:
    """What both readers share; only addresses are sent to executors, which open the files themselves."""

    def __init__(self, root: str):
        self.root = root

    def _open(self, path: str) -> tuple[pafs.FileSystem, str]:
        if "://" in path or path.startswith("file:"):
            return pafs.FileSystem.from_uri(path)
        return pafs.LocalFileSystem(), path

    def _json(self, path: str) -> Any:
        files, at = self._open(path)
        if files.get_file_info(at).type == pafs.FileType.NotFound:
            return None
        with files.open_input_stream(at) as source:
            return json.loads(source.read())

    def _get(self, number: int) -> Any:
        return self._json(f"{self.root}/_commits/{number:020d}.json")

    def _ranges(self, start: dict, end: dict) -> list[Range]:
        found = []
        for number in range(start["low"] + 1, end["high"] + 1):
            for part, segments in self._get(number)["segments"].items():
                for first, n, path in segments:
                    low = max(first, start["ends"].get(part, 0))
                    high = min(first + n, end["ends"].get(part, 0))
                    if low < high:
                        found.append(Range(f"{self.root}/{path}", int(part), first, low, high))
        return found

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        files, at = self._open(partition.path)
        with files.open_input_file(at) as source:
            offset = partition.first
            for batch in pq.ParquetFile(source).iter_batches(columns=["value"]):
                low, high = max(partition.low - offset, 0), min(partition.high - offset, len(batch))
                if low < high:
                    n = high - low
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("value").slice(low, n),
                            pa.array([partition.part] * n, pa.int32()),
                            pa.array(range(offset + low, offset + high), pa.int64()),
                        ],
                        names=["value", "partition", "offset"],
                    )
                offset += len(batch)


class LogStream(_Files, DataSourceStreamReader):
    """Positions are ``ends``, the next offset of each partition, and two commits.

    All commits up to ``low`` are read whole; none after ``high`` is read in part.
    """

    def __init__(self, root: str, limit: int, progress: str | None):
        super().__init__(root)
        self.limit, self.progress, self.planned = limit, progress, None

    def initialOffset(self) -> dict:
        return {"low": -1, "high": -1, "ends": {}}

    def latestOffset(self) -> dict:
        at = self.planned or (self.limit and self._json(f"{self.progress}/planned.json")) or self.initialOffset()
        self.planned = self._further(at)
        if self.limit and self.planned != at:
            self._note(self.planned)
        return self.planned

    def partitions(self, start: dict, end: dict) -> Sequence[Range]:
        return self._ranges(start, end)

    def _further(self, at: dict) -> dict:
        room = lambda p: at["ends"].get(p, 0) + self.limit
        high, reached, ends_of = at["high"], at["ends"], {}
        if high >= 0:
            reached = self._get(high)["ends"]
        open_parts = not self.limit or any(reached[p] < room(p) for p in reached) or not reached
        while open_parts and (commit := self._get(high + 1)) is not None:
            high += 1
            reached = ends_of[high] = commit["ends"]
            open_parts = not self.limit or any(reached[p] < room(p) for p in reached)
        ends = {p: min(e, room(p)) if self.limit else e for p, e in reached.items()}
        low = at["low"]
        while low < high:
            upto = ends_of.get(low + 1) or self._get(low + 1)["ends"]
            if any(ends[p] < e for p, e in upto.items()):
                break
            low += 1
        return {"low": low, "high": high, "ends": ends}

    def _note(self, planned: dict) -> None:
        """Written before Spark logs the trigger, so the note is never behind the checkpoint."""
        files, at = self._open(self.progress)
        files.create_dir(at, recursive=True)
        with files.open_output_stream(f"{at}/planned.tmp") as out:
            out.write(json.dumps(planned).encode())
        files.move(f"{at}/planned.tmp", f"{at}/planned.json")


class LogBatch(_Files, DataSourceReader):
    def partitions(self) -> Sequence[Range]:
        start = {"low": -1, "high": -1, "ends": {}}
        return self._ranges(start, LogStream(self.root, 0, None)._further(start))


class MessageLog(DataSource):
    """The format ``message_log``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: Any) -> LogBatch:
        return LogBatch(self.options["path"].rstrip("/"))

    def streamReader(self, schema: Any) -> LogStream:
        limit = int(self.options.get("limit", "0"))
        return LogStream(self.options["path"].rstrip("/"), limit, self.options.get("progress"))
