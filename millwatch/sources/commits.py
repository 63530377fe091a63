"""Numbered commit files: small JSON documents that say which parts of a table are live.

A commit is written to a file of its own name and appears whole or not at all. ``create`` fails if the number is
taken, which is what lets several writers share a table; ``replace`` is for one writer that repeats a commit.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class Taken(Exception):
    """Another writer has made the commit of this number."""


class Folder:
    """Files below a path, through whatever filesystem its address names."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark._jvm.org.apache.hadoop
        self.path = path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str) -> Any:
        return self.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def delete(self, *names: str) -> None:
        for name in names:
            self.fs.delete(self._at(name), True)

    def names(self) -> list[str]:
        if not self.exists(""):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at("")))

    def _write(self, name: str, data: bytes) -> None:
        out = self.fs.create(self._at(name), False)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def _rename(self, name: str, to: str) -> bool:
        return self.fs.rename(self._at(name), self._at(to))

    def read(self, name: str) -> bytes:
        source = self.fs.open(self._at(name))
        try:
            return bytes(source.readAllBytes())
        finally:
            source.close()


class Commits(Folder):
    """The commits of a table, numbered from 0."""

    def get(self, number: int) -> Any:
        name = _name(number)
        if not self.exists(name):
            raise FileNotFoundError(f"commit {self.path}/{name} does not exist")
        return json.loads(self.read(name))

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.names() if n.endswith(".json") and not n.startswith(".")]

    def newest(self) -> tuple[int, Any]:
        """Number and content of the last commit, ``-1, None`` before the first."""
        for number in reversed(self.numbers()):
            return number, self.get(number)
        return -1, None

    def create(self, number: int, content: Any) -> None:
        """Makes a commit; :class:`Taken` if the number exists. Of two at once one succeeds.

        The number is claimed by a file that only one writer can create; the content follows by a rename.
        A writer that died in between leaves its claim, which :meth:`next_free` passes over.
        """
        try:
            self._write(f"{number:020d}.claim", b"")
        except Exception as err:
            if not self.exists(f"{number:020d}.claim"):
                raise
            raise Taken(f"{self.path}: commit {number}") from err
        self.replace(number, content)

    def next_free(self) -> int:
        """The number after all that were made or claimed."""
        return max((int(n.split(".")[0]) for n in self.names() if n[0].isdigit()), default=-1) + 1

    def replace(self, number: int, content: Any) -> None:
        """Makes or repeats a commit of a table with one writer."""
        own = f".{number:020d}-{uuid.uuid4().hex}"
        self._write(own, json.dumps(content).encode())
        if not self._rename(own, _name(number)):
            self.delete(_name(number))
            if not self._rename(own, _name(number)):
                raise OSError(f"cannot write commit {number} of {self.path}")


def _name(number: int) -> str:
    return f"{number:020d}.json"
