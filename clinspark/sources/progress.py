"""What a run has finished, noted step by step, so that a killed run can go on where it stopped.

A step is noted after its writes, with a fingerprint of all that its result depends on. A run that resumes
skips a step whose note bears the fingerprint it would have now, and does any other anew. A note is removed before its
step starts: files of a step that was broken off are never taken for whole ones.
"""
from __future__ import annotations

import hashlib
import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


def combined(*parts) -> str:
    """One fingerprint of several values."""
    return hashlib.sha256(json.dumps(parts, default=str, sort_keys=True).encode()).hexdigest()


def input_files(df: DataFrame) -> list[tuple[str, int, int]] | None:
    """Name, length and time of change of every file that ``df`` reads, from listings alone; None if it reads no files."""
    spark = df.sparkSession
    named = set(df.inputFiles())
    if not named:
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = []
    for folder in sorted({n.rsplit("/", 1)[0] for n in named}):
        at = path(spark._jvm.java.net.URI(folder))
        for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
            if status.isFile():
                found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


class Progress:
    """The notes of one run, under ``folder``; a run that does not ``resume`` does every step."""

    def __init__(self, spark: SparkSession, folder: str, resume: bool = False):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.folder, self.resume, self.skipped = folder.rstrip("/"), resume, []
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _noted(self, at) -> dict:
        if not self._fs.exists(at):
            return {}
        stream = self._fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def step(self, name: str, fingerprint: str | None, work: Callable[[], dict]) -> dict:
        """The result of ``work`` (values that JSON can hold), or of its earlier run. Without a fingerprint it is always done."""
        at, draft = self._path(f"{self.folder}/{name}"), self._path(f"{self.folder}/_{name}")
        noted = self._noted(at) if self.resume and fingerprint else {}
        if noted.get("fingerprint") == fingerprint and fingerprint:
            self.skipped.append(name)
            return noted["result"]
        self._fs.delete(at, False)
        result = work()
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps({"fingerprint": fingerprint, "result": result}).encode()))
        finally:
            stream.close()
        self._fs.rename(draft, at)  # a note is there as a whole or not at all
        return result
