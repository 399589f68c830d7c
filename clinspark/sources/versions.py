"""Tables whose parts are replaced together: a refresh by key, and state that a stream carries on.

A table is dealt to a fixed number of parts by its key. A write stages the parts it
replaces in a folder of its own and then commits: one small file, renamed to its
version's name if there is none yet, that names the folder of every live part. Readers follow the newest
commit, so they see all of a write or nothing; a run killed at any point leaves the table as it was,
and of two writers of one version the second fails. Only replaced parts are rewritten.
"""
from __future__ import annotations

import json
import uuid
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import keep_last

PARTS = 64
PART = "_part"


class Versions:
    """The versions of one table under ``path``."""

    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def part_of(self, *key: str) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.parts)).cast("int")

    def _listed(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _manifest(self, version: int) -> dict | None:
        at = self._path(f"{self.path}/_commits/{version:010d}")
        if not self._fs.exists(at):
            return None
        stream = self._fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def current(self) -> int:
        """The newest committed version, 0 without any."""
        return max((int(n) for n in self._listed("_commits") if n.isdigit()), default=0)

    def info(self, version: int | None = None) -> dict:
        """What the writer of a version noted with it."""
        found = self._manifest(self.current() if version is None else version)
        return found["info"] if found else {}

    def read(self, schema, version: int | None = None, parts: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version (the newest if not given), of all or some parts."""
        found = self._manifest(self.current() if version is None else version)
        live = found["live"] if found else {}
        wanted = None if parts is None else set(map(str, parts))
        folders = [f"{self.path}/{folder}/{PART}={p}" for p, folder in sorted(live.items()) if wanted is None or p in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def replace(self, rows: DataFrame, version: int, touched: Iterable[int], cluster_by: Sequence[str] = (),
                info: dict | None = None) -> None:
        """Commit ``version``: the parts ``touched`` hold ``rows`` (with a column ``_part``), the others what they held before."""
        folder = f"data-{version:010d}-{uuid.uuid4().hex[:12]}"
        rows.repartitionByRange(PART, *cluster_by).write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        before = self._manifest(version - 1)
        live = dict(before["live"]) if before else {}
        for p in touched:
            live.pop(str(p), None)
        live |= {name.split("=")[1]: folder for name in self._listed(folder) if name.startswith(f"{PART}=")}
        written, commit = (self._path(f"{self.path}/_commits/{n}") for n in (f"_{uuid.uuid4().hex}", f"{version:010d}"))
        stream = self._fs.create(written, False)
        try:
            stream.write(bytearray(json.dumps({"live": live, "info": info or {}}).encode()))
        finally:
            stream.close()
        if self._fs.exists(commit) or not self._fs.rename(written, commit):  # a rename onto a file fails on shared stores
            raise RuntimeError(f"version {version} of {self.path} was committed by another writer")

    def prune(self, keep: int = 2) -> None:
        """Drop what only versions before the newest ``keep`` refer to; folders that no commit names are left alone."""
        found = {int(n): self._manifest(int(n)) for n in self._listed("_commits") if n.isdigit()}
        newest = sorted(found)[-keep:]
        live = {f for n in newest for f in found[n]["live"].values()}
        for n in sorted(found):
            if n not in newest:
                for folder in set(found[n]["live"].values()) - live:
                    self._fs.delete(self._path(f"{self.path}/{folder}"), True)
                self._fs.delete(self._path(f"{self.path}/_commits/{n:010d}"), False)


def merge_by_key(spark: SparkSession, rows: DataFrame, path: str, key: Sequence[str], order: Sequence[str],
                 parts: int = PARTS) -> DataFrame:
    """E2 as a refresh: the table at ``path`` with ``rows`` merged in, the last row per key by ``order`` kept.

    Keep-last is a maximum, so merging extract by extract gives what a rebuild from
    all extracts gives. Only the parts that hold keys of ``rows`` are read and
    rewritten; an extract merged twice changes nothing.
    """
    table = Versions(spark, path, parts)
    version = table.current()
    new = keep_last(rows, key, order).withColumn(PART, table.part_of(*key))
    touched = [r[0] for r in new.select(PART).distinct().collect()]  # at most ``parts`` numbers
    if touched or not version:
        old = table.read(rows.schema, version, touched).withColumn(PART, table.part_of(*key))
        both = keep_last(old.unionByName(new), key, order)
        table.replace(both.withColumn(PART, table.part_of(*key)), version + 1, touched, key)
        table.prune()
    return table.read(rows.schema)
