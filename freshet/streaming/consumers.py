"""Who reads a change feed, and how far each has come.

A consumer says up to which epoch it needs the feed no more. Retention keeps
what the slowest one still needs. Positions are small files, named so that a
listing tells them; only the newest of a consumer counts.
"""

from __future__ import annotations

import urllib.parse

from pyspark.sql import DataFrame, SparkSession

from freshet.errors import UNKNOWN_NAME, fault
from freshet.session import Storage


class Consumers:
    """The consumers of one feed, at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._storage = Storage(spark)
        self._path = path
        self._storage.mkdirs(path)

    def _files(self) -> list[tuple[str, int, str]]:
        out = []
        for file in self._storage.names(self._path):
            name, mark, epoch = file.removesuffix(".json").rpartition("~")
            if mark and not file.startswith("_"):
                out.append((urllib.parse.unquote(name), int(epoch), file))
        return out

    def positions(self) -> dict[str, int]:
        """The last epoch each consumer is done with; -1 before the first."""
        found: dict[str, int] = {}
        for name, epoch, _ in self._files():
            found[name] = max(epoch, found.get(name, epoch))
        return found

    def reach(self, name: str, epoch: int) -> None:
        """A consumer, known from now on, is done with the epochs up to this one. It never goes back."""
        known = self.positions().get(name)
        if known is not None and known >= epoch:
            return
        file = f"{urllib.parse.quote(name, safe='')}~{epoch}.json"
        self._storage.create_once(f"{self._path}/{file}", "{}")
        for other, older, old in self._files():
            if other == name and older < epoch:
                self._storage.delete(f"{self._path}/{old}")

    def forget(self, name: str) -> None:
        """The consumer is gone and needs nothing any more."""
        own = [file for other, _, file in self._files() if other == name]
        if not own:
            raise fault(UNKNOWN_NAME, f"no consumer is named '{name}'")
        for file in own:
            self._storage.delete(f"{self._path}/{file}")

    def least(self) -> int | None:
        """The epoch up to which every consumer is done; None without consumers."""
        return min(self.positions().values(), default=None)

    def table(self) -> DataFrame:
        """``consumer`` and ``consumer_epoch``, one row each."""
        return self._spark.createDataFrame(list(self.positions().items()), "consumer string, consumer_epoch bigint")
