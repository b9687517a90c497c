"""The newest row per key, kept in buckets of which a merge rewrites some.

::

    <path>/layout.json            number of buckets, made once
    <path>/rows/<attempt>/bucket=<b>/part-*   buckets a merge wrote
    <path>/versions/<n>.json      made once: which attempt holds each bucket, up to which epoch

A key belongs to one bucket for good. A merge reads and writes the buckets its
changes fall into; the others keep their files. The new version names all
buckets, so a reader sees either all of a merge or nothing of it, and of two
merges at the same time one makes the version and the other starts again from
it. The number of buckets bounds what a version lists and never changes; a
bucket's share of the keys is what a merge rewrites for a single changed key.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.errors import BAD_CONFIG, WRONG_STATEMENT, fault
from freshet.session import Storage

BUCKETS = 64
BUCKET = "bucket"
# Versions whose files stay, so that readers of the one before can finish.
_KEPT_VERSIONS = 2


class KeyedTable:
    """Rows of ``schema`` with one row per ``keys``; ``order`` tells the newest."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: str, buckets: int = BUCKETS
    ):
        unknown = [k for k in [*keys, order] if k not in schema.names]
        if unknown or not keys or buckets < 1:
            raise fault(BAD_CONFIG, f"keys {keys} and order '{order}' must be columns, buckets positive")
        self._spark = spark
        self._storage = Storage(spark)
        self.path = path
        self.keys = keys
        self.order = order
        fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields]
        self.schema = T.StructType(fields)
        self._rows = f"{path}/rows"
        self._versions = f"{path}/versions"
        for folder in (self._rows, self._versions):
            self._storage.mkdirs(folder)
        layout = json.dumps({"buckets": buckets, "keys": keys})
        self._storage.create_once(f"{path}/layout.json", layout)
        known = json.loads(self._storage.read_text(f"{path}/layout.json"))
        if known["keys"] != keys:
            raise fault(WRONG_STATEMENT, f"the table at {path} is kept by {known['keys']}")
        # Whoever made the table chose the number.
        self.buckets = known["buckets"]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    # -- versions --------------------------------------------------------

    def _numbers(self) -> list[int]:
        names = self._storage.names(self._versions)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> dict:
        """The newest version: its number, the epoch it reaches and the attempt of each bucket."""
        numbers = self._numbers()
        if not numbers:
            return {"number": -1, "upto": None, "attempts": {}}
        return json.loads(self._storage.read_text(f"{self._versions}/{numbers[-1]}.json"))

    @property
    def upto(self) -> int | None:
        """The epoch up to which changes were merged."""
        return self.version()["upto"]

    def _read(self, version: dict, only: set[int] | None = None) -> DataFrame:
        chosen = {b: a for b, a in version["attempts"].items() if only is None or int(b) in only}
        if not chosen:
            return self._spark.createDataFrame([], self.schema)
        paths = [f"{self._rows}/{attempt}/{BUCKET}={b}" for b, attempt in chosen.items()]
        return self._spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The rows of the newest version."""
        return self._read(self.version())

    # -- merging ---------------------------------------------------------

    def _newest(self, rows: DataFrame, *more: str) -> DataFrame:
        """One row per key; the last in ``order`` wins."""
        keys = [*more, *self.keys]
        values = [c for c in self.schema.names if c not in self.keys and c != self.order]
        best = [F.max_by(v, self.order).alias(v) for v in values]
        return rows.groupBy(*keys).agg(F.max(self.order).alias(self.order), *best)

    def merge(self, changes: DataFrame, upto: int) -> dict:
        """Put the newest of ``changes`` in place of what their keys had; returns the version.

        ``upto`` is the epoch the table then reaches; one it has reached
        already changes nothing.
        """
        while True:
            before = self.version()
            if before["upto"] is not None and before["upto"] >= upto:
                return before
            made = self._merged(before, changes, upto)
            if made is not None:
                return made

    def replace(self, rows: DataFrame, upto: int) -> dict:
        """Let the table hold the newest of ``rows`` and nothing else."""
        while True:
            before = self.version()
            made = self._merged({**before, "attempts": {}}, rows, upto)
            if made is not None:
                return made

    def _merged(self, before: dict, changes: DataFrame, upto: int) -> dict | None:
        """The version after a merge, or none if another came first."""
        attempt = uuid.uuid4().hex
        place = f"{self._rows}/{attempt}"
        # Reduced where they are before any is moved: a key that changes often is one row per task.
        fresh = self._newest(changes.select(*self.schema.names))
        touched = {r[BUCKET] for r in fresh.select(self._bucket()).distinct().collect()}
        if touched:
            both = self._read(before, touched).unionByName(fresh).withColumn(BUCKET, self._bucket())
            # One shuffle by bucket serves the merge and leaves each bucket to one task.
            dealt = both.repartition(min(len(touched), self.buckets), BUCKET)
            self._newest(dealt, BUCKET).write.partitionBy(BUCKET).parquet(place)
        written = {n.partition("=")[2] for n in self._storage.names(place) if n.startswith(f"{BUCKET}=")}
        version = {
            "number": before["number"] + 1,
            "upto": upto,
            "attempts": {**before["attempts"], **dict.fromkeys(sorted(written), attempt)},
        }
        if not self._storage.create_once(f"{self._versions}/{version['number']}.json", json.dumps(version)):
            self._storage.delete(place)
            return None
        self._forget(version["number"])
        return version

    def _forget(self, number: int) -> None:
        """Remove the buckets that none of the last versions names."""
        kept, numbers = {}, self._numbers()
        for n in [n for n in numbers if n > number - _KEPT_VERSIONS]:
            told = json.loads(self._storage.read_text(f"{self._versions}/{n}.json"))
            for bucket, attempt in told["attempts"].items():
                kept.setdefault(attempt, set()).add(bucket)
        for n in [n for n in numbers if n <= number - _KEPT_VERSIONS]:
            gone = json.loads(self._storage.read_text(f"{self._versions}/{n}.json"))
            for bucket, attempt in gone["attempts"].items():
                if bucket not in kept.get(attempt, ()):
                    self._storage.delete(f"{self._rows}/{attempt}/{BUCKET}={bucket}")
                if attempt not in kept:
                    self._storage.delete(f"{self._rows}/{attempt}")
            self._storage.delete(f"{self._versions}/{n}.json")

    # -- size ------------------------------------------------------------

    def files(self) -> dict[int, list[str]]:
        """The data files of each bucket in the newest version."""
        out = {}
        for bucket, attempt in self.version()["attempts"].items():
            names = self._storage.names(f"{self._rows}/{attempt}/{BUCKET}={bucket}")
            out[int(bucket)] = sorted(n for n in names if n.startswith("part-"))
        return out

    def bytes_stored(self) -> int:
        """Size of the newest version's files."""
        attempts = self.version()["attempts"].items()
        return sum(self._storage.size(f"{self._rows}/{attempt}/{BUCKET}={bucket}") for bucket, attempt in attempts)
