"""A Parquet table written in numbered commits, readable as of any of them.

Sources and change feeds share this layout::

    <path>/staging/<attempt>/part-*      rows of an attempt that has no number yet
    <path>/log/<n>.json                  made once: commit n is the attempt it names
    <path>/data/<key>=<n>/part-*         the rows of commit n, moved there after that
    <path>/rejects/<key>=<n>/part-*      what its judged rows hold besides, if it was written so
    <path>/folded/<n>/                   the log entries up to n, in one file

An attempt writes where nobody else does, then claims the next number by making
the log entry, which succeeds for one writer alone; the others take the number
after it. Only rows of a claimed attempt ever reach ``data``, so a stream that
lists ``data`` sees what the log names and nothing else. Whoever finds a claimed
attempt that its writer left in ``staging`` moves it. A job that died before its
claim leaves nothing a reader can see.

Making the entry once needs a file system that refuses to create an existing
file, as HDFS and local disks do. On an object store without conditional writes
a table must have one writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.errors import FELL_BEHIND, fault, from_task
from freshet.session import Storage

FOLD_EVERY = 1000
# The column by which judged rows are kept apart, in their folder's name only.
REFUSED = "_refused"
_ACCEPTED_FOLDER, _REFUSED_FOLDER = f"{REFUSED}=false", f"{REFUSED}=true"
_REPORT = "array<struct<epoch:bigint,source:string,input_rows:bigint,watermark_ms:bigint,duration_ms:bigint>>"
_LOG_FIELDS = (
    "attempt string, rows bigint, late_rows bigint, max_event_us bigint, committed_ms bigint, "
    "rows_before bigint, newest_before_us bigint, upto bigint, claimed_by string, rejected_rows bigint, "
    f"late_before_ms bigint, offsets array<bigint>, reports {_REPORT}"
)


class EpochTable:
    """Commits numbered by ``key``; ``schema`` excludes the key itself."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str):
        self._spark = spark
        self._storage = Storage(spark)
        self.path = path
        self.data_path = f"{path}/data"
        self.log_path = f"{path}/log"
        self.rejects_path = f"{path}/rejects"
        self._staging = f"{path}/staging"
        self._folds = f"{path}/folded"
        self.key = key
        self.schema = schema
        self._known_last: int | None = None
        self._folded: int | None = None
        for folder in (self.data_path, self.log_path, self._staging):
            self._storage.mkdirs(folder)

    @property
    def stored_schema(self) -> T.StructType:
        """The payload and the key, every column nullable as Parquet has it."""
        fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in self.schema.fields]
        return T.StructType([*fields, T.StructField(self.key, T.LongType())])

    # -- writing ---------------------------------------------------------

    def commit(
        self,
        df: DataFrame,
        number: int | None = None,
        event_time: Column | None = None,
        late: Column | None = None,
        **more,
    ) -> dict:
        """Write ``df`` as one commit; returns its log entry.

        Without a ``number`` the next free one is taken. A number that exists
        already keeps its rows: ``df`` still runs, since whoever repeats a
        commit may rely on that, and its rows go nowhere.

        Row count, newest event time and the number of rows for which ``late``
        holds are observed by the write itself, so none costs another pass.
        ``more`` are further fields of the entry.
        """
        if number is not None and self.has(number):
            df.write.format("noop").mode("overwrite").save()
            return self.entry(number)
        return self._attempt(df, number, event_time, late, None, more)

    def commit_judged(
        self, df: DataFrame, event_time: Column | None = None, late: Column | None = None, **more
    ) -> dict:
        """Write judged rows as one commit, in one pass: those with ``REFUSED`` go to the rejects of its number.

        Rows and rejects appear together, since one claim publishes both.
        """
        return self._attempt(df, None, event_time, late, F.col(REFUSED), more)

    def _attempt(
        self,
        df: DataFrame,
        number: int | None,
        event_time: Column | None,
        late: Column | None,
        refused: Column | None,
        more: dict,
    ) -> dict:
        seen, attempt, none = Observation(), uuid.uuid4().hex, F.lit(None).cast("bigint")
        kept = ~refused if refused is not None else F.lit(True)
        newest = F.unix_micros(F.max(F.when(kept, event_time))) if event_time is not None else none
        behind = F.count_if(late & kept) if late is not None else none
        aside = F.count_if(refused) if refused is not None else none
        observed = df.observe(
            seen,
            F.count(F.when(kept, 1)).alias("rows"),
            behind.alias("late_rows"),
            newest.alias("newest"),
            aside.alias("rejected_rows"),
        )
        writer = observed.write if refused is None else observed.write.partitionBy(REFUSED)
        try:
            writer.parquet(f"{self._staging}/{attempt}")
            told = {"attempt": attempt, "rows": seen.get["rows"], "late_rows": seen.get["late_rows"]}
            told |= {"max_event_us": seen.get["newest"], **more}
            if refused is not None:
                told["rejected_rows"] = seen.get["rejected_rows"]
            entry = self._claim(told, number)
        except Exception as error:
            self._storage.delete(f"{self._staging}/{attempt}")
            typed = from_task(error)
            if typed is not None:
                raise typed from error
            raise
        if entry["attempt"] != attempt:
            self._storage.delete(f"{self._staging}/{attempt}")
        else:
            self._publish(entry[self.key], attempt)
            if entry[self.key] % FOLD_EVERY == FOLD_EVERY - 1:
                self.fold_log(entry[self.key] - FOLD_EVERY)
        return entry

    def _claim(self, told: dict, number: int | None) -> dict:
        """The entry made for an attempt, or the one that has its fixed number already.

        Each entry carries the totals before it, so that positions in the
        table are read off one entry instead of summed over the log.
        """
        while True:
            last = self.last()
            mine = number if number is not None else (0 if last is None else last + 1)
            before = self.entry(last) if last is not None else {}
            newest = [us for us in (before.get("newest_before_us"), before.get("max_event_us")) if us is not None]
            entry = {
                self.key: mine,
                **told,
                "committed_ms": int(time.time() * 1000),
                "rows_before": before.get("rows_before", 0) + before.get("rows", 0),
                "newest_before_us": max(newest, default=None),
            }
            made = self._storage.create_once(f"{self.log_path}/{mine}.json", json.dumps(entry))
            if made and not self._overtaken(mine):
                self._known_last = max(mine, -1 if self._known_last is None else self._known_last)
                return entry
            if not made and number is not None:
                return self.entry(mine)

    def _overtaken(self, number: int) -> bool:
        """Whether the number was given away long ago and its entry folded: then the claim is void."""
        folded = self._find_fold()
        if folded is None or number > folded:
            return False
        self._storage.delete(f"{self.log_path}/{number}.json")
        self._known_last = None
        return True

    def _publish(self, number: int, attempt: str) -> None:
        """Move the rows of a claimed attempt to their place; others may help or have done it."""
        source = f"{self._staging}/{attempt}"
        self._storage.mkdirs(f"{self.data_path}/{self.key}={number}")
        names = self._storage.names(source)
        # Rejects first: a stream that sees rows finds what was kept aside with them.
        for inner, place in ((_REFUSED_FOLDER, self.rejects_path), ("", self.data_path), (_ACCEPTED_FOLDER, self.data_path)):
            held = [f"{inner}/{n}" for n in self._storage.names(f"{source}/{inner}")] if inner in names else []
            held = names if not inner else held
            parts = [n for n in held if n.rpartition("/")[2].startswith("part-")]
            if parts:
                self._storage.mkdirs(f"{place}/{self.key}={number}")
            for name in parts:
                self._storage.move(f"{source}/{name}", f"{place}/{self.key}={number}/{name.rpartition('/')[2]}")
        self._storage.delete(source)

    def settle(self) -> None:
        """Finish what writers claimed but did not move."""
        waiting = self._storage.names(self._staging)
        if waiting and self.last() is not None:
            claimed = self.log().where(F.col("attempt").isin(waiting)).select(self.key, "attempt").collect()
            for row in claimed:
                self._publish(row[self.key], row["attempt"])

    def fold_log(self, upto: int | None = None) -> None:
        """Gather the log entries up to ``upto`` in one file, to keep listings short.

        A reader that starts in between finds an entry in the fold, as its own
        file, or as both, and counts it once.
        """
        last = self.last() if upto is None else upto
        if last is None or last < 0 or last == self._find_fold():
            return
        self.log().where(F.col(self.key) <= last).coalesce(1).write.mode("overwrite").json(f"{self._folds}/{last}")
        self._folded = last
        for name in self._storage.names(self._folds):
            if name.isdigit() and int(name) < last:
                self._storage.delete(f"{self._folds}/{name}")
        for number in self._unfolded():
            if number <= last:
                self._storage.delete(f"{self.log_path}/{number}.json")

    def _find_fold(self) -> int | None:
        """The newest complete fold; older entries have no file of their own."""
        done = [int(n) for n in self._storage.names(self._folds) if n.isdigit()]
        done = [n for n in sorted(done) if self._storage.exists(f"{self._folds}/{n}/_SUCCESS")]
        self._folded = done[-1] if done else None
        return self._folded

    def _unfolded(self) -> list[int]:
        names = self._storage.names(self.log_path)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    # -- reading ---------------------------------------------------------

    def has(self, number: int) -> bool:
        if self._folded is not None and number <= self._folded:
            return True
        if self._storage.exists(f"{self.log_path}/{number}.json"):
            return True
        folded = self._find_fold()
        return folded is not None and number <= folded

    def entry(self, number: int) -> dict:
        if self._storage.exists(f"{self.log_path}/{number}.json"):
            return json.loads(self._storage.read_text(f"{self.log_path}/{number}.json"))
        return self.log().where(F.col(self.key) == number).first().asDict()

    def last(self) -> int | None:
        """The newest commit: one listing to start with, then only the next numbers.

        Commits by others are found because they continue the sequence.
        """
        if self._known_last is None:
            folded, own = self._find_fold(), self._unfolded()
            self._known_last = max([*own[-1:], *([folded] if folded is not None else [])], default=None)
        else:
            number = self._known_last
            while self.has(number + 1):
                number += 1
            self._known_last = number
        return self._known_last

    def retained(self, number: int) -> bool:
        """Whether the rows of a commit are still there."""
        return self._storage.exists(f"{self.data_path}/{self.key}={number}")

    def first_retained(self) -> int | None:
        """The oldest commit whose rows are still there."""
        prefix = f"{self.key}="
        kept = [int(n[len(prefix):]) for n in self._storage.names(self.data_path) if n.startswith(prefix)]
        return min(kept) if kept else None

    def log(self) -> DataFrame:
        """The log as a table, one row per commit."""
        reader = self._spark.read.schema(f"{self.key} bigint, {_LOG_FIELDS}")
        folded = self._find_fold()
        if folded is None:
            return reader.json(self.log_path)
        later = reader.json(self.log_path).where(F.col(self.key) > folded)
        return reader.json(f"{self._folds}/{folded}").unionByName(later)

    def read(self, after: int | None = None, upto: int | None = None) -> DataFrame:
        """Rows of committed numbers in ``(after, upto]``; without ``after``, from the first on.

        The upper end is fixed when called, which makes the result a snapshot.
        Asking for rows that retention removed is an error, never a gap.
        """
        last = self.last()
        top = -1 if last is None else (last if upto is None else min(upto, last))
        self.settle()
        due = 0 if after is None else after + 1
        if due <= top and not self.retained(due):
            first = self.first_retained()
            if first is None or due < first:
                lost = (top + 1 if first is None else min(first, top + 1)) - due
                raise fault(FELL_BEHIND, f"{lost} commits from {due} on are no longer kept")
        key, reader = F.col(self.key), self._spark.read.schema(self.stored_schema)
        if 0 < due <= top:
            # Only the folders asked for are listed; retention leaves none out between them.
            folders = [f"{self.data_path}/{self.key}={n}" for n in range(due, top + 1)]
            return reader.option("basePath", self.data_path).parquet(*folders)
        rows = reader.parquet(self.data_path)
        return rows.where((key >= due) & (key <= top))

    def claimed(self, mark: str, after: int | None) -> dict | None:
        """The entry after a number that carries this mark, if any."""
        found = self.log().where((F.col(self.key) > (-1 if after is None else after)) & (F.col("claimed_by") == mark))
        row = found.first()
        return row.asDict() if row else None

    def rows_between(self, after: int | None, upto: int) -> int:
        """How many rows the commits in ``(after, upto]`` have, from two entries."""
        last = self.entry(upto)
        first = self.entry(after) if after is not None else None
        return last["rows_before"] + last["rows"] - (first["rows_before"] + first["rows"] if first else 0)

    # -- retention -------------------------------------------------------

    def retain(self, keep: int, upto: int | None = None) -> int:
        """Drop the rows of all but the newest ``keep`` commits, of those up to ``upto`` if given; the log stays."""
        last = self.last()
        if last is None:
            return 0
        self.settle()
        prefix, dropped = f"{self.key}=", 0
        top = last - keep if upto is None else min(last - keep, upto)
        for name in self._storage.names(self.data_path):
            if name.startswith(prefix) and int(name[len(prefix):]) <= top:
                self._storage.delete(f"{self.data_path}/{name}")
                dropped += 1
        return dropped

    def bytes_stored(self, after: int | None = None) -> int:
        """Size of the files of the commits after a number."""
        if after is None:
            return self._storage.size(self.data_path)
        last = self.last()
        numbers = range(after + 1, (-1 if last is None else last) + 1)
        return sum(self._storage.size(f"{self.data_path}/{self.key}={n}") for n in numbers)

    def stored_files(self) -> DataFrame:
        """Number and size of the data files, from the listing, not the content."""
        files = (
            self._spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(self.data_path)
        )
        return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
