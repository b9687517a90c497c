"""Session helpers: the shared work folder, small files on it, stream sessions."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from freshet.errors import BAD_CONFIG, fault

# Settings a stream session takes over from the session that opened it.
_INHERITED = (
    "spark.sql.session.timeZone",
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.enabled",
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.streaming.stateStore.providerClass",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
    "spark.sql.codegen.hugeMethodLimit",
    "spark.checkpoint.dir",
)

# HotSpot never compiles methods above 8000 bytes of bytecode. Past that size
# Spark does better with its smaller per-expression methods than with one
# generated method that stays interpreted; wide schemas get there quickly.
_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

_roots: dict[str, str] = {}


def tune(spark: SparkSession) -> None:
    """Set the generated-method limit, unless the session chose one itself."""
    key, value = _METHOD_LIMIT
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, value)


def build_session(app: str = "freshet", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package is written for.

    RocksDB with changelog checkpoints keeps streaming state off the heap, so
    state may outgrow executor memory. Everything else is left to the cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        _METHOD_LIMIT[0]: _METHOD_LIMIT[1],
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The folder for written tables: ``spark.checkpoint.dir`` of the cluster.

    Only a local session without that setting gets a temporary folder, because
    executors on other machines could not read one.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not spark.sparkContext.master.startswith("local"):
                raise fault(BAD_CONFIG, "set spark.checkpoint.dir to a folder every executor can reach")
            own = tempfile.mkdtemp(prefix="freshet-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            shared = "file:" + own
        _roots[app] = f"{shared.rstrip('/')}/freshet-{app}"
    return _roots[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder below the work root that nobody used before."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for one stream: own views, own shuffle width.

    Streaming state keeps the shuffle width of its first run, so the width
    belongs to the stream and not to whoever changes the shared session later.
    """
    own = spark.newSession()
    for key in _INHERITED:
        value = spark.conf.get(key, None)
        if value is not None and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    tune(own)
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


class Storage:
    """Folder and marker-file calls on whatever Hadoop file system holds a path."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def is_file(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target) and fs.getFileStatus(target).isFile()

    def mkdirs(self, path: str) -> None:
        fs, target = self._at(path)
        fs.mkdirs(target)

    def delete(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)

    def size(self, path: str) -> int:
        """Bytes of a file or of everything below a folder."""
        fs, target = self._at(path)
        return fs.getContentSummary(target).getLength() if fs.exists(target) else 0

    def changed(self, path: str) -> int:
        """When a file or folder was changed last, in milliseconds."""
        fs, target = self._at(path)
        return fs.getFileStatus(target).getModificationTime()

    def set_changed(self, path: str, millis: int) -> None:
        """Give a file another time of change."""
        fs, target = self._at(path)
        fs.setTimes(target, millis, -1)

    def names(self, path: str) -> list[str]:
        fs, target = self._at(path)
        if not fs.exists(target):
            return []
        return [status.getPath().getName() for status in fs.listStatus(target)]

    def _write(self, path: str, text: str, overwrite: bool) -> None:
        fs, target = self._at(path)
        out = fs.create(target, overwrite)
        out.write(bytearray(text.encode("utf-8")))
        out.close()

    def write_text(self, path: str, text: str) -> None:
        """Write a small file so that readers see all of it or none."""
        fs, target = self._at(path)
        folder, name = os.path.split(path)
        draft = f"{folder}/_{name}.{uuid.uuid4().hex[:8]}"
        self._write(draft, text, True)
        if not fs.rename(self._at(draft)[1], target):
            fs.delete(self._at(draft)[1], False)
            raise FileExistsError(path)

    def create_once(self, path: str, text: str) -> bool:
        """Make a small file that must not exist; False if it does. One caller of many succeeds.

        Local disks check and create in two steps through the Hadoop client,
        so a finished draft is linked to the name instead, which is one step.
        """
        fs, target = self._at(path)
        if fs.getScheme() != "file":
            try:
                self._write(path, text, False)
            except Py4JJavaError as error:
                if fs.exists(target):
                    return False
                raise error
            return True
        folder, name = os.path.split(path)
        draft = f"{folder}/_{name}.{uuid.uuid4().hex[:8]}"
        self._write(draft, text, True)
        try:
            places = [self._jvm.java.io.File(self._at(p)[1].toUri().getPath()).toPath() for p in (path, draft)]
            self._jvm.java.nio.file.Files.createLink(*places)
            return True
        except Py4JJavaError as error:
            if fs.exists(target):
                return False
            raise error
        finally:
            fs.delete(self._at(draft)[1], False)

    def move(self, path: str, to: str) -> None:
        """Rename a file; done already is as good as done now."""
        fs, source = self._at(path)
        target = self._at(to)[1]
        try:
            moved = fs.rename(source, target)
        except Py4JJavaError:
            moved = False
        if not moved and not fs.exists(target):
            raise FileNotFoundError(path)

    def read_text(self, path: str) -> str:
        fs, target = self._at(path)
        stream = fs.open(target)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()
