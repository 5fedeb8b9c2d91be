"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_folders: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect. Dots in names are written as ``__``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.sql.streaming.stopActiveRunOnRestart", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a shared folder")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="topictally-")
    return _local_folders[application]


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder, used by nothing else and deleted with the session."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return folder


class Folder:
    """Small files below a folder, by Spark's own access to its storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.path = path
        root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _place(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def read_text(self, name: str) -> str | None:
        """The text of a file, or None if there is none."""
        if not self.system.exists(self._place(name)):
            return None
        stream = self.system.open(self._place(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        """Write a file under another name first, so that it is there whole or not at all."""
        draft = self._place(f"{name}.draft")
        stream = self.system.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.system.delete(self._place(name), False)
        if not self.system.rename(draft, self._place(name)):
            raise RuntimeError(f"cannot write {self.path}/{name}")

    def sizes(self, name: str) -> dict[str, int]:
        """Bytes of files by the folder below ``name`` that they lie in."""
        found: dict[str, int] = {}
        if self.system.exists(self._place(name)):
            files = self.system.listFiles(self._place(name), True)
            while files.hasNext():
                file = files.next()
                place = file.getPath().getParent().getName()
                found[place] = found.get(place, 0) + file.getLen()
        return found

    def delete(self, name: str) -> None:
        self.system.delete(self._place(name), True)

    def move(self, name: str, other: str) -> None:
        """Give a file or folder another name; folders above it are made."""
        self.system.mkdirs(self._place(other).getParent())
        if not self.system.rename(self._place(name), self._place(other)):
            raise RuntimeError(f"cannot move {self.path}/{name}")
