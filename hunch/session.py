"""Session construction and the shared working folder.

Everything durable that the engine writes between stages (index tables, lineage
cuts) goes below the folder the cluster names in ``spark.checkpoint.dir``. That
setting is read from the running session; only when it is missing (a bare local
test session) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app_name: str = "hunch", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings this engine is tuned for.

    On a cluster, call with ``master=None`` and let spark-submit decide; locally pass
    ``local[N]``. AQE stays on: it coalesces the many small shuffle partitions of the
    per-query stages and splits skewed join partitions at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Parquet row-group skipping on the term-sorted postings needs min/max stats.
        "spark.sql.parquet.filterPushdown": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not (master or "").startswith("local") and not shuffle_partitions:
        # On a cluster, start every shuffle with several partitions per core and let AQE
        # coalesce them to its advisory size: the postings shuffle grows with the corpus,
        # a fixed small count would make each reducer hold gigabytes.
        n = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and memoised tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); sets a fresh
    local folder only when neither is configured, as in unit tests.
    """
    sc = spark.sparkContext
    d = None
    try:
        d = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookup differences
        d = None
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="hunch-ckpt-")
        sc.setCheckpointDir(d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once a context (Spark distributes the file)."""
    sc = spark.sparkContext
    if getattr(sc, "_hunch_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="hunch-zip-"), "hunch.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._hunch_shipped = True


def app_scratch(spark: SparkSession, *parts: str) -> str:
    """A per-application path under the shared folder (not created here)."""
    base = shared_dir(spark)
    app = spark.sparkContext.applicationId
    return "/".join([base, "hunch", app, *[p.strip("/") for p in parts]])


class Scope:
    """The working folders and tables that a piece of work makes, so that they can go together.

    ``with scope.open():`` makes every ``fresh_path`` of the thread belong to it (the innermost
    open scope owns a path). ``delete`` removes them; call it once nothing reads them any more,
    that is when the results have been written elsewhere. Deleting twice does no harm."""

    _open = threading.local()

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.tables: list[str] = []

    @classmethod
    def current(cls) -> Scope | None:
        stack = getattr(cls._open, "stack", None)
        return stack[-1] if stack else None

    @contextmanager
    def open(self) -> Iterator[Scope]:
        stack = self._open.__dict__.setdefault("stack", [])
        stack.append(self)
        try:
            yield self
        finally:
            stack.remove(self)

    def delete(self, spark: SparkSession) -> None:
        for t in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {t}")
        for p in self.paths:
            remove_path(spark, p)
        self.paths, self.tables = [], []

    def holds(self, files: list[str]) -> bool:
        """Whether one of ``files`` lies below a folder of this scope."""
        names = [p.rstrip("/").rsplit("/", 1)[-1] for p in self.paths]  # unique by construction
        return any(f"/{n}/" in f for f in files for n in names)


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[Scope]:
    """A scope whose folders and tables are deleted at its end, also after an error. What is to last
    must be written within it, to a path that was made outside."""
    scope = Scope()
    try:
        with scope.open():
            yield scope
    finally:
        scope.delete(spark)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store Spark writes to."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unique path under the application's scratch folder, owned by the open scope if there is one."""
    path = app_scratch(spark, f"{label}-{uuid.uuid4().hex[:12]}")
    if (scope := Scope.current()) is not None:
        scope.paths.append(path)
    return path


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Materialise ``df`` as Parquet in the shared folder and read it back.

    Used where a plan would otherwise be recomputed (a count before a join) or grow
    too deep. Unlike a local checkpoint, the written files survive executor loss.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for APIs that want a plain local path (tests only)."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
