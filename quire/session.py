"""Session helpers: building a session, the shared checkpoint folder, staging."""

from __future__ import annotations

import contextvars
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings a local/test session gets; a cluster session keeps its own.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    # JVM case mapping: ~7x faster lower() than ICU; both differ from Python's
    # str.lower() only on a few dozen supplementary code points (newer Unicode).
    "spark.sql.icu.caseMappings.enabled": "false",
    # documents can be long: keep Arrow batches for pandas UDFs / mapInPandas small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, cpus: int | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster use the cluster's session."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    b = SparkSession.builder.master(master).appName("quire")
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and checkpoints.

    Taken from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set (tests, local runs) a fresh
    scratch folder is made and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) on a cluster")
            d = tempfile.mkdtemp(prefix="quire-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


_SCOPES: contextvars.ContextVar[tuple] = contextvars.ContextVar("quire-staging", default=())


class staging:
    """A scope that owns what is staged in it: every scratch path made inside is
    removed when the scope ends, with or without an error. Results are written
    inside the scope, to paths made outside it (or given to :meth:`keep`)::

        with staging(spark):
            query(spark, sf_dir).write.parquet(out)
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> "staging":
        self._token = _SCOPES.set((*_SCOPES.get(), self))
        return self

    def keep(self, path: str) -> None:
        """Hand a path over to the scope around this one (to nobody, if there is none)."""
        if path in self.paths:
            self.paths.remove(path)
            around = _SCOPES.get()[:-1]
            if around:
                around[-1].paths.append(path)

    def __exit__(self, *_) -> None:
        _SCOPES.reset(self._token)
        for path in self.paths:
            _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_result(spark: SparkSession, query: Callable[[], DataFrame], path: str, fmt: str = "parquet") -> None:
    """Write what ``query`` returns to ``path`` and remove all it staged on the way."""
    with staging(spark):
        query().write.format(fmt).save(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, owned by the
    innermost :class:`staging` scope."""
    path = f"{checkpoint_root(spark)}/quire/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES.get():
        _SCOPES.get()[-1].paths.append(path)
    return path


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor recomputes from the staged files, not
    from the sources) and gives later passes a columnar, prunable table.
    """
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("error")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the staged copy ``df`` reads (a frame :func:`stage` returned), once
    nothing reads it any more. Only folders under the staging root are touched."""
    spark = df.sparkSession
    root = f"{checkpoint_root(spark)}/quire/"
    inner = root.split(":", 1)[-1].lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.split(":", 1)[-1].lstrip("/").startswith(inner):
            _delete(spark, folder)


def size_in_bytes(setting: str) -> int:
    """A size as settings spell it: ``10485760``, ``10485760b``, ``256k``, ``10MB``, ``-1``."""
    text = setting.strip().lower().removesuffix("b")
    unit = " kmgt".find(text[-1:]) if text[-1:] in "kmgt" else 0
    return int(text.rstrip("kmgt")) << (10 * unit)


_SHIPPED: set = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``quire`` importable in Python workers (pandas UDFs and
    ``mapInPandas`` functions are pickled by module reference).

    The package is zipped once per driver process and added with
    ``addPyFile``, which distributes it to every executor; a no-op when the
    package is already importable there because it is installed.
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="quire-pkg-"), "quire.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(d, f)
                    zf.write(p, os.path.relpath(p, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
