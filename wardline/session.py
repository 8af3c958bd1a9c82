"""Session set-up and lineage cutting.

The only place the library writes intermediate data is the shared folder
the cluster names in ``spark.checkpoint.dir``.  Without one, a local
session uses a scratch folder of its own and a cluster session is an error.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FILES_PER_CORE = 4       # of a stored table, at most (or an eighth of the shuffle partitions)

# application id -> shared folder of that application
_FOLDERS: dict[str, str] = {}

# Settings every session should carry: UTC so millisecond arithmetic on
# instants never sees DST, AQE for runtime coalescing / skew splitting.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # coalesce shuffle output to ~advisory size (64 MB), not to the core count
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": os.environ.get("WARDLINE_PARALLELISM_FIRST", "false"),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "wardline", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster passes its own)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("WARDLINE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data, set once per application.

    It is the folder the session names in ``spark.checkpoint.dir`` (or an
    earlier ``setCheckpointDir``).  Where neither is set, a ``local[...]``
    session gets one scratch folder; on a cluster that is an error, since
    each executor would write to its own disk.
    """
    app = spark.sparkContext.applicationId
    if app in _FOLDERS:
        return _FOLDERS[app]
    path = spark.conf.get("spark.checkpoint.dir", None) or None
    if path is None:
        earlier = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = earlier.get() if earlier.isDefined() else None
    if path is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="wardline-ckpt-")
    spark.sparkContext.setCheckpointDir(path)  # for solvers that checkpoint by themselves
    _FOLDERS[app] = path.rstrip("/")
    return _FOLDERS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/wardline-stage/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: later plans prune columns and push filters into the
    written table, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # a few files per core: shuffles may have far more partitions than a small table needs
    files = max(FILES_PER_CORE * spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    df.coalesce(files).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str = "table", **options) -> DataFrame:
    """Like :func:`stored`, with one file per task that made it; :func:`discard` deletes it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    let_go(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._written_to)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of finished jobs.

    Its cleaner does so once the driver's collector has found their plans
    unreachable, and an idle driver may not collect for half an hour.  The
    listeners hold the plan of the query that ended last, so an empty one ends here.
    """
    spark.range(0).collect()
    gc.collect()
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same as :func:`stored`; the name the pipelines use."""
    return stored(df, "lineage")


def ship_library(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Enough where workers see the driver's file system (local sessions); a
    cluster ships the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
