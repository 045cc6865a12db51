"""Spark session settings shared by the library, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall-clock for timestamp_ntz round trips,
# AQE for runtime re-planning (partition coalescing, skew-join splitting,
# SMJ -> BHJ when the real size is small), Arrow for the few pandas paths.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


LOCAL_DRIVER_MEMORY = "8g"


def build_session(
    master: str | None = None,
    app_name: str = "faultline",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` is only given for local runs; on a cluster the launcher sets it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = LOCAL_DRIVER_MEMORY  # local mode: the driver JVM runs every task
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and "memory" not in k:
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher names a shared folder; it is read from the
    session and never replaced. Only when it is unset (local tests) a scratch
    folder is created here; on a cluster a machine-local one would lose data, so that raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="faultline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables (lineage cuts, snapshots)."""
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), name)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``faultline`` importable in every Python worker (pandas UDFs refer to it).

    The package is zipped once per application on the driver and added with ``addPyFile``,
    which sends it to all executors whatever file system the shared folder is on.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="faultline-zip-"), f"faultline-{app}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str = "stage"):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from here, not from the
    sources) and lets later passes read only the columns they need. Its shuffle files are of no use once
    it is written, so Spark deletes them then, not when the driver's JVM happens to collect them.
    """
    import uuid
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), "stages", f"{name}-{uuid.uuid4().hex[:12]}")
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


_WRITTEN: dict[str, list[str]] = {}


def drop_stage(df) -> None:
    """Delete one table that ``materialize`` wrote and nothing reads any more."""
    spark = df.sparkSession
    folders = {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}
    conf, Path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    for path in _WRITTEN.get(spark.sparkContext.applicationId, []):
        if os.path.basename(path) in folders:
            p = Path(path)
            p.getFileSystem(conf).delete(p, True)


def stages_written(spark: SparkSession) -> int:
    """How many tables ``materialize`` has written and not dropped in this application."""
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def drop_stages(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables that ``materialize`` wrote, from number ``since`` on; returns how many there were.

    For the end of a job, when its results are written: tables that still read from a stage are lost.
    """
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    paths = written[since:]
    del written[since:]
    conf, Path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        p = Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


BROADCAST_MAX_ROWS = 100_000


def broadcast_if_small(df, max_rows: int = BROADCAST_MAX_ROWS):
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows.

    Larger tables are left to Spark: a sort-merge join, or a broadcast that
    AQE chooses from the real size at run time.
    """
    from pyspark.sql import functions as F
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
