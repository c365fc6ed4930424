"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Whether a query's shuffle files go as soon as it has ended.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "flowlark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where it is installed on the cluster or given as ``--py-files``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="flowlark-")) / "flowlark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return _own_dirs.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="flowlark-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, on the file system it lies on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage.

    Row order and partition numbers of the result are fixed from here on, also
    when an executor is lost and its partitions are read again. The shuffle files behind it
    go at once; Spark alone keeps them until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a new query, as one keeps what is set when it is made
    finally:
        spark.conf.set(SHUFFLES_GO, before)
