"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
BROADCAST_ROWS = 200_000
_own_folders: dict = {}
_shipped: set = set()


def build_session(master: str | None = None, name: str = "pairloom", shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; used by tests, bench and the command line.

    On a cluster, leave ``master`` and ``shuffle_partitions`` unset: ``spark-submit`` names the first and
    AQE sizes the second from the data.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # One maths thread per Python worker: the cores are already shared out as task slots.
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
        .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            os.environ.setdefault("OMP_NUM_THREADS", "1")
            os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers of a session, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        source = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="pairloom-"), "pairloom.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
            for folder, _, names in os.walk(source):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(source)))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return spark


def staging_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir`` as the cluster names it.

    Where it is unset, a local session gets a temporary folder of its own; on a cluster that is an
    error, since a folder of one machine would be lost with that machine.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        if context.applicationId not in _own_folders:
            _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="pairloom-")
        folder = _own_folders[context.applicationId]
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the staging folder."""
    return f"{staging_dir(spark)}/pairloom/{label}-{uuid.uuid4().hex}"


def counted_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a stored table when its rows, which are counted, stay within ``limit``; else the join shuffles."""
    return F.broadcast(df) if df.count() <= limit else df


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, survives the loss of any executor, and unlike a row checkpoint lets later readers
    prune columns and push filters down.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
